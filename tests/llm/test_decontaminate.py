"""Benchmark items in documents: other names and numbers, sentence openings, and items of few literals."""

import pytest

from tests.llm.cases import documents
from tidemill.llm import decontaminate

ITEMS = [
    (1, "Anna has 12 apples. Ben gives her 5. Anna eats 2. How many apples does Anna have left?"),
    (2, "Grandmother baked seven small loaves before lunch began"),
    (3, "What is 12 times 7?"),
    (4, "Compute 3 + 4 - 5 + 6 - 7 + 8 - 9"),
    (5, "The red fox sees nothing in the dark wood."),
    (6, "Twelve"),
    (7, None),
    (8, ""),
]


def found(spark, rows):
    items = spark.createDataFrame(ITEMS, "item_id int, text string")
    return {(r.id, r.item): r.windows for r in decontaminate.find(documents(spark, rows), items).collect()}


@pytest.fixture(scope="module")
def hits(spark):
    rows = [
        (1, "So: Maria has 31 apples. Tom gives her 8. Maria eats 4. How many apples does Maria have left?"),
        (2, "Maria has 31 apples. Tom gives her 8. Jack eats 4. How many apples does Jack have left?"),
        (3, "she wrote that Grandmother baked seven small loaves before lunch began and left"),
        (4, "they asked: What is 12 times 7? Nobody knew"),
        (5, "they asked: What is 13 times 7? Nobody knew"),
        (6, "Now Compute 3 + 4 - 5 + 6 - 7 + 8 - 9 and stop"),
        (7, "Now Compute 3 + 4 - 5 + 6 - 7 + 8 - 1 and stop"),
        (8, "we know the red fox sees nothing in the dark wood, she said"),
        (9, ITEMS[0][1]),
        (10, None),
        (11, ""),
        (12, " ".join("1 2 3" for _ in range(500))),
    ]
    return found(spark, rows)


def test_names_that_open_sentences(hits):
    assert (1, 1) in hits and (9, 1) in hits
    assert (2, 1) not in hits or hits[2, 1] < hits[1, 1]  # other persons in the same places
    assert (3, 2) in hits


def test_items_of_few_literals(hits):
    assert (4, 3) in hits and (5, 3) not in hits
    assert (6, 4) in hits and (7, 4) not in hits


def test_openings_in_small_letters(hits):
    assert (8, 5) in hits


def test_nothing_else(hits):
    assert {d for d, _ in hits} <= {1, 2, 3, 4, 6, 8, 9}


def test_windows_count_once(spark):
    text = "The old miller went to town and sold one sack of flour there."
    items = spark.createDataFrame([(1, text)], "item_id int, text string")
    (row,) = decontaminate.find(documents(spark, [(1, text), (1, text)]), items).collect()
    assert (row.windows, row.first) == (2 * 4, 0)
