"""Near duplicates of the pipeline's stage against all pairs."""

import random
from collections import Counter

import corpus_pipeline
import pytest

from tests.llm.cases import documents, texts, words
from tidemill.llm import shingles


def plain_set(text):
    found = (text or "").encode().lower().split()
    return {tuple(found[i : i + 5]) for i in range(max(1, len(found) - 4))} if found else set()


def near_copies():
    """Texts of 120 words with one or two of them replaced, and a group of 40 copies with a word of their own each."""
    rng = random.Random(11)
    rows = []
    for i in range(60):
        base = words(rng, 120, 9)
        other = list(base)
        for at in rng.sample(range(120), 1 + i % 2):
            other[at] = f"replaced{at}"
        rows += [(1000 + 2 * i, " ".join(base)), (1001 + 2 * i, " ".join(other))]
    base = words(rng, 200, 9)
    return rows + [(2000 + i, " ".join([*base[:i], f"own{i}", *base[i:]])) for i in range(40)]


def plain_components(rows):
    sets = [plain_set(t) for _, t in rows]
    parent = list(range(len(rows)))

    def root(i):
        while parent[i] != i:
            i = parent[i]
        return i

    for i, a in enumerate(sets):
        for j, b in enumerate(sets[:i]):
            if len(a & b) >= 0.8 * len(a | b) - 1e-9:
                parent[root(i)] = root(j)
    least = {}
    for i, (key, _) in enumerate(rows):
        if key is not None:
            least[root(i)] = min(least.get(root(i), key), key)
    return [(key, least.get(root(i))) for i, (key, _) in enumerate(rows)]


@pytest.mark.parametrize("crowded", [0, 32])
def test_all_pairs(spark, monkeypatch, crowded):
    monkeypatch.setattr(shingles.links, "__defaults__", (shingles.SHINGLE, shingles.SIMILAR, crowded))
    rows = texts() + near_copies()
    found = shingles.near_duplicates(documents(spark, rows)).collect()
    assert Counter((r.id, r.component) for r in found) == Counter(plain_components(rows))


def test_stage_finds_near_copies(spark):
    rows = near_copies()
    kept = {r.doc_id for r in corpus_pipeline.near_dedup(spark, documents(spark, rows), "").collect()}
    assert kept == {c for _, c in plain_components(rows)}
    assert len(rows) - len(kept) > 90


def test_simhash_finds_close_copies(spark, monkeypatch):
    """Without any band, the stage still links what its fingerprints say, and only where the sets are similar."""
    monkeypatch.setattr(shingles, "band_keys", lambda hashes: [])
    rng = random.Random(12)
    base = words(rng, 900, 9)
    rows = [(1, " ".join(base)), (2, " ".join([*base, "end"])), (3, " ".join(words(rng, 900, 9))), (4, "a b"), (5, "a b"), (6, "")]
    kept = {r.doc_id for r in corpus_pipeline.near_dedup(spark, documents(spark, rows), "").collect()}
    assert kept == {1, 3, 4, 6}


def test_simhash_pairs_of_equal_fingerprints(spark):
    nodes = spark.createDataFrame([(1, 0), (2, 0), (3, 3), (4, 7 << 20)], "node long, fp long")
    assert {(r.a, r.b) for r in shingles.simhash_pairs(nodes).collect()} == {(1, 2), (1, 3)}


def test_empty(spark):
    assert shingles.deduplicate(documents(spark, [])).count() == 0
