"""Small tables with the awkward rows every operator must take."""

import random

from pyspark.sql.types import LongType, StringType, StructField, StructType

#: Columns besides key and text whose names operators use inside.
DOCUMENTS = StructType(
    [StructField(n, t) for n, t in (("doc_id", LongType()), ("text", StringType()), ("row", StringType()), ("id", StringType()), ("line", LongType()), ("quality", StringType()), ("n_chars", LongType()))]
)


def words(rng: random.Random, n: int, size: int = 400) -> list[str]:
    return ["".join(rng.choice("aeioustrnl") for _ in range(rng.randint(1, 7))) + str(rng.randint(0, size))[:1] for _ in range(n)]


def texts(seed: int = 5) -> list[tuple]:
    """(doc_id, text): nulls, empty texts, blanks, repeated rows, equal texts, near copies, shared passages, one long text."""
    rng = random.Random(seed)
    passage = " ".join(words(rng, 90))
    base = [" ".join(words(rng, rng.randint(3, 160))).replace(" s", "\n", 3) for _ in range(14)]
    rows = [(i, t) for i, t in enumerate(base)]
    rows += [(100 + i, base[i]) for i in range(3)]
    for i in range(5):
        near = base[i].split(" ")
        near[len(near) // 2] = "changed"
        rows.append((200 + i, " ".join(near)))
        rows.append((300 + i, f"{' '.join(words(rng, 5 * i))} {passage} {' '.join(words(rng, 30))}"))
    rows += [(400, None), (401, ""), (402, " \n\t "), (403, "one"), (404, "one two"), (405, "\n".join(["the same line of the text"] * 4))]
    rows += [(None, base[2]), (None, None), (None, "no id here at all"), (7, base[7]), (7, base[7]), (8, "another text of a known id")]
    rows += [(500, " ".join(words(rng, 6000))), (501, "ab" * 900), (502, "café " * 120 + "中文 \U0001f600"), (503, "A B C a b c " + "x" * 500)]
    return rows


def documents(spark, rows=None):
    rows = texts() if rows is None else rows
    return spark.createDataFrame([(i, t, "r", "i", 1, "q", len(t or "")) for i, t in rows], DOCUMENTS).repartition(3, "doc_id")
