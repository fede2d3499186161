"""Hard negatives against all pairs; bounds of the index."""

import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from tidemill.llm import negatives

SCHEMA = "vec_id long, vector array<long>, label int, key string, score double"


def plain(rows):
    seen = {(i, la, tuple(v)) for i, v, la in rows if i is not None and la is not None and v is not None and None not in v}
    wide = max((len(v) for *_, v in seen), default=0)
    seen = {(i, la, v + (0,) * (wide - len(v))) for i, la, v in seen}
    out = set()
    for a, label, v in seen:
        if a % 3:
            continue
        scored = sorted((-sum(x * y for x, y in zip(v, w)), i, la) for i, la, w in seen if i != a)
        for less, p, _ in [r for r in scored if r[2] == label][:5]:
            fit = [r for r in scored if r[2] != label and 80 * -less <= 100 * -r[0] <= 100 * -less][:5]
            out |= {(a, p, n, i, -less, -s) for n, (s, i, _) in enumerate(fit, 1)}
    return out


def made(seed, n, wide, big=20):
    rng = random.Random(seed)
    rows, centres = [], [[rng.randint(-big, big) for _ in range(wide)] for _ in range(6)]
    for i in range(n):
        v = [c + rng.randint(-big // 3, big // 3) for c in rng.choice(centres)]
        if rng.random() < 0.2:
            v = [rng.randint(1, 4) * x for x in v]
        rows.append((i, v, rng.randint(0, 3)))
    same = rows[4][1]
    rows += [(n + i, same, 1) for i in range(60)] + [(n + 100 + i, same, 2) for i in range(9)] + [rows[3]] * 4
    rows += [(None, same, 1), (n + 200, None, 1), (n + 201, same, None), (n + 202, [None, *same[1:]], 1), (n + 203, [], 1), (n + 205, same[:2], 2), (n + 207, [0] * wide, 3)]
    return rows


@pytest.mark.parametrize("seed, bucket, stripe, big", [(1, 2048, 1 << 17, 20), (2, 7, 25, 20), (3, 16, 40, 1 << 27)])
def test_all_pairs(spark, monkeypatch, seed, bucket, stripe, big):
    monkeypatch.setattr(negatives, "BUCKET", bucket)
    monkeypatch.setattr(negatives, "STRIPE", stripe)
    rows = made(seed, 150, 5, big)
    frame = spark.createDataFrame([(*r, "k", 0.5) for r in rows], SCHEMA).repartition(3)
    found = [tuple(r) for r in negatives.mine(frame, F.col("vec_id") % 3 == 0).collect()]
    assert len(found) == len(set(found)) and set(found) == plain(rows)


def test_empty_and_too_large(spark):
    empty = spark.createDataFrame([], SCHEMA)
    assert negatives.mine(empty, F.col("vec_id") % 3 == 0).count() == 0
    alone = spark.createDataFrame([(3, [1, 2], 1, "k", 0.1)], SCHEMA)
    assert negatives.mine(alone, F.col("vec_id") % 3 == 0).count() == 0
    with pytest.raises(ValueError):
        negatives.mine(spark.createDataFrame([(3, [1 << 40], 1, "k", 0.1)], SCHEMA), F.col("vec_id") % 3 == 0)


def test_pruning_loses_nothing_and_prunes():
    rng = np.random.default_rng(3)
    vectors = rng.integers(-200, 200, (400, 12)).astype(np.int32)
    vectors[0] = 0
    lengths = np.linalg.norm(vectors, axis=1)
    unit = vectors / np.where(lengths > 0, lengths, 1)[:, None]
    orders = np.argsort(unit.T, axis=1).astype(np.int16)
    labels = np.zeros(400, np.int64)
    bucket = negatives.Bucket(float(lengths.max()), labels.tobytes(), [[i] for i in range(400)], vectors.tobytes(), orders.tobytes(), np.dtype("float64"))
    fewer = 0
    for i in range(1, 100):
        anchor = negatives.Anchor(b"", 0, vectors[i].astype(float), [(0, 0)], True, 5)
        scores = vectors @ vectors[i].astype(np.int64)
        for least in (1, int(0.5 * scores.max()), int(scores[i]), int(scores.max()) + 10**9):
            near = bucket.near(anchor, least)
            assert set(np.flatnonzero(scores >= least)) <= set(near.tolist())
            fewer += 0 < len(near) < 300
    assert fewer > 60
