"""Exact clustering of one column against all ways to cut."""

import itertools
import random

import pytest

from tidemill.operators import models


def plain(values, k):
    values = sorted(values)
    places = sorted(set(values))

    def cost(part):
        mean = sum(part) / len(part)
        return sum((x - mean) ** 2 for x in part)

    found = []
    for cuts in itertools.combinations(places[:-1], min(k, len(places)) - 1):
        bounds = [float("-inf"), *cuts, float("inf")]
        found.append((sum(cost([x for x in values if a < x <= b]) for a, b in zip(bounds, bounds[1:])), list(cuts)))
    least = min(c for c, _ in found)
    return min(cuts for c, cuts in found if c <= least + 1e-9)


@pytest.mark.parametrize("k, marks", [(3, 2048), (3, 8), (2, 6), (4, 10)])
def test_least_cost_cuts(spark, monkeypatch, k, marks):
    monkeypatch.setattr(models, "MARKS", marks)
    rng = random.Random(k * marks)
    for values in (
        [float(rng.choice([0, 10, 100]) + rng.randint(0, 9)) for _ in range(90)],
        [float(i) for i in range(24)],  # many cuts cost the same: the lowest win
    ):
        df = spark.createDataFrame([(v,) for v in [*values, None]], "x double")
        assert models.least_cost_cuts(df, "x", k) == plain(values, k)


def test_few_values(spark):
    df = spark.createDataFrame([(1.0,), (5.0,), (5.0,), (None,)], "x double")
    got = {r.x: r.c for r in models.named_clusters(df, "x", ["low", "mid", "high"], "c").collect()}
    assert got == {1.0: "low", 5.0: "mid"}
    assert models.named_clusters(df.limit(0), "x", ["low", "mid", "high"], "c").count() == 0
