import random

import numpy as np
import pandas as pd
import pytest
from hypothesis import given, settings, strategies as st

from tidemill.operators import ordered


def frame(n, hot, seed):
    rng = random.Random(seed)
    value = lambda: 7.0 if rng.random() < hot else (None if rng.random() < 0.05 else float(rng.randint(0, 50)))
    return pd.DataFrame(
        {"id": range(n), "k": [("a" if rng.random() < 0.6 else rng.choice("bc")) for _ in range(n)], "x": [value() for _ in range(n)],
         "w": [rng.randint(1, 9) for _ in range(n)]}
    )


@pytest.mark.parametrize("descending", [False, True])
@pytest.mark.parametrize("hot", [0.0, 0.4, 1.0])
@pytest.mark.parametrize("settle", [False, True])
def test_order_stats_equals_pandas(spark, descending, hot, settle):
    pdf = frame(700, hot, 3)
    df = spark.createDataFrame(pdf.astype({"x": object}).where(pdf.notna(), None), "id long, k string, x double, w long")
    got = ordered.order_stats(
        df, "x", keys=["k"], descending=descending, tie="id", row_number="rn", rank="rk", dense_rank="dr",
        running={"upto": "w"}, settle=settle, n=6,
    ).toPandas().sort_values("id").reset_index(drop=True)
    order = pdf.assign(s=(-pdf.x if descending else pdf.x).fillna(np.inf)).sort_values(["k", "s", "id"])
    order["rn"] = order.groupby("k").cumcount() + 1
    order["upto"] = order.groupby("k").w.cumsum()
    order["rk"] = order.groupby("k").s.rank(method="min").astype(int)
    order["dr"] = order.groupby("k").s.rank(method="dense").astype(int)
    want = order.sort_values("id").reset_index(drop=True)
    for c in ("rn", "rk", "dr", "upto"):
        assert got[c].tolist() == want[c].tolist(), c


@settings(max_examples=5, deadline=None)
@given(st.lists(st.integers(-20, 20), min_size=1, max_size=40))
def test_exact_quantiles_interpolate_like_numpy(spark, values):
    df = spark.createDataFrame([(float(v),) for v in values], "x double")
    row = ordered.exact_quantiles(df, "x", {"a": 0.333, "b": 0.995}).first()
    assert row.a == pytest.approx(np.quantile(values, 0.333)) and row.b == pytest.approx(np.quantile(values, 0.995))


def test_percent_rank_shares_ties(spark):
    pdf = pd.DataFrame({"id": range(8), "x": [1.0, 5.0, 5.0, 9.0, None, 5.0, 2.0, None]})
    df = spark.createDataFrame(pdf.astype({"x": object}).where(pdf.notna(), None), "id long, x double")
    got = ordered.average_percent_rank(df, "x", "p").toPandas().sort_values("id").p.tolist()
    assert got == pytest.approx(pdf.x.rank(pct=True, na_option="keep").fillna(0).tolist())


def test_empty_input(spark):
    df = spark.createDataFrame([], "id long, x double")
    assert ordered.order_stats(df, "x", tie="id", row_number="rn").count() == 0
    assert ordered.exact_quantiles(df, "x", {"a": 0.5}).first().a is None


@pytest.mark.parametrize("hot", [0.0, 0.9])
def test_ranks_without_tie(spark, hot):
    pdf = frame(600, hot, 9)
    df = spark.createDataFrame(pdf.astype({"x": object}).where(pdf.notna(), None), "id long, k string, x double, w long")
    got = ordered.order_stats(df, "x", rank="rk", dense_rank="dr", n=6).toPandas().sort_values("id").reset_index(drop=True)
    x = pdf.x.fillna(np.inf)
    assert got.rk.tolist() == x.rank(method="min").astype(int).tolist()
    assert got.dr.tolist() == x.rank(method="dense").astype(int).tolist()
    if hot:  # the frequent value is dealt over several parts
        assert ordered.cut_ranges(df, "x", n=6, spread=True).df.where("x = 7").select("__part").distinct().count() > 2


def test_row_number_over_text(spark):
    names = ["src/b.py", "src/a.py", None, "src/a/é.py", "src/ab", "src/", "src/zz" * 3, "src/é"]
    df = spark.createDataFrame([(n,) for n in names], "name string")
    got = ordered.order_stats(df, "name", tie="name", row_number="rn", n=4, settle=True).collect()
    want = sorted((n for n in names if n is not None), key=str.encode)
    assert [r.name for r in sorted(got, key=lambda r: r.rn)] == [*want, None]


PATH = "src/main/java/org/xy"


def paths(n, seed=4):
    """Names nearly all of which share 20 bytes, with nulls, empty and non-ASCII ones."""
    rng = random.Random(seed)
    names = [f"{PATH}{rng.randint(0, 10**6):06d}.java" for _ in range(n)]
    return names + ["README", "", "é/ü", "src/", "src/main/java/org/xy\uffffz", "src/main/java/org/xy\U00010000z"] * max(1, n // 6000)


def range_sizes(cut):
    return sorted((r["count"] for r in cut.df.groupBy("__range", "__part").count().collect()), reverse=True)


@pytest.mark.parametrize("descending", [False, True])
def test_text_ranges_are_even_under_one_prefix(spark, descending):
    rows = [(t,) for t in paths(30_000)]
    cut = ordered.cut_ranges(spark.createDataFrame(rows, "name string").repartition(4), "name", descending, n=16)
    sizes = range_sizes(cut)
    assert len(sizes) == 16 and sizes[0] < 2 * len(rows) / 16
    spans = cut.df.groupBy("__range").agg({"name": "min"}).orderBy("__range").collect()
    firsts = [r[1].encode() for r in spans]
    assert firsts == sorted(firsts, reverse=descending)


@pytest.mark.parametrize("tie_type", ["long", "string"])
def test_frequent_text_is_split_by_its_tie(spark, tie_type):
    rows = [("the same" if i % 3 else f"{PATH}{i}", i if tie_type == "long" else f"key {i:06d}") for i in range(9000)]
    df = spark.createDataFrame(rows, f"name string, id {tie_type}").repartition(4)
    sizes = range_sizes(ordered.cut_ranges(df, "name", tie="id", n=12))
    assert sizes[0] < 2 * len(rows) / 12
    got = {r.id: r.rn for r in ordered.order_stats(df, "name", tie="id", row_number="rn", n=12).collect()}
    assert got == {k: i for i, (_, k) in enumerate(sorted(rows, key=lambda r: (r[0].encode(), r[1])), 1)}


@pytest.mark.parametrize("descending", [False, True])
def test_text_order_equals_python(spark, descending):
    rows = [(None if i % 50 == 0 else t, i, i % 7) for i, t in enumerate(paths(800) + paths(300) + ["b"] * 400)]
    df = spark.createDataFrame(rows, "name string, id long, w long").repartition(3)
    got = ordered.order_stats(df, "name", descending=descending, tie="id", row_number="rn", rank="rk", dense_rank="dr", running={"upto": "w"}, n=7)
    known = sorted((r for r in rows if r[0] is not None), key=lambda r: r[1])
    known.sort(key=lambda r: r[0].encode(), reverse=descending)
    order = known + [r for r in rows if r[0] is None]
    found = sorted(got.collect(), key=lambda r: r.rn)
    assert [r.id for r in found] == [r[1] for r in order]
    assert [r.rn for r in found] == list(range(1, len(rows) + 1))
    upto, rank, dense, last = 0, 0, 0, object()
    for place, (r, want) in enumerate(zip(found, order), 1):
        if want[0] != last:
            rank, dense, last = place, dense + 1, want[0]
        upto += want[2]
        assert (r.upto, r.rk, r.dr) == (upto, rank, dense)


def test_frequent_number_with_a_text_tie(spark):
    rows = [(5.0 if i % 4 else float(i), f"{PATH}{i:05d}") for i in range(4000)]
    df = spark.createDataFrame(rows, "x double, name string").repartition(4)
    cut = ordered.cut_ranges(df, "x", tie="name", n=8)
    assert range_sizes(cut)[0] < 2 * len(rows) / 8
    got = {r.name: r.rn for r in ordered.order_stats(df, "x", tie="name", row_number="rn", n=8).collect()}
    assert got == {k: i for i, (_, k) in enumerate(sorted(rows), 1)}
