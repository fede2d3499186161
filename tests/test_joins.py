import itertools
import random

from pyspark.sql import functions as F

from tidemill.operators import joins, ranges, similar


def periods(n, seed, long):
    rng = random.Random(seed)
    rows = []
    for i in range(n):
        b = rng.randint(-500, 500)
        length = rng.choice([0, 1, 7, 60, 5000]) if rng.random() < long else rng.randint(0, 10)
        rows.append((i, b, b + length))
    return rows


def joined(spark, left, right, closed):
    a = spark.createDataFrame(left, "i long, b1 long, e1 long")
    c = spark.createDataFrame(right, "j long, b2 long, e2 long")
    out = ranges.interval_join(a, c, F.col("b1"), F.col("e1"), F.col("b2"), F.col("e2"), width=4, closed=closed)
    return sorted((r.i, r.j) for r in out.collect())


def test_interval_join_equals_brute_force(spark):
    left, right = periods(60, 1, 0.3) + [(99, None, 4)], periods(60, 2, 0.5)
    for closed in (False, True):
        test = (lambda a, b, c, d: a <= d and c <= b) if closed else (lambda a, b, c, d: a < d and c < b)
        want = sorted((l[0], r[0]) for l, r in itertools.product(left, right) if l[1] is not None and test(l[1], l[2], r[1], r[2]))
        assert joined(spark, left, right, closed) == want


def test_one_hot_long_period_meets_everything_once(spark):
    left, right = [(i, i, i + 1) for i in range(200)], [(0, -10**9, 10**9)]
    assert joined(spark, left, right, False) == [(i, 0) for i in range(200)]


def test_points_are_not_copied_and_crowded_cells_are_dealt_out(spark):
    rng = random.Random(8)
    points = [(i, 5_000_003 if i % 2 else rng.randint(-10**7, 10**7)) for i in range(6000)] + [(-1, None)]
    spans = [(j, b, b + rng.choice([0, 3, 200, 10**6])) for j, b in enumerate(rng.randint(-10**7, 10**7) for _ in range(300))]
    spans += [(900, 5_000_003, 5_000_003), (901, 5_000_004, 5_000_000), (902, -(10**12), 10**12), (903, None, 4)]
    a, c = spark.createDataFrame(points, "i long, at long"), spark.createDataFrame(spans, "j long, b long, e long")
    out = ranges.point_in_period(a, c, F.col("at"), F.col("b"), F.col("e"), width=4)
    got = sorted((r.i, r.j) for r in out.collect())
    assert got == sorted((i, j) for i, at in points if at is not None for j, b, e in spans if b is not None and b <= at <= e)
    probes, _ = ranges._salted(ranges._points(ranges._bounded(a, F.col("at"), F.col("at"), "__l"), "__l", 1000), c.withColumn("__cell", F.col("j")), "__lrow")
    sizes = [r["count"] for r in probes.groupBy("__cell", "__salt").count().collect()]
    assert sum(sizes) == 6000 and max(sizes) < 6000 // 64


def test_pieces_grow_with_the_periods(spark):
    spans = [(j, j * 50, j * 50 + 3) for j in range(500)] + [(999, 0, 10**15)]
    c = ranges._bounded(spark.createDataFrame(spans, "j long, b long, e long"), F.col("b"), F.col("e"), "__r")
    pieces = ranges._pieces(c, "__r", ranges._grid([(c, "__r")], 1))
    assert pieces.count() <= 4 * len(spans)
    assert pieces.groupBy("__rrow", "__cell").count().where("count > 1").isEmpty()


def test_ipv4(spark):
    rows = spark.createDataFrame([("10.0.0.1",), ("255.255.255.255",), ("1.2.3",), ("300.1.1.1",), (None,)], "a string")
    got = [r[0] for r in rows.select(ranges.ipv4_number(F.col("a"))).collect()]
    assert got == [167772161, 4294967295, None, None, None]


def test_prefer_and_exclude(spark):
    a = spark.createDataFrame([(1, "a"), (2, "a")], "k int, s string")
    b = spark.createDataFrame([(2, "b"), (3, "b")], "k int, s string")
    assert sorted(map(tuple, joins.prefer(a, b, ["k"]).collect())) == [(1, "a"), (2, "a"), (3, "b")]
    rows = spark.createDataFrame([(1,), (2,), (None,), (9,)], "k int")
    kept = joins.exclude_ids(rows, "k", [a.where("k = 1").select("k")], [9]).collect()
    assert sorted((r.k or 0) for r in kept) == [0, 2]


def test_fuzzy_finds_every_pair_within_one_edit(spark):
    names = ["red bolt", "red bol", "red bolts", "rad bolt", "blue", "", "b"]
    one = spark.createDataFrame([(n,) for n in names], "a string")
    got = {(r.a, r.b) for r in similar.fuzzy_match(one, one.withColumnRenamed("a", "b"), "a", "b").collect()}

    def edits(a, b):
        row = list(range(len(b) + 1))
        for i, x in enumerate(a, 1):
            row, last = [i], row
            for j, y in enumerate(b, 1):
                row.append(min(last[j] + 1, row[-1] + 1, last[j - 1] + (x != y)))
        return row[-1]

    assert got == {(a, b) for a in names for b in names if edits(a, b) <= 1}


def test_network_without_a_length_holds_no_host(spark):
    hosts = spark.createDataFrame([("10.0.0.1",), (None,), ("x",)], "host string")
    nets = spark.createDataFrame([("10.0.0.0", 8), ("10.0.0.0", None), ("10.0.0.0", 40)], "net string, bits int")
    assert [tuple(r) for r in ranges.network_join(hosts, nets, "host", "net", "bits").collect()] == [("10.0.0.1", "10.0.0.0", 8)]


def test_similarity_join_loses_no_pair(spark):
    import duckdb

    rng = random.Random(11)
    words = ["".join(rng.choice("abcdeéx #") for _ in range(rng.choice([1, 2, 3, 5, 8, 12, 30]))) for _ in range(120)]
    typed = words[:60] + ["".join(rng.sample(w, len(w))) for w in words[:20]] + [w[1:] + w[:1] for w in words[20:60]] + [w + "zz" for w in words[40:90]]
    words, typed = sorted({*words, "", "martha"}), sorted({*typed, "", "marhta"})
    a = spark.createDataFrame([(w,) for w in words] + [(None,), (words[3],)], "a string")
    b = spark.createDataFrame([(w,) for w in typed] + [(None,)], "b string")
    ascii_pairs = [(x, y) for x in words for y in typed]
    scores = dict(zip(ascii_pairs, similar._score([x for x, _ in ascii_pairs], [y for _, y in ascii_pairs])))
    for threshold in (0.8, 0.9, 1.0):
        got = {(r.a, r.b): r.score for r in similar.similarity_join(a, b, "a", "b", threshold).collect()}
        want = {p: s for p, s in scores.items() if s >= threshold - 1e-9}
        assert set(got) == set(want)
    con = duckdb.connect()
    for (x, y), s in scores.items():
        if x.isascii() and y.isascii() and x and y:
            assert abs(con.execute("SELECT jaro_winkler_similarity(?, ?)", [x, y]).fetchone()[0] - s) < 1e-9
