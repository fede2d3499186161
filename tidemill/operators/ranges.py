"""Joins on overlapping periods and on network prefixes, as equi-joins.

Spark plans a nested loop for an inequality join. Here periods are cut into pieces
along one grid, and rows meet where they have a piece in the same cell. A point lies
in one cell, so it is never copied. The cells are as wide as a third of the mean
period, or wider, so all pieces together are at most four per period however unequal
the periods are; and a cell holds no more than about a third as many short periods as
long ones cross it, so few candidates are tested in vain. Two periods that share
several cells are joined in the one where the later of them begins.

A cell that holds more than its share of the probing rows is salted: its rows are
dealt over several tasks, to each of which the cell's periods are sent.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Observation, functions as F

#: A cell with more than one in so many probing rows is salted; there are fewer than this.
SHARES = 256
#: Pieces of a period are listed in two steps, so that no row holds more than this many, or this many blocks of them.
BLOCK = 1024


def _bounded(df: DataFrame, begin: Column, end: Column, prefix: str) -> DataFrame:
    kept = df.select(F.struct(*df.columns).alias(f"{prefix}row"), begin.alias(f"{prefix}b"), end.alias(f"{prefix}e"))
    return kept.where(F.col(f"{prefix}b").isNotNull() & F.col(f"{prefix}e").isNotNull())


def _grid(frames: list[tuple[DataFrame, str]], width: int) -> int:
    """Cell width: a third of the greater mean length, ``width`` at least."""
    for df, prefix in frames:
        length = F.greatest(F.col(f"{prefix}e").cast("double") - F.col(f"{prefix}b").cast("double"), F.lit(0.0))
        mean = df.agg(F.avg(length)).first()[0]
        width = max(width, int(mean or 0) // 3 + 1)
    return width


def _cell(column: str, width: int) -> Column:
    """Whole cells below the bound, downwards for negative numbers too."""
    at = F.col(column).cast("long")
    return F.call_function("div", at - F.pmod(at, F.lit(width).cast("long")), F.lit(width).cast("long"))


def _pieces(df: DataFrame, prefix: str, width: int) -> DataFrame:
    """One row per cell that the period touches, with the first of them."""
    df = df.withColumn(f"{prefix}first", _cell(f"{prefix}b", width)).withColumn("__last", _cell(f"{prefix}e", width))
    df = df.withColumn("__last", F.greatest(f"{prefix}first", "__last"))
    blocks = F.sequence(F.lit(0).cast("long"), F.floor((F.col("__last") - F.col(f"{prefix}first")) / BLOCK))
    df = df.withColumn("__from", F.explode(F.transform(blocks, lambda b: F.col(f"{prefix}first") + b * BLOCK)))
    to = F.least(F.col("__from") + (BLOCK - 1), F.col("__last"))
    return df.withColumn("__cell", F.explode(F.sequence("__from", to))).drop("__from", "__last")


def _points(df: DataFrame, prefix: str, width: int) -> DataFrame:
    return df.withColumn("__cell", _cell(f"{prefix}b", width)).withColumn(f"{prefix}first", F.col("__cell"))


def _salted(probes: DataFrame, pieces: DataFrame, row: str) -> tuple[DataFrame, DataFrame]:
    """Both sides with ``__salt``, which differs from 0 in crowded cells only."""
    seen = Observation()
    counts = probes.groupBy("__cell").agg(F.count(F.lit(1)).alias("n")).observe(seen, F.sum("n").alias("total"))
    crowded = counts.orderBy(F.col("n").desc(), "__cell").limit(SHARES).collect()
    total = seen.get["total"]
    parts = {r["__cell"]: -(-r["n"] * SHARES // total) for r in crowded if r["n"] * SHARES > total}
    salts = F.lit(1)
    if parts:
        table = F.create_map(*[F.lit(x) for kv in parts.items() for x in kv])
        salts = F.coalesce(F.try_element_at(table, F.col("__cell")), F.lit(1))
    dealt = probes.withColumn("__salt", F.pmod(F.xxhash64(row), salts).cast("int"))
    return dealt, pieces.withColumn("__salt", F.explode(F.sequence(F.lit(0), (salts - 1).cast("int"))))


def interval_join(
    left: DataFrame,
    right: DataFrame,
    left_begin: Column,
    left_end: Column,
    right_begin: Column,
    right_end: Column,
    width: int,
    closed: bool = False,
) -> DataFrame:
    """Pairs of rows whose periods overlap.

    Bounds are whole numbers (microseconds, days, addresses); ``width`` is the
    narrowest cell, best near a usual period length. Half-open by default:
    ``not (b1 >= e2 or b2 >= e1)``; ``closed`` counts touching ends as well.
    Column names of the two sides must differ. ``left`` should be the larger side:
    crowded cells are dealt out by its rows.
    """
    a, c = _bounded(left, left_begin, left_end, "__l"), _bounded(right, right_begin, right_end, "__r")
    width = _grid([(a, "__l"), (c, "__r")], width)
    probes, pieces = _salted(_pieces(a, "__l", width), _pieces(c, "__r", width), "__lrow")
    lb, le, rb, re = (F.col(n) for n in ("__lb", "__le", "__rb", "__re"))
    touching = (lb <= re) & (rb <= le) if closed else (lb < re) & (rb < le)
    met = probes.join(pieces, ["__cell", "__salt"]).where(touching & (F.col("__cell") == F.greatest("__lfirst", "__rfirst")))
    return met.select("__lrow.*", "__rrow.*")


def point_in_period(
    points: DataFrame, periods: DataFrame, point: Column, begin: Column, end: Column, width: int
) -> DataFrame:
    """Points with the periods that hold them; both ends belong to the period. A point is one row up to the join."""
    a, c = _bounded(points, point, point, "__l"), _bounded(periods, begin, end, "__r")
    width = _grid([(c, "__r")], width)
    probes, pieces = _salted(_points(a, "__l", width), _pieces(c, "__r", width), "__lrow")
    met = probes.join(pieces, ["__cell", "__salt"]).where("__rb <= __lb AND __lb <= __re")
    return met.select("__lrow.*", "__rrow.*")


_QUAD = "(25[0-5]|2[0-4][0-9]|1?[0-9]?[0-9])"


def ipv4_number(address: Column) -> Column:
    """Dotted quad to its number; null when it is not an address."""
    parts = F.transform(F.split(address, r"\."), lambda q: q.cast("bigint"))
    number = F.aggregate(parts, F.lit(0).cast("bigint"), lambda n, q: n * 256 + q)
    return F.when(address.rlike(rf"^{_QUAD}(\.{_QUAD}){{3}}$"), number)


def net_mask(bits: Column) -> Column:
    """Number of the mask with that many leading ones."""
    return F.lit(4294967296) - F.pow(F.lit(2), 32 - bits).cast("bigint")


def network_join(hosts: DataFrame, networks: DataFrame, address: str, network: str, bits: str) -> DataFrame:
    """Hosts with every network that contains them: an equi-join per prefix length.

    There are at most 33 prefix lengths; only those in use multiply the hosts.
    Networks without a length from 0 to 32 hold no host.
    """
    networks = networks.where(F.col(bits).between(0, 32))
    lengths = [r[0] for r in networks.select(bits).distinct().collect()]
    masked = F.transform(
        F.array(*[F.struct(F.lit(n).alias("bits"), F.lit(2**32 - 2 ** (32 - n)).alias("mask")) for n in lengths]),
        lambda m: F.struct(m["bits"].alias("bits"), F.col("__n").bitwiseAND(m["mask"]).alias("net")),
    )
    numbered = hosts.withColumn("__n", ipv4_number(F.col(address))).where("__n IS NOT NULL")
    probes = numbered.withColumn("__p", F.explode(masked)).drop("__n")
    nets = networks.withColumn("__net", ipv4_number(F.col(network)).bitwiseAND(net_mask(F.col(bits))))
    return probes.join(nets, (F.col("__p.bits") == F.col(bits)) & (F.col("__p.net") == F.col("__net"))).drop("__p", "__net")
