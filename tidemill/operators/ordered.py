"""Order statistics over a whole table or over a few large groups.

A window without a partition key, or with a key that holds a third of the
rows, sorts those rows in one task. The operators here cut the order column
into ranges first. Each range is sorted by itself, and what lies before it is
added from a table with one line per range.

The cut points of numbers and times come from ``approxQuantile``, those of text
from a bounded sample compared byte by byte, as Spark orders text, so a prefix
that most texts share costs nothing. A cut point that repeats is a value so
frequent that one range could not hold it evenly; it gets a range of its own,
which is cut once more by the tie-break column.
"""

from __future__ import annotations

import math
from dataclasses import dataclass

from pyspark.ml.feature import Bucketizer
from pyspark.sql import Column, DataFrame, Window, functions as F

from tidemill.functions.columns import position
from tidemill.session import cut_lineage, parallelism

#: Sampled texts per range, sampled texts in all, and characters of a text that the sample keeps.
PER_RANGE, SAMPLE, PREFIX = 200, 200_000, 1024

_POS, _TIE, _RANGE, _PART, _KEY = "__pos", "__tie", "__range", "__part", "__key"


@dataclass(frozen=True)
class Ranges:
    """A frame with range columns, and the order inside a range."""

    df: DataFrame
    by: str
    descending: bool
    tie: str | None

    @property
    def order(self) -> list[Column]:
        first = F.col(self.by).desc_nulls_last() if self.descending else F.col(self.by).asc_nulls_last()
        return [first] + ([F.col(self.tie)] if self.tie else [])


def _cuts(df: DataFrame, n: int) -> tuple[list[float], list[float], list[float]]:
    """Cut points of the position, the frequent positions, cut points of the tie."""
    probs = [i / n for i in range(1, n)]
    columns = [c for c in (_POS, _TIE) if c in df.columns]
    found = df.approxQuantile(columns, probs, 0.25 / n)
    points = [p for p in found[0] if math.isfinite(p)] if found[0] else []
    frequent = sorted({a for a, b in zip(points, points[1:]) if a == b})
    ties = sorted(set(found[1])) if len(columns) == 2 and found[1] else []
    return sorted(set(points)), frequent, ties


def _text_sample(df: DataFrame, columns: list[str], n: int) -> list[tuple]:
    """A bounded sample of the rows: some ``PER_RANGE`` for each of n ranges, ``SAMPLE`` at most, texts cut after ``PREFIX`` characters."""
    rows, wanted = df.count(), min(PER_RANGE * n, SAMPLE)
    some = df.select(*[F.substring(c, 1, PREFIX) if t == "string" else F.col(c) for c, t in df.select(*columns).dtypes])
    return [tuple(r) for r in some.sample(min(1.0, 1.2 * wanted / max(rows, 1)), 7).limit(2 * wanted).collect()]


def _text_cuts(values: list[str], n: int) -> tuple[list[str], list[str]]:
    """Cut points between n ranges of the sampled texts, and the texts that fill a range."""
    values = sorted((v for v in values if v is not None), key=str.encode)
    points = [values[len(values) * i // n] for i in range(1, n)] if values else []
    frequent = sorted({a for a, b in zip(points, points[1:]) if a == b}, key=str.encode)
    # Nothing lies between a text and the same text with a zero byte behind it.
    return sorted({*points, *(f + "\0" for f in frequent)}, key=str.encode), frequent


def _place(column: str, cuts: list[str]) -> Column:
    """How many cut points are not above the text; two short searches instead of one over all of them."""
    if not cuts:
        return F.lit(0.0)
    step = math.ceil(math.sqrt(len(cuts)))
    blocks = [cuts[i : i + step] for i in range(0, len(cuts), step)]
    at_most = lambda c: c <= F.col(column)
    block = F.size(F.filter(F.lit([b[0] for b in blocks]), at_most))
    inside = F.size(F.filter(F.element_at(F.array(*[F.lit(b) for b in blocks]), F.greatest(block, F.lit(1))), at_most))
    return F.when(block == 0, 0.0).otherwise(((block - 1) * step + inside).cast("double"))


def _cut_text(df: DataFrame, by: str, descending: bool, tie: str | None, n: int, spread: bool) -> DataFrame:
    types = dict(df.dtypes)
    sample = _text_sample(df, [by, tie] if tie and tie != by else [by], n)
    cuts, frequent = _text_cuts([r[0] for r in sample], n)
    place = F.lit(float(len(cuts))) - _place(by, cuts) if descending else _place(by, cuts)
    df = df.withColumn(_RANGE, F.when(F.col(by).isNull(), float(len(cuts) + 1)).otherwise(place))
    part, fill = F.lit(0.0), F.col(by).isin(frequent)
    if frequent and tie and tie != by:
        ties = [r[1] for r in sample if r[0] in set(frequent)]
        if types[tie] == "string":
            inner = F.when(F.col(tie).isNull(), -1.0).otherwise(_place(tie, _text_cuts(ties, n)[0]))
        else:
            held = df.where(fill).select(position(tie, types[tie]).alias(_TIE))
            probs = [i / n for i in range(1, n)]
            points = sorted({p for p in held.approxQuantile(_TIE, probs, 0.25 / n) if math.isfinite(p)})
            after = F.size(F.filter(F.lit(points or [0.0]), lambda p: p <= position(tie, types[tie]))).cast("double")
            inner = F.when(F.col(tie).isNull(), -1.0).otherwise(after)
        part = F.when(fill, inner).otherwise(0.0)
    elif frequent and spread and not tie:
        row = F.pmod(F.xxhash64(*[c for c in df.columns if c != _RANGE]), F.lit(n)).cast("double")
        part = F.when(fill, row).otherwise(0.0)
    return df.withColumn(_PART, part)


def cut_ranges(
    df: DataFrame, by: str, descending: bool = False, tie: str | None = None, n: int | None = None, spread: bool = False
) -> Ranges:
    """Add ``__range`` and ``__part``; (range, part) grows with (by, tie).

    Without ``tie``, ``spread`` deals the rows of a frequent value over the parts by
    their hash: enough where rows of one value need no order among themselves.
    """
    n = n or parallelism(df.sparkSession)
    types = dict(df.dtypes)
    if types[by] == "string":
        return Ranges(_cut_text(df, by, descending, tie, n, spread), by, descending, tie)
    pos = position(by, types[by])
    if descending:
        pos = F.when(F.col(by).isNull(), F.lit(float("inf"))).otherwise(-pos)
    df = df.withColumn(_POS, pos)
    text_tie = tie is not None and types[tie] == "string"
    if tie and not text_tie:
        df = df.withColumn(_TIE, position(tie, types[tie]))
    points, frequent, ties = _cuts(df, n)
    splits = sorted(set(points) | {math.nextafter(f, math.inf) for f in frequent}) or [0.0]
    df = Bucketizer(
        splits=[-math.inf, *splits, math.inf], inputCol=_POS, outputCol=_RANGE, handleInvalid="keep"
    ).transform(df)
    if frequent and text_tie:
        held = df.where(F.col(_POS).isin(frequent))
        cuts = _text_cuts([r[0] for r in _text_sample(held, [tie], n)], n)[0]
        inner = F.when(F.col(tie).isNull(), -1.0).otherwise(_place(tie, cuts))
        df = df.withColumn(_PART, F.when(F.col(_POS).isin(frequent), inner).otherwise(0.0))
    elif frequent and ties:
        df = Bucketizer(
            splits=[-math.inf, *ties, math.inf], inputCol=_TIE, outputCol=_PART, handleInvalid="keep"
        ).transform(df)
        df = df.withColumn(_PART, F.when(F.col(_POS).isin(frequent), F.col(_PART)).otherwise(0.0))
    elif frequent and spread and not tie:
        row = F.pmod(F.xxhash64(*[c for c in df.columns if c not in (_POS, _RANGE)]), F.lit(n)).cast("double")
        df = df.withColumn(_PART, F.when(F.col(_POS).isin(frequent), row).otherwise(0.0))
    else:
        df = df.withColumn(_PART, F.lit(0.0))
    return Ranges(df.drop(_POS, _TIE), by, descending, tie)


def order_stats(
    df: DataFrame,
    by: str,
    keys: list[str] | None = None,
    descending: bool = False,
    tie: str | None = None,
    row_number: str | None = None,
    rank: str | None = None,
    dense_rank: str | None = None,
    running: dict[str, str] | None = None,
    n: int | None = None,
    settle: bool = False,
) -> DataFrame:
    """Add row number, rank, dense rank and running sums in the order of ``by``.

    ``running`` maps an output name to the column that is summed from the start
    of the group up to and including the row. ``tie`` must make the order total
    when ``row_number`` or ``running`` is asked for. Nulls sort last. Meant for
    few or large groups; a key with small groups needs no more than a window.

    The input is read three times: for the cut points, for the counts per range
    and for the ranges. ``settle`` writes it down first, which pays when it is
    more than a scan.
    """
    keys, running = keys or [], running or {}
    if settle:
        df = cut_lineage(df)
    cut = cut_ranges(df, by, descending, tie, n, spread=not (row_number or running))
    data = cut.df.withColumn(_KEY, F.struct(*keys) if keys else F.lit(0))

    local = Window.partitionBy(_KEY, _RANGE, _PART).orderBy(*cut.order)
    by_value = Window.partitionBy(_KEY, _RANGE, _PART).orderBy(cut.order[0])
    steps = {}
    if row_number:
        steps[row_number] = F.row_number().over(local)
    if rank:
        steps[rank] = F.rank().over(by_value)
    if dense_rank:
        steps[dense_rank] = F.dense_rank().over(by_value)
    for out, source in running.items():
        steps[out] = F.sum(source).over(local.rowsBetween(Window.unboundedPreceding, 0))

    sums = [F.sum(c).alias(f"__sum_{out}") for out, c in running.items()]
    values = [F.count_distinct(by).alias("__values")] if dense_rank else []
    parts = data.groupBy(_KEY, _RANGE, _PART).agg(F.count(F.lit(1)).alias("__rows"), *sums, *values)
    # One line per (group, range, part): these windows sort next to nothing.
    along = Window.partitionBy(_KEY).orderBy(_RANGE, _PART)
    before = along.rowsBetween(Window.unboundedPreceding, -1)
    below = Window.partitionBy(_KEY).orderBy(_RANGE).rangeBetween(Window.unboundedPreceding, -1)
    if dense_rank:
        # A range with several parts holds one value; count it in its first part.
        in_range = Window.partitionBy(_KEY, _RANGE).orderBy(_PART)
        parts = parts.withColumn("__values", F.when(F.row_number().over(in_range) == 1, F.col("__values")))
    added = {row_number: F.sum("__rows").over(before), rank: F.sum("__rows").over(below)}
    if dense_rank:
        added[dense_rank] = F.sum("__values").over(below)
    added.update({out: F.sum(f"__sum_{out}").over(before) for out in running})
    offsets = parts.select(
        _KEY, _RANGE, _PART, *[v.alias(f"__off_{o}") for o, v in added.items() if o in steps]
    )
    done = data.withColumns(steps).join(offsets, [_KEY, _RANGE, _PART])
    total = {o: F.col(o) + F.coalesce(F.col(f"__off_{o}"), F.lit(0)) for o in steps}
    return done.select(*df.columns, *[v.alias(o) for o, v in total.items()])


def exact_quantiles(df: DataFrame, columns: str | list[str], probs: dict[str, float]) -> DataFrame:
    """One row of linearly interpolated quantiles, exact for any number of rows.

    Values are counted first, so a frequent value travels once; the running
    count over the distinct values finds the neighbours of each position. With
    several columns the outputs are named ``column_prob``.
    """
    many = not isinstance(columns, str)
    names = list(columns) if many else [columns]
    cells = F.array(*[F.struct(F.lit(c).alias("__c"), F.col(c).cast("double").alias("__v")) for c in names])
    counts = df.select(F.inline(cells)).where("__v IS NOT NULL").groupBy("__c", "__v").agg(F.count(F.lit(1)).alias("__n"))
    seen = cut_lineage(order_stats(counts, "__v", keys=["__c"], running={"__upto": "__n"}, settle=True))
    seen = seen.join(seen.groupBy("__c").agg(F.sum("__n").alias("__total")), "__c")

    ends, out = [], []
    for c in names:
        for prob, p in probs.items():
            name = f"{c}_{prob}" if many else prob
            at = (F.col("__total") - 1) * F.lit(float(p))
            for side, place in (("lo", F.floor(at)), ("hi", F.ceil(at))):
                here = (F.col("__c") == c) & (F.col("__upto") - F.col("__n") <= place) & (F.col("__upto") > place)
                ends.append(F.max(F.when(here, F.col("__v"))).alias(f"__{side}_{name}"))
            ends.append(F.max(F.when(F.col("__c") == c, at - F.floor(at))).alias(f"__part_{name}"))
            lo, hi = F.col(f"__lo_{name}"), F.col(f"__hi_{name}")
            out.append((lo + (hi - lo) * F.col(f"__part_{name}")).alias(name))
    return seen.agg(*ends).select(*out)


def average_percent_ranks(df: DataFrame, outputs: dict[str, str]) -> DataFrame:
    """``average_percent_rank`` of several double columns at once: one counting pass for all."""
    cells = F.array(*[F.struct(F.lit(c).alias("__c"), F.col(c).alias("__v")) for c in outputs])
    counts = df.select(F.inline(cells)).where("__v IS NOT NULL").groupBy("__c", "__v").agg(F.count(F.lit(1)).alias("__n"))
    seen = cut_lineage(order_stats(counts, "__v", keys=["__c"], running={"__upto": "__n"}, settle=True))
    seen = seen.join(seen.groupBy("__c").agg(F.sum("__n").alias("__total")), "__c")
    mean_rank = F.col("__upto") - F.col("__n") + (F.col("__n") + 1) / F.lit(2.0)
    for column, out in outputs.items():
        shares = seen.where(F.col("__c") == column).select(F.col("__v").alias(column), (mean_rank / F.col("__total")).alias(out))
        df = df.join(shares, column, "left").withColumn(out, F.coalesce(out, F.lit(0.0)))
    return df


def average_percent_rank(df: DataFrame, column: str, out: str) -> DataFrame:
    """Percent rank where ties share their mean rank; null values get 0."""
    counts = df.where(F.col(column).isNotNull()).groupBy(column).agg(F.count(F.lit(1)).alias("__n"))
    seen = cut_lineage(order_stats(counts, column, running={"__upto": "__n"}, settle=True))
    total = seen.agg(F.sum("__n")).scalar()
    mean_rank = F.col("__upto") - F.col("__n") + (F.col("__n") + 1) / F.lit(2.0)
    shares = seen.select(F.col(column), (mean_rank / total).alias(out))
    return df.join(shares, column, "left").select(*df.columns, F.coalesce(out, F.lit(0.0)).alias(out))
