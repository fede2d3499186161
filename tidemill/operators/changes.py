"""Change capture: hashes, classification, SCD merges, upserts and window reloads."""

from __future__ import annotations

import datetime
from collections.abc import Iterator, Sequence
from contextlib import contextmanager

from pyspark import StorageLevel
from pyspark.sql import Column, DataFrame, functions as F

from tidemill.operators.columns import drop_audit
from tidemill.session import scratch_path

NULL_MARK = "\\N"


def row_hash(columns: Sequence[str], legacy: bool = False) -> Column:
    """SHA-256 of the values in the order of the lower-cased names.

    By default a null has its own mark, which no value can give because ``|`` and
    the backslash are escaped in values, and the result is the 32-byte digest.
    ``legacy`` skips nulls and gives the hex text as bytes, as older tables
    hold it; there ``(a, null)`` and ``(null, a)`` collide.
    """
    texts = [F.col(c).cast("string") for c in sorted(columns, key=str.lower)]
    if legacy:
        return F.sha2(F.concat_ws("|", *texts), 256).cast("binary")
    escaped = [F.replace(F.replace(t, F.lit("\\"), F.lit("\\\\")), F.lit("|"), F.lit("\\|")) for t in texts]
    return F.unhex(F.sha2(F.concat_ws("|", *[F.coalesce(t, F.lit(NULL_MARK)) for t in escaped]), 256))


def _hash_or_null(columns: Sequence[str], legacy: bool) -> Column:
    return row_hash(columns, legacy) if columns else F.lit(None).cast("binary")


def _time_or_null(df: DataFrame, column: str | None) -> Column:
    return F.col(column).try_cast("timestamp_ntz") if column in df.columns else F.lit(None).cast("timestamp_ntz")


def dimension_audit(
    df: DataFrame,
    keys: Sequence[str],
    run_ts: str,
    overwritten: Sequence[str] = (),
    created: str | None = None,
    modified: str | None = None,
    legacy: bool = False,
) -> DataFrame:
    """Key hash, hash of overwritten (type 1) and of versioned (type 2) columns, flags and times."""
    apart = {*keys, *overwritten, created, modified}
    versioned = [c for c in drop_audit(df).columns if c not in apart]
    return df.withColumns(
        {
            "__BusinessKeyHash": row_hash(keys, legacy),
            "__Type1Hash": _hash_or_null(overwritten, legacy),
            "__Type2Hash": _hash_or_null(versioned, legacy),
            "__DeletedFlag": F.lit(False),
            "__CreateDateTime": F.lit(run_ts).cast("timestamp_ntz"),
            "__DataCreationDateTime": _time_or_null(df, created),
            "__DataModificationDateTime": _time_or_null(df, modified),
        }
    )


def fact_audit(df: DataFrame, keys: Sequence[str], run_ts: str, legacy: bool = False) -> DataFrame:
    return df.withColumns(
        {
            "__FactKeyHash": row_hash(keys, legacy),
            "__DeletedFlag": F.lit(False),
            "__CreateDateTime": F.lit(run_ts).cast("timestamp_ntz"),
        }
    )


def classify(source: DataFrame, target: DataFrame, keys: Sequence[str], with_deleted: bool = False) -> DataFrame:
    """Change type of every source row against the target; both carry audit hashes.

    A type 1 change hides a type 2 change. Rows only the target has appear as
    ``deleted`` when asked for.
    """
    marks = target.select(
        *keys, F.col("__Type1Hash").alias("__t1"), F.col("__Type2Hash").alias("__t2"), F.lit(True).alias("__known")
    )
    rows = source.withColumn("__new", F.lit(True)).join(marks, list(keys), "full" if with_deleted else "left")
    kind = (
        F.when(F.col("__new").isNull(), "deleted")
        .when(F.col("__known").isNull(), "new")
        .when(~F.col("__Type1Hash").eqNullSafe(F.col("__t1")), "type_i_changed")
        .when(~F.col("__Type2Hash").eqNullSafe(F.col("__t2")), "type_ii_changed")
        .otherwise("unchanged")
    )
    return rows.withColumn("change_type", kind).drop("__t1", "__t2", "__known", "__new")


def upsert(target: DataFrame, batch: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Target with the batch laid over it: batch rows win, all other rows stay (SCD type 1).

    The batch must have one row per key. The anti join sees only the batch's keys, so
    a small batch is broadcast and the target is not shuffled. Where the table format
    has MERGE, use that; on plain files write the result as a new version.
    """
    kept = target.join(batch.select(*keys), list(keys), "left_anti").select(*target.columns)
    return kept.unionByName(batch.select(*target.columns))


def scd2_open(df: DataFrame, as_of: str) -> DataFrame:
    """First load of a versioned dimension: every row valid from ``as_of``."""
    return df.withColumns(
        {"valid_from": F.lit(as_of).cast("date"), "valid_to": F.lit(None).cast("date"), "is_current": F.lit(True)}
    )


def scd2_merge(
    dimension: DataFrame, batch: DataFrame, keys: Sequence[str], overwritten: Sequence[str], as_of: str
) -> DataFrame:
    """Apply a batch to a versioned dimension, validity half-open.

    A change in an overwritten column replaces the value in the current row; a
    change in any other column closes the current row and opens a new one.
    History and rows the batch lacks stay. The same batch again changes
    nothing. The batch must have one row per key.

    Only the current rows of the batch's keys are merged. They are found by a semi
    join, all others pass by an anti join; both see only the keys of the batch, so a
    small batch is broadcast and the dimension is not shuffled. A changed key gives
    two rows of one array.
    """
    data = [c for c in batch.columns if c not in keys]
    versioned = [c for c in data if c not in overwritten]
    named = batch.select(*keys)
    rest = dimension.join(named.withColumn("is_current", F.lit(True)), [*keys, "is_current"], "left_anti").select(*dimension.columns)
    touched = dimension.where("is_current").join(named, list(keys), "left_semi").select(*keys, F.struct(*data, "valid_from").alias("__old"))
    both = batch.select(*keys, F.struct(*data).alias("__new")).join(touched, list(keys), "left")

    def version(values: str, took: Sequence[str], valid_from: Column, valid_to: Column, current: bool) -> Column:
        return F.struct(
            *[F.col(f"{'__new' if c in took else values}.{c}").alias(c) for c in data],
            valid_from.cast("date").alias("valid_from"),
            valid_to.cast("date").alias("valid_to"),
            F.lit(current).alias("is_current"),
        )

    old_from, start, never = F.col("__old.valid_from"), F.lit(as_of), F.lit(None)
    changed = ~F.struct(*[F.col(f"__old.{c}") for c in versioned]).eqNullSafe(
        F.struct(*[F.col(f"__new.{c}") for c in versioned])
    )
    opened = version("__new", (), start, never, True)
    rows = (
        F.when(F.col("__old").isNull(), F.array(opened))
        .when(changed, F.array(version("__old", (), old_from, start, False), opened))
        .otherwise(F.array(version("__old", overwritten, old_from, never, True)))
    )
    return both.select(*keys, F.inline(rows)).unionByName(rest).select(*dimension.columns)


def replace_window(target: DataFrame, batch: DataFrame, column: str, start: object) -> DataFrame:
    """Drop target rows at or after ``start`` and add the batch; running it twice changes nothing."""
    return target.where(F.col(column) < start).unionByName(batch)


def overwrite_partitions(df: DataFrame, path: str, partition: str) -> None:
    """Replace exactly the partitions the frame has; the others are not read or written.

    Rows of a partition value go together into tasks of even size, so a large value has several.
    """
    df.hint("rebalance", partition).write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy(
        partition
    ).parquet(path)


def write_version(df: DataFrame, name: str) -> str:
    """Write to a new path, so a table is never overwritten while it is read."""
    path = scratch_path(df.sparkSession, name)
    df.write.parquet(path)
    return path


def lookback(end_day: str, days: int) -> tuple[str, str, str]:
    """Start day (yyyyMMdd), start month (yyyy-MM) and start quarter of a look-back window."""
    start = datetime.datetime.strptime(end_day, "%Y%m%d") - datetime.timedelta(days=days)
    return start.strftime("%Y%m%d"), start.strftime("%Y-%m"), quarter_of(start.strftime("%Y-%m"))


def quarter_of(year_month: str) -> str:
    """``2024-08`` -> ``2024 Q3``."""
    month = datetime.datetime.strptime(year_month, "%Y-%m")
    return f"{month.year} Q{(month.month + 2) // 3}"


@contextmanager
def persisted(df: DataFrame) -> Iterator[DataFrame]:
    """Keep a frame that is read more than once, release it afterwards."""
    kept = df.persist(StorageLevel.MEMORY_AND_DISK)
    try:
        yield kept
    finally:
        kept.unpersist()
