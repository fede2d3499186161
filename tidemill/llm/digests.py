"""Exact duplicates against a persistent index of text digests.

The index is a table of one row per distinct text, bucketed and sorted by digest, in a
folder that all executors share. A new batch is reduced to one row per digest, what the
index lacks is found by a sort-merge anti-join that reads the index bucket by bucket
without a shuffle, and that is appended. A row is a duplicate if the index names another
row for its digest.
"""

from __future__ import annotations

import hashlib

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from tidemill.session import cut_lineage

#: Fixed value: the characters that do not count when texts are compared.
BLANKS = r"[\x20\x09-\x0D]+"
#: A digest with more than one in so many rows of a batch is looked up by broadcast; there are fewer than this.
SHARES = 2000


def digest(text: str | Column) -> Column:
    """SHA-256 of the text without its blanks, 32 bytes; a null text counts as empty."""
    column = F.col(text) if isinstance(text, str) else text
    return F.unhex(F.sha2(F.regexp_replace(F.coalesce(column, F.lit("")), BLANKS, ""), 256))


class DigestIndex:
    """Index of the texts seen so far, kept below ``folder`` in ``buckets`` buckets.

    The same folder opened later, by another session too, continues the index. It must be
    opened with the number of buckets it was made with; the folder's name holds it, so
    another number is another, empty index. ``key_type`` is the type of the ids.
    One writer at a time.
    """

    def __init__(self, spark: SparkSession, folder: str, buckets: int = 64, key_type: str = "bigint") -> None:
        self.spark, self.buckets = spark, buckets
        self.path = f"{folder.rstrip('/')}/digests-{buckets}"
        self.table = "digest_index_" + hashlib.md5(self.path.encode()).hexdigest()
        spark.sql(
            f"CREATE TABLE IF NOT EXISTS {self.table} (digest BINARY, keep_id {key_type}, keep_row BIGINT, n_chars INT, batch STRING) "
            f"USING parquet CLUSTERED BY (digest) SORTED BY (digest) INTO {buckets} BUCKETS LOCATION '{self.path}'"
        )

    def read(self) -> DataFrame:
        """Rows (digest, keep_id, keep_row, n_chars, batch), one per distinct text."""
        self.spark.catalog.refreshTable(self.table)
        return self.spark.table(self.table)

    def append(self, groups: DataFrame) -> None:
        """Adds the digests of ``groups`` (the columns of the table) that the index lacks; one file per bucket and call."""
        known = self.read().select("digest").hint("merge")
        fresh = groups.join(known, "digest", "left_anti").select("digest", "keep_id", "keep_row", "n_chars", "batch")
        fresh.repartition(self.buckets, "digest").write.insertInto(self.table)

    def compact(self, folder: str) -> DigestIndex:
        """A copy of the index below ``folder`` with one sorted file per bucket, for when appends have left many."""
        kind = dict(self.read().dtypes)["keep_id"]
        copy = DigestIndex(self.spark, folder, self.buckets, kind)
        copy.append(self.read())
        return copy

    def add(self, docs: DataFrame, batch: str, key: str = "doc_id", text: str = "text") -> DataFrame:
        """Adds a batch and returns one row (id, digest, keep_id, group_size, kept, row) per row of ``docs``.

        Of equal texts within the batch the row with the most code points in its whole
        original text stays, then the one with the smallest id. A text that an earlier
        batch brought keeps that batch's row, and all of this batch's rows go; ``keep_id``
        names the row that stays in either case. ``group_size`` counts the rows of this
        batch with the text. The same ``batch`` added again, after a failure, finds its own
        entries and gives the same answer.

        Null, empty and blank texts are one group. Rows without an id come last among
        equals, so ``keep_id`` is null only if no id is known. Of repeated rows with one
        id exactly one is kept. Texts of any length are read whole. An empty table gives
        an empty table; no column but key and text is looked at.
        """
        rows = docs.select(
            F.col(key).alias("id"), digest(text).alias("digest"), F.length(F.coalesce(F.col(text), F.lit(""))).alias("n_chars"),
        )
        # Written down, so that row numbers are the same wherever they are read.
        rows = cut_lineage(rows.withColumn("row", F.monotonically_increasing_id()))
        order = F.struct((-F.col("n_chars")).alias("less"), F.col("id").isNull().alias("unknown"), "id", "row")
        groups = rows.groupBy("digest").agg(F.min(order).alias("best"), F.count(F.lit(1)).alias("group_size"))
        groups = cut_lineage(
            groups.select(
                "digest", F.col("best.id").alias("keep_id"), F.col("best.row").alias("keep_row"), (-F.col("best.less")).alias("n_chars"),
                F.lit(batch).alias("batch"), "group_size",
            )
        )
        self.append(groups)
        index = self.read().select("digest", "keep_id", "keep_row", (F.col("batch") == batch).alias("own")).hint("merge")
        named = cut_lineage(groups.select("digest", "group_size").join(index, "digest"))
        return self._label(rows, named)

    @staticmethod
    def _label(rows: DataFrame, named: DataFrame) -> DataFrame:
        """The index entry of each row. Digests with many rows, of which there are few, do not meet in one task."""
        total = named.agg(F.sum("group_size")).first()[0] or 0
        large = F.col("group_size") * SHARES > total
        hot = F.broadcast(named.where(large))
        rest = rows.join(hot, "digest", "left_anti").join(named.where(~large), "digest")
        found = rows.join(hot, "digest").unionByName(rest)
        return found.select("id", "digest", "keep_id", "group_size", (F.col("own") & (F.col("row") == F.col("keep_row"))).alias("kept"), "row")


def deduplicate(docs: DataFrame, index: DigestIndex, batch: str, key: str = "doc_id", text: str = "text") -> DataFrame:
    """The rows of ``docs`` whose text is new to the index, one per distinct text, with their columns.

    Handles what :meth:`DigestIndex.add` handles. Copies are told apart by id and number
    of code points; rows that share id, text and length are one row here.
    """
    verdicts = index.add(docs, batch, key, text).where("kept").select("digest", "id")
    marked = docs.withColumn("__digest", digest(text)).withColumn("__id", F.col(key))
    marked = marked.withColumn("__chars", F.length(F.coalesce(F.col(text), F.lit(""))))
    # Only rows that carry a kept id meet here: one per text, and its repeats.
    kept = verdicts.select(F.col("digest").alias("__d"), F.col("id").alias("__k"))
    same = (F.col("__digest") == F.col("__d")) & F.col("__id").eqNullSafe(F.col("__k"))
    some = marked.join(kept, same, "left_semi")
    best = some.groupBy("__digest").agg(F.max_by(F.struct(*docs.columns), "__chars").alias("doc"))
    return best.select("doc.*")
