"""Hard negatives by exact inner-product search with coordinate pruning.

Distinct vectors are ordered by length and cut into buckets. A bucket holds, for every
coordinate, its vectors ordered by that coordinate's share of their length. An anchor
that looks for scores of at least t turns t into an angle for the bucket's longest
vector; within that angle each of the anchor's largest coordinates, its focus, allows a
range of values, which is one run of the ordered list. Only vectors in the runs of all
focus coordinates are multiplied out. t rises as good scores are found, and buckets too
short to reach it are passed over. All bounds are necessary conditions, so nothing is
lost.

Buckets are dealt over stripes that a task holds at once; the anchors, in batches, pass
through every stripe.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, Window, functions as F
from pyspark.sql.pandas.types import to_arrow_schema

from tidemill.session import cut_lineage, parallelism

#: Vectors of a bucket, and vectors that a task holds at once (some 400 bytes each at 64 dimensions).
BUCKET, STRIPE = 2048, 1 << 17
#: Coordinates of an anchor whose ranges are intersected.
FOCUS = 4
#: Slack of the floating-point bounds; scores themselves are exact.
SLACK = 1e-9
#: An anchor vector with more than one in so many anchor rows is joined by broadcast; there are fewer than this.
SHARES = 2000

INDEX_COLUMNS = ("longest", "labels", "ids", "matrix", "orders")
INDEX = "longest double, labels binary, ids array<array<long>>, matrix binary, orders binary"


class Bucket:
    """Vectors of similar length with a list per coordinate, ordered by value over length."""

    def __init__(self, longest: float, labels: bytes, ids: list, matrix: bytes, orders: bytes, exact: np.dtype) -> None:
        self.longest, self.ids = longest, ids
        self.labels = np.frombuffer(labels, np.int64)
        n = len(self.labels)
        self.vectors = np.frombuffer(matrix, np.int32).reshape(n, -1).astype(exact)
        self.orders = np.frombuffer(orders, np.int16).reshape(-1, n)
        lengths = np.linalg.norm(self.vectors.astype(np.float64), axis=1)
        self.unit = self.vectors / np.where(lengths > 0, lengths, 1)[:, None]
        self.lists = np.take_along_axis(self.unit.T, self.orders, axis=1)

    def near(self, anchor: Anchor, least: float) -> np.ndarray | None:
        """Vectors that may score ``least`` or more with the anchor; None for all of them."""
        if least <= 0 or anchor.length == 0:
            return None
        reach = least / (anchor.length * self.longest) if self.longest else np.inf
        if reach > 1 + SLACK:
            return np.empty(0, np.int64)
        angle = np.arccos(min(1.0, reach)) + SLACK
        lows = np.cos(np.minimum(np.pi, anchor.angles + angle)) - SLACK
        highs = np.cos(np.maximum(0.0, anchor.angles - angle)) + SLACK
        runs = []
        for f, low, high in zip(anchor.focus, lows, highs):
            ordered = self.lists[f]
            runs.append((np.searchsorted(ordered, low, "left"), np.searchsorted(ordered, high, "right")))
        best = min(range(len(runs)), key=lambda i: runs[i][1] - runs[i][0])
        found = self.orders[anchor.focus[best], runs[best][0] : runs[best][1]].astype(np.int64)
        for i, f in enumerate(anchor.focus):
            if i != best and len(found):
                values = self.unit[found, f]
                found = found[(values >= lows[i]) & (values <= highs[i])]
        return found

    def scores(self, anchor: Anchor, least: float, same: bool) -> tuple[np.ndarray, np.ndarray]:
        """(places, scores) of the vectors with the anchor's label, or with another, that score ``least`` or more."""
        places = self.near(anchor, least)
        fits = (self.labels if places is None else self.labels[places]) == anchor.label
        fits = fits if same else ~fits
        places = np.flatnonzero(fits) if places is None else places[fits]
        found = (self.vectors[places] @ anchor.vector).astype(np.int64)
        good = found >= least
        return places[good], found[good]

    def rows(self, places: np.ndarray, scores: np.ndarray) -> list[tuple[int, int]]:
        """(-score, id) of every row behind the vectors."""
        return [(-s, i) for p, s in zip(places.tolist(), scores.tolist()) for i in self.ids[p]]


class Anchor:
    """A vector to search with. ``windows`` are the score ranges (low, high) wanted, highest rows first."""

    def __init__(self, key: bytes, label: int, vector: np.ndarray, windows: list[tuple[float, float]], same: bool, k: int) -> None:
        self.key, self.label, self.vector, self.same, self.k = key, label, vector, same, k
        self.length = float(np.linalg.norm(vector.astype(np.float64)))
        unit = vector / self.length if self.length else vector.astype(np.float64)
        self.focus = np.argsort(-np.abs(unit), kind="stable")[:FOCUS]
        self.angles = np.arccos(np.clip(unit[self.focus], -1, 1))
        self.windows = [[low, high, []] for low, high in windows]

    def search(self, bucket: Bucket) -> None:
        least = min((w[0] for w in self.windows), default=np.inf)
        if least == np.inf:
            return
        places, scores = bucket.scores(self, least, self.same)
        for window in self.windows:
            low, high, held = window
            inside = (scores >= low) & (scores <= high)
            if inside.any():
                chosen, values = places[inside], scores[inside]
                if len(values) > self.k:  # rows below the k-th vector's score cannot be among the first k
                    top = values >= np.partition(values, -self.k)[-self.k]
                    chosen, values = chosen[top], values[top]
                held = sorted(held + bucket.rows(chosen, values))[: self.k]
                window[2] = held
                if len(held) == self.k:
                    window[0] = max(low, -held[-1][0])


def _builder(stripes: int, schema) -> Callable:
    """Buckets of the partition's vectors, which come longest first, dealt over the stripes."""
    arrow = to_arrow_schema(schema)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        part, held, number = TaskContext.get().partitionId(), [], 0

        def bucket(table: pa.Table) -> pa.RecordBatch:
            matrix = np.array(table["vec"].to_pylist(), dtype=np.int32).reshape(table.num_rows, -1)
            lengths = np.linalg.norm(matrix.astype(np.float64), axis=1)
            unit = matrix / np.where(lengths > 0, lengths, 1)[:, None]
            orders = np.argsort(unit.T, axis=1, kind="stable").astype(np.int16)
            labels = np.array(table["label"].to_pylist(), dtype=np.int64)
            row = {
                "stripe": (part + number) % stripes, "kind": 0, "longest": float(lengths.max()), "labels": labels.tobytes(),
                "ids": table["ids"].to_pylist(), "matrix": matrix.tobytes(), "orders": orders.tobytes(),
            }
            return pa.RecordBatch.from_pylist([row], arrow)

        for batch in batches:
            held.append(batch)
            while sum(b.num_rows for b in held) >= BUCKET:
                table = pa.Table.from_batches(held)
                yield bucket(table.slice(0, BUCKET))
                number += 1
                held = table.slice(BUCKET).to_batches()
        if sum(b.num_rows for b in held):
            yield bucket(pa.Table.from_batches(held))

    return run


def _searcher(same: bool, k: int, exact: str, schema) -> Callable:
    """Rows (key, positive_score, score, id): per anchor and window, the first k rows of the stripe."""
    arrow = to_arrow_schema(schema)
    kind = np.dtype(exact)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        buckets: list[Bucket] = []
        stripe = None
        for batch in batches:
            for at in range(0, batch.num_rows, 256):
                rows = batch.slice(at, 256).to_pylist()
                anchors = []
                for r in rows:
                    if r["stripe"] != stripe:
                        stripe, buckets = r["stripe"], []
                    if r["kind"] == 0:
                        buckets.append(Bucket(r["longest"], r["labels"], r["ids"], r["matrix"], r["orders"], kind))
                    else:
                        windows = [(-np.inf, np.inf)] if same else [(-(-80 * s // 100), s) for s in r["positives"]]
                        anchors.append((r, Anchor(r["key"], r["label"], np.array(r["vec"], dtype=kind), windows, same, k)))
                if not anchors:
                    continue
                for bucket in buckets:
                    for _, anchor in anchors:
                        anchor.search(bucket)
                out = [
                    {"key": r["key"], "positive_score": None if same else r["positives"][i], "score": -less, "id": who}
                    for r, anchor in anchors for i, window in enumerate(anchor.windows) for less, who in window[2]
                ]
                yield pa.RecordBatch.from_pylist(out, arrow)

    return run


def _key() -> Column:
    return F.unhex(F.sha2(F.concat_ws(",", F.col("label").cast("string"), F.col("vec").cast("array<string>")), 256))


def _first(rows: DataFrame, k: int, *group: str) -> DataFrame:
    """The first k rows of each group by score and id; Spark cuts the groups before it shuffles them."""
    place = F.row_number().over(Window.partitionBy(*group).orderBy(F.col("score").desc(), "id"))
    return rows.withColumn("place", place).where(F.col("place") <= k)


def mine(rows: DataFrame, anchor: Column, positives: int = 5, negatives: int = 5, key: str = "vec_id", vector: str = "vector", label: str = "label") -> DataFrame:
    """Rows (anchor_id, positive_id, rank, negative_id, positive_score, negative_score).

    ``vector`` is an array of whole numbers, ``label`` a whole number, ``anchor`` a
    condition on the columns of ``rows``. A score is the inner product with the anchor;
    higher scores come first, ties by smaller id. An anchor's positives are the first
    ``positives`` other rows of its label; per positive, the first ``negatives`` rows of
    other labels with a score from 80 to 100 per cent of the positive's are returned, so
    none for a positive with a negative score.

    Rows with a null id, label, vector or component take no part. Missing components of a
    shorter vector count as 0. Repeated rows count once; an anchor is never its own
    positive. Equal vectors of one label are one vector with its first ids, whatever their
    number. An empty table gives an empty table; other columns are not looked at. Vectors
    whose scores would pass 64 bits raise a ValueError.
    """
    spark, k = rows.sparkSession, positives + 1
    clean = rows.where(F.col(key).isNotNull() & F.col(label).isNotNull() & F.col(vector).isNotNull() & ~F.exists(vector, F.isnull))
    clean = clean.select(
        F.col(key).cast("long").alias("id"), F.col(label).cast("long").alias("label"), F.col(vector).cast("array<long>").alias("vec"),
        F.coalesce(anchor, F.lit(False)).alias("anchor"),
    )
    square = F.aggregate("vec", F.lit(0.0), lambda s, x: s + x.cast("double") * x.cast("double"))
    clean = cut_lineage(clean.withColumn("key", _key()).withColumn("square", square))
    size = clean.agg(F.max(F.size("vec")).alias("wide"), F.max("square").alias("square"), F.count(F.lit(1)).alias("n")).first()
    wide, exact = size["wide"] or 0, "int64" if (size["square"] or 0) >= 2**52 else "float64"
    if (size["square"] or 0) >= 2**62:
        raise ValueError("scores of these vectors do not fit 64 bits")
    vec = F.transform(F.concat("vec", F.array_repeat(F.lit(0).cast("long"), F.lit(wide) - F.size("vec"))), lambda x: x.cast("int")).alias("vec")

    # Of equal vectors only the first ids can be among the first rows of any anchor.
    place = F.row_number().over(Window.partitionBy("key").orderBy("id"))
    some = clean.select("key", "id").distinct().withColumn("place", place).where(F.col("place") <= max(k, negatives))
    ids = some.groupBy("key").agg(F.sort_array(F.collect_list("id")).alias("ids"))
    distinct = clean.groupBy("key").agg(F.first("label").alias("label"), F.first("vec").alias("vec"), F.first("square").alias("square")).join(ids, "key")
    stripes = max(parallelism(spark), -(-size["n"] // STRIPE))
    ordered = distinct.select("label", vec, "ids", "square").repartitionByRange(stripes, F.col("square").desc(), F.col("ids")[0])
    schema = spark.createDataFrame([], f"stripe int, kind int, {INDEX}").schema
    buckets = cut_lineage(
        ordered.sortWithinPartitions(F.col("square").desc(), F.col("ids")[0]).select("label", "vec", "ids").mapInArrow(_builder(stripes, schema), schema)
    )

    asked = clean.where("anchor").select("key", "id", "label", "vec").dropDuplicates(["key", "id"])
    asked = cut_lineage(asked)
    anchors = cut_lineage(asked.groupBy("key").agg(F.first("label").alias("label"), F.first("vec").alias("vec"), F.count(F.lit(1)).alias("copies")).select("key", "label", vec, "copies"))

    def search(queries: DataFrame, same: bool, count: int) -> DataFrame:
        out = spark.createDataFrame([], "key binary, positive_score long, score long, id long").schema
        nothing = [F.lit(None).cast(t).alias(c) for c, t in (("key", "binary"), ("label", "long"), ("vec", "array<int>"), ("positives", "array<long>"))]
        held = buckets.select("stripe", "kind", *INDEX_COLUMNS, *nothing)
        empty = [F.lit(None).cast(buckets.schema[c].dataType).alias(c) for c in INDEX_COLUMNS]
        sent = queries.select(F.explode(F.sequence(F.lit(0), F.lit(stripes - 1))).alias("stripe"), F.lit(1).alias("kind"), *empty, "key", "label", "vec", "positives")
        dealt = held.unionByName(sent).repartitionById(stripes, F.col("stripe"))
        found = dealt.sortWithinPartitions("stripe", "kind", F.col("longest").desc()).mapInArrow(_searcher(same, count, exact, out), out)
        return cut_lineage(_first(found, count, "key", "positive_score"))

    elements = F.sort_array(F.collect_list(F.struct((-F.col("score")).alias("less"), "id")))
    near = search(anchors.withColumn("positives", F.lit(None).cast("array<long>")), True, k).groupBy("key").agg(elements.alias("near"))
    near = cut_lineage(near)
    levels = F.array_distinct(F.transform("near", lambda e: -e["less"]))
    against = search(anchors.join(near.select("key", levels.alias("positives")), "key"), False, negatives)
    against = against.groupBy("key", "positive_score").agg(elements.alias("rows"))
    against = against.groupBy("key").agg(F.map_from_entries(F.collect_list(F.struct("positive_score", "rows"))).alias("negatives"))
    found = cut_lineage(anchors.select("key", "copies").join(near, "key").join(against, "key"))

    # Anchor rows that share a vector with many others do not meet in one task.
    large = F.col("copies") * SHARES > (anchors.agg(F.sum("copies")).first()[0] or 0)
    hot = F.broadcast(found.where(large))
    joined = asked.select("key", F.col("id").alias("anchor_id"))
    joined = joined.join(hot, "key").unionByName(joined.join(hot, "key", "left_anti").join(found.where(~large), "key"))
    others = F.slice(F.filter("near", lambda e: e["id"] != F.col("anchor_id")), 1, positives)
    pairs = joined.select("anchor_id", "negatives", F.explode(others).alias("p"))
    pairs = pairs.select("anchor_id", F.col("p.id").alias("positive_id"), (-F.col("p.less")).alias("positive_score"), "negatives")
    ranked = pairs.select("anchor_id", "positive_id", "positive_score", F.posexplode(F.try_element_at("negatives", "positive_score")).alias("at", "n"))
    return ranked.select(
        "anchor_id", "positive_id", (F.col("at") + 1).cast("int").alias("rank"), F.col("n.id").alias("negative_id"), "positive_score",
        (-F.col("n.less")).alias("negative_score"),
    )
