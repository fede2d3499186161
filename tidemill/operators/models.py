"""Clustering, batch scoring and lead selection."""

from __future__ import annotations

from collections.abc import Iterator, Sequence

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, functions as F
from pyspark.sql.types import DoubleType

from tidemill.functions.columns import rounded
from tidemill.functions.labels import first_match
from tidemill.operators.ordered import average_percent_ranks, order_stats
from tidemill.session import cut_lineage


#: Places of the sorted values that the driver looks at in one round, at most.
MARKS = 2048
#: Cuts whose costs differ by less than this share of the total cost are equal; the lowest win.
EQUAL = 1e-11


def _cost(low: np.ndarray, high: np.ndarray) -> np.ndarray:
    """Squared distances from the mean of the values between two places, from running (count, sum, sum of squares)."""
    n, s, q = (high - low).T
    return np.where(n > 0, np.maximum(q - s * s / np.where(n > 0, n, 1), 0.0), 0.0)


def _best_cuts(marks: np.ndarray, k: int, slack: float) -> tuple[float, list[int]]:
    """Least cost of k segments that end at marks, and the lowest marks that reach it."""
    m = len(marks)
    rest = [_cost(marks, np.broadcast_to(marks[-1], marks.shape))]
    for _ in range(k - 1):
        after = rest[-1]
        rest.append(np.array([np.inf if i == m - 1 else (_cost(np.broadcast_to(marks[i], (m - i - 1, 3)), marks[i + 1 :]) + after[i + 1 :]).min() for i in range(m)]))
    at, cuts, spent = 0, [], 0.0
    for left in range(k - 1, 0, -1):
        step = _cost(np.broadcast_to(marks[at], (m - at - 1, 3)), marks[at + 1 :])
        total = spent + step + rest[left - 1][at + 1 :]
        chosen = int(np.flatnonzero(total <= rest[k - 1][0] + slack)[0])
        spent += step[chosen]
        at += chosen + 1
        cuts.append(at)
    return float(rest[k - 1][0]), cuts


def _possible(marks: np.ndarray, k: int, best: float) -> np.ndarray:
    """For each block between neighbouring marks, whether one of the cuts may lie in it.

    The values inside the blocks that hold cuts are left out of the bound, so it never
    exceeds the cost of any way to cut there.
    """
    low, high = marks[:-1], marks[1:]
    m = len(low)
    before = [_cost(np.broadcast_to(marks[0], low.shape), low)]
    after = [_cost(high, np.broadcast_to(marks[-1], high.shape))]
    for _ in range(k - 2):
        grown = before[-1].copy()  # the cut before lies in the same block
        for b in range(1, m):
            grown[b] = min(grown[b], (before[-1][:b] + _cost(high[:b], np.broadcast_to(low[b], (b, 3)))).min())
        before.append(grown)
        grown = after[-1].copy()
        for b in range(m - 1):
            grown[b] = min(grown[b], (after[-1][b + 1 :] + _cost(np.broadcast_to(high[b], (m - b - 1, 3)), low[b + 1 :])).min())
        after.append(grown)
    return np.any([x + y <= best for x, y in zip(before, reversed(after))], axis=0)


def least_cost_cuts(df: DataFrame, column: str, k: int) -> list[float]:
    """The last value of each but the last of the k intervals with the least sum of squared distances from their means.

    Exact for any number of values. Running counts and sums over the sorted distinct
    values give the cost of any interval. The driver sees these sums at a bounded number
    of places, finds the blocks between them in which no best cut can lie, and looks
    closer at the others, until each holds one value. With fewer distinct values than k
    every value is an interval.
    """
    if k < 2:
        return []
    centre = df.agg(F.avg(column)).first()[0] or 0.0
    x = F.col(column).cast("double") - F.lit(float(centre))
    counts = df.where(F.col(column).isNotNull()).groupBy(F.col(column).cast("double").alias("value")).agg(
        F.count(F.lit(1)).cast("double").alias("n"), F.sum(x).alias("s"), F.sum(x * x).alias("q")
    )
    sums = cut_lineage(order_stats(counts, "value", tie="value", row_number="place", running={"un": "n", "us": "s", "uq": "q"}, settle=True))
    m = sums.count()
    if m <= k:
        return [r["value"] for r in sums.orderBy("value").collect()][: max(m - 1, 0)]

    def at(places: list[int]) -> np.ndarray:
        held = {r["place"]: (r["un"], r["us"], r["uq"]) for r in sums.where(F.col("place").isin(places)).collect()}
        return np.array([held.get(p, (0.0, 0.0, 0.0)) for p in places])

    step = max(1, m * 2 // MARKS)
    places = sorted({0, m, *range(step, m, step)})
    while True:
        marks = at(places)
        slack = EQUAL * float(_cost(marks[:1], marks[-1:])[0])
        best, cuts = _best_cuts(marks, k, slack) if len(places) > k else (np.inf, [])
        open_ = [(a, b) for a, b, may in zip(places, places[1:], _possible(marks, k, best + slack)) if may]
        wide = [(a, b) for a, b in open_ if b - a > 1]
        if not wide:
            ends = [places[c] for c in cuts]
            return [r["value"] for r in sums.where(F.col("place").isin(ends)).orderBy("place").collect()]
        parts = max(2, MARKS // (2 * len(wide)))
        finer = {a + (b - a) * i // parts for a, b in wide for i in range(parts + 1)}
        places = sorted({0, m, *(places[c] for c in cuts), *(p for ab in open_ for p in ab), *finer})


def named_clusters(df: DataFrame, column: str, names: Sequence[str], out: str) -> DataFrame:
    """Least-squares clusters of one column; they carry the names in the order of their means. Nulls are left out."""
    known = df.where(F.col(column).isNotNull())
    ends = least_cost_cuts(known, column, len(names))
    label = first_match([(F.col(column).cast("double") <= F.lit(e), name) for e, name in zip(ends, names)], names[len(ends)])
    return known.withColumn(out, label)


def logistic(weights: dict[str, float], intercept: float) -> dict:
    """A saved model as plain numbers: feature weights and an intercept."""
    return {"weights": dict(weights), "intercept": float(intercept)}


def score(df: DataFrame, model: dict, out: str = "probability") -> DataFrame:
    """Probability per row, computed on Arrow batches with the model shipped to the tasks.

    The function is self-contained, so any model object with a vectorised
    predict can take its place. Missing features count as 0.
    """
    names, weights, intercept = list(model["weights"]), list(model["weights"].values()), model["intercept"]

    def predict(batches: Iterator[tuple[pd.Series, ...]]) -> Iterator[pd.Series]:
        import numpy

        for columns in batches:
            x = numpy.column_stack([c.fillna(0.0).to_numpy(dtype="float64") for c in columns])
            yield pd.Series(1.0 / (1.0 + numpy.exp(-(x @ numpy.asarray(weights) + intercept))))

    return df.withColumn(out, F.pandas_udf(predict, DoubleType())(*[F.col(n).cast("double") for n in names]))


def score_native(df: DataFrame, model: dict, out: str = "probability") -> DataFrame:
    """The same linear model as one expression."""
    z = F.lit(model["intercept"])
    for name, weight in model["weights"].items():
        z = z + F.coalesce(F.col(name).cast("double"), F.lit(0.0)) * weight
    return df.withColumn(out, 1.0 / (1.0 + F.exp(-z)))


MEASURES = {"aum_0": "aum", "rollup_12monsales": "sales", "proj_sales_3mon": "proj3m", "proj_sales": "proj"}


def lead_scores(leads: DataFrame, top: int = 600) -> DataFrame:
    """Mean of four percent ranks, rule override of the model score, model rank and lead flag."""
    nonzero = leads.withColumns({c: F.nullif(F.col(c), F.lit(0.0)) for c in MEASURES})
    ranked = average_percent_ranks(cut_lineage(nonzero), {c: f"{name}_decile" for c, name in MEASURES.items()})
    ranked = ranked.na.fill(0.0, list(MEASURES))
    c = F.col
    mean = (c("proj3m_decile") + c("proj_decile") + c("sales_decile") + c("aum_decile")) / 4
    rule = (
        (c("aum_0") >= 1000000) | (c("rollup_12monsales") >= 100000) | (c("proj_sales_3mon") >= 100000) | (c("proj_sales") >= 100000)
    )
    scored = ranked.withColumns({"ia_score": rounded(mean, 3), "blanket_rules": rule.cast("int")}).withColumn(
        "final_score",
        F.when((c("blanket_rules") == 1) & (c("probability") < 0.225), 0.225 + 0.01 * c("ia_score")).otherwise(c("probability")),
    )
    out = order_stats(scored, "probability", descending=True, tie="cgi", row_number="model_rank", settle=True)
    return out.withColumn(
        "lead_indicator", ((c("model_rank") <= top) | (c("blanket_rules") == 1)).cast("int")
    )


def select_leads(scored: DataFrame, ownership: DataFrame, spare: str, first: int = 25, last: int = 35) -> DataFrame:
    """Split leads into owned, incremental and non leads, then rank all of them again.

    ``ownership`` has (cgi, final_psp). Free leads are ranked per owner by
    score: the first go to that owner, the next to the spare owner. Owned and
    incremental leads rank before the rest. Fallen angels and rule leads become
    incremental at the end.
    """
    c = F.col
    owned = scored.join(ownership, "cgi").withColumn("own_inc", F.lit("ownership"))
    free = scored.join(ownership.select("cgi"), "cgi", "left_anti")
    free = order_stats(free, "ia_score", keys=["psp"], descending=True, tie="cgi", row_number="__rank", settle=True)
    lead = c("lead_indicator") == 1
    free = free.withColumns(
        {
            "final_psp": F.when(lead & c("__rank").between(first + 1, last), spare).otherwise(c("psp")),
            "own_inc": F.when(lead & (c("__rank") <= last), "incremental").otherwise("non lead"),
        }
    ).drop("__rank")
    every = owned.unionByName(free).withColumn(
        "__score", c("ia_score") + F.when(c("own_inc") != "non lead", 1).otherwise(0)
    )
    final = order_stats(every, "__score", keys=["psp"], descending=True, tie="cgi", row_number="original_rank", settle=True)
    fallen = (c("rollup_12monsales") <= 0) & (c("aum_0") >= 500000)
    rescued = (c("own_inc") == "non lead") & (fallen | (c("blanket_rules") == 1))
    return final.withColumns(
        {
            "fallen_angel": F.when(fallen, "Fallen Angel").otherwise("Active"),
            "own_inc": F.when(rescued, "incremental").otherwise(c("own_inc")),
        }
    ).drop("__score")
