"""Joins of texts that differ by a typing error, or are similar to a degree."""

from __future__ import annotations

import math
from collections.abc import Iterator, Sequence
from itertools import combinations
from types import FunctionType

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F
from pyspark.sql.types import DoubleType

from tidemill.session import cut_lineage


#: Texts whose lengths differ by less than this factor share a length class.
CLASS = 1.15
SLACK = 1e-9


def _by_value(function: FunctionType) -> FunctionType:
    """A copy that travels to the executors whole, so they need no copy of the package."""
    copy = FunctionType(function.__code__, {"np": np, "math": math, "combinations": combinations, "__builtins__": __builtins__}, function.__name__)
    copy.__module__ = "__main__"
    return copy


def _score(a: Sequence[str], b: Sequence[str]) -> np.ndarray:
    """Jaro-Winkler similarities of pairs of texts, all pairs at once.

    The greedy matching walks along the left texts position by position; at each, the
    first free equal character in reach is taken in every pair by one array operation.
    """
    n, m = (np.fromiter(map(len, x), np.int64, len(x)) for x in (a, b))
    wide, long = int(n.max(initial=0)), int(m.max(initial=0))
    if not wide or not long:
        return ((n == 0) & (m == 0)).astype(float)
    x = np.array(a, f"U{wide}").view(np.uint32).reshape(len(a), wide)
    y = np.array(b, f"U{long}").view(np.uint32).reshape(len(b), long)
    rows, places = np.arange(len(a)), np.arange(long)
    reach = np.maximum(np.maximum(n, m) // 2 - 1, 0)[:, None]
    free = places < m[:, None]
    left, count = np.full((len(a), max(wide, long)), -1, np.int64), np.zeros(len(a), np.int64)
    for i in range(wide):
        fits = free & (y == x[:, i : i + 1]) & (np.abs(places - i) <= reach) & (i < n)[:, None]
        hit = np.flatnonzero(fits.any(axis=1))
        free[hit, fits[hit].argmax(axis=1)] = False
        left[hit, count[hit]] = x[hit, i]
        count[hit] += 1
    taken = ~free & (places < m[:, None])
    right = np.full_like(left, -1)
    at = np.cumsum(taken, axis=1) - 1
    row, place = np.nonzero(taken)
    right[row, at[row, place]] = y[row, place]
    swaps = (left != right).sum(axis=1) // 2
    safe = np.maximum(count, 1)
    jaro = np.where(count > 0, (count / np.maximum(n, 1) + count / np.maximum(m, 1) + (count - swaps) / safe) / 3, 0.0)
    same = np.zeros((len(a), 4), bool)
    k = min(4, wide, long)
    same[:, :k] = (x[:, :k] == y[:, :k]) & (np.arange(k) < np.minimum(n, m)[:, None])
    start = np.cumprod(same, axis=1).sum(axis=1)
    out = np.where(jaro > 0.7, jaro + start * 0.1 * (1 - jaro), jaro)
    return np.where((n == 0) & (m == 0), 1.0, out)[rows]


def similarity(left: Column, right: Column) -> Column:
    """Jaro-Winkler similarity; a null on either side gives 0."""
    score = _by_value(_score)

    def scores(batches: Iterator[tuple[pd.Series, pd.Series]]) -> Iterator[pd.Series]:
        for a, b in batches:
            out = np.zeros(len(a))
            known = np.flatnonzero((a.notna() & b.notna()).to_numpy())
            # Pairs of similar width together, so that one long text does not widen the arrays of all.
            width = np.maximum(a.iloc[known].str.len(), b.iloc[known].str.len()).to_numpy() if len(known) else known
            known = known[np.argsort(width, kind="stable")]
            for at in range(0, len(known), 512):
                part = known[at : at + 512]
                out[part] = score(a.iloc[part].tolist(), b.iloc[part].tolist())
            yield pd.Series(out)

    return F.pandas_udf(scores, DoubleType())(left, right)


def _variants(text: Column) -> Column:
    """The text itself and the text without one character, each once."""
    cuts = F.transform(
        F.sequence(F.lit(1), F.greatest(F.length(text), F.lit(1))),
        lambda i: F.concat(F.substr(text, F.lit(1), i - 1), F.substr(text, i + 1)),
    )
    return F.array_distinct(F.concat(F.array(text), cuts))


def fuzzy_match(left: DataFrame, right: DataFrame, left_text: str, right_text: str, score: str = "score") -> DataFrame:
    """Distinct texts of both sides within one edit of each other, with their similarity.

    Two texts one edit apart share a text with at most one character removed,
    so an equi-join on those finds every pair without comparing all of them.
    Texts are made distinct first, so copies cost nothing.
    """
    a = left.select(left_text).distinct().withColumn("__v", F.explode(_variants(F.col(left_text))))
    b = right.select(right_text).distinct().withColumn("__v", F.explode(_variants(F.col(right_text))))
    pairs = a.join(b, "__v").select(left_text, right_text).distinct()
    near = pairs.where(F.levenshtein(left_text, right_text, 1) >= 0)
    return near.withColumn(score, similarity(F.col(left_text), F.col(right_text)))


def _least_overlap(threshold: float) -> float:
    """c, so that texts of lengths a and b with a Jaro-Winkler similarity of the threshold share c*a*b/(a+b) characters.

    A common start of four characters adds at most 0.4 of what a Jaro similarity over
    0.7 lacks to 1. Jaro's third term is 1 at most, which leaves common/a + common/b >= 3j - 1.
    """
    return 3 * max(0.7, (threshold - 0.4) / 0.6) - 1


def _keys(text: str, own_left: bool, c: float, rank: dict, ratio: float, slack: float) -> list:
    """The keys under which a text meets every text that shares enough characters with it.

    Its characters, each numbered by occurrence, are ordered by rarity. Two texts that
    share o of them share k already among the first n - o + k of either. k is 2 where o
    allows, so a key is a pair of characters with the length classes of both sides.
    """
    n = len(text)
    if not n:
        return ["="]

    def kind(length):
        return int(math.log(length) / math.log(ratio) + slack)

    def lowest(cls):
        low = max(1, int(ratio**cls) - 1)
        while kind(low) < cls:
            low += 1
        return low

    seen, marks = {}, []
    for ch in text:
        seen[ch] = seen.get(ch, 0) + 1
        marks.append((rank.get(ch, 0), ch, seen[ch]))
    marks = [f"{ch}{i}" for _, ch, i in sorted(marks)]
    short, far = max(1, math.ceil((c - 1) * n - slack)), math.floor(n / (c - 1) + slack)
    out, mine = [], kind(n)
    for other in range(kind(short), kind(far) + 1):
        first = max(short, lowest(other))
        if first > far or kind(first) != other:
            continue
        low = (lowest(mine), lowest(other))
        k = 2 if math.ceil(c * low[0] * low[1] / (low[0] + low[1]) - slack) >= 2 else 1
        shared = math.ceil(c * n * first / (n + first) - slack)
        pair = f"{mine}:{other}" if own_left else f"{other}:{mine}"
        out += [f"{pair}:{':'.join(x)}" for x in combinations(marks[: n - shared + k], k)]
    return out


def similarity_join(left: DataFrame, right: DataFrame, left_text: str, right_text: str, threshold: float, score: str = "score") -> DataFrame:
    """Distinct texts of both sides with a Jaro-Winkler similarity of ``threshold`` (0.8 or more), all of them.

    Similar texts have similar lengths and many characters in common. Candidates meet
    in an equi-join on pairs of rare common characters, see ``_keys``, and are scored;
    the filter never loses a pair. Nulls meet nothing, empty texts each other.
    """
    if not 0.8 <= threshold <= 1:
        raise ValueError("the threshold must be from 0.8 to 1")
    sides = [left.select(F.col(left_text).alias("t")), right.select(F.col(right_text).alias("t"))]
    # At most one row per character of the script.
    letters = sides[0].unionByName(sides[1]).distinct().select(F.explode(F.split("t", "")).alias("ch")).groupBy("ch").count().collect()
    rank = {r["ch"]: i for i, r in enumerate(sorted(letters, key=lambda r: (r["count"], r["ch"])))}
    c, keys, ratio, slack = _least_overlap(threshold), _by_value(_keys), CLASS, SLACK

    def emit(own_left: bool):
        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for batch in batches:
                texts = batch.column("t").to_pylist()
                yield pa.RecordBatch.from_arrays([batch.column("id"), pa.array([keys(t, own_left, c, rank, ratio, slack) for t in texts], pa.list_(pa.string()))], names=["id", "keys"])

        return run

    # Texts are numbered and keys hashed, so what is joined and made distinct is three numbers; a hash that two keys share only adds a candidate.
    texts, met = [], []
    for side, own_left, name in ((sides[0], True, left_text), (sides[1], False, right_text)):
        numbered = cut_lineage(side.where("t IS NOT NULL").distinct().withColumn("id", F.monotonically_increasing_id()))
        found = numbered.mapInArrow(emit(own_left), "id long, keys array<string>")
        met.append(found.select(F.col("id").alias(f"__{name}"), F.explode(F.transform("keys", lambda k: F.xxhash64(k))).alias("__key")))
        texts.append(numbered.select(F.col("id").alias(f"__{name}"), F.col("t").alias(name)))
    pairs = met[0].join(met[1], "__key").select(f"__{left_text}", f"__{right_text}").distinct()
    named = pairs.join(texts[0], f"__{left_text}").join(texts[1], f"__{right_text}").select(left_text, right_text)
    scored = named.withColumn(score, similarity(F.col(left_text), F.col(right_text)))
    return scored.where(F.col(score) >= threshold - SLACK)
