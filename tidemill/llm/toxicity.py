"""Toxicity scores on text restored by a noisy-channel decoder.

A character trigram model is counted over all documents. Tokens that look disguised
(digits or signs for letters, long repetitions, letters set apart) become a lattice
of what each character may stand for, and Viterbi decoding under the model picks the
likeliest reading. Up to four short neighbours are also read as one word that was
split, where the model finds that likelier than the pieces. The words and word beginnings of the plain and the restored text
are the features; their weights come from labelled rows.
"""

from __future__ import annotations

import functools
import math
import re
from collections.abc import Callable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from tidemill.session import cut_lineage

#: Labelled rows that the classifier is fitted on at most; those with the least hash of their id.
SAMPLE = 20_000
#: Features that the classifier keeps at most, by evidence.
FEATURES = 20_000
#: Tokens that a task remembers.
REMEMBERED = 500_000

# What characters may stand for.
LEET = {
    "0": "o", "1": "il", "2": "z", "3": "e", "4": "a", "5": "s", "6": "gb", "7": "t", "8": "b", "9": "g", "@": "a", "$": "s",
    "!": "i", "|": "il", "+": "t", "(": "c", "<": "c", "€": "e", "£": "l", "*": "aeiou", "#": "h", "%": "o", "&": "a",
}
LETTERS = "abcdefghijklmnopqrstuvwxyzàáâãäåæçèéêëìíîïðñòóôõöøùúûüýþÿß"
ALPHABET = {c: i + 3 for i, c in enumerate(LETTERS)}
START, END, OTHER = 0, 1, 2
SIZE = len(LETTERS) + 3

#: Costs of the channel, in nats: a sign for a letter, a sign that only separates, one more repetition.
SWAP, SEPARATOR, REPEAT = 1.0, 2.5, 0.7
#: A space inside a word.
SPACE = 3.0

WORD = re.compile(r"[^\W\d_]+")
EDGE = ".,;:!?\"'()[]{}«»“”‘’…"
APART = re.compile(r"(?<!\S)(?:[^\s._-][ ._*-]{1,2}){2,}[^\s._*-](?=[\s.,;:!?]|$)")
BETWEEN = re.compile(r"([^\s._-])[ ._*-]{0,2}")
#: Letters of a piece of a split word at most, and pieces.
PIECE, PIECES = 5, 4
REPEATED = re.compile(r"([^\W\d_])\1\1")
RUN = re.compile(r"(.)\1*", re.S)


def trigrams(docs: DataFrame, text: str = "text") -> DataFrame:
    """Rows (gram, n) over the words of all documents; at most one row per triple of the alphabet.

    Words are counted first, so each distinct word is cut into triples once.
    """
    words = docs.select(F.explode(F.split(F.lower(text), r"[^\p{L}]+")).alias("word")).where(F.length("word") > 0)
    counted = words.groupBy("word").agg(F.count(F.lit(1)).alias("n"))
    framed = F.concat(F.lit("^^"), F.regexp_replace("word", f"[^{LETTERS}]", "?"), F.lit("$"))
    cut = counted.withColumn("framed", framed).select(
        "n", F.explode(F.transform(F.sequence(F.lit(1), F.length("framed") - 2), lambda i: F.substring(F.col("framed"), i, F.lit(3)))).alias("gram")
    )
    return cut.groupBy("gram").agg(F.sum("n").alias("n"))


def costs(grams: list) -> np.ndarray:
    """Negative log probability of a character after two others, smoothed with the shorter contexts."""
    place = ALPHABET | {"^": START, "$": END, "?": OTHER}
    n = np.zeros((SIZE, SIZE, SIZE))
    for r in grams:
        a, b, c = (place[x] for x in r["gram"])
        n[a, b, c] = r["n"]
    one = (n.sum((0, 1)) + 1) / (n.sum() + SIZE)
    pair = n.sum(0)
    two = (pair + 5 * one) / (pair.sum(1, keepdims=True) + 5)
    three = (n + 5 * two[None]) / (n.sum(2, keepdims=True) + 5)
    return -np.log(three).astype(np.float32)


#: Choices that were looked up, by character and length of its run; all runs of three and more have the same.
KNOWN_CHOICES: dict[tuple[str, int], list[tuple[str, float]]] = {}


def lattice(token: str) -> list[list[tuple[str, float]]]:
    """For each run of a character what it may have been, with the cost of the channel."""
    steps = []
    for m in RUN.finditer(token):
        c, r = m.group(1), min(m.end() - m.start(), 3)
        choices = KNOWN_CHOICES.get((c, r))
        if choices is None:
            if c in ALPHABET:
                choices = [(c, REPEAT * (r > 1) if r != 2 else 0.5)] + ([(c + c, 0.1 if r == 2 else REPEAT)] if r > 1 else [])
            else:
                signs = LEET.get(c, "")
                choices = [(x, SWAP + REPEAT * (r > 1)) for x in signs] + ([(x + y, SWAP + 0.1 if r == 2 else SWAP + REPEAT) for x in signs for y in signs] if r > 1 else [])
                choices.append(("", 4.0 if c.isalnum() else SEPARATOR if c in LEET else 0.3))
            KNOWN_CHOICES[c, r] = choices
        steps.append(choices)
    return steps


def decode(token: str, model: np.ndarray) -> str:
    """The likeliest reading of a token."""
    return reading(token, model)[1]


def reading(token: str, model: np.ndarray | list) -> tuple[float, str]:
    """Cost and text of the likeliest reading: Viterbi over the lattice, states are the last two characters.

    Tasks pass the model as nested lists, whose elements are read much faster than those of an array.
    """
    best: dict[tuple[int, int], tuple[float, str]] = {(START, START): (0.0, "")}
    for choices in lattice(token):
        if len(choices) == 1 and len(best) == 1:  # one way on
            (((a, b), (cost, out)),), ((letters, extra),) = best.items(), choices
            if len(letters) == 1:
                z = ALPHABET[letters]
                best = {(b, z): (cost + extra + float(model[a][b][z]), out + letters)}
                continue
        after: dict[tuple[int, int], tuple[float, str]] = {}
        for (a, b), (cost, out) in best.items():
            for letters, extra in choices:
                x, y, total = a, b, cost + extra
                for c in letters:
                    z = ALPHABET[c]
                    total += float(model[x][y][z])
                    x, y = y, z
                state = (x, y)
                known = after.get(state)
                if known is None or total < known[0]:
                    after[state] = (total, out + letters)
        best = after
    return min((cost + float(model[a][b][END]), out) for (a, b), (cost, out) in best.items())


def disguised(token: str) -> bool:
    """A sign or digit that may stand for a letter, another sign among letters, or a letter three times in a row."""
    if token.isalpha():
        return REPEATED.search(token) is not None
    if any(c in LEET for c in token) or REPEATED.search(token):
        return True
    letters = [i for i, c in enumerate(token) if c.isalpha()]
    return bool(letters) and any(not c.isalpha() and c not in "'’-" for c in token[: letters[-1] + 1])


def readings(token: str, model: np.ndarray) -> set[str]:
    """Words of a lower-case token: as written, and as restored with and without the signs around it."""
    bare = token.strip(EDGE)
    if bare.isalpha() and not REPEATED.search(bare):  # a word as written; most tokens
        return {bare}
    words = set(WORD.findall(token))
    if bare and disguised(bare):
        words |= {decode(x, model) for x in {bare, bare.strip("*$%&#|<>")}}
    return words - {""}


def joined(pieces: tuple[str, ...], model: np.ndarray | list, cost_of: Callable[[str], float] | None = None) -> str:
    """The word that was split into ``pieces``, or an empty text if the pieces are likelier words of their own.

    ``cost_of`` may remember the costs of pieces.
    """
    cost, word = reading("".join(pieces), model)
    own = sum(map(cost_of or (lambda p: reading(p, model)[0]), pieces))
    return word if cost + SPACE * (len(pieces) - 1) < own else ""


def features(words: set[str]) -> set[str]:
    """Whole words, and their beginnings for languages that add endings."""
    return {f"={w}" for w in words} | {w[:k] for w in words for k in (4, 5) if len(w) > k}


def tokens_of(text: str) -> set[str]:
    low = text.lower()
    found = set(low.split())
    found.update("".join(BETWEEN.findall(m.group(0))) for m in APART.finditer(low))
    return found


def neighbours(text: str) -> set[tuple[str, ...]]:
    """Runs of two to ``PIECES`` short tokens."""
    tokens = [t.strip(EDGE) if len(t) <= PIECE + 1 else "" for t in text.lower().split()]
    found: set[tuple[str, ...]] = set()
    start = 0
    for end in [i for i, t in enumerate(tokens) if not 0 < len(t) <= PIECE] + [len(tokens)]:
        if end - start > 1:  # the tokens between two that are no pieces
            own = tokens[start:end]
            for n in range(2, min(PIECES, len(own)) + 1):
                found.update(zip(*(own[i:] for i in range(n))))
        start = end + 1
    return found


@dataclass
class Model:
    """What scoring needs: the character model, weights of features, and the coefficients of the document's sums."""

    characters: np.ndarray
    weights: dict
    coefficients: tuple


def _vectors(weights: dict, model: np.ndarray):
    """A function from text to the document's numbers: its heaviest feature and how many tokens carry one."""
    known: dict[str, float] = {}
    model = model.tolist()

    @functools.lru_cache(REMEMBERED // 5)
    def cost_of(piece: str) -> float:
        return reading(piece, model)[0]

    def heaviest(word: str) -> float:
        """Of the features of one word."""
        return max(weights.get(f"={word}", 0.0), weights.get(word[:4], 0.0) if len(word) > 4 else 0.0, weights.get(word[:5], 0.0) if len(word) > 5 else 0.0)

    def weight(token: str) -> float:
        found = known.get(token)
        if found is None:
            if len(known) >= REMEMBERED:
                known.clear()
            found = known[token] = max(map(heaviest, readings(token, model)), default=0.0)
        return found

    together: dict[tuple[str, ...], float] = {}

    def split(pieces: tuple[str, ...]) -> float:
        """Weight of the word that was split; only what may carry one is decoded."""
        found = together.get(pieces)
        if found is None:
            if len(together) >= REMEMBERED:
                together.clear()
            whole, found = "".join(pieces), 0.0
            if len(whole) > 3 and (not whole.isalpha() or f"={whole}" in weights or whole[:4] in weights or whole[:5] in weights):
                if not whole.isdigit() and max(map(weight, pieces)) <= 0:
                    word = joined(pieces, model, cost_of)
                    found = heaviest(word) if word else 0.0
            together[pieces] = found
        return found

    def vector(text: str) -> tuple[float, float]:
        heavy = [w for w in map(weight, tokens_of(text)) if w > 0]
        heavy += [w for w in map(split, neighbours(text)) if w > 0]
        return max(heavy, default=0.0), math.log1p(len(heavy))

    return vector


def _logistic(x: np.ndarray, y: np.ndarray) -> np.ndarray:
    """Ridge logistic regression by Newton steps."""
    design = np.column_stack([np.ones(len(x)), x])
    beta = np.zeros(design.shape[1])
    ridge = np.eye(len(beta)) * 0.05
    for _ in range(30):
        p = 1 / (1 + np.exp(-np.clip(design @ beta, -30, 30)))
        hessian = design.T @ (design * (p * (1 - p))[:, None]) + ridge
        beta += np.linalg.solve(hessian, design.T @ (y - p) - ridge @ beta)
    return beta


def fit(docs: DataFrame, labels: DataFrame, key: str = "doc_id", text: str = "text", label: str = "toxic", sample: int = SAMPLE) -> Model:
    """Fits on at most ``sample`` rows of ``labels`` (key, label); the character model covers all of ``docs``.

    Words are judged as they stand and restored; split words only count when texts are
    scored. Null keys and labels are left out; of several labels of a key the largest counts.
    Without any labelled row, or without both classes, every document scores the
    smoothed share of the label.
    """
    spark = docs.sparkSession
    # One row per triple of a fixed alphabet.
    characters = costs(trigrams(docs, text).collect())
    shared = spark.sparkContext.broadcast(characters)
    clean = labels.where(F.col(key).isNotNull() & F.col(label).isNotNull()).groupBy(F.col(key).alias("id")).agg(F.max(label).cast("int").alias("y"))
    chosen = clean.orderBy(F.xxhash64("id"), "id").limit(sample)
    # At most ``sample`` pairs of two numbers: small enough for every task.
    rows = docs.select(F.col(key).alias("id"), F.col(text).alias("text")).join(F.broadcast(chosen), "id").select("y", "text")

    def words(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known: dict[str, set] = {}
        model = shared.value.tolist()

        def of(token: str) -> set:
            found = known.get(token)
            if found is None:
                if len(known) >= REMEMBERED // 5:
                    known.clear()
                found = known[token] = features(readings(token, model))
            return found

        for batch in batches:
            for start in range(0, batch.num_rows, 200):
                part = batch.slice(start, 200)
                out = [sorted(set().union(*map(of, tokens_of(t or "")))) for t in part.column("text").to_pylist()]
                yield pa.RecordBatch.from_arrays([part.column("y"), pa.array(out, pa.list_(pa.string()))], names=["y", "found"])

    # Equal texts count once: a text with many copies is one piece of evidence.
    distinct = cut_lineage(rows.groupBy(F.sha1("text")).agg(F.max("y").alias("y"), F.first("text").alias("text")).select("y", "text"))
    found = distinct.mapInArrow(words, "y int, found array<string>")
    totals = distinct.groupBy("y").count().collect()
    toxic = sum(r["count"] for r in totals if r["y"])
    other = sum(r["count"] for r in totals if not r["y"])
    if not toxic or not other:
        share = (toxic + 1) / (toxic + other + 2)
        return Model(characters, {}, (math.log(share / (1 - share)), 0.0, 0.0))
    counts = found.select("y", F.explode("found").alias("feature")).groupBy("feature").agg(
        F.sum("y").alias("a"), F.sum(1 - F.col("y")).alias("b")
    )
    a, b = F.col("a"), F.col("b")
    share = F.lit(toxic / (toxic + other))
    test = 2 * (a * F.log(a / ((a + b) * share)) + F.when(b > 0, b * F.log(b / ((a + b) * (1 - share)))).otherwise(0.0))
    weight = F.log((a + 0.5) / (toxic + 1)) - F.log((b + 0.5) / (other + 1))
    tested = cut_lineage(counts.where("a > 1").select("feature", weight.alias("w"), test.alias("g")))
    # The more features are tried, the more evidence one needs: less than one of them passes by chance.
    evidence = 2 * math.log(max(tested.count(), 2))
    strong = tested.where((F.col("w") > 1) & (F.col("g") >= evidence))
    weights = {r["feature"]: r["w"] for r in strong.orderBy(F.desc("g"), "feature").limit(FEATURES).collect()}
    vectors = _apply(distinct, Model(characters, weights, (0.0, 0.0, 0.0)), ["y"], "y int").select("y", "top", "many").collect()
    x = np.array([[r["top"], r["many"]] for r in vectors])
    return Model(characters, weights, tuple(_logistic(x, np.array([r["y"] for r in vectors])).tolist()))


def _apply(rows: DataFrame, model: Model, keep: list[str], kinds: str) -> DataFrame:
    """``rows`` has the kept columns and ``text``; adds score, top and many."""
    # Plain values: a broadcast is pickled by reference, and workers may lack this package.
    shared = rows.sparkSession.sparkContext.broadcast((model.characters, model.weights, model.coefficients))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        characters, weights, (c0, c1, c2) = shared.value
        vector = _vectors(weights, characters)
        for batch in batches:
            found = np.array([vector(t.as_py() or "") for t in batch.column("text")], dtype=float).reshape(-1, 2)
            score = 1 / (1 + np.exp(-np.clip(c0 + c1 * found[:, 0] + c2 * found[:, 1], -500, 500)))
            columns = [*(batch.column(k) for k in keep), pa.array(score), pa.array(found[:, 0]), pa.array(found[:, 1])]
            yield pa.RecordBatch.from_arrays(columns, names=[*keep, "score", "top", "many"])

    return rows.select(*keep, "text").mapInArrow(run, f"{kinds}, score double, top double, many double")


def score(docs: DataFrame, model: Model, key: str = "doc_id", text: str = "text") -> DataFrame:
    """Rows (id, score), one per row of ``docs``, from the text alone.

    Null and empty texts get the score of a text without any feature. Repeated rows and
    null ids stay; an empty table gives an empty table; other columns are not read. All
    tokens of a text are judged, however long it is.
    """
    kind = docs.select(key).schema[0].dataType.simpleString()
    rows = docs.select(F.col(key).alias("id"), F.col(text).alias("text"))
    return _apply(rows, model, ["id"], f"id {kind}").select("id", "score")
