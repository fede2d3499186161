"""Operators that SQL does not express, against plain versions on awkward rows."""

import math
import time
import zlib
from collections import Counter

import numpy as np
import public_tokenizers
import pytest
import tiktoken
import xxhash
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from tests.llm.cases import documents, texts
from tidemill.llm import bpe, decontaminate, lines, quality, records, simhash, suffixes, toxicity

RANKS = public_tokenizers.path("byte_bpe_50k.tiktoken")


@pytest.fixture(scope="module")
def docs(spark, tmp_path_factory):
    path = str(tmp_path_factory.mktemp("llm") / "docs")
    documents(spark).write.parquet(path)
    return spark.read.parquet(path)


def test_suffix_array():
    rng = np.random.default_rng(1)
    for _ in range(300):
        strings = [rng.integers(0, 3, rng.integers(0, 10)).tolist() for _ in range(rng.integers(1, 6))]
        starts = [0, *np.cumsum([len(s) for s in strings]).tolist()]
        flat = sum(strings, [])
        end = {i: b for a, b in zip(starts, starts[1:]) for i in range(a, b)}
        order = suffixes.suffix_array(flat, starts)
        assert sorted(order) == list(range(len(flat)))
        keys = [flat[i : end[i]] for i in order]
        assert keys == sorted(keys)


@pytest.mark.parametrize("large", [suffixes.LARGE, 1])
def test_suffix_dedup(docs, monkeypatch, large):
    monkeypatch.setattr(suffixes, "LARGE", large)
    monkeypatch.setattr(suffixes, "BLOCK", 8)
    data = [(i, (t or "").encode()) for i, t in texts()]
    seen = Counter(b[i : i + 400] for _, b in data for i in range(len(b) - 399))
    want = Counter()
    for key, b in data:
        gone = np.zeros(len(b), bool)
        for i in range(len(b) - 399):
            if seen[b[i : i + 400]] > 1:
                gone[i : i + 400] = True
        spans = int(np.count_nonzero(np.diff(np.concatenate(([0], gone.astype(int)))) == 1))
        want[key, len(b), int(gone.sum()), spans, bytes(np.frombuffer(b, np.uint8)[~gone])] += 1
    got = Counter((r.id, r.n_bytes, r.n_removed, r.n_spans, bytes(r.kept)) for r in suffixes.deduplicate(docs).collect())
    assert got == want
    assert sum(k[2] * n for k, n in want.items()) > 2000


def plain_print(text: str) -> int:
    found = (text or "").encode().lower().split()
    shingles = [b" ".join(found[i : i + 3]) for i in range(max(1, len(found) - 2))] if found else []
    hashes = [xxhash.xxh64_intdigest(s, 42) for s in shingles]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def test_simhash(docs):
    rows = texts()
    prints = [plain_print(t) for _, t in rows]
    parent = list(range(len(rows)))

    def root(i):
        while parent[i] != i:
            i = parent[i]
        return i

    for i in range(len(rows)):
        for j in range(i):
            if bin(prints[i] ^ prints[j]).count("1") <= 2:
                parent[root(i)] = root(j)
    least = {}
    for i, (key, _) in enumerate(rows):
        if key is not None:
            least[root(i)] = min(least.get(root(i), key), key)
    want = Counter((key, f"{prints[i]:016x}", least.get(root(i))) for i, (key, _) in enumerate(rows))
    found = simhash.near_duplicates(docs).withColumn("hex", simhash.hex_digits())
    assert Counter((r.id, r.hex, r.component) for r in found.collect()) == want


@pytest.mark.parametrize("crowded", [0, 3, 32])
def test_simhash_links(spark, crowded):
    """Around crowded keys the connected groups are the same as from all pairs."""
    rng = np.random.default_rng(3)
    values = {int(v) for v in rng.integers(-(1 << 62), 1 << 62, 40)}
    for v in list(values)[:10]:
        for _ in range(12):
            v ^= 1 << int(rng.integers(0, 63))
            values.add(v)
    values = sorted(values)

    def groups(pairs):
        parent = {v: v for v in values}

        def root(v):
            while parent[v] != v:
                v = parent[v]
            return v

        for a, b in pairs:
            parent[root(a)] = root(b)
        return {frozenset(v for v in values if root(v) == r) for r in {root(v) for v in values}}

    plain = [(a, b) for a in values for b in values if a < b and bin((a ^ b) & (1 << 64) - 1).count("1") <= 2]
    found = simhash.links(spark.createDataFrame([(v,) for v in values], "fp long"), crowded).collect()
    assert groups([(r.a, r.b) for r in found]) == groups(plain)
    assert all(bin((r.a ^ r.b) & (1 << 64) - 1).count("1") <= 2 for r in found)


def plain_lines(rows):
    """Removed (doc, line) by comparing every line with all earlier ones."""
    seen, gone = [], set()
    keyed = {(key, text) for key, text in rows if text}
    hashed = [(key is not None, key or 0, xxhash.xxh64_intdigest(t.encode(), 42), key, t) for key, t in keyed]
    for _, _, _, key, text in sorted(hashed, key=lambda r: (r[0], r[1], r[2] - (1 << 64) if r[2] >> 63 else r[2])):
        for n, line in enumerate(text.encode().split(b"\n")):
            own = set(line.split())
            if own:
                if any(len(own & s) >= 0.8 * len(own | s) - 1e-9 for s in seen):
                    gone.add((key, text, n))
                seen.append(own)
    return gone


def test_lines(docs):
    rows = texts()
    gone = plain_lines(rows)
    want = Counter()
    for key, text in rows:
        left = [x for n, x in enumerate((text or "").split("\n")) if (key, text, n) not in gone]
        want[key, None if text is None else "\n".join(left), len((text or "").split("\n")) - len(left)] += 1
    found = lines.deduplicate(docs)
    assert found.columns == [*docs.columns, "removed_lines"]
    assert Counter((r.doc_id, r.text, r.removed_lines) for r in found.collect()) == want
    assert len(gone) > 5


def test_lines_least_shared(spark):
    """Prefixes of similar sets share at least the number that the filter asks for."""
    rng, t = np.random.default_rng(8), lines.SIMILARITY
    pairs = []
    for _ in range(3000):
        n = int(rng.integers(1, 30))
        a = set(rng.choice(60, n, False).tolist())
        b = set(a)
        for _ in range(int(rng.integers(1, 4))):
            b ^= {int(rng.integers(0, 60))}
        if b and a != b and len(a & b) >= t * len(a | b) - 1e-9:
            pairs.append((a, b))
    cut = lambda s: sorted(s)[: min(len(s), len(s) - math.ceil(t * len(s) - 1e-9) + lines._shared(t))]
    rows = [(len(a), len(b), len(set(cut(a)) & set(cut(b)))) for a, b in pairs]
    frame = spark.createDataFrame(rows, "size int, other_size int, m int")
    assert len(rows) > 500 and frame.where(F.col("m") < lines._least_shared(t)).count() == 0


def test_lines_fetch_texts_of_likely_pairs_only(spark, monkeypatch):
    """Lines that share a few words and cannot be similar are told apart without their texts."""
    fetched, texts_of = [], lines._texts

    def watched(docs, wanted):
        fetched.append(wanted.count())
        return texts_of(docs, wanted)

    monkeypatch.setattr(lines, "_texts", watched)
    rows = [(i, " ".join([f"pair{i // 2}", f"also{i // 2}", *(f"w{i}x{j}" for j in range(30))])) for i in range(40)]
    rows += [(100, "one two three four five six seven eight nine ten"), (101, "one two three four five six seven eight nine zero ten")]
    found = lines.removed_lines(documents(spark, rows)).collect()
    assert [r.doc for r in found] == [101] and sum(fetched) == 2


def test_lines_near_misses_fetch_no_texts(spark, monkeypatch):
    """Lines that share all their rare words and too few of the common ones are told apart by their sketches."""
    fetched, texts_of = [], lines._texts

    def watched(docs, wanted):
        fetched.append(wanted.count())
        return texts_of(docs, wanted)

    monkeypatch.setattr(lines, "_texts", watched)
    rng, pool = np.random.default_rng(3), [f"often{i}" for i in range(200)]
    rows = [(i, "\n".join(f"{w} alone{i}x{j}" for j, w in enumerate(pool))) for i in range(60)]
    rows += [(100 + i, " ".join([*(f"rare{j}" for j in range(14)), *rng.choice(pool, 7, False)])) for i in range(40)]
    want = {r[:1] + r[2:] for r in plain_lines(rows)}
    found = lines.removed_lines(documents(spark, rows)).collect()
    assert {(r.doc, r.line) for r in found} == want and sum(fetched) <= 4


def test_lines_witness_is_not_the_first_holder(spark):
    """Lines unlike the first holder of their words, and like each other, are all found."""
    rng, base = np.random.default_rng(4), [f"w{i}" for i in range(30)]
    rows = [(0, " ".join(base[:16] + [f"x{i}" for i in range(9)]))]
    for i in range(1, 60):
        own = list(base)
        own[int(rng.integers(0, 30))] = f"other{i}"
        rows.append((i, " ".join(own)))
    want = {r[:1] + r[2:] for r in plain_lines(rows)}
    assert {(r.doc, r.line) for r in lines.removed_lines(documents(spark, rows)).collect()} == want and len(want) > 50


def test_lines_large_group_without_first_witness(spark, monkeypatch):
    """In a large group of similar lines that are unlike the first holder of their words, few meet all earlier ones."""
    pairs, holders_of = [], lines._holders

    def watched(*args):
        found = holders_of(*args)
        pairs.append(found.count())
        return found

    monkeypatch.setattr(lines, "_holders", watched)
    rng, base = np.random.default_rng(6), [f"w{i}" for i in range(30)]
    often = base[16:] + [f"x{i}" for i in range(9)]
    rows = [(0, " ".join(base[:16] + often[-9:]))]
    for i in range(1, 250):
        own = list(base)
        own[int(rng.integers(16, 30))] = f"other{i}"
        rows.append((i, " ".join(own)))
    rows += [(1000 + i, "\n".join(often)) for i in range(300)]  # these words are not in the prefixes
    want = {r[:1] + r[2:] for r in plain_lines(rows)}
    assert {(r.doc, r.line) for r in lines.removed_lines(documents(spark, rows)).collect()} == want
    assert sum(pairs) < 5000


def test_suffix_array_of_many_short_strings():
    """Strings of a context's length are sorted without a step in Python for each symbol."""
    rng = np.random.default_rng(2)
    symbols, starts = rng.integers(0, 1000, 17 * 20000), np.arange(0, 17 * 20000 + 1, 17)
    begin = time.process_time()
    order = suffixes.suffix_array(symbols.tolist(), starts.tolist())
    assert time.process_time() - begin < 1.2 and len(set(order)) == len(symbols)


def test_lines_sketches_never_part_similar_sets(spark):
    """Sketches of similar sets differ in no more bits than the filter allows."""
    rng, t = np.random.default_rng(9), lines.SIMILARITY
    texts_, pairs = [], []
    for _ in range(300):
        a = {f"w{i}" for i in rng.choice(3000, int(rng.integers(1, 120)), False).tolist()}
        b = set(a)
        for _ in range(int(rng.integers(1, 1 + max(2, len(a) // 5)))):
            b ^= {f"w{int(rng.integers(0, 3000))}"} if rng.random() < 0.5 or not b else {sorted(b)[0]}
        if b and len(a & b) >= t * len(a | b) - 1e-9:
            pairs.append((len(texts_), len(texts_) + 1))
            texts_ += [" ".join(sorted(a)), " ".join(sorted(b))]
    counts = spark.sparkContext.broadcast(np.zeros(lines.COUNTERS, np.int64))
    rows = spark.createDataFrame(list(enumerate(texts_)), "doc long, text string").selectExpr("doc", "0L as version", "text")
    shape = "doc long, version long, line int, entry long, size int, prefix array<int>, sketch long, low_sketch long, high_sketch long"
    cut = {r.doc: r for r in rows.mapInArrow(lines._cut(counts, t, lines._arrow(rows.schema["doc"].dataType)), shape).collect()}
    names = ("size", *lines.SKETCHES)
    held = [tuple(cut[i][c] for i in pair for c in names) for pair in pairs]
    frame = spark.createDataFrame(held, [*names, *(f"other_{c}" for c in names)])
    assert len(pairs) > 100 and frame.where(lines._close(t, *lines.SMALL) & lines._close(t, *lines.WIDE)).count() == len(pairs)


class Refuses:
    def fullmatch(self, text):
        raise AssertionError(text)


def test_plain_words_need_no_pattern(monkeypatch):
    """Words of letters are looked up without the patterns that only others need, to the same values."""
    words = ["word", "Word", "seven", "km", "(Word,", "\u00e9t\u00e9!"]
    want = [decontaminate.Lexicon()[w] for w in words]
    tokenizer = Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))
    monkeypatch.setattr(decontaminate, "NUMBER", Refuses())
    monkeypatch.setattr(records, "LETTERS", Refuses())
    assert [decontaminate.Lexicon()[w] for w in words] == want
    known = records.Known(tokenizer)
    for piece in ("word", " word", "Z", " Zqxjkvv"):
        assert np.frombuffer(known[piece], "<u4").tolist() == tokenizer.encode(piece, add_special_tokens=False).ids


def test_bpe(docs):
    encoding = tiktoken.Encoding("plain", pat_str=public_tokenizers.PATTERN, mergeable_ranks=bpe.read_ranks(RANKS), special_tokens={})
    want = Counter((k, np.array(encoding.encode_ordinary(t or ""), "<u4").tobytes(), (t or "").encode()) for k, t in texts())
    found = bpe.decode(bpe.encode(docs, RANKS, public_tokenizers.PATTERN), RANKS).collect()
    assert Counter((r.id, bytes(r.ids), bytes(r.decoded)) for r in found) == want
    assert all(r.n_tokens * 4 == len(r.ids) for r in found)


def test_records(spark, docs, tmp_path):
    path = public_tokenizers.path("byte_bpe_50k.json")
    plain = Tokenizer.from_file(path)
    want = Counter((k, np.array(plain.encode(t or "", add_special_tokens=False).ids + [2], "<u4").tobytes()) for k, t in texts())
    folder = f"file://{tmp_path}/records"
    records.write_tokens(docs, folder, path, end_id=2)
    found = sorted(records.read_tokens(spark, folder).collect(), key=lambda r: r.start)
    assert Counter((r.key, bytes(r.ids)) for r in found) == want
    keys = [(r.key is not None, r.key or 0) for r in found]
    assert keys == sorted(keys)
    assert [r.start for r in found] == [0, *np.cumsum([r.n_tokens for r in found]).tolist()[:-1]]
    mixed = records.read_tokens(spark, folder, shuffle=4).collect()
    assert Counter((r.key, r.start) for r in mixed) == Counter((r.key, r.start) for r in found)
    file = next(f for f in (tmp_path / "records").iterdir() if f.suffix == ".rec" and f.stat().st_size > 100)
    file.write_bytes(file.read_bytes()[:60] + b"\x55" + file.read_bytes()[61:])
    with pytest.raises(Exception, match="damaged"):
        records.read_tokens(spark, folder).collect()


def test_crc32c():
    crc = records.Crc32c()
    assert crc(b"123456789") == 0xE3069283 and crc(b"") == 0 and crc(bytes(32)) == 0x8A9136AA
    data = np.random.default_rng(1).integers(0, 256, 5000, np.uint8).tobytes()
    one, slow = crc.by_distance[0], 0xFFFFFFFF
    for byte in data:
        slow = int(one[(slow ^ byte) & 0xFF]) ^ slow >> 8
    assert crc(data) == slow ^ 0xFFFFFFFF


def test_quality_keeps_columns_and_rows(docs):
    kept = quality.quality_filter(docs)
    assert kept.columns == docs.columns
    judged = quality.judge(docs)
    assert judged.count() == docs.count()
    assert kept.count() == judged.where("quality.kept").count()


def test_toxicity(spark):
    """Held-out accuracy on the labelled rows, restored disguises, and awkward rows."""
    path = "/root/testdata/sf0.01"
    from tidemill.llm import queries

    scored = {r.doc_id: r for r in queries.QUERIES["op4_toxicity"](spark, path).collect()}
    truth = {r.doc_id: r.toxic for r in spark.read.parquet(f"{path}/labels.parquet").collect()}
    held = [(scored[k].score, truth[k]) for k in truth if zlib.crc32(str(k).encode()) % 5 == 0]
    assert all(scored[k].held_out == (zlib.crc32(str(k).encode()) % 5 == 0) for k in scored)
    pairs = [(a > b) + (a == b) / 2 for a, x in held for b, y in held if x and not y]
    assert sum(pairs) / len(pairs) > 0.75
    docs = spark.read.parquet(f"{path}/documents.parquet")
    model = toxicity.fit(docs, spark.read.parquet(f"{path}/labels.parquet"))
    plain, disguised, clean = "an idiot and a moron", "an 1d1ot and a m0r0n i.d.i.o.t", "the and of"
    rows = [(1, plain), (2, disguised), (3, clean), (None, None), (4, ""), (4, ""), (5, None)]
    got = toxicity.score(documents(spark, rows), model).collect()
    assert len(got) == len(rows) and all(0 <= r.score <= 1 for r in got)
    by = {r.id: r.score for r in got}
    assert by[1] > 0.5 > by[3] and by[2] > by[3]
    nothing = toxicity.fit(docs.limit(0), spark.createDataFrame([], "doc_id long, toxic int"))
    assert toxicity.score(documents(spark, rows), nothing).count() == len(rows)


def test_empty_tables(spark, tmp_path):
    none = documents(spark, [])
    assert suffixes.deduplicate(none).count() == 0
    assert simhash.near_duplicates(none).count() == 0
    assert lines.deduplicate(none).count() == 0
    assert quality.judge(none).count() == 0
    assert bpe.encode(none, RANKS, public_tokenizers.PATTERN).count() == 0
    records.write_tokens(none, f"file://{tmp_path}/none", public_tokenizers.path("byte_bpe_50k.json"), 2)
    assert records.read_tokens(spark, f"file://{tmp_path}/none").count() == 0


