"""The pipeline's stages against plain versions, each on its own input."""

import re

import corpus_pipeline
import public_tokenizers
import tiktoken

from tests import oracle
from tests.llm.test_brute import plain_lines
from tests.llm.test_shingles import plain_components
from tidemill.llm import bpe, queries
from tidemill.session import scratch_path

PATH = "/root/testdata/sf0.001"


def test_stages(spark):
    docs, kept = spark.read.parquet(f"{PATH}/documents.parquet"), []
    for name, stage in corpus_pipeline.STAGES:
        path = scratch_path(spark, name)
        stage(spark, docs, PATH).write.parquet(path)
        after = spark.read.parquet(path)
        kept.append((name, docs, after))
        docs = after
    assert [n for n, _, _ in kept] == ["quality_rules", "line_dedup", "near_dedup", "benchmark_decontamination", "tokens"]
    for _, before, after in kept[:-1]:
        assert after.schema.simpleString() == before.schema.simpleString()

    rows = [{r.doc_id: r for r in frame.collect()} for frame in (kept[0][1], *(a for _, _, a in kept))]
    sql = queries.QUALITY_SQL.format(docs="documents") + "SELECT doc_id FROM judged WHERE kept"
    assert set(rows[1]) == {r[0] for r in oracle.connect(PATH).execute(sql).fetchall()}

    gone = plain_lines([(r.doc_id, r.text) for r in rows[1].values()])
    for key, r in rows[1].items():
        left = "\n".join(x for n, x in enumerate(r.text.split("\n")) if (key, r.text, n) not in gone)
        assert rows[2][key].text == left and rows[2][key].n_chars == len(left)

    # Of every group linked by a similarity of 0.8 between sets of five words, one stays.
    texts = [(k, r.text) for k, r in rows[2].items()]
    groups = {}
    for key, group in plain_components(texts):
        groups.setdefault(group, []).append(key)
    assert any(len(g) > 1 for g in groups.values())
    assert all(sum(k in rows[3] for k in g) == 1 for g in groups.values())

    plain = lambda t: re.sub(r"\W+", " ", t.lower()).split()
    items = [plain(r.text) for r in spark.read.parquet(f"{PATH}/benchmark.parquet").collect()]
    grams = {tuple(w[i : i + 13]) for w in items for i in range(len(w) - 12)}
    short = {tuple(w[i : i + 5]) for w in items for i in range(len(w) - 4)}
    for key, r in rows[3].items():
        w = plain(r.text)
        if key in rows[4]:
            assert not any(tuple(w[i : i + 13]) in grams for i in range(len(w) - 12))
        else:  # what goes has a passage of an item, whatever its names and numbers are
            assert any(tuple(w[i : i + 5]) in short for i in range(len(w) - 4)), key
    assert set(rows[4]) < set(rows[3])

    ranks = bpe.read_ranks(public_tokenizers.path("byte_bpe_50k.tiktoken"))
    encoding = tiktoken.Encoding("plain", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={})
    assert set(rows[5]) == set(rows[4])
    for key, r in rows[5].items():
        assert r.text == rows[4][key].text and r.n_tokens == len(encoding.encode_ordinary(r.text))


def test_run_is_the_query(spark):
    assert queries.QUERIES["pipeline"](spark, PATH).count() > 0
