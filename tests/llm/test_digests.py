"""The digest index against a dictionary, across batches, and its plan."""

import hashlib
import re

from tests.llm.cases import documents, texts
from tidemill.llm import digests


def bare(text):
    return re.sub(r"[\x20\x09-\x0D]", "", text or "")


def expected(rows):
    groups = {}
    for k, t in rows:
        groups.setdefault(bare(t), []).append((-len(t or ""), k is None, k or 0, k))
    best = {t: min(g) for t, g in groups.items()}
    return {t: (b[3], len(groups[t])) for t, b in best.items()}


def index(spark, tmp_path, **kw):
    return digests.DigestIndex(spark, f"file://{tmp_path}/index", buckets=4, **kw)


def test_one_batch(spark, tmp_path):
    rows = [*texts(), (900, "a b\tc"), (901, "a  bc\n\n"), (899, "abc    "), (902, "a\u00a0bc")]
    found = index(spark, tmp_path).add(documents(spark, rows), "first").collect()
    want = expected(rows)
    assert len(found) == len(rows)
    by_digest = {hashlib.sha256(t.encode()).digest(): v for t, v in want.items()}
    for r in found:
        assert (r.keep_id, r.group_size) == by_digest[bytes(r.digest)]
        assert not r.kept or r.id == r.keep_id
    assert sum(r.kept for r in found) == len(want)
    assert want["abc"] == (899, 3)


def test_batches_and_reruns(spark, tmp_path):
    rows = texts()
    first, second = rows[::2], rows[1::2]
    one = index(spark, tmp_path)
    kept = {r.digest: r.keep_id for r in one.add(documents(spark, first), "a").collect() if r.kept}
    reopened = index(spark, tmp_path)
    before = sorted(map(str, reopened.add(documents(spark, second), "b").collect()))
    again = sorted(map(str, reopened.add(documents(spark, second), "b").collect()))
    assert [re.sub(r", row=\d+", "", x) for x in before] == [re.sub(r", row=\d+", "", x) for x in again]
    for r in reopened.add(documents(spark, second), "b").collect():
        if r.digest in kept:
            assert not r.kept and r.keep_id == kept[r.digest]
    assert reopened.read().count() == len(expected(rows))
    small = reopened.compact(f"file://{tmp_path}/compact")
    assert sorted(map(str, small.read().collect())) == sorted(map(str, reopened.read().collect()))


def test_kept_rows(spark, tmp_path):
    docs = documents(spark, texts())
    out = digests.deduplicate(docs, index(spark, tmp_path), "x")
    assert out.columns == docs.columns
    assert sorted(bare(r.text) for r in out.collect()) == sorted(expected(texts()))


def test_empty(spark, tmp_path):
    empty = index(spark, tmp_path)
    assert empty.add(documents(spark, []), "none").count() == 0
    assert digests.deduplicate(documents(spark, []), empty, "none").count() == 0


def test_index_is_not_shuffled(spark, tmp_path):
    some = index(spark, tmp_path)
    some.add(documents(spark), "x").count()
    batch = spark.createDataFrame([(bytearray(b"x" * 32),)], "digest binary")
    spark.conf.set("spark.sql.shuffle.partitions", "16")
    plan = batch.join(some.read().hint("merge"), "digest", "left_anti")._jdf.queryExecution().executedPlan().toString()
    spark.conf.set("spark.sql.shuffle.partitions", "4")
    assert "SortMergeJoin" in plan and "Bucketed: true" in plan
    assert plan.count("Exchange") == 1 and plan.index("Exchange") < plan.index(some.table)
