"""Url rules, archives and decontamination on awkward rows."""

import pytest
from pyspark.sql import functions as F

from tests.llm.cases import documents
from tidemill.llm import decontaminate, urls, warc

URLS = [
    (1, "http://A.Example.ORG/es/x?y#z"), (2, "https://example.org/en/123"), (3, "http://example.org"), (4, "no scheme.org/"), (5, None),
    (6, "http://x.com/fr/"), (7, "http://com/de/1"), (8, "http://notcom/fr/1"), (9, "ftp://badexample.org/es/"), (9, "ftp://badexample.org/es/"),
    (None, "http://q.org/?a"), (10, "http://example.org:80/es/"), (11, "http://É.org/é/" + "p" * 3000), (12, ""),
]


def plain(url, rules):
    host = path = ""
    if url and "://" in url:
        rest = url.split("://", 1)[1]
        cut = min([rest.find(c) for c in "/?#" if c in rest], default=len(rest))
        host = "".join(c.lower() if "A" <= c <= "Z" else c for c in rest[:cut])
        tail = rest[cut:]
        path = tail[: min([tail.find(c) for c in "?#" if c in tail], default=len(tail))]
    fits = [(len(h + p), len(h), v == "block", h + p, v) for h, p, v in rules if (host == h or host.endswith("." + h)) and path.startswith(p)]
    return (host, path, *(max(fits)[3:] if fits else (None, "allow")))


@pytest.mark.parametrize("broadcast", [True, False])
def test_urls(spark, broadcast):
    rules = [("org", "/", "allow"), ("example.org", "/es/", "block"), ("com", "/fr/", "allow"), ("com", "/de/", "block"), ("example.org", "", "block")]
    pages = spark.createDataFrame([(k, u, "h", "v") for k, u in URLS], "page_id long, url string, host string, row string")
    table = spark.createDataFrame([*rules, (None, "/", "block"), ("a", None, "block")], "host string, path string, verdict string")
    found = urls.judge(pages, F.broadcast(table) if broadcast else table)
    key = lambda r: tuple(str(x) for x in r)
    got = sorted(((r.page_id, r.host, r.path, r.rule, r.verdict) for r in found.collect()), key=key)
    assert got == sorted(((k, *plain(u, rules)) for k, u in URLS), key=key)
    assert urls.judge(pages.limit(0), table).count() == 0
    assert {r.verdict for r in urls.judge(pages, table.limit(0)).collect()} == {"allow"}


def test_hosts_of_many_labels(spark):
    """Hosts are cut at the rules' numbers of labels only, so a long one costs no more than a short one."""
    long = "http://" + "a." * 60_000 + "example.org/es/1"
    pages = spark.createDataFrame([(1, long), (2, "http://one/es/"), (3, "http://x.example.org/es/")], "page_id long, url string")
    table = spark.createDataFrame([("example.org", "/es/", "block")], "host string, path string, verdict string")
    assert {r.page_id: r.verdict for r in urls.judge(pages, table).collect()} == {1: "block", 2: "allow", 3: "block"}


@pytest.mark.parametrize("cut", [10, 40, 2000])
def test_cut_archives_raise(spark, tmp_path, cut):
    """A file cut inside the headers or the payload of its last record is an error, and no shorter payload."""
    folder = f"file://{tmp_path}/cut"
    import random

    body = "".join(random.Random(1).choices("abcdefgh \n", k=20_000))
    warc.write_archives(spark.createDataFrame([(1, "u", body)], "page_id long, url string, html string"), folder)
    (file,) = list((tmp_path / "cut").glob("*.warc.gz"))
    file.write_bytes(file.read_bytes()[:-cut] if cut != 40 else file.read_bytes()[:40])
    with pytest.raises(Exception, match="ends inside"):
        warc.read_archives(spark, folder).count()


def test_archives(spark, tmp_path):
    rows = [(1, "http://a/", "same"), (2, "http://b/", "same"), (3, None, None), (4, "http://c/\r\nX: y", ""), (None, "u", "same"), (5, "u", "é" * 70000), (5, "u", "twice"), (5, "u", "twice"), (6, "u", "a\r\n\r\nb")]
    pages = spark.createDataFrame([(*r, "t") for r in rows], "page_id long, url string, html string, record_type string")
    folder = f"file://{tmp_path}/warc"
    warc.write_archives(pages, folder)
    found = warc.read_archives(spark, folder, verify=True)
    got = {(r.record_id, r.record_type, r.refers_to, r.payload_bytes, None if r.payload is None else bytes(r.payload).decode()) for r in found.collect()}
    name = "urn:page:{}".format
    assert got == {
        (name(1), "revisit", name(2), 4, None), (name(2), "response", None, 4, "same"), (None, "revisit", name(2), 4, None),
        (name(3), "revisit", name(4), 0, None), (name(4), "response", None, 0, ""), (name(5), "response", None, 140000, "é" * 70000),
        (name(5), "response", None, 5, "twice"), (name(6), "response", None, 6, "a\r\n\r\nb"),
    }
    assert found.count() == len(rows)
    only = warc.read_archives(spark, folder).where("record_type = 'revisit'")
    assert only.count() == 3
    assert "Filter" not in only._jdf.queryExecution().optimizedPlan().toString() or "PushedFilters" in only._jdf.queryExecution().toString()
    warc.write_archives(pages.limit(0), f"file://{tmp_path}/none")
    assert warc.read_archives(spark, f"file://{tmp_path}/none").count() == 0


QUESTION = "A farmer has 12 sheep and Anna buys 5 km of rope from Peter, then Anna walks 3 hours to the old market and sells 12 eggs."


def test_decontaminate(spark):
    changed = QUESTION.replace("12", "40").replace("5 km", "7 kg").replace("Anna", "Berta").replace("Peter", "Karl").replace("3 hours", "9 days")
    broken = changed.replace("Berta walks", "Karl walks").replace("40 eggs", "41 eggs")
    rows = [(1, "before. " + QUESTION), (2, changed.upper().lower() and changed), (3, "some other text. " * 40), (4, None), (5, ""), (None, QUESTION), (6, "x " * 5000 + "\n" + QUESTION + " y"), (6, QUESTION), (7, broken)]
    docs = documents(spark, rows)
    items = spark.createDataFrame([(1, QUESTION), (2, None), (3, ""), (None, "a short item of few words"), (1, QUESTION)], "item_id long, text string")
    found = {(r.id, r.item): r.windows for r in decontaminate.find(docs, items).collect()}
    assert {k for k, i in found if i == 1} >= {1, 2, 6, None}
    assert not any(k in (3, 4, 5) for k, _ in found)
    assert found.get((7, 1), 0) < found[2, 1]
    kept = decontaminate.decontaminate(docs, items)
    assert kept.columns == docs.columns
    assert {r.doc_id for r in kept.collect()} >= {3, 4, 5, None}
    assert decontaminate.find(docs.limit(0), items).count() == 0
    assert decontaminate.find(docs, items.limit(0)).count() == 0


def test_slots():
    assert decontaminate.pattern(["3", "Anna", "3."]) == decontaminate.pattern(["8", "Bo", "8"]) == "0,1,0"
    assert decontaminate.pattern(["3", "Anna", "4"]) == "0,1,2"
