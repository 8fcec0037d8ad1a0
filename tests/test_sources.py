"""Sources, sinks and streams over files."""

import json

import pytest
from pyspark.sql import functions as F

from corpusflow.sources import feeds, sinks
from corpusflow.streaming import items as streams

RSS = """<rss><channel><title>c</title>
<item><link>https://a.example/1</link><title>One [Image 1 of 2]</title><pubDate>Mon, 06 Jan 2025 10:00:00 +0000</pubDate><description>&lt;p&gt;Some  text&lt;/p&gt;</description></item>
<item><title>No link</title></item>
<item><link>https://a.example/2</link><title>Two</title><pubDate>bad</pubDate></item></channel></rss>"""


def test_feed_files(spark, tmp_path):
    (tmp_path / "f.xml").write_text(RSS)
    got = feeds.entries(feeds.feed_files(spark, str(tmp_path / "f.xml"))).orderBy("url").collect()
    assert [(r["url"], r["title"], r["summary"], r["pub_ts"] is None) for r in got] == [("https://a.example/1", "One", "Some text", False), ("https://a.example/2", "Two", "", True)]


def test_feed_source(spark):
    def fetch(url):  # local, so that workers get it by value
        if "bad" in url:
            raise OSError("refused")
        return [(f"{url}/x", "T", None, None, None, None, "s", None, None)]

    spark.dataSource.register(feeds.feed_source(fetch))
    got = spark.read.format("feed").option("urls", "https://ok.example,https://bad.example").load().orderBy("feed").collect()
    assert [(r["feed"], r["status"], r["error"]) for r in got] == [("https://bad.example", "error", "refused"), ("https://ok.example", "ok", None)]


def test_channels(spark):
    got = feeds.channels(spark, [{"id": "a", "name": "A", "feeds": ["f1", "f2"], "full": "page"}, {"id": "b", "feeds": ["f3"], "lookback": 30}]).orderBy("channel_ord", "feed_ord").collect()
    assert [(r["id"], r["feed"], r["lookback"]) for r in got] == [("a", "f1", None), ("a", "f2", None), ("b", "f3", 30)]


def test_snapshot_failover(spark, tmp_path):
    (tmp_path / "s.json").write_text(json.dumps({"updatedAt": "x", "items": [{"url": "u1", "zhParas": ["a"]}, {"url": "u2"}]}))
    got = feeds.snapshot(spark, str(tmp_path / "missing.json"), str(tmp_path / "s.json")).orderBy("ord").collect()
    assert [(r["url"], r["zhParas"]) for r in got] == [("u1", ["a"]), ("u2", None)]
    assert feeds.snapshot(spark, str(tmp_path / "missing.json")).count() == 0


def test_glossary_file(spark, tmp_path):
    (tmp_path / "g.csv").write_text("﻿english,中文\n# note\nNATO,one\nnato\ttwo\nterm,x\nalone\nAir Force,a,b\n\n", encoding="utf-8")
    assert {(r["term"], r["target"]) for r in feeds.glossary_file(spark, str(tmp_path / "g.csv")).collect()} == {("nato", "two"), ("air force", "a,b")}


def test_decoded(spark):
    assert spark.createDataFrame([(b"ab\xffc",)], "b binary").select(feeds.decoded(F.col("b"))).first()[0] == "abc"


def test_sinks(spark, tmp_path):
    path, df = str(tmp_path / "t"), spark.range(3)
    sinks.swap(df, path)
    sinks.swap(spark.read.parquet(path).filter("id > 0"), path)
    assert spark.read.parquet(path).count() == 2
    assert sinks.export_snapshot(df, "now", str(tmp_path / "j")) and not sinks.export_snapshot(df.limit(0), "now", str(tmp_path / "k"))
    v = sinks.commit(df, str(tmp_path / "v"), 0)
    assert v == 1 == sinks.commit_if_changed(df.limit(0), str(tmp_path / "v"), 1)
    with pytest.raises(RuntimeError):
        sinks.commit(df, str(tmp_path / "v"), 0)
    sinks.write_items(df.withColumn("k", F.col("id") % 2), str(tmp_path / "i"), "k")
    assert spark.read.parquet(str(tmp_path / "i")).count() == 3


def test_streams(spark, tmp_path):
    schema = "url string, title string, pub_ts timestamp"
    rows = [("u1", "Same title", "2025-01-01"), ("u2", "same TITLE!", "2025-01-02"), ("u1", "Other", "2025-01-03")]
    spark.createDataFrame(rows, "url string, title string, t string").selectExpr("url", "title", "cast(t as timestamp) pub_ts").write.parquet(str(tmp_path / "in"))
    source = spark.readStream.schema(schema).parquet(str(tmp_path / "in"))
    q = streams.unseen(source).writeStream.format("memory").queryName("unseen").option("checkpointLocation", str(tmp_path / "c1")).trigger(availableNow=True).start()
    q.awaitTermination()
    assert spark.table("unseen").count() == 2
    streams.upsert(source, str(tmp_path / "out"), str(tmp_path / "c2")).awaitTermination()
    assert {(r["url"], r["title"]) for r in spark.read.parquet(str(tmp_path / "out")).collect()} == {("u1", "Other"), ("u2", "same TITLE!")}


def test_fetch(spark):
    from corpusflow.sources import fetch as fetching

    def client(url):
        if url.endswith("/moved"):
            return fetching.Response(302, location="/there")
        if url.endswith("/inside"):
            return fetching.Response(302, location="http://localhost/")
        if url.endswith("/down"):
            raise OSError("refused")
        return fetching.Response(404 if url.endswith("/gone") else 200, url.encode())

    urls = [f"https://a.example/{x}" for x in ("x", "moved", "inside", "down", "gone")] + ["http://localhost/x", "https://a.example/x"]
    df = spark.createDataFrame([(u,) for u in urls], "url string")
    got = {r["url"].rsplit("/", 1)[1]: r for r in fetching.fetch(df, client, 0.0, lambda s: None).collect()}
    assert len(got) == 5 and bytes(got["moved"]["body"]) == b"https://a.example/there" and got["gone"]["status"] == 404
    assert "not allowed" in got["inside"]["error"] and got["down"]["error"] == "refused" and got["x"]["error"] is None


def test_terms_as_a_source(spark, tmp_path):
    """A recorded server: classes and the cursor are in the requests, pages come in order."""
    from urllib.parse import unquote

    from corpusflow.sources import fetch as fetching
    from corpusflow.sources import sparql

    log, page = str(tmp_path / "log"), 1000

    def client(url):
        import json
        import re

        q = unquote(url.split("query=")[1])
        cls, after = re.search(r"wd:(C\d)", q)[1], re.search(r'STR\(\?item\) > "([^"]*)"', q)
        after = after[1] if after else ""
        with open(log, "a") as out:
            out.write(f"{cls} {after.rsplit('/', 1)[-1]}\n")
        have = [f"http://www.wikidata.org/entity/Q{k:05d}" for k in range(1500 if cls == "C1" else 3)]
        rows = [{"item": {"value": i}, "en": {"value": "en"}, "zh": {"value": cls}} for i in have if i > after][:page]
        return fetching.Response(200, json.dumps({"results": {"bindings": rows}}).encode())

    spark.conf.set("spark.sql.python.filterPushdown.enabled", "true")
    spark.dataSource.register(sparql.term_source(sparql.Endpoint("https://e.example/q", client, sleep=lambda s: None), per_task=1))
    asked = lambda: open(log).read().split("\n")[:-1]  # noqa: E731, SIM115
    load = lambda: spark.read.format("sparql_terms").option("classes", '["C1", "C2", "C3"]').load()
    df = load().filter("class IN ('C1', 'C2') AND item > 'Q00001' AND zh <> ''")
    got = sorted((r["class"], r["item"]) for r in df.collect())
    assert got == sorted([("C1", f"Q{k:05d}") for k in range(2, 1500)] + [("C2", "Q00002")])
    assert sorted(asked()) == ["C1 Q00001", "C1 Q01001", "C2 Q00001"]
    plan = df._jdf.queryExecution().executedPlan().toString()
    assert "class" not in "".join(x for x in plan.splitlines() if "Filter" in x and "Batch" not in x).replace("isnotnull(class", "")
    assert load().filter("class = 'C3'").count() == 3 and asked()[-1] == "C3 " and load().filter("class = 'C9'").count() == 0
    with pytest.raises(sparql.Refused):
        sparql.bindings({"status": "ERROR", "exception": "slow"})


def test_tasks_keep_their_distance(spark, tmp_path):
    """By recorded times: one host of most pages, read by all tasks, never closer than the spacing."""
    from corpusflow.sources import fetch as fetching

    log = str(tmp_path / "log")

    def client(url):
        import random
        import time

        with open(log, "a") as out:
            out.write(f"{time.time()} {url.split('/')[2]}\n")
        time.sleep(random.random() * 0.05)
        return fetching.Response(200, b"x")

    urls = spark.createDataFrame([(f"https://{'hot' if k < 6 else f'h{k}'}.example/{k}",) for k in range(9)], "url string")
    for of_host in (True, False):
        (tmp_path / "log").write_text("")
        got = fetching.fetch_together(urls, client, 3, spacing=0.5, of_host=of_host).collect()
        assert len(got) == 9 and all(r["status"] == 200 for r in got)
        times = sorted((float(t), h) for t, h in (x.split() for x in open(log)))  # noqa: SIM115
        own = [t for t, h in times if not of_host or h.startswith("hot")]
        assert min(b - a for a, b in zip(own, own[1:], strict=False)) >= 0.49
