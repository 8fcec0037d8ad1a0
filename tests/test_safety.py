"""Broken pages, forbidden addresses, writers that end too early, answers of all kinds."""

import json

import pytest
from pyspark.sql import functions as F

from corpusflow import storage
from corpusflow.functions import text as T
from corpusflow.operators import enrich, graph, html, select
from corpusflow.sources import feeds, fetch, sinks, sparql
from stub import Stub

WORDS = "The ferry left the harbour before dawn and the crew watched the lights of the town grow small behind them. "
BAD_PAGES = [
    "<b>" * 5000 + "deep text that is long enough to be a sentence.", "<![foo[x]]><p>after a marked section</p>", "<p>" + "</x>" * 20000 + "end tags", "<div>" * 3000 + "<p>inner words here</p>" + "</div>" * 3000,
    "<!DOCTYPE [<!ELEMENT", "<", "<a href=\"", "\x00<p>\x00 nul</p>", None, "", "<p><b><p><b>" * 3000, "<script>" + "x" * 10000, "<![CDATA[ x ]]><p>some more words</p>", "<li>" * 2000 + "item",
]


def test_no_page_ends_the_job(spark):
    rows = [(k, p) for k, p in enumerate(BAD_PAGES)]
    got = html.page_body(html.routes(spark.createDataFrame(rows, "page_id long, html string"), ["article", "div.content"])).collect()
    assert len(got) == len(BAD_PAGES)
    assert "after a marked section" in html.paragraphs(html.parse(BAD_PAGES[1])) and "some more words" in html.paragraphs(html.parse(BAD_PAGES[12]))


def test_selectors():
    root = html.parse("<div id=a class='x y'><section><p class=k data-r='1'>t</p></section><p class=k>u</p></div><p class=k>v</p>")
    pick = lambda s: (lambda n: n and n.text())(html.select(root, s))
    assert pick("p.k") == "t" and pick("div > p.k") == "u" and pick("div.x.y section p") == "t" and pick("div#a[class] > p") == "u"
    assert pick("[data-r=1]") == "t" and pick("section > div p") is None and pick("#root > p") is None and pick("div section > p.k") == "t"
    for bad in ("p:first-child", "a + b", "", "p,,q"):
        with pytest.raises(ValueError):
            html.select(root, bad)


def test_extractor_route(spark):
    pages = spark.createDataFrame([(1, f"<article><p>{WORDS * 20}</p></article>"), (2, "<p>short</p>"), (3, "<p>x</p>")], "page_id long, html string")

    def extract(page):
        if "x" in page[:5]:
            raise ValueError("no")
        return WORDS * 3 + "\n\n" + WORDS if "article" in page else "too short"

    got = {r["page_id"]: r for r in html.page_body(html.routes(pages, ["article"], extract=extract)).collect()}
    assert got[1]["route"] == "extracted" and got[1]["body"].count("\n\n") == 1 and got[2]["route"] != "extracted" and got[3]["route"] != "extracted"


def test_caption():
    assert html.caption(html.parse("<meta property='og:description' content=' Two  ships '><p>" + WORDS)) == "Two ships"
    assert html.caption(html.parse(f"<p>short</p><p>{WORDS}</p>")) == WORDS.strip() and html.caption(html.parse("<p>no</p>")) == ""


NOT_ALLOWED = "http://172.16.0.1/ http://100.64.0.1/ http://192.0.0.1/ http://224.0.0.1/ http://2130706433/ http://LOCALHOST./ http://0x7f.1/ http://[::1]/ http://[::ffff:10.0.0.1]/ ftp://a.com/ http://a.internal/ http://017.0.0.1/ http:///x http://10.1.2.3/ http://198.18.0.1/".split()
ALLOWED = "http://10.example.com/ https://a.com/x http://8.8.8.8/ http://localhost.example.com/ http://1.example./".split()


def test_one_guard_for_columns_and_fetching(spark):
    urls = [(u,) for u in NOT_ALLOWED + ALLOWED]
    found = {r["u"]: r["ok"] for r in spark.createDataFrame(urls, "u string").select("u", T.url_allowed(F.col("u")).alias("ok")).collect()}
    assert found == dict.fromkeys(NOT_ALLOWED, False) | dict.fromkeys(ALLOWED, True)
    assert {u: fetch.allowed(u) for u in found} == found


def test_resolved_addresses():
    names = {"good.com": ["8.8.8.8", "2606:4700::1111"], "bad.com": ["8.8.8.8", "10.0.0.1"], "none.com": []}
    assert [fetch.allowed(f"https://{n}/", names.__getitem__) for n in names] == [True, False, False]
    assert not fetch.allowed("https://a.com/", hosts={"b.com"}) and fetch.loopback("http://127.0.0.1:11/x", 11)
    for bad in ("http://8.8.8.8/", "https://127.0.0.1/", "http://127.0.0.1:12/"):
        with pytest.raises(ValueError):
            fetch.loopback(bad, 11)


def test_a_swap_that_was_cut_short(spark, tmp_path):
    path = str(tmp_path / "t")
    sinks.swap(spark.range(3).toDF("id"), path)
    (tmp_path / "t").rename(tmp_path / "t.abc.old")  # ended between the two renames
    assert sinks.exists(spark, path) and sinks.read(spark, path).count() == 3
    assert sinks.read(spark, str(tmp_path / "u"), "id long").count() == 0 and not sinks.exists(spark, str(tmp_path / "u"))


def test_versions_locks_and_log(spark, tmp_path):
    path, df = str(tmp_path / "v"), spark.range(3).toDF("id")
    sinks.commit(df, path, 0)
    sinks.commit(df.filter("id > 0"), path, 1)
    assert sinks.read_version(spark, path).count() == 2 and sinks.read_version(spark, path, 1).count() == 3
    with pytest.raises(FileNotFoundError):
        sinks.read_version(spark, path, 9)
    with sinks.exclusive(spark, path):
        with pytest.raises(RuntimeError), sinks.exclusive(spark, path):
            pass
    with sinks.exclusive(spark, path), sinks.exclusive(spark, path, stale=10, now=lambda: 4e9):
        pass
    for k in range(2):
        sinks.log_run(sinks.run_stats(spark.createDataFrame([("ok",), (None,)], "state string")), str(tmp_path / "log"), run=k)
    assert sorted((r["run"], r["ok_count"], r["deferred"]) for r in spark.read.json(str(tmp_path / "log")).collect()) == [("0", 1, 1), ("1", 1, 1)]


def test_no_own_folder_on_a_cluster():
    class Conf:
        def get(self, *_):
            return None

    class Context:
        master = "spark://host:7077"
        getConf = lambda self: Conf()

    class Session:
        conf, sparkContext = Conf(), Context()

    with pytest.raises(RuntimeError):
        storage.checkpoint_dir(Session())


def answers(pages):
    def client(url):
        return fetch.Response(200, json.dumps(pages.pop(0)).encode())

    return client


def bindings(*rows):
    return {"results": {"bindings": [{k: {"value": v} for k, v in r.items()} for r in rows]}}


def test_sparql(monkeypatch):
    monkeypatch.setattr(sparql, "PAGE", 2)
    row = lambda k: {"item": f"{sparql.ITEM_PREFIX}{k}", "en": f"en{k}", "zh": f"zh{k}"}
    own = sparql.Endpoint("https://query.example.org/q", answers([bindings(row(1), row(2)), bindings(row(3))]), sleep=lambda s: None)
    assert list(own.terms("Q5")) == [("Q1", "en1", "zh1"), ("Q2", "en2", "zh2"), ("Q3", "en3", "zh3")]
    assert sparql.Endpoint("https://query.example.org/q", answers([bindings({"item": f"{sparql.ITEM_PREFIX}7"})])).items(sparql.children_query("Q1")) == ["Q7"]
    with pytest.raises(RuntimeError):
        sparql.Endpoint("https://query.example.org/q", answers([{"status": "ERROR", "exception": "slow"}])).rows("x")
    with pytest.raises(ValueError):
        sparql.Endpoint("http://query.example.org/q", answers([])).rows("x")
    with pytest.raises(ValueError):
        sparql.terms_query("Q5 . DROP")
    assert sparql.text('a"b\\') == '"a\\"b\\\\"'


def test_harvest_goes_on_where_it_ended(spark):
    calls = spark.createDataFrame([("A",), ("B",), ("C",)], "class string")

    def broken(name):
        if name == "B":
            raise OSError("slow")
        return [(f"{name}{k}", "en", "zh") for k in range(2 if name == "A" else 0)]

    terms, state = graph.harvest(calls, broken)
    assert terms.count() == 2 and {r["class"]: (r["done"], r["error"]) for r in state.collect()} == {"A": (True, None), "B": (False, "slow"), "C": (True, None)}
    again, state2 = graph.harvest(calls, lambda name: [(name, "en", "zh")], state)
    assert [r["class"] for r in again.collect()] == ["B"] and state2.filter("done").count() == 1
    assert graph.distinct_terms(terms.unionByName(again)).count() == 3


def test_first_of_each_hot_key(spark):
    df = spark.range(5000).selectExpr("if(id % 3 = 0, 'hot', concat('k', id % 50)) AS k", "id")
    want = {}
    for r in df.collect():
        want.setdefault(r["k"], []).append(r["id"])
    got = {}
    for r in select.first_of_each(df, ["k"], "id", 7).collect():
        got.setdefault(r["k"], []).append(r["id"])
    assert {k: sorted(v) for k, v in got.items()} == {k: sorted(v)[:7] for k, v in want.items()}



def test_a_blank_answer_is_asked_for_once_more(spark):
    seen = spark.sparkContext.accumulator(0)

    class Blank:
        def answer(self, prompt, texts):
            seen.add(1)
            return "" if len(texts) > 1 else json.dumps([t.upper() for t in texts])

    rows = spark.createDataFrame([(1, k, f"text {k}") for k in range(3)], "doc_id long, pos int, text string")
    got = enrich.enrich(rows, Blank(), lambda df, name: storage.checkpointed(df))
    assert {(r["out"], r["via"]) for r in got.collect()} == {(f"TEXT {k}", "single") for k in range(3)} and seen.value == 2 + 3


def test_prompts_reach_the_client(spark):
    class Echo:
        def answer(self, prompt, texts):
            wanted = all(x in prompt for x in ("Glossary", "carrier=X", "Title | Sum", "own=term", "one=1"))
            return json.dumps([("YES " if wanted else "NO ") + t for t in texts])

    rows = spark.createDataFrame([(1, 0, "some text", "Title | Sum", ["own=term"]), (1, 1, "more text", "Title | Sum", ["one=1"])], "doc_id long, pos int, text string, head string, hits array<string>")
    got = enrich.enrich(rows, Echo(), lambda df, name: storage.checkpointed(df), terms=[("carrier", "X")])
    assert {r["out"] for r in got.collect()} == {"YES some text", "YES more text"}


def test_titles_fall_back_one_by_one(spark):
    rows = [(k, f"title {k}" + (" BREAK" if k == 3 else ""), "" if k == 2 else f"summary {k}") for k in range(12)] + [(99, "a title that is never answered", "s")]

    class Some(Stub):
        def answer(self, prompt, texts):
            return "" if any("never" in t for t in texts) else super().answer(prompt, texts)

    got = {r["doc_id"]: r for r in enrich.titles(spark.createDataFrame(rows, "doc_id long, title string, summary string").coalesce(1), Some(), lambda df, name: storage.checkpointed(df)).collect()}
    assert len(got) == 13 and got[3]["via"] == "single" and got[3]["title_out"] == "TITLE 3 BREAK" and got[99]["via"] == "failed" and got[99]["title_out"] is None
    assert got[5]["summary_out"] == "SUMMARY 5" and got[2]["title_out"] == "TITLE 2"


def test_paragraphs_told_the_one_before(spark, tmp_path):
    class Told:
        def answer(self, prompt, texts):
            before = prompt.split("Text before, translated: ")[1] if "Text before" in prompt else "-"
            return json.dumps({"p": f"{texts[0]}<{before[:3]}>"}) if texts[0] != "bad" else "{"

    items = spark.createDataFrame([(1, "t", "s", ["aaaa", "bad", "cccc", "dddd"], None), (2, "t", "s", ["aaaa", "bbbb"], ["old!", ""]), (3, None, None, None, None)], "doc_id long, title string, summary string, paras array<string>, paras_out array<string>")
    write = lambda df, name: storage.checkpointed(df)
    got = {r["doc_id"]: (r["paras_out"], r["state"]) for r in enrich.in_sequence(items, Told(), write).collect()}
    assert got == {1: (["aaaa<->", "", "cccc<->", "dddd<ccc>"], "failed"), 2: (["old!", "bbbb<old>"], "ok"), 3: ([], "failed")}
    assert enrich.in_sequence(items, Told(), write, max_paras=1).filter("doc_id = 1").first()["paras_out"] == ["aaaa<->", "", "", ""]
    some = {r["doc_id"]: r["paras_out"] for r in enrich.in_sequence(items, Told(), write, max_requests=2).collect()}
    assert some == {1: ["aaaa<->", "", "", ""], 2: ["old!", ""], 3: []}
    # a run that ended after its second stage goes on with the third
    asked = spark.sparkContext.accumulator(0)

    class Once(Told):
        def answer(self, prompt, texts):
            asked.add(1)
            return super().answer(prompt, texts)

    whole = enrich.kept_in(str(tmp_path / "run"))

    def ends(df, name):
        if name == "paragraph_2":
            raise KeyboardInterrupt
        return whole(df, name)

    with pytest.raises(KeyboardInterrupt):
        enrich.in_sequence(items, Once(), ends)
    assert asked.value == 3
    assert {r["doc_id"]: (r["paras_out"], r["state"]) for r in enrich.in_sequence(items, Once(), whole).collect()} == got and asked.value == 5


def test_fields_of_single_answers(spark):
    cases = {'{"p": "x"}': "x", 'said {"p": "a "quoted" b"} end': 'a "quoted" b', "p: line": "line", "plain\ntext": "plain\ntext", "{broken": "", "": "", '{"q": 1}': "", '{"p": ""}\np：文本': "文本"}
    rows = spark.createDataFrame([(k,) for k in cases], "raw string").select("raw", T.parse_field(F.col("raw"), "p", False).alias("p"))
    assert {r["raw"]: r["p"] for r in rows.collect()} == cases


def test_answers_that_were_cut_short():
    usage = {"usage": {"prompt_tokens": 7, "completion_tokens": 3}}
    cut = enrich.Chat(lambda *a: {"choices": [{"message": {"content": "half"}, "finish_reason": "length"}], **usage}, "https://a.example/", "m")
    with pytest.raises(enrich.Truncated):
        enrich.Retrying(cut, lambda s: None).answer("do", ["a"])
    assert cut.usage == (1, 7, 3) and cut.payload("do", ["a"])["temperature"] == 0.2 and cut.payload("do", ["a"])["max_tokens"] == 16384
    with pytest.raises(enrich.Truncated):
        enrich.LocalChat(lambda *a: {"message": {"content": "half"}, "done_reason": "length"}, "http://127.0.0.1:1/api", "m").answer("do", ["a"])


def test_what_a_run_took(spark):
    class Counting:
        usage = (0, 0, 0)

        def answer(self, prompt, texts):
            self.usage = (2, 10, len(texts))
            if any("BREAK" in t for t in texts):
                raise OSError("refused")
            return json.dumps([t.upper() for t in texts])

    rows = spark.createDataFrame([(k, p, f"text {p}" + (" BREAK" if k == 3 and p == 0 else "")) for k in range(4) for p in range(8)], "doc_id long, pos int, text string")
    run = enrich.Run()
    enrich.enrich(rows, Counting(), lambda df, name: storage.checkpointed(df), run=run).count()
    took = run.row()
    # 8 chunks, of which one is refused; 6 texts alone, one of them twice
    assert (took["calls"], took["requests"], took["errors"], took["tokens_in"]) == (15, 30, 3, 150) and took["texts"] == 32 + 7 and took["seconds"] >= 0


def test_a_budget_for_staged_runs(spark):
    items = spark.createDataFrame([(k, f"title {k}", "sum", [f"para {k} {p}" for p in range(4)]) for k in range(4)], "doc_id long, title string, summary string, paras array<string>")
    got = {r["doc_id"]: r for r in enrich.staged(items, Stub(), lambda df, name: storage.checkpointed(df), max_paras=6).collect()}
    assert got[0]["paras_out"] == [f"PARA 0 {p}" for p in range(4)] and got[0]["title_out"] == "TITLE 0" and got[1]["paras_out"] == ["PARA 1 0", "PARA 1 1", "", ""]
    assert got[1]["title_out"] is None and got[3]["paras_out"] == [""] * 4 and got[3]["state"] == "failed"


def test_backends():
    sent = []

    def post(url, payload, headers):
        sent.append((url, payload, headers))
        return {"choices": [{"message": {"content": "done"}}], "message": {"content": "local"}}

    made = {"cloud": lambda: enrich.cloud(post, "https://api.example.com/v1", "m", "key"), "local": lambda: enrich.LocalChat(post, "http://127.0.0.1:1/api", "m"), "none": lambda: enrich.cloud(post, "https://a.com", "m", " ")}
    assert enrich.backend("none", made) is None and enrich.backend("local", made).answer("do", ["a", "b"]) == "local"
    assert enrich.Retrying(enrich.backend("cloud", made).client, lambda s: None).answer("do", ["a"]) == "done"
    assert sent[1][2]["Authorization"] == "Bearer key" and "[2] b" in sent[0][1]["messages"][-1]["content"] and sent[1][1]["messages"][-1]["content"].endswith("a")
    with pytest.raises(ValueError):
        enrich.backend("other", made)
    with pytest.raises(ValueError):
        enrich.cloud(post, "https://10.0.0.1/", "m", "key").answer("do", ["a"])
    with pytest.raises(ValueError):
        enrich.LocalChat(post, "http://8.8.8.8/", "m")


def test_without_a_client_nothing_is_asked(spark):
    items = spark.createDataFrame([(1, "t", "s", ["a"])], "doc_id long, title string, summary string, paras array<string>")
    assert tuple(enrich.staged(items, None, None).first()) == (1, None, None, None, None)


def test_locked_and_known_fields_stay(spark):
    items = spark.createDataFrame([(1, "title a", "sum a", ["para a", "para b"], ["OLD", ""], None, "KEEP", False), (2, "title b", "sum b", ["para c"], None, "HAS", None, True)], "doc_id long, title string, summary string, paras array<string>, paras_out array<string>, summary_out string, title_out string, locked boolean")
    got = {r["doc_id"]: tuple(r)[1:] for r in enrich.staged(items, Stub(), lambda df, name: storage.checkpointed(df), form="indexed").collect()}
    assert got == {1: (["OLD", "PARA B"], "SUM A", "KEEP", "ok"), 2: (["PARA C"], "HAS", None, "ok")}


def test_feed_bodies_and_authors(spark):
    rows = [("content", " http://a/1 ", "T1", None, ["Ann", "Bo"], "<p>summary one</p>", "<p>First paragraph of it.</p><p>Second paragraph of it.</p>"), ("page", "http://a/2", "T2", "<name>Cy</name>", None, "<p>summary two</p>", "<p>ignored</p>")]
    raw = spark.createDataFrame(rows, "full string, link string, title string, author string, authors array<string>, summary string, content string")
    for c in ("pubDate", "published", "updated", "description"):
        raw = raw.withColumn(c, F.lit(None).cast("string"))
    got = {r["url"]: r for r in feeds.entries(raw).collect()}
    assert got["http://a/1"]["body"] == "First paragraph of it.\n\nSecond paragraph of it." and got["http://a/1"]["author"] == "Ann、Bo" and got["http://a/1"]["summary"].startswith("First")
    assert got["http://a/2"]["body"] == "" and got["http://a/2"]["author"] == "Cy" and got["http://a/2"]["summary"] == "summary two"


def test_a_long_body_in_a_row(spark):
    body = [("Yes." if k % 3 == 0 else f"This is paragraph number {k} of the text.") for k in range(4000)]
    got = spark.createDataFrame([(body,), ([],), (None,)], "p array<string>").select(T.clean_array(F.col("p")).alias("c")).collect()
    want, k = [], 0
    while k < len(body):
        want.append(f"{body[k]} {body[k + 1]}" if body[k] == "Yes." and k + 1 < len(body) else body[k])
        k += 2 if body[k] == "Yes." and k + 1 < len(body) else 1
    assert got[0]["c"] == want and got[1]["c"] == [] and got[2]["c"] is None


def test_clients_by_host():
    client = fetch.routed(lambda u: "plain", lambda u: "special", {"a.com"})
    assert [client(f"http://{h}/") for h in ("a.com", "x.a.com", "ba.com")] == ["special", "special", "plain"] and fetch.routed(lambda u: "plain", None, {"a.com"})("http://a.com/") == "plain"


def test_recent_items_by_channel(spark):
    from corpusflow.streaming import items

    rows = [("a", 1, "2024-01-30"), ("a", 2, "2024-01-20"), ("b", 3, "2024-01-20"), ("b", 4, None), ("c", 5, "2024-01-31")]
    own = spark.createDataFrame(rows, "channel string, id int, d string").selectExpr("channel", "id", "to_timestamp(d) AS pub_ts")
    got = items.recent(own, spark.createDataFrame([("a", 7), ("b", 30)], "channel string, lookback int"), now=F.lit("2024-01-31").cast("timestamp"))
    assert sorted(r["id"] for r in got.collect()) == [1, 3, 4]


def test_an_upsert_that_carries_forward(spark, tmp_path):
    from corpusflow.streaming import items

    schema = "url string, pub_ts timestamp, body string, note string"
    row = lambda url, day, body, note: spark.sql(f"SELECT '{url}' AS url, timestamp'2024-01-{day}' AS pub_ts, '{body}' AS body, {note} AS note").select("url", "pub_ts", "body", F.col("note").cast("string"))
    source, table = str(tmp_path / "in"), str(tmp_path / "table")

    def carry(batch, known):
        old = known.select("url", F.col("note").alias("old"))
        return batch.join(old, "url", "left").withColumn("note", F.coalesce("note", "old"))

    for df in (row("u", "01", "one", "'kept'"), row("u", "02", "two", "null")):
        df.write.mode("append").parquet(source)
        items.upsert(spark.readStream.schema(schema).parquet(source), table, str(tmp_path / "state"), carry=carry).awaitTermination()
    assert [(r["body"], r["note"]) for r in sinks.read(spark, table).collect()] == [("two", "kept")]


def test_a_search_goes_on_from_its_last_level(spark):
    edges = spark.createDataFrame([("r", "a"), ("a", "b"), ("b", "c"), ("c", "d"), ("r", "e")], "parent string, child string")
    roots = spark.createDataFrame([("r",)], "node string")
    whole = sorted(map(tuple, graph.descend(edges, roots).collect()))
    for depth in range(4):
        early = graph.descend(edges, roots, depth=depth)
        assert sorted(map(tuple, graph.descend(edges, roots, known=early).collect())) == whole
