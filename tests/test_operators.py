"""Operators against micro-fixtures, sequential folds and properties."""

import random
import re

import pytest
from pyspark.sql import functions as F

from corpusflow.operators import carryover, enrich, glossary, graph, html, joins, paragraphs, select
from stub import Stub


def fold(paras):
    """The cleaner's merge as a loop."""
    out, i = [], 0
    short = lambda p: len(p.split()) <= 2 and p[-1] in ".!?"
    while i < len(paras):
        if short(paras[i]) and i + 1 < len(paras):
            out.append(paras[i] + " " + paras[i + 1])
            i += 2
        else:
            out.append(paras[i])
            i += 1
    return out


def test_merge_equals_the_fold(spark):
    rng = random.Random(4)
    docs = [[rng.choice(["Yes.", "So it.", "A longer one of words.", f"Number {k} of many words."]) for k in range(rng.randint(1, 12))] for _ in range(150)]
    rows = [(d, k, p) for d, ps in enumerate(docs) for k, p in enumerate(ps)]
    got = paragraphs.merge_short(spark.createDataFrame(rows, "doc_id long, pos int, para string")).orderBy("doc_id", "pos").collect()
    for d, ps in enumerate(docs):
        assert [r["para"] for r in got if r["doc_id"] == d] == fold(ps)


@pytest.mark.parametrize("old, out, new, paras, state", [
    ("a\n\nb", ["A", "B"], "a\n\nb", ["A", "B"], "ok"),
    ("a\n\nb", ["A", "B"], "a\n\nb\n\nc", ["A", "B", ""], "failed"),
    ("a\n\nb", ["A", "B"], "a\n\nx", ["A", ""], "failed"),
    ("a\n\nb", ["A", "B"], "x\n\nb", None, None),
    ("a  b", None, "a  b", None, "ok"),
])
def test_carry_over(spark, old, out, new, paras, state):
    items = spark.createDataFrame([("u", new)], "url string, body string")
    prev = spark.createDataFrame([("u", 0, "old", "t0", "s", None, "failed"), ("u", 1, old, "t", "s", out, "ok")], "url string, ord int, body string, title_out string, summary_out string, paras_out array<string>, state string")
    row = carryover.carry(items, prev).first()
    assert (row["paras_out"], row["state"], row["title_out"]) == (paras, state, "t")
    assert carryover.carry(items.withColumn("url", F.lit("v")), prev).first()["state"] is None


def test_glossary(spark):
    docs = spark.createDataFrame([(1, "The Carrier Strike Group met NATO. nato again"), (2, None), (3, "")], "doc_id long, text string")
    terms = spark.createDataFrame([("nato", "N"), ("carrier strike group", "C")], "term string, target string")
    got = glossary.hits(docs, terms).orderBy("doc_id", "rank").collect()
    assert [(r["doc_id"], r["term"], r["rank"]) for r in got] == [(1, "carrier strike group", 1), (1, "nato", 2)]
    assert glossary.hits(docs, terms, max_hits=1).count() == 1


def test_glossary_at_the_ends_of_texts(spark):
    texts = ["", ".", "...", "A b", " A b.", "-a- B", "É a.b\u212a", "a  B\nc d e", "\U0001f600a"]
    terms = ["a", "a b", " a", " a b", "b ", "b", "a b c d", "a b c d e", "b c", "e", "k", "a "]
    found = set()
    for k, text in enumerate(texts):
        words = re.split(r"[^A-Za-z0-9\-]+", text)
        for i in range(len(words)):
            found |= {(k, g) for n in range(1, 5) if i + n <= len(words) and (g := " ".join(words[i : i + n]).lower().strip(".-")) in terms}
    got = glossary.hits(spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string"), spark.createDataFrame([(t,) for t in terms], "term string"), max_hits=99)
    assert {(r["doc_id"], r["term"]) for r in got.collect()} == found and len(found) > 12


def test_glossary_with_hot_terms_and_a_long_document(spark):
    """A term of nearly all documents, one of 20,000 words, one id of many rows, more terms than a filter has false hits for."""
    texts = [(k, f"the word{k % 50} Carrier Group {k}") for k in range(300)] + [(1000, " ".join(f"x{k} y{k}." for k in range(20000)))] + [(7, "again the -nato- term")] * 5 + [(8, None), (9, "Kelvin \u212a.x")]
    terms = [("the",), ("nato",), ("carrier group",), ("word3 carrier",), ("k",), ("absent term",), *[(f"y{k} x{k + 1}",) for k in range(0, 30000, 3)]]
    known = {t for (t,) in terms}
    want = set()
    for i in {i for i, _ in texts}:
        first = {}
        for text in [t for j, t in texts if j == i and t]:
            w = re.split(r"[^A-Za-z0-9\-]+", text)
            for at in range(len(w)):
                for n in range(1, 5):
                    g = " ".join(w[at : at + n]).lower().strip(".-")
                    if at + n <= len(w) and g in known:
                        first[g] = min(first.get(g, 10**9), at * 10 + n)
        want |= {(i, g, r + 1) for r, (g, _) in enumerate(sorted(first.items(), key=lambda x: x[1])[:8])}
    docs = spark.createDataFrame(texts, "doc_id long, text string").repartition(5)
    got = glossary.hits(docs, spark.createDataFrame(terms, "term string"))
    assert {(r["doc_id"], r["term"], r["rank"]) for r in got.collect()} == want and len([w for w in want if w[0] == 1000]) == 8
    assert glossary.hits(docs, spark.createDataFrame([], "term string")).count() == 0


def test_bloom_filter_loses_nothing(spark):
    rows = spark.range(40000).selectExpr("concat('v', id) AS v")
    kept = joins.perhaps(rows, F.col("v"), joins.bloom(rows.filter("cast(substring(v, 2) as int) % 4 = 0")))
    assert kept.filter("cast(substring(v, 2) as int) % 4 = 0").count() == 10000 and kept.count() < 10500


def test_descend(spark):
    edges = spark.createDataFrame([("r", "a"), ("a", "b"), ("b", "c"), ("c", "d"), ("d", "e"), ("r", "b"), ("c", "r")], "parent string, child string")
    roots = spark.createDataFrame([("r",)], "node string")
    assert {(r[0], r[1]) for r in graph.descend(edges, roots).collect()} == {("r", 0), ("a", 1), ("b", 1), ("c", 2), ("d", 3), ("e", 4)}
    assert graph.descend(edges, roots, max_classes=2).count() == 2
    assert graph.descend(edges.limit(0), roots).count() == 1


def test_roots(spark):
    labels = spark.createDataFrame([(f"Q{k}", "ship") for k in range(8)] + [("Q9", "tank")], "item string, label string")
    edges = spark.createDataFrame([(f"Q{k}", "Q100") for k in range(1, 9)], "child string, parent string")
    roots = spark.createDataFrame([("ship", "Q7"), ("tank", None)], "label string, curated string")
    assert [r["item"] for r in graph.resolve_roots(labels, edges, roots).orderBy("rank").collect()] == ["Q7", "Q1", "Q2", "Q3"]


@pytest.mark.parametrize("seed", range(3))
def test_context_of_hot_keys(spark, seed):
    """One key of most rows, keys whose first texts are null, a null key, ends of ranges anywhere."""
    rng = random.Random(seed)
    rows = [(rng.choice(["hot"] * 8 + ["a", "b", None]), k, rng.choice([None, f"text {k}"]) if k % 3 else f"long {k} " * 40) for k in range(500)]
    rows += [("z", 1000 + k, None if k < 60 else f"z {k}") for k in range(80)]
    want, last, head = {}, {}, {}
    for key, at, text in rows:
        if text is not None:
            head.setdefault(key, text)
    for key, at, text in rows:
        want[at] = ((last[key] or "")[:200] if last.get(key) is not None else None, head.get(key))
        last[key] = text
    got = select.context(spark.createDataFrame(rows, "k string, at int, t string").repartition(3), "k", "at", "t")
    assert {r["at"]: (r["prev"], r["head"]) for r in got.collect()} == want


def test_carried_text_never_meets_old_bodies(spark):
    body = "\n\n".join(f"Paragraph {k} of the body." for k in range(6))
    prev = spark.createDataFrame([("u", 0, "none", "t0", "s0", ["x"], "ok", False, "m0"), ("u", 1, body, "t", "s", [f"T{k}" for k in range(6)], "ok", True, "m")], "url string, ord int, body string, title_out string, summary_out string, paras_out array<string>, state string, locked boolean, title_trans string")
    new = [("u", body.replace("3", "three")), ("u", body), ("u", None), ("v", body)]
    got = carryover.carry(spark.createDataFrame(new, "url string, body string"), prev)
    rows = {(r["url"], r["body"]): r for r in got.collect()}
    assert rows[new[0]]["paras_out"] == ["T0", "T1", "T2", "", "", ""] and rows[new[0]]["n_carried"] == 3 and rows[new[0]]["locked"] and rows[new[0]]["title_trans"] == "m" and rows[new[0]]["state"] == "failed"
    assert rows[new[1]]["state"] == "ok" and rows[new[1]]["n_carried"] == 6 and rows[new[2]]["carried"] and rows[new[2]]["n_carried"] == 0 and not rows[new[3]]["carried"] and rows[new[3]]["locked"] is None


def test_budget_and_chunks(spark):
    rows = spark.createDataFrame([(k, n) for k, n in enumerate([4, 5, 6, 2])], "doc_id long, todo long")
    assert [r["granted"] for r in select.budget(rows, ["doc_id"], "todo", 10).orderBy("doc_id").collect()] == [4, 5, 1, 0]
    many = spark.createDataFrame([(1, k) for k in range(14)], "doc_id long, pos int")
    assert [r["count"] for r in select.chunks(many, ["doc_id"], ["pos"], 6).groupBy("chunk").count().orderBy("chunk").collect()] == [6, 6, 2]


def test_lookback(spark):
    rows = spark.createDataFrame([(1, None), (2, "2024-01-01 00:00:00"), (3, "2023-12-31 23:59:59"), (4, "2024-01-05 00:00:00")], "k int, t string").withColumn("ts", F.col("t").cast("timestamp"))
    kept = select.lookback(rows, "ts", F.lit("2024-01-08 00:00:00").cast("timestamp"), F.lit(7))
    assert {r["k"] for r in kept.collect()} == {1, 2, 4}
    top = select.top_n(kept.withColumn("c", F.lit(1)), ["c"], [F.desc_nulls_last("ts"), F.col("k")], 2)
    assert [r["k"] for r in top.orderBy("rank").collect()] == [4, 2]


def test_longest_wins(spark):
    rows = spark.createDataFrame([(1, "k", "aa"), (2, "k", "bbb"), (3, "k", "ccc"), (4, "", "x"), (5, "", "y")], "ord long, key string, t string")
    assert {r["ord"] for r in select.longest_wins(rows, "key", "t", "ord").collect()} == {2, 4, 5}


LONG = "This is a paragraph with quite some words in it. " * 12


@pytest.mark.parametrize("page, text, route", [
    (f"<body><nav><a>Home</a></nav><article><h1>Title of it all here</h1><p>{LONG}<p>Second paragraph of the text.</article></body>", "Second paragraph", "selector"),
    (f"<body><nav><p>{LONG}</p></nav></body>", "This is a paragraph", "blocks"),
    (f"<body><div class='x'><p>{LONG}</p></div></body>", "This is a paragraph", "dense"),
    (f"<body><div class='share-bar'><p>Share this with all your many friends now.</p></div><div><p>{LONG}</p></div></body>", "This is a paragraph", "dense"),
    ("<head><meta property='og:description' content='A short description of the page.'></head><body></body>", "A short description", "described"),
    ("", "", "none"),
])
def test_page_body(spark, page, text, route):
    pages = spark.createDataFrame([(1, page)], "page_id long, html string")
    row = html.page_body(html.routes(pages, ["article", "div.content"])).first()
    assert text in row["body"] and row["route"] == route and "friends" not in row["body"]


def test_html_paragraphs():
    assert html.paragraphs(html.parse("<div>One line<br>Two lines<br></div><p>Par <b>bold</b> text</p><p>Par bold text</p>")) == ["Par bold text", "One line", "Two lines"]
    assert html.paragraphs(html.parse("<ul><li>a b<li>c d</ul><script>x()</script>")) == ["a b", "c d"]
    assert html.paragraphs(html.parse("Some words that stand alone. And others as well here.")) == ["Some words that stand alone.", "And others as well here."]
    root = html.parse("<div id=a class='x y'><p>t</p></div>")
    assert html.select(root, "div.y") and html.select(root, "div#a") and html.select(root, "p") and not html.select(root, "div.z")


def test_enrich(spark):
    rows = [(1, k, f"word{k} here") for k in range(8)] + [(2, 0, "BREAK me"), (2, 1, "fine words"), (3, 0, "x")]
    got = enrich.enrich(spark.createDataFrame(rows, "doc_id long, pos int, text string"), Stub(), lambda df, name: df.cache())
    by = {(r["doc_id"], r["pos"]): (r["out"], r["via"]) for r in got.collect()}
    assert len(by) == len(rows) and by[1, 7] == ("WORD7 HERE", "chunk") and by[2, 1] == ("FINE WORDS", "single")


def test_enrich_when_the_client_fails(spark):
    class Broken:  # local, so that workers get it by value
        def answer(self, prompt, texts):
            raise OSError("down")

    got = enrich.enrich(spark.createDataFrame([(1, 0, "a b")], "doc_id long, pos int, text string"), Broken(), lambda df, name: df.cache()).collect()
    assert [(r["out"], r["via"]) for r in got] == [("", "single")]


def test_retrying_client():
    waits, calls = [], []

    class Flaky:
        def answer(self, prompt, texts):
            calls.append(texts)
            if len(calls) < 3:
                raise OSError("busy")
            return "done"

    assert enrich.Retrying(Flaky(), waits.append).answer("", ["a"]) == "done" and waits == [0, 2, 4]


def test_preview_and_stages(spark):
    rows = spark.createDataFrame([(1, k, "x y") for k in range(7)] + [(2, 0, "z")], "doc_id long, pos int, text string")
    assert tuple(enrich.preview(rows).first()) == (2, 8, 3)
    items = spark.createDataFrame([(1, "A title", "", ["one two", "three four"]), (2, "T two", "sum mary", ["x"]), (3, "", None, [])], "doc_id long, title string, summary string, paras array<string>")
    got = {r["doc_id"]: r for r in enrich.staged(items, Stub(), lambda df, name: df.cache()).collect()}
    assert (got[1]["paras_out"], got[1]["title_out"], got[1]["summary_out"], got[1]["state"]) == (["ONE TWO", "THREE FOUR"], "A TITLE", None, "ok")
    assert got[2]["summary_out"] == "SUM MARY" and got[3]["state"] == "failed"
