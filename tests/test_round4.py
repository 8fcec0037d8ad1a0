"""Findings of round 4: a small case of each that failed before."""

import os
import random
import re

import pytest
from pyspark.sql import functions as F

from corpusflow import storage
from corpusflow.functions import text as T
from corpusflow.operators import enrich, glossary


@pytest.fixture
def shared(spark, tmp_path, monkeypatch):
    """The shared folder of this test alone; ``shared()``: its bytes."""
    own = storage.OWN_FOLDER
    monkeypatch.setattr(storage, "OWN_FOLDER", str(tmp_path))
    spark.sparkContext.setCheckpointDir(str(tmp_path))
    yield lambda: sum(os.path.getsize(os.path.join(d, f)) for d, _, names in os.walk(tmp_path) for f in names if not f.endswith(".crc"))
    spark.sparkContext.setCheckpointDir(own)


def plain_hits(texts, known, most):
    out = set()
    for i in {i for i, _ in texts}:
        first = {}
        for text in [t for j, t in texts if j == i and t is not None]:
            w = re.split(r"[^A-Za-z0-9\-]+", text)
            for at in range(len(w)):
                for n in range(1, 5):
                    g = " ".join(w[at : at + n]).lower().strip(".-")
                    if at + n <= len(w) and g in known:
                        first[g] = min(first.get(g, 10**9), at * 10 + n)
        out |= {(i, g, r + 1) for r, (g, _) in enumerate(sorted(first.items(), key=lambda x: x[1])[:most])}
    return out


def test_hits_that_lie_beyond_each_lead(spark, monkeypatch):
    """Texts that are done at once, late, or never; cut words, repeats, one without an id, no letters at all."""
    monkeypatch.setattr(glossary, "LEAD", 1)
    monkeypatch.setattr(glossary, "KEPT", 0.8)
    monkeypatch.setattr(glossary, "DISTINCT", 0.6)
    monkeypatch.setattr(glossary, "WIDER", 2)
    dice = random.Random(4)
    some = [f"w{k}" for k in range(12)] + ["rare-1", "é", "..", "--"]
    texts = [(k, dice.choice(["", ". ", "a"]) + dice.choice([" ", ", ", "\n"]).join(dice.choices(some, k=dice.randrange(1, 90)))) for k in range(150)]
    texts += [(200, "no " * 60 + "w1 w2 w3 w4 w5 w6"), (201, "w1 " * 60 + "w2 w3 w4."), (202, "é" * 50), (203, None), (204, ""), (205, "w1-w2 w3 " + "x" * 40), (None, "w5 w6 " * 40 + "w7"), (206, ",,, w1 w2"), (206, "q q q q q w3 w9")]
    terms = [*[f"w{k}" for k in range(9)], *[f"w{k} w{k + 1}" for k in range(9)], "w1 w2 w3 w4", "w3 w4 w5", "rare-1 w2", "w2 ", " w1", "absent"]
    got = glossary.hits(spark.createDataFrame(texts, "doc_id long, text string").repartition(3), spark.createDataFrame([(t,) for t in terms], "term string"), max_hits=4)
    want = plain_hits(texts, set(terms), 4)
    assert {tuple(r) for r in got.select("doc_id", "term", "rank").collect()} == want and len(want) > 400
    assert got.count() == len(want)


def test_hits_keep_no_more_windows_than_they_need(spark, shared):
    """Every word is a term: of 2000 a text, no table has more than the first few."""
    docs = spark.range(60).select(F.col("id").alias("doc_id"), F.expr("array_join(transform(sequence(0, 1999), x -> concat('t', (x * 7 + id) % 2000)), ' ')").alias("text"))
    terms = spark.range(2000).select(F.concat(F.lit("t"), "id").alias("term"))
    got = glossary.hits(docs, terms, max_hits=3).collect()
    assert len(got) == 180 and {r["term"] for r in got if r["doc_id"] == 5} == {"t5", "t12", "t19"}
    assert shared() < 1_000_000


def test_a_generation_parses_its_answers_once(spark):
    plans = []

    def write(df, name):
        plans.append(df._jdf.queryExecution().optimizedPlan().toString())
        return df.checkpoint()

    items = spark.createDataFrame([(1, "t", "", ["a", "b"], None), (2, "t", "", ["c"], None)], "doc_id long, title string, summary string, paras array<string>, paras_out array<string>")
    said = enrich.Answers(lambda prompt, texts: F.to_json(F.struct(F.upper(texts[0]).alias("p"))))
    got = {r["doc_id"]: r["paras_out"] for r in enrich.in_sequence(items, said, write).collect()}
    assert got == {1: ["A", "B"], 2: ["C"]}
    assert [p.count("from_json") for p in plans] == [1, 1]


def test_fields_of_odd_answers(spark):
    odd = {'{"p": " a "}': "a", '{"p": ""}': "", '{"p": null} p: b': "", "{": "", "": "", None: "", " plain ": "plain", 'x {"p": "c\nd"} y': "c\nd", '{"p": "say "e" \\"f\\""}': 'say "e" "f', 'p: g': "g", "p: h {": "h {", "} {": "", '{"q": "i"}': "", '{"p": "译文：j"}': "j"}
    rows = spark.createDataFrame([(k, v) for k, v in odd.items()], "answer string, want string")
    assert [tuple(r) for r in rows.withColumn("got", T.parse_field(F.col("answer"), "p", False)).filter("got IS NULL OR got <> want").collect()] == []
