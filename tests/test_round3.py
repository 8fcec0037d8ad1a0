"""Findings of round 3: a small case of each that failed before."""

import duckdb
from pyspark.sql import functions as F

from corpusflow import registry
from corpusflow.functions import text as T
from corpusflow.operators import enrich
from corpusflow.plans import catalogue
from corpusflow.storage import spread


def equal_sql(spark, folder, name, tables):
    con = duckdb.connect()
    con.execute("SET TimeZone = 'UTC'")
    for t in tables:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM '{folder}/{t}.parquet'")
    df = registry.queries()[name](spark, str(folder))
    rel = con.sql(registry.oracle_sql()[name])
    at = [rel.columns.index(c) for c in df.columns]
    got, want = sorted(map(tuple, df.collect()), key=str), sorted((tuple(r[i] for i in at) for r in rel.fetchall()), key=str)
    assert got == want
    return got


def test_titles_as_their_sql_has_them(spark, tmp_path):
    pages = ["Rea&amp;&amp;  thou &amp</title>", "token = &quot;0b96&quot;</title>", "a &lt;b&gt; &#39;c&#39; &nbsp;</title>", "no end", "&amp;quot;\n x\t</title>"]
    rows = [(k, f"<html><title>{t}<p>text</p>") for k, t in enumerate(pages)] + [(90, None), (91, "")]
    con = duckdb.connect()
    con.execute("CREATE TABLE pages (page_id BIGINT, html VARCHAR)")
    con.executemany("INSERT INTO pages VALUES (?, ?)", rows)
    con.execute(f"COPY pages TO '{tmp_path}/pages.parquet' (FORMAT parquet)")
    got = dict(equal_sql(spark, tmp_path, "q13b_page_titles", ["pages"]))
    assert got[0] == "Rea&& thou &amp" and got[1] == "token = &quot;0b96&quot;" and got[90] is None


def documents(folder, texts):
    con = duckdb.connect()
    con.execute("CREATE TABLE documents (doc_id BIGINT, text VARCHAR)")
    con.executemany("INSERT INTO documents VALUES (?, ?)", list(enumerate(texts)))
    con.execute(f"COPY documents TO '{folder}/documents.parquet' (FORMAT parquet)")


def test_openings_search_no_whole_text(spark, tmp_path):
    texts = ["a b c d e", "a b c d e ", "One two, three-four (five) six. Seven one two", ". lead b c d e f", "\n\n, ; x", None, "", "é a é b é c é d é e f", "word " * 5000]
    documents(tmp_path, texts)
    assert len(equal_sql(spark, tmp_path, "q22b_large_glossary", ["documents"])) > 20
    plan = catalogue._openings(spark.read.parquet(f"{tmp_path}/documents.parquet"))._jdf.queryExecution().executedPlan().toString()
    assert "split(text" not in plan


def plan_of(df):
    return df._jdf.queryExecution().optimizedPlan().toString()


def test_answers_are_parsed_once(spark):
    answered = spark.createDataFrame([('[{"i": 1, "p": " a "}, {"i": 1, "p": "b"}, {"i": 2, "p": " "}]', 3), ('{"i": 1, "p": "x"} {"i": 1, "p": "y"} [', 1), (None, 1), ("[null]", 1)], "said string, n int")
    slots = answered.select(T.parse_slots(F.col("said"), F.col("n")).alias("s"))
    assert [r["s"] for r in slots.collect()] == [["b", "", ""], ["x"], [""], [""]]
    assert plan_of(slots).count("from_json") == 1
    assert plan_of(answered.select(T.parse_array(F.col("said"), F.col("n")).alias("s"))).count("from_json") == 1


def test_strip_takes_the_white_space_of_the_pattern(spark):
    codes = [k for k in range(1, 0x10000) if not 0xD800 <= k < 0xE000 and k != 0xFEFF]
    signs = spark.createDataFrame([(chr(k),) for k in codes], "c string")
    assert signs.filter(F.col("c").rlike(r"^(?U)\s$")).count() == len(T.SPACES)
    assert sorted(r["c"] for r in signs.filter(T.strip(F.col("c")) == "").collect()) == sorted(T.SPACES)
    assert "regexp_replace" not in plan_of(signs.select(T.strip(F.col("c")).alias("s")))


def test_generations_make_documents_once(spark):
    seen = spark.sparkContext.accumulator(0)

    @F.udf("array<string>")
    def made(k):
        seen.add(1)
        return [f"text {k} {n}" for n in range(k)]

    items = spark.range(1, 6).select(F.col("id").alias("doc_id"), F.lit("t").alias("title"), F.lit("").alias("summary"), made("id").alias("paras"), F.when(F.col("id") == 5, F.array(F.lit(""), F.lit("old"))).alias("paras_out"))
    said = enrich.Answers(lambda prompt, texts: F.to_json(F.struct(F.upper(texts[0]).alias("p"))))
    got = {r["doc_id"]: r["paras_out"] for r in enrich.in_sequence(items, said, lambda df, name: df.checkpoint()).collect()}
    assert got[5] == ["TEXT 5 0", "old", "TEXT 5 2", "TEXT 5 3", "TEXT 5 4"] and len(got) == 5
    assert seen.value == 5


def test_carried_digests_are_not_filtered_by(spark):
    for name in ("q21_carry_over", "q21b_carried_flags"):
        assert "isnotnull(sha2" not in plan_of(registry.queries()[name](spark, "/root/testdata/sf0.001"))


def test_larger_tables_of_pages_have_more_pieces(spark, tmp_path):
    spark.range(20_000).selectExpr("id AS page_id", "sha2(cast(id AS string), 512) AS html").coalesce(1).write.parquet(f"{tmp_path}/pages")
    pages = spark.read.parquet(f"{tmp_path}/pages")
    own = spread(pages, 100_000)
    assert own.rdd.getNumPartitions() >= 10 and own.count() == 20_000
