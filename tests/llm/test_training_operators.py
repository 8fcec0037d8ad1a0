"""The first ten operators on small tables, against brute force and in every odd case."""

import hashlib
import math
import random
import re
import zlib
from collections import Counter

import numpy as np
import pytest
import regex
import xxhash
from pyspark.sql import functions as F

from corpusflow import storage
from corpusflow.llm import bpe, common, components, decontam, kd_shards, langid, lm_score, quality_rules, simhash, simple8b, toxicity, url_templates
from plain import plain_contaminated, plain_counts

DIR = "/root/testdata/sf0.001"
DOC = "doc_id long, text string, lang string, source string, n_chars long"
ODD = [
    (1, None, None, None, None), (2, "", "en", "src0", 0), (3, " \n\t ", "en", "src0", 4), (4, "word", "en", None, 4), (5, "Ünïcode “quotes” it's 12,5 kg\n\nünd\u00a0漢字 😀", "de", "src1", 40),
    (6, "same text here", "en", "src1", 14), (7, "same text here", "fr", "src2", 14), (7, "same text here", "fr", "src2", 14), (None, "no id at all", "en", "src0", 12), (8, "a b c " * 20000, "en", "src0", 120000),
]
WORD = re.compile(r"[^\x20\x09-\x0D]+")


@pytest.fixture(scope="module")
def docs(spark):
    return spark.read.parquet(f"{DIR}/documents.parquet").cache()


@pytest.fixture(scope="module")
def odd(spark):
    """Odd rows, with further columns whose names the operators use inside."""
    return spark.createDataFrame(ODD, DOC).selectExpr("*", "'x' AS id", "1 AS words_", "2 AS n_words", "3 AS score", "4 AS fingerprint", "5 AS block").cache()


@pytest.fixture(scope="module")
def empty(odd):
    return odd.limit(0)


def by_id(df):
    return {r["doc_id"]: r for r in df.collect()}


# ------------------------------------------------------------------ quality rules


def test_quality_counts(docs, odd, empty):
    names = ["n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words"]
    for df in (docs, odd):
        texts = {r["doc_id"]: r["text"] for r in df.collect()}
        for k, r in by_id(quality_rules.judge(df)).items():
            assert tuple(r[n] for n in names) == plain_counts(texts[k]), k
    assert quality_rules.judge(odd).count() == len(ODD) and quality_rules.judge(empty).count() == 0
    kept = quality_rules.filter_documents(odd)
    assert kept.columns == odd.columns and kept.count() == 0 and quality_rules.filter_documents(empty).count() == 0


def test_bad_hosts_lose_their_documents(spark):
    good, bad = " ".join(f"w{k}" for k in range(60)), "short"
    rows = [(h * 100 + k, good if k < n else bad, h) for h, n in ((1, 40), (2, 38), (3, 39), (4, 4)) for k in range(40)]
    got = quality_rules.judge(spark.createDataFrame([(i, t, f"h{h}") for i, t, h in rows], "doc_id long, text string, source string"))
    kept = {r["doc_id"] // 100 for r in got.filter("kept").collect()}
    assert kept == {1, 2, 3}
    assert got.filter("kept and base_failed").count() == 0 and got.filter("kept").count() == 40 + 38 + 39


# ---------------------------------------------------------------------------- BPE


def test_bpe(docs, odd, empty):
    enc = bpe.encoder(bpe.vocabulary_path())
    for df in (docs, odd):
        found = by_id(bpe.digests(df))
        for r in df.collect():
            text = r["text"] or ""
            ids = enc.encode_ordinary(text)
            own = found[r["doc_id"]]
            assert own["n_tokens"] == len(ids)
            assert own["ids_sha256"] == hashlib.sha256(" ".join(map(str, ids)).encode()).hexdigest()
            assert own["decoded_sha256"] == hashlib.sha256(text.encode()).hexdigest()
    assert bpe.digests(odd).count() == len(ODD) and bpe.digests(empty).count() == 0


def test_bytes_that_are_not_utf8(spark):
    bad = spark.sql("SELECT 1L AS doc_id, cast(unhex('61ff62c3') AS string) AS text")
    text = "a\ufffdb\ufffd"
    got = bpe.digests(bad).first()
    assert (got["n_tokens"], got["decoded_sha256"]) == (len(bpe.encoder(bpe.vocabulary_path()).encode_ordinary(text)), hashlib.sha256(text.encode()).hexdigest())
    assert simple8b.round_trip(bad).first()["n_tokens"] == len(library().encode(text, add_special_tokens=False).ids) + 1
    assert lm_score.score(bad, bad.select("doc_id")).count() == 1


def test_small_blocks_change_nothing(docs):
    a, b = (sorted((r["doc_id"], tuple(r["ids"])) for r in bpe.encode(docs, block_bytes=n).collect()) for n in (1000, 1 << 24))
    assert a == b


def test_decode_keeps_columns(spark):
    df = spark.createDataFrame([(1, [15496, 995], "x"), (2, [], "y"), (3, None, None)], "k long, ids array<int>, other string")
    got = {r["k"]: (r["other"], r["decoded"] and bytes(r["decoded"])) for r in bpe.decode(df).collect()}
    assert got == {1: ("x", b"Hello world"), 2: ("y", bytearray(b"")), 3: (None, None)} or got[2] == ("y", b"") and got[3] == (None, None)


# ----------------------------------------------------------------------- sharding


def test_shards(docs, odd, empty):
    rows = kd_shards.report(docs).collect()
    texts = {r["doc_id"]: r["text"] for r in docs.collect()}
    sizes = Counter()
    for r in rows:
        raw = texts[r["doc_id"]].encode()
        assert (r["size"], r["text_crc32"], r["law"], r["grown_shard"]) == (len(raw) + 1, zlib.crc32(raw), "bytes", None)
        sizes[r["shard"]] += r["size"]
    for s in range(8):
        assert sorted(r["slot"] for r in rows if r["shard"] == s) == list(range(sum(r["shard"] == s for r in rows)))
    assert max(sizes.values()) - min(sizes.values()) <= 2 * max(r["size"] for r in rows)
    found = kd_shards.report(odd).collect()
    assert len(found) == len(ODD) and {r["size"] for r in found if r["doc_id"] == 1} == {1}
    assert kd_shards.report(empty).count() == 0


@pytest.mark.parametrize("shards", [1, 3, 5])
def test_other_numbers_of_shards(docs, shards):
    rows = kd_shards.shard(docs, shards).collect()
    sizes = Counter()
    for r in rows:
        sizes[r["shard"]] += r["size"]
    assert sorted(sizes) == list(range(shards)) and len(rows) == docs.count()
    assert max(sizes.values()) - min(sizes.values()) <= 3 * max(r["size"] for r in rows)


def plain_kd(rows, shards, slack=kd_shards.GROUP_SLACK):
    """A k-d tree over rows of the digest, node by node: shard and place of each row."""
    dims = kd_shards.DIMENSIONS
    spread = lambda own: [max(r[d] for r in own) - min(r[d] for r in own) for d in dims]
    wide, share = [s or 1.0 for s in spread(rows)], sum(r["size"] for r in rows) / shards
    out = []

    def split(own, n, v):
        if n == 1 or not own:
            out.append(sorted(own, key=lambda r: (v(r), r["g"], r["doc_id"], r["rid"])))
            out.extend([] for _ in range(n - 1))
            return
        d = max(range(len(dims)), key=lambda k: (spread(own)[k] / wide[k], -k))
        order = sorted(own, key=lambda r: (r[dims[d]], r["g"], r["doc_id"], r["rid"]))
        at = np.concatenate([[0], np.cumsum([r["size"] for r in order])])
        cut = at[-1] * (n // 2) / n
        over = next(k for k in range(len(order)) if at[k] < cut <= at[k + 1])
        group = [k for k, r in enumerate(order) if (r[dims[d]], r["g"]) == (order[over][dims[d]], order[over]["g"])]
        near = min((at[group[0]], at[group[-1] + 1]), key=lambda x: abs(x - cut))
        cut = near if abs(near - cut) <= slack * share else cut
        left = [r for k, r in enumerate(order) if at[k] + r["size"] / 2 <= cut]
        key = lambda r, d=dims[d]: r[d]
        split(left, n // 2, key)
        split([r for k, r in enumerate(order) if at[k] + r["size"] / 2 > cut], n - n // 2, key)

    split(rows, shards, lambda r: 0.0)
    return out


@pytest.mark.parametrize("shards", [2, 4, 8])
def test_shards_are_those_of_a_plain_tree(docs, shards):
    rows = [r.asDict() for r in kd_shards.digest(docs).collect()]
    want = {r["doc_id"]: k for k, own in enumerate(plain_kd(rows, shards)) for r in own}
    assert {r["doc_id"]: r["shard"] for r in kd_shards.shard(docs, shards).collect()} == want


def test_target_bytes(docs):
    target = docs.selectExpr("sum(octet_length(text) + 1) AS n").first()["n"] // 11
    sizes = [r["n"] for r in kd_shards.shard(docs, target_bytes=target).groupBy("shard").sum("size").withColumnRenamed("sum(size)", "n").collect()]
    assert len(sizes) in (11, 12) and max(sizes) <= target * 1.01 + docs.selectExpr("max(octet_length(text)) AS n").first()["n"]


def test_equal_texts_stay_together_and_a_huge_group_is_split(spark):
    rows = [(k, f"text {k % 500} " * 5) for k in range(2000)]
    got = kd_shards.shard(spark.createDataFrame([(i, t, "en", f"s{i % 7}", 1) for i, t in rows], DOC))
    shards = {}
    for r in got.collect():
        shards.setdefault(r["doc_id"] % 500, set()).add(r["shard"])
    assert sum(len(s) > 1 for s in shards.values()) <= 7
    hot = kd_shards.shard(spark.createDataFrame([(k, "one text", "en", "s", 1) for k in range(800)], DOC))
    assert {r["count"] for r in hot.groupBy("shard").count().collect()} == {100}


# --------------------------------------------------------------------------- URLs


def test_urls(spark):
    rows = [
        (1, "http://A.Example.NET/en/1?x", "a.example.net", "/en/1", "example.net/en/", "allow"), (2, "https://example.net/fr", "example.net", "/fr", "net/", "block"), (3, "http://net", "net", "", None, "allow"),
        (4, "x://example.com/de/q#f", "example.com", "/de/q", "example.com/de/", "block"), (5, "http://badexample.com/de/q", "badexample.com", "/de/q", None, "allow"), (6, "http://a.org/fr/", "a.org", "/fr/", "org/fr/", "allow"),
        (7, None, "", "", None, "allow"), (8, "no scheme/de/", "", "", None, "allow"), (9, "", "", "", None, "allow"), (9, "http://x.net?a/b", "x.net", "", None, "allow"), (10, "a://ÀB.net:80/p/é", "Àb.net:80", "/p/é", None, "allow"),
    ]
    df = spark.createDataFrame([(r[0], r[1], "h") for r in rows], "page_id long, url string, host string")
    got = sorted(tuple(r[c] or "" for c in ("page_id", "host", "path", "rule", "verdict")) for r in url_templates.judge(df).collect())
    assert got == sorted((r[0], r[2], r[3], r[4] or "", r[5]) for r in rows)
    assert url_templates.judge(df.limit(0)).count() == 0


def test_templates_of_blocked_urls_are_rejected(spark):
    rules = [("block", "a.com", "/ads/x"), ("allow", "a.com", "/news/1")]
    urls = [f"http://a.com/ads/x{k}" for k in range(30)] + [f"http://a.com/ads/y{k}" for k in range(30)] + [f"http://a.com/news/{k}" for k in range(100)] + [f"http://b.com/p/{k}" for k in range(30)]
    got = url_templates.judge(spark.createDataFrame(list(enumerate(urls)), "page_id long, url string"), rules)
    verdicts = {(r["host"], r["path"].split("/")[1], r["verdict"]) for r in got.filter("rule is null").collect()}
    assert verdicts == {("a.com", "ads", "block"), ("a.com", "news", "allow"), ("b.com", "p", "allow")}


def plain_template(typed, host, urls):
    """The template of a typed path, segment by segment, from all ``(host, typed, label)``."""
    path, here = "", [(t, l) for h, t, l in urls if h == host]
    for depth, segment in enumerate(typed):
        at = [(t[depth], l) for t, l in here if len(t) > depth]
        labels = lambda own: (sum(l == "block" for l in own), sum(l is not None for l in own))

        def name(s, at=at):
            (b, n), (sb, sn) = labels([l for x, l in at if x == s]), labels([l for x, l in at if x != s])
            k, p = len({x for x, _ in at}), (b + sb + 1) / (n + sn + 2)
            z = abs((b + 0.5) / (n + 1) - (sb + 0.5) / (sn + 1)) / math.sqrt(p * (1 - p) * (1 / (n + 1) + 1 / (sn + 1)))
            alike = min(n, sn) >= url_templates.LEAST_LABELS and z < url_templates.Z
            return "*" if k > 1 and (k >= url_templates.MANY_VALUES and len(at) / k < url_templates.PER_VALUE or alike) else s

        here = [(t, l) for t, l in here if len(t) > depth and name(t[depth]) == name(segment)]
        path += "/" + name(segment)
    return path


def test_templates_decide_as_a_plain_tree(spark):
    rng = random.Random(7)
    rules = [("block", "a.com", "/shop/ad"), ("allow", "a.com", "/shop/it"), ("block", "b.org", "/x/p/1"), ("allow", "b.org", "/x/q/1"), ("block", "b.org", "/y/p/1"), ("allow", "b.org", "/y/q/1")]
    urls = [f"http://a.com/shop/{rng.choice(['ad', 'it', 'zz'])}{k}/view" for k in range(60)] + [f"http://a.com/{x}/{k % 3}/y" for x in ("de", "en") for k in range(20)]
    urls += [f"http://b.org/{rng.choice('xy')}/{rng.choice('pq')}/{rng.choice([1, 2])}{k}/z" for k in range(200)] + ["http://b.org", "http://b.org/"]
    rows = url_templates.judge(spark.createDataFrame(list(enumerate(urls)), "page_id long, url string"), rules).collect()
    typed = {r["path"]: r["t"] for r in spark.createDataFrame([(r["path"],) for r in rows], "path string").select("path", url_templates.typed(F.col("path")).alias("t")).collect()}
    label = lambda r: r["verdict"] if r["rule"] else None
    every = [(r["host"], typed[r["path"]], label(r)) for r in rows]
    blocked, labelled = sum(l == "block" for *_, l in every), sum(l is not None for *_, l in every)
    want, purity = {}, {}
    for r in rows:
        want[r["page_id"]] = (r["host"], plain_template(typed[r["path"]], r["host"], every))
    for t in set(want.values()):
        own = [label(r) for r in rows if want[r["page_id"]] == t]
        n = sum(x is not None for x in own)
        purity[t] = (n, (sum(x == "block" for x in own) + url_templates.PRIOR_WEIGHT * blocked / labelled) / (n + url_templates.PRIOR_WEIGHT))
    for r in rows:
        n, p = purity[want[r["page_id"]]]
        assert (r["host"], r["template"]) == want[r["page_id"]] and r["n_labels"] == n and abs(r["purity"] - p) < 1e-9
        assert r["verdict"] == (label(r) or ("block" if n >= url_templates.LEAST_LABELS and p >= url_templates.REJECT else "allow"))
    assert {r["verdict"] for r in rows if not r["rule"]} == {"allow", "block"} and any("*" in r["template"] for r in rows)


def test_a_branch_without_labels_inherits(spark):
    """From a node that rules judge nearly as a whole much, from one that they hardly touch little; deep paths are told apart."""
    deep = "/1/2/3/4/5/6"
    rules = [("block", "most.com", f"/x/{c}/") for c in "abcdefgh"] + [("block", "few.com", "/x/a/"), ("allow", "c.com", "/x/a/")] + [("block", "d.com", f"{deep}/bad/"), ("allow", "d.com", f"{deep}/good/")]
    urls = [f"http://most.com/x/{c}/{k}" for c in "abcdefgh" for k in range(20)] + [f"http://most.com/x/new/{k}" for k in range(6)]
    urls += [f"http://few.com/x/{c}/{k}" for c in "abcdefgh" for k in range(20)] + [f"http://c.com/x/{c}/{k}" for c in "ab" for k in range(60)]
    urls += [f"http://d.com{deep}/{kind}/p{k % 3}" for kind in ("bad", "good") for k in range(30)] + ["http://e.com/x", "http://most.com"]
    rows = url_templates.judge(spark.createDataFrame(list(enumerate(urls)), "page_id long, url string"), rules).collect()
    own = {(r["host"], "/".join(r["path"].split("/")[:3])): r for r in rows if not r["rule"]}
    new, old = own["most.com", "/x/new"], own["few.com", "/x/h"]
    assert new["verdict"] == "block" and new["n_labels"] == 0 and new["n_inherited"] == 160 and new["inherited"] > 0.9
    assert old["verdict"] == "allow" and old["n_labels"] == 0 and old["n_inherited"] == 20 and 0.5 < old["inherited"] < 0.8
    assert own["c.com", "/x/b"]["verdict"] == "allow" and own["c.com", "/x/b"]["inherited"] < 0.5 and own["e.com", "/x"]["n_inherited"] == 0
    kinds = {(r["path"].split("/")[7], r["template"]) for r in rows if r["host"] == "d.com"}
    assert len({t for _, t in kinds}) == 6 and {t.split("/")[7] for _, t in kinds} == {"bad", "good"}


# -------------------------------------------------------------------- language ID


def test_codewords():
    for n in (2, 4, 6, 9, 30):
        code = langid.codewords(n)
        apart = [(code[a] != code[b]).sum() for a in range(n) for b in range(a)]
        assert min(apart) >= (1 if n == 2 else 2) and len(code) == n


def test_language(spark, odd, empty):
    big = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    got = langid.identify(big).join(big.select("doc_id", "lang"), "doc_id").collect()
    held = [r for r in got if r["held_out"]]
    assert all(r["held_out"] == (zlib.crc32(str(r["doc_id"]).encode()) % 4 == 2) for r in got)
    assert np.mean([r["lang"] == r["lang_pred"] for r in held]) > 0.97 and all(0 <= r["score"] <= 1 for r in got)
    model = langid.train(big.filter(~langid.held_out()))
    found = langid.predict(odd, model, odd.columns).collect()
    assert {r["doc_id"]: r["lang_pred"] for r in found if r["doc_id"] in (1, 2, 3)} == dict.fromkeys((1, 2, 3), "und") and len(found) == len(ODD)
    assert langid.predict(spark.createDataFrame([(1, "12 + 4!")], "doc_id long, text string"), model, ["doc_id"]).first()["lang_pred"] == "und"
    assert langid.identify(empty).count() == 0 and langid.filter_documents(odd).columns == odd.columns
    one = langid.fit([b"abc def"] * 3, ["xx"] * 3)
    assert langid.predict(odd, one, ["doc_id"]).filter("lang_pred = 'xx'").count() == 7


def invented(rng, letters, words):
    return " ".join("".join(rng.choice(letters) for _ in range(rng.randint(3, 8))) for _ in range(words))


def test_a_language_with_long_texts_only(spark):
    rng = random.Random(9)
    rows = [(k, invented(rng, "abcde", 40), "en") for k in range(200)] + [(1000 + k, invented(rng, "vwxyz", 6000), "lx") for k in range(40)]
    got = langid.identify(spark.createDataFrame(rows, "doc_id long, text string, lang string")).collect()
    assert {(r["doc_id"] >= 1000, r["lang_pred"]) for r in got} == {(False, "en"), (True, "lx")}


def test_the_sample_does_not_depend_on_order_or_copies(docs):
    draw = lambda df: sorted((r["lang"], r["text"]) for r in langid.sample(df).collect())
    assert draw(docs) == draw(docs.orderBy("text").unionByName(docs).repartition(7))


def test_steps_do_not_change_a_language(monkeypatch):
    import pyarrow as pa

    rng = random.Random(4)
    model = langid.fit([invented(rng, x, 50).encode() for x in ("abcé", "xyz漢") for _ in range(20)], ["aa"] * 20 + ["bb"] * 20)
    raw, off = langid.padded(*common.utf8(pa.array([invented(rng, "abcxyz", n) for n in (0, 1, 300, 5000)])))
    once = langid._means(model.weights, raw, off)
    alone = [langid._means(model.weights, raw[a:b], np.array([0, b - a])) for a, b in zip(off[:-1], off[1:], strict=True)]
    spans = common.spans
    monkeypatch.setattr(common, "spans", lambda o, most: spans(o, 100))
    steps = langid._steps
    monkeypatch.setattr(langid, "_steps", lambda r, o, step: steps(r, o, 101))
    assert np.allclose(once, langid._means(model.weights, raw, off), atol=1e-9) and np.allclose(once, np.concatenate(alone), atol=1e-9)


def test_many_languages():
    texts, labels = zip(*[(f"{chr(97 + k % 26)}{chr(97 + k // 26)}q " * 20, f"l{k:03d}") for k in range(60) for _ in range(2)], strict=True)
    model = langid.fit([t.encode() for t in texts], list(labels))
    raw, off = langid.padded(*common.utf8(__import__("pyarrow").array(texts)))
    assert [model.languages[k] for k in langid.decode(model, raw, off)[0]] == list(labels)


# ------------------------------------------------------------------------ SimHash


def plain_print(text, k=3):
    low = (text or "").translate({c: c + 32 for c in range(65, 91)})
    words = WORD.findall(low)
    grams = [" ".join(words[i : i + k]) for i in range(len(words) - k + 1)] or ([" ".join(words)] if words else [])
    h = [xxhash.xxh64_intdigest(g.encode(), 42) for g in grams]
    return sum(1 << b for b in range(64) if 2 * sum(x >> b & 1 for x in h) > len(h))


def plain_components(prints, radius):
    root = list(range(len(prints)))

    def find(i):
        while root[i] != i:
            i = root[i]
        return i

    for i in range(len(prints)):
        for j in range(i):
            if (prints[i] ^ prints[j]).bit_count() <= radius:
                a, b = sorted((find(i), find(j)))
                root[b] = a
    return [find(i) for i in range(len(prints))]


def test_near_duplicates(docs, odd, empty):
    for df in (docs, odd):
        rows = sorted(df.collect(), key=lambda r: (r["doc_id"] is None, r["doc_id"]))
        prints = [plain_print(r["text"]) for r in rows]
        roots = plain_components(prints, 3)
        found = {}
        for r in simhash.near_duplicates(df).collect():
            found.setdefault(r["doc_id"], set()).add((r["fingerprint"] % 2**64, r["component_id"]))
        for k, r in enumerate(rows):
            assert (prints[k], rows[roots[k]]["doc_id"]) in found[r["doc_id"]]
    assert simhash.near_duplicates(odd).count() == len(ODD) and simhash.near_duplicates(empty).count() == 0


@pytest.mark.parametrize("radius, cell", [(3, 8), (3, 1024), (5, 16)])
def test_links_lose_nothing(spark, radius, cell):
    rng = random.Random(radius)
    base = [rng.getrandbits(64) for _ in range(30)]
    dense = [base[0] ^ sum(1 << b for b in rng.sample(range(64), rng.randint(0, 6))) for _ in range(150)]
    prints = sorted(set(base + dense + [b ^ (1 << rng.randrange(64)) ^ (1 << rng.randrange(64)) for b in base]))
    df = spark.createDataFrame([(p - 2**64 if p >= 2**63 else p,) for p in prints], "fingerprint long")
    roots = {r["node"]: r["root"] for r in components.components(simhash.links(df, radius, cell)).collect()}
    got = [roots.get(p - 2**64 if p >= 2**63 else p, p) for p in prints]
    want = plain_components(prints, radius)
    assert len(set(zip(got, want, strict=True))) == len(set(got)) == len(set(want))


def test_components(spark):
    chain = [(k, k + 1) for k in range(40)] + [(100, 101), (101, 101), (100, 101)]
    got = {r["node"]: r["root"] for r in components.components(spark.createDataFrame(chain, "a long, b long")).collect()}
    assert got == {**dict.fromkeys(range(41), 0), 100: 100, 101: 100}
    assert components.components(spark.createDataFrame([], "a long, b long")).count() == 0


@pytest.mark.parametrize("share", [1, common.HEAVY_SHARE])
def test_components_of_hot_nodes(spark, monkeypatch, share):
    """A node with half of all links, a long chain and small groups, with and without groups that count as heavy."""
    monkeypatch.setattr(common, "HEAVY_SHARE", share)
    rng = random.Random(4)
    pairs = [(7000 + k, 9) for k in range(900)] + [(20000 + k, 20001 + k) for k in range(70)] + [tuple(rng.sample(range(30000, 30600), 2)) for _ in range(300)]
    root = {n: n for p in pairs for n in p}

    def find(n):
        while root[n] != n:
            n = root[n]
        return n

    for a, b in pairs:
        a, b = find(a), find(b)
        root[max(a, b)] = min(a, b)
    got = {r["node"]: r["root"] for r in components.components(spark.createDataFrame(pairs, "a long, b long")).collect()}
    assert got == {n: find(n) for n in root}


def test_scratch_of_a_step_that_fails(spark, tmp_path, monkeypatch):
    monkeypatch.setattr(storage, "checkpoint_dir", lambda _: str(tmp_path))
    with pytest.raises(ZeroDivisionError):
        common.settled(spark, "step", lambda: common.materialise(spark.range(3), "inner").limit(1 // 0))
    assert not [p for p in tmp_path.iterdir() if p.is_dir()]


def test_a_folder_without_a_scheme_is_the_session_s(spark):
    conf = spark.sparkContext._jsc.hadoopConfiguration()
    before = conf.get("fs.defaultFS")
    conf.set("fs.defaultFS", "hdfs://localhost:9")
    try:
        assert common.full_address(spark, "/shared/x") == "hdfs://localhost:9/shared/x"
        assert common.full_address(spark, "file:/shared/x").startswith("file:/")
    finally:
        conf.set("fs.defaultFS", before)
    assert common.full_address(spark, "/shared/x").startswith("file:/")


def test_components_of_links_that_change(spark):
    """Links in another order at each evaluation: the two directions must be of one evaluation."""
    from pyspark.sql import functions as F

    star = spark.range(200).select(F.when(F.rand() < 0.5, F.col("id")).otherwise(F.col("id") + 1000).alias("a"), F.lit(5000).alias("b"))
    roots = {r["root"] for r in components.components(star.select(F.col("b").alias("a"), F.col("a").alias("b"))).collect()}
    assert len(roots) == 1


def test_deduplicate(spark, odd, empty):
    rng = random.Random(1)
    rows = []
    for g in range(30):
        words = [f"w{rng.randrange(10**6)}" for _ in range(200)]
        for c in range(3):
            own = words[:]
            if c:
                own[rng.randrange(200)] = "changed"
            rows.append((g * 10 + c, " ".join(own)))
    kept = simhash.deduplicate(spark.createDataFrame(rows, "doc_id long, text string"))
    assert {r["doc_id"] for r in kept.collect()} == {g * 10 for g in range(30)}
    found = simhash.deduplicate(odd)
    # texts without words are one group; the repeated row is one; the null id stays
    assert sorted((r["doc_id"] or 0) for r in found.collect()) == [0, 1, 4, 5, 6, 8] and found.columns == odd.columns
    assert simhash.deduplicate(empty).count() == 0
    named = odd.selectExpr("*", "1 AS gone_", "2 AS twice_", "3 AS row_", "4 AS key_", "5 AS component_id", "6 AS sum")
    assert simhash.deduplicate(named).columns == named.columns and simhash.deduplicate(named).count() == 6


def test_two_documents_under_one_id(spark):
    a, b = (" ".join(f"{x}{k}" for k in range(80)) for x in "ab")
    rows = [(7, a, "x"), (7, b, "y"), (9, a, "z"), (None, b, "n"), (9, a, "z"), (None, None, "m")]
    kept = simhash.deduplicate(spark.createDataFrame(rows, "doc_id long, text string, tag string"))
    assert sorted(r["tag"] for r in kept.collect()) == ["m", "n", "x"]


def test_a_hot_fingerprint(spark):
    rows = [(k, "one text for a third of all rows") for k in range(3000)] + [(k, f"text {k} of its own {k * 7}") for k in range(3000, 9000)]
    got = simhash.near_duplicates(spark.createDataFrame(rows, "doc_id long, text string"))
    assert got.count() == 9000 and got.filter("doc_id < 3000 and component_id = 0").count() == 3000


def jaccard(a, b):
    a, b = ({tuple(w[k : k + 5]) for k in range(len(w) - 4)} for w in (a.split(), b.split()))
    return len(a & b) / len(a | b)


def shifted(rng, pairs, words, cut):
    """Two windows, ``cut`` words apart, over texts of their own: ids 2k and 2k + 1."""
    rows = []
    for k in range(pairs):
        w = [f"w{rng.randrange(10**9)}" for _ in range(words + cut)]
        rows += [(2 * k, " ".join(w[:words])), (2 * k + 1, " ".join(w[cut:]))]
    return rows


def test_less_similar_texts_stay(spark):
    rows = shifted(random.Random(3), 60, 204, 28)  # 200 shingles, 172 shared
    assert 0.75 < jaccard(rows[0][1], rows[1][1]) < 0.76
    # a chain through a text in the middle is cut where a link is under the bound
    w = [f"v{k}" for k in range(300)]
    rows += [(1000, " ".join(w[:204])), (1001, " ".join(w[8:212])), (1002, " ".join(w[38:242]))]
    assert jaccard(rows[-3][1], rows[-2][1]) > 0.8 > jaccard(rows[-2][1], rows[-1][1])
    kept = {r["doc_id"] for r in simhash.deduplicate(spark.createDataFrame(rows, "doc_id long, text string")).collect()}
    assert kept == {r[0] for r in rows} - {1001}


def test_pairs_at_the_bound_are_found(spark):
    rows = shifted(random.Random(5), 150, 409, 45)  # 405 shingles, 360 shared: a similarity of 0.8
    assert jaccard(rows[0][1], rows[1][1]) == 0.8
    kept = {r["doc_id"] for r in simhash.deduplicate(spark.createDataFrame(rows, "doc_id long, text string")).collect()}
    assert kept >= {2 * k for k in range(150)} and len(kept) <= 153


def test_sets_in_cells(spark):
    rng = random.Random(4)
    sets = [sorted(rng.sample(range(400), rng.randint(1, 12))) for _ in range(60)] + [sorted(set(range(k, k + 30)) - {rng.randrange(500)}) for k in range(0, 60, 2)]
    marks = np.arange(len(sets)) + 100
    flat, off = np.concatenate(sets), common.ends(np.array([len(s) for s in sets]))
    everyone = np.arange(len(sets))
    parts = [(everyone, everyone)] + [(everyone[:45], everyone[45:]), (everyone[:45], everyone[:45]), (everyone[45:], everyone[45:])]

    def split(links):
        root = {int(m): int(m) for m in marks}
        for a, b in links:
            old, new = max(root[a], root[b]), min(root[a], root[b])
            root = {k: new if v == old else v for k, v in root.items()}
        return root

    want = split([(marks[i], marks[j]) for i in everyone for j in range(i) if len(set(sets[i]) & set(sets[j])) >= 0.8 * len(set(sets[i]) | set(sets[j]))])
    assert len(set(want.values())) < len(sets)
    for cells in (parts[:1], parts[1:]):
        assert split([x for tree, asks in cells for x in simhash._similar_in(marks, marks, asks, tree, flat, off, 0.8)]) == want


@pytest.mark.parametrize("cell", [5, 16, 1000])
def test_large_candidate_groups(spark, cell):
    """Every pair of a candidate group is compared, in whatever cells: chains, dense groups and strangers."""
    rng = random.Random(cell)
    sets = {}
    for g in range(3):
        base = rng.sample(range(10**6), 60)
        sets |= {len(sets) + k: set(base) - {rng.choice(base)} for k in range(40)}  # near copies
        sets |= {len(sets) + k: set(base[k : k + 30]) for k in range(0, 30, 3)}  # a chain of windows
    sets = list({frozenset(x) for x in sets.values()})
    rows = [(bytes([k % 2]), k + 1, sorted(s)) for k, s in enumerate(sets)]
    got = {r["node"]: r["root"] for r in simhash._similar(spark.createDataFrame(rows, "v binary, mark long, h array<long>"), 0.8, cell).collect()}
    root = list(range(len(sets)))
    for i in range(len(sets)):
        for j in range(i):
            if i % 2 == j % 2 and len(sets[i] & sets[j]) >= 0.8 * len(sets[i] | sets[j]):
                root = [root[j] if r == root[i] else r for r in root]
    want = {k: min(x for x in range(len(sets)) if root[x] == root[k]) + 1 for k in range(len(sets))}
    assert {k + 1: got.get(k + 1, k + 1) for k in want} == {k + 1: v for k, v in want.items()}


# ---------------------------------------------------------------- decontamination

ITEM = "A farmer named Tom sells 12 apples for 3 dollars each day, and then Anna buys 5 kg of them with cash."


def test_decontamination(spark, empty, odd):
    items = spark.createDataFrame([(1, ITEM), (2, "Tom met Anna and Tom saw Anna again with Tom near the old Berlin station today"), (3, None), (4, ""), (5, "too short"), (6, "five words make one window")], "item_id long, text string")
    texts = {
        1: ITEM, 2: "Well now. " + ITEM.replace("Tom", "Bob").replace("12", "4,000.5").replace("Anna", "Carla") + " The end.", 3: "Nothing of the kind stands in this text at all, whatever the number 12 says.",
        4: None, 5: "", 6: ITEM.split(" each")[0], 7: "It was said: five words make one window, always.", 8: "x Bob met Eve and Bob saw Eve again with Bob near the old Rome station today",
        9: "x Bob met Eve and Max saw Lea again with Joe near the old Rome station today", 10: "too short",
    }
    df = spark.createDataFrame(list(texts.items()), "doc_id long, text string")
    got = {r["doc_id"]: r["item_id"] for r in decontam.judge(df, items).collect() if r["contaminated"]}
    assert got == {1: 1, 2: 1, 7: 6, 8: 2}
    assert {r["doc_id"] for r in decontam.filter_documents(df, items).collect()} == {3, 4, 5, 6, 9, 10}
    assert decontam.judge(df, items.limit(0)).filter("contaminated").count() == 0
    assert decontam.judge(odd, items).count() == len(ODD) and decontam.judge(empty, items).count() == 0
    assert decontam.filter_documents(odd, items).columns == odd.columns


BARNS = (
    "A farmer keeps 2 red barns and 2 blue barns on the wide green hill behind the old mill, where the river bends towards the village and the road "
    "climbs slowly past three stone walls before it reaches the quiet forest that covers all of the northern slope."
)


def test_items_without_windows_are_matched_as_they_stand(spark):
    """Four tokens, numbers and names alone, one word, twice the same."""
    texts = ["Which planet is largest", "17, 4 and 2.5 kg: 99, 12 kg 8 3 1", "Paris", "Anna Bo Cy 12 Dee", "Anna Bo Cy 12 Dee", "", None, "42 7"]
    docs = [
        "so which PLANET is largest of all", "which planet is the largest", "with 17 4 and 2.5 kg 99 12 kg 8 3 1 in it", "with 17 4 and 2.5 kg 99 12 kg 8 3 2 in it", "paris", "They went to Paris, not to Rome", " Paris.",
        "Here Anna Bo Cy 12 Dee met", "Here Anna Bo Cy 13 Dee met", "42 7", "42 7 9", "largest", "", None, "Which planet is largest " * 3,
    ]
    items = spark.createDataFrame(list(enumerate(texts)), "item_id int, text string")
    rows = decontam.judge(spark.createDataFrame(list(enumerate(docs)), "doc_id long, text string"), items).collect()
    got = {docs[r["doc_id"]]: (r["contaminated"], r["n_items"]) for r in rows}
    assert {d: c for d, (c, _) in got.items()} == {d: plain_contaminated(d, texts) for d in docs}
    assert got[docs[7]] == (True, 2) and not got[docs[1]][0] and not got[docs[5]][0] and got[docs[14]] == (True, 1) and sum(c for c, _ in got.values()) == 4
    mixed = items.unionByName(spark.createDataFrame([(90, "How many apples does Tom have after he eats 3 of the 7 apples he bought")], "item_id int, text string"))
    assert decontam.matches(spark.createDataFrame([(1, "how many apples does tom have after he eats 3 of the 7 apples he bought"), (2, "anna bo cy 12 dee")], "doc_id long, text string"), mixed).count() == 3


def test_one_contradiction_does_not_clear_a_copy(spark):
    items = spark.createDataFrame([(1, BARNS)], "item_id long, text string")
    texts = [(1, BARNS.replace("2 blue", "3 blue")), (2, BARNS.replace("2 red", "5 red").replace("2 blue", "7 blue")), (3, "Only 2 red barns and 7 blue barns stand here.")]
    got = {r["doc_id"]: r for r in decontam.judge(spark.createDataFrame(texts, "doc_id long, text string"), items).collect()}
    assert [got[k]["contaminated"] for k in (1, 2, 3)] == [True, True, False]
    # windows that hold a contradiction are left out: one with both digits at least
    assert all(0.5 < got[k]["cover"] < 1 for k in (1, 2))


def test_passages_of_a_long_item(spark):
    rng = random.Random(6)
    words = [f"k{rng.randrange(10**6)}x" for _ in range(400)]
    other = [f"o{rng.randrange(10**6)}x" for _ in range(300)]
    items = spark.createDataFrame([(1, " ".join(words))], "item_id long, text string")
    texts = [(k, " ".join(other[:100] + words[50 : 50 + k] + other[100:])) for k in (8, 12, 13, 60, 99)]
    # two passages of 12 apart are no passage of 13
    texts.append((1000, " ".join(other[:100] + words[50:62] + other[100:200] + words[90:102])))
    got = {r["doc_id"]: r["contaminated"] for r in decontam.judge(spark.createDataFrame(texts, "doc_id long, text string"), items).collect()}
    assert got == {8: False, 12: False, 13: True, 60: True, 99: True, 1000: False}


def test_rows_without_an_id_of_their_own(spark):
    items = spark.createDataFrame([(1, ITEM)], "item_id long, text string")
    rows = [(None, ITEM), (None, "nothing of the kind"), (None, None), (None, ITEM), (7, ITEM), (7, "nothing of the kind")]
    df = spark.createDataFrame(rows, "doc_id long, text string")
    bad = [(r["doc_id"], r["n_items"], r["cover"]) for r in decontam.judge(df, items).collect() if r["contaminated"]]
    assert sorted(bad, key=str) == [(7, 1, 1.0), (None, 1, 1.0), (None, 1, 1.0)]
    kept = [tuple(r) for r in decontam.filter_documents(df, items).collect()]
    assert sorted(kept, key=str) == sorted([rows[1], rows[2], rows[5]], key=str)


def test_against_a_plain_matcher(spark, docs):
    items = [r["text"] for r in spark.read.parquet(f"{DIR}/benchmark.parquet").collect()] + [ITEM, BARNS, "five words make one window"]
    rng = random.Random(12)
    texts = [r["text"] for r in docs.collect()]
    for k in range(120):  # items cut, re-parameterised and set into other texts
        words = rng.choice(items).split()
        a = rng.randrange(len(words))
        own = words[a : a + rng.randint(4, 40)]
        own = [str(rng.randrange(1000)) if x.isdigit() and rng.random() < 0.7 else rng.choice(["Otto", "Ida", x]) if x[:1].isupper() and rng.random() < 0.5 else x for x in own]
        texts.append(" ".join(["some words before"] * (k % 2) + own + ["and some after"] * (k % 3)))
    texts += [None, "", *items]
    got = {r["doc_id"]: r["contaminated"] for r in decontam.judge(spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string"), spark.createDataFrame(list(enumerate(items)), "item_id long, text string")).collect()}
    want = {k: plain_contaminated(t, items) for k, t in enumerate(texts)}
    assert got == want and 20 < sum(want.values()) < len(texts) - 20


def test_planted_passages(spark):
    d, b = (spark.read.parquet(f"/root/testdata/sf0.01/{t}.parquet") for t in ("documents", "benchmark"))
    grams = {tuple(w[k : k + 8]) for w in (x["text"].lower().split() for x in b.collect()) for k in range(len(w) - 7)}
    hit = {x["doc_id"] for x in d.collect() for w in [x["text"].lower().split()] if sum(tuple(w[k : k + 8]) in grams for k in range(len(w) - 7)) >= 4}
    assert {r["doc_id"] for r in decontam.judge(d, b).filter("contaminated").collect()} == hit


# --------------------------------------------------------------------- LM scoring


def test_lm_scores(spark, docs, odd, empty):
    import public_tokenizers

    pattern, good = regex.compile(public_tokenizers.PATTERN), {r["doc_id"] for r in docs.collect() if r["doc_id"] % 3 == 0}
    texts = {r["doc_id"]: [None, *pattern.findall(r["text"])] for r in docs.collect()}
    models = [Counter(), Counter()]
    own = {k: Counter(w) + Counter(zip(w, w[1:], strict=False)) for k, w in texts.items()}
    for k, c in own.items():
        for m in (0, 1) if k in good else (1,):
            models[m].update(c)
    tokens = {t for w in texts.values() for t in w[1:]}
    masses = [sum(len(w) - 1 for k, w in texts.items() if m or k in good) for m in (0, 1)]

    def loss(m, k, before, token):
        mine, scale = m or k in good, masses[0] / masses[m]
        left = lambda unit: scale * (models[m][unit] - mine * own[k][unit])
        single = (left(token) + lm_score.SMOOTHING) / (scale * (masses[m] - mine * (len(texts[k]) - 1)) + lm_score.SMOOTHING * len(tokens))
        return -math.log((left((before, token)) + lm_score.BACK_OFF * single) / (left(before) + lm_score.BACK_OFF))

    target = docs.filter("doc_id % 3 = 0").select("doc_id")
    got, small = by_id(lm_score.score(docs, target)), by_id(lm_score.score(docs, target, block_bytes=5000))
    for k, w in texts.items():
        want = sum(loss(0, k, a, b) - loss(1, k, a, b) for a, b in zip(w, w[1:], strict=False)) / max(len(w) - 1, 1)
        assert got[k]["n_tokens"] == len(w) - 1 and abs(got[k]["score"] - want) < 1e-9 and abs(small[k]["score"] - want) < 1e-9
    found = lm_score.score(odd, odd.filter("doc_id = 8").select("doc_id")).collect()
    assert len(found) == len(ODD) and {r["score"] for r in found if r["doc_id"] in (1, 2)} == {0.0}
    assert {r["score"] for r in lm_score.score(odd, odd.limit(0).select("doc_id")).collect()} == {0.0}
    assert lm_score.score(empty, odd.select("doc_id")).count() == 0


def test_rows_for_buckets_are_not_in_the_table_too(spark, docs, monkeypatch):
    """What is dealt to buckets is on disk once, in the shuffle; the table has blocks' documents alone."""
    tables, write = [], common.bucketed
    monkeypatch.setattr(common, "bucketed", lambda *a: tables.append(write(*a)) or tables[-1])
    assert lm_score.score(docs, docs.select("doc_id"), block_bytes=5000).count() == docs.count()
    found = [r["bucket"] for r in tables[0].select("bucket").collect()]
    assert len(found) > 1 and set(found) == {-1}


def test_order_of_words_counts(spark):
    """A document scores by what follows what: shuffled, it reads less like the target."""
    rng = random.Random(3)
    lines = [[f"{chr(97 + k)}{x}" for x in "abcdefgh"] for k in range(20)]
    text = lambda: " ".join(" ".join(rng.choice(lines)) for _ in range(20))
    mixed = lambda: " ".join(rng.sample([w for line in lines for w in line], 160))
    rows = [(k, text()) for k in range(60)] + [(100 + k, mixed()) for k in range(60)]
    got = by_id(lm_score.score(spark.createDataFrame(rows, "doc_id long, text string"), spark.range(0, 40).withColumnRenamed("id", "doc_id")))
    assert max(got[k]["score"] for k in range(60)) < min(got[100 + k]["score"] for k in range(60))


# --------------------------------------------------------------------- Simple-8b


def library():
    from tokenizers import Tokenizer

    return Tokenizer.from_file(simple8b.tokenizer_path())


def test_token_files(spark, docs, odd, empty):
    tokenizer = library()
    end = "<|endoftext|>"
    special = spark.createDataFrame(enumerate([end, f"a{end}b", f"{end}{end} x  {end}", f"tail  {end}", f"  {end}\n\n{end}y", end[:-1], f"{end[:-2]}{end}|>", f"é{end}漢 {end}", f"{'word ' * 3000}{end}{' word' * 3000}"]), "doc_id long, text string")
    for df in (docs, odd.filter("doc_id is not null and doc_id <> 7"), special):
        at, found = 0, by_id(simple8b.round_trip(df))
        for r in sorted(df.collect(), key=lambda r: r["doc_id"]):
            ids = [*tokenizer.encode(r["text"] or "", add_special_tokens=False).ids, 0]
            own = found[r["doc_id"]]
            assert (own["start"], own["n_tokens"], own["ids_crc32"]) == (at, len(ids), zlib.crc32(np.array(ids, "<u4").tobytes())), r["text"]
            at += len(ids)
    assert simple8b.round_trip(odd).count() == len(ODD) and simple8b.round_trip(empty).count() == 0


def test_one_id_of_many_rows(spark):
    tokenizer = library()
    rows = [(7, f"text {k % 50} " * 3) for k in range(2000)] + [(None, f"none {k}") for k in range(500)] + [(9, "last")]
    got = simple8b.round_trip(spark.createDataFrame(rows, "doc_id long, text string")).collect()
    at, want = 0, []
    for k, t in sorted(rows, key=lambda r: (r[0] is not None, r[0] or 0, r[1])):
        ids = [*tokenizer.encode(t, add_special_tokens=False).ids, 0]
        want.append((k, at, len(ids), zlib.crc32(np.array(ids, "<u4").tobytes())))
        at += len(ids)
    assert sorted(map(tuple, got), key=lambda r: r[1]) == want


def test_added_tokens_at_every_step_size(monkeypatch):
    import pyarrow as pa

    tokenizer, encode = library(), simple8b.word_encoder(simple8b.tokenizer_path())
    rng = random.Random(2)
    parts = ["<|endoftext|>", "<|endoftext|", "|>", " ", "  ", "word", "é", "\n", "'ll", "12"]
    texts = ["".join(rng.choice(parts) for _ in range(rng.randrange(30))) for _ in range(300)] + [None]
    want = [[*tokenizer.encode(t or "", add_special_tokens=False).ids, 0] for t in texts]
    split = common.split_pieces
    for step in (1, 17, 1000, 4 << 20):
        monkeypatch.setattr(common, "split_pieces", lambda raw, off, step=step: split(raw, off, step))
        lengths, ids = simple8b.encode_batch(pa.array(texts), encode, 0)
        assert lengths.tolist() == [len(w) for w in want] and ids.tolist() == [i for w in want for i in w]


# ----------------------------------------------------------------------- toxicity


def test_toxicity(spark, odd, empty):
    d, l = (spark.read.parquet(f"/root/testdata/sf0.1/{t}.parquet") for t in ("documents", "labels"))
    own = d.join(l.select("doc_id", "toxic"), "doc_id").filter("lang = 'en' and length(text) < 6000").cache()
    model = toxicity.train(own.drop("toxic"), own.select("doc_id", "toxic"))
    got = toxicity.predict(own, model).join(own.select("doc_id", "toxic"), "doc_id").collect()
    assert all(r["held_out"] == (zlib.crc32(str(r["doc_id"]).encode()) % 5 == 0) and 0 <= r["score"] <= 1 and r["predicted"] == int(r["score"] >= 0.5) for r in got)
    held = [r for r in got if r["held_out"]]
    toxic, clean = [r["score"] for r in held if r["toxic"]], [r["score"] for r in held if not r["toxic"]]
    assert np.mean([a > b for a in toxic for b in clean]) > 0.9 and np.mean(np.array(clean) < 0.5) > 0.9
    found = toxicity.predict(odd, model).collect()
    assert len(found) == len(ODD) and len({r["score"] for r in found if r["doc_id"] in (1, 2, 3)}) == 1
    assert toxicity.score(empty, l.limit(0)).count() == 0
    assert {r["score"] for r in toxicity.score(odd, l.limit(0)).collect()} == {0.0}


def test_unseen_misspellings(spark):
    rng = random.Random(8)
    bad = "blockhead numbskull dimwitted scoundrel wretched imbecile".split()
    clean = ["".join(rng.choice("bcdfglmnprst") + rng.choice("aeiou") for _ in range(rng.randint(2, 4))) for _ in range(400)]

    def text(*words):
        own = [rng.choice(clean) for _ in range(rng.randint(20, 60))]
        for w in words:
            own.insert(rng.randrange(len(own)), w)
        return " ".join(own)

    def misspelt(w):
        k = rng.randrange(1, len(w) - 1)
        return rng.choice([w[:k] + w[k + 1 :], w[:k] + w[k] + w[k:], w[:k] + "*" + w[k + 1 :]])

    model = toxicity.fit([text(rng.choice(bad), rng.choice(bad)) for _ in range(400)] + [text() for _ in range(400)], [1] * 400 + [0] * 400)
    seen = np.array(toxicity.score_batch(model, __import__("pyarrow").array([text(misspelt(rng.choice(bad)), misspelt(rng.choice(bad))) for _ in range(200)])))
    other = np.array(toxicity.score_batch(model, __import__("pyarrow").array([text() for _ in range(200)])))
    # 0.81 when written, where no n-gram of a word but those of its own letters helps
    assert (seen >= 0.5).mean() > 0.75 and (other >= 0.5).mean() < 0.05


def test_the_toxicity_sample_does_not_depend_on_order_copies_or_length(spark, monkeypatch):
    drawn = []
    monkeypatch.setattr(toxicity, "fit", lambda texts, labels: drawn.append((texts, labels)))
    rows = [(k, f"text {k} " * (1 if k % 2 else 4000)) for k in range(60)]
    d, l = spark.createDataFrame(rows, "doc_id long, text string"), spark.createDataFrame([(k, k // 30) for k in range(60)], "doc_id long, toxic int")
    toxicity.train(d, l)
    toxicity.train(d.orderBy("text").unionByName(d).repartition(5), l.orderBy(-l["doc_id"]))
    assert drawn[0] == drawn[1] and any(len(t) > 16384 for t in drawn[0][0])
    monkeypatch.setattr(toxicity, "SAMPLE_BYTES", 500_000)
    toxicity.train(d, l)
    assert 0 < len(drawn[2][0]) < len(drawn[0][0]) and {len(t) > 16384 for t in drawn[2][0]} == {True, False}


def test_checkpoint_dir_is_the_sessions(spark):
    assert common.checkpoint_dir(spark) == (spark.conf.get("spark.checkpoint.dir", None) or storage.OWN_FOLDER).rstrip("/")
