"""Operators 11 to 13 against their SQL and brute force, and in every odd case."""

import datetime
import hashlib
import math
import random
import re
from collections import Counter

import duckdb
import numpy as np
import pytest
from corpusflow.llm import change_points, hard_negatives, imatch, queries
from pyspark.sql import functions as F

DIR = "/root/testdata/sf0.001"


def equals_sql(spark, name, folder=DIR, **tables):
    """The registered query over ``folder`` gives the rows of its SQL."""
    con = duckdb.connect()
    for t in ("sale_lines", "embeddings", "documents"):
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM '{folder}/{t}.parquet'")
    got, want = queries.queries()[name](spark, folder), con.sql(queries.oracle_sql()[name])
    assert got.columns == want.columns
    rows = sorted(map(tuple, got.collect()), key=str)
    assert rows == sorted(want.fetchall(), key=str)
    return rows


# ------------------------------------------------------------------ change points


def plain_cut(x, min_days, penalty):
    """All segmentations' best by recursion over the last segment: ``(cost, segments, starts from the last)``."""
    def cost(i, j):
        n, s, q = j - i, sum(x[i:j]), sum(v * v for v in x[i:j])
        return n * math.floor(1000 * math.log(1 + (n * q - s * s) // (n * n)))

    best = {0: (0, 0, ())}
    for j in range(1, len(x) + 1):
        found = [(best[i][0] + cost(i, j) + penalty, best[i][1] + 1, (i, *best[i][2])) for i in range(j - min_days + 1) if i in best]
        if found:
            best[j] = min(found)
    if len(x) < min_days:
        return cost(0, len(x)), (0,)
    return best[len(x)][0] - penalty, best[len(x)][2][::-1]


@pytest.mark.parametrize("seed", range(6))
def test_cuts_are_the_best_of_all(seed, monkeypatch):
    monkeypatch.setattr(change_points, "SIDE", 7)
    rng = random.Random(seed)
    series = []
    for k in range(14):
        n = rng.choice([1, 3, 13, 14, 27, 28, 29, 60, 90])
        levels = [rng.choice([0, 0, 5, 40, 10**4]) for _ in range(4)]
        wide = rng.choice([1, 1, 3, 50])
        series.append([levels[i * 4 // n] + rng.randrange(wide) for i in range(n)])
    series += [[0] * 50, [7] * 50, [1, 2] * 30, [-3, 4] * 20]
    days, totals, off = [], [], [0]
    for x in series:
        kept = [i for i, v in enumerate(x) if v or i in (0, len(x) - 1) or rng.random() < 0.5]
        days += [100 + i for i in kept]
        totals += [x[i] for i in kept]
        off.append(len(days))
    for min_days, penalty in ((14, 40_000), (14, 100), (5, 3000), (1, 900), (3, 0)):
        got = {}
        for part, columns in change_points.cut_all(np.array(off), np.array(days), np.array(totals), min_days, penalty):
            for k, row in zip(part, zip(*columns, strict=True), strict=True):
                got.setdefault(int(k), []).append(row)
        for k, x in enumerate(series):
            best, starts = plain_cut(x, min_days, penalty)
            own = got[k]
            assert [r[0] for r in own] == list(range(1, len(starts) + 1))
            assert tuple(r[1] - 100 for r in own) == starts and {r[7] for r in own} == {best} and {r[6] for r in own} == {len(starts)}
            assert sum(r[2] for r in own) == len(x) and sum(r[3] for r in own) == sum(x)


def test_sums_beyond_64_bits():
    x = [10**12 + k % 3 for k in range(40)] + [5] * 40
    (found, best), = change_points.cut(np.array([x]), np.array([80]))
    assert (best, tuple(f[0] for f in found)) == plain_cut(x, 14, 40_000) and len(found) == 2


def test_change_points_equal_sql(spark):
    rows = equals_sql(spark, "op13_change_points")
    assert any(r[1] > 1 for r in rows)


def test_change_points_of_odd_rows(spark):
    day = lambda k, h=0: datetime.datetime(2024, 1, 1, h) + datetime.timedelta(days=k)
    rows = [(1, 5, day(0), "a"), (1, 5, day(0, 23), "a"), (1, 5, day(0, 23), "a"), (1, None, day(-9), "a"), (1, 9, None, "a"), (2, None, day(1), "a"), (None, 4, day(3), None)]
    rows += [(3, 3 if k < 30 else 3000 * (k % 2), day(k), "a") for k in range(60) if k not in (4, 5)]
    df = spark.createDataFrame(rows, "vendor_id long, quantity int, shipped_at timestamp_ntz, day_ string")
    got = change_points.segments(df, "vendor_id", "shipped_at", "quantity")
    own = {(r["vendor_id"], r["segment_no"]): r for r in got.collect()}
    assert set(own) == {(1, 1), (None, 1), (3, 1), (3, 2)}
    assert (own[1, 1]["n_days"], own[1, 1]["total"], own[1, 1]["spread"], own[1, 1]["best_cost"]) == (1, 15, 1, 0)
    assert own[3, 2]["first_day"] - own[3, 1]["first_day"] in (30, 31)
    assert change_points.segments(df.limit(0), "vendor_id", "shipped_at", "quantity").count() == 0


# ----------------------------------------------------------------- hard negatives


def plain_mine(rows, every, limit=2**28):
    """Every anchor against every row; ``rows``: ``(id, label, vector)``."""
    own = []
    for i, label, v in rows:
        if i is None or label is None or not v or any(x is None or not math.isfinite(x) for x in v):
            continue
        most = math.isqrt(2**62 // len(v))
        own.append((i, label, [max(-most, min(most, math.floor(256 * x))) for x in v]))
    out = []
    for a, label, q in own:
        if a % every:
            continue
        scored = sorted((-sum(x * y for x, y in zip(q, r, strict=True)), i, lab) for i, lab, r in own if i != a and len(r) == len(q))
        for p, pid in [(-s, i) for s, i, lab in scored if lab == label][:5]:
            fit = [(-s, i) for s, i, lab in scored if lab != label and 80 * p <= -100 * s <= 100 * p][:5]
            out += [(a, pid, k + 1, i, p, s) for k, (s, i) in enumerate(fit)]
    return sorted(out)


VECTORS = "vec_id long, label int, embedding array<float>, q string, block int"


def test_hard_negatives_equal_sql(spark):
    assert equals_sql(spark, "op11_hard_negatives")


@pytest.mark.parametrize("seed", range(3))
def test_hard_negatives_with_copies_and_odd_rows(spark, monkeypatch, seed):
    """Many copies of one vector, of one id and of one label, small shards, blocks and groups, two lengths."""
    for name, value in (("SHARD", 16), ("BLOCK", 3), ("GROUP", 1)):
        monkeypatch.setattr(hard_negatives, name, value)
    rng = random.Random(seed)
    vector = lambda n, wide=1.0: [float(np.float32(rng.uniform(-wide, wide))) for _ in range(n)]
    common = vector(7)
    rows = [(k, rng.choice([0, 0, 1, 2]), common if k % 3 == 0 else vector(7) if k % 3 == 1 else [x + 0.01 for x in common]) for k in range(90)]
    rows += [(200 + k, k % 2, vector(4, 3e6)) for k in range(30)] + [(30, 0, common)] * 9 + [(40, 1, vector(7))] * 2
    rows += [(None, 1, common), (500, None, common), (510, 1, None), (520, 1, []), (530, 1, [*common[:-1], None]), (540, 1, [*common[:-1], float("nan")]), (550, 1, [*common[:-1], float("inf")]), (-10, 1, common)]
    df = spark.createDataFrame([(*r, "x", 1) for r in rows], VECTORS).repartition(3)
    got = hard_negatives.mine(hard_negatives.quantised(df), F.col("id") % 10 == 0)
    assert sorted(map(tuple, got.collect())) == plain_mine(df.select("vec_id", "label", "embedding").collect(), 10)
    assert hard_negatives.mine(hard_negatives.quantised(df.limit(0)), F.col("id") % 10 == 0).count() == 0


@pytest.mark.parametrize(("dims", "wide"), [(1, 5), (5, 300), (64, 256), (3, 2**30)])
def test_bounds_hold(dims, wide):
    rng = np.random.default_rng(dims)
    q = rng.integers(-wide, wide, (200, dims))
    q[50:120] = q[50]
    codes, ends = hard_negatives.approximate(q)
    for a in q[::20]:
        lower, upper = hard_negatives.bounds(hard_negatives.tables(a, ends), codes)
        score = [int(x) for x in q.astype(object) @ a.astype(object)]
        assert all(lo <= s <= up for lo, s, up in zip(lower, score, upper, strict=True))
        if dims == 64:
            assert np.median(upper - lower) < 0.5 * (max(score) - min(score))


# --------------------------------------------------------------- document prints

M64 = 2**64 - 1


def mixed(x):
    x = ((x ^ (x >> 30)) * 0xBF58476D1CE4E5B9) & M64
    x = ((x ^ (x >> 27)) * 0x94D049BB133111EB) & M64
    return x ^ (x >> 31)


def poly(values):
    return sum(v * pow(0x9E3779B97F4A7C15, k + 1, 2**64) for k, v in enumerate(values)) & M64


def plain_terms(text):
    words = re.findall(rb"[0-9A-Za-z\x80-\xff]+", text.encode())
    return {mixed(poly(b + 1 for b in w.translate(bytes(b + 32 if 65 <= b <= 90 else b for b in range(256))))) & (2**48 - 1) for w in words}


def plain_print(terms, lexicon):
    kept = terms & lexicon
    sign = "+" if kept or not terms else "-"
    kept = kept or terms
    cells = {}
    for seed in range(imatch.SEEDS):
        for h in sorted(kept):
            u = mixed((h + (seed + 1) * 0x9E3779B97F4A7C15) & M64)
            level = min((u & -u).bit_length() - 1 if u else 0, imatch.LEVELS - 1)
            cells.setdefault((seed, level), []).append(mixed(u ^ 0x9E3779B97F4A7C15))
    cell = lambda s, k: max(1, mixed(poly(cells[s, k])) >> 48) if (s, k) in cells else 0
    return f"{sign}{len(kept):08x}" + "".join(f"{cell(s, k):04x}" for s in range(imatch.SEEDS) for k in range(imatch.LEVELS))


def plain_near(a, b):
    """The most likely number of differing terms, tried one by one."""
    if a == b:
        return 1.0
    m, n = (abs(int(x[:9], 16)) for x in (a, b))
    cells = [[x[9 + 4 * k : 13 + 4 * k] for k in range(imatch.SEEDS * imatch.LEVELS)] for x in (a, b)]
    agree = [sum(cells[0][s * imatch.LEVELS + k] == cells[1][s * imatch.LEVELS + k] for s in range(imatch.SEEDS)) for k in range(imatch.LEVELS)]

    def fits(d):
        out = 0.0
        for k, c in enumerate(agree):
            q = min(max((1 - 0.5 ** min(k + 1, imatch.LEVELS - 1)) ** d, 1e-300), 1 - 1e-12)
            out += c * math.log(q) + (imatch.SEEDS - c) * math.log1p(-q)
        return out

    d = max(imatch._TRIED, key=fits)
    d = min(max(d, abs(m - n), 1), max(m + n, 1))
    return (m + n - d) / max(m + n + d, 1)


def plain_prints(rows, key=lambda r: r[0]):
    rows = sorted(rows, key=key)
    found = [plain_terms(t or "") for _, t in rows]
    df = Counter(h for terms in found for h in terms)
    lexicon = {h for h, n in df.items() if n >= 2 and n * 10 <= len(rows)}
    out = []
    for k, (i, t) in enumerate(rows):
        t, after = t or "", rows[(k + 1) % len(rows)][1] or ""
        edited = t[: len(t) - len(t) // 2] + after[: len(t) // 2]
        own, other, follows = plain_print(found[k], lexicon), plain_print(plain_terms(edited), lexicon), plain_print(found[(k + 1) % len(rows)], lexicon)
        out.append((i, len(t), hashlib.sha256(edited.encode()).hexdigest(), own, other, plain_near(own, other), plain_near(own, follows)))
    return out


def same_prints(got, want):
    got = sorted(map(tuple, got.collect()), key=str)
    want = sorted(want, key=str)
    assert [r[:5] for r in got] == [r[:5] for r in want]
    assert np.allclose([r[5:] for r in got], [r[5:] for r in want])


@pytest.mark.parametrize("step", [None, 300])
def test_prints_equal_plain_ones(spark, monkeypatch, step):
    if step:
        monkeypatch.setattr(imatch, "STEP", step)
        monkeypatch.setattr(imatch, "BLOCK_BYTES", 20_000)
    docs = spark.read.parquet(f"{DIR}/documents.parquet")
    got = imatch.prints_and_edits(docs.repartition(5) if step else docs)
    same_prints(got, plain_prints([(r["doc_id"], r["text"]) for r in docs.collect()]))
    plain = {r["doc_id"]: (abs(int(r["fingerprint"][:9], 16)), r["fingerprint"]) for r in got.collect()}
    assert {r["doc_id"]: (r["n_terms"], r["fingerprint"]) for r in imatch.fingerprints(docs, block_bytes=step and 5000 or 1 << 20).collect()} == plain


def test_prints_of_odd_rows(spark):
    rows = [(1, None), (2, ""), (3, " .,- "), (4, "wörd"), (5, "Ünïcode “quotes” it's 12,5 kg\n漢字 😀"), (6, "same text here"), (7, "Same TEXT here"), (9, "a b c " * 30000), (10, "😀" * 7)]
    rows += [(8, "one key of a third of all rows")] * 9 + [(11, "z")]
    df = spark.createDataFrame([(*r, 1, "x", 2) for r in rows], "doc_id long, text string, block int, h string, row int").repartition(4)
    got = imatch.prints_and_edits(df)
    same_prints(got, plain_prints(rows))
    near = {r["doc_id"]: r for r in got.collect()}
    assert near[6]["fingerprint"] == near[7]["fingerprint"] and near[1]["fingerprint"] == near[3]["fingerprint"] and near[8]["near_next"] in (0.0, 1.0)
    lone = imatch.prints_and_edits(df.filter("doc_id = 4"))
    same_prints(lone, plain_prints([(4, "wörd")]))
    without = spark.createDataFrame([(None, "no id"), (3, "three"), (None, "no id")], "doc_id long, text string")
    same_prints(imatch.prints_and_edits(without), plain_prints([(None, "no id"), (None, "no id"), (3, "three")], key=lambda r: -1 if r[0] is None else r[0]))
    assert imatch.prints_and_edits(df.limit(0)).count() == 0 and imatch.fingerprints(df.limit(0)).count() == 0


def test_likeness_follows_the_shared_terms():
    rng = random.Random(3)
    for n, share in ((40, 0.9), (300, 0.5), (300, 0.1), (4000, 0.33), (4000, 0.8)):
        found = []
        for _ in range(30):
            common, a, b = ({rng.getrandbits(48) for _ in range(k)} for k in (int(n * share), int(n * (1 - share) / 2), int(n * (1 - share) / 2)))
            one, two = (imatch.prints(np.sort(np.array(sorted(common | x), np.uint64)), 1, np.zeros(1, bool)) for x in (a, b))
            found.append(float(imatch.likeness(one, two)[0]))
        assert abs(sum(found) / len(found) - share) < 0.1, (n, share)
