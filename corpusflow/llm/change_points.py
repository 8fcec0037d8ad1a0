"""Penalised change points of daily series (operator 13).

A key's series is the sum of a value for each day, from its first to its last day
with rows; days between without any count 0. It is cut into segments of at least
``min_days`` days so that the segments' costs, plus ``penalty`` a cut, are least.

Rows are summed by key and day before anything else moves, so a hot key is as many
rows from each task as it has days. What then meets in one place is a series: a
number a day. Series are dealt out by key and cut in batches.

The dynamic programme over a series (``cut``) is solved by CDQ divide and conquer:
the left half first; then blocked min-plus kernels push what its positions give to
the right half; then the right half. Keys are sums of ``cost * (days + 1) + 1``, so
of equal costs the fewest segments win; a position's predecessors are pushed in
ascending order and only a smaller key replaces what is there, so of equal keys the
earliest predecessor stays. A block is left out where even a segment without cost
could not better any of its positions.

Integers are exact: 64 bits where a whole series fits, Python's own beyond.

Cases: rows without a value or without a time take no part, repeated rows count
each, rows without a key are one series (of key null); a key without any row has no
segment; a series shorter than ``min_days`` is one segment; an empty table gives an
empty result; further columns are ignored. Times are read without a zone. A series
is worked on by one task, in time that grows with the square of its days (but for
what is left out) and in memory in proportion to them.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from corpusflow.llm import common as C
from corpusflow.shipping import ship

MIN_DAYS, PENALTY = 14, 40_000
#: Positions a side of a kernel, and cells of a kernel over all series of a batch.
SIDE, CELLS = 64, 1 << 18
_INF = 1 << 62
_OUT = {"segment_no": pa.int32(), **dict.fromkeys(("first_day", "n_days", "total", "spread", "cost", "n_segments", "best_cost"), pa.int64())}


def daily(rows: DataFrame, key: str, at: str, value: str) -> DataFrame:
    """``key_, day_, total_``: sums of ``value`` by key and day."""
    own = rows.select(F.col(f"`{key}`").alias("key_"), F.unix_date(F.to_date(F.col(f"`{at}`"))).alias("day_"), F.col(f"`{value}`").cast("long").alias("value_"))
    return own.filter("day_ IS NOT NULL AND value_ IS NOT NULL").groupBy("key_", "day_").agg(F.sum("value_").alias("total_"))


def segments(rows: DataFrame, key: str, at: str, value: str, min_days: int = MIN_DAYS, penalty: int = PENALTY) -> DataFrame:
    """``key, segment_no, first_day, n_days, total, spread, cost, n_segments, best_cost``, a row a segment."""
    ship(rows.sparkSession)
    kind = rows.schema[key].dataType
    series = daily(rows, key, at, value).groupBy("key_").agg(F.array_sort(F.collect_list(F.struct("day_", "total_"))).alias("series_"))

    def run(batches):
        for batch in batches:
            lists = batch.column("series_")
            off = lists.offsets.to_numpy()
            days, totals = (x.to_numpy(zero_copy_only=False) for x in lists.values.flatten())
            for part, found in cut_all(off, days, totals, min_days, penalty):
                named = dict(zip(_OUT, found, strict=True))
                keys = batch.column("key_").take(pa.array(part))
                yield pa.RecordBatch.from_arrays([keys, *[pa.array(named[c], t) for c, t in _OUT.items()]], names=["key_", *_OUT])

    out = "key_ " + kind.simpleString() + ", segment_no int, " + ", ".join(f"{c} long" for c in list(_OUT)[1:])
    return series.mapInArrow(C.in_worker(run), out).withColumnRenamed("key_", key)


def cut_all(off: np.ndarray, days: np.ndarray, totals: np.ndarray, min_days: int, penalty: int):
    """Batches of ``(series, columns of _OUT)`` of many series, those of like length together."""
    first, last = days[off[:-1]].astype(np.int64), days[off[1:] - 1].astype(np.int64)
    n = last - first + 1
    order = np.argsort(n, kind="stable")
    at = 0
    while at < len(order):
        # as many as fill a kernel, whose longest is not much longer than the shortest
        some = order[at : at + max(1, CELLS // SIDE**2)]
        some = some[n[some] <= n[some[0]] * 1.25 + SIDE]
        at += len(some)
        x = np.zeros((len(some), int(n[some[-1]])), np.int64)
        for row, k in enumerate(some):
            x[row, days[off[k] : off[k + 1]] - first[k]] = totals[off[k] : off[k + 1]]
        found = cut(x, n[some], min_days, penalty)
        part = np.repeat(some, [len(f) for f, _ in found])
        rows = [(s + 1, int(first[k]) + i, j - i, total, spread, cost, len(f), best) for k, (f, best) in zip(some, found, strict=True) for s, (i, j, total, spread, cost) in enumerate(f)]
        yield part, list(zip(*rows, strict=True))


def _spread(n, s, q):
    """``V``, exact."""
    return 1 + (n * q - s * s) // (n * n)


def _cost(n, v):
    return n * np.floor(1000 * np.log(v.astype(np.float64))).astype(np.int64)


def cut(x: np.ndarray, n: np.ndarray, min_days: int = MIN_DAYS, penalty: int = PENALTY) -> list[tuple[list[tuple], int]]:
    """For each row of ``x`` (its first ``n`` values): ``[(start, end, sum, spread, cost)]`` and the least cost."""
    many, longest = x.shape
    biggest = int(np.abs(x).sum(axis=1, dtype=np.float64).max()) + 1
    exact = np.int64 if biggest**2 * max(longest, 2) < _INF else object
    x = x.astype(exact)
    zero = np.zeros((many, 1), exact)
    s, q = (np.concatenate([zero, np.cumsum(y, axis=1)], axis=1) for y in (x, x * x))
    unit = longest + 1
    best = np.full((many, longest + 1), _INF, np.int64)
    best[:, 0] = 0
    before = np.zeros((many, longest + 1), np.int64)

    def push(a: int, b: int, c: int, d: int) -> None:
        """What positions ``a`` to ``b`` give to ``c`` to ``d``."""
        own = best[:, a:b]
        if np.all(own.min(axis=1) + penalty * unit + 1 > best[:, c:d].max(axis=1)):
            return
        i, j = np.arange(a, b), np.arange(c, d)[:, None]
        days = j - i
        some = np.maximum(days, 1)
        v = _spread(some, s[:, c:d, None] - s[:, None, a:b], q[:, c:d, None] - q[:, None, a:b])
        key = own[:, None, :] + (_cost(some, v) + penalty) * unit + 1
        key[:, days < min_days] = _INF
        at = key.argmin(axis=2)  # the first of equals
        least = np.take_along_axis(key, at[..., None], axis=2)[..., 0]
        less = least < best[:, c:d]
        best[:, c:d][less] = least[less]
        before[:, c:d][less] = at[less] + a

    def solve(lo: int, hi: int) -> None:
        if hi - lo <= max(min_days, 1):  # no two positions are a segment apart
            return
        mid = (lo + hi) // 2
        solve(lo, mid)
        for a in range(lo, mid, SIDE):
            for c in range(mid, hi, SIDE):
                if min(c + SIDE, hi) - 1 - a >= min_days:
                    push(a, min(a + SIDE, mid), c, min(c + SIDE, hi))
        solve(mid, hi)

    solve(0, longest + 1)
    out = []
    for k in range(many):
        j, found = int(n[k]), []
        while j:
            i = int(before[k, j]) if n[k] >= min_days else 0
            v = _spread(j - i, int(s[k, j]) - int(s[k, i]), int(q[k, j]) - int(q[k, i]))
            found.append((i, j, int(s[k, j]) - int(s[k, i]), v, int(_cost(j - i, np.array(v)))))
            j = i
        out.append((found[::-1], sum(f[4] for f in found) + penalty * (len(found) - 1)))
    return out


#: Position by position, each with all its predecessors.
ORACLE = f"""WITH RECURSIVE d AS (SELECT vendor_id, CAST(shipped_at AS DATE) - DATE '1970-01-01' AS day, CAST(sum(quantity) AS HUGEINT) AS x FROM sale_lines WHERE quantity IS NOT NULL AND shipped_at IS NOT NULL GROUP BY ALL),
 r AS (SELECT vendor_id, min(day) AS a, max(day) - min(day) + 1 AS n FROM d GROUP BY vendor_id),
 e AS (SELECT r.vendor_id, a, n, k, coalesce(x, 0) AS x FROM (SELECT *, unnest(range(n)) AS k FROM r) r LEFT JOIN d ON d.vendor_id IS NOT DISTINCT FROM r.vendor_id AND d.day = a + k),
 c AS (SELECT vendor_id, a, n, k, sum(x) OVER w AS s, sum(x * x) OVER w AS q FROM e WINDOW w AS (PARTITION BY vendor_id ORDER BY k)),
 p AS (SELECT vendor_id, any_value(a) AS a, any_value(n) AS n, list_prepend(0::HUGEINT, list(s ORDER BY k)) AS s, list_prepend(0::HUGEINT, list(q ORDER BY k)) AS q FROM c GROUP BY vendor_id),
 f AS (SELECT *, 0::BIGINT AS j, [{{'c': 0::BIGINT, 'm': 0::BIGINT, 'i': 0::BIGINT}}] AS f FROM p
  UNION ALL SELECT vendor_id, a, n, s, q, j + 1, list_append(f, CASE WHEN j + 1 >= {MIN_DAYS} THEN list_min([{{'c': f[i + 1].c + {PENALTY} + (j + 1 - i) * CAST(floor(1000 * ln(CAST(
   1 + ((j + 1 - i) * (q[j + 2] - q[i + 1]) - (s[j + 2] - s[i + 1]) * (s[j + 2] - s[i + 1])) // ((j + 1 - i) * (j + 1 - i)) AS DOUBLE))) AS BIGINT), 'm': f[i + 1].m + 1, 'i': i}} FOR i IN range(0, j + 2 - {MIN_DAYS}) IF f[i + 1] IS NOT NULL]) END) FROM f WHERE j < n),
 t AS (SELECT vendor_id, a, n, s, q, f, n AS j, CASE WHEN n < {MIN_DAYS} THEN 0 ELSE f[n + 1].i END AS i FROM f WHERE j = n
  UNION ALL SELECT vendor_id, a, n, s, q, f, i, f[i + 1].i FROM t WHERE i > 0),
 g AS (SELECT vendor_id, a + i AS first_day, j - i AS n_days, s[j + 1] - s[i + 1] AS total, 1 + ((j - i) * (q[j + 1] - q[i + 1]) - (s[j + 1] - s[i + 1]) * (s[j + 1] - s[i + 1])) // ((j - i) * (j - i)) AS spread FROM t),
 h AS (SELECT *, n_days * CAST(floor(1000 * ln(CAST(spread AS DOUBLE))) AS BIGINT) AS cost FROM g)
SELECT vendor_id, CAST(row_number() OVER (PARTITION BY vendor_id ORDER BY first_day) AS INTEGER) AS segment_no, CAST(first_day AS BIGINT) AS first_day, CAST(n_days AS BIGINT) AS n_days, CAST(total AS BIGINT) AS total, CAST(spread AS BIGINT) AS spread,
 CAST(cost AS BIGINT) AS cost, count(*) OVER v AS n_segments, CAST(sum(cost) OVER v + {PENALTY} * (count(*) OVER v - 1) AS BIGINT) AS best_cost FROM h WINDOW v AS (PARTITION BY vendor_id)"""
