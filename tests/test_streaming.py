"""State, refills and sources of streams, batch after batch."""

import datetime
import json
import random
import time

import pandas as pd

from corpusflow.sources import feeds, sinks
from corpusflow.streaming import items, latest, refill

ROW = "url string, pub_ts timestamp_ntz, arrived int, body string, big long"
DAY = lambda k: None if k is None else datetime.datetime(1969 if k < 0 else 2024, 1, abs(k) or 1, 1, 2, 3, 456)


def feed(spark, path, rows):
    spark.createDataFrame([(u, DAY(d), a, b, 2**60 + 1 if b == "big" else None) for u, d, a, b in rows], ROW).coalesce(1).write.mode("append").parquet(path)


BATCHES = [
    [("u1", 1, 1, "a"), ("u1", 2, 2, "b"), ("u2", None, 3, "no date"), ("u3", -5, 4, "old"), (None, 3, 5, "no url"), ("u4", 4, 6, "big")],
    [("u1", 2, 7, "refetched"), ("u2", -3, 8, "dated"), ("u3", None, 9, "undated"), ("u4", 4, 6, "big")],
    [("u1", 1, 10, "late"), ("u5", None, 11, "x"), ("u5", None, 12, "y")],
]
WANT = {"u1": "refetched", "u2": "dated", "u3": "old", "u4": "big", "u5": "y"}


def test_latest_by_state(spark, tmp_path):
    source, path, check = (str(tmp_path / x) for x in ("in", "out", "state"))
    grown = []
    for batch in BATCHES:
        feed(spark, source, batch)
        latest.follow(spark.readStream.schema(ROW).parquet(source), path, check, "url", ["pub_ts", "arrived"]).awaitTermination()
        grown.append(spark.read.parquet(path).count())
    got = {r["url"]: r for r in latest.current(spark, path, "url").collect()}
    assert {u: r["body"] for u, r in got.items()} == WANT and got["u4"]["big"] == 2**60 + 1 and got["u4"]["pub_ts"] == DAY(4) and got["u5"]["pub_ts"] is None
    assert grown == [4, 6, 7]  # what did not change is not written again
    latest.follow(spark.readStream.schema(ROW).parquet(source), path, check, "url", ["pub_ts", "arrived"]).awaitTermination()
    assert spark.read.parquet(path).count() == 7


class Kept(dict):
    """A group's map, and how often it is asked."""

    asked = 0

    def getMapState(self, *_):
        return self

    def iterator(self):
        self.asked += 1
        return iter(list(self.items()))

    def getValue(self, key):
        self.asked += 1
        return self.get(key)

    def updateValue(self, key, value):
        self.asked += 1
        self[key] = value


def test_a_key_that_does_not_change_is_not_asked_for_by_itself():
    keep, kept = latest.KeepLatest(), Kept()
    keep.init(kept)

    def batch(keys, place, row):
        kept.asked = 0
        frame = pd.DataFrame([(str(k), place, f"{row}{k}") for k in keys], columns=["key_", "place_", "row_"])
        return [list(r) for told in keep.handleInputRows(("0",), iter([frame[:30], frame[30:]]), None) for r in told.to_numpy()], kept.asked

    every = range(100)
    assert batch(every, "1b", "x") == ([[f"x{k}", 1, False] for k in every], 101)
    assert batch(every, "1b", "x") == batch(every, "1a", "y") == ([], 1)
    assert batch([*every, *every], "1b", "z")[0] == [[f"z{k}", 2, False] for k in every]  # of equals the later arrival
    # few of many: no more is read than some times what came, the others one by one
    assert batch([99, 0, 100], "1c", "w") == ([["w99", 3, False], ["w0", 3, False], ["w100", 1, False]], 6)
    assert kept["5",] == ("1b", "z5", 2, 0)


def test_latest_by_state_of_many_keys(spark, tmp_path, monkeypatch):
    """Groups of many keys over several batches, against plain Python; some batches are few of a group's keys."""
    monkeypatch.setattr(latest, "GROUPS", 3)
    rng, want = random.Random(5), {}
    source, path, check = (str(tmp_path / x) for x in ("in", "out", "state"))
    for n, size in enumerate((300, 300, 9)):
        rows = [(f"u{rng.randrange(80)}", rng.randrange(1, 20), 1000 * n + k, f"{n} {k}") for k in range(size)]
        feed(spark, source, rows)
        for r in rows:
            want[r[0]] = max(want.get(r[0], r), r, key=lambda x: x[1:3])
        latest.follow(spark.readStream.schema(ROW).parquet(source), path, check, "url", ["pub_ts", "arrived"]).awaitTermination()
        assert {r["url"]: r["body"] for r in latest.current(spark, path, "url").collect()} == {u: r[3] for u, r in want.items()}


def test_keys_that_nothing_comes_for_are_gone(spark, tmp_path):
    source, path, check = (str(tmp_path / x) for x in ("in", "out", "state"))
    feed(spark, source, [("u1", 1, 1, "a")])
    query = latest.follow(spark.readStream.schema(ROW).parquet(source), path, check, "url", ["pub_ts"], keep_ms=500, processingTime="1 second")
    try:
        end, told = time.time() + 45, []
        while time.time() < end and not any(told):
            time.sleep(1)
            told = [r["gone_"] for r in spark.read.parquet(path).collect()] if list((tmp_path / "out").glob("part-*.parquet")) and (tmp_path / "out" / "_spark_metadata" / "0").exists() else []
    finally:
        query.stop()
    assert sorted(told) == [False, True] and latest.current(spark, path, "url").count() == 0


def test_upsert_takes_the_later_of_equals(spark, tmp_path):
    source, path = str(tmp_path / "in"), str(tmp_path / "table")
    for batch in BATCHES:
        feed(spark, source, [r for r in batch if r[0]])
        items.upsert(spark.readStream.schema(ROW).parquet(source), path, str(tmp_path / "state")).awaitTermination()
    got = {r["url"]: r["body"] for r in sinks.read(spark, path).collect()}
    assert {**got, "u5": "y"} == WANT and got["u5"] in "xy"


def test_refill_asks_only_for_blank_slots(spark, tmp_path):
    path, check = str(tmp_path / "slots"), str(tmp_path / "check")
    rows = [(d, p, f"text {d} {p}", "kept" if p == 0 else None) for d in range(3) for p in range(3)]
    sinks.append(spark.createDataFrame(rows, "doc_id long, pos int, text string, out string"), path, "first")
    asked = []

    def ask(df):
        found = df.collect()
        asked.append(sorted((r["doc_id"], r["pos"]) for r in found))
        return spark.createDataFrame([(r["doc_id"], r["pos"], "" if (r["doc_id"], r["pos"]) == (1, 1) and len(asked) < 4 else r["text"].upper()) for r in found], "doc_id long, pos int, out string")

    run = lambda **how: refill.refill(spark, path, check, ask, **how).awaitTermination()
    state = lambda: {(r["doc_id"], r["pos"]): r["out"] for r in refill.slots(spark, path).collect()}
    run(max_slots=4)
    assert asked == [[(0, 1), (0, 2), (1, 1), (1, 2)]] and state()[0, 1] == "TEXT 0 1" and state()[2, 2] == "" and state()[1, 0] == "kept"
    run()
    assert asked[1:] == [[(1, 1), (2, 1), (2, 2)]]
    once = state()
    run()
    assert asked[2:] == [[(1, 1)]] and state() == once  # it failed again, and nothing else is asked
    sinks.append(spark.createDataFrame([(9, 0, "more", None), (0, 0, "text 0 0", "")], "doc_id long, pos int, text string, out string"), path, "second")
    run()
    assert asked[3:] == [[(0, 0), (1, 1), (9, 0)]] and all(state().values())
    run()
    run()
    assert len(asked) == 4
    assert sinks.append(spark.range(1), path, "second") == 0


def test_feeds_as_a_stream(spark, tmp_path):
    box = tmp_path / "feeds"
    box.mkdir()
    entry = lambda link, at: (link, "T", None, at if at and at[0] == "M" else None, None if at and at[0] == "M" else at, None, "s", None, None)
    put = lambda name, *rows: (box / name).write_text(json.dumps([entry(*r) for r in rows]))
    folder = str(box)

    def fetch(url):
        import json
        import pathlib

        return [tuple(e) for e in json.loads((pathlib.Path(folder) / url.split("/")[-1]).read_text())]

    urls = ["https://a.example/x?y=1,2/one", "https://a.example/two", "https://a.example/gone"]
    put("one", ("1", "2024-01-01T00:00:00Z"), ("2", "2024-01-02T00:00:00Z"))
    put("two", ("u", None), ("m", "Mon, 01 Jan 2024 00:00:00 +0000"))
    spark.dataSource.register(feeds.feed_source(fetch, per_task=2))

    def new():
        query = spark.readStream.format("feed").option("feeds", json.dumps(urls)).load().writeStream.format("parquet").option("checkpointLocation", str(tmp_path / "c")).trigger(availableNow=True).start(str(tmp_path / "out"))
        query.awaitTermination()
        return sorted((r["feed"].split("/")[-1], r["link"]) for r in spark.read.parquet(str(tmp_path / "out")).collect())

    first = [("one", "1"), ("one", "2"), ("two", "m"), ("two", "u")]
    assert new() == first and new() == first
    put("one", ("2", "2024-01-02T00:00:00Z"), ("2b", "2024-01-02T00:00:00+00:00"), ("3", "2024-01-03T00:00:00Z"), ("0", "2023-12-01"))
    put("two", ("u", None), ("v", None))
    put("gone", ("g", "2024-01-01"))
    assert new() == sorted([*first, ("one", "2b"), ("one", "3"), ("two", "v"), ("gone", "g")])
