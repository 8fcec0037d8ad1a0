"""Sources: channel catalogue, feed files and feed fetching, snapshots, glossary files."""

from __future__ import annotations

import contextlib
import json
from collections.abc import Callable, Iterator
from concurrent.futures import ThreadPoolExecutor
from datetime import datetime, timezone
from email.utils import parsedate_to_datetime

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.datasource import DataSource, DataSourceReader, DataSourceStreamReader, InputPartition
from pyspark.sql.utils import AnalysisException

from corpusflow.functions import text as X
from corpusflow.operators import html

_TEXT, _TEXTS, _INT = T.StringType(), T.ArrayType(T.StringType()), T.IntegerType()


def _schema(**fields: T.DataType) -> T.StructType:
    return T.StructType([T.StructField(k, v) for k, v in fields.items()])


CHANNEL = _schema(id=_TEXT, name=_TEXT, feeds=_TEXTS, full=_TEXT, selectors=_TEXTS, lookback=_INT, ua=_TEXT)
ENTRY = _schema(link=_TEXT, title=_TEXT, author=_TEXT, pubDate=_TEXT, published=_TEXT, updated=_TEXT, summary=_TEXT, description=_TEXT, content=_TEXT)
ITEM = _schema(
    **{k: _TEXT for k in "url title author pubDate summary body channel channelName titleZh summaryZh".split()},
    zhParas=_TEXTS, zhFull=_TEXT, zhDone=_INT, zhChunks=_INT, zhState=_TEXT, zhAt=_TEXT, titleTrans=_TEXT, titleZhLocked=T.BooleanType(),
)
SNAPSHOT = T.StructType([T.StructField("updatedAt", T.StringType()), T.StructField("items", T.ArrayType(ITEM))])
#: Header words of glossary files. Fixed values.
HEADER_WORDS = ["english", "en", "术语", "原文", "term"]
MAX_TERM, MAX_TARGET, MAX_TERMS = 80, 200, 500_000


def channels(spark: SparkSession, catalogue: list[dict]) -> DataFrame:
    """One row for each feed of a channel catalogue, with the catalogue's order."""
    rows = [{f.name: c.get(f.name) for f in CHANNEL} for c in catalogue]
    own = spark.createDataFrame([tuple(r[f.name] for f in CHANNEL) for r in rows], CHANNEL)
    order = F.create_map(*[x for k, c in enumerate(catalogue) for x in (F.lit(c["id"]), F.lit(k))]) if catalogue else F.create_map()
    return own.withColumn("channel_ord", F.element_at(order, F.col("id"))).select("*", F.posexplode("feeds").alias("feed_ord", "feed"))


def feed_files(spark: SparkSession, path: str, row_tag: str = "item") -> DataFrame:
    """Entries of RSS (``item``) or Atom (``entry``) files."""
    return spark.read.format("xml").option("rowTag", row_tag).option("ignoreNamespace", True).schema(ENTRY).load(path)


def entries(raw: DataFrame) -> DataFrame:
    """Feed entries as items: fields chosen, cleaned and cut.

    Where a column ``full`` says ``content``, the entry's content, else its summary, is
    the body, through the fragment route and the cleaner; elsewhere the body is the
    page's and stays empty here. A column ``authors`` (names) stands in for a missing
    author.
    """
    content = F.coalesce(F.col("full") == "content", F.lit(False)) if "full" in raw.columns else F.lit(False)
    said = X.or_else(F.col("summary"), F.col("description"))
    raw_body = F.when(content, X.or_else(F.col("content"), said)).otherwise(said)
    when = F.coalesce(X.timestamp(F.col("published")), X.timestamp(F.col("updated")), X.timestamp(F.col("pubDate")))
    keep = [c for c in raw.columns if c not in (*ENTRY.names, "authors")]
    names = F.col("authors") if "authors" in raw.columns else F.array().cast("array<string>")
    own = raw.filter(F.trim(F.coalesce("link", F.lit(""))) != "").select(
        *keep,
        F.trim("link").alias("url"),
        X.collapse(X.strip_gallery(F.col("title"))).alias("title"),
        X.collapse(X.authors(X.strip_tags(F.col("author")), names)).alias("author"),
        when.alias("pub_ts"),
        raw_body.alias("raw_body"),
        F.when(content, html.fragment(raw_body)).otherwise("").alias("whole_"),
    )
    own = own.withColumn("body", X.clean_body(F.col("whole_"))).drop("whole_")
    return own.withColumn("summary", X.summary(X.or_else(F.col("body"), F.col("raw_body"))))


def channel_status(rows: DataFrame, by: str = "feed_channel") -> DataFrame:
    """``by, n, status, error, feed_errors``: a channel fails only if no feed of it gave an
    entry and one failed; how many rows say that a feed failed stands beside it."""
    ok = (F.col("status") == "ok") & (F.coalesce("link", F.lit("")) != "")
    errors = F.sort_array(F.collect_set("error"))  # a message a feed, at most
    own = rows.groupBy(by).agg(F.count_if(ok).alias("n"), F.count_if(F.col("status") == "error").alias("feed_errors"), F.substring(F.array_join(errors, "; "), 1, 400).alias("error"))
    failed = (F.col("n") == 0) & (F.col("error") != "")
    return own.select(by, "n", F.when(failed, "error").otherwise("ok").alias("status"), F.when(failed, F.col("error")).alias("error"), "feed_errors")


#: Feeds of a task.
PER_TASK = 32
_LINK, _DATES = ENTRY.names.index("link"), [ENTRY.names.index(c) for c in ("published", "updated", "pubDate")]


def moment(entry: tuple) -> int | None:
    """When an entry is of, in microseconds since 1970; None: it does not say."""
    for at in _DATES:
        raw = (entry[at] or "").strip()
        with contextlib.suppress(ValueError, TypeError):
            found = datetime.fromisoformat(raw) if raw[:4].isdigit() else parsedate_to_datetime(raw)
            found = found if found.tzinfo else found.replace(tzinfo=timezone.utc)
            return round(found.timestamp() * 1_000_000)
    return None


def seen(entries: list[tuple]) -> dict:
    """What a feed has: its newest moment, the links of that moment, and the links that have none."""
    dated = [(m, e[_LINK]) for e in entries if (m := moment(e)) is not None]
    newest = max((m for m, _ in dated), default=None)
    return {"at": newest, "links": sorted({u or "" for m, u in dated if m == newest}), "undated": sorted({e[_LINK] or "" for e in entries if moment(e) is None})}


def is_new(entry: tuple, start: dict | None, end: dict) -> bool:
    """Whether an entry came after what ``start`` has seen, and no later than ``end``."""
    at, link = moment(entry), entry[_LINK] or ""
    if at is None:
        return link in end["undated"] and (start is None or link not in start["undated"])
    if end["at"] is None or at > end["at"] or at == end["at"] and link not in end["links"]:
        return False
    return start is None or start["at"] is None or at > start["at"] or at == start["at"] and link not in start["links"]


def _groups(urls: list, per_task: int) -> list[InputPartition]:
    return [InputPartition(urls[k : k + per_task]) for k in range(0, len(urls), per_task)]


class FeedReader(DataSourceReader):
    def __init__(self, urls: list[str], fetch: Callable[[str], list[tuple]], per_task: int):
        self.urls, self.fetch, self.per_task = urls, fetch, per_task

    def partitions(self) -> list[InputPartition]:
        return _groups(self.urls, self.per_task)

    def read(self, partition: InputPartition) -> Iterator[tuple]:
        for url in partition.value:
            try:
                for k, row in enumerate(self.fetch(url)):
                    yield (url, k, *row, "ok", None)
            except Exception as e:  # a broken feed is a row, not a failed scan
                yield (url, 0, *[None] * len(ENTRY.names), "error", str(e)[:200])


class FeedStreamReader(DataSourceStreamReader):
    """Entries that are new since the last batch; the offset maps each feed to what it had.

    ``latestOffset`` looks at the feeds from the driver, some at a time, through ``look``; a
    feed that can't be looked at keeps its offset. A task then fetches its feeds' entries
    between two offsets; if that fails the batch fails, and is read again, so that none is lost.
    """

    def __init__(self, urls: list[str], fetch: Callable[[str], list[tuple]], look: Callable[[str], dict], per_task: int):
        self.urls, self.fetch, self.look, self.per_task, self.last = urls, fetch, look, per_task, {}

    def initialOffset(self) -> dict:
        return {}

    def latestOffset(self) -> dict:
        def one(url: str) -> str | None:
            with contextlib.suppress(Exception):
                return json.dumps(self.look(url))
            return self.last.get(url)

        with ThreadPoolExecutor(16) as pool:
            found = zip(self.urls, pool.map(one, self.urls), strict=True)
        self.last = {u: x for u, x in found if x is not None}
        return self.last

    def partitions(self, start: dict, end: dict) -> list[InputPartition]:
        self.last = {**start, **self.last}
        moved = [(u, json.loads(start[u]) if u in start else None, json.loads(x)) for u, x in sorted(end.items()) if start.get(u) != x]
        return _groups(moved, self.per_task)

    def read(self, partition: InputPartition) -> Iterator[tuple]:
        for url, start, end in partition.value:
            for k, entry in enumerate(self.fetch(url)):
                if is_new(entry, start, end):
                    yield (url, k, *entry, "ok", None)


def feed_source(fetch: Callable[[str], list[tuple]], look: Callable[[str], dict] | None = None, per_task: int = PER_TASK) -> type[DataSource]:
    """A data source ``feed`` over ``fetch(url) -> entries``, for batches and streams.

    Options: ``feeds``, a JSON array of urls, or ``urls``, comma-separated where no url
    has a comma. ``look(url)`` tells what ``seen`` tells, where there is a cheaper way
    than to fetch. A task reads ``per_task`` feeds.
    """
    told = look or (lambda url: seen(fetch(url)))

    class FeedSource(DataSource):
        @classmethod
        def name(cls) -> str:
            return "feed"

        def schema(self) -> T.StructType:
            return T.StructType([T.StructField("feed", T.StringType()), T.StructField("entry_ord", T.IntegerType()), *ENTRY.fields, T.StructField("status", T.StringType()), T.StructField("error", T.StringType())])

        def _urls(self) -> list[str]:
            if "feeds" in self.options:
                return json.loads(self.options["feeds"])
            return [u for u in self.options["urls"].split(",") if u]

        def reader(self, schema) -> DataSourceReader:
            return FeedReader(self._urls(), fetch, per_task)

        def streamReader(self, schema) -> DataSourceStreamReader:
            return FeedStreamReader(self._urls(), fetch, told, per_task)

    return FeedSource


def snapshot(spark: SparkSession, *paths: str) -> DataFrame:
    """Items of the first path that holds a snapshot; none: no items."""
    for path in paths:
        try:
            found = spark.read.schema(SNAPSHOT).option("multiLine", True).json(path).filter(F.col("items").isNotNull())
            if not found.isEmpty():
                return found.select(F.posexplode("items").alias("ord", "i")).select("ord", "i.*")
        except AnalysisException:
            continue
    return spark.createDataFrame([], T.StructType([T.StructField("ord", T.IntegerType()), *ITEM.fields]))


def glossary_file(spark: SparkSession, path: str, limit: int = MAX_TERMS) -> DataFrame:
    """``term, target`` of a two-column text file: split at the first separator, no
    quoting; the last of equal terms wins."""
    lines = spark.read.text(path, wholetext=False).withColumn("ord", F.monotonically_increasing_id())
    value = X.strip(F.regexp_replace("value", "^﻿", ""))
    cut = F.split(value, r"[\t,]", 2)
    own = lines.filter((value != "") & ~value.startswith("#")).select("ord", F.lower(X.strip(cut[0])).alias("term"), X.strip(F.get(cut, F.lit(1))).alias("target"))
    own = own.filter((F.col("term") != "") & (F.col("target") != "") & ~F.col("term").isin(HEADER_WORDS) & (F.length("term") <= MAX_TERM) & (F.length("target") <= MAX_TARGET))
    return own.groupBy("term").agg(F.max_by("target", "ord").alias("target"), F.min("ord").alias("ord")).orderBy("ord").limit(limit).drop("ord")


def decoded(raw):
    """Bytes as text, invalid sequences dropped."""
    return F.regexp_replace(F.make_valid_utf8(raw.cast("string")), "�", "")
