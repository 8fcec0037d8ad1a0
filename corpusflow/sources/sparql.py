"""SPARQL sources: queries by text, results as rows, through an injected client.

The engine brings no network client (see ``fetch``). Endpoints are a configuration:
only hosts that the caller lists are asked, by ``https``.
"""

from __future__ import annotations

import json
import time
from collections.abc import Callable, Iterable, Iterator
from dataclasses import dataclass, field
from urllib.parse import quote, urlsplit

from pyspark.sql import types as T
from pyspark.sql.datasource import DataSource, DataSourceReader, EqualTo, Filter, GreaterThan, In, InputPartition

from corpusflow.sources import fetch

PREFIXES = {
    "rdfs": "http://www.w3.org/2000/01/rdf-schema#",
    "wdt": "http://www.wikidata.org/prop/direct/",
    "wd": "http://www.wikidata.org/entity/",
}
#: Items are entities whose name begins so; properties and lexemes are not.
ITEM_PREFIX = "http://www.wikidata.org/entity/Q"
#: Results of a page of terms, pages of a class, children of a class, candidates for a root.
PAGE, PAGES, CHILDREN, ROOTS = 1000, 3, 2000, 6
ATTEMPTS, PAUSE = 6, 0.5


def text(value: str) -> str:
    """A string literal."""
    return '"' + value.replace("\\", "\\\\").replace('"', '\\"').replace("\n", "\\n") + '"'


def roots_query(label: str, language: str = "en") -> str:
    """Items with a label that are a subclass of something."""
    return f"SELECT DISTINCT ?item WHERE {{ ?item rdfs:label {text(label)}@{language} ; wdt:P279 ?parent . {_is_item('item')} }} LIMIT {ROOTS}"


def children_query(item: str) -> str:
    """Direct subclasses of an item."""
    return f"SELECT DISTINCT ?item WHERE {{ ?item wdt:P279 wd:{_name(item)} . {_is_item('item')} }} LIMIT {CHILDREN}"


def terms_query(cls: str, after: str = "", languages: tuple[str, str] = ("en", "zh")) -> str:
    """A page of a class's instances with labels in both languages, in order of item."""
    labels = " ".join(f"?item rdfs:label ?{v} . FILTER(LANG(?{v}) = {text(lang)})" for v, lang in zip(("en", "zh"), languages, strict=True))
    beyond = f"FILTER(STR(?item) > {text(after)})" if after else ""
    return f"SELECT ?item ?en ?zh WHERE {{ ?item wdt:P31 wd:{_name(cls)} . {labels} {beyond} }} ORDER BY STR(?item) LIMIT {PAGE}"


def _is_item(variable: str) -> str:
    return f"FILTER(STRSTARTS(STR(?{variable}), {text(ITEM_PREFIX)}))"


def _name(item: str) -> str:
    if not item.isalnum():
        raise ValueError(f"not an item: {item!r}")
    return item


class Refused(RuntimeError):
    """An endpoint answered, but not the question."""


def bindings(answer: dict) -> list[dict[str, str]]:
    """The rows of an answer; raises ``Refused`` for one that has none to give."""
    rows = answer.get("results", {}).get("bindings")
    if rows is None or answer.get("exception") or answer.get("status") == "ERROR":
        raise Refused(f"no result: {answer.get('exception') or answer.get('status') or 'not a result'}"[:200])
    return [{name: cell["value"] for name, cell in row.items()} for row in rows]


@dataclass
class Endpoint:
    """Asks one endpoint; a failed request is sent again after growing waits."""

    url: str
    client: Callable[[str], fetch.Response]
    hosts: set[str] = field(default_factory=set)
    resolve: Callable[[str], list[str]] | None = None
    sleep: Callable[[float], None] = time.sleep

    def rows(self, query: str) -> list[dict[str, str]]:
        """The bindings of a query, a dict of values each."""
        prefixes = "".join(f"PREFIX {k}: <{v}>\n" for k, v in PREFIXES.items())
        url = f"{self.url}?query={quote(prefixes + query)}"
        if not fetch.allowed(url, self.resolve, ("https",), self.hosts or {urlsplit(self.url).hostname or ""}):
            raise ValueError(f"not allowed: {self.url}")
        return bindings(fetch.json_of(url, self.client, attempts=ATTEMPTS, sleep=self.sleep, resolve=self.resolve, wait=lambda k: min(30.0, 4.0 * (k + 1))))

    def terms(self, cls: str, after: str = "") -> Iterator[tuple[str, str, str]]:
        """``(item, en, zh)`` of a class, page after page, of items beyond ``after``; for ``graph.harvest``."""
        for page in range(PAGES):
            if page:
                self.sleep(PAUSE)
            found = self.rows(terms_query(cls, after))
            yield from ((r["item"].rsplit("/", 1)[-1], r["en"], r["zh"]) for r in found)
            if len(found) < PAGE:
                return
            after = found[-1]["item"]

    def items(self, query: str) -> list[str]:
        return [r["item"].rsplit("/", 1)[-1] for r in self.rows(query)]


# ------------------------------------------------------------------ the data source

#: Classes of a task.
PER_TASK = 4
TERM = T.StructType([T.StructField(c, T.StringType()) for c in ("class", "item", "en", "zh")])


class TermReader(DataSourceReader):
    """Terms of classes; filters on class and item become part of the requests.

    ``class = x`` and ``class IN (...)`` choose the classes that are asked, and ``item > x``
    is where the first page begins. Other filters stay with Spark, and so does ``item > x``
    where the source orders names otherwise than Spark does.
    """

    def __init__(self, endpoint: Endpoint, classes: list[str], per_task: int):
        self.endpoint, self.classes, self.after, self.per_task = endpoint, list(dict.fromkeys(classes)), "", per_task

    def pushFilters(self, filters: list[Filter]) -> Iterable[Filter]:
        for f in filters:
            if isinstance(f, EqualTo) and f.attribute == ("class",):
                self.classes = [c for c in self.classes if c == f.value]
            elif isinstance(f, In) and f.attribute == ("class",):
                self.classes = [c for c in self.classes if c in f.value]
            else:
                if isinstance(f, GreaterThan) and f.attribute == ("item",):
                    self.after = max(self.after, f.value)
                yield f

    def partitions(self) -> list[InputPartition]:
        return [InputPartition(self.classes[k : k + self.per_task]) for k in range(0, len(self.classes), self.per_task)]

    def read(self, partition: InputPartition) -> Iterator[tuple]:
        for cls in partition.value if partition is not None else []:
            after = ITEM_PREFIX.removesuffix("Q") + self.after if self.after else ""
            for item, en, zh in self.endpoint.terms(cls, after):
                yield (cls, item, en, zh)


def term_source(endpoint: Endpoint, per_task: int = PER_TASK) -> type[DataSource]:
    """A data source ``sparql_terms``: ``class, item, en, zh``; option ``classes``: a JSON array.

    Filters reach the requests where ``spark.sql.python.filterPushdown.enabled`` is true.
    """

    class TermSource(DataSource):
        @classmethod
        def name(cls) -> str:
            return "sparql_terms"

        def schema(self) -> T.StructType:
            return TERM

        def reader(self, schema) -> DataSourceReader:
            return TermReader(endpoint, json.loads(self.options["classes"]), per_task)

    return TermSource
