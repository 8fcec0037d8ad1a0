"""Page fetching with an injected client: retries, spacing by host, guarded redirects.

The engine brings no network client. A client is ``get(url) -> Response``; it
follows no redirects by itself.
"""

from __future__ import annotations

import contextlib
import ipaddress
import json
import random
import re
import time
from collections.abc import Callable, Iterator
from dataclasses import dataclass
from urllib.parse import urljoin, urlsplit

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from corpusflow.functions import text as T
from corpusflow.shipping import ship

#: Attempts, hops, seconds between pages of a host, waits after an HTTP and another error.
ATTEMPTS, HOPS, SPACING = 3, 5, 2.5
HTTP_WAIT, OTHER_WAIT = 6.0, 1.5
#: Seconds that chance adds to a pause, at most.
JITTER = 1.5
#: Seconds in which all tasks of a barrier hear what one of them said.
HEARD = 2.0
SCHEMA = "url string, body binary, status int, error string"
_RESERVED_NAME = re.compile(r"(?:localhost|.*\.(?:local|internal|localhost))$", re.I)
_NUMBERS = re.compile(r"(?:0x[0-9a-f]*|\d+)(?:\.(?:0x[0-9a-f]*|\d+))*", re.I)


@dataclass
class Response:
    status: int
    body: bytes = b""
    location: str | None = None


def public(address: str) -> bool:
    """Whether an address literal is one of the public internet."""
    own = ipaddress.ip_address(address.partition("%")[0])
    own = getattr(own, "ipv4_mapped", None) or own
    return own.is_global and not (own.is_multicast or own.is_reserved or own.is_unspecified or own.is_loopback or own.is_link_local)


def allowed(url: str, resolve: Callable[[str], list[str]] | None = None, schemes: tuple[str, ...] = ("http", "https"), hosts: set[str] | None = None) -> bool:
    """The guard of every request and redirect: scheme, host name, address.

    ``resolve(host)`` gives the addresses of a name, all of which must be public; it
    raises if there is none. Without it only what is an address already is judged:
    also one that is written as a single or an octal or hexadecimal number.
    """
    try:
        parts = urlsplit(url)
        host = (parts.hostname or "").lower().rstrip(".")
        parts.port  # noqa: B018  raises if it is none
    except ValueError:
        return False
    if parts.scheme not in schemes or not host or _RESERVED_NAME.match(host) or hosts is not None and host not in hosts:
        return False
    with contextlib.suppress(ValueError):
        return public(host)
    if _NUMBERS.fullmatch(host):  # resolvers read these as addresses, in one way or another
        return False
    if resolve is None:
        return True
    try:
        found = resolve(host)
    except OSError:
        return False
    return bool(found) and all(public(a) for a in found)


def loopback(url: str, port: int | None = None) -> str:
    """``url`` if it is one of this machine's own, for a model server beside the engine."""
    parts = urlsplit(url)
    if parts.scheme != "http" or parts.hostname not in ("127.0.0.1", "localhost", "::1") or port is not None and parts.port != port:
        raise ValueError(f"not a local endpoint: {url[:100]}")
    return url


def get(url: str, client: Callable[[str], Response], attempts: int = ATTEMPTS, sleep: Callable[[float], None] = time.sleep, resolve: Callable[[str], list[str]] | None = None, wait: Callable[[int], float] | None = None) -> Response:
    """One page, through guarded redirects; waits grow with the attempt (``wait`` of its number, if given), client errors end at once."""
    error: Exception | None = None
    for k in range(attempts):
        try:
            at = url
            for _ in range(HOPS + 1):
                if not allowed(at, resolve):
                    raise ValueError(f"not allowed: {at}")
                found = client(at)
                if found.location is None:
                    break
                at = urljoin(at, found.location)
            else:
                raise ValueError("too many redirects")
            if found.status < 400 or found.status < 500 and found.status != 429:
                return found
            error = OSError(f"status {found.status}")
            pause = HTTP_WAIT * (k + 1)
        except ValueError:
            raise
        except Exception as e:
            error, pause = e, OTHER_WAIT * (k + 1)
        if k + 1 < attempts:
            sleep(wait(k) if wait else pause)
    raise error or OSError("no attempt")


def fetch(urls: DataFrame, client: Callable[[str], Response], spacing: float = SPACING, sleep: Callable[[float], None] = time.sleep, jitter: float = JITTER, resolve: Callable[[str], list[str]] | None = None, one_by_one: bool = False) -> DataFrame:
    """``url, body, status, error`` of allowed urls: a host's pages one after another, spaced.

    Hosts are dealt out over the tasks, or with ``one_by_one`` all pages follow one
    another, for a client that must send one request at a time to whatever host; a
    pause is ``spacing`` and up to ``jitter`` seconds more. A failed page is a row.
    Write the result once: a second use would fetch again.
    """

    def run(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        last: dict[str, float] = {}
        for frame in frames:
            out = []
            for url in frame["url"]:
                host = "" if one_by_one else urlsplit(url).hostname or ""
                rest = last.get(host, 0.0) + spacing + random.uniform(0, jitter) - time.monotonic()
                if host in last and rest > 0:
                    sleep(rest)
                try:
                    r = get(url, client, sleep=sleep, resolve=resolve)
                    out.append((url, r.body, r.status, None))
                except Exception as e:
                    out.append((url, None, None, str(e)[:200]))
                last[host] = time.monotonic()
            yield pd.DataFrame(out, columns=["url", "body", "status", "error"]).astype({"status": "Int32"})

    ship(urls.sparkSession)
    own = urls.select("url").filter(T.url_allowed(F.col("url"))).distinct()
    own = own.repartition(1) if one_by_one else own.repartition(T.url_host(F.col("url")))
    return own.mapInPandas(run, SCHEMA)


def fetch_together(urls: DataFrame, client: Callable[[str], Response], tasks: int, spacing: float = SPACING, sleep: Callable[[float], None] = time.sleep, resolve: Callable[[str], list[str]] | None = None, of_host: bool = True) -> DataFrame:
    """``fetch`` by ``tasks`` tasks at once, whichever host a page is of: a host with most of the
    pages is read by all of them, and yet no two requests to it are closer than ``spacing``.

    A barrier stage in rounds. In each, every task tells the others which host it will ask
    next and what its clock says. From that all see the same timetable: those with one host
    take turns, a ``spacing`` apart, from a time on at which all have heard of it. A task that
    misses its turn, by more than a tenth of ``spacing``, waits for the next round. Clocks may
    differ by another tenth. Without ``of_host`` all hosts count as one. There must be as
    many free slots as tasks.
    """

    def run(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        from pyspark import BarrierTaskContext

        context = BarrierTaskContext.get()
        own, me = (u for frame in frames for u in frame["url"]), context.partitionId()
        url = next(own, None)
        while True:
            host = "" if url is None else (urlsplit(url).hostname or "?") if of_host else "*"
            said = [json.loads(x) for x in context.allGather(json.dumps([host, time.time()]))]
            if not any(h for h, _ in said):
                return
            if url is None:
                continue
            turn = sum(h == host for h, _ in said[:me])
            slot = max(t for _, t in said) + max(HEARD, spacing) + turn * spacing * 1.2
            sleep(max(0.0, slot - time.time()))
            if time.time() > slot + spacing / 10:
                continue
            try:
                r = get(url, client, attempts=1, sleep=sleep, resolve=resolve)
                row = (url, r.body, r.status, None)
            except Exception as e:
                row = (url, None, None, str(e)[:200])
            url = next(own, None)
            yield pd.DataFrame([row], columns=["url", "body", "status", "error"]).astype({"status": "Int32"})

    ship(urls.sparkSession)
    own = urls.select("url").filter(T.url_allowed(F.col("url"))).distinct()
    return own.repartition(tasks).mapInPandas(run, SCHEMA, barrier=True)


def routed(plain: Callable[[str], Response], special: Callable[[str], Response] | None, hosts: set[str]) -> Callable[[str], Response]:
    """A client that asks some hosts, with their subdomains, through a ``special`` client
    (such as one with a browser's handshake) where there is one, and all others as ever."""

    def client(url: str) -> Response:
        host = (urlsplit(url).hostname or "").lower()
        theirs = any(host == h or host.endswith("." + h) for h in hosts)
        return (special if special and theirs else plain)(url)

    return client


def json_of(url: str, client: Callable[[str], Response], **guard) -> dict:
    """The JSON document at a url, through ``get``."""
    found = get(url, client, **guard)
    if found.status >= 400:
        raise OSError(f"status {found.status}")
    return json.loads(found.body)
