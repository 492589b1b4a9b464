"""Fetching pages: the protocol, a polite HTTP client, the index walk and a distributed fetch."""

from __future__ import annotations

import re
import threading
import time
import urllib.error
import urllib.request
from collections.abc import Callable, Iterator
from typing import Protocol

import pandas as pd
from pyspark.sql import DataFrame

from . import pages

RETRIED = (429, 500, 502, 503, 504)


class Fetcher(Protocol):
    """Hands back the text of a URL, or raises."""

    def get(self, url: str) -> str: ...


class IndexUnavailable(RuntimeError):
    """The first index page lists no package, which means an outage rather than nothing new."""


class HttpClient:
    """A client with retries, exponential waits, and a least interval between the requests of all its threads.

    With ``pace``, a function that returns when the next request may be made, the interval is that of whoever gives turns.
    """

    def __init__(self, delay: float = 0.0, timeout: float = 45.0, retries: int = 3, opener: Callable | None = None, sleep: Callable[[float], None] = time.sleep, clock: Callable[[], float] = time.monotonic, pace: Callable[[], None] | None = None):
        self.pace = pace
        self.delay, self.timeout, self.retries = max(0.0, delay), timeout, retries
        self._open, self._sleep, self._clock = opener or urllib.request.urlopen, sleep, clock
        self._gate, self._next = threading.Lock(), 0.0

    def _wait_turn(self) -> None:
        if self.pace:
            return self.pace()
        with self._gate:
            now = self._clock()
            if now < self._next:
                self._sleep(self._next - now)
            self._next = max(now, self._next) + self.delay

    def get(self, url: str) -> str:
        failure: Exception | None = None
        for attempt in range(self.retries + 1):
            self._wait_turn()
            wait = 2.0**attempt
            try:
                with self._open(urllib.request.Request(url, headers={"User-Agent": "corpusmill"}), timeout=self.timeout) as reply:
                    headers = getattr(reply, "headers", None)
                    charset = headers.get_content_charset() if headers is not None else None
                    return _decoded(reply.read(), charset)
            except urllib.error.HTTPError as error:
                if error.code not in RETRIED:
                    raise
                asked = (error.headers or {}).get("Retry-After", "")
                failure, wait = error, float(asked) if asked.isdigit() else wait
            except (OSError, TimeoutError) as error:
                failure = error
            self._sleep(wait)
        raise failure


def _decoded(body: bytes, charset: str | None) -> str:
    """The body in the charset that its header names, if there is such a one; UTF-8 otherwise."""
    try:
        return body.decode(charset or "utf-8", "replace")
    except LookupError:
        return body.decode("utf-8", "replace")


def index_url(page: int, base: str = pages.BASE_URL) -> str:
    return base if page == 1 else f"{base}/?page={page}"


def page_links(html: str) -> list[int]:
    """The ids linked from one index page, in order, once each."""
    return list(dict.fromkeys(map(int, re.findall(pages.LINK, re.sub(pages.COMMENT.replace(r"\z", r"\Z"), "", html)))))


def discover(fetcher: Fetcher, settled: frozenset[int] | set[int] = frozenset(), limit: int | None = None) -> list[int]:
    """Walk the index, newest first, for packages that aren't settled.

    The walk ends at a page without packages, at ``limit`` pages, or, without a limit, at a page that has nothing new.
    """
    wanted: dict[int, None] = {}
    seen: set[int] = set()
    page = 0
    while limit is None or page < limit:
        page += 1
        ids = page_links(fetcher.get(index_url(page)))
        if not ids and page == 1:
            raise IndexUnavailable(f"{index_url(1)} lists no packages")
        news = [i for i in ids if i not in seen and i not in settled]
        seen.update(ids)
        wanted.update(dict.fromkeys(news))
        if not ids or not news and limit is None:
            break
    return list(wanted)


def fetch_pages(targets: DataFrame, make_fetcher: Callable[[], Fetcher], workers: int = 8, threads: int = 1) -> DataFrame:
    """id, position, html, error of each target (id, position), fetched in ``workers`` partitions of ``threads`` threads.

    Spark may run a task again; write the result before anything else reads it.
    """
    url = pages.BASE_URL + "/pack/{}"

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        from concurrent.futures import ThreadPoolExecutor

        fetcher = make_fetcher()

        def one(ident: int) -> tuple[str | None, str | None]:
            try:
                return fetcher.get(url.format(ident)), None
            except Exception as error:  # a failure concerns its page only
                return None, str(error)

        with ThreadPoolExecutor(max(1, threads)) as pool:
            for batch in batches:
                for at in range(0, len(batch), 64):
                    part = batch.iloc[at : at + 64]
                    found = list(pool.map(one, part["id"].tolist()))
                    yield pd.DataFrame(
                        {
                            "id": part["id"].to_numpy(), "position": part["position"].to_numpy(),
                            "html": [h for h, _ in found], "error": [e for _, e in found],
                        }
                    )

    return targets.select("id", "position").repartition(max(1, workers)).mapInPandas(
        run, "id bigint, position bigint, html string, error string",
    )
