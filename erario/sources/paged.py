"""A paged HTTP source: pages are read by tasks, one partition a page."""

from __future__ import annotations

import json
import time
import urllib.error
import urllib.parse
import urllib.request
from collections.abc import Callable, Iterator
from dataclasses import dataclass

from pyspark.sql.datasource import DataSource, DataSourceReader, InputPartition

#: Seconds to wait for an answer, between attempts, and attempts.
TIMEOUT, PAUSE, ATTEMPTS = 30, 1.0, 3


class PageError(RuntimeError):
    """A page could not be read, or its answer doesn't say how many pages there are."""


def http_get(url: str, params: dict[str, str]) -> tuple[int, dict[str, str], str]:
    """(status, headers, body) of one request."""
    try:
        with urllib.request.urlopen(f"{url}?{urllib.parse.urlencode(params)}", timeout=TIMEOUT) as r:
            return r.status, dict(r.headers), r.read().decode()
    except urllib.error.HTTPError as e:
        return e.code, dict(e.headers), ""


def get_page(get: Callable[[str, dict[str, str]], tuple[int, dict[str, str], str]], url: str, params: dict[str, str], pause: float = PAUSE, attempts: int = ATTEMPTS) -> dict:
    """One page as JSON. Status 429 waits as long as Retry-After says, other failures longer each time; then PageError."""
    last = ""
    for n in range(1, attempts + 1):
        try:
            status, headers, body = get(url, params)
            if status == 200:
                return json.loads(body)
            last = f"status {status}"
            wait = float(headers.get("Retry-After", pause * n)) if status == 429 else pause * n
        except OSError as e:
            last, wait = str(e), pause * n
        if n < attempts:
            time.sleep(wait)
    raise PageError(f"{url} {params}: {last}")


def records_of(page: dict) -> list[dict]:
    """Records of a page, under either key that servers use."""
    return page.get("data") or page.get("results") or []


def page_count(page: dict) -> int:
    """Number of pages from the summary (one server misspells its key); PageError where it is missing."""
    total = (page.get("summary") or page.get("sumary") or {}).get("total_pages")
    if total is None:
        raise PageError("the answer has no total_pages")
    return int(total)


@dataclass
class Page(InputPartition):
    """One page of the query."""

    number: int


class PagedReader(DataSourceReader):
    """Asks for the first page on the driver and leaves the pages to the tasks."""

    def __init__(self, options: dict[str, str]):
        self.url = options["url"]
        self.params = {k[6:]: v for k, v in options.items() if k.startswith("param.")}
        self.pause = float(options.get("pause", PAUSE))

    def partitions(self) -> list[Page]:
        first = get_page(http_get, self.url, self.params | {"page": "1"}, self.pause)
        return [Page(i) for i in range(1, page_count(first) + 1)]

    def read(self, partition: Page) -> Iterator[tuple[int, str]]:
        page = get_page(http_get, self.url, self.params | {"page": str(partition.number)}, self.pause)
        for r in records_of(page):
            yield partition.number, json.dumps(r, ensure_ascii=False)


class PagedSource(DataSource):
    """``spark.read.format("erario_paged").option("url", …).option("param.data_inicio", …)`` -> (pagina, registro JSON)."""

    @classmethod
    def name(cls) -> str:
        return "erario_paged"

    def schema(self) -> str:
        return "pagina int, registro string"

    def reader(self, schema) -> PagedReader:
        return PagedReader(dict(self.options))


def pages(get: Callable[[str, dict[str, str]], tuple[int, dict[str, str], str]], url: str, params: dict[str, str], pause: float = PAUSE) -> Iterator[tuple[int, list[dict]]]:
    """(number, records) of all pages, one after the other, for callers without a cluster."""
    n, total = 1, 1
    while n <= total:
        page = get_page(get, url, params | {"page": str(n)}, pause)
        total = page_count(page)
        yield n, records_of(page)
        n += 1
