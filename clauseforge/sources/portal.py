"""A listing portal as a Spark data source: one partition per category and page.

``spark.read.format("listing_portal")`` with options ``base``, ``pages`` (how many per category), ``categories`` (JSON map of
name to path; default below), ``params`` (JSON), ``fetcher`` ("module:function", default an HTTP getter with retries).
A failed page has ``html`` null and its error in ``error`` instead of failing the job.
"""

from __future__ import annotations

import importlib
import json
import time
import urllib.error
import urllib.parse
import urllib.request
from collections.abc import Callable, Iterator

from pyspark.sql import SparkSession
from pyspark.sql.datasource import DataSource, DataSourceReader, InputPartition

# Listing categories with their paths, and what a page request carries.
CATEGORIES = {
    "Acts": "/acts",
    "Rules": "/rules",
    "Regulations": "/regulations",
    "Consolidated & Gazette Notified Regulations": "/consolidated-gazette-notified-regulations",
    "Updated Regulations": "/updated-regulations",
    "Notifications": "/notifications",
    "Circulars": "/circulars",
    "Guidelines": "/guidelines",
    "Orders": "/orders1",
    "Notices": "/notices1",
    "Exposure Drafts": "/exposure-drafts",
}
PER_PAGE, MOST_PAGES, RETRIES, BACKOFF, TIMEOUT, RETRY_STATUS = 20, 250, 4, 1.5, 40, (429, 500, 502, 503, 504)


def page_params(cur: int, portlet: str = "", per_page: int = PER_PAGE) -> dict[str, str]:
    """Query of page ``cur``; a portal that routes by portlet needs its name in the query too."""
    base = {"p_p_id": portlet.strip("_"), "p_p_lifecycle": "0", "p_p_state": "normal", "p_p_mode": "view"} if portlet else {}
    return base | {f"{portlet}delta": str(per_page), f"{portlet}cur": str(cur)}


def http_get(url: str) -> str:
    """The body of ``url``; busy and failing servers are asked again with growing pauses."""
    for attempt in range(RETRIES + 1):
        try:
            with urllib.request.urlopen(url, timeout=TIMEOUT) as answer:  # noqa: S310
                return answer.read().decode(answer.headers.get_content_charset() or "utf-8", "replace")
        except urllib.error.HTTPError as e:
            if e.code not in RETRY_STATUS or attempt == RETRIES:
                raise
        except (urllib.error.URLError, TimeoutError):
            if attempt == RETRIES:
                raise
        time.sleep(BACKOFF * 2**attempt)
    raise AssertionError


class _Page(InputPartition):
    def __init__(self, category: str, url: str, cur: int, query: str):
        self.category, self.url, self.cur, self.query = category, url, cur, query


class _Reader(DataSourceReader):
    def __init__(self, options: dict[str, str]):
        self.options = options

    def partitions(self) -> list[InputPartition]:
        o = self.options
        categories = json.loads(o["categories"]) if "categories" in o else CATEGORIES
        only = set(json.loads(o["only"])) if "only" in o else set(categories)
        last = min(int(o.get("pages", 1)), MOST_PAGES)
        out: list[InputPartition] = []
        for name, path in categories.items():
            url = urllib.parse.urljoin(o["base"], path)
            out += [_Page(name, url, cur, urllib.parse.urlencode(page_params(cur, o.get("portlet", "")))) for cur in range(1, last + 1) if name in only]
        return out

    def read(self, partition: _Page) -> Iterator[tuple]:
        module, _, name = self.options.get("fetcher", f"{__name__}:http_get").partition(":")
        fetch: Callable[[str], str] = getattr(importlib.import_module(module), name)
        try:
            html, error = fetch(f"{partition.url}?{partition.query}"), None
        except Exception as e:  # one bad page must not end the scan
            html, error = None, f"{type(e).__name__}: {e}"[:500]
        yield partition.category, partition.cur, partition.url, html, error


class ListingPortal(DataSource):
    @classmethod
    def name(cls) -> str:
        return "listing_portal"

    def schema(self) -> str:
        return "category string, cur int, url string, html string, error string"

    def reader(self, schema) -> DataSourceReader:  # noqa: ANN001
        return _Reader(dict(self.options))


def register(spark: SparkSession) -> None:
    spark.dataSource.register(ListingPortal)
