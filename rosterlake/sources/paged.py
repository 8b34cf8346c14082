"""A Spark data source over an interface that gives pages; one partition per independent query.

``fetch`` is given by the caller and imported on the executors by its name, so
that tests and offline runs use landed pages. A cursor is followed inside one
partition; failures are rows with a status, never exceptions.
"""

from __future__ import annotations

import importlib
import json
import time
from collections.abc import Iterator

from pyspark.sql.datasource import DataSource, DataSourceReader, InputPartition


class Query(InputPartition):
    def __init__(self, value: str):
        self.value = value


def fetch_with_retry(fetch, url: str, attempts: int, base: float, most: float, sleep=time.sleep) -> tuple[str, str | None]:
    """(status, body): ok, silent_empty or failed. Waits min(base * 2**n, most) seconds between attempts.

    An answer with total 0 is tried again, as it may be a failure that isn't
    reported; if it stays, its status is silent_empty.
    """
    status, body = "failed", None
    for n in range(attempts):
        try:
            body = fetch(url)
            total = json.loads(body).get("total") if body else None
            status = "silent_empty" if total == 0 else "ok"
        except Exception:  # noqa: BLE001 - whatever the interface raises is a status here
            status, body = "failed", None
        if status == "ok":
            break
        if n + 1 < attempts:
            sleep(min(base * 2**n, most))
    return status, body


class PagedSource(DataSource):
    """Options: fetch (module:function), url (with {q}), queries (JSON list), attempts, base, most, max_pages."""

    @classmethod
    def name(cls) -> str:
        return "pages"

    def schema(self) -> str:
        return "query string, page int, url string, status string, body string"

    def reader(self, schema):
        return PagedReader(self.options)


class PagedReader(DataSourceReader):
    def __init__(self, options):
        self.options = dict(options)

    def partitions(self):
        return [Query(str(q)) for q in json.loads(self.options.get("queries", '[""]'))]

    def read(self, partition: Query) -> Iterator[tuple]:
        module, _, name = self.options["fetch"].partition(":")
        fetch = getattr(importlib.import_module(module), name)
        attempts, base, most = int(self.options.get("attempts", "3")), float(self.options.get("base", "1")), float(self.options.get("most", "30"))
        url, page, seen = self.options["url"].replace("{q}", partition.value), 0, set()
        while url and url not in seen and page < int(self.options.get("max_pages", "1000000")):
            seen.add(url)
            status, body = fetch_with_retry(fetch, url, attempts, base, most)
            yield partition.value, page, url, status, body
            try:
                links = json.loads(body)["link"] if body else []
                url = next((x["url"] for x in links if x.get("relation") == "next"), None)
            except (ValueError, KeyError, TypeError):
                url = None
            page += 1
