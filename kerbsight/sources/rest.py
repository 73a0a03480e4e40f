"""A Spark data source for services that answer in pages of JSON, such as those of districts and other public registers.

    spark.dataSource.register(PagedJson)
    spark.read.format("paged_json").option("url", "https://...").option("items", "_embedded.districts").schema("code string, ...").load()

The driver asks for the first page only, to learn how many there are. Ranges of pages are the partitions, and each task
fetches its own, one after the other, so nothing but a page is in memory and a lost task only repeats its range.
"""

from __future__ import annotations

import json
import time
import urllib.error
import urllib.parse
import urllib.request
from collections.abc import Iterator
from dataclasses import dataclass

from pyspark.sql.datasource import DataSource, DataSourceReader, InputPartition
from pyspark.sql.types import BooleanType, DoubleType, FloatType, IntegralType, StringType, StructType

#: Answers after which a request is tried again: too many requests, and failures of the server.
AGAIN = (429, 500, 502, 503, 504)


class Options:
    """Options of the source; names are as Spark gives them, in lower case.

    url; items, the dotted path of the list within a page; pagesize and the names of the parameters for page and size
    (pageparam, sizeparam); total, the dotted path of the number of pages; next, that of the address of the next page, for
    services that don't tell a number; partitions, the most tasks; timeout in seconds, retries and wait between them;
    header.NAME for request headers; param.NAME for further parameters.
    """

    def __init__(self, given: dict[str, str]):
        given = {k.lower(): v for k, v in given.items()}
        if not given.get("url"):
            raise ValueError("paged_json needs the option url")
        self.url, self.items = given["url"], given.get("items", "")
        self.total, self.next = given.get("total", "page.totalPages"), given.get("next", "_links.next.href")
        self.page_param, self.size_param, self.size = given.get("pageparam", "page"), given.get("sizeparam", "_pageSize"), int(given.get("pagesize", "100"))
        self.first, self.partitions = int(given.get("firstpage", "1")), int(given.get("partitions", "8"))
        self.timeout, self.retries, self.wait = float(given.get("timeout", "5")), int(given.get("retries", "3")), float(given.get("wait", "0.5"))
        self.headers = {k[7:]: v for k, v in given.items() if k.startswith("header.")}
        self.params = {k[6:]: v for k, v in given.items() if k.startswith("param.")}
        if min(self.size, self.partitions) < 1:
            raise ValueError("pagesize and partitions must be 1 or more")

    def address(self, page: int) -> str:
        parts = urllib.parse.urlsplit(self.url)
        query = urllib.parse.parse_qsl(parts.query) + [*self.params.items(), (self.page_param, str(page)), (self.size_param, str(self.size))]
        return urllib.parse.urlunsplit(parts._replace(query=urllib.parse.urlencode(query)))


def at_path(value, path: str):
    """What lies at a dotted path, None where a step is missing."""
    for step in filter(None, path.split(".")):
        value = value.get(step) if isinstance(value, dict) else None
    return value


def fetch(options: Options, address: str) -> dict | list:
    """One page; failures that may pass are tried again, with growing pauses."""
    for attempt in range(options.retries + 1):
        try:
            request = urllib.request.Request(address, headers={"Accept": "application/json"} | options.headers)
            with urllib.request.urlopen(request, timeout=options.timeout) as answer:  # noqa: S310
                return json.load(answer)
        except urllib.error.HTTPError as e:
            if e.code not in AGAIN or attempt == options.retries:
                raise RuntimeError(f"{address}: answer {e.code}") from e
        except (urllib.error.URLError, TimeoutError, ConnectionError) as e:
            if attempt == options.retries:
                raise RuntimeError(f"{address}: {e}") from e
        time.sleep(options.wait * 2**attempt)
    raise AssertionError


def items_of(page: dict | list, path: str) -> list:
    """The items of a page; a page without the list is an error, as it isn't what was asked for."""
    found = at_path(page, path) if path else page
    if not isinstance(found, list):
        raise RuntimeError(f"no list at {path or 'the top'} of the answer")
    return found


def converted(value, kind):
    """A JSON value as one of a column's type; objects and lists become JSON text; what doesn't fit is null."""
    if value is None:
        return None
    if isinstance(kind, StringType):
        return value if isinstance(value, str) else json.dumps(value, separators=(",", ":"))
    if isinstance(kind, BooleanType):
        return value if isinstance(value, bool) else None
    try:
        if isinstance(kind, (DoubleType, FloatType)):
            return float(value)
        if isinstance(kind, IntegralType):
            return int(value)
    except (TypeError, ValueError):
        return None
    raise TypeError(f"columns of {kind.simpleString()} aren't read; take string and from_json")


@dataclass
class Pages(InputPartition):
    """Pages from first up to before last; without last, from there by the links to the next page."""

    first: int
    last: int | None


class PagedReader(DataSourceReader):
    def __init__(self, options: Options, schema: StructType):
        self.options, self.schema = options, schema

    def partitions(self) -> list[Pages]:
        """Ranges of pages of about equal length; one partition where the service doesn't tell how many pages it has."""
        o = self.options
        total = at_path(fetch(o, o.address(o.first)), o.total)
        if total is None:
            return [Pages(o.first, None)]
        total = int(total)
        n = max(1, min(o.partitions, total))
        edges = [o.first + total * k // n for k in range(n + 1)]
        return [Pages(a, b) for a, b in zip(edges, edges[1:], strict=False)]

    def read(self, partition: Pages) -> Iterator[tuple]:
        o = self.options
        if partition.last is not None:
            for page in range(partition.first, partition.last):
                yield from self._rows(fetch(o, o.address(page)))
            return
        address, seen = o.address(partition.first), set()
        while address and address not in seen:
            seen.add(address)
            page = fetch(o, address)
            yield from self._rows(page)
            link = at_path(page, o.next)
            address = urllib.parse.urljoin(address, link) if link else None

    def _rows(self, page: dict | list) -> Iterator[tuple]:
        for item in items_of(page, self.options.items):
            yield tuple(converted(at_path(item, f.name), f.dataType) for f in self.schema.fields)


class PagedJson(DataSource):
    """Items of all pages as rows. Columns are dotted paths within an item; missing ones are null."""

    @classmethod
    def name(cls) -> str:
        return "paged_json"

    def schema(self) -> StructType:
        raise ValueError("paged_json needs a schema")

    def reader(self, schema: StructType) -> PagedReader:
        return PagedReader(Options(dict(self.options)), schema)
