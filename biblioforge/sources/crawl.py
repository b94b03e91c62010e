"""Catalogue crawler: a site behind an interface as a Spark data source, for batch and streaming reads.

A catalogue lists items page by page below each category. The source reads a category in one partition (in ranges of
pages where the catalogue knows how many there are), page after page until one is missing or max_pages is reached. As a
stream, its offsets are the pages read of each category, so a restarted query goes on where it stopped and pages that
appear later are read then. A crawl that may catch up takes as many pages in a batch as it has read before, in tasks of
equal ranges, so its batches grow with the logarithm of the site. A page that can't be read is one row with its error,
and the crawl goes on after it.
"""

from __future__ import annotations

import json
import time
from abc import ABC, abstractmethod
from collections.abc import Iterator
from dataclasses import dataclass
from urllib.parse import parse_qsl, urlencode, urlsplit, urlunsplit

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.datasource import DataSource, DataSourceReader, DataSourceStreamReader, InputPartition

from biblioforge.store import fresh, numbered_within

ITEM_DDL = "category string, segment string, subsegment string, page int, pos int, url string, title string, fields map<string,string>, error string"


@dataclass(frozen=True)
class Category:
    url: str
    segment: str
    subsegment: str


class Catalogue(ABC):
    """What a crawler knows of a site. Instances are pickled and used on the executors."""

    @abstractmethod
    def has(self, url: str) -> bool:
        """Whether a listing page exists and has items; asked on the driver by streams, so it should be cheap."""

    @abstractmethod
    def listing(self, url: str) -> list[dict]:
        """Items of a listing page: url, title and any other fields."""

    def details(self, url: str) -> dict:
        """More fields of an item."""
        return {}

    def pages(self, category: Category) -> int | None:
        """How many listing pages a category has, where the site says so."""
        return None


def page_url(category: str, page: int) -> str:
    """Address of a listing page: pn=page from the second page on."""
    if page == 1:
        return category
    parts = urlsplit(category)
    return urlunsplit(parts._replace(query=urlencode([*parse_qsl(parts.query, keep_blank_values=True), ("pn", page)])))


@dataclass
class Span(InputPartition):
    """Pages first..last of a category; last is None where only the site knows."""

    category: Category
    first: int
    last: int | None


@dataclass
class Crawl:
    """A catalogue, its categories, and how they are crawled."""

    catalogue: Catalogue
    categories: list[Category]
    max_pages: int | None = None
    with_details: bool = False
    delay: float = 0.0
    pages_per_task: int = 50
    pages_per_batch: int = 50
    catch_up: bool = False

    def rows(self, span: Span) -> Iterator[tuple]:
        c, page = span.category, span.first
        while (span.last is None or page <= span.last) and (self.max_pages is None or page <= self.max_pages):
            url = page_url(c.url, page)
            if page > span.first and self.delay:
                time.sleep(self.delay)
            try:
                if span.last is None and not self.catalogue.has(url):
                    return
                items = self.catalogue.listing(url)
            except Exception as e:  # a page that can't be read is a row, so that one page doesn't end the job
                yield (c.url, c.segment, c.subsegment, page, None, url, None, None, type(e).__name__)
                items = []
            for pos, item in enumerate(items):
                fields, error = {k: str(v) for k, v in item.items() if k not in ("url", "title") and v is not None}, None
                if self.with_details and item.get("url"):
                    try:
                        fields |= {k: str(v) for k, v in self.catalogue.details(item["url"]).items() if v is not None}
                    except Exception as e:  # the item stays as the listing has it
                        error = type(e).__name__
                yield (c.url, c.segment, c.subsegment, page, pos, item.get("url"), item.get("title"), fields, error)
            page += 1

    def ranges(self, category: Category, first: int, last: int) -> list[Span]:
        return [Span(category, k, min(last, k + self.pages_per_task - 1)) for k in range(first, last + 1, self.pages_per_task)]

    def spans(self) -> list[Span]:
        out = []
        for c in self.categories:
            n = self.catalogue.pages(c)
            if n is None:
                out.append(Span(c, 1, None))
            else:
                n = n if self.max_pages is None else min(n, self.max_pages)
                out += self.ranges(c, 1, n)
        return out


class _Reader(DataSourceReader):
    def __init__(self, crawl: Crawl):
        self.crawl = crawl

    def partitions(self):
        return self.crawl.spans() or [Span(Category("", "", ""), 1, 0)]

    def read(self, partition):
        yield from self.crawl.rows(partition)


class _StreamReader(DataSourceStreamReader):
    """Offsets: {category: pages read}. A batch takes up to pages_per_batch further pages of each category; to catch up, up to as many as were read before."""

    def __init__(self, crawl: Crawl):
        self.crawl, self.now = crawl, {}

    def initialOffset(self) -> dict:
        return {c.url: 0 for c in self.crawl.categories}

    def latestOffset(self) -> dict:
        out = self.initialOffset() | self.now
        for c in self.crawl.categories:
            stop = out[c.url] + max(self.crawl.pages_per_batch, out[c.url] if self.crawl.catch_up else 0)
            stop = stop if self.crawl.max_pages is None else min(stop, self.crawl.max_pages)
            n = self.crawl.catalogue.pages(c) if out[c.url] < stop else None
            if n is not None:
                out[c.url] = max(out[c.url], min(stop, n))
                continue
            while out[c.url] < stop and self.crawl.catalogue.has(page_url(c.url, out[c.url] + 1)):
                out[c.url] += 1
        return out

    def partitions(self, start: dict, end: dict):
        self.now = self.now | end  # after a restart too, when the engine repeats the last batch
        return [s for c in self.crawl.categories for s in self.crawl.ranges(c, start.get(c.url, 0) + 1, end.get(c.url, 0))]

    def read(self, partition):
        yield from self.crawl.rows(partition)

    def commit(self, end: dict) -> None:
        self.now = self.now | end


def register_crawl(spark: SparkSession, name: str, crawl: Crawl) -> None:
    """Makes a crawl readable as spark.read.format(name) and spark.readStream.format(name), with the columns of ITEM_DDL."""

    class CrawlSource(DataSource):
        @classmethod
        def name(cls):
            return name

        def schema(self):
            return ITEM_DDL

        def reader(self, schema):
            return _Reader(crawl)

        def streamReader(self, schema):
            return _StreamReader(crawl)

    spark.dataSource.register(CrawlSource)


READ_AHEAD = 50  # listing pages that are read from files at once


class StoredSite(Catalogue):
    """A site whose listing pages are a Parquet folder (category, page, body): body is a JSON array of items."""

    def __init__(self, path: str):
        self.path, self._held = path, {}

    def __getstate__(self) -> dict:
        return self.__dict__ | {"_held": {}}

    def _table(self, category: str, columns: list[str], first: int | None = None, last: int | None = None):
        import pyarrow.dataset as ds
        import pyarrow.fs as fs

        system, path = fs.FileSystem.from_uri(self.path) if "://" in self.path or self.path.startswith("file:") else (fs.LocalFileSystem(), self.path)
        wanted = ds.field("category") == urlsplit(category).path.strip("/")
        if first is not None:
            wanted &= (ds.field("page") >= first) & (ds.field("page") <= last)
        return ds.dataset(path, filesystem=system, exclude_invalid_files=True).to_table(columns=columns, filter=wanted)

    def has(self, url: str) -> bool:
        page = _page_number(url)
        return self._table(url, ["page"], page, page).num_rows > 0

    def listing(self, url: str) -> list[dict]:
        page = _page_number(url)
        if (url.partition("?")[0], page) not in self._held:  # the pages behind it are asked for next
            t = self._table(url, ["page", "body"], page, page + READ_AHEAD - 1)
            self._held = {(url.partition("?")[0], p): b for p, b in zip(t["page"].to_pylist(), t["body"].to_pylist(), strict=True)}
        return json.loads(self._held[url.partition("?")[0], page])

    def pages(self, category: Category) -> int | None:
        """The highest number; None if pages are missing in between."""
        import pyarrow.compute as pc

        numbers = self._table(category.url, ["page"])["page"]
        high = pc.max(numbers).as_py() or 0
        return high if len(numbers) == high else None


def _page_number(url: str) -> int:
    return int(dict(parse_qsl(urlsplit(url).query)).get("pn", 1))


def store_site(items: DataFrame, order: str, per_page: int = 20, broken: F.Column | None = None) -> str:
    """Writes items (category, `order`, url, title, any others) as a StoredSite and gives its path. broken (of category and page): pages with half a body."""
    at = numbered_within(items, ["category"], [order], "n")
    at = at.withColumn("page", (F.floor(F.col("n") / per_page) + 1).cast("int")).withColumn("at", F.col("n") % per_page)
    item = F.struct(*[c for c in items.columns if c != "category"])
    pages = at.groupBy("category", "page").agg(F.sort_array(F.collect_list(F.struct("at", item.alias("item")))).alias("x"))  # per_page items each
    pages = pages.withColumn("body", F.to_json(F.transform("x", lambda x: x["item"])))
    if broken is not None:
        pages = pages.withColumn("body", F.when(broken, F.left("body", F.lit(10))).otherwise(F.col("body")))
    path = fresh(items.sparkSession, "site")
    pages.select("category", "page", "body").repartitionByRange("category", "page").sortWithinPartitions("category", "page").write.option("parquet.block.size", 1 << 20).parquet(path)
    return path
