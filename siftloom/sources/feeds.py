"""RSS and Atom documents, robots rules, and rows from paged web interfaces through a fetcher that the caller gives."""

from __future__ import annotations

import html as _html
import re
import time
from collections.abc import Callable, Iterator
from xml.etree import ElementTree

import pandas as pd
from pyspark.sql import DataFrame, SparkSession, functions as F
from pyspark.sql.datasource import DataSource, DataSourceReader, InputPartition

_TAG, _BLANK = re.compile(r"<[^>]+>"), re.compile(r"\s+")


def _plain(text: str | None, limit: int) -> str:
    return _BLANK.sub(" ", _TAG.sub(" ", text or "")).strip()[:limit]


def _local(e: ElementTree.Element) -> str:
    return e.tag.rpartition("}")[2].lower()


def feed_entries(document: bytes) -> list[dict]:
    """Entries of a feed that have an address, whatever its namespaces."""
    out = []
    for entry in ElementTree.fromstring(document).iter():
        if _local(entry) not in ("item", "entry"):
            continue
        parts: dict[str, ElementTree.Element] = {}
        for child in entry:
            parts.setdefault(_local(child), child)
        text = lambda *names: next(("".join(parts[n].itertext()) for n in names if n in parts and "".join(parts[n].itertext()).strip()), "")  # noqa: B023, E731
        url = text("link").strip() or (parts["link"].get("href", "").strip() if "link" in parts else "")
        if url:
            out.append({"title": _plain(_html.unescape(text("title")), 220), "url": url, "summary": _plain(_html.unescape(text("description", "summary", "content")), 600), "published": text("pubdate", "published", "updated").strip() or None})
    return out


def parsed_feeds(feeds: DataFrame) -> DataFrame:
    """From (feed, document BINARY): (feed, title, url, summary, published, error), the error of a document that is no feed in a row of its own."""

    def f(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for b in batches:
            rows = []
            for feed, document in zip(b["feed"], b["document"]):
                try:
                    rows += [{"feed": feed, "error": None, **e} for e in feed_entries(bytes(document))]
                except (ElementTree.ParseError, TypeError) as e:
                    rows.append({"feed": feed, "error": str(e)[:200]})
            yield pd.DataFrame(rows, columns=["feed", "title", "url", "summary", "published", "error"], dtype=object)

    return feeds.select("feed", "document").mapInPandas(f, "feed STRING, title STRING, url STRING, summary STRING, published STRING, error STRING")


def allowed_by_robots(pages: DataFrame, robots: DataFrame, agent: str = "*") -> DataFrame:
    """pages (url, ...) that their origin's rules (origin, rules: the text of robots.txt) allow; no rules allow everything."""
    origin = F.lower(F.regexp_extract("url", r"^(\w+://[^/?#]+)", 1))

    @F.pandas_udf("boolean")
    def allowed(urls: pd.Series, rules: pd.Series) -> pd.Series:
        from urllib.robotparser import RobotFileParser

        known: dict[str, RobotFileParser] = {}
        out = []
        for url, text in zip(urls, rules):
            if not text:
                out.append(True)
                continue
            if text not in known:
                known[text] = RobotFileParser()
                known[text].parse(text.splitlines())
            out.append(known[text].can_fetch(agent, url))
        return pd.Series(out, dtype="bool")

    own = robots.groupBy(F.lower("origin").alias("_origin")).agg(F.min("rules").alias("_rules"))
    return pages.withColumn("_origin", origin).join(own, "_origin", "left").where(allowed("url", "_rules")).drop("_origin", "_rules")


class _Query(InputPartition):
    def __init__(self, query: str):
        super().__init__(query)


class _Reader(DataSourceReader):
    """One partition per query; pages till one comes short, a wait between them."""

    def __init__(self, fetch: Callable[[str, int, int], list[tuple]], queries: list[str], size: int, pages: int, wait: float):
        self.fetch, self.queries, self.size, self.pages, self.wait = fetch, queries, size, pages, wait

    def partitions(self) -> list[InputPartition]:
        return [_Query(q) for q in self.queries]

    def read(self, partition: InputPartition) -> Iterator[tuple]:
        for page in range(1, self.pages + 1):
            rows = self.fetch(partition.value, self.size, page)
            yield from ((partition.value, *r) for r in rows)
            if len(rows) < self.size:
                return
            time.sleep(self.wait)


def paged_source(name: str, fetch: Callable[[str, int, int], list[tuple]], queries: list[str], size: int = 30, pages: int = 2, wait: float = 0.0) -> type[DataSource]:
    """A data source of (query, title, url, summary, published) rows; fetch(query, size, page) reaches the interface and is the caller's."""

    class Paged(DataSource):
        @classmethod
        def name(cls) -> str:
            return name

        def schema(self) -> str:
            return "query STRING, title STRING, url STRING, summary STRING, published STRING"

        def reader(self, schema: object) -> DataSourceReader:
            return _Reader(fetch, queries, size, pages, wait)

    return Paged


def read_paged(spark: SparkSession, source: type[DataSource]) -> DataFrame:
    spark.dataSource.register(source)
    return spark.read.format(source.name()).load()
