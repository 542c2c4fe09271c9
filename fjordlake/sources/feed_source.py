"""The feed as a stream whose offset is the cursor: pages follow each other by their next link, whenever they landed.

    spark.dataSource.register(FeedPages)
    spark.readStream.format("feed_pages").option("path", landing).option("first", "start").load()

A page lies in the landing folder under the last part of its address, with `.json` behind it. The cursor is a page, its number in the
feed and how many of its items have been read. A page without a next link is the tail: it is read again when it has grown, or has
got a next link, and only what is new of it comes. A page that has not landed, or not as readable JSON, stops the stream until it has.

The driver follows the links, one page at a time, and keeps only the cursor; executors read the pages' items. `pages_per_batch`
bounds a batch. Each page also gives a row with place -1 and nothing else, so that pages without items are counted."""

from __future__ import annotations

import json
from collections.abc import Iterator
from dataclasses import dataclass

from pyspark.sql.datasource import DataSource, DataSourceStreamReader, InputPartition

from fjordlake.operators.events import ITEM_SCHEMA

_ENTRY = ("status", "title", "businessName", "municipal", "sistEndret")


def page_name(url: str | None) -> str | None:
    """The last part of an address; none for a blank one."""
    clean = (url or "").strip().split("?")[0].rstrip("/")
    return clean.rsplit("/", 1)[-1] or None


@dataclass
class Part(InputPartition):
    """Items of one page from one place to another, or to its end."""

    page: str
    number: int
    start: int
    stop: int | None


def _text(value) -> str | None:
    return value if value is None or isinstance(value, str) else json.dumps(value, ensure_ascii=False)


def _items(page: dict) -> list:
    found = page.get("items")
    return [x for x in found if isinstance(x, dict)] if isinstance(found, list) else []


class FeedPages(DataSource):
    @classmethod
    def name(cls) -> str:
        return "feed_pages"

    def schema(self) -> str:
        return f"page string, page_number long, place int, {ITEM_SCHEMA}"

    def streamReader(self, schema) -> FeedReader:
        return FeedReader(self.options["path"], self.options["first"], int(self.options.get("pages_per_batch", "10")))


class FeedReader(DataSourceStreamReader):
    def __init__(self, path: str, first: str, pages_per_batch: int):
        self.path, self.first, self.pages_per_batch = path, first, pages_per_batch
        self.cursor: dict | None = None

    def _page(self, name: str) -> dict | None:
        """A landed page; none if it isn't there or can't be read."""
        from pyarrow import fs

        store, root = fs.FileSystem.from_uri(self.path) if "://" in self.path else (fs.LocalFileSystem(), self.path)
        try:
            with store.open_input_stream(f"{root.rstrip('/')}/{name}.json") as file:
                found = json.loads(file.read())
        except (FileNotFoundError, ValueError):
            return None
        return found if isinstance(found, dict) else None

    def _after(self, cursor: dict) -> dict | None:
        """The cursor behind the cursor's page: on the next page, or on the tail behind what it holds now; none if there is no such page yet."""
        page = self._page(cursor["page"])
        if page is None:
            return None
        link = page_name(page.get("next_url") if isinstance(page.get("next_url"), str) else None)
        if link and link != cursor["page"]:
            return {"page": link, "number": cursor["number"] + 1, "place": 0}
        return cursor | {"place": max(cursor["place"], len(_items(page)))}

    def initialOffset(self) -> dict:
        return {"page": self.first, "number": 0, "place": 0}

    def latestOffset(self) -> dict:
        cursor = self.cursor or self.initialOffset()
        for _ in range(self.pages_per_batch):
            following = self._after(cursor)
            if following is None or following == cursor:
                break
            cursor = following
            if cursor["place"]:
                break
        self.cursor = cursor
        return cursor

    def partitions(self, start: dict, end: dict) -> list[Part]:
        if self.cursor is None:  # a restart: the engine asks for its last batch first
            self.cursor = end
        parts, at = [], start
        while at["number"] < end["number"]:
            parts.append(Part(at["page"], at["number"], at["place"], None))
            following = self._after(at)
            if following is None or following["number"] == at["number"]:
                raise ValueError(f"page {at['page']} of the feed has lost its next link")
            at = following
        if at["number"] == end["number"] and at["place"] < end["place"]:
            parts.append(Part(at["page"], at["number"], at["place"], end["place"]))
        return parts

    def read(self, partition: Part) -> Iterator[tuple]:
        page = self._page(partition.page)
        if page is None:
            raise ValueError(f"page {partition.page} of the feed can't be read any more")
        if partition.start == 0:
            yield (partition.page, partition.number, -1, None, None, None, None, None)
        for place, item in enumerate(_items(page)[: partition.stop]):
            if place >= partition.start:
                entry = item.get("_feed_entry")
                own = tuple(_text(entry.get(k)) for k in _ENTRY) if isinstance(entry, dict) else None
                yield (partition.page, partition.number, place, *(_text(item.get(k)) for k in ("id", "url", "title", "date_modified")), own)

    def commit(self, end: dict) -> None:
        pass
