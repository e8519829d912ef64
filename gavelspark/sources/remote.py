"""Python data sources for remote lists and change feeds.

``fetch`` is injected by name (module:function), so a worker can import it and tests
need no network; the option ``location``, if given, is passed on to it.  A list source reads one partition per page range; the feed source's
offset is the feed's sequence number.
"""

from __future__ import annotations

import importlib
from collections.abc import Iterator
from functools import partial

from pyspark.sql.datasource import DataSource, DataSourceReader, DataSourceStreamReader, InputPartition


def resolve(name: str, location: str | None = None):
    module, _, function = name.partition(":")
    fetch = getattr(importlib.import_module(module), function)
    return fetch if location is None else partial(fetch, location=location)


class PageRange(InputPartition):
    def __init__(self, first: int, last: int) -> None:
        self.first, self.last = first, last


class PagedListReader(DataSourceReader):
    def __init__(self, options: dict) -> None:
        self.fetch, self.limit = (options["fetch"], options.get("location")), int(options.get("limit", 200))
        self.pages, self.parts = int(options["pages"]), int(options.get("partitions", 4))

    def partitions(self) -> list[PageRange]:
        step = max(1, -(-self.pages // self.parts))
        return [PageRange(a, min(a + step, self.pages)) for a in range(0, self.pages, step)]

    def read(self, partition: PageRange) -> Iterator[tuple]:
        fetch = resolve(*self.fetch)
        for page in range(partition.first, partition.last):
            yield from fetch(offset=page * self.limit, limit=self.limit)


class PagedList(DataSource):
    """format("paged_list"): options fetch, location, pages, limit, partitions."""

    @classmethod
    def name(cls) -> str:
        return "paged_list"

    def schema(self) -> str:
        return self.options.get("columns", "id string, name string")

    def reader(self, schema) -> PagedListReader:
        return PagedListReader(self.options)


class SeqRange(InputPartition):
    def __init__(self, after: int, upto: int) -> None:
        self.after, self.upto = after, upto


class FeedReader(DataSourceStreamReader):
    """Offsets are sequence numbers; a restart reads the same ranges again."""

    def __init__(self, options: dict) -> None:
        self.fetch, self.limit = (options["fetch"], options.get("location")), int(options.get("limit", 500))
        self.first = self.at = int(options.get("after", 0))

    def initialOffset(self) -> dict:
        return {"after": self.first}

    def latestOffset(self) -> dict:
        _, self.at = resolve(*self.fetch)(after=self.at, limit=self.limit)
        return {"after": self.at}

    def partitions(self, start: dict, end: dict) -> list[SeqRange]:
        return [SeqRange(start["after"], end["after"])] if end["after"] > start["after"] else []

    def read(self, partition: SeqRange) -> Iterator[tuple]:
        items, _ = resolve(*self.fetch)(after=partition.after, limit=partition.upto - partition.after)
        yield from (i for i in items if i[0] <= partition.upto)


class ChangeFeed(DataSource):
    """format("change_feed"): options fetch, location, after, limit."""

    @classmethod
    def name(cls) -> str:
        return "change_feed"

    def schema(self) -> str:
        return "seq long, entity_type string, entity_id string, change string"

    def streamReader(self, schema) -> FeedReader:
        return FeedReader(self.options)


def sample_list(offset: int, limit: int) -> list[tuple]:
    """A list of 95 made-up rows, for tests."""
    return [(f"id-{i:04d}", f"name {i}") for i in range(offset, min(offset + limit, 95))]


def sample_feed(after: int, limit: int) -> tuple[list[tuple], int]:
    """A feed of 60 made-up changes and the sequence number to go on from."""
    items = [(s, "person", f"id-{s % 7}", "updated" if s % 5 else "deleted") for s in range(after + 1, min(after + limit, 60) + 1)]
    return items, items[-1][0] if items else after


def table_list(offset: int, limit: int, location: str) -> list[tuple]:
    """slug and name of one page of the parquet table of jurisdictions, in file order."""
    import pyarrow.dataset as ds

    out: list[tuple] = []
    for file in ds.dataset(location).get_fragments():
        for group in file.split_by_row_group():
            n = group.count_rows()
            if offset < n and limit > 0:
                rows = group.to_table(columns=["slug", "name"]).slice(offset, limit)
                out += zip(rows["slug"].to_pylist(), rows["name"].to_pylist())
                limit -= rows.num_rows
            offset = max(0, offset - n)
    return out


def table_feed(after: int, limit: int, location: str) -> tuple[list[tuple], int]:
    """The next ``limit`` changes after a sequence number, of the parquet table of events; an error
    is a deletion.  Holds no more than a page and a batch of rows."""
    import pyarrow as pa
    import pyarrow.dataset as ds

    page = None
    for batch in ds.dataset(location).to_batches(columns=["event_id", "user_id", "event_type"], filter=ds.field("event_id") > after):
        rows = pa.Table.from_batches([batch])
        page = (rows if page is None else pa.concat_tables([page, rows])).sort_by("event_id").slice(0, limit)
    items = [] if page is None else [(r["event_id"], "user", str(r["user_id"]), "deleted" if r["event_type"] == "error" else "updated") for r in page.to_pylist()]
    return items, items[-1][0] if items else after
