"""The change feed as a Spark data source whose offset is the sequence number.

Feed pages are landed as ``feed-<since>-<last>.jsonl`` files in one folder. The names alone
tell which pages a range of sequences needs, so planning reads no page, and every page is
one partition. ``spark.dataSource.register(FeedSource)``, then
``spark.readStream.format("registry_feed").option("path", folder)``.
"""

from __future__ import annotations

import json
import re
from collections.abc import Iterator

import pyarrow.fs as pafs

from pyspark.sql.datasource import DataSource, DataSourceReader, DataSourceStreamReader, InputPartition

from registry_lens.functions.storage import file_system

PAGE = re.compile(r"feed-(\d+)-(\d+)\.jsonl$")
SCHEMA = "seq bigint, id string, revs array<string>, deleted boolean"


class Page(InputPartition):
    """A page and the range wanted of it: after ``since`` up to ``last``."""

    def __init__(self, path: str, since: int, last: int):
        self.path, self.since, self.last = path, since, last


def pages(folder: str) -> list[tuple[int, int, str]]:
    """(first, last, URI) of the landed pages, in order; none when the folder is missing."""
    fs, path = file_system(folder)
    names = [f.base_name for f in fs.get_file_info(pafs.FileSelector(path, allow_not_found=True))]
    found = [(m, n) for n in names if (m := PAGE.match(n))]
    return sorted((int(m[1]), int(m[2]), f"{folder.rstrip('/')}/{n}") for m, n in found)


def head(folder: str) -> int | None:
    """The last sequence that has landed; None without pages."""
    return max((last for _, last, _ in pages(folder)), default=None)


def read_page(page: Page) -> Iterator[tuple]:
    fs, path = file_system(page.path)
    with fs.open_input_stream(path) as f:
        text = f.read().decode("utf-8")
    for line in text.split("\n"):
        if not line.strip():
            continue
        row = json.loads(line)
        if row.get("k") == "feedhdr" or not page.since < row["seq"] <= page.last:
            continue
        yield (row["seq"], row.get("id"), [c.get("rev") for c in row.get("changes") or []], row.get("deleted") is True)


def plan(folder: str, since: int, last: int, most: int | None = None) -> list[Page]:
    """The pages that a range of sequences needs, in order; at most ``most`` of them."""
    return [Page(path, max(a, since), min(b, last)) for a, b, path in pages(folder) if b > since and a < last][:most]


class FeedReader(DataSourceReader):
    def __init__(self, options: dict):
        self.folder, self.since, self.last = options["path"], int(options.get("since", -1)), int(options.get("last", 2**62))
        self.most = int(options["maxPages"]) if "maxPages" in options else None

    def partitions(self):
        return plan(self.folder, self.since, self.last, self.most)

    def read(self, partition):
        return read_page(partition) if partition is not None else iter(())  # none: there was no page to plan


class FeedStreamReader(DataSourceStreamReader):
    def __init__(self, options: dict):
        self.folder, self.start = options["path"], int(options.get("startingSeq", -1))
        self.seen = self.start

    def initialOffset(self) -> dict:
        return {"seq": self.start}

    def latestOffset(self) -> dict:
        last = head(self.folder)
        last = self.seen if last is None else last
        if last < self.seen:
            raise ValueError(f"the feed went back from {self.seen} to {last}")
        self.seen = last
        return {"seq": last}

    def partitions(self, start: dict, end: dict):
        return plan(self.folder, start["seq"], end["seq"])

    def read(self, partition):
        return read_page(partition) if partition is not None else iter(())  # none: there was no page to plan

    def commit(self, end: dict) -> None:
        """Nothing to release: pages stay."""


class FeedSource(DataSource):
    """Batch and streaming access to landed feed pages."""

    @classmethod
    def name(cls) -> str:
        return "registry_feed"

    def schema(self) -> str:
        return SCHEMA

    def reader(self, schema) -> DataSourceReader:
        return FeedReader(self.options)

    def streamReader(self, schema) -> DataSourceStreamReader:
        return FeedStreamReader(self.options)
