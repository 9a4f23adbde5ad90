"""Landed feeds as a data source of Spark: `spark.read.format("feeds")`.

A feed's documents land as files under `path/feed=<key>/`, each a whole RSS or Atom document; land() writes them so. A scan
has a partition for each feed, or several for one whose files are more than PART bytes. What can't be read becomes a row with `error`, and
leaves other files and feeds as they are. This module needs nothing else of the package, so workers get it with the scan.
"""

from __future__ import annotations

import hashlib
import json
import re
from collections.abc import Iterator
from dataclasses import dataclass
from xml.etree import ElementTree

import pyarrow as pa
from pyarrow import fs
from pyspark.sql.datasource import DataSource, DataSourceReader, EqualTo, Filter, In, InputPartition

ENTRY = "title string, link string, summary string, content string, published string, updated string"
SCHEMA = f"feed_order int, source_name string, tier string, file string, entry_order long, {ENTRY}, error string"
COLUMNS = [pa.field(name, {"int": pa.int32(), "long": pa.int64()}.get(kind, pa.string())) for name, kind in (c.split() for c in SCHEMA.split(", "))]
#: Names of elements (without their namespaces) and the fields that they fill.
FIELDS = {"title": "title", "description": "summary", "summary": "summary", "encoded": "content", "content": "content", "pubDate": "published", "published": "published", "date": "published", "updated": "updated"}
#: Bytes of files that one partition reads, unless a single file has more.
PART = 32 << 20


def feed_key(url: str) -> str:
    """The name of the folder that a feed's documents land in."""
    return hashlib.sha256(url.encode()).hexdigest()[:16]


def entries_of(xml: str | bytes | None) -> tuple[list[dict], str | None]:
    """The entries of a feed (RSS items, Atom entries) and why it can't be read, if so. Documents with declarations of their own are refused."""
    raw = xml.encode() if isinstance(xml, str) else xml
    if not raw or b"<!DOCTYPE" in raw or b"<!ENTITY" in raw:
        return [], "no feed document"
    try:
        root = ElementTree.fromstring(raw)
    except (ElementTree.ParseError, ValueError, LookupError) as e:  # LookupError: an encoding that isn't known
        return [], str(e)
    local = lambda e: e.tag.rsplit("}", 1)[-1] if isinstance(e.tag, str) else ""
    out = []
    for entry in (e for e in root.iter() if local(e) in ("item", "entry")):
        found: dict = dict.fromkeys(["title", "link", "summary", "content", "published", "updated"])
        for e in entry:
            text, name = "".join(e.itertext()), local(e)
            if name == "link":
                address = text.strip() or (e.get("href") if e.get("rel", "alternate") == "alternate" else None)
                found["link"] = found["link"] or address
            elif (field := FIELDS.get(name)) and not found[field]:
                found[field] = text
        out.append(found)
    return out, None


def in_order(path: str) -> list:
    """A sort key by which numbers in names count as numbers."""
    return [int(x) if x.isdigit() else x for x in re.split(r"(\d+)", path)]


@dataclass
class FeedPart(InputPartition):
    """Some of a feed's files, in order; first is the number of the first of them in the feed."""

    order: int
    name: str
    tier: str
    files: list[str]
    first: int


class FeedReader(DataSourceReader):
    def __init__(self, path: str, feeds: list[dict]):
        self.path = path
        self.feeds = [{"order": i, "name": f.get("name") or f.get("url", ""), "url": f.get("url", ""), "tier": f.get("tier") or "T2"} for i, f in enumerate(feeds)]
        self.names: set[str] | None = None

    def pushFilters(self, filters: list[Filter]):
        """Filters by source_name leave out feeds before their files are listed; all others are for Spark."""
        for f in filters:
            if isinstance(f, EqualTo | In) and f.attribute == ("source_name",):
                wanted = set(f.value) if isinstance(f, In) else {f.value}
                self.names = wanted if self.names is None else self.names & wanted
            else:
                yield f

    def partitions(self) -> list[FeedPart]:
        store, top = fs.FileSystem.from_uri(self.path)
        parts = []
        for f in self.feeds:
            if self.names is not None and f["name"] not in self.names:
                continue
            found = store.get_file_info(fs.FileSelector(f"{top}/feed={feed_key(f['url'])}", allow_not_found=True, recursive=True))
            files = sorted(((x.path, x.size) for x in found if x.type == fs.FileType.File and not x.base_name.startswith(("_", "."))), key=lambda x: in_order(x[0]))
            groups, held = [[]], 0
            for path, size in files:
                if groups[-1] and held + size > PART:
                    groups, held = [*groups, []], 0
                groups[-1].append(path)
                held += size
            first = 0
            for group in groups:  # a feed without files has one, which says so
                parts.append(FeedPart(f["order"], f["name"], f["tier"], group, first))
                first += len(group)
        return parts

    def read(self, part: FeedPart | None) -> Iterator[pa.RecordBatch]:
        if part is None:  # there are no feeds
            return
        store, _ = fs.FileSystem.from_uri(self.path)
        head = {"feed_order": part.order, "source_name": part.name, "tier": part.tier}
        if not part.files:
            yield self.batch([head | {"error": "nothing has landed"}])
        for i, path in enumerate(part.files, part.first):
            at = head | {"file": path.rsplit("/", 1)[-1]}
            try:
                with store.open_input_file(path) as f:
                    entries, error = entries_of(f.read())
            except OSError as e:
                entries, error = [], str(e)
            rows = [at | e | {"entry_order": (i << 32) + k} for k, e in enumerate(entries)]
            yield self.batch([at | {"error": error}] if error else rows)

    @staticmethod
    def batch(rows: list[dict]) -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays([pa.array([r.get(f.name) for r in rows], f.type) for f in COLUMNS], [f.name for f in COLUMNS])


class FeedSource(DataSource):
    """Options: path, the folder that feeds land in (a URI that Arrow can open), and feeds, a JSON list of {name, url, tier}."""

    @classmethod
    def name(cls) -> str:
        return "feeds"

    def schema(self) -> str:
        return SCHEMA

    def reader(self, schema) -> FeedReader:
        feeds = json.loads(self.options.get("feeds", "[]"))
        if not isinstance(feeds, list) or not self.options.get("path"):
            raise ValueError("feeds are a JSON list; path names the folder that they land in")
        return FeedReader(self.options["path"], feeds)
