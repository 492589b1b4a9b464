"""A package site as a data source, in batches and as a stream.

The driver walks the index, newest first, and hands the packages it lists to partitions, in which they are fetched:
``id``, ``position`` in the index, ``html`` or ``error``. As a stream a micro-batch is what a few index pages list that is
neither settled nor listed before in the same walk. Spark asks a Python stream for its latest offset without telling where
the query stands, so the stream keeps its plans itself, in the folder ``state``: a plan is written before its offset is
given out, an offset is the number of a plan, and partitions are made from plans alone. A page that was fetched is kept in
that folder until its batch is committed; a batch that is run again fetches only what is not there.

Options (texts, as for any source):

* ``fetcher``: ``module:factory`` of a ``Fetcher``, imported in the workers, called with ``argument`` if that is given;
  by default an ``HttpClient`` with ``delay``;
* ``settled``: Parquet files with a column ``id`` of packages that need no fetch; only the ids of one index page at a
  time are looked up in them;
* ``limit``: index pages to walk at most; then the walk goes on past pages without news;
* ``partitions``: in which a batch is fetched (8);
* ``state``: folder of a stream, in a store that driver and executors share; ``pages``: index pages of a micro-batch (1).
"""

from __future__ import annotations

import importlib
import json
from collections.abc import Iterator
from dataclasses import dataclass

from pyarrow import dataset, fs
from pyspark.sql.datasource import DataSource, DataSourceReader, DataSourceStreamReader, InputPartition

from . import fetch, pages

SCHEMA = "id bigint, position bigint, html string, error string"
NAME = "package_site"


class Ids:
    """A set of ids as ranges, which is short where an index lists neighbours: ``3-7,9``."""

    def __init__(self, text: str = ""):
        self.ids: set[int] = set()
        for part in filter(None, text.split(",")):
            first, _, last = part.partition("-")
            self.ids.update(range(int(first), int(last or first) + 1))

    def __str__(self) -> str:
        out: list[list[int]] = []
        for i in sorted(self.ids):
            if out and out[-1][1] == i - 1:
                out[-1][1] = i
            else:
                out.append([i, i])
        return ",".join(f"{a}" if a == b else f"{a}-{b}" for a, b in out)


@dataclass
class Walk:
    """Where a walk through the index stands."""

    page: int = 0
    seen: str = ""
    done: bool = False
    position: int = 0


class Site:
    """What the options of a source name."""

    def __init__(self, options: dict[str, str]):
        self.options = dict(options)
        self.limit = int(options["limit"]) if options.get("limit") else None
        self.partitions = max(1, int(options.get("partitions", 8)))

    def fetcher(self) -> fetch.Fetcher:
        named = self.options.get("fetcher")
        if not named:
            return fetch.HttpClient(delay=float(self.options.get("delay", 0)))
        module, _, name = named.partition(":")
        make = getattr(importlib.import_module(module), name)
        return make(self.options["argument"]) if "argument" in self.options else make()

    def settled(self, ids: list[int]) -> set[int]:
        """Those of ``ids`` that are settled."""
        if not self.options.get("settled") or not ids:
            return set()
        files, path = fs.FileSystem.from_uri(self.options["settled"])
        found = dataset.dataset(path, format="parquet", filesystem=files).to_table(columns=["id"], filter=dataset.field("id").isin(ids))
        return set(found.column("id").to_pylist())

    def step(self, fetcher: fetch.Fetcher, walk: Walk, count: int | None) -> tuple[list[tuple[int, int]], Walk]:
        """Walk ``count`` index pages further (None: to the end): the (id, position) found, and where the walk then stands."""
        wanted, seen, page, position = [], Ids(walk.seen), walk.page, walk.position
        done = walk.done or self.limit is not None and page >= self.limit
        while not done and (count is None or page < walk.page + count):
            page += 1
            listed = fetch.page_links(fetcher.get(fetch.index_url(page)))
            if not listed and page == 1:
                raise fetch.IndexUnavailable(f"{fetch.index_url(1)} lists no packages")
            fresh = [i for i in listed if i not in seen.ids]
            settled = self.settled(fresh)
            news = [i for i in fresh if i not in settled]
            seen.ids.update(listed)
            wanted += [(i, position + k) for k, i in enumerate(news)]
            position += len(news)
            done = not listed or (not news if self.limit is None else page >= self.limit)
        return wanted, Walk(page, str(seen), done, position)

    def parts(self, wanted: list[tuple[int, int]], kept: str | None = None) -> list[InputPartition]:
        n = min(self.partitions, len(wanted))
        return [InputPartition((wanted[k::n], kept)) for k in range(n)]

    def read(self, partition: InputPartition | None) -> Iterator[tuple]:
        """Fetch the packages of a partition, one after the other; what was kept of an earlier run is not fetched again."""
        wanted, kept = partition.value if partition else ([], None)  # Spark reads None where there is no partition
        fetcher, store = None, Store(kept) if kept else None
        for ident, position in wanted:
            row = store.get(f"{ident}.json") if store else None
            if row is None:
                fetcher = fetcher or self.fetcher()
                try:
                    row = [fetcher.get(f"{pages.BASE_URL}/pack/{ident}"), None]
                except Exception as error:  # a failure concerns its page only
                    row = [None, str(error)]
                if store:
                    store.put(f"{ident}.json", row)
            yield (ident, position, *row)


class Store:
    """Small JSON files in a folder of any store that pyarrow reaches; a file is there whole or not at all."""

    def __init__(self, folder: str):
        self.files, self.folder = fs.FileSystem.from_uri(folder)
        self.files.create_dir(self.folder, recursive=True)

    def names(self) -> list[str]:
        return sorted(f.base_name for f in self.files.get_file_info(fs.FileSelector(self.folder)) if f.type == fs.FileType.File and not f.base_name.endswith(".part"))

    def get(self, name: str) -> object | None:
        path = f"{self.folder}/{name}"
        if self.files.get_file_info(path).type == fs.FileType.NotFound:
            return None
        with self.files.open_input_stream(path, compression=None) as stream:
            return json.loads(stream.read().decode("utf-8", "surrogatepass"))

    def put(self, name: str, value: object, mark: str = "") -> None:
        """Write under another name, then rename; ``mark`` tells writers of the same name apart."""
        part = f"{self.folder}/{name}{mark}.part"
        with self.files.open_output_stream(part, compression=None) as stream:
            stream.write(json.dumps(value).encode())
        self.files.move(part, f"{self.folder}/{name}")

    def drop(self, *names: str) -> None:
        for name in names:
            if self.files.get_file_info(f"{self.folder}/{name}").type != fs.FileType.NotFound:
                self.files.delete_file(f"{self.folder}/{name}")

    def drop_folder(self) -> None:
        if self.files.get_file_info(self.folder).type != fs.FileType.NotFound:
            self.files.delete_dir(self.folder)


class SiteReader(DataSourceReader):
    def __init__(self, site: Site):
        self.site = site

    def partitions(self) -> list[InputPartition]:
        return self.site.parts(self.site.step(self.site.fetcher(), Walk(), None)[0])

    def read(self, partition: InputPartition) -> Iterator[tuple]:
        return self.site.read(partition)


class SiteStream(DataSourceStreamReader):
    """The stream; its offsets are ``{"plan": n}``, and plan n is written before offset n is given out."""

    def __init__(self, site: Site):
        self.site, self.state = site, site.options["state"].rstrip("/")
        self.count = max(1, int(site.options.get("pages", 1)))
        self.fresh, self.begun = True, -1

    def _plans(self) -> Store:
        return Store(f"{self.state}/plans")

    def initialOffset(self) -> dict:
        return {"plan": 0}

    def latestOffset(self) -> dict:
        """The last plan, or a new one if that may have been run: when a batch was made of it, or by a former process.

        A plan that a former process wrote but never ran is then part of the next batch, which spans both.
        """
        plans = self._plans()
        last = max((int(n.split(".")[0]) for n in plans.names()), default=0)
        known = plans.get(f"{last:09d}.json") if last else {"walk": {}, "ids": []}
        walk = Walk(**known["walk"])
        if walk.done and self.fresh:
            walk = Walk()  # the next walk, from the first index page
        if not self.fresh and (self.begun < last or walk.done):
            return {"plan": last}
        wanted, stand = [], walk
        while not wanted and not stand.done:  # pages without news make no batch
            wanted, stand = self.site.step(self.site.fetcher(), stand, self.count)
        self.fresh = False
        if not wanted and not last:
            return {"plan": 0}
        if wanted:
            last += 1
        plans.put(f"{last:09d}.json", {"walk": stand.__dict__, "ids": wanted or known["ids"]})
        return {"plan": last}

    def partitions(self, start: dict, end: dict) -> list[InputPartition]:
        self.begun = max(self.begun, end["plan"])
        plans, out = self._plans(), []
        for k in range(start["plan"] + 1, end["plan"] + 1):
            out += self.site.parts([tuple(w) for w in plans.get(f"{k:09d}.json")["ids"]], f"{self.state}/fetched/{k:09d}")
        return out

    def read(self, partition: InputPartition) -> Iterator[tuple]:
        return self.site.read(partition)

    def commit(self, end: dict) -> None:
        plans = self._plans()
        plans.drop(*[n for n in plans.names() if int(n.split(".")[0]) < end["plan"]])
        files, path = fs.FileSystem.from_uri(f"{self.state}/fetched")
        for info in files.get_file_info(fs.FileSelector(path, allow_not_found=True)):
            if info.type == fs.FileType.Directory and int(info.base_name) <= end["plan"]:
                files.delete_dir(info.path)


class PackageSite(DataSource):
    """``spark.read.format("package_site")`` and ``spark.readStream.format("package_site")``, once registered."""

    @classmethod
    def name(cls) -> str:
        return NAME

    def schema(self) -> str:
        return SCHEMA

    def reader(self, schema) -> DataSourceReader:
        return SiteReader(Site(self.options))

    def streamReader(self, schema) -> DataSourceStreamReader:
        return SiteStream(Site(self.options))
