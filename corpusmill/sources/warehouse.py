"""A folder of versioned Parquet tables with a pointer that names the current version.

A table is a folder that is written as a whole, or a manifest of buckets once rows are upserted into it; see ``buckets``.

A build writes every changed table into a new version and then moves the pointer in one step, so a
reader sees either all of it or nothing, and no plan overwrites the files that it reads. Paths may be in
any store that Spark reaches; the pointer is moved by a rename there.
"""

from __future__ import annotations

import json
import uuid
from concurrent.futures import ThreadPoolExecutor

from pyspark.sql import DataFrame, SparkSession

from ..schemas import KEYS, TABLES, USABLE
from ..shipping import ship
from .buckets import BucketTable


class MissingWarehouse(FileNotFoundError):
    """A warehouse opened for reading does not exist."""


#: How the name of a manifest ends, which tells it from a folder.
_MANIFEST = ".manifest.json"


class Warehouse:
    def __init__(self, spark: SparkSession, path: str, read_only: bool = False):
        self.spark, self.path, self.read_only = ship(spark), path.rstrip("/"), read_only
        self._jvm = spark._jvm
        self._fs = self._hadoop(self.path).getFileSystem(spark._jsc.hadoopConfiguration())
        if not self._fs.exists(self._hadoop(f"{self.path}/CURRENT")):
            if read_only:
                raise MissingWarehouse(path)
            self.point({})
        if not read_only and (missing := [name for name in TABLES if name not in self.current()]):
            self.swap({name: spark.createDataFrame([], TABLES[name]) for name in missing})

    def _hadoop(self, path: str):
        return self._jvm.org.apache.hadoop.fs.Path(path)

    def _read_text(self, path: str) -> str:
        stream = self._fs.open(self._hadoop(path))
        try:
            return bytes(self._jvm.org.apache.commons.io.IOUtils.toByteArray(stream)).decode()
        finally:
            stream.close()

    def current(self) -> dict[str, str]:
        """Table name to folder of the current version."""
        return json.loads(self._read_text(f"{self.path}/CURRENT"))

    def read(self, name: str) -> DataFrame:
        folder = self.current().get(name)  # none in a warehouse of before the table
        return self.at(name, folder) if folder else self.spark.createDataFrame([], TABLES[name])

    def tables(self) -> dict[str, DataFrame]:
        return {name: self.read(name) for name in TABLES}

    def write(self, name: str, df: DataFrame) -> str:
        """Write a table into a new folder, which no reader sees before ``point``."""
        if self.read_only:
            raise PermissionError("opened for reading")
        folder = f"{name}/{uuid.uuid4().hex}"
        df.select(*TABLES[name].fieldNames()).write.parquet(f"{self.path}/{folder}")
        return folder

    def at(self, name: str, folder: str) -> DataFrame:
        """A version of a table."""
        if folder.endswith(_MANIFEST):
            return self._buckets(name, folder).read()
        return self.spark.read.schema(TABLES[name]).parquet(f"{self.path}/{folder}")

    def _buckets(self, name: str, manifest: str) -> BucketTable:
        return BucketTable.load(self.spark, self.uri(f"{self.path}/{name}"), TABLES[name], KEYS[name], self._read_text(f"{self.path}/{manifest}"))

    def bucketed(self, name: str) -> BucketTable:
        """The current version of a table in buckets; one that is a plain folder yet is copied into buckets."""
        current = self.current()[name]
        if current.endswith(_MANIFEST):
            return self._buckets(name, current)
        empty = BucketTable(self.spark, self.uri(f"{self.path}/{name}"), TABLES[name], KEYS[name], [])
        return empty if self.read_only else empty.upsert(self.read(name))

    def lookup(self, name: str, keys: DataFrame) -> DataFrame:
        """The rows of a table with one of the keys (a column), of a table in buckets without reading the others."""
        current = self.current()[name]
        if current.endswith(_MANIFEST):
            return self._buckets(name, current).lookup(keys)
        return self.read(name).join(keys.toDF(KEYS[name]).distinct(), KEYS[name], "left_semi")

    def upsert(self, name: str, batch: DataFrame, gone: DataFrame | None = None) -> str:
        """Write a version in which ``batch``, one row for each key, replaces or joins what is stored, and the keys in ``gone`` leave.

        No reader sees it before ``point``. Only buckets with one of the keys are written, and small ones.
        """
        if self.read_only:
            raise PermissionError("opened for reading")
        manifest = f"{name}/{uuid.uuid4().hex}{_MANIFEST}"
        self._write_text(f"{self.path}/{manifest}", self.bucketed(name).upsert(batch, gone).manifest())
        return manifest

    def upserts(self, changes: dict[str, tuple[DataFrame, DataFrame | None]]) -> dict[str, str]:
        """``upsert`` of several tables, (batch, keys that leave) by name, side by side: each is a few short jobs one after the other."""
        with ThreadPoolExecutor(len(changes)) as pool:
            done = {name: pool.submit(self.upsert, name, *change) for name, change in changes.items()}
            return {name: one.result() for name, one in done.items()}

    def _write_text(self, path: str, content: str) -> None:
        stream = self._fs.create(self._hadoop(path), True)
        stream.write(content.encode())
        stream.close()

    def point(self, folders: dict[str, str]) -> None:
        """Make written folders current together."""
        if self.read_only:
            raise PermissionError("opened for reading")
        pointer = self._hadoop(f"{self.path}/CURRENT")
        now = (self.current() if self._fs.exists(pointer) else {}) | folders
        fresh = self._hadoop(f"{self.path}/CURRENT.{uuid.uuid4().hex}")
        self._write_text(fresh.toString(), json.dumps(now))
        context = self._jvm.org.apache.hadoop.fs.FileContext.getFileContext(self._fs.getUri(), self.spark._jsc.hadoopConfiguration())
        options = self.spark.sparkContext._gateway.new_array(self._jvm.org.apache.hadoop.fs.Options.Rename, 1)
        options[0] = self._jvm.org.apache.hadoop.fs.Options.Rename.OVERWRITE
        context.rename(self._fs.makeQualified(fresh), self._fs.makeQualified(pointer), options)

    def swap(self, changed: dict[str, DataFrame]) -> None:
        """Write the changed tables and make them current together."""
        self.point({name: self.write(name, df) for name, df in changed.items()})

    def uri(self, path: str) -> str:
        """A path of the warehouse with its store, as others than Spark need it."""
        scheme, rest = self._fs.makeQualified(self._hadoop(path)).toString().split(":", 1)
        return f"{scheme}:{rest if rest.startswith('//') else '//' + rest}"

    def work(self) -> str:
        """A fresh folder for intermediate tables of a build."""
        return f"{self.path}/work/{uuid.uuid4().hex}"

    def drop(self, folder: str) -> None:
        """Delete a folder of the warehouse that nothing reads any more."""
        self._fs.delete(self._hadoop(folder), True)

    def vacuum(self) -> int:
        """Delete the versions of tables that are not current, and what builds left behind; the number of folders.

        Not for while another job reads or builds.
        """
        kept, gone = set(self.current().values()), 0
        for name, folder in self.current().items():
            if folder.endswith(_MANIFEST):
                kept |= {f"{name}/{b.file.split('/')[0]}" for b in self._buckets(name, folder).buckets}
        for name in [*TABLES, "work"]:
            folder = self._hadoop(f"{self.path}/{name}")
            for status in self._fs.listStatus(folder) if self._fs.exists(folder) else ():
                if f"{name}/{status.getPath().getName()}" not in kept:
                    self._fs.delete(status.getPath(), True)
                    gone += 1
        return gone

    def views(self) -> None:
        """Temporary views of the tables, of the clean questions and of the translated ones."""
        for name, df in self.tables().items():
            df.createOrReplaceTempView(name)
        usable = ", ".join(f"'{s}'" for s in USABLE)
        self.spark.sql(
            "SELECT q.* FROM questions q WHERE NOT EXISTS (SELECT 1 FROM question_exclusions x WHERE x.question_id = q.id)"
        ).createOrReplaceTempView("questions_clean")
        self.spark.sql(
            f"SELECT q.*, t.question_en, t.answer_en, t.explanation_en, t.acceptance_criteria_en, t.handout_text_en, t.status AS translation_status FROM questions_canonical q JOIN translations t ON t.question_id = q.id WHERE t.status IN ({usable})"
        ).createOrReplaceTempView("questions_translated")
