"""Tables that a job writes for its own later steps, in the folder that driver and executors share."""

from __future__ import annotations

import atexit
import shutil
import tempfile
import threading
import uuid
from collections.abc import Iterator
from contextlib import contextmanager, suppress
from functools import lru_cache

from pyspark import SparkContext
from pyspark.sql import DataFrame, SparkSession

#: Removes a job's shuffle files when it ends, instead of when the driver next collects garbage.
_TIDY = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"


def shared_folder(spark: SparkSession) -> str:
    """The folder that driver and executors share: ``spark.checkpoint.dir``, or else the session's checkpoint folder.

    On a cluster there is no fallback: a folder of the driver's own machine would be another one on each executor.
    """
    folder = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getCheckpointDir()
    if not folder:
        master = spark.sparkContext.master
        if master != "local" and not master.startswith("local["):
            raise RuntimeError("set spark.checkpoint.dir to a folder that all executors share")
        folder = _own_folder()
    return folder.rstrip("/")


@lru_cache(maxsize=1)
def _own_folder() -> str:
    """For a session of a single process (tests, the bench), where the driver is the only executor."""
    folder = tempfile.mkdtemp(prefix="corpusmill-")
    atexit.register(shutil.rmtree, folder, ignore_errors=True)
    return f"file://{folder}"


@contextmanager
def settings(spark: SparkSession, values: dict[str, str]) -> Iterator[None]:
    """Session settings for the jobs that run inside; the former ones are put back."""
    before = {k: spark.conf.get(k, None) for k in values}
    for k, v in values.items():
        spark.conf.set(k, v)
    try:
        yield
    finally:
        for k, v in before.items():
            spark.conf.set(k, v) if v is not None else spark.conf.unset(k)


_writing = threading.Lock()
_writers: dict[str, list] = {}


@contextmanager
def _tidy(spark: SparkSession) -> Iterator[None]:
    """``_TIDY`` for the writes that run inside, of which several may do so side by side: the last one puts the setting back."""
    key = spark.sparkContext.applicationId
    with _writing:
        count, before = _writers.get(key) or [0, spark.conf.get(_TIDY, None)]
        _writers[key] = [count + 1, before]
        spark.conf.set(_TIDY, "true")
    try:
        yield
    finally:
        with _writing:
            count, before = _writers.pop(key)
            if count > 1:
                _writers[key] = [count - 1, before]
            elif before is None:
                spark.conf.unset(_TIDY)
            else:
                spark.conf.set(_TIDY, before)


def staged(df: DataFrame, label: str) -> DataFrame:
    """Write ``df`` to the shared folder and read it back.

    The written table cuts the lineage: an executor lost later costs a reread, not
    the whole history, and every later branch sees the same rows.
    """
    path = f"{shared_folder(df.sparkSession)}/corpusmill/{label}-{uuid.uuid4().hex}"
    discard_later(path)
    with _tidy(df.sparkSession):
        df.write.parquet(path)
    out = df.sparkSession.read.schema(df.schema).parquet(path)
    out._staged_path = path
    return out


def staged_by(parts: list[DataFrame], label: str, key: str, buckets: int) -> DataFrame:
    """Write tables of one schema, one after the other, as a single one in ``buckets`` hash buckets of ``key``, and read it back.

    Joins on the key read the table where it lies: they exchange the other side only.
    """
    spark, name = parts[0].sparkSession, f"{label}-{uuid.uuid4().hex}"
    path, table = f"{shared_folder(spark)}/corpusmill/{name}", name.replace("-", "_")
    discard_later(path)
    columns = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in parts[0].schema.fields)
    spark.sql(f"CREATE TABLE {table} ({columns}) USING parquet CLUSTERED BY (`{key}`) INTO {buckets} BUCKETS LOCATION '{path}'")
    try:
        for part in parts:
            with _tidy(spark):
                part.write.insertInto(table)
    except BaseException:
        spark.sql(f"DROP TABLE IF EXISTS {table}")
        raise
    out = spark.table(table)
    out._staged_path, out._staged_table = path, table
    return out


def discard(*tables: DataFrame) -> None:
    """Delete staged tables that no later plan reads; others are left alone."""
    for table in tables:
        path = getattr(table, "_staged_path", None)
        if path:
            if name := getattr(table, "_staged_table", None):
                table.sparkSession.sql(f"DROP TABLE IF EXISTS {name}")
            _delete(table.sparkSession._jvm, path)
            _left.discard(path)


def _delete(jvm, path: str) -> None:
    where = jvm.org.apache.hadoop.fs.Path(path)
    where.getFileSystem(jvm.org.apache.hadoop.conf.Configuration()).delete(where, True)


#: Folders in the shared folder that go when the driver's process ends: tables that results read lazily.
_left: set[str] = set()


def discard_later(folder: str) -> None:
    """Delete a folder when the driver's process ends."""
    if not _left:
        atexit.register(_discard_left)
    _left.add(folder)


def _discard_left() -> None:
    jvm = SparkContext._jvm
    for path in _left if jvm is not None else ():
        with suppress(Exception):  # the JVM or the store may be gone by now
            _delete(jvm, path)


class Scratch:
    """Stages tables and deletes them at the end of the block, but for those that ``keep`` was told of."""

    def __init__(self, label: str):
        self.label, self.tables, self.kept = label, [], set()

    def __call__(self, df: DataFrame, label: str) -> DataFrame:
        self.tables.append(staged(df, f"{self.label}-{label}"))
        return self.tables[-1]

    def by(self, parts: list[DataFrame], label: str, key: str, buckets: int) -> DataFrame:
        """``staged_by``."""
        self.tables.append(staged_by(parts, f"{self.label}-{label}", key, buckets))
        return self.tables[-1]

    def keep(self, table: DataFrame) -> DataFrame:
        self.kept.add(id(table))
        return table

    def drop(self, *tables: DataFrame) -> None:
        """Delete tables that no later step reads."""
        gone = set(map(id, tables))
        self.tables = [t for t in self.tables if id(t) not in gone]
        discard(*tables)

    def __enter__(self) -> Scratch:
        return self

    def __exit__(self, *_: object) -> None:
        discard(*[t for t in self.tables if id(t) not in self.kept])
