"""Tables in buckets, of which an upsert writes only those that it touches.

A bucket is one Parquet file of at most about BUCKET_ROWS rows. The manifest, a JSON file, lists the buckets with the range
of their keys and their number of rows; beside the buckets stands a Bloom filter of each one's keys. A batch of rows is
compared with the ranges, then with the filters, then with the keys of the buckets that are left; the buckets that hold one
of its keys are written anew together with the batch, and the others stay as they are. Every key is in one bucket. New keys
go to new buckets; small buckets, which many small batches leave, are taken along whenever a batch of their size comes, so
that a row is written again a logarithmic number of times, not once for each batch.

Nothing is ever overwritten: an upsert makes a new version of the manifest, and whoever points to it makes it current.
"""

from __future__ import annotations

import json
import math
import uuid
from collections.abc import Iterator
from dataclasses import asdict, dataclass
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyarrow import dataset, fs
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..staging import staged

#: Rows of a bucket, and bits and hashes of its filter for each key (about 1 in 120 other keys passes).
BUCKET_ROWS, BITS, HASHES = 100_000, 10, 7


@dataclass(frozen=True)
class Bucket:
    """One file: its path below the table's folder, that of its filter, its least and greatest key, its rows."""

    file: str
    filters: str
    low: int
    high: int
    rows: int


def _spread(keys: np.ndarray, seed: int) -> np.ndarray:
    """A 64-bit hash of integers, by multiplications and shifts."""
    x = keys.astype(np.int64).view(np.uint64) + np.uint64(seed)
    for factor in (0xFF51AFD7ED558CCD, 0xC4CEB9FE1A85EC53):
        x = (x ^ (x >> np.uint64(33))) * np.uint64(factor)
    return x ^ (x >> np.uint64(33))


def _places(keys: np.ndarray, bits: int) -> np.ndarray:
    """The bits of each key, a row for each hash."""
    one, step = _spread(keys, 0x9E3779B97F4A7C15), _spread(keys, 0x2545F4914F6CDD1D) | np.uint64(1)
    return (one + np.arange(HASHES, dtype=np.uint64)[:, None] * step) % np.uint64(bits)


def bloom(keys: np.ndarray) -> bytes:
    """A filter of the keys."""
    flags = np.zeros(max(64, len(keys) * BITS + 7 & ~7), np.uint8)
    flags[_places(keys, len(flags)).ravel().astype(np.int64)] = 1
    return np.packbits(flags).tobytes()


def passes(keys: np.ndarray, filtered: bytes) -> np.ndarray:
    """Whether each key may be among those that the filter was made of."""
    flags = np.frombuffer(filtered, np.uint8)
    at = _places(keys, 8 * len(flags)).astype(np.int64)
    return ((flags[at >> 3] >> (7 - (at & 7))) & 1).all(axis=0)


class BucketTable:
    """A version of a table: its folder, key (a bigint that is never null), schema, and the manifest's buckets."""

    def __init__(self, spark: SparkSession, folder: str, schema: T.StructType, key: str, buckets: list[Bucket]):
        self.spark, self.folder, self.schema, self.key, self.buckets = spark, folder, schema, key, buckets

    @classmethod
    def load(cls, spark: SparkSession, folder: str, schema: T.StructType, key: str, manifest: str) -> BucketTable:
        """From the text of a manifest."""
        return cls(spark, folder, schema, key, [Bucket(**b) for b in json.loads(manifest)])

    def manifest(self) -> str:
        return json.dumps([asdict(b) for b in self.buckets])

    def read(self, buckets: list[Bucket] | None = None) -> DataFrame:
        """The rows of all buckets, or of some."""
        some = self.buckets if buckets is None else buckets
        if not some:
            return self.spark.createDataFrame([], self.schema)
        return self.spark.read.schema(self.schema).parquet(*[f"{self.folder}/{b.file}" for b in some])

    def candidates(self, keys: DataFrame) -> list[Bucket]:
        """Buckets whose range and filter admit one of the keys (a column). A task reads a bucket's filter once."""
        if not self.buckets:
            return []
        low, high = (np.array([getattr(b, side) for b in self.buckets], np.int64) for side in ("low", "high"))
        places = [(f"{self.folder}/{b.filters}", b.file) for b in self.buckets]

        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            known = lru_cache(maxsize=64)(_filter)
            touched = np.zeros(len(low), bool)
            for batch in batches:
                own = np.unique(batch.column(0).to_numpy(zero_copy_only=False))
                first, last = np.searchsorted(own, low, side="left"), np.searchsorted(own, high, side="right")
                for b in np.flatnonzero((first < last) & ~touched):
                    touched[b] = passes(own[first[b] : last[b]], known(*places[b])).any()
            yield pa.RecordBatch.from_arrays([pa.array(np.flatnonzero(touched), pa.int64())], ["bucket"])

        found = keys.select(F.col(keys.columns[0]).cast("long").alias("k")).filter("k is not null").mapInArrow(run, "bucket long").distinct()
        return [self.buckets[r.bucket] for r in found.collect()]  # at most a number for each bucket

    def lookup(self, keys: DataFrame) -> DataFrame:
        """The rows with one of the keys (a column, staged or cheap); only buckets that may hold one are read."""
        return self.read(self.candidates(keys)).join(self._keys(keys), self.key, "left_semi")

    def _keys(self, keys: DataFrame) -> DataFrame:
        return keys.select(F.col(keys.columns[0]).cast("long").alias(self.key)).distinct()

    def _holders(self, keys: DataFrame) -> list[Bucket]:
        """The buckets that hold one of the keys: candidates, of which the keys are read."""
        some = self.candidates(keys)
        if not some:
            return []
        held = self.read(some).select(self.key, F.element_at(F.split(F.col("_metadata.file_path"), "/"), -1).alias("file"))
        names = {r.file for r in held.join(self._keys(keys), self.key, "left_semi").select("file").distinct().collect()}
        return [b for b in some if b.file.rsplit("/", 1)[1] in names]

    def upsert(self, batch: DataFrame, gone: DataFrame | None = None) -> BucketTable:
        """The version in which the rows of ``batch``, one for each key, replace or join those stored.

        Rows whose keys are in ``gone`` (a column) and not in the batch leave. The batch is staged.
        """
        batch = staged(batch.select(*self.schema.fieldNames()), "bucket-batch")
        out = batch.select(self.key) if gone is None else staged(batch.select(self.key).union(gone.select(F.col(gone.columns[0]).cast("long"))), "bucket-keys")
        added = batch.count()
        touched = self._holders(out)
        rows = added + sum(b.rows for b in touched)
        for b in sorted(set(self.buckets) - set(touched), key=lambda b: b.rows):
            if b.rows > min(rows, BUCKET_ROWS // 2) or not added:
                break
            touched.append(b)  # a small one, no larger than what is written anyway
            rows += b.rows
        if not touched and not added:
            return self
        left = self.read(touched).join(self._keys(out), self.key, "left_anti")
        kept = [b for b in self.buckets if b not in touched]
        return BucketTable(self.spark, self.folder, self.schema, self.key, kept + self._written(left.unionByName(batch), rows))

    def _written(self, rows: DataFrame, count: int) -> list[Bucket]:
        """New buckets of the rows, about ``count``, by ranges of their keys, with their filters."""
        version = uuid.uuid4().hex
        parts = max(1, math.ceil(count / BUCKET_ROWS))
        dealt = rows.repartitionByRange(parts, self.key) if parts > 1 else rows.coalesce(1)
        dealt.sortWithinPartitions(self.key).write.parquet(f"{self.folder}/{version}/rows")
        name = F.element_at(F.split(F.col("_metadata.file_path"), "/"), -1)
        own = self.spark.read.schema(self.schema).parquet(f"{self.folder}/{version}/rows").select(F.col(self.key).alias("k"), name.alias("file"))
        # a list of keys for each file: files are bounded by the range partitioning
        lists = own.groupBy("file").agg(F.min("k").alias("low"), F.max("k").alias("high"), F.count("*").alias("rows"), F.collect_list("k").alias("keys"))

        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for batch in batches:
                for k in range(batch.num_rows):
                    part = batch.slice(k, 1)
                    made = bloom(part.column(4).flatten().to_numpy())
                    yield pa.RecordBatch.from_arrays([*part.columns[:4], pa.array([made], pa.binary())], ["file", "low", "high", "rows", "bloom"])

        lists.mapInArrow(run, "file string, low long, high long, rows long, bloom binary").write.parquet(f"{self.folder}/{version}/filters")
        found = self.spark.read.parquet(f"{self.folder}/{version}/filters").select("file", "low", "high", "rows").collect()
        return [Bucket(f"{version}/rows/{r.file}", f"{version}/filters", r.low, r.high, r.rows) for r in sorted(found, key=lambda r: r.low)]


def _filter(folder: str, file: str) -> bytes:
    files, path = fs.FileSystem.from_uri(folder)
    name = file.rsplit("/", 1)[1]
    return dataset.dataset(path, format="parquet", filesystem=files).to_table(columns=["bloom"], filter=dataset.field("file") == name).column(0)[0].as_py()
