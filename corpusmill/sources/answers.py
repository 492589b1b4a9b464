"""Where reviews are kept as they are made: single calls while a review is under way, one record for each answer.

``Calls`` remembers the answers of a client by record, so that a review that broke off goes on from the call it was
at. ``review_answers`` is a sink: every row becomes a Parquet file of its own, named by ``question_id`` and
``content_hash``, that is there whole or not at all. A task or a job that runs again writes the same files, so that however
often it is committed there is one record for each key. A folder of records is read as any Parquet folder; that of a job
that was committed has a ``_SUCCESS`` beside them, and in ``_commits`` what its tasks told.
"""

from __future__ import annotations

import uuid
from collections.abc import Awaitable, Callable, Iterator
from dataclasses import asdict, dataclass
from typing import Any

import pyarrow as pa
from pyarrow import fs, parquet
from pyspark import TaskContext
from pyspark.sql.datasource import DataSource, DataSourceArrowWriter, WriterCommitMessage

from .site import Store

NAME = "review_answers"
KEY = ("question_id", "content_hash")

Record = dict[str, Any]


class Calls:
    """The client of one review, which asks ``client`` only for what is not remembered of the record in ``store``.

    Calls are told apart by their place in the review and their role: a review makes the same calls again as long as it
    gets the same answers. Each answer is written before the review sees it.
    """

    def __init__(self, client: Any, store: Store, source: Record):
        self.client, self.store, self.name = client, store, f"{source['question_id']}-{source['content_hash']}.json"
        self.known: list[list] = store.get(self.name) or []
        self.place = 0

    async def _call(self, role: str, ask: Callable[..., Awaitable[tuple[Record, Record]]], *told: Record | None) -> tuple[Record, Record]:
        at, self.place = self.place, self.place + 1
        if at < len(self.known) and self.known[at][0] == role:
            return self.known[at][1], self.known[at][2]
        output, usage = await ask(*told)
        self.known[at:] = [[role, dict(output), dict(usage)]]
        self.store.put(self.name, self.known, uuid.uuid4().hex)
        return output, usage

    async def propose(self, source: Record, previous: Record | None, feedback: Record | None) -> tuple[Record, Record]:
        return await self._call("propose", self.client.propose, source, previous, feedback)

    async def critique(self, source: Record, candidate: Record) -> tuple[Record, Record]:
        return await self._call("critique", self.client.critique, source, candidate)

    async def edit(self, source: Record, candidate: Record) -> tuple[Record, Record]:
        return await self._call("edit", self.client.edit, source, candidate)


@dataclass
class Written(WriterCommitMessage):
    """What a task tells the driver: a few numbers, however many records it wrote."""

    partition: int
    records: int


class AnswerWriter(DataSourceArrowWriter):
    def __init__(self, path: str):
        self.path = path

    def write(self, iterator: Iterator[pa.RecordBatch]) -> Written:
        files, folder = fs.FileSystem.from_uri(self.path)
        records = 0
        for batch in iterator:
            keys = zip(*(batch.column(c).to_pylist() for c in KEY))
            for k, (ident, content) in enumerate(keys):
                part = f"{folder}/_{uuid.uuid4().hex}"
                parquet.write_table(pa.Table.from_batches([batch.slice(k, 1)]), part, filesystem=files)
                files.move(part, f"{folder}/{ident}-{content}.parquet")
                records += 1
        return Written(TaskContext.get().partitionId(), records)

    def commit(self, messages: list[Written | None]) -> None:
        """Tell that the job is whole; a second time this changes nothing but adds a note."""
        files, folder = fs.FileSystem.from_uri(self.path)
        Store(f"{self.path}/_commits").put(f"{uuid.uuid4().hex}.json", [asdict(m) for m in messages if m])
        with files.open_output_stream(f"{folder}/_SUCCESS"):
            pass

    def abort(self, messages: list[Written | None]) -> None:
        """Records of a job that failed stay: they are answers that were paid for."""


class ReviewAnswers(DataSource):
    """``results.write.format("review_answers").mode("append").save(folder)``, once registered."""

    @classmethod
    def name(cls) -> str:
        return NAME

    def writer(self, schema, overwrite: bool) -> AnswerWriter:
        missing = [c for c in KEY if c not in schema.fieldNames()]
        if missing or overwrite:
            raise ValueError(f"columns that are missing: {missing}" if missing else "answers are only ever added")
        path = self.options["path"].rstrip("/")
        files, folder = fs.FileSystem.from_uri(path)
        files.create_dir(folder, recursive=True)
        return AnswerWriter(path)


def recorded(path: str) -> bool:
    """Whether the folder holds a record."""
    files, folder = fs.FileSystem.from_uri(path)
    return any(f.base_name.endswith(".parquet") for f in files.get_file_info(fs.FileSelector(folder, allow_not_found=True)))
