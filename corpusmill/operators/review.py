"""The review stage: which records to offer, the bounded propose/critique/edit fold, and its distributed run.

The fold is a plain function over an injected client; Spark runs it over partitions of pending
records. Records are dictionaries with the keys of the schemas below.
"""

from __future__ import annotations

import asyncio
import contextlib
import json
from collections import Counter
from collections.abc import Callable, Iterator
from dataclasses import dataclass, field
from datetime import datetime, timezone
from typing import Any, Protocol

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..schemas import ENGLISH, TRANSLATIONS, USAGE
from ..sources.answers import Calls
from ..sources.gate import Pass
from ..sources.site import Store
from . import draw
from .funnel import pending

#: Fields that a usable translation must have.
REQUIRED = ENGLISH[:3]
#: Revisions after the first proposal.
MAX_REVISIONS = 2
SOURCE = ("question_id", "content_hash", "question", "answer", "explanation", "acceptance_criteria", "handout_text", "package_title")

# The texts that the fold itself writes.
DISAGREE = "The critic and writer disagree on whether the question is translatable."
EXHAUSTED = "No candidate passed independent review within the revision limit."
BLANK_REASON = "untranslatable_reason is blank"
EMPTY_FIELDS = "Editor returned empty required fields: "
COPY_EDIT = " English copy edit: "
NOT_PASSED = "The translation did not pass independent review."
POLISHED = "Polished the English prose."
UNSAFE = "Safe English copy editing requires substantive puzzle changes."
# End of the fixed values.

Record = dict[str, Any]


class ReviewClient(Protocol):
    """Each call returns (structured output, usage counters)."""

    async def propose(self, source: Record, previous: Record | None, feedback: Record | None) -> tuple[Record, Record]: ...

    async def critique(self, source: Record, candidate: Record) -> tuple[Record, Record]: ...

    async def edit(self, source: Record, candidate: Record) -> tuple[Record, Record]: ...


@dataclass(frozen=True)
class Policy:
    """What a run is told from outside: instructions for the prompts of each role (propose, critique, edit), rounds of revision."""

    instructions: dict[str, str] = field(default_factory=dict)
    max_revisions: int = MAX_REVISIONS

    @classmethod
    def load(cls, path: str) -> Policy:
        """From a JSON object with the fields of this class; unknown ones are an error."""
        with open(path, encoding="utf-8") as text:
            return cls(**json.load(text))

    def prompt(self, role: str, source: Record, **more: Record) -> str:
        """The role's instructions, a blank line, and the task as JSON: the record, and what ``more`` hands on."""
        task = json.loads(prompt(source)) | more
        return f"{self.instructions.get(role, '')}\n\n{json.dumps(task, ensure_ascii=False, indent=2)}".lstrip()


@dataclass
class Verdict:
    """What the fold ends with."""

    candidate: Record
    editor_status: str
    rounds: int
    edits: int
    usage: Counter = field(default_factory=Counter)
    history: list[Record] = field(default_factory=list)


def prompt(source: Record) -> str:
    """The task text's JSON: Russian fields renamed, the package title as it is."""
    return json.dumps({f"{k}_ru": source[k] for k in SOURCE[2:7]} | {"package_title": source["package_title"]}, ensure_ascii=False)


def blank_fields(record: Record) -> list[str]:
    return [f for f in REQUIRED if not str(record.get(f) or "").strip()]


def local_issues(candidate: Record) -> list[str]:
    """What is wrong with a candidate by its form alone."""
    if candidate["status"] == "untranslatable":
        return [] if candidate["untranslatable_reason"].strip() else [BLANK_REASON]
    return [
        f"{f} is blank" for f in (
            *blank_fields(candidate), *([] if candidate["changes_description"].strip() else ["changes_description"]),
        )
    ]


def _called(answer: tuple[Record, Record], usage: Counter) -> Record:
    output, spent = answer
    usage.update(spent)
    return dict(output)


async def review(client: ReviewClient, source: Record, max_revisions: int = MAX_REVISIONS) -> Verdict:
    """Propose and criticise until a candidate is accepted or the rounds are used up; then let the editor see it."""
    usage: Counter = Counter()
    history: list[Record] = []
    previous = feedback = playable = None
    for turn in range(1, max_revisions + 2):
        candidate = _called(await client.propose(source, previous, feedback), usage)
        critique = _called(await client.critique(source, candidate), usage)
        issues = local_issues(candidate)
        given_up = candidate["status"] == "untranslatable"
        if not given_up and not issues:
            playable = candidate
        if critique["decision"] == "accept" and given_up != (critique["accepted_status"] == "untranslatable"):
            issues.append(DISAGREE)
        if issues:
            told = [critique["revision_instructions"], *issues]
            critique |= {
                "decision": "revise", "issues": [*critique["issues"], *issues],
                "revision_instructions": " ".join(t for t in told if t),
            }
        history.append({"attempt": turn, "candidate": candidate, "critique": critique})
        if critique["decision"] == "accept":
            chosen = candidate
        elif turn <= max_revisions:
            previous, feedback = candidate, critique
            continue
        else:
            chosen = playable if critique["accepted_status"] != "untranslatable" else None
        if chosen is not None:
            return await _polish(client, source, chosen | {"status": critique["accepted_status"]}, turn, usage, history)
        reason = critique["summary"].strip() or critique["revision_instructions"].strip() or NOT_PASSED
        nothing = dict.fromkeys(ENGLISH, "") | {
            "status": "untranslatable", "changes_description": EXHAUSTED, "untranslatable_reason": reason,
        }
        return await _polish(client, source, nothing, turn, usage, history)
    raise ValueError("max_revisions is negative")


async def _polish(client: ReviewClient, source: Record, candidate: Record, rounds: int, usage: Counter, history: list[Record]) -> Verdict:
    """The editor's turn. Its texts count only if all required ones are there and it doesn't ask for rework; whether
    anything was edited is told by the texts."""
    if candidate["status"] == "untranslatable":
        return Verdict(candidate, "skipped", rounds, 0, usage, history)
    edit = _called(await client.edit(source, dict(candidate)), usage)
    before, after = ({f: r[f] for f in ENGLISH} for r in (candidate, edit))
    blank = blank_fields(after)
    if blank or edit["decision"] == "needs_rework":
        reason = f"{EMPTY_FIELDS}{', '.join(blank)}." if blank else edit["needs_rework_reason"].strip() or UNSAFE
        status, edit = "needs_rework", edit | before | {"needs_rework_reason": reason}
    elif after == before:
        status, edit = "unchanged", edit | {"needs_rework_reason": ""}
    else:
        status, edit = "edited", edit | {"needs_rework_reason": ""}
        note = f"{candidate['changes_description'].rstrip()}{COPY_EDIT}{edit['edit_summary'].strip() or POLISHED}"
        candidate = candidate | after | {"changes_description": note.strip()}
    history.append({"editor": edit | {"decision": status}})
    return Verdict(candidate, status, rounds, 1, usage, history)


def pending_inputs(canonical: DataFrame, translations: DataFrame, packages: DataFrame, limit: int | None = None, refresh: bool = False, seed: int | None = None) -> DataFrame:
    """Records to review with their package's title: those without a translation, or all with ``refresh``; of these
    exactly ``limit`` drawn at random."""
    rows = canonical if refresh else pending(canonical, translations)
    titles = packages.select(F.col("id").alias("package_id"), F.col("title").alias("package_title"))
    rows = rows.withColumnRenamed("id", "question_id").join(titles, "package_id").select(*SOURCE)
    return rows if limit is None else draw.uniform(rows, "question_id", limit, seed)


def sample_by_hash(rows: DataFrame, key: str, seed: str, n: int) -> DataFrame:
    """A draw of ``n`` rows that depends on key and seed alone, not on partitioning."""
    return draw.least(rows, n, F.sha2(F.concat_ws("|", F.col(key).cast("string"), F.lit(seed)), 256), F.col(key))


#: A translation row, and why there is none.
RESULT = T.StructType([*TRANSLATIONS.fields, T.StructField("failure", T.StringType())])


def run_reviews(inputs: DataFrame, make_client: Callable[[], ReviewClient], concurrency: int = 1000, partitions: int | None = None, fail_fast: bool = False, max_revisions: int = MAX_REVISIONS, calls: str | None = None, gate_pass: Pass | None = None) -> DataFrame:
    """A translation row for each input, or the text of what went wrong in ``failure`` (such rows stay pending).

    At most ``concurrency`` reviews of a partition are under way at once, and each gives its row when it is done. Spark may
    run a task again; write the result once before anything else reads it. With a folder ``calls`` every answer of the client
    is written there before it is used: a review that is run again, in another task or another run, repeats at most the one
    call it was waiting for. With ``gate_pass`` a review also holds a lease of the driver's gate, which bounds all partitions
    together. With ``fail_fast`` the first failure ends the job, at once where there is a gate to tell.
    """

    async def one(client: ReviewClient, gate: asyncio.Semaphore, source: Record) -> Record:
        async with gate, gate_pass.lease() if gate_pass else contextlib.nullcontext():
            row: Record = dict.fromkeys([*TRANSLATIONS.fieldNames(), "failure"])
            row |= {"question_id": source["question_id"], "content_hash": source["content_hash"]}
            try:
                done = await review(Calls(client, Store(calls), source) if calls else client, source, max_revisions)
            except Exception as error:
                if fail_fast:
                    if gate_pass:
                        gate_pass.stop(f"{type(error).__name__}: {error}")
                    raise
                return row | {"failure": f"{type(error).__name__}: {error}"}
            row |= {k: done.candidate[k] for k in ("status", *ENGLISH, "changes_description", "untranslatable_reason")}
            row |= {u: done.usage["requests" if u == "api_requests" else u] for u in USAGE}
            return row | {
                "editor_status": done.editor_status, "translation_attempts": done.rounds,
                "critic_attempts": done.rounds, "editor_attempts": done.edits,
                "completed_at": datetime.now(timezone.utc).replace(tzinfo=None),
            }

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        with asyncio.Runner() as runner:
            for batch in batches:
                client, gate = make_client(), asyncio.Semaphore(max(1, concurrency))
                loop = runner.get_loop()
                waiting = {loop.create_task(one(client, gate, source)) for source in batch.to_dict("records")}
                while waiting:
                    done, waiting = loop.run_until_complete(asyncio.wait(waiting, return_when=asyncio.FIRST_COMPLETED))
                    yield pd.DataFrame([task.result() for task in done], columns=[*TRANSLATIONS.fieldNames(), "failure"])

    rows = inputs.repartition(partitions) if partitions else inputs
    return rows.mapInPandas(run, RESULT)


def run_report(results: DataFrame) -> DataFrame:
    """selected, completed, errors, and the usage of the completed."""
    done = F.col("failure").isNull()
    return results.agg(
        F.count("*").alias("selected"), F.count(F.when(done, 1)).alias("completed"),
        F.count(F.when(~done, 1)).alias("errors"),
        *[F.coalesce(F.sum(F.when(done, F.col(u))), F.lit(0)).alias(u) for u in USAGE],
    )


def last_round(rounds: DataFrame, key: str, turn: str, accepted: Column) -> DataFrame:
    """Per key: rounds used and whether it ended in acceptance, where the first accepted round ends the sequence.

    The relational restatement of the fold's end over recorded rounds.
    """
    first = F.min(F.when(accepted, F.col(turn)))
    return rounds.groupBy(key).agg(F.coalesce(first, F.max(turn)).alias("last_turn"), first.isNotNull().alias("accepted"))
