"""Schemas of the relations."""

from __future__ import annotations

from pyspark.sql import types as T

_KINDS = {
    "bigint": T.LongType(),
    "int": T.IntegerType(),
    "string": T.StringType(),
    "double": T.DoubleType(),
    "timestamp": T.TimestampType(),
    "ids": T.ArrayType(T.LongType()),
    "names": T.ArrayType(T.StringType()),
    "numbers": T.ArrayType(T.DoubleType()),
    "media": T.ArrayType(T.StructType([T.StructField("role", T.StringType()), T.StructField("url", T.StringType())])),
}


def _struct(text: str) -> T.StructType:
    """'name kind, ..' as a schema; without a kind it is a string."""
    pairs = [(*part.split(), "string")[:2] for part in text.split(",")]
    return T.StructType([T.StructField(name, _KINDS[kind]) for name, kind in pairs])


# The names of the relations' columns, and the values of their status columns.
ENGLISH = ("question_en", "answer_en", "explanation_en", "acceptance_criteria_en", "handout_text_en")
USAGE = ("api_requests", "input_tokens", "cached_input_tokens", "cache_write_input_tokens", "output_tokens", "reasoning_output_tokens")

PACKAGES = _struct("id bigint, title, slug, played_at_start, played_at_end, editor_ids ids, editor_names names, url, status, http_status int, page_hash, questions_found int, first_seen_at timestamp, fetched_at timestamp, error")
QUESTIONS = _struct("id bigint, package_id bigint, question_number int, question, answer, explanation, acceptance_criteria, handout_text, host_note, kind, has_media int, media_urls media, author_ids ids, author_names names, tournament_ids ids, source_references, taken_down int, solve_percentages numbers, correct_answers ids, content_hash")
EXCLUSIONS = _struct("question_id bigint, reason")
CANONICAL = T.StructType([*QUESTIONS.fields, *_struct("printings bigint, playings int, total_teams double, solve_rate double").fields])
PRINTINGS = _struct("question_id bigint, canonical_id bigint")
TRANSLATIONS = _struct(f"question_id bigint, content_hash, status, {', '.join(ENGLISH)}, changes_description, untranslatable_reason, editor_status, translation_attempts bigint, critic_attempts bigint, editor_attempts bigint, {', '.join(f'{u} bigint' for u in USAGE)}, completed_at timestamp")

#: Groups of reprints: the key as a number, its canonical record, the greatest id and the number of its printings.
GROUPS = _struct("group_key bigint, canonical_id bigint, last_id bigint, printings bigint")
#: Questions that were stored since the later stages were last brought up to date.
CHANGES = _struct("question_id bigint")

TABLES = {"packages": PACKAGES, "questions": QUESTIONS, "question_exclusions": EXCLUSIONS, "questions_canonical": CANONICAL, "question_printings": PRINTINGS, "translations": TRANSLATIONS, "question_groups": GROUPS, "question_changes": CHANGES}
KEYS = {"packages": "id", "questions": "id", "question_exclusions": "question_id", "questions_canonical": "id", "question_printings": "question_id", "translations": "question_id", "question_groups": "group_key", "question_changes": "question_id"}

STATUSES = ("translated", "adapted", "untranslatable")
EDITOR_STATUSES = ("unchanged", "edited", "needs_rework", "skipped")
USABLE = ("translated", "adapted")
SETTLED = ("ok", "empty")
# End of the fixed values.
