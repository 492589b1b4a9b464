"""Text functions as column expressions.

Every pattern carries Java's (?U) flag where it touches letters or white space, and spells word
characters as ``[\\p{L}\\p{N}_]``. Patterns are held in ``Patterns`` so that the same operators run on
other languages.
"""

from __future__ import annotations

import unicodedata
from dataclasses import dataclass
from functools import reduce

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

# The patterns and limits of the Russian quiz corpus. Possessive quantifiers, starting at the first of
# several blanks or of a word, looking for a stem only where a word has it first, and for a blank before anything behind
# it, change no match; they keep Java's matcher from recursing or going over long texts again.
NOTE_OPENER = r"(?U)\[\s*+(?:Ведущему|ведущему|Чтецу|чтецу|Комментарий\s++для\s++ведущего)\b"
MULTIPART = r"(?U)(?:^\s*+|(?<!\s)[\s&&[^\n]]*+\n\s*+)(?:\[[^\]]*+\]\s*+)*+(Блиц|Дуплет|БЛИЦ|ДУПЛЕТ)\b"
BLITZ = "блиц"
REFERS_TO_OTHER = r"(?U)(?<![\p{L}\p{N}_])(?>[\p{L}\p{N}_]*?(?:предыдущ|прошл))[\p{L}\p{N}_]*+\s++вопрос"
HANDOUT_LOST = (
    r"(?iU)(?<![\p{L}\p{N}_])(?>[\p{L}\p{N}_]*?раздаточн)"
    r"(?:[\p{L}\p{N}_]*?(?:утерян|утрачен|потерян|не сохран)|[\p{L}\p{N}_]*+[^.\]]{0,60}?(?:утерян|утрачен|потерян|не сохран))"
)
#: White space that ``clean_text`` could change: other than a space or a line end, beside more, or at an end.
UNTIDY = r"(?U)\A\s|\s(?:(?<![ \n])|(?=\s|\z))"
MIN_QUESTION_LENGTH = 40
MEDIA_PLACEHOLDER = "[Media question; see media URLs]"
# End of the fixed values.

#: The fields that make up the content hash, in order.
CONTENT_FIELDS = ("question", "answer", "explanation", "acceptance_criteria", "handout_text")


@dataclass(frozen=True)
class Patterns:
    """What the classifying functions look for.

    A presenter's note goes from ``note_opener`` to the next ``]`` or, where there is none, to the end of its line if the
    text goes on after it; or it is whatever ``host_note`` matches, if that is given.
    """

    note_opener: str = NOTE_OPENER
    host_note: str | None = None
    multipart: str = MULTIPART
    blitz: str = BLITZ
    refers_to_other: str = REFERS_TO_OTHER
    handout_lost: str = HANDOUT_LOST
    min_length: int = MIN_QUESTION_LENGTH


DEFAULT = Patterns()


def present(c: Column) -> Column:
    """The string, '' for null."""
    return F.coalesce(c.cast("string"), F.lit(""))


def strip(c: Column) -> Column:
    """Without white space (of any script) at the ends. A run of it is looked at once, wherever it stands."""
    return F.regexp_replace(c, r"(?U)(?=\s)(?:^\s++|(?<!\s)\s++$)", "")


def _tidy_lines(c: Column) -> Column:
    """Runs of spaces and tabs as one space; lines without white space at their ends."""
    return F.regexp_replace(_one_blank(c), r"(?Um)(?=\s)(?:^[\s&&[^\n]]++|(?<![\s&&[^\n]])[\s&&[^\n]]++$)", "")


def _one_blank(c: Column) -> Column:
    """Runs of spaces and tabs as one space; a single space is no match."""
    return F.regexp_replace(c, r" [ \t]++|\t[ \t]*+", " ")


def clean_text(c: Column) -> Column:
    """Source text with LF line ends, tidy lines, at most one blank line in a row, and no white space around; '' for null.

    Takes time in proportion to the text, whatever its blanks; a text that is clean is only looked at.
    """
    c = c.cast("string")
    unix = F.regexp_replace(c, r"\r\n?", "\n")
    tidy = strip(F.regexp_replace(_tidy_lines(unix), r"\n{3,}", "\n\n"))
    return F.coalesce(F.when(c.rlike(UNTIDY), tidy).otherwise(c), F.lit(""))


Piece = tuple[Column, str | None]


def _note_parts(c: Column, patterns: Patterns) -> list[Piece]:
    """The text in pieces, each with the pattern of the notes in it.

    Up to the last ``]`` every note is closed; after it none is, and those on the last line are no notes. So whether a
    note is closed is decided once, and no opener looks through the rest of the text for itself.
    """
    if patterns.host_note:
        return [(c, patterns.host_note)]
    rest = F.substring_index(c, "]", -1)
    last = F.substring_index(rest, "\n", -1)
    closed, lines = (F.substring(x, F.lit(1), F.length(x) - F.length(y)) for x, y in ((c, rest), (rest, last)))
    return [(closed, patterns.note_opener + r"[^\]]*+\]"), (lines, patterns.note_opener + r"[^\n]*+(?=\n)"), (last, None)]


def _found(parts: list[Piece]) -> Column:
    return F.array_join(F.concat(*[F.regexp_extract_all(part, F.lit(note), F.lit(0)) for part, note in parts if note]), "\n")


def _left(parts: list[Piece]) -> Column:
    left = F.concat(*[F.regexp_replace(part, note, "") if note else part for part, note in parts])
    return strip(_tidy_lines(F.regexp_replace(_one_blank(left), r"\n{3,}", "\n\n")))


def _noted(parts: list[Piece]) -> Column:
    return reduce(Column.__or__, [part.rlike(note) for part, note in parts if note])


def host_notes(c: Column, patterns: Patterns = DEFAULT) -> Column:
    """The presenter's notes in the text, one to a line; '' if none."""
    return _found(_note_parts(c, patterns))


def without_host_notes(c: Column, patterns: Patterns = DEFAULT) -> Column:
    """The text a player hears: untouched if it has no note, else tidied after their removal."""
    parts = _note_parts(c, patterns)
    return F.when(_noted(parts), _left(parts)).otherwise(c)


def with_notes(rows: DataFrame, name: str, heard: str, notes: str, patterns: Patterns = DEFAULT) -> DataFrame:
    """``rows`` with ``without_host_notes`` and ``host_notes`` of the text (no null) in column ``name``, whose pieces are made once."""
    parts = _note_parts(F.col(name), patterns)
    pieces = [(F.col(f"_piece{i}"), note) for i, (_, note) in enumerate(parts)]
    each = rows.select("*", *[part.alias(f"_piece{i}") for i, (part, _) in enumerate(parts)])
    each = each.withColumn("_noted", _noted(pieces))
    return each.select(
        *rows.columns, F.when(F.col("_noted"), _left(pieces)).otherwise(F.col(name)).alias(heard),
        F.when(F.col("_noted"), _found(pieces)).otherwise("").alias(notes),
    )


def question_kind(c: Column, patterns: Patterns = DEFAULT) -> Column:
    """blitz, duplet or normal, by the first multi-part marker that starts a line; normal for null.

    Long texts, also of brackets or blanks only, take time in proportion to each line's run of brackets.
    """
    marker = F.lower(F.regexp_extract(c, patterns.multipart, 1))
    return F.when(marker == "", "normal").when(marker == patterns.blitz, "blitz").otherwise("duplet")


def exclusion_reason(question: Column, answer: Column, patterns: Patterns = DEFAULT) -> Column:
    """Why a row is no usable question, by the first rule that fires; null if it is one."""
    return (
        F.when(strip(present(answer)) == "", "no_answer")
        .when(F.length(strip(present(question))) < patterns.min_length, "not_a_question")
        .when(question.rlike(patterns.refers_to_other), "refers_to_other_question")
        .when(question.rlike(patterns.handout_lost), "handout_lost")
    )


def short_hash(c: Column) -> Column:
    """The first 16 hex digits of SHA-256."""
    return F.substring(F.sha2(c, 256), 1, 16)


page_hash = short_hash


def content_hash(*fields: Column) -> Column:
    """Hash of the fields with NUL between; null counts as ''."""
    return short_hash(F.concat_ws("\0", *map(present, fields)))


def _squeeze(folded: Column) -> Column:
    """Anything but letters, digits and _ as single spaces, none at the ends."""
    return strip(F.regexp_replace(F.regexp_replace(folded, r"(?U)[^\p{L}\p{N}_\s]", " "), r"(?U)\s+", " "))


def native_key(c: Column) -> Column:
    """The normalised hash without Python: exact for text that NFKC leaves alone and whose only case folding beyond
    lower case is that of sharp s."""
    folded = reduce(lambda x, pair: F.replace(x, F.lit(pair[0]), F.lit(pair[1])), [("ß", "ss"), ("ё", "е")], F.lower(present(c)))
    return short_hash(_squeeze(folded))


def normalized_key(c: Column) -> Column:
    """Hash that is equal for texts alike but for case, punctuation, spacing and compatibility forms.

    ASCII text is folded by Spark; only the rest passes through Python, to which the others' rows are nulls.
    """
    folded = F.coalesce(F.when(_plain(c), F.lower(c)), _fold(F.when(~_plain(c), c)), F.lit(""))
    return short_hash(_squeeze(F.replace(folded, F.lit("ё"), F.lit("е"))))


def _plain(c: Column) -> Column:
    return F.octet_length(c) == F.length(c)


def fold_series(texts: pd.Series) -> pd.Series:
    return texts.map(lambda t: None if t is None else unicodedata.normalize("NFKC", t).casefold())


_fold = F.pandas_udf(fold_series, T.StringType())
