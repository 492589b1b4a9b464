"""Pages of a package site: links, embedded payloads, typed package and question rows."""

from __future__ import annotations

import json
import math
import re
from collections.abc import Callable

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions import text, values

# The site's layout.
BASE_URL = "https://gotquestions.online"
LINK = r"(?i)<a(?=\s)[^>]*?\shref\s*=\s*[\"']/pack/(\d+)(?=[/?#\"'])"
COMMENT = r"(?s)<!--.*?(?:-->|\z)"
CHUNK = r"self\.__next_f\.push\(\[1,(\"(?:[^\"\\]++|\\.)*+\")\]\)"
MARKER = '"pack":'
MEDIA_ROLES = {
    "razdatkaPic": "handout", "audio": "question_audio", "answerPic": "answer", "commentPic": "explanation",
    "commentAudio": "explanation_audio",
}
# End of the fixed values.

_PERSON = "array<struct<id:bigint,name:string>>"
_QUESTION = "id:string,number:int,text:string,answer:string,comment:string,zachet:string,razdatkaText:string,razdatkaPic:string,audio:string,answerPic:string,commentPic:string,commentAudio:string,authors:" + _PERSON + ",tournaments:array<struct<id:bigint>>,source:string,takenDown:string,complexity:array<double>,correct_answers:array<bigint>"
_PACKAGE = f"id:string,title:string,longTitle:string,startDate:string,endDate:string,declared:string,dbchgkinfoslug:string,editors:{_PERSON},questions:array<struct<{_QUESTION}>>"
_TEXTS = ("text", "answer", "comment", "zachet", "razdatkaText", "source")
_PEOPLE = pa.list_(pa.struct({"id": pa.int64(), "name": pa.string()}))
_ASKED = pa.struct({
    "id": pa.string(), "number": pa.int32(), **dict.fromkeys(("text", "answer", "comment", "zachet", "razdatkaText", *MEDIA_ROLES), pa.string()),
    "authors": _PEOPLE, "tournaments": pa.list_(pa.struct({"id": pa.int64()})), "source": pa.string(), "takenDown": pa.string(),
    "complexity": pa.list_(pa.float64()), "correct_answers": pa.list_(pa.int64()),
})
#: ``_PACKAGE`` beside what is wrong, as Python returns them.
_READ = pa.struct({
    "error": pa.string(),
    "package": pa.struct({
        **dict.fromkeys(("id", "title", "longTitle", "startDate", "endDate", "declared", "dbchgkinfoslug"), pa.string()),
        "editors": _PEOPLE, "questions": pa.list_(_ASKED),
    }),
})
#: Pages that Python holds as objects.
PAGES_AT_ONCE = 200
_DECODE = json.JSONDecoder().raw_decode
_PUSH = "self.__next_f.push([1,"
_SPELT = {"NaN": math.nan, "INF": math.inf, "+INF": math.inf, "Infinity": math.inf, "+Infinity": math.inf, "-INF": -math.inf, "-Infinity": -math.inf}


def links(html: Column, pattern: str = LINK) -> Column:
    """The first groups of all matches, without repetitions, in the order of their first appearance."""
    return F.array_distinct(F.regexp_extract_all(html, F.lit(pattern), F.lit(1)))


def package_links(pages: DataFrame) -> DataFrame:
    """page columns, position, id of each package linked from an index page."""
    shown = F.regexp_replace("html", COMMENT, "")
    found = pages.select(*[c for c in pages.columns if c != "html"], F.posexplode(links(shown)).alias("position", "id"))
    return found.withColumn("id", F.col("id").cast("bigint"))


def payload_of(html: str | None) -> tuple[dict | None, str | None]:
    """(typed package object, None) or (None, what is wrong). Nothing in a page makes it raise."""
    try:
        return _payload_of(html or "")
    except RecursionError:
        return None, "the payload is nested too deeply"
    except ValueError as error:
        return None, f"the payload is malformed: {error}"[:200]


def _payload_of(html: str) -> tuple[dict | None, str | None]:
    texts = _chunks(html)
    if texts is None:
        chunks = re.findall(CHUNK, html)
        if not chunks:
            return None, "no embedded chunks"
        try:
            texts = [json.loads(c) for c in chunks]
        except ValueError:
            return None, "a chunk is no JSON string"
    stream = "".join(texts)
    at = stream.find(MARKER)
    start = stream.find("{", at) if at >= 0 else -1
    if start < 0:
        return None, "no package object"
    try:
        package, _ = _DECODE(stream, start)
    except ValueError:
        return None, "the package object is no JSON"
    if "id" not in package or "tours" not in package:
        return None, "the package object lacks id or tours"
    return _typed(package), None


def _chunks(html: str) -> list[str] | None:
    """The decoded chunks, found and decoded in one go; None where something that looks like a chunk is none."""
    found: list[str] = []
    at = html.find(_PUSH + '"')
    while at >= 0:
        try:
            chunk, end = _DECODE(html, at + len(_PUSH))
        except ValueError:
            return None
        if not html.startswith("])", end):
            return None
        found.append(chunk)
        at = html.find(_PUSH + '"', end)
    return found or None


def _typed(package: dict) -> dict:
    """Lists of objects without what isn't one, and texts as strings, so that one schema reads every page."""
    declared = package.get("questions")
    texts = {c: _text(package.get(c)) for c in ("id", "title", "longTitle", "startDate", "endDate", "dbchgkinfoslug")}
    return texts | {
        "declared": str(declared) if isinstance(declared, int) else None,
        "editors": _persons(package.get("editors")),
        "questions": [_question(q) for t in _objects(package["tours"]) for q in _objects(t.get("questions")) if q.get("id") is not None],
    }


def _question(q: dict) -> dict:
    get = q.get
    number, taken = _whole(get("number")), get("takenDown")
    typed = {c: x if (x := get(c)) is None or type(x) is str else str(x) for c in _TEXTS if c in q}
    typed |= {c: q[c] for c in MEDIA_ROLES if c in q and isinstance(q[c], str)}
    typed["id"] = _text(q["id"])
    typed["number"] = number if number is not None and -(1 << 31) <= number < 1 << 31 else None
    typed["authors"] = _persons(get("authors"))
    typed["tournaments"] = [{"id": _whole(t.get("id"))} for t in _objects(get("tournaments"))]
    typed["takenDown"] = "true" if taken is True else "false" if taken is False else json.dumps(taken)
    typed["complexity"] = _listed(get("complexity"), _double)
    typed["correct_answers"] = _listed(get("correct_answers"), _long)
    return typed


def _objects(x: object) -> list[dict]:
    return [i for i in x if isinstance(i, dict)] if isinstance(x, list) else []


def _persons(x: object) -> list[dict]:
    return [{"id": _whole(p.get("id")), "name": _text(p.get("name"))} for p in _objects(x)]


def _whole(x: object) -> int | None:
    if type(x) is int and -(1 << 62) < x < 1 << 62:
        return x
    if isinstance(x, str) and re.fullmatch(r"[+-]?\d+", x.strip()):
        x = int(x) if len(x.strip()) <= 20 else 1 << 63
    if not isinstance(x, int):
        return None
    if not -(1 << 63) <= x < 1 << 63:
        raise ValueError("a number of too many digits")
    return int(x)


def _listed(x: object, number: Callable[[object], float | None]) -> list | None:
    """A list of numbers and nulls; null for anything else."""
    try:
        return [None if i is None else number(i) for i in x] if isinstance(x, list) else None
    except (TypeError, OverflowError):
        return None


def _double(x: object) -> float:
    if isinstance(x, str) and x in _SPELT:
        return _SPELT[x]
    if isinstance(x, bool) or not isinstance(x, (int, float)):
        raise TypeError
    return float(x)


def _long(x: object) -> int:
    if isinstance(x, bool) or not isinstance(x, int):
        raise TypeError
    if not -(1 << 63) <= x < 1 << 63:
        raise OverflowError
    return x


def _text(x: object) -> str | None:
    return x if x is None or isinstance(x, str) else str(x)


def payload_batch(html: pa.Array) -> pa.Array:
    """A batch's pages, read by a few at a time, since objects take more memory than columns."""
    return pa.concat_arrays([_read(html.slice(at, PAGES_AT_ONCE)) for at in range(0, max(len(html), 1), PAGES_AT_ONCE)])


def _read(html: pa.Array) -> pa.Array:
    read = [{"package": package, "error": error} for package, error in map(payload_of, html.to_pylist())]
    try:
        return pa.array(read, _READ)
    except UnicodeEncodeError:  # half a surrogate pair, which JSON can spell, does not leave Python
        return pa.array([_whole_characters(r) for r in read], _READ)


def _whole_characters(read: dict) -> dict:
    try:
        json.dumps(read, ensure_ascii=False).encode()
    except UnicodeEncodeError:
        return {"error": "the payload has half a surrogate pair"}
    return read


def _payload(html: str) -> Column:
    """What the column's pages hold; called not deterministic, so that a filter on what follows from it doesn't evaluate it once more."""
    return F.arrow_udf(payload_batch, f"error:string,package:struct<{_PACKAGE}>").asNondeterministic()(html)


def _media(q: Column) -> Column:
    entries = [F.struct(F.lit(role).alias("role"), F.when(text.strip(q[f]) != "", values.absolute_url(BASE_URL, text.strip(q[f]))).alias("url")) for f, role in MEDIA_ROLES.items()]
    found = F.filter(F.array(*entries), lambda m: m["url"].isNotNull())
    return F.when(F.coalesce(*[q[f] for f in MEDIA_ROLES]).isNotNull(), found).otherwise(F.array().cast("array<struct<role:string,url:string>>"))


def _people(people: Column) -> tuple[Column, Column]:
    held = F.coalesce(people, F.array().cast(_PERSON))
    return F.transform(held, lambda p: p["id"]), F.transform(held, lambda p: text.clean_text(p["name"]))


def parse(pages: DataFrame, patterns: text.Patterns = text.DEFAULT) -> DataFrame:
    """Columns of ``pages`` (id, html, ..) but html, with page_hash, parse_error, package (struct) and questions (array of raw structs).

    A page whose declared number of questions differs from the parsed one, or with an id that is no number, is a
    parse error, as is any malformed payload; the rest of the crawl goes on.
    """
    own = [c for c in pages.columns if c != "html"]
    read = pages.select(*own, text.page_hash(F.col("html")).alias("page_hash"), _payload("html").alias("payload"))
    read = read.withColumn("raw", F.col("payload.package"))
    read = read.withColumn("questions", F.coalesce("raw.questions", F.array().cast(f"array<struct<{_QUESTION}>>")))
    bad_id = F.expr("try_cast(raw.id AS bigint)").isNull() | F.exists("questions", lambda q: q["id"].try_cast("bigint").isNull())
    declared = F.expr("try_cast(raw.declared AS int)")
    count = F.size("questions")
    error = (
        F.when(F.col("payload.error").isNotNull(), F.col("payload.error"))
        .when(F.col("raw").isNull(), "unreadable payload")
        .when(bad_id, "an id is no number")
        .when(declared != count, F.concat(F.lit("declared "), declared.cast("string"), F.lit(" questions, parsed "), count.cast("string")))
    )
    editor_ids, editor_names = _people(F.col("raw.editors"))
    title = text.clean_text(F.col("raw.title"))
    date = lambda c: F.nullif(text.clean_text(F.col(f"raw.{c}")), F.lit(""))
    package = F.struct(
        F.expr("try_cast(raw.id AS bigint)").alias("id"),
        F.when(title == "", text.clean_text(F.col("raw.longTitle"))).otherwise(title).alias("title"),
        text.clean_text(F.col("raw.dbchgkinfoslug")).alias("slug"),
        date("startDate").alias("played_at_start"),
        date("endDate").alias("played_at_end"),
        editor_ids.alias("editor_ids"),
        editor_names.alias("editor_names"),
    )
    return read.select(*own, "page_hash", error.alias("parse_error"), package.alias("package"), "questions")


def question_rows(parsed: DataFrame, patterns: text.Patterns = text.DEFAULT) -> DataFrame:
    """Typed question rows of parsed pages, with ``position`` in the page."""
    own = [c for c in parsed.columns if c not in ("package", "questions", "page_hash", "parse_error", "id")]
    each = parsed.select(F.col("package.id").alias("package_id"), *own, "questions")  # first, or else whole packages are made for their ids
    each = each.select("package_id", *own, F.posexplode("questions").alias("position", "q"))
    q, raw, shown = F.col("q"), F.col("raw_text"), F.col("shown")
    each = each.withColumn("raw_text", text.clean_text(q["text"]))  # columns of their own, or else each use cleans the text again
    each = each.withColumn("shown", F.when(raw == "", text.MEDIA_PLACEHOLDER).otherwise(raw))
    each = text.with_notes(each, "shown", "heard", "notes", patterns)
    author_ids, author_names = _people(q["authors"])
    rows = each.select(
        *[c for c in each.columns if c not in ("q", "raw_text", "shown", "heard", "notes")],
        q["id"].cast("bigint").alias("id"),
        q["number"].alias("question_number"),
        F.col("heard").alias("question"),
        text.clean_text(q["answer"]).alias("answer"),
        text.clean_text(q["comment"]).alias("explanation"),
        text.clean_text(q["zachet"]).alias("acceptance_criteria"),
        text.clean_text(q["razdatkaText"]).alias("handout_text"),
        F.col("notes").alias("host_note"),
        text.question_kind(shown, patterns).alias("kind"),
        _media(q).alias("media_urls"),
        author_ids.alias("author_ids"),
        author_names.alias("author_names"),
        F.transform(F.coalesce(q["tournaments"], F.array().cast("array<struct<id:bigint>>")), lambda t: t["id"]).alias("tournament_ids"),
        F.coalesce(text.strip(q["source"]), F.lit("")).alias("source_references"),
        values.truthy(q["takenDown"]).alias("taken_down"),
        F.coalesce(q["complexity"], F.array().cast("array<double>")).alias("solve_percentages"),
        F.coalesce(q["correct_answers"], F.array().cast("array<bigint>")).alias("correct_answers"),
    )
    return rows.withColumn("has_media", (F.size("media_urls") > 0).cast("int")).withColumn(
        "content_hash", text.content_hash(*map(F.col, text.CONTENT_FIELDS)),
    )
