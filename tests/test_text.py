import re
import unicodedata
from hashlib import sha256
from random import Random

from corpusmill.functions import text, values
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

ODD = st.text(alphabet=" \t\n\r\xa0абВё[]Ведущему:аяЁЙßΣİaZ9_.,ﬁ́-😀", max_size=30)
FEW = settings(max_examples=12, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])


def column(spark, f, texts):
    df = spark.createDataFrame([(i, t) for i, t in enumerate(texts)], "i int, t string")
    return [r.x for r in df.select("i", f(F.col("t")).alias("x")).orderBy("i").collect()]


def model_clean(t):
    lines = [re.sub(r"[ \t]+", " ", x).strip() for x in (t or "").replace("\r\n", "\n").replace("\r", "\n").split("\n")]
    return re.sub(r"\n{3,}", "\n\n", "\n".join(lines)).strip()


def model_key(t):
    folded = unicodedata.normalize("NFKC", t or "").casefold().replace("ё", "е")
    return sha256(re.sub(r"\s+", " ", re.sub(r"[^\w\s]", " ", folded)).strip().encode()).hexdigest()[:16]


@FEW
@given(st.lists(ODD, min_size=20, max_size=40))
def test_clean_text_and_key_against_plain_models(spark, texts):
    assert column(spark, text.clean_text, [*texts, None]) == [model_clean(t) for t in [*texts, None]]
    assert column(spark, text.normalized_key, [*texts, None]) == [model_key(t) for t in [*texts, None]]


NOTE = "[Ведущему: читать медленно]"


def test_host_notes(spark):
    texts = [f"{NOTE} Вопрос про город", f"[Чтецу: раз\nдва] Раздатка:\n\n\n\n  строка   один \nстрока два", "[Ведущему: не закрыто\nСам вопрос", "Обычные [скобки] остаются  тут", "[Ведущему: без конца"]
    assert column(spark, text.without_host_notes, texts) == ["Вопрос про город", "Раздатка:\n\nстрока один\nстрока два", "Сам вопрос", texts[3], texts[4]]
    assert column(spark, text.host_notes, texts) == [NOTE, "[Чтецу: раз\nдва]", "[Ведущему: не закрыто", "", ""]


def test_kinds(spark):
    texts = ["Блиц.\n1. Раз", "Текст\nДуплет: два", "[Ведущему: темп]\n ДУПЛЕТ. Раз", "Это столица", "Полиция и блицкриг"]
    assert column(spark, text.question_kind, texts) == ["blitz", "duplet", "duplet", "normal", "normal"]


def test_exclusion_reasons(spark):
    long = "Назовите город, в котором произошли описанные в тексте события."
    rows = [(long, " \xa0", "no_answer"), ("$1a", "да", "not_a_question"), (text.MEDIA_PLACEHOLDER, "да", "not_a_question"), ("В предыдущем вопросе говорилось о городе, назовите его.", "да", "refers_to_other_question"), ("Раздаточный материал к этому вопросу, увы, утерян навсегда.", "да", "handout_lost"), ("РАЗДАТОЧНЫЙ МАТЕРИАЛ К ЭТОМУ ВОПРОСУ ПОТЕРЯН, извините нас.", "да", "handout_lost"), (long, "да", None), ("Раздаточный материал роздан. Тетрадь утеряна, и дневник тоже.", "да", None), ("😀" * 39, "да", "not_a_question"), ("😀" * 40, "да", None), (None, "да", "not_a_question"), (long, None, "no_answer")]
    df = spark.createDataFrame(rows, "q string, a string, want string")
    assert [r for r in df.select("*", text.exclusion_reason(F.col("q"), F.col("a")).alias("got")).collect() if r.got != r.want] == []


def test_hashes(spark):
    got = spark.range(1).select(text.content_hash(F.lit("в"), F.lit("о"), F.lit(None), F.lit(""), F.lit("x")).alias("h"), text.page_hash(F.lit("<p>é")).alias("p")).first()
    assert got.h == sha256("в\0о\0\0\0x".encode()).hexdigest()[:16] and got.p == sha256("<p>é".encode()).hexdigest()[:16]
    keys = column(spark, text.normalized_key, ["Ёлка, мой друг!", "елка мой   ДРУГ", "другой друг", "за́мок", "ﬁn", "FIN"])
    assert keys[0] == keys[1] != keys[2] and keys[4] == keys[5]


def test_values(spark):
    one = spark.range(1)
    c = lambda x: F.lit(x)
    p, q = values.paired(F.array(c(50.0), c(90.0), c(1.0)), F.array(c(5).cast("long"), c(90).cast("long")))
    row = one.select(
        p.alias("p"), q.alias("q"), values.total_teams(p, q).alias("t"), values.solve_rate(q, values.total_teams(p, q)).alias("r"),
        values.teams(c(0.0), c(3)).alias("none"), values.teams(c(None), c(3)).alias("null"),
        values.ordered_union(F.array(F.array(c(3), c(1)), F.array(c(2), c(3)))).alias("u"),
        values.spaced_json(F.array(c(50.0), c(None).cast("double"))).alias("j"),
        values.cost(c(1_000_000), c(0), c(0), c(0)).alias("c1"), values.cost(c(1_000_000), c(900_000), c(400_000), c(500_000)).alias("c2"),
        values.duration(c(-5)).alias("d0"), values.duration(c(9)).alias("d1"), values.duration(c(75)).alias("d2"), values.duration(c(11_059)).alias("d3"),
        values.recent(c("2025-01-02T10:00"), F.to_date(c("2025-07-01"))).alias("recent"), values.recent(c(None).cast("string"), F.to_date(c("2025-07-01"))).alias("never"),
        values.index_url("u", c(1)).alias("i1"), values.index_url("u", c(3)).alias("i3"),
        F.array(*[values.absolute_url("https://s.x", c(x)) for x in ("http://a/b", "//h/p", "/p", "p")]).alias("urls"),
        F.array(*[values.truthy(c(x)) for x in (None, "false", "0", "[]", "1", "true", '"x"')]).alias("truth"),
        values.compact_json(F.array(c("Ё"), c("b"))).alias("compact"),
    ).first()
    assert row.p == [50.0, 90.0] and row.q == [5, 90] and row.t == 110.0 and row.r == 95 / 110 and row.none == row.null == 0.0
    assert row.u == [3, 1, 2] and row.j == "[50.0, null]" and abs(row.c1 - 0.2) < 1e-12 and abs(row.c2 - (0.018 + 0.1 + 0.6)) < 1e-12
    assert (row.d0, row.d1, row.d2, row.d3) == ("0s", "9s", "1m15s", "3h04m") and row.recent and not row.never
    assert (row.i1, row.i3) == ("u", "u/?page=3") and row.urls == ["http://a/b", "https://h/p", "https://s.x/p", "https://s.x/p"]
    assert row.truth == [0, 0, 0, 0, 1, 1, 1] and row.compact == '["Ё","b"]'


def test_long_texts_of_one_kind_take_no_time(spark):
    """A megabyte of brackets, of blanks, of lines: no stack overflow, and seconds at most for all of them."""
    import time

    n = 1 << 20
    long = ["[a] " * (n // 4), "x" + " " * n + "y", "\n" * n + "Блиц.", " \n" * (n // 2) + "x", "[" * n, "[Ведущему: " + "а" * n, "a\t" * (n // 2), "предыдущ" + "и" * n + " вопрос", "[a]" * (n // 3) + " Дуплет. x"]
    start = time.monotonic()
    assert column(spark, text.question_kind, long) == ["normal", "normal", "blitz", "normal", "normal", "normal", "normal", "normal", "duplet"]
    assert column(spark, text.strip, long[1:4]) == [long[1], "\n" * 0 + "Блиц.", "x"]
    assert [len(x) for x in column(spark, text.clean_text, long)] == [n - 1, 3, 5, 1, n, n + 11, n - 1, n + 15, n // 3 * 3 + 10]
    assert column(spark, lambda c: text.exclusion_reason(c, F.lit("a")), long)[7] == "refers_to_other_question"
    assert column(spark, text.host_notes, [long[0], long[5], long[5] + "\n"]) == ["", "", long[5]]
    assert time.monotonic() - start < 60


def test_adversaries_of_notes_and_reasons_take_no_time(spark):
    """A megabyte of unclosed notes, on many lines or on one, and of repeated stems, in one word or in many."""
    import time

    def times(x, n=1 << 20):
        return x * (n // len(x))

    notes = [times("[Ведущему "), times("[Ведущему\n"), times("[Чтецу: а] "), times("[Ведущему ") + "]", times("[" + " " * 9)]
    words = [times("раздаточн"), times("раздаточн "), times("раздаточн") + "утерян", times("предыдущ"), times("прошл "), times("предыдущ") + " вопрос", times("Раздаточный материал " + "а" * 70 + " утерян ")]
    start = time.monotonic()
    got = column(spark, text.host_notes, notes)
    assert got[0] == "" and got[1].count("[") == notes[1].count("[") and got[2].count("]") == notes[2].count("]") and got[3] == notes[3] and got[4] == ""
    reasons = column(spark, lambda c: text.exclusion_reason(c, F.lit("a")), words)
    assert reasons == [None, None, "handout_lost", None, None, "refers_to_other_question", None]
    assert time.monotonic() - start < 60


_PIECES = ("[", "]", "Ведущему", "ведущему", "Чтецу", "Комментарий для ведущего", "\n", " ", "\t", "а", ":", ".")
_STEMS = ("раздаточн", "РАЗДАТОЧН", "ый", " ", ".", "]", "утерян", "не сохран", "не", "предыдущ", "прошл", "вопрос", "\n", "-", "а" * 30, "_")


def test_notes_and_reasons_equal_the_plain_patterns(spark):
    """The linear forms against the rules written plainly, over random pieces."""
    note = re.compile(r"\[\s*(?:Ведущему|ведущему|Чтецу|чтецу|Комментарий\s+для\s+ведущего)\b(?:[^\]]*\]|[^\n]*(?=\n))")
    refers = re.compile(r"предыдущ\w*\s+вопрос|прошл\w*\s+вопрос")
    lost = re.compile(r"раздаточн\w*[^.\]]{0,60}(?:утерян|утрачен|потерян|не сохран)", re.I)
    random = Random(3)
    texts = ["".join(random.choice(pieces) for _ in range(random.randint(0, 14))) for pieces in (_PIECES, _STEMS) for _ in range(3000)]
    assert column(spark, text.host_notes, texts) == ["\n".join(note.findall(t)) for t in texts]
    long = ["x" * 40 + "." + t for t in texts]
    expected = ["refers_to_other_question" if refers.search(t) else "handout_lost" if lost.search(t) else None for t in long]
    assert column(spark, lambda c: text.exclusion_reason(c, F.lit("a")), long) == expected
    assert {"refers_to_other_question", "handout_lost", None} == set(expected)


def test_clean_texts_are_only_looked_at():
    """What ``UNTIDY`` does not match, cleaning leaves alone; ordinary texts are among it."""
    blanks = "  \n\t\r\xa0 \x85\v\x1cab"
    untidy = re.compile(text.UNTIDY.replace("(?U)", "").replace(r"\z", r"\Z").replace(r"\s", "[\t-\r \x85\xa0 ]"))
    texts = ["".join(Random(i).choices(blanks, k=i % 9)) for i in range(4000)]
    kept = [t for t in texts if not untidy.search(t)]
    assert len(kept) > 400 and all(model_clean(t) == t for t in kept if "\x1c" not in t)
    assert not untidy.search("Назовите город.\nИ реку") and untidy.search("a  b") and untidy.search(" a") and untidy.search("a\n")


def test_notes_in_columns_of_their_own(spark):
    rng = Random(5)
    bits = ["[Ведущему: тихо]", "[Чтецу: а\nб]", "[Ведущему: не закрыто", "\n", " ", "]", "[x]", "Вопрос  про", "\n\n\n"]
    texts = ["".join(rng.choices(bits, k=rng.randrange(8))) for _ in range(300)]
    df = spark.createDataFrame([(t,) for t in texts], "t string")
    for patterns in (text.DEFAULT, text.Patterns(host_note=r"\[x\]|про")):
        got = text.with_notes(df, "t", "heard", "notes", patterns).select("t", "heard", "notes").collect()
        want = df.select("t", text.without_host_notes(F.col("t"), patterns), text.host_notes(F.col("t"), patterns)).collect()
        assert sorted(map(tuple, got)) == sorted(map(tuple, want))
    assert column(spark, text.host_notes, ["a [Ведущему: б\nв] г", "a] [Ведущему: б\nв", "[Ведущему: б"]) == ["[Ведущему: б\nв]", "[Ведущему: б", ""]
