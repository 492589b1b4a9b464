import hashlib
import re

from corpusmill.llm import decontam
from corpusmill.llm.queries import table

SF = "/root/testdata/sf0.001"
WORD = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")


def words(text):
    lowered = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "")
    return WORD.findall(lowered)


def brute(docs, items, size=10):
    """Results by plain comparison of word lists."""
    grams = {}
    for item, text in items:
        own = words(text)
        n = min(size, len(own))
        for i in range(len(own) - n + 1 if n else 0):
            grams.setdefault(tuple(own[i : i + n]), set()).add(item)
    out = []
    for doc, text in docs:
        own, hit, found = words(text), set(), set()
        for n in {len(g) for g in grams}:
            for i in range(len(own) - n + 1):
                if (g := tuple(own[i : i + n])) in grams:
                    hit.update(range(i, i + n))
                    found |= grams[g]
        out.append((doc, len(own), len(hit), len(found), hashlib.sha256(",".join(sorted(map(str, found))).encode()).hexdigest(), bool(hit)))
    return sorted(out, key=str)


def rows(df):
    return sorted(map(tuple, df.collect()), key=str)


def test_matches_brute_force_on_given_tables(spark):
    docs, items = table(spark, SF, "documents"), table(spark, SF, "benchmark")
    got = rows(decontam.hits(docs, items))
    assert got == brute([(r.doc_id, r.text) for r in docs.collect()], [tuple(r) for r in items.collect()])
    assert any(r[5] for r in got)


CASES = [(1, "a b c d e f g h i j k"), (2, "x a b c d e f g h i j k y"), (3, None), (4, ""), (5, "Short One"), (5, "Short One"), (6, "... short\none! short one"), (7, "é" * 50_000 + " a b c d e f g h i J"), (None, "a b c d e f g h i j")]
ITEMS = [(10, "A b c d e f g h i j"), (9, "a b c d e f g h i j"), (11, "short one"), (12, None), (13, "!!"), (None, "x a")]


def test_edge_cases_and_blocks(spark, monkeypatch):
    docs = spark.createDataFrame([(*c, "extra") for c in CASES], "doc_id long, text string, hits string")
    items = spark.createDataFrame(ITEMS, "item_id long, text string")
    expected = brute(CASES, [i for i in ITEMS if i[0] is not None])
    assert rows(decontam.hits(docs, items)) == expected
    monkeypatch.setattr(decontam, "BLOCK_ROWS", 1)
    assert rows(decontam.hits(docs, items)) == expected


def test_empty_tables(spark):
    docs = spark.createDataFrame(CASES, "doc_id long, text string")
    none = spark.createDataFrame([], "item_id long, text string")
    assert not any(r.contaminated for r in decontam.hits(docs, none).collect())
    assert decontam.hits(docs.limit(0), none).count() == 0


def test_cut_keeps_columns_and_clean_rows(spark):
    docs = spark.createDataFrame([(1, "One. A b c d e f g h i j! Two three four five six seven eight nine ten eleven.", 5, "q"), (2, "a b c d e f g h i j", 3, "r"), (3, None, None, None), (4, "clean", 5, "s")], "doc_id long, text string, n_chars long, spans string")
    items = spark.createDataFrame(ITEMS, "item_id long, text string")
    out = decontam.decontaminate(docs, items)
    assert out.columns == docs.columns
    text = "One. ! Two three four five six seven eight nine ten eleven."
    assert rows(out) == sorted([(1, text, len(text), "q"), (3, None, None, None), (4, "clean", 5, "s")], key=str)


def test_blocks_change_nothing_for_overlapping_items(spark, monkeypatch):
    """Two items overlap in a document: the one block's hits must not be cut before the other one is scanned."""
    a_to_o = [chr(ord("a") + i) for i in range(15)]
    docs = spark.createDataFrame([(1, " ".join(["q1"] * 12 + a_to_o + ["q2"] * 12), 0, b"x"), (2, " ".join(a_to_o), 0, None), (2, None, 0, None), (3, "clean text", 7, None)], "doc_id long, text string, n_chars long, rest binary")
    items = spark.createDataFrame([(1, " ".join(a_to_o[:10])), (2, " ".join(a_to_o[5:])), (3, "")], "item_id long, text string")
    whole = rows(decontam.decontaminate(docs, items)), rows(decontam.hits(docs, items))
    assert [r[1] for r in whole[0]] == [" ".join(["q1"] * 12) + "  " + " ".join(["q2"] * 12), None, "clean text"]
    monkeypatch.setattr(decontam, "BLOCK_ROWS", 1)
    assert (rows(decontam.decontaminate(docs, items)), rows(decontam.hits(docs, items))) == whole
