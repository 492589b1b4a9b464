import hashlib
import sys
from pathlib import Path

sys.path.insert(0, str(Path(__file__).parents[2]))
sys.path.insert(0, str(Path(__file__).parent))
import base64

import corpus_pipeline
import public_tokenizers
import test_decontam
import test_neardup
import tiktoken
from corpusmill.llm import linedup, quality
from corpusmill.llm.queries import table

SF = "/root/testdata/sf0.001"


def plain_lines(rows):
    """Lines on MIN_SITES sites stay in the smallest doc_id only; rows left empty go."""
    sites, first = {}, {}
    for r in rows:
        for x in {x.strip(" ") for x in r["text"].split("\n")}:
            if len(x) >= linedup.MIN_CHARS:
                sites.setdefault(x, set()).add(r["source"])
                first[x] = min(r["doc_id"], first.get(x, r["doc_id"]))
    out = []
    for r in rows:
        lines = r["text"].split("\n")
        kept = [x for x in lines if not (len(x.strip(" ")) >= linedup.MIN_CHARS and len(sites[x.strip(" ")]) >= linedup.MIN_SITES and first[x.strip(" ")] != r["doc_id"])]
        if len(kept) == len(lines) or "".join(kept).strip():
            out.append({**r, "text": "\n".join(kept)})
    return out


def plain_cut(text, grams):
    """Benchmark words cut, from the first to the last of each run of hit words; None where most words are hit."""
    found = [(m.start(), m.end()) for m in test_decontam.WORD.finditer("".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text))]
    words = test_decontam.words(text)
    hit = set()
    for n in {len(g) for g in grams}:
        for i in range(len(words) - n + 1):
            if tuple(words[i : i + n]) in grams:
                hit.update(range(i, i + n))
    if len(hit) > 0.5 * len(words):
        return None
    out, done = "", 0
    for i in sorted(hit):
        if i - 1 not in hit:
            end = i
            while end + 1 in hit:
                end += 1
            out += text[done : found[i][0]]
            done = found[end][1]
    return out + text[done:]


def test_run_against_a_plain_version(spark):
    docs, labels = table(spark, SF, "documents"), table(spark, SF, "labels")
    scored = {r.doc_id: r.keep for r in quality.score_documents(docs, labels).collect()}
    rows = [r.asDict() for r in docs.collect() if scored[r.doc_id]]
    rows = plain_lines(rows)
    kept = {d for d, _, _, k in test_neardup.brute([(r["doc_id"], r["text"]) for r in rows], corpus_pipeline.NEAR_PERCENT) if k}
    rows = [r for r in rows if r["doc_id"] in kept]
    grams = set()
    for item in table(spark, SF, "benchmark").collect():
        own = test_decontam.words(item.text)
        n = min(10, len(own))
        grams |= {tuple(own[i : i + n]) for i in range(len(own) - n + 1 if n else 0)}
    texts = {r["doc_id"]: t for r in rows if (t := plain_cut(r["text"], grams)) is not None}
    with open(public_tokenizers.path("byte_bpe_multi_50k.tiktoken"), "rb") as lines:
        ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, lines)}
    encoding = tiktoken.Encoding("own", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={})
    want = {}
    for doc, text in texts.items():
        ids = encoding.encode_ordinary(text)
        want[doc] = (len(ids), hashlib.sha256(",".join(map(str, ids)).encode()).hexdigest(), hashlib.sha256(text.encode()).hexdigest())
    got = {r.doc_id: (r.n_tokens, r.ids_sha256, r.decoded_sha256) for r in corpus_pipeline.run(spark, SF).collect()}
    assert got == want and 50 < len(got) < docs.count()


def test_stages_on_odd_rows_keep_the_columns(spark):
    rows = [(1, "One two three four five six seven.", "en", "a", 34, 1), (1, "One two three four five six seven.", "en", "a", 34, 1), (2, "one two three four five six seven.", "en", "b", 34, 2), (3, None, None, None, None, None), (4, "", "en", "a", 0, 3), (None, "x y z", "en", "a", 5, 4), (5, "long " * 30_000, "en", "a", 150_000, 5)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long, keep long")
    for empty in (False, True):
        out = docs.limit(0) if empty else docs
        for name, stage in corpus_pipeline.STAGES[:-1]:
            out = stage(spark, out, SF)
            assert out.columns == docs.columns, name
        last = corpus_pipeline.encode_stage(spark, out, SF).collect()
        ids = [r.doc_id for r in last]
        assert ids == [] if empty else {1, 3, 4, None} <= set(ids) and 2 not in ids and ids.count(1) == 1


def test_rows_of_one_id_and_different_texts_are_judged_apart(spark):
    copy, own, other = "one two three four five six seven", "eight nine ten eleven twelve thirteen", "red green blue white black grey"
    rows = [(1, copy), (5, copy), (5, own), (7, other), (7, own + " fourteen fifteen " + other[::-1]), (7, other)]
    out = corpus_pipeline.near_stage(spark, spark.createDataFrame(rows, "doc_id long, text string"), SF)
    assert sorted(map(tuple, out.collect())) == sorted([rows[0], *rows[2:5]])
