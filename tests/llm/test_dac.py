import itertools
import zlib

import numpy as np
import public_tokenizers
import pytest
from corpusmill.llm import dac
from corpusmill.llm.queries import table
from hypothesis import given, settings
from hypothesis import strategies as st
from tokenizers import Tokenizer

PATH = public_tokenizers.path("word_bpe_49k.json")


@settings(max_examples=80, deadline=None)
@given(st.lists(st.integers(0, 2**32 - 1) | st.integers(0, 300)), st.integers(1, 40))
def test_round_trip_and_random_access(ids, times):
    data = np.array(ids * times, np.uint32)
    segment = dac.Segment(dac.encode(data))
    assert np.array_equal(segment.all(), data) and len(segment) == len(data)
    for i in {0, len(data) // 2, len(data) - 1} if len(data) else ():
        assert segment[i] == data[i]


@pytest.mark.parametrize("widths", [(16,), (8, 8), (3, 5, 8), (1, 15), (12, 4), (9, 3, 20)])
def test_every_position_by_rank(widths):
    data = (np.random.default_rng(3).pareto(0.6, 3_000) * 7).clip(0, 65_535).astype(np.uint32)
    segment = dac.Segment(dac.encode(data, widths))
    assert [segment[i] for i in range(len(data))] == data.tolist()
    with pytest.raises(IndexError):
        segment[len(data)]


def expected(rows):
    own = Tokenizer.from_file(PATH)
    ids = [(d, [*own.encode(t or "", add_special_tokens=False).ids, 1]) for d, t in rows]
    starts = itertools.accumulate([len(i) for _, i in ids], initial=0)
    return [(d, s, len(i), zlib.crc32(np.array(i, "<u4").tobytes())) for (d, i), s in zip(ids, starts)]


def test_given_documents_in_order(spark, monkeypatch):
    monkeypatch.setattr(dac, "SEGMENT", 5_000)
    docs = table(spark, "/root/testdata/sf0.001", "documents")
    rows = sorted((r.doc_id, r.text) for r in docs.collect())
    assert sorted(map(tuple, dac.stored_digests(docs.repartition(5), PATH).collect())) == expected(rows)


def test_edge_cases(spark, tmp_path):
    texts = [(1, None), (2, ""), (3, "  It's\t ＡB１2\x1cx <|endoftext|> y\r\n\n é é ́z İΣ"), (4, "w" * 70_000), (5, "a b"), (5, "a b")]
    docs = spark.createDataFrame([(d, t, 7) for d, t in texts], "doc_id long, text string, shard int")
    target = str(tmp_path / "ids")
    dac.write_ids(docs, target, PATH)
    assert sorted(map(tuple, dac.read_documents(spark, target).collect())) == expected(texts)
    flat = [i for _, t in texts for i in [*Tokenizer.from_file(PATH).encode(t or "", add_special_tokens=False).ids, 1]]
    assert [dac.token_at(spark, target, p) for p in (0, 1, 2, len(flat) - 1)] == [flat[p] for p in (0, 1, 2, len(flat) - 1)]
    with pytest.raises(IndexError):
        dac.token_at(spark, target, len(flat))
    assert dac.stored_digests(docs.limit(0), PATH).count() == 0
    nulls = spark.createDataFrame([(None, "b"), (1, "a"), (None, None)], "doc_id long, text string")
    assert sorted(r.start for r in dac.stored_digests(nulls, PATH).filter("doc_id is null").collect())[0] == 0


def test_encoder_forgets_and_equals_the_library(monkeypatch):
    """Words of any kind, in slices, with a table that is too small for them."""
    import random

    from tokenizers import Tokenizer

    path = public_tokenizers.path("word_bpe_49k.json")
    library = Tokenizer.from_file(path)
    rnd = random.Random(3)
    letters = [*"aA bB.,'sSt\t\n 19é中<|>!-\x0b\x0c\r\x85 ", "É", "J̌", "İ", "ß", "Σς", "​", "<|endoftext|>", "<|ENDOFTEXT|>", "'re", ". ", ", "]
    texts = ["".join(rnd.choice(letters) for _ in range(rnd.randrange(60))) for _ in range(1500)] + ["", ".", "a.", "1,", "x" * 5000 + "."]
    monkeypatch.setattr(dac, "MEMORY", 300)
    encoder = dac.WordEncoder(path)
    for start in range(0, len(texts), 50):
        for text, ids in zip(texts[start : start + 50], encoder.ids(texts[start : start + 50])):
            assert ids.tolist() == library.encode(text, add_special_tokens=False).ids, repr(text)
