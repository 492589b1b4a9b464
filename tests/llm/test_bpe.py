import hashlib

import public_tokenizers
import tiktoken
from corpusmill.llm import bpe
from corpusmill.llm.queries import table
from hypothesis import given, settings
from hypothesis import strategies as st

PATH, PATTERN = public_tokenizers.path("byte_bpe_multi_50k.tiktoken"), public_tokenizers.PATTERN
CODEC = bpe.codec(PATH, PATTERN)
TIKTOKEN = tiktoken.Encoding("own", pat_str=PATTERN, mergeable_ranks=CODEC.ranks, special_tokens={})


def check(text):
    ids = TIKTOKEN.encode_ordinary(text)
    assert next(CODEC.digests([text])) == (",".join(map(str, ids)), len(ids), text.encode()) and CODEC.encode(text) == ids and CODEC.decode(ids) == text.encode()


@settings(max_examples=300, deadline=None)
@given(st.text(max_size=40) | st.text(alphabet=" \n\t\r\x85　a'sé1!漢", max_size=20))
def test_same_ids_as_the_library(text):
    check(text)


def test_long_and_odd_texts():
    for text in ("", " ", "a" * 50_000, " " * 5_000 + "x", "\n" * 3_000, "🙂" * 2_000, "it's  we'll\t\n  I'D ", "x" + " \n " * 400):
        check(text)


def test_model_has_one_piece_a_token():
    assert len(bpe.read_ranks(PATH)) == CODEC.processor.get_piece_size() - 1
    assert CODEC.processor.get_score(1234) == -1234 and bpe.unmapped(CODEC.processor.id_to_piece(1234)) == CODEC.pieces[1234]
    assert bpe.unmapped(bpe.mapped(bytes(range(256)))) == bytes(range(256))


def test_query_on_given_documents(spark):
    docs = table(spark, "/root/testdata/sf0.001", "documents").select("doc_id", "text")
    docs = docs.unionByName(spark.createDataFrame([(-1, None), (-2, ""), (-3, "a b"), (-3, "a b"), (None, "c")], docs.schema)).selectExpr("*", "1 as ids")
    want = sorted(((r.doc_id, len(i := TIKTOKEN.encode_ordinary(r.text or "")), hashlib.sha256(",".join(map(str, i)).encode()).hexdigest(), hashlib.sha256((r.text or "").encode()).hexdigest()) for r in docs.collect()), key=str)
    assert sorted((tuple(r)[:4] for r in bpe.encode_digests(docs, PATH, PATTERN).collect()), key=str) == want
    full = bpe.encode_documents(docs, PATH, PATTERN).collect()
    assert sorted(((r.doc_id, len(r.ids), hashlib.sha256(",".join(map(str, r.ids)).encode()).hexdigest(), hashlib.sha256(bytes(r.decoded)).hexdigest()) for r in full), key=str) == want
    assert bpe.encode_digests(docs.limit(0), PATH, PATTERN).count() == 0
