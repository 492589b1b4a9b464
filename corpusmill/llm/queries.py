"""The registered queries of this subpackage: name -> (spark, sf_dir) -> DataFrame, and their SQL."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from . import decontam, exponion, lexical, linedup, lmscore, neardup, warc


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def op8_bpe_codec(spark: SparkSession, sf_dir: str) -> DataFrame:
    import public_tokenizers

    from .bpe import encode_digests

    return encode_digests(
        table(spark, sf_dir, "documents"), public_tokenizers.path("byte_bpe_multi_50k.tiktoken"),
        public_tokenizers.PATTERN,
    ).drop("n_bytes")


def op10_decontaminate(spark: SparkSession, sf_dir: str) -> DataFrame:
    from .decontam import hits

    return hits(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


def op2_transport_stream(spark: SparkSession, sf_dir: str) -> DataFrame:
    from .media import stored_digests

    return stored_digests(table(spark, sf_dir, "documents"))


def op6_url_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    from .urlfilter import judge

    return judge(table(spark, sf_dir, "pages"))


def op9_addressable_ids(spark: SparkSession, sf_dir: str) -> DataFrame:
    import public_tokenizers

    from .dac import stored_digests

    return stored_digests(table(spark, sf_dir, "documents"), public_tokenizers.path("word_bpe_49k.json"))


def op5_line_spread(spark: SparkSession, sf_dir: str) -> DataFrame:
    from .linedup import digests

    return digests(table(spark, sf_dir, "documents"))


def op4_chosen_path(spark: SparkSession, sf_dir: str) -> DataFrame:
    from .neardup import near_duplicates

    return near_duplicates(table(spark, sf_dir, "documents"), 85)


def op1_contextual_pii(spark: SparkSession, sf_dir: str) -> DataFrame:
    from .pii import find

    return find(table(spark, sf_dir, "documents"))


def op3_cotrained_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    from .quality import score_documents

    return score_documents(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


def op7_stupid_backoff(spark: SparkSession, sf_dir: str) -> DataFrame:
    from .lmscore import rounded

    return rounded(table(spark, sf_dir, "documents"))


def op11_warc_dictionary(spark: SparkSession, sf_dir: str) -> DataFrame:
    from .warc import stored_digests

    return stored_digests(table(spark, sf_dir, "pages"))


def op12_exponion_clusters(spark: SparkSession, sf_dir: str) -> DataFrame:
    from .exponion import clusters

    return clusters(table(spark, sf_dir, "embeddings"))


def op13_lexical_search(spark: SparkSession, sf_dir: str) -> DataFrame:
    from .lexical import rank

    return rank(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "op1_contextual_pii": op1_contextual_pii,
    "op2_transport_stream": op2_transport_stream,
    "op3_cotrained_quality": op3_cotrained_quality,
    "op4_chosen_path": op4_chosen_path,
    "op5_line_spread": op5_line_spread,
    "op6_url_filter": op6_url_filter,
    "op7_stupid_backoff": op7_stupid_backoff,
    "op8_bpe_codec": op8_bpe_codec,
    "op9_addressable_ids": op9_addressable_ids,
    "op10_decontaminate": op10_decontaminate,
    "op11_warc_dictionary": op11_warc_dictionary,
    "op12_exponion_clusters": op12_exponion_clusters,
    "op13_lexical_search": op13_lexical_search,
}

ORACLE_SQL: dict[str, str] = {
    "op4_chosen_path": neardup.ORACLE_SQL,
    "op5_line_spread": linedup.ORACLE_SQL,
    "op7_stupid_backoff": lmscore.ORACLE_SQL,
    "op10_decontaminate": decontam.ORACLE_SQL,
    "op11_warc_dictionary": warc.ORACLE_SQL,
    "op12_exponion_clusters": exponion.ORACLE_SQL,
    "op13_lexical_search": lexical.ORACLE_SQL,
}
