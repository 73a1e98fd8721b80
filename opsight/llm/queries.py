"""The operators of this folder over the given tables, as registered queries."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from opsight.llm.filter_audit import AUDIT_SQL
from opsight.llm.ranked_search import RANK_SQL

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
CHECKS: dict[str, str] = {}


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def query(fn: Callable[[SparkSession, str], DataFrame]) -> Callable[[SparkSession, str], DataFrame]:
    QUERIES[fn.__name__] = fn
    return fn


@query
def op1_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    from opsight.llm.toxicity import toxicity

    return toxicity(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


@query
def op2_benchmark_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    from opsight.llm.decontamination import contaminated

    return contaminated(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


@query
def op3_repeated_passages(spark: SparkSession, sf_dir: str) -> DataFrame:
    from opsight.llm.passages import repeated_passages

    return repeated_passages(table(spark, sf_dir, "documents"))


@query
def op4_best_fit_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    import public_tokenizers

    from opsight.llm.packing import pack

    return pack(table(spark, sf_dir, "documents"), public_tokenizers.path("byte_bpe_50k.json"),
                public_tokenizers.path("byte_bpe_50k.tiktoken"))


@query
def op5_suffix_tree_scores(spark: SparkSession, sf_dir: str) -> DataFrame:
    from opsight.llm.lm import score_texts

    return score_texts(table(spark, sf_dir, "documents"))


@query
def op6_simhash_near_duplicates(spark: SparkSession, sf_dir: str) -> DataFrame:
    from opsight.llm.simhash import near_duplicates

    return near_duplicates(table(spark, sf_dir, "documents"))


@query
def op7_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    from opsight.llm.quality import clean_lines

    return clean_lines(table(spark, sf_dir, "documents"))


@query
def op8_personal_data(spark: SparkSession, sf_dir: str) -> DataFrame:
    from opsight.llm.pii import personal_data

    return personal_data(table(spark, sf_dir, "documents"))


@query
def op9_byte_shards(spark: SparkSession, sf_dir: str) -> DataFrame:
    from opsight.llm.sharding import shard

    return shard(table(spark, sf_dir, "documents"))


@query
def op10_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    import public_tokenizers

    from opsight.llm.tokens import token_counts

    return token_counts(table(spark, sf_dir, "documents"), public_tokenizers.path("piece_bpe_32k.model"))


@query
def op12_filter_interactions(spark: SparkSession, sf_dir: str) -> DataFrame:
    from opsight.llm.filter_audit import audit_filters

    return audit_filters(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


@query
def op11_ranked_search(spark: SparkSession, sf_dir: str) -> DataFrame:
    from opsight.llm.ranked_search import rank_documents

    return rank_documents(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


@query
def op13_syncmer_fingerprints(spark: SparkSession, sf_dir: str) -> DataFrame:
    from opsight.llm.syncmers import edited_fingerprints

    return edited_fingerprints(table(spark, sf_dir, "documents"))


CHECKS |= {"op11_ranked_search": RANK_SQL, "op12_filter_interactions": AUDIT_SQL}
