"""The registered queries of the operators, and the SQL of those that SQL can express."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from novalake.llm import jaccard_join, language, lm_scoring, sql
from novalake.llm.common import read_table
from novalake.llm.decontamination import annotate, hit_words, is_contaminated
from novalake.llm.html_text import main_text
from novalake.llm.packing import pack_documents
from novalake.llm.pii import KINDS, find, train
from novalake.llm.posting_lists import nearest
from novalake.llm.prefix_trie import trie
from novalake.llm.sharding import shard
from novalake.llm.source_divergence import divergence
from novalake.llm.token_store import read_back, write_store
from novalake.llm.top_scores import top_scores
from novalake.session import new_stage_path

SHARDS = 24


def tokenizer_path() -> str:
    import public_tokenizers

    return public_tokenizers.path("word_bpe_49k.json")


def op1_token_store(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = new_stage_path(spark, "token-store")
    write_store(read_table(spark, sf_dir, "documents"), path, tokenizer_path())
    return read_back(spark, path)


def op2_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pack_documents(read_table(spark, sf_dir, "documents"), tokenizer_path())


def _listed(spans: Column) -> Column:
    parts = F.transform(spans, lambda s: F.concat_ws(":", s["kind"], s["start"], s["end"]))
    return F.array_join(parts, ",")


def op3_personal_data(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read_table(spark, sf_dir, "documents").select("doc_id", "text")
    found = find(docs, train(docs))
    base = F.col("base")
    counts = [F.expr(f"cast(size(filter(base, s -> s.kind = '{k}')) as bigint)").alias(f"n_{k}") for k in KINDS]
    return found.select("doc_id", *counts, F.sha2(_listed(base), 256).alias("base_sha256"),
                        _listed(F.col("spans")).alias("spans"))


def op4_html_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    return main_text(read_table(spark, sf_dir, "pages"))


def op5_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read_table(spark, sf_dir, "documents").select("doc_id", "text")
    marked = annotate(docs, read_table(spark, sf_dir, "benchmark"), "found")
    found = F.col("found")
    return marked.select(
        "doc_id", found["n_words"].alias("n_words"), hit_words(found).alias("n_hit"),
        F.size(found["items"]).cast("bigint").alias("n_items"),
        F.sha2(F.array_join(found["items"], ","), 256).alias("items_sha256"),
        is_contaminated(found).alias("contaminated"),
    )


def op6_posting_lists(spark: SparkSession, sf_dir: str) -> DataFrame:
    return nearest(read_table(spark, sf_dir, "embeddings"), F.col("vec_id") % 20 == 0, 20)


def op7_sharding(spark: SparkSession, sf_dir: str) -> DataFrame:
    dealt = shard(read_table(spark, sf_dir, "documents"), SHARDS)
    return dealt.select("doc_id", "size", "text_crc32", F.lit("bytes").alias("law"), "shard", "slot",
                        F.lit(None).cast("int").alias("grown_shard"))


def op8_language(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read_table(spark, sf_dir, "documents")
    return language.predict(docs, language.train(docs))


def op9_jaccard_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    joined = jaccard_join.join(read_table(spark, sf_dir, "documents"))
    return joined.select("doc_id", "n_shingles", "component_id")


def op10_context_tree(spark: SparkSession, sf_dir: str) -> DataFrame:
    return lm_scoring.score(read_table(spark, sf_dir, "documents"))


def op11_top_scores(spark: SparkSession, sf_dir: str) -> DataFrame:
    return top_scores(read_table(spark, sf_dir, "embeddings"), F.col("vec_id") % 20 == 0, 20)


def op12_source_divergence(spark: SparkSession, sf_dir: str) -> DataFrame:
    return divergence(read_table(spark, sf_dir, "documents"))


def op13_prefix_trie(spark: SparkSession, sf_dir: str) -> DataFrame:
    return trie(read_table(spark, sf_dir, "conversations"))


QUERIES = {
    "op1_token_store": op1_token_store,
    "op2_packing": op2_packing,
    "op3_personal_data": op3_personal_data,
    "op4_html_text": op4_html_text,
    "op5_decontamination": op5_decontamination,
    "op6_posting_lists": op6_posting_lists,
    "op7_sharding": op7_sharding,
    "op8_language": op8_language,
    "op9_jaccard_join": op9_jaccard_join,
    "op10_context_tree": op10_context_tree,
    "op11_top_scores": op11_top_scores,
    "op12_source_divergence": op12_source_divergence,
    "op13_prefix_trie": op13_prefix_trie,
}

# The other operators hold trained models, tokenizers, hashes that SQL lacks, or an approximate result.
ORACLE = {
    "op5_decontamination": sql.DECONTAMINATION,
    "op9_jaccard_join": sql.JACCARD_JOIN,
    "op11_top_scores": sql.TOP_SCORES,
    "op12_source_divergence": sql.SOURCE_DIVERGENCE,
    "op13_prefix_trie": sql.PREFIX_TRIE,
}
