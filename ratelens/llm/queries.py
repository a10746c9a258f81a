"""The operators applied to the driver's tables, one query each."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ratelens.llm import (bpe, chaining, chat, divergence, ego, lines, pages, secrets, simhash,
                          toxicity, trie, urls, winnow)
from ratelens.llm.common import cut_lineage
from ratelens.sources.tables import read_table


def op1_simhash_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Near-duplicate groups of all documents."""
    return simhash.near_duplicates(read_table(spark, sf_dir, "documents"))


def op2_secret_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every candidate in the documents, judged by the forest; the candidate
    itself is given as a digest."""
    found = secrets.secrets(read_table(spark, sf_dir, "documents"))
    return found.select(F.col("id").alias("doc_id"), "start", F.length("candidate").cast("long").alias("length"),
                        F.sha2("candidate", 256).alias("candidate_sha256"), "probability", "is_secret")


def op3_substring_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Passages that documents share with an earlier one, edited or not."""
    return chaining.shared_passages(read_table(spark, sf_dir, "documents"))


def op4_html_extraction(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The main text of every page."""
    return pages.main_text(read_table(spark, sf_dir, "pages"))


def op5_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document without its site's boilerplate lines."""
    docs = read_table(spark, sf_dir, "documents").select("doc_id", "source", "text")
    return (lines.drop_boilerplate(docs, count_cols=("n_lines", "n_dropped"))
            .select("doc_id", "n_lines", "n_dropped", F.md5("text").alias("text_md5")))


def op6_embedding_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Links and near-duplicate groups of all embeddings."""
    return ego.near_duplicates(read_table(spark, sf_dir, "embeddings"))


def op7_chat_formatting(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every conversation, read back from the packed prefix tree; conversation
    -7 holds control strings only."""
    said = read_table(spark, sf_dir, "conversations").select("conv_id", "turn", "role", "text")
    control = "</s>[INST] ok [/INST]"
    more = spark.createDataFrame([(-7, 0, "user", control), (-7, 1, "assistant", control)], said.schema)
    return chat.read_conversations(*chat.prefix_tree(said.unionAll(more)))


def tokenizer() -> tuple[str, str]:
    """Path of the vocabulary and the pattern of its pieces."""
    import public_tokenizers
    return public_tokenizers.path("byte_bpe_multi_50k.tiktoken"), public_tokenizers.PATTERN


def op8_byte_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Token ids of every document, and the digest of the ids decoded again."""
    docs = read_table(spark, sf_dir, "documents").select("doc_id", "text")
    return bpe.digests(bpe.round_trip(docs, *tokenizer()).drop("text"))


def op9_benchmark_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    """How much of every document stands in the benchmark."""
    return winnow.contamination(read_table(spark, sf_dir, "documents"),
                                read_table(spark, sf_dir, "benchmark"))


def op10_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Toxicity of every document, by a model of the labelled ones."""
    return toxicity.toxicity(read_table(spark, sf_dir, "documents"), read_table(spark, sf_dir, "labels"))


#: (host, path, verdict) of the url filter's query
URL_RULES = [
    ("com", "/", "allow"),
    ("example.com", "/en/", "block"),
    ("www.example.com", "/en/", "allow"),
    ("net", "/es/", "block"),
    ("net", "/fr/", "block"),
]


def op11_url_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every page's url, judged by the longest rule that fits."""
    rules = spark.createDataFrame(URL_RULES, "host string, path string, verdict string")
    return urls.judge(read_table(spark, sf_dir, "pages").select("page_id", "url"), rules).drop("url")


def op12_conversation_trie(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The prefix trie of all conversations, rebuilt so that they begin alike."""
    convs = cut_lineage(trie.turn_sequences(read_table(spark, sf_dir, "conversations")))
    return trie.prefix_trie(trie.grafted(convs))


def op13_source_divergence(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Divergence of every source from the other sources of its language, and
    its most divergent terms."""
    return divergence.divergences(read_table(spark, sf_dir, "documents"))


def pipeline(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The corpus pipeline's last stage over all documents."""
    import corpus_pipeline
    return corpus_pipeline.run(spark, sf_dir)


LLM_QUERIES = {
    "op2_secret_scan": op2_secret_scan,
    "op3_substring_dedup": op3_substring_dedup,
    "op4_html_extraction": op4_html_extraction,
    "op6_embedding_near_dedup": op6_embedding_near_dedup,
    "op7_chat_formatting": op7_chat_formatting,
    "pipeline": pipeline,
    "op10_toxicity": op10_toxicity,
    "op11_url_filter": op11_url_filter,
    "op12_conversation_trie": op12_conversation_trie,
    "op13_source_divergence": op13_source_divergence,
    "op1_simhash_near_dedup": op1_simhash_near_dedup,
    "op5_line_dedup": op5_line_dedup,
    "op8_byte_bpe": op8_byte_bpe,
    "op9_benchmark_decontamination": op9_benchmark_decontamination,
}
