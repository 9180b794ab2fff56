"""The queries of the text operators, with production parameters over whole tables, and their SQL."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from weavegraph.llm import curve_packing, decontaminate, forest, langid, licenses, line_dedup, minhash, mixing, negatives, ppm, prefix_trie, quality, token_files

#: The tokenizer of the contract; any file of the tokenizers library will do.
TOKENIZER = "word_bpe_49k.json"


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def tokenizer_path(name: str = TOKENIZER) -> str:
    import public_tokenizers

    return str(public_tokenizers.path(name))


def op1_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Which lines of each document repeat runs of 50 words or more that occur before; nulls, long texts and repeated rows as in find_repeated_runs()."""
    return line_dedup.line_report(table(spark, sf_dir, "documents"))


def op2_token_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every whole text as token files, read back: start, number and crc32 of each document's ids; edge cases as in write_tokens()."""
    return token_files.token_digest(table(spark, sf_dir, "documents"), tokenizer=tokenizer_path())


def op3_benchmark_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Words of each document that benchmark windows of 13 words hit, and the contamination rule; edge cases as in find_contamination()."""
    return decontaminate.decontamination_report(table(spark, sf_dir, "documents").select("doc_id", "text"), table(spark, sf_dir, "benchmark"))


def op4_language_identification(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The language of every whole text, learned from the training folds; edge cases as in identify()."""
    return langid.language_report(table(spark, sf_dir, "documents"))


def op5_prefix_forest(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The 20 nearest of every vector whose id is divisible by 20, among all others; edge cases as in nearest()."""
    return forest.nearest(table(spark, sf_dir, "embeddings"), is_query=F.col("vec_id") % 20 == 0)


def op6_ppm_scores(spark: SparkSession, sf_dir: str) -> DataFrame:
    """log10 probabilities of every whole text under the byte trie and the word baseline; edge cases as in score_documents()."""
    return ppm.score_report(table(spark, sf_dir, "documents"))


def op7_license_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Licence families and unknown licences in every whole text; edge cases as in scan()."""
    return licenses.license_report(table(spark, sf_dir, "documents"))


def op8_source_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """What the mix takes of every document, with its source's target; edge cases as in mix_sources()."""
    return mixing.mix_sources(table(spark, sf_dir, "documents"))


def op9_minhash_near_duplicates(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Groups of near-duplicates by four-word shingles at a similarity of 0.8; edge cases as in near_duplicates()."""
    return minhash.near_duplicates(table(spark, sf_dir, "documents"), width=4)


def op10_quality_grades(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Expected grade and tail probability of every whole text, learned from the ratings; edge cases as in judge_quality()."""
    return quality.quality_report(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


def op11_curve_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every whole text in sequences of 2048 ids along a Hilbert curve, read back piece by piece; edge cases as in pack_documents()."""
    return curve_packing.packing_report(table(spark, sf_dir, "documents"), tokenizer=tokenizer_path())


def op12_hard_negatives(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The first five hard negatives of each of an anchor's five positives, scored by whole numbers; edge cases as in hard_negatives()."""
    label = F.when(F.col("vec_id") % 7 == 0, (F.col("label") + 1) % 10).otherwise(F.col("label"))
    found = negatives.hard_negatives(table(spark, sf_dir, "embeddings"), is_anchor=F.col("vec_id") % 100 == 0, label=label)
    return found.drop("positive_rank")  # the columns of the SQL


def op13_conversation_trie(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every prefix of the rebuilt conversations, from a z-fast trie; edge cases as in trie_report()."""
    return prefix_trie.trie_report(table(spark, sf_dir, "conversations"))


QUERIES = {
    f.__name__: f
    for f in (
        op1_line_dedup,
        op2_token_files,
        op3_benchmark_decontamination,
        op4_language_identification,
        op5_prefix_forest,
        op6_ppm_scores,
        op7_license_scan,
        op8_source_mixing,
        op9_minhash_near_duplicates,
        op10_quality_grades,
        op11_curve_packing,
        op12_hard_negatives,
        op13_conversation_trie,
    )
}

ORACLE_SQL = {
    "op3_benchmark_decontamination": decontaminate.CONTAMINATION_SQL,
    "op8_source_mixing": mixing.MIX_SQL,
    "op9_minhash_near_duplicates": minhash.NEAR_SQL,
    "op12_hard_negatives": negatives.NEGATIVES_SQL,
    "op13_conversation_trie": prefix_trie.TRIE_SQL,
}
