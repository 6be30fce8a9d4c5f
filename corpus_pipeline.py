"""From raw documents to token files: quality, near-duplicates, decontamination, mixing, token output."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from saltmarsh.llm import decontaminate, mixing, near_dups, quality, tokens
from saltmarsh.session import scratch_path

COLUMNS = ["doc_id", "text", "lang", "source", "n_chars"]
LEAST_SCORE = 0.3


def keep_good(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the compression classifier (operator 9) gives a score of 0.3 or more; it learns from the labelled ones."""
    model = quality.fit_quality(docs, spark.read.parquet(f"{sf_dir}/labels.parquet"))
    scored = quality.score(docs, model, "text", COLUMNS)
    return scored.where(F.col("score") >= LEAST_SCORE).select(*COLUMNS)


def drop_near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near-duplicates (operator 5): the one of the smallest id.

    Five-word shingles, similarity 0.8. Documents without words are in no group and stay, as do rows without an id. Rows
    that share an id are one document: one row of it stays.
    """
    found = near_dups.near_duplicates(docs, width=5, percent=80)
    gone = found.where("NOT kept AND doc_id IS NOT NULL").select("doc_id").distinct()
    kept = docs.join(gone, "doc_id", "left_anti").select(*COLUMNS)
    again = docs.where("doc_id IS NOT NULL").groupBy("doc_id").count().where("count > 1").select("doc_id")
    one = kept.join(again, "doc_id", "left_semi").dropDuplicates(["doc_id"])
    return kept.join(again, "doc_id", "left_anti").union(one.select(*COLUMNS))


def drop_contaminated(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents in which no benchmark item is found (operator 6)."""
    return decontaminate.clean_documents(docs, spark.read.parquet(f"{sf_dir}/benchmark.parquet")).select(*COLUMNS)


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The mix (operator 4) as rows: repeated documents in several rows, the last one cut where the source's words are reached."""
    mixed = mixing.mixed_documents(docs)
    return mixed.withColumn("n_chars", F.length("text").cast("long")).select(*COLUMNS)


def token_output(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token files of the mix (operator 3), read back: a row per document row with its place and checksum."""
    import public_tokenizers

    return tokens.token_files(docs, public_tokenizers.path("byte_bpe_50k.json"))


STAGES = [
    ("quality classifier", keep_good),
    ("MinHash near-dedup", drop_near_duplicates),
    ("benchmark decontamination", drop_contaminated),
    ("mixing sources to target weights", mix_sources),
    ("token-ID / binary output", token_output),
]
ORACLE_SQL = None  # compressed sizes and BPE ids are beyond SQL; tests hold the stages against brute force


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``; each but the last is written to the shared folder and read again."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for k, (_, stage) in enumerate(STAGES):
        docs = stage(spark, docs, sf_dir)
        if k < len(STAGES) - 1:
            path = scratch_path(spark, f"stage{k}")
            docs.write.parquet(path)
            docs = spark.read.schema(docs.schema).parquet(path)
    return docs
