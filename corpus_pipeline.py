"""A corpus-cleaning pipeline of five stages, each one of the training-data operators.

Each stage takes (spark, docs, sf_dir) and works on all rows its predecessor kept; run() applies them in
order and hands each stage's result on as a Parquet table in the shared checkpoint folder, so a lost executor
costs one stage at most; a table is deleted when the next one is written, and a run that names its folder can be taken up
again behind its last finished stage.  All but the last stage return the columns of documents, also extra
ones with any name; on an empty table each stage returns no rows.
"""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from notewarden import prepared
from notewarden.llm import decontaminate, language_id, near_dups, packing, substring_dedup
from notewarden.llm.common import exists, remove, shared_dir, table

HELPER = "__nw"


@prepared
def language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without a letter, or in none of the corpus' languages, go; a missing lang is filled in.

    Null and empty texts go; where no document has a language, all go, as none can be told.  Texts of any length are read whole; repeated rows are judged alike."""
    model = language_id.learn(docs)
    found = language_id.with_language(docs, model, to=HELPER, reject=True).where(F.col(f"{HELPER}.lang") != "und")
    return found.withColumn("lang", F.coalesce("lang", F.col(f"{HELPER}.lang"))).select(*docs.columns)


@prepared
def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near copies (five-word shingles, Jaccard similarity of 0.8 or more) stays, that of the smallest id.

    BK-trees over SimHashes find the pairs, exact sets confirm them.
    Of repeated rows one stays; texts without a word are one group; a very long text counts with all its shingles."""
    return near_dups.drop_near_copies(docs)


@prepared
def substrings(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Passages of 13 words or more that a document of a smaller id has too are cut out; documents with no word left go.

    Rows with a null id lose nothing; rows of one id lose nothing to each other; texts of any length are compared whole."""
    had = F.regexp_like("text", F.lit(r"[^\x20\x09-\x0D]"))
    out = substring_dedup.dedup_substrings(docs).where(had)
    return out.withColumn("n_chars", F.length("text").cast("bigint")).select(*docs.columns)


@prepared
def decontamination(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents contaminated by the benchmark (hit words make a twentieth or more of all) go; with an empty benchmark none.

    Texts of any length are scanned whole; repeated rows are judged alike."""
    found = decontaminate.decontaminate(docs, table(spark, sf_dir, "benchmark"), prefix=HELPER)
    return found.where(~F.col(f"{HELPER}contaminated")).select(*docs.columns)


@prepared
def pack(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Every remaining document row gets its bucket, batch and slot; a text without a word has length 0.

    A text longer than the budget is a batch of its own; rows of one length, or of one id, are placed one after another in any order."""
    lengths = docs.select("doc_id", packing.length_words(F.col("text")).alias(HELPER))
    return packing.pack(lengths, F.col(HELPER)).drop(HELPER)


STAGES = [
    ("language_id", language),
    ("simhash_near_dedup", near_duplicates),
    ("substring_dedup", substrings),
    ("benchmark_decontamination", decontamination),
    ("packing", pack),
]

#: Language identification cannot be expressed in SQL; tests hold the stages against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str, folder: str | None = None) -> DataFrame:
    """The result of all stages.

    Each stage is written to the folder, and the table before it is deleted then; at the end the last one is left.  A later run with the same folder goes on behind
    the last finished stage, so a folder belongs to one input.  Without a folder the run takes a new one, of which nothing stays if it fails."""
    base = folder or f"{shared_dir(spark)}/pipeline-{uuid.uuid4().hex}"
    tables = [f"{base}/{name}" for name, _ in STAGES]
    done = max((k + 1 for k, path in enumerate(tables) if exists(spark, f"{path}/_SUCCESS")), default=0)
    docs = spark.read.parquet(tables[done - 1]) if done else table(spark, sf_dir, "documents")
    try:
        for k in range(done, len(STAGES)):
            STAGES[k][1](spark, docs, sf_dir).write.mode("overwrite").parquet(tables[k])
            docs = spark.read.parquet(tables[k])
            if k:
                remove(spark, tables[k - 1])
    except BaseException:
        if not folder:
            remove(spark, base)
        raise
    return docs
