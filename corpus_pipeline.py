"""Training-corpus pipeline: five stages over ``documents``, each one operator of ``velograph.llm``.

Every stage reads all rows that the one before it kept. All but the last return
the columns of the documents, whatever further columns these have; operators see
positional names, so no column of the input can clash with theirs.
"""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession, Window as W, functions as F

from velograph.llm import line_dedup, nb_svm, ngram_join, pieces, wu_manber
from velograph.llm.scratch import Scratch
from velograph.session import materialize


class Shielded:
    """Documents under positional column names, and the way back."""

    def __init__(self, docs: DataFrame):
        self.names = docs.columns
        self.inner = [f"input_{i}" for i in range(len(self.names))]
        self.docs = docs.toDF(*self.inner)
        self.key, self.text = (self.inner[self.names.index(c)] for c in ("doc_id", "text"))

    def back(self, df: DataFrame, *more: str) -> DataFrame:
        return df.select(*self.inner, *more).toDF(*self.names, *more)


def quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the classifier predicts to be of quality 1."""
    x = Shielded(docs)
    model = nb_svm.fit(docs, spark.read.parquet(f"{sf_dir}/labels.parquet"))
    return x.back(nb_svm.score(x.docs, model, text=x.text).where("predicted = 1"))


def lines(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Lines of 20 code points or more found in three documents stay in the last one
    only; ``n_chars`` follows the text. A document may become empty, and stays."""
    x = Shielded(docs)
    out = x.back(line_dedup.dedup_lines(x.docs, key=x.key, text=x.text), "n_dropped")
    if "n_chars" in docs.columns:
        kind = docs.schema["n_chars"].dataType
        out = out.withColumn("n_chars", F.when(F.col("n_dropped") > 0, F.length("text")).otherwise(F.col("n_chars")).cast(kind))
    return out.select(*docs.columns)


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One text of every component of 5-word shingle sets of similarity 0.8 or more: that
    of the smallest id, of several such the one of least hash. An id with unrelated texts
    keeps each of them, a row that repeats id and text stays once. Texts without words
    link with nothing; rows without an id take no part and stay."""
    found = ngram_join.near_duplicates(docs, k=5, percent=80).where("doc_id IS NOT NULL")
    first = found.where("component IS NOT NULL").groupBy("component").agg(F.min(F.struct("doc_id", "text_hash")).alias("kept")).select("kept.*")
    kept = first.union(found.where("component IS NULL").select("doc_id", "text_hash")).toDF("kept_id", "kept_hash").distinct()
    x = Shielded(docs)
    rows = x.docs.withColumns({"kept_id": F.col(x.key).cast("long"), "kept_hash": F.xxhash64(x.text)}).join(kept, ["kept_id", "kept_hash"], "left_semi")
    rows = rows.withColumn("row", F.row_number().over(W.partitionBy("kept_id", "kept_hash").orderBy(x.text))).where("row = 1")
    return x.back(rows).unionByName(docs.where(F.col("doc_id").isNull()))


def decontaminate(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents of which less than a twentieth of the words lies in benchmark windows."""
    x = Shielded(docs)
    found = wu_manber.contaminated(x.docs, spark.read.parquet(f"{sf_dir}/benchmark.parquet"), text=x.text)
    return x.back(found.where(~F.col("contaminated")))


def encode(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents with their ids under merge-dropout and ``lossless``: whether these
    decode to the text (a null text counts as empty). The ids are written in between:
    in one stage, a task would keep a Python worker for each of the two steps."""
    x = Shielded(docs)
    path = public_tokenizers.path("piece_bpe_32k.model")
    out = pieces.decode(materialize(pieces.encode(x.docs, path, key=x.key, text=x.text), "ids"), path)
    out = out.withColumn("lossless", F.col("decoded") == F.coalesce(F.col(x.text), F.lit(""))).withColumn("n_ids", F.size("ids"))
    clash = [c for c in docs.columns if c not in ("ids", "n_ids", "lossless")]
    return x.back(out.withColumnsRenamed({c: f"result_{c}" for c in ("ids", "n_ids", "lossless")}),
                  "result_ids", "result_n_ids", "result_lossless").select(
        *clash, *(F.col(f"result_{c}").alias(c) for c in ("ids", "n_ids", "lossless")))


STAGES = [("quality", quality), ("lines", lines), ("near_duplicates", near_duplicates), ("decontaminate", decontaminate), ("encode", encode)]

#: The classifier and the keyed segmentation are beyond SQL; the tests hold the stages against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``; each result is written and read again."""
    scratch = Scratch(spark, "pipeline")
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for (name, stage), before in zip(STAGES[:-1], [None, *(n for n, _ in STAGES)], strict=False):
        docs = scratch.write(stage(spark, docs, sf_dir), name)
        if before is not None:
            scratch.drop(before)
    return STAGES[-1][1](spark, docs, sf_dir)
