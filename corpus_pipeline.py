"""A corpus from raw documents to packed sequences: quality, exact and near duplicates, packing.

Every stage takes (spark, docs, sf_dir) and returns a DataFrame that is written as Parquet and
read again as the next stage's docs.  The first three keep whole rows of ``documents`` with
all their columns; the last one packs what they kept.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

#: The rows of run() can't be stated in SQL (a trained model, SimHash, tokenizer, packing).
ORACLE_SQL = None


def quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the quality classifier predicts to be good; a null text is scored as empty."""
    from starkiln.llm.common import table
    from starkiln.llm.quality_classifier import keep, train

    return keep(docs, train(docs, table(spark, sf_dir, "labels")))


def _only(docs: DataFrame, kept: DataFrame) -> DataFrame:
    """Rows of docs whose doc_id is among the kept ones (null ids compare equal).  The two
    sides are shuffled by doc_id, which is nearly unique, so there is no hot key."""
    ids = kept.select(F.col("doc_id").alias("_kept"))
    return docs.join(ids, docs["doc_id"].eqNullSafe(ids["_kept"]), "left_semi")


def exact(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each set of equal texts: the smallest doc_id.  Rows that repeat both
    doc_id and text are reduced to one."""
    from starkiln.llm.exact_dedup import exact_dedup

    once = Window.partitionBy("doc_id", "text").orderBy("doc_id")
    rows = _only(docs, exact_dedup(docs).filter("kept"))
    return rows.withColumn("_copy", F.row_number().over(once)).filter("_copy = 1").drop("_copy")


def near(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each connected group of SimHash near-duplicates: the smallest doc_id."""
    from starkiln.llm.simhash_dedup import simhash_dedup

    return _only(docs, simhash_dedup(docs, words=3, bits=3).filter("kept OR doc_id IS NULL"))


def packing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of sequences of at most 1024 tokens, every id of every document once."""
    import public_tokenizers

    from starkiln.llm.packing import pack

    return pack(docs, public_tokenizers.path("byte_bpe_50k.json"))


STAGES = [("quality", quality), ("exact", exact), ("near", near), ("packing", packing)]


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``; each is written to the shared folder and read again."""
    from starkiln.llm.common import stored, table

    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES:
        docs = stored(stage(spark, docs, sf_dir), f"stage-{name}")
    return docs
