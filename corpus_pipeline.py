"""The corpus pipeline: five stages over ``documents``, each one operator.

``run`` applies them in order; every stage's rows are written as Parquet in
the session's shared checkpoint folder and read again as the next one's docs.

1. quality classifier: rows that score below the threshold go.
2. line dedup: repeated boilerplate lines are taken out of the texts.
3. SimHash near-dedup: of each class one row, of the smallest id, stays.
4. benchmark decontamination: documents that share a window with an item go.
5. packing: the remaining documents as pieces of training sequences.

Rows: every stage handles what its operator does (nulls, empty texts, repeated
rows, empty tables, other columns). Stages 3 and 4 number the rows and judge and
drop each by its own text, whatever others share its id; in a class with any
id, a row without one is not the one that stays.
"""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from basketry.llm.common import Scratch, crc_mod
from basketry.llm.decontamination import contamination
from basketry.llm.line_dedup import line_dedup
from basketry.llm.packing import pack
from basketry.llm.quality import quality_filter, train
from basketry.llm.simhash import near_dedup
from basketry.session import drop_since

#: SQL cannot state the classifier, SimHash linking or packing; tests hold the
#: stages against brute force instead.
ORACLE_SQL = None


def _numbered(docs: DataFrame, scratch: Scratch) -> tuple[DataFrame, str]:
    """``docs`` with a number of its own per row, written, and that column's name."""
    name = "row"
    while name.lower() in {c.lower() for c in docs.columns}:
        name += "_"
    return scratch.keep(docs.withColumn(name, F.monotonically_increasing_id()), "numbered"), name


def _without(rows: DataFrame, name: str, dropped: DataFrame, scratch: Scratch) -> DataFrame:
    """``rows`` but those whose number is in ``dropped (gone)``, without the number.

    The numbers are written first, so Spark knows their size when it plans the join.
    """
    gone = scratch.keep(dropped, "dropped")
    return rows.join(gone, rows[name] == gone["gone"], "left_anti").drop(name)


def quality_classifier(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Learns from the labels of the training rows, drops what scores low."""
    labels = spark.read.parquet(f"{sf_dir}/labels.parquet").where(crc_mod("doc_id", 5) != 0)
    return quality_filter(docs, train(docs, labels))


def lines(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Takes boilerplate lines out; ``n_chars``, if there, follows the text."""
    cleaned = line_dedup(docs)
    if "n_chars" in cleaned.columns:
        kind = docs.schema["n_chars"].dataType
        cleaned = cleaned.withColumn("n_chars", F.length("text").cast(kind))
    return cleaned.select(*docs.columns)


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Keeps one row of each class: the first of the smallest id."""
    scratch = Scratch(spark)
    rows, name = _numbered(docs, scratch)
    ranked = rows.select(F.struct(F.col("doc_id").isNull().alias("none"), F.col("doc_id").alias("id"),
                                  F.col(name).alias("row")).alias("rank"), "text")
    classes = near_dedup(ranked, scratch=scratch, id_col="rank")
    gone = classes.where(F.col("doc_id.row") != F.col("component_id.row"))
    return _without(rows, name, gone.select(F.col("doc_id.row").alias("gone")), scratch)


def decontamination(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Drops the rows that share a window of words with a benchmark item."""
    scratch = Scratch(spark)
    rows, name = _numbered(docs, scratch)
    found = contamination(rows, spark.read.parquet(f"{sf_dir}/benchmark.parquet"), scratch=scratch,
                          id_col=name)
    return _without(rows, name, found.where("contaminated").select(F.col("doc_id").alias("gone")), scratch)


def packing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Packs what is left into sequences."""
    return pack(docs, public_tokenizers.path("byte_bpe_50k.json"))


STAGES = [
    ("quality classifier", quality_classifier),
    ("line dedup", lines),
    ("SimHash near-dedup", near_duplicates),
    ("benchmark decontamination", decontamination),
    ("packing", packing),
]


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over the whole ``documents`` table; the packed pieces.

    A stage's intermediate tables go when its result is written, and that
    result when the next one is; the last stays for the pieces to be read.
    """
    docs, last = spark.read.parquet(f"{sf_dir}/documents.parquet"), None
    for name, stage in STAGES[:-1]:
        result = Scratch(spark)
        made = len(Scratch.made)
        docs = result.keep(stage(spark, docs, sf_dir), name.replace(" ", "-"))
        drop_since(spark, made)
        if last is not None:
            last.drop()
        last = result
    return STAGES[-1][1](spark, docs, sf_dir)
