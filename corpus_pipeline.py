"""From documents to packed training sequences: language, quality, near copies, passages, packing.

Each stage takes (spark, docs, sf_dir) and works on all that the stage before
kept. All but the last return the columns of ``documents``. Equal ids, nulls
in any column and empty texts are allowed: a text without a letter is rejected
as of no language; of rows that share id and text one stays; empty tables give
an empty result, and without labels the classifier keeps every document; texts
are read whole, however long; columns besides those of ``documents`` are left
out, whatever their names.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from loamworks.llm import jaccard, langid, packing, quality, substrings
from loamworks.llm.common import drop_staged, row_key, staged, table

COLUMNS = ("doc_id", "text", "lang", "source", "n_chars")
#: A document stays if its best language has at least this share of the likelihood.
LANGUAGE_SCORE = 0.5


def _kept(found: DataFrame) -> DataFrame:
    return found.select(F.col("__id").alias("doc_id"), *COLUMNS[1:])


def language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents of a recognised language."""
    model = langid.fit(langid.training(docs))
    own = docs.select(F.col("doc_id").alias("__id"), *COLUMNS[1:])
    found = langid.predict(own, model, "__id", keep=("__id", *COLUMNS[1:]))
    return _kept(found.filter((F.col("lang_pred") != "und") & (F.col("score") >= LANGUAGE_SCORE)))


def good(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the quality classifier accepts."""
    model = quality.fit(docs, quality.training(table(spark, sf_dir, "labels")))
    own = docs.select(F.col("doc_id").alias("__id"), *COLUMNS[1:])
    found = quality.predict(own, model, "__id", keep=("__id", *COLUMNS[1:]))
    return _kept(found.filter("predicted = 1"))


def one_of_each(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of each group of near copies the document of the least id."""
    # Ids may repeat: a name that sorts by id and tells rows of different text apart.
    name = F.concat(F.coalesce(F.lpad(F.col("doc_id").cast("string"), 20, "0"), F.lit("~")), F.lit(":"), F.hex(row_key("doc_id", "text")))
    own = docs.select(*COLUMNS).withColumn("__name", name)
    found = jaccard.jaccard_components(own, "__name")
    stay = found.filter("doc_id = component_id").select(F.col("doc_id").alias("__name")).distinct()
    first = Window.partitionBy("__name").orderBy("__name")
    left = own.join(stay, "__name").withColumn("__nth", F.row_number().over(first))
    return left.filter("__nth = 1").select(*COLUMNS)


def without_repeats(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without the passages that occur elsewhere; untouched texts stay as they are."""
    own = docs.select(F.col("doc_id").alias("__id"), *COLUMNS[1:])
    found = substrings.remove_repeats(own, "__id", keep=COLUMNS[1:])
    text = F.when(F.col("n_removed") > 0, F.col("kept")).otherwise(F.col("text"))
    return found.select(
        "doc_id", text.alias("text"), "lang", "source",
        F.when(F.col("n_removed") > 0, F.length("kept").cast("long")).otherwise(F.col("n_chars")).alias("n_chars"),
    )


def packed(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The pieces of the documents with their place in the packed sequences."""
    return packing.pack(docs)


STAGES = [
    ("language", language),
    ("quality", good),
    ("near_duplicates", one_of_each),
    ("passages", without_repeats),
    ("packing", packed),
]

#: Trained models and hashes: SQL can't express the stages. Tests hold them against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for i, (_, stage) in enumerate(STAGES):
        before, docs = docs, stage(spark, docs, sf_dir)
        if i < len(STAGES) - 1:
            docs = staged(docs)
            if i:
                drop_staged(before)
    return docs
