"""A corpus from raw documents to packed sequences, each stage stored before the next one reads it."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from tallybook.llm import minhash, mixing, packing, quality
from tallybook.llm.queries import read, tokenizer_file
from tallybook.llm.stage import stage
from tallybook.llm.workers import ship, small_batches

# The classifier is fitted and tokens are counted in Python; SQL cannot express the rows.
ORACLE_SQL = None


def good_documents(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the quality classifier keeps, whole rows.

    Null and empty texts are scored by their site alone; rows without an id are scored like others but
    teach nothing; repeated rows get the same score. Without labels, or without documents, nothing is
    rejected, or there is nothing to reject. Further columns of ``docs`` come out again.
    """
    ship(spark)
    labels = spark.read.parquet(f"{sf_dir}/labels.parquet")
    kept = quality.score_documents(docs, labels).where("keep").select(*docs.columns)
    # Texts go to Python once more when these rows are read: stored here, they do so in small batches.
    with small_batches(spark):
        return stage(kept, "good")


def distinct_documents(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near copies: five-word shingles, similarity 0.8 or more.

    The one with the smallest id stays; ids are told apart by their texts, so that an id that stands for
    several texts neither keeps nor drops the others. Of repeated rows one stays. Rows without an id, and
    texts without words, are copies of nothing and all stay, the latter once per id and text. An empty
    table gives an empty one.
    """
    ship(spark)
    mark = F.xxhash64("text")
    named = docs.where("doc_id IS NOT NULL")
    texts = named.select(F.struct("doc_id", mark.alias("mark")).alias("id"), "text")
    kept = stage(
        minhash.near_duplicates(texts, id_column="id").where("kept")
        .groupBy(F.col("doc_id.doc_id").alias("__id"), F.col("doc_id.mark").alias("__mark"))
        .agg(F.count(F.lit(1)).alias("rows")), "kept")
    marked = named.withColumn("__text", mark)

    def chosen(rows: str) -> DataFrame:
        keys = kept.where(rows)
        return marked.join(keys, (F.col("doc_id") == F.col("__id")) & (F.col("__text") == F.col("__mark")), "left_semi")

    # Only repeated rows need to come together.
    copies = Window.partitionBy("doc_id", "__text").orderBy(F.lit(0))
    first = chosen("rows > 1").withColumn("__copy", F.row_number().over(copies)).where("__copy = 1").drop("__copy")
    return chosen("rows = 1").unionByName(first).drop("__text").unionByName(docs.where("doc_id IS NULL"))


def mixed_documents(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The documents of the mix, each as often as it is taken.

    A null source is a source; null and empty texts have no words, so the mix takes none of them; rows
    without an id and repeated rows are mixed like others; an empty table gives an empty one.
    """
    ship(spark)
    return mixing.mixed_rows(mixing.mix_sources(docs)).select(*docs.columns)


def packed_sequences(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The pieces of all documents and their places in sequences.

    A null text is an empty one and has its end token alone; rows without an id and repeated rows are
    packed like others; longer texts are cut; an empty table gives no pieces.
    """
    ship(spark)
    return packing.pack(docs, tokenizer_file())


STAGES = [
    ("quality classifier", good_documents),
    ("near duplicates", distinct_documents),
    ("mixing sources", mixed_documents),
    ("packing", packed_sequences),
]


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read(spark, sf_dir, "documents")
    for name, function in STAGES:
        docs = stage(function(spark, docs, sf_dir), name.replace(" ", "-"))
    return docs
