"""The corpus pipeline: stages over ``documents``, each written and read again before the next.

Each stage takes ``(spark, docs, sf_dir)`` and returns the documents that it keeps; all but the last return the columns that they got.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from daypanel.llm import toxicity
from daypanel.llm.base import WORD, cut, table
from daypanel.llm.decontaminate import leaks
from daypanel.llm.line_dedup import dedup_lines
from daypanel.llm.mixing import mix
from daypanel.llm.ngram_join import jaccard_classes


def packed(docs: DataFrame, *more: str) -> DataFrame:
    """``doc_id``, ``text`` and ``more`` beside ``row``, which holds all columns whatever their names."""
    return docs.select(F.struct(*(F.col(f"`{c}`") for c in docs.columns)).alias("row"), "doc_id", "text", *more)


def drop_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the classifier chain doesn't call toxic; null and empty texts stay."""
    return toxicity.score(packed(docs), table(spark, sf_dir, "labels")).where("toxic = 0").select("row.*")


def drop_repeated_lines(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without repeated chunks of lines; one that has no word left goes. ``n_chars`` is counted anew where the text changed."""
    rows = dedup_lines(packed(docs)).where((F.col("n_removed") == 0) | F.col("text").rlike(WORD))
    changed = {"text": F.col("text")}
    if "n_chars" in docs.columns:
        changed["n_chars"] = F.when(F.col("n_removed") > 0, F.length("text").cast(dict(docs.dtypes)["n_chars"])).otherwise(F.col("row.n_chars"))
    return rows.select(*(changed.get(c, F.col("row").getField(c)).alias(c) for c in docs.columns))


def one_of_each_group(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of each group of documents linked by shingles the one of the least id; texts without shingles stay.

    Rows are told apart by id and a hash of the text: a repeated id loses no other text, rows that repeat both are
    one document. A null id stays only where its group has no other.
    """
    classes = cut(jaccard_classes(docs, count_links=False))
    first = F.min(F.struct(F.col("doc_id").isNull().alias("none"), "doc_id", "text_key")).alias("first")
    kept = classes.where("group is not null").groupBy("group").agg(first).select(F.col("first.doc_id").alias("kept_id"), F.col("first.text_key").alias("kept_key"))
    rows = packed(docs).select("row", F.col("doc_id").cast("long").alias("kept_id"), F.xxhash64("text").alias("kept_key"))
    same = rows["kept_id"].eqNullSafe(kept["kept_id"]) & (rows["kept_key"] == kept["kept_key"])
    ones = rows.join(kept, same, "left_semi").dropDuplicates(["kept_id", "kept_key"]).select("row.*")
    blank = docs.where(F.col("text").isNull() | ~F.col("text").rlike(WORD))
    return ones.unionByName(blank)


def drop_leaks(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that hold no benchmark item, exact or edited.

    Rows are told apart by id and a hash of the text: a leak takes no other text of a repeated or null id with it.
    """
    found = leaks(docs, table(spark, sf_dir, "benchmark")).select(F.col("doc_id").alias("leaked"), "text_key").distinct()
    rows = packed(docs).withColumn("key", F.xxhash64("text"))
    return rows.join(found, F.col("doc_id").cast("long").eqNullSafe(F.col("leaked")) & (F.col("key") == F.col("text_key")), "left_anti").select("row.*")


def mix_to_weights(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the mix takes, with ``copies`` (1 to 3), ``size``, ``taken``, ``source_size`` and ``target``; a document is repeated by its number of copies, not by rows.

    Documents are told apart by id and text; rows that repeat both, which the stages before leave out, share the largest number.
    Columns of ``docs`` named like an added one are replaced.
    """
    added = ["size", "source_size", "target", "copies", "taken"]
    rows = packed(docs, "source").withColumn("mix_id", F.xxhash64("doc_id", "text"))
    mixed = mix(rows.select(F.col("mix_id").alias("doc_id"), "text", "source")).where("copies > 0")
    taken = cut(mixed.groupBy("doc_id", "source", "size").agg(*(F.max(c).alias(c) for c in added[1:])))
    taken = taken.select(F.col("doc_id").alias("taken_id"), F.col("source").alias("taken_source"), *added)
    rows = rows.join(taken, (F.col("mix_id") == F.col("taken_id")) & F.col("source").cast("string").eqNullSafe(F.col("taken_source")))
    return rows.select(*(F.col("row").getField(c).alias(c) for c in docs.columns if c not in added), *added)


STAGES = [
    ("toxicity", drop_toxic),
    ("line_dedup", drop_repeated_lines),
    ("ngram_jaccard_join", one_of_each_group),
    ("benchmark_decontamination", drop_leaks),
    ("mix_sources", mix_to_weights),
]

#: Hashing, training and alignment have no SQL form; tests compare each stage with a brute-force version.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The stages in order over ``documents``."""
    docs = table(spark, sf_dir, "documents")
    for _, stage in STAGES:
        docs = cut(stage(spark, docs, sf_dir))
    return docs
