"""From raw documents to packed training sequences, stage by stage.

Every stage takes the rows that the one before it kept and returns the
columns of ``documents`` (the last one: a row a packed piece). ``run`` writes
each stage's rows as Parquet below the cluster's shared folder and reads them
again, so a stage never repeats the work of those before it.

``ORACLE_SQL`` is None: the first stage's boosted trees have no SQL form; the
stages are tested against brute force instead.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from meterlake.llm import near_dedup, packing, substring_dedup, toxicity
from meterlake.llm.decontaminate import decontaminate
from meterlake.llm.deploy import ship
from meterlake.llm.queries import tokenizer_path
from meterlake.session import shared_dir

COLUMNS = ["doc_id", "text", "lang", "source", "n_chars"]
ORACLE_SQL = None


def reject_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents with a toxicity score below 0.5. Learns from the labels of
    keys whose crc32 is no multiple of 5, as the query of the operator does."""
    ship(spark)
    labels = spark.read.parquet(f"{sf_dir}/labels.parquet")
    learnt = F.coalesce(F.crc32(F.col("doc_id").cast("string")) % 5 != 0, F.lit(True))
    model = toxicity.fit_toxicity(docs, labels.where(learnt))
    return model.score(docs, score_col="__toxic").where("__toxic < 0.5").select(*docs.columns)


def drop_near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group linked at 80 percent of its 5-word
    shingles: the one with the smallest key; of rows with one key, one."""
    ship(spark)
    found = near_dedup.near_duplicates(docs, percent=80, size=5).checkpoint()
    dropped = found.where(~F.col("kept")).select(F.col("doc_id").alias("key")).distinct()
    several = found.where("doc_id is not null").groupBy(F.col("doc_id").alias("key")).agg(F.count(F.lit(1)).alias("n")).where("n > 1").select("key")
    # most rows are in neither list and stay where they are; the joins see the rest
    concerned = near_dedup.key_filter(dropped.union(several))
    rest = concerned(docs.where(F.col("doc_id").isNotNull()), "doc_id").withColumn("key", F.col("doc_id"))
    rest = rest.join(dropped, "key", "left_anti").dropDuplicates(["key"])
    clear = concerned(docs, "doc_id", others=True)
    return clear.select(*docs.columns).union(rest.select(*docs.columns))


def drop_repeated_passages(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents, without the words of 20-word windows that an earlier
    place has. A text that loses nothing stays as it is; the words that stay
    of another are joined by single spaces, and may be none."""
    ship(spark)
    done = substring_dedup.substring_dedup(docs, window=20, keep=tuple(c for c in docs.columns if c != "doc_id"))
    text = F.when(F.col("n_removed") > 0, F.col("kept_text")).otherwise(F.col("text"))
    whole = done.withColumn("text", text).withColumn("n_chars", F.when(F.col("n_removed") > 0, F.length("text").cast("long")).otherwise(F.col("n_chars")))
    return whole.select(*docs.columns)


def drop_contaminated(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without any 10-word window of a benchmark item."""
    ship(spark)
    found = decontaminate(docs, spark.read.parquet(f"{sf_dir}/benchmark.parquet"), window=10)
    return found.where("n_hit = 0").select(*docs.columns)


def pack(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Every piece of every document with its sequence of 2048 ids."""
    ship(spark)
    packed = packing.pack_documents(docs, tokenizer=tokenizer_path(), end_id=0, capacity=2048)
    return packed.select("doc_id", "piece", "start", "length", "ids_crc32", "sequence_id", "offset")


STAGES = [
    ("toxicity", reject_toxic),
    ("near_dedup", drop_near_duplicates),
    ("substring_dedup", drop_repeated_passages),
    ("decontamination", drop_contaminated),
    ("packing", pack),
]


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``; one row a packed piece."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").select(*COLUMNS)
    folder = shared_dir(spark, "pipeline")
    for name, stage in STAGES:
        path = f"{folder}/{name}"
        stage(spark, docs, sf_dir).write.parquet(path)
        docs = spark.read.parquet(path)
    return docs
