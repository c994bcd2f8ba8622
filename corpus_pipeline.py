"""The corpus pipeline: STAGES in order, each on all that its predecessor kept, each written as Parquet and read again."""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from splitweave.llm.common import scratch_of, written
from splitweave.llm.decontaminate import overlaps
from splitweave.llm.language import UNKNOWN, identify
from splitweave.llm.packing import pack
from splitweave.llm.secrets import redacted
from splitweave.llm.simhash import near_duplicates
from splitweave.sources.paths import remove

LEAST_SHARE = 0.3


def renamed(docs: DataFrame) -> tuple[DataFrame, dict[str, str]]:
    """The same columns under plain numbers, so that none has the name of a column which an operator adds; and their new names."""
    new = {c: f"column_{i}" for i, c in enumerate(docs.columns)}
    return docs.toDF(*new.values()), new


def known_language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Keep documents whose language is known, and is that of 3 in 10 of the text's letters at least; all labelled ones teach."""
    plain, new = renamed(docs)
    found = identify(plain, F.lit(True), new["lang"], new["text"])
    return found.where((F.col("lang_pred") != UNKNOWN) & (F.col("score") >= LEAST_SHARE)).select(*new.values()).toDF(*docs.columns)


def one_of_each(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Keep the document with the smallest id of every group of near duplicates: SimHash of 4-word shingles, at most 4 bits apart.

    Of rows equal in id and text one stays. Rows that share an id but not their text are documents like others, each in the
    group that its text belongs to; of those in one group with the smallest id, one stays. Rows without an id are not compared and stay.
    """
    plain, new = renamed(docs)
    doc_id, text = new["doc_id"], new["text"]
    groups = near_duplicates(plain, 4, 4, doc_id, text).where("doc_id = component_id").groupBy("doc_id", "class_id", "text_hash").agg(F.count("*").alias("rows"))
    one = groups.groupBy("doc_id", "class_id").agg(F.min(F.struct("text_hash", "rows")).alias("kept"))
    keep = written(one.select(F.col("doc_id").alias("keep_id"), "kept.text_hash", "kept.rows"), "keep")
    hashed = plain.withColumn("own_hash", F.xxhash64(F.coalesce(F.col(text), F.lit(""))))
    same = (F.col(doc_id).cast("long") == F.col("keep_id")) & (F.col("own_hash") == F.col("text_hash"))
    single = hashed.join(keep.where("rows = 1"), same, "left_semi")
    repeated = hashed.join(keep.where("rows > 1"), same, "left_semi").dropDuplicates([doc_id, "own_hash"])
    kept = single.unionByName(repeated).select(*new.values())
    return kept.unionByName(plain.where(F.col(doc_id).cast("long").isNull())).toDF(*docs.columns)


def uncontaminated(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Drop documents that hold a passage of the benchmark. Rows count for themselves, also those that share an id or have none."""
    plain, new = renamed(docs)
    rows = plain.withColumn("row_hash", F.xxhash64(new["doc_id"], new["text"]))
    found = overlaps(rows, spark.read.parquet(f"{sf_dir}/benchmark.parquet"), id_column="row_hash", text=new["text"], item_text="text")
    found = written(found.select(F.col("doc_id").alias("row_hash")).distinct(), "contaminated")
    return rows.join(found, "row_hash", "left_anti").select(*new.values()).toDF(*docs.columns)


def without_secrets(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Replace secrets in the texts and count the characters anew; all documents stay."""
    return redacted(docs).withColumn("n_chars", F.length("text").cast(docs.schema["n_chars"].dataType)).select(*docs.columns)


def packed(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Sequences of at most 2048 tokens."""
    return pack(docs, public_tokenizers.path("byte_bpe_50k.json"))


STAGES = [
    ("language_id", known_language),
    ("simhash_near_dedup", one_of_each),
    ("decontamination", uncontaminated),
    ("secret_scan", without_secrets),
    ("best_fit_packing", packed),
]

ORACLE_SQL = None  # SQL expresses none of the stages; tests compare them with brute force


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The last stage's rows. What a stage wrote on its way is removed when its result is written; so is that result, when the next one's is."""
    docs, last = spark.read.parquet(f"{sf_dir}/documents.parquet"), []
    for name, stage in STAGES:
        with scratch_of() as places:
            docs = written(stage(spark, docs, sf_dir), name)
        for place in [*last, *places[:-1]]:
            remove(spark, place)
        last = places[-1:]
    return docs
