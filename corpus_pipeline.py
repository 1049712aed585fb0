"""A corpus from documents to packed sequences, in five stages.

Each stage takes what the one before has kept and is written as Parquet in the shared
folder before the next one reads it. The first four return the columns of documents.
"""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tickshard.llm import language, near, packing, pii, tiling
from tickshard.llm.queries import tokenizer_path
from tickshard.llm.scratch import small_batches
from tickshard.plans.temporary import shared_folder
from tickshard.session import configure


#: Bits of the filter that says which texts may be gone: 512 rows of 4 KiB at most.
FILTER_BITS = 1 << 24


def _without(docs: DataFrame, gone: DataFrame) -> DataFrame:
    """*docs* without the ids in *gone*, a stored result.

    A bit table of fixed size, made from those ids, is broadcast to the texts: a text whose
    bit is clear stays where it is, and only the others meet the ids in an exact anti join.
    Rows with a NULL id stay.
    """
    ids = gone.select("doc_id").where("doc_id IS NOT NULL").distinct()
    at = F.pmod(F.xxhash64("doc_id"), F.lit(FILTER_BITS)) + 1
    bucket, bit, bits = "__gone_bucket", "__gone_bit", "__gone_bits"
    table = ids.groupBy(F.bitmap_bucket_number(at).alias(bucket)).agg(
        F.bitmap_construct_agg(F.bitmap_bit_position(at)).alias(bits)
    )
    placed = docs.withColumns({bucket: F.bitmap_bucket_number(at), bit: F.bitmap_bit_position(at)})
    byte = f"conv(hex(substring({bits}, int({bit} div 8) + 1, 1)), 16, 10)"
    is_set = F.expr(f"getbit(cast({byte} AS bigint), int({bit} % 8)) = 1")
    flagged = placed.join(F.broadcast(table), bucket, "left").withColumn(
        bit, F.coalesce(is_set, F.lit(False))
    )
    sure = flagged.where(~F.col(bit)).select(*docs.columns)
    doubtful = flagged.where(bit).select(*docs.columns)
    return sure.unionByName(doubtful.join(ids, "doc_id", "left_anti").select(*docs.columns))


def language_id(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents whose text has a language; NULL texts and texts without a letter go."""
    small_batches(configure(spark))
    model = language.train(docs.where(~language.held_out()))
    found = language.identify(docs, model)
    return found.where(found.lang_pred != language.UNKNOWN).select(*docs.columns)


def near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near-duplicates: that with the smallest id."""
    small_batches(configure(spark))
    found = near.near_duplicates(docs, shingle=5)
    return _without(docs, found.where("NOT kept"))


def decontamination(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that hold no benchmark item."""
    benchmark = small_batches(configure(spark)).read.parquet(f"{sf_dir}/benchmark.parquet")
    return _without(docs, tiling.contaminated(docs, benchmark))


def personal_data(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents, with personal data in texts masked."""
    small_batches(configure(spark))
    return pii.mask(docs, pii.train(docs))


def packed(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The pieces of all documents, with their token ids, sequence and offset."""
    small_batches(configure(spark))
    return packing.pack(docs, tokenizer_path())


STAGES = [
    ("language_id", language_id),
    ("near_dedup", near_dedup),
    ("decontamination", decontamination),
    ("personal_data", personal_data),
    ("packing", packed),
]

#: Hashing, learning and packing are beyond SQL; tests compare with brute force instead.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over documents."""
    folder = f"{shared_folder(configure(spark))}/tickshard_corpus/{uuid.uuid4().hex}"
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for number, (name, stage) in enumerate(STAGES):
        path = f"{folder}/{number}_{name}"
        stage(spark, docs, sf_dir).write.parquet(path)
        docs = spark.read.parquet(path)
    return docs
