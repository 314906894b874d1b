"""A training corpus from the documents: quality, near-duplicates, benchmarks, mix, shards.

Each stage takes (spark, docs, sf_dir), works on all rows that its predecessor
kept and returns the columns of ``documents``; the last one adds ``shard``. What
a stage returns is written as Parquet into the shared folder and read again, so a
lost executor costs at most the stage that runs. A stage's rows are deleted when the
next stage has written its own, the last ones when the session ends.

1. quality classifier: documents that it rejects (toxic or poor) go;
2. SimHash near-dedup: of each component the document with the smallest doc_id stays,
   one row of it where rows repeat;
3. benchmark decontamination: documents that hold a benchmark window go;
4. mix: a document is returned as often (0 to 2 times) as the mix takes it;
5. sharding: ``SHARDS`` shards of near equal bytes.

SQL can express neither the classifier nor the fingerprints; tests hold the
stages against brute-force versions.
"""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession

from runtally.llm import decontaminate, kd_shards, ordinal_quality, simhash_vptree, source_mix
from runtally.llm.common import drop_folder, shared_folder, table
from runtally.llm.queries import SHARDS, SIMHASH_BITS, SIMHASH_WIDTH


def quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return ordinal_quality.kept_rows(docs, ordinal_quality.train(docs, table(spark, sf_dir, "labels")))


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return simhash_vptree.kept_rows(docs, SIMHASH_WIDTH, SIMHASH_BITS)


def benchmarks(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return decontaminate.clean_rows(docs, table(spark, sf_dir, "benchmark"))


def mix(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return source_mix.mixed_rows(docs)


def shards(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return kd_shards.sharded_rows(docs, shards=SHARDS)


STAGES = [
    ("quality classifier", quality), ("SimHash near-dedup", near_duplicates), ("benchmark decontamination", benchmarks),
    ("mixing sources", mix), ("sharding", shards),
]
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    folder = f"{shared_folder(spark).rstrip('/')}/corpus-{uuid.uuid4().hex}"
    drop_folder(spark, folder, at_end=True)
    docs = table(spark, sf_dir, "documents")
    for k, (_, stage) in enumerate(STAGES):
        out = f"{folder}/{k}"
        stage(spark, docs, sf_dir).write.parquet(out)
        docs = spark.read.parquet(out)
        if k:
            drop_folder(spark, f"{folder}/{k - 1}")
    return docs
