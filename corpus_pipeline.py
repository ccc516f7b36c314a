"""Corpus pipeline: documents to packed training sequences, in stages.

Each stage takes ``(spark, docs, sf_dir)`` and returns a DataFrame, which
``run`` writes as Parquet and reads again as the next stage's ``docs``:

1. toxicity: documents that the classifier rejects go;
2. exact_dedup: of equal texts the longest original stays;
3. near_dedup: one document of each group of near copies (five words, similarity 0.8) stays;
4. decontamination: documents that hold a passage of the benchmark go;
5. packing: the rest is tokenised and packed into sequences.

Stages 1 to 4 return the columns of ``docs``.  They judge rows, not ids: rows
with a null id are judged like others, of repeated rows one passes stages 2 and
3, and rows with one id and different texts are judged one by one.
"""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession

from ventilake.llm.common import shared_folder, table
from ventilake.llm.decontaminate import drop_contaminated
from ventilake.llm.exact_dedup import drop_exact_copies
from ventilake.llm.near_dedup import drop_near_copies
from ventilake.llm.packing import default_tokenizer, pack
from ventilake.llm.toxicity import drop_toxic


#: near copies from this similarity (in hundredths) go; op6's query has a threshold of its own
NEAR = 80
#: 30 bands of five values: a pair at similarity 0.80 shares none with probability 7e-6
NEAR_PERMS, NEAR_ROWS = 75, 5


def toxicity(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return drop_toxic(docs, table(spark, sf_dir, "labels"))


def exact_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return drop_exact_copies(docs)


def near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return drop_near_copies(docs, threshold=NEAR, perms=NEAR_PERMS, rows_per_band=NEAR_ROWS)


def decontamination(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return drop_contaminated(docs, table(spark, sf_dir, "benchmark"))


def packing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return pack(docs, default_tokenizer())


STAGES = [
    ("toxicity", toxicity),
    ("exact_dedup", exact_dedup),
    ("near_dedup", near_dedup),
    ("decontamination", decontamination),
    ("packing", packing),
]

#: the classifier, the components and the tokenizer are not expressible in SQL
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The stages over ``documents``; what each returns is kept in the shared folder under a name of its own."""
    folder = f"{shared_folder(spark)}/corpus-{uuid.uuid4().hex}"
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES:
        stage(spark, docs, sf_dir).write.parquet(f"{folder}/{name}")
        docs = spark.read.parquet(f"{folder}/{name}")
    return docs
