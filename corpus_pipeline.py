"""A training corpus from ``documents``: language, near copies, benchmark passages, secrets, packed sequences.

Each stage takes (spark, docs, sf_dir) and returns a DataFrame that is written as Parquet and read again as the next
one's ``docs``.  All but the last return the columns of ``docs``.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from daygrain.llm import decontaminate, language, minhash, packing, secrets
from daygrain.llm.bitmap import free_name, split_by
from daygrain.session import written


def known_language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents with letters; a missing ``lang`` is filled in by a model that learns from every labelled text.

    A document goes if its text is null or has no letters.  Where no text has a label, ``lang`` stays as it is.
    """
    model = language.train(docs)
    if not model.languages:
        return language.lettered(docs)
    pred, score = "__lang_pred", "__lang_score"
    told = language.predict(docs, model, pred, score).where(F.col(score) > 0)  # 0 without letters, whatever the labels' names
    lang = F.coalesce(F.col("lang"), F.col(pred)).alias("lang")
    return told.select(*[lang if c == "lang" else F.col(f"`{c}`") for c in docs.columns])


def without_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near copies (five-word shingles, similarity 0.8): the one with the smallest id.

    Repeated rows of one document are copies, too; a row with another text is judged by that text.  Rows without id are
    in no group and stay.
    """
    text_hash, kept, times = (free_name(docs, n) for n in ("text_hash", "kept", "times"))
    key = ["doc_id", text_hash]
    hashed = docs.withColumn(text_hash, F.xxhash64("text"))
    found = minhash.near_duplicates(hashed, k=5, percent=80, carried=(text_hash,)).where("doc_id IS NOT NULL")
    by_row = written(found.groupBy(*key).agg(F.max("kept").alias(kept), F.count("*").alias(times)), "kept")
    # rows that go, and those of which one stays; texts of all others are not shuffled
    known = written(by_row.where(~F.col(kept) | (F.col(times) > 1)), "gone")
    doubtful, clear = split_by(hashed, known, *key)
    told = doubtful.join(known, key, "left")
    single = told.where(F.col(times).isNull())
    repeated = told.where(F.col(kept) & (F.col(times) > 1)).dropDuplicates(["doc_id", "text"])
    columns = [F.col(f"`{c}`") for c in docs.columns]
    return clear.select(*columns).unionByName(single.select(*columns)).unionByName(repeated.select(*columns))


def without_benchmark(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without a benchmark passage of ten words."""
    return decontaminate.decontaminated(docs, spark.read.parquet(f"{sf_dir}/benchmark.parquet"), window=10)


def without_secrets(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents, with secrets cut out of their texts."""
    return secrets.redacted(docs)


def packed(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Places of the tokenised documents in sequences of 4096 tokens."""
    import public_tokenizers

    return packing.pack(docs, public_tokenizers.path("word_bpe_49k.json"), capacity=4096)


STAGES = [
    ("language", known_language),
    ("near_duplicates", without_near_copies),
    ("decontamination", without_benchmark),
    ("secrets", without_secrets),
    ("packing", packed),
]

ORACLE_SQL = None  # the first two stages can't be stated in SQL; tests/llm holds run() against plain Python


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES[:-1]:
        docs = written(stage(spark, docs, sf_dir), f"stage-{name}")
    return STAGES[-1][1](spark, docs, sf_dir)
