"""A training corpus from raw documents: toxic texts go, near copies and repeated passages go, sources are mixed and what is left is packed.

Each stage reads the whole table its predecessor kept, stored as Parquet.  Scratch tables of a
stage go when the next one begins, as its rows are stored by then.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tickloom.llm import jaccard, mixing, packing, substring, toxicity
from tickloom.session import Scratch

_open: list[Scratch] = []


def _scratch(spark: SparkSession) -> Scratch:
    """Scratch tables of the stage that begins; those of stages before are removed."""
    while _open:
        _open.pop().close()
    _open.append(Scratch(spark))
    return _open[-1]


def drop_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the classifier does not reject; it learns from those of them that are labelled and not held out."""
    labels = spark.read.parquet(f"{sf_dir}/labels.parquet")
    model = toxicity.fit(_scratch(spark), docs, labels)
    scored = toxicity.score(docs, model)
    return scored.where("predicted = 0").select(*[f"`{c}`" for c in docs.columns])


def drop_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The first document by id of each group that links of 0.8 and more between sets of five-word shingles hold together."""
    return jaccard.keep_first(_scratch(spark), docs, size=5, percent=80)


def drop_repeats(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Texts without the passages of 35 words and more that occur twice; ``n_chars`` follows."""
    kept = substring.remove_repeats(_scratch(spark), docs, size=35)
    if "n_chars" in docs.columns:
        kept = kept.withColumn("n_chars", F.length("text").cast(docs.schema["n_chars"].dataType))
    return kept.select(*[f"`{c}`" for c in docs.columns])


def mix(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Each document as often as its source's target takes it."""
    return mixing.mixed_rows(_scratch(spark), docs)


def pack(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of the documents placed in sequences of 4096 tokens."""
    return packing.pack(_scratch(spark), docs)


STAGES = [
    ("toxicity", drop_toxic),
    ("jaccard_join", drop_near_copies),
    ("substring_dedup", drop_repeats),
    ("mixing", mix),
    ("packing", pack),
]

#: Trained weights and a tokenizer's ids are beyond SQL.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``, each stored before the next one reads it."""
    stored = Scratch(spark)
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES:
        docs = stored.keep(stage(spark, docs, sf_dir), name)
    while _open:
        _open.pop().close()
    stored.close(*stored.paths[:-1])
    return docs
