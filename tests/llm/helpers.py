from __future__ import annotations

import random
import string

from pyspark.sql import DataFrame, SparkSession

#: Documents with columns of names that results and helper columns have as well.
DOCUMENTS = "doc_id long, text string, lang string, source string, n_chars long, size string, batch string, row string, part string, v string"


def documents(spark: SparkSession, rows: list[tuple[int | None, str | None]], sources: list[str | None] | None = None) -> DataFrame:
    full = [(k, t, "en", sources[i] if sources else "src", len(t or ""), "s", "b", "r", "p", "v") for i, (k, t) in enumerate(rows)]
    return spark.createDataFrame(full, DOCUMENTS)


def lower(text: str) -> str:
    return text.translate(str.maketrans(string.ascii_uppercase, string.ascii_lowercase))


def prose(random_: random.Random, words: int, vocabulary: int = 5000) -> list[str]:
    return [f"w{random_.randrange(vocabulary)}" for _ in range(words)]
