"""Vectors dealt into shards, queries into blocks, and results merged: what both searches share."""

from __future__ import annotations

from collections.abc import Callable

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tickloom.session import Scratch

#: Vectors of a shard and queries of a block, which meet in one task; queries that travel as one row.
SHARD_ROWS, BLOCK_ROWS, PACKED_ROWS = 4096, 65536, 1024


def usable(vector: str) -> Column:
    """Is the vector there and without null or non-finite components?"""
    bad = F.exists(vector, lambda x: x.isNull() | F.isnan(x.cast("double")) | (F.abs(x.cast("double")) == float("inf")))
    return F.col(vector).isNotNull() & (F.size(vector) > 0) & ~bad


def distinct_vectors(scratch: Scratch, rows: DataFrame, k: int, shard_rows: int | None = None) -> DataFrame:
    """``v`` once each, with the k + 1 smallest of its ``ids``, and a shard, from ``vec_id`` and ``v``.

    Equal vectors score alike and ties go to smaller ids, so of equal ones no others can be among a
    query's best k besides itself.  The limit is applied before the shuffle too, so a vector that a third of
    the rows share stays small.
    """
    by = Window.partitionBy("v").orderBy("vec_id")
    least = rows.where("vec_id IS NOT NULL").distinct().withColumn("place", F.row_number().over(by)).where(F.col("place") <= k + 1)
    grouped = scratch.keep(least.groupBy("v").agg(F.array_sort(F.collect_list("vec_id")).alias("ids")), "vectors")
    shards = max(1, -(-grouped.count() // (shard_rows or SHARD_ROWS)))
    # Vectors of different lengths never meet.
    shard = F.concat_ws("/", F.size("v"), F.pmod(F.xxhash64("v"), F.lit(shards)))
    return grouped.withColumn("shard", shard)


def query_blocks(scratch: Scratch, rows: DataFrame, wanted: Column) -> tuple[DataFrame, int]:
    """The queries in rows of about PACKED_ROWS: ``block``, ``length`` of the vectors, ``ids``, ``vs``; and the number of blocks."""
    queries = scratch.keep(rows.where(wanted).distinct(), "queries")
    count = queries.count()
    blocks, packs = max(1, -(-count // BLOCK_ROWS)), max(1, -(-count // PACKED_ROWS))
    pack = F.pmod(F.xxhash64("vec_id"), F.lit(packs))
    packed = queries.groupBy(pack.alias("pack"), F.size("v").alias("length")).agg(F.collect_list(F.struct("vec_id", "v")).alias("q"))
    block = F.pmod(F.col("pack"), F.lit(blocks)).alias("block")
    return packed.select(block, "length", F.transform("q", lambda q: q.vec_id).alias("ids"), F.transform("q", lambda q: q.v).alias("vs")), blocks


def search_shards(
    shards: DataFrame, queries: DataFrame, blocks: int, search: Callable[[pd.DataFrame, pd.DataFrame], pd.DataFrame], score: str, descending: bool, k: int
) -> DataFrame:
    """Every block of queries against every shard, by ``search(shard, block)``, then the best k of each query.

    search returns query_id, vec_id and score.  Queries travel packed, one row for about a thousand of them and each shard, and a shard once for every
    block.  Each of a shard's answers is short, so the merge sees a few rows per query and shard.
    """
    names = shards.groupBy(F.col("shard").alias("name")).count()
    met = queries.join(names.withColumn("length", F.split_part("name", F.lit("/"), F.lit(1)).cast("int")), "length")
    left = met.select("block", F.col("name").alias("part"), "ids", "vs")
    right = shards.withColumn("block", F.explode(F.sequence(F.lit(0), F.lit(blocks - 1)))).withColumn("block", F.col("block").cast("long"))

    def run(block: pd.DataFrame, shard: pd.DataFrame) -> pd.DataFrame:
        if not len(block) or not len(shard):
            return pd.DataFrame({"query_id": np.empty(0, np.int64), "vec_id": np.empty(0, np.int64), "score": np.empty(0)})
        return search(shard, pd.DataFrame({"vec_id": np.concatenate(block["ids"].to_list()), "query": [v for vs in block["vs"] for v in vs]}))

    found = left.groupBy("block", "part").cogroup(right.groupBy("block", "shard")).applyInPandas(run, f"query_id long, vec_id long, score {score}")
    by = Window.partitionBy("query_id").orderBy(F.col("score").desc() if descending else F.col("score"), "vec_id")
    ranked = found.distinct().withColumn("rank", F.row_number().over(by)).where(F.col("rank") <= k)
    return ranked.select("query_id", "rank", "vec_id", "score")


def best_ids(query: int, ids: list[np.ndarray], scores: np.ndarray, k: int) -> tuple[list[int], list]:
    """The k best of some vectors' ids other than the query's; scores: ascending is better, one per vector."""
    pairs = sorted((s, i) for s, own in zip(scores.tolist(), ids, strict=True) for i in own.tolist() if i != query)[:k]
    return [i for _, i in pairs], [s for s, _ in pairs]
