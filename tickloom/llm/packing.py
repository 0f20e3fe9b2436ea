"""Packing of token sequences by a grouping genetic algorithm on islands.

Documents are tokenised and only those longer than a sequence cut.  Pieces that fill a sequence
stand alone.  All others are dealt by hash into shards of bounded size; a shard's
population lives on several islands, each a group of its own.  An individual is a packing, its genes are
bins: crossover injects whole well-filled bins of one parent into the other, removes the
bins that held the same documents, and puts the documents displaced by that where they fit best.
Packings begin as best fits in random orders; one by size joins half way, if the fewest bins possible are not reached by then.
Between epochs the best packing of each island migrates to the next island.  Shards only lose the
room of about one bin each, so more data means more shards, not larger ones.
"""

from __future__ import annotations

import gc
import json
import os
import re
import zlib
from array import array
from bisect import bisect_left, insort
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tickloom.llm.corpus import release
from tickloom.llm.rowwise import slices
from tickloom.session import Scratch

LENGTH = 4096
#: The id that ends a document.
END = 1
SHARD_ITEMS = 4096
ISLANDS, EPOCHS, POPULATION, GENERATIONS = 3, 3, 10, 100
#: Words kept with their ids by each worker, and the longest such.
CACHE_WORDS, CACHE_BYTES = 200_000, 64

#: Letters and marks beyond ASCII of words that are cut here; each is its own composed form, in every version of Unicode.
_LETTERS = "a-z\u00df-\u00f6\u00f8-\u024f"
_PLAIN = re.compile(f"[!-~{_LETTERS}¡¿«»‘’“”–—…]+")


def default_tokenizer() -> str:
    import public_tokenizers

    return public_tokenizers.path("word_bpe_49k.json")


class WordTokenizer:
    """Ids of words by a tokenizer's file, and this worker's known words.

    The file's own library tokenises any word.  Most words, plain ones, are encoded faster by merging in the order of ids, where
    the file is of the form for which that is the same: byte-level, an id for each byte, for each byte that ends a word, then one for each
    merge in turn.  The byte 0xFF, which no text has, stands for a word's end.
    """

    def __init__(self, path: str):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer

        self.full = Tokenizer.from_file(path)
        self.known = KnownWords(self)
        self.pattern, self.special, self.merge = None, (), None
        with open(path, encoding="utf-8") as file:
            described = json.load(file)
        model, splits = described["model"], described.get("pre_tokenizer") or {}
        splits = [p["pattern"].get("Regex") for p in splits.get("pretokenizers", []) if p["type"] == "Split" and p["invert"] and p["behavior"] == "Removed"]
        steps = [(n["type"], n.get("pattern")) for n in (described.get("normalizer") or {}).get("normalizers", [])]
        ranks = ranks_of(model)
        if ranks and splits == [WORD_PATTERN] and steps == [("NFC", None), ("Replace", {"Regex": r"\s+"}), ("Lowercase", None)]:
            import tiktoken

            self.merge = tiktoken.Encoding("words", pat_str=WORD_PATTERN, mergeable_ranks=ranks, special_tokens={})._core_bpe.encode_single_piece
            self.pattern = re.compile(f"'s|'t|'re|'ve|'m|'ll|'d|[{_LETTERS}]+|[0-9]|[^{_LETTERS}0-9]+")
            self.special = tuple(t["content"] for t in described["added_tokens"])

    def _plainly(self, word: str) -> bytes | None:
        """Ids of a plain word, or None."""
        lower = word.lower()
        plain = lower.isprintable() if lower.isascii() else _PLAIN.fullmatch(lower)
        if self.merge is None or not plain or ("<" in word and any(mark in word for mark in self.special)):
            return None
        ids = array("I")
        for piece in self.pattern.findall(lower):
            ids.extend(self.merge(piece.encode() + b"\xff"))
        return ids.tobytes()

    def word_bytes(self, word: bytes) -> bytes:
        text = word.decode()
        ids = self._plainly(text)
        return array("I", self.full.encode(text, add_special_tokens=False).ids).tobytes() if ids is None else ids

    def token_bytes(self, text: bytes | None) -> bytes:
        """The ids of a text, and the end's, as little-endian unsigned 32-bit numbers.

        The tokenizer drops white space and none of its tokens spans any, so words between ASCII
        white space are tokenised apart, and each only once while it is known.
        """
        return b"".join(map(self.known.__getitem__, (text or b"").split())) + array("I", [END]).tobytes()


class KnownWords(dict):
    """Words with their ids; starts anew when it is full."""

    def __init__(self, tokenizer: WordTokenizer):
        super().__init__()
        self.find = tokenizer.word_bytes

    def __missing__(self, word: bytes) -> bytes:
        ids = self.find(word)
        if len(word) <= CACHE_BYTES:
            if len(self) >= CACHE_WORDS:
                self.clear()
            self[word] = ids
        return ids


#: The pattern of the default tokenizer's words, as its file has it (fixed value).
WORD_PATTERN = r"'s|'t|'re|'ve|'m|'ll|'d|[\p{L}]+|[\p{N}]|[^\s\p{L}\p{N}]+"


def ranks_of(model: dict) -> dict[bytes, int] | None:
    """Bytes of each token with its id, if ids are in the order of merges; a word's end is the byte 0xFF."""
    suffix, merges, vocabulary = model.get("end_of_word_suffix"), model.get("merges", []), model.get("vocab", {})
    if model.get("type") != "BPE" or not suffix or model.get("continuing_subword_prefix"):
        return None
    shown = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    letters = {chr(b): b for b in shown} | {chr(0x100 + k): b for k, b in enumerate(b for b in range(0x100) if b not in shown)}
    if sorted(vocabulary[x] for x in letters if x in vocabulary) != [*range(256)] or sorted(vocabulary[x + suffix] for x in letters if x + suffix in vocabulary) != [*range(256, 512)]:
        return None
    pairs = [tuple(m.split(" ")) if isinstance(m, str) else tuple(m) for m in merges]
    if any(vocabulary.get(a + b) != 512 + i or a.endswith(suffix) for i, (a, b) in enumerate(pairs)):
        return None
    tokens = [*letters, *(x + suffix for x in letters), *(a + b for a, b in pairs)]
    return {bytes(letters[c] for c in t.removesuffix(suffix)) + (b"\xff" if t.endswith(suffix) else b""): vocabulary[t] for t in tokens}


@lru_cache(1)
def _tokenizer(path: str) -> WordTokenizer:
    """This worker's tokenizer."""
    return WordTokenizer(path)


def tokenize(df: DataFrame, key: str = "doc_id", text: str = "text", path: str | None = None, length: int = LENGTH) -> DataFrame:
    """Key, number of ids with the end's, and the crc32 of the ids of each piece of ``length``, for every row."""
    path = path or default_tokenizer()
    schema = T.StructType([T.StructField("key", df.schema[key].dataType), T.StructField("n", T.LongType()), T.StructField("crcs", T.ArrayType(T.LongType()))])

    def run(parts: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in parts:
            for at, take in slices(part.column("text"), 1 << 20, 4096):
                some = part.slice(at, take)
                sizes, crcs = [], []
                for ids in map(_tokenizer(path).token_bytes, some.column("text").to_pylist()):
                    sizes.append(len(ids) // 4)
                    crcs.append([zlib.crc32(ids[k : k + 4 * length]) for k in range(0, len(ids), 4 * length)])
                yield pa.RecordBatch.from_arrays([some.column("key"), pa.array(sizes, pa.int64()), pa.array(crcs, pa.list_(pa.int64()))], names=schema.names)
        # An idle worker would keep its words and the vocabulary beside those at work in later stages.
        _tokenizer.cache_clear()
        gc.collect()
        release()

    return df.select(F.col(f"`{key}`").alias("key"), F.col(f"`{text}`").cast("binary").alias("text")).mapInArrow(run, schema)


def best_fit(lengths: np.ndarray, order: np.ndarray, bins: np.ndarray, rooms: list[int], length: int) -> int:
    """Put the items of ``order`` where the least room stays, opening bins as needed; returns the number of bins.

    bins: each item's bin, written for the items placed; rooms: what the existing bins have left.
    """
    free = sorted((room, b) for b, room in enumerate(rooms))
    n = len(rooms)
    for item in order.tolist():
        need = int(lengths[item])
        at = bisect_left(free, (need, -1))
        if at < len(free):
            room, b = free.pop(at)
        else:
            room, b, n = length, n, n + 1
        bins[item] = b
        if room > need:
            insort(free, (room - need, b))
    return n


def _fitness(lengths: np.ndarray, bins: np.ndarray, length: int) -> tuple[int, float]:
    """Bins, and how unevenly they are filled (negative): the smaller the better."""
    fills = np.bincount(bins, weights=lengths)
    return len(fills), -float(((fills / length) ** 2).sum())


def cross(lengths: np.ndarray, one: np.ndarray, other: np.ndarray, random: np.random.Generator, length: int) -> np.ndarray:
    """``one`` with some of the well-filled bins of ``other``."""
    fills = np.bincount(other, weights=lengths)
    well = np.flatnonzero(fills >= np.quantile(fills, 0.5))
    injected = well[random.random(len(well)) < random.uniform(0.1, 0.6)]
    carried = np.isin(other, injected)
    hit = np.unique(one[carried])
    displaced = np.isin(one, hit) & ~carried
    stay = ~carried & ~displaced
    child = np.empty(len(one), np.int64)
    kept, child[stay] = np.unique(one[stay], return_inverse=True)
    moved, place = np.unique(other[carried], return_inverse=True)
    child[carried] = place + len(kept)
    placed = ~displaced
    rooms = length - np.bincount(child[placed], weights=lengths[placed], minlength=len(kept) + len(moved)).astype(np.int64)
    loose = np.flatnonzero(displaced)
    best_fit(lengths, loose[np.argsort(-lengths[loose], kind="stable")], child, rooms.tolist(), length)
    return child


def evolve(lengths: np.ndarray, elites: list[np.ndarray], seed: int, length: int = LENGTH) -> np.ndarray:
    """The best packing after some generations from the given packings and best fits in random orders.

    Generations run while more bins are used than the items fill; one whose packing needs no more is done.
    """
    random = np.random.default_rng(seed)
    least = -(-int(lengths.sum()) // length)
    if any(int(e.max()) + 1 <= least for e in elites):
        return min(elites, key=lambda e: _fitness(lengths, e, length))

    def packed(order: np.ndarray) -> np.ndarray:
        bins = np.empty(len(lengths), np.int64)
        best_fit(lengths, order, bins, [], length)
        return bins

    people = list(elites)
    people += [packed(random.permutation(len(lengths))) for _ in range(POPULATION - len(people))]
    ranked = sorted(((_fitness(lengths, p, length), i, p) for i, p in enumerate(people)), key=lambda x: x[:2])
    number = len(ranked)
    for generation in range(GENERATIONS):
        if ranked[0][0][0] <= least:
            break
        if generation == GENERATIONS // 2:
            # A packing by size joins late, so that it is one parent among others.
            by_size = packed(np.argsort(-lengths, kind="stable"))
            ranked.append((_fitness(lengths, by_size, length), number, by_size))
            number += 1
            ranked.sort(key=lambda x: x[:2])
        a, b = (min(random.integers(0, len(ranked), 2)) for _ in range(2))
        child = cross(lengths, ranked[a][2], ranked[b if a != b else (a + 1) % len(ranked)][2], random, length)
        ranked.append((_fitness(lengths, child, length), number, child))
        number += 1
        ranked = sorted(ranked, key=lambda x: x[:2])[:POPULATION]
    return ranked[0][2]


def _islands(scratch: Scratch, items: DataFrame, length: int) -> DataFrame:
    """``row`` and its bin in the best packing of each shard, from ``shard``, ``row`` and ``length``."""
    schema = "shard long, island int, row long, length long, bin long, bins long, uneven double"

    def epoch(number: int):
        def run(group: pd.DataFrame) -> pd.DataFrame:
            shard, island = int(group["shard"].iloc[0]), int(group["island"].iloc[0])
            if "origin" in group:
                packings = [p.sort_values("row", ignore_index=True) for _, p in group.groupby("origin")]
                elites, base = [p["bin"].to_numpy() for p in packings], packings[0]
            else:
                elites, base = [], group.sort_values("row", ignore_index=True)
            lengths = base["length"].to_numpy()
            best = evolve(lengths, elites, (shard * ISLANDS + island) * EPOCHS + number, length)
            bins, uneven = _fitness(lengths, best, length)
            return pd.DataFrame({"shard": shard, "island": island, "row": base["row"], "length": lengths, "bin": best, "bins": bins, "uneven": uneven})

        return run

    everywhere = items.withColumn("island", F.explode(F.array(*[F.lit(i) for i in range(ISLANDS)])))
    state = scratch.keep(everywhere.groupBy("shard", "island").applyInPandas(epoch(0), schema), "islands")
    for number in range(1, EPOCHS):
        own = state.withColumn("origin", F.lit(0))
        migrants = state.withColumn("origin", F.lit(1)).withColumn("island", (F.col("island") + 1) % ISLANDS)
        both = own.unionByName(migrants)
        state = scratch.keep(both.groupBy("shard", "island").applyInPandas(epoch(number), schema), "islands")
    best = state.groupBy("shard").agg(F.min(F.struct("bins", "uneven", "island")).alias("best")).select("shard", F.col("best.island").alias("island"))
    return state.join(best, ["shard", "island"]).select("shard", "row", "length", "bin")


def pack(scratch: Scratch, df: DataFrame, key: str = "doc_id", text: str = "text", path: str | None = None, length: int = LENGTH) -> DataFrame:
    """Pack all rows: a row per piece with the key column, ``piece``, ``start``, ``length``, ``ids_crc32``, ``sequence_id`` and ``offset``.

    Null and empty texts are one piece, the end's id.  Repeated rows are packed each.  An empty table gives no pieces.  Other columns take
    no part, whatever their names.
    """
    tokens = scratch.keep(tokenize(df, key, text, path, length).withColumn("row", F.monotonically_increasing_id()), "tokens")
    pieces = tokens.select("row", "key", "n", F.posexplode("crcs").alias("piece", "ids_crc32")).select(
        "row", "key", "piece", (F.col("piece").cast("long") * length).alias("start"), F.least(F.lit(length).cast("long"), F.col("n") - F.col("piece").cast("long") * length).alias("length"), "ids_crc32"
    )
    loose = pieces.where(F.col("length") < length)
    count = loose.count()
    shards = max(1, round(count / SHARD_ITEMS))
    items = loose.select(F.pmod(F.xxhash64("row"), F.lit(shards)).alias("shard"), "row", "length")

    def place(group: pd.DataFrame) -> pd.DataFrame:
        group = group.sort_values(["bin", "row"], ignore_index=True)
        group["offset"] = group.groupby("bin")["length"].cumsum() - group["length"]
        group["sequence_id"] = group["shard"] * (1 << 24) + group["bin"]
        return group[["row", "sequence_id", "offset"]]

    places = _islands(scratch, items, length).groupBy("shard").applyInPandas(place, "row long, sequence_id long, offset long")
    # Full pieces have sequences of their own, numbered below zero.
    alone = pieces.where(F.col("length") == length).select("*", (-1 - F.monotonically_increasing_id()).alias("sequence_id"), F.lit(0).cast("long").alias("offset"))
    both = loose.join(places, "row").unionByName(alone)
    return both.select(F.col("key").alias(key), "piece", "start", "length", "ids_crc32", "sequence_id", "offset")
