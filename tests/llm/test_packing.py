from __future__ import annotations

import json
import math
import random
import zlib

import numpy as np
import pytest

from tests.llm.helpers import documents, prose
from tickloom.llm import packing
from tickloom.session import Scratch


def expected_pieces(rows, length):
    tokenizers = pytest.importorskip("tokenizers")
    tokenizer = tokenizers.Tokenizer.from_file(packing.default_tokenizer())
    out = []
    for key, text in rows:
        ids = np.array([*tokenizer.encode(text or "", add_special_tokens=False).ids, 1], "<u4")
        for at in range(0, len(ids), length):
            part = ids[at : at + length]
            out.append((key, at // length, at, len(part), zlib.crc32(part.tobytes())))
    return sorted(out, key=str)


def test_pieces_and_places(spark, monkeypatch):
    monkeypatch.setattr(packing, "SHARD_ITEMS", 40)
    r = random.Random(4)
    rows = [(i, " ".join(prose(r, r.randrange(1, 90)))) for i in range(120)]
    rows += [(200, None), (201, ""), (None, "Ünḯ it's <|endoftext|>x 12 a b c"), (202, "don't\x0bSTOP\n\n¡hola!"), (203, "x" * 5000), (204, "y " * 4000)]
    rows += [(205, "same text"), (205, "same text")]
    length = 256
    found = packing.pack(Scratch(spark), documents(spark, rows), length=length).toPandas()
    pieces = found[["doc_id", "piece", "start", "length", "ids_crc32"]].astype(object).where(found[["doc_id"]].notna().values | np.array([False, True, True, True, True]), None)
    assert sorted((tuple(None if v is None else int(v) for v in p) for p in pieces.itertuples(index=False)), key=str) == expected_pieces(rows, length)
    for _, sequence in found.sort_values("offset").groupby("sequence_id"):
        assert sequence["length"].sum() <= length
        assert (sequence["length"].cumsum() - sequence["length"] == sequence["offset"]).all()
    assert found["sequence_id"].nunique() <= math.ceil(found["length"].sum() / length) * 1.1 + 4


def test_no_rows(spark):
    assert packing.pack(Scratch(spark), documents(spark, [])).collect() == []


def check_packing(lengths, bins, length):
    assert (np.bincount(bins, weights=lengths) <= length).all()


def test_crossover_keeps_packings_whole():
    random_ = np.random.default_rng(0)
    lengths = random_.integers(1, 90, 300)
    people = []
    for k in range(2):
        bins = np.empty(len(lengths), np.int64)
        packing.best_fit(lengths, random_.permutation(len(lengths)), bins, [], 100)
        people.append(bins)
        check_packing(lengths, bins, 100)
    for _ in range(20):
        child = packing.cross(lengths, people[0], people[1], random_, 100)
        check_packing(lengths, child, 100)
        assert set(child) == set(range(child.max() + 1))
        people = [people[1], child]


def test_evolution_beats_or_equals_one_best_fit_and_takes_elites():
    lengths = np.array([60, 50, 30, 30, 20, 20, 20, 70, 40, 10, 10, 40] * 5)
    bins = np.empty(len(lengths), np.int64)
    simple = packing.best_fit(lengths, np.argsort(-lengths, kind="stable"), bins, [], 100)
    best = packing.evolve(lengths, [], 1, 100)
    assert best.max() + 1 <= simple
    again = packing.evolve(lengths, [best], 2, 100)
    assert again.max() + 1 <= best.max() + 1
    assert len(packing.evolve(np.array([5]), [], 0, 100)) == 1


def triples(count, length, seed):
    """Items that fill ``count`` sequences to the end, by threes."""
    random_, out = np.random.default_rng(seed), []
    for _ in range(count):
        a = random_.integers(int(0.38 * length), int(0.49 * length))
        b = random_.integers(length // 4 + 1, (length - a) // 2 + 1)
        out += [a, b, length - a - b]
    return np.array(out)


@pytest.mark.parametrize("count", [40, 83, 400])
def test_evolution_beats_decreasing_best_fit(monkeypatch, count):
    lengths = triples(count, 4096, count)
    bins = np.empty(len(lengths), np.int64)
    simple = packing.best_fit(lengths, np.argsort(-lengths, kind="stable"), bins, [], 4096)
    crossed, cross = [], packing.cross
    monkeypatch.setattr(packing, "cross", lambda *a: crossed.append(1) or cross(*a))
    best = packing.evolve(lengths, [], 1, 4096)
    check_packing(lengths, best, 4096)
    assert len(crossed) == packing.GENERATIONS and best.max() + 1 <= 0.96 * simple
    # No packing by size is better than what the population ends with.
    uneven = np.random.default_rng(count).integers(900, 2041, 600)
    simple = packing.best_fit(uneven, np.argsort(-uneven, kind="stable"), np.empty(600, np.int64), [], 4096)
    assert packing.evolve(uneven, [], 1, 4096).max() + 1 <= simple


def test_islands_go_on_from_migrants(spark, monkeypatch):
    monkeypatch.setattr(packing, "GENERATIONS", 30)
    lengths = triples(40, 4096, 3)
    items = spark.createDataFrame([(0, k, int(n)) for k, n in enumerate(lengths)], "shard long, row long, length long")
    placed = packing._islands(Scratch(spark), items, 4096).toPandas().sort_values("row")
    assert placed["row"].tolist() == list(range(120))
    check_packing(placed["length"].to_numpy(), placed["bin"].to_numpy(), 4096)
    bins = np.empty(120, np.int64)
    assert placed["bin"].nunique() <= 0.96 * packing.best_fit(lengths, np.argsort(-lengths, kind="stable"), bins, [], 4096)


def test_merging_by_rank_gives_the_ids_of_merging_by_pair():
    """Each token's last merge is the listed one, so that equal ranks are reached in the same way in any word."""
    with open(packing.default_tokenizer(), encoding="utf-8") as file:
        model = json.load(file)["model"]
    ranks = packing.ranks_of(model)
    assert len(ranks) == 512 + len(model["merges"])
    by_id = {rank: token for token, rank in ranks.items()}
    tokenizer = packing.WordTokenizer(packing.default_tokenizer())
    assert tokenizer.merge is not None
    suffix = model["end_of_word_suffix"]
    for i, merge in enumerate(model["merges"]):
        pair = merge.split(" ") if isinstance(merge, str) else merge
        parts = [bytes([b]) for b in by_id[512 + i]]
        if parts[-1] == b"\xff" and pair[1].endswith(suffix):
            parts[-2:] = [parts[-2] + parts[-1]]
        while len(parts) > 2:
            best = min(range(len(parts) - 1), key=lambda k: ranks.get(parts[k] + parts[k + 1], 1 << 30))
            assert ranks[parts[best] + parts[best + 1]] < 512 + i
            parts[best : best + 2] = [parts[best] + parts[best + 1]]
        assert [ranks[p] for p in parts] == [model["vocab"][p] for p in pair], merge


def test_words_equal_the_library(monkeypatch):
    monkeypatch.setattr(packing, "CACHE_WORDS", 50)
    tokenizer = packing.WordTokenizer(packing.default_tokenizer())
    r = random.Random(9)
    letters = "abcdefgstv'éÉñßÅǆǅİıſΣς汉😀0129²½-_.,;:!?¿¡«»—…<|>\u0301\u00a0\u2028\x1c\x85\u3000KÅ"
    words = ["".join(r.choice(letters) for _ in range(r.randrange(1, 14))) for _ in range(4000)]
    words += ["<|endoftext|>", "x<|startoftext|>y", "<|endoftext|", "don't", "'S", "ΟΔΟΣ", "ﬁne", "x" * 3000, "Ångström", "naïveté,"]
    plain = sum(tokenizer._plainly(w) is not None for w in words)
    assert 0 < plain < len(words)
    for word in words:
        whole = tokenizer.full.encode(word, add_special_tokens=False).ids
        assert np.frombuffer(tokenizer.word_bytes(word.encode()), "<u4").tolist() == whole, word
    text = " ".join(words)
    ids = np.frombuffer(tokenizer.token_bytes(text.encode()), "<u4").tolist()
    assert ids == [*tokenizer.full.encode(text, add_special_tokens=False).ids, packing.END] and len(tokenizer.known) <= 50
