from __future__ import annotations

import math
import random
import re
import zlib
from collections import Counter

import numpy as np

from tests.llm.helpers import documents, prose
from tickloom.llm import toxicity
from tickloom.session import Scratch

BAD = ["idiotic", "scumbag", "worthless"]


def corpus(n=700):
    r = random.Random(6)
    rows, labels = [], []
    for i in range(n):
        words = prose(r, r.randrange(5, 80), 300)
        toxic = i % 5 == 0
        if toxic:
            for w in BAD:
                words.insert(r.randrange(len(words)), w)
        rows.append((i, " ".join(words)))
        labels.append((i, 1, int(toxic)))
    return rows, labels


def test_held_out_texts_are_told_apart_and_labels_are_no_input(spark):
    rows, labels = corpus()
    rows += [(5000, None), (5001, ""), (None, "you idiotic worthless scumbag"), (5002, "IDIOTIC\n\nscumbag " + "word " * 20000)]
    labels += [(1, 1, None), (None, 1, 1), (5, 1, 0), (9999, 1, 1)]
    df = documents(spark, rows)
    given = spark.createDataFrame(labels, "doc_id long, quality int, toxic int")
    model = toxicity.fit(Scratch(spark), df, given)
    scored = toxicity.score(df, model).withColumn("held_out", toxicity.held_out("doc_id"))
    found = {r["doc_id"]: r for r in scored.collect()}
    assert len(found) == len(rows) and set(df.columns) < set(scored.columns)
    assert all(0 <= r["score"] <= 1 and r["predicted"] == (r["score"] >= 0.5) for r in found.values())
    held = [k for k in range(700) if zlib.crc32(str(k).encode()) % 5 == 0]
    assert [k for k in found if k is not None and found[k]["held_out"]] == [k for k in found if k is not None and zlib.crc32(str(k).encode()) % 5 == 0]
    right = sum(found[k]["predicted"] == (k % 5 == 0) for k in held)
    assert right >= 0.97 * len(held)
    assert found[None]["predicted"] == 1 and found[5002]["predicted"] == 1
    assert found[5000]["score"] == found[5001]["score"] < 0.5
    # Labels of held-out rows change nothing.
    turned = spark.createDataFrame([(k, q, t if k is None or t is None or zlib.crc32(str(k).encode()) % 5 else 1 - t) for k, q, t in labels], given.schema)
    other = toxicity.fit(Scratch(spark), df, turned)
    assert other.known.keys.tolist() == model.known.keys.tolist() and abs(other.weights - model.weights).max() < 1e-6


def test_training_sample_is_bounded(spark, monkeypatch):
    rows, labels = corpus()
    monkeypatch.setattr(toxicity, "TRAINING_ROWS", 50)
    given = spark.createDataFrame(labels, "doc_id long, quality int, toxic int")
    training, shares = toxicity.training_rows(Scratch(spark), documents(spark, rows), given, ~toxicity.held_out("key"), "doc_id", "text", "toxic")
    counts = dict(training.groupBy("label").count().collect())
    assert 20 <= counts[0] <= 90 and 20 <= counts[1] <= 90 and shares[0] > shares[1] > 1


def test_without_labels_or_rows(spark):
    df = documents(spark, [(1, "a b"), (2, None)])
    model = toxicity.fit(Scratch(spark), df, spark.createDataFrame([], "doc_id long, quality int, toxic int"))
    assert toxicity.score(df, model).count() == 2
    assert toxicity.score(documents(spark, []), model).collect() == []


def spelled(text):
    """N-grams as strings, with the places at which they begin, by the plainest way."""
    plain = re.sub("[ \t\n\x0b\x0c\r]+", " ", f" {text} ")
    plain = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in plain)
    return [(plain[i : i + n], i) for n in toxicity.SIZES for i in range(len(plain) - n + 1)], len(plain)


def test_blocks_hold_the_ngrams_of_the_whole_text():
    for length in (0, 1, toxicity.BLOCK - 3, toxicity.BLOCK - 2, toxicity.BLOCK, 2 * toxicity.BLOCK + 5):
        text = "".join(chr(97 + i * i % 23) for i in range(length))
        whole = toxicity.ngrams(text)
        blocks = [(int(k), at + int(b)) for at, g in toxicity._blocks(text) for k, b in zip(g.keys, g.begins, strict=True)]
        assert sorted(blocks) == sorted(zip(whole.keys.tolist(), whole.begins.tolist(), strict=True))


def test_ngrams_are_of_characters():
    r = random.Random(1)
    texts = ["Abc  abc\tABC", "é́ 汉字 😀😀 x", "", " ", "a\x0bb\x1cc", "".join(r.choice("abAB é汉\n😀") for _ in range(3000))]
    names: dict[int, str] = {}
    for text in texts:
        grams, length = spelled(text)
        found = toxicity.ngrams(text)
        assert found.length == length and found.begins.tolist() == [i for _, i in grams]
        for (gram, _), key in zip(grams, found.keys.tolist(), strict=True):
            assert names.setdefault(key, gram) == gram


def test_features_weights_and_scores_equal_the_plainest_way(spark, monkeypatch):
    monkeypatch.setattr(toxicity, "SEGMENT", 300)
    rows, labels = corpus(300)
    toxic = {k: t for k, _, t in labels}
    training = spark.createDataFrame([(toxic[k], t) for k, t in rows], "label int, text string")
    model = toxicity.train(Scratch(spark), training)
    sizes = [sum(v == c for v in toxic.values()) for c in (0, 1)]
    counts = Counter((g, toxic[k]) for k, t in rows for g in {g for g, _ in spelled(t)[0]})

    def gain(gram):
        seen = [counts[gram, c] for c in (0, 1)]
        cells = [(seen[c], sum(seen) * sizes[c] / sum(sizes)) for c in (0, 1)] + [(sizes[c] - seen[c], (sum(sizes) - sum(seen)) * sizes[c] / sum(sizes)) for c in (0, 1)]
        return sum(o * math.log(o / e) for o, e in cells if o)

    telling = {g for g, _ in counts if gain(g) >= toxicity.LEAST_GAIN}
    by_key = {int(k): g for t in (t for _, t in rows) for k, (g, _) in zip(toxicity.ngrams(t).keys, spelled(t)[0], strict=True)}
    chosen = {by_key[k] for k in model.known.keys.tolist()}
    # Others that share a hash's upper bits can hide what is barely telling, nothing more.
    assert chosen <= telling and max((gain(g) for g in telling - chosen), default=0) < 2 * toxicity.LEAST_GAIN and len(chosen) > 30
    weight = {by_key[k]: w for k, w in zip(model.known.keys.tolist(), model.weights, strict=True)}
    long_ = " ".join(t for _, t in rows[:40])
    for text in [*(t for _, t in rows[:30]), "", long_]:
        grams, length = spelled(text)
        odds = [math.exp(model.intercept + sum(weight[g] for g in {g for g, i in grams if i // 300 == s and g in weight})) for s in range(-(-length // 300))]
        assert math.isclose(model.log_odds(text), math.log(sum(odds) / math.sqrt(len(odds))), rel_tol=1e-9, abs_tol=1e-9)


def test_long_clean_texts_stay_and_long_toxic_ones_are_found(spark):
    rows, labels = corpus(1500)
    given = spark.createDataFrame(labels, "doc_id long, quality int, toxic int")
    model = toxicity.fit(Scratch(spark), documents(spark, rows), given)
    by = {c: [t for k, t in rows if (k % 5 == 0) == c] for c in (False, True)}
    r = random.Random(4)
    for size in (20_000, 100_000, 300_000, 1_000_000):
        for bad, least, most in ((False, 0, 0.05), (True, 0.9, 1)):
            joined = []
            for _ in range(20):
                parts = [r.choice(by[bad]) for _ in range(200)]
                joined.append(" ".join(parts * -(-size // sum(map(len, parts)))))
            assert least <= sum(model.log_odds(t) >= 0 for t in joined) / 20 <= most, (size, bad)


def test_presence_of_hashes():
    a, b = (next(toxicity._presence([t])) for t in ("Abc  abc\tabc", "abc abc abc"))
    assert a.tolist() == b.tolist()
    long_ = next(toxicity._presence(["xy z " * 9000]))
    assert long_.tolist() == next(toxicity._presence(["xy z " * 9])).tolist()


def test_clashing_names(spark):
    model = toxicity.Model(np.empty(0, np.uint32), np.empty(0), 1.0)
    df = documents(spark, [(1, "a")]).withColumnRenamed("v", "text to score").withColumnRenamed("part", "rest").withColumnRenamed("row", "results").withColumnRenamed("size", "score")
    out = toxicity.score(df, model)
    assert {"text to score", "rest", "results", "text"} <= set(out.columns) and out.columns.count("score") == 1 and out.first()["predicted"] == 1
