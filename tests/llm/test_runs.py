from __future__ import annotations

import hashlib
import random
import re
import zlib

import numpy as np
import pytest

from tests.llm.helpers import documents, prose
from tickloom.llm import queries, runs

WORDS = "[^\x20\x09-\x0d]+"


def brute_force(words, least=6, exponent=4):
    """Every maximal stretch of every lag, without those of a shorter period."""
    n, out = len(words), set()
    for q in range(1, n // exponent + 1):
        i = 0
        while i + q < n:
            if words[i] != words[i + q]:
                i += 1
                continue
            j = i
            while j + q < n and words[j] == words[j + q]:
                j += 1
            stretch = words[i : j + q]
            if len(stretch) >= max(least, exponent * q) and not any(stretch[p:] == stretch[:-p] for p in range(1, q)):
                out.add((i, len(stretch), q))
            i = j
    return sorted(out, key=lambda x: (x[0], x[2]))


def repetitive(random_):
    words = []
    for _ in range(random_.randrange(9)):
        unit = [random_.choice("abc") for _ in range(random_.randrange(1, 14))]
        words += (unit * random_.randrange(1, 7))[: random_.randrange(1, 70)]
    return words


@pytest.mark.parametrize(("least", "exponent"), [(6, 4), (6, 3), (2, 3), (12, 4)])
def test_runs_equal_brute_force(least, exponent):
    r = random.Random(least)
    for _ in range(400):
        texts = [repetitive(r) for _ in range(r.randrange(1, 4))]
        numbers = np.array([ord(w) for t in texts for w in t], np.int64)
        found = runs.find(numbers, np.array([len(t) for t in texts]), least, exponent)
        assert [tuple(x) for x in found.tolist()] == [(i, *x) for i, t in enumerate(texts) for x in brute_force(t, least, exponent)]


def test_neighbours_alone_are_paired():
    # One word without end: pairs, extensions and memory stay in proportion.
    found = runs.find(np.zeros(200_000, np.int64), np.array([200_000]), 6, 4)
    assert found.tolist() == [[0, 0, 200_000, 1]]


def expected(key, text):
    words = re.findall(WORDS, text or "")
    n = len(words)
    if key is not None and n:
        h = zlib.crc32(str(key).encode())
        g = h // 10
        if h % 10 == 0:
            a = g % n
            p = 1 + (n - a) // (3 + g % 8)
            words = [w if i < a else words[a + (i - a) % p] for i, w in enumerate(words)]
    found = brute_force(words)
    dropped = {i for s, length, q in found for i in range(s + q, s + length)}
    best = min(found, key=lambda x: (-x[1], x[0], x[2]), default=None)
    sha = lambda s: hashlib.sha256(s.encode()).hexdigest()
    return (
        key, len(found), *((best[0], best[1], best[2], 1000 * best[1] // best[2]) if best else (None,) * 4),
        sha("".join(f"{s},{length},{q}\n" for s, length, q in found)), sha(" ".join(w for i, w in enumerate(words) if i not in dropped)),
    )


def test_query_equals_brute_force(spark, tmp_path):
    r = random.Random(2)
    texts = [" ".join(repetitive(r)) for _ in range(60)] + [" ".join(prose(r, r.randrange(1, 80))) for _ in range(200)]
    texts += [None, "", " \t\n", "one", "a a a a a a", "a\x0ba\x1ca a a a a", "é é é é é é x", "so so  so\nso so so so", " ".join(["x y z"] * 4000), " ".join(prose(r, 30_000))]
    rows = [*enumerate(texts), (3, texts[4]), (3, texts[4]), (None, texts[3]), (-5, texts[70])]
    documents(spark, rows).repartition(3).write.parquet(str(tmp_path / "documents.parquet"))
    found = [tuple(x) for x in queries.op11_periodic_runs(spark, str(tmp_path)).collect()]
    small = [row for row in rows if len(row[1] or "") < 5000]
    long_keys = {k for k, _ in rows} - {k for k, _ in small}
    assert sorted((x for x in found if x[0] not in long_keys), key=str) == sorted((expected(*x) for x in small), key=str)
    assert len(found) == len(rows) and sum(x[1] > 0 for x in found) > 30
    by = {x[0]: x for x in found}
    (key,) = (k for k, t in rows if t and t.startswith("x y z"))
    if zlib.crc32(str(key).encode()) % 10:
        assert by[key][1:6] == (1, 0, 12_000, 3, 4_000_000)


def test_other_columns_pass_and_results_replace(spark):
    df = documents(spark, [(1, "a b a b a b a b a b c"), (2, None), (2, "")]).withColumnRenamed("v", "runs").withColumnRenamed("part", "rest").withColumnRenamed("row", "results")
    out = runs.find_runs(df)
    assert {"doc_id", "rest", "results", "size", "batch"} <= set(out.columns) and out.columns.count("runs") == 1
    by = {(r["doc_id"], r["collapsed"]): r for r in out.collect()}
    assert by[1, "a b c"]["runs"][0].asDict() == {"start": 0, "length": 10, "period": 2} and by[1, "a b c"]["rest"] == "p"
    assert by[2, None]["n_words"] == 0 and by[2, None]["runs"] == [] and by[2, ""]["runs"] == []


def test_no_rows_and_wrong_parameters(spark):
    assert runs.find_runs(documents(spark, [])).collect() == []
    with pytest.raises(ValueError):
        runs.find_runs(documents(spark, []), exponent=2)
