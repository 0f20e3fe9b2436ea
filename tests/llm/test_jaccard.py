from __future__ import annotations

import random
import re

import numpy as np
import pytest

from tests.llm.helpers import documents, lower, prose
from tickloom.llm import jaccard
from tickloom.session import Scratch


def shingles(text, size):
    x = re.findall(r"[^\x20\x09-\x0d]+", lower(text or ""))
    return {tuple(x[i : i + size]) for i in range(len(x) - size + 1)} if len(x) >= size else ({tuple(x)} if x else set())


def expected(rows, size, percent):
    sets = [shingles(t, size) for _, t in rows]
    root = list(range(len(rows)))

    def find(i):
        while root[i] != i:
            i = root[i]
        return i

    for i, a in enumerate(sets):
        for j in range(i):
            b = sets[j]
            if a and b and 100 * len(a & b) >= percent * len(a | b):
                root[find(i)] = find(j)
    least = {}
    for i, (key, _) in enumerate(rows):
        if key is not None:
            least[find(i)] = min(key, least.get(find(i), key))
    return sorted([(rows[i][0], len(sets[i]), least.get(find(i)) if sets[i] else rows[i][0]) for i in range(len(rows))], key=str)


def cases():
    r = random.Random(5)
    rows = [(i, " ".join(prose(r, r.randrange(1, 60)))) for i in range(30)]
    # Copies with changes, of every size on both sides of any boundary.
    for n in list(range(1, 48)) + [90, 150, 400]:
        base = prose(r, n)
        for k in range(4):
            x = list(base)
            for _ in range(k * n // 60):
                x[r.randrange(n)] = f"new{r.random()}"
            rows.append((1000 + 10 * n + k, " ".join(x + prose(r, k) if k == 3 else x)))
    # A large group of near copies, many of which link only through others.
    base = prose(r, 120)
    for k in range(40):
        x = list(base)
        for _ in range(r.randrange(0, 4)):
            x[r.randrange(120)] = f"other{r.random()}"
        rows.append((5000 + k, " ".join(x)))
    rows += [(1, None), (2, ""), (3, " \n"), (4, "One"), (5, "one"), (6, "one two"), (7, "ONE\ttwo"), (8, "É x y"), (9, "é x y")]
    rows += [(6000, rows[40][1]), (6000, rows[40][1]), (None, rows[40][1]), (None, "alone without key"), (None, None)]
    return rows


@pytest.mark.parametrize(("size", "percent"), [(3, 90), (5, 80)])
def test_equal_to_brute_force(spark, size, percent):
    rows = cases()
    _, out = jaccard.similar_groups(Scratch(spark), documents(spark, rows), size=size, percent=percent)
    assert sorted(map(tuple, out.select("doc_id", "n_shingles", "component_id").collect()), key=str) == expected(rows, size, percent)


@pytest.mark.parametrize("boundary", [0, 12, 30])
def test_every_boundary_gives_the_same(spark, monkeypatch, boundary):
    monkeypatch.setattr(jaccard, "choose_boundary", lambda *_: boundary)
    monkeypatch.setattr(jaccard, "TILE", 7)
    rows = [x for x in cases() if x[1] and (len(x[1].split()) < 36 or x[0] and x[0] >= 5000)]
    _, out = jaccard.similar_groups(Scratch(spark), documents(spark, rows), size=3, percent=90)
    assert sorted(map(tuple, out.select("doc_id", "n_shingles", "component_id").collect()), key=str) == expected(rows, 3, 90)


def test_one_of_each_group_stays_whole(spark):
    rows = [(3, "a b c d e f g"), (2, "A b c d e f g"), (9, "something else here"), (None, "a b c d e f g"), (4, None)]
    kept = jaccard.keep_first(Scratch(spark), documents(spark, rows))
    assert kept.columns == documents(spark, rows).columns
    assert sorted(map(tuple, kept.select("doc_id", "text").collect()), key=str) == [(2, rows[1][1]), (4, None), (9, rows[2][1])]


def test_no_rows(spark):
    assert jaccard.similar_groups(Scratch(spark), documents(spark, []))[1].collect() == []


def test_boundary_weighs_subsets_against_scans():
    assert jaccard.choose_boundary([(12, 5, 1000)], 90) > 12
    assert jaccard.choose_boundary([(39, 100, 200)], 90) < 39
    assert jaccard.choose_boundary([], 90) == 0


def test_overlaps_in_parts():
    r = np.random.default_rng(1)
    sets = [np.unique(r.integers(0, 60, k).astype(np.uint64)) for k in (5, 20, 40, 40, 1)]
    found = jaccard.overlaps(sets, width=7)
    assert found.tolist() == [[len(np.intersect1d(a, b)) for b in sets] for a in sets]
