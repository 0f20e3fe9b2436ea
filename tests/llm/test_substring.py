from __future__ import annotations

import hashlib
import random
import re
from collections import Counter

import pytest

from tests.llm.helpers import documents, prose
from tickloom.llm import corpus, substring
from tickloom.session import Scratch


def expected(rows, size):
    split = [re.findall(r"[^\x20\x09-\x0d]+", t or "") for _, t in rows]
    seen = Counter(tuple(x[i : i + size]) for x in split for i in range(len(x) - size + 1))
    out = []
    for (key, text), x in zip(rows, split, strict=True):
        gone = {k for i in range(len(x) - size + 1) if seen[tuple(x[i : i + size])] > 1 for k in range(i, i + size)}
        kept = " ".join(y for i, y in enumerate(x) if i not in gone)
        out.append((key, None if text is None else kept, len(x), len(gone), hashlib.sha256(kept.encode()).hexdigest()))
    return sorted(out, key=str)


def found(spark, rows, size):
    out = substring.remove_repeats(Scratch(spark), documents(spark, rows), size=size)
    assert {"lang", "size", "row", "batch"} <= set(out.columns)
    return sorted(map(tuple, out.select("doc_id", "text", "n_words", "n_removed", "kept_sha256").collect()), key=str)


def cases():
    r = random.Random(3)
    passage, other = prose(r, 60), prose(r, 35)
    rows = [(i, " ".join(prose(r, r.randrange(3, 120)))) for i in range(20)]
    rows += [(100 + i, " ".join(prose(r, i) + passage[i % 20 :] + prose(r, 10))) for i in range(30)]
    rows += [(200, " ".join(other + prose(r, 3) + other)), (201, "  ".join(other[:-1])), (None, "\t".join(other))]
    rows += [(300, None), (301, ""), (302, " \n "), (303, "Ünï cödé x  y"), (304, "a " * 400), (305, "a\n" * 3000)]
    rows += [(400, " ".join(passage)), (400, " ".join(passage)), (401, " ".join(x.upper() for x in passage))]
    return rows


@pytest.mark.parametrize("size", [35, 8, 1])
def test_equal_to_brute_force(spark, size):
    rows = cases()
    assert found(spark, rows, size) == expected(rows, size)


def test_small_batches_and_ranges(spark, monkeypatch):
    monkeypatch.setattr(corpus, "BATCH_BYTES", 600)
    monkeypatch.setattr(corpus, "RANGE_ROWS", 50)
    rows = cases()
    assert found(spark, rows, 35) == expected(rows, 35)


def test_no_rows(spark):
    assert found(spark, [], 35) == []
