from __future__ import annotations

import hashlib
import random
from collections import Counter, defaultdict
from functools import reduce
from urllib.parse import urlparse

import numpy as np
import pyarrow as pa
import pyarrow.parquet as pq
import pytest
from pyspark.sql import functions as F

from tests.llm.helpers import documents, prose
from tickloom.llm import align as A
from tickloom.session import Scratch

pytest.importorskip("public_tokenizers")


def by_the_libraries(text):
    """Token ids and bytes of either side by the plainest way."""
    from sentencepiece import SentencePieceProcessor
    from tokenizers import Tokenizer

    _, full, pieces = A.default_paths()
    if not hasattr(by_the_libraries, "known"):
        tokenizer = Tokenizer.from_file(full)
        tokenizer.encode_special_tokens = True
        shown = [*range(33, 127), *range(161, 173), *range(174, 256)]
        letters = {chr(b): b for b in shown} | {chr(256 + k): b for k, b in enumerate(b for b in range(256) if b not in shown)}
        by_the_libraries.known = tokenizer, SentencePieceProcessor(model_file=pieces), letters
    tokenizer, model, letters = by_the_libraries.known
    a = tokenizer.encode(" " + text, add_special_tokens=False).ids
    b = model.encode(text)
    bytes_a = [bytes(letters[c] for c in tokenizer.id_to_token(i)) for i in a]
    bytes_b = [bytes([int(model.id_to_piece(i)[3:5], 16)]) if model.is_byte(i) else model.id_to_piece(i).replace("▁", " ").encode() for i in b]
    return a, bytes_a, b, bytes_b


def brute_force(rows):
    links, written, sizes = [], [], []
    for _, text in rows:
        a, bytes_a, b, bytes_b = by_the_libraries(text) if text else ((), (), (), ())
        if not text or not (b"".join(bytes_a) == b"".join(bytes_b) == (" " + text).encode()):
            links.append([])
            written.append("")
            sizes.append((0, 0, 0))
            continue
        ends_a, ends_b = np.cumsum([len(x) for x in bytes_a]).tolist(), np.cumsum([len(x) for x in bytes_b]).tolist()
        groups, i, j = [], 0, 0
        for cut in sorted(set(ends_a) & set(ends_b)):
            p, q = ends_a.index(cut) + 1, ends_b.index(cut) + 1
            groups.append((a[i:p], b[j:q]))
            i, j = p, q
        own, j = [], 0
        for k, e in enumerate(ends_a):
            while ends_b[j] <= e - len(bytes_a[k]):
                j += 1
            m = j
            while m < len(b) and ends_b[m] - len(bytes_b[m]) < e:
                own.append((a[k], b[m]))
                m += 1
        links.append(own)
        written.append(";".join("|".join(",".join(map(str, side)) for side in g) for g in groups))
        sizes.append((len(a), len(b), len(groups)))
    counts = Counter(p for own in links for p in set(own))
    most = defaultdict(int)
    for (x, _), n in counts.items():
        most[x] = max(most[x], n)
    return sorted(
        (
            (key, *size, len(own), sum(counts[p] == most[p[0]] for p in own), sum(counts[p] for p in own), hashlib.sha256(w.encode()).hexdigest() if w else "")
            for (key, _), own, w, size in zip(rows, links, written, sizes, strict=True)
        ),
        key=str,
    )


SAMPLES = [
    "plain words, don't stop; it's 12345 times.", "  two leading spaces", "trailing  ", "\n\nlines\r\n\ttabs \x0b\n end\n\n", "¡Hola, señor! ¿Qué tal?", "naïve café über straße", "汉字 和 かな 😀😀 emoji",
    "<|endoftext|> <s> </s> <unk> <0x0A>", "a▁b ▁ c", "zero\x00byte", "é é combining", "x" * 300, " ", "　wide space", "A.B.C,1,2", "foo_bar__baz", "Ⅷ ² ½ 1²3",
]


def text_of(random_):
    out = []
    for _ in range(random_.randrange(1, 60)):
        out.append(random_.choice([*prose(random_, 1), random_.choice(SAMPLES), random_.choice([" ", "  ", "\n", ", ", ". ", "'s ", "1", "é"])]))
        out.append(random_.choice(["", " ", " ", " "]))
    return "".join(out)


@pytest.mark.parametrize("width", [1 << 16, 7])
def test_equal_to_brute_force_however_long_texts_are_cut(spark, monkeypatch, width):
    monkeypatch.setattr(A, "RANGE_CHARS", width)
    monkeypatch.setattr(A, "FAN", 3)
    monkeypatch.setattr(A, "BATCH_BYTES", 2000)
    r = random.Random(5)
    texts = [*SAMPLES, *(text_of(r) for _ in range(40)), None, "", "same words", "same words"]
    rows = [*enumerate(texts), (3, texts[0]), (None, texts[0])]
    df = documents(spark, rows).withColumnRenamed("v", "pair").withColumnRenamed("part", "key").withColumnRenamed("batch", "unit").repartition(3)
    found = [tuple(x) for x in A.align(Scratch(spark), df).select("doc_id", *A.MEASURES, "groups_sha256").collect()]
    assert sorted(found, key=str) == brute_force(rows)
    assert any(x[6] for x in found) and any(x[5] < x[4] for x in found)


def test_fragments_compose_in_any_order():
    tokens = A.Tokenizers(*A.default_paths())
    r = random.Random(7)
    for _ in range(60):
        text = " " + text_of(r) + r.choice(SAMPLES)
        a, b, same = tokens.encode(text, text)
        if not same:
            continue
        parts = []
        cuts = [sorted([0, n, *(r.randrange(n + 1) for _ in range(5))]) for n in (len(a), len(b))]
        ends = [np.concatenate(([0], np.cumsum(length[ids]))) for ids, length in ((a, tokens.length_a), (b, tokens.length_b))]
        a, b = np.array(a, A.IDS), np.array(b, A.IDS)
        for k in range(6):
            (p, q), (s, t) = cuts[0][k : k + 2], cuts[1][k : k + 2]
            parts.append(A.split(tokens, int(ends[0][p]), int(ends[1][s]), a[p:q], b[s:t]))

        def composed(x, y):
            (f, left), (g, right) = x, y
            both, between = A.join(tokens, f, g)
            return both, tuple(np.concatenate(side) for side in zip(left, between, right, strict=True))

        one = reduce(composed, parts)
        two = reduce(lambda x, y: composed(y, x), reversed(parts))
        three = composed(composed(composed(parts[0], parts[1]), composed(parts[2], parts[3])), composed(parts[4], parts[5]))
        for whole, closed in (one, two, three):
            assert whole.cut == ends[0][-1] and not len(whole.prefix_a) and not len(whole.suffix_b)
            assert np.array_equal(closed[0], a) and np.array_equal(closed[1], b)


def test_ranges_are_cut_where_no_token_crosses():
    tokens = A.Tokenizers(*A.default_paths())
    r = random.Random(3)
    for _ in range(60):
        text = " " + text_of(r)
        for edge, whole, encode in (
            (A._EDGE_A, tokens.encode_a(text), tokens.encode_a),
            (A._EDGE_B, tokens.pieces.encode(text[1:]), lambda p: tokens.pieces.encode(p[1:]) if p else []),
        ):
            at = A.edges(text, edge, 11)
            assert [i for p, q in zip(at[:-1], at[1:], strict=True) for i in encode(text[p:q])] == whole


def test_white_space_without_end_and_long_strings():
    tokens = A.Tokenizers(*A.default_paths())
    assert tokens.encode_a(" a" + " " * 6000 + "b") == by_the_libraries("a" + " " * 6000 + "b")[0]
    assert A.edges("x" * 100, A._EDGE_A, 7)[-2:] == [100, 100]


def test_no_rows(spark):
    assert A.align(Scratch(spark), documents(spark, [])).collect() == []


def unit_of(tokens, texts):
    sides = list(zip(*(tokens.encode(f" {t}", f" {t}")[:2] if t else ((), ()) for t in texts), strict=True))
    sizes = [np.array([len(x) for x in side], np.int64) for side in sides]
    ids = [np.concatenate([np.array(x, A.IDS) for x in side]) for side in sides]
    cells = {f"n_{c}": pa.array([n.tobytes()], pa.binary()) for c, n in zip("ab", sizes, strict=True)}
    cells |= {f"ids_{c}": pa.array([A._packed(x)], pa.binary()) for c, x in zip("ab", ids, strict=True)}
    return pa.table(cells), A.Aligned(tokens, ids[0], sizes[0], ids[1], sizes[1])


def test_a_batch_is_aligned_a_piece_at_a_time(monkeypatch):
    monkeypatch.setattr(A, "PIECE_TOKENS", 50)
    tokens, r = A.Tokenizers(*A.default_paths()), random.Random(9)
    texts = ["", *(" ".join(prose(r, r.randrange(1, 12), 40)) for _ in range(60)), "", " ".join(prose(r, 90)), ""]
    unit, whole = unit_of(tokens, texts)
    pieces = list(A._pieces(unit, tokens))
    assert all(len(p.a) <= 50 or len(p.n_a) == 1 for p in pieces) and max(len(p.a) for p in pieces) > 50
    assert [w for p in pieces for w in p.written()] == whole.written()
    assert np.array_equal(np.concatenate([p.links() for p in pieces]), whole.links())
    assert all(map(np.array_equal, A.distinct_links(pieces), whole.distinct_links()))


def test_stored_batches_are_read_one_by_one(spark, monkeypatch):
    monkeypatch.setattr(A, "BATCH_BYTES", 64 << 10)
    monkeypatch.setitem(A._STORED, "parquet.block.size", str(64 << 10))
    r = random.Random(11)
    rows = [(i, " ".join(prose(r, 300))) for i in range(800)]
    units = A._short_units(Scratch(spark), documents(spark, rows).select(F.col("doc_id").alias("key"), "text").coalesce(1), A.default_paths())
    (file,) = units.inputFiles()
    meta = pq.read_metadata(urlparse(file).path)
    assert meta.num_rows > 8 and max(meta.row_group(i).num_rows for i in range(meta.num_row_groups)) <= 3
    assert meta.row_group(0).total_byte_size < 192 << 10
    assert sorted(k for x in units.select("keys").collect() for k in x.keys) == list(range(800))
