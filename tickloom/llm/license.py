"""Licence scan with a positional index of rare words.

Templates are texts, grants and headers of public licences.  Their words are weighted by
how rare they are in the corpus, counted over all texts.  Each template posts its rarest places (word to template and position), as many as
make up half of its weight.  A file's licence words are taken from the rarest on; templates whose posted weight they cannot reach, or whose key phrases
they cannot make up, are out.  For the others the file's places and the postings are intersected by relative position: places that agree on where the
template begins add their weights, and only a placement that has what a score of 0.8 cannot do without is looked at whole.  So nothing is
missed: what a placement may lack of all weight, it may lack of the posted weight at most.  A placement's score is the weighted share of the template's words found in place.  A
label also needs its mandatory key phrases within the placement, and none of them may go on as a longer
phrase of another label ("CC BY-NC" is no CC BY).  Short notices and identifiers are templates
that are key phrases as a whole.  Base labels come from their phrases' words standing in a row, anywhere in the text.
"""

from __future__ import annotations

import re
from collections import defaultdict
from collections.abc import Iterator, Sequence
from itertools import product

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tickloom.llm.license_texts import LICENSE_TEXTS
from tickloom.llm.words import LETTERS, fingerprints, spans

#: Phrases of the base labels.
BASE_PHRASES = (("mit license", "mit"), ("apache license", "apache"), ("general public license", "gpl"))
#: Label, text and mandatory key phrases of each template.
LONG_TEMPLATES = (
    ("mit", "released under the mit license", ("mit license",)),
    ("mit", "licensed under the mit license", ("mit license",)),
    ("mit", "permission is hereby granted free of charge to any person obtaining a copy of this software", ("permission is hereby granted", "free of charge")),
    ("apache", "licensed under the apache license version 2 0", ("apache license",)),
    ("apache", "you may not use this file except in compliance with the license", ("except in compliance with the license",)),
    ("gpl", "this work is licensed under the gnu general public license version 3", ("general public license",)),
    ("gpl", "under the terms of the gnu general public license as published by the free software foundation", ("general public license",)),
    ("lgpl", "under the terms of the gnu lesser general public license as published by the free software foundation", ("lesser general public license",)),
    ("agpl", "under the terms of the gnu affero general public license as published by the free software foundation", ("affero general public license",)),
    ("bsd", "redistribution and use in source and binary forms with or without modification are permitted", ("redistribution and use in source and binary forms",)),
    ("isc", "permission to use copy modify and or distribute this software for any purpose with or without fee is hereby granted", ("with or without fee is hereby granted",)),
    ("mpl", "this source code form is subject to the terms of the mozilla public license", ("mozilla public license",)),
    ("cc-by", "this work is licensed under a creative commons attribution license", ("creative commons attribution",)),
    ("cc0", "to the extent possible under law has waived all copyright and related rights to this work", ("waived all copyright and related rights",)),
    ("unlicense", "this is free and unencumbered software released into the public domain", ("unencumbered software released into the public domain",)),
)
#: Identifiers of the SPDX list by label; those in the first table are clear without a context.
SPDX_CLEAR = {
    "apache": ("apache 1 1", "apache 2 0"),
    "gpl": ("gpl 1 0", "gpl 2 0", "gpl 3 0"),
    "lgpl": ("lgpl 2 0", "lgpl 2 1", "lgpl 3 0"),
    "agpl": ("agpl 1 0", "agpl 3 0"),
    "bsd": ("bsd 1 clause", "bsd 2 clause", "bsd 3 clause", "bsd 4 clause"),
    "mpl": ("mpl 1 0", "mpl 1 1", "mpl 2 0"),
    "epl": ("epl 1 0", "epl 2 0"),
    "eupl": ("eupl 1 1", "eupl 1 2"),
    "cddl": ("cddl 1 0", "cddl 1 1"),
    "odbl": ("odbl 1 0",),
    "cc0": ("cc0 1 0",),
}
SPDX_OTHER = {"mit": ("mit",), "mit-0": ("mit 0",), "isc": ("isc",), "0bsd": ("0bsd",), "unlicense": ("unlicense",), "zlib": ("zlib",), "bsl": ("bsl 1 0",), "artistic": ("artistic 1 0", "artistic 2 0"), "ofl": ("ofl 1 1",), "wtfpl": ("wtfpl",)}
#: Names of licences as short notices have them.
NAMES = {
    "mit": ("mit licence", "mit licensed", "licensed under mit", "licensed under the mit", "mit or apache 2 0", "apache 2 0 or mit"),
    "apache": ("apache licence", "licensed under apache", "apache v2"),
    "gpl": ("general public licence", "gnu gpl", "gplv2", "gplv3", "gpl v2", "gpl v3"),
    "lgpl": ("lesser general public license", "lesser general public licence", "gnu lgpl", "lgplv2", "lgplv3", "lgpl v2", "lgpl v3"),
    "agpl": ("affero general public license", "affero general public licence", "gnu agpl", "agplv3", "agpl v3"),
    "bsd": ("bsd license", "bsd licence", "1 clause bsd", "2 clause bsd", "3 clause bsd", "4 clause bsd"),
    "isc": ("isc license", "isc licence"),
    "0bsd": ("bsd zero clause", "zero clause bsd"),
    "mpl": ("mozilla public license", "mozilla public licence"),
    "epl": ("eclipse public license", "eclipse public licence"),
    "eupl": ("european union public license", "european union public licence"),
    "cddl": ("common development and distribution license",),
    "odbl": ("open database license", "open database licence"),
    "bsl": ("boost software license", "boost software licence"),
    "zlib": ("zlib license", "zlib licence"),
    "artistic": ("artistic license 1 0", "artistic license 2 0"),
    "ofl": ("sil open font license", "sil open font licence"),
    "cc0": ("under cc0", "cc0 license", "cc0 licence", "cc0 public domain dedication", "creativecommons org publicdomain zero"),
}
#: How each Creative Commons element is written, and the licences that they form.
CC_ELEMENTS = {"nc": ("noncommercial", "non commercial"), "sa": ("sharealike", "share alike"), "nd": ("noderivatives", "no derivatives", "noderivs", "no derivs")}
CC_KINDS = ((), ("sa",), ("nd",), ("nc",), ("nc", "sa"), ("nc", "nd"))
CC_VERSIONS = ("1 0", "2 0", "2 5", "3 0", "4 0")


def _short_notices() -> list[tuple[str, str]]:
    """Labels and phrases of short notices."""
    notices = [(label, p) for table in (SPDX_CLEAR, NAMES) for label, phrases in table.items() for p in phrases]
    notices += [(label, f"spdx license identifier {p}") for table in (SPDX_CLEAR, SPDX_OTHER) for label, phrases in table.items() for p in phrases]
    for kind in CC_KINDS:
        label, short = "-".join(("cc-by", *kind)), " ".join(("cc by", *kind))
        names = [" ".join(("creative commons attribution", *n)) for n in product(*(CC_ELEMENTS[e] for e in kind))]
        notices.append((label, " ".join(("creativecommons org licenses by", *kind))))
        # "cc by" alone can be anything, so it needs a version or a context; the longer kinds have both too, for their key phrases to go on from those.
        notices += [(label, f"{before} {x}") for x in (short, *names) for before in ("under", "under a", "under the", "license", "licence")]
        notices += [(label, f"{x} {after}") for x in (short, *names) for after in (*CC_VERSIONS, "license", "licence", "international")]
        if kind:
            notices += [(label, x) for x in (short, *names)]
    return list(dict.fromkeys(notices))


#: Label, text and mandatory key phrases of every template.
TEMPLATES = (
    *((label, " ".join(re.findall("[a-z0-9]+", text)), phrases) for label, text, phrases in LICENSE_TEXTS),
    *LONG_TEMPLATES,
    *((label, p, (p,)) for label, p in _short_notices()),
)
#: A placement counts from this weighted share of its template's words.
LEAST_SCORE = 0.8
#: Share of a template's weight that its postings make up.
POSTED_SHARE = 0.5
#: Above the rounding of sums of weights.
_SLACK = 1e-9


def _prints(words: list[str]) -> np.ndarray:
    raw = " ".join(words).encode()
    data = np.frombuffer(raw, np.uint8)
    return fingerprints(data, *spans(data, LETTERS))


class Index:
    """Templates by word: postings, weights, phrases."""

    def __init__(self, idf: dict[str, float], templates: Sequence[tuple[str, str, Sequence[str]]] = TEMPLATES):
        self.words = sorted({w for _, text, phrases in templates for x in (text, *phrases) for w in x.split()} | {w for p, _ in BASE_PHRASES for w in p.split()})
        self.number = {w: i for i, w in enumerate(self.words)}
        prints = _prints(self.words)
        self.order = np.argsort(prints)
        self.prints = prints[self.order]
        #: A first test of fingerprints by 16 of their bits.
        self.screen = np.zeros(1 << 16, bool)
        self.screen[(self.prints >> np.uint64(48)).astype(np.int64)] = True
        self.weight = np.array([idf.get(w, 1.0) for w in self.words])
        self.labels = [label for label, _, _ in templates]
        self.templates = [np.array([self.number[w] for w in text.split()]) for _, text, _ in templates]
        self.totals = [float(self.weight[t].sum()) for t in self.templates]
        self.phrases = [[[self.number[w] for w in p.split()] for p in phrases] for _, _, phrases in templates]
        #: By label and phrase, how phrases of other labels go on from it.
        self.longer: dict[tuple[str, tuple[int, ...]], list[list[int]]] = defaultdict(list)
        starts: dict[tuple[int, ...], set[str]] = defaultdict(set)
        for label, phrases in zip(self.labels, self.phrases, strict=True):
            for p in phrases:
                starts[tuple(p)].add(label)
        for p, others in starts.items():
            for k in range(1, len(p)):
                for label in starts.get(p[:k], set()) - others:
                    self.longer[label, p[:k]].append(list(p[k:]))
        self.base = [([self.number[w] for w in p.split()], label) for p, label in BASE_PHRASES]
        self.postings: dict[int, list[tuple[int, int]]] = defaultdict(list)
        #: By template, the weight that a placement must have at the posted places, and the words that its key phrases are of.
        self.needed: list[float] = []
        self.mandatory = [{w for p in phrases for w in p} for phrases in self.phrases]
        for t, words in enumerate(self.templates):
            weight = self.weight[words]
            order = sorted(range(len(words)), key=lambda i: (-weight[i], self.words[words[i]], i))
            posted, may_lack = 0.0, (1 - LEAST_SCORE) * self.totals[t]
            # Where all words are mandatory, a placement may lack none, so the rarest is enough.
            whole = words.tolist() in self.phrases[t]
            for i in order:
                self.postings[int(words[i])].append((t, i))
                posted += float(weight[i])
                if whole or posted >= POSTED_SHARE * self.totals[t]:
                    break
            self.needed.append((posted if whole else posted - may_lack) - _SLACK * self.totals[t])

    def find(self, prints: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Positions and numbers of the licence words among fingerprints."""
        at = np.flatnonzero(self.screen[(prints >> np.uint64(48)).astype(np.int64)])
        place = np.minimum(np.searchsorted(self.prints, prints[at]), len(self.prints) - 1)
        hit = self.prints[place] == prints[at]
        return at[hit], self.order[place[hit]]

    def _stands(self, where: dict[int, int], label: str, phrase: list[int], at: int) -> bool:
        """Whether a key phrase of a label stands at a place, and not as the beginning of another label's."""
        if any(where.get(at + j) != w for j, w in enumerate(phrase)):
            return False
        end = at + len(phrase)
        return not any(all(where.get(end + j) == w for j, w in enumerate(rest)) for rest in self.longer.get((label, tuple(phrase)), ()))

    def _placements(self, at: dict[int, list[int]]) -> Iterator[tuple[int, int]]:
        """Templates and where they begin, as far as the votes of a file's words, given by their places, leave them possible."""
        rarest = sorted((w for w in at if w in self.postings), key=lambda w: (-self.weight[w], self.words[w]))
        reach: dict[int, float] = defaultdict(float)
        for w in rarest:
            for t, _ in self.postings[w]:
                reach[t] += float(self.weight[w])
        likely = {t for t, r in reach.items() if r >= self.needed[t] and all(w in at for w in self.mandatory[t])}
        votes: dict[tuple[int, int], float] = defaultdict(float)
        for w in rarest:
            posted = [x for x in self.postings[w] if x[0] in likely]
            for p in at[w] if posted else ():
                for t, position in posted:
                    votes[t, p - position] += float(self.weight[w])
        return (x for x, v in votes.items() if v >= self.needed[x[0]])

    def scan(self, positions: np.ndarray, numbers: np.ndarray) -> dict:
        """Base places and labels, and the method's labels and best score, of one text's licence words."""
        where = dict(zip(positions.tolist(), numbers.tolist(), strict=True))
        base: list[tuple[int, str]] = []
        for phrase, label in self.base:
            base += [(p, label) for p, w in where.items() if w == phrase[0] and all(where.get(p + k) == v for k, v in enumerate(phrase))]
        at: dict[int, list[int]] = defaultdict(list)
        for p, w in where.items():
            at[w].append(p)
        labels, best = set(), 0.0
        for t, shift in self._placements(at):
            words = self.templates[t].tolist()
            found = [where.get(shift + k) == w for k, w in enumerate(words)]
            score = min(1.0, float(self.weight[self.templates[t]][found].sum()) / self.totals[t])
            if score < LEAST_SCORE - _SLACK:
                continue
            if all(any(self._stands(where, self.labels[t], p, shift + k) for k in range(len(words) - len(p) + 1)) for p in self.phrases[t]):
                labels.add(self.labels[t])
                best = max(best, score)
        return {"base": base, "labels": labels, "score": max(best, 1.0 if base else 0.0) if not labels else best}


def _texts(values: list[bytes | None]) -> tuple[np.ndarray, np.ndarray]:
    """Lower-cased texts in one buffer with a newline between neighbours, and where each begins."""
    raw = b"\n".join((v or b"").lower() for v in values)
    begins = np.concatenate(([0], np.cumsum(np.array([len(v or b"") + 1 for v in values], np.int64))))
    return np.frombuffer(raw, np.uint8), begins


def _slices(values: list[bytes | None], most: int = 4 << 20) -> Iterator[list[bytes | None]]:
    """Runs of texts of bounded size together."""
    held, size = [], 0
    for v in values:
        held.append(v)
        size += len(v or b"")
        if size >= most:
            yield held
            held, size = [], 0
    if held:
        yield held


def word_frequencies(df: DataFrame, text: str, templates: Sequence[tuple[str, str, Sequence[str]]] = TEMPLATES) -> dict[str, float]:
    """Inverse document frequencies of the licence words over all texts.

    Each task counts into as many numbers as there are licence words, so what is summed is of fixed size.
    """
    plain = Index({}, templates)

    def run(parts: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counts, texts = np.zeros(len(plain.words), np.int64), 0
        for part in parts:
            for values in _slices(part.column("text").to_pylist()):
                data, begins = _texts(values)
                starts, ends = spans(data, LETTERS)
                at, numbers = plain.find(fingerprints(data, starts, ends))
                of = np.searchsorted(begins, starts[at], "right")
                pairs = np.unique(of * len(plain.words) + numbers)
                counts += np.bincount(pairs % len(plain.words), minlength=len(plain.words))
                texts += len(values)
        yield pa.RecordBatch.from_arrays([pa.array(np.arange(len(counts) + 1)), pa.array(np.append(counts, texts))], ["word", "texts"])

    rows = df.select(F.col(f"`{text}`").cast("binary").alias("text")).mapInArrow(run, "word long, texts long").groupBy("word").agg(F.sum("texts").alias("texts")).collect()
    known = {r["word"]: r["texts"] for r in rows}
    total = known.get(len(plain.words), 0)
    return {w: float(np.log((1 + total) / (1 + known.get(i, 0))) + 1) for i, w in enumerate(plain.words)}


def scan_licenses(df: DataFrame, text: str = "text", templates: Sequence[tuple[str, str, Sequence[str]]] = TEMPLATES) -> DataFrame:
    """``df`` without its text, with ``n_words``, ``n_base`` (places of base phrases), ``first_word`` and ``last_word``
    (their smallest and largest start), ``base_labels``, ``labels`` and ``score``.

    Words are runs of ASCII letters and digits and of everything beyond ASCII, A-Z as a-z.  Null and empty texts have none; labels are then
    empty strings and the score 0.  The score is the best placement's weighted share of a template; with base places but no placement it is 1,
    as phrases stand whole.  ``templates`` have a label, their text and its mandatory key phrases, in lower-case words with single spaces.  Result columns replace columns of their names, other columns pass through.
    """
    idf = word_frequencies(df, text, templates)
    results = [
        T.StructField("n_words", T.LongType()),
        T.StructField("n_base", T.LongType()),
        T.StructField("first_word", T.LongType()),
        T.StructField("last_word", T.LongType()),
        T.StructField("base_labels", T.StringType()),
        T.StructField("labels", T.StringType()),
        T.StructField("score", T.DoubleType()),
    ]
    held = [f for f in df.schema if f.name != text and f.name not in {r.name for r in results}]
    schema = T.StructType([*held, *results])
    kept = [f.name for f in held]

    def run(parts: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        index = Index(idf, templates)
        for part in parts:
            out: dict[str, list] = {r.name: [] for r in results}
            for values in _slices(part.column(len(kept)).to_pylist()):
                data, begins = _texts(values)
                starts, ends = spans(data, LETTERS)
                at, numbers = index.find(fingerprints(data, starts, ends))
                first = np.searchsorted(starts, begins)
                edges = np.searchsorted(at, first)
                for i in range(len(values)):
                    found = index.scan(at[edges[i] : edges[i + 1]] - first[i], numbers[edges[i] : edges[i + 1]])
                    places = [p for p, _ in found["base"]]
                    base = {label for _, label in found["base"]}
                    out["n_words"].append(int(first[i + 1] - first[i]))
                    out["n_base"].append(len(places))
                    out["first_word"].append(min(places, default=None))
                    out["last_word"].append(max(places, default=None))
                    out["base_labels"].append(",".join(sorted(base)))
                    out["labels"].append(",".join(sorted(base | found["labels"])))
                    out["score"].append(found["score"])
            arrays = [pa.array(out[r.name], {"long": pa.int64(), "string": pa.string(), "double": pa.float64()}[r.dataType.simpleString().replace("bigint", "long")]) for r in results]
            yield pa.RecordBatch.from_arrays([*(part.column(i) for i in range(len(kept))), *arrays], names=schema.names)

    # Columns are told by place, so their names don't matter.
    held_columns = [F.col(f"`{n}`").alias(f"c{i}") for i, n in enumerate(kept)]
    return df.select(*held_columns, F.col(f"`{text}`").cast("binary").alias("text")).mapInArrow(run, schema)
