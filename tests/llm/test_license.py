from __future__ import annotations

import random
import re

from tests.llm.helpers import documents, lower, prose
from tickloom.llm import license as L


def base(text):
    words = re.findall("[^\x00-\x2f\x3a-\x60\x7b-\x7f]+", lower(text or ""))
    places, labels = [], set()
    for phrase, label in (("mit license", "mit"), ("apache license", "apache"), ("general public license", "gpl")):
        p = phrase.split()
        for i in range(len(words) - len(p) + 1):
            if words[i : i + len(p)] == p:
                places.append(i)
                labels.add(label)
    return len(words), len(places), min(places, default=None), max(places, default=None), ",".join(sorted(labels))


def test_base_equal_to_brute_force_and_labels_of_the_method(spark):
    r = random.Random(8)
    texts = [
        "Released under the MIT License.",
        "x MIT\n-- License mit license apache-license",
        "mit licenses; amit license; the Apache   License, Version 2.0",
        "GNU General Public License general public\0license",
        "Redistribution and use in source and binary forms, with or without modification, are permitted provided",
        "under the terms of the GNU Lesser General Public License as published by the Free Software Foundation",
        "permission is hereby granted, free of charge, to any person obtaining a copy of this software",
        "license mit", "Éapache license é", None, "", " ... ", "a license of the software, use, terms and forms",
        " ".join(prose(r, 5000)) + " mit license " + " ".join(prose(r, 5000)),
    ]
    for _ in range(200):
        texts.append(" ".join(r.choice(["mit", "license", "apache", "general", "public", "GNU", "x", "the", "Software"]) for _ in range(r.randrange(0, 30))))
    rows = list(enumerate(texts)) + [(0, texts[0]), (None, texts[0])]
    df = documents(spark, rows).withColumnRenamed("v", "labels")
    out = L.scan_licenses(df)
    assert {"size", "row", "lang"} <= set(out.columns) and out.columns.count("labels") == 1
    found = out.select("doc_id", "n_words", "n_base", "first_word", "last_word", "base_labels").collect()
    assert sorted(map(tuple, found), key=str) == sorted(((k, *base(t)) for k, t in rows), key=str)
    by = {r["doc_id"]: r for r in out.collect() if r["doc_id"] is not None}
    assert by[4]["labels"] == "bsd" and by[5]["labels"] == "gpl,lgpl" and by[6]["labels"] == "mit" and by[6]["n_base"] == 0
    assert by[12]["labels"] == "" and by[12]["score"] == 0.0 and by[9]["labels"] == ""
    assert all(0 <= x["score"] <= 1 and set(filter(None, x["base_labels"].split(","))) <= set(x["labels"].split(",")) for x in by.values())


def test_short_notices_are_labelled(spark):
    expected = {
        "Words. Licensed under CC BY-NC 4.0.": "cc-by-nc",
        "Licensed under CC BY 4.0, more": "cc-by",
        "cc-by-sa": "cc-by-sa",
        "under a CC BY-NC-ND license": "cc-by-nc-nd",
        "This work is licensed under a Creative Commons Attribution-NonCommercial 4.0 International License.": "cc-by-nc",
        "This work is licensed under a Creative Commons Attribution License": "cc-by",
        "https://creativecommons.org/licenses/by-nc-sa/4.0/": "cc-by-nc-sa",
        "# SPDX-License-Identifier: MIT": "mit",
        "SPDX-License-Identifier: MIT-0": "mit-0",
        "SPDX-License-Identifier: Apache-2.0 OR MIT": "apache,mit",
        "BSD 3-Clause": "bsd",
        "Mozilla Public License 2.0": "mpl",
        "sent to the clerk, cc by mail": "",
        "it is 2 or 3 clauses by 4.0": "",
    }
    out = L.scan_licenses(documents(spark, list(enumerate(expected)))).collect()
    assert {list(expected)[r["doc_id"]]: r["labels"] for r in out} == expected
    assert all((r["score"] > 0) == (r["labels"] != "") for r in out)


def placed(words, idf, templates=L.TEMPLATES):
    """Labels and best score by trying every template at every place."""
    labels, best = set(), 0.0
    starts = [(label, p.split()) for label, _, phrases in templates for p in phrases]
    at = {}
    for i, w in enumerate(words):
        at.setdefault(w, []).append(i)
    for label, text, phrases in templates:
        t = text.split()
        weight = [idf[w] for w in t]
        for begin in {i - k for k, w in enumerate(t) for i in at.get(w, ())}:
            inside = [0 <= begin + k < len(words) and words[begin + k] == w for k, w in enumerate(t)]
            score = sum(x for x, found in zip(weight, inside) if found) / sum(weight)
            if score < 0.8 - 1e-9:
                continue

            def stands(p, i):
                longer = [q for other, q in starts if other != label and q[: len(p)] == p and len(q) > len(p) and label not in {x for x, y in starts if y == q}]
                return i >= 0 and words[i : i + len(p)] == p and not any(words[i : i + len(q)] == q for q in longer)

            if all(any(stands(p.split(), begin + k) for k in range(len(t) - len(p.split()) + 1)) for p in phrases):
                labels.add(label)
                best = max(best, score)
    return labels, best


def test_labels_and_scores_equal_to_trying_every_place():
    r = random.Random(3)
    idf = {w: r.choice([1.0, 1.5, 3.0, 7.0]) + r.random() for w in L.Index({}).words}
    index = L.Index(idf)
    several = 0
    for round_ in range(60):
        words = prose(r, r.randrange(0, 30))
        for _ in range(r.randrange(0, 4)):
            text = r.choice(L.TEMPLATES[: r.choice([15, 30, len(L.TEMPLATES)])])[1].split()
            for _ in range(r.choice([0, 0, 1, 5, 12])):
                text[r.randrange(len(text))] = r.choice(["x", "the", "license"])
            if r.random() < 0.2:
                text.insert(r.randrange(len(text)), "y")
            words += text + prose(r, r.randrange(0, 5))
        found = index.scan(*index.find(L._prints(words))) if words else {"labels": set(), "score": 0.0, "base": []}
        labels, best = placed(words, idf)
        several += len(labels) > 1
        assert found["labels"] == labels
        assert not labels or abs(found["score"] - best) < 1e-9
    assert several > 5


def test_only_placements_with_enough_votes_are_looked_at(monkeypatch):
    index = L.Index({})
    tried = []
    placements = L.Index._placements
    monkeypatch.setattr(L.Index, "_placements", lambda self, at: (tried.append(x) or x for x in placements(self, at)))
    words = ("the software is provided to use and copy in the terms of this license without fee " * 200).split()
    assert index.scan(*index.find(L._prints(words)))["labels"] == set() and len(tried) == 0
    mit = next(text for label, text, _ in L.TEMPLATES if label == "mit").split()
    spoilt = [w if i % 12 else "x" for i, w in enumerate(words + mit + words)]
    index.scan(*index.find(L._prints(spoilt)))
    assert len({t for t, _ in tried}) <= 3 and len(tried) <= 5


def test_whole_texts_are_labelled(spark):
    texts = [f"Copyright 2020 Someone.\n\n{text.capitalize()}" for _, text, _ in L.LICENSE_TEXTS]
    out = {r["doc_id"]: r for r in L.scan_licenses(documents(spark, list(enumerate(texts)))).collect()}
    for i, (label, _, _) in enumerate(L.LICENSE_TEXTS):
        assert label in out[i]["labels"].split(",") and set(out[i]["labels"].split(",")) <= {label, "gpl"} and out[i]["score"] == 1.0
    assert out[1]["labels"] == "isc" and out[2]["labels"] == "0bsd"


def test_templates_are_a_parameter(spark):
    df = documents(spark, [(1, "all wrongs reserved by us"), (2, "Licensed under CC BY-NC 4.0.")])
    out = L.scan_licenses(df, templates=(("own", "all wrongs reserved", ("wrongs reserved",)),)).collect()
    assert {r["doc_id"]: r["labels"] for r in out} == {1: "own", 2: ""}


def test_frequencies_cover_all_texts(spark):
    df = documents(spark, [(1, "license license"), (2, "mit"), (3, "License"), (4, None)])
    idf = L.word_frequencies(df, "text")
    assert idf["license"] < idf["mit"] < idf["apache"]


def test_no_rows(spark):
    assert L.scan_licenses(documents(spark, [])).collect() == []


def test_columns_of_any_name_pass_through(spark):
    names = ["text to scan", "c0", "c1", "a.b", "labels", "text"]
    df = spark.createDataFrame([("z", "0", "1", "d", "old", "under the MIT license")], ", ".join(f"`{n}` string" for n in names))
    found = L.scan_licenses(df).first().asDict()
    assert [found[n] for n in names[:4]] == ["z", "0", "1", "d"] and found["base_labels"] == "mit" and found["labels"] == "mit"
    assert L.scan_licenses(df.select("text")).first()["n_words"] == 4
