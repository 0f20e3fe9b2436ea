from __future__ import annotations

import random

import corpus_pipeline
from tests.llm.helpers import documents, prose
from tickloom.llm import mixing


def test_stages_in_order_with_their_decisions(spark, tmp_path):
    r = random.Random(9)
    passage = prose(r, 60)
    rows, labels = [], []
    for i in range(400):
        words = prose(r, r.randrange(40, 120), 3000)
        toxic = i % 4 == 0
        if toxic:
            words[3:3] = ["idiotic", "scumbag", "worthless"]
        rows.append((i, " ".join(words)))
        labels.append((i, 1, int(toxic)))
    copies = [(1000 + i, rows[i][1] + " end") for i in (1, 2, 3)]
    shared = [(2000 + i, " ".join(prose(r, 40) + passage + prose(r, 40))) for i in range(5)]
    rows += copies + shared + [(3000, None), (3001, ""), (None, " ".join(prose(r, 50)))]
    folder = str(tmp_path)
    documents(spark, rows, [("a", "b", None)[i % 3] for i in range(len(rows))]).write.parquet(f"{folder}/documents.parquet")
    spark.createDataFrame(labels, "doc_id long, quality int, toxic int").write.parquet(f"{folder}/labels.parquet")
    docs = spark.read.parquet(f"{folder}/documents.parquet")
    columns = docs.columns
    kept = {}
    for name, stage in corpus_pipeline.STAGES:
        out = f"{folder}/{name}"
        stage(spark, docs, folder).write.parquet(out)
        docs = spark.read.parquet(out)
        kept[name] = docs.toPandas()
        if name != "packing":
            assert docs.columns == columns
    ids = {n: set(k["doc_id"].dropna().astype(int)) for n, k in kept.items()}
    toxic = {i for i in range(400) if i % 4 == 0}
    assert len(ids["toxicity"] & toxic) <= 8 and len({*range(400)} - toxic - ids["toxicity"]) <= 8
    assert {3000, 3001} <= ids["toxicity"] and not {1001, 1002, 1003} & ids["jaccard_join"]
    repeated = kept["substring_dedup"].set_index("doc_id")["text"]
    assert all(" ".join(passage) not in (t or "") for t in repeated) and len(repeated.loc[2000].split()) >= 80
    plan = mixing.mix_sources(corpus_pipeline.Scratch(spark), spark.read.parquet(f"{folder}/substring_dedup"))
    assert len(kept["mixing"]) == plan.agg({"copies": "sum"}).first()[0]
    assert kept["packing"].groupby("sequence_id")["length"].sum().max() <= 4096
    ran = corpus_pipeline.run(spark, folder)
    assert ran.count() == len(kept["packing"])
    corpus_pipeline._scratch(spark)
