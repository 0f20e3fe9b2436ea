"""Registered queries of the operators in this package, with production parameters, and their SQL."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tickloom.llm import align, graph_ann, html, jaccard, license, maxscore, mixing, packing, runs, secret_scan, sql, substring, toxicity, warc
from tickloom.session import Scratch


def _read(spark: SparkSession, folder: str, table: str) -> DataFrame:
    return spark.read.parquet(f"{folder}/{table}.parquet")


def op1_maxscore(spark: SparkSession, folder: str) -> DataFrame:
    return maxscore.top_k(Scratch(spark), _read(spark, folder, "embeddings").select("vec_id", "embedding"))


def op2_substring_dedup(spark: SparkSession, folder: str) -> DataFrame:
    documents = _read(spark, folder, "documents").select("doc_id", "text")
    return substring.remove_repeats(Scratch(spark), documents, with_text=False)


def op3_graph_ann(spark: SparkSession, folder: str) -> DataFrame:
    return graph_ann.nearest(Scratch(spark), _read(spark, folder, "embeddings").select("vec_id", "embedding"))


def op4_warc(spark: SparkSession, folder: str) -> DataFrame:
    scratch = Scratch(spark)
    archives = scratch.path("archives")
    warc.write_archives(scratch, _read(spark, folder, "pages").select("page_id", "url", "html"), archives)
    records = warc.read_archives(scratch, archives)
    response = F.col("record_type") == "response"
    return records.select(
        "page_id",
        F.when(response, F.col("body_bytes")).otherwise(F.col("payload_bytes")).alias("payload_bytes"),
        F.when(response, F.col("body_digest")).otherwise(F.col("payload_digest")).alias("payload_digest"),
        "record_type",
        "refers_to",
    )


def op5_html(spark: SparkSession, folder: str) -> DataFrame:
    pages = _read(spark, folder, "pages").select("page_id", "url", "html")
    return html.main_text(Scratch(spark), pages).select("page_id", "url", "text", "n_chars")


def op6_mixing(spark: SparkSession, folder: str) -> DataFrame:
    return mixing.mix_sources(Scratch(spark), _read(spark, folder, "documents").select("doc_id", "text", "source"))


def op7_packing(spark: SparkSession, folder: str) -> DataFrame:
    return packing.pack(Scratch(spark), _read(spark, folder, "documents").select("doc_id", "text"))


def op8_toxicity(spark: SparkSession, folder: str) -> DataFrame:
    documents = _read(spark, folder, "documents").select("doc_id", "text")
    model = toxicity.fit(Scratch(spark), documents, _read(spark, folder, "labels").select("doc_id", "toxic"))
    scored = toxicity.score(documents, model).withColumn("held_out", toxicity.held_out("doc_id"))
    return scored.select("doc_id", "held_out", "score", "predicted")


def op9_license(spark: SparkSession, folder: str) -> DataFrame:
    return license.scan_licenses(_read(spark, folder, "documents").select("doc_id", "text"))


def op10_jaccard_join(spark: SparkSession, folder: str) -> DataFrame:
    documents = _read(spark, folder, "documents").select("doc_id", "text")
    _, groups = jaccard.similar_groups(Scratch(spark), documents, size=3, percent=90)
    return groups.select("doc_id", "n_shingles", "component_id")


def planted_periods(documents: DataFrame) -> DataFrame:
    """Documents of which about a tenth, by checksum of the id, repeat a stretch of their words to the end.

    With h = crc32 of the decimal ``doc_id``, g = h / 10 and n words, where h divides by ten: from word a = g mod n on, word i
    becomes word a + (i - a) mod p, p = 1 + (n - a) / (3 + g mod 8).  Rows without a text or an id stay as they are.
    """
    words = F.regexp_extract_all("text", F.lit(r"[^\x20\x09-\x0D]+"), F.lit(0))
    h = F.crc32(F.col("doc_id").cast("string").cast("binary"))
    picked = documents.withColumn("g", F.when(h % 10 == 0, F.floor(h / 10))).withColumn("words", F.when(F.col("g").isNotNull(), words))
    n = F.size("words")
    a = F.when(n > 0, F.expr("g % size(words)").cast("int"))
    placed = picked.withColumn("a", a).withColumn("p", (1 + F.expr("(size(words) - a) div (3 + g % 8)")).cast("int"))
    rewritten = F.expr("array_join(transform(words, (w, i) -> IF(i < a, w, words[a + (i - a) % p])), ' ')")
    return placed.select("doc_id", F.when(F.col("a").isNotNull(), rewritten).otherwise(F.col("text")).alias("text"))


def op11_periodic_runs(spark: SparkSession, folder: str) -> DataFrame:
    found = runs.find_runs(planted_periods(_read(spark, folder, "documents").select("doc_id", "text")))
    best = F.expr("array_max(transform(runs, r -> struct(r.length AS length, -r.start AS start, -r.period AS period)))")
    lines = F.expr("array_join(transform(runs, r -> concat(r.start, ',', r.length, ',', r.period, '\n')), '')")
    return found.withColumn("best", best).select(
        "doc_id",
        F.size("runs").cast("long").alias("n_runs"),
        (-F.col("best.start")).alias("start"),
        F.col("best.length").alias("length"),
        (-F.col("best.period")).alias("period"),
        F.expr("1000 * best.length div -best.period").alias("exponent_milli"),
        F.sha2(lines, 256).alias("runs_sha256"),
        F.sha2(F.coalesce("collapsed", F.lit("")), 256).alias("collapsed_sha256"),
    )


def op12_alignment(spark: SparkSession, folder: str) -> DataFrame:
    return align.align(Scratch(spark), _read(spark, folder, "documents").select("doc_id", "text"))


def op13_secrets(spark: SparkSession, folder: str) -> DataFrame:
    found = secret_scan.scan_secrets(_read(spark, folder, "documents").select("doc_id", "text"))
    written = "array_join(transform({0}, s -> concat_ws(':', s.kind, s.start, s.end)), ',')"
    return found.withColumn("base", F.expr("filter(secrets, s -> s.kind IN ('assign', 'access', 'hex'))")).select(
        "doc_id",
        *[F.size(F.expr(f"filter(secrets, s -> s.kind = '{k}')")).cast("long").alias(f"n_{k}") for k in secret_scan.KINDS],
        F.sha2(F.expr(written.format("base")), 256).alias("base_sha256"),
        F.expr(written.format("secrets")).alias("spans"),
    )


QUERIES = {
    f.__name__: f
    for f in (
        op1_maxscore,
        op2_substring_dedup,
        op3_graph_ann,
        op4_warc,
        op5_html,
        op6_mixing,
        op7_packing,
        op8_toxicity,
        op9_license,
        op10_jaccard_join,
        op11_periodic_runs,
        op12_alignment,
        op13_secrets,
    )
}
ORACLE: dict[str, str] = {
    "op1_maxscore": sql.OP1,
    "op2_substring_dedup": sql.OP2,
    "op4_warc": sql.OP4,
    "op6_mixing": sql.OP6,
    "op10_jaccard_join": sql.OP10,
}
