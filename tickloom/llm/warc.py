"""Web archives written from pages and read back by boundary-chain verification.

Archives are concatenated WARC records.  They are written by the text sink, as a
record is text between known separators, and read by the text source cut at the
records' magic line, so any number of tasks share a large archive.  The pieces of a
file tile it: their lengths, summed along the file, give the offset of each
magic.  A magic may also stand inside a payload; so each piece that starts like a record only proposes
an edge from its offset to where its declared length ends.  Pointer jumping from the
start of the file, first inside each split and then along the splits, keeps the records that
the chain reaches.  Pieces inside a record belong to its payload.
"""

from __future__ import annotations

import hashlib
import re
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tickloom.session import Scratch

# Fixed values of the format.
MAGIC = b"WARC/1.0\r\n"
END = "\r\n\r\n"
#: Payloads this long are revisits of an equal one.
REVISIT_BYTES = 1000
#: Records in an archive file, by which the sink starts a new one.
RECORDS_PER_FILE = 50_000
_JUMPS = 64


def plan_records(pages: DataFrame, key: str = "page_id", url: str = "url", html: str = "html", least: int = REVISIT_BYTES) -> DataFrame:
    """Record type and reference of each page: ``page_id``, ``url``, ``digest``, ``bytes``, ``record_type``, ``refers_to``.

    Of equal payloads of at least ``least`` bytes that with the largest key is the response.  Rows of equal key and
    payload are all responses, being one page.
    """
    payload = F.coalesce(F.col(f"`{html}`").cast("string"), F.lit(""))
    rows = pages.select(
        F.col(f"`{key}`").alias("page_id"), F.col(f"`{url}`").cast("string").alias("url"), F.sha1(payload.cast("binary")).alias("digest"), F.octet_length(payload).cast("long").alias("bytes")
    )
    newest = rows.where(F.col("bytes") >= least).groupBy("digest", "bytes").agg(F.max("page_id").alias("newest"))
    joined = rows.join(newest, ["digest", "bytes"], "left")
    revisit = F.col("newest").isNotNull() & (F.col("page_id").isNull() | (F.col("page_id") < F.col("newest")))
    return joined.select(
        "page_id", "url", "digest", "bytes", F.when(revisit, "revisit").otherwise("response").alias("record_type"), F.when(revisit, F.col("newest")).alias("refers_to")
    )


def _header(pages: DataFrame) -> DataFrame:
    """The text of each record, from page_id, url, html, record_type, refers_to, digest and bytes."""

    def line(name: str, value: Column) -> Column:
        return F.concat(F.lit(f"{name}: "), value, F.lit("\r\n"))

    safe_url = F.regexp_replace(F.coalesce("url", F.lit("")), r"[\x00-\x20\x7F]", "")
    body = F.when(F.col("record_type") == "revisit", F.lit("")).otherwise(F.coalesce("html", F.lit("")))
    return pages.select(
        F.concat(
            F.lit(MAGIC.decode()),
            line("WARC-Type", F.col("record_type")),
            line("WARC-Record-ID", F.concat(F.lit("<urn:page:"), F.coalesce(F.col("page_id").cast("string"), F.lit("none")), F.lit(">"))),
            # In angle brackets, as the format has it, an address cannot end a line as the magic does.
            line("WARC-Target-URI", F.concat(F.lit("<"), safe_url, F.lit(">"))),
            F.coalesce(line("WARC-Refers-To", F.concat(F.lit("<urn:page:"), F.col("refers_to").cast("string"), F.lit(">"))), F.lit("")),
            line("WARC-Payload-Digest", F.concat(F.lit("sha1:"), F.col("digest"))),
            line("X-Payload-Length", F.col("bytes").cast("string")),
            line("Content-Type", F.lit("text/html")),
            line("Content-Length", F.octet_length(body).cast("string")),
            F.lit("\r\n"),
            body,
        ).alias("value")
    )


def write_archives(scratch: Scratch, pages: DataFrame, path: str, key: str = "page_id", url: str = "url", html: str = "html") -> None:
    """Write a record for each page.  Null payloads are empty, null keys and URLs too; other columns are left out."""
    plan = plan_records(pages, key, url, html).where("record_type = 'revisit'").select("page_id", "digest", "refers_to").distinct()
    plan = scratch.keep(plan, "revisits")
    payload = F.coalesce(F.col(f"`{html}`").cast("string"), F.lit(""))
    rows = pages.select(
        F.col(f"`{key}`").alias("page_id"),
        F.col(f"`{url}`").cast("string").alias("url"),
        payload.alias("html"),
        F.sha1(payload.cast("binary")).alias("digest"),
        F.octet_length(payload).cast("long").alias("bytes"),
    )
    same = F.col("p.page_id").eqNullSafe(F.col("r.page_id")) & (F.col("p.digest") == F.col("r.digest"))
    joined = rows.alias("p").join(plan.alias("r"), same, "left")
    typed = joined.select("p.*", F.col("r.refers_to"), F.when(F.col("r.digest").isNotNull(), "revisit").otherwise("response").alias("record_type"))
    _header(typed).write.option("lineSep", END).option("maxRecordsPerFile", RECORDS_PER_FILE).text(path)


_PIECE = (
    "file string, split long, piece int, at long, length long, size long, whole boolean, record_type string, page_id long, refers_to long, "
    "payload_digest string, payload_bytes long, body_digest string, body_bytes long, head long"
)
_LINE = re.compile(rb"([A-Za-z-]+):[ \t]*([^\r\n]*)\r\n")
_PAGE = re.compile(rb"<urn:page:(-?\d+)>")


def _page(value: bytes | None) -> int | None:
    found = _PAGE.fullmatch(value or b"")
    return int(found[1]) if found else None


def _parse(body: bytes) -> dict | None:
    """Fields of a record from what follows its magic, or None if that is no record header."""
    end = body.find(b"\r\n\r\n")
    if end < 0:
        return None
    fields, at = {}, 0
    while at < end + 2:
        line = _LINE.match(body, at)
        if not line:
            return None
        fields[line[1].lower()] = line[2]
        at = line.end()
    length = fields.get(b"content-length", b"")
    if not length.isdigit() or b"warc-type" not in fields:
        return None
    return {
        "head": end + 4,
        "body_bytes": int(length),
        "record_type": fields[b"warc-type"].decode("latin-1"),
        "page_id": _page(fields.get(b"warc-record-id")),
        "refers_to": _page(fields.get(b"warc-refers-to")),
        "payload_digest": fields.get(b"warc-payload-digest", b"").decode("latin-1").removeprefix("sha1:") or None,
        "payload_bytes": int(n) if (n := fields.get(b"x-payload-length", b"")).isdigit() else None,
    }


def _pieces(spark, path: str) -> DataFrame:
    """The archives' bytes between magics, in order within each split."""
    raw = spark.read.option("lineSep", MAGIC.decode()).text(path)
    return raw.select(F.col("value").cast("binary").alias("value"), F.col("_metadata.file_path").alias("file"), F.col("_metadata.file_block_start").alias("split"))


def _numbered(parts: Iterator[pa.RecordBatch]) -> Iterator[tuple[str, int, int, int, bytes]]:
    """file, split, number and offset in the split of each piece."""
    place, piece, at = None, 0, 0
    for part in parts:
        for value, file, split in zip(*(part.column(c).to_pylist() for c in ("value", "file", "split")), strict=True):
            if (file, split) != place:
                place, piece, at = (file, split), 0, 0
            yield file, split, piece, at, value
            piece, at = piece + 1, at + len(value) + len(MAGIC)


def candidates(spark, path: str) -> DataFrame:
    """A row for each piece: where it lies in its split, and the record that it may be."""
    names = [c.split()[0] for c in _PIECE.split(", ")]
    arrow = {"string": pa.string(), "long": pa.int64(), "int": pa.int32(), "boolean": pa.bool_()}
    schema = pa.schema([(c.split()[0], arrow[c.split()[1]]) for c in _PIECE.split(", ")])

    def run(parts: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        rows: list[dict] = []
        for file, split, piece, at, value in _numbered(parts):
            row = {"file": file, "split": split, "piece": piece, "at": at, "length": len(value) + len(MAGIC), "whole": False}
            # The first piece of a file lies before any magic.
            parsed = _parse(value) if split or piece else None
            if parsed:
                body = value[parsed["head"] :]
                row |= parsed | {"size": len(MAGIC) + parsed["head"] + parsed["body_bytes"] + len(END)}
                # Whole: the declared end is where the next piece begins.
                if len(body) == parsed["body_bytes"] + len(END) and body.endswith(END.encode()):
                    row |= {"whole": True, "body_digest": hashlib.sha1(body[: parsed["body_bytes"]]).hexdigest()}
            rows.append(row)
            if len(rows) == 4096:
                yield pa.RecordBatch.from_pylist([{n: r.get(n) for n in names} for r in rows], schema)
                rows = []
        if rows:
            yield pa.RecordBatch.from_pylist([{n: r.get(n) for n in names} for r in rows], schema)

    return _pieces(spark, path).mapInArrow(run, _PIECE)


def _with_offsets(scratch: Scratch, found: DataFrame) -> DataFrame:
    """Pieces with the offset of their magic in the file; the splits' lengths are summed along each file."""
    lengths = found.groupBy("file", "split").agg(F.sum("length").alias("total"))
    along = Window.partitionBy("file").orderBy("split").rowsBetween(Window.unboundedPreceding, -1)
    bases = lengths.select("file", "split", F.coalesce(F.sum("total").over(along), F.lit(0)).alias("base"))
    # A piece ends at the next magic: the magic before it is where it begins.
    start = F.col("base") + F.col("at") - len(MAGIC)
    return scratch.keep(found.join(bases, ["file", "split"]).withColumn("offset", start), "offsets")


def _jump(successor: np.ndarray) -> np.ndarray:
    """Where each chain of positions leaves the array, by doubling; ``successor[i]`` is i's next position, i itself at an end."""
    for _ in range(_JUMPS):
        further = successor[successor]
        if np.array_equal(further, successor):
            return further
        successor = further
    return successor


def _successors(split: pd.DataFrame) -> np.ndarray:
    """Positions of the records that follow, within the split; a record's own position where its successor is not there."""
    offsets = split["offset"].to_numpy()
    ends = np.where(split["size"].notna(), offsets + split["size"].fillna(0).to_numpy(np.int64), -1)
    at = np.searchsorted(offsets, ends)
    inside = (at < len(offsets)) & (ends >= 0)
    inside[inside] = offsets[at[inside]] == ends[inside]
    return np.where(inside, at, np.arange(len(offsets)))


def reachable(scratch: Scratch, pieces: DataFrame) -> DataFrame:
    """``file`` and ``offset`` of the records that the chain from the file's start reaches."""
    edges = pieces.where("size IS NOT NULL").select("file", "split", "offset", "size")

    def leave(split: pd.DataFrame) -> pd.DataFrame:
        split = split.sort_values("offset", ignore_index=True)
        last = _jump(_successors(split))
        return pd.DataFrame({"file": split["file"], "offset": split["offset"], "next": (split["offset"] + split["size"]).to_numpy()[last]})

    by_split = edges.groupBy("file", "split")
    exits = scratch.keep(by_split.applyInPandas(leave, "file string, offset long, next long"), "exits")
    # Entries of splits: double the jumps along the file until no new one is reached.
    reached = scratch.keep(exits.where("offset = 0").select("file", "offset"), "entries")
    jumps = exits
    while True:
        there = reached.join(jumps, ["file", "offset"]).select("file", F.col("next").alias("offset"))
        there = there.join(exits.select("file", "offset"), ["file", "offset"], "left_semi")
        grown = scratch.keep(reached.unionByName(there).distinct(), "entries")
        if grown.count() == reached.count():
            break
        reached = grown
        further = jumps.join(jumps.select("file", F.col("offset").alias("next"), F.col("next").alias("beyond")), ["file", "next"], "left")
        jumps = scratch.keep(further.select("file", "offset", F.coalesce("beyond", "next").alias("next")), "jumps")
    entries = reached.withColumn("entry", F.lit(True))

    def keep(split: pd.DataFrame) -> pd.DataFrame:
        split = split.sort_values("offset", ignore_index=True)
        successor = _successors(split)
        on = split["entry"].notna().to_numpy()
        for _ in range(_JUMPS):
            more = on.copy()
            more[successor[on]] = True
            if np.array_equal(more, on):
                break
            on, successor = more, successor[successor]
        return split.loc[on, ["file", "offset"]]

    marked = edges.join(entries, ["file", "offset"], "left")
    return marked.groupBy("file", "split").applyInPandas(keep, "file string, offset long")


def read_archives(scratch: Scratch, path: str) -> DataFrame:
    """The records of the archives below ``path``: ``file``, ``offset``, ``record_type``, ``page_id``, ``refers_to``,
    ``payload_digest`` and ``payload_bytes`` as declared, ``body_bytes``, ``body_digest`` of the bytes found.

    A piece that the chain doesn't reach gives none; a chain that breaks ends its file's records.
    """
    spark = scratch.spark
    pieces = _with_offsets(scratch, candidates(spark, path))
    kept = scratch.keep(reachable(scratch, pieces), "reachable")
    fields = ("file", "offset", "record_type", "page_id", "refers_to", "payload_digest", "payload_bytes", "body_bytes", "body_digest")
    records = pieces.join(kept, ["file", "offset"])
    broken = scratch.keep(records.where("NOT whole").select("file", "offset", "head", "body_bytes"), "broken")
    whole = records.where("whole").select(*fields)
    if broken.isEmpty():
        return whole
    # Payloads with a magic inside: gather their pieces by a second look at the archives.
    marked = pieces.join(broken.select("file").distinct(), "file", "left_semi").join(kept.withColumn("start", F.col("offset")), ["file", "offset"], "left")
    along = Window.partitionBy("file").orderBy("offset").rowsBetween(Window.unboundedPreceding, 0)
    owned = marked.select("file", "split", "piece", F.col("offset").alias("at"), F.last("start", True).over(along).alias("offset"))
    wanted = owned.join(broken.select("file", "offset", "head", "body_bytes"), ["file", "offset"])

    shape = pa.schema([("file", pa.string()), ("split", pa.int64()), ("piece", pa.int32()), ("value", pa.binary())])

    def number(parts: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for file, split, piece, _, value in _numbered(parts):
            yield pa.RecordBatch.from_pylist([{"file": file, "split": split, "piece": piece, "value": value}], shape)

    values = _pieces(spark, path).mapInArrow(number, "file string, split long, piece int, value binary")
    parts = values.join(wanted, ["file", "split", "piece"])

    def digest(record: pd.DataFrame) -> pd.DataFrame:
        record = record.sort_values("at")
        joined = MAGIC.join(record["value"])
        head, size = int(record["head"].iloc[0]), int(record["body_bytes"].iloc[0])
        found = hashlib.sha1(joined[head : head + size]).hexdigest()
        return pd.DataFrame({"file": [record["file"].iloc[0]], "offset": [record["offset"].iloc[0]], "body_digest": [found]})

    digests = parts.groupBy("file", "offset").applyInPandas(digest, "file string, offset long, body_digest string")
    rest = records.where("NOT whole").drop("body_digest").join(digests, ["file", "offset"]).select(*fields)
    return whole.unionByName(rest)
