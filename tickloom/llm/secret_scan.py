"""Secrets in texts: known forms by pattern, random strings by token efficiency.

A byte-pair vocabulary holds what is frequent in ordinary text, so words and identifiers cost few tokens a
character and random strings many.  Candidates are unbroken strings of the characters that keys are
written in; those that cost more than one token per ``RATIO`` characters are reported as ``random``,
after known digests (hexadecimal strings of a digest's length) and known identifiers (UUIDs, dates and
times, numbers, names made of words) have been set aside.
"""

from __future__ import annotations

import re
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import types as T

from tickloom.llm.rowwise import judge_texts

SPAN = "array<struct<kind:string,start:bigint,`end`:bigint>>"
#: Kinds in the order in which spans that begin together are listed.
KINDS = ("assign", "access", "hex", "random")
#: Characters a token below which a string is called random: above 99 % of random strings over 36 or 64 symbols.
RATIO = 2.0
#: Shortest candidate, in characters.
SHORTEST = 20

_ASSIGN = re.compile(r"""(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", re.IGNORECASE | re.ASCII)
_ACCESS = re.compile(r"AKIA[A-Z0-9]+")
_HEX = re.compile(r"[0-9a-f]{24,}")
_CANDIDATE = re.compile(r"[A-Za-z0-9+/_-]+={0,2}")

#: Hexadecimal digits of common digests: MD5, SHA-1, SHA-224, SHA-256, SHA-384, SHA-512.
DIGEST_LENGTHS = (32, 40, 56, 64, 96, 128)
_DIGEST = re.compile(r"[0-9a-f]+|[0-9A-F]+")
_UUID = re.compile(r"[0-9A-Fa-f]{8}(-[0-9A-Fa-f]{4}){3}-[0-9A-Fa-f]{12}")
_MOMENT = re.compile(r"\d{4}[-/_]?\d{2}[-/_]?\d{2}([T_-]\d{2}[-_]?\d{2}([-_]?\d{2})?([-_]?\d{1,9})?Z?)?")
_NUMBER = re.compile(r"[0-9+/_-]+=*")
_NAME_PART = re.compile(r"[A-Z]?[a-z]+|[A-Z]+|[0-9]+")
_SEPARATORS = re.compile(r"[+/_=-]+")


def default_vocabulary() -> str:
    import public_tokenizers

    return public_tokenizers.path("byte_bpe_50k.tiktoken")


@lru_cache(1)
def _encoding(path: str):
    """This worker's encoding of the vocabulary."""
    import public_tokenizers
    import tiktoken
    from tiktoken.load import load_tiktoken_bpe

    return tiktoken.Encoding("vocabulary", pat_str=public_tokenizers.PATTERN, mergeable_ranks=load_tiktoken_bpe(path), special_tokens={})


def is_known(string: str) -> bool:
    """A digest of a known length, or an identifier of a known form."""
    if len(string) in DIGEST_LENGTHS and _DIGEST.fullmatch(string):
        return True
    if _UUID.fullmatch(string) or _MOMENT.fullmatch(string) or _NUMBER.fullmatch(string):
        return True
    return _is_name(string)


def _is_name(string: str) -> bool:
    """Words and numbers, joined by separators or by a change of case: four letters a word at least on average, few numbers."""
    parts = [p for piece in _SEPARATORS.split(string) for p in _NAME_PART.findall(piece)]
    words = [p for p in parts if not p[0].isdigit()]
    return bool(words) and sum(map(len, words)) >= 4 * len(words) and len(parts) - len(words) <= 1 + len(words) // 4


def random_spans(text: str, encoding, ratio: float, shortest: int) -> list[tuple[int, int]]:
    """Spans of the strings that the vocabulary encodes too badly."""
    found = []
    for match in _CANDIDATE.finditer(text):
        if match.end() - match.start() >= shortest and not is_known(match.group()):
            string = match.group()
            if len(string) < ratio * len(encoding.encode_ordinary(string)):
                found.append(match.span())
    return found


def spans(text: str, encoding, ratio: float = RATIO, shortest: int = SHORTEST) -> list[tuple[int, int, int]]:
    """Start, kind's number and end of all findings, by start, then kind; a random string inside a known form is not told twice."""
    found = [(m.start(), 0, m.end()) for m in _ASSIGN.finditer(text) if m.end(2) - m.start(2) >= 6]
    found += [(m.start(), 1, m.end()) for m in _ACCESS.finditer(text) if m.end() - m.start() >= 20]
    found += [(m.start(), 2, m.end()) for m in _HEX.finditer(text)]
    extra = random_spans(text, encoding, ratio, shortest)
    if found and extra:
        found.sort()
        begins, furthest = np.array([s for s, _, _ in found]), np.maximum.accumulate([e for _, _, e in found])
        at = np.searchsorted(begins, [s for s, _ in extra], "right") - 1
        extra = [(s, e) for (s, e), k in zip(extra, at.tolist(), strict=True) if k < 0 or furthest[k] < e]
    return sorted(found + [(s, 3, e) for s, e in extra])


def scan_secrets(df: DataFrame, text: str = "text", vocabulary: str | None = None, ratio: float = RATIO, shortest: int = SHORTEST) -> DataFrame:
    """All columns, with ``secrets``: kind, start and end (code points, end exclusive) of all findings, by start, then kind.

    Kinds: ``assign`` (a named password, token or key that is given a value of six characters or more), ``access`` (an access key's id),
    ``hex`` (24 hexadecimal digits or more) and the method's ``random``.  Matches of a kind are the leftmost that do not overlap; those
    too short are dropped.

    Null and empty texts have an empty list.  Texts and strings of any length are scanned whole.  Repeated rows and ties are judged each on its own;
    an empty table gives none.  Other columns pass through, whatever their names; one called ``secrets`` is replaced.
    """
    path = vocabulary or default_vocabulary()

    def judge(texts: list[str | None]) -> list[pa.Array]:
        encoding = _encoding(path)
        rows = [spans(t, encoding, ratio, shortest) if t else [] for t in texts]
        flat = [x for row in rows for x in row]
        fields = [pa.array([KINDS[k] for _, k, _ in flat], pa.string()), pa.array([s for s, _, _ in flat], pa.int64()), pa.array([e for _, _, e in flat], pa.int64())]
        edges = np.concatenate(([0], np.cumsum([len(r) for r in rows]))).astype(np.int32)
        return [pa.ListArray.from_arrays(pa.array(edges), pa.StructArray.from_arrays(fields, names=["kind", "start", "end"]))]

    return judge_texts(df, text, T.StructType.fromDDL(f"secrets {SPAN}"), judge, binary=False, keep_text=True)
