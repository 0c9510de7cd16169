"""Secret scans: fixed patterns, and windows of high Shannon entropy per character class.

A candidate is a maximal run of one class's characters that is at least a window long. The
window slides over it; the counts of its characters change by one that enters and one that
leaves, so each step costs the same whatever the window. Runs of windows at or above the class's
threshold become spans ``entropy_<class>``. Windows that the allow-list names do not count: those
that overlap one of its matches, and for a match that is a word those within a window's length of
it too, unless they lie in another part of the candidate (parts are runs of letters and digits).

Defined cases: a null or empty text has no spans; repeated rows are scanned each for itself;
other columns pass by unread. Offsets count code points, ends are exclusive.
"""

from __future__ import annotations

import math
import re
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tonemill.llm import buffers

# The patterns of the base kinds and the least length of what they must hold.
ASSIGN = (rb"(password|passwd|secret|token|api_?key)[\"']?\x20*[:=]\x20*[\"']?"
          rb"([A-Za-z0-9+/_.=-]+)")
ACCESS = rb"AKIA[A-Z0-9]+"
ASSIGN_LEAST, ACCESS_LEAST, HEX_LEAST = 6, 20, 24
BASE_KINDS = ("assign", "access", "hex")
_WORDS = (b"password", b"passwd", b"secret", b"token", b"apikey", b"api_key")
_assign = re.compile(ASSIGN, re.IGNORECASE)
_access = re.compile(ACCESS)
_part = re.compile(rb"[A-Za-z0-9]+")


@dataclass(frozen=True)
class EntropyClass:
    """Characters of a class, its window and the bits per character from which it counts."""

    name: str
    characters: str
    window: int
    bits: float
    #: A window counts only if it holds characters of each of these sets.
    needs: tuple[str, ...] = ()


_DIGITS = "0123456789"
_LOWER = "abcdefghijklmnopqrstuvwxyz"
CLASSES = (
    EntropyClass("hex", _DIGITS + "abcdef", 20, 3.0, (_DIGITS, "abcdef")),
    EntropyClass("HEX", _DIGITS + "ABCDEF", 20, 3.0, (_DIGITS, "ABCDEF")),
    EntropyClass("base64", _DIGITS + _LOWER + _LOWER.upper() + "+/=_-", 20, 3.8,
                 (_DIGITS, _LOWER, _LOWER.upper())),
)
#: Windows at these patterns are known to be harmless: samples and placeholders.
ALLOWED = (r"(?i)example", r"(?i)(sample|dummy|placeholder|changeme)", r"(.)\1{7}",
           r"(?i)abcdefghij", r"0123456789")


@dataclass(frozen=True)
class Scan:
    classes: tuple[EntropyClass, ...] = CLASSES
    allowed: tuple[str, ...] = ALLOWED

    def harmless(self, candidate: bytes, window: int) -> np.ndarray | None:
        """For each window of the candidate, by its start, whether the allow-list names it."""
        hits = [m.span() for p in self.allowed for m in re.finditer(p.encode(), candidate)]
        if not hits:
            return None
        out = np.zeros(len(candidate) - window + 1, bool)
        for a, b in hits:
            out[max(0, a - window + 1): b] = True
            if len(set(candidate[a:b])) == 1:  # filler says nothing of what stands beside it
                continue
            near = range(max(0, a - 2 * window + 1), min(len(out), b + window))
            parts = _part.finditer(candidate, near.start, min(len(candidate), near.stop + window))
            apart = np.zeros(len(near), bool)
            for m in parts:
                if m.end() <= a or m.start() >= b:
                    apart[m.start() - near.start: max(0, m.end() - window + 1 - near.start)] = True
            out[near.start: near.stop] |= ~apart
        return out


def hot_windows(text: bytes, window: int, bits: float, needs: tuple[bytes, ...],
                harmless: np.ndarray | None = None) -> list[tuple[int, int]]:
    """Maximal unions of windows of ``text`` with at least ``bits`` of entropy a character,
    without windows that are ``harmless``."""
    log = [0.0] + [c * math.log2(c) for c in range(1, window + 2)]
    counts = [0] * 256
    total, found = 0.0, []
    whole = math.log2(window)
    sets = [frozenset(s) for s in needs]
    held = [0] * len(sets)
    for i, c in enumerate(text):
        total += log[counts[c] + 1] - log[counts[c]]
        counts[c] += 1
        for k, s in enumerate(sets):
            held[k] += c in s
        if i >= window:
            out = text[i - window]
            total += log[counts[out] - 1] - log[counts[out]]
            counts[out] -= 1
            for k, s in enumerate(sets):
                held[k] -= out in s
        if i >= window - 1 and whole - total / window >= bits - 1e-9 and all(held):
            start = i - window + 1
            if harmless is not None and harmless[start]:
                continue
            if found and start <= found[-1][1]:
                found[-1] = (found[-1][0], i + 1)
            else:
                found.append((start, i + 1))
    return found


def _runs(data: np.ndarray, offsets: np.ndarray, members: np.ndarray, least: int):
    starts, ends = buffers.edges(members[data], offsets)
    long = ends - starts >= least
    return starts[long], ends[long]


def _members(characters: str) -> np.ndarray:
    table = np.zeros(256, bool)
    table[list(characters.encode())] = True
    return table


def scan_texts(column: pa.Array, scan: Scan) -> list[list[tuple[str, int, int]]]:
    """Spans ``(kind, start, end)`` in code points of each text, by start, then kind as listed."""
    data, offsets = buffers.utf8(column)
    n = len(offsets) - 1
    spans: list[list[tuple[int, int, int]]] = [[] for _ in range(n)]
    kinds = [*BASE_KINDS, *(f"entropy_{c.name}" for c in scan.classes)]
    raw = data.tobytes()
    begins = offsets.tolist()
    low = buffers.LOWER[data].tobytes()
    # Keywords are looked up over the whole chunk; only rows that hold one meet the pattern.
    hits = sorted({int(i) for w in _WORDS for i in _places(low, w)})
    for r in np.unique(buffers.rows_of(np.array(hits, np.int64), offsets)).tolist() if hits else ():
        for m in _assign.finditer(raw[begins[r]: begins[r + 1]]):
            if len(m[2]) >= ASSIGN_LEAST:
                spans[r].append((m.start(), 0, m.end()))
    keys = _places(raw, b"AKIA")
    for r in np.unique(buffers.rows_of(np.array(keys, np.int64), offsets)).tolist() if keys else ():
        for m in _access.finditer(raw[begins[r]: begins[r + 1]]):
            if len(m[0]) >= ACCESS_LEAST:
                spans[r].append((m.start(), 1, m.end()))
    starts, ends = _runs(data, offsets, _members(_DIGITS + "abcdef"), HEX_LEAST)
    for r, a, b in zip(buffers.rows_of(starts, offsets).tolist(), starts.tolist(), ends.tolist()):
        spans[r].append((a - begins[r], 2, b - begins[r]))
    for k, cls in enumerate(scan.classes, len(BASE_KINDS)):
        needs = tuple(s.encode() for s in cls.needs)
        starts, ends = _runs(data, offsets, _members(cls.characters), cls.window)
        rows = buffers.rows_of(starts, offsets).tolist()
        for r, a, b in zip(rows, starts.tolist(), ends.tolist()):
            candidate = raw[a:b]
            found = hot_windows(candidate, cls.window, cls.bits, needs)
            if found and (harmless := scan.harmless(candidate, cls.window)) is not None:
                found = hot_windows(candidate, cls.window, cls.bits, needs, harmless)
            if found:
                spans[r] += [(a + x - begins[r], k, a + y - begins[r]) for x, y in found]
    # Byte offsets become code points: bytes 10xxxxxx continue a character.
    out: list[list[tuple[str, int, int]]] = []
    for r, own in enumerate(spans):
        if own:
            part = data[begins[r]: begins[r + 1]]
            points = np.concatenate([[0], np.cumsum((part & 0xC0) != 0x80)])
            out.append([(kinds[k], int(points[a]), int(points[b])) for a, k, b in sorted(own)])
        else:
            out.append([])
    return out


def _places(text: bytes, word: bytes) -> list[int]:
    found, at = [], text.find(word)
    while at >= 0:
        found.append(at)
        at = text.find(word, at + len(word))
    return found


SPANS = "array<struct<kind:string,start:int,end:int>>"
_SPANS = pa.list_(pa.struct([("kind", pa.string()), ("start", pa.int32()), ("end", pa.int32())]))


def find_secrets(docs: DataFrame, scan: Scan | None = None, key: str = "doc_id",
                 text: str = "text") -> DataFrame:
    """``key, spans``: one row per row of ``docs``, with its spans in order. No shuffle."""
    scan = scan or Scan()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for a, b in buffers.slices(batch.column(1)):
                spans = [[{"kind": k, "start": s, "end": e} for k, s, e in own]
                         for own in scan_texts(batch.column(1).slice(a, b - a), scan)]
                yield pa.RecordBatch.from_arrays(
                    [batch.column(0).slice(a, b - a), pa.array(spans, _SPANS)], ["key", "spans"])

    kind = docs.schema[key].dataType.simpleString()
    return (docs.select(F.col(key).alias("key"), F.col(text).cast("string").alias("text"))
            .mapInArrow(run, f"key {kind}, spans {SPANS}").withColumnRenamed("key", key))


def joined(spans):
    """Column of ``kind:start:end``, comma-joined."""
    return F.array_join(F.transform(spans, lambda s: F.concat_ws(
        ":", s["kind"], s["start"].cast("string"), s["end"].cast("string"))), ",")


def redact(docs: DataFrame, scan: Scan | None = None, mask: str = "[SECRET]") -> DataFrame:
    """``docs`` with every span of its ``text`` replaced by ``mask``; overlapping spans as one."""
    scan = scan or Scan()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            at = batch.schema.get_field_index("text")
            texts = batch.column(at)
            new = []
            for text, spans in zip(texts.to_pylist(), scan_texts(texts, scan)):
                end, parts = 0, []
                for _, a, b in spans:
                    if a >= end:
                        parts += [text[end:a], mask]
                    end = max(end, b)
                new.append(text if not spans else "".join([*parts, text[end:]]))
            yield batch.set_column(at, batch.schema.field(at), pa.array(new, texts.type))

    return docs.mapInArrow(run, docs.schema)
