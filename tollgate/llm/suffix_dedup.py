"""Byte-exact removal of repeated substrings by fingerprints at synchronising positions.

This is not prefix doubling: there are no growing offsets, no rounds of reranking and no ranks.  Each run
of windows has an anchor (see ``repeats``); a window whose anchor's fingerprint is unique is unique.  Anchors
with all that their windows cover are compared next, which settles whole copied stretches.  What is still
open are single windows at the ends of copies; they are sorted once by the fingerprints of their two halves,
and all but the first of equals are marked.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .frames import saved, texts
from .repeats import BASES, COPY, OPEN, Anchors, Later, Powers, anchors, covered, marks, per_document, twins, window_names

TWIN = 3
VALUES = np.random.default_rng(64).integers(0, 1 << 64, 256, np.uint64)


def symbols(raw: bytes) -> np.ndarray:
    return VALUES[np.frombuffer(raw, np.uint8)]


def open_starts(a: Anchors, at: np.ndarray) -> np.ndarray:
    """The starts of all windows of the runs whose anchors are at ``at``."""
    run = np.searchsorted(a.at, at)
    return np.concatenate([np.arange(a.lo[r], a.hi[r] + 1) for r in run])


def _windows(length: int, gram: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        powers = Powers(BASES[0])
        halves = Powers(BASES[1])
        for b in batches:
            cols: list[list[np.ndarray]] = [[], [], [], []]
            for i, raw, at in zip(b.column(0).to_pylist(), b.column(1).to_pylist(), b.column(2), strict=True):
                values = symbols(raw)
                starts = open_starts(anchors(values, length, gram, powers), at.values.to_numpy())
                one, two = window_names(values, length, halves, starts)
                for c, x in zip(cols, (one.view(np.int64), two.view(np.int64), np.full(len(starts), i), starts), strict=True):
                    c.append(x)
            if cols[0]:
                yield pa.RecordBatch.from_arrays([pa.array(np.concatenate(c)) for c in cols], ["one", "two", "id", "start"])

    return run


def _later(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    later = Later(own_document=True)
    for b in batches:
        one, two, ids, start = (b.column(c).to_numpy() for c in ("one", "two", "id", "start"))
        out = later(one, two, ids)
        yield pa.RecordBatch.from_arrays([pa.array(ids[out]), pa.array(start[out])], ["id", "start"])


def repeated(raw: bytes, kinds: np.ndarray, at: np.ndarray, length: int, gram: int, powers: Powers) -> np.ndarray:
    """Which bytes lie in a window that starts earlier elsewhere, from the marks of the document."""
    values = symbols(raw)
    if (a := anchors(values, length, gram, powers)) is None:
        return np.zeros(len(raw), bool)
    if TWIN in kinds:
        return np.ones(len(raw), bool)
    copy = np.zeros(len(a.at), bool)
    copy[np.searchsorted(a.at, at[kinds == COPY])] = True
    copy = copy[a.first] | (a.first != np.arange(len(a.first)))
    dup = np.repeat(copy, a.hi - a.lo + 1)
    dup[at[kinds == OPEN]] = True
    return covered(dup, length)


OUT = "id long, n_bytes long, n_removed long, n_spans long, kept_sha256 string, kept binary"


def _cut(length: int, gram: int, keep: bool):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        powers = Powers(BASES[0])
        for b in batches:
            rows = []
            for i, raw, kinds, at in zip(*(b.column(c) for c in range(4)), strict=True):
                raw = raw.as_py()
                k, p = (x.values.to_numpy() if x.is_valid else np.empty(0, np.int64) for x in (kinds, at))
                gone = repeated(raw, k, p, length, gram, powers)
                kept = np.frombuffer(raw, np.uint8)[~gone].tobytes()
                spans = int((gone & ~np.r_[False, gone[:-1]]).sum()) if len(gone) else 0
                rows.append((i.as_py(), len(raw), int(gone.sum()), spans, hashlib.sha256(kept).hexdigest(), kept if keep else None))
            names = [c.split()[0] for c in OUT.split(", ")]
            kinds = (pa.int64(), pa.int64(), pa.int64(), pa.int64(), pa.string(), pa.binary())
            yield pa.RecordBatch.from_arrays([pa.array([r[j] for r in rows], t) for j, t in enumerate(kinds)], names)

    return run


def remove_repeats(docs: DataFrame, length: int = 100, gram: int = 40, id_col: str = "doc_id", text_col: str = "text", keep: bool = True) -> DataFrame:
    """One row for each document: its bytes, how many are removed in how many runs, and what is left.

    A byte goes if a window of ``length`` bytes that covers it also starts earlier: in a smaller id, or
    before in the same document.  A null text is empty; texts shorter than a window stay whole; see
    ``frames.texts`` for null and repeated ids.  ``kept`` is null unless ``keep``; it may not be valid
    UTF-8, as windows cut characters.
    """
    corpus = texts(docs, id_col, text_col).select("id", F.col("text").cast("binary").alias("text"))
    parts = int(docs.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    dealt = corpus.repartition(parts, "id")  # read by both joins below, shuffled once
    found = saved(marks(corpus, symbols, length, gram))
    still = dealt.join(per_document(found.where(F.col("state") == OPEN), "at"), "id")
    pairs = still.mapInArrow(_windows(length, gram), "one long, two long, id long, start long")
    pairs = pairs.repartition("one").sortWithinPartitions("one", "two", "id", "start")
    dup = pairs.mapInArrow(_later, "id long, start long")
    every = found.where(F.col("state") == COPY).select("id", F.lit(COPY).alias("kind"), F.col("at").cast("long").alias("at"))
    every = every.union(dup.select("id", F.lit(OPEN), "start")).union(twins(corpus).select("id", F.lit(TWIN), F.lit(0).cast("long")))
    whole = dealt.join(per_document(every, "kind", "at"), "id", "left")
    return whole.mapInArrow(_cut(length, gram, keep), OUT)
