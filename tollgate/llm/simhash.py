"""SimHash near-duplicates by anchor-point covering.

Fingerprints live in two 32-bit halves.  Two fingerprints at most three bits apart are at most one bit
apart in one half, so each half is searched for distance one.  The anchors of a half are the codewords
of the [31, 26] Hamming code on its low 31 bits, a perfect code of covering radius one: every
fingerprint has one home anchor within the radius, and is replicated to all (at most 16) anchors within
radius plus one.  A linked pair meets at the home anchor of either member; there the full 64 bits are
compared.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .frames import components, released, saved, texts

LANES = np.uint64(0x0101010101010101)


def fingerprint(text: bytes, shingle: int = 3, seed: int = 42) -> int:
    """64-bit SimHash of the lower-cased (A-Z) words' shingles; 0 for a text without words."""
    words = text.lower().split()
    if not words:
        return 0
    joined = b" ".join(words)
    if len(words) <= shingle:
        return xxhash.xxh64_intdigest(joined, seed)
    spaces = np.flatnonzero(np.frombuffer(joined, np.uint8) == 32)
    starts = [0, *(spaces[: len(words) - shingle] + 1).tolist()]
    ends = [*spaces[shingle - 1 :].tolist(), len(joined)]
    digest = xxhash.xxh64_intdigest
    h = np.array([digest(joined[s:e], seed) for s, e in zip(starts, ends, strict=True)], np.uint64)
    cuts = np.arange(0, len(h), 255)
    bits = 0
    for j in range(8):  # bit j of each byte; byte lanes hold sums of at most 255 ones
        sums = np.add.reduceat((h >> np.uint64(j)) & LANES, cuts).view(np.uint8).reshape(-1, 8).sum(0, dtype=np.int64)
        for lane in np.flatnonzero(2 * sums > len(h)).tolist():
            bits |= 1 << (8 * lane + j)
    return bits


def fingerprints(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", shingle: int = 3) -> DataFrame:
    """(id, fp): the fingerprint of every document as a signed long."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            fp = np.array([fingerprint(t, shingle) for t in b.column(1).to_pylist()], np.uint64)
            yield pa.RecordBatch.from_arrays([b.column(0), pa.array(fp.view(np.int64))], ["id", "fp"])

    return texts(docs, id_col, text_col).select("id", F.col("text").cast("binary").alias("text")).mapInArrow(released(run), "id long, fp long")


def _parity_columns() -> np.ndarray:
    """For a syndrome s (1..31): the bit masks to flip to reach the 15 codewords at distance two."""
    out = np.zeros((32, 15), np.uint64)
    for s in range(1, 32):
        pairs = [(i, i ^ s) for i in range(1, 32) if i < i ^ s]
        out[s] = [(1 << (i - 1)) | (1 << (j - 1)) for i, j in pairs]
    return out


FLIPS = _parity_columns()
MASKS = [np.uint64(sum(1 << (p - 1) for p in range(1, 32) if p >> b & 1)) for b in range(5)]


def anchors(fp: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(row, key, home) of all anchors of the fingerprints, for both halves."""
    rows, keys, home = [], [], []
    at = np.arange(len(fp))
    for half in (0, 1):
        v = (fp >> np.uint64(32 * half)) & np.uint64(0x7FFFFFFF)
        s = np.zeros(len(fp), np.int64)
        for b, m in enumerate(MASKS):
            s |= (np.bitwise_count(v & m).astype(np.int64) & 1) << b
        tag = np.uint64(half << 31)
        off = s > 0
        one = np.where(off, np.uint64(1) << np.maximum(s - 1, 0).astype(np.uint64), np.uint64(0))
        rows.append(at)
        keys.append((v ^ one) | tag)
        home.append(np.ones(len(fp), bool))
        rows.append(np.repeat(at[off], 15))
        keys.append(((v[off, None] ^ FLIPS[s[off]]) | tag).ravel())
        home.append(np.zeros(15 * int(off.sum()), bool))
    return np.concatenate(rows), np.concatenate(keys), np.concatenate(home)


def _replicate(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for b in batches:
        fp, rep = b.column(0).to_numpy().view(np.uint64), b.column(1).to_numpy()
        r, k, h = anchors(fp)
        yield pa.RecordBatch.from_arrays([pa.array(k.astype(np.int64)), pa.array(fp[r].view(np.int64)), pa.array(rep[r]), pa.array(h)], ["key", "fp", "rep", "home"])


def linked(group: np.ndarray, fp: np.ndarray, home: np.ndarray, most: int) -> np.ndarray:
    """For rows sorted by group: the least row of the links found within each group (itself if none)."""
    lab = np.arange(len(fp))
    i = lab
    step = 1
    while True:
        i = i[i + step < len(fp)]
        i = i[group[i] == group[i + step]]
        if not len(i):
            return lab
        j = i + step
        ok = (home[i] | home[j]) & (np.bitwise_count(fp[i] ^ fp[j]) <= most)
        a, b = i[ok], j[ok]
        while len(a):  # hook the larger root to the smaller, then flatten
            x, y = lab[a], lab[b]
            apart = x != y
            a, b, x, y = a[apart], b[apart], x[apart], y[apart]
            if not len(a):
                break
            np.minimum.at(lab, np.maximum(x, y), np.minimum(x, y))
            while True:
                up = lab[lab]
                if np.array_equal(up, lab):
                    break
                lab = up
        step += 1


def _compare(most: int, rows: int = 200_000):
    def close(parts: list[np.ndarray]) -> pa.RecordBatch:
        key, sub, fp, rep, home = (np.concatenate(x) for x in zip(*parts, strict=True))
        group = np.cumsum(np.r_[True, (key[1:] != key[:-1]) | (sub[1:] != sub[:-1])])
        lab = linked(group, fp.view(np.uint64), home, most)
        hit = lab != np.arange(len(lab))
        return pa.RecordBatch.from_arrays([pa.array(rep[hit]), pa.array(rep[lab[hit]])], ["a", "b"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        parts, n = [], 0
        for b in batches:
            if not b.num_rows:
                continue
            cols = [b.column(c).to_numpy(zero_copy_only=False) for c in range(5)]
            parts.append(cols)
            n += b.num_rows
            if n < rows:
                continue
            cols = [np.concatenate(x) for x in zip(*parts, strict=True)]
            tail = np.flatnonzero((cols[0] != cols[0][-1]) | (cols[1] != cols[1][-1]))
            cut = int(tail[-1]) + 1 if len(tail) else 0  # the last group may go on
            if cut:
                yield close([[c[:cut] for c in cols]])
            parts, n = [[c[cut:] for c in cols]], len(cols[0]) - cut
        if n:
            yield close(parts)

    return run


def links(distinct: DataFrame, most: int = 3, block: int = 20_000) -> DataFrame:
    """Spanning links (a, b) between the representatives of distinct fingerprints (fp, rep).

    An anchor with more than ``block`` fingerprints is dealt out as pairs of hashed blocks, so that no
    task holds more than about two blocks of one anchor and every pair still meets.
    """
    if most > 3:
        raise ValueError("the anchors cover at most three differing bits")
    rows = distinct.select("fp", "rep").mapInArrow(released(_replicate), "key long, fp long, rep long, home boolean")
    hot = rows.groupBy("key").agg(F.count("*").alias("n")).where(F.col("n") > block)
    hot = hot.select("key", F.ceil(F.col("n") / block).cast("int").alias("blocks"))
    dealt = rows.join(hot, "key", "left").withColumn("mine", F.pmod(F.xxhash64("fp"), F.coalesce("blocks", F.lit(1))).cast("int"))
    other = F.explode(F.sequence(F.lit(0), F.coalesce("blocks", F.lit(1)) - 1)).alias("other")
    pair = F.least("mine", "other").cast("long") * F.lit(1 << 31) + F.greatest("mine", "other")
    dealt = dealt.select("key", "fp", "rep", "home", "mine", other).select("key", pair.alias("sub"), "fp", "rep", "home")
    return dealt.repartition("key", "sub").sortWithinPartitions("key", "sub", "fp").mapInArrow(released(_compare(most)), "a long, b long").distinct()


def simhash_groups(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", shingle: int = 3, most: int = 3) -> DataFrame:
    """(id, fp, component): every document with its fingerprint and the least id linked to it.

    Documents without words have fingerprint zero and link like any other.  See ``frames.texts`` for
    null ids and repeated ids; an empty table gives an empty result.
    """
    fps = saved(fingerprints(docs, id_col, text_col, shingle))
    distinct = saved(fps.groupBy("fp").agg(F.min("id").alias("rep")))
    roots = components(links(distinct, most))
    named = distinct.join(roots, F.col("rep") == F.col("node"), "left").select("fp", F.coalesce("root", "rep").alias("component"))
    return fps.join(named, "fp").select("id", "fp", "component")


def keep_one(docs: DataFrame, shingle: int = 3, most: int = 3) -> DataFrame:
    """The rows of ``docs`` but for those that a document with a smaller id stands for."""
    gone = simhash_groups(docs, shingle=shingle, most=most).where("component <> id").select(F.col("id").alias("doc_id"))
    return docs.join(gone, "doc_id", "left_anti").select(docs.columns)
