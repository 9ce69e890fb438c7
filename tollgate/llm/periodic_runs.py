"""Periodic runs of words, found on a Re-Pair grammar of each text.

A run is a stretch of words with smallest period q, at least ``LEAST_WORDS`` words and ``POWERS`` periods
long, that no neighbouring word extends.  Each text's word ids are compressed by Re-Pair: the most frequent
pair of symbols becomes a nonterminal, until no pair is left twice.  The smallest node of the derivation
that holds a whole run has its inner boundary inside that run, so it is enough to find, once for each
nonterminal, the runs that cross its boundary.  What is found is carried to all places where the nonterminal
is derived; pieces that a node's edge cut short are merged into the maximal interval of an ancestor.

Before that, texts are thinned without loss: any three consecutive words of a run occur at least three times in their
text, so stretches without such words hold no run.  Most texts have none and build no grammar.
"""

from __future__ import annotations

import hashlib
from collections import defaultdict
from collections.abc import Iterator
from heapq import heapify, heappop, heappush
from itertools import count

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .frames import released, texts

#: Least length of a run in words, and in periods.  Thinning rests on six words and four periods or more.
LEAST_WORDS = 6
POWERS = 4


class Grammar:
    """Nodes above the words: ``kids`` (left, right), ``at`` one place of each in the text, and ``size`` in words."""

    def __init__(self, words: list[int]):
        self.words = words
        self.raw = np.array(words, "<i4").tobytes()
        self.kids: list[tuple[int, int]] = []
        self.at: list[int] = []
        self.size: list[int] = []

    def add(self, left: tuple[int, int], right: tuple[int, int], at: int, size: int) -> int:
        """The number of a new node: nodes count down from -1, words are 0 and up."""
        self.kids.append((left, right))
        self.at.append(at)
        self.size.append(size)
        return -len(self.kids)

    def width(self, symbol: int) -> int:
        return 1 if symbol >= 0 else self.size[-symbol - 1]


def re_pair(words: list[int], stretches: list[tuple[int, int]]) -> tuple[Grammar, list[list[tuple[int, int]]]]:
    """The grammar of the stretches (start, end) of ``words``, and what each came down to as (symbol, place).

    The most frequent pair goes first, of equal ones the oldest, which keeps the nodes shallow.  Pairs never
    cross stretches.
    """
    g = Grammar(words)
    n = len(words)
    symbol, after, before = list(words), [-1] * n, [-1] * n
    places: dict[tuple[int, int], list[int]] = defaultdict(list)
    number: dict[tuple[int, int], int] = defaultdict(int)
    for lo, hi in stretches:
        for i in range(lo, hi - 1):
            after[i], before[i + 1] = i + 1, i
            pair = (words[i], words[i + 1])
            places[pair].append(i)
            number[pair] += 1
    age = count()
    heap = [(-c, next(age), pair) for pair, c in number.items() if c > 1]
    heapify(heap)
    while heap:
        c, _, pair = heappop(heap)
        if number[pair] != -c:  # other pairs have taken some of its places since
            if number[pair] > 1:
                heappush(heap, (-number[pair], next(age), pair))
            continue
        a, b = pair
        own = []
        for p in places.pop(pair):
            q = after[p]
            if symbol[p] == a and q >= 0 and symbol[q] == b and (not own or q != own[-1] and p != after[own[-1]]):
                own.append(p)
        number[pair] = 0
        if len(own) < 2:
            continue
        new = g.add(a, b, own[0], g.width(a) + g.width(b))
        fresh: dict[tuple[int, int], None] = {}
        for p in own:
            q = after[p]
            left, right = before[p], after[q]
            if left >= 0:
                number[(symbol[left], a)] -= 1
                places[(symbol[left], new)].append(left)
                number[(symbol[left], new)] += 1
                fresh[(symbol[left], new)] = None
            if right >= 0:
                number[(b, symbol[right])] -= 1
                places[(new, symbol[right])].append(p)
                number[(new, symbol[right])] += 1
                fresh[(new, symbol[right])] = None
                before[right] = p
            symbol[p], after[p] = new, right
            symbol[q] = after[q] = before[q] = None
            after[q] = before[q] = -1
        for pair in fresh:
            if number[pair] > 1:
                heappush(heap, (-number[pair], next(age), pair))
    left_over = []
    for lo, _ in stretches:
        row, p = [], lo
        while p >= 0:
            row.append((symbol[p], p))
            p = after[p]
        left_over.append(row)
    return g, left_over


def binarise(g: Grammar, row: list[tuple[int, int]]) -> int:
    """One node over a stretch's remaining symbols, joined in balanced pairs."""
    while len(row) > 1:
        row = [
            (g.add(row[i][0], row[i + 1][0], row[i][1], g.width(row[i][0]) + g.width(row[i + 1][0])), row[i][1]) if i + 1 < len(row) else row[i]
            for i in range(0, len(row), 2)
        ]
    return row[0][0]


def forward_runs(w: list[int], raw: bytes, lo: int, mid: int, hi: int, least: int, powers: int) -> list[tuple[int, int, int]]:
    """Runs (start, end, period) of w[lo:hi] that cover two periods or more from ``mid`` on.

    Such a run starts at ``mid`` with a square; squares of repeated roots belong to the run of the root.
    """
    found: list[tuple[int, int, int]] = []
    first, q = w[mid], 0
    while True:
        try:
            q = w.index(first, mid + q + 1, mid + (hi - mid) // 2 + 1) - mid
        except ValueError:
            break
        if w[mid + q - 1] != w[mid + 2 * q - 1] or any(q % p == 0 and e >= mid + 2 * q for _, e, p in found):
            continue
        if raw[4 * mid : 4 * (mid + q)] != raw[4 * (mid + q) : 4 * (mid + 2 * q)]:
            continue
        end = mid + 2 * q
        while end < hi and w[end] == w[end - q]:
            end += 1
        start = mid
        while start > lo and w[start - 1] == w[start - 1 + q]:
            start -= 1
        found.append((start, end, q))
    return [(s, e, q) for s, e, q in found if e - s >= max(least, powers * q)]


def crossing_runs(g: Grammar, mirror: tuple[list[int], bytes], node: int, least: int, powers: int) -> list[tuple[int, int, int]]:
    """The node's runs across its boundary, relative to its start: half of each lies on one side."""
    k = -node - 1
    lo, hi = g.at[k], g.at[k] + g.size[k]
    mid, n = lo + g.width(g.kids[k][0]), len(g.words)
    out = forward_runs(g.words, g.raw, lo, mid, hi, least, powers)
    out += [(n - e, n - s, q) for s, e, q in forward_runs(*mirror, n - hi, n - mid, n - lo, least, powers)]
    return [(s - lo, e - lo, q) for s, e, q in dict.fromkeys(out)]


def runs_of(words: list[int], stretches: list[tuple[int, int]], least: int = LEAST_WORDS, powers: int = POWERS) -> list[tuple[int, int, int]]:
    """Every run of ``words`` in the stretches, as (start, length, period) by start and then period."""
    g, left_over = re_pair(words, stretches)
    roots = [(binarise(g, row), lo) for row, (lo, _) in zip(left_over, stretches, strict=True)]
    back = words[::-1]
    mirror = (back, np.array(back, "<i4").tobytes())
    own = [crossing_runs(g, mirror, -k - 1, least, powers) if g.size[k] >= least else [] for k in range(len(g.kids))]
    holds: list[bool] = []  # whether a node or one below it has runs; children come before their parents
    for k, kids in enumerate(g.kids):
        holds.append(bool(own[k]) or any(x < 0 and holds[-x - 1] for x in kids))
    placed, todo = [], roots
    while todo:
        node, at = todo.pop()
        if node >= 0 or not holds[-node - 1]:
            continue
        k = -node - 1
        placed += [(q, at + s, at + e) for s, e, q in own[k]]
        left, right = g.kids[k]
        todo += [(left, at), (right, at + g.width(left))]
    whole: list[tuple[int, int, int]] = []
    for q, s, e in sorted(placed, key=lambda x: (x[0], x[1], -x[2])):
        if not (whole and whole[-1][0] == q and whole[-1][2] >= e):
            whole.append((q, s, e))
    return sorted((s, e - s, q) for q, s, e in whole)


def _mixed(ids: np.ndarray, owner: np.ndarray) -> np.ndarray:
    """A 64-bit name for the three words from each place on, and their text."""
    x = ids.astype(np.uint64)
    name = (x[:-2] * np.uint64(0x9E3779B97F4A7C15)) ^ (x[1:-1] * np.uint64(0xC2B2AE3D27D4EB4F) + (x[2:] << np.uint64(31)))
    name = (name ^ (name >> np.uint64(29))) * np.uint64(0xBF58476D1CE4E5B9)
    return (name + owner[:-2].astype(np.uint64) * np.uint64(0x94D049BB133111EB)) * np.uint64(0xD6E8FEB86659FD93)


def thinned(ids: np.ndarray, owner: np.ndarray, rounds: int = 3) -> dict[int, list[tuple[int, int]]]:
    """text: stretches (start, end) of ``ids`` where every three words occur three times in that text.

    ``owner`` says which text a word belongs to.  Names may collide, which only leaves more words in.
    """
    keep = np.ones(len(ids), bool)
    for turn in range(rounds):
        if len(ids) < LEAST_WORDS or not keep.any():
            return {}
        whole = keep[:-2] & keep[1:-1] & keep[2:] & (owner[:-2] == owner[2:])
        at = np.flatnonzero(whole)
        names = _mixed(ids, owner)[at]
        if turn == 0:  # a cheap look first
            slot = (names >> np.uint64(64 - 22)).astype(np.int64)
            often = np.bincount(slot, minlength=1 << 22)[slot] >= 3
            at, names = at[often], names[often]
        _, back, number = np.unique(names, return_inverse=True, return_counts=True)
        at = at[number[back] >= 3]
        keep = np.zeros(len(ids), bool)
        for k in range(3):
            keep[at + k] = True
        edge = np.flatnonzero(np.diff(np.concatenate([[0], keep.astype(np.int8), [0]])) | _starts(owner, keep))
        spans = [(a, b) for a, b in zip(edge[:-1].tolist(), edge[1:].tolist(), strict=True) if keep[a] and b - a >= LEAST_WORDS]
        keep[:] = False
        for a, b in spans:
            keep[a:b] = True
    out: dict[int, list[tuple[int, int]]] = defaultdict(list)
    for a, b in spans:
        out[int(owner[a])].append((a, b))
    return out


def _starts(owner: np.ndarray, keep: np.ndarray) -> np.ndarray:
    """Where a kept text begins right after another one, with a place for the end."""
    new = np.zeros(len(owner) + 1, np.int8)
    new[1:-1] = (owner[1:] != owner[:-1]) & keep[1:] & keep[:-1]
    return new


def runs_of_texts(split: list[list[bytes]], least: int = LEAST_WORDS, powers: int = POWERS) -> list[list[tuple[int, int, int]]]:
    """The runs of every text, given as its words."""
    sizes = np.array([len(x) for x in split], np.int64)
    number: dict[bytes, int] = defaultdict(count().__next__)
    ids = np.fromiter((number[w] for words in split for w in words), np.int64, int(sizes.sum()))
    owner = np.repeat(np.arange(len(split)), sizes)
    first = np.cumsum(sizes) - sizes
    out: list[list[tuple[int, int, int]]] = [[] for _ in split]
    for t, spans in thinned(ids, owner).items():
        base = int(first[t])
        words = ids[base : base + int(sizes[t])]
        out[t] = runs_of(words.tolist(), [(a - base, b - base) for a, b in spans], least, powers)
    return out


def without_repeats(words: list[bytes], runs: list[tuple[int, int, int]]) -> list[bytes]:
    """The words less those that a run contains after its first period."""
    if not runs:
        return words
    out, at = [], 0
    for s, e in sorted((s + q, s + n) for s, n, q in runs):
        if e > at:
            out += words[at : max(at, s)]
            at = e
    return out + words[at:]


RUN = pa.struct([("start", pa.int64()), ("length", pa.int64()), ("period", pa.int64())])
SCHEMA = "id long, n_words long, runs array<struct<start: bigint, length: bigint, period: bigint>>, collapsed string, collapsed_sha256 string"


def find_runs(
    docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", least: int = LEAST_WORDS, powers: int = POWERS, keep: bool = True
) -> DataFrame:
    """(id, n_words, runs, collapsed, collapsed_sha256) of every document.

    ``runs`` holds (start, length, period) in words, by start and then period; ``collapsed`` is the text
    with one period of each run left, its words joined by one blank (null without ``keep``).  A null, empty or
    blank text has no words and no runs.  See ``frames.texts`` for null ids and repeated ids.  A text is
    worked on as a whole by one task, in time near its length.
    """
    if least < LEAST_WORDS or powers < POWERS:
        raise ValueError(f"runs have {LEAST_WORDS} words and {POWERS} periods or more")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            split = [(x or b"").split() for x in b.column(1).to_pylist()]
            runs = runs_of_texts(split, least, powers)
            left = [b" ".join(without_repeats(w, r)) for w, r in zip(split, runs, strict=True)]
            yield pa.RecordBatch.from_arrays(
                [
                    b.column(0),
                    pa.array([len(w) for w in split], pa.int64()),
                    pa.array([[dict(zip(("start", "length", "period"), x, strict=True)) for x in r] for r in runs], pa.list_(RUN)),
                    pa.array([x.decode() for x in left], pa.string()) if keep else pa.nulls(len(left), pa.string()),
                    pa.array([hashlib.sha256(x).hexdigest() for x in left], pa.string()),
                ],
                ["id", "n_words", "runs", "collapsed", "collapsed_sha256"],
            )

    raw = texts(docs, id_col, text_col).select("id", F.col("text").cast("binary").alias("text"))
    return raw.mapInArrow(released(run), SCHEMA)
