"""Removal of repeated word passages by suffix automata of reference shards.

The reference of a document is all documents with smaller ids, so it has no size bound and isn't
broadcast whole.  It is cut into shards that can matter to each other: stretches around a shared gram of
words (see ``repeats``; a stretch that is a copy as a whole is settled before).  Each shard goes to one
task, in the order of ids, and there the documents stream through: a stretch's matching statistics
against the automaton of the earlier documents mark its windows, then the stretch extends the automaton.
A shard with too many stretches for one automaton is compared window by window in a sort instead.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .frames import saved, texts
from .repeats import BASES, COPY, OPEN, Later, Names, Powers, anchors, covered, marks, mix, per_document, twins, window_names

TWIN = 3
BLANKS = np.zeros(256, bool)
BLANKS[[9, 10, 11, 12, 13, 32]] = True
VALUES = np.random.default_rng(65).integers(0, 1 << 64, 256, np.uint64)


class Words:
    """From a text to one 64-bit name for each word."""

    def __init__(self):
        self.powers = Powers(BASES[1])

    def __call__(self, raw: bytes) -> np.ndarray:
        byte = np.frombuffer(raw, np.uint8)
        blank = np.r_[True, BLANKS[byte], True]
        start, end = np.flatnonzero(blank[:-1] & ~blank[1:]), np.flatnonzero(~blank[:-1] & blank[1:])
        if not len(start):
            return np.empty(0, np.uint64)
        return mix(Names(VALUES[byte], self.powers).of(start, end) ^ mix((end - start).astype(np.uint64)))


class SuffixAutomaton:
    """A generalised suffix automaton of sequences of integers."""

    def __init__(self):
        self.next: list[dict[int, int]] = [{}]
        self.link = [-1]
        self.size = [0]

    def _state(self, size: int, next_: dict[int, int], link: int) -> int:
        self.next.append(next_)
        self.link.append(link)
        self.size.append(size)
        return len(self.next) - 1

    def _split(self, p: int, x: int) -> int:
        """The state for the longest word of ``p`` and then ``x``, which ``p`` has a transition for."""
        q = self.next[p][x]
        if self.size[q] == self.size[p] + 1:
            return q
        twin = self._state(self.size[p] + 1, dict(self.next[q]), self.link[q])
        self.link[q] = twin
        while p >= 0 and self.next[p].get(x) == q:
            self.next[p][x] = twin
            p = self.link[p]
        return twin

    def add(self, sequence: list[int]) -> None:
        last = 0
        for x in sequence:
            if x in self.next[last]:
                last = self._split(last, x)
                continue
            new = self._state(self.size[last] + 1, {}, 0)
            p = last
            while p >= 0 and x not in self.next[p]:
                self.next[p][x] = new
                p = self.link[p]
            if p >= 0:
                self.link[new] = self._split(p, x)
            last = new

    def matches(self, sequence: list[int]) -> list[int]:
        """For each place, how many symbols up to and with it stand together in some added sequence."""
        state = size = 0
        out = []
        for x in sequence:
            while state and x not in self.next[state]:
                state = self.link[state]
                size = self.size[state]
            if x in self.next[state]:
                state = self.next[state][x]
                size += 1
            else:
                size = 0
            out.append(size)
        return out


def _stretches(length: int, gram: int):
    """From (id, text, at, names, crowded) to the stretches of open anchors, or their windows if crowded."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        words, powers = Words(), Powers(BASES[0])
        for b in batches:
            for i, raw, at, crowded in zip(*(b.column(c) for c in range(4)), strict=True):
                values = words(raw.as_py())
                a = anchors(values, length, gram, powers)
                at, many = at.values.to_numpy(), np.array(crowded.as_py())
                index = np.searchsorted(a.at, at)
                rows = [(int(a.name[r].view(np.int64)), 0, int(a.lo[r]), values[a.lo[r] : a.hi[r] + length].view(np.int64)) for r in index[~many]]
                for r in index[many]:
                    starts = np.arange(a.lo[r], a.hi[r] + 1)
                    one, two = window_names(values, length, words.powers, starts)
                    rows += [(int(x), int(y), int(s), None) for x, y, s in zip(one.view(np.int64), two.view(np.int64), starts, strict=True)]
                kinds = (pa.int64(), pa.int64(), pa.int64(), pa.list_(pa.int64()))
                one, two, start, said = (pa.array([r[j] for r in rows], t) for j, t in enumerate(kinds))
                yield pa.RecordBatch.from_arrays([one, two, pa.array(np.full(len(rows), i.as_py())), start, said], ["one", "two", "id", "start", "said"])

    return run


def _stream(length: int):
    """From stretches sorted by (one, id), then windows of crowded shards sorted by (one, two, id), to the
    windows (id, start) that an earlier document has."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        shard = owner = None
        automaton, waiting = SuffixAutomaton(), []
        later = Later(own_document=False)
        for b in batches:
            ids, starts = [], []
            whole = b.column("said").is_valid()
            for name, i, start, said in zip(*(b.filter(whole).column(c).to_pylist() for c in ("one", "id", "start", "said")), strict=True):
                if name != shard:
                    shard, owner, automaton, waiting = name, i, SuffixAutomaton(), []
                elif i != owner:  # a document doesn't match itself
                    for s in waiting:
                        automaton.add(s)
                    owner, waiting = i, []
                for end, size in enumerate(automaton.matches(said), start):
                    if size >= length:
                        ids.append(i)
                        starts.append(end - length + 1)
                waiting.append(said)
            one, two, i, start = (b.filter(b.column("said").is_null()).column(c).to_numpy() for c in ("one", "two", "id", "start"))
            out = later(one, two, i)
            ids, starts = (np.concatenate([np.array(x, np.int64), y[out]]) for x, y in ((ids, i), (starts, start)))
            yield pa.RecordBatch.from_arrays([pa.array(ids), pa.array(starts)], ["id", "start"])

    return run


def repeated(values: np.ndarray, kinds: np.ndarray, at: np.ndarray, length: int, gram: int, powers: Powers) -> np.ndarray:
    """Which words lie in a window that an earlier document has, from the marks of the document."""
    if (a := anchors(values, length, gram, powers)) is None:
        return np.zeros(len(values), bool)
    if TWIN in kinds:
        return np.ones(len(values), bool)
    copy = np.zeros(len(a.at), bool)
    copy[np.searchsorted(a.at, at[kinds == COPY])] = True
    dup = np.repeat(copy, a.hi - a.lo + 1)
    dup[at[kinds == OPEN]] = True
    for r in np.flatnonzero(a.first != np.arange(len(a.first))):  # what holds for the first of equals holds for all
        f = a.first[r]
        dup[a.lo[r] : a.hi[r] + 1] |= dup[a.lo[f] : a.hi[f] + 1]
    return covered(dup, length)


OUT = "id long, n_words long, n_removed long, kept_sha256 string, kept string"


def _cut(length: int, gram: int, keep: bool):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        words, powers = Words(), Powers(BASES[0])
        for b in batches:
            rows = []
            for i, raw, kinds, at in zip(*(b.column(c) for c in range(4)), strict=True):
                raw = raw.as_py()
                said = raw.split()
                gone = np.zeros(len(said), bool)
                if kinds.is_valid:
                    gone = repeated(words(raw), kinds.values.to_numpy(), at.values.to_numpy(), length, gram, powers)
                kept = b" ".join([w for w, g in zip(said, gone.tolist(), strict=True) if not g])
                rows.append((i.as_py(), len(said), int(gone.sum()), hashlib.sha256(kept).hexdigest(), kept.decode() if keep else None))
            kinds = (pa.int64(), pa.int64(), pa.int64(), pa.string(), pa.string())
            yield pa.RecordBatch.from_arrays([pa.array([r[j] for r in rows], t) for j, t in enumerate(kinds)], [c.split()[0] for c in OUT.split(", ")])

    return run


def remove_passages(docs: DataFrame, length: int = 13, gram: int = 5, crowd: int = 5_000, id_col: str = "doc_id", text_col: str = "text", keep: bool = True) -> DataFrame:
    """One row for each document: its words, how many are removed, and what is left, single-spaced.

    A word goes if a window of ``length`` words that covers it also starts in a document with a smaller
    id.  A null text has no words; texts shorter than a window stay whole; see ``frames.texts`` for null
    and repeated ids.  ``crowd``: most stretches in one automaton.  ``kept`` is null unless ``keep``.
    """
    corpus = texts(docs, id_col, text_col).select("id", F.col("text").cast("binary").alias("text"))
    parts = int(docs.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    dealt = corpus.repartition(parts, "id")  # read by both joins below, shuffled once
    found = saved(marks(corpus, Words(), length, gram))
    still = found.where(F.col("state") == OPEN)
    crowded = still.groupBy("name").agg(F.count("*").alias("n")).where(F.col("n") > crowd).select("name", F.lit(True).alias("crowded"))
    still = still.join(crowded, "name", "left").select("id", "at", F.coalesce("crowded", F.lit(False)).alias("crowded"))
    shards = dealt.join(per_document(still, "at", "crowded"), "id").mapInArrow(_stretches(length, gram), "one long, two long, id long, start long, said array<long>")
    shards = shards.repartition("one").sortWithinPartitions(F.isnull("said"), "one", "two", "id", "start")
    seen = shards.mapInArrow(_stream(length), "id long, start long")
    every = found.where(F.col("state") == COPY).select("id", F.lit(COPY).alias("kind"), F.col("at").cast("long").alias("at"))
    every = every.union(seen.select("id", F.lit(OPEN), "start")).union(twins(corpus).select("id", F.lit(TWIN), F.lit(0).cast("long")))
    whole = dealt.join(per_document(every, "kind", "at"), "id", "left")
    return whole.mapInArrow(_cut(length, gram, keep), OUT)
