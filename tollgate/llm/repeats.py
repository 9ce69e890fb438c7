"""Repeated windows of a fixed length, found by names at synchronising positions.

A text is a sequence of symbols, each a 64-bit value.  Among the ``length - gram + 1`` grams of a window
the one with the least hash is its anchor, the leftmost of equals; equal windows have equal anchors at
equal places.  So windows need comparing only where anchors have equal names:

1. every anchor, with the span of the windows it stands for, goes to the task of its gram's name;
2. of anchors with equal spans all but the first are copies; a name with one span only is settled;
3. the windows of what is left are named by the pair of their halves and compared one by one.

All of it is sorted, so a task holds one Arrow batch, however often a gram occurs.  Spans are told apart by
64 bits: of g different contexts of one gram about g ** 2 / 2 ** 65 pairs are taken for equal.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

BASES = (0x9E3779B97F4A7C15, 0xD1342543DE82EF95)  # 5 modulo 8, so that powers differ in nearly all bits
COPY, OPEN = 2, 1


def mix(x: np.ndarray) -> np.ndarray:
    """A one-to-one scrambling of 64-bit values."""
    x = (x ^ (x >> np.uint64(32))) * np.uint64(0xD6E8FEB86659FD93)
    x = (x ^ (x >> np.uint64(29))) * np.uint64(0xC2B2AE3D27D4EB4F)
    return x ^ (x >> np.uint64(32))


class Powers:
    """Powers of a base and of its inverse modulo 2 ** 64, as many as were asked for so far."""

    def __init__(self, base: int):
        self.base, self.inverse = base, pow(base, -1, 1 << 64)
        self.up = self.down = np.ones(1, np.uint64)

    def upto(self, n: int) -> tuple[np.ndarray, np.ndarray]:
        if len(self.up) < n:
            size = max(n, 2 * len(self.up))
            self.up, self.down = (np.cumprod(np.concatenate([[np.uint64(1)], np.full(size - 1, b, np.uint64)])) for b in (self.base, self.inverse))
        return self.up[:n], self.down[:n]


class Names:
    """Names of any span of a text's symbols, from prefix sums."""

    def __init__(self, values: np.ndarray, powers: Powers):
        n = len(values)
        up, self.down = powers.upto(n + 1)
        self.sums = np.zeros(n + 1, np.uint64)
        np.cumsum(values * up[:n], out=self.sums[1:])

    def of(self, start: np.ndarray | slice, end: np.ndarray | slice) -> np.ndarray:
        return mix((self.sums[end] - self.sums[start]) * self.down[start])

    def every(self, size: int) -> np.ndarray:
        n = len(self.sums) - size
        return self.of(slice(0, n), slice(size, size + n))


@dataclass
class Anchors:
    """Runs of windows [lo, hi] that share the anchor at ``at``; ``first`` is the first run of equals in the text."""

    at: np.ndarray
    lo: np.ndarray
    hi: np.ndarray
    name: np.ndarray
    span: np.ndarray
    first: np.ndarray


def anchors(values: np.ndarray, length: int, gram: int, powers: Powers) -> Anchors | None:
    """The anchors of a text; None if it is shorter than a window."""
    windows = len(values) - length + 1
    if windows < 1:
        return None
    names = Names(values, powers)
    grams = names.every(gram)
    width = length - gram + 1
    least = (mix(grams) & np.uint64(0xFFFFFFFF00000000)) | np.arange(len(grams), dtype=np.uint64)
    step = 1
    while 2 * step <= width:
        least = np.minimum(least[:-step], least[step:])
        step *= 2
    least = np.minimum(least[:windows], least[width - step : width - step + windows])
    at = (least & np.uint64(0xFFFFFFFF)).astype(np.int64)
    lo = np.flatnonzero(np.r_[True, at[1:] != at[:-1]])
    hi = np.r_[lo[1:], windows] - 1
    at = at[lo]
    shape = ((at - lo) << 32 | (hi - lo)).astype(np.uint64)
    span = mix(names.of(lo, hi + length) ^ mix(shape + np.uint64(1)))
    name = grams[at]
    both = np.stack([name, span], 1).view([("n", np.uint64), ("s", np.uint64)]).ravel()
    _, index, back = np.unique(both, return_index=True, return_inverse=True)
    return Anchors(at, lo, hi, name, span, index[back])


def window_names(values: np.ndarray, length: int, powers: Powers, starts: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The names of both halves of the windows at ``starts``."""
    names, half = Names(values, powers), length // 2
    return names.of(starts, starts + half), names.of(starts + half, starts + length)


def emit(symbols: Callable[[bytes], np.ndarray], length: int, gram: int):
    """Arrow function from (id, text) to (name, span, id, at): the distinct anchors of each text.

    Of equal texts in a batch only the one with the least id is looked at: the others are copies.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        powers = Powers(BASES[0])
        for b in batches:
            ids, texts = b.column(0).to_pylist(), b.column(1).to_pylist()
            least: dict[bytes, int] = {}
            for i, t in zip(ids, texts, strict=True):
                least[t] = min(i, least.get(t, i))
            cols: list[list[np.ndarray]] = [[], [], [], []]
            for t, i in least.items():
                if (a := anchors(symbols(t), length, gram, powers)) is None:
                    continue
                own = np.flatnonzero(a.first == np.arange(len(a.first)))
                for c, x in zip(cols, (a.name[own].view(np.int64), a.span[own].view(np.int64), np.full(len(own), i), a.at[own].astype(np.int32)), strict=True):
                    c.append(x)
            if cols[0]:
                yield pa.RecordBatch.from_arrays([pa.array(np.concatenate(c)) for c in cols], ["name", "span", "id", "at"])

    return run


def judge(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """From rows sorted by (name, span, id) to (name, id, at, state): COPY, or OPEN if its name has other spans."""
    held = None  # the last row that began a span, still without another span of its name
    last = None  # the row before this batch
    for b in batches:
        if not b.num_rows:
            continue
        name, span, ids, at = (b.column(c).to_numpy() for c in ("name", "span", "id", "at"))
        before_name = np.r_[name[:1] if last is None else last[:1], name[:-1]]
        before_span = np.r_[span[:1] if last is None else last[1:], span[:-1]]
        same_name, same_span = before_name == name, before_span == span
        if last is None:
            same_name[0] = same_span[0] = False
        copy = same_name & same_span
        new = np.flatnonzero(~copy)  # each begins a span
        later = same_name[new]  # of a name that has begun before
        follows = np.r_[later[1:], False]  # the next span has the same name
        state = np.where(copy, COPY, 0)
        state[new] = np.where(later | follows, OPEN, 0)
        out = state > 0
        yield pa.RecordBatch.from_arrays([pa.array(name[out]), pa.array(ids[out]), pa.array(at[out]), pa.array(state[out].astype(np.int32))], ["name", "id", "at", "state"])
        if len(new):
            if held is not None and later[0]:
                yield pa.RecordBatch.from_arrays([pa.array([held[0]]), pa.array([held[1]]), pa.array([held[2]], pa.int32()), pa.array([OPEN], pa.int32())], ["name", "id", "at", "state"])
            k = new[-1]
            held = None if state[k] else (int(name[k]), int(ids[k]), int(at[k]))
        last = np.array([name[-1], span[-1]])


class Later:
    """Marks rows, sorted by (one, two, id), that aren't the first of their name; keeps state between calls.

    Unless ``own_document``, rows of the first's document are passed over, too.
    """

    def __init__(self, own_document: bool):
        self.own_document, self.last = own_document, None

    def __call__(self, one: np.ndarray, two: np.ndarray, ids: np.ndarray) -> np.ndarray:
        if not len(one):
            return np.zeros(0, bool)
        carried = self.last is not None and (one[0], two[0]) == self.last[:2]
        same = np.r_[carried, (one[1:] == one[:-1]) & (two[1:] == two[:-1])]
        begin = np.maximum.accumulate(np.where(same, -1, np.arange(len(one))))
        first = np.where(begin < 0, self.last[2] if carried else ids[0], ids[begin])
        self.last = (one[-1], two[-1], first[-1])
        return same if self.own_document else ids != first


def marks(corpus: DataFrame, symbols: Callable[[bytes], np.ndarray], length: int, gram: int) -> DataFrame:
    """(name, id, at, state) of all anchors of a corpus (id, text: binary) that are copies or open."""
    found = corpus.mapInArrow(emit(symbols, length, gram), "name long, span long, id long, at int")
    found = found.repartition("name").sortWithinPartitions("name", "span", "id")
    return found.mapInArrow(judge, "name long, id long, at int, state int")


def twins(corpus: DataFrame) -> DataFrame:
    """(id) of every document whose whole text a smaller id has, too."""
    named = corpus.select("id", F.md5("text").alias("h"), F.length("text").alias("n"))
    first = named.groupBy("h", "n").agg(F.min("id").alias("first"))
    return named.join(first, ["h", "n"]).where("id <> first").select("id")


def per_document(rows: DataFrame, *cols: str) -> DataFrame:
    """(id, and an array of each of ``cols`` in the same order)."""
    own = rows.groupBy("id").agg(F.collect_list(F.struct(*cols)).alias("_rows"))
    return own.select("id", *[F.col(f"_rows.{c}").alias(c) for c in cols])


def covered(dup: np.ndarray, length: int) -> np.ndarray:
    """Which symbols lie in a window whose start is marked."""
    steps = np.zeros(len(dup) + length, np.int64)
    at = np.flatnonzero(dup)
    steps[at] += 1
    steps[at + length] -= 1
    return np.cumsum(steps)[:-1] > 0


