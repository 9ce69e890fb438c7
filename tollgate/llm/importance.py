"""Importance resampling towards a target distribution, on hashed n-grams.

A text is folded to its words with single spaces between; a regular expression with lookarounds at the word
boundaries then scan it with overlapping matches: at each word's start the match is the word, and a look
ahead takes in the words after it, so the spans of all n-grams that start there come at once.  Each n-gram is
counted under its CRC-32, carried on from the shorter one's, modulo the number of buckets.  A bucket's gain is the log ratio of its
smoothed shares in the target and in the corpus; a document's weight is the sum over its features, and
the draw takes the highest weights with Gumbel noise, which samples without replacement by importance.

The corpus is scanned once: each document's buckets are written as 16-bit numbers, counted from there, and
weighed from there.  Only the counts, one row for each bucket, go through the driver.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator
from operator import methodcaller

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .frames import released, saved, small_batches, texts

#: Fixed values of the draw: longest n-gram, number of buckets, least words of a candidate, percent drawn, seed.
LONGEST, BUCKETS, LEAST_WORDS, PERCENT, SEED = 3, 10_000, 20, 5, 42

#: Bytes of words are kept, A-Z in lower case; any other ASCII byte parts words.
FOLD = bytes(c + 32 if 65 <= c <= 90 else c if 48 <= c <= 57 or 97 <= c <= 122 or c >= 128 else 32 for c in range(256))


def scanner(longest: int) -> regex.Pattern:
    """A word between boundaries, and as look-ahead groups each of the ``longest`` - 1 words after it with its blank."""
    return regex.compile(rb"(?<![^ ])([^ ]++)(?=%s)(?![^ ])" % (rb"( [^ ]++)?+" * (longest - 1)))


def buckets_of(raw: bytes, pattern: regex.Pattern, buckets: int) -> tuple[int, np.ndarray]:
    """The number of words, and the bucket of every n-gram, repeats included, by length and then place."""
    single = b" ".join(raw.translate(FOLD).split())
    spans = list(zip(*map(methodcaller("groups"), pattern.finditer(single, overlapped=True)), strict=True))
    if not spans:
        return 0, np.empty(0, "<u2")
    n, sums, found = len(spans[0]), None, []
    for k, words in enumerate(spans[:n]):  # the last k words have no k words after them
        sums = list(map(zlib.crc32, words[: n - k], sums)) if k else list(map(zlib.crc32, words))
        found += sums
    return n, (np.array(found, np.uint32) % np.uint32(buckets)).astype("<u2")


def features(rows: DataFrame, longest: int = LONGEST, buckets: int = BUCKETS) -> DataFrame:
    """(id, n_words, buckets) of rows (id, text: binary): the buckets as little-endian 16-bit numbers."""
    if not 0 < buckets <= 1 << 16:
        raise ValueError("buckets are numbered in 16 bits")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        pattern = scanner(longest)
        for b in batches:
            found = [buckets_of(x or b"", pattern, buckets) for x in b.column(1).to_pylist()]
            yield pa.RecordBatch.from_arrays(
                [b.column(0), pa.array([n for n, _ in found], pa.int64()), pa.array([x.tobytes() for _, x in found], pa.binary())],
                ["id", "n_words", "buckets"],
            )

    return rows.mapInArrow(released(run), "id long, n_words long, buckets binary")


def bucket_counts(found: DataFrame, buckets: int = BUCKETS) -> DataFrame:
    """(bucket, n) over all rows of ``features``: each task adds up its own and sends one row for each bucket."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(buckets, np.int64)
        for b in batches:
            for x in b.column(0).to_pylist():
                total += np.bincount(np.frombuffer(x, "<u2"), minlength=buckets)
        own = np.flatnonzero(total)
        yield pa.RecordBatch.from_arrays([pa.array(own, pa.int64()), pa.array(total[own], pa.int64())], ["bucket", "n"])

    return found.select("buckets").mapInArrow(run, "bucket long, n long").groupBy("bucket").agg(F.sum("n").alias("n"))


def gains(corpus: DataFrame, target: DataFrame, buckets: int = BUCKETS) -> DataFrame:
    """(bucket, gain) of every bucket, from two frames of ``bucket_counts``; thousandths, rounded down."""
    spark = corpus.sparkSession

    def full(counts: DataFrame, n: str, total: str) -> DataFrame:
        every = spark.range(buckets).withColumnRenamed("id", "bucket")
        out = every.join(counts.withColumnRenamed("n", n), "bucket", "left").fillna(0, [n])
        return out.join(F.broadcast(counts.agg(F.coalesce(F.sum("n"), F.lit(0)).alias(total))))  # one row

    smooth = F.lit(float(buckets))
    over = (F.col("t").cast("double") + 1) * (F.col("all_s").cast("double") + smooth)
    under = (F.col("s").cast("double") + 1) * (F.col("all_t").cast("double") + smooth)
    both = full(corpus, "s", "all_s").join(full(target, "t", "all_t"), "bucket")
    return both.select("bucket", F.floor(1000 * F.ln(over / under)).alias("gain"))


def weights(found: DataFrame, gain: np.ndarray) -> DataFrame:
    """(id, n_words, n_features, weight) of every row of ``features``."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            own = [np.frombuffer(x, "<u2") for x in b.column(2).to_pylist()]
            yield pa.RecordBatch.from_arrays(
                [
                    b.column(0),
                    b.column(1),
                    pa.array([len(x) for x in own], pa.int64()),
                    pa.array([int(gain[x].sum()) for x in own], pa.int64()),
                ],
                ["id", "n_words", "n_features", "weight"],
            )

    return found.mapInArrow(run, "id long, n_words long, n_features long, weight long")


def noise(id_col, seed: int = SEED):
    """Gumbel noise in thousandths, rounded down, from the hash of seed and id."""
    first = F.substring(F.sha2(F.concat(F.lit(f"{seed}:"), id_col.cast("string")), 256), 1, 8)
    h = F.conv(first, 16, 10).cast("double")
    return F.floor(-1000 * F.ln(-F.ln((h + 0.5) / 4294967296)))


def numbered(rows: DataFrame, order: list, name: str) -> DataFrame:
    """``rows`` with their place, from 1, in the whole order (which has no ties).

    A distributed sort; a row's place is its place in its sorted partition after the sizes of those before.
    Only the partitions' sizes go through the driver.
    """
    place = F.monotonically_increasing_id()
    cut = saved(rows.orderBy(*order).select("*", F.shiftright(place, 33).alias("_part"), place.bitwiseAND((1 << 33) - 1).alias("_place")))
    sizes = cut.groupBy("_part").agg(F.count("*").alias("n")).orderBy("_part").collect()
    before, ahead = 0, []
    for r in sizes:
        ahead.append((r["_part"], before))
        before += r["n"]
    ahead = rows.sparkSession.createDataFrame(ahead, "_part long, _ahead long")
    return cut.join(F.broadcast(ahead), "_part").select(*rows.columns, (F.col("_ahead") + F.col("_place") + 1).alias(name))


def resample(
    docs: DataFrame,
    target: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    target_col: str = "text",
    percent: int = PERCENT,
    least_words: int = LEAST_WORDS,
    longest: int = LONGEST,
    buckets: int = BUCKETS,
    seed: int = SEED,
) -> DataFrame:
    """(id, n_features, weight, score, rank) of every document; rank is null where it isn't drawn.

    Of the documents with ``least_words`` words or more, ``percent`` in a hundred (rounded down) are drawn: the
    highest scores, ties to the smaller id.  A null or empty text has no features and weight 0; an empty target
    leaves all shares to the smoothing.  Every row of the target counts, repeated ones too.  See ``frames.texts``
    for null ids and repeated ids of documents.
    """
    spark = docs.sparkSession
    small_batches(spark)
    own = texts(docs, id_col, text_col).select("id", F.col("text").cast("binary").alias("text"))
    found = saved(features(own, longest, buckets))
    wanted = target.select(F.lit(0).cast("long").alias("id"), F.col(target_col).cast("string").cast("binary").alias("text"))
    counts = saved(bucket_counts(found, buckets)), saved(bucket_counts(features(wanted, longest, buckets), buckets))
    gain = np.zeros(buckets, np.int64)
    for r in gains(*counts, buckets).collect():  # one row for each bucket
        gain[r["bucket"]] = r["gain"]
    weighed = saved(weights(found, gain).withColumn("score", F.col("weight") + noise(F.col("id"), seed)))
    able = F.col("n_words") >= least_words
    drawn = percent * weighed.where(able).count() // 100
    ranked = numbered(weighed.where(able), [F.desc("score"), "id"], "rank")
    ranked = ranked.withColumn("rank", F.when(F.col("rank") <= drawn, F.col("rank")))
    return ranked.unionByName(weighed.where(~able), allowMissingColumns=True).drop("n_words")


def draw(docs: DataFrame, target: DataFrame, id_col: str = "doc_id", **options) -> DataFrame:
    """The rows of ``docs`` whose documents ``resample`` draws, with all their columns."""
    taken = resample(docs, target, id_col, **options).where("rank is not null").select(F.col("id").alias("_drawn_id"))
    return docs.join(taken, docs[id_col].cast("long") == taken["_drawn_id"], "left_semi")
