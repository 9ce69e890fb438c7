"""Language-model scores by subword lattices.

A SentencePiece vocabulary's pieces span a lattice over each word; a word's probability is the sum over
all segmentations, by forward recursion in log space, and a text's is the product over its words and an
end.  Pieces of a unigram vocabulary weigh by their own scores.  A vocabulary of merges holds ranks
instead of log-probabilities, so its pieces weigh by their share of the training words' segmentations,
smoothed towards Zipf's law over the ranks.

Words are scored once each, whatever their number of occurrences, and the scores go to the documents by
chunks: each chunk of about ``chunk_bytes`` of text asks once for each of its distinct words.
"""

from __future__ import annotations

import math
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import sentencepiece
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .frames import saved, texts
from .sentencepiece_codec import BYTE, MARK, NORMAL, UNIGRAM, Model, parse

#: Words that one task counts before it hands the sums on.
FLUSH = 1_000_000
#: The weight of Zipf's law against training pieces, in pieces.
PRIOR = 1_000.0


def tokens(raw: bytes) -> list[bytes]:
    return raw.lower().split()


def held_out(id_col="id"):
    return F.crc32(F.col(id_col).cast("string").cast("binary")) % 10 == 0


@dataclass
class Pieces:
    """log10 weights: of pieces by text, of bytes, and of the end."""

    logs: dict[str, float]
    byte_logs: list[float]
    end: float
    longest: int


def weigh(model: Model, counts: dict[int, int], ends: int) -> Pieces:
    """The weights from a model, the counts of its pieces in training words and the training documents."""
    own = [i for i, (_, _, kind) in enumerate(model.pieces) if kind in (NORMAL, BYTE)]
    zipf = {i: 1 / (r + 3) for r, i in enumerate(sorted(own, key=lambda i: -model.pieces[i][1]))}
    # bytes that the corpus doesn't need come last; the end is as likely as the first piece
    scale = 1 / (sum(zipf.values()) + 1 / 3)
    total = sum(counts.get(i, 0) for i in own) + ends + PRIOR
    end = math.log10((ends + PRIOR * scale / 3) / total)
    if model.kind == UNIGRAM:
        rest = math.log10(1 - 10**end)
        log = {i: model.pieces[i][1] / math.log(10) + rest for i in own}
    else:
        log = {i: math.log10((counts.get(i, 0) + PRIOR * scale * zipf[i]) / total) for i in own}
    logs = {model.pieces[i][0]: x for i, x in log.items() if model.pieces[i][2] == NORMAL}
    bytes_ = {int(model.pieces[i][0][1:-1], 16): x for i, x in log.items() if model.pieces[i][2] == BYTE}
    floor = min(log.values(), default=0.0) - 3
    return Pieces(logs, [bytes_.get(b, floor) for b in range(256)], end, max(map(len, logs), default=1))


def word_score(word: str, pieces: Pieces) -> float:
    """log10 of the summed probability of all segmentations of the marked word."""
    text = MARK + word
    logs, longest = pieces.logs, pieces.longest
    forward = [0.0]
    for end in range(1, len(text) + 1):
        arcs = []
        for start in range(max(0, end - longest), end):
            p = logs.get(text[start:end])
            if p is not None:
                arcs.append(forward[start] + p)
        if text[end - 1] not in logs:  # a character without a piece is spelled in bytes
            arcs.append(forward[end - 1] + sum(pieces.byte_logs[b] for b in text[end - 1].encode()))
        best = max(arcs)
        forward.append(best + math.log10(sum(10 ** (a - best) for a in arcs)) if len(arcs) > 1 else best)
    return forward[-1]


def _count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """From (text, held_out) to (word, n): occurrences in training texts, 0 for words of others."""
    sums: Counter[bytes] = Counter()

    def flush() -> pa.RecordBatch:
        out = pa.RecordBatch.from_arrays([pa.array(list(sums), pa.binary()), pa.array(list(sums.values()), pa.int64())], ["word", "n"])
        sums.clear()
        return out

    for b in batches:
        for raw, held in zip(b.column(0).to_pylist(), b.column(1).to_pylist(), strict=True):
            if held:
                for w in set(tokens(raw)):
                    sums[w] += 0
            else:
                sums.update(tokens(raw))
            if len(sums) > FLUSH:
                yield flush()
    yield flush()


def _pieces(raw: bytes):
    """From (word, n) to (piece, n): pieces of the best segmentation, weighted."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = sentencepiece.SentencePieceProcessor(model_proto=raw)
        sums = np.zeros(own.get_piece_size(), np.int64)
        for b in batches:
            n = b.column(1).to_numpy()
            ids = own.encode([w.decode() for w in b.column(0).to_pylist()], num_threads=1)
            size = np.fromiter(map(len, ids), np.int64, len(ids))
            np.add.at(sums, np.fromiter((i for x in ids for i in x), np.int64, int(size.sum())), np.repeat(n, size))
        at = np.flatnonzero(sums)
        yield pa.RecordBatch.from_arrays([pa.array(at), pa.array(sums[at])], ["piece", "n"])

    return run


def _words_scored(pieces: tuple):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = Pieces(*pieces)
        for b in batches:
            score = [word_score(w.decode(), own) for w in b.column(0).to_pylist()]
            yield pa.RecordBatch.from_arrays([b.column(0), b.column(1), pa.array(score, pa.float64())], ["word", "n", "score"])

    return run


def _distinct(chunk: pa.Table) -> pa.Table:
    """The distinct words of a chunk of (chunk, id, text)."""
    found: set[bytes] = set()
    for raw in chunk.column("text").to_pylist():
        found.update(tokens(raw))
    first = chunk.column("chunk")[0].as_py()
    return pa.table({"chunk": pa.array([first] * len(found), pa.int64()), "word": pa.array(list(found), pa.binary())})


def _texts_scored(total: int, kinds: int, ends: int, end_score: float):
    """From a chunk's documents and its words' counts and scores to the documents' scores."""
    below = math.log10(total + 0.1 * (kinds + 1))
    end_base = math.log10(ends + 0.1) - below

    def run(docs: pa.Table, words: pa.Table) -> pa.Table:
        n = words.column("n").to_numpy()
        place = {w: i for i, w in enumerate(words.column("word").to_pylist())}
        base = np.log10(n + 0.1) - below
        score = words.column("score").to_numpy()
        rows = []
        for raw in docs.column("text").to_pylist():
            at = np.array([place[w] for w in tokens(raw)], np.int64)
            known = int((n[at] > 0).sum()) + (ends > 0)
            rows.append((len(at) + 1, known, math.fsum(base[at]) + end_base, math.fsum(score[at]) + end_score))
        cols = [pa.array([r[j] for r in rows], t) for j, t in enumerate((pa.int64(), pa.int64(), pa.float64(), pa.float64()))]
        return pa.table([docs.column("id"), *cols], ["id", "n_tokens", "n_known", "base_score", "score"])

    return run


def score_texts(docs: DataFrame, model_file: str, chunk_bytes: int = 24_000_000, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(id, held_out, n_tokens, n_known, train_tokens, base_score, score) of every document.

    Documents whose id's checksum is a multiple of ten are held out; the others are learnt from.  A null
    text has the end as its only token; with nothing to learn from, counts are zero and the weights are
    the vocabulary's own.  See ``frames.texts`` for null and repeated ids.
    """
    with open(model_file, "rb") as f:
        raw = f.read()
    model = parse(raw)
    corpus = texts(docs, id_col, text_col).select("id", F.col("text").cast("binary").alias("text"))
    sized = corpus.agg(F.sum(F.length("text")).alias("bytes"), F.count(F.when(~held_out(), 1)).alias("ends")).first()
    ends = sized["ends"]
    words = corpus.select("text", held_out().alias("held_out")).mapInArrow(_count, "word binary, n long")
    words = saved(words.groupBy("word").agg(F.sum("n").alias("n")))
    sums = words.agg(F.sum("n").alias("n"), F.count(F.when(F.col("n") > 0, 1)).alias("kinds")).first()
    total, kinds = (sums["n"] or 0) + ends, sums["kinds"] + (ends > 0)
    counts = words.where("n > 0").mapInArrow(_pieces(raw), "piece long, n long").groupBy("piece").agg(F.sum("n").alias("n"))
    weights = weigh(model, {r["piece"]: r["n"] for r in counts.collect()}, ends)  # at most the vocabulary's pieces
    scored = words.mapInArrow(_words_scored((weights.logs, weights.byte_logs, weights.end, weights.longest)), "word binary, n long, score double")

    chunks = max(1, math.ceil((sized["bytes"] or 0) / chunk_bytes))
    parts = int(docs.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    dealt = corpus.withColumn("chunk", F.pmod(F.xxhash64("id"), F.lit(chunks))).repartition(parts, "chunk")
    asked = dealt.groupBy("chunk").applyInArrow(_distinct, "chunk long, word binary")
    answers = asked.join(scored, "word").select("chunk", "word", "n", "score")
    out = dealt.groupBy("chunk").cogroup(answers.groupBy("chunk")).applyInArrow(
        _texts_scored(total, kinds, ends, weights.end), "id long, n_tokens long, n_known long, base_score double, score double"
    )
    return out.select("id", held_out().alias("held_out"), "n_tokens", "n_known", F.lit(total).cast("long").alias("train_tokens"), "base_score", "score")
