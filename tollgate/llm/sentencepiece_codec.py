"""SentencePiece encoding and decoding on the Tokenizers library.

The model's protobuf is read field by field; normaliser, metaspace marker, scores or merges and byte
fallback are rebuilt as a ``tokenizers.Tokenizer``.  Batches are encoded on several threads, and every
text's ids are compared with SentencePiece's own, and with the text after decoding.
"""

from __future__ import annotations

import hashlib
import os
import re
import struct
import sys
from array import array
from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
import sentencepiece
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from tokenizers import Tokenizer, models, normalizers

from .frames import released, small_batches

MARK = "▁"

# Numbers of messages, fields and piece kinds of the format.
PIECES, TRAINER, NORMALIZER = 1, 2, 3
UNIGRAM, BPE = 1, 2
NORMAL, UNKNOWN, CONTROL, USER_DEFINED, UNUSED, BYTE = 1, 2, 3, 4, 5, 6


def fields(raw: bytes) -> Iterator[tuple[int, int | bytes]]:
    """(number, value) of a protobuf message: integers as such, all else as bytes."""
    at = 0

    def varint() -> int:
        nonlocal at
        value = shift = 0
        while True:
            byte = raw[at]
            at += 1
            value |= (byte & 127) << shift
            shift += 7
            if byte < 128:
                return value

    while at < len(raw):
        key = varint()
        kind = key & 7
        if kind == 0:
            yield key >> 3, varint()
            continue
        size = {1: 8, 5: 4}.get(kind) or varint()
        yield key >> 3, raw[at : at + size]
        at += size


@dataclass
class Model:
    pieces: list[tuple[str, float, int]] = field(default_factory=list)
    kind: int = UNIGRAM
    byte_fallback: bool = False
    charsmap: bytes = b""
    dummy_prefix: bool = True
    remove_extra: bool = True
    escape: bool = True

    @property
    def unknown(self) -> int:
        return next((i for i, p in enumerate(self.pieces) if p[2] == UNKNOWN), 0)


def parse(raw: bytes) -> Model:
    out = Model()
    for number, value in fields(raw):
        if number == PIECES:
            own = dict(fields(value))
            score = struct.unpack("<f", own[2])[0] if 2 in own else 0.0
            out.pieces.append((own.get(1, b"").decode(), score, own.get(3, NORMAL)))
        elif number == TRAINER:
            own = dict(fields(value))
            out.kind, out.byte_fallback = own.get(3, UNIGRAM), bool(own.get(35, 0))
        elif number == NORMALIZER:
            own = dict(fields(value))
            out.charsmap = own.get(2, b"")
            out.dummy_prefix, out.remove_extra, out.escape = (bool(own.get(n, 1)) for n in (3, 4, 5))
    return out


def merges(model: Model) -> list[tuple[str, str]]:
    """Every way to join two pieces to a third, the best third first."""
    ids = {p: i for i, (p, _, kind) in enumerate(model.pieces) if kind == NORMAL}
    found = []
    for piece, i in ids.items():
        for k in range(1, len(piece)):
            if piece[:k] in ids and piece[k:] in ids:
                found.append((-model.pieces[i][1], i, k))
    return [(model.pieces[i][0][:k], model.pieces[i][0][k:]) for _, i, k in sorted(found)]


def backend(model: Model) -> Tokenizer:
    """The model without normaliser and splitting, which ``Codec`` applies."""
    if any(kind == USER_DEFINED for *_, kind in model.pieces):
        raise ValueError("models with user-defined pieces aren't supported")
    unknown = model.pieces[model.unknown][0]
    if model.kind == UNIGRAM:
        return Tokenizer(models.Unigram([(p, s) for p, s, _ in model.pieces], unk_id=model.unknown, byte_fallback=model.byte_fallback))
    if model.kind == BPE:
        ids = {p: i for i, (p, *_) in enumerate(model.pieces)}
        return Tokenizer(models.BPE(ids, merges(model), unk_token=unknown, fuse_unk=True, byte_fallback=model.byte_fallback))
    raise ValueError(f"model type {model.kind} isn't supported")


def packed(ids: list[int]) -> bytes:
    """Ids as little-endian 32-bit integers."""
    out = array("i", ids)
    if sys.byteorder == "big":
        out.byteswap()
    return out.tobytes()


class Codec:
    """Encoder and decoder of one model, with SentencePiece beside them for parity.

    Where no piece goes on past a word's end, words are encoded by themselves, each once as long as it
    is among the last ``words`` different ones; the memory holds two such generations.  Ids are
    little-endian 32-bit integers.
    """

    def __init__(self, raw: bytes, threads: int, words: int = 200_000):
        os.environ["TOKENIZERS_PARALLELISM"] = "true" if threads > 1 else "false"
        os.environ["RAYON_NUM_THREADS"] = str(threads)
        self.model = parse(raw)
        self.fast = backend(self.model)
        self.own = sentencepiece.SentencePieceProcessor(model_proto=raw)
        self.words = words
        self.charsmap = normalizers.Precompiled(self.model.charsmap) if self.model.charsmap else None
        self.apart = all(MARK not in p.lstrip(MARK) for p, *_ in self.model.pieces)
        self.known: dict[str, bytes] = {}
        self.before: dict[str, bytes] = {}
        self.bytes_of = np.array([self._bytes(p, kind) for p, _, kind in self.model.pieces], object)

    def _bytes(self, piece: str, kind: int) -> bytes:
        if kind == BYTE:
            return bytes([int(piece[1:-1], 16)])
        if kind == CONTROL:
            return b""
        return " ⁇ ".encode() if kind == UNKNOWN else piece.replace(MARK, " ").encode()

    def normalise(self, text: str) -> str:
        if self.charsmap:
            text = self.charsmap.normalize_str(text)
        if self.model.remove_extra:
            text = re.sub(" {2,}", " ", text).strip(" ")
        if self.model.dummy_prefix and text:
            text = " " + text
        return text.replace(" ", MARK) if self.model.escape else text

    def split(self, text: str) -> list[str]:
        """Words with the marks before them; the whole text where pieces go on past a word's end."""
        if not self.apart:
            return [text] if text else []
        if 2 * MARK in text or "\0" in text:
            return re.findall(f"{MARK}+[^{MARK}]*|[^{MARK}]+", text)
        words = text.replace(MARK, "\0" + MARK).split("\0")
        return words if words[0] else words[1:]

    def encode(self, texts: list[str]) -> list[bytes]:
        """The ids of every text; words not yet known are encoded together, on several threads."""
        cut = [self.split(self.normalise(t)) for t in texts]
        if len(self.known) > self.words:
            self.known, self.before = {}, self.known
        new = []
        for w in set().union(*cut).difference(self.known):
            ids = self.before.get(w)
            if ids is None:
                new.append(w)
            else:
                self.known[w] = ids
        for word, e in zip(new, self.fast.encode_batch_fast(new, add_special_tokens=False), strict=True):
            self.known[word] = packed(e.ids)
        return [b"".join(map(self.known.__getitem__, words)) for words in cut]

    def reference(self, texts: list[str]) -> list[bytes]:
        """SentencePiece's own ids of whole texts, on one thread, which takes the least work."""
        return [i.astype("<i4", copy=False).tobytes() for i in self.own.encode(texts, out_type="numpy", num_threads=1)]

    def decode(self, ids: np.ndarray | list[int]) -> str:
        raw = b"".join(self.bytes_of[np.asarray(ids, np.int64)].tolist())
        if self.model.dummy_prefix and raw[:1] == b" ":
            raw = raw[1:]
        return raw.decode(errors="replace")


OUT = "id long, ids array<int>, n_tokens long, ids_sha256 string, parity boolean, round_trip boolean"


def encode(docs: DataFrame, model_file: str, id_col: str = "doc_id", text_col: str = "text", threads: int = 2, keep_ids: bool = True) -> DataFrame:
    """One row for each row of ``docs``: ids, their number and digest, parity and whether decoding restores the text.

    The digest is of the ids as little-endian 32-bit integers.  A null text is empty and has no ids; a
    null id stays null; a repeated row is encoded again.  Blanks that the model's normaliser changes
    make the round trip false.  The driver reads the model file, which travels with the tasks.
    """
    with open(model_file, "rb") as f:
        raw = f.read()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        codec = Codec(raw, threads)
        for whole in batches:
            for at in range(0, whole.num_rows, 256):
                b = whole.slice(at, 256)
                texts = b.column(1).to_pylist()
                found = codec.encode(texts)
                parity = [a == w for a, w in zip(found, codec.reference(texts), strict=True)]
                ids = [np.frombuffer(i, "<i4") for i in found]
                trip = [codec.decode(i) == t for i, t in zip(ids, texts, strict=True)]
                digest = [hashlib.sha256(i).hexdigest() for i in found]
                kept = pa.array(ids if keep_ids else [None] * len(ids), pa.list_(pa.int32()))
                n = pa.array([len(i) for i in ids], pa.int64())
                cols = [b.column(0), kept, n, pa.array(digest, pa.string()), pa.array(parity, pa.bool_()), pa.array(trip, pa.bool_())]
                yield pa.RecordBatch.from_arrays(cols, [c.split()[0] for c in OUT.split(", ")])

    small_batches(docs.sparkSession)
    return docs.select(F.col(id_col).cast("long").alias("id"), F.coalesce(F.col(text_col).cast("string"), F.lit("")).alias("text")).mapInArrow(released(run), OUT)


def decode(encoded: DataFrame, model_file: str, id_col: str = "id", ids_col: str = "ids") -> DataFrame:
    """(id, text) from (id, ids); null ids are an empty text."""
    with open(model_file, "rb") as f:
        raw = f.read()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        codec = Codec(raw, 1)
        for b in batches:
            yield pa.RecordBatch.from_arrays([b.column(0), pa.array([codec.decode(i or []) for i in b.column(1).to_pylist()], pa.string())], ["id", "text"])

    return encoded.select(F.col(id_col).alias("id"), F.col(ids_col).alias("ids")).mapInArrow(run, "id long, text string")
