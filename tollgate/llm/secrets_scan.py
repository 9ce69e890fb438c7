"""Secret scan: fixed patterns, and zstandard novelty of strings in sensitive context.

A candidate is a long token outside the pattern matches with a sensitive word shortly before it; in ``NAME=value`` it is the
value, and the name is text before it.  Dotted tokens (as signed web tokens have) and wrapped ones (as key
files have) are tried whole first, with the context of their beginning.  Its novelty is what it adds
to the compressed size of the text around it, under a compressor primed with code
identifiers, as a share of what random characters of its own alphabet and length would add at the same place:
words and identifiers add little, random strings their full entropy, whatever the alphabet.
"""

from __future__ import annotations

import builtins
import importlib
import keyword
import random
import re
import string
import zlib
from bisect import bisect_left, bisect_right
from collections.abc import Iterator
from itertools import product

import numpy as np
import pandas as pd
import pyarrow as pa
import zstandard
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .frames import small_batches, texts

KINDS = ("assign", "access", "hex", "novel")

#: The base patterns and the least length of the group that counts.
ASSIGN = re.compile(r"""(?:(?i:password|passwd|secret|token|api_?key))["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", re.ASCII)
ACCESS = re.compile(r"AKIA[A-Z0-9]+")
HEX = re.compile(r"[0-9a-f]+")
LEAST = {"assign": 6, "access": 20, "hex": 24}

#: A text without any of these has no assignment.
KEYWORDS = (b"password", b"passwd", b"secret", b"token", b"apikey", b"api_key")

TOKEN = re.compile(r"[A-Za-z0-9+/_=-]{20,}")
#: What '=' parts in a token; only padding at its end stays with the part before.
PART = re.compile(r"[A-Za-z0-9+/_-]+(?:=+(?![A-Za-z0-9+/_=-]))?")
SENSITIVE = re.compile(r"(?i:auth|bearer|credential|private|pass|pwd|signature|access|session|cookie|key|token|secret|salt|cert|login)", re.ASCII)
#: Tokens joined by dots, and lines of a wrapped token; a last short line counts before the block's end mark.
DOTTED = re.compile(r"(?<![A-Za-z0-9_.-])[A-Za-z0-9_-]{8,}+(?:\.[A-Za-z0-9_-]{8,}+)+")
PARTS = re.compile(r"[^.]{20,}")
BREAK = r"(?:\\r)?\\n|\r?\n[ \t]*+"
WRAPPED = re.compile(rf"(?<![A-Za-z0-9+/])[A-Za-z0-9+/]{{40,}}+(?:(?:{BREAK})[A-Za-z0-9+/]{{40,}}+)*+(?:(?:{BREAK})[A-Za-z0-9+/]++(?==*+(?:{BREAK})-----END))?={{0,2}}")
#: What may stand between a fixed pattern's match and the rest of its dotted or wrapped token.
LEAD = re.compile(r"(?:\\[rn]|[\s.=])*")
#: Tokens that follow a sensitive word within so many characters are candidates.
REACH = 48
#: A key block's header reaches further, over the fields that may stand below it.
HEADER, HEADER_REACH = re.compile(r"-----BEGIN [A-Z0-9 ]*PRIVATE KEY"), 200
#: Characters on either side of a candidate that the compressor sees.
AROUND = 128
#: Least share of what random strings of the same alphabet add; those lie around 1, few of them below 0.92; nine in ten chains of
#: words that no dictionary has lie below 0.88.
NOVEL = 0.91
#: Random strings that a candidate is held against; their mean steadies the share of short ones.
DRAWS = 4

IN_TOKEN = np.zeros(256, bool)
IN_TOKEN[list(b"+/_=-0123456789ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz")] = True


#: Modules of Python's own library whose names stand for the identifiers of ordinary code.
NAMED = "argparse ast asyncio base64 calendar codecs collections configparser csv datetime decimal email.message functools hashlib hmac http.client inspect io json logging os os.path pathlib pickle random re secrets shutil socket sqlite3 ssl statistics string subprocess sys tempfile threading time types unittest urllib.parse urllib.request uuid xml.etree.ElementTree zipfile".split()


def identifiers() -> list[str]:
    """Code identifiers in the usual spellings, and the names of Python's own library, keywords and attributes."""
    verbs = "get set load read write make build parse find check update delete create send fetch open close handle".split()
    nouns = "user name value index config client server request response session table column file path buffer message token key access secret password private public signature certificate credential account service environment variable default example placeholder".split()
    snake = [f"{v}_{n}" for v, n in product(verbs, nouns)]
    camel = [v + n.capitalize() for v, n in product(verbs, nouns)]
    code = "import return function class const static final self this None null true false string integer boolean float void public private"
    known = {*keyword.kwlist, *dir(builtins)}
    for name in NAMED:
        module = importlib.import_module(name)
        known.update(dir(module))
        known.update(x for k in vars(module).values() if isinstance(k, type) for x in dir(k))
    library = sorted(x for x in known if not x.startswith("__") and len(x) > 3)
    return [*snake, *camel, *nouns, *code.split(), *library]


def compressor(size: int = 32768) -> zstandard.ZstdCompressor:
    """A compressor primed with a dictionary made from shuffled identifiers, always the same."""
    rng, words = random.Random(0), identifiers()
    lines = [" ".join(rng.choices(words, k=12)).encode() for _ in range(4000)]
    primer = zstandard.train_dictionary(size, lines)
    return zstandard.ZstdCompressor(level=12, dict_data=primer, write_content_size=False, write_checksum=False, write_dict_id=False)


ALPHABETS = (string.digits, "0123456789abcdef", "0123456789ABCDEF", string.ascii_uppercase + "234567")
CLASSES = (string.ascii_lowercase, string.ascii_uppercase, string.digits)


def like(rng: random.Random, candidate: str) -> str:
    """A random string of the candidate's length and alphabet: digits, hex or base 32; of others, every
    letter and digit is drawn from its own class and marks stay."""
    used = set(candidate)
    for pool in ALPHABETS:
        if used <= set(pool):
            return "".join(rng.choices(pool, k=len(candidate)))
    pools = {c: pool for pool in CLASSES for c in pool}
    return "".join(rng.choice(pools.get(c, c)) for c in candidate)


def novelty(size: zstandard.ZstdCompressor, candidate: str, before: str, after: str) -> float:
    """Marginal compressed bytes of the candidate against its surroundings, as a share of what random
    strings of its alphabet and length add there.

    Copies of the candidate nearby are left out of the surroundings: a secret said twice is as secret.
    The random strings depend on the candidate alone, so every run gives the same share.
    """
    rng = random.Random(zlib.crc32(candidate.encode()))
    others = [like(rng, candidate).encode() for _ in range(DRAWS)]
    own = drawn = 0
    # a few bytes more or less hang on whether the compressor packs literals; both sides, and each alone, steady that
    for around in (before + " " + after, before, after):
        context = around.replace(candidate, "").encode()
        alone = len(size.compress(context))
        own += len(size.compress(context + b" " + candidate.encode())) - alone
        drawn += sum(len(size.compress(context + b" " + x)) - alone for x in others)
    return DRAWS * own / max(1, drawn)


def long_run(raw: bytes, least: int) -> bool:
    """Whether ``raw`` has ``least`` token characters in a row."""
    if len(raw) < least:
        return False
    stops = np.flatnonzero(~IN_TOKEN[np.frombuffer(raw, np.uint8)])
    edges = np.concatenate([[-1], stops, [len(raw)]])
    return bool((np.diff(edges) > least).any())


def joined(spans: list[tuple[int, int]]) -> list[tuple[int, int]]:
    """The spans in order, those that overlap made one."""
    out: list[tuple[int, int]] = []
    for s, e in sorted(spans):
        if out and s < out[-1][1]:
            out[-1] = (out[-1][0], max(e, out[-1][1]))
        else:
            out.append((s, e))
    return out


def overlapping(spans: list[tuple[int, int]], start: int, end: int) -> list[tuple[int, int]]:
    """Those of ``joined`` spans that share a character with the interval."""
    first = bisect_right(spans, start, key=lambda x: x[1])
    return spans[first : bisect_left(spans, end, key=lambda x: x[0])]


def outside(start: int, end: int, spans: list[tuple[int, int]]) -> list[tuple[int, int]]:
    """What ``joined`` spans leave of an interval."""
    out = []
    for s, e in [*spans, (end, end)]:
        if start < s:
            out.append((start, s))
        start = max(start, e)
    return out


def scan_text(size: zstandard.ZstdCompressor, raw: bytes | None) -> list[tuple[str, int, int, float | None]]:
    """(kind, start, end, novelty) in code points, by start and then kind; [] for null or empty."""
    raw = raw or b""
    low = raw.lower()
    assigned = any(k in low for k in KEYWORDS)
    runs = long_run(raw, 20)
    if not (assigned or runs):
        return []
    text = raw.decode()
    found: list[tuple[str, int, int, float | None]] = []
    if assigned:
        found += [("assign", *m.span(), None) for m in ASSIGN.finditer(text) if len(m[1]) >= LEAST["assign"]]
    if runs:
        for kind, pattern in (("access", ACCESS), ("hex", HEX)):
            found += [(kind, *m.span(), None) for m in pattern.finditer(text) if m.end() - m.start() >= LEAST[kind]]
        found += novel_spans(size, text, [(s, e) for _, s, e, _ in found])
    return sorted(found, key=lambda x: (x[1], KINDS.index(x[0])))


def novel_spans(size: zstandard.ZstdCompressor, text: str, taken: list[tuple[int, int]]) -> list[tuple[str, int, int, float | None]]:
    """Novel strings in sensitive context that lie outside the spans ``taken``."""

    def sensitive(at: int) -> bool:
        return bool(SENSITIVE.search(text, max(0, at - REACH), at) or HEADER.search(text, max(0, at - HEADER_REACH), at))

    found: list[tuple[str, int, int, float | None]] = []

    def tried(s: int, e: int, parts: bool = False) -> bool:
        spans = [(s, e), *(p.span() for p in PARTS.finditer(text, s, e) if parts)]
        for x, y in spans:  # a dotted token with a part that is novel is novel
            new = novelty(size, text[x:y], text[max(0, x - AROUND) : x], text[y : y + AROUND])
            if new >= NOVEL:
                found.append(("novel", s, e, round(new, 4)))
                return True
        return False

    for pattern in (WRAPPED, DOTTED):
        busy = joined([*taken, *((s, e) for _, s, e, _ in found)])
        for m in pattern.finditer(text):
            if (pattern is DOTTED or "\n" in m[0] or "\\n" in m[0]) and sensitive(m.start()):
                for s, e in outside(*m.span(), overlapping(busy, *m.span())):
                    s = LEAD.match(text, s, e).end()
                    if e - s >= 20:
                        tried(s, e, pattern is DOTTED)
    busy = joined([*taken, *((s, e) for _, s, e, _ in found)])
    for m in TOKEN.finditer(text):
        own = overlapping(busy, *m.span())
        parts = [p.span() for p in PART.finditer(text, *m.span()) if p.end() - p.start() >= 20]
        hit = False
        for s, e in [*parts, m.span()]:
            if (s, e) == m.span() and hit:  # the whole token counts if none of its parts does
                break
            if any(x < e and y > s for x, y in own) or not sensitive(s):
                continue
            hit = tried(s, e) or hit
    return found


def _scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    kind = pa.list_(pa.struct([("kind", pa.string()), ("start", pa.int32()), ("end", pa.int32()), ("novelty", pa.float64())]))
    size = compressor()
    for b in batches:
        spans = [[dict(zip(("kind", "start", "end", "novelty"), s, strict=True)) for s in scan_text(size, t)] for t in b.column(1).to_pylist()]
        yield pa.RecordBatch.from_arrays([b.column(0), pa.array(spans, kind)], ["id", "spans"])


def find_secrets(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(id, spans) of every document; see ``frames.texts`` for null texts, null ids and repeated ids."""
    raw = texts(docs, id_col, text_col).select("id", F.col("text").cast("binary").alias("text"))
    return raw.mapInArrow(_scan, "id long, spans array<struct<kind: string, start: int, end: int, novelty: double>>")


def span_list(spans, kinds: tuple[str, ...]):
    """kind:start:end of the spans of these kinds, comma-joined."""
    own = F.filter(spans, lambda s: s["kind"].isin(*kinds))
    return F.array_join(F.transform(own, lambda s: F.concat_ws(":", s["kind"], s["start"].cast("string"), s["end"].cast("string"))), ",")


def n_of(spans, kind: str):
    return F.size(F.filter(spans, lambda s: s["kind"] == kind)).cast("long")


def redact_text(size: zstandard.ZstdCompressor, raw: bytes | None, mark: str = "[secret]") -> str | None:
    """The text with every span, overlapping ones together, replaced by ``mark``."""
    if raw is None:
        return None
    spans, text = scan_text(size, raw), raw.decode()
    out, at = [], 0
    for _, s, e, _ in spans:
        if s >= at:
            out += [text[at:s], mark]
        at = max(at, e)
    return "".join([*out, text[at:]])


def redact(docs: DataFrame, text_col: str = "text") -> DataFrame:
    """``docs`` with secrets replaced in every row's text and ``n_chars``, if there, set to match."""

    @F.pandas_udf("string")
    def run(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        size = compressor()
        for raw in batches:
            yield pd.Series([redact_text(size, x) for x in raw], dtype=object)

    small_batches(docs.sparkSession)
    out = docs.withColumn(text_col, run(F.col(text_col).cast("binary")))
    if "n_chars" in docs.columns:
        n = F.when(F.col("n_chars").isNotNull(), F.length(text_col)).cast(docs.schema["n_chars"].dataType)
        out = out.withColumn("n_chars", n)
    return out.select(docs.columns)
