"""Personal data: fixed patterns, and a semi-Markov conditional random field over whole spans.

The field scores candidate segments of up to ``LONGEST`` tokens as wholes: their shape, how many digits and
groups they hold, whether check digits fit, the words around them.  Dynamic programming over all ways to cut a
stretch of text into single outside tokens and typed segments, with weights for what follows what, gives
the likelihood in training, and boundaries and types together (Viterbi) in use; a segment is reported if its
posterior reaches ``SURE``.  A segment must hold an anchor (a digit, '@', or the word "dot"), so only the
stretches around anchors are worked on; elsewhere the best path is outside in any case.

It is trained here, by likelihood, on sentences made of words from a bounded sample of the corpus in which
invented personal data of many spellings, and numbers that are none, are planted.
"""

from __future__ import annotations

import random
import re
from collections.abc import Callable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .frames import texts

BASE_KINDS = ("email", "ip", "card", "phone")
TYPES = ("email", "ip", "card", "phone", "id", "iban", "birth")
KINDS = BASE_KINDS + tuple(f"crf_{t}" for t in TYPES)

#: The base patterns.  Lookbehinds and possessive repeats change no match, only save retries.
DOMAIN = re.compile(r"@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+")
LOCAL = frozenset("ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789._%+-")
IP = re.compile(r"(?<![0-9])[0-9]++(\.[0-9]++)(\.[0-9]++)(\.[0-9]++)")
CARD = re.compile(r"[0-9](?:[\x20-]?[0-9])+")
PHONE = re.compile(r"\+[0-9][\x20().0-9-]+[0-9]")

LONGEST = 14
#: Least posterior of a reported segment.
SURE = 0.9
#: Tokens decoded at once in a long stretch, and the tokens around them that are decoded with them.
BLOCK, MARGIN = 2_000, 10 * LONGEST

TOKEN = re.compile(r"[^\W\d_]+|[0-9]+|\S")
ANCHOR = re.compile(r"[0-9@]|(?i:\bdot\b)")
OPENERS, CLOSERS = frozenset("+("), frozenset(")")


def digits(text: str) -> str:
    return "".join(c for c in text if "0" <= c <= "9")


def luhn(number: str) -> bool:
    total = sum(int(c) if i % 2 == 0 else (int(c) * 2 - 9 if c > "4" else int(c) * 2) for i, c in enumerate(reversed(number)))
    return total % 10 == 0


def emails(text: str) -> Iterator[tuple[int, int]]:
    """Leftmost matches: from the earliest local character before an '@' that a domain follows."""
    done, at = 0, text.find("@")
    while at >= 0:
        m = DOMAIN.match(text, at)
        start = at
        while start > done and text[start - 1] in LOCAL:
            start -= 1
        if m and start < at:
            yield start, m.end()
            done = m.end()
        else:
            done = at + 1  # no later match reaches back over this '@'
        at = text.find("@", done)


def base_spans(text: str) -> list[tuple[str, int, int]]:
    """(kind, start, end) of the fixed patterns, by start and then kind."""
    found = [("email", s, e) for s, e in emails(text)]
    found += [("ip", *m.span()) for m in IP.finditer(text) if all(small(p) for p in m[0].split("."))]
    for m in CARD.finditer(text):
        number = digits(m[0]) if m.end() - m.start() <= 37 else ""  # 19 digits and 18 separators
        if 14 <= len(number) <= 19 and luhn(number):
            found.append(("card", *m.span()))
    found += [("phone", *m.span()) for m in PHONE.finditer(text) if 10 <= len(digits(m[0])) <= 15]
    return sorted(found, key=lambda x: (x[1], KINDS.index(x[0])))


def small(part: str) -> bool:
    """Whether a run of digits is at most 255, whatever its leading zeros."""
    part = part.lstrip("0")
    return len(part) <= 3 and int(part or 0) <= 255


# --- segments and their features

#: Words that announce a type, as they stand before it.
CUES = {
    "email": "mail|e-mail|email|contact|write to|reach me|correo|adresse",
    "ip": "ip|host|server|address|from|login from",
    "card": "card|visa|credit card|paid with|carte|tarjeta|kreditkarte",
    "phone": "tel|phone|call|mobile|fax|cell|ring|telefon|teléfono|téléphone",
    "id": "ssn|social security number|id number|passport|insurance",
    "iban": "iban|account|konto|transfer to|cuenta|compte",
    "birth": "born|born on|date of birth|dob|birthday|geboren am|né le|nacido el",
}
CUE_WORDS = {t: frozenset(re.findall(r"[^\W\d_]{2,}", said)) - {"is", "on", "to", "me", "le", "am", "el", "with", "from", "number", "of"} for t, said in CUES.items()}


def mod97(text: str) -> bool:
    """Check digits of an account number in the international form."""
    plain = "".join(c for c in text if c.isascii() and c.isalnum()).upper()
    if not 15 <= len(plain) <= 34 or not plain[:2].isalpha() or not plain[2:4].isdigit():
        return False
    return int("".join(str(int(c, 36)) for c in plain[4:] + plain[:4])) % 97 == 1


def shapes(text: str, tokens: list[tuple[int, int]]) -> list[str]:
    """Of each token: digits by their number, letters by whether they are long, else itself; a blank before it stays."""
    out, end = [], 0
    for a, b in tokens:
        c = text[a]
        if "0" <= c <= "9":
            said = str(min(b - a, 9))
        elif c.isalpha():
            said = low if (low := text[a:b].lower()) in ("at", "dot") else "A" if b - a < 3 else "W"
        else:
            said = c
        out.append(" " + said if a > end else said)
        end = b
    return out


#: Spellings of '@' and '.', and numbers of one to three digits, as one.
FOLDS = ((re.compile(r" ?[(\[]?(at|@)[)\]]? ?"), "@"), (re.compile(r" ?[(\[]?(dot|\.)[)\]]? ?"), "."), (re.compile(r"[AW][1-9]?"), "W"), (re.compile("[1-3]"), "n"))


def features(text: str, tokens: list[tuple[int, int]], forms: list[str], i: int, j: int) -> list[str]:
    """Features of the whole span of tokens i to j (j not included); ``forms`` are the tokens' shapes."""
    start, end = tokens[i][0], tokens[j - 1][1]
    form = "".join(forms[i:j]).lstrip(" ")
    groups = [text[a:b] for a, b in tokens[i:j] if "0" <= text[a] <= "9"]
    number = "".join(groups)
    words = form.count("W") + form.count("A")
    folded = form
    for pattern, to in FOLDS:
        folded = pattern.sub(to, folded)
    left = forms[i - 1].lstrip(" ") if i and tokens[i - 1][1] == start else ""
    right = "" if end == len(text) else "x" if text[end].isalnum() else text[end]
    after = forms[j][-1:] if j < len(tokens) else ""
    out = [
        "bias",
        f"shape {form[:40]}",
        f"folded {folded[:40]}",
        f"marks {''.join(sorted(set(form) - set('AWatdo123456789')))[:8]}",
        f"digits {min(len(number), 24)}",
        f"groups {min(len(groups), 12)} {words > 0}",
        f"words {min(words, 6)}",
        f"left {left}",
        f"right {right} {after if right in ' .,-/' else ''}",
        f"tight {' ' not in form}",
    ]
    before = {text[a:b].lower() for a, b in tokens[max(0, i - 3) : i]}
    out += [f"near {t} {folded[:12]}" if t == "birth" else f"near {t}" for t, cues in CUE_WORDS.items() if before & cues]
    if 13 <= len(number) <= 19 and not words:
        out.append(f"luhn {luhn(number)}")
    if words and len(number) > 9:
        out.append(f"mod97 {mod97(text[start:end])}")
    if len(groups) == 4:
        out.append(f"bytes {all(small(g) for g in groups)} {words > 0}")
    if len(groups) == 3 and len(number) < 9:
        out.append(f"date {any(1 <= int(x) <= 31 and 1 <= int(y) <= 12 and len(z) == 4 for x, y, z in (groups, groups[::-1]))}")
    if "@" in folded:
        out.append(f"mail {folded.count('.')} {folded[:1]}{folded[-1:]}")
    return out


def segments(text: str, tokens: list[tuple[int, int]], longest: int = LONGEST) -> list[tuple[int, int]]:
    """Candidate (i, j): tokens without wide gaps, with an anchor, at most one '@' and 24 digits, that
    begin and end with a letter, a digit or a bracket."""
    n = len(tokens)
    first = [text[a] for a, _ in tokens]
    solid = [c.isalnum() for c in first]
    out = []
    for i in range(n):
        a = tokens[i][0]
        if not (solid[i] or first[i] in OPENERS) or a and solid[i] and text[a - 1].isalnum():
            continue
        held = number = signs = 0
        for j in range(i + 1, min(n, i + longest) + 1):
            a, b = tokens[j - 1]
            if j - 1 > i and a - tokens[j - 2][1] and (a - tokens[j - 2][1] > 1 or text[a - 1] in "\n\r"):
                break
            if "0" <= first[j - 1] <= "9":
                number += b - a
                held = 1
            elif first[j - 1] == "@":
                signs += 1
                held = 1
            elif b - a == 3 and text[a:b].lower() == "dot":
                held = 1
            if number > 24 or signs > 1:
                break
            if held and (solid[j - 1] or first[j - 1] in CLOSERS) and not (b < len(text) and solid[j - 1] and text[b].isalnum()):
                out.append((i, j))
    return out


# --- the field


@dataclass
class Field:
    """``names`` numbers the features; ``weights`` has a row for each and one of zeros; ``follow`` scores label pairs (0: outside)."""

    names: dict[str, int]
    weights: np.ndarray
    follow: np.ndarray

    def rows(self, said: list[str]) -> list[int]:
        return [self.names[x] for x in said if x in self.names]


#: Log weight of what can't be.
NEVER = -1e30


def lse(x: np.ndarray, axis: int = 0) -> np.ndarray:
    top = x.max(axis)
    return top + np.log(np.exp(x - np.expand_dims(top, axis)).sum(axis))


def forward_backward(n: int, cuts: list[tuple[int, int]], scores: np.ndarray, follow: np.ndarray):
    """(log Z, posteriors of the segments by type, expected label pairs) over all ways to cut ``n`` tokens."""
    k = len(follow)
    ends: list[list[int]] = [[] for _ in range(n + 1)]
    starts: list[list[int]] = [[] for _ in range(n + 1)]
    for c, (i, j) in enumerate(cuts):
        ends[j].append(c)
        starts[i].append(c)
    step = np.exp(follow)
    ahead = np.full((n + 1, k), NEVER)  # by the label of what ends here
    ahead[0, 0] = 0.0
    into = np.empty((n + 1, k))  # log weight of everything before a segment of that label that starts here
    for t in range(n + 1):
        if t:
            ahead[t, 0] = into[t - 1, 0]
            if ends[t]:
                ahead[t, 1:] = lse(np.array([into[cuts[c][0], 1:] + scores[c] for c in ends[t]]))
        top = ahead[t].max()
        into[t] = top + np.log(np.exp(ahead[t] - top) @ step)
    total = float(lse(ahead[n]))
    behind = np.zeros((n + 1, k))
    pairs = np.zeros((k, k))
    post = np.zeros((len(cuts), k - 1))
    for t in range(n - 1, -1, -1):
        opened = np.full(k, NEVER)  # log weight of a segment of that label from here and all after it
        opened[0] = behind[t + 1, 0]
        if starts[t]:
            after = scores[starts[t]] + behind[[cuts[c][1] for c in starts[t]], 1:]
            opened[1:] = lse(after)
            post[starts[t]] = np.exp(into[t, 1:] + after - total)
        high, top = ahead[t].max(), opened.max()
        rest = np.exp(opened - top)
        pairs += np.outer(np.exp(ahead[t] - high), rest) * step * np.exp(high + top - total)
        behind[t] = top + np.log(step @ rest)
    return total, post, pairs


def best_path(n: int, cuts: list[tuple[int, int]], scores: np.ndarray, follow: np.ndarray) -> list[tuple[int, int]]:
    """(segment, type) of the best way to cut ``n`` tokens."""
    k = len(follow)
    best = np.full((n + 1, k), NEVER)
    best[0, 0] = 0.0
    back: list[list[tuple[int, int, int]]] = [[(0, 0, -1)] * k for _ in range(n + 1)]  # where it began, label before, segment
    ends: list[list[int]] = [[] for _ in range(n + 1)]
    for c, (_, j) in enumerate(cuts):
        ends[j].append(c)
    into, source = np.empty((n + 1, k)), np.empty((n + 1, k), int)
    for t in range(n + 1):
        if t:
            best[t, 0], back[t][0] = into[t - 1, 0], (t - 1, source[t - 1, 0], -1)
            for c in ends[t]:
                i = cuts[c][0]
                for y in np.flatnonzero(into[i, 1:] + scores[c] > best[t, 1:]) + 1:
                    best[t, y], back[t][y] = into[i, y] + scores[c, y - 1], (i, source[i, y], c)
        step = best[t][:, None] + follow
        into[t], source[t] = step.max(0), step.argmax(0)
    out, t, y = [], n, int(best[n].argmax())
    while t:
        before, label, c = back[t][y]
        if c >= 0:
            out.append((c, y - 1))
        t, y = before, int(label)
    return out[::-1]


def train(said: list[tuple[str, tuple[int, int, str] | None]], rounds: int = 8, rate: float = 0.35, decay: float = 2e-4) -> Field:
    """The field that fits sentences, each with the (start, end, type) of its one segment or None, by likelihood."""
    names: dict[str, int] = {}
    work = []
    for text, truth in said:
        tokens = [m.span() for m in TOKEN.finditer(text)]
        cuts = segments(text, tokens)
        forms = shapes(text, tokens)
        own = [[names.setdefault(x, len(names)) for x in features(text, tokens, forms, i, j)] for i, j in cuts]
        right = next((c for c, (i, j) in enumerate(cuts) if truth and (tokens[i][0], tokens[j - 1][1]) == truth[:2]), None)
        if truth and right is None:
            continue
        work.append((len(tokens), cuts, own, right, truth and TYPES.index(truth[2])))
    width = max((len(x) for w in work for x in w[2]), default=1)
    k = len(TYPES) + 1
    weights, follow = np.zeros((len(names) + 1, k - 1)), np.zeros((k, k))
    rows = [np.array([[*x, *[len(names)] * (width - len(x))] for x in w[2]], int).reshape(-1, width) for w in work]
    speed_w, speed_f = np.full_like(weights, 1e-8), np.full_like(follow, 1e-8)
    order = random.Random(1)
    places = list(range(len(work)))
    for _ in range(rounds):
        order.shuffle(places)
        for at in range(0, len(places), 16):
            grad_w, grad_f = -decay * weights, -decay * follow
            for p in places[at : at + 16]:
                n, cuts, _, right, label = work[p]
                scores = weights[rows[p]].sum(1)
                _, post, pairs = forward_backward(n, cuts, scores, follow)
                if right is not None:
                    post[right, label] -= 1
                np.add.at(grad_w, rows[p], -post[:, None, :])
                grad_f -= pairs
                grad_f += true_pairs(n, cuts, right, label, k)
            grad_w[-1] = 0
            speed_w += grad_w**2
            speed_f += grad_f**2
            weights += rate * grad_w / np.sqrt(speed_w)
            follow += rate * grad_f / np.sqrt(speed_f)
    return Field(names, weights, follow)


def true_pairs(n: int, cuts: list[tuple[int, int]], right: int | None, label: int | None, k: int) -> np.ndarray:
    """How often each label follows each in the labelled cut: one segment at most, outside before and after."""
    out = np.zeros((k, k))
    if right is None:
        out[0, 0] = n
        return out
    i, j = cuts[right]
    out[0, label + 1] += 1
    out[0, 0] += i + max(n - j - 1, 0)
    out[label + 1, 0] += j < n
    return out


# --- training sentences


def _group(rng: random.Random, *sizes: int) -> list[str]:
    return ["".join(rng.choices("0123456789", k=n)) for n in sizes]


def _card(rng: random.Random) -> list[str]:
    head = rng.choice("3456") + "".join(rng.choices("0123456789", k=14))
    number = next(head + c for c in "0123456789" if luhn(head + c))
    return [number[i : i + 4] for i in range(0, 16, 4)]


def _iban(rng: random.Random) -> str:
    land, body = rng.choice(["DE", "FR", "ES", "GB", "NL", "IT"]), "".join(rng.choices("0123456789", k=rng.choice([14, 18, 20])))
    check = 98 - int("".join(str(int(c, 36)) for c in body + land + "00")) % 97
    whole = f"{land}{check:02d}{body}"
    return " ".join(whole[i : i + 4] for i in range(0, len(whole), 4)) if rng.random() < 0.6 else whole


def _phone(rng: random.Random) -> str:
    g = lambda *n: _group(rng, *n)
    return rng.choice([
        lambda: "({}) {}-{}".format(*g(3, 3, 4)), lambda: "{}-{}-{}".format(*g(3, 3, 4)), lambda: "{}.{}.{}".format(*g(3, 3, 4)),
        lambda: "({}){}-{}".format(*g(3, 3, 4)), lambda: "1-{}-{}-{}".format(*g(3, 3, 4)), lambda: "0{} {} {} {} {}".format(*g(1, 2, 2, 2, 2)),
        lambda: "00{} {} {}".format(*g(2, 2, 7)), lambda: "0{}/{}".format(*g(2, 7)), lambda: "0{}.{}.{}.{}.{}".format(*g(1, 2, 2, 2, 2)),
    ])()


def _email(rng: random.Random, name: Callable[[], str]) -> str:
    at = rng.choice([" at ", " [at] ", "[at]", " (at) ", "(at)", " @ "])
    dot = rng.choice([" dot ", " [dot] ", "[dot]", " (dot) ", "(dot)"]) if at != " @ " else rng.choice([".", " . ", " dot "])
    own = name() + rng.choice(["", str(rng.randrange(99)), dot + name()])
    return own + at + name() + dot + rng.choice(["com", "org", "net", "de", "example" + dot + "com"])


def _date(rng: random.Random) -> str:
    d, m, y = rng.randrange(1, 29), rng.randrange(1, 13), rng.randrange(1930, 2012)
    return rng.choice([f"{d:02d}.{m:02d}.{y}", f"{d}/{m}/{y}", f"{y}-{m:02d}-{d:02d}", f"{d:02d}-{m:02d}-{y}"])


def _ip(rng: random.Random) -> str:
    return rng.choice(["[.]", " . ", " dot ", "(.)", "[dot]"]).join(str(rng.randrange(256)) for _ in range(4))


def _other(rng: random.Random, name: Callable[[], str]) -> str:
    """Numbers and signs that are no personal data."""
    g, r = lambda *n: _group(rng, *n), rng.randrange
    return rng.choice([
        lambda: str(r(1900, 2030)), lambda: f"${r(1, 999)},{r(100, 999)}.{r(10, 99)}", lambda: f"{r(99)}.{r(99)} EUR", lambda: f"v{r(9)}.{r(30)}.{r(9)}",
        lambda: f"{r(9)}.{r(30)}.{r(9)}", lambda: f"{r(24)}:{r(60):02d}", lambda: _date(rng), lambda: f"{r(100)}%", lambda: f"{r(50)}-{r(50, 99)}",
        lambda: f"pp. {r(100, 300)}-{r(300, 500)}", lambda: f"978-{r(9)}-{r(10, 99)}-{r(100000, 999999)}-{r(9)}", lambda: f"#{r(99999)}", lambda: "".join(g(r(1, 13))),
        lambda: f"{r(90)}.{r(10000)}, {r(90)}.{r(10000)}", lambda: " ".join(str(r(99)) for _ in range(r(2, 9))), lambda: "-".join(str(r(9)) for _ in range(r(2, 5))),
        lambda: f"{name()} @ {r(1, 12)}", lambda: f"@{name()}", lambda: f"a dot {name()}", lambda: f"the dot at {name()}", lambda: f"{name()}@{name()}",
        lambda: f"{r(9999)} {name()} {r(9999)}", lambda: "".join(rng.choices("0123456789abcdef", k=r(8, 40))), lambda: " ".join(g(4, 4)), lambda: " ".join(g(*[16] * r(1, 4))),
        lambda: f"{r(1, 99)},{r(100, 999)},{r(100, 999)}", lambda: f"{r(9)} x {r(9)}", lambda: f"({r(1, 40)})", lambda: f"[{r(1, 99)}]", lambda: f"{name()}{r(999)}",
        lambda: "-".join(g(5, 6, 7)), lambda: "/".join(g(2, 2)), lambda: f"{r(1, 99)} {r(100, 999)}",
    ])()


def sentences(words: list[str], number: int = 800, seed: int = 5) -> list[tuple[str, tuple[int, int, str] | None]]:
    """Training sentences of ``words``: in five of nine personal data is planted, in the others something else."""
    rng = random.Random(seed)
    words = words or ["word"]

    def name() -> str:
        letters = "".join(c for c in rng.choice(words) if c.isalpha())
        return letters.lower() if len(letters) > 1 else "name"

    make = {
        "email": lambda: _email(rng, name), "ip": lambda: _ip(rng), "phone": lambda: _phone(rng), "iban": lambda: _iban(rng), "birth": lambda: _date(rng),
        "card": lambda: rng.choice([".", "/", " - ", "_", ". "]).join(_card(rng)), "id": lambda: rng.choice(["-", " "]).join(_group(rng, 3, 2, 4)),
    }
    out: list[tuple[str, tuple[int, int, str] | None]] = []
    for _ in range(number):
        before, after = (" ".join(rng.choices(words, k=rng.randrange(1, 5))) for _ in range(2))
        if rng.random() < 5 / 9:
            kind = rng.choice(TYPES)
            if kind in ("birth", "id") or rng.random() < 0.4:
                before += " " + rng.choice(CUES[kind].split("|")) + rng.choice(["", ":", " is"])
            said = make[kind]()
            truth = (len(before) + 1, len(before) + 1 + len(said), kind)
        else:
            said, truth = _other(rng, name), None
            if rng.random() < 0.15:
                before += " " + rng.choice(rng.choice([*CUES.values()]).split("|"))
                truth = None if not re.fullmatch(r"[\d./-]{8,10}", said) else "drop"
        if truth != "drop":
            out.append((f"{before} {said}{rng.choice(['', ',', '.', ' '])} {after}".replace("  ", " ") if truth is None else f"{before} {said}{rng.choice(['', ',', '.'])} {after}", truth))
    return out


# --- use


def words_away(text: str, at: int, words: int, back: bool) -> int:
    """Where ``words`` words, and so at least as many tokens, before or after ``at`` lie between."""
    for _ in range(words + 1):
        if back:
            at = text.rfind(" ", 0, at)
            if at < 0:
                return 0
        else:
            at = text.find(" ", at + 1)
            if at < 0:
                return len(text)
    return at


def islands(text: str, longest: int = LONGEST) -> Iterator[list[tuple[int, int]]]:
    """The tokens of each stretch that reaches as far around anchors as a segment, and its context, can."""
    lo = hi = -1
    for m in ANCHOR.finditer(text):
        if m.start() >= hi:
            start = words_away(text, m.start(), longest + 3, True)
            if start >= hi:
                if hi >= 0:
                    yield [t.span() for t in TOKEN.finditer(text, lo, hi)]
                lo = start
        hi = max(hi, words_away(text, m.end() - 1, longest, False))
    if hi >= 0:
        yield [t.span() for t in TOKEN.finditer(text, lo, hi)]


def model_spans(field: Field, text: str, taken: list[tuple[str, int, int]], sure: float = SURE) -> list[tuple[str, int, int, float]]:
    """(kind, start, end, posterior) of the best path's sure segments that meet no span of ``taken``.

    A stretch of more than ``BLOCK`` tokens is decoded in blocks with ``MARGIN`` tokens around; each reports what
    starts in it.
    """
    out = []
    for stretch in islands(text):
        for own in range(0, len(stretch), BLOCK):
            first = max(0, own - MARGIN)
            tokens = stretch[first : own + BLOCK + MARGIN]
            cuts = segments(text, tokens)
            forms = shapes(text, tokens)
            scores = np.array([field.weights[field.rows(features(text, tokens, forms, i, j))].sum(0) for i, j in cuts])
            path = best_path(len(tokens), cuts, scores, field.follow) if cuts else []
            path = [(c, y) for c, y in path if own <= first + cuts[c][0] < own + BLOCK]
            if not path:
                continue
            post = forward_backward(len(tokens), cuts, scores, field.follow)[1]
            for c, y in path:
                s, e = tokens[cuts[c][0]][0], tokens[cuts[c][1] - 1][1]
                if post[c, y] >= sure and not any(a < e and b > s for _, a, b in taken):
                    out.append((f"crf_{TYPES[y]}", s, e, round(float(post[c, y]), 4)))
    return out


def scan_text(field: Field, raw: bytes | None) -> list[tuple[str, int, int, float | None]]:
    """(kind, start, end, posterior) in code points, by start and then kind; [] for null or empty."""
    text = (raw or b"").decode()
    if not ANCHOR.search(text):
        return []
    base = base_spans(text)
    found = [(*x, None) for x in base] + model_spans(field, text, base)
    return sorted(found, key=lambda x: (x[1], KINDS.index(x[0])))


def sample_words(docs: DataFrame, id_col: str, text_col: str, sample: int, words: int = 40) -> list[str]:
    """Some words of each of ``sample`` documents with the smallest id hashes, without digits and '@'.

    A bound on the hash leaves about four times as many documents, so that tasks hand little to the driver
    however many there are; in a corpus of a few thousand none is needed.
    """
    rows = docs.where(F.col(text_col).isNotNull() & F.col(id_col).isNotNull()).select(
        F.col(id_col).cast("long").alias("id"), F.substring(F.col(text_col).cast("string"), 1, 8 * words).alias("text")
    )
    rows = rows.withColumn("h", F.xxhash64("id"))
    number = docs.where(F.col(id_col).isNotNull()).count()
    if number > 16 * sample:
        rows = rows.where(F.col("h") < -(1 << 63) + (1 << 64) * 4 * sample // number)
    rows = rows.orderBy("h", "id", "text").limit(sample).collect()
    return sorted({w for r in rows for w in r["text"].split()[:words] if not ANCHOR.search(w)})


def fit(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", sample: int = 200) -> Field:
    """The field, trained on sentences of words from at most ``sample`` documents; the same rows give the same field."""
    return train(sentences(sample_words(docs, id_col, text_col, sample)))


def find_personal_data(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", sample: int = 200, field: Field | None = None) -> DataFrame:
    """(id, spans) of every document, with ``field`` or one fitted on a sample of at most ``sample`` documents.

    A span has its kind, start, end (code points) and, from the field, its posterior.  Segments that overlap a base
    span are not repeated.  See ``frames.texts`` for null texts, null ids and repeated ids.
    """
    field = field or fit(docs, id_col, text_col, sample)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        kind = pa.list_(pa.struct([("kind", pa.string()), ("start", pa.int32()), ("end", pa.int32()), ("posterior", pa.float64())]))
        for b in batches:
            spans = [[dict(zip(("kind", "start", "end", "posterior"), s, strict=True)) for s in scan_text(field, t)] for t in b.column(1).to_pylist()]
            yield pa.RecordBatch.from_arrays([b.column(0), pa.array(spans, kind)], ["id", "spans"])

    raw = texts(docs, id_col, text_col).select("id", F.col("text").cast("binary").alias("text"))
    return raw.mapInArrow(run, "id long, spans array<struct<kind: string, start: int, end: int, posterior: double>>")
