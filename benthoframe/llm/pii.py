"""Personal data: fixed patterns, and a linear-chain conditional random field over word shapes.

The patterns (e-mail, IP address, card and phone number) give the base spans. The field labels white-space separated
tokens with B/I tags of those kinds and of secrets (keys, passwords); its features are the shape of a token, its length and
characters, and what kind of token stands beside it. It is trained from a small labelled table, by default one made from
rules, and decoded by Viterbi over numpy batches of token runs of equal length. A token without digit, `@`, `+` or 20 ASCII letters
in a row is plain; the field allows it no tag but O, in training as in decoding, so only the runs between plain tokens need
decoding. A run of over `_PART` tokens is decoded in parts, with the same result, so its memory does not grow with its length. A span
of the field is kept if it overlaps no base span and passes the plain check of its kind.

Defined results: null text is empty and has no span; offsets are code points, end exclusive; other rows and
columns have no influence, so repeated rows give equal results.
"""

from __future__ import annotations

import hashlib
import random
import re
from collections.abc import Callable, Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

KINDS = ("email", "ip", "card", "phone", "secret")
#: More labelled tokens than this are refused: training holds them on the driver.
MAX_TOKENS = 50_000
Span = tuple[str, int, int]
#: Score of a tag or transition that the field rules out.
FORBIDDEN = -1e4

# --- base patterns -----------------------------------------------------------------------------------------------

# Possessive, and an address never begins inside a run of digits: linear in the text.
_LOCAL = re.compile(r"[A-Za-z0-9._%+-]")
_DOMAIN = re.compile(r"@[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)++")
_IP = re.compile(r"(?<![0-9])[0-9]++(?:\.[0-9]++){3}")
_CARD = re.compile(r"[0-9](?:[ -]?[0-9])++")
_PHONE = re.compile(r"\+[0-9][ ().0-9-]+[0-9]")
_DIGIT = re.compile(r"[0-9]")
_DIGITS = re.compile(r"[^0-9]+")


def luhn(digits: str) -> bool:
    odd = sum(map(int, digits[::-2]))
    return (odd + sum(sum(divmod(2 * int(d), 10)) for d in digits[-2::-2])) % 10 == 0


def _small(part: str) -> bool:
    part = part.lstrip("0")
    return len(part) <= 3 and int(part or 0) <= 255


def _emails(text: str) -> list[Span]:
    out, free, at = [], 0, text.find("@")
    while at >= 0:
        start = at
        while start > free and _LOCAL.match(text, start - 1):
            start -= 1
        found = _DOMAIN.match(text, at) if start < at else None
        if found:
            out.append(("email", start, found.end()))
            free = found.end()
        else:
            free = max(free, at + 1)
        at = text.find("@", at + 1)
    return out


def base_spans(text: str) -> list[Span]:
    """Leftmost non-overlapping matches of each kind that pass their check, by kind and start."""
    out = _emails(text)
    if not _DIGIT.search(text):
        return out
    out += [("ip", m.start(), m.end()) for m in _IP.finditer(text) if all(map(_small, m[0].split(".")))]
    for m in _CARD.finditer(text):
        digits = _DIGITS.sub("", m[0])
        if 13 <= len(digits) <= 19 and luhn(digits):
            out.append(("card", m.start(), m.end()))
    for m in _PHONE.finditer(text):
        if 9 <= len(_DIGITS.sub("", m[0])) <= 15:
            out.append(("phone", m.start(), m.end()))
    return out


# --- features ----------------------------------------------------------------------------------------------------

_SPECIAL = re.compile(r"[0-9@+]|[A-Za-z]{20,}")
_SWITCH = re.compile(r"[a-z][A-Z]|[A-Z]{2}[a-z]")
_PART = 4096  # tokens of a long run that are decoded at a time
_TOKEN = re.compile(r"[^\x20\x09-\x0d]+")
_WHITE = " \t\n\v\f\r"
_RUNS = [(re.compile(r"[A-Z]+"), "A"), (re.compile(r"[0-9]+"), "9"), (re.compile(r"[a-z\u0080-\U0010ffff]+"), "a")]
_TRIM_LEFT, _TRIM_RIGHT = "\"'<[{`", "\"'>]}`.,;:!?#*$%&|"


def shape(token: str) -> str:
    """Upper-case, lower-case and digit runs as one letter each."""
    token = token[:80]
    for pattern, letter in _RUNS:
        token = pattern.sub(letter, token)
    return token[:16]


def _bucket(n: int) -> int:
    return n if n < 12 else 12 + min(8, (n - 12) // 4)


def neighbour(token: str | None) -> str:
    if token is None:
        return "none"
    if not _SPECIAL.search(token):
        return "plain"
    return "plus" if token[0] == "+" else "bracket" if token[0] == "(" else "at" if "@" in token else "digits" if token.isdigit() else "special"


def features(token: str, before: str | None, after: str | None) -> list[str]:
    """Names of the features of a token between two others."""
    beside = [f"before={neighbour(before)}", f"after={neighbour(after)}"]
    if not _SPECIAL.search(token):
        return ["plain", *beside]
    core = token.strip(_TRIM_LEFT + _TRIM_RIGHT)
    digits = sum(c.isdigit() for c in core)
    hexed = len(core) >= 16 and not core.strip("0123456789abcdefABCDEF") and digits < len(core)
    mixed = len(core) >= 16 and core.isalnum() and 0 < digits < len(core)
    switches = min(len(_SWITCH.findall(core)), 6) if len(core) >= 16 else 0
    return [
        f"shape={shape(core)}", f"length={_bucket(len(core))}", f"digits={_bucket(digits)}", f"dots={min(core.count('.'), 4)}",
        f"dashes={min(core.count('-'), 4)}", f"hex={hexed}", f"mixed={mixed}", f"switches={switches}", f"at={'@' in core}", *beside,
    ]


# --- labelled table ----------------------------------------------------------------------------------------------


def labelled_tokens(sentences: int = 250, seed: int = 7) -> list[tuple[int, int, str, str]]:
    """A small labelled table made from rules: (sentence, position, token, tag), personal data and lookalikes among words."""
    rng = random.Random(seed)
    number = lambda n: "".join(rng.choice("0123456789") for _ in range(n))
    word = lambda: "".join(rng.choice("aeioulnrstmdg") for _ in range(rng.randint(2, 9))) + rng.choice(["", "", "", ",", "."])
    letters = lambda n, of: "".join(rng.choice(of) for _ in range(n))
    makers = {
        "email": lambda: [f"{letters(6, 'abcdeinorst')}{rng.choice(['', '.', '_'])}{number(rng.randint(0, 2))}@{letters(5, 'aeimlnst')}{rng.choice(['.', str(rng.randint(1, 9)) + '.'])}{rng.choice(['com', 'example.org', 'net'])}"],
        "ip": lambda: [".".join(str(rng.randint(0, 255)) for _ in range(4))],
        "card": lambda: rng.choice([[number(16)], [number(4) for _ in range(4)], ["-".join(number(4) for _ in range(4))], [number(15)]]),
        "phone": lambda: rng.choice([
            [f"+{rng.randint(1, 99)}", f"({number(3)})", f"{number(3)}-{number(4)}"], [f"({number(3)})", f"{number(3)}-{number(4)}"],
            [f"{number(3)}-{number(3)}-{number(4)}"], [f"+{number(2)}", number(3), number(7)], [f"+{number(11)}"],
        ]),
        "secret": lambda: [rng.choice(["", '"']) + rng.choice([letters(rng.choice([32, 40]), "0123456789abcdef"), letters(rng.randint(20, 36), "ABCDEFGHKabcdefgh0123456789"), letters(rng.randint(20, 36), "ABCDEFGHKMRSTXZabcdefghkmrstxz")]) + rng.choice(["", '"'])],
        "": lambda: rng.choice([
            [number(rng.randint(1, 8))], [f"{number(1)}.{number(1)}"], [f"{number(4)}-{number(2)}-{number(2)}"], [f"{number(2)}:{number(2)}"],
            [f"{number(2)},{number(3)}"], [f"v{number(1)}.{number(1)}.{number(1)}"], [f"#{number(3)}"], [f"{number(2)}%"], [letters(5, "aeinrst") + number(2)],
            ["@" + letters(5, "aeinrst")], ["a+b"], [f"{number(2)}.{number(2)}.{number(4)}"], [number(24)], [letters(rng.randint(20, 30), "aeinrstdlu")], [letters(1, "ABDEGS") + letters(rng.randint(20, 30), "aeinrstdlu")], [letters(24, "ABDEGRSTU")], [f"({number(1)})"], [f"{number(3)}-{number(2)}"],
        ]),
    }
    rows = []
    for s in range(sentences):
        tokens = []
        for _ in range(rng.randint(1, 3)):
            tokens += [(word(), "O") for _ in range(rng.randint(0, 5))]
            kind = rng.choice([*KINDS, "", ""])
            made = makers[kind]()
            if rng.random() < 0.3:
                made[-1] += rng.choice([".", ",", ";", "!"])
            tokens += [(t, f"{'I' if i else 'B'}-{kind}" if kind else "O") for i, t in enumerate(made)]
        tokens += [(word(), "O") for _ in range(rng.randint(0, 4))]
        rows += [(s, i, t, tag) for i, (t, tag) in enumerate(tokens)]
    return rows


def labelled_table(spark: SparkSession) -> DataFrame:
    return spark.createDataFrame(labelled_tokens(), "sentence long, position int, token string, tag string")


# --- the field ---------------------------------------------------------------------------------------------------


def _logsum(x: np.ndarray, axis: int) -> np.ndarray:
    top = x.max(axis=axis, keepdims=True)
    return np.squeeze(top, axis) + np.log(np.exp(x - top).sum(axis=axis))


class Field:
    """Weights of features by tag, and of tag pairs; tag 0 is O, which also stands before and after a sequence."""

    def __init__(self, kinds: tuple[str, ...] = KINDS):
        self.tags = ["O", *(f"{x}-{k}" for k in kinds for x in "BI")]
        self.index: dict[str, int] = {}
        self.weight = np.zeros((0, len(self.tags)))
        self.step = np.zeros((len(self.tags), len(self.tags)))
        self.allowed = np.zeros_like(self.step)
        for j, tag in enumerate(self.tags):
            if tag[0] == "I":  # only after B or I of its kind
                self.allowed[:, j] = FORBIDDEN
                self.allowed[[j - 1, j], j] = 0

    def train(self, sentences: list[tuple[list[str], list[str]]], epochs: int = 60, rate: float = 0.2, l2: float = 1e-3) -> Field:
        """Adam on the mean negative log likelihood of all sentences at once."""
        tag_no = {t: i for i, t in enumerate(self.tags)}
        length = max((len(t) for t, _ in sentences), default=0)
        rows = []
        for tokens, _ in sentences:
            around = [None, *tokens, None]
            rows.append([[self.index.setdefault(f, len(self.index)) for f in features(*around[i + 1 : i + 2], around[i], around[i + 2])] for i in range(len(tokens))])
        if not rows:
            return self
        n, s, most = len(rows), len(self.tags), max(len(f) for r in rows for f in r)
        plain = np.array([[j < len(t) and not _SPECIAL.search(t[j]) for j in range(length)] for t, _ in sentences])
        hard = np.zeros((n, length, s))
        hard[plain, 1:] = FORBIDDEN
        none = len(self.index)  # a feature of weight 0 fills up
        x = np.full((n, length, most), none)
        y, mask = np.zeros((n, length), int), np.zeros((n, length), bool)
        for i, (r, (_, tags)) in enumerate(zip(rows, sentences)):
            for j, f in enumerate(r):
                x[i, j, : len(f)] = f
                y[i, j], mask[i, j] = tag_no[tags[j]], True
        w, t = np.zeros((none + 1, s)), np.zeros((s, s))
        moments = [[np.zeros_like(v), np.zeros_like(v)] for v in (w, t)]
        one = np.eye(s)
        for epoch in range(1, epochs + 1):
            e, step = w[x].sum(2) + hard, t + self.allowed
            a = np.zeros((n, length, s))
            b = np.zeros((n, length, s))
            a[:, 0] = e[:, 0] + step[0]
            for j in range(1, length):
                a[:, j] = np.where(mask[:, j, None], _logsum(a[:, j - 1, :, None] + step, 1) + e[:, j], a[:, j - 1])
            last = mask.sum(1) - 1
            z = _logsum(a[np.arange(n), last] + step[:, 0], 1)
            b[np.arange(n), last] = step[:, 0]
            for j in range(length - 2, -1, -1):
                following = _logsum(step[None] + (e[:, j + 1] + b[:, j + 1])[:, None, :], 2)
                b[:, j] = np.where((j < last)[:, None], following, b[:, j])
            p = np.exp(np.minimum(a + b - z[:, None, None], 0)) * mask[..., None]
            node = (one[y] * mask[..., None]) - p
            gw, gt = np.zeros_like(w), np.zeros_like(t)
            np.add.at(gw, x.reshape(-1), np.repeat(node.reshape(-1, s), most, axis=0))
            gt[0] += node[:, 0].sum(0)
            end = np.zeros((n, s))
            end += one[y[np.arange(n), last]] - p[np.arange(n), last]
            gt[:, 0] += end.sum(0)
            for j in range(1, length):
                m = mask[:, j]
                pair = np.exp(np.minimum(a[m, j - 1, :, None] + step + (e[m, j] + b[m, j])[:, None, :] - z[m, None, None], 0))
                gt += np.einsum("na,nb->ab", one[y[m, j - 1]], one[y[m, j]]) - pair.sum(0)
            for value, grad, (m1, m2) in zip((w, t), (gw, gt), moments):
                grad = grad / n - l2 * value
                m1 += 0.1 * (grad - m1)
                m2 += 0.01 * (grad**2 - m2)
                value += rate * (m1 / (1 - 0.9**epoch)) / (np.sqrt(m2 / (1 - 0.99**epoch)) + 1e-8)
            w[none] = 0
        self.weight, self.step = w[:-1], t
        return self

    def emissions(self, tokens: list[str], before: str | None, after: str | None) -> np.ndarray:
        around, out = [before, *tokens, after], np.zeros((len(tokens), len(self.tags)))
        for i, token in enumerate(tokens):
            known = [self.index[f] for f in features(token, around[i], around[i + 2]) if f in self.index]
            out[i] = self.weight[known].sum(0)
            if not _SPECIAL.search(token):
                out[i, 1:] += FORBIDDEN
        return out

    def viterbi(self, e: np.ndarray) -> np.ndarray:
        """Best tags of sequences of equal length (sequences, tokens, tags)."""
        step = self.step + self.allowed
        n, length, _ = e.shape
        value, back = e[:, 0] + step[0], []
        for j in range(1, length):
            options = value[:, :, None] + step
            back.append(options.argmax(1))
            value = options.max(1) + e[:, j]
        tag = (value + step[:, 0]).argmax(1)
        out = [tag]
        for pointers in reversed(back):
            tag = pointers[np.arange(n), tag]
            out.append(tag)
        return np.stack(out[::-1], 1)


def train_field(labelled: DataFrame) -> Field:
    """Train from a table (sentence, position, token, tag) of at most `MAX_TOKENS` rows; rows with nulls teach nothing."""
    rows = labelled.select("sentence", "position", "token", "tag").dropna().limit(MAX_TOKENS + 1).collect()
    if len(rows) > MAX_TOKENS:
        raise ValueError(f"more than {MAX_TOKENS} labelled tokens")
    sentences: dict[int, tuple[list[str], list[str]]] = {}
    for r in sorted(rows, key=lambda r: (r.sentence, r.position)):
        tokens, tags = sentences.setdefault(r.sentence, ([], []))
        tokens.append(r.token)
        tags.append(r.tag)
    return Field().train(list(sentences.values()))


def _runs(text: str, most: int = _PART) -> Iterator[tuple[list[tuple[int, int]], bool]]:
    """Runs of adjoining tokens to decode, those with a digit, `@`, `+` or 20 letters, in parts; whether the run goes on."""
    run: list[tuple[int, int]] = []
    end = -1
    for m in _SPECIAL.finditer(text):
        if m.start() < end:
            continue
        start = m.start()
        while start > 0 and text[start - 1] not in _WHITE:
            start -= 1
        token = _TOKEN.match(text, start)
        adjoins = run and not text[end:start].strip(_WHITE)
        if run and (not adjoins or len(run) >= most):
            yield run, bool(adjoins)
            run = []
        run.append(token.span())
        end = token.end()
    if run:
        yield run, False


def _beside(text: str, run: list[tuple[int, int]]) -> tuple[str | None, str | None]:
    end = run[0][0]
    while end > 0 and text[end - 1] in _WHITE:
        end -= 1
    start = end
    while start > 0 and text[start - 1] not in _WHITE:
        start -= 1
    following = _TOKEN.search(text, run[-1][1])
    return (text[start:end] or None), (following[0] if following else None)


def _passes(kind: str, found: str) -> bool:
    """The plain check of a span that the field proposes."""
    digits = _DIGITS.sub("", found)
    if kind == "card":
        return 13 <= len(digits) <= 19 and luhn(digits)
    if kind == "ip":
        parts = found.split(".")
        return len(parts) == 4 and all(p.isdigit() and p.isascii() and _small(p) for p in parts)
    if kind == "phone":
        return 7 <= len(digits) <= 15 and not re.search(r"[^0-9+(). -]", found) and bool(re.search(r"[-+()]", found))
    if kind == "email":
        return bool(re.fullmatch(r"[^@\s]+@[^@\s]+\.[^@\s]+", found))
    return len(found) >= 16 and (0 < len(digits) < len(found) or not digits and len(_SWITCH.findall(found)) >= 3)


class _LongRun:
    """Viterbi over a run in parts. Only the values before each part are kept; the way back computes the parts again."""

    def __init__(self, text: str, field: Field):
        self.text, self.field, self.step = text, field, field.step + field.allowed
        self.parts: list[tuple[int, int, np.ndarray | None]] = []
        self.value: np.ndarray | None = None

    def _forward(self, part: list[tuple[int, int]], value: np.ndarray | None) -> tuple[list[np.ndarray], np.ndarray]:
        back = []
        for e in self.field.emissions([self.text[a:b] for a, b in part], *_beside(self.text, part)):
            options = self.step[:1] if value is None else value[:, None] + self.step
            back.append(options.argmax(0))
            value = options.max(0) + e
        return back, value

    def add(self, part: list[tuple[int, int]]) -> None:
        self.parts.append((part[0][0], part[-1][1], self.value))
        self.value = self._forward(part, self.value)[1]

    def spans(self) -> list[Span]:
        found, last = [], None
        tag = (self.value + self.step[:, 0]).argmax()
        for start, stop, value in reversed(self.parts):
            part = [m.span() for m in _TOKEN.finditer(self.text, start, stop)]
            for (a, b), pointers in zip(reversed(part), reversed(self._forward(part, value)[0])):
                name, tag = self.field.tags[tag], pointers[tag]
                last = None if name == "O" else last or b
                if name[0] == "B":
                    found += _trimmed(self.text, name[2:], a, last)
                    last = None
        return found


def field_spans(texts: list[str], field: Field, most: int = _PART, hold: int = 200_000) -> list[list[Span]]:
    """Spans that the field finds in each text; runs of equal length are decoded together, about `hold` tokens at a time."""
    jobs: dict[int, list[tuple[int, list[tuple[int, int]]]]] = {}
    out: list[list[Span]] = [[] for _ in texts]

    def decode() -> None:
        for length, group in jobs.items():
            size = max(1, 20_000 // length)
            for at in range(0, len(group), size):
                part = group[at : at + size]
                e = np.stack([field.emissions([texts[i][a:b] for a, b in run], *_beside(texts[i], run)) for i, run in part])
                for (i, run), tags in zip(part, field.viterbi(e)):
                    out[i] += _collect(texts[i], run, [field.tags[t] for t in tags])
        jobs.clear()

    held = 0
    for i, text in enumerate(texts):
        long: _LongRun | None = None
        for run, more in _runs(text, most):
            if more or long:
                long = long or _LongRun(text, field)
                long.add(run)
                if not more:
                    out[i] += long.spans()
                    long = None
                continue
            jobs.setdefault(len(run), []).append((i, run))
            held += len(run)
            if held >= hold:
                decode()
                held = 0
    decode()
    return out


def _collect(text: str, run: list[tuple[int, int]], tags: list[str]) -> list[Span]:
    spans, at = [], 0
    while at < len(tags):
        if tags[at] == "O":
            at += 1
            continue
        kind, first = tags[at][2:], at
        at += 1
        while at < len(tags) and tags[at] == f"I-{kind}":
            at += 1
        spans += _trimmed(text, kind, run[first][0], run[at - 1][1])
    return spans


def _trimmed(text: str, kind: str, start: int, end: int) -> list[Span]:
    """The span without quotes and punctuation around it, if it passes."""
    while start < end and text[start] in _TRIM_LEFT:
        start += 1
    while end > start and text[end - 1] in _TRIM_RIGHT:
        end -= 1
    return [(kind, start, end)] if start < end and _passes(kind, text[start:end]) else []


def find_spans(texts: list[str], field: Field) -> list[tuple[list[Span], list[Span]]]:
    """(base spans, all spans) of each text, both by kind and start."""
    order = {k: i for i, k in enumerate(KINDS)}
    out = []
    for text, more in zip(texts, field_spans(texts, field)):
        base = base_spans(text)
        taken = sorted((s, e) for _, s, e in base)
        extra = [x for x in more if not any(s < x[2] and x[1] < e for s, e in taken)] if len(taken) < 50 else _apart(more, taken)
        out.append((base, sorted([*base, *extra], key=lambda x: (order[x[0]], x[1]))))
    return out


def _apart(spans: list[Span], taken: list[tuple[int, int]]) -> list[Span]:
    """Those that overlap nothing taken (sorted by start), for texts with many."""
    from bisect import bisect_left

    furthest, ends = 0, []
    for _, e in taken:
        furthest = max(furthest, e)
        ends.append(furthest)
    out = []
    for x in spans:
        at = bisect_left(taken, (x[2], 0))
        if at == 0 or ends[at - 1] <= x[1]:
            out.append(x)
    return out


def write_spans(spans: list[Span]) -> str:
    return ",".join(f"{k}:{s}:{e}" for k, s, e in spans)


def redacted(text: str, spans: list[Span]) -> str:
    """The text with each span, or run of overlapping spans, replaced by the kind of its first."""
    out, at = [], 0
    for kind, start, end in sorted(spans, key=lambda x: (x[1], -x[2])):
        if start >= at:
            out += [text[at:start], f"<{kind.upper()}>"]
        at = max(at, end)
    return "".join([*out, text[at:]])


def find_pii(docs: DataFrame, field: Field) -> DataFrame:
    """doc_id, counts of base spans by kind, digest of the base spans, all spans, and the redacted text of every row."""
    shared = docs.sparkSession.sparkContext.broadcast(field)  # features of at most MAX_TOKENS tokens by tags
    named = [("doc_id", pa.int64()), *((f"n_{k}", pa.int64()) for k in KINDS[:4]), ("base_sha256", pa.string()), ("spans", pa.string()), ("redacted_text", pa.string())]

    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            given = batch.column("text").to_pylist()
            rows = []
            for doc_id, text, (base, spans) in zip(batch.column("doc_id").to_pylist(), given, find_spans([t or "" for t in given], shared.value)):
                kinds = [k for k, _, _ in base]
                digest = hashlib.sha256(write_spans(base).encode()).hexdigest()
                rows.append((doc_id, *(kinds.count(k) for k in KINDS[:4]), digest, write_spans(spans), redacted(text, spans) if spans else text))
            columns = zip(*rows) if rows else [[] for _ in named]
            yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, (_, t) in zip(columns, named)], schema=pa.schema(named))

    schema = "doc_id long, n_email long, n_ip long, n_card long, n_phone long, base_sha256 string, spans string, redacted_text string"
    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text").mapInArrow(scan, schema)


def redact_column(field: Field) -> Callable[[str], Column]:
    """A column function: each text with its spans replaced by their kinds; null stays null."""
    shared = SparkSession.active().sparkContext.broadcast(field)

    @F.pandas_udf("string")
    def cleaned(texts: pd.Series) -> pd.Series:
        given = [t or "" for t in texts]
        found = find_spans(given, shared.value)
        return pd.Series([redacted(g, s) if s else t for t, g, (_, s) in zip(texts, given, found)], dtype="object")

    return cleaned
