"""Personal data: fixed patterns, and a conditional random field beside them.

The patterns find e-mail addresses, IPv4 addresses, card and phone numbers.
A linear-chain conditional random field over word shapes adds spans that the
patterns miss, such as phone numbers without a country code and addresses
written with "(at)". It is trained on the driver from a small labelled table
that is written out below by rule, and decoded by Viterbi over many windows
at a time.

Words without a digit, an at sign or a bracketed "at" are always outside
unless such a word stands within two places. So a text falls into windows
that are decoded one by one with the same result as its whole.
"""

from __future__ import annotations

import functools
import hashlib
import random
import re
import zlib
from collections.abc import Iterator
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

from tessella.llm.shared import pieces

KINDS = ("email", "ip", "card", "phone")
LOCAL = "ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789._%+-"
DOMAIN = re.compile(r"[A-Za-z0-9-]+(?:\.[A-Za-z0-9-]+)+")
ADDRESS = re.compile(r"(?<![0-9])[0-9]+\.[0-9]+\.[0-9]+\.[0-9]+")
CARD = re.compile(r"[0-9](?:[ -]?[0-9])+")
PHONE = re.compile(r"\+[0-9][ ().0-9-]+[0-9]")
HINT = re.compile(r"[0-9@]|[(\[{]at[)\]}]")
LABELS = ["O", *(f"{b}-{k}" for k in KINDS for b in "BI")]
BUCKETS = 1 << 13
REACH = 2
Span = tuple[str, int, int]


def emails(text: str) -> list[tuple[int, int]]:
    """Leftmost matches of the address pattern, found from the at signs in linear time."""
    out, last, at = [], 0, text.find("@")
    while at >= 0:
        before = text[last:at]
        start = last + len(before.rstrip(LOCAL))
        domain = DOMAIN.match(text, at + 1) if start < at else None
        if domain:
            out.append((start, domain.end()))
            last, at = domain.end(), text.find("@", domain.end())
        else:
            last, at = at + 1, text.find("@", at + 1)
    return out


def luhn(digits: str) -> bool:
    total = 0
    for k, c in enumerate(reversed(digits)):
        d = int(c) * (1 + k % 2)
        total += d - 9 if d > 9 else d
    return total % 10 == 0


def base_spans(text: str) -> list[Span]:
    """The patterns' spans by start, then kind; leftmost and non-overlapping for each kind."""
    found: list[tuple[int, int, int]] = [(s, 0, e) for s, e in emails(text)] if "@" in text else []
    for m in ADDRESS.finditer(text):
        # zeros in front are no limit to a part's length
        if all(len(p) <= 3 and int(p or "0") <= 255 for p in (x.lstrip("0") for x in m.group().split("."))):
            found.append((m.start(), 1, m.end()))
    for m in CARD.finditer(text):
        digits = m.group().replace(" ", "").replace("-", "")
        if 14 <= len(digits) <= 19 and luhn(digits):
            found.append((m.start(), 2, m.end()))
    if "+" in text:
        for m in PHONE.finditer(text):
            if 10 <= sum("0" <= c <= "9" for c in m.group()) <= 15:
                found.append((m.start(), 3, m.end()))
    return [(KINDS[k], s, e) for s, k, e in sorted(found)]


# ---------------------------------------------------------------- the labelled table


def labelled_table(n: int = 700, seed: int = 11) -> list[tuple[str, list[Span]]]:
    """Sentences with marked spans, made by rule; about half show personal data."""
    draw = random.Random(seed)
    syllables = "an er ti on re the ing ou ha le qui de ver ein que la os ra mi to".split()
    word = lambda: "".join(draw.choice(syllables) for _ in range(draw.randint(1, 4)))
    num = lambda k: "".join(draw.choice("0123456789") for _ in range(k))
    byte = lambda: str(draw.randint(0, 255))

    def filler() -> str:
        w = word()
        return draw.choice([w, w, w, w.capitalize(), w + ",", w + "."])

    def email() -> str:
        user = word() + draw.choice(["", "." + word(), num(2), "." + num(2)])
        host = word() + draw.choice([".com", ".net", ".org", "." + word() + ".de"])
        return draw.choice([f"{user}@{host}", f"{user}@{host}", f"{user} (at) {host}", f"{user} [at] {host}", f"{user}(at){host}"])

    def phone() -> str:
        a, b, c = num(3), num(3), num(4)
        return draw.choice([f"+1 ({a}) {b}-{c}", f"({a}) {b}-{c}", f"{a}-{b}-{c}", f"+49 {a} {b}{c}", f"0{num(3)} {num(7)}", f"{a}.{b}.{c}"])

    def card() -> str:
        d = "4" + num(14)
        d += next(c for c in "0123456789" if luhn(d + c))
        return draw.choice([d, "-".join(d[i : i + 4] for i in range(0, 16, 4)), " ".join(d[i : i + 4] for i in range(0, 16, 4))])

    def broken() -> str:
        d = num(16)
        return d if not luhn(d) else d[:-1] + str((int(d[-1]) + 5) % 10)

    make = {"email": email, "ip": lambda: ".".join(byte() for _ in range(4)), "card": card, "phone": phone}
    cues = {"email": ["mail", "email:", "contact"], "ip": ["host", "ip", "from"], "card": ["card", "visa", "paid"], "phone": ["tel", "phone:", "call", "fax"]}
    other = [
        lambda: num(draw.randint(1, 6)), lambda: f"{draw.randint(1, 28)}.{draw.randint(1, 12)}.{draw.randint(1950, 2030)}", lambda: str(draw.randint(1900, 2030)),
        lambda: f"{draw.randint(1, 9)}.{draw.randint(0, 9)}", lambda: f"{draw.randint(1, 9)}.{draw.randint(0, 9)}.{draw.randint(0, 20)}", lambda: f"${num(3)}.{num(2)}", lambda: f"{num(2)}%",
        lambda: f"password={num(6)}ab{num(4)}", lambda: f'token = "{num(9)}fe{num(9)}"', lambda: "AKIA" + num(3) + "QX" + num(6), lambda: f"{num(2)}:{num(2)}",
        lambda: f"{draw.randint(1990, 2030)}-{num(2)}-{num(2)}", lambda: f"({num(1)})", lambda: f"[{num(2)}]", lambda: f"{num(3)}-{num(2)}", lambda: f"No. {num(5)}",
        lambda: "@" + word(), broken, broken, lambda: f"ISBN {num(3)}-{num(1)}-{num(5)}-{num(3)}-{num(1)}", lambda: f"{num(9)}{num(12)}", lambda: f"{word()}{num(2)}", lambda: f"{num(2)} | {num(3)} | {num(4)}",
    ]
    table = []
    for _ in range(n):
        parts: list[str] = [filler() for _ in range(draw.randint(0, 4))]
        spans: list[Span] = []
        for _ in range(draw.randint(1, 2)):
            if draw.random() < 0.5:
                kind = draw.choice(KINDS)
                if draw.random() < 0.5:
                    parts.append(draw.choice(cues[kind]))
                at = len(" ".join(parts)) + bool(parts)
                made = make[kind]()
                spans.append((kind, at, at + len(made)))
                parts.append(made + draw.choice(["", "", ".", ","]))
            else:
                parts.append(draw.choice(other)())
            parts += [filler() for _ in range(draw.randint(1, 4))]
        table.append((" ".join(parts), spans))
    return table


# ---------------------------------------------------------------- features and model

WORD = re.compile(r"\S+")
_SHAPE = [(re.compile(r"[A-Z]+"), "A"), (re.compile(r"[^\W\d_A-Z]+"), "a")]


@functools.lru_cache(1 << 16)
def _word_features(word: str) -> tuple[str, ...]:
    core = word.rstrip(".,;:!?")
    shape = core
    for pattern, letter in _SHAPE:
        shape = pattern.sub(letter, shape)
    exact = re.sub(r"[0-9]", "9", shape)[:24]
    shape = re.sub(r"[0-9]+", "9", shape)[:24]
    digits = sum("0" <= c <= "9" for c in core)
    cue = core.lower() if not digits and len(core) < 12 else "#"
    return (
        "s=" + shape, "x=" + exact, f"d={min(digits, 20)}", f"n={min(len(core), 20)}", "c=" + cue, "f=" + core[:1] if not core[:1].isalnum() else "f=w",
        "@" if "@" in core or "(at)" in core else "-", "luhn" if 13 <= digits <= 19 and luhn(re.sub("[^0-9]", "", core)) else "free", "dots=" + str(min(core.count("."), 4)), "tail=" + word[len(core) :][:1],
    )


def features(words: list[str]) -> np.ndarray:
    """Bucket numbers (word, feature): the word's, its neighbours' shapes, digits and cues."""
    own = [_word_features(w) for w in words]
    edge = ("s=^", "x=^", "d=^", "n=^", "c=^", "f=^", "^", "luhn=^", "dots=^", "tail=^")
    rows = []
    for k, f in enumerate(own):
        row = list(f)
        for step in (-2, -1, 1, 2):
            g = own[k + step] if 0 <= k + step < len(own) else edge
            row += [f"{step}{g[i]}" for i in (0, 2, 4, 9)]
        row.append("bias")
        rows.append([zlib.crc32(x.encode()) % BUCKETS for x in row])
    return np.array(rows, np.int64)


class Field(NamedTuple):
    weights: np.ndarray  # (bucket, label)
    moves: np.ndarray  # (label, label)


def _tags(words: list[tuple[int, int]], spans: list[Span]) -> list[int]:
    tags = [0] * len(words)
    for kind, s, e in spans:
        inside = [k for k, (a, b) in enumerate(words) if a < e and b > s]
        for i, k in enumerate(inside):
            tags[k] = LABELS.index(f"{'I' if i else 'B'}-{kind}")
    return tags


def _logsum(x: np.ndarray, axis: int) -> np.ndarray:
    top = x.max(axis=axis, keepdims=True)
    return np.squeeze(top, axis) + np.log(np.exp(x - top).sum(axis=axis))


@functools.cache
def train(steps: int = 80, rate: float = 0.15, ridge: float = 2e-3) -> Field:
    """Maximum conditional likelihood on the labelled table, by full-batch Adam steps."""
    table = labelled_table()
    found = [[(m.start(), m.end()) for m in WORD.finditer(t)] for t, _ in table]
    n, longest, labels = len(table), max(map(len, found)), len(LABELS)
    x = np.zeros((n, longest, len(features(["a"])[0])), np.int64)
    y = np.zeros((n, longest), np.int64)
    on = np.zeros((n, longest), bool)
    for k, ((text, spans), words) in enumerate(zip(table, found, strict=True)):
        x[k, : len(words)] = features([text[a:b] for a, b in words])
        y[k, : len(words)] = _tags(words, spans)
        on[k, : len(words)] = True
    theta = np.zeros(BUCKETS * labels + labels * labels)
    first, second = np.zeros_like(theta), np.zeros_like(theta)
    rows, x_on = np.arange(n), x[on]
    gold = np.zeros_like(theta)
    g_w, g_m = gold[: BUCKETS * labels].reshape(BUCKETS, labels), gold[BUCKETS * labels :].reshape(labels, labels)
    for t in range(longest):
        np.add.at(g_w, (x[on[:, t], t], y[on[:, t], t][:, None]), 1)
        if t:
            np.add.at(g_m, (y[on[:, t], t - 1], y[on[:, t], t]), 1)
    for step in range(1, steps + 1):
        weights, moves = theta[: BUCKETS * labels].reshape(BUCKETS, labels), theta[BUCKETS * labels :].reshape(labels, labels)
        emit = weights[x].sum(axis=2)
        fore = np.zeros((longest, n, labels))
        back = np.zeros((longest, n, labels))
        fore[0] = emit[:, 0]
        for t in range(1, longest):
            go = _logsum(fore[t - 1][:, :, None] + moves, 1) + emit[:, t]
            fore[t] = np.where(on[:, t, None], go, fore[t - 1])
        for t in range(longest - 2, -1, -1):
            go = _logsum(moves + (emit[:, t + 1] + back[t + 1])[:, None, :], 2)
            back[t] = np.where(on[:, t + 1, None], go, 0)
        z = _logsum(fore[-1], 1)
        expected = np.zeros_like(theta)
        e_w, e_m = expected[: BUCKETS * labels].reshape(BUCKETS, labels), expected[BUCKETS * labels :].reshape(labels, labels)
        share = np.exp(fore + back - z[:, None]).transpose(1, 0, 2)[on]
        for k in range(labels):
            e_w[:, k] = np.bincount(x_on.ravel(), weights=np.repeat(share[:, k], x.shape[2]), minlength=BUCKETS)
        for t in range(1, longest):
            live = rows[on[:, t]]
            pair = fore[t - 1][live][:, :, None] + moves + (emit[live, t] + back[t][live])[:, None, :] - z[live, None, None]
            e_m += np.exp(pair).sum(axis=0)
        slope = (expected - gold) / n + ridge * theta
        first = 0.9 * first + 0.1 * slope
        second = 0.99 * second + 0.01 * slope**2
        theta = theta - rate * (first / (1 - 0.9**step)) / (np.sqrt(second / (1 - 0.99**step)) + 1e-8)
    return Field(theta[: BUCKETS * labels].reshape(BUCKETS, labels), theta[BUCKETS * labels :].reshape(labels, labels))


def viterbi(field: Field, windows: list[np.ndarray]) -> list[np.ndarray]:
    """The best label sequence of each window of emissions; windows advance together."""
    order = sorted(range(len(windows)), key=lambda k: -len(windows[k]))
    sizes = np.array([len(windows[k]) for k in order])
    out: list[np.ndarray] = [np.zeros(0, np.int64)] * len(windows)
    at = 0
    while at < len(order):
        # windows of much the same length make one array
        to = int(np.searchsorted(-sizes, -(sizes[at] // 2), side="right"))
        to = max(at + 1, min(to, at + max(1, 200_000 // max(1, int(sizes[at])))))
        block, most = order[at:to], int(sizes[at])
        emit = np.zeros((most, len(block), len(LABELS)))
        for i, k in enumerate(block):
            emit[: len(windows[k]), i] = windows[k]
        best, came = emit[0], np.zeros((most, len(block), len(LABELS)), np.int8)
        ends = np.zeros((most, len(block)), np.int64)
        ends[0] = best.argmax(axis=1)
        for t in range(1, most):
            step = best[:, :, None] + field.moves
            came[t] = step.argmax(axis=1)
            best = step.max(axis=1) + emit[t]
            ends[t] = best.argmax(axis=1)
        for i, k in enumerate(block):
            n = len(windows[k])
            path = np.zeros(n, np.int64)
            path[-1] = ends[n - 1, i]
            for t in range(n - 1, 0, -1):
                path[t - 1] = came[t, i, path[t]]
            out[k] = path
        at = to
    return out


def _windows(text: str) -> list[list[tuple[int, int]]]:
    """Runs of words that may carry a label: hinted words and their neighbours."""
    words = [(m.start(), m.end()) for m in WORD.finditer(text)]
    starts = np.array([a for a, _ in words])
    hit = np.unique(np.searchsorted(starts, [m.start() for m in HINT.finditer(text)], side="right") - 1)
    near = np.zeros(len(words), bool)
    for step in range(-REACH, REACH + 1):
        near[np.clip(hit + step, 0, len(words) - 1)] = True
    edges = np.flatnonzero(np.diff(np.concatenate([[0], near.astype(np.int8), [0]])))
    return [words[a:b] for a, b in edges.reshape(-1, 2)]


def _trim(kind: str, text: str, start: int, end: int) -> tuple[int, int] | None:
    """A span without surrounding punctuation; None if it cannot be of its kind."""
    while end > start and text[end - 1] in ".,;:!?\"'>":
        end -= 1
    while start < end and text[start] in ",;:\"'<":
        start += 1
    digits = sum("0" <= c <= "9" for c in text[start:end])
    least = {"email": 0, "ip": 4, "card": 13, "phone": 7}[kind]
    if not start < end or digits < least or kind == "phone" and digits > 15:
        return None
    if kind == "card" and not (digits <= 19 and luhn(re.sub("[^0-9]", "", text[start:end]))):
        return None
    if kind == "email" and not ("@" in text[start:end] or HINT.search(text, start, end) and "at" in text[start:end]):
        return None
    return start, end


def find(field: Field, texts: list[str]) -> list[tuple[list[Span], list[Span]]]:
    """(base spans, all spans) of each text. Added spans never overlap base ones."""
    base = [base_spans(t) if HINT.search(t) else [] for t in texts]
    places, emissions = [], []
    for k, t in enumerate(texts):
        if HINT.search(t):
            for window in _windows(t):
                places.append((k, window))
                emissions.append(field.weights[features([t[a:b] for a, b in window])].sum(axis=1))
    added: list[list[Span]] = [[] for _ in texts]
    for (k, window), path in zip(places, viterbi(field, emissions), strict=True):
        i = 0
        while i < len(path):
            if path[i] == 0:
                i += 1
                continue
            kind, j = KINDS[(path[i] - 1) // 2], i + 1
            inside = LABELS.index(f"I-{kind}")
            while j < len(path) and path[j] == inside:
                j += 1
            cut = _trim(kind, texts[k], window[i][0], window[j - 1][1])
            if cut and not any(s < cut[1] and e > cut[0] for _, s, e in base[k]):
                added[k].append((kind, *cut))
            i = j
    return [(b, sorted([*b, *a], key=lambda x: (x[1], KINDS.index(x[0]))) if a else b) for b, a in zip(base, added, strict=True)]


def joined(spans: list[Span]) -> str:
    return ",".join(f"{k}:{s}:{e}" for k, s, e in spans)


def detect(docs: DataFrame, text: str = "text", key: str = "doc_id") -> DataFrame:
    """key, counts of base spans by kind, digest of the base spans, and all spans.

    Null text counts as empty and has no spans. Repeated rows give a row each.
    One pass without a shuffle; offsets count code points.
    """
    shared = docs.sparkSession.sparkContext.broadcast(train())

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for piece in pieces(batch, "text"):
                got = find(shared.value, [t or "" for t in piece.column(1).to_pylist()])
                counts = [pa.array([sum(k == kind for k, _, _ in b) for b, _ in got], pa.int64()) for kind in KINDS]
                digest = pa.array([hashlib.sha256(joined(b).encode()).hexdigest() for b, _ in got], pa.string())
                yield pa.record_batch([piece.column(0), *counts, digest, pa.array([joined(a) for _, a in got], pa.string())], names=["key", *(f"n_{k}" for k in KINDS), "base_sha256", "spans"])

    source = docs.select(docs[key].alias("key"), docs[text].alias("text"))
    kind = source.schema["key"].dataType.simpleString()
    columns = f"key {kind}, n_email long, n_ip long, n_card long, n_phone long, base_sha256 string, spans string"
    return source.mapInArrow(run, columns).withColumnRenamed("key", key)


def masked(text: str, spans: list[Span]) -> str:
    """The text with each span replaced by its kind in brackets; overlaps go with the first."""
    out, last = [], 0
    for kind, s, e in spans:
        if s >= last:
            out += [text[last:s], f"<{kind.upper()}>"]
        last = max(last, e)
    return "".join([*out, text[last:]])


def redact(docs: DataFrame, text: str = "text") -> DataFrame:
    """``docs`` with every span of ``text`` masked; all other columns and rows stay.

    Null text stays null.
    """
    shared = docs.sparkSession.sparkContext.broadcast(train())
    names = docs.columns
    place = names.index(text)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            batch = pa.RecordBatch.from_arrays(batch.columns, names=[f"c{i}" for i in range(len(names))])
            for piece in pieces(batch, f"c{place}"):
                texts = piece.column(place).to_pylist()
                got = find(shared.value, [t or "" for t in texts])
                new = [None if t is None else masked(t, a) if a else t for t, (_, a) in zip(texts, got, strict=True)]
                columns = [pa.array(new, pa.string()) if i == place else c for i, c in enumerate(piece.columns)]
                yield pa.RecordBatch.from_arrays(columns, names=[f"c{i}" for i in range(len(names))])

    plain = docs.toDF(*[f"c{i}" for i in range(len(names))])
    return plain.mapInArrow(run, plain.schema).toDF(*names)
