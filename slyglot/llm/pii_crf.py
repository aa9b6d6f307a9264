"""Personal data: fixed patterns, and a linear-chain conditional random field beside them.

Base spans come from patterns with a check each (parts of an address, check digit of a
card, digits of a phone number). The field adds what patterns miss, such as spelled-out
addresses and phone numbers without a country code. It labels tokens B-kind, I-kind or O
from word-shape features of a token and its neighbours, is trained by its likelihood on a
small labelled table, and is decoded by Viterbi over batches of windows in numpy. Windows
are the surroundings of every digit, at sign, spelled-out dot, bracketed `at`, and `at`
before a dotted name in the whole text; text away from those can hold none of the kinds. An added span passes a plain check of its
kind and never touches a base span.
"""

from __future__ import annotations

import hashlib
import re
from bisect import bisect_left
from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .shared import whole_text

KINDS = ("email", "ip", "card", "phone")
LABELS = ("O", *(f"{at}-{kind}" for kind in KINDS for at in "BI"))
#: Labelled rows used at most; the table is meant to be small.
LABELLED = 20_000
#: Characters on each side of a trigger that a window reaches over.
REACH = 48

Span = tuple[str, int, int]

LOCAL = frozenset("ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789._%+-")
DOMAIN = re.compile(r"[A-Za-z0-9-]+(?:\.[A-Za-z0-9-]+)+")
# A run of digits is tried at its start only: later starts in it cannot do better.
IP = re.compile(r"(?<![0-9])[0-9]++\.[0-9]++\.[0-9]++\.[0-9]++")
CARD = re.compile(r"[0-9](?:[ -]?[0-9])+")
PHONE = re.compile(r"\+[0-9][ ().0-9-]+[0-9]")
TRIGGER = re.compile(r"[0-9@]+|(?i:\bdot\b|[\[({]\s*at\s*[\])}]|\bat\b(?=[ \t]+[\w-]+(?:\.[\w-]+)*\.[a-z]))")
DIGITS = re.compile(r"[^0-9]")
TOKEN = re.compile(r"[^\W\d_]+|\d+|[^\w\s]|_")
CUES = {
    "at", "dot", "email", "mail", "e", "contact", "write", "call", "phone", "tel", "telephone", "mobile", "cell", "fax", "ring", "number",
    "card", "visa", "account", "ip", "address", "host", "server", "version", "v", "license", "isbn", "order", "id", "password", "token",
    "key", "on", "from", "to", "in", "page", "chapter", "room", "gmail", "com", "org", "net", "de", "co", "uk", "edu", "is", "reach",
}


def luhn(digits: str) -> bool:
    total = 0
    for place, digit in enumerate(reversed(digits)):
        value = int(digit) * (1 + place % 2)
        total += value - 9 * (value > 9)
    return total % 10 == 0


def _emails(text: str) -> Iterator[Span]:
    at, last = text.find("@"), 0
    while at >= 0:
        domain = DOMAIN.match(text, at + 1)
        start = at
        while domain and start > last and text[start - 1] in LOCAL:
            start -= 1
        if domain and start < at:
            last = domain.end()
            yield "email", start, last
        at = text.find("@", at + 1)


def base_spans(text: str) -> list[Span]:
    """The spans of the fixed patterns, by start and then kind."""
    spans = list(_emails(text))
    for m in IP.finditer(text):
        if all(len(p.lstrip("0")) <= 3 and int(p.lstrip("0") or 0) <= 255 for p in m.group().split(".")):
            spans.append(("ip", *m.span()))
    for m in CARD.finditer(text):
        digits = DIGITS.sub("", m.group())
        if 12 <= len(digits) <= 19 and luhn(digits):
            spans.append(("card", *m.span()))
    if "+" in text:
        for m in PHONE.finditer(text):
            if 9 <= len(DIGITS.sub("", m.group())) <= 15:
                spans.append(("phone", *m.span()))
    return sorted(spans, key=_order)


def _order(span: Span) -> tuple[int, int, int]:
    return span[1], KINDS.index(span[0]), span[2]


def spelled(spans: Iterable[Span]) -> str:
    return ",".join(f"{kind}:{start}:{end}" for kind, start, end in spans)


# Features

def _shape(word: str) -> str:
    if word.isdigit():
        return f"d{min(len(word), 7)}"
    if word.isalpha():
        case = "X" if word.isupper() else "Xx" if word[0].isupper() else "x"
        return case + str(min(len(word), 4)) + ("!" + word.lower() if word.lower() in ("at", "dot", "com", "org", "net") else "")
    return word


def token_features(tokens: list[tuple[str, bool]]) -> list[list[str]]:
    """Feature names of each (word, space before) token."""
    shapes = ["<<", "<", *[_shape(w) + ("_" if space else "") for w, space in tokens], ">", ">>"]
    cues = [w.lower() if w.lower() in CUES else "" for w, _ in tokens]
    rows = []
    for i in range(len(tokens)):
        a, b, c, d, e = shapes[i:i + 5]
        before = " ".join(sorted({cue for cue in cues[max(0, i - 4):i] if cue}))
        rows.append([
            f"0{c}", f"1{b}|{c}", f"2{c}|{d}", f"3{a}|{b}|{c}", f"4{c}|{d}|{e}", f"5{b}|{c}|{d}", f"6{cues[i]}", f"7{before}|{c[:2]}",
            f"8{a}|{b}|{c}|{d}", f"9{b}|{d}",
        ])
    return rows


TEMPLATES = 10


class Field:
    """Weights of a linear-chain conditional random field."""

    def __init__(self, names: dict[str, int], emit: np.ndarray, step: np.ndarray):
        self.names, self.emit, self.step = names, emit, step

    def ids(self, rows: list[list[str]]) -> np.ndarray:
        unknown = len(self.names)
        return np.array([[self.names.get(n, unknown) for n in row] for row in rows], np.int64).reshape(-1, TEMPLATES)

    @staticmethod
    def train(examples: list[tuple[str, list[Span]]], passes: int = 60, rate: float = 0.15, ridge: float = 1e-4) -> Field:
        """Maximise the penalised likelihood by gradient steps with per-weight scaling."""
        k = len(LABELS)
        sequences = []
        for text, spans in examples:
            tokens = [(m.group(), m.start(), m.end()) for m in TOKEN.finditer(text)]
            if tokens:
                sequences.append((token_features(_spaced(tokens, text)), _labels(tokens, spans)))
        names: dict[str, int] = {}
        for rows, _ in sequences:
            for row in rows:
                for name in row:
                    names.setdefault(name, len(names))
        field = Field(names, np.zeros((len(names) + 1, k)), np.zeros((k, k)))
        if not sequences:
            return field
        longest = max(len(y) for _, y in sequences)
        ids = np.full((len(sequences), longest, TEMPLATES), len(names))
        gold = np.zeros((len(sequences), longest), np.int64)
        live = np.zeros((len(sequences), longest), bool)
        for s, (rows, y) in enumerate(sequences):
            ids[s, :len(y)], gold[s, :len(y)], live[s, :len(y)] = field.ids(rows), y, True
        scale = [np.full_like(field.emit, 1e-8), np.full_like(field.step, 1e-8)]
        for _ in range(passes):
            grads = field._gradient(ids, gold, live)
            for weights, grad, seen in zip((field.emit, field.step), grads, scale):
                grad -= ridge * len(sequences) * weights
                seen += grad * grad
                weights += rate * grad / np.sqrt(seen)
            field.emit[-1] = 0
        return field

    def _gradient(self, ids: np.ndarray, gold: np.ndarray, live: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Seen less expected feature counts, by forward and backward sums."""
        n, t, k = *gold.shape, len(LABELS)
        score = self.emit[ids].sum(axis=2)
        forward, backward = np.zeros((t, n, k)), np.zeros((t, n, k))
        forward[0] = score[:, 0]
        for i in range(1, t):
            new = _log_sum(forward[i - 1][:, :, None] + self.step, 1) + score[:, i]
            forward[i] = np.where(live[:, i, None], new, forward[i - 1])
        for i in range(t - 2, -1, -1):
            new = _log_sum(self.step + (score[:, i + 1] + backward[i + 1])[:, None, :], 2)
            backward[i] = np.where(live[:, i + 1, None], new, 0)
        whole = _log_sum(forward[-1], 1)
        mean = np.exp(forward + backward - whole[None, :, None]).transpose(1, 0, 2) * live[:, :, None]
        diff = np.eye(k)[gold] * live[:, :, None] - mean
        emit = np.zeros_like(self.emit)
        np.add.at(emit, ids[live].ravel(), np.repeat(diff[live], TEMPLATES, axis=0))
        step = np.zeros_like(self.step)
        for i in range(1, t):
            on = live[:, i]
            joint = np.exp(forward[i - 1][on][:, :, None] + self.step + (score[on, i] + backward[i][on])[:, None, :] - whole[on, None, None])
            step -= joint.sum(axis=0)
            np.add.at(step, (gold[on, i - 1], gold[on, i]), 1)
        return emit, step

    def decode(self, sequences: list[np.ndarray]) -> list[np.ndarray]:
        """The best labels of each sequence of feature ids; Viterbi over like-sized batches."""
        out: list[np.ndarray] = [np.zeros(0, np.int64)] * len(sequences)
        order = sorted(range(len(sequences)), key=lambda s: len(sequences[s]))
        start = 0
        while start < len(order):
            size, longest = 0, len(sequences[order[start]])
            while start + size < len(order) and size < 512 and len(sequences[order[start + size]]) <= 2 * longest + 8:
                size += 1
            batch = order[start:start + size]
            for s, labels in zip(batch, self._viterbi([sequences[s] for s in batch])):
                out[s] = labels
            start += size
        return out

    def _viterbi(self, batch: list[np.ndarray]) -> list[np.ndarray]:
        sizes = np.array([len(s) for s in batch])
        n, t = len(batch), int(sizes.max())
        score = np.zeros((n, t, len(LABELS)))
        for s, ids in enumerate(batch):
            score[s, :len(ids)] = self.emit[ids].sum(axis=1)
        best, back = score[:, 0], np.zeros((t, n, len(LABELS)), np.int8)
        for i in range(1, t):
            ways = best[:, :, None] + self.step
            back[i] = ways.argmax(axis=1)
            on = (i < sizes)[:, None]
            best = np.where(on, ways.max(axis=1) + score[:, i], best)
            back[i] = np.where(on, back[i], np.arange(len(LABELS)))
        labels = np.zeros((n, t), np.int64)
        labels[:, -1] = best.argmax(axis=1)
        for i in range(t - 1, 0, -1):
            labels[:, i - 1] = back[i][np.arange(n), labels[:, i]]
        return [labels[s, :size] for s, size in enumerate(sizes)]


def _log_sum(x: np.ndarray, axis: int) -> np.ndarray:
    top = x.max(axis=axis, keepdims=True)
    return np.squeeze(top, axis) + np.log(np.exp(x - top).sum(axis=axis))


def _spaced(tokens: list[tuple[str, int, int]], text: str) -> list[tuple[str, bool]]:
    return [(word, start == 0 or text[start - 1].isspace()) for word, start, _ in tokens]


def _labels(tokens: list[tuple[str, int, int]], spans: list[Span]) -> list[int]:
    labels = []
    for _, start, end in tokens:
        kind = next((s for s in spans if s[1] <= start and end <= s[2]), None)
        labels.append(0 if kind is None else LABELS.index(("B-" if start == kind[1] else "I-") + kind[0]))
    return labels


# The small labelled table

FILLER = "the report of this river and a small green house were seen by them before noon while others left".split()


def examples(count: int = 300, seed: int = 1) -> list[tuple[str, list[Span]]]:
    """A small labelled table: sentences made from patterns of data and of look-alikes."""
    random = np.random.default_rng(seed)
    pick = lambda options: options[int(random.integers(len(options)))]
    digits = lambda n: "".join(str(d) for d in random.integers(0, 10, n))
    name = lambda: pick(["john", "Ana", "k", "mueller", "lee", "sam", "rosa", "info", "sales", "Bob"])
    site = lambda: pick(["mail", "example", "web", "gmail", "post", "host", "corp"])
    top = lambda: pick(["com", "org", "net", "de", "co"])

    def card() -> str:
        number = "4" + digits(14)
        number += next(d for d in "0123456789" if luhn(number + d))
        return pick([number, " ".join(re.findall("....", number)), "-".join(re.findall("....", number))])

    makers = {
        "email": [
            lambda: f"{name()}.{digits(2)}@{site()}.{top()}", lambda: f"{name()} at {site()} dot {top()}", lambda: f"{name()} (at) {site()}.{top()}",
            lambda: f"{name()} [at] {site()} [dot] {top()}", lambda: f"{name()} dot {name()} at {site()} dot {top()}", lambda: f"{name()} @ {site()}.{top()}",
            lambda: f"{name()}{digits(2)} (at) {site()} (dot) {top()}",
        ],
        "ip": [lambda: ".".join(str(random.integers(1, 256)) for _ in range(4))],
        "card": [card],
        "phone": [
            lambda: f"+1 ({digits(3)}) {digits(3)}-{digits(4)}", lambda: f"({digits(3)}) {digits(3)}-{digits(4)}", lambda: f"{digits(3)}-{digits(3)}-{digits(4)}",
            lambda: f"+49 {digits(2)} {digits(7)}", lambda: f"{digits(3)}.{digits(3)}.{digits(4)}", lambda: f"0{digits(3)} {digits(3)} {digits(4)}",
        ],
        "": [
            lambda: f"version {random.integers(1, 9)}.{random.integers(0, 9)}", lambda: f"License, Version 2.{digits(1)}.", lambda: f"CC BY-NC {random.integers(1, 5)}.0.",
            lambda: f"in {random.integers(1900, 2030)}", lambda: f"20{digits(2)}-0{random.integers(1, 9)}-1{digits(1)}", lambda: f"password={digits(5)}ab{digits(3)}c{digits(4)}",
            lambda: f'token = "{digits(3)}f{digits(4)}e{digits(8)}a{digits(2)}"', lambda: f"AKIA{digits(2)}QX{digits(3)}ZK{digits(1)}", lambda: f"order {digits(6)}",
            lambda: f"page {digits(2)} of {digits(3)}", lambda: f"{digits(2)}:{digits(2)}", lambda: f"{digits(1)},{digits(3)},{digits(3)}", lambda: f"id {digits(8)}",
            lambda: f"{digits(2)} per cent", lambda: f"ISBN 978-{digits(1)}-{digits(2)}-{digits(6)}-{digits(1)}", lambda: "a dot on the map at noon",
            lambda: f"http://{site()}.{top()}/{digits(4)}", lambda: f"{digits(1)}.{digits(1)}.{digits(2)}", lambda: f"@{name()} said", lambda: f"{digits(4)} {digits(4)} items",
        ],
    }
    lead = {"email": ["email", "write to", "contact", "mail"], "ip": ["host", "server", "from"], "card": ["card", "visa"], "phone": ["call", "tel", "phone", "ring"], "": ["see"]}
    rows = []
    for i in range(count):
        text, spans = "", []
        for kind in (pick(list(makers)), pick(list(makers)), "")[: 1 + i % 3]:
            words = [pick(FILLER) for _ in range(int(random.integers(1, 6)))] + ([pick(lead[kind])] if random.random() < 0.4 else [])
            text += " ".join(words) + " "
            made = pick(makers[kind])()
            if kind:
                spans.append((kind, len(text), len(text) + len(made)))
            text += made + pick([" ", ", ", ". ", "\n"])
        rows.append((text + pick(FILLER), spans))
    return rows


def labelled_table(spark: SparkSession) -> DataFrame:
    """The examples as a table (text, spans), spans as kind:start:end, comma-joined."""
    return spark.createDataFrame([(text, spelled(spans)) for text, spans in examples()], "text string, spans string")


def learn(labelled: DataFrame) -> Field:
    """Train on a table like `labelled_table`; rows without a text are left out.

    The table is small by contract; `LABELLED` rows of it are read at most.
    """
    rows = labelled.where("text IS NOT NULL").select("text", F.coalesce("spans", F.lit("")).alias("spans")).limit(LABELLED).collect()
    return Field.train([
        (r.text, [(k, int(a), int(b)) for k, a, b in (s.split(":") for s in r.spans.split(",") if s)])
        for r in sorted(rows, key=lambda r: (r.text, r.spans))
    ])


# Finding

def _windows(text: str) -> Iterator[tuple[int, int]]:
    start = end = -1
    for m in TRIGGER.finditer(text):
        a, b = max(0, m.start() - REACH), min(len(text), m.end() + REACH)
        while a > 0 and m.start() - a < 2 * REACH and not text[a - 1].isspace():
            a -= 1
        while b < len(text) and b - m.end() < 2 * REACH and not text[b].isspace():
            b += 1
        if a <= end:
            end = max(end, b)
        else:
            if end >= 0:
                yield start, end
            start, end = a, b
    if end >= 0:
        yield start, end


def _plausible(kind: str, found: str) -> bool:
    digits = DIGITS.sub("", found)
    if kind == "email":
        return bool(re.fullmatch(r"(?i)[\w.%+-]+(?:\s*dot\s*[\w-]+)*\s*(?:@|[\[({]\s*at\s*[\])}]|\bat\b)\s*[\w-]+(?:\s*(?:\.|[\[({]\s*dot\s*[\])}]|\bdot\b)\s*[a-z]\w*)+", found)) and "\n" not in found
    if kind == "ip":
        parts = found.split(".")
        return len(parts) == 4 and all(p.isascii() and p.isdigit() and int(p) <= 255 for p in parts)
    if kind == "card":
        return 12 <= len(digits) <= 19 and luhn(digits) and not re.search(r"[^0-9 .-]", found)
    return bool(re.fullmatch(r"\+?[0-9(][0-9 ().-]*[0-9]", found)) and 9 <= len(digits) <= 15 and len(re.findall(r"[0-9]+", found)) > 2


def find(texts: list[str], field: Field) -> list[tuple[list[Span], list[Span]]]:
    """Base spans and all spans of each text."""
    bases = [base_spans(text) for text in texts]
    windows, sequences = [], []
    for i, text in enumerate(texts):
        for a, b in _windows(text):
            tokens = [(m.group(), m.start(), m.end()) for m in TOKEN.finditer(text, a, b)]
            if tokens:
                windows.append((i, tokens))
                sequences.append(field.ids(token_features(_spaced(tokens, text))))
    added: list[list[Span]] = [[] for _ in texts]
    taken = [_joined(base) for base in bases]
    for (i, tokens), labels in zip(windows, field.decode(sequences)):
        for kind, first, last in _entities(labels.tolist()):
            start, end = tokens[first][1], tokens[last][2]
            # Windows come in the order of the text, so only the last added span can overlap.
            clear = _clear(taken[i], start, end) and (not added[i] or added[i][-1][2] <= start)
            if clear and _plausible(kind, texts[i][start:end]):
                added[i].append((kind, start, end))
    return [(base, sorted([*base, *more], key=_order)) for base, more in zip(bases, added)]


def _joined(spans: list[Span]) -> tuple[list[int], list[int]]:
    """Starts and ends of the stretches that spans, sorted by start, cover."""
    starts, ends = [], []
    for _, start, end in spans:
        if ends and start < ends[-1]:
            ends[-1] = max(ends[-1], end)
        else:
            starts.append(start)
            ends.append(end)
    return starts, ends


def _clear(stretches: tuple[list[int], list[int]], start: int, end: int) -> bool:
    at = bisect_left(stretches[0], end)
    return at == 0 or stretches[1][at - 1] <= start


def _entities(labels: list[int]) -> Iterator[tuple[str, int, int]]:
    start = -1
    for i, label in enumerate([*labels, 0]):
        name = LABELS[label]
        if start >= 0 and name != f"I-{LABELS[labels[start]][2:]}":
            yield LABELS[labels[start]][2:], start, i - 1
            start = -1
        if name[0] == "B" or name[0] == "I" and start < 0:
            start = i


def detect(docs: DataFrame, field: Field) -> DataFrame:
    """doc_id, n_email, n_ip, n_card, n_phone, base_sha256, spans, n_added of every row.

    Counts and hash are of base spans; `spans` holds those of the field too, as
    kind:start:end in code points by start, then kind. A NULL text counts as empty and
    has no spans. Repeated rows are searched each; other columns are not carried; an
    empty table gives an empty result.
    """

    def found(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows = find([t.as_py() for t in batch.column(1)], field)
            counts = {f"n_{kind}": pa.array([sum(s[0] == kind for s in base) for base, _ in rows], pa.int64()) for kind in KINDS}
            yield pa.RecordBatch.from_pydict({
                "doc_id": batch.column(0), **counts,
                "base_sha256": pa.array([hashlib.sha256(spelled(base).encode()).hexdigest() for base, _ in rows], pa.string()),
                "spans": pa.array([spelled(every) for _, every in rows], pa.string()),
                "n_added": pa.array([len(every) - len(base) for base, every in rows], pa.int64()),
            })

    picked = docs.select(F.col("doc_id").cast("long").alias("doc_id"), whole_text().alias("text"))
    schema = "doc_id long, n_email long, n_ip long, n_card long, n_phone long, base_sha256 string, spans string, n_added long"
    return picked.mapInArrow(found, schema)


def masked_text(text: str, spans: list[Span]) -> str:
    """The text with each span replaced by its kind in brackets; overlaps by the first."""
    parts, at = [], 0
    for kind, start, end in spans:
        if start >= at:
            parts += [text[at:start], f"[{kind}]"]
        at = max(at, end)
    return "".join([*parts, text[at:]])


def masked(docs: DataFrame, field: Field) -> DataFrame:
    """The rows of `docs` with personal data masked in `text` and `n_chars` brought up to date."""
    text_at = docs.columns.index("text")

    def hidden(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = batch.column(text_at).to_pylist()
            clean = [None if t is None else masked_text(t, every) for t, (_, every) in zip(texts, find([t or "" for t in texts], field))]
            yield batch.set_column(text_at, batch.schema.field(text_at), pa.array(clean, batch.schema.field(text_at).type))

    out = docs.mapInArrow(hidden, docs.schema)
    if "n_chars" in docs.columns:
        size = F.char_length("text").cast(docs.schema["n_chars"].dataType)
        out = out.select(*[F.when(F.col("text").isNull(), F.col(c)).otherwise(size).alias(c) if c == "n_chars" else F.col(c) for c in docs.columns])
    return out
