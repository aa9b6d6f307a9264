"""Secrets in text: candidate strings, and a random forest that removes false positives.

A candidate is a run of 16 or more key characters, whole, wherever it stands, or any value
of four characters or more, quoted or not, after a hint word and '=' or ':'. Its features
are its length, the make-up and the transitions of its characters (class changes, and the
log-probability of its letter pairs in ordinary words), how much of it dictionary words
cover, the words before and after it, and the path it comes from. A forest trained from a
table of labelled findings scores it. Letter pairs and dictionary come from the words of
the labelled findings' surroundings and of the negative findings, so the model depends on
the labelled table alone.
"""

from __future__ import annotations

import hashlib
import math
import re
from bisect import bisect_right
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.ml.classification import RandomForestClassificationModel, RandomForestClassifier
from pyspark.ml.functions import array_to_vector, vector_to_array
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .shared import whole_text

KEY_CHARACTERS = "A-Za-z0-9_+/=.\\-"
CANDIDATE = re.compile(rf"(?<![{KEY_CHARACTERS}])[{KEY_CHARACTERS}]{{16,}}+")
#: Part of a candidate before an equals sign that names what follows.
NAMED = re.compile(r"^([A-Za-z_.\-]{2,40})=(?=[^=])")
WORD = re.compile(r"[^\W\d_]+")
SEPARATOR = re.compile(r"[=:]>?[ \t]*+")
VALUE = re.compile(r"\"([^\"\n]{4,})\"|'([^'\n]{4,})'|`([^`\n]{4,})`|([^\s\"'`,;<>=:][^\s\"'`,;<>]{3,})")
REACH = 60
TREES, DEPTH, THRESHOLD = 40, 8, 0.5
#: Labelled rows used at most; the table is meant to be small.
LABELLED = 50_000
DICTIONARY = 5_000
HINTS = {"password", "passwd", "pwd", "secret", "token", "key", "apikey", "api", "auth", "bearer", "credential", "credentials", "private", "access", "aws", "pass"}
HINTED = re.compile(rf"(?:(?<![A-Za-z])|(?<=[a-z])(?=[A-Z]))(?i:{'|'.join(sorted(HINTS))})[\"'`\]]*[ \t]*$")
HARMLESS = {"sha", "hash", "checksum", "commit", "digest", "md5", "uuid", "id", "example", "sample", "placeholder", "version", "see", "http", "https", "image", "data", "etag", "integrity"}
FIXTURES = {"test", "tests", "docs", "doc", "example", "examples", "fixture", "fixtures", "sample", "samples", "lock", "vendor"}
FEATURES = (
    "length", "upper", "lower", "digits", "marks", "classes", "changes", "entropy", "pairs", "hex", "covered", "longest_word",
    "hint_before", "harmless_before", "named_hint", "hint_after", "quoted", "equals_before", "path_fixture", "prefix_upper", "repeated", "segments",
)


class Words:
    """Letter pairs and a dictionary, from ordinary words."""

    def __init__(self, words: Counter):
        pairs = np.ones((27, 27))
        for word, n in words.items():
            codes = [0, *(ord(c) - 96 if "a" <= c <= "z" else 0 for c in word), 0]
            for a, b in zip(codes, codes[1:]):
                pairs[a, b] += min(n, 50)
        self.pairs = np.log(pairs / pairs.sum(axis=1, keepdims=True)).tolist()
        self.known = {w for w, _ in sorted(words.items(), key=lambda x: (-x[1], x[0]))[:DICTIONARY] if len(w) >= 3}
        self.longest = max(map(len, self.known), default=0)

    def pair_score(self, text: str) -> float:
        codes = [ord(c) - 96 if "a" <= c <= "z" else 0 for c in text.lower()]
        return sum(self.pairs[a][b] for a, b in zip(codes, codes[1:])) / max(1, len(codes) - 1)

    def covered(self, text: str) -> tuple[float, int]:
        """Share of letters and digits inside dictionary words, greedily, and the longest word."""
        low, at, inside, longest = text.lower(), 0, 0, 0
        size = sum(c.isalnum() for c in low)
        while at < len(low):
            for n in range(min(self.longest, len(low) - at), 2, -1):
                if low[at:at + n] in self.known:
                    inside, longest, at = inside + n, max(longest, n), at + n
                    break
            else:
                at += 1
        return inside / max(1, size), longest


def _class(c: str) -> int:
    return 0 if c.islower() else 1 if c.isupper() else 2 if c.isdigit() else 3


def spans(text: str) -> list[tuple[int, int]]:
    """Candidates of a text: runs of key characters, and named values that are in no such run."""
    runs = [m.span() for m in CANDIDATE.finditer(text)]
    starts = [a for a, _ in runs]
    named = set()
    for m in SEPARATOR.finditer(text):
        if HINTED.search(text, max(0, m.start() - REACH), m.start()) and (value := VALUE.match(text, m.end())):
            start, end = value.span(value.lastindex)
            at = bisect_right(starts, start) - 1
            if at < 0 or runs[at][1] < end:
                named.add((start, end))
    return sorted([*runs, *named])


def measure(found: str, before: str, after: str, path: str, words: Words) -> list[float]:
    """The features of one candidate with its neighbouring text and its path."""
    name = NAMED.match(found)
    value = found[name.end():] if name else found
    body = value.rstrip("=.-")
    n = max(1, len(body))
    kinds = [_class(c) for c in body]
    counts = Counter(body)
    near = [w.lower() for w in WORD.findall(before)][-4:]
    later = [w.lower() for w in WORD.findall(after)][:2]
    named = {w.lower() for w in WORD.findall(name.group(1))} if name else set()
    covered, longest = words.covered(body)
    prefix = re.match(r"[A-Z]{3,5}(?=[A-Z0-9])", body)
    return [float(x) for x in (
        min(n, 512), kinds.count(1) / n, kinds.count(0) / n, kinds.count(2) / n, kinds.count(3) / n, len(set(kinds)),
        sum(a != b for a, b in zip(kinds, kinds[1:])) / n, -sum(c / n * math.log2(c / n) for c in counts.values()), words.pair_score(body),
        all(c in "0123456789abcdef" for c in body.lower()), covered, longest,
        any(w in HINTS for w in near), any(w in HARMLESS for w in near), any(w in HINTS for w in named), any(w in HINTS for w in later),
        before[-1:] in ('"', "'", "`"), bool(name) or bool(re.search(r"[=:]\s*[\"'`]?$", before)),
        any(w in FIXTURES for w in re.split(r"[^a-z]+", path.lower())), bool(prefix), max(counts.values(), default=0) / n,
        len(re.split(r"[/._\-]+", body)),
    )]


def examples(count: int = 1200, seed: int = 4) -> list[tuple[str, str, str, str, int]]:
    """Labelled findings (found, before, after, path, label): keys and their look-alikes."""
    random = np.random.default_rng(seed)
    pick = lambda options: options[int(random.integers(len(options)))]
    some = lambda letters, n: "".join(letters[int(i)] for i in random.integers(0, len(letters), n))
    hexa, upper = "0123456789abcdef", "ABCDEFGHIJKLMNOPQRSTUVWXYZ"
    every = upper + upper.lower() + "0123456789"
    parts = "th er on an re he in ed nd ha at en es of or nt ea ti to it st io le is ou ar as de rt ve sch pf keit ung heit lich ver ment que ción eau".split()
    word = lambda a=2, b=5: "".join(pick(parts) for _ in range(int(random.integers(a, b))))
    secret = [
        lambda: (pick(["AKIA", "ASIA"]) + some(upper + "0123456789", 16), pick(["", "key ", 'aws = "'])),
        lambda: (pick(["password", "passwd", "secret", "api_key", "pwd"]) + "=" + some(hexa, int(random.integers(16, 33))), ""),
        lambda: (some(hexa, pick([32, 40, 64])), pick(['token = "', 'secret: "', "password: ", 'api_key="', "auth token "])),
        lambda: (pick(["ghp_", "sk_live_", "xoxb-", "glpat-"]) + some(every, int(random.integers(20, 41))), pick(["", "token ", "use "])),
        lambda: (some(every + "+/", pick([28, 40, 44, 64])) + pick(["", "=", "=="]), pick(['secret = "', "key: ", "bearer ", 'credential "'])),
        lambda: ("eyJ" + some(every, 20) + ".eyJ" + some(every, 40) + "." + some(every + "-_", 43), pick(["bearer ", "token ", ""])),
    ]
    harmless = [
        lambda: (word(6, 12), ""), lambda: (word(6, 12).capitalize(), ""), lambda: ("-".join(word() for _ in range(5)), ""), lambda: ("_".join(word() for _ in range(5)), pick(["", "key "])),
        lambda: ("/".join(word() for _ in range(5)) + ".html", pick(["", "see "])), lambda: (".".join(word() for _ in range(4)) + ".com", "see "),
        lambda: (some(hexa, 40), pick(["commit ", "sha ", "checksum "])), lambda: (some(hexa, 64), pick(["sha256 digest ", "hash "])),
        lambda: ("-".join(some(hexa, n) for n in (8, 4, 4, 4, 12)), pick(["uuid ", "id "])), lambda: (some("0123456789", int(random.integers(16, 24))), pick(["card ", "number ", ""])),
        lambda: (pick("=-._x*"[:4]) * int(random.integers(16, 60)), ""), lambda: ("password=" + pick(["x" * 16, "your-password-here", "changeme-changeme", "example-password"]), ""),
        lambda: ("AKIA" + pick(["XXXXXXXXXXXXXXXX", "EXAMPLEEXAMPLEEX"]), "example "), lambda: (word().upper() + word(4, 8).upper(), ""),
        lambda: (word() + str(random.integers(10, 99)) + "-" + word() + "." + word() + ".example.com", ""), lambda: (word(3, 6).capitalize() + word(3, 6).capitalize() + word(3, 6).capitalize(), ""),
        lambda: ("2024-01-01-00.00." + some("0123456789", 4), "on "), lambda: (word(3, 6) + "--" + word(3, 6) + "..." + word(), ""),
    ]
    rows = []
    for i in range(count):
        label = int(i % 2)
        found, before = pick(secret if label else harmless)()
        lead = " ".join(word() for _ in range(3)) + pick([" ", ".\n", ", "])
        quote = before[-1:] if before[-1:] == '"' else " "
        rows.append((found, lead + before, quote + " ".join(word() for _ in range(2)), pick(["src1", "src/main.py", "web/page", "tests/data" if not label else "etc/app.conf"]), label))
    return rows


def named_examples(count: int = 600, seed: int = 5) -> list[tuple[str, str, str, str, int]]:
    """Labelled values after a hint word, like `examples`: short secrets, and words, marks and references."""
    random = np.random.default_rng(seed)
    pick = lambda options: options[int(random.integers(len(options)))]
    some = lambda letters, n: "".join(letters[int(i)] for i in random.integers(0, len(letters), n))
    lower, digits, marks = "abcdefghijklmnopqrstuvwxyz", "0123456789", "!@#$%&*?"
    every = lower + lower.upper() + digits
    parts = "th er on an re he in ed nd ha at en es of or nt ea ti to it st io le is ou ar as de rt ve".split()
    word = lambda a=2, b=5: "".join(pick(parts) for _ in range(int(random.integers(a, b))))
    leet = str.maketrans("oeias", "03145")
    secret = [
        lambda: word(3, 5).translate(leet).capitalize() + some(digits, 1), lambda: word() + some(digits, int(random.integers(1, 5))) + pick(["", "x", "!", "#"]),
        lambda: some(every, int(random.integers(8, 16))), lambda: some(every + marks, int(random.integers(8, 24))), lambda: some("0123456789abcdef", 12),
        lambda: word().capitalize() + pick(marks) + some(digits, 2) + word() + pick(marks),
    ]
    harmless = [
        word, lambda: word(3, 6).capitalize(), lambda: " ".join(word() for _ in range(3)), lambda: pick(["required", "string", "value", "changeme", "true", "false", "none", "null", "optional", "hidden"]),
        lambda: pick("*x.-_") * int(random.integers(4, 16)), lambda: "${" + word().upper() + "_" + word().upper() + "}", lambda: word() + "." + word() + "." + word(), lambda: word() + "_" + word(),
        lambda: word() + "()", lambda: str(random.integers(1900, 2030)), lambda: "your-" + word(), lambda: word() + ".",
    ]
    names = ["password", "pwd", "passwd", "secret", "token", "api_key", "key", "auth", "access", "pass"]
    rows = []
    for i in range(count):
        label = int(i % 2)
        found = pick(secret if label else harmless)()
        quote = pick(['"', "'", ""])
        before = " ".join(word() for _ in range(3)) + " " + pick(names) + pick([" = ", "=", ": "]) + quote
        rows.append((found, before, quote + " " + " ".join(word() for _ in range(2)), pick(["src1", "src/main.py", "web/page", "etc/app.conf"]), label))
    return rows


def labelled_table(spark: SparkSession) -> DataFrame:
    return spark.createDataFrame(examples() + named_examples(), "found string, before string, after string, path string, label int")


def learn(labelled: DataFrame, seed: int = 8) -> tuple[RandomForestClassificationModel, Words]:
    """A forest and word model from labelled findings; NULL texts count as empty.

    Rows without a label of 0 or 1 are left out. With one class only, every candidate
    gets that class.
    """
    columns = [F.coalesce(c, F.lit("")).alias(c) for c in ("found", "before", "after", "path")]
    rows = labelled.where("label IN (0, 1)").select(*columns, F.col("label").cast("double").alias("label")).limit(LABELLED).collect()
    rows = sorted(map(tuple, rows))
    seen: Counter = Counter()
    for found, before, after, _, label in rows:
        texts = (before, after) if label else (before, after, *(found for _ in range(not any(c.isdigit() for c in found))))
        seen.update(w.lower() for text in texts for w in WORD.findall(text))
    words = Words(seen)
    measured = [(measure(*row[:4], words), row[4]) for row in rows]
    data = labelled.sparkSession.createDataFrame(measured, "x array<double>, label double").select(array_to_vector("x").alias("features"), "label")
    forest = RandomForestClassifier(numTrees=TREES, maxDepth=DEPTH, seed=seed, featureSubsetStrategy="sqrt", minInstancesPerNode=2)
    return forest.fit(data), words


def candidates(docs: DataFrame, words: Words, path_column: str | None = "source") -> DataFrame:
    """doc_id, start, end, found_sha256, x: every candidate of every whole text."""
    path = F.coalesce(F.col(path_column).cast("string"), F.lit("")) if path_column in docs.columns else F.lit("")

    def searched(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows: dict[str, list] = {"doc_id": [], "start": [], "end": [], "found_sha256": [], "x": []}
            for doc_id, text, where in zip(*(batch.column(i) for i in range(3))):
                whole = text.as_py()
                for start, end in spans(whole):
                    found = whole[start:end]
                    x = measure(found, whole[max(0, start - REACH):start], whole[end:end + REACH], where.as_py(), words)
                    digest = hashlib.sha256(found.encode()).hexdigest()
                    for name, value in zip(rows, (doc_id.as_py(), start, end, digest, x)):
                        rows[name].append(value)
            types = (pa.int64(), pa.int64(), pa.int64(), pa.string(), pa.list_(pa.float64()))
            yield pa.RecordBatch.from_arrays([pa.array(v, t) for v, t in zip(rows.values(), types)], list(rows))

    picked = docs.select(F.col("doc_id").cast("long").alias("doc_id"), whole_text().alias("text"), path.alias("path"))
    return picked.mapInArrow(searched, "doc_id long, start long, end long, found_sha256 string, x array<double>")


def scan(docs: DataFrame, forest: RandomForestClassificationModel, words: Words, threshold: float = THRESHOLD) -> DataFrame:
    """doc_id, start, end (code points), found_sha256, score of candidates at or above `threshold`.

    NULL and empty texts have none; a NULL path counts as empty; repeated rows are
    searched each; other columns are ignored; an empty table gives an empty result.
    """
    scored = forest.transform(candidates(docs, words).withColumn("features", array_to_vector("x")))
    score = F.round(vector_to_array("probability")[1], 9) if forest.numClasses > 1 else F.lit(0.0)
    return scored.select("doc_id", "start", "end", "found_sha256", score.alias("score")).where(F.col("score") >= threshold)
