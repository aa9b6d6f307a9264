"""Conversation repair against an exhaustive search and a plain rewriting."""

import hashlib
import random
import re
import zlib
from functools import cache

import pytest

from slyglot.llm import turn_repair

SPACES = " \t\n\v\f\r"
SCHEMA = "conv_id long, turn long, role string, text string, gaps long, part int, state string"


def exhaustive(rows):
    """The least (cost, audit) over all edit sequences with up to three inserts in a row."""

    def shorter(kept):  # runs of "ua" need not be told apart
        return kept if len(kept) < 6 else kept[: len(kept) - 2 * ((len(kept) - 4) // 2)]

    @cache
    def best(i, kept, inserts):
        ways = [(0, "")] if i == len(rows) and re.fullmatch("(s?(ua)+)?", kept) else []
        steps = [(i, c, 3, "I", inserts + 1) for c in "ua" if inserts < 3]
        if i < len(rows):
            initial, fault = rows[i]
            more = 3 if fault == "truncated" else 0
            steps.append((i + 1, "", 4, "D", 0))
            if fault not in ("blank", "duplicate"):
                steps += [(i + 1, initial or "-", more, "K", 0), (i + 1, "u", 3 + more, "R", 0), (i + 1, "a", 3 + more, "R", 0)]
        for j, c, cost, edit, n in steps:
            if re.fullmatch("s?(ua)*u?", kept + c) and (rest := best(j, shorter(kept + c), n)):
                ways.append((cost + rest[0], edit + rest[1]))
        return min(ways) if ways else None

    kept = [c + "ua" * k + u for c in ("", "s") for k in range(3) for u in ("", "u")]
    for i in range(len(rows) - 20, 0, -20):  # from the end, so that no call goes deep
        for k in kept:
            best(i, shorter(k), 0)
    return best(0, "", 0)


def damaged(rows):
    for conv, turn, role, text in rows:
        spaced = [" " if v is None else str(v) for v in (conv, turn, role, text)]
        kind = zlib.crc32(":".join(spaced[:2]).encode()) % 20
        role, text = spaced[2:]
        if kind == 0:
            continue
        text = "" if kind == 1 else re.sub("[.!?]", "", text) if kind == 2 else text
        yield from [(conv, turn, "user" if kind == 4 else role, text)] * (2 if kind == 3 else 1)


def plain(rows):
    """The contract, conversation by conversation."""
    found = {conv: [] for conv, *_ in rows}
    for conv, turn, role, text in damaged(rows):
        found[conv].append((turn, role, text))
    for conv, turns in found.items():
        turns.sort(key=lambda r: (r[0] is not None, r[0] or 0, r[1].encode(), r[2].encode()))
        seen, coded = set(), []
        for _, role, text in turns:
            fault = "blank" if not text.strip(SPACES) else "duplicate" if (role, text) in seen else "" if text.rstrip(SPACES)[-1] in ".!?" else "truncated"
            seen.add((role, text))
            coded.append((role[:1], fault))
        cost, audit = exhaustive(tuple(coded))
        known = [t for t, _, _ in turns if t is not None]
        gaps = max(known) - min(known) + 1 - len(set(known)) if known else 0
        faults = [sum(f == name for _, f in coded) for name in ("blank", "duplicate", "truncated")]
        illegal = sum(a + b not in ("su", "ua", "au") for (a, _), (b, _) in zip(coded, coded[1:]))
        lines, queue = [], list(turns)
        for edit in audit:
            _, role, text = queue.pop(0) if edit != "I" else (None, "", "")
            if edit in "RI":
                role = "assistant" if lines and lines[-1][0] == "u" else "user"
            if edit != "D":
                lines.append(f"{role}:{text}")
        assert not queue and re.fullmatch("(s?(ua)+)?", "".join(line[0] for line in lines))
        yield (conv, gaps, *faults, illegal, cost, audit, hashlib.sha256("\n".join(lines).encode()).hexdigest())


def repaired(frame):
    names = [field.split()[0] for field in turn_repair.RESULT.split(", ")]
    return sorted(map(tuple, frame.select(*names).collect()), key=repr)


def check(spark, rows):
    frame = spark.createDataFrame([(*r, 7, None, "x") for r in rows], SCHEMA).repartition(3)
    assert repaired(turn_repair.repair(turn_repair.damage(frame))) == sorted(plain(rows), key=repr)


def test_agenda_equals_exhaustive_search():
    rng = random.Random(5)
    for k in range(1500):
        n = rng.randint(0, 9) if k < 1400 else rng.randint(30, 110)
        rows = tuple((rng.choice("ssuuuaaa x"), rng.choice(["", "", "", "truncated", "blank", "duplicate"])) for _ in range(n))
        assert turn_repair.lightest_repair(list(rows)) == exhaustive(rows), rows


def test_whole_table(spark, sf_dir):
    rows = [tuple(r) for r in spark.read.parquet(f"{sf_dir}/conversations.parquet").select("conv_id", "turn", "role", "text").collect()]
    check(spark, rows)


def made(rng, conv, n):
    roles, texts = ["user", "assistant", "system", "tool", "", None], ["Yes.", "no", "Why?\n", " ", "", None, "é!", "Go on.", "It is so", "\x0b"]
    return [(conv, rng.choice([None, *range(12)]), rng.choices(roles, [8, 8, 2, 1, 1, 1])[0], rng.choice(texts) or None) for _ in range(n)]


@pytest.mark.parametrize("partitions", [1, 4, 23])
def test_awkward_rows_and_conversations_over_several_tasks(spark, partitions):
    rng = random.Random(partitions)
    rows = [r for conv in (*range(40), None) for r in made(rng, conv, rng.randint(1, 9))]
    rows += made(rng, 77, 300) + made(rng, None, 200) + [(78, 1, "user", "same.")] * 90 + [(79, t, "user" if t % 2 else "assistant", f"{t}.") for t in range(400)]
    rows += [(80, 0, "user", "long " * 60_000 + "?"), (80, 1, "assistant", "ok" + " " * 100_000)]
    before = spark.conf.get("spark.sql.shuffle.partitions")
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    spark.conf.set("spark.sql.shuffle.partitions", partitions)
    try:
        check(spark, rows)
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", before)
        spark.conf.unset("spark.sql.adaptive.coalescePartitions.enabled")


def test_dropped_conversation_and_empty_table(spark):
    conv = next(c for c in range(1000) if zlib.crc32(f"{c}:0".encode()) % 20 == 0)
    check(spark, [(conv, 0, "user", "gone.")])
    check(spark, [(conv, 0, "user", "gone."), (5000, 3, "user", "a."), (5001, 3, "assistant", "a.")])
    assert turn_repair.repair(turn_repair.damage(spark.createDataFrame([], SCHEMA))).collect() == []
