"""Conversation structure repair by lightest derivations over a hypergraph of repair items.

`damage` makes faulty conversations from given ones. `repair` finds for each conversation
the cheapest edits after which role initials read `(s?(ua)+)?`, of equally cheap ones
those whose audit (initials of the edits, in order) is least.

Items are facts such as "from row i on and in state q, the rest can be repaired at this
cost with this audit". Single edits deduce an item from one item, and two adjacent spans
of rows deduce the span of both. Knuth's agenda pops items by (cost, rows covered, audit).
Every deduction grows that key and keeps the order of its premises, since audits of one
span at one cost are never proper prefixes of each other, so the first weight that an item
is popped with is its lightest, and the search ends when the goal item is popped.

Rows are dealt by range of (conversation, turn, role, text), so a conversation of any size
spreads over tasks. What lies whole within a task is repaired there. Only the first and
the last conversation of a task may go on elsewhere: for these the task of each piece
derives the spans for all states, the spans of a conversation are joined by the same
agenda, and its rows are read once more in order for the repaired text.
"""

from __future__ import annotations

import hashlib
import heapq
from collections.abc import Iterable, Iterator
from dataclasses import dataclass

import pandas as pd
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from slyglot.session import scratch_path

KEEP, REROLE, DELETE, INSERT, TRUNCATED = 0, 3, 4, 3, 3
#: States: nothing kept yet, after a system, user or assistant turn.
START, SYSTEM, USER, ASSISTANT = range(4)
STATES = (START, SYSTEM, USER, ASSISTANT)
FINAL = (START, ASSISTANT)
LEGAL = {"su", "ua", "au"}
#: Rows derived as one leaf of the tree of spans.
LEAF = 32
SPACES = r"\x20\x09-\x0D"

Weight = tuple[int, str]
Row = tuple[str, str]


def _next(state: int, initial: str) -> int | None:
    """The state after a turn whose role begins so; None where the turn is illegal."""
    if initial == "s":
        return SYSTEM if state == START else None
    if initial == "u":
        return None if state == USER else USER
    return ASSISTANT if initial == "a" and state == USER else None


def _inserted(state: int) -> int:
    return ASSISTANT if state == USER else USER


def _edits(initial: str, fault: str, state: int) -> Iterator[tuple[int, int, str]]:
    """(next state, cost, audit) of every edit of one row in a state."""
    yield state, DELETE, "D"
    if fault in ("blank", "duplicate"):
        return
    more = TRUNCATED if fault == "truncated" else 0
    kept = _next(state, initial)
    if kept is not None:
        yield kept, KEEP + more, "K"
    yield _inserted(state), REROLE + more, "R"


class Agenda:
    """Lightest weights of items, popped in the order of (cost, rows covered, audit)."""

    def __init__(self) -> None:
        self.queue: list[tuple[int, int, str, tuple]] = []
        self.lightest: dict[tuple, Weight] = {}
        self.best: dict[tuple, Weight] = {}

    def push(self, item: tuple, covered: int, weight: Weight) -> None:
        if item not in self.lightest and (item not in self.best or weight < self.best[item]):
            self.best[item] = weight
            heapq.heappush(self.queue, (weight[0], covered, weight[1], item))

    def pop(self) -> tuple | None:
        """The next item to become final, or None when nothing is left."""
        while self.queue:
            cost, _, audit, item = heapq.heappop(self.queue)
            if item not in self.lightest:
                self.lightest[item] = (cost, audit)
                return item
        return None


def _spans(sizes: list[int]) -> tuple[dict[tuple[int, int], tuple], int]:
    """The balanced tree over leaves: for each span its (parent, sibling, is left), and rows covered."""
    kin: dict[tuple[int, int], tuple] = {}
    todo = [(0, len(sizes))]
    while todo:
        low, high = todo.pop()
        if high - low > 1:
            middle = (low + high) // 2
            left, right = (low, middle), (middle, high)
            kin[left], kin[right] = ((low, high), right, True), ((low, high), left, False)
            todo += [left, right]
    return kin, sum(sizes)


def joined_spans(leaves: list[dict[tuple[int, int], Weight]], sizes: list[int], goals: Iterable[tuple[int, int]] | None) -> dict[tuple[int, int], Weight]:
    """Weights of (state in, state out) over all leaves; until the first of `goals` is final, or for all states."""
    kin, _ = _spans(sizes)
    upto = [0]
    for size in sizes:
        upto.append(upto[-1] + size)
    agenda, whole = Agenda(), (0, len(leaves))
    known: dict[tuple[tuple[int, int], str, int], list[int]] = {}
    for i, leaf in enumerate(leaves):
        for (q, r), weight in leaf.items():
            agenda.push(((i, i + 1), q, r), sizes[i], weight)
    wanted, found = set(goals or ()), {}
    while (item := agenda.pop()) is not None:
        span, q, r = item
        weight = agenda.lightest[item]
        if span == whole:
            found[q, r] = weight
            if (q, r) in wanted:
                break
            continue
        parent, sibling, is_left = kin[span]
        covered = upto[parent[1]] - upto[parent[0]]
        known.setdefault((span, "in", q), []).append(r)
        known.setdefault((span, "out", r), []).append(q)
        if is_left:
            for end in known.get((sibling, "in", r), ()):
                other = agenda.lightest[sibling, r, end]
                agenda.push((parent, q, end), covered, (weight[0] + other[0], weight[1] + other[1]))
        else:
            for begin in known.get((sibling, "out", q), ()):
                other = agenda.lightest[sibling, begin, q]
                agenda.push((parent, begin, r), covered, (other[0] + weight[0], other[1] + weight[1]))
    return found


def leaf_spans(rows: list[Row], begins: Iterable[int], ends: Iterable[int], first_only: bool = False) -> dict[tuple[int, int], Weight]:
    """Lightest (state in, state out) over some rows of (initial, fault), edit by edit from the right.

    With `first_only` the search ends with the first of the wanted items.
    """
    into: list[dict[int, list[tuple[int, int, str]]]] = []
    for initial, fault in rows:
        back: dict[int, list[tuple[int, int, str]]] = {}
        for state in STATES:
            for after, cost, audit in _edits(initial, fault, state):
                back.setdefault(after, []).append((state, cost, audit))
        into.append(back)
    fills: dict[int, list[int]] = {}
    for state in STATES:
        fills.setdefault(_inserted(state), []).append(state)
    agenda, size, wanted, found = Agenda(), len(rows), set(begins), {}
    for end in ends:
        agenda.push((size, end, end), 0, (0, ""))
    while (item := agenda.pop()) is not None:
        i, q, r = item
        cost, audit = agenda.lightest[item]
        if i == 0 and q in wanted:
            found[q, r] = (cost, audit)
            if first_only:
                break
        for state in fills.get(q, ()):
            agenda.push((i, state, r), size - i, (cost + INSERT, "I" + audit))
        if i:
            for state, more, edit in into[i - 1].get(q, ()):
                agenda.push((i - 1, state, r), size - i + 1, (cost + more, edit + audit))
    return found


def derive(rows: list[Row], all_states: bool = False) -> dict[tuple[int, int], Weight]:
    """Lightest weights over any number of rows: the goal's only, or those of all states."""
    if len(rows) <= LEAF:
        return leaf_spans(rows, STATES, STATES) if all_states else leaf_spans(rows, (START,), FINAL, True)
    blocks = [rows[i:i + LEAF] for i in range(0, len(rows), LEAF)]
    leaves = [leaf_spans(block, STATES, STATES) for block in blocks]
    return joined_spans(leaves, [len(b) for b in blocks], None if all_states else [(START, end) for end in FINAL])


def lightest_repair(rows: list[Row]) -> Weight:
    """Cost and audit of the cheapest repair of rows of (initial, fault)."""
    weights = derive(rows)
    return min(weights[START, end] for end in FINAL if (START, end) in weights)


class Rewriter:
    """Applies audits to rows in order, and hashes the repaired `role:text` lines."""

    def __init__(self) -> None:
        self.state, self.hash, self.lines = START, hashlib.sha256(), 0

    def _line(self, role: str, text: str, state: int) -> None:
        self.hash.update(f"{chr(10) if self.lines else ''}{role}:{text}".encode())
        self.lines, self.state = self.lines + 1, state

    def fill(self, edits: str, at: int) -> int:
        """Inserts from place `at` of the audit on; the place after them."""
        while at < len(edits) and edits[at] == "I":
            state = _inserted(self.state)
            self._line("user" if state == USER else "assistant", "", state)
            at += 1
        return at

    def edit(self, edits: str, at: int, role: str, text: str) -> int:
        at = self.fill(edits, at)
        if edits[at] == "K":
            self._line(role, text, _next(self.state, role[:1]))
        elif edits[at] == "R":
            state = _inserted(self.state)
            self._line("user" if state == USER else "assistant", text, state)
        return at + 1


@dataclass
class Piece:
    """Counts over consecutive rows of one conversation; adjacent pieces add up."""

    rows: int = 0
    blank: int = 0
    duplicate: int = 0
    truncated: int = 0
    illegal: int = 0
    turns: int = 0
    low: int | None = None
    high: int | None = None
    first: str | None = None
    last: str | None = None

    def add(self, turn: int | None, initial: str, fault: str) -> None:
        other = Piece(1, fault == "blank", fault == "duplicate", fault == "truncated", 0, int(turn is not None), turn, turn, initial, initial)
        self.join(other)

    def join(self, after: Piece) -> None:
        if not after.rows:
            return
        self.illegal += after.illegal + (self.rows > 0 and self.last + after.first not in LEGAL)
        self.turns += after.turns - (self.high is not None and self.high == after.low)
        for name in ("rows", "blank", "duplicate", "truncated"):
            setattr(self, name, getattr(self, name) + getattr(after, name))
        self.first = after.first if self.first is None else self.first
        self.last = after.last
        if after.low is not None:
            self.low = after.low if self.low is None else self.low
            self.high = after.high

    def gaps(self) -> int:
        return 0 if self.low is None else self.high - self.low + 1 - self.turns


COUNTS = ("blank", "duplicate", "truncated", "illegal")
RESULT = "conv_id long, gaps long, blank long, duplicate long, truncated long, illegal long, cost long, audit string, repaired_sha256 string"
OPEN = "part int, pos long, turn long, role string, text string, empty boolean, ended boolean, gone boolean"


def _fault(empty: bool, seen: bool, ended: bool) -> str:
    return "blank" if empty else "duplicate" if seen else "" if ended else "truncated"


def damage(conversations: DataFrame) -> DataFrame:
    """conv_id, turn, role, text, gone: rows with faults, chosen by crc32(`conv_id:turn`) % 20.

    0 drops a row (it stays as a mark with `gone`), 1 empties its text, 2 takes out its
    `.`, `!` and `?`, 3 repeats it and 4 makes it a user's. NULL counts as one space.
    """
    spaced = lambda name: F.coalesce(F.col(name).cast("string"), F.lit(" "))
    kind = F.crc32(F.concat_ws(":", spaced("conv_id"), spaced("turn")).cast("binary")) % 20
    text = F.when(F.col("_kind") <= 1, "").when(F.col("_kind") == 2, F.translate(spaced("text"), ".!?", "")).otherwise(spaced("text"))
    role = F.when(F.col("_kind") == 0, "").when(F.col("_kind") == 4, "user").otherwise(spaced("role"))
    copies = F.array_repeat(F.lit(0), F.when(F.col("_kind") == 3, 2).otherwise(1))
    rows = conversations.select("conv_id", "turn", "role", "text", kind.alias("_kind"))
    return rows.select(
        F.col("conv_id").cast("long").alias("conv_id"), F.col("turn").cast("long").alias("turn"),
        role.alias("role"), text.alias("text"), (F.col("_kind") == 0).alias("gone"), F.explode(copies).alias("_copy"),
    ).drop("_copy")


def _marked(rows: DataFrame) -> DataFrame:
    spaced = lambda name: F.coalesce(F.col(name), F.lit(" "))
    gone: Column = F.col("gone") if "gone" in rows.columns else F.lit(False)
    rows = rows.select(
        F.col("conv_id").cast("long").alias("conv_id"), F.col("turn").cast("long").alias("turn"),
        spaced("role").alias("role"), spaced("text").alias("text"), gone.alias("gone"))
    return rows.select(
        "conv_id", "turn", "role", "text", (~F.col("text").rlike(f"[^{SPACES}]")).alias("empty"),
        F.col("text").rlike(rf"[.!?][{SPACES}]*\z").alias("ended"), "gone")


def _result(conv_id: int | None, piece: Piece, weight: Weight, sha256: str) -> tuple:
    return (conv_id, piece.gaps(), *(int(getattr(piece, n)) for n in COUNTS), *weight, sha256)


def _closed(conv_id: int | None, rows: list[tuple]) -> tuple:
    """The result of a conversation all of whose rows are here, in order."""
    piece, seen, coded, left = Piece(), set(), [], []
    for turn, role, text, empty, ended, gone in rows:
        if gone:
            continue
        fault = _fault(empty, (role, text) in seen, ended)
        seen.add((role, text))
        piece.add(turn, role[:1], fault)
        coded.append((role[:1], fault))
        left.append((role, text))
    weight, rewriter, at = lightest_repair(coded), Rewriter(), 0
    for role, text in left:
        at = rewriter.edit(weight[1], at, role, text)
    rewriter.fill(weight[1], at)
    return _result(conv_id, piece, weight, rewriter.hash.hexdigest())


def _batch(rows: list[tuple], schema: pa.Schema) -> pa.RecordBatch:
    columns = zip(*rows) if rows else [()] * len(schema)
    return pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(columns, schema)], schema=schema)


_ARROW = {"long": pa.int64(), "int": pa.int32(), "string": pa.string(), "boolean": pa.bool_()}
#: Results built before they are handed over, and characters of rows likewise.
HANDED = 2000


def _schema(text: str) -> pa.Schema:
    return pa.schema([(name, _ARROW[kind]) for name, kind in (field.split() for field in text.split(", "))])


def _first_pass(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Results of conversations that lie within this task; the rows of its first and last one."""
    part, schema = TaskContext.get().partitionId(), _schema(RESULT + ", " + OPEN)
    no_result, no_row = (None,) * 8, (None,) * 8
    out: list[tuple] = []
    now: object = out  # no conversation yet
    held: list[tuple] = []
    begun, pos = 0, 0

    def as_open() -> None:
        nonlocal pos
        for turn, role, text, empty, ended, gone in held:
            out.append((now, *no_result, part, pos, turn, role, text, empty, ended, gone))
            pos += 1
        held.clear()

    for batch in batches:
        for conv_id, *row in zip(*(column.to_pylist() for column in batch.columns)):
            if conv_id != now or now is out:
                if begun == 1:
                    as_open()
                elif begun:
                    out.append((*_closed(now, held), *no_row))
                    held.clear()
                now, begun = conv_id, begun + 1
            held.append(tuple(row))
            if begun == 1 and len(held) >= HANDED:  # the first conversation is open whatever follows
                as_open()
            if len(out) >= HANDED:
                yield _batch(out, schema)
                out.clear()
    as_open()
    yield _batch(out, schema)


def _open_faults(rows: DataFrame) -> DataFrame:
    """part, pos and fault of open rows; the first of equal rows is found by a combined aggregate."""
    left = rows.where("NOT gone")
    first = (
        left.where("NOT empty").groupBy("conv_id", "role", F.sha2("text", 256).alias("digest"))
        .agg(F.min(F.struct("part", "pos")).alias("at")).select("at.part", "at.pos", F.lit(False).alias("seen"))
    )
    light = left.select("conv_id", "part", "pos", "turn", F.substring("role", 1, 1).alias("initial"), "empty", "ended")
    return light.join(first, ["part", "pos"], "left").withColumn("seen", F.coalesce("seen", F.lit(True)))


PIECE = "conv_id long, part int, rows long, blank long, duplicate long, truncated long, illegal long, turns long, low long, high long, first string, last string"
SPANS = PIECE + ", begins array<int>, ends array<int>, costs array<long>, audits array<string>"


def _piece_spans(frame: pd.DataFrame) -> pd.DataFrame:
    """One row: the counts of a piece and its spans for all states."""
    frame = frame.sort_values("pos")
    piece, coded = Piece(), []
    for turn, initial, empty, seen, ended in zip(frame["turn"], frame["initial"], frame["empty"], frame["seen"], frame["ended"]):
        fault = _fault(empty, seen, ended)
        piece.add(None if pd.isna(turn) else int(turn), initial, fault)
        coded.append((initial, fault))
    spans = derive(coded, all_states=True)
    conv_id = frame["conv_id"].iloc[0]
    row = [None if pd.isna(conv_id) else int(conv_id), int(frame["part"].iloc[0]), *vars(piece).values()]
    row += [[q for q, _ in spans], [r for _, r in spans], [w[0] for w in spans.values()], [w[1] for w in spans.values()]]
    return pd.DataFrame([row], columns=[f.split()[0] for f in SPANS.split(", ")]).astype({"low": "Int64", "high": "Int64"})


PLAN = "conv_id long, gaps long, blank long, duplicate long, truncated long, illegal long, cost long, audit string, part int, edits string"


def _conversation_plan(frame: pd.DataFrame) -> pd.DataFrame:
    """The lightest repair over the pieces of a conversation, and the edits of each piece.

    A header row (part -1) has the result; one row for each piece has its share of the audit.
    """
    frame = frame.sort_values("part")
    total, leaves, sizes = Piece(), [], []
    for row in frame.itertuples(index=False):
        values = row._asdict()
        counts = {name: (None if pd.isna(values[name]) else values[name]) for name in vars(total)}
        total.join(Piece(**{n: v if v is None or n in ("first", "last") else int(v) for n, v in counts.items()}))
        leaves.append({(int(q), int(r)): (int(c), a) for q, r, c, a in zip(row.begins, row.ends, row.costs, row.audits)})
        sizes.append(int(row.rows))
    weights = joined_spans(leaves, sizes, [(START, end) for end in FINAL])
    weight = min(weights[START, end] for end in FINAL if (START, end) in weights)
    conv_id = frame["conv_id"].iloc[0]
    conv_id = None if pd.isna(conv_id) else int(conv_id)
    rows, at, edits = [(*_result(conv_id, total, weight, "")[:-1], -1, "")], 0, weight[1]
    for part, size in zip(frame["part"].tolist(), sizes):
        begun = at
        for _ in range(size):  # as many edits of rows, with the inserts before them
            while edits[at] == "I":
                at += 1
            at += 1
        if part == frame["part"].iloc[-1]:
            at = len(edits)
        rows.append((conv_id, *(None,) * 7, part, edits[begun:at]))
    return pd.DataFrame(rows, columns=[f.split()[0] for f in PLAN.split(", ")])


def _rewritten(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Results of conversations whose header, edits and rows come in order."""
    schema, out = _schema(RESULT), []
    header: tuple | None = None
    rewriter, edits, at = Rewriter(), "", 0
    for batch in batches:
        for conv_id, part, _, *rest in zip(*(column.to_pylist() for column in batch.columns)):
            *result, role, text, share = rest
            if part == -1:
                if header is not None:
                    rewriter.fill(edits, at)
                    out.append((*header, rewriter.hash.hexdigest()))
                header, rewriter, edits, at = (conv_id, *result), Rewriter(), "", 0
            elif share is not None:
                rewriter.fill(edits, at)
                edits, at = share, 0
            else:
                at = rewriter.edit(edits, at, role, text)
            if len(out) >= HANDED:
                yield _batch(out, schema)
                out.clear()
    if header is not None:
        rewriter.fill(edits, at)
        out.append((*header, rewriter.hash.hexdigest()))
    yield _batch(out, schema)


def repair(rows: DataFrame) -> DataFrame:
    """The counts, cost, audit and digest of the repaired rows of every conversation.

    `rows` has conv_id, turn, role and text, and may have `gone` for rows that only name
    their conversation. Rows are taken by turn, NULL first, then by role and text. NULL
    role or text counts as one space, rows without a conv_id are one conversation, and
    repeated rows are turns of their own. A role that begins otherwise than s, u or a can
    be changed or deleted, not kept. Very long texts are read whole. A conversation without
    rows gives zeros, an empty audit and the digest of nothing; an empty table gives an
    empty result; other columns are ignored.

    The audit of a conversation is one value and its digest is one SHA-256 over all its
    text, which goes in order: the last pass streams one conversation through one task.
    """
    spark = rows.sparkSession
    keys = ["conv_id", "turn", "role", "text"]
    dealt = _marked(rows).repartitionByRange(*keys).sortWithinPartitions(*keys)
    path = scratch_path(spark, "turns")
    dealt.mapInArrow(_first_pass, RESULT + ", " + OPEN).write.parquet(path)
    written = spark.read.parquet(path)
    closed = written.where("part IS NULL").select(*(f.split()[0] for f in RESULT.split(", ")))

    names = ["conv_id", *(f.split()[0] for f in OPEN.split(", "))]
    open_rows = written.where("part IS NOT NULL").select(*names)
    spans = _open_faults(open_rows).groupBy("conv_id", "part").applyInPandas(_piece_spans, SPANS)
    plans_path = scratch_path(spark, "turn-plans")
    spans.groupBy("conv_id").applyInPandas(_conversation_plan, PLAN).write.parquet(plans_path)
    plans = spark.read.parquet(plans_path)

    none = lambda kind, *ns: [F.lit(None).cast(kind).alias(n) for n in ns]
    result = [f.split()[0] for f in RESULT.split(", ")][1:-1]
    steps = plans.select("conv_id", "part", F.lit(-1).cast("long").alias("pos"), *result, *none("string", "role", "text"), F.col("edits").alias("share"))
    texts = open_rows.where("NOT gone").select(
        "conv_id", "part", "pos", *none("long", *result[:-1]), *none("string", "audit"), "role", "text", *none("string", "share"))
    in_order = steps.union(texts).repartition("conv_id").sortWithinPartitions("conv_id", "part", "pos")
    opened = in_order.mapInArrow(_rewritten, RESULT)

    nothing = [F.lit(0).cast("long").alias(n) for n in result[:-1]]
    left = open_rows.groupBy("conv_id").agg(F.bool_and("gone").alias("bare")).where("bare")
    bare = left.select("conv_id", *nothing, F.lit("").alias("audit"), F.lit(hashlib.sha256().hexdigest()).alias("repaired_sha256"))
    return closed.union(opened).union(bare)
