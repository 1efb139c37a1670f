"""Conversation structure repair: generalised LR over the role grammar, the cheapest edits of every conversation.

Rows of a conversation are read in order; a stack per way to read them is kept, equal stacks are merged by the least
(cost, audit), see ``role_grammar``. As the stacks of the grammar are few, a piece of a conversation is a table from the
stack before it to the stacks behind it, each with the least cost and its edits. So a long conversation is many tasks:

1. One row per distinct turn with its fault, without its text: equal rows are counted, and what an earlier turn has said
   is found by a join on a hash of the text.
2. These rows are sorted over all tasks by conversation and turn, and cut into chunks of bounded length, each of which
   becomes one row: its table of stacks, its counts, and where it starts. A conversation of any size is so many chunks.
3. The few rows of a conversation's chunks are joined up in order: forward the least cost per stack, backward the edits.
4. The edits of a chunk and the texts of its rows meet in sorted order. They are streamed through SHA-256, which has to
   see a conversation from front to back; nothing of it is held but the hash.

Audits are compared by ASCII: of equally cheap edits the least. An audit never is a proper beginning of another one of the
same rows, stack and cost, so merging prefixes loses none.

Defined cases: a NULL role or text is one space, which is no role and blank. A NULL ``conv_id`` is a conversation of its
own. Rows of the same turn come in the order of role and a hash of the text, so repeated rows stand side by side. Rows
without a turn come first. A role's initial decides whether it can be kept; an empty role has none and cannot. Any rows
may be missing: a conversation whose rows are all gone has zeros, an empty audit and the hash of the empty text, as has
one that is deleted whole (but its costs). Further columns do not matter. An empty table gives an empty result.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from dataclasses import dataclass, field
from functools import lru_cache

import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, BinaryType, BooleanType, IntegerType, LongType, StringType, StructType

from lettora.llm.role_grammar import BLANK, DUPLICATE, SOUND, TRUNCATED, RoleGrammar, Tops
from lettora.operators.skew import skew_join
from lettora.params import SkewLimits
from lettora.sources.shared import written

BLANKS = " \t\n\x0b\x0c\r"
#: What may follow what, by initials, and the roles that edits may give.
LEGAL = ("su", "ua", "au")
ROLES = {"u": "user", "a": "assistant"}
ORDER = ["conv", "turn", "role", "digest"]


@dataclass(frozen=True)
class RepairSpec:
    """``chunk_rows`` distinct turns at most are one chunk."""

    chunk_rows: int = 512


# --- damage -----------------------------------------------------------------------------------------------------------


def damaged(conversations: DataFrame) -> DataFrame:
    """The rows after damage by a hash of conversation and turn; ``n`` is 2 where a row is repeated."""
    conv, turn = (F.coalesce(F.col(key).cast("string"), F.lit(" ")) for key in ("conv_id", "turn"))
    name = F.concat(conv, F.lit(":"), turn)
    kind = F.crc32(name.cast("binary")) % 20
    rows = conversations.select(
        F.col("conv_id").cast("long").alias("conv_id"),
        F.col("turn").cast("long").alias("turn"),
        *(F.coalesce(F.col(text).cast("string"), F.lit(" ")).alias(text) for text in ("role", "text")),
        kind.alias("kind"),
    ).where("kind > 0")
    text = F.when(F.col("kind") == 1, "").when(F.col("kind") == 2, F.translate("text", ".!?", "")).otherwise(F.col("text"))
    return rows.select(
        "conv_id",
        "turn",
        F.when(F.col("kind") == 4, "user").otherwise(F.col("role")).alias("role"),
        text.alias("text"),
        F.when(F.col("kind") == 3, 2).otherwise(1).cast("long").alias("n"),
    )


def _keyed(rows: DataFrame) -> DataFrame:
    # As text, so that conversations without a number can be joined too.
    conv = F.coalesce(F.col("conv_id").cast("string"), F.lit("")).alias("conv")
    return rows.select(conv, "turn", "role", F.unhex(F.md5(F.col("text").cast("binary"))).alias("digest"), "text", "n")


def faulty_turns(rows: DataFrame, limits: SkewLimits = SkewLimits()) -> DataFrame:
    """``ORDER``, ``initial``, ``fault`` and ``copies``: a row per distinct turn, without its text."""
    trimmed = F.rtrim("text", F.lit(BLANKS))
    # NUL and other control characters are no blanks here, as in the pattern of the contract.
    turns = _keyed(rows).groupBy(*ORDER).agg(
        F.sum("n").alias("copies"),
        F.max(trimmed == "").alias("blank"),
        F.max(~F.right(trimmed, F.lit(1)).isin(".", "!", "?")).alias("cut"),
    )
    turns = written(turns, "turns")
    said = ["conv", "role", "digest"]
    # NULL turns come first, and a minimum skips NULLs.
    place = F.struct(F.col("turn").isNotNull().alias("known"), F.coalesce("turn", F.lit(0)).alias("turn"))
    firsts = written(turns.groupBy(*said).agg(F.min(place).alias("first"), F.count(F.lit(1)).alias("n")), "first_turns")
    joined = skew_join(turns, firsts.drop("n"), said, "inner", limits, firsts.select(*said, "n"))
    fault = F.when(F.col("blank"), BLANK).when(place > F.col("first"), DUPLICATE).when(F.col("cut"), TRUNCATED).otherwise(SOUND)
    return joined.select(*ORDER, F.substring("role", 1, 1).alias("initial"), fault.cast("int").alias("fault"), "copies")


# --- chunks -----------------------------------------------------------------------------------------------------------

_COUNTS = ("blank", "duplicate", "truncated", "illegal", "turns")
_WAY = StructType().add("before", IntegerType()).add("behind", IntegerType()).add("cost", LongType()).add("audit", StringType())
_CHUNK = StructType().add("conv", StringType()).add("turn", LongType()).add("role", StringType()).add("digest", BinaryType())
_CHUNK.add("chunk", LongType()).add("first_initial", StringType()).add("last_initial", StringType())
_CHUNK.add("first_turn", LongType()).add("last_turn", LongType())
for _name in _COUNTS:
    _CHUNK.add(_name, LongType())
_CHUNK.add("ways", ArrayType(_WAY))


@lru_cache(maxsize=1)
def grammar() -> RoleGrammar:
    return RoleGrammar()


def _arrow(schema: StructType) -> pa.Schema:
    from pyspark.sql.pandas.types import to_arrow_schema

    return to_arrow_schema(schema)


class _Chunk:
    """A run of turns of one conversation, read from every stack there can be before it."""

    def __init__(self, row: tuple, at_start: bool):
        self.key = row[:4]
        nodes = range(1 if at_start else len(grammar().step))
        self.tops: dict[int, Tops] = {node: {node: (0, "")} for node in nodes}
        self.rows = 0
        self.counts = dict.fromkeys(_COUNTS, 0)
        self.initials: list[str] = []
        self.turns: list[int | None] = [None, None]

    def add(self, row: tuple) -> None:
        _, turn, _, _, initial, fault, copies = row
        for node, tops in self.tops.items():
            self.tops[node] = grammar().after_row(tops, initial, fault, copies)
        counts = self.counts
        counts["blank"] += copies if fault == BLANK else 0
        counts["duplicate"] += copies if fault == DUPLICATE else copies - 1 if fault != BLANK else 0
        counts["truncated"] += fault == TRUNCATED
        counts["illegal"] += (copies - 1) * illegal(initial, initial)
        if self.initials:
            counts["illegal"] += illegal(self.initials[1], initial)
        if turn is not None and turn != self.turns[1]:
            counts["turns"] += 1
            self.turns = [turn if self.turns[0] is None else self.turns[0], turn]
        self.initials = [self.initials[0] if self.initials else initial, initial]
        self.rows += 1

    def row(self, number: int) -> tuple:
        ways = [
            {"before": before, "behind": behind, "cost": cost, "audit": audit}
            for before, tops in self.tops.items()
            for behind, (cost, audit) in tops.items()
        ]
        return (*self.key, number, *self.initials, *self.turns, *self.counts.values(), ways)


def illegal(before: str, initial: str) -> bool:
    return before + initial not in LEGAL


def _chunk_rows(batches: Iterator[pa.RecordBatch], chunk_rows: int) -> Iterator[pa.RecordBatch]:
    """Sorted turns -> chunks. Chunk numbers rise with the sort order, over all tasks."""
    task, made, arrow = TaskContext.get().partitionId(), 0, _arrow(_CHUNK)
    chunk: _Chunk | None = None
    out: list[tuple] = []

    def flushed() -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*out), arrow)], schema=arrow)

    for batch in batches:
        for row in zip(*(column.to_pylist() for column in batch.columns)):
            if chunk is None or chunk.key[0] != row[0] or chunk.rows == chunk_rows:
                # The first conversation of a task may have begun in another one.
                new = chunk is not None and chunk.key[0] != row[0]
                if chunk is not None:
                    out.append(chunk.row(task << 40 | made))
                    made += 1
                chunk = _Chunk(row, new)
            chunk.add(row)
        if len(out) >= 1000:
            yield flushed()
            out = []
    if chunk is not None:
        out.append(chunk.row(task << 40 | made))
    if out:
        yield flushed()


def chunks(turns: DataFrame, spec: RepairSpec = RepairSpec()) -> DataFrame:
    """``faulty_turns`` -> a row per chunk, ``ORDER`` being that of its first turn."""
    size = spec.chunk_rows
    ordered = turns.repartitionByRange(*ORDER).sortWithinPartitions(*ORDER)
    return ordered.mapInArrow(lambda batches: _chunk_rows(batches, size), _CHUNK)


# --- conversations ----------------------------------------------------------------------------------------------------

#: A row for a chunk (with ``edits``, from the stack ``before``) or for a whole conversation (with the rest).
_PLAN = StructType(_CHUNK.fields[:4]).add("before", IntegerType()).add("edits", StringType()).add("whole", BooleanType())
for _name in ("gaps", "blank", "duplicate", "truncated", "illegal", "cost"):
    _PLAN.add(_name, LongType())
_PLAN.add("audit", StringType())


@dataclass
class _Way:
    """The least way to a stack behind a chunk; earlier chunks are shared with other ways."""

    cost: int
    edits: str
    before: int
    up: "_Way | None" = None

    def less(self, other: "_Way") -> bool:
        if self.cost != other.cost:
            return self.cost < other.cost
        mine, others = [], []
        a: _Way | None = self
        b: _Way | None = other
        while a is not b and a is not None and b is not None:
            mine.append(a.edits)
            others.append(b.edits)
            a, b = a.up, b.up
        return "".join(reversed(mine)) < "".join(reversed(others))


@dataclass
class _Conversation:
    conv: str
    ways: dict[int, _Way | None] = field(default_factory=lambda: {0: None})
    keys: list[tuple] = field(default_factory=list)
    counts: dict[str, int] = field(default_factory=lambda: dict.fromkeys(_COUNTS, 0))
    turns: list[int | None] = field(default_factory=lambda: [None, None])
    initial: str | None = None

    def add(self, row: dict) -> None:
        for name in _COUNTS:
            self.counts[name] += row[name]
        if self.initial is not None:
            self.counts["illegal"] += illegal(self.initial, row["first_initial"])
        self.initial = row["last_initial"]
        if row["first_turn"] is not None:
            self.counts["turns"] -= row["first_turn"] == self.turns[1]
            self.turns = [row["first_turn"] if self.turns[0] is None else self.turns[0], row["last_turn"]]
        self.keys.append(tuple(row[name] for name in ORDER))
        new: dict[int, _Way] = {}
        for step in row["ways"]:
            if step["before"] in self.ways:
                up = self.ways[step["before"]]
                way = _Way(step["cost"] + (up.cost if up else 0), step["audit"], step["before"], up)
                if step["behind"] not in new or way.less(new[step["behind"]]):
                    new[step["behind"]] = way
        self.ways = new

    def rows(self) -> Iterator[tuple]:
        """The edits of every chunk, and what there is to say about the conversation."""
        last: _Way | None = None
        for node, way in self.ways.items():
            for end, (cost, inserts) in grammar().with_inserts({node: (way.cost, "")}).items():
                if end in grammar().accepts:
                    ended = _Way(cost, way.edits + inserts, way.before, way.up)
                    if last is None or ended.less(last):
                        last = ended
        edits: list[tuple[int, str]] = []
        way, cost = last, last.cost
        while way is not None:
            edits.append((way.before, way.edits))
            way = way.up
        edits.reverse()
        for key, (before, piece) in zip(self.keys, edits, strict=True):
            yield (*key, before, piece, False, *[None] * 7)
        first, final = self.turns
        gaps = 0 if first is None else final - first + 1 - self.counts["turns"]
        counts = (self.counts[name] for name in _COUNTS[:4])
        yield (*self.keys[0], None, None, True, gaps, *counts, cost, "".join(piece for _, piece in edits))


def _plan_rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    arrow = _arrow(_PLAN)
    held: _Conversation | None = None
    out: list[tuple] = []

    def flushed() -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*out), arrow)], schema=arrow)

    for batch in batches:
        for row in batch.to_pylist():
            if held is None or held.conv != row["conv"]:
                out += held.rows() if held else ()
                held = _Conversation(row["conv"])
            held.add(row)
        if len(out) >= 1000:
            yield flushed()
            out = []
    if held:
        out += held.rows()
    if out:
        yield flushed()


# --- repaired texts ---------------------------------------------------------------------------------------------------

_HASHED = StructType().add("conv", StringType()).add("repaired_sha256", StringType())
REPAIRED = StructType().add("conv", StringType()).add("at", LongType()).add("role", StringType()).add("text", StringType())


class _Editor:
    """Carries out the edits of one conversation, turn by turn."""

    def __init__(self) -> None:
        self.edits: Iterator[str] = iter("")
        self.node = 0

    def chunk(self, before: int, edits: str) -> None:
        self.edits, self.node = iter(edits), before

    def _insert(self) -> tuple[str, str]:
        role, self.node = grammar().filler(self.node)
        return ROLES[role], ""

    def turn(self, role: str, text: str) -> Iterator[tuple[str, str]]:
        while (edit := next(self.edits)) == "I":
            yield self._insert()
        if edit == "K":
            self.node = grammar().step[self.node][role[:1]]
            yield role, text
        elif edit == "R":
            given, self.node = grammar().filler(self.node)
            yield ROLES[given], text

    def end(self) -> Iterator[tuple[str, str]]:
        for _ in self.edits:
            yield self._insert()


def _edited(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[str, str | None, str | None]]:
    """Sorted turns and chunks -> conversation, role and text of each turn that remains, in order.

    A conversation begins with a row that has no role.
    """
    conv, editor = None, _Editor()
    for batch in batches:
        for at, role, text, n, before, edits in zip(*(batch.column(c).to_pylist() for c in ("conv", "role", "text", "n", "before", "edits"))):
            if at != conv:
                for turn in editor.end():
                    yield conv, *turn
                conv, editor = at, _Editor()
                yield conv, None, None
            if edits is not None:
                editor.chunk(before, edits)
                continue
            for _ in range(n):
                for turn in editor.turn(role, text):
                    yield conv, *turn
    for turn in editor.end():
        yield conv, *turn


def _hash_rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    arrow = _arrow(_HASHED)
    out: list[list[str]] = [[], []]
    conv, sha, between = None, hashlib.sha256(), b""
    for at, role, text in _edited(batches):
        if role is None:
            if conv is not None:
                out[0].append(conv)
                out[1].append(sha.hexdigest())
            conv, sha, between = at, hashlib.sha256(), b""
            if len(out[0]) >= 1000:
                yield pa.RecordBatch.from_arrays([pa.array(c, pa.string()) for c in out], schema=arrow)
                out = [[], []]
            continue
        sha.update(between + f"{role}:{text}".encode())
        between = b"\n"
    if conv is not None:
        out[0].append(conv)
        out[1].append(sha.hexdigest())
        yield pa.RecordBatch.from_arrays([pa.array(c, pa.string()) for c in out], schema=arrow)


def _repaired_rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    arrow = _arrow(REPAIRED)
    out: list[tuple] = []
    at = 0
    for conv, role, text in _edited(batches):
        if role is None:
            at = 0
            continue
        out.append((conv, at, role, text))
        at += 1
        if len(out) >= 1000:
            yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*out), arrow)], schema=arrow)
            out = []
    if out:
        yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*out), arrow)], schema=arrow)


@dataclass(frozen=True)
class Repair:
    """What was found: ``plan`` (per chunk the edits, per conversation the counts, cost and audit) of the given ``rows``."""

    rows: DataFrame
    plan: DataFrame

    def conversations(self) -> DataFrame:
        names = [f.name for f in _PLAN.fields[7:]]
        return self.plan.where("whole").select("conv", *names)

    def _in_order(self) -> DataFrame:
        none = F.lit(None)
        turns = _keyed(self.rows).select(*ORDER, F.lit(1).alias("kind"), "text", "n", none.cast("int").alias("before"), none.cast("string").alias("edits"))
        edits = self.plan.where("not whole").select(
            *ORDER, F.lit(0).alias("kind"), none.cast("string").alias("text"), F.lit(0).cast("long").alias("n"), "before", "edits"
        )
        both = turns.union(edits).repartition("conv").sortWithinPartitions(*ORDER, "kind")
        return both.select("conv", "role", "text", "n", "before", "edits")

    def turns(self) -> DataFrame:
        """``conv``, ``at``, ``role``, ``text`` of the repaired conversations."""
        return self._in_order().mapInArrow(_repaired_rows, REPAIRED)

    def hashes(self) -> DataFrame:
        return self._in_order().mapInArrow(_hash_rows, _HASHED)


def repair(rows: DataFrame, spec: RepairSpec = RepairSpec(), limits: SkewLimits = SkewLimits()) -> Repair:
    """The cheapest repair of conversations: ``conv_id``, ``turn``, ``role``, ``text`` and ``n``, how often a row counts."""
    pieces = written(chunks(faulty_turns(rows, limits), spec), "chunks")
    plan = pieces.repartition("conv").sortWithinPartitions("conv", "chunk").mapInArrow(_plan_rows, _PLAN)
    return Repair(rows, written(plan, "repairs"))


def repaired_conversations(
    conversations: DataFrame, spec: RepairSpec = RepairSpec(), limits: SkewLimits = SkewLimits()
) -> DataFrame:
    """A row per conversation of ``conversations``: what damage did to it, and what repairing it takes."""
    repaired = repair(damaged(conversations), spec, limits)
    conv_id = F.col("conv_id").cast("long")
    every = conversations.groupBy(conv_id.alias("conv_id")).agg(F.first(F.coalesce(conv_id.cast("string"), F.lit(""))).alias("conv"))
    joined = every.join(repaired.conversations(), "conv", "left").join(repaired.hashes(), "conv", "left")

    def or_zero(name: str) -> Column:
        return F.coalesce(name, F.lit(0)).cast("long").alias(name)

    numbers = [or_zero(name) for name in ("gaps", "blank", "duplicate", "truncated", "illegal", "cost")]
    audit = F.coalesce("audit", F.lit("")).alias("audit")
    return joined.select("conv_id", *numbers, audit, F.coalesce("repaired_sha256", F.sha2(F.lit(b""), 256)).alias("repaired_sha256"))
