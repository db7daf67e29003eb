"""Repairing the turns of conversations at the least cost.

Rows are dealt out in the order of conversations and turns and read as a stream. A
conversation that lies inside one task and fits a block is searched at once
(``edit_lattice``). Others are cut into blocks, each summed up by its costs between the states
of the wanted order: sixteen numbers, which are chained in a tree, so a conversation of any
length is many blocks in many tasks and never one group. On the way back down the tree every
block learns the states it is entered and left in, and is searched between these.

A row whose role and text were seen earlier must be known before the stream is read. Only
such rows, without their texts, are found by grouping and sent along as marks in front of the
rows they mean. The last sort key is a number of the row, so exact copies are spread as well.
"""

from __future__ import annotations

import hashlib
from collections.abc import Callable, Iterator
from dataclasses import dataclass

import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.pandas.types import to_arrow_schema

from tracemill.llm import edit_lattice as lattice
from tracemill.llm.batches import ROWS_PER_SLICE, map_slices
from tracemill.sources.staging import release, stage


@dataclass(frozen=True)
class Limits:
    """A block has at most so many rows, and is closed by so many characters. So many bits of
    a block's number are one step of the tree."""

    rows: int = 256
    chars: int = 8 << 20
    fan_bits: int = 10


LIMITS = Limits()
# White space, sentence ends, and the neighbours that are in order.
NOT_BLANK = "[^\\x20\\x09-\\x0D]"
ENDS_WELL = "[.!?][\\x20\\x09-\\x0D]*\\z"
IN_ORDER = ("su", "ua", "au")
EMPTY_SHA256 = hashlib.sha256().hexdigest()
LARGEST = (1 << 63) - 1

COUNTS = ("blank", "duplicate", "truncated", "illegal", "turns")
PART = (
    "costs array<long>, ranks array<int>, blank long, duplicate long, truncated long, illegal long, "
    "turns long, low long, high long, first_turn long, last_turn long, head string, tail string"
)
# One table for what a task finds: whole conversations, blocks, their rows, and repaired turns.
STREAM = "kind string, task int, nth long, place int, edit string, role string, text string, " + (
    "pattern string, gaps long, cost long, audit string, repaired_sha256 string, " + PART
)


def following(a: dict, b: dict) -> dict:
    """The counts of two consecutive parts of a conversation."""
    both = {name: a[name] + b[name] for name in COUNTS}
    both["illegal"] += a["tail"] + b["head"] not in IN_ORDER
    both["turns"] -= a["last_turn"] is not None and a["last_turn"] == b["first_turn"]
    lows = [x["low"] for x in (a, b) if x["low"] is not None]
    highs = [x["high"] for x in (a, b) if x["high"] is not None]
    ends = {"low": min(lows, default=None), "high": max(highs, default=None)}
    edges = {"first_turn": a["first_turn"], "last_turn": b["last_turn"], "head": a["head"], "tail": b["tail"]}
    return both | ends | edges


def gaps(part: dict) -> int:
    if part["low"] is None:
        return 0
    return min(part["high"] - part["low"] + 1 - part["turns"], LARGEST)


def audit_with_drops(pattern: str, letters: str) -> str:
    """Letters of the rows that need not go, with those of the others (``-``) put in.

    At equal cost a deletion stands in front of an insertion, as D is less than I.
    """
    shown, at = [], 0
    for code in pattern:
        if code == "-":
            shown.append("D")
            continue
        start = at
        while letters[at] == "I":
            at += 1
        at += 1
        shown.append(letters[start:at])
    return "".join(shown) + letters[at:]


def repaired(codes: str, letters: str, state: int) -> Iterator[tuple[str, str | None, int | None]]:
    """Edit, new role if any, and the row it takes, for every turn that remains."""
    at = 0
    for letter in letters:
        if letter == "I":
            state = lattice.SET[state]
            yield letter, lattice.ROLE_OF[state], None
            continue
        if letter == "K":
            state = lattice.KEPT[codes[at].lower()][state]
            yield letter, None, at
        elif letter == "R":
            state = lattice.SET[state]
            yield letter, lattice.ROLE_OF[state], at
        at += 1


class Lines:
    """SHA-256 of ``role:text`` lines, joined by newlines."""

    def __init__(self) -> None:
        self.sha, self.none = hashlib.sha256(), True

    def add(self, role: str, text: str) -> None:
        self.sha.update(f"{role}:{text}".encode() if self.none else f"\n{role}:{text}".encode())
        self.none = False


class Stream:
    """Reads the sorted rows of a task and writes rows of ``STREAM``."""

    def __init__(self, task: int, limits: Limits, with_turns: bool, out: list[dict]) -> None:
        self.task, self.limits, self.with_turns, self.out = task, limits, with_turns, out
        self.conv: tuple | None = None
        self.first = True
        self.nth = 0
        self.before: tuple | None = None
        self.late: tuple | None = None
        self._empty()

    def _empty(self) -> None:
        self.rows: list[tuple[str, str]] = []
        self.pattern: list[str] = []
        self.chars = 0
        self.part = None
        self.blocks_closed = False

    def read(self, conv, turn, role, digest, salt, kind, text, fault) -> None:
        key = conv, turn, role, digest, salt
        if kind == 0:
            self.late = key
            return
        if self.conv is None or self.conv[0] != conv:
            if self.conv is not None:
                self._finish(self.first)
                self.first = False
            self.conv, self.before = (conv,), None
        elif len(self.pattern) >= self.limits.rows or self.chars >= self.limits.chars:
            self._close()
            self.blocks_closed = True
        # Marks stand in front of their row; copies with one number stand side by side.
        repeated = self.late == key or self.before == key
        self.before = key
        if fault != "blank" and repeated:
            fault = "duplicate"
        initial = role[:1]
        one = dict.fromkeys(COUNTS, 0)
        if fault:
            one[fault] = 1
        one["turns"] = int(turn is not None)
        one |= {"low": turn, "high": turn, "first_turn": turn, "last_turn": turn, "head": initial, "tail": initial}
        self.part = following(self.part, one) if self.part else one
        if fault in ("blank", "duplicate"):
            self.pattern.append("-")
            return
        code = initial if initial and initial in "sua" else "o"
        self.pattern.append(code.upper() if fault else code)
        self.rows.append((role, text))
        self.chars += len(text)

    def _finish(self, open_: bool) -> None:
        """End the conversation; ``open_`` if more of it may lie in another task."""
        if self.part is None:
            return
        if open_ or self.blocks_closed:
            self._close()
        else:
            self._whole()
        self._empty()

    def end(self) -> None:
        if self.conv is not None:
            self._finish(True)

    def _whole(self) -> None:
        pattern = "".join(self.pattern)
        codes = pattern.replace("-", "")
        cost, letters = lattice.repair(codes)
        lines = Lines()
        for place, (edit, role, at) in enumerate(repaired(codes, letters, lattice.START)):
            old, text = self.rows[at] if at is not None else ("", "")
            lines.add(role or old, text)
            if self.with_turns:
                self._write("turn", place=place, edit=edit, role=role or old, text=text)
        self._write(
            "whole",
            gaps=gaps(self.part),
            cost=cost + lattice.DELETE * (len(pattern) - len(codes)),
            audit=audit_with_drops(pattern, letters),
            repaired_sha256=lines.sha.hexdigest(),
            **{name: self.part[name] for name in COUNTS},
        )

    def _close(self) -> None:
        """Write the block and its rows, and begin another one."""
        pattern = "".join(self.pattern)
        ways = lattice.summarize(pattern.replace("-", ""))
        self._write(
            "block",
            pattern=pattern,
            costs=[way[0] if way else -1 for way in ways],
            ranks=[way[1] if way else -1 for way in ways],
            **self.part,
        )
        for place, (role, text) in enumerate(self.rows):
            self._write("row", place=place, role=role, text=text)
        self.nth += 1
        self.rows, self.pattern, self.chars, self.part = [], [], 0, None

    def _write(self, kind: str, **values) -> None:
        self.out.append({"kind": kind, "conv": self.conv[0], "task": self.task, "nth": self.nth, **values})


def _stream(rows: DataFrame, conv_type: str, limits: Limits, with_turns: bool) -> DataFrame:
    wanted = T._parse_datatype_string(f"conv {conv_type}, {STREAM}")
    arrow = to_arrow_schema(wanted)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        out: list[dict] = []
        stream = Stream(TaskContext.get().partitionId(), limits, with_turns, out)
        for batch in batches:
            for start in range(0, batch.num_rows, ROWS_PER_SLICE):
                for row in zip(*(c.to_pylist() for c in batch.slice(start, ROWS_PER_SLICE).columns)):
                    stream.read(*row)
                if out:
                    yield pa.RecordBatch.from_pylist(out, schema=arrow)
                    out.clear()
        stream.end()
        if out:
            yield pa.RecordBatch.from_pylist(out, schema=arrow)

    return rows.mapInArrow(run, wanted)


def _ways(part: dict) -> lattice.Summary:
    return [(c, r) if c >= 0 else None for c, r in zip(part["costs"], part["ranks"])]


def _chained(fan_bits: int) -> Callable[[pa.Table], pa.Table]:
    """One part out of consecutive ones of a conversation, for a group of the tree."""

    def step(table: pa.Table) -> pa.Table:
        parts = sorted(table.to_pylist(), key=lambda part: part["address"])
        ways, counts = _ways(parts[0]), parts[0]
        for part in parts[1:]:
            ways, counts = lattice.chain(ways, _ways(part)), following(counts, part)
        whole = counts | {
            "conv": parts[0]["conv"],
            "address": parts[0]["address"] >> fan_bits,
            "costs": [way[0] if way else -1 for way in ways],
            "ranks": [way[1] if way else -1 for way in ways],
        }
        return pa.Table.from_pylist([whole], schema=table.schema)

    return step


def _descended(schema: pa.Schema) -> Callable[[pa.Table], pa.Table]:
    """Where each part of a group is entered and left, if the group's states are known."""

    def step(table: pa.Table) -> pa.Table:
        parts = sorted(table.to_pylist(), key=lambda part: part["address"])
        states = lattice.crossed_states([_ways(p) for p in parts], parts[0]["entry"], parts[0]["exit"])
        rows = [
            {"conv": p["conv"], "address": p["address"], "entry": a, "exit": b, "last": False}
            for p, a, b in zip(parts, states, states[1:])
        ]
        rows[-1]["last"] = parts[0]["last"]
        return pa.Table.from_pylist(rows, schema=schema)

    return step


SOLVED = "address long, cost long, audit string, edits array<struct<edit: string, role: string, place: int>>"


def _solve_blocks(blocks: DataFrame, conv_type: str) -> DataFrame:
    """Audit and edits of blocks between their states."""

    def make():
        def step(convs, addresses, patterns, entries, exits, lasts):
            rows = []
            for conv, address, pattern, entry, exit_, last in zip(convs, addresses, patterns, entries, exits, lasts):
                codes = pattern.replace("-", "")
                cost, letters = lattice.cheapest(codes, entry, (exit_,), False)
                tail = lattice.TAILS[exit_] if last else ""
                cost += lattice.DELETE * (len(pattern) - len(codes)) + lattice.INSERT * len(tail)
                edits = [{"edit": e, "role": r, "place": p} for e, r, p in repaired(codes, letters + tail, entry)]
                rows.append((conv, address, cost, audit_with_drops(pattern, letters) + tail, edits))
            return [list(column) for column in zip(*rows)]

        return step

    return map_slices(blocks, make, f"conv {conv_type}, {SOLVED}")


def _hash_lines(lines: DataFrame, conv_type: str) -> DataFrame:
    """SHA-256 of the lines of each conversation, which stand in order in one partition."""
    wanted = T._parse_datatype_string(f"conv {conv_type}, repaired_sha256 string")
    arrow = to_arrow_schema(wanted)

    def run(batches):
        now, found = None, []
        for batch in batches:
            for start in range(0, batch.num_rows, ROWS_PER_SLICE):
                part = batch.slice(start, ROWS_PER_SLICE)
                for conv, role, text in zip(*(c.to_pylist() for c in part.columns)):
                    if now is None or now[0] != conv:
                        if now:
                            found.append({"conv": now[0], "repaired_sha256": now[1].sha.hexdigest()})
                        now = conv, Lines()
                    now[1].add(role, text)
        if now:
            found.append({"conv": now[0], "repaired_sha256": now[1].sha.hexdigest()})
        yield pa.RecordBatch.from_pylist(found, schema=arrow)

    return lines.mapInArrow(run, wanted)


REPORT = ("gaps", "blank", "duplicate", "truncated", "illegal", "cost", "audit", "repaired_sha256")


@dataclass
class Repair:
    """The stored findings about all conversations."""

    found: DataFrame
    levels: list[DataFrame]
    roots: DataFrame | None
    solved: DataFrame
    with_turns: bool

    def _conv_type(self) -> str:
        return self.found.schema["conv"].dataType.simpleString()

    def _open_turns(self) -> DataFrame:
        edits = self.solved.select("conv", "address", F.posexplode("edits").alias("order", "edit"))
        edits = edits.select("conv", "address", "order", "edit.*").alias("e")
        rows = self.found.filter("kind = 'row'")
        rows = rows.select(self.address().alias("address"), "place", F.col("role").alias("old"), "text").alias("r")
        same = (F.col("e.address") == F.col("r.address")) & (F.col("e.place") == F.col("r.place"))
        role, text = F.coalesce("e.role", "r.old", F.lit("")), F.coalesce("r.text", F.lit(""))
        return edits.join(rows, same, "left").select(
            "conv", "e.address", "order", "edit", role.alias("role"), text.alias("text")
        )

    @staticmethod
    def address() -> Column:
        return F.col("address_high") + F.col("nth")

    def turns(self) -> DataFrame:
        """``conv, block, place, edit, role, text``: the repaired turns, in this order."""
        if not self.with_turns:
            raise ValueError("turns are stored only if asked for")
        whole = self.found.filter("kind = 'turn'")
        whole = whole.select("conv", F.lit(0).cast("long").alias("block"), "place", "edit", "role", "text")
        rest = self._open_turns().select(
            "conv", F.col("address").alias("block"), F.col("order").alias("place"), "edit", "role", "text"
        )
        return whole.unionByName(rest)

    def report(self) -> DataFrame:
        """One row for each conversation with its counts, cost, audit and hash."""
        whole = self.found.filter("kind = 'whole'").select("conv", *REPORT)
        if self.roots is None:
            return whole
        lines = self._open_turns().repartition("conv").sortWithinPartitions("conv", "address", "order")
        hashes = _hash_lines(lines.select("conv", "role", "text"), self._conv_type())
        ordered = F.array_sort(F.collect_list(F.struct("address", "audit")))
        audits = self.solved.groupBy("conv").agg(
            F.sum("cost").alias("cost"),
            F.array_join(F.transform(ordered, lambda block: block["audit"]), "").alias("audit"),
        )
        span = F.col("high").cast("decimal(38,0)") - F.col("low") + 1 - F.col("turns")
        counts = self.roots.select(
            "conv",
            F.coalesce(F.least(span, F.lit(LARGEST)).cast("long"), F.lit(0)).alias("gaps"),
            *COUNTS[:4],
        )
        joined = counts.alias("c").join(audits.alias("a"), F.expr("c.conv <=> a.conv"))
        joined = joined.join(hashes.alias("h"), F.expr("c.conv <=> h.conv"), "left").select(
            "c.*", "cost", "audit", F.coalesce("repaired_sha256", F.lit(EMPTY_SHA256)).alias("repaired_sha256")
        )
        return whole.unionByName(joined)

    def release(self) -> None:
        """Delete the stored tables, once no outcome is needed any more."""
        for table in (self.found, self.solved, *self.levels):
            release(table)


def _given_rows(df: DataFrame, conv: str, turn: str, role: str, text: str) -> DataFrame:
    """The rows with a number, a digest of the text, and the faults one row shows."""
    given = df.select(
        F.col(conv).alias("conv"),
        F.col(turn).cast("long").alias("turn"),
        F.coalesce(F.col(role), F.lit(" ")).alias("role"),
        F.coalesce(F.col(text), F.lit(" ")).alias("text"),
    )
    fault = F.when(~F.col("text").rlike(NOT_BLANK), "blank").when(~F.col("text").rlike(ENDS_WELL), "truncated")
    return given.select(
        "conv", "turn", "role", F.unhex(F.md5("text")).alias("digest"),
        F.xxhash64(F.monotonically_increasing_id()).alias("salt"), "text", fault.alias("fault"),
    )


def _late_rows(rows: DataFrame) -> DataFrame:
    """Keys of the rows whose role and text an earlier row has; no texts are moved."""
    order = F.struct(F.col("turn").isNotNull().alias("told"), "turn", "salt")
    light = rows.filter("fault is null or fault <> 'blank'").select("conv", "turn", "role", "digest", "salt")
    seen = light.groupBy("conv", "role", "digest").agg(F.min(order).alias("first"), F.count("*").alias("times"))
    same = F.expr("l.conv <=> s.conv and l.role = s.role and l.digest = s.digest")
    both = light.alias("l").join(seen.filter("times > 1").alias("s"), same)
    return both.filter(order > F.col("first")).select("l.*")


def repair_conversations(
    df: DataFrame,
    conv: str = "conv_id",
    turn: str = "turn",
    role: str = "role",
    text: str = "text",
    with_turns: bool = True,
    limits: Limits = LIMITS,
) -> Repair:
    """Find each row's first fault and the cheapest edits that bring all turns in order.

    A row is blank without a character that is not white space, a duplicate if role and text
    stand in an earlier row, truncated if it does not end a sentence. Blank and duplicate
    rows go; truncated ones cost five more where they stay. Of edits at one cost the audit
    that comes first in ASCII is taken.

    A null role or text is one blank, which is no known role and a blank text. A null id is a
    conversation of its own. Null turns come first; rows of one turn are taken by role and
    then by a hash of the text. Repeated rows are duplicates. An empty table has no
    conversations; only the four named columns are looked at. ``with_turns`` stores the
    repaired turns as well.

    The hash of a conversation is taken in order, as SHA-256 must be: one that spans tasks is
    streamed through one task for it, while its search and audit are not.
    """
    kind = df.schema[conv].dataType.simpleString()
    rows = stage(_given_rows(df, conv, turn, role, text), "turns")
    late = stage(_late_rows(rows), "late-turns")
    keys = ("conv", "turn", "role", "digest", "salt")
    marks = late.select(*keys, F.lit(0).alias("kind"), F.lit(None).cast("string").alias("text"))
    marks = marks.withColumn("fault", F.lit(None).cast("string"))
    dealt = rows.select(*keys, F.lit(1).alias("kind"), "text", "fault").unionByName(marks)
    order = (F.col("conv").asc_nulls_first(), F.col("turn").asc_nulls_first(), "role", "digest", "salt")
    dealt = dealt.repartitionByRange(*order).sortWithinPartitions(*order, "kind")
    found = stage(_stream(dealt, kind, limits, with_turns), "conversations")
    release(rows)
    release(late)

    blocks = found.filter("kind = 'block'")
    top = blocks.agg(F.max("task").alias("task"), F.max("nth").alias("nth")).first()
    bits = (top.nth or 0).bit_length()
    high = F.shiftleft(F.col("task").cast("long"), bits)
    found = found.withColumn("address_high", high)
    if top.task is None:
        empty = T._parse_datatype_string(f"conv {kind}, {SOLVED}")
        solved = stage(df.sparkSession.createDataFrame([], empty), "blocks")
        return Repair(found, [], None, solved, with_turns)

    level = blocks.select("conv", (high + F.col("nth")).alias("address"), *_names(PART))
    levels, largest = [], (top.task << bits) + top.nth
    schema = T._parse_datatype_string(f"conv {kind}, address long, {PART}")
    while largest > 0:
        group = F.shiftright("address", limits.fan_bits)
        levels.append(level)
        level = stage(level.groupBy("conv", group).applyInArrow(_chained(limits.fan_bits), schema), "parts")
        largest >>= limits.fan_bits
    roots = level
    ways = f"conv {kind}, address long, entry int, exit int, last boolean"
    known_arrow = to_arrow_schema(T._parse_datatype_string(ways))

    def make():
        def step(convs, addresses, costs, ranks):
            exits = [lattice.final_exit(_ways({"costs": c, "ranks": r})) for c, r in zip(costs, ranks)]
            return [convs, addresses, [lattice.START] * len(exits), exits, [True] * len(exits)]

        return step

    known = map_slices(roots.select("conv", "address", "costs", "ranks"), make, ways)
    for level in reversed(levels):
        parts = level.select("conv", "address", "costs", "ranks").alias("p")
        same = F.expr(f"p.conv <=> k.conv and shiftright(p.address, {limits.fan_bits}) = k.address")
        joined = parts.join(known.alias("k"), same).select("p.*", "entry", "exit", "last")
        group = F.shiftright("address", limits.fan_bits)
        known = joined.groupBy("conv", group).applyInArrow(_descended(known_arrow), ways)
    patterns = blocks.select("conv", (high + F.col("nth")).alias("address"), "pattern").alias("b")
    between = patterns.join(known.alias("k"), F.expr("b.conv <=> k.conv and b.address = k.address"))
    solved = _solve_blocks(between.select("b.*", "entry", "exit", "last"), kind)
    return Repair(found, levels[1:] + [roots], roots, stage(solved, "blocks"), with_turns)


def _names(fields: str) -> list[str]:
    return T._parse_datatype_string(fields).names


def damaged(df: DataFrame) -> DataFrame:
    """Conversations with faults put in by a checksum of ``conv_id:turn``, nulls as one blank.

    Of twenty values 0 drops the row, 1 empties its text, 2 takes its sentence ends out, 3
    repeats it and 4 makes it the user's.
    """
    known = [F.coalesce(F.col(name).cast("string"), F.lit(" ")) for name in ("conv_id", "turn")]
    draw = F.crc32(F.concat_ws(":", *known)) % 20
    text = F.coalesce(F.col("text"), F.lit(" "))
    text = F.when(draw == 1, "").when(draw == 2, F.regexp_replace(text, "[.!?]", "")).otherwise(text)
    role = F.when(draw == 4, "user").otherwise(F.coalesce(F.col("role"), F.lit(" ")))
    rows = df.filter(draw != 0).select(
        "conv_id", "turn", role.alias("role"), text.alias("text"),
        F.explode(F.array_repeat(F.lit(1), F.when(draw == 3, 2).otherwise(1))).alias("copy"),
    )
    return rows.drop("copy")


def repair_report(df: DataFrame, limits: Limits = LIMITS) -> DataFrame:
    """The report about every original conversation after its damage.

    A conversation of which no row is left has zeros, an empty audit and the hash of
    nothing; a null ``conv_id`` is a conversation. An empty table gives an empty one.
    """
    found = repair_conversations(damaged(df), with_turns=False, limits=limits).report().alias("r")
    every = df.select("conv_id").distinct().alias("o")
    joined = every.join(found, F.expr("o.conv_id <=> r.conv"), "left")
    numbers = [F.coalesce(F.col(name), F.lit(0)).cast("long").alias(name) for name in REPORT[:6]]
    audit = F.coalesce("audit", F.lit("")).alias("audit")
    digest = F.coalesce("repaired_sha256", F.lit(EMPTY_SHA256)).alias("repaired_sha256")
    return joined.select("conv_id", *numbers, audit, digest)
