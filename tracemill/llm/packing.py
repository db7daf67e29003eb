"""Packing token sequences by a configuration linear program.

Documents become token ids, long ones in pieces. Only the number of pieces of each
length goes to the driver: at most ``capacity`` counts, whatever the data. There a
configuration says which lengths share a sequence, and the linear program asks for the
fewest sequences that hold all pieces. Multiplicative weights solve it: every length
has a price, a knapsack by dynamic programming finds the most valuable configuration,
and prices fall for what it holds. Its fractional answer is rounded; what is left over,
and the shortest pieces, which are good for filling, go to the best-fitting gaps.

The plan names pieces by length and rank. Ranks come from counting inside the tasks
that encode and adding up per task, so no length is gathered anywhere.
"""

from __future__ import annotations

import json
import math
import zlib
from bisect import bisect_left, insort
from collections import defaultdict
from collections.abc import Callable

import numpy as np
import pyarrow as pa
import tiktoken
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.pandas.types import to_arrow_schema
from tokenizers import Tokenizer

from tracemill.llm.batches import map_slices
from tracemill.llm.bpe import byte_alphabet
from tracemill.sources.staging import stage

CAPACITY = 2048
END_ID = 0
# Lengths are rounded up to multiples of this in the linear program.
UNIT = 8
# Pieces up to this length stay out of the program and fill gaps.
FILLERS = 128
STEPS = 5000
RATE = 0.1
# Fixed value: how byte-level vocabularies of this family split a text.
WORDS = (
    r"""'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"""
)
PIECE_FIELDS = "piece int, start long, length long, ids_crc32 long, task int, place long"


def byte_level_encoder(path: str) -> Callable[[str], list[int]]:
    """Encode as the tokenizer file does, without added special tokens.

    Where its merges are in the order of their ids, the rank-based library gives
    the same ids several times faster; otherwise, and for what that refuses, the
    file's own library is used.
    """
    with open(path, encoding="utf-8") as file:
        described = json.load(file)
    own = Tokenizer.from_file(path)
    plain = lambda text: own.encode(text, add_special_tokens=False).ids
    model, first = described["model"], described["pre_tokenizer"]
    merged = [m.replace(" ", "") if isinstance(m, str) else "".join(m) for m in model["merges"]]
    ids = [model["vocab"][token] for token in merged]
    simple = (
        not described["normalizer"]
        and not described["post_processor"]
        and first["type"] == "ByteLevel"
        and first["use_regex"]
        and not first["add_prefix_space"]
        and ids == sorted(ids)
        and ids[0] == len(model["vocab"]) - len(ids)
    )
    if not simple:
        return plain
    byte_of = {shown: byte for byte, shown in byte_alphabet().items()}
    ranks = {bytes(byte_of[c] for c in token): rank for token, rank in model["vocab"].items()}
    quick = tiktoken.Encoding("file", pat_str=WORDS, mergeable_ranks=ranks, special_tokens={})
    special = [t["content"] for t in described["added_tokens"]]

    def encode(text: str) -> list[int]:
        if any(mark in text for mark in special):
            return plain(text)
        try:
            return quick.encode_ordinary(text)
        except (ValueError, RuntimeError):
            return plain(text)

    return encode


def cut_lengths(total: int, capacity: int) -> list[int]:
    """Lengths of the pieces of a document: all full, but perhaps the first."""
    first = total % capacity
    return ([first] if first else []) + [capacity] * (total // capacity)


def encode_pieces(
    docs: DataFrame, path: str, capacity: int, text: str, id_column: str, keep_ids: bool
) -> DataFrame:
    """The pieces of all documents, stored; ``task, place`` number those of a length."""

    def make():
        encode = byte_level_encoder(path)
        task = TaskContext.get().partitionId()
        seen = np.zeros(capacity + 1, dtype=np.int64)

        def step(names, texts):
            rows = []
            for name, whole in zip(names, texts):
                ids = np.array((encode(whole) if whole else []) + [END_ID], "<u4")
                start = 0
                for piece, length in enumerate(cut_lengths(len(ids), capacity)):
                    part = ids[start : start + length]
                    row = (name, piece, start, length, zlib.crc32(part.tobytes()), task, int(seen[length]))
                    rows.append(row + (part.tolist(),) if keep_ids else row)
                    seen[length] += 1
                    start += length
            return [list(column) for column in zip(*rows)]

        return step

    kind = docs.schema[id_column].dataType.simpleString()
    schema = f"`{id_column}` {kind}, {PIECE_FIELDS}" + (", ids array<long>" if keep_ids else "")
    return stage(map_slices(docs.select(id_column, text), make, schema), "pieces")


def best_configuration(prices: np.ndarray) -> tuple[int, ...]:
    """The most valuable multiset of sizes that fits: an unbounded knapsack.

    ``prices[s]`` is the price of size ``s``; the capacity is the largest size.
    """
    capacity = len(prices) - 1
    value = np.zeros(capacity + 1)
    taken = np.zeros(capacity + 1, dtype=np.int64)
    for room in range(1, capacity + 1):
        worth = prices[1 : room + 1] + value[room - 1 :: -1]
        best = int(worth.argmax())
        value[room], taken[room] = worth[best], best + 1
    sizes, room = [], capacity
    while room > 0:
        size = int(taken[room])
        if prices[size] > 0:
            sizes.append(size)
        room -= size
    return tuple(sorted(sizes, reverse=True))


def solve_configurations(
    demand: np.ndarray, steps: int = STEPS, rate: float = RATE
) -> dict[tuple[int, ...], float]:
    """How often to use each configuration so that all demand is covered.

    ``demand[s]`` is the number of pieces of size ``s``. Each step takes as much of
    the best configuration as covers one of its sizes once; weights of the covered
    sizes fall exponentially.
    """
    wanted = demand > 0
    if not wanted.any():
        return {}
    weights = wanted.astype(float)
    covered = np.zeros(len(demand))
    used: dict[tuple[int, ...], float] = defaultdict(float)
    enough = math.log(wanted.sum() + 1) / rate**2
    needed = np.where(wanted, demand, 1)
    for _ in range(steps):
        configuration = best_configuration(np.where(wanted, weights / needed, 0.0))
        sizes, counts = np.unique(configuration, return_counts=True)
        amount = (demand[sizes] / counts).min()
        used[configuration] += amount
        share = amount * counts / demand[sizes]
        covered[sizes] += share
        weights[sizes] *= np.exp(-rate * share)
        if covered[wanted].min() >= enough:
            break
        if weights.max() < 1e-200:
            weights /= weights.max()
    scale = max(float(np.median(covered[wanted])), 1e-9)
    return {configuration: amount / scale for configuration, amount in used.items()}


class Plan:
    """Where the pieces of each length go: runs of ranks over runs of sequences."""

    def __init__(self, counts: dict[int, int], capacity: int) -> None:
        self.capacity = capacity
        self.left = dict(counts)
        self.rank = dict.fromkeys(counts, 0)
        self.sequences = 0
        # length, first rank, how many, first sequence, offset in each
        self.runs: list[tuple[int, int, int, int, int]] = []
        self.gaps: list[int] = []
        self.open: dict[int, list[tuple[int, int]]] = defaultdict(list)

    def _place(self, length: int, count: int, sequence: int, offset: int) -> None:
        self.runs.append((length, self.rank[length], count, sequence, offset))
        self.rank[length] += count
        self.left[length] -= count

    def _leave(self, gap: int, sequence: int, count: int) -> None:
        if gap:
            if not self.open[gap]:
                insort(self.gaps, gap)
            self.open[gap].append((sequence, count))

    def use(self, configuration: tuple[int, ...], wanted: int, lengths: dict[int, list[int]]) -> None:
        """Fill up to ``wanted`` new sequences; ``lengths`` lists those of each size.

        Sizes stand for several lengths, so a sequence's offsets change where the
        pieces of one length are used up; between these places one run serves.
        """
        supply = {s: sum(self.left[n] for n in lengths[s]) for s in set(configuration)}
        count = min([wanted, *(supply[s] // configuration.count(s) for s in supply)])
        slots: list[list[tuple[int, int]]] = []
        pending = defaultdict(int)
        for size in configuration:
            runs, missing = [], count
            for length in lengths[size]:
                free = self.left[length] - pending[length]
                taken = min(free, missing)
                if taken > 0:
                    runs.append((length, taken))
                    pending[length] += taken
                    missing -= taken
            slots.append(runs)
        done = 0
        while done < count:
            step = min(runs[0][1] for runs in slots)
            offset = 0
            for runs in slots:
                length, taken = runs[0]
                self._place(length, step, self.sequences + done, offset)
                offset += length
                runs[0] = (length, taken - step)
                if taken == step:
                    runs.pop(0)
            self._leave(self.capacity - offset, self.sequences + done, step)
            done += step
        self.sequences += count

    def fill(self) -> None:
        """Put what is left into the best-fitting gaps, longest first."""
        for length in sorted(self.left, reverse=True):
            while self.left[length]:
                at = bisect_left(self.gaps, length)
                if at == len(self.gaps):
                    self._open_for(length)
                    continue
                gap = self.gaps[at]
                sequence, count = self.open[gap].pop()
                if not self.open[gap]:
                    self.gaps.pop(at)
                taken = min(count, self.left[length])
                self._place(length, taken, sequence, self.capacity - gap)
                self._leave(gap - length, sequence, taken)
                if count > taken:
                    self._leave(gap, sequence + taken, count - taken)

    def _open_for(self, length: int) -> None:
        """New sequences that hold as many pieces of this length as fit."""
        each = self.capacity // length
        full, rest = divmod(self.left[length], each)
        for number, (count, holds) in enumerate(((full, each), (1, rest))):
            if count and holds:
                for slot in range(holds):
                    self._place(length, count, self.sequences, slot * length)
                self._leave(self.capacity - holds * length, self.sequences, count)
                self.sequences += count


def plan_sequences(counts: dict[int, int], capacity: int = CAPACITY) -> Plan:
    """A plan for ``counts`` pieces of each length; on the driver, bounded by lengths."""
    plan = Plan(counts, capacity)
    unit = UNIT if capacity % UNIT == 0 else 1
    lengths: dict[int, list[int]] = defaultdict(list)
    for length in sorted(counts, reverse=True):
        if length > min(FILLERS, capacity // 4):
            lengths[-(-length // unit)].append(length)
    demand = np.zeros(capacity // unit + 1)
    for size, members in lengths.items():
        demand[size] = sum(counts[n] for n in members)
    used = solve_configurations(demand)
    for configuration, amount in sorted(used.items(), key=lambda item: (-item[1], item[0])):
        # The smallest piece is left to the best fit, which knows exact lengths.
        kept = configuration[:-1] or configuration
        if int(amount):
            plan.use(kept, int(amount), lengths)
    plan.fill()
    return plan


def pack_documents(
    docs: DataFrame,
    path: str,
    capacity: int = CAPACITY,
    text: str = "text",
    id_column: str = "doc_id",
    keep_ids: bool = False,
) -> DataFrame:
    """Every piece of every document with its sequence and its offset in there.

    ``piece, start, length, ids_crc32, sequence_id, offset``, and ``ids`` if asked
    for. A null or empty text is the closing id alone. Copies and rows without id
    are packed like any others, each row once. Columns other than the two named are
    not looked at. ``path`` is a tokenizer file that every executor can read.
    """
    pieces = encode_pieces(docs, path, capacity, text, id_column, keep_ids)
    held = stage(pieces.groupBy("task", "length").agg(F.count("*").alias("held")), "piece-counts")
    counts = {row.length: row.n for row in held.groupBy("length").agg(F.sum("held").alias("n")).collect()}
    runs = np.array(plan_sequences(counts, capacity).runs or np.zeros((0, 5)), dtype=np.int64)
    runs = runs[np.lexsort((runs[:, 1], runs[:, 0]))]
    # Ranks of one length lie below 2 ** 50, so length and rank make one key.
    starts = (runs[:, 0] << 50) + runs[:, 1]

    earlier = Window.partitionBy("length").orderBy("task")
    before = F.sum("held").over(earlier.rowsBetween(Window.unboundedPreceding, 0)) - F.col("held")
    offsets = held.select("task", "length", before.alias("before"))
    # As many rows as tasks times lengths: compressed they look small enough to broadcast,
    # but they grow with the input.
    ranked = pieces.join(offsets.hint("merge"), ["task", "length"])
    own = [id_column, "piece", "start", "length", "ids_crc32"] + (["ids"] if keep_ids else [])
    ranked = ranked.select(*own, (F.col("before") + F.col("place")).alias("rank"))
    fields = [f for f in ranked.schema if f.name != "rank"]
    schema = T.StructType(
        fields + [T.StructField("sequence_id", T.LongType()), T.StructField("offset", T.LongType())]
    )
    arrow = to_arrow_schema(schema)

    def locate(batches):
        for batch in batches:
            length = batch.column("length").to_numpy()
            rank = batch.column("rank").to_numpy()
            run = runs[np.searchsorted(starts, (length << 50) + rank, side="right") - 1]
            sequence = run[:, 3] + rank - run[:, 1]
            columns = [batch.column(f.name) for f in fields] + [pa.array(sequence), pa.array(run[:, 4])]
            yield pa.RecordBatch.from_arrays(columns, schema=arrow)

    return ranked.mapInArrow(locate, schema)


def assemble_sequences(packed: DataFrame) -> DataFrame:
    """``sequence_id, ids`` from pieces packed with ``keep_ids``.

    A sequence never holds more than its capacity, so neither does a group.
    """
    parts = F.array_sort(F.collect_list(F.struct("offset", "ids")))
    grouped = packed.groupBy("sequence_id").agg(parts.alias("parts"))
    return grouped.select("sequence_id", F.flatten(F.transform("parts", lambda p: p["ids"])).alias("ids"))
