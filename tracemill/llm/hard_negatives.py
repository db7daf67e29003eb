"""Mining hard negatives with candidate lists that clusters of anchors share.

Anchors are put into clusters by direction. Of a cluster with centre ``c`` and largest angle
``r`` between ``c`` and a member, no member can score a candidate ``x`` higher than its own
length times ``|x| cos(max(0, angle(x, c) - r))``. The candidates are sorted by this once for
the cluster; every member walks down that list and stops where the bound proves that nothing
further on can change its result.

All anchors meet all candidates in tiles of bounded size, a group of anchors by a block of
candidates. The first block is walked before the others: what an anchor finds there is a
proved minimum, so later walks stop early and return little. The search runs twice, first
for positives, then, with the windows these give, for negatives.
"""

from __future__ import annotations

import math
from collections.abc import Callable
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.pandas.types import to_arrow_schema

from tracemill.llm.batches import map_slices
from tracemill.sources.staging import release, stage

# Anchors and candidates of a tile. Small tables get smaller blocks, so that all cores work.
GROUP_ROWS = 16_384
BLOCK_ROWS = 65_536
LEAST_BLOCK_ROWS = 4_096
# Centres are fitted on so many anchors at most; any centres give the same results.
SAMPLE_ROWS = 8_192
CLUSTERS = 64
ROUNDS = 8
# Candidates of a step down the list: at first, and at most; and scores held at a time,
# where a cluster has very many members.
FIRST_STEP, LARGEST_STEP = 256, 4_096
SCORES_HELD = 1 << 22
# Scores are cut to this, so that a hundred times one fits 64 bits.
LARGEST_SCORE = (1 << 63) // 100 - 1
# Larger products than this are not added exactly by floating point.
EXACT = float(1 << 53)
# No threshold; and the id of rows without one, behind all others.
NONE = -(1 << 62)
NO_ID = (1 << 63) - 1

FOUND = "anchor long, place int, score long, id long, row long"


@dataclass(frozen=True)
class Tiles:
    """How many groups of anchors meet how many blocks of candidates."""

    groups: int
    blocks: int

    @classmethod
    def of(cls, anchors: int, rows: int, tasks: int) -> Tiles:
        small = min(tasks, math.ceil(rows / LEAST_BLOCK_ROWS))
        return cls(max(1, math.ceil(anchors / GROUP_ROWS)), max(1, math.ceil(rows / BLOCK_ROWS), small))


def matrix(vectors: list[bytes], width: int) -> np.ndarray:
    """Packed vectors as rows; shorter ones end in zeros."""
    if vectors and all(len(v) == 8 * width for v in vectors):
        return np.frombuffer(b"".join(vectors), "<f8").reshape(len(vectors), width)
    rows = np.zeros((len(vectors), width))
    for row, vector in zip(rows, vectors):
        values = np.frombuffer(vector, "<f8")
        row[: len(values)] = values
    return rows


def exact_scores(left: np.ndarray, right: np.ndarray) -> np.ndarray:
    """Integer inner products of whole-numbered rows."""
    with np.errstate(over="ignore", invalid="ignore"):
        long_left, long_right = (np.sqrt((m * m).sum(axis=1)) for m in (left, right))
        most = long_left.max(initial=0) * long_right.max(initial=0)
        if most < EXACT:
            return (left @ right.T).astype(np.int64)
        small_left = long_left * long_right.max(initial=0) < EXACT
        products = np.where(small_left[:, None], left @ right.T, 0.0)
    scores = np.where(small_left[:, None], products, 0.0).astype(np.int64)
    whole = [[int(x) for x in row] for row in right]
    for at in np.flatnonzero(~small_left):
        own = [int(x) for x in left[at]]
        exact = (sum(a * b for a, b in zip(own, row)) for row in whole)
        scores[at] = [max(-LARGEST_SCORE, min(s, LARGEST_SCORE)) for s in exact]
    return scores


def directions(rows: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Rows of length one (or zero), and the lengths."""
    largest = np.abs(rows).max(axis=1, initial=0)
    scaled = rows / np.where(largest > 0, largest, 1)[:, None]
    lengths = np.sqrt((scaled * scaled).sum(axis=1))
    return scaled / np.where(lengths > 0, lengths, 1)[:, None], lengths * largest


def fit_centres(rows: np.ndarray, count: int) -> np.ndarray:
    """Centres of clusters by direction: spherical k-means from evenly spread rows."""
    units, _ = directions(rows)
    centres = units[np.linspace(0, len(units) - 1, min(count, len(units))).astype(int)]
    for _ in range(ROUNDS):
        nearest = (units @ centres.T).argmax(axis=1)
        sums = np.zeros_like(centres)
        np.add.at(sums, nearest, units)
        moved, lengths = directions(sums)
        centres = np.where(lengths[:, None] > 0, moved, centres)
    return centres


def bounds_of(members: np.ndarray, units: np.ndarray, lengths: np.ndarray) -> np.ndarray:
    """For each candidate, more than any member of length one can score it."""
    own, _ = directions(members)
    centre, _ = directions(own.sum(axis=0, keepdims=True))
    radius = np.arccos(np.clip(own @ centre[0], -1, 1)).max(initial=0) + 1e-6
    angles = np.arccos(np.clip(units @ centre[0], -1, 1))
    return lengths * np.cos(np.maximum(0.0, angles - radius))


class Walk:
    """The results of a cluster's members on their way down the shared list."""

    def __init__(self, lows: np.ndarray, highs: np.ndarray, wanted: int) -> None:
        self.lows, self.highs = lows, highs
        shape = (*lows.shape, wanted)
        self.scores = np.full(shape, NONE, dtype=np.int64)
        self.ids = np.full(shape, NO_ID, dtype=np.int64)
        self.rows = np.full(shape, NO_ID, dtype=np.int64)

    def needed(self, members: np.ndarray) -> np.ndarray:
        """The least score that still counts, for every window of the members."""
        return np.maximum(self.lows[members], self.scores[members, :, -1])

    def take(self, window: int, members: np.ndarray, scores: np.ndarray, ids: np.ndarray, rows: np.ndarray) -> None:
        """Merge finds into a window's best; members may come several times."""
        touched = np.unique(members)
        wanted = self.scores.shape[2]
        who = np.concatenate([members, np.repeat(touched, wanted)])
        merged = [
            np.concatenate([new, old[touched, window].ravel()])
            for new, old in ((scores, self.scores), (ids, self.ids), (rows, self.rows))
        ]
        order = np.lexsort((merged[2], merged[1], -merged[0], who))
        who = who[order]
        first = np.searchsorted(who, touched)
        chosen = order[(first[:, None] + np.arange(wanted)).ravel()]
        for held, values in zip((self.scores, self.ids, self.rows), merged):
            held[touched, window] = values[chosen].reshape(len(touched), wanted)


def walk_tile(anchors: dict, candidates: dict, same: bool, wanted: int) -> dict[str, np.ndarray]:
    """What the anchors of a tile find in it: for each window the best that lie in it.

    ``same`` looks for candidates of an anchor's own label, else for those of another.
    """
    units, lengths = directions(candidates["vectors"])
    own_lengths = directions(anchors["vectors"])[1]
    parts = []
    for cluster in np.unique(anchors["cluster"]):
        own = np.flatnonzero(anchors["cluster"] == cluster)
        vectors, labels, rows = (anchors[name][own] for name in ("vectors", "label", "row"))
        bound = bounds_of(vectors, units, lengths)
        order = np.argsort(-bound, kind="stable")
        walk = Walk(anchors["lows"][own], anchors["highs"][own], wanted)
        active, at, step = np.arange(len(own)), 0, FIRST_STEP
        while at < len(order):
            # Nothing from here on scores more; half a point outweighs all rounding of bounds.
            most = own_lengths[own[active]] * bound[order[at]]
            most = most + 0.5 + np.abs(most) * 1e-9
            active = active[most >= walk.needed(active).min(axis=1)]
            if not len(active):
                break
            taken = min(step, max(1, SCORES_HELD // len(active)))
            part = order[at : at + taken]
            scores = exact_scores(vectors[active], candidates["vectors"][part])
            fitting = (labels[active][:, None] == candidates["label"][part]) == same
            fitting &= rows[active][:, None] != candidates["row"][part]
            least = walk.needed(active)
            for window in range(least.shape[1]):
                hit = fitting & (scores >= least[:, window, None])
                hit &= scores <= walk.highs[active, window][:, None]
                who, which = np.nonzero(hit)
                if len(who):
                    which = part[which]
                    walk.take(window, active[who], scores[hit], candidates["id"][which], candidates["row"][which])
            at += taken
            step = min(2 * step, LARGEST_STEP)
        member, window, place = np.nonzero(walk.scores > NONE)
        kept = member, window, place
        parts.append((rows[member], window, walk.scores[kept], walk.ids[kept], walk.rows[kept]))
    columns = [np.concatenate(column) for column in zip(*parts)]
    return dict(zip(("anchor", "place", "score", "id", "row"), columns))


def _tile_step(same: bool, wanted: int, arrow: pa.Schema) -> Callable[[pa.Table, pa.Table], pa.Table]:
    def numbers(table: pa.Table, name: str) -> np.ndarray:
        return table.column(name).to_numpy()

    def step(left: pa.Table, right: pa.Table) -> pa.Table:
        if not left.num_rows or not right.num_rows:
            return pa.Table.from_pylist([], schema=arrow)
        vectors = [table.column("vector").to_pylist() for table in (left, right)]
        width = max(max(map(len, some), default=0) for some in vectors) // 8
        lows, highs = (left.column(name).to_pylist() for name in ("lows", "highs"))
        windows = max(map(len, lows))
        # A window that an anchor lacks lets nothing through.
        padded = [
            np.array([row + [fill] * (windows - len(row)) for row in some], dtype=np.int64).reshape(-1, windows)
            for some, fill in ((lows, LARGEST_SCORE + 1), (highs, NONE))
        ]
        if not windows:
            return pa.Table.from_pylist([], schema=arrow)
        anchors = {name: numbers(left, name) for name in ("row", "label", "cluster")}
        anchors |= {"vectors": matrix(vectors[0], width), "lows": padded[0], "highs": padded[1]}
        candidates = {name: numbers(right, name) for name in ("row", "label", "id")}
        candidates["vectors"] = matrix(vectors[1], width)
        found = walk_tile(anchors, candidates, same, wanted)
        return pa.Table.from_pydict({f.name: pa.array(found[f.name], f.type) for f in arrow}, schema=arrow)

    return step


def _search(anchors: DataFrame, rows: DataFrame, tiles: Tiles, same: bool, wanted: int) -> DataFrame:
    """The best ``wanted`` rows of every window (``lows``, ``highs``) of every anchor, stored."""
    schema = T._parse_datatype_string(FOUND)
    step = _tile_step(same, wanted, to_arrow_schema(schema))

    def met(known: DataFrame, first: int, last: int) -> DataFrame:
        """What the anchors find in the blocks from ``first`` up to ``last``."""
        every = lambda low, high: F.explode(F.sequence(F.lit(low), F.lit(high)))
        group = F.pmod(F.xxhash64("row"), F.lit(tiles.groups)).cast("int").alias("group")
        left = known.select("*", group, every(first, last).alias("block"))
        block = F.pmod(F.xxhash64("row", F.lit(1)), F.lit(tiles.blocks)).cast("int").alias("block")
        right = rows.select("*", block, every(0, tiles.groups - 1).alias("group"))
        right = right.filter(F.col("block").between(first, last))
        both = left.groupBy("group", "block").cogroup(right.groupBy("group", "block"))
        order = Window.partitionBy("anchor", "place").orderBy(F.desc("score"), "id", "row")
        found = both.applyInArrow(step, schema).withColumn("rank", F.row_number().over(order))
        return found.filter(F.col("rank") <= wanted)

    first = stage(met(anchors, 0, 0), "first-finds")
    if tiles.blocks == 1:
        return first
    # The last of as many as are wanted: whatever scores less is not wanted.
    least = first.filter(F.col("rank") == wanted).groupBy("anchor")
    least = least.agg(F.map_from_entries(F.collect_list(F.struct("place", "score"))).alias("least"))
    raised = F.expr("transform(lows, (low, i) -> greatest(low, coalesce(try_element_at(least, i), low)))")
    known = anchors.join(least, F.col("row") == F.col("anchor"), "left").withColumn("lows", raised)
    rest = stage(met(known.drop("least", "anchor"), 1, tiles.blocks - 1), "finds")
    order = Window.partitionBy("anchor", "place").orderBy(F.desc("score"), "id", "row")
    both = first.unionByName(rest).withColumn("rank", F.row_number().over(order))
    both = stage(both.filter(F.col("rank") <= wanted), "finds")
    release(first)
    release(rest)
    return both


def _packed_rows(df: DataFrame, scale: int, vector: str, id_column: str, label: Column, anchor: Column) -> DataFrame:
    """Rows that take part, numbered, with whole-numbered vectors."""
    parts = F.col(vector)
    odd = F.exists(parts, lambda x: x.isNull() | F.isnan(x) | (F.abs(x) == float("inf")))
    sound = df.filter(label.isNotNull() & parts.isNotNull() & ~F.coalesce(odd, F.lit(False)))
    named = sound.select(
        F.monotonically_increasing_id().alias("row"),
        F.col(id_column).cast("long").alias("id"),
        label.cast("long").alias("label"),
        F.coalesce(anchor, F.lit(False)).alias("is_anchor"),
        parts.cast("array<double>").alias("vector"),
    )

    def make():
        def step(rows, ids, labels, anchors, vectors):
            whole = [np.floor(scale * np.array(v, dtype="<f8")).astype("<f8").tobytes() for v in vectors]
            return [rows, [NO_ID if i is None else i for i in ids], labels, anchors, whole]

        return step

    return map_slices(named, make, "row long, id long, label long, is_anchor boolean, vector binary")


def _with_clusters(anchors: DataFrame, count: int) -> DataFrame:
    """The nearest centre of every anchor."""
    # The sample is bounded, so it may be looked at in one place.
    sample = anchors.orderBy(F.xxhash64("row"), "row").limit(SAMPLE_ROWS).select("vector").collect()
    vectors = [bytes(row.vector) for row in sample]
    width = max(map(len, vectors), default=0) // 8
    centres = fit_centres(matrix(vectors, width), count) if vectors else np.zeros((1, width))

    def make():
        def step(rows, ids, labels, vectors):
            wide = max(width, *(len(v) // 8 for v in vectors))
            units, _ = directions(matrix(vectors, wide))
            return [rows, ids, labels, vectors, (units[:, :width] @ centres.T).argmax(axis=1).tolist()]

        return step

    fields = "row long, id long, label long, vector binary, cluster int"
    return map_slices(anchors.select("row", "id", "label", "vector"), make, fields)


def _hundredth(value: Column, up: bool) -> Column:
    """A hundredth of a whole number, rounded up or down."""
    rest = F.pmod(value, F.lit(100))
    return F.call_function("div", value + F.pmod(-rest, F.lit(100)) if up else value - rest, F.lit(100))


def mine_negatives(
    df: DataFrame,
    anchor: Column,
    label: Column,
    vector: str = "embedding",
    id_column: str = "vec_id",
    scale: int = 256,
    positives: int = 5,
    negatives: int = 3,
    low: int = 50,
    high: int = 95,
) -> DataFrame:
    """``anchor_id, positive_id, rank, negative_id, positive_score, negative_score``.

    An anchor's positives are its ``positives`` best other rows of its label; for each of
    them its ``negatives`` best rows of another label score from ``low`` to ``high``
    percent of the positive. Scores are inner products of ``floor(scale * x)``; higher ones
    come first, ties by id. Results are exact, whatever the clusters.

    Rows with a null label, vector or component, or a component that is not finite, take no
    part. A null id comes after all others and is null in the result. Vectors of different
    lengths are taken as if zeros followed; an empty one scores 0. Repeated rows are rows of
    their own, each other's positives and anchors twice. Scores beyond what a hundredth of
    64 bits holds are cut to that. A table without anchors gives none. Other columns are
    not looked at.
    """
    rows = stage(_packed_rows(df, scale, vector, id_column, label, anchor), "vectors")
    size = rows.agg(F.count("*").alias("rows"), F.count_if("is_anchor").alias("anchors")).first()
    tiles = Tiles.of(size.anchors, size.rows, int(df.sparkSession.conf.get("spark.sql.shuffle.partitions")))
    clusters = max(1, min(CLUSTERS, math.isqrt(size.anchors)))
    anchors = stage(_with_clusters(rows.filter("is_anchor"), clusters), "anchors")
    rows_met = rows.drop("is_anchor")

    all_scores = anchors.withColumn("lows", F.array(F.lit(NONE))).withColumn("highs", F.array(F.lit(LARGEST_SCORE)))
    nearest = _search(all_scores.drop("id"), rows_met, tiles, True, positives)

    # One window for each positive, in their order.
    kept = F.array_sort(F.collect_list(F.struct("rank", "id", "score")))
    windows = nearest.groupBy("anchor").agg(kept.alias("kept"))
    share = lambda percent, up: F.transform("kept", lambda p: _hundredth(p["score"] * percent, up))
    bounded = windows.select("anchor", share(low, True).alias("lows"), share(high, False).alias("highs"))
    asked = anchors.join(bounded, F.col("row") == F.col("anchor")).drop("anchor", "id")
    hard = _search(asked, rows_met, tiles, False, negatives)
    positive = F.col("kept")[F.col("place")]
    owners = anchors.select(F.col("row").alias("anchor"), F.col("id").alias("own"))
    named = hard.join(windows, "anchor").join(owners, "anchor")
    known = lambda name: F.when(name != NO_ID, name)
    return named.select(
        known(F.col("own")).alias("anchor_id"),
        known(positive["id"]).alias("positive_id"),
        F.col("rank").cast("int").alias("rank"),
        known(hard["id"]).alias("negative_id"),
        positive["score"].alias("positive_score"),
        hard["score"].alias("negative_score"),
    )


def negatives_of_embeddings(df: DataFrame) -> DataFrame:
    """The query's own anchors and labels: every 50th id, and every 7th label moved on."""
    moved = F.when(F.col("vec_id") % 7 == 0, (F.col("label") + 1) % 10).otherwise(F.col("label"))
    return mine_negatives(df, F.col("vec_id") % 50 == 0, moved)
