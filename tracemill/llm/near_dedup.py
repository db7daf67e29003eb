"""Near-duplicate documents from bottom-k sketches of one hash function.

1. Every text becomes a set of word shingles. Texts with equal sets become one node,
   before anything else is done, so groups of copies cost no more than one text.
2. The ``k`` smallest shingle hashes of a set are its sketch. Two sets that are similar
   enough share many of them, so they share one among each one's rarest few: only those
   are put into inverted lists.
3. Nodes that meet in no list are done. For the few others, lists of their whole sets take
   the place of the sketches' lists; these leave nothing to chance.
4. Lists propose pairs. A list never proposes all its pairs: its nodes are compared
   with a few nodes of the list, links found so far are turned into components, and
   what is left in different components is compared in the end. That loses nothing:
   two nodes in one component need no further link.
5. A pair's union sketch estimates its resemblance, which sorts out most pairs. The
   others are confirmed on full shingle sets, read anew from the texts.

Where a set has more than ``k`` shingles, steps 2 and 5 allow for six standard deviations
of the estimate. By the exact binomial tail a link of 64 values is missed with a chance of
at most 3.5e-8 at 85 % (fewer than 37 shared) and 1.9e-8 at 80 % (fewer than 32), that is once
in 29 or 51 million borderline pairs. ``exact`` leaves this out: all sets are listed whole, and
only sizes and full sets judge pairs, which takes several times the shuffle.
"""

from __future__ import annotations

import math

import numpy as np
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tracemill.llm.batches import map_slices
from tracemill.llm.components import connected_components
from tracemill.llm.shingles import (
    SHINGLE_WORDS,
    jaccard_parts,
    set_digest,
    shingle_set,
    union_sketch,
)
from tracemill.sources.staging import release, stage

SKETCH = 64
THRESHOLD_PERCENT = 85
DEVIATIONS = 6
# Nodes that all others of a list are compared with, by round.
HUBS = (1, 3)
# Pairs of one hub that a group of the exact check holds.
PAIRS_PER_GROUP = 128


def least_shared(n: int, size: int, percent: int) -> int:
    """Values of a union sketch that a set of ``n`` shares almost surely with one like it.

    A union has at most ``n / share`` values. A sketch that holds all of it shows at
    least ``n * share``; otherwise it draws ``size`` without putting any back.
    """
    share = percent / 100
    union = n / share
    whole = math.ceil(n * percent / 100)
    if union <= size:
        return whole
    spread = size * share * (1 - share) * (union - size) / (union - 1)
    return min(whole, math.floor(size * share - DEVIATIONS * math.sqrt(spread)))


def _least_shared_column(n: Column, size: int, percent: int) -> Column:
    share = percent / 100
    union = n / share
    whole = F.ceil(n * percent / 100)
    spread = size * share * (1 - share) * (union - size) / (union - 1)
    drawn = F.floor(size * share - DEVIATIONS * F.sqrt(spread))
    return F.when(union <= size, whole).otherwise(F.least(whole, drawn))


def sketch_texts(docs: DataFrame, text: str, id_column: str, size: int, words: int) -> DataFrame:
    """``doc_id, text_hash, n_shingles, digest, sketch`` of every row, stored."""

    def make():
        def step(names, hashes, texts):
            sets = [shingle_set(whole, words) for whole in texts]
            return [
                names,
                hashes,
                [len(s) for s in sets],
                [set_digest(s) if len(s) else None for s in sets],
                # The sign bit is flipped, so that signed values keep the order.
                [(s[:size] ^ np.uint64(1 << 63)).view(np.int64).tolist() for s in sets],
            ]

        return step

    kind = docs.schema[id_column].dataType.simpleString()
    schema = f"doc_id {kind}, text_hash long, n_shingles long, digest binary, sketch array<long>"
    source = docs.select(F.col(id_column), F.xxhash64(F.col(text)), F.col(text))
    return stage(map_slices(source, make, schema), "sketches")


def distinct_sets(sketched: DataFrame) -> DataFrame:
    """One numbered node for every shingle set, with the row that stands for it."""
    filled = sketched.filter(F.col("digest").isNotNull())
    nodes = filled.groupBy("digest").agg(
        F.min(F.struct("doc_id", "text_hash")).alias("row"),
        F.first("n_shingles").alias("n"),
        F.first("sketch").alias("sketch"),
    )
    numbered = nodes.select(
        F.monotonically_increasing_id().alias("node"), "digest", "row.doc_id", "row.text_hash", "n", "sketch"
    )
    return stage(numbered, "shingle-sets")


def _rarest(values: DataFrame, needed: Column) -> DataFrame:
    """``value, node, n, alone, place``: each node under its first values, stored.

    ``values`` has a row for each of the ``kept`` values of a node. They are ordered by the
    number of nodes that have them, the same for all; nodes that share ``needed`` values
    then share one of their first ``kept - needed + 1``. Values of one node only are
    counted (``alone``), but not listed, and neither are lists of one node.
    """
    shared = values.groupBy("value").agg(F.count("*").alias("nodes")).filter("nodes > 1")
    common = values.join(shared, "value")
    rare_first = Window.partitionBy("node").orderBy("nodes", "value")
    alone = F.col("kept") - F.count("*").over(Window.partitionBy("node"))
    placed = common.select(
        "value", "node", "n", "kept", alone.alias("alone"), (F.row_number().over(rare_first) + alone).alias("place")
    )
    first = placed.filter(F.col("place") <= F.col("kept") - needed + 1)
    first = stage(first.select("value", "node", "n", "alone", "place"), "first-values")
    met = first.groupBy("value").agg(F.count("*").alias("nodes")).filter("nodes > 1").select("value")
    lists = stage(first.join(met, "value", "left_semi"), "inverted-lists")
    release(first)
    return lists


def sketch_lists(nodes: DataFrame, size: int, percent: int) -> DataFrame:
    """Inverted lists of the values that sketches retain: who may have a partner."""
    kept = F.size("sketch").alias("kept")
    values = nodes.select("node", "n", kept, F.explode("sketch").alias("value"))
    return _rarest(values, _least_shared_column(F.col("n"), size, percent))


def full_lists(texts: DataFrame, percent: int, words: int) -> DataFrame:
    """Inverted lists of all values of the nodes that may have a partner.

    Sketches leave room for chance and so put distant copies of one text under
    one value. Whole sets do not, and few nodes have got here.
    """

    def make():
        def step(nodes, bodies):
            out = ([], [], [])
            for node, body in zip(nodes, bodies):
                values = shingle_set(body, words).view(np.int64).tolist()
                out[0].extend([node] * len(values))
                out[1].extend([len(values)] * len(values))
                out[2].extend(values)
            return list(out)

        return step

    values = map_slices(texts.select("node", "text"), make, "node long, n long, value long")
    values = stage(values.distinct(), "full-values")
    lists = _rarest(values.withColumn("kept", F.col("n")), F.ceil(F.col("n") * percent / 100))
    release(values)
    return lists


def _may_overlap(one: dict[str, Column], other: dict[str, Column], percent: int) -> Column:
    """Whether two sets can be similar, given the places where they meet in a list.

    Their sizes say how much they must share. If they do, the first value they share is
    early in both; a list where they meet later need not propose them.
    """
    shared = F.ceil((one["n"] + other["n"]) * percent / (100 + percent))
    early = lambda side: side["place"] <= side["n"] - shared + 1
    return early(one) & early(other)


def _labelled(lists: DataFrame, labels: DataFrame | None) -> DataFrame:
    """Lists with the component of each node, at first the node itself."""
    if labels is None:
        return lists.withColumn("component", F.col("node"))
    joined = lists.join(labels, "node", "left")
    return joined.withColumn("component", F.coalesce("component", "node"))


def hub_pairs(lists: DataFrame, hubs: int, labels: DataFrame | None, percent: int) -> DataFrame:
    """Distinct pairs of a list's hubs with its other nodes, where not yet connected.

    Hubs are the nodes with the fewest values of their own: in a family of edited
    copies they are next to the original, and most others are near them. Hubs of
    later rounds are of different components.
    """
    named = _labelled(lists, labels)
    row = F.struct("alone", "node", "n", "component", "place")
    centres = named.groupBy("value", "component").agg(F.min(row).alias("hub"))
    nearest = Window.partitionBy("value").orderBy("hub")
    # Spark keeps each task's first rows of a window that is cut at a rank.
    first = centres.withColumn("nth", F.row_number().over(nearest)).filter(F.col("nth") <= hubs)
    ends = named.groupBy("value").agg(F.min("component").alias("least"), F.max("component").alias("most"))
    chosen = first.join(ends.filter("least < most"), "value", "left_semi")
    pairs = named.join(chosen.select("value", "hub"), "value")
    fit = _may_overlap(
        {"n": F.col("n"), "place": F.col("place")}, {"n": F.col("hub.n"), "place": F.col("hub.place")}, percent
    )
    pairs = pairs.filter((F.col("component") != F.col("hub.component")) & fit)
    return pairs.select(
        F.least("hub.node", "node").alias("a"), F.greatest("hub.node", "node").alias("b")
    ).distinct()


def open_pairs(lists: DataFrame, labels: DataFrame | None, percent: int) -> DataFrame:
    """Distinct pairs of a list that are still in different components."""
    named = _labelled(lists, labels)
    open_lists = named.groupBy("value").agg(
        F.min("component").alias("least"), F.max("component").alias("most")
    ).filter("least < most").select("value")
    named = stage(named.join(open_lists, "value", "left_semi"), "open-lists")
    other = named.select("value", *(F.col(c).alias(f"{c}2") for c in ("node", "n", "component", "place")))
    apart = (F.col("component") != F.col("component2")) & (F.col("node") < F.col("node2"))
    fit = _may_overlap(
        {"n": F.col("n"), "place": F.col("place")}, {"n": F.col("n2"), "place": F.col("place2")}, percent
    )
    pairs = named.join(other, "value").filter(apart & fit)
    return pairs.select(F.col("node").alias("a"), F.col("node2").alias("b")).distinct()


def promising(pairs: DataFrame, nodes: DataFrame, size: int, percent: int, exact: bool = False) -> DataFrame:
    """``a, b, sure``: pairs whose union sketch does not rule them out.

    ``sure`` where both sketches are whole sets, so that the answer is exact. With ``exact``
    larger sets are ruled out by their sizes only.
    """
    side = lambda name: nodes.select(
        F.col("node").alias(name), F.col("n").alias(f"n_{name}"), F.col("sketch").alias(f"s_{name}")
    )
    joined = pairs.join(side("a"), "a").join(side("b"), "b")

    def make():
        def step(ones, others, ns, ms, lefts, rights):
            kept = []
            for a, b, n, m, left, right in zip(ones, others, ns, ms, lefts, rights):
                one, other = np.array(left, np.int64), np.array(right, np.int64)
                if n <= size and m <= size:
                    shared, union = jaccard_parts(one, other)
                    if 100 * shared >= percent * union:
                        kept.append((a, b, True))
                elif exact:
                    if 100 * min(n, m) >= percent * max(n, m):
                        kept.append((a, b, False))
                else:
                    shared, seen = union_sketch(one, other, size)
                    if seen < size or shared >= least_shared(min(n, m), size, percent):
                        kept.append((a, b, False))
            return [list(column) for column in zip(*kept)] or [[], [], []]

        return step

    columns = joined.select("a", "b", "n_a", "n_b", "s_a", "s_b")
    return map_slices(columns, make, "a long, b long, sure boolean")


def node_texts(docs: DataFrame, nodes: DataFrame, lists: DataFrame, text: str, id_column: str) -> DataFrame:
    """``node, text`` of the nodes in any list, stored."""
    listed = nodes.join(lists.select("node").distinct(), "node", "left_semi")
    wanted = listed.select("node", F.col("doc_id").alias("_wanted"), "text_hash")
    rows = docs.select(F.col(id_column).alias("_doc"), F.xxhash64(F.col(text)).alias("text_hash"), F.col(text).alias("text"))
    found = rows.join(wanted, (rows.text_hash == wanted.text_hash) & rows._doc.eqNullSafe(wanted._wanted))
    return stage(found.select("node", "text").dropDuplicates(["node"]), "node-texts")


def confirmed(pairs: DataFrame, texts: DataFrame, percent: int, words: int) -> DataFrame:
    """The pairs that are similar on their full shingle sets.

    Pairs of one ``a`` are checked in groups: its text comes first and its set is kept
    while the others pass by, one at a time.
    """
    counts = pairs.groupBy("a").agg(F.ceil(F.count("*") / PAIRS_PER_GROUP).alias("groups"))
    dealt = pairs.join(counts, "a").select(
        "a", "b", F.pmod(F.xxhash64("b"), F.col("groups")).cast("int").alias("group")
    )
    firsts = dealt.select("a", "group").distinct().join(texts.withColumnRenamed("node", "a"), "a")
    firsts = firsts.select("a", "group", F.lit(0).alias("role"), F.col("a").alias("b"), "text")
    others = dealt.join(texts.withColumnRenamed("node", "b"), "b")
    others = others.select("a", "group", F.lit(1).alias("role"), "b", "text")
    rows = firsts.unionByName(others).repartition("a", "group")
    rows = rows.sortWithinPartitions("a", "group", "role", "b")

    def make():
        kept: list = [None, None]

        def step(ones, roles, others, bodies):
            links = []
            for a, role, b, body in zip(ones, roles, others, bodies):
                if role == 0:
                    if kept[0] != a:
                        kept[:] = a, shingle_set(body, words)
                    continue
                shared, union = jaccard_parts(kept[1], shingle_set(body, words))
                if 100 * shared >= percent * union:
                    links.append((a, b))
            return [list(column) for column in zip(*links)] or [[], []]

        return step

    return map_slices(rows.select("a", "role", "b", "text"), make, "a long, b long")


def find_links(
    docs: DataFrame, nodes: DataFrame, text: str, id_column: str, size: int, percent: int, words: int, exact: bool
) -> DataFrame | None:
    """``node, component`` of all nodes that are linked to another; None if none is."""
    listed = nodes.select("node") if exact else sketch_lists(nodes, size, percent)
    if listed.isEmpty():
        return None
    texts = node_texts(docs, nodes, listed, text, id_column)
    lists = full_lists(texts, percent, words)
    links, labels = None, None
    for number in range(len(HUBS) + 1):
        if number < len(HUBS):
            pairs = hub_pairs(lists, HUBS[number], labels, percent)
        else:
            pairs = open_pairs(lists, labels, percent)
        pairs = stage(pairs, "pairs")
        likely = stage(promising(pairs, nodes, size, percent, exact), "likely-pairs")
        sure = likely.filter("sure").select("a", "b")
        found = stage(
            sure.unionByName(confirmed(likely.filter("not sure").select("a", "b"), texts, percent, words)), "links"
        )
        release(pairs)
        release(likely)
        if not found.isEmpty():
            links = found if links is None else links.unionByName(found)
            labels = connected_components(links)
    release(texts)
    release(lists)
    if not exact:
        release(listed)
    return labels


def near_duplicates(
    docs: DataFrame,
    text: str = "text",
    id_column: str = "doc_id",
    percent: int = THRESHOLD_PERCENT,
    size: int = SKETCH,
    words: int = SHINGLE_WORDS,
    exact: bool = False,
) -> DataFrame:
    """``doc_id, text_hash, n_shingles, component_id, kept`` of every row.

    Texts are linked where their shingle sets overlap by ``percent`` of their union;
    the component is named by its smallest id, and that document is kept. Null and
    empty texts, and those of white space only, have no shingles, are linked with
    nothing and are kept. Repeated rows are one document and share their verdict. Null
    ids never name a component that has another id; rows of a component without any
    id are all kept. Columns other than the two named are not looked at. ``exact`` finds
    links without any estimate.
    """
    sketched = sketch_texts(docs, text, id_column, size, words)
    nodes = distinct_sets(sketched)
    labels = find_links(docs, nodes, text, id_column, size, percent, words, exact)
    placed = nodes.select("digest", "doc_id", F.col("node").alias("component"))
    if labels is not None:
        joined = nodes.select("node", "digest", "doc_id").join(labels, "node", "left")
        placed = joined.select("digest", "doc_id", F.coalesce("component", "node").alias("component"))
        placed = stage(placed, "components")
    names = placed.groupBy("component").agg(F.min("doc_id").alias("component_id"))
    named = placed.join(names, "component").select("digest", "component_id")
    rows = sketched.select("doc_id", "text_hash", "n_shingles", "digest")
    full = rows.filter(F.col("digest").isNotNull()).join(named, "digest").drop("digest")
    empty = rows.filter(F.col("digest").isNull()).drop("digest").withColumn("component_id", F.col("doc_id"))
    result = full.unionByName(empty)
    return result.select(
        F.col("doc_id").alias(id_column),
        "text_hash",
        "n_shingles",
        "component_id",
        F.col("doc_id").eqNullSafe(F.col("component_id")).alias("kept"),
    )
