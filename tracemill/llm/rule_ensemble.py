"""A quality classifier as a sparse ensemble of rules.

Shallow random trees over text statistics are taken apart: every path from a root is
a conjunctive rule. Lasso logistic regression over the rules leaves few of them with
a weight, and those are compiled into one Spark column: scoring is a projection over
the statistics, without a model object.
"""

from __future__ import annotations

import math
import re
from dataclasses import dataclass

import numpy as np
from pyspark.ml.classification import LogisticRegression, RandomForestClassifier
from pyspark.ml.functions import array_to_vector
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tracemill.llm.batches import map_slices
from tracemill.llm.shingles import finish_hash, word_hashes
from tracemill.sources.staging import stage

FOLDS = 5
HELD_OUT_FOLD = 0
CUTOFF = 0.3
# Labelled documents that the model is fitted on, at most.
TRAINING_ROWS = 20_000
TREES = 40
DEPTH = 3
PENALTY = 0.002
# The fit ends where a step changes the objective by less than this share; the number of
# steps is only a stop for what never settles.
TOLERANCE = 1e-6
MOST_STEPS = 2000
SEED = 17
_HASHES = 1 << 20

# Characters whose rate per thousand is a statistic.
CHARACTERS = {
    "upper_rate": b"ABCDEFGHIJKLMNOPQRSTUVWXYZ",
    "digit_rate": b"0123456789",
    "stop_rate": b".?",
    "shout_rate": b"!",
    "bar_rate": b"|",
    "mark_rate": b"#*$%&<>",
    "quote_rate": b"\"'`",
    "bracket_rate": b"(){}[]",
    "comma_rate": b",;:",
}
BLANKS = b" \t\n\x0b\x0c\r"
WINDOW = 3
STATISTICS = (
    "n_words",
    "n_lines",
    "word_length",
    "dup_line_rate",
    "repeat_rate",
    *CHARACTERS,
)


def held_out(doc_id: Column) -> Column:
    """Whether the document is in the fold that nothing is learned from."""
    return F.coalesce(F.crc32(doc_id.cast("string").cast("binary")) % FOLDS == HELD_OUT_FOLD, F.lit(False))


def repeated_words(hashes: np.ndarray, window: int = WINDOW) -> int:
    """Words inside windows of words that occur twice or more in the text."""
    runs = len(hashes) - window + 1
    if runs < 2:
        return 0
    grams = np.zeros(runs, dtype=np.uint64)
    for step in range(window):
        grams = finish_hash(grams + hashes[step : step + runs])
    order = np.argsort(grams, kind="stable")
    same = grams[order][1:] == grams[order][:-1]
    again = np.zeros(runs, dtype=bool)
    again[order[1:][same]] = True
    again[order[:-1][same]] = True
    covered = np.zeros(len(hashes), dtype=bool)
    for step in range(window):
        covered[step : step + runs] |= again
    return int(covered.sum())


def statistics(text: str | None) -> tuple[float, ...]:
    """``STATISTICS`` of one whole text; all are 0 for a null or empty one."""
    text = text or ""
    raw = text.encode("utf-8", "surrogatepass")
    deleted = lambda found: len(raw) - len(raw.translate(None, found))
    hashes = word_hashes(text)
    words = max(len(hashes), 1)
    lines = [line for line in raw.split(b"\n") if line.strip(BLANKS)]
    size = max(len(text), 1)
    return (
        float(len(hashes)),
        float(len(lines)),
        (len(text) - deleted(BLANKS)) / words,
        1000 * (len(lines) - len(set(lines))) / max(len(lines), 1),
        1000 * repeated_words(hashes) / words,
        *(1000 * deleted(found) / size for found in CHARACTERS.values()),
    )


def text_statistics(docs: DataFrame, text: str = "text") -> DataFrame:
    """``docs`` without the text, with ``STATISTICS`` of the whole of it."""
    kept = [field for field in docs.schema if field.name != text]

    def make():
        def step(*columns):
            *others, texts = columns
            rows = [statistics(whole) for whole in texts]
            return [*others, *(list(column) for column in zip(*rows))]

        return step

    fields = [f"`{field.name}` {field.dataType.simpleString()}" for field in kept]
    fields += [f"{name} double" for name in STATISTICS]
    source = docs.select(*(field.name for field in kept), text)
    return map_slices(source, make, ", ".join(fields))


@dataclass(frozen=True, order=True)
class Condition:
    statistic: str
    above: bool
    bound: float

    def column(self) -> Column:
        value = F.col(self.statistic)
        return value > self.bound if self.above else value <= self.bound


Rule = tuple[Condition, ...]
_SPLIT = re.compile(r"^(\s*)(?:If|Else) \(feature (\d+) (<=|>) ([-+.\dEe]+)\)")


def tree_rules(description: str) -> set[Rule]:
    """The rule of every path from the root in a printed tree.

    Two bounds on one statistic in the same direction become the tighter one.
    """
    rules: set[Rule] = set()
    path: list[tuple[int, Condition]] = []
    for line in description.splitlines():
        found = _SPLIT.match(line)
        if not found:
            continue
        indent, feature, sign, bound = found.groups()
        while path and path[-1][0] >= len(indent):
            path.pop()
        path.append((len(indent), Condition(STATISTICS[int(feature)], sign == ">", float(bound))))
        tight: dict[tuple[str, bool], float] = {}
        for _, c in path:
            known = tight.get((c.statistic, c.above), c.bound)
            tight[c.statistic, c.above] = max(known, c.bound) if c.above else min(known, c.bound)
        rules.add(tuple(sorted(Condition(name, above, b) for (name, above), b in tight.items())))
    return rules


def rule_column(rule: Rule) -> Column:
    first, *others = (condition.column() for condition in rule)
    for other in others:
        first = first & other
    return first


@dataclass(frozen=True)
class RuleModel:
    """Weighted rules; the score is the logistic function of their sum."""

    intercept: float
    weights: tuple[tuple[Rule, float], ...]

    def score(self) -> Column:
        total = F.lit(self.intercept)
        for rule, weight in self.weights:
            total = total + F.when(rule_column(rule), F.lit(weight)).otherwise(0.0)
        return 1.0 / (1.0 + F.exp(-total))


def training_rows(docs: DataFrame, labels: DataFrame, limit: int = TRAINING_ROWS) -> DataFrame:
    """Statistics and ``label`` of at most ``limit`` labelled documents by hash.

    One row for each document id. Never of held-out ones. Null labels and documents with contradicting labels
    are left out.
    """
    usable = labels.filter(F.col("doc_id").isNotNull() & F.col("quality").isin(0, 1))
    usable = usable.filter(~held_out(F.col("doc_id")))
    once = usable.groupBy("doc_id").agg(F.min("quality").alias("quality"), F.max("quality").alias("other"))
    once = once.filter(F.col("quality") == F.col("other"))
    share = 1.5 * limit / max(once.count(), 1)
    near = F.pmod(F.xxhash64("doc_id"), F.lit(_HASHES)) < int(min(share, 1.0) * _HASHES)
    some = once.filter(near).orderBy(F.xxhash64("doc_id"), "doc_id").limit(limit)
    some = stage(some.select("doc_id", F.col("quality").cast("double").alias("label")), "rule-labels")
    # At most `limit` rows of two numbers, and one text for each of them, however many rows an
    # id has: the one whose hash comes first.
    labelled = docs.select("doc_id", "text").join(F.broadcast(some), "doc_id")
    labelled = labelled.groupBy("doc_id").agg(
        F.min_by("text", F.xxhash64("text")).alias("text"), F.first("label").alias("label")
    )
    return stage(text_statistics(labelled).drop("doc_id"), "rule-training")


def fit_rules(training: DataFrame) -> RuleModel:
    """Trees, rules, lasso weights. With labels of one sort, only the intercept."""
    counts = {row.label: row["count"] for row in training.groupBy("label").count().collect()}
    if len(counts) < 2:
        known = 0.0 if not counts else (6.0 if 1.0 in counts else -6.0)
        return RuleModel(known, ())
    few = training.coalesce(4)
    rows = few.select("label", array_to_vector(F.array(*STATISTICS)).alias("features"))
    forest = RandomForestClassifier(
        numTrees=TREES, maxDepth=DEPTH, seed=SEED, featureSubsetStrategy="onethird", subsamplingRate=0.7
    ).fit(rows)
    rules = sorted(set().union(*(tree_rules(tree.toDebugString) for tree in forest.trees)))
    if not rules:
        return RuleModel(math.log(counts[1.0] / counts[0.0]), ())
    fires = F.array(*(rule_column(rule).cast("double") for rule in rules))
    lasso = LogisticRegression(elasticNetParam=1.0, regParam=PENALTY, maxIter=MOST_STEPS, tol=TOLERANCE, standardization=False)
    fitted = lasso.fit(few.select("label", array_to_vector(fires).alias("features")))
    pairs = zip(rules, map(float, fitted.coefficients.toArray()))
    return RuleModel(float(fitted.intercept), tuple((r, w) for r, w in pairs if w))


def score_quality(docs: DataFrame, labels: DataFrame, model: RuleModel | None = None) -> DataFrame:
    """``doc_id, held_out, score, predicted`` of every document.

    A null text is scored like an empty one. Copies are scored alike, each row
    once; a null ``doc_id`` is in no fold and never learned from. Columns other than
    ``doc_id`` and ``text`` are not looked at. Without labels all score 0.5.
    """
    learned = model or fit_rules(training_rows(docs, labels))
    scored = text_statistics(docs.select("doc_id", "text")).select(
        "doc_id", held_out(F.col("doc_id")).alias("held_out"), learned.score().alias("score")
    )
    return scored.select("*", (F.col("score") >= CUTOFF).cast("int").alias("predicted"))
