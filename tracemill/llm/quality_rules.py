"""Quality rules with thresholds learned from the corpus, in DataFrame functions only.

Every text gets counts. Ratios of these are summed up in quantile sketches, one per
language, source and metric: counts over integer buckets whose width is at most a
thirty-second of their value. Sketches are merged by adding counts, so partial ones are made before
any shuffle, sources can be merged into languages, and a sketch can be stored and
grown by later data. Unlike sampled sketches they do not depend on the order of rows.

A text is rejected where a ratio lies outside the fences of its language and source. Every
fence is computed from quantiles of their sketch; no cutoff is fixed. Small groups borrow
from their language, and languages from all texts, by weight: the larger a group, the less.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tracemill.operators.projection import computed_once
from tracemill.sources.staging import stage

# Fixed values of the base rules.
BLANKS = " \t\n\x0b\f\r"
BLANK_RUN = r"[\x20\x09-\x0D]+"
SYMBOLS = "#*$%&|<>"
WINDOW = 3
LEAST_WORDS = 50
MOST_REPEATED_PERCENT = 50

# Leading binary digits that a bucket keeps.
DIGITS = 6
# A group's sketch is blended with its language's as if that were so many texts more.
PRIOR_TEXTS = 30
# Parts of a text in which blended weights are counted, as whole numbers.
UNIT = 100_000


@dataclass(frozen=True)
class Fence:
    """Bounds learned from the quantiles ``upper`` and ``lower`` (in per cent) of a metric.

    The upper bound lies ``reach`` times their distance above ``upper`` and a bucket more; with
    ``low`` there is a lower bound as far below ``lower``. A metric that is 0 for nearly all
    texts needs a quantile further out.
    """

    metric: str
    upper: int
    lower: int
    reach: int
    low: bool = False


FENCES = (
    Fence("word_length", 75, 25, reach=6, low=True),
    Fence("symbol_rate", 90, 50, reach=1),
    Fence("dup_line_rate", 99, 50, reach=1),
    Fence("repeat_rate", 99, 50, reach=1),
)
LEVELS = tuple(sorted({level for fence in FENCES for level in (fence.upper, fence.lower)}))


def words_of(text: Column) -> Column:
    return F.filter(F.split(text, BLANK_RUN), lambda word: word != "")


def _repeated(grams: Column, window: int) -> Column:
    """Positions under windows whose hash occurs twice or more."""
    marked = F.array_sort(F.transform(grams, lambda gram, at: F.struct(gram.alias("h"), at.alias("at"))))
    return F.when(F.size(F.array_distinct(grams)) == F.size(grams), F.lit(None)).otherwise(marked)


def text_counts(docs: DataFrame, text: str = "text", window: int = WINDOW) -> DataFrame:
    """Rows of ``docs`` with counts of their whole text; a null text has none.

    ``n_words, word_chars, n_symbols, n_lines, n_dup_lines, n_repeat_words``. Lines
    without a word are not counted. Windows are compared by a 64-bit hash inside
    one text. The steps are apart, or each would be computed again by the next.
    """
    kept = [F.col(name) for name in docs.columns if name != text]
    whole = F.coalesce(F.col(text), F.lit(""))
    first = computed_once(docs.select(*kept, whole.alias("_text"), words_of(whole).alias("_words")))
    lines = F.filter(F.split("_text", "\n", -1), lambda line: F.translate(line, BLANKS, "") != "")
    gram = lambda at: F.xxhash64(*(F.get("_words", at + step) for step in range(window)))
    starts = F.sequence(F.lit(0), F.size("_words") - window)
    grams = F.when(F.size("_words") >= window, F.transform(starts, gram)).otherwise(
        F.array().cast("array<bigint>")
    )
    second = computed_once(
        first.select(
            *kept,
            F.size("_words").cast("long").alias("n_words"),
            F.length(F.translate("_text", BLANKS, "")).cast("long").alias("word_chars"),
            (F.length("_text") - F.length(F.translate("_text", SYMBOLS, ""))).cast("long").alias("n_symbols"),
            lines.alias("_lines"),
            grams.alias("_grams"),
        )
    )
    third = computed_once(
        second.select(
            "*",
            F.size("_lines").cast("long").alias("n_lines"),
            (F.size("_lines") - F.size(F.array_distinct("_lines"))).cast("long").alias("n_dup_lines"),
            _repeated(F.col("_grams"), window).alias("_sorted"),
        ).drop("_lines", "_grams")
    )
    same = lambda x, at: (F.get("_sorted", at - 1)["h"] == x["h"]) | (F.get("_sorted", at + 1)["h"] == x["h"])
    again = F.filter("_sorted", lambda x, at: F.coalesce(same(x, at), F.lit(False)))
    places = F.array_sort(F.transform(again, lambda x: x["at"]))
    fourth = computed_once(third.select("*", places.alias("_places")).drop("_sorted"))
    # Each window adds the words that the window before it does not cover.
    covered = F.aggregate(
        F.coalesce("_places", F.array().cast("array<int>")),
        F.struct(F.lit(-window).alias("last"), F.lit(0).cast("long").alias("words")),
        lambda sofar, at: F.struct(
            at.alias("last"),
            (sofar["words"] + F.least(at - sofar["last"], F.lit(window))).alias("words"),
        ),
        lambda sofar: sofar["words"],
    )
    return computed_once(fourth.select("*", covered.alias("n_repeat_words")).drop("_places"))


def fails_base() -> Column:
    """Too few words, or more than half of them in repeated windows."""
    return (F.col("n_words") < LEAST_WORDS) | (
        100 * F.col("n_repeat_words") > MOST_REPEATED_PERCENT * F.col("n_words")
    )


def _rate(part: str, whole: str, scale: int) -> Column:
    return F.coalesce(F.expr(f"{scale} * {part} div nullif({whole}, 0)"), F.lit(0).cast("long"))


def metric_columns() -> dict[str, Column]:
    """Whole numbers, so that every engine computes the same; 0 without words."""
    return {
        "word_length": _rate("word_chars", "n_words", 100),
        "symbol_rate": _rate("n_symbols", "n_words", 1000),
        "dup_line_rate": _rate("n_dup_lines", "n_lines", 1000),
        "repeat_rate": _rate("n_repeat_words", "n_words", 1000),
    }


def bucket(value: Column) -> Column:
    """The smallest value with the same leading binary digits."""
    drop = F.greatest(F.length(F.bin(value)) - DIGITS, F.lit(0))
    return F.call_function("shiftleft", F.call_function("shiftright", value, drop), drop)


def quantile_sketches(measured: DataFrame, groups: tuple[str, ...]) -> DataFrame:
    """``groups, metric, bucket, texts`` of rows that hold the metrics.

    Partial counts are made before the shuffle, so a large group costs no more than
    a small one.
    """
    pairs = F.array(
        *(F.struct(F.lit(f.metric).alias("metric"), bucket(F.col(f.metric)).alias("bucket")) for f in FENCES)
    )
    flat = measured.select(*groups, F.inline(pairs))
    return flat.groupBy(*groups, "metric", "bucket").agg(F.count("*").alias("texts"))


def merge_sketches(sketches: DataFrame, groups: tuple[str, ...]) -> DataFrame:
    return sketches.groupBy(*groups, "metric", "bucket").agg(F.sum("texts").alias("texts"))


def blended(sketches: DataFrame) -> DataFrame:
    """``lang, source, metric, bucket, weight`` of every group, in whole parts of a text.

    ``weight`` is the group's own texts and ``PRIOR_TEXTS`` spread like its language's,
    which is blended with all texts in the same way. A group has a row for every bucket of
    the metric in any text; these are bounded in number by the digits of a bucket.
    """
    every = merge_sketches(sketches, ()).withColumnRenamed("texts", "all_texts")
    every = every.select(
        "metric", "bucket", F.expr(f"all_texts * {UNIT} div sum(all_texts) over (partition by metric)").alias("all_share")
    )

    def spread(own: DataFrame, groups: list[str], prior: DataFrame, on: list[str]) -> DataFrame:
        """Counts of each group beside the prior's shares, in all buckets of the prior."""
        sizes = own.groupBy(*groups, "metric").agg(F.sum("texts").alias("size")).alias("g")
        same = [F.col(f"g.{name}").eqNullSafe(F.col(f"p.{name}")) for name in [*on, "metric"]]
        condition = same[0] if len(same) == 1 else same[0] & same[1]
        grid = sizes.join(prior.alias("p"), condition).select(
            *(F.col(f"g.{name}").alias(name) for name in [*groups, "metric"]), "size", "bucket", "prior"
        ).alias("l")
        counts = own.alias("r")
        same = F.col("l.bucket") == F.col("r.bucket")
        for name in [*groups, "metric"]:
            same = same & F.col(f"l.{name}").eqNullSafe(F.col(f"r.{name}"))
        return grid.join(counts, same, "left").select("l.*", F.coalesce("texts", F.lit(0)).alias("texts"))

    languages = spread(merge_sketches(sketches, ("lang",)), ["lang"], every.withColumnRenamed("all_share", "prior"), [])
    shares = languages.select(
        "lang", "metric", "bucket",
        F.expr(f"(texts * {UNIT} + {PRIOR_TEXTS} * prior) div (size + {PRIOR_TEXTS})").alias("prior"),
    )
    own = merge_sketches(sketches, ("lang", "source"))
    groups = spread(own, ["lang", "source"], shares, ["lang"])
    weight = F.col("texts") * UNIT + PRIOR_TEXTS * F.col("prior")
    return groups.select("lang", "source", "metric", "bucket", weight.alias("weight"))


def quantiles(weights: DataFrame) -> DataFrame:
    """``lang, source, metric, q<level>`` of each blended sketch."""
    within = Window.partitionBy("lang", "source", "metric")
    upto = F.sum("weight").over(within.orderBy("bucket").rowsBetween(Window.unboundedPreceding, 0))
    ranked = weights.select("*", upto.alias("upto"), F.sum("weight").over(within).alias("total"))
    at = lambda level: F.min(F.when(100 * F.col("upto") >= level * F.col("total"), F.col("bucket")))
    return ranked.groupBy("lang", "source", "metric").agg(*(at(level).alias(f"q{level}") for level in LEVELS))


def bucket_width(value: Column) -> Column:
    """How many whole numbers fall into the bucket that begins with this value."""
    drop = F.greatest(F.length(F.bin(value)) - DIGITS, F.lit(0))
    return F.call_function("shiftleft", F.lit(1).cast("long"), drop)


def thresholds(sketches: DataFrame) -> DataFrame:
    """``lang, source`` and ``<metric>_low/_high`` for every group."""
    rows = quantiles(blended(sketches))
    bounds = []
    for fence in FENCES:
        upper, lower = F.col(f"q{fence.upper}"), F.col(f"q{fence.lower}")
        away = fence.reach * (upper - lower)
        here = F.col("metric") == fence.metric
        bounds.append(F.max(F.when(here, upper + away + bucket_width(upper))).alias(f"{fence.metric}_high"))
        if fence.low:
            bounds.append(F.max(F.when(here, lower - away)).alias(f"{fence.metric}_low"))
    return rows.groupBy("lang", "source").agg(*bounds)


def inside_fences() -> Column:
    good = F.lit(True)
    for fence in FENCES:
        good = good & (F.col(fence.metric) <= F.col(f"{fence.metric}_high"))
        if fence.low:
            good = good & (F.col(fence.metric) >= F.col(f"{fence.metric}_low"))
    return good


def judge_quality(docs: DataFrame, text: str = "text", carry: bool = False) -> DataFrame:
    """Every document's ``text_hash``, counts, metrics, ``base_failed`` and ``kept``.

    ``carry`` adds the whole row as ``document``, so that a verdict need not be joined to it.

    ``docs`` has ``doc_id, lang, source`` and the text; other columns are not looked
    at. A null or empty text has no words and fails. Null languages and sources
    are groups of their own. Copies are judged alike, each row once. Sketches are
    made of the texts that pass the base rules.
    """
    whole = F.col(text)
    carried = [F.struct(*docs.columns).alias("document")] if carry else []
    narrow = docs.select(
        "doc_id", "lang", "source", F.xxhash64(whole).alias("text_hash"), whole.alias("_whole"), *carried
    )
    counted = text_counts(narrow, "_whole")
    metrics = [column.alias(name) for name, column in metric_columns().items()]
    measured = stage(counted.select("*", *metrics, fails_base().alias("base_failed")), "quality-counts")
    groups = ("lang", "source")
    bounds = thresholds(quantile_sketches(measured.filter(~F.col("base_failed")), groups))
    bounds = bounds.select(*(F.col(name).alias(f"_{name}" if name in groups else name) for name in bounds.columns))
    # Stored, so that Spark knows their size: while they are few, rows meet them where they lie.
    bounds = stage(bounds, "quality-bounds")
    same = F.col("lang").eqNullSafe(F.col("_lang")) & F.col("source").eqNullSafe(F.col("_source"))
    judged = measured.join(bounds, same, "left")
    kept = ~F.col("base_failed") & F.coalesce(inside_fences(), F.lit(False))
    return judged.select(*measured.columns, kept.alias("kept"))


def passing_documents(docs: DataFrame, text: str = "text") -> DataFrame:
    """The rows of ``docs`` that are kept, whole; no document is shuffled.

    Rows are stored beside their counts, and the few bounds are joined to these. Null and
    empty texts go; copies and rows without id are judged one by one; all columns come back
    as they were, whatever they are called. An empty table stays empty.
    """
    judged = judge_quality(docs, text, carry=True).filter("kept")
    return judged.select(*(F.col("document")[name].alias(name) for name in docs.columns))
