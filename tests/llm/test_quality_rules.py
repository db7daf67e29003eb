import re
from collections import Counter

from tracemill.llm.quality_rules import judge_quality, quantile_sketches, merge_sketches, metric_columns, passing_documents, text_counts, thresholds

WORD = re.compile(r"[^\x20\x09-\x0D]+")


def plain_counts(text):
    text = text or ""
    words = WORD.findall(text)
    lines = [line for line in text.split("\n") if WORD.search(line)]
    grams = [tuple(words[i : i + 3]) for i in range(len(words) - 2)]
    often = Counter(grams)
    covered = {i + k for i, g in enumerate(grams) if often[g] > 1 for k in range(3)}
    symbols = sum(text.count(c) for c in "#*$%&|<>")
    return len(words), sum(map(len, words)), symbols, len(lines) - len(set(lines)), len(covered)


def test_counts_like_brute_force(spark, smallest):
    documents = spark.read.parquet(f"{smallest}/documents.parquet").select("doc_id", "text")
    texts = ["a b c a b c", "x y z x", "a\na\n \n\nb#\na", "a a a a a", "p q r s p q r t p q r", None, "", "é|<b>\u00a0c"]
    own = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    for docs in (own, documents):
        expected = {r.doc_id: plain_counts(r.text) for r in docs.collect()}
        fields = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words")
        found = {r.doc_id: tuple(r[f] for f in fields) for r in text_counts(docs).collect()}
        assert found == expected


def test_thresholds_adapt(spark):
    """The same rate of symbols is ordinary in one source and an outlier in the other."""
    plain = " ".join(f"word{i}" for i in range(80))
    marked = " ".join(f"word{i}" + "#" * (i % 2) for i in range(80))
    rows = [(i, f"{plain} {i}", "en", "prose") for i in range(150)] + [(200, marked, "en", "prose")]
    rows += [(1000 + i, f"{marked} {i}", "en", "code") for i in range(150)]
    judged = judge_quality(spark.createDataFrame(rows, "doc_id long, text string, lang string, source string"))
    kept = {r.doc_id: r.kept for r in judged.collect()}
    assert [d for d, good in kept.items() if not good] == [200]


def test_bounds_differ_by_source_and_are_learned(spark):
    """On the scale of the smaller test data too; the labels say who is hurt."""
    folder = "/root/testdata/sf0.01"
    docs = spark.read.parquet(f"{folder}/documents.parquet")
    judged = judge_quality(docs)
    measured = judged.filter("not base_failed")
    bounds = thresholds(quantile_sketches(measured, ("lang", "source"))).collect()
    assert len(bounds) > 50
    for name in ("word_length_high", "word_length_low", "dup_line_rate_high", "repeat_rate_high"):
        assert len({row[name] for row in bounds}) > 3
    labels = spark.read.parquet(f"{folder}/labels.parquet")
    known = measured.join(labels, "doc_id")
    kept = {(r.quality, r.kept): r["count"] for r in known.groupBy("quality", "kept").count().collect()}
    assert kept.get((1, False), 0) <= 0.01 * kept[1, True]
    assert kept[0, False] > 3 * kept.get((0, True), 0)


def test_a_small_group_borrows_from_its_language(spark):
    plain = " ".join(f"word{i}" for i in range(80))
    rows = [(i, plain + f" {i}", "en", "large") for i in range(200)] + [(300 + i, plain + " # # #", "en", "small") for i in range(2)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string")
    bounds = {r.source: r.symbol_rate_high for r in thresholds(quantile_sketches(judge_quality(docs), ("lang", "source"))).collect()}
    assert bounds == {"large": 1, "small": 1}


def test_odd_rows(odd_documents, no_documents):
    judged = {r.doc_id: r for r in judge_quality(odd_documents).collect()}
    assert judged[0].n_words == 0 and judged[0].base_failed and not judged[0].kept
    assert judged[7].n_words == 3000 and judged[7].n_repeat_words == 3000
    assert judge_quality(odd_documents).count() == odd_documents.count()
    assert judge_quality(no_documents).collect() == []


def test_sketches_merge(spark, smallest):
    docs = spark.read.parquet(f"{smallest}/documents.parquet")
    measured = text_counts(docs).select("*", *(c.alias(n) for n, c in metric_columns().items()))
    whole = quantile_sketches(measured, ("lang",))
    parts = quantile_sketches(measured.filter("doc_id % 2 = 0"), ("lang", "source")).unionByName(
        quantile_sketches(measured.filter("doc_id % 2 = 1"), ("lang", "source"))
    )
    merged = merge_sketches(parts, ("lang",))
    assert sorted(map(tuple, merged.collect())) == sorted(map(tuple, whole.collect()))


def test_native(odd_documents):
    plan = judge_quality(odd_documents)._jdf.queryExecution().executedPlan().toString()
    assert "Python" not in plan and "Arrow" not in plan


def test_passing_documents_are_whole_and_not_shuffled(spark, smallest, odd_documents, no_documents):
    docs = spark.read.parquet(f"{smallest}/documents.parquet")
    verdicts = {r.doc_id: r.kept for r in judge_quality(docs).collect()}
    kept = passing_documents(docs)
    expected = [r for r in docs.collect() if verdicts[r.doc_id]]
    assert sorted(map(repr, kept.collect())) == sorted(map(repr, expected)) and len(expected) > 100
    assert kept.columns == docs.columns
    named = odd_documents.selectExpr("*", "1 as document", "2 as metric", "3 as text_hash")
    assert passing_documents(named).dtypes == named.dtypes
    assert passing_documents(no_documents).collect() == []
