from pyspark.sql import functions as F

from tracemill.llm import rule_ensemble as r

TREE = """DecisionTreeClassificationModel: depth=2, numNodes=5
  If (feature 0 <= 10.5)
   If (feature 2 <= 3.0)
    Predict: 0.0
   Else (feature 2 > 3.0)
    Predict: 1.0
  Else (feature 0 > 10.5)
   If (feature 0 <= 20.0)
    Predict: 1.0
   Else (feature 0 > 20.0)
    Predict: 0.0
"""


def test_paths_become_rules():
    words, length = r.STATISTICS[0], r.STATISTICS[2]
    low, high = r.Condition(words, False, 10.5), r.Condition(words, True, 10.5)
    assert r.tree_rules(TREE) == {
        (low,),
        (high,),
        (low, r.Condition(length, False, 3.0)),
        (low, r.Condition(length, True, 3.0)),
        (r.Condition(words, False, 20.0), high),
        (r.Condition(words, True, 20.0),),
    }


def test_held_out_accuracy(spark):
    sf = "/root/testdata/sf0.01"
    docs, labels = (spark.read.parquet(f"{sf}/{t}.parquet") for t in ("documents", "labels"))
    model = r.fit_rules(r.training_rows(docs, labels))
    assert 0 < len(model.weights) < 80
    scored = r.score_quality(docs, labels, model)
    assert scored.count() == docs.count()
    judged = scored.filter("held_out").join(labels, "doc_id")
    right = judged.agg(F.avg((F.col("predicted") == F.col("quality")).cast("double"))).first()[0]
    assert right > 0.93
    assert scored.filter("score < 0 or score > 1 or score is null").isEmpty()


def test_nothing_is_learned_from_held_out_rows(spark):
    docs = spark.range(200).select(F.col("id").alias("doc_id"), F.lit("some text").alias("text"))
    out = r.held_out(F.col("doc_id"))
    labels = docs.select("doc_id", F.when(out, 1).otherwise(0).alias("quality"))
    assert {row.label for row in r.training_rows(docs, labels).collect()} == {0.0}
    assert r.training_rows(docs, labels, limit=20).count() == 20


def test_odd_rows(spark, odd_documents, no_documents):
    labels = spark.createDataFrame([(1, 0), (5, 1), (5, 0), (None, 1), (7, None), (8, 1)], "doc_id long, quality int")
    rows = r.score_quality(odd_documents, labels).collect()
    assert len(rows) == odd_documents.count()
    by = {row.doc_id: row.score for row in rows}
    assert by[0] == by[1] and all(0 <= row.score <= 1 for row in rows)
    assert r.score_quality(no_documents, labels).collect() == []
    none = r.score_quality(odd_documents, labels.limit(0)).collect()
    assert {row.score for row in none} == {0.5}


def test_one_row_for_each_labelled_id(spark):
    """However many rows a labelled id has; the same one in every layout."""
    docs = spark.range(3000).select(
        F.when(F.col("id") % 3 == 0, 1).otherwise(F.col("id")).alias("doc_id"),
        F.concat(F.lit("some words "), F.repeat(F.lit("x "), (F.col("id") % 50).cast("int"))).alias("text"),
    )
    labels = spark.range(1, 400).select(F.col("id").alias("doc_id"), (F.col("id") % 2).alias("quality"))
    rows = [sorted(map(tuple, r.training_rows(layout, labels, 100).collect())) for layout in (docs, docs.repartition(5))]
    assert rows[0] == rows[1] and len(rows[0]) <= 100
    every = r.training_rows(docs, labels).count()
    asked = labels.filter((F.crc32(F.col("doc_id").cast("string")) % 5 != 0)).join(docs, "doc_id").select("doc_id")
    assert every == asked.distinct().count()


def plain_statistics(text):
    words = text.encode().split()
    lines = [line for line in text.encode().split(b"\n") if line.split()]
    grams = [tuple(words[i : i + r.WINDOW]) for i in range(len(words) - r.WINDOW + 1)]
    often = {g for g in grams if grams.count(g) > 1}
    covered = {i + k for i, g in enumerate(grams) if g in often for k in range(r.WINDOW)}
    return len(words), len(lines), len(covered)


def test_statistics_like_brute_force(spark):
    texts = ["a b c a b c", "x\n\nx\n y z", "a a a a a", "one", "", " \n ", "p q r s p q r t"]
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    for row in r.text_statistics(docs).collect():
        n_words, n_lines, covered = plain_statistics(texts[row.doc_id])
        assert (row.n_words, row.n_lines) == (n_words, n_lines)
        assert row.repeat_rate == (1000 * covered / n_words if n_words else 0)
