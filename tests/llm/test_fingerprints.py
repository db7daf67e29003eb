import hashlib

import numpy as np

from tracemill.llm import fingerprints as fp
from tracemill.llm.shingles import shingle_set


def plain_rows(rows):
    """Straight over the list, in descending order of ids."""
    ordered = sorted(rows, key=lambda r: -r[0])
    out = {}
    for i, (doc, text) in enumerate(ordered):
        after = ordered[(i + 1) % len(ordered)][1] or ""
        text = text or ""
        cut = len(text) // 3
        edited = text[: len(text) - cut] + after[:cut]
        a, b, c = (fp.sketch(t) for t in (text, edited, after))
        out[doc] = (
            len(text), hashlib.sha256(edited.encode()).hexdigest(), fp.write(a), fp.write(b),
            fp.likeness(a, b), fp.likeness(a, c),
        )
    return out


def found(docs):
    return {r.doc_id: tuple(r)[1:] for r in fp.compare_with_next(docs).collect()}


def test_like_brute_force(spark, settings, smallest):
    docs = spark.read.parquet(f"{smallest}/documents.parquet").select("doc_id", "text")
    rows = [tuple(r) for r in docs.collect()]
    for ranges in (1, 8, 500):
        settings(spark__sql__shuffle__partitions=ranges)
        assert found(docs) == plain_rows(rows)
    one = spark.createDataFrame([(3, "a single text of a few words")], "doc_id long, text string")
    assert found(one) == plain_rows([(3, "a single text of a few words")])


def test_odd_rows(odd_documents, no_documents):
    rows = fp.compare_with_next(odd_documents).collect()
    assert len(rows) == odd_documents.count()
    by = {r.doc_id: r for r in rows}
    assert by[5].fingerprint == by[6].fingerprint != ""
    assert by[0].fingerprint == by[1].fingerprint == "" and by[0].n_chars == 0
    assert fp.compare_with_next(no_documents).collect() == []
    assert fp.fingerprint_documents(odd_documents).count() == odd_documents.count()


def test_estimates():
    words = [f"w{i}" for i in range(4000)]
    whole, half = (fp.sketch(" ".join(w)) for w in (words, words[:2000]))
    assert abs(fp.likeness(whole, half) - 0.5) < 0.15
    assert fp.containment(half, whole) > 0.85 and abs(fp.containment(whole, half) - 0.5) < 0.2
    assert abs(fp.distinct_shingles(whole) - 3996) < 1000
    assert fp.distinct_shingles(fp.sketch("a b c d e f")) == 2
    assert fp.likeness(fp.sketch(""), fp.sketch("")) == 1.0
    assert np.array_equal(fp.read(fp.write(whole)), whole)


def test_merging_parts(spark):
    texts = [" ".join(f"w{i}" for i in range(at, at + 300)) for at in range(0, 3000, 290)]
    docs = spark.createDataFrame(list(enumerate([*texts, None])), "doc_id long, text string")
    prints = fp.fingerprint_documents(docs).selectExpr("doc_id % 2 as part", "fingerprint")
    merged = {r.part: r.fingerprint for r in fp.merge_fingerprints(prints, ["part"]).collect()}
    for part in (0, 1):
        union = np.unique(np.concatenate([shingle_set(t) for t in texts[part::2]]))
        assert merged[part] == fp.write(union[: fp.SKETCH])


def test_a_hot_id_lies_in_many_ranges(spark, settings):
    """A third of all rows under one id, another third without id; each has the next in its order."""
    settings(spark__sql__shuffle__partitions=12)
    names = lambda i: 50 if i % 3 == 0 else None if i % 3 == 1 else i
    rows = [(names(i), f"text {i} of some words and {i * i} more") for i in range(900)]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    keyed = docs.selectExpr("~coalesce(doc_id, -9223372036854775807L - 1) as place", "xxhash64(text) as hash", "doc_id", "text")
    ordered = keyed.orderBy("place", "hash").collect()
    bounds = fp._range_bounds(keyed.select("place", "hash"), 12)
    assert len({b for b in bounds if b[0] == ~50}) >= 3 and len({b for b in bounds if b[0] == 2**63 - 1}) >= 3
    expected = {}
    for row, after in zip(ordered, ordered[1:] + ordered[:1]):
        cut = len(row.text) // 3
        edited = row.text[: len(row.text) - cut] + after.text[:cut]
        expected[hashlib.sha256(edited.encode()).hexdigest()] = row.doc_id
    rows = fp.compare_with_next(docs).collect()
    assert len(rows) == 900 and {r.edited_sha256: r.doc_id for r in rows} == expected
