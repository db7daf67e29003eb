import random
import re
from math import comb

from tracemill.llm.components import connected_components
from tracemill.llm.near_dedup import least_shared, near_duplicates
from tracemill.llm.verdicts import keep_rows

WORD = re.compile(r"[^\x20\x09-\x0D]+")
LOWER = {c: c + 32 for c in range(65, 91)}


def plain_set(text):
    words = WORD.findall((text or "").translate(LOWER))
    return {tuple(words[i : i + 5]) for i in range(max(1, len(words) - 4))} if words else set()


def plain_components(rows):
    sets = [plain_set(text) for _, text in rows]
    top = list(range(len(rows)))

    def root(i):
        while top[i] != i:
            i = top[i]
        return i

    for i, one in enumerate(sets):
        for j in range(i):
            common = len(one & sets[j])
            if common and 100 * common >= 85 * len(one | sets[j]):
                top[root(i)] = root(j)
    name = {}
    for i, (doc, _) in enumerate(rows):
        name[root(i)] = min(name.get(root(i), doc), doc)
    return {doc: (len(sets[i]), name[root(i)]) for i, (doc, _) in enumerate(rows)}


def found(docs):
    return {r.doc_id: (r.n_shingles, r.component_id) for r in near_duplicates(docs).collect()}


def edited(pick, words, edits):
    words = list(words)
    for _ in range(edits):
        words[pick.randrange(len(words))] = f"e{pick.randrange(10**6)}"
    return " ".join(words)


def test_families_like_brute_force(spark):
    """Copies with few and many edits, so that links chain and most pairs are none."""
    pick = random.Random(5)
    rows = []
    for size in (7, 20, 60, 68, 75, 90, 150, 600):
        base = [f"w{pick.randrange(10**6)}" for _ in range(size)]
        rows += [edited(pick, base, pick.randint(0, max(1, size // 20))) for _ in range(25)]
        rows += [" ".join(base).upper(), " ".join(base) + "\n", " ".join(base[: size * 9 // 10])]
    shared = " ".join(f"boiler{i}" for i in range(30))
    rows += [shared + " " + " ".join(f"u{pick.randrange(10**6)}" for _ in range(n)) for n in range(1, 40)]
    rows += [None, "", "  \t", "a b", "A  b", "one"]
    pick.shuffle(rows)
    rows = list(enumerate(rows))
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    assert found(docs) == plain_components(rows)


def test_given_documents_like_brute_force(spark, smallest):
    docs = spark.read.parquet(f"{smallest}/documents.parquet")
    rows = [(r.doc_id, r.text) for r in docs.select("doc_id", "text").collect()]
    assert found(docs) == plain_components(rows)


def test_odd_rows(spark, odd_documents, no_documents):
    rows = near_duplicates(odd_documents).collect()
    assert len(rows) == odd_documents.count()
    by = {r.doc_id: r for r in rows}
    assert by[5].component_id == by[6].component_id == 5 and not by[6].kept
    assert by[0].n_shingles == 0 and by[0].kept and by[50].kept
    assert all(r.kept and r.component_id is None for r in rows if r.doc_id is None)
    kept = keep_rows(odd_documents, near_duplicates(odd_documents))
    assert kept.columns == odd_documents.columns and kept.count() == odd_documents.count() - 1
    assert near_duplicates(no_documents).collect() == []
    alone = spark.createDataFrame([(1, "only one text here now")], "doc_id long, text string")
    assert found(alone) == {1: (1, 1)}


def test_components(spark):
    chain = [(i, i + 1) for i in range(0, 40)] + [(100, 101), (101, 100)] + [(200, 200 + i) for i in range(1, 30)]
    labels = connected_components(spark.createDataFrame(chain, "a long, b long")).collect()
    assert {r.component for r in labels} == {0, 100, 200} and len(labels) == 41 + 2 + 30


def test_needed_overlap():
    assert least_shared(10, 64, 85) == 9
    assert least_shared(64, 64, 85) <= 55
    assert 35 <= least_shared(10**6, 64, 85) <= 38


def test_chance_of_a_missed_link():
    """The figures of the module's docstring."""
    for percent, chance in ((85, 3.5e-8), (80, 1.95e-8)):
        p, needed = percent / 100, least_shared(10**9, 64, percent)
        missed = sum(comb(64, i) * p**i * (1 - p) ** (64 - i) for i in range(needed))
        assert 0.99 * chance < missed < 1.01 * chance


def test_exact_links_leave_nothing_to_a_sketch(spark):
    """With a sketch of four values links get lost; listing whole sets finds them all."""
    pick = random.Random(7)
    rows = []
    for _ in range(12):
        base = [f"w{pick.randrange(10**6)}" for _ in range(80)]
        rows += [" ".join(base), *(edited(pick, base, 1) for _ in range(3))]
    rows = list(enumerate(rows))
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    expected = plain_components(rows)
    assert len({c for _, c in expected.values()}) == 12
    exact = near_duplicates(docs, size=4, exact=True)
    assert {r.doc_id: (r.n_shingles, r.component_id) for r in exact.collect()} == expected
