"""Counts against the tokenizer's own library."""

import json
import random

import pytest
from tokenizers import Tokenizer

from tracemill.llm import token_counts
from tracemill.llm.queries import QUERIES, tokenizer
from tracemill.llm.token_counts import Counter, count_tokens, whole_tokens

PATH = tokenizer("byte_bpe_50k.json")


@pytest.fixture(scope="module")
def library():
    return Tokenizer.from_file(PATH)


@pytest.fixture(scope="module")
def counter():
    return Counter(PATH, whole_tokens(PATH))


def wanted(library, text):
    return len(library.encode(text, add_special_tokens=False).ids)


def test_proved_strings_are_one_token(library):
    whole = sorted(whole_tokens(PATH))
    # A string of several pre-tokens is proved for its bytes, but never looked up.
    alone = [t for t in whole if len(library.pre_tokenizer.pre_tokenize_str(t)) == 1]
    assert len(alone) > 49_000
    assert all(len(e.ids) == 1 for e in library.encode_batch(alone, add_special_tokens=False))


def test_a_string_that_merges_never_reach_is_not_proved(tmp_path):
    file = json.loads(open(PATH, encoding="utf-8").read())
    # No merge makes these letters one token, though the vocabulary holds it.
    file["model"]["vocab"]["zqxjv"] = 50257
    path = str(tmp_path / "odd.json")
    with open(path, "w", encoding="utf-8") as out:
        json.dump(file, out)
    assert "zqxjv" not in whole_tokens(path)
    assert Counter(path, whole_tokens(path)).count("zqxjv") == wanted(Tokenizer.from_file(path), "zqxjv") > 1


def test_query(spark, smallest, library):
    found = QUERIES["op13_whole_tokens"](spark, smallest)
    assert found.columns == ["doc_id", "n_bytes", "n_tokens", "over_limit"]
    texts = {r.doc_id: r.text or "" for r in spark.read.parquet(f"{smallest}/documents.parquet").collect()}
    rows = found.collect()
    assert len(rows) == len(texts)
    for row in rows:
        text = texts[row.doc_id]
        assert (row.n_bytes, row.n_tokens) == (len(text.encode()), wanted(library, text))
        assert row.over_limit == (row.n_tokens > 512)


PIECES = ["'", "'s", "'LL", "  ", "\n", "\x1c", "\x85", "\xa0", "a", "Zz", "1", "٣", "é", "é", "日本", "ſ"]
PIECES += ["\U0001f600", "<|endoftext|>", "<|end", "՘", "꟎", "\t", "\x00", "!!", " ", "　"]


@pytest.mark.parametrize("part", [1 << 20, 5])
def test_odd_texts(library, counter, monkeypatch, part):
    monkeypatch.setattr(token_counts, "PART", part)
    chance = random.Random(part)
    texts = ["".join(chance.choices(PIECES, k=chance.randrange(30))) for _ in range(4000)]
    assert [counter.count(text) for text in texts] == [wanted(library, text) for text in texts]


def test_very_long_texts(library, counter):
    for text in ("word " * 600_000, "x" * 200_000, " " * 100_000 + "end"):
        assert counter.count(text) == wanted(library, text)


def test_bounded_memory_keeps_counts(library, monkeypatch):
    monkeypatch.setattr(token_counts, "REMEMBERED", 3)
    counter = Counter(PATH, whole_tokens(PATH))
    text = " ".join(f"unheard{i}of the" for i in range(50))
    assert counter.count(text) == counter.count(text) == wanted(library, text)
    assert len(counter.sizes) <= len(whole_tokens(PATH)) + 3


def test_odd_rows(spark, odd_documents, no_documents, library):
    rows = count_tokens(odd_documents, PATH, limit=5).collect()
    given = odd_documents.collect()
    assert sorted((r.doc_id or -1, r.n_tokens) for r in rows) == sorted(
        (r.doc_id or -1, wanted(library, r.text or "")) for r in given
    )
    assert all(r.over_limit == (r.n_tokens > 5) for r in rows)
    assert count_tokens(no_documents, PATH).count() == 0
    named = odd_documents.withColumnRenamed("doc_id", "n_tokens")
    assert count_tokens(named.select("n_tokens", "text").withColumnRenamed("n_tokens", "name"), PATH, id_column="name").count() == len(given)


def test_other_kinds_are_refused():
    with pytest.raises(ValueError):
        whole_tokens(tokenizer("word_bpe_49k.json"))
