import hashlib
import random

import numpy as np
import pytest
from tokenizers import Tokenizer

from tracemill.llm.bpe import Encoder, encode_texts
from tracemill.llm.queries import tokenizer

PATH = tokenizer("word_bpe_49k.json")


@pytest.fixture(scope="module")
def library():
    return Tokenizer.from_file(PATH)


@pytest.fixture(scope="module")
def encoder():
    return Encoder(PATH)


def odd_texts():
    pick = random.Random(7)
    ranges = [(33, 127), (97, 123), (160, 600), (768, 880), (880, 1500), (0x4E00, 0x4F00), (0x1F300, 0x1F700), (1, 33), (32, 33)]
    made = ["".join(chr(pick.randrange(*pick.choice(ranges))) for _ in range(120)) for _ in range(200)]
    return made + [
        "", " ", "a<|endoftext|>B <|startoftext|>", "Don't WE'LL 12345 ½ ﬁ İSTANBUL ΣΑΣ", "x" * 3000,
        "ab!" * 400, "é ́ x́", "\x1c\x85\xa0 z​z", "ﬀŉẞß", "KK", "tab\tnew\nline",
    ]


def test_like_the_library(encoder, library):
    for text in odd_texts():
        ids, shown = encoder.encode(text)
        expected = library.encode(text, add_special_tokens=False).ids
        assert np.frombuffer(ids, "<u4").tolist() == expected
        assert shown == library.decode(expected, skip_special_tokens=False)


def test_cuts_are_certain(encoder):
    """No token of any word crosses one, and putting fragments together loses nothing."""
    merges = encoder.merges
    for word in ("internationalization", "zzqxjkvb", "a!?b", "qwrtpsdf"):
        fragments = merges.fragments(word)
        assert "".join(fragments) == word
        whole = merges.encode(word, True)
        apart = [t for i, f in enumerate(fragments, 1) for t in merges.encode(f, i == len(fragments))]
        assert whole == apart
    assert len(merges.fragments("zzqxjkvb")) > 1


def test_long_fragments_merge_alike(encoder):
    merges = encoder.merges
    pick = random.Random(3)
    for _ in range(50):
        symbols = [pick.choice("aeinrst") for _ in range(47)]
        assert merges._merge_long([*symbols]) == merges.encode("".join(symbols), False)


def test_memory_is_bounded(encoder, library, monkeypatch):
    monkeypatch.setattr("tracemill.llm.bpe.REMEMBERED", 5)
    text = " ".join(f"word{i} other{i}" for i in range(50))
    ids, _ = encoder.encode(text)
    assert np.frombuffer(ids, "<u4").tolist() == library.encode(text, add_special_tokens=False).ids
    assert len(encoder.known_chunks) <= 200_000


def test_rows(spark, odd_documents, no_documents, library):
    rows = encode_texts(odd_documents, PATH, ids=True).collect()
    texts = sorted((r.doc_id or -1, r.text or "") for r in odd_documents.collect())
    for row, (_, text) in zip(sorted(rows, key=lambda r: r.doc_id or -1), texts):
        ids = library.encode(text, add_special_tokens=False).ids
        assert row.ids == ids and row.n_tokens == len(ids)
        assert row.ids_sha256 == hashlib.sha256(np.array(ids, "<u4").tobytes()).hexdigest()
        shown = library.decode(ids, skip_special_tokens=False)
        assert row.decoded_sha256 == hashlib.sha256(shown.encode()).hexdigest()
    assert encode_texts(no_documents, PATH).collect() == []
