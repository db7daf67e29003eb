import random
import zlib

import numpy as np
import pytest
from tokenizers import Tokenizer

from tracemill.llm.packing import (
    Plan,
    assemble_sequences,
    best_configuration,
    byte_level_encoder,
    cut_lengths,
    pack_documents,
    plan_sequences,
)
from tracemill.llm.queries import tokenizer

PATH = tokenizer("byte_bpe_50k.json")


@pytest.mark.parametrize("count", [1, 30, 3000])
def test_plans_hold_every_piece_once(count):
    pick = np.random.default_rng(count)
    counts = {}
    for total in np.clip(pick.lognormal(6.3, 1, count).astype(int), 1, 9000):
        for length in cut_lengths(int(total), 2048):
            counts[length] = counts.get(length, 0) + 1
    plan = plan_sequences(counts)
    filled = np.zeros(plan.sequences, int)
    ranks = {length: set() for length in counts}
    spans = [[] for _ in range(plan.sequences)]
    for length, rank, many, sequence, offset in plan.runs:
        filled[sequence : sequence + many] += length
        ranks[length] |= set(range(rank, rank + many))
        for i in range(many):
            spans[sequence + i].append((offset, offset + length))
    assert all(ranks[n] == set(range(counts[n])) for n in counts)
    assert filled.max() <= 2048 and filled.min() > 0
    for own in spans:
        ends = [0] + [end for _, end in sorted(own)]
        assert [start for start, _ in sorted(own)] == ends[:-1]
    least = -(-sum(n * c for n, c in counts.items()) // 2048)
    assert plan.sequences <= least * 1.01 + 1


def test_configurations():
    prices = np.zeros(11)
    prices[[3, 4, 6]] = [2.0, 3.0, 4.9]
    assert best_configuration(prices) == (6, 4)
    plan = Plan({5: 3}, 10)
    plan.fill()
    assert plan.sequences == 2


def test_pieces_are_the_documents(spark, odd_documents, no_documents):
    own = Tokenizer.from_file(PATH)
    packed = pack_documents(odd_documents, PATH, capacity=64, keep_ids=True)
    rows = packed.collect()
    texts = [(r.doc_id, r.text) for r in odd_documents.collect()]
    expected = []
    for doc, text in texts:
        ids = own.encode(text or "", add_special_tokens=False).ids + [0]
        start = 0
        for piece, length in enumerate(cut_lengths(len(ids), 64)):
            part = ids[start : start + length]
            crc = zlib.crc32(np.array(part, "<u4").tobytes())
            expected.append((doc, piece, start, length, crc, part))
            start += length
    plain = [(r.doc_id, r.piece, r.start, r.length, r.ids_crc32, r.ids) for r in rows]
    assert sorted(plain, key=repr) == sorted(expected, key=repr)
    by = {}
    for r in rows:
        by.setdefault(r.sequence_id, []).append((r.offset, r.ids))
    joined = {s: [i for _, ids in sorted(parts) for i in ids] for s, parts in by.items()}
    assert {r.sequence_id: r.ids for r in assemble_sequences(packed).collect()} == joined
    assert max(map(len, joined.values())) <= 64
    assert pack_documents(no_documents, PATH).collect() == []


def test_the_quick_encoder_is_the_tokenizer():
    own, quick = Tokenizer.from_file(PATH), byte_level_encoder(PATH)
    pick = random.Random(2)
    ranges = [(32, 127), (160, 600), (768, 880), (0x4E00, 0x4F00), (0x1F300, 0x1F700), (9, 14), (32, 33)]
    texts = ["".join(chr(pick.randrange(*pick.choice(ranges))) for _ in range(150)) for _ in range(150)]
    for text in [*texts, "<|endoftext|> a", " " * 500 + "x", "a" * 5000]:
        assert quick(text) == own.encode(text, add_special_tokens=False).ids
