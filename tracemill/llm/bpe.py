"""BPE encoding by forced boundaries.

A merge joins two neighbouring symbols into a token of the vocabulary. So where two
neighbouring bytes never stand side by side inside any token, no merge can ever cross: a
certain cut. A word is split at its certain cuts, the fragments are encoded one by
one, and the ids are put together again. Fragments are short and come back often,
so each task remembers what it has encoded.

White space is such a cut everywhere, as no token contains any. Texts are therefore
taken apart at white space first, which also lets the tokenizer's normalizer and word
pattern run on one chunk at a time.
"""

from __future__ import annotations

import hashlib
import json
import re
from dataclasses import dataclass

import numpy as np
from pyspark.sql import DataFrame
from tokenizers import Tokenizer

from tracemill.llm.batches import map_slices

# Chunks and fragments a task remembers before it starts anew.
REMEMBERED = 200_000
# Longer chunks are not worth remembering.
LONGEST_REMEMBERED = 64
BLANK_RUN = re.compile(r"[ \t\n\x0b\x0c\r]+")


@dataclass
class Merges:
    """A vocabulary with its merge ranks, and the symbol pairs inside its tokens."""

    ids: dict[str, int]
    ranks: dict[tuple[str, str], int]
    inside: set[str]
    end: str

    @classmethod
    def from_model(cls, model: dict) -> Merges:
        end = model.get("end_of_word_suffix") or ""
        pairs = [tuple(m.split(" ")) if isinstance(m, str) else tuple(m) for m in model["merges"]]
        inside = set()
        for token in model["vocab"]:
            body = token.removesuffix(end) if end else token
            inside.update(body[at : at + 2] for at in range(len(body) - 1))
        return cls(model["vocab"], {pair: rank for rank, pair in enumerate(pairs)}, inside, end)

    def fragments(self, word: str) -> list[str]:
        """The parts of a word between its certain cuts."""
        cuts = [at for at in range(1, len(word)) if word[at - 1 : at + 1] not in self.inside]
        return [word[a:b] for a, b in zip([0, *cuts], [*cuts, len(word)])]

    def encode(self, fragment: str, last: bool) -> list[str]:
        """Tokens of a fragment; ``last`` if it ends a word.

        Always the pair with the lowest rank is merged, the leftmost of equals. Long
        fragments go through a heap, as this takes quadratic time.
        """
        symbols = list(fragment)
        if last and self.end:
            symbols[-1] += self.end
        if len(symbols) > 48:
            return self._merge_long(symbols)
        rank, none = self.ranks.get, 1 << 30
        order = [rank(pair, none) for pair in zip(symbols, symbols[1:])]
        while order:
            best = min(order)
            if best == none:
                break
            at = order.index(best)
            symbols[at] += symbols.pop(at + 1)
            del order[at]
            if at:
                order[at - 1] = rank((symbols[at - 1], symbols[at]), none)
            if at < len(order):
                order[at] = rank((symbols[at], symbols[at + 1]), none)
        return symbols

    def _merge_long(self, symbols: list[str]) -> list[str]:
        from heapq import heapify, heappop, heappush

        after = [*range(1, len(symbols)), -1]
        before = [-1, *range(len(symbols) - 1)]
        ranks = self.ranks
        heap = [
            (rank, i, pair)
            for i, pair in enumerate(zip(symbols, symbols[1:]))
            if (rank := ranks.get(pair)) is not None
        ]
        heapify(heap)
        while heap:
            _, at, pair = heappop(heap)
            right = after[at]
            if symbols[at] != pair[0] or right < 0 or symbols[right] != pair[1]:
                continue
            symbols[at] += symbols[right]
            symbols[right] = ""
            after[at] = after[right]
            if after[at] >= 0:
                before[after[at]] = at
            for left, there in ((before[at], at), (at, after[at])):
                if left >= 0 and there >= 0:
                    fresh = symbols[left], symbols[there]
                    if fresh in ranks:
                        heappush(heap, (ranks[fresh], left, fresh))
        return [s for s in symbols if s]


def byte_alphabet() -> dict[int, str]:
    """What the byte-level alphabet shows each byte as: itself if printable, else a
    character from 256 on, in the order of the bytes."""
    shown = [*range(33, 127), *range(161, 173), *range(174, 256)]
    others = [byte for byte in range(256) if byte not in shown]
    return {b: chr(b) for b in shown} | {b: chr(256 + i) for i, b in enumerate(others)}


# Chunks of these characters only are their own normal form but for upper case, and
# their words are the runs below; all others go through the tokenizer's own steps.
PLAIN = re.compile("[!-~\u00c0-\u00d6\u00d8-\u00f6\u00f8-\u00ff]+")
PLAIN_WORD = re.compile(
    "'s|'t|'re|'ve|'m|'ll|'d|[a-z\u00df-\u00f6\u00f8-\u00ff]+|[0-9]|[^a-z0-9\u00df-\u00f6\u00f8-\u00ff]+"
)
PLAIN_PATTERN = r"'s|'t|'re|'ve|'m|'ll|'d|[\p{L}]+|[\p{N}]|[^\s\p{L}\p{N}]+"

PLAIN_STEPS = ["NFC", "Replace", "Lowercase"]

Piece = tuple[bytes, str]


class Encoder:
    """Ids and decoded text, chunk by chunk, as the tokenizer file describes them."""

    def __init__(self, path: str) -> None:
        with open(path, encoding="utf-8") as file:
            described = json.load(file)
        self.merges = Merges.from_model(described["model"])
        self.tokenizer = Tokenizer.from_file(path)
        if described.get("decoder") or described.get("post_processor"):
            raise ValueError("only tokenizers that join tokens with blanks are supported")
        if not self.merges.end:
            raise ValueError("only tokenizers that mark the ends of words are supported")
        self.packed = {t: i.to_bytes(4, "little") for t, i in self.merges.ids.items()}
        self.special = {t["content"]: t["id"] for t in described["added_tokens"]}
        marks = "|".join(map(re.escape, sorted(self.special, key=len, reverse=True)))
        self.marks = re.compile(f"({marks})") if marks else None
        self.bytes_shown = dict(byte_alphabet())
        steps = described["pre_tokenizer"].get("pretokenizers") or [{}]
        normal = [n["type"] for n in (described["normalizer"] or {}).get("normalizers", [])]
        pattern = steps[0].get("pattern", {}).get("Regex")
        self.plain = normal == PLAIN_STEPS and pattern == PLAIN_PATTERN
        self.known_fragments: dict[tuple[str, bool], Piece] = {}
        self.known_words: dict[str, Piece] = {}
        self.known_chunks: dict[str, Piece] = {}

    def _remember(self, known: dict, key, length: int, found: Piece) -> Piece:
        if length <= LONGEST_REMEMBERED:
            if len(known) >= REMEMBERED:
                known.clear()
            known[key] = found
        return found

    def _fragment(self, fragment: str, last: bool) -> Piece:
        key = fragment, last
        found = self.known_fragments.get(key)
        if found is None:
            packed = self.packed
            tokens = [t for t in self.merges.encode(fragment, last) if t in packed]
            found = b"".join([packed[t] for t in tokens]), " ".join(tokens)
            self._remember(self.known_fragments, key, len(fragment), found)
        return found

    def _word(self, word: str) -> Piece:
        """A word in the byte-level alphabet: its fragments, one after the other."""
        found = self.known_words.get(word)
        if found is None:
            *inner, last = self.merges.fragments(word)
            pieces = [self._fragment(f, False) for f in inner] + [self._fragment(last, True)]
            found = b"".join([p for p, _ in pieces]), " ".join([s for _, s in pieces if s])
            self._remember(self.known_words, word, len(word), found)
        return found

    def _words(self, part: str) -> list[str]:
        if self.plain and PLAIN.fullmatch(part):
            words = PLAIN_WORD.findall(part.lower())
            if part.isascii():
                return words
            return [w.encode().decode("latin-1").translate(self.bytes_shown) for w in words]
        normal = self.tokenizer.normalizer.normalize_str(part)
        return [word for word, _ in self.tokenizer.pre_tokenizer.pre_tokenize_str(normal)]

    def _chunk(self, chunk: str) -> Piece:
        pieces = []
        for part in self.marks.split(chunk) if self.marks else [chunk]:
            if part in self.special:
                pieces.append((self.special[part].to_bytes(4, "little"), part))
            elif part:
                pieces += map(self._word, self._words(part))
        return b"".join([p for p, _ in pieces]), " ".join([s for _, s in pieces if s])

    def encode(self, text: str) -> tuple[bytes, str]:
        """Little-endian 32-bit ids of a text, and the text they decode to."""
        known = self.known_chunks
        ids, shown = [], []
        for chunk in BLANK_RUN.split(text):
            if not chunk:
                continue
            found = known.get(chunk)
            if found is None:
                found = self._remember(known, chunk, len(chunk), self._chunk(chunk))
            ids.append(found[0])
            if found[1]:
                shown.append(found[1])
        return b"".join(ids), " ".join(shown)


def encode_texts(
    docs: DataFrame, path: str, text: str = "text", id_column: str = "doc_id", ids: bool = False
) -> DataFrame:
    """``n_tokens, ids_sha256, decoded_sha256`` of every whole text; ``ids`` if asked.

    Ids and decoding are those of the tokenizer file at ``path``, which every
    executor can read, without special tokens added. A null text is empty: no
    tokens. Rows are encoded one by one, copies and rows without id too. Columns
    other than the two named are not looked at.
    """

    def make():
        encoder = Encoder(path)

        def step(names, texts):
            rows = []
            for name, whole in zip(names, texts):
                packed, shown = encoder.encode(whole or "")
                row = (
                    name,
                    len(packed) // 4,
                    hashlib.sha256(packed).hexdigest(),
                    hashlib.sha256(shown.encode()).hexdigest(),
                )
                rows.append(row + (np.frombuffer(packed, "<u4").tolist(),) if ids else row)
            return [list(column) for column in zip(*rows)]

        return step

    kind = docs.schema[id_column].dataType.simpleString()
    schema = f"`{id_column}` {kind}, n_tokens long, ids_sha256 string, decoded_sha256 string"
    return map_slices(docs.select(id_column, text), make, schema + (", ids array<long>" if ids else ""))
