"""Token counts by a whole-token shortcut.

A byte-level tokenizer splits a text into pre-tokens and merges the bytes of each on its
own. What a pre-token becomes depends on its bytes alone, so if merging the bytes of a
vocabulary string is proved to end in one token, every pre-token equal to that string is
one token and needs no merging. The proof runs once for the whole vocabulary, before the
job; tasks look pre-tokens up in the proved set and merge only the others, which they
remember within bounds.
"""

from __future__ import annotations

import json
import re
import unicodedata
from collections.abc import Iterator
from functools import lru_cache

import regex
from pyspark.sql import DataFrame
from tokenizers import Tokenizer

from tracemill.llm.batches import map_slices
from tracemill.llm.bpe import Merges, byte_alphabet

LIMIT = 512
# Merged pre-tokens a task remembers before it starts anew, and the longest of them.
REMEMBERED = 400_000
LONGEST_REMEMBERED = 64
# Longer texts are taken apart between words before they are split.
PART = 1 << 20
# Fixed value: how byte-level vocabularies of this family split a text.
WORDS = r"""'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"""
# The same for ASCII texts. Letters stand first: what starts differently can change places.
ASCII_WORDS = r""" ?[A-Za-z]+|'(?:s|t|re|ve|m|ll|d)| ?[0-9]+| ?[^\sA-Za-z0-9]+|\s+(?!\S)|\s+"""


class Described:
    """A byte-level tokenizer file: its merges and the strings it takes out of texts."""

    def __init__(self, path: str) -> None:
        with open(path, encoding="utf-8") as file:
            described = json.load(file)
        model, first = described["model"], described["pre_tokenizer"] or {}
        plain = (
            model["type"] == "BPE"
            and not model.get("dropout")
            and not model.get("end_of_word_suffix")
            and not model.get("continuing_subword_prefix")
            and not described["normalizer"]
            and first.get("type") == "ByteLevel"
            and first.get("use_regex")
            and not first.get("add_prefix_space")
            and not any(t["lstrip"] or t["rstrip"] or t["single_word"] for t in described["added_tokens"])
        )
        if not plain:
            raise ValueError("only byte-level tokenizers without normalizer are supported")
        self.merges = Merges.from_model(model)
        self.unmerged = bool(model.get("ignore_merges"))
        self.marks = sorted((t["content"] for t in described["added_tokens"]), key=len, reverse=True)


@lru_cache
def described(path: str) -> Described:
    """The file at ``path``, read once in every process."""
    return Described(path)


@lru_cache
def whole_tokens(path: str) -> frozenset[str]:
    """The vocabulary strings proved to be one token if they stand alone as a pre-token.

    Each is merged from its bytes by the ranks of the file. Strings that are no valid
    UTF-8 equal no pre-token and are left out. As large as the vocabulary at most.
    """
    file = described(path)
    byte_of = {shown: byte for byte, shown in byte_alphabet().items()}
    proved = set()
    for token in file.merges.ids:
        if not all(c in byte_of for c in token):
            continue
        if file.unmerged or file.merges.encode(token, False) == [token]:
            try:
                proved.add(bytes(byte_of[c] for c in token).decode())
            except UnicodeDecodeError:
                continue
    return frozenset(proved)


class Sizes(dict):
    """Tokens of a pre-token: 1 for the proved ones, merged and remembered otherwise."""

    def __init__(self, whole: frozenset[str], merges: Merges) -> None:
        super().__init__(dict.fromkeys(whole, 1))
        self.whole, self.merges, self.shown = whole, merges, byte_alphabet()

    def __missing__(self, word: str) -> int:
        symbols = word.encode().decode("latin-1").translate(self.shown)
        size = len(self.merges.encode(symbols, False))
        if len(word) <= LONGEST_REMEMBERED:
            if len(self) >= len(self.whole) + REMEMBERED:
                self.clear()
                self.update(dict.fromkeys(self.whole, 1))
            self[word] = size
        return size


def parts(text: str) -> Iterator[str]:
    """A text in parts that split into the same pre-tokens: white space after anything
    else always starts a new one."""
    start = 0
    between = re.compile(r"(?<=\S)(?=\s)", re.ASCII)
    while len(text) - start > PART:
        found = between.search(text, start + PART)
        if not found:
            break
        yield text[start : found.start()]
        start = found.start()
    yield text[start:]


class Counter:
    """Counts tokens of whole texts as the tokenizer file describes them."""

    def __init__(self, path: str, whole: frozenset[str]) -> None:
        file = described(path)
        self.sizes = Sizes(whole, file.merges)
        self.marks = re.compile("(" + "|".join(map(re.escape, file.marks)) + ")") if file.marks else None
        self.ascii, self.any = re.compile(ASCII_WORDS, re.ASCII), regex.compile(WORDS)
        self.splitter = Tokenizer.from_file(path).pre_tokenizer.pre_tokenize_str
        self.byte_of = {shown: byte for byte, shown in byte_alphabet().items()}
        self.assigned: set[str] = set()

    def agreed(self, text: str) -> bool:
        """Whether all characters are ones that libraries class alike.

        Those that Python's own tables leave unassigned may be known to a library with
        tables of another year.
        """
        if self.assigned.issuperset(text):
            return True
        fresh = set(text) - self.assigned
        self.assigned |= {c for c in fresh if unicodedata.category(c) != "Cn"}
        return self.assigned.issuperset(fresh)

    def words(self, text: str) -> list[str]:
        if text.isascii() and not any(c in text for c in "\x1c\x1d\x1e\x1f"):
            return self.ascii.findall(text)
        if self.agreed(text):
            return self.any.findall(text)
        shown = (word for word, _ in self.splitter(text))
        return [bytes(self.byte_of[c] for c in word).decode() for word in shown]

    def count(self, text: str) -> int:
        """Strings of the file's added tokens are one token each, wherever they stand."""
        pieces = self.marks.split(text) if self.marks else [text]
        size = self.sizes.__getitem__
        total = len(pieces) // 2
        for piece in pieces[::2]:
            for part in parts(piece):
                total += sum(map(size, self.words(part)))
        return total


def count_tokens(
    docs: DataFrame, path: str, limit: int = LIMIT, text: str = "text", id_column: str = "doc_id"
) -> DataFrame:
    """``n_bytes, n_tokens, over_limit`` of every whole text.

    ``path`` names a byte-level tokenizer file that every executor can read. Strings of
    its added tokens inside a text count as that token, as its library has it; no token
    is added, nothing is cut. A null or empty text has no byte and no token. Rows are
    counted one by one, copies and rows without id too; an empty table gives an empty
    one, and columns other than the two named are not looked at.
    """
    whole = whole_tokens(path)

    def make():
        counter = Counter(path, whole)

        def step(names, texts):
            sizes = [counter.count(whole_text) if whole_text else 0 for whole_text in texts]
            n_bytes = [len(whole_text.encode()) if whole_text else 0 for whole_text in texts]
            return [names, n_bytes, sizes, [size > limit for size in sizes]]

        return step

    kind = docs.schema[id_column].dataType.simpleString()
    schema = f"`{id_column}` {kind}, n_bytes long, n_tokens long, over_limit boolean"
    return map_slices(docs.select(id_column, text), make, schema)
