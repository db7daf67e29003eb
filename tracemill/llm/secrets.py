"""Secret scans: fixed patterns, and formats inferred from what these find.

Values that the fixed patterns find are labelled credentials. Their prefix tree is
folded into a probabilistic automaton by merging states whose outcomes do not differ
significantly (ALERGIA); a second automaton comes from ordinary tokens. Automata read the
alphabet of each run of letters and digits, so random strings of one format share a path
and its states keep their positions: lengths are learned too. Every token
outside the fixed findings that is as long as a labelled credential may be is then scored
by its likelihood ratio, and reported if the credentials' format explains it better than the
ordinary one and than characters drawn at random.

Automata are learned from bounded samples (``SAMPLE``) and are small; the texts are
scanned where they lie, without a shuffle.
"""

from __future__ import annotations

import hashlib
import heapq
import math
import re
from bisect import bisect_right
from collections.abc import Callable, Iterable, Iterator
from dataclasses import dataclass, field

import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tracemill.llm.batches import map_slices

# The base patterns, their kinds in order, and the shortest matches.
ASSIGN = re.compile(
    r"""(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""",
    re.IGNORECASE | re.ASCII,
)
ASSIGN_WORDS = ("password", "passwd", "secret", "token", "apikey", "api_key")
ACCESS = re.compile(r"AKIA[A-Z0-9]+")
HEX = re.compile(r"[0-9a-f]+")
ASSIGN_LEAST, ACCESS_LEAST, HEX_LEAST = 8, 16, 32
KINDS = ("assign", "access", "hex", "format")
BASE_KINDS = KINDS[:3]

# Tokens the automata judge: all that are long enough for a labelled credential.
LEAST_TOKEN = ASSIGN_LEAST
TOKEN = re.compile(r"(?<![A-Za-z0-9+/_=-])[A-Za-z0-9+/_=-]{%d,}" % LEAST_TOKEN)
# Distinct values of either sort that the automata are learned from, and the longest of them.
SAMPLE = 1000
LONGEST_EXAMPLE = 1000
# Chance of keeping two states apart that are the same.
ALPHA = 0.05
# Natural logarithm of the odds at which a token is reported.
LEAST_ODDS = 3.0
# Strings of character classes whose odds a task remembers, and the longest of them.
REMEMBERED, LONGEST_REMEMBERED = 1 << 16, 64

Span = tuple[int, int, str]


RUN = re.compile(r"[A-Za-z0-9]+")
HEX_LOWER, HEX_UPPER = re.compile(r"[0-9a-f]+"), re.compile(r"[0-9A-F]+")


def alphabet(run: str) -> str:
    """The class of a run of letters and digits, the smallest alphabet that it shows.

    ``d`` digits, ``l`` and ``u`` letters of one case, ``m`` of both; with digits ``h`` and
    ``H`` hexadecimal, ``L`` and ``U`` other letters of one case, ``b`` of both.
    """
    if run.isdigit():
        return "d"
    lower, upper = run.islower(), run.isupper()
    if run.isalpha():
        return "l" if lower else "u" if upper else "m"
    if HEX_LOWER.fullmatch(run):
        return "h"
    if HEX_UPPER.fullmatch(run):
        return "H"
    return "L" if lower else "U" if upper else "b"


def classes_of(word: str) -> str:
    """Each character's class: that of its run, or itself where it stands between runs."""
    return RUN.sub(lambda run: alphabet(run[0]) * len(run[0]), word)


CLASSES = "dluhHmLUb+/_=-."


@dataclass
class State:
    visits: int = 0
    ends: int = 0
    seen: dict[str, int] = field(default_factory=dict)
    next: dict[str, int] = field(default_factory=dict)


def prefix_tree(words: Iterable[str]) -> list[State]:
    states = [State()]
    for word in words:
        at = 0
        for letter in classes_of(word):
            state = states[at]
            state.visits += 1
            state.seen[letter] = state.seen.get(letter, 0) + 1
            if letter not in state.next:
                state.next[letter] = len(states)
                states.append(State())
            at = state.next[letter]
        states[at].visits += 1
        states[at].ends += 1
    return states


def _alike(states: list[State], one: int, other: int, alpha: float) -> bool:
    """No outcome of the two states, or of those behind them, differs significantly."""
    width = math.sqrt(0.5 * math.log(2 / alpha))
    pairs = [(one, other)]
    while pairs:
        left, right = (states[i] for i in pairs.pop())
        bound = width * (left.visits**-0.5 + right.visits**-0.5)
        if bound >= 1:
            continue
        if abs(left.ends / left.visits - right.ends / right.visits) > bound:
            return False
        for letter in left.seen.keys() | right.seen.keys():
            shares = left.seen.get(letter, 0) / left.visits, right.seen.get(letter, 0) / right.visits
            if abs(shares[0] - shares[1]) > bound:
                return False
            if letter in left.next and letter in right.next:
                pairs.append((left.next[letter], right.next[letter]))
    return True


def _fold(states: list[State], into: int, tree: int) -> None:
    """Add the subtree ``tree`` to the state ``into`` and those behind it."""
    pairs = [(into, tree)]
    while pairs:
        into, tree = pairs.pop()
        kept, gone = states[into], states[tree]
        kept.visits += gone.visits
        kept.ends += gone.ends
        for letter, count in gone.seen.items():
            kept.seen[letter] = kept.seen.get(letter, 0) + count
            if letter in kept.next:
                pairs.append((kept.next[letter], gone.next[letter]))
            else:
                kept.next[letter] = gone.next[letter]


def infer_automaton(words: Iterable[str], alpha: float = ALPHA) -> list[State]:
    """A probabilistic automaton from examples, its first state the start."""
    states = prefix_tree(words)
    settled = [0]
    while True:
        known = set(settled)
        open_edges = [
            (-states[states[at].next[letter]].visits, at, letter)
            for at in settled
            for letter in sorted(states[at].next)
            if states[at].next[letter] not in known
        ]
        if not open_edges:
            break
        _, at, letter = min(open_edges)
        child = states[at].next[letter]
        for candidate in settled:
            if _alike(states, candidate, child, alpha):
                states[at].next[letter] = candidate
                _fold(states, candidate, child)
                break
        else:
            settled.append(child)
    place = {old: new for new, old in enumerate(settled)}
    return [
        State(s.visits, s.ends, s.seen, {c: place[n] for c, n in s.next.items()})
        for s in (states[i] for i in settled)
    ]


def log_likelihood(automaton: list[State], classes: str) -> float:
    """Logarithm of the probability of a string of classes, with half a count for the unseen."""
    outcomes = len(CLASSES) + 1
    at, total = 0, 0.0
    for letter in classes:
        if at is None:
            total -= math.log(outcomes)
            continue
        state = automaton[at]
        total += math.log((state.seen.get(letter, 0) + 0.5) / (state.visits + 0.5 * outcomes))
        at = state.next.get(letter)
    if at is None:
        return total - math.log(outcomes)
    return total + math.log((automaton[at].ends + 0.5) / (automaton[at].visits + 0.5 * outcomes))


@dataclass(frozen=True)
class Formats:
    """Automata of credentials and of ordinary tokens; None without examples."""

    credentials: list[State] | None
    ordinary: list[State]

    def odds(self, word: str) -> float:
        return self.class_odds(classes_of(word))

    def class_odds(self, classes: str) -> float:
        if self.credentials is None:
            return -math.inf
        # A token that neither automaton explains, such as a word in capitals, is no credential.
        chance = -(len(classes) + 1) * math.log(len(CLASSES) + 1)
        ordinary = max(log_likelihood(self.ordinary, classes), chance)
        return log_likelihood(self.credentials, classes) - ordinary


def remembering(formats: Formats) -> Callable[[str], float]:
    """``formats.odds``, which depend on the classes of the characters only."""
    known: dict[str, float] = {}

    def odds(word: str) -> float:
        classes = classes_of(word)
        if classes in known:
            return known[classes]
        value = formats.class_odds(classes)
        if len(classes) <= LONGEST_REMEMBERED:
            if len(known) >= REMEMBERED:
                known.clear()
            known[classes] = value
        return value

    return odds


def base_spans(text: str) -> list[Span]:
    """Findings of the fixed patterns, in no order."""
    found = []
    folded = text.lower()
    if any(word in folded for word in ASSIGN_WORDS):
        found += [
            (m.start(), m.end(), "assign")
            for m in ASSIGN.finditer(text)
            if len(m[2]) >= ASSIGN_LEAST
        ]
    if "AKIA" in text:
        found += [
            (m.start(), m.end(), "access")
            for m in ACCESS.finditer(text)
            if m.end() - m.start() >= ACCESS_LEAST
        ]
    return found


def long_tokens(text: str) -> Iterator[tuple[int, int]]:
    return ((m.start(), m.end()) for m in TOKEN.finditer(text))


def untouched(tokens: list[tuple[int, int]], found: list[Span]) -> list[tuple[int, int]]:
    """The tokens that overlap no span."""
    if not found:
        return tokens
    starts, ends = [], []
    for start, end, _ in sorted(found):
        if ends and start <= ends[-1]:
            ends[-1] = max(ends[-1], end)
        else:
            starts.append(start)
            ends.append(end)
    free = []
    for start, end in tokens:
        at = bisect_right(ends, start)
        if at == len(ends) or starts[at] >= end:
            free.append((start, end))
    return free


def scan(text: str) -> tuple[list[Span], list[tuple[int, int]]]:
    """Base spans, and long tokens that touch none of them.

    A run of 32 hexadecimal digits always lies inside a long token, so only those
    are searched for it.
    """
    found, tokens = base_spans(text), []
    for start, end in long_tokens(text):
        if end - start >= HEX_LEAST:
            found += [
                (start + m.start(), start + m.end(), "hex")
                for m in HEX.finditer(text[start:end])
                if m.end() - m.start() >= HEX_LEAST
            ]
        tokens.append((start, end))
    return found, untouched(tokens, found)


def in_order(spans: Iterable[Span]) -> list[Span]:
    return sorted(spans, key=lambda span: (span[0], KINDS.index(span[2])))


def write_spans(spans: Iterable[Span]) -> str:
    return ",".join(f"{kind}:{start}:{end}" for start, end, kind in spans)


def _place(value: str) -> tuple[int, str]:
    """The order of ``xxhash64(value), value`` in Spark."""
    key = xxhash.xxh64_intdigest(value.encode(), 42)
    return (key - (1 << 64) if key >> 63 else key), value


def _examples(docs: DataFrame, text: str, sample: int) -> DataFrame:
    """``labelled, value`` of credentials and ordinary tokens: of either sort the first of every slice."""

    def make():
        def step(texts):
            values = {True: set(), False: set()}
            for whole in texts:
                if not whole:
                    continue
                found, free = scan(whole)
                for start, end, kind in found:
                    value = whole[start:end]
                    if kind == "assign":
                        value = ASSIGN.match(value)[2]
                    values[True].add(value)
                values[False].update(whole[start:end] for start, end in free)
            out = ([], [])
            for labelled, own in values.items():
                first = heapq.nsmallest(sample, (v for v in own if len(v) <= LONGEST_EXAMPLE), key=_place)
                out[0].extend([labelled] * len(first))
                out[1].extend(first)
            return list(out)

        return step

    return map_slices(docs.select(F.col(text)), make, "labelled boolean, value string")


def learn_formats(docs: DataFrame, text: str = "text", sample: int = SAMPLE) -> Formats:
    """Automata from at most ``sample`` distinct values of either sort, by hash.

    Values of more than ``LONGEST_EXAMPLE`` characters are found and scored like all others,
    but not learned from.
    """
    distinct = _examples(docs, text, sample).distinct()
    words = {}
    for labelled in (True, False):
        some = distinct.filter(F.col("labelled") == labelled)
        some = some.orderBy(F.xxhash64("value"), "value").limit(sample)
        words[labelled] = [row.value for row in some.collect()]
    credentials = infer_automaton(words[True]) if words[True] else None
    return Formats(credentials, infer_automaton(words[False]))


def find_spans(
    text: str | None,
    formats: Formats,
    least_odds: float = LEAST_ODDS,
    odds: Callable[[str], float] | None = None,
) -> list[Span]:
    """All spans of a text in order; none for a null text. ``odds`` may remember those of ``formats``."""
    found, free = scan(text or "")
    odds = odds or formats.odds
    scored = ((start, end, odds(text[start:end])) for start, end in free)
    return in_order(found + [(s, e, "format") for s, e, value in scored if value >= least_odds])


def redact(text: str, spans: Iterable[Span], mark: str) -> str:
    """The text with each run of overlapping spans replaced by ``mark``."""
    parts, done, open_until = [], 0, -1
    for start, end, _ in spans:
        if start >= open_until:
            parts += [text[done:start], mark]
            open_until = end
        open_until = done = max(open_until, end)
    return "".join([*parts, text[done:]])


def scan_secrets(
    docs: DataFrame, text: str = "text", id_column: str = "doc_id", formats: Formats | None = None
) -> DataFrame:
    """For every row its counts, the digest of the base spans, and all spans.

    ``n_assign, n_access, n_hex, base_sha256, spans``, positions in code points. A
    null text is empty: no spans, the digest of an empty string. Each row is judged
    by itself, copies and rows without id too. Columns other than the two named are
    not looked at. Without any labelled credential nothing is added to the base.
    """
    learned = formats or learn_formats(docs, text)

    def make():
        odds = remembering(learned)

        def step(ids, texts):
            rows = []
            for name, whole in zip(ids, texts):
                spans = find_spans(whole, learned, odds=odds)
                base = [span for span in spans if span[2] in BASE_KINDS]
                counts = [sum(kind == k for *_, kind in base) for k in BASE_KINDS]
                digest = hashlib.sha256(write_spans(base).encode()).hexdigest()
                rows.append((name, *counts, digest, write_spans(spans)))
            return [list(column) for column in zip(*rows)]

        return step

    kind = docs.schema[id_column].dataType.simpleString()
    schema = (
        f"`{id_column}` {kind}, n_assign long, n_access long, n_hex long, "
        "base_sha256 string, spans string"
    )
    return map_slices(docs.select(id_column, text), make, schema)


def redact_secrets(
    docs: DataFrame, text: str = "text", mark: str = "[secret]", formats: Formats | None = None
) -> DataFrame:
    """``docs`` with the secrets in ``text`` replaced; all other columns unchanged.

    Null texts stay null and empty ones empty; every row is masked by itself, copies too. An
    empty table stays empty.
    """
    learned = formats or learn_formats(docs, text)

    @F.pandas_udf("string")
    def clean(texts):
        odds = remembering(learned)
        return texts.map(
            lambda whole: whole and redact(whole, find_spans(whole, learned, odds=odds), mark),
            na_action="ignore",
        )

    return docs.withColumn(text, clean.asNondeterministic()(F.col(text)))
