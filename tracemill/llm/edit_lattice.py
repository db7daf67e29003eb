"""Cheapest edits of a conversation, by a bidirectional Dijkstra search.

A conversation is a string of codes, one for each row that need not go: the initial of its
role (``s``, ``u``, ``a``, ``o`` for any other), in upper case if its text is truncated.
Nodes of the lattice are pairs of rows read and a state of the wanted order ``(s?(ua)+)?``;
edits are edges, named by the letter that the audit shows.

What an edit does follows from its letter and the state, so an audit says all about a
repair, and of two paths to one node at equal cost neither's audit begins with the other's.
The least audit of a path therefore consists of least audits of its parts.
"""

from __future__ import annotations

from functools import lru_cache
from heapq import heappop, heappush

# States: nothing yet, after the system's turn, after the user's, after the assistant's.
START, SYSTEM, USER, ASSISTANT = STATES = range(4)
# The cost of each edit, and of keeping a truncated text in any way.
REROLE, DELETE, INSERT, TRUNCATED = 1, 2, 5, 5
# The state after a row that keeps its role, by its initial.
KEPT = {
    "s": {START: SYSTEM},
    "u": {START: USER, SYSTEM: USER, ASSISTANT: USER},
    "a": {USER: ASSISTANT},
    "o": {},
}
# The state after a row that is inserted or whose role is set.
SET = {START: USER, SYSTEM: USER, USER: ASSISTANT, ASSISTANT: USER}
SET_FROM = {state: [s for s in STATES if SET[s] == state] for state in STATES}
ROLE_OF = {USER: "user", ASSISTANT: "assistant"}
# States in which a conversation may end, and the insertions that lead there.
ENDS = (START, ASSISTANT)
TAILS = {START: "", SYSTEM: "II", USER: "I", ASSISTANT: ""}

Found = tuple[int, str]


def row_edges(code: str, state: int) -> list[tuple[int, str, int]]:
    """Cost, letter and next state of the edits that read a row."""
    extra = TRUNCATED if code.isupper() else 0
    edges = [(DELETE, "D", state), (REROLE + extra, "R", SET[state])]
    kept = KEPT[code.lower()].get(state)
    return edges if kept is None else [(extra, "K", kept), *edges]


EDGES = {code: {state: row_edges(code, state) for state in STATES} for code in "suaoSUAO"}
EDGES_TO = {
    code: {
        state: [(cost, letter, s) for s in STATES for cost, letter, to in EDGES[code][s] if to == state]
        for state in STATES
    }
    for code in EDGES
}


def cheapest(codes: str, entry: int, exits: tuple[int, ...], tail: bool) -> Found | None:
    """The least cost from ``entry`` to one of ``exits``, and the least audit at that cost.

    ``tail`` tells whether rows may be inserted behind the last one. None if no edits lead
    there. Both heaps are kept in the order of cost, then rows read, then audit, so a node's
    first turn has its final cost and audit. An edge or node that both sides have reached
    is a crossing. The search ends once no open path can be as cheap as the best
    crossing, so all crossings of that cost have been compared.
    """
    size = len(codes)
    ahead: dict[tuple[int, int], Found] = {}
    back: dict[tuple[int, int], Found] = {}
    forward = [(0, 0, "", entry)]
    reverse = [(0, 0, "", state) for state in sorted(exits)]
    best: Found | None = None
    reached = [0, 0]
    while forward or reverse:
        if forward:
            reached[0] = forward[0][0]
        if reverse:
            reached[1] = reverse[0][0]
        if best and sum(reached) > best[0]:
            break
        if not reverse or forward and reached[0] <= reached[1]:
            cost, at, audit, state = heappop(forward)
            if (at, state) in ahead:
                continue
            ahead[at, state] = cost, audit
            steps = [(at + 1, *edge) for edge in EDGES[codes[at]][state]] if at < size else []
            if at < size or tail:
                steps.append((at, INSERT, "I", SET[state]))
            crossings = [(0, "", back.get((at, state)))]
            for place, more, letter, to in steps:
                crossings.append((more, letter, back.get((place, to))))
                if (place, to) not in ahead:
                    heappush(forward, (cost + more, place, audit + letter, to))
            for more, letter, rest in crossings:
                if rest:
                    found = cost + more + rest[0], audit + letter + rest[1]
                    best = min(best or found, found)
        else:
            cost, left, audit, state = heappop(reverse)
            at = size - left
            if (at, state) in back:
                continue
            back[at, state] = cost, audit
            steps = [(at - 1, *edge) for edge in EDGES_TO[codes[at - 1]][state]] if at else []
            if at < size or tail:
                steps += [(at, INSERT, "I", s) for s in SET_FROM[state]]
            crossings = [(0, "", ahead.get((at, state)))]
            for place, more, letter, before in steps:
                crossings.append((more, letter, ahead.get((place, before))))
                if (place, before) not in back:
                    heappush(reverse, (cost + more, size - place, letter + audit, before))
            for more, letter, first in crossings:
                if first:
                    found = first[0] + more + cost, first[1] + letter + audit
                    best = min(best or found, found)
    return best


@lru_cache(maxsize=50_000)
def repair(codes: str) -> Found:
    """Cost and audit of a whole conversation."""
    return cheapest(codes, START, ENDS, True)


# A part of a conversation by the states it is entered and left in: the cost, and the place of
# its audit among those from the same state. None where there is no way.
Summary = list[tuple[int, int] | None]


@lru_cache(maxsize=5_000)
def summarize(codes: str) -> tuple[tuple[int, int] | None, ...]:
    """All ways through a part. Its audits end with a row's letter, so none begins with another."""
    ways: Summary = [None] * 16
    for entry in STATES:
        found = {exit_: cheapest(codes, entry, (exit_,), False) for exit_ in STATES}
        audits = sorted(way[1] for way in found.values() if way)
        for exit_, way in found.items():
            if way:
                ways[4 * entry + exit_] = way[0], audits.index(way[1])
    return tuple(ways)


def _joined(first: Summary, second: Summary, entry: int, exit_: int) -> tuple[int, int, int, int] | None:
    """Least cost, ranks of both audits, and the state between."""
    ways = []
    for middle in STATES:
        one, two = first[4 * entry + middle], second[4 * middle + exit_]
        if one and two:
            ways.append((one[0] + two[0], one[1], two[1], middle))
    return min(ways, default=None)


def chain(first: Summary, second: Summary) -> Summary:
    """The summary of two parts, one behind the other."""
    ways: Summary = [None] * 16
    for entry in STATES:
        found = {exit_: _joined(first, second, entry, exit_) for exit_ in STATES}
        ranks = sorted(way[1:3] for way in found.values() if way)
        for exit_, way in found.items():
            if way:
                ways[4 * entry + exit_] = way[0], ranks.index(way[1:3])
    return ways


def final_exit(summary: Summary) -> int:
    """The state in which a whole conversation's rows are best left."""
    ways = [
        (way[0] + INSERT * len(TAILS[exit_]), way[1], exit_)
        for exit_ in STATES
        if (way := summary[4 * START + exit_])
    ]
    return min(ways)[2]


def crossed_states(parts: list[Summary], entry: int, exit_: int) -> list[int]:
    """The states between consecutive parts on the way from ``entry`` to ``exit_``, both included."""
    # The best way on from each state in front of a part: cost, then the audits' order by
    # the first part that differs, which is that part's rank.
    onward = {exit_: (0, None)}
    choices = []
    for part in reversed(parts):
        before = {}
        for state in STATES:
            ways = [
                (way[0] + onward[to][0], way[1], to)
                for to in onward
                if (way := part[4 * state + to])
            ]
            if ways:
                cost, _, to = min(ways)
                before[state] = cost, to
        choices.append(before)
        onward = before
    states = [entry]
    for choice in reversed(choices):
        states.append(choice[states[-1]][1])
    return states
