"""Repairs against a plain search over all edits, in one block and in many."""

import functools
import hashlib
import random
import re
import zlib
from collections import defaultdict

import pytest

from tracemill.llm import edit_lattice
from tracemill.llm.conversation_repair import Limits, damaged, repair_conversations, repair_report
from tracemill.llm.queries import QUERIES

NOTHING = hashlib.sha256().hexdigest()


def plain_damage(rows):
    """Rows (conv, turn, role, text) after the damage, by the wording of the contract."""
    kept = []
    for conv, turn, role, text in rows:
        role, text = (" " if x is None else x for x in (role, text))
        key = ":".join(" " if x is None else str(x) for x in (conv, turn))
        draw = zlib.crc32(key.encode()) % 20
        text = "" if draw == 1 else re.sub("[.!?]", "", text) if draw == 2 else text
        row = conv, turn, "user" if draw == 4 else role, text
        kept += [] if draw == 0 else [row, row] if draw == 3 else [row]
    return kept


def plain_report(rows):
    """Counts, least cost, least audit and hash of one conversation's rows, by trying all edits."""
    digest = lambda text: hashlib.md5(text.encode()).digest()
    rows = sorted(rows, key=lambda r: (r[1] is not None, r[1] or 0, r[2].encode(), digest(r[3])))
    faults, seen = [], set()
    for _, _, role, text in rows:
        solid = re.sub(r"[\x20\x09-\x0d]+\Z", "", text)
        if not solid:
            faults.append("blank")
        elif (role, text) in seen:
            faults.append("duplicate")
        else:
            faults.append("" if solid[-1] in ".!?" else "truncated")
        seen.add((role, text))
    turns = [r[1] for r in rows if r[1] is not None]
    gaps = max(turns) - min(turns) + 1 - len(set(turns)) if turns else 0
    pairs = [a[2][:1] + b[2][:1] for a, b in zip(rows, rows[1:])]
    follows = {"": ("s", "u"), "s": ("u",), "u": ("a",), "a": ("u",)}
    roles = {"u": "user", "a": "assistant"}

    @functools.cache
    def best(at, last, inserted):
        """The least (cost, audit, turns) from here on."""
        options = []
        if at == len(rows) and last in ("", "a"):
            options.append((0, "", ()))
        steps = []
        for initial in follows[last]:
            if initial in roles and inserted < 3:
                steps.append((5, "I", (roles[initial], ""), at, initial, inserted + 1))
            if at < len(rows) and faults[at] not in ("blank", "duplicate"):
                more = 5 * (faults[at] == "truncated")
                _, _, role, text = rows[at]
                if role[:1] == initial:
                    steps.append((more, "K", (role, text), at + 1, initial, 0))
                if initial in roles:
                    steps.append((1 + more, "R", (roles[initial], text), at + 1, initial, 0))
        if at < len(rows):
            steps.append((2, "D", None, at + 1, last, 0))
        for cost, letter, turn, to, then, count in steps:
            rest = best(to, then, count)
            if rest:
                options.append((cost + rest[0], letter + rest[1], ((turn,) if turn else ()) + rest[2]))
        return min(options, default=None)

    # From the end, so that calls do not go deep.
    for at in range(len(rows), -1, -40):
        for last in follows:
            best(at, last, 0)
    cost, audit, turns_left = best(0, "", 0)
    lines = "\n".join(f"{role}:{text}" for role, text in turns_left)
    counts = (faults.count(name) for name in ("blank", "duplicate", "truncated"))
    illegal = sum(p not in ("su", "ua", "au") for p in pairs)
    return (gaps, *counts, illegal, cost, audit, hashlib.sha256(lines.encode()).hexdigest())


def plain_reports(rows):
    """By conversation, from rows before the damage."""
    groups = defaultdict(list)
    for row in plain_damage(rows):
        groups[row[0]].append(row)
    none = (0, 0, 0, 0, 0, 0, "", NOTHING)
    return {conv: plain_report(groups[conv]) if groups[conv] else none for conv in {r[0] for r in rows}}


def reports(df):
    return {row[0]: tuple(row[1:]) for row in df.collect()}


def random_rows(chance, conversations, longest):
    rows = []
    for conv in [None, *range(conversations)]:
        for _ in range(chance.randrange(1, longest)):
            turn = chance.choice([None, *range(-2, longest)])
            role = chance.choice(["user", "assistant", "user", "assistant", "system", "tool", "", None])
            text = chance.choice(["", " \n", None, "One.", "Two!", "Three", "Four? ", f"{chance.random()}.", "x"])
            rows.append((conv, turn, role, text))
    return rows


def table(spark, rows):
    return spark.createDataFrame(rows, "conv_id long, turn long, role string, text string")


@pytest.mark.parametrize("seed", range(6))
def test_search_finds_the_least_audit(seed):
    chance = random.Random(seed)
    for _ in range(300):
        codes = "".join(chance.choices("suaouaSUAO", k=chance.randrange(11)))
        names = {"s": "system", "u": "user", "a": "assistant", "o": "x"}
        rows = [
            (0, at, names[c.lower()] , f"{at}" + ("" if c.isupper() else ".")) for at, c in enumerate(codes)
        ]
        assert edit_lattice.repair(codes) == plain_report(rows)[5:7]


def test_parts_chain_to_the_whole():
    chance = random.Random(5)
    for _ in range(300):
        codes = "".join(chance.choices("suaouaSUAO", k=chance.randrange(14)))
        cuts = [0, *sorted(chance.randrange(len(codes) + 1) for _ in range(3)), len(codes)]
        parts = [codes[a:b] for a, b in zip(cuts, cuts[1:])]
        sums = [list(edit_lattice.summarize(part)) for part in parts]
        whole = functools.reduce(edit_lattice.chain, sums)
        assert whole == edit_lattice.chain(edit_lattice.chain(*sums[:2]), edit_lattice.chain(*sums[2:]))
        last = edit_lattice.final_exit(whole)
        states = edit_lattice.crossed_states(sums, edit_lattice.START, last)
        audits = [edit_lattice.cheapest(p, a, (b,), False)[1] for p, a, b in zip(parts, states, states[1:])]
        assert "".join(audits) + edit_lattice.TAILS[last] == edit_lattice.repair(codes)[1]


def test_query_equals_plain_search(spark, smallest):
    rows = [tuple(r) for r in spark.read.parquet(f"{smallest}/conversations.parquet").collect()]
    assert reports(QUERIES["op11_edit_lattice"](spark, smallest)) == plain_reports(rows)


@pytest.mark.parametrize("block", [256, 3, 1])
def test_odd_rows_in_blocks_of_any_size(spark, settings, block):
    rows = random_rows(random.Random(block), 40, 14)
    # Conversations that span tasks need many small ones.
    settings(spark__sql__shuffle__partitions=7, spark__sql__adaptive__coalescePartitions__enabled="false")
    df = table(spark, rows).repartition(5)
    assert reports(repair_report(df, Limits(rows=block, fan_bits=2))) == plain_reports(rows)


def test_long_conversation_is_cut_and_turns_are_kept(spark, settings):
    settings(spark__sql__shuffle__partitions=6, spark__sql__adaptive__coalescePartitions__enabled="false")
    roles = ["user", "assistant"]
    rows = [(1, at, roles[at % 2], f"turn {at}.") for at in range(1500)] + [(2, 0, "user", "a."), (2, 1, "x", "b.")]
    found = repair_conversations(damaged(table(spark, rows)), limits=Limits(rows=16, fan_bits=3))
    assert found.found.filter("kind = 'block'").select("task").distinct().count() > 3
    assert reports(found.report()) == plain_reports(rows)
    turns = found.turns().filter("conv = 1").orderBy("block", "place").collect()
    lines = "\n".join(f"{r.role}:{r.text}" for r in turns)
    assert hashlib.sha256(lines.encode()).hexdigest() == plain_reports(rows)[1][7]
    assert [r.edit for r in found.turns().filter("conv = 2").orderBy("place").collect()] == ["K", "R"]
    found.release()


def test_copies_of_one_row_are_spread(spark, settings):
    settings(spark__sql__shuffle__partitions=8, spark__sql__adaptive__coalescePartitions__enabled="false")
    rows = [(7, 7, "user", "the same.")] * 3000 + [(7, 8, "assistant", "well.")]
    found = repair_conversations(table(spark, rows))
    assert found.found.filter("kind = 'block'").select("task").distinct().count() > 3
    row = found.report().first()
    assert (row.duplicate, row.cost, row.illegal, row.gaps) == (2999, 5998, 2999, 0)
    assert row.audit == "K" + "D" * 2999 + "K"


def test_very_long_texts_close_a_block(spark):
    rows = [(conv, at, ("user", "assistant")[at % 2], "long text. " * 300 + f"{at}.") for conv in range(4) for at in range(6)]
    assert reports(repair_report(table(spark, rows), Limits(chars=1000))) == plain_reports(rows)


def test_no_rows_and_clashing_columns(spark):
    empty = table(spark, [])
    assert repair_report(empty).collect() == [] and repair_conversations(empty).turns().count() == 0
    rows = [(1, 0, "user", "Yes."), (1, 1, "assistant", "No.")]
    more = table(spark, rows).selectExpr("*", "1 as kind", "'x' as audit", "2 as conv", "'y' as salt")
    assert reports(repair_report(more)) == plain_reports(rows)
