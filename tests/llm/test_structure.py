"""Conversation repair against every edit string, and the query against its contract written out."""

from __future__ import annotations

import hashlib
import re
import zlib
from itertools import combinations, product

import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from tagloom.llm import structure
from tagloom.llm.catalog import QUERIES

FORM = re.compile(r"(s?(ua)+)?")
BLANK = " \t\n\x0b\f\r"


def play(rows, edits):
    """(cost, turns) that edits leave of (initial or role, text, fault) rows; None if they are no repair."""
    cost, turns, at = 0, [], 0
    for edit in edits:
        wanted = "assistant" if turns and turns[-1][0][:1] == "u" else "user"
        if edit == "I":
            turns.append((wanted, ""))
            cost += 5
            continue
        if at == len(rows):
            return None
        role, text, fault = rows[at]
        at += 1
        if edit == "D":
            cost += 2
            continue
        if fault in ("blank", "duplicate"):
            return None
        cost += (edit == "R") + 5 * (fault == "truncated")
        turns.append((wanted if edit == "R" else role, text))
    if at < len(rows) or not FORM.fullmatch("".join(role[:1] or "-" for role, _ in turns)):
        return None
    return cost, turns


def every_repair(rows, most=2):
    """(cost, audit) of all repairs with at most ``most`` empty turns."""
    for edits in product("DKR", repeat=len(rows)):
        for inserts in range(most + 1):
            for places in combinations(range(len(rows) + inserts), inserts):
                left = iter(edits)
                audit = "".join("I" if k in places else next(left) for k in range(len(rows) + inserts))
                played = play(rows, audit)
                if played:
                    yield played[0], audit


def as_rows(symbols):
    initial = {"s": "system", "u": "user", "a": "assistant", "o": "tool", "d": "user"}
    return [(initial[x.lower()], "t", "blank" if x == "d" else "truncated" if x.isupper() else "") for x in symbols]


@settings(max_examples=150, deadline=None)
@given(st.text(alphabet="suaoUASd", max_size=4))
def test_cheapest_and_first_of_all_repairs(symbols):
    assert structure.solve(symbols) == min(every_repair(as_rows(symbols)))


@settings(max_examples=60, deadline=None)
@given(st.lists(st.tuples(st.sampled_from("suaoUAd"), st.integers(1, 70)), max_size=6))
def test_runs_as_row_by_row(runs):
    symbols = "".join(x * n for x, n in runs)
    cost, audit = structure.solve(symbols)
    assert play(as_rows(symbols), audit)[0] == cost
    behind = [structure.END]
    for x in reversed(symbols):
        behind.append(structure.applied(structure.power(x, 0), behind[-1]))
    assert cost == behind[-1][structure.START]
    # The greedy choice over row-by-row costs is the first audit in ASCII.
    state, made = structure.START, ""
    for x, costs in zip(symbols, reversed(behind[:-1]), strict=True):
        left = structure.applied(structure.power(x, 0), costs)[state]
        kept = structure.kept_state(x, state) if x != "d" else None
        extra = 5 * x.isupper()
        if 2 + costs[state] == left:
            made += "D"
        elif kept is not None and extra + costs[kept] == left:
            made, state = made + "K", kept
        else:
            made, state = made + "R", structure.NEXT[state]
    assert audit == made


def test_binary_powers_are_cached():
    structure.power.cache_clear()
    structure.solve("u" * 100_000)
    assert structure.power.cache_info().currsize <= 18


def slow_repair(rows):
    """Columns of one conversation: (turn, role, text) rows after damage."""
    rows = [(t, " " if r is None else r, " " if x is None else x) for t, r, x in rows]
    rows.sort(key=lambda row: (row[0] is not None, row[0] or 0, row[1], row[2][:100], hashlib.md5(row[2].encode()).digest()))
    seen, plain = set(), []
    for _, role, text in rows:
        last = text.rstrip(BLANK)[-1:]
        fault = "blank" if not last else "duplicate" if (role, text) in seen else "truncated" if last not in ".!?" else ""
        seen.add((role, text))
        plain.append((role, text, fault))
    best: dict = {}  # (row, roles so far as a state) -> least (cost, audit) of the rest, by plain recursion

    def rest(at, state):
        if (at, state) not in best:
            found = [(0, "")] if at == len(plain) and state in "0a" else []
            after = {"0": "u", "s": "u", "u": "a", "a": "u"}[state]
            if at < len(plain):
                role, _, fault = plain[at]
                more = 5 * (fault == "truncated")
                found.append(join((2, "D"), rest(at + 1, state)))
                if fault in ("", "truncated"):
                    found.append(join((1 + more, "R"), rest(at + 1, after)))
                    if role[:1] == after or (role[:1] == "s" and state == "0"):
                        found.append(join((more, "K"), rest(at + 1, role[:1])))
            elif not found:
                found.append(join((5, "I"), rest(at, after)))
            best[at, state] = min(found)
        return best[at, state]

    cost, audit = rest(0, "0")
    turns = [t for t, _, _ in rows if t is not None]
    pairs = zip(plain, plain[1:], strict=False)
    counts = [sum(f == name for _, _, f in plain) for name in ("blank", "duplicate", "truncated")]
    illegal = sum(a[0][:1] + b[0][:1] not in ("su", "ua", "au") for a, b in pairs)
    gaps = max(turns) - min(turns) + 1 - len(set(turns)) if turns else 0
    lines = "\n".join(f"{role}:{text}" for role, text in play(plain, audit)[1])
    return (gaps, *counts, illegal, cost, audit, hashlib.sha256(lines.encode()).hexdigest())


def join(edit, rest):
    return edit[0] + rest[0], edit[1] + rest[1]


def slow_damage(rows):
    made = []
    for conv, turn, role, text in rows:
        role, text = " " if role is None else role, " " if text is None else text
        kind = zlib.crc32(f"{' ' if conv is None else conv}:{' ' if turn is None else turn}".encode()) % 20
        if kind == 1:
            text = ""
        elif kind == 2:
            text = re.sub("[.!?]", "", text)
        elif kind == 4:
            role = "user"
        made += [(conv, turn, role, text)] * (0 if kind == 0 else 2 if kind == 3 else 1)
    return made


def slow_query(rows):
    groups: dict = {conv: [] for conv, *_ in rows}
    for conv, *row in slow_damage(rows):
        groups[conv].append(row)
    return {conv: slow_repair(group) for conv, group in groups.items()}


NAMES = ("gaps", "blank", "duplicate", "truncated", "illegal", "cost", "audit", "repaired_sha256")


def of_query(rows):
    return {r["conv_id"]: tuple(r[name] for name in NAMES) for r in rows}


def test_query_on_the_supplied_table(spark, folder):
    rows = [tuple(r) for r in spark.read.parquet(f"{folder}/conversations.parquet").select("conv_id", "turn", "role", "text").collect()]
    found = QUERIES["op13_structure"](spark, folder).collect()
    assert of_query(found) == slow_query(rows)
    assert len(found) == len({conv for conv, *_ in rows})


TEXTS = ["Yes.", "No?", "well", "well \n", "", " \t", None, "x" * 150 + "a.", "x" * 150 + "b.", "漢字。", "end!\x0b", "é"]
ROLES = ["user", "assistant", "system", None, "", "User", "tool", "agent"]


@pytest.fixture(scope="module")
def odd_rows():
    import random

    rng = random.Random(13)
    rows = [(1, None, None, None), (2, 1, "user", "Yes."), (2, 1, "user", "Yes."), (None, 1, "user", "Yes."), (None, None, "assistant", "No?")]
    for conv in range(3, 60):
        for _ in range(rng.randint(1, 9)):
            rows.append((conv, rng.choice([None, *range(9)]), rng.choice(ROLES[: rng.choice([3, 3, 8])]), rng.choice(TEXTS)))
    for turn in range(700):  # one conversation with most of the rows, many of them alike
        rows.append((99, turn // 3, rng.choice(ROLES[:3]), rng.choice([*TEXTS, f"turn {turn}.", f"turn {turn}!"])))
    return rows


def write(spark, rows, folder):
    extra = [(*row, "clash", 1, False, 2, "u") for row in rows]
    fields = "conv_id bigint, turn bigint, role string, text string, c string, n int, whole boolean, kind int, x string"
    spark.createDataFrame(extra, fields).repartition(7).write.parquet(f"{folder}/conversations.parquet")


def test_query_on_odd_rows(spark, odd_rows, tmp_path):
    write(spark, odd_rows, tmp_path)
    found = QUERIES["op13_structure"](spark, str(tmp_path)).collect()
    assert of_query(found) == slow_query(odd_rows)
    assert len(found) == len({conv for conv, *_ in odd_rows})


def test_small_segments_and_conversations_in_many_parts(spark, odd_rows):
    fields = "conv_id bigint, turn bigint, role string, text string"
    made = structure.repair(spark.createDataFrame(odd_rows, fields).repartition(7), segment_rows=3, part_bits=2)
    assert made.rows.filter("NOT whole").count() > 100
    groups: dict = {}
    for conv, *row in odd_rows:
        groups.setdefault(conv, []).append(row)
    expected = {conv: slow_repair(group) for conv, group in groups.items()}
    audits = made.audits.collect()
    assert {r["conv_id"]: tuple(r[name] for name in NAMES[:-1]) for r in audits} == {c: x[:-1] for c, x in expected.items()}
    shas = structure.repaired_digests(made.rows).collect()
    nothing = hashlib.sha256(b"").hexdigest()
    assert {r["conv_id"]: r["repaired_sha256"] for r in shas} == {c: x[-1] for c, x in expected.items() if x[-1] != nothing}
    assert len(shas) == len({r["conv_id"] for r in shas}) and len(audits) == len(groups)


def test_repaired_rows_are_well_formed(spark, odd_rows):
    rows = spark.createDataFrame(odd_rows, "conv_id bigint, turn bigint, role string, text string")
    made: dict = {}
    for r in structure.repair(rows).rows.orderBy("conv_id", "position", "part").collect():
        made.setdefault(r["conv_id"], []).append(r)
    assert all(FORM.fullmatch("".join(r["role"][:1] for r in turns)) for turns in made.values())
    kept = {(c, "" if x is None else x) for c, _, _, x in odd_rows}
    assert all((conv, r["text"]) in kept or r["edit"] == "I" for conv, turns in made.items() for r in turns)


def test_empty_table(spark):
    rows = spark.createDataFrame([], "conv_id bigint, turn bigint, role string, text string")
    made = structure.repair(rows)
    assert made.audits.collect() == [] and made.rows.collect() == []
    assert structure.repaired_digests(made.rows).collect() == []
