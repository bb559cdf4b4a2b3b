import hashlib
import itertools
import random
import re
import zlib
from functools import lru_cache

import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from kestrel.llm.dialogue import (FINAL, MUST_GO, _apply, advance, damage, repair, repair_report, segment_matrix,
                                  turn_digests, unroll)

SCHEMA = T.StructType([T.StructField("conv_id", T.LongType()), T.StructField("turn", T.LongType()),
                       T.StructField("role", T.StringType()), T.StructField("text", T.StringType())])
SPACE = " \t\n\x0b\x0c\r"
FORM = re.compile(r"(s?(ua)+)?")


def row_hash(role, text):
    return hashlib.sha256(f"{len(role.encode())}:{role}{text}".encode()).digest()


def faults(rows):
    """rows (role, text) in order -> fault of each."""
    seen, out = set(), []
    for role, text in rows:
        if not text.strip(SPACE):
            out.append("blank")
        elif (role, text) in seen:
            out.append("duplicate")
        else:
            out.append("truncated" if text.rstrip(SPACE)[-1] not in ".!?" else "")
        seen.add((role, text))
    return out


def cheapest(rows):
    """(cost, audit, turns) row by row from the last one; no runs, no matrices."""
    marks = faults(rows)

    @lru_cache(maxsize=None)
    def best(i, state, inserted):
        # state: "" / "s" / "u" / "a", the last output letter; at most two inserts in a row can pay
        found = [(0, "")] if i == len(rows) and state in ("", "a") else []
        after = "a" if state == "u" else "u"

        def add(cost, edit, then):
            found.append((cost + then[0], edit + then[1]))

        if inserted < 2:
            add(3, "I", best(i, after, inserted + 1))
        if i < len(rows):
            add(4, "D", best(i + 1, state, 0))
            if marks[i] not in ("blank", "duplicate"):
                more, first = 3 * (marks[i] == "truncated"), rows[i][0][:1]
                add(3 + more, "R", best(i + 1, after, 0))
                if first == after or (first == "s" and state == ""):
                    add(more, "K", best(i + 1, first, 0))
        return min(found, default=(10 ** 9, ""))

    for i in range(len(rows), -1, -1):  # keeps the recursion flat
        for state in ("", "s", "u", "a"):
            cost, audit = best(i, state, 0)
    cost, audit = best(0, "", 0)
    out, left = [], iter(rows)
    for edit in audit:
        role, text = ("", "") if edit == "I" else next(left)
        if edit in "RI":
            role = "assistant" if out and out[-1][0][:1] == "u" else "user"
        if edit != "D":
            out.append((role, text))
    return cost, audit, out


def report(conv_rows):
    """Expected row of repair_report without the id, from damaged rows (turn, role, text)."""
    rows = sorted(conv_rows, key=lambda r: (r[0] is not None, r[0] or 0, row_hash(r[1], r[2])))
    said = [(role, text) for _, role, text in rows]
    marks = faults(said)
    turns = [t for t, _, _ in rows if t is not None]
    gaps = max(turns) - min(turns) + 1 - len(set(turns)) if turns else 0
    illegal = sum((a[0][:1] + b[0][:1]) not in ("su", "ua", "au") for a, b in zip(said, said[1:]))
    cost, audit, out = cheapest(said)
    sha = hashlib.sha256("\n".join(f"{r}:{t}" for r, t in out).encode()).hexdigest()
    return (gaps, *(marks.count(k) for k in ("blank", "duplicate", "truncated")), illegal, cost, audit, sha)


def damaged(rows):
    out = []
    for conv, turn, role, text in rows:
        key = f"{' ' if conv is None else conv}:{' ' if turn is None else turn}"
        role, text = (" " if role is None else role), (" " if text is None else text)
        kind = zlib.crc32(key.encode()) % 20
        text = "" if kind == 1 else re.sub("[.!?]", "", text) if kind == 2 else text
        role = "user" if kind == 4 else role
        out += [(conv, turn, role, text)] * (0 if kind == 0 else 2 if kind == 3 else 1)
    return out


def expected(rows):
    by = {}
    for conv, *_ in rows:
        by[conv] = []
    for conv, turn, role, text in damaged(rows):
        by[conv].append((turn, role, text))
    return {conv: report(v) for conv, v in by.items()}


def test_final_costs():
    assert FINAL == (0, 6, 3, 0)


def enumerate_edits(symbols):
    """Every edit sequence of few inserts, checked against the form by the regular expression."""
    roles, out = "sua-", []
    gaps = [["", "u", "a", "ua", "au"]] * (len(symbols) + 1)
    per_row = []
    for sym in symbols:
        options = [("D", 4, "")]
        if sym != MUST_GO:
            extra = 3 * (sym & 1)
            options += [("R", 3 + extra, "u"), ("R", 3 + extra, "a"), ("K", extra, roles[sym >> 1])]
        per_row.append(options)
    for inserts in itertools.product(*gaps):
        for edits in itertools.product(*per_row):
            text = inserts[0] + "".join(e[2] + i for e, i in zip(edits, inserts[1:]))
            if FORM.fullmatch(text):
                audit = "I" * len(inserts[0]) + "".join(e[0] + "I" * len(i) for e, i in zip(edits, inserts[1:]))
                out.append((sum(e[1] for e in edits) + 3 * audit.count("I"), audit))
    return min(out)


@pytest.mark.parametrize("length", [0, 1, 2, 3])
def test_every_short_sequence_against_enumeration(length):
    for symbols in itertools.product(range(9), repeat=length):
        if length == 3 and hash(symbols) % 7:
            continue
        runs = tuple((s, len(list(g))) for s, g in itertools.groupby(symbols))
        e = unroll(runs)
        assert (e.cost, e.audit) == enumerate_edits(symbols), symbols


def test_powers_equal_single_steps():
    for symbol in range(9):
        v = FINAL
        for n in range(1, 40):
            v = advance(symbol, 1, v)
            assert advance(symbol, n, FINAL) == v == _apply(segment_matrix(((symbol, n),)), FINAL)


def test_long_runs_unroll_like_short_ones():
    rng = random.Random(5)
    for _ in range(60):
        runs = tuple((s, rng.randint(1, 30)) for s, _ in itertools.groupby(rng.choices(range(9), k=6)))
        rows = []
        for i, (s, n) in enumerate(runs):
            for j in range(n):
                role = ("system", "user", "assistant", "tool")[s >> 1] if s < 8 else "user"
                rows.append((role, "" if s == MUST_GO else f"{i} {j}" + ("" if s & 1 else ".")))
        cost, audit, _ = cheapest(rows)
        e = unroll(runs)
        assert (e.cost, e.audit) == (cost, audit)
    big = unroll(((2, 100_000),))  # user turns only: every second one takes the other role
    assert big.cost == 150_000 and len(big.audit) == 100_000 and big.audit.count("R") == 50_000


def random_rows(seed, convs, longest):
    rng = random.Random(seed)
    rows = []
    for c in range(convs):
        n = rng.randint(0, 6) if c else longest
        for t in range(n):
            role = rng.choice(["user", "assistant", "user", "assistant", "system", None, "tool", ""])
            text = rng.choice([None, "", " \n", "hello.", "cut off", "what?", f"text {t}!", "é\x0b", "same.", "Ä…"])
            turn = None if rng.random() < 0.03 else t + (rng.random() < 0.05)
            rows.append((c if c < convs - 1 else None, turn, role, text))
    return rows


def test_report_equals_brute_force(spark):
    rows = random_rows(1, 120, 150)
    rows += rows[:40]
    df = spark.createDataFrame(rows, SCHEMA).repartition(5)
    got = {r[0]: tuple(r)[1:] for r in repair_report(df).collect()}
    assert got == expected(rows)


def test_a_conversation_over_many_partitions(spark):
    rng = random.Random(9)
    rows = [(7, t, rng.choice(["user", "assistant"]), rng.choice(["a.", "b", "", f"{t}.", f"{t}"])) for t in range(3000)]
    df = spark.createDataFrame(rows, SCHEMA)
    want = report([(t, r, x) for _, t, r, x in rows])
    for by_conversation in (True, False):
        got = repair(df, by_conversation=by_conversation)
        row = got.audits.collect()
        assert len(row) == 1 and tuple(row[0])[1:] == want[:-1]
        # range partitions come in order of their number: the turns of one conversation are spread
        turns = got.turns.withColumn("p", F.spark_partition_id()).collect()
        assert (len({t["p"] for t in turns}) > 1) != by_conversation
        lines = "\n".join(f"{t['role']}:{t['text']}" for t in turns)
        assert hashlib.sha256(lines.encode()).hexdigest() == want[-1]
    assert turn_digests(repair(df).turns).collect()[0]["sha"] == want[-1]


def test_edges(spark):
    empty = spark.createDataFrame([], SCHEMA)
    assert repair_report(empty).count() == 0
    rows = [(1, 0, "user", "x" * 300_000 + "."), (1, 1, "assistant", "y."), (2, None, None, None), (3, 5, "system", "s."),
            (None, None, "user", "a?")] + [(4, 1, "user", "same.")] * 500
    df = spark.createDataFrame(rows, SCHEMA)
    for name in ("conv", "h", "tag", "pid", "local", "audit", "kind", "copy"):
        df = df.withColumn(name, F.lit("x"))
    got = {r[0]: tuple(r)[1:] for r in repair_report(df).collect()}
    assert got == expected(rows)
    one = next(c for c in range(10_000) if zlib.crc32(f"{c}:0".encode()) % 20 == 0)
    gone = repair_report(spark.createDataFrame([(one, 0, "user", "hi.")], SCHEMA)).collect()
    assert [tuple(r) for r in gone] == [(one, 0, 0, 0, 0, 0, 0, "", hashlib.sha256(b"").hexdigest())]


def test_damage_keeps_whole_rows(spark):
    rows = random_rows(3, 40, 20)
    got = sorted(map(tuple, damage(spark.createDataFrame(rows, SCHEMA)).collect()), key=repr)
    assert got == sorted(damaged(rows), key=repr)
