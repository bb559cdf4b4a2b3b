"""Conversation structure repair by a run-length dynamic programme.

A conversation is a sequence of symbols, one a row: the row's role and its fault. Equal
consecutive symbols are one run. Over four states (nothing yet, after the system turn, after
a user turn, after an assistant turn) a symbol is a min-plus matrix: entry (p, q) is the
least cost of taking its row, and any turns inserted before it, from p to q. A run of n
symbols advances a vector of costs by the cached binary powers of its matrix; the edits are
then unrolled forwards, halving each run by the same powers, taking the ASCII-least edit
that keeps the cost least.

Distributed form: rows are reduced to keys (conversation, turn, hash of role and text) with
counts and put in order by ranges, so a conversation that holds a third of all rows lies in
many partitions. Each partition's part of a conversation is a segment. Only a segment at a
partition's border can belong to a conversation that goes on elsewhere: its product of
matrices gives the cost vector behind every segment (from the last one back), then its map
from entry state to exit state gives the entry state of every segment (from the first one
on). At most two segments a partition take part in that. Texts move once, beside the edits.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import lru_cache
from typing import NamedTuple

import numpy as np
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import store

SPACE = " \t\n\x0b\x0c\r"

#: Costs of the edits; an undeleted truncated row costs ``TRUNCATED`` more.
REROLE, DELETE, INSERT, TRUNCATED = 3, 4, 3, 3
FAR = 1 << 60
#: States: nothing yet, after system, after user, after assistant. NEXT: after one more user/assistant turn.
NEXT, ENDS = (2, 2, 3, 2), (0, 3)
ROLE = {1: "system", 2: "user", 3: "assistant"}
#: State after keeping a row of role class s, u, a, other in each state (-1: not allowed).
KEPT = ((1, -1, -1, -1), (2, 2, -1, 2), (-1, -1, 3, -1), (-1, -1, -1, -1))
#: Symbols: 2 * role class + truncated, and the row that has to go.
MUST_GO = 8
LEGAL = {(0, 1), (1, 2), (2, 1)}
MEMO_ROWS = 64

Vector = tuple[int, int, int, int]


def _times(a: tuple, b: tuple) -> tuple:
    return tuple(tuple(min(a[p][k] + b[k][q] for k in range(4)) for q in range(4)) for p in range(4))


def _apply(m: tuple, v: Vector) -> Vector:
    return tuple(min(m[p][q] + v[q] for q in range(4)) for p in range(4))


def _inserts() -> tuple:
    one = [[FAR] * 4 for _ in range(4)]
    for p in range(4):
        one[p][p] = 0
        one[p][NEXT[p]] = INSERT
    m = tuple(map(tuple, one))
    return _times(m, m)


INSERTS = _inserts()
#: Least cost from each state to an end when no row is left.
FINAL: Vector = _apply(INSERTS, tuple(0 if q in ENDS else FAR for q in range(4)))


def _choices(symbol: int, state: int) -> list[tuple[str, int, int]]:
    """(edit, cost, state after) of one row, by the edit's letter."""
    out = [("D", DELETE, state)]
    if symbol != MUST_GO:
        extra = TRUNCATED * (symbol & 1)
        kept = KEPT[symbol >> 1][state]
        if kept >= 0:
            out.append(("K", extra, kept))
        out.append(("R", REROLE + extra, NEXT[state]))
    return out


@lru_cache(maxsize=None)  # 9 symbols x at most 63 powers
def power(symbol: int, k: int) -> tuple:
    """The min-plus matrix of 2**k equal symbols, inserts before each row included."""
    if k:
        half = power(symbol, k - 1)
        return _times(half, half)
    row = [[FAR] * 4 for _ in range(4)]
    for p in range(4):
        for _, cost, q in _choices(symbol, p):
            row[p][q] = min(row[p][q], cost)
    return _times(INSERTS, tuple(map(tuple, row)))


def advance(symbol: int, n: int, v: Vector) -> Vector:
    """Costs before a run of ``n`` symbols from the costs ``v`` behind it."""
    k = 0
    while n:
        if n & 1:
            v = _apply(power(symbol, k), v)
        n, k = n >> 1, k + 1
    return v


def segment_matrix(runs) -> tuple:
    """Min-plus product of a segment's runs."""
    total = tuple(tuple(0 if p == q else FAR for q in range(4)) for p in range(4))
    for symbol, n in runs:
        k = 0
        while n:
            if n & 1:
                total = _times(total, power(symbol, k))
            n, k = n >> 1, k + 1
    return total


class Edits(NamedTuple):
    audit: str
    cost: int
    state: int
    turns: list  # (row number, edit, state after) of each turn that stays or is inserted


def unroll(runs: tuple, state: int = 0, behind: Vector = FINAL, closing: bool = True) -> Edits:
    """The cheapest edits of a segment entered in ``state`` with costs ``behind`` it; ties ASCII-least.

    Runs may end in the middle of a conversation; ``closing`` says that nothing follows.
    """
    after = [behind]
    for symbol, n in reversed(runs):
        after.append(advance(symbol, n, after[-1]))
    after.reverse()
    audit, turns, cost, row = [], [], 0, 0

    def step(symbol: int, v: Vector) -> None:
        nonlocal state, cost, row
        here = _apply(power(symbol, 0), v)
        while True:
            left = here[state]
            options = [*_choices(symbol, state), ("I", INSERT, -1)]
            edit, spent, to = min((e, c, q) for e, c, q in options
                                  if c + (here[NEXT[state]] if e == "I" else v[q]) == left)
            audit.append(edit)
            cost += spent
            state = NEXT[state] if edit == "I" else to
            if edit != "D":
                turns.append((row, edit, state))
            if edit != "I":
                row += 1
                return

    # Each entry is a run still to go and the costs behind it; halves of a run are split off on demand.
    for i, (symbol, n) in enumerate(runs):
        todo = [(n, after[i + 1])]
        while todo:
            n, v = todo.pop()
            if n == 1:
                step(symbol, v)
            else:
                first = 1 << ((n - 1).bit_length() - 1)
                todo += [(n - first, v), (first, advance(symbol, n - first, v))]
    while closing and state not in ENDS:
        state = NEXT[state]
        audit.append("I")
        cost += INSERT
        turns.append((row, "I", state))
    return Edits("".join(audit), cost, state, turns)


_remembered = lru_cache(maxsize=1 << 14)(unroll)


def _edits(runs: tuple, state: int, behind: Vector, closing: bool) -> Edits:
    short = sum(n for _, n in runs) <= MEMO_ROWS
    return (_remembered if short else unroll)(runs, state, behind, closing)


class _Segment:
    """Collapses the rows of one segment, read one after the other, to runs of equal symbols."""

    def __init__(self, pid: int, conv, lo: int, cls: int):
        self.pid, self.conv, self.lo, self.first, self.last = pid, conv, lo, cls, None
        self.symbols, self.counts, self.copies = [], [], []
        self.blank = self.duplicate = self.truncated = self.illegal = 0

    def add(self, cls: int, blank: bool, cut: int, n: int, first: bool) -> None:
        """``n`` equal rows of a role class; ``first``: their role and text were not seen before."""
        if blank:
            self.blank += n
            self._run(MUST_GO, n)
        else:
            self.duplicate += n - first
            if first:
                self.truncated += cut
                self._run(2 * cls + cut, 1)
            self._run(MUST_GO, n - first)
        self.illegal += n - 1 + (self.last is not None and (self.last, cls) not in LEGAL)
        self.last = cls
        self.copies.append(n)

    def _run(self, symbol: int, n: int) -> None:
        if n and self.symbols and self.symbols[-1] == symbol:
            self.counts[-1] += n
        elif n:
            self.symbols.append(symbol)
            self.counts.append(n)

    def row(self, edge: bool) -> tuple:
        copies = self.copies if max(self.copies) > 1 else None
        return (self.pid, self.conv, self.lo, edge, self.symbols, self.counts, copies, self.blank, self.duplicate,
                self.truncated, self.illegal, self.first, self.last)


def _segments(conv_type: str):
    """Ordered rows (pid, conv, local, class, blank, cut, n, first) -> one row a segment; and its schema."""
    def run(batches: Iterator) -> Iterator:
        import pyarrow as pa

        listed = pa.list_(pa.int64())
        types = [pa.int64(), None, pa.int64(), pa.bool_(), pa.list_(pa.int32()), listed, listed, *[pa.int64()] * 4,
                 pa.int32(), pa.int32()]
        names = ["pid", "conv", "lo", "edge", "symbols", "counts", "copies", "blank", "duplicate", "truncated",
                 "illegal", "first_class", "last_class"]
        done, held, before = [], None, None  # before: partition number of the segment closed last

        def emit():
            columns = list(zip(*done, strict=True))
            done.clear()
            return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(columns, types, strict=True)], names)

        for batch in batches:
            types[1] = batch.schema.field(1).type
            for pid, conv, local, cls, blank, cut, n, first in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                if held is None or held.pid != pid or held.conv != conv:
                    if held is not None:
                        done.append(held.row(before != held.pid or pid != held.pid))
                        before = held.pid
                    held = _Segment(pid, conv, local, cls)
                held.add(cls, blank, cut, n, first)
            if len(done) > 4096:
                yield emit()
        if held is not None:
            done.append(held.row(True))
            yield emit()
    return run, (f"pid long, conv {conv_type}, lo long, edge boolean, symbols array<int>, counts array<long>, "
                 "copies array<long>, blank long, duplicate long, truncated long, illegal long, first_class int, "
                 "last_class int")


def _runs_of(row) -> tuple:
    return tuple(zip(row["symbols"], row["counts"], strict=True))


def _matrices(batches: Iterator) -> Iterator:
    """Border segments -> their min-plus products, 16 entries."""
    import pyarrow as pa

    for batch in batches:
        flat = [[x for line in segment_matrix(_runs_of(r)) for x in line] for r in batch.to_pylist()]
        yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), batch.column(2),
                                          pa.array(flat, pa.list_(pa.int64()))], ["pid", "lo", "conv", "matrix"])


def _costs_behind(pdf):
    """Segments of one conversation -> the costs behind each; nothing for a conversation of one segment."""
    import pandas as pd

    pdf = pdf.sort_values("pid", ascending=False)
    rows, v = [], FINAL
    if len(pdf) > 1:
        for pid, lo, flat in zip(pdf["pid"], pdf["lo"], pdf["matrix"], strict=True):
            rows.append((pid, lo, list(v), not rows))
            v = _apply(tuple(tuple(int(x) for x in flat[4 * p:4 * p + 4]) for p in range(4)), v)
    return pd.DataFrame(rows, columns=["pid", "lo", "behind", "closing"])


def _exits(batches: Iterator) -> Iterator:
    """Border segments with the costs behind them -> the exit state for each entry state."""
    import pyarrow as pa

    for batch in batches:
        rows = batch.to_pylist()
        exits = [[_edits(_runs_of(r), s, tuple(r["behind"]), r["closing"]).state for s in range(4)] for r in rows]
        yield pa.RecordBatch.from_arrays(
            [batch.column(c) for c in range(5)] + [pa.array(exits, pa.list_(pa.int32()))],
            ["pid", "lo", "conv", "first_class", "last_class", "exits"])


def _entries(pdf):
    """Segments of one conversation -> the entry state of each, and whether its border is an illegal pair."""
    import pandas as pd

    pdf = pdf.sort_values("pid")
    rows, state, last = [], 0, None
    for pid, lo, first, end, exits in zip(pdf["pid"], pdf["lo"], pdf["first_class"], pdf["last_class"], pdf["exits"],
                                          strict=True):
        rows.append((pid, lo, state, int(last is not None and (last, first) not in LEGAL)))
        state, last = int(exits[state]), end
    return pd.DataFrame(rows, columns=["pid", "lo", "entry", "border"])


def _unrolled(batches: Iterator) -> Iterator:
    """Segments -> audit, cost and turns (key row, place beside it, edit, role) of each."""
    import pyarrow as pa

    names = ["local", "tag", "place", "edit", "role"]
    types = [pa.int64(), pa.int32(), pa.int64(), pa.string(), pa.string()]
    for batch in batches:
        audits, costs, ends, flat = [], [], [0], []
        for r in batch.to_pylist():
            closing = r["closing"] is None or r["closing"]
            behind = FINAL if r["behind"] is None else tuple(r["behind"])
            e = _edits(_runs_of(r), r["entry"] or 0, behind, closing)
            audits.append(e.audit)
            costs.append(e.cost)
            keys = sum(r["counts"]) if r["copies"] is None else len(r["copies"])
            before = None if r["copies"] is None else np.cumsum(r["copies"])
            for place, (row, edit, state) in enumerate(e.turns):
                key = row if before is None else int(np.searchsorted(before, row, side="right"))
                tag = 1 if edit != "I" else 0 if key < keys else 3
                flat.append((r["lo"] + min(key, keys - 1), tag, place, edit, ROLE[state] if edit != "K" else None))
            ends.append(len(flat))
        columns = list(zip(*flat, strict=True)) if flat else [[]] * 5
        items = pa.StructArray.from_arrays([pa.array(c, t) for c, t in zip(columns, types, strict=True)], names)
        yield pa.RecordBatch.from_arrays(
            [batch.column(0), batch.column(1), batch.column(2), pa.array(audits, pa.string()),
             pa.array(costs, pa.int64()), pa.ListArray.from_arrays(pa.array(ends, pa.int32()), items)],
            ["pid", "lo", "conv", "audit", "cost", "turns"])


def _joined_turns(batches: Iterator) -> Iterator:
    """Sorted edits (tag 0 insert, 1 keep or rerole, 3 insert at the end) and texts (tag 2) -> repaired turns."""
    import pyarrow as pa

    expected, new_role = False, None  # the row before was an edit that keeps the text that follows
    for batch in batches:
        tag = batch.column(1).to_numpy()
        roles, texts = batch.column(4), batch.column(5)
        before = np.empty(len(tag), bool)
        if not len(tag):
            continue
        before[0], before[1:] = expected, tag[:-1] == 1
        shown = (tag == 0) | (tag == 3) | ((tag == 2) & before)
        at = np.flatnonzero(shown)
        edits, own = batch.column(3).to_pylist(), roles.to_pylist()
        out_edit, out_role = [], []
        for i in at.tolist():
            if tag[i] != 2:
                out_edit.append("I")
                out_role.append(own[i])
            else:
                given = own[i - 1] if i else new_role
                out_edit.append("K" if given is None else "R")
                out_role.append(given or own[i])
        expected, new_role = bool(tag[-1] == 1), own[-1]
        take = pa.array(at)
        yield pa.RecordBatch.from_arrays(
            [batch.column(0).take(take), batch.column(2).take(take), pa.array(out_edit, pa.string()),
             pa.array(out_role, pa.string()), texts.take(take)], ["conv", "turn", "edit", "role", "text"])


class Repair(NamedTuple):
    """Result of ``repair``: ``audits`` one row a conversation, ``turns`` the repaired turns."""
    audits: DataFrame
    turns: DataFrame


def _keyed(rows: DataFrame, conv_col: str, turn_col: str, role_col: str, text_col: str) -> DataFrame:
    def said(c: str) -> Column:
        return F.coalesce(rows[c].cast("string"), F.lit(" "))

    role, text = said(role_col), said(text_col)
    h = F.unhex(F.sha2(F.concat(F.octet_length(role).cast("string"), F.lit(":"), role, text).cast("binary"), 256))
    return rows.select(rows[conv_col].alias("conv"), rows[turn_col].cast("long").alias("turn"), role.alias("role"),
                       text.alias("text"), h.alias("h"))


def repair(rows: DataFrame, conv_col: str = "conv_id", turn_col: str = "turn", role_col: str = "role",
           text_col: str = "text", by_conversation: bool = True) -> Repair:
    """The cheapest edits that give every conversation the form (system? (user assistant)+)?.

    A row's first fault counts: blank (nothing but white space), duplicate (role and text seen
    earlier in the conversation), truncated (the last character other than white space is not
    ``.``, ``!`` or ``?``). Edits: Keep 0, Rerole 3, Delete 4 (the only one for blank rows and
    duplicates), Insert of an empty turn 3; a truncated row that stays costs 3 more. A role
    counts by its first letter; a role that begins with none of s, u, a is never kept.

    ``audits``: conv, gaps, blank, duplicate, truncated, illegal, cost, audit. ``turns``: conv,
    turn (of an inserted turn: the row it stands beside), edit (K, R or I), role, text. The turns
    of a conversation lie in order in one partition, as a digest over them needs; with
    ``by_conversation=False`` they are ordered by ranges, so a hot conversation is spread.

    Null roles and texts count as one space, null turns come first, null conversations are one
    conversation. Rows that tie on the turn are ordered by the SHA-256 of their role and text, so
    repeated rows stand together. An empty table gives empty results. Texts of any length are
    read whole, conversations of any length are split. Extra columns are ignored.
    """
    said = _keyed(rows, conv_col, turn_col, role_col, text_col)
    conv_type = said.schema["conv"].dataType.simpleString()
    end = F.rtrim("text", F.lit(SPACE))
    first = F.substring("role", 1, 1)
    cls = F.when(first == "s", 0).when(first == "u", 1).when(first == "a", 2).otherwise(3)
    keys = (said.select("conv", "turn", "h", cls.alias("cls"), (end == "").alias("blank"),
                        (~F.right(end, F.lit(1)).isin(".", "!", "?")).cast("int").alias("cut"))
            .groupBy("conv", "turn", "h", "cls", "blank", "cut").agg(F.count(F.lit(1)).alias("n")))
    width = int(rows.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    # Written once: a range partitioning that is computed again may cut elsewhere.
    placed = store(keys.repartitionByRange(width, "conv", "turn", "h").sortWithinPartitions("conv", "turn", "h")
                   .withColumn("pid", F.spark_partition_id().cast("long"))
                   .withColumn("local", F.monotonically_increasing_id() - F.shiftleft("pid", 33)), "turn-keys")
    firsts = (placed.where("not blank").groupBy("conv", "h").agg(F.min(F.struct("pid", "local")).alias("at"))
              .select("at.pid", "at.local", F.lit(True).alias("first")))
    flagged = placed.join(firsts, ["pid", "local"], "left").select(
        "pid", "conv", "local", "cls", "blank", "cut", "n", F.coalesce("first", F.lit(False)).alias("first"))
    run, schema = _segments(conv_type)
    segments = store(flagged.repartition("pid").sortWithinPartitions("pid", "local").mapInArrow(run, schema), "segments")

    own = ["pid", "lo", "conv"]
    edges = segments.where("edge")
    behind = store(edges.select(*own, "symbols", "counts")
                   .mapInArrow(_matrices, f"pid long, lo long, conv {conv_type}, matrix array<long>")
                   .groupBy("conv").applyInPandas(_costs_behind, "pid long, lo long, behind array<long>, closing boolean"),
                   "costs-behind")
    entries = store(edges.join(behind, ["pid", "lo"])
                    .select(*own, "first_class", "last_class", "symbols", "counts", "behind", "closing")
                    .mapInArrow(_exits, f"pid long, lo long, conv {conv_type}, first_class int, last_class int, "
                                        "exits array<int>")
                    .groupBy("conv").applyInPandas(_entries, "pid long, lo long, entry int, border int"), "entries")
    whole = segments.join(behind, ["pid", "lo"], "left").join(entries, ["pid", "lo"], "left")
    solved = store(whole.select(*own, "symbols", "counts", "copies", "behind", "closing", "entry").mapInArrow(
        _unrolled, f"pid long, lo long, conv {conv_type}, audit string, cost long, "
                   "turns array<struct<local:long,tag:int,place:long,edit:string,role:string>>"), "edits")

    found = segments.join(entries.select("pid", "lo", "border"), ["pid", "lo"], "left").groupBy("conv").agg(
        F.sum("blank").alias("blank"), F.sum("duplicate").alias("duplicate"), F.sum("truncated").alias("truncated"),
        F.sum(F.col("illegal") + F.coalesce("border", F.lit(0))).alias("illegal"))
    cost = solved.groupBy(F.col("conv").alias("c")).agg(
        F.sum("cost").alias("cost"),
        F.array_join(F.transform(F.sort_array(F.collect_list(F.struct("pid", "audit"))), lambda x: x["audit"]), "")
        .alias("audit"))
    gaps = placed.groupBy("conv", "turn").agg(F.lit(1)).groupBy(F.col("conv").alias("g")).agg(
        F.coalesce(F.max("turn") - F.min("turn") + 1 - F.count("turn"), F.lit(0)).alias("gaps"))
    audits = (found.join(cost, found["conv"].eqNullSafe(cost["c"])).join(gaps, found["conv"].eqNullSafe(gaps["g"]))
              .select("conv", "gaps", "blank", "duplicate", "truncated", "illegal", "cost", "audit"))

    edits = (solved.select("pid", F.explode("turns").alias("t")).select("pid", "t.*")
             .join(placed.select("pid", "local", "conv", "turn", "h"), ["pid", "local"])
             .select("conv", "tag", "turn", "edit", "role", F.lit("").alias("text"), "h", "place"))
    texts = said.select("conv", F.lit(2).alias("tag"), "turn", F.lit(None).cast("string").alias("edit"), "role", "text",
                        "h", F.lit(0).cast("long").alias("place"))
    both = edits.unionByName(texts)
    both = both.repartition("conv") if by_conversation else both.repartitionByRange(width, "conv", "turn", "h")
    turns = (both.sortWithinPartitions("conv", "turn", "h", "tag", "place")
             .select("conv", "tag", "turn", "edit", "role", "text")
             .mapInArrow(_joined_turns, f"conv {conv_type}, turn long, edit string, role string, text string"))
    return Repair(audits, turns)


def damage(rows: DataFrame) -> DataFrame:
    """The damaged rows (conv_id, turn, role, text) of a fixed rule: crc32 of ``conv_id:turn`` modulo 20.

    0 drops the row, 1 empties its text, 2 removes ``.``, ``!`` and ``?`` from it, 3 repeats the row,
    4 makes its role user. Nulls of the key, the role and the text count as one space; ids stay null.
    """
    def said(c: str) -> Column:
        return F.coalesce(rows[c].cast("string"), F.lit(" "))

    kind = F.crc32(F.concat(said("conv_id"), F.lit(":"), said("turn")).cast("binary")) % 20
    base = rows.select(rows["conv_id"], rows["turn"], said("role").alias("role"), said("text").alias("text"),
                       kind.alias("kind")).where("kind <> 0")
    copies = F.explode(F.when(F.col("kind") == 3, F.array(F.lit(0), F.lit(1))).otherwise(F.array(F.lit(0))))
    text = F.when(F.col("kind") == 1, "").when(F.col("kind") == 2, F.translate("text", ".!?", "")).otherwise(F.col("text"))
    return (base.withColumn("copy", copies)
            .select("conv_id", "turn", F.when(F.col("kind") == 4, "user").otherwise(F.col("role")).alias("role"),
                    text.alias("text")))


def _digests(batches: Iterator) -> Iterator:
    """Ordered turns (conv, role, text) -> SHA-256 over ``role:text`` lines of each conversation."""
    import hashlib

    import pyarrow as pa

    held, digest = None, None
    for batch in batches:
        convs, sums = [], []
        rows = zip(batch.column(0).to_pylist(), batch.column(1).cast(pa.binary()).to_pylist(),
                   batch.column(2).cast(pa.binary()).to_pylist(), strict=True)
        for conv, role, text in rows:
            if digest is not None and conv == held:
                digest.update(b"\n")
            else:
                if digest is not None:
                    convs.append(held)
                    sums.append(digest.hexdigest())
                held, digest, kind = conv, hashlib.sha256(), batch.schema.field(0).type
            digest.update(role)
            digest.update(b":")
            digest.update(text)
        if convs:
            yield pa.RecordBatch.from_arrays([pa.array(convs, kind), pa.array(sums)], ["conv", "sha"])
    if digest is not None:
        yield pa.RecordBatch.from_arrays([pa.array([held], kind), pa.array([digest.hexdigest()])], ["conv", "sha"])


def turn_digests(turns: DataFrame) -> DataFrame:
    """(conv, sha): SHA-256 of each conversation's repaired ``role:text`` lines; turns as ``repair`` gives them.

    A digest is a chain, so a conversation's texts pass through one task, as a stream: a hot
    conversation costs time there, not memory.
    """
    conv_type = turns.schema["conv"].dataType.simpleString()
    return turns.select("conv", "role", "text").mapInArrow(_digests, f"conv {conv_type}, sha string")


def repair_report(conversations: DataFrame) -> DataFrame:
    """Damage, repair and digest of all conversations: one row for each original conv_id."""
    result = repair(damage(conversations))
    shas = turn_digests(result.turns)
    all_ids = conversations.select("conv_id").distinct()
    audits = result.audits
    out = (all_ids.join(audits, all_ids["conv_id"].eqNullSafe(audits["conv"]), "left").drop("conv")
           .join(shas, all_ids["conv_id"].eqNullSafe(shas["conv"]), "left"))
    zeros = [F.coalesce(c, F.lit(0)).cast("long").alias(c) for c in ("gaps", "blank", "duplicate", "truncated", "illegal",
                                                                     "cost")]
    return out.select("conv_id", *zeros, F.coalesce("audit", F.lit("")).alias("audit"),
                      F.coalesce("sha", F.sha2(F.lit("").cast("binary"), 256)).alias("repaired_sha256"))
