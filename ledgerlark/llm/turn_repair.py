"""Repair of role order and faulty turns of conversations, by dynamic programming over a shared grammar.

A conversation is a sequence of symbols, one per turn: its role's initial and its first fault (blank, duplicate, truncated or none). A
repair edits the turns at least cost so that the initials read ``(s?(ua)+)?``. Each symbol is a min-plus transfer matrix between the four
states of that language; an entry holds the cost and the edits' initials (the audit). Matrices compose, so the symbols are compressed first:
Re-Pair replaces the most frequent neighbours by a rule, over all conversations, and each rule's matrix is made once, bottom-up, from the
two it stands for. Its audits are ropes of theirs. A conversation then costs one step per symbol that is left.

Of cheapest repairs the one with the smallest audit in ASCII order is taken. Two audits that start in one state and cover the same turns
never are prefixes of each other, because each ends with a turn's own letter; so the order of audits is that of their first parts, then of
their second ones, and a matrix keeps ranks instead of comparing texts.

Turns are dealt and sorted by ranges of (conversation, turn), so that a conversation of any length spreads over tasks; duplicates are found
inside a range, and across ranges for the conversations that span several, of which there are fewer than ranges. Of a conversation only
symbols, a character per turn, and the audit meet in a row.

Turns of a conversation are taken by ``order`` (nulls first), ties by role and text. A null role or text reads as one space. A role that is
empty adds no initial. Rows that repeat are duplicates after the first. A null key is a conversation like any other. Very long texts are
moved, never parsed in Python. An empty table gives empty results. Other columns are not carried.
"""

from __future__ import annotations

import hashlib
from collections import Counter
from collections.abc import Iterator
from typing import NamedTuple

import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ledgerlark.session import materialise

BLANKS = " \t\n\x0b\x0c\r"
CLASSES = ["s", "u", "a", "other", "none"]
FAULTS = ["", "truncated", "blank", "duplicate"]
LEGAL = {("s", "u"), ("u", "a"), ("a", "u")}
#: States: nothing yet, after the system turn, after a user turn, after an assistant turn. The first and the last may end.
START, SYSTEM, USER, ASSISTANT = STATES = range(4)
REROLE, INSERT, DELETE, UNFINISHED = 3, 3, 4, 3
#: Turns of one row of symbols that the grammar learns from.
SEGMENT = 256
#: Rounds of Re-Pair, rules of one round, and how often a pair must occur: the size of the grammar. Any grammar gives the same repairs.
ROUNDS, RULES, FREQUENT = 8, 64, 16
#: Symbol sequences whose repair a task remembers.
REMEMBERED = 4096
FIRST_RULE = 0x100


class Entry(NamedTuple):
    """Cost, audit (a text, or a pair of ropes) and the audit's rank among the entries of its matrix row."""

    cost: int
    audit: str | tuple
    rank: int


Matrix = list[list[Entry | None]]


def symbol(role_class: int, fault: int) -> str:
    return chr(ord("A") + role_class * len(FAULTS) + fault)


def _moves(state: int, initial: str) -> int | None:
    """The state after one more turn with this initial."""
    if initial == "s":
        return SYSTEM if state == START else None
    if initial == "u":
        return None if state == USER else USER
    return ASSISTANT if initial == "a" and state == USER else None


def _ranked(rows: list[dict[int, tuple[int, object, object]]]) -> Matrix:
    """A matrix from cost, audit and something to order audits by, per row and column."""
    out: Matrix = []
    for row in rows:
        order = {q: i for i, q in enumerate(sorted(row, key=lambda q: row[q][2]))}
        out.append([Entry(row[q][0], row[q][1], order[q]) if q in row else None for q in STATES])
    return out


def terminal(role_class: int, fault: int) -> Matrix:
    """The matrix of one turn: inserts before it, then the turn kept, given a role, or deleted."""
    name, rows = CLASSES[role_class], []
    for p in STATES:
        best: dict[int, tuple[int, str, str]] = {}

        def offer(q: int | None, cost: int, audit: str, best=best) -> None:
            if q is not None and (q not in best or (cost, audit) < best[q][:2]):
                best[q] = (cost, audit, audit)

        mid, inserted = p, ""
        for _ in range(3):
            paid = INSERT * len(inserted)
            offer(mid, paid + DELETE, inserted + "D")
            if FAULTS[fault] not in ("blank", "duplicate"):
                paid += UNFINISHED if FAULTS[fault] == "truncated" else 0
                offer(mid if name == "none" else _moves(mid, name), paid, inserted + "K")
                offer(_moves(mid, "u"), paid + REROLE, inserted + "R")
                offer(_moves(mid, "a"), paid + REROLE, inserted + "R")
            mid, inserted = (ASSISTANT if mid == USER else USER), inserted + "I"
        rows.append(best)
    return _ranked(rows)


def product(a: Matrix, b: Matrix) -> Matrix:
    rows = []
    for row in a:
        best: dict[int, tuple] = {}
        for mid, x in enumerate(row):
            for q, y in enumerate(b[mid] if x else ()):
                if y and (q not in best or (x.cost + y.cost, x.rank) < (best[q][0], best[q][2][0])):
                    best[q] = (x.cost + y.cost, (x.audit, y.audit), (x.rank, y.rank))
        rows.append(best)
    return _ranked(rows)


def spelled(rope) -> str:
    parts, stack = [], [rope]
    while stack:
        x = stack.pop()
        if isinstance(x, str):
            parts.append(x)
        else:
            stack.extend((x[1], x[0]))
    return "".join(parts)


class Grammar:
    """Rules in the order in which they were made, and the matrix of every symbol."""

    def __init__(self, pairs: list[str]):
        self.pairs = pairs
        self.matrices = {symbol(c, f): terminal(c, f) for c in range(len(CLASSES)) for f in range(len(FAULTS))}
        for i, pair in enumerate(pairs):
            self.matrices[chr(FIRST_RULE + i)] = product(self.matrices[pair[0]], self.matrices[pair[1]])

    def compress(self, text: str) -> str:
        for i, pair in enumerate(self.pairs):
            text = text.replace(pair, chr(FIRST_RULE + i))
        return text

    def repair(self, text: str) -> tuple[int, str]:
        """Least cost, and the smallest audit of that cost."""
        reached: dict[int, tuple[int, object, int]] = {START: (0, "", 0)}
        for c in self.compress(text):
            best: dict[int, tuple] = {}
            for p, (cost, audit, rank) in reached.items():
                for q, y in enumerate(self.matrices[c][p]):
                    if y and (q not in best or (cost + y.cost, rank) < (best[q][0], best[q][2][0])):
                        best[q] = (cost + y.cost, (audit, y.audit), (rank, y.rank))
            order = {q: i for i, q in enumerate(sorted(best, key=lambda q: best[q][2]))}
            reached = {q: (cost, audit, order[q]) for q, (cost, audit, _) in best.items()}
        ends = {START: "", ASSISTANT: "", USER: "I", SYSTEM: "II"}
        cost, _, p = min((cost + INSERT * len(ends[p]), rank, p) for p, (cost, _, rank) in reached.items())
        return cost, spelled((reached[p][1], ends[p]))


def pair_counts(text: str) -> Counter:
    """Neighbours of a sequence; of equal ones in a row every second is counted."""
    found, last = Counter(), -2
    for i in range(len(text) - 1):
        if text[i] == text[i + 1] and last == i - 1 and text[i - 1] == text[i]:
            last = -2
            continue
        found[text[i:i + 2]] += 1
        last = i
    return found


def learn(sequences: DataFrame, rounds: int = ROUNDS, rules: int = RULES, frequent: int = FREQUENT) -> Grammar:
    """Re-Pair over rows of (``symbols``, ``n``): per round the most frequent pairs of which none ends where another begins."""
    pairs: list[str] = []
    for _ in range(rounds):
        grammar = Grammar(list(pairs))

        def count(batches: Iterator[pa.RecordBatch], grammar=grammar) -> Iterator[pa.RecordBatch]:
            for batch in batches:
                total = Counter()
                for text, n in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
                    for pair, k in pair_counts(grammar.compress(text)).items():
                        total[pair] += k * n
                yield pa.RecordBatch.from_arrays([pa.array(list(total), pa.string()), pa.array(list(total.values()), pa.int64())], names=["pair", "n"])

        counted = sequences.select("symbols", "n").mapInArrow(count, "pair string, n bigint").groupBy("pair").agg(F.sum("n").alias("n"))
        best = counted.filter(F.col("n") >= frequent).orderBy(F.desc("n"), "pair").limit(4 * rules).collect()
        first, second, chosen = set(), set(), []
        for r in best:
            x, y = r["pair"]
            if len(chosen) < rules and x not in second and y not in first and (x != y or not chosen):
                first.add(x)
                second.add(y)
                chosen.append(r["pair"])
        if not chosen:
            break
        pairs += chosen
    return Grammar(pairs)


def _classified(rows: DataFrame, key: str, order: str, role: str, text: str) -> DataFrame:
    plain = rows.select(F.col(key).alias("conv"), F.col(order).alias("turn"), F.coalesce(role, F.lit(" ")).alias("role"),
                        F.coalesce(text, F.lit(" ")).alias("text"))
    end = F.right(F.rtrim("text", F.lit(BLANKS)), F.lit(1))
    fault = F.when(end == "", FAULTS.index("blank")).when(end.isin(".", "!", "?"), 0).otherwise(FAULTS.index("truncated"))
    initial = F.left("role", F.lit(1))
    kind = F.when(initial == "s", 0).when(initial == "u", 1).when(initial == "a", 2).when(initial == "", 4).otherwise(3)
    told = F.unhex(F.sha2(F.concat(F.length("role").cast("string"), F.lit(":"), "role", "text"), 256))
    return plain.withColumns({"kind": kind, "fault": fault, "digest": told})


def placed(rows: DataFrame, key: str, order: str, role: str, text: str) -> DataFrame:
    """Turns with ``part`` and ``seq``, which order them, their class and fault, and whether they begin a turn number. A table."""
    source = _classified(rows, key, order, role, text)
    dealt = source.repartitionByRange("conv", "turn").sortWithinPartitions("conv", "turn", "role", "text")
    schema = T.StructType([*source.schema.fields, T.StructField("part", T.IntegerType()), T.StructField("seq", T.LongType()),
                           T.StructField("new_turn", T.BooleanType())])
    names, same = [f.name for f in schema], FAULTS.index("duplicate")
    settled = (FAULTS.index("blank"), same)

    def number(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        part, seq, seen = TaskContext.get().partitionId(), 0, set()
        conv = turn = object()
        for batch in batches:
            faults, fresh_turns = [], []
            for c, t, fault, digest in zip(*(batch.column(n).to_pylist() for n in ("conv", "turn", "fault", "digest")), strict=True):
                if c != conv:
                    conv, turn, seen = c, object(), set()
                faults.append(same if digest in seen and fault not in settled else fault)
                fresh_turns.append(t is not None and t != turn)
                seen.add(digest)
                turn = t
            n = len(faults)
            made = {"fault": pa.array(faults, pa.int32()), "part": pa.array([part] * n, pa.int32()),
                    "seq": pa.array(range(seq, seq + n), pa.int64()), "new_turn": pa.array(fresh_turns, pa.bool_())}
            seq += n
            yield pa.RecordBatch.from_arrays([made[x] if x in made else batch.column(x) for x in names], names=names)

    return materialise(dealt.mapInArrow(number, schema), "turns")


def symbols_of(turns: DataFrame) -> DataFrame:
    """(conv, part, seq, sym) with the duplicates of earlier ranges, and what gaps need."""
    narrow = turns.drop("role", "text")
    spans = narrow.groupBy("conv").agg(F.min("part").alias("a"), F.max("part").alias("b")).filter("a < b").select(
        F.col("conv").alias("spanning"))
    spans = F.broadcast(spans)  # fewer rows than ranges: two ranges share one conversation at most
    inside = F.col("conv").eqNullSafe(F.col("spanning"))
    split = narrow.join(spans, inside, "left_semi")
    first = split.groupBy(F.col("conv").alias("c"), F.col("digest").alias("d")).agg(F.min("part").alias("first"))
    open_ = F.col("fault").isin(0, FAULTS.index("truncated"))
    late = split.filter(open_).join(first, F.col("conv").eqNullSafe(F.col("c")) & (F.col("digest") == F.col("d"))).withColumn(
        "fault", F.when(F.col("part") > F.col("first"), FAULTS.index("duplicate")).otherwise(F.col("fault")))
    whole = narrow.join(spans, inside, "left_anti").unionByName(split.filter(~open_)).unionByName(late.select(*narrow.columns))
    sym = F.char(F.lit(ord("A")) + F.col("kind") * len(FAULTS) + F.col("fault"))
    return whole.select("conv", "turn", "part", "seq", "new_turn", sym.alias("sym"))


def _in_order(parts: Column, name: str) -> Column:
    return F.array_join(F.transform(F.array_sort(parts), lambda x: x[name]), "")


class Repair(NamedTuple):
    """``conversations``: key, gaps, blank, duplicate, truncated, illegal, cost, audit. ``turns``: key, position, role, text."""

    conversations: DataFrame
    turns: DataFrame


_EDITS = T.ArrayType(T.StructType([T.StructField("part", T.IntegerType()), T.StructField("seq", T.LongType()),
                                   T.StructField("base", T.LongType()), T.StructField("edit", T.StringType())]))
_COUNTS = ["blank", "duplicate", "truncated", "illegal", "cost"]


def _edits(audit: str, places: Iterator[tuple[int, int]]) -> list[dict]:
    """Per turn its place, the repaired turns before it, and its letters: u or a for an inserted turn, K, D, or U or A for a new role."""
    out, state, inserted, n = [], START, "", 0
    for letter in audit:
        if letter == "I":
            state = _moves(state, "a") or USER
            inserted += "a" if state == ASSISTANT else "u"
            continue
        part, seq, initial = next(places)
        edit = letter
        if letter == "R":
            state = ASSISTANT if state == USER else USER
            edit = "A" if state == ASSISTANT else "U"
        elif letter == "K" and initial != "none":
            state = _moves(state, initial)
        out.append({"part": part, "seq": seq, "base": n, "edit": inserted + edit})
        n += len(inserted) + (letter != "D")
        inserted = ""
    if inserted:
        out[-1]["edit"] += inserted
    return out


def repair(rows: DataFrame, key: str = "conv_id", order: str = "turn", role: str = "role", text: str = "text") -> Repair:
    """Diagnose and repair every conversation that has rows."""
    turns = placed(rows, key, order, role, text)
    segments = symbols_of(turns).groupBy("conv", "part", F.floor(F.col("seq") / SEGMENT).alias("segment")).agg(
        _in_order(F.collect_list(F.struct("seq", "sym")), "sym").alias("symbols"), F.min("seq").alias("begin"),
        F.min("turn").alias("low"), F.max("turn").alias("high"), F.count_if("new_turn").alias("distinct"))
    segments = materialise(segments, "symbols")
    grammar = learn(segments.groupBy("symbols").agg(F.count("*").alias("n")))
    whole = segments.groupBy("conv").agg(
        F.array_sort(F.collect_list(F.struct("part", "begin", "symbols"))).alias("pieces"),
        F.coalesce(F.max("high") - F.min("low") + 1 - F.sum("distinct"), F.lit(0)).cast("bigint").alias("gaps"))
    schema = T.StructType([whole.schema["conv"], whole.schema["gaps"], *[T.StructField(n, T.LongType()) for n in _COUNTS],
                           T.StructField("audit", T.StringType()), T.StructField("edits", _EDITS)])

    def evaluate(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known: dict[str, tuple[int, str]] = {}
        for batch in batches:
            numbers, audits, edits = [], [], []
            for pieces in batch.column("pieces").to_pylist():
                line = "".join(p["symbols"] for p in pieces)
                if line not in known:
                    if len(known) >= REMEMBERED:
                        known.clear()
                    known[line] = grammar.repair(line)
                cost, audit = known[line]
                kinds = [divmod(ord(c) - ord("A"), len(FAULTS)) for c in line]
                initials = [CLASSES[k] for k, _ in kinds]
                faults = Counter(FAULTS[f] for _, f in kinds)
                illegal = sum(p not in LEGAL for p in zip(initials, initials[1:], strict=False))
                numbers.append([faults["blank"], faults["duplicate"], faults["truncated"], illegal, cost])
                audits.append(audit)
                at = ((p["part"], p["begin"] + i) for p in pieces for i in range(len(p["symbols"])))
                edits.append(_edits(audit, ((*x, i) for x, i in zip(at, initials, strict=True))))
            columns = [pa.array([r[i] for r in numbers], pa.int64()) for i in range(len(_COUNTS))]
            kind = pa.list_(pa.struct([("part", pa.int32()), ("seq", pa.int64()), ("base", pa.int64()), ("edit", pa.string())]))
            yield pa.RecordBatch.from_arrays([batch.column("conv"), batch.column("gaps"), *columns, pa.array(audits, pa.string()),
                                              pa.array(edits, kind)], names=[f.name for f in schema])

    judged = materialise(whole.mapInArrow(evaluate, schema), "repairs")
    steps = judged.select(F.inline("edits"))
    role_of = {"K": F.col("role"), "U": F.lit("user"), "A": F.lit("assistant"), "u": F.lit("user"), "a": F.lit("assistant")}

    def turn(c: Column) -> Column:
        name = F.coalesce(*[F.when(c == k, v) for k, v in role_of.items()])
        return F.struct(name.alias("role"), F.when(c.isin("u", "a"), "").otherwise(F.col("text")).alias("text"))

    letters = F.filter(F.split("edit", ""), lambda c: c.isin(*role_of))
    made = turns.select("conv", "role", "text", "part", "seq").join(steps, ["part", "seq"]).select(
        "conv", "base", F.posexplode(F.transform(letters, turn)).alias("i", "t"))
    repaired = made.select(F.col("conv").alias(key), (F.col("base") + F.col("i")).alias("position"), "t.role", "t.text")
    return Repair(judged.drop("edits").withColumnRenamed("conv", key), repaired)


def digests(turns: DataFrame, key: str = "conv_id", name: str = "repaired_sha256") -> DataFrame:
    """Per conversation the SHA-256 of its ``role:text`` lines in order, read as a stream: a task holds one hash, whatever the length."""
    lines = turns.select(key, "position", F.concat("role", F.lit(":"), "text").cast("binary").alias("line"))
    schema = T.StructType([turns.schema[key], T.StructField(name, T.StringType())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        kind, current, state = None, None, None
        for batch in batches:
            kind, done = batch.schema.field(0).type, []
            for c, place, line in zip(*(batch.column(i).to_pylist() for i in range(3)), strict=True):
                if place == 0:
                    if state:
                        done.append((current, state.hexdigest()))
                    current, state = c, hashlib.sha256()
                else:
                    state.update(b"\n")
                state.update(line)
            yield _pairs(done, kind, name, key)
        if state:
            yield _pairs([(current, state.hexdigest())], kind, name, key)

    return lines.repartition(key).sortWithinPartitions(key, "position").mapInArrow(run, schema)


def _pairs(rows: list[tuple], kind: pa.DataType, name: str, key: str) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array([r[0] for r in rows], kind), pa.array([r[1] for r in rows], pa.string())], names=[key, name])
