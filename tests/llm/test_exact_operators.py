"""Exact copies, periodic runs and conversation repair against brute force, and on awkward rows."""

from __future__ import annotations

import hashlib
import heapq
import random
import re

import numpy as np
import pytest
from pyspark.sql import functions as F

from ledgerlark.llm import decontaminate as D
from ledgerlark.llm import exact_dup as E
from ledgerlark.llm import line_rules, piece_tokens, secret_scan, suffix_tree
from ledgerlark.llm import periodic_runs as P
from ledgerlark.llm import turn_repair as R
from ledgerlark.llm.common import Texts
from ledgerlark.llm.queries_exact import damaged, planted
from ledgerlark.llm.queries_models import PIECES

LONG = "Lorem ipsum dolor " * 40_000
SCHEMA = "doc_id bigint, text string, Kept string, keep_id string, fp_high string, n_words string, runs string, collapsed string, the_row string"
ROWS = [(1, "Alpha beta"), (1, "Alpha beta"), (2, "ALPHA BETA"), (None, "alpha beta"), (3, None), (4, ""), (5, " "), (6, LONG), (7, LONG.upper()),
        (8, "Älpha"), (9, "älpha"), (None, None), (10, "x" * 300_000)]


@pytest.fixture(scope="module")
def awkward(spark):
    return spark.createDataFrame([(*r, "k", "i", "f", "n", "r", "c", "t") for r in ROWS], SCHEMA)


def lowered(text):
    return (text or "").translate({c: c + 32 for c in range(65, 91)})


# Exact copies


def texts_of(values):
    raw = [v.encode() for v in values]
    return Texts(np.frombuffer(b"".join(raw), np.uint8), np.concatenate([[0], np.cumsum([len(r) for r in raw])]))


def test_fingerprints_are_polynomials_of_the_bytes():
    rnd = random.Random(3)
    values = ["", "a", "A", "é" * 700, *("".join(rnd.choices("abcXYZ ", k=n)) for n in (1, 1023, 1024, 1025, 5000, 70_000))]
    base = E.bases()
    got = E.polynomials(texts_of(values), base)
    prime = int(E.PRIME)
    for value, row in zip(values, got.tolist(), strict=True):
        for b, h in zip(base.tolist(), row, strict=True):
            want = 0
            for byte in lowered(value).encode():
                want = (want * b + byte) % prime
            assert h == want
    assert got[1].tolist() == got[2].tolist()


def test_parts_compose_to_the_whole(spark):
    rnd = random.Random(5)
    whole, parts = [], []
    for i in range(40):
        text = "".join(rnd.choices("abc DEF\n", k=rnd.choice([0, 1, 50, 4000])))
        cuts = sorted(rnd.choices(range(len(text) + 1), k=rnd.randint(0, 6)))
        whole.append((i, text))
        parts += [(i, n, text[a:b]) for n, (a, b) in enumerate(zip([0, *cuts], [*cuts, len(text)], strict=True))]
    rnd.shuffle(parts)
    a = E.fingerprints(spark.createDataFrame(whole, "d int, text string"), ["d"], E.bases()).drop("text_sha256")
    b = E.fingerprint_parts(spark.createDataFrame(parts, "d int, part int, text string").repartition(5), "d", "part")
    assert sorted(map(tuple, a.collect())) == sorted(map(tuple, b.collect()))


def brute_copies(rows):
    groups = {}
    for d, t in rows:
        groups.setdefault(lowered(t), []).append(d)
    return sorted((d if d is not None else -1, max((x for x in groups[lowered(t)] if x is not None), default=-1), len(groups[lowered(t)]),
                   hashlib.sha256(lowered(t).encode()).hexdigest()) for d, t in rows)


def found(df):
    return sorted((-1 if r.doc_id is None else r.doc_id, -1 if r.keep_id is None else r.keep_id, r.group_size, r.text_sha256) for r in df.collect())


def test_copies_of_awkward_rows(awkward):
    marked = E.mark_copies(awkward, awkward.columns)
    assert found(marked) == brute_copies(ROWS)
    kept = marked.filter("kept").collect()
    assert sorted(r.keep_id for r in kept) == sorted({r[1] for r in brute_copies(ROWS)})
    dropped = E.drop_copies(awkward)
    assert dropped.columns == awkward.columns and dropped.count() == len(kept)
    assert {r.Kept for r in dropped.collect()} == {"k"}
    assert E.mark_copies(awkward.filter("false"), ["doc_id"]).count() == 0


def test_texts_that_share_a_fingerprint_are_told_apart(spark, monkeypatch):
    """With a base of 1 the fingerprint is the sum of the bytes, so anagrams meet and the bases must change."""
    monkeypatch.setattr(E, "PIECE", 4)
    rows = [(i, t) for i, t in enumerate(["abcdefgh", "abcdefhg", "abcdefgh", "hgfedcba", "abcdefhg", "zz"])]
    tried = []

    def choose(attempt):
        tried.append(attempt)
        return np.ones(4, np.uint64) if attempt == 0 else E.bases(attempt)

    assert found(E.mark_copies(spark.createDataFrame(rows, "doc_id bigint, text string"), ["doc_id"], choose=choose)) == brute_copies(rows)
    assert tried == [0, 1]


def test_a_large_group_joins_by_broadcast_and_stays_whole(spark, monkeypatch):
    monkeypatch.setattr(E, "HOT_GROUPS", 4)
    rows = [(i, "same" if i % 3 else f"text {i % 50}") for i in range(600)]
    assert found(E.mark_copies(spark.createDataFrame(rows, "doc_id bigint, text string").repartition(7), ["doc_id"])) == brute_copies(rows)


# Periodic runs


def brute_runs(x, shortest):
    out = {}
    for q in range(1, len(x) // 2 + 1):
        i = 0
        while i + q < len(x):
            j = i
            while j + q < len(x) and x[j] == x[j + q]:
                j += 1
            if j > i and j - i + q >= max(2 * q, shortest):
                out.setdefault((i, j - i + q), q)
            i = max(j, i + 1)
    return sorted((s, n, q) for (s, n), q in out.items())


def words_with_runs(rnd):
    kind, n = rnd.randrange(3), rnd.randint(0, 80)
    x = [rnd.randint(1, rnd.choice([1, 2, 2, 3, 9])) for _ in range(n)]
    if kind == 0 and n:
        a = rnd.randrange(n)
        p = rnd.randint(1, n - a)
        x[a:] = [x[a + i % p] for i in range(n - a)]
    if kind == 1:
        f = [1], [1, 2]
        while len(f[-1]) < n:
            f = (f[1], f[1] + f[0])
        x = f[1][:n]
    return x


def test_runs_equal_brute_force():
    rnd = random.Random(7)
    for _ in range(1500):
        x = words_with_runs(rnd)
        for shortest in (1, 12):
            s, n, q = P.runs_of(np.array(x, np.uint64), shortest)
            assert sorted(zip(s.tolist(), n.tolist(), q.tolist(), strict=True)) == brute_runs(x, shortest), x


def collapsed(words, runs):
    gone = {i for s, n, q in runs for i in range(s + q, s + n)}
    return " ".join(w for i, w in enumerate(words) if i not in gone)


def test_runs_of_rows(spark):
    rnd = random.Random(11)
    rows = [(i, rnd.choice([" ", "\n", "\t  "]).join(f"wé{v}" for v in words_with_runs(rnd))) for i in range(200)]
    got = {r.d: r for r in P.find_runs(spark.createDataFrame(rows, "d int, text string"), ["d"]).collect()}
    for d, text in rows:
        words = text.split()
        want = brute_runs(words, 12)
        assert [tuple(r) for r in got[d].runs] == want and got[d].collapsed == collapsed(words, want) and got[d].n_words == len(words)


def test_runs_of_awkward_rows(awkward):
    rows = P.find_runs(awkward, awkward.columns).collect()
    assert len(rows) == len(ROWS) and "Kept" in rows[0].asDict()
    for r in rows:
        if r.text and r.text.lower() == LONG.lower():
            assert [tuple(x) for x in r.runs] == [(0, 120_000, 3)] and r.collapsed.lower() == "lorem ipsum dolor"
        else:
            assert r.runs == [] and r.collapsed == " ".join((r.text or "").split())
    assert P.find_runs(awkward.filter("false"), ["doc_id"]).count() == 0


def test_planted_repeats_follow_the_rule(spark):
    import zlib
    rows = [(i, " ".join(f"w{j}" for j in range(i % 23))) for i in range(300)] + [(None, None)]
    for r in planted(spark.createDataFrame(rows, "doc_id bigint, text string")).collect():
        words = (dict(rows).get(r.doc_id) or "").split()
        h = zlib.crc32(str(r.doc_id).encode() if r.doc_id is not None else b"")
        if h % 10 == 0 and words:
            g, n = h // 10, len(words)
            a = g % n
            p = 1 + (n - a) // (3 + g % 8)
            words = [words[i if i < a else a + (i - a) % p] for i in range(n)]
        assert (r.text or "").split() == words


# Conversation repair


def cheapest(turns):
    """Least cost, smallest audit and repaired rows by a search over whole strings of edits."""
    best, queue = {}, [(0, "", 0, "", ())]
    while queue:
        cost, audit, i, state, out = heapq.heappop(queue)
        if (i, state) in best and best[i, state] < (cost, audit):
            continue
        best[i, state] = (cost, audit)
        if i == len(turns) and state in ("", "a"):
            return cost, audit, list(out)
        after = {"": "su", "s": "u", "u": "a", "a": "u"}[state]
        for initial in after:
            if initial != "s":
                name = {"u": "user", "a": "assistant"}[initial]
                if audit.count("I") < 2 * len(turns) + 2:
                    heapq.heappush(queue, (cost + 3, audit + "I", i, initial, (*out, f"{name}:")))
                if i < len(turns) and turns[i][2] in ("", "truncated"):
                    extra = 3 * (turns[i][2] == "truncated")
                    heapq.heappush(queue, (cost + 3 + extra, audit + "R", i + 1, initial, (*out, f"{name}:{turns[i][1]}")))
            if i < len(turns) and turns[i][2] in ("", "truncated") and turns[i][0][:1] == initial:
                heapq.heappush(queue, (cost + 3 * (turns[i][2] == "truncated"), audit + "K", i + 1, initial, (*out, f"{turns[i][0]}:{turns[i][1]}")))
        if i < len(turns):
            if turns[i][2] in ("", "truncated") and turns[i][0] == "":
                heapq.heappush(queue, (cost + 3 * (turns[i][2] == "truncated"), audit + "K", i + 1, state, (*out, f":{turns[i][1]}")))
            heapq.heappush(queue, (cost + 4, audit + "D", i + 1, state, out))


def judged(rows):
    """Brute force over (turn, role, text) rows of one conversation."""
    rows = [(t, " " if r is None else r, " " if x is None else x) for t, r, x in rows]
    rows.sort(key=lambda r: (r[0] is not None, r[0] or 0, r[1], r[2]))
    seen, turns = set(), []
    for _, role, text in rows:
        end = re.findall(r"[^\x20\x09-\x0D]", text)[-1:]
        fault = "blank" if not end else "duplicate" if (role, text) in seen else "" if end[0] in ".!?" else "truncated"
        seen.add((role, text))
        turns.append((role, text, fault))
    numbers = [t for t, *_ in rows if t is not None]
    gaps = max(numbers) - min(numbers) + 1 - len(set(numbers)) if numbers else 0
    counts = [sum(t[2] == f for t in turns) for f in ("blank", "duplicate", "truncated")]
    illegal = sum(a[0][:1] + b[0][:1] not in ("su", "ua", "au") for a, b in zip(turns, turns[1:], strict=False))
    cost, audit, out = cheapest(turns)
    return (gaps, *counts, illegal, cost, audit, out)


def conversations(rnd, n):
    texts = ["Yes.", "No!", "Why?", "cut", "", " \n", "Tall.", "é.", None]
    roles = ["user", "assistant", "system", "user", "assistant", "tool", "", None]
    out = []
    for c in range(n):
        turn = 0
        for _ in range(rnd.randint(0, 9)):
            turn += rnd.choice([1, 1, 1, 0, 3])
            out.append((c if c else None, None if rnd.random() < 0.05 else turn, rnd.choice(roles), rnd.choice(texts)))
    return out


def results(fixed):
    lines = {}
    for r in fixed.turns.collect():
        lines.setdefault(r.conv_id, []).append((r.position, f"{r.role}:{r.text}"))
    for v in lines.values():
        v.sort()
        assert [p for p, _ in v] == list(range(len(v)))
    return {r.conv_id: (r.gaps, r.blank, r.duplicate, r.truncated, r.illegal, r.cost, r.audit, [x for _, x in lines.get(r.conv_id, [])])
            for r in fixed.conversations.collect()}


CONV = "conv_id bigint, turn bigint, role string, text string"


@pytest.mark.parametrize("frequent", [1, 10**9])
def test_repairs_equal_a_search_over_edits(spark, monkeypatch, frequent):
    """With a grammar of many rules and with none."""
    monkeypatch.setattr(R.learn, "__defaults__", (R.ROUNDS, R.RULES, frequent))
    rows = conversations(random.Random(13), 150)
    extra = spark.createDataFrame([(*r, 1, "x") for r in rows], CONV + ", part int, cost string").repartition(3)
    got, by_conv = results(R.repair(extra)), {}
    for c, *r in rows:
        by_conv.setdefault(c, []).append(tuple(r))
    assert got == {c: judged(rs) for c, rs in by_conv.items()}


def test_one_conversation_over_many_ranges(spark, monkeypatch):
    """A third of all turns in one conversation, its repeats in other ranges than the first."""
    monkeypatch.setattr(R, "SEGMENT", 8)
    rnd = random.Random(17)
    long = [(7, i, rnd.choice(["user", "assistant"]), f"Text {rnd.randrange(150)}{rnd.choice(['.', ''])}") for i in range(300)]
    rows = long + [(c, i, "user" if i % 2 == 0 else "assistant", "Hi.") for c in range(100, 250) for i in range(4)]
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    fixed = R.repair(spark.createDataFrame(rows, CONV).repartition(5))
    got = results(fixed)
    spark.conf.unset("spark.sql.adaptive.coalescePartitions.enabled")
    assert got[7] == judged([r[1:] for r in long]) and got[7][2] > 50
    assert all(got[c] == judged([r[1:] for r in rows if r[0] == c]) for c in (100, 249))
    hashes = {r.conv_id: r.repaired_sha256 for r in R.digests(fixed.turns).collect()}
    assert hashes == {c: hashlib.sha256("\n".join(v[-1]).encode()).hexdigest() for c, v in got.items() if v[-1]}


def test_empty_and_long_conversations(spark):
    fixed = R.repair(spark.createDataFrame([], CONV))
    assert fixed.conversations.count() == 0 and fixed.turns.count() == 0 and R.digests(fixed.turns).count() == 0
    got = results(R.repair(spark.createDataFrame([(1, 0, "user", LONG), (1, 1, "assistant", LONG), (2, 0, None, None)], CONV)))
    assert got[1][:7] == (0, 0, 0, 2, 0, 6, "KK") and got[2] == (0, 1, 0, 0, 0, 4, "D", [])


def test_grammar_never_changes_a_repair(spark):
    rnd = random.Random(19)
    lines = ["".join(rnd.choices("AEIBFJCD", k=rnd.randint(1, 60))) for _ in range(60)]
    sequences = spark.createDataFrame([(x, 3) for x in lines], "symbols string, n bigint")
    plain, learned = R.Grammar([]), R.learn(sequences, frequent=2)
    assert len(learned.pairs) > 20
    assert all(len(learned.compress(x)) < len(x) for x in lines if len(x) > 10)
    assert [plain.repair(x) for x in lines] == [learned.repair(x) for x in lines]


def test_damage_follows_the_rule(spark):
    import zlib
    rows = [(c if c else None, t if t else None, "system" if t == 0 else None, "A. b! c?") for c in range(40) for t in range(5)]
    want = []
    for c, t, role, text in rows:
        h = zlib.crc32(f"{' ' if c is None else c}:{' ' if t is None else t}".encode()) % 20
        text = {1: "", 2: "A b c"}.get(h, text)
        role = "user" if h == 4 else role or " "
        want += [(c or -1, t or -1, role, text)] * {0: 0, 3: 2}.get(h, 1)
    got = [(r.conv_id or -1, r.turn or -1, r.role, r.text) for r in damaged(spark.createDataFrame(rows, CONV)).collect()]
    assert sorted(got) == sorted(want) and "A b c" in {r[3] for r in got}


# Names and types that meet those of results


CLASHES = ["n_words", "SPANS", "items", "n_hit", "contaminated", "secrets", "ids", "score", "n_tokens", "base_score", "x", "row", "lines", "words_left"]


@pytest.mark.parametrize("name", ["passages", "secrets", "ids", "scores", "rules"])
def test_extra_columns_named_like_results(spark, name):
    rows = [(1, "one two three four five six seven eight nine ten eleven twelve thirteen fourteen", "h"), (2, None, None), (2, "", "h")]
    docs = spark.createDataFrame([(*r, *CLASHES) for r in rows], "doc_id bigint, text string, source string, " + ", ".join(f"{c} string" for c in CLASHES))
    benchmark = spark.createDataFrame([("q-1", rows[0][1]), (None, "other words here")], "item_id string, text string")
    made = {"passages": lambda: D.find_passages(docs, benchmark, docs.columns), "secrets": lambda: secret_scan.scan(docs, docs.columns),
            "ids": lambda: piece_tokens.encode(docs, PIECES, docs.columns),
            "scores": lambda: suffix_tree.score_texts(docs, F.lit(True), docs.columns),
            "rules": lambda: line_rules.host_line_rules(docs.drop("source").withColumnRenamed("row", "lines_") , host="lines")}[name]()
    out = made.collect()
    assert len(out) == 3 and len({c.lower() for c in made.columns}) == len(made.columns)
    if name == "passages":
        assert [r["items"] for r in out if r.contaminated] == [["q-1"]]


@pytest.mark.parametrize("host", ["row", "lines", "n_words", "host", "doc", "gone"])
def test_hosts_may_have_any_name(spark, host):
    rows = [(i, "a common line\nown words number " + "abcd"[i] * 3 + " x" * 10, "h") for i in range(4)]
    docs = spark.createDataFrame(rows, f"doc_id bigint, text string, {host} string")
    assert [r.n_frequent_lines for r in line_rules.host_line_rules(docs, max_docs=3, host=host).collect()] == [1] * 4


def test_passages_over_several_blocks_with_string_ids(spark):
    items = [(f"id-{i}", " ".join(f"w{i}x{j}" for j in range(20))) for i in range(9)] + [("id-0", "another text of the first id here")]
    docs = spark.createDataFrame([(None, items[3][1] + " and " + items[7][1]), (5, None)], "doc_id bigint, text string")
    benchmark = spark.createDataFrame(items, "item_id string, text string")
    got = D.find_passages(docs, benchmark, ["doc_id"], block_bytes=200).collect()
    assert sorted((sorted(r["items"]), r.n_hit) for r in got) == [([], 0), (["id-3", "id-7"], 40)]


# Texts without the frequent lines of their host


def plain_removal(rows, max_docs, min_words, max_removed):
    def form(part):
        return " ".join(re.findall(r"[^\x20\x09-\x0d]+", re.sub("[0-9]", "0", lowered(part))))

    holders = {}
    for n, (doc, text, host) in enumerate(rows):
        for part in (text or "").split("\n"):
            if form(part):
                holders.setdefault((host, form(part)), set()).add(("row", n) if doc is None else doc)
    frequent = {k for k, docs in holders.items() if len(docs) > max_docs}
    out = []
    for doc, text, host in rows:
        parts = (text or "").split("\n")
        kept = [p for p in parts if (host, form(p)) not in frequent]
        n, left = (sum(len(form(p).split()) for p in some) for some in (parts, kept))
        if left >= min_words and n - left <= n * max_removed:
            out.append((doc, "\n".join(kept), host))
    return sorted(out, key=repr)


def test_texts_without_frequent_lines_brute_force(spark):
    rnd = random.Random(11)
    common = ["Read 12 more\tposts", "read 99 MORE posts ", "Share this", " ", "", "\r", "ärmer 7 Ä", "a b c d e f g"]
    rows = [(rnd.choice([i, i, i // 2, None]),
             "\n".join(rnd.choice([*common, f"own line {rnd.choice('xyz')} of words"]) for _ in range(rnd.randint(0, 9))),
             rnd.choice(["h", "h", "g", None])) for i in range(300)]
    rows += [(900, None, "h"), (901, "", None), (902, "Share this\n" + "one two " * 60_000, "h"), (903, rows[0][1], "h"), (904, rows[0][1], "h")]
    docs = spark.createDataFrame(rows, "doc_id bigint, text string, source string").repartition(3)
    for limits in ((8, 3, 0.5), (8, 0, 1.0), (1000, 0, 1.0)):
        got = line_rules.without_frequent_lines(docs, *limits)
        assert sorted((tuple(r) for r in got.collect()), key=repr) == plain_removal(rows, *limits)


def test_texts_without_frequent_lines_under_clashing_names(spark):
    rows = [(i, "a common line\nown words number " + "abcd"[i] * 3 + " x" * 10, "h") for i in range(4)]
    extra = ["text_mark", "host_mark", "gone_lines", "the_key", "row", "lines", "line", "gone", "n_words", "doc"]
    docs = spark.createDataFrame([(*r, *extra) for r in rows],
                                 "Id bigint, Body string, host string, " + ", ".join(f"{c} string" for c in extra))
    got = line_rules.without_frequent_lines(docs, 3, key="id", host="HOST", text="body")
    assert got.columns == docs.columns
    assert sorted(tuple(r) for r in got.collect()) == [(i, t.split("\n")[1], h, *extra) for i, t, h in rows]
    assert line_rules.without_frequent_lines(docs.limit(0), key="Id", host="host", text="Body").count() == 0
