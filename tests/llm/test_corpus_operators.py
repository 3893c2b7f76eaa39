"""Corpus operators against SQL, brute force, round trips and held-out accuracy, and on awkward rows."""

from __future__ import annotations

import base64
import json
import math
import random
import re
import unicodedata
import zlib
from collections import Counter

import numpy as np
import pytest
from pyspark.sql import functions as F

from check_oracle import database, normal
from ledgerlark.llm import decontaminate, line_dedup, line_rules, near_dup, piece_tokens, pseudonyms, quality_model, secret_scan, sharding
from ledgerlark.llm import common, suffix_tree
from ledgerlark.llm.common import bucket
from ledgerlark.llm.queries_models import PIECES
from ledgerlark.llm.registry import CHECKS, QUERIES, load_all

SF, SMALL = "/root/testdata/sf0.01", "/root/testdata/sf0.001"
load_all()
LONG = "lorem ipsum dolor " * 40_000
SCHEMA = "doc_id bigint, text string, source string, slot string, N_LINES string, score string, ids string, kept string"


@pytest.fixture(scope="module")
def awkward(spark):
    """Null ids, texts and sources, blank and very long texts, repeated rows, ties, and columns named like added ones."""
    rows = [(1, "alpha beta gamma delta epsilon zeta", "a"), (1, "alpha beta gamma delta epsilon zeta", "a"), (2, None, "a"), (3, "", None),
            (4, " \t\n ", "b"), (None, "alpha beta gamma delta epsilon zeta", "b"), (None, None, None), (5, LONG, "c"),
            (6, "alpha beta gamma delta epsilon zeta", "c"), (7, "word", "c"), (8, "x" * 300_000, "d"), (9, "a\n\nb\n", "d")]
    return spark.createDataFrame([(*r, "s", "n", "c", "i", "k") for r in rows], SCHEMA)


@pytest.fixture(scope="module")
def nothing(spark):
    return spark.createDataFrame([], SCHEMA)


@pytest.mark.parametrize("name", sorted(CHECKS))
def test_equals_sql(spark, name):
    df = QUERIES[name](spark, SMALL)
    columns = sorted(df.columns)
    ours = Counter(tuple(normal(v) for v in r) for r in df.select(columns).collect())
    listing = ", ".join(columns)
    theirs = Counter(tuple(normal(v) for v in r) for r in database(SMALL).execute(f"SELECT {listing} FROM ({CHECKS[name]})").fetchall())
    assert ours == theirs and ours


# Sharding


def test_fill_is_taking_turns():
    names, size = ["x", "y", "z"], 31
    owner, free = [None] * size, set(range(size))
    orders = []
    for n in names:
        at, skip = sharding._hash(n + "/offset") % size, sharding._hash(n + "/skip") % (size - 1) + 1
        orders.append([(at + k * skip) % size for k in range(size)])
    for turn in range(size):
        i = turn % 3
        slot = next(s for s in orders[i] if s in free)
        free.discard(slot)
        owner[slot] = i
    assert sharding.fill(names, size) == owner
    assert all(sorted(o) == list(range(size)) for o in orders)


def test_fill_is_even_and_stable():
    names = [f"s{i}" for i in range(20)]
    before, after = sharding.fill(names, 2003), sharding.fill(names[:-1], 2003)
    share = Counter(before)
    assert max(share.values()) - min(share.values()) <= 1
    moved = sum(a != b for a, b in zip(before, after, strict=True))
    assert moved < 2003 / 20 * 3
    for bad in ([], ["a", "a"]):
        with pytest.raises(ValueError):
            sharding.fill(bad, 31)
    with pytest.raises(ValueError):
        sharding.fill(["a"], 30)


def test_place(spark, awkward, nothing):
    rows = sharding.place(awkward, "doc_id", ["a", "b", "c"], 101).collect()
    table = sharding.fill(["a", "b", "c"], 101)
    assert len(rows) == awkward.count() and all(table[r.slot] == r.shard and "abc"[r.shard] == r.shard_name for r in rows)
    by_id = {}
    for r in rows:
        assert r.doc_id is None or by_id.setdefault(r.doc_id, r.shard) == r.shard
    assert len({r.slot for r in rows if r.doc_id is None}) == 2
    assert sharding.place(nothing, ["doc_id", "source"], ["a"], 2).count() == 0


# Line rules


def test_rules_count_distinct_documents_of_a_host(spark, awkward, nothing):
    line = "Read 12 more  posts"
    rows = [(i, f"{line}\nunique " + "abcd"[i] * 3 + " w" * 10, "h") for i in range(4)] + [(9, "read 99 more posts\nbody of nine " + "v " * 9, "other")]
    docs = spark.createDataFrame(rows, "doc_id bigint, text string, source string")
    out = {r.doc_id: r for r in line_rules.host_line_rules(docs, max_docs=3).collect()}
    assert all(out[i].words_left == out[i].n_words - 4 and out[i].n_frequent_lines == 1 and not out[i].depleted for i in range(4))
    assert out[9].words_left == out[9].n_words and line_rules.host_line_rules(nothing).count() == 0
    odd = line_rules.host_line_rules(awkward, max_docs=1).collect()
    assert len(odd) == awkward.count()
    assert all(r.n_words == 0 and r.depleted for r in odd if r.doc_id in (2, 3, 4))
    # The repeated rows are one document, so their host has the line once.
    assert all(r.n_frequent_lines == 0 for r in odd if r.doc_id == 1)


def test_repeated_windows_brute_force(spark):
    random.seed(5)
    texts = [" ".join(random.choice("ab") for _ in range(random.randint(0, 40))) for _ in range(60)]
    docs = spark.createDataFrame([(i, t, "s") for i, t in enumerate(texts)], "doc_id bigint, text string, source string")
    for r in line_rules.host_line_rules(docs).collect():
        w = texts[r.doc_id].split()
        seen = Counter(tuple(w[i:i + 5]) for i in range(len(w) - 4))
        covered = {j for i in range(len(w) - 4) if seen[tuple(w[i:i + 5])] > 1 for j in range(i, i + 5)}
        assert r.n_repeat_words == len(covered)


# Near duplicates


def brute_groups(texts: dict, size: int, percent: int = 80) -> dict:
    sets = {}
    for k, t in texts.items():
        w = re.findall(r"[^\x20\x09-\x0D]+", (t or "").translate(str.maketrans({chr(c): chr(c + 32) for c in range(65, 91)})))
        sets[k] = {tuple(w[i:i + size]) for i in range(max(1, len(w) - size + 1))} if w else set()
    group = {k: k for k in texts}

    def root(k):
        while group[k] != k:
            k = group[k]
        return k

    for a in texts:
        for b in texts:
            if a < b and sets[a] and sets[b]:
                both = len(sets[a] & sets[b])
                if 100 * both >= percent * (len(sets[a]) + len(sets[b]) - both):
                    x, y = sorted((root(a), root(b)))
                    group[y] = x
    return {k: root(k) for k in texts}


def test_near_duplicates_brute_force(spark, monkeypatch):
    """Families of copies with few and many changes, on short sketches and with crowded lists."""
    random.seed(3)
    words = [f"w{i}" for i in range(400)]
    texts, base = {}, [[random.choice(words) for _ in range(n)] for n in (3, 5, 6, 12, 30, 60, 200)]
    for k in range(220):
        w = list(random.choice(base))
        for _ in range(random.choice([0, 0, 1, 2, len(w) // 12, len(w) // 8, len(w) // 4])):
            w[random.randrange(len(w))] = random.choice(words)
        texts[k] = " ".join(w)
    docs = spark.createDataFrame(list(texts.items()), "doc_id bigint, text string")
    for size, most in ((1, 0), (2, 0), (2, 32)):
        monkeypatch.setattr(near_dup, "LIST", most)
        got = {r.doc_id: r.component_id for r in near_dup.near_duplicates(docs, size=size).collect()}
        assert got == brute_groups(texts, size)


def test_near_duplicates_of_awkward_rows(spark, awkward, nothing):
    out = near_dup.near_duplicates(awkward, size=2).collect()
    assert len(out) == awkward.count() and near_dup.near_duplicates(nothing).count() == 0
    by = {r.doc_id: r for r in out if r.doc_id is not None}
    assert by[1].component_id == 1 and by[6].component_id == 1 and not by[6].kept and by[2].n_shingles == 0 and by[2].kept
    assert [r.kept for r in out if r.doc_id is None and r.n_shingles] == [False]
    kept = near_dup.drop_near_duplicates(awkward, size=2)
    assert kept.columns == awkward.columns and sorted(r.doc_id or 0 for r in kept.collect()) == [0, 1, 1, 2, 3, 4, 5, 7, 8, 9]


# Secrets


def der(tag: int, body: bytes) -> bytes:
    size = bytes([len(body)]) if len(body) < 128 else bytes([0x80 + (len(body).bit_length() + 7) // 8]) + len(body).to_bytes((len(body).bit_length() + 7) // 8, "big")
    return bytes([tag]) + size + body


def number(n: int) -> bytes:
    return der(2, n.to_bytes(n.bit_length() // 8 + 1, "big"))


PKCS1 = der(0x30, number(0) + b"".join(number(random.Random(i).getrandbits(500) | 1) for i in range(8)))
PKCS8 = der(0x30, number(0) + der(0x30, der(6, bytes([42, 134, 72, 134, 247, 13, 1, 1, 1])) + der(5, b"")) + der(4, PKCS1))
SEC1 = der(0x30, number(1) + der(4, bytes(range(32))))


def ssh_key() -> bytes:
    def part(b):
        return len(b).to_bytes(4, "big") + b

    return b"openssh-key-v1\0" + part(b"none") + part(b"none") + part(b"") + (1).to_bytes(4, "big") + part(b"public" * 5) + part(b"private" * 9)


def test_secrets_are_confirmed(spark, awkward, nothing):
    b64 = lambda b: base64.b64encode(b).decode()
    url = lambda d: base64.urlsafe_b64encode(json.dumps(d).encode()).decode().rstrip("=")
    lines = "\n".join(b64(PKCS8)[i:i + 64] for i in range(0, len(b64(PKCS8)), 64))
    token = url({"alg": "HS256"}) + "." + url({"sub": 1}) + ".c2lnbmF0dXJl"
    texts = {0: "é " + b64(PKCS1), 1: lines, 2: SEC1.hex().upper(), 3: b64(ssh_key()), 4: token, 5: b64(PKCS1)[:-9], 6: b64(bytes(200)),
             7: "eyJhbGciOjF9." + url({"a": 1}) + ".x", 8: 'Token = "abcdef0123" password:abc AKIA' + "A" * 16}
    docs = spark.createDataFrame(list(texts.items()), "doc_id bigint, text string")
    out = {r.doc_id: [(s.kind, texts[r.doc_id][s.start:s.end]) for s in r.secrets] for r in secret_scan.scan(docs, ["doc_id"]).collect()}
    assert out[0] == [("pkcs1", b64(PKCS1))] and out[1] == [("pkcs8", lines)] and out[2][-1] == ("sec1", SEC1.hex().upper())
    assert out[3] == [("openssh", b64(ssh_key()))] and out[4] == [("token", token)] and not out[5] and not out[6] and not out[7]
    assert out[8] == [("assign", 'Token = "abcdef0123'), ("access", "AKIA" + "A" * 16)]
    assert all(not r.secrets for r in secret_scan.scan(awkward, ["doc_id"]).collect()) and secret_scan.scan(nothing, ["doc_id"]).count() == 0


def test_plain_shapes_brute_force(spark):
    random.seed(8)
    bits = ["password", "PassWd", "tokEn", "api_key", "apikey", ":", "=", " ", '"', "'", "AKIA", "ABCD1234", "deadbeef00", "é", "\n", "K", "ſecret", "x=y"]
    texts = {i: "".join(random.choice(bits) for _ in range(40)) for i in range(300)}
    assign = re.compile(r"""(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", re.I | re.A)
    docs = spark.createDataFrame(list(texts.items()), "doc_id bigint, text string")
    for r in secret_scan.scan(docs, ["doc_id"]).collect():
        t = texts[r.doc_id]
        want = [(m.start(), 0, "assign", m.end()) for m in assign.finditer(t) if len(m[2]) >= 6]
        want += [(m.start(), 1, "access", m.end()) for m in re.finditer("AKIA[A-Z0-9]+", t) if len(m[0]) >= 20]
        want += [(m.start(), 2, "hex", m.end()) for m in re.finditer("[0-9a-f]+", t) if len(m[0]) >= 24]
        assert [(s.kind, s.start, s.end) for s in r.secrets if s.kind in ("assign", "access", "hex")] == [(k, s, e) for s, _, k, e in sorted(want)]


def test_keys_end_where_their_lengths_say(spark):
    """Words on the next line, indented lines, escaped line ends and headers of other beginnings; every length modulo three."""
    texts, want = {}, {}
    for i in range(6):
        key = base64.b64encode(der(0x30, number(1) + der(4, bytes(range(1, 33 + i))))).decode()
        texts[i], want[i] = f"key: {key}\nThis line goes on", ("sec1", key)
        texts[10 + i], want[10 + i] = f"key: {key.rstrip('=')}\nThis line goes on", ("sec1", key.rstrip("="))
    whole = base64.b64encode(PKCS8).decode()
    lines = [whole[i:i + 64] for i in range(0, len(whole), 64)]
    for i, end in enumerate(("\n    ", "\r\n\t", "\\n", "\\r\\n")):
        texts[20 + i] = f"-----BEGIN PRIVATE KEY-----{end}{end.join(lines)}{end}-----END"
        want[20 + i] = ("pkcs8", end.join(lines))
    ssh = base64.b64encode(ssh_key()).decode().rstrip("=")
    texts[30], want[30] = f"{ssh}\nword and more", ("openssh", ssh)
    texts[31], want[31] = f"averylongwordwithoutanyend\n{whole}", ("pkcs8", whole)
    for i, head in enumerate((' {"alg":"HS256"}', '{\t"alg":"HS256"}', '\n{"alg":"none"}')):
        token = ".".join(base64.urlsafe_b64encode(x.encode()).decode().rstrip("=") for x in (head, '\t{"a":1}')) + ".c2ln"
        texts[40 + i], want[40 + i] = f"www12345.example.{token}", ("token", token)
    docs = spark.createDataFrame(list(texts.items()), "doc_id bigint, text string")
    out = {r.doc_id: [(s.kind, texts[r.doc_id][s.start:s.end]) for s in r.secrets] for r in secret_scan.scan(docs, ["doc_id"]).collect()}
    assert {k: [v] for k, v in want.items()} == out


# Quality classifier


def test_classifier_on_held_out_rows(spark):
    labels = {r.doc_id: r.quality for r in spark.read.parquet("/root/testdata/sf0.1/labels.parquet").collect()}
    rows = QUERIES["op5_quality_classifier"](spark, "/root/testdata/sf0.1").collect()
    assert len(rows) == 10_000 and all(0 <= r.score <= 1 and r.predicted == (r.score >= 0.3) for r in rows)
    assert all(r.held_out == (zlib.crc32(str(r.doc_id).encode()) % 5 == 0) for r in rows)
    held = [(r.predicted, labels[r.doc_id]) for r in rows if r.held_out and r.doc_id in labels]
    good = [p for p, y in held if y == 1]
    bad = [p for p, y in held if y == 0]
    assert np.mean(good) > 0.98 and np.mean(bad) < 0.1


def test_classifier_on_awkward_rows(spark, awkward, nothing):
    labels = spark.createDataFrame([(1, 1), (1, 1), (5, 0), (6, None), (9, 1)], "doc_id bigint, quality int")
    for docs, known, n in ((awkward, labels, awkward.count()), (nothing, labels, 0), (awkward, labels.limit(0), awkward.count())):
        rows = quality_model.featurise(docs, ["doc_id"])
        model = quality_model.train(rows, known, F.lit(True))
        out = quality_model.score_texts(docs, model).collect()
        assert len(out) == n and all(0 <= r.score <= 1 for r in out)
        assert quality_model.add_scores(rows, model, ["doc_id"]).count() == n


# Decontamination


def test_passages_in_blocks(spark, awkward, nothing):
    bench = spark.createDataFrame([(1, "alpha beta"), (1, "gamma delta"), (None, "zeta"), (2, None), (3, "..."), (4, "lorem ipsum dolor " * 6)],
                                  "item_id bigint, text string")
    for size in (1 << 20, 16):
        out = decontaminate.find_passages(awkward, bench, ["doc_id"], block_bytes=size).collect()
        assert len(out) == awkward.count()
        by = {r.doc_id: r for r in out if r.doc_id}
        assert by[1].n_hit == 5 and by[1].items == [1] and by[1].contaminated and by[5].n_hit == 120_000 and by[5].items == [4]
        assert not by[2].contaminated and by[9].n_hit == 0
    assert decontaminate.find_passages(nothing, bench, ["doc_id"]).count() == 0
    assert all(r.n_hit == 0 for r in decontaminate.find_passages(awkward, bench.limit(0), ["doc_id"]).collect())


# Line dedup


def test_spread_lines(spark, awkward, nothing):
    foot = "shared foot line"
    rows = [(i, f"own words of page {i} which are many\n {foot}\t\n\nend {i}", f"site{i}") for i in range(6)]
    rows += [(10 + i, foot, f"site{i}") for i in range(2)] + [(20 + i, f"same site only\nbut more text here {i}", "one") for i in range(9)]
    docs = spark.createDataFrame(rows, "doc_id bigint, text string, source string")
    out = {r.doc_id: r for r in line_dedup.remove_spread_lines(docs, min_sites=6).collect()}
    assert out[0].text == "own words of page 0 which are many\n\nend 0" and (out[0].n_lines, out[0].n_removed) == (3, 1)
    assert out[10].text == "" and out[20].n_removed == 0
    odd = line_dedup.remove_spread_lines(awkward, min_sites=1)
    assert odd.count() == awkward.count() and line_dedup.remove_spread_lines(nothing).count() == 0
    assert {r.doc_id: r.text for r in odd.collect()}[2] is None


def test_a_passage_that_outweighs_the_page_goes_and_copies_stay(spark):
    passage = " ".join(f"p{i}" for i in range(60))
    pages = [(i, f"{passage}\n" + " ".join(f"own{i}x{j}" for j in range(25)), f"site{i}") for i in range(12)]
    copies = [(100 + i, "a page\nwith three lines\nof its own", f"site{i}") for i in range(12)]
    docs = spark.createDataFrame(pages + copies, "doc_id bigint, text string, source string")
    out = {r.doc_id: r for r in line_dedup.remove_spread_lines(docs, min_sites=10).collect()}
    assert all(out[i].n_removed == 1 and passage not in out[i].text for i in range(12))
    assert all(out[100 + i].text == copies[0][1] for i in range(12))


# Pseudonyms


def luhn(digits: str) -> bool:
    d = [int(c) for c in digits][::-1]
    return (sum(d[::2]) + sum(sum(divmod(2 * x, 10)) for x in d[1::2])) % 10 == 0


def test_pseudonyms_keep_the_format(spark, awkward, nothing):
    values = ["4111 1111 1111 1111", "4111-1111-1111-1112", "+1 (017) 555-7713", "97.51.17.173", "1999-02-28", "31.12.2020", "2020/02/30",
              "123-45-6789", "ann.lee42@mail.example.com", "jörg.9@x.example.org", "12/24/1987"]
    docs = spark.createDataFrame([(i, f"see {v}, or {v}.") for i, v in enumerate(values)] + [(99, f"{values[0]} {values[3]}")], "doc_id bigint, text string")
    made = pseudonyms.pseudonymise_texts(docs, "key")
    out = {r.doc_id: r for r in made.collect()}
    new = [re.match(r"see (.*), or (.*)\.$", out[i].text).groups() for i in range(len(values))]
    assert all(a == b for a, b in new)  # equal values stay linked
    new = [a for a, _ in new]
    shape = lambda s: re.sub("[0-9]", "9", re.sub("[a-zà-öø-ÿ]", "a", s))
    assert all(shape(a) == shape(b) for a, b in zip(values, new, strict=True) if "." not in a or "@" in a)
    assert new[1] == values[1] and new[6] == values[6]  # fail their checks
    assert all(a != b for i, (a, b) in enumerate(zip(values, new, strict=True)) if i not in (1, 6))
    assert luhn(re.sub(r"\D", "", new[0])) and all(0 <= int(x) <= 255 for x in new[3].split("."))
    assert new[2].startswith("+1 (") and new[8].endswith("@mail.example.com")
    assert out[99].text == f"{new[0]} {new[3]}" and (out[99].n_card, out[99].n_ip) == (1, 1)
    assert {r.doc_id: r.text for r in pseudonyms.restore(made, "key").collect()} == {r.doc_id: r.text for r in docs.collect()}
    assert pseudonyms.pseudonymise_texts(docs, "other").filter("doc_id = 0").first().text != out[0].text
    odd = pseudonyms.pseudonymise_texts(awkward, F.lit("key"))
    assert sorted(str(r.text) for r in odd.collect()) == sorted(str(r.text) for r in awkward.collect())
    assert pseudonyms.pseudonymise_texts(nothing, "key").count() == 0


def test_pseudonyms_of_all_letters_and_day_first_dates(spark):
    names = ["иван", "ИВАН", "őrű", "ōno", "Ά", "δημος", "中文名", "김철수", "straße", "שלום", "ab中и9"]
    values = [f"{n}@mail.example.com" for n in names] + ["31/12/1999", "13/01/1800", "29/02/2000", "31/12/2199"]
    docs = spark.createDataFrame(list(enumerate(values)), "doc_id bigint, text string")
    made = pseudonyms.pseudonymise_texts(docs, "key")
    out = {r.doc_id: r for r in made.collect()}
    again = {r.doc_id: r.text for r in pseudonyms.pseudonymise_texts(docs, "other").collect()}
    assert {r.doc_id: r.text for r in pseudonyms.restore(made, "key").collect()} == dict(enumerate(values))
    for i, n in enumerate(names):
        new = out[i].text.removesuffix("@mail.example.com")
        assert len(new) == len(n) and new != n and all(c.isalpha() or c.isdigit() for c in new) and out[i].n_email == 1
        assert len(n) < 3 or again[i] != out[i].text
    assert all("а" <= c <= "я" or c in "ѐёђѓєѕіїјљњћќѝўџ" or "CYRILLIC" in unicodedata.name(c) for c in out[0].text.split("@")[0])
    for i in range(len(names), len(values)):
        assert re.fullmatch(r"(1[3-9]|2\d|3[01])/\d\d/(18|19|20|21)\d\d", out[i].text) and out[i].n_date == 1
    # Every letter of a class reads as a letter, and every late day is found by its number.
    letters = [chr(c) for _, _, lo, hi, _ in pseudonyms.letter_ranges() for c in range(lo, hi + 1)]
    assert spark.createDataFrame([(c,) for c in letters], "c string").filter(~F.col("c").rlike(r"^\p{L}$")).count() == 0
    ranks = spark.range(88497).select(F.col("id").cast("int").alias("r")).withColumn("d", pseudonyms._late_day(F.col("r")))
    assert ranks.filter((pseudonyms._late_rank(F.col("d")) != F.col("r")) | (F.dayofmonth("d") < 13)).count() == 0
    kept = spark.createDataFrame([(1, "see ...@mail.example.com")], "doc_id bigint, text string")
    assert pseudonyms.pseudonymise_texts(kept, "key").first().n_email == 0


def test_feistel_permutes(spark):
    """Every IPv4-like pair of small digits maps to another one, none twice."""
    radices = F.array(F.lit(7), F.lit(11))
    df = spark.range(77).select(F.array((F.col("id") % 7).cast("int"), (F.col("id") / 7).cast("int")).alias("d"))
    out = [tuple(r[0]) for r in df.select(pseudonyms.feistel(F.col("d"), radices, F.lit("t"), F.lit("k"))).collect()]
    assert sorted(out) == sorted((a, b) for a in range(7) for b in range(11))


# Suffix tree


def test_scores(spark):
    docs = spark.read.parquet(SF + "/documents.parquet").select("doc_id", "text")
    fold = bucket("doc_id", 10)
    rows = suffix_tree.score_texts(docs, fold != 0, ["doc_id"]).collect()
    small = {r.doc_id: r for r in suffix_tree.score_texts(docs, fold != 0, ["doc_id"], hot_words=500).collect()}
    lower = str.maketrans({chr(c): chr(c + 32) for c in range(65, 91)})
    tokens = {r.doc_id: [*re.findall(r"[^\x20\x09-\x0D]+", r.text.translate(lower)), None] for r in docs.collect()}
    training = [k for k in tokens if zlib.crc32(str(k).encode()) % 10]
    counts = Counter(w for k in training for w in tokens[k])
    size, distinct = sum(counts.values()), len(counts)
    for r in rows:
        own = tokens[r.doc_id]
        assert (r.n_tokens, r.n_known, r.train_tokens) == (len(own), sum(counts[w] > 0 for w in own), size)
        assert r.base_score == pytest.approx(sum(math.log10((counts[w] + 0.1) / (size + 0.1 * (distinct + 1))) for w in own))
        assert small[r.doc_id].score == pytest.approx(r.score) and small[r.doc_id].n_known == r.n_known
    held = [r for r in rows if zlib.crc32(str(r.doc_id).encode()) % 10 == 0]
    assert sum(r.score for r in held) > 0.9 * sum(r.base_score for r in held)


def test_tree_is_a_distribution(spark):
    """After every context the probabilities of all known words, the end and the unknown symbol sum to one."""
    random.seed(2)
    follows = {"a": "bbbc", "b": "ac", "c": "ad", "d": "abcd"}
    texts = []
    for _ in range(400):
        w = ["a"]
        while len(w) < 12:
            w.append(random.choice(follows[w[-1]]))
        texts.append(" ".join(w))
    docs = spark.createDataFrame([(i, t) for i, t in enumerate(texts)], "doc_id bigint, text string")
    words = suffix_tree.count_keys(docs, "text", lambda t: t.hashes).withColumnRenamed("key", "word")
    n = {r.word: r.n for r in words.collect()}
    model = suffix_tree.fit(docs, "text", words, sum(n.values()), len(n), 0.75)
    assert [len(level.states) > 0 for level in model.levels] == [True, True]
    counts = np.array([n[w] for w in model.frequent.tolist()])
    every = np.arange(len(counts))
    for one in range(-1, len(counts)):
        for two in range(-1, len(counts)):
            given, factor = model.chain(every, np.full(len(counts), one), np.full(len(counts), two))
            known = given + factor * (counts - 0.75) / model.size
            assert known.sum() + factor[0] * 0.75 * len(n) / model.size == pytest.approx(1)


def test_tree_grows_with_the_corpus(spark):
    """A context's evidence counts, not its share: 30 occurrences are kept however many other texts there are; scores do not depend on
    what tasks hold."""
    random.seed(5)
    rare = [f"r{i} left right{i % 3}" for i in range(3) for _ in range(30)]
    noise = [" ".join(f"w{random.randrange(3000)}" for _ in range(200)) for _ in range(3000)]
    docs = spark.createDataFrame(list(enumerate(rare + noise)), "doc_id bigint, text string").repartition(4)
    words = suffix_tree.count_keys(docs, "text", lambda t: t.hashes).withColumnRenamed("key", "word")
    n = {r.word: r.n for r in words.collect()}
    model = suffix_tree.fit(docs, "text", words, sum(n.values()), len(n), 0.75)
    assert [len(level.states) >= 3 for level in model.levels] == [True, True]
    asked = docs.filter("doc_id in (0, 31, 62, 100)").unionByName(
        spark.createDataFrame([(-1, "r0 left right1"), (-2, "unheard left right0")], docs.schema))
    both = docs.filter("doc_id not in (0, 31, 62, 100)").unionByName(asked)
    learned = F.col("doc_id") >= 0
    whole = {r.doc_id: r.score for r in suffix_tree.score_texts(both, learned, ["doc_id"]).collect()}
    assert whole[0] > whole[-1] + 1  # right0 follows "r0 left", right1 does not
    for entries, words_held in ((0, 0), (500, 100), (0, 1 << 20)):
        parts = {r.doc_id: r.score for r in suffix_tree.score_texts(
            both, learned, ["doc_id"], hot_words=words_held, hot_entries=entries).collect()}
        assert parts == pytest.approx(whole)
    deeper = {r.doc_id: r.score for r in suffix_tree.score_texts(both, learned, ["doc_id"], depth=3).collect()}
    assert deeper[0] >= whole[0] - 0.1 and deeper.keys() == whole.keys()


def test_words_by_eight_bytes_are_told_apart():
    """Words of every length around eight bytes and a long one, next to borders of texts; same words get same hashes, others do not."""
    words = [("aB\u00e9" * 60)[:k] for k in range(1, 150)] + ["A", "ab", "a\x00", "a\x00\x00", "[", "@z`"]
    texts = [" ".join(words), "\t".join(reversed(words)), "", "x", words[-1]]
    found, plain = common.lower_words(chunk(texts)), common.words_of(chunk(texts), common.NOT_SPACE, common.LOWER)
    for mine, its in zip(found[1:], plain[1:], strict=True):
        assert mine.tolist() == its.tolist()
    lower = [w.translate(str.maketrans({chr(c): chr(c + 32) for c in range(65, 91)})) for t in texts for w in re.findall(r"[^\x20\x09-\x0D]+", t)]
    assert len(set(zip(lower, found.hashes.tolist(), strict=True))) == len(set(lower)) == len(set(found.hashes.tolist()))


def test_held_numbers_are_found_and_no_others(spark):
    """Sparse and crowded keys, numbers on either side of what a byte holds, parts without keys; a key is undone to its symbol."""
    rng = np.random.default_rng(5)
    for keys in (rng.integers(-1 << 63, 1 << 63, 20_000), np.arange(-300, 300) << 3, np.array([7]), np.zeros(0, np.int64)):
        keys = np.unique(keys[(keys != -1)])
        n = np.where(np.arange(len(keys)) % 7 == 0, 254 + np.arange(len(keys)), 1 + np.arange(len(keys)) % 254)
        rows = spark.createDataFrame([*zip(keys.tolist(), n.tolist(), strict=True)], "word bigint, n bigint")
        held = suffix_tree.Held.of(rows)
        assert len(held) == len(keys) and held.n(keys).tolist() == n.tolist()
        assert not held.n(np.setdiff1d(np.concatenate([keys + 1, keys - 1, [0, -1]]), keys)).any()
        assert len(held.keys) <= 1.2 * len(keys) + 4 * 64 + 600
        assert suffix_tree.ungrown(keys, suffix_tree.grown(keys, n))[keys != 0].tolist() == n[keys != 0].tolist()


def test_scores_of_awkward_rows(spark, awkward, nothing):
    out = suffix_tree.score_texts(awkward, F.lit(True), ["doc_id"]).collect()
    assert len(out) == awkward.count() and all(np.isfinite(r.score) and r.n_known == r.n_tokens for r in out)
    assert suffix_tree.score_texts(nothing, F.lit(True), ["doc_id"]).count() == 0
    assert all(r.train_tokens == 0 and r.base_score == 0 for r in suffix_tree.score_texts(awkward, F.lit(False), ["doc_id"]).collect())


# Piece tokens


def chunk(texts: list[str]):
    from ledgerlark.llm.common import Texts

    data = [t.encode() for t in texts]
    return Texts(np.frombuffer(b"".join(data), np.uint8), np.concatenate([[0], np.cumsum([len(x) for x in data])]).astype(np.int64))


def test_tokens_equal_the_library(spark):
    import sentencepiece

    library = sentencepiece.SentencePieceProcessor(model_file=PIECES)
    random.seed(4)
    odd = [*"abcdefgh  XYZ.,'\n\t", "é", "日", "本", "😀", "▁", "\x00", "ß", "~"]
    texts = ["", " ", "a" * 900, " " * 70, "the" * 400] + ["".join(random.choice(odd) for _ in range(random.randint(1, 50))) for _ in range(500)]
    texts += [r.text for r in spark.read.parquet("/root/testdata/sf0.001/documents.parquet").collect()]
    encoder, decoder = piece_tokens.Encoder(piece_tokens.load(PIECES)), piece_tokens.Decoder(piece_tokens.load(PIECES))
    for i in range(0, len(texts), 400):
        part = texts[i:i + 400]
        ids = encoder(chunk(part))[0].to_pylist()
        assert ids == library.encode(part)
        offsets = np.concatenate([[0], np.cumsum([len(x) for x in ids])])
        assert decoder(np.array([t for x in ids for t in x]), offsets).to_pylist() == [t.replace("▁", " ") for t in part]


def test_unigram_pieces_brute_force():
    random.seed(6)
    pieces = ["<unk>", "▁", "a", "b", "c", "ab", "bc", "abc", "▁a", "▁ab", "ca", "bb"]
    score = np.array([0] + [-random.uniform(1, 6) for _ in pieces[1:]])
    p = piece_tokens.pieces_of(pieces, score, np.array([2] + [1] * (len(pieces) - 1)), bpe=False)
    worst = score[1:].min() - 10

    def best(word):
        table = [(0.0, [])]
        for end in range(1, len(word) + 1):
            ways = [(table[s][0] + score[pieces.index(word[s:end])], [*table[s][1], pieces.index(word[s:end])])
                    for s in range(end) if word[s:end] in pieces[1:]]
            if word[end - 1] not in pieces[1:]:
                ways.append((table[end - 1][0] + worst, [*table[end - 1][1], 0]))
            table.append(max(ways, key=lambda x: x[0]))
        return table[-1]

    texts = ["".join(random.choice("abcab z") for _ in range(random.randint(1, 14))) for _ in range(300)]
    for text, ids in zip(texts, piece_tokens.Encoder(p)(chunk(texts))[0].to_pylist(), strict=True):
        want = best("▁" + text.replace(" ", "▁"))
        assert sum(score[i] if i else worst for i in ids) == pytest.approx(want[0])


def test_tokens_of_awkward_rows(spark, awkward, nothing):
    assert all(r.same for r in piece_tokens.encode(awkward, PIECES, ["doc_id"], check="same").collect())
    encoded = piece_tokens.encode(awkward, PIECES, ["doc_id", "text"])
    back = piece_tokens.decode(encoded, PIECES, ["doc_id", "text"]).collect()
    assert len(back) == awkward.count() and all(r.decoded == (r.text or "") for r in back)
    assert piece_tokens.decode(piece_tokens.encode(nothing, PIECES, ["doc_id"]), PIECES, ["doc_id"]).count() == 0
