"""The pipeline's stages against brute force on what each of them reads."""

from __future__ import annotations

import re
from collections import defaultdict

import corpus_pipeline as P
from ledgerlark.session import materialise
from test_corpus_operators import brute_groups

SF = "/root/testdata/sf0.001"


def test_stages(spark):
    docs = spark.read.parquet(SF + "/documents.parquet")
    columns, kept = docs.columns, {}
    for name, stage in P.STAGES:
        before = {r.doc_id: r.asDict() for r in docs.collect()}
        docs = materialise(stage(spark, docs, SF), name)
        kept[name] = (before, {r.doc_id: r.asDict() for r in docs.collect()})
        assert docs.columns == columns or name == P.STAGES[-1][0]

    before, after = kept["quality"]
    labels = {r.doc_id: r.quality for r in spark.read.parquet(SF + "/labels.parquet").collect()}
    good = [k for k in before if labels.get(k) == 1]
    assert sum(k in after for k in good) >= 0.95 * len(good) and all(before[k] == r for k, r in after.items())

    before, after = kept["lines"]
    bare = lambda text: [x.strip(" \t\r\x0b\x0c") for x in text.split("\n")]
    pages, sites = {}, defaultdict(set)
    for r in before.values():
        page = frozenset(bare(r["text"])) - {""}
        pages[page] = min(pages.get(page, r["source"]), r["source"])
    for page, site in pages.items():
        for line in page:
            sites[line].add(site)
    assert before.keys() == after.keys()
    for k, r in before.items():
        left = [x for x, t in zip(r["text"].split("\n"), bare(r["text"]), strict=True) if len(sites[t]) < P.MIN_SITES]
        assert after[k]["text"] == "\n".join(left)

    before, after = kept["near_duplicates"]
    groups = brute_groups({k: r["text"] for k, r in before.items()}, P.SHINGLE_WORDS)
    assert set(after) == {k for k, g in groups.items() if k == g}

    before, after = kept["benchmark"]
    words = lambda t: re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", t.translate({c: c + 32 for c in range(65, 91)}))
    windows = set()
    for r in spark.read.parquet(SF + "/benchmark.parquet").collect():
        w = words(r.text)
        windows |= {tuple(w[i:i + 13]) for i in range(max(1, len(w) - 12))} if w else set()
    for k, r in before.items():
        w, hit = words(r["text"]), set()
        for size in {len(x) for x in windows}:
            for i in range(len(w) - size + 1):
                if tuple(w[i:i + size]) in windows:
                    hit.update(range(i, i + size))
        assert (k in after) == (not hit or 20 * len(hit) < len(w))

    before, after = kept["tokens"]
    assert before.keys() == after.keys() and all(r["n_tokens"] == len(r["ids"]) > 0 for r in after.values())
    assert P.run(spark, SF).count() == len(after)


def test_empty_and_awkward_documents(spark):
    schema = "doc_id bigint, text string, lang string, source string, n_chars bigint, score string, ids string"
    rows = [(1, None, None, None, None, "s", "i"), (None, "", "en", "a", 0, "s", "i"), (2, "one two three four five six", "en", "a", 27, "s", "i"),
            (2, "one two three four five six", "en", "a", 27, "s", "i"), (None, "one two three four five six", "en", "b", 27, None, None)]
    for some in (rows, []):
        docs = spark.createDataFrame(some, schema)
        for name, stage in P.STAGES:
            docs = materialise(stage(spark, docs, SF), name)
        assert docs.count() <= len(some)
