"""Importance resampling, license scan and tokenizer alignment against plain versions, and on odd rows."""

import hashlib
import math
import random
import re
import zlib
from collections import Counter

import numpy as np
import pytest
from pyspark.sql import functions as F

from tidelake.llm import alignment, importance, license_scan
from tidelake.llm.common import tokenizer_path

NO_WORD = "[\x00-\x2f\x3a-\x60\x7b-\x7f]+"
UPPER = {c: c + 32 for c in range(ord("A"), ord("Z") + 1)}


def words(text):
    return [w for w in re.split(NO_WORD, (text or "").translate(UPPER)) if w]


# importance resampling


def grams(text):
    own = words(text)
    return own + [f"{a} {b}" for a, b in zip(own, own[1:])]


def drawn(docs, target, percent=25):
    s = Counter(zlib.crc32(g.encode()) % 10_000 for _, t in docs for g in grams(t))
    t = Counter(zlib.crc32(g.encode()) % 10_000 for x in target for g in grams(x))
    big, small = float(sum(s.values())), float(sum(t.values()))
    rows = []
    for i, text in docs:
        own = [zlib.crc32(g.encode()) % 10_000 for g in grams(text)]
        gain = [math.floor(1000 * math.log((t[b] + 1) * (big + 10_000) / ((s[b] + 1) * (small + 10_000)))) for b in own]
        weight = sum(gain) // len(own) if own else 0
        h = int(hashlib.sha256(f"7:{'' if i is None else i}".encode()).hexdigest()[:8], 16)
        score = weight + math.floor(-1000 * math.log(-math.log((h + 0.5) / 4294967296)))
        rows.append((i, len(own), weight, score, len(words(text)) >= 20))
    order = sorted((r for r in rows if r[4]), key=lambda r: (-r[3], r[0] is None, r[0] or 0))
    kept = percent * len(order) // 100
    out = [(*r[:4], k + 1 if k < kept else None) for k, r in enumerate(order)]
    return sorted(out + [(*r[:4], None) for r in rows if not r[4]], key=repr)


@pytest.fixture(scope="module")
def sampled(spark):
    rng = random.Random(11)
    vocabulary = [f"{a}{b}" for a in ("ba", "ké", "nu", "do", "Ze") for b in ("ra", "9", "ñi", "X", "lo", "t")]
    docs = [(i, " - ".join(rng.choices(vocabulary, k=rng.choice((5, 19, 20, 21, 60))))) for i in range(120)]
    docs += [(5, docs[5][1]), (5, docs[5][1]), (200, None), (201, ""), (202, "..."), (None, docs[7][1]), (None, docs[8][1])]
    docs += [(300 + i, "alpha beta " * 30) for i in range(5)]
    target = [(i, " ".join(rng.choices(vocabulary[:8], k=40))) for i in range(6)]
    rows = [(i, t, "x", 1) for i, t in docs]
    return docs, target, spark.createDataFrame(rows, "doc_id long, text string, weight string, n int").repartition(3)


def test_drawn_rows_are_those_of_a_plain_version(spark, sampled):
    docs, target, df = sampled
    rows = importance.scored(df, spark.createDataFrame(target, "item_id long, text string"))
    got = importance.ranked(rows).collect()
    assert sorted(map(tuple, got), key=repr) == drawn(docs, [t for _, t in target])


def test_copies_are_ranked_in_steps(spark, sampled, monkeypatch):
    monkeypatch.setattr(importance, "COPIES_A_ROW", 2)
    rows = spark.createDataFrame([(1, 30, 40, 5, 9)] * 7 + [(2, 30, 40, 5, 8)], "doc_id long, n_words long, n_features long, weight long, score long")
    got = sorted(r["rank"] for r in importance.ranked(rows, percent=100).collect())
    assert got == list(range(1, 9))


def test_resampled_rows_keep_their_columns(spark, sampled):
    docs, target, df = sampled
    got = importance.resampled(df, spark.createDataFrame(target, "item_id long, text string"))
    want = Counter((r[0]) for r in drawn(docs, [t for _, t in target]) if r[4])
    assert got.columns == df.columns and Counter(r.doc_id for r in got.collect()) == want
    none = importance.resampled(df.limit(0), spark.createDataFrame([], "item_id long, text string"))
    assert none.collect() == [] and none.columns == df.columns


def test_the_scan_finds_overlapping_runs():
    scanner = importance.GramScanner(3, 1 << 30)
    n, found = scanner(" One,two--THREE é4 \n".encode())
    want = ["one", "two", "three", "é4", "one two", "two three", "three é4", "one two three", "two three é4"]
    assert n == 4 and found.tolist() == [zlib.crc32(g.encode()) % (1 << 30) for g in want]
    assert scanner(b" .. ")[1].size == 0


def test_importance_of_odd_rows(spark, odd_docs, no_docs):
    target = spark.createDataFrame([(1, None), (2, "alpha beta")], "item_id long, text string")
    got = importance.ranked(importance.scored(odd_docs, target)).collect()
    docs = [(r.doc_id, r.text) for r in odd_docs.collect()]
    assert sorted(map(tuple, got), key=repr) == drawn(docs, [None, "alpha beta"])
    assert importance.ranked(importance.scored(no_docs, target.limit(0))).collect() == []


# license scan


def places(text):
    own = words(text)
    found = []
    for label, phrase in license_scan.PHRASES:
        want = phrase.split()
        found += [(i, label) for i in range(len(own)) if own[i : i + len(want)] == want]
    return sorted(found)


LICENSED = [
    (1, "Mit  License, MIT license mit LICENSE cc-by cc by by"),
    (2, "Released under the GNU General Public License; not gnu general license"),
    (3, None),
    (4, ""),
    (5, "mit"),
    (6, "x Permission is hereby granted, free of charge, to any other person obtaining a copy of this software and its "
        "associated documentation files (the Software), to deal in the Software without restriction, y"),
    (7, "permission is hereby granted " + "word " * 300 + "to deal in the software without restriction"),
    (8, "apache license " * 2000),
    (9, "Licensed under the Apache License, Version 2.0. éé mit license"),
]


def test_license_phrases_are_those_of_a_plain_version(spark, odd_docs):
    rows = [(i, t, "l", 1) for i, t in [*LICENSED, LICENSED[0], (1, "another mit license"), (None, "cc by"), (None, "cc by")]]
    df = spark.createDataFrame(rows, "doc_id long, text string, label string, at int").repartition(3)
    for docs in (df, odd_docs.select("doc_id", "text", F.col("kept").alias("place"))):
        got = [
            (r.doc_id, r.n_words, sorted((s.start, s.label) for s in r.spans if s.phrase))
            for r in license_scan.scanned(docs).collect()
        ]
        want = sorted(((r.doc_id, len(words(r.text)), places(r.text)) for r in docs.collect()), key=repr)
        assert sorted(got, key=repr) == want


def test_notices_survive_other_words_but_not_scattered_ones(spark):
    df = spark.createDataFrame(LICENSED, "doc_id long, text string")
    got = {r.doc_id: r.spans for r in license_scan.scanned(df).collect()}
    notice = [s for s in got[6] if not s.phrase]
    # Two words were put in or changed: three diagonals of one template are one span.
    assert [(s.label, s.start, s.end) for s in notice] == [("mit", 1, 32)] and 0.5 <= notice[0].share < 1
    assert got[7] == [] and len(got[8]) == 2000 and all(s.label == "apache" for s in got[8])
    assert {s.label for s in got[9]} == {"apache", "apache-2.0", "mit"}
    assert max(s.share for s in got[9]) == 1.0


def test_license_scan_of_no_rows_and_own_templates(spark, no_docs):
    assert license_scan.scanned(no_docs).collect() == []
    df = spark.createDataFrame([(1, "all rights reserved, ALL rights"), (2, "none")], "doc_id long, text string")
    got = {r.doc_id: [(s.label, s.start) for s in r.spans] for r in license_scan.scanned(df, [("arr", "all rights")]).collect()}
    assert got == {1: [("arr", 0), ("arr", 3)], 2: []}
    assert sorted((r.doc_id, r.n_words) for r in license_scan.scanned(df, []).collect()) == [(1, 5), (2, 1)]
    with pytest.raises(ValueError):
        license_scan.scanned(df, [("one", "word")])


# tokenizer alignment


PATHS = tokenizer_path("byte_bpe_50k.json"), tokenizer_path("piece_bpe_32k.model")


@pytest.fixture(scope="module")
def encoders():
    return alignment.Encoders(*PATHS)


def whole(text, encoders):
    """(a ids, b ids, groups, links) by walking byte by byte."""
    if not text:
        return None
    (ids,) = encoders([text])
    if ids is None:
        return None
    groups, links, a, b, i, j, x, y = [], [], *ids, 0, 0, 0, 0
    open_a, open_b = [], []
    while i < len(a) or j < len(b):
        if x <= y:
            open_a.append(int(a[i]))
            x += len(encoders.a_vocabulary.pieces[a[i]])
            i += 1
        else:
            open_b.append(int(b[j]))
            y += len(encoders.b_vocabulary.pieces[b[j]])
            j += 1
        if x == y and open_b:
            groups.append((open_a, open_b))
            links.append((open_a[-1], open_b[-1]))
            open_a, open_b = [], []
    assert not open_a and not open_b
    return len(a), len(b), groups, links


def plain_alignment(docs, encoders):
    made = [(i, whole(t, encoders)) for i, t in docs]
    count = Counter(p for _, m in made if m for p in m[3])
    best = {}
    for (_, b), n in count.items():
        best[b] = max(best.get(b, 0), n)
    out = []
    for i, m in made:
        if m is None:
            out.append((i, 0, 0, 0, 0, 0, 0, ""))
            continue
        n_a, n_b, groups, links = m
        text = ";".join(f"{','.join(map(str, a))}|{','.join(map(str, b))}" for a, b in groups)
        digest = hashlib.sha256(text.encode()).hexdigest()
        top = sum(count[p] == best[p[1]] for p in links)
        out.append((i, n_a, n_b, len(groups), len(links), top, sum(count[p] for p in links), digest))
    return sorted(out, key=repr)


ODD = [
    (1, "Straße déjà vu — naïve façade 東京都 🦊🦊 <|endoftext|> <s> </s> [INST]"),
    (2, "tabs\tand\n\nnew  lines   and    spaces   ok"),
    (3, "literal ▁ mark"),
    (4, None),
    (5, ""),
    (6, " leading and trailing "),
    (7, "x" * 3000),
    (8, "\x00\x01 control \x1f bytes"),
    (9, "long text with many words and numbers 12345 " * 60),
    (9, "long text with many words and numbers 12345 " * 60),
    (None, "no id"),
    (10, "longer ▁ mark " * 90),
    (11, "mixed  double  spaces  " * 50),
    (12, "東京都に住んでいます。" * 90),
]


@pytest.mark.parametrize("longest,width,frequent", [(alignment.LONG, alignment.RANGE, 1 << 20), (200, 37, 40), (64, 5, 0), (2_000, 500, 1)])
def test_alignment_is_that_of_a_plain_version(spark, encoders, longest, width, frequent):
    rows = [(i, t, 1, "r") for i, t in ODD]
    df = spark.createDataFrame(rows, "doc_id long, text string, n_a int, row string").repartition(3)
    got = alignment.counted(alignment.aligned(df, *PATHS, longest, width), frequent)
    columns = ["doc_id", "n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum", "groups_sha256"]
    assert sorted(map(tuple, got.select(columns).collect()), key=repr) == plain_alignment(ODD, encoders)


def test_fragments_compose_associatively(encoders):
    rng = np.random.default_rng(3)
    text = " ".join(t for _, t in ODD if t and "▁" not in t)[:4000]
    ((a, b),) = encoders([text])
    a_ends, b_ends = np.cumsum(encoders.a_sizes[a]), np.cumsum(encoders.b_sizes[b])
    one = alignment.fragment(a, b, a_ends, b_ends)
    for _ in range(20):
        edges = np.sort(rng.integers(0, a_ends[-1], 6)).tolist() + [int(a_ends[-1])]
        parts, i, j = [alignment.EMPTY], 0, 0
        for e in edges:
            k, m = np.searchsorted(a_ends, e, "right"), np.searchsorted(b_ends, e, "right")
            parts.append(alignment.fragment(a[i:k], b[j:m], a_ends[i:k], b_ends[j:m]))
            i, j = k, m
        left, right = parts[0], parts[-1]
        for p in parts[1:]:
            left = alignment.composed(left, p)
        for p in parts[-2::-1]:
            right = alignment.composed(p, right)
        for made in (left, right, alignment.reduced(parts)):
            assert alignment.groups_of(made) == alignment.groups_of(one) and made.cuts == one.cuts
            assert made.links.tolist() == one.links.tolist() and not len(made.suffix[0])


def test_parts_are_encoded_as_the_whole(encoders):
    for _, text in ODD:
        if text and "▁" not in text:
            parts = alignment._cut(text, 50)
            assert "".join(parts) == text
            ids = list(encoders([p[1:] if i else p for i, p in enumerate(parts)]))
            ((a, b),) = encoders([text])
            assert np.concatenate([x for x, _ in ids]).tolist() == a.tolist()
            assert np.concatenate([y for _, y in ids]).tolist() == b.tolist()


def test_alignment_of_odd_rows(spark, encoders, odd_docs, no_docs):
    got = alignment.counted(alignment.aligned(odd_docs, *PATHS))
    docs = [(r.doc_id, r.text) for r in odd_docs.collect()]
    columns = ["doc_id", "n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum", "groups_sha256"]
    assert sorted(map(tuple, got.select(columns).collect()), key=repr) == plain_alignment(docs, encoders)
    assert alignment.counted(alignment.aligned(no_docs, *PATHS)).collect() == []
