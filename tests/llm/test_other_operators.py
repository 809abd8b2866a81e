"""Operators on embeddings and pages against plain versions, and on odd rows; the pipeline."""

import random

import brute
import numpy as np
import pytest
from pyspark.sql import functions as F

from tidelake.llm import neighbours, url_filter, warc
from tidelake.llm.common import connected, table
from tidelake.llm.queries import QUERIES, URL_RULES
from tidelake.session import scratch_dir


def test_components_of_random_edges(spark):
    rng = random.Random(8)
    edges = [(rng.randrange(300), rng.randrange(300)) for _ in range(220)] + [(k, k + 1) for k in range(400, 440)]
    parent = {n: n for e in edges for n in e}

    def find(n):
        while parent[n] != n:
            n = parent[n]
        return n

    for a, b in edges:
        a, b = find(a), find(b)
        parent[max(a, b)] = min(a, b)
    got = connected(spark.createDataFrame(edges, "a long, b long"), "test").collect()
    want = {n: find(n) for a, b in edges if a != b for n in (a, b)}
    assert {r.node: r.component for r in got} == want and len(got) == len(want)


# nearest neighbours


def exact(vectors, queries, k):
    out = {}
    for q in queries:
        near = []
        for i, v in vectors.items():
            if i != q:
                a, b = np.array(v, float), np.array(vectors[q], float)
                near.append((-(a @ b) / np.sqrt((a @ a) * (b @ b)), i))
        out[q] = sorted(near)[:k]
    return out


@pytest.mark.parametrize("folder", ["sf0.01"])
def test_recall_against_brute_force(spark, folder):
    sf_dir = f"/root/testdata/{folder}"
    vectors = {r.vec_id: r.embedding for r in table(spark, sf_dir, "embeddings").collect()}
    want = exact(vectors, [i for i in vectors if i % 50 == 0], 5)
    hits = total = 0
    got = {}
    for r in QUERIES["op6_neighbours"](spark, sf_dir).collect():
        got.setdefault(r.query_id, []).append(r)
    assert set(got) == set(want)
    for q, near in want.items():
        rows = sorted(got[q], key=lambda r: r["rank"])
        assert [r["rank"] for r in rows] == [1, 2, 3, 4, 5]
        for r in rows:
            a, b = np.array(vectors[q], float), np.array(vectors[r.vec_id], float)
            assert r.score == pytest.approx((a @ b) / np.sqrt((a @ a) * (b @ b)), abs=1e-12)
        assert [(-r.score, r.vec_id) for r in rows] == sorted((-r.score, r.vec_id) for r in rows)
        hits += len({i for _, i in near} & {r.vec_id for r in rows})
        total += 5
    assert hits / total >= 0.9


def test_neighbours_of_odd_rows(spark):
    nan, inf = float("nan"), float("inf")
    rows = [(0, [1.0, 0.0, 0.0]), (1, [1.0, 0.0, 0.0]), (2, [1.0, 0.0, 0.0]), (3, [2.0, 0.0, 0.0]), (4, [0.9, 0.1, 0.0])]
    rows += [(5, [0.0, 0.0, 0.0]), (6, None), (7, [1.0, None, 0.0]), (8, [nan, 1.0, 0.0]), (9, [inf, 0.0, 0.0]), (10, [1.0])]
    rows += [(100, [0.0, 1.0, 0.0]), (None, [1.0, 0.0, 0.0]), (0, [1.0, 0.0, 0.0])]
    df = spark.createDataFrame([(i, v, "x") for i, v in rows], "vec_id long, embedding array<float>, cid string")
    got = neighbours.nearest(df, F.col("vec_id") % 50 == 0, recall=0.999999).collect()
    by = {q: [r.vec_id for r in sorted(got, key=lambda r: r["rank"]) if r.query_id == q] for q in (0, 100)}
    assert by[0] == [1, 2, 3, 4, 100] and len(by[100]) == 5 and {r.query_id for r in got} == {0, 100}
    assert neighbours.nearest(df.limit(0), F.col("vec_id") % 50 == 0).collect() == []


# URL filter


def split_url(url):
    if not url or "://" not in url:
        return "", ""
    rest = url.split("://", 1)[1]
    cut = min([rest.find(c) for c in "/?#" if c in rest], default=len(rest))
    host, rest = rest[:cut], rest[cut:]
    cut = min([rest.find(c) for c in "?#" if c in rest], default=len(rest))
    return "".join(c.lower() if c.isascii() else c for c in host), rest[:cut]


def rule_of(host, path):
    fits = []
    for verdict, rule in URL_RULES:
        domain, start = rule.split("/", 1)
        if (host == domain or host.endswith("." + domain)) and path.startswith("/" + start):
            fits.append((len(rule), rule, verdict))
    return max(fits)[1:] if fits else (None, None)


URLS = [
    None, "", "no scheme", "://", "http://EXAMPLE.com/en/1?x", "http://www.example.com/en/", "http://a.b.net/es/", "http://net/fr/x",
    "http://x.com", "http://x.com?a/b", "HTTP://Ä.COM/#f", "a://b://c/d", "http://planet/es/", "http://cheapspam.org/x", "http://q.org/\n/y",
]


def test_hosts_paths_and_rules(spark, sf_dir):
    pages = [(r.page_id, r.url) for r in table(spark, sf_dir, "pages").collect()]
    odd = spark.createDataFrame([(i, u, "<b>spam cheap</b>", "h") for i, u in enumerate(URLS)], "page_id long, url string, html string, host string")
    for rows, urls in ((QUERIES["op8_url_filter"](spark, sf_dir).collect(), pages), (url_filter.judged(odd, URL_RULES).collect(), list(enumerate(URLS)))):
        got = {r.page_id: r for r in rows}
        assert len(got) == len(urls)
        for i, url in urls:
            host, path = split_url(url)
            rule, verdict = rule_of(host, path)
            assert (got[i].host, got[i].path, got[i].rule) == (host, path, rule), url
            assert got[i].verdict in ("allow", "block") and verdict in (None, got[i].verdict)
    assert url_filter.judged(odd.limit(0), URL_RULES).collect() == []


def test_model_learns_from_blocked_words(spark):
    rows = [(i, f"http://spamfarm{'abc'[i % 3]}.org/x/{i}") for i in range(30)]
    rows += [(100 + i, f"http://gooddesk{'abc'[i % 3]}.org/y/{i}") for i in range(60)] + [(900, "http://farmspam.org/x/1"), (901, "http://farm.org/x/1")]
    html = "<p>" + "spam farm good desk " * 50 + "</p>"
    pages = spark.createDataFrame([(i, u, html) for i, u in rows], "page_id long, url string, html string")
    got = {r.page_id: r for r in url_filter.judged(pages, ()).collect()}
    assert got[900].verdict == "block" and got[900].tokens[:2] == ["h:farm", "h:spam"]
    assert got[901].verdict == "block" and all(got[100 + i].verdict == "allow" for i in range(60))


def test_segmentation_is_the_most_probable():
    import itertools
    import math

    counts = {"cheap": 5, "pills": 4, "she": 3, "ap": 1, "he": 9, "pill": 2, "s": 1}
    split = url_filter.Segmenter(counts)

    def score(words):
        return sum(split.logs.get(w, split.unknown(len(w))) for w in words)

    for name in ("cheappills", "shepills", "xqzheap", "s", ""):
        ways = []
        for marks in itertools.product([0, 1], repeat=max(0, len(name) - 1)):
            words, at = [], 0
            for k, mark in enumerate(marks, 1):
                if mark:
                    words.append(name[at:k])
                    at = k
            ways.append(score([*words, name[at:]] if name else []))
        assert math.isclose(score(split(name)), max(ways))
    assert split("cheappills") == ["cheap", "pills"]


@pytest.mark.parametrize("broadcast_rows", [0, 200_000])
def test_rare_and_unseen_words_cut_hosts(spark, monkeypatch, broadcast_rows):
    from tidelake.llm import common

    monkeypatch.setattr(common, "BROADCAST_ROWS", broadcast_rows)
    letters = "translate(cast({} as string), '0123456789', 'abcdefghij')".format
    many = spark.range(60).selectExpr("id as page_id", "'http://x.org/' as url", f"array_join(transform(sequence(id * 1000, id * 1000 + 999), k -> concat('q', {letters('k')}, ' q', {letters('k')})), ' ') as html")
    rows = [(100, "http://zebravalley.org/x", "zebra valley"), (101, "http://malwarefarm.org/x", "malw are are farm"), (102, None, None)]
    pages = many.unionByName(spark.createDataFrame(rows, "page_id long, url string, html string"))
    got = {r.page_id: r for r in url_filter.judged(pages, ()).collect()}
    assert len(got) == 63 and got[102].tokens == []
    assert got[100].tokens[:2] == ["h:zebra", "h:valley"]
    assert got[101].tokens[:2] == ["h:malware", "h:farm"] and got[101].score > got[100].score


@pytest.mark.parametrize("broadcast_rows", [0, 200_000])
def test_rare_tokens_weigh_beside_many_common_ones(spark, monkeypatch, broadcast_rows):
    import math
    from collections import Counter

    from tidelake.llm import common

    monkeypatch.setattr(common, "BROADCAST_ROWS", broadcast_rows)
    path = "array_join(transform(sequence(id % 101 * 1000, id % 101 * 1000 + 999), k -> concat('t', k)), '/')"
    many = spark.range(202).selectExpr("id as page_id", f"concat('http://good.org/', {path}) as url", "'good spam farm' as html")
    urls = [(900, "http://spamfarm.org/rare"), (901, "http://farm.net/rare/rare"), (902, "http://farm.net/rare/rare"), (903, None)]
    pages = many.unionByName(spark.createDataFrame([(i, u, "good") for i, u in urls], "page_id long, url string, html string"))
    got = {r.page_id: r for r in url_filter.judged(pages, ()).collect()}
    assert len(got) == 206
    counts, sizes = {True: Counter(), False: Counter()}, Counter()
    for r in got.values():
        counts["h:spam" in r.tokens].update(r.tokens)
        sizes["h:spam" in r.tokens] += 1
    n = len(counts[True] | counts[False])
    assert n > 101_000 and sizes[True] == 1
    totals = {kind: own.total() + n for kind, own in counts.items()}

    def log(kind, token):
        return math.log((counts[kind][token] + 1) / totals[kind])

    for r in got.values():
        want = math.log(sizes[True] / sizes[False]) + sum(log(True, t) - log(False, t) for t in r.tokens)
        assert r.score == pytest.approx(want, abs=1e-6) and r.verdict == ("block" if want > 0 else "allow")


# WARC


def want_records(pages):
    first, out = {}, {}
    for i, html in sorted(pages):
        data = (html or "").encode()
        digest = brute.digest32(data)
        head = first.setdefault(digest, i)
        out[i] = (len(data), digest, "response" if head == i else "revisit", None if head == i else head)
    return out


def test_archive_query(spark, sf_dir):
    pages = [(r.page_id, r.html) for r in table(spark, sf_dir, "pages").collect()]
    rows = QUERIES["op10_warc"](spark, sf_dir).collect()
    assert {r.page_id: (r.payload_bytes, r.payload_digest, r.record_type, r.refers_to) for r in rows} == want_records(pages)


def test_archives_of_odd_pages(spark):
    pages = [(1, None, "é" * 1000), (2, "u\r\nX: y", ""), (3, "u", None), (4, "u", "é" * 1000), (5, "u", "\r\n\r\nWARC/1.1\r\n" * 40)]
    pages += [(6, "u", "0\r\n\r\n"), (7, "u", "𝄞" * 700 + "x"), (4, "u", "é" * 1000)]
    df = spark.createDataFrame([(*p, "z") for p in pages], "page_id long, url string, html string, first string")
    path = scratch_dir(spark, "warc-test")
    warc.write_archives(df, path, segment_bytes=500)
    rows = warc.read_archives(spark, path).collect()
    assert len(rows) == len(pages) and all(r.complete for r in rows)
    want, texts = want_records([(i, h) for i, _, h in pages]), {i: h or "" for i, _, h in pages}
    for r in rows:
        assert (r.payload_digest, r.record_type, r.refers_to) == want[r.page_id][1:]
        assert r.record_type == "revisit" or r.payload.decode() == texts[r.page_id]
    empty = scratch_dir(spark, "warc-empty")
    warc.write_archives(df.limit(0), empty)
    assert warc.read_archives(spark, empty).collect() == []


def test_long_payloads_of_repeated_and_missing_ids(spark):
    texts = [c * 3000 for c in "abcdefg"]
    pages = [(1, texts[0]), (1, texts[0]), (2, texts[1]), (2, texts[2]), (None, texts[3]), (None, texts[4]), (None, texts[4])]
    pages += [(3, texts[5]), (4, texts[5]), (None, texts[5]), (5, texts[0]), (6, texts[6])]
    df = spark.createDataFrame([(i, "u", t) for i, t in pages], "page_id long, url string, html string")
    path = scratch_dir(spark, "warc-repeated")
    warc.write_archives(df, path, segment_bytes=500)
    rows = warc.read_archives(spark, path).collect()
    assert all(r.complete for r in rows)
    key = lambda x: (x[0] is None, x)
    got = sorted(((r.page_id, r.payload.decode()) for r in rows if r.record_type == "response"), key=key)
    assert got == sorted([p for p in pages if p[0] not in (4, 5) and p != (None, texts[5])], key=key)
    revisits = [(r.page_id, r.refers_to, r.payload_digest) for r in rows if r.record_type == "revisit"]
    digests = [brute.digest32(t.encode()) for t in texts]
    assert sorted(revisits, key=key) == [(4, 3, digests[5]), (5, 1, digests[0]), (None, 3, digests[5])]
    files = [r.content for r in spark.read.format("binaryFile").load(path).select("content").collect()]
    fields = [f for data in files for f, _ in warc.records_in(warc.gunzipped(data))]
    ids = [f["warc-record-id"] for f in fields]
    assert len(ids) == len(set(ids)) and {f["warc-refers-to"] for f in fields if "warc-refers-to" in f} <= set(ids)


def test_segments_are_put_together_in_one_pass_over_a_task(spark):
    """A call for each record costs more than the record; segments of one come together and in order."""
    html = {i: "".join(chr(97 + (i * j) % 26) for j in range(100 + 700 * i)) for i in range(40)}
    df = spark.createDataFrame([(i, f"http://a.com/{i}", t) for i, t in html.items()], "page_id long, url string, html string")
    path = scratch_dir(spark, "warc-segments")
    warc.write_archives(df.repartition(5), path, segment_bytes=300)
    read = warc.read_archives(spark, path)
    assert "FlatMapGroupsInArrow" not in read._jdf.queryExecution().executedPlan().toString()
    assert {r.page_id: bytes(r.payload).decode() for r in read.collect() if r.complete} == html
    parts = {n: {"page_id": 1, "uri": "", "digest": None, "segment": n, "total": 10 if n == 3 else None, "block": b"x"} for n in (1, 3)}
    assert warc._reassemble(parts)[-1] is False



def test_damaged_records_are_told(spark):
    import pyarrow as pa

    def segments(*parts):
        return pa.Table.from_pylist(
            [{"origin": "<urn:page:1>", "uri": "u", "digest": None, "segment": k, "total": t, "block": b} for k, t, b in parts]
        )

    block = b"HTTP/1.1 200 OK\r\nTransfer-Encoding: chunked\r\n\r\n" + warc.chunked(b"abc" * 9, 5)
    whole = warc._reassemble(segments((2, len(block), block[20:]), (1, None, block[:20]))).to_pylist()[0]
    assert whole["payload"] == b"abc" * 9 and whole["complete"]
    assert not warc._reassemble(segments((2, 7, block[20:]), (1, None, block[:20]))).to_pylist()[0]["complete"]
    assert not warc._reassemble(segments((3, len(block), block[20:]), (1, None, block[:20]))).to_pylist()[0]["complete"]
    with pytest.raises(ValueError):
        warc.unchunked(b"5\r\nab")


# pipeline


def test_pipeline_stage_by_stage(spark, sf_dir):
    import corpus_pipeline as cp
    from test_text_operators import check_packing

    from tidelake.llm import pii, quality
    from tidelake.llm.common import saved

    docs = table(spark, sf_dir, "documents")
    columns, at = docs.columns, {}
    for name, stage in cp.STAGES:
        docs = saved(stage(spark, docs, sf_dir), "pipeline-test")
        at[name] = docs
        if name != "packing":
            assert docs.columns == columns
            assert docs.filter("n_chars != length(text)").count() == 0
    before = table(spark, sf_dir, "documents")
    judged = {r.doc_id: r.keep for r in quality.judged(before, table(spark, sf_dir, "labels")).collect()}
    good = {r.doc_id: r.text for r in at["quality classifier"].collect()}
    assert set(good) == {i for i, keep in judged.items() if keep}
    groups = brute.components(list(good.items()))
    one = {r.doc_id: r.text for r in at["n-gram Jaccard join"].collect()}
    assert one == {i: t for i, t in good.items() if groups[i][1] == i}
    cut = {r.doc_id: r.text for r in at["suffix-array dedup"].collect()}
    assert cut == {i: kept.decode("utf-8", "ignore") for i, (_, kept) in brute.repeats(list(one.items())).items()}
    clean = {r.doc_id: r.text for r in at["PII"].collect()}
    assert set(clean) == set(cut)
    for i, text in cut.items():
        base = brute.fixed_forms(text)
        assert (clean[i] == text) or base or "[ID]" in clean[i]
        assert not base or clean[i] == pii.redacted(text, base) or "[ID]" in clean[i]
    rows = at["packing"].withColumn("ids_crc32", F.crc32("ids")).collect()
    check_packing(rows, list(clean.items()))


def test_pipeline_on_odd_rows(spark, odd_docs, no_docs, sf_dir):
    import corpus_pipeline as cp

    for docs in (odd_docs, no_docs):
        for name, stage in cp.STAGES[:-1]:
            out = stage(spark, docs, sf_dir)
            assert out.columns == docs.columns
            docs = spark.createDataFrame(out.collect(), docs.schema)
        assert docs.filter("doc_id is not null").count() == docs.select("doc_id").filter("doc_id is not null").distinct().count()


def test_pipeline_keeps_a_clean_text_whose_doc_id_repeats(spark, sf_dir):
    import corpus_pipeline as cp

    first = "a passage about rivers and mountains that an early document has in full length here"
    clean = "quite another thing written once only by somebody who shares a number with a copy of it"
    rows = [
        (1, first, "s"), (7, first, "s"), (7, clean, "s"), (7, clean, "s"), (7, clean + " indeed", "s"),
        (9, "words of a third text that nobody else in this small table has ever used before", "s"), (None, first, "s"),
    ]
    docs = spark.createDataFrame(rows, "doc_id long, text string, component string")
    got = cp.keep_one_of_similar(spark, docs, sf_dir)
    kept = sorted(((r.doc_id, r.text) for r in got.collect()), key=repr)
    assert got.columns == docs.columns
    assert [i for i, _ in kept] == [1, 7, 9, None] and kept[1][1] in (clean, clean + " indeed")


def test_segments_carry_rows_of_the_given_pages(spark, sf_dir):
    path = scratch_dir(spark, "warc-segments")
    pages = table(spark, sf_dir, "pages")
    warc.write_archives(pages, path, segment_bytes=2 << 10)
    files = spark.read.format("binaryFile").load(path).select("content")
    parts = warc.arrow_map(files, warc._parse(True), warc.SEGMENT, rows=1)
    assert parts.select("origin").distinct().count() > pages.count() / 10
    read = {r.page_id: r for r in warc.read_archives(spark, path).filter("record_type = 'response'").collect()}
    want = {r.page_id: r.html for r in pages.collect()}
    assert all(r.complete and r.payload.decode() == want[i] for i, r in read.items())
