"""Operators on documents against plain versions, and on odd rows."""

import hashlib
import random
import zlib
from collections import Counter

import brute
import numpy as np
import pytest
from pyspark.sql import functions as F

from tidelake.llm import fingerprints, jaccard_join, packing, pii, quality, sentencepiece_codec, suffix_dedup
from tidelake.llm.common import table, tokenizer_path
from tidelake.llm.queries import QUERIES


@pytest.fixture(scope="module")
def docs(spark, sf_dir):
    return [(r.doc_id, r.text) for r in table(spark, sf_dir, "documents").select("doc_id", "text").collect()]


# n-gram Jaccard join


def test_components_equal_brute_force(spark, sf_dir, docs):
    got = {r.doc_id: (r.n_shingles, r.component_id) for r in QUERIES["op1_jaccard_join"](spark, sf_dir).collect()}
    assert got == brute.components(docs)


def test_large_and_salted_lists_lose_no_link(spark, monkeypatch):
    monkeypatch.setattr(jaccard_join, "SMALL_LIST", 1)
    monkeypatch.setattr(jaccard_join, "SALTED_LIST", 3)
    monkeypatch.setattr(jaccard_join, "WIDESPREAD", 2)
    rng = random.Random(5)
    vocabulary = [f"v{k}" for k in range(400)]
    rows, base = [], [[rng.choice(vocabulary) for _ in range(60)] for _ in range(6)]
    for i in range(120):
        own = list(base[i % 6])
        for _ in range(rng.choice([0, 1, 2, 3, 5])):
            own[rng.randrange(60)] = rng.choice(vocabulary)
        rows.append((i, " ".join(own)))
    got = jaccard_join.similar_components(spark.createDataFrame(rows, "doc_id long, text string").repartition(3))
    assert {r.doc_id: (r.n_shingles, r.component_id) for r in got.collect()} == brute.components(rows)


def near_copies(count, seed=3):
    """A text of 220 words and copies of it with 3 to 13 words changed, each by words of its own."""
    rng = random.Random(seed)
    base = [f"b{rng.randrange(5000)}" for _ in range(220)]
    rows = []
    for i in range(count):
        own = list(base)
        for at in rng.sample(range(220), rng.randrange(3, 14)):
            own[at] = f"own{i}x{at}"
        rows.append((i, " ".join(own)))
    return rows


def test_few_pairs_of_near_copies_are_compared(spark, monkeypatch):
    """Copies that differ too much from each other are mostly ruled out by what their prefixes leave to share."""
    made = {}

    def counted(df, label):
        made[label] = made.get(label, 0) + (out := keep(df, label)).count()
        return out

    keep = jaccard_join.saved
    monkeypatch.setattr(jaccard_join, "saved", counted)
    rows = near_copies(400)
    df = spark.createDataFrame(rows, "doc_id long, text string").repartition(3)
    got = {r.doc_id: (r.n_shingles, r.component_id) for r in jaccard_join.similar_components(df).collect()}
    assert got == brute.components(rows)
    compared = made["jaccard-overlaps"] + made["jaccard-leaders"] + made["jaccard-open"]
    assert compared < 0.12 * 400 * 399 / 2 and made["jaccard-unsure"] < 400


def test_a_component_of_most_rows_is_named_like_the_others(spark):
    rows = [(i, "one text that most of the rows have in common") for i in range(60)]
    rows += [(100 + i, f"text number {i // 2} of a pair of its own and no other") for i in range(10)]
    rows += [(200, None), (201, ""), (None, rows[0][1])]
    df = spark.createDataFrame(rows, "doc_id long, text string").repartition(4)
    got = jaccard_join.similar_components(df).collect()
    want = brute.components([r for r in rows if r[0] is not None])
    assert {r.doc_id: r.component_id for r in got if r.doc_id is not None} == {i: c for i, (_, c) in want.items()}
    assert len(got) == len(rows)


def test_components_of_odd_rows(odd_docs, no_docs, texts):
    rows = jaccard_join.similar_components(odd_docs).collect()
    assert len(rows) == len(texts) + 3
    want = brute.components(texts)
    assert all((r.n_shingles, r.component_id) == want[r.doc_id] for r in rows if r.doc_id is not None)
    assert [r.component_id for r in rows if r.doc_id is None] == [None, None]
    assert want[9][1] == 8 and want[7][1] == 6 and want[4] == (0, 4)
    assert jaccard_join.similar_components(no_docs).collect() == []


# sentencepiece


def as_unigram(path):
    """The same pieces and scores as a unigram model, for the library's own lattice."""
    raw = open(path, "rb").read()

    def varint(data, at):
        value = shift = 0
        while True:
            byte = data[at]
            at, value, shift = at + 1, value | (byte & 127) << shift, shift + 7
            if byte < 128:
                return value, at

    def size(n):
        out = bytearray()
        while n > 127:
            out.append(n & 127 | 128)
            n >>= 7
        return bytes([*out, n])

    out, at = b"", 0
    while at < len(raw):
        start = at
        key, at = varint(raw, at)
        if key & 7 == 2:
            n, at = varint(raw, at)
            body, at = raw[at : at + n], at + n
            if key >> 3 == 2:  # the trainer's settings, to which the kind of model belongs
                body += bytes([3 << 3, 1])
                out += raw[start : start + 1] + size(len(body)) + body
                continue
        out += raw[start:at]
    return out


def test_pieces_are_those_of_the_lattice_over_the_same_scores(docs):
    from sentencepiece import SentencePieceProcessor

    path = tokenizer_path("piece_bpe_32k.model")
    codec, model = sentencepiece_codec.Codec(path), SentencePieceProcessor(model_proto=as_unigram(path))
    odd = ["naïve", "日本語", "x\ny", "😀a", "▁", "wordsofnospace" * 3]
    for word in odd + sorted({w for _, t in docs[:60] for w in t.split()})[:800]:
        assert codec.encode(word) == model.nbest_encode_as_ids(word, 2)[0], word


def test_pieces_give_the_text_back(odd_docs, no_docs, texts):
    path = tokenizer_path("piece_bpe_32k.model")
    ids = sentencepiece_codec.encoded(odd_docs, path)
    back = sentencepiece_codec.decoded(ids, path).collect()
    assert len(back) == len(texts) + 3
    assert all((dict(texts)[r.doc_id] or "") == r.text for r in back if r.doc_id is not None)
    assert sentencepiece_codec.encoded(no_docs, path).collect() == []
    codec = sentencepiece_codec.Codec(path)
    rng = random.Random(2)
    for _ in range(300):
        text = "".join(rng.choice("ab \n\tñ▁é😀x'") for _ in range(rng.randrange(30))).replace("▁", "")
        assert codec.decode(codec.encode(text)) == text


def test_piece_query_covers_every_document(spark, sf_dir, docs):
    rows = QUERIES["op2_sentencepiece"](spark, sf_dir).collect()
    assert len(rows) == len(docs) and all(r.restored and r.n_pieces == len(r.ids) for r in rows)


# fingerprints


def test_fingerprints_of_documents_and_their_edits(spark, sf_dir, docs):
    rows = {r.doc_id: r for r in QUERIES["op3_fingerprints"](spark, sf_dir).collect()}
    edits, errors = brute.edited(docs), []
    for i, text in docs:
        assert rows[i].n_chars == len(text)
        assert rows[i].edited_sha256 == hashlib.sha256(edits[i].encode()).hexdigest()
        a, b = brute.shingles(text), brute.shingles(edits[i])
        errors.append(abs(rows[i].near_edited - len(a & b) / len(a | b)))
    assert max(errors) < 0.2 and np.mean(errors) < 0.04
    by_text = {t: rows[i].fingerprint for i, t in docs}
    assert all(rows[i].fingerprint == by_text[t] for i, t in docs)


def test_fingerprints_of_odd_rows(odd_docs, no_docs, texts):
    rows = fingerprints.edited_fingerprints(odd_docs).collect()
    assert len(rows) == len(texts) + 3
    assert {r.doc_id: r.n_chars for r in rows if r.doc_id} == {i: len(t or "") for i, t in texts}
    assert all(r.sketch == [] for r in rows if r.doc_id in (3, 4, 5))
    assert fingerprints.edited_fingerprints(no_docs).collect() == []


def test_many_rows_without_id_are_in_bins_of_their_own(spark, monkeypatch):
    monkeypatch.setattr(fingerprints, "BIN_ROWS", 10)
    rows = [(i, f"text of the document {i} " * 9) for i in range(60)] + [(None, f"nameless text {i} " * 7) for i in range(90)]
    docs = spark.createDataFrame(rows, "doc_id long, text string").repartition(4)
    binned = fingerprints._binned(docs.withColumn("th", F.xxhash64("text")), 10)
    sizes = {r.bin: r["count"] for r in binned.groupBy("bin").count().collect()}
    assert sum(n for b, n in sizes.items() if b < 0) == 90 and max(n for b, n in sizes.items() if b < 0) < 30
    # The order is that of one bin: ids falling, then rows without id by their hash.
    hashes = {r.text: r.th for r in docs.select("text", F.xxhash64("text").alias("th")).collect()}
    order = sorted(rows, key=lambda r: (r[0] is None, -(r[0] or 0), hashes[r[1]] >> 1, hashes[r[1]]))
    want = Counter()
    for (i, text), (_, after) in zip(order, order[1:] + order[:1]):
        n = len(text) // 3
        want[i, text[: len(text) - n] + after[:n]] += 1
    got = Counter((r.doc_id, r.edited) for r in fingerprints.edited_fingerprints(docs).collect())
    assert got == want


def test_sketches_merge_and_estimate(spark):
    from pyspark.sql import functions as F

    parts = [" ".join(f"t{i}" for i in range(a, b)) for a, b in ((0, 3000), (1500, 4500), (0, 3000))]
    df = spark.createDataFrame([(k, "g", t) for k, t in enumerate(parts)], "k int, g string, text string")
    df = df.withColumn("sketch", fingerprints.sketch(F.col("text")))
    a, b, c = (r.sketch for r in df.orderBy("k").collect())
    assert a == c
    both = fingerprints.merge_sketches(df, ["g"], "sketch").first().sketch
    pair = spark.createDataFrame([(a, b, both)], "a array<long>, b array<long>, both array<long>")
    row = pair.select(
        (fingerprints.merged(F.col("a"), F.col("b")) == F.col("both")).alias("same"),
        fingerprints.resemblance(F.col("a"), F.col("b")).alias("like"),
        fingerprints.containment(F.col("a"), F.col("b")).alias("part"),
        fingerprints.distinct_shingles(F.col("both")).alias("n"),
    ).first()
    assert row.same and abs(row.like - 1 / 3) < 0.15 and abs(row.part - 0.5) < 0.25 and abs(row.n / 4496 - 1) < 0.35


# suffix-array dedup


def test_suffix_arrays_and_common_prefixes():
    rng = np.random.default_rng(7)
    segments = [bytes(rng.integers(97, 99, rng.integers(1, 50)).astype(np.uint8)) for _ in range(25)] + [b"ab" * 30] * 2
    sizes = np.array([len(s) for s in segments])
    ends = np.cumsum(sizes + 1) - 1
    symbols = np.zeros(sizes.sum() + len(segments), np.int16)
    symbols[np.arange(sizes.sum()) + np.repeat(np.arange(len(segments)), sizes)] = (
        np.frombuffer(b"".join(segments), np.uint8).astype(np.int16) + 1
    )

    def suffix(i):
        end = ends[np.searchsorted(ends, i)]
        return [*(symbols[i:end] + 1000).tolist(), int(end) / 1e6]

    sa, rank = suffix_dedup.suffix_array(symbols, ends)
    assert sa.tolist() == sorted(range(len(symbols)), key=suffix)
    shared = suffix_dedup.common_prefixes(symbols, ends, sa, rank)
    for k in range(1, len(sa)):
        pairs = zip(suffix(sa[k]), suffix(sa[k - 1]))
        assert shared[sa[k]] == next(n for n, (x, y) in enumerate(pairs) if x != y)


def test_repeats_equal_brute_force(spark, sf_dir, docs):
    want = brute.repeats(docs)
    for r in QUERIES["op4_suffix_dedup"](spark, sf_dir).collect():
        spans, kept = want[r.doc_id]
        assert (r.n_removed, r.n_spans) == (sum(b - a for a, b in spans), len(spans))
        assert r.kept_sha256 == hashlib.sha256(kept).hexdigest()


def test_many_small_shards_agree(spark, monkeypatch):
    monkeypatch.setattr(suffix_dedup, "SHARD_BYTES", 200)
    monkeypatch.setattr(suffix_dedup, "ANCHORS_PER_BUCKET", 50)
    rng = random.Random(3)
    stock = ["".join(rng.choice("abcdé ") for _ in range(70)) for _ in range(8)]
    rows = [(i, "".join(rng.choice(stock)[rng.randrange(20) :] for _ in range(rng.randrange(6)))) for i in range(60)]
    got = suffix_dedup.without_repeats(spark.createDataFrame(rows, "doc_id long, text string").repartition(4))
    want = brute.repeats(rows)
    for r in got.collect():
        assert ([(s.start, s.end) for s in r.spans], bytes(r.kept)) == want[r.doc_id]


def test_rows_of_marks_grow_no_faster_than_texts(spark, monkeypatch):
    monkeypatch.setattr(suffix_dedup, "ANCHORS_PER_BUCKET", 1_000)
    monkeypatch.setattr(suffix_dedup, "WINDOWS_PER_BUCKET", 1_000)
    monkeypatch.setattr(suffix_dedup, "HOMES", 4, raising=False)
    kept, made = suffix_dedup.saved, {}

    def counted(df, label):
        out = kept(df, label)
        if label in ("suffix-settled", "suffix-merged"):
            made[label] = made.get(label, 0) + out.count()
        return out

    monkeypatch.setattr(suffix_dedup, "saved", counted)
    rng = random.Random(11)
    letters = "abcdefghijklmnopqrstuvwxyz "
    stock = ["".join(rng.choice(letters) for _ in range(90)) for _ in range(40)]
    rows = [(i, "".join(rng.choice(stock) + "".join(rng.choices(letters, k=40)) for _ in range(12))) for i in range(200)]
    seen = []
    for n in (40, 200):
        made.clear()
        docs = spark.createDataFrame(rows[:n], "doc_id long, text string").repartition(n // 10)
        want = brute.repeats(rows[:n])
        for r in suffix_dedup.without_repeats(docs).collect():
            assert ([(s.start, s.end) for s in r.spans], bytes(r.kept)) == want[r.doc_id]
        seen.append(sum(made.values()))
    assert seen[1] <= 6 * seen[0] and seen[1] <= 3 * len(rows)


def test_repeats_of_odd_rows(odd_docs, no_docs, texts):
    rows = suffix_dedup.without_repeats(odd_docs, carry=odd_docs.columns).collect()
    assert len(rows) == len(texts) + 3
    want = brute.repeats(texts)
    for r in rows:
        if r.doc_id is None:
            assert r.spans == []
        else:
            assert ([(s.start, s.end) for s in r.spans], bytes(r.kept)) == want[r.doc_id]
            assert r.carried.doc_id == r.doc_id and r.carried.kept == "k"
    assert suffix_dedup.without_repeats(no_docs).collect() == []


# packing


def check_packing(rows, docs):
    from tokenizers import Tokenizer

    tokenizer = Tokenizer.from_file(tokenizer_path("word_bpe_49k.json"))
    sequences, pieces = {}, {}
    for r in rows:
        sequences.setdefault(r.sequence_id, []).append((r.offset, r.length))
        pieces.setdefault(r.doc_id, []).append(r)
    tokens = padding = 0
    for own in sequences.values():
        at = 0
        for offset, length in sorted(own):
            assert offset == at and length > 0
            at += length
        assert at <= 4096
        tokens += at
        padding += 4096 - at if at & (at - 1) else 0
    for i, text in docs:
        ids = tokenizer.encode(text or "", add_special_tokens=False).ids + [2]
        at = 0
        for r in sorted(pieces[i], key=lambda r: r.start):
            assert r.start == at and r.doc_tokens == len(ids)
            part = np.array(ids[at : at + r.length], "<u4").tobytes()
            assert zlib.crc32(part) == r.ids_crc32
            at += r.length
        assert at == len(ids)
    return padding / max(1, tokens)


def test_packing_query(spark, sf_dir, docs):
    assert check_packing(QUERIES["op5_packing"](spark, sf_dir).collect(), docs) < 0.02


def test_packing_odd_rows(odd_docs, no_docs, texts):
    from pyspark.sql import functions as F

    path = tokenizer_path("word_bpe_49k.json")
    once = odd_docs.filter("doc_id is not null").dropDuplicates(["doc_id"]).coalesce(1)
    check_packing(packing.packed(once, path).withColumn("ids_crc32", F.crc32("ids")).collect(), texts)
    assert packing.packed(odd_docs, path).filter("doc_id = 1").count() >= 2
    assert packing.packed(no_docs, path).collect() == []


def test_cuts_are_the_cheapest():
    rng = random.Random(4)
    for _ in range(60):
        places = np.cumsum([rng.randrange(1, 40) for _ in range(rng.randrange(1, 25))])
        penalties = np.array([rng.choice([0.0, 6.0, 48.0]) for _ in places])

        def cost(ends):
            total, at = 0.0, 0
            for e in ends:
                length = e - at
                pad = 0 if length >= 256 and not length & (length - 1) else 64 - length
                total += pad + packing.SEQUENCE + penalties[list(places).index(e)]
                at = e
            return total

        best = {0: 0.0}
        for j, p in enumerate(places.tolist()):
            best[p] = min(best[q] + 64 - (p - q) + packing.SEQUENCE + penalties[j] for q in best if p - q <= 64)
        assert cost(packing.best_cuts(places, penalties, 64)) == pytest.approx(best[places[-1]])


# personal data


def test_fixed_forms_equal_plain_expressions():
    rng = random.Random(1)
    for _ in range(20_000):
        text = "".join(rng.choice("ab.@-+1234567890 ()%.@1 é") for _ in range(rng.randrange(40)))
        assert pii.fixed_forms(text) == brute.fixed_forms(text), text


def test_personal_data_query(spark, sf_dir, docs):
    rows = {r.doc_id: r for r in QUERIES["op7_pii"](spark, sf_dir).collect()}
    for i, text in docs:
        base = brute.fixed_forms(text)
        named = [f"{pii.KINDS[k]}:{a}:{b}" for a, k, b in base]
        assert rows[i].base_sha256 == hashlib.sha256(",".join(named).encode()).hexdigest()
        assert [getattr(rows[i], f"n_{k}") for k in pii.KINDS[:4]] == [sum(k == s[1] for s in base) for k in range(4)]
        assert set(named) <= set(rows[i].spans.split(","))


def test_contexts_find_unseen_identifiers(spark):
    rng = random.Random(9)
    rows = [(i, f"please dial +1 (555) 555-{rng.randrange(1000, 9999)} now and wait") for i in range(40)]
    rows += [(100 + i, f"please dial 0044-{rng.randrange(1000, 9999)}-{rng.randrange(10, 99)} now and wait") for i in range(20)]
    rows += [(200 + i, f"built in release 2024-{rng.randrange(1000, 9999)}-x of the tool") for i in range(40)]
    found = pii.found_spans(spark.createDataFrame(rows, "doc_id long, text string")).collect()
    new = {r.doc_id for r in found if any(s.kind == "id" for s in r.pii.spans)}
    assert new == set(range(100, 120))
    assert all("0044" not in r.pii.clean for r in found if r.doc_id in new)


@pytest.mark.parametrize("broadcast_rows", [0, 200_000])
def test_rare_contexts_count_beside_many_common_ones(spark, monkeypatch, broadcast_rows):
    monkeypatch.setattr(pii, "BROADCAST_ROWS", broadcast_rows)
    letters = "translate(cast({} as string), '0123456789', 'abcdefghij')".format
    many = f"concat('x', {letters('id % 7000')}, ' y', {letters('id % 7000')}, ' u', id, '@q.org z', {letters('id % 7000')})"
    common = spark.range(7 * 7000).selectExpr("id as doc_id", f"{many} as text")
    rows = [(100_000 + i, f"zulu yankee v{i}@q.org whiskey") for i in range(5)]
    rows += [(200_000, "zulu yankee 0044-1234-77 whiskey"), (200_000, "zulu yankee 0044-1234-77 whiskey"), (200_001, None)]
    rare = spark.createDataFrame(rows, "doc_id long, text string")
    found = pii.found_spans(common.unionByName(rare)).filter("doc_id >= 100000").collect()
    clean = sorted((r.doc_id, r.pii.clean) for r in found if r.doc_id >= 200_000 and r.text)
    assert clean == [(200_000, "zulu yankee [ID] whiskey")] * 2
    assert len(found) == 8 and all(r.pii.clean == "zulu yankee [EMAIL] whiskey" for r in found if r.doc_id < 200_000)


def test_joined_patterns_find_the_same(spark, sf_dir, monkeypatch):
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    sent = sorted((r.doc_id, r.pii) for r in pii.found_spans(docs).collect())
    monkeypatch.setattr(pii, "BROADCAST_ROWS", 0)
    assert sent == sorted((r.doc_id, r.pii) for r in pii.found_spans(docs).collect())


def test_personal_data_of_odd_rows(odd_docs, no_docs, texts):
    rows = pii.found_spans(odd_docs, "n").collect()
    assert len(rows) == len(texts) + 3
    one = next(r for r in rows if r.doc_id == 14)
    assert [s.kind for s in one.n.base] == ["email", "phone", "card", "ip"]
    assert one.n.clean == "write to [EMAIL] or [PHONE], card [CARD], from [IP]"
    assert all(r.n.clean is None for r in rows if r.text is None)
    assert pii.found_spans(no_docs).collect() == []


# quality


def test_quality_on_held_out_labels(spark):
    sf_dir = "/root/testdata/sf0.01"
    docs, labels = table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels")
    known, held_out = labels.filter("doc_id % 2 = 0"), labels.filter("doc_id % 2 = 1")
    rows = quality.judged(docs, known).join(held_out, "doc_id").select("keep", "quality").collect()
    good, bad = [r.keep for r in rows if r.quality], [not r.keep for r in rows if not r.quality]
    assert len(rows) > 150 and np.mean(good) > 0.97 and np.mean(bad) > 0.85


def test_sparse_sites_are_drawn_to_the_whole(spark):
    rows = [("a", "x", p) for p in [0.9] * 500] + [("b", "x", p) for p in [0.2] * 500] + [("c", "y", 0.0)]
    found = {r.host: r for r in quality.sites(spark.createDataFrame(rows, "host string, path string, p double")).collect()}
    assert found["a"].path_share > 0.88 and found["b"].path_share < 0.22 and found["c"].path_share > 0.1


def plain_quality(docs, labels):
    """{doc_id: posterior} for distinct doc_ids: ridge logistic regression by descent, shares and weights in dicts."""
    looks = {i: quality.looks(t or "") for i, t, _, _ in docs}
    known = sorted(i for i in labels if i in looks)
    x, y = np.array([looks[i] for i in known]), np.array([labels[i] for i in known], float)
    mean, spread = x.mean(axis=0), x.std(axis=0) + 1e-9
    z, each = np.c_[np.ones(len(x)), (x - mean) / spread], np.where(y == 1, 0.5 / y.mean(), 0.5 / (1 - y.mean()))
    ridge, w = np.r_[1e-6, np.full(x.shape[1], quality.RIDGE)], np.zeros(x.shape[1] + 1)
    for _ in range(200):
        p = 1 / (1 + np.exp(-z @ w))
        hessian = sum(e * q * (1 - q) * np.outer(r, r) for e, q, r in zip(each, p, z)) + np.diag(ridge)
        w = w + np.linalg.inv(hessian) @ (sum(e * (t - q) * r for e, t, q, r in zip(each, y, p, z)) - ridge * w)
    evidence = {i: float(np.clip(w[0] + w[1:] @ ((np.array(v) - mean) / spread), -12, 12)) for i, v in looks.items()}
    good = {i: 1 / (1 + np.exp(-e)) for i, e in evidence.items()}
    base = sum(good.values()) / len(good)

    def shares(groups, prior):
        between = sum(len(m) * (np.mean([good[i] for i in m]) - prior[g]) ** 2 for g, m in groups.items())
        within = sum(len(m) * np.var([good[i] for i in m]) for m in groups.values()) / (len(docs) - len(groups))
        differ = (between - len(groups) * within) / len(docs)
        strong = quality.MOST_STRENGTH if differ <= within / quality.MOST_STRENGTH else max(1.0, within / differ)
        return {g: (sum(good[i] for i in m) + strong * prior[g]) / (len(m) + strong) for g, m in groups.items()}

    hosts, paths = {}, {}
    for i, _, host, path in docs:
        hosts.setdefault(host, []).append(i)
        paths.setdefault((host, path), []).append(i)
    of_host = shares(hosts, {h: base for h in hosts})
    of_path = shares(paths, {g: of_host[g[0]] for g in paths})

    def logit(p):
        p = min(1 - 1e-4, max(1e-4, p))
        return np.log(p / (1 - p))

    shift = {i: logit(of_path[host, path]) - logit(base) for i, _, host, path in docs}
    grid = np.linspace(0, quality.MOST_SITE_WEIGHT, 200_001)
    e, d = np.array([evidence[i] for i in known]), np.array([shift[i] for i in known])
    loss = 0.5 * quality.SITE_RIDGE * grid**2
    for k in range(len(known)):
        loss += np.logaddexp(0, (1 - 2 * y[k]) * (e[k] + grid * d[k]))
    weight = grid[np.argmin(loss)]
    return {i: 1 / (1 + np.exp(-(evidence[i] + weight * shift[i]))) for i in looks}, weight


def site_docs():
    """Texts that look much alike, in hosts that differ: one of good documents, one of bad ones, several of both."""
    rng = random.Random(9)
    docs, labels = [], {}
    for i in range(400):
        host = ("fine", "poor", "mixed", None)[i % 4]
        is_good = {"fine": 0.95, "poor": 0.08}.get(host, 0.5) > rng.random()
        words = [rng.choice("alpha beta gamma delta epsilon zeta eta theta".split()) for _ in range(rng.randrange(5, 60))]
        # One look of many tells a little.
        noise = rng.random() < (0.2 if is_good else 0.6)
        docs.append((i, " ".join(words) + (" $$$ @@" if noise else " end."), host, f"p{i % 3}"))
        if i % 2:
            labels[i] = int(is_good)
    return docs, labels


def test_quality_equals_a_plain_version_and_sites_count(spark):
    docs, labels = site_docs()
    want, weight = plain_quality(docs, labels)
    df = spark.createDataFrame(docs, "doc_id long, text string, source string, lang string").repartition(3)
    known = spark.createDataFrame(sorted(labels.items()), "doc_id long, quality int")
    got = {r.doc_id: r for r in quality.judged(df, known).collect()}
    assert max(abs(got[i].posterior - p) for i, p in want.items()) < 1e-3 and weight > 0.2
    # Sites change decisions that the texts alone would have made otherwise.
    alone = {i: r.evidence >= np.log(quality.KEEP_FROM / (1 - quality.KEEP_FROM)) for i, r in got.items()}
    assert sum(alone[i] != r.keep for i, r in got.items()) >= 3
    # Sites that say nothing have next to no weight.
    evidence, shift = np.zeros(1000), np.tile([0.5, -0.5], 500)
    assert quality.site_weight(evidence, shift, np.tile([1.0, 1.0, 0.0, 0.0], 250)) < 1e-9
    assert quality.site_weight(np.empty(0), np.empty(0), np.empty(0)) == 0


def test_quality_of_odd_rows(spark, odd_docs, no_docs, texts):
    labels = spark.createDataFrame([(1, 1), (12, 0), (None, 1), (13, None), (2, 1), (2, 0)], "doc_id long, quality int")
    rows = quality.judged(odd_docs, labels).collect()
    assert len(rows) == len(texts) + 3 and all(0 <= r.posterior <= 1 for r in rows)
    assert all(r.keep for r in quality.judged(odd_docs, labels.limit(0)).collect())
    assert quality.good_documents(odd_docs, labels).columns == odd_docs.columns
    assert quality.judged(no_docs, labels).collect() == []


def test_queries_equal_their_sql(spark, sf_dir):
    import pathlib
    import sys

    sys.path.insert(0, str(pathlib.Path(__file__).resolve().parents[1]))
    import oracle

    from tidelake.llm.queries import ORACLES

    con = oracle.connect(sf_dir)
    for name, sql in ORACLES.items():
        assert oracle.compare(con, QUERIES[name](spark, sf_dir), sql) is None


def test_cut_points_are_found_without_sorting(monkeypatch):
    import numpy as np

    rng = np.random.default_rng(4)
    cases = []
    for total in (1, 256, 257, 3000):
        docs, sentences = (np.sort(rng.integers(-2, total + 3, size)) for size in (6, 9))
        ends = {total} | {p for p in [*docs.tolist(), *sentences.tolist()] if 0 < p <= total}
        want, last = [], 0
        for end in sorted(ends):
            want += [*range(last + packing.HARD_EVERY, end, packing.HARD_EVERY), end]
            last = end
        charge = [0.0 if p in docs else packing.SENTENCE_CUT if p in sentences else packing.HARD_CUT for p in want]
        cases.append((total, docs, sentences, want, charge))
    for name in ("unique", "union1d", "isin"):
        monkeypatch.setattr(np, name, None)
    for total, docs, sentences, want, charge in cases:
        places, penalties = packing.cut_points(total, docs, sentences)
        assert places.tolist() == want and penalties.tolist() == charge
