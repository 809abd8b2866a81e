"""Self-join of documents on the Jaccard similarity of their word shingles, exact, without all pairs.

A set's rarest shingles, taken in one corpus-wide order, form its prefix; two sets that reach the
threshold share a prefix shingle. Prefix entries are sent to index lists. A list is sorted by set
size and position and cut into blocks of equal (size, position): the size and position filters are
tried once a block, and a failing block is skipped with all its entries.

Large lists are mostly many similar sets. There every set is compared with a leader only. A set Y
that links to a leader X becomes its follower, and what is known about X answers for Y: for any Z,
``|Y & Z|`` differs from ``|X & Z|`` by at most ``|Y - X|`` upwards, so one comparison of two leaders
rules out all pairs of their followers, or shows that they are connected. Only what this leaves
open is compared set by set.

Equal sets are one class from the start; a class costs one entry a task, however many copies it has.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidelake.llm.common import (
    ShingleSets,
    arrow_groups,
    arrow_map,
    connected,
    matching,
    mixed,
    saved,
    signed,
)

BINS = 1 << 20
CHUNK = 1 << 16
ENTRIES_PER_BUCKET = 200_000
FLUSH = 400_000
SMALL_LIST = 64
SALTED_LIST = 20_000
SHARED_PART = 12
LEADERS = 3
WIDESPREAD = 24
MOST_WIDESPREAD = 1 << 20
SEEN = 100_000

ENTRY = "bucket int, salt int, tok binary, doc binary, pos binary, cls binary, n binary"


def set_name(tokens: np.ndarray) -> int:
    """64-bit name of a set; equal sets have equal names."""
    if not len(tokens):
        return 0
    with np.errstate(over="ignore"):
        total = mixed(tokens + np.uint64(0x9E3779B97F4A7C15)).sum(dtype=np.uint64)
        name = mixed(np.array([total ^ np.uint64(len(tokens))], np.uint64))
    return int(signed(name)[0])


def shared_at_least(n):
    """Prefixes of sets from this size on are so long that similar sets share this many shingles in them.

    One would do for finding pairs. Some more make prefixes a little longer and rule out the pairs
    that have only a passage in common, before any set is fetched.
    """
    return 1 + n // SHARED_PART


def _name_sets(width: int):
    """Per document its set's size and name, and the task's count of shingles by hash bin."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sets, counts = ShingleSets(width), np.zeros(BINS, np.int64)
        for batch in batches:
            n, names = [], []
            for tokens in sets(batch):
                n.append(len(tokens))
                names.append(set_name(tokens))
                # The tokens of one set are distinct; two in one bin count once, which only blurs.
                counts[(tokens >> np.uint64(44)).astype(np.int64)] += 1
            empty = pa.nulls(batch.num_rows, pa.binary())
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column("doc_id"),
                    batch.column("text_key"),
                    pa.array(n, pa.int64()),
                    pa.array(names, pa.int64()),
                    pa.nulls(batch.num_rows, pa.int32()),
                    empty,
                ],
                ["doc_id", "text_key", "n", "cls", "chunk", "counts"],
            )
        chunks = [(k, c) for k, c in enumerate(counts.reshape(-1, CHUNK)) if c.any()]
        if chunks:
            nothing = pa.nulls(len(chunks), pa.int64())
            yield pa.RecordBatch.from_arrays(
                [
                    nothing,
                    nothing,
                    nothing,
                    nothing,
                    pa.array([k for k, _ in chunks], pa.int32()),
                    pa.array([c.astype(np.int32).tobytes() for _, c in chunks], pa.binary()),
                ],
                ["doc_id", "text_key", "n", "cls", "chunk", "counts"],
            )

    return run


def _add_chunks(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    sums: dict[int, np.ndarray] = {}
    for batch in batches:
        for k, counts in zip(batch.column("chunk").to_pylist(), batch.column("counts").to_pylist(), strict=True):
            if k not in sums:
                sums[k] = np.zeros(CHUNK, np.int64)
            sums[k] += np.frombuffer(counts, np.int32)
    if sums:
        yield pa.RecordBatch.from_arrays(
            [pa.array(list(sums), pa.int32()), pa.array([c.tobytes() for c in sums.values()], pa.binary())],
            ["chunk", "counts"],
        )


def _bin_counts(written: DataFrame) -> np.ndarray:
    """How many sets hold a shingle of each hash bin; BINS numbers, whatever the corpus."""
    parts = written.filter("chunk is not null").select("chunk", "counts")
    counts = np.zeros(BINS, np.int64)
    for row in arrow_map(parts.repartition("chunk"), _add_chunks, "chunk int, counts binary").collect():
        counts[row.chunk * CHUNK : (row.chunk + 1) * CHUNK] += np.frombuffer(row.counts, np.int64)
    return counts


def _in_bins(width: int, full):
    """The task's shingles that fall in bins fuller than usual, counted."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sets, chosen = ShingleSets(width), full.value
        for batch in batches:
            kept = [t[chosen[(t >> np.uint64(44)).astype(np.int64)]] for t in sets(batch)]
            tok, n = np.unique(np.concatenate([np.empty(0, np.uint64), *kept]), return_counts=True)
            yield pa.RecordBatch.from_arrays([pa.array(signed(tok)), pa.array(n)], ["tok", "n"])

    return run


def widespread(docs: DataFrame, counts: np.ndarray, width: int) -> tuple[np.ndarray, np.ndarray]:
    """Shingles in more than ``WIDESPREAD`` documents, sorted, and in how many; at most ``MOST_WIDESPREAD``, the commonest.

    Ordered by (this count, hash), shingles of widespread passages come last, so prefixes avoid them.
    The order may be any; only the length of index lists depends on it. Counted are the shingles of
    bins that stand out, a few hundredths of all, by a grouped sum.
    """
    usual = float(np.median(counts))
    full = docs.sparkSession.sparkContext.broadcast(counts > usual + 2 * np.sqrt(usual) + WIDESPREAD // 4)
    sums = arrow_map(docs.select("text"), _in_bins(width, full), "tok long, n long").groupBy("tok").agg(F.sum("n").alias("n"))
    found = sums.filter(F.col("n") > WIDESPREAD).orderBy(F.desc("n"), "tok").limit(MOST_WIDESPREAD).toArrow()
    tok = found.column("tok").to_numpy().view(np.uint64)
    order = np.argsort(tok)
    return tok[order], found.column("n").to_numpy()[order]


def prefix_length(percent: int, n: str = "n") -> str:
    """How many shingles the prefix of a set of ``n`` has, as SQL."""
    return f"least({n}, {n} - ({percent} * {n} + 99) div 100 + 1 + {n} div {SHARED_PART})"


def _entries(width: int, percent: int, common, bits: int):
    """Prefix entries packed by bucket of the shingle's hash; widespread shingles spread over salts."""

    def pack(found: list[tuple]) -> Iterator[pa.RecordBatch]:
        sizes = np.array([len(t) for _, _, t, _ in found], np.int64)
        cls = np.array([c for c, _, _, _ in found], np.int64)
        n = np.array([k for _, k, _, _ in found], np.uint32)
        tok, lev = np.concatenate([t for _, _, t, _ in found]), np.concatenate([v for _, _, _, v in found])
        doc = np.repeat(np.arange(len(found), dtype=np.uint32), sizes)
        pos = (np.arange(len(tok)) - np.repeat(np.cumsum(sizes) - sizes, sizes)).astype(np.uint32)
        ways = lev // SALTED_LIST + 1
        salt = np.where(ways > 1, 1 + cls[doc].view(np.uint64) % ways.astype(np.uint64), 0).astype(np.int64)
        bucket = (tok >> np.uint64(64 - bits)).astype(np.int64) if bits else np.zeros(len(tok), np.int64)
        order = np.lexsort((tok, salt, bucket))
        tok, doc, pos, salt, bucket = tok[order], doc[order], pos[order], salt[order], bucket[order]
        cuts = np.flatnonzero((np.diff(bucket) != 0) | (np.diff(salt) != 0)) + 1
        edges = [0, *cuts.tolist(), len(tok)]
        rows = []
        for lo, hi in zip(edges, edges[1:]):
            own, local = np.unique(doc[lo:hi], return_inverse=True)
            rows.append(
                (
                    int(bucket[lo]),
                    int(salt[lo]),
                    tok[lo:hi].tobytes(),
                    local.astype(np.uint32).tobytes(),
                    pos[lo:hi].tobytes(),
                    cls[own].tobytes(),
                    n[own].tobytes(),
                )
            )
        kinds = [pa.int32(), pa.int32(), *[pa.binary()] * 5]
        names = ["bucket", "salt", "tok", "doc", "pos", "cls", "n"]
        for at in range(0, len(rows), 512):
            part = rows[at : at + 512]
            yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(zip(*part), kinds)], names)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sets, seen, found, held = ShingleSets(width), set(), [], 0
        often, level = common.value
        for batch in batches:
            ids = batch.column("doc_id").is_valid().to_pylist()
            for tokens, has_id in zip(sets(batch), ids, strict=True):
                name = set_name(tokens)
                if not len(tokens) or not has_id or name in seen:
                    continue
                if len(seen) >= SEEN:
                    seen.clear()
                seen.add(name)
                size = len(tokens)
                keep = min(size, size - (percent * size + 99) // 100 + shared_at_least(size))
                lev = np.zeros(size, np.int64)
                if len(often):
                    at = np.minimum(np.searchsorted(often, tokens), len(often) - 1)
                    lev = np.where(often[at] == tokens, level[at], 0)
                if lev.any():
                    order = np.lexsort((tokens, lev))[:keep]
                    tokens, lev = tokens[order], lev[order]
                found.append((name, size, tokens[:keep].copy(), lev[:keep].copy()))
                held += keep
                if held >= FLUSH:
                    yield from pack(found)
                    found, held = [], 0
        if found:
            yield from pack(found)

    return run


def _index(percent: int):
    """One bucket's lists: candidate pairs of small lists, leader pairs and the entries of large ones."""

    def passes(n1, p1, n2, p2):
        """Whether two sets can be similar that share this shingle; whether they can when it is their first."""
        need = -(-percent * (n1 + n2) // (100 + percent))
        rest = np.minimum(n1 - p1, n2 - p2)
        sized = 100 * np.minimum(n1, n2) >= percent * np.maximum(n1, n2)
        return sized & (np.minimum(p1, p2) + rest >= need), sized & (rest >= need)

    def run(group: pa.Table) -> pa.Table:
        tok, cls, n, pos = [], [], [], []
        for row in group.to_pylist():
            doc = np.frombuffer(row["doc"], np.uint32)
            tok.append(np.frombuffer(row["tok"], np.uint64))
            cls.append(np.frombuffer(row["cls"], np.int64)[doc])
            n.append(np.frombuffer(row["n"], np.uint32)[doc])
            pos.append(np.frombuffer(row["pos"], np.uint32))
        tok, cls = np.concatenate(tok), np.concatenate(cls)
        n, pos = np.concatenate(n).astype(np.int64), np.concatenate(pos).astype(np.int64)
        order = np.lexsort((cls, pos, n, tok))
        tok, cls, n, pos = tok[order], cls[order], n[order], pos[order]
        first = np.r_[True, (tok[1:] != tok[:-1]) | (cls[1:] != cls[:-1])]
        tok, cls, n, pos = tok[first], cls[first], n[first], pos[first]
        new_list = np.r_[True, tok[1:] != tok[:-1]]
        sizes = np.diff(np.r_[np.flatnonzero(new_list), len(tok)])
        per_entry = np.repeat(sizes, sizes)

        def pairs_of(tok, cls, n, pos):
            """All pairs of one list, by blocks of equal (size, position)."""
            if not len(tok):
                return tuple(np.empty((4, 0), np.int64))
            start = np.flatnonzero(np.r_[True, (np.diff(tok) != 0) | (np.diff(n) != 0) | (np.diff(pos) != 0)])
            size = np.diff(np.r_[start, len(tok)])
            left, right, firsts, k = [], [], [], 0
            while True:
                i = np.arange(len(start) - k)
                i = i[tok[start[i]] == tok[start[i + k]]]
                if not len(i):
                    break
                j = i + k
                ok, first = passes(n[start[i]], pos[start[i]], n[start[j]], pos[start[j]])
                i, j, first = i[ok], j[ok], first[ok]
                count = size[i] * size[j]
                at = np.arange(count.sum()) - np.repeat(np.cumsum(count) - count, count)
                a = np.repeat(start[i], count) + at // np.repeat(size[j], count)
                b = np.repeat(start[j], count) + at % np.repeat(size[j], count)
                left.append(a[a < b])
                right.append(b[a < b])
                firsts.append(np.repeat(first, count)[a < b])
                k += 1
            a, b = np.concatenate(left or [start[:0]]), np.concatenate(right or [start[:0]])
            first = np.concatenate([np.zeros(0, bool), *firsts]).astype(np.int64)
            return np.minimum(cls[a], cls[b]), np.maximum(cls[a], cls[b]), shared_at_least(np.minimum(n[a], n[b])), first

        # A salted list is a part of one, however few entries it has here.
        large = (per_entry > SMALL_LIST) | (group.column("salt")[0].as_py() > 0)
        small = (per_entry > 1) & ~large
        a, b, least, first = pairs_of(tok[small], cls[small], n[small], pos[small])
        order = np.lexsort((b, a))
        a, b, least, first = a[order], b[order], least[order], first[order]
        start = np.flatnonzero(np.r_[True, (a[1:] != a[:-1]) | (b[1:] != b[:-1])]) if len(a) else a
        common = np.diff(np.r_[start, len(a)]) if len(a) else a
        first = np.maximum.reduceat(first, start) if len(a) else a
        a, b, least = a[start], b[start], least[start]
        lefts, rights = [], []
        big = np.flatnonzero(large)
        edges = np.r_[0, np.flatnonzero(np.diff(tok[big]) != 0) + 1, len(big)] if len(big) else [0]
        for lo, hi in zip(edges, edges[1:]):
            own = big[lo:hi]
            # Sets with few rare shingles have this one early; of a group of copies these are the ones
            # nearest to what was copied, and so the likeliest to be similar to all others.
            own = own[np.lexsort((cls[own], pos[own]))]
            led_by = 0
            while len(own) and led_by < LEADERS:
                lead, own = own[0], own[1:]
                sized, near = passes(n[lead], pos[lead], n[own], pos[own])
                lefts.append(np.full(int(near.sum()), cls[lead]))
                rights.append(cls[own[near]])
                led_by += 1
                if led_by == LEADERS:  # what no leader's size fits has leaders of its own
                    own, led_by = own[100 * np.minimum(n[lead], n[own]) < percent * np.maximum(n[lead], n[own])], 0
        led = np.concatenate([np.empty(0, np.int64), *lefts]), np.concatenate([np.empty(0, np.int64), *rights])
        led = np.unique(np.stack([np.minimum(*led), np.maximum(*led)], 1), axis=0)
        zeros = np.zeros(len(led), np.int64)
        return pa.concat_tables(
            [
                pa.table({"tok": pa.nulls(len(a), pa.int64()), "a": a, "b": b, "n": least, "pos": common, "first": first}),
                # Leader pairs are compared whatever their number of common shingles.
                pa.table({"tok": pa.nulls(len(led), pa.int64()), "a": led[:, 0], "b": led[:, 1], "n": zeros, "pos": zeros, "first": zeros + 1}),
                pa.table(
                    {
                        "tok": signed(tok[large]),
                        "a": cls[large],
                        "b": pa.nulls(int(large.sum()), pa.int64()),
                        "n": n[large],
                        "pos": pos[large],
                        "first": (pos[large] <= n[large] - -(-percent * n[large] // 100)).astype(np.int64),
                    }
                ),
            ]
        )

    return run


def _packed_sets(width: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        shingles = ShingleSets(width)
        for batch in batches:
            sets = shingles(batch)
            yield pa.RecordBatch.from_arrays(
                [
                    pa.array([set_name(s) for s in sets], pa.int64()),
                    batch.column("wanted"),
                    pa.array([s.tobytes() for s in sets], pa.binary()),
                ],
                ["cls", "wanted", "tokens"],
            )

    return run


def _overlaps(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        out = []
        for left, right in zip(batch.column("ta").to_pylist(), batch.column("tb").to_pylist(), strict=True):
            x, y = np.frombuffer(left, np.uint64), np.frombuffer(right, np.uint64)
            at = np.searchsorted(y, x)
            at[at == len(y)] = 0
            out.append((int((y[at] == x).sum()) if len(y) else 0, len(x), len(y)))
        inter, na, nb = zip(*out) if out else ((), (), ())
        yield pa.RecordBatch.from_arrays(
            [batch.column("a"), batch.column("b"), *[pa.array(v, pa.int64()) for v in (inter, na, nb)]],
            ["a", "b", "inter", "na", "nb"],
        )


def similar_components(docs: DataFrame, percent: int = 75, width: int = 5) -> DataFrame:
    """(doc_id, n_shingles, component_id, component, text_key) for each row of ``docs`` (doc_id, text).

    Documents link when ``100 * intersection >= percent * union`` of their sets of ``width``-word
    shingles; ``component_id`` is the smallest doc_id reachable by links, the own one included, and
    ``component`` a name of all that is reachable, NULL without shingles: two components may have one
    smallest doc_id where its rows differ. ``text_key`` is the text's xxhash64.
    A NULL or empty text has no shingles and no links. Copies and repeated rows share one class and
    get a row each. A row without doc_id stays, without links: its component_id is NULL. Other
    columns are ignored; an empty table gives an empty result.
    """
    spark = docs.sparkSession
    docs = docs.select(F.col("doc_id").cast("long"), F.col("text").cast("string"))
    keyed = docs.withColumn("text_key", F.xxhash64("text"))
    named = arrow_map(keyed, _name_sets(width), "doc_id long, text_key long, n long, cls long, chunk int, counts binary")
    named = saved(named, "jaccard-names")
    counts = _bin_counts(named)
    classes = named.filter("chunk is null").select("doc_id", "text_key", "n", "cls")
    total = int(counts.sum()) * (100 - percent) // 100
    bits = max(0, (total // ENTRIES_PER_BUCKET).bit_length())
    often, level = widespread(docs, counts, width)
    common = spark.sparkContext.broadcast((often, level))
    levels = spark.createDataFrame(pa.table({"tok": signed(often), "level": level.astype(np.int64)}))
    levels = saved(levels, "jaccard-levels")
    entries = arrow_map(docs, _entries(width, percent, common, bits), ENTRY)
    index = saved(
        arrow_groups(
            entries, ["bucket", "salt"], _index(percent), "tok long, a long, b long, n long, pos long, first long"
        ),
        "jaccard-index",
    )
    common.unpersist()

    # Similar sets that meet in no large list share that many prefix shingles in small ones.
    found = index.filter("b is not null").groupBy("a", "b")
    found = found.agg(F.sum("pos").alias("common"), F.min("n").alias("least"), F.max("first").alias("first"))
    found = saved(found, "jaccard-found")
    large = index.filter("b is null").select("tok", F.col("a").alias("cls"), "n", "pos", "first")
    # What a pair lacks in small lists it may share in large ones, of which each set's number is known.
    held = large.groupBy("cls").agg(F.count("*").alias("held"))
    short = found.filter("first = 1 and common < least")
    for side in "ab":
        short = short.join(held.select(F.col("cls").alias(side), F.col("held").alias(f"held_{side}")), side)
    short = short.filter("common + least(held_a, held_b) >= least").select("a", "b")
    pairs = found.filter("first = 1 and common >= least").select("a", "b").unionByName(short)
    pairs = saved(pairs, "jaccard-pairs")
    wanted = pairs.select(F.col("a").alias("cls")).unionByName(pairs.select(F.col("b").alias("cls")))
    wanted = wanted.unionByName(large.select("cls")).distinct()
    chosen = classes.join(wanted, "cls").filter("doc_id is not null").groupBy("cls").agg(F.min("doc_id").alias("doc_id"))
    chosen = saved(chosen.select("doc_id", F.col("cls").alias("wanted")), "jaccard-chosen")
    texts = matching(docs, chosen, ["doc_id"]).select("wanted", "text")
    # A doc_id may have rows with other texts; only the set asked for is kept, and once.
    sets = arrow_map(texts, _packed_sets(width), "cls long, wanted long, tokens binary").filter("cls = wanted")
    sets = saved(sets.select("cls", "tokens"), "jaccard-sets")

    def overlaps(pairs: DataFrame, label: str) -> DataFrame:
        sided = pairs.join(sets.select(F.col("cls").alias("b"), F.col("tokens").alias("tb")), "b")
        sided = sided.join(sets.select(F.col("cls").alias("a"), F.col("tokens").alias("ta")), "a")
        return saved(arrow_map(sided, _overlaps, "a long, b long, inter long, na long, nb long"), label)

    links = F.expr(f"100 * inter >= {percent} * (na + nb - inter)")
    known = overlaps(pairs, "jaccard-overlaps")
    edges = known.filter(links).select("a", "b")
    labels = connected(edges, "jaccard-first")
    if not large.isEmpty():
        limits = saved(_limits(large, held, levels, percent), "jaccard-limits")
        edges = edges.unionByName(_across(large, limits, found, known, links, labels, overlaps, percent))
        labels = connected(edges, "jaccard-all")

    reached = classes.join(labels.withColumnRenamed("node", "cls"), "cls", "left")
    reached = reached.withColumn("of", F.coalesce("component", F.when(F.col("n") > 0, F.col("cls"))))
    smallest = reached.filter("doc_id is not null and of is not null").groupBy("of")
    smallest = smallest.agg(F.min("doc_id").alias("least"), F.count("*").alias("rows"))
    # A row alone has no other to look for. Components with more than a thousandth of all rows are at most
    # a thousand; their rows do not move, like those without a component.
    smallest = saved(smallest.filter("rows > 1"), "jaccard-smallest")
    reached = saved(reached, "jaccard-reached")
    many = F.col("rows") * 1000 > reached.count()
    hot = smallest.filter(many).select("of", F.col("least").alias("hot_least"))
    placed = reached.join(F.broadcast(hot), "of", "left")
    still = F.col("hot_least").isNotNull() | F.col("of").isNull()
    moved = placed.filter(~still).drop("hot_least").join(smallest.filter(~many).select("of", "least"), "of", "left")
    every = placed.filter(still).withColumnRenamed("hot_least", "least").unionByName(moved)
    return every.select(
        "doc_id",
        F.col("n").alias("n_shingles"),
        F.when(F.col("doc_id").isNotNull(), F.coalesce("least", "doc_id")).alias("component_id"),
        F.col("of").alias("component"),
        "text_key",
    )


def _mixed_lists(large: DataFrame, known: DataFrame, links, labels: DataFrame, label: str) -> DataFrame:
    """Entries of the large lists whose sets are not all connected, with each set's component and leader."""
    linked = known.filter(links)
    sides = linked.select(F.col("b").alias("cls"), F.col("a").alias("lead"), F.expr("nb - inter").alias("extra"))
    sides = sides.unionByName(linked.select(F.col("a").alias("cls"), F.col("b").alias("lead"), F.expr("na - inter").alias("extra")))
    # Most sets that have a leader share it, so the leader followed most often is the one to follow.
    fame = sides.groupBy("lead").agg(F.count("*").alias("fame"))
    best = (
        sides.join(fame, "lead")
        .groupBy("cls")
        .agg(F.max_by(F.struct("lead", "extra", "fame"), F.struct("fame", F.negative("extra"), "lead")).alias("best"))
    )
    entries = (
        large.join(best, "cls", "left")
        .join(labels.withColumnRenamed("node", "cls"), "cls", "left")
        .select(
            "tok",
            "cls",
            "n",
            "pos",
            "first",
            F.coalesce("component", "cls").alias("component"),
            F.coalesce("best.lead", "cls").alias("lead"),
            F.coalesce("best.extra", F.lit(0)).alias("extra"),
        )
    )
    mixed_lists = entries.groupBy("tok").agg(F.min("component").alias("lo"), F.max("component").alias("hi"))
    return saved(entries.join(mixed_lists.filter("lo != hi").select("tok"), "tok", "left_semi"), label)


def _with_both(pairs: DataFrame, own: DataFrame, key: str) -> DataFrame:
    """``pairs`` (a, b) with the columns of ``own`` for either side."""
    for side in "ab":
        pairs = pairs.join(own.select([F.col(c).alias(side if c == key else f"{c}_{side}") for c in own.columns]), side)
    return pairs


def _limits(large: DataFrame, held: DataFrame, levels: DataFrame, percent: int) -> DataFrame:
    """(cls, cap, end) of the sets in large lists.

    Of two sets, the one whose prefix ends earlier in the corpus-wide order has no shingle in its prefix
    that the other has behind its own. So what they share is either met in small lists, and counted there,
    or among the ``cap`` shingles which the one that ends earlier has in large lists or behind its
    prefix. ``end`` is the place of the last prefix shingle in that order, NULL if its list is not large.
    """
    size = prefix_length(percent)
    last = large.filter(f"pos = {size} - 1").join(levels, "tok", "left")
    # Hashes are ordered as unsigned numbers.
    place = F.struct(F.coalesce("level", F.lit(0)).alias("level"), F.col("tok").bitwiseXOR(F.lit(-(1 << 63))).alias("tok"))
    last = last.groupBy("cls").agg(F.max(place).alias("end"))
    sizes = large.groupBy("cls").agg(F.max("n").alias("n"))
    cap = F.expr(f"n - {size} + held").alias("cap")
    return sizes.join(held, "cls").join(last, "cls", "left").select("cls", cap, "end")


def _across(large, limits, found, known, links, labels, overlaps, percent) -> DataFrame:
    """Links between sets of one large list that the leaders' links have not connected yet."""
    entries = _mixed_lists(large, known, links, labels, "jaccard-mixed")
    groups = entries.groupBy("lead").agg(
        F.max("extra").alias("extra"),
        F.min("n").alias("lo"),
        F.max("n").alias("hi"),
        F.collect_set("tok").alias("held"),
        F.count("*").alias("entries"),
    )
    members = entries.select("cls", "lead").distinct().join(limits, "cls").groupBy("lead")
    members = members.agg(
        F.max("cap").alias("cap"),
        F.min("end").alias("early"),
        F.when(F.count("end") == F.count("*"), F.max("end")).alias("late"),
        (F.count("end") == F.count("*")).alias("ended"),
    )
    groups = groups.join(members.withColumn("early", F.when(F.col("ended"), F.col("early"))).drop("ended"), "lead")
    # Similar sets meet in the list of their first common shingle, which both have in the part of
    # their prefix that would do without the count of common ones.
    # What both have from there on bounds what they share; of followers, the best case counts.
    ahead = entries.filter("first = 1").groupBy("tok", "lead", "component")
    ahead = ahead.agg(F.max(F.col("n") - F.col("pos")).alias("rest"), F.min("n").alias("lo"))
    other = ahead.select("tok", F.col("lead").alias("b"), F.col("component").alias("other"), F.col("rest").alias("rest_b"), F.col("lo").alias("lo_b"))
    can = f"{100 + percent} * least(rest, rest_b) >= {percent} * (lo + lo_b)"
    met = ahead.join(other, "tok").filter(f"component != other and lead < b and {can}")
    met = met.select(F.col("lead").alias("a"), "b").distinct()
    met = _with_both(met, groups, "lead").withColumn("meetings", F.size(F.array_intersect("held_a", "held_b")))
    met = met.drop("held_a", "held_b")
    # What two followers share in small lists counts beside the large lists their leaders meet in.
    lead_of = entries.select("cls", "lead").distinct()
    beside = found.filter("least > 0").join(lead_of.select(F.col("cls").alias("a"), F.col("lead").alias("x")), "a")
    beside = beside.join(lead_of.select(F.col("cls").alias("b"), F.col("lead").alias("y")), "b")
    beside = beside.groupBy(F.least("x", "y").alias("a"), F.greatest("x", "y").alias("b")).agg(F.max("common").alias("beside"))
    beside_them = F.coalesce("beside", F.lit(0))
    enough = F.col("meetings") + beside_them >= 1 + F.floor(F.least("lo_a", "lo_b") / SHARED_PART)
    # The cap of the followers that end earlier counts, where it is known which these are.
    cap = F.when(F.col("late_a") <= F.col("early_b"), F.col("cap_a")).when(F.col("late_b") <= F.col("early_a"), F.col("cap_b"))
    cap = F.coalesce(cap, F.greatest("cap_a", "cap_b"))
    capped = (100 + percent) * (cap + beside_them) >= percent * (F.col("lo_a") + F.col("lo_b"))
    met = saved(met.join(beside, ["a", "b"], "left").filter(enough & capped), "jaccard-met")
    compared = overlaps(met.select("a", "b"), "jaccard-leaders").join(met, ["a", "b"])
    joined = compared.filter(links).select("a", "b")
    # No follower pair can reach the threshold when even this bound stays below it.
    reachable = F.expr(
        f"{100 + percent} * (inter + extra_a + extra_b) >= {percent} * (lo_a + lo_b)"
        f" and 100 * hi_a >= {percent} * lo_b and 100 * hi_b >= {percent} * lo_a"
    )
    # Of two leaders, the one whose followers have fewer entries is "few": these are offered to the other's lists.
    few = F.col("entries_a") <= F.col("entries_b")
    unsure = compared.filter(~links & reachable).select(
        F.when(few, F.col("a")).otherwise(F.col("b")).alias("few"),
        F.when(few, F.col("b")).otherwise(F.col("a")).alias("many"),
        "inter",
    )
    unsure = saved(unsure, "jaccard-unsure")
    # The first common shingle of similar sets is among their "first" entries, as above.
    own = ["tok", F.col("cls").alias("y"), F.col("n").alias("n1"), F.col("pos").alias("p1"), F.col("lead").alias("few")]
    left = entries.filter("first = 1").select(*own, F.col("extra").alias("extra1"))
    right = left.toDF("tok", "z", "n2", "p2", "many", "extra2")
    open_pairs = (
        left.join(unsure, "few")
        .join(right, ["tok", "many"])
        .filter(
            f"100 * least(n1, n2) >= {percent} * greatest(n1, n2)"
            f" and {100 + percent} * least(n1 - p1, n2 - p2) >= {percent} * (n1 + n2)"
            f" and {100 + percent} * (inter + extra1 + extra2) >= {percent} * (n1 + n2)"
        )
        .select("y", "z")
    )
    # The bound of the followers, now for each pair of them.
    for side in "yz":
        own = limits.select(F.col("cls").alias(side), F.col("cap").alias(f"cap_{side}"), F.col("end").alias(f"end_{side}"))
        open_pairs = open_pairs.distinct().join(own, side) if side == "y" else open_pairs.join(own, side)
    cap = F.when(F.col("end_y") <= F.col("end_z"), F.col("cap_y")).when(F.col("end_z") <= F.col("end_y"), F.col("cap_z"))
    open_pairs = open_pairs.select(
        F.least("y", "z").alias("a"), F.greatest("y", "z").alias("b"), F.coalesce(cap, F.greatest("cap_y", "cap_z")).alias("cap")
    )
    sizes = entries.groupBy("cls").agg(F.max("n").alias("n"))
    open_pairs = _with_both(open_pairs, sizes, "cls").join(found.select("a", "b", "common"), ["a", "b"], "left")
    within = (100 + percent) * (F.col("cap") + F.coalesce("common", F.lit(0))) >= percent * (F.col("n_a") + F.col("n_b"))
    open_pairs = open_pairs.filter(within).select("a", "b").distinct()
    late = overlaps(open_pairs, "jaccard-open").filter(links).select("a", "b")
    return joined.unionByName(late)
