"""Removal of byte strings that already start in an earlier document, by suffix arrays of shards.

Comparing every shard's suffix array with every other would take work that grows with the square of
the corpus, so shards hold only the stretches of text that can matter:

1. Of each window of ``length`` bytes the least hash of its ``ANCHOR``-byte substrings is picked;
   equal windows pick the same substring, so a repeated string shares an anchor with its copy. An
   anchor travels with a hash of everything within reach of it. Where an earlier document has the
   same surroundings, all windows around the anchor are repeats and nothing else need be looked at.
2. Where anchors are shared but surroundings differ, the surroundings are cut out. Shards of these
   segments get a suffix array (Larsson-Sadakane refinement) and its common prefixes (Kasai), which
   give its groups of equal windows and the earliest document of each.
3. The shards' sorted windows are merged by hash range: each shard's windows are looked up by binary
   search in the merged ones, which tells it of earlier documents in other shards.

What the buckets of steps 1 and 3 find goes back to the documents by home: a fixed number of document
ranges, so that the rows sent are in proportion to the buckets, however thinly a document is spread over them.
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidelake.llm.common import BROADCAST_ROWS, arrow_groups, arrow_map, mixed, saved

ANCHOR = 20
NEAR_BITS = 12
DECIDED_BUCKETS = 1 << 30
GAP = 96
PIECE_BYTES = 256 << 10
SHARD_BYTES = 1 << 20
ANCHORS_PER_BUCKET = 80_000
WINDOWS_PER_BUCKET = 150_000
FLUSH = 200_000
HOMES = 256
HOME_BYTES = 256 << 20

BASE = np.uint64(0xD6E8FEB86659FD93)
VALUES = mixed(np.arange(1, 258, dtype=np.uint64) * np.uint64(0x9E3779B97F4A7C15))
MOST = np.uint64(0xFFFFFFFFFFFFFFFF)


def _power(k: int) -> np.uint64:
    return np.uint64(pow(int(BASE), k, 1 << 64))


class WindowHashes:
    """Polynomial hashes of windows of any length over symbols (0-256), put together from powers of two."""

    def __init__(self, symbols: np.ndarray, most: int) -> None:
        span, h = 1, VALUES[symbols]
        self.levels = [(span, h)]
        while span * 2 <= most:
            h = h[:-span] * _power(span) + h[span:]
            span *= 2
            self.levels.append((span, h))

    def __call__(self, length: int, starts: np.ndarray | slice) -> np.ndarray:
        """Hashes of the windows of ``length`` that begin at ``starts``, given as places or as a slice."""
        out, done = None, 0
        for span, h in reversed(self.levels):
            while length - done >= span:
                part = h[starts.start + done : starts.stop + done] if isinstance(starts, slice) else h[starts + done]
                out = part if out is None else out * _power(span) + part
                done += span
        return mixed(out)


def _sliding(values: np.ndarray, width: int, pick) -> np.ndarray:
    span, out = 1, values
    while span * 2 <= width:
        out = pick(out[:-span], out[span:])
        span *= 2
    return pick(out[: len(out) - (width - span)], out[width - span :]) if width > span else out


def laid_out(texts: Sequence[bytes]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Texts one after the other with gaps of symbol 256, and where each starts and ends."""
    sizes = np.array([len(t) for t in texts], np.int64)
    starts = np.cumsum(sizes + GAP) - sizes
    symbols = np.full(int(sizes.sum()) + GAP * (len(texts) + 1), 256, np.int16)
    flat = np.frombuffer(b"".join(texts), np.uint8)
    inside = np.arange(len(flat)) + np.repeat(starts - (np.cumsum(sizes) - sizes), sizes)
    symbols[inside] = flat
    return symbols, starts, starts + sizes


def anchors(texts: Sequence[bytes], length: int) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """(text number, position, anchor hash, hash of the surroundings) of every picked anchor.

    The hash of the surroundings is one of all of them and two short ones, of the bytes right before
    and right after the anchor. A window of ``length`` has all of one of these two parts.
    """
    width, half = length - ANCHOR + 1, (length - ANCHOR) // 2
    symbols, starts, ends = laid_out(texts)
    hashes = WindowHashes(symbols, 2 * length - ANCHOR)
    grams = hashes(ANCHOR, slice(0, len(symbols) - ANCHOR + 1))
    step = np.zeros(len(grams) + 1, np.int32)
    long_enough = ends - starts >= length
    np.add.at(step, starts[long_enough], 1)
    np.add.at(step, ends[long_enough] - ANCHOR + 1, -1)
    usable = np.cumsum(step[:-1]) > 0
    grams[~usable] = MOST
    least = _sliding(grams, width, np.minimum)
    whole = np.zeros(len(least) + 1, np.int32)
    np.add.at(whole, starts[long_enough], 1)
    np.add.at(whole, ends[long_enough] - length + 1, -1)
    least[np.cumsum(whole[:-1]) == 0] = 0
    reach = _sliding(np.r_[np.zeros(width - 1, np.uint64), least, np.zeros(width - 1, np.uint64)], width, np.maximum)
    at = np.flatnonzero(usable & (reach[: len(grams)] == grams))
    around = hashes(2 * length - ANCHOR, at - (length - ANCHOR)) >> np.uint64(2 * NEAR_BITS) << np.uint64(2 * NEAR_BITS)
    around |= hashes(half, at - half) >> np.uint64(64 - NEAR_BITS) << np.uint64(NEAR_BITS)
    around |= hashes(half, at + ANCHOR) >> np.uint64(64 - NEAR_BITS)
    text = np.searchsorted(starts, at, side="right") - 1
    return text, at - starts[text], grams[at], around


def suffix_array(symbols: np.ndarray, ends: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Suffix array and ranks of segments laid out with terminators (symbol 0); ``ends``: their places.

    Larsson-Sadakane: sorted by the first symbols, then only groups not yet told apart are refined,
    by the rank of what follows, twice as far each time. Terminators are all different.
    """
    n, first = len(symbols), 7
    left = np.repeat(ends, np.diff(np.r_[-1, ends])) - np.arange(n)
    key, shift = np.zeros(n, np.uint64), symbols.astype(np.uint64)
    for k in range(first):
        key = (key << np.uint64(9)) | np.where(left >= k, np.r_[shift[k:], np.zeros(k, np.uint64)], np.uint64(0))
    alone = np.where(left < first, np.arange(n), -1)
    sa = np.lexsort((alone, key))
    new = np.r_[True, (key[sa][1:] != key[sa][:-1]) | (alone[sa][1:] != alone[sa][:-1])]
    start = np.flatnonzero(new)
    rank = np.empty(n, np.int64)
    rank[sa] = np.repeat(start, np.diff(np.r_[start, n]))
    sizes = np.diff(np.r_[start, n])
    open_at = np.flatnonzero(np.repeat(sizes > 1, sizes))
    h = first
    while len(open_at):
        own = sa[open_at]
        group, after = rank[own], rank[own + h]
        order = np.lexsort((after, group))
        own, group, after = own[order], group[order], after[order]
        sa[open_at] = own
        start = np.flatnonzero(np.r_[True, (group[1:] != group[:-1]) | (after[1:] != after[:-1])])
        sizes = np.diff(np.r_[start, len(own)])
        rank[own] = np.repeat(open_at[start], sizes)
        open_at = open_at[np.repeat(sizes > 1, sizes)]
        h *= 2
    return sa, rank


def common_prefixes(symbols: np.ndarray, ends: np.ndarray, sa: np.ndarray, rank: np.ndarray) -> np.ndarray:
    """Kasai's lengths, in text order: symbols shared by each suffix and the one sorted before it.

    The length falls by one from one text position to the next wherever the symbols before both
    suffixes agree; only the other places are compared symbol by symbol, all of them at once.
    """
    n = len(symbols)
    before = np.where(rank > 0, sa[rank - 1], -1)
    left = np.repeat(ends, np.diff(np.r_[-1, ends])) - np.arange(n)
    prior = np.r_[0, symbols[:-1]]
    same = symbols[before - 1] == prior
    follows = (before > 0) & same & (prior != 0) & (before == np.r_[-1, before[:-1]] + 1)
    fresh = np.flatnonzero(~follows & (before >= 0))
    shared = np.zeros(n, np.int64)
    most = np.minimum(left[fresh], left[before[fresh]])
    live, k = fresh[most > 0], 0
    limit = most[most > 0]
    while len(live):
        same = symbols[live + k] == symbols[before[live] + k]
        live, limit = live[same], limit[same]
        k += 1
        shared[live] = k
        more = limit > k
        live, limit = live[more], limit[more]
    origin = np.maximum.accumulate(np.where(follows, 0, np.arange(n)))
    return np.maximum(0, shared[origin] - (np.arange(n) - origin))


def shard_windows(segments: Sequence[bytes], length: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Segment, offset and number of its group of equal windows, for every whole window in suffix order."""
    sizes = np.array([len(s) for s in segments], np.int64)
    ends = np.cumsum(sizes + 1) - 1
    symbols = np.zeros(int(sizes.sum()) + len(segments), np.int16)
    inside = np.arange(int(sizes.sum())) + np.repeat(np.arange(len(segments)), sizes)
    symbols[inside] = np.frombuffer(b"".join(segments), np.uint8).astype(np.int16) + 1
    sa, rank = suffix_array(symbols, ends)
    shared = common_prefixes(symbols, ends, sa, rank)
    segment = np.repeat(np.arange(len(segments)), sizes + 1)
    whole = (ends[segment] - np.arange(len(symbols))) >= length
    kept = sa[whole[sa]]
    # Suffixes shorter than a window cannot stand between two that share a whole window.
    new = np.r_[True, shared[kept[1:]] < length] if len(kept) else np.zeros(0, bool)
    return segment[kept], kept - (ends - sizes)[segment[kept]], np.cumsum(new) - 1


MARK = "home int, kind int, ids binary, hashes binary, counts binary, pos binary"
MARK_NAMES = ["home", "kind", "ids", "hashes", "counts", "pos"]
DOC_MARKS = "doc_id long, th long, marks array<struct<kind:int,pos:binary>>"
COVERED, OPEN, REPEATED = 0, 1, 2


def _marks(docs: np.ndarray, pos: np.ndarray, kind: int, ids: np.ndarray, hashes: np.ndarray, homes: int) -> list[tuple]:
    """One row per home, a range of documents by hash, with their positions of one kind and how many each has.

    Buckets grow in number with the input, so a row per document in each would come to hold a single position.
    """
    if not len(docs):
        return []
    home = (mixed(ids.view(np.uint64) ^ hashes.view(np.uint64)) % np.uint64(homes)).astype(np.int64)[docs]
    order = np.lexsort((pos, docs, home))
    docs, pos, home = docs[order], pos[order].astype(np.uint32), home[order]
    start = np.flatnonzero(np.r_[True, docs[1:] != docs[:-1]])
    own, counts = docs[start], np.diff(np.r_[start, len(docs)]).astype(np.uint32)
    edges = np.r_[np.flatnonzero(np.r_[True, np.diff(home[start]) != 0]), len(start)].tolist()
    start = np.r_[start, len(docs)].tolist()
    return [
        (
            int(home[start[lo]]), kind, ids[own[lo:hi]].tobytes(), hashes[own[lo:hi]].tobytes(),
            counts[lo:hi].tobytes(), pos[start[lo] : start[hi]].tobytes(),
        )
        for lo, hi in zip(edges, edges[1:])
    ]


def _mark_batch(rows: list[tuple]) -> pa.RecordBatch:
    kinds = [pa.int32(), pa.int32(), *[pa.binary()] * 4]
    columns = list(zip(*rows)) if rows else [()] * 6
    return pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(columns, kinds)], MARK_NAMES)


def _gather(group: pa.Table) -> pa.Table:
    """One home's marks from all buckets, one row per document."""
    rows = group.to_pylist()
    ids, hashes = (np.concatenate([np.frombuffer(r[c], np.int64) for r in rows]) for c in ("ids", "hashes"))
    counts, pos = (np.concatenate([np.frombuffer(r[c], np.uint32) for r in rows]) for c in ("counts", "pos"))
    kind = np.repeat([r["kind"] for r in rows], [len(r["ids"]) // 8 for r in rows])
    counts = counts.astype(np.int64)
    begin = np.cumsum(counts) - counts
    order = np.lexsort((kind, hashes, ids))
    ids, hashes, kind, counts, begin = ids[order], hashes[order], kind[order], counts[order], begin[order]
    pos = pos[np.repeat(begin - (np.cumsum(counts) - counts), counts) + np.arange(len(pos))]
    new_doc = np.r_[True, (np.diff(ids) != 0) | (np.diff(hashes) != 0)]
    start = np.flatnonzero(new_doc | np.r_[True, np.diff(kind) != 0])
    ends = np.cumsum(counts)[np.r_[start[1:], len(ids)] - 1].tolist()
    found = pa.array([pos[lo:hi].tobytes() for lo, hi in zip([0, *ends], ends)], pa.binary())
    first = np.flatnonzero(new_doc)
    edges = pa.array(np.r_[np.searchsorted(start, first), len(start)].astype(np.int32))
    marks = pa.StructArray.from_arrays([pa.array(kind[start].astype(np.int32)), found], ["kind", "pos"])
    columns = [pa.array(ids[first]), pa.array(hashes[first]), pa.ListArray.from_arrays(edges, marks)]
    return pa.Table.from_arrays(columns, ["doc_id", "th", "marks"])


POSTED = "bucket int, key binary, around binary, doc binary, low binary, high binary, ids binary, hashes binary"
POSTED_NAMES = ["bucket", "key", "around", "doc", "low", "high", "ids", "hashes"]


def _post(key, around, doc, pos, ids, hashes, bits: int) -> Iterator[pa.RecordBatch]:
    """Entries (key, around, doc, pos) packed by the top bits of the key."""
    if not len(key):
        return
    wide = around is key
    order = np.argsort(key)
    key, around, doc, pos = key[order], around[order], doc[order], pos[order]
    bucket = (key >> np.uint64(64 - bits)).astype(np.int64) if bits else np.zeros(len(key), np.int64)
    edges = [0, *(np.flatnonzero(np.diff(bucket)) + 1).tolist(), len(key)]
    rows = []
    for lo, hi in zip(edges, edges[1:]):
        own, local = np.unique(doc[lo:hi], return_inverse=True)
        p = pos[lo:hi].astype(np.uint32)
        rows.append(
            (
                int(bucket[lo]),
                key[lo:hi].tobytes() if wide else (key[lo:hi] & np.uint64(0xFFFFFFFF)).astype(np.uint32).tobytes(),
                b"" if wide else around[lo:hi].tobytes(),
                local.astype(np.uint16).tobytes(),
                (p & 0xFFFF).astype(np.uint16).tobytes(),
                (p >> 16).astype(np.uint16).tobytes(),
                ids[own].tobytes(),
                hashes[own].tobytes(),
            )
        )
    kinds = [pa.int32(), *[pa.binary()] * 7]
    for at in range(0, len(rows), 256):
        part = rows[at : at + 256]
        yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(zip(*part), kinds)], POSTED_NAMES)


def _decided(doc, pos, ids, hashes) -> Iterator[pa.RecordBatch]:
    """Positions that need no merging, posted without keys to buckets of their own."""
    if len(doc):
        own, local = np.unique(doc, return_inverse=True)
        bucket = -1 - int((ids[own[0]] ^ hashes[own[-1]]) % DECIDED_BUCKETS)
        p = pos.astype(np.uint32)
        row = (
            bucket, b"", b"", local.astype(np.uint16).tobytes(), (p & 0xFFFF).astype(np.uint16).tobytes(),
            (p >> 16).astype(np.uint16).tobytes(), ids[own].tobytes(), hashes[own].tobytes(),
        )
        kinds = [pa.int32(), *[pa.binary()] * 7]
        yield pa.RecordBatch.from_arrays([pa.array([v], k) for v, k in zip(row, kinds)], POSTED_NAMES)


def _is_decided(group: pa.Table) -> bool:
    return group.column("bucket")[0].as_py() < 0


def _unpost(group: pa.Table, wide: bool):
    """The entries of one bucket and its documents: key, around, doc number, pos, ids, hashes, block number."""
    key, around, doc, pos, ids, hashes, block, count = [], [], [], [], [], [], [], 0
    for at, row in enumerate(group.to_pylist()):
        key.append(np.frombuffer(row["key"], np.uint64 if wide else np.uint32))
        if not wide:
            around.append(np.frombuffer(row["around"], np.uint64))
        doc.append(np.frombuffer(row["doc"], np.uint16).astype(np.int64) + count)
        pos.append(np.frombuffer(row["low"], np.uint16).astype(np.int64) | np.frombuffer(row["high"], np.uint16).astype(np.int64) << 16)
        ids.append(np.frombuffer(row["ids"], np.int64))
        hashes.append(np.frombuffer(row["hashes"], np.int64))
        block.append(np.full(len(key[-1]), at))
        count += len(ids[-1])
    join = np.concatenate
    return join(key), join(around) if around else None, join(doc), join(pos), join(ids), join(hashes), join(block)


def _scan(length: int, bits: int):
    """Anchors of all texts, packed by bucket."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        parts, ids, hashes, count, held = [], [], [], 0, 0

        def flush():
            key, around, doc, pos = (np.concatenate(c) for c in zip(*parts))
            named, known = np.array(ids, np.int64), np.array(hashes, np.int64)
            owner = named[doc]
            order = np.lexsort((owner, around, key))
            new = np.r_[True, (np.diff(key[order]) != 0) | (np.diff(around[order]) != 0)]
            least = owner[order][new][np.cumsum(new) - 1]
            # Behind an earlier document of this very task with the same surroundings: decided here.
            later = np.zeros(len(key), bool)
            later[order] = owner[order] > least
            yield from _decided(doc[later], pos[later], named, known)
            rest = ~later
            yield from _post(key[rest], around[rest], doc[rest], pos[rest], named, known, bits)

        for batch in batches:
            texts = batch.column("text").cast(pa.binary()).to_pylist()
            own = list(zip(batch.column("doc_id").to_pylist(), batch.column("th").to_pylist(), texts))
            own = [(i, h, t) for i, h, t in own if i is not None and t is not None and len(t) >= length]
            at = 0
            while at < len(own):
                end, total = at, 0
                while end < len(own) and (end == at or total + len(own[end][2]) <= PIECE_BYTES):
                    total += len(own[end][2])
                    end += 1
                text, pos, key, around = anchors([t for _, _, t in own[at:end]], length)
                parts.append((key, around, text + count, pos))
                ids += [i for i, _, _ in own[at:end]]
                hashes += [h for _, h, _ in own[at:end]]
                count += end - at
                held += len(key)
                at = end
                if held >= FLUSH or count >= 40_000:
                    yield from flush()
                    parts, ids, hashes, count, held = [], [], [], 0, 0
        if held:
            yield from flush()

    return run


def _settle(homes: int):
    """One bucket's anchors: those covered by an earlier document's surroundings, and the open ones."""

    def run(group: pa.Table) -> pa.Table:
        key, around, doc, pos, ids, hashes, _ = _unpost(group, wide=False)
        if _is_decided(group):
            return pa.Table.from_batches([_mark_batch(_marks(doc, pos, COVERED, ids, hashes, homes))])
        owner = ids[doc]
        order = np.lexsort((owner, around, key))
        key, around, doc, pos, owner = key[order], around[order], doc[order], pos[order], owner[order]
        new_key = np.r_[True, key[1:] != key[:-1]]
        new_class = new_key | np.r_[True, around[1:] != around[:-1]]
        starts = np.flatnonzero(new_class)
        class_of = np.cumsum(new_class) - 1
        covered = owner > owner[starts][class_of]  # sorted by owner within a class
        first = np.zeros(len(key), bool)
        first[starts] = True
        is_open = np.zeros(len(key), bool)
        for shift in (0, NEAR_BITS):
            # Only where the bytes on one side agree too can two documents share a whole window.
            near = around >> np.uint64(shift) & np.uint64((1 << NEAR_BITS) - 1)
            order = np.lexsort((near, key))
            group = np.r_[True, (np.diff(key[order]) != 0) | (np.diff(near[order]) != 0)]
            begin, of = np.flatnonzero(group), np.cumsum(group) - 1
            classes = np.bincount(of, weights=first[order], minlength=len(begin))
            low, high = np.minimum.reduceat(owner[order], begin), np.maximum.reduceat(owner[order], begin)
            is_open[order] |= ((classes > 1) & (low != high))[of]
        is_open &= ~covered
        rows = _marks(doc[covered], pos[covered], COVERED, ids, hashes, homes)
        rows += _marks(doc[is_open], pos[is_open], OPEN, ids, hashes, homes)
        return pa.Table.from_batches([_mark_batch(rows)])

    return run


def _positions(marks: list[dict], kind: int) -> np.ndarray:
    found = [np.frombuffer(m["pos"], np.uint32) for m in marks or [] if m["kind"] == kind]
    return np.unique(np.concatenate(found)).astype(np.int64) if found else np.empty(0, np.int64)


def _stretches(at: np.ndarray, before: int, after: int, size: int) -> np.ndarray:
    """Merged [start, end) around positions, within a text."""
    if not len(at):
        return np.empty((0, 2), np.int64)
    lo, hi = np.maximum(0, at - before), np.minimum(size, at + after)
    new = np.r_[True, lo[1:] > np.maximum.accumulate(hi)[:-1]]
    start = np.flatnonzero(new)
    return np.stack([lo[start], np.maximum.reduceat(hi, start)], 1)


def _shards(length: int, bits: int):
    """Suffix arrays of the open stretches; each shard's windows, posted by the range of their hash."""

    def posted(segments: list[bytes], own: list[tuple], ids: np.ndarray, hashes: np.ndarray):
        place = np.array(own, np.int64)
        segment, offset, group = shard_windows(segments, length)
        doc, pos = place[segment, 0], place[segment, 1] + offset
        # One hash a group of equal windows, from the first of it.
        lead = np.flatnonzero(np.r_[True, group[1:] != group[:-1]]) if len(group) else np.empty(0, np.int64)
        symbols, starts, _ = laid_out(segments)
        key = WindowHashes(symbols, length)(length, starts[segment[lead]] + offset[lead])[group]
        owner = ids[doc]
        later = owner > np.minimum.reduceat(owner, lead)[group] if len(lead) else np.zeros(0, bool)
        yield from _decided(doc[later], pos[later], ids, hashes)
        key = key[~later]
        yield from _post(key, key, doc[~later], pos[~later], ids, hashes, bits)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        segments, own, ids, hashes, held = [], [], [], [], 0
        for batch in batches:
            for row in batch.to_pylist():
                text = row["text"].encode()
                at = _positions(row["marks"], OPEN)
                for lo, hi in _stretches(at, length - ANCHOR, length, len(text)).tolist():
                    segments.append(text[lo:hi])
                    own.append((len(ids), lo))
                    held += hi - lo
                ids.append(row["doc_id"])
                hashes.append(row["th"])
                if held >= SHARD_BYTES or len(ids) >= 60_000:
                    yield from posted(segments, own, np.array(ids, np.int64), np.array(hashes, np.int64))
                    segments, own, ids, hashes, held = [], [], [], [], 0
        if segments:
            yield from posted(segments, own, np.array(ids, np.int64), np.array(hashes, np.int64))

    return run


def _merge(homes: int):
    """Windows of one hash range: each shard's are looked up in all shards' merged windows."""

    def run(group: pa.Table) -> pa.Table:
        key, _, doc, pos, ids, hashes, block = _unpost(group, wide=True)
        if _is_decided(group):
            return pa.Table.from_batches([_mark_batch(_marks(doc, pos, REPEATED, ids, hashes, homes))])
        owner = ids[doc]
        order = np.lexsort((owner, key))
        merged, first = np.unique(key[order], return_index=True)
        earliest = owner[order][first]
        found = np.zeros(len(key), bool)
        edges = np.r_[np.flatnonzero(np.r_[True, np.diff(block) != 0]), len(block)]
        for lo, hi in zip(edges[:-1].tolist(), edges[1:].tolist()):
            found[lo:hi] = earliest[np.searchsorted(merged, key[lo:hi])] < owner[lo:hi]
        return pa.Table.from_batches([_mark_batch(_marks(doc[found], pos[found], REPEATED, ids, hashes, homes))])

    return run


def _cut(length: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            kept, spans, sizes, clean = [], [], [], []
            texts = batch.column("text").cast(pa.binary()).to_pylist()
            for text, marks in zip(texts, batch.column("marks").to_pylist(), strict=True):
                missing, text = text is None, text or b""
                covered = _stretches(_positions(marks, COVERED), length - ANCHOR, length, len(text))
                repeated = _stretches(_positions(marks, REPEATED), 0, length, len(text))
                own = np.concatenate([covered, repeated])
                if len(own):
                    own = own[np.argsort(own[:, 0], kind="stable")]
                    high = np.maximum.accumulate(own[:, 1])
                    start = np.flatnonzero(np.r_[True, own[1:, 0] > high[:-1]])
                    own = np.stack([own[start, 0], np.maximum.reduceat(own[:, 1], start)], 1)
                own = own.tolist()
                out, at = [], 0
                for lo, hi in own:
                    out.append(text[at:lo])
                    at = hi
                out.append(text[at:])
                kept.append(b"".join(out))
                spans.append([{"start": lo, "end": hi} for lo, hi in own])
                sizes.append(len(text))
                clean.append(None if missing else kept[-1].decode("utf-8", "ignore"))
            span = pa.list_(pa.struct([("start", pa.int64()), ("end", pa.int64())]))
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column("doc_id"),
                    pa.array(sizes, pa.int64()),
                    pa.array(spans, span),
                    pa.array(kept, pa.binary()),
                    pa.array(clean, pa.string()),
                    batch.column("carried"),
                ],
                ["doc_id", "n_bytes", "spans", "kept", "text", "carried"],
            )

    return run


def without_repeats(docs: DataFrame, length: int = 50, carry: Sequence[str] = ()) -> DataFrame:
    """(doc_id, n_bytes, spans, kept, text, carried) for each row of ``docs`` (doc_id, text, any others).

    A byte goes when a ``length``-byte string that covers it also starts in a document with a smaller
    doc_id; strings are judged on the input and do not cross documents. ``spans`` are the removed
    runs [start, end), ``kept`` the remaining UTF-8 bytes, ``text`` those as characters, without ones cut
    apart (NULL where it was NULL), ``carried`` a struct of the columns named
    in ``carry``. NULL text counts as empty. Rows that repeat a doc_id do not count as earlier than
    each other. A row without doc_id is neither searched nor cut. Empty tables give empty results.
    """
    carried = F.struct(*[F.col(f"`{c}`") for c in carry]) if carry else F.struct(F.lit(None).cast("int").alias("none"))
    docs = docs.select(
        F.col("doc_id").cast("long"),
        F.xxhash64("text").alias("th"),
        F.col("text").cast("string").alias("text"),
        carried.alias("carried"),
    )
    total = docs.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    bits, wide_bits = (max(0, int(total * 0.065 / most).bit_length()) for most in (ANCHORS_PER_BUCKET, WINDOWS_PER_BUCKET))
    homes = max(HOMES, total // HOME_BYTES)
    narrow = docs.select("doc_id", "th", "text")
    posted = arrow_map(narrow, _scan(length, bits), POSTED)
    settled = saved(arrow_groups(posted, ["bucket"], _settle(homes), MARK), "suffix-settled")

    def per_doc(marks: DataFrame) -> DataFrame:
        return arrow_groups(marks, ["home"], _gather, DOC_MARKS)

    opened = saved(per_doc(settled.filter(F.col("kind") == OPEN)), "suffix-opened")
    # Only texts with open anchors move; while these are few, the others are left out before the shuffle.
    named = opened.select("doc_id", "th")
    texts = narrow.join(F.broadcast(named), ["doc_id", "th"], "left_semi") if named.count() <= BROADCAST_ROWS else narrow
    windows = arrow_map(texts.join(opened, ["doc_id", "th"]), _shards(length, wide_bits), POSTED)
    merged = saved(arrow_groups(windows, ["bucket"], _merge(homes), MARK), "suffix-merged")
    marks = per_doc(settled.filter(F.col("kind") == COVERED).unionByName(merged))
    schema = (
        "doc_id long, n_bytes long, spans array<struct<start:long,end:long>>, kept binary, text string, carried "
        + docs.schema["carried"].dataType.simpleString()
    )
    return arrow_map(docs.join(marks, ["doc_id", "th"], "left").select("doc_id", "text", "marks", "carried"), _cut(length), schema)
