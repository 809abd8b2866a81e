"""Alignment of two tokenizers by byte offsets, composed from fragments of byte ranges.

A text is encoded by a byte-level BPE (A, over a space and the text) and a piece model (B, which adds
the space itself). Offsets where tokens of both end cut the bytes into groups. A fragment is what one
byte range knows: an open prefix (its tokens up to the first common end; where the group began is not
known yet), closed groups, and an open suffix (tokens behind its last common end). Fragments compose
associatively: suffix and next prefix make one group. Texts are cut at single spaces, which no token of
either vocabulary crosses: what is between two of them gives closed groups whatever stands around it,
and is encoded once for all its occurrences in a batch. Stretches of over ``RANGE`` bytes without such a
space are composed from byte ranges. Texts of more than ``LONG`` bytes are cut into parts that are encoded
in different tasks and composed by tree reduction.

Texts that are NULL, empty or not restored by either tokenizer have no tokens. Every row is worked on
by itself, so repeated rows and doc_ids count as often as they occur. A long text without such a space is one
part, encoded in one task. Empty tables give empty results; further columns of any name do not matter.
"""

from __future__ import annotations

import hashlib
import json
import os
import re
import sys
from collections.abc import Iterator
from itertools import chain
from types import ModuleType
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidelake.llm.common import arrow_groups, arrow_map, pieces_of, saved

LONG = 64 << 10
RANGE = 4 << 10
FAN_IN = 8
#: Id pairs with the highest counts that every task gets; counts of the others are joined.
FREQUENT_PAIRS = 1 << 20
B_IDS = 1 << 16

BYTES_AT_ONCE = 2 << 20
#: A worker remembers so many words of so many characters at most.
WORDS_KEPT, LONGEST_KEPT = 300_000, 48
#: A single space between characters that are none: no piece has a space inside, no A token has one but first.
_CUT = re.compile(r"(?<=\S) (?=\S)")


class Vocabulary(NamedTuple):
    """The bytes of each token, by id."""

    pieces: list[bytes]

    @property
    def sizes(self) -> np.ndarray:
        return np.array([len(p) for p in self.pieces], np.int64)


def byte_characters() -> dict[str, int]:
    """Byte-level BPE's printable stand-ins: printable Latin-1 bytes are themselves, the others follow U+0100."""
    plain = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    others = [b for b in range(256) if b not in set(plain)]
    return {chr(b): b for b in plain} | {chr(0x100 + i): b for i, b in enumerate(others)}


class Encoders:
    """Both tokenizers with the bytes of their tokens; opened once a task."""

    def __init__(self, byte_path: str, piece_path: str) -> None:
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        import sentencepiece
        from tokenizers import Tokenizer

        self.a = Tokenizer.from_file(byte_path)
        self.a.encode_special_tokens = True
        with open(byte_path, encoding="utf-8") as file:
            read = json.load(file)
        stand_in = byte_characters()
        a_bytes = {i: bytes(stand_in[c] for c in token) for token, i in read["model"]["vocab"].items()}
        for added in read.get("added_tokens", ()):
            a_bytes.setdefault(added["id"], added["content"].encode())
        self.a_vocabulary = Vocabulary([a_bytes.get(i, b"") for i in range(max(a_bytes) + 1)])
        self.b = sentencepiece.SentencePieceProcessor(model_file=piece_path)
        pieces = []
        for i in range(self.b.get_piece_size()):
            piece = self.b.id_to_piece(i)
            if "▁" in piece.lstrip("▁"):
                raise ValueError(f"piece {piece!r} has a space inside, so texts cannot be cut at spaces")
            if self.b.is_byte(i):
                pieces.append(bytes([int(piece[3:-1], 16)]))
            else:
                pieces.append(piece.replace("▁", " ").encode())
        self.b_vocabulary = Vocabulary(pieces)
        self.a_sizes, self.b_sizes = self.a_vocabulary.sizes, self.b_vocabulary.sizes

    def flat(self, texts: list[str]) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray, bool]:
        """Ids of all texts by A and B one after the other, their numbers a text, and whether both give all texts back."""
        spaced = [f" {t}" for t in texts]
        a_ids = [e.ids for e in self.a.encode_batch_fast(spaced, add_special_tokens=False)]
        b_ids = self.b.encode(texts, num_threads=1)
        want, good, out = "".join(spaced).encode(), True, []
        for ids, pieces in ((a_ids, self.a_vocabulary.pieces), (b_ids, self.b_vocabulary.pieces)):
            joined = list(chain.from_iterable(ids))
            good = good and b"".join(map(pieces.__getitem__, joined)) == want
            out += [np.array(joined, np.int64), np.fromiter(map(len, ids), np.int64, len(ids))]
        return *out, good

    def __call__(self, texts: list[str]) -> Iterator[tuple[np.ndarray, np.ndarray] | None]:
        """The ids of each text by A and B; None where either does not give the text back."""
        for text in texts:
            a, _, b, _, good = self.flat([text])
            yield (a, b) if good else None


class Fragment(NamedTuple):
    """Tokens of one byte range. Without a common end all of them are in the prefix, the suffix is empty.

    ``prefix`` and ``suffix`` are ids of A and of B; ``body`` are the closed groups between them as
    text, joined by ';'; ``cuts`` counts common ends; ``links`` are the ids that end together at each, a << 16 | b.
    """

    n_a: int
    n_b: int
    cuts: int
    prefix: tuple[np.ndarray, np.ndarray]
    body: bytes
    suffix: tuple[np.ndarray, np.ndarray]
    links: np.ndarray


_NONE = np.empty(0, np.int64)
EMPTY = Fragment(0, 0, 0, (_NONE, _NONE), b"", (_NONE, _NONE), np.empty(0, np.uint32))


def _digits() -> tuple[np.ndarray, np.ndarray]:
    text = [str(i).encode() for i in range(1 << 16)]
    return np.array(text, "S6").view(np.uint8).reshape(-1, 6).copy(), np.array([len(t) for t in text])


_TABLE: list = []


def group_text(a: np.ndarray, b: np.ndarray, a_cuts: np.ndarray, b_cuts: np.ndarray) -> tuple[bytes, np.ndarray]:
    """``a1,a2|b1;a3|b2,b3;``: groups whose last tokens are at the given places; and where each group's text ends."""
    if not _TABLE:
        _TABLE.extend(_digits())
    table, lengths = _TABLE
    n = len(a) + len(b)
    a_group = np.searchsorted(a_cuts, np.arange(len(a)), "left")
    b_group = np.searchsorted(b_cuts, np.arange(len(b)), "left")
    a_place = np.arange(len(a)) + np.r_[0, b_cuts + 1][a_group]
    b_place = np.arange(len(b)) + np.r_[a_cuts + 1, len(a)][b_group]
    ids, mark = np.empty(n, np.int64), np.full(n, ord(","), np.uint8)
    ids[a_place], ids[b_place] = a, b
    mark[a_place[a_cuts]], mark[b_place[b_cuts]] = ord("|"), ord(";")
    length = lengths[ids]
    flat = table[ids]
    flat[np.arange(n), length] = mark
    text = flat[np.arange(6) <= length[:, None]].tobytes()
    return text, np.cumsum(length + 1)[b_place[b_cuts]]


def _written(a: np.ndarray, b: np.ndarray) -> bytes:
    return f"{','.join(map(str, a.tolist()))}|{','.join(map(str, b.tolist()))}".encode()


def fragment(a: np.ndarray, b: np.ndarray, a_ends: np.ndarray, b_ends: np.ndarray) -> Fragment:
    """The fragment of a byte range from the tokens that end in it and their ends, counted from anywhere."""
    at = np.searchsorted(a_ends, b_ends)
    common = at < len(a_ends)
    common[common] = a_ends[at[common]] == b_ends[common]
    b_cuts = np.flatnonzero(common)
    a_cuts = at[common]
    if not len(a_cuts):
        return Fragment(len(a), len(b), 0, (a, b), b"", (_NONE, _NONE), np.empty(0, np.uint32))
    links = (a[a_cuts] << 16 | b[b_cuts]).astype(np.uint32)
    i, j, k, m = a_cuts[0] + 1, b_cuts[0] + 1, a_cuts[-1] + 1, b_cuts[-1] + 1
    body = group_text(a[i:k], b[j:m], a_cuts[1:] - i, b_cuts[1:] - j)[0][:-1]
    return Fragment(len(a), len(b), len(a_cuts), (a[:i], b[:j]), body, (a[k:], b[m:]), links)


def composed(left: Fragment, right: Fragment) -> Fragment:
    """The fragment of two neighbouring ranges; associative, with ``EMPTY`` as its neutral element."""

    def joined(x, y):
        return np.concatenate([x[0], y[0]]), np.concatenate([x[1], y[1]])

    n_a, n_b, links = left.n_a + right.n_a, left.n_b + right.n_b, np.concatenate([left.links, right.links])
    if not left.cuts:
        return Fragment(n_a, n_b, right.cuts, joined(left.prefix, right.prefix), right.body, right.suffix, links)
    if not right.cuts:
        return Fragment(n_a, n_b, left.cuts, left.prefix, left.body, joined(left.suffix, right.prefix), links)
    closed = _written(*joined(left.suffix, right.prefix))
    body = b";".join(part for part in (left.body, closed, right.body) if part)
    return Fragment(n_a, n_b, left.cuts + right.cuts, left.prefix, body, right.suffix, links)


def reduced(parts: list[Fragment]) -> Fragment:
    """All fragments composed in order, by halves."""
    while len(parts) > 1:
        parts = [composed(*parts[i : i + 2]) if i + 1 < len(parts) else parts[i] for i in range(0, len(parts), 2)]
    return parts[0] if parts else EMPTY


def ranges(a: np.ndarray, b: np.ndarray, a_sizes: np.ndarray, b_sizes: np.ndarray, width: int = RANGE) -> Fragment:
    """The fragment of a part of a text, composed from its byte ranges of ``width``."""
    a_ends, b_ends = np.cumsum(a_sizes[a]), np.cumsum(b_sizes[b])
    total = int(max(a_ends[-1] if len(a) else 0, b_ends[-1] if len(b) else 0))
    edges = np.arange(width, total + width, width)
    a_at, b_at = np.searchsorted(a_ends, edges, "right"), np.searchsorted(b_ends, edges, "right")
    out, i, j = [], 0, 0
    for k, m in zip(a_at.tolist(), b_at.tolist()):
        out.append(fragment(a[i:k], b[j:m], a_ends[i:k], b_ends[j:m]))
        i, j = k, m
    return reduced(out)


def groups_of(whole: Fragment) -> bytes:
    """All groups of a whole text; its end is a common one, so nothing is open but where the prefix began."""
    if not whole.cuts:
        return b""
    first = _written(*whole.prefix)
    return first + b";" + whole.body if whole.body else first


_FRAGMENT = (
    "n_a long, n_b long, cuts long, prefix_a binary, prefix_b binary, body binary, suffix_a binary, suffix_b binary, "
    "links binary"
)
_FRAGMENT_TYPES = [pa.int64()] * 3 + [pa.binary()] * 6


def _stored(f: Fragment) -> tuple:
    return (
        f.n_a, f.n_b, f.cuts, f.prefix[0].tobytes(), f.prefix[1].tobytes(), f.body,
        f.suffix[0].tobytes(), f.suffix[1].tobytes(), f.links.tobytes(),
    )


def _restored(row: dict) -> Fragment:
    ids = {c: np.frombuffer(row[c], np.int64) for c in ("prefix_a", "prefix_b", "suffix_a", "suffix_b")}
    return Fragment(
        row["n_a"], row["n_b"], row["cuts"], (ids["prefix_a"], ids["prefix_b"]), row["body"],
        (ids["suffix_a"], ids["suffix_b"]), np.frombuffer(row["links"], np.uint32),
    )


_ALIGNED = "row long, doc_id {id}, n_a long, n_b long, n_groups long, links binary, groups_sha256 string"


def _columns(rows: list[tuple], types: list[pa.DataType], names: list[str]) -> pa.RecordBatch:
    columns = zip(*rows) if rows else [()] * len(types)
    return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(columns, types)], names=names)


class Words:
    """What a text's words give, each encoded once: a word begins with a single space no token crosses.

    A word's end is a common end, so a word is a run of closed groups; a text is its words' runs one after
    the other. Words of more than ``range_bytes`` are composed from fragments of byte ranges. Short words
    are remembered; when there are over ``WORDS_KEPT`` of them, those of the last texts alone stay.
    """

    def __init__(self, byte_path: str, piece_path: str, range_bytes: int = RANGE) -> None:
        self.encoders, self.range_bytes = Encoders(byte_path, piece_path), range_bytes
        self.known: dict[str, tuple | None] = {}

    def learn(self, words: list[str]) -> dict[str, tuple | None]:
        """(n_a, n_b, groups each with ';', links) of each word; None where a tokenizer does not give it back."""
        short = [w for w in words if 0 < len(w) <= self.range_bytes]
        a, a_counts, b, b_counts, good = self.encoders.flat(short)
        if good:
            out: dict[str, tuple | None] = dict(zip(short, _closed_runs(a, a_counts, b, b_counts, self.encoders)))
        else:
            half = len(short) // 2
            out = {short[0]: None} if not half else self.learn(short[:half]) | self.learn(short[half:])
        for word in words:
            if not word:
                out[word] = None
            elif len(word) > self.range_bytes:
                (own,) = self.encoders([word])
                made = own and ranges(*own, self.encoders.a_sizes, self.encoders.b_sizes, self.range_bytes)
                out[word] = made and (made.n_a, made.n_b, groups_of(made) + b";", made.links.tobytes())
        return out

    def __call__(self, texts: list[str]) -> Iterator[tuple[int, int, bytes, bytes] | None]:
        """The same for whole texts."""
        split = [_CUT.split(t) for t in texts]
        used = set().union(*split)
        new = [w for w in used if w not in self.known]
        own: dict[str, tuple | None] = {}
        for start, stop in _runs_of_bytes(new, BYTES_AT_ONCE):
            own.update(self.learn(new[start:stop]))
        known = self.known
        for words in split:
            parts = [own[w] if w in own else known[w] for w in words]
            if None in parts:
                yield None
                continue
            n_a, n_b, groups, links = zip(*parts)
            yield sum(n_a), sum(n_b), b"".join(groups), b"".join(links)
        if len(self.known) + len(own) > WORDS_KEPT:
            self.known = {w: known[w] for w in used if w in known}
        self.known.update((w, made) for w, made in own.items() if len(w) <= LONGEST_KEPT)


def worker_words(byte_path: str, piece_path: str, range_bytes: int) -> Words:
    """The worker's own: what one task has learned of the words serves the next."""
    kept = sys.modules.setdefault("_tidelake_aligned_words", ModuleType("_tidelake_aligned_words")).__dict__
    key = f"{byte_path}|{piece_path}|{range_bytes}"
    if key not in kept:
        kept[key] = Words(byte_path, piece_path, range_bytes)
    return kept[key]


def _runs_of_bytes(words: list[str], most: int) -> Iterator[tuple[int, int]]:
    """(start, stop) of runs of at most ``most`` characters, or one longer word."""
    start, total = 0, 0
    for i, word in enumerate(words):
        if i > start and total + len(word) > most:
            yield start, i
            start, total = i, 0
        total += len(word) + 1
    if words:
        yield start, len(words)


def _closed_runs(
    a: np.ndarray, a_counts: np.ndarray, b: np.ndarray, b_counts: np.ndarray, encoders: Encoders
) -> Iterator[tuple[int, int, bytes, bytes]]:
    """(n_a, n_b, groups, links) of many words: ends are counted on from word to word, whose ends are common."""
    if not len(a):
        return
    a_ends, b_ends = np.cumsum(encoders.a_sizes[a]), np.cumsum(encoders.b_sizes[b])
    at = np.searchsorted(a_ends, b_ends)
    b_cuts = np.flatnonzero(a_ends[at] == b_ends)
    a_cuts = at[b_cuts]
    links = (a[a_cuts] << 16 | b[b_cuts]).astype("<u4").tobytes()
    text, ends = group_text(a, b, a_cuts, b_cuts)
    last = np.searchsorted(a_cuts, np.cumsum(a_counts) - 1)
    first, begin = 0, 0
    for n_a, n_b, stop, end in zip(a_counts.tolist(), b_counts.tolist(), (4 * (last + 1)).tolist(), ends[last].tolist()):
        yield n_a, n_b, text[begin:end], links[first:stop]
        first, begin = stop, end


def _short(docs: DataFrame, byte_path: str, piece_path: str, width: int) -> DataFrame:
    """Rows encoded and aligned one by one; long texts are passed over."""
    id_type = docs.schema["doc_id"].dataType.simpleString()

    def encode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        words = worker_words(byte_path, piece_path, width)
        names = ["row", "doc_id", "n_a", "n_b", "n_groups", "links", "groups_sha256"]
        types = [pa.int64()] * 3 + [pa.binary(), pa.string()]
        for whole in batches:
            for start, piece in pieces_of(whole, "text", BYTES_AT_ONCE):
                batch, out = whole.slice(start, len(piece)), []
                for made in words([t.decode() for t in piece]):
                    n_a, n_b, groups, links = made or (0, 0, b"", b"")
                    digest = hashlib.sha256(groups[:-1]).hexdigest() if made else ""
                    out.append((n_a, n_b, len(links) // 4, links, digest))
                made = [pa.array(c, t) for c, t in zip(zip(*out), types)]
                yield pa.RecordBatch.from_arrays([batch.column("row"), batch.column("doc_id"), *made], names=names)

    return arrow_map(docs, encode, _ALIGNED.format(id=id_type))


def _part_fragment(made: tuple[int, int, bytes, bytes]) -> Fragment:
    """A run of closed groups as the fragment of a part: where its first group began is for its neighbour to say."""
    n_a, n_b, groups, links = made
    first, _, body = groups[:-1].partition(b";")
    prefix = tuple(np.array(ids.split(b","), np.int64) for ids in first.split(b"|"))
    links = np.frombuffer(links, np.uint32)
    return Fragment(n_a, n_b, len(links), prefix, body, (_NONE, _NONE), links)


def _cut(text: str, most: int) -> list[str]:
    """Parts of about ``most`` characters, each begun by the space before its first word but the first one."""
    parts, start = [], 0
    while len(text) - start > most:
        found = _CUT.search(text, start + most)
        if not found:
            break
        parts.append(text[start : found.start()])
        start = found.start()
    return [*parts, text[start:]]


def _long(docs: DataFrame, byte_path: str, piece_path: str, long: int, width: int) -> DataFrame:
    """Long texts: cut, encoded part by part in tasks of their own, composed in a tree."""
    id_type = docs.schema["doc_id"].dataType.simpleString()

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row, doc_id, text in zip(*[batch.column(c).to_pylist() for c in ("row", "doc_id", "text")]):
                parts = _cut(text, long)
                # Only the first part has not the space that begins it; the tokenizers are given texts without it.
                rows = [(row, doc_id, i, part[1:] if i else part) for i, part in enumerate(parts)]
                yield pa.RecordBatch.from_arrays(
                    [pa.array(c) for c in zip(*rows)], names=["row", "doc_id", "part", "text"]
                ).cast(_arrow_schema(id_type))

    def encode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        words = worker_words(byte_path, piece_path, width)
        names = ["row", "doc_id", "part", "whole", *[c.split()[0] for c in _FRAGMENT.split(", ")]]
        types = [pa.int64(), _arrow(id_type), pa.int64(), pa.bool_(), *_FRAGMENT_TYPES]
        for batch in batches:
            for row, doc_id, part, text in zip(*[c.to_pylist() for c in batch.columns]):
                (made,) = words([text])
                stored = _stored(_part_fragment(made) if made else EMPTY)
                yield _columns([(row, doc_id, part, made is not None, *stored)], types, names)

    parts = saved(arrow_map(docs, cut, f"row long, doc_id {id_type}, part long, text string", rows=16), "align-parts")
    dealt = parts.repartition(F.xxhash64("row", "part"))
    schema = f"row long, doc_id {id_type}, part long, whole boolean, {_FRAGMENT}"
    level = saved(arrow_map(dealt, encode, schema, rows=64), "align-fragments")

    def compose(rows: pa.Table) -> pa.Table:
        rows = rows.sort_by("part").to_pylist()
        made = reduced([_restored(r) for r in rows])
        head = (rows[0]["row"], rows[0]["doc_id"], rows[0]["part"] // FAN_IN, all(r["whole"] for r in rows))
        types = [pa.int64(), _arrow(id_type), pa.int64(), pa.bool_(), *_FRAGMENT_TYPES]
        return pa.Table.from_batches([_columns([(*head, *_stored(made))], types, list(rows[0]))])

    while (level.agg(F.max("part")).first()[0] or 0) > 0:
        group = level.withColumn("group", F.floor(F.col("part") / FAN_IN))
        level = saved(
            arrow_groups(group, ["row", "group"], lambda t: compose(t.drop_columns(["group"])), schema), "align-fragments"
        )

    def finish(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        names = ["row", "doc_id", "n_a", "n_b", "n_groups", "links", "groups_sha256"]
        types = [pa.int64(), _arrow(id_type), *[pa.int64()] * 3, pa.binary(), pa.string()]
        for batch in batches:
            rows = []
            for r in batch.to_pylist():
                f = _restored(r)
                if r["whole"]:
                    digest = hashlib.sha256(groups_of(f)).hexdigest()
                    rows.append((r["row"], r["doc_id"], f.n_a, f.n_b, f.cuts, f.links.tobytes(), digest))
                else:
                    rows.append((r["row"], r["doc_id"], 0, 0, 0, b"", ""))
            yield _columns(rows, types, names)

    return arrow_map(level, finish, _ALIGNED.format(id=id_type), rows=64)


def _arrow(spark_type: str) -> pa.DataType:
    return {"bigint": pa.int64(), "int": pa.int32(), "string": pa.string()}[spark_type]


def _arrow_schema(id_type: str) -> pa.Schema:
    return pa.schema([("row", pa.int64()), ("doc_id", _arrow(id_type)), ("part", pa.int64()), ("text", pa.string())])


def aligned(docs: DataFrame, byte_path: str, piece_path: str, longest: int = LONG, width: int = RANGE) -> DataFrame:
    """(row, doc_id, n_a, n_b, n_groups, links, groups_sha256) of each row, written; links are a << 16 | b in 32 bits.

    Texts of more than ``longest`` bytes are worked on in parts of about as many characters, and these in
    ranges of ``width`` bytes.
    """
    long = F.coalesce(F.octet_length("text") > longest, F.lit(False))
    number = F.monotonically_increasing_id()
    short = docs.filter(~long).select(number.alias("row"), "doc_id", "text")
    short = saved(_short(short, byte_path, piece_path, width), "align-short")
    # Numbers are kept by the written parts; those of long texts are below zero.
    long_rows = docs.filter(long).select((-1 - number).alias("row"), "doc_id", "text")
    return short.unionByName(saved(_long(long_rows, byte_path, piece_path, longest, width), "align-long"))


def pair_counts(rows: DataFrame) -> DataFrame:
    """(pair, n): how many links of all rows hold each id pair; batches are counted before they are shuffled."""

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            pairs, n = np.unique(np.frombuffer(b"".join(batch.column("links").to_pylist()), "<u4"), return_counts=True)
            yield pa.RecordBatch.from_arrays(
                [pa.array(pairs.astype(np.int64)), pa.array(n.astype(np.int64))], names=["pair", "n"]
            )

    return arrow_map(rows.select("links"), count, "pair long, n long").groupBy("pair").agg(F.sum("n").alias("n"))


def best_counts(pairs: DataFrame) -> np.ndarray:
    """The highest count of any pair of each B id; as many numbers as B has ids."""
    out = np.zeros(B_IDS, np.int64)
    for row in pairs.groupBy((F.col("pair") % B_IDS).alias("b")).agg(F.max("n").alias("n")).collect():
        out[row.b] = row.n
    return out


def counted(rows: DataFrame, frequent_pairs: int = FREQUENT_PAIRS) -> DataFrame:
    """``rows`` of ``aligned`` with n_links, n_best and count_sum.

    The counts of the ``frequent_pairs`` commonest pairs are looked up in every task; the others, rare
    and so never hot, are joined.
    """
    pairs = saved(pair_counts(rows), "align-pairs")
    best = best_counts(pairs)
    # The commonest pairs are those from some power of two on; there are at most 64 of these.
    powers = pairs.groupBy(F.floor(F.log2("n")).alias("power")).agg(F.count("*").alias("pairs")).collect()
    least, total = 64, 0
    for row in sorted(powers, reverse=True):
        total += row.pairs
        if total > frequent_pairs:
            break
        least = row.power
    common = pairs.filter(F.floor(F.log2("n")) >= least).toArrow().sort_by("pair")
    known, number = common["pair"].to_numpy().astype(np.uint32), common["n"].to_numpy()
    shared = rows.sparkSession.sparkContext.broadcast((known, number, best))
    kept = "row long, doc_id {id}, n_a long, n_b long, n_groups long, groups_sha256 string".format(
        id=rows.schema["doc_id"].dataType.simpleString()
    )
    copied = ["row", "doc_id", "n_a", "n_b", "n_groups", "groups_sha256"]

    def look_up(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known, number, best = shared.value
        for batch in batches:
            made = []
            for own in batch.column("links"):
                links = np.frombuffer(own.as_buffer(), "<u4")
                if not len(links) or not len(known):
                    made.append((len(links), 0, 0, links.tobytes()))
                    continue
                at = np.minimum(np.searchsorted(known, links), len(known) - 1)
                found = known[at] == links
                n = number[at[found]]
                top = best[links[found] & np.uint32(B_IDS - 1)]
                made.append((len(links), int((n == top).sum()), int(n.sum()), links[~found].tobytes()))
            types = [pa.int64()] * 3 + [pa.binary()]
            extra = [pa.array(c, t) for c, t in zip(zip(*made), types)] if made else [pa.array([], t) for t in types]
            yield pa.RecordBatch.from_arrays(
                [*[batch.column(c) for c in copied], *extra],
                names=[*copied, "n_links", "n_best", "count_sum", "rare"],
            )

    looked_up = arrow_map(rows, look_up, f"{kept}, n_links long, n_best long, count_sum long, rare binary")
    if total <= frequent_pairs:
        return looked_up.drop("rare")
    looked_up = saved(looked_up, "align-looked-up")

    def rare_links(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        best = shared.value[2]
        for batch in batches:
            for row, own in zip(batch.column("row").to_pylist(), batch.column("rare")):
                links, n = np.unique(np.frombuffer(own.as_buffer(), "<u4"), return_counts=True)
                columns = [np.full(len(links), row), links.astype(np.int64), n.astype(np.int64), best[links % B_IDS]]
                yield pa.RecordBatch.from_arrays([pa.array(c) for c in columns], names=["row", "pair", "times", "top"])

    rare = arrow_map(
        looked_up.filter("octet_length(rare) > 0").select("row", "rare"),
        rare_links,
        "row long, pair long, times long, top long",
    )
    rare = rare.join(pairs, "pair").groupBy("row").agg(
        F.sum(F.when(F.col("n") == F.col("top"), F.col("times")).otherwise(0)).alias("more_best"),
        F.sum(F.col("n") * F.col("times")).alias("more_sum"),
    )
    every = looked_up.drop("rare").join(rare, "row", "left")
    for column, more in (("n_best", "more_best"), ("count_sum", "more_sum")):
        every = every.withColumn(column, F.col(column) + F.coalesce(more, F.lit(0)))
    return every.drop("more_best", "more_sum")
