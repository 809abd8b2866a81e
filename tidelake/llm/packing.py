"""Packing of documents into training sequences, in order, by dynamic programming over cut points.

Tokens of a task's documents form one stream. A sequence ends at a document end, a sentence end or,
inside very long sentences, anywhere; the cheapest way to cut the stream minimises padding plus a
penalty for each document that is cut, and a small charge for each sequence. The best predecessor of a
cut point lies in a sliding window, kept in a monotone queue; sequences of a power of two need no
padding and are tried beside it.
"""

from __future__ import annotations

import os
import re
import sys
from collections import deque
from collections.abc import Iterator
from itertools import chain
from types import ModuleType

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame

from tidelake.llm.common import arrow_map

WINDOW = 4096
SENTENCE_CUT = 6.0
HARD_CUT = 48.0
SEQUENCE = 24.0
HARD_EVERY = 256
BUFFER = 1_500_000
MEMO = 600_000


# The mark comes first, so that the search goes from mark to mark and not from byte to byte.
_FINAL_MARK = re.compile(rb"[.,](?<=[a-z].)(?=\s|$)")


class WordTokens:
    """Token ids of texts by a tokenizer that lowers case, never joins what white space parts and
    marks where a word ends.

    Every distinct word is encoded once while the memo has room; a text is the sequence of its words.
    """

    def __init__(self, path: str) -> None:
        from tokenizers import Tokenizer

        os.environ["TOKENIZERS_PARALLELISM"] = "false"  # Spark's tasks are the parallelism
        self.tokenizer = Tokenizer.from_file(path)
        vocabulary = self.tokenizer.get_vocab(with_added_tokens=True)
        self.last = np.zeros(max(vocabulary.values()) + 1, bool)
        self.last[[i for piece, i in vocabulary.items() if piece.endswith("</w>")]] = True
        self.special = [p.content.encode() for p in self.tokenizer.get_added_tokens_decoder().values()]
        self.forget()

    def forget(self) -> None:
        self.known: dict[bytes, int] = {}
        self.ids: list[np.ndarray] = [np.empty(0, np.uint32)]
        self.size: list[np.ndarray] = [np.empty(0, np.int64)]
        self.stop: list[np.ndarray] = [np.empty(0, bool)]

    def encoded(self, words: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """Ids of some words, and how many each has.

        A word of letters alone is one unit of the tokenizer and has one last piece, so many such
        words are encoded as one text and told apart by their last pieces.
        """
        if all(map(str.isalpha, words)):
            (found,) = self.tokenizer.encode_batch_fast([" ".join(words)], add_special_tokens=False)
            ids = np.array(found.ids, np.uint32)
            ends = np.flatnonzero(self.last[ids]) + 1
            if len(ends) == len(words):
                return ids, np.diff(np.r_[0, ends])
        found = [e.ids for e in self.tokenizer.encode_batch_fast(words, add_special_tokens=False)]
        sizes = np.fromiter(map(len, found), np.int64, len(found))
        return np.fromiter(chain.from_iterable(found), np.uint32, int(sizes.sum())), sizes

    def learn(self, words: set[bytes]) -> None:
        new = words.difference(self.known)
        if len(self.known) + len(new) > MEMO and self.known:
            self.forget()
            new = words
        new = [(w, w.decode()) for w in new]
        plain = [pair for pair in new if pair[1].isalpha()]
        others = [pair for pair in new if not pair[1].isalpha()]
        for group in (plain, others):
            for at in range(0, len(group), 2000):
                part = group[at : at + 2000]
                ids, sizes = self.encoded([text for _, text in part])
                self.known.update(zip([w for w, _ in part], range(len(self.known), len(self.known) + len(part))))
                self.ids.append(ids)
                self.size.append(sizes)
                self.stop.append(np.array([w[-1:] in b".!?" for w, _ in part]))
        self.ids, self.size, self.stop = ([np.concatenate(c)] for c in (self.ids, self.size, self.stop))

    def words(self, text: bytes) -> list[bytes]:
        # Lowering the case first makes fewer words, but could write a special token.
        low = text.lower()
        low = text if any(s in low for s in self.special) else low
        # A mark behind a letter is a unit of its own, with a space before it or not.
        return _FINAL_MARK.sub(rb" \g<0>", low).split()

    def __call__(self, texts: list[bytes]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """All ids, the number of ids of each text, and the places after which a sentence ends."""
        words = list(map(self.words, texts))
        flat = list(chain.from_iterable(words))
        self.learn(set(flat))
        at = np.fromiter(map(self.known.__getitem__, flat), np.int64, len(flat))
        size = self.size[0][at]
        start = (np.cumsum(self.size[0]) - self.size[0])[at]
        before = np.cumsum(size) - size
        ids = self.ids[0][np.arange(int(size.sum())) + np.repeat(start - before, size)]
        edges = np.r_[0, np.cumsum(list(map(len, words)))].astype(np.int64)
        sums = np.r_[0, np.cumsum(size)]
        return ids, sums[edges[1:]] - sums[edges[:-1]], (before + size)[self.stop[0][at]]


def word_tokens(path: str) -> WordTokens:
    """The worker's own: what one task has learned of the words serves the next."""
    kept = sys.modules.setdefault("_tidelake_word_tokens", ModuleType("_tidelake_word_tokens")).__dict__
    if path not in kept:
        kept[path] = WordTokens(path)
    return kept[path]


def best_cuts(places: np.ndarray, penalties: np.ndarray, window: int = WINDOW) -> list[int]:
    """Ends of the cheapest sequences over ``places`` (ascending, gaps at most ``window``), the last included.

    A sequence costs its padding to ``window``, none at a power of two, plus ``SEQUENCE`` and its end's penalty.
    """
    count = len(places)
    place, penalty = [0, *places.tolist()], [0.0, *penalties.tolist()]
    shorter: dict[int, list[int]] = {}  # from where a sequence of a power of two ends here
    known = np.array(place)
    for power in (1 << k for k in range(8, window.bit_length() - 1)):
        at = np.searchsorted(known, known - power)
        for j in np.flatnonzero(known[at] == known - power).tolist():
            shorter.setdefault(j, []).append(int(at[j]))
    cost, back = [0.0] * (count + 1), [0] * (count + 1)
    queue = deque([(0.0, 0)])
    for j in range(1, count + 1):
        here = place[j]
        while place[queue[0][1]] < here - window:
            queue.popleft()
        best, source = queue[0]
        best += window - here
        for i in shorter.get(j, ()):
            if cost[i] < best:
                best, source = cost[i], i
        cost[j] = own = best + SEQUENCE + penalty[j]
        back[j] = source
        key = own + here
        while queue and queue[-1][0] >= key:
            queue.pop()
        queue.append((key, j))
    out, j = [], count
    while j:
        out.append(place[j])
        j = back[j]
    return out[::-1]


def cut_points(total: int, doc_ends: np.ndarray, sentence_ends: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Places where a sequence may end and what ending there costs; the end of the stream is one."""
    # What ends where: a document over a sentence over nothing but the stream.
    kind = np.zeros(total + 1, np.uint8)
    kind[total] = 1
    kind[sentence_ends[(sentence_ends > 0) & (sentence_ends <= total)]] = 2
    kind[doc_ends[(doc_ends > 0) & (doc_ends <= total)]] = 3
    places = np.flatnonzero(kind)
    gaps = np.diff(np.r_[0, places])
    for p, g in zip(places[gaps > HARD_EVERY].tolist(), gaps[gaps > HARD_EVERY].tolist()):
        kind[p - g + HARD_EVERY : p : HARD_EVERY] = 1
    kind[0] = 0
    places = np.flatnonzero(kind)
    return places, np.array([0.0, HARD_CUT, SENTENCE_CUT, 0.0])[kind[places]]


class Stream:
    """Tokens not yet in a sequence, with the documents they belong to."""

    def __init__(self, end_id: int, window: int) -> None:
        self.end_id, self.window = end_id, window
        self.ids, self.held = [], 0
        self.docs, self.starts, self.sizes, self.sentences = [], [], [], []

    def add(self, doc_ids: list, ids: np.ndarray, sizes: np.ndarray, ends: np.ndarray) -> None:
        """Documents' tokens, each followed by the end id."""
        count = len(sizes)
        doc_of = np.repeat(np.arange(count), sizes)
        full = np.full(len(ids) + count, self.end_id, np.uint32)
        full[np.arange(len(ids)) + doc_of] = ids
        inner = ends[ends < len(ids)]
        starts = np.cumsum(sizes + 1) - (sizes + 1)
        self.sentences.append(inner + doc_of[inner - 1] + self.held)
        self.ids.append(full)
        self.docs += doc_ids
        self.starts += (starts + self.held).tolist()
        self.sizes += (sizes + 1).tolist()
        self.held += len(full)

    def cut(self, last: bool) -> tuple[np.ndarray, np.ndarray, list[tuple]] | None:
        """Sequences of what is held; without ``last``, the tokens of the final one are kept back."""
        ids, starts, sizes = np.concatenate(self.ids), np.array(self.starts), np.array(self.sizes)
        sentences = np.concatenate(self.sentences)
        sentences = sentences[sentences > 0]
        ends = best_cuts(*cut_points(len(ids), (starts + sizes), sentences), self.window)
        if not last:
            ends = ends[:-1]
        elif len(ends):
            left = ends[-1] - (ends[-2] if len(ends) > 1 else 0)
            if self.window - left > self.window // 8 and left & (left - 1):
                # The very last tokens fill sequences of powers of two instead of a padded one.
                at = ends.pop() - left
                for power in sorted((1 << k for k in range(left.bit_length()) if left >> k & 1), reverse=True):
                    at += power
                    ends.append(at)
        done = ends[-1] if ends else 0
        cuts = np.array(ends, np.int64)
        edges = np.unique(np.r_[0, cuts, starts[(starts > 0) & (starts < done)]])
        edges = edges[edges < done]
        finish = np.r_[edges[1:], done]
        doc = np.searchsorted(starts, edges, side="right") - 1
        sequence = np.searchsorted(cuts, edges, side="right")
        begin = np.r_[0, cuts][sequence]
        pieces = list(
            zip(
                [self.docs[d] for d in doc.tolist()],
                (edges - starts[doc]).tolist(),
                (finish - edges).tolist(),
                sizes[doc].tolist(),
                sequence.tolist(),
                (edges - begin).tolist(),
                [ids[a:b].tobytes() for a, b in zip(edges.tolist(), finish.tolist())],
            )
        )
        keep = starts + sizes > done
        self.ids, self.held = [ids[done:]], len(ids) - done
        self.docs = [d for d, k in zip(self.docs, keep.tolist()) if k]
        self.starts, self.sizes = (starts[keep] - done).tolist(), sizes[keep].tolist()
        self.sentences = [sentences[sentences > done] - done]
        return len(cuts), pieces


PIECE = "doc_id long, start long, length long, doc_tokens long, sequence_id long, offset long, ids binary"
_KINDS = [*[pa.int64()] * 6, pa.binary()]


def _pack(path: str, end_id: int, window: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tokens, stream = word_tokens(path), Stream(end_id, window)
        base = TaskContext.get().partitionId() << 36

        def flush(last: bool):
            nonlocal base
            count, pieces = stream.cut(last)
            for at in range(0, len(pieces), 4096):
                columns = list(zip(*pieces[at : at + 4096]))
                columns[4] = [base + s for s in columns[4]]
                names = [c.split()[0] for c in PIECE.split(", ")]
                yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(columns, _KINDS)], names)
            base += count

        for batch in batches:
            texts = [t or b"" for t in batch.column("text").cast(pa.binary()).to_pylist()]
            stream.add(batch.column("doc_id").to_pylist(), *tokens(texts))
            if stream.held >= BUFFER:
                yield from flush(False)
        if stream.held:
            yield from flush(True)

    return run


def packed(docs: DataFrame, tokenizer_path: str, end_id: int = 2, window: int = WINDOW) -> DataFrame:
    """Pieces of the documents of ``docs`` (doc_id, text) in sequences of at most ``window`` tokens.

    Columns: doc_id, start (ids of the document before the piece), length, doc_tokens (with the end
    id), sequence_id, offset in the sequence, ids (little-endian 32-bit). Each document is its token
    ids, then ``end_id``; NULL and empty texts are the end id alone. Each task packs its rows in their
    order, so equal input files give equal sequences; rows that repeat a doc_id are documents of
    their own. Other columns are ignored; an empty table gives no pieces.
    """
    rows = docs.select(docs["doc_id"].cast("long").alias("doc_id"), docs["text"].cast("string").alias("text"))
    return arrow_map(rows, _pack(tokenizer_path, end_id, window), PIECE)
