"""Importance resampling towards a target: hashed n-gram counts of two corpora, a weight a document, a Gumbel draw.

A text's separators are collapsed to single spaces; for each n, one regular expression scans it with
overlapping matches, its lookarounds keep spans on word boundaries, and the bytes of every span are
counted by their CRC. The counts of both corpora give each bucket a gain, a document's weight is the
floored mean gain of its n-grams, and the highest weights plus Gumbel noise are drawn.

NULL and empty texts, and texts without words, have no n-grams and weight 0; the noise of a NULL
doc_id is that of an empty one. Rows are judged one by one, so repeated rows count in the corpus as
often as they occur and each has its own rank. Equal scores are ranked by doc_id (NULL last); between
rows that agree in both, and in their counts, any order is the same. Empty tables give empty results;
without a target all buckets of it are empty. Further columns of any name do not matter.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator
from operator import itemgetter

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tidelake.llm.common import arrow_map, saved

WORDS = 2
BUCKETS = 10_000
LEAST_WORDS = 20
SHARE_PERCENT = 25
SEED = 7
#: Copies of one row that one row of ranks stands for.
COPIES_A_ROW = 10_000
#: Scores are whole thousandths of a logarithm; so many of them make a block whose total the driver sees.
BLOCK = 1_000

SEPARATORS = rb"[\x00-\x2F\x3A-\x60\x7B-\x7F]+"


class GramScanner:
    """Buckets of all runs of 1 to ``words`` consecutive words of a text."""

    def __init__(self, words: int = WORDS, buckets: int = BUCKETS) -> None:
        self.buckets = buckets
        self.separators = regex.compile(SEPARATORS)
        # No word begins before the span and none goes on behind it.
        self.runs = [
            regex.compile(rb"(?<![^ ])[^ ]++(?: [^ ]++){%d}(?![^ ])" % more) for more in range(words)
        ]

    def collapsed(self, text: bytes) -> bytes:
        return self.separators.sub(b" ", text.lower()).strip(b" ")

    def __call__(self, text: bytes) -> tuple[int, np.ndarray]:
        """The number of words, and the bucket of every n-gram."""
        line = self.collapsed(text)
        found = [
            np.fromiter(map(zlib.crc32, map(itemgetter(0), run.finditer(line, overlapped=True))), np.uint32)
            for run in self.runs
        ]
        return len(found[0]), np.concatenate(found) % np.uint32(self.buckets)


def hashed(docs: DataFrame, words: int = WORDS, buckets: int = BUCKETS, carry: tuple[str, ...] = ()) -> DataFrame:
    """(carried struct, n_words, grams): every text's n-gram buckets as little-endian 32-bit numbers."""
    columns = [F.col(f"`{c}`").alias(f"c{i}") for i, c in enumerate(carry)]
    narrow = docs.select(F.struct(F.lit(0).alias("_"), *columns).alias("carried"), F.col("text"))
    kept = narrow.schema["carried"].dataType.simpleString()

    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        scanner = GramScanner(words, buckets)
        for batch in batches:
            made = [scanner(text or b"") for text in batch.column("text").cast(pa.binary()).to_pylist()]
            counts = pa.array([n for n, _ in made], pa.int64())
            grams = pa.array([g.astype("<u4").tobytes() for _, g in made], pa.binary())
            yield pa.RecordBatch.from_arrays(
                [batch.column("carried"), counts, grams], names=["carried", "n_words", "grams"]
            )

    return arrow_map(narrow, scan, f"carried {kept}, n_words long, grams binary")


def bucket_counts(grams: DataFrame, buckets: int = BUCKETS) -> np.ndarray:
    """How many n-grams of all rows fall into each bucket; each task sends one number a bucket."""

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(buckets, np.int64)
        for batch in batches:
            for own in batch.column("grams"):
                total += np.bincount(np.frombuffer(own.as_buffer(), "<u4"), minlength=buckets)
        at = np.flatnonzero(total)
        yield pa.RecordBatch.from_arrays([pa.array(at), pa.array(total[at])], names=["bucket", "n"])

    rows = arrow_map(grams.select("grams"), count, "bucket long, n long").groupBy("bucket").agg(F.sum("n").alias("n"))
    out = np.zeros(buckets, np.int64)
    for row in rows.collect():  # at most one row a bucket
        out[row.bucket] = row.n
    return out


def gains(source: np.ndarray, target: np.ndarray) -> np.ndarray:
    """Thousandths of the logarithm of how much likelier each bucket is in the target, both smoothed by one."""
    buckets = len(source)
    s, t = source.astype(float), target.astype(float)
    odds = (t + 1) * (s.sum() + buckets) / ((s + 1) * (t.sum() + buckets))
    return np.floor(1000 * np.log(odds)).astype(np.int64)


def noise(doc_id: Column, seed: int = SEED) -> Column:
    """Gumbel noise in floored thousandths, a function of seed and doc_id alone."""
    key = F.concat(F.lit(f"{seed}:"), F.coalesce(doc_id.cast("string"), F.lit("")))
    h = F.conv(F.substring(F.sha2(key, 256), 1, 8), 16, 10).cast("long")
    return F.floor(-1000 * F.log(-F.log((h + F.lit(0.5)) / F.lit(4294967296.0))))


def scored(
    docs: DataFrame,
    target: DataFrame,
    words: int = WORDS,
    buckets: int = BUCKETS,
    seed: int = SEED,
    carry: tuple[str, ...] = (),
) -> DataFrame:
    """(carried, doc_id, n_words, n_features, weight, score) for each row of ``docs``; texts are scanned once."""
    grams = saved(hashed(docs, words, buckets, ("doc_id", *carry)), "importance-grams")
    gain = gains(bucket_counts(grams, buckets), bucket_counts(hashed(target, words, buckets), buckets))
    kept = grams.schema["carried"].dataType.simpleString()

    def weigh(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            sizes, weights = [], []
            for own in batch.column("grams"):
                at = np.frombuffer(own.as_buffer(), "<u4")
                sizes.append(len(at))
                weights.append(int(gain[at].sum()) // len(at) if len(at) else 0)
            out = [batch.column("carried"), batch.column("n_words"), pa.array(sizes, pa.int64())]
            yield pa.RecordBatch.from_arrays(
                [*out, pa.array(weights, pa.int64())], names=["carried", "n_words", "n_features", "weight"]
            )

    weighed = arrow_map(grams, weigh, f"carried {kept}, n_words long, n_features long, weight long")
    return weighed.select(
        "carried",
        F.col("carried.c0").alias("doc_id"),
        "n_words",
        "n_features",
        "weight",
        (F.col("weight") + noise(F.col("carried.c0"), seed)).alias("score"),
    )


def ranked(rows: DataFrame, percent: int = SHARE_PERCENT, least_words: int = LEAST_WORDS) -> DataFrame:
    """(doc_id, n_features, weight, score, rank): 1, 2, 3… by falling score for the drawn rows, else NULL.

    Rows alike are counted first. A rank is the number of rows in higher blocks of scores, in higher
    scores of the block, and before in the same score: no task sorts more than the rows of one score,
    which the noise holds below a 2,500th of them, or the distinct scores of one block.
    """
    enough = (F.col("n_words") >= least_words).alias("enough")
    same = rows.groupBy("doc_id", "n_features", "weight", "score", enough).agg(F.count("*").alias("copies"))
    same = saved(same, "importance-rows")
    able = same.filter("enough")
    block = F.floor(F.col("score") / BLOCK).alias("block")
    scores = able.groupBy("score").agg(F.sum("copies").alias("n")).select("score", "n", block)
    scores = saved(scores, "importance-scores")
    # Scores span less than 200,000 thousandths, whatever the corpus: gains and noise are logarithms.
    blocks = sorted(scores.groupBy("block").agg(F.sum("n").alias("n")).collect(), reverse=True)
    before, total = [], 0
    for row in blocks:
        before.append((row.block, total))
        total += row.n
    drawn = percent * total // 100
    spark = rows.sparkSession
    before = spark.createDataFrame(before, "block long, higher_blocks long")
    up_to = Window.partitionBy("block").orderBy(F.desc("score"))
    higher = scores.join(F.broadcast(before), "block").select(
        "score", (F.col("higher_blocks") + F.sum("n").over(up_to) - F.col("n")).alias("higher")
    )
    within = Window.partitionBy("score").orderBy(F.col("doc_id").asc_nulls_last(), "n_features", "weight")
    placed = able.join(F.broadcast(higher), "score").withColumn(
        "first", F.col("higher") + F.sum("copies").over(within) - F.col("copies") + 1
    )
    placed = placed.select("doc_id", "n_features", "weight", "score", "copies", "first")
    rest = same.filter("not enough").select(
        "doc_id", "n_features", "weight", "score", "copies", F.lit(None).cast("long").alias("first")
    )
    every = placed.unionByName(rest)
    # Copies come back in two steps, so that no task makes all copies of a row.
    parts = F.explode(F.sequence(F.lit(0).cast("long"), F.col("copies") - 1, F.lit(COPIES_A_ROW).cast("long")))
    every = every.select("*", parts.alias("skip")).repartition("score", "doc_id", "skip")
    most = F.least(F.col("copies"), F.col("skip") + COPIES_A_ROW) - 1
    every = every.select("*", F.explode(F.sequence("skip", most)).alias("copy"))
    rank = F.col("first") + F.col("copy")
    return every.select("doc_id", "n_features", "weight", "score", F.when(rank <= drawn, rank).alias("rank"))


def resampled(
    docs: DataFrame,
    target: DataFrame,
    percent: int = SHARE_PERCENT,
    least_words: int = LEAST_WORDS,
    words: int = WORDS,
    buckets: int = BUCKETS,
    seed: int = SEED,
) -> DataFrame:
    """The drawn rows of ``docs`` with all their columns: of N rows with enough words, percent * N // 100."""
    rows = saved(scored(docs, target, words, buckets, seed, tuple(docs.columns)), "importance-scored")
    drawn = ranked(rows, percent, least_words).filter("rank is not null")
    last = drawn.orderBy(F.desc("rank")).select("score", "doc_id", "rank").limit(1).collect()
    columns = [F.col(f"carried.c{i + 1}").alias(c) for i, c in enumerate(docs.columns)]
    able = rows.filter(F.col("n_words") >= least_words)
    if not last:
        return able.limit(0).select(*columns)
    score, doc_id, count = last[0]
    same_id = F.col("doc_id").eqNullSafe(F.lit(doc_id))
    smaller_id = F.col("doc_id").isNotNull() if doc_id is None else F.coalesce(F.col("doc_id") < doc_id, F.lit(False))
    same_score = F.col("score") == score
    better = able.filter((F.col("score") > score) | (same_score & smaller_id))
    # The last place may be shared by rows of one doc_id and score; as many of them go as places are left.
    tied = able.filter(same_score & same_id).limit(count - better.count())
    return better.unionByName(tied).select(*columns)
