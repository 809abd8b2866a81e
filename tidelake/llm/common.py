"""What the corpus operators share: bounded Arrow batches, written intermediates, word hashes, components."""

from __future__ import annotations

import ctypes
import sys
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark import cloudpickle
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidelake.session import scratch_dir

# The functions of this package travel with the tasks, so that workers need not have it installed.
cloudpickle.register_pickle_by_value(sys.modules["tidelake.llm"])

BATCH_ROWS = 2_000
BATCH_BYTES = 8 << 20
BROADCAST_ROWS = 200_000


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def give_back() -> None:
    """Return memory a worker has freed to the system; allocators keep it for a next time that may not come."""
    pa.default_memory_pool().release_unused()
    trim = getattr(ctypes.CDLL(None), "malloc_trim", None)
    if trim is not None:
        trim(0)


def tokenizer_path(name: str) -> str:
    """Where the public vocabulary file ``name`` is installed, the same on all machines."""
    import public_tokenizers

    return public_tokenizers.path(name)


def arrow_map(
    df: DataFrame,
    function: Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]],
    schema: str,
    rows: int = BATCH_ROWS,
) -> DataFrame:
    """``mapInArrow`` with batches bounded in rows and bytes, so that long texts do not add up in a worker."""
    conf = df.sparkSession.conf
    conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", str(rows))
    conf.set("spark.sql.execution.arrow.maxBytesPerBatch", str(BATCH_BYTES))

    def task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        yield from function(batches)
        give_back()

    return df.mapInArrow(task, schema)


def arrow_groups(
    df: DataFrame, keys: list[str], function: Callable[[pa.Table], pa.Table], schema: str
) -> DataFrame:
    """``applyInArrow`` per group of ``keys``."""

    def group(rows: pa.Table) -> pa.Table:
        out = function(rows)
        give_back()
        return out

    return df.groupBy(*keys).applyInArrow(group, schema)


#: Has Spark delete what a statement shuffled when the statement ends.
CLEANUP = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"


def saved(df: DataFrame, label: str) -> DataFrame:
    """``df`` written to the shared folder and read back: later steps neither repeat it nor depend on its executors."""
    path = scratch_dir(df.sparkSession, label)
    schema, spark = df.schema, df.sparkSession
    before = spark.conf.get(CLEANUP, None)
    spark.conf.set(CLEANUP, "true")
    try:
        df.write.parquet(path)
    finally:
        if before is None:
            spark.conf.unset(CLEANUP)
        else:
            spark.conf.set(CLEANUP, before)
    return spark.read.schema(schema).parquet(path)


def matching(df: DataFrame, chosen: DataFrame, on: list[str], how: str = "inner") -> DataFrame:
    """``df`` joined with a written table of narrow rows; sent to all tasks only while its count is small."""
    few = chosen.count() <= BROADCAST_ROWS
    return df.join(F.broadcast(chosen) if few else chosen, on, how)


def pieces_of(batch: pa.RecordBatch, column: str, most_bytes: int = 4 << 20) -> Iterator[tuple[int, list[bytes]]]:
    """Runs of (first row, UTF-8 texts) of a batch, each of at most ``most_bytes`` unless one text is longer."""
    start, texts, total = 0, [], 0
    for i, text in enumerate(batch.column(column).cast(pa.binary()).to_pylist()):
        text = text or b""
        if texts and total + len(text) > most_bytes:
            yield start, texts
            start, texts, total = i, [], 0
        texts.append(text)
        total += len(text)
    if texts:
        yield start, texts


def mixed(h: np.ndarray) -> np.ndarray:
    """A bijective scrambling of 64-bit values, so that their order is as good as random."""
    h = h ^ (h >> np.uint64(30))
    h = h * np.uint64(0xBF58476D1CE4E5B9)
    h = h ^ (h >> np.uint64(27))
    h = h * np.uint64(0x94D049BB133111EB)
    return h ^ (h >> np.uint64(31))


BASE = 0x9E3779B97F4A7C15
_SPACE = np.zeros(256, bool)
_SPACE[[0x20, *range(0x09, 0x0E)]] = True
_LOWER = np.arange(256)
_LOWER[ord("A") : ord("Z") + 1] += 32
_VALUES = mixed(_LOWER.astype(np.uint64) + np.uint64(1))


def _powers(base: int, count: int) -> np.ndarray:
    out = np.full(count, base, np.uint64)
    out[0] = 1
    return np.cumprod(out, dtype=np.uint64)


class ShingleSets:
    """Sorted distinct 64-bit hashes of the ``width``-word shingles of texts.

    Words are runs without ASCII white space, A-Z lowered. Fewer words than ``width`` make one
    shingle of all of them, no word makes none. All texts of a call are hashed together: a word's
    hash is the difference of two running sums of its bytes, weighted by powers of an odd number.
    """

    def __init__(self, width: int) -> None:
        self.width, self.power, self.inverse = width, _powers(BASE, 2), _powers(pow(BASE, -1, 1 << 64), 2)

    def of_piece(self, texts: list[bytes]) -> list[np.ndarray]:
        flat = np.frombuffer(b" ".join(texts) + b" ", np.uint8)
        if len(flat) > len(self.power):
            self.power = _powers(BASE, 2 * len(flat))
            self.inverse = _powers(pow(BASE, -1, 1 << 64), 2 * len(flat))
        space = _SPACE[flat]
        start = np.flatnonzero(~space & np.r_[True, space[:-1]])
        end = np.flatnonzero(space & np.r_[False, ~space[:-1]])
        sums = np.cumsum(_VALUES[flat] * self.power[: len(flat)], dtype=np.uint64)
        h = mixed((sums[end - 1] - np.where(start > 0, sums[start - 1], np.uint64(0))) * self.inverse[start])
        sizes = np.array([len(t) + 1 for t in texts])
        words = np.diff(np.searchsorted(start, np.r_[0, np.cumsum(sizes)]))
        rolled = np.full(max(0, len(h) - self.width + 1), self.width, np.uint64)
        for k in range(self.width):
            rolled = (rolled ^ h[k : k + len(rolled)]) * np.uint64(BASE)
            rolled ^= rolled >> np.uint64(29)
        rolled = mixed(rolled)
        out, at = [], 0
        for count in words.tolist():
            if count >= self.width:
                own = np.sort(rolled[at : at + count - self.width + 1])
                out.append(own[np.r_[True, own[1:] != own[:-1]]])
            elif count:
                short = np.uint64(count)
                for word in h[at : at + count]:
                    short = mixed(np.array([short ^ word], np.uint64) * np.uint64(BASE))[0]
                out.append(np.array([short], np.uint64))
            else:
                out.append(np.empty(0, np.uint64))
            at += count
        return out

    def __call__(self, batch: pa.RecordBatch, column: str = "text") -> list[np.ndarray]:
        return [own for _, texts in pieces_of(batch, column, 1 << 20) for own in self.of_piece(texts)]


def signed(values: np.ndarray) -> np.ndarray:
    return np.ascontiguousarray(values, np.uint64).view(np.int64)


def connected(edges: DataFrame, label: str, most_rounds: int = 60) -> DataFrame:
    """(node, component) for the nodes of undirected edges (a, b); a component is named by its smallest node.

    Large-star and small-star steps in turn until the edges no longer change; each round is
    written to the shared folder. No step needs a node's neighbours in one task beyond a minimum.
    """

    def lowest(links: DataFrame) -> DataFrame:
        return links.groupBy("u").agg(F.min("v").alias("m")).withColumn("m", F.least("u", "m"))

    current = saved(
        edges.select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v")).filter("u != v").distinct(),
        f"{label}-edges",
    )
    mark = None
    for _ in range(most_rounds):
        both = current.unionByName(current.select(F.col("v").alias("u"), F.col("u").alias("v")))
        large = both.join(lowest(both), "u").filter("v > u").select(F.col("v").alias("u"), F.col("m").alias("v"))
        large = large.filter("u != v").distinct()
        least = lowest(large)
        small = large.join(least, "u").select(F.col("v").alias("u"), F.col("m").alias("v"))
        small = small.unionByName(least.select("u", F.col("m").alias("v")))
        current = saved(small.filter("u != v").distinct(), f"{label}-stars")
        now = tuple(current.agg(F.count("*"), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first())
        if now == mark:
            nodes = current.select(F.col("u").alias("node"), F.col("v").alias("component"))
            roots = current.select(F.col("v").alias("node"), F.col("v").alias("component")).distinct()
            return nodes.unionByName(roots)
        mark = now
    raise RuntimeError("components did not settle")
