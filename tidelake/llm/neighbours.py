"""Approximate nearest neighbours by cosine: multiprobe hashing with p-stable (Gaussian) projections.

On unit vectors a hash is the cell ``floor((a . v + b) / WIDTH)``; a table joins several. A query visits
the cells around its own in the order of the chance that a neighbour fell there, until the chances
add up to the wanted recall; candidates of all tables are ranked by the exact cosine.

Equal vectors are one class with its few smallest ids, since no query needs more of them.
"""

from __future__ import annotations

import math
from statistics import NormalDist

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tidelake.llm.common import arrow_map, mixed, saved

TABLES = 2
WIDTH = 1.2
PER_CELL = 500
REACH = 2
SEED = 20_240_101
SAMPLE_ROWS = 10_000
SAMPLE_QUERIES = 100
PART_ROWS = 8_000
SALTED_CELL = 4_000


def projections(dim: int, hashes: int) -> tuple[np.ndarray, np.ndarray]:
    """Directions and offsets of all tables' hashes; the same for equal arguments."""
    rng = np.random.default_rng((SEED, dim, hashes))
    return rng.standard_normal((dim, TABLES * hashes)), rng.uniform(0, WIDTH, TABLES * hashes)


def matrix(column: pa.Array) -> np.ndarray:
    """List column as rows of doubles; all lists have one length."""
    column = column.combine_chunks() if isinstance(column, pa.ChunkedArray) else column
    flat = column.flatten().cast(pa.float64()).to_numpy(zero_copy_only=False)
    return flat.reshape(len(column), -1) if len(column) else np.empty((0, 0))


def _unit(rows: np.ndarray) -> np.ndarray:
    scaled = rows / np.abs(rows).max(axis=1, keepdims=True)
    return scaled / np.sqrt((scaled * scaled).sum(axis=1, keepdims=True))


def _keys(cells: np.ndarray, table: int) -> np.ndarray:
    """One signed 64-bit name for each row of cell numbers."""
    name = np.full(len(cells), table + 1, np.uint64)
    for part in cells.T:
        name = mixed(name * np.uint64(0x9E3779B97F4A7C15) + part.astype(np.int64).view(np.uint64))
    return name.view(np.int64)


def cells_in_order(place: np.ndarray, offset: np.ndarray, alike: float, wanted: float) -> np.ndarray:
    """Cells around a query's projections, likeliest first, until a neighbour's chances reach ``wanted``.

    A neighbour at cosine ``alike`` projects to a normal around ``alike`` times the query's place.
    """
    own = np.floor((place + offset) / WIDTH).astype(np.int64)
    spread = NormalDist(0, math.sqrt(max(1e-4, 1 - alike * alike)))
    steps = range(-REACH, REACH + 1)
    chances = np.array(
        [
            [
                max(
                    1e-12,
                    spread.cdf((cell + s + 1) * WIDTH - b - alike * x) - spread.cdf((cell + s) * WIDTH - b - alike * x),
                )
                for s in steps
            ]
            for cell, x, b in zip(own.tolist(), place.tolist(), offset.tolist())
        ]
    )
    costs = -np.log(chances)
    beam = 64
    while True:
        cost, cells, cut = np.zeros(1), np.zeros((1, 0), np.int64), False
        for k in range(len(own)):
            cost = (cost[:, None] + costs[k][None, :]).ravel()
            moved = np.tile(np.arange(-REACH, REACH + 1), len(cells))[:, None]
            cells = np.hstack([np.repeat(cells, 2 * REACH + 1, axis=0), moved])
            best = np.argsort(cost, kind="stable")[:beam]
            cut |= len(cost) > beam
            cost, cells = cost[best], cells[best]
        reached = np.cumsum(np.exp(-cost))
        enough = int(np.searchsorted(reached, wanted)) + 1
        if enough <= len(cost) or not cut:
            return own + cells[:enough]
        beam *= 4


def _index(hashes: int):
    def run(batches):
        for batch in batches:
            rows = matrix(batch.column("embedding"))
            if not len(rows):
                continue
            a, b = projections(rows.shape[1], hashes)
            cells = np.floor((_unit(rows) @ a + b) / WIDTH)
            keys = [_keys(cells[:, t * hashes : (t + 1) * hashes], t) for t in range(TABLES)]
            for key in keys:
                yield pa.RecordBatch.from_arrays(
                    [pa.array(key), *(batch.column(c) for c in ("cid", "ids", "embedding"))],
                    ["key", "cid", "ids", "embedding"],
                )

    return run


def _probe(hashes: int, alike: float, wanted: float):
    def run(batches):
        for batch in batches:
            rows = matrix(batch.column("embedding"))
            if not len(rows):
                continue
            a, b = projections(rows.shape[1], hashes)
            places = _unit(rows) @ a
            keys = []
            for place in places:
                own = []
                for t in range(TABLES):
                    part = slice(t * hashes, (t + 1) * hashes)
                    own.append(_keys(cells_in_order(place[part], b[part], alike, wanted), t))
                keys.append(np.concatenate(own))
            yield pa.RecordBatch.from_arrays(
                [batch.column("cid"), pa.array(keys, pa.list_(pa.int64()))], ["cid", "keys"]
            )

    return run


FOUND = "cid long, vec_id long, score double"


def cosines(rows: np.ndarray, query: np.ndarray) -> np.ndarray:
    """Exact cosine of each row with the query, in doubles, row by row alike."""
    rows = rows / np.abs(rows).max(axis=1, keepdims=True)
    query = query / np.abs(query).max()
    return (rows * query).sum(axis=1) / (np.sqrt((rows * rows).sum(axis=1)) * math.sqrt((query * query).sum()))


def _search(most: int):
    """Best candidates of one part for each query that probes it."""

    def run(index: pa.Table, probes: pa.Table) -> pa.Table:
        out: list[tuple] = []
        if index.num_rows and probes.num_rows:
            rows = matrix(index.column("embedding"))
            unit = _unit(rows)
            cell = index.column("cell").to_numpy()
            order = np.argsort(cell, kind="stable")
            sorted_cells = cell[order]
            cid, ids = index.column("cid").to_numpy(), index.column("ids").to_pylist()
            asked = matrix(probes.column("embedding"))
            for number, (query, cells) in enumerate(zip(probes.column("cid").to_pylist(), probes.column("cells").to_pylist())):
                wanted = np.unique(np.array(cells, np.int64))
                lo, hi = np.searchsorted(sorted_cells, wanted), np.searchsorted(sorted_cells, wanted, side="right")
                size = hi - lo
                at = np.arange(size.sum()) + np.repeat(lo - (np.cumsum(size) - size), size)
                if not len(at):
                    continue
                at = order[at]
                _, first = np.unique(cid[at], return_index=True)  # a class may be met in several tables
                at = at[first]
                near = unit[at] @ _unit(asked[number : number + 1])[0]
                if len(at) > most:
                    # Exact scores decide among all that rounding could put first.
                    least = np.partition(near, len(near) - most)[len(near) - most]
                    at = at[near >= least - 1e-9]
                score = cosines(rows[at], asked[number])
                named = [(-s, i) for s, a in zip(score.tolist(), at.tolist()) for i in ids[a]]
                out += [(query, i, -s) for s, i in sorted(named)[:most]]
        columns = list(zip(*out)) if out else [()] * 3
        return pa.table(
            [pa.array(c, k) for c, k in zip(columns, (pa.int64(), pa.int64(), pa.float64()))], ["cid", "vec_id", "score"]
        )

    return run


def usable(embedding: Column) -> Column:
    """Not NULL, not zero, and no component NULL or not finite."""
    value = embedding.cast("array<double>")
    finite = F.forall(value, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")))
    return embedding.isNotNull() & F.coalesce(finite & F.exists(value, lambda x: x != 0), F.lit(False))


def _likeness(classes: DataFrame, k: int) -> float:
    """Cosine that nine of ten sampled vectors reach with their ``k``-th nearest sampled one.

    Fitted on at most ``SAMPLE_ROWS`` classes, picked by a hash. In all rows neighbours are nearer,
    so the chances worked out with it are too low rather than too high.
    """
    rows = classes.orderBy(F.xxhash64("cid"), "cid").limit(SAMPLE_ROWS).select("embedding").toArrow()
    unit = _unit(matrix(rows.column("embedding")))
    near = unit[:SAMPLE_QUERIES] @ unit.T
    near[np.arange(len(near)), np.arange(len(near))] = -1
    kth = -np.partition(-near, min(k, near.shape[1]) - 1, axis=1)[:, min(k, near.shape[1]) - 1]
    return float(np.clip(np.quantile(kth, 0.1), 0.0, 0.999))


def nearest(vectors: DataFrame, is_query: Column, k: int = 5, recall: float = 0.96) -> DataFrame:
    """(query_id, rank, vec_id, score): each query's ``k`` nearest other rows found, by exact cosine.

    ``vectors`` has vec_id and embedding; queries are the rows where ``is_query`` holds, candidates
    all rows but the query's own. Nearest first, equal scores by smaller vec_id. NULL, zero and
    non-finite vectors, vectors of another length than the commonest, and rows without vec_id take
    no part. Rows that repeat a vec_id with the same vector count once. ``recall`` is the estimated
    chance that one of the nearest is met. Other columns are ignored; no usable rows, no result.
    """
    spark = vectors.sparkSession
    rows = vectors.withColumn("_query", is_query).select("vec_id", "embedding", "_query")
    rows = rows.filter(usable(F.col("embedding")) & F.col("vec_id").isNotNull())
    rows = rows.select(F.col("vec_id").cast("long"), F.col("embedding").cast("array<double>"), F.coalesce("_query", F.lit(False)).alias("q"))
    by_size = rows.groupBy(F.size("embedding").alias("dim")).count().orderBy(F.desc("count"), "dim").first()
    empty = "query_id long, rank int, vec_id long, score double"
    if by_size is None:
        return spark.createDataFrame([], empty)
    rows = rows.filter(F.size("embedding") == by_size.dim)
    place = F.row_number().over(Window.partitionBy("embedding").orderBy("vec_id"))
    few = rows.dropDuplicates(["vec_id", "embedding"]).withColumn("place", place).filter(F.col("place") <= k + 1)
    classes = few.groupBy("embedding").agg(F.min("vec_id").alias("cid"), F.array_sort(F.collect_list("vec_id")).alias("ids"))
    classes = saved(classes, "neighbours-classes")
    total = classes.count()
    asked = rows.filter("q").select(F.col("vec_id").alias("query_id"), "embedding")
    asked = asked.join(classes.select("embedding", "cid"), "embedding").select("query_id", "cid").distinct()
    asked = saved(asked, "neighbours-queries")
    query_classes = classes.join(asked.select("cid").distinct(), "cid").select("cid", "embedding")

    alike = _likeness(classes, k)
    hashes = max(2, round(math.log(max(1, total / PER_CELL), 3)))
    wanted = 1 - (1 - recall) ** (1 / TABLES)
    index = arrow_map(classes, _index(hashes), "key long, cid long, ids array<long>, embedding array<double>")
    probes = arrow_map(query_classes, _probe(hashes, alike, wanted), "cid long, keys array<long>")
    probes = probes.select("cid", F.explode("keys").alias("key"))
    # A crowded cell is dealt over as many parts as its rows need.
    crowded = index.groupBy("key").count().filter(F.col("count") > SALTED_CELL)
    crowded = saved(crowded.select("key", F.ceil(F.col("count") / SALTED_CELL).cast("int").alias("ways")), "neighbours-crowded")
    parts = max(1, total * TABLES // PART_ROWS)
    ways = F.coalesce("ways", F.lit(1))
    index = index.join(crowded, "key", "left").withColumn("salt", F.pmod(F.xxhash64("cid"), ways).cast("int"))
    probes = probes.join(crowded, "key", "left").withColumn("salt", F.explode(F.sequence(F.lit(0), ways - 1)))
    cell = F.xxhash64("key", "salt")
    index = index.select(cell.alias("cell"), "cid", "ids", "embedding").withColumn("part", F.pmod("cell", F.lit(parts)))
    probes = probes.select("cid", cell.alias("cell")).groupBy("cid", F.pmod("cell", F.lit(parts)).alias("part"))
    probes = probes.agg(F.collect_list("cell").alias("cells")).join(query_classes, "cid")
    met = index.groupBy("part").cogroup(probes.groupBy("part")).applyInArrow(_search(k + 1), FOUND)
    best = Window.partitionBy("cid").orderBy(F.desc("score"), "vec_id")
    met = met.distinct().withColumn("place", F.row_number().over(best)).filter(F.col("place") <= k + 1)
    answers = asked.join(met.drop("place"), "cid").filter("vec_id != query_id")
    ranked = Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id")
    answers = answers.withColumn("rank", F.row_number().over(ranked)).filter(F.col("rank") <= k)
    return answers.select("query_id", "rank", "vec_id", "score")
