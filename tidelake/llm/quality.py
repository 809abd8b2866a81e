"""Quality of documents: a classifier's evidence shrunk towards what host and path are like.

A logistic model on a text's looks gives each document's odds. Hosts and paths (for a corpus without
URLs: any coarse and finer grouping) get a share of good documents by grouped sums over the whole
corpus; a sparse path is drawn to its host, a sparse host to all documents. How strongly is estimated
from how much hosts, and paths within hosts, differ beyond chance (empirical Bayes). How much a path's
share then counts beside a document's own evidence is estimated too, as what makes the labels likeliest:
nothing where sites tell no more than texts do.
"""

from __future__ import annotations

import math
import re
from collections import Counter
from collections.abc import Iterator
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidelake.llm.common import arrow_map, matching, saved

TRAIN_ROWS = 20_000
RIDGE = 1.0
#: Prior precision of the weight of sites, and its bounds.
SITE_RIDGE, MOST_SITE_WEIGHT = 1.0, 2.0
KEEP_FROM = 0.3
MOST_STRENGTH = 1e4

NAMES = (
    "log_words", "word_length", "upper_words", "symbol_words", "shouted_words", "table_marks",
    "repeated_words", "commonest_word", "repeated_lines", "longest_line", "digit_share",
    "other_share", "sentence_ends",
)
_SYMBOLS = re.compile(r"[#$%&*^~=<>|\\{}@_+]")


def looks(text: str) -> list[float]:
    """What a text looks like, each number about 0 to 1 (see ``NAMES``); an empty text is all zeros."""
    words = text.split()
    if not words:
        return [0.0] * len(NAMES)
    count = len(words)
    bare = [w for w in words if w != "|"]
    lines = [line for line in text.split("\n") if line]
    size = len(text)
    commonest = Counter(words).most_common(2)[-1][1] if len(set(words)) > 1 else count
    return [
        min(1.0, math.log1p(count) / 10),
        min(2.0, size / count / 10),
        sum(1 for w in bare if len(w) > 1 and w.isupper()) / count,
        sum(1 for w in bare if _SYMBOLS.search(w[-2:])) / count,
        sum(1 for w in bare if w.endswith("!!")) / count,
        (count - len(bare)) / count,
        1 - len(set(words)) / count,
        commonest / count,
        1 - len(set(lines)) / max(1, len(lines)),
        min(1.0, max(map(len, lines), default=0) / 2000),
        sum(map(text.count, "0123456789")) / size,
        len(_SYMBOLS.findall(text)) / size,
        min(1.0, 5 * sum(map(text.count, ".?!")) / count),
    ]


def with_looks(docs: DataFrame, column: str) -> DataFrame:
    """``docs`` with the numbers of :func:`looks` of ``text`` in a new column."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = [looks(t or "") for t in batch.column("text").to_pylist()]
            yield pa.RecordBatch.from_arrays(
                [*batch.columns, pa.array(found, pa.list_(pa.float64()))], [*batch.schema.names, column]
            )

    fields = ", ".join(f"`{c}` {t}" for c, t in docs.dtypes)
    return arrow_map(docs, run, f"{fields}, `{column}` array<double>")


def fitted(x: np.ndarray, y: np.ndarray) -> np.ndarray:
    """Weights of a ridge logistic regression on standardised columns, by Newton steps; the first is the constant.

    Good and bad examples count the same in total. Without examples of both kinds only the constant is not 0.
    """
    good = y.mean() if len(y) else 1.0
    if not 0 < good < 1:
        return np.r_[4.0 if good else -4.0, np.zeros(len(NAMES))]
    mean, spread = x.mean(axis=0), x.std(axis=0) + 1e-9
    z = np.c_[np.ones(len(x)), (x - mean) / spread]
    weight = np.where(y == 1, 0.5 / good, 0.5 / (1 - good))
    ridge = np.r_[1e-6, np.full(x.shape[1], RIDGE)]
    w = np.zeros(z.shape[1])
    for _ in range(30):
        p = 1 / (1 + np.exp(-np.clip(z @ w, -30, 30)))
        gradient = z.T @ (weight * (y - p)) - ridge * w
        curve = (z * (weight * p * (1 - p))[:, None]).T @ z + np.diag(ridge)
        step = np.linalg.solve(curve, gradient)
        w += step
        if np.abs(step).max() < 1e-8:
            break
    inner = w[1:] / spread
    return np.r_[w[0] - inner @ mean, inner]


def _labelled(rows: DataFrame, labels: DataFrame, *columns: str) -> list:
    """``columns`` and the quality of the labelled rows; of more than ``TRAIN_ROWS``, those of least hash of doc_id."""
    known = labels.select(F.col("doc_id").cast("long"), F.col("quality").cast("int")).filter("doc_id is not null and quality is not null")
    known = known.groupBy("doc_id").agg(F.min("quality").alias("quality"))
    found = rows.select("doc_id", *columns).join(known, "doc_id").orderBy(F.xxhash64("doc_id"), "doc_id", *columns)
    return found.limit(TRAIN_ROWS).collect()


def train(seen: DataFrame, labels: DataFrame) -> np.ndarray:
    """Weights from the labelled documents of ``seen`` (doc_id, looks); of more than ``TRAIN_ROWS``, those of least hash."""
    rows = _labelled(seen, labels, "looks")
    x = np.array([r.looks for r in rows], np.float64).reshape(-1, len(NAMES))
    return fitted(x, np.array([r.quality for r in rows], np.float64))


def odds(column: Column, weights: np.ndarray) -> Column:
    """Log odds that a document is good, from its looks."""
    terms = [F.get(column, i) * float(w) for i, w in enumerate(weights[1:])]
    return F.greatest(F.lit(-12.0), F.least(F.lit(12.0), sum(terms, F.lit(float(weights[0])))))


def chance(log_odds: Column) -> Column:
    return 1 / (1 + F.exp(-log_odds))


def _strength(groups: DataFrame, mean: str) -> float:
    """Prior weight, in documents, that explains how much groups (n, good, squares) differ from ``mean``.

    Method of moments: the spread of documents within groups, against the spread of the groups' shares
    beyond what that leads to.
    """
    beyond = F.sum(F.col("n") * ((F.col("good") / F.col("n") - F.col(mean)) ** 2)).alias("between")
    inner = F.sum(F.col("squares") - F.col("good") ** 2 / F.col("n")).alias("inner")
    row = groups.agg(beyond, inner, F.sum("n").alias("n"), F.count("*").alias("groups")).first()
    if not row.n or row.n == row.groups:
        return MOST_STRENGTH
    within = max(0.0, row.inner / (row.n - row.groups))
    spread = (row.between - row.groups * within) / row.n
    return MOST_STRENGTH if spread <= within / MOST_STRENGTH else max(1.0, within / spread)


def sites(scored: DataFrame) -> DataFrame:
    """(host, path, base, host_share, path_share) from ``scored`` (host, path, p); written, one row a path."""
    p = F.col("p")
    paths = scored.groupBy("host", "path").agg(F.count("*").alias("n"), F.sum(p).alias("good"), F.sum(p * p).alias("squares"))
    paths = saved(paths, "quality-paths")
    hosts = paths.groupBy("host").agg(*[F.sum(c).alias(c) for c in ("n", "good", "squares")])
    total = paths.agg(F.sum("good") / F.sum("n")).first()[0]
    hosts = hosts.withColumn("base", F.lit(0.5 if total is None else float(total)))
    strong = _strength(hosts, "base")
    host_share = (F.col("good") + strong * F.col("base")) / (F.col("n") + strong)
    hosts = hosts.select("base", F.col("host").alias("_host"), host_share.alias("host_share"))
    paths = saved(paths.join(hosts, F.col("host").eqNullSafe(F.col("_host"))).drop("_host"), "quality-hosts")
    strong = _strength(paths, "host_share")
    path_share = (F.col("good") + strong * F.col("host_share")) / (F.col("n") + strong)
    return saved(paths.select("host", "path", "base", "host_share", path_share.alias("path_share")), "quality-sites")


def _logit(p: Column) -> Column:
    p = F.greatest(F.lit(1e-4), F.least(F.lit(1 - 1e-4), p))
    return F.log(p / (1 - p))


def site_shift() -> Column:
    """Log odds of a path's share against those of all documents."""
    return _logit(F.col("path_share")) - _logit(F.col("base"))


def site_weight(evidence: np.ndarray, shift: np.ndarray, good: np.ndarray) -> float:
    """How much of the shift makes the labels likeliest beside the evidence, by Newton steps; 0 without labels."""
    weight = 0.0
    for _ in range(50):
        p = 1 / (1 + np.exp(-np.clip(evidence + weight * shift, -30, 30)))
        step = (shift @ (good - p) - SITE_RIDGE * weight) / ((shift * shift) @ (p * (1 - p)) + SITE_RIDGE)
        before, weight = weight, float(np.clip(weight + step, 0.0, MOST_SITE_WEIGHT))
        if abs(weight - before) < 1e-10:
            break
    return weight


def posterior(evidence: Column, weight: float) -> Column:
    """Chance that a document is good: its evidence, moved by what its path is like against all documents."""
    return chance(evidence + weight * site_shift())


def judged(docs: DataFrame, labels: DataFrame, host: str = "source", path: str = "lang") -> DataFrame:
    """(doc_id, evidence, host_share, path_share, posterior, keep) for each row of ``docs``.

    ``docs`` has doc_id, text and the columns named by ``host`` and ``path``; ``labels`` has doc_id and
    quality (1 good, 0 bad). NULL hosts or paths are groups of their own; NULL and empty texts look
    like nothing and are judged by the constant. Repeated rows get a row each; of a doc_id labelled
    both ways the bad label counts. Other columns are ignored. Without labels everything is kept; an
    empty table gives an empty result.
    """
    own = docs.select(F.col("doc_id").cast("long"), F.col("text").cast("string"), F.col(f"`{host}`").alias("host"), F.col(f"`{path}`").alias("path"))
    seen = saved(with_looks(own, "looks").drop("text"), "quality-looks")
    columns = ["doc_id", "evidence", "host_share", "path_share", "posterior", "keep"]
    return _judge(seen, model(seen, labels)).select(*columns)


class Model(NamedTuple):
    """Weights of the looks, shares of the sites as a written table, weight of the sites."""

    looks: np.ndarray
    sites: DataFrame
    site_weight: float


def model(seen: DataFrame, labels: DataFrame) -> Model:
    """Everything fitted on ``seen`` (doc_id, host, path, looks): sites on all rows, weights on labelled ones."""
    weights = train(seen, labels)
    scored = seen.withColumn("evidence", odds(F.col("looks"), weights))
    groups = sites(scored.select("host", "path", chance(F.col("evidence")).alias("p")))
    known = _labelled(with_site(scored, groups).withColumn("shift", site_shift()), labels, "evidence", "shift")
    arrays = (np.array([r[c] for r in known], np.float64) for c in ("evidence", "shift", "quality"))
    return Model(weights, groups, site_weight(*arrays))


def _judge(seen: DataFrame, fitted_: Model) -> DataFrame:
    scored = seen.withColumn("evidence", odds(F.col("looks"), fitted_.looks))
    sited = with_site(scored, fitted_.sites)
    return sited.withColumn("posterior", posterior(F.col("evidence"), fitted_.site_weight)).withColumn(
        "keep", F.col("posterior") >= KEEP_FROM
    )


def with_site(scored: DataFrame, groups: DataFrame) -> DataFrame:
    """``scored`` with its path's row of ``groups``; NULL names meet NULL names."""
    marked = [(F.col(c).isNull().alias(f"_{c}_null"), F.coalesce(F.col(c).cast("string"), F.lit("")).alias(f"_{c}")) for c in ("host", "path")]
    flat = [c for pair in marked for c in pair]
    named = groups.select(*flat, "base", "host_share", "path_share")
    on = ["_host", "_host_null", "_path", "_path_null"]
    return matching(scored.select("*", *flat), named, on).drop(*on)


def good_documents(docs: DataFrame, labels: DataFrame, host: str = "source", path: str = "lang") -> DataFrame:
    """The rows of ``docs`` that :func:`judged` keeps, with all their columns and no others."""
    row = docs.select(
        F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("row"),
        F.col("doc_id").cast("long").alias("doc_id"),
        F.col("text").cast("string").alias("text"),
        F.col(f"`{host}`").alias("host"),
        F.col(f"`{path}`").alias("path"),
    )
    seen = saved(with_looks(row.drop("row"), "looks").drop("text"), "quality-looks")
    # The looks are taken once more where the text is, which is cheaper than moving texts to them.
    return _judge(with_looks(row, "looks"), model(seen, labels)).filter("keep").select("row.*")
