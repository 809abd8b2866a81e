"""Bottom-k sketches of documents' word shingles, in DataFrame functions only.

A sketch is the sorted array of the ``k`` smallest 64-bit shingle hashes. Sketches of parts merge into
the sketch of the whole; two sketches estimate resemblance, containment and distinct counts.
"""

from __future__ import annotations

from pyspark.ml.feature import Bucketizer
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tidelake.llm.common import saved

K = 128
BIN_ROWS = 500
MOST_BINS = 20_000
WIDTH = 5


def words_of(text: Column) -> Column:
    """Runs without ASCII white space, A-Z lowered."""
    low = F.translate(F.coalesce(text, F.lit("")), "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
    return F.filter(F.split(low, r"[\x20\x09-\x0D]+"), lambda w: w != "")


def shingle_hashes(words: Column, width: int = WIDTH) -> Column:
    """Hashes of all runs of ``width`` words; fewer words make one run, none make none."""
    at = F.sequence(F.lit(0), F.size(words) - width)
    runs = F.transform(at, lambda i: F.xxhash64(*[F.get(words, i + k) for k in range(width)]))
    whole = F.array(F.xxhash64(words))
    return F.when(F.size(words) >= width, runs).when(F.size(words) > 0, whole).otherwise(F.array().cast("array<long>"))


def sketch(text: Column, k: int = K, width: int = WIDTH) -> Column:
    """The ``k`` smallest distinct shingle hashes of a text, ascending."""
    words = words_of(text)
    # Bound to a name once: as an expression used again and again it would be split again and again.
    hashes = F.element_at(F.transform(F.array(words), lambda w: shingle_hashes(w, width)), 1)
    return F.slice(F.array_sort(F.array_distinct(hashes)), 1, k)


def merged(a: Column, b: Column, k: int = K) -> Column:
    """Sketch of the union of two sketched sets."""
    return F.slice(F.array_sort(F.array_union(a, b)), 1, k)


def merge_sketches(rows: DataFrame, keys: list[str], column: str, k: int = K) -> DataFrame:
    """(keys, sketch) of all rows of each key; a key's rows are cut to ``k`` hashes before they are brought together."""
    hashes = rows.select(*keys, F.explode(column).alias("hash")).distinct()
    place = F.row_number().over(Window.partitionBy(*keys).orderBy("hash"))
    least = hashes.withColumn("place", place).filter(F.col("place") <= k)
    return least.groupBy(*keys).agg(F.array_sort(F.collect_list("hash")).alias("sketch"))


def resemblance(a: Column, b: Column, k: int = K) -> Column:
    """Estimated Jaccard similarity, 0 to 1; two empty sets are alike."""
    both = merged(a, b, k)
    shared = F.size(F.array_intersect(F.array_intersect(both, a), b))
    return F.when(F.size(both) == 0, F.lit(1.0)).otherwise(shared / F.size(both))


def distinct_shingles(a: Column, k: int = K) -> Column:
    """Estimated number of distinct shingles; exact below ``k``."""
    top = (F.element_at(a, -1).cast("double") + F.lit(2.0**63)) / F.lit(2.0**64)
    return F.when(F.size(a) < k, F.size(a).cast("double")).otherwise((k - 1) / top)


def containment(a: Column, b: Column, k: int = K) -> Column:
    """Estimated share of the first set that is in the second, 0 to 1; an empty set is contained."""
    union = distinct_shingles(merged(a, b, k), k)
    share = resemblance(a, b, k) * union / distinct_shingles(a, k)
    return F.when(F.size(a) == 0, F.lit(1.0)).otherwise(F.least(F.lit(1.0), share))


def printed(a: Column) -> Column:
    """The sketch as a string of 16 hexadecimal digits a hash."""
    return F.array_join(F.transform(a, lambda h: F.lpad(F.hex(h), 16, "0")), "")


def _binned(rows: DataFrame, per_bin: int) -> DataFrame:
    """``rows`` with a column ``bin``: ranges of doc_id of about ``per_bin`` rows, more where that made over ``MOST_BINS``.

    Rows without id come last, by ranges of their text's hash ``th``, in bins -1, -2, …
    A range's bounds are quantiles of all ids, so dense stretches of ids get as many bins as they need.
    """
    known = rows.select(F.col("doc_id").cast("double").alias("doc_id")).dropna()
    bins = max(1, min(MOST_BINS, known.count() // per_bin))
    cuts = known.approxQuantile("doc_id", [k / bins for k in range(1, bins)], 0.2 / bins) if bins > 1 else []
    splits = [float("-inf"), *(sorted(set(cuts)) or [0.0]), float("inf")]
    number = Bucketizer(splits=splits, inputCol="_place", outputCol="bin")
    placed = number.transform(rows.withColumn("_place", F.coalesce(F.col("doc_id").cast("double"), F.lit(0.0))))
    nameless = 1 + min(MOST_BINS - 1, rows.filter("doc_id is null").count() // per_bin)
    share = (F.shiftright("th", 1).cast("double") + F.lit(2.0**62)) / F.lit(2.0**63)
    part = F.least(F.floor(share * nameless), F.lit(nameless - 1))
    return placed.drop("_place").withColumn(
        "bin", F.when(F.col("doc_id").isNull(), -1 - part).otherwise(F.col("bin")).cast("int")
    )


def edited_fingerprints(docs: DataFrame, k: int = K) -> DataFrame:
    """Per row of ``docs`` (doc_id, text): its sketch, that of its edited text, and the next document's.

    The edited text has the last third of the code points replaced by the first as many of the next
    document by descending doc_id (all of a shorter one). Rows alike in doc_id and text are one
    document and get a row each; rows of one doc_id with other texts follow each other by a hash;
    rows without doc_id come last. NULL text counts as empty. Other columns are ignored. Returns
    doc_id, n_chars, edited, sketch, edited_sketch, next_sketch.

    Texts are moved once, to bins of neighbouring ids, where the next document is the next row. Only
    a bin's last document needs one from elsewhere, the first of the bin below.
    """
    text = F.coalesce(F.col("text").cast("string"), F.lit(""))
    rows = docs.select(F.col("doc_id").cast("long"), text.alias("text")).withColumn("th", F.xxhash64("text"))
    rows = _binned(rows, BIN_ROWS)

    # The first document of every bin, by ids alone, then its text: one row a bin.
    head = F.max(F.struct("doc_id", F.negative("th").alias("low"))).alias("head")
    heads = rows.select("bin", "doc_id", F.shiftright("th", 1).alias("th")).groupBy("bin").agg(head)
    heads = saved(heads, "fingerprint-heads")
    firsts = rows.alias("r").join(
        F.broadcast(heads).alias("h"),
        F.expr("r.bin = h.bin and r.doc_id <=> h.head.doc_id and shiftright(r.th, 1) = -h.head.low"),
    )
    firsts = firsts.groupBy("r.bin").agg(F.min(F.struct("r.th", "r.text")).alias("first"))
    firsts = saved(firsts, "fingerprint-firsts")
    # Which bin is below which is decided by their numbers, at most two times MOST_BINS; the texts stay where they are.
    falling = Window.orderBy(F.desc("bin"))
    top = F.max("bin").over(falling.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing))
    ring = firsts.select(F.coalesce(F.lead("bin").over(falling), top).alias("bin"), F.col("bin").alias("_bin"))
    below = firsts.join(F.broadcast(ring), "bin").select("_bin", F.col("first.text").alias("below"))

    own = rows.repartition("bin").groupBy("bin", "doc_id", "th").agg(
        F.first("text").alias("text"), F.count("*").cast("int").alias("copies")
    )
    own = own.withColumn("sketch", sketch(F.col("text"), k))
    order = Window.partitionBy("bin").orderBy(F.desc_nulls_last("doc_id"), F.shiftright("th", 1), "th")
    following = own.withColumns({"after": F.lead("text").over(order), "next_sketch": F.lead("sketch").over(order)})
    following = following.join(below, F.expr("bin = _bin and after is null"), "left")
    size = F.length("text")
    following = following.withColumns(
        {
            "n_chars": size.cast("long"),
            "after": F.coalesce("after", "below"),
            "next_sketch": F.coalesce("next_sketch", sketch(F.col("below"), k)),
        }
    )
    replaced = "cast(floor(n_chars / 3) as int)"
    edited = F.expr(f"concat(substring(text, 1, cast(n_chars as int) - {replaced}), substring(after, 1, {replaced}))")
    made = following.withColumn("edited", edited).withColumn("edited_sketch", sketch(F.col("edited"), k))
    made = made.withColumn("copy", F.explode(F.sequence(F.lit(1), "copies")))
    return made.select("doc_id", "n_chars", "edited", "sketch", "edited_sketch", "next_sketch")
