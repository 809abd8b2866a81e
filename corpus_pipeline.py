"""A corpus from raw documents to packed training sequences, stage by stage.

Each stage takes (spark, docs, sf_dir) and returns a DataFrame that is written and read again as the
next stage's documents. All but the last keep the columns of ``documents``; where a stage changes a
text, ``n_chars`` follows it.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidelake.llm import jaccard_join, packing, pii, quality, suffix_dedup
from tidelake.llm.common import matching, saved, table, tokenizer_path


def _with_text(rows: DataFrame, text, columns: list[str]) -> DataFrame:
    """``rows`` with a new text, its length in ``n_chars`` where there is such a column, and ``columns`` only."""
    rows = rows.withColumn("text", text)
    if "n_chars" in columns:
        rows = rows.withColumn("n_chars", F.length("text").cast(rows.schema["n_chars"].dataType))
    return rows.select(*[F.col(f"`{c}`") for c in columns])


def keep_good(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the quality classifier does not reject."""
    return quality.good_documents(docs, table(spark, sf_dir, "labels"))


def keep_one_of_similar(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document, that of the smallest doc_id, of each group linked by similar texts.

    Rows are judged with their texts: of a doc_id that has several, each text stays or goes by its own
    group. Rows that repeat a doc_id and text, or similar texts under one doc_id, count as one
    document; rows without doc_id stay.
    """
    found = saved(jaccard_join.similar_components(docs), "pipeline-components")
    row = ["doc_id", "text_key"]
    named = found.filter("doc_id is not null")
    # Of one doc_id's similar texts the one with the smallest key stays.
    several = named.filter("component_id = doc_id and component is not null").groupBy("doc_id", "component")
    several = several.agg(F.min("text_key").alias("kept"), F.max("text_key").alias("last")).filter("kept < last")
    others = named.join(several.select("doc_id", "component", "kept"), ["doc_id", "component"]).filter("text_key != kept")
    dropped = named.filter("component_id != doc_id").select(*row).unionByName(others.select(*row)).distinct()
    again = named.groupBy(*row).count().filter("count > 1").select(*row)
    dropped, again = saved(dropped, "pipeline-dropped"), saved(again, "pipeline-repeated")
    keyed = docs.select(F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("row"), F.col("doc_id").alias("doc_id"))
    keyed = keyed.withColumn("text_key", F.xxhash64("row.text"))
    kept = keyed.join(F.broadcast(dropped) if dropped.count() <= 200_000 else dropped, row, "left_anti")
    if not again.isEmpty():
        once = matching(kept, again, row).dropDuplicates(row)
        kept = kept.join(again, row, "left_anti").unionByName(once)
    return kept.select(*[F.col(f"row.`{c}`").alias(c) for c in docs.columns])


def cut_repeats(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without the long passages that earlier documents have."""
    cut = suffix_dedup.without_repeats(docs, carry=docs.columns)
    return _with_text(cut.select("carried.*", F.col("text").alias("_left")), F.col("_left"), docs.columns)


def redact(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents with personal data put as its kind."""
    found = pii.found_spans(docs, "_pii")
    return _with_text(found, F.col("_pii.clean"), docs.columns)


def pack(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of documents in training sequences."""
    return packing.packed(docs, tokenizer_path("word_bpe_49k.json"))


STAGES = [
    ("quality classifier", keep_good),
    ("n-gram Jaccard join", keep_one_of_similar),
    ("suffix-array dedup", cut_repeats),
    ("PII", redact),
    ("packing", pack),
]

#: Models, iterations and tokenizers are not expressible in SQL; the tests compare with brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES:
        docs = saved(stage(spark, docs, sf_dir), f"pipeline-{name.replace(' ', '-')}")
    return docs
