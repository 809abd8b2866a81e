"""One query per corpus operator, over its whole table."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidelake.llm import (
    alignment,
    fingerprints,
    importance,
    jaccard_join,
    license_scan,
    neighbours,
    packing,
    pii,
    quality,
    sentencepiece_codec,
    suffix_dedup,
    url_filter,
    warc,
)
from tidelake.llm.common import saved, table, tokenizer_path
from tidelake.session import scratch_dir


def op1_jaccard_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = jaccard_join.similar_components(table(spark, sf_dir, "documents"))
    return found.select("doc_id", "n_shingles", "component_id")


def op2_sentencepiece(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Ids of every text, and whether decoding them gives it back."""
    path = tokenizer_path("piece_bpe_32k.model")
    ids = sentencepiece_codec.encoded_and_decoded(table(spark, sf_dir, "documents"), path)
    return ids.select("doc_id", F.size("ids").cast("long").alias("n_pieces"), "ids", "restored")


def op3_fingerprints(spark: SparkSession, sf_dir: str) -> DataFrame:
    made = fingerprints.edited_fingerprints(table(spark, sf_dir, "documents"))
    return made.select(
        "doc_id",
        "n_chars",
        F.sha2("edited", 256).alias("edited_sha256"),
        fingerprints.printed(F.col("sketch")).alias("fingerprint"),
        fingerprints.printed(F.col("edited_sketch")).alias("edited_fingerprint"),
        fingerprints.resemblance(F.col("sketch"), F.col("edited_sketch")).alias("near_edited"),
        fingerprints.resemblance(F.col("sketch"), F.col("next_sketch")).alias("near_next"),
    )


def op4_suffix_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    cut = suffix_dedup.without_repeats(table(spark, sf_dir, "documents"))
    return cut.select(
        "doc_id",
        "n_bytes",
        (F.col("n_bytes") - F.octet_length("kept")).cast("long").alias("n_removed"),
        F.size("spans").cast("long").alias("n_spans"),
        F.sha2("kept", 256).alias("kept_sha256"),
    )


def op5_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    pieces = packing.packed(table(spark, sf_dir, "documents"), tokenizer_path("word_bpe_49k.json"))
    return pieces.select(
        "doc_id", "start", "length", F.crc32("ids").alias("ids_crc32"), "doc_tokens", "sequence_id", "offset"
    )


def op6_neighbours(spark: SparkSession, sf_dir: str) -> DataFrame:
    return neighbours.nearest(table(spark, sf_dir, "embeddings"), F.col("vec_id") % 50 == 0)


def op7_pii(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = pii.found_spans(table(spark, sf_dir, "documents").select("doc_id", "text"))

    def listed(column: str):
        return F.array_join(F.transform(column, lambda s: F.concat_ws(":", s["kind"], s["start"], s["end"])), ",")

    def number(kind: str):
        return F.size(F.filter("pii.base", lambda s: s["kind"] == kind)).cast("long").alias(f"n_{kind}")

    return found.select(
        "doc_id",
        *[number(kind) for kind in pii.KINDS[:4]],
        F.sha2(listed("pii.base"), 256).alias("base_sha256"),
        listed("pii.spans").alias("spans"),
    )


URL_RULES = (
    ("allow", "com/"),
    ("block", "example.com/en/"),
    ("allow", "www.example.com/en/"),
    ("block", "net/es/"),
    ("block", "net/fr/"),
)


def op8_url_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    judged = url_filter.judged(table(spark, sf_dir, "pages"), URL_RULES)
    return judged.select("page_id", "host", "path", "rule", "verdict")


def op9_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality.judged(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


def op10_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = scratch_dir(spark, "warc")
    warc.write_archives(table(spark, sf_dir, "pages"), path, segment_bytes=8 << 10)
    read = warc.read_archives(spark, path).select(
        "page_id",
        F.octet_length("payload").cast("long").alias("payload_bytes"),
        "payload_digest",
        "record_type",
        "refers_to",
    )
    read = saved(read, "warc-read")
    responses = read.filter("record_type = 'response'")
    # A revisit's payload is the one of the record it refers to.
    same = ["refers_to", "payload_digest"]
    sizes = responses.select(F.col("page_id").alias("refers_to"), "payload_digest", "payload_bytes").dropDuplicates(same)
    revisits = read.filter("record_type = 'revisit'").drop("payload_bytes").join(sizes, same, "left")
    return responses.unionByName(revisits)


def op11_importance(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = importance.scored(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))
    return importance.ranked(rows)


def op12_license_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = license_scan.scanned(table(spark, sf_dir, "documents"))
    base = F.filter("spans", lambda s: s["phrase"])
    return found.select(
        "doc_id",
        "n_words",
        F.size(base).cast("long").alias("n_base"),
        F.array_min(F.transform(base, lambda s: s["start"])).cast("long").alias("first_word"),
        F.array_max(F.transform(base, lambda s: s["start"])).cast("long").alias("last_word"),
        license_scan.labels(base).alias("base_labels"),
        license_scan.labels(F.col("spans")).alias("labels"),
        F.coalesce(F.array_max(F.transform("spans", lambda s: s["share"])), F.lit(0.0)).alias("score"),
    )


def op13_alignment(spark: SparkSession, sf_dir: str) -> DataFrame:
    paths = tokenizer_path("byte_bpe_50k.json"), tokenizer_path("piece_bpe_32k.model")
    rows = alignment.counted(alignment.aligned(table(spark, sf_dir, "documents"), *paths))
    return rows.select(
        "doc_id", "n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum", "groups_sha256"
    )


def pipeline(spark: SparkSession, sf_dir: str) -> DataFrame:
    import corpus_pipeline

    return corpus_pipeline.run(spark, sf_dir)


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "op1_jaccard_join": op1_jaccard_join,
    "op2_sentencepiece": op2_sentencepiece,
    "op3_fingerprints": op3_fingerprints,
    "op4_suffix_dedup": op4_suffix_dedup,
    "op5_packing": op5_packing,
    "op6_neighbours": op6_neighbours,
    "op7_pii": op7_pii,
    "op8_url_filter": op8_url_filter,
    "op9_quality": op9_quality,
    "op10_warc": op10_warc,
    "op11_importance": op11_importance,
    "op12_license_scan": op12_license_scan,
    "op13_alignment": op13_alignment,
    "pipeline": pipeline,
}
_TEMPLATE_ROWS = ", ".join(f"({i}, '{label}', '{text}')" for i, (label, text) in enumerate(license_scan.TEMPLATES))
ORACLES: dict[str, str] = {
    "op1_jaccard_join": """WITH RECURSIVE split AS (
  SELECT doc_id, list_filter(regexp_split_to_array(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ',
    'abcdefghijklmnopqrstuvwxyz'), '[\\x20\\x09-\\x0D]+'), lambda x: x <> '') AS w FROM documents
),
sets AS (
  SELECT DISTINCT doc_id, unnest(CASE WHEN len(w) >= 5
    THEN list_transform(range(1, len(w) - 3), lambda i: array_to_string(w[i : i + 4], ' '))
    WHEN len(w) > 0 THEN [array_to_string(w, ' ')] ELSE [] END) AS shingle FROM split
),
sizes AS (SELECT doc_id, count(*) AS n FROM sets GROUP BY doc_id),
shared AS (
  SELECT a.doc_id AS a, b.doc_id AS b, count(*) AS n FROM sets a JOIN sets b USING (shingle)
  WHERE a.doc_id < b.doc_id GROUP BY 1, 2
),
links AS (
  SELECT a, b FROM shared s JOIN sizes x ON x.doc_id = a JOIN sizes y ON y.doc_id = b
  WHERE 100 * s.n >= 75 * (x.n + y.n - s.n)
),
ways AS (SELECT a, b FROM links UNION ALL SELECT b, a FROM links),
reached(a, b) AS (SELECT a, b FROM ways UNION SELECT r.a, w.b FROM reached r JOIN ways w ON r.b = w.a),
least AS (SELECT a, min(b) AS b FROM reached GROUP BY a)
SELECT d.doc_id, coalesce(n, 0) AS n_shingles, least(d.doc_id, coalesce(least.b, d.doc_id)) AS component_id
FROM documents d LEFT JOIN sizes USING (doc_id) LEFT JOIN least ON least.a = d.doc_id""",
    "op11_importance": """WITH RECURSIVE steps(n, step, c) AS (
  SELECT range, 0, range FROM range(256)
  UNION ALL SELECT n, step + 1, CASE WHEN c & 1 = 1 THEN xor(c >> 1, 3988292384) ELSE c >> 1 END FROM steps WHERE step < 8
),
crc AS (SELECT n, c FROM steps WHERE step = 8),
texts AS (
  SELECT 0 AS side, row_number() OVER () AS r, doc_id, text FROM documents
  UNION ALL SELECT 1, row_number() OVER (), NULL, text FROM benchmark
),
split AS (
  SELECT side, r, doc_id, list_filter(regexp_split_to_array(translate(coalesce(text, ''),
    'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]+'),
    lambda x: x <> '') AS w FROM texts
),
grams AS (
  SELECT side, r, unnest(list_concat(w, list_transform(range(1, len(w)), lambda i: w[i] || ' ' || w[i + 1]))) AS gram
  FROM split
),
bytes AS (
  SELECT gram, hex(encode(gram)) AS h, strlen(gram) AS size FROM (SELECT DISTINCT gram FROM grams)
),
rolled(gram, h, size, i, c) AS (
  SELECT gram, h, size, 0, 4294967295 FROM bytes
  UNION ALL
  SELECT gram, h, size, i + 1, xor(x.c >> 8, crc.c) FROM rolled x JOIN crc
    ON crc.n = xor(x.c, ('0x' || substr(h, 2 * i + 1, 2))::BIGINT) & 255 WHERE i < size
),
buckets AS (SELECT gram, xor(c, 4294967295) % 10000 AS bucket FROM rolled WHERE i = size),
counts AS (
  SELECT bucket, count(*) FILTER (side = 0) AS s, count(*) FILTER (side = 1) AS t FROM grams JOIN buckets USING (gram)
  GROUP BY bucket
),
totals AS (SELECT sum(s)::DOUBLE AS s_all, sum(t)::DOUBLE AS t_all FROM counts),
gains AS (
  SELECT bucket, floor(1000 * ln((t + 1)::DOUBLE * (s_all + 10000) / ((s + 1)::DOUBLE * (t_all + 10000))))::BIGINT AS gain
  FROM counts, totals
),
weights AS (
  SELECT r, count(*) AS n_features, floor(sum(gain)::DOUBLE / count(*))::BIGINT AS weight
  FROM grams JOIN buckets USING (gram) JOIN gains USING (bucket) WHERE side = 0 GROUP BY r
),
scores AS (
  SELECT doc_id, len(w) AS n, coalesce(n_features, 0) AS n_features, coalesce(weight, 0) AS weight,
    coalesce(weight, 0) + floor(-1000 * ln(-ln((('0x' || substr(sha256('7:' || doc_id), 1, 8))::BIGINT + 0.5::DOUBLE)
      / 4294967296.0::DOUBLE)))::BIGINT AS score
  FROM split LEFT JOIN weights USING (r) WHERE side = 0
),
places AS (
  SELECT *, CASE WHEN n >= 20 THEN row_number() OVER (PARTITION BY n >= 20 ORDER BY score DESC, doc_id) END AS place,
    count(*) FILTER (n >= 20) OVER () AS able FROM scores
)
SELECT doc_id, n_features, weight, score, CASE WHEN place <= 25 * able // 100 THEN place END AS rank FROM places""",
    "op12_license_scan": f"""WITH templates(template, label, body) AS (VALUES {_TEMPLATE_ROWS}),
parts AS (
  SELECT template, label, string_split(body, ' ') AS t, len(string_split(body, ' ')) AS length,
    CASE WHEN len(string_split(body, ' ')) < 5 THEN 2 ELSE 3 END AS width FROM templates
),
template_grams AS (
  SELECT *, length - width + 1 AS grams, unnest(range(length - width + 1)) AS place FROM parts
),
wanted AS (SELECT * EXCLUDE (t), array_to_string(t[place + 1 : place + width], ' ') AS gram FROM template_grams),
split AS (
  SELECT row_number() OVER () AS r, doc_id, list_filter(regexp_split_to_array(translate(coalesce(text, ''),
    'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]+'),
    lambda x: x <> '') AS w FROM documents
),
runs AS (
  SELECT r, w, unnest(range(len(w) - 1)) AS pos, 2 AS width FROM split
  UNION ALL SELECT r, w, unnest(range(len(w) - 2)), 3 FROM split
),
hits AS (
  SELECT r, template, label, length, width, grams, place, pos FROM
    (SELECT r, pos, width, array_to_string(w[pos + 1 : pos + width], ' ') AS gram FROM runs) JOIN wanted USING (width, gram)
),
diagonals AS (
  SELECT r, template, label, length, width, grams, pos - place AS diagonal, list(place) AS places, min(pos) AS first,
    max(pos) AS last FROM hits GROUP BY ALL
),
phrases AS (
  SELECT r, label, diagonal AS start, 1.0::DOUBLE AS share FROM diagonals WHERE length < 5 AND len(places) = grams
),
marked AS (
  SELECT *, coalesce(abs(diagonal - lag(diagonal) OVER o) > 8 OR first - lag(last) OVER o > 8, true)::INT AS new
  FROM diagonals WHERE length >= 5 WINDOW o AS (PARTITION BY r, template ORDER BY first, diagonal)
),
numbered AS (
  SELECT *, sum(new) OVER (PARTITION BY r, template ORDER BY first, diagonal ROWS UNBOUNDED PRECEDING) AS run FROM marked
),
notices AS (
  SELECT r, label, len(list_distinct(flatten(list(places))))::DOUBLE / grams AS share FROM numbered
  GROUP BY r, template, run, label, length, width, grams
  HAVING len(list_distinct(flatten(list(places))))::DOUBLE / grams >= 0.5
    AND max(last) + width - min(first) <= 2 * length
),
base AS (
  SELECT r, count(*) AS n_base, min(start)::BIGINT AS first_word, max(start)::BIGINT AS last_word,
    string_agg(DISTINCT label, ',' ORDER BY label) AS base_labels FROM phrases GROUP BY r
),
every AS (
  SELECT r, string_agg(DISTINCT label, ',' ORDER BY label) AS labels, max(share) AS score
  FROM (SELECT r, label, share FROM phrases UNION ALL SELECT r, label, share FROM notices) GROUP BY r
)
SELECT doc_id, len(w)::BIGINT AS n_words, coalesce(n_base, 0) AS n_base, first_word, last_word,
  coalesce(base_labels, '') AS base_labels, coalesce(labels, '') AS labels, coalesce(score, 0)::DOUBLE AS score
FROM split LEFT JOIN base USING (r) LEFT JOIN every USING (r)""",
}
