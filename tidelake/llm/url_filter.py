"""Verdicts on URLs: listed rules first, then naive Bayes over words cut from host and path."""

from __future__ import annotations

import math
import re
from collections.abc import Iterator, Sequence
from itertools import islice

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidelake.llm.common import arrow_map, matching, saved

LONGEST_WORD = 20
MEMO = 200_000

#: Words whose hosts count as blocked when the model is fitted.
BLOCKED_WORDS = ("spam", "pills", "casino", "porn", "viagra", "malware", "phishing")


def host_of(url: Column) -> Column:
    """After the first ``://`` up to ``/``, ``?``, ``#`` or the end, A-Z lowered; else empty."""
    host = F.regexp_extract(F.coalesce(url, F.lit("")), r"://([^/?#]*)", 1)
    return F.translate(host, "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def path_of(url: Column) -> Column:
    """After the host up to ``?``, ``#`` or the end."""
    return F.regexp_extract(F.coalesce(url, F.lit("")), r"://[^/?#]*([^?#]*)", 1)


def matching_rule(host: Column, path: Column, rules: Sequence[tuple[str, str]]) -> tuple[Column, Column]:
    """(rule, verdict) of the longest of ``rules`` (verdict, ``host/path``) that fits, else NULLs."""
    rule, verdict = F.lit(None).cast("string"), F.lit(None).cast("string")
    for kind, text in sorted(rules, key=lambda r: len(r[1])):
        domain, _, start = text.partition("/")
        fits = ((host == domain) | host.endswith(f".{domain}")) & path.startswith(f"/{start}")
        rule, verdict = F.when(fits, F.lit(text)).otherwise(rule), F.when(fits, F.lit(kind)).otherwise(verdict)
    return rule, verdict


def word_counts(texts: DataFrame, column: str) -> DataFrame:
    """(word, n) of the a-z words of all marked-up texts; tags, scripts and styles do not count."""
    plain = F.regexp_replace(F.lower(column), r"(?s)<script.*?</script>|<style.*?</style>|<[^>]*>", " ")
    words = texts.select(F.explode(F.split(plain, "[^a-z]+")).alias("word"))
    return words.filter(F.length("word").between(2, LONGEST_WORD)).groupBy("word").agg(F.count("*").alias("n"))


class Segmenter:
    """Most probable split of a concatenated name under a unigram model, by Viterbi."""

    def __init__(self, counts: dict[str, int], total: int | None = None) -> None:
        """``counts`` may lack words that no name has if ``total`` is given."""
        self.total = max(2, sum(counts.values()) if total is None else total)
        self.logs = {w: math.log(n / self.total) for w, n in counts.items()}
        self.longest = max([1, *map(len, counts)])
        self.memo: dict[str, list[str]] = {}

    def unknown(self, size: int) -> float:
        return -math.log(self.total) - 2.3 * size

    def __call__(self, name: str) -> list[str]:
        known = self.memo.get(name)
        if known is None:
            if len(self.memo) >= MEMO:
                self.memo.clear()
            known = self.memo[name] = self.split(name)
        return known

    def split(self, name: str) -> list[str]:
        best, back = [0.0], [0]
        for end in range(1, len(name) + 1):
            score, at = -math.inf, 0
            for start in range(max(0, end - max(self.longest, LONGEST_WORD)), end):
                own = self.logs.get(name[start:end])
                got = best[start] + (self.unknown(end - start) if own is None else own)
                if got > score:
                    score, at = got, start
            best.append(score)
            back.append(at)
        words, end = [], len(name)
        while end:
            words.append(name[back[end] : end])
            end = back[end]
        return words[::-1]


def names_of(host: str) -> list[str]:
    """Runs of a-z of a host without its last label and ``www``."""
    labels = host.split(".")[:-1]
    return [part for label in labels if label != "www" for part in re.split(r"[^a-z]+", label) if part]


def tokens_of(words: list[str], path: str) -> list[str]:
    """The words of a host and those of a path; a run of digits is ``#``."""
    out = [f"h:{word}" for word in words]
    return out + [f"p:{'#' if part.isdigit() else part}" for part in re.split(r"[^0-9a-z]+", path.lower()) if part]


def _parts(longest: int):
    """(key, word) for all runs of 1 to ``longest`` letters in a host's names."""

    def rows_of(keys: list[str], hosts: list[str]) -> Iterator[tuple[str, str]]:
        for key, host in zip(keys, hosts, strict=True):
            for name in names_of(host):
                for end in range(1, len(name) + 1):
                    yield from ((key, name[start:end]) for start in range(max(0, end - longest), end))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows = rows_of(batch.column("key").to_pylist(), batch.column("host").to_pylist())
            while some := list(islice(rows, 50_000)):
                keys, words = zip(*some)
                yield pa.RecordBatch.from_arrays([pa.array(keys, pa.string()), pa.array(words, pa.string())], ["key", "word"])

    return run


def _split(total: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            hosts, known, words = batch.column("host"), batch.column("known").to_pylist(), []
            for host, own in zip(hosts.to_pylist(), known, strict=True):
                split = Segmenter({w["word"]: w["n"] for w in own or []}, total)
                words.append([word for name in names_of(host) for word in split(name)])
            yield pa.RecordBatch.from_arrays([hosts, pa.array(words, pa.list_(pa.string()))], ["host", "words"])

    return run


def host_words(hosts: DataFrame, counts: DataFrame, longest: int) -> DataFrame:
    """(host, words) of distinct ``hosts`` (host), cut under all of ``counts`` (word, n), a written table.

    A host is cut by the counts of the words in its own names, so no task needs the whole vocabulary.
    """
    total = counts.agg(F.coalesce(F.sum("n"), F.lit(0))).first()[0]
    # A long host goes by its hash, as it would be repeated for each of its parts.
    keyed = hosts.withColumn("key", F.when(F.length("host") <= 64, F.col("host")).otherwise(F.sha2("host", 256)))
    parts = arrow_map(keyed, _parts(longest), "key string, word string")
    known = matching(parts, counts, ["word"]).groupBy("key").agg(F.collect_set(F.struct("word", "n")).alias("known"))
    own = keyed.join(known, "key", "left").select("host", "known")
    return saved(arrow_map(own, _split(total), "host string, words array<string>"), "urls-hosts")


def _tokenised(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        words, paths = batch.column("words").to_pylist(), batch.column("path").to_pylist()
        tokens = [tokens_of(w, p) for w, p in zip(words, paths, strict=True)]
        names = batch.schema.names
        kept = [c for c, n in zip(batch.columns, names) if n != "words"]
        yield pa.RecordBatch.from_arrays(
            [*kept, pa.array(tokens, pa.list_(pa.string()))], [*[n for n in names if n != "words"], "tokens"]
        )


def evidence(tokens: DataFrame, weights: DataFrame) -> DataFrame:
    """(host, path, evidence): the sum of the ``weights`` (token, weight) of a URL's tokens, written.

    Each host and path is scored once, in the order of its tokens; those without weights have no row.
    """
    spots = tokens.select("host", "path", "tokens").distinct()
    spots = spots.select("host", "path", F.posexplode("tokens").alias("at", "token"))
    own = matching(spots, weights, ["token"]).groupBy("host", "path")
    own = own.agg(F.array_sort(F.collect_list(F.struct("at", "weight"))).alias("own"))
    total = F.aggregate("own", F.lit(0.0), lambda sum_, x: sum_ + x["weight"])
    return saved(own.select("host", "path", total.alias("evidence")), "urls-evidence")


def judged(
    pages: DataFrame, rules: Sequence[tuple[str, str]], blocked_words: Sequence[str] = BLOCKED_WORDS
) -> DataFrame:
    """(page_id, host, path, rule, verdict, score, tokens) for each row of ``pages`` (page_id, url, html).

    The longest fitting rule decides; other URLs are blocked when naive Bayes finds that likelier
    (score above 0). Its examples are all URLs: to block where the host has one of ``blocked_words``,
    to allow elsewhere; other URLs that a rule blocks are none, as rules speak of places, not of
    words. The words hosts are cut into are counted over all pages' text, blocked
    words once at least; the model has the weights of all tokens of examples. Without examples of both kinds everything without a rule is allowed. NULL urls and urls without ``://``
    have empty host and path. Repeated rows get a row each; other columns are ignored.
    """
    spark = pages.sparkSession
    counted = saved(word_counts(pages, "html"), "urls-counted")
    seeds = spark.createDataFrame([(w,) for w in sorted(set(blocked_words))], "word string").coalesce(1)
    new = seeds.join(counted.filter(F.col("word").isin(*blocked_words)), "word", "left_anti")
    counts = counted.unionByName(new.select("word", F.lit(1).cast("long").alias("n")))
    longest = max([LONGEST_WORD, *map(len, blocked_words)])
    urls = pages.select("page_id", host_of(F.col("url")).alias("host"), path_of(F.col("url")).alias("path"))
    rule, verdict = matching_rule(F.col("host"), F.col("path"), rules)
    urls = urls.withColumns({"rule": rule, "listed": verdict})
    words = host_words(saved(urls.select("host").distinct(), "urls-distinct"), counts, longest)
    urls = matching(urls, words, ["host"])
    fields = ", ".join(f"{c} {t}" for c, t in urls.dtypes if c != "words")
    tokens = arrow_map(urls, _tokenised, f"{fields}, tokens array<string>")
    tokens = saved(tokens, "urls-tokens")

    seeds = F.array(*[F.lit(f"h:{w}") for w in blocked_words]).cast("array<string>")
    label = F.when(F.arrays_overlap("tokens", seeds), F.lit("block"))
    label = label.when(F.coalesce("listed", F.lit("allow")) == "allow", F.lit("allow"))
    examples = tokens.select(label.alias("label"), "tokens").filter("label is not null")
    sizes = {r.label: r.n for r in examples.groupBy("label").agg(F.count("*").alias("n")).collect()}
    by_token = examples.select("label", F.explode("tokens").alias("token")).groupBy("token")
    by_token = by_token.agg(
        F.count(F.when(F.col("label") == "block", 1)).alias("block"),
        F.count(F.when(F.col("label") != "block", 1)).alias("allow"),
    )
    score = F.lit(-math.inf)
    scored = tokens
    if len(sizes) == 2:
        by_token = saved(by_token, "urls-by-token")
        n, block, allow = by_token.agg(
            F.count("*"), F.coalesce(F.sum("block"), F.lit(0)), F.coalesce(F.sum("allow"), F.lit(0))
        ).first()
        weight = F.log((F.col("block") + 1) / F.lit(block + n)) - F.log((F.col("allow") + 1) / F.lit(allow + n))
        found = evidence(tokens, by_token.select("token", weight.alias("weight")))
        scored = matching(tokens, found, ["host", "path"], "left")
        score = F.lit(math.log(sizes["block"] / sizes["allow"])) + F.coalesce("evidence", F.lit(0.0))
    scored = scored.withColumn("score", score)
    by_method = F.when(F.col("score") > 0, F.lit("block")).otherwise(F.lit("allow"))
    return scored.select(
        "page_id", "host", "path", "rule", F.coalesce("listed", by_method).alias("verdict"), "score", "tokens"
    )
