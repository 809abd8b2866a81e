"""Personal data: fixed forms, and identifiers found from the contexts and shapes the fixed forms have.

The fixed forms (email, ip, card, phone) are the seeds. Every token that could be an identifier, a seed
or not, is an instance with lexical patterns: the words before and after it and its shape. Scores run
to and fro over the graph of patterns and instances: a pattern is as good as the instances it has, an
instance as good as its best patterns agree. Patterns that stay good find identifiers of no fixed form.
"""

from __future__ import annotations

import re
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidelake.llm.common import BROADCAST_ROWS, arrow_map, saved

KINDS = ("email", "ip", "card", "phone", "id")
ROUNDS = 3
LEAST_SURE = 5
GOOD_PATTERN = 0.9
LEAST_SCORE = 0.85
LEAST_DIGITS, LEAST_LENGTH = 4, 8

_DOMAIN = re.compile(r"[A-Za-z0-9-]+(?:\.[A-Za-z0-9-]+)+")
_LOCAL_END = re.compile(r"[A-Za-z0-9._%+-]")
_IP = re.compile(r"(?<![0-9])[0-9]++(?:\.[0-9]++){3}")
_CARD = re.compile(r"[0-9](?:[ -]?[0-9])+")
_PHONE = re.compile(r"\+[0-9][ ().0-9-]+[0-9]")
_DIGIT = re.compile(r"[0-9]")
_TOKEN = re.compile(r"\S+")
_EDGES = "\"'`.,;:!?()[]{}<>|*&%$#"


def luhn(digits: str) -> bool:
    total = 0
    for place, digit in enumerate(reversed(digits)):
        value = ord(digit) - 48
        if place % 2:
            value = value * 2 - 9 * (value > 4)
        total += value
    return total % 10 == 0


def emails(text: str) -> Iterator[tuple[int, int]]:
    """Leftmost matches, by way of their @: what stands before it is the longest run up to the last match."""
    done, at = 0, text.find("@")
    while at >= 0:
        start = at
        while start > done and _LOCAL_END.match(text[start - 1]):
            start -= 1
        domain = _DOMAIN.match(text, at + 1) if start < at else None
        if domain:
            done = domain.end()
            yield start, done
        else:
            done = max(done, at + 1)
        at = text.find("@", max(at + 1, done))


def fixed_forms(text: str) -> list[tuple[int, int, int]]:
    """(start, kind number, end) of the fixed forms, leftmost and without overlaps within a kind, in order."""
    found = [(a, 0, b) for a, b in emails(text)]
    if _DIGIT.search(text):
        for m in _IP.finditer(text):
            if all(len(p.lstrip("0")) < 4 and int(p) <= 255 for p in m.group().split(".")):
                found.append((m.start(), 1, m.end()))
        for m in _CARD.finditer(text):
            digits = m.group().replace(" ", "").replace("-", "")
            if 14 <= len(digits) <= 19 and luhn(digits):
                found.append((m.start(), 2, m.end()))
        for m in _PHONE.finditer(text):
            if 10 <= sum(map(m.group().count, "0123456789")) <= 15:
                found.append((m.start(), 3, m.end()))
    return sorted(found)


def shape_of(token: str) -> str:
    """Kinds of characters: runs of letters and digits mixed as ``x``, of digits ``0`` with their number, of letters ``a``."""
    out = []
    for run in re.findall(r"[0-9A-Za-z]+|[^0-9A-Za-z]", token):
        if run.isdigit():
            out.append(f"0{len(run)}")
        elif run.isascii() and run.isalnum():
            out.append(("x" if any(c.isdigit() for c in run) else "a") + ("" if len(run) < 8 else "+"))
        else:
            out.append(run)
    return "".join(out)


def _plain(word: str) -> str:
    return re.sub(r"[0-9]", "0", word.strip(_EDGES).lower())[:24]


def instances(text: str, base: list[tuple[int, int, int]]) -> list[tuple[int, int, bool, list[str]]]:
    """(start, end, is a seed, patterns) of the seeds and of tokens that could be identifiers.

    Such a token has at least four digits among eight characters after the marks around it are taken
    off, and overlaps no seed; of ``name=value`` the value counts, the name being its left context.
    """
    if not base and not _DIGIT.search(text):
        return []
    words = [(m.start(), m.end()) for m in _TOKEN.finditer(text)]
    spots, b = [], 0
    for start, _, end in base:
        spots.append((start, end, True))
    merged: list[list[int]] = []
    for start, _, end in base:
        if merged and start <= merged[-1][1]:
            merged[-1][1] = max(merged[-1][1], end)
        else:
            merged.append([start, end])
    for lo, hi in words:
        token = text[lo:hi]
        if not _DIGIT.search(token):
            continue
        name, mark, value = token.rpartition("=")
        if mark and value:
            lo = hi - len(value)
            token = value
        core = token.strip(_EDGES)
        lo += len(token) - len(token.lstrip(_EDGES))
        if len(core) < LEAST_LENGTH or sum(map(core.count, "0123456789")) < LEAST_DIGITS:
            continue
        while b < len(merged) and merged[b][1] <= lo:
            b += 1
        if b < len(merged) and merged[b][0] < lo + len(core):
            continue
        spots.append((lo, lo + len(core), False))
    out, w = [], 0
    for lo, hi, seed in sorted(spots):
        while w < len(words) and words[w][1] <= lo:
            w += 1
        attached = text[words[w][0] : lo] if w < len(words) else ""
        before = [_plain(text[a:b]) for a, b in words[max(0, w - 2) : w]]
        after = next((_plain(text[a:b]) for a, b in words[w : w + 20] if a >= hi), "")
        left = attached.strip(_EDGES) or (before[-1] if before else "")
        patterns = [f"l1 {left.lower()[-24:]}", f"l2 {' '.join(before)}", f"r1 {after}", f"s {shape_of(text[lo:hi])}"]
        out.append((lo, hi, seed, patterns))
    return out


def _graph(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        names, seeds, patterns = [], [], []
        for text in batch.column("text").to_pylist():
            text = text or ""
            for lo, hi, seed, own in instances(text, fixed_forms(text)):
                names.append(text[lo:hi])
                seeds.append(seed)
                patterns.append(own)
        yield pa.RecordBatch.from_arrays(
            [pa.array(names, pa.string()), pa.array(seeds, pa.bool_()), pa.array(patterns, pa.list_(pa.string()))],
            ["instance", "seed", "patterns"],
        )


def learned_patterns(docs: DataFrame) -> DataFrame:
    """(pattern, worth) of all high-confidence patterns, written to the shared folder.

    Instances count once each, however often they occur. A seed scores 1; a pattern the mean of its
    instances' scores, counted only from ``LEAST_SURE`` sure ones on; another instance the mean of its two
    best patterns of different kinds, so that neither a shape nor a context alone is enough.
    """
    spans = arrow_map(docs.select("text"), _graph, "instance string, seed boolean, patterns array<string>")
    edges = spans.select("instance", "seed", F.explode("patterns").alias("pattern"))
    edges = saved(edges.groupBy("instance", "pattern").agg(F.max("seed").alias("seed")), "pii-graph")
    seen = edges.groupBy("instance").agg(F.max("seed").alias("seed"))
    scores = seen.withColumn("score", F.when(F.col("seed"), 1.0).otherwise(0.0))
    for turn in range(ROUNDS):
        patterns = edges.select("instance", "pattern").join(scores, "instance").groupBy("pattern")
        sure = F.count(F.when(F.col("score") >= LEAST_SCORE, 1))
        patterns = patterns.agg(F.avg("score").alias("worth"), sure.alias("sure"))
        patterns = saved(patterns.filter(F.col("sure") >= LEAST_SURE), f"pii-patterns-{turn}")
        best = edges.filter(~F.col("seed")).join(patterns, "pattern").groupBy("instance")
        # Kinds of patterns: l1 and l2 are one, the words before.
        kind = F.substring("pattern", 1, 1)
        best = best.agg(
            F.max(F.when(kind == "l", F.col("worth"))).alias("l"),
            F.max(F.when(kind == "r", F.col("worth"))).alias("r"),
            F.max(F.when(kind == "s", F.col("worth"))).alias("s"),
        )
        order = F.array_sort(F.transform(F.array("l", "r", "s"), lambda x: -F.coalesce(x, F.lit(0.0))))
        best = best.select("instance", (-(F.get(order, 0) + F.get(order, 1)) / 2).alias("found"))
        scores = seen.join(best, "instance", "left").select(
            "instance", "seed", F.when(F.col("seed"), 1.0).otherwise(F.coalesce("found", F.lit(0.0))).alias("score")
        )
        scores = saved(scores, f"pii-scores-{turn}")
    return saved(patterns.filter(F.col("worth") >= GOOD_PATTERN).select("pattern", "worth"), "pii-good")


def all_spans(text: str, model: dict[str, float]) -> tuple[list, list]:
    """(fixed forms, fixed forms and found identifiers), each (start, kind number, end) in order.

    ``found_places`` finds the same identifiers with a model that is a table.
    """
    base = fixed_forms(text)
    extra = []
    for lo, hi, seed, patterns in instances(text, base) if model else []:
        if seed:
            continue
        best: dict[str, float] = {}
        for pattern in patterns:
            best[pattern[0]] = max(best.get(pattern[0], 0.0), model.get(pattern, 0.0))
        top = sorted(best.values(), reverse=True)[:2]
        if sum(top) / 2 >= LEAST_SCORE:
            extra.append((lo, 4, hi))
    return base, sorted(base + extra)


def _candidates(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    kinds = [pa.string(), pa.int32(), pa.int32(), pa.list_(pa.string())]
    for batch in batches:
        rows = []
        for key, text in zip(batch.column("key").to_pylist(), batch.column("text").to_pylist(), strict=True):
            found = instances(text, fixed_forms(text))
            rows += [(key, lo, hi, patterns) for lo, hi, seed, patterns in found if not seed]
        columns = zip(*rows) if rows else [()] * len(kinds)
        yield pa.RecordBatch.from_arrays(
            [pa.array(c, k) for c, k in zip(columns, kinds)], ["key", "start", "end", "patterns"]
        )


def found_places(docs: DataFrame, model: DataFrame) -> DataFrame:
    """(key, places) of the texts with identifiers of no fixed form, places being (start, end); ``key`` is ``text_key``."""
    texts = docs.select(text_key().alias("key"), "text").filter("text is not null")
    spots = arrow_map(texts, _candidates, "key string, start int, end int, patterns array<string>")
    edges = spots.select("key", "start", "end", F.explode("patterns").alias("pattern")).join(model, "pattern")
    kind = F.substring("pattern", 1, 1)
    worths = [F.max(F.when(kind == k, F.col("worth"))).alias(k) for k in "lrs"]
    best = edges.groupBy("key", "start", "end").agg(*worths)
    order = F.array_sort(F.transform(F.array(*"lrs"), lambda x: -F.coalesce(x, F.lit(0.0))))
    best = best.filter(-(F.get(order, 0) + F.get(order, 1)) / 2 >= LEAST_SCORE)
    return best.groupBy("key").agg(F.collect_list(F.struct("start", "end")).alias("places"))


def text_key() -> Column:
    return F.sha2("text", 256)


SPANS = "array<struct<kind:string,start:int,end:int>>"
_SPANS = pa.list_(pa.struct([("kind", pa.string()), ("start", pa.int32()), ("end", pa.int32())]))


def _named(spans: list) -> list[dict]:
    return [{"kind": KINDS[k], "start": a, "end": b} for a, k, b in spans]


def redacted(text: str, spans: list[tuple[int, int, int]]) -> str:
    """The text with each span, or run of overlapping spans, put as its first kind in brackets."""
    out, at = [], 0
    for start, kind, end in spans:
        if start >= at:
            out += [text[at:start], f"[{KINDS[kind].upper()}]"]
        at = max(at, end)
    return "".join([*out, text[at:]])


def found_spans(docs: DataFrame, column: str = "pii") -> DataFrame:
    """``docs`` (text, any others) with a new struct column of base spans, all spans and the redacted text.

    Positions are code points, ends exclusive; spans are ordered by start and kind. NULL texts have no
    spans and stay NULL. Patterns are learned from all rows of ``docs``; no rows, no patterns.
    Repeated rows get a row each, and a new column named as an old one replaces it. All good patterns
    count; they are sent to all tasks while they are at most ``BROADCAST_ROWS``, else joined.
    """
    patterns = learned_patterns(docs)
    few = patterns.count() <= BROADCAST_ROWS
    model = docs.sparkSession.sparkContext.broadcast({r.pattern: r.worth for r in patterns.collect()} if few else {})
    docs = docs.drop(column)
    names, places = docs.columns, "_places"
    while places in names:
        places += "_"
    out = ", ".join(f"`{c}` {t}" for c, t in docs.dtypes)
    if not few:
        found = saved(found_places(docs, patterns), "pii-places")
        found = found.select(F.col("key").alias(f"{places}_key"), F.col("places").alias(places))
        if found.count() <= BROADCAST_ROWS:
            found = F.broadcast(found)
        docs = docs.join(found, text_key() == F.col(f"{places}_key"), "left").drop(f"{places}_key")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known = model.value
        for batch in batches:
            rows = []
            joined = [None] * len(batch) if few else batch.column(places).to_pylist()
            for text, extra in zip(batch.column("text").to_pylist(), joined, strict=True):
                base, spans = all_spans(text or "", known)
                if extra:
                    spans = sorted(base + [(p["start"], 4, p["end"]) for p in extra])
                clean = text if not spans else redacted(text, spans)
                rows.append({"base": _named(base), "spans": _named(spans), "clean": clean})
            kind = pa.struct([("base", _SPANS), ("spans", _SPANS), ("clean", pa.string())])
            old = batch.columns[: len(names)]
            yield pa.RecordBatch.from_arrays([*old, pa.array(rows, kind)], [*names, column])

    return arrow_map(docs, run, f"{out}, `{column}` struct<base:{SPANS},spans:{SPANS},clean:string>")
