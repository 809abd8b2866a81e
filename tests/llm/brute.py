"""Plain single-machine versions of the corpus operators, to compare with."""

import base64
import hashlib
import re
from collections import Counter, defaultdict


def words(text):
    return (text or "").encode().lower().split()


def shingles(text, width=5):
    own = words(text)
    return {tuple(own[i : i + width]) for i in range(max(1, len(own) - width + 1))} if own else set()


def components(docs):
    """{doc_id: (size, smallest reachable doc_id)} for distinct doc_ids."""
    sets = {i: shingles(t) for i, t in docs}
    holders = defaultdict(list)
    for i, own in sets.items():
        for s in own:
            holders[s].append(i)
    parent = {i: i for i in sets}

    def find(i):
        while parent[i] != i:
            i = parent[i]
        return i

    for i, own in sets.items():
        common = Counter(j for s in own for j in holders[s] if j < i)
        for j, n in common.items():
            if 100 * n >= 75 * (len(own) + len(sets[j]) - n):
                a, b = find(i), find(j)
                parent[max(a, b)] = min(a, b)
    return {i: (len(s), find(i)) for i, s in sets.items()}


def repeats(docs, length=50):
    """{doc_id: (spans, kept bytes)} for distinct doc_ids."""
    seen, out = set(), {}
    for i, text in sorted(docs):
        data = (text or "").encode()
        cut = bytearray(len(data))
        own = [data[p : p + length] for p in range(len(data) - length + 1)]
        for p, window in enumerate(own):
            if window in seen:
                cut[p : p + length] = b"\1" * length
        seen.update(own)
        spans = [m.span() for m in re.finditer(b"\1+", bytes(cut))]
        out[i] = (spans, bytes(b for b, c in zip(data, cut) if not c))
    return out


def edited(docs):
    """{doc_id: edited text} by descending doc_id."""
    order = sorted(((i, t or "") for i, t in docs), reverse=True)
    out = {}
    for k, (i, text) in enumerate(order):
        m = len(text) // 3
        out[i] = text[: len(text) - m] + order[(k + 1) % len(order)][1][:m]
    return out


FORMS = (
    r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+",
    r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)",
    r"[0-9]([\x20-]?[0-9])+",
    r"\+[0-9][\x20().0-9-]+[0-9]",
)


def luhn(digits):
    doubled = [int(d) * (1 + k % 2) for k, d in enumerate(reversed(digits))]
    return sum(d // 10 + d % 10 for d in doubled) % 10 == 0


def fixed_forms(text):
    out = []
    for kind, form in enumerate(FORMS):
        for m in re.finditer(form, text):
            digits = re.sub("[^0-9]", "", m.group())
            passes = (
                True,
                kind == 1 and all(int(p) <= 255 for p in m.group().split(".")),
                14 <= len(digits) <= 19 and luhn(digits),
                10 <= len(digits) <= 15,
            )
            if passes[kind]:
                out.append((m.start(), kind, m.end()))
    return sorted(out)


def digest32(data):
    return base64.b32encode(hashlib.sha1(data).digest()).decode()
