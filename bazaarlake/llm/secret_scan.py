"""Secrets in texts: regular expressions verified on the candidates of a trigram index.

Each rule's expression gives a Boolean query over case-folded trigrams that every match
holds. Texts are indexed in segments of bounded size, inside the task that reads them: the
postings of a segment say which of its texts hold which of the asked trigrams. A rule's
query intersects and unites postings, and the expression runs over the texts that remain.
A rule without mandatory trigrams runs over all texts of the segment.
"""

from __future__ import annotations

import re
from collections.abc import Iterable
from dataclasses import dataclass
from functools import reduce
from itertools import product
from re import _constants as kinds
from re import _parser

import numpy as np
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from bazaarlake.llm.batches import lower_ascii, with_text_columns


@dataclass(frozen=True)
class Rule:
    """Matches of ``pattern``, without overlaps from the left, whose ``group`` is long enough.

    ``any_case`` ignores the case of ASCII letters; classes such as ``\\w`` are ASCII.
    """

    kind: str
    pattern: str
    least: int = 0
    group: int = 0
    any_case: bool = False

    @property
    def flags(self) -> int:
        return re.ASCII | (re.IGNORECASE if self.any_case else 0)


# The three base rules of the query contract. A run of 32 and more hex digits
# is a whole run of them, so the least length can stand in the expression.
BASE_RULES = (
    Rule("assign", "(password|passwd|secret|token|api_?key)[\"']?\\x20*[:=]\\x20*[\"']?"
                   "([A-Za-z0-9+/_.=-]+)", 8, 2, any_case=True),
    Rule("access", "AKIA[A-Z0-9]+", 16),
    Rule("hex", "[0-9a-f]{32,}", 32),
)
# Published formats of keys and logins.
MORE_RULES = (
    Rule("github", "gh[pousr]_[A-Za-z0-9]{36,}"),
    Rule("gitlab", "glpat-[A-Za-z0-9_-]{20,}"),
    Rule("slack", "xox[abprs]-[A-Za-z0-9-]{10,}"),
    Rule("google", "AIza[A-Za-z0-9_-]{35}"),
    Rule("stripe", "[rs]k_live_[A-Za-z0-9]{16,}"),
    Rule("jwt", "eyJ[A-Za-z0-9_-]{8,}[.]eyJ[A-Za-z0-9_-]{8,}[.][A-Za-z0-9_-]+"),
    Rule("bearer", "Bearer\\x20+[A-Za-z0-9._~+/-]{20,}", any_case=True),
    Rule("private_key", "-----BEGIN\\x20[A-Z\\x20]*PRIVATE KEY-----"),
    Rule("url_login", "(?:https?|ftp|postgres|postgresql|mysql|mongodb|redis|amqp)://"
                      "[^\\x00-\\x20:@/]+:[^\\x00-\\x20:@/]+@"),
)
# Sets of strings an expression may match are kept up to this size, classes up to that one.
MOST_STRINGS, MOST_CHARS = 64, 16
# A segment's characters are turned into trigrams in pieces of this length.
PIECE = 1 << 20

# A Boolean query: True (any text), a trigram's number, or ("and" | "or", parts).
Query = bool | int | tuple


def gram(three: str) -> int:
    a, b, c = map(ord, lower_ascii(three))
    return a << 42 | b << 21 | c


def _both(parts: Iterable[Query]) -> Query:
    parts = [p for p in parts if p is not True]
    return True if not parts else parts[0] if len(parts) == 1 else ("and", parts)


def _either(parts: Iterable[Query]) -> Query:
    parts = list(parts)
    return True if True in parts else parts[0] if len(parts) == 1 else ("or", parts)


def _any_of(strings: set[str]) -> Query:
    """Some string of the set: the trigrams of one of them; supersets say nothing more."""
    grams = {frozenset(gram(s[i:i + 3]) for i in range(len(s) - 2)) for s in strings}
    least = [g for g in grams if not any(other < g for other in grams)]
    return _either(_both(sorted(g)) for g in sorted(least, key=sorted))


def _sequence(items) -> tuple[set[str] | None, Query]:
    """All strings a sequence matches (None if too many), and the query each match meets."""
    held, met, whole = {""}, [], True
    for op, arg in items:
        strings, query = _item(op, arg)
        joined = None if strings is None or len(held) * len(strings) > MOST_STRINGS else {
            a + b for a in held for b in strings}
        if joined is None:  # what stood before must occur somewhere, and so must what follows
            met += [_any_of(held), query]
            held, whole = strings or {""}, False
        else:
            held = joined
    met.append(_any_of(held))
    return (held if whole else None), _both(met)


def _item(op, arg) -> tuple[set[str] | None, Query]:
    if op is kinds.LITERAL:
        return {lower_ascii(chr(arg))}, True
    if op is kinds.IN:
        chars: set[str] = set()
        for kind, value in arg:
            low, high = value if kind is kinds.RANGE else (value, value)
            if kind not in (kinds.LITERAL, kinds.RANGE) or high - low >= MOST_CHARS:
                return None, True
            chars |= {lower_ascii(chr(c)) for c in range(low, high + 1)}
        return (chars, True) if len(chars) <= MOST_CHARS else (None, True)
    if op in (kinds.MAX_REPEAT, kinds.MIN_REPEAT, kinds.POSSESSIVE_REPEAT):
        least, most, inner = arg
        strings, query = _sequence(inner)
        if strings is not None and least <= most <= 4 and len(strings) ** most <= MOST_STRINGS:
            return {"".join(p) for n in range(least, most + 1)
                    for p in product(strings, repeat=n)}, True
        return None, (query if least else True)
    if op is kinds.SUBPATTERN:
        return _sequence(arg[-1])
    if op is kinds.ATOMIC_GROUP:
        return _sequence(arg)
    if op is kinds.BRANCH:
        found = [_sequence(x) for x in arg[1]]
        if all(s is not None for s, _ in found):
            strings = set().union(*[s for s, _ in found])
            if len(strings) <= MOST_STRINGS:
                return strings, True
        return None, _either(q for _, q in found)
    if op in (kinds.AT, kinds.ASSERT, kinds.ASSERT_NOT):
        return {""}, True
    return None, True


def trigram_query(rule: Rule) -> Query:
    """The Boolean trigram query that every text with a match of ``rule`` meets."""
    return _sequence(_parser.parse(rule.pattern, rule.flags))[1]


def asked_grams(query: Query) -> set[int]:
    if isinstance(query, tuple):
        return set().union(*map(asked_grams, query[1]))
    return set() if query is True else {query}


class TrigramIndex:
    """Postings of ``grams`` (sorted numbers) over a segment of texts."""

    def __init__(self, texts: list[str], grams: np.ndarray):
        self.size = len(texts)
        codes = np.frombuffer("\n".join(texts).encode("utf-32-le"), dtype="<u4")
        ends = np.cumsum(np.fromiter((len(t) + 1 for t in texts), np.int64, self.size))
        found = []
        for at in range(0, len(codes) - 2 if len(grams) else 0, PIECE):
            c = codes[at:at + PIECE + 2].astype(np.int64)
            c[(c >= 65) & (c <= 90)] += 32
            asked = c[:-2] << 42 | c[1:-1] << 21 | c[2:]
            place = np.searchsorted(grams, asked)
            place[place == len(grams)] = 0
            hits = np.nonzero(grams[place] == asked)[0]
            text = np.searchsorted(ends, hits + at, side="right")
            found.append(np.unique(place[hits] * self.size + text))
        pairs = np.unique(np.concatenate(found)) if found else np.zeros(0, np.int64)
        cuts = np.searchsorted(pairs, np.arange(len(grams) + 1) * self.size)
        self.postings = {int(g): pairs[a:b] - i * self.size for i, (g, a, b) in enumerate(
            zip(grams, cuts, cuts[1:]))}

    def texts_with(self, query: Query) -> np.ndarray:
        """Numbers of the texts that meet a query, in order."""
        if query is True:
            return np.arange(self.size)
        if isinstance(query, tuple):
            join = np.intersect1d if query[0] == "and" else np.union1d
            return reduce(join, map(self.texts_with, query[1]))
        return self.postings[query]


def scan_secrets(df: DataFrame, text: str, rules: Iterable[Rule] = BASE_RULES + MORE_RULES,
                 keep: list[str] | None = None) -> DataFrame:
    """Add ``secrets``, an array of (kind, start, end), and ``n_verified``.

    Places are code points, ends exclusive; the array is ordered by start, then by the
    order of ``rules``. ``n_verified`` counts the rules whose expression ran over the text,
    so it shows what the index saved. Matches of one rule do not overlap, those of
    two may. Null and empty texts hold no secret; equal texts give equal arrays; texts are
    scanned whole, whatever their length. An empty frame gives an empty one. Input
    columns of the new names are replaced, others pass through. There is no shuffle, and a
    task holds one segment of about ``batches.RUN_CHARS`` characters (or one longer text).
    """
    rules = tuple(rules)
    queries = [trigram_query(rule) for rule in rules]
    grams = np.array(sorted(set().union(*map(asked_grams, queries))), dtype=np.int64)

    def make():
        scans = [re.compile(rule.pattern, rule.flags).finditer for rule in rules]

        def compute(texts):
            texts = [t or "" for t in texts]
            index = TrigramIndex(texts, grams)
            spans = [[] for _ in texts]
            verified = np.zeros(len(texts), dtype=np.int64)
            for order, (rule, query, scan) in enumerate(zip(rules, queries, scans)):
                candidates = index.texts_with(query)
                verified[candidates] += 1
                for i in candidates.tolist():
                    for match in scan(texts[i]):
                        if len(match[rule.group]) >= rule.least:
                            spans[i].append((match.start(), order, match.end()))
            return {"secrets": [[(rules[k].kind, start, end) for start, k, end in sorted(found)]
                                for found in spans], "n_verified": verified}

        return compute

    return with_text_columns(
        df, text, "secrets array<struct<kind:string,start:int,end:int>>, n_verified int", make,
        keep)


def span_text(secrets: Column) -> Column:
    """``kind:start:end`` of each secret, joined by commas."""
    return F.array_join(F.transform(secrets, lambda s: F.concat_ws(
        ":", s["kind"], s["start"].cast("string"), s["end"].cast("string"))), ",")
