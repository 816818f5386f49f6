"""Spelling variants: words one edit apart, found with bidirectional FM-indexes.

A word and a near word (one code point inserted, deleted or replaced) agree exactly in the
word's left half or in its right half. The search scheme matches one half exactly and
extends across the other with one error, as intervals of suffix ranks over the delimited
vocabulary. The vocabulary is kept twice in ranges of bounded size, ordered by its words and
by its reversed words, so that a half leads to the few ranges that can hold its matches.
"""

from __future__ import annotations

import math
from bisect import bisect_left
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from bazaarlake.llm.batches import quoted
from bazaarlake.session import write_and_read

# Words of a range, and at most as many searches in it per task.
RANGE_WORDS = 20_000
# Searches that go through the index at once.
AT_ONCE = 4096
BLOCK = 16
PREFIX, SUFFIX = 0, 1


def suffix_array(text: np.ndarray) -> np.ndarray:
    """Starts of the suffixes in order, by doubling the compared length."""
    rank = text.astype(np.int64)
    step = 1
    while True:
        after = np.zeros(len(text), dtype=np.int64)
        after[:-step or None] = rank[step:] + 1
        key = rank * (int(rank.max()) + 2) + after
        order = np.argsort(key, kind="stable")
        rank = np.zeros(len(text), dtype=np.int64)
        rank[order[1:]] = np.cumsum(key[order[1:]] != key[order[:-1]])
        step *= 2
        if rank[order[-1]] == len(text) - 1 or step >= len(text):
            return order


class Ranks:
    """Occurrences of each sign before a place of the Burrows-Wheeler transform of a text."""

    def __init__(self, text: np.ndarray, signs: int, order: np.ndarray):
        blocks = len(text) // BLOCK + 1
        self.rows = np.full((blocks, BLOCK), signs, dtype=np.int32)
        self.rows.ravel()[:len(text)] = text[order - 1]
        counts = np.stack([(self.rows == c).sum(1) for c in range(signs)], axis=1)
        self.before = np.cumsum(counts, axis=0) - counts
        self.smaller = np.cumsum(self.before, axis=1) - self.before
        self.first = np.cumsum(counts.sum(0)) - counts.sum(0)
        self.signs = signs

    def _part(self, place: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        block = place // BLOCK
        return block, self.rows[block], np.arange(BLOCK) < (place % BLOCK)[:, None]

    def of(self, sign: np.ndarray, place: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """How often ``sign``, and how often smaller signs, stand before ``place``."""
        block, rows, inside = self._part(place)
        sign = sign[:, None]
        return (self.before[block, sign[:, 0]] + ((rows == sign) & inside).sum(1),
                self.smaller[block, sign[:, 0]] + ((rows < sign) & inside).sum(1))

    def all(self, place: np.ndarray) -> np.ndarray:
        """How often each sign stands before each place."""
        block, rows, inside = self._part(place)
        cells = (np.arange(len(place))[:, None] * self.signs + rows)[inside]
        return self.before[block] + np.bincount(
            cells, minlength=len(place) * self.signs).reshape(-1, self.signs)


class FMIndex:
    """Bidirectional index of ``|word|word|..|``; sign 0 is the delimiter.

    A state is (search, place in its pattern, first rank in the index that the direction
    extends, first rank in the other one, size); both intervals are kept in step.
    """

    def __init__(self, words: list[str]):
        lengths = np.array(list(map(len, words)), dtype=np.int64)
        marks = np.concatenate([[0], np.cumsum(lengths + 1)])
        letters = np.frombuffer("".join(words).encode("utf-32-le"), dtype="<u4")
        self.alphabet = np.unique(letters)
        text = np.zeros(int(marks[-1]) + 1, dtype=np.int64)
        inside = np.ones(len(text), dtype=bool)
        inside[marks] = False
        text[inside] = np.searchsorted(self.alphabet, letters) + 1
        order, back = suffix_array(text), suffix_array(text[::-1])
        signs = len(self.alphabet) + 1
        self.size = len(text)
        self.forward = Ranks(text, signs, order)
        self.backward = Ranks(text[::-1], signs, back)
        # Suffixes that begin with a delimiter come first; which word follows each?
        self.word_at = np.searchsorted(marks, order[:len(marks)])

    def signs_of(self, text: str) -> np.ndarray:
        """Signs of a text's letters; -1 for letters that the index does not have."""
        letters = np.frombuffer(text.encode("utf-32-le"), dtype="<u4")
        at = np.minimum(np.searchsorted(self.alphabet, letters), len(self.alphabet) - 1)
        return np.where(self.alphabet[at] == letters, at + 1, -1)

    def near(self, words: list[str], side: int) -> tuple[np.ndarray, np.ndarray]:
        """(number in ``words``, number of an indexed word) of pairs that are near.

        ``PREFIX`` finds those whose left half is exactly there, ``SUFFIX`` those whose
        right half is: the half is matched from the word's end inwards, the rest with one
        error. No pair comes twice.
        """
        found = [self._near(words[i:i + AT_ONCE], side) for i in range(0, len(words), AT_ONCE)]
        return (np.concatenate([q + i * AT_ONCE for i, (q, _) in enumerate(found)]),
                np.concatenate([w for _, w in found]))

    def _near(self, words, side):
        ranks = self.backward if side == PREFIX else self.forward
        keys = words if side == PREFIX else [w[::-1] for w in words]
        lengths = np.array(list(map(len, words)), dtype=np.int64)
        halves = lengths // 2 if side == PREFIX else lengths - lengths // 2
        starts = np.cumsum(lengths) - lengths
        pattern = np.append(self.signs_of("".join(keys)), -2)

        def sign_at(search, place):  # -2 behind the end
            return pattern[np.where(place < lengths[search], starts[search] + place, -1)]

        def extend(state, sign):
            known = sign >= 0
            search, place, low, other, size = (x[known] for x in state)
            sign = sign[known]
            (at, less), (end, more) = ranks.of(sign, low), ranks.of(sign, low + size)
            alive = end > at
            return tuple(x[alive] for x in (
                search, place + 1, ranks.first[sign] + at, other + more - less, end - at))

        def match(state, stop):
            done = []
            while len(state[0]):
                ready = state[1] == stop[state[0]]
                done.append(tuple(x[ready] for x in state))
                state = tuple(x[~ready] for x in state)
                state = extend(state, sign_at(state[0], state[1]))
            return joined(done)

        def joined(states):
            return tuple(np.concatenate(x) for x in zip(*states)) if states else (
                tuple(np.zeros((5, 0), dtype=np.int64)))

        numbers = np.arange(len(words))
        state = extend((numbers, numbers * 0 - 1, numbers * 0, numbers * 0,
                        np.full(len(words), self.size)), numbers * 0)
        exact, found = match(state, halves), []
        while len(exact[0]):
            search, place, low, other, size = exact
            at, end = ranks.all(low), ranks.all(low + size)
            counts = end - at
            less = np.cumsum(counts, axis=1) - counts
            row, sign = np.nonzero(counts)
            child = (search[row], place[row] + 1, ranks.first[sign] + at[row, sign],
                     other[row] + less[row, sign], counts[row, sign])
            wanted = sign_at(search, place)
            wrong = (sign != wanted[row]) & (sign != 0)
            replaced = tuple(x[wrong & (wanted[row] != -2)] for x in child)
            added = tuple(x[wrong] for x in child)
            # In a run of equal letters only the last may be missing, one added only behind it.
            missing = (wanted != -2) & (sign_at(search, place + 1) != wanted)
            ended = match(joined([
                replaced, (added[0], added[1] - 1, *added[2:]),
                (search[missing], place[missing] + 1, low[missing], other[missing],
                 size[missing])]), lengths)
            found.append(extend(ended, ended[0] * 0))
            exact = tuple(x[sign == wanted[row]] for x in child)
        search, _, low, other, _ = joined(found)
        return search, self.word_at[other if side == PREFIX else low]


def near_in_range(words: list[str], counts: np.ndarray, asked: list[str], side: int):
    """Number of near words of each asked word, and the one of largest count (ties smallest).

    Pairs that both sides find belong to ``PREFIX``. Returns (asked, n_near, n, word) rows.
    """
    order = sorted(range(len(words)), key=words.__getitem__)
    words, counts = [words[i] for i in order], counts[order]
    search, found = FMIndex(words).near(asked, side)
    if side == SUFFIX:
        halves = [len(w) // 2 for w in asked]
        new = np.array([asked[q][:halves[q]] != words[w][:halves[q]]
                        for q, w in zip(search.tolist(), found.tolist())], dtype=bool)
        search, found = search[new], found[new]
    best = np.lexsort((found, -counts[found], search))
    first = np.nonzero(np.diff(search[best], prepend=-1))[0]
    best, near = best[first], np.diff(np.append(first, len(best)))
    return ([asked[q] for q in search[best].tolist()], near, counts[found[best]],
            [words[w] for w in found[best].tolist()])


def word_counts(df: DataFrame, text: str, pattern: str, change=None) -> DataFrame:
    """(word, n) of all matches of ``pattern`` in whole texts, A-Z lower-cased.

    ``change`` turns the column of matches into the words to count. Null and empty
    texts have none. Counts are added up before the shuffle.
    """
    upper = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"
    runs = df.select("*", F.explode(F.regexp_extract_all(
        F.col(quoted(text)), F.lit(pattern), F.lit(0))).alias("__run"))
    run = F.translate("__run", upper, upper.lower())
    return runs.select((change(run) if change else run).alias("word")).groupBy("word").agg(
        F.count(F.lit(1)).alias("n"))


def _ranges(words: DataFrame, side: int, n_ranges: int) -> DataFrame:
    key = F.col("word") if side == PREFIX else F.reverse("word")
    placed = words.repartitionByRange(n_ranges, key)
    return write_and_read(placed.select(
        F.lit(side).alias("side"), F.spark_partition_id().alias("range"), key.alias("key"),
        "word", "n"), f"words-{side}")


def _asked(words: DataFrame, bounds: dict[int, list[tuple]], parts: dict[tuple, int]) -> DataFrame:
    """Rows (side, range, part, word): the ranges that can hold a word's exact half."""

    def route(batches: Iterator[pa.RecordBatch]):
        import xxhash

        lows = {side: [low for _, low, _ in found] for side, found in bounds.items()}
        highs = {side: [high for *_, high in found] for side, found in bounds.items()}
        for batch in batches:
            rows: list[list] = [[], [], [], []]
            for word in batch.column(0).to_pylist():
                for side in (PREFIX, SUFFIX):
                    cut = len(word) // 2
                    half = word[:cut] if side == PREFIX else word[cut:][::-1]
                    last = bisect_left(lows[side], half + chr(0x10FFFF))
                    for i in range(bisect_left(highs[side], half), last):
                        number = bounds[side][i][0]
                        part = xxhash.xxh32_intdigest(word) % parts.get((side, number), 1)
                        for column, value in zip(rows, (side, number, part, word)):
                            column.append(value)
            yield pa.RecordBatch.from_arrays(
                [*[pa.array(x, pa.int32()) for x in rows[:3]], pa.array(rows[3], pa.string())],
                names=["side", "range", "part", "word"])

    return words.select("word").mapInArrow(route, "side int, range int, part int, word string")


def near_words(words: DataFrame, range_words: int = RANGE_WORDS) -> DataFrame:
    """(word, n_near, best_n, best) of the words of a written (word, n) table with near words.

    Ranges hold about ``range_words`` words; the driver gets their first and last words
    and counts. A range with more searches than that (a half that very many words
    share) is copied to several tasks, each with a part of the searches.
    """
    spark = words.sparkSession
    n_ranges = max(1, math.ceil(words.count() / range_words))
    sides = [_ranges(words, side, n_ranges) for side in (PREFIX, SUFFIX)]
    placed = sides[0].unionByName(sides[1])
    bounds: dict[int, list[tuple]] = {PREFIX: [], SUFFIX: []}
    for row in placed.groupBy("side", "range").agg(
            F.min("key").alias("low"), F.max("key").alias("high")).orderBy("low").collect():
        bounds[row["side"]].append((row["range"], row["low"], row["high"]))
    parts = {(r["side"], r["range"]): math.ceil(r["count"] / range_words) for r in
             _asked(words, bounds, {}).groupBy("side", "range").count().collect()}
    copies = spark.createDataFrame(
        [(*place, n) for place, n in parts.items()], "side int, range int, parts int")
    held = placed.join(copies, ["side", "range"]).select(
        "side", "range", F.explode(F.sequence(F.lit(0), F.col("parts") - 1)).alias("part"),
        "word", "n")
    # As many partitions as groups, however small: the work is not in the bytes.
    tasks, place = max(1, sum(parts.values())), ["side", "range", "part"]

    def search(key, indexed: pa.Table, asked: pa.Table) -> pa.Table:
        names, near, best_n, best = near_in_range(
            indexed["word"].to_pylist(), indexed["n"].to_numpy(), asked["word"].to_pylist(),
            key[0].as_py())
        return pa.table({"word": pa.array(names, pa.string()), "n_near": pa.array(near, pa.int64()),
                         "best_n": pa.array(best_n, pa.int64()),
                         "best": pa.array(best, pa.string())})

    found = held.repartition(tasks, *place).groupBy(*place).cogroup(
        _asked(words, bounds, parts).repartition(tasks, *place).groupBy(*place)).applyInArrow(
        search, "word string, n_near long, best_n long, best string")
    best = F.min(F.struct((-F.col("best_n")).alias("order"), F.col("best").alias("best")))
    return found.groupBy("word").agg(F.sum("n_near").alias("n_near"), best.alias("b")).select(
        "word", "n_near", (-F.col("b.order")).alias("best_n"), "b.best")


def spelling_variants(words: DataFrame, word: str = "word", n: str = "n", ratio: int = 5,
                      least_length: int = 6, least_count: int = 1,
                      range_words: int = RANGE_WORDS) -> DataFrame:
    """(word, form, root, n, n_near, form_n): words grouped under their common spellings.

    Two words are near if one edit of a code point turns one into the other. A word's form
    is its near word of largest count (ties: smallest in code-point order) if that is
    ``ratio`` times the word's or more; the root is where forms lead in the end, the word itself
    where it has none. Rows of one word are added up; null words, words under ``least_length``
    (2 at least) and words seen under ``least_count`` times take no part. ``ratio`` is 2 or
    more, so that chains of forms are as short as the logarithm of the counts. No words
    give no rows; columns other than the two are not carried, as rows stand for words.
    """
    if ratio < 2 or least_length < 2:
        raise ValueError("ratio and least_length must be 2 or more")
    vocabulary = write_and_read(words.select(
        F.col(quoted(word)).cast("string").alias("word"), F.col(quoted(n)).cast("long").alias("n")
    ).filter(F.length("word") >= least_length).groupBy("word").agg(F.sum("n").alias("n")).filter(
        F.col("n") >= least_count), "vocabulary")
    near = near_words(vocabulary, range_words)
    none = [F.lit(0).cast("long").alias("n_near"), F.lit(None).cast("long").alias("best_n"),
            F.lit(None).cast("string").alias("best")]
    judged = vocabulary.select("word", "n", *none).unionByName(
        near.select("word", F.lit(None).cast("long").alias("n"), "n_near", "best_n", "best")
    ).groupBy("word").agg(*[F.max(c).alias(c) for c in ("n", "n_near", "best_n", "best")])
    common = F.col("best_n") >= ratio * F.col("n")
    formed = write_and_read(judged.select(
        "word", "n", "n_near", F.when(common, F.col("best")).alias("form"),
        F.when(common, F.col("best_n")).alias("form_n")), "formed")
    return formed.join(_roots(formed, ratio), "word", "left").select(
        "word", "form", F.coalesce("root", "word").alias("root"), "n", "n_near", "form_n")


def _roots(formed: DataFrame, ratio: int) -> DataFrame:
    """(word, root) of words with a form: each round doubles the steps that a row has gone."""
    links = formed.filter("form IS NOT NULL").select("word", F.col("form").alias("root"))
    most = formed.agg(F.max("form_n")).first()[0] or 1
    for _ in range(math.ceil(math.log2(max(1.0, math.log(most, ratio) + 1)))):
        links = write_and_read(links, "roots")
        onward = links.select(F.col("word").alias("root"), F.col("root").alias("next"))
        links = links.join(onward, "root", "left").select(
            "word", F.coalesce("next", "root").alias("root"))
    return links


def drop_code_point(run: Column, at: Column) -> Column:
    """``run`` without its code point ``at`` (from 0)."""
    return F.concat(run.substr(F.lit(1), at), run.substr(at + 2, F.length(run)))
