"""Quality by compression: texts that shrink too much or too little are rejected."""

from __future__ import annotations

import math
import re

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from bazaarlake.llm.batches import WORD, with_text_columns

SYMBOLS = "#*$%&|<>"
CHUNK_BYTES = 4096
LEVEL = 3
# (from this many UTF-8 bytes on, least ratio, greatest ratio) of raw to compressed
# size. Short texts hardly shrink, so the bounds widen with length. These hold where a
# corpus is too small to learn from.
WHOLE_BANDS = ((0, 0.0, 2.6), (256, 1.05, 3.2), (1024, 1.25, 3.8), (4096, 1.4, 4.5),
               (16384, 1.5, 5.0))
CHUNK_BANDS = ((0, 0.0, 2.6), (256, 1.05, 3.4), (1024, 1.2, 4.2), (4096, 1.3, 5.0))
# Learned bounds: bands begin at powers of two, and neighbours join until a band has
# BAND_VALUES ratios. Fences lie so many quartile distances beyond the quartiles (Tukey's inner
# ones for texts, the outer ones for chunks, of which a long text has many), at least
# LEAST_SPREAD, all on the logarithm of the ratio.
LEAST_TEXTS, BAND_VALUES = 500, 100
WHOLE_FENCE, CHUNK_FENCE, LEAST_SPREAD = 1.5, 3.0, 0.05
FIRST_BAND, LAST_BAND = 6, 24  # 64 bytes, 16 MB
BINS = 1000  # per unit of the logarithm
# Odd 64-bit multipliers of the five words of a window.
_MIX = np.array([0x9E3779B97F4A7C15, 0xC2B2AE3D27D4EB4F, 0x165667B19E3779F9,
                 0xD6E8FEB86659FD93, 0xA0761D6478BD642F], dtype=np.uint64)


def repeated_words(words: list[str]) -> int:
    """Words inside 5-word windows that occur twice or more, the first included."""
    n = len(words) - 4
    if n < 2:
        return 0
    numbers: dict[str, int] = {}
    ids = np.array([numbers.setdefault(w, len(numbers) + 1) for w in words], dtype=np.uint64)
    if len(numbers) == len(words):
        return 0
    windows = sum(ids[k:k + n] * _MIX[k] for k in range(5))
    order = np.argsort(windows, kind="stable")
    same = windows[order][1:] == windows[order][:-1]
    if not same.any():
        return 0
    steps = np.zeros(len(words) + 1, dtype=np.int64)
    hit = np.zeros(n, dtype=bool)
    hit[order[1:][same]] = hit[order[:-1][same]] = True
    np.add.at(steps, np.nonzero(hit)[0], 1)
    np.add.at(steps, np.nonzero(hit)[0] + 5, -1)
    return int((np.cumsum(steps)[:-1] > 0).sum())


def repeated_lines(text: str) -> int:
    """Lines with a word that equal an earlier line."""
    lines = [line for line in text.split("\n") if line and WORD.search(line)]
    return len(lines) - len(set(lines))


def band(size: int, bands) -> tuple[float, float]:
    """Bounds of the last band that starts at or below ``size``."""
    return next((low, high) for start, low, high in reversed(bands) if size >= start)


class Compressor:
    def __init__(self, level: int, chunk_bytes: int, whole, chunks):
        import zstandard

        self.shrink = zstandard.ZstdCompressor(level=level, write_content_size=False).compress
        self.chunk_bytes, self.whole, self.chunks = chunk_bytes, whole, chunks

    def ratios(self, text: str) -> tuple[float, float, float, bool]:
        """Ratio of the whole text, least and greatest ratio of its chunks, all in band.

        Chunks have ``chunk_bytes`` bytes; what is left at the end is a chunk too and
        is judged by the band of its own length.
        """
        raw = text.encode()
        if not raw:
            return 0.0, 0.0, 0.0, True
        whole = len(raw) / len(self.shrink(raw))
        low, high = band(len(raw), self.whole)
        fine, least, most = low <= whole <= high, whole, whole
        if len(raw) > self.chunk_bytes:
            least, most = float("inf"), 0.0
            for at in range(0, len(raw), self.chunk_bytes):
                piece = raw[at:at + self.chunk_bytes]
                ratio = len(piece) / len(self.shrink(piece))
                low, high = band(len(piece), self.chunks)
                fine = fine and low <= ratio <= high
                least, most = min(least, ratio), max(most, ratio)
        return whole, least, most, fine


def _bin(size: int, ratio: float, chunk: int) -> int:
    """Kind, band and rounded logarithm of a ratio as one number."""
    power = min(max(size.bit_length() - 1, FIRST_BAND - 1), LAST_BAND)
    return (chunk << 32) + (power << 20) + (round(math.log(ratio) * BINS) + (1 << 19))


def _fences(counts: dict[int, dict[int, int]], fence: float):
    """Bands from counts of rounded logarithms by power of two, longest texts first."""
    bands, held, start = [], {}, 0
    for power in sorted(counts, reverse=True):
        for value, n in counts[power].items():
            held[value] = held.get(value, 0) + n
        start = 0 if power < FIRST_BAND else 1 << power
        if sum(held.values()) >= BAND_VALUES:
            bands.append((start, held))
            held = {}
    if held and bands:  # too few short texts join the band above them
        above, values = bands.pop()
        bands.append((start, {v: values.get(v, 0) + held.get(v, 0) for v in {*values, *held}}))
    out = []
    for start, values in reversed(bands):
        ordered, total, quartiles = sorted(values), sum(values.values()), []
        for share in (1, 3):
            passed = 0
            for value in ordered:
                passed += values[value]
                if 4 * passed >= share * total:
                    quartiles.append(value / BINS)
                    break
        low, high = quartiles
        spread = max(fence * (high - low), LEAST_SPREAD)
        out.append((start, math.exp(low - spread), math.exp(high + spread)))
    return tuple([(0, *out[0][1:]), *out[1:]]) if out else None


def learn_bands(df: DataFrame, text: str, level: int = LEVEL, chunk_bytes: int = CHUNK_BYTES):
    """(whole_bands, chunk_bands) for ``compression_rules`` from all texts of a corpus.

    The quartiles of the ratios of each length band, exact to 1/``BINS``, set its bounds, so
    less than a quarter of junk on either side cannot move them far. Equal texts count
    once. Null and empty texts teach nothing. A corpus of fewer than ``LEAST_TEXTS``
    distinct texts, or without chunks, keeps the fixed bounds. The driver gets counts
    of rounded ratios, whose number does not grow with the corpus.
    """
    def make():
        import xxhash

        zstd = Compressor(level, chunk_bytes, WHOLE_BANDS, CHUNK_BANDS)

        def compute(texts):
            out = {"digest": [], "bins": []}
            for text in texts:
                raw = (text or "").encode()
                found = []
                if raw:
                    found.append(_bin(len(raw), len(raw) / len(zstd.shrink(raw)), 0))
                if len(raw) > chunk_bytes:
                    for at in range(0, len(raw), chunk_bytes):
                        piece = raw[at:at + chunk_bytes]
                        found.append(_bin(len(piece), len(piece) / len(zstd.shrink(piece)), 1))
                out["digest"].append(xxhash.xxh3_128_hexdigest(raw))
                out["bins"].append(found)
            return out

        return compute

    texts = with_text_columns(df, text, "digest string, bins array<long>", make, keep=[])
    counted = texts.dropDuplicates(["digest"]).select(F.explode("bins").alias("bin")).groupBy(
        "bin").agg(F.count(F.lit(1)).alias("n"))
    counts: tuple[dict, dict] = ({}, {})
    for row in counted.collect():
        kind, power = row["bin"] >> 32, row["bin"] >> 20 & 0xFFF
        counts[kind].setdefault(power, {})[(row["bin"] & 0xFFFFF) - (1 << 19)] = row["n"]
    if sum(sum(x.values()) for x in counts[0].values()) < LEAST_TEXTS:
        return WHOLE_BANDS, CHUNK_BANDS
    return (_fences(counts[0], WHOLE_FENCE) or WHOLE_BANDS,
            _fences(counts[1], CHUNK_FENCE) or CHUNK_BANDS)


def compression_rules(
    df: DataFrame, text: str, level: int = LEVEL, chunk_bytes: int = CHUNK_BYTES,
    whole_bands=WHOLE_BANDS, chunk_bands=CHUNK_BANDS, keep: list[str] | None = None,
) -> DataFrame:
    """Add word, symbol, line and window counts, zstandard ratios and a verdict.

    ``base_failed``: under 10 words, or over a fifth of the words stand in 5-word
    windows that repeat. ``kept``: not so, and the ratios of the whole text and of
    each of its fixed chunks lie in the band of their length. Null and empty texts have
    no words, so they fail; ``learn_bands`` gives bands that fit a corpus; equal texts get equal verdicts; texts of any length are
    taken whole. Input columns of these names are replaced, others pass through.
    """
    def make():
        zstd = Compressor(level, chunk_bytes, whole_bands, chunk_bands)

        def compute(texts):
            out = {k: [] for k in names}
            for text in texts:
                text = text or ""
                words = WORD.findall(text)
                repeats = repeated_words(words)
                whole, least, most, fine = zstd.ratios(text)
                failed = len(words) < 10 or 100 * repeats > 20 * len(words)
                for name, value in zip(names, (
                        len(words), sum(map(len, words)), sum(map(text.count, SYMBOLS)),
                        repeated_lines(text), repeats, whole, least, most, failed,
                        fine and not failed)):
                    out[name].append(value)
            return out

        return compute

    schema = ("n_words long, word_chars long, n_symbols long, n_dup_lines long, "
              "n_repeat_words long, ratio double, chunk_ratio_min double, "
              "chunk_ratio_max double, base_failed boolean, kept boolean")
    names = re.findall(r"(\w+) (?:long|double|boolean)", schema)
    return with_text_columns(df, text, schema, make, keep)
