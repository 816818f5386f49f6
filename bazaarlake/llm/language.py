"""Language identification by a small byte convolutional network, written in numpy."""

from __future__ import annotations

import re
from dataclasses import dataclass

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from bazaarlake.llm.batches import quoted, with_text_columns

WIDTHS = (2, 3, 4)
FILTERS = 12  # per width
EMBEDDING = 6
WINDOW = 256  # bytes per window
# Training takes at most so many documents of a language, and so many windows of each.
DOCS_PER_LANGUAGE = 400
WINDOWS_PER_DOC = 4
MOST_LANGUAGES = 1000  # the most frequent ones are learned
SPARE = 4  # a language's documents are thinned by hash to so many times the sample first
STEPS, BATCH, RATE = 500, 128, 0.01
UNKNOWN = "und"
_LETTER = re.compile(r"[^\W\d_]")  # signs such as ² and Ⅷ too, which are no letters


def has_letter(text: str) -> bool:
    """Whether a text has a letter in the sense of Unicode, as ``\\p{L}`` has in training."""
    return any(found[0].isalpha() for found in _LETTER.finditer(text))


@dataclass
class ByteNet:
    """Byte vectors, convolutions of several widths, max pooling, softmax."""

    languages: list[str]
    embed: np.ndarray  # 256 x EMBEDDING; byte 0 is padding
    kernel: np.ndarray  # widest * EMBEDDING x filters, zero beyond a filter's width
    bias: np.ndarray
    dense: np.ndarray
    offset: np.ndarray

    def columns(self, windows: np.ndarray) -> np.ndarray:
        """Each position with the bytes behind it: windows x positions x inputs."""
        n, length = windows.shape
        widest = self.kernel.shape[0] // EMBEDDING
        vectors = np.zeros((n, length + widest - 1, EMBEDDING), dtype=np.float32)
        vectors[:, :length] = self.embed[windows]
        view = np.lib.stride_tricks.sliding_window_view(vectors, widest, axis=1)
        return view.transpose(0, 1, 3, 2).reshape(n, length, -1)

    def pooled(self, windows: np.ndarray) -> np.ndarray:
        n = len(windows)
        inputs = self.columns(windows)
        found = inputs.reshape(-1, inputs.shape[-1]) @ self.kernel
        return np.maximum(found.reshape(n, -1, found.shape[-1]).max(axis=1) + self.bias, 0)

    def scores(self, windows: np.ndarray) -> np.ndarray:
        """Log probabilities of each window."""
        return log_softmax(self.pooled(windows) @ self.dense + self.offset)


def log_softmax(x: np.ndarray) -> np.ndarray:
    x = x - x.max(axis=1, keepdims=True)
    return x - np.log(np.exp(x).sum(axis=1, keepdims=True))


def windows_of(raw: bytes, size: int = WINDOW) -> np.ndarray:
    """All bytes in rows of ``size``; the last row is filled with zeros."""
    rows = -(-len(raw) // size)
    flat = np.zeros(rows * size, dtype=np.uint8)
    flat[:len(raw)] = np.frombuffer(raw, dtype=np.uint8)
    return flat.reshape(rows, size)


def fit_network(texts: list[str], labels: list[str], seed: int = 7) -> ByteNet:
    """Train on one window per text with Adam; the same input gives the same network."""
    languages = sorted(set(labels))
    rng = np.random.default_rng(seed)
    filters = FILTERS * len(WIDTHS)
    mask = np.zeros((max(WIDTHS) * EMBEDDING, filters), dtype=np.float32)
    for i, width in enumerate(WIDTHS):
        mask[:width * EMBEDDING, i * FILTERS:(i + 1) * FILTERS] = 1
    normal = lambda *shape: rng.normal(0, 0.3, shape).astype(np.float32)
    embed = normal(256, EMBEDDING)
    embed[0] = 0
    net = ByteNet(languages, embed, normal(*mask.shape) * mask,
                  np.zeros(filters, np.float32), normal(filters, len(languages)),
                  np.zeros(len(languages), np.float32))
    if not texts:
        return net
    data = np.concatenate([windows_of(t.encode()[:WINDOW]) for t in texts])
    target = np.array([languages.index(x) for x in labels])
    weights = [net.embed, net.kernel, net.bias, net.dense, net.offset]
    first, second = [np.zeros_like(w) for w in weights], [np.zeros_like(w) for w in weights]
    for step in range(1, STEPS + 1):
        picked = rng.integers(0, len(data), BATCH)
        x, y = data[picked], target[picked]
        inputs = net.columns(x)
        found = inputs @ net.kernel
        at = found.argmax(axis=1)  # windows x filters: where each filter is strongest
        top = np.take_along_axis(found, at[:, None], 1)[:, 0] + net.bias
        pooled = np.maximum(top, 0)
        error = np.exp(log_softmax(pooled @ net.dense + net.offset))
        error[np.arange(BATCH), y] -= 1
        error /= BATCH
        back = (error @ net.dense.T) * (top > 0)
        strongest = inputs[np.arange(BATCH)[:, None], at]  # windows x filters x inputs
        d_kernel = np.einsum("nfi,nf->if", strongest, back) * mask
        d_inputs = back[:, :, None] * net.kernel.T[None]
        d_embed = np.zeros_like(net.embed)
        padded = np.pad(x, ((0, 0), (0, max(WIDTHS) - 1)))
        for k in range(max(WIDTHS)):
            seen = np.take_along_axis(padded, at + k, 1)
            np.add.at(d_embed, seen, d_inputs[:, :, k * EMBEDDING:(k + 1) * EMBEDDING])
        d_embed[0] = 0
        for i, (w, g) in enumerate(zip(weights, (d_embed, d_kernel, back.sum(0),
                                                 pooled.T @ error, error.sum(0)))):
            first[i] += 0.1 * (g - first[i])
            second[i] += 0.01 * (g * g - second[i])
            w -= RATE * (first[i] / (1 - 0.9 ** step)
                         / (np.sqrt(second[i] / (1 - 0.99 ** step)) + 1e-8)).astype(np.float32)
    return net


def training_windows(
    df: DataFrame, text: str, lang: str, key: str, docs: int = DOCS_PER_LANGUAGE,
    windows: int = WINDOWS_PER_DOC,
) -> DataFrame:
    """Windows of at most ``docs`` documents of each language, chosen by hashed key and text.

    Columns lang, key, part, text. Windows are spread evenly over a document's
    whole length, so training sees all parts of long texts. Only the ``MOST_LANGUAGES`` most
    frequent languages are taken; documents of rarer ones teach nothing.
    """
    part = F.posexplode(F.transform(F.sequence(F.lit(0), F.lit(windows - 1)), lambda k: F.substring(
        F.col("text"), (k * F.greatest(F.lit(0), F.length("text") - WINDOW)
                        / max(windows - 1, 1)).cast("int") + 1, F.lit(WINDOW))))
    known = df.select(F.col(quoted(lang)).cast("string").alias("lang"),
                      F.col(quoted(key)).cast("string").alias("key"),
                      F.col(quoted(text)).cast("string").alias("text"))
    # At most MOST_LANGUAGES short rows, so they can go to every task.
    counts = F.broadcast(known.filter("lang IS NOT NULL").groupBy("lang").agg(
        F.count(F.lit(1)).alias("all")).orderBy(F.desc("all"), "lang").limit(MOST_LANGUAGES))
    spread = F.pmod(F.xxhash64("key", F.xxhash64("text")), F.lit(2**30))
    # Few more than asked for reach the ranking, however many tasks read the table.
    likely = known.join(counts, "lang").withColumn("spread", spread).filter(
        (F.col("spread") * F.col("all") < F.lit(SPARE * docs * 2**30))
        & F.col("text").rlike(r"\p{L}"))
    cut = likely.select("lang", "key", "spread", part.alias("part", "text"))
    order = Window.partitionBy("lang").orderBy("spread", "key", "text", "part")
    return cut.withColumn("nth", F.row_number().over(order)).filter(
        F.col("nth") <= docs * windows).select("lang", "key", "part", "text")


def fit_languages(df: DataFrame, text: str, lang: str, key: str,
                  docs: int = DOCS_PER_LANGUAGE) -> ByteNet:
    """Train on the bounded sample of ``training_windows``.

    The driver holds ``docs * WINDOWS_PER_DOC`` windows of 256 characters for each
    language, whatever the size of the data. Rows with a null language or without
    a letter teach nothing; without any row the network knows no language. Languages
    beyond the ``MOST_LANGUAGES`` most frequent are not learned, so never predicted.
    """
    rows = sorted(training_windows(df, text, lang, key, docs).collect(), key=repr)
    return fit_network([r.text for r in rows], [r.lang for r in rows])


def predict_languages(df: DataFrame, text: str, net: ByteNet,
                      keep: list[str] | None = None) -> DataFrame:
    """Add ``lang_pred`` and ``score`` (0 to 1) from all windows of each whole text.

    Log probabilities of the windows are averaged by their bytes. Null texts, texts
    without a letter, and any text under a network without languages give ``und``
    and 0. Ties go to the first language in alphabetical order.
    """
    step = 2048  # windows worked on at once

    def make():
        def compute(texts):
            known = [i for i, t in enumerate(texts) if t and net.languages and has_letter(t)]
            out = {"lang_pred": [UNKNOWN] * len(texts), "score": [0.0] * len(texts)}
            if not known:
                return out
            raw = [texts[i].encode() for i in known]
            windows = np.concatenate([windows_of(r) for r in raw])
            logs = np.concatenate([net.scores(windows[k:k + step])
                                   for k in range(0, len(windows), step)])
            logs = logs * (windows != 0).sum(axis=1, keepdims=True)
            rows = [-(-len(r) // WINDOW) for r in raw]
            starts = np.concatenate([[0], np.cumsum(rows)[:-1]])
            means = np.add.reduceat(logs, starts) / np.array([[len(r)] for r in raw])
            chance = np.exp(log_softmax(means))
            best = chance.argmax(axis=1)
            for i, doc in enumerate(known):
                out["lang_pred"][doc] = net.languages[best[i]]
                out["score"][doc] = float(chance[i, best[i]])
            return out

        return compute

    return with_text_columns(df, text, "lang_pred string, score double", make, keep)
