"""Alignment of a byte-level tokenizer's tokens with a piece tokenizer's.

Each text is tokenised whole by both. Where both have a token end, and both go on with a
token that begins with a space, stands an anchor; anchors cut the two sequences into short
windows of ids. The alignment inside a window depends on its ids alone, so it is worked
out once per distinct pair of id tuples and looked up afterwards.
"""

from __future__ import annotations

import hashlib
import json
import re
from array import array
from collections.abc import Callable

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from bazaarlake.llm.batches import quoted, runs, with_text_columns
from bazaarlake.session import write_and_read

# Fixed value: the expression by which byte-level pre-tokenizers cut texts.
BYTE_LEVEL = (r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+"
              r"|\s+(?!\S)|\s+")
# Runs of white space on which the fast library's expression engine gives up.
LONG_SPACE = re.compile(r"\s{10000}")
# Distinct windows a task remembers; then the table starts anew.
MOST_WINDOWS = 400_000
# Characters that are tokenised and aligned at once (or one longer text).
AT_ONCE = 1_000_000
_ADDED = ("n_a long, n_b long, n_groups long, groups_sha256 string, pairs array<int>, "
          "times array<int>")


def _byte_signs() -> dict[str, int]:
    """The character that stands for each byte in byte-level vocabularies."""
    shown = [*range(33, 127), *range(161, 173), *range(174, 256)]
    hidden = [b for b in range(256) if b not in shown]
    return {chr(b): b for b in shown} | {chr(256 + i): b for i, b in enumerate(hidden)}


class ByteTokenizer:
    """Byte-level BPE from a ``tokenizers`` file, run by ``tiktoken`` (same ids, less time).

    Raises ``ValueError`` for a file whose merges are not in the order of their ids, or that
    changes texts before it merges. Strings of special tokens are plain text.
    """

    def __init__(self, spec: bytes):
        import tiktoken

        spec = json.loads(spec)
        model, cut = spec["model"], spec["pre_tokenizer"] or {}
        signs, vocab = _byte_signs(), model["vocab"]
        special = {t["content"] for t in spec.get("added_tokens", ())}
        ranks = {bytes(map(signs.__getitem__, token)): i for token, i in vocab.items()
                 if token not in special}
        merged = [vocab["".join(m if isinstance(m, list) else m.split(" "))]
                  for m in model["merges"]]
        if (model["type"] != "BPE" or spec["normalizer"] or model.get("dropout")
                or model.get("ignore_merges") or cut.get("type") != "ByteLevel"
                or cut.get("add_prefix_space") or not cut.get("use_regex", True)
                or merged != list(range(256, 256 + len(merged))) or len(ranks) != merged[-1] + 1):
            raise ValueError("not a plain byte-level BPE file with merges in the order of ids")
        self.token_bytes = [b""] * len(ranks)
        for token, i in ranks.items():
            self.token_bytes[i] = token
        self.model = tiktoken.Encoding("bytes", pat_str=BYTE_LEVEL, mergeable_ranks=ranks,
                                       special_tokens={})
        self.spec, self.slow = json.dumps(spec), None

    def encode(self, texts: list[str]) -> list[tuple[np.ndarray, bytes]]:
        """Ids of each text and the bytes they spell."""
        found = [self.one(t) for t in texts]
        return [(ids, self.model.decode_bytes(ids.tolist())) for ids in found]

    def one(self, text: str) -> np.ndarray:
        if len(text) < 10_000 or not LONG_SPACE.search(text):
            return self.model.encode_to_numpy(text, disallowed_special=())
        if not self.slow:
            from tokenizers import Tokenizer

            self.slow = Tokenizer.from_str(self.spec)
            self.slow.encode_special_tokens = True
        return np.array(self.slow.encode(text, add_special_tokens=False).ids, dtype=np.uint32)


class PieceTokenizer:
    """A sentencepiece model; pieces stand for the bytes they decode to."""

    def __init__(self, spec: bytes):
        from sentencepiece import SentencePieceProcessor

        self.model = SentencePieceProcessor(model_proto=spec)
        self.token_bytes = []
        for i in range(self.model.get_piece_size()):
            piece = self.model.id_to_piece(i)
            hidden = self.model.is_control(i) or self.model.is_unknown(i)
            self.token_bytes.append(
                b"" if hidden else bytes([int(piece[3:5], 16)]) if self.model.is_byte(i)
                else piece.replace("▁", " ").encode())

    def encode(self, texts: list[str]) -> list[tuple[np.ndarray, bytes]]:
        """Ids of each text and the bytes they spell."""
        spelled = self.token_bytes.__getitem__
        return [(np.array(ids, dtype=np.uint32), b"".join(map(spelled, ids)))
                for ids in self.model.encode(texts, num_threads=1)]


def possible_pairs(a: list[bytes], b: list[bytes]) -> np.ndarray:
    """Codes ``a_id * len(b) + b_id`` of all pairs that can end together, sorted.

    Of two tokens over the same text with the same end, one is a suffix of the other, so
    the vocabularies bound the number of pairs, whatever the size of the corpus.
    """
    by_bytes: tuple[dict, dict] = ({}, {})
    for held, tokens in zip(by_bytes, (a, b)):
        for i, token in enumerate(tokens):
            held.setdefault(token, []).append(i)
    codes = {i * len(b) + j for i, token in enumerate(a) for at in range(len(token))
             for j in by_bytes[1].get(token[at:], ())}
    codes |= {i * len(b) + j for j, token in enumerate(b) for at in range(len(token))
              for i in by_bytes[0].get(token[at:], ())}
    return np.array(sorted(codes), dtype=np.int64)


class Aligner:
    """Groups and links of token sequences over the same bytes, window by window."""

    def __init__(self, a: list[bytes], b: list[bytes]):
        # Windows are kept packed; "H" and "I" are two and four bytes.
        self.code = "H" if max(len(a), len(b)) <= 1 << 16 else "I"
        self.lengths = [np.array(list(map(len, t)), dtype=np.int64) for t in (a, b)]
        self.marked = [np.array([x[:1] == b" " for x in t]) for t in (a, b)]
        self.shown = {sign: np.array([f"{i}{sign}" for i in range(max(len(a), len(b)))], object)
                      for sign in ",|;"}
        self.table: dict[tuple[bytes, bytes], tuple[str, bytes]] = {}

    def learn(self, keys: list[tuple[bytes, bytes]]) -> None:
        """Put windows into the table: their groups as text, the codes of their links.

        Both sides of a window have the same bytes, so laid end to end they keep in step.
        """
        a, b = (np.frombuffer(b"".join(side), dtype=self.code).astype(np.int64)
                for side in zip(*keys))
        ends_a, ends_b = (np.cumsum(n[x]) for n, x in zip(self.lengths, (a, b)))
        last_a = np.isin(ends_a, ends_b, assume_unique=True)
        last_b = np.isin(ends_b, ends_a, assume_unique=True)
        links = a[last_a] * len(self.lengths[1]) + b[last_b]
        # Each group's tokens of the first side, then its tokens of the second.
        group_a, group_b = (np.cumsum(x) - x for x in (last_a, last_b))
        after_a, after_b = (np.append(0, np.flatnonzero(x) + 1) for x in (last_a, last_b))
        text = np.empty(len(a) + len(b), dtype=object)
        text[np.arange(len(a)) + after_b[group_a]] = np.where(
            last_a, self.shown["|"][a], self.shown[","][a])
        text[np.arange(len(b)) + after_a[group_b + 1]] = np.where(
            last_b, self.shown[";"][b], self.shown[","][b])
        size = array(self.code).itemsize
        to_a, to_b = (np.cumsum([len(x) // size for x in side]) for side in zip(*keys))
        to_link = np.cumsum(last_a)[to_a - 1]
        text, packed = text.tolist(), links.tobytes()
        at = from_link = 0
        for key, until, link in zip(keys, (to_a + to_b).tolist(), (to_link * 8).tolist()):
            self.table[key] = "".join(text[at:until]), packed[from_link:link]
            at, from_link = until, link

    def windows(self, sides: list[list[np.ndarray]]) -> tuple[list[tuple[bytes, bytes]], list[int]]:
        """Id tuples between anchors, starts of marked tokens in both sequences, of all texts.

        ``sides`` are the texts' ids by each tokenizer; a text's start is an anchor too.
        The second list says which window each text begins with.
        """
        starts, marks, firsts, packed = [], [], [], []
        for n, m, ids in zip(self.lengths, self.marked, sides):
            counts = np.array(list(map(len, ids)))
            side = np.concatenate(ids)
            ends, first, mark = np.cumsum(n[side]), np.cumsum(counts) - counts, m[side]
            mark[first] = True
            starts.append(ends - n[side])
            marks.append(np.flatnonzero(mark))
            firsts.append(first)
            packed.append(side.astype(self.code).tobytes())
        # Which token of the first sequence starts at a byte with its mark.
        token_at = np.full(int(ends[-1]), -1, dtype=np.int32)
        token_at[starts[0][marks[0]]] = marks[0]
        cuts_a = token_at[starts[1][marks[1]]]
        cuts = cuts_a[cuts_a >= 0].astype(np.int64), marks[1][cuts_a >= 0]
        size = array(self.code).itemsize
        parts = []
        for side, cut in zip(packed, cuts):
            at = (cut * size).tolist()
            parts.append([side[x:y] for x, y in zip(at, [*at[1:], None])])
        keys = list(zip(*parts))
        return keys, np.searchsorted(cuts[0], firsts[0]).tolist()

    def align(self, sides: list[list[np.ndarray]]) -> list[tuple[str, np.ndarray]]:
        """Per text its groups, ``a1,a2|b1;a3|b2;``, and the codes of its links."""
        if not sides[0]:
            return []
        if len(self.table) > MOST_WINDOWS:
            self.table = {}
        keys, begins = self.windows(sides)
        found = list(map(self.table.get, keys))
        missing = [i for i, known in enumerate(found) if known is None]
        if missing:
            self.learn(list({keys[i] for i in missing}))
            for i in missing:
                found[i] = self.table[keys[i]]
        texts, codes = zip(*found)
        return [("".join(texts[x:y]), np.frombuffer(b"".join(codes[x:y]), dtype=np.int64))
                for x, y in zip(begins, [*begins[1:], None])]


def align_texts(df: DataFrame, text: str, byte_path: str, piece_path: str,
                with_groups: bool = False, keep: list[str] | None = None) -> DataFrame:
    """Tokenise and align each text: token and group counts, links, and the groups' digest.

    Adds ``n_a``, ``n_b``, ``n_groups``, ``groups_sha256``, ``pairs`` (distinct linked pairs
    as places in ``possible_pairs``) and ``times`` (links of each), and on request ``groups``
    (``a1,a2|b1;a3|b2``). A link is a pair of tokens that end at the same byte, so each group
    has one. A text that is null or empty, or that a tokenizer does not give back byte by
    byte, has no tokens: zeros, empty lists, an empty digest. Equal texts give equal
    values; texts of any length are taken whole. Input columns of these names are replaced.
    """
    byte_spec, piece_spec = (open(path, "rb").read() for path in (byte_path, piece_path))

    def make():
        a, b = ByteTokenizer(byte_spec), PieceTokenizer(piece_spec)
        aligner = Aligner(a.token_bytes, b.token_bytes)
        codes = possible_pairs(a.token_bytes, b.token_bytes)
        nothing = np.zeros(0, dtype=np.int64)

        def compute(texts):
            out = {name: [] for name in
                   ("n_a", "n_b", "n_groups", "groups_sha256", "pairs", "times", "groups")}
            texts = [t or "" for t in texts]
            for start, end in runs(texts, AT_ONCE):
                part = texts[start:end]
                sides = list(zip(a.encode([" " + t for t in part]), b.encode(part)))
                whole = [bool(t) and all(spelled == (" " + t).encode() for _, spelled in found)
                         for t, found in zip(part, sides)]
                aligned = iter(aligner.align(
                    [[x[k][0] for x, w in zip(sides, whole) if w] for k in (0, 1)]))
                for ids, w in zip(sides, whole):
                    groups, links = next(aligned) if w else ("", nothing)
                    pairs, times = np.unique(links, return_counts=True)
                    out["n_a"].append(len(ids[0][0]) if w else 0)
                    out["n_b"].append(len(ids[1][0]) if w else 0)
                    out["n_groups"].append(len(links))
                    out["groups_sha256"].append(
                        hashlib.sha256(groups[:-1].encode()).hexdigest() if w else "")
                    out["pairs"].append(np.searchsorted(codes, pairs).astype(np.int32))
                    out["times"].append(times.astype(np.int32))
                    if with_groups:
                        out["groups"].append(groups[:-1])
            return out

        return compute

    return with_text_columns(df, text, _ADDED + ", groups string" * with_groups, make, keep)


def pair_counts(aligned: DataFrame, n_pairs: int) -> np.ndarray:
    """Links of each possible pair over all rows; the driver gets one number per pair."""
    linked = aligned.select(F.explode(F.arrays_zip("pairs", "times")).alias("x")).groupBy(
        F.col("x.pairs").alias("pair")).agg(F.sum("x.times").alias("n")).toArrow()
    counts = np.zeros(n_pairs, dtype=np.int64)
    counts[linked["pair"].to_numpy()] = linked["n"].to_numpy()
    return counts


def align_tokenizers(df: DataFrame, text: str, byte_path: str, piece_path: str,
                     with_groups: bool = False, keep: list[str] | None = None) -> DataFrame:
    """``align_texts`` with ``n_links``, ``n_best`` and ``count_sum`` over the corpus's counts.

    A pair's count is how many links of the corpus hold it; ``n_best`` are a row's links
    whose count is the highest of their piece id (ties included), ``count_sum`` adds the
    counts of a row's links. The aligned rows are written once to the shared folder, so texts
    are tokenised once. Counts go to all tasks; ``possible_pairs`` bounds them by the two
    vocabularies. Without rows there are no counts and no rows.
    """
    byte_tokens, piece_tokens = (kind(open(path, "rb").read()).token_bytes for kind, path in (
        (ByteTokenizer, byte_path), (PieceTokenizer, piece_path)))
    codes = possible_pairs(byte_tokens, piece_tokens)
    taken = {"n_links", "n_best", "count_sum"}
    kept = [c for c in (df.columns if keep is None else keep) if c.lower() not in taken]
    aligned = write_and_read(_positional(align_texts(
        df, text, byte_path, piece_path, with_groups, kept)), "aligned")
    names = [f.name for f in T.StructType.fromDDL(_ADDED)] + ["groups"] * with_groups
    own = [c for c in kept if c.lower() not in names]
    at = {name: f"c{len(own) + i}" for i, name in enumerate(names)}
    counts = pair_counts(aligned.select(F.col(at["pairs"]).alias("pairs"),
                                        F.col(at["times"]).alias("times")), len(codes))
    highest = np.zeros(len(piece_tokens), dtype=np.int64)
    np.maximum.at(highest, codes % len(piece_tokens), counts)
    best = counts == highest[codes % len(piece_tokens)]
    scored = aligned.mapInArrow(_scorer(counts, best, at["pairs"], at["times"]), T.StructType(
        [*aligned.schema.fields, *T.StructType.fromDDL("n_links long, n_best long, count_sum long")]))
    shown = [*own, *names]
    return scored.select(*[F.col(f"c{i}").alias(name) for i, name in enumerate(shown)
                           if name not in ("pairs", "times")], "n_links", "n_best", "count_sum")


def _positional(df: DataFrame) -> DataFrame:
    """Names that parquet and Python tasks take, whatever the input's are."""
    return df.select(*[F.col(quoted(c)).alias(f"c{i}") for i, c in enumerate(df.columns)])


def _scorer(counts: np.ndarray, best: np.ndarray, pairs: str, times: str) -> Callable:
    def score(batches):
        for batch in batches:
            listed = batch.column(batch.schema.get_field_index(pairs))
            ends = np.concatenate([[0], np.cumsum(listed.value_lengths().to_numpy())])
            pair = listed.flatten().to_numpy()
            n = batch.column(batch.schema.get_field_index(times)).flatten().to_numpy().astype(
                np.int64)
            sums = [np.concatenate([[0], np.cumsum(values)]) for values in (
                n, n * best[pair], n * counts[pair])]
            yield pa.RecordBatch.from_arrays(
                batch.columns + [pa.array(s[ends[1:]] - s[ends[:-1]]) for s in sums],
                names=[*batch.schema.names, "n_links", "n_best", "count_sum"])

    return score
