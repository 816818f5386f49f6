"""SentencePiece encoding and decoding through a table of distinct chunks."""

from __future__ import annotations

import hashlib
import re
from collections.abc import Iterator
from itertools import chain

from pyspark.sql import DataFrame

from bazaarlake.llm.batches import runs, with_text_columns

# A chunk is a run of word marks (a space, or the mark itself) and what follows.
_CHUNK = re.compile("[ ▁]+[^ ▁]*")
# Distinct chunks a task remembers (by characters held); then the table starts anew.
TABLE_CHARS = 8_000_000
# Texts are cut into chunks in parts of about this many characters.
PART_CHARS = 500_000


def check_model(model: bytes) -> None:
    """Raise ``ValueError`` if chunks of this model cannot be segmented one by one.

    That holds when no piece has a word mark behind another character, white space
    is kept as it is, and each text gets one mark in front.
    """
    from sentencepiece import sentencepiece_model_pb2

    proto = sentencepiece_model_pb2.ModelProto()
    proto.ParseFromString(model)
    rule = proto.normalizer_spec
    crossing = any(p.type in (1, 4) and re.search("[^▁]▁", p.piece) for p in proto.pieces)
    if (crossing or rule.precompiled_charsmap or rule.remove_extra_whitespaces
            or not rule.add_dummy_prefix or not rule.escape_whitespaces
            or proto.trainer_spec.treat_whitespace_as_suffix):
        raise ValueError("pieces of this model may cross word marks")


class ChunkTable:
    """Ids of each distinct chunk, segmented once and joined back by position."""

    def __init__(self, model: bytes):
        from sentencepiece import SentencePieceProcessor

        self.model = SentencePieceProcessor(model_proto=model)
        self.end = self.model.eos_id()
        self.held = 0
        self.ids: dict[str, list[int]] = {}
        self.shown: dict[str, str] = {}

    def learn(self, chunks: set[str]) -> None:
        if self.held > TABLE_CHARS:
            self.held, self.ids, self.shown = 0, {}, {}
        new = sorted(c for c in chunks if c not in self.ids)
        self.held += sum(map(len, new))
        # The library puts one mark before each text, which stands for the chunk's first.
        for chunk, ids in zip(new, self.model.encode([c[1:] for c in new], num_threads=1)):
            if len(chunk) == 1:
                ids = [self.model.piece_to_id("▁")]
            self.ids[chunk], self.shown[chunk] = ids, " ".join(map(str, ids))

    def encode(self, texts: list[str | None]) -> list[list[str]]:
        """The chunks of each text, all of them in the table afterwards."""
        split = [_CHUNK.findall(" " + t) if t else [] for t in texts]
        self.learn(set(chain.from_iterable(split)))
        return split

    def encode_in_parts(self, texts: list[str | None]) -> Iterator[list[str]]:
        """The same in turn, as few texts' chunks at a time as ``PART_CHARS`` hold."""
        for start, end in runs(texts, PART_CHARS):
            yield from self.encode(texts[start:end])


def encode_texts(df: DataFrame, text: str, model_path: str, with_ids: bool = False,
                 keep: list[str] | None = None) -> DataFrame:
    """Add ``n_tokens``, ``ids_sha256``, ``decoded_sha256`` (and ``ids`` on request).

    Ids are those of the library for the whole text plus one end id, without
    sampling; ``decoded_sha256`` is over the library's ``decode(ids)``. Each distinct
    chunk is segmented once per table; chunks of a text are joined by position. A
    null or empty text has the end id alone and decodes to the empty text. Repeated
    rows give repeated results, an empty frame gives an empty one; input columns of
    these names are replaced, others pass through. The model file is read on the
    driver and sent with the tasks.
    """
    with open(model_path, "rb") as file:
        model = file.read()
    check_model(model)

    def make():
        table = ChunkTable(model)
        last = str(table.end)

        def compute(texts):
            out = {"n_tokens": [], "ids_sha256": [], "decoded_sha256": [], "ids": []}
            for chunks in table.encode_in_parts(texts):
                ids = list(chain.from_iterable(map(table.ids.__getitem__, chunks)))
                ids.append(table.end)
                line = " ".join([*map(table.shown.__getitem__, chunks), last])
                out["n_tokens"].append(len(ids))
                out["ids_sha256"].append(hashlib.sha256(line.encode()).hexdigest())
                out["decoded_sha256"].append(
                    hashlib.sha256(table.model.decode(ids).encode()).hexdigest())
                if with_ids:
                    out["ids"].append(ids)
            return out

        return compute

    schema = "n_tokens long, ids_sha256 string, decoded_sha256 string"
    return with_text_columns(df, text, schema + ", ids array<int>" * with_ids, make, keep)
