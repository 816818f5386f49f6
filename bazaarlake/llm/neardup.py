"""Near-duplicate components by one-permutation MinHash, banded buckets and star edges."""

from __future__ import annotations

from collections import OrderedDict

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from bazaarlake.llm.batches import WORD, lower_ascii, quoted, with_text_columns
from bazaarlake.session import write_and_read

WORDS = 5  # per shingle
BANDS, ROWS = 32, 7  # a pair at 0.85 shares no band with a chance of 4e-6
MISSED = 5e-6  # greatest chance to miss a pair at the threshold, which sets the rows of a band
SKETCH_WORDS = 16  # of 64 bits, in a document's bitmap of shingles
# Buckets with more unlinked members first drop those that provably link to nobody.
CROWDED = 50
# Remaining pairs meet at once when there are at most so many for each document. Few of
# them pass their bitmaps and have their texts compared.
PAIRS_PER_DOC = 32
CENTERS = 32  # of a bucket in each later round
WORD_TABLE = 500_000
_EMPTY = np.uint64(2**64 - 1)


class WordHashes(dict):
    """64-bit hash of each word, remembered up to a bound."""

    def __missing__(self, word: str) -> int:
        import xxhash

        if len(self) > WORD_TABLE:
            self.clear()
        value = self[word] = xxhash.xxh64_intdigest(word)
        return value


def shingle_hashes(text: str | None, words: WordHashes) -> np.ndarray:
    """Sorted 64-bit hashes of a text's distinct shingles.

    Shingles are five consecutive words after lower-casing A-Z; a text with fewer words
    is one shingle, one without words none.
    """
    found = WORD.findall(lower_ascii(text)) if text else []
    if not found:
        return np.zeros(0, dtype=np.uint64)
    hashes = np.array(list(map(words.__getitem__, found)), dtype=np.uint64)
    length = min(WORDS, len(hashes))
    n = len(hashes) - length + 1
    mixed = np.full(n, length, dtype=np.uint64)
    for k in range(length):
        mixed = (mixed ^ (mixed >> np.uint64(29))) * np.uint64(0xBF58476D1CE4E5B9)
        mixed += hashes[k:k + n]
    mixed = (mixed ^ (mixed >> np.uint64(31))) * np.uint64(0x94D049BB133111EB)
    return np.unique(mixed ^ (mixed >> np.uint64(30)))


class OnePermutation:
    """One hash per shingle, its smallest value in each bin, empty bins filled from others.

    An empty bin takes the value of the first filled one in its own fixed random
    order of bins (optimal densification), so two sets that agree there agree here.
    """

    def __init__(self, bands: int = BANDS, rows: int = ROWS, seed: int = 11):
        rng = np.random.default_rng(seed)
        self.bands, self.bins = bands, bands * rows
        self.probes = rng.integers(0, self.bins, (1024, self.bins))
        self.odd = rng.integers(0, 2**63, rows, dtype=np.uint64) * np.uint64(2) + np.uint64(1)

    def signature(self, shingles: np.ndarray) -> np.ndarray:
        values = np.full(self.bins, _EMPTY, dtype=np.uint64)
        bins = ((shingles >> np.uint64(32)) * np.uint64(self.bins)) >> np.uint64(32)
        mixed = (shingles ^ (shingles >> np.uint64(33))) * np.uint64(0xC4CEB9FE1A85EC53)
        np.minimum.at(values, bins.astype(np.int64), mixed)
        empty = np.nonzero(values == _EMPTY)[0]
        if len(empty) == 0:
            return values
        filled = values.copy()
        for probe in self.probes:
            filled[empty] = values[probe[empty]]
            empty = empty[filled[empty] == _EMPTY]
            if len(empty) == 0:
                return filled
        filled[empty] = values[np.argmax(values != _EMPTY)]
        return filled

    def band_hashes(self, shingles: np.ndarray) -> np.ndarray:
        rows = self.signature(shingles).reshape(self.bands, -1)
        mixed = (rows * self.odd).sum(axis=1, dtype=np.uint64)
        return ((mixed ^ (mixed >> np.uint64(32))) * np.uint64(0xFF51AFD7ED558CCD)).view(np.int64)


def band_rows(percent: int, bands: int = BANDS) -> int:
    """The most rows of a band (one at least) that keep the chance to miss a pair small."""
    rows = 1
    while rows < 64 and (1 - (percent / 100) ** (rows + 1)) ** bands <= MISSED:
        rows += 1
    return rows


def bitmap(shingles: np.ndarray) -> np.ndarray:
    """Bits named by the shingles' lowest bits, as signed 64-bit words."""
    bits = np.zeros(64 * SKETCH_WORDS, dtype=np.uint8)
    bits[(shingles % np.uint64(64 * SKETCH_WORDS)).astype(np.int64)] = 1
    return np.packbits(bits).view(np.int64)


def signatures(docs: DataFrame, text: str, rows: int = ROWS) -> DataFrame:
    """Add n_shingles, set_hash (of the whole shingle set), bands and sketch (a bitmap).

    All but the size are null for texts without words.
    """
    def make():
        import xxhash

        words, permutation = WordHashes(), OnePermutation(rows=rows)

        def compute(texts):
            out = {"n_shingles": [], "set_hash": [], "bands": [], "sketch": []}
            for text in texts:
                shingles = shingle_hashes(text, words)
                out["n_shingles"].append(len(shingles))
                out["set_hash"].append(
                    xxhash.xxh3_128_hexdigest(shingles.tobytes()) if len(shingles) else None)
                out["bands"].append(
                    permutation.band_hashes(shingles) if len(shingles) else None)
                out["sketch"].append(bitmap(shingles) if len(shingles) else None)
            return out

        return compute

    return with_text_columns(
        docs, text, "n_shingles long, set_hash string, bands array<long>, sketch array<long>",
        make, keep=[c for c in docs.columns if c != text])


def links(pairs: DataFrame, texts: DataFrame, percent: int) -> DataFrame:
    """The pairs (a, b) whose full shingle sets have the similarity asked for."""
    both = pairs.join(texts.select(F.col("id").alias("a"), F.col("text").alias("text_a")), "a")
    both = both.join(texts.select(F.col("id").alias("b"), F.col("text").alias("text_b")), "b")

    def work(batches):
        words, recent = WordHashes(), OrderedDict()

        def shingles(key: int, text: str) -> np.ndarray:
            if key not in recent:
                recent[key] = shingle_hashes(text, words)
                if len(recent) > 64:
                    recent.popitem(last=False)
            return recent[key]

        for batch in batches:
            linked = []
            a, b, text_a, text_b = (batch.column(i) for i in range(4))
            for i, (x, y) in enumerate(zip(a.to_pylist(), b.to_pylist())):
                one = shingles(x, text_a[i].as_py() if x not in recent else "")
                two = shingles(y, text_b[i].as_py() if y not in recent else "")
                common = len(np.intersect1d(one, two, assume_unique=True))
                linked.append(100 * common >= percent * (len(one) + len(two) - common))
            yield pa.RecordBatch.from_arrays([a, b], ["a", "b"]).filter(pa.array(linked))

    return both.select("a", "b", "text_a", "text_b").mapInArrow(work, "a long, b long")


def components(edges: DataFrame) -> DataFrame:
    """(doc, comp): the smallest document reachable, for every document on an edge.

    Labels spread along edges and jump to their label's label; each round is written
    to the shared folder, so a lost executor repeats one round at most.
    """
    both = write_and_read(edges.select(F.col("a").alias("doc"), F.col("b").alias("other")).union(
        edges.select("b", "a")).distinct(), "edges")
    labels = write_and_read(both.groupBy("doc").agg(
        F.least("doc", F.min("other")).alias("comp")), "labels")
    while True:
        near = both.join(labels.withColumnsRenamed({"doc": "other"}), "other").groupBy("doc").agg(
            F.min("comp").alias("near"))
        spread = labels.join(near, "doc").select(
            "doc", F.col("comp").alias("old"), F.least("comp", "near").alias("comp"))
        head = spread.select(F.col("doc").alias("comp"), F.col("comp").alias("head"))
        jumped = spread.join(head, "comp", "left").select(
            "doc", "old", F.least("comp", "head").alias("comp"))
        done = write_and_read(jumped, "labels")
        moved = done.filter("old <> comp").limit(1).count()
        labels = done.drop("old")
        if not moved:
            return labels


def _possible(percent: int) -> Column:
    """Whether sizes and bitmaps of a pair allow the similarity asked for.

    The smaller set must have ``percent`` of the larger. Each bit that differs stands
    for at least one shingle that only one of the sets has, and a link allows
    (100 - percent) / (100 + percent) of both sizes together to be such shingles. So no
    link is ruled out, and few other pairs have their texts fetched.
    """
    differing = F.aggregate(F.zip_with("sketch_a", "sketch_b", lambda x, y: F.bit_count(
        x.bitwiseXOR(y))), F.lit(0), lambda total, bits: total + bits)
    return (100 * F.least("n_a", "n_b") >= percent * F.greatest("n_a", "n_b")) & (
        (100 + percent) * differing <= (100 - percent) * (F.col("n_a") + F.col("n_b")))


def _pairs(rows: DataFrame, is_center: Column, percent: int) -> DataFrame:
    """Pairs of a center and another member of its bucket, of different components."""
    side = lambda x: [F.col("doc").alias(x), *[
        F.col(c).alias(f"{c}_{x}") for c in ("n", "comp", "sketch")]]
    center = rows.filter(is_center).select("bucket", *side("b"))
    other = rows.select("bucket", *side("a"), is_center.alias("both"))
    return other.join(center, "bucket").filter(
        (F.col("comp_a") != F.col("comp_b")) & (~F.col("both") | (F.col("a") < F.col("b")))
        & _possible(percent)).select("a", "b").distinct()


def _open(rows: DataFrame, comps: DataFrame) -> DataFrame:
    """Rows of buckets that still hold different components.

    ``main`` is the bucket's largest component, ``m`` the bucket's rows and ``open``
    its pairs of different components. Each of those has a member outside ``main``.
    """
    known = rows.drop("comp", "main", "m", "open").join(comps, "doc", "left").withColumn(
        "comp", F.coalesce("comp", "doc"))
    sizes = known.groupBy("bucket", "comp").agg(F.count(F.lit(1)).alias("c"))
    mixed = sizes.groupBy("bucket").agg(
        F.max_by("comp", F.struct("c", -F.col("comp"))).alias("main"), F.sum("c").alias("m"),
        F.sum(F.col("c") * F.col("c")).alias("squares"), F.count(F.lit(1)).alias("kinds"))
    return known.join(mixed.filter("kinds > 1").selectExpr(
        "bucket", "main", "m", "(m * m - squares) / 2 AS open"), "bucket")


def _can_link(crowd: DataFrame, texts: DataFrame, percent: int) -> DataFrame:
    """Documents of ``crowd`` that share enough shingles with any of the others to link.

    A link needs ``percent`` of a document's shingles in the other one. Shingles
    that no other document of the crowd has cannot be among them, so a document with
    too many of those links to nobody here.
    """
    members = crowd.select(F.col("doc").alias("id"), "n").distinct().join(texts, "id")

    def work(batches):
        words = WordHashes()
        for batch in batches:
            for i, key in enumerate(batch.column(0).to_pylist()):
                found = shingle_hashes(batch.column(1)[i].as_py(), words).view(np.int64)
                yield pa.RecordBatch.from_arrays(
                    [pa.array(np.full(len(found), key)), pa.array(found)], ["doc", "shingle"])

    held = members.select("id", "text").mapInArrow(work, "doc long, shingle long")
    shared = held.groupBy("shingle").agg(F.count(F.lit(1)).alias("df")).filter("df > 1")
    counts = held.join(shared, "shingle").groupBy("doc").agg(F.count(F.lit(1)).alias("common"))
    return counts.join(members.select(F.col("id").alias("doc"), "n"), "doc").filter(
        F.col("common") * 100 >= F.col("n") * percent).select("doc")


def near_duplicates(docs: DataFrame, key: str, text: str, percent: int = 85) -> DataFrame:
    """One row per document: key, n_shingles, component_id, kept.

    Documents link when 100 * shared shingles >= ``percent`` * all shingles of the
    two; a component's id is the smallest key reachable. ``kept`` marks that document.

    Bands are as long as ``MISSED`` allows at ``percent`` (7 rows at 85, 5 at 80).

    Documents with equal shingle sets form a class, and one of them goes on. Classes
    meet in buckets of equal band hashes. In the first round each bucket is a star:
    its center (the member that shares most buckets with others, as an original does
    with its copies) is compared with every member on full sets. Later rounds take
    the buckets that still hold different components: in crowded ones, documents
    that provably link to nobody are dropped, and members outside a bucket's largest
    component become the centers of further stars, all of them once those pairs are few
    against the documents. So no candidate is left out, and pairs grow with
    documents, not with a bucket's square.

    Null and empty texts have no shingles and link with nothing. Rows with a null key
    take no part (component null, kept). Repeated rows are members of one class.
    """
    source = docs.select(F.col(quoted(key)).cast("long").alias("id"),
                         F.col(quoted(text)).cast("string").alias("text"))
    signed = write_and_read(signatures(source, "text", band_rows(percent)), "signatures")
    classes = signed.filter("id IS NOT NULL AND set_hash IS NOT NULL").groupBy("set_hash").agg(
        F.min(F.struct("id", "n_shingles", "bands", "sketch")).alias("first"))
    banded = classes.select(
        F.col("first.id").alias("doc"), F.col("first.n_shingles").alias("n"),
        F.posexplode("first.bands").alias("band", "hash")).select(
        F.xxhash64("band", "hash").alias("bucket"), "doc", "n")
    shared = banded.groupBy("bucket").agg(F.count(F.lit(1)).alias("m")).filter("m > 1")
    rows = write_and_read(banded.join(shared, "bucket"), "buckets")
    candidates = write_and_read(rows.select("doc").distinct(), "candidates")
    sketches = classes.select(F.col("first.id").alias("doc"), F.col(
        "first.sketch").alias("sketch")).join(candidates, "doc", "left_semi")
    texts = write_and_read(source.join(candidates.withColumnRenamed(
        "doc", "id"), "id", "left_semi").dropDuplicates(["id"]), "texts")

    popular = rows.groupBy("doc").agg(F.sum("m").alias("popular"))
    ranked = rows.join(popular.join(sketches, "doc"), "doc").withColumn("comp", F.col("doc"))
    first = ranked.groupBy("bucket").agg(F.max_by(
        "doc", F.struct("popular", -F.col("doc"))).alias("center"))
    rows = write_and_read(ranked.join(first, "bucket").withColumn(
        "center", F.col("doc") == F.col("center")), "stars")
    found = write_and_read(
        links(_pairs(rows, F.col("center"), percent), texts, percent), "links")
    comps = components(found)
    documents = signed.count()
    rows, pruned = rows.filter(~F.col("center")).drop("center"), False
    while True:
        rows = write_and_read(_open(rows, comps), "open")
        left = rows.agg(F.sum(F.col("open") / F.col("m")).alias("pairs"), F.max("m").alias(
            "m")).first()
        if left["m"] is None:
            break
        minor = F.col("comp") != F.col("main")
        if left["pairs"] <= PAIRS_PER_DOC * documents:
            found = found.union(write_and_read(
                links(_pairs(rows, minor, percent), texts, percent), "links"))
            comps = components(found)
            break
        if not pruned:
            crowd = rows.filter(F.col("m") > CROWDED)
            can = write_and_read(_can_link(crowd, texts, percent), "linkable")
            rows = rows.filter(F.col("m") <= CROWDED).unionByName(
                crowd.join(can, "doc", "left_semi"))
            pruned = True
            continue
        order = Window.partitionBy("bucket").orderBy(F.desc("popular"), "doc")
        center = rows.filter(minor).select("bucket", "doc", F.row_number().over(order).alias(
            "nth")).filter(F.col("nth") <= CENTERS).drop("nth").withColumn("center", F.lit(True))
        rows = write_and_read(rows.join(center, ["bucket", "doc"], "left").withColumn(
            "center", F.coalesce("center", F.lit(False))), "stars")
        new = write_and_read(
            links(_pairs(rows, F.col("center"), percent), texts, percent), "links")
        rows = rows.filter(~F.col("center")).drop("center")
        if not new.isEmpty():
            found = found.union(new)
            comps = components(found)

    named = classes.select("set_hash", F.col("first.id").alias("doc")).join(
        comps, "doc", "left").select("set_hash", F.coalesce("comp", "doc").alias("comp"))
    return signed.select("id", "n_shingles", "set_hash").join(named, "set_hash", "left").select(
        F.col("id").alias(key), "n_shingles",
        F.when(F.col("id").isNotNull(), F.coalesce("comp", "id")).alias("component_id"),
        F.coalesce(F.col("id") == F.coalesce("comp", "id"), F.lit(True)).alias("kept"))
