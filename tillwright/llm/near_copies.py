"""Near-duplicate documents by SimHash and pigeonring filtering."""

from __future__ import annotations

from collections.abc import Iterator
from itertools import repeat

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tillwright.llm.common import ROW_KEY, components, row_key, settle

BITS = 64
_LOWER = bytes(range(65)) + bytes(range(97, 123)) + bytes(range(91, 256))
# Hashes spread out to single bits at a time: 64 bytes each.
_AT_ONCE = 1 << 18


def shingle_hashes(text: bytes, words: int = 3, seed: int = 42) -> np.ndarray:
    """XXH64 of every word shingle of a text, repeats included."""
    found = text.translate(_LOWER).split()
    if not found:
        return np.empty(0, np.uint64)
    if len(found) < words:
        shingles = [b" ".join(found)]
    else:
        shingles = map(b" ".join, zip(*(found[i:] for i in range(words))))
    return np.fromiter(map(xxhash.xxh64_intdigest, shingles, repeat(seed)), np.uint64)


def fingerprint(hashes: np.ndarray) -> int:
    """The 64 bits that are set in over half of the hashes, as a signed number."""
    counts = np.zeros(BITS, np.int64)
    for start in range(0, len(hashes), _AT_ONCE):
        part = hashes[start : start + _AT_ONCE].astype("<u8").view(np.uint8).reshape(-1, 8)
        counts += np.unpackbits(part, axis=1, bitorder="little").sum(axis=0, dtype=np.int64)
    return int(np.packbits(counts * 2 > len(hashes), bitorder="little").view("<i8")[0])


def fingerprints(docs: DataFrame, doc_id: str = "doc_id", text: str = "text",
                 words: int = 3) -> DataFrame:
    """``(doc_id, fp)`` and the row key of every row. Null and wordless texts have fingerprint 0."""
    names = ["doc_id", *ROW_KEY, "fp"]

    def of_batches(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = batch.column(3).cast(pa.binary())
            found = [fingerprint(shingle_hashes(t.as_py() or b"", words)) for t in texts]
            yield pa.RecordBatch.from_arrays(
                [*(batch.column(i) for i in range(3)), pa.array(found, pa.int64())], names)

    kind = docs.schema[doc_id].dataType.simpleString()
    plain = docs.select(F.col(f"`{doc_id}`").alias("doc_id"),
                        F.col(f"`{text}`").cast("string").alias("text"))
    return plain.select("doc_id", *row_key(), "text").mapInArrow(
        of_batches, f"doc_id {kind}, _id string, _text_hash bigint, fp bigint"
    )


def _widths(segments: int) -> list[tuple[int, int]]:
    """First bit and width of each segment; widths differ by one at most."""
    ends = [BITS * i // segments for i in range(segments + 1)]
    return [(a, b - a) for a, b in zip(ends, ends[1:])]


def _bits(value: Column, first: int, width: int) -> Column:
    return F.shiftrightunsigned(value, first).bitwiseAND(F.lit((1 << width) - 1))


def free_links(segments: int, distance: int) -> int:
    """Consecutive segments that a viable chain has without any difference."""
    return -(-segments // distance) - 1 if distance else segments


def _ring_keys(fps: DataFrame, segments: int, distance: int) -> DataFrame:
    """A row ``(fp, ring, key)`` for each place on the ring where a chain may start."""
    widths, free = _widths(segments), free_links(segments, distance)
    keys = []
    for start in range(segments):
        key = F.lit(0).cast("long")
        for step in range(free):
            first, width = widths[(start + step) % segments]
            key = F.shiftleft(key, width).bitwiseOR(_bits(F.col("fp"), first, width))
        keys.append(F.struct(F.lit(start).alias("ring"), key.alias("key")))
    return fps.select("fp", F.explode(F.array(*keys)).alias("_k")).select("fp", "_k.*")


def _chain_viable(a: Column, b: Column, segments: int, distance: int) -> Column:
    """Whether every chain from ``ring`` on keeps within its share of the distance."""
    widths = _widths(segments)
    differing = a.bitwiseXOR(b)
    viable = F.lit(False)
    for start in range(segments):
        total, within = F.lit(0), F.lit(True)
        for length in range(1, segments + 1):
            first, width = widths[(start + length - 1) % segments]
            total = total + F.bit_count(_bits(differing, first, width))
            within = within & (total <= F.lit(length * distance // segments))
        viable = F.when(F.col("ring") == start, within).otherwise(viable)
    return viable


def _crowded_links(members: DataFrame, segments: int, distance: int) -> DataFrame:
    """Links inside crowded buckets, without their pairs (distance 2 or less).

    Two fingerprints differ in two bits or fewer exactly if one bit flipped in
    each, or none, makes them the same. Each writes out these variants, flips
    inside the shared key left out, and is tied to the least fingerprint that has
    the variant too. A variant has no more than 65 of them.
    """
    if distance > 2:
        raise ValueError("crowded buckets are linked up to a distance of 2")
    widths, free = _widths(segments), free_links(segments, distance)
    flips = F.lit(None).cast("array<bigint>")
    for start in range(segments):
        shared = {(start + step) % segments for step in range(free)}
        open_bits = [
            bit for i, (first, width) in enumerate(widths) if i not in shared
            for bit in range(first, first + width)
        ]
        masks = F.array(F.lit(0).cast("long"), *[F.shiftleft(F.lit(1).cast("long"), bit)
                                                for bit in (open_bits if distance else [])])
        flips = F.when(F.col("ring") == start, masks).otherwise(flips)
    variants = members.select("ring", "key", "fp", F.explode(flips).alias("_flip")).select(
        "ring", "key", "fp", F.col("fp").bitwiseXOR(F.col("_flip")).alias("variant")
    )
    tied = variants.groupBy("ring", "key", "variant").agg(F.collect_set("fp").alias("fps"))
    if distance == 1:  # one flip joins two of them only if the other has none
        tied = tied.where(F.array_contains("fps", F.col("variant")))
    hub = F.col("variant") if distance == 1 else F.array_min("fps")
    return (
        tied.where(F.size("fps") > 1)
        .select(hub.alias("a"), F.explode("fps").alias("b"))
        .where("a != b")
    )


def links(fps: DataFrame, distance: int = 2, segments: int = 5, crowd: int = 64) -> DataFrame:
    """``(a, b)`` links between distinct fingerprints, enough to join all that link.

    Pigeonring: cut the bits into a ring of ``segments``. If two fingerprints
    differ in ``distance`` bits or fewer, somewhere a chain starts whose first l
    segments differ in no more than ``l * distance / segments`` bits, for every l.
    So its first links do not differ at all; with the defaults they are two
    segments of 25 bits together, and these are the join key. The longer chains
    are checked on each pair before the full distance. A bucket of more than
    ``crowd`` fingerprints makes no pairs: ``_crowded_links`` ties its members.
    More ``segments`` mean more, longer keys: 25 bits for 5, 27 for 7, 30 for 13.
    """
    keys = _ring_keys(fps, segments, distance)
    shared = settle(
        keys.groupBy("ring", "key").agg(F.count(F.lit(1)).alias("n")).where("n > 1"), "ring-keys"
    )
    members = settle(keys.join(shared, ["ring", "key"]), "ring-members")
    few = members.where(F.col("n") <= crowd).select("ring", "key", "fp")
    a, b = F.col("a"), F.col("b")
    pairs = (
        few.withColumnRenamed("fp", "a")
        .join(few.withColumnRenamed("fp", "b"), ["ring", "key"])
        .where("a < b")
        .where(_chain_viable(a, b, segments, distance))
        .where(F.bit_count(a.bitwiseXOR(b)) <= distance)
        .select("a", "b")
    )
    crowded = members.where(F.col("n") > crowd)
    return pairs.union(_crowded_links(crowded, segments, distance)).distinct()


def labelled(prints: DataFrame, pairs: DataFrame) -> DataFrame:
    """``prints`` with the ``component_id`` of every row, from links of its ``fp``."""
    nodes = settle(prints.groupBy("fp").agg(F.min("doc_id").alias("least")), "fingerprint-nodes")
    roots = settle(components(pairs, "near-copies"), "roots")
    linked = roots.join(nodes.withColumnRenamed("fp", "node"), "node")
    least = linked.groupBy("root").agg(F.min("least").alias("component_id"))
    labels = settle(
        nodes.join(
            roots.join(least.hint("rebalance"), "root").select(
                F.col("node").alias("fp"), "component_id"
            ), "fp", "left",
        ).select("fp", F.coalesce("component_id", "least").alias("component_id")),
        "component-labels",
    )
    return prints.join(labels, "fp")


def near_copies(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", distance: int = 2,
                segments: int = 5, words: int = 3, crowd: int = 64) -> DataFrame:
    """``(doc_id, fp, component_id)`` of every row.

    ``component_id`` is the least id among all documents that links lead to, the
    document itself included. Rows with one fingerprint meet as one node, so
    thousands of copies cost one row per map task. Null ids keep their row and
    take part; the least id ignores them, and a component of null ids alone has
    none. Repeated rows stay repeated. An empty table gives an empty result.
    """
    found = _rows(docs, doc_id, text, distance, segments, words, crowd)
    return found.select("doc_id", "fp", "component_id")


def _rows(docs: DataFrame, doc_id: str, text: str, distance: int = 2, segments: int = 5,
          words: int = 3, crowd: int = 64) -> DataFrame:
    prints = settle(fingerprints(docs, doc_id, text, words), "fingerprints")
    different = settle(prints.select("fp").distinct(), "distinct-prints")
    return labelled(prints, links(different, distance, segments, crowd))


def keep_one(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", **settings) -> DataFrame:
    """The rows of one document per component, the one with the least id.

    A row goes if its id is not its component's least. Rows are told apart by id and
    text, so another text with the same id is judged by its own component, and rows with
    the same id and text stay or go together. A row without an id stays: nothing says which of
    its group it is.
    """
    found = _rows(docs, doc_id, text, **settings)
    gone = settle(found.where("doc_id != component_id").select(*ROW_KEY).distinct(), "near-copies")
    return docs.select("*", *row_key(doc_id, text)).join(gone, ROW_KEY, "left_anti").select(
        *[F.col(f"`{c}`") for c in docs.columns]
    )
