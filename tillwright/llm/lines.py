"""Repeated and nearly repeated lines, found by a segment-partition edit join."""

from __future__ import annotations

from collections.abc import Iterator

import pandas as pd
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tillwright.llm.common import ROW_KEY, components, row_key, settle

_BLANK = " \t\r\x0b\x0c"


def within(a: str, b: str, most: int) -> bool:
    """Whether two strings are at most ``most`` edits apart.

    Bit-parallel and banded: one word per number of errors holds, for the prefixes
    of ``a`` that differ in length from the prefix of ``b`` by no more than
    ``most``, whether they are that close. The band moves along with ``b``.
    """
    if abs(len(a) - len(b)) > most:
        return False
    start, short = 0, min(len(a), len(b))
    while start < short and a[start] == b[start]:
        start += 1
    end = 0
    while end < short - start and a[-1 - end] == b[-1 - end]:
        end += 1
    a, b = a[start : len(a) - end], b[start : len(b) - end]
    places: dict[str, int] = {}
    for i, letter in enumerate(a):
        places[letter] = places.get(letter, 0) | 1 << i
    band = (1 << 2 * most + 1) - 1
    rows = [((1 << errors + 1) - 1) << most for errors in range(most + 1)]
    for at, letter in enumerate(b):
        same = places.get(letter, 0)
        same = (same >> at - most if at >= most else same << most - at) & band
        before = after = 0
        for errors, row in enumerate(rows):
            now = (row & same) | before | before >> 1 | after << 1
            rows[errors] = after = now & band
            before = row
    return bool(rows[most] >> (len(a) - len(b) + most) & 1)


def lines_of(docs: DataFrame, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """A row per line that is not blank: row key, ``place``, ``order``, ``line``, ids.

    Lines are cut at line feeds and stripped of blanks. ``order`` ranks all lines
    by document id, then place; rows without an id come last.
    """
    rank = F.coalesce(F.col(doc_id).cast("decimal(20,0)"), F.lit(str(1 << 63)).cast("decimal(20,0)"))
    rows = docs.select(
        *row_key(doc_id, text), rank.alias("_rank"),
        F.posexplode(F.split(F.col(text).cast("string"), "\n")).alias("place", "_raw"),
    ).select(*ROW_KEY, "_rank", "place", F.btrim("_raw", F.lit(_BLANK)).alias("line"))
    return rows.where("line != ''").select(
        *ROW_KEY, "place", "line",
        (F.col("_rank") * F.lit(1 << 31).cast("decimal(10,0)") + F.col("place")).cast("decimal(38,0)").alias("order"),
        F.xxhash64("line").alias("short_id"), F.unhex(F.md5("line")).alias("line_id"),
    )


def _segment(length: Column, number: int, segments: int) -> tuple[Column, Column]:
    """First place (from 0) and length of a segment of a line of ``length``."""
    first = F.floor(length * (number - 1) / segments)
    return first, F.floor(length * number / segments) - first


def segment_keys(lines: DataFrame, most: int) -> DataFrame:
    """``(short_id, key, own)``: where a line is indexed, and where it looks.

    A line is cut into ``most + 1`` segments; of a line within ``most`` edits one of
    them stands unchanged. A line looks among lines as long as itself or up to
    ``most`` shorter, for each segment at the places where it can stand when the
    edits left and right of it are few enough. ``own`` marks its index entries.
    """
    size, rows = F.length("line"), []
    for shorter in range(most + 1):
        other = size - shorter
        for number in range(1, most + 2):
            first, width = _segment(other, number, most + 1)
            left, right = number - 1, most + 1 - number
            for shift in range(max(-left, shorter - right), min(left, shorter + right) + 1):
                part = F.col("line").substr(F.greatest(first + shift, F.lit(0)).cast("int") + 1,
                                            width.cast("int"))
                rows.append(F.struct(
                    F.xxhash64(other, F.lit(number), part).alias("key"),
                    F.lit(shorter == shift == 0).alias("own"),
                ))
    return lines.select("short_id", F.explode(F.array(*rows)).alias("_k")).select(
        "short_id", "_k.*"
    )


def _variant_batches(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Keys that two lines one edit apart share, a place at a time.

    Lines of one length share what is left without one character; a longer line
    without a character is the shorter one cut at that place. Hashes of all
    prefixes and suffixes are formed on the way, so a line costs its length.
    """
    for batch in batches:
        for line_id, line in zip(batch.column(0), batch.column(1)):
            text = line.as_py()
            heads, tails = [0], [0]
            head, tail = xxhash.xxh64(), xxhash.xxh64()
            for letter in text:
                head.update(letter.encode())
                heads.append(head.intdigest())
            for letter in reversed(text):
                tail.update(letter.encode())
                tails.append(tail.intdigest())
            n = len(text)
            tails.reverse()  # tails[i]: of text[i:]
            keys, roles = [], []
            for kind, length, size, skip in ((0, n, n, 1), (1, n, n + 1, 0), (2, n - 1, n, 1)):
                for i in range(size):
                    keys.append(xxhash.xxh64_intdigest(
                        b"%d %d %d %d %d" % (min(kind, 1), length, i, heads[i], tails[i + skip])
                    ) - (1 << 63))
                    roles.append(kind)
            yield pa.RecordBatch.from_arrays(
                [pa.array([line_id.as_py()] * len(keys), pa.binary()), pa.array(keys, pa.int64()),
                 pa.array(roles, pa.int32())],
                ["line_id", "variant", "role"],
            )


def _crowded_links(texts: DataFrame) -> DataFrame:
    """Links of lines one edit apart without any pairs, for the lines of crowded buckets.

    Lines that share a variant are all one edit apart if one character was taken
    from each; a longer line is one edit from the shorter line that is the variant.
    """
    variants = texts.select("line_id", "line").mapInArrow(
        _variant_batches, "line_id binary, variant bigint, role int"
    )
    shared = variants.groupBy("variant").agg(
        F.collect_set(F.when(F.col("role") < 2, F.col("line_id"))).alias("own"),
        F.collect_set(F.when(F.col("role") == 2, F.col("line_id"))).alias("longer"),
    )
    both = F.array_union("own", "longer")
    return shared.where((F.size("own") > 0) & (F.size(both) > 1)).select(
        F.array_min("own").alias("a"), F.explode(both).alias("b")
    ).where("a != b")


def near_lines(lines: DataFrame, most: int = 1, shortest: int = 16,
               crowd: int = 64) -> DataFrame:
    """``(a, b)``: ids of different lines at most ``most`` edits apart, enough to join all.

    Lines shorter than ``shortest`` characters have no near lines. Buckets, which
    are the lines that share a segment key, are found by counting, so only lines
    with company are ever paired, and only the texts of these are looked up.
    Within a bucket of more than ``crowd`` lines no pairs are made: its lines are
    tied over what they share without one character. That holds for one edit; with
    more, crowded buckets are paired like others, at a cost of their square.
    """
    long_enough = lines.where(F.length("line") >= shortest)
    keyed = segment_keys(long_enough, most)
    shared = settle(
        keyed.groupBy("key")
        .agg(F.min("short_id").alias("lo"), F.max("short_id").alias("hi"), F.max("own").alias("own"))
        .where("own AND lo != hi").select("key"),
        "shared-segments",
    )
    members = settle(
        keyed.join(shared, "key").groupBy("key", "short_id").agg(F.max("own").alias("own")),
        "segment-members",
    )
    sizes = settle(members.groupBy("key").agg(F.count(F.lit(1)).alias("n")), "bucket-sizes")
    crowded = members.join(sizes.where(F.col("n") > crowd) if most == 1 else sizes.limit(0), "key")
    few = members.join(sizes.where(F.col("n") <= crowd) if most == 1 else sizes, "key")
    pairs = settle(
        few.where("own").select("key", F.col("short_id").alias("x"))
        .join(few.select("key", F.col("short_id").alias("y"), F.col("own").alias("_own")), "key")
        .where("x != y AND (x < y OR NOT _own)")
        .select("x", "y").distinct(),
        "line-pairs",
    )
    thick = crowded.select("short_id").distinct().withColumn("thick", F.lit(True))
    wanted = settle(
        pairs.select(F.col("x").alias("short_id")).union(pairs.select("y"))
        .withColumn("thick", F.lit(False)).union(thick)
        .groupBy("short_id").agg(F.max("thick").alias("thick")),
        "wanted-lines",
    )
    texts = settle(
        long_enough.join(wanted, "short_id")
        .groupBy("short_id", "line_id", "thick").agg(F.first("line").alias("line")),
        "line-texts",
    )

    @F.pandas_udf("boolean")
    def close(a: pd.Series, b: pd.Series) -> pd.Series:
        return pd.Series([within(x, y, most) for x, y in zip(a, b)], dtype=bool)

    left = texts.select(F.col("short_id").alias("x"), F.col("line_id").alias("a"),
                        F.col("line").alias("_a"))
    right = texts.select(F.col("short_id").alias("y"), F.col("line_id").alias("b"),
                         F.col("line").alias("_b"))
    verified = pairs.join(left, "x").join(right, "y").where(close("_a", "_b")).select("a", "b")
    # Lines whose short ids clash are rare; they are compared with each other, too.
    clashing = left.join(right, left["x"] == right["y"]).where("a < b").where(
        close("_a", "_b")).select("a", "b")
    links = verified.union(clashing)
    if most == 1:
        links = links.union(_crowded_links(texts.where("thick")))
    return links.distinct()


def repeated(docs: DataFrame, doc_id: str = "doc_id", text: str = "text",
             **settings) -> DataFrame:
    """``(row key, gone, n_near)``: places of the lines of a row that an earlier line repeats.

    Lines equal or linked over near lines form a class; its first line by document
    id and place stays, all others go. ``n_near`` counts those that go although no
    equal line stays. Rows without such lines are left out.
    """
    lines = lines_of(docs, doc_id, text)
    classes = settle(components(near_lines(lines, **settings), "near-lines"), "line-classes")
    firsts = settle(
        lines.groupBy("line_id").agg(F.count(F.lit(1)).alias("n"), F.min("order").alias("first")),
        "first-lines",
    )
    of_class = firsts.join(classes.withColumnRenamed("node", "line_id"), "line_id", "left")
    roots = of_class.where(F.col("root").isNotNull()).groupBy("root").agg(
        F.min("first").alias("class_first"))
    bound = settle(
        of_class.where("n > 1 OR root IS NOT NULL").join(roots.hint("rebalance"), "root", "left")
        .select("line_id", F.coalesce("class_first", "first").alias("stays"),
                (F.col("class_first") < F.col("first")).alias("near")),
        "line-decisions",
    )
    # A line that is everywhere is one row of decisions and many rows of lines: the
    # adaptive join splits it.
    return (
        lines.select(*ROW_KEY, "place", "order", "line_id").join(bound, "line_id")
        .where("order > stays")
        .groupBy(*ROW_KEY)
        # Repeated rows write their places twice; one of each is enough.
        .agg(F.array_sort(F.collect_set("place")).alias("gone"),
             F.size(F.collect_set(F.when(F.col("near"), F.col("place")))).cast("long")
             .alias("n_near"))
    )


def report(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", **settings) -> DataFrame:
    """``(doc_id, n_lines, gone, n_near)`` of every row, see ``repeated``.

    Blank lines are no lines. Null texts have none. Rows with one id count as one
    document; equal rows lose the same lines. Ids are whole numbers or null.
    """
    gone = settle(repeated(docs, doc_id, text, **settings), "gone-lines")
    parts = F.filter(F.split(F.col(text).cast("string"), "\n"),
                     lambda x: F.btrim(x, F.lit(_BLANK)) != "")
    rows = docs.select(
        F.col(doc_id).alias("doc_id"), *row_key(doc_id, text),
        F.coalesce(F.size(parts), F.lit(0)).cast("long").alias("n_lines"),
    )
    return rows.join(gone, ROW_KEY, "left").select(
        "doc_id", F.greatest("n_lines", F.lit(0).cast("long")).alias("n_lines"),
        F.coalesce("gone", F.array().cast("array<int>")).alias("gone"),
        F.coalesce("n_near", F.lit(0).cast("long")).alias("n_near"),
    )


def drop_repeated(docs: DataFrame, doc_id: str = "doc_id", text: str = "text",
                  **settings) -> DataFrame:
    """``docs`` without the lines that ``repeated`` finds; blank lines stay.

    A row that loses lines and has none left but blank ones goes. Other rows and
    columns stay as they are.
    """
    gone = settle(repeated(docs, doc_id, text, **settings), "gone-lines")
    rows = docs.select(F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("row"),
                       *row_key(doc_id, text))
    parts = F.split(F.col("row")[text], "\n")
    left = F.array_except(F.sequence(F.lit(0), F.size(parts) - 1), F.col("gone"))
    rest = F.array_join(F.transform(left, lambda i: F.element_at(parts, i + 1)), "\n")
    body = F.when(F.col("gone").isNull(), F.col("row")[text]).otherwise(rest)
    return (
        rows.join(gone, ROW_KEY, "left")
        .withColumn("body", body)
        .where(F.col("gone").isNull() | (F.btrim("body", F.lit(_BLANK + "\n")) != ""))
        .select(*[F.col("body").alias(c) if c == text else F.col("row")[c].alias(c)
                  for c in docs.columns])
    )
