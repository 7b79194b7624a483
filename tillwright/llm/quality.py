"""Quality rules with thresholds taken from the texts of each language and source."""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tillwright.llm.common import settle

_BLANK = b" \t\n\x0b\x0c\r"
_NO_CODE_POINT = bytes(range(0x80, 0xC0))
_SYMBOLS = b"#*$%&|<>"
COUNTS = ["n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "n_lines"]


def repeated_words(words: list[bytes]) -> int:
    """Words inside a 3-word window that the text has twice or more."""
    n = len(words)
    if n < 4:
        return 0
    place = dict(zip(words, range(n)))
    if len(place) == n:
        return 0
    code = np.fromiter(map(place.__getitem__, words), np.int64, n)
    pairs = code[:-1] * n + code[1:]
    if n >= 1 << 21:  # n cubed would overflow
        pairs = np.unique(pairs, return_inverse=True)[1]
    _, window, times = np.unique(pairs[:-1] * n + code[2:], return_inverse=True,
                                 return_counts=True)
    again = times[window] > 1
    covered = np.zeros(n, bool)
    for shift in range(3):
        covered[shift : shift + len(again)] |= again
    return int(covered.sum())


def counts_of(text: bytes) -> tuple[int, ...]:
    """The numbers of ``COUNTS`` for one text."""
    words = text.split()
    seen: set[bytes] = set()
    lines = repeated = 0
    for line in text.split(b"\n"):
        if line.strip():
            lines += 1
            if line in seen:
                repeated += 1
            else:
                seen.add(line)
    return (
        len(words),
        len(text.translate(None, _BLANK + _NO_CODE_POINT)),
        len(text) - len(text.translate(None, _SYMBOLS)),
        repeated,
        repeated_words(words),
        lines,
    )


@dataclass(frozen=True)
class Rule:
    """A ratio of two counts, judged by the sketch of its group.

    A ratio with both limits stands around the middle half of its group. One that is
    0 for most texts is held against the quantile ``tail``, and as far again from the
    median. ``spread`` is a least width of the middle half; no rule needs one.
    """

    name: str
    over: str
    under: str
    spread: float = 0.0
    low: bool = False
    tail: float = 0.95


RULES = (
    Rule("symbols", "n_symbols", "word_chars"),
    Rule("dup_lines", "n_dup_lines", "n_lines"),
    Rule("repeats", "n_repeat_words", "n_words"),
    Rule("word_length", "word_chars", "n_words", low=True),
)
# Sketch buckets grow by this factor, so a quantile is right to half a percent of itself.
_GROWTH = 1.01
_LEAST = 1e-4


def with_counts(docs: DataFrame, text: str = "text", keep: list[str] | None = None) -> DataFrame:
    """A column ``row`` with the columns ``keep`` (all by default), and ``counts``."""
    keep = docs.columns if keep is None else keep
    row = T.StructType([docs.schema[c] for c in keep])
    counts = T.StructType([T.StructField(c, T.LongType()) for c in COUNTS])

    def of_batches(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = [counts_of(t.as_py() or b"") for t in batch.column(1).cast(pa.binary())]
            columns = zip(*found) if found else [[]] * len(COUNTS)
            yield pa.RecordBatch.from_arrays(
                [batch.column(0),
                 pa.StructArray.from_arrays([pa.array(c, pa.int64()) for c in columns], COUNTS)],
                ["row", "counts"],
            )

    return docs.select(
        F.struct(*[F.col(f"`{c}`") for c in keep]).alias("row"), F.col(text).cast("string")
    ).mapInArrow(of_batches, T.StructType([T.StructField("row", row),
                                           T.StructField("counts", counts)]))


def _ratio(rule: Rule) -> Column:
    return F.coalesce(
        F.try_divide(F.col(f"counts.{rule.over}"), F.col(f"counts.{rule.under}")), F.lit(0.0)
    )


def sketches(counted: DataFrame, lang: str = "lang", source: str = "source") -> DataFrame:
    """Quantile sketches: ``(lang, source, rule, bucket, n)``.

    A bucket holds the texts of a group whose ratio lies between two neighbouring
    powers of ``_GROWTH``. Sketches merge by adding the counts of a bucket, in any
    order and with the same result; the sums are formed map-side, so a source with
    most of the texts costs some thousand rows per task at most.
    """
    ratios = F.array(*[F.struct(F.lit(r.name).alias("rule"), _ratio(r).alias("value"))
                       for r in RULES])
    value = F.col("_r.value")
    bucket = F.when(value < _LEAST, F.lit(0)).otherwise(
        1 + F.floor(F.log(value / _LEAST) / F.log(F.lit(_GROWTH)))
    )
    return (
        counted.select(F.col(f"row.{lang}").alias("lang"), F.col(f"row.{source}").alias("source"),
                       F.explode(ratios).alias("_r"))
        .groupBy("lang", "source", F.col("_r.rule").alias("rule"), bucket.alias("bucket"))
        .agg(F.count(F.lit(1)).alias("n"))
    )


def _value(bucket: Column, part: float) -> Column:
    """The value at a part of a bucket's width: 0 its least, 1 its greatest."""
    return F.when(bucket == 0, F.lit(_LEAST if part == 1 else 0.0)).otherwise(
        _LEAST * F.pow(F.lit(_GROWTH), bucket - 1 + part)
    )


def fences(merged: DataFrame, keys: list[str], reach: float) -> DataFrame:
    """A row per group: ``n`` texts, and ``low`` and ``high`` of each rule.

    The fences of rules with both stand ``reach`` times the width of the middle half
    outside of it; the others stand above the quantile ``tail`` by its distance from
    the median.
    """
    # At most some thousand buckets per group and rule, whatever the number of texts.
    groups = merged.groupBy(*keys, "rule", "bucket").agg(F.sum("n").alias("n")).groupBy(
        *keys, "rule"
    ).agg(
        F.sum("n").alias("n"),
        F.array_sort(F.collect_list(F.struct("bucket", "n"))).alias("sketch"),
    )

    def quantile(q: float) -> Column:
        return F.aggregate(
            "sketch",
            F.struct(F.lit(0).cast("long").alias("seen"), F.lit(None).cast("long").alias("at")),
            lambda state, b: F.struct(
                (state["seen"] + b["n"]).alias("seen"),
                F.when(state["at"].isNull() & (state["seen"] + b["n"] >= F.col("n") * q),
                       b["bucket"].cast("long")).otherwise(state["at"]).alias("at"),
            ),
            lambda state: state["at"],
        )

    wanted = sorted({q for r in RULES for q in ((0.25, 0.75) if r.low else (0.5, r.tail))})
    found = groups.select(*keys, "rule", "n", *[quantile(q).alias(f"q{q}") for q in wanted])
    limits = []
    for r in RULES:
        low, high = (F.col(f"`q{q}`") for q in ((0.25, 0.75) if r.low else (0.5, r.tail)))
        width = F.greatest(_value(high, 0.5) - _value(low, 0.5), F.lit(r.spread)) * (
            reach if r.low else 1)
        for side, limit in (("high", _value(high, 1) + width), ("low", _value(low, 0) - width)):
            if side == "high" or r.low:
                limits.append(
                    F.max(F.when(F.col("rule") == r.name, limit)).alias(f"{side}_{r.name}"))
    return found.groupBy(*keys).agg(F.max("n").alias("n"), *limits)


LIMITS = [*[f"high_{r.name}" for r in RULES], *[f"low_{r.name}" for r in RULES if r.low]]


def thresholds(counted: DataFrame, lang: str = "lang", source: str = "source",
               reach: float = 3.0, drawn: int = 10) -> DataFrame:
    """Limits per language and source, ``(lang, source, *LIMITS)``.

    A group's limits are drawn to those of its language as if ``drawn`` texts had these,
    and a language's to those of all texts; so they move without a step as a group
    grows, and a group of few texts has nearly those of its language. All come from
    merged sketches. Texts that fail the base rules, which go anyway, are left out of
    the sketches; a group of nothing else has no limits. Null languages and sources are groups of their own.
    """
    sketched = settle(sketches(counted.where(~base_failed()), lang, source), "sketches")
    overall = fences(sketched, [], reach).first()
    own = fences(sketched, ["lang", "source"], reach)
    wider = fences(sketched, ["lang"], reach).select(
        F.col("lang").alias("_lang"), F.col("n").alias("_n"),
        *[F.col(c).alias(f"_{c}") for c in LIMITS],
    )
    joined = own.join(wider, F.col("lang").eqNullSafe(F.col("_lang")))

    def pulled(own: Column, n: str, to: Column) -> Column:
        return (own * F.col(n) + to * drawn) / (F.col(n) + drawn)

    return settle(joined.select("lang", "source", *[
        pulled(F.col(c), "n", pulled(
            F.col(f"_{c}"), "_n", F.lit(overall[c] if overall else None).cast("double"))).alias(c)
        for c in LIMITS
    ]), "thresholds")


def base_failed() -> Column:
    words, repeats = F.col("counts.n_words"), F.col("counts.n_repeat_words")
    return (words < 50) | (100 * repeats > 50 * words)


def judged(docs: DataFrame, limits: DataFrame | None = None, text: str = "text",
           lang: str = "lang", source: str = "source", keep: list[str] | None = None,
           **settings) -> DataFrame:
    """``row`` (the columns ``keep``), ``counts``, ``base_failed`` and ``kept`` of every row.

    A text is kept if it does not fail the base rules and no ratio is outside the
    limits of its language and source; a count of one is never outside. Null texts are empty; a ratio over nothing
    is 0. The limits are a small table that the planner broadcasts by its size on
    file; if they are large, a join by language and source, whose hot keys the
    adaptive skew join splits. Repeated rows are judged alike, an empty table gives none.
    """
    # Without the text a counted row is small, so it is written and texts are counted once.
    small = keep is not None and text not in keep and {lang, source} <= set(keep)
    counted = with_counts(docs, text, keep)
    counted = settle(counted, "counted") if small else counted
    if limits is None:
        of_groups = counted if small else with_counts(docs, text, [lang, source])
        limits = thresholds(of_groups, lang, source, **settings)
    fine = F.lit(True)
    for rule in RULES:
        # One symbol or one repeated line says nothing, however rare it is in the group.
        fine = fine & ((_ratio(rule) <= F.col(f"limits.high_{rule.name}"))
                       | (F.col(f"counts.{rule.over}") <= 1))
        if rule.low:
            fine = fine & (_ratio(rule) >= F.col(f"limits.low_{rule.name}"))
    limits = limits.select(F.struct("*").alias("limits"))
    joined = counted.join(
        limits,
        F.col(f"row.{lang}").eqNullSafe(F.col("limits.lang"))
        & F.col(f"row.{source}").eqNullSafe(F.col("limits.source")),
        "left",
    )
    return joined.select("row", "counts", base_failed().alias("base_failed"),
                         F.coalesce(~base_failed() & fine, F.lit(False)).alias("kept"))


def keep_good(docs: DataFrame, **settings) -> DataFrame:
    """The rows of ``docs`` that are kept, with their columns."""
    return judged(docs, **settings).where("kept").select("row.*")
