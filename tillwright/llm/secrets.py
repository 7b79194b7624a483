"""Secrets in texts, and credentials whose parts stand near each other."""

from __future__ import annotations

import re
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tillwright.llm.common import ROW_KEY, row_key, settle

# Kinds in the order they are listed where spans start together. The first three
# are reported wherever they stand, the others only beside their counterparts.
KINDS = ["assign", "access", "hex", "user", "key", "endpoint"]
BASE = 3
ASSIGN, ACCESS, HEX, USER, KEY, ENDPOINT = range(6)

_ASSIGN = re.compile(
    r"""(?:password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""",
    re.ASCII | re.IGNORECASE,
)
_ASSIGN_WORDS = re.compile(rb"passw|secret|token|api_?key")
_ACCESS = re.compile(r"AKIA[A-Z0-9]+")
_HEX = re.compile(r"[0-9a-f]{24,}")
_USER = re.compile(
    r"""\b(?:user(?:name)?|login|account|client_?id)["']?\x20*[:=]\x20*["']?[A-Za-z0-9@._+-]{3,}""",
    re.ASCII | re.IGNORECASE,
)
_USER_WORDS = re.compile(rb"user|login|account|client_?id")
_KEY = re.compile(r"(?<![A-Za-z0-9/+])[A-Za-z0-9/+]{40}(?![A-Za-z0-9/+=])")
_ENDPOINT = re.compile(r"""\b[a-z][a-z0-9+.-]{1,20}://[^\s"'<>]+""", re.ASCII)
_HEX_CLASS = bytes(120 if chr(c) in "0123456789abcdef" else 46 for c in range(256))
SPAN = "struct<start:bigint,kind:int,end:bigint>"


def base_spans(text: str) -> list[tuple[int, int, int]]:
    """``(start, kind, end)`` of the kinds that need nothing beside them."""
    raw = text.encode()
    spans = []
    if _ASSIGN_WORDS.search(raw.lower()):
        spans += [(m.start(), ASSIGN, m.end()) for m in _ASSIGN.finditer(text)
                  if len(m.group(1)) >= 6]
    if b"AKIA" in raw:
        spans += [(m.start(), ACCESS, m.end()) for m in _ACCESS.finditer(text)
                  if m.end() - m.start() >= 20]
    if b"x" * 24 in raw.translate(_HEX_CLASS):
        spans += [(m.start(), HEX, m.end()) for m in _HEX.finditer(text)]
    return sorted(spans)


def _mixed(key: str) -> bool:
    return any(c.isdigit() for c in key) and any(c.islower() for c in key) and any(
        c.isupper() for c in key)


def weak_spans(text: str, base: list[tuple[int, int, int]]) -> list[tuple[int, int, int]]:
    """Candidates that count only beside others: users, bare keys, endpoints.

    Without an access id or a user there is nothing to complement, so then the
    rest is not looked for.
    """
    users = []
    if _USER_WORDS.search(text.encode().lower()):
        users = [(m.start(), USER, m.end()) for m in _USER.finditer(text)]
    if not users and all(kind != ACCESS for _, kind, _ in base):
        return []
    keys = [(m.start(), KEY, m.end()) for m in _KEY.finditer(text) if _mixed(m.group())]
    ends = [(m.start(), ENDPOINT, m.end()) for m in _ENDPOINT.finditer(text)]
    return users + keys + ends


def detect(docs: DataFrame, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """``(doc_id, row key, base, weak)`` of every row, one pass over whole texts."""
    span = pa.struct([("start", pa.int64()), ("kind", pa.int32()), ("end", pa.int64())])

    def column(spans: list[list[tuple[int, int, int]]]) -> pa.Array:
        return pa.array([[{"start": a, "kind": k, "end": b} for a, k, b in row] for row in spans],
                        pa.list_(span))

    def of_batches(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = [t.as_py() or "" for t in batch.column(3)]
            base = [base_spans(t) for t in texts]
            weak = [weak_spans(t, b) for t, b in zip(texts, base)]
            yield pa.RecordBatch.from_arrays(
                [*batch.columns[:3], column(base), column(weak)],
                ["doc_id", *ROW_KEY, "base", "weak"],
            )

    kind = docs.schema[doc_id].dataType.simpleString()
    return docs.select(
        F.col(doc_id).alias("doc_id"), *row_key(doc_id, text), F.col(text).cast("string")
    ).mapInArrow(of_batches, (
        f"doc_id {kind}, _id string, _text_hash bigint, base array<{SPAN}>, weak array<{SPAN}>"
    ))


def linked(found: DataFrame, reach: int = 300) -> DataFrame:
    """Weak candidates with what complements them within ``reach`` characters.

    A key needs an access id or a user, a user needs a secret, an endpoint needs both an id
    and a secret. Secrets are keys, assignments and long hex runs. The join is by row and by stretches of
    ``reach`` characters: a candidate, widened by the reach, meets what starts in
    its stretches or reaches into them. A stretch holds no more candidates than
    characters fit in, so a text with very many costs in proportion to its length.
    """
    parts = found.where(F.size("weak") > 0).select(
        *ROW_KEY, F.explode(F.concat("base", "weak")).alias("_p")
    ).select(*ROW_KEY, "_p.*").distinct()

    def stretches(first: Column, last: Column) -> Column:
        return F.explode(F.sequence(F.floor(first / reach), F.floor(last / reach)))

    weak = parts.where(F.col("kind") >= BASE).withColumn(
        "stretch", stretches(F.greatest(F.col("start") - reach, F.lit(0)), F.col("end") + reach)
    )
    others = parts.where(F.col("kind") != ENDPOINT).select(
        *ROW_KEY, F.col("kind").alias("_kind"), F.col("start").alias("_start"),
        F.col("end").alias("_end"),
    ).withColumn("stretch", stretches(F.col("_start"), F.col("_end")))
    near = (F.col("_start") <= F.col("end") + reach) & (F.col("_end") >= F.col("start") - reach)
    has_id = F.max(F.col("_kind").isin(ACCESS, USER))
    has_secret = F.max(F.col("_kind").isin(ASSIGN, HEX, KEY))
    met = (
        weak.join(others, [*ROW_KEY, "stretch"])
        .where(near)
        .groupBy(*ROW_KEY, "start", "kind", "end")
        .agg(has_id.alias("id"), has_secret.alias("secret"))
    )
    fits = (
        F.when(F.col("kind") == KEY, F.col("id"))
        .when(F.col("kind") == USER, F.col("secret"))
        .otherwise(F.col("id") & F.col("secret"))
    )
    return met.where(fits).select(*ROW_KEY, F.struct("start", "kind", "end").alias("span"))


def spans_text(spans: Column) -> Column:
    """``kind:start:end`` of sorted spans, comma-joined."""
    names = F.array(*[F.lit(k) for k in KINDS])
    return F.array_join(F.transform(spans, lambda s: F.concat_ws(
        ":", F.element_at(names, s["kind"] + 1), s["start"], s["end"])), ",")


def scan(docs: DataFrame, doc_id: str = "doc_id", text: str = "text",
         reach: int = 300) -> DataFrame:
    """``(doc_id, base, spans)`` of every row; positions are code points, ends exclusive.

    ``base`` holds assignments, access ids and long hex runs; ``spans`` adds the weak
    candidates that ``linked`` confirms. Both are sorted by start, then kind. Null
    texts are empty, repeated rows get the same spans and stay repeated.
    """
    found = settle(detect(docs, doc_id, text), "secret-parts")
    more = settle(
        linked(found, reach).groupBy(*ROW_KEY).agg(F.collect_list("span").alias("linked")),
        "linked-parts",
    )
    none = F.array().cast(f"array<{SPAN}>")
    return found.join(more, ROW_KEY, "left").select(
        "doc_id", "base",
        F.array_sort(F.concat("base", F.coalesce("linked", none))).alias("spans"),
    )


def n_of(kind: int) -> Column:
    return F.size(F.filter("base", lambda s: s["kind"] == kind)).cast("long")
