"""Language of a text by naive Bayes over hashed character n-grams."""

from __future__ import annotations

import sys
import unicodedata
from collections.abc import Iterator
from dataclasses import dataclass
from functools import cache

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tillwright.llm.common import settle

ORDERS = (1, 2, 3)
UNDETERMINED = "und"
# N-grams worked on at a time.
_AT_ONCE = 1 << 18
_FACTOR = np.uint64(0x9E3779B97F4A7C15)
_MAX_MATRIX_BYTES = 128 << 20


@cache
def letters() -> np.ndarray:
    """For each code point the lower-case letter it stands for, or 0."""
    out = np.zeros(sys.maxunicode + 1, np.uint32)
    for code in range(sys.maxunicode + 1):
        letter = chr(code)
        if unicodedata.category(letter)[0] == "L":
            lower = letter.lower()
            out[code] = ord(lower) if len(lower) == 1 else code
    return out


def _folded(text: str) -> np.ndarray:
    """Lower-case letters of a text, with one 0 for whatever stands between and around."""
    codes = letters()[np.frombuffer(text.encode("utf-32-le"), np.uint32)]
    codes = np.concatenate(([0], codes, [0]))
    return codes[np.concatenate(([True], (codes[1:] != 0) | (codes[:-1] != 0)))]


def buckets_of(text: str, buckets: int) -> Iterator[np.ndarray]:
    """Bucket numbers of all n-grams of a text, block by block; a power of two of them.

    An n-gram may hold the gap between words; a gap alone is none.
    """
    codes = _folded(text)
    if len(codes) < 3:  # no letter
        return
    wide = codes.astype(np.uint64)
    for order in ORDERS:
        last = len(wide) - order + 1
        for start in range(0, last, _AT_ONCE):
            end = min(start + _AT_ONCE, last)
            mixed = np.full(end - start, order, np.uint64)
            for shift in range(order):
                mixed = (mixed ^ wide[start + shift : end + shift]) * _FACTOR
                mixed ^= mixed >> np.uint64(29)
            if order == 1:
                mixed = mixed[wide[start:end] != 0]
            yield (mixed >> np.uint64(20)).astype(np.int64) & (buckets - 1)


@dataclass(frozen=True)
class Model:
    """Log probabilities, a row per bucket and a column per language."""

    languages: list[str]
    prior: np.ndarray
    table: np.ndarray

    def scores(self, texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """Log joint probability of each text in each language, and its number of n-grams.

        A batch is the product of a sparse matrix, the n-grams of each text, with the
        table: rows of the table are added up from one text's first n-gram to the next's.
        """
        total = np.tile(self.prior, (len(texts), 1))
        n = np.zeros(len(texts), np.int64)
        rows, parts, held = [], [], 0

        def add() -> None:
            size = [len(p) for p in parts]
            first = np.cumsum(size) - size
            sums = np.add.reduceat(self.table[np.concatenate(parts)], first, axis=0, dtype=np.float64)
            np.add.at(total, rows, sums)

        for row, text in enumerate(texts):
            for found in buckets_of(text, len(self.table)):
                if not len(found):
                    continue
                n[row] += len(found)
                rows.append(row)
                parts.append(found)
                held += len(found)
                if held >= _AT_ONCE:
                    add()
                    rows, parts, held = [], [], 0
        if parts:
            add()
        return total, n

    def predict_all(self, texts: list[str | None]) -> list[tuple[str, float]]:
        """The likeliest language of each text and its posterior probability; ties take the
        first by name."""
        if not self.languages:
            return [(UNDETERMINED, 0.0)] * len(texts)
        total, n = self.scores([t or "" for t in texts])
        best = total.argmax(axis=1)
        sure = 1.0 / np.exp(total - total.max(axis=1, keepdims=True)).sum(axis=1)
        return [(self.languages[b], float(s)) if held else (UNDETERMINED, 0.0)
                for b, s, held in zip(best.tolist(), sure.tolist(), n.tolist())]

    def predict(self, text: str | None) -> tuple[str, float]:
        return self.predict_all([text])[0]


def _count_batches(buckets: int):
    def of_batches(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        # Counts of a task: languages times buckets numbers, however many texts.
        counts: dict[str, np.ndarray] = {}
        for batch in batches:
            for lang, text in zip(batch.column(0).to_pylist(), batch.column(1)):
                own = counts.setdefault(lang, np.zeros(buckets + 1, np.int64))
                own[buckets] += 1
                for found in buckets_of(text.as_py() or "", buckets):
                    own[:buckets] += np.bincount(found, minlength=buckets)
        for lang, own in counts.items():
            at = np.flatnonzero(own)
            yield pa.RecordBatch.from_arrays(
                [pa.array([lang] * len(at), pa.string()), pa.array(at), pa.array(own[at])],
                ["lang", "bucket", "n"],
            )

    return of_batches


def train(docs: DataFrame, text: str = "text", lang: str = "lang", buckets: int = 1 << 15,
          smoothing: float = 0.5) -> Model:
    """Fit on every row with a language and a text; the driver gets sums per bucket alone.

    Counts are formed per task and added up by language and bucket, so what is
    shuffled and collected is bounded by languages times buckets, whatever the
    corpus. The matrix may take ``_MAX_MATRIX_BYTES``; more languages than that
    allows are an error that asks for fewer buckets.
    """
    labelled = docs.where(F.col(lang).isNotNull() & F.col(text).isNotNull()).select(
        F.col(lang).cast("string"), F.col(text).cast("string")
    )
    # Asked for twice, computed once.
    counted = settle(labelled.mapInArrow(
        _count_batches(buckets), "lang string, bucket bigint, n bigint"
    ).groupBy("lang", "bucket").agg(F.sum("n").alias("n")), "gram-counts")
    languages = [r.lang for r in counted.where(F.col("bucket") == buckets).select("lang")
                 .orderBy("lang").limit(_MAX_MATRIX_BYTES // (8 * buckets) + 1).collect()]
    if len(languages) * buckets * 8 > _MAX_MATRIX_BYTES:
        raise ValueError(f"too many languages for {buckets} buckets; use fewer buckets")
    column = {name: i for i, name in enumerate(languages)}
    sums = np.zeros((buckets + 1, len(languages)))
    for batch in counted.toArrow().to_batches():
        at = [column[name] for name in batch.column(0).to_pylist()]
        sums[batch.column(1).to_numpy(), at] = batch.column(2).to_numpy()
    prior = np.log(sums[buckets] / max(1.0, sums[buckets].sum()))
    table = sums[:buckets] + smoothing
    return Model(languages, prior, np.log(table / table.sum(axis=0)).astype(np.float32))


def predict(docs: DataFrame, model: Model, doc_id: str = "doc_id",
            text: str = "text") -> DataFrame:
    """``(doc_id, lang_pred, score)`` of every row; one pass, the model is broadcast.

    Whole texts are scored. ``score`` is the posterior probability. A text that is
    null or has no letter is ``und`` with score 0; so is every text if the model
    has learned no language. Repeated rows stay repeated.
    """
    shared = docs.sparkSession.sparkContext.broadcast(model)

    def of_batches(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = shared.value.predict_all(batch.column(1).to_pylist())
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array([x[0] for x in found], pa.string()),
                 pa.array([x[1] for x in found], pa.float64())],
                ["doc_id", "lang_pred", "score"],
            )

    kind = docs.schema[doc_id].dataType.simpleString()
    return docs.select(F.col(doc_id).alias("doc_id"), F.col(text).cast("string")).mapInArrow(
        of_batches, f"doc_id {kind}, lang_pred string, score double"
    )


def held_out(doc_id: str = "doc_id") -> Column:
    """The quarter of the ids that nothing is learned from; null ids are not in it."""
    return F.coalesce(F.crc32(F.col(doc_id).cast("string").cast("binary")) % 4 == 2, F.lit(False))
