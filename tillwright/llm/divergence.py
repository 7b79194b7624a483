"""How far the sources of a language are apart in the terms they use.

``CountVectorizer`` models learn the terms of each language; the documents' sparse vectors
over them are summed by group, and the sums are compared pair by pair over the terms that occur.
"""

from __future__ import annotations

from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.ml.feature import CountVectorizer
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tillwright.llm.common import settle

# What parts terms, as blanks; A-Z as a-z; all other bytes of UTF-8 belong to terms.
_TERM_BYTES = bytes(
    c + 32 if 65 <= c <= 90 else c if 97 <= c <= 122 or c >= 128 else 32 for c in range(256)
)
# Terms a batch is sent on with.
_AT_ONCE = 1 << 18
# Stands between a language and a term; no term holds it.
_MARK = "\0"
_EVERY_TERM = 2**31 - 1
# Shares are whole numbers out of this, and every count is raised by the second (fixed values).
_WHOLE, _RAISE = 10**9, 2
BLOCK_TERMS = 1 << 22


def document_terms(docs: DataFrame, text: str = "text", lang: str = "lang",
                   source: str = "source") -> DataFrame:
    """``(lang, source, tokens, counts)`` of every row; nulls are empty.

    ``tokens`` are the different terms, each marked by the language, ``counts`` how often
    the text has them.
    """

    def of_batches(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            start, ends, tokens, counts = 0, [0], [], []
            for row, (name, value) in enumerate(zip(batch.column(0), batch.column(2))):
                own = Counter(value.as_py().encode().translate(_TERM_BYTES).split())
                mark = (name.as_py() + _MARK).encode()
                tokens += [mark + t for t in own]
                counts += own.values()
                ends.append(len(tokens))
                if len(tokens) >= _AT_ONCE or row == len(batch) - 1:
                    rows, offsets = batch.slice(start, row + 1 - start), pa.array(ends, pa.int32())
                    marked = pa.array(tokens, pa.binary()).cast(pa.string())
                    yield pa.RecordBatch.from_arrays(
                        [rows.column(0), rows.column(1), pa.ListArray.from_arrays(offsets, marked),
                         pa.ListArray.from_arrays(offsets, pa.array(counts, pa.int64()))],
                        ["lang", "source", "tokens", "counts"])
                    start, ends, tokens, counts = row + 1, [0], [], []

    plain = [F.coalesce(F.col(f"`{c}`").cast("string"), F.lit("")).alias(c)
             for c in (lang, source, text)]
    return docs.select(*plain).mapInArrow(
        of_batches, "lang string, source string, tokens array<string>, counts array<bigint>"
    )


def _tokens(documents: DataFrame, block_terms: int) -> tuple[DataFrame, int]:
    """The documents with terms, their terms dealt into blocks, and the number of blocks.

    A model's vocabulary is held by the driver and by every executor. So terms are
    dealt by hash into blocks of some ``block_terms`` different ones, of which a model
    keeps fewer; a document is a row in each block that it has terms of.
    """
    held = documents.where(F.size("tokens") > 0)
    different = held.select(F.explode("tokens").alias("t")).agg(
        F.approx_count_distinct("t").alias("n")
    ).first().n
    blocks = max(1, -(-different // block_terms))
    if blocks == 1:
        return held.withColumn("block", F.lit(0)), 1
    pairs = F.arrays_zip("tokens", "counts")
    dealt = F.transform(
        F.sequence(F.lit(0), F.lit(blocks - 1)),
        lambda b: F.struct(b.alias("block"), F.filter(
            pairs, lambda x: F.pmod(F.xxhash64(x["tokens"]), F.lit(blocks)) == b).alias("held")),
    )
    by_block = held.select("lang", "source", F.explode(dealt).alias("part")).select(
        "lang", "source", "part.block", F.col("part.held.tokens").alias("tokens"),
        F.col("part.held.counts").alias("counts"))
    return settle(by_block.where(F.size("tokens") > 0), "term-blocks", by=["block"]), blocks


def vector_sums(documents: DataFrame, vocabulary: list[str]) -> DataFrame:
    """``(lang, source, place, n)``: the documents' vectors over the vocabulary, summed by group.

    A document's vector has its count of each term at the term's place, and no entry for
    terms the vocabulary lacks. Vectors are added up within a batch of documents first.
    """
    shared = documents.sparkSession.sparkContext.broadcast(vocabulary)

    def of_batches(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        words = pa.array(shared.value, pa.string())
        for batch in batches:
            groups: dict[tuple, int] = {}
            codes = np.array([groups.setdefault(g, len(groups)) for g in zip(
                batch.column(0).to_pylist(), batch.column(1).to_pylist())], np.int64)
            code = np.repeat(codes, np.diff(batch.column(2).offsets.to_numpy()))
            at = pc.index_in(batch.column(2).flatten(), value_set=words)
            in_vector = pc.is_valid(at).to_numpy(zero_copy_only=False)
            cells = code[in_vector] * len(words) + at.drop_null().to_numpy()
            order = np.argsort(cells)
            cells, counts = cells[order], batch.column(3).flatten().to_numpy()[in_vector][order]
            first = np.flatnonzero(np.concatenate(([True], cells[1:] != cells[:-1]))[:len(cells)])
            sums = np.add.reduceat(counts, first) if len(first) else counts
            found = cells[first]
            langs, sources = zip(*groups) if groups else ((), ())
            code = pa.array(found // max(1, len(words)))
            yield pa.RecordBatch.from_arrays(
                [pa.array(langs, pa.string()).take(code), pa.array(sources, pa.string()).take(code),
                 pa.array((found % max(1, len(words))).astype(np.int32)), pa.array(sums, pa.int64())],
                ["lang", "source", "place", "n"],
            )

    vectors = documents.select("lang", "source", "tokens", "counts").mapInArrow(
        of_batches, "lang string, source string, place int, n bigint")
    return vectors.groupBy("lang", "source", "place").agg(F.sum("n").alias("n"))


def _named(sums: DataFrame, vocabulary: list[str]) -> DataFrame:
    """``(lang, source, term, n)``: terms in place of their places."""
    shared = sums.sparkSession.sparkContext.broadcast(vocabulary)

    def of_batches(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        words = pa.array((w.rpartition(_MARK)[2] for w in shared.value), pa.string())
        for batch in batches:
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), batch.column(1), words.take(batch.column(2)), batch.column(3)],
                ["lang", "source", "term", "n"])

    return sums.mapInArrow(of_batches, "lang string, source string, term string, n bigint")


def group_counts(documents: DataFrame, least_docs: int = 10,
                 block_terms: int = BLOCK_TERMS) -> DataFrame:
    """``(lang, source, term, n)`` of the kept terms that occur in a group.

    A language keeps the terms in at least ``least_docs`` of its documents. One model
    per block learns the vocabulary of all languages, each term marked by its language,
    without a limit to its size; the documents' vectors over it are summed by group, entry
    by entry, first within each batch, so that a group with most of the documents costs no more.
    """
    spark = documents.sparkSession
    tokens, blocks = _tokens(documents, block_terms)
    # A model must keep something: this token is in just enough documents, and in none of ours.
    anchor = spark.range(least_docs).select(F.array(F.lit("")).alias("tokens"))
    sums = []
    for block in range(blocks):
        own = tokens.where(F.col("block") == block)
        # How often a document has a term does not matter to the vocabulary.
        vocabulary = CountVectorizer(
            inputCol="tokens", outputCol="vector", minDF=float(least_docs), vocabSize=_EVERY_TERM
        ).fit(own.select("tokens").union(anchor)).vocabulary
        sums.append(settle(_named(vector_sums(own, vocabulary), vocabulary), "group-sums"))
    whole = sums[0]
    for part in sums[1:]:
        whole = whole.union(part)
    return whole


def _share(n: Column, total: Column, terms: Column) -> Column:
    """``1 + 10^9 * (n + 2) div (total + 2 * terms)``, in decimals as counts may be huge."""
    top = (n + F.lit(_RAISE)).cast("decimal(28,0)") * F.lit(_WHOLE).cast("decimal(10,0)")
    below = (total + F.lit(_RAISE) * terms).cast("decimal(28,0)")
    return F.when(below > 0, F.lit(1) + F.call_function("div", top, below)).otherwise(F.lit(1))


def _f(p: str, q: str) -> Column:
    return F.expr(f"(({p} - {q}) * ({p} - {q})) div ({p} + {q})")


def divergence(docs: DataFrame, text: str = "text", lang: str = "lang", source: str = "source",
               least_docs: int = 10, top: int = 10,
               block_terms: int = BLOCK_TERMS) -> DataFrame:
    """``(lang, source, part, item, value, rank)``: the audit of every group.

    Part ``pair`` compares a group with each other source of its language; ``value``
    sums ``(p - q)^2 div (p + q)`` over all kept terms, with shares p and q in
    thousand millionths. Part ``term`` names the ``top`` terms that a group uses more
    than its language does. Equal values rank by item.

    The sum over a pair's terms is split by where they occur. A term that one of them
    lacks has there the share of a count of 0, so such terms depend on their count
    alone and are added up from a histogram of counts per group; terms that both lack
    add the same number each. Only terms that both have are joined.

    Null texts, languages and sources are ''. A group without terms takes part with
    counts of 0; without any kept term in a language its pairs have the value 0.
    Repeated rows count each time. An empty table gives an empty result.
    """
    documents = settle(document_terms(docs, text, lang, source), "document-terms")
    counts = group_counts(documents, least_docs, block_terms)
    term = Window.partitionBy("lang", "term")
    kept = settle(counts.select(
        "*", F.sum("n").over(term).alias("lang_n"),
        F.when(F.row_number().over(term.orderBy("source")) == 1, 1).otherwise(0).alias("first"),
    ), "kept-terms")
    langs = kept.groupBy("lang").agg(
        F.sum("n").alias("lang_total"), F.sum("first").alias("terms")
    )
    groups = settle(
        documents.select("lang", "source").distinct()
        .join(kept.groupBy("lang", "source").agg(
            F.sum("n").alias("total"), F.count(F.lit(1)).alias("held")), ["lang", "source"], "left")
        .join(langs, "lang", "left")
        .select("lang", "source", *[F.coalesce(c, F.lit(0)).alias(c)
                                    for c in ("total", "held", "lang_total", "terms")])
        .withColumn("p0", _share(F.lit(0), F.col("total"), F.col("terms"))), "groups",
    )
    shares = settle(
        kept.join(groups, ["lang", "source"]).select(
            "lang", "source", "term", "p0",
            _share(F.col("n"), F.col("total"), F.col("terms")).alias("p"),
            _share(F.col("lang_n"), F.col("lang_total"), F.col("terms")).alias("q"),
        ), "shares",
    )
    return _pairs(groups, shares).unionByName(_terms(shares, top))


def _ranked(rows: DataFrame, part: str) -> DataFrame:
    order = Window.partitionBy("lang", "source").orderBy(F.desc("value"), F.asc("item"))
    return rows.select("lang", "source", F.lit(part).alias("part"), "item", "value",
                       F.row_number().over(order).alias("rank"))


def _pairs(groups: DataFrame, shares: DataFrame) -> DataFrame:
    """Every two sources of a language, each as seen from the other."""
    other = groups.select("lang", F.col("source").alias("item"), F.col("p0").alias("item_p0"),
                          F.col("held").alias("item_held"))
    pairs = groups.join(other, "lang").where("source != item")
    # What a group's own terms add where the other lacks them all.
    histogram = shares.groupBy("lang", "source", "p").agg(F.count(F.lit(1)).alias("n"))
    alone = (
        histogram.join(other, "lang").where("source != item")
        .groupBy("lang", "source", "item").agg(F.sum(F.col("n") * _f("p", "item_p0")).alias("own"))
    )
    # What changes where both have a term, from each pair once.
    right = shares.select("lang", "term", F.col("source").alias("item"), F.col("p").alias("item_p"),
                          F.col("p0").alias("item_p0"))
    both = (
        shares.join(right, ["lang", "term"]).where("source < item")
        .groupBy("lang", "source", "item").agg(
            F.count(F.lit(1)).alias("n_both"),
            F.sum(_f("p", "item_p") - _f("p", "item_p0") - _f("p0", "item_p")).alias("change"),
        )
    )
    flipped = [F.col("source").alias("item"), F.col("item").alias("source")]
    both = both.unionByName(both.select("lang", *flipped, "n_both", "change"))
    theirs = alone.select("lang", *flipped, F.col("own").alias("theirs"))
    key = ["lang", "source", "item"]
    none = F.lit(0).cast("bigint")
    joined = pairs.join(alone, key, "left").join(theirs, key, "left").join(both, key, "left")
    lacked = F.col("terms") - F.col("held") - F.col("item_held") + F.coalesce("n_both", none)
    value = (
        F.coalesce("own", none) + F.coalesce("theirs", none) + F.coalesce("change", none)
        + lacked * _f("p0", "item_p0")
    )
    return _ranked(joined.withColumn("value", value), "pair")


def _terms(shares: DataFrame, top: int) -> DataFrame:
    """The terms a group uses more than its language, first by what they add."""
    more = shares.where("p > q").select(
        "lang", "source", F.col("term").alias("item"), _f("p", "q").alias("value")
    )
    return _ranked(more, "term").where(F.col("rank") <= top)
