"""Benchmark passages in training texts, found with a generalised suffix automaton."""

from __future__ import annotations

import itertools
from collections.abc import Iterable, Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tillwright.llm.common import ROW_KEY, row_key

# A-Z become lower case; ASCII other than letters and digits separates words.
_WORDS = bytes(
    c + 32 if 65 <= c <= 90 else c if c >= 128 or chr(c).isalnum() else 32 for c in range(256)
)
# Test items that may be broadcast in all, block by block.
MOST_ITEM_BYTES = 256 << 20
SPANS = "array<struct<start:bigint,end:bigint>>"


def words_of(text: bytes) -> list[bytes]:
    return text.translate(_WORDS).split()


class Automaton:
    """Suffix automaton of many word sequences, with the items of each window.

    ``window`` consecutive words of an item make a window; an item with fewer
    words, but not none, is one window.
    """

    def __init__(self, items: Iterable[tuple[str, list[bytes]]], window: int):
        self.window = window
        self.codes: dict[bytes, int] = {}
        self.follow: list[dict[int, int]] = [{}]
        self.link, self.longest = [-1], [0]
        coded = [(name, [self.codes.setdefault(w, len(self.codes)) for w in words])
                 for name, words in items if words]
        for _, word_codes in coded:
            at = 0
            for code in word_codes:
                at = self._grow(at, code)
        self.shortest = min([window, *(len(word_codes) for _, word_codes in coded)])
        self._mark(coded)

    def _state(self, follow: dict[int, int], link: int, longest: int) -> int:
        self.follow.append(follow)
        self.link.append(link)
        self.longest.append(longest)
        return len(self.link) - 1

    def _split(self, parent: int, code: int, child: int) -> int:
        """The state for the words up to ``parent`` plus ``code`` alone."""
        if self.longest[child] == self.longest[parent] + 1:
            return child
        copy = self._state(dict(self.follow[child]), self.link[child], self.longest[parent] + 1)
        self.link[child] = copy
        while parent >= 0 and self.follow[parent].get(code) == child:
            self.follow[parent][code] = copy
            parent = self.link[parent]
        return copy

    def _grow(self, last: int, code: int) -> int:
        known = self.follow[last].get(code)
        if known is not None:  # an earlier item has these words too
            return self._split(last, code, known)
        new = self._state({}, 0, self.longest[last] + 1)
        while last >= 0 and code not in self.follow[last]:
            self.follow[last][code] = new
            last = self.link[last]
        if last >= 0:
            self.link[new] = self._split(last, code, self.follow[last][code])
        return new

    def _mark(self, coded: list[tuple[str, list[int]]]) -> None:
        """Find each state's window state, its items, and the short items it ends with."""
        count, window = len(self.link), self.window
        self.top = [-1] * count
        for state in sorted(range(1, count), key=self.longest.__getitem__):
            if self.longest[state] >= window:
                over = self.longest[self.link[state]] >= window
                self.top[state] = self.top[self.link[state]] if over else state
        self.owners: dict[int, set[str]] = {}
        short: dict[int, list[tuple[int, str]]] = {}
        for name, word_codes in coded:
            state = 0
            for length, code in enumerate(word_codes, 1):
                state = self.follow[state][code]
                if length >= window:
                    self.owners.setdefault(self.top[state], set()).add(name)
            if len(word_codes) < window:
                short.setdefault(state, []).append((len(word_codes), name))
        # Short items on the way from each state to the root.
        self.endings: dict[int, list[tuple[int, str]]] = {}
        if short:
            for state in sorted(range(1, count), key=self.longest.__getitem__):
                ends = short.get(state, []) + self.endings.get(self.link[state], [])
                if ends:
                    self.endings[state] = ends

    def scan(self, words: list[bytes]) -> tuple[list[tuple[int, int]], set[str], int]:
        """Hit spans (word positions, end exclusive), items, and the longest match.

        Matches shorter than every window are of no use; words that no item has
        end a match, so only long enough runs of known words are walked.
        """
        n = len(words)
        if n < self.shortest:
            return [], set(), 0
        codes = np.fromiter(map(self.codes.get, words, itertools.repeat(-1)), np.int64, n)
        edges = np.flatnonzero(np.diff(np.concatenate(([False], codes >= 0, [False]))))
        spans: list[tuple[int, int]] = []
        tops: set[int] = set()
        items: set[str] = set()
        most = 0
        for start, end in zip(edges[::2].tolist(), edges[1::2].tolist()):
            if end - start >= self.shortest:
                most = max(most, self._walk(codes[start:end].tolist(), start, spans, tops, items))
        for top in tops:
            items |= self.owners[top]
        return merged(spans), items, most

    def _walk(self, codes, start, spans, tops, items) -> int:
        follow, link, longest, window = self.follow, self.link, self.longest, self.window
        endings = self.endings
        state = length = most = 0
        for end, code in enumerate(codes, start + 1):
            onward = follow[state].get(code)
            if onward is None:
                while onward is None:
                    state = link[state]
                    onward = follow[state].get(code)
                length = longest[state]
            state, length = onward, length + 1
            if length > most:
                most = length
            if length >= window:
                spans.append((end - window, end))
                tops.add(self.top[state])
            if endings:
                for size, name in endings.get(state, ()):
                    if size <= length:
                        spans.append((end - size, end))
                        items.add(name)
        return most


def merged(spans: Iterable[tuple[int, int]]) -> list[tuple[int, int]]:
    """Spans without overlaps or seams, in order."""
    out: list[list[int]] = []
    for start, end in sorted(spans):
        if out and start <= out[-1][1]:
            out[-1][1] = max(out[-1][1], end)
        else:
            out.append([start, end])
    return [tuple(s) for s in out]


def item_blocks(benchmark: DataFrame, item_id: str, text: str,
                block_bytes: int) -> Iterator[list[tuple[str, bytes]]]:
    """Items in blocks of about ``block_bytes`` of text, fetched a partition at a time.

    More than ``MOST_ITEM_BYTES`` of them are an error: then it is no benchmark.
    """
    block, size, total = [], 0, 0
    rows = benchmark.select(F.col(item_id).cast("string"), F.col(text).cast("binary"))
    for name, body in rows.toLocalIterator():
        if name is None or not body:
            continue
        block.append((name, bytes(body)))
        size += len(body)
        total += len(body)
        if total > MOST_ITEM_BYTES:
            raise ValueError(f"more than {MOST_ITEM_BYTES} bytes of test items")
        if size >= block_bytes:
            yield block
            block, size = [], 0
    if block:
        yield block


def _scan_block(docs: DataFrame, items: list[tuple[str, bytes]], window: int,
                doc_id: str, text: str) -> DataFrame:
    shared = docs.sparkSession.sparkContext.broadcast(items)

    def of_batches(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        automaton = Automaton(((name, words_of(body)) for name, body in shared.value), window)
        for batch in batches:
            texts = batch.column(3).cast(pa.binary())
            found = []
            for value in texts:
                words = words_of(value.as_py() or b"")
                found.append((len(words), *automaton.scan(words)))
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column(0), batch.column(1), batch.column(2),
                    pa.array([x[0] for x in found], pa.int64()),
                    pa.array([[{"start": a, "end": b} for a, b in x[1]] for x in found],
                             pa.list_(pa.struct([("start", pa.int64()), ("end", pa.int64())]))),
                    pa.array([sorted(x[2]) for x in found], pa.list_(pa.string())),
                    pa.array([x[3] for x in found], pa.int64()),
                ],
                ["doc_id", *ROW_KEY, "n_words", "spans", "items", "longest"],
            )

    kind = docs.schema[doc_id].dataType.simpleString()
    return docs.select(
        F.col(doc_id).alias("doc_id"), *row_key(doc_id, text), F.col(text).cast("string")
    ).mapInArrow(of_batches, (
        f"doc_id {kind}, _id string, _text_hash bigint, n_words bigint, spans {SPANS}, "
        "items array<string>, longest bigint"
    ))


def _union_of_blocks(parts: list[DataFrame]) -> DataFrame:
    """One row per input row from a row per block; repeated rows stay as many."""
    rows = parts[0]
    for part in parts[1:]:
        rows = rows.unionByName(part)

    @F.pandas_udf(SPANS)
    def union(many: pd.Series) -> pd.Series:
        return many.map(lambda spans: [
            {"start": a, "end": b} for a, b in merged((s["start"], s["end"]) for s in spans)
        ])

    return (
        rows.groupBy("doc_id", *ROW_KEY)
        .agg(
            F.first("n_words").alias("n_words"),
            F.flatten(F.collect_set("spans")).alias("spans"),
            F.array_sort(F.array_distinct(F.flatten(F.collect_set("items")))).alias("items"),
            F.max("longest").alias("longest"),
            (F.count(F.lit(1)) / len(parts)).cast("int").alias("_times"),
        )
        .withColumn("spans", union("spans"))
        .withColumn("_times", F.explode(F.sequence(F.lit(1), "_times")))
        .drop("_times")
    )


def find_passages(docs: DataFrame, benchmark: DataFrame, window: int = 10,
                  doc_id: str = "doc_id", text: str = "text", item_id: str = "item_id",
                  item_text: str = "text", block_bytes: int = 4 << 20) -> DataFrame:
    """Where texts hold windows of test items, a row per input row.

    Columns: the id, the row key, ``n_words``, merged hit ``spans`` of word
    positions, ``items`` that occur (sorted text), ``longest`` match in words (0 if
    below the shortest window). Test items come to the executors in blocks of
    about ``block_bytes``, each as one broadcast and one pass over the texts, so
    memory does not grow with the benchmark; one block is the usual case and
    needs no shuffle. Null texts have no words, items with null id or text are left
    out, repeated item ids count as one item, empty tables give no hits or rows.
    """
    parts = [
        _scan_block(docs, block, window, doc_id, text)
        for block in item_blocks(benchmark, item_id, item_text, block_bytes)
    ] or [_scan_block(docs, [], window, doc_id, text)]
    return parts[0] if len(parts) == 1 else _union_of_blocks(parts)


def n_hit(spans: str = "spans"):
    return F.aggregate(spans, F.lit(0).cast("long"), lambda n, s: n + s["end"] - s["start"])


def items_digest(items: str = "items"):
    """SHA-256 of the sorted item ids, comma-joined."""
    return F.sha2(F.array_join(items, ","), 256)


def cut_spans(text: str, spans: list[tuple[int, int]]) -> str:
    """The text without the words of ``spans``, and without what stands between them.

    A space stands where words were cut between others.
    """
    raw = text.encode()
    mask = np.frombuffer(raw.translate(_WORDS), np.uint8) != 32
    edges = np.flatnonzero(np.diff(np.concatenate(([False], mask, [False]))))
    starts, ends = edges[::2], edges[1::2]
    out, at = [], 0
    for first, last in spans:
        out.append(raw[at : starts[first]].rstrip())
        at = int(ends[last - 1])
    out.append(raw[at:].lstrip())
    return b" ".join(part for part in out if part).decode()


def remove_passages(docs: DataFrame, benchmark: DataFrame, max_coverage: float = 0.5,
                    window: int = 10, text: str = "text", **settings) -> DataFrame:
    """Rows of ``docs`` without what they share with test items.

    A row goes if more than ``max_coverage`` of its words are hit. Otherwise its hit
    spans are cut out, again and again while what is left still has a window (words
    that come together by a cut can make one; the limit holds for each round). Other
    rows stay as they are, null and empty texts among them. Nothing is shuffled.
    """
    blocks = list(item_blocks(benchmark, settings.get("item_id", "item_id"),
                              settings.get("item_text", "text"),
                              settings.get("block_bytes", 4 << 20)))
    shared = [docs.sparkSession.sparkContext.broadcast(block) for block in blocks]
    at = docs.columns.index(text)

    def built(block) -> Automaton:
        return Automaton(((name, words_of(body)) for name, body in block.value), window)

    def of_batches(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        # With several blocks one automaton is held at a time.
        only = built(shared[0]) if len(shared) == 1 else None
        for batch in batches:
            texts = batch.column(at).to_pylist()
            words = {i: words_of((t or "").encode()) for i, t in enumerate(texts)}
            gone: set[int] = set()
            while words:
                hits: dict[int, list[tuple[int, int]]] = {}
                for block in shared:
                    automaton = only or built(block)
                    for i, found in words.items():
                        if spans := automaton.scan(found)[0]:
                            hits.setdefault(i, []).extend(spans)
                pending = {}
                for i, spans in hits.items():
                    spans = merged(spans)
                    if sum(b - a for a, b in spans) > max_coverage * len(words[i]):
                        gone.add(i)
                    else:
                        texts[i] = cut_spans(texts[i], spans)
                        pending[i] = words_of(texts[i].encode())
                words = pending
            columns = [*batch.columns[:at], pa.array(texts, pa.string()), *batch.columns[at + 1 :]]
            keep = pa.array([i not in gone for i in range(len(texts))], pa.bool_())
            yield pa.RecordBatch.from_arrays(columns, names=batch.schema.names).filter(keep)

    return docs.mapInArrow(of_batches, docs.schema)


