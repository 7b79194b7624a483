"""The best documents for each test item, by branch and bound over tries of documents."""

from __future__ import annotations

import math
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tillwright.llm.common import settle

# What parts terms, as blanks; A-Z as a-z; all other bytes of UTF-8 belong to terms.
_TERM_BYTES = bytes(
    c + 32 if 65 <= c <= 90 else c if 48 <= c <= 57 or 97 <= c <= 122 or c >= 128 else 32
    for c in range(256)
)
# Fixed values of the score.
_FLAT, _SLOPE, _SCALE, _TF, _M = 50, 50, 10**9, 1000, 20
# A tree takes so many documents or vector entries; a block of items so many items and
# cells of terms times items.
_TREE_DOCS, _TREE_ENTRIES = 4096, 1 << 19
_BLOCK_ITEMS, _BLOCK_CELLS = 256, 1 << 23


def terms_of(text: str | None) -> list[bytes]:
    """Terms of a text in order, repeats included."""
    return (text or "").encode().translate(_TERM_BYTES).split()


@dataclass(frozen=True)
class Items:
    """Items of one block: ``columns[term]`` holds the places of the items that have it."""

    ids: list
    columns: dict[bytes, list[int]]


def _as_items(rows: list) -> Items:
    places: dict = {}
    columns: dict[bytes, list[int]] = {}
    for row in rows:
        place = places.setdefault(row.item_id, len(places))
        for term in set(terms_of(row.text)):
            own = columns.setdefault(term, [])
            if not own or own[-1] != place:
                own.append(place)
    return Items(list(places), {t: sorted(set(own)) for t, own in columns.items()})


def item_blocks(items: DataFrame, item_id: str = "item_id", text: str = "text") -> Iterator[Items]:
    """All items, block by block; a block's weights are a matrix of bounded size.

    Items are dealt by hash of their id, so rows with one id are one item.
    """
    plain = items.select(F.col(f"`{item_id}`").alias("item_id"),
                         F.col(f"`{text}`").cast("string").alias("text"))
    size = plain.agg(F.count(F.lit(1)).alias("n"), F.sum(F.octet_length("text")).alias("bytes")).first()
    blocks = max(1, -(-size.n // _BLOCK_ITEMS))
    # No more terms than half the bytes.
    while (size.n / blocks) * ((size.bytes or 0) / 2 / blocks) > _BLOCK_CELLS and blocks < size.n:
        blocks *= 2
    for block in range(blocks if size.n else 0):
        own = plain.where(F.pmod(F.xxhash64(F.col("item_id").cast("string")), F.lit(blocks)) == block)
        found = _as_items(own.collect())
        if found.ids:
            yield found


def vectors(docs: DataFrame, terms: list[bytes], doc_id: str = "doc_id",
            text: str = "text") -> DataFrame:
    """``(doc_id, n, terms, tfs)``: all terms counted, those of the items listed."""
    shared = docs.sparkSession.sparkContext.broadcast({t: i for i, t in enumerate(terms)})

    def of_batches(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known = shared.value
        for batch in batches:
            sizes, ends, held, tfs = [], [0], [], []
            for value in batch.column(1):
                found = terms_of(value.as_py())
                sizes.append(len(found))
                for term, tf in Counter(found).items():
                    at = known.get(term)
                    if at is not None:
                        held.append(at)
                        tfs.append(tf)
                ends.append(len(held))
            offsets = pa.array(ends, pa.int32())
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array(sizes, pa.int64()),
                 pa.ListArray.from_arrays(offsets, pa.array(held, pa.int32())),
                 pa.ListArray.from_arrays(offsets, pa.array(tfs, pa.int64()))],
                ["doc_id", "n", "terms", "tfs"],
            )

    kind = docs.schema[doc_id].dataType.simpleString()
    return docs.select(
        F.col(f"`{doc_id}`").alias("doc_id"), F.col(f"`{text}`").cast("string")
    ).mapInArrow(of_batches, f"doc_id {kind}, n bigint, terms array<int>, tfs array<bigint>")


def weight(total: int, docs: int) -> int:
    return math.floor(1000 * math.log((2 * total + 2) / (2 * docs + 1)))


def _gain(tf: np.ndarray, m) -> np.ndarray:
    return (_SCALE * tf) // (_TF * tf + _M * m)


@dataclass
class Node:
    """Documents that share a path; ``tfs`` are the greatest of each term among them."""

    terms: np.ndarray
    tfs: np.ndarray
    least_m: int
    children: list = field(default_factory=list)
    docs: tuple | None = None


def _leaf(order: list, paths: list, tfs: list, ms: np.ndarray, ids: list) -> Node:
    """Documents with the same terms, with a row of term counts each."""
    own = np.array([tfs[i] for i in order], np.int64).reshape(len(order), -1)
    at = ms[order]
    return Node(np.array(paths[order[0]], np.int64), own.max(axis=0), int(at.min()),
                docs=(own, at, [ids[i] for i in order]))


def _over(children: list[Node]) -> Node:
    """The node above: of each term the greatest count below, and the least m."""
    if len(children) == 1:
        return children[0]
    terms = np.concatenate([c.terms for c in children])
    tfs = np.concatenate([c.tfs for c in children])
    by_term = np.argsort(terms, kind="stable")
    terms, tfs = terms[by_term], tfs[by_term]
    first = np.flatnonzero(np.concatenate(([True], terms[1:] != terms[:-1])))
    return Node(terms[first], np.maximum.reduceat(tfs, first),
                min(c.least_m for c in children), children)


def tree(paths: list[tuple], tfs: list[tuple], ms: np.ndarray, ids: list) -> Node | None:
    """The trie of the documents' terms, most frequent first; stretches without a fork are one node.

    Sorted paths share their first terms with their neighbours, so a fork lies
    between two of them where they part, and one walk with a stack finds all forks.
    """
    order = sorted(range(len(paths)), key=paths.__getitem__)
    # Open nodes from the root down: depth and the children found so far.
    open_nodes: list[tuple[int, list[Node]]] = []
    start = 0
    while start < len(order):
        path = paths[order[start]]
        end = start + 1
        while end < len(order) and paths[order[end]] == path:
            end += 1
        done = _leaf(order[start:end], paths, tfs, ms, ids)
        shared = -1
        if end < len(order):
            after, shared = paths[order[end]], 0
            for a, b in zip(path, after):
                if a != b:
                    break
                shared += 1
        while open_nodes and open_nodes[-1][0] > shared:
            _, children = open_nodes.pop()
            children.append(done)
            done = _over(children)
        if shared >= 0:
            if open_nodes and open_nodes[-1][0] == shared:
                open_nodes[-1][1].append(done)
            else:
                open_nodes.append((shared, [done]))
        else:
            return done
        start = end
    return None


class Best:
    """The best ``top`` documents of each item so far; equal scores keep the lesser id."""

    def __init__(self, items: int, top: int):
        self.top = top
        self.least = np.ones(items, np.int64)  # a score has to reach this
        self.found: list[list] = [[] for _ in range(items)]

    def add(self, item: int, scores: np.ndarray, ids: list) -> None:
        own = self.found[item]
        own.extend(zip((-scores).tolist(), [(i is None, i or 0) for i in ids], ids))
        if len(own) >= 2 * self.top:
            self._cut(item)

    def _cut(self, item: int) -> None:
        own = self.found[item]
        own.sort(key=lambda x: x[:2])
        del own[self.top:]
        if len(own) == self.top:
            self.least[item] = max(1, -own[-1][0])

    def rows(self) -> Iterator[tuple]:
        for item in range(len(self.found)):
            self._cut(item)
            for score, _, doc in self.found[item]:
                yield item, doc, -score


def search(root: Node, weights: np.ndarray, best: Best) -> None:
    """Depth first; a subtree is left by each item that nothing in it can score enough for.

    No document below a node has a term more often, or a smaller m, than the node
    says, and the score grows with the one and falls with the other.
    """
    stack = [(root, np.arange(weights.shape[1]))]
    while stack:
        node, items = stack.pop()
        own = weights[node.terms[:, None], items]
        bound = _gain(node.tfs, node.least_m) @ own
        near = bound >= best.least[items]
        if not near.any():
            continue
        items = items[near]
        if node.docs is None:
            # The child with most documents' terms is looked at first.
            stack.extend((c, items) for c in sorted(node.children, key=lambda c: len(c.terms)))
            continue
        tfs, ms, ids = node.docs
        scores = _gain(tfs, ms[:, None]) @ own[:, near]
        for place, item in enumerate(items.tolist()):
            enough = np.flatnonzero(scores[:, place] >= best.least[item])
            if len(enough):
                best.add(item, scores[enough, place], [ids[i] for i in enough])


def _searched(rows: DataFrame, weights: np.ndarray, place: np.ndarray, total: int, length: int,
              top: int) -> DataFrame:
    """``(item, doc_id, score)``: the best of each task for each item."""
    shared = rows.sparkSession.sparkContext.broadcast((weights, place))
    kind = rows.schema["doc_id"].dataType.simpleString()

    def of_batches(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        weights, place = shared.value
        best = Best(weights.shape[1], top)
        paths, counts, ms, ids, entries = [], [], [], [], 0
        out = None

        def grow() -> None:
            root = tree(paths, counts, np.array(ms, np.int64), ids)
            if root is not None:
                search(root, weights, best)
            for own in (paths, counts, ms, ids):
                own.clear()

        for batch in batches:
            out = batch.column(0).type
            sizes = batch.column(1).to_pylist()
            for i, doc in enumerate(batch.column(0).to_pylist()):
                terms = place[batch.column(2)[i].values.to_numpy()]
                tfs = batch.column(3)[i].values.to_numpy()
                order = np.argsort(terms)
                paths.append(tuple(terms[order].tolist()))
                counts.append(tuple(tfs[order].tolist()))
                ms.append(100 - _FLAT + (_SLOPE * sizes[i] * total) // length)
                ids.append(doc)
                entries += len(terms)
                if len(paths) >= _TREE_DOCS or entries >= _TREE_ENTRIES:
                    grow()
                    entries = 0
        grow()
        found = list(best.rows())
        if found:
            yield pa.RecordBatch.from_arrays(
                [pa.array([r[0] for r in found], pa.int32()), pa.array([r[1] for r in found], out),
                 pa.array([r[2] for r in found], pa.int64())], ["item", "doc_id", "score"],
            )

    listed = rows.where(F.size("terms") > 0)
    return listed.mapInArrow(of_batches, f"item int, doc_id {kind}, score bigint")


def rank(docs: DataFrame, items: DataFrame, top: int = 50, doc_id: str = "doc_id",
         text: str = "text", item_id: str = "item_id", item_text: str = "text") -> DataFrame:
    """``(item_id, rank, doc_id, score)``: the ``top`` documents of each item, scores above 0.

    Items go in blocks of bounded size, all documents are searched for each block.
    A document is cut down to its terms that an item has, most frequent first, and
    counted once. Each task grows tries of some thousand such vectors, in which
    documents share their first terms, and searches them for all items, depth first,
    with the greatest term counts and the least m of each subtree as its bound. The
    best of the tasks are ranked in two steps, so that an item's rows are dealt out.

    Equal scores rank by id, rows without an id last. Repeated rows rank each. Rows
    with one ``item_id``, null too, are one item with the terms of all of them. Null
    and empty texts have no terms: such documents are not counted, such items get no
    rows. An empty table on either side gives an empty result.
    """
    spark = docs.sparkSession
    kinds = (items.schema[item_id].dataType.simpleString(), docs.schema[doc_id].dataType.simpleString())
    parts = []
    for block in item_blocks(items, item_id, item_text):
        terms = list(block.columns)
        rows = settle(vectors(docs, terms, doc_id, text), "item-vectors")
        whole = rows.agg(F.count_if(F.col("n") > 0).alias("docs"), F.sum("n").alias("terms")).first()
        held = rows.select(F.explode("terms").alias("t")).groupBy("t").count().collect()
        if not held:
            continue
        in_docs = np.zeros(len(terms), np.int64)
        for r in held:
            in_docs[r.t] = r["count"]
        place = np.empty(len(terms), np.int64)
        place[np.argsort(-in_docs, kind="stable")] = np.arange(len(terms))
        weights = np.zeros((len(terms), len(block.ids)), np.int64)
        for at, term in enumerate(terms):
            weights[place[at], block.columns[term]] = weight(whole.docs, int(in_docs[at]))
        found = _searched(rows, weights, place, whole.docs, whole.terms, top)
        names = spark.createDataFrame(list(enumerate(block.ids)), f"item int, item_id {kinds[0]}")
        parts.append(_best_of(found, top).join(F.broadcast(names), "item"))
    if not parts:
        return spark.createDataFrame(
            [], f"item_id {kinds[0]}, rank int, doc_id {kinds[1]}, score bigint")
    ranked = parts[0]
    for part in parts[1:]:
        ranked = ranked.unionByName(part)
    return ranked.select("item_id", "rank", "doc_id", "score")


def _best_of(found: DataFrame, top: int) -> DataFrame:
    order = [F.desc("score"), F.asc_nulls_last("doc_id")]
    dealt = found.withColumn("_deal", F.pmod(F.xxhash64("doc_id", "score"), F.lit(32)))
    first = dealt.withColumn("rank", F.row_number().over(
        Window.partitionBy("item", "_deal").orderBy(*order))).where(F.col("rank") <= top)
    return first.withColumn("rank", F.row_number().over(
        Window.partitionBy("item").orderBy(*order))).where(F.col("rank") <= top).drop("_deal")
