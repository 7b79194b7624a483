"""Ranked search against plain scores of all documents; tries against their documents."""

import math
import random
import re

import numpy as np
import pytest

from tillwright.llm import ranking as op

TERM = re.compile(r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+")


def plain_terms(text):
    return TERM.findall("".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or ""))


def plain(docs, items, top=50):
    found = [(d, plain_terms(t)) for d, t in docs]
    found = [(d, t) for d, t in found if t]
    total, length = len(found), sum(len(t) for _, t in found)
    asked = {}
    for item, text in items:
        asked.setdefault(item, set()).update(plain_terms(text))
    rows = []
    for item, terms in asked.items():
        weights = {t: math.floor(1000 * math.log((2 * total + 2) / (
            2 * sum(t in d for _, d in found) + 1))) for t in terms}
        scored = []
        for doc, own in found:
            m = 100 - 50 + 50 * len(own) * total // length
            score = sum(w * (10**9 * own.count(t) // (1000 * own.count(t) + 20 * m))
                        for t, w in weights.items() if t in own)
            if score > 0:
                scored.append((-score, doc is None, doc or 0, doc))
        rows += [(item, i + 1, doc, -s) for i, (s, _, _, doc) in enumerate(
            sorted(scored, key=lambda x: x[:3])[:top])]
    return sorted(rows, key=repr)


def frames(spark, docs, items):
    return (spark.createDataFrame(docs, "doc_id long, text string").selectExpr(
                "*", "1 AS n", "2 AS terms", "3 AS item", "4 AS score"),
            spark.createDataFrame(items, "item_id string, text string").selectExpr("*", "1 AS doc_id"))


def made(seed, n):
    rng = random.Random(seed)
    words = ["the", "of", "été", "A1", "x-y", "Z9"] + [f"w{i}" for i in range(60)]
    prose = lambda k: " ".join(rng.choices(words, [60 // (i + 1) + 1 for i in range(len(words))], k=k))
    docs = [(i, prose(rng.randint(1, 60))) for i in range(n)]
    docs += [(1000 + i, docs[3][1]) for i in range(70)]  # ties beyond the limit
    docs += [(5, docs[5][1]), (None, docs[6][1]), (None, docs[7][1]), (901, None), (902, ""), (903, " .,"),
             (904, "the " * 30_000 + "W1"), (905, "THE É é Été")]
    items = [("a", prose(8)), ("b", "the the OF"), ("b", "w1"), (None, "w2 w3"), ("c", None), ("d", "..."),
             ("e", "nowhere"), ("f", prose(30)), ("f", prose(30))]
    return docs, items


@pytest.mark.parametrize("seed,trees,top", [(1, 4096, 50), (2, 7, 50), (3, 1, 3), (4, 40, 1)])
def test_against_all_scores(spark, monkeypatch, seed, trees, top):
    docs, items = made(seed, 120)
    monkeypatch.setattr(op, "_TREE_DOCS", trees)
    d, i = frames(spark, docs, items)
    found = op.rank(d.repartition(3), i, top)
    assert found.columns == ["item_id", "rank", "doc_id", "score"]
    assert sorted((tuple(r) for r in found.collect()), key=repr) == plain(docs, items, top)


def test_blocks_of_items(spark, monkeypatch):
    docs, items = made(5, 60)
    d, i = frames(spark, docs, items)
    monkeypatch.setattr(op, "_BLOCK_ITEMS", 2)
    assert len(list(op.item_blocks(i))) > 1
    assert sorted((tuple(r) for r in op.rank(d, i).collect()), key=repr) == plain(docs, items)


def test_empty_tables(spark):
    docs, items = frames(spark, *made(6, 5))
    for pair in ((docs.limit(0), items), (docs, items.limit(0)), (docs.where("text IS NULL"), items)):
        assert op.rank(*pair).collect() == []
        assert op.rank(*pair).dtypes == [("item_id", "string"), ("rank", "int"), ("doc_id", "bigint"),
                                         ("score", "bigint")]


def documents_of(node):
    if node.docs is not None:
        return [(tuple(zip(node.terms.tolist(), row)), m) for row, m in zip(node.docs[0].tolist(),
                                                                           node.docs[1].tolist())]
    return [d for c in node.children for d in documents_of(c)]


def test_every_node_bounds_its_documents():
    rng = random.Random(9)
    paths = [tuple(sorted(rng.sample(range(12), rng.randint(1, 6)))) for _ in range(200)]
    paths += [(0,), (0, 1), (0, 1, 2), (0, 1, 2)]
    tfs = [tuple(rng.randint(1, 9) for _ in p) for p in paths]
    ms = np.array([rng.randint(50, 500) for _ in paths])
    root = op.tree(paths, tfs, ms, list(range(len(paths))))
    assert sorted(documents_of(root)) == sorted(
        (tuple(zip(p, t)), m) for p, t, m in zip(paths, tfs, ms.tolist()))
    nodes = [root]
    while nodes:
        node = nodes.pop()
        below, most = documents_of(node), dict(zip(node.terms.tolist(), node.tfs.tolist()))
        assert node.least_m == min(m for _, m in below)
        assert most == {t: max(dict(d).get(t, 0) for d, _ in below) for t in most}
        assert set(most) == {t for d, _ in below for t, _ in d}
        assert not node.children or len(node.children) > 1
        nodes += node.children
    assert op.tree([], [], np.array([]), []) is None
    pruned = op.Best(1, 2)
    op.search(root, np.ones((12, 1), np.int64), pruned)
    assert len(list(pruned.rows())) == 2
