"""Hits of benchmark windows against a plain search."""

import random
import re

import pytest

from tillwright.llm import contamination as op

WORD = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")


def words(text):
    return WORD.findall("".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or ""))


def plain(text, items, window):
    body, hit, found = words(text), set(), set()
    for name, item in items:
        w = words(item)
        size = min(window, len(w))
        for i in range(len(w) - size + 1) if w else ():
            for j in range(len(body) - size + 1):
                if body[j : j + size] == w[i : i + size]:
                    hit.update(range(j, j + size))
                    found.add(str(name))
    return len(body), len(hit), sorted(found)


def cases(seed):
    rng = random.Random(seed)
    vocabulary = ["a", "b", "C", "é", "ß9", "x-y"]
    text = lambda n: rng.choice([" ", ", ", "\n"]).join(rng.choices(vocabulary, k=n))
    items = [(i, text(rng.choice([1, 2, 3, 4, 6, 9, 14]))) for i in range(12)]
    items += [(50, None), (51, ""), (52, "..."), (53, items[0][1]), (0, items[0][1])]
    docs = [(i, text(rng.randint(0, 40))) for i in range(30)]
    docs += [(i + 30, text(5) + " zz " + (t or "") + " zz " + text(3)) for i, t in items[:10]]
    docs += [(90, None), (91, ""), (92, "zz " * 5000), (93, docs[3][1]), (93, docs[3][1]),
             (None, docs[3][1])]
    return docs, items


@pytest.mark.parametrize("window,block_bytes", [(4, 1 << 20), (6, 30), (3, 1)])
def test_hits(spark, window, block_bytes):
    docs, items = cases(window)
    d = spark.createDataFrame(docs, "doc_id long, text string").selectExpr("*", "1 AS _id")
    b = spark.createDataFrame(items, "item_id long, text string").selectExpr("*", "1 AS doc_id")
    found = op.find_passages(d, b, window, block_bytes=block_bytes).select(
        "doc_id", "n_words", op.n_hit().alias("n_hit"), "items").collect()
    got = sorted(((r.doc_id or -1), r.n_words, r.n_hit, r["items"]) for r in found)
    assert got == sorted(((i or -1), *plain(t, items, window)) for i, t in docs)


@pytest.mark.parametrize("block_bytes", [1 << 20, 20])
def test_removal_leaves_no_window(spark, block_bytes):
    docs, items = cases(7)
    d = spark.createDataFrame(docs, "doc_id long, text string").selectExpr("*", "2 AS words")
    b = spark.createDataFrame(items, "item_id long, text string")
    kept = op.remove_passages(d, b, 0.5, 4, block_bytes=block_bytes)
    assert kept.columns == d.columns
    texts = {r.doc_id: r.text for r in kept.collect()}
    for i, t in docs:
        n, hit, _ = plain(t, items, 4)
        if hit > 0.5 * n:
            assert i not in texts
        elif not hit:
            assert i in texts
        if i in texts:
            assert plain(texts[i], items, 4)[1] == 0
            if not hit:
                assert texts[i] == t


def test_production_window(spark):
    item = " ".join(f"w{i}" for i in range(15))
    docs = [(1, "start " + " ".join(f"W{i}" for i in range(3, 14)) + " end"),
            (2, " ".join(f"w{i}" for i in range(9))), (3, "w1 w2 short one!")]
    d = spark.createDataFrame(docs, "doc_id long, text string")
    b = spark.createDataFrame([(7, item), (8, "Short one")], "item_id long, text string")
    rows = {r.doc_id: r for r in op.find_passages(d, b).collect()}
    assert [(s.start, s.end) for s in rows[1].spans] == [(1, 12)] and rows[1].longest == 11
    assert rows[2].spans == [] and rows[3]["items"] == ["8"]
    assert op.cut_spans(docs[2][1], [(2, 4)]) == "w1 w2 !"


def test_empty_tables(spark):
    none = spark.createDataFrame([], "doc_id long, text string")
    items = spark.createDataFrame([(1, "a b")], "item_id long, text string")
    assert op.find_passages(none, items).count() == 0
    assert op.remove_passages(none, items).count() == 0
    docs = spark.createDataFrame([(1, "a b")], "doc_id long, text string")
    assert op.find_passages(docs, items.limit(0)).first()["items"] == []
    assert op.remove_passages(docs, items.limit(0)).count() == 1
