"""Line classes against all pairs and a plain edit distance."""

import random

import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from tillwright.llm import lines as op

BLANK = " \t\r\x0b\x0c"


def distance(a, b):
    row = list(range(len(b) + 1))
    for i, x in enumerate(a, 1):
        last, row[0] = row[0], i
        for j, y in enumerate(b, 1):
            last, row[j] = row[j], min(row[j] + 1, row[j - 1] + 1, last + (x != y))
    return row[-1]


@settings(max_examples=500, deadline=None)
@given(st.text("abé", max_size=12), st.text("abé", max_size=12), st.integers(0, 4))
def test_within(a, b, most):
    assert op.within(a, b, most) == (distance(a, b) <= most)


def variants(rng, n):
    out = []
    for _ in range(n):
        line = "".join(rng.choices("abcé ", k=rng.randint(10, 30)))
        for _ in range(rng.randint(1, 8)):
            at = rng.randrange(len(line) + 1)
            line = rng.choice([line, line[:at] + "x" + line[at:], line[:at] + line[at + 1 :],
                               line[:at] + "y" + line[at + 1 :]])
            out.append(line)
    return out


def plain(rows, most, shortest):
    """Places that go per row index, and how many of them are near only."""
    found = []
    for i, (doc_id, text) in enumerate(rows):
        for place, raw in enumerate((text or "").split("\n")):
            line = raw.strip(BLANK)
            if line:
                rank = (1 << 63 if doc_id is None else doc_id, place)
                found.append((line, rank, i, place))
    texts = sorted({f[0] for f in found})
    root = {t: t for t in texts}

    def top(t):
        while root[t] != t:
            t = root[t]
        return t

    for i, a in enumerate(texts):
        for b in texts[i + 1 :]:
            if min(len(a), len(b)) >= shortest and abs(len(a) - len(b)) <= most:
                if distance(a, b) <= most:
                    root[top(b)] = top(a)
    first, own = {}, {}
    for line, rank, _, _ in found:
        first[top(line)] = min(rank, first.get(top(line), rank))
        own[line] = min(rank, own.get(line, rank))
    gone = [[[], 0] for _ in rows]
    for line, rank, i, place in found:
        if rank > first[top(line)]:
            gone[i][0].append(place)
            gone[i][1] += first[top(line)] < own[line]
    return gone


def table(rng, n):
    lines = variants(rng, n) + ["", "  ", "short", "shorz", "a" * 40, "a" * 39, "\tb\r"]
    rows = [(i, "\n".join(rng.choices(lines, k=rng.randint(1, 6)))) for i in range(n)]
    return rows + [(900, None), (901, ""), (902, "\n\n"), (5, rows[5][1]), (5, rows[5][1]),
                   (None, rows[7][1])]


@pytest.mark.parametrize("most,crowd,seed", [(1, 64, 1), (1, 1, 2), (2, 64, 3), (0, 64, 4)])
def test_report(spark, most, crowd, seed):
    rows = table(random.Random(seed), 25)
    df = spark.createDataFrame(rows, "doc_id long, text string").selectExpr(
        "*", "1 AS place", "2 AS line", "3 AS key")
    want = plain(rows, most, 12)
    found = op.report(df, most=most, shortest=12, crowd=crowd).collect()
    got = sorted((repr(r.doc_id), r.n_lines, list(r.gone), r.n_near) for r in found)
    assert got == sorted(
        (repr(i), sum(bool(x.strip(BLANK)) for x in (t or "").split("\n")), gone, near)
        for (i, t), (gone, near) in zip(rows, want)
    )


def test_drop(spark):
    rows = table(random.Random(9), 12)
    df = spark.createDataFrame(rows, "doc_id long, text string").selectExpr("*", "1 AS row", "2 AS gone")
    kept = op.drop_repeated(df, shortest=12)
    assert kept.columns == df.columns
    want = []
    for (i, text), (gone, _) in zip(rows, plain(rows, 1, 12)):
        left = text
        if gone:
            left = "\n".join(x for n, x in enumerate(text.split("\n")) if n not in gone)
        if not gone or left.strip(BLANK + "\n"):
            want.append((repr(i), repr(left)))
    assert sorted((repr(r.doc_id), repr(r.text)) for r in kept.collect()) == sorted(want)


@pytest.mark.parametrize("crowd", [64, 1])
def test_long_lines(spark, crowd):
    rows = [(1, "é" * 20_000), (2, "é" * 19_999), (3, "é" * 9_000 + "x" + "é" * 10_999),
            (4, "é" * 19_998), (5, "é" * 19_000)]
    df = spark.createDataFrame(rows, "doc_id long, text string")
    assert {r.doc_id: list(r.gone) for r in op.report(df, crowd=crowd).collect()} == {
        1: [], 2: [0], 3: [0], 4: [0], 5: []}


def test_empty(spark):
    df = spark.createDataFrame([], "doc_id long, text string")
    assert op.report(df).count() == 0 and op.drop_repeated(df).count() == 0
