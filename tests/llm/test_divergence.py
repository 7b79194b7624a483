"""The audit against a plain version with whole vectors."""

import random
import re
from collections import Counter

import pytest

from tillwright.llm import divergence as op

TERM = re.compile(r"[^\x00-\x40\x5B-\x60\x7B-\x7F]+")


def plain(docs, least, top):
    lower = lambda t: "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in t or "")
    docs = [(lang or "", source or "", TERM.findall(lower(text))) for text, lang, source in docs]
    rows = []
    for lang in {d[0] for d in docs}:
        own = [d for d in docs if d[0] == lang]
        in_docs = Counter(t for _, _, terms in own for t in set(terms))
        kept = sorted(t for t, n in in_docs.items() if n >= least)

        def shares(some):
            n = Counter(t for _, _, terms in some for t in terms)
            total = sum(n[t] for t in kept)
            return {t: 1 + 10**9 * (n[t] + 2) // (total + 2 * len(kept)) for t in kept}, n

        whole, _ = shares(own)
        groups = {s: shares([d for d in own if d[1] == s]) for s in {d[1] for d in own}}
        f = lambda p, q: (p - q) ** 2 // (p + q)
        for source, (p, n) in groups.items():
            pairs = [(-sum(f(p[t], q[t]) for t in kept), other.encode(), other)
                     for other, (q, _) in groups.items() if other != source]
            terms = [(-f(p[t], whole[t]), t.encode(), t) for t in kept if n[t] and p[t] > whole[t]]
            rows += [(lang, source, "pair", x[2], -x[0], i + 1) for i, x in enumerate(sorted(pairs))]
            rows += [(lang, source, "term", x[2], -x[0], i + 1)
                     for i, x in enumerate(sorted(terms)[:top])]
    return sorted(rows)


def frame(spark, docs):
    return spark.createDataFrame(docs, "text string, lang string, source string").selectExpr(
        "*", "1 AS terms", "2 AS n", "3 AS block", "4 AS tokens", "5 AS p0")


def made(seed):
    rng = random.Random(seed)
    words = ["the", "Of", "été", "ß", "a1b", "x", "日本"] + [f"{a}{b}" for a in "bcdf" for b in "aeiou"]
    prose = lambda: " ".join(rng.choices(words, k=rng.randint(0, 25)))
    docs = [(prose(), rng.choice(["en", "en", "de", None]), rng.choice(["s1", "s2", "s3", None]))
            for _ in range(80)]
    return docs + [docs[0]] * 40 + [(None, "en", "quiet"), ("", "fr", "s1"), ("12 3", "fr", "s2"), (None, None, None),
                                    ("word " * 20_000, "en", "long"), ("the\0of", "e\0n", "s"), ("x", "", "s1")]


@pytest.mark.parametrize("seed,least,top,block", [(1, 10, 10, 1 << 21), (2, 3, 2, 7), (3, 500, 10, 1 << 21)])
def test_against_whole_vectors(spark, seed, least, top, block):
    docs = made(seed)
    found = op.divergence(frame(spark, docs).repartition(3), least_docs=least, top=top, block_terms=block)
    assert found.columns == ["lang", "source", "part", "item", "value", "rank"]
    assert sorted(tuple(r) for r in found.collect()) == plain(docs, least, top)


def test_empty(spark):
    found = op.divergence(frame(spark, made(1)).limit(0))
    assert found.collect() == []
    assert [t for _, t in found.dtypes] == ["string"] * 4 + ["bigint", "int"]
