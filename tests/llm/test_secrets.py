"""Base spans against the patterns as given; links against all pairs of a text."""

import random
import re

from pyspark.sql import functions as F

from tillwright.llm import secrets as op

GIVEN = [
    (r"""(?i:password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""",
     lambda m: len(m.group(1)) >= 6),
    (r"AKIA[A-Z0-9]+", lambda m: len(m.group()) >= 20),
    (r"[0-9a-f]+", lambda m: len(m.group()) >= 24),
]
KEY = "aB3" + "xY9/" * 9 + "Q"
BITS = ["password", "PassWd", "ſecret", "toKen", "secret", "api_key", "APIkey", " ", "  ", "=", ":",
        '"', "'", "abcdef", "ABC", "0123456789abcdef", "AKIA", "Z9Z9Z9Z9Z9Z9Z9Z9", "é", "🙂", "\n",
        KEY, " user=", "login: ", "bob.x", "https://x.example/y ", "word " * 30, "s3://b/k "]


def plain_base(text):
    return sorted((m.start(), k, m.end()) for k, (pattern, fits) in enumerate(GIVEN)
                  for m in re.finditer(pattern, text, re.ASCII) if fits(m))


def plain_spans(text, reach):
    base = plain_base(text)
    parts = base + op.weak_spans(text, base)
    out = list(base)
    for start, kind, end in parts:
        if kind < op.BASE:
            continue
        near = {k for s, k, e in parts if s <= end + reach and e >= start - reach}
        has_id, secret = near & {op.ACCESS, op.USER}, near & {op.ASSIGN, op.HEX, op.KEY}
        if {op.KEY: has_id, op.USER: secret, op.ENDPOINT: has_id and secret}[kind]:
            out.append((start, kind, end))
    return sorted(out)


def texts(seed, n):
    rng = random.Random(seed)
    return ["".join(rng.choices(BITS, k=rng.randint(0, 40))) for _ in range(n)]


def test_base_spans():
    for text in texts(1, 3000):
        assert op.base_spans(text) == plain_base(text)


def test_scan(spark):
    rows = [(i, t) for i, t in enumerate(texts(2, 300))]
    rows += [(900, None), (901, ""), (902, rows[5][1]), (902, rows[5][1]), (None, rows[6][1]),
             (903, f"user=bob {'x ' * 400} {KEY}"), (904, f"user=bob {'x ' * 100} {KEY}"),
             (905, f"{KEY} https://db.example/x"), (907, f"user=bob {'0123456789abcdef' * 2}"), (906, "user=bob " * 20_000 + KEY)]
    df = spark.createDataFrame(rows, "doc_id long, text string").selectExpr(
        "*", "1 AS kind", "2 AS start", "3 AS _id", "4 AS spans")
    found = op.scan(df, reach=300).collect()
    got = sorted((repr(r.doc_id), [tuple(s) for s in r.spans], [tuple(s) for s in r.base])
                 for r in found)
    want = sorted((repr(i), plain_spans(t or "", 300), plain_base(t or ""))
                  for i, t in rows if i != 906)
    assert [g for g in got if g[0] != "906"] == want
    last = next(r for r in found if r.doc_id == 906)
    # Of twenty thousand users, those near the key, and the key itself.
    assert [s.kind for s in last.spans].count(op.KEY) == 1
    assert 30 < len(last.spans) < 40


def test_text_of_spans(spark):
    df = spark.createDataFrame([(1, f"é token = 'abcdef' user=bob {KEY}")], "doc_id long, text string")
    r = op.scan(df).select(op.spans_text(F.col("spans")).alias("all"), op.n_of(op.ASSIGN).alias("n"),
                           op.spans_text(F.col("base")).alias("base")).first()
    assert r.base == "assign:2:17" and r.n == 1
    assert r.all == "assign:2:17,user:19:27,key:28:68"
    assert op.scan(df.limit(0)).count() == 0
