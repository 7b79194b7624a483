"""Counts, base rules and adaptive limits against plain versions."""

import random
import re
from collections import Counter

import numpy as np

from tillwright.llm import quality as op


def plain(text):
    text = text or ""
    words = re.findall(r"[^\x20\x09-\x0D]+", text)
    windows = Counter(tuple(words[i : i + 3]) for i in range(len(words) - 2))
    covered = set()
    for i in range(len(words) - 2):
        if windows[tuple(words[i : i + 3])] > 1:
            covered.update((i, i + 1, i + 2))
    lines = [x for x in text.split("\n") if re.search(r"[^\x20\x09-\x0D]", x)]
    return (len(words), sum(map(len, words)), sum(c in "#*$%&|<>" for c in text),
            len(lines) - len(set(lines)), len(covered), len(lines))


def texts(seed, n):
    rng = random.Random(seed)
    words = ["a", "bb", "é", "漢字", "#x", "|", "c\x1cd", "\x85"]
    return ["".join(rng.choice(words) + rng.choice([" ", " ", "\n", "\t\r", " \n \n"])
                    for _ in range(rng.randint(0, 30))) for _ in range(n)]


def test_counts():
    for text in [*texts(1, 400), "", " \n\n ", "a b c", "a b c a b c", "a a a a", "w " * 50_000,
                 " ".join(map(str, range(50_000)))]:
        assert op.counts_of(text.encode()) == plain(text)


def test_long_text_of_many_words():
    words = [b"%d" % (i % 1_100_000) for i in range(2_200_000)]
    assert op.repeated_words(words) == 2_200_000


def docs(spark):
    rng = random.Random(3)
    rows = []
    for i in range(600):
        lang, source = rng.choice(["en", "en", "de", None]), rng.choice(["s0", "s0", "s1", None])
        body = " ".join("".join(rng.choices("abcdefgh", k=rng.randint(3, 7))) for _ in range(80))
        rows.append((i, body, lang, source))
    rows += [(1000, "# | " * 100, "en", "s0"), (1001, None, "en", "s0"), (1002, "", None, None),
             (1003, "many words " * 100, "de", "s1"), (1004, rows[0][1] + " #", "en", "s0"),
             (1005, rows[0][1], "xx", "only here"), (1005, rows[0][1], "xx", "only here"),
             (None, rows[1][1], "en", "s0"), (1006, "\n".join([rows[2][1]] * 9), "en", "s0"),
             (1007, " ".join("x" * 60 + str(i) for i in range(90)), "en", "s0")]
    return spark.createDataFrame(rows, "doc_id long, text string, lang string, source string")


def test_verdicts(spark):
    df = docs(spark).selectExpr("*", "1 AS counts", "2 AS n", "3 AS row", "4 AS limits")
    found = op.judged(df, keep=["doc_id", "text", "lang", "source"]).collect()
    assert len(found) == df.count()
    by = {r.row.doc_id: r for r in found}
    for r in found:
        p = plain(r.row.text)
        assert tuple(r.counts) == p
        assert r.base_failed == (p[0] < 50 or 100 * p[4] > 50 * p[0])
        assert not (r.base_failed and r.kept)
    assert not by[1000].kept and not by[1006].kept and not by[1007].kept
    assert by[1004].kept and by[1005].kept and by[None].kept
    assert sum(r.kept for r in found if r.row.doc_id is not None and r.row.doc_id < 600) == 600
    kept = op.keep_good(df)
    assert kept.columns == df.columns and kept.count() == sum(r.kept for r in found)


def test_quantiles_of_merged_sketches(spark):
    df = docs(spark)
    counted = op.with_counts(df)
    limits = op.fences(op.sketches(counted), [], 3.0).first()
    rule = next(r for r in op.RULES if r.name == "word_length")
    ratios = sorted((p[1] / p[0] if p[0] else 0.0) for p in map(plain, (r.text for r in df.collect())))
    q1, q3 = (np.quantile(ratios, q, method="inverted_cdf") for q in (0.25, 0.75))
    width = 3 * max(q3 - q1, rule.spread)
    assert abs(limits.high_word_length - (q3 + width)) < 0.03 * q3 * 4
    assert abs(limits.low_word_length - (q1 - width)) < 0.03 * q3 * 4


def test_empty(spark):
    df = docs(spark).limit(0)
    assert op.judged(df).count() == 0 and op.keep_good(df).columns == df.columns


def test_limits_follow_the_texts_of_the_group(spark):
    rng = random.Random(8)
    rows = []
    for i in range(400):
        source = "plain" if i % 2 else "tables"
        words = ["".join(rng.choices("abcdefgh", k=rng.randint(3, 7))) for _ in range(100)]
        if source == "tables":  # every text has symbols and repeated lines
            words[:20] = ["|"] * rng.randint(10, 20)
        size = rng.randint(2, 5) if source == "tables" else 0
        rows.append((i, " ".join(words) + "\n--" * size, "en", source))
    odd = rows[1][1].replace(" ", "\n") + "\nx y" * 12  # a tenth of its lines repeat
    rows += [(1000, odd, "en", "plain"), (1001, rows[1][1] + " |" * 8, "en", "plain"),
             (1002, rows[1][1] + " | |", "en", "tables")]
    df = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string")
    by = {r.source: r for r in op.thresholds(op.with_counts(df)).collect()}
    for limit in ("high_symbols", "high_dup_lines"):
        assert by["tables"][limit] > 10 * by["plain"][limit]
    kept = {r.doc_id for r in op.keep_good(df).collect()}
    assert not {1000, 1001} & kept and 1002 in kept
    assert len(kept) > 380
