"""Encoding against the library's own best path over the same pieces; round trips."""

import random
import re

import public_tokenizers
import pyarrow as pa
import pytest
import sentencepiece
from pyspark.sql import functions as F
from sentencepiece import sentencepiece_model_pb2

from tillwright.llm import pieces as op

PATH = public_tokenizers.path("piece_bpe_32k.model")


def searching(place):
    """The model with the library's search for the best path in place of its merges.

    Single precision cannot hold the scores of a thousand million that the file gives
    to spaces, so they are lifted here.
    """
    model = sentencepiece_model_pb2.ModelProto()
    with open(PATH, "rb") as file:
        model.ParseFromString(file.read())
    model.trainer_spec.model_type = 1
    for piece in model.pieces:
        piece.score = max(piece.score, -40_000.0)
    place.write_bytes(model.SerializeToString())
    return str(place)


@pytest.fixture(scope="module")
def place(tmp_path_factory):
    return searching(tmp_path_factory.mktemp("model") / "best.model")


@pytest.fixture(scope="module")
def library(place):
    return sentencepiece.SentencePieceProcessor(model_file=place)


@pytest.fixture(scope="module")
def vocabulary(place):
    return op.Vocabulary.load(place)


TEXTS = ["", "Hello world", "  two  spaces ", "a.b, c; d! e? f|g", "anh. anh, thonenor", "été ñandú über",
         "日本語 text", "tabs\tand\nlines\r\n", "x" * 150, "1234567890 3.14", "end ", " ", "...", "don't"]


def sample():
    rng = random.Random(4)
    made = ["".join(rng.choices("etaoin shrdlu.,", k=rng.randint(1, 40))) for _ in range(60)]
    return TEXTS + made


def ids_of(df):
    return {r.doc_id: list(r.ids) for r in df.collect()}


@pytest.mark.parametrize("most_shared", [1 << 19, 20, 0])
def test_encode_and_decode(spark, library, vocabulary, most_shared):
    rows = [*enumerate(sample()), (900, "long " * 20_000), (901, "a.b " * 50 + "zq. " * 50)]
    df = spark.createDataFrame(rows, "doc_id long, text string").selectExpr(
        "*", "1 AS word", "2 AS ids", "3 AS k", "4 AS own", "5 AS _row", "6 AS piece")
    found = op.encode(df.repartition(3), vocabulary, most_shared=most_shared)
    assert ids_of(found) == {i: library.encode(t) for i, t in rows}
    back = {r.doc_id: (r.text, r.round_trip) for r in op.decode(found, vocabulary).collect()}
    assert back == {i: (t, True) for i, t in rows}
    assert back == {i: (library.decode(ids), True) for i, ids in ids_of(found).items()}


def test_unknown_characters_are_spelled(spark, library, vocabulary):
    rows = [(1, "a\U0001F9FFb"), (2, "\U00013000"), (3, "ok \x00\x07"), (4, "\U0001F9FF" * 300),
            (5, "né" * 400), (6, "\n\n"), (7, "a\U0001F9FFb " * 9)]
    df = spark.createDataFrame(rows, "doc_id long, text string")
    for most_shared in (1 << 19, 0):
        found = op.encode(df, vocabulary, most_shared=most_shared)
        assert ids_of(found) == {i: library.encode(t) for i, t in rows}
        assert all(r.round_trip and r.n_spelled == sum(i in vocabulary.byte_ids for i in r.ids)
                   for r in found.collect())


def test_short_and_long_words_fold_alike(spark, vocabulary, monkeypatch):
    words = sorted({w for t in sample() for w in re.split(r"(?<!▁)(?=▁)", "▁" + t.replace(" ", "▁"))
                    if w})
    df = spark.createDataFrame([(w,) for w in words], "word string")
    folded = {r.word: op._spelled(list(r.ids), vocabulary)
              for r in op.encode_words(df, ["word"], vocabulary).collect()}
    by_piece = {p: (n, s) for n, p, s in vocabulary.pieces}
    assert folded == {w: op._plain_ids(w, by_piece, vocabulary) for w in words}


def test_rows(spark, library, vocabulary):
    rows = [(1, None), (3, TEXTS[3]), (3, TEXTS[3]), (None, TEXTS[4]), (901, "mark ▁ here"), (902, "")]
    df = spark.createDataFrame(rows, "doc_id long, text string")
    found = op.summarize(df, vocabulary).collect()
    want = [(i, library.encode(t or ""), i != 901) for i, t in rows]
    assert sorted(map(repr, want)) == sorted(
        repr((r.doc_id, list(r.ids), r.round_trip)) for r in found)
    assert all(r.n_pieces == len(r.ids) for r in found)


def test_decoding_any_ids(spark, vocabulary):
    lists = [(1, None), (2, []), (3, [0, 1, 2, -5, 10**6, None]), (4, [vocabulary.byte_ids[255]])]
    df = spark.createDataFrame(lists, "doc_id long, ids array<int>")
    assert {r.doc_id: r.text for r in op.decode(df, vocabulary).collect()} == {
        1: None, 2: "", 3: "", 4: None}


def test_given_scores(spark):
    """With the file's own scores no path is better, and texts come back."""
    vocabulary = op.Vocabulary.load(PATH)
    own = sentencepiece.SentencePieceProcessor(model_file=PATH)
    rows = [(i, t) for i, t in enumerate(sample()) if t]
    df = spark.createDataFrame(rows, "doc_id long, text string")
    for doc_id, ids in ids_of(op.encode(df, vocabulary)).items():
        ours, merged = (sum(own.get_score(i) for i in found) for found in (ids, own.encode(dict(rows)[doc_id])))
        assert ours >= merged and own.decode(ids) == dict(rows)[doc_id]


def test_empty(spark, vocabulary):
    df = spark.createDataFrame([], "doc_id long, text string")
    assert op.summarize(df, vocabulary).count() == 0


def test_plans_hold_no_vocabulary_and_deal_texts_once(spark, vocabulary):
    df = spark.createDataFrame([(1, "a b")], "doc_id long, text string")
    plan = op.encode(df, vocabulary)._jdf.queryExecution().executedPlan().toString()
    assert plan.count("Exchange hashpartitioning") == 1 and len(plan) < 60_000


def test_words_of_texts_walk_to_the_edges_of_the_join(spark, vocabulary):
    """A substring of a text is no row: the walk finds the same edges, and the plan joins nothing."""
    words = ["▁thenon", "x" * 150, "\n", "▁日本\U0001F9FF", "a"]
    df = spark.createDataFrame([(w,) for w in words], "word string")
    joined = {w: [] for w in words}
    for r in op.edges(df, vocabulary).collect():
        joined[r.word].append(tuple(r.edge))
    walked = op._Walk.of(vocabulary).lattices(words).to_pylist()
    assert {w: sorted((end * 256 + e["start"], e["id"], e["score"])
                      for end, own in enumerate(ends, 1) for e in own) for w, ends in zip(words, walked)} == {
        w: sorted(own) for w, own in joined.items()}
    assert [len(ends) for ends in walked] == [len(w) for w in words]
    texts = spark.createDataFrame([(1, "thenon \U0001F9FF")], "doc_id long, text string")
    plan = op.encode(texts, vocabulary, most_shared=0)._jdf.queryExecution().executedPlan().toString()
    assert not any(node in plan for node in ("Join", "Generate", "Aggregate"))


def cut(text, vocabulary):
    """The words of a text by a look at each two neighbours."""
    words = ["▁"] * bool(text)
    for before, after in zip("▁" + text.replace(" ", "▁"), text.replace(" ", "▁")):
        if after == "▁" != before or after in vocabulary.cut_before and before.isalpha():
            words.append(after)
        else:
            words[-1] += after
    return words


def test_words_of_many_texts_at_once(vocabulary):
    """Letters of one to four bytes before a mark, spaces in runs and at ends, empty texts, a slice."""
    rng = random.Random(6)
    letters = "ab .,|é日▁ \U00020000\U0001F9FFâ–1\n;‖"
    for _ in range(300):
        texts = ["".join(rng.choices(letters, k=rng.randint(0, 12))) for _ in range(rng.randint(0, 6))]
        many = pa.array(["zz", *texts, "q"]).slice(1, len(texts))
        assert op.words_of(many, vocabulary).to_pylist() == [cut(text, vocabulary) for text in texts]


def test_texts_are_not_cut_by_patterns(spark, vocabulary):
    """Whole texts go to the batch that looks them up; Spark makes no array of their words."""
    df = spark.createDataFrame([(1, "a b")], "doc_id long, text string")
    plan = op.encode(df, vocabulary)._jdf.queryExecution().executedPlan().toString()
    assert "split(" not in plan


def test_the_fold_keeps_numbers(spark):
    """Of equal ways that whose last piece starts first stays, as in the fold that keeps ways."""
    rng = random.Random(8)
    words = []
    for size in [1, 2, 3, 5, 9] * 8:
        words.append([[(start, 10 * end + start, float(-rng.randint(1, 3)))
                       for start in range(end) if start == end - 1 or rng.random() < 0.6]
                      for end in range(1, size + 1)])
    df = spark.createDataFrame([(words,)], "rare array<array<array<struct<start:int,id:int,score:double>>>>")
    found = df.select(F.transform("rare", op._best_ids_by_end).alias("ids"))
    assert "named_struct(score" not in found._jdf.queryExecution().optimizedPlan().toString()
    want = []
    for word in words:
        ways = [(0.0, 0, [])]
        for edges in word:
            score, back, number, start = max((ways[s][0] + score, -s, i, s) for s, i, score in edges)
            ways.append((score, back, ways[start][2] + [number]))
        want.append(ways[-1][2])
    assert found.first().ids == want


def test_bytes_that_are_no_text(spark, library, vocabulary):
    df = spark.sql("SELECT 1L AS doc_id, CAST(X'6120E26262FF2E' AS STRING) AS text")
    for most_shared in (1 << 19, 0):
        found = op.encode(df, vocabulary, most_shared=most_shared).first()
        assert found.ids == library.encode("a \ufffdbb\ufffd.") and not found.round_trip
