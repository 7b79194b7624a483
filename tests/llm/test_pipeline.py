"""The pipeline on small tables: what each stage keeps, against plain versions."""

import random

import corpus_pipeline
import public_tokenizers
import test_contamination as contamination
import test_lines as lines
import test_near_copies as copies
import test_quality as quality
from tillwright.llm import pieces
from tillwright.llm.queries import QUERIES


def tables(spark, folder):
    rng = random.Random(11)
    word = lambda: "".join(rng.choices("abcdefghij", k=rng.randint(3, 8)))
    prose = lambda n: " ".join(word() for _ in range(n))
    passage, shared = prose(30), prose(15)
    docs = [(i, "\n".join(prose(40) for _ in range(3)), "en", "s") for i in range(150)]
    docs += [(200, docs[0][1], "en", "s"), (201, docs[1][1] + " tail", "en", "s"),
             (202, prose(60) + " " + passage + " " + prose(20), "en", "s"),
             (203, passage + "\n" + prose(25), "en", "s"),
             (204, "too short", "en", "s"), (205, "# " * 200 + prose(60), "en", "s"),
             (206, shared + "\n" + prose(70), "en", "s"), (207, shared + "s\n" + prose(70), "de", "s"),
             (208, None, None, None), (None, prose(90), "en", "s"), (209, prose(700), None, "t")]
    # A near copy of one line: other words at places that leave most shingles.
    words = docs[-1][1].split()
    words[350] = "changed"
    docs.append((210, " ".join(words), None, "t"))
    spark.createDataFrame(
        [(*d, len(d[1] or ""), 1) for d in docs],
        "doc_id long, text string, lang string, source string, n_chars long, row int",
    ).write.parquet(f"{folder}/documents.parquet")
    spark.createDataFrame([(1, passage), (2, None)], "item_id long, text string").write.parquet(
        f"{folder}/benchmark.parquet")
    return docs, passage


def test_stages(spark, tmp_path):
    docs, passage = tables(spark, str(tmp_path))
    now = spark.read.parquet(f"{tmp_path}/documents.parquet")
    seen = []
    for name, stage in corpus_pipeline.STAGES:
        before = [(r.doc_id, r.text) for r in now.collect()]
        out = stage(spark, now, str(tmp_path))
        if name != "sentencepiece":
            assert out.columns == now.columns and out.dtypes == now.dtypes
            out.write.parquet(f"{tmp_path}/{name}")
            now = spark.read.parquet(f"{tmp_path}/{name}")
            after = sorted(((r.doc_id, r.text) for r in now.collect()), key=repr)
        seen.append(name)
        if name == "quality_rules":
            gone = {d for d, _ in before} - {d for d, _ in after}
            assert gone == {204, 205, 208}
            assert all(t == dict(before)[d] for d, t in after)
        elif name == "line_dedup":
            want = []
            for (doc_id, text), (gone, _) in zip(before, lines.plain(before, 1, 16)):
                left = "\n".join(x for n, x in enumerate(text.split("\n")) if n not in gone)
                if left.strip(lines.BLANK + "\n") or not gone:
                    want.append((doc_id, left if gone else text))
            assert after == sorted(want, key=repr)
            assert 200 not in dict(after) and dict(after)[207].count("\n") == 0
        elif name == "simhash_near_dedup":
            prints = [copies.plain_print(t) for _, t in before]
            groups = copies.plain_components(prints, 2)
            least = {}
            for (doc_id, _), group in zip(before, groups):
                if doc_id is not None:
                    least[group] = min(doc_id, least.get(group, doc_id))
            assert after == sorted([
                row for row, group in zip(before, groups)
                if row[0] is None or row[0] == least[group]
            ], key=repr)
        elif name == "decontamination":
            for doc_id, text in before:
                n, hit, _ = contamination.plain(text, [(1, passage)], 10)
                if not hit:
                    assert dict(after)[doc_id] == text
                elif hit > 0.5 * n:
                    assert doc_id not in dict(after)
                else:
                    assert contamination.plain(dict(after)[doc_id], [(1, passage)], 10)[1] == 0
            assert 202 in dict(after) and 203 not in dict(after)
        else:
            rows = out.collect()
            assert sorted(map(repr, (r.doc_id for r in rows))) == sorted(repr(d) for d, _ in before)
            texts = {repr(d): t for d, t in before}
            assert all(r.round_trip and r.n_pieces == len(r.ids) > 0 for r in rows)
            back = pieces.decode(out, pieces.Vocabulary.load(public_tokenizers.path("piece_bpe_32k.model")))
            assert {repr(r.doc_id): r.text for r in back.collect()} == texts
    assert seen == [name for name, _ in corpus_pipeline.STAGES]


def test_quality_of_plain_counts():
    assert quality.plain("a b") == (2, 2, 0, 0, 0, 1)


def test_registered_names():
    import __spark_entry__

    names = [q.name for q in QUERIES]
    assert [n.split("_")[0] for n in names] == [f"op{i}" for i in range(1, 14)]
    assert {*names, "pipeline"} <= set(__spark_entry__.queries())
