"""The stages of the pipeline on a small corpus whose outcome is known."""

import hashlib
import random
import time
from pathlib import Path

import pytest

import corpus_pipeline
from millrace.llm import probminhash
from millrace.llm.queries import vocabulary
from millrace.session import SHUFFLE_CLEANUP

tokenizers = pytest.importorskip("tokenizers")


def made(folder, spark, rows, bench):
    spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, stage_score int").write.parquet(f"{folder}/documents.parquet")
    labels = [(i, int("***" not in (t or "")), 0) for i, t, *_ in rows if i is not None]
    spark.createDataFrame(labels, "doc_id long, quality int, toxic int").write.parquet(f"{folder}/labels.parquet")
    spark.createDataFrame(bench, "item_id long, text string").write.parquet(f"{folder}/benchmark.parquet")
    return str(folder)


def test_pipeline_keeps_what_is_clean(spark, tmp_path):
    rng = random.Random(6)
    words = {"en": "the of and house river people walk there over stone".split(), "de": "der die und haus fluss leute gehen dort stein weg".split()}

    def text(lang, n=40):
        return " ".join(rng.choice(words[lang]) + rng.choice(["", "s", "en", "er"]) for _ in range(n))

    rows = [(i, text(lang), lang, "s", 1) for i, lang in enumerate(["en", "de"] * 60)]
    rows += [(200 + i, " ".join(w + "***" for w in text("en").split()), "en", "s", 1) for i in range(60)]
    clean = {i for i, *_ in rows if i < 200}
    base = rows[3][1].split()
    near = " ".join([*base, "end"])
    item = text("en", 30)
    rows += [
        (300, rows[5][1], "de", "t", 2), (301, near, "de", "t", 2), (302, text("en") + " " + item + " " + text("en"), "en", "t", 2),
        (303, None, "en", "t", 2), (304, "", "en", "t", 2), (305, "123 !!!", "en", "t", 2), (306, text("en", 8000), "en", "t", 2),
    ]
    folder = made(tmp_path / "in", spark, rows, [(1, item), (2, "too short")])
    docs = spark.read.parquet(f"{folder}/documents.parquet")
    kept = {}
    for name, stage in corpus_pipeline.STAGES[:-1]:
        out = stage(spark, docs, folder)
        assert out.columns == docs.columns
        path = str(tmp_path / name.replace(" ", "-"))
        out.write.parquet(path)
        docs = spark.read.parquet(path)
        kept[name] = {r.doc_id for r in docs.collect()}
    assert kept["language"] == {r[0] for r in rows} - {303, 304, 305}
    assert kept["quality"] == clean | {300, 301, 302, 306}
    assert kept["near copies"] == clean | {302, 306}
    assert kept["decontamination"] == clean | {306}
    tokenizer = tokenizers.Tokenizer.from_file(vocabulary("word_bpe_49k.json"))
    got = {r.doc_id: r for r in corpus_pipeline.run(spark, folder).collect()}
    assert set(got) == clean | {306}
    for i, t, *_ in rows:
        if i in got:
            ids = tokenizer.encode(t, add_special_tokens=False).ids
            assert got[i].n_tokens == len(ids) and got[i].ids_sha256 == hashlib.sha256(" ".join(map(str, ids)).encode()).hexdigest()


def test_every_row_is_judged_by_itself(spark, tmp_path):
    """Null, repeated and shared ids: a clean row stays whatever its id, and one row of a group, whatever their ids."""
    rng = random.Random(2)
    text = lambda n=60: " ".join(rng.choice("abcdefghij") + str(rng.randrange(400)) for _ in range(n))
    first, second, third, item = text(), text(), text(), text(30)
    rows = [
        (1, first), (2, first + " end"), (2, second), (2, second), (None, third), (None, first), (None, third + " end"), (5, "x " + item),
        (5, text()), (None, item + " y"), (None, None), (7, ""),
    ]
    schema = "doc_id long, text string, row_key string"
    docs = spark.createDataFrame([(*r, "kept") for r in rows], schema).repartition(3)
    folder = str(tmp_path / "in")
    docs.write.parquet(f"{folder}/documents.parquet")
    spark.createDataFrame([(1, item)], "item_id long, text string").write.parquet(f"{folder}/benchmark.parquet")
    left = corpus_pipeline.copies_stage(spark, docs, folder)
    assert left.columns == docs.columns
    got = sorted((str(r.doc_id), r.text or "") for r in left.collect())
    texts = [t for _, t in got]
    assert ("1", first) in got and ("2", second) in got and texts.count(second) == 1 and rows[8] == (5, rows[8][1]) and ("5", rows[8][1]) in got
    assert not any(t == first + " end" for t in texts) and texts.count(first) == 1
    assert sum(t in (third, third + " end") for t in texts) == 1
    clean = corpus_pipeline.decontamination_stage(spark, left, folder)
    kept = sorted(r.text or "" for r in clean.collect())
    assert kept == sorted(t for t in texts if item not in t) and rows[8][1] in kept


def files_left(spark, before, seconds=15):
    """Shuffle files that are new and still there after some seconds; Spark deletes them without waiting until they are gone."""
    folders = list(spark._jvm.org.apache.spark.SparkEnv.get().blockManager().diskBlockManager().localDirsString())
    for _ in range(seconds * 5 + 1):
        left = {str(f) for folder in folders for f in Path(folder).rglob("shuffle_*.data")} - before
        if not left:
            break
        time.sleep(0.2)
    return left


def test_near_copies_and_decontamination_leave_no_shuffle_files(spark, tmp_path, monkeypatch):
    """Whatever the driver's memory holds: files that wait for its garbage collector pile up over the steps and stages."""
    rng = random.Random(4)
    text = lambda n=60: " ".join(rng.choice("abcdefghij") + str(rng.randrange(400)) for _ in range(n))
    base, item = text(), text(30)
    rows = [(i, text()) for i in range(30)] + [(30 + i, f"{base} end{i}") for i in range(20)] + [(60, "x " + item)]
    folder = str(tmp_path / "in")
    spark.createDataFrame(rows, "doc_id long, text string").repartition(3).write.parquet(f"{folder}/documents.parquet")
    spark.createDataFrame([(1, item)], "item_id long, text string").write.parquet(f"{folder}/benchmark.parquet")
    docs, setting = spark.read.parquet(f"{folder}/documents.parquet"), spark.conf.get(SHUFFLE_CLEANUP)
    monkeypatch.setattr(probminhash, "release", lambda spark: None)
    before = files_left(spark, set(), 0)
    left = corpus_pipeline.copies_stage(spark, docs, folder)
    assert sorted(r.doc_id for r in left.collect()) == [*range(31), 60]
    assert not files_left(spark, before)
    clean = corpus_pipeline.decontamination_stage(spark, left, folder)
    for _ in range(2):  # the result may be read again
        assert sorted(r.doc_id for r in clean.collect()) == [*range(31)]
    assert not files_left(spark, before)
    assert spark.conf.get(SHUFFLE_CLEANUP) == setting


def test_pipeline_over_an_empty_table(spark, tmp_path):
    folder = made(tmp_path / "in", spark, [], [])
    assert corpus_pipeline.run(spark, folder).count() == 0
