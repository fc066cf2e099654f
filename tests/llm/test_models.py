"""The trained operators: exact parts against brute force, the rest by held-out accuracy; and the whole pipeline."""

import random
import zlib

import pytest

import corpus_pipeline
from trailmark.llm import langid, quality

ALPHABETS = {"en": "the and ing of to er on an".split(), "de": "der und sch ein ung ich en pf".split(), "es": "el que ción ar os de ña ll".split(), "fr": "le eau ou é ai tion que x".split()}
HEAD = "doc_id long, text string, lang string, source string, n_chars long"


def prose(rng, lang, n):
    return " ".join("".join(rng.choices(ALPHABETS[lang], k=rng.randint(1, 3))) for _ in range(n))


@pytest.fixture(scope="module")
def corpus(spark):
    rng, rows, labels = random.Random(11), [], []
    for i in range(360):
        lang = rng.choice(list(ALPHABETS))
        text = prose(rng, lang, rng.randint(30, 120))
        good = rng.random() < 0.6
        if not good:
            word = text.split()[0]
            text = rng.choice([" ".join([word] * 60), text.upper().replace(" ", "!! "), text.replace(" ", "%%% ")])
        rows.append((i, text, lang, f"s{i % 7}", len(text)))
        labels.append((i, int(good), 0))
    rows += [(1000, None, "en", None, None), (1001, "", None, "s", 0), (1002, "12 34 !!", "de", "s", 8), (1003, prose(rng, "en", 20_000), "en", "s", 1), (1003, prose(rng, "en", 20), "en", "s", 1), (None, "the ering", None, None, None)]
    labels += [(1000, None, None), (None, 1, 0), (5, labels[5][1], 1), (9999, 0, 0), (7, 3, 0)]
    docs = spark.createDataFrame(rows, HEAD).selectExpr("*", "'x' AS score", "'y' AS held_out", "'z' AS word")
    return rows, docs.cache(), spark.createDataFrame(labels, "doc_id long, quality int, toxic int").cache(), dict((i, q) for i, q, _ in labels[:360])


def fold(doc_id, n):
    return zlib.crc32(("" if doc_id is None else str(doc_id)).encode()) % n


def test_quality(spark, corpus):
    rows, docs, labels, truth = corpus
    got = quality.classify(docs, quality.train(docs, labels), docs.columns)
    assert got.columns.count("score") == 1 and dict(got.dtypes)["score"] == "double"
    told = got.collect()
    assert len(told) == len(rows) and all(0 <= r["score"] <= 1 and r["predicted"] == (r["score"] >= 0.3) for r in told)
    held = [r for r in told if r["held_out"] and r["doc_id"] in truth]
    assert sum(r["predicted"] == truth[r["doc_id"]] for r in held) / len(held) > 0.9
    blank = quality.train(docs, labels.limit(0))
    assert len({round(r["score"], 9) for r in quality.classify(docs.limit(5), blank, ["doc_id"]).collect()}) == 1
    assert quality.classify(docs.limit(0), blank, ["doc_id"]).count() == 0


def test_language(spark, corpus):
    rows, docs, _, _ = corpus
    model = langid.train(docs)
    assert ("de", "en") in model.pairs and ("es", "fr") in model.pairs and len(model.families) == 2
    told = langid.identify(docs, model, ["doc_id", "lang", "text"]).collect()
    assert len(told) == len(rows) and all(0 <= r["score"] <= 1 for r in told)
    assert all(r["lang_pred"] == "und" for r in told if r["doc_id"] in (1000, 1001, 1002))
    held = [r for r in told if r["held_out"] and r["doc_id"] is not None and r["doc_id"] < 1000]
    assert sum(r["lang_pred"] == r["lang"] for r in held) / len(held) > 0.95
    empty = langid.train(docs.limit(0))
    assert {r["lang_pred"] for r in langid.identify(docs.limit(3), empty, ["doc_id"]).collect()} == {"und"}


def test_pipeline(spark, corpus, tmp_path):
    rows, docs, labels, truth = corpus
    copy = rows[next(i for i, q in truth.items() if q)]
    item = next(rows[i][1] for i, q in truth.items() if q and i > copy[0] and fold(i, 5))
    table = spark.createDataFrame([*rows, (2000, copy[1], *copy[2:]), (2001, prose(random.Random(1), "en", 40) + " " + item, "en", "s", 1)], HEAD)
    table.write.parquet(str(tmp_path / "documents.parquet"))
    labels.write.parquet(str(tmp_path / "labels.parquet"))
    spark.createDataFrame([(1, item)], "item_id long, text string").write.parquet(str(tmp_path / "benchmark.parquet"))
    kept = {r["doc_id"] for r in corpus_pipeline.run(spark, str(tmp_path)).collect()}
    assert len(kept & {copy[0], 2000}) == 1 and 2001 not in kept
    good = [i for i, q in truth.items() if q and rows[i][1] != item]
    assert sum(i in kept for i in good) / len(good) > 0.95
    assert sum(i in kept for i, q in truth.items() if not q) / 140 < 0.1
    step = spark.read.parquet(str(tmp_path / "documents.parquet"))
    for name, stage in corpus_pipeline.STAGES[:-1]:
        step = stage(spark, step, str(tmp_path))
        assert step.columns == table.columns, name
        step = spark.createDataFrame(step.collect(), table.schema)
