"""The language model: counts, training sums and scores against plain Python."""

import math
import random
import zlib
from collections import Counter

import numpy as np
import pytest
import xxhash

from trailmark.llm import lm

LONG_WORD = "Ab" * 400


def words(text):
    return [*(text or "").encode().lower().split(), b"\n"]


def fold(doc_id):
    return zlib.crc32(("" if doc_id is None else str(doc_id)).encode()) % 7


@pytest.fixture(scope="module")
def docs(spark):
    rng, rows = random.Random(21), []
    stems = ["ab cd ef gh ij kl mn op qr st".split(), "uv wx yz ba dc fe hg ji lk nm".split()]
    for i in range(120):
        own = rng.choice(stems)
        rows.append((i, " ".join("".join(rng.choices(own, k=rng.choice([1, 1, 2, 3]))) for _ in range(rng.randint(1, 80)))))
    rows += [(500, None), (501, ""), (502, LONG_WORD + " ab"), (503, LONG_WORD.lower()), (3, rows[3][1]), (3, rows[3][1]), (None, "ab żółw"), (504, "xy " * 30_000)]
    return rows, spark.createDataFrame(rows, "doc_id long, text string").selectExpr("*", "'x' AS score", "1 AS words", "'y' AS held_out")


def parts(spark, docs):
    """The trained model and the dictionary, made as score() makes them."""
    learnt = docs.select("doc_id", (lm.remainder("doc_id", 7) == 2).alias("held_out"), "text")
    vocabulary = lm.word_counts(learnt.where("NOT held_out"))
    top = lm._most_frequent(vocabulary)
    codes = lm.encoded(learnt, {w: i for i, (w, _) in enumerate(top)}, np.log10(np.array([c for _, c in top], float) + 1))
    return lm.train(codes.where("NOT held_out"), vocabulary, top), top, codes.where("NOT held_out")


def slow_score(text, model, top, counts):
    """log10 P of a text, one token and one weight after the other."""
    number, tokens, codes, total = {w: i for i, (w, _) in enumerate(top)}, words(text), [], 0.0
    keys = [w if len(w) <= 64 else b"\n" + xxhash.xxh3_128_digest(w) for w in tokens]
    tail = lambda k: (lambda h: h - (h >> 63 << 64))(xxhash.xxh64_intdigest(k[-2:], 42)) % 16
    for k in keys:
        codes.append(number.get(k, -1 - ((zlib.crc32(k) >> 5) * 16 + tail(k))))
    klass = [int(model.klass[c]) if c >= 0 else 48 + tail(k) for c, k in zip(codes, keys)]
    first = lambda i: number[b"\n"] if i < 0 else codes[i] if 0 <= codes[i] < 3072 else 3072 + abs(codes[i]) % 1024
    second = lambda i: (int(model.klass[number[b"\n"]]) if i < 0 else klass[i]) * 4 + first(i) % 4
    mixed = lambda a, b, n: ((a * 40_503 + b * 2_654_435_761) % 2**32 >> 7) % n
    for i, (c, k) in enumerate(zip(codes, klass)):
        x, y, z = (first(i - j) for j in (1, 2, 3))
        rows = [x, 4096 + y, 8192 + z, 12288 + mixed(x, y, 8192)]
        odds = [math.exp(float(model.bias[0][o]) + sum(float(model.weights[0][r, o]) for r in rows)) for o in range(64)]
        total += math.log10(odds[k] / sum(odds))
        if k < 48:
            x, y, z = (second(i - j) for j in (1, 2, 3))
            rows = [k * 1280 + r for r in (x, 256 + y, 512 + z, 768 + mixed(x, y, 512))]
            odds = [math.exp(float(model.bias[1][k, o]) + sum(float(model.weights[1][r, o]) for r in rows)) for o in range(64)]
            total += math.log10(odds[int(model.slot[c])] / sum(odds))
        else:
            total += math.log10(counts[tokens[i]] + 1) - model.room[k - 48]
    return total


def test_scores_match_plain_python(spark, docs, monkeypatch):
    monkeypatch.setattr(lm, "DICTIONARY", 90)
    rows, df = docs
    got = lm.score(df).collect()
    counts = Counter(w for i, t in rows if fold(i) != 2 for w in words(t))
    n, v = sum(counts.values()), len(counts)
    model, top, _ = parts(spark, df)
    assert 0 < len(top) <= 90 < v and counts[LONG_WORD.lower().encode()] > 0
    told = {}
    for r in got:
        told.setdefault(r["doc_id"], []).append(r)
    assert len(got) == len(rows) and all(r["train_tokens"] == n and r["held_out"] == (fold(r["doc_id"]) == 2) for r in got)
    for i, t in rows:
        for r in told[i] if i != 504 else ():
            assert r["n_tokens"] == len(words(t)) and r["n_known"] == sum(counts[w] > 0 for w in words(t))
            assert abs(r["base_score"] - sum(math.log10((counts[w] + 1) / (n + v + 1)) for w in words(t))) < 1e-6
            assert abs(r["score"] - slow_score(t, model, top, counts)) < 2e-3 * max(1, len(words(t)) / 20)
    assert told[504][0]["n_tokens"] == 30_001
    assert lm.score(df.limit(0)).count() == 0
    assert lm.score(df.where("doc_id IS NULL OR doc_id = 500")).count() == 2


def test_model_sums_to_one_and_learns(spark, docs):
    rows, df = docs
    model, top, _ = parts(spark, df)
    codes = np.array([i for i in (5, 0, 7)])
    # every word of the vocabulary as third token, the same context before it
    every = np.concatenate([np.concatenate([codes[:2], [w]]) for w in range(len(top))])
    logs = model.logs(every, np.arange(0, len(every), 3))[2::3]
    counted = 10.0 ** logs
    rare = model.klass[: len(top)] >= lm.HEAD_CLASSES
    assert not rare.any() and 0.9 < counted.sum() <= 1 + 1e-6  # the rest is for unseen words
    told = [r for r in lm.score(df).collect() if r["held_out"]]
    assert sum(r["score"] for r in told) > sum(r["base_score"] for r in told)


def test_every_template_learns_from_all_texts(spark, docs):
    rows, df = docs
    model, top, codes = parts(spark, df)
    n = sum(len(words(t)) for i, t in rows if fold(i) != 2)
    came = lm.summed(codes, lambda *x: lm.add_came(model, *x), sum(lm.CELLS))
    expected = lm.summed(codes, lambda *x: lm.add_expected(model, *x), sum(lm.CELLS))
    for a, b in zip(lm.FIRST, lm.FIRST[1:]):
        assert came[a * 64 : b * 64].sum() == n and abs(expected[a * 64 : b * 64].sum() / n - 1) < 1e-3
        assert abs(model.weights[0][a:b]).max() > 0
    first, second = came[: lm.CELLS[0]], came[lm.CELLS[0] :].reshape(48, -1, 64)
    frequent = first.reshape(-1, 64)[: lm.BUCKETS, :48].sum()
    for a, b in zip(lm.SECOND, lm.SECOND[1:]):
        assert second[:, a:b].sum() == frequent and abs(model.weights[1].reshape(48, -1, 64)[:, a:b]).max() > 0
    # copies of all texts give twice the sums
    twice = codes.unionAll(codes)
    assert np.array_equal(lm.summed(twice, lambda *x: lm.add_came(model, *x), sum(lm.CELLS)), 2 * came)


def test_gradient_sums_match_plain_sums(spark, docs):
    _, df = docs
    model, _, codes = parts(spark, df)
    some = [np.frombuffer(r["codes"], np.int32).astype(np.int64) for r in codes.limit(5).collect()]
    flat = np.zeros(sum(lm.CELLS))
    lm.add_expected(model, flat, np.concatenate(some), np.concatenate([[0], np.cumsum([len(x) for x in some])[:-1]]))
    slow = np.zeros(sum(lm.CELLS))
    for x in some:
        for factor, at, rows, given, _ in model.decisions(x, np.array([0])):
            table = slow[factor * lm.CELLS[0] :][: lm.CELLS[factor]].reshape(-1, 64)
            bias = model.bias[1][given] if factor else np.repeat(model.bias[0][None], len(at), axis=0)
            odds = np.exp(bias + sum(model.weights[factor][r] for r in rows))
            for p, *r in zip(odds / odds.sum(axis=1, keepdims=True), *rows):
                for k in r:
                    table[k] += p
    assert np.allclose(flat, slow, atol=1e-3)


def test_classes_hold_words_with_like_neighbours():
    rng = np.random.default_rng(1)
    kind = rng.integers(0, 2, 200)
    seen = rng.poisson(np.where(kind[:, None] == np.arange(6) % 2, 30, 1)).astype(float)
    got = lm.clusters(seen, 4)
    assert max(np.bincount(got)) <= lm.SLOTS and all(len(set(kind[got == k])) == 1 or abs(kind[got == k].mean() - 0.5) > 0.4 or (got == k).sum() < 8 for k in set(got.tolist()))
    assert len(lm.clusters(np.zeros((0, 6)), 4)) == 0
