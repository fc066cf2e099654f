"""Top-k search, SimHash groups and decontamination against brute force."""

import hashlib
import random

import numpy as np
import pytest
import xxhash
from pyspark.sql import functions as F

from trailmark.llm import decontam, simhash, topk

DOCS = "doc_id long, text string, lang string, source string, fp string, score double, _text string, _row string"


def rows_of(texts):
    return [(i, t, "en", "s", "x", 0.5, "other", "r") for i, t in texts]


def test_top_k_matches_brute_force(spark):
    rng = np.random.default_rng(3)
    vectors = [(i, [int(x) for x in rng.integers(-50, 50, 6) * (rng.random(6) < 0.6)]) for i in range(700)]
    vectors += [(700, [0] * 6), (701, vectors[5][1]), (702, vectors[5][1]), (703, None), (704, [1, None, 2, 3, 4, 5]), (705, [])]
    df = spark.createDataFrame(vectors, "vec_id long, weights array<long>")
    got = topk.top_k(df.withColumn("asked", F.lit("clash")), df.where("vec_id % 50 = 0"), 10, shard_cells=1200).collect()
    usable = {i: np.array(v) for i, v in vectors if v and None not in v}
    want = []
    for q in (i for i in usable if i % 50 == 0):
        best = sorted((-int(usable[q] @ v), i) for i, v in usable.items() if i != q)[:10]
        want += [(q, r + 1, i, -s) for r, (s, i) in enumerate(best)]
    assert sorted(tuple(r) for r in got) == sorted(want)
    assert topk.top_k(df.where("vec_id < 0"), df).count() == topk.top_k(df, df.where("vec_id < 0")).count() == 0


def test_top_k_of_huge_numbers_repeated_queries_and_no_numbers(spark):
    big = 2.0**70
    rows = [(0, [big, 1.0]), (1, [big, 3.0]), (2, [big, 2.0]), (3, [float("nan"), 1.0]), (4, [float("inf"), 1.0]), (5, [-big]), (100, [1.0, 1.0]), (100, [1.0, -1.0]), (100, [1.0, 1.0])]
    df = spark.createDataFrame(rows, "vec_id long, weights array<double>")
    got = [tuple(r) for r in topk.top_k(df, df.where("vec_id = 100"), 3, shard_cells=4).orderBy("query_id", "vec_id", "rank").collect()]
    # both vectors of query 100 have ranks of their own; scores beyond 64 bits are clamped
    assert len(got) == 6 and sorted(r[1] for r in got) == [1, 1, 2, 2, 3, 3] and {r[3] for r in got} == {2**63 - 1}
    one = [tuple(r) for r in topk.top_k(df, df.where("vec_id = 100").limit(1), 4).collect()]
    assert [r[2] for r in sorted(one, key=lambda r: r[1])][-1] == 5 and one[-1][3] == -(2**63)


def slow_fingerprint(text, width=4):
    words = bytes(c + 32 if 65 <= c <= 90 else c for c in (text or "").encode()).split()
    parts = [b" ".join(words[i : i + width]) for i in range(max(1, len(words) - width + 1))] if words else []
    h = [xxhash.xxh64_intdigest(p, 42) for p in parts]
    return sum(1 << b for b in range(64) if 2 * sum(x >> b & 1 for x in h) > len(h))


def test_covering_masks_miss_no_pair():
    masks, rng = simhash.covering_masks(4), random.Random(1)
    for _ in range(3000):
        differ = sum(1 << b for b in rng.sample(range(64), rng.randint(0, 4)))
        assert any(not m & differ for m in masks)


def test_near_duplicates_match_brute_force(spark):
    rng = random.Random(5)
    base = " ".join(rng.choice("abcdefgh") * rng.randint(1, 4) for _ in range(400))
    texts = [base]
    for _ in range(25):
        words = rng.choice(texts).split()
        words[rng.randrange(len(words))] = "new"
        texts.append(" ".join(words))
    texts += [base.upper(), None, "", " \t\n", "one", "one two three", "ONE two\tthree", "żółw " * 9000, "other words entirely here"]
    docs = spark.createDataFrame(rows_of(enumerate(texts)) + rows_of([(3, texts[3])]), DOCS)
    got = simhash.near_duplicates(docs, bucket_rows=4).collect()
    assert len(got) == len(texts) + 1
    fps = {i: slow_fingerprint(t) for i, t in enumerate(texts)}
    label = {i: i for i in fps}
    for _ in fps:
        for i in fps:
            for j in fps:
                if (fps[i] ^ fps[j]).bit_count() <= 4:
                    label[i] = label[j] = min(label[i], label[j])
    for r in got:
        assert r["fingerprint"] == f"{fps[r['doc_id']]:016x}"
        assert r["component_id"] == label[r["doc_id"]]
    assert simhash.near_duplicates(docs.limit(0)).count() == 0


def test_one_of_each_keeps_one_copy_and_all_columns(spark):
    rng = random.Random(7)
    make = lambda: [str(rng.randrange(10**6)) for _ in range(300)]
    first, second = make(), make()
    near = [*first[:150], "changed", *first[151:]]
    docs = spark.createDataFrame(rows_of(enumerate([" ".join(first), " ".join(first), " ".join(near), " ".join(second), None, "", "short text"])), DOCS)
    kept = simhash.one_of_each(docs, bucket_rows=2)
    assert kept.columns == docs.columns
    ids = {r["doc_id"] for r in kept.collect()}
    assert len(ids & {0, 1, 2}) == 1 and len(ids & {4, 5}) == 1 and {3, 6} <= ids
    assert {r["_row"] for r in kept.collect()} == {"r"}
    assert simhash.one_of_each(docs.limit(0)).count() == 0


def test_crowded_buckets_lose_no_link(spark):
    rng = random.Random(23)
    centre = rng.getrandbits(64)
    fps = {centre ^ sum(1 << b for b in rng.sample(range(64), rng.randint(0, 7))) for _ in range(700)} | {rng.getrandbits(64) for _ in range(50)}
    signed = [x - (1 << 64) if x >> 63 else x for x in fps]
    df = spark.createDataFrame([(x,) for x in signed], "fp long")
    for rows in (3, 40, 4096):  # buckets dealt anew, in chunks, and whole
        label = {x: x for x in fps}

        def top(x):
            while label[x] != x:
                x = label[x]
            return x

        links = [(r["src"] % 2**64, r["dst"] % 2**64) for r in simhash.near_links(df, 4, rows).collect()]
        assert all((a ^ b).bit_count() <= 4 for a, b in links)
        for a, b in links:
            label[top(a)] = top(b)
        assert all(top(a) == top(b) for a in fps for b in fps if (a ^ b).bit_count() <= 4)


def test_one_of_each_in_crowded_buckets(spark):
    rng = random.Random(29)
    base, texts = [str(rng.randrange(10**6)) for _ in range(150)], []
    for _ in range(60):
        words = list(base)
        for i in rng.sample(range(150), rng.randint(1, 12)):
            words[i] = str(rng.randrange(10**6))
        texts.append(" ".join(words))
    sets = [shingles(t) for t in texts]
    label = list(range(60))
    for _ in label:
        for i in label:
            for j in range(60):
                if alike(sets[i], sets[j]) >= 0.8:
                    label[i] = label[j] = min(label[i], label[j])
    assert 1 < len(set(label)) < 60
    docs = spark.createDataFrame(rows_of(enumerate(texts)), DOCS)
    for rows in (2, 7, 1024):
        kept = simhash.one_of_each(docs.repartition(3), bucket_rows=rows).collect()  # out of a shuffle: rows are numbered once
        groups = [label[r["doc_id"]] for r in kept]
        assert sorted(set(groups)) == sorted(set(label)) and len(groups) == len(set(label))


def shingles(text, width=5):
    words = text.lower().split()
    return {tuple(words[i : i + width]) for i in range(max(1, len(words) - width + 1))} if words else set()


def alike(x, y):
    return len(x & y) / max(1, len(x | y))


def test_one_of_each_finds_copies_however_they_were_edited(spark):
    rng = random.Random(9)
    made = lambda n: [str(rng.randrange(10**6)) for _ in range(n)]
    texts = []
    for k in range(240):
        words = made(rng.choice([60, 120, 200, 400]))
        n = len(words)
        cut = n - int(n * 0.15)
        edited = [words + made(n // 5 - 2), words[:cut], words[n - cut :], [w if i % 60 != 30 else "x" for i, w in enumerate(words)]][k % 4]
        texts += [" ".join(words), " ".join(edited)]
    assert all(alike(shingles(a), shingles(b)) >= 0.8 for a, b in zip(texts[::2], texts[1::2]))
    docs = spark.createDataFrame(rows_of(enumerate(texts)), DOCS)
    assert sorted(r["doc_id"] // 2 for r in simhash.one_of_each(docs).collect()) == list(range(240))


def test_one_of_each_links_by_the_sets_themselves(spark):
    rng = random.Random(13)
    texts, close = [], 0
    for k in range(120):
        words = [str(rng.randrange(10**6)) for _ in range(90)]
        other = [w if i not in (20, 45, 70)[: 1 + k % 3] else "x" for i, w in enumerate(words)]
        texts += [" ".join(words), " ".join(other)]
        close += alike(shingles(texts[-2]), shingles(texts[-1])) >= 0.8
    assert 0 < close < 120
    kept = {r["doc_id"] for r in simhash.one_of_each(spark.createDataFrame(rows_of(enumerate(texts)), DOCS)).collect()}
    assert all(len(kept & {2 * k, 2 * k + 1}) == (1 if alike(shingles(texts[2 * k]), shingles(texts[2 * k + 1])) >= 0.8 else 2) for k in range(120))


def slow_decontamination(text, items, width=10):
    cut = lambda t: bytes(c + 32 if 65 <= c <= 90 else c if chr(c).isalnum() and c < 128 or c >= 128 else 32 for c in (t or "").encode()).split()
    words, hit, ids = cut(text), set(), set()
    for item, t in items:
        w = cut(t)
        n = min(width, len(w))
        for a in range(len(w) - n + 1 if n else 0):
            for p in range(len(words) - n + 1):
                if words[p : p + n] == w[a : a + n]:
                    hit.update(range(p, p + n))
                    ids.add(str(item))
    return len(words), len(hit), sorted(ids)


@pytest.mark.parametrize("block_bytes", [1 << 20, 40])
def test_decontamination_matches_brute_force(spark, block_bytes):
    rng = random.Random(2)
    text = lambda n: " ".join(rng.choice("ab") + rng.choice("xy") for _ in range(n))
    items = [(1, text(14)), (2, "Solo"), (10, text(12)), (3, None), (4, " !? "), (5, text(10)), (5, text(11))]
    docs = [(i, text(rng.randint(0, 60))) for i in range(40)] + [(40, None), (41, ""), (42, "so, SOLO!"), (43, items[0][1].upper().replace(" ", "--")), (43, "x " * 50_000 + items[2][1])]
    df = spark.createDataFrame(rows_of(docs), DOCS).withColumnRenamed("score", "n_hit").withColumnRenamed("fp", "_row_")
    bench = spark.createDataFrame([(*x, "clash") for x in items], "item_id long, text string, doc_id string")
    got = decontam.decontaminate(spark, df, bench, block_bytes=block_bytes).collect()
    want = sorted((i, *slow_decontamination(t, items)) for i, t in docs if len(t or "") < 10_000)
    told = sorted((r["doc_id"], r["n_words"], r["n_hit"], r["item_ids"]) for r in got if r["n_words"] < 10_000)
    assert told == want
    assert all(r["items_sha256"] == hashlib.sha256(",".join(r["item_ids"]).encode()).hexdigest() and r["contaminated"] == (r["n_hit"] > 0) for r in got)
    assert next(r for r in got if r["n_words"] > 10_000)["n_hit"] >= 12
    both = decontam.decontaminate(spark, df, bench, block_bytes=block_bytes, keep=("doc_id", "n_hit", "_row_"))
    assert both.columns[:4] == ["doc_id", "n_hit_", "_row__", "n_words"] and {r["n_hit_"] for r in both.collect()} == {0.5}
    assert decontam.decontaminate(spark, df, bench.limit(0)).where("contaminated").count() == 0
    assert decontam.decontaminate(spark, df.limit(0), bench).count() == 0
