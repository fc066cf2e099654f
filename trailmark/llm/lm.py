"""Hashed maximum-entropy language model with a class-factored softmax.

P(token | context) = P(class | context) * P(token | class, context).

Both factors are log-linear in hashed features of the context: the token before
(bigram), the pair before (trigram), and the tokens two and three back (skips).
The first factor has a row of ``CLASSES`` weights for each bucket of each
template; the second, for the ``HEAD`` most frequent words, a row of ``SLOTS``
weights for each class and bucket.  Words of a class are alike in what stands
next to them.  Rarer words lie in classes by hashed endings, where a word has its
smoothed share of the class: the vocabulary has no bound, weights have.  With
one unseen type in every class of rare words the model sums to one.

Training is by distributed gradient updates.  In every round all tasks walk all
training texts and add up, for each weight, how often its outcome came and how
often the model expected it (the gradient is their difference); the sums meet
in a shuffle, block by block, and the weights of all templates move along the
gradient with each coordinate scaled by what was expected (iterative scaling).
At the zero weights of the first round what is expected is a product of two
counts, so that round counts only what came.

Texts are tokenised twice: once to count words, and once into stored word
numbers, which every later step reads.  Counts are exact and cover the whole
training corpus: tasks count words into bounded dictionaries, Spark sums them.
Only the some ``DICTIONARY`` most frequent words and the weights, of fixed size,
are sent to all tasks; every other word meets its count in a shuffled join.
Words of more than ``LONG`` bytes are told by a 128-bit digest throughout.
"""

from __future__ import annotations

import zlib
from collections import Counter
from collections.abc import Callable, Iterator
from dataclasses import dataclass
from itertools import repeat

import numpy as np
import pyarrow as pa
import xxhash
import zstandard
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from trailmark.llm.common import arrow_batches, raw, remainder
from trailmark.plans.shared import stored

DICTIONARY, LONG = 1 << 18, 64
#: Classes of frequent words and words of each, classes of rare words.
HEAD_CLASSES, SLOTS, TAIL_CLASSES = 48, 64, 16
HEAD, CLASSES = HEAD_CLASSES * SLOTS, HEAD_CLASSES + TAIL_CLASSES  # CLASSES is SLOTS, so that both factors use the same memory
#: Buckets of a single token and of a pair, for the first factor, and for each class of the second.
BUCKETS, PAIRS = 4096, 8192
NEAR, NEAR_PAIRS = 256, 512
#: First row of each template, and the rows of all, in the weights of either factor.
FIRST = (0, BUCKETS, 2 * BUCKETS, 3 * BUCKETS, 3 * BUCKETS + PAIRS)
SECOND = (0, NEAR, 2 * NEAR, 3 * NEAR, 3 * NEAR + NEAR_PAIRS)
CELLS = (FIRST[-1] * CLASSES, HEAD_CLASSES * SECOND[-1] * SLOTS)
#: Rounds that walk the texts with a softmax, step of the first round by template, step of later rounds, prior counts.
ROUNDS, MIX, RATE, SMOOTH = 1, (0.6, 0.35, 0.25, 0.4), 0.45, (100.0, 100.0)
#: Tokens scored at once, words and bytes of text counted before they are handed on, numbers of one summed block.
CHUNK, FLUSH, FLUSH_BYTES, BLOCK = 2048, 200_000, 64 << 20, 1 << 14
#: Neighbours that tell classes apart: the most frequent words, and any other.
SIGNS = 64
END = b"\n"  # no word holds it


def words_of(text: bytes) -> list[bytes]:
    """Words with A-Z lower-cased, then the end token."""
    words = text.lower().split()
    words.append(END)
    return words


def key_of(word: bytes) -> bytes:
    """The word, or a digest that no word can be equal to."""
    return word if len(word) <= LONG else END + xxhash.xxh3_128_digest(word)


def tail_class(key: bytes) -> int:
    h = xxhash.xxh64_intdigest(key[-2:], 42)
    return (h - (1 << 64) if h >> 63 else h) % TAIL_CLASSES


def word_counts(docs: DataFrame) -> DataFrame:
    """(word binary, c long): how often each token occurs in ``text``, long words by their digest."""

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        found, size = Counter(), 0
        kind = pa.schema([("word", pa.binary()), ("n", pa.int64())])
        out = lambda: pa.RecordBatch.from_arrays([pa.array(map(key_of, found), pa.binary()), pa.array(list(found.values()), pa.int64())], schema=kind)
        for batch in batches:
            for text in raw(batch.column(0)):
                found.update(words_of(text))
                size += len(text)
                if len(found) > FLUSH or size > FLUSH_BYTES:
                    yield out()
                    found.clear()
                    size = 0
        if found:
            yield out()

    return arrow_batches(docs.select("text"), count, "word binary, n long").groupBy("word").agg(F.sum("n").alias("c"))


def _most_frequent(vocabulary: DataFrame) -> list[tuple[bytes, int]]:
    """The ``DICTIONARY`` most frequent words and their counts, or somewhat fewer: of words that the last place is too
    small for, all within 2 % of one another, none is taken.  So no task has to send the driver more than it needs."""
    level = F.floor(F.log2("c") * 48).cast("int")  # some thousand levels, whatever the corpus
    sizes = vocabulary.groupBy(level.alias("level")).agg(F.count("*").alias("n")).orderBy(F.desc("level")).collect()
    room, least = DICTIONARY, None
    for r in sizes:
        room -= r["n"]
        if room < 0:
            break
        least = r["level"]
    if least is None:
        return []
    found = vocabulary.where(level >= least).select("word", "c").toArrow()
    return sorted(zip(found.column(0).to_pylist(), found.column(1).to_pylist()), key=lambda x: (-x[1], x[0]))


def encode(text: bytes, words: dict[bytes, int]) -> tuple[np.ndarray, dict[bytes, int]]:
    """Each token's number in the dictionary, or a negative code of its hash and tail class; and the tokens outside."""
    tokens = words_of(text)
    codes = np.fromiter(map(words.get, tokens, repeat(-1)), np.int32, len(tokens))
    outside: dict[bytes, int] = {}
    for i in np.flatnonzero(codes < 0).tolist():
        key = key_of(tokens[i])
        n = words.get(key, -1) if key is not tokens[i] else -1
        if n < 0:
            n = -1 - ((zlib.crc32(key) >> 5) * TAIL_CLASSES + tail_class(key))
            outside[key] = outside.get(key, 0) + 1
        codes[i] = n
    return codes, outside


def encoded(rows: DataFrame, words: dict[bytes, int], log_count: np.ndarray) -> DataFrame:
    """Rows (doc_id, held_out, text) as word numbers, with what the dictionary alone tells, and the words outside it."""
    sent = rows.sparkSession.sparkContext.broadcast((words, log_count))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known, logs = sent.value
        for batch in batches:
            if not batch.num_rows:
                continue
            made = [encode(x, known) for x in raw(batch.column(2))]
            inside = [c[c >= 0] for c, _ in made]
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column(0), batch.column(1), pa.array([len(c) for c, _ in made], pa.int64()), pa.array([len(c) for c in inside], pa.int64()),
                    pa.array([float(logs[c].sum()) for c in inside], pa.float64()), pa.array([c.tobytes() for c, _ in made], pa.binary()),
                    pa.array([list(o) for _, o in made], pa.list_(pa.binary())), pa.array([list(o.values()) for _, o in made], pa.list_(pa.int64())),
                ],
                names=["doc_id", "held_out", "n_tokens", "known", "counts", "codes", "words", "times"],
            )

    kind = "doc_id long, held_out boolean, n_tokens long, known long, counts double, codes binary, words array<binary>, times array<long>"
    made = arrow_batches(rows.select("doc_id", "held_out", F.coalesce("text", F.lit("")).alias("text")), run, kind)
    return stored(made.withColumn("row", F.monotonically_increasing_id()), "encoded")


def _joined(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """All codes of a batch in one array, and where each text starts; every text has a token."""
    parts = [np.frombuffer(x, np.int32) for x in column.to_pylist()]
    sizes = np.array([len(x) for x in parts])
    return np.concatenate(parts).astype(np.int64), np.concatenate([[0], np.cumsum(sizes)[:-1]]).astype(np.int64)


def summed(codes: DataFrame, add: Callable[[np.ndarray, np.ndarray, np.ndarray], None], size: int) -> np.ndarray:
    """Sum over all texts of what ``add`` puts into an array of ``size``; each task sends only blocks with numbers in."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        flat, pack = np.zeros(size, np.float32), zstandard.ZstdCompressor(level=1)
        for batch in batches:
            if batch.num_rows:
                add(flat, *_joined(batch.column(0)))
        flat = (flat.view(np.uint32) + np.uint32(1 << 6)) & np.uint32(0xFFFFFF80)  # 17 bits are enough, and shrink
        for k in range(0, size, BLOCK):
            part = flat[k : k + BLOCK]
            if part.any():
                yield pa.RecordBatch.from_arrays([pa.array([k // BLOCK], pa.int32()), pa.array([pack.compress(part.tobytes())], pa.binary())], names=["key", "block"])

    def total(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        at, x, unpack = None, None, zstandard.ZstdDecompressor()
        out = lambda: pa.RecordBatch.from_arrays([pa.array([at], pa.int32()), pa.array([x.tobytes()], pa.binary())], names=["key", "block"])
        for batch in batches:
            for key, block in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                if key != at:
                    if at is not None:
                        yield out()
                    at, x = key, np.zeros(min(BLOCK, size - key * BLOCK))
                x += np.frombuffer(unpack.decompress(block), np.float32)
        if at is not None:
            yield out()

    n = int(codes.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    blocks = arrow_batches(codes.select("codes"), run, "key int, block binary").repartition(n, "key").sortWithinPartitions("key")
    flat = np.zeros(size)
    for r in arrow_batches(blocks, total, "key int, block binary").toLocalIterator():
        x = np.frombuffer(r["block"], np.float64)
        flat[r["key"] * BLOCK : r["key"] * BLOCK + len(x)] = x
    return flat


def _back(x: np.ndarray, starts: np.ndarray, end: int) -> list[np.ndarray]:
    """``x`` of the tokens one, two and three back; ``end`` before the start of a text."""
    n, out = len(x), []
    place = np.arange(n) - np.repeat(starts, np.diff(np.append(starts, n)))
    for k in (1, 2, 3):
        y = np.full(n, end, x.dtype)
        y[k:] = x[:-k] if k < n else end
        y[place < k] = end
        out.append(y)
    return out


def _room() -> tuple[np.ndarray, np.ndarray]:
    """Memory for the numbers of one chunk, used again and again."""
    return np.empty((CHUNK, CLASSES), np.float32), np.empty((CHUNK, CLASSES), np.float32)


@dataclass
class Model:
    """Everything a task needs to score codes; its size does not depend on the corpus."""

    log_count: np.ndarray  # log10(count + 1) by number
    klass: np.ndarray  # class by number
    slot: np.ndarray  # place in the class by number; 0 for rare words
    end: int  # number of the end token
    room: np.ndarray  # log10 of count and types of each class of rare words
    bias: tuple[np.ndarray, np.ndarray]  # (CLASSES,), (HEAD_CLASSES, SLOTS)
    weights: tuple[np.ndarray, np.ndarray]  # (FIRST[-1], CLASSES), (HEAD_CLASSES * SECOND[-1], SLOTS)

    def classes(self, codes: np.ndarray) -> np.ndarray:
        return np.where(codes < 0, HEAD_CLASSES + (-1 - codes) % TAIL_CLASSES, self.klass[np.maximum(codes, -1)])

    def features(self, codes: np.ndarray, klass: np.ndarray, starts: np.ndarray) -> tuple[list[np.ndarray], list[np.ndarray]]:
        """Rows of the first factor, by template, and rows of the second within those of the token's class."""
        own = np.where((codes >= 0) & (codes < HEAD), codes, HEAD + np.abs(codes) % (BUCKETS - HEAD)).astype(np.uint16)
        near = (klass * (NEAR // CLASSES)).astype(np.uint16) + own % np.uint16(NEAR // CLASSES)
        end = int(self.klass[self.end]) * (NEAR // CLASSES) + self.end % (NEAR // CLASSES)
        mixed = lambda one, two, n: ((one * np.uint32(40_503) + two * np.uint32(2_654_435_761)) >> np.uint32(7)) % np.uint32(n)
        (a, b, c), (x, y, z) = _back(own, starts, self.end), _back(near, starts, end)
        first = [a, b + np.uint16(FIRST[1]), c + np.uint16(FIRST[2]), mixed(a.astype(np.uint32), b.astype(np.uint32), PAIRS).astype(np.uint16) + np.uint16(FIRST[3])]
        return first, [x, y + np.uint16(SECOND[1]), z + np.uint16(SECOND[2]), mixed(x.astype(np.uint32), y.astype(np.uint32), NEAR_PAIRS).astype(np.uint16) + np.uint16(SECOND[3])]

    def decisions(self, codes: np.ndarray, starts: np.ndarray) -> Iterator[tuple[int, np.ndarray, list[np.ndarray], np.ndarray, np.ndarray]]:
        """(factor, tokens it is for, rows by template, class of the bias, outcome), in an order that keeps the rows in use few."""
        klass = self.classes(codes)
        first, second = self.features(codes, klass, starts)
        at = np.argsort(first[0], kind="stable")
        yield 0, at, [x[at] for x in first], klass[at], klass[at]
        at = np.argsort(klass.astype(np.uint8), kind="stable")
        at = at[: np.count_nonzero(klass < HEAD_CLASSES)]
        base = (klass[at] * SECOND[-1]).astype(np.uint16)
        yield 1, at, [base + x[at] for x in second], klass[at], self.slot[codes[at]]

    def odds(self, factor: int, rows: list[np.ndarray], given: np.ndarray, room: tuple[np.ndarray, np.ndarray]) -> np.ndarray:
        """What P(outcome | rows) is proportional to, for each token; weights are bounded, so nothing overflows."""
        z, more = (x[: len(given)] for x in room)
        np.take(self.weights[factor], rows[0], axis=0, out=z, mode="clip")
        for r in rows[1:]:
            z += np.take(self.weights[factor], r, axis=0, out=more, mode="clip")
        z += np.take(self.bias[factor], given, axis=0, out=more, mode="clip") if factor else self.bias[0]
        return np.exp(z, out=z)

    def logs(self, codes: np.ndarray, starts: np.ndarray) -> np.ndarray:
        """log10 P of each token but, for those outside the dictionary, log10 of their count and one."""
        out, room, ones = np.zeros(len(codes)), _room(), np.ones(CLASSES, np.float32)
        for factor, at, rows, given, outcome in self.decisions(codes, starts):
            for a in range(0, len(at), CHUNK):
                z = self.odds(factor, [r[a : a + CHUNK] for r in rows], given[a : a + CHUNK], room)
                out[at[a : a + CHUNK]] += np.log10(z[np.arange(len(z)), outcome[a : a + CHUNK]] / (z @ ones))
            if not factor:
                rare = at[outcome >= HEAD_CLASSES]
                out[rare] += np.where(codes[rare] < 0, 0, self.log_count[np.maximum(codes[rare], 0)]) - self.room[outcome[outcome >= HEAD_CLASSES] - HEAD_CLASSES]
        return out


def add_came(model: Model, flat: np.ndarray, codes: np.ndarray, starts: np.ndarray) -> None:
    """Add how often each outcome came with each row, of both factors."""
    for factor, _, rows, _, outcome in model.decisions(codes, starts):
        width, low = (CLASSES, SLOTS)[factor], factor * CELLS[0]
        part = flat[low : low + CELLS[factor]]
        for r in rows:
            part += np.bincount(r.astype(np.int64) * width + outcome, minlength=CELLS[factor]).astype(np.float32)


def add_expected(model: Model, flat: np.ndarray, codes: np.ndarray, starts: np.ndarray) -> None:
    """Add how often the model expects each outcome with each row, of both factors."""
    room, ones = _room(), np.ones(CLASSES, np.float32)
    for factor, at, rows, given, _ in model.decisions(codes, starts):
        table = flat[factor * CELLS[0] :][: CELLS[factor]].reshape(-1, (CLASSES, SLOTS)[factor])
        for a in range(0, len(at), CHUNK):
            part = [r[a : a + CHUNK] for r in rows]
            p = model.odds(factor, part, given[a : a + CHUNK], room)
            p /= (p @ ones)[:, None]
            for r in part:
                order = np.argsort(r, kind="stable")  # a radix sort, for 16 bits
                same = r[order]
                first = np.flatnonzero(np.concatenate([[True], same[1:] != same[:-1]]))
                sorted_ = np.take(p, order, axis=0, out=room[1][: len(p)], mode="clip").view(np.complex64)  # two numbers are added at once
                table[same[first]] += np.add.reduceat(sorted_, first, axis=0).view(np.float32)


def add_neighbours(flat: np.ndarray, codes: np.ndarray, starts: np.ndarray) -> None:
    """Add how often each frequent word has each of the signs before and after it."""
    sign = np.where((codes >= 0) & (codes < SIGNS - 1), codes, SIGNS - 1)
    own = (codes >= 0) & (codes < HEAD)
    inner = np.ones(len(codes), bool)
    inner[starts] = False  # nothing stands before a text
    at = np.flatnonzero(own & inner)
    flat += np.bincount(codes[at] * 2 * SIGNS + sign[at - 1], minlength=flat.size)
    at = np.flatnonzero(own[:-1] & inner[1:])
    flat += np.bincount(codes[at] * 2 * SIGNS + SIGNS + sign[at + 1], minlength=flat.size)


def clusters(seen: np.ndarray, n: int) -> np.ndarray:
    """``n`` classes, of ``SLOTS`` words at most, of the rows of ``seen``: halved again and again along the direction in which they differ most."""
    shares = np.sqrt(seen / np.maximum(seen.sum(axis=1, keepdims=True), 1))
    out = np.zeros(len(seen), np.int64)

    def part(rows: np.ndarray, low: int, n: int) -> None:
        if n < 2 or not len(rows):
            out[rows] = low
            return
        x = shares[rows] - shares[rows].mean(axis=0)
        along = np.linalg.eigh(x.T @ x)[1][:, -1]
        along *= np.sign(along[np.abs(along).argmax()])
        order = rows[np.argsort(x @ along, kind="stable")]
        cut = -(-len(rows) * (n // 2) // n)
        part(order[:cut], low, n // 2), part(order[cut:], low + n // 2, n - n // 2)

    part(np.arange(len(seen)), 0, n)
    return out


def start(vocabulary: DataFrame, top: list[tuple[bytes, int]], klass: np.ndarray) -> Model:
    """A model of exact unigram counts; ``klass`` has the classes of the frequent words."""
    counts, head = np.array([c for _, c in top], np.float64), len(klass)
    of = np.concatenate([klass, [tail_class(w) + HEAD_CLASSES for w, _ in top[head:]], [0]]).astype(np.int64)
    slot = np.zeros(len(top) + 1, np.int64)
    mass, types, shares = np.zeros(CLASSES), np.zeros(CLASSES), np.full((HEAD_CLASSES, SLOTS), 1e-9)
    for k in range(HEAD_CLASSES):
        own = np.flatnonzero(klass == k)
        slot[own] = np.arange(len(own))
        mass[k] = counts[own].sum()
        shares[k, : len(own)] = counts[own] / max(mass[k], 1)
    ending = F.pmod(F.xxhash64(F.expr("substring(word, -2, 2)")), F.lit(TAIL_CLASSES)).cast("int")  # as tail_class()
    for r in vocabulary.groupBy(ending.alias("k")).agg(F.sum("c").alias("m"), F.count("*").alias("t")).collect():
        mass[HEAD_CLASSES + r["k"]], types[HEAD_CLASSES + r["k"]] = r["m"], r["t"]
    for w, c in top[:head]:  # those have classes of their own
        mass[HEAD_CLASSES + tail_class(w)] -= c
        types[HEAD_CLASSES + tail_class(w)] -= 1
    bias = np.log((mass + 1) / (mass + 1).sum()).astype(np.float32), np.log(shares / shares.sum(axis=1, keepdims=True)).astype(np.float32)
    room = np.log10(mass[HEAD_CLASSES:] + types[HEAD_CLASSES:] + 1)
    end = next((i for i, (w, _) in enumerate(top) if w == END), 0)
    weights = np.zeros((FIRST[-1], CLASSES), np.float32), np.zeros((HEAD_CLASSES * SECOND[-1], SLOTS), np.float32)
    return Model(np.log10(np.append(counts, 0) + 1), of, slot, end, room, bias, weights)


def _tables(flat: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    return flat[: CELLS[0]].reshape(-1, CLASSES), flat[CELLS[0] :].reshape(-1, SLOTS)


def update(model: Model, came: np.ndarray, expected: np.ndarray | None) -> None:
    """One step of the weights of all templates; without ``expected`` it is what zero weights expect."""
    for factor, (seen, cuts) in enumerate(zip(_tables(came), (FIRST, SECOND))):
        for k, bias in enumerate(np.atleast_2d(model.bias[factor])):
            p = np.exp(bias.astype(np.float64))
            for t, (a, b) in enumerate(zip(cuts, cuts[1:])):
                rows = slice(k * cuts[-1] + a, k * cuts[-1] + b)
                thought = seen[rows].sum(axis=1, keepdims=True) * p if expected is None else _tables(expected)[factor][rows]
                step = np.log((seen[rows] + SMOOTH[factor] * p) / (thought + SMOOTH[factor] * p))
                w = model.weights[factor][rows] + (MIX[t] if expected is None else RATE) * step
                model.weights[factor][rows] = np.clip(w, -8, 8)


def train(codes: DataFrame, vocabulary: DataFrame, top: list[tuple[bytes, int]], rounds: int = ROUNDS) -> Model:
    """Fit on the ``codes`` of the training texts; every round walks all of them for all templates."""
    sc, head = codes.sparkSession.sparkContext, min(HEAD, len(top))
    signs = summed(codes, add_neighbours, HEAD * 2 * SIGNS).reshape(HEAD, -1)[:head] if head else np.zeros((0, 1))
    model = start(vocabulary, top, clusters(signs, HEAD_CLASSES))
    if not head:
        return model

    def walk(add: Callable) -> np.ndarray:
        sent = sc.broadcast(model)
        flat = summed(codes, lambda *x: add(sent.value, *x), sum(CELLS))
        sent.unpersist()
        return flat

    came = walk(add_came)
    update(model, came, None)
    for _ in range(rounds):
        update(model, came, walk(add_expected))
    return model


def score(docs: DataFrame, folds: int = 7, held: int = 2, rounds: int = ROUNDS) -> DataFrame:
    """doc_id, held_out, n_tokens, n_known, train_tokens, base_score, score for every row.

    A null text is empty: one end token.  Repeated rows are scored, and learnt
    from, each; a null doc_id counts as empty text when the fold is taken.  Very
    long texts are read whole, very long words count like any other.  Without
    training texts all counts are 0.  Extra columns are ignored, whatever they
    are called; an empty table gives an empty result.
    """
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), (remainder("doc_id", folds) == held).alias("held_out"), F.col("text").cast("string").alias("text"))
    vocabulary = stored(word_counts(rows.where("NOT held_out")), "vocabulary")
    n, v = (int(x or 0) for x in vocabulary.agg(F.sum("c"), F.count("*")).first())
    top = _most_frequent(vocabulary)
    known = encoded(rows, {w: i for i, (w, _) in enumerate(top)}, np.log10(np.array([c for _, c in top], np.float64) + 1))
    sent = docs.sparkSession.sparkContext.broadcast(train(known.where("NOT held_out"), vocabulary, top, rounds))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if batch.num_rows:
                codes, starts = _joined(batch.column(6))
                yield pa.RecordBatch.from_arrays([*batch.columns[:6], pa.array(np.add.reduceat(sent.value.logs(codes, starts), starts))], names=[*batch.schema.names[:6], "logs"])

    told = arrow_batches(
        known.select("row", "doc_id", "held_out", "n_tokens", "known", "counts", "codes"), run, "row long, doc_id long, held_out boolean, n_tokens long, known long, counts double, logs double"
    )
    outside = known.select("row", F.explode(F.arrays_zip("words", "times")).alias("x")).select("row", F.col("x.words").alias("word"), F.col("x.times").alias("times"))
    met = outside.join(vocabulary, "word").groupBy("row").agg(F.sum(F.col("times") * F.log10(F.col("c") + F.lit(1.0))).alias("rare"), F.sum("times").alias("more"))  # others add nothing
    rare, room = F.coalesce("rare", F.lit(0.0)), float(np.log10(n + v + 1))
    return told.join(met, "row", "left").select(
        "doc_id", "held_out", "n_tokens", (F.col("known") + F.coalesce("more", F.lit(0))).alias("n_known"), F.lit(n).cast("long").alias("train_tokens"),
        (F.col("counts") + rare - F.col("n_tokens") * F.lit(room)).alias("base_score"), (F.col("logs") + rare).alias("score"),
    )
