"""Benchmark decontamination: a prefix-filtered join of word windows with exact checks.

A window (``width`` consecutive words of an item; the whole item if it has
fewer) is contained in a document only if each of its words is, so for exact
containment the necessary prefix is one word.  Words are ordered by how many
documents hold them, and each window is joined on its rarest one.  A hit of
that word at position p puts the window at p minus its offset (positional
bound); the document must have the window's length of words from there (length
bound); then the words themselves are compared.

The documents stay where they are: no document row is shuffled, so neither a
hot source nor a passage that many documents share makes a large task.  The
benchmark is dealt into blocks of about ``block_bytes`` of text.  Driver and
workers hold one block at a time, whose index each task builds once; a benchmark
of several blocks walks the documents for each, and what the blocks have found
meets in one aggregation of the documents that were hit.
"""

from __future__ import annotations

import hashlib
from collections import Counter, defaultdict
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from trailmark.llm.common import arrow_batches, beside, raw
from trailmark.plans.shared import stored

WIDTH = 10
#: Text of one broadcast block; its index takes about 50 times as much memory in a worker.
BLOCK_BYTES = 2 << 20

#: A-Z become a-z; every other ASCII character but digits and letters parts words.
_FOLD = bytes(c + 32 if 65 <= c <= 90 else c if 48 <= c <= 57 or 97 <= c <= 122 or c >= 128 else 32 for c in range(256))

FOUND = "n_words long, n_hit long, n_items long, items_sha256 string, contaminated boolean, item_ids array<string>, hit_spans array<struct<start:int,end:int>>"


def words_of(text: bytes) -> list[bytes]:
    """Lower-case runs of ASCII letters, digits and anything beyond ASCII."""
    return text.translate(_FOLD).split()


def index_block(items: list[tuple[str, list[bytes]]], seen_in: dict[bytes, int], width: int = WIDTH) -> dict:
    """Each window under its rarest word: word -> [(window's words, offset of the word, ids of the items)]."""
    owners: dict[tuple[bytes, ...], set[str]] = defaultdict(set)
    for item, words in items:
        n = min(width, len(words))
        for at in range(len(words) - n + 1 if n else 0):
            owners[tuple(words[at : at + n])].add(item)
    index: dict[bytes, list] = defaultdict(list)
    for window, ids in owners.items():
        rarest = min(window, key=lambda w: (seen_in.get(w, 0), w))
        index[rarest].append((list(window), window.index(rarest), sorted(ids)))
    return dict(index)


def find(words: list[bytes], index: dict, hit: bytearray, found: set[str]) -> None:
    """Mark the words inside any occurrence of an indexed window; add the items that own it."""
    here = index.keys() & set(words)
    if not here:
        return
    total = len(words)
    for p, word in enumerate(words):
        if word in here:
            for window, offset, ids in index[word]:
                start = p - offset
                end = start + len(window)
                if start >= 0 and end <= total and words[start:end] == window:
                    hit[start:end] = b"\x01" * (end - start)
                    found.update(ids)


def _spans(hit: bytearray) -> list[dict]:
    out, at = [], hit.find(1)
    while at >= 0:
        end = hit.find(0, at)
        end = len(hit) if end < 0 else end
        out.append({"start": at, "end": end})
        at = hit.find(1, end)
    return out


def _document_frequency(texts: DataFrame, words: set[bytes]) -> dict[bytes, int]:
    """In how many documents each word of a block occurs, over all documents."""
    sent = texts.sparkSession.sparkContext.broadcast(words)

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total: Counter = Counter()
        for batch in batches:
            for text in raw(batch.column(0)):
                total.update(sent.value.intersection(words_of(text)))
        if total:
            yield pa.RecordBatch.from_pydict({"word": list(total), "n": list(total.values())}, schema=pa.schema([("word", pa.binary()), ("n", pa.int64())]))

    rows = arrow_batches(texts, count, "word binary, n long").groupBy("word").agg(F.sum("n").alias("n"))
    out = {bytes(r["word"]): r["n"] for r in rows.toLocalIterator()}
    sent.unpersist()
    return out


def _marked(batch: pa.RecordBatch, words: list[list[bytes]], hits: list[bytearray], found: list[set[str]], names: list[str]) -> pa.RecordBatch:
    """The columns of ``batch`` but the last, and those of FOUND."""
    ids, n_hit = [sorted(x) for x in found], [sum(h) for h in hits]
    made = [
        pa.array([len(w) for w in words], pa.int64()), pa.array(n_hit, pa.int64()), pa.array([len(x) for x in ids], pa.int64()),
        pa.array([hashlib.sha256(",".join(x).encode()).hexdigest() for x in ids]), pa.array([n > 0 for n in n_hit]),
        pa.array(ids, pa.list_(pa.string())), pa.array([_spans(h) for h in hits], pa.list_(pa.struct([("start", pa.int32()), ("end", pa.int32())]))),
    ]
    return pa.RecordBatch.from_arrays([*batch.columns[: len(names) - len(made)], *made], names=names)


def decontaminate(spark: SparkSession, docs: DataFrame, benchmark: DataFrame, width: int = WIDTH, block_bytes: int = BLOCK_BYTES, keep: tuple[str, ...] = ("doc_id",)) -> DataFrame:
    """One row per document: ``keep`` columns, its hit words and the items it holds windows of.

    Null and empty texts, of documents or items, have no words: such documents
    are never contaminated, such items never found; very long ones are read
    whole.  Repeated documents are each reported; an item id that occurs twice
    counts once, with the windows of both texts; a null item id is the text
    ``null``.  An empty benchmark marks nothing, an empty table of documents gives
    an empty result.  Other columns of either table are ignored; a column of
    ``keep`` that is named like a new one, or like a name used on the way
    (``_text_``, ``_row_``, ``_ids_``, ``_ends_``), gets an underscore.
    """
    size = benchmark.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    n_blocks = max(1, -(-size // block_bytes))
    items = benchmark.select(F.coalesce(F.col("item_id").cast("string"), F.lit("null")).alias("item"), F.coalesce(F.col("text"), F.lit("")).alias("text"))
    dealt = items.withColumn("block", F.pmod(F.xxhash64("item", "text"), F.lit(n_blocks)))
    new = tuple(x.split()[0] for x in FOUND.split(", "))
    rows = docs.select(*[F.col(f"`{c}`").alias(name) for c, name in beside(keep, (*new, "_text_", "_row_", "_ids_", "_ends_")).items()], F.col("text").alias("_text_"))
    kept = rows.schema.fields[:-1]
    names = [*(f.name for f in kept), *new]
    schema = "".join(f"`{f.name}` {f.dataType.simpleString()}, " for f in kept) + FOUND

    def block(b: int, texts: DataFrame):
        words = [(r["item"], words_of(r["text"].encode())) for r in dealt.where(F.col("block") == b).toLocalIterator()]
        seen_in = _document_frequency(texts, {w for _, own in words for w in own})
        return spark.sparkContext.broadcast((words, seen_in))

    if n_blocks == 1:
        sent = block(0, rows.select("_text_"))

        def mark(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            index = index_block(*sent.value, width)
            for batch in batches:
                texts = [words_of(x) for x in raw(batch.column(len(kept)))]
                hits, found = [bytearray(len(w)) for w in texts], [set() for _ in texts]
                for x in zip(texts, hits, found):
                    find(x[0], index, *x[1:])
                yield _marked(batch, texts, hits, found, names)

        return arrow_batches(rows, mark, schema)

    numbered = stored(rows.withColumn("_row_", F.monotonically_increasing_id()), "numbered")
    told = None
    for b in range(n_blocks):
        sent = block(b, numbered.select("_text_"))

        def search(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            index, out = index_block(*sent.value, width), []
            for batch in batches:
                out = []
                for row, words in zip(batch.column(0).to_pylist(), map(words_of, raw(batch.column(1)))):
                    hit, found = bytearray(len(words)), set()
                    find(words, index, hit, found)
                    if found:
                        out.append((row, sorted(found), [(x["start"], x["end"]) for x in _spans(hit)]))
                if out:
                    pairs = [[v for s in x[2] for v in s] for x in out]
                    yield pa.RecordBatch.from_arrays([pa.array([x[0] for x in out], pa.int64()), pa.array([x[1] for x in out], pa.list_(pa.string())), pa.array(pairs, pa.list_(pa.int32()))], names=["_row_", "_ids_", "_ends_"])

        got = stored(arrow_batches(numbered.select("_row_", "_text_"), search, "_row_ long, _ids_ array<string>, _ends_ array<int>"), "hits")
        sent.unpersist()
        told = got if told is None else told.unionAll(got)
    met = told.groupBy("_row_").agg(F.flatten(F.collect_list("_ids_")).alias("_ids_"), F.flatten(F.collect_list("_ends_")).alias("_ends_"))  # a row for each block at most
    whole = numbered.join(met, "_row_", "left").select(*(f"`{f.name}`" for f in kept), "_text_", "_ids_", "_ends_")

    def merge(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = [words_of(x) for x in raw(batch.column(len(kept)))]
            hits, found = [bytearray(len(w)) for w in texts], [set(x or ()) for x in batch.column(len(kept) + 1).to_pylist()]
            for hit, ends in zip(hits, batch.column(len(kept) + 2).to_pylist()):
                for a, e in zip((ends or ())[::2], (ends or ())[1::2]):
                    hit[a:e] = b"\x01" * (e - a)
            yield _marked(batch, texts, hits, found, names)

    return arrow_batches(whole, merge, schema)
