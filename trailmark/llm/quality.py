"""Quality classifier by compression.

Two zstandard dictionaries are built, one from good and one from bad labelled
text.  A text is cut into blocks of ``CHUNK`` bytes, all of which are compressed
with either dictionary and with none, so the dictionaries count alike at the
start and at the end of long texts.  The difference of the two sizes over the
plain compressed size, together with how far the text compresses at all and how
short it is, goes through a logistic curve fitted on labelled text that neither
dictionary has seen.

The labelled sample is bounded: about ``sample_rows`` documents of each label, of
any length.  Half of them make the dictionaries, from whole blocks drawn evenly
over all their text up to about ``sample_bytes`` a label; of the other half the tasks
compute the curve's inputs from the whole texts, so the driver never holds one.
Scoring reads every whole text.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import xxhash
import zstandard
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from trailmark.llm.common import map_arrow, raw, remainder
from trailmark.plans.shared import forget, stored

CHUNK, DICTIONARY_BYTES, LEVEL = 4096, 110 << 10, 1
SAMPLE_ROWS, SAMPLE_BYTES = 4000, 8 << 20
THRESHOLD = 0.3


def _chunks(text: bytes) -> list[bytes]:
    return [text[i : i + CHUNK] for i in range(0, len(text), CHUNK)]


def _dictionary(parts: list[bytes]) -> bytes:
    """A trained dictionary, or the joined blocks where they are too few to train on."""
    try:
        return zstandard.train_dictionary(DICTIONARY_BYTES, parts, k=256, d=8).as_bytes()
    except zstandard.ZstdError:
        return b"".join(parts)[-DICTIONARY_BYTES:]


class Sizes:
    """Compressed sizes of a text with the good, the bad and no dictionary."""

    def __init__(self, good: bytes, bad: bytes):
        make = lambda d: zstandard.ZstdCompressor(level=LEVEL, write_content_size=False, write_dict_id=False, **({"dict_data": zstandard.ZstdCompressionDict(d)} if d else {}))
        self.all = [make(good), make(bad), make(b"")]
        self.frame = len(self.all[2].compress(b""))

    def features(self, text: bytes) -> list[float]:
        parts = _chunks(text)
        g, b, p = (sum(len(c.compress(x)) - self.frame for x in parts) for c in self.all)
        n, p = max(len(text), 1), max(p, 1)
        d, r, short = 10 * min(max((g - b) / p, -0.5), 0.5), float(np.log(p / n)), min(max(4.5 - float(np.log(n)), 0), 3)
        return [1, d, d * d, min(max(r, -5), 0) + 0.7, min(r + 1.3, 0), min(r + 2.5, 0), max(r + 0.5, 0), short, d * short, (g + b) / 2 / p]


@dataclass(frozen=True)
class Model:
    good: bytes
    bad: bytes
    weights: tuple[float, ...]

    def score(self, texts: list[bytes]) -> np.ndarray:
        if not texts:
            return np.empty(0)
        sizes = Sizes(self.good, self.bad)
        x = np.array([sizes.features(t) for t in texts])
        return 1 / (1 + np.exp(-np.clip(x @ np.array(self.weights), -30, 30)))


def fit_curve(x: np.ndarray, y: np.ndarray, share_good: float) -> tuple[float, ...]:
    """Weights of the logistic curve for rows of inputs and labels 0 or 1, weighted to the share of good labels."""
    beta = np.zeros(10)
    w = np.where(y == 1, share_good / max(y.sum(), 1), (1 - share_good) / max((1 - y).sum(), 1)) * len(y)
    for _ in range(60 if len(y) else 0):
        p = 1 / (1 + np.exp(-np.clip(x @ beta, -30, 30)))
        hessian = x.T @ (x * (w * p * (1 - p) + 1e-6)[:, None]) + 0.1 * np.eye(len(beta))
        beta = beta + np.linalg.solve(hessian, x.T @ (w * (y - p)) - 0.1 * beta)
    return tuple(beta.tolist())


def train(docs: DataFrame, labels: DataFrame, folds: int = 5, held: int = 0, sample_rows: int = SAMPLE_ROWS, sample_bytes: int = SAMPLE_BYTES) -> Model:
    """Fit on labelled rows outside the held-out fold.

    Labels other than 0 and 1 are left out; a document labelled more than once
    counts once per distinct label, and a doc_id that several rows have counts
    with the least of their texts.  Null texts are empty.  Without labels of both
    kinds, or with empty tables, the score is a constant.
    """
    known = labels.select(F.col("doc_id").alias("_id"), F.col("quality").cast("int").alias("quality")).where("_id IS NOT NULL AND quality IN (0, 1)").where(remainder("_id", folds) != held).distinct()
    counts = {r["quality"]: r["n"] for r in known.groupBy("quality").agg(F.count("*").alias("n")).collect()}
    if not counts:
        return Model(b"", b"", (0.0,) * 10)
    # a hash-ordered sample of about sample_rows ids: small enough to broadcast
    share = F.create_map(*[F.lit(x) for label, n in counts.items() for x in (label, int((1 << 20) * min(1.0, sample_rows / n)))])
    ids = known.where(F.pmod(F.xxhash64("_id"), F.lit(1 << 20)) < share[F.col("quality")])
    met = docs.select(F.col("doc_id").alias("_id"), F.coalesce("text", F.lit("")).alias("text")).join(F.broadcast(ids), "_id")
    sample = stored(met.groupBy("_id", "quality").agg(F.min("text").alias("text")), "labelled")
    half = F.pmod(F.xxhash64(F.lit("half"), "_id"), F.lit(2))
    sizes = {r["quality"]: r["n"] or 0 for r in sample.where(half == 0).groupBy("quality").agg(F.sum(F.octet_length("text")).alias("n")).collect()}
    limit = {label: (1 << 32) * min(1.0, sample_bytes / max(n, 1)) for label, n in sizes.items()}

    def pick(batch: pa.RecordBatch) -> pa.RecordBatch:
        told = [(q, c) for i, q, t in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), raw(batch.column(2))) for at, c in enumerate(_chunks(t)) if xxhash.xxh32_intdigest(f"{at} {i}") < limit[q]]
        return pa.RecordBatch.from_arrays([pa.array([q for q, _ in told], pa.int32()), pa.array([c for _, c in told], pa.binary())], names=["quality", "part"])

    parts: dict[int, list[bytes]] = {0: [], 1: []}
    picked = map_arrow(sample.where(half == 0).select(F.col("_id").cast("string"), "quality", "text"), pick, "quality int, part binary").toArrow()
    for label, part in zip(picked.column(0).to_pylist(), picked.column(1).to_pylist()):
        parts[label].append(part)
    good, bad = (_dictionary(sorted(parts[k], key=xxhash.xxh64_intdigest)) for k in (1, 0))

    def inputs(batch: pa.RecordBatch) -> pa.RecordBatch:
        sizes = Sizes(good, bad)
        return pa.RecordBatch.from_arrays([batch.column(0), pa.array([sizes.features(t) for t in raw(batch.column(1))], pa.list_(pa.float64()))], names=["quality", "x"])

    held_back = sample if sample.where(half == 1).select("quality").distinct().count() < len(counts) else sample.where(half == 1)  # a handful of labels serves for both
    told = sorted((r["quality"], r["x"]) for r in map_arrow(held_back.select("quality", "text"), inputs, "quality int, x array<double>").collect())
    forget(sample)
    weights = fit_curve(np.array([x for _, x in told]).reshape(-1, 10), np.array([y for y, _ in told], float), counts.get(1, 0) / sum(counts.values()))
    return Model(good, bad, weights)


def classify(docs: DataFrame, model: Model, keep: list[str], folds: int = 5, held: int = 0) -> DataFrame:
    """``keep`` columns plus held_out, score and predicted, for every row.

    A null text is scored as empty, very long texts whole; repeated rows get the
    same score; a null doc_id counts as empty text when the fold is taken.  An
    empty table gives an empty result.  Columns of ``keep`` that are called
    held_out, score or predicted are replaced.
    """
    sent = docs.sparkSession.sparkContext.broadcast(model)  # two dictionaries and ten weights
    keep = [c for c in keep if c not in ("held_out", "score", "predicted")]
    rows = docs.select(*keep, (remainder("doc_id", folds) == held).alias("held_out"), F.col("text").alias("_text"))

    def run(batch: pa.RecordBatch) -> pa.RecordBatch:
        score = sent.value.score(raw(batch.column(batch.num_columns - 1)))
        return pa.RecordBatch.from_arrays([*batch.columns[:-1], pa.array(score), pa.array((score >= THRESHOLD).astype(np.int32))], names=[*batch.schema.names[:-1], "score", "predicted"])

    schema = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in rows.schema.fields[:-1]) + ", score double, predicted int"
    return map_arrow(rows, run, schema)
