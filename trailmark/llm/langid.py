"""Hierarchical language identification with linear support vector machines.

Features are hashed n-grams of the whole text's UTF-8 bytes (one to three bytes,
with word bounds; lower-cased, what is neither a letter a-z nor beyond ASCII being
a bound), square-rooted and scaled to length one.  One-versus-rest
machines choose the language family; within it, one machine for each pair of
languages votes.  Machines are fitted in the primal with squared hinge loss on
a bounded sample: at most ``per_lang`` texts a language and about ``sample_rows``
in all, but never fewer than ``LEAST`` of a language that has so many, whatever
their length; every language is learnt.  The tasks compute the features of
whole texts, the driver gets numbers of fixed size.  A logistic curve over
the margins of a part that was held back turns margins into probabilities.
"""

from __future__ import annotations

from dataclasses import dataclass
from itertools import combinations

import numpy as np
import pyarrow as pa
import regex
import zstandard
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from trailmark.llm.common import map_arrow, remainder

BUCKETS = 4096
PER_LANG, SAMPLE_ROWS, LEAST = 1000, 8000, 20

#: Language -> family; a language that is not listed is a family of its own.
FAMILIES = {
    **dict.fromkeys("en de nl sv da no nb nn is af lb fy yi".split(), "germanic"),
    **dict.fromkeys("fr es it pt ro ca gl oc la".split(), "romance"),
    **dict.fromkeys("ru uk be pl cs sk bg sr hr bs sl mk".split(), "slavic"),
    **dict.fromkeys("fi et hu".split(), "uralic"),
    **dict.fromkeys("tr az kk uz ky tt".split(), "turkic"),
    **dict.fromkeys("hi bn ur pa mr gu ne".split(), "indo-aryan"),
    **dict.fromkeys("ar he fa mt".split(), "semitic-script"),
    **dict.fromkeys("zh ja ko".split(), "cjk"),
}

_LETTER = regex.compile(r"\p{L}")
_KEEP = bytes(c if 97 <= c <= 122 or c >= 128 else 32 for c in range(256))


def features(text: str, buckets: int = BUCKETS) -> np.ndarray:
    line = np.frombuffer(b" " + b" ".join(text.lower().encode().translate(_KEEP).split()) + b" ", np.uint8).astype(np.uint32)
    two = line[:-1] * np.uint32(257) + line[1:]
    codes = [line * np.uint32(2654435761), two * np.uint32(2246822519) + np.uint32(7)]
    if len(line) > 2:
        codes.append((two[:-1] * np.uint32(257) + line[2:]) * np.uint32(3266489917) + np.uint32(13))
    counts = np.sqrt(np.bincount(np.concatenate(codes) >> np.uint32(20), minlength=buckets)[:buckets].astype(np.float32))
    return counts / max(float(np.sqrt(counts @ counts)), 1e-9)


def _svm(x: np.ndarray, y: np.ndarray, c: float = 20.0, rounds: int = 150) -> np.ndarray:
    """Weights, with the bias last, of a squared-hinge machine for y in {-1, 1}; classes weigh alike."""
    share = np.where(y > 0, 0.5 / max((y > 0).sum(), 1), 0.5 / max((y < 0).sum(), 1)).astype(np.float32) * c
    w = np.zeros(x.shape[1] + 1, np.float32)
    ahead, rate = w.copy(), 1 / (1 + 4 * c)
    for t in range(rounds):  # accelerated gradient
        slack = np.maximum(1 - y * (x @ ahead[:-1] + ahead[-1]), 0) * share * y
        grad = ahead - 2 * np.concatenate([slack @ x, [slack.sum()]])
        grad[-1] -= ahead[-1]  # the bias isn't shrunk
        new = ahead - np.float32(rate) * grad
        ahead = new + np.float32(t / (t + 3)) * (new - w)
        w = new
    return w


def _slope(margin: np.ndarray, y: np.ndarray) -> float:
    """Slope of the logistic curve through zero that fits the margins best."""
    a, slopes = margin * y, np.geomspace(0.5, 64, 40)
    return float(slopes[int(np.argmin([np.logaddexp(0, -s * a).mean() for s in slopes]))]) if len(a) else 1.0


@dataclass(frozen=True)
class Model:
    families: tuple[str, ...]
    members: tuple[tuple[str, ...], ...]
    top: np.ndarray  # (family, weights)
    top_slope: float
    pairs: dict[tuple[str, str], tuple[np.ndarray, float]]

    def predict(self, x: np.ndarray) -> tuple[list[str], np.ndarray]:
        if not self.families:
            return ["und"] * len(x), np.zeros(len(x))
        ones = np.concatenate([x, np.ones((len(x), 1), np.float32)], axis=1)
        if len(self.families) > 1:
            z = self.top_slope * (ones @ self.top.T)
            p = 1 / (1 + np.exp(-np.clip(z, -30, 30)))
            family, sure = z.argmax(axis=1), p.max(axis=1) / np.maximum(p.sum(axis=1), 1e-9)
        else:
            family, sure = np.zeros(len(x), int), np.ones(len(x))
        margins = {k: 1 / (1 + np.exp(-np.clip(s * (ones @ w), -30, 30))) for k, (w, s) in self.pairs.items()}
        langs, score = [], np.empty(len(x))
        for i, f in enumerate(family.tolist()):
            names = self.members[f]
            votes = np.zeros(len(names))
            for a, b in combinations(range(len(names)), 2):
                p = margins[names[a], names[b]][i]
                votes[a] += (p >= 0.5) + p * 1e-3  # ties in votes go by probability
                votes[b] += (p < 0.5) + (1 - p) * 1e-3
            best = int(votes.argmax())
            within = [p if names[best] == k[0] else 1 - p for k, p in ((k, m[i]) for k, m in margins.items() if names[best] in k)]
            langs.append(names[best])
            score[i] = sure[i] * min(within, default=1.0)
        return langs, np.clip(score, 0, 1)


def fit(x: np.ndarray, langs: list[str], families: dict[str, str] | None = None) -> Model:
    """Fit on rows of features and their languages."""
    known = FAMILIES if families is None else families
    of = np.array([known.get(v, v) for v in langs], dtype=object)
    lang, back = np.array(langs, dtype=object), np.arange(len(langs)) % 5 == 4
    names = tuple(sorted(set(of.tolist())))
    members = tuple(tuple(sorted({v for v, f in zip(langs, of) if f == n})) for n in names)
    top, margins, signs = [], [], []
    for n in names if len(names) > 1 else ():
        y = np.where(of == n, 1, -1).astype(np.float32)
        w = _svm(x[~back], y[~back])
        top.append(w), margins.append(x[back] @ w[:-1] + w[-1]), signs.append(y[back])
    pairs = {}
    for group in members:
        for a, b in combinations(group, 2):
            here = (lang == a) | (lang == b)
            y = np.where(lang == a, 1, -1).astype(np.float32)
            w = _svm(x[here & ~back], y[here & ~back])
            pairs[a, b] = (w, _slope(x[here & back] @ w[:-1] + w[-1], y[here & back]))
    return Model(names, members, np.array(top), _slope(np.concatenate(margins), np.concatenate(signs)) if top else 1.0, pairs)


def train(docs: DataFrame, folds: int = 3, held: int = 1, per_lang: int = PER_LANG, sample_rows: int = SAMPLE_ROWS) -> Model:
    """Fit on a hash-ordered sample of every language outside the held-out fold.

    Rows without a language, a text or a letter teach nothing; repeated rows
    count once.  Without any such row nothing is learnt, and all is ``und``.
    """
    rows = docs.where(F.col("lang").isNotNull() & F.col("text").rlike(r"\p{L}")).where(remainder("doc_id", folds) != held)
    counts = rows.groupBy("lang").agg(F.count("*").alias("n"))
    n_langs = counts.count()
    most = max(LEAST, min(per_lang, sample_rows // max(n_langs, 1)))
    share = counts.select("lang", F.least(F.lit(1.0), 1.3 * (most + 10) / F.col("n")).alias("share"))  # a row for each language
    h = F.xxhash64("doc_id", "text")
    picked = rows.select("lang", "text", h.alias("h")).join(F.broadcast(share), "lang").where(F.pmod("h", F.lit(1 << 30)) < F.col("share") * (1 << 30))
    once = picked.groupBy("lang", "h").agg(F.min("text").alias("text"))

    def run(batch: pa.RecordBatch) -> pa.RecordBatch:
        pack = zstandard.ZstdCompressor(level=1)
        return pa.RecordBatch.from_arrays([*batch.columns[:2], pa.array([pack.compress(features(t).tobytes()) for t in batch.column(2).to_pylist()], pa.binary())], names=["lang", "h", "x"])

    got: dict[str, list] = {}
    for r in map_arrow(once, run, "lang string, h long, x binary").toLocalIterator():
        own = got.setdefault(r["lang"], [])
        own.append((r["h"], bytes(r["x"])))
        if len(own) > 2 * most:
            own.sort()
            del own[most:]
    sample = sorted((h, x, lang) for lang, found in got.items() for h, x in sorted(found)[:most])
    unpack = zstandard.ZstdDecompressor()
    x = np.empty((len(sample), BUCKETS), np.float32)
    for i, (_, packed, _) in enumerate(sample):
        x[i] = np.frombuffer(unpack.decompress(packed), np.float32)
    return fit(x, [v for _, _, v in sample])


def identify(docs: DataFrame, model: Model, keep: list[str], folds: int = 3, held: int = 1) -> DataFrame:
    """``keep`` columns plus held_out, lang_pred and score, for every row.

    ``und`` with score 0 for a null or empty text or one without a letter; very
    long texts are read whole; repeated rows get the same answer.  An empty table
    gives an empty result.  A null doc_id counts as empty text when the fold is taken.  Columns of ``keep``
    that are called held_out, lang_pred or score are replaced.
    """
    sent = docs.sparkSession.sparkContext.broadcast(model)  # some weights for each family and pair, whatever the input
    keep = [c for c in keep if c not in ("held_out", "lang_pred", "score")]
    rows = docs.select(*keep, (remainder("doc_id", folds) == held).alias("held_out"), F.col("text").alias("_text"))

    def run(batch: pa.RecordBatch) -> pa.RecordBatch:
        texts = [t or "" for t in batch.column(batch.num_columns - 1).to_pylist()]
        lang, score = ["und"] * len(texts), np.zeros(len(texts))
        there = [i for i, t in enumerate(texts) if _LETTER.search(t)]
        for at in range(0, len(there), 256):
            part = there[at : at + 256]
            names, sure = sent.value.predict(np.array([features(texts[i]) for i in part], dtype=np.float32))
            for i, v, s in zip(part, names, sure):
                lang[i], score[i] = v, s
        return pa.RecordBatch.from_arrays([*batch.columns[:-1], pa.array(lang, pa.string()), pa.array(score)], names=[*batch.schema.names[:-1], "lang_pred", "score"])

    schema = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in rows.schema.fields[:-1]) + ", lang_pred string, score double"
    return map_arrow(rows, run, schema)
