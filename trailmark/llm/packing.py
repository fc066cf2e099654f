"""Best-fit packing of documents into fixed-size sequences under conflicts.

A document longer than the capacity is cut: its full pieces fill bins of their
own, the rest is packed.  Rests are taken by falling size.  Open bins are kept
in order of what room they have; the search starts at the successor of the
piece's size and goes on until the tightest bin is found that is compatible:
each bin carries one bitmap of the sources and one of the duplicate clusters
that it holds, and no bin takes two documents of one source or of one cluster.

The rows are dealt by row number into shards of about ``shard_rows``, whatever
their source or cluster, so a hot source or a large group of copies is spread
evenly.  Only sizes and keys are shuffled, no texts.
"""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

#: Rows of one shard; memory of a shard is at most about 30 MB.
SHARD_ROWS = 16_384
CAPACITY = 2048

_SCHEMA = "doc_id long, piece int, start long, n_tokens long, bin long, bin_offset long"


class Bins:
    """Open bins ordered by residual room, then by number."""

    def __init__(self, capacity: int, n_sources: int, n_clusters: int, most: int):
        self.capacity, self.n_open, self.made = capacity, 0, 0
        self.keys = np.zeros(most + 1, np.int64)  # residual << 32 | bin
        self.first_cluster_word = n_sources // 64 + 1
        self.bits = np.zeros((most, self.first_cluster_word + n_clusters // 64 + 1), np.uint64)

    def place(self, size: int, source: int, cluster: int) -> tuple[int, int]:
        """(bin, offset in the bin) for a piece; -1 stands for no source or no cluster."""
        words = [(source // 64, np.uint64(1 << source % 64))] if source >= 0 else []
        if cluster >= 0:
            words.append((self.first_cluster_word + cluster // 64, np.uint64(1 << cluster % 64)))
        at = self._tightest(size, words)
        if at < 0:
            number, room = self.made, self.capacity
            self.made += 1
        else:
            key = int(self.keys[at])
            number, room = key & 0xFFFFFFFF, key >> 32
            self.keys[at : self.n_open - 1] = self.keys[at + 1 : self.n_open]
            self.n_open -= 1
        for word, bit in words:
            self.bits[number, word] |= bit
        if room > size:
            key = (room - size) << 32 | number
            to = int(np.searchsorted(self.keys[: self.n_open], key))
            self.keys[to + 1 : self.n_open + 1] = self.keys[to : self.n_open]
            self.keys[to] = key
            self.n_open += 1
        return number, self.capacity - room

    def _tightest(self, size: int, words: list) -> int:
        lo, step = int(np.searchsorted(self.keys[: self.n_open], size << 32)), 64
        while lo < self.n_open:
            hi = min(lo + step, self.n_open)
            numbers = self.keys[lo:hi] & 0xFFFFFFFF
            clash = np.zeros(hi - lo, np.uint64)
            for word, bit in words:
                clash |= self.bits[numbers, word] & bit
            free = clash == 0
            first = int(free.argmax())
            if free[first]:
                return lo + first
            lo, step = hi, step * 2
        return -1


def _codes(values: pd.Series, repeated_only: bool) -> np.ndarray:
    """Dense numbers of the values; -1 for null and, if asked, for values that occur once."""
    codes, _ = pd.factorize(values)
    if repeated_only and len(codes):
        kept = np.bincount(codes[codes >= 0], minlength=1) > 1
        dense = np.where(kept, np.cumsum(kept) - 1, -1)
        codes = np.where(codes >= 0, dense[codes], -1)
    return codes


def pack_shard(rows: pd.DataFrame, capacity: int) -> pd.DataFrame:
    """Pack rows (row, doc_id, size, source, cluster, shard) of one shard."""
    rows = rows.assign(full=rows["size"] // capacity, rest=rows["size"] % capacity)
    rows = rows.assign(s=_codes(rows["source"], True), c=_codes(rows["cluster"], True)).sort_values(["rest", "row"], ascending=[False, True], kind="stable")
    bins = Bins(capacity, int(rows["s"].max()) + 1, int(rows["c"].max()) + 1, len(rows))
    out = []
    for doc, full, rest, s, c in zip(rows["doc_id"], rows["full"], rows["rest"], rows["s"], rows["c"]):
        if rest:
            number, offset = bins.place(rest, s, c)
            out.append((doc, full, full * capacity, rest, number, offset))
        elif not full:
            out.append((doc, 0, 0, 0, None, None))
    number = bins.made
    for doc, full in zip(rows["doc_id"], rows["full"]):
        for piece in range(full):
            out.append((doc, piece, piece * capacity, capacity, number, 0))
            number += 1
    base = int(rows["shard"].iloc[0]) << 32
    got = pd.DataFrame(out, columns=["doc_id", "piece", "start", "n_tokens", "bin", "bin_offset"])
    got["doc_id"] = pd.array([None if d is None or d != d else int(d) for d in got["doc_id"]], dtype="Int64")
    for name in ("bin", "bin_offset"):
        got[name] = pd.array([None if v is None or v != v else int(v) for v in got[name]], dtype="Int64")
    return got.assign(bin=got["bin"] + base)


def measured(docs: DataFrame) -> DataFrame:
    """Add n_tokens (words between ASCII white space) and cluster (equal texts, but for case and white space)."""
    text = F.coalesce(F.col("text"), F.lit(""))
    plain = F.trim(F.regexp_replace(F.lower(text), r"[\x20\x09-\x0D]+", " "))
    return docs.withColumns({"n_tokens": F.regexp_count(text, F.lit(r"[^\x20\x09-\x0D]+")).cast("long"), "cluster": F.xxhash64(plain)})


def pack(docs: DataFrame, capacity: int = CAPACITY, shard_rows: int = SHARD_ROWS, size: str = "n_tokens", source: str = "source", cluster: str = "cluster") -> DataFrame:
    """One row per piece: doc_id, piece, start and n_tokens in the document, bin, bin_offset.

    A null source or cluster conflicts with nothing; a null or negative size
    counts as 0; a document of size 0 is returned with a null bin, for it takes
    no room.  Repeated rows are packed each, ties are broken by row number.
    Extra columns are ignored; an empty table gives an empty result.
    """
    if capacity < 1:
        raise ValueError("capacity must be positive")
    light = docs.select(
        F.col("doc_id").cast("long").cast("string").alias("doc_id"),  # a null must not make doubles of the others
        F.greatest(F.coalesce(F.col(size).cast("long"), F.lit(0)), F.lit(0)).alias("size"),
        F.col(source).cast("string").alias("source"),
        F.col(cluster).cast("string").alias("cluster"),
        F.monotonically_increasing_id().alias("row"),
    )
    shards = max(1, -(-docs.count() // shard_rows))
    dealt = light.withColumn("shard", F.pmod(F.xxhash64("row"), F.lit(shards)))

    def run(rows: pd.DataFrame) -> pd.DataFrame:
        return pack_shard(rows, capacity)

    return dealt.groupBy("shard").applyInPandas(run, _SCHEMA)
