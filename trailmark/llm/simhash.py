"""SimHash near-duplicate groups with covering locality-sensitive hashing.

Fingerprints within ``radius`` bits are linked; groups are the connected
components of the links.  For radius r every bit position i gets a non-zero
vector m(i) of r+1 bits, and each non-zero vector v of r+1 bits makes one table
whose mask keeps the positions with an odd number of common bits of m(i) and v
(Pagh, "CoveringLSH", 2018).  The vectors of at most r differing positions
never span all r+1 dimensions, so some v is orthogonal to all of them: its mask
drops every differing bit, and the pair collides there.  No pair is missed.

Equal fingerprints are one node from the start.  A bucket's nodes are not
paired off: a breadth-first search over packed words emits a spanning forest,
at most one link per node.  A bucket of more than ``bucket_rows`` nodes is cut
into chunks, and each pair of chunks is a bucket of its own, so every pair of
nodes still meets and no task holds more than two chunks.  Where that would make
more rows than there are masks, the bucket is first dealt anew by the masks of the
positions that its own mask leaves open, which again miss no pair.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from itertools import accumulate

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from trailmark.llm.common import arrow_batches, map_arrow, raw
from trailmark.operators.components import connected_components
from trailmark.plans.shared import stored

BITS, SEED = 64, 42
#: Nodes of one bucket that are searched together.
BUCKET_ROWS = 4096

_LANES = np.uint64(0x0101010101010101)
_SHIFTS = [np.uint64(b) for b in range(8)]


def shingle_hashes(text: bytes, width: int) -> np.ndarray:
    """XXH64 of the shingles of ``width`` words, repeats included; of the whole sequence, if it has fewer; nothing without words."""
    words = text.lower().split()  # bytes: only A-Z change, only ASCII white space parts
    if not words:
        return np.empty(0, np.uint64)
    line = b" ".join(words)
    h = xxhash.xxh64_intdigest
    if len(words) <= width:
        return np.array([h(line, SEED)], dtype=np.uint64)
    ends = [x - 1 for x in accumulate(len(w) + 1 for w in words)]
    starts = [0] + [x + 1 for x in ends]
    return np.array([h(line[a:b], SEED) for a, b in zip(starts, ends[width - 1 :])], dtype=np.uint64)


def fingerprint(text: bytes, width: int = 4) -> int:
    """SimHash of the shingles of ``width`` words, repeats included, as an unsigned number; 0 without words."""
    hashes = shingle_hashes(text, width)
    n = len(hashes)
    if n < 2:
        return int(hashes[0]) if n else 0
    rows = np.zeros(-(-n // 255) * 255, dtype=np.uint64)
    rows[:n] = hashes
    rows = rows.reshape(-1, 255)  # the sums of 255 rows fit into the eight bits of a lane
    out = 0
    for b, shift in enumerate(_SHIFTS):
        lanes = ((rows >> shift) & _LANES).sum(axis=1, dtype=np.uint64).view(np.uint8).reshape(-1, 8).sum(axis=0, dtype=np.int64)
        for byte in np.flatnonzero(lanes * 2 > n).tolist():
            out |= 1 << (8 * byte + b)
    return out


def covering_masks(radius: int, bits: int = BITS) -> list[int]:
    """2^(radius+1) - 1 masks of which, for any ``radius`` positions, one has none of them."""
    top = 1 << (radius + 1)
    vectors = [i % (top - 1) + 1 for i in range(bits)]
    return [sum(1 << i for i, m in enumerate(vectors) if (m & v).bit_count() % 2) for v in range(1, top)]


def _signed(x: int) -> int:
    return x - (1 << 64) if x >> 63 else x


def _forest(nodes: np.ndarray, radius: int) -> tuple[np.ndarray, np.ndarray]:
    """Links of a spanning forest of ``nodes`` under distance <= radius."""
    src, dst, rest = [], [], nodes
    while len(rest) > 1:
        todo, rest = [rest[0]], rest[1:]
        while todo and len(rest):
            at = todo.pop()
            near = np.bitwise_count(rest ^ at) <= radius
            if near.any():
                new = rest[near]
                src.append(np.full(len(new), at)), dst.append(new)
                todo.extend(new)
                rest = rest[~near]
    if not src:
        return nodes[:0], nodes[:0]
    return np.concatenate(src), np.concatenate(dst)




def _search(radius: int):
    """Over rows (bucket, fp) sorted by bucket: links of each run of equal buckets."""
    kind = pa.schema([("src", pa.int64()), ("dst", pa.int64())])

    def links(keys: np.ndarray, fps: np.ndarray) -> pa.RecordBatch | None:
        cuts = np.flatnonzero(np.concatenate(([True], keys[1:] != keys[:-1], [True])))
        sizes = np.diff(cuts)
        pairs = cuts[:-1][sizes == 2]
        a, b = fps[pairs], fps[pairs + 1]
        ok = np.bitwise_count(a ^ b) <= radius
        src, dst = [a[ok]], [b[ok]]
        for at in np.flatnonzero(sizes > 2).tolist():
            x, y = _forest(np.unique(fps[cuts[at] : cuts[at + 1]]), radius)
            src.append(x), dst.append(y)
        s, d = np.concatenate(src), np.concatenate(dst)
        both = np.unique(np.stack([np.minimum(s, d), np.maximum(s, d)]), axis=1)  # the tables find the same links
        return pa.RecordBatch.from_arrays([pa.array(both[0].view(np.int64)), pa.array(both[1].view(np.int64))], schema=kind) if both.size else None

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        keys, fps = np.empty(0, np.int64), np.empty(0, np.uint64)
        for batch in batches:
            keys = np.concatenate([keys, batch.column(0).to_numpy()])
            fps = np.concatenate([fps, batch.column(1).to_numpy().view(np.uint64)])
            last = int(np.searchsorted(keys, keys[-1])) if len(keys) else 0  # the last run may go on
            if last:
                out = links(keys[:last], fps[:last])
                keys, fps = keys[last:], fps[last:]
                if out is not None:
                    yield out
        if len(keys):
            out = links(keys, fps)
            if out is not None:
                yield out

    return run


def near_links(fps: DataFrame, radius: int = 4, bucket_rows: int = BUCKET_ROWS) -> DataFrame:
    """Links (src, dst) that connect all of the distinct long ``fp`` that lie within ``radius``."""
    masks = covering_masks(radius)
    named = lambda t, mask: F.xxhash64(F.lit(t), F.col("fp").bitwiseAND(F.lit(_signed(mask))))
    keys: list[Column] = [F.struct(F.lit(t).alias("t"), named(t, m).alias("bucket")) for t, m in enumerate(masks)]
    buckets = fps.select("fp", F.explode(F.array(*keys)).alias("x")).select("fp", "x.t", "x.bucket")
    crowd = lambda df: df.groupBy("bucket").agg(F.count("*").alias("n")).where(F.col("n") > bucket_rows).select("bucket", F.ceil(F.col("n") / bucket_rows).cast("int").alias("chunks"))
    # rows of a bucket that is cut into chunks are copied once a chunk, else once a mask
    level = buckets.join(crowd(buckets), "bucket", "left")
    deep = [F.array(*(F.lit(_signed(m | w)) for w in masks)) for m in masks]
    inner = F.transform(F.element_at(F.array(*deep), F.col("t") + 1), lambda w: F.xxhash64("bucket", w, F.col("fp").bitwiseAND(w)))
    dense = F.coalesce(F.col("chunks"), F.lit(0)) > len(masks)
    anew = level.where(dense).select("fp", F.explode(inner).alias("bucket"))
    mine = F.pmod(F.xxhash64("fp", F.lit(SEED)), F.col("chunks")).cast("int")
    others = F.sequence(F.lit(0), F.col("chunks") - 1)
    spread = F.when(F.col("chunks").isNull(), F.array("bucket")).otherwise(
        F.transform(others, lambda j: F.xxhash64("bucket", F.least(F.col("mine"), j), F.greatest(F.col("mine"), j)))
    )
    dealt = level.where(~dense).select("fp", "bucket", "chunks").unionAll(anew.join(crowd(anew), "bucket", "left").select("fp", "bucket", "chunks"))
    cells = dealt.withColumn("mine", mine).select("fp", F.explode(spread).alias("bucket"))
    n = int(fps.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    return arrow_batches(cells.select("bucket", "fp").repartition(n, "bucket").sortWithinPartitions("bucket"), _search(radius), "src long, dst long")


def fingerprints(docs: DataFrame, width: int = 4, keep: list[str] | None = None) -> DataFrame:
    """``keep`` columns of ``docs`` (default: doc_id) and the fingerprint of ``text`` as a long ``fp``."""
    keep = keep or ["doc_id"]
    rows = docs.select(*keep, F.col("text").alias("_text"))

    def run(batch: pa.RecordBatch) -> pa.RecordBatch:
        fps = np.array([fingerprint(x, width) for x in raw(batch.column(batch.num_columns - 1))], dtype=np.uint64).view(np.int64)
        return pa.RecordBatch.from_arrays([*batch.columns[:-1], pa.array(fps)], names=[*keep, "fp"])

    schema = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in rows.schema.fields[:-1]) + ", fp long"
    return map_arrow(rows, run, schema)


def near_duplicates(docs: DataFrame, width: int = 4, radius: int = 4, bucket_rows: int = BUCKET_ROWS) -> DataFrame:
    """One row per document: doc_id, fp, fingerprint (16 hex digits), component_id.

    Null and empty texts, and texts of white space only, have fingerprint zero
    and are linked like any other; texts of fewer than ``width`` words are one
    shingle.  Repeated rows are each reported; a null doc_id belongs to a
    component but never names one unless all of its ids are null.  Extra
    columns are ignored, an empty table gives an empty result.
    """
    rows = stored(fingerprints(docs.withColumn("doc_id", F.col("doc_id").cast("long")), width), "fingerprints")
    nodes = rows.groupBy("fp").agg(F.min("doc_id").alias("first_id"))
    groups = connected_components(near_links(nodes.select("fp"), radius, bucket_rows))
    known = nodes.join(groups, nodes["fp"] == groups["node"], "left").select("fp", "first_id", F.coalesce("component", "fp").alias("root"))
    # the members of a component are pre-aggregated; its least id comes back by an equi-join
    least = known.groupBy("root").agg(F.min("first_id").alias("component_id"))
    named = known.where("root <> fp").join(least, "root").select("fp", F.col("component_id").alias("of_root"))
    roots = least.select(F.col("root").alias("fp"), F.col("component_id").alias("of_root"))
    label = named.unionAll(roots)
    return rows.join(label, "fp").select("doc_id", "fp", F.lpad(F.lower(F.hex("fp")), 16, "0").alias("fingerprint"), F.col("of_root").alias("component_id"))


# --- one document of each group of near copies ------------------------------------------------------------------------
#
# Two texts are copies if their sets of five-word shingles are ``similarity`` alike (Jaccard), however they came to differ:
# words replaced, text added or cut off.  Candidates share one of BANDS keys, each made of ROWS minimum hashes of the set:
# a pair of similarity s misses all of them with probability (1 - s^ROWS)^BANDS, 6e-7 at 0.8.  Every candidate pair that
# its bucket's links do not yet connect is then compared by the sets themselves.  With a ``radius``, texts whose
# fingerprints lie within it are copies too, as of ``near_duplicates``: repeats count there, and no such pair is missed.

BANDS, ROWS = 14, 2
#: Nodes, and bytes of text, of one bucket that are compared together.
COPY_ROWS, COPY_BYTES = 1024, 8 << 20
_MIX = np.random.default_rng(SEED).integers(1 << 62, 1 << 63, (2, BANDS * ROWS), dtype=np.uint64) | np.uint64(1)


def set_keys(text: bytes, width: int = 5) -> tuple[int, int, list[int]]:
    """(two halves of a digest of the set of shingles, BANDS keys) of a text; equal sets have equal ones."""
    h = np.unique(shingle_hashes(text, width))
    digest = xxhash.xxh3_128_intdigest(h.tobytes(), SEED)
    halves = digest >> 64, digest & (1 << 64) - 1
    if not len(h):
        return *halves, [xxhash.xxh64_intdigest(b"", j) for j in range(BANDS)]
    least = np.array([((h ^ x) * m).min() for x, m in zip(*_MIX)], dtype=np.uint64).reshape(BANDS, ROWS)
    return *halves, [xxhash.xxh64_intdigest(band.tobytes(), j) for j, band in enumerate(least)]


def _copies(nodes: np.ndarray, sets: list[np.ndarray], similarity: float) -> tuple[list, list]:
    """Links of a spanning forest of ``nodes`` whose sets are ``similarity`` alike or more."""
    src, dst = [], []
    sizes = np.array([len(s) for s in sets])
    if len(nodes) == 2:
        both = len(np.intersect1d(sets[0], sets[1], assume_unique=True))
        return ([nodes[0]], [nodes[1]]) if both >= similarity * (sizes.sum() - both) else ([], [])
    owner = np.repeat(np.arange(len(nodes)), sizes)
    names, of = np.unique(np.concatenate(sets), return_inverse=True)
    order = np.argsort(of, kind="stable")
    holders, ends = owner[order], np.cumsum(np.bincount(of, minlength=len(names)))
    begins, starts = np.concatenate([[0], ends[:-1]]), np.concatenate([[0], np.cumsum(sizes)])
    rest = np.ones(len(nodes), bool)
    for first in range(len(nodes)):
        todo = [first] if rest[first] else []
        rest[first] = False
        while todo and rest.any():
            at = todo.pop()
            own = of[starts[at] : starts[at + 1]]
            met = np.bincount(np.concatenate([holders[begins[i] : ends[i]] for i in own.tolist()]), minlength=len(nodes))
            new = np.flatnonzero(rest & (met >= similarity * (sizes[at] + sizes - met)))
            rest[new] = False
            src += [nodes[at]] * len(new)
            dst += nodes[new].tolist()
            todo += new.tolist()
    return src, dst


def _copy_links(width: int, similarity: float):
    """Over rows (cell, node, text) sorted by cell: links of a spanning forest of each cell."""
    kind = pa.schema([("src", pa.int64()), ("dst", pa.int64())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        cell, nodes, sets = None, [], []

        def links() -> Iterator[pa.RecordBatch]:
            if len(nodes) > 1:
                src, dst = _copies(np.array(nodes), sets, similarity)
                if src:
                    yield pa.RecordBatch.from_arrays([pa.array(src, pa.int64()), pa.array(dst, pa.int64())], schema=kind)

        for batch in batches:
            for key, node, text in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), raw(batch.column(2))):
                if key != cell:
                    yield from links()
                    cell, nodes, sets = key, [], []
                nodes.append(node), sets.append(np.unique(shingle_hashes(text, width)))
        yield from links()

    return run


def _alike(width: int, similarity: float):
    """Over rows (node, hub, text, hub_text): those whose sets are ``similarity`` alike, as links."""

    def run(batch: pa.RecordBatch) -> pa.RecordBatch:
        known: dict[bytes, np.ndarray] = {}
        src, dst = [], []
        for node, hub, text, other in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), raw(batch.column(2)), raw(batch.column(3))):
            a, b = (known[other] if other in known else known.setdefault(other, np.unique(shingle_hashes(other, width)))), np.unique(shingle_hashes(text, width))
            both = len(np.intersect1d(a, b, assume_unique=True))
            if both >= similarity * (len(a) + len(b) - both):
                src.append(hub), dst.append(node)
        return pa.RecordBatch.from_arrays([pa.array(src, pa.int64()), pa.array(dst, pa.int64())], names=["src", "dst"])

    return run


def _just_read(docs: DataFrame) -> bool:
    """Do rows of ``docs`` come in the same order whenever they are read: nothing but files, filters and projections?"""
    plan = docs._jdf.queryExecution().optimizedPlan().toString()
    return all(re.match(r"[\s:+-]*(Project|Filter|Relation)\b", line) for line in plan.strip().splitlines())


def _numbered(docs: DataFrame, own: str) -> DataFrame:
    rows = docs.withColumn(own, F.monotonically_increasing_id())
    return rows if _just_read(docs) else stored(rows, "numbered")


def copy_links(rows: DataFrame, nodes: DataFrame, width: int, similarity: float, bucket_rows: int) -> DataFrame:
    """Links (src, dst) that connect all alike of ``nodes`` (node, bytes, keys) that share a key; ``rows`` has (node, _text).

    A bucket of one chunk is searched by one task.  Of larger ones each has a hub, its
    least node, and every node is first compared with the least of its hubs.  Those
    alike are connected, so only the others must meet all: they are cut into chunks
    that meet one another, and each chunk of the nodes connected with the bucket's hub.
    """
    keyed = nodes.select("node", "bytes", F.explode("keys").alias("key"))
    # most keys have one node, which nothing can be linked to by it; of keys that have the same nodes one is enough
    met = keyed.groupBy("key").agg(
        F.count("*").alias("n"), F.sum("bytes").alias("bytes"), F.min("node").alias("hub"), F.bit_xor(F.xxhash64("node")).alias("x0"), F.bit_xor(F.xxhash64(F.lit(SEED), "node")).alias("x1")
    ).where("n > 1")
    n_chunks = lambda n, size: F.greatest(F.ceil(F.col(n) / bucket_rows), F.least(n, F.ceil(F.col(size) / COPY_BYTES))).cast("int")
    met = met.groupBy("n", "x0", "x1").agg(F.min("key").alias("key"), F.max("bytes").alias("bytes"), F.min("hub").alias("hub")).select("key", "hub", n_chunks("n", "bytes").alias("chunks"))
    met = stored(keyed.join(met, "key"), "buckets")  # a row for each node and bucket that may link it
    wanted = met.groupBy("node").agg((F.max("chunks") > 1).alias("crowd"))
    rows = stored(rows.join(wanted.hint("merge"), "node"), "texts")  # the only shuffle of all texts; ids never go through the driver
    cells = met.where("chunks = 1").select("node", F.col("key").alias("cell"))
    linked = None
    if not met.where("chunks > 1").isEmpty():
        large = met.where("chunks > 1").select("node", "bytes", "key", "hub")
        pairs = large.groupBy("node").agg(F.min("hub").alias("hub")).where("node <> hub")  # one for each node, however many buckets it is in
        hubs = rows.where("crowd").select(F.col("node").alias("hub"), F.col("_text").alias("hub_text"))
        linked = stored(map_arrow(pairs.join(hubs, "hub").join(rows.where("crowd"), "node").select("node", "hub", "_text", "hub_text"), _alike(width, similarity), "src long, dst long"), "hubs")
        # a node is known to be connected with its bucket's hub if both were linked to one and the same, or are it
        label = linked.select(F.col("dst").alias("node"), F.col("src").alias("at"))
        both = large.where("node <> hub").join(label, "node", "left").join(label.select(F.col("node").alias("hub"), F.col("at").alias("hub_at")), "hub", "left")
        told = both.select("key", "node", "bytes", (F.coalesce("at", "node") == F.coalesce("hub_at", "hub")).alias("near"))
        of = lambda x: F.when(F.col("near") == x, F.col("bytes"))
        sizes = told.groupBy("key").agg(F.count(of(False)).alias("u"), F.sum(of(False)).alias("ub"), F.count(of(True)).alias("l"), F.sum(of(True)).alias("lb")).where("u > 0")
        sizes = sizes.select("key", n_chunks("u", "ub").alias("us"), F.coalesce(n_chunks("l", "lb"), F.lit(0)).alias("ls"))
        mine = F.pmod(F.xxhash64("node"), F.when(F.col("near"), F.col("ls")).otherwise(F.col("us"))).cast("int")
        to = lambda n: F.when(F.col(n) > 0, F.sequence(F.lit(0), F.col(n) - 1)).otherwise(F.array().cast("array<int>"))
        own = F.transform(to("us"), lambda j: F.xxhash64("key", F.lit("u"), F.least(F.col("mine"), j), F.greatest(F.col("mine"), j)))
        out = F.transform(to("ls"), lambda j: F.xxhash64("key", F.lit("l"), F.col("mine"), j))
        back = F.transform(to("us"), lambda i: F.xxhash64("key", F.lit("l"), i, F.col("mine")))
        spread = F.when(F.col("near"), back).otherwise(F.concat(own, out))
        cells = cells.unionAll(told.join(sizes, "key").withColumn("mine", mine).select("node", F.explode(spread).alias("cell")))
    n = int(rows.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    buckets = cells.join(rows, "node").select("cell", "node", "_text").repartition(n, "cell").sortWithinPartitions("cell")
    found = arrow_batches(buckets, _copy_links(width, similarity), "src long, dst long")
    return found if linked is None else found.unionAll(linked)


def print_links(prints: DataFrame, radius: int) -> DataFrame:
    """Links (src, dst) that connect all nodes of ``prints`` (node, fp) with fingerprints within ``radius``; a node may have several."""
    prints = stored(prints.distinct(), "prints")
    first = stored(prints.groupBy("fp").agg(F.min("node").alias("first")), "first")  # the node that stands for a fingerprint
    same = prints.join(first, "fp").where("node <> first").select(F.col("first").alias("src"), F.col("node").alias("dst"))
    end = lambda x: first.select(F.col("fp").alias(x), F.col("first").alias(f"{x}_node"))
    near = near_links(first.select("fp"), radius).distinct().join(end("src"), "src").join(end("dst"), "dst")
    return same.unionAll(near.select(F.col("src_node").alias("src"), F.col("dst_node").alias("dst")))


def copy_groups(docs: DataFrame, own: str, width: int = 5, similarity: float = 0.8, bucket_rows: int = COPY_ROWS, radius: int | None = None) -> tuple[DataFrame, DataFrame]:
    """Of ``docs`` with row numbers ``own``: (``own``, node), equal sets being one node; and (node, component) of the nodes with links."""
    rows = docs.select(own, F.col("text").alias("_text"))

    def run(batch: pa.RecordBatch) -> pa.RecordBatch:
        texts = raw(batch.column(1))
        made = [set_keys(x, width) for x in texts]
        u = lambda x: pa.array(np.array(x, dtype=np.uint64).view(np.int64))
        keys = pa.ListArray.from_arrays(pa.array(range(0, BANDS * len(made) + 1, BANDS), pa.int32()), u([k for m in made for k in m[2]]))
        fps = pa.nulls(len(made), pa.int64()) if radius is None else u([fingerprint(x) for x in texts])
        return pa.RecordBatch.from_arrays([batch.column(0), pa.array([len(x) for x in texts], pa.int64()), u([m[0] for m in made]), u([m[1] for m in made]), keys, fps], names=["row", "bytes", "d0", "d1", "keys", "fp"])

    told = stored(map_arrow(rows, run, "row long, bytes long, d0 long, d1 long, keys array<long>, fp long"), "told")
    nodes = stored(told.groupBy("d0", "d1").agg(F.min("row").alias("node"), F.max("bytes").alias("bytes"), F.min("keys").alias("keys")), "nodes")
    members = told.join(nodes.select("d0", "d1", "node"), ["d0", "d1"])
    links = copy_links(rows.withColumnRenamed(own, "node"), nodes, width, similarity, bucket_rows)
    if radius is not None:
        links = links.unionAll(print_links(members.select("node", "fp"), radius))
    return members.select(F.col("row").alias(own), "node"), connected_components(links)


def one_of_each(docs: DataFrame, width: int = 5, similarity: float = 0.8, bucket_rows: int = COPY_ROWS, radius: int | None = None) -> DataFrame:
    """``docs`` without all but one document of each group of near copies.

    Copies are texts whose sets of shingles are ``similarity`` alike and, unless
    ``radius`` is None, those that :func:`near_duplicates` links at that radius.
    The first row of a group stays.  Texts without words are copies of one
    another, as are equal texts; a null text counts as empty, a very long one is
    read whole.  Columns are handed on as they are, whatever else they are
    called; an empty table stays empty.
    """
    own = "_row"
    while own in docs.columns:
        own += "_"
    numbered = _numbered(docs, own)
    members, groups = copy_groups(numbered, own, width, similarity, bucket_rows, radius)
    later = groups.where("node <> component").select("node")
    first = members.where(F.col(own) == F.col("node")).join(later, "node", "left_anti").select(own)
    return numbered.join(first.hint("merge"), own, "left_semi").select(*docs.columns)  # ids of all documents never go through the driver
