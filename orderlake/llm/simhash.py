"""SimHash near-duplicates: 64-bit fingerprints linked through BK-trees.

Fingerprint: words (A-Z lower-cased, split at blanks), shingles of ``shingle``
words, XXH64 (seed 42) of each, and a majority vote of every bit.

Links: fingerprints are collapsed to distinct ones first, so a group of equal
texts is one node. Each fingerprint goes to one shard per block of a bit split:
with ``distance`` + 1 blocks, two fingerprints that differ in at most ``distance``
bits agree on a whole block and so share a shard. A shard with more than
``SHARD_NODES`` fingerprints is split again in the same way on the bits that vary in it,
until every shard is that small; this loses no link and caps no group. Each shard's
BK-tree (children keyed by their integer Hamming distance to the parent) is built
in the task that holds the shard, and a lookup follows only edges within the
radius. The trees grow with the input, so they are not broadcast: shards and
their queries meet by shuffle instead, and a tree has a fixed largest size.

A shard passes on one edge per fingerprint, to the root of its linked set in that
shard, never all pairs. Connected components over those edges give the classes.

Defined results: null and wordless texts have fingerprint zero and are linked like
any other; a text of fewer words is one shingle; rows that repeat have equal
fingerprints; a null id never becomes a component id unless the class has no other.
Extra columns pass through; a column named like a result column is replaced by it.
"""

from __future__ import annotations

from functools import reduce

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from orderlake.llm.frames import fresh, keep_lineage, cleared, row_key
from orderlake.operators.components import connected_components

SHINGLE = 3
DISTANCE = 3
SEED = 42
#: Fingerprints in one BK-tree at most.
SHARD_NODES = 512
#: Shingles hashed at a time, which bounds memory for long texts.
_VOTE_ROWS = 1 << 15


def text_fingerprint(text: str | None, shingle: int = SHINGLE) -> int:
    """SimHash of one text as an unsigned integer."""
    words = text.encode("utf-8", "replace").lower().split() if text else []  # bytes.lower is A-Z only, bytes.split is at blanks only
    if not words:
        return 0
    joined = b" ".join(words)
    at = np.zeros(len(words) + 1, np.int64)
    np.cumsum(np.fromiter(map(len, words), np.int64, len(words)) + 1, out=at[1:])
    size = min(shingle, len(words))
    count = len(words) - size + 1
    starts, ends = at[:count].tolist(), (at[size:size + count] - 1).tolist()
    votes = np.zeros(64, np.int64)
    for lo in range(0, count, _VOTE_ROWS):
        hashes = np.fromiter((xxhash.xxh64_intdigest(joined[a:b], SEED) for a, b in
                              zip(starts[lo:lo + _VOTE_ROWS], ends[lo:lo + _VOTE_ROWS])),
                             "<u8", min(_VOTE_ROWS, count - lo))
        votes += np.unpackbits(hashes.view(np.uint8).reshape(-1, 8), axis=1, bitorder="little").sum(axis=0, dtype=np.int64)
    return int.from_bytes(np.packbits(votes * 2 > count, bitorder="little").tobytes(), "little")


def fingerprints(docs: DataFrame, *, text: str = "text", shingle: int = SHINGLE, name: str = "fingerprint",
                 keep: list[str] | None = None) -> DataFrame:
    """The columns ``keep`` of ``docs`` (all, if not given) plus the fingerprint as a signed 64-bit integer."""
    docs = cleared(docs, name)
    keep = docs.columns if keep is None else keep
    at, kept = docs.columns.index(text), [docs.columns.index(c) for c in keep]

    def run(batches):
        for batch in batches:
            prints = np.array([text_fingerprint(x.as_py(), shingle) for x in batch.column(at)], np.uint64)
            yield pa.RecordBatch.from_arrays([*(batch.column(k) for k in kept), pa.array(prints.view(np.int64))],
                                             names=[*keep, name])

    return docs.mapInArrow(run, T.StructType([*(docs.schema[k] for k in kept), T.StructField(name, T.LongType())]))


class BKTree:
    """Distinct 64-bit integers; a node's children are keyed by their distance to it."""

    def __init__(self):
        self.root = None

    def within(self, x: int, radius: int) -> list[int]:
        found, todo = [], [self.root] if self.root else []
        while todo:
            value, children = todo.pop()
            d = (value ^ x).bit_count()
            if d <= radius:
                found.append(value)
            if children:
                todo += [children[e] for e in range(d - radius, d + radius + 1) if e in children]
        return found

    def add(self, x: int) -> None:
        if self.root is None:
            self.root = (x, {})
            return
        value, children = self.root
        while d := (value ^ x).bit_count():
            if d not in children:
                children[d] = (x, {})
                return
            value, children = children[d]


def _linked_sets(values: list[int], radius: int):
    """(value, root) for each value that is not the root of its linked set in this shard."""
    tree, parent = BKTree(), {}

    def top(x):
        while parent[x] != x:
            parent[x] = parent[parent[x]]
            x = parent[x]
        return x

    for x in values:
        parent[x] = x
        for y in tree.within(x, radius):
            a, b = top(x), top(y)
            if a != b:
                parent[max(a, b)] = min(a, b)
        tree.add(x)
    return ((x, top(x)) for x in values if top(x) != x)


def _bit_blocks(bits: int, blocks: int) -> list[int]:
    """``bits`` in ``blocks`` nearly equal parts, without empty ones."""
    each = [1 << b for b in range(64) if bits >> b & 1]
    cuts = [round(k * len(each) / blocks) for k in range(blocks + 1)]
    return [sum(each[a:b]) for a, b in zip(cuts, cuts[1:]) if b > a]


def _signed(x: int) -> int:
    return x - (1 << 64) if x >> 63 else x


def _finer(blocks: int):
    """Batches of (mask, key, varying) -> (mask, key, child): masks that also fix one part of the bits that vary in the shard."""
    def run(batches):
        for batch in batches:
            rows = [(m, k, _signed(m % (1 << 64) | part)) for m, k, v in zip(*(c.to_pylist() for c in batch.columns))
                    for part in _bit_blocks(v % (1 << 64), blocks)]
            yield pa.RecordBatch.from_arrays([pa.array([r[i] for r in rows], pa.int64()) for i in range(3)], names=["mask", "key", "child"])
    return run


def _shards(prints: DataFrame, distance: int, shard_nodes: int) -> DataFrame:
    """(mask, key, fp) with every pair within ``distance`` together in some shard of at most ``shard_nodes`` rows.

    A pair of a shard differs only in bits that vary in it, so it agrees on one of ``distance`` + 1 parts of these. A
    split fixes a part, so a large shard falls apart after a few rounds.
    """
    rows = prints.select("fp", F.explode(F.array(*[F.lit(_signed(m)) for m in _bit_blocks((1 << 64) - 1, distance + 1)])).alias("mask")) \
                 .withColumn("key", F.col("fp").bitwiseAND(F.col("mask")))
    parts = []
    while True:
        sizes = keep_lineage(rows.groupBy("mask", "key").agg(
            F.count(F.lit(1)).alias("n"), F.bit_or("fp").bitwiseXOR(F.bit_and("fp")).alias("varying")).where("n > 1"))
        parts.append(rows.join(sizes.where(F.col("n") <= shard_nodes).select("mask", "key"), ["mask", "key"], "left_semi"))
        large = sizes.where(F.col("n") > shard_nodes).select("mask", "key", "varying")
        if large.isEmpty():
            return reduce(DataFrame.unionByName, parts)
        finer = large.mapInArrow(_finer(distance + 1), "mask long, key long, child long")
        rows = keep_lineage(rows.join(finer, ["mask", "key"]).select("fp", F.col("child").alias("mask"))
                            .withColumn("key", F.col("fp").bitwiseAND(F.col("mask"))).distinct())


def links(prints: DataFrame, distance: int = DISTANCE, shard_nodes: int = SHARD_NODES) -> DataFrame:
    """Edges (src, dst) over the distinct ``fp`` of ``prints`` whose components are those of
    "differ in at most ``distance`` bits"."""
    shards = _shards(prints, distance, shard_nodes)
    # by a hash of its own: a deal by the columns that the join above met on would be taken for done, and is undone where that join is turned into
    # a broadcast one, so that a shard lay in several tasks
    ordered = shards.repartition(F.xxhash64("mask", "key")).sortWithinPartitions("mask", "key", "fp")

    def run(batches):
        shard, values = None, []
        for batch in batches:
            src, dst = [], []
            for m, k, fp in zip(*(batch.column(c).to_pylist() for c in ("mask", "key", "fp"))):
                if (m, k) != shard:
                    for a, b in _linked_sets(values, distance):
                        src.append(a)
                        dst.append(b)
                    shard, values = (m, k), []
                values.append(fp & 0xFFFFFFFFFFFFFFFF)
            yield _edges(src, dst)
        last = list(_linked_sets(values, distance))
        yield _edges([a for a, _ in last], [b for _, b in last])

    return ordered.mapInArrow(run, "src long, dst long").distinct()


def _edges(src: list[int], dst: list[int]) -> pa.RecordBatch:
    signed = [pa.array(np.array(x, np.uint64).view(np.int64)) for x in (src, dst)]
    return pa.RecordBatch.from_arrays(signed, names=["src", "dst"])


def classes(prints: DataFrame, doc_id: str, fingerprint: str, distance: int = DISTANCE,
            shard_nodes: int = SHARD_NODES) -> DataFrame:
    """(fp, class_fp, component_id): for each distinct fingerprint the smallest fingerprint and ``doc_id`` of its class.

    ``prints`` is read several times, so it should be checkpointed.
    """
    nodes = keep_lineage(prints.groupBy(F.col(fingerprint).alias("fp")).agg(F.min(doc_id).alias("first_id")))
    edges = keep_lineage(links(nodes.select("fp"), distance, shard_nodes))
    ends = edges.select(F.col("src").alias("v")).union(edges.select(F.col("dst").alias("v"))).distinct()
    label = connected_components(ends, edges)
    classed = nodes.join(label, nodes["fp"] == label["v"], "left").select(
        "fp", "first_id", F.coalesce("label", "fp").alias("class_fp"))
    first = classed.groupBy("class_fp").agg(F.min("first_id").alias("component_id"))
    return classed.drop("first_id").join(first, "class_fp")


def near_duplicates(docs: DataFrame, *, doc_id: str = "doc_id", text: str = "text", shingle: int = SHINGLE,
                    distance: int = DISTANCE, shard_nodes: int = SHARD_NODES) -> DataFrame:
    """``docs`` without its text, plus fingerprint (signed long) and component_id (smallest ``doc_id`` of the class)."""
    docs = cleared(docs, "fingerprint", "component_id")
    rest = [c for c in docs.columns if c != text]
    prints = keep_lineage(fingerprints(docs, text=text, shingle=shingle, keep=rest))
    (fp,) = fresh(prints, "fp")
    found = classes(prints, doc_id, "fingerprint", distance, shard_nodes).select(F.col("fp").alias(fp), "component_id")
    return prints.join(found, prints["fingerprint"] == found[fp], "left").drop(fp)


def keep_one(docs: DataFrame, *, doc_id: str = "doc_id", text: str = "text", shingle: int = SHINGLE,
             distance: int = DISTANCE, shard_nodes: int = SHARD_NODES) -> DataFrame:
    """``docs`` with one row of each class: that of the smallest ``doc_id`` (null last).

    Between rows of equal id the text's hash decides, and rows equal in id and text are one.
    """
    k1, k2 = fresh(docs, "_k1", "_k2")
    keyed = docs.withColumns(dict(zip((k1, k2), row_key(F.col(doc_id), F.col(text)))))
    narrow = keyed.select(F.col(doc_id).alias("id"), F.col(text).alias("text"), F.col(k1).alias("k1"), F.col(k2).alias("k2"))
    prints = keep_lineage(fingerprints(narrow, shingle=shingle, keep=["id", "k1", "k2"]))
    order = F.struct(F.col("id").isNull().alias("no_id"), "id", "k1", "k2")
    # the first row of each fingerprint, then of each class: a large group is reduced before it meets
    each = prints.groupBy(F.col("fingerprint").alias("fp")).agg(F.min(order).alias("row"))
    found = classes(prints, "id", "fingerprint", distance, shard_nodes).select("fp", "class_fp")
    kept = each.join(found, "fp").groupBy("class_fp").agg(F.min("row").alias("row")).select(
        F.col("row.k1").alias(k1), F.col("row.k2").alias(k2))
    return keyed.join(kept, [k1, k2], "left_semi").dropDuplicates([k1, k2]).drop(k1, k2)
