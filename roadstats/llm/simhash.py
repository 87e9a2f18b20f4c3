"""SimHash near-duplicates: vantage-point trees over 64-bit fingerprints.

Fingerprint: words are runs of other than ASCII white space, A-Z lower-cased; every shingle of
``shingle`` words (joined by spaces, repeats included; a shorter text is one shingle) is hashed
with XXH64 (seed 42), and a bit is set if more than half of the hashes have it.

Equal fingerprints are first reduced to one row. The tree has ``levels`` levels; level j splits
its points into rings by their Hamming distance to a vantage point, taken over the j-th block
of bits. Distances over disjoint blocks add up to the Hamming distance, so the triangle bounds
add up along a path: two fingerprints within ``max_bits`` = 2 have ring numbers that differ by
2 in all at most, and some leaf is within 1 of both. Each fingerprint therefore goes to its own
leaf and, as a boundary overlap, to the leaves one ring away at one level (1 + 2 * levels
shards); all other branches are pruned. Every pair within 2 bits meets in a shard, where exact
distances decide. A shard links its members by a spanning forest, not by all pairs. Shards
with more than ``SHARD_ROWS`` members are split down to the last tree, whose blocks are single
bits (64 levels): a leaf then holds only fingerprints within 1 bit of one value, which link
without a comparison. Vantage points are fixed random values; any choice gives exact pairs.

Links are joined to components by alternating large-star and small-star steps, each written to
the shared folder; nothing is collected but counts.

Defined results: null, empty and blank texts have fingerprint 0 and link like any other. Rows
with a null doc_id get a component like others; its id is the smallest non-null doc_id in it,
or null if there is none. Repeated rows each get their row. An empty table gives no rows. Extra
columns are ignored by ``near_duplicates`` and kept by ``one_of_each``.
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import accumulate

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from roadstats.llm.folds import free_name
from roadstats.session import new_work_dir

SHINGLE = 3
MAX_BITS = 2
SHARD_ROWS = 20_000
#: Tree levels by number of fingerprints: more levels give smaller leaves and more overlaps.
LEVELS = ((1_000_000, 4), (1_000_000_000, 8), (float("inf"), 16))
#: Fixed random vantage point; level j uses its j-th block of bits.
VANTAGE = 0x3C6EF372FE94F82B
_CHUNK = 1 << 15


def fingerprint(text: str | None, shingle: int = SHINGLE) -> int:
    """Unsigned fingerprint of one text."""
    words = (text or "").encode("utf-8", "surrogatepass").lower().split()
    if not words:
        return 0
    joined = b" ".join(words)
    ends = list(accumulate(map(len, words), lambda at, n: at + 1 + n))
    starts = [0, *(e + 1 for e in ends[:-1])]
    width = min(shingle, len(words))
    digest, ends = xxhash.xxh64_digest, ends[width - 1 :]
    total = np.zeros(64, dtype=np.int64)
    for lo in range(0, len(ends), _CHUNK):
        spans = zip(starts[lo : lo + _CHUNK], ends[lo : lo + _CHUNK])
        hashes = b"".join([digest(joined[a:b], 42) for a, b in spans])
        bits = np.unpackbits(np.frombuffer(hashes, dtype=np.uint8)).reshape(-1, 64)
        total += bits.sum(axis=0, dtype=np.int32)
    return int.from_bytes(np.packbits(2 * total > len(ends)).tobytes(), "big")


def fingerprints(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", shingle: int = SHINGLE) -> DataFrame:
    """(doc_id, text_key, fp) of each row; fp is the fingerprint as a signed bigint."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            values = np.array([fingerprint(t.as_py(), shingle) for t in batch.column(2)], dtype=np.uint64)
            columns = [batch.column(0), batch.column(1), pa.array(values.view(np.int64))]
            yield pa.RecordBatch.from_arrays(columns, ["doc_id", "text_key", "fp"])

    rows = docs.select(F.col(id_col).cast("bigint").alias("doc_id"), text_key(text_col).alias("text_key"), F.col(text_col).alias("text"))
    return rows.mapInArrow(run, "doc_id bigint, text_key bigint, fp bigint")


def text_key(text_col: str) -> Column:
    return F.xxhash64(F.coalesce(F.col(text_col), F.lit("")))


def _leaf(fp: Column, levels: int) -> list[Column]:
    """Ring numbers of a fingerprint, one a level."""
    width = 64 // levels
    moved = fp.bitwiseXOR(F.lit(VANTAGE).cast("bigint"))
    block = lambda j: F.shiftrightunsigned(moved, j * width).bitwiseAND(F.lit((1 << width) - 1).cast("bigint"))
    return [F.bit_count(block(j)).cast("bigint") for j in range(levels)]


def _shards(fps: DataFrame, levels: int) -> DataFrame:
    """(shard, fp): each fingerprint in its leaf and the leaves one ring away at one level."""
    width = 64 // levels
    digit = (width + 1).bit_length()
    rings = _leaf(F.col("fp"), levels)
    own = sum((F.shiftleft(r, digit * j) for j, r in enumerate(rings)), F.lit(0).cast("bigint"))
    near = [F.when(r > 0, own - (1 << digit * j)) for j, r in enumerate(rings)]
    near += [F.when(r < width, own + (1 << digit * j)) for j, r in enumerate(rings)]
    return fps.select(F.explode(F.array_compact(F.array(own, *near))).alias("shard"), "fp")


def _forest(fps: np.ndarray, max_bits: int) -> Iterator[tuple[int, int]]:
    """Spanning links of a shard's members: breadth-first over exact distances."""
    left = np.ones(len(fps), dtype=bool)
    for k in range(len(fps)):
        if not left[k]:
            continue
        left[k] = False
        queue, root = [k], int(fps[k])
        while queue:
            rest = np.flatnonzero(left)
            close = rest[np.bitwise_count(fps[rest] ^ fps[queue.pop()]) <= max_bits]
            left[close] = False
            for n in close.tolist():
                queue.append(n)
                yield root, int(fps[n])


def _links_in_shards(members: DataFrame, max_bits: int) -> DataFrame:
    """Links (a, b) inside each shard. A task reads its shards in order, one at a time."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        shard, held = None, []

        def links() -> pa.RecordBatch:
            fps = np.unique(np.concatenate(held)).view(np.uint64) if held else np.zeros(0, dtype=np.uint64)
            found = np.array(list(_forest(fps, max_bits)), dtype=np.uint64).reshape(-1, 2).view(np.int64)
            return pa.RecordBatch.from_arrays([pa.array(found[:, 0]), pa.array(found[:, 1])], ["a", "b"])

        for batch in batches:
            keys, fps = batch.column(0).to_numpy(), batch.column(1).to_numpy()
            cuts = [0, *(np.flatnonzero(np.diff(keys)) + 1).tolist(), len(keys)]
            for lo, hi in zip(cuts, cuts[1:]):
                if lo == hi:
                    continue
                if keys[lo] != shard:
                    if sum(map(len, held)) > 1:
                        yield links()
                    shard, held = keys[lo], []
                held.append(fps[lo:hi])
        if held:
            yield links()

    return members.repartition("shard").sortWithinPartitions("shard").mapInArrow(run, "a bigint, b bigint")


def _bit_leaves(members: DataFrame) -> DataFrame:
    """Links of fingerprints within 2 bits by the tree of single-bit levels: a leaf's members are
    all within one bit of its value, so each links to the smallest of them."""
    bits = F.transform(F.sequence(F.lit(0), F.lit(63)), lambda b: F.col("fp").bitwiseXOR(F.call_function("shiftleft", F.lit(1).cast("bigint"), b)))
    leaves = members.select("fp").distinct().select("fp", F.explode(F.concat(F.array("fp"), bits)).alias("leaf"))
    least = leaves.groupBy("leaf").agg(F.min("fp").alias("b"), F.count("*").alias("n")).where("n > 1")
    return leaves.join(least, "leaf").where("fp <> b").select(F.col("fp").alias("a"), "b")


def links(fps: DataFrame, n: int, max_bits: int = MAX_BITS, shard_rows: int = SHARD_ROWS) -> DataFrame:
    """Links (a, b) whose components are those of all pairs within ``max_bits`` bits of the
    distinct fingerprints in ``fps`` (column fp, ``n`` rows)."""
    if not 0 <= max_bits <= 2:
        raise ValueError("leaves overlap by one ring on either side: max_bits is 2 at most")
    levels = next(k for most, k in LEVELS if n <= most)
    members = _shards(fps, levels)
    sizes = members.groupBy("shard").count().where(F.col("count") > 1)
    root = new_work_dir(fps.sparkSession, "simhash-shards")
    sizes.write.parquet(root)
    sizes = fps.sparkSession.read.parquet(root)
    large = sizes.where(F.col("count") > shard_rows).select("shard")
    some_large = max_bits == 2 and len(large.take(1)) > 0
    small = members.join(large, "shard", "left_anti") if some_large else members
    found = _links_in_shards(small, max_bits)
    return found.unionByName(_bit_leaves(members.join(large, "shard", "left_semi"))) if some_large else found


def components(edges: DataFrame) -> DataFrame:
    """(node, root) of every node of the links (a, b): root is the component's smallest node.

    Alternates large-star (each node's larger neighbours move to its smallest neighbour) and
    small-star (its smaller ones do) until the links stay the same.
    """
    spark = edges.sparkSession
    root = new_work_dir(spark, "components")

    def kept(df: DataFrame, step: int) -> DataFrame:
        df.write.parquet(f"{root}/step={step}")
        return spark.read.parquet(f"{root}/step={step}")

    def state(df: DataFrame) -> tuple:
        return tuple(df.agg(F.count("*"), F.bit_xor(F.xxhash64("a", "b"))).first())

    def star(df: DataFrame, large: bool) -> DataFrame:
        both = df.union(df.select("b", "a")) if large else df
        least = both.groupBy("a").agg(F.min("b").alias("m")).withColumn("m", F.least("a", "m"))
        moved = both.join(least, "a")
        if large:
            return moved.where("b > a").select(F.col("b").alias("a"), F.col("m").alias("b")).distinct()
        own = least.where("m <> a").select("a", F.col("m").alias("b"))
        return moved.where("b <> m").select(F.col("b").alias("a"), F.col("m").alias("b")).union(own).distinct()

    # Links point from the larger node (a) to the smaller one (b).
    down = edges.where("a <> b").select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).distinct()
    links, step = kept(down, 0), 0
    before = state(links)
    while before[0]:
        step += 1
        links = kept(star(star(links, large=True), large=False), step)
        now = state(links)
        if now == before:
            break
        before = now
    return links.select(F.col("a").alias("node"), F.col("b").alias("root"))


def _classes(docs: DataFrame, id_col: str, text_col: str, shingle: int, max_bits: int) -> tuple[DataFrame, DataFrame]:
    """(rows, classes): rows (doc_id, text_key, fp) and per fingerprint its component's root."""
    spark = docs.sparkSession
    root = new_work_dir(spark, "simhash")
    fingerprints(docs, id_col, text_col, shingle).write.parquet(f"{root}/rows")
    rows = spark.read.parquet(f"{root}/rows")
    rows.groupBy("fp").agg(F.min(F.struct("doc_id", "text_key")).alias("any"), F.min("doc_id").alias("least")).write.parquet(f"{root}/fps")
    fps = spark.read.parquet(f"{root}/fps")
    found = components(links(fps.select("fp"), fps.count(), max_bits))
    joined = fps.join(found, fps["fp"] == found["node"], "left").select("fp", "least", F.coalesce("root", "fp").alias("root"))
    return rows, joined


def near_duplicates(
    docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", shingle: int = SHINGLE, max_bits: int = MAX_BITS
) -> DataFrame:
    """(doc_id, fingerprint, component_id) of every row."""
    rows, classes = _classes(docs, id_col, text_col, shingle, max_bits)
    least = classes.groupBy("root").agg(F.min("least").alias("component_id"))
    by_fp = classes.select("fp", "root").join(least, "root").select("fp", "component_id")
    return rows.join(by_fp, "fp").select("doc_id", F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"), "component_id")


def one_of_each(
    docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", shingle: int = SHINGLE, max_bits: int = MAX_BITS
) -> DataFrame:
    """One row of each component, with all columns: the smallest (doc_id, text hash), null ids last."""
    rows, classes = _classes(docs, id_col, text_col, shingle, max_bits)
    order = F.struct(F.col("doc_id").isNull().alias("none"), "doc_id", "text_key", "fp")
    by_fp = rows.groupBy("fp").agg(F.min(order).alias("first"))
    first = by_fp.join(classes.select("fp", "root"), "fp").groupBy("root").agg(F.min("first").alias("first"))
    # The same plain keys serve the join and the removal of repeated rows: one shuffle of the texts.
    keys = [free_name(docs, n) for n in ("_id", "_none", "_key")]

    def values(doc_id: Column, key: Column) -> dict[str, Column]:
        return dict(zip(keys, (F.coalesce(doc_id, F.lit(0).cast("bigint")), doc_id.isNull(), key)))

    kept = first.select(*[v.alias(k) for k, v in values(F.col("first.doc_id"), F.col("first.text_key")).items()])
    keyed = docs.withColumns(values(F.col(id_col).cast("bigint"), text_key(text_col)))
    return keyed.join(kept, keys, "left_semi").dropDuplicates(keys).select(*docs.columns)


def op3_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir.rstrip('/')}/documents.parquet").select("doc_id", "text")
    return near_duplicates(docs)
