"""Hard negatives by threshold joins with suffix-norm bounds.

A query vector (anchor) wants rows in order of their integer inner product with it. ``threshold_join``
finds all rows of a block with a product of at least each query's threshold, in the manner of L2AP:

* Dimensions stand in a fixed order, those with the most weight last. Of each row the first ones are
  left out of the inverted index, as many as have norm times the queries' largest norm below the
  smallest threshold: alone they reach no threshold, so a row that does meets a posting. Rows are
  kept in the order of their first indexed dimension, so a dimension's postings are a run of rows.
* Partial products are summed over the postings from the last dimension to the first. A pair is dropped
  once its sum plus the product of the two norms over what is left is below the query's threshold.
* The pairs left add the product over the dimensions outside the index, which makes them exact.

``mine`` calls it in rounds, for positives and then for the windows below them. Queries whose windows
are not filled come back with a lower threshold, and the last one admits every row that may count.
What is found at a threshold is complete above it, so a filled window is final. Thresholds decide how
much is looked at, never what is found.

Rows are scanned where they lie; queries come in blocks of ``BLOCK_BYTES`` that are broadcast. Each
task hands on at most the best few rows per query and window, and these are merged by query.

Defined results: rows with a null id, label or vector or with a null or non-finite component take no
part. A row that is repeated with its id, label and vector counts once; different rows of one id are
different rows, but never partners of an anchor with that id. A shorter vector counts as filled up with
zeros. Products are exact integers: by floats below 2 ** 53, beyond by Python integers. An empty table
gives no rows. Columns other than the three are not read.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from roadstats.session import new_work_dir, path_exists

#: Most bytes of query vectors that are broadcast at a time.
BLOCK_BYTES = 8 << 20
#: Rows a task looks at together, queries by rows in one step.
CHUNK, PAIRS = 1 << 13, 1 << 20
#: Dimensions that a step sums over before pairs are dropped.
STEP = 8
#: Thresholds of the first rounds: for positives shares of the largest product that the norms allow,
#: for negatives shares of the smallest positive product. The last round's admits all that count.
SHARES, CLOSE = (0.35, 0.22), (0.95, 0.88)
_SLACK = 1e-9
_FLOAT_EXACT = float(1 << 53)


def take_part(rows: DataFrame, id_col: str, label: Column, vector_col: str, scale: int = 256) -> DataFrame:
    """(id, label, vector): rows that take part, components as floor(scale * x) in doubles."""
    x = lambda v: v.cast("double")
    bad = F.exists(F.col(vector_col), lambda v: v.isNull() | F.isnan(v) | (F.abs(x(v)) == float("inf")))
    whole = F.transform(F.col(vector_col), lambda v: F.floor(F.lit(float(scale)) * x(v)).cast("double"))
    kept = rows.where(F.col(id_col).isNotNull() & label.isNotNull() & F.col(vector_col).isNotNull() & ~bad)
    return kept.select(F.col(id_col).cast("bigint").alias("id"), label.cast("bigint").alias("label"), whole.alias("vector")).distinct()


def matrix(column: pa.Array, width: int) -> np.ndarray:
    """Vectors of a list column as rows, filled up with zeros to ``width``."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    sizes = np.asarray(pc.list_value_length(column)).astype(np.int64)
    out = np.zeros((len(column), width))
    row = np.repeat(np.arange(len(column)), sizes)
    out[row, np.arange(len(row)) - np.repeat(np.cumsum(sizes) - sizes, sizes)] = np.asarray(pc.list_flatten(column))
    return out


@dataclass
class Index:
    """Rows ordered by their first indexed dimension (``starts``), with prefix norms.

    ``norms[:, d]`` is the norm of the dimensions before d.
    """

    rows: np.ndarray
    starts: np.ndarray
    norms: np.ndarray
    order: np.ndarray

    @classmethod
    def build(cls, rows: np.ndarray, most: float, least: float) -> "Index":
        """Index for queries of norm up to ``most`` and thresholds from ``least`` on."""
        norms = prefix_norms(rows)
        covered = norms * most * (1 + _SLACK) < least
        starts = np.maximum(covered.sum(axis=1) - 1, 0)
        order = np.argsort(starts, kind="stable")
        return cls(rows[order], starts[order], norms[order], order)


def prefix_norms(rows: np.ndarray) -> np.ndarray:
    return np.sqrt(np.concatenate((np.zeros((len(rows), 1)), np.cumsum(rows * rows, axis=1)), axis=1))


def threshold_join(queries: np.ndarray, thresholds: np.ndarray, index: Index) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray]]:
    """(query, row, product) of all pairs with a product of at least the query's threshold, for some
    queries at a time (about ``PAIRS`` pairs)."""
    width, n = queries.shape[1], len(index.rows)
    q_norms, rows = prefix_norms(queries), np.arange(n)
    limit = thresholds - _SLACK * (1 + np.abs(thresholds))
    block = max(1, PAIRS // max(n, 1))
    for lo in range(0, len(queries), block):
        q, qn, t = queries[lo : lo + block], q_norms[lo : lo + block], limit[lo : lo + block]
        sums = np.zeros((len(q), n))
        pair = None  # Once few pairs are left they are kept as (query, row, sum).
        for end in range(width, 0, -STEP):
            begin = max(end - STEP, 0)
            if pair is None:
                # Rows with postings in all these dimensions, then those whose postings begin in them.
                first = int(np.searchsorted(index.starts, begin, side="right"))
                sums[:, :first] += q[:, begin:end] @ index.rows[:first, begin:end].T
                for d in range(begin + 1, end):
                    more = int(np.searchsorted(index.starts, d, side="right"))
                    if more > first:
                        sums[:, first:more] += q[:, d : d + 1] * index.rows[first:more, d]
                left = np.maximum(begin, index.starts)  # the dimensions before this one are still to come
                alive = sums + qn[:, left] * index.norms[rows, left] * (1 + _SLACK) >= t[:, None]
                if alive.sum() * 8 < alive.size:
                    a, b = np.nonzero(alive)
                    pair = a, b, sums[a, b]
            else:
                a, b, s = pair
                posted = index.starts[b, None] <= np.arange(begin, end)
                s = s + (q[a, begin:end] * index.rows[b, begin:end] * posted).sum(axis=1)
                left = np.maximum(begin, index.starts[b])
                kept = s + qn[a, left] * index.norms[b, left] * (1 + _SLACK) >= t[a]
                pair = a[kept], b[kept], s[kept]
        if pair is None:
            a, b = np.nonzero(alive) if width else np.nonzero(np.ones_like(sums, dtype=bool))
            pair = a, b, sums[a, b]
        a, b, s = pair
        product = _finish(q, a, index, b, s)
        kept = product >= thresholds[lo : lo + block][a]
        yield a[kept] + lo, index.order[b[kept]], product[kept]


def _finish(q: np.ndarray, a: np.ndarray, index: Index, b: np.ndarray, sums: np.ndarray) -> np.ndarray:
    """Exact products: the sums over the postings and the product of what is outside the index."""
    if len(a) and (q**2).sum(axis=1).max() * index.norms[:, -1].max() ** 2 >= _FLOAT_EXACT**2 / 4:
        return np.array([sum(int(x) * int(y) for x, y in zip(q[i], index.rows[j])) for i, j in zip(a, b)], dtype=np.int64)
    out, width = sums.copy(), int(index.starts[b].max()) if len(b) else 0
    for lo in range(0, len(a) if width else 0, 1 << 14):
        i, j = a[lo : lo + (1 << 14)], b[lo : lo + (1 << 14)]
        outside = np.arange(width) < index.starts[j, None]
        out[lo : lo + (1 << 14)] += (q[i, :width] * index.rows[j, :width] * outside).sum(axis=1)
    return np.rint(out).astype(np.int64)


def best_of(query: np.ndarray, product: np.ndarray, ids: np.ndarray, n: int) -> np.ndarray:
    """Places of each query's first ``n`` by product descending, then id."""
    order = np.lexsort((ids, -product, query))
    sorted_query = query[order]
    first = np.searchsorted(sorted_query, sorted_query, side="left")
    return order[np.arange(len(order)) - first < n]


@dataclass
class Block:
    """Queries of a round: their places in the whole block, ids, labels, vectors (dimensions in index
    order), thresholds and, for windows, the highest product of each (a row a query)."""

    places: np.ndarray
    ids: np.ndarray
    labels: np.ndarray
    vectors: np.ndarray
    thresholds: np.ndarray
    dims: np.ndarray
    highs: np.ndarray | None = None

    def part(self, kept: np.ndarray, thresholds: np.ndarray) -> "Block":
        highs = None if self.highs is None else self.highs[kept]
        return Block(kept, self.ids[kept], self.labels[kept], self.vectors[kept], thresholds, self.dims, highs)


def _chunks(batches: Iterator[pa.RecordBatch], dims: np.ndarray) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray]]:
    for batch in batches:
        for lo in range(0, batch.num_rows, CHUNK):
            part = batch.slice(lo, CHUNK)
            ids, labels = (part.column(k).to_numpy(zero_copy_only=False) for k in (0, 1))
            yield ids, labels, matrix(part.column(2), len(dims))[:, dims]


def _sides(block: Block, labels: np.ndarray) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """(queries, rows) to join: all with all for windows, else label by label."""
    if block.highs is not None:
        yield np.arange(len(block.ids)), np.arange(len(labels))
        return
    for label in np.intersect1d(block.labels, labels):
        yield np.flatnonzero(block.labels == label), np.flatnonzero(labels == label)


def join_block(rows: DataFrame, block: Block, n: int) -> DataFrame:
    """(query, slot, rank, product, id): for each query of ``block`` (by place) the best ``n`` rows at or
    above its threshold: of its own label (slot 0), or of other labels for each of its windows."""
    shared = rows.sparkSession.sparkContext.broadcast(block)
    slots = 1 if block.highs is None else block.highs.shape[1]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        block: Block = shared.value
        norms = np.sqrt((block.vectors**2).sum(axis=1))
        held = [np.zeros(0, dtype=np.int64)] * 3  # query and slot, product, id
        for ids, labels, vectors in _chunks(batches, block.dims):
            fresh = [held]
            for queries, places in _sides(block, labels):
                thresholds = block.thresholds[queries]
                index = Index.build(vectors[places], norms[queries].max(), thresholds.min())
                for q, r, product in threshold_join(block.vectors[queries], thresholds, index):
                    q, r = queries[q], places[r]
                    kept = ids[r] != block.ids[q]
                    if block.highs is not None:
                        kept &= labels[r] != block.labels[q]
                    q, r, product = q[kept], r[kept], product[kept]
                    for slot in range(slots):
                        fits = slice(None) if block.highs is None else product <= block.highs[q, slot]
                        found = [q[fits] * slots + slot, product[fits], ids[r[fits]]]
                        best = best_of(*found, n)
                        fresh.append([x[best] for x in found])
            held = [np.concatenate(x) for x in zip(*fresh)]
            best = best_of(*held, n)
            held = [x[best] for x in held]
        columns = [block.places[held[0] // slots], held[0] % slots, held[1], held[2]]
        yield pa.RecordBatch.from_arrays([pa.array(x) for x in columns], ["query", "slot", "product", "id"])

    found = rows.mapInArrow(run, "query bigint, slot bigint, product bigint, id bigint")
    order = Window.partitionBy("query", "slot").orderBy(F.col("product").desc(), F.col("id"))
    return found.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= n)


def _rounds(rows: DataFrame, block: Block, n: int, steps: list[np.ndarray], root: str, filled) -> np.ndarray:
    """Join with the falling thresholds ``steps``, each round written to ``root``/round=k; the number of
    the round that each query is complete in. ``filled(waiting, counts)`` says which windows are full."""
    spark, waiting = rows.sparkSession, np.arange(len(block.ids))
    ready = np.zeros(len(waiting), dtype=np.int64)
    slots = 1 if block.highs is None else block.highs.shape[1]
    for k, step in enumerate(steps):
        path = f"{root}/round={k}"
        join_block(rows, block.part(waiting, step[waiting]), n).write.parquet(path)
        ready[waiting] = k
        if k + 1 == len(steps):
            break
        got = spark.read.parquet(path).groupBy("query", "slot").agg(F.count("*").alias("n")).toArrow()
        query, slot, size = (np.asarray(got.column(c)).astype(np.int64) for c in ("query", "slot", "n"))
        counts = np.zeros((len(block.ids), slots), dtype=np.int64)
        counts[query, slot] = size
        waiting = waiting[~filled(waiting, counts[waiting], step[waiting])]
        if not len(waiting):
            break
    return ready


def mine_block(rows: DataFrame, block: Block, largest: float, positives: int, negatives: int, low: int, high: int, root: str) -> DataFrame | None:
    """(anchor_id, positive_id, rank, negative_id, positive_score, negative_score) for the anchors of a
    block, whose rounds are kept under ``root``."""
    spark = rows.sparkSession
    bounds = np.sqrt((block.vectors**2).sum(axis=1)) * largest
    steps = [np.floor(bounds * share) for share in SHARES] + [np.full(len(bounds), float(np.iinfo(np.int64).min))]
    ready = _rounds(rows, block, positives, steps, f"{root}/positives", lambda _, counts, __: counts[:, 0] >= positives)
    got = spark.read.parquet(f"{root}/positives").select("query", "round", "rank", "product", "id").toArrow()
    query, found_in, rank, product, ids = (np.asarray(c).astype(np.int64) for c in got.columns)
    # A pair takes part if a product n with low * p <= 100 n <= high * p can exist.
    kept = (ready[query] == found_in) & ((product >= 0) if low <= high else (product <= 0))
    query, rank, product, ids = query[kept], rank[kept] - 1, product[kept], ids[kept]
    if not len(query):
        return None
    anchors, at = np.unique(query, return_inverse=True)
    highs = np.full((len(anchors), positives), np.iinfo(np.int64).min, dtype=np.int64)
    lows = np.full((len(anchors), positives), np.iinfo(np.int64).max, dtype=np.int64)
    whole, rest = np.divmod(product, 100)  # hundredths without an overflow
    highs[at, rank], lows[at, rank] = whole * high + rest * high // 100, whole * low - (-rest * low // 100)
    windows = block.part(anchors, np.zeros(len(anchors)))
    windows.highs = highs

    def filled(waiting: np.ndarray, counts: np.ndarray, step: np.ndarray) -> np.ndarray:
        # A window is final when it is full, or when nothing of it lies below the threshold.
        return ((counts >= negatives) | (step[:, None] <= lows[waiting])).all(axis=1)

    least = np.nextafter(lows.min(axis=1).astype(np.float64), -np.inf)
    closest = np.where(highs >= 0, highs, np.iinfo(np.int64).max).min(axis=1)
    steps = [np.maximum(np.floor(closest * share), least) for share in CLOSE] + [least]
    ready = _rounds(rows, windows, negatives, steps, f"{root}/negatives", filled)
    columns = {"query": at, "slot": rank, "round": ready[at], "anchor_id": windows.ids[at], "positive_id": ids, "positive_score": product, "least": lows[at, rank]}
    wanted = spark.createDataFrame(pa.table(columns))
    found = spark.read.parquet(f"{root}/negatives").withColumn("round", F.col("round").cast("bigint"))
    joined = found.join(wanted, ["query", "slot", "round"]).where(F.col("product") >= F.col("least"))
    return joined.select("anchor_id", "positive_id", F.col("rank").cast("int").alias("rank"), F.col("id").alias("negative_id"), "positive_score", F.col("product").alias("negative_score"))


RESULT = "anchor_id bigint, positive_id bigint, rank int, negative_id bigint, positive_score bigint, negative_score bigint"


def mine(rows: DataFrame, is_anchor: Column, positives: int = 5, negatives: int = 5, low: int = 80, high: int = 100) -> DataFrame:
    """Hard negatives of the anchors among ``rows`` (id, label, vector), see ``take_part``.

    For each of an anchor's best ``positives`` rows of its label: the best ``negatives`` rows of other
    labels whose product lies between ``low`` and ``high`` hundredths of the positive's.
    """
    spark, root = rows.sparkSession, new_work_dir(rows.sparkSession, "negatives")
    rows.write.parquet(f"{root}/rows")
    rows = spark.read.parquet(f"{root}/rows")

    def weights(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            width = max(pc.max(pc.list_value_length(batch.column(0))).as_py() or 0, 1)
            squares = matrix(batch.column(0), width) ** 2
            norm = np.full(width, np.sqrt(squares.sum(axis=1).max()))
            yield pa.RecordBatch.from_arrays([pa.array(np.arange(width)), pa.array(squares.sum(axis=0)), pa.array(norm)], ["dim", "weight", "norm"])

    weighed = rows.select("vector").mapInArrow(weights, "dim bigint, weight double, norm double")
    dims = weighed.groupBy("dim").agg(F.sum("weight").alias("weight"), F.max("norm").alias("norm")).orderBy("weight", "dim").collect()
    if not dims:
        return spark.createDataFrame([], RESULT)
    order, largest = np.array([d["dim"] for d in dims]), max(d["norm"] for d in dims)
    anchors = rows.where(is_anchor)
    blocks = -(-anchors.count() * len(dims) * 8 // BLOCK_BYTES)
    for k in range(blocks):
        got = anchors.where(F.pmod(F.xxhash64("id"), F.lit(blocks)) == k).toArrow().sort_by("id")
        if not got.num_rows:
            continue
        ids, labels = (np.asarray(got.column(c)).astype(np.int64) for c in ("id", "label"))
        block = Block(np.arange(len(ids)), ids, labels, matrix(got.column("vector"), len(dims))[:, order], np.zeros(len(ids)), order)
        found = mine_block(rows, block, largest, positives, negatives, low, high, f"{root}/block-{k}")
        if found is not None:
            found.write.parquet(f"{root}/found/block={k}")
    if not path_exists(spark, f"{root}/found"):
        return spark.createDataFrame([], RESULT)
    return spark.read.schema(RESULT).parquet(f"{root}/found").select(*[c.split()[0] for c in RESULT.split(", ")])


def op13_negatives(spark: SparkSession, sf_dir: str) -> DataFrame:
    table = spark.read.parquet(f"{sf_dir.rstrip('/')}/embeddings.parquet")
    label = F.when(F.col("vec_id") % 7 == 0, (F.col("label") + 1) % 10).otherwise(F.col("label"))
    return mine(take_part(table, "vec_id", label, "embedding"), F.col("id") % 100 == 0)
