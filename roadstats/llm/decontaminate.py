"""Benchmark decontamination: Wu-Manber multi-pattern search over words.

Patterns are the benchmark items' windows of ``window`` consecutive words (an item with fewer
words is one shorter window). Symbols are words, not characters. For each window length the
index has a shift table over hashed blocks of two words (how far the search may skip when a
block ends at the current word) and buckets of windows by the hash of their last block. A
block with shift 0 opens its bucket; a candidate counts only after its words have been
compared byte for byte, so hash collisions cost time and never a wrong hit.

The windows are cut and repeated ones merged by Spark. They are dealt by hash to blocks of about
``BLOCK_WINDOWS`` distinct windows; the index of a block is a few flat arrays, built at once from its
rows and broadcast. A larger benchmark is searched block by block, each block's narrow result written
to the shared folder and the hit spans united per document. Documents are never shuffled for one
block. A window's items travel with it (no more than there are items).

Defined results: a null or empty text has no words, no hits and no items. Null or empty items
give no window; a null item_id counts in the hits but not among the items. Repeated items and
windows count once. Repeated documents each get their row. An empty benchmark or document table
gives no hits, or no rows. Extra columns of either table are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from roadstats.llm.words import mix, split_words, text_bytes
from roadstats.session import new_work_dir

WINDOW = 10
#: Distinct windows that one broadcast index covers (about 0.2 KB each, tables included).
BLOCK_WINDOWS = 1 << 18
#: Windows that a task hands to Spark together.
HANDED = 1 << 13

RESULT = "doc_id bigint, n_words bigint, spans array<struct<from: int, to: int>>, items array<bigint>"


@dataclass
class Table:
    """Shift table, suffix buckets and windows of one length, as flat arrays.

    Window k is ``data[offsets[k]:offsets[k + 1]]`` and belongs to the items
    ``items[item_offsets[k]:item_offsets[k + 1]]``; ``suffixes`` are the sorted hashes of the
    windows' last blocks and ``windows`` the numbers of the windows in that order.
    """

    length: int
    shift: np.ndarray
    mask: np.uint64
    suffixes: np.ndarray
    windows: np.ndarray
    data: bytes
    offsets: np.ndarray
    items: np.ndarray
    item_offsets: np.ndarray

    def bucket(self, block: np.uint64) -> Iterator[int]:
        """Windows whose last block has this hash."""
        at = int(np.searchsorted(self.suffixes, block))
        while at < len(self.suffixes) and self.suffixes[at] == block:
            yield int(self.windows[at])
            at += 1


def _blocks(hashes: np.ndarray, length: int) -> np.ndarray:
    """Hash of the block that ends at each word (two words; one if the windows have one)."""
    if length == 1:
        return hashes
    return mix(hashes[..., :-1] * np.uint64(31) + hashes[..., 1:])


def benchmark_windows(benchmark: DataFrame, id_col: str, text_col: str, window: int = WINDOW) -> DataFrame:
    """(length, words, items): the distinct windows, their words joined by blanks, and their items."""

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for group in split_words(batch.column(1)):
                at = group.bounds()
                for r in range(len(group.counts)):
                    length = int(min(window, at[r + 1] - at[r]))
                    if not length:
                        continue
                    own = slice(at[r], at[r + 1])
                    text = _joined(group.low, group.starts[own], group.ends[own])
                    starts = np.concatenate(([0], np.cumsum(group.ends[own] - group.starts[own] + 1)))
                    count = len(starts) - length
                    for lo in range(0, count, HANDED):
                        found = [text[a : b - 1] for a, b in zip(starts[lo : min(lo + HANDED, count)], starts[lo + length :])]
                        item = pa.repeat(batch.column(0)[group.first + r], len(found))
                        yield pa.RecordBatch.from_arrays([pa.array([length] * len(found), pa.int32()), pa.array(found, pa.binary()), item], ["length", "words", "item"])

    rows = benchmark.select(F.col(id_col).cast("bigint").alias("item"), F.col(text_col).alias("text")).where("text != ''")
    found = rows.mapInArrow(cut, "length int, words binary, item bigint")
    return found.groupBy("length", "words").agg(F.collect_set("item").alias("items"))


def window_blocks(benchmark: DataFrame, id_col: str, text_col: str, window: int, block_windows: int) -> Iterator[pa.Table]:
    """The distinct windows in blocks of about ``block_windows``, one at least."""
    spark, root = benchmark.sparkSession, new_work_dir(benchmark.sparkSession, "benchmark-windows")
    benchmark_windows(benchmark, id_col, text_col, window).write.parquet(f"{root}/all")
    every = spark.read.schema("length int, words binary, items array<bigint>").parquet(f"{root}/all")
    n = -(-every.count() // block_windows)
    if n <= 1:
        yield every.toArrow()
        return
    block = F.pmod(F.xxhash64("words"), F.lit(n)).cast("int").alias("block")
    every.select("*", block).repartition("block").write.partitionBy("block").parquet(f"{root}/blocks")
    for k in range(n):
        yield spark.read.parquet(f"{root}/blocks").where(F.col("block") == k).drop("block").toArrow()


def build_index(block: pa.Table) -> list[Table]:
    """One table for each window length that occurs in a block (length, words, items)."""
    tables = []
    for length in sorted(pc.unique(block.column("length")).to_pylist()):
        rows = block.filter(pc.equal(block.column("length"), length)).combine_chunks()
        texts = rows.column("words").cast(pa.string()).combine_chunks()
        data, offsets = text_bytes(texts)
        hashes = np.concatenate([group.hashes for group in split_words(texts)]).reshape(-1, length)
        size = min(2, length)
        slots = 1 << min(24, max(16, (32 * len(hashes) * length).bit_length()))
        shift = np.full(slots, length - size + 1, dtype=np.uint8 if length < 250 else np.int32)
        mask = np.uint64(slots - 1)
        ends = _blocks(hashes, length)
        for k in range(ends.shape[1]):  # later blocks allow smaller steps, which stay
            shift[(ends[:, k] & mask).astype(np.int64)] = ends.shape[1] - 1 - k
        order = np.argsort(ends[:, -1], kind="stable")
        lists = rows.column("items").combine_chunks()
        items = np.asarray(lists.flatten().to_numpy(zero_copy_only=False), dtype=np.int64)
        counts = pc.fill_null(pc.list_value_length(lists), 0).to_numpy(zero_copy_only=False)
        item_offsets = np.concatenate(([0], np.cumsum(counts))).astype(np.int64)
        tables.append(Table(length, shift, mask, ends[order, -1], order, data.tobytes(), offsets, items, item_offsets))
    return tables


def _joined(low: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> bytes:
    return b" ".join(low[s:e].tobytes() for s, e in zip(starts, ends))


def _occurrences(table: Table, group, lo: int, hi: int, shifts: bytes, blocks: np.ndarray) -> Iterator[tuple[int, int]]:
    """(first word, window) of each occurrence among words ``lo .. hi - 1`` of the group."""
    size = 1 if table.length == 1 else 2
    at, last = lo + table.length - size, hi - size  # block k covers words k .. k + size - 1
    while at <= last:
        step = shifts[at]
        if step:
            at += step
            continue
        start = at + size - table.length
        text = None
        for n in table.bucket(blocks[at]):
            text = text or _joined(group.low, group.starts[start : start + table.length], group.ends[start : start + table.length])
            if text == table.data[table.offsets[n] : table.offsets[n + 1]]:
                yield start, n
        at += 1


def _united(spans: list[tuple[int, int]]) -> list[tuple[int, int]]:
    out: list[tuple[int, int]] = []
    for lo, hi in sorted(spans):
        if out and lo <= out[-1][1]:
            out[-1] = (out[-1][0], max(hi, out[-1][1]))
        else:
            out.append((lo, hi))
    return out


def search_words(column: pa.Array, tables: list[Table]) -> Iterator[tuple[int, int, list[tuple[int, int]], list[int]]]:
    """(row, number of words, united hit spans, item ids) of each row of a text column."""
    for group in split_words(column):
        scans = []
        for table in tables:
            blocks = _blocks(group.hashes, table.length)
            shifts = table.shift[(blocks & table.mask).astype(np.int64)]
            scans.append((table, shifts.tobytes() if shifts.dtype == np.uint8 else shifts, blocks))
        at = group.bounds().tolist()
        for r in range(len(group.counts)):
            spans, items = [], set()
            for table, shifts, blocks in scans:
                for start, n in _occurrences(table, group, at[r], at[r + 1], shifts, blocks):
                    spans.append((start - at[r], start - at[r] + table.length))
                    items.update(table.items[table.item_offsets[n] : table.item_offsets[n + 1]].tolist())
            yield group.first + r, at[r + 1] - at[r], _united(spans), sorted(items)


def _search(docs: DataFrame, id_col: str, text_col: str, block: pa.Table) -> DataFrame:
    shared = docs.sparkSession.sparkContext.broadcast([vars(t) for t in build_index(block)])

    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tables = [Table(**fields) for fields in shared.value]
        span = pa.list_(pa.struct([("from", pa.int32()), ("to", pa.int32())]))
        for batch in batches:
            n, spans, found = [], [], []
            for _, words, hit, ids in search_words(batch.column(2), tables):
                n.append(words)
                spans.append([{"from": a, "to": b} for a, b in hit])
                found.append(ids)
            columns = [batch.column(0), batch.column(1), pa.array(n, pa.int64()), pa.array(spans, span), pa.array(found, pa.list_(pa.int64()))]
            yield pa.RecordBatch.from_arrays(columns, ["doc_id", "text_key", "n_words", "spans", "items"])

    rows = docs.select(F.col(id_col).cast("bigint").alias("doc_id"), F.xxhash64(text_col).alias("text_key"), F.col(text_col).alias("text"))
    return rows.mapInArrow(scan, RESULT.replace("n_words", "text_key bigint, n_words"))


def find_benchmark(
    docs: DataFrame,
    benchmark: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    item_col: str = "item_id",
    item_text_col: str = "text",
    window: int = WINDOW,
    block_windows: int = BLOCK_WINDOWS,
) -> DataFrame:
    """One row per document: doc_id, n_words, spans (hit words, end exclusive) and items."""
    spark = docs.sparkSession
    blocks = window_blocks(benchmark, item_col, item_text_col, window, block_windows)
    first = next(blocks)
    second = next(blocks, None)
    if second is None:
        return _search(docs, id_col, text_col, first).drop("text_key")
    # Equal rows give equal results: the first block keeps one row per document row, the others
    # add their spans and items by (doc_id, text).
    root = new_work_dir(spark, "benchmark-blocks")
    _search(docs, id_col, text_col, first).write.parquet(f"{root}/block=0")
    n = 1
    while second is not None:
        found = _search(docs, id_col, text_col, second).where(F.size("items") + F.size("spans") > 0)
        found.dropDuplicates(["doc_id", "text_key"]).write.parquet(f"{root}/block={n}")
        second, n = next(blocks, None), n + 1
    base = spark.read.parquet(f"{root}/block=0")
    more = spark.read.parquet(*[f"{root}/block={k}" for k in range(1, n)])
    more = more.groupBy("doc_id", "text_key").agg(
        F.flatten(F.collect_list("spans")).alias("spans2"), F.flatten(F.collect_list("items")).alias("items2")
    )
    on = base["doc_id"].eqNullSafe(more["doc_id"]) & (base["text_key"] == more["text_key"])
    joined = base.join(more, on, "left").select(
        base["doc_id"],
        base["n_words"],
        F.concat("spans", F.coalesce("spans2", F.array().cast("array<struct<from:int,to:int>>"))).alias("spans"),
        F.array_sort(F.array_union("items", F.coalesce("items2", F.array().cast("array<bigint>")))).alias("items"),
    )
    # Unite the spans of the blocks: keep a running union while walking them in order.
    span = "struct<from: int, to: int>"
    ordered = F.array_sort("spans")
    united = F.aggregate(
        ordered,
        F.array().cast(f"array<{span}>"),
        lambda out, s: F.when(
            (F.size(out) > 0) & (s["from"] <= F.element_at(out, -1)["to"]),
            F.concat(
                F.slice(out, 1, F.size(out) - 1),
                F.array(F.struct(F.element_at(out, -1)["from"].alias("from"), F.greatest(F.element_at(out, -1)["to"], s["to"]).alias("to"))),
            ),
        ).otherwise(F.concat(out, F.array(s))),
    )
    return joined.select("doc_id", "n_words", united.alias("spans"), "items")


def digest(found: DataFrame) -> DataFrame:
    """Contract columns from ``find_benchmark`` rows."""
    n_hit = F.aggregate("spans", F.lit(0).cast("bigint"), lambda s, x: s + (x["to"] - x["from"]))
    ids = F.array_join(F.array_sort(F.transform("items", lambda x: x.cast("string"))), ",")
    return found.select(
        "doc_id",
        "n_words",
        n_hit.alias("n_hit"),
        F.size("items").cast("bigint").alias("n_items"),
        F.sha2(ids, 256).alias("items_sha256"),
        (n_hit > 0).alias("contaminated"),
    )


def has_benchmark(text: Column, spark: SparkSession, block: pa.Table) -> Column:
    """Whether a text holds any window of the block."""
    shared = spark.sparkContext.broadcast([vars(t) for t in build_index(block)])

    @F.arrow_udf("boolean")
    def run(column: pa.Array) -> pa.Array:
        tables = [Table(**fields) for fields in shared.value]
        return pa.array([bool(spans) for _, _, spans, _ in search_words(column, tables)], pa.bool_())

    return run(text)


def clean_documents(docs: DataFrame, benchmark: DataFrame, window: int = WINDOW, block_windows: int = BLOCK_WINDOWS) -> DataFrame:
    """The rows of ``docs`` (all columns) whose text holds no benchmark window.

    A filter beside the scan, without a shuffle. Of a large benchmark four blocks are searched
    at a time, the rows they leave being written to the shared folder.
    """
    spark = docs.sparkSession
    kept, root = docs, None
    for n, block in enumerate(window_blocks(benchmark, "item_id", "text", window, block_windows)):
        if n and n % 4 == 0:
            root = root or new_work_dir(spark, "decontaminate")
            kept.write.parquet(f"{root}/{n}")
            kept = spark.read.parquet(f"{root}/{n}")
        kept = kept.where(~has_benchmark(F.col("text"), spark, block))
    return kept


def op10_decontaminate(spark: SparkSession, sf_dir: str) -> DataFrame:
    root = sf_dir.rstrip("/")
    docs = spark.read.parquet(f"{root}/documents.parquet").select("doc_id", "text")
    benchmark = spark.read.parquet(f"{root}/benchmark.parquet").select("item_id", "text")
    return digest(find_benchmark(docs, benchmark))
