"""Phrase collocations by mergeable Misra-Gries summaries and an exact second pass.

Text is lower-cased (A-Z) and cut at ``[.,;:!?\\x0A-\\x0D]`` into pieces, those at blanks and tabs into
words. Everything is counted per language (null: ``und``).

First pass: all n-grams of 1 to 3 words are dealt by hash to parts. A part's stream of (fingerprint,
count) runs is merged into a Misra-Gries summary: when there are more counters than its capacity,
the largest count outside it is taken from all, and those that fall to zero go. A count is then
too low by at most what was taken in all, which stays under mass / capacity. The capacity is
``SLACK`` times mass / threshold, so an n-gram seen ``threshold`` times always survives. The part's
survivors leave as bits of a map of ``MAP_BITS`` bits (a fixed size, whatever the corpus).

Second pass: the texts are read again and n-grams whose bit is set are counted exactly, under the
64-bit hashes of their words (words with their own text). An n-gram let through by a shared
fingerprint or bit only costs its count; those under the threshold go. Two words with one hash would
mix their phrases: each is counted under its own text, so this is seen, and the words are then
hashed by another function.

``collocations`` then scores each phrase at its weakest cut, drops those inside a longer phrase that
explains half of them, and ranks by language.

Defined results: null and empty texts have no words. Repeated rows count each. Ties in the ranking go
to the phrase that is smaller by bytes. Words may be of any length. An empty table gives no rows.
Columns other than text and language are not read. Counts are exact up to 10 ** 15.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from roadstats.llm.words import Words, mix, split_words
from roadstats.session import new_work_dir

THRESHOLD = 10
#: Capacity of a summary over mass / threshold.
SLACK = 2
#: Bits of the survivors' map (16 MB, broadcast).
MAP_BITS = 1 << 27
#: Bytes of text behind a part of the first pass; least and most parts, as powers of two. Beyond 1 TB
#: the parts grow, to about 40 million counters (0.6 GB) each at 100 TB.
PART_BYTES, LEAST_PARTS, MOST_PARTS = 1 << 22, 5, 18
#: N-grams that a task gathers before it hands them on, in the first and in the second pass.
RUN, COUNTED = 1 << 19, 1 << 18
#: Bytes of a row group of the written runs. Their rows are some KB each, and Spark reads a row group's
#: first 4,096 rows into one column vector.
ROW_GROUP = 1 << 22
#: Most rows of a batch that goes back to Spark, and bytes of text that are cut into words together.
HANDED, TEXT = 1 << 14, 1 << 18
LONGEST = 3
#: Parts that a word is dealt to in joins, since few words begin or end many phrases.
SALTS = 4
_STEPS = [np.uint64(m) for m in (0x9E3779B97F4A7C15, 0xC2B2AE3D27D4EB4F, 0x165667B19E3779F9)]
_LANG = np.uint64(0xD6E8FEB86659FD93)


def _bytes(chars: bytes) -> np.ndarray:
    table = np.zeros(256, dtype=bool)
    table[list(chars)] = True
    return table


_PIECE_END = _bytes(b".,;:!?\n\x0b\x0c\r")
_WORD = ~(_PIECE_END | _bytes(b" \t"))


def _digest(data: bytes) -> int:
    return int.from_bytes(hashlib.blake2b(data, digest_size=8).digest(), "little")


def word_ids(group: Words, langs: list[str], careful: bool = False) -> np.ndarray:
    """64-bit id of each word within its row's language; ``careful`` takes a cryptographic hash."""
    hashes = group.hashes
    if careful:
        spans = [group.low[a:b].tobytes() for a, b in zip(group.starts, group.ends)]
        hashes = np.array([_digest(s) for s in spans], dtype=np.uint64)
    lang = np.array([_digest(x.encode()) for x in langs], dtype=np.uint64)
    return mix(hashes ^ np.repeat(lang, group.counts) * _LANG)


def pieces(group: Words) -> np.ndarray:
    """Number of the piece that each word lies in; pieces of different rows differ."""
    ends = np.concatenate(([0], np.cumsum(_PIECE_END[group.low])))
    return ends[group.starts] + np.repeat(np.arange(len(group.counts)), group.counts)


def ngrams(ids: np.ndarray, piece: np.ndarray) -> Iterator[tuple[int, np.ndarray, np.ndarray]]:
    """(length, places, fingerprints) of the n-grams of each length within pieces."""
    mixed = np.zeros(len(ids), dtype=np.uint64)
    for n in range(1, LONGEST + 1):
        size = max(len(ids) - n + 1, 0)
        mixed = mixed[:size] + ids[n - 1 :] * _STEPS[n - 1]
        places = np.flatnonzero(piece[:size] == piece[n - 1 :])
        yield n, places, mix(mixed[places] + np.uint64(n))


def _groups(batch: pa.RecordBatch) -> Iterator[tuple[Words, list[str]]]:
    """Words and languages of whole rows of a batch (lang, text)."""
    lang = pc.fill_null(batch.column(0), "und").to_pylist()
    for group in split_words(batch.column(1), word=_WORD, piece=TEXT):
        yield group, lang[group.first : group.first + len(group.counts)]


def _totals(keys: np.ndarray, counts: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Distinct keys in order and the sum of each one's counts."""
    if not len(keys):
        return keys, counts
    order = np.argsort(keys, kind="stable")
    keys, counts = keys[order], counts[order]
    first = np.flatnonzero(np.concatenate(([True], keys[1:] != keys[:-1])))
    return keys[first], np.add.reduceat(counts, first)


# --- first pass: Misra-Gries ------------------------------------------------------------------


class Summary:
    """Misra-Gries counters over 64-bit keys; ``taken`` bounds how much too low a count may be."""

    def __init__(self, capacity: int):
        self.capacity, self.taken = max(int(capacity), 1), 0
        self.keys, self.counts = np.zeros(0, dtype=np.uint64), np.zeros(0, dtype=np.int64)
        self.waiting: list[tuple[np.ndarray, np.ndarray]] = []
        self.n_waiting = 0

    def add(self, keys: np.ndarray, counts: np.ndarray) -> None:
        """Merge with exact counts (a summary from which nothing was taken)."""
        self.waiting.append((keys, counts))
        self.n_waiting += len(keys)
        if self.n_waiting >= self.capacity:
            self._settle()

    def merge(self, other: "Summary") -> None:
        other._settle()
        self.taken += other.taken
        self.add(other.keys, other.counts)

    def _settle(self) -> None:
        if not self.waiting:
            return
        keys = np.concatenate([self.keys, *(k for k, _ in self.waiting)])
        counts = np.concatenate([self.counts, *(c.astype(np.int64) for _, c in self.waiting)])
        self.waiting, self.n_waiting = [], 0
        self.keys, self.counts = _totals(keys, counts)
        if len(self.keys) > self.capacity:
            at = len(self.keys) - self.capacity - 1
            least = int(np.partition(self.counts, at)[at])  # the largest count outside the capacity
            self.taken += least
            kept = self.counts > least
            self.keys, self.counts = self.keys[kept], self.counts[kept] - least

    def frequent(self, threshold: int) -> np.ndarray:
        """Keys that may have ``threshold`` or more; every one that has them is among these."""
        self._settle()
        return self.keys[self.counts + self.taken >= threshold]


_RUNS = "part bigint, mass bigint, keys binary, counts binary"


def _hand_on(keys: np.ndarray, counts: np.ndarray, bits: int) -> Iterator[pa.RecordBatch]:
    """Sorted (fingerprint, count) as one row a part: 32 bits of the fingerprint behind the part's."""
    part = (keys >> np.uint64(64 - bits)).astype(np.int64)
    rest = ((keys >> np.uint64(32 - bits)) & np.uint64(0xFFFFFFFF)).astype(np.uint32)
    at = np.flatnonzero(np.concatenate(([True], part[1:] != part[:-1])))
    ends = np.append(at[1:], len(part))
    columns = [
        pa.array(part[at]), pa.array(np.add.reduceat(counts, at)),
        pa.array([_pack(np.diff(rest[a:b], prepend=np.uint32(0))) for a, b in zip(at, ends)], pa.binary()),
        pa.array([_pack(counts[a:b].astype(np.uint32)) if counts[a:b].max() > 255 else counts[a:b].astype(np.uint8).tobytes() for a, b in zip(at, ends)], pa.binary()),
    ]
    yield pa.RecordBatch.from_arrays(columns, ["part", "mass", "keys", "counts"])


def _pack(values: np.ndarray) -> bytes:
    """32-bit values with their lowest bytes first, then the next ones: steps between sorted keys and
    small counts leave runs of zeros that Spark's own compression takes away."""
    return values.view(np.uint8).reshape(-1, 4).T.tobytes()


def _unpack(data: bytes) -> np.ndarray:
    return np.ascontiguousarray(np.frombuffer(data, np.uint8).reshape(4, -1).T).view(np.uint32).ravel()


def _open(keys: bytes, counts: bytes) -> tuple[np.ndarray, np.ndarray]:
    sizes = np.frombuffer(counts, np.uint8) if 4 * len(counts) == len(keys) else _unpack(counts)
    return np.cumsum(_unpack(keys), dtype=np.uint32).astype(np.uint64), sizes.astype(np.int64)


def runs(rows: DataFrame, bits: int, careful: bool = False) -> DataFrame:
    """(part, mass, keys, counts): the n-grams of rows (lang, text), counted in runs of ``RUN``."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, size = [], 0
        for batch in batches:
            for group, lang in _groups(batch):
                for _, _, marks in ngrams(word_ids(group, lang, careful), pieces(group)):
                    held.append(marks)
                    size += len(marks)
                if size >= RUN:
                    yield from _hand_on(*np.unique(np.concatenate(held), return_counts=True), bits)
                    held, size = [], 0
        if size:
            yield from _hand_on(*np.unique(np.concatenate(held), return_counts=True), bits)

    return rows.mapInArrow(run, _RUNS)


def _bits_of(keys: np.ndarray, slots: int) -> np.ndarray:
    """Slot of a fingerprint's 32 bits in a part's stretch of the map."""
    return (keys * np.uint64(slots)) >> np.uint64(32)


def survivors(found: DataFrame, bits: int, threshold: int, slots: int, slack: float = SLACK) -> DataFrame:
    """(part, survivors, mass, taken, map): each part's summary as its stretch of ``slots`` bits."""

    def summarise(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        part, mass, summary = None, 0, None

        def close() -> pa.RecordBatch:
            kept = summary.frequent(threshold)
            stretch = np.zeros(slots, dtype=bool)
            stretch[_bits_of(kept, slots).astype(np.int64)] = True
            row = [part, len(kept), mass, summary.taken, np.packbits(stretch, bitorder="little").tobytes()]
            types = [pa.int64()] * 4 + [pa.binary()]
            return pa.RecordBatch.from_arrays([pa.array([v], t) for v, t in zip(row, types)], ["part", "survivors", "mass", "taken", "map"])

        for batch in batches:
            of_part, total = (batch.column(k).to_numpy() for k in (0, 1))
            for k in range(batch.num_rows):
                if of_part[k] != part:
                    if part is not None:
                        yield close()
                    # The part's mass comes first (see below), so the capacity is known.
                    part, mass = int(of_part[k]), int(total[k])
                    summary = Summary(slack * mass / threshold + 1)
                else:
                    summary.add(*_open(batch.column(2)[k].as_py(), batch.column(3)[k].as_py()))
        if part is not None:
            yield close()

    masses = found.groupBy("part").agg(F.sum("mass").alias("mass"))
    first = masses.select("part", "mass", F.lit(None).cast("binary").alias("keys"), F.lit(None).cast("binary").alias("counts"))
    both = first.withColumn("turn", F.lit(0)).unionByName(found.withColumn("turn", F.lit(1)))
    dealt = both.repartition(1 << min(bits, 14), "part").sortWithinPartitions("part", "turn")
    return dealt.select("part", "mass", "keys", "counts").mapInArrow(summarise, "part bigint, survivors bigint, mass bigint, taken bigint, map binary")


# --- second pass: exact counts ----------------------------------------------------------------

_COUNTS = "w1 bigint, w2 bigint, w3 bigint, lang string, word string, n bigint"


def _texts(group: Words, places: np.ndarray) -> pa.Array:
    """The words at ``places`` as strings."""
    starts, sizes = group.starts[places], (group.ends - group.starts)[places]
    offsets = np.concatenate(([0], np.cumsum(sizes))).astype(np.int32)
    at = np.repeat(starts - offsets[:-1], sizes) + np.arange(offsets[-1])
    return pa.StringArray.from_buffers(len(places), pa.py_buffer(offsets), pa.py_buffer(group.low[at].tobytes()))


def _rows(w: list[np.ndarray], lang: pa.Array | None, word: pa.Array | None, n: np.ndarray) -> pa.RecordBatch:
    size = len(n)
    ids = [pa.array(x.view(np.int64)) if x is not None else pa.nulls(size, pa.int64()) for x in w]
    text = [x if x is not None else pa.nulls(size, pa.string()) for x in (lang, word)]
    return pa.RecordBatch.from_arrays([*ids, *text, pa.array(n.astype(np.int64))], ["w1", "w2", "w3", "lang", "word", "n"])


def exact_counts(rows: DataFrame, shared, bits: int, slots: int, careful: bool = False) -> DataFrame:
    """(w1, w2, w3, lang, word, n) of every n-gram whose bit is set; of single words with their
    language and text. Rows without w1 hold a language's number of words."""

    def known(marks: np.ndarray) -> np.ndarray:
        part = marks >> np.uint64(64 - bits)
        bit = part * np.uint64(slots) + _bits_of((marks >> np.uint64(32 - bits)) & np.uint64(0xFFFFFFFF), slots)
        return (shared.value[(bit >> np.uint64(3)).astype(np.int64)] >> (bit & np.uint64(7)).astype(np.uint8)) & 1 > 0

    def hand_on(words: list[pa.Table], held: list[list[np.ndarray]]) -> Iterator[pa.RecordBatch]:
        if words:
            once = pa.concat_tables(words).group_by(["w1", "lang", "word"], use_threads=False).aggregate([("n", "sum")])
            for part in once.select(["w1", "lang", "word", "n_sum"]).to_batches(max_chunksize=HANDED):
                none = pa.nulls(part.num_rows, pa.int64())
                yield pa.RecordBatch.from_arrays([part.column(0), none, none, *part.columns[1:]], ["w1", "w2", "w3", "lang", "word", "n"])
        for n, columns in enumerate(held, start=2):
            if not columns:
                continue
            marks, *w = (np.concatenate(c) for c in zip(*columns))
            order = np.argsort(marks, kind="stable")
            w = [x[order] for x in w]
            new = np.ones(len(order), dtype=bool)
            new[1:] = np.any([x[1:] != x[:-1] for x in w], axis=0)
            at = np.flatnonzero(new)
            sizes = np.diff(np.append(at, len(order)))
            for lo in range(0, len(at), HANDED):
                part = slice(lo, lo + HANDED)
                yield _rows([*(x[at[part]] for x in w), *[None] * (LONGEST - n)], None, None, sizes[part])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        words, held, size, totals = [], [[] for _ in range(LONGEST - 1)], 0, {}
        for batch in batches:
            for group, lang in _groups(batch):
                ids, piece = word_ids(group, lang, careful), pieces(group)
                for x, k in zip(lang, group.counts.tolist()):
                    totals[x] = totals.get(x, 0) + k
                for n, places, marks in ngrams(ids, piece):
                    kept = known(marks)
                    places, marks = places[kept], marks[kept]
                    size += len(places)
                    if n > 1:
                        held[n - 2].append([marks, *(ids[places + k] for k in range(n))])
                        continue
                    # A word counts under its own text, so two words with one id stay apart.
                    row = np.repeat(np.arange(len(lang)), group.counts)[places]
                    langs = pa.array(lang, pa.string()).take(pa.array(row))
                    table = pa.table({"w1": pa.array(ids[places].view(np.int64)), "lang": langs, "word": _texts(group, places)})
                    words.append(table.group_by(["w1", "lang", "word"], use_threads=False).aggregate([([], "count_all")]).rename_columns(["w1", "lang", "word", "n"]))
                if size >= COUNTED:
                    yield from hand_on(words, held)
                    words, held, size = [], [[] for _ in range(LONGEST - 1)], 0
        yield from hand_on(words, held)
        if totals:
            yield _rows([None] * 3, pa.array(list(totals), pa.string()), None, np.array(list(totals.values()), dtype=np.int64))

    return rows.mapInArrow(run, _COUNTS).groupBy("w1", "w2", "w3", "lang", "word").agg(F.sum("n").alias("n"))


def frequent(docs: DataFrame, threshold: int = THRESHOLD, text_col: str = "text", lang_col: str = "lang", careful: bool = False) -> DataFrame:
    """(w1, w2, w3, lang, word, n) of the n-grams that occur ``threshold`` times, from a written table.

    Both passes are jobs of their own over the whole texts; what the first one finds is written
    before it is summarised.
    """
    spark, root = docs.sparkSession, new_work_dir(docs.sparkSession, "collocations")
    rows = docs.select(F.coalesce(F.col(lang_col).cast("string"), F.lit("und")).alias("lang"), F.col(text_col).alias("text"))
    size = rows.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    bits = min(max(LEAST_PARTS, int(size // PART_BYTES).bit_length()), MOST_PARTS)
    slots = max(MAP_BITS >> bits, 8)
    small = {"parquet.block.size": str(ROW_GROUP), "parquet.enable.dictionary": "false"}
    runs(rows, bits, careful).write.options(**small).parquet(f"{root}/runs")
    survivors(spark.read.schema(_RUNS).parquet(f"{root}/runs"), bits, threshold, slots).write.options(**small).parquet(f"{root}/map")
    stretches = spark.read.schema("part bigint, taken bigint, map binary").parquet(f"{root}/map").toArrow()
    bitmap = np.zeros((1 << bits, slots // 8), dtype=np.uint8)
    for part, taken, stretch in zip(*(stretches.column(k).to_pylist() for k in range(3))):
        if taken >= threshold:
            raise RuntimeError("a summary took as much as the threshold; its capacity is below mass / threshold")
        bitmap[part] = np.frombuffer(stretch, np.uint8)
    shared = spark.sparkContext.broadcast(bitmap.ravel())
    counts = exact_counts(rows, shared, bits, slots, careful)
    counts.where((F.col("n") >= threshold) | F.col("w1").isNull()).write.parquet(f"{root}/counts")
    shared.unpersist()
    counts = spark.read.schema(_COUNTS).parquet(f"{root}/counts")
    if not careful and counts.where("w1 IS NOT NULL AND w2 IS NULL").groupBy("w1").count().where("count > 1").limit(1).count():
        return frequent(docs, threshold, text_col, lang_col, careful=True)
    return counts


# --- scores -----------------------------------------------------------------------------------


def _attach(left: DataFrame, words: DataFrame, key: str) -> DataFrame:
    """Inner join with each word of the left side dealt to ``SALTS`` parts."""
    dealt = left.withColumn("_salt", F.pmod(F.xxhash64(*left.columns), F.lit(SALTS)).cast("int"))
    copies = words.withColumn("_salt", F.explode(F.sequence(F.lit(0), F.lit(SALTS - 1))))
    return dealt.join(copies, [key, "_salt"]).drop("_salt")


def _score(l: str, r: str) -> Column:  # noqa: E741
    """floor(1000000 a a / (l r)) in decimals of 38 digits."""
    whole = "CAST({} AS DECIMAL(19, 0))"
    a = whole.format("a")
    return F.expr(f"(CAST(1000000 AS DECIMAL(7, 0)) * {a} * {a}) DIV ({whole.format(l)} * {whole.format(r)})")


def phrases(counts: DataFrame, share: float = 0.5) -> DataFrame:
    """(lang, phrase, a, l, r, score) of the phrases of 2 and 3 words that no longer one explains."""
    words = counts.where("w1 IS NOT NULL AND w2 IS NULL").select(F.col("w1").alias("w"), "lang", "word", "n")
    named = lambda k, *more: words.select(F.col("w").alias(f"w{k}"), F.col("word").alias(f"word{k}"), F.col("n").alias(f"f{k}"), *more)
    pairs = counts.where("w2 IS NOT NULL AND w3 IS NULL").select("w1", "w2", F.col("n").alias("a"))
    pairs = _attach(_attach(pairs, named(1, "lang"), "w1"), named(2), "w2")
    triples = counts.where("w3 IS NOT NULL").select("w1", "w2", "w3", F.col("n").alias("a"))
    head = pairs.select("w1", "w2", "lang", "word1", "word2", "f1", F.col("a").alias("f12"))
    tail = pairs.select(F.col("w1").alias("w2"), F.col("w2").alias("w3"), F.col("word2").alias("word3"), F.col("f2").alias("f3"), F.col("a").alias("f23"))
    around = triples.select("w1", "w2", "a").unionByName(triples.select(F.col("w2").alias("w1"), F.col("w3").alias("w2"), "a"))
    longest = around.groupBy("w1", "w2").agg(F.max("a").alias("longer"))
    two = pairs.join(longest, ["w1", "w2"], "left").where(F.coalesce(F.col("longer"), F.lit(0)) < F.col("a") * F.lit(share))
    two = two.select("lang", F.concat_ws(" ", "word1", "word2").alias("phrase"), "a", F.col("f1").alias("l"), F.col("f2").alias("r"), _score("f1", "f2").alias("score"))
    three = triples.join(head, ["w1", "w2"]).join(tail, ["w2", "w3"])
    three = three.withColumns({"s1": _score("f1", "f23"), "s2": _score("f12", "f3")})
    first = F.col("s1") <= F.col("s2")
    three = three.select(
        "lang", F.concat_ws(" ", "word1", "word2", "word3").alias("phrase"), "a", F.when(first, F.col("f1")).otherwise(F.col("f12")).alias("l"),
        F.when(first, F.col("f23")).otherwise(F.col("f3")).alias("r"), F.least("s1", "s2").alias("score"),
    )
    return two.unionByName(three)


def collocations(docs: DataFrame, threshold: int = THRESHOLD, share: float = 0.5, best: int = 2000, text_col: str = "text", lang_col: str = "lang") -> DataFrame:
    """(lang, rank, phrase, a, l, r, n, score): each language's ``best`` phrases.

    ``a`` is the phrase's count, ``l`` and ``r`` those of the parts at its weakest cut, ``n`` the
    language's words. Candidates are ranked in parts first, so no task sorts a whole language.
    """
    counts = frequent(docs, threshold, text_col, lang_col)
    found = phrases(counts, share)
    parts = int(docs.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    order = [F.col("score").desc(), F.col("a").desc(), F.col("phrase").asc()]
    found = found.withColumn("_part", F.pmod(F.xxhash64("phrase"), F.lit(parts)))
    top = found.withColumn("rank", F.row_number().over(Window.partitionBy("lang", "_part").orderBy(*order))).where(F.col("rank") <= best)
    top = top.withColumn("rank", F.row_number().over(Window.partitionBy("lang").orderBy(*order)).cast("bigint")).where(F.col("rank") <= best)
    totals = counts.where("w1 IS NULL").select("lang", "n")
    return top.join(totals, "lang").select("lang", "rank", "phrase", "a", "l", "r", "n", "score")


def op11_collocations(spark: SparkSession, sf_dir: str) -> DataFrame:
    return collocations(spark.read.parquet(f"{sf_dir.rstrip('/')}/documents.parquet").select("lang", "text"))
