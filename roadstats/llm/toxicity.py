"""Toxicity by class-conditional Kneser-Ney models over characters.

Text is lower-cased (A-Z) and every run of separators becomes one space; the events are byte
5-grams: a byte given the four before it. The toxic and the ordinary class each have a
Kneser-Ney distribution over the next byte, from 5-grams down to 3-grams, that ends in counts
the classes share:

    P_class(w | h) = (max(c - D, 0) + (S + D t) P_class(w | shorter h)) / (S + c(h))

with c the class's count of 5-grams, or below those its continuation count (how many different
bytes come before), c(h) the sum and t the number of different bytes after h. Under the 3-grams
stands P_shared, the same estimate from both classes' counts over a uniform one. ``S`` counts of
backoff mass and the discount ``D`` make a rare expression say little either way. The score is a
document's log-likelihood ratio divided by the square root of its length, put through a logistic
curve.

Counts cover every labelled row of folds 0 and 1, gathered by a distributed aggregation keyed by
the 5-gram; the logistic curve is fitted on a histogram of all labelled rows of fold 3. Fold 2
(see ``folds.fold``) is held out. Ratios and backoff weights are written under their exact keys
(n-gram and order), one row each, so the table grows with the input. Up to ``MOST_KEYS`` rows it is
broadcast in key order; beyond that the texts' distinct n-grams are joined with it by key, those in
many texts by broadcast (``joined_ratios``). Both ways give the same ratios.

Defined results: null and empty texts have ratio 0 and so the curve's value there. Repeated rows
score alike; in training each counts. Without labels of both classes every score is 0. Labels
without a document and null labels are ignored; of several labels of one id the largest holds.
Columns other than id and text are never read for a score and kept by ``without_toxic``.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from roadstats.llm.folds import fold, free_name, one_label
from roadstats.llm.words import LOWER, WORD, text_bytes
from roadstats.session import new_work_dir

ORDER, LOWEST = 5, 3
DISCOUNT = 0.75
BACKOFF_MASS = 5.0
THRESHOLD = 0.3
#: Most labels that are broadcast to the texts (about 32 MB); more are joined by shuffle.
MOST_BROADCAST = 1_000_000
#: Most ratios and backoff weights that are broadcast to the texts (64 MB); more are joined by shuffle.
MOST_KEYS = 1 << 22
#: In that join an n-gram with more than one of so many (text, n-gram) pairs is broadcast: fewer than
#: so many n-grams have that many.
HOT_SHARE = 100_000
#: Histogram of ratios for the logistic curve: bins a unit, and units on either side of 0.
BINS, SPAN = 256, 16
_FOLDED = np.where(WORD, LOWER, 32).astype(np.uint8)
_GROUP = 1 << 20


def stream(column: pa.Array) -> Iterator[tuple[int, np.ndarray, np.ndarray]]:
    """(first row, 5-grams, number of them by row) for groups of whole rows.

    A 5-gram is its bytes as an integer, the newest lowest; before a row come spaces.
    """
    raw, offs = text_bytes(column)
    rows, row = len(offs) - 1, 0
    while row < rows:
        last = max(row + 1, int(np.searchsorted(offs, offs[row] + _GROUP, side="right")) - 1)
        text = _FOLDED[raw[offs[row] : offs[last]]]
        space = text == 32
        again = np.zeros(len(text), dtype=bool)
        again[1:] = space[:-1]
        starts = offs[row:last] - offs[row]
        again[starts[starts < len(text)]] = True  # a row begins after a space
        kept = ~(space & again)
        counts = np.diff(np.concatenate(([0], np.cumsum(kept)))[offs[row : last + 1] - offs[row]])
        yield row, _grams(text[kept], counts), counts
        row = last


def _grams(text: np.ndarray, counts: np.ndarray) -> np.ndarray:
    grams = text.astype(np.uint64)
    begins = np.concatenate(([0], np.cumsum(counts)))[:-1][counts > 0]
    for back in range(1, ORDER):
        before = np.full(len(text), 32, dtype=np.uint64)
        before[back:] = text[:-back] if back <= len(text) else 32
        for n in range(back):  # the first bytes of a row look back over its start
            at = begins + n
            before[at[(at < len(text)) & (n < counts[counts > 0])]] = 32
        grams |= before << np.uint64(8 * back)
    return grams


def count_grams(rows: DataFrame) -> DataFrame:
    """(gram, c0, c1) over rows (label 0/1, text)."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            label = np.asarray(batch.column(0)).astype(bool)
            for first, grams, counts in stream(batch.column(1)):
                keys = grams << np.uint64(1) | np.repeat(label[first : first + len(counts)], counts).astype(np.uint64)
                keys, n = np.unique(keys, return_counts=True)
                toxic = (keys & np.uint64(1)).astype(bool)
                columns = [(keys >> np.uint64(1)).view(np.int64), np.where(toxic, 0, n), np.where(toxic, n, 0)]
                yield pa.RecordBatch.from_arrays([pa.array(c.astype(np.int64)) for c in columns], ["gram", "c0", "c1"])

    found = rows.select("label", "text").mapInArrow(run, "gram bigint, c0 bigint, c1 bigint")
    return found.groupBy("gram").agg(F.sum("c0").alias("c0"), F.sum("c1").alias("c1"))


def ratios(grams: DataFrame, root: str) -> DataFrame:
    """(key, ratio): log P_toxic - log P_ordinary of each n-gram of the orders 5 to 3, and
    of the weight that each context gives to the order below (see ``seen_key``, ``rest_key``).

    Each order's counts and probabilities are written under ``root`` once and read by the next step,
    so every step is a plan of two joins at most.
    """
    read = grams.sparkSession.read.parquet
    d, s = F.lit(DISCOUNT), F.lit(BACKOFF_MASS)
    counts = {ORDER: grams}
    for n in range(ORDER - 1, LOWEST - 1, -1):
        shorter = F.col("gram").bitwiseAND(F.lit((1 << 8 * n) - 1).cast("bigint"))
        kinds = [F.sum((F.col(c) > 0).cast("bigint")).alias(c) for c in ("c0", "c1")]
        counts[n + 1].groupBy(shorter.alias("gram")).agg(*kinds).write.parquet(f"{root}/counts-{n}")
        counts[n] = read(f"{root}/counts-{n}")
    for n in range(LOWEST, ORDER + 1):
        rows = counts[n].withColumn("ctx", F.shiftright("gram", 8))
        sums = [F.sum(c).alias(c.replace("c", "n")) for c in ("c0", "c1")]
        kinds = [F.sum((F.col(c) > 0).cast("bigint")).alias(c.replace("c", "t")) for c in ("c0", "c1")]
        rows.groupBy("ctx").agg(*sums, *kinds, F.count("*").alias("t")).write.parquet(f"{root}/contexts-{n}")
        contexts = read(f"{root}/contexts-{n}")
        rows = rows.join(contexts, "ctx")
        pool, total = F.col("c0") + F.col("c1"), F.col("n0") + F.col("n1")
        if n == LOWEST:
            shared = (F.greatest(pool - d, F.lit(0.0)) + d * F.col("t") / 64) / total
            rows = rows.withColumns({"q0": shared, "q1": shared})
        else:
            below = read(f"{root}/lower-{n - 1}").select(F.col("gram").alias("sub"), F.col("p0").alias("q0"), F.col("p1").alias("q1"))
            sub = F.col("gram").bitwiseAND(F.lit((1 << 8 * (n - 1)) - 1).cast("bigint"))
            rows = rows.withColumn("sub", sub).join(below, "sub")
        rest = lambda k: (s + d * F.col(f"t{k}")) / (s + F.col(f"n{k}"))
        p = lambda k: F.greatest(F.col(f"c{k}") - d, F.lit(0.0)) / (s + F.col(f"n{k}")) + rest(k) * F.col(f"q{k}")
        rows.select("gram", p(0).alias("p0"), p(1).alias("p1")).write.parquet(f"{root}/lower-{n}")
        seen = read(f"{root}/lower-{n}").select(seen_key(F.col("gram"), n).alias("key"), F.log(F.col("p1") / F.col("p0")).alias("ratio"))
        seen.write.parquet(f"{root}/ratios/part=seen-{n}")
        contexts.select(rest_key(F.col("ctx"), n).alias("key"), F.log(rest(1) / rest(0)).alias("ratio")).write.parquet(f"{root}/ratios/part=rest-{n}")
    return read(f"{root}/ratios").select("key", "ratio")


def seen_key(gram, order: int):
    """Key of an n-gram: the gram and its order (Column or numpy)."""
    return gram * 16 + order if isinstance(gram, Column) else gram << np.uint64(4) | np.uint64(order)


def rest_key(context, order: int):
    """Key of the weight that a context leaves to the order below."""
    return context * 16 + (order + 8) if isinstance(context, Column) else context << np.uint64(4) | np.uint64(order + 8)


def slot_table(found: DataFrame) -> tuple[np.ndarray, np.ndarray]:
    """Keys in order and their ratios; the last key is above all others and has none."""
    rows = found.select("key", "ratio").toArrow()
    keys = np.asarray(rows.column("key")).astype(np.uint64)
    order = np.argsort(keys)
    ratio = np.asarray(rows.column("ratio")).astype(np.float64)
    return np.append(keys[order], np.uint64(2**64 - 1)), np.append(ratio[order], np.nan)


def _look_up(keys: np.ndarray, table: tuple[np.ndarray, np.ndarray]) -> np.ndarray:
    """Ratio of each key, NaN where it was not counted."""
    known, ratio = table
    at = np.searchsorted(known, keys)
    return np.where(known[at] == keys, ratio[at], np.nan)


def _gram_ratios(grams: np.ndarray, table: tuple[np.ndarray, np.ndarray], order: int) -> np.ndarray:
    """Ratio of each n-gram; an unseen one has its context's weight and the shorter gram's ratio."""
    ratio = _look_up(seen_key(grams, order), table)
    new = np.flatnonzero(np.isnan(ratio))
    if len(new):
        rest = np.nan_to_num(_look_up(rest_key(grams[new] >> np.uint64(8), order), table))
        shorter = grams[new] & np.uint64((1 << 8 * (order - 1)) - 1)
        ratio[new] = rest + _gram_ratios(shorter, table, order - 1) if order > LOWEST else rest
    return ratio


def text_ratios(column: pa.Array, table: tuple[np.ndarray, np.ndarray]) -> np.ndarray:
    """Log-likelihood ratio of each row over the square root of its length."""
    out = np.zeros(len(column))
    for first, grams, counts in stream(column):
        distinct, place = np.unique(grams, return_inverse=True)
        ratio = _gram_ratios(distinct, table, ORDER)[place]
        sums = np.concatenate(([0.0], np.cumsum(ratio, dtype=np.float64)))
        at = np.concatenate(([0], np.cumsum(counts)))
        out[first : first + len(counts)] = (sums[at[1:]] - sums[at[:-1]]) / np.sqrt(np.maximum(counts, 1))
    return out


def text_grams(rows: DataFrame) -> DataFrame:
    """(text_key, gram, n, size) over rows (text_key, text): each text's distinct 5-grams, how often
    each occurs in it and how many it has."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for first, grams, counts in stream(batch.column(1)):
                row = np.repeat(np.arange(len(counts), dtype=np.uint64), counts)
                pairs, n = np.unique(row << np.uint64(8 * ORDER) | grams, return_counts=True)
                row = (pairs >> np.uint64(8 * ORDER)).astype(np.int64)
                gram = (pairs & np.uint64((1 << 8 * ORDER) - 1)).view(np.int64)
                columns = [batch.column(0).take(pa.array(first + row)), *(pa.array(c.astype(np.int64)) for c in (gram, n, counts[row]))]
                yield pa.RecordBatch.from_arrays(columns, ["text_key", "gram", "n", "size"])

    return rows.select("text_key", "text").mapInArrow(run, "text_key string, gram bigint, n bigint, size bigint")


def resolved(grams: DataFrame, found: DataFrame) -> DataFrame:
    """``grams`` with the ratio of each 5-gram, by joins what ``_gram_ratios`` looks up."""
    rows = grams.withColumns({"ratio": F.lit(0.0), "open": F.lit(True)})
    for n in range(ORDER, LOWEST - 1, -1):
        kind = lambda tag, key, value: found.where(F.col("key").bitwiseAND(F.lit(15)) == tag).select(F.shiftright("key", 4).alias(key), F.col("ratio").alias(value))
        shorter = F.col("gram").bitwiseAND(F.lit((1 << 8 * n) - 1).cast("bigint"))
        rows = rows.withColumns({"shorter": shorter, "ctx": F.shiftright(shorter, 8)})
        rests = kind(n + 8, "ctx", "rest")
        # Two bytes make few contexts, but very many n-grams share one.
        rows = rows.join(kind(n, "shorter", "seen"), "shorter", "left").join(F.broadcast(rests) if n == LOWEST else rests, "ctx", "left")
        step = F.when(F.col("open"), F.coalesce("seen", "rest", F.lit(0.0))).otherwise(0.0)
        rows = rows.select(*grams.columns, (F.col("ratio") + step).alias("ratio"), (F.col("open") & F.col("seen").isNull()).alias("open"))
    return rows.drop("open")


def joined_ratios(docs: DataFrame, text_col: str, name: str, found: DataFrame) -> DataFrame:
    """``docs`` and the ratio of each row's text as ``name``, with the texts' n-grams joined to
    ``found`` by key. Texts are told apart by their SHA-256; repeated ones have one ratio."""
    root, key = new_work_dir(docs.sparkSession, "toxicity-pairs"), free_name(docs, "_text_key")
    read = docs.sparkSession.read.parquet
    digest = F.sha2(F.coalesce(F.col(text_col), F.lit("")), 256)
    text_grams(docs.select(digest.alias("text_key"), F.col(text_col).alias("text"))).write.parquet(f"{root}/pairs")
    pairs = read(f"{root}/pairs")
    pairs.groupBy("gram").agg(F.count("*").alias("texts")).write.parquet(f"{root}/grams")
    resolved(read(f"{root}/grams"), found).write.parquet(f"{root}/ratios")
    ratio = read(f"{root}/ratios")
    most = (ratio.agg(F.sum("texts")).first()[0] or 0) / HOT_SHARE
    hot = ratio.where(F.col("texts") > most).select("gram", "ratio")
    cold = ratio.where(F.col("texts") <= most).select("gram", "ratio")
    far = pairs.join(F.broadcast(hot.select("gram")), "gram", "left_anti").join(cold, "gram")
    both = pairs.join(F.broadcast(hot), "gram").unionByName(far)
    # The mean is the same however often a text is repeated.
    mean = F.sum(F.col("n") * F.col("ratio")) / F.sum("n")
    by_text = both.groupBy(F.col("text_key").alias(key)).agg((mean * F.sqrt(F.max("size"))).alias(name))
    rows = docs.withColumn(key, digest).join(by_text, key, "left")
    return rows.select(*docs.columns, F.coalesce(F.col(name), F.lit(0.0)).alias(name))


class Model:
    """Fitted ratios and logistic curve: probability of toxic = sigmoid(slope x ratio + offset).

    ``found`` has the ratios by key; ``shared`` has them broadcast where they are few. Without
    ``found`` every ratio is 0.
    """

    def __init__(self, found: DataFrame | None):
        self.found, self.shared, self.slope, self.offset = found, None, 0.0, 0.0
        if found is not None and found.count() <= MOST_KEYS:
            self.shared = found.sparkSession.sparkContext.broadcast(slot_table(found))

    def with_ratio(self, docs: DataFrame, text_col: str, name: str) -> DataFrame:
        """``docs`` and the ratio of each row's text as ``name`` (a free name)."""
        if self.found is None:
            return docs.select("*", F.lit(0.0).alias(name))
        if self.shared is None:
            return joined_ratios(docs, text_col, name, self.found)
        shared = self.shared

        @F.arrow_udf("double")
        def run(column: pa.Array) -> pa.Array:
            return pa.array(text_ratios(column, shared.value))

        return docs.select("*", run(F.col(text_col)).alias(name))

    def probability(self, ratio: Column) -> Column:
        if self.found is None:
            return F.lit(0.0)
        return 1.0 / (1.0 + F.exp(-(F.lit(self.slope) * ratio + F.lit(self.offset))))


def fit_curve(bins: list[tuple[float, int, int]], steps: int = 50) -> tuple[float, float]:
    """Logistic curve through (ratio, label, count) bins by Newton's method."""
    x, y, n = (np.array(c, dtype=np.float64) for c in zip(*bins))
    design, w = np.stack([x, np.ones_like(x)], axis=1), np.zeros(2)
    for _ in range(steps):
        p = 1 / (1 + np.exp(-np.clip(design @ w, -30, 30)))
        slope = design.T @ (n * (y - p)) - np.array([1e-3, 0]) * w
        curve = (design * (n * p * (1 - p))[:, None]).T @ design + np.diag([1e-3, 1e-6])
        move = np.linalg.solve(curve, slope)
        w = w + np.clip(move, -5, 5)
        if np.abs(move).max() < 1e-9:
            break
    return float(w[0]), float(w[1])


def fit(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text", label_col: str = "toxic") -> Model:
    """Fit both class models and the curve from the labelled rows outside fold 2."""
    spark = docs.sparkSession
    known = one_label(labels, label_col, id_col).withColumn("label", (F.col("label") > 0).cast("int"))
    rows = docs.select(F.col(id_col).cast("bigint").alias("doc_id"), F.col(text_col).alias("text")).withColumn("fold", fold())
    root = new_work_dir(spark, "toxicity")
    known.write.parquet(f"{root}/labels")
    known = spark.read.parquet(f"{root}/labels")
    few = known.count() <= MOST_BROADCAST
    counted = rows.where("fold IN (0, 1)").join(F.broadcast(known) if few else known, "doc_id")
    count_grams(counted).write.parquet(f"{root}/grams")
    grams = spark.read.parquet(f"{root}/grams")
    seen = grams.agg(F.sum("c0"), F.sum("c1")).first()
    if not seen[0] or not seen[1]:
        return Model(None)
    model = Model(ratios(grams, root))
    # Of fold 3 only ids and ratios are joined, not texts.
    held = model.with_ratio(rows.where("fold = 3"), "text", "x").select("doc_id", "x").join(known, "doc_id")
    bin_no = F.floor(F.greatest(F.lit(-float(SPAN)), F.least(F.lit(float(SPAN)), F.col("x"))) * BINS)
    bins = held.groupBy(bin_no.alias("bin"), "label").count().collect()
    if len({r["label"] for r in bins}) < 2:
        return Model(None)
    slope, model.offset = fit_curve([((r["bin"] + 0.5) / BINS, r["label"], r["count"]) for r in bins])
    model.slope = max(slope, 0.0)
    return model


def score(docs: DataFrame, model: Model, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(doc_id, held_out, score, predicted) of every row."""
    rows = docs.select(F.col(id_col).cast("bigint").alias("doc_id"), F.col(text_col).alias("text"))
    rows = model.with_ratio(rows, "text", "ratio")
    scored = rows.select("doc_id", (fold() == 2).alias("held_out"), model.probability(F.col("ratio")).alias("score"))
    return scored.withColumn("predicted", (F.col("score") >= THRESHOLD).cast("int"))


def without_toxic(docs: DataFrame, labels: DataFrame, threshold: float = THRESHOLD) -> DataFrame:
    """The rows of ``docs`` (all columns) that score below ``threshold``."""
    model = fit(docs, labels)
    ratio = free_name(docs, "_ratio")
    scored = model.with_ratio(docs, "text", ratio)
    return scored.where(model.probability(F.col(ratio)) < threshold).select(*docs.columns)


def op7_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    root = sf_dir.rstrip("/")
    docs = spark.read.parquet(f"{root}/documents.parquet").select("doc_id", "text")
    labels = spark.read.parquet(f"{root}/labels.parquet").select("doc_id", "toxic")
    return score(docs, fit(docs, labels))
