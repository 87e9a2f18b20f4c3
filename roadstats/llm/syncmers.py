"""Document fingerprints from closed syncmers, as Spark expressions only.

A text's symbols are words (runs of other than white space; CJK characters count as words of
their own, since such text has no spaces). A k-mer of ``K`` words is a closed syncmer if its
smallest inner run of ``S`` words, by hash, is the first or the last one. The choice looks at
nothing outside the k-mer, so an edit changes only the anchors it touches: equal stretches keep
equal anchors, wherever they move.

``anchors`` gives every syncmer of a text as one bigint, hash above position, and ``sketch`` puts
all of them in hash order: the fingerprint grows with the text. ``likeness`` is the share of
distinct anchors the texts have in common; ``matches`` gives the anchors two fingerprints share
with both positions, for positional matching (a repeated anchor with each of its positions);
``last_match`` is the last such position in the first text.

``next_texts`` puts beside each row the text of the next doc_id without a one-task sort: doc_id
ranges from approximate percentiles hold about ``RANGE_BYTES`` each, and the first rows of every
range are repeated in the range before it. Columns made from the rows (the fingerprint) are made
after the rows were dealt out, so that only texts are shuffled.

Defined results: a null or empty text has no anchor and an empty fingerprint; a shorter text
than a k-mer has its whole sequence as its one anchor. Two empty fingerprints are alike (1), an
empty and another one not (0). Rows with a null doc_id come first in doc_id order; rows that
repeat a doc_id are ordered by text hash, and each such row gets a result. An empty table gives
no rows. Extra columns are ignored. Positions beyond ``MAX_POSITION`` are held as that value.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

K, S = 4, 2
MAX_POSITION = (1 << 24) - 1
HASH_BITS = 39
#: Text that one range of ids holds, about, and the most ranges.
RANGE_BYTES = 1 << 20
MAX_RANGES = 1 << 16
CJK = r"([぀-ヿ㐀-䶿一-鿿가-힯])"


def _let(value: Column, body: Callable[[Column], Column]) -> Column:
    """``body`` of a value that is computed once (a lambda variable, not a repeated expression)."""
    return F.transform(F.array(value), body)[0]


def _span(last: Column) -> Column:
    """0 .. last, empty if last is negative."""
    return F.when(last >= 0, F.sequence(F.lit(0), last)).otherwise(F.array().cast("array<int>"))


def anchors(text: Column, k: int = K, s: int = S) -> Column:
    """Every closed syncmer in order: array<bigint> of hash << 24 | position."""
    if not 0 < s < k:
        raise ValueError("an inner run is shorter than its k-mer")
    inner = k - s  # offset of the last inner run

    def packed(value: Column, position: Column) -> Column:
        part = F.shiftrightunsigned(value, 64 - HASH_BITS)
        at = F.least(position, F.lit(MAX_POSITION)).cast("bigint")
        return F.shiftleft(part, 24).bitwiseOR(at)

    def of_runs(words: Column, runs: Column) -> Column:
        edge = lambda i: F.least(runs[i], runs[i + inner])
        middle = lambda i: F.least(*[runs[i + j] for j in range(1, inner)]) if inner > 2 else runs[i + 1]
        closed = (lambda i: edge(i) <= middle(i)) if inner > 1 else (lambda i: F.lit(True))
        chosen = F.filter(_span(F.size(words) - k), closed)
        return F.transform(chosen, lambda i: packed(F.xxhash64(*[words[i + j] for j in range(k)]), i))

    def of_words(words: Column) -> Column:
        runs = F.transform(_span(F.size(words) - s), lambda i: F.xxhash64(*[words[i + j] for j in range(s)]))
        whole = F.array(packed(F.xxhash64(F.to_json(words)), F.lit(0)))
        return (
            F.when(F.size(words) == 0, F.array().cast("array<bigint>"))
            .when(F.size(words) < k, whole)
            .otherwise(_let(runs, lambda r: of_runs(words, r)))
        )

    spaced = F.regexp_replace(F.coalesce(text, F.lit("")), CJK, " $1 ")
    symbols = F.array_remove(F.split(spaced, r"\s+"), "")
    return _let(F.transform(symbols, lambda w: F.xxhash64(w)), of_words)


def _hash(anchor: Column) -> Column:
    return F.shiftright(anchor, 24)


def sketch(found: Column) -> Column:
    """All anchors, in hash order."""
    return F.sort_array(found)


def as_text(fingerprint: Column) -> Column:
    """Sixteen hex digits an anchor (hash and position)."""
    return F.lower(F.array_join(F.transform(fingerprint, lambda a: F.lpad(F.hex(a), 16, "0")), ""))


def likeness(a: Column, b: Column) -> Column:
    """Share of distinct anchors that two texts have in common, 0 to 1 (Dice: twice the shared
    ones over the sum of both)."""
    hashes = lambda f: F.array_distinct(F.transform(f, _hash))

    def of(x: Column, y: Column) -> Column:
        both = F.size(x) + F.size(y)
        return F.when(both == 0, F.lit(1.0)).otherwise(2 * F.size(F.array_intersect(x, y)) / both)

    return _let(hashes(a), lambda x: _let(hashes(b), lambda y: of(x, y)))


def _merged(a: Column, b: Column) -> Column:
    """Anchors of both in one order: by hash, those of ``a`` before those of ``b``, by position."""
    side = lambda n: lambda x: F.shiftleft(_hash(x), 25).bitwiseOR(F.lit(n << 24).cast("bigint")).bitwiseOR(_place(x))
    return F.sort_array(F.concat(F.transform(a, side(0)), F.transform(b, side(1))))


def _place(anchor: Column) -> Column:
    return anchor.bitwiseAND(F.lit(MAX_POSITION).cast("bigint"))


def _group(merged: Column) -> Column:
    return F.shiftrightunsigned(merged, 25)


def _of_b(merged: Column) -> Column:
    return F.shiftright(merged, 24).bitwiseAND(F.lit(1).cast("bigint")) == 1


def matches(a: Column, b: Column) -> Column:
    """Anchors of both fingerprints, each pair of places: array<struct<hash, position in a, position in b>>."""
    row = lambda x, y: F.struct(_group(x).alias("hash"), _place(x).alias("a"), _place(y).alias("b"))

    def pairs(group: Column) -> Column:
        of_a, of_b = F.filter(group, lambda x: ~_of_b(x)), F.filter(group, _of_b)
        return _let(of_b, lambda ys: F.flatten(F.transform(of_a, lambda x: F.transform(ys, lambda y: row(x, y)))))

    def of(merged: Column) -> Column:
        begins = F.filter(_span(F.size(merged) - 1), lambda i: (i == 0) | (_group(F.get(merged, i - 1)) != _group(F.get(merged, i))))
        end = lambda f, n: F.coalesce(F.get(f, n + 1), F.size(merged))
        group = lambda f: F.transform(f, lambda at, n: pairs(F.slice(merged, at + 1, end(f, n) - at)))
        return F.flatten(_let(begins, group))

    return _let(_merged(a, b), of)


def last_match(a: Column, b: Column) -> Column:
    """Largest position in ``a`` of an anchor that ``b`` has too, null without one."""

    def of(merged: Column) -> Column:
        # The last anchor of a with some hash stands right before the first of b with it.
        def meets(x: Column, i: Column) -> Column:
            after = F.get(merged, i + 1)
            return ~_of_b(x) & _of_b(after) & (_group(x) == _group(after))

        return F.array_max(F.transform(F.filter(merged, meets), _place))

    return _let(_merged(a, b), of)


def next_texts(docs: DataFrame, kept: list[str], range_bytes: int = RANGE_BYTES, made: dict[str, Column] | None = None) -> DataFrame:
    """``docs`` (doc_id, text, ...) and the columns ``made`` from each row, with ``next_<name>`` of
    the row that follows in doc_id order, for each name in ``kept``; the last row is followed by
    the first."""
    size = docs.agg(F.sum(F.octet_length("text")).alias("bytes"), F.count("*").alias("rows")).first()
    ranges = max(1, min(MAX_RANGES, (size["bytes"] or 0) // range_bytes, size["rows"] // 2))
    wanted = [F.lit(n / ranges) for n in range(1, ranges)] or [F.lit(0.5)]
    least, cuts = docs.agg(F.min("doc_id"), F.percentile_approx("doc_id", F.array(*wanted), min(10 * ranges, 1_000_000))).first()
    cuts = sorted(set(cuts or ()) - {least}) if ranges > 1 else []
    # Range of an id: the number of cuts at or below it, found in two steps of about sqrt(n).
    step = max(1, int(len(cuts) ** 0.5))
    below = lambda values: F.size(F.filter(F.array(*map(F.lit, values)), lambda c: c <= F.col("doc_id"))) if values else F.lit(0)
    coarse = below(cuts[step - 1 :: step])
    blocks = F.array(*[F.array(*[F.lit(c).cast("bigint") for c in cuts[k : k + step]]) for k in range(0, len(cuts), step)] or [F.array().cast("array<bigint>")])
    block = F.coalesce(F.try_element_at(blocks, coarse + 1), F.array().cast("array<bigint>"))
    number = coarse * step + F.size(F.filter(block, lambda c: c <= F.col("doc_id")))
    rows = docs.withColumn("_range", F.coalesce(number, F.lit(0)).cast("int")).withColumn("_ahead", F.lit(False))
    # The first rows of each range also end the range before it.
    starts = F.col("doc_id").isin(cuts) if cuts else F.lit(False)
    ahead = rows.where(starts).withColumn("_range", F.col("_range") - 1).withColumn("_ahead", F.lit(True))
    first_id = F.col("doc_id").isNull() if docs.where("doc_id IS NULL").take(1) else F.col("doc_id") == F.lit(least)
    round_up = rows.where(first_id).withColumn("_range", F.lit(len(cuts))).withColumn("_ahead", F.lit(True))
    order = Window.partitionBy("_range").orderBy("_ahead", F.col("doc_id").asc_nulls_first(), F.xxhash64("text"))
    both = rows.unionByName(ahead).unionByName(round_up)
    if made:
        both = both.repartition("_range").withColumns(made)
    # The last range is followed by the round-up rows only; elsewhere "ahead" rows sort last too.
    for name in kept:
        both = both.withColumn(f"next_{name}", F.lead(name).over(order))
    return both.where(~F.col("_ahead")).drop("_range", "_ahead")


def edited(text: Column, after: Column) -> Column:
    """``text`` with its last floor(n / 2) characters replaced by the first as many of ``after``."""
    half = F.floor(F.char_length(text) / 2).cast("int")
    return F.concat(F.substring(text, F.lit(1), F.char_length(text) - half), F.substring(after, F.lit(1), half))


def op2_syncmers(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir.rstrip('/')}/documents.parquet")
    docs = docs.select(F.col("doc_id").cast("bigint").alias("doc_id"), F.coalesce("text", F.lit("")).alias("text"))
    rows = next_texts(docs, ["text", "fp"], made={"fp": sketch(anchors(F.col("text")))})
    rows = rows.withColumn("edit", edited(F.col("text"), F.col("next_text")))
    rows = rows.withColumn("edit_fp", sketch(anchors(F.col("edit"))))
    return rows.select(
        "doc_id",
        F.char_length("text").cast("bigint").alias("n_chars"),
        F.sha2(F.col("edit"), 256).alias("edited_sha256"),
        as_text(F.col("fp")).alias("fingerprint"),
        as_text(F.col("edit_fp")).alias("edited_fingerprint"),
        likeness(F.col("fp"), F.col("edit_fp")).alias("near_edited"),
        likeness(F.col("fp"), F.col("next_fp")).alias("near_next"),
        last_match(F.col("fp"), F.col("edit_fp")).alias("last_match"),
    )
