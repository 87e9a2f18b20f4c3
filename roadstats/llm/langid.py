"""Language identification by a linear-chain conditional random field over words.

Words are runs of ASCII letters (A-Z lower-cased) and of non-ASCII characters. Each word has a score
for every language, the sum of learned weights of its features, and each pair of neighbours a
learned transition score; together they define the probability of every labelling of a text's
words. Forward-backward gives each word's probability of each language, also where a text switches
between languages (``switches`` returns the runs). A text's language is the one with the largest
mean over its words, and that mean is the score.

Features: affixes of 1 to 4 bytes, byte n-grams of 2 to 4 within the word (as a mean), the word
itself, hashed to ``FEATURES`` slots, and the lexicon: for the ``LEXICON`` most frequent words of all
learnable texts the language they are most typical of, in steps of how typical. The lexicon is
counted over every learnable row; the weights are fitted (L-BFGS, in one task) on a sample: of each
language about ``FIT_ROWS`` rows, those with the smallest hash of the id, ``RUNS`` runs of ``RUN_WORDS``
words each (words of over ``LONGEST`` bytes skipped). Runs of different rows are joined to
sequences, so transitions are learned from texts that switch.

Learnable are rows with text and language whose id is not held out (crc32 of the id's decimal
text modulo 3 is 1). Language and id are never inputs of a prediction.

Defined results: a null text or one without a letter is ``und`` with score 0. With no learnable row
all texts are. A null id is not held out. Repeated rows are counted each; ties go to the language that
sorts first. Words of any length are read whole. An empty table gives no rows. ``identify`` keeps
all columns of its input.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from roadstats.llm.fitting import minimise
from roadstats.llm.folds import free_name
from roadstats.llm.words import Words, mix, split_words
from roadstats.session import new_work_dir

FEATURES = 1 << 15
LEXICON = 1 << 16
#: The sample of the fit: rows of a language, runs of a row, words of a run and bytes of a word.
FIT_ROWS, RUNS, RUN_WORDS, LONGEST = 768, 3, 16, 64
#: Runs in a training sequence.
JOINED = 4
PENALTY = 3e-6
#: Weight of the mean over n-grams beside the single features.
GRAMS = 4.0
#: Words that forward-backward takes in one go; longer texts are chained from such blocks.
BLOCK = 256
#: Lower ends of the lexicon's steps.
TYPICAL = (0.0, 0.5, 0.8, 0.95)
UNDETERMINED = "und"
_MARKS = [np.uint64(m) for m in (0x9E3779B97F4A7C15, 0xC2B2AE3D27D4EB4F, 0x165667B19E3779F9, 0xD6E8FEB86659FD93)]
_LETTER = np.zeros(256, dtype=bool)
_LETTER[65:91] = _LETTER[97:123] = _LETTER[128:] = True


def held_out(id_col: str | Column = "doc_id") -> Column:
    """crc32 of the id's decimal text modulo 3 is 1; a null id is not held out."""
    column = F.col(id_col) if isinstance(id_col, str) else id_col
    return F.coalesce(F.pmod(F.crc32(column.cast("string")), F.lit(3)) == 1, F.lit(False))


# --- features ---------------------------------------------------------------------------------


def _slots(keys: np.ndarray, mark: np.uint64, kind: int) -> np.ndarray:
    return (mix(keys * mark + np.uint64(kind)) & np.uint64(FEATURES - 1)).astype(np.int64)


def features(low: np.ndarray, starts: np.ndarray, ends: np.ndarray, hashes: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(slots, values, number by word) of words given as spans of ``low``."""
    n, sizes = len(starts), ends - starts
    # The words one after the other, each with a zero byte on either side.
    offsets = np.concatenate(([0], np.cumsum(sizes + 2)))
    data = np.zeros(offsets[-1], dtype=np.uint64)
    within = np.arange(sizes.sum()) - np.repeat(np.cumsum(sizes) - sizes, sizes)
    data[np.repeat(offsets[:-1] + 1, sizes) + within] = low[np.repeat(starts, sizes) + within]
    word, slots, values = [np.arange(n)], [_slots(hashes, _MARKS[3], 0)], [np.ones(n)]
    mixed = data.copy()
    total = np.zeros(n)
    grams = []
    for size in range(2, 5):
        mixed = mixed[:-1] << np.uint64(8) | data[size - 1 :] if len(mixed) > 1 else mixed[:0]
        count = np.maximum(sizes + 3 - size, 0)
        owner = np.repeat(np.arange(n), count)
        place = np.arange(count.sum()) - np.repeat(np.cumsum(count) - count, count)
        grams.append((owner, _slots(mixed[offsets[owner] + place], _MARKS[0], size)))
        total += count
    for owner, found in grams:
        word.append(owner)
        slots.append(found)
        values.append(GRAMS / total[owner])
    for back in (False, True):
        key = np.zeros(n, dtype=np.uint64)
        for size in range(1, 5):
            at = offsets[1:] - 1 - size if back else offsets[:-1] + size
            long = sizes >= size
            key = key << np.uint64(8) | np.where(long, data[np.clip(at, 0, max(len(data) - 1, 0))], 0).astype(np.uint64) if n else key
            word.append(np.flatnonzero(long))
            slots.append(_slots(key[long], _MARKS[1 + back], size))
            values.append(np.ones(long.sum()))
    word, slots, values = np.concatenate(word), np.concatenate(slots), np.concatenate(values)
    order = np.argsort(word, kind="stable")
    return slots[order], values[order].astype(np.float32), np.bincount(word, minlength=n)


class Lexicon:
    """Word hashes in order and, of each, its slot: the language it is typical of and how much."""

    def __init__(self, hashes: np.ndarray, counts: np.ndarray):
        order = np.argsort(hashes)
        self.hashes, counts = hashes[order], counts[order].astype(np.float64)
        rate = counts / np.maximum(counts.sum(axis=0), 1)
        share = rate / np.maximum(rate.sum(axis=1, keepdims=True), 1e-300)
        best = share.argmax(axis=1) if len(share) else np.zeros(0, dtype=np.int64)
        step = np.searchsorted(TYPICAL, share.max(axis=1) if len(share) else np.zeros(0), side="right") - 1
        self.slots = best * len(TYPICAL) + step
        self.size = counts.shape[1] * len(TYPICAL) + 1  # the last slot: not in the lexicon

    def of(self, hashes: np.ndarray) -> np.ndarray:
        if not len(self.hashes):
            return np.full(len(hashes), self.size - 1)
        at = np.minimum(np.searchsorted(self.hashes, hashes), len(self.hashes) - 1)
        return np.where(self.hashes[at] == hashes, self.slots[at], self.size - 1)


def word_scores(group: Words, weights: np.ndarray, lexicon: Lexicon) -> np.ndarray:
    """Scores (words x languages) of a group's words, computed once per distinct word."""
    distinct, first, place = np.unique(group.hashes, return_index=True, return_inverse=True)
    out = np.zeros((len(distinct), weights.shape[1]))
    for lo in range(0, len(distinct), 1 << 14):
        at = first[lo : lo + (1 << 14)]
        slots, values, sizes = features(group.low, group.starts[at], group.ends[at], group.hashes[at])
        begins = np.cumsum(sizes) - sizes
        out[lo : lo + len(at)] = np.add.reduceat(weights[slots] * values[:, None], begins, axis=0)
        out[lo : lo + len(at)] += weights[FEATURES + lexicon.of(group.hashes[at])]
    return out[place]


# --- the chain --------------------------------------------------------------------------------


def _scaled(x: np.ndarray) -> np.ndarray:
    return x / np.maximum(x.sum(axis=-1, keepdims=True), 1e-300)


def _weights(scores: np.ndarray) -> np.ndarray:
    return np.exp(scores - scores.max(axis=-1, keepdims=True))


def posteriors(scores: np.ndarray, counts: np.ndarray, transitions: np.ndarray) -> np.ndarray:
    """Probability of each language of each word, for rows with ``counts`` words one after the other.

    Rows are cut into blocks that are stepped through together. Of rows with several blocks the
    product of the steps of each block is taken first, and chained to the weights that enter
    the block from either side.
    """
    langs, step = scores.shape[1], np.exp(transitions - transitions.max())
    blocks = -(-counts // BLOCK)
    row = np.repeat(np.arange(len(counts)), blocks)
    number = np.arange(len(row)) - np.repeat(np.cumsum(blocks) - blocks, blocks)
    begins = np.repeat(np.cumsum(counts) - counts, blocks) + number * BLOCK
    sizes = np.minimum(BLOCK, np.repeat(counts, blocks) - number * BLOCK)
    order = np.argsort(-sizes, kind="stable")  # blocks still running are a prefix
    begins, sizes = begins[order], sizes[order]
    weight = _weights(scores)
    running = [int(np.searchsorted(-sizes, -t, side="left")) for t in range(BLOCK)]

    enter, leave = np.ones((len(row), langs)), np.ones((len(row), langs))
    many = blocks[row] > 1
    if many.any():
        product = np.tile(np.eye(langs), (len(row), 1, 1))
        chained = many[order]
        for t in range(BLOCK):
            at = np.flatnonzero(chained[: running[t]])
            if len(at):
                x = (product[at] @ step) * weight[begins[at] + t][:, None, :]
                product[at] = x / x.sum(axis=(1, 2), keepdims=True)
        place = np.empty(len(order), dtype=np.int64)
        place[order] = np.arange(len(order))  # place of each block in step order
        head = np.cumsum(blocks) - blocks
        for k in range(1, int(blocks.max())):
            rows = np.flatnonzero(blocks > k)
            here, before = place[head[rows] + k], place[head[rows] + k - 1]
            enter[here] = _scaled(np.einsum("ri,rij->rj", enter[before], product[before]))
            rows = np.flatnonzero(blocks > k)
            here, after = place[head[rows] + blocks[rows] - 1 - k], place[head[rows] + blocks[rows] - k]
            leave[here] = _scaled(np.einsum("rij,rj->ri", product[after], leave[after]))
    out = np.zeros_like(scores)
    state = enter
    for t in range(int(sizes.max()) if len(sizes) else 0):
        n = running[t]
        state = _scaled((state[:n] @ step) * weight[begins[:n] + t])
        out[begins[:n] + t] = state
    back = leave
    for t in range((int(sizes.max()) if len(sizes) else 0) - 1, -1, -1):
        n = running[t]
        at = begins[:n] + t
        out[at] = _scaled(out[at] * back[:n])
        back[:n] = _scaled((weight[at] * back[:n]) @ step.T)
    return out


def likelihood(scores: np.ndarray, labels: np.ndarray, transitions: np.ndarray) -> tuple[float, np.ndarray, np.ndarray]:
    """(negative log-likelihood, its slope by the scores, by the transitions) of sequences of equal
    length: scores (sequences x words x languages), labels (sequences x words, -1 for none).

    Words without a label lie at the end of a sequence.
    """
    n, size, langs = scores.shape
    top = scores.max(axis=2, keepdims=True)
    weight, step = np.exp(scores - top), np.exp(transitions)
    there = labels >= 0
    ahead = np.zeros((size, n, langs))
    norm = np.ones((size, n))
    state = np.full((n, langs), 1.0 / langs)
    for t in range(size):
        x = (state @ step) * weight[:, t]
        total = x.sum(axis=1)
        state = np.where(there[:, t, None], x / total[:, None], state)
        norm[t] = np.where(there[:, t], total, 1.0)
        ahead[t] = state
    value = np.log(norm).sum() + (top[:, :, 0] * there).sum()
    slope, by_step = np.zeros_like(scores), np.zeros_like(transitions)
    back = np.ones((n, langs))
    for t in range(size - 1, -1, -1):
        own = there[:, t, None]
        slope[:, t] = np.where(own, ahead[t] * back, 0.0)
        before = ahead[t - 1] if t else np.full((n, langs), 1.0 / langs)
        pulled = np.where(own, weight[:, t] * back / norm[t][:, None], 0.0)
        by_step += (before.T @ pulled) * step
        back = np.where(own, pulled @ step.T, back)
    seen = np.where(there, labels, 0)
    at = np.nonzero(there)
    value -= scores[at[0], at[1], seen[at]].sum()
    slope[at[0], at[1], seen[at]] -= 1
    # What precedes the first word is any language alike.
    start = np.full(langs, 1.0 / langs) @ step
    first = seen[there[:, 0], 0]
    value -= np.log(start[first]).sum()
    by_step -= np.bincount(first, minlength=langs) / (langs * start) * step
    pairs = there[:, 1:]
    np.add.at(by_step, (seen[:, :-1][pairs], seen[:, 1:][pairs]), -1.0)
    value -= transitions[seen[:, :-1][pairs], seen[:, 1:][pairs]].sum()
    return float(value), slope, by_step


def fit_chain(runs: list[tuple[int, str]], langs: int, lexicon: Lexicon, steps: int = 60) -> tuple[np.ndarray, np.ndarray]:
    """(weights, transitions) from runs of words (language, words joined by blanks)."""
    group = next(split_words(pa.array([words for _, words in runs], pa.string()), word=_LETTER), None)
    groups = list(split_words(pa.array([words for _, words in runs], pa.string()), word=_LETTER)) if group is not None else []
    hashes = np.concatenate([g.hashes for g in groups])
    counts = np.concatenate([g.counts for g in groups])
    label = np.repeat(np.array([lang for lang, _ in runs]), counts)
    distinct, first, place = np.unique(hashes, return_index=True, return_inverse=True)
    # Features of each distinct word, from the group where it first occurs.
    bounds = np.concatenate(([0], np.cumsum([len(g.hashes) for g in groups])))
    parts = []
    for k, g in enumerate(groups):
        own = np.flatnonzero((first >= bounds[k]) & (first < bounds[k + 1]))
        at = first[own] - bounds[k]
        parts.append((own, *features(g.low, g.starts[at], g.ends[at], g.hashes[at])))
    slots, values = np.concatenate([p[1] for p in parts]), np.concatenate([p[2] for p in parts])
    owner = np.concatenate([np.repeat(own, sizes) for own, _, _, sizes in parts])
    slots = np.concatenate((slots, FEATURES + lexicon.of(distinct)))
    values, owner = np.concatenate((values, np.ones(len(distinct)))), np.concatenate((owner, np.arange(len(distinct))))
    order = np.argsort(owner, kind="stable")
    slots, values, owner = slots[order], values[order].astype(np.float64), owner[order]
    begins = np.searchsorted(owner, np.arange(len(distinct)))

    # ``JOINED`` runs make a sequence.
    sequence = np.repeat(np.arange(len(runs)) // JOINED, counts)
    lengths = np.bincount(sequence)
    column = np.arange(len(label)) - np.repeat(np.cumsum(lengths) - lengths, lengths)
    labels = np.full((len(lengths), int(lengths.max())), -1)
    labels[sequence, column] = label
    size = FEATURES + lexicon.size

    def loss(x: np.ndarray) -> tuple[float, np.ndarray]:
        weights, transitions = x[: size * langs].reshape(size, langs), x[size * langs :].reshape(langs, langs)
        by_word = np.add.reduceat(weights[slots] * values[:, None], begins, axis=0)
        scores = np.zeros((*labels.shape, langs))
        scores[sequence, column] = by_word[place]
        value, slope, by_step = likelihood(scores, labels, transitions)
        found = slope[sequence, column]
        by_weight = np.empty((size, langs))
        for k in range(langs):
            of_word = np.bincount(place, weights=found[:, k], minlength=len(distinct))
            by_weight[:, k] = np.bincount(slots, weights=values * of_word[owner], minlength=size)
        n = len(label)
        by_weight = by_weight / n + 2 * PENALTY * weights
        by_step = by_step / n + 2 * PENALTY * transitions
        return value / n + PENALTY * float((x * x).sum()), np.concatenate((by_weight.ravel(), by_step.ravel()))

    best = minimise(loss, np.zeros(size * langs + langs * langs), steps)
    return best[: size * langs].reshape(size, langs).astype(np.float32), best[size * langs :].reshape(langs, langs)


# --- Spark ------------------------------------------------------------------------------------


class Model:
    """Learned languages (sorted), weights, transitions and lexicon (broadcast; their size does not
    depend on the number of rows)."""

    def __init__(self, spark: SparkSession, langs: list[str], weights: np.ndarray | None, transitions: np.ndarray | None, lexicon: Lexicon | None):
        self.langs = langs
        self.shared = spark.sparkContext.broadcast((weights, transitions, lexicon)) if len(langs) > 1 else None

    def shares(self, text: Column) -> Column:
        """Mean probability of each language over the words of a text (null without words)."""
        shared = self.shared

        @F.arrow_udf("array<double>")
        def run(column: pa.Array) -> pa.Array:
            out = []
            for group, found in chains(column, *shared.value):
                sums = np.concatenate((np.zeros((1, found.shape[1])), np.cumsum(found, axis=0)))
                at = group.bounds()
                mean = (sums[at[1:]] - sums[at[:-1]]) / np.maximum(group.counts, 1)[:, None]
                out.extend(m.tolist() if k else None for m, k in zip(mean, group.counts))
            return pa.array(out, pa.list_(pa.float64()))

        return run(text)


def chains(column: pa.Array, weights: np.ndarray, transitions: np.ndarray, lexicon: Lexicon) -> Iterator[tuple[Words, np.ndarray]]:
    """Words and their probabilities by language, for groups of whole rows."""
    for group in split_words(column, word=_LETTER):
        yield group, posteriors(word_scores(group, weights, lexicon), group.counts, transitions)


def _learnable(docs: DataFrame, id_col: str, text_col: str, lang_col: str) -> DataFrame:
    rows = docs.select(F.col(id_col).cast("string").alias("key"), F.col(text_col).alias("text"), F.col(lang_col).cast("string").alias("lang"))
    return rows.where(F.col("text").isNotNull() & F.col("lang").isNotNull() & ~held_out("key"))


def count_words(rows: DataFrame, langs: list[str], most: int = LEXICON) -> Lexicon:
    """Lexicon of the most frequent words over all ``rows`` (lang, text)."""
    number = {lang: k for k, lang in enumerate(langs)}

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            lang = np.array([number[x] for x in batch.column(0).to_pylist()], dtype=np.uint64)
            for group in split_words(batch.column(1), word=_LETTER):
                own = np.repeat(lang[group.first : group.first + len(group.counts)], group.counts)
                for k in np.unique(own):
                    words, n = np.unique(group.hashes[own == k], return_counts=True)
                    columns = [pa.array(words.view(np.int64)), pa.array(np.full(len(words), k, dtype=np.int32)), pa.array(n.astype(np.int64))]
                    yield pa.RecordBatch.from_arrays(columns, ["hash", "lang", "n"])

    found = rows.select("lang", "text").mapInArrow(run, "hash bigint, lang int, n bigint")
    by_lang = [F.sum(F.when(F.col("lang") == k, F.col("n")).otherwise(0)).alias(f"n{k}") for k in range(len(langs))]
    counted = found.groupBy("hash").agg(F.sum("n").alias("n"), *by_lang)
    top = counted.orderBy(F.col("n").desc(), "hash").limit(most).toArrow()
    counts = np.stack([np.asarray(top.column(f"n{k}")).astype(np.int64) for k in range(len(langs))], axis=1)
    return Lexicon(np.asarray(top.column("hash")).astype(np.int64).view(np.uint64), counts)


def sample_runs(rows: DataFrame, sizes: dict[str, int]) -> DataFrame:
    """(lang, place, words): runs of words of about ``FIT_ROWS`` rows of each language."""
    order = F.xxhash64("key")
    # Hashes are even, so those below this bound are about twice the rows wanted.
    bound = F.lit(None).cast("double")
    for lang, n in sizes.items():
        bound = F.when(F.col("lang") == lang, F.lit(-(2.0**63) + 2.0**64 * min(1.0, 2.0 * FIT_ROWS / n))).otherwise(bound)
    near = rows.withColumn("order", order).where(F.col("order").cast("double") <= bound)
    first = Window.partitionBy("lang").orderBy("order", "key")
    keys = near.select("lang", "order", "key").distinct().withColumn("n", F.row_number().over(first)).where(F.col("n") <= FIT_ROWS)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for group in split_words(batch.column(2), word=_LETTER):
                bounds = group.bounds()
                for k in range(len(group.counts)):
                    at = np.arange(bounds[k], bounds[k + 1])
                    at = at[group.ends[at] - group.starts[at] <= LONGEST]
                    seed = batch.column(1)[group.first + k].as_py() & (2**63 - 1)
                    for r in range(min(RUNS, -(-len(at) // RUN_WORDS))):
                        lo = (seed >> 7 * r) % max(len(at) - RUN_WORDS + 1, 1)
                        words = b" ".join(group.low[group.starts[i] : group.ends[i]].tobytes() for i in at[lo : lo + RUN_WORDS])
                        row = [batch.column(0)[group.first + k].as_py(), (seed >> 11 * r) & 0xFFFFFF, words.decode()]
                        yield pa.RecordBatch.from_pylist([dict(zip(("lang", "place", "words"), row))])

    # Rows that repeat an id with its language are both read.
    picked = near.join(F.broadcast(keys.select("lang", "key")), ["lang", "key"], "left_semi").select("lang", "order", "text")
    return picked.mapInArrow(run, "lang string, place bigint, words string")


def fit(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", lang_col: str = "lang") -> Model:
    """Count the lexicon over all learnable rows and fit the chain on the sample."""
    spark = docs.sparkSession
    rows = _learnable(docs, id_col, text_col, lang_col)
    sizes = {r["lang"]: r["n"] for r in rows.groupBy("lang").agg(F.count("*").alias("n")).collect()}
    langs = sorted(sizes)
    if len(langs) < 2:
        return Model(spark, langs, None, None, None)
    lexicon = count_words(rows, langs)
    root = new_work_dir(spark, "langid")
    sample_runs(rows, sizes).write.parquet(f"{root}/runs")
    size = FEATURES + lexicon.size

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        found = sorted((r["place"], r["lang"], r["words"]) for batch in batches for r in batch.to_pylist())
        if found:
            weights, transitions = fit_chain([(langs.index(lang), words) for _, lang, words in found], len(langs), lexicon)
            columns = [pa.array([x.tobytes()], pa.binary()) for x in (weights, transitions)]
            yield pa.RecordBatch.from_arrays(columns, ["weights", "transitions"])

    # The sample is bounded: one task fits, and the driver gets the weights alone.
    runs = spark.read.schema("lang string, place bigint, words string").parquet(f"{root}/runs")
    got = runs.coalesce(1).mapInArrow(run, "weights binary, transitions binary").toArrow()
    if not got.num_rows:  # no words
        return Model(spark, langs[:1], None, None, None)
    weights = np.frombuffer(got.column(0)[0].as_py(), np.float32).reshape(size, len(langs))
    transitions = np.frombuffer(got.column(1)[0].as_py(), np.float64).reshape(len(langs), len(langs))
    return Model(spark, langs, weights, transitions, lexicon)


def identify(docs: DataFrame, model: Model, text_col: str = "text", lang_name: str = "lang_pred", score_name: str = "score") -> DataFrame:
    """``docs`` and each row's language and score."""
    text = F.col(text_col)
    letter = F.coalesce(text.rlike(r"\p{L}"), F.lit(False))
    if not model.langs:
        return docs.select("*", F.lit(UNDETERMINED).alias(lang_name), F.lit(0.0).alias(score_name))
    if model.shared is None:
        return docs.select("*", F.when(letter, model.langs[0]).otherwise(UNDETERMINED).alias(lang_name), F.when(letter, 1.0).otherwise(0.0).alias(score_name))
    shares, known = free_name(docs, "_shares"), free_name(docs, "_letter")
    rows = docs.select("*", letter.alias(known), model.shares(text).alias(shares))
    best = F.array_max(shares)
    named = F.element_at(F.array(*[F.lit(x) for x in model.langs]), F.array_position(shares, best).cast("int"))
    return rows.select(
        *docs.columns,
        F.when(F.col(known), named).otherwise(UNDETERMINED).alias(lang_name),
        F.when(F.col(known), F.least(best, F.lit(1.0))).otherwise(0.0).alias(score_name),
    )


def switches(docs: DataFrame, model: Model, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(id, runs): of each row the runs of words of one language, as (lang, first word, words, mean
    probability). Each word has its most probable language."""
    kind = pa.list_(pa.struct([("lang", pa.string()), ("first", pa.int64()), ("words", pa.int64()), ("probability", pa.float64())]))
    langs, shared = model.langs, model.shared

    @F.arrow_udf("array<struct<lang: string, first: bigint, words: bigint, probability: double>>")
    def run(column: pa.Array) -> pa.Array:
        out = []
        for group, found in chains(column, *shared.value):
            best, bounds = found.argmax(axis=1), group.bounds()
            for lo, hi in zip(bounds[:-1], bounds[1:]):
                cuts = np.flatnonzero(np.diff(best[lo:hi])) + 1
                edges = [0, *cuts.tolist(), int(hi - lo)] if hi > lo else []
                out.append([(langs[best[lo + a]], a, b - a, float(found[lo + a : lo + b, best[lo + a]].mean())) for a, b in zip(edges, edges[1:])])
        return pa.array(out, kind)

    if shared is None:
        raise ValueError("fewer than two languages were learned, so no text switches between them")
    return docs.select(F.col(id_col).alias("id"), run(F.col(text_col)).alias("runs"))


def op12_langid(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir.rstrip('/')}/documents.parquet")
    model = fit(docs.select("doc_id", "text", "lang"))
    found = identify(docs.select("doc_id", "text"), model)
    return found.select(F.col("doc_id").cast("bigint").alias("doc_id"), held_out().alias("held_out"), "lang_pred", "score")
