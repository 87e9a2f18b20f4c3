"""Collocations, language identification and hard negatives."""

from __future__ import annotations

import itertools
import re
from collections import Counter

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from roadstats.llm import collocations, langid, negatives
from tests.llm.conftest import lower

SF_SMALL = "/root/testdata/sf0.001"


# --- 11: collocations -------------------------------------------------------------------------


def brute_collocations(rows, threshold=10, share=50, best=2000):
    """(lang, rank, phrase, a, l, r, n, score) from all n-grams of rows (text, lang)."""
    counts, totals = {}, Counter()
    for text, lang in rows:
        lang = "und" if lang is None else lang
        of = counts.setdefault(lang, Counter())
        for piece in re.split("[.,;:!?\n\x0b\x0c\r]", lower(text or "")):
            words = re.findall("[^ \t]+", piece)
            totals[lang] += len(words)
            of.update(tuple(words[i : i + n]) for n in (1, 2, 3) for i in range(len(words) - n + 1))
    out = []
    for lang, of in counts.items():
        candidates = {g: a for g, a in of.items() if len(g) > 1 and a >= threshold}
        kept = []
        for g, a in candidates.items():
            if any(len(h) > len(g) and 100 * f >= share * a and any(h[i : i + len(g)] == g for i in range(len(h))) for h, f in candidates.items()):
                continue
            score, cut = min((1000000 * a * a // (of[g[:k]] * of[g[k:]]), k) for k in range(1, len(g)))
            kept.append((-score, -a, " ".join(g).encode(), of[g[:cut]], of[g[cut:]]))
        for rank, (score, a, phrase, left, right) in enumerate(sorted(kept)[:best], start=1):
            out.append((lang, rank, phrase.decode(), -a, left, right, totals[lang], -score))
    return sorted(out)


def texts_of(spark, rows):
    return spark.createDataFrame(rows, "text string, lang string")


PROSE = [
    ("New York City is big. New York, new york city! the cat; the dog", "en"), ("a b c\ta b c  a b\x0bc d", None), ("a b c", "und"),
    ("Ünï cödé ünï cödé\nünï cödé . É é", "fr"), ("", "fr"), (None, "fr"), (None, None), ("日本 語 日本 語", "ja"), ("  \t ., ", "xx"),
]


@pytest.mark.parametrize("threshold,best", [(2, 2000), (2, 3), (1, 2000), (10, 2000)])
def test_collocations_match_brute_force(spark, threshold, best):
    rows = PROSE * 2 + [("new york city new york city the the the the", "en")] * 6
    got = collocations.collocations(texts_of(spark, rows), threshold=threshold, best=best)
    assert sorted(map(tuple, got.collect())) == brute_collocations(rows, threshold, best=best)


def test_collocations_of_odd_rows(spark, odd, no_documents):
    got = collocations.collocations(odd)
    assert sorted(map(tuple, got.collect())) == brute_collocations([(r.text, r.lang) for r in odd.collect()])
    assert collocations.collocations(no_documents).collect() == []


def test_collocations_of_small_runs_and_a_full_map(spark, monkeypatch):
    """Many runs a task, summaries that take from their counters, and a map whose bits are shared."""
    for name, value in {"RUN": 50, "COUNTED": 40, "MAP_BITS": 256, "HANDED": 7}.items():
        monkeypatch.setattr(collocations, name, value)
    rng = np.random.default_rng(5)
    rows = [(" ".join(f"w{k}" for k in rng.zipf(1.3, 40) % 200), "en") for _ in range(150)]
    got = collocations.collocations(texts_of(spark, rows).repartition(3), threshold=6)
    assert sorted(map(tuple, got.collect())) == brute_collocations(rows, 6)


def test_words_that_share_a_hash_are_hashed_anew(spark, monkeypatch):
    real = collocations.word_ids
    monkeypatch.setattr(collocations, "word_ids", lambda group, langs, careful=False: real(group, langs, careful) % np.uint64(3) if not careful else real(group, langs, careful))
    rows = [("x y z x y q", "en")] * 12
    got = collocations.collocations(texts_of(spark, rows))
    assert sorted(map(tuple, got.collect())) == brute_collocations(rows)


def test_misra_gries_keeps_every_frequent_key():
    rng = np.random.default_rng(3)
    for capacity in (5, 40, 1000):
        stream = rng.zipf(1.2, 20000) % 5000
        true = Counter(stream.tolist())
        parts = [collocations.Summary(capacity) for _ in range(4)]
        for k, chunk in enumerate(np.array_split(stream, 97)):
            keys, counts = np.unique(chunk, return_counts=True)
            parts[k % 4].add(keys.astype(np.uint64), counts)
        whole = parts[0]
        for other in parts[1:]:
            whole.merge(other)
        whole._settle()
        assert len(whole.keys) <= capacity and whole.taken <= len(stream) / (capacity + 1)
        held = dict(zip(whole.keys.tolist(), whole.counts.tolist()))
        for key, n in true.items():
            assert n - whole.taken <= held.get(key, 0) <= n
        least = whole.taken + 1
        assert {k for k, n in true.items() if n >= least} <= set(whole.frequent(least).tolist())


def test_runs_are_packed_without_loss():
    rng = np.random.default_rng(1)
    keys = np.unique(rng.integers(0, 2**63, 5000).astype(np.uint64) * np.uint64(2))
    counts = rng.integers(1, 300, len(keys))
    counts[:100] = 1
    at = 0
    for batch in collocations._hand_on(keys, counts, 5):
        for part, mass, packed, sizes in zip(*(batch.column(k).to_pylist() for k in range(4))):
            rest, n = collocations._open(packed, sizes)
            own = keys[at : at + len(n)]
            assert (own >> np.uint64(59) == part).all() and (own >> np.uint64(27) & np.uint64(0xFFFFFFFF) == rest).all()
            assert (counts[at : at + len(n)] == n).all() and n.sum() == mass
            at += len(n)
    assert at == len(keys)


# --- 12: language identification --------------------------------------------------------------


def brute_posteriors(scores, transitions):
    n, langs = scores.shape
    total = np.zeros((n, langs))
    for path in itertools.product(range(langs), repeat=n):
        weight = np.exp(transitions)[:, path[0]].sum() * np.exp(scores[0, path[0]])
        for k in range(1, n):
            weight *= np.exp(transitions[path[k - 1], path[k]] + scores[k, path[k]])
        for k in range(n):
            total[k, path[k]] += weight
    return total / total.sum(axis=1, keepdims=True)


@pytest.mark.parametrize("block", [1, 2, 3, 256])
def test_posteriors_match_all_paths(monkeypatch, block):
    monkeypatch.setattr(langid, "BLOCK", block)
    rng = np.random.default_rng(block)
    counts, transitions = np.array([5, 0, 7, 1, 0, 3, 6]), rng.normal(size=(3, 3))
    scores = rng.normal(size=(counts.sum(), 3)) * 3
    got = langid.posteriors(scores, counts, transitions)
    at = 0
    for n in counts[counts > 0]:
        assert np.allclose(got[at : at + n], brute_posteriors(scores[at : at + n], transitions))
        at += n


def test_likelihood_has_the_right_slope():
    rng = np.random.default_rng(2)
    scores, transitions = rng.normal(size=(3, 5, 3)), rng.normal(size=(3, 3))
    labels = rng.integers(0, 3, (3, 5))
    labels[1, 3:], labels[2, 1:] = -1, -1
    value, by_score, by_step = langid.likelihood(scores, labels, transitions)
    best = np.log(brute_posteriors(scores[2, :1], transitions)[0, labels[2, 0]])
    assert np.isclose(langid.likelihood(scores[2:], labels[2:], transitions)[0], -best)
    for x, slope in ((scores, by_score), (transitions, by_step)):
        for at in itertools.product(*map(range, x.shape)):
            keep = x[at]
            x[at] = keep + 1e-6
            up = langid.likelihood(scores, labels, transitions)[0]
            x[at] = keep - 1e-6
            down = langid.likelihood(scores, labels, transitions)[0]
            x[at] = keep
            assert abs((up - down) / 2e-6 - slope[at]) < 1e-4


def test_features_are_those_of_the_word():
    def of(words):
        group = next(langid.split_words(pa.array([" ".join(words)]), word=langid._LETTER))
        slots, values, sizes = langid.features(group.low, group.starts, group.ends, group.hashes)
        parts = np.split(np.arange(len(slots)), np.cumsum(sizes)[:-1])
        return [sorted(zip(slots[p].tolist(), values[p].tolist())) for p in parts]

    words = ["a", "straße", "x" * 500, "ab", "straße"]
    together, alone = of(words), [of([w])[0] for w in words]
    assert together == alone and together[1] == together[4] and together[0] != together[3]
    assert abs(sum(v for _, v in together[1]) - (1 + langid.GRAMS + 8)) < 1e-5  # word, n-grams, affixes


def test_langid_held_out_accuracy_and_switches(spark):
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    model = langid.fit(docs)
    found = langid.identify(docs, model).withColumn("out", langid.held_out())
    assert found.columns[: len(docs.columns)] == docs.columns
    rows = found.select("out", "lang", "lang_pred", "score").collect()
    assert all(0 <= r.score <= 1 for r in rows)
    for out in (True, False):
        part = [r for r in rows if r.out == out]
        assert len(part) > 200 and sum(r.lang == r.lang_pred for r in part) / len(part) > 0.98
    # A text that switches: both parts are found, and the boundary within a few words.
    longest = {lang: docs.where((F.col("lang") == lang) & langid.held_out() & (F.length("text") > 2000)).orderBy("doc_id").first().text for lang in ("en", "de")}
    parts = [" ".join(re.findall(r"[^\W\d_]+", t)[:60]) for t in longest.values()]
    mixed = spark.createDataFrame([(1, " ".join(parts)), (2, None), (3, "12 34")], "doc_id bigint, text string")
    runs = {r.id: r.runs for r in langid.switches(mixed, model).collect()}
    assert not runs[2] and not runs[3]
    label = [r.lang for r in runs[1] for _ in range(r.words)]
    assert sum(a == b for a, b in zip(label, ["en"] * 60 + ["de"] * 60)) >= 108


def test_langid_of_odd_rows(spark, odd, no_documents):
    mixed = odd.withColumn("lang", F.when(F.col("doc_id") % 2 == 0, "fr").otherwise("en"))
    for docs in (mixed, odd):  # two languages, and one
        rows = langid.identify(docs, langid.fit(docs)).collect()
        assert len(rows) == odd.count() and all(0 <= r.score <= 1 for r in rows)
        assert {r.lang_pred for r in rows if not re.search(r"[^\W\d_]", r.text or "")} == {"und"}
        assert "und" not in {r.lang_pred for r in rows if re.search(r"[^\W\d_]", r.text or "")}
        same = {}
        for r in rows:
            assert same.setdefault(r.text, (r.lang_pred, r.score)) == (r.lang_pred, r.score)
    nothing = langid.fit(no_documents)
    assert {(r.lang_pred, r.score) for r in langid.identify(odd, nothing).collect()} == {("und", 0.0)}
    assert langid.identify(no_documents, nothing).collect() == []


def test_prediction_does_not_use_id_or_language(spark):
    docs = spark.read.parquet(f"{SF_SMALL}/documents.parquet")
    model = langid.fit(docs)
    told = {r.doc_id: (r.lang_pred, r.score) for r in langid.identify(docs, model).collect()}
    moved = docs.withColumn("lang", F.lit("zz")).withColumn("doc_id", F.col("doc_id") + 1000)
    assert told == {r.doc_id - 1000: (r.lang_pred, r.score) for r in langid.identify(moved, model).collect()}


# --- 13: hard negatives -----------------------------------------------------------------------


def brute_negatives(rows, positives=5, negatives=5, low=80):
    """rows: distinct (id, label, integer vector); anchors are ids divisible by 100."""
    dot = lambda a, b: sum(x * y for x, y in itertools.zip_longest(a, b, fillvalue=0))
    out = []
    for anchor, label, vector in rows:
        if anchor % 100:
            continue
        scored = sorted((-dot(vector, v), i, other) for i, other, v in rows if i != anchor)
        for p, i, _ in [s for s in scored if s[2] == label][:positives]:
            fits = [(n, j) for n, j, other in scored if other != label and low * -p <= 100 * -n <= 100 * -p][:negatives]
            out += [(anchor, i, rank, j, -p, -n) for rank, (n, j) in enumerate(fits, start=1)]
    return sorted(out)


def vectors_of(spark, rows):
    return spark.createDataFrame(rows, "vec_id bigint, embedding array<float>, label int, id string")


def mined(spark, table):
    rows = negatives.take_part(table, "vec_id", F.col("label"), "embedding")
    return sorted(map(tuple, negatives.mine(rows, F.col("id") % 100 == 0).collect()))


def wholes(rows):
    kept = {(i, label, tuple(int(np.floor(256 * float(np.float32(x)))) for x in v)) for i, v, label, _ in rows if i is not None and label is not None and v is not None and all(x is not None and np.isfinite(x) for x in v)}
    return sorted(kept)


@pytest.mark.parametrize("seed,width,spread", [(1, 12, 1.0), (2, 3, 0.02), (3, 20, 5.0), (4, 1, 0.01)])
def test_negatives_match_brute_force(spark, monkeypatch, seed, width, spread):
    """Narrow spreads make many ties; several query blocks for the first two."""
    monkeypatch.setattr(negatives, "BLOCK_BYTES", 4 * width * 8 if seed < 3 else 1 << 20)
    rng = np.random.default_rng(seed)
    scale = spread * np.linspace(0.2, 2, width)  # dimensions of unequal weight
    rows = [(int(25 * k), (rng.normal(size=width) * scale).tolist(), int(rng.integers(0, 3)), "x") for k in range(150)]
    assert mined(spark, vectors_of(spark, rows).repartition(3)) == brute_negatives(wholes(rows))


def test_negatives_of_odd_rows(spark):
    rows = [
        (0, [1.0, 0.0], 1, "a"), (0, [1.0, 0.0], 1, "a"), (0, [0.5, 0.5], 2, "same id"), (1, [0.9, 0.1], 1, "b"), (2, [0.85, 0.0], 2, "c"),
        (3, None, 1, "d"), (4, [1.0, None], 1, "e"), (5, [float("nan"), 1.0], 2, "f"), (6, [float("inf"), 0.0], 2, "g"), (7, [0.8, 0.2], None, "h"),
        (None, [0.9, 0.9], 2, "i"), (8, [], 2, "short"), (9, [0.8], 2, "shorter"), (100, [0.0, 0.0], 1, "zero"), (200, [-1.0, 0.0], 3, "alone"),
        (10, [1.0, 0.0, 5.0], 1, "longer"), (11, [0.9, 0.1], 1, "b"), (12, [0.85, 0.0], 2, "tie"),
    ]
    table = vectors_of(spark, rows)
    assert mined(spark, table) == brute_negatives(wholes(rows))
    assert mined(spark, table.limit(0)) == [] and mined(spark, table.where("vec_id % 100 <> 0")) == []


def test_products_beyond_floats_are_exact(spark):
    big = float(1 << 21)
    rows = [(0, [big, big, 1.0], 1, ""), (1, [big, big, 3.0], 1, ""), (2, [big, big, 2.0], 2, ""), (3, [big, big, 1.0], 2, ""), (4, [big, big, 4.0], 2, "")]
    assert mined(spark, vectors_of(spark, rows)) == brute_negatives(wholes(rows))


@pytest.mark.parametrize("pairs,step", [(1 << 20, 8), (900, 5), (100, 24)])
def test_threshold_join_prunes_and_stays_exact(monkeypatch, pairs, step):
    monkeypatch.setattr(negatives, "PAIRS", pairs)
    monkeypatch.setattr(negatives, "STEP", step)
    rng = np.random.default_rng(7)
    scale = np.sort(rng.exponential(size=24)) ** 3 * 100
    rows, queries = (np.floor(rng.normal(size=(n, 24)) * scale) for n in (400, 30))
    products = queries @ rows.T
    for quantile in (0.5, 0.99, 0.9999):
        thresholds = np.quantile(products, quantile, axis=1)
        index = negatives.Index.build(rows, np.sqrt((queries**2).sum(axis=1)).max(), thresholds.min())
        found = sorted((int(q), int(r), int(p)) for part in negatives.threshold_join(queries, thresholds, index) for q, r, p in zip(*part))
        assert found == sorted((q, r, int(products[q, r])) for q, r in zip(*np.nonzero(products >= thresholds[:, None])))
        if quantile > 0.9:
            assert (index.starts > 0).mean() > 0.9  # most rows leave dimensions out of the index
