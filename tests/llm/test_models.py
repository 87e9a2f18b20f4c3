"""Classifiers, URL rules, rollups, transcripts and the pipeline."""

from __future__ import annotations

import math
import os
import re
import zlib
from collections import Counter
from itertools import combinations
from urllib.parse import urlsplit

import duckdb
import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

import corpus_pipeline
from roadstats.llm import folds, quality, rollups, sql, toxicity, transcripts, urls
from roadstats.llm.queries import QUERIES
from tests.llm.conftest import words
from tests.conftest import SF_MID, SF_SMALL


def _auc(label: np.ndarray, score: np.ndarray) -> float:
    order = np.argsort(np.argsort(score)) + 1
    good = label == 1
    return (order[good].sum() - good.sum() * (good.sum() + 1) / 2) / (good.sum() * (~good).sum())


def test_fold_is_crc32_of_the_id(spark):
    got = {r.id: r.f for r in spark.range(300).select("id", folds.fold("id").alias("f")).collect()}
    assert got == {i: zlib.crc32(str(i).encode()) % 4 for i in range(300)}


# --- 1: quality -------------------------------------------------------------------------------


def test_cumulative_link_gradient():
    rng = np.random.default_rng(0)
    rows = [(np.sort(rng.choice(30, 5, replace=False)).astype(np.int32), rng.random(5).astype(np.float32)) for _ in range(60)]
    grades = rng.integers(0, 3, 60)
    seen = {}

    def spy(function, at, steps):
        seen["f"], seen["x"] = function, at + 0.1 * rng.normal(size=len(at))
        return at

    before, quality.minimise = quality.minimise, spy
    try:
        quality.fit_weights(rows, grades, 3)
    finally:
        quality.minimise = before
    x, (_, slope) = seen["x"], seen["f"](seen["x"])
    for k in [0, 3, len(x) - 2, len(x) - 1]:
        step = np.zeros(len(x))
        step[k] = 1e-5
        assert abs((seen["f"](x + step)[0] - seen["f"](x - step)[0]) / 2e-5 - slope[k]) < 1e-6


def test_ordinal_fit_orders_grades():
    rng = np.random.default_rng(1)
    grades = rng.integers(0, 4, 400)
    rows = [(np.array([0, 1 + int(rng.integers(5))], dtype=np.int32), np.array([g + 0.3 * rng.normal(), 1.0], dtype=np.float32)) for g in grades]
    weights, cuts = quality.fit_weights(rows, grades, 4)
    assert (np.diff(cuts) > 0).all()
    f = np.array([weights[s] @ v for s, v in rows])
    expected = sum(1 / (1 + np.exp(t - f)) for t in cuts)
    assert np.corrcoef(expected, grades)[0, 1] > 0.9


def test_features_count_whole_texts():
    texts = ["", None, "a", "ab", "abc", "abcd efg", "é x", "a", "a a", "zz", "zz Zz zz zz"]
    for _, grams, n_grams, word, repeats, n_words in quality.features(pa.array(texts)):
        sizes = [len((t or "").encode()) for t in texts]
        assert n_grams.tolist() == [max(0, s - 2) for s in sizes] and len(grams) == n_grams.sum()
        assert n_words.tolist() == [len((t or "").split()) for t in texts] and len(word) == len(repeats) == n_words.sum()
        assert repeats.tolist().count(1) == 4  # "a a" and "zz Zz zz zz", not across rows
    weights = np.random.default_rng(2).normal(size=quality.FEATURES).astype(np.float32)
    whole = quality.text_values(pa.array(texts), weights)
    alone = [quality.text_values(pa.array([t], pa.string()), weights)[0] for t in texts]
    assert np.allclose(whole, alone)


def test_op1_held_out(spark):
    got = quality.op1_quality(spark, SF_MID).toPandas()
    labels = spark.read.parquet(f"{SF_MID}/labels.parquet").toPandas()
    held = got.merge(labels, on="doc_id").query("held_out")
    assert len(got) == 1000 and got.p_acceptable.between(0, 1).all() and got.expected_grade.between(0, 2).all()
    assert _auc(held.quality.values, held.p_acceptable.values) > 0.85


def test_scores_follow_from_weights_and_thresholds(spark, odd):
    """Brute force from the learned numbers: features counted one by one in Python."""
    docs = spark.read.parquet(f"{SF_MID}/documents.parquet").select("doc_id", "text").union(odd.select("doc_id", "text"))
    labels = spark.read.parquet(f"{SF_MID}/labels.parquet")
    model = quality.fit(docs, quality.ratings_of(labels))
    weights = np.asarray(model.shared.value, dtype=np.float64)
    assert model.thresholds == sorted(model.thresholds)

    def value(text):
        raw = (text or "").encode()
        grams = [int.from_bytes(raw[i : i + 3], "big") for i in range(len(raw) - 2)]
        total = quality.SCALE * float(weights[quality._slots(quality.mix(np.array(grams, dtype=np.uint64) * quality._TRIGRAMS))].mean()) if grams else 0.0
        found = words(text)
        hashes = [next(quality.split_words(pa.array([w]))).hashes[0] for w in found]
        for k, h in enumerate(hashes):
            slot = quality._slots(quality.mix(np.array([h]) * quality._WORDS))[0]
            repeat = quality._REPEATS[0] if k and found[k] == found[k - 1] else quality._REPEATS[1]
            total += quality.SCALE * (weights[slot] + weights[repeat]) / len(hashes)
        return total

    texts = [r.text for r in docs.orderBy(F.xxhash64("doc_id", "text")).limit(60).collect()] + [None, "", "a a A b", "é"]
    table = spark.createDataFrame(list(enumerate(texts)), "doc_id bigint, text string")
    for r in quality.score(table, model).collect():
        tails = [1 / (1 + np.exp(t - value(texts[r.doc_id]))) for t in model.thresholds]
        assert r.p_acceptable == pytest.approx(tails[0], abs=1e-4) and r.expected_grade == pytest.approx(sum(tails), abs=1e-4)


def test_sample_is_bounded_in_bytes(spark):
    ratings = spark.range(200).selectExpr("id AS doc_id", "CAST(id % 2 * 2 AS int) AS grade")
    docs = ratings.selectExpr("doc_id", "CASE WHEN doc_id = 7 THEN repeat('x ', 100000) WHEN doc_id % 2 = 0 THEN 'bad bad words' ELSE 'fine long text' END AS text")
    assert quality.fit(docs, ratings, most_bytes=1000).shared is not None
    assert quality.fit(docs, ratings, most_bytes=15).only in (0, 2)  # one row
    assert quality.fit(docs, ratings, most_bytes=1).only is None  # none


def test_sample_is_taken_from_the_documents_own_ratings(spark):
    ratings = spark.range(2_000).selectExpr("id AS doc_id", "CAST(id % 2 * 2 AS int) AS grade")
    later = [r.doc_id for r in ratings.orderBy(F.xxhash64("doc_id")).collect()[1_500:]]
    docs = spark.createDataFrame([(i, ["bad bad words", "fine long text"][i % 2]) for i in later], "doc_id bigint, text string")
    model = quality.fit(docs, ratings, rows=50)
    assert model.shared is not None and model.only is None


# --- 7: toxicity ------------------------------------------------------------------------------


def test_grams_by_definition():
    texts = ["Ab, c", "", None, "x", "  hi--there é", "--", "a" * 9]
    for first, grams, counts in toxicity.stream(pa.array(texts)):
        at = np.concatenate(([0], np.cumsum(counts)))
        for r, text in enumerate(texts[first:]):
            kept = re.sub(rb" +", b" ", bytes(toxicity._FOLDED[list((text or "").encode())])) if text else b""
            kept = kept.removeprefix(b" ")
            padded = b" " * 4 + kept
            assert grams[at[r] : at[r + 1]].tolist() == [int.from_bytes(padded[i : i + 5], "big") for i in range(len(kept))]


def test_ratios_by_definition(spark, work):
    rows = [("0", "abab abab"), ("0", "abba"), ("1", "bab bab x"), ("1", "ab"), ("0", "")]
    counts: dict[int, list[int]] = {}
    for label, text in rows:
        for _, grams, _ in toxicity.stream(pa.array([text])):
            for g in grams.tolist():
                counts.setdefault(g, [0, 0])[int(label)] += 1
    df = spark.createDataFrame([(int(a), b) for a, b in rows], "label int, text string")
    table = toxicity.count_grams(df)
    assert {r.gram: [r.c0, r.c1] for r in table.collect()} == counts
    d, s = toxicity.DISCOUNT, toxicity.BACKOFF_MASS
    orders = {5: counts}
    for n in (4, 3):
        orders[n] = {}
        for g, c in orders[n + 1].items():
            own = orders[n].setdefault(g & (1 << 8 * n) - 1, [0, 0])
            own[0], own[1] = own[0] + (c[0] > 0), own[1] + (c[1] > 0)

    def p(g, n, k):
        table = orders[n]
        near = [c for x, c in table.items() if x >> 8 == g >> 8]
        if n == 3:
            total = sum(map(sum, near))
            low = (max(sum(table.get(g, [0, 0])) - d, 0) + d * len(near) / 64) / total if near else None
        else:
            low = p(g & (1 << 8 * (n - 1)) - 1, n - 1, k)
        own = [c[k] for c in near]
        return (max(table.get(g, [0, 0])[k] - d, 0) + (s + d * sum(c > 0 for c in own)) * low) / (s + sum(own))

    found = {r.key: r.ratio for r in toxicity.ratios(table, f"{work}/a").collect()}
    for n, grams in orders.items():
        for g in grams:
            assert found[toxicity.seen_key(np.uint64(g), n).item()] == pytest.approx(np.log(p(g, n, 1) / p(g, n, 0)))
    slots = toxicity.slot_table(toxicity.ratios(table, f"{work}/b"))
    for g in counts:  # "x" after each context: unseen at some order, seen below or not at all
        new = g >> 8 << 8 | ord("b")
        got = toxicity._gram_ratios(np.array([new], dtype=np.uint64), slots, 5)[0]
        if new & 0xFFFFFF in orders[3]:
            assert got == pytest.approx(np.log(p(new, 5, 1) / p(new, 5, 0)), abs=1e-5)


def test_unseen_grams_are_told_from_seen(spark):
    seen = F.when(F.col("id") % 2 == 0, toxicity.seen_key(F.col("id") * 7919, 5)).otherwise(toxicity.rest_key(F.col("id") * 7919, 5))
    found = spark.range(400_000).select(seen.alias("key"), F.lit(1.0).alias("weight"), (F.col("id") + 1.0).alias("ratio"))
    table = toxicity.slot_table(found)
    ids = np.arange(0, 400_000, 2, dtype=np.uint64)
    assert (toxicity._gram_ratios(ids * np.uint64(7919), table, 5) == ids + 1.0).all()
    strangers = (np.arange(400_000, dtype=np.uint64) * np.uint64(7919)) + (np.uint64(1) << np.uint64(39))
    assert not toxicity._gram_ratios(strangers, table, 5).any()


def test_joined_ratios_equal_broadcast_ones(spark, odd_dir, monkeypatch):
    docs = spark.read.parquet(f"{SF_SMALL}/documents.parquet").select("doc_id", "text")
    docs = docs.union(spark.read.parquet(f"{odd_dir}/documents.parquet").selectExpr("doc_id + 1000000", "text")).union(docs.limit(50))
    labels = spark.read.parquet(f"{SF_SMALL}/labels.parquet")
    near = toxicity.fit(docs, labels)
    monkeypatch.setattr(toxicity, "MOST_KEYS", 0)
    monkeypatch.setattr(toxicity, "HOT_SHARE", 2_000)
    far = toxicity.fit(docs, labels)
    assert near.shared is not None and far.shared is None
    assert (far.slope, far.offset) == pytest.approx((near.slope, near.offset), rel=0.02)
    got = [sorted((repr(r.doc_id), r.text or "", r.x) for r in m.with_ratio(docs, "text", "x").collect()) for m in (near, far)]
    assert [r[:2] for r in got[0]] == [r[:2] for r in got[1]] and len(got[0]) == docs.count()
    assert np.allclose([r[2] for r in got[0]], [r[2] for r in got[1]], atol=1e-9)


def test_op7_finds_planted_words(spark, work):
    rng = np.random.default_rng(3)
    rows, labels = [], []
    for i in range(1200):
        text = ["".join(rng.choice(list("abcdefgh"), 5)) for _ in range(60)]
        toxic = i % 6 == 0
        for k in range(6 if toxic else 0):
            text[10 * k] = ["wretched", "vile", "scoundrel"][k % 3]
        rows.append((i, " ".join(text)))
        labels.append((i, 1, int(toxic)))
    rows.append((5000, None))
    spark.createDataFrame(rows, "doc_id bigint, text string").write.parquet(f"{work}/documents.parquet")
    spark.createDataFrame(labels, "doc_id bigint, quality int, toxic int").write.parquet(f"{work}/labels.parquet")
    got = toxicity.op7_toxicity(spark, work).toPandas().set_index("doc_id")
    truth = np.array([i % 6 == 0 for i in range(1200)])
    assert got.held_out.tolist() == [zlib.crc32(str(i).encode()) % 4 == 2 for i in got.index]
    held = got.loc[range(1200)][got.loc[range(1200)].held_out.values]
    assert _auc(truth[held.index].astype(int), held.score.values) > 0.99
    assert (held.predicted == truth[held.index]).mean() > 0.97 and got.predicted[5000] == 0
    assert ((got.score >= 0.3) == (got.predicted == 1)).all()


# --- 6: URLs ----------------------------------------------------------------------------------

URLS = [
    "https://a.example.org/es/1", "https://example.org/en/1x", "http://EXAMPLE.org/en/2?x=1", "ftp://com/fr/", "https://x.com/de/9#f", "https://x.com",
    "https://xcom/de/", "no scheme", "", None, "https://h.net?q://z/", "a://b://c/d", "://host/p", "https://x.org#a/b", "https://b.org/é/ü?ü",
]


def test_url_parts_and_rules(spark):
    df = spark.createDataFrame(list(enumerate(URLS)), "page_id bigint, url string")
    labels = spark.createDataFrame([], "doc_id bigint, quality int, toxic int")
    got = {r.page_id: r for r in urls.judge(df, labels).collect()}
    for n, url in enumerate(URLS):
        rest = (url or "").partition("://")[2] if "://" in (url or "") else ""
        host = re.match(r"[^/?#]*", rest)[0]
        path = re.match(r"[^?#]*", rest[len(host) :])[0]
        host = re.sub("[A-Z]", lambda m: m[0].lower(), host)
        fits = [(len(h + p), h + p, v) for v, h, p in urls.RULES if (host == h or host.endswith("." + h)) and path.startswith(p)]
        rule, verdict = max(fits)[1:] if fits else (None, "allow")
        assert (got[n].host, got[n].path, got[n].rule, got[n].verdict) == (host, path, rule, verdict), url
    assert urlsplit(URLS[0]).hostname == got[0].host


def test_mined_rules_are_exact(spark):
    rng = np.random.default_rng(4)
    rows = []
    for i in range(3000):
        host = ["good.net", "shop.net", "spam.net"][int(rng.integers(3))]
        kind = ["news", "pills"][int(rng.integers(2))]
        rows.append((i, f"https://{host}/{kind}/{i}", host == "spam.net" and kind == "pills" and rng.random() < 0.95 or rng.random() < 0.02))
    pages = spark.createDataFrame([(i, u) for i, u, _ in rows], "page_id bigint, url string")
    labels = spark.createDataFrame([(i, int(not bad), 0) for i, _, bad in rows if i % 3], "doc_id bigint, quality int, toxic int")
    got = {r.page_id: r for r in urls.judge(pages, labels).collect()}
    assert all((got[i].verdict == "block") == ("spam.net/pills" in u) for i, u, _ in rows)
    assert {got[i].mined_rule for i, u, _ in rows if "spam.net/pills" in u} == {"host:spam path:pills"}


def _brute_rules(transactions):
    """Antecedents by trying every token set."""
    n, seen, bad = len(transactions), Counter(), Counter()
    for tokens, blocked in transactions:
        for size in range(1, len(tokens) + 1):
            for part in combinations(sorted(tokens), size):
                seen[part] += 1
                bad[part] += blocked
    base, z, found = sum(b for _, b in transactions) / n, urls.Z, {}
    for part, k in bad.items():
        p, rows = k / seen[part], seen[part]
        low = (p + z * z / 2 / rows - z * math.sqrt(p * (1 - p) / rows + z * z / 4 / rows**2)) / (1 + z * z / rows)
        if k and k >= math.ceil(n * urls.MIN_SUPPORT) and low >= urls.MIN_CONFIDENCE and p / base >= urls.MIN_LIFT:
            found[part] = p
    return {r for r, p in found.items() if not any(found.get(r[:k] + r[k + 1 :], -1) >= p for k in range(len(r)))}


@pytest.mark.parametrize("n", [60, 2000])
def test_miner_against_brute_force(spark, n):
    rng = np.random.default_rng(n)
    rows = []
    for _ in range(n):
        tokens = sorted({f"t{int(k)}" for k in rng.integers(0, 9, int(rng.integers(0, 6)))})
        rows.append((tokens, bool(rng.random() < (0.9 if {"t1", "t2"} <= set(tokens) or "t7" in tokens else 0.1))))
    df = spark.createDataFrame(rows, "tokens array<string>, blocked boolean")
    got = {tuple(r.rule) for r in urls.mine(df, urls.MIN_SUPPORT, urls.MIN_CONFIDENCE, urls.MIN_LIFT).collect()}
    kept = [(t, b) for t, b in rows if t or b]  # transactions without any item are left out
    assert got == _brute_rules(kept) and got


def test_page_text(spark):
    html = "<html><title>A</title><style>p{}</style><script>var t='</p>';</script><nav>menu</nav><!-- <p>no</p> --><p>one <b>t</b>wo</p>\n<P class='x'>3 &lt; 4 &amp;amp;</html>"
    df = spark.createDataFrame([(html,), ("",), (None,), ("<p>" * 50_000 + "x",)], "h string")
    assert [r.t for r in df.select(urls.page_text(F.col("h")).alias("t")).collect()] == ["A\none two\n3 < 4 &amp;", "", None, "x"]


def test_pages_are_labelled_by_their_text(spark):
    docs = spark.read.parquet(f"{SF_MID}/documents.parquet").select("doc_id", "text")
    labels = spark.read.parquet(f"{SF_MID}/labels.parquet")
    host = F.when(F.col("quality") == 0, "junk.net").otherwise("good.net")
    html = F.concat(F.lit("<html><nav>a</nav><p>"), "text", F.lit("</p></html>"))
    pages = docs.join(labels, "doc_id").select((F.col("doc_id") + 10**6).alias("page_id"), F.concat(F.lit("http://"), host, F.lit("/p/"), F.col("doc_id")).alias("url"), html.alias("html"))
    got = urls.judge(pages, urls.page_labels(pages, docs, labels)).collect()
    assert {r.mined_rule for r in got if r.verdict == "block"} == {"host:junk"}
    assert all((r.verdict == "block") == (r.host == "junk.net") for r in got)


# --- 8: rollups -------------------------------------------------------------------------------


def test_op8_against_sql(spark):
    con = duckdb.connect()
    for t in ("documents", "labels"):
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{SF_SMALL}/{t}.parquet')")
    df = rollups.op8_token_counts(spark, SF_SMALL)
    res = con.execute(sql.ORACLE["op8_token_counts"])
    names = [d[0] for d in res.description]
    assert sorted(names) == sorted(df.columns)
    assert sorted(map(repr, map(tuple, df.select(*names).collect()))) == sorted(map(repr, res.fetchall()))


def test_empty_marker_is_no_commit(spark, work):
    rows = spark.createDataFrame([("s", "en", "t", 5)], "source string, lang string, tokenizer string, n_tokens bigint")
    rollup = rollups.Rollup(spark, f"{work}/rollup")
    os.makedirs(f"{work}/rollup/commits")
    os.makedirs(f"{work}/rollup/snapshots")
    open(f"{work}/rollup/commits/{rollup._marker('a')}", "w").close()  # its writer died
    assert rollup.commit("a", rollups.inserts(rows)) and not rollup.commit("a", rollups.inserts(rows))
    open(f"{work}/rollup/snapshots/00000000", "w").close()
    rollup.compact()
    assert rollup.commit("b", rollups.inserts(rows)) and not rollup.commit("b", rollups.inserts(rows))
    rollup.compact()
    assert [tuple(r) for r in rollup.totals().collect()] == [("s", "en", "t", 2, 10)]


def test_rollup_batches_commit_once(spark, work):
    rows = spark.createDataFrame([("s", "en", "v1", 10), ("s", "en", "v1", 5), (None, "en", "v1", None)], "source string, lang string, tokenizer string, n_tokens bigint")
    rollup = rollups.Rollup(spark, f"{work}/rollup")
    total = lambda: sorted(map(repr, map(tuple, rollup.totals().collect())))
    assert total() == []
    assert rollup.commit("a", rollups.inserts(rows)) and not rollup.commit("a", rollups.inserts(rows))
    first = total()
    assert first == sorted([repr((None, "en", "v1", 1, 0)), repr(("s", "en", "v1", 2, 15))])
    # A batch that died before its marker: data without a commit.
    rows.limit(1).selectExpr("source", "lang", "tokenizer", "1L docs", "9L tokens").write.parquet(f"{work}/rollup/deltas/dead")
    assert total() == first
    rollup.compact()
    assert total() == first and not rollup.commit("a", rollups.inserts(rows))
    revised = rows.limit(1).selectExpr("source", "lang", "tokenizer", "n_tokens", "'v2' new_tokenizer", "7L new_tokens")
    assert rollup.commit("b", rollups.revisions(revised))
    assert total() == sorted([repr((None, "en", "v1", 1, 0)), repr(("s", "en", "v1", 1, 5)), repr(("s", "en", "v2", 1, 7))])
    assert rollup.commit("c", rollups.deletes(rows.where("source IS NULL"))) and rollup.commit("empty", rollups.inserts(rows.limit(0)))
    rollup.compact()
    assert total() == sorted([repr(("s", "en", "v1", 1, 5)), repr(("s", "en", "v2", 1, 7))])


# --- 9: transcripts ---------------------------------------------------------------------------


def _viterbi(codes, model):
    score = model.transitions[transcripts.START] + model.emissions[:, codes[0]]
    for code in codes[1:]:
        score = (score[:, None] + model.transitions[: transcripts.START]).max(axis=0) + model.emissions[:, code]
    return score.max()


def _read_in_order(spark, lines):
    """(conv_id, turn, line) -> (code, state or None), by conversation in reading order."""
    rows = lines.withColumn("text", F.coalesce("text", F.lit("")))
    rows = rows.select("conv_id", "turn", "line", F.xxhash64("text").alias("mark"), transcripts.features(F.col("text")).alias("code"), transcripts.is_blank(F.col("text")).alias("blank"), "role", "begins")
    state = {s: n for n, s in enumerate(transcripts.STATES)}
    by: dict = {}
    for r in sorted(rows.collect(), key=lambda r: (r.conv_id, r.turn, r.line, r.mark)):
        own = by.setdefault(r.conv_id, [])
        own.append(((r.turn, r.line), r.code + int(bool(own) and own[-1][3]), state.get((r.role, r.begins)), r.blank))
    return by


def _brute_model(by):
    steps, seen = np.zeros((transcripts.START + 1, transcripts.START)), np.zeros((transcripts.START, transcripts.CODES))
    for path in by.values():
        before = transcripts.START
        for _, code, now, _ in path:
            if now is not None:
                seen[now, code] += 1
                if before is not None and transcripts._ALLOWED[before, now]:
                    steps[before, now] += 1
            before = now
    return transcripts.model_of(steps, seen)


@pytest.mark.parametrize("chunk", [3, 1024])
def test_chunks_decode_like_one_pass(spark, monkeypatch, chunk):
    monkeypatch.setattr(transcripts, "CHUNK", chunk)
    turns = spark.read.parquet(f"{SF_SMALL}/conversations.parquet")
    # One conversation holds most lines, so that it lies in several ranges; one turn is repeated.
    hot = turns.where("conv_id >= 40").select(F.lit(7).cast("bigint").alias("conv_id"), (F.col("turn") + F.col("conv_id") * 10).alias("turn"), "role", "text")
    turns = turns.unionByName(hot).unionByName(turns.where("conv_id = 3"))
    lines = transcripts.transcript_lines(turns)
    by = _read_in_order(spark, lines)
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        model = transcripts.fit(lines)
        got = transcripts.parse(lines, model).collect()
        ranges = transcripts._in_order(lines).where("conv_id = 7").select(F.spark_partition_id().alias("p")).distinct().count()
    finally:
        spark.conf.unset("spark.sql.adaptive.coalescePartitions.enabled")
    assert ranges > 2
    brute = _brute_model(by)
    assert np.array_equal(model.transitions, brute.transitions) and np.array_equal(model.emissions, brute.emissions)
    assert len(got) == sum(map(len, by.values()))
    assert any(code % 2 for path in by.values() for _, code, now, _ in path if now is not None and now % 2)  # blank lines inside turns too
    state = {s: n for n, s in enumerate(transcripts.STATES)}
    found: dict = {}
    for r in got:
        found.setdefault(r.conv_id, {}).setdefault((r.turn, r.line), []).append(state[r.role, r.opens])
    for conv, path in by.items():
        if conv == 3:  # repeated lines: their states cannot be told apart
            continue
        score, before = 0.0, transcripts.START
        for place, code, _, _ in path:
            (now,) = found[conv][place]
            score += model.transitions[before, now] + model.emissions[now, code]
            before = now
        assert score == _viterbi([code for _, code, _, _ in path], model)


def test_repeated_turns_count_once_each(spark):
    turns = spark.createDataFrame([(1, 0, "user", "hi")] * 3000 + [(1, 1, "assistant", "yes")], "conv_id bigint, turn bigint, role string, text string")
    lines = transcripts.transcript_lines(turns)
    counted = transcripts._counted(lines).where("kind < 2").groupBy("kind").agg(F.sum("n").alias("n")).collect()
    edges = 2 * transcripts._counted(lines).where("kind = 2").count()
    assert {r.kind: r.n for r in counted}[1] + edges // 2 == lines.count()
    assert np.array_equal(transcripts.fit(lines).transitions, _brute_model(_read_in_order(spark, lines)).transitions)
    assert len(transcripts.parse(lines, transcripts.fit(lines)).collect()) == lines.count()


def test_roles_are_recovered_and_rendered(spark):
    turns = spark.read.parquet(f"{SF_MID}/conversations.parquet")
    lines = transcripts.transcript_lines(turns)
    got = transcripts.op9_transcripts(spark, SF_MID)
    truth = lines.select("conv_id", "turn", "line", F.col("role").alias("given"), (folds.fold("conv_id") == 2).alias("held"))
    both = got.join(truth, ["conv_id", "turn", "line"]).toPandas()
    assert len(both) == lines.count() and (both[both.held].role == both[both.held].given).mean() > 0.9
    for r in both.itertuples():
        assert r.rendered.startswith(f"<|{r.role}|>\n") == r.opens and r.rendered.endswith("\n")


def test_markers(spark):
    texts = ["User: hi", "[human]: a: b", "ai> x", "## SYSTEM: y", "see also: this", "plain", "", "Q: why?"]
    df = spark.createDataFrame(list(enumerate(texts)), "n int, text string")
    got = [tuple(r) for r in df.orderBy("n").select(transcripts.marker_of(F.col("text")), transcripts.without_marker(F.col("text"))).collect()]
    assert got == [(2, "hi"), (2, "a: b"), (3, "x"), (1, "y"), (0, "see also: this"), (0, "plain"), (0, ""), (2, "why?")]


# --- odd inputs -------------------------------------------------------------------------------


@pytest.fixture(scope="module")
def odd_dir(spark, odd, odd_labels, tmp_path_factory):
    root = str(tmp_path_factory.mktemp("odd"))
    odd.write.parquet(f"{root}/documents.parquet")
    odd_labels.write.parquet(f"{root}/labels.parquet")
    pages = [(1, "https://a.org/x", "h"), (1, "https://a.org/x", "h"), (None, "https://a.org/x", None), (2, None, None), (3, "", "")]
    spark.createDataFrame(pages, "page_id bigint, url string, html string").write.parquet(f"{root}/pages.parquet")
    spark.createDataFrame([(1, "alpha beta gamma"), (None, None)], "item_id bigint, text string").write.parquet(f"{root}/benchmark.parquet")
    turns = [(1, 0, "user", "hi"), (1, 0, "user", "hi"), (1, None, "user", None), (None, 1, None, "x\ny"), (2, 5, "tool", "")]
    spark.createDataFrame(turns, "conv_id bigint, turn bigint, role string, text string").write.parquet(f"{root}/conversations.parquet")
    vectors = [(0, [1.0, 0.5], 1), (0, [1.0, 0.5], 1), (1, [0.7, 0.5], 1), (2, [0.8, 0.5], 2), (None, [1.0], 1), (3, None, 2), (4, [None, 1.0], 2), (5, [1.0, 0.4], None)]
    spark.createDataFrame(vectors, "vec_id bigint, embedding array<float>, label int").write.parquet(f"{root}/embeddings.parquet")
    return root


@pytest.fixture(scope="module")
def empty_dir(spark, odd_dir, tmp_path_factory):
    root = str(tmp_path_factory.mktemp("empty"))
    for t in ("documents", "labels", "pages", "benchmark", "conversations", "embeddings"):
        spark.read.parquet(f"{odd_dir}/{t}.parquet").limit(0).write.parquet(f"{root}/{t}.parquet")
    return root


ROWS = {"op11_collocations": None, "op13_negatives": 1, "op6_urls": 5, "op8_token_counts": None, "op9_transcripts": 11, "pipeline": None}  # op9: six lines, and a blank one behind each of the five turns


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_odd_and_empty_tables(spark, odd_dir, empty_dir, name):
    rows = QUERIES[name](spark, odd_dir).collect()
    expected = ROWS.get(name, 13)  # each row of documents, repeated ones too
    assert expected is None or len(rows) == expected
    assert QUERIES[name](spark, empty_dir).collect() == []


def test_defined_results_of_odd_rows(spark, odd_dir):
    rows = QUERIES["op3_simhash"](spark, odd_dir).collect()
    zero = [r for r in rows if r.fingerprint == "0" * 16]
    assert len(zero) == 4 and {r.component_id for r in zero} == {2}  # null, empty and blank texts link
    assert {r.component_id for r in rows if r.doc_id == 9} == {1}
    texts = [r for r in QUERIES["op2_syncmers"](spark, odd_dir).collect() if r.doc_id in (2, 3)]
    assert all(r.n_chars == 0 and r.fingerprint == "" for r in texts)
    found = {r.doc_id: r for r in QUERIES["op5_licenses"](spark, odd_dir).collect() if r.doc_id in (2, 7)}
    assert found[2].n_words == 0 and found[2].score == 0.0 and found[2].first_word is None
    assert (found[7].n_base, found[7].base_labels, found[7].first_word, found[7].last_word) == (3, "cc-by,reserved", 0, 5)
    hit = [r for r in QUERIES["op10_decontaminate"](spark, odd_dir).collect() if r.contaminated]
    assert sorted(r.doc_id for r in hit) == [1, 1, 9] and all(r.n_hit == 3 and r.n_items == 1 for r in hit)


# --- pipeline ---------------------------------------------------------------------------------


def test_stages_keep_columns_and_decide(spark, odd_dir):
    docs = spark.read.parquet(f"{odd_dir}/documents.parquet")
    rows = Counter(map(tuple, docs.collect()))
    for name, stage in corpus_pipeline.STAGES[:-1]:
        kept = stage(spark, docs, odd_dir)
        assert kept.columns == docs.columns, name
        assert not Counter(map(tuple, kept.collect())) - rows, name
    assert [r.n for r in corpus_pipeline.near_duplicates(spark, docs, odd_dir).groupBy("doc_id", "text").agg(F.count("*").alias("n")).collect()].count(1) >= 7


def test_pipeline_stages_against_the_operators(spark):
    docs = spark.read.parquet(f"{SF_SMALL}/documents.parquet")
    left = {r.doc_id for r in corpus_pipeline.near_duplicates(spark, docs, SF_SMALL).collect()}
    assert left == {r.component_id for r in QUERIES["op3_simhash"](spark, SF_SMALL).collect()}
    clean = {r.doc_id for r in corpus_pipeline.decontaminate(spark, docs, SF_SMALL).collect()}
    assert clean == {r.doc_id for r in QUERIES["op10_decontaminate"](spark, SF_SMALL).collect() if not r.contaminated}
    calm = {r.doc_id for r in corpus_pipeline.toxicity(spark, docs, SF_SMALL).collect()}
    assert calm == {r.doc_id for r in QUERIES["op7_toxicity"](spark, SF_SMALL).collect() if not r.predicted}
    good = {r.doc_id for r in corpus_pipeline.quality(spark, docs, SF_SMALL).collect()}
    assert good == {r.doc_id for r in QUERIES["op1_quality"](spark, SF_SMALL).collect() if r.selected}


def test_run_applies_all_stages(spark):
    got = corpus_pipeline.run(spark, SF_SMALL)
    docs = spark.read.parquet(f"{SF_SMALL}/documents.parquet")
    assert got.columns == ["doc_id", "n_tokens", "ids_sha256", "decoded_sha256"]
    assert 0 < got.count() < docs.count()
    texts = got.join(docs, "doc_id").select(F.sha2("text", 256).alias("a"), F.col("decoded_sha256").alias("b")).collect()
    assert all(r.a == r.b for r in texts)
