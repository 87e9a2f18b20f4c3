"""Fingerprints, near-duplicates, BPE, licenses and decontamination against brute force."""

from __future__ import annotations

import hashlib
import math
import random
import re

import numpy as np
import pyarrow as pa
import pytest
import xxhash
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from roadstats.llm import bpe, decontaminate, licenses, simhash, syncmers
from roadstats.llm import words as w
from tests.conftest import SF_SMALL
from tests.llm.conftest import lower, words


# --- words ------------------------------------------------------------------------------------


@settings(max_examples=80, deadline=None)
@given(st.lists(st.text(alphabet="aB1 .-é\x00日", max_size=30), max_size=12), st.sampled_from([4, 16, 1 << 20]))
def test_split_words(texts, piece):
    before, w.PIECE = w.PIECE, piece
    try:
        found = []
        for group in w.split_words(pa.array([*texts, None], pa.string())):
            at = group.bounds()
            for r in range(len(group.counts)):
                found.append([bytes(group.low[a:b]).decode() for a, b in zip(group.starts[at[r] : at[r + 1]], group.ends[at[r] : at[r + 1]])])
        assert found == [words(t) for t in [*texts, None]]
    finally:
        w.PIECE = before


def test_equal_words_hash_alike():
    (group,) = w.split_words(pa.array(["one two ONE", "zwei one"]))
    h = group.hashes
    assert h[0] == h[2] == h[4] and len(set(h.tolist())) == 3


# --- 2: closed syncmers -----------------------------------------------------------------------


def _syncmers(text: str, hash_words, hash_runs) -> list[int]:
    """Positions of closed syncmers by definition."""
    tokens = re.sub(syncmers.CJK, r" \1 ", text).split()
    k, s = syncmers.K, syncmers.S
    found = []
    for i in range(len(tokens) - k + 1):
        runs = [hash_runs(tokens[i + j : i + j + s]) for j in range(k - s + 1)]
        if min(runs[0], runs[-1]) <= min(runs):
            found.append(i)
    return found


def test_syncmers_by_definition(spark, small):
    df, docs = small
    place = F.transform(syncmers.anchors(F.col("text")), lambda a: a.bitwiseAND(F.lit(syncmers.MAX_POSITION).cast("bigint")))
    found = {r.doc_id: r.p for r in df.select("doc_id", place.alias("p")).collect()}
    tokens = sorted({t for _, x in docs for t in x.split()})
    one = {r.t: r.h for r in spark.createDataFrame([(t,) for t in tokens], "t string").select("t", F.xxhash64("t").alias("h")).collect()}
    runs = sorted({tuple(x.split()[i : i + 2]) for _, x in docs for i in range(len(x.split()) - 1)})
    pairs = spark.createDataFrame([(one[a], one[b], a, b) for a, b in runs], "x bigint, y bigint, a string, b string")
    two = {(r.a, r.b): r.h for r in pairs.select("a", "b", F.xxhash64("x", "y").alias("h")).collect()}
    for i, text in docs:
        if len(text.split()) >= syncmers.K:
            assert found[i] == _syncmers(text, one.get, lambda run: two[tuple(run)])


def test_op2_edits_and_likeness(spark, small):
    _, docs = small
    got = {r.doc_id: r for r in syncmers.op2_syncmers(spark, SF_SMALL).collect()}
    assert sorted(got) == [i for i, _ in docs]
    for n, (i, text) in enumerate(docs):
        after, half = docs[(n + 1) % len(docs)][1], len(text) // 2
        edit = text[: len(text) - half] + after[:half]
        assert (got[i].n_chars, got[i].edited_sha256) == (len(text), hashlib.sha256(edit.encode()).hexdigest())
        assert 0 <= got[i].near_next <= 1 and 0 <= got[i].near_edited <= 1
    by_text = {}
    for i, text in docs:
        assert by_text.setdefault(text, got[i].fingerprint) == got[i].fingerprint
    near = np.array([(got[i].near_edited, got[i].near_next) for i, _ in docs])
    assert 0.35 < near[:, 0].mean() < 0.65 and near[:, 1].mean() < 0.05
    assert (near[:, 0] > near[:, 1]).mean() > 0.95


@pytest.mark.parametrize("range_bytes", [1, 3000, 1 << 40])
def test_next_texts_in_ranges(small, range_bytes):
    df, docs = small
    got = {r.doc_id: r.next_text for r in syncmers.next_texts(df.select("doc_id", "text"), ["text"], range_bytes).collect()}
    assert got == {i: docs[(n + 1) % len(docs)][1] for n, (i, _) in enumerate(docs)}


def test_syncmers_match_moved_text(spark):
    a = " ".join(f"w{n}" for n in range(400))
    row = spark.createDataFrame([(a, "new words come first " + a)], "a string, b string")
    fa, fb = (syncmers.sketch(syncmers.anchors(F.col(c))) for c in "ab")
    got = row.select(syncmers.matches(fa, fb).alias("m"), syncmers.likeness(fa, fb).alias("near"), syncmers.likeness(fa, fa).alias("same")).first()
    assert {m["b"] - m["a"] for m in got.m} == {4} and got.near > 0.9 and got.same == 1.0


def test_fingerprints_hold_every_syncmer(spark):
    rng = np.random.default_rng(5)
    a = [f"w{n}" for n in rng.integers(0, 10**9, 20_000)]
    b = [f"w{n}" for n in rng.integers(0, 10**9, 20_000)]
    b[7_000:7_050] = a[12_000:12_050]
    edit = a[:9_000] + ["other"] + a[9_001:]
    rows = [(" ".join(a), " ".join(b)), (" ".join(a), " ".join(edit)), ("x y x y x y z x y x y q", "x y x y x y"), ("", "a b"), ("", "")]
    df = spark.createDataFrame([(n, *r) for n, r in enumerate(rows)], "n int, a string, b string")
    fa, fb = (syncmers.sketch(syncmers.anchors(F.col(c))) for c in "ab")
    made = df.select("n", syncmers.anchors(F.col("a")).alias("all"), fa.alias("fa"), fb.alias("fb"))
    last = F.array_max(F.transform(syncmers.matches(F.col("fa"), F.col("fb")), lambda m: m["a"]))
    got = made.select("*", syncmers.matches(F.col("fa"), F.col("fb")).alias("m"), syncmers.likeness(F.col("fa"), F.col("fb")).alias("near"), last.alias("last"))
    got = got.orderBy("n").collect()
    place = lambda x: x & syncmers.MAX_POSITION
    for r in got:
        assert r.fa == sorted(r["all"])
        x, y = {v >> 24 for v in r.fa}, {v >> 24 for v in r.fb}
        assert r.near == (2 * len(x & y) / (len(x) + len(y)) if x or y else 1.0)
        pairs = sorted((u >> 24, place(u), place(v)) for u in r.fa for v in r.fb if u >> 24 == v >> 24) if r.n > 1 else None
        assert pairs is None or sorted((m["hash"], m["a"], m["b"]) for m in r.m) == pairs
    assert sum(m["a"] - m["b"] == 5_000 for m in got[0].m) > 20 and 0.99 < got[1].near < 1


def test_last_match(spark, small):
    df, docs = small
    fa, fb = (syncmers.sketch(syncmers.anchors(c)) for c in (F.col("text"), F.reverse("text")))
    made = df.select(fa.alias("a"), fb.alias("b")).union(df.select(fa.alias("a"), F.slice(fa, 1, 5).alias("b")))
    for r in made.select("a", "b", syncmers.last_match(F.col("a"), F.col("b")).alias("last")).collect():
        held = {x >> 24 for x in r.b}
        assert r.last == max((x & syncmers.MAX_POSITION for x in r.a if x >> 24 in held), default=None)


# --- 3: SimHash -------------------------------------------------------------------------------


def _simhash(text: str) -> int:
    tokens = re.findall(r"[^\x20\x09-\x0D]+", lower(text))
    if not tokens:
        return 0
    shingles = [" ".join(tokens[i : i + 3]) for i in range(max(1, len(tokens) - 2))]
    hashes = [xxhash.xxh64_intdigest(s.encode(), 42) for s in shingles]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def _components(fps: dict) -> dict:
    parent = {i: i for i in fps}

    def find(x):
        while parent[x] != x:
            x = parent[x]
        return x

    ids = sorted(fps)
    for n, a in enumerate(ids):
        for b in ids[n + 1 :]:
            if (fps[a] ^ fps[b]).bit_count() <= 2:
                x, y = find(a), find(b)
                parent[max(x, y)] = min(x, y)
    return {i: find(i) for i in ids}


def test_op3_against_all_pairs(spark, small):
    _, docs = small
    got = {r.doc_id: r for r in simhash.op3_simhash(spark, SF_SMALL).collect()}
    fps = {i: _simhash(t) for i, t in docs}
    assert {i: got[i].fingerprint for i in got} == {i: f"{f:016x}" for i, f in fps.items()}
    assert {i: got[i].component_id for i in got} == _components(fps)


@pytest.mark.parametrize("levels", [4, 8, 16])
@pytest.mark.parametrize("shard_rows", [3, 20_000])
def test_links_are_exact(spark, monkeypatch, levels, shard_rows):
    rng = np.random.default_rng(levels)
    centres = rng.integers(0, 1 << 63, 40, dtype=np.uint64)
    fps = {int(c) for c in centres}
    for c in centres[:25].tolist():  # chains and balls of close values around some
        for _ in range(12):
            flips = rng.integers(0, 64, rng.integers(1, 4))
            c2 = c
            for b in flips.tolist():
                c2 ^= 1 << b
            fps.add(c2)
            c = c2 if rng.random() < 0.5 else c
    monkeypatch.setattr(simhash, "LEVELS", ((float("inf"), levels),))
    signed = [(int(np.uint64(f).view(np.int64)),) for f in fps]
    df = spark.createDataFrame(signed, "fp bigint")
    links = simhash.links(df, len(signed), shard_rows=shard_rows)
    roots = {r.node: r.root for r in simhash.components(links).collect()}
    expected = _components({s[0]: s[0] & (1 << 64) - 1 for s in signed})
    groups = lambda of: sorted(sorted(k for k in of if of[k] == g) for g in set(of.values()))
    assert groups({s[0]: roots.get(s[0], s[0]) for s in signed}) == groups(expected)


def test_components_of_a_long_chain(spark):
    edges = spark.createDataFrame([(n, n + 1) for n in range(60)] + [(100, 101), (7, 7)], "a bigint, b bigint")
    got = {r.node: r.root for r in simhash.components(edges).collect()}
    assert got == {**{n: 0 for n in range(1, 61)}, 101: 100}


# --- 4: BPE -----------------------------------------------------------------------------------


@pytest.fixture(scope="module")
def tokenizer():
    tokenizers = pytest.importorskip("tokenizers")
    found = tokenizers.Tokenizer.from_file(bpe.default_vocabulary())
    found.no_truncation()
    found.no_padding()
    return found


@pytest.fixture(scope="module")
def encoder():
    return bpe.Bpe(bpe._read_vocabulary(bpe.default_vocabulary()), cached=200)


@settings(max_examples=300, deadline=None)
@given(text=st.one_of(st.text(max_size=200), st.text(alphabet=" \n\t　aéB1½!'.s日\x85\xa0<|endoftext|>", max_size=80)))
def test_encode_like_the_tokenizers_library(tokenizer, encoder, text):
    text = text.encode("utf-8", "ignore").decode()
    ids = encoder.encode(text)
    assert ids == tokenizer.encode(text, add_special_tokens=False).ids
    assert encoder.decode(ids) == tokenizer.decode(ids, skip_special_tokens=False) == text


@pytest.mark.parametrize("text", ["<|endoftext|>a<|endoftext|><|endof", "é" * 900, "ab" * 2000, "a" * 5000, " " * 3000, "it's  we'LL\n\n x"])
def test_long_words_and_special_tokens(tokenizer, encoder, text):
    assert encoder.encode(text) == tokenizer.encode(text, add_special_tokens=False).ids


def test_op4_round_trip(spark, small, tokenizer):
    _, docs = small
    got = {r.doc_id: r for r in bpe.op4_bpe(spark, SF_SMALL).collect()}
    assert len(got) == len(docs)
    for i, text in docs:
        ids = tokenizer.encode(text, add_special_tokens=False).ids
        sha = lambda x: hashlib.sha256(x.encode()).hexdigest()
        assert tuple(got[i]) == (i, len(ids), sha(",".join(map(str, ids))), sha(tokenizer.decode(ids, skip_special_tokens=False)))


def test_encode_then_decode_tables(small):
    df, docs = small
    encoded = bpe.encode(df, bpe.default_vocabulary())
    back = bpe.decode(encoded, bpe.default_vocabulary())
    assert sorted(map(tuple, back.collect())) == docs


# --- 5: licenses ------------------------------------------------------------------------------


def _licenses(text: str):
    tokens, places, labels = words(text), [], {}
    for phrase, label in licenses.PHRASES.items():
        part = phrase.split(" ")
        places += [(i, label) for i in range(len(tokens) - len(part) + 1) if tokens[i : i + len(part)] == part]
    pieces = re.split(licenses.SEPARATORS, lower(text))
    wanted = {label: set(licenses.template_words(template)) for label, template in licenses.TEMPLATES.items()}
    for b in range(0, max(len(pieces) - (licenses.BLOCK - licenses.STEP), 1), licenses.STEP):
        block = set(pieces[b : b + licenses.BLOCK])
        for label, own in wanted.items():
            if len(block & own) >= licenses.needed(len(own), licenses.CONTAINMENT):
                labels[label] = max(labels.get(label, 0), len(block & own) / len(own))
    at, base = [i for i, _ in places], {label for _, label in places}
    score = 1.0 if places else max(labels.values(), default=0.0)
    return len(tokens), len(places), min(at, default=None), max(at, default=None), ",".join(sorted(base)), ",".join(sorted(base | set(labels))), score


def test_op5_against_brute_force(spark, work):
    texts = [
        "Licensed under CC BY-NC 4.0. x", "(c) All rights reserved! all-rights reserved", "general public license", "GENERAL\nPUBLIC\nLICENSE",
        "filler " * 40 + "This work is licensed under the GNU General Public License, version 3." + " tail" * 50,
        "filler " * 7 + "Released under the MIT License", "the of and to", "Kelvin KMIT released license", "İ cc by", ".all rights reserved.", "", None,
        "redistribution of the source in binary forms without modification is permitted for any use", "ally rights reserved", "cc bye",
    ]
    docs = [(r.doc_id, r.text) for r in spark.read.parquet(f"{SF_SMALL}/documents.parquet").collect()] + [(10_000 + n, t) for n, t in enumerate(texts)]
    spark.createDataFrame(docs, "doc_id bigint, text string").write.parquet(f"{work}/documents.parquet")
    got = {r.doc_id: tuple(r)[1:] for r in licenses.op5_licenses(spark, work).collect()}
    for i, text in docs:
        found, expected = got[i], _licenses(text or "")
        assert found[:6] == expected[:6] and math.isclose(found[6], expected[6], abs_tol=1e-12), (text, found, expected)


def test_blocks_begin_at_every_word(spark):
    cut = "x " * 15 + "cc " + "x " * 5 + "sa x 4 " + "x " * 8 + "0" + " x" * 40
    body = licenses.TEMPLATES["mit-text"]
    terms = {**licenses.TEMPLATES, "long": " ".join(f"term{n}" for n in range(400))}
    texts = [cut, "pad " * 70 + body + " tail" * 50, terms["long"], " ".join(w + " z z" for w in terms["long"].split(" ")), "term1 " * 400 + "mit", "cc sa 4 " + "cc " * 31 + "0"]
    texts += ["pad " * 90 + licenses.TEMPLATES[label] + " tail" * 90 for label in ("mit-body", "bsd-3-body", "isc-body", "gpl-3.0-notice")]
    docs = spark.createDataFrame(list(enumerate(texts)) + [(0, cut)], "doc_id bigint, text string")
    got = {r.doc_id: {f["label"]: f["contained"] for f in r.found} for r in licenses.find_licenses(docs, templates=terms).collect()}
    for n, text in enumerate(texts):
        pieces, expected = re.split(licenses.SEPARATORS, lower(text)), {}
        for label, template in terms.items():
            own, span = set(licenses.template_words(template)), licenses.span_of(template)
            best = max(len(own.intersection(pieces[b : b + span])) for b in range(len(pieces)))
            if best >= licenses.needed(len(own), licenses.CONTAINMENT):
                expected[label] = best / len(own)
        assert got[n] == expected, (n, got[n], expected)
    assert "cc-by-sa-4.0" in got[0] and {"mit-grant", "mit-text"} <= set(got[1]) and got[2] == {"long": 1.0} and got[3] == {}
    assert {"mit-grant", "mit-text", "mit-body"} <= set(got[6]) and {"bsd-2-text", "bsd-2-body", "bsd-3-body"} <= set(got[7])
    assert "isc-body" in got[8] and "gpl-3.0-notice" in got[9]


def test_positional_filter_leaves_fewer_candidates(spark):
    rng = random.Random(5)
    sets = [licenses.template_words(t) for t in licenses.TEMPLATES.values()]
    vocabulary = sorted({w for own in sets for w in own})
    number = {w: n for n, w in enumerate(vocabulary, 1)}
    templates = [[number[w] for w in own] for own in sets]
    needs = [licenses.needed(len(own), licenses.CONTAINMENT) for own in templates]
    texts = [rng.sample(range(1, len(vocabulary) + 1), rng.randint(1, 40)) for _ in range(300)]
    texts += [rng.sample(own, len(own) - rng.randint(0, 2)) + rng.sample(range(1, len(vocabulary) + 1), 3) for own in templates for _ in range(5)]
    rows = [(n, n, [w << 32 | at for at, w in enumerate(text)]) for n, text in enumerate(texts)]
    own = licenses.own_words(spark.createDataFrame(rows, "doc_id bigint, text_key bigint, tokens array<bigint>"))
    order = licenses.global_order(own, len(vocabulary))
    left = [{(r.doc_id, n) for r in licenses.candidates(own, order, templates, needs, p).collect() for n in r.met} for p in (True, False)]
    true = {(i, n) for i, text in enumerate(texts) for n, words_of in enumerate(templates) if len(set(words_of).intersection(text)) >= needs[n]}
    rank = {w: place for place, w in enumerate(order)}
    for positional, found in zip((True, False), left):  # the filters as they are defined, pair by pair
        expected = set()
        for i, text in enumerate(texts):
            have = sorted(rank[w] for w in set(text))
            for n, words_of in enumerate(templates):
                prefix = sorted(rank[w] for w in words_of)[: len(words_of) - needs[n] + 1]
                shared = [at for at, place in enumerate(have) if place in prefix]
                if shared and len(have) - (shared[0] if positional else 0) >= needs[n]:
                    expected.add((i, n))
        assert found == expected
    assert true and true <= left[0] < left[1]


# --- 10: decontamination ----------------------------------------------------------------------


def _hits(text: str, items) -> tuple:
    tokens, hit, found = words(text), set(), set()
    for item, item_text in items:
        own = words(item_text)
        n = min(10, len(own))
        for k in range(len(own) - n + 1) if n else ():
            for i in range(len(tokens) - n + 1):
                if tokens[i : i + n] == own[k : k + n]:
                    hit.update(range(i, i + n))
                    if item is not None:
                        found.add(item)
    ids = ",".join(sorted(map(str, found)))
    return len(tokens), len(hit), len(found), hashlib.sha256(ids.encode()).hexdigest(), len(hit) > 0


@pytest.mark.parametrize("block_windows", [3, decontaminate.BLOCK_WINDOWS])
def test_find_benchmark_against_brute_force(spark, block_windows, monkeypatch):
    monkeypatch.setattr(decontaminate, "HANDED", 2)  # windows of one item in several batches
    ten = "one two three four five six seven eight nine ten"
    items = [(1, ten + " eleven"), (2, ten.upper()), (2, ten), (10, "solo"), (11, "two words"), (12, ""), (13, None), (None, "null id item"), (14, "a b a b a b a b a b a b")]
    texts = [
        None, "", "solo", "x solo, solo x", ten, f"zero {ten} eleven twelve", ten.replace(" ", "\n-- "), ten.replace("ten", "tent"),
        "two words two words two", "null id item", "a b " * 9, "b a " * 9, "nine ten one two three four five six seven eight", f"{ten} {ten}", "two", "one " + ten,
    ]
    docs = spark.createDataFrame(list(enumerate(texts)) + [(3, texts[3])], "doc_id bigint, text string")
    benchmark = spark.createDataFrame(items, "item_id bigint, text string")
    got = sorted(map(tuple, decontaminate.digest(decontaminate.find_benchmark(docs, benchmark, block_windows=block_windows)).collect()))
    assert got == sorted([(i, *_hits(t or "", items)) for i, t in enumerate(texts)] + [(3, *_hits(texts[3], items))])
    kept = sorted(r.doc_id for r in decontaminate.clean_documents(docs, benchmark, block_windows=block_windows).collect())
    assert kept == [i for i, t in enumerate(texts) if not _hits(t or "", items)[4]]


def test_op10_against_brute_force(spark, small):
    _, docs = small
    items = [(r.item_id, r.text) for r in spark.read.parquet(f"{SF_SMALL}/benchmark.parquet").collect()]
    windows: dict[tuple, set] = {}
    for item, text in items:
        own = words(text)
        for k in range(len(own) - 9):
            windows.setdefault(tuple(own[k : k + 10]), set()).add(item)
    got = {r.doc_id: tuple(r)[1:] for r in decontaminate.op10_decontaminate(spark, SF_SMALL).collect()}
    for i, text in docs:
        tokens = words(text)
        at = [k for k in range(len(tokens) - 9) if tuple(tokens[k : k + 10]) in windows]
        found = set().union(*[windows[tuple(tokens[k : k + 10])] for k in at]) if at else set()
        hit = {n for k in at for n in range(k, k + 10)}
        sha = hashlib.sha256(",".join(sorted(map(str, found))).encode()).hexdigest()
        assert got[i] == (len(tokens), len(hit), len(found), sha, bool(hit))
    assert any(g[4] for g in got.values())


def test_decontaminate_without_items(spark, small):
    df, _ = small
    none = spark.createDataFrame([], "item_id bigint, text string")
    assert decontaminate.clean_documents(df, none).count() == df.count()
    assert decontaminate.digest(decontaminate.find_benchmark(df, none)).where("contaminated").count() == 0
