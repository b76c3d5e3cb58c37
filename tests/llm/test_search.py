"""Exact dedup, lexical search and hard negatives against brute force on small odd tables."""

import hashlib
import math
import random
import re

import numpy as np
import pytest
from pyspark.sql import functions as F

from tapeweave.llm import exact_dedup, hard_negatives, lexical

LONG = "xyz" * 3000
TEXTS = [(1, "a"), (2, None), (3, ""), (4, "a"), (9, LONG), (5, LONG + "!"), (6, LONG), (7, " a"), (7, "a"), (7, "a"), (None, "a"),
         (None, "lone"), (8, "A"), (10, LONG[:1024]), (11, LONG[:2048]), (12, LONG[:1025]), (13, "é" * 700), (14, "é" * 700), (15, "é" * 700),
         (16, "\x00"), (17, "\x00\x00"), (18, LONG[:1023] + "y" + LONG[1024:])]


def texts(spark, rows):
    return spark.createDataFrame([(*r, "clash", 1) for r in rows], "doc_id long, text string, row string, name int").repartition(5)


def brute_classes(rows):
    groups = {}
    for d, t in rows:
        groups.setdefault(t or "", []).append(d)
    out = []
    for t, ids in groups.items():
        ids.sort(key=lambda x: (x is not None, x or 0))
        for i, d in enumerate(ids):
            out.append((d, ids[-1], len(ids), i == len(ids) - 1, hashlib.sha256(t.encode()).hexdigest()))
    return sorted(out, key=str)


def found_classes(df):
    return sorted(((r["doc"], r["keep"], r["group_size"], r["kept"], r["text_sha256"]) for r in df.collect()), key=str)


@pytest.mark.parametrize("block", [1, 7, 1024])
def test_exact_classes_equal_brute_force(spark, block):
    rows = TEXTS if block > 1 else [(d, t and t[:90]) for d, t in TEXTS]
    assert found_classes(exact_dedup.classes(texts(spark, rows), block=block)) == brute_classes(rows)


def test_names_are_not_shared_by_blocks_of_one_hash(spark):
    def weak(block, seed):
        return (F.length(block).cast("long"), F.lit(0).cast("long")) if seed < 2 else exact_dedup.block_hashes(block, seed)
    assert found_classes(exact_dedup.classes(texts(spark, TEXTS), block=512, hashes=weak)) == brute_classes(TEXTS)


def test_frequent_texts_are_joined_apart(spark, monkeypatch):
    monkeypatch.setattr(exact_dedup, "HOT", 4)
    rows = [(i, "the same text " * 200 if i % 3 else f"text {i}") for i in range(300)]
    assert found_classes(exact_dedup.classes(texts(spark, rows), block=256)) == brute_classes(rows)


def test_dropped_copies_leave_one_row_with_all_columns(spark):
    left = exact_dedup.drop_copies(texts(spark, TEXTS))
    assert left.columns == ["doc_id", "text", "row", "name"]
    want = [(d, t) for d, t, *_ in {(t or ""): (d, t) for d, t in sorted(TEXTS, key=lambda x: (x[0] is not None, x[0] or 0, x[1] or ""))}.values()]
    assert sorted(str((r["doc_id"], r["text"] or "")) for r in left.collect()) == sorted(str((d, t or "")) for d, t in want)
    assert exact_dedup.drop_copies(texts(spark, [])).count() == exact_dedup.classes(texts(spark, [])).count() == 0


TERM = re.compile("[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+")


def words(t):
    return TERM.findall((t or "").translate(str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")))


def brute_search(docs, items, k):
    lists = [(d, words(t)) for d, t in docs]
    n, total = sum(bool(w) for _, w in lists), sum(len(w) for _, w in lists)
    df = {}
    for _, w in lists:
        for t in set(w):
            df[t] = df.get(t, 0) + 1
    out = []
    for item, text in items:
        scored = []
        for d, w in lists:
            m = 10 + 90 * len(w) * n // max(1, total)
            s = sum(math.floor(1000 * math.log((2 * n + 2) / (2 * df[t] + 1))) * (1_000_000_000 * w.count(t) // (1000 * w.count(t) + 8 * m))
                    for t in set(words(text)) if t in df)
            if s > 0:
                scored.append((-s, d is None, d))
        scored.sort()
        out += [(item, i + 1, d, -s) for i, (s, _, d) in enumerate(scored[:k])]
    return sorted(out, key=str)


def corpus(seed, n):
    rng = random.Random(seed)
    vocabulary = [f"w{i}" for i in range(60)] + ["Straße", "İx", "ÉÀ", "日本", "don't", "a_b", "X9"]
    weights = [1 / (i + 1) for i in range(len(vocabulary))]
    return [(i, " ".join(rng.choices(vocabulary, weights, k=rng.choice([0, 1, 5, 30, 200])))) for i in range(n)]


def collected(df):
    return sorted(((r["item_id"], r["rank"], r["doc_id"], r["score"]) for r in df.collect()), key=str)


@pytest.mark.parametrize("stripe_docs, stripe_points, pairs", [(4096, 1 << 20, 100_000), (3, 1 << 20, 100_000), (64, 50, 20)])
def test_search_equals_brute_force(spark, stripe_docs, stripe_points, pairs):
    docs = corpus(3, 160) + [(500, None), (501, "W0 w0\tW1"), (501, "W0 w0\tW1"), (None, "w0 w3"), (502, ""), (503, "..."), (504, "w5 " * 5000)]
    items = corpus(4, 8) + [(100, "w0 w0 W1 straße"), (101, "nowhere"), (102, None), (103, "w0 日本"), (103, "w2"), (None, "éà x9"),
                             (104, "w1 w7 " + " ".join(f"new{i}" for i in range(300)))]
    df = spark.createDataFrame([(*r, "x") for r in docs], "doc_id long, text string, rows string").repartition(3)
    it = spark.createDataFrame([(*r, 1) for r in items], "item_id long, text string, item int")
    got = lexical.search(df, it, k=7, pairs=pairs, stripe_docs=stripe_docs, stripe_points=stripe_points)
    assert collected(got) == brute_search(docs, items, 7)


def test_search_in_equal_documents_and_empty_tables(spark):
    docs = [(i, "same words here") for i in range(50)] + [(77, "other")]
    df = spark.createDataFrame(docs, "doc_id long, text string")
    items = spark.createDataFrame([(1, "words")], "item_id long, text string")
    assert collected(lexical.search(df, items, stripe_docs=8)) == brute_search(docs, [(1, "words")], 10)
    assert lexical.search(df.limit(0), items).count() == lexical.search(df, items.limit(0)).count() == 0


def brute_negatives(rows, is_anchor, positives=5, negatives=3):
    fine = []
    for d, v, label in rows:
        if d is None or label is None or v is None or any(x is None or not math.isfinite(x) for x in v):
            continue
        q = [math.floor(256 * x) for x in v]
        if sum(x * x for x in q) < 1 << 55:
            fine.append((d, q, label))
    out = []
    for a, q, label in (x for x in fine if is_anchor(x[0])):
        scored = sorted((-sum(x * y for x, y in zip(q, v)), d, other) for d, v, other in fine)
        for s, p in [(s, d) for s, d, other in scored if other == label and d != a][:positives]:
            fit = [(t, d) for t, d, other in scored if other != label and 50 * -s <= 100 * -t <= 95 * -s][:negatives]
            out += [(a, p, i + 1, d, -s, -t) for i, (t, d) in enumerate(fit)]
    return sorted(out)


def vectors(seed, n, dim, centres=6, spread=0.3):
    rng = np.random.default_rng(seed)
    c = rng.standard_normal((centres, dim)) * 2
    return [(i, (c[rng.integers(centres)] + rng.normal(0, spread, dim)).tolist(), int(rng.integers(4))) for i in range(n)]


ODD = [(900, None, 1), (905, [1.0] * 8, None), (910, [None] * 8, 1), (915, [float("nan")] * 8, 1), (920, [float("inf")] * 8, 1),
       (925, [1e12] * 8, 1), (930, [], 2), (935, [1.5] * 3, 2), (940, [0.0] * 8, 0), (None, [1.0] * 8, 1), (945, [-1e-300] * 8, 1),
       (950, [2.0] * 8, 3), (950, [2.0] * 8, 3), (950, [2.0] * 8, 2)]


@pytest.mark.parametrize("rows, setting", [
    (vectors(1, 400, 8) + ODD, {}),
    (vectors(2, 400, 8) + ODD, {"centres": 9, "part": 20}),
    (vectors(3, 300, 16, 40, 0.01), {"centres": 4, "part": 10, "sample": 50}),
    ([(i, [1.0, 2.0], i % 3) for i in range(300)] + vectors(4, 60, 2), {"centres": 5, "part": 30}),
])
def test_negatives_equal_brute_force(spark, rows, setting, monkeypatch):
    monkeypatch.setattr(hard_negatives, "LEAF", 12)
    seen = list({x: None for x in [r[0] for r in rows]})
    rows = [(d if d is None or d >= 900 else seen.index(d) + i // 1000, v, y) for i, (d, v, y) in enumerate(rows)]
    df = spark.createDataFrame([(*r, "x") for r in rows], "vec_id long, embedding array<double>, label int, row string").repartition(4)
    got = hard_negatives.mine(hard_negatives.quantised(df), F.col("id") % 5 == 0, **setting)
    names = ["anchor_id", "positive_id", "rank", "negative_id", "positive_score", "negative_score"]
    assert sorted(tuple(r[c] for c in names) for r in got.collect()) == brute_negatives(rows, lambda d: d % 5 == 0)


def test_negatives_of_an_empty_table(spark):
    df = spark.createDataFrame([], "vec_id long, embedding array<float>, label int")
    assert hard_negatives.mine(hard_negatives.quantised(df), F.col("id") % 5 == 0).count() == 0


def test_bounds_hold_for_all_below(spark):
    rng = np.random.default_rng(8)
    v = rng.integers(-500, 500, (600, 12))
    norm = float((v * v).sum(1).max())
    tree = hard_negatives.CoverTree(v, np.arange(600), np.arange(600), rng.integers(0, 3, 600), norm)
    assert tree.leaf.sum() > 10 and sorted(tree.ids) == list(range(600))
    q = rng.integers(-500, 500, (20, 12))

    def below(node):
        if tree.leaf[node]:
            return list(range(tree.begin[node], tree.end[node]))
        return [x for child in range(tree.begin[node], tree.end[node]) for x in below(child)]
    least, most = hard_negatives.bounds((q @ tree.centre.T).astype(float), (q * q).sum(1).astype(float), tree.radius, norm)
    for node in range(len(tree.leaf)):
        products = q @ tree.v[below(node)].T
        assert (products.min(1) >= least[:, node]).all() and (products.max(1) <= most[:, node]).all()
