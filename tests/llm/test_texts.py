"""Line dedup, Jaccard join, repeats and decontamination against brute force on small tables."""

import hashlib
import random
import re

import numpy as np
import pytest

from tapeweave.llm import decontaminate, jaccard, line_dedup, repeats
from tapeweave.llm.queries import QUERIES

SCHEMA = "doc_id long, text string, row string, n int, h string, key string"


def frame(spark, rows):
    """Documents with extra columns of names that operators use inside."""
    return spark.createDataFrame([(i, t, "x", 1, None, "k") for i, t in rows], SCHEMA)


def texts(seed, n):
    """Documents with copies, near copies, shared passages, short and empty ones."""
    rng = random.Random(seed)
    words = ["".join(rng.choice("abcdefgh") for _ in range(rng.randrange(1, 6))) for _ in range(300)]
    passage = " ".join(rng.choice(words) for _ in range(70))
    out = []
    for i in range(n):
        kind = rng.random()
        body = [rng.choice(words) for _ in range(rng.choice([0, 1, 3, 30, 120, 300]))]
        if kind < 0.35 and out:
            body = (rng.choice(out)[1] or "").split(" ")
            for _ in range(rng.randrange(0, 4)):
                body[rng.randrange(len(body))] = rng.choice(words)
        text = " ".join(body)
        if kind > 0.8:
            text += "\n" + passage + "\n" + text[:50]
        out.append((i, rng.choice([text, text.replace(" ", "\n", 3), text.upper()])))
    return [*out, (n, None), (n + 1, ""), (n + 2, " \n\t"), (None, out[0][1]), (3, out[3][1]), (4, "other words here")]


# --- line dedup


def test_line_dedup_equals_brute_force(spark):
    rows = texts(1, 60) + [(200, "A long line here\n\nshort\nA LONG line here \nlast"), (201, "a long line here\r\nshort")]
    got = {(r["doc_id"], r["n_lines"], r["n_dropped"], r["text"]) for r in line_dedup.dedup_lines(frame(spark, rows)).collect()}

    def key(line):
        line = line.strip(" \t\n\x0b\x0c\r")
        return re.sub("[A-Z]", lambda m: m[0].lower(), line)

    first = {}
    for i, t in rows:
        for line in (t or "").split("\n"):
            if i is not None and len(key(line)) >= 10:
                first[key(line)] = min(i, first.get(key(line), i))
    want = set()
    for i, t in rows:
        lines = (t or "").split("\n")
        kept = [x for x in lines if i is None or len(key(x)) < 10 or first[key(x)] == i]
        want.add((i, len(lines), len(lines) - len(kept), t if len(kept) == len(lines) else "\n".join(kept)))
    assert got == want


def test_line_dedup_of_a_line_in_every_document_and_a_long_text(spark):
    line = "the same line everywhere"
    rows = [(i, f"{line}\nown {i} own {i} own") for i in range(300)] + [(1000, "\n".join([line] * 5000))]
    got = {r["doc_id"]: r for r in line_dedup.dedup_lines(frame(spark, rows)).collect()}
    assert got[0]["n_dropped"] == 0 and all(got[i]["n_dropped"] == 1 for i in range(1, 300))
    assert got[1000]["text"] == "" and got[1000]["n_dropped"] == 5000


@pytest.mark.parametrize("run", [
    line_dedup.dedup_lines, jaccard.cluster, repeats.remove,
    lambda d: decontaminate.mark(d, d.sparkSession.createDataFrame([(1, "some passage of a test")], "item_id long, text string"))])
def test_empty_table(spark, run):
    assert run(frame(spark, [])).count() == 0


# --- Jaccard join


def brute_components(sets, num, den):
    up = {i: i for i in sets}

    def top(x):
        while up[x] != x:
            x = up[x]
        return x
    ids = list(sets)
    for k, a in enumerate(ids):
        for b in ids[k + 1:]:
            both = len(sets[a] & sets[b])
            if sets[a] and sets[b] and den * both >= num * (len(sets[a]) + len(sets[b]) - both):
                x, y = top(a), top(b)
                up[max(x, y)] = min(x, y)
    return {i: top(i) for i in ids}


def shingles(text, k):
    w = re.findall(r"[^\x20\x09-\x0D]+", re.sub("[A-Z]", lambda m: m[0].lower(), text or ""))
    return {tuple(w[i:i + k]) for i in range(len(w) - k + 1)} if len(w) >= k else ({tuple(w)} if w else set())


@pytest.mark.parametrize("seed, words, num, frequent, block", [(2, 4, 85, 64, 192), (3, 5, 80, 2, 3), (4, 1, 60, 1, 2), (5, 2, 70, 0, 4)])
def test_jaccard_equals_brute_force(spark, seed, words, num, frequent, block):
    rows = [(i, t) for i, t in texts(seed, 90) if i is not None]
    rows = rows[:-2]  # ids of their own
    sets = {i: shingles(t, words) for i, t in rows}
    want = {(i, len(sets[i]), c) for i, c in brute_components(sets, num, 100).items()}
    got = jaccard.cluster(frame(spark, rows), words=words, num=num, den=100, frequent=frequent, block=block)
    assert {tuple(r) for r in got.collect()} == want


def test_jaccard_with_more_frequent_shingles_than_are_broadcast(spark, monkeypatch):
    monkeypatch.setattr(jaccard, "SMALL", 0)
    rows = [(i, t) for i, t in texts(6, 90) if i is not None][:-2]
    sets = {i: shingles(t, 2) for i, t in rows}
    want = {(i, len(sets[i]), c) for i, c in brute_components(sets, 70, 100).items()}
    got = jaccard.cluster(frame(spark, rows), words=2, num=70, den=100, frequent=1, block=4)
    assert {tuple(r) for r in got.collect()} == want


def test_parity_never_rules_out_what_is_similar():
    rng = np.random.default_rng(3)
    for size in (1, 40, 900, 5000):
        a = np.unique(rng.integers(-2 ** 62, 2 ** 62, size))
        for kept in (0.2, 0.8, 0.97, 1.0):
            b = np.unique(np.concatenate([a[rng.random(len(a)) < kept], rng.integers(-2 ** 62, 2 ** 62, size // 20)]))
            differ = int(np.bitwise_count(jaccard.parity(a).view(np.uint64) ^ jaccard.parity(b).view(np.uint64)).sum())
            assert differ <= len(np.setxor1d(a, b))


def test_jaccard_repeated_and_null_ids(spark):
    got = jaccard.cluster(frame(spark, [(5, "a b c d e f"), (5, "a b c d e f"), (7, "A B c d e f"), (None, "a b c d e f"),
                                        (9, None), (9, "")])).collect()
    assert sorted((r["doc"], r["component_id"]) for r in got if r["doc"] is not None) == [(5, 5), (5, 5), (7, 5), (9, 9), (9, 9)]
    assert [r["component_id"] for r in got if r["doc"] is None] == [None]


def test_jaccard_of_repeated_rows_with_frequent_shingles(spark):
    rng = random.Random(11)
    rows = []
    for pair in range(12):
        body = [f"w{rng.randrange(10 ** 6)}" for _ in range(104)]
        near = list(body)
        near[20], near[60] = "x", "y"  # ten shingles each: similarity 90 / 110
        rows += [(2 * pair, " ".join(body))] * 8 + [(2 * pair + 1, " ".join(near))] * 8
    got = jaccard.cluster(frame(spark, rows), words=5, num=80, den=100, frequent=1).collect()
    assert len(got) == len(rows)
    assert {(r["doc"], r["component_id"]) for r in got} == {(i, i // 2 * 2) for i in range(24)}


def test_jaccard_of_different_texts_of_one_id(spark):
    rng = random.Random(12)
    one, two, three = (" ".join(f"w{rng.randrange(10 ** 6)}" for _ in range(104)) for _ in range(3))
    rows = [(1, one), (2, two), (5, one), (5, two), (7, two + " end"), (7, three), (8, three + " end"), (9, "something else")]
    got = jaccard.cluster(frame(spark, rows * 3), words=5, num=80, den=100, frequent=1).collect()
    assert sorted((r["doc"], r["component_id"]) for r in got) == sorted([(i, 9 if i == 9 else 1) for i, _ in rows] * 3)


@pytest.mark.parametrize("known", [1.0, 0.6])
@pytest.mark.parametrize("sides", [False, True])
def test_trie_finds_what_it_should(known, sides):
    rng = random.Random(6)
    sets = [sorted(rng.sample(range(30), rng.randrange(1, 20))) for _ in range(150)]
    sets += sets[:5]
    begin = [np.array(s[:max(1, int(known * len(s)))]) for s in sets]
    trie = jaccard.Trie(begin, np.array([len(s) for s in sets]), 6, 10)
    side = np.array([i % 3 == 0 for i in range(len(sets))])
    found = list(trie.similar(side, ~side) if sides else trie.similar())
    got = [tuple(sorted((one, int(o)))) for one, others in found for o in others]
    want = {(i, j) for i, s in enumerate(sets) for j, o in enumerate(sets) if i < j and (not sides or side[i] != side[j])
            and 10 * len({*s} & {*o}) >= 6 * len({*s} | {*o})}
    assert len(got) == len(set(got)) and set(got) >= want and len(got) < 150 * 150 / 4
    if known == 1:
        assert set(got) == want


def test_jaccard_of_an_id_with_and_without_words(spark):
    rng = random.Random(13)
    body = " ".join(f"w{rng.randrange(10 ** 6)}" for _ in range(60))
    got = jaccard.cluster(frame(spark, [(1, body), (5, body + " end"), (5, None), (6, ""), (6, None), (7, body)]), words=5, num=80, den=100)
    assert sorted((r["doc"], r["n_shingles"], r["component_id"]) for r in got.collect()) == [
        (1, 56, 1), (5, 0, 1), (5, 57, 1), (6, 0, 6), (6, 0, 6), (7, 56, 1)]


# --- repeats


def brute_removed(rows, window):
    seen = {}
    data = [(t or "").encode() for _, t in rows]
    for b in data:
        for k in range(len(b) - window + 1):
            seen[b[k:k + window]] = seen.get(b[k:k + window], 0) + 1
    out = []
    for b in data:
        gone = set()
        for k in range(len(b) - window + 1):
            if seen[b[k:k + window]] > 1:
                gone.update(range(k, k + window))
        out.append(bytes(x for i, x in enumerate(b) if i not in gone))
    return out


@pytest.mark.parametrize("seed, window, gram, limit", [(7, 200, 96, 1 << 20), (8, 40, 12, 3000), (9, 25, 25, 100), (10, 60, 30, 1)])
def test_repeats_equal_brute_force(spark, seed, window, gram, limit):
    rows = texts(seed, 60) + [(500, "ab" * 400), (501, "é" * 300 + "x"), (502, "é" * 150)]
    got = repeats.remove(frame(spark, rows), window=window, gram=gram, limit=limit).collect()
    want = brute_removed(rows, window)
    assert sorted((r["doc_id"] is None, r["doc_id"] or 0, r["n_bytes"], bytes(r["kept"])) for r in got) == \
        sorted((i is None, i or 0, len((t or "").encode()), k) for (i, t), k in zip(rows, want))
    assert all(r["n_bytes"] - len(r["kept"]) == sum(s["end"] - s["start"] for s in r["removed"]) for r in got)


def test_run_index_matches():
    rng = random.Random(11)
    for _ in range(40):
        strings = ["".join(rng.choice("ab") for _ in range(rng.randrange(1, 30))).encode() for _ in range(4)]
        index = repeats.RunIndex(strings)
        got = index.matches()
        places = [(k, i) for k, s in enumerate(strings) for i in range(len(s))]
        for k, i in places:
            best = 0
            for other in places:
                x, y = strings[k][i:], strings[other[0]][other[1]:]
                if other != (k, i):
                    best = max(best, next((n for n, (a, b) in enumerate(zip(x, y)) if a != b), min(len(x), len(y))))
            assert got[index.starts[k] + i] == best


def test_repeats_query_equals_brute_force(spark, sf_dir):
    rows = [tuple(r) for r in spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text").collect()]
    want = {i: hashlib.sha256(k).hexdigest() for (i, _), k in zip(rows, brute_removed(rows, 200))}
    got = {r["doc_id"]: r["kept_sha256"] for r in QUERIES["op9_repeats"](spark, sf_dir).collect()}
    assert got == want


# --- decontamination


def edited(rng, text, k):
    out = list(text)
    for _ in range(k):
        at = rng.randrange(len(out))
        kind = rng.random()
        if kind < 0.33:
            out[at] = rng.choice("xyz")
        elif kind < 0.66:
            out.insert(at, rng.choice("xyz"))
        else:
            del out[at]
    return "".join(out)


def distance_inside(item, text):
    """Least edits between ``item`` and any part of ``text``."""
    row = [0] * (len(text) + 1)
    for i, c in enumerate(item, 1):
        new = [i]
        for j, d in enumerate(text, 1):
            new.append(min(row[j] + 1, new[j - 1] + 1, row[j - 1] + (c != d)))
        row = new
    return min(row)


def test_decontamination_finds_every_passage_within_the_budget(spark):
    rng = random.Random(12)
    items = [(k, " ".join("".join(rng.choice("abcdefghijkl") for _ in range(rng.randrange(2, 8))) for _ in range(rng.randrange(8, 40))))
             for k in range(12)] + [(50, "tiny"), (51, None), (52, "")]
    rows, planted = [], set()
    for i in range(80):
        body = " ".join("".join(rng.choice("abcdefghijkl") for _ in range(rng.randrange(2, 8))) for _ in range(rng.randrange(0, 150)))
        if i % 2:
            k, t = items[rng.randrange(12)]
            at = rng.choice([0, len(body), rng.randrange(len(body) + 1)])
            body = body[:at] + edited(rng, t.upper() if i % 4 == 1 else t, rng.randrange(decontaminate.budget(len(t)) + 1)) + body[at:]
            planted.add((i, k))
        rows.append((i, body))
    rows += [(100, None), (101, ""), (102, "a Tiny thing"), (103, "ti\nny"), (None, items[0][1])]
    bench = spark.createDataFrame(items, "item_id long, text string")
    out = decontaminate.mark(frame(spark, rows), bench).collect()
    assert len(out) == len(rows)
    got = {(r["doc_id"], s["item_id"]): s for r in out for s in r["spans"]}
    assert planted | {(102, 50), (None, 0)} <= set(got)
    text, passages = dict(rows), dict(items)
    for (i, k), s in got.items():
        fold = lambda t: re.sub(r"\s+", " ", t.lower())
        assert distance_inside(fold(passages[k]), fold(text[i])) <= s["edits"] <= decontaminate.budget(len(passages[k]))
        if s["edits"] == 0:
            assert fold(text[i][s["start"]:s["end"]]) == fold(passages[k])
    # what was not planted has no passage
    assert all(distance_inside(passages[k], text[i].lower()) <= decontaminate.budget(len(passages[k])) for i, k in set(got) - planted)


def test_decontamination_in_blocks_and_with_an_empty_benchmark(spark, monkeypatch):
    bench = spark.createDataFrame([(k, f"passage number {k} of a benchmark with words") for k in range(9)], "item_id long, text string")
    docs = frame(spark, [(k, f"before passage number {k} of a benchmark with words after") for k in range(9)])
    want = {(r["doc_id"], s["item_id"]) for r in decontaminate.mark(docs, bench).collect() for s in r["spans"]}
    monkeypatch.setattr(decontaminate, "BLOCK_CHARS", 100)
    assert {(r["doc_id"], s["item_id"]) for r in decontaminate.mark(docs, bench).collect() for s in r["spans"]} == want
    assert {(k, k) for k in range(9)} <= want
    assert all(r["spans"] == [] for r in decontaminate.mark(docs, bench.where("false")).collect())


@pytest.mark.parametrize("chars, held", [(40, 1), (40, 3), (10 ** 6, 4)])
def test_passages_in_many_blocks(spark, monkeypatch, chars, held):
    monkeypatch.setattr(decontaminate, "BLOCK_CHARS", chars)
    monkeypatch.setattr(decontaminate, "HELD", held)
    rng = random.Random(4)
    passage = lambda: " ".join("".join(rng.choice("abcdefgh") for _ in range(rng.randrange(3, 9))) for _ in range(8))
    items = [(i, passage()) for i in range(9)]
    rows = [(100 + i, f"{passage()} {t} {passage()}" if i % 2 else passage()) for i, t in items] + [(200, items[0][1] + " " + items[4][1]), (201, None)]
    docs = spark.createDataFrame([(*r, "mine") for r in rows], "doc_id long, text string, spans_ string")
    out = decontaminate.mark(docs, spark.createDataFrame(items, "item_id long, text string")).collect()
    assert out[0].asDict().keys() == {"doc_id", "text", "spans_", "spans"} and {r["spans_"] for r in out} == {"mine"}
    want = {(100 + i, i) for i in range(9) if i % 2} | {(200, 0), (200, 4)}
    assert {(r["doc_id"], s["item_id"]) for r in out for s in r["spans"]} == want


def test_alignment_equals_a_full_table():
    rng = np.random.default_rng(9)
    items, regions, budgets, want = [], [], [], []
    for _ in range(150):
        n = int(rng.integers(1, 40))
        item = rng.integers(0, 4, n).astype(np.uint32)
        region = rng.integers(0, 4, n + int(rng.integers(-2, 12))).astype(np.uint32)
        k = int(rng.integers(0, 8))
        table = np.zeros((n + 1, len(region) + 1), int)
        table[:, 0] = np.arange(n + 1)
        for i in range(1, n + 1):
            for j in range(1, len(region) + 1):
                table[i, j] = min(table[i - 1, j - 1] + (item[i - 1] != region[j - 1]), table[i - 1, j] + 1, table[i, j - 1] + 1)
        items.append(item)
        regions.append(region)
        budgets.append(k)
        want.append(int(table[-1].min()) if len(region) else n)
    for item, region, k, full, found in zip(items, regions, budgets, want, decontaminate.align(items, regions, budgets)):
        if found:
            edits, start, end = found
            assert full <= edits <= k and 0 <= start <= end <= len(region)
        elif full == 0:
            assert len(region) < len(item)
