"""Embedding forest and WARC archives on small tables; queries against their SQL."""

import base64
import hashlib
import io
import random

import numpy as np
import oracle
import pytest

from tapeweave.llm import forest, warc
from tapeweave.llm.common import components
from tapeweave.llm.queries import QUERIES
from tapeweave.llm.sql import SQL


@pytest.mark.parametrize("name", sorted(SQL))
def test_query_equals_sql(spark, sf_dir, name):
    difference = oracle.compare(QUERIES[name](spark, sf_dir), oracle.duck(sf_dir), SQL[name])
    assert difference is None, difference


def test_components_of_chains_stars_and_loops(spark):
    rng = random.Random(1)
    order = list(range(400))
    rng.shuffle(order)
    edges = list(zip(order[:200], order[1:200])) + [(order[200], x) for x in order[201:300]] + [(350, 350), (None, 3), (order[0], order[1])]
    got = {r["node"]: r["component"] for r in components(spark.createDataFrame(edges, "a long, b long")).collect()}
    want = {x: min(order[:200]) for x in order[:200]} | {x: min(order[200:300]) for x in order[200:300]}
    assert got == want
    assert components(spark.createDataFrame([], "a long, b long")).count() == 0


def clustered(seed, n, dim=16):
    rng = np.random.default_rng(seed)
    centres = rng.standard_normal((n // 8, dim))
    out = []
    for i in range(n):
        v = centres[rng.integers(len(centres))] + rng.normal(0, 0.12, dim) if rng.random() < 0.7 else rng.standard_normal(dim)
        out.append((i, (out[rng.integers(len(out))][1] if out and rng.random() < 0.1 else (v * rng.uniform(0.1, 9)).tolist())))
    return out


def brute_links(rows, threshold):
    fine = [(i, np.array(v) / np.abs(v).max()) for i, v in rows
            if i is not None and v and None not in v and np.isfinite(v).all() and np.any(np.array(v) != 0)]
    links = {i: 0 for i, _ in rows if i is not None}
    pairs = []
    for a in range(len(fine)):
        for b in range(a + 1, len(fine)):
            (i, x), (j, y) = fine[a], fine[b]
            if len(x) == len(y) and x @ y / np.linalg.norm(x) / np.linalg.norm(y) >= threshold:
                links[i] += 1
                links[j] += 1
                pairs.append((i, j))
    up = {i: i for i in links}

    def top(x):
        return x if up[x] == x else top(up[x])
    for i, j in pairs:
        x, y = top(i), top(j)
        up[max(x, y)] = min(x, y)
    return {i: (links[i], top(i), top(i) == i) for i in links}, len(pairs)


ODD = [(900, None), (901, []), (902, [0.0] * 16), (903, [1.0] * 15 + [None]), (904, [1.0] * 15 + [float("nan")]),
       (905, [1.0] * 15 + [float("inf")]), (906, [1.0, 2.0]), (907, [2.0, 4.0]), (None, [1.0] * 16), (908, [1e-300] * 16), (909, [1e300] * 16)]


def vectors(spark, rows):
    return spark.createDataFrame([(i, v, 1, 2) for i, v in rows], "vec_id long, embedding array<double>, label int, leaf int")


@pytest.mark.parametrize("leaf, block", [(10_000, 1500), (10_000, 7)])
def test_one_leaf_is_exact(spark, leaf, block):
    rows = clustered(2, 200) + ODD
    got = forest.near_duplicates(vectors(spark, rows), threshold=0.9, leaf=leaf, block=block).collect()
    want, _ = brute_links(rows, 0.9)
    assert {r["vec_id"]: (r["n_links"], r["component_id"], r["kept"]) for r in got if r["vec_id"] is not None} == want
    assert [(r["n_links"], r["component_id"], r["kept"]) for r in got if r["vec_id"] is None] == [(0, None, False)]


def test_forest_recall_and_no_link_counted_twice(spark):
    rows = clustered(3, 1500)
    got = {r["vec_id"]: r for r in forest.near_duplicates(vectors(spark, rows), threshold=0.9, leaf=60, block=40).collect()}
    want, pairs = brute_links(rows, 0.9)
    assert all(got[i]["n_links"] <= n for i, (n, _, _) in want.items())
    assert sum(r["n_links"] for r in got.values()) >= 0.9 * 2 * pairs > 1000


def checked(spark, data, least, **setting):
    """Links of the forest against all pairs: none too many, a share of at least ``least``; returns both counts."""
    got = forest.near_duplicates(vectors(spark, list(enumerate(data.tolist()))), threshold=0.9, **setting).collect()
    unit = data / np.linalg.norm(data, axis=1, keepdims=True)
    want = (unit @ unit.T >= 0.9).sum(1) - 1
    found = np.zeros(len(data), np.int64)
    for r in got:
        found[r["vec_id"]] = r["n_links"]
    assert (found <= want).all() and found.sum() >= least * want.sum()
    return found, want, {r["vec_id"]: r["component_id"] for r in got}


@pytest.mark.parametrize("spread, block", [(0.0343, 150), (0.0343, 4000), (0.012, 150), (0.024, 90)])
def test_every_link_inside_a_large_group_of_near_copies(spark, spread, block):
    """A third of the rows; the mean cosine of their pairs is about 0.93, 0.99 and 0.96."""
    rng = np.random.default_rng(5)
    n, dim = 2400, 64
    centre = rng.standard_normal(dim)
    centre /= np.linalg.norm(centre)
    data = rng.standard_normal((n, dim))
    data[::3] = centre + rng.normal(0, spread, (n // 3, dim))
    data[1::30] = data[2::30] + rng.normal(0, 0.3, (n // 30, dim))  # isolated pairs
    found, want, component = checked(spark, data, 0.999, leaf=60, block=block)
    assert want.sum() > 400_000 and (found[::3] == want[::3]).all()
    assert {component[i] for i in range(0, n, 3) if want[i]} == {0}


def test_several_groups_near_each_other(spark):
    rng = np.random.default_rng(15)
    base = rng.standard_normal(32)
    data = np.concatenate([base / np.linalg.norm(base) + rng.normal(0, 0.06, 32) + rng.normal(0, 0.02, (300, 32)) for _ in range(4)]
                          + [rng.standard_normal((900, 32))])
    rng.shuffle(data)
    checked(spark, data, 0.97, leaf=50, block=200)


@pytest.mark.parametrize("n, leaf", [(2000, 100), (12000, 300)])
def test_recall_and_work_by_table_size(n, leaf):
    """Pairs at the threshold itself among vectors of all directions, and a third in one group of near copies."""
    rng = np.random.default_rng(n)
    data = rng.standard_normal((n, 64))
    data[::3] = data[0] + rng.normal(0, 0.12, (len(data[::3]), 64))
    data /= np.linalg.norm(data, axis=1, keepdims=True)
    near = rng.standard_normal((n, 64))
    near -= (near * data).sum(1, keepdims=True) * data
    near = 0.9 * data + np.sqrt(1 - 0.81) * near / np.linalg.norm(near, axis=1, keepdims=True)
    made = forest.fit(data[:forest.SAMPLE], n, 0.9, leaf)
    met = np.zeros(n, bool)
    for nodes in made.trees:
        met |= forest._together(nodes, data, near)
    assert made.leaves > 10 and len(made.centres) == 1
    assert met.mean() >= 0.98
    assert forest.work(made, data, 0.9) < 0.75


def test_forest_of_an_empty_table(spark):
    assert forest.near_duplicates(vectors(spark, clustered(4, 10)).where("false")).count() == 0
    assert {r["n_links"] for r in forest.near_duplicates(vectors(spark, ODD[:4])).collect()} == {0}


# --- WARC


PAGES = [(1, "http://a/1", "<p>one</p>"), (2, "http://a/2", "<p>one</p>"), (9, "http://a/ 9\r\nX: y", "<p>one</p>"),
         (3, None, None), (4, "http://a/4", ""), (5, "http://a/5", "é" * 100_000), (6, "http://a/6", "x\r\n\r\ny" * 3000),
         (7, "u", "twice"), (7, "u", "twice"), (None, "u", "twice"), (8, "u", "a\0b")]


def pages(spark, rows=PAGES):
    return spark.createDataFrame([(i, u, h, 5, "t") for i, u, h in rows], "page_id long, url string, html string, size int, target string")


def read(spark, tmp_path, frame, **options):
    out = f"file://{tmp_path}/warc"
    manifest = warc.write(frame, out, **options)
    return manifest, warc.assemble(warc.records(spark, manifest, out)).collect()


def test_warc_round_trip(spark, tmp_path):
    manifest, captures = read(spark, tmp_path, pages(spark).repartition(3))
    assert len(captures) == len(PAGES) and sum(r["records"] for r in manifest.collect()) == 3 * len(PAGES)
    by_id = {c["record_id"]: c for c in captures}
    assert len(by_id) == len(PAGES)
    payloads = {}
    for i, _, h in PAGES:
        payloads.setdefault(i, (h or "").encode())
    for c in captures:
        data = payloads[c["page_id"]]
        assert c["payload_bytes"] == len(data)
        assert c["payload_digest"] == base64.b32encode(hashlib.sha1(data).digest()).decode()
        assert len(c["requests"]) == len(c["metadata"]) == 1
        if c["record_type"] == "response":
            assert bytes(c["payload"]) == data and c["refers_to"] is None
        else:
            top = by_id[c["refers_to"]]
            assert top["record_type"] == "response" and top["payload_digest"] == c["payload_digest"]
    kinds = {(c["page_id"], c["record_type"], by_id[c["refers_to"]]["page_id"] if c["refers_to"] else None) for c in captures}
    assert kinds == {(1, "revisit", 9), (2, "revisit", 9), (9, "response", None), (3, "revisit", 4), (4, "response", None),
                     (5, "response", None), (6, "response", None), (7, "response", None), (7, "revisit", 7),
                     (None, "revisit", 7), (8, "response", None)}


def test_warc_small_payloads_are_responses(spark, tmp_path):
    _, captures = read(spark, tmp_path, pages(spark), min_bytes=6)
    assert {c["page_id"] for c in captures if c["record_type"] == "revisit"} == {1, 2}


def test_warc_empty_table(spark, tmp_path):
    manifest, captures = read(spark, tmp_path, pages(spark).where("false"))
    assert manifest.count() == 0 and captures == []


def test_warc_records_without_partner(spark):
    rows = [("response", "r1", None, 10), ("request", "q1", "r1", None), ("request", "q2", "r1", None), ("metadata", "m9", "r9", None),
            ("request", "q3", None, None), ("revisit", "r2", None, None)]
    frame = spark.createDataFrame([(t, i, c, None, None, "D", n, None, None) for t, i, c, n in rows], warc._RECORD)
    got = {r["record_id"]: r for r in warc.assemble(frame).collect()}
    assert set(got) == {"r1", "r2"} and [q["record_id"] for q in got["r1"]["requests"]] == ["q1", "q2"]
    assert got["r2"]["requests"] == [] and got["r1"]["metadata"] == [] and got["r1"]["page_id"] is None


def test_parser_in_small_pieces():
    data = b"".join(r for i, u, h in PAGES for r in warc.page_records(i, u, h, 0, None))

    class Slow(io.BytesIO):
        def read(self, n=-1):
            return super().read(min(n, 11))
    assert [f["warc-type"] for f, _ in warc.parse(Slow(data))] == ["response", "request", "metadata"] * len(PAGES)
    with pytest.raises(ValueError):
        list(warc.parse(io.BytesIO(data[:-300])))
