"""The pipeline against a brute-force version of its stages, and stages on odd tables."""

import re

import corpus_pipeline
import pytest
from test_texts import brute_components, distance_inside, shingles

from tapeweave.llm import decontaminate
from tapeweave.llm.common import table


@pytest.fixture(scope="module")
def steps(spark, sf_dir):
    docs = table(spark, sf_dir, "documents")
    out = [docs.collect()]
    for _, stage in corpus_pipeline.STAGES:
        docs = stage(spark, docs, sf_dir)
        out.append(docs.collect())
        docs = spark.createDataFrame(out[-1], docs.schema)
    return [{r["doc_id"]: r for r in rows} for rows in out]


def test_stage_names():
    assert [n for n, _ in corpus_pipeline.STAGES] == ["quality_classifier", "line_dedup", "ngram_jaccard_join",
                                                      "benchmark_decontamination", "bpe_encoding"]


def test_quality_keeps_clean_documents(spark, sf_dir, steps):
    labels = [tuple(r) for r in table(spark, sf_dir, "labels").select("doc_id", "quality").collect()]
    good = [i for i, q in labels if q == 1]
    bad = [i for i, q in labels if q == 0]
    assert sum(i in steps[1] for i in good) >= 0.98 * len(good)
    assert sum(i in steps[1] for i in bad) <= 0.3 * len(bad)
    assert all(steps[1][i] == steps[0][i] for i in steps[1])


def test_lines(steps):
    first = {}
    key = lambda x: re.sub("[A-Z]", lambda m: m[0].lower(), x.strip(" \t\n\x0b\x0c\r"))
    for i in sorted(steps[1]):
        for x in (steps[1][i]["text"] or "").split("\n"):
            first.setdefault(key(x), i)
    assert steps[2].keys() == steps[1].keys()
    for i, r in steps[2].items():
        lines = (steps[1][i]["text"] or "").split("\n")
        assert r["text"] == "\n".join(x for x in lines if len(key(x)) < 10 or first[key(x)] == i)
        assert r["n_chars"] == len(r["text"])


def test_near_copies(steps):
    want = brute_components({i: shingles(r["text"], 5) for i, r in steps[2].items()}, 80, 100)
    assert set(steps[3]) == {i for i, c in want.items() if i == c}


def test_leaks(spark, sf_dir, steps):
    items = [r["text"] for r in table(spark, sf_dir, "benchmark").collect()]
    fold = lambda t: re.sub(r"\s+", " ", t.lower())
    assert set(steps[4]) <= set(steps[3])
    for i, r in steps[3].items():
        exact = any(fold(t) in fold(r["text"] or "") for t in items)
        if exact:
            assert i not in steps[4]
        elif i not in steps[4]:  # a passage with edits
            assert any(distance_inside(fold(t), fold(r["text"])) <= decontaminate.budget(len(fold(t))) for t in items)


def test_tokens(steps):
    assert set(steps[5]) == set(steps[4])
    assert all(r["round_trip"] and r["n_tokens"] == len(r["ids"]) for r in steps[5].values())


def test_stages_on_odd_rows(spark, sf_dir):
    schema = table(spark, sf_dir, "documents").schema
    rows = [(1, None, None, None, None), (None, "some text with no id at all", "en", "s", 3), (2, "", None, None, 0),
            (3, "one word " * 20_000, "en", "s", 9), (3, "one word " * 20_000, "en", "s", 9), (4, "plain words of a text", "en", "s", 9)]
    for docs in (spark.createDataFrame(rows, schema), spark.createDataFrame([], schema)):
        for name, stage in corpus_pipeline.STAGES:
            out = stage(spark, docs, sf_dir)
            assert out.count() <= docs.count()
            if name != "bpe_encoding":
                assert out.columns == docs.columns
