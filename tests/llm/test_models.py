"""Quality rules and secret network: held-out accuracy, exact patterns, odd rows."""

import hashlib
import math
import random
import re
import unicodedata
import zlib

import numpy as np
import pytest

from tapeweave.llm import quality, secrets
from tapeweave.llm.queries import QUERIES

# --- quality


def labelled(spark, n=600):
    rng = random.Random(1)
    docs, labels = [], []
    for i in range(n):
        good = rng.random() < 0.7
        words = ["".join(rng.choice("abcdefghij") for _ in range(rng.randrange(2, 8))) for _ in range(rng.randrange(5, 120))]
        docs.append((i, " ".join(words) + "." if good else "!! ".join(w.upper() for w in words), 0.5, 7))
        labels.append((i, int(good)))
    docs += [(None, None, None, None), (n, "", None, None), (n + 1, None, None, None), (n + 2, "x" * 300_000, None, None), docs[0]]
    labels += [(None, 1), (n, None), (0, labels[0][1]), (n + 2, 5)]
    return (spark.createDataFrame(docs, "doc_id long, text string, score double, y int"),
            spark.createDataFrame(labels, "doc_id long, quality int"))


def test_quality_on_held_out_rows(spark):
    docs, labels = labelled(spark)
    model = quality.train(docs, labels)
    assert model.rules and len(model.rules) == len(model.weights)
    out = quality.classify(docs, model).collect()
    assert out[0].asDict().keys() == {"doc_id", "text", "y", "score", "predicted"} and len(out) == docs.count()
    assert all(0 <= r["score"] <= 1 and r["predicted"] == int(r["score"] >= quality.THRESHOLD) for r in out)
    truth = {r[0]: r[1] for r in labels.where("doc_id < 600").collect()}
    held = [r for r in out if r["doc_id"] in truth and zlib.crc32(str(r["doc_id"]).encode()) % 5 == 0]
    assert len(held) > 80 and sum(r["predicted"] == truth[r["doc_id"]] for r in held) >= 0.98 * len(held)
    same = [r["score"] for r in out if r["doc_id"] == 0]
    assert len(same) == 2 and same[0] == same[1]


def test_quality_never_learns_held_out_labels(spark):
    docs, labels = labelled(spark)
    wrong = labels.selectExpr("doc_id", "case when crc32(cast(cast(doc_id as string) as binary)) % 5 = 0 then 1 - quality else quality end as quality")
    assert quality.train(docs, labels) == quality.train(docs, wrong)
    assert quality.train(docs, labels, sample=50) == quality.train(docs.repartition(7), labels.repartition(3), sample=50)


def test_quality_without_labels(spark):
    docs, labels = labelled(spark, 30)
    assert {r["score"] for r in quality.classify(docs, quality.train(docs, labels.where("false"))).collect()} == {0.5}
    one = quality.train(docs, labels.where("quality = 1"))
    assert {r["predicted"] for r in quality.classify(docs, one).collect()} == {1}
    assert quality.classify(docs.where("false"), one).count() == 0
    assert quality.train(docs.where("false"), labels) == quality.RuleModel((), (), 0.0)


def test_rules_compile_to_what_they_say(spark):
    docs, _ = labelled(spark, 40)
    model = quality.RuleModel(((("capitals", True, 0.3),), (("commas", False, 0.1), ("lines", False, 0.5))), (-2.0, 1.5), 0.25)
    for r in quality.classify(docs, model).collect():
        t = r["text"] or ""
        share = (sum(c.isupper() for c in t) / max(1, len(t)), sum(c in ",;:" for c in t) / max(1, len(t)), t.count("\n") / max(1, len(t)))
        z = 0.25 + (-2.0 if share[0] > 0.3 else 0) + (1.5 if share[1] <= 0.1 and share[2] <= 0.5 else 0)
        assert r["score"] == pytest.approx(1 / (1 + math.exp(-z)))


def brute_statistics(text):
    t = text or ""
    n, words = len(t), [w for w in re.split("[\x20\x09-\x0D]+", t) if w]

    def share(kind):
        return sum(kind(c) for c in t) / max(n, 1)
    return {"log_chars": math.log1p(n), "word_length": n / max(len(words), 1), "distinct_words": len(set(words)) / max(len(words), 1),
            "capitals": share(lambda c: unicodedata.category(c) == "Lu"), "digits": share(lambda c: unicodedata.category(c)[0] == "N"),
            "symbols": share(lambda c: c in "#*%&$@~^=<>+_\\/{}[]"), "bars": share(lambda c: c == "|"), "exclamations": share(lambda c: c == "!"),
            "stops": share(lambda c: c in ".?"), "commas": share(lambda c: c in ",;:"), "lines": share(lambda c: c == "\n")}


def test_every_score_of_the_table_equals_brute_force(spark, sf_dir):
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text")
    odd = spark.createDataFrame([(-1, None), (-2, ""), (-3, "Ünï ÀB ½ Ⅷ [x] {y} \\ a|b! \t\x0b"), (-4, " ")], "doc_id long, text string")
    docs = docs.unionByName(odd)
    model = quality.train(docs, spark.read.parquet(f"{sf_dir}/labels.parquet"))
    assert len(model.rules) > 3
    for r in quality.classify(docs, model).collect():
        seen = brute_statistics(r["text"])
        z = model.intercept + sum(w for rule, w in zip(model.rules, model.weights)
                                  if all(seen[name] > bound if above else seen[name] <= bound for name, above, bound in rule))
        near = any(abs(seen[name] - bound) < 1e-12 * max(1, abs(bound)) for rule in model.rules for name, _, bound in rule)
        assert near or r["score"] == pytest.approx(1 / (1 + math.exp(-z)), rel=1e-9), r["doc_id"]
        assert r["predicted"] == int(r["score"] >= quality.THRESHOLD)


def test_quality_query(spark, sf_dir):
    got = {r["doc_id"]: r for r in QUERIES["op6_quality_rules"](spark, sf_dir).collect()}
    assert len(got) == spark.read.parquet(f"{sf_dir}/documents.parquet").count()
    assert all(r["held_out"] == (zlib.crc32(str(i).encode()) % 5 == 0) for i, r in got.items())
    labels = [tuple(r) for r in spark.read.parquet(f"{sf_dir}/labels.parquet").select("doc_id", "quality").collect()]
    right = [got[i]["predicted"] == q for i, q in labels if got[i]["held_out"]]
    assert sum(right) >= 0.85 * len(right)


# --- secrets

PATTERN = re.compile(r"""((?:[pP][aA][sS][sS][wW][oO][rR][dD])|(?:[pP][aA][sS][sS][wW][dD])|[sS][eE][cC][rR][eE][tT]|[tT][oO][kK][eE][nN]|"""
                     r"""[aA][pP][iI]_?[kK][eE][yY])["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""")


def brute(text):
    t = text or ""
    found = [("assign", m.start(), m.end()) for m in PATTERN.finditer(t) if len(m[2]) >= 6]
    found += [("access", m.start(), m.end()) for m in re.finditer("AKIA[A-Z0-9]+", t) if len(m[0]) >= 20]
    found += [("hex", m.start(), m.end()) for m in re.finditer("[0-9a-f]+", t) if len(m[0]) >= 24]
    return sorted(found, key=lambda f: (f[1], secrets.KINDS.index(f[0])))


def secret_texts(n=300):
    rng = random.Random(2)
    hexa = lambda k: "".join(rng.choice("0123456789abcdef") for _ in range(k))
    mixed = lambda k: "".join(rng.choice("ABCDEFGHJKLMNPQRSTUVWXYZ0123456789") for _ in range(k))
    out = []
    for _ in range(n):
        words = ["".join(rng.choice("abcdefé ") for _ in range(rng.randrange(1, 9))) for _ in range(rng.randrange(1, 40))]
        words.insert(rng.randrange(len(words)), rng.choice([
            f"PassWord = '{hexa(20)}'", f"api_key:{hexa(40)}", f"AKIA{mixed(16)}", hexa(rng.choice([23, 24, 60])), f"token={mixed(5)}",
            f"secret: token: {hexa(30)}", f"AKIA{mixed(15)}", str(rng.randrange(10 ** 15, 10 ** 16)), "paſſword=abcdefgh", "plain"]))
        out.append(" ".join(words))
    return [*out, None, "", "a1" * 50_000, out[0], "toKen=abcdef", "token=token=abcdef"]


def test_patterns_equal_brute_force():
    texts = secret_texts()
    assert [f for f, _ in secrets.scan(texts)] == [brute(t) for t in texts]
    assert [secrets.base(t or "") for t in texts] == [brute(t) for t in texts]


def test_findings_keep_base_and_add_to_it(spark):
    texts = secret_texts()
    docs = spark.createDataFrame([(i, t, None, "w") for i, t in enumerate(texts)], "doc_id long, text string, findings int, w string")
    out = {r["doc_id"]: r for r in secrets.find(docs).collect()}
    assert len(out) == len(texts) and out[0].asDict().keys() == {"doc_id", "w", "findings"}
    for i, t in enumerate(texts):
        found = out[i]["findings"]
        assert [(f["kind"], f["start"], f["end"]) for f in found if f["kind"] != "network"] == brute(t)
        assert all(0 <= f["score"] <= 1 and f["end"] <= len(t) for f in found)
    assert secrets.find(docs.where("false")).count() == 0


def test_network_learns_secrets_and_its_threshold_keeps_recall():
    rng = random.Random(5)
    word = lambda: "".join(rng.choice("abcdefghijklmnoprstu") for _ in range(6))
    secret = lambda: "".join(rng.choice("ABCDEFGHabcdefgh0123456789+/") for _ in range(32))
    number = lambda: str(rng.randrange(10 ** 15, 10 ** 16))

    def shown(token):
        t = f"{word()} {word()} {token} {word()}"
        at = t.index(token)
        return secrets.windows(t, at, at + len(token))[0]
    net = secrets.fit([shown(secret()) for _ in range(400)], [shown(number()) for _ in range(400)])
    new, other = (net.score(secrets.codes([shown(f()) for _ in range(300)])) for f in (secret, number))
    assert (new >= net.threshold).mean() >= 0.95 and (other >= net.threshold).mean() <= 0.05
    assert new.mean() > 0.8 and other.mean() < 0.2
    alone = secrets.fit([], [])  # the fixed examples are there at every size
    new, other = (alone.score(secrets.codes([shown(f()) for _ in range(300)])) for f in (secret, number))
    assert (new >= alone.threshold).mean() > 0.9 and (other >= alone.threshold).mean() < 0.3


def test_planted_secrets_that_no_pattern_matches(spark):
    """Recall and precision of the network's spans on tokens the patterns don't know, in a table of its own prose."""
    rng = random.Random(21)
    word = lambda: "".join(rng.choice("bcdfglmnprst") + rng.choice("aeiou") for _ in range(rng.randrange(1, 5)))
    token = lambda: "".join(rng.choice("ABCDEFGHJKLMNPQRSTUVWXYZabcdefghjkmnpqrstuvwxyz0123456789") for _ in range(rng.randrange(12, 41)))
    harmless = [lambda: f"{word()}_{word()}", lambda: str(rng.randrange(10 ** 6, 10 ** 9)), lambda: f"20{rng.randrange(10, 30)}-0{rng.randrange(1, 10)}-1{rng.randrange(10)}",
                lambda: f"{word()}/{word()}/{word()}", lambda: word() + word().capitalize()]
    rows, planted = [], set()
    for i in range(400):
        words = [word() for _ in range(rng.randrange(5, 40))]
        words[rng.randrange(len(words))] = rng.choice(harmless)()
        if i % 4 == 0:
            at = rng.randrange(len(words))
            words[at] = token()
            start = len(" ".join(words[:at])) + (at > 0)
            planted.add((i, start, start + len(words[at])))
        if i % 7 == 0:
            words.append("password=" + token())
        rows.append((i, " ".join(words), "x"))
    out = secrets.find(spark.createDataFrame(rows, "doc_id long, text string, seen string")).collect()
    assert out[0].asDict().keys() == {"doc_id", "seen", "findings"}
    found = {(r["doc_id"], f["start"], f["end"]) for r in out for f in r["findings"] if f["kind"] == "network"}
    missed = [rows[i][1][a:b] for i, a, b in sorted(planted - found)]
    extra = [rows[i][1][a:b] for i, a, b in sorted(found - planted)]
    assert len(found & planted) >= 0.8 * len(planted) and len(found & planted) >= 0.9 * len(found), (missed, extra)
    long = {p for p in planted if p[2] - p[1] >= 16}
    assert len(found & long) >= 0.95 * len(long), missed


def test_network_learns_from_every_window(spark):
    """More windows than one shard holds: each is trained on or held out, and the threshold is that of all held-out ones."""
    rng = random.Random(9)
    made = lambda letters, k: "".join(rng.choice(letters) for _ in range(k))
    n, other = 2 * secrets.SHARD + 100, 1500
    rows = [(False, made("0123456789", 14).rjust(secrets.WIDTH, "\0")) for _ in range(n)]
    rows += [(True, made("ABCDEFGHabcdefgh0123456789", 30).rjust(secrets.WIDTH, "\0")) for _ in range(other)]
    table = spark.createDataFrame(rows, "secret boolean, w string")
    net = secrets.learn(table.unionByName(table))
    assert net.trained[0] + net.held[0] == other and net.trained[1] + net.held[1] == n
    assert 0.15 * n < net.held[1] < 0.25 * n
    again = secrets.learn(table.repartition(5))
    assert (again.flat() == net.flat()).all() and (again.scale, again.threshold) == (net.scale, net.threshold)
    found, plain = (net.score(secrets.codes([w for s, w in rows if s == label])) for label in (True, False))
    assert (found >= net.threshold).mean() >= 0.97 and (plain >= net.threshold).mean() <= 0.02
    few = secrets.learn(table.limit(50))
    assert few.trained[1] + few.held[1] == 50


def test_threshold_is_the_highest_that_keeps_recall():
    counts = [(True, z, 10) for z in range(100)] + [(False, -500, 300)]
    assert secrets._lowest(counts, 0.9) == 9  # 99 of 1000 may be missed
    net = secrets.calibrate(secrets.start(np.random.default_rng(1)), counts, [(True, 60, 5)], 0.9)
    assert list(net.calibrated(np.array([8, 9, 10])) >= net.threshold) == [False, True, True]
    low = secrets.calibrate(secrets.start(np.random.default_rng(1)), counts, [(True, 4, 5)], 0.9)  # of the fixed ones too
    assert list(low.calibrated(np.array([3, 4])) >= low.threshold) == [False, True]


def test_candidates_overlap_findings_but_never_lie_inside():
    key = "deadbeef" * 3
    text = f"a {key}XYZ9 b {key} c xY9aaa d"
    (found, other), = secrets.scan([text])
    assert [f[0] for f in found] == ["hex", "hex"] and [text[a:b] for a, b in other] == [f"{key}XYZ9", "xY9aaa"]


def test_windows_cover_the_whole_token():
    t = "left " + "0123456789" * 30 + " right"
    found = secrets.windows(t, 5, 305)
    assert "".join(w[secrets.LEFT:secrets.LEFT + secrets.BODY] for w in found).rstrip("\0") == t[5:305]
    assert all(len(w) == secrets.WIDTH for w in found) and secrets.codes(found).shape == (7, secrets.WIDTH)
    assert np.isin(secrets.codes(["é" * secrets.WIDTH]), 96).all()


def test_secret_query(spark, sf_dir):
    docs = {r[0]: r[1] for r in spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text").collect()}
    for r in QUERIES["op7_secret_network"](spark, sf_dir).collect():
        found = brute(docs[r["doc_id"]])
        spans = ",".join(f"{k}:{a}:{b}" for k, a, b in found)
        assert r["base_sha256"] == hashlib.sha256(spans.encode()).hexdigest()
        assert [r["n_assign"], r["n_access"], r["n_hex"]] == [sum(f[0] == k for f in found) for k in ("assign", "access", "hex")]
        assert ",".join(x for x in r["spans"].split(",") if not x.startswith("network")) == spans
