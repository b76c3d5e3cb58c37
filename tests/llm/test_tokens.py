"""Encoding, decoding and token files against the tokenizers library."""

import io
import random
import zlib
from collections import Counter

import numpy as np
import public_tokenizers
import pytest
from tokenizers import Tokenizer

from tapeweave.llm import bpe, token_files
from tapeweave.llm.queries import QUERIES

PATH = public_tokenizers.path("byte_bpe_50k.json")
ODD = [" ", "  ", "\n", "a", "B", "é", "'s", "'ll", "1", "23", "<|endoftext|>", "\t", "\x1c", "\x85", "\xa0", " ", "😀",
       "ß", "_", "the", "\r\n", "​", "一", "ſ", "-"]


@pytest.fixture(scope="module")
def library():
    return Tokenizer.from_file(PATH)


def odd_texts(seed, n):
    rng = random.Random(seed)
    return ["".join(rng.choice(ODD) for _ in range(rng.randrange(14))) for _ in range(n)]


def rows(spark, texts):
    return spark.createDataFrame([(i, t, i, None) for i, t in enumerate(texts)], "doc_id long, text string, ids int, decoded string")


def test_words_equal_library(library):
    vocabulary = bpe.Vocabulary(open(PATH, encoding="utf-8").read())
    texts = [*odd_texts(1, 3000), "a" * 300, "é" * 200, "abc" * 400]
    assert [vocabulary.encode_word(t) for t in texts] == [e.ids for e in library.encode_batch(texts, add_special_tokens=False)]
    words = [*texts, *(f" {t}" for t in texts)]
    assert [np.frombuffer(b, "<i4").tolist() for b in vocabulary.encode_words(words)] == [vocabulary.encode_word(w) for w in words]


@pytest.mark.parametrize("kept", [3, 200_000])
def test_encoders_equal_library_whatever_they_remember(library, monkeypatch, kept):
    """Closing punctuation, special tokens and odd white space; memos that turn over all the time."""
    monkeypatch.setattr(bpe, "MEMO_WORDS", kept)
    monkeypatch.setattr(bpe, "MEMO_PIECES", kept)
    rng = random.Random(8)
    ends = ["", ".", ",", "!?", "...", "'s", "'", ")", "<|endoftext|>.", "é,", "1;", "\n", "\n\n", " ", "\xa0", "\u0301,", "²:", "Ⅷ."]
    texts = odd_texts(9, 400) + [" ".join(rng.choice(["the", "Cat", "straße", "x1", "日本", "a<|endoftext|>b", "-", "\x1f"]) + rng.choice(ends)
                                          for _ in range(rng.randrange(1, 30))) for _ in range(600)]
    source = open(PATH, encoding="utf-8").read()
    vocabulary = bpe.Vocabulary(source)
    token_files._workers.clear()
    for encoder in (bpe.WordEncoder(vocabulary.encode_words), token_files._library_encoder(source)):
        for group in (texts[:300], texts[300:], texts[:600]):
            assert [np.frombuffer(b, "<i4").tolist() for b in encoder.encode(group)] == \
                [e.ids for e in library.encode_batch(group, add_special_tokens=False)]
        assert len(encoder.memo) <= max(kept, 0) + 3000


def test_decoding_in_small_steps(spark, monkeypatch):
    monkeypatch.setattr(bpe, "DECODE_IDS", 3)
    lists = [(0, [100, 200, 300, 400, 500]), (1, None), (2, []), (3, [-5, 10 ** 6, 50256, None, 7]), (4, [220]), (5, [128, 129])]
    whole = Tokenizer.from_file(PATH)
    got = {r["k"]: r["decoded"] for r in bpe.decode(spark.createDataFrame(lists, "k int, ids array<int>").repartition(1), PATH).collect()}
    for k, ids in lists:
        known = [i for i in ids or [] if i is not None and 0 <= i < 50257]
        assert got[k] == whole.decode(known, skip_special_tokens=False)


def test_lexicon_is_minimal_and_exact(tmp_path):
    words = [b"step", b"steps", b"stepping", b"leap", b"leaps", b"leaping", b" \xc3\xa9", b"s", b"a" * 64]
    made = bpe.Lexicon.build(words, lambda w: list(w))
    assert len(made.final) < len({w[:k] for w in words for k in range(len(w) + 1)})
    (tmp_path / "lexicon").write_bytes(made.dump())
    read = bpe.Lexicon.load(str(tmp_path / "lexicon"))
    numbers = read.find([*words, b"", b"ste", b"stepss", b"x" * 500])
    assert sorted(numbers[:len(words)]) == list(range(len(words))) and (numbers[len(words):] == -1).all()
    assert [np.frombuffer(read.ids_of(n), "<i4").tolist() for n in numbers[:len(words)]] == [list(w) for w in words]
    assert (bpe.Lexicon.build([], list).find([b"a"]) == -1).all()


def test_encode_and_decode(spark, library):
    texts = [None, "", *odd_texts(2, 300), "the same", "the same", "word " * 30_000, "x" * 20_000, " lead", "trail ", " "]
    out = bpe.decode(bpe.encode(rows(spark, texts), PATH), PATH).orderBy("doc_id").collect()
    assert out[0].asDict().keys() == {"doc_id", "text", "ids", "decoded"}
    for r, t in zip(out, texts):
        assert r["ids"] == library.encode(t or "", add_special_tokens=False).ids
        assert r["decoded"] == library.decode(r["ids"], skip_special_tokens=False) == (t or "")
    assert bpe.encode(rows(spark, texts).where("false"), PATH).count() == 0


def test_decode_of_any_ids(spark, library):
    rng = random.Random(3)
    ids = [None, [], [50256, 999_999, 5], *([rng.randrange(50257) for _ in range(8)] for _ in range(200))]
    data = spark.createDataFrame([(i, x) for i, x in enumerate(ids)], "k int, ids array<int>")
    for r in bpe.decode(data, PATH).collect():
        assert r["decoded"] == library.decode([i for i in r["ids"] or [] if i < 50257], skip_special_tokens=False)


def test_word_counts_cover_every_text(spark, monkeypatch):
    texts = ["a b  c", None, "a", "a\nb a", " a"] * 20
    monkeypatch.setattr(bpe, "FLUSH_WORDS", 2)
    got = {r["word"]: r["n"] for r in bpe.word_counts(rows(spark, texts)).collect()}
    want = Counter()
    for t in filter(None, texts):
        p = bpe.words_of(t)
        want.update([p[0], *(f" {w}" for w in p[1:])])
    assert got == {w: n for w, n in want.items() if w}


@pytest.mark.parametrize("bits", [False, True])
@pytest.mark.parametrize("block", [1, 7, 64, 65_536])
def test_plane_files_round_trip(bits, block):
    rng = np.random.default_rng(4)
    docs = [rng.integers(0, 1 << 32, n, np.uint32) for n in (0, 1, 5, 300, 0, 64, 7)]
    out = io.BytesIO()
    writer = token_files.IdWriter(out, block, bits)
    for i, ids in enumerate(docs):
        writer.add(None if i == 0 else i * 10, ids)
    assert writer.close() == (len(docs), sum(map(len, docs)))
    file = token_files.open_bytes(out.getvalue())
    for i in (3, 0, 6, 5, 2, 1, 4):
        assert file.ids(i).tolist() == docs[i].tolist()
    with pytest.raises(ValueError):
        token_files.open_bytes(out.getvalue()[:-1])


CUT = ["a", "Zoë", "don't", "x1", "½", "Ж", "日", "\u0301", "'s", "_", "(", *".,;:!?", *[" "] * 8, *["\n"] * 4, "\t", "\r", "\x0b", "\x1c", "\x7f",
       "\x85", "\xa0", "\u1680", "\u180e", "\u2003", "\u2028", "\u202f", "\u205f", "\u3000", "\u200b", "×", "÷", "“", "<|endoftext|>"]


@pytest.mark.parametrize("kept,chunk", [(5, 50), (200_000, 8 << 20)])
def test_cut_pieces_equal_library(library, monkeypatch, kept, chunk):
    """White space of all kinds and closing punctuation in any order, at both ends of texts; little and much at a time."""
    monkeypatch.setattr(token_files, "MEMO_PIECES", kept)
    monkeypatch.setattr(token_files, "CHUNK", chunk)
    rng = random.Random(12)
    texts = ["".join(rng.choices(CUT, k=rng.randrange(12))) for _ in range(6000)]
    texts += ["".join(rng.choices(CUT[:-1], k=rng.randrange(300))) for _ in range(100)] + [a + b + c for a in CUT for b in CUT for c in "a \n"]
    token_files._workers.clear()
    encoder = token_files._library_encoder(open(PATH, encoding="utf-8").read())
    for some in (texts, texts[::-1], texts[:9]):
        assert [np.frombuffer(b, "<u4").tolist() for b in encoder.encode(some)] == \
            [e.ids for e in library.encode_batch(some, add_special_tokens=False)]
        assert len(encoder.memo) <= kept
    assert encoder.encode([]) == [] and encoder.encode(["", ""]) == [b"", b""]
    token_files._workers.clear()


class Counting:
    """A tokenizer of the library that counts the characters it is given."""

    given = 0

    def __init__(self, inner):
        object.__setattr__(self, "inner", inner)

    @classmethod
    def from_str(cls, source):
        return cls(Tokenizer.from_str(source))

    def __getattr__(self, name):
        return getattr(self.inner, name)

    def __setattr__(self, name, value):
        setattr(self.inner, name, value)

    def encode_batch_fast(self, texts, **options):
        Counting.given += sum(map(len, texts))
        return self.inner.encode_batch_fast(texts, **options)


def test_words_go_to_the_library_once(library, monkeypatch):
    """Many words that return late, with other punctuation behind them, are not encoded again."""
    import tokenizers

    words = ["".join("abcdefghij"[int(c)] for c in str(10 ** 8 + i * 7919)) for i in range(360_000)]
    texts = [" " + " ".join(w + end for w in words[a:a + 120_000]) for end in (",", "!?") for a in range(0, len(words), 120_000)]
    monkeypatch.setattr(tokenizers, "Tokenizer", Counting)
    monkeypatch.setattr(Counting, "given", 0)
    token_files._workers.clear()
    encoder = token_files._library_encoder(open(PATH, encoding="utf-8").read())
    got = [encoder.encode([t])[0] for t in texts]
    token_files._workers.clear()
    assert Counting.given < 1.1 * sum(len(w) + 2 for w in words)
    assert [np.frombuffer(b, "<u4").tolist() for b in got[2:4]] == [e.ids for e in library.encode_batch(texts[2:4], add_special_tokens=False)]


@pytest.mark.parametrize("change", ["prefix", "added", "inside", "whole"])
def test_other_tokenizers_equal_library(change):
    """A prefix space, an added token that takes the space before it, ones that hold breaks and each other, another pre-tokenizer."""
    import json

    spec = json.load(open(PATH, encoding="utf-8"))
    if change == "prefix":
        spec["pre_tokenizer"]["add_prefix_space"] = True
    elif change == "whole":
        spec["pre_tokenizer"]["use_regex"] = False
    elif change == "inside":
        for i, t in enumerate(["t. s", "<|endoftext|>. x", "e", " <|endoftext|>"]):
            spec["added_tokens"].append({"id": 50257 + i, "content": t, "single_word": False, "lstrip": False, "rstrip": False,
                                         "normalized": False, "special": True})
    else:
        spec["added_tokens"].append({"id": 50257, "content": "cat", "single_word": True, "lstrip": True, "rstrip": False,
                                     "normalized": False, "special": False})
    texts = ["the cat  sat, concat\n\ncat", "", "a b\nc", "cat", "no one here.", "a  <|endoftext|>. x  e", "a  <|endoftext|>. y", "cat. sat.", "<|endof", "text|> cat. ",
             "sit  <|endoftext|>  <|endoftext|>\n"]
    source = json.dumps(spec)
    token_files._workers.clear()
    want = [e.ids for e in Tokenizer.from_str(source).encode_batch(texts, add_special_tokens=False)]
    assert [np.frombuffer(b, "<u4").tolist() for b in token_files._library_encoder(source).encode(texts)] == want
    token_files._workers.clear()


def test_token_files_in_order(spark, library, tmp_path):
    texts = [None, "", *odd_texts(5, 60), "word " * 5000, "same", "same"]
    data = rows(spark, texts).unionByName(rows(spark, ["no id"]).selectExpr("cast(null as long) as doc_id", "text", "ids", "decoded"))
    out = f"file://{tmp_path}/ids"
    manifest = token_files.write(data, out, PATH, end=2, block=512, bits=True, files=5)
    got = sorted(token_files.read(spark, manifest, out).collect(), key=lambda r: r["start"])
    assert [r["doc"] for r in got] == [None, *range(len(texts))]
    start = 0
    for r, t in zip(got, ["no id", *texts]):
        ids = [*library.encode(t or "", add_special_tokens=False).ids, 2]
        assert (r["start"], r["n_tokens"], np.frombuffer(r["ids"], "<u4").tolist()) == (start, len(ids), ids)
        start += len(ids)
    empty = token_files.write(data.where("false"), out, PATH, end=2)
    assert empty.count() == 0 and token_files.read(spark, empty, out).count() == 0


def test_queries_equal_library(spark, sf_dir, library):
    import hashlib

    docs = {r[0]: r[1] for r in spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text").collect()}
    files = {r["doc_id"]: r for r in QUERIES["op3_token_files"](spark, sf_dir).collect()}
    coded = {r["doc_id"]: r for r in QUERIES["op8_bpe_lexicon"](spark, sf_dir).collect()}
    assert files.keys() == coded.keys() == docs.keys()
    start = 0
    for i in sorted(docs):
        ids = library.encode(docs[i] or "", add_special_tokens=False).ids
        text = library.decode(ids, skip_special_tokens=False)
        assert coded[i]["n_tokens"] == len(ids)
        assert coded[i]["ids_sha256"] == hashlib.sha256(",".join(map(str, ids)).encode()).hexdigest()
        assert coded[i]["decoded_sha256"] == hashlib.sha256(text.encode()).hexdigest()
        data = np.array([*ids, 2], "<u4").tobytes()
        assert (files[i]["start"], files[i]["n_tokens"], files[i]["ids_crc32"]) == (start, len(ids) + 1, zlib.crc32(data))
        start += len(ids) + 1
