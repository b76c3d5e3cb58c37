"""Byte-level BPE: a minimal acyclic lexicon of frequent words, exact merges for the rest.

A text is cut at single spaces between visible characters: the pre-tokenizer
always breaks there, so the ids of such a word depend on the word alone. The
most frequent words of the corpus (counted over all documents) are compiled
into a minimal automaton with shared suffixes, whose word numbers lead to the
ids; executors memory-map it. All other words are split by the pre-tokenizer's
pattern and merged by rank, so the ids are those of the tokenizer library.
"""

from __future__ import annotations

import heapq
import json
import mmap
import re
import uuid
from array import array
from collections import Counter
from collections.abc import Callable, Iterable, Iterator

import numpy as np
import pyarrow as pa
import regex
from pyarrow import fs
from pyspark import SparkFiles
from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tapeweave.llm.common import give_back, pieces, saved, with_column
from tapeweave.session import workspace

LEXICON_WORDS = 65_536  # bounds the automaton; a word outside is merged, never dropped
MEMO_WORDS = 100_000  # words of each of the two generations that a worker keeps
MEMO_PIECES = 100_000  # and pieces of words
LONG_WORD = 64  # longer words are neither counted nor kept
DECODE_IDS = 1 << 18  # ids that are decoded in one step
FLUSH_WORDS = 400_000  # distinct words that a counting task holds at once
# Fixed value: the pattern of the byte-level pre-tokenizer.
PATTERN = r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"

_SPREAD = np.uint64(0x9E3779B97F4A7C15)
_BESIDE = re.compile(r" \s|\s | \Z")
_SAFE = re.compile(r"(?<=\S) (?=\S)")


def words_of(text: str) -> list[str]:
    """The words of a text, each but the first without the space before it."""
    if text.replace("\n", "").isprintable():  # its white space is spaces and newlines
        beside = "  " in text or " \n" in text or "\n " in text or text[-1:] == " "
    else:
        beside = _BESIDE.search(text)
    return _SAFE.split(text) if beside else text.split(" ")


class Vocabulary:
    """Ranks, ids and bytes of a byte-level BPE tokenizer file (its JSON text)."""

    def __init__(self, source: str):
        spec = json.loads(source)
        model, before = spec["model"], spec["pre_tokenizer"]
        if model["type"] != "BPE" or before["type"] != "ByteLevel" or before["add_prefix_space"] or spec["normalizer"]:
            raise ValueError("only byte-level BPE without prefix space and normalizer is supported")
        shown = [*range(33, 127), *range(161, 173), *range(174, 256)]
        hidden = [b for b in range(256) if b not in shown]
        self.char = {b: chr(b) for b in shown} | {b: chr(256 + i) for i, b in enumerate(hidden)}
        byte = {c: b for b, c in self.char.items()}
        self.ids: dict[str, int] = model["vocab"]
        pairs = [m.split(" ") if isinstance(m, str) else m for m in model["merges"]]
        self.first = [self.ids[self.char[b]] for b in range(256)]
        # rank of a pair of ids, and the id that a merge of that rank makes
        self.rank = {self.ids[x] << 32 | self.ids[y]: i for i, (x, y) in enumerate(pairs)}
        self.made = [self.ids[x + y] for x, y in pairs]
        self.known: dict[str, list[int]] = {}
        self.pieces: dict[str, bytes] = {}
        self.older_pieces: dict[str, bytes] = {}
        keys = np.array(list(self.rank), np.int64)
        order = np.argsort(keys)
        self._keys, self._ranks = keys[order], np.arange(len(keys))[order]
        self._made, self._first = np.array(self.made, np.int32), np.array(self.first, np.int32)
        self.bytes = {i: bytes(byte[c] for c in t) for t, i in self.ids.items()}
        self.special = {t["content"]: t["id"] for t in spec.get("added_tokens", [])}
        self.bytes |= {i: t.encode() for t, i in self.special.items()}
        self._special = regex.compile("|".join(map(regex.escape, sorted(self.special, key=len, reverse=True)))) \
            if self.special else None
        self._pattern = regex.compile(PATTERN)

    def encode_word(self, word: str) -> list[int]:
        """Exact ids of a text that is pre-tokenized on its own."""
        out: list[int] = []
        at = 0
        for m in self._special.finditer(word) if self._special else ():
            for piece in self._pattern.findall(word[at:m.start()]):
                out += self._piece(piece)
            out.append(self.special[m[0]])
            at = m.end()
        for piece in self._pattern.findall(word[at:] if at else word):
            out += self._piece(piece)
        return out

    def encode_words(self, words: list[str]) -> list[bytes]:
        """The same for many words at once, as little-endian 32-bit ids.

        Words that begin with a space and end visibly keep to themselves in one
        long text; it is split by the pattern once and its new pieces are merged together.
        """
        out: list[bytes | None] = [None] * len(words)
        together = [i for i, w in enumerate(words) if w[:1] == " " and len(w) <= LONG_WORD and not w[-1:].isspace()
                    and not w[1:2].isspace()]
        if self._special and self._special.search("".join(words)):
            together = [i for i in together if not self._special.search(words[i])]
        if together:
            pieces = self._pattern.findall("".join([words[i] for i in together]))
            ends = np.cumsum(np.fromiter(map(len, pieces), np.int64, len(pieces)))
            want = np.cumsum([len(words[i]) for i in together])
            at = np.searchsorted(ends, want)
            if not (ends[at] == want).all():
                raise AssertionError("a word ran into the next one")
            if len(self.pieces) > MEMO_PIECES:
                self.pieces, self.older_pieces = {}, self.pieces
            known, older = self.pieces, self.older_pieces
            fresh = set(pieces)
            fresh -= known.keys()
            back = fresh & older.keys()
            for p in back:
                known[p] = older[p]
            new = list(fresh - back)
            known.update(zip(new, self._merge_many([p.encode() for p in new])))
            data = list(map(known.__getitem__, pieces))
            begin = 0
            for i, end in zip(together, (at + 1).tolist()):
                out[i] = data[begin] if end == begin + 1 else b"".join(data[begin:end])
                begin = end
        return [array("i", self.encode_word(w)).tobytes() if b is None else b for w, b in zip(words, out)]

    def _pair_ranks(self, x: np.ndarray, y: np.ndarray) -> np.ndarray:
        key = x.astype(np.int64) << 32 | y
        at = np.minimum(np.searchsorted(self._keys, key), len(self._keys) - 1)
        return np.where(self._keys[at] == key, self._ranks[at], len(self._keys))

    def _merge_many(self, pieces: list[bytes]) -> list[bytes]:
        """Each round makes the leftmost best merge of every piece that still has one."""
        if not pieces:
            return []
        none = len(self._keys)
        ids = self._first[np.frombuffer(b"".join(pieces), np.uint8)]
        word = np.repeat(np.arange(len(pieces)), np.fromiter(map(len, pieces), np.int64, len(pieces)))
        done: list[tuple[np.ndarray, np.ndarray]] = []
        rank = np.full(len(ids), none)
        same = word[1:] == word[:-1]
        rank[:-1][same] = self._pair_ranks(ids[:-1][same], ids[1:][same])
        while len(ids):
            begin = np.flatnonzero(np.append(True, word[1:] != word[:-1]))
            low = np.minimum.reduceat(rank, begin)
            size = np.diff(np.append(begin, len(ids)))
            if (over := low == none).any():
                rest = np.repeat(over, size)
                done.append((word[rest], ids[rest]))
                word, ids, rank = word[~rest], ids[~rest], rank[~rest]
                low, size = low[~over], size[~over]
                if not len(ids):
                    break
            best = np.flatnonzero(rank == np.repeat(low, size))
            best = best[np.append(True, word[best[1:]] != word[best[:-1]])]
            ids[best] = self._made[low]
            keep = np.ones(len(ids), bool)
            keep[best + 1] = False
            best -= np.arange(len(best))  # one symbol fewer for each merge before
            word, ids, rank = word[keep], ids[keep], rank[keep]
            for left in (best - 1, best):
                ok = (left >= 0) & (left + 1 < len(ids))
                inside = np.zeros(len(left), bool)
                inside[ok] = word[left[ok]] == word[left[ok] + 1]
                at = left[inside]
                rank[at] = self._pair_ranks(ids[at], ids[at + 1])
                last = left[ok & ~inside] if left is not best else left[~inside]
                rank[last] = none
        word = np.concatenate([w for w, _ in done])
        ids = np.concatenate([x for _, x in done])
        order = np.argsort(word, kind="stable")
        data = ids[order].astype("<i4").tobytes()
        cut = (4 * np.searchsorted(word[order], np.arange(len(pieces) + 1))).tolist()
        return [data[a:b] for a, b in zip(cut, cut[1:])]

    def _piece(self, piece: str) -> list[int]:
        ids = self.known.get(piece)
        if ids is None:
            ids = self._merge(piece)
            if len(piece) <= LONG_WORD:
                if len(self.known) >= MEMO_PIECES:
                    self.known.clear()
                self.known[piece] = ids
        return ids

    def _merge(self, piece: str) -> list[int]:
        first = self.first
        parts = [first[b] for b in piece.encode()]
        rank, none = self.rank.get, len(self.rank)
        if len(parts) > 2 * LONG_WORD:
            return self._merge_long(parts)
        ranks = [rank(x << 32 | y, none) for x, y in zip(parts, parts[1:])]
        while ranks and (low := min(ranks)) != none:
            k = ranks.index(low)
            parts[k:k + 2] = [self.made[low]]
            del ranks[k]
            if k < len(ranks):
                ranks[k] = rank(parts[k] << 32 | parts[k + 1], none)
            if k:
                ranks[k - 1] = rank(parts[k - 1] << 32 | parts[k], none)
        return parts

    def _merge_long(self, parts: list[int]) -> list[int]:
        """The same merges through a heap, for words of any length."""
        n, rank = len(parts), self.rank
        after, before = [*range(1, n), -1], [-1, *range(n - 1)]
        heap = [(rank[p], i) for i, (x, y) in enumerate(zip(parts, parts[1:])) if (p := x << 32 | y) in rank]
        heapq.heapify(heap)
        while heap:
            r, i = heapq.heappop(heap)
            j = after[i] if parts[i] >= 0 else -1
            if j < 0 or rank.get(parts[i] << 32 | parts[j]) != r:
                continue
            parts[i], parts[j] = self.made[r], -1
            after[i] = after[j]
            if after[j] >= 0:
                before[after[j]] = i
            for x, y in ((before[i], i), (i, after[i])):
                if x >= 0 and y >= 0 and (p := parts[x] << 32 | parts[y]) in rank:
                    heapq.heappush(heap, (rank[p], x))
        return [p for p in parts if p >= 0]


class Lexicon:
    """A minimal acyclic automaton over words (bytes) with a list of ids for each.

    States are merged bottom-up while sorted words come in, so equal suffixes
    are shared. An edge carries the number of words that come before those
    behind it; their sum along a path is the word's number, which leads to its ids.
    """

    _ARRAYS = (("keys", "<i8"), ("target", "<i4"), ("skip", "<i4"), ("final", "|u1"), ("offsets", "<i4"), ("ids", "<i4"))

    def __init__(self, arrays: dict[str, np.ndarray]):
        self.__dict__.update(arrays)

    @classmethod
    def build(cls, words: Iterable[bytes], encode: Callable[[bytes], list[int]]) -> Lexicon:
        words = sorted({w for w in words if w})
        known: dict[tuple, int] = {}
        states: list[tuple[bool, tuple[tuple[int, int], ...]]] = []

        def freeze(node: list) -> int:
            key = (node[0], tuple(node[1]))
            if key not in known:
                known[key] = len(states)
                states.append(key)
            return known[key]

        path: list[list] = [[False, [], -1]]  # final, edges so far, label from the parent
        last = b""
        for w in [*words, None]:
            same = 0
            if w is not None:
                limit = min(len(w), len(last))
                while same < limit and w[same] == last[same]:
                    same += 1
            while len(path) > same + 1:
                node = path.pop()
                path[-1][1].append((node[2], freeze(node)))
            if w is None:
                break
            path += [[False, [], b] for b in w[same:]]
            path[-1][0] = True
            last = w
        root = freeze(path[0])
        below = [0] * len(states)
        keys, target, skip = [], [], []
        for s, (final, edges) in enumerate(states):  # children are frozen before their parents
            n = int(final)
            for label, to in edges:
                keys.append(s * 256 + label)
                target.append(to)
                skip.append(n)
                n += below[to]
            below[s] = n
        order = np.argsort(np.array(keys, np.int64), kind="stable")
        outs = [encode(w) for w in words]
        return cls({"keys": np.array([root, *np.array(keys, np.int64)[order]], "<i8"),  # the root comes first
                    "target": np.array(target, "<i4")[order], "skip": np.array(skip, "<i4")[order],
                    "final": np.array([f for f, _ in states], "|u1"),
                    "offsets": np.cumsum([0, *map(len, outs)]).astype("<i4"),
                    "ids": np.array([i for o in outs for i in o], "<i4")})

    def dump(self) -> bytes:
        arrays = [(k, np.ascontiguousarray(getattr(self, k), d)) for k, d in self._ARRAYS]
        head = json.dumps([[k, len(a)] for k, a in arrays]).encode().ljust(512)
        return head + b"".join(a.tobytes().ljust(-(-a.nbytes // 8) * 8, b"\0") for _, a in arrays)

    @classmethod
    def load(cls, path: str) -> Lexicon:
        """Memory-map a dumped lexicon; workers of one machine share its pages."""
        with open(path, "rb") as f:
            data = mmap.mmap(f.fileno(), 0, access=mmap.ACCESS_READ)
        at, out = 512, {}
        kinds = dict(cls._ARRAYS)
        for k, n in json.loads(data[:512]):
            out[k] = np.frombuffer(data, kinds[k], n, at)
            at += -(-out[k].nbytes // 8) * 8
        return cls(out)

    def _edges(self) -> tuple[np.ndarray, np.ndarray, int]:
        """Edges by a hash of their key, in a table at most half full: key (-1: none), edge number, and the shift."""
        if not hasattr(self, "_table"):
            keys = np.array(self.keys[1:], np.int64)
            bits = max(4, int(2 * len(keys)).bit_length())
            slots, edges = np.full(1 << bits, -1, np.int64), np.zeros(1 << bits, np.int64)
            at = (keys.astype(np.uint64) * _SPREAD >> np.uint64(64 - bits)).astype(np.int64)
            rest = np.arange(len(keys))
            while len(rest):  # each round the first of those that want a free slot gets it
                free = rest[slots[at[rest]] < 0]
                place, who = np.unique(at[free], return_index=True)
                slots[place], edges[place] = keys[free[who]], free[who]
                rest = np.setdiff1d(rest, free[who], assume_unique=True)
                at[rest] = (at[rest] + 1) & ((1 << bits) - 1)
            self._table = (slots, edges, bits)
        return self._table

    def _step(self, want: np.ndarray) -> np.ndarray:
        """The edge of each key, -1 where there is none."""
        slots, edges, bits = self._edges()
        at = (want.astype(np.uint64) * _SPREAD >> np.uint64(64 - bits)).astype(np.int64)
        found = np.full(len(want), -1, np.int64)
        rest = np.arange(len(want))
        while len(rest):
            here = slots[at[rest]]
            hit = here == want[rest]
            found[rest[hit]] = edges[at[rest[hit]]]
            rest = rest[~hit & (here >= 0)]
            at[rest] = (at[rest] + 1) & ((1 << bits) - 1)
        return found

    def find(self, words: list[bytes]) -> np.ndarray:
        """The number of each word, -1 where it is not in the lexicon; all words step together."""
        number = np.full(len(words), -1, np.int64)
        if len(self.keys) < 2 or not words:
            return number
        text = np.frombuffer(b"".join(words), np.uint8)
        size = np.fromiter(map(len, words), np.int64, len(words))
        start = np.cumsum(size) - size
        live = np.flatnonzero((size > 0) & (size <= 2 * LONG_WORD))
        state = np.full(len(live), self.keys[0], np.int64)
        rank = np.zeros(len(live), np.int64)
        step = 0
        while len(live):
            at = self._step(state * 256 + text[start[live] + step])
            ok = at >= 0
            live, at = live[ok], at[ok]
            rank, state = rank[ok] + self.skip[at], self.target[at].astype(np.int64)
            step += 1
            done = size[live] == step
            hit = done & (self.final[state] == 1)
            number[live[hit]] = rank[hit]
            live, state, rank = live[~done], state[~done], rank[~done]
        return number

    def ids_of(self, number: int) -> bytes:
        return self.ids[self.offsets[number]:self.offsets[number + 1]].tobytes()


class WordEncoder:
    """Ids of texts through a memo of recent words; ``fresh`` gives the ids (as bytes) of new ones.

    The memo has two generations: a full one becomes the older, and words still in
    use move to the new one, so frequent words are never asked for again. The
    first word of a text, which has no space before it, is a key of its own kind.
    """

    def __init__(self, fresh: Callable[[list[str]], list[bytes]], vocabulary: Vocabulary | None = None):
        self.fresh, self.vocabulary, self.memo, self.older = fresh, vocabulary, {}, {}

    def encode(self, texts: list[str]) -> list[bytes]:
        """Little-endian 32-bit ids of each text."""
        parts = [words_of(t) for t in texts]
        for p in parts:
            p[0] = (p[0],)
        memo, older = self.memo, self.older
        new = set().union(*parts)
        new -= memo.keys()
        back = new & older.keys()
        new -= back
        for w in back:
            memo[w] = older[w]
        more = list(new)
        memo.update(zip(more, self.fresh([w[0] if type(w) is tuple else " " + w for w in more])))
        get = memo.__getitem__
        out = [b"".join(map(get, p)) for p in parts]
        for w in more:
            if type(w) is tuple or len(w) > LONG_WORD:
                del memo[w]
        if len(memo) > MEMO_WORDS:
            self.older, self.memo = memo, {}
        return out


    def forget(self) -> None:
        """Give back the memory of the memos, as a worker does when its task ends."""
        self.memo, self.older = {}, {}
        if self.vocabulary:
            self.vocabulary.known, self.vocabulary.pieces, self.vocabulary.older_pieces = {}, {}, {}


_workers: dict[str, WordEncoder] = {}


def lexicon_encoder(source: str, lexicon: str) -> WordEncoder:
    """The worker's encoder; ``lexicon`` names a file that Spark has brought to the executor."""
    if lexicon not in _workers:
        vocabulary, known = Vocabulary(source), Lexicon.load(SparkFiles.get(lexicon))

        def fresh(words: list[str]) -> list[bytes]:
            number = known.find([w.encode() for w in words]).tolist()
            unseen = iter(vocabulary.encode_words([w for k, w in zip(number, words) if k < 0]))
            return [known.ids_of(k) if k >= 0 else next(unseen) for k in number]

        _workers.clear()
        _workers[lexicon] = WordEncoder(fresh, vocabulary)
    return _workers[lexicon]


def groups(texts: list[str | None], size: int = 1 << 20) -> Iterator[list[str]]:
    """Texts (null: empty) in runs of about ``size`` characters, so that memory stays bounded."""
    run, n = [], 0
    for t in texts:
        run.append(t or "")
        n += len(t or "")
        if n >= size:
            yield run
            run, n = [], 0
    if run:
        yield run


def word_counts(docs: DataFrame, text: str = "text") -> DataFrame:
    """How often each word (``word``, with the space before it) occurs in all texts: ``n``."""

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seen: Counter = Counter()  # words behind a space, without it
        first: Counter = Counter()
        for batch in pieces(batches):
            for t in batch.column(0).to_pylist():
                if t:
                    p = words_of(t)
                    first[p[0]] += 1
                    del p[0]
                    seen.update(p)
                if len(seen) + len(first) > FLUSH_WORDS:
                    yield _counted(seen, first)
                    seen.clear()
                    first.clear()
        if seen or first:
            yield _counted(seen, first)
        seen.clear()
        first.clear()
        give_back()

    return (docs.select(F.col(text).alias("text")).mapInArrow(count, "word string, n long")
            .groupBy("word").agg(F.sum("n").alias("n")))


def _counted(seen: Counter, first: Counter) -> pa.RecordBatch:
    rows = [(" " + w, n) for w, n in seen.items() if len(w) < LONG_WORD]
    rows += [(w, n) for w, n in first.items() if 0 < len(w) <= LONG_WORD]
    return pa.RecordBatch.from_arrays([pa.array([w for w, _ in rows], pa.string()),
                                       pa.array([n for _, n in rows], pa.int64())], ["word", "n"])


def build_lexicon(docs: DataFrame, source: str, text: str = "text", words: int = LEXICON_WORDS) -> str:
    """Compile the most frequent words, ``words`` at most (words of equal count all or none), and
    bring the file to all executors; returns its name."""
    spark = docs.sparkSession
    counts = saved(word_counts(docs, text), "word-counts")
    # how many words have each count, from the largest on; the words up to the bound are collected, no others
    steps = (counts.groupBy("n").agg(F.count(F.lit(1)).alias("m"))
             .select("n", F.sum("m").over(W.orderBy(F.desc("n"))).alias("upto")))
    least = steps.where(F.col("upto") <= words).agg(F.min("n")).first()[0]
    top = [r["word"] for r in counts.where(F.col("n") >= least).select("word").collect()] if least is not None else []
    vocabulary = Vocabulary(source)
    made = Lexicon.build((w.encode() for w in top), lambda w: vocabulary.encode_word(w.decode()))
    name = f"lexicon-{uuid.uuid4().hex}.bin"
    uri = workspace(spark, "lexicon")
    store, path = fs.FileSystem.from_uri(uri if "://" in uri or uri.startswith("file:") else f"file://{uri}")
    store.create_dir(path, recursive=True)
    with store.open_output_stream(f"{path}/{name}") as f:
        f.write(made.dump())
    spark.sparkContext.addFile(f"{uri}/{name}")
    return name


class _Decoder:
    """Texts of ids by one gather from the bytes of all tokens."""

    def __init__(self, known: dict[int, bytes]):
        table = [known.get(i, b"") for i in range(max(known, default=-1) + 1)] + [b""]  # the last one for ids it lacks
        self.flat = np.frombuffer(b"".join(table), np.uint8)
        self.size = np.array([len(b) for b in table], np.int64)
        self.start = np.cumsum(self.size) - self.size

    def texts(self, values: np.ndarray, offsets: np.ndarray) -> list[str]:
        out: list[str] = []
        a, count = 0, len(offsets) - 1
        while a < count:  # some documents at a time, of about DECODE_IDS ids
            b = max(a + 1, int(np.searchsorted(offsets, offsets[a] + DECODE_IDS, side="right")) - 1)
            ids = np.nan_to_num(values[offsets[a]:offsets[b]], nan=-1).astype(np.int64)
            ids[(ids < 0) | (ids >= len(self.size))] = len(self.size) - 1
            n = self.size[ids]
            end = np.cumsum(n)
            data = self.flat[np.repeat(self.start[ids] - (end - n), n) + np.arange(n.sum())].tobytes()
            cut = np.r_[0, end][offsets[a:b + 1] - offsets[a]].tolist()
            out += [data[x:y].decode("utf-8", "replace") for x, y in zip(cut, cut[1:])]
            a = b
        return out


def encode(docs: DataFrame, tokenizer: str, text: str = "text", out: str = "ids", lexicon: str | None = None,
           decoded: str | None = None) -> DataFrame:
    """``docs`` with the token ids (array of int) of each whole text in ``out``, behind its columns.

    The ids are those of the tokenizer library for the tokenizer file's path
    ``tokenizer``, without added special tokens. A null or empty text has no
    ids; every row stays. ``decoded`` names a column for what the ids decode to,
    as ``decode`` would give it, in the same pass. Columns of these names are
    replaced.
    """
    spark = docs.sparkSession
    with open(tokenizer, encoding="utf-8") as f:
        source = f.read()
    lexicon = lexicon or build_lexicon(docs, source, text)
    sent = spark.sparkContext.broadcast(source)  # the vocabulary file: a fixed size
    keep = [c for c in docs.columns if c not in (out, decoded)]
    made = [T.StructField(out, T.ArrayType(T.IntegerType()))] + ([T.StructField(decoded, T.StringType())] if decoded else [])
    schema = T.StructType([*(docs.schema[c] for c in keep), *made])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder, decoder = lexicon_encoder(sent.value, lexicon), None
        for batch in pieces(batches):
            texts = batch.column(batch.schema.get_field_index(text)).to_pylist()
            data = [b for g in groups(texts) for b in encoder.encode(g)]
            offsets = np.cumsum([0, *(len(b) // 4 for b in data)])
            ids = np.frombuffer(b"".join(data), "<i4")
            columns = [pa.ListArray.from_arrays(pa.array(offsets.astype(np.int32)), pa.array(ids))]
            if decoded:
                decoder = decoder or _Decoder(encoder.vocabulary.bytes)
                columns.append(pa.array(decoder.texts(ids, offsets), pa.string()))
            yield pa.RecordBatch.from_arrays([*(batch.column(batch.schema.get_field_index(c)) for c in keep), *columns], schema.names)
        encoder.forget()
        give_back()

    return docs.mapInArrow(run, schema)


def decode(docs: DataFrame, tokenizer: str, ids: str = "ids", out: str = "decoded") -> DataFrame:
    """``docs`` with the text of its ids in ``out``, special tokens included, behind its columns.

    Null or no ids give an empty text; ids that the vocabulary lacks give
    nothing; bytes that are not UTF-8 become replacement characters.
    """
    with open(tokenizer, encoding="utf-8") as f:
        sent = docs.sparkSession.sparkContext.broadcast(Vocabulary(f.read()).bytes)

    def run(rows: pa.ListArray) -> pa.Array:
        decoder = _Decoder(sent.value)
        return pa.array(decoder.texts(rows.values.to_numpy(zero_copy_only=False), rows.offsets.to_numpy().astype(np.int64)), pa.string())

    return with_column(docs, ids, out, T.StringType(), run)
