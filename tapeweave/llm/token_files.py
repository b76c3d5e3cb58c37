"""Token ids in binary files of shuffled planes.

A file holds the ids of a range of documents one after the other, cut into
blocks of ``BLOCK`` ids. A block is transposed into planes (all lowest bytes,
then the next ones, or single bits), so that a plane holds alike values, and
each plane is a zstandard frame. The index behind the blocks has each block's
place, number of ids and plane sizes, and each document's id and length, so one
document is read from the blocks that hold it.

    file   = MAGIC block* index trailer
    block  = plane*                       planes of one block, low ones first
    index  = zstandard(header JSON, newline, block table, document table)
    trailer = place of the index (8 bytes), MAGIC
"""

from __future__ import annotations

import io
import json
import os
import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import zstandard
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from tapeweave.llm.bpe import groups
from tapeweave.llm.common import give_back, saved
from tapeweave.llm.shared_files import attempt_name, open_store

MAGIC = b"TWPLANE1"
BLOCK = 1 << 16
LEVEL = 3
_NULL_ID = -(1 << 63)
TOGETHER = 512  # pieces that go to the library as one text
CHUNK = 8 << 20  # bytes of text that are cut and encoded in one step; a longer text is one step
MEMO_PIECES = 500_000  # pieces of texts that a worker keeps with their ids
LONG_PIECE = 64  # longer ones are not kept

# Kinds of bytes: 0 visible, 1 white space, 2 neither for certain.
_KIND = np.zeros(256, np.uint8)
_KIND[:32] = _KIND[127] = 2
_KIND[[9, 10, 11, 12, 13, 32]] = 1
_CLOSE, _ALNUM = np.zeros(256, bool), np.zeros(256, bool)
_CLOSE[list(b".,;:!?")] = True
_ALNUM[[k for k in range(128) if chr(k).isalnum()]] = True
# White space beyond ASCII, by its bytes in UTF-8.
_WIDE_CHARS = "\x85\xa0\u1680\u180e\u2000\u2001\u2002\u2003\u2004\u2005\u2006\u2007\u2008\u2009\u200a\u2028\u2029\u202f\u205f\u3000"
_WIDE = [[int.from_bytes(c.encode()) for c in _WIDE_CHARS if len(c.encode()) == n] for n in (2, 3)]
_WIDE_LEAD = np.zeros(256, bool)
_WIDE_LEAD[[c.encode()[0] for c in _WIDE_CHARS]] = True


def to_planes(ids: np.ndarray, bits: bool) -> list[bytes]:
    """Planes of 32-bit ids: 4 of bytes or 32 of bits."""
    rows = np.ascontiguousarray(ids, "<u4").view(np.uint8).reshape(-1, 4)
    if not bits:
        return [np.ascontiguousarray(rows[:, k]).tobytes() for k in range(4)]
    spread = np.unpackbits(rows, axis=1, bitorder="little")
    return [np.packbits(spread[:, k], bitorder="little").tobytes() for k in range(32)]


def from_planes(planes: list[bytes], n: int, bits: bool) -> np.ndarray:
    if not bits:
        return np.stack([np.frombuffer(p, np.uint8) for p in planes], 1).reshape(-1).view("<u4")
    spread = np.stack([np.unpackbits(np.frombuffer(p, np.uint8), count=n, bitorder="little") for p in planes], 1)
    return np.packbits(spread, axis=1, bitorder="little").reshape(-1).view("<u4")


class IdWriter:
    """Writes one file; memory holds one block and the index."""

    def __init__(self, out, block: int = BLOCK, bits: bool = False, level: int = LEVEL):
        self.out, self.block, self.bits = out, block, bits
        self.pack = zstandard.ZstdCompressor(level=level)
        self.at, self.table, self.docs, self.waiting, self.held = len(MAGIC), [], [], [], 0
        out.write(MAGIC)

    def add(self, doc: int | None, ids: np.ndarray) -> None:
        self.docs.append((_NULL_ID if doc is None else doc, len(ids)))
        self.waiting.append(ids)
        self.held += len(ids)
        if self.held >= self.block:
            ids = np.concatenate(self.waiting)
            whole = len(ids) // self.block * self.block
            for i in range(0, whole, self.block):
                self._write(ids[i:i + self.block])
            self.waiting, self.held = [ids[whole:]], len(ids) - whole

    def _write(self, ids: np.ndarray) -> None:
        frames = [self.pack.compress(p) for p in to_planes(ids, self.bits)]
        self.table.append((self.at, len(ids), *map(len, frames)))
        for f in frames:
            self.out.write(f)
            self.at += len(f)

    def close(self) -> tuple[int, int]:
        """Number of documents and of ids."""
        if self.held:
            self._write(np.concatenate(self.waiting))
        head = {"bits": self.bits, "blocks": len(self.table), "docs": len(self.docs), "planes": 32 if self.bits else 4}
        self.out.write(self.pack.compress(
            json.dumps(head).encode() + b"\n" + np.array(self.table, "<i8").tobytes()
            + np.array(self.docs, "<i8").reshape(-1, 2).T.tobytes()))
        self.out.write(self.at.to_bytes(8, "little") + MAGIC)
        return len(self.docs), sum(n for _, n in self.docs)


class IdFile:
    """Reads one file through its index."""

    def __init__(self, source, size: int):
        self.source, self.unpack = source, zstandard.ZstdDecompressor()
        tail = self._read(size - 16, 16)
        if tail[8:] != MAGIC:
            raise ValueError("not a token-id file, or cut short")
        at = int.from_bytes(tail[:8], "little")
        head, _, data = self.unpack.decompressobj().decompress(self._read(at, size - 16 - at)).partition(b"\n")
        head = json.loads(head)
        self.bits, width = head["bits"], 2 + head["planes"]
        table = np.frombuffer(data, "<i8", head["blocks"] * width).reshape(-1, width)
        self.places, self.counts, self.frames = table[:, 0], table[:, 1], table[:, 2:]
        docs = np.frombuffer(data, "<i8", 2 * head["docs"], table.nbytes)
        self.docs, self.sizes = docs[:head["docs"]], docs[head["docs"]:]
        self.starts = np.cumsum(self.sizes) - self.sizes
        self.edges = np.cumsum([0, *self.counts])
        self._held = (-1, np.zeros(0, "<u4"))

    def _read(self, at: int, n: int) -> bytes:
        self.source.seek(at)
        return self.source.read(n)

    def _block(self, b: int) -> np.ndarray:
        if self._held[0] != b:
            data = self._read(int(self.places[b]), int(self.frames[b].sum()))
            cut = np.cumsum([0, *self.frames[b]]).tolist()
            planes = [self.unpack.decompress(data[x:y]) for x, y in zip(cut, cut[1:])]
            self._held = (b, from_planes(planes, int(self.counts[b]), self.bits))
        return self._held[1]

    def ids(self, doc: int) -> np.ndarray:
        """Ids of the document at place ``doc`` of the file; reads the blocks that hold it."""
        a, n = int(self.starts[doc]), int(self.sizes[doc])
        out = []
        b = int(np.searchsorted(self.edges, a, side="right")) - 1
        while n > 0:
            low = a - int(self.edges[b])
            piece = self._block(b)[low:low + n]
            out.append(piece)
            a, n, b = a + len(piece), n - len(piece), b + 1
        return np.concatenate([*out, np.zeros(0, "<u4")])


def cuts(data: bytes, starts: np.ndarray) -> np.ndarray:
    """Where the pieces of some texts begin: ``data`` holds the texts, ``starts`` where each begins.

    The byte-level pre-tokenizer breaks at each of these places and what lies
    between two of them is split there as it is in the whole text: before white
    space that follows something visible, around the last sign of white space
    before something visible (a space stays with the word behind it), and before
    closing punctuation that follows a letter or digit. Other breaks are left to
    the library. Control characters and white space beyond ASCII end the rules.
    """
    at = np.zeros(len(data) + 1, bool)
    at[starts] = True
    own = at.copy()  # where texts begin
    b = np.frombuffer(data, np.uint8)
    if len(b) > 1:
        kind = _KIND[b]
        lead = np.flatnonzero(_WIDE_LEAD[b])
        for k in range(2 if len(lead) else 0):  # of two bytes, of three bytes
            here = lead[lead < len(b) - 1 - k]
            code = b[here].astype(np.int32) << 8 | b[here + 1]
            here = here[np.isin(code << 8 | b[here + 2] if k else code, _WIDE[k])]
            for i in range(2 + k):
                kind[here + i] = 2
        white, seen = kind == 1, kind == 0
        at[1:-1] |= white[1:] & seen[:-1]
        at[1:-2] |= white[1:-1] & white[:-2] & seen[2:] & ~own[2:-1]
        at[1:-1] |= seen[1:] & white[:-1] & (b[:-1] != 32) & at[:-2]
        close = np.flatnonzero(_CLOSE[b[1:]]) + 1
        last, before = b[close - 1], b[np.maximum(close - 2, 0)]
        at[close[_ALNUM[last] | (before == 0xC3) & (last > 0x7F) & (last != 0x97) & (last != 0xB7)]] = True  # Latin-1 letters
    return np.flatnonzero(at[:-1])


class LibraryEncoder:
    """Texts through the tokenizers library, each distinct piece once as long as it is remembered.

    Texts are taken some at a time and cut where the pre-tokenizer breaks for
    certain (``cuts``). The pieces that are not in ``memo`` go to the library, many as
    one text. Pieces of letters alone are one word to the pre-tokenizer and go to the
    library's merges by themselves, the others through the whole tokenizer with
    newlines between them: that is an id which no such piece has. What can touch its
    neighbours there goes alone, such as added tokens; texts go whole where an added token takes its
    surroundings, and all texts of tokenizers that are not byte-level BPE do.
    """

    def __init__(self, source: str):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer, pre_tokenizers

        self.whole = Tokenizer.from_str(source)
        self.whole.no_truncation()
        self.whole.no_padding()
        spec = json.loads(source)
        model, before = spec["model"], spec["pre_tokenizer"] or {}
        added = spec.get("added_tokens") or []
        self.added = [t["content"] for t in added if t["content"]]
        # the library splits a text at added tokens before all else; where that depends on what is beside them, texts go whole
        plain = not any(t.get(k) for t in added for k in ("single_word", "lstrip", "rstrip")) and len({t.get("normalized") for t in added}) < 2
        self.apart = re.compile(b"|".join(re.escape(t.encode()) for t in sorted(self.added, key=len, reverse=True))) if plain and added else None
        char = {}  # the character that stands for each byte in the vocabulary
        for k in range(256):
            char[k] = chr(k) if 33 <= k <= 126 or 161 <= k <= 172 or k >= 174 else chr(256 + k - len([c for c in char.values() if c < "\u0100"]))
        self.newline = None
        if before.get("type") == "ByteLevel" and before.get("use_regex", True) and not before.get("add_prefix_space") \
                and not spec["normalizer"] and model["type"] == "BPE" and set(char.values()) <= model["vocab"].keys() \
                and not any(model.get(k) for k in ("dropout", "continuing_subword_prefix", "end_of_word_suffix")) \
                and not any("\n" in t for t in self.added):
            self.newline = self._library(["\n"])[0]
            self.newline = int(self.newline[0]) if len(self.newline) == 1 else None
        if self.newline is not None:
            self.merges = Tokenizer.from_str(json.dumps(spec | {
                "added_tokens": [], "pre_tokenizer": None, "post_processor": None, "truncation": None, "padding": None}))
            self.merges.pre_tokenizer = pre_tokenizers.CharDelimiterSplit("\n")
            self.shown = np.array([ord(char[k]) for k in range(256)], "<u2")
            self.shown[10] = 10
            self.sizes = np.zeros(max(model["vocab"].values()) + 1, np.int64)  # bytes of each id
            for t, i in model["vocab"].items():
                self.sizes[i] = len(t)
        self.letters: dict[str, bool] = {}
        self.memo = pa.array([], pa.binary())
        self.memo_ids = _lists([0], np.zeros(0, "<u4"))

    def _library(self, texts: list[str]) -> list[np.ndarray]:
        return [np.array(e.ids, "<u4") for e in self.whole.encode_batch_fast(texts, add_special_tokens=False)]

    @staticmethod
    def _holders(data: bytes, edges: np.ndarray, added: list[str]) -> set[int]:
        """The texts that hold an added token."""
        found = set()
        for t in added:
            k = data.find(t.encode())
            while k >= 0:
                d = int(np.searchsorted(edges, k, side="right"))  # the text behind
                found.add(d - 1)
                k = data.find(t.encode(), int(edges[d]))
        return found

    def _is_letter(self, c: str) -> bool:
        """Whether the pre-tokenizer, too, takes it for a letter."""
        if c not in self.letters:
            self.letters[c] = len(self.whole.pre_tokenizer.pre_tokenize_str(f"a{c}a")) == 1
        return self.letters[c]

    def _words(self, words: list[str]) -> tuple[np.ndarray, list[np.ndarray]]:
        """How many ids each piece of letters has, and the ids of all."""
        counts, out = [], []
        for i in range(0, len(words), TOGETHER):
            data = "\n".join(words[i:i + TOGETHER]).encode()
            b = np.frombuffer(data, np.uint8)
            found, = self.merges.encode_batch_fast([self.shown[b].tobytes().decode("utf-16-le")], add_special_tokens=False)
            out.append(np.array(found.ids, "<u4"))
            ends = np.cumsum(self.sizes[out[-1]])
            want = np.append(np.flatnonzero(b == 10), len(b))
            want -= np.arange(len(want))
            at = np.minimum(np.searchsorted(ends, want), len(ends) - 1)
            if not (ends[at] == want).all():
                raise AssertionError("a word ran into the next one")
            counts.append(np.diff(at, prepend=-1))
        return np.concatenate([np.zeros(0, np.int64), *counts]), out

    def _beside(self, pieces: list[str]) -> list[np.ndarray]:
        """Ids of pieces that keep to themselves between newlines."""
        out: list[np.ndarray] = []
        for i in range(0, len(pieces), TOGETHER):
            ids, = self._library(["\n".join(pieces[i:i + TOGETHER])])
            at = np.flatnonzero(ids == self.newline)
            out += [ids[a:b] for a, b in zip([0, *(at + 1).tolist()], [*at.tolist(), len(ids)])]
        if len(out) != len(pieces):
            raise AssertionError("a piece ran into the next one")
        return out

    def _fresh(self, pieces: pa.Array, added: list[str]) -> pa.Array:
        """Lists of the ids of pieces that are not remembered; none holds an added token but those in ``added``."""
        texts = pieces.cast(pa.string()).to_pylist()
        words, beside, alone = [], [], []
        for i, x in enumerate(texts):
            if added and any(t in x for t in added):
                alone.append(i)
            elif x[1:].isalpha() and (x[0] == " " or x[0].isalpha()):
                words.append(i)
            elif x.isprintable() and x != " " and " " not in x[1:]:
                beside.append(i)
            else:
                alone.append(i)
        strange = {c for c in set("".join([texts[i] for i in words])) if c != " " and not self._is_letter(c)}
        if strange:
            beside += [i for i in words if not strange.isdisjoint(texts[i])]
            words = [i for i in words if strange.isdisjoint(texts[i])]
        counts, ids = self._words([texts[i] for i in words])
        rest = self._beside([texts[i] for i in beside])
        for group in groups([texts[i] for i in alone], 1 << 16):
            rest += self._library(group)
        offsets = np.cumsum(np.concatenate([[0], counts, np.array([len(x) for x in rest], np.int64)]))
        made = _lists(offsets, np.concatenate([np.zeros(0, "<u4"), *ids, *rest]))
        place = np.empty(len(texts), np.int64)
        place[[*words, *beside, *alone]] = np.arange(len(texts))
        return made.take(pa.array(place))

    def _chunk(self, texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        if self.newline is None:
            ids = [x for group in groups(texts.to_pylist()) for x in self._library(group)]
            return np.concatenate([np.zeros(0, "<u4"), *ids]), np.cumsum([0, *map(len, ids)])
        wide = np.int64 if pa.types.is_large_string(texts.type) else np.int32
        edges = np.frombuffer(texts.buffers()[1], wide)[texts.offset:texts.offset + len(texts) + 1].astype(np.int64)
        data = texts.buffers()[2].slice(edges[0], edges[-1] - edges[0]).to_pybytes() if edges[-1] > edges[0] else b""
        edges -= edges[0]
        added = [t for t in self.added if t.encode() in data]
        held = []  # the places of added tokens, or of the texts that hold them
        for d in sorted(self._holders(data, edges, added)):
            a, b = int(edges[d]), int(edges[d + 1])
            held += [m.span() for m in self.apart.finditer(data, a, b)] if self.apart else [(a, b)]
        held = np.array(held, np.int64).reshape(-1, 2)
        begin = cuts(data, np.concatenate([edges[:-1], held.ravel()]))
        inside = np.zeros(len(begin) + 1, np.int64)
        np.add.at(inside, np.searchsorted(begin, held[:, 0] + 1), 1)
        np.add.at(inside, np.searchsorted(begin, held[:, 1]), -1)
        begin = begin[np.cumsum(inside[:-1]) == 0]
        pieces = pa.Array.from_buffers(pa.binary(), len(begin), [None, pa.py_buffer(np.append(begin, len(data)).astype(np.int32)), pa.py_buffer(data)])
        pieces = pieces.dictionary_encode()
        names = pieces.dictionary
        place = pc.index_in(names, self.memo)
        new = names.filter(place.is_null())
        made = pa.concat_arrays([self.memo_ids, self._fresh(new, added)])
        place = place.to_numpy(zero_copy_only=False).copy()
        unknown = np.isnan(place)
        place[unknown] = np.arange(len(self.memo), len(made))
        ids = made.take(pa.array(place.astype(np.int64)))  # of each name
        self._remember(names, ids, new, made)
        size = pc.list_value_length(ids).to_numpy()
        number = pieces.indices
        upto = np.append(0, np.cumsum(size[number.to_numpy()], dtype=np.int64))
        return ids.take(number).flatten().to_numpy(), upto[np.searchsorted(begin, edges)]

    def _remember(self, names: pa.Array, ids: pa.Array, new: pa.Array, made: pa.Array) -> None:
        """Keep the new pieces too, or where those are too many the pieces of this step alone."""
        if len(self.memo) + len(new) <= MEMO_PIECES:
            names, ids = pa.concat_arrays([self.memo, new]), made
        names, ids = names[:MEMO_PIECES], ids[:MEMO_PIECES]
        short = pc.less_equal(pc.binary_length(names), LONG_PIECE)
        self.memo, self.memo_ids = names.filter(short), ids.filter(short)

    def chunks(self, texts: pa.Array) -> Iterator[tuple[np.ndarray, np.ndarray]]:
        """Ids of some texts after the other, and where each text's begin and the last one's end; a null is an empty text."""
        size = np.append(0, np.cumsum(pc.binary_length(texts).fill_null(0).to_numpy(), dtype=np.int64))
        a = 0
        while a < len(texts):
            b = max(a + 1, int(np.searchsorted(size, size[a] + CHUNK, side="right")) - 1)
            yield self._chunk(texts[a:b].fill_null(""))
            a = b

    def encode(self, texts: list[str]) -> list[bytes]:
        """Little-endian 32-bit ids of each text."""
        return [ids[a:b].tobytes() for ids, at in self.chunks(pa.array(texts, pa.string())) for a, b in zip(at, at[1:])]


def _lists(offsets, ids: np.ndarray) -> pa.Array:
    return pa.LargeListArray.from_arrays(pa.array(offsets, pa.int64()), pa.array(ids, pa.uint32()))


_workers: dict[str, LibraryEncoder] = {}


def _library_encoder(source: str) -> LibraryEncoder:
    """The worker's encoder."""
    key = str(hash(source))
    if key not in _workers:
        _workers.clear()
        _workers[key] = LibraryEncoder(source)
    return _workers[key]


def write(docs: DataFrame, out: str, tokenizer: str, end: int, id: str = "doc_id", text: str = "text",
          block: int = BLOCK, bits: bool = False, files: int | None = None) -> DataFrame:
    """Encode whole texts and write them to ``files`` files below ``out`` in ascending order of their ids.

    Returns the manifest, one row per file: ``part``, ``file``, ``docs``,
    ``ids`` and ``start`` (ids in the files before). Each document ends with
    the id ``end``; null and empty texts have that id alone. Null document ids
    come first; rows with equal ids follow each other, ordered by the hash of
    their text. An empty table gives no files.
    """
    spark = docs.sparkSession
    with open(tokenizer, encoding="utf-8") as f:
        sent = spark.sparkContext.broadcast(f.read())  # the vocabulary file: a fixed size
    n = files or int(spark.conf.get("spark.sql.shuffle.partitions"))
    rows = docs.select(F.col(id).cast("long").alias("doc"), F.col(text).alias("text"))
    order = ["doc", F.xxhash64("text")]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder = _library_encoder(sent.value)
        store, path = open_store(out)
        part, name = attempt_name("ids", ".twp")
        writer = sink = None
        for batch in batches:
            if not batch.num_rows:
                continue
            if writer is None:
                store.create_dir(path, recursive=True)
                sink = store.open_output_stream(f"{path}/{name}")
                writer = IdWriter(sink, block, bits)
            docs = iter(batch.column(0).to_pylist())
            for ids, at in encoder.chunks(batch.column(1)):
                at = at.tolist()
                for a, b in zip(at, at[1:]):
                    writer.add(next(docs), np.append(ids[a:b], np.uint32(end)))
        if writer is not None:
            count, total = writer.close()
            sink.close()
            give_back()
            yield pa.RecordBatch.from_pylist([{"part": part, "file": name, "docs": count, "ids": total}],
                                             pa.schema([("part", pa.int32()), ("file", pa.string()),
                                                        ("docs", pa.int64()), ("ids", pa.int64())]))

    made = saved(rows.repartitionByRange(n, *order).sortWithinPartitions(*order)
                 .mapInArrow(run, "part int, file string, docs long, ids long"), "token-manifest")
    before = W.orderBy("part").rowsBetween(W.unboundedPreceding, -1)  # one row per file
    return made.withColumn("start", F.coalesce(F.sum("ids").over(before), F.lit(0)).cast("long"))


def read(spark: SparkSession, manifest: DataFrame, out: str) -> DataFrame:
    """Documents of the files: ``doc``, ``start`` (ids of all documents before it), ``n_tokens``
    and ``ids`` (binary, little-endian 32 bits each); a task for each file."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        store, path = open_store(out)
        for batch in batches:
            for name, start in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                with store.open_input_file(f"{path}/{name}") as source:
                    yield from _documents(IdFile(source, source.size()), start)

    files = manifest.select("file", "start").repartition(max(1, manifest.count()), "file")
    return files.mapInArrow(run, "doc long, start long, n_tokens long, ids binary")


def _documents(file: IdFile, start: int, size: int = 4 << 20) -> Iterator[pa.RecordBatch]:
    first, held, rows = 0, 0, []
    for d in range(len(file.docs) + 1):
        if rows and (d == len(file.docs) or held >= size):
            docs = file.docs[first:d]
            yield pa.RecordBatch.from_arrays(
                [pa.array(docs, mask=docs == _NULL_ID), pa.array(file.starts[first:d] + start),
                 pa.array(file.sizes[first:d]), pa.array(rows, pa.binary())], ["doc", "start", "n_tokens", "ids"])
            first, held, rows = d, 0, []
        if d < len(file.docs):
            rows.append(file.ids(d).tobytes())
            held += len(rows[-1])


def open_bytes(data: bytes) -> IdFile:
    return IdFile(io.BytesIO(data), len(data))
