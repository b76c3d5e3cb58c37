"""Long repeated passages of bytes, found by a run-length compressed index.

Equal windows of ``WINDOW`` bytes have equal anchors (see ``anchors``), so every
repeat is settled among the occurrences of one anchor, and the anchors, not the
texts, are shuffled. Anchors that occur once are finished. Occurrences whose
windows are all equal repeat as they are. Only the distinct surroundings that
are left are fetched from the texts and indexed, many anchors to an index of
bounded size: its Burrows-Wheeler transform is kept as runs with the text places
at their ends, the common prefixes are computed at those places alone, and the
longest other match of every position follows from them in one pass over the text.
An anchor with more surroundings than an index may hold is settled by the hashes
of its windows, counted by Spark.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tapeweave.llm.anchors import Hashes, anchors
from tapeweave.llm.common import join_counted, saved

WINDOW = 200
GRAM = 96
INDEX_BYTES = 1 << 20  # of text in one index
_NULL_ID = -(1 << 63)


class RunIndex:
    """Run-compressed Burrows-Wheeler transform of strings, each closed by a mark of its own."""

    def __init__(self, strings: list[bytes]):
        size = np.fromiter(map(len, strings), np.int64, len(strings))
        self.starts = np.cumsum(size + 1) - size - 1
        text = np.empty(int(size.sum()) + len(strings), np.int64)
        ends = self.starts + size
        body = np.ones(len(text), bool)
        body[ends] = False
        text[body] = np.frombuffer(b"".join(strings), np.uint8)
        text[ends] = 256 + np.arange(len(strings))
        self.size = n = len(text)
        # suffix order by doubling; a level's ranks tell equal pieces of 2^level bytes
        levels = [text]
        rank, step = text, 1
        while True:
            key = rank * (n + 257)
            key[:n - step] += rank[step:] + 1
            order = np.argsort(key)
            there = key[order]
            rank = np.empty(n, np.int64)
            rank[order] = np.cumsum(np.append(0, there[1:] != there[:-1]))
            if rank[order[-1]] == n - 1:
                break
            levels.append(rank)
            step *= 2
        before = text[order - 1]
        head = np.append(True, before[1:] != before[:-1])
        tail = np.append(head[1:], True)
        self.symbols, self.lengths = before[head], np.diff(np.append(np.flatnonzero(head), n))
        self.heads, self.tails = order[head], order[tail]  # text places at both ends of each run
        # what stands before the first row of a run and after its last one
        self.above, self.below = np.roll(self.tails, 1), np.roll(self.heads, -1)
        self.head_match = self._common(levels, self.heads, self.above)
        self.tail_match = self._common(levels, self.tails, self.below)
        self.head_match[0] = self.tail_match[-1] = 0

    def _common(self, levels: list[np.ndarray], x: np.ndarray, y: np.ndarray) -> np.ndarray:
        """Common prefix of suffixes, by the levels from the longest down."""
        x, y, both = x.copy(), y.copy(), np.zeros(len(x), np.int64)
        for k in range(len(levels) - 1, -1, -1):
            inside = np.flatnonzero((np.maximum(x, y) < self.size) & (x != y))
            same = inside[levels[k][x[inside]] == levels[k][y[inside]]]
            x[same] += 1 << k
            y[same] += 1 << k
            both[same] += 1 << k
        return both

    def matches(self) -> np.ndarray:
        """For every place the length of its longest match at any other place.

        Within a run the neighbour in suffix order moves along with the place,
        so the match shrinks by one at a time from the last sampled place on.
        """
        best = np.zeros(self.size, np.int64)
        at = np.arange(self.size)
        for places, values in ((self.heads, self.head_match), (self.tails, self.tail_match)):
            sampled = np.zeros(self.size, np.int64)
            sampled[places] = places
            known = np.zeros(self.size, np.int64)
            known[places] = values
            last = np.maximum.accumulate(sampled)
            best = np.maximum(best, known[last] - (at - last))
        return best


def _spans(marked: np.ndarray, window: int) -> list[tuple[int, int]]:
    """Runs of marked window starts as byte ranges."""
    edge = np.diff(np.concatenate([[0], marked.view(np.int8), [0]]))
    return [(int(a), int(b) - 1 + window) for a, b in zip(np.flatnonzero(edge == 1), np.flatnonzero(edge == -1))]


_KEY = "doc long, row long"


def _bytes(batch: pa.RecordBatch, column: int) -> Iterator[np.ndarray]:
    """The UTF-8 bytes of each text, without a copy; null is empty."""
    values = batch.column(column)
    offsets = np.frombuffer(values.buffers()[1], np.int32)[values.offset:values.offset + len(values) + 1]
    data = np.frombuffer(values.buffers()[2] or b"", np.uint8)
    for a, b in zip(offsets.tolist(), offsets[1:].tolist()):
        yield data[a:b]


def _anchor_rows(rows: DataFrame, window: int, gram: int) -> DataFrame:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in (b.slice(i, 500) for b in batches for i in range(0, b.num_rows, 500)):
            found = [anchors(x, gram, window) for x in _bytes(batch, 2)]
            many = [len(a["h"]) for a in found]
            joined = {k: np.concatenate([a[k] for a in found]) for k in ("h", "g", "start", "n", "offset")}
            at = pa.array(np.repeat(np.arange(len(found)), many))
            place = joined["start"] << 16 | joined["n"] << 8 | joined["offset"]
            yield pa.RecordBatch.from_arrays([pa.array(joined["h"]), pa.array(joined["g"]), batch.column(0).take(at),
                                              batch.column(1).take(at), pa.array(place)], ["h", "g", "doc", "row", "place"])

    return rows.mapInArrow(run, f"h long, g long, {_KEY}, place long")


def _fetch(rows: DataFrame, wanted: DataFrame, window: int) -> DataFrame:
    """The surroundings of wanted anchors, cut from the texts."""
    lists = wanted.groupBy("doc", "row").agg(F.collect_list(F.struct("h", "g", "place", "open")).alias("wanted"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in (b.slice(i, 200) for b in batches for i in range(0, b.num_rows, 200)):
            lists = batch.column(3)
            items = lists.flatten()
            many = lists.value_lengths().to_numpy()
            place = items.field("place").to_numpy()
            start, n = place >> 16, place >> 8 & 255
            cut, k = [], 0
            for data, m in zip(_bytes(batch, 2), many.tolist()):
                for a, w in zip(start[k:k + m].tolist(), n[k:k + m].tolist()):
                    cut.append(data[a:a + w + window - 1].tobytes())
                k += m
            at = pa.array(np.repeat(np.arange(batch.num_rows), many))
            yield pa.RecordBatch.from_arrays(
                [items.field("h"), items.field("g"), items.field("open"), batch.column(0).take(at),
                 batch.column(1).take(at), pa.array(start), pa.array(cut, pa.binary())],
                ["h", "g", "open", "doc", "row", "start", "bytes"])

    return (rows.join(lists, ["doc", "row"]).select("doc", "row", "text", "wanted")
            .mapInArrow(run, f"h long, g long, open boolean, {_KEY}, start long, bytes binary"))


def _indexed(surroundings: DataFrame, window: int, limit: int) -> DataFrame:
    """Repeats among surroundings (sorted by anchor), as byte ranges of the open ones."""

    def settle(held: list[tuple]) -> list[tuple[int, int, int, int]]:
        if len(held) < 2:
            return []
        index = RunIndex([r[5] for r in held])
        long = index.matches() >= window
        return [(doc, row, start + a, start + b)
                for (_, is_open, doc, row, start, data), at in zip(held, index.starts.tolist()) if is_open
                for a, b in _spans(long[at:at + len(data)], window)]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[tuple] = []
        size = 0
        for batch in batches:
            out: list[tuple[int, int, int, int]] = []
            for r in zip(*(c.to_pylist() for c in batch.columns)):
                if size >= limit and r[0] != held[-1][0]:
                    out += settle(held)
                    held, size = [], 0
                held.append(r)
                size += len(r[5])
            if out:
                yield _range_batch(out)
        if held:
            yield _range_batch(settle(held))

    return surroundings.select("h", "open", "doc", "row", "start", "bytes").mapInArrow(run, f"{_KEY}, s long, e long")


def _range_batch(found: list[tuple[int, int, int, int]]) -> pa.RecordBatch:
    columns = list(zip(*found)) if found else [()] * 4
    return pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in columns], ["doc", "row", "s", "e"])


def _counted(surroundings: DataFrame, window: int) -> DataFrame:
    """The same for anchors with very many surroundings: windows are counted by their hashes."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in (b.slice(i, 200) for b in batches for i in range(0, b.num_rows, 200)):
            w1, w2, start, many = [], [], [], []
            for data, at in zip(batch.column(4).to_pylist(), batch.column(3).to_pylist()):
                hashes = Hashes(np.frombuffer(data, np.uint8))
                k = np.arange(len(data) - window + 1)
                w1.append(hashes.of(0, k, window).view(np.int64))
                w2.append(hashes.of(1, k, window).view(np.int64))
                start.append(at + k)
                many.append(len(k))
            at = pa.array(np.repeat(np.arange(batch.num_rows), many))
            yield pa.RecordBatch.from_arrays([pa.array(np.concatenate(w1)), pa.array(np.concatenate(w2)),
                                              *(batch.column(i).take(at) for i in range(3)),
                                              pa.array(np.concatenate(start))], ["w1", "w2", "open", "doc", "row", "s"])

    windows = saved(surroundings.select("open", "doc", "row", "start", "bytes")
                    .mapInArrow(run, f"w1 long, w2 long, open boolean, {_KEY}, s long"), "hot-windows")
    often = windows.groupBy("w1", "w2").agg(F.count(F.lit(1)).alias("n")).where("n > 1").select("w1", "w2")
    return windows.where("open").join(often, ["w1", "w2"]).select("doc", "row", "s", (F.col("s") + window).alias("e"))


def repeated(docs: DataFrame, id: str = "doc_id", text: str = "text", window: int = WINDOW, gram: int = GRAM,
             limit: int = INDEX_BYTES) -> DataFrame:
    """Byte ranges (``doc``, ``row``, ``s``, ``e``) that windows occurring elsewhere cover; they may overlap.

    ``doc`` is the id (the least long for a null one), ``row`` the hash of the text.
    """
    if not 0 < gram <= window or window - gram > 254:
        raise ValueError("gram must be at most window, and less than 255 below it")
    rows = _rows(docs, id, text)
    found = saved(_anchor_rows(rows.where(F.octet_length("text") >= window), window, gram), "anchors")
    stats = (found.groupBy("h").agg(F.count(F.lit(1)).alias("c"), F.min("g").alias("g1"), F.max("g").alias("g2"))
             .where("c > 1").select("h", (F.col("g1") < F.col("g2")).alias("mixed"), "c"))
    stats = saved(stats, "anchor-counts")
    total = found.count()
    met = saved(join_counted(found, stats, ["h"], "c", total), "repeated-anchors")
    classes = met.groupBy("h", "g").agg(F.count(F.lit(1)).alias("c"), F.first("mixed").alias("mixed"),
                                        F.min(F.struct("doc", "row", "place")).alias("one"))
    classes = saved(classes, "surroundings")
    start, n = F.shiftright("place", 16), F.shiftright("place", 8).bitwiseAND(255)
    whole = (join_counted(met, classes.where("c > 1").select("h", "g", "c"), ["h", "g"], "c", total)
             .select("doc", "row", start.alias("s"), (start + n + window - 1).alias("e")))
    mixed = classes.where("mixed").select("h", "g", "one.doc", "one.row", "one.place", (F.col("c") == 1).alias("open"))
    sizes = mixed.groupBy("h").agg(F.sum(F.shiftright("place", 8).bitwiseAND(255) + window).alias("size"))
    fetched = saved(_fetch(rows, mixed, window), "surrounding-bytes")
    hot = saved(sizes.where(F.col("size") > limit).select("h"), "hot-anchors")
    parts = int(docs.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    out = whole.unionByName(_indexed(fetched.join(hot, "h", "left_anti").repartition(parts, "h")
                                     .sortWithinPartitions("h", "doc", "row", "start"), window, limit))
    return out if hot.isEmpty() else out.unionByName(_counted(fetched.join(hot, "h", "left_semi"), window))


def _rows(docs: DataFrame, id: str, text: str) -> DataFrame:
    return docs.select(F.coalesce(F.col(id).cast("long"), F.lit(_NULL_ID)).alias("doc"),
                       F.xxhash64(F.col(text)).alias("row"), F.coalesce(F.col(text), F.lit("")).alias("text"))


def remove(docs: DataFrame, id: str = "doc_id", text: str = "text", window: int = WINDOW, gram: int = GRAM,
           limit: int = INDEX_BYTES) -> DataFrame:
    """One row per row of ``docs``: ``id``, ``n_bytes``, ``removed`` (merged byte ranges) and ``kept`` (binary).

    Every byte of a whole text that lies in ``window`` bytes which also start
    anywhere else goes, in the same document too. Null and empty texts, and
    texts shorter than ``window``, keep everything. Repeated rows are each
    other's repeats. Kept bytes may not be UTF-8. An empty table gives no rows.
    """
    ranges = saved(repeated(docs, id, text, window, gram, limit), "repeats").groupBy("doc", "row").agg(
        F.sort_array(F.collect_set(F.struct("s", "e"))).alias("ranges"))
    rows = _rows(docs, id, text)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        pair = pa.list_(pa.struct([("start", pa.int64()), ("end", pa.int64())]))
        for batch in (b.slice(i, 500) for b in batches for i in range(0, b.num_rows, 500)):
            docs_, size, removed, kept = batch.column(0).to_pylist(), [], [], []
            for data, ranges in zip(_bytes(batch, 1), batch.column(2).to_pylist()):
                merged: list[list[int]] = []
                for r in ranges or ():
                    if merged and r["s"] <= merged[-1][1]:
                        merged[-1][1] = max(merged[-1][1], r["e"])
                    else:
                        merged.append([r["s"], r["e"]])
                size.append(len(data))
                removed.append([{"start": a, "end": b} for a, b in merged])
                cut = [0, *(x for m in merged for x in m), len(data)]
                kept.append(b"".join(data[a:b].tobytes() for a, b in zip(cut[::2], cut[1::2])))
            yield pa.RecordBatch.from_arrays(
                [pa.array([None if d == _NULL_ID else d for d in docs_], pa.int64()), pa.array(size, pa.int64()),
                 pa.array(removed, pair), pa.array(kept, pa.binary())], [id, "n_bytes", "removed", "kept"])

    return (rows.join(ranges, ["doc", "row"], "left").select("doc", "text", "ranges")
            .mapInArrow(run, f"`{id}` long, n_bytes long, removed array<struct<start:long,end:long>>, kept binary"))
