"""Benchmark decontamination by the q-gram lemma, with verified edit distances.

A passage of L characters that occurs in a text with at most k edits shares at
least L - q + 1 - q k of its q-grams with it, all on diagonals at most k apart.
So the shared q-grams are counted in bands of 2 k diagonals, each overlapping
its neighbours by half; bands that meet the bound are verified by an alignment
inside the band. The benchmark goes to the executors in blocks of bounded size
and every document meets every block in its scan: nothing is shuffled.
"""

from __future__ import annotations

import pickle

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tapeweave.llm.common import with_column

Q = 8
RATE = 0.1  # edits allowed for each character of a passage
BLOCK_CHARS = 2_000_000  # characters of the benchmark that are broadcast as one
HELD = 4  # blocks whose index a worker holds; each text is read once for so many
SPAN = "array<struct<item_id:bigint,start:int,end:int,edits:int>>"
_BASE = np.uint64(0x9E3779B97F4A7C15)
_FILTER_BITS = 22
TABLES = 64  # alignments that go together
_NOWHERE = 0xFFFFFFFF  # matches no character
GROUP_CHARS = 1 << 20  # characters of texts that are looked at in one step
_SPACE = np.zeros(0x202B, bool)
_SPACE[[32, 9, 10, 11, 12, 13, 0xA0, 0x2028, 0x2029]] = True


def fold(text: str) -> tuple[np.ndarray, np.ndarray]:
    """Code points in lower case with white-space runs as one space, and their places in ``text``."""
    low = text.lower()
    if len(low) != len(text):  # a few letters grow
        low = "".join(c.lower() if len(c.lower()) == 1 else c for c in text)
    code = np.frombuffer(low.encode("utf-32-le", "surrogatepass"), np.uint32).copy()
    space = _SPACE[np.minimum(code, len(_SPACE) - 1)]
    code[space] = 32
    keep = np.ones(len(code), bool)
    keep[1:] = ~(space[1:] & space[:-1])
    at = np.flatnonzero(keep)
    return code[at], at


def grams(code: np.ndarray, q: int) -> np.ndarray:
    if len(code) < q:
        return np.zeros(0, np.uint64)
    # hashes of 1, 2, 4, ... characters; q is put together from them
    part, size, power = code.astype(np.uint64), 1, np.full(1, _BASE)
    h, done = np.zeros(len(code) - q + 1, np.uint64), 0
    while True:
        if q & size:
            h = h * power + part[done:done + len(h)]
            done += size
        if done == q:
            return h ^ (h >> np.uint64(29))
        part = part[:-size] * power + part[size:]
        size, power = 2 * size, power * power


def budget(length: int, q: int = Q, rate: float = RATE) -> int:
    """Edits allowed in a passage: ``rate`` of its length, but few enough that the lemma asks for a shared q-gram."""
    return max(0, min(int(rate * length), (length - q) // q))


def align(items: list[np.ndarray], regions: list[np.ndarray], budgets: list[int]) -> list[tuple[int, int, int] | None]:
    """Best place of each item in its region: (edits, start, end) with at most its budget of edits, else None.

    Row i of a table is kept on the columns i to i + width, where ``width``
    is what the region is longer than the item, so the cost is a band and not
    the whole table. Ends of a region are free. All tables go row by row
    together, the longest items first, so that those which are done are the last.
    """
    out: list[tuple[int, int, int] | None] = [None] * len(items)
    fit = [i for i in range(len(items)) if len(regions[i]) >= len(items[i])]
    fit.sort(key=lambda i: -len(items[i]))
    for at in range(0, len(fit), TABLES):
        _align(fit[at:at + TABLES], items, regions, budgets, out)
    return out


def _align(which: list[int], items: list[np.ndarray], regions: list[np.ndarray], budgets: list[int], out: list) -> None:
    size = np.array([len(items[i]) for i in which])
    width = np.array([len(regions[i]) for i in which]) - size
    columns = int(width.max()) + 1
    item = np.zeros((len(which), int(size[0])), np.uint32)
    region = np.full((len(which), int(size[0]) + columns), _NOWHERE, np.uint32)
    for row, i in enumerate(which):
        item[row, :size[row]] = items[i]
        region[row, :len(regions[i])] = regions[i]
    big = 1 << 20
    span = np.arange(columns)
    outside = span > width[:, None]
    # cost above, start below
    packed = np.where(outside, big << 32, 0) + span
    up = np.full(packed.shape, big << 32)
    for i in range(int(size[0])):
        a = int(np.searchsorted(-size, -i, side="left"))  # tables that have a row i
        now = packed[:a]
        # same diagonal: match or change; next diagonal: a character of the item is missing
        diag = now + ((region[:a, i:i + columns] != item[:a, i, None]).astype(np.int64) << 32)
        up[:a, :-1] = now[:, 1:] + (1 << 32)
        best = np.where(up[:a] >> 32 < diag >> 32, up[:a], diag)
        # characters added in the region: running minimum along the row
        best = np.minimum.accumulate(best - (span << 32), axis=1) + (span << 32)
        best[outside[:a]] = big << 32
        packed[:a] = best
    cost = packed >> 32
    e = cost.argmin(1)
    for row, i in enumerate(which):
        c = int(cost[row, e[row]])
        if c <= budgets[i]:
            out[i] = (c, int(packed[row, e[row]] & 0xFFFFFFFF), int(size[row] + e[row]))


class Passages:
    """A block of benchmark passages with the index of their q-grams."""

    def __init__(self, items: list[tuple[int, str]], q: int = Q, rate: float = RATE):
        self.q = q
        folded = [(i, fold(t)[0]) for i, t in items]
        self.items = [(i, c) for i, c in folded if len(c)]
        self.size = np.array([len(c) for _, c in self.items], np.int64)
        self.k = np.array([budget(int(n), q, rate) for n in self.size], np.int64)
        self.need = self.size - q + 1 - q * self.k
        self.step = np.maximum(self.k, 1)
        self.short = [n for n, (_, c) in enumerate(self.items) if len(c) < q]
        found = [grams(c, q) for _, c in self.items]
        code = np.concatenate([*found, np.zeros(0, np.uint64)])
        order = np.argsort(code, kind="stable")
        self.item = np.repeat(np.arange(len(found)), [len(g) for g in found])[order]
        self.place = np.concatenate([*(np.arange(len(g)) for g in found), np.zeros(0, np.int64)])[order]
        self.codes, first = np.unique(code[order], return_index=True)
        self.first = np.append(first, len(code))
        self.maybe = np.zeros(1 << _FILTER_BITS, bool)
        self.maybe[self.codes >> np.uint64(64 - _FILTER_BITS)] = True

    def find(self, texts: list[str | None]) -> list[list[tuple[int, int, int, int]]]:
        """For each text, (item, start, end, edits) of each passage, places in code points of the text."""
        out: list[list[tuple[int, int, int, int]]] = []
        run: list[str] = []
        chars = 0
        for t in texts:
            run.append(t or "")
            chars += len(run[-1])
            if chars >= GROUP_CHARS:
                out += self._find(run)
                run, chars = [], 0
        return out + self._find(run)

    def _find(self, texts: list[str]) -> list[list[tuple[int, int, int, int]]]:
        """The texts lie in one array, a separator behind each; regions never cross one."""
        out: list[list[tuple[int, int, int, int]]] = [[] for _ in texts]
        if not self.items or not any(texts):
            return out
        code, at = fold("\0".join([*texts, ""]))
        begin = np.cumsum([0, *(len(t) + 1 for t in texts)])
        edge = np.searchsorted(at, begin)  # of each text among the folded characters
        spans = [x for n in self.short for d in range(len(texts))
                 for x in self._exact(n, code[edge[d]:edge[d + 1] - 1], d, int(edge[d]))]
        h = grams(code, self.q)
        where = np.flatnonzero(self.maybe[h >> np.uint64(64 - _FILTER_BITS)]) if len(self.codes) else h[:0]
        if len(where):
            slot = np.minimum(np.searchsorted(self.codes, h[where]), len(self.codes) - 1)
            ok = self.codes[slot] == h[where]
            where, slot = where[ok].astype(np.int64), slot[ok]
        if len(where):
            n = self.first[slot + 1] - self.first[slot]
            entry = np.repeat(self.first[slot] - (np.cumsum(n) - n), n) + np.arange(n.sum())
            item = self.item[entry]
            # diagonals count from -size, so that bands start at 0
            diagonal = np.repeat(where, n) - self.place[entry] + self.size[item]
            band = item * (1 << 40) + diagonal // self.step[item]
            half, count = np.unique(band, return_counts=True)
            after = np.zeros(len(half), np.int64)
            joined = np.flatnonzero(half[1:] == half[:-1] + 1)
            after[joined] = count[joined + 1]
            before = np.zeros(len(half), np.int64)
            before[joined + 1] = count[joined]
            met = np.maximum(after, before) + count >= self.need[half >> 40]
            spans += self._verify(half[met], code, edge)
        for d, n, s, e, edits in spans:
            low = int(begin[d])
            out[d].append((self.items[n][0], int(at[s]) - low, int(at[e - 1]) + 1 - low, edits))
        return out

    def _exact(self, n: int, code: np.ndarray, d: int, low: int) -> list[tuple[int, int, int, int, int]]:
        c = self.items[n][1]
        if len(code) < len(c):
            return []
        same = np.ones(len(code) - len(c) + 1, bool)
        for i, x in enumerate(c):
            same &= code[i:len(code) - len(c) + 1 + i] == x
        return [(d, n, low + int(s), low + int(s) + len(c), 0) for s in np.flatnonzero(same)]

    def _verify(self, bands: np.ndarray, code: np.ndarray, edge: np.ndarray) -> list[tuple[int, int, int, int, int]]:
        # Places of one passage lie 9 k apart or more, so a run of few bands holds one of them at most.
        runs: list[list[int]] = []
        for band in bands.tolist():
            if runs and band == runs[-1][1] + 1 and band - runs[-1][0] < 6:
                runs[-1][1] = band
            else:
                runs.append([band, band])
        places, items, regions, budgets = [], [], [], []
        for band, until in runs:
            n, b, c = band >> 40, band & ((1 << 40) - 1), until & ((1 << 40) - 1)
            k, step, size = int(self.k[n]), int(self.step[n]), int(self.size[n])
            # half bands b - 1 to c + 1, and k more on either side for edits before the first shared gram
            low, high = (b - 1) * step - size - k, (c + 2) * step + k + 1
            first = int(np.searchsorted(edge, max(low, 0), side="right")) - 1
            last = int(np.searchsorted(edge, min(high, len(code) - 1), side="right")) - 1
            for d in range(first, min(last, len(edge) - 2) + 1):
                lo, hi = max(low, int(edge[d])), min(high, int(edge[d + 1]) - 1)
                if hi - lo < size - k:
                    continue
                # room for edits at the ends of a text; it matches nothing
                room = np.full(k, _NOWHERE, np.uint32)
                places.append((d, n, lo, hi))
                items.append(self.items[n][1])
                regions.append(np.concatenate([room, code[lo:hi], room]))
                budgets.append(k)
        best: dict[tuple[int, int], list[tuple[int, int, int, int, int]]] = {}
        for (d, n, lo, hi), k, found in zip(places, budgets, align(items, regions, budgets)):
            if not found:
                continue
            edits, s, e = found
            s, e = max(lo, s - k + lo), min(e - k + lo, hi)
            seen = best.setdefault((d, n), [])
            if seen and s < seen[-1][3]:
                if edits < seen[-1][4]:
                    seen[-1] = (d, n, s, e, edits)
            elif e > s:
                seen.append((d, n, s, e, edits))
        return [x for found in best.values() for x in found]


_workers: dict[int, Passages] = {}


def mark(docs: DataFrame, benchmark: DataFrame, text: str = "text", out: str = "spans", item_id: str = "item_id",
         item_text: str = "text", q: int = Q, rate: float = RATE) -> DataFrame:
    """``docs`` with the benchmark passages of each whole text in ``out``, behind its columns.

    A span is (item_id, start, end, edits): places in code points, end
    exclusive, letters and white space folded, at most ``budget`` edits. Null
    and empty texts, and an empty benchmark, give no spans; null and empty
    passages are nowhere; equal passages are found under each of their ids;
    passages shorter than ``q`` must occur exactly. Every row stays.
    """
    spark = docs.sparkSession
    items = (benchmark.select(F.col(item_id).cast("long").alias("i"), F.col(item_text).alias("t"))
             .where("i is not null and length(t) > 0").distinct())
    chars = items.agg(F.coalesce(F.sum(F.length("t")), F.lit(0))).first()[0]
    if not chars:
        return docs.select(*[c for c in docs.columns if c != out], F.array().cast(SPAN).alias(out))
    blocks = -(-chars // BLOCK_CHARS)
    made, names = docs, []
    for first in range(0, blocks, HELD):
        sent = []
        for b in range(first, min(first + HELD, blocks)):
            part = items.where(F.pmod(F.xxhash64("i", "t"), F.lit(blocks)) == b)
            rows = sorted((r["i"], r["t"]) for r in part.collect())  # one block: about BLOCK_CHARS characters
            sent.append(spark.sparkContext.broadcast(pickle.dumps((rows, q, rate))))
        name = out
        while name in made.columns and name in [*docs.columns, *names]:
            name += "_"
        names.append(name)
        made = with_column(made, text, name, _span_type(), _finder(sent))
    return made.select(*[c for c in docs.columns if c != out], F.concat(*names).alias(out))


def _span_type() -> T.ArrayType:
    return T.ArrayType(T.StructType([T.StructField("item_id", T.LongType()), T.StructField("start", T.IntegerType()),
                                     T.StructField("end", T.IntegerType()), T.StructField("edits", T.IntegerType())]))


def _finder(sent: list):
    keys = [b._jbroadcast.id() for b in sent]
    kind = pa.list_(pa.struct([("item_id", pa.int64()), ("start", pa.int32()), ("end", pa.int32()),
                               ("edits", pa.int32())]))

    def run(texts: pa.StringArray) -> pa.Array:
        names = ("item_id", "start", "end", "edits")
        lists = texts.to_pylist()
        found: list[list[dict]] = [[] for _ in lists]
        for key, block in zip(keys, sent):  # each text comes here once for all of them
            if key not in _workers:
                if len(_workers) >= HELD:
                    _workers.clear()
                _workers[key] = Passages(*pickle.loads(block.value))
            for mine, spans in zip(found, _workers[key].find(lists)):
                mine += [dict(zip(names, s)) for s in spans]
        return pa.array(found, kind)

    return run
