"""Ranked lexical search over a term-document grid kept as a K2-treap of impact maxima.

The terms of a block of items are the rows of a grid, documents its columns. Each
task cuts its documents into stripes; the grid of a stripe is a quadtree whose
levels hold, for every cell with an occurrence, a mask of its four children, the
place of the first and the greatest impact inside. Empty cells take no space. An
item goes down along the rows of all its terms at once: for a range of documents
the weighted sum of its rows' maxima bounds every score in it, the ranges with
the greatest bounds are opened first, and what can't reach the item's
``k``-th best score is left. At single documents the sum is the score itself.
The best of each task are ranked together. Every document is indexed; what
travels is each document's counts of the items' terms, and ``k`` rows an item
from each task.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Row
from pyspark.sql import Window as W
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import to_arrow_type

from tapeweave.llm.common import saved
from tapeweave.llm.shingles import GROUP_BYTES, _BYTE, _powers, mix

PAIRS = 100_000  # (item, term) pairs of a block of items, which each task holds
STRIPE_DOCS = 4096
STRIPE_POINTS = 1 << 20
OPEN = 64  # document ranges opened in one step
_TERM = np.ones(256, bool)
_TERM[[*range(0x30), *range(0x3A, 0x41), *range(0x5B, 0x61), *range(0x7B, 0x80)]] = False
_BELOW = np.array([[bin(m & ((1 << q) - 1)).count("1") for q in range(4)] for m in range(16)], np.int32)


def terms(texts: list[str | None]) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """For groups of texts: 64-bit hashes of their terms in order, and where each text's begin (one more at the end).

    Terms are the longest runs of ASCII letters, digits and characters beyond
    ASCII, A-Z in lower case; null and empty texts have none.
    """
    run: list[bytes] = []
    size = 0
    for t in texts:
        run.append((t or "").encode("utf-8", "surrogatepass"))
        size += len(run[-1]) + 1
        if size >= GROUP_BYTES:
            yield _terms(run)
            run, size = [], 0
    if run:
        yield _terms(run)


def _terms(run: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
    data = np.frombuffer(b"\n".join([b"", *run, b""]), np.uint8)
    edges = np.cumsum([1, *(len(b) + 1 for b in run)])
    inside = _TERM[data]
    power, inverse = _powers(len(data))
    total = np.cumsum(np.where(inside, _BYTE[data], np.uint64(0)) * power)
    begin = np.flatnonzero(inside[1:] & ~inside[:-1]) + 1
    end = np.flatnonzero(~inside[1:] & inside[:-1]) + 1
    found = mix((total[end - 1] - total[begin - 1]) * inverse[begin] + (end - begin).astype(np.uint64))
    return found.view(np.int64), np.searchsorted(begin, edges)


def item_terms(items: DataFrame, id: str = "item_id", text: str = "text") -> DataFrame:
    """``item`` (number of the row), ``id`` and the distinct ``terms`` of each row of ``items`` that has any."""
    kind = items.schema[id].dataType

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            out = []
            for found, at in terms(batch.column(2).to_pylist()):
                out += [np.unique(found[a:b]).tolist() for a, b in zip(at, at[1:])]
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), pa.array(out, pa.list_(pa.int64()))],
                                             ["item", "id", "terms"])

    source = items.select(F.monotonically_increasing_id().alias("item"), F.col(id).alias("id"), F.col(text).alias("text"))
    found = source.mapInArrow(run, f"item long, id {kind.simpleString()}, terms array<long>")
    return saved(found.where("size(terms) > 0"), "item-terms")


def postings(docs: DataFrame, vocabulary: np.ndarray, id: str = "doc_id", text: str = "text") -> DataFrame:
    """Per document: ``doc``, ``n`` (terms with repeats), and of the terms in ``vocabulary`` (sorted) their ``rows`` and ``tfs``."""
    kind = docs.schema[id].dataType
    known = docs.sparkSession.sparkContext.broadcast(vocabulary)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        words = known.value
        for batch in batches:
            done = 0
            for found, at in terms(batch.column(1).to_pylist()):
                count = len(at) - 1
                rows = np.minimum(np.searchsorted(words, found), len(words) - 1)
                hit = np.flatnonzero(words[rows] == found)
                of = np.searchsorted(at, hit, side="right") - 1
                cells, tfs = np.unique(of * len(words) + rows[hit], return_counts=True)
                doc, row = np.divmod(cells, len(words))
                offsets = pa.array(np.searchsorted(doc, np.arange(count + 1)).astype(np.int32))
                yield pa.RecordBatch.from_arrays(
                    [batch.column(0).slice(done, count), pa.array(np.diff(at).astype(np.int64)),
                     pa.ListArray.from_arrays(offsets, pa.array(row.astype(np.int32))),
                     pa.ListArray.from_arrays(offsets, pa.array(tfs.astype(np.int64)))], ["doc", "n", "rows", "tfs"])
                done += count

    found = docs.select(F.col(id).alias("doc"), F.col(text).alias("text")).mapInArrow(
        run, f"doc {kind.simpleString()}, n long, rows array<int>, tfs array<long>")
    return saved(found, "postings")


class Treap:
    """Quadtree over points (row, column, impact > 0) with the greatest impact of every cell."""

    def __init__(self, row: np.ndarray, column: np.ndarray, impact: np.ndarray):
        self.height = max(1, int(max(row.max(initial=0), column.max(initial=0))).bit_length())
        code = np.zeros(len(row), np.int64)
        for b in range(self.height):
            code |= ((row >> b & 1) << (2 * b + 1)) | ((column >> b & 1) << (2 * b))
        order = np.argsort(code, kind="stable")
        code, top = code[order], impact[order]
        tops, masks, firsts = [top], [np.zeros(len(code), np.uint8)], [np.zeros(len(code), np.int64)]
        for _ in range(self.height):
            quadrant, above = code & 3, code >> 2
            begin = np.flatnonzero(np.r_[True, above[1:] != above[:-1]])
            tops.append(np.maximum.reduceat(tops[-1], begin))
            masks.append(np.bitwise_or.reduceat((1 << quadrant).astype(np.uint8), begin))
            firsts.append(begin)
            code = above[begin]
        # one numbering from the root, cell 0, to the points; the last cell stands for all empty ones
        starts = np.cumsum([0, *(len(t) for t in reversed(tops))])
        self.top = np.r_[np.concatenate(tops[::-1]), 0]
        self.mask = np.r_[np.concatenate(masks[::-1]), 0].astype(np.uint8)
        self.first = np.r_[np.concatenate([f + s for f, s in zip(reversed(firsts), starts[1:])]), 0]
        self.empty = int(starts[-1])

    def child(self, cells: np.ndarray, quadrant: np.ndarray) -> np.ndarray:
        mask = self.mask[cells]
        return np.where(mask >> quadrant & 1, self.first[cells] + _BELOW[mask, quadrant], self.empty)

    def search(self, rows: np.ndarray, weights: np.ndarray, least: int, k: int) -> tuple[np.ndarray, np.ndarray]:
        """Columns and scores of all whose weighted sum over ``rows`` is above 0 and, as far as known, among the ``k`` best;
        ``least`` is a score that must be reached."""
        known = rows < 1 << self.height  # other rows have no points
        rows, weights = rows[known], weights[known]
        bits = rows[None, :] >> np.arange(self.height)[:, None] & 1  # by how far above the points
        cells = np.zeros((1, len(rows)), np.int64)
        bound = (self.top[cells] * weights).sum(1)
        height, column = np.full(1, self.height), np.zeros(1, np.int64)
        columns, scores = np.zeros(0, np.int64), np.zeros(0, np.int64)
        least = max(least, 1)
        while True:
            alive = bound >= least
            if not alive.all():
                cells, bound, height, column = cells[alive], bound[alive], height[alive], column[alive]
            if not len(bound):
                return columns, scores
            if len(bound) > OPEN:
                best = np.argpartition(bound, -OPEN)[-OPEN:]
                rest = np.ones(len(bound), bool)
                rest[best] = False
                now = cells[best], height[best], column[best]
                cells, bound, height, column = cells[rest], bound[rest], height[rest], column[rest]
            else:
                now = cells, height, column
                cells, bound, height, column = cells[:0], bound[:0], height[:0], column[:0]
            lower = now[1] - 1
            half = 2 * bits[lower]
            opened = np.concatenate([self.child(now[0], half), self.child(now[0], half + 1)])
            sums = (self.top[opened] * weights).sum(1)
            lower, place = np.r_[lower, lower], np.r_[2 * now[2], 2 * now[2] + 1]
            hit = sums >= least
            final = hit & (lower == 0)
            if final.any():
                columns, scores = np.r_[columns, place[final]], np.r_[scores, sums[final]]
                if len(scores) >= k:
                    least = max(least, int(np.partition(scores, -k)[-k]))
            go = hit & (lower > 0) & (sums >= least)
            cells, bound = np.concatenate([cells, opened[go]]), np.r_[bound, sums[go]]
            height, column = np.r_[height, lower[go]], np.r_[column, place[go]]


def _weight(documents: int, df: np.ndarray) -> np.ndarray:
    return np.floor(1000 * np.log((2 * documents + 2) / (2 * df + 1))).astype(np.int64)


def _search(found: DataFrame, items: list[Row], words: int, k: int, stripe_docs: int, stripe_points: int) -> DataFrame:
    """Best ``k`` documents of each task for each item of a block: ``item``, ``doc``, ``score``."""
    spark, kind = found.sparkSession, found.schema["doc"].dataType
    sums = found.agg(F.count_if(F.col("n") > 0).alias("n"), F.coalesce(F.sum("n"), F.lit(0)).alias("l")).first()
    counted = found.select(F.explode("rows").alias("row")).groupBy("row").agg(F.count(F.lit(1)).alias("df")).toPandas()
    df = np.zeros(words, np.int64)
    df[counted["row"].to_numpy(np.int64)] = counted["df"].to_numpy(np.int64)
    # frequent terms next to each other, so that full cells are shared
    place = np.empty(words, np.int64)
    place[np.argsort(-df, kind="stable")] = np.arange(words)
    plan = spark.sparkContext.broadcast((place, _weight(sums["n"], df), [(r["item"], np.array(r["rows"])) for r in items]))
    documents, length = sums["n"], max(1, sums["l"])

    def stripe(docs: list, n: np.ndarray, size: np.ndarray, rows: np.ndarray, tfs: np.ndarray,
               best: dict[int, list]) -> None:
        place, weight, wanted = plan.value
        order = np.argsort(n, kind="stable")  # alike lengths together: closer bounds
        at = np.empty(len(n), np.int64)
        at[order] = np.arange(len(n))
        m = 100 - 90 + 90 * n * documents // length
        impact = 1_000_000_000 * tfs // (1000 * tfs + 8 * np.repeat(m, size))
        some = impact > 0
        if not some.any():
            return
        tree = Treap(place[rows[some]], np.repeat(at, size)[some], impact[some])
        for item, mine in wanted:
            kept = best.setdefault(item, [])
            column, score = tree.search(place[mine], weight[mine], kept[-1][0] if len(kept) == k else 1, k)
            if len(column):
                kept += [(int(s), docs[order[c]]) for c, s in zip(column, score)]
                kept.sort(key=lambda x: (-x[0], x[1] is None, x[1]))
                del kept[k:]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        best: dict[int, list] = {}
        docs, n, size, rows, tfs, points = [], [], [], [], [], 0

        def close() -> None:
            stripe(docs, np.concatenate(n), np.concatenate(size), np.concatenate(rows), np.concatenate(tfs), best)
            for x in (docs, n, size, rows, tfs):
                x.clear()

        for batch in (b.slice(i, 512) for b in batches for i in range(0, b.num_rows, 512)):
            offsets = batch.column(2).offsets.to_numpy().astype(np.int64)
            a, b = offsets[0], offsets[-1]
            docs += batch.column(0).to_pylist()
            n.append(batch.column(1).to_numpy())
            size.append(np.diff(offsets))
            rows.append(batch.column(2).values.to_numpy()[a:b])
            tfs.append(batch.column(3).values.to_numpy()[a:b])
            points += b - a
            if len(docs) >= stripe_docs or points >= stripe_points:
                close()
                points = 0
        if docs:
            close()
        out = [(item, d, s) for item, kept in best.items() for s, d in kept]
        if out:
            yield pa.RecordBatch.from_arrays([pa.array([x[0] for x in out], pa.int64()), pa.array([x[1] for x in out], doc_type),
                                              pa.array([x[2] for x in out], pa.int64())], ["item", "doc", "score"])

    doc_type = to_arrow_type(kind)
    return found.mapInArrow(run, f"item long, doc {kind.simpleString()}, score long")


def search(docs: DataFrame, items: DataFrame, k: int = 10, id: str = "doc_id", text: str = "text", item_id: str = "item_id",
           item_text: str = "text", pairs: int = PAIRS, stripe_docs: int = STRIPE_DOCS, stripe_points: int = STRIPE_POINTS) -> DataFrame:
    """For every row of ``items`` its ``k`` best documents with a score above 0: ``item`` (number of the
    row), ``item_id``, ``rank`` from 1, ``doc_id`` and ``score``.

    N documents have a term, L is the number of their terms, n that of one
    document, df the documents with a term, tf its occurrences in one. A term
    weighs floor(1000 ln((2 N + 2) / (2 df + 1))), and a document scores the sum
    of weight * (10^9 tf div (1000 tf + 8 m)), m = 10 + 90 n N div L, over the
    item's distinct terms. Equal scores come by ascending id, null ids last; rows
    that repeat an id are documents of their own, and so are repeated items.
    Texts without a term (null, empty) are never found and, as items, have no
    rows; empty tables give no rows. Other columns play no part.

    Items are searched in blocks of about ``pairs`` (item, term) pairs, which the
    driver and each task hold; an item's own terms always stay together.
    """
    spark = docs.sparkSession
    asked = item_terms(items, item_id, item_text)
    size = asked.agg(F.coalesce(F.sum(F.size("terms")), F.lit(0))).first()[0]
    blocks = max(1, -(-size // pairs))
    ranked: DataFrame | None = None
    for b in range(blocks):
        block = asked.where(F.pmod(F.xxhash64("item"), F.lit(blocks)) == b).collect()
        vocabulary = np.unique(np.concatenate([np.zeros(0, np.int64), *(np.array(r["terms"], np.int64) for r in block)]))
        if not len(vocabulary):
            continue
        found = postings(docs, vocabulary, id, text)
        rows = [Row(item=r["item"], rows=np.searchsorted(vocabulary, r["terms"])) for r in block]
        best = saved(_search(found, rows, len(vocabulary), k, stripe_docs, stripe_points), "best-documents")
        ranked = best if ranked is None else ranked.unionByName(best)
    if ranked is None:
        ranked = spark.createDataFrame([], f"item long, doc {docs.schema[id].dataType.simpleString()}, score long")
    rank = F.row_number().over(W.partitionBy("item").orderBy(F.desc("score"), F.asc_nulls_last("doc")))
    return (ranked.withColumn("rank", rank).where(F.col("rank") <= k)
            .join(asked.select("item", F.col("id").alias("item_id")), "item")
            .select("item", "item_id", "rank", F.col("doc").alias("doc_id"), "score"))
