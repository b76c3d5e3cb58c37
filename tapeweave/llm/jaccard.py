"""N-gram Jaccard join: exact links of similar texts, found through prefix trees.

Sets of word shingles are put in one global order (of their hashes). Two sets
of the wanted similarity share at least ``1 + s`` shingles among the first
``p + s`` of each, p being the prefix that must hold one (s that of the smaller set). So

1. equal sets become one class with a representative;
2. representatives whose extended prefix holds fewer than 1 + s shingles that
   another one has are finished: they have no partner. Only the others' whole
   sets are written;
3. the rest is listed by shingle. A set with at most s very frequent shingles
   in its extended prefix can do without those, so frequent passages make no
   lists; sets that consist of frequent shingles are listed under the rarest of
   all their shingles among themselves;
4. in each list every set is first compared with the list's smallest document,
   which joins large groups of near copies by as many pairs as they have sets;
5. lists whose sets aren't yet in one component go through a trie of the ordered
   extended prefixes: one walk for all sets of the list shares the overlaps with
   common beginnings and leaves a subtree when what remains of both sets can't
   reach the similarity. Very long lists are dealt out as pairs of blocks;
6. a pair whose parity bits differ in more places than its sets may is left out,
   and what is still possible is verified on the whole sets.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tapeweave.llm.common import components, give_back, pieces, saved
from tapeweave.llm.shingles import mix, shingle_sets, signature

BITS = 1024  # of a set that tell how much two sets differ at least
SMALL = 2_000_000  # frequent shingles that are broadcast at most
FREQUENT = 64  # a shingle with more representatives makes no list of its own, see 3.
BLOCK = 192  # sets of a list that meet in one task, from each side


def prefix(n, num: int, den: int):
    """Length of the prefix that must share a shingle, for numbers and columns."""
    return n - (num * n + den - 1) // den + 1


def slack(n, num: int, den: int):
    return prefix(n, num, den) // 2


def _sets(docs: DataFrame, words: int, num: int, den: int, whole: bool) -> DataFrame:
    """``doc``, size ``n``, signature ``s1``, ``s2`` and ordered ``shingles``: those of the extended prefix, or all.

    With all come ``begin``, the extended prefix in 32 bits each (in the same order;
    two that are cut to one number only make an overlap look larger), and ``bits``.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in pieces(batches):
            n, s1, s2, out, begin, bits = [], [], [], [], [], []
            for v in shingle_sets(batch.column(1).to_pylist(), words):
                n.append(len(v))
                a, b = signature(v)
                s1.append(a)
                s2.append(b)
                extended = v[:prefix(len(v), num, den) + slack(len(v), num, den)]
                out.append(v if whole else extended)
                if whole:
                    begin.append((extended >> 32).astype(np.int32))
                    bits.append(parity(v))
            columns = [batch.column(0), pa.array(n, pa.int64()), pa.array(s1, pa.int64()), pa.array(s2, pa.int64()), _lists(out, np.int64)]
            if whole:
                columns += [_lists(begin, np.int32), _lists(bits, np.int64)]
            yield pa.RecordBatch.from_arrays(columns, ["doc", "n", "s1", "s2", "shingles", "begin", "bits"][:len(columns)])

    more = ", begin array<int>, bits array<long>" if whole else ""
    return docs.mapInArrow(run, f"doc long, n long, s1 long, s2 long, shingles array<long>{more}")


def _lists(rows: list[np.ndarray], kind: type) -> pa.ListArray:
    offsets = pa.array(np.cumsum([0, *map(len, rows)]).astype(np.int32))
    return pa.ListArray.from_arrays(offsets, pa.array(np.concatenate([*rows, np.zeros(0, kind)])))


def parity(values: np.ndarray) -> np.ndarray:
    """``BITS`` bits of a set: whether an even or odd number of its elements falls on each.

    Sets that differ in d elements differ in at most d bits.
    """
    at = (mix(values.view(np.uint64), 0x7B1) >> np.uint64(64 - BITS.bit_length() + 1)).astype(np.int64)
    return np.packbits(np.bincount(at, minlength=BITS).astype(np.uint8) & 1).view(np.int64)


def _required(a, b, num: int, den: int):
    """Smallest intersection of sets of these sizes with the wanted similarity."""
    return (num * (a + b) + num + den - 1) // (num + den)


def _int(expression: str) -> Column:
    return F.expr(expression)


def _verify(pairs: DataFrame, sets: DataFrame, num: int, den: int) -> DataFrame:
    """The pairs (x, y) whose whole sets are similar enough."""
    left = sets.select(F.col("doc").alias("x"), F.col("shingles").alias("sx"))
    right = sets.select(F.col("doc").alias("y"), F.col("shingles").alias("sy"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in pieces(batches):
            keep = []
            a, b = batch.column(2), batch.column(3)
            ao, bo = a.offsets.to_numpy(), b.offsets.to_numpy()
            av, bv = a.values.to_numpy(), b.values.to_numpy()
            for i in range(batch.num_rows):
                x, y = av[ao[i]:ao[i + 1]], bv[bo[i]:bo[i + 1]]
                both = len(np.intersect1d(x, y, assume_unique=True))
                keep.append(den * both >= num * (len(x) + len(y) - both))
            yield batch.select([0, 1]).filter(pa.array(keep, pa.bool_()))

    return (pairs.join(left, "x").join(right, "y").select("x", "y", "sx", "sy")
            .mapInArrow(run, "x long, y long"))


class Trie:
    """Beginnings of ordered sets by what they share, walked once for all sets that ask.

    An edge holds all that the sets below it have in common, so a node is a run of
    the sorted sets. For every asking set the walk keeps the overlap with the path
    so far, which all sets below share. Sets may be given whole or by their first
    elements; a pair is found unless what is known of both rules it out.
    """

    def __init__(self, sets: list[np.ndarray], sizes: np.ndarray, num: int, den: int):
        self.num, self.den = num, den
        order = sorted(range(len(sets)), key=lambda i: sets[i].tolist())
        self.order, self.sizes = np.array(order, np.int64), sizes[order]
        sets = [sets[i] for i in order]
        known = np.array([len(v) for v in sets], np.int64)
        everything = np.concatenate(sets)
        values, rank = np.unique(everything, return_inverse=True)
        self.width, owner = len(values) + 1, np.repeat(np.arange(len(sets)), known)
        at = np.r_[0, np.cumsum(known)]
        self.sets = [rank[a:b] for a, b in zip(at, at[1:])]
        self.last = np.array([v[-1] if len(v) else -1 for v in self.sets], np.int64)
        # which sets hold a value, and where a value comes in each set
        by_value = np.argsort(rank, kind="stable")
        self.holders, self.first = owner[by_value], np.searchsorted(rank[by_value], np.arange(self.width))
        self.places, self.starts = owner * self.width + rank, at[:-1]
        self.shared = [self._shared(x, y) for x, y in zip(self.sets, self.sets[1:])]

    @staticmethod
    def _shared(x: np.ndarray, y: np.ndarray) -> int:
        n = min(len(x), len(y))
        differ = x[:n] != y[:n]
        at = int(differ.argmax()) if n else 0
        return at if n and differ[at] else n

    def similar(self, asking: np.ndarray | None = None, among: np.ndarray | None = None) -> Iterator[tuple[int, np.ndarray]]:
        """A set and those that may be similar to it, each pair once; as places in what the tree was made of.

        With ``asking`` and ``among`` (flags) only pairs of a set among the one and a set asking.
        """
        n = len(self.sets)
        ask = np.ones(n, bool) if asking is None else asking[self.order]
        told = np.ones(n, bool) if among is None else among[self.order]
        everyone = np.flatnonzero(ask)
        # run of sets, depth of its node, who still asks, their overlaps
        todo = [(0, n, 0, everyone, np.zeros(len(everyone), np.int64))]
        while todo:
            low, high, depth, who, both = todo.pop()
            if asking is None:  # each pair at its earlier set
                later = who > low
                who, both = who[later], both[later]
            if not len(who) or not told[low:high].any():
                continue
            end = len(self.sets[low]) if high - low == 1 else min(self.shared[low:high - 1])
            edge = self.sets[low][depth:end]
            if len(edge):
                both = both + self._hits(edge)[who]
                who, both = self._possible(low, high, end, who, both)
                if not len(who):
                    continue
            if high - low == 1:
                if told[low]:
                    who, both = self._possible(low, high, end, who, both)
                    who = who[who != low]
                    if len(who):
                        yield int(self.order[low]), self.order[who]
                continue
            begin = low
            for i in range(low, high):
                if i == high - 1 or self.shared[i] == end:
                    todo.append((begin, i + 1, end, who, both))
                    begin = i + 1

    def _hits(self, edge: np.ndarray) -> np.ndarray:
        """How many of the values each set holds."""
        a, b = self.first[edge], self.first[edge + 1]
        size = b - a
        at = np.repeat(a - np.r_[0, np.cumsum(size)[:-1]], size) + np.arange(size.sum())
        return np.bincount(self.holders[at], minlength=len(self.sets))

    def _possible(self, low: int, high: int, depth: int, who: np.ndarray, both: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Those for whom what remains of both sides can still reach the similarity with a set of the run."""
        sizes, run = self.sizes[who], self.sizes[low:high]
        path = self.sets[low][:depth]
        passed = np.searchsorted(self.places, who * self.width + (path[-1] if depth else -1), side="right") - self.starts[who]
        seen = np.searchsorted(path, self.last[who], side="right")  # of the path, before a set's known part ends
        least = np.maximum(int(run.min()), (self.num * sizes + self.den - 1) // self.den)
        enough = both + np.minimum(sizes - passed, int(run.max()) - seen) >= _required(sizes, least, self.num, self.den)
        return who[enough], both[enough]


def _walk(rows: DataFrame, num: int, den: int) -> DataFrame:
    """Pairs of each list (rows sorted by ``key``) that may be similar; side 0 meets side 1 in a pair of blocks."""

    def links(docs: np.ndarray, component: np.ndarray, side: np.ndarray, size: np.ndarray, sets: list[np.ndarray],
              bits: np.ndarray) -> tuple[list, list]:
        sides = (side == 1).any() and (side == 0).any()
        trie = Trie(sets, size, num, den)
        x, y = [], []
        for one, others in trie.similar(side == 1, side == 0) if sides else trie.similar():
            others = others[component[others] != component[one]]
            differ = np.bitwise_count(bits[others] ^ bits[one]).sum(1, dtype=np.int64)
            others = others[differ <= size[others] + size[one] - 2 * _required(size[others], size[one], num, den)]
            x += [docs[others]]
            y += [np.full(len(others), docs[one])]
        return x, y

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        rest: pa.RecordBatch | None = None
        for batch in batches:
            if rest is not None:
                batch = pa.Table.from_batches([rest, batch]).combine_chunks().to_batches()[0]
            key = batch.column(0).to_numpy()
            other = np.flatnonzero(key != key[-1]) if len(key) else key
            cut = int(other[-1]) + 1 if len(other) else 0  # rows of the last key may go on in the next batch
            rest = batch.slice(cut)
            if cut:
                yield from lists(batch.slice(0, cut))
        if rest is not None and rest.num_rows:
            yield from lists(rest)
        give_back()

    def lists(batch: pa.RecordBatch) -> Iterator[pa.RecordBatch]:
        key, docs, component, side, size = (batch.column(i).to_numpy() for i in range(5))
        off, val = batch.column(5).offsets.to_numpy(), batch.column(5).values.to_numpy()
        places = batch.column(6).offsets.to_numpy()
        bits = batch.column(6).values.to_numpy()[places[0]:places[-1]].view(np.uint64).reshape(batch.num_rows, -1)
        begin = np.flatnonzero(np.r_[True, key[1:] != key[:-1]])
        x, y = [], []
        for a, b in zip(begin.tolist(), [*begin[1:].tolist(), len(key)]):
            sets = [val[off[i]:off[i + 1]] for i in range(a, b)]
            for out, more in zip((x, y), links(docs[a:b], component[a:b], side[a:b], size[a:b], sets, bits[a:b])):
                out += more
        if sum(map(len, x)):
            yield pa.RecordBatch.from_arrays([pa.array(np.concatenate(x), pa.int64()), pa.array(np.concatenate(y), pa.int64())], ["x", "y"])

    return rows.mapInArrow(run, "x long, y long")


def _rarest(sets: DataFrame, often: DataFrame, num: int, den: int) -> DataFrame:
    """``doc`` and each ``shingle`` of its prefix when the rarest come first, then by hash; those not in ``often`` are rarest."""
    if often.limit(SMALL + 1).count() > SMALL:
        p = f"(n - ({num} * n + {den} - 1) div {den} + 1)"
        return (sets.select("doc", "n", "s1", "s2", F.explode("shingles").alias("shingle")).join(often, "shingle", "left")
                .groupBy("doc", "n", "s1", "s2")
                .agg(F.sort_array(F.collect_list(F.struct(F.coalesce("f", F.lit(0)).alias("f"), "shingle"))).alias("all"))
                .select("doc", F.explode(_int(f"slice(all, 1, cast({p} as int))")).alias("t")).select("doc", "t.shingle"))
    known = often.orderBy("shingle").toPandas()
    sent = sets.sparkSession.sparkContext.broadcast((known["shingle"].to_numpy(np.int64), known["f"].to_numpy(np.int64)))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        keys, counts = sent.value
        for batch in batches:
            off, val = batch.column(1).offsets.to_numpy(), batch.column(1).values.to_numpy()
            f = np.zeros(len(val), np.int64)
            if len(keys):
                at = np.minimum(np.searchsorted(keys, val), len(keys) - 1)
                f = np.where(keys[at] == val, counts[at], 0)
            docs, out = batch.column(0).to_numpy(), []
            for a, b in zip(off[:-1], off[1:]):
                first = np.argsort(f[a:b], kind="stable")[:prefix(int(b - a), num, den)]  # equal counts stay in the order of hashes
                out.append(val[a:b][first])
            yield pa.RecordBatch.from_arrays([pa.array(np.repeat(docs, [len(x) for x in out])),
                                              pa.array(np.concatenate([*out, np.zeros(0, np.int64)]))], ["doc", "shingle"])

    return sets.select("doc", "shingles").mapInArrow(run, "doc long, shingle long")


def cluster(docs: DataFrame, id: str = "doc_id", text: str = "text", words: int = 5, num: int = 80,
            den: int = 100, frequent: int = FREQUENT, block: int = BLOCK) -> DataFrame:
    """One row per row of ``docs``: ``doc``, ``n_shingles`` and ``component_id``.

    Two documents are linked when ``den`` times the intersection of their sets
    of ``words``-word shingles is at least ``num`` times the union; the
    component is the smallest id reachable. Texts without words (null, empty,
    white space) have no shingles and no links; rows that share an id count as
    one document that has the links of each of them. Rows with a null id come
    back with a null component. An empty table gives no rows. Ids are integers.
    """
    docs = docs.select(F.col(id).cast("long").alias("doc"), F.col(text).alias("text"))
    p = f"(n - ({num} * n + {den} - 1) div {den} + 1)"
    least = f"(({num} * n + {den} - 1) div {den})"
    s = f"(({least} - ({num} * {least} + {den} - 1) div {den} + 1) div 2)"  # the slack of the smallest partner
    sets = saved(_sets(docs, words, num, den, whole=False), "shingle-prefixes")
    classes = (sets.where("n > 0 and doc is not null").groupBy("n", "s1", "s2")
               .agg(F.min("doc").alias("rep"), F.min_by("shingles", "doc").alias("shingles")))
    classes = saved(classes, "shingle-classes")
    # ids of several rows, and the classes that an id of several texts joins
    worded = F.when(F.col("n") > 0, F.struct("n", "s1", "s2"))
    repeated = saved(sets.where("doc is not null").groupBy("doc")
                     .agg(F.count(F.lit(1)).alias("k"), F.min(worded).alias("a"), F.max(worded).alias("b"))
                     .where("k > 1").select("doc", F.coalesce(_int("a < b"), F.lit(False)).alias("several")), "repeated-ids")
    repeats = not repeated.isEmpty()
    # 2. which shingles of the extended prefixes do other representatives have
    listed = classes.select("rep", "n", F.explode("shingles").alias("shingle"))
    common = listed.groupBy("shingle").agg(F.count(F.lit(1)).alias("f")).where("f > 1")
    shared = listed.join(common, "shingle").select("rep", "n", "shingle", F.col("f").cast("int").alias("f"))
    shared = saved(shared, "shared-shingles")
    hopeful = saved(shared.groupBy("rep", "n").agg(F.count(F.lit(1)).alias("c"),
                                                  F.count_if(F.col("f") > frequent).alias("hot"))
                    .where(f"c >= 1 + {s}").select("rep", "n", _int(f"hot > {s}").alias("hot")), "hopeful")
    wanted = hopeful.select(F.col("rep").alias("doc")).distinct()
    whole = _sets(docs.join(wanted, "doc", "left_semi"), words, num, den, whole=True).where("n > 0")
    if repeats:  # each set of an id once
        whole = whole.groupBy("doc", "n", "s1", "s2").agg(*[F.first(c).alias(c) for c in ("shingles", "begin", "bits")])
    whole = saved(whole, "shingle-sets")
    # 3. lists
    plain = (shared.where(F.col("f") <= frequent).join(hopeful.select("rep", "n"), ["rep", "n"], "left_semi")
             .select(F.lit(0).alias("kind"), "shingle", F.col("rep").alias("doc")))
    hot = hopeful.where("hot").select(F.col("rep").alias("doc")).distinct()
    often = saved(shared.where(F.col("f") > frequent).groupBy("shingle").agg(F.first("f").alias("f")), "frequent-shingles")
    ranked = (_rarest(whole.join(hot, "doc", "left_semi"), often, num, den)
              .select(F.lit(1).alias("kind"), "shingle", "doc"))
    lists = saved(plain.unionByName(ranked).distinct(), "shingle-lists")
    # 4. each set with the smallest document of its lists
    leads = lists.groupBy("kind", "shingle").agg(F.min("doc").alias("lead"), F.count(F.lit(1)).alias("m"))
    leads = saved(leads.where("m > 1"), "list-leads")
    sizes = whole.select("doc", "n", "bits").distinct()
    differ = "aggregate(zip_with(bx, bz, (a, b) -> bit_count(a ^ b)), 0, (a, b) -> a + b)"
    least_both = f"(({num} * (nx + ny) + {num + den - 1}) div {num + den})"
    star = (lists.join(leads, ["kind", "shingle"]).where("doc <> lead")
            .select(F.col("doc").alias("x"), F.col("lead").alias("y")).distinct()
            .join(sizes.select(F.col("doc").alias("x"), F.col("n").alias("nx"), F.col("bits").alias("bx")), "x")
            .join(sizes.select(F.col("doc").alias("y"), F.col("n").alias("ny"), F.col("bits").alias("bz")), "y")
            .where(f"{den} * least(nx, ny) >= {num} * greatest(nx, ny)")
            .where(f"{differ} <= nx + ny - 2 * {least_both}").select("x", "y").distinct())
    links = saved(_verify(star, whole, num, den), "links")
    if repeats:
        own = (sets.join(repeated.where("several").select("doc"), "doc", "left_semi").where("n > 0")
               .join(classes.select("n", "s1", "s2", "rep"), ["n", "s1", "s2"])
               .select(F.col("doc").alias("x"), F.col("rep").alias("y")))
        links = saved(links.unionByName(own.where("x <> y")), "links")
    found = components(links, "x", "y")
    # 5. what a list leaves open
    labelled = (lists.join(leads.where("m > 2").select("kind", "shingle", "m"), ["kind", "shingle"])
                .join(found.withColumnRenamed("node", "doc"), "doc", "left")
                .withColumn("component", F.coalesce("component", "doc")))
    labelled = saved(labelled, "labelled-lists")
    # lists of the same sets are one list: near copies share many shingles
    open_lists = (labelled.groupBy("kind", "shingle")
                  .agg(F.min("component").alias("a"), F.max("component").alias("b"), F.count(F.lit(1)).alias("k"),
                       F.bit_xor(F.xxhash64("doc")).alias("x1"), F.bit_xor(F.xxhash64(F.lit("list"), "doc")).alias("x2"))
                  .where("a < b").groupBy("k", "x1", "x2").agg(F.min(F.struct("kind", "shingle")).alias("t"))
                  .select("t.kind", "t.shingle"))
    parts = F.expr(f"cast(ceil(m / {block}) as int)")
    rows = (labelled.join(open_lists, ["kind", "shingle"])
            .withColumn("parts", parts).withColumn("part", F.expr("pmod(xxhash64(doc), parts)"))
            # a list of several blocks: every pair of blocks, and each block with itself
            .withColumn("other", F.explode(F.expr("sequence(0, parts - 1)")))
            .withColumn("side", F.expr("cast(part > other as int)"))
            .select(F.xxhash64("kind", "shingle", F.least("part", "other"), F.greatest("part", "other")).alias("key"),
                    "doc", "component", "side"))
    rows = rows.join(whole.select("doc", "n", "begin", "bits"), "doc").select("key", "doc", "component", "side", "n", "begin", "bits")
    n = int(docs.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    maybe = saved(_walk(rows.repartition(n, "key").sortWithinPartitions("key", "side", "doc"), num, den)
                  .select(F.least("x", "y").alias("x"), F.greatest("x", "y").alias("y")).distinct(), "pairs")
    more = saved(_verify(maybe, whole, num, den), "links")
    final = components(links.unionByName(more), "x", "y") if not more.isEmpty() else found
    of_class = (classes.select("n", "s1", "s2", "rep").join(final.withColumnRenamed("node", "rep"), "rep", "left")
                .select("n", "s1", "s2", F.coalesce("component", "rep").alias("least")))
    out = (sets.select("doc", "n", "s1", "s2").join(of_class, ["n", "s1", "s2"], "left")
           .select("doc", F.col("n").alias("n_shingles"),
                   F.when(F.col("doc").isNotNull(), F.coalesce("least", "doc")).alias("component_id")))
    if repeats:  # rows without words have the component of their id's other rows
        known = (out.where("n_shingles > 0").join(repeated.select("doc"), "doc", "left_semi")
                 .groupBy("doc").agg(F.min("component_id").alias("known")))
        out = out.join(known, "doc", "left").select("doc", "n_shingles", F.coalesce("known", "component_id").alias("component_id"))
    return out
