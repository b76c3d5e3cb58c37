"""Embedding near-duplicates through a forest of random-projection trees with spill.

Every tree cuts recursively at a random place along a random direction; vectors
near a cut go to both sides. Two vectors that end in a leaf together are
compared, and a pair counts in the first leaf that holds both, so nothing is
counted twice. Trees are added until partners planted at the threshold itself
are met in one of them almost surely, so the work follows the number of leaves
and not that of pairs.

A cut through a large group of near copies saves nothing and loses links. Groups
are found on the sample; every vector belongs to the nearest one in reach and is
compared with its group once, in blocks, outside the trees. Of those whose angle
to the centre is at most half the threshold's, all pairs are linked: they are
counted, not compared. The trees then part groups from each other and from the
rest: a group counts as one vector for the cuts, and is met only by vectors
whose angle to its centre allows a link.

Tasks return how many vectors each one is linked with and a spanning forest of
the links, never the pairs. Equal vectors are one class from the start.
"""

from __future__ import annotations

import pickle
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tapeweave.llm.common import components, saved
from tapeweave.session import BROADCAST_ROWS

SAMPLE = 8_000  # vectors that the fit may see at most
LEAF = 600  # vectors of the whole table that a leaf should hold
SPILL = 0.25  # overlap on either side of a cut, against what a pair at the threshold differs along a random direction
LOST = 0.005  # share of partners at the threshold that no tree may bring together
TREES = 32  # at most
GROUPS = 512  # groups at most; their centres are broadcast
SEEN = 8  # vectors of the sample that a group needs
REACH = 0.8  # of the threshold's angle: how far from its centre a group goes
BLOCK = 4000


@dataclass
class Forest:
    """``trees``, each a list of nodes (direction, cut, overlap, left, right) or (leaf number,); numbers go on from tree
    to tree, after those of the groups. ``recall`` is the share of planted partners that share a leaf."""

    centres: np.ndarray
    trees: list[list[tuple]]
    leaves: int
    recall: float


def fit(sample: np.ndarray, total: int, threshold: float, leaf: int = LEAF, seed: int = 11) -> Forest:
    rng = np.random.default_rng(seed)
    dim = sample.shape[1]
    theta = np.arccos(np.clip(threshold, -1, 1))
    share = total / max(1, len(sample))
    centres = _centres(sample, theta, leaf / share)
    group, _ = grouped(sample, centres, theta)
    # a group counts as one vector, which stands for itself; the others stand for their share of the table
    units = np.concatenate([sample[group < 0], centres])
    weight = np.r_[np.full((group < 0).sum(), share), np.ones(len(centres))]
    spill = SPILL * np.sqrt(max(0.0, 2 - 2 * threshold) / dim)
    asked = units[rng.integers(len(units), size=min(2000, 4 * len(units)))] if len(units) else units
    partner = rng.standard_normal(asked.shape)
    partner -= (partner * asked).sum(1, keepdims=True) * asked
    partner /= np.maximum(np.linalg.norm(partner, axis=1, keepdims=True), 1e-12)
    partner = np.cos(theta) * asked + np.sin(theta) * partner
    trees, number, apart = [], len(centres), np.ones(len(asked), bool)
    while not trees or (apart.mean() > LOST if len(apart) else False) and len(trees) < TREES:
        nodes, number = _tree(units, weight, leaf, spill, number, rng)
        trees.append(nodes)
        apart &= ~_together(nodes, asked, partner)
        if len(nodes) == 1:
            break
    return Forest(centres, trees, number, 1 - float(apart.mean()) if len(apart) else 1.0)


def _centres(sample: np.ndarray, theta: float, least: float) -> np.ndarray:
    """Centres of groups that hold more than a leaf may: of what is left, the vector with most neighbours leads."""
    left, centres = sample, []
    near = _neighbours(sample, np.cos(theta))
    while len(centres) < GROUPS and len(left) and near.max() >= max(SEEN, least):
        lead = left[near.argmax()]
        centre = left[left @ lead >= np.cos(theta)].mean(0)
        centre /= np.linalg.norm(centre)
        centres.append(centre)
        stay = left @ centre < np.cos(REACH * theta)
        if stay.all():
            centres.pop()
            break
        gone, left, near = left[~stay], left[stay], near[stay]
        for i in range(0, len(left), 1024):
            near[i:i + 1024] -= (left[i:i + 1024] @ gone.T >= np.cos(theta)).sum(1)
    return np.array(centres).reshape(-1, sample.shape[1])


def _neighbours(sample: np.ndarray, cosine: float) -> np.ndarray:
    out = np.zeros(len(sample), np.int64)
    for i in range(0, len(sample), 1024):
        out[i:i + 1024] = (sample[i:i + 1024] @ sample.T >= cosine).sum(1)
    return out


def grouped(vectors: np.ndarray, centres: np.ndarray, theta: float) -> tuple[np.ndarray, np.ndarray]:
    """The group of each vector (-1: none), and whether it lies so near the centre that it is linked with all such."""
    if not len(centres) or not len(vectors):
        return np.full(len(vectors), -1, np.int64), np.zeros(len(vectors), bool)
    cosine = vectors @ centres.T
    group = cosine.argmax(1)
    best = cosine[np.arange(len(vectors)), group]
    return np.where(best >= np.cos(REACH * theta), group, -1), best >= np.cos(theta / 2) + 1e-9


def _tree(units: np.ndarray, weight: np.ndarray, leaf: int, spill: float, number: int,
          rng: np.random.Generator) -> tuple[list[tuple], int]:
    nodes: list[tuple] = [()]
    todo = [(0, np.arange(len(units)))]
    while todo:
        at, rows = todo.pop()
        found = None
        if weight[rows].sum() > leaf and len(rows) >= 16:
            for _ in range(4):  # directions along which most are alike part nothing
                direction = rng.standard_normal(units.shape[1])
                direction /= np.linalg.norm(direction)
                seen = units[rows] @ direction
                cut = float(np.quantile(seen, rng.uniform(0.35, 0.65)))
                left, right = rows[seen <= cut + spill], rows[seen >= cut - spill]
                if max(len(left), len(right)) <= 0.8 * len(rows):
                    found = (direction, cut, spill)
                    break
        if found is None:
            nodes[at] = (number,)
            number += 1
            continue
        nodes[at] = (*found, len(nodes), len(nodes) + 1)
        nodes += [(), ()]
        todo += [(nodes[at][3], left), (nodes[at][4], right)]
    return nodes, number


def leaves(nodes: list[tuple], vectors: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(row, leaf) of every leaf of a tree that each row reaches, sorted."""
    out_rows, out_leaves = [np.zeros(0, np.int64)], [np.zeros(0, np.int64)]
    todo = [(0, np.arange(len(vectors)))]
    while todo:
        at, rows = todo.pop()
        if not len(rows):
            continue
        if len(nodes[at]) == 1:
            out_rows.append(rows)
            out_leaves.append(np.full(len(rows), nodes[at][0]))
            continue
        direction, cut, spill, left, right = nodes[at]
        seen = vectors[rows] @ direction
        todo += [(left, rows[seen <= cut + spill]), (right, rows[seen >= cut - spill])]
    rows, leaf = np.concatenate(out_rows), np.concatenate(out_leaves)
    order = np.lexsort((leaf, rows))
    return rows[order], leaf[order]


def _together(nodes: list[tuple], a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Which rows of ``a`` and ``b`` share a leaf."""
    (ra, la), (rb, lb) = leaves(nodes, a), leaves(nodes, b)
    width = max(la.max(initial=0), lb.max(initial=0)) + 1
    shared = np.intersect1d(ra * width + la, rb * width + lb) // width
    return np.isin(np.arange(len(a)), shared)


def work(forest: Forest, vectors: np.ndarray, threshold: float) -> float:
    """Comparisons against all pairs, for a look at what a forest saves."""
    theta = np.arccos(threshold)
    group, core = grouped(vectors, forest.centres, theta)
    done = 0.0
    for g in range(len(forest.centres)):
        size, inner = (group == g).sum(), ((group == g) & core).sum()
        done += size * (size - 1) / 2 - inner * (inner - 1) / 2
    for nodes in forest.trees:
        rows, leaf = leaves(nodes, vectors)
        for part in np.split(rows[np.argsort(leaf, kind="stable")], np.flatnonzero(np.diff(np.sort(leaf))) + 1):
            single, held = part[group[part] < 0], part[group[part] >= 0]
            done += len(single) * (len(single) - 1) / 2
            for g in np.unique(group[held]):
                done += (vectors[single] @ forest.centres[g] >= np.cos(min(np.pi, (1 + REACH) * theta))).sum() * (group[held] == g).sum()
    return done / (len(vectors) * (len(vectors) - 1) / 2)


def _matrix(column: pa.Array) -> np.ndarray:
    """Unit vectors of lists of equal length, in double precision."""
    offsets = column.offsets.to_numpy()
    v = column.values.to_numpy(zero_copy_only=False)[offsets[0]:offsets[-1]].astype(np.float64).reshape(len(column), -1)
    v = v / np.abs(v).max(1, keepdims=True)
    return v / np.linalg.norm(v, axis=1, keepdims=True)


def _compare(threshold: float, centres: np.ndarray):
    """Links inside a leaf, or between the two blocks of a pair of it; a group's own leaf has the number of its centre."""
    theta = np.arccos(np.clip(threshold, -1, 1))
    reach = np.cos(min(np.pi, (1 + REACH) * theta)) - 1e-9  # a vector farther from a centre has no link in its group
    apart = np.cos(min(np.pi, (1 + 2 * REACH) * theta)) - 1e-9  # two groups

    def run(group: pa.Table) -> pa.Table:
        group = group.combine_chunks()
        column = {c: group.column(c).chunk(0) for c in group.column_names} if group.num_rows else {}
        vectors, rep, cls = _matrix(column["vector"]), column["rep"].to_numpy(), column["cls"].to_numpy()
        many, side = column["m"].to_numpy(), column["side"].to_numpy()
        mine, core = column["grp"].to_numpy(), column["core"].to_numpy(zero_copy_only=False)
        leaf = column["leaf"][0].as_py()
        held = column["leaves"]
        size = np.diff(held.offsets.to_numpy())
        member = np.full((len(rep), max(size)), -1, np.int64)
        member[np.arange(max(size)) < size[:, None]] = held.values.to_numpy()
        count = np.zeros(len(rep), np.int64)
        root = np.arange(len(rep))
        cross = bool(side.any()) and not side.all()

        def meet(rows: np.ndarray, cols: np.ndarray) -> None:
            """Compare ``rows`` with ``cols``; if they are the same, each pair once."""
            same = rows is cols
            for begin in range(0, len(rows), 256):
                part, facing = rows[begin:begin + 256], cols[begin:] if same else cols
                i, j = np.nonzero(vectors[part] @ vectors[facing].T >= threshold)
                i, j = part[i], facing[j]
                if same:
                    i, j = i[i < j], j[i < j]
                if not len(i):
                    continue
                owned = np.ones(len(i), bool)
                if leaf >= len(centres):  # the first common leaf owns the pair
                    for k in range(member.shape[1] if member.shape[1] > 1 else 0):
                        leaf_of = member[i, k]
                        earlier = np.flatnonzero(owned & (leaf_of >= 0) & (leaf_of < leaf))
                        if len(earlier):
                            owned[earlier] = ~(member[j[earlier]] == leaf_of[earlier, None]).any(1)
                np.add.at(count, i[owned], many[j[owned]])
                np.add.at(count, j[owned], many[i[owned]])
                _join(root, i, j)

        whole = np.arange(len(rep))
        first, second = (whole[side == 0], whole[side == 1]) if cross else (whole, whole)
        if leaf < len(centres):  # a group: all pairs but those inside the core
            rim1, rim2 = first[~core[first]], second[~core[second]]
            if cross:
                meet(rim1, second)
                meet(first[core[first]], rim2)
            else:
                meet(rim1, rim1)
                meet(rim1, first[core[first]])
        else:
            ones = first[mine[first] < 0]
            others = second[mine[second] < 0] if cross else ones
            meet(ones, others)
            for single, many_of in ((ones, second), (others, first)) if cross else ((ones, first),):
                for g in np.unique(mine[many_of]):
                    if g >= 0:  # those of a group meet what can be near enough to its centre
                        meet(single[vectors[single] @ centres[g] >= reach], many_of[mine[many_of] == g])
            for g in np.unique(mine[first]):
                for h in np.unique(mine[second]):
                    if g >= 0 and h >= 0 and (g < h or cross and g != h) and centres[g] @ centres[h] >= apart:
                        meet(first[mine[first] == g], second[mine[second] == h])
        keep = (count > 0) | (root != whole)
        return pa.table({"rep": rep[keep], "cls": cls[keep], "links": count[keep], "up": rep[root][keep]})

    return run


def _join(root: np.ndarray, i: np.ndarray, j: np.ndarray) -> None:
    """Join the components of ``i`` and ``j``; each entry of ``root`` is the smallest member of its component."""
    while True:
        a, b = root[i], root[j]
        apart = a != b
        if not apart.any():
            return
        i, j, a, b = i[apart], j[apart], a[apart], b[apart]
        np.minimum.at(root, np.maximum(a, b), np.minimum(a, b))
        while (root[root] != root).any():
            root[:] = root[root]


def near_duplicates(vectors: DataFrame, id: str = "vec_id", vector: str = "embedding", threshold: float = 0.9,
                    leaf: int = LEAF, sample: int = SAMPLE, block: int = BLOCK) -> DataFrame:
    """One row per row of ``vectors``: ``id``, ``n_links``, ``component_id`` and ``kept``.

    Two vectors are linked when their cosine is at least ``threshold``; no other
    pair ever is. A table of at most ``leaf`` vectors is one leaf and compared
    whole; of a larger one a pair at the threshold itself may be missed (``LOST``),
    nearer pairs less, and pairs inside a group never. Vectors that are null, empty, zero or hold null or
    non-finite components, and rows with a null id, are linked with nothing;
    vectors of different lengths are never compared. ``component_id`` is the
    smallest id reachable (null for a null id); rows that share an id count as
    vectors of their own. An empty table gives no rows.
    """
    narrow = vectors.schema[vector].dataType.simpleString() == "array<float>"  # travels as it is, compared in doubles
    rows = vectors.select(F.col(id).cast("long").alias("id"), F.col(vector).cast("array<float>" if narrow else "array<double>").alias("v"))
    finite = F.forall("v", lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")))
    some = F.exists("v", lambda x: x != 0)
    fine = F.coalesce(F.col("id").isNotNull() & finite & some, F.lit(False))
    rows = rows.select("id", F.when(fine, F.col("v")).alias("v"))
    rows = rows.withColumn("cls", F.xxhash64("v")).withColumn("cls2", F.xxhash64(F.lit("second"), "v"))
    classes = saved(rows.where("v is not null").groupBy("cls", "cls2")
                    .agg(F.min("id").alias("rep"), F.count(F.lit(1)).alias("m"), F.min("v").alias("vector")), "vector-classes")
    parts: list[DataFrame] = []
    inside: list[DataFrame] = []
    for (dim, total) in [tuple(r) for r in classes.groupBy(F.size("vector")).count().orderBy("count").collect()]:
        part = classes.where(F.size("vector") == dim)
        # thinned first, so that tasks send the driver no more than their part of a sample
        some = part.where(F.pmod(F.xxhash64("cls"), F.lit(total)) < 2 * sample)
        drawn = some.orderBy(F.xxhash64("cls"), "cls2").limit(sample).select("vector").toArrow()
        forest = fit(_matrix(drawn.column(0).combine_chunks()), total, threshold, leaf)
        # The sizes first, so that a row goes to its leaf's blocks in the one shuffle that carries vectors.
        sizes = saved(_drop(part, forest, dim, threshold, narrow=True).groupBy("leaf").agg(F.count(F.lit(1)).alias("size"))
                      .where("size > 1"), "forest-leaves")
        dropped = _drop(part, forest, dim, threshold)
        parts.append(dropped.join(F.broadcast(sizes) if forest.leaves <= BROADCAST_ROWS else sizes, "leaf")
                     .withColumn("parts", F.expr(f"cast(ceil(size / {block}) as int)"))
                     .withColumn("part", F.expr("cast(pmod(xxhash64(cls), parts) as int)"))
                     .withColumn("other", F.explode(F.expr("sequence(0, parts - 1)")))
                     .withColumn("side", F.expr("cast(part > other as int)"))
                     .withColumn("low", F.least("part", "other")).withColumn("high", F.greatest("part", "other"))
                     .drop("size", "parts", "part", "other").groupBy("leaf", "low", "high")
                     .applyInArrow(_compare(threshold, forest.centres), "rep long, cls long, links long, up long"))
        inside.append(_drop(part, forest, dim, threshold, narrow=True).where(F.col("core") & (F.col("leaf") == F.col("grp")))
                      .select(F.lit(dim).alias("dim"), "grp", "rep", "cls", "m"))
    spark = vectors.sparkSession
    if parts:
        found, cores = parts[0], inside[0]
        for p, c in zip(parts[1:], inside[1:]):
            found, cores = found.unionByName(p), cores.unionByName(c)
        found, cores = saved(found, "forest-links"), saved(cores, "forest-cores")
        # all pairs of a core are linked
        totals = cores.groupBy("dim", "grp").agg(F.sum("m").alias("total"), F.min("rep").alias("up"))
        inner = cores.join(F.broadcast(totals), ["dim", "grp"]).select("rep", "cls", (F.col("total") - F.col("m")).alias("links"), "up")
        found = found.unionByName(inner)
        counts = found.groupBy("rep", "cls").agg(F.sum("links").alias("links"))
        linked = components(found.select(F.col("rep").alias("a"), F.col("up").alias("b")))
    else:
        counts = spark.createDataFrame([], "rep long, cls long, links long")
        linked = spark.createDataFrame([], "node long, component long")
    known = (classes.select("cls", "cls2", "rep", "m").join(counts, ["rep", "cls"], "left")
             .join(linked.withColumnRenamed("node", "rep"), "rep", "left")
             .select("cls", "cls2", (F.coalesce("links", F.lit(0)) + F.col("m") - 1).alias("n"),
                     F.coalesce("component", "rep").alias("c")))
    return (rows.select("id", F.when(F.col("v").isNotNull(), F.col("cls")).alias("cls"), "cls2")
            .join(known, ["cls", "cls2"], "left")
            .select(F.col("id").alias(id), F.coalesce("n", F.lit(0)).cast("long").alias("n_links"),
                    F.coalesce("c", "id").alias("component_id"),
                    F.coalesce(F.coalesce("c", "id") == F.col("id"), F.lit(False)).alias("kept")))


def _drop(classes: DataFrame, forest: Forest, dim: int, threshold: float, narrow: bool = False) -> DataFrame:
    """A row for each vector and leaf that it reaches, its group's first, with the vector and all its leaves unless ``narrow``."""
    sent = classes.sparkSession.sparkContext.broadcast(pickle.dumps(forest))  # bounded by the sample
    theta = float(np.arccos(np.clip(threshold, -1, 1)))
    names = ["rep", "cls", "m"] + ([] if narrow else ["vector"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        forest = pickle.loads(sent.value)
        for batch in (b.slice(i, 2048) for b in batches for i in range(0, b.num_rows, 2048)):
            vectors = _matrix(batch.column(3))
            group, core = grouped(vectors, forest.centres, theta)
            core &= group >= 0
            found = [leaves(nodes, vectors) for nodes in forest.trees]
            rows = np.concatenate([np.flatnonzero(group >= 0), *(r for r, _ in found)])
            leaf = np.concatenate([group[group >= 0], *(x for _, x in found)])
            order = np.lexsort((leaf, rows))
            rows, leaf = rows[order], leaf[order]
            at = pa.array(rows)
            columns = [*batch.select(names).take(at).columns, pa.array(leaf), pa.array(group[rows]), pa.array(core[rows])]
            if not narrow:
                begin = np.searchsorted(rows, np.arange(batch.num_rows + 1)).astype(np.int32)
                columns.append(pa.ListArray.from_arrays(pa.array(begin), pa.array(leaf.astype(np.int32))).take(at))
            yield pa.RecordBatch.from_arrays(columns, [*names, "leaf", "grp", "core", "leaves"][:len(columns)])

    kind = classes.schema["vector"].dataType.simpleString()
    return classes.select("rep", "cls", "m", "vector").mapInArrow(
        run, "rep long, cls long, m long, " + ("" if narrow else f"vector {kind}, ") + "leaf long, grp long, core boolean"
        + ("" if narrow else ", leaves array<int>"))
