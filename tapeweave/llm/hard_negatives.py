"""Hard negatives by inner product, through cover trees over norm-augmented vectors.

A further coordinate gives all vectors the norm of the longest one, so that an
inner product is a distance: <q, x> = (|q|^2 + M^2 - dist^2) / 2. The top of the
tree is fitted on a bounded sample (farthest-first centres); every row goes to
its nearest centre, and the rows of a centre, dealt out in parts of bounded size,
are covered level by level: a node knows a centre and the radius that covers all
below it, so distances to the centre bound all inner products below.

A query descends from the nodes whose bounds meet one of its windows [low, high]
and reach its k-th best score so far; leaves are verified exactly, the best
bounds first. First every query visits the part of the tree that promises most,
then, with the scores found there, all others that can still matter.
"""

from __future__ import annotations

import pickle
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Row
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from tapeweave.llm.common import saved

SAMPLE = 20_000  # rows that the top of the tree is fitted on at most
CENTRES = 256
PART = 4096  # rows of a centre that form one tree
LEAF = 48
FAN = 32  # children of a node at most
TOGETHER = 512  # queries that descend together
DEALT = 20_000  # queries of a tree that one task takes
NORM = float(1 << 55)  # squared norms stay below, so that scores times 95 are longs
OPEN_LOW, OPEN_HIGH = -(1 << 56), 1 << 56


def quantised(df: DataFrame, id: str = "vec_id", vector: str = "embedding", label: str = "label", scale: int = 256) -> DataFrame:
    """``row``, ``id``, ``label`` and ``v``, the vector as integers floor(``scale`` * x), of the rows that take part.

    Rows with a null label or vector, or a null or non-finite component, take no
    part; nor do those whose scores would not fit a long (a squared norm of
    2^55 or more).
    """
    inside = df.select(F.col(id).alias("id"), F.col(label).cast("long").alias("label"),
                       F.col(vector).cast("array<double>").alias("x"))
    fine = F.forall("x", lambda e: e.isNotNull() & ~F.isnan(e) & (F.abs(e) < float("inf")))
    inside = inside.where(F.col("label").isNotNull() & F.col("x").isNotNull()).where(fine)
    norm = F.aggregate("x", F.lit(0.0), lambda a, e: a + F.pow(F.floor(e * scale).cast("double"), 2))
    return (inside.where(norm < NORM)
            .select(F.monotonically_increasing_id().alias("row"), "id", "label",
                    F.transform("x", lambda e: F.floor(e * scale).cast("long")).alias("v")))


def _matrix(column: pa.ListArray, dims: int) -> np.ndarray:
    """Lists as the rows of a matrix, shorter ones filled up with 0."""
    out = np.zeros((len(column), dims), np.int64)
    offsets, values = column.offsets.to_numpy(), column.values.to_numpy()
    size = np.diff(offsets)
    out[np.repeat(np.arange(len(size)), size), np.arange(offsets[0], offsets[-1]) - np.repeat(offsets[:-1], size)] = values[offsets[0]:offsets[-1]]
    return out


def _products(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Exact inner products of integer rows; in doubles where those are exact."""
    if len(a) and len(b) and (a * a).sum(1).max() < 1 << 52 and (b * b).sum(1).max() < 1 << 52:
        return (a.astype(np.float64) @ b.T.astype(np.float64)).astype(np.int64)
    return a @ b.T


def _augmented(v: np.ndarray, norm: float) -> np.ndarray:
    x = v.astype(np.float64)
    return np.c_[x, np.sqrt(np.maximum(0.0, norm - (x * x).sum(1)))]


def _distances(x: np.ndarray, centre: np.ndarray) -> np.ndarray:
    d = x - centre
    return np.sqrt((d * d).sum(1))


def cover(x: np.ndarray, radius: float, most: int) -> tuple[list[int], np.ndarray, np.ndarray]:
    """Centres (row numbers, the farthest next) until all rows are within ``radius`` or there are ``most``; each row's centre and distance."""
    centres, near, of = [0], _distances(x, x[0]), np.zeros(len(x), np.int64)
    while len(centres) < most:
        far = int(near.argmax())
        if near[far] <= radius:
            break
        d = _distances(x, x[far])
        closer = d < near
        of[closer], near[closer] = len(centres), d[closer]
        centres.append(far)
    return centres, of, near


class CoverTree:
    """Nodes level by level: centre, covering radius, least and greatest label, children or leaf rows."""

    def __init__(self, v: np.ndarray, ids: np.ndarray, rows: np.ndarray, labels: np.ndarray, norm: float):
        x = _augmented(v, norm)
        start, _, near = cover(x, np.inf, 1)
        order: list[np.ndarray] = []
        centres, radii, spans, low, high = [start[0]], [near.max()], [(0, 0, True)], [0], [0]
        todo, done = [(0, np.arange(len(x)), near.max())], 0
        while todo:
            following = []
            for node, members, radius in todo:
                low[node], high[node] = labels[members].min(), labels[members].max()
                if len(members) <= LEAF or radius == 0:
                    members = members[np.lexsort((rows[members], ids[members]))]
                    order.append(members)
                    spans[node] = (done, done + len(members), True)
                    done += len(members)
                    continue
                picked, of, near = cover(x[members], radius / 2, min(FAN, max(2, -(-len(members) // LEAF))))
                spans[node] = (len(centres), len(centres) + len(picked), False)
                for i, p in enumerate(picked):
                    mine = of == i
                    centres.append(members[p])
                    radii.append(near[mine].max())
                    spans.append((0, 0, True))
                    low.append(0)
                    high.append(0)
                    following.append((len(centres) - 1, members[mine], radii[-1]))
            todo = following
        sort = np.concatenate(order)
        self.centre, self.radius = v[centres], np.array(radii)
        self.begin, self.end, self.leaf = (np.array(s) for s in zip(*spans))
        self.low, self.high = np.array(low), np.array(high)
        self.v, self.ids, self.rows, self.labels = v[sort], ids[sort], rows[sort], labels[sort]


def bounds(products: np.ndarray, norms: np.ndarray, radius: np.ndarray, norm: float) -> tuple[np.ndarray, np.ndarray]:
    """Least and greatest inner product of queries with what a ball holds, from that with its centre."""
    total = norms[:, None] + norm
    distance = np.sqrt(np.maximum(0.0, total - 2 * products))
    slack = 1 + 1e-9 * total
    reach = np.sqrt(norms)[:, None] * radius
    least = np.maximum((total - (distance + radius) ** 2) / 2, products - reach)
    most = np.minimum((total - np.maximum(0.0, distance - radius) ** 2) / 2, products + reach)
    return least - slack, most + slack


def _matter(least, most, low, high, best, labels, node_low, node_high, same: bool) -> np.ndarray:
    """Which queries have a window (their second axis) that the ball can add to."""
    open_ = ((least[:, :, None] <= high[:, None, :]) & (most[:, :, None] >= np.maximum(low, best)[:, None, :])).any(2)
    if same:
        return open_ & (node_low <= labels[:, None]) & (labels[:, None] <= node_high)
    return open_ & ~((node_low == labels[:, None]) & (node_high == labels[:, None]))


def _descend(tree: CoverTree, queries: dict[str, np.ndarray], k: int, same: bool, norm: float) -> Iterator[tuple]:
    """The best ``k`` rows of the tree in each window: (query row, window, score, id, row); more may follow the k-th."""
    q, labels, ids, low, high = (queries[c] for c in ("v", "label", "id", "low", "high"))
    best = queries["best"].copy()
    norms = (q.astype(np.float64) ** 2).sum(1)
    leaves: list[tuple[int, np.ndarray, np.ndarray]] = []
    todo = [(np.zeros(1, np.int64), np.arange(len(q)))]
    while todo:
        nodes, who = todo.pop()
        least, most = bounds(_products(q[who], tree.centre[nodes]).astype(np.float64), norms[who], tree.radius[nodes], norm)
        go = _matter(least, most, low[who], high[who], best[who], labels[who], tree.low[nodes], tree.high[nodes], same)
        for i, node in enumerate(nodes):
            mine = np.flatnonzero(go[:, i])
            if not len(mine):
                continue
            if tree.leaf[node]:
                leaves.append((node, who[mine], most[mine, i]))
            else:
                todo.append((np.arange(tree.begin[node], tree.end[node]), who[mine]))
    leaves.sort(key=lambda x: -x[2].max())
    windows = low.shape[1]
    tops = np.full((len(q), windows, k), OPEN_LOW, np.int64)  # best scores so far, the least first
    for node, who, most in leaves:
        alive = (most[:, None] >= np.maximum(low[who], best[who])).any(1)
        who = who[alive]
        if not len(who):
            continue
        a, b = tree.begin[node], tree.end[node]
        scores = _products(q[who], tree.v[a:b])
        if same:
            fit = (tree.labels[None, a:b] == labels[who, None]) & (tree.ids[None, a:b] != ids[who, None])
        else:
            fit = tree.labels[None, a:b] != labels[who, None]
        # in order of score, then id: what a window holds lies together, after what is above it
        kept = np.where(fit, scores, OPEN_LOW)
        order = np.argsort(-kept, axis=1, kind="stable")
        kept = np.take_along_axis(kept, order, 1)
        above = (kept[:, None, :] > high[who][:, :, None]).sum(2)
        place = above[:, :, None] + np.arange(k)
        inside = place < b - a
        place = np.minimum(place, b - a - 1)
        q_of = np.arange(len(who))[:, None, None]
        value = kept[q_of, place]
        fine = inside & (value >= np.maximum(low[who], best[who])[:, :, None])
        if not fine.any():
            continue
        tops[who] = np.sort(np.concatenate([tops[who], np.where(fine, value, OPEN_LOW)], axis=2), axis=2)[:, :, -k:]
        best[who] = np.maximum(best[who], tops[who][:, :, 0])
        i, w, j = np.nonzero(fine)
        at = a + order[i, place[i, w, j]]
        yield queries["row"][who[i]], w, value[i, w, j], tree.ids[at], tree.rows[at]


class Index:
    """The fitted top of the tree, and the trees of all rows as a written table."""

    def __init__(self, points: DataFrame, sample: int = SAMPLE, centres: int = CENTRES, part: int = PART):
        """``points`` has ``row``, ``id`` (long), ``label`` and ``v``; shorter vectors count as filled up with 0."""
        self.points = points
        seen = points.agg(F.count(F.lit(1)).alias("n"), F.max(F.size("v")).alias("dims"),
                          F.max(F.aggregate("v", F.lit(0).cast("long"), lambda a, e: a + e * e)).alias("norm")).first()
        self.rows, self.dims, self.norm = seen["n"], seen["dims"] or 0, float(seen["norm"] or 0)
        dims, norm = self.dims, self.norm
        # thinned first, so that tasks send the driver no more than their part of a sample
        some = points.where(F.pmod(F.xxhash64("row"), F.lit(max(1, self.rows))) < 2 * sample)
        fitted = some.orderBy(F.xxhash64("row"), "row").limit(sample).select("v").toArrow().column("v").combine_chunks()
        x = _matrix(fitted, dims)
        wanted = max(1, min(centres, -(-self.rows // part)))
        self.top = x[cover(_augmented(x, norm), 0.0, wanted)[0]] if len(x) else x
        top = points.sparkSession.sparkContext.broadcast(self.top)

        def assign(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            centre = _augmented(top.value, norm)
            for batch in batches:
                x = _augmented(_matrix(batch.column(batch.schema.get_field_index("v")), dims), norm)
                far = (x * x).sum(1)[:, None] + (centre * centre).sum(1) - 2 * (x @ centre.T)
                cell = far.argmin(1)
                d = np.sqrt(((x - centre[cell]) ** 2).sum(1))
                yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(cell.astype(np.int32)), pa.array(d)],
                                                 [*batch.schema.names, "cell", "distance"])

        dealt = saved(points.select("row", "id", "label", "v")
                      .mapInArrow(assign, "row long, id long, label long, v array<long>, cell int, distance double"), "tree-cells")
        self.cells = (dealt.groupBy("cell").agg(F.count(F.lit(1)).alias("n"), F.max("distance").alias("radius"),
                                                F.min("label").alias("low"), F.max("label").alias("high")).collect())
        parts = {r["cell"]: -(-r["n"] // part) for r in self.cells}  # as many entries as centres
        of = F.create_map(*[F.lit(x) for r in parts.items() for x in r]) if parts else F.create_map(F.lit(0), F.lit(1))

        def build(group: pa.Table) -> pa.Table:
            group = group.combine_chunks()
            v = _matrix(group.column("v").chunk(0), dims)
            cols = [group.column(c).to_numpy() for c in ("id", "row", "label")]
            tree = CoverTree(v, *cols, norm)
            return pa.table({"cell": group.column("cell")[:1], "part": group.column("part")[:1],
                             "tree": pa.array([pickle.dumps(tree)], pa.binary())})

        part_of = F.pmod(F.xxhash64("row"), of[F.col("cell")].cast("long")).cast("int")
        self.trees = saved(dealt.where("id is not null").withColumn("part", part_of).groupBy("cell", "part")
                           .applyInArrow(build, "cell int, part int, tree binary"), "cover-trees")
        self.parts = parts

    def _route(self, queries: DataFrame, same: bool, home: bool) -> DataFrame:
        """``queries`` with the ``cell`` to visit: the most promising one, or all others that may matter."""
        dims, norm = self.dims, self.norm
        order = sorted(self.cells, key=lambda r: r["cell"])
        plan = queries.sparkSession.sparkContext.broadcast(
            (self.top[[r["cell"] for r in order]], *(np.array([r[c] for r in order]) for c in ("radius", "low", "high", "cell"))))

        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            top, radius, least_label, most_label, cells = plan.value
            for batch in (b.slice(i, TOGETHER) for b in batches for i in range(0, b.num_rows, TOGETHER)):
                if not len(cells):
                    continue
                got = _arrays(batch, dims)
                v = got["v"]
                least, most = bounds(_products(v, top).astype(np.float64), (v.astype(np.float64) ** 2).sum(1), radius, norm)
                go = _matter(least, most, got["low"], got["high"], got["best"], got["label"], least_label, most_label, same)
                # what promises most: the greatest bound, of those that reach into a window
                lead = np.where(go, np.minimum(most, got["high"].max(1)[:, None]), -np.inf)
                first = np.zeros_like(go)
                first[np.arange(len(v)), lead.argmax(1)] = True
                home_go = first & np.isfinite(lead)
                if home:
                    who, at = np.nonzero(home_go)
                else:
                    visited = cells[None, :] == np.array(got["home"])[:, None]
                    who, at = np.nonzero(go & ~visited)
                yield pa.RecordBatch.from_arrays([*batch.take(pa.array(who)).columns, pa.array(cells[at].astype(np.int32))],
                                                 [*batch.schema.names, "cell"])

        schema = ", ".join(f"{f.name} {f.dataType.simpleString()}" for f in queries.schema.fields)
        return queries.mapInArrow(run, f"{schema}, cell int")

    def _visit(self, routed: DataFrame, k: int, same: bool, asked: int) -> DataFrame:
        """``row`` of the query, ``window``, ``score``, ``id`` and ``found`` (row) of what the trees of a cell hold."""
        spark, dims, norm = routed.sparkSession, self.dims, self.norm
        deals = max(1, -(-asked // DEALT))
        parts = [Row(cell=c, part=p) for c, n in self.parts.items() for p in range(n)]
        names = ["row", "id", "label", "v", "low", "high", "best", "home"]
        trees = (self.trees.withColumn("deal", F.explode(F.expr(f"sequence(0, {deals - 1})")))
                 .select("cell", "part", "deal", F.lit(0).alias("kind"), "tree", *[F.lit(None).cast(routed.schema[n].dataType).alias(n) for n in names]))
        table = F.broadcast(spark.createDataFrame(parts or [Row(cell=-1, part=-1)], "cell int, part int"))
        asks = (routed.join(table, "cell").withColumn("deal", F.pmod(F.xxhash64("row"), F.lit(deals)).cast("int"))
                .select("cell", "part", "deal", F.lit(1).alias("kind"), F.lit(None).cast("binary").alias("tree"), *names))
        n = int(spark.conf.get("spark.sql.shuffle.partitions"))
        stream = trees.unionByName(asks).repartition(n, "cell", "part", "deal").sortWithinPartitions("cell", "part", "deal", "kind", "row")

        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            tree: CoverTree | None = None
            for batch in (b.slice(i, TOGETHER) for b in batches for i in range(0, b.num_rows, TOGETHER)):
                kind = batch.column(3).to_numpy()
                cuts = [*np.flatnonzero(kind == 0), batch.num_rows]
                spans = [(0, cuts[0], None)] + [(c + 1, e, c) for c, e in zip(cuts, cuts[1:])]
                for a, e, at in spans:
                    if at is not None:
                        tree = pickle.loads(batch.column(4)[int(at)].as_py())
                    if e <= a or tree is None:
                        continue
                    for out in _descend(tree, _arrays(batch.slice(a, e - a).select(names), dims), k, same, norm):
                        yield pa.RecordBatch.from_arrays([pa.array(np.asarray(o).astype(np.int64)) for o in out],
                                                         ["row", "window", "score", "id", "found"])

        return stream.mapInArrow(run, "row long, window long, score long, id long, found long")

    def first(self, queries: DataFrame, k: int, same: bool) -> DataFrame:
        """The first ``k`` rows in every window of every query, by score and then id: ``row``, ``window``, ``score``, ``id``, ``found``.

        ``queries`` has ``row``, ``id``, ``label``, ``v`` and the arrays ``low`` and ``high``; partners have the
        query's label and another id (``same``) or another label.
        """
        by = W.partitionBy("row", "window").orderBy(F.desc("score"), F.asc("id"), F.asc("found"))

        def ranked(found: DataFrame) -> DataFrame:
            return found.withColumn("rank", F.row_number().over(by)).where(F.col("rank") <= k)

        asked = queries.count()
        fresh = queries.select("row", "id", "label", "v", "low", "high",
                               F.transform("low", lambda _: F.lit(OPEN_LOW).cast("long")).alias("best"), F.lit(-1).alias("home"))
        near = saved(self._route(fresh, same, home=True), "queries-home")
        found = saved(ranked(self._visit(near, k, same, asked)).drop("rank"), "found-home")
        reached = (found.groupBy("row", "window").agg(F.count(F.lit(1)).alias("n"), F.min("score").alias("least"))
                   .where(F.col("n") == k).groupBy("row")
                   .agg(F.map_from_entries(F.collect_list(F.struct(F.col("window").cast("int"), "least"))).alias("least")))
        known = (near.select("row", F.col("cell").alias("home_cell")).join(reached, "row", "left"))
        again = (fresh.join(known, "row")
                 .withColumn("best", F.expr(f"transform(low, (x, i) -> coalesce(least[i], {OPEN_LOW}L))"))
                 .withColumn("home", F.col("home_cell")).select(*fresh.columns))
        rest = saved(self._route(again, same, home=False), "queries-rest")
        return saved(ranked(found.unionByName(self._visit(rest, k, same, asked))), "found")


def _arrays(batch: pa.RecordBatch, dims: int) -> dict[str, np.ndarray]:
    """Queries as arrays; all of a batch have as many windows as the one with most, the others closed."""
    out = {n: batch.column(batch.schema.get_field_index(n)) for n in batch.schema.names}
    windows = max((len(x) for x in out["low"].to_pylist()), default=0)
    made = {n: out[n].to_numpy(zero_copy_only=False) for n in ("row", "id", "label", "home")}
    made["v"] = _matrix(out["v"], dims)
    for n, closed in (("low", OPEN_HIGH), ("high", OPEN_LOW), ("best", OPEN_LOW)):
        made[n] = np.full((batch.num_rows, windows), closed, np.int64)
        for i, x in enumerate(out[n].to_pylist()):
            made[n][i, :len(x)] = x
    return made


def mine(points: DataFrame, anchors: Column, positives: int = 5, negatives: int = 3, low: int = 50, high: int = 95,
         sample: int = SAMPLE, centres: int = CENTRES, part: int = PART) -> DataFrame:
    """Hard negatives: ``anchor_id``, ``positive_id``, ``rank``, ``negative_id``, ``positive_score``, ``negative_score``.

    ``points`` is as ``quantised`` makes it; rows for which ``anchors`` holds are
    the anchors. Scores are integer inner products, and rows come by score, then
    id. An anchor's positives are its first ``positives`` other rows of the same
    label; for each of them its negatives are the first ``negatives`` rows of
    another label with low * positive score <= 100 * score <= high * positive
    score. Positives without such a negative have no row. Rows with a null id
    take no part. Rows that share the anchor's id are never its positives, but
    those of another label may be negatives; repeated rows count each. Vectors
    of different lengths are compared as if filled up with 0. An empty table
    gives no rows.
    """
    points = saved(points.where("id is not null").select("row", F.col("id").cast("long").alias("id"), "label", "v"), "points")
    index = Index(points, sample, centres, part)
    asking = saved(points.where(anchors), "anchors")

    def window(x: int) -> Column:
        return F.array(F.lit(x).cast("long"))

    first = index.first(asking.withColumns({"low": window(OPEN_LOW + 1), "high": window(OPEN_HIGH)}), positives, same=True)
    ranges = first.select("row", F.struct("rank", F.col("id").alias("positive_id"), F.col("score").alias("positive_score"),
                                          F.expr(f"-((-{low} * score - pmod(-{low} * score, 100)) div 100)").alias("low"),
                                          F.expr(f"({high} * score - pmod({high} * score, 100)) div 100").alias("high")).alias("p"))
    ranges = ranges.where("p.low <= p.high")
    windows = saved(ranges.groupBy("row").agg(F.sort_array(F.collect_list("p")).alias("p")), "windows")
    asked = asking.join(windows, "row").withColumns({"low": F.col("p.low"), "high": F.col("p.high")})
    found = index.first(asked.drop("p"), negatives, same=False)
    return (found.withColumnRenamed("id", "negative_id").withColumnRenamed("score", "negative_score")
            .join(windows, "row").join(asking.select("row", F.col("id").alias("anchor_id")), "row")
            .withColumn("p", F.expr("p[cast(window as int)]"))
            .select("anchor_id", "p.positive_id", "rank", "negative_id", "p.positive_score", "negative_score"))
