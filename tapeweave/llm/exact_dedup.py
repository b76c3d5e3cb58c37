"""Exact dedup by block naming: equal texts, and only those, end with the same integer name.

Every text is cut into blocks of ``BLOCK`` bytes. The distinct blocks are sorted
and numbered, and each block of a text is replaced by its number. Adjacent pairs
of numbers are sorted and numbered in turn, until one number is left of each
text; (round, number) is its identity. The order that numbers blocks is that of
a 128-bit hash, of which each name's least and greatest block are compared: if a
hash has two blocks, another hash is taken, so names are never shared by chance.
Blocks meet as partial aggregates, and of a key that many places hold only the
name travels, by broadcast of the at most ``HOT`` keys that are so frequent.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tapeweave.llm.common import join_counted, saved

BLOCK = 1024
HOT = 1000  # keys with more than a HOT-th of all rows are joined by broadcast; there are fewer than HOT


def block_hashes(block: Column, seed: int) -> tuple[Column, Column]:
    return F.xxhash64(F.lit(2 * seed), block), F.xxhash64(F.lit(2 * seed + 1), block)


def _blocks(size: int) -> Column:
    """The binary column ``data`` in blocks; an empty one is one empty block."""
    return F.expr(f"transform(sequence(0, greatest(0, cast((octet_length(data) - 1) div {size} as int))),"
                  f" i -> substring(data, i * {size} + 1, {size}))")


def _block_names(texts: DataFrame, size: int, hashes: Callable[[Column, int], tuple[Column, Column]]) -> tuple[DataFrame, int]:
    """Number of each distinct block by its hashes, and the seed that tells all blocks apart."""
    seed = 0
    while True:
        h1, h2 = hashes(F.col("block"), seed)
        found = (texts.select(F.explode(_blocks(size)).alias("block"))
                 .groupBy(h1.alias("h1"), h2.alias("h2"))
                 .agg(F.min("block").alias("least"), F.max("block").alias("most"), F.count(F.lit(1)).alias("n"))
                 .sortWithinPartitions("h1", "h2"))
        names = saved(found.select("h1", "h2", "n", (F.monotonically_increasing_id() + 1).alias("name"),
                                   (F.col("least") < F.col("most")).alias("shared")), "block-names")
        if names.where("shared").isEmpty():
            return names.drop("shared"), seed
        seed += 1


def classes(docs: DataFrame, id: str = "doc_id", text: str = "text", block: int = BLOCK,
            hashes: Callable[[Column, int], tuple[Column, Column]] = block_hashes, row: str | None = None) -> DataFrame:
    """One row per row of ``docs``: ``row``, ``doc`` (its id), ``text_sha256``, ``keep`` (id of the
    row that stays), ``group_size`` and ``kept``.

    Texts are equal when they are the same bytes; null counts as empty, and empty
    texts equal each other. Of equal texts the row with the largest id stays, a
    null id being the smallest; of rows that share that id too one stays. ``row``
    is a number of the row, that of column ``row`` if given. An empty table gives
    no rows; other columns play no part, whatever their names.
    """
    number = F.col(row) if row else F.monotonically_increasing_id()
    data = F.coalesce(F.col(text), F.lit("")).cast("binary")
    names, seed = _block_names(docs.select(data.alias("data")), block, hashes)
    h1, h2 = hashes(F.col("b"), seed)
    rows = docs.select(number.alias("row"), F.col(id).alias("doc"), data.alias("data"))
    rows = saved(rows.select("row", "doc", F.unhex(F.sha2("data", 256)).alias("sha"),
                             F.transform(_blocks(block), lambda b: F.struct(
                                 *(h.alias(n) for h, n in zip(hashes(b, seed), ("h1", "h2"))))).alias("blocks")), "block-hashes")
    seen = rows.agg(F.count(F.lit(1)).alias("rows"), F.coalesce(F.sum(F.size("blocks")), F.lit(0)).alias("places"),
                    F.coalesce(F.max(F.size("blocks")), F.lit(0)).alias("longest")).first()
    places = rows.select("row", "doc", F.size("blocks").alias("size"), F.posexplode("blocks").alias("pos", "b"))
    level = saved(join_counted(places.select("row", "doc", "size", "pos", "b.*"), names, ["h1", "h2"], "n", seen["places"], HOT)
                  .select("row", "doc", "size", "pos", "name"), "named-blocks")
    ends = level.where("size = 1").select("row", "doc", F.lit(0).alias("round"), "name")
    longest, total, turn = seen["longest"], seen["places"], 0
    while longest > 1:
        turn += 1
        pairs = (level.where("size > 1")
                 .groupBy("row", "doc", F.expr("(size + 1) div 2").cast("int").alias("size"), F.expr("pos div 2").cast("int").alias("pos"))
                 .agg(F.max(F.when(F.col("pos") % 2 == 0, F.col("name"))).alias("a"),
                      F.coalesce(F.max(F.when(F.col("pos") % 2 == 1, F.col("name"))), F.lit(0)).alias("b")))
        pairs = saved(pairs, "name-pairs")
        names = pairs.groupBy("a", "b").agg(F.count(F.lit(1)).alias("n")).sortWithinPartitions("a", "b")
        names = saved(names.select("a", "b", "n", (F.monotonically_increasing_id() + 1).alias("name")), "pair-names")
        total = names.agg(F.sum("n")).first()[0]
        level = saved(join_counted(pairs, names, ["a", "b"], "n", total, HOT).select("row", "doc", "size", "pos", "name"), "named-pairs")
        ends = ends.unionByName(level.where("size = 1").select("row", "doc", F.lit(turn).alias("round"), "name"))
        longest = (longest + 1) // 2
    groups = (ends.groupBy("round", "name")
              .agg(F.count(F.lit(1)).alias("group_size"), F.max(F.struct("doc", "row")).alias("top"))
              .select("round", "name", F.struct("group_size", "top").alias("g"), F.col("group_size").alias("n")))
    groups = saved(groups, "text-groups").withColumnRenamed("name", "last").withColumnRenamed("g", "name")
    found = join_counted(ends.withColumnRenamed("name", "last").drop("doc"), groups, ["round", "last"], "n", seen["rows"], HOT)
    return (rows.select("row", "doc", "sha").join(found.select("row", F.col("name").alias("g")), "row")
            .select("row", "doc", F.lower(F.hex("sha")).alias("text_sha256"), F.col("g.top.doc").alias("keep"),
                    F.col("g.group_size").alias("group_size"), (F.col("row") == F.col("g.top.row")).alias("kept")))


def drop_copies(docs: DataFrame, id: str = "doc_id", text: str = "text", block: int = BLOCK) -> DataFrame:
    """The rows of ``docs`` that stay, with all their columns; see ``classes``."""
    wrapped = saved(docs.select(F.monotonically_increasing_id().alias("row"), F.struct("*").alias("all")), "numbered-rows")
    keys = wrapped.select("row", F.col("all")[id].alias("id"), F.col("all")[text].alias("text"))
    kept = classes(keys, "id", "text", block, row="row").where("kept").select("row")
    return wrapped.join(kept, "row", "left_semi").select("all.*")
