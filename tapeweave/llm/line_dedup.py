"""Line dedup: first occurrences by range-partitioned hashes, keep bitmaps per document.

Lines travel as 128-bit hashes with document and position, never as text. They
are range-partitioned by (hash, salt of the document) and sorted by document and
position inside, so one stream over a partition meets every first occurrence
before its repeats. A line that all documents hold is spread over ``SALTS``
ranges; only each range's first document goes on to the second, global look.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from tapeweave.llm.common import LOWER, UPPER, WS, saved

MIN_CHARS = 10
SALTS = 64


def line_key(line: Column) -> Column:
    """A line without ASCII white space at its ends, A-Z in lower case."""
    return F.translate(F.trim(line, F.lit(WS)), UPPER, LOWER)


def _lines(text: Column) -> Column:
    return F.split(F.coalesce(text, F.lit("")), "\n", -1)


def _row(text: Column) -> Column:
    """Tells apart rows of one id with different texts; equal rows have equal bitmaps."""
    return F.xxhash64(text)


def keep_bitmaps(docs: DataFrame, id: str = "doc_id", text: str = "text", min_chars: int = MIN_CHARS,
                 salts: int = SALTS) -> DataFrame:
    """Which lines stay: ``doc``, ``row`` (hash of the text), ``n_dropped`` and ``keep``.

    A line goes if its key has at least ``min_chars`` code points and a smaller
    id holds the key too. ``keep`` lists words of 64 lines, (word, bits), bit i
    of word w set when line 64 w + i stays; words without a dropped line, and
    documents without one, are left out. Rows with a null id take no part and
    keep all lines; null and empty texts are one empty line; rows that share an
    id count as one document, so they never drop each other's lines. An empty
    table gives no rows.
    """
    lines = (docs.where(F.col(id).isNotNull())
             .select(F.col(id).alias("doc"), _row(F.col(text)).alias("row"),
                     F.posexplode(F.transform(_lines(F.col(text)), line_key)).alias("pos", "key"))
             .where(F.length("key") >= min_chars)
             .select("doc", "row", "pos", F.xxhash64("key").alias("h1"),
                     F.xxhash64(F.lit("line"), "key").alias("h2")))
    lines = saved(lines, "line-hashes").withColumn("salt", F.pmod(F.xxhash64("doc"), F.lit(salts)))
    n = int(docs.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    stream = (W.partitionBy("h1", "h2", "salt").orderBy("doc", "pos")
              .rowsBetween(W.unboundedPreceding, W.currentRow))
    met = (lines.repartitionByRange(n, "h1", "h2", "salt")
           .withColumn("first", F.first("doc").over(stream)))
    again = met.where("doc > first").select("doc", "row", "pos")
    # at most ``salts`` documents of a key are left
    heads = met.where("doc = first").withColumn("least", F.min("doc").over(W.partitionBy("h1", "h2")))
    dropped = again.unionByName(heads.where("doc > least").select("doc", "row", "pos"))
    words = (dropped.groupBy("doc", "row", F.shiftright("pos", 6).alias("word"))
             .agg(F.expr("bit_or(shiftleft(1L, pos & 63))").alias("bits")))
    return (words.groupBy("doc", "row")
            .agg(F.sum(F.bit_count("bits")).alias("n_dropped"),
                 F.sort_array(F.collect_list(F.struct("word", F.bitwise_not("bits").alias("bits")))).alias("keep")))


def dedup_lines(docs: DataFrame, bitmaps: DataFrame | None = None, id: str = "doc_id",
                text: str = "text") -> DataFrame:
    """``docs`` with ``text`` cut to the kept lines (joined by a newline), and
    ``n_lines`` (before) and ``n_dropped`` behind its columns.

    Every row stays. A text that loses no line is unchanged (null stays null);
    one that loses all of them is empty. Columns of the two names are replaced.
    """
    bitmaps = keep_bitmaps(docs, id, text) if bitmaps is None else bitmaps
    inner = docs.select(F.col(id).alias("doc"), _row(F.col(text)).alias("row"), F.struct("*").alias("all"),
                        F.col(text).alias("text"))
    # expands the bitmap once, so that each line's bit is found by its index
    dense = F.expr("transform(sequence(0, shiftright(size(lines) - 1, 6)), w -> coalesce(words[w], -1L))")
    kept = F.expr("filter(lines, (x, i) -> (shiftright(dense[shiftright(i, 6)], i & 63) & 1) = 1)")
    out = (inner.join(bitmaps, ["doc", "row"], "left")
           .withColumn("lines", _lines(F.col("text")))
           .withColumn("words", F.map_from_entries("keep"))
           .withColumn("dense", F.when(F.col("n_dropped") > 0, dense))
           .withColumn("kept", F.when(F.col("n_dropped") > 0, F.concat_ws("\n", kept)).otherwise(F.col("text"))))
    names = [F.col("kept").alias(c) if c == text else F.col("all")[c].alias(c)
             for c in docs.columns if c not in ("n_lines", "n_dropped")]
    return out.select(*names, F.size("lines").cast("long").alias("n_lines"),
                      F.coalesce("n_dropped", F.lit(0)).cast("long").alias("n_dropped"))
