"""One query per operator, over its whole table."""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tapeweave.llm import bpe, decontaminate, exact_dedup, forest, hard_negatives, jaccard, lexical, line_dedup, quality, repeats, secrets, token_files, warc
from tapeweave.llm.common import saved, table
from tapeweave.session import workspace


TOKENIZER = "byte_bpe_50k.json"


def op1_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    out = line_dedup.dedup_lines(docs)
    return out.select("doc_id", "n_lines", "n_dropped",
                      F.sha2(F.coalesce("text", F.lit("")).cast("binary"), 256).alias("kept_sha256"))


def op2_jaccard_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = jaccard.cluster(table(spark, sf_dir, "documents"), words=4, num=85, den=100)
    return found.withColumnRenamed("doc", "doc_id")


def op3_token_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = workspace(spark, "token-files")
    docs = table(spark, sf_dir, "documents")
    manifest = token_files.write(docs, out, public_tokenizers.path(TOKENIZER), end=2)
    return token_files.read(spark, manifest, out).select(
        F.col("doc").alias("doc_id"), "start", "n_tokens", F.crc32("ids").alias("ids_crc32"))


def op4_embedding_forest(spark: SparkSession, sf_dir: str) -> DataFrame:
    return forest.near_duplicates(table(spark, sf_dir, "embeddings"))


def op5_decontaminate(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    found = decontaminate.mark(docs, table(spark, sf_dir, "benchmark"))
    return found.select("doc_id", F.explode("spans").alias("s")).select("doc_id", "s.*")


def op6_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    model = quality.train(docs, table(spark, sf_dir, "labels"))
    return quality.classify(docs, model).select("doc_id", quality.held_out(F.col("doc_id")).alias("held_out"),
                                                "score", "predicted")


def op7_secret_network(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = secrets.find(table(spark, sf_dir, "documents").select("doc_id", "text"))

    def listed(which):
        return F.concat_ws(",", F.transform(F.filter("findings", which), lambda f: F.concat_ws(
            ":", f["kind"], f["start"].cast("string"), f["end"].cast("string"))))

    def count(kind: str):
        return F.size(F.filter("findings", lambda f: f["kind"] == kind)).cast("long").alias(f"n_{kind}")

    return found.select("doc_id", count("assign"), count("access"), count("hex"),
                        F.sha2(listed(lambda f: f["kind"] != "network").cast("binary"), 256).alias("base_sha256"),
                        listed(lambda f: F.lit(True)).alias("spans"))


def op8_bpe_lexicon(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = public_tokenizers.path(TOKENIZER)
    docs = bpe.encode(table(spark, sf_dir, "documents").select("doc_id", "text"), path, decoded="decoded")
    return docs.select(
        "doc_id", F.size("ids").cast("long").alias("n_tokens"),
        F.sha2(F.concat_ws(",", F.col("ids").cast("array<string>")).cast("binary"), 256).alias("ids_sha256"),
        F.sha2(F.col("decoded").cast("binary"), 256).alias("decoded_sha256"))


def op9_repeats(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = repeats.remove(table(spark, sf_dir, "documents"))
    return found.select("doc_id", "n_bytes",
                        (F.col("n_bytes") - F.length("kept")).cast("long").alias("n_removed"),
                        F.size("removed").cast("long").alias("n_spans"), F.sha2("kept", 256).alias("kept_sha256"))


def op10_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = workspace(spark, "warc")
    manifest = warc.write(table(spark, sf_dir, "pages"), out)
    # the archives are read once; their records without payloads are small
    captures = warc.assemble(saved(warc.records(spark, manifest, out, payloads=False), "warc-records"))
    target = captures.where("record_type = 'response'").select(F.col("record_id").alias("refers_to"),
                                                               F.col("page_id").alias("target"))
    return captures.join(target, "refers_to", "left").select(
        "page_id", "payload_bytes", "payload_digest", "record_type", F.col("target").alias("refers_to"))


def op11_hard_negatives(spark: SparkSession, sf_dir: str) -> DataFrame:
    vectors = table(spark, sf_dir, "embeddings")
    moved = F.when(F.col("vec_id") % 7 == 0, (F.col("label") + 1) % 10).otherwise(F.col("label"))
    points = hard_negatives.quantised(vectors.withColumn("label", moved))
    return hard_negatives.mine(points, F.col("id") % 50 == 0)


def op12_exact_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = exact_dedup.classes(table(spark, sf_dir, "documents"))
    return found.select(F.col("doc").alias("doc_id"), F.col("keep").alias("keep_id"), "group_size", "kept", "text_sha256")


def op13_lexical_search(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = lexical.search(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))
    return found.select("item_id", "rank", "doc_id", "score")


QUERIES = {
    "op1_line_dedup": op1_line_dedup,
    "op2_jaccard_join": op2_jaccard_join,
    "op3_token_files": op3_token_files,
    "op4_embedding_forest": op4_embedding_forest,
    "op5_decontaminate": op5_decontaminate,
    "op6_quality_rules": op6_quality_rules,
    "op7_secret_network": op7_secret_network,
    "op8_bpe_lexicon": op8_bpe_lexicon,
    "op9_repeats": op9_repeats,
    "op10_warc": op10_warc,
    "op11_hard_negatives": op11_hard_negatives,
    "op12_exact_dedup": op12_exact_dedup,
    "op13_lexical_search": op13_lexical_search,
}
