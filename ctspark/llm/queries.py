"""The registered queries of the corpus operators: thin forms over whole tables."""

from __future__ import annotations

import hashlib

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from . import byte_bpe, compression_bands, compression_classifier, credential_links, dc3_dedup, heap_centroids, impact_topk, jaccard_join, kd_sharding, merkle_manifest, nb_toxicity, pii_bootstrap, ss_packing
from .common import prepare, table
from .labelled import fold
from .oracles import ORACLE_SQL  # noqa: F401


def op1_byte_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    prepare(spark)
    vocabulary = public_tokenizers.path("byte_bpe_multi_50k.tiktoken")
    ids = byte_bpe.encode(table(spark, sf_dir, "documents"), vocabulary, public_tokenizers.PATTERN)
    out = byte_bpe.decode(ids, vocabulary)
    return out.select("doc_id", "n_tokens", F.sha2("ids", 256).alias("ids_sha256"), F.sha2("decoded", 256).alias("decoded_sha256"))


def op2_compression_bands(spark: SparkSession, sf_dir: str) -> DataFrame:
    prepare(spark)
    out = compression_bands.measure(table(spark, sf_dir, "documents"))
    return out.select("doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "kept")


def op3_pii_bootstrap(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = pii_bootstrap.find(table(spark, sf_dir, "documents"))
    return pii_bootstrap.digests(out)


def op4_ss_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    prepare(spark)
    return ss_packing.pack(table(spark, sf_dir, "documents"), public_tokenizers.path("word_bpe_49k.json"))


def _held_out(scores: DataFrame, limit: float) -> DataFrame:
    return scores.select("doc_id", (fold() == 1).alias("held_out"), "score", (F.col("score") >= limit).cast("int").alias("predicted"))


def op5_compression_classifier(spark: SparkSession, sf_dir: str) -> DataFrame:
    prepare(spark)
    docs = table(spark, sf_dir, "documents")
    return _held_out(compression_classifier.score(docs, compression_classifier.train(docs, table(spark, sf_dir, "labels"))), 0.5)


def op6_dc3_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    prepare(spark)
    out = dc3_dedup.remove_repeats(table(spark, sf_dir, "documents"))
    return out.select("doc_id", "n_bytes", "n_removed", "n_spans", "kept_sha256")


def op7_jaccard_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    prepare(spark)
    return jaccard_join.link_components(table(spark, sf_dir, "documents"))


def op8_kd_sharding(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    out = kd_sharding.shard(docs, 16, with_text_crc=True)
    return out.select("doc_id", "size", "text_crc32", F.lit("bytes").alias("law"), "shard", "slot", F.lit(None).cast("int").alias("grown_shard"))


def op9_impact_topk(spark: SparkSession, sf_dir: str) -> DataFrame:
    prepare(spark)
    usable = table(spark, sf_dir, "embeddings").where(
        F.col("embedding").isNotNull() & ~F.exists("embedding", lambda x: x.isNull() | F.isnan(x) | (F.abs(x) == float("inf")))
    )
    vectors = usable.select("vec_id", F.transform("embedding", lambda x: F.floor(x.cast("double") * 64)).alias("vec"))
    return impact_topk.top_k(vectors, vectors.where("vec_id % 20 = 0"), 20)


def op10_nb_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    prepare(spark)
    docs = table(spark, sf_dir, "documents")
    return _held_out(nb_toxicity.score(docs, nb_toxicity.train(docs, table(spark, sf_dir, "labels"))), 0.7)


def op11_merkle_intervals(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    fields = ["doc_id", "source", "lang", "n_chars", "text"]
    tampered = F.crc32(F.col("doc_id").cast("string").cast("binary")) % 5 == 0
    given = merkle_manifest.leaf([F.col(c) if c != "text" else merkle_manifest.lowered(F.col(c)) for c in fields])
    keep = {"given": F.when(tampered, given)}
    manifest = merkle_manifest.build(docs, fields, keep=keep)
    found = merkle_manifest.proofs(manifest)
    own = F.coalesce("kept_given", "digest")
    out = found.select(
        F.col("order").alias("doc_id"),
        F.col("digest").alias("leaf"),
        "subroot",
        F.lit(manifest.root).cast("string").alias("root"),
        merkle_manifest.proof_digest(F.col("path")).alias("proof_sha256"),
        merkle_manifest.folded(own, F.col("path")).alias("folded_root"),
    )
    return out.withColumn("verified", F.col("folded_root") == F.col("root"))


def op12_heap_centroids(spark: SparkSession, sf_dir: str) -> DataFrame:
    prepare(spark)
    usable = table(spark, sf_dir, "embeddings").where(
        (F.size("embedding") == 64) & ~F.exists("embedding", lambda x: x.isNull() | F.isnan(x) | (F.abs(x) == float("inf")))
    )
    vectors = usable.select("vec_id", F.transform("embedding", lambda x: F.floor(x.cast("double") * 256)).alias("vec"))
    starts = vectors.where("vec_id is not null").orderBy(F.sha2(F.concat(F.lit("2:"), F.col("vec_id").cast("string")).cast("binary"), 256), "vec").limit(40)
    found = heap_centroids.cluster(vectors, starts, 64, 5)
    # one row a centroid, 40 at most
    sums = {r["cluster"]: r["s"] for r in found.rows.groupBy("cluster").agg(F.sum("distance").alias("s")).collect()}
    hashes = [hashlib.sha256(",".join(map(str, c)).encode()).hexdigest() for c in found.centroids]
    centres = spark.createDataFrame([(c, sums.get(c, 0), sum(sums.values()), h) for c, h in enumerate(hashes)], "cluster int, cluster_inertia long, inertia long, centroid_sha256 string")
    out = found.rows.join(F.broadcast(centres), "cluster")
    return out.select(F.col("id").alias("vec_id"), "cluster", "distance", "cluster_inertia", "inertia", "centroid_sha256")


def op13_credential_links(spark: SparkSession, sf_dir: str) -> DataFrame:
    prepare(spark)
    return credential_links.digests(credential_links.find(table(spark, sf_dir, "documents")))


QUERIES = {f.__name__: f for f in (op1_byte_bpe, op2_compression_bands, op3_pii_bootstrap, op4_ss_packing, op5_compression_classifier, op6_dc3_dedup, op7_jaccard_join, op8_kd_sharding, op9_impact_topk, op10_nb_toxicity, op11_merkle_intervals, op12_heap_centroids, op13_credential_links)}
