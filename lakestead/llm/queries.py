"""The registered query of each operator, with production parameters over whole tables."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from lakestead.llm import (
    centroids,
    exact_dedup,
    language_id,
    line_dedup,
    merkle,
    mixing,
    near_dedup,
    packing,
    quality_cnn,
    quality_rules,
    sentencepieces,
    substring_dedup,
    warc,
)
from lakestead.llm.common import table, tune
from lakestead.session import scratch_dir

#: The tree of the corpus: sources by their number into four domains, then language, then source.
MIX = mixing.Mix(
    weights=({"d0": 4, "d1": 3, "d2": 2, "d3": 1}, {"en": 4, "de": 2, "fr": 2, "es": 2}, {}),
    percent=60,
    max_epochs=2,
    seed="mix-1",
)
DOMAIN_SQL = "'d' || (CAST(nullif(regexp_extract(source, '([0-9]+)$', 1), '') AS BIGINT) % 4)"


def documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(tune(spark), sf_dir, "documents").select("doc_id", "text")


def trusted_ids(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The documents that the labels call good."""
    return table(spark, sf_dir, "labels").filter("quality = 1").select("doc_id")


def tree() -> dict[str, Column]:
    number = F.expr("try_cast(nullif(regexp_extract(source, '([0-9]+)$', 1), '') as bigint) % 4")
    return {"domain": F.concat(F.lit("d"), number.cast("string")), "lang": F.col("lang"), "source": F.col("source")}


def _fold(parts: int, out: int) -> Column:
    """Whether a row is held out: by the CRC of its id; rows without an id are."""
    return F.coalesce(F.crc32(F.col("doc_id").cast("string")) % parts == out, F.lit(True))


def op1_quality_cnn(spark: SparkSession, sf_dir: str) -> DataFrame:
    labels = table(tune(spark), sf_dir, "labels").filter(~_fold(5, 0))
    scored = quality_cnn.classify(documents(spark, sf_dir), labels)
    return scored.select(
        "doc_id", _fold(5, 0).alias("held_out"), "score", (F.col("score") >= 0.3).cast("int").alias("predicted")
    )


def op2_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    done = line_dedup.line_dedup(documents(spark, sf_dir))
    return done.select("doc_id", "n_lines", "n_dropped", F.sha2("text", 256).alias("kept_sha256"))


def op3_exact_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = exact_dedup.exact_dedup(documents(spark, sf_dir))
    return found.withColumn("text_sha256", F.lower(F.hex("sha"))).drop("sha")


def op4_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packing.best_fit_packing(documents(spark, sf_dir))


def op5_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_dedup.near_dedup(documents(spark, sf_dir), near=near_dedup.Near(percent=85))


def op6_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    judged = quality_rules.quality_rules(documents(spark, sf_dir), trusted_ids(spark, sf_dir))
    first = ["n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "kept"]
    return judged.select("doc_id", *first, "score")


def op7_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(tune(spark), sf_dir, "documents").select("doc_id", "text", "lang", "source")
    taken = mixing.mix_sources(docs, tree(), MIX)
    return taken.select("doc_id", tree()["domain"].alias("domain"), "lang", "source", "n_tokens", "epoch")


def op8_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = scratch_dir(spark, "llm/archives")
    warc.write_archives(table(tune(spark), sf_dir, "pages"), path)
    return warc.read_records(spark, path)


def op9_substring_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return substring_dedup.substring_dedup(documents(spark, sf_dir)).drop("kept_text")


def op10_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(tune(spark), sf_dir, "documents")
    found = language_id.identify(docs, docs.filter(~_fold(4, 2)).select("doc_id", "text", "lang"))
    return found.select("doc_id", _fold(4, 2).alias("held_out"), F.col("lang").alias("lang_pred"), "score", "accepted")


def op11_merkle_manifest(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(tune(spark), sf_dir, "documents")
    hit = F.crc32(F.col("doc_id").cast("string")) % 7 == 0
    changed = F.when(hit, F.col("n_chars") + 1).otherwise(F.col("n_chars"))
    made = merkle.manifest(docs, ["doc_id", "source", "lang", "n_chars", "text"], tampered={"n_chars": changed})
    checked = made.withColumn("folded", merkle.folded(F.coalesce("claimed", "leaf")))
    hexed = [merkle.as_text(F.col(c)).alias(c) for c in ("leaf", "subroot", "root")]
    return checked.select(
        "doc_id",
        *hexed,
        F.sha2(merkle.as_text(F.col("path")), 256).alias("proof_sha256"),
        merkle.as_text(F.col("folded")).alias("folded_root"),
        (F.col("folded") == F.col("root")).alias("verified"),
    )


def op12_sentencepiece(spark: SparkSession, sf_dir: str, model_path: str | None = None) -> DataFrame:
    if model_path is None:
        import public_tokenizers

        model_path = public_tokenizers.path("piece_bpe_32k.model")
    encoded = sentencepieces.encode(documents(spark, sf_dir), model_path, decoded=True)
    return encoded.select(
        "doc_id",
        F.size("ids").cast("long").alias("n_tokens"),
        F.sha2(F.array_join(F.col("ids").cast("array<string>"), ","), 256).alias("ids_sha256"),
        F.sha2("decoded", 256).alias("decoded_sha256"),
    )


def op13_centroid_clustering(spark: SparkSession, sf_dir: str) -> DataFrame:
    placed, found = centroids.cluster(table(tune(spark), sf_dir, "embeddings"))
    return centroids.with_inertia(placed, found)


QUERIES = {
    "op1_quality_cnn": op1_quality_cnn,
    "op2_line_dedup": op2_line_dedup,
    "op3_exact_dedup": op3_exact_dedup,
    "op4_packing": op4_packing,
    "op5_near_dedup": op5_near_dedup,
    "op6_quality_rules": op6_quality_rules,
    "op7_mixing": op7_mixing,
    "op8_warc": op8_warc,
    "op9_substring_dedup": op9_substring_dedup,
    "op10_language_id": op10_language_id,
    "op11_merkle_manifest": op11_merkle_manifest,
    "op12_sentencepiece": op12_sentencepiece,
    "op13_centroid_clustering": op13_centroid_clustering,
}

ORACLE = {
    "op2_line_dedup": line_dedup.ORACLE_SQL,
    "op3_exact_dedup": exact_dedup.ORACLE_SQL,
    "op5_near_dedup": near_dedup.ORACLE_SQL,
    "op7_mixing": mixing.oracle_sql(MIX, DOMAIN_SQL),
    "op8_warc": warc.ORACLE_SQL,
    "op9_substring_dedup": substring_dedup.ORACLE_SQL,
    "op11_merkle_manifest": merkle.ORACLE_SQL,
    "op13_centroid_clustering": centroids.oracle_sql(),
}
