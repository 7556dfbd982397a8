"""The registered queries of this subpackage: each operator over its whole table."""

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from runlens.llm import (
    line_dedup, near_dedup, packing, pieces, quality_classifier, quality_rules, sharding, token_counts,
    token_files, topk, url_filter, variants, whitening,
)
from runlens.sources import staging


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def op1_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    scope = staging.Scope(spark)  # the result reads the spans until the session ends
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    return line_dedup.dedup_lines(docs, scope).select(
        "doc_id", "text", "n_lines", "n_removed_lines", F.size("removed").alias("n_removed_chunks"))


def op2_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = near_dedup.near_duplicates(table(spark, sf_dir, "documents"))
    return found.select("doc_id", F.col("n_shingles").cast("long"), "component_id", "kept")


def op3_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "lang", "text")
    counted = staging.stage(quality_rules.with_counts(docs).drop("text"), "rule-counts")
    cutoffs = quality_rules.fit(counted, table(spark, sf_dir, "labels"))
    judged = quality_rules.judge(counted, cutoffs)
    return judged.select("doc_id", *quality_rules.COUNTS, "base_failed", "kept",
                         F.array_join("rejected_by", ",").alias("rejected_by"))


def op4_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Three batches over all documents, one of them delivered twice: every document is inserted; every
    seventh is revised to another tokenizer's counts; every eleventh is deleted. So the remainders choose
    what happens to a document; none is left out."""
    docs = table(spark, sf_dir, "documents")

    def counted(rows: DataFrame, file: str) -> DataFrame:
        counts = token_counts.count_tokens(rows, public_tokenizers.path(file))
        return staging.stage(counts.withColumn("tokenizer", F.lit(file.partition(".")[0])), "token-counts")

    named = counted(docs, "byte_bpe_50k.json")
    revised = token_counts.revisions(
        named.where("doc_id % 7 = 0"), counted(docs.where("doc_id % 7 = 0"), "piece_bpe_32k.model"))
    rollup = token_counts.Rollup(spark, staging.new_folder(spark, "token-rollup"))
    rollup.commit("load", token_counts.inserts(named))
    rollup.commit("revise", revised)
    rollup.commit("load", token_counts.inserts(named))
    rollup.commit("delete", token_counts.deletes(named.where("doc_id % 11 = 0 and doc_id % 7 <> 0")))
    rollup.compact()
    return rollup.totals()


def packed(docs: DataFrame, scope: staging.Scope) -> DataFrame:
    """The pieces of ``docs`` with their places and the checksum of their ids."""
    pieces_ = scope.stage(packing.token_pieces(docs, public_tokenizers.path("byte_bpe_50k.json")), "pieces")
    found = packing.pack(pieces_.withColumn("ids_crc32", F.crc32("ids")).drop("ids"))  # ids stay in place
    return found.select("doc_id", "piece", "start", F.col("length").cast("long"), "ids_crc32",
                        "sequence_id", "offset")


def op5_best_fit_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packed(table(spark, sf_dir, "documents"), staging.Scope(spark))


def op6_sentencepiece(spark: SparkSession, sf_dir: str) -> DataFrame:
    coded = pieces.round_trip(table(spark, sf_dir, "documents"), public_tokenizers.path("piece_bpe_32k.model"))
    joined = F.array_join(F.col("ids").cast("array<string>"), ",")
    return coded.select("doc_id", F.size("ids").cast("long").alias("n_tokens"),
                        F.sha2(joined.cast("binary"), 256).alias("ids_sha256"),
                        F.sha2(F.col("decoded").cast("binary"), 256).alias("decoded_sha256"))


def op7_url_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    """No table holds outcomes of pages, so each page's outcome is measured on its own html."""
    pages = table(spark, sf_dir, "pages")
    outcomes = pages.select("url", url_filter.junk_page(F.col("html")).alias("bad"))
    return url_filter.judge(pages.select("page_id", "url"), outcomes).select(
        "page_id", "host", "path", "rule", "verdict")


def op8_quality_classifier(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    model = quality_classifier.learn(docs, table(spark, sf_dir, "labels"))
    scored = quality_classifier.with_score(docs, model)
    return scored.select(
        "doc_id", quality_classifier.held_out(F.col("doc_id")).alias("held_out"), "score", "predicted")


def op9_exact_topk(spark: SparkSession, sf_dir: str) -> DataFrame:
    vectors = table(spark, sf_dir, "embeddings")
    return topk.search(vectors, vectors.where("vec_id % 100 = 0"), 10, staging.Scope(spark))


def op10_sharding(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The checksum is taken where the texts are read, so that only numbers are written and moved."""
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    scope = staging.Scope(spark)
    keyed = sharding.with_keys(docs).withColumn(
        "text_crc32", F.crc32(F.coalesce(F.col("text"), F.lit("")).cast("binary"))).drop("text")
    placed = sharding.assign(scope.stage(keyed, "keyed"))
    return placed.select("doc_id", "size", "text_crc32", F.lit("bytes").alias("law"), "shard", "slot",
                         F.lit(None).cast("int").alias("grown_shard"))


def op11_spelling_variants(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    return variants.variants(docs, staging.Scope(spark))


def op12_whitening(spark: SparkSession, sf_dir: str) -> DataFrame:
    vectors = table(spark, sf_dir, "embeddings")
    model = whitening.fit(vectors)
    kind = "vec_id long, component int, n long, deviation long, whitened double, explained double, identity_error double"
    if model is None or not len(model.values):
        return spark.createDataFrame([], kind)
    each = F.posexplode("whitened").alias("at", "whitened")
    rows = whitening.transform(vectors, model).select("vec_id", "deviation", each)
    explained = F.array(*[F.lit(float(e / model.trace)) for e in model.values])
    return rows.select(
        "vec_id", (F.col("at") + 1).alias("component"), F.lit(model.rows).cast("long").alias("n"), "deviation", "whitened",
        F.get(explained, F.col("at")).alias("explained"), F.lit(model.identity_error).alias("identity_error"))


def op13_token_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Written, and read back from the files."""
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    folder = staging.new_folder(spark, "token-files")
    token_files.write(docs, public_tokenizers.path("byte_bpe_50k.json"), 2, folder)
    return token_files.read(spark, folder).select("doc_id", "start", "n_tokens", F.crc32("ids").alias("ids_crc32"))


QUERIES = {
    "op1_line_dedup": op1_line_dedup,
    "op2_near_dedup": op2_near_dedup,
    "op3_quality_rules": op3_quality_rules,
    "op4_token_counts": op4_token_counts,
    "op5_best_fit_packing": op5_best_fit_packing,
    "op6_sentencepiece": op6_sentencepiece,
    "op7_url_filter": op7_url_filter,
    "op8_quality_classifier": op8_quality_classifier,
    "op9_exact_topk": op9_exact_topk,
    "op10_sharding": op10_sharding,
    "op11_spelling_variants": op11_spelling_variants,
    "op12_whitening": op12_whitening,
    "op13_token_files": op13_token_files,
}
