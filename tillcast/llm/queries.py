"""Registered queries: each operator with production parameters on its whole table."""

from pyspark.sql import functions as F

from tillcast.llm import (
    exact_dedup, hard_negatives, html_density, line_quality, mixing, packing, rule_ensemble, simhash, spelling,
    token_counts, toxicity, url_rules, warc,
)
from tillcast.llm.common import table

QUERIES = {}


def query(fn):
    QUERIES[fn.__name__] = fn
    return fn


@query
def op4_exact_dedup(spark, sf_dir):
    return exact_dedup.duplicate_groups(table(spark, sf_dir, "documents"))


@query
def op10_simhash_near_dedup(spark, sf_dir):
    return simhash.near_duplicates(table(spark, sf_dir, "documents"))


@query
def op5_line_quality(spark, sf_dir):
    return line_quality.quality_rules(table(spark, sf_dir, "documents"))


@query
def op7_vector_best_fit(spark, sf_dir):
    return packing.pack_documents(table(spark, sf_dir, "documents"))


@query
def op8_soft_mixing(spark, sf_dir):
    return mixing.mixture(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


@query
def op1_token_counts(spark, sf_dir):
    return token_counts.token_counts(table(spark, sf_dir, "documents"))


@query
def op3_url_rules(spark, sf_dir):
    return url_rules.judge_urls(table(spark, sf_dir, "pages"))


@query
def op9_text_density(spark, sf_dir):
    return html_density.main_text(table(spark, sf_dir, "pages"))


@query
def op6_rule_ensemble(spark, sf_dir):
    return rule_ensemble.quality_scores(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


@query
def op2_noisy_channel_toxicity(spark, sf_dir):
    return toxicity.toxicity_scores(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


@query
def op13_warc_segments(spark, sf_dir):
    index = warc.round_trip(table(spark, sf_dir, "pages"))
    return index.select("page_id", "payload_bytes", "payload_digest", "record_type", "refers_to")


@query
def op11_bloom_spelling(spark, sf_dir):
    return spelling.variants(table(spark, sf_dir, "documents"), spelling.typing_noise)


@query
def op12_four_russians(spark, sf_dir):
    moved = F.when(F.col("vec_id") % 7 == 0, (F.col("label") + 1) % 10).otherwise(F.col("label"))
    vectors = table(spark, sf_dir, "embeddings").select(
        F.col("vec_id").alias("id"), moved.alias("label"), F.col("embedding").alias("vector")
    )
    return hard_negatives.mine(vectors, F.col("id") % 50 == 0)
