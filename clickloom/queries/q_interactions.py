"""Interaction queries: A1, A2, W7, M17, M19."""

from __future__ import annotations

from pyspark.sql import functions as F

from clickloom.functions.columns import rnd

from clickloom.operators import cleaning as C
from clickloom.operators import interactions as I
from clickloom.queries import register
from clickloom.queries.sql_base import CLEAN, CLICKSTREAM, INTERACTIONS_OF, with_
from clickloom.sources.testdata import clickstream

INTER = CLEAN + ",\ninter AS (" + INTERACTIONS_OF.format(src="clean") + ")"


def clean_interactions(spark, sf):
    return I.interactions(C.clean_events(clickstream(spark, sf)))


@register("interactions", with_(INTER) + "\nSELECT * FROM inter")
def q_inter(spark, sf):
    return clean_interactions(spark, sf)


@register("interaction_quality", with_(INTER) + """
SELECT total_pairs, unique_users, unique_items, round(avg_score, 6) AS avg_score, max_score,
       round((1.0 - total_pairs / (unique_users * unique_items)) * 100, 6) AS sparsity_pct,
       round(score_eq_1 * 100.0 / total_pairs, 6) AS pct_score_1,
       round(score_eq_2 * 100.0 / total_pairs, 6) AS pct_score_2,
       round(score_ge_4 * 100.0 / total_pairs, 6) AS pct_score_ge4,
       (1.0 - total_pairs / (unique_users * unique_items)) * 100 > 99 AS sparsity_gate_pass
FROM (SELECT count(*) AS total_pairs, count(DISTINCT user_id) AS unique_users,
             count(DISTINCT product_id) AS unique_items, avg(confidence_score) AS avg_score,
             max(confidence_score) AS max_score, count_if(confidence_score = 1) AS score_eq_1,
             count_if(confidence_score = 2) AS score_eq_2,
             count_if(confidence_score >= 4) AS score_ge_4 FROM inter)""")
def q_quality(spark, sf):
    return I.interaction_quality(clean_interactions(spark, sf))


TOP_ITEMS_SQL = """
SELECT product_id, CAST(sum(confidence_score) AS BIGINT) AS total_confidence,
       count(DISTINCT user_id) AS n_users
FROM inter GROUP BY product_id ORDER BY total_confidence DESC, product_id LIMIT 20"""


@register("top_items", with_(INTER) + TOP_ITEMS_SQL)
def q_top(spark, sf):
    return I.top_items(clean_interactions(spark, sf), k=20)


# Minimum slice (raw adapter events -> interactions -> top items); also the smoke entry.
@register("raw_top_items",
          with_(CLICKSTREAM + ",\ninter AS (" + INTERACTIONS_OF.format(src="clickstream") + ")")
          + TOP_ITEMS_SQL)
def q_raw_top(spark, sf):
    return I.top_items(I.interactions(clickstream(spark, sf)), k=20)


@register("high_intent_pairs", with_(INTER) + "\nSELECT * FROM inter WHERE confidence_score >= 2")
def q_high(spark, sf):
    return I.high_intent(clean_interactions(spark, sf))


@register("normalised_weights_daily_batch", with_(INTER) + """,
b AS (SELECT *, CAST(last_interaction AS DATE) AS batch_id FROM inter)
SELECT user_id, product_id, batch_id,
       round(confidence_score / avg(confidence_score) OVER (PARTITION BY batch_id), 6) AS weight
FROM b""")
def q_weights(spark, sf):
    pairs = clean_interactions(spark, sf).withColumn("batch_id", F.to_date("last_interaction"))
    out = I.normalised_weights(pairs, "batch_id")
    return out.select("user_id", "product_id", "batch_id", rnd("weight", 6).alias("weight"))
