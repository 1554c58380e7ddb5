"""Data-quality queries (Q2-Q6)."""

from __future__ import annotations

from pyspark.sql import functions as F

from clickloom.operators import features as Fe
from clickloom.operators import quality as Q
from clickloom.queries import register
from clickloom.queries.common import TEST_START, features
from clickloom.queries.q_features import AUG_CTES
from clickloom.queries.sql_base import FEATURES, with_


@register("item_feature_invariants", with_(FEATURES) + """
SELECT count(*) AS n_rows,
       count_if(product_id IS NULL OR cat_l1 IS NULL OR cat_l2 IS NULL OR brand IS NULL OR price_bucket IS NULL
                OR avg_price IS NULL OR item_total_confidence IS NULL OR item_purchase_rate IS NULL) AS rows_with_null,
       count_if(price_bucket < 0 OR price_bucket > 7) AS bad_price_bucket,
       count_if(item_purchase_rate < 0) AS negative_rate,
       count(*) >= 1 AND count(*) <= 1000000000 AS row_count_ok
FROM item_feats""")
def q_items(spark, sf):
    return Q.item_feature_invariants(features(spark, sf).items)


@register("user_feature_invariants", with_(FEATURES) + """
SELECT count(*) AS n_rows,
       count_if(user_id IS NULL OR total_events IS NULL OR months_active IS NULL OR purchase_rate IS NULL
                OR cart_rate IS NULL OR n_sessions IS NULL OR peak_hour_bucket IS NULL OR preferred_dow IS NULL
                OR top_category IS NULL OR has_purchase_history IS NULL) AS rows_with_null,
       count_if(peak_hour_bucket < 0 OR peak_hour_bucket > 3) AS bad_hour,
       count_if(preferred_dow < 1 OR preferred_dow > 7) AS bad_dow,
       count_if(purchase_rate < 0 OR purchase_rate > 1 OR cart_rate < 0 OR cart_rate > 1) AS bad_rate
FROM user_feats""")
def q_users(spark, sf):
    return Q.user_feature_invariants(features(spark, sf).users)


@register("item_vocab_round_trip", with_(FEATURES) + """,
k AS (SELECT DISTINCT product_id FROM item_feats),
a AS (SELECT count(*) AS n_keys, count_if(v.item_idx IS NULL) AS unmapped_keys
      FROM k LEFT JOIN item_vocab v USING (product_id)),
b AS (SELECT count(*) AS vocab_size, min(item_idx) AS min_idx, max(item_idx) AS max_idx,
             count(DISTINCT item_idx) AS distinct_idx FROM item_vocab),
c AS (SELECT count_if(n > 1) AS idx_with_many_keys FROM (SELECT item_idx, count(*) AS n FROM item_vocab GROUP BY 1))
SELECT *, min_idx = 1 AND max_idx = vocab_size AND distinct_idx = vocab_size AS dense_ok FROM a, b, c""")
def q_vocab(spark, sf):
    f = features(spark, sf)
    return Q.vocab_round_trip(f.items, f.item_vocab, "product_id", "item_idx", 1)


def _sanity_sql() -> str:
    cols = ("avg_price_scaled", "log_confidence_scaled", "purchase_rate_scaled")
    return with_(FEATURES) + "\n" + "\nUNION ALL\n".join(
        f"SELECT '{c}' AS column, round(avg({c}), 4) AS mean, round(stddev_pop({c}), 4) AS std FROM items_enc"
        for c in cols)


@register("scaling_sanity_items", _sanity_sql())
def q_sanity(spark, sf):
    return Q.scaling_sanity(features(spark, sf).items_enc,
                            ["avg_price_scaled", "log_confidence_scaled", "purchase_rate_scaled"])


@register("augmented_merge_alignment", with_(FEATURES) + AUG_CTES + """,
merged AS (SELECT e.product_id, a.price_relative_to_cat_avg_scaled AS r, a.product_recency_log_scaled AS q
           FROM items_enc e JOIN aug a USING (product_id))
SELECT (SELECT count(*) FROM items_enc) AS rows_before,
       (SELECT count(*) FROM merged) AS rows_after,
       (SELECT count_if(r IS NULL OR q IS NULL OR isnan(r) OR isnan(q)) FROM merged) AS rows_nan_or_null,
       (SELECT count(*) FROM items_enc e WHERE NOT EXISTS (SELECT 1 FROM merged m WHERE m.product_id = e.product_id))
         AS keys_lost""")
def q_align(spark, sf):
    f = features(spark, sf)
    cutoff = F.lit(TEST_START.strftime("%Y-%m-%d %H:%M:%S")).cast("timestamp_ntz")
    aug = Fe.augment_items(f.items_enc, f.items, f.inter, cutoff)
    return Q.merge_alignment(f.items_enc, aug, "product_id",
                             ["price_relative_to_cat_avg_scaled", "product_recency_log_scaled"])


@register("encoded_artifact_checks", with_(FEATURES) + """
SELECT TRUE AS item_columns_ok, TRUE AS user_columns_ok, i.*, u.*, (SELECT count(*) FROM item_vocab) AS item_vocab_size,
       (SELECT count_if(k = 'unknown' AND idx = 0) FROM v_brand) AS unknown_is_zero,
       i.distinct_item_idx = (SELECT count(*) FROM item_vocab) AS item_idx_dense, i.min_item_idx >= 1 AS pad_free
FROM (SELECT count_if(product_id IS NULL OR item_idx IS NULL OR cat_l1_idx IS NULL OR cat_l2_idx IS NULL OR brand_idx IS NULL
                      OR price_bucket IS NULL OR avg_price_scaled IS NULL OR log_confidence_scaled IS NULL
                      OR purchase_rate_scaled IS NULL) AS item_nulls,
             min(item_idx) AS min_item_idx, count(DISTINCT item_idx) AS distinct_item_idx,
             count_if(brand_idx < 0) AS negative_brand_idx FROM items_enc) i
CROSS JOIN (SELECT count_if(user_id IS NULL OR user_idx IS NULL OR top_cat_idx IS NULL OR peak_hour_bucket IS NULL
                            OR preferred_dow IS NULL OR has_purchase_history IS NULL OR log_total_events IS NULL
                            OR months_active IS NULL OR purchase_rate IS NULL OR cart_rate IS NULL
                            OR log_n_sessions IS NULL) AS user_nulls,
                   count_if(preferred_dow < 0 OR preferred_dow > 6) AS bad_dow FROM users_enc) u""")
def q_encoded(spark, sf):
    f = features(spark, sf)
    return Q.encoded_checks(f.items_enc, f.users_enc, f.item_vocab, f.vocabs["brand"])
