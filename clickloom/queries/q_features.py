"""Feature-layer queries."""

from __future__ import annotations

import uuid

from pyspark.sql import functions as F

from clickloom.functions.columns import rnd
from clickloom.operators import features as Fe
from clickloom.operators import interactions as I
from clickloom.queries import register
from clickloom.queries.common import TEST_START, features
from clickloom.queries.sql_base import FEATURES, scaled, with_
from clickloom.session import scratch_path
from clickloom.sources import files as Fl


@register("item_features", with_(FEATURES) + "\nSELECT * FROM item_feats")
def q_items(spark, sf):
    return features(spark, sf).items


@register("user_features", with_(FEATURES) + "\nSELECT * FROM user_feats")
def q_users(spark, sf):
    return features(spark, sf).users


def by_user(spark, df, buckets=4):
    """``df`` as a table dealt and sorted by user."""
    name = f"clickloom_{uuid.uuid4().hex}"
    Fl.save_bucketed(df, name, "user_id", buckets, path=scratch_path(spark, name))
    return spark.table(name)


# The same over events that are stored by user: no exchange on the user side (tests/test_bucketed.py).
@register("user_features_bucketed", with_(FEATURES) + "\nSELECT * FROM user_feats")
def q_users_bucketed(spark, sf):
    f = features(spark, sf)
    return Fe.user_features(by_user(spark, f.train), f.items)


@register("interactions_bucketed", with_(FEATURES) + """
SELECT i.*, u.total_events, u.n_sessions FROM inter_train i JOIN user_feats u USING (user_id)""")
def q_inter_bucketed(spark, sf):
    f = features(spark, sf)
    return I.interactions(by_user(spark, f.train)).join(by_user(spark, f.users).select("user_id", "total_events", "n_sessions"), "user_id")


@register("item_vocab", with_(FEATURES) + "\nSELECT * FROM item_vocab")
def q_item_vocab(spark, sf):
    return features(spark, sf).item_vocab


@register("user_vocab", with_(FEATURES) + "\nSELECT * FROM user_vocab")
def q_user_vocab(spark, sf):
    return features(spark, sf).user_vocab


@register("brand_vocab", with_(FEATURES) + "\nSELECT k AS brand, idx FROM v_brand")
def q_brand_vocab(spark, sf):
    return features(spark, sf).vocabs["brand"]


@register("category_vocabs", with_(FEATURES) + """
SELECT 'cat_l1' AS vocab, k AS value, idx FROM v_cat_l1 UNION ALL
SELECT 'cat_l2' AS vocab, k AS value, idx FROM v_cat_l2 UNION ALL
SELECT 'top_category' AS vocab, k AS value, idx FROM v_top""")
def q_cat_vocabs(spark, sf):
    f = features(spark, sf)
    parts = [f.vocabs["cat_l1"].select(F.lit("cat_l1").alias("vocab"), F.col("cat_l1").alias("value"), "idx"),
             f.vocabs["cat_l2"].select(F.lit("cat_l2").alias("vocab"), F.col("cat_l2").alias("value"), "idx"),
             f.top_vocab.select(F.lit("top_category").alias("vocab"), F.col("top_category").alias("value"), "idx")]
    return parts[0].unionByName(parts[1]).unionByName(parts[2])


@register("items_encoded", with_(FEATURES) + "\nSELECT * FROM items_enc")
def q_items_enc(spark, sf):
    return features(spark, sf).items_enc


@register("users_encoded", with_(FEATURES) + "\nSELECT * FROM users_enc")
def q_users_enc(spark, sf):
    return features(spark, sf).users_enc


@register("train_pairs", with_(FEATURES) + "\nSELECT * FROM pairs")
def q_pairs(spark, sf):
    return features(spark, sf).pairs


@register("train_pairs_dropped", with_(FEATURES) + """
SELECT n_before, n_after, n_before - n_after AS n_dropped
FROM (SELECT count(*) AS n_before FROM inter_train) CROSS JOIN (SELECT count(*) AS n_after FROM pairs)""")
def q_pairs_dropped(spark, sf):
    f = features(spark, sf)
    return Fe.dropped_pairs(f.inter, f.user_vocab, f.item_vocab)


@register("user_cyclic_dow", with_(FEATURES) + """
SELECT user_id, user_idx, preferred_dow, round(sin(preferred_dow * 2 * pi() / 7), 6) AS dow_sin,
       round(cos(preferred_dow * 2 * pi() / 7), 6) AS dow_cos FROM users_enc""")
def q_cyclic(spark, sf):
    out = Fe.cyclic_day_features(features(spark, sf).users_enc)
    return out.select("user_id", "user_idx", "preferred_dow", rnd("dow_sin", 6).alias("dow_sin"),
                      rnd("dow_cos", 6).alias("dow_cos"))


AUG_CTES = (""",
m0 AS (SELECT e.product_id, e.item_idx, e.cat_l2_idx, greatest(coalesce(f.avg_price, 0.0), 0.0) AS avg_price
       FROM items_enc e LEFT JOIN item_feats f USING (product_id)),
m1 AS (SELECT *, avg(avg_price) OVER (PARTITION BY cat_l2_idx) AS cm FROM m0),
fs AS (SELECT product_id, min(first_interaction) AS fs FROM inter_train GROUP BY product_id),
m2 AS (SELECT m1.*, (avg_price - cm) / CASE WHEN cm = 0 THEN 1 ELSE cm END AS rel,
              coalesce(ln(1 + greatest((epoch(TIMESTAMP '2024-01-26') - floor(epoch(fs.fs))) / 86400.0, 0.0)), 0.0) AS rec
       FROM m1 LEFT JOIN fs USING (product_id)),
aug AS (SELECT product_id, """ + scaled("rel", "price_relative_to_cat_avg_scaled") + ", " +
          scaled("rec", "product_recency_log_scaled") + """ FROM m2)""")


@register("items_augmented", with_(FEATURES) + AUG_CTES + """
SELECT e.*, a.price_relative_to_cat_avg_scaled, a.product_recency_log_scaled
FROM items_enc e JOIN aug a USING (product_id)""")
def q_aug(spark, sf):
    f = features(spark, sf)
    cutoff = F.lit(TEST_START.strftime("%Y-%m-%d %H:%M:%S")).cast("timestamp_ntz")
    return Fe.augment_items(f.items_enc, f.items, f.inter, cutoff)


@register("log_sampling_frequency", with_(FEATURES) + """,
c AS (SELECT item_idx, count(*) AS c FROM pairs GROUP BY item_idx)
SELECT e.item_idx, round(CASE WHEN c.c IS NULL THEN ln(1.0 / (SELECT max(item_idx) + 1 FROM items_enc))
                        ELSE ln(c.c / (SELECT count(*) FROM pairs)) END, 6) AS log_q
FROM items_enc e LEFT JOIN c USING (item_idx)""")
def q_logq(spark, sf):
    f = features(spark, sf)
    out = Fe.log_sampling_frequency(f.pairs, f.items_enc)
    return out.select("item_idx", rnd("log_q", 6).alias("log_q"))


@register("log_sampling_frequency_high_intent", with_(FEATURES) + """,
hp AS (SELECT * FROM pairs WHERE confidence_score >= 2),
c AS (SELECT item_idx, count(*) AS c FROM hp GROUP BY item_idx)
SELECT e.item_idx, round(CASE WHEN c.c IS NULL THEN ln(1.0 / (SELECT max(item_idx) + 1 FROM items_enc))
                        ELSE ln(c.c / (SELECT count(*) FROM hp)) END, 6) AS log_q
FROM items_enc e LEFT JOIN c USING (item_idx)""")
def q_logq_hi(spark, sf):
    f = features(spark, sf)
    out = Fe.log_sampling_frequency(I.high_intent(f.pairs), f.items_enc)
    return out.select("item_idx", rnd("log_q", 6).alias("log_q"))
