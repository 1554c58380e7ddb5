"""Cleaning queries: F1-F8 and the joins J1/J2 inside them."""

from __future__ import annotations

from pyspark.sql import functions as F

from clickloom.functions.columns import rnd

from clickloom.operators import cleaning as C
from clickloom.queries import register
from clickloom.queries.sql_base import CLEAN, DIRTY, ORDER_EVENTS, clean_sql, kcore_sql, with_
from clickloom.sources.testdata import clickstream, dirty_clickstream, order_interactions

CS_COLS = ("event_time, event_type, product_id, category_id, category_code, brand, price, "
           "user_id, user_session")


def _filled(spark, sf):
    return C.drop_null_session(C.fill_unknown(clickstream(spark, sf)))


@register("clean_fill_nulls", with_(CLEAN) + f"\nSELECT {CS_COLS} FROM cl_fill")
def q_fill(spark, sf):
    return _filled(spark, sf)


@register("exact_dedup", with_(CLEAN) + f"\nSELECT {CS_COLS} FROM cl_exact_flat")
def q_exact(spark, sf):
    return C.exact_dedup(_filled(spark, sf))


@register("near_dedup", with_(CLEAN) + f"\nSELECT {CS_COLS} FROM cl_near")
def q_near(spark, sf):
    return C.near_dedup(C.exact_dedup(_filled(spark, sf)))


@register("price_floor", with_(CLEAN) + f"\nSELECT {CS_COLS} FROM cl_price")
def q_price(spark, sf):
    return C.price_floor(C.near_dedup(C.exact_dedup(_filled(spark, sf))))


# Per-user mean events per active day (the bot statistic) for every user.
@register("user_events_per_day", with_(CLEAN) + """
SELECT user_id, round(avg(n), 6) AS avg_events_per_day, count(*) AS active_days FROM (
  SELECT user_id, CAST(event_time AS DATE) AS d, count(*) AS n FROM cl_price GROUP BY 1, 2)
GROUP BY user_id""")
def q_epd(spark, sf):
    df = C.price_floor(C.near_dedup(C.exact_dedup(_filled(spark, sf))))
    daily = df.groupBy("user_id", F.to_date("event_time").alias("d")).agg(F.count(F.lit(1)).alias("n"))
    return daily.groupBy("user_id").agg(rnd(F.avg("n"), 6).alias("avg_events_per_day"),
                                        F.count(F.lit(1)).alias("active_days"))


# Bot filter with a threshold low enough to bite on the test data (F6 + J2).
@register("drop_bots_threshold2", with_(CLEAN) + f"""
SELECT {CS_COLS} FROM cl_price WHERE user_id NOT IN (
  SELECT user_id FROM (SELECT user_id, avg(n) AS a FROM (
    SELECT user_id, CAST(event_time AS DATE) AS d, count(*) AS n FROM cl_price GROUP BY 1, 2)
  GROUP BY user_id) WHERE a > 2)""")
def q_bots(spark, sf):
    df = C.price_floor(C.near_dedup(C.exact_dedup(_filled(spark, sf))))
    return C.drop_bots(df, threshold=2)


@register("clean_events", with_(CLEAN) + f"\nSELECT {CS_COLS} FROM clean")
def q_clean(spark, sf):
    return C.clean_events(clickstream(spark, sf))


@register("kcore_k3", with_(CLEAN, kcore_sql("clean", 3)) + f"\nSELECT {CS_COLS} FROM kc10")
def q_kcore3(spark, sf):
    return C.kcore(C.clean_events(clickstream(spark, sf)), k=3)


# Needs three rounds before it is stable.
@register("kcore_k34", with_(CLEAN, kcore_sql("clean", 34)) + f"\nSELECT {CS_COLS} FROM kc10")
def q_kcore34(spark, sf):
    return C.kcore(C.clean_events(clickstream(spark, sf)), k=34)


# Shrinks for five rounds, then empties the table.
@register("kcore_k36_empties", with_(CLEAN, kcore_sql("clean", 36)) + f"\nSELECT {CS_COLS} FROM kc10")
def q_kcore36(spark, sf):
    return C.kcore(C.clean_events(clickstream(spark, sf)), k=36)


ORDER_ROWS = "user_id, product_id, event_type, l_orderkey, l_linenumber"


# Customers and parts: stable after a few rounds, and still shrinking when the tenth ends it.
@register("kcore_orders_k20", with_(ORDER_EVENTS, kcore_sql("oi", 20)) + f"\nSELECT {ORDER_ROWS} FROM kc10")
def q_kcore_orders(spark, sf):
    return C.kcore(order_interactions(spark, sf), k=20).select(*ORDER_ROWS.split(", "))


@register("kcore_orders_k24_cut", with_(ORDER_EVENTS, kcore_sql("oi", 24)) + f"\nSELECT {ORDER_ROWS} FROM kc10")
def q_kcore_orders_cut(spark, sf):
    return C.kcore(order_interactions(spark, sf), k=24, pairs_a_bucket=8192).select(*ORDER_ROWS.split(", "))


def _report_sql(k: int, rounds: int) -> str:
    sel = []
    for i in range(rounds + 1):
        label = "raw" if i == 0 else f"r{i}"
        sel.append(f"SELECT {i} AS step, '{label}' AS stage, count(*) AS n_rows, "
                   f"count(DISTINCT user_id) AS n_users, count(DISTINCT product_id) AS n_items "
                   f"FROM rp{i}")
    return (with_(CLEAN, kcore_sql("clean", k, rounds, prefix="rp")) + "\n" +
            "\nUNION ALL\n".join(sel))


@register("kcore_fixed_rounds_report", _report_sql(45, 3))
def q_kcore_report(spark, sf):
    return C.kcore_fixed_rounds_report(C.clean_events(clickstream(spark, sf)), k=45, rounds=3)


# The same steps where each has something to do: nulls, duplicates, near
# duplicates, cheap rows, a bot, types nobody knows.
DIRTY_CLEAN = with_(DIRTY, clean_sql("dirty"))


def _dirty(spark, sf):
    return C.drop_null_session(C.fill_unknown(dirty_clickstream(spark, sf)))


@register("dirty_events", with_(DIRTY) + f"\nSELECT {CS_COLS} FROM dirty")
def q_dirty(spark, sf):
    return dirty_clickstream(spark, sf)


@register("dirty_fill_and_drop_nulls", DIRTY_CLEAN + f"\nSELECT {CS_COLS} FROM cl_fill")
def q_dirty_fill(spark, sf):
    return _dirty(spark, sf)


@register("dirty_exact_dedup", DIRTY_CLEAN + f"\nSELECT {CS_COLS} FROM cl_exact_flat")
def q_dirty_exact(spark, sf):
    return C.exact_dedup(_dirty(spark, sf))


@register("dirty_near_dedup", DIRTY_CLEAN + f"\nSELECT {CS_COLS} FROM cl_near")
def q_dirty_near(spark, sf):
    return C.near_dedup(C.exact_dedup(_dirty(spark, sf)))


@register("dirty_price_floor", DIRTY_CLEAN + f"\nSELECT {CS_COLS} FROM cl_price")
def q_dirty_price(spark, sf):
    return C.price_floor(C.near_dedup(C.exact_dedup(_dirty(spark, sf))))


# 60 events a day and more is a bot here: the repeating user goes, the others stay.
@register("dirty_clean_events", with_(DIRTY, clean_sql("dirty", bots=60)) + f"\nSELECT {CS_COLS} FROM clean")
def q_dirty_clean(spark, sf):
    return C.drop_bots(C.price_floor(C.near_dedup(C.exact_dedup(_dirty(spark, sf)))), threshold=60)


_STEPS = (("dirty", "dirty"), ("filled", "cl_fill"), ("exact", "cl_exact_flat"), ("near", "cl_near"), ("price", "cl_price"), ("bots", "clean"))


# Every step removes rows.
@register("dirty_step_counts", with_(DIRTY, clean_sql("dirty", bots=60)) + "\n" + "\nUNION ALL\n".join(
    f"SELECT '{n}' AS step, count(*) AS n_rows FROM {t}" for n, t in _STEPS))
def q_dirty_counts(spark, sf):
    raw = dirty_clickstream(spark, sf)
    filled = C.drop_null_session(C.fill_unknown(raw))
    exact = C.exact_dedup(filled)
    near = C.near_dedup(exact)
    price = C.price_floor(near)
    frames = (raw, filled, exact, near, price, C.drop_bots(price, threshold=60))
    out = None
    for (name, _), df in zip(_STEPS, frames, strict=True):
        one = df.agg(F.count(F.lit(1)).alias("n_rows")).select(F.lit(name).alias("step"), "n_rows")
        out = one if out is None else out.unionByName(one)
    return out
