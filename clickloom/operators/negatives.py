"""Negative sampling and negative-quality analyses.

A draw is the leading 60 bits of an md5 of (seed, keys, slot, purpose): the
same in every engine, reproducible and independent of partitioning. A draw
picks a position among what is free and the position is then moved past what is
not (the user's positives, earlier draws), so nothing is rejected, every pair
gets its full number of negatives, and no pool is ever enumerated per pair.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from clickloom.functions.columns import attach

from clickloom.operators.ordering import dense_index, lookup_join

N_HARD = 3
WARM_THRESHOLD = 20


def draw(*parts: Column | str | int) -> Column:
    """A reproducible integer below 2**60."""
    text = F.concat_ws(":", *[(p if isinstance(p, Column) else F.lit(str(p))).cast("string") for p in parts])
    return F.conv(F.substring(F.md5(text), 1, 15), 16, 10).cast("long")


def draw_sql(*parts: str) -> str:
    """``draw`` in the oracle's SQL; parts are expressions."""
    return "CAST('0x' || substr(md5(concat_ws(':', " + ", ".join(f"CAST({p} AS VARCHAR)" for p in parts) + ")), 1, 15) AS BIGINT)"


def past(index: Column, taken: Column) -> Column:
    """The ``index``-th (from 0) position that is not in the ascending array ``taken``."""
    return F.aggregate(taken, index, lambda at, t: F.when(t <= at, at + 1).otherwise(at))


def draw_places(free: Column, n: int, *key: Column | str | int) -> Column:
    """``n`` places below ``free``: distinct ones if there are enough, else each
    on its own."""
    def one(places: Column, slot: Column) -> Column:
        d = draw(*key, slot)
        return F.concat(places, F.array(F.when(free >= n, past(F.pmod(d, free - slot), F.array_sort(places))).otherwise(F.pmod(d, free))))

    return F.aggregate(F.sequence(F.lit(0).cast("long"), F.lit(n - 1).cast("long")), F.array().cast("array<long>"), one)


def indexed_pools(items: DataFrame) -> DataFrame:
    """Pools (kind, key) -> items with position ``pos`` 0..n-1 and pool size ``n``:
    ('cat', cat_l2_idx) for known categories and ('bucket', price_bucket) for all."""
    cat = items.filter(F.col("cat_l2_idx") != 0).select(F.lit("cat").alias("kind"),
                                                         F.col("cat_l2_idx").cast("long").alias("key"), "item_idx")
    bucket = items.select(F.lit("bucket").alias("kind"), F.col("price_bucket").cast("long").alias("key"), "item_idx")
    pools = cat.unionByName(bucket)
    g = dense_index(pools, ["kind", "key", "item_idx"], "_g", start=0)
    first = g.groupBy("kind", "key").agg(F.min("_g").alias("_g0"), F.count(F.lit(1)).alias("n"))
    return g.join(first, ["kind", "key"]).select("kind", "key", "item_idx", (F.col("_g") - F.col("_g0")).alias("pos"),
                                                 "n")


def hard_negatives(pairs: DataFrame, items: DataFrame, n_neg: int = N_HARD, warm_threshold: int = WARM_THRESHOLD,
                   seed: int = 42) -> DataFrame:
    """Exactly ``n_neg`` negatives per training pair (user_idx, item_idx).

    * known category, warm user (at least ``warm_threshold`` pairs) whose
      untouched categories hold at least ``n_neg`` items: for each slot a
      category the user never touched, then an item of it;
    * known category otherwise: items of the positive's category that the user
      never interacted with;
    * unknown category: items of the positive's price bucket, likewise;
    * none free there: the whole catalogue but the positive.
    Without replacement when at least ``n_neg`` items are free, else with. A
    catalogue of the positive alone has no negative and gives no row.
    Output: (user_idx, item_idx, slot, neg_item_idx, route).
    """
    it = items.select("item_idx", "cat_l2_idx", "price_bucket")
    p = pairs.select("user_idx", "item_idx")
    pools = indexed_pools(it)
    sizes = pools.select("kind", "key", "n").distinct()

    # what a user touched: a short array of category places and what they hold
    cats = dense_index(pools.filter(F.col("kind") == "cat").select("key"), "key", "place", start=0)
    cats = cats.join(sizes.filter(F.col("kind") == "cat").drop("kind"), "key")
    totals = cats.agg(F.count(F.lit(1)).alias("n_cats"), F.coalesce(F.sum("n"), F.lit(0)).alias("n_known"))
    of_cat = it.filter(F.col("cat_l2_idx") != 0).select("item_idx", F.col("cat_l2_idx").cast("long").alias("key")).join(cats, "key")
    touched = p.join(of_cat, "item_idx").select("user_idx", "place", "n").distinct()
    touched = touched.groupBy("user_idx").agg(F.array_sort(F.collect_list("place")).alias("touched"), F.sum("n").alias("n_touched"))
    n_train = p.groupBy("user_idx").agg(F.count(F.lit(1)).alias("n_train"))
    user = attach(n_train.join(touched, "user_idx", "left"), totals)
    user = user.select("user_idx", "n_train", F.coalesce("touched", F.array().cast("array<long>")).alias("touched"),
                       (F.col("n_cats") - F.coalesce(F.size("touched"), F.lit(0))).alias("n_untouched"),
                       (F.col("n_known") - F.coalesce("n_touched", F.lit(0))).alias("n_untouched_items"))
    pa = p.join(it, "item_idx").join(user, "user_idx")
    warm = ((F.col("cat_l2_idx") != 0) & (F.col("n_train") >= warm_threshold) & (F.col("n_untouched") > 0) &
            (F.col("n_untouched_items") >= n_neg))
    u, i, slot = F.col("user_idx"), F.col("item_idx"), F.col("slot")

    slots = F.explode(F.sequence(F.lit(0), F.lit(n_neg - 1))).alias("slot")
    wd = pa.filter(warm).select("user_idx", "item_idx", "touched", "n_untouched", slots)
    wd = wd.withColumn("place", past(F.pmod(draw(seed, u, i, slot, "category"), F.col("n_untouched")), F.col("touched")))
    wd = lookup_join(wd, cats, "place", F.xxhash64(u, i, slot)).withColumn("pos", F.pmod(draw(seed, u, i, slot, "item"), F.col("n")))
    warm_out = (wd.join(pools.filter(F.col("kind") == "cat").select("key", "pos", F.col("item_idx").alias("neg_item_idx")), ["key", "pos"])
                .select("user_idx", "item_idx", "slot", "neg_item_idx", F.lit("warm_anti_category").alias("route")))

    # the positive's pool, and how much of it the user left free
    known = F.col("cat_l2_idx") != 0
    rest = pa.filter(~warm).select(
        "user_idx", "item_idx", F.when(known, F.lit("cat")).otherwise(F.lit("bucket")).alias("kind"),
        F.when(known, F.col("cat_l2_idx")).otherwise(F.col("price_bucket")).cast("long").alias("key"))
    taken = p.join(pools.select("item_idx", "kind", "key", "pos"), "item_idx")
    held = taken.groupBy("user_idx", "kind", "key").agg(F.count(F.lit(1)).alias("m"))
    rest = (lookup_join(rest, sizes, ["kind", "key"], F.xxhash64(u, i)).join(held, ["user_idx", "kind", "key"], "left")
            .withColumn("free", F.col("n") - F.coalesce("m", F.lit(0))))
    places = F.posexplode(draw_places(F.col("free"), n_neg, seed, u, i)).alias("slot", "place")
    drawn = rest.filter(F.col("free") > 0).select("user_idx", "item_idx", "kind", "key", "free", places)
    # place among the free -> position in the pool: the number of positives before
    # it, by one ordered pass over a user's draws and positives of a pool
    order = Window.partitionBy("user_idx", "kind", "key").orderBy("pos")
    before = taken.select("user_idx", "kind", "key", (F.col("pos") - F.row_number().over(order) + 1).alias("place"), F.lit(1).alias("one"))
    both = drawn.withColumn("one", F.lit(0)).unionByName(before, allowMissingColumns=True)
    along = (Window.partitionBy("user_idx", "kind", "key").orderBy("place", F.desc("one"))
             .rowsBetween(Window.unboundedPreceding, Window.currentRow))
    moved = both.withColumn("pos", F.col("place") + F.sum("one").over(along)).filter(F.col("one") == 0)
    pool_out = (moved.join(pools.select("kind", "key", "pos", F.col("item_idx").alias("neg_item_idx")), ["kind", "key", "pos"])
                .select("user_idx", "item_idx", "slot", "neg_item_idx",
                        F.when(F.col("free") >= n_neg, "pool_sampled").otherwise("pool_with_replacement").alias("route")))

    # nothing free: the catalogue, past the positive's own position
    catalog = dense_index(it.select("item_idx"), "item_idx", "pos", start=0)
    empty = rest.filter(F.col("free") <= 0).select("user_idx", "item_idx").join(catalog.withColumnRenamed("pos", "own"), "item_idx")
    empty = attach(empty, catalog.agg((F.count(F.lit(1)) - 1).alias("free"))).filter(F.col("free") > 0)
    ed = empty.select("user_idx", "item_idx", "own", F.posexplode(draw_places(F.col("free"), n_neg, seed, u, i)).alias("slot", "place"))
    ed = ed.withColumn("pos", F.col("place") + (F.col("place") >= F.col("own")).cast("long"))
    empty_out = ed.join(catalog.select("pos", F.col("item_idx").alias("neg_item_idx")), "pos").select(
        "user_idx", "item_idx", "slot", "neg_item_idx", F.lit("catalogue_fallback").alias("route"))
    return warm_out.unionByName(pool_out).unionByName(empty_out)


def uniform_negatives(rows: DataFrame, key_cols: list[str], n_items: int, n_neg: int, seed: int = 42) -> DataFrame:
    """``n_neg`` item indices uniform over [1, n_items) per row (0 = PAD
    never drawn), each from a draw of (seed, keys, slot)."""
    keys = [F.col(c) for c in key_cols]
    draws = F.transform(F.sequence(F.lit(0), F.lit(n_neg - 1)),
                        lambda s: F.pmod(draw(seed, *keys, s), F.lit(n_items - 1)) + 1)
    return rows.withColumn("negatives", draws)


def pool_sizes(pairs: DataFrame, items: DataFrame) -> DataFrame:
    """Per training pair the size of its hard-negative pool minus the
    positive (category pool for known categories, price bucket otherwise)."""
    it = items.select("item_idx", "cat_l2_idx", "price_bucket")
    cat_n = it.filter(F.col("cat_l2_idx") != 0).groupBy("cat_l2_idx").agg(F.count(F.lit(1)).alias("cat_n"))
    b_n = it.groupBy("price_bucket").agg(F.count(F.lit(1)).alias("b_n"))
    pa = pairs.select("user_idx", "item_idx").join(it, "item_idx")
    pa = lookup_join(pa, cat_n, "cat_l2_idx", F.col("user_idx"), how="left")
    pa = lookup_join(pa, b_n, "price_bucket", F.col("user_idx"))
    return pa.select("user_idx", "item_idx", (F.when(F.col("cat_l2_idx") != 0, F.col("cat_n"))
                                              .otherwise(F.col("b_n")) - 1).alias("pool_size"))


def session_negatives(events: DataFrame, items: DataFrame, session_col: str = "user_session",
                      item_col: str = "product_id") -> DataFrame:
    """Per session with a positive (cart/purchase), its view-only items
    (viewed, never carted or purchased in the session) and how many of them
    share a category with one of the session's positives."""
    t = F.col("event_type")
    per = events.groupBy(session_col, item_col).agg(
        F.max((t == "view").cast("int")).alias("viewed"), F.max(t.isin("cart", "purchase").cast("int")).alias("pos"))
    cat = items.select(F.col(item_col), F.col("cat_l2").alias("cat"))
    per = per.join(cat, item_col, "left")
    pos_sessions = per.filter(F.col("pos") == 1).select(session_col).distinct()
    pos_cats = per.filter(F.col("pos") == 1).select(session_col, "cat").distinct().withColumn("_sc", F.lit(1))
    view_only = (per.filter((F.col("viewed") == 1) & (F.col("pos") == 0))
                 .join(pos_sessions, session_col, "left_semi")
                 .join(pos_cats, [session_col, "cat"], "left"))
    stats = view_only.groupBy(session_col).agg(F.count(F.lit(1)).alias("pool_size"),
                                               F.count("_sc").alias("same_category"))
    return pos_sessions.join(stats, session_col, "left").fillna(0, ["pool_size", "same_category"])


def in_batch_difficulty(pairs: DataFrame, items: DataFrame, batch_size: int, top_share: float = 0.1) -> DataFrame:
    """Per batch of about ``batch_size`` pairs (a fixed arithmetic spread of
    the pair over as many batches as the pairs need) the same-category pair rate
    sum_c n_c (n_c - 1) / (B (B - 1)) and the share of items that are among the
    most popular ``top_share`` of the catalogue."""
    n_batches = pairs.agg(F.ceil(F.count(F.lit(1)) / batch_size).alias("n_batches"))
    spread = F.pmod(F.col("user_idx") * 7919 + F.col("item_idx") * 104729, F.col("n_batches"))
    b = attach(pairs.select("user_idx", "item_idx"), n_batches).select("user_idx", "item_idx", spread.alias("batch"))
    b = b.join(items.select("item_idx", "cat_l2_idx"), "item_idx")
    per_cat = b.groupBy("batch", "cat_l2_idx").agg(F.count(F.lit(1)).alias("n_c"))
    same = per_cat.groupBy("batch").agg(F.sum(F.col("n_c") * (F.col("n_c") - 1)).alias("same_pairs"),
                                        F.sum("n_c").alias("size"))
    pop = pairs.groupBy("item_idx").agg(F.count(F.lit(1)).alias("n"))
    n_items = pop.agg(F.count(F.lit(1)).alias("_n"))
    ranked = dense_index(pop.select((-F.col("n")).alias("_neg"), "item_idx"), ["_neg", "item_idx"], "_r", start=1)
    top = attach(ranked, n_items).filter(F.col("_r") <= F.ceil(F.col("_n") * top_share)).select("item_idx")
    popular = b.join(top.withColumn("_top", F.lit(1)), "item_idx", "left").groupBy("batch").agg(
        F.count("_top").alias("n_popular"))
    out = same.join(popular, "batch")
    return out.select("batch", "size", F.when(F.col("size") > 1, F.col("same_pairs") /
                                              (F.col("size") * (F.col("size") - 1))).otherwise(0.0)
                      .alias("same_category_pair_rate"),
                      (F.col("n_popular") / F.col("size")).alias("popular_share"))


def false_negative_risk(negs: DataFrame, items: DataFrame, pairs: DataFrame, top_share: float = 0.1) -> DataFrame:
    """Over mined negatives, the share with the positive's category and
    brand, and the share that are among the most popular ``top_share`` items
    of their category."""
    it = items.select("item_idx", "cat_l2_idx", "brand_idx")
    pos = it.select(F.col("item_idx"), F.col("cat_l2_idx").alias("p_cat"), F.col("brand_idx").alias("p_brand"))
    neg = it.select(F.col("item_idx").alias("neg_item_idx"), F.col("cat_l2_idx").alias("n_cat"),
                    F.col("brand_idx").alias("n_brand"))
    pop = pairs.groupBy("item_idx").agg(F.count(F.lit(1)).alias("n")).join(it, "item_idx")
    ranked = dense_index(pop.select("cat_l2_idx", (-F.col("n")).alias("_neg"), "item_idx"),
                         ["cat_l2_idx", "_neg", "item_idx"], "_g", start=0)
    first = ranked.groupBy("cat_l2_idx").agg(F.min("_g").alias("_g0"), F.count(F.lit(1)).alias("_cn"))
    top = (ranked.join(first, "cat_l2_idx")
           .filter((F.col("_g") - F.col("_g0")) < F.ceil(F.col("_cn") * top_share))
           .select(F.col("item_idx").alias("neg_item_idx")).withColumn("_top", F.lit(1)))
    j = negs.join(pos, "item_idx").join(neg, "neg_item_idx").join(top, "neg_item_idx", "left")
    return j.agg(F.count(F.lit(1)).alias("n_negatives"),
                 F.avg(((F.col("p_cat") == F.col("n_cat")) & (F.col("p_brand") == F.col("n_brand"))).cast("double"))
                 .alias("same_cat_brand_share"),
                 F.avg(F.coalesce(F.col("_top"), F.lit(0)).cast("double")).alias("popular_in_category_share"))
