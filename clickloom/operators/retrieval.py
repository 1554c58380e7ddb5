"""Baseline recommenders: global popularity, per-category popularity and item
co-occurrence (R8, R9, R28, R29, R30, A27).

Popularity ranks are dense indices (range-partitioned sort), never a single
global window. "Top-k items not yet seen by the user" is answered exactly
and in linear work: a user with ``s`` seen items can lose at most ``s`` of
the first ``k + s`` ranks, so each user explodes exactly ``k + s`` rank
numbers and equi-joins them to the rank table (no nested-loop range join,
no per-user scan of the catalogue, no cap on history).
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from clickloom.operators.ordering import dense_index, top_k_per_group


def popularity_ranks(pairs: DataFrame, item_col: str = "item_idx",
                     score_col: str = "confidence_score") -> DataFrame:
    """A27 + W7: items by summed score, ranked 1.. (ties by item id)."""
    pop = pairs.groupBy(item_col).agg(F.sum(score_col).cast("double").alias("popularity"))
    keyed = pop.select(item_col, "popularity", (-F.col("popularity")).alias("_neg"))
    ranks = dense_index(keyed.select("_neg", item_col), ["_neg", item_col], "pop_rank", start=1)
    return ranks.select(item_col, (-F.col("_neg")).alias("popularity"), "pop_rank")


def seen_counts(seen: DataFrame, user_col: str = "user_idx") -> DataFrame:
    return seen.groupBy(user_col).agg(F.count(F.lit(1)).alias("_n_seen"))


# Fixed bound: rows of a global rank table's head that are looked up by broadcast.
HEAD_RANKS = 4096
# Buckets of the salted (key, rank) lookup of per-key rankings.
RANK_SALTS = 8
# Co-occurrence: (rep, item) pairs of one user that one join key may hold; a user
# with more is split over as many salts as the measured pair work needs.
PAIRS_A_KEY = 2_000_000


def _unseen_top_k(users: DataFrame, seen: DataFrame, ranked: DataFrame, k: int, rank_col: str,
                  key_cols: list[str], user_col: str, item_col: str, extra: int = 0) -> DataFrame:
    """Per user (with its key columns, e.g. a category) the first ``k`` ranked
    items not in ``seen``; exact via explode(1..k+extra+n_seen) + equi join.

    Every user asks for ranks 1..k+extra, so in a shuffle join those rank
    numbers would be keys as hot as the user count. For a global ranking
    (no key columns; ranks are dense and unique) the first ``HEAD_RANKS``
    ranks are a table of at most that many rows: they are looked up by
    broadcast, and only ranks past the head (wanted by users with long
    histories) take the shuffle join."""
    u = (users.join(seen_counts(seen, user_col), user_col, "left")
         .withColumn("_bound", F.lit(k + extra) + F.coalesce(F.col("_n_seen"), F.lit(0))))
    exploded = u.select(user_col, *key_cols, F.explode(F.sequence(F.lit(1), F.col("_bound"))).alias(rank_col))
    if key_cols:
        # per-key rankings (e.g. per category): a popular key makes (key, 1..k)
        # hot, so the lookup is salted by user; the rank table (one row per
        # item) is copied into each of RANK_SALTS buckets, the user side is not
        salted = exploded.withColumn("_salt", F.pmod(F.xxhash64(user_col), F.lit(RANK_SALTS)).cast("int"))
        copies = ranked.select("*", F.explode(F.sequence(F.lit(0), F.lit(RANK_SALTS - 1))).alias("_salt"))
        cand = salted.join(copies, key_cols + [rank_col, "_salt"]).drop("_salt")
    else:
        head = F.col(rank_col) <= HEAD_RANKS
        cand = (exploded.filter(head).join(F.broadcast(ranked.filter(head)), rank_col)
                .unionByName(exploded.filter(~head).join(ranked.filter(~head), rank_col)))
    cand = cand.join(seen.select(user_col, item_col), [user_col, item_col], "left_anti")
    return cand


def popularity_recs(users: DataFrame, seen: DataFrame, ranks: DataFrame, k: int = 20,
                    user_col: str = "user_idx", item_col: str = "item_idx") -> DataFrame:
    """Per user the ``k`` most popular unseen items, ``rank`` 1..k."""
    cand = _unseen_top_k(users.select(user_col).distinct(), seen, ranks.select(item_col, "pop_rank"),
                         k, "pop_rank", [], user_col, item_col)
    return top_k_per_group(cand, user_col, [F.asc("pop_rank")], k, rank_col="rank").select(
        user_col, item_col, "rank")


def category_ranks(pairs: DataFrame, item_cat: DataFrame, cat_col: str = "cat_l2_idx",
                   item_col: str = "item_idx", score_col: str = "confidence_score") -> DataFrame:
    """Items ranked by summed score inside their category (1.., ties by id)."""
    pop = (pairs.join(item_cat.select(item_col, cat_col), item_col)
           .groupBy(cat_col, item_col).agg(F.sum(score_col).cast("double").alias("popularity")))
    keyed = pop.select(cat_col, (-F.col("popularity")).alias("_neg"), item_col)
    idx = dense_index(keyed, [cat_col, "_neg", item_col], "_g", start=0)
    first = idx.groupBy(cat_col).agg(F.min("_g").alias("_g0"))
    return idx.join(first, cat_col).select(cat_col, item_col, (-F.col("_neg")).alias("popularity"),
                                          (F.col("_g") - F.col("_g0") + 1).alias("cat_rank"))


def top_category(pairs: DataFrame, item_cat: DataFrame, cat_col: str = "cat_l2_idx",
                 user_col: str = "user_idx", item_col: str = "item_idx",
                 score_col: str = "confidence_score") -> DataFrame:
    """Each user's category with the largest summed score (ties: smallest id)."""
    s = (pairs.join(item_cat.select(item_col, cat_col), item_col)
         .groupBy(user_col, cat_col).agg(F.sum(score_col).alias("_s")))
    return top_k_per_group(s, user_col, [F.desc("_s"), F.asc(cat_col)], 1, rank_col=None).select(user_col, cat_col)


def category_popularity_recs(users: DataFrame, pairs: DataFrame, item_cat: DataFrame, ranks: DataFrame,
                             k: int = 20, cat_col: str = "cat_l2_idx", user_col: str = "user_idx",
                             item_col: str = "item_idx") -> DataFrame:
    """Popular unseen items of the user's top category first, then global
    popularity (unseen, not already chosen) until ``k``."""
    seen = pairs.select(user_col, item_col)
    u = users.select(user_col).distinct()
    ucat = u.join(top_category(pairs, item_cat, cat_col, user_col, item_col), user_col, "left")
    cranks = category_ranks(pairs, item_cat, cat_col, item_col).select(cat_col, item_col, "cat_rank")
    in_cat = _unseen_top_k(ucat.filter(F.col(cat_col).isNotNull()), seen, cranks, k, "cat_rank", [cat_col],
                           user_col, item_col)
    in_cat = top_k_per_group(in_cat, user_col, [F.asc("cat_rank")], k, rank_col=None)
    glob = _unseen_top_k(u, seen, ranks.select(item_col, "pop_rank"), k, "pop_rank", [], user_col, item_col,
                         extra=k)
    both = (in_cat.select(user_col, item_col, F.lit(0).alias("_pri"), F.col("cat_rank").alias("_r"))
            .unionByName(glob.select(user_col, item_col, F.lit(1).alias("_pri"), F.col("pop_rank").alias("_r"))))
    best = both.groupBy(user_col, item_col).agg(F.min(F.struct("_pri", "_r")).alias("_o"))
    return top_k_per_group(best, user_col, [F.asc("_o")], k, rank_col="rank").select(user_col, item_col, "rank")


def representative_items(pairs: DataFrame, user_col: str = "user_idx", item_col: str = "item_idx",
                         score_col: str = "confidence_score") -> DataFrame:
    """Each user's highest-confidence item (ties: smallest item id)."""
    return top_k_per_group(pairs, user_col, [F.desc(score_col), F.asc(item_col)], 1, rank_col=None).select(
        user_col, F.col(item_col).alias("rep_item"))


def cooccurrence_counts(pairs: DataFrame, reps: DataFrame, user_col: str = "user_idx",
                        item_col: str = "item_idx") -> DataFrame:
    """Exact co-occurrence of each representative item with every other item:
    the number of users having interacted with both.

    Only representative items are expanded (a semi join first reduces the
    left side to them) and the (rep, item) counts are partially aggregated
    right after the join, so what is shuffled is bounded by distinct
    (rep, item) pairs per map task, not by users. No neighbour cap: every
    co-interacting user counts.
    """
    ui = pairs.select(user_col, item_col).distinct()
    rep_set = reps.select(F.col("rep_item").alias(item_col)).distinct()
    left = ui.join(rep_set, item_col, "left_semi").select(user_col, F.col(item_col).alias("rep_item"))
    # A user's pair work is their representative items times their items. Their
    # (user, rep) rows go to one of as many salts as that work needs by rep item and
    # their (user, item) rows are copied to each; each (user, rep, item) still
    # meets once. Ordinary users need one salt.
    work = (left.groupBy(user_col).agg(F.count(F.lit(1)).alias("_r"))
            .join(ui.groupBy(user_col).agg(F.count(F.lit(1)).alias("_n")), user_col)
            .select(user_col, F.ceil(F.col("_r") * F.col("_n") / F.lit(PAIRS_A_KEY)).alias("_salts")).filter(F.col("_salts") > 1))
    salts = F.coalesce("_salts", F.lit(1))
    left = left.join(work, user_col, "left").select(user_col, "rep_item", F.pmod(F.xxhash64("rep_item"), salts).alias("_salt"))
    right = ui.join(work, user_col, "left").select(user_col, item_col, F.explode(F.sequence(F.lit(0).cast("long"), salts - 1)).alias("_salt"))
    joined = left.join(right, [user_col, "_salt"]).filter(F.col(item_col) != F.col("rep_item"))
    return joined.groupBy("rep_item", item_col).agg(F.count(F.lit(1)).alias("cooc"))


def cooccurrence_recs(users: DataFrame, pairs: DataFrame, ranks: DataFrame, k: int = 20, walk: int = 500,
                      user_col: str = "user_idx", item_col: str = "item_idx") -> DataFrame:
    """Neighbours of the user's representative item by co-occurrence
    (the first ``walk`` by count, ties by item id), unseen ones first, then
    global popularity (unseen, not already chosen) until ``k``."""
    seen = pairs.select(user_col, item_col)
    u = users.select(user_col).distinct()
    reps = u.join(representative_items(pairs, user_col, item_col), user_col)
    counts = cooccurrence_counts(pairs, reps, user_col, item_col)
    top = top_k_per_group(counts, "rep_item", [F.desc("cooc"), F.asc(item_col)], walk, rank_col="nb_rank")
    # a best-seller represents many users: users are spread over salts and the
    # neighbour lists (``walk`` rows an item at most) copied to each
    salted = reps.withColumn("_salt", F.pmod(F.xxhash64(user_col), F.lit(RANK_SALTS)).cast("int"))
    copies = top.select("*", F.explode(F.sequence(F.lit(0), F.lit(RANK_SALTS - 1))).alias("_salt"))
    cand = (salted.join(copies, ["rep_item", "_salt"]).select(user_col, item_col, "nb_rank")
            .join(seen, [user_col, item_col], "left_anti"))
    cand = top_k_per_group(cand, user_col, [F.asc("nb_rank")], k, rank_col=None)
    glob = _unseen_top_k(u, seen, ranks.select(item_col, "pop_rank"), k, "pop_rank", [], user_col, item_col,
                         extra=k)
    both = (cand.select(user_col, item_col, F.lit(0).alias("_pri"), F.col("nb_rank").alias("_r"))
            .unionByName(glob.select(user_col, item_col, F.lit(1).alias("_pri"), F.col("pop_rank").alias("_r"))))
    best = both.groupBy(user_col, item_col).agg(F.min(F.struct("_pri", "_r")).alias("_o"))
    return top_k_per_group(best, user_col, [F.asc("_o")], k, rank_col="rank").select(user_col, item_col, "rank")
