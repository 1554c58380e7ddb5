"""Evaluation of baseline recommenders on a held-out window (metrics per cohort)."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from clickloom.operators import ranking as Rk
from clickloom.operators import retrieval as Rt


def run(pairs: DataFrame, test_events: DataFrame, user_vocab: DataFrame, item_vocab: DataFrame,
        item_cat: DataFrame, k: int = 20) -> DataFrame:
    gt = Rk.ground_truth(test_events, user_vocab, item_vocab)
    users = gt.select("user_idx").distinct()
    ranks = Rt.popularity_ranks(pairs)
    strategies = {
        "popularity": Rt.popularity_recs(users, pairs, ranks, k),
        "category_popularity": Rt.category_popularity_recs(users, pairs, item_cat, ranks, k),
        "cooccurrence": Rt.cooccurrence_recs(users, pairs, ranks, k),
    }
    out = None
    for name, recs in strategies.items():
        strat = Rk.stratified_metrics(Rk.user_metrics(recs, gt, k), pairs, k).select(
            F.lit(name).alias("strategy"), "*")
        out = strat if out is None else out.unionByName(strat)
    return out
