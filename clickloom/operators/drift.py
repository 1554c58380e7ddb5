"""Popularity drift and the weekly retraining gate.

Distributions are per-item counts; two of them are aligned with a full
outer join on the item (the union vocabulary), and divergences are one
grouped sum. The weekly gate is an ordered fold over a calendar-sized array
(one element per week) evaluated with ``aggregate``.
"""

from __future__ import annotations

import datetime as dt
import math

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from clickloom.functions.columns import attach, rnd
from clickloom.operators.ordering import lookup_join
from clickloom.session import cut_lineage

# Fixed values of the drift monitor.
JSD_EPS = 1e-10
JSD_ALERT = 0.10
TOP_N_OVERLAP = 50
TOP_N_REPORT = 20
PROMOTE_MIN_GAIN = 0.0005
LN2 = math.log(2)


def item_counts(events: DataFrame, item_col: str = "product_id") -> DataFrame:
    return events.groupBy(F.col(item_col).alias("item")).agg(F.count(F.lit(1)).alias("n"))


def _aligned(ref: DataFrame, new: DataFrame) -> DataFrame:
    a = ref.select("item", F.col("n").alias("n_p"))
    b = new.select("item", F.col("n").alias("n_q"))
    j = a.join(b, "item", "full_outer").fillna(0, ["n_p", "n_q"])
    tot = j.agg(F.sum("n_p").alias("t_p"), F.sum("n_q").alias("t_q"), F.count(F.lit(1)).alias("n_union"))
    return attach(j, tot)


def jsd_smoothed(ref: DataFrame, new: DataFrame, eps: float = JSD_EPS) -> DataFrame:
    """R15 (monitor form): JSD over the union vocabulary with ``eps`` added to
    every probability and renormalised, natural log, divided by ln 2."""
    j = _aligned(ref, new)
    den_p = F.lit(1.0) + F.col("n_union") * F.lit(eps)
    p = (F.col("n_p") / F.col("t_p") + F.lit(eps)) / den_p
    q = (F.col("n_q") / F.col("t_q") + F.lit(eps)) / den_p
    m = (p + q) / 2
    term = 0.5 * (p * F.log(p / m) + q * F.log(q / m))
    return j.agg((F.sum(term) / F.lit(LN2)).alias("jsd"))


def jsd_masked(ref: DataFrame, new: DataFrame) -> DataFrame:
    """R15 (weekly form): terms with a zero probability are skipped; the value
    is clipped to [0, ln 2] and divided by ln 2. Empty sides give 0."""
    j = _aligned(ref, new)
    p = F.when(F.col("t_p") > 0, F.col("n_p") / F.col("t_p")).otherwise(F.lit(0.0))
    q = F.when(F.col("t_q") > 0, F.col("n_q") / F.col("t_q")).otherwise(F.lit(0.0))
    m = (p + q) / 2
    kl_p = F.when((p > 0) & (m > 0), p * F.log(p / m)).otherwise(F.lit(0.0))
    kl_q = F.when((q > 0) & (m > 0), q * F.log(q / m)).otherwise(F.lit(0.0))
    s = F.coalesce(F.sum(0.5 * kl_p + 0.5 * kl_q), F.lit(0.0))
    return j.agg((F.least(F.greatest(s, F.lit(0.0)), F.lit(LN2)) / F.lit(LN2)).alias("jsd"))


def top_items(counts: DataFrame, n: int) -> DataFrame:
    """The ``n`` most frequent items with rank 1..n (ties by item id)."""
    top = counts.orderBy(F.desc("n"), F.asc("item")).limit(n)
    # the window runs over at most n rows (after the ordered limit)
    return top.select("item", "n", F.row_number().over(Window.orderBy(F.desc("n"), F.asc("item"))).alias("rank"))


def _top_array(top: DataFrame) -> Column:
    return F.transform(F.array_sort(F.collect_list(F.struct("rank", "item"))), lambda x: x["item"])


def drift_report(ref_events: DataFrame, new_events: DataFrame, item_col: str = "product_id",
                 alert: float = JSD_ALERT, overlap_n: int = TOP_N_OVERLAP,
                 report_n: int = TOP_N_REPORT) -> DataFrame:
    """R15 + U3 + S10 payload: one row with event counts, JSD (smoothed),
    top-N overlap %, test-item coverage %, the alert flag and both top-20 lists."""
    cr, cn = item_counts(ref_events, item_col), item_counts(new_events, item_col)
    jsd = jsd_smoothed(cr, cn)
    tr, tn = top_items(cr, overlap_n), top_items(cn, overlap_n)
    overlap = tr.join(tn, "item", "left_semi").agg(
        (F.count(F.lit(1)) * 100.0 / F.lit(overlap_n)).alias("top_n_overlap_pct"))
    cov = cn.agg(F.count(F.lit(1)).alias("_t"))
    covered = cn.join(cr.select("item"), "item", "left_semi").agg(F.count(F.lit(1)).alias("_c"))
    coverage = attach(cov, covered).select(
        F.when(F.col("_t") > 0, F.col("_c") * 100.0 / F.col("_t")).otherwise(F.lit(0.0)).alias("coverage_pct"))
    n_ev = attach(cr.agg(F.sum("n").alias("n_ref_events")), cn.agg(F.sum("n").alias("n_new_events")))
    top_r = tr.filter(F.col("rank") <= report_n).agg(_top_array(tr).alias("top_ref"))
    top_n = tn.filter(F.col("rank") <= report_n).agg(_top_array(tn).alias("top_new"))
    out = attach(jsd, overlap, coverage, n_ev, top_r, top_n)
    return out.select(F.col("n_ref_events").cast("long"), F.col("n_new_events").cast("long"),
                      rnd("jsd", 6).alias("jsd"), rnd("top_n_overlap_pct", 6).alias("top_n_overlap_pct"),
                      rnd("coverage_pct", 6).alias("coverage_pct"), (F.col("jsd") > alert).alias("alert"),
                      "top_ref", "top_new")


def rank_comparison(ref_events: DataFrame, new_events: DataFrame, n: int = TOP_N_REPORT,
                    item_col: str = "product_id") -> DataFrame:
    """Items in either top-``n`` list with both ranks; an item missing from
    one list gets a null rank there and status 'entered' or 'dropped'."""
    a = top_items(item_counts(ref_events, item_col), n).select("item", F.col("rank").alias("ref_rank"))
    b = top_items(item_counts(new_events, item_col), n).select("item", F.col("rank").alias("new_rank"))
    j = a.join(b, "item", "full_outer")
    status = (F.when(F.col("ref_rank").isNull(), "entered").when(F.col("new_rank").isNull(), "dropped")
              .otherwise("both"))
    return j.select("item", "ref_rank", "new_rank", (F.col("ref_rank") - F.col("new_rank")).alias("rank_gain"),
                    status.alias("status"))


# A week with fewer events or sessions is skipped.
MIN_WEEK_EVENTS = 100
MIN_WEEK_SESSIONS = 50


def week_number(ts_col: str, start: dt.datetime, days: int = 7) -> Column:
    """1 for ``[start, start + days)`` and so on, computed from the
    timestamp (an equi-key), not by a range join to a calendar."""
    base = F.unix_timestamp(F.lit(start.strftime("%Y-%m-%d %H:%M:%S")).cast("timestamp_ntz"))
    return (F.floor((F.unix_timestamp(ts_col) - base) / F.lit(days * 86400)) + 1).cast("int")


def weekly_windows(events: DataFrame, start: dt.datetime, n_weeks: int | None = None, days: int = 7,
                   ts_col: str = "event_time") -> DataFrame:
    """Events from ``start`` on, tagged with their calendar week; with
    ``n_weeks`` only that many weeks, else all there are."""
    tagged = events.withColumn("week", week_number(ts_col, start, days)).filter(F.col("week") >= 1)
    return tagged if n_weeks is None else tagged.filter(F.col("week") <= n_weeks)


def week_count(tagged: DataFrame) -> int:
    """The last week that has events (0 if none has)."""
    return tagged.agg(F.max("week")).first()[0] or 0


#: a baseline: the last week it serves (None: all later ones) and its period
Baseline = tuple[int | None, dt.datetime, dt.datetime]


def weekly_jsd(tagged: DataFrame, events: DataFrame, baselines: list[Baseline], item_col: str = "product_id",
               ts_col: str = "event_time") -> DataFrame:
    """R15 (weekly): masked JSD of each week against the baseline period that
    serves it (a month before, in production), all weeks in one grouped job.

    ``baselines`` are ordered; a week is served by the first whose last week it
    does not exceed. A baseline's item counts are copied to the weeks it serves:
    calendar x catalogue rows at most."""
    period = F.lit(None).cast("int")
    for i, (last, _, _) in reversed(list(enumerate(baselines))):
        period = F.lit(i) if last is None else F.when(F.col("week") <= last, F.lit(i)).otherwise(period)
    counts = None
    for i, (_, start, end) in enumerate(baselines):
        own = (events.filter((F.col(ts_col) >= F.lit(start).cast("timestamp_ntz")) & (F.col(ts_col) < F.lit(end).cast("timestamp_ntz")))
               .groupBy(F.col(item_col).alias("item")).agg(F.count(F.lit(1)).alias("n_p")).withColumn("period", F.lit(i)))
        counts = own if counts is None else counts.unionByName(own)
    cur = cut_lineage(tagged.groupBy("week", F.col(item_col).alias("item")).agg(F.count(F.lit(1)).alias("n_q")))
    weeks = cur.select("week").distinct().withColumn("period", period)
    # two keys each (period, then week) for whole catalogues: salted
    ref = lookup_join(counts, weeks, "period", F.col("item")).select("week", "item", "n_p")
    j = ref.join(cur, ["week", "item"], "full_outer").fillna(0, ["n_p", "n_q"])
    tot = j.groupBy("week").agg(F.sum("n_p").alias("t_p"), F.sum("n_q").alias("t_q"))
    j = lookup_join(j, tot, "week", F.col("item"))
    p = F.when(F.col("t_p") > 0, F.col("n_p") / F.col("t_p")).otherwise(F.lit(0.0))
    q = F.when(F.col("t_q") > 0, F.col("n_q") / F.col("t_q")).otherwise(F.lit(0.0))
    m = (p + q) / 2
    kl_p = F.when((p > 0) & (m > 0), p * F.log(p / m)).otherwise(F.lit(0.0))
    kl_q = F.when((q > 0) & (m > 0), q * F.log(q / m)).otherwise(F.lit(0.0))
    value = F.least(F.greatest(F.sum(0.5 * kl_p + 0.5 * kl_q), F.lit(0.0)), F.lit(LN2)) / F.lit(LN2)
    return j.groupBy("week").agg(value.alias("jsd"))


def weekly_volume(tagged: DataFrame, min_len: int = 2, user_col: str = "user_id", item_col: str = "product_id",
                  session_col: str = "user_session", ts_col: str = "event_time") -> DataFrame:
    """Events of each week, and its sessions of at least ``min_len`` events once
    consecutive repeats are removed (what a week is trained on)."""
    from clickloom.operators.sequences import drop_consecutive_repeats
    rows = tagged.select("week", F.col(user_col).alias("user_idx"), F.col(session_col).alias("user_session"),
                         F.col(ts_col).alias("event_time"), F.col(item_col).alias("item_idx"), F.col("event_type").alias("event_idx"))
    per = drop_consecutive_repeats(rows.dropna(subset=["user_session"]), ["week", "user_idx", "user_session"])
    per = per.groupBy("week", "user_idx", "user_session").agg(F.count(F.lit(1)).alias("n")).filter(F.col("n") >= min_len)
    sessions = per.groupBy("week").agg(F.count(F.lit(1)).alias("n_sessions"))
    return (tagged.groupBy("week").agg(F.count(F.lit(1)).alias("n_events")).join(sessions, "week", "left")
            .fillna(0, ["n_sessions"]))


def weekly_gate(weekly: DataFrame, alert: float = JSD_ALERT, min_gain: float = PROMOTE_MIN_GAIN,
                initial_best: float = 0.0) -> DataFrame:
    """Ordered fold over weeks (``week``, ``n_events``, ``n_sessions``,
    ``jsd``, ``ndcg``). In this order a week is: skipped with too few events;
    not retrained when its jsd is below ``alert`` (week 1 always is); skipped
    with too few sessions; retrained without evaluation when ndcg is null;
    promoted when its ndcg exceeds the best by at least ``min_gain``, else not.
    The best moves only on promotion. One row per week with the action and the
    best NDCG after it."""
    arr = F.array_sort(F.collect_list(F.struct("week", "n_events", "n_sessions", "jsd", "ndcg")))
    init = F.struct(F.lit(initial_best).alias("best"),
                    F.array().cast("array<struct<week:int,jsd:double,ndcg:double,action:string,retrained:boolean,"
                                   "promoted:boolean,best_after:double>>").alias("hist"))

    def step(acc, w):
        gains = F.coalesce(w["ndcg"] - acc["best"] >= F.lit(min_gain), F.lit(False))
        action = (F.when(w["n_events"] < MIN_WEEK_EVENTS, "too_few_events")
                  .when((w["week"] != 1) & (w["jsd"] < alert), "no_finetune")
                  .when(w["n_sessions"] < MIN_WEEK_SESSIONS, "too_few_sessions")
                  .when(w["ndcg"].isNull(), "trained_no_eval")
                  .when(gains, "promoted").otherwise("not_promoted"))
        promote = action == "promoted"
        best = F.when(promote, w["ndcg"]).otherwise(acc["best"])
        row = F.struct(w["week"].alias("week"), w["jsd"].alias("jsd"), w["ndcg"].alias("ndcg"), action.alias("action"),
                       action.isin("trained_no_eval", "promoted", "not_promoted").alias("retrained"), promote.alias("promoted"),
                       best.alias("best_after"))
        return F.struct(best.alias("best"), F.concat(acc["hist"], F.array(row)).alias("hist"))

    folded = weekly.agg(F.aggregate(arr, init, step).alias("_f"))
    return folded.select(F.explode("_f.hist").alias("h")).select("h.*")


def weekly_popularity_ndcg(tagged: DataFrame, n_weeks: int, k: int = 20, user_col: str = "user_id",
                           item_col: str = "product_id") -> DataFrame:
    """For each week w < n_weeks, a popularity recommender trained on weeks
    1..w (confidence-weighted, seen items removed) is scored by mean NDCG@k
    on the cart/purchase events of week w + 1; rows ``(week, ndcg)``.

    Events are counted once per (week, user, item); each week then adds its
    counts to the running pair table instead of recounting all weeks before."""
    from clickloom.operators import interactions as I
    from clickloom.operators import ranking as Rk
    from clickloom.operators import retrieval as Rt
    weight = (F.when(F.col("event_type") == "purchase", I.W_PURCHASE).when(F.col("event_type") == "cart", I.W_CART)
              .when(F.col("event_type") == "view", I.W_VIEW))
    counted = cut_lineage(tagged.filter(weight.isNotNull()).groupBy("week", user_col, item_col).agg(F.sum(weight).alias("confidence_score")))
    out, pairs = None, None
    for w in range(1, n_weeks):
        new = counted.filter(F.col("week") == w).drop("week")
        pairs = new if pairs is None else (pairs.unionByName(new).groupBy(user_col, item_col)
                                           .agg(F.sum("confidence_score").alias("confidence_score")))
        pairs = cut_lineage(pairs)
        nxt = tagged.filter((F.col("week") == w + 1) & F.col("event_type").isin("cart", "purchase"))
        gt = nxt.join(pairs.select(user_col).distinct(), user_col, "left_semi").select(user_col, item_col).distinct()
        ranks = Rt.popularity_ranks(pairs, item_col)
        recs = Rt.popularity_recs(gt.select(user_col).distinct(), pairs, ranks, k, user_col, item_col)
        m = Rk.user_metrics(recs, gt, k, user_col=user_col, item_col=item_col)
        row = m.agg(F.avg("ndcg").alias("ndcg")).select(F.lit(w).alias("week"), "ndcg")
        out = row if out is None else out.unionByName(row)
    if out is None:
        return tagged.sparkSession.createDataFrame([], "week int, ndcg double")
    return out


def weekly_report(events: DataFrame, start: dt.datetime, baselines: list[Baseline], n_weeks: int | None = None) -> DataFrame:
    """Per week: events, sessions, JSD against its baseline and next-week NDCG."""
    tagged = cut_lineage(weekly_windows(events, start, n_weeks))
    return (weekly_volume(tagged).join(weekly_jsd(tagged, events, baselines), "week", "left")
            .join(weekly_popularity_ndcg(tagged, week_count(tagged)), "week", "left")
            .select("week", "n_events", "n_sessions", F.col("jsd").cast("double").alias("jsd"), F.col("ndcg").cast("double").alias("ndcg")))
