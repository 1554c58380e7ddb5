"""The weekly loop with stored state (R17): judged weeks are not judged again.

Two Parquet tables partitioned by week live under the state folder: ``history``
(a week's row: drift, evaluation, action, best so far) and ``pairs`` (the user x
item scores of all weeks up to it, the popularity model's training state). A week replaces
its own partitions only, by dynamic partition overwrite, which Spark stages and
moves at commit: a job that fails leaves what was there. The history row is
written last and is what makes a week finished.
"""

from __future__ import annotations

import datetime as dt
import os
from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from clickloom.operators import drift as D
from clickloom.operators import interactions as I
from clickloom.operators import ranking as Rk
from clickloom.operators import retrieval as Rt
from clickloom.session import cut_lineage

HISTORY = ("week int, n_events long, n_sessions long, jsd double, ndcg double, hr_20 double, action string, improvement double, retrained boolean, "
           "promoted boolean, best_after double")
COLUMNS = [c.split()[0] for c in HISTORY.split(", ")]
#: actions of a week that had too little data: it is judged again by the next run
UNFINISHED = ("too_few_events", "too_few_sessions")
K = 20


def _exists(spark: SparkSession, path: str) -> bool:
    where = spark._jvm.org.apache.hadoop.fs.Path(path)
    return where.getFileSystem(spark._jsc.hadoopConfiguration()).exists(where)


def read_history(spark: SparkSession, state: str) -> DataFrame:
    """The stored weeks; none before the first run."""
    path = os.path.join(state, "history")
    if not _exists(spark, path):
        return spark.createDataFrame([], HISTORY)
    return spark.read.schema(HISTORY).parquet(path).select(*COLUMNS)


def _replace_week(df: DataFrame, path: str) -> None:
    df.write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy("week").parquet(path)


def _stored_pair_weeks(spark: SparkSession, state: str) -> list[int]:
    where = spark._jvm.org.apache.hadoop.fs.Path(os.path.join(state, "pairs"))
    fs = where.getFileSystem(spark._jsc.hadoopConfiguration())
    if not fs.exists(where):
        return []
    names = [s.getPath().getName() for s in fs.listStatus(where)]
    return sorted(int(n[len("week="):]) for n in names if n.startswith("week="))


def _scores(tagged: DataFrame, user_col: str, item_col: str) -> DataFrame:
    kind = F.col("event_type")
    weight = F.when(kind == "purchase", I.W_PURCHASE).when(kind == "cart", I.W_CART).when(kind == "view", I.W_VIEW)
    return tagged.where(weight.isNotNull()).groupBy(user_col, item_col).agg(F.sum(weight).alias("confidence_score"))


def _pairs_up_to(spark: SparkSession, state: str, tagged: DataFrame, week: int, user_col: str, item_col: str) -> DataFrame:
    """Scores of weeks 1 to ``week``: the nearest stored table before it and the
    events since (all of them if nothing fits)."""
    before = max([w for w in _stored_pair_weeks(spark, state) if w < week], default=0)
    new = _scores(tagged.where(F.col("week").between(before + 1, week)), user_col, item_col)
    if not before:
        return new
    old = spark.read.parquet(os.path.join(state, "pairs", f"week={before}")).select(user_col, item_col, "confidence_score")
    return old.unionByName(new).groupBy(user_col, item_col).agg(F.sum("confidence_score").alias("confidence_score"))


def _drop_pairs_before(spark: SparkSession, state: str, week: int) -> None:
    path = spark._jvm.org.apache.hadoop.fs.Path
    for w in _stored_pair_weeks(spark, state):
        if w < week:
            where = path(os.path.join(state, "pairs", f"week={w}"))
            where.getFileSystem(spark._jsc.hadoopConfiguration()).delete(where, True)


def _evaluate(pairs: DataFrame, following: DataFrame, user_col: str, item_col: str) -> DataFrame:
    """One row: mean NDCG@20 and hit rate of the popularity recommender on the
    carts and purchases of the week after; null where there are none."""
    bought = following.where(F.col("event_type").isin("cart", "purchase"))
    truth = bought.join(pairs.select(user_col).distinct(), user_col, "left_semi").select(user_col, item_col).distinct()
    recs = Rt.popularity_recs(truth.select(user_col).distinct(), pairs, Rt.popularity_ranks(pairs, item_col), K, user_col, item_col)
    per_user = Rk.user_metrics(recs, truth, K, user_col=user_col, item_col=item_col)
    return per_user.agg(F.avg("ndcg").alias("ndcg"), F.avg(F.col("hit").cast("double")).alias("hr_20"))


def advance(events: DataFrame, state: str, start: dt.datetime, baselines: list[D.Baseline], weeks: Sequence[int] | None = None,
            redo: Sequence[int] = (), initial_best: float = 0.0, alert: float = D.JSD_ALERT, min_gain: float = D.PROMOTE_MIN_GAIN,
            user_col: str = "user_id", item_col: str = "product_id") -> DataFrame:
    """Judges ``weeks`` (default: all that ``events`` hold) in order, from where
    the state under ``state`` ends, and gives the whole stored history.

    A finished week is skipped unless named in ``redo``; a week that had too
    little data is judged again. A week's best so far is that after the last
    stored week before it. Judging a week again with the same events replaces
    its row by an equal one; later weeks keep theirs. ``improvement`` is the NDCG
    less the best before, null where nothing was evaluated. Weeks without events
    have no row. Two runs over half the weeks each give the history of one run;
    the events must reach back over the weeks since the last stored one and the
    baselines, not further."""
    spark = events.sparkSession
    tagged = cut_lineage(D.weekly_windows(events, start))
    there = {r["week"] for r in tagged.select("week").distinct().collect()}  # a calendar
    stored = {r["week"]: r for r in read_history(spark, state).collect()}  # one row a week
    for week in sorted(there if weeks is None else there & set(weeks)):
        if week in stored and stored[week]["action"] not in UNFINISHED and week not in redo:
            continue
        own = tagged.where(F.col("week") == week)
        pairs = cut_lineage(_pairs_up_to(spark, state, tagged, week, user_col, item_col))
        row = (D.weekly_volume(own, user_col=user_col, item_col=item_col)
               .join(D.weekly_jsd(own, events, baselines, item_col=item_col), "week", "left")
               .join(_evaluate(pairs, tagged.where(F.col("week") == week + 1), user_col, item_col).withColumn("week", F.lit(week)), "week", "left"))
        row = cut_lineage(row.select("week", F.col("n_events").cast("long").alias("n_events"), F.col("n_sessions").cast("long").alias("n_sessions"),
                                     F.col("jsd").cast("double").alias("jsd"), "ndcg", "hr_20"))
        best = max((w for w in stored if w < week), default=None)
        best = initial_best if best is None else stored[best]["best_after"]
        judged = D.weekly_gate(row, alert, min_gain, best).select("week", "action", "retrained", "promoted", "best_after")
        gain = F.when(F.col("action").isin("promoted", "not_promoted"), F.col("ndcg") - F.lit(best))
        done = row.join(judged, "week").withColumn("improvement", gain).select(*COLUMNS)
        _replace_week(pairs.withColumn("week", F.lit(week)), os.path.join(state, "pairs"))
        _replace_week(done, os.path.join(state, "history"))
        stored[week] = done.first()
        _drop_pairs_before(spark, state, week - 1)  # the one before it serves to judge this week again
    return read_history(spark, state)
