"""Drift queries."""

from __future__ import annotations

import datetime as dt
import uuid

from pyspark.sql import functions as F

from clickloom.functions.columns import rnd
from clickloom.operators import drift as D
from clickloom.operators import weekly_state as S
from clickloom.queries import register
from clickloom.queries.common import features
from clickloom.queries.sql_base import FEATURES, secs, with_
from clickloom.session import scratch_path

# The first week of January is the baseline of weeks 1 and 2, the two weeks after
# it that of all later ones. Week 4 is the month's last two days.
WEEK1 = dt.datetime(2024, 1, 8)
BASELINES = [(2, dt.datetime(2024, 1, 1), WEEK1), (None, WEEK1, dt.datetime(2024, 1, 22))]
N_WEEKS = 4  # of the oracle, which is unrolled; the query finds them in the data

COUNTS = """,
cr AS (SELECT product_id AS item, count(*) AS n FROM train GROUP BY 1),
cn AS (SELECT product_id AS item, count(*) AS n FROM test GROUP BY 1),
tr AS (SELECT item, row_number() OVER (ORDER BY n DESC, item) AS rank FROM cr QUALIFY rank <= 50),
tn AS (SELECT item, row_number() OVER (ORDER BY n DESC, item) AS rank FROM cn QUALIFY rank <= 50)"""


@register("drift_report_train_test", with_(FEATURES) + COUNTS + """,
al AS (SELECT coalesce(a.item, b.item) AS item, coalesce(a.n, 0) AS n_p, coalesce(b.n, 0) AS n_q
       FROM cr a FULL OUTER JOIN cn b ON a.item = b.item),
tt AS (SELECT sum(n_p) AS t_p, sum(n_q) AS t_q, count(*) AS n_union FROM al),
pq AS (SELECT (n_p / t_p + 1e-10) / (1.0 + n_union * 1e-10) AS p, (n_q / t_q + 1e-10) / (1.0 + n_union * 1e-10) AS q
       FROM al CROSS JOIN tt),
js AS (SELECT sum(0.5 * (p * ln(p / ((p + q) / 2)) + q * ln(q / ((p + q) / 2)))) / ln(2) AS jsd FROM pq)
SELECT CAST((SELECT sum(n) FROM cr) AS BIGINT) AS n_ref_events, CAST((SELECT sum(n) FROM cn) AS BIGINT) AS n_new_events,
       round(jsd, 6) AS jsd,
       round((SELECT count(*) FROM tr WHERE item IN (SELECT item FROM tn)) * 100.0 / 50, 6) AS top_n_overlap_pct,
       round((SELECT count(*) FROM cn WHERE item IN (SELECT item FROM cr)) * 100.0 / (SELECT count(*) FROM cn), 6)
         AS coverage_pct,
       jsd > 0.1 AS alert,
       (SELECT list(item ORDER BY rank) FROM tr WHERE rank <= 20) AS top_ref,
       (SELECT list(item ORDER BY rank) FROM tn WHERE rank <= 20) AS top_new
FROM js""")
def q_drift(spark, sf):
    f = features(spark, sf)
    return D.drift_report(f.train, f.split("test"))


@register("drift_rank_comparison", with_(FEATURES) + COUNTS + """
SELECT coalesce(a.item, b.item) AS item, a.rank AS ref_rank, b.rank AS new_rank, a.rank - b.rank AS rank_gain,
       CASE WHEN a.rank IS NULL THEN 'entered' WHEN b.rank IS NULL THEN 'dropped' ELSE 'both' END AS status
FROM (SELECT * FROM tr WHERE rank <= 20) a FULL OUTER JOIN (SELECT * FROM tn WHERE rank <= 20) b ON a.item = b.item""")
def q_rank_cmp(spark, sf):
    f = features(spark, sf)
    return D.rank_comparison(f.train, f.split("test"))


TAGGED = f""",
tagged AS (SELECT * FROM (
  SELECT *, CAST(floor(({secs('event_time')} - epoch(TIMESTAMP '2024-01-08')) / 604800) + 1 AS INTEGER) AS week
  FROM clean) WHERE week >= 1),
wc AS (SELECT week, product_id AS item, count(*) AS n_q FROM tagged GROUP BY 1, 2),
wb AS (SELECT DISTINCT week, CASE WHEN week <= 2 THEN TIMESTAMP '2024-01-01' ELSE TIMESTAMP '2024-01-08' END AS b_start,
              CASE WHEN week <= 2 THEN TIMESTAMP '2024-01-08' ELSE TIMESTAMP '2024-01-22' END AS b_end FROM tagged),
wr AS (SELECT week, product_id AS item, count(*) AS n_p FROM wb JOIN clean ON event_time >= b_start AND event_time < b_end GROUP BY 1, 2),
wj AS (SELECT coalesce(a.week, b.week) AS week, coalesce(n_p, 0) AS n_p, coalesce(n_q, 0) AS n_q
       FROM wr a FULL OUTER JOIN wc b ON a.week = b.week AND a.item = b.item),
wt AS (SELECT wj.*, sum(n_p) OVER (PARTITION BY week) AS t_p, sum(n_q) OVER (PARTITION BY week) AS t_q FROM wj),
wpq AS (SELECT week, CASE WHEN t_p > 0 THEN n_p / t_p ELSE 0.0 END AS p, CASE WHEN t_q > 0 THEN n_q / t_q ELSE 0.0 END AS q FROM wt),
wjsd AS (SELECT week, least(greatest(sum(
            0.5 * CASE WHEN p > 0 AND (p + q) / 2 > 0 THEN p * ln(p / ((p + q) / 2)) ELSE 0.0 END
          + 0.5 * CASE WHEN q > 0 AND (p + q) / 2 > 0 THEN q * ln(q / ((p + q) / 2)) ELSE 0.0 END), 0.0), ln(2)) / ln(2) AS jsd
         FROM wpq GROUP BY week),
wl AS (SELECT *, lag(product_id) OVER (PARTITION BY week, user_id, user_session ORDER BY event_time, product_id, event_type) AS prev_item
       FROM tagged),
wsn AS (SELECT week, count(*) AS n_sessions FROM (
          SELECT week, user_id, user_session FROM wl WHERE prev_item IS NULL OR prev_item <> product_id
          GROUP BY 1, 2, 3 HAVING count(*) >= 2) GROUP BY 1),
wvol AS (SELECT e.week, e.n_events, coalesce(s.n_sessions, 0) AS n_sessions
         FROM (SELECT week, count(*) AS n_events FROM tagged GROUP BY 1) e LEFT JOIN wsn s USING (week))"""


def _weekly_ndcg_sql() -> str:
    from clickloom.queries.q_ranking import gains_sql
    parts, sels = [gains_sql(20)], []
    for w in range(1, N_WEEKS):
        parts.append(f"""h{w} AS (SELECT user_id, product_id,
      count_if(event_type = 'purchase') * 4 + count_if(event_type = 'cart') * 2 + count_if(event_type = 'view')
        AS confidence_score FROM tagged WHERE week <= {w} AND event_type IN ('view', 'cart', 'purchase') GROUP BY 1, 2),
p{w} AS (SELECT product_id, row_number() OVER (ORDER BY sum(confidence_score) DESC, product_id) AS pop_rank
         FROM h{w} GROUP BY 1),
g{w} AS (SELECT DISTINCT user_id, product_id FROM tagged WHERE week = {w + 1} AND event_type IN ('cart', 'purchase')
         AND user_id IN (SELECT user_id FROM h{w})),
r{w} AS (SELECT * FROM (SELECT u.user_id, p.product_id, row_number() OVER (PARTITION BY u.user_id ORDER BY p.pop_rank)
           AS rank FROM (SELECT DISTINCT user_id FROM g{w}) u CROSS JOIN p{w} p
           WHERE NOT EXISTS (SELECT 1 FROM h{w} s WHERE s.user_id = u.user_id AND s.product_id = p.product_id))
         WHERE rank <= 20),
m{w} AS (SELECT g.user_id, coalesce(h.dcg, 0.0) / i.idcg AS ndcg, CASE WHEN h.dcg IS NULL THEN 0.0 ELSE 1.0 END AS hit
  FROM (SELECT user_id, least(count(*), 20) AS n_ideal FROM g{w} GROUP BY 1) g
  LEFT JOIN (SELECT r.user_id, sum(gn.gain) AS dcg FROM r{w} r JOIN g{w} USING (user_id, product_id)
             JOIN gains_20 gn ON gn.rank = r.rank GROUP BY 1) h USING (user_id)
  JOIN gains_20 i ON i.rank = g.n_ideal)""")
        sels.append(f"SELECT {w} AS week, avg(ndcg) AS ndcg, avg(hit) AS hr_20 FROM m{w}")
    parts.append("wndcg AS (" + " UNION ALL ".join(sels) + ")")
    return ",\n" + ",\n".join(parts)


WEEKLY = TAGGED + _weekly_ndcg_sql()


WK = """,
wk AS (SELECT v.week, v.n_events, v.n_sessions, j.jsd, n.ndcg, n.hr_20 FROM wvol v LEFT JOIN wjsd j USING (week) LEFT JOIN wndcg n USING (week))"""


@register("weekly_drift_metrics", with_(FEATURES) + WEEKLY + WK + """
SELECT week, n_events, n_sessions, round(jsd, 6) AS jsd, round(ndcg, 6) AS ndcg FROM wk""")
def q_weekly(spark, sf):
    w = D.weekly_report(features(spark, sf).clean, WEEK1, BASELINES)
    return w.select("week", "n_events", "n_sessions", rnd("jsd", 6).alias("jsd"), rnd("ndcg", 6).alias("ndcg"))


def _gate_sql(best: str) -> str:
    action = f"""CASE WHEN w.n_events < 100 THEN 'too_few_events' WHEN w.week <> 1 AND w.jsd < CAST(0.1 AS DOUBLE) THEN 'no_finetune'
              WHEN w.n_sessions < 50 THEN 'too_few_sessions' WHEN w.ndcg IS NULL THEN 'trained_no_eval'
              WHEN w.ndcg - {best} >= CAST(0.0005 AS DOUBLE) THEN 'promoted' ELSE 'not_promoted' END"""
    return f"""w.week, w.jsd, w.ndcg, {action} AS action, CASE WHEN {action} = 'promoted' THEN w.ndcg ELSE {best} END AS best_after"""


@register("weekly_retrain_gate", "WITH RECURSIVE " + with_(FEATURES)[len("WITH "):] + WEEKLY + WK + f""",
g AS (
  SELECT {_gate_sql("CAST(0.0 AS DOUBLE)")} FROM wk w WHERE w.week = 1
  UNION ALL
  SELECT {_gate_sql("g.best_after")} FROM g JOIN wk w ON w.week = g.week + 1)
SELECT week, round(jsd, 6) AS jsd, round(ndcg, 6) AS ndcg, action,
       action IN ('trained_no_eval', 'promoted', 'not_promoted') AS retrained, action = 'promoted' AS promoted,
       round(best_after, 6) AS best_after
FROM g""")
def q_gate(spark, sf):
    g = D.weekly_gate(D.weekly_report(features(spark, sf).clean, WEEK1, BASELINES))
    return g.select("week", rnd("jsd", 6).alias("jsd"), rnd("ndcg", 6).alias("ndcg"), "action", "retrained", "promoted",
                    rnd("best_after", 6).alias("best_after"))


# R17 with stored state: two weeks in one run, the rest in the next, the second judged again in a third.
@register("weekly_state_resumed", "WITH RECURSIVE " + with_(FEATURES)[len("WITH "):] + WEEKLY + WK + f""",
g AS (
  SELECT {_gate_sql("CAST(0.0 AS DOUBLE)")}, CAST(0.0 AS DOUBLE) AS best_before FROM wk w WHERE w.week = 1
  UNION ALL
  SELECT {_gate_sql("g.best_after")}, g.best_after AS best_before FROM g JOIN wk w ON w.week = g.week + 1)
SELECT week, n_events, n_sessions, round(wk.jsd, 6) AS jsd, round(wk.ndcg, 6) AS ndcg, round(hr_20, 6) AS hr_20, action,
       CASE WHEN action IN ('promoted', 'not_promoted') THEN round(wk.ndcg - best_before, 6) END AS improvement,
       action IN ('trained_no_eval', 'promoted', 'not_promoted') AS retrained, action = 'promoted' AS promoted, round(best_after, 6) AS best_after
FROM g JOIN wk USING (week)""")
def q_state(spark, sf):
    clean, state = features(spark, sf).clean, scratch_path(spark, f"weekly-state-{uuid.uuid4().hex}")
    S.advance(clean, state, WEEK1, BASELINES, weeks=[1, 2])
    S.advance(clean, state, WEEK1, BASELINES)
    out = S.advance(clean, state, WEEK1, BASELINES, weeks=[2], redo=[2])
    return out.select("week", "n_events", "n_sessions", "action", "retrained", "promoted",
                      *[rnd(c, 6).alias(c) for c in ("jsd", "ndcg", "hr_20", "improvement", "best_after")])
