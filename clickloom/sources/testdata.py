"""Readers for the driver tables and the adapter to the clickstream schema.

The clickstream schema (one row per event) is::

    event_time timestamp, event_type string, product_id long, category_id long,
    category_code string, brand string, price double, user_id long,
    user_session string

Mapping from the test tables (see FIXTURES.md):
  * ``events.ts`` -> event_time, ``events.value`` -> price
  * event type: view -> view, click -> cart, purchase -> purchase; signup and error
    stay as they are, types the library does not know: operators filter them
  * product_id = ``props.k``; brand and category come from ``part``
  * category_code = lower(p_type) || '.' || last word of p_name
  * user_session: per-user inactivity gap (default 12 h), numbered 1, 2, ...
"""

from __future__ import annotations

import os

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from clickloom.functions.columns import attach
from clickloom.operators.ordering import HOT_ROWS, hot_keys, previous_within, running_sum
from clickloom.session import cut_lineage

TABLES = ("region", "nation", "customer", "supplier", "part", "orders", "lineitem",
          "events", "documents", "embeddings", "pages", "benchmark", "labels",
          "conversations")

# Event-type renaming from the test tables to the clickstream vocabulary.
EVENT_TYPE_RENAME = {"view": "view", "click": "cart", "purchase": "purchase"}
# Return flag of a line item -> event type (orders x lineitem clickstream): N view, A cart, R purchase.

DEFAULT_SESSION_GAP_SECONDS = 12 * 3600

CLICKSTREAM_COLUMNS = ["event_time", "event_type", "product_id", "category_id",
                       "category_code", "brand", "price", "user_id", "user_session"]


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(os.path.join(sf_dir, f"{name}.parquet"))


def _renamed_type(col: str) -> F.Column:
    expr = F.col(col)
    for src, dst in EVENT_TYPE_RENAME.items():
        expr = F.when(F.col(col) == src, F.lit(dst)).otherwise(expr)
    return expr


def sessionize(df: DataFrame, user_col: str, ts_col: str, tiebreak: list[str] | str,
               gap_seconds: int, out: str = "session_no", bucket_seconds: int | None = None,
                hot_rows: int = HOT_ROWS) -> DataFrame:
    """Numbers sessions per user: a new session starts at a user's first event
    or after more than ``gap_seconds`` of inactivity (whole-second gaps).

    Both the gap test and the running count are windows over the user's events
    in one order: one shuffle, one sort. Users of more than ``hot_rows`` events,
    if there are any, are cut into time buckets instead, by one pass per (user,
    time bucket) with the bucket tails copied forward (``previous_within``) and
    the buckets' counts added up (``running_sum``).
    """
    bucket = bucket_seconds or max(2 * gap_seconds, 3600)
    tb = [tiebreak] if isinstance(tiebreak, str) else list(tiebreak)
    timed = df.withColumn("_secs", F.unix_timestamp(F.col(ts_col)))
    apart = (F.col("_secs") - F.col("_p._secs")) > gap_seconds
    if hot_keys(df, [user_col], hot_rows) is None:
        w = Window.partitionBy(user_col).orderBy(ts_col, *tb)
        # rows without a time come first and are a session of their own
        start = F.col("_p").isNull() | (F.col("_p._secs").isNull() & F.col("_secs").isNotNull()) | apart
        upto = w.rowsBetween(Window.unboundedPreceding, Window.currentRow)
        marked = timed.withColumn("_p", F.lag(F.struct("_secs")).over(w)).withColumn("_v", start.cast("long"))
        return marked.withColumn(out, F.sum("_v").over(upto)).drop("_p", "_secs", "_v")
    with_prev = previous_within(timed, user_col, ts_col, tb, ["_secs"], gap_seconds, out="_p", bucket_seconds=bucket)
    start = (F.col("_p").isNull() | apart).cast("long")
    return running_sum(with_prev.drop("_tb"), user_col, ts_col, tb, start, out, bucket_seconds=bucket,
                       hot_rows=hot_rows).drop("_p", "_secs")


_MATERIALISED: dict = {}


def input_version(spark: SparkSession, sf_dir: str, names: tuple[str, ...] = ("events", "part")) -> tuple:
    """Lengths and modification times of the tables' paths: what is kept for one
    version of the input is not used for the next."""
    out = []
    for name in names:
        path = spark._jvm.org.apache.hadoop.fs.Path(os.path.join(sf_dir, f"{name}.parquet"))
        status = path.getFileSystem(spark._jsc.hadoopConfiguration()).getFileStatus(path)
        out.append((status.getLen(), status.getModificationTime()))
    return tuple(out)


def clickstream(spark: SparkSession, sf_dir: str,
                gap_seconds: int = DEFAULT_SESSION_GAP_SECONDS, keep_event_id: bool = False) -> DataFrame:
    """Events of the test tables in the clickstream schema.

    The adapted table is materialised once per Spark application and input
    directory (checkpoint folder) and reused by later queries, like a stored
    upstream table of a pipeline."""
    key = (spark.sparkContext.applicationId, sf_dir, input_version(spark, sf_dir), gap_seconds, keep_event_id)
    if key not in _MATERIALISED:
        _MATERIALISED[key] = _build_clickstream(spark, sf_dir, gap_seconds, keep_event_id)
    return _MATERIALISED[key]


def _build_clickstream(spark: SparkSession, sf_dir: str, gap_seconds: int, keep_event_id: bool) -> DataFrame:
    ev = (table(spark, sf_dir, "events")
          .select("event_id", "ts", "user_id", "event_type", "value", "props")
          .select("event_id", F.col("ts").alias("event_time"), "user_id",
                  _renamed_type("event_type").alias("event_type"),
                  F.col("value").alias("price"),
                  F.get_json_object("props", "$.k").cast("long").alias("product_id")))
    part = (table(spark, sf_dir, "part")
            .select(F.col("p_partkey").alias("product_id"),
                    F.col("p_size").cast("long").alias("category_id"),
                    F.concat(F.lower("p_type"), F.lit("."),
                             F.regexp_extract("p_name", r"([^ ]+)$", 1)).alias("category_code"),
                    F.col("p_brand").alias("brand")))
    # the sessions first, on the events' own narrow columns; of part only what the
    # events name, stored: it is broadcast, without a hint, where that is little
    sess = sessionize(ev, "user_id", "event_time", ["event_id"], gap_seconds)
    part = cut_lineage(part.join(ev.select("product_id").distinct(), "product_id", "left_semi"))
    sess = sess.join(part, "product_id", "left")
    out = sess.withColumn("user_session",
                          F.concat(F.col("user_id").cast("string"), F.lit("-"),
                                   F.col("session_no").cast("string")))
    cols = CLICKSTREAM_COLUMNS + (["event_id"] if keep_event_id else [])
    # materialised once: every later step (and every self-join in it) starts
    # from this table instead of re-running the scan, join and sessionization
    return cut_lineage(out.select(*cols))


def order_interactions(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A larger, multi-year clickstream from orders x lineitem (FIXTURES C):
    customer as user, part as item, order date as time, price from the line,
    event type from the return flag. Used where month-level splits are needed."""
    o = table(spark, sf_dir, "orders").select("o_orderkey", "o_custkey", "o_orderdate")
    li = table(spark, sf_dir, "lineitem").select("l_orderkey", "l_partkey", "l_linenumber",
                                                  "l_extendedprice", "l_returnflag")
    return (li.join(o, li.l_orderkey == o.o_orderkey)
            .select(F.col("o_custkey").alias("user_id"), F.col("l_partkey").alias("product_id"),
                    F.col("o_orderdate").alias("event_time"),
                    F.col("l_extendedprice").alias("price"),
                    F.when(F.col("l_returnflag") == "N", F.lit("view"))
                    .when(F.col("l_returnflag") == "A", F.lit("cart"))
                    .otherwise(F.lit("purchase")).alias("event_type"),
                    "l_orderkey", "l_linenumber"))


def dirty_clickstream(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The clickstream with the faults a raw log has, each derived from the rows
    themselves, so that every cleaning step has work at any scale:

    * purchases come twice, the second time at a higher price (exact duplicates);
    * carts come again a second later (near duplicates);
    * items of category 1 to 10 have no brand and no category code, those of
      category 11 to 13 no session;
    * errors cost a hundredth (below the price floor);
    * the user with the smallest id repeats each event 60 times, 20 s apart (a bot).
    """
    c = clickstream(spark, sf_dir)
    later = lambda s: (F.col("event_time") + F.make_dt_interval(secs=s)).alias("event_time")
    rest = [x for x in CLICKSTREAM_COLUMNS if x != "event_time"]
    twice = c.filter(F.col("event_type") == "purchase").withColumn("price", F.col("price") + 1)
    again = c.filter(F.col("event_type") == "cart").select(later(F.lit(1.0)), *rest).select(*CLICKSTREAM_COLUMNS)
    first = c.agg(F.min("user_id").alias("first"))
    bot = (attach(c, first).filter(F.col("user_id") == F.col("first")).drop("first")
           .withColumn("_n", F.explode(F.sequence(F.lit(1), F.lit(60))))
           .select(later(F.col("_n") * 20.0), *rest).select(*CLICKSTREAM_COLUMNS))
    every = c.unionByName(twice).unionByName(again).unionByName(bot)
    bare = F.col("category_id").between(1, 10)
    return (every.withColumn("brand", F.when(~F.coalesce(bare, F.lit(False)), F.col("brand")))
            .withColumn("category_code", F.when(~F.coalesce(bare, F.lit(False)), F.col("category_code")))
            .withColumn("user_session", F.when(~F.coalesce(F.col("category_id").between(11, 13), F.lit(False)), F.col("user_session")))
            .withColumn("price", F.when(F.col("event_type") == "error", F.col("price") / 100).otherwise(F.col("price")))
            .select(*CLICKSTREAM_COLUMNS))
