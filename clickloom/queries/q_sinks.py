"""Sinks and loaders, written, read back and compared."""

from __future__ import annotations

import os
import uuid

from pyspark.sql import functions as F

from clickloom.queries import register
from clickloom.queries.common import features
from clickloom.queries.q_sources import TITLE_SQL, q_catalog
from clickloom.queries.sql_base import CLICKSTREAM, FEATURES, ORDER_EVENTS, secs, with_
from clickloom.session import cut_lineage, scratch_path
from clickloom.sources import files as Fl
from clickloom.sources import staged as St
from clickloom.sources.testdata import clickstream, order_interactions

RELOADED = "1995-06"


def _path(spark, name):
    return scratch_path(spark, f"{name}-{uuid.uuid4().hex}")


def _zoned(df):
    return df.withColumn("event_time", F.concat(F.date_format("event_time", "yyyy-MM-dd HH:mm:ss"), F.lit(" UTC")))


# Partitioned Parquet in a fixed number of files a partition.
@register("partitioned_sink", with_(FEATURES) + "\nSELECT * FROM labelled")
def q_partitioned(spark, sf):
    path = _path(spark, "split-events")
    Fl.write_parquet(features(spark, sf).labelled, path, n_files=3, partition_by=["split"])
    return spark.read.parquet(path)


# S7 + S8: a table is created, then replaced by another.
@register("replaced_table", with_(FEATURES) + "\nSELECT * FROM inter_train")
def q_replaced(spark, sf):
    f = features(spark, sf)
    name, path = f"clickloom_{uuid.uuid4().hex}", _path(spark, "external-table")
    Fl.save_table(f.clean.select("user_id", "product_id"), name, path=path)
    Fl.save_table(f.inter, name, path=path)
    return spark.table(name)


# JSON documents written, read back with their schema.
@register("catalog_json_read_back", with_(FEATURES) + """,
ranked AS (SELECT CAST(product_id AS VARCHAR) AS item_id, coalesce(cat_l1, 'unknown') AS c1,
                  coalesce(cat_l2, 'unknown') AS c2, trim(lower(coalesce(brand, ''))) AS brand,
                  round(avg_price, 2) AS price FROM item_feats)
SELECT item_id, c1, c2, """ + TITLE_SQL + """ AS brand, price FROM ranked""")
def q_json(spark, sf):
    path = _path(spark, "catalog-json")
    cat = q_catalog(spark, sf).select("item_id", F.struct("c1", "c2", F.col("brand_display").alias("brand"), "price").alias("e"))
    Fl.write_json(cat, path)
    back = spark.read.schema("item_id string, e struct<c1:string,c2:string,brand:string,price:double>").json(path)
    return back.select("item_id", "e.*")


# The artifacts of a directory, loaded by name.
@register("artifact_bundle", with_(FEATURES) + """
SELECT 'item_vocab' AS artifact, product_id AS id, CAST(item_idx AS BIGINT) AS idx FROM item_vocab
UNION ALL SELECT 'user_vocab', user_id, CAST(user_idx AS BIGINT) FROM user_vocab""")
def q_bundle(spark, sf):
    f = features(spark, sf)
    path = _path(spark, "bundle")
    Fl.write_parquet(f.item_vocab, os.path.join(path, "item_vocab"))
    Fl.write_parquet(f.user_vocab, os.path.join(path, "user_vocab"))
    b = Fl.load_bundle(spark, path, ["item_vocab", "user_vocab"])
    rows = lambda n, k, i: b[n].select(F.lit(n).alias("artifact"), F.col(k).alias("id"), F.col(i).alias("idx"))
    return rows("item_vocab", "product_id", "item_idx").unionByName(rows("user_vocab", "user_id", "user_idx"))


# S3: raw CSV restricted to the vocabularies; dirty ids (here: those of errors) are dropped.
@register("month_in_vocab", with_(FEATURES) + f"""
SELECT user_idx, item_idx, {secs('event_time')} AS event_epoch, event_type, price, user_session
FROM clickstream JOIN user_vocab USING (user_id) JOIN item_vocab USING (product_id) WHERE event_type <> 'error'""")
def q_in_vocab(spark, sf):
    f, path = features(spark, sf), _path(spark, "month-csv")
    item = F.col("product_id").cast("string")
    dirty = F.when(F.col("event_type") == "error", F.concat(item, F.lit("x"))).otherwise(item)
    _zoned(clickstream(spark, sf)).withColumn("product_id", dirty).write.option("header", True).csv(path)
    out = Fl.read_month_in_vocab(spark, path, f.user_vocab, f.item_vocab)
    return out.select("user_idx", "item_idx", F.unix_timestamp("event_time").alias("event_epoch"), "event_type", "price", "user_session")


# Bulk load with malformed rows (here: a price that is no number for every
# signup) counted and held against a tolerance.
@register("bulk_load_bad_records", with_(CLICKSTREAM) + """
SELECT count(*) AS n_rows, count_if(event_type = 'signup') AS n_bad, count_if(event_type <> 'signup') AS n_good,
       count_if(event_type = 'signup') AS n_counted_by_gate FROM clickstream""")
def q_bulk(spark, sf):
    path = _path(spark, "bulk-csv")
    price = F.when(F.col("event_type") == "signup", F.lit("no number")).otherwise(F.col("price").cast("string"))
    _zoned(clickstream(spark, sf)).withColumn("price", price).write.option("header", True).csv(path)
    back = Fl.read_raw_csv(spark, path)
    counted = Fl.check_bad_records(back, max_bad=clickstream(spark, sf).count())
    loaded, bad = cut_lineage(back), F.col(Fl.CORRUPT).isNotNull()
    return loaded.agg(F.count(F.lit(1)).alias("n_rows"), F.count_if(bad).alias("n_bad"), F.count_if(~bad).alias("n_good")).withColumn(
        "n_counted_by_gate", F.lit(counted).cast("long"))


# Files named by their month (here: by their split); the hold-out is routed
# away by name, unread.
@register("bulk_load_holdout_by_name", with_(FEATURES) + f"""
SELECT {secs('event_time')} AS event_epoch, event_type, product_id, price, user_id, user_session FROM labelled WHERE split <> 'test'""")
def q_holdout(spark, sf):
    labelled, target = features(spark, sf).labelled, _path(spark, "named-csv")
    for split in ("train", "val", "test"):
        path = _path(spark, f"csv-{split}")
        Fl.write_raw_csv(labelled.filter(F.col("split") == split), path)
        Fl.name_parts(spark, path, split, target)
    rest = Fl.parse_event_time(Fl.months_from_file_stem(Fl.read_raw_csv(spark, target), ["test"]))
    return rest.select(F.unix_timestamp("event_time").alias("event_epoch"), "event_type", "product_id", "price", "user_id", "user_session")


# A table replaced by a checked one, also where the new rows come from the old; a refused one changes nothing.
@register("replaced_table_checked", with_(FEATURES) + "\nSELECT * FROM inter_train WHERE confidence_score >= 2")
def q_replaced_checked(spark, sf):
    path, name = _path(spark, "replaced"), f"clickloom_{uuid.uuid4().hex}"
    St.replace_table(features(spark, sf).clean.select("user_id", "product_id"), name, path)
    St.replace_table(features(spark, sf).inter, name, path)
    St.replace_table(spark.table(name).where(F.col("confidence_score") >= 2), name, path)

    def refuse(df):
        raise ValueError("refused")
    try:
        St.replace_table(spark.table(name).limit(1), name, path, refuse)
    except ValueError:
        return spark.table(name)
    raise AssertionError("the check was not asked")


# A month of orders loaded again, the others' files as they were.
@register("month_reload_orders", with_(ORDER_EVENTS) + """
SELECT strftime(event_time, '%Y-%m') AS month, count(*) AS n, count_if(event_type = 'reloaded') AS n_reloaded FROM (
  SELECT event_time, CASE WHEN strftime(event_time, '%Y-%m') = '{month}' THEN 'reloaded' ELSE event_type END AS event_type FROM oi) GROUP BY 1""".replace(
    "{month}", RELOADED))
def q_reload(spark, sf):
    path = _path(spark, "by-month")
    orders = order_interactions(spark, sf).withColumn("month", F.date_format("event_time", "yyyy-MM"))
    St.reload_partitions(orders, path)
    St.reload_partitions(orders.where(F.col("month") == RELOADED).withColumn("event_type", F.lit("reloaded")), path, only=[RELOADED])
    found = spark.read.option("basePath", path).schema(orders.schema).parquet(path)
    return found.groupBy("month").agg(F.count(F.lit(1)).alias("n"), F.count_if(F.col("event_type") == "reloaded").alias("n_reloaded"))


# Good rows and rejects counted by the write itself, each in its table.
@register("bulk_load_gate", with_(CLICKSTREAM) + """
SELECT CASE WHEN event_type = 'signup' THEN 'rejected' ELSE 'loaded' END AS table_name, count(*) AS n_rows, count(*) AS n_observed,
       count(DISTINCT user_id) AS n_users FROM clickstream GROUP BY 1""")
def q_gate(spark, sf):
    source, path, quarantine = (_path(spark, p) for p in ("gate-csv", "gate-loaded", "gate-rejected"))
    price = F.when(F.col("event_type") == "signup", F.lit("no number")).otherwise(F.col("price").cast("string"))
    _zoned(clickstream(spark, sf)).withColumn("price", price).write.option("header", True).csv(source)
    n = St.load_csv(spark, source, path, quarantine, max_bad=1 << 40)
    table = lambda where, name, seen: spark.read.parquet(where).agg(
        F.count(F.lit(1)).alias("n_rows"), F.lit(seen).cast("long").alias("n_observed"), F.count_distinct("user_id").alias("n_users")).withColumn("table_name", F.lit(name))
    return table(path, "loaded", n["good"]).unionByName(table(quarantine, "rejected", n["bad"]))
