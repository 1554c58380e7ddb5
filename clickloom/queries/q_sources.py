"""Source/sink queries."""

from __future__ import annotations

import uuid

from pyspark.sql import functions as F

from clickloom.functions.columns import normalise_brand, rnd, title_brand
from clickloom.queries import register
from clickloom.queries.common import features
from clickloom.queries.sql_base import CLICKSTREAM, FEATURES, INTERACTIONS_OF, ORDER_EVENTS, secs, with_
from clickloom.session import scratch_path
from clickloom.sources import files as Fl
from clickloom.sources.testdata import clickstream, order_interactions, table


@register("clickstream_events", with_(CLICKSTREAM) + "\nSELECT * FROM clickstream")
def q_clickstream(spark, sf):
    return clickstream(spark, sf)


# Raw CSV round trip: written in the raw layout (second precision, zone text),
# read back with the fixed schema, parsed with the zone; epoch seconds are
# compared so the result does not depend on the session time zone.
@register("csv_roundtrip_events", with_(CLICKSTREAM) + f"""
SELECT {secs('event_time')} AS event_epoch, event_type, product_id, category_id, category_code, brand, price,
       user_id, user_session, CAST(NULL AS VARCHAR) AS _corrupt_record
FROM clickstream""")
def q_csv(spark, sf):
    path = scratch_path(spark, f"raw-csv-{uuid.uuid4().hex}")
    Fl.write_raw_csv(clickstream(spark, sf), path)
    raw = Fl.parse_event_time(Fl.read_raw_csv(spark, path))
    return raw.select(F.unix_timestamp("event_time").alias("event_epoch"),
                      *[c for c in raw.columns if c not in ("event_time",)])


@register("month_window_loader", with_(ORDER_EVENTS) + """
SELECT user_id, event_time, price, event_type, l_orderkey, l_linenumber, product_id AS item_id FROM oi
WHERE event_time >= TIMESTAMP '1998-07-01' AND event_time < TIMESTAMP '1998-08-01'""")
def q_month(spark, sf):
    return Fl.load_month_window(order_interactions(spark, sf), "1998-07")


@register("parquet_export_interactions",
          with_(CLICKSTREAM + ",\ninter AS (" + INTERACTIONS_OF.format(src="clickstream") + ")") +
          "\nSELECT * FROM inter")
def q_export(spark, sf):
    from clickloom.operators.interactions import interactions
    path = scratch_path(spark, f"export-{uuid.uuid4().hex}")
    cols = ["user_id", "product_id", "confidence_score", "n_views", "n_carts", "n_purchases",
            F.col("first_interaction").cast("timestamp_ntz").alias("first_interaction"),
            F.col("last_interaction").cast("timestamp_ntz").alias("last_interaction")]
    Fl.export_parquet(interactions(clickstream(spark, sf)), path, cols, order_by=["user_id", "product_id"])
    return spark.read.parquet(path)


# Preset items always present in the catalogue (a parameter of the catalog build).
PRESET_ITEMS = ("7", "42", "77")


# str.title by runs of letters; acronyms as they are listed.
TITLE_SQL = r"""CASE WHEN brand = '' THEN 'Unknown' ELSE array_to_string(list_transform(
            list_filter(string_split_regex(brand, '\s+'), lambda w: w <> ''),
            lambda w: CASE WHEN w IN ('lg', 'hp', 'aeg', 'tcl', 'bmw', 'kia', 'cpu', 'ssd', 'led', 'rgb', 'usb',
                                      'hdmi', 'tv', 'jbl', 'msn') THEN upper(w)
                           ELSE array_to_string(list_transform(regexp_extract_all(w, '\p{L}+|[^\p{L}]+'),
                                                               lambda r: upper(r[1]) || r[2:]), '') END), ' ') END"""


# Brands with hyphens, apostrophes, digits, acronyms and accents.
@register("brand_display_forms", """
WITH b AS (SELECT DISTINCT trim(lower(x)) AS brand FROM (
  SELECT unnest([p_brand, replace(p_brand, '#', '-d-'), 'l' || chr(39) || p_brand, substr(p_brand, 7) || 'm tv', 'hp  ' || p_brand,
                 'é' || p_brand, '']) AS x
  FROM part))
SELECT brand, """ + TITLE_SQL + """ AS brand_display FROM b""")
def q_brands(spark, sf):
    b = F.col("p_brand")
    forms = F.array(b, F.replace(b, F.lit("#"), F.lit("-d-")), F.concat(F.lit("l'"), b), F.concat(F.substring(b, 7, 100), F.lit("m tv")),
                    F.concat(F.lit("hp  "), b), F.concat(F.lit("é"), b), F.lit(""))
    raw = table(spark, sf, "part").select(F.explode(forms).alias("raw"))
    brands = raw.select(normalise_brand(F.col("raw")).alias("brand")).distinct()
    return brands.withColumn("brand_display", title_brand(F.col("brand")))


CATALOG_SQL = with_(FEATURES) + """,
ranked AS (SELECT CAST(product_id AS VARCHAR) AS item_id, coalesce(cat_l1, 'unknown') AS c1,
                  coalesce(cat_l2, 'unknown') AS c2, trim(lower(coalesce(brand, ''))) AS brand,
                  round(avg_price, 2) AS price, CAST(item_total_confidence AS BIGINT) AS interactions
           FROM item_feats),
top AS (SELECT * FROM ranked ORDER BY interactions DESC, item_id LIMIT {n}),
pre AS (SELECT * FROM ranked WHERE item_id IN ('7', '42', '77') AND item_id NOT IN (SELECT item_id FROM top)),
cat AS (SELECT * FROM top UNION ALL SELECT * FROM pre)
SELECT *, {title} AS brand_display
FROM cat"""


def _catalog_sql(n):
    return CATALOG_SQL.replace("{n}", str(n)).replace("{title}", TITLE_SQL)


@register("catalog_entries", _catalog_sql(2000))
def q_catalog(spark, sf, n=2000):
    it = features(spark, sf).items
    ranked = it.select(F.col("product_id").cast("string").alias("item_id"),
                       F.coalesce("cat_l1", F.lit("unknown")).alias("c1"),
                       F.coalesce("cat_l2", F.lit("unknown")).alias("c2"),
                       normalise_brand(F.col("brand")).alias("brand"), rnd("avg_price", 2).alias("price"),
                       F.col("item_total_confidence").cast("long").alias("interactions"))
    top = ranked.orderBy(F.desc("interactions"), F.asc("item_id")).limit(n)
    pre = ranked.filter(F.col("item_id").isin(list(PRESET_ITEMS))).join(top.select("item_id"), "item_id",
                                                                       "left_anti")
    cat = top.unionByName(pre)
    return cat.withColumn("brand_display", title_brand(F.col("brand")))


# A list so short that presets lie outside it.
@register("catalog_entries_top10", _catalog_sql(10))
def q_catalog_top10(spark, sf):
    return q_catalog(spark, sf, 10)


@register("catalog_json_lines", f"""
SELECT CAST(to_json({{'item_id': item_id, 'e': {{'c1': c1, 'c2': c2, 'brand': brand_display, 'price': price}}}}) AS VARCHAR) AS json
FROM ({_catalog_sql(2000)})""")
def q_catalog_json(spark, sf):
    cat = q_catalog(spark, sf)
    entries = cat.select("item_id", F.struct("c1", "c2", F.col("brand_display").alias("brand"), "price").alias("e"))
    return Fl.to_json_lines(entries)
