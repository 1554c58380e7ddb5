"""Results must not depend on the number of shuffle partitions."""

from pyspark.sql import functions as F

from clickloom.operators import cleaning as C
from clickloom.operators import negatives as N
from clickloom.operators import ordering as O
from clickloom.sources.testdata import clickstream, table

SF = "/root/testdata/sf0.001"


def _rows(df):
    return sorted(tuple(r) for r in df.collect())


def test_same_results_for_different_partition_counts(spark):
    cs = clickstream(spark, SF)
    items = spark.createDataFrame([(i, 1 + i % 4, i % 3, 0) for i in range(1, 60)],
                                  "item_idx long, cat_l2_idx long, price_bucket long, brand_idx long")
    pairs = table(spark, SF, "events").select(F.col("user_id").alias("user_idx"),
                                              (F.col("event_id") % 59 + 1).alias("item_idx")).distinct()
    out = []
    for n in ("3", "11"):
        spark.conf.set("spark.sql.shuffle.partitions", n)
        out.append((_rows(C.clean_events(cs)),
                    _rows(O.dense_index(cs.select("user_session"), "user_session", "i", num_partitions=int(n))),
                    _rows(N.hard_negatives(pairs, items)),
                    _rows(O.exact_quantiles(cs, "price", [0.1, 0.5, 0.9], num_partitions=int(n)))))
    spark.conf.set("spark.sql.shuffle.partitions", "8")
    assert out[0] == out[1]
