import os
import uuid

import pytest
from pyspark.sql import functions as F

from clickloom.operators import features as Fe
from clickloom.operators import interactions as I
from clickloom.session import cut_lineage
from clickloom.sources import files as Fl
from tests.helpers import events


def plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


def exchanges_by(df, column):
    return [line.strip() for line in plan(df).splitlines() if "Exchange hashpartitioning" in line and column in line]


@pytest.fixture(scope="module")
def stored(spark, tmp_path_factory):
    rows = [(37 * i % 90000, ("view", "cart", "purchase")[i % 3], i % 11, i * i % 23, f"s{i % 40}") for i in range(600)]
    plain = events(spark, rows)
    names, folder = [], tmp_path_factory.mktemp("bucketed")

    def store(df, buckets=4):
        name = f"clickloom_{uuid.uuid4().hex}"
        Fl.save_bucketed(df, name, "user_id", buckets, path=str(folder / name))
        names.append(name)
        return spark.table(name)
    yield plain, store(plain), store, folder
    for name in names:
        spark.sql(f"DROP TABLE {name}")


def same(a, b):
    return sorted(map(str, a.collect())) == sorted(map(str, b.collect()))


def test_one_sorted_file_a_bucket(stored):
    plain, table, _, folder = stored
    assert same(table, plain)
    files = [f for name in os.listdir(folder) for f in os.listdir(folder / name) if f.endswith(".parquet")]
    assert len(files) == 4


def test_interactions_by_user_have_no_exchange(stored):
    plain, table, _, _ = stored
    got = I.interactions(table)
    assert same(got, I.interactions(plain)) and "Exchange" not in plan(got) and exchanges_by(I.interactions(plain), "user_id")


def test_user_features_shuffle_nothing_by_user(stored):
    plain, table, _, _ = stored
    items = cut_lineage(Fe.item_features(plain, I.interactions(plain)))  # a small table of known size: Spark broadcasts it
    got = Fe.user_features(table, items)
    assert same(got, Fe.user_features(plain, items)) and exchanges_by(got, "user_id") == []
    assert len(exchanges_by(Fe.user_features(plain, items), "user_id")) >= 3


def test_tables_of_one_key_join_in_place(stored, spark):
    plain, table, store, _ = stored
    users = store(plain.groupBy("user_id").agg(F.count(F.lit(1)).alias("n")))
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", -1)
    try:
        got = table.join(users, "user_id")
        assert "Exchange" not in plan(got) and got.count() == 600
        other = store(plain.groupBy("user_id").agg(F.count(F.lit(1)).alias("n")), buckets=3)
        assert "Exchange" in plan(table.join(other, "user_id"))
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
