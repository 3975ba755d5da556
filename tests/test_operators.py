"""Operators against brute force on small inputs."""

import random

from pyspark.sql import Window
from pyspark.sql import functions as F

from civicflow.operators.ordering import rank_leq


def test_rank_leq_matches_window_rank(spark):
    rnd = random.Random(7)
    rows = [(i, rnd.choice([None, 1, 2, 3, 5, 5, 8, 13, 21]) if i % 3 else rnd.randint(0, 9))
            for i in range(300)]
    df = spark.createDataFrame(rows, "id int, v int")
    for k in (1, 3, 20):
        fast = {(r["id"], r["rank"]) for r in rank_leq(df, "v", k).collect()}
        w = Window.orderBy(F.col("v").desc_nulls_last())
        slow = {(r["id"], r["rank"]) for r in
                df.withColumn("rank", F.rank().over(w)).filter(F.col("rank") <= k).collect()}
        assert fast == slow


def test_name_network_matches_pair_join(tables):
    from civicflow.plans.stress import cx_name_network
    li = tables["lobbyist_identity"].alias("li")
    ep = tables["entrusted_person"].alias("ep")
    other = tables["lobbyist_identity"].alias("o")
    brute = (li.join(ep, F.col("li.last_name") == F.col("ep.last_name"))
             .join(other, F.col("ep.identity_id") == F.col("o.id"))
             .filter(F.col("li.entry_id") != F.col("o.entry_id"))
             .select(F.col("li.entry_id"), F.col("li.last_name")).distinct())
    assert sorted(map(tuple, cx_name_network(tables).collect())) == \
        sorted(map(tuple, brute.collect()))


def test_top_k_per_group_matches_row_number(spark):
    from civicflow.operators.ordering import top_k_per_group
    rnd = random.Random(3)
    rows = [(rnd.choice([1, 1, 1, 1, 2, 3]), rnd.randint(0, 50), i) for i in range(500)]
    df = spark.createDataFrame(rows, "g int, v int, i int")
    fast = sorted(map(tuple, top_k_per_group(df, ["g"], 5, F.col("v").desc(),
                                             F.col("i")).collect()))
    w = Window.partitionBy("g").orderBy(F.col("v").desc(), F.col("i"))
    slow = sorted(map(tuple, df.withColumn("r", F.row_number().over(w))
                      .filter(F.col("r") <= 5).drop("r").collect()))
    assert fast == slow


def test_lag_by_matches_window_lag_with_hot_key(spark):
    from civicflow.operators.ordering import lag_by
    rnd = random.Random(11)
    rows = [(0 if i % 3 else rnd.randint(1, 20), rnd.randint(2000, 2030), i, rnd.randint(0, 99))
            for i in range(900)]
    df = spark.createDataFrame(rows, "k int, y int, id int, v int")
    w = Window.partitionBy("k").orderBy("y", "id")
    slow = sorted(map(tuple, df.withColumn("p", F.lag("v").over(w)).collect()))
    fast = sorted(map(tuple, lag_by(df, "k", ["y", "id"], "v", "p").collect()))
    assert fast == slow
