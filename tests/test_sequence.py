"""Skew-safe previous-row operator equals the plain window, also with one hot key."""

import random

from orderpulse.operators.sequence import with_previous, with_previous_window


def test_previous_matches_window_with_hot_key(spark):
    rng = random.Random(3)
    rows = []
    for i in range(3000):
        key = 0 if i % 3 == 0 else rng.randint(1, 40)  # key 0 holds a third of the rows
        ts = None if rng.random() < 0.02 else rng.randint(0, 500)
        rows.append((key, ts, f"{i:05d}", rng.choice(["A", "B", None])))
    df = spark.createDataFrame(rows, "k long, ts long, id string, v string")
    got = with_previous(df, "k", ["ts", "id"], ["v"], num_partitions=8)
    want = with_previous_window(df, "k", ["ts", "id"], ["v"])
    cols = ["k", "ts", "id", "v", "prev_v", "has_prev"]
    g = sorted((tuple(r) for r in got.select(*cols).collect()), key=repr)
    w = sorted((tuple(r) for r in want.select(*cols).collect()), key=repr)
    assert g == w
    # the hot key really was spread over several range partitions
    from pyspark.sql import functions as F

    parts = (df.repartitionByRange(8, "k", "ts", "id").where("k = 0")
             .select(F.spark_partition_id().alias("p")).distinct().count())
    assert parts > 1


def rows_of(df, *cols):
    return sorted((tuple(r) for r in df.select(*cols).collect()), key=repr)


def test_previous_is_exact_for_64_bit_keys_and_values(spark):
    base = 1_800_000_000_000_000_000
    rows = [(base + k, i, None if i == 1 else 2 ** 53 + i + k) for k in range(50) for i in range(3)]
    df = spark.createDataFrame(rows, "k long, ts long, v long")
    got = with_previous(df, "k", ["ts"], ["v"], num_partitions=4)
    want = with_previous_window(df, "k", ["ts"], ["v"])
    cols = ["k", "ts", "v", "prev_v", "has_prev"]
    assert rows_of(got, *cols) == rows_of(want, *cols)


def test_previous_survives_coalesce_and_union(spark):
    df = spark.createDataFrame([(i % 7, i, f"v{i}") for i in range(300)], "k long, ts long, v string")
    got = with_previous(df, "k", ["ts"], ["v"], num_partitions=8)
    cols = ["k", "ts", "v", "prev_v", "has_prev"]
    want = rows_of(with_previous_window(df, "k", ["ts"], ["v"]), *cols)
    assert rows_of(got.coalesce(2), *cols) == want
    assert rows_of(got.limit(0).unionByName(got), *cols) == want


def test_previous_of_empty_and_null_keys(spark):
    df = spark.createDataFrame([(None, 1, "a"), (None, 2, "b"), (1, None, "c"), (1, 1, None), (1, 2, "e")],
                               "k long, ts long, v string")
    cols = ["k", "ts", "v", "prev_v", "has_prev"]
    got = with_previous(df, "k", ["ts"], ["v"], num_partitions=3)
    assert rows_of(got, *cols) == rows_of(with_previous_window(df, "k", ["ts"], ["v"]), *cols)
    assert with_previous(df.limit(0), "k", ["ts"], ["v"], num_partitions=3).count() == 0
