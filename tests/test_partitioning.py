"""Partition columns: pinned values, agreement with DuckDB, and properties."""

import duckdb
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from orderpulse.functions.partitioning import customer_partition, digits_mod, hash_partition
from orderpulse.plans import oracle as O

AVAILABLE = [0, 1, 2, 4, 5, 7]
# Key, partition by hash, partition by customer digits (computed once with DuckDB).
PINNED = [('customer:123', 2, 4), ('abc', 0, 0), ('', 5, 5), ('42:customer:7', 1, 1), ('no digits at all', 4, 4), ('ключ', 5, 5), (None, 0, 0)]


def partitions(spark, keys, available):
    df = spark.createDataFrame([(i, k) for i, k in enumerate(keys)], "i long, key string")
    rows = df.select("i", hash_partition(F.col("key"), available).alias("h"),
                     customer_partition(F.col("key"), available).alias("c")).orderBy("i").collect()
    return [(r.h, r.c) for r in rows]


def test_pinned_partitions(spark):
    assert partitions(spark, [k for k, _, _ in PINNED], AVAILABLE) == [(h, c) for _, h, c in PINNED]


def test_no_available_partitions(spark):
    df = spark.createDataFrame([(k,) for k in ["a", None, "7"]], "key string")
    got = df.select(hash_partition(F.col("key"), []).alias("h"), customer_partition(F.col("key"), []).alias("c"))
    assert {(r.h, r.c) for r in got.collect()} == {(0, 0)}


def test_digits_mod_exact_for_long_numbers(spark):
    digits = "12345678901234567890123456789012345678901234567890"
    df = spark.createDataFrame([(digits,)], "d string")
    for n in (6, 97, 2 ** 31 - 1):
        assert df.select(digits_mod(F.col("d"), n).alias("m")).first().m == int(digits) % n


KEYS = st.lists(st.one_of(st.none(), st.text(max_size=30), st.from_regex(r"customer:[0-9]{1,30}", fullmatch=True)),
                min_size=1, max_size=60)


def test_partitioners_agree_with_duckdb(spark):
    @settings(max_examples=5, deadline=None)
    @given(KEYS, st.lists(st.integers(0, 63), min_size=1, max_size=9, unique=True))
    def check(keys, available):
        keys = [k.replace("\x00", "") if k else k for k in keys]
        con = duckdb.connect()
        con.execute("create table k (i bigint, key varchar)")
        con.executemany("insert into k values (?, ?)", list(enumerate(keys)))
        want = con.execute(f"select {O.hash_partition_sql('key', available)}, "
                           f"{O.customer_partition_sql('key', available)} from k order by i").fetchall()
        assert partitions(spark, keys, available) == want

    check()


def test_partitions_come_from_the_list_and_follow_its_order(spark):
    @settings(max_examples=4, deadline=None)
    @given(KEYS, st.permutations(list(range(10, 16))))
    def check(keys, available):
        plain, permuted = partitions(spark, keys, list(range(6))), partitions(spark, keys, available)
        assert [(available[h], available[c]) for h, c in plain] == permuted

    check()
