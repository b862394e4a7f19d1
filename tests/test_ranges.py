"""Even ranges: every row in one part, parts of like size, pushed down."""

import random
from datetime import datetime

import pytest
from pyspark.sql import functions as F

from casemill.plans import derived as D
from casemill.session import scratch_path
from casemill.sources.jdbc import read_jdbc_even, write_jdbc_table
from casemill.sources.ranges import even_bounds, even_parts, range_predicates
from helpers import SF_SMALL


def sizes(parts):
    return [p.count() for p in parts]


def column(kind, n, r):
    if kind == "steep":
        return [int(1.02 ** r.randrange(1000)) * 10**6 + r.randrange(10**6) for _ in range(n)], "long"
    if kind == "prefix":
        return [f"a long shared prefix/{r.random() ** 4:.9f}" for _ in range(n)], "string"
    if kind == "time":
        return [datetime.fromtimestamp(1.7e9 + 1e7 * r.random() ** 5) for _ in range(n)], "timestamp"
    return [r.choice("äöü'\\xyz") * r.randrange(4) + "é" + str(r.random()) for _ in range(n)], "string"


@pytest.mark.parametrize("kind", ["steep", "prefix", "time", "quotes"])
def test_parts_are_even_and_take_each_row_once(spark, kind):
    r = random.Random(kind)
    values, ddl = column(kind, 4000, r)
    rows = [(i, None if i % 17 == 0 else v) for i, v in enumerate(values)]
    df = spark.createDataFrame(rows, f"i int, v {ddl}").repartition(7).cache()
    parts = even_parts(df, "v", 6)
    n = sizes(parts)
    assert len(n) == 6 and sum(n) == 4000 and max(n) <= 2 * min(n)
    ids = [x.i for p in parts for x in p.collect()]
    assert sorted(ids) == list(range(4000))
    if kind != "quotes":  # as SQL text too
        assert [df.where(p).count() for p in range_predicates("v", even_bounds(df, "v", 6))] == n


def test_hot_values_and_little_to_cut(spark):
    hot = spark.createDataFrame([(i, 5 if i % 3 else i) for i in range(3000)], "i int, v int")
    parts = even_parts(hot, "v", 8)
    assert sum(sizes(parts)) == 3000 and max(sizes(parts)) < 2600
    same = spark.createDataFrame([("x",)] * 20 + [(None,)], "v string")
    assert sizes(even_parts(same, "v", 4)) == [21]
    assert sizes(even_parts(same.where("v IS NULL"), "v", 4)) == [1] and sizes(even_parts(same.where("false"), "v", 4)) == [0]
    assert sizes(even_parts(hot, "v", 1)) == [3000]
    assert sizes(even_parts(spark.createDataFrame([("",), ("a",), ("a\0",), ("b",)], "v string"), "v", 4)) != [4]
    nan = spark.createDataFrame([(float("nan"),)] * 30 + [(float(i),) for i in range(10)] + [(None,)], "v double")
    assert sum(sizes(even_parts(nan, "v", 4))) == 41
    with pytest.raises(ValueError):
        even_bounds(hot, "v", 0)
    with pytest.raises(ValueError):
        even_bounds(hot.select(F.array("v").alias("v")), "v", 2)


def test_ranges_reach_the_parquet_scan(spark):
    folder = scratch_path(spark, "test-ranges")
    D.uneven_orders(spark, SF_SMALL).write.parquet(folder)
    part = even_parts(spark.read.parquet(folder), "steep", 4)[1].select("o_orderkey", "steep")
    plan = part._jdf.queryExecution().executedPlan().toString()
    assert "GreaterThanOrEqual(steep" in plan and "LessThan(steep" in plan and "label" not in plan


@pytest.mark.parametrize("column", ["LABEL", "AMOUNT"])
def test_even_jdbc_ranges(spark, column):
    url, driver = "jdbc:derby:memory:ranges;create=true", {"driver": "org.apache.derby.jdbc.EmbeddedDriver"}
    steep = lambda i: int(1.1 ** (i % 90))
    rows = [(i, f"n'{steep(i)}-{i}", None if i % 9 == 0 else 100 * steep(i) + i % 100) for i in range(900)]
    write_jdbc_table(spark.createDataFrame(rows, "ID int, LABEL string, AMOUNT int"), url, "labels", mode="overwrite",
                     column_types="LABEL varchar(64)", properties=driver)
    got = read_jdbc_even(spark, url, "labels", column, 5, properties=driver)
    per_task = [r.n for r in got.groupBy(F.spark_partition_id().alias("p")).agg(F.count("*").alias("n")).collect()]
    assert len(per_task) == 5 and sum(per_task) == 900 and max(per_task) <= 2 * min(per_task)
    assert sorted(r.ID for r in got.collect()) == list(range(900))
