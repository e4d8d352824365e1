from __future__ import annotations

import random
from datetime import date
from decimal import Decimal

import pytest
from pyspark.sql import functions as F

from martwright.functions.enrich import enrich_customers, enrich_products
from martwright.plans.marts import MARTS, REPORTS, TOTAL, over_master, over_star, placed, profit_rollup, run_report
from martwright.plans.star import (
    CUSTOMER_COLUMNS,
    ORDER_COLUMNS,
    PRODUCT_COLUMNS,
    measured,
    measured_star,
    sales_master,
    star,
)

ALL = {**MARTS, **REPORTS}


def order_frame(spark, lines):
    """(order, day, customer, product, quantity, price, discount, profit)"""
    money = [tuple(Decimal(v).quantize(Decimal("0.01")) for v in line[5:7]) for line in lines]
    records = [
        (i, f"O{o}", day, day, "Air", c, p, q, *pair, None if z is None else Decimal(z).quantize(Decimal("0.0001")),
         "run", "orders", "o.json", None, None)
        for i, ((o, day, c, p, q, _, _, z), pair) in enumerate(zip(lines, money, strict=True))
    ]
    types = ["int", "string", "date", "date", "string", "string", "string", "int", "decimal(18,2)",
             "decimal(4,2)", "decimal(18,4)", "string", "string", "string", "timestamp", "date"]
    schema = ", ".join(f"{n} {t}" for n, t in zip(ORDER_COLUMNS, types, strict=True))
    return spark.createDataFrame(records, schema)


def customer_frame(spark, lines):
    records = [(c, name, "Seg", "Ctry", city, "St", "1", "south", "Addr") for c, name, city in lines]
    return enrich_customers(spark.createDataFrame(
        records, "customer_id string, customer_name string, segment string, country string, "
        "city string, state string, postal_code string, region string, address string"))


def product_frame(spark, lines):
    records = [(p, cat, sub, f"name {p}", 1.5) for p, cat, sub in lines]
    return enrich_products(spark.createDataFrame(
        records, "product_id string, category string, sub_category string, product_name string, "
        "price_per_product double"))


def random_star(spark, seed, repeated, hot=0):
    rng = random.Random(seed)
    lines = []
    for _ in range(300):
        customer = "C0" if rng.random() < hot else rng.choice([None, *[f"C{i}" for i in range(12)]])
        product = rng.choice([None, *[f"P{i}" for i in range(8)]])
        day = date(2015 + rng.randrange(3), 1 + rng.randrange(2), 1)
        lines.append((rng.randrange(60), day, customer, product, rng.randrange(9),
                      rng.randrange(999), rng.choice(["0", "0.1", "0.25"]), str(rng.uniform(-9, 9))))
    people = [(f"C{i}", f"N{i % 5}", f"T{i % 3}") for i in range(9)] + [(None, "Nobody", "T0")]
    goods = [(f"P{i}", f"cat {i % 3}", f"sub {i % 4}") for i in range(6)] + [(None, "none", "none")]
    if repeated:
        people += [("C1", "N1", "T1"), ("C2", "Other", "T2"), ("C3", "N3", "T9"), ("C3", "N3", "T9")]
        goods += [("P1", "cat 1", "sub 1"), ("P2", "elsewhere", "sub 2")]
    return star(order_frame(spark, lines), customer_frame(spark, people), product_frame(spark, goods))


def test_sales_master_row(spark):
    source = star(
        order_frame(spark, [(1, date(2016, 8, 21), "C1", "P1", 2, 1200, "0.1", "1200.567")]),
        customer_frame(spark, [("C1", "John", "Bangalore")]),
        product_frame(spark, [("P1", "technology", "phones")]),
    )
    master = sales_master(source)
    assert master.columns == [*ORDER_COLUMNS, *CUSTOMER_COLUMNS, *PRODUCT_COLUMNS]
    row = master.first()
    assert (row.profit, row.customer_name, row.customer_region) == (Decimal("1200.57"), "John", "SOUTH")
    assert (row.product_category, row.category_name) == ("technology", "Technology")
    assert row.customer_full_address == "Addr, Bangalore, St, Ctry"


@pytest.mark.parametrize("name", ALL)
@pytest.mark.parametrize("repeated", [False, True])
def test_pruned_mart_equals_mart_of_the_full_join(spark, rows, name, repeated):
    source = random_star(spark, 3, repeated)
    expected = over_master(sales_master(source, measure=False), ALL[name])
    actual = over_star(source, ALL[name])
    assert actual.schema.names == expected.schema.names
    assert rows(actual) == rows(expected)


@pytest.mark.parametrize("name", ["customer_summary", "profit_summary", "daily_sales"])
def test_pruned_mart_with_both_lookups_shuffled(spark, rows, settings, monkeypatch, name):
    """Neither lookup is small enough to broadcast."""
    monkeypatch.setattr("martwright.operators.staging.broadcast_within.__defaults__", (0,))
    settings(spark__sql__autoBroadcastJoinThreshold="-1")
    source = random_star(spark, 5, True)
    plan = over_star(source, MARTS[name])
    assert "BroadcastHashJoin" not in plan._jdf.queryExecution().toString()
    assert rows(plan) == rows(over_master(sales_master(source, measure=False), MARTS[name]))


def test_measured(spark):
    unique = random_star(spark, 1, False)
    repeated = random_star(spark, 1, True)
    found = measured([(x, []) for s in (unique, repeated) for x in s.lookups])
    assert [x.unique for x in found] == [True, True, False, False]
    wide = measured([(unique.customers, ["customer_name", "city"])])[0]
    assert 0 < found[0].bytes < wide.bytes
    nothing = star(unique.orders, unique.customers.frame.limit(0), unique.products.frame)
    assert measured([(nothing.customers, [])])[0].unique


def joins(df):
    return df._jdf.queryExecution().optimizedPlan().toString().count("Join")


def by_cell(monkeypatch, settings):
    """No lookup is small, and a cell holds little of each."""
    monkeypatch.setattr("martwright.plans.star.BROADCAST_BYTES", 0)
    monkeypatch.setattr("martwright.plans.star.CELL_BYTES", 1000)
    settings(spark__sql__autoBroadcastJoinThreshold="-1")


def test_large_lookups_are_joined_after_one_shuffle_of_the_lines(spark, rows, settings, monkeypatch):
    source = random_star(spark, 7, False, hot=0.5)
    expected = rows(sales_master(source, measure=False))
    by_cell(monkeypatch, settings)
    monkeypatch.setattr("martwright.operators.staging.broadcast_within.__defaults__", (0,))
    master = sales_master(source)
    plan = master._jdf.queryExecution().executedPlan().toString()
    # The lines and both lookups, once each; lines with a customer's columns are not shuffled.
    assert plan.count("Exchange") == 3
    assert rows(master) == expected


@pytest.mark.parametrize("change", ["repeated keys", "another key type", "many cells"])
def test_lookups_that_cells_do_not_suit(spark, rows, settings, monkeypatch, change):
    source = random_star(spark, 9, change == "repeated keys")
    if change == "another key type":
        people = source.customers.frame.withColumn("customer_id", F.regexp_replace("customer_id", "C", "").cast("int"))
        lines = source.orders.withColumn("customer_id", F.regexp_replace("customer_id", "C", "0"))
        source = star(lines, people, source.products.frame)
    expected = rows(sales_master(source, measure=False))
    by_cell(monkeypatch, settings)
    if change == "many cells":
        monkeypatch.setattr("martwright.plans.star.MOST_CELLS", 1)
    master = sales_master(source)
    assert "__cell" not in master._jdf.queryExecution().toString()
    assert rows(master) == expected


def test_unused_lookups_are_not_joined(spark):
    source = random_star(spark, 2, False)
    assert joins(over_star(source, REPORTS["profit_by_year"])) == 0
    assert joins(over_star(source, MARTS["daily_sales"])) == 0
    assert joins(over_star(source, MARTS["customer_summary"])) == 1
    assert joins(over_star(source, MARTS["profit_summary"])) == 2
    # a repeated product key multiplies order lines, so the product join must stay
    assert joins(over_star(random_star(spark, 2, True), MARTS["customer_summary"])) == 2


def test_marts_add_up_to_the_master(spark):
    master = sales_master(random_star(spark, 4, False))
    assert master.count() == 300
    total = master.agg(F.sum("profit")).first()[0]
    for name in ("customer_summary", "product_summary", "daily_sales"):
        assert over_master(master, MARTS[name]).agg(F.sum("total_profit")).first()[0] == total


def test_order_of_reports(spark, database):
    master = sales_master(random_star(spark, 6, False))
    master.write.saveAsTable(f"{database}.sales_master")
    for name, report in REPORTS.items():
        by_sql = run_report(spark, name, f"{database}.sales_master").collect()
        by_frame = over_master(master, report).collect()
        assert sorted(by_sql, key=repr) == sorted(by_frame, key=repr)
        keys = [tuple(row[c] for c in report.order) for row in by_frame]
        ordered = sorted(keys, key=lambda k: [(v is not None, v) for v in k], reverse=report.descending)
        assert keys == ordered == [tuple(row[c] for c in report.order) for row in by_sql]


def test_hot_customer_is_split(spark, settings):
    """A customer with most of the lines: adaptive execution splits its partition."""
    settings(
        spark__sql__autoBroadcastJoinThreshold="-1",
        spark__sql__adaptive__autoBroadcastJoinThreshold="-1",
        spark__sql__adaptive__skewJoin__skewedPartitionThresholdInBytes="10KB",
        spark__sql__adaptive__skewJoin__skewedPartitionFactor="1.5",
        spark__sql__adaptive__advisoryPartitionSizeInBytes="8KB",
    )
    source = random_star(spark, 8, False)
    lines = source.orders.repartition(8)
    hot = lines.limit(1).withColumn("customer_id", F.lit("C0"))
    hot = hot.withColumn("copy", F.explode(F.sequence(F.lit(1), F.lit(20000)))).drop("copy")
    lines = lines.unionByName(hot.repartition(8))
    source = star(lines, source.customers.frame, source.products.frame)
    counted = sales_master(source, measure=False).groupBy("ship_mode").count()
    assert counted.first()["count"] == 20300
    counted.collect()
    assert "skew=true" in counted._jdf.queryExecution().executedPlan().toString()


def test_rollup_holds_every_report(spark, rows):
    master = sales_master(random_star(spark, 9, True), measure=False)
    rollup = profit_rollup(master)
    plan = rollup._jdf.queryExecution().executedPlan().toString()
    whole = rollup._jdf.queryExecution().optimizedPlan().toString()
    assert whole.count("Expand") == 1 and plan.count("Exchange hashpartitioning(order_year") == 1
    for name, report in REPORTS.items():
        one = rollup.filter(F.col("report") == name).select(*report.keys, "total_profit")
        assert rows(one) == rows(over_master(master, report))
    assert rollup.filter(F.col("report") == TOTAL).first().total_profit == master.agg(F.round(F.sum("profit"), 2)).first()[0]


def test_rollup_of_no_lines(spark):
    master = sales_master(random_star(spark, 9, True), measure=False).limit(0)
    assert profit_rollup(master).count() == 0


def test_places_follow_the_order_over_many_ranges(spark, settings):
    settings(spark__sql__shuffle__partitions="7", spark__sql__adaptive__coalescePartitions__enabled="false")
    mart = REPORTS["profit_by_customer"]
    lines = [(f"c{k % 50:02}", f"n{k}", None if k % 9 == 0 else Decimal(k % 13)) for k in range(200)]
    frame = spark.createDataFrame(lines, "customer_id string, customer_name string, total_profit decimal(18,2)")
    got = placed(frame.repartition(5), mart).orderBy("position").collect()
    wanted = sorted(lines, key=lambda r: (r[2] is None, -(r[2] or 0), r[0], r[1]))
    assert [r.position for r in got] == list(range(1, 201))
    assert [tuple(r)[1:] for r in got] == wanted
    assert placed(frame.limit(0), mart).count() == 0


def test_lookups_are_measured_once_for_all_marts(spark, rows, monkeypatch):
    for repeated in (False, True):
        source = random_star(spark, 10, repeated)
        once = measured_star(source)
        assert [x.unique for x in once.lookups] == [not repeated] * 2
        needs = [(x, list(x.columns)[:2]) for x in source.lookups]
        after = [(x, names) for x, (_, names) in zip(once.lookups, needs, strict=True)]
        assert [x.bytes for x in measured(after)] == [x.bytes for x in measured(needs)]
        expected = {name: rows(over_star(source, mart)) for name, mart in ALL.items()}
        jobs = spark.sparkContext.statusTracker()
        spark.sparkContext.setJobGroup("measured", "")
        frames = {name: over_star(once, mart) for name, mart in ALL.items()}
        assert not jobs.getJobIdsForGroup("measured")
        spark.sparkContext.setJobGroup("", "")
        assert {name: rows(frame) for name, frame in frames.items()} == expected
