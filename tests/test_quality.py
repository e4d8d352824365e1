from __future__ import annotations

import random

import pytest
from pyspark.sql import functions as F

from martwright.functions.rules import Rule
from martwright.operators import staging
from martwright.operators.quality import as_rules, duplicate_rows, quality_split, rule_violations
from martwright.sources.metadata import active_rules

CHAIN = [Rule("product_id", "NOT_NULL"), Rule("product_id", "UNIQUE"), Rule("quantity", "POSITIVE")]


def products(spark, lines):
    return spark.createDataFrame(lines, "quantity int, product_id string")


@pytest.mark.parametrize(
    ("rule", "broken"),
    [
        (Rule("n", "NOT_NULL"), [(None, None)]),
        (Rule("n", "POSITIVE"), [(-1.0, "b"), (0.0, "b")]),
        (Rule("n", "MIN_VALUE", "5"), [(-1.0, "b"), (0.0, "b")]),
        (Rule("n", "RANGE", "0, 7.5"), [(-1.0, "b"), (9.0, "a"), (float("nan"), "a")]),
        (Rule("t", "REGEX", "^a$"), [(-1.0, "b"), (0.0, "b")]),
        (Rule("t", "DOMAIN", "b, c"), [(7.5, "a"), (9.0, "a"), (float("nan"), "a")]),
        (Rule("n", "UNIQUE"), []),
        (Rule("t", "UNIQUE"), [(-1.0, "b"), (0.0, "b"), (7.5, "a"), (9.0, "a"), (float("nan"), "a")]),
    ],
)
def test_single_rules(spark, rows, rule, broken):
    data = [(None, None), (0.0, "b"), (-1.0, "b"), (7.5, "a"), (9.0, "a"), (float("nan"), "a")]
    df = spark.createDataFrame(data, "n double, t string")
    found = rule_violations(df, rule)
    assert found.columns == df.columns
    assert repr(rows(found)) == repr(sorted(broken, key=repr))


def test_rule_errors(spark):
    df = spark.createDataFrame([("1",)], "t string")
    with pytest.raises(TypeError, match="numeric"):
        rule_violations(df, Rule("t", "POSITIVE"))
    with pytest.raises(ValueError, match="rule_value"):
        rule_violations(df, Rule("t", "REGEX"))


def test_chain_sees_survivors_only(spark, rows):
    split = quality_split(products(spark, [(10, "P1"), (-5, "P1"), (20, None)]), CHAIN)
    assert split.valid.count() == 0
    assert rows(split.rejected, "quantity", "failed_rule", "failed_column", "actual_value") == [
        (-5, "UNIQUE", "product_id", "P1"), (10, "UNIQUE", "product_id", "P1"),
        (20, "NOT_NULL", "product_id", None)]
    reordered = quality_split(products(spark, [(10, "P1"), (-5, "P1"), (20, None)]), CHAIN[::-1])
    assert rows(reordered.valid) == [(10, "P1")]


def test_duplicates_and_nulls(spark, rows):
    """Key not first, NULL keys, exact duplicates among the valid rows."""
    lines = [(1, None), (1, None), (2, "P2"), (2, "P2"), (3, "P3")]
    split = quality_split(products(spark, lines), [Rule("product_id", "UNIQUE")])
    assert rows(split.valid) == [(1, None), (1, None), (3, "P3")]
    assert split.rejected.count() == 2
    kept = quality_split(products(spark, lines), [Rule("quantity", "POSITIVE")])
    assert kept.valid.count() == 5
    assert tuple(kept.metrics().first()) == (5, 5, 0)


def test_distinct_mode(spark, rows):
    """Exact duplicates collapse after the first rule, so UNIQUE then passes them."""
    lines = [(2, "P2"), (2, "P2"), (-1, "P2"), (3, "P3"), (4, "P3")]
    rules = [Rule("quantity", "POSITIVE"), Rule("product_id", "UNIQUE")]
    split = quality_split(products(spark, lines), rules, distinct=True)
    assert rows(split.valid) == [(2, "P2")]
    assert rows(split.rejected, "quantity") == [(-1,), (3,), (4,)]


def test_unknown_rules_are_listed(spark):
    unknown = Rule("quantity", "CHECKSUM")
    split = quality_split(products(spark, [(1, "P1")]), [unknown])
    assert split.skipped == [unknown]
    assert (split.valid.count(), split.rejected.count()) == (1, 0)
    assert split.rejected.columns[-4:] == ["failed_column", "failed_rule", "actual_value", "rejection_reason"]


def brute_force_chain(lines, rules):
    """Brute force over Python rows."""
    alive, rejected = list(enumerate(lines)), []
    for rule in rules:
        position = {"quantity": 0, "product_id": 1}[rule.column]
        values = [row[position] for _, row in alive]

        def breaks(value, rule=rule, values=values):
            if rule.kind == "NOT_NULL":
                return value is None
            if value is None:
                return False
            if rule.kind == "UNIQUE":
                return values.count(value) > 1
            return value <= 0

        rejected += [(*row, rule.kind) for _, row in alive if breaks(row[position])]
        alive = [(i, row) for i, row in alive if not breaks(row[position])]
    return sorted((row for _, row in alive), key=repr), sorted(rejected, key=repr)


@pytest.mark.parametrize("limit", [staging.BROADCAST_BYTES, 0])
@pytest.mark.parametrize("seed", [1, 2])
def test_random_chains(spark, rows, settings, monkeypatch, seed, limit):
    """Against brute force, with the duplicate keys broadcast and joined by shuffle."""
    monkeypatch.setattr("martwright.operators.quality.BROADCAST_BYTES", limit)
    settings(spark__sql__autoBroadcastJoinThreshold="10MB" if limit else "-1")
    rng = random.Random(seed)
    keys = [None, *[f"P{i}" for i in range(40)], *["HOT"] * 20]
    lines = [(rng.choice([None, -1, 1, 2, 3]), rng.choice(keys)) for _ in range(120)]
    rules = [
        Rule("quantity", "UNIQUE") if seed == 2 else Rule("quantity", "POSITIVE"),
        Rule("product_id", "UNIQUE"),
        Rule("quantity", "NOT_NULL"),
        Rule("product_id", "UNIQUE"),
    ]
    rng.shuffle(rules)
    split = quality_split(products(spark, lines), rules)
    valid, rejected = brute_force_chain(lines, rules)
    assert rows(split.valid) == valid
    assert rows(split.rejected, "quantity", "product_id", "failed_rule") == rejected
    assert tuple(split.metrics().first()) == (120, len(valid), len(rejected))


def test_row_rules_move_below_the_shuffle(spark, settings, monkeypatch, tmp_path):
    """Rows that break a later row-local rule are not shuffled for the UNIQUE join."""
    monkeypatch.setattr("martwright.operators.quality.BROADCAST_BYTES", -1)
    settings(spark__sql__autoBroadcastJoinThreshold="-1")
    path = str(tmp_path / "lines")
    products(spark, [(1, "P1"), (2, "P2")]).write.parquet(path)
    rules = [Rule("product_id", "UNIQUE"), Rule("quantity", "MIN_VALUE", "7")]
    plan = quality_split(spark.read.parquet(path), rules).valid._jdf.queryExecution().executedPlan().toString()
    assert plan.index("SortMergeJoin") < plan.index("Exchange hashpartitioning") < plan.index("< 7)")


def test_hot_key_is_split(spark, settings, monkeypatch):
    """A repeated key with most of the rows, and too many repeated keys to broadcast."""
    monkeypatch.setattr("martwright.operators.quality.BROADCAST_BYTES", -1)
    settings(
        spark__sql__autoBroadcastJoinThreshold="-1",
        spark__sql__adaptive__autoBroadcastJoinThreshold="-1",
        spark__sql__adaptive__skewJoin__skewedPartitionThresholdInBytes="10KB",
        spark__sql__adaptive__skewJoin__skewedPartitionFactor="1.5",
        spark__sql__adaptive__advisoryPartitionSizeInBytes="8KB",
    )
    ids = spark.range(30000, numPartitions=8)
    key = F.when(F.col("id") < 20000, "HOT").otherwise(F.concat(F.lit("P"), F.col("id").cast("string")))
    noise = F.sha2(F.col("id").cast("string"), 256)
    df = ids.select(noise.alias("noise"), key.alias("product_id"))
    split = quality_split(df, [Rule("product_id", "UNIQUE")])
    assert tuple(split.metrics().first()) == (30000, 10000, 20000)
    widest = split.rejected.groupBy("failed_rule").agg(F.max("noise"), F.count(F.lit(1)).alias("rows"))
    assert [row.rows for row in widest.collect()] == [20000]
    assert "skew=true" in widest._jdf.queryExecution().executedPlan().toString()


def test_duplicate_rows(spark, rows):
    df = spark.createDataFrame([(1, 1), (1, 1), (1, 2), (None, 1), (None, 1)], "a int, b int")
    assert rows(duplicate_rows(df, ["a", "b"])) == [(1, 1, 2)]


def test_rules_from_metadata(spark):
    table = spark.createDataFrame(
        [("t", "b", "UNIQUE", None, True), ("t", "a", "REGEX", "x", True),
         ("t", "a", "NOT_NULL", None, False), ("u", "a", "NOT_NULL", None, True)],
        "table_name string, column_name string, rule_type string, rule_value string, active_flag boolean",
    )
    assert as_rules(active_rules(table, "t")) == [Rule("a", "REGEX", "x"), Rule("b", "UNIQUE")]
    first = table.withColumn("priority", F.when(F.col("column_name") == "b", 1).otherwise(2))
    assert as_rules(active_rules(first, "t")) == [Rule("b", "UNIQUE"), Rule("a", "REGEX", "x")]


def test_staged_tables_are_packed_closely(spark, rows):
    from pathlib import Path

    from martwright.operators.staging import stage

    staged = stage(spark.range(1000).selectExpr("concat('key-', id) AS k"), "packed")
    files = [file.name for file in Path(staged.path.removeprefix("file:")).glob("part-*")]
    assert files and all(name.endswith(".zstd.parquet") for name in files)
    assert staged.rows == len(rows(staged.frame)) == 1000
