"""Text policy audit of a table: a verdict per row and counts per rule."""

from __future__ import annotations

from functools import reduce
from operator import and_

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tabwright.functions.text import follows_policy, policy_rules


def text_policy_verdicts(df: DataFrame, col: str, name: str = "conforms") -> DataFrame:
    return df.withColumn(name, follows_policy(col))


def text_policy_audit(df: DataFrame, col: str) -> DataFrame:
    """``(rule, passed, failed)`` for each rule and for ``all_rules``, in one scan."""
    # Each test is a column first, so the verdict reuses the results instead of matching again.
    rules = policy_rules(col)
    tested = df.select(*[test.alias(rule) for rule, test in rules.items()])
    tests = {**{rule: F.col(rule) for rule in rules}, "all_rules": reduce(and_, [F.col(rule) for rule in rules])}
    counted = tested.agg(
        F.count(F.lit(1)).alias("_n"), *[F.count_if(test).alias(rule) for rule, test in tests.items()]
    )
    cells = [
        F.struct(F.lit(r).alias("rule"), F.col(r).alias("passed"), (F.col("_n") - F.col(r)).alias("failed"))
        for r in tests
    ]
    return counted.select(F.explode(F.array(*cells)).alias("_r")).select("_r.*")
