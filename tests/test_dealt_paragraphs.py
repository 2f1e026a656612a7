"""A large book is treated in more than one task, and each rule's pattern runs once."""

from pyspark.sql import functions as F

from inkmill.operators import assemble, rules
from inkmill.plans.config import Pattern, Rule


def test_a_book_is_treated_in_many_tasks(spark):
    one = spark.range(0, 1000).select(F.lit("b").alias("book_id"), F.col("id").alias("para_no"), F.lit("x。").alias("text")).coalesce(1)
    plan = assemble.treat(one, [])._jdf.queryExecution().optimizedPlan().toString()
    assert "RepartitionByExpression" in plan
    assert assemble.lines(assemble.treat(one, [])).count() == 1000


def test_each_rule_looks_once(spark):
    chain = [Rule("e", "extract", Pattern("b"), "s")]
    plan = spark.range(1).select(rules.apply_rules(F.array(F.col("id").cast("string")), chain).alias("r"))._jdf.queryExecution().analyzed().toString()
    assert plan.upper().count("RLIKE(") == 1
