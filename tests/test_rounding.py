"""Rounding in doubles gives what rounding by decimal digits gives."""

import random

from vigil.plans.queries import rounded


def test_rounded_equals_round(spark):
    draw = random.Random(3)
    values = [None, float("nan"), float("inf"), -float("inf"), 0.0, -0.0, -1e-9, 0.5e-6, 1.5e-6, 2.5e-6, -0.5e-6, 1e6, -999999.9999995, 1e300]
    values += [k / 2e6 for k in range(-999, 1000)] + [draw.uniform(-1, 1) * 10 ** draw.randint(-8, 13) for _ in range(5000)]
    values += [round(draw.uniform(-999, 999), 6) + 5e-7 for _ in range(5000)]
    df = spark.createDataFrame([(v,) for v in values], "x double")
    for digits in (3, 6):
        both = rounded(df.selectExpr("x", "x AS y"), digits).select("x")
        want = df.selectExpr(f"round(x, {digits}) + 0D AS x")
        assert both.exceptAll(want).count() == want.exceptAll(both).count() == 0
        plan = both._jdf.queryExecution().optimizedPlan().toString()
        assert "rint" in plan.lower()
