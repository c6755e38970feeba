"""What the evaluation and its written tables leave on the disks."""

from __future__ import annotations

import random
import time
from datetime import date

from pyspark.sql import functions as F

from factorloom.operators import evaluate as ev
from factorloom.operators import lineage


def test_ranks_are_not_written_and_move_no_other_columns(spark, monkeypatch):
    rng, written = random.Random(4), []
    monkeypatch.setattr(ev, "stored", lambda df, real=ev.stored: written.append(df.columns) or real(df))
    rows = [("f", date(2024, 1, d), f"s{i}", float(rng.randint(0, 40)), rng.random()) for d in range(1, 5) for i in range(60)]
    paired = spark.createDataFrame(rows, "factor_id string, trade_date date, stock_code string, factor_value double, ret double")
    buckets = ev.bucketed(paired, 5)
    assert not any("factor_rank" in columns for columns in written)
    daily = ev.daily_metrics(buckets, 5)
    plan = daily._jdf.queryExecution().optimizedPlan().toString()
    assert not any("stock_code" in line for line in plan.splitlines() if "Project [" in line or "Window [" in line)
    top = buckets.where("in_top").select("factor_id", "trade_date", "stock_code")
    assert "Window" not in top._jdf.queryExecution().optimizedPlan().toString()
    for r in daily.collect():
        day = buckets.where(F.col("trade_date") == F.lit(r.trade_date)).collect()
        mean = lambda xs: sum(xs) / len(xs)
        assert abs(r.ls_ret - (mean([x.ret for x in day if x.in_top]) - mean([x.ret for x in day if x.in_bottom]))) < 1e-12


def test_written_tables_leave_no_shuffle_files(spark):
    def files():
        every = spark._jvm.org.apache.spark.SparkEnv.get().blockManager().diskBlockManager().getAllFiles()
        return sum(1 for i in range(every.size()) if every.apply(i).getName().startswith("shuffle_"))

    df = spark.range(10_000).groupBy((F.col("id") % 97).alias("k")).count()
    for write in (lineage.stored, lineage.cut_lineage):
        before, kept = files(), write(df)
        for _ in range(50):
            if files() <= before:
                break
            time.sleep(0.1)
        assert files() <= before and kept.count() == 97
    assert spark.conf.get("spark.sql.classic.shuffleDependency.fileCleanup.enabled") == "false"
