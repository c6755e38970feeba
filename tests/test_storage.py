"""Readers, writers and the end-to-end jobs, by writing and reading back."""

from __future__ import annotations

import datetime as dt
import json

import numpy as np
import pytest
from pyspark.sql import functions as F

from factorloom import schema
from factorloom.operators import conform as cf
from factorloom.operators import documents as dc
from factorloom.operators import universe as un
from factorloom.operators import upsert as up
from factorloom.plans import backtest as bt
from factorloom.plans import factors as plan
from factorloom.plans import ingest
from factorloom.sources import readers, writers

NOW = "2024-06-01 12:00:00"


def day(i):
    return dt.date(2024, 1, 1) + dt.timedelta(days=i)


@pytest.fixture(scope="module")
def bars(spark):
    rows = []
    for c in range(12):
        for i in range(40):
            p = 50 + (c * 7 + i * (c % 5 + 1)) % 23 + c / 10
            rows.append((f"{600000 + c}.SH", day(i), p - 1, p + 1.0, p - 2.0, p * 1.0, 100.0 + i, 100.0 * p))
    cols = "stock_code string, trade_date date, open double, high double, low double, close double, volume double, turnover double"
    return spark.createDataFrame(rows, cols).cache()


def empty(spark, layout):
    return spark.createDataFrame([], layout)


def test_batch_daily_evaluation_and_correlation(spark, bars, tmp_path):
    mine = {"m2": plan.momentum(2), "m5": plan.momentum(5), "rc": plan.rank_correlation(4), "bad": F.col("nope")}
    path, daily = f"{tmp_path}/values", f"{tmp_path}/daily"
    registry, bad = bt.run_batch(bars, mine, "ALL", day(0), day(39), path, empty(spark, schema.VALUE_FILES), NOW)
    assert list(bad) == ["bad"]
    assert registry.count() == 3 and cf.split_registry(registry)[1].count() == 0
    again, _ = bt.run_batch(bars, mine, "ALL", day(0), day(39), path, registry, "2024-06-02 00:00:00")
    assert again.count() == 3 and cf.key_violations(again, schema.BATCH_KEYS).count() == 0
    paths = {r["factor_id"]: r["rel_path"] for r in bt.registered_paths(again, "ALL").collect()}
    assert spark.read.parquet(paths["m2"]).count() == bars.count()

    for asked in (day(50), day(20)):
        rows, _ = bt.run_daily(bars, {"m2": plan.momentum(2)}, asked, "ALL", daily, empty(spark, schema.VALUE_FILES), NOW)
        assert rows.count() == 1 and cf.split_registry(rows)[1].count() == 0
    assert {r[0] for r in spark.read.parquet(daily).select("trade_date").distinct().collect()} == {day(39), day(20)}

    values = spark.read.parquet(path)
    meta = spark.createDataFrame([("m2", "two", "price", "daily", "u")], "factor_id string, factor_name string, factor_type string, trading_cycle string, source_url string")
    basic = bt.run_evaluation(
        values, bars, meta, empty(spark, schema.FACTOR_BASIC), f"{tmp_path}/docs", f"{tmp_path}/runs", F.lit(NOW).cast("timestamp"), 2, 4
    )
    assert {r["factor_id"]: r["factor_name"] for r in basic.collect()} == {"m2": "two", "m5": "m5", "rc": "rc"}
    docs = [json.loads(r["value"]) for r in spark.read.text(f"{tmp_path}/docs").collect()]
    assert {d["factor_id"] for d in docs} == {"m2", "m5", "rc"}
    assert set(docs[0]["key_metrics"]) == {"ic_value", "ic_ir", "sharpe_ratio", "max_drawdown", "turnover"}
    assert all(d["pass_standard"] is None and "pass_standard" in d for d in docs)
    runs = spark.read.parquet(f"{tmp_path}/runs")
    assert runs.count() == 3 and runs.where("pass_standard is not null").count() == 0

    snaps = f"{tmp_path}/corr"
    for asof in (day(20), day(39)):
        bt.run_correlation(values, basic.withColumn("is_valid", F.col("factor_id") != "rc"), "ALL", asof, snaps, 30, 5)
    stored = spark.read.parquet(snaps)
    assert stored.count() == 4
    assert {r["as_of_date"] for r in writers.latest_snapshot(stored, "ALL").collect()} == {day(39)}
    dropped = writers.drop_snapshots(spark, snaps, day(45), 10)
    assert dropped == 1 and spark.read.parquet(snaps).count() == 2
    assert writers.drop_snapshots(spark, snaps, day(45), 10) == 0  # a second run finds nothing
    assert {r["as_of_date"] for r in writers.read_latest_snapshot(spark, snaps, "ALL").collect()} == {day(39)}


def test_csv_values_by_file_name(spark, bars, tmp_path):
    folder = tmp_path / "by_universe" / "HS300"
    folder.mkdir(parents=True)
    for name, v in {
        "f_1_HS300_2024-01-01_2024-01-31.csv": 1.0,
        "f_1_hs300_2024-01-01_2024-02-29.csv": 2.0,
        "f_2_HS300_2024-01-01_2024-01-15.CSV": 3.0,
        "f_3_ALL_2024-01-01_2024-01-15.csv": 4.0,
        "f_4_HS300_2024-01-01_soon.csv": 5.0,
        "short.csv": 6.0,
    }.items():
        (folder / name).write_text(f"trade_date,stock_code,factor_value\n2024-01-05,a,{v}\n2024-01-05,b,\n2024-01-05,c,inf\n")
    got = readers.read_values_dir(spark, str(tmp_path), "hs300").where("stock_code = 'a'")
    assert sorted((r["factor_id"], r["factor_value"]) for r in got.collect()) == [("f_1", 2.0), ("f_2", 3.0)]
    every = readers.read_values_dir(spark, str(tmp_path), "HS300", newest_only=False)
    assert every.where("stock_code = 'a'").count() == 4
    assert every.where("stock_code <> 'a' and factor_value is not null").count() == 0
    one = readers.read_values_csv(spark, str(folder / "f_2_HS300_2024-01-01_2024-01-15.CSV"))
    assert one.columns == schema.FACTOR_VALUES.names and one.count() == 3
    (folder / "bad.csv").write_text("trade_date,value\n2024-01-05,1\n")
    with pytest.raises(ValueError, match="lack columns"):
        readers.read_values_csv(spark, str(folder / "bad.csv"))


def test_ingest_merges_a_lookback(spark, tmp_path):
    path = f"{tmp_path}/bars"

    def landed(rows):
        df = spark.createDataFrame(rows, "time string, code string, close double, pre_close double, paused double, update string")
        fixed = {c: F.lit(None).cast("double") for c in ("open", "low", "high", "volume", "money", "high_limit", "low_limit")}
        mapping = {k: v for k, v in readers.VENDOR_A_COLUMNS.items()} | {"update": "update_time"}
        return readers.landed_bars(df.withColumns(fixed), mapping)

    first = landed([("20240110", "1.XSHE", 10.0, 8.0, 0.0, "2024-01-10"), ("20240220", "1.XSHE", 11.0, 0.0, 1.0, "2024-02-20"),
                    ("20240220", "1.XSHE", 12.0, 11.0, None, "2024-02-21"), ("20240221", "", 1.0, 1.0, 0.0, "2024-02-21"),
                    ("20240222", "2.XSHG", None, 1.0, 0.0, "2024-02-22")])
    assert first.schema.names == schema.BARS.names
    ingest.load_history(first, path, "2024-01-01", "2024-12-31")
    stored = spark.read.parquet(path)
    assert sorted((r["stock_code"], r["close"], r["is_suspend"]) for r in stored.collect()) == [("1.SZ", 10.0, False), ("1.SZ", 12.0, None)]
    assert stored.where("close = 10").first()["return"] == pytest.approx(2500)
    late = landed([("20240110", "1.XSHE", 99.0, 8.0, 0.0, "2024-03-01"), ("2024-02-20", "1.XSHE", 13.0, 11.0, 0.0, "2024-03-01"),
                   ("20240225", "2.XSHG", 5.0, None, 0.0, "2024-03-01")])
    for _ in range(2):
        ingest.sync_bars(spark, late, path, "2024-02-28", 20)
        got = sorted((r["stock_code"], str(r["trade_date"]), r["close"]) for r in spark.read.parquet(path).collect())
        assert got == [("1.SZ", "2024-01-10", 10.0), ("1.SZ", "2024-02-20", 13.0), ("2.SH", "2024-02-25", 5.0)]
    assert ingest.duplicate_bars(spark.read.parquet(path)).count() == 0
    some = late.select("stock_code", "trade_date", (F.col("close") * 2).alias("close"))
    ingest.sync_bars(spark, some, path, "2024-02-28", 20, rule="patch")
    row = spark.read.parquet(path).where("trade_date = date'2024-02-20'").first()
    assert row["close"] == 26.0 and row["pre_close"] == 11.0

    calendar = f"{tmp_path}/calendar"
    days = spark.createDataFrame([(day(1),), (day(1),), (day(3),)], "trade_date date")
    ingest.sync_calendar(spark, days, calendar, day(-2), day(3), NOW)
    ingest.sync_calendar(spark, days.limit(0), calendar, day(3), day(4), NOW)
    flags = {r["trade_date"]: r["is_trade_day"] for r in spark.read.parquet(calendar).collect()}
    assert flags == {day(i): int(i == 1) for i in range(-2, 5)}


def test_vendor_with_foreign_headers(spark):
    df = spark.createDataFrame([("2024-01-05", 1.0, 2.0, 3.0, 0.5, 100.0, 150.0)], "`日期` string, `开盘` double, `收盘` double, `最高` double, `最低` double, `成交量` double, `成交额` double")
    row = readers.landed_bars(df, readers.VENDOR_B_COLUMNS, stock_code=F.lit("600000.SH")).first()
    assert (row["trade_date"], row["close"], row["turnover"], row["multiple"]) == (dt.date(2024, 1, 5), 2.0, 150.0, 1)
    with pytest.raises(ValueError, match="lacks columns"):
        readers.landed_bars(df.drop("收盘"), readers.VENDOR_B_COLUMNS)


def test_universe_rules(spark, bars):
    assert un.filter_universe(bars, "all_a").count() == bars.count()
    members = spark.createDataFrame([("HS300", "600001.SH", day(0)), ("HS300", "600002.SH", day(9))], "universe string, stock_code string, as_of date")
    assert {r[0] for r in un.filter_universe(bars, "HS300", members, day(5)).select("stock_code").distinct().collect()} == {"600001.SH"}
    assert un.filter_universe(bars, "ETF", members, day(5)).count() == 0
    assert un.filter_universe(bars, "CUSTOM", stock_codes=" 600003.XSHG,").count() == 40
    with pytest.raises(ValueError):
        un.filter_universe(bars, "MOON")
    with pytest.raises(ValueError):
        readers.scan_closes(bars, day(0), day(5), [" "])
    assert readers.scan_closes(bars, day(0), day(5), [" 600003.SH", ""]).count() == 6
    plan_text = readers.scan_bars(bars, day(0), day(1))._jdf.queryExecution().optimizedPlan().toString()
    assert "high" in plan_text


def test_filters_and_columns_reach_the_scan(spark, bars, tmp_path):
    bars.withColumn("unused", F.lit("x")).write.parquet(f"{tmp_path}/b")
    df = readers.scan_closes(spark.read.parquet(f"{tmp_path}/b"), day(3), day(5))
    text = df._jdf.queryExecution().executedPlan().toString()
    assert "GreaterThanOrEqual(trade_date,2024-01-04)" in text
    assert "unused" not in text and "volume" not in text


def test_documents_there_and_back(spark, tmp_path):
    cols = "factor_id string, factor_name string, formula string, description string, factor_type string, test_universe string, trading_cycle string, factor_direction string, source_url string"
    rows = [("F1", "one", "RANK(close)", "d", "t", "ALL", "daily", "Short", "http://a"), ("F2", "two", "close", "d", "t", "ALL", "daily", "sideways", "u")]
    writers.write_documents(spark.createDataFrame(rows, cols), f"{tmp_path}/md")
    (tmp_path / "sub").mkdir()
    (tmp_path / "sub" / "x.md").write_text("因子ID：F3\n公式: close\n公式(DSL):  open \n")
    good, bad = bt.load_definitions(spark, str(tmp_path))
    got = {r["factor_id"]: (r["factor_name"], r["formula"], r["factor_direction"]) for r in good.collect()}
    assert got == {"F1": ("one", "RANK(close)", "short"), "F2": ("two", "close", "long")}
    assert [r["missing_fields"] for r in bad.collect()] == [["factor_name", "factor_direction"]]


def test_pages_of_mixed_planes(spark):
    filler = "ab\U0001f600" * 60000
    html = (
        f'<h4 id="alpha9">out</h4><div class="a preview-contents"><div>{filler}</div><h4 id="alpha1">alpha_1</h4><ul><li>{filler}</li>'
        f'<li>说明: {filler}</li><li>因子公式: A &ge; B &times; &#60;&#x3E; &amp;lt; {filler}</li></ul></div><h4 id="alpha2">x</h4>'
    )
    pages = spark.createDataFrame([(1, html)], "page_id int, html string")
    rows = dc.extract_blocks(pages, ["page_id"]).collect()
    assert [(r["alpha_name"], r["raw_formula"], r["description"]) for r in rows] == [("alpha_1", f"A ≥ B × <> &lt; {filler}", f"说明: {filler}")]


def test_null_keys_meet(spark):
    t = spark.createDataFrame([(None, 1, "2024-01-01"), (None, 2, "2024-01-09"), ("a", 3, "2024-01-02")], "k string, v int, d string")
    t = t.withColumn("d", F.col("d").cast("date"))
    assert sorted(r["v"] for r in up.keep_recent(t, "d", ["k"], "2024-01-10", 3).collect()) == [2, 3]
    assert up.insert_if_absent(t, t.where("v = 1"), ["k"]).count() == 3
    flags = up.update_flags(t.where("v = 1"), t.where("v = 1").withColumn("v", F.lit(7)), ["k"])
    assert [r["v"] for r in flags.collect()] == [7]


def test_unreadable_table_is_an_error(spark, tmp_path):
    (tmp_path / "t").mkdir()
    (tmp_path / "t" / "part-0.parquet").write_text("no parquet")
    with pytest.raises(Exception):
        writers.upsert_table(spark, f"{tmp_path}/t", spark.createDataFrame([(1, 2)], "k int, m int"), ["k"], ["m"])


def test_few_files_per_partition(spark, tmp_path):
    df = spark.range(2000).select("id", (F.col("id") % 20).alias("m")).repartition(8)
    writers.overwrite_partitions(df, f"{tmp_path}/few", ["m"])
    assert len(list((tmp_path / "few").rglob("part-*.parquet"))) == 20


def test_very_long_pages(spark):
    filler = "<p>" + "word <b>bold</b> " * 20000 + "</p>"
    html = f'{filler}<h4 id="alpha1">alpha_1</h4><ul><li>{filler}</li><li>因子公式: A &lt; B</li></ul>{filler}<h4 id="alpha2">x</h4>'
    rows = dc.extract_blocks(spark.createDataFrame([(1, html)], "id int, html string"), ["id"]).collect()
    assert [(r["factor_id"], r["raw_formula"]) for r in rows] == [("JQ_ALPHA_001", "A < B")]


def test_load_summary_and_preview(bars):
    row = cf.log_summary(bars).first()
    assert (row["n_rows"], row["n_stocks"], row["start_date"]) == (480, 12, day(0))
    assert [r["trade_date"] for r in writers.preview(bars, ["trade_date", "stock_code"], 3).collect()] == [day(0)] * 3


def test_observed_load(bars, tmp_path):
    df, seen = cf.observe_load(bars)
    df.write.parquet(f"{tmp_path}/o")
    assert (seen.get["n_rows"], seen.get["start_date"], seen.get["end_date"]) == (480, day(0), day(39))


def test_document_pointer_falls_back(spark):
    runs = spark.createDataFrame(
        [("a", "ALL", "docs\\a.json"), ("b", "ALL", "gone.json"), ("c", "ETF", "docs/c.json"), ("d", "ALL", None)],
        "factor_id string, test_universe string, result_json_rel_path string",
    )
    there = ["docs/a.json", "docs/c.json", "res/by_universe/ALL/b_ALL_backtest.json", "res/b_backtest.json", "res/c_backtest.json"]
    files = spark.createDataFrame([(p,) for p in there], "rel_path string")
    got = {r["factor_id"]: r["backtest_json_path"] for r in bt.document_pointers(runs, files, "ALL", "res").collect()}
    assert got == {"a": "docs/a.json", "b": "res/by_universe/ALL/b_ALL_backtest.json", "c": "res/c_backtest.json"}


def test_factor_values_against_pandas(bars):
    """Momentum of a panel, clipped and standardised by date."""
    got = plan.compute_factors(bars, plan.library("momentum_20")).toPandas()
    raw = bars.select("trade_date", "stock_code", "close").toPandas().sort_values(["stock_code", "trade_date"])
    raw["x"] = raw.groupby("stock_code").close.transform(lambda c: (c - c.shift(20)) / c.shift(20))

    def standard(x):
        x = x.clip(x.quantile(0.01), x.quantile(0.99))
        return (x - x.mean()) / x.std() if x.nunique() > 1 else x * 0.0

    raw["z"] = raw.groupby("trade_date").x.transform(standard).fillna(0.0)
    both = got.merge(raw, on=["trade_date", "stock_code"])
    assert len(both) == len(got) == len(raw) and np.allclose(both.factor_value, both.z, atol=1e-7)


def test_only_chosen_files_are_opened(spark, tmp_path):
    folder = tmp_path / "by_universe" / "ALL"
    folder.mkdir(parents=True)
    for name in ("a [1]{x}_ALL_2024-01-01_2024-01-31.csv", "a [1]{x}_ALL_2024-01-01_2024-02-29.csv", "b%20+_ALL_2024-01-01_2024-01-15.csv", "odd.csv"):
        (folder / name).write_text("trade_date,stock_code,factor_value\n2024-01-05,a,1.5\n2024-01-06,b,none\n")
    got = readers.read_values_dir(spark, str(tmp_path), "all")
    opened = sorted(f.rsplit("/", 1)[1] for f in got.inputFiles())
    assert len(opened) == 2 and "2024-02-29" in opened[0]
    rows = {(r["factor_id"], r["stock_code"]): r["factor_value"] for r in got.collect()}
    assert rows == {(f, s): v for f in ("a [1]{x}", "b%20+") for s, v in (("a", 1.5), ("b", None))}
    assert readers.read_values_dir(spark, str(tmp_path), "none").count() == 0
    listed = readers.list_files(spark, str(folder), "*.csv")
    assert listed.count() == 4 and listed.where("length > 0 and modified is not null").count() == 4


def test_large_partitions_are_written_by_many_tasks(spark, tmp_path):
    df = spark.range(1000).select("id", F.when(F.col("id") < 900, "big").otherwise("small").alias("part"))
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")  # it merges what is this small
    try:
        writers.overwrite_partitions(df, str(tmp_path / "t"), ["part"], rows=100)
    finally:
        spark.conf.unset("spark.sql.adaptive.coalescePartitions.enabled")
    files = {k: len(list((tmp_path / "t" / f"part={k}").glob("*.parquet"))) for k in ("big", "small")}
    assert files["small"] == 1 and files["big"] > 1
    assert spark.read.parquet(str(tmp_path / "t")).groupBy("part").count().orderBy("part").collect()[0][1] == 900


def test_no_active_thresholds_is_an_error(spark):
    from factorloom.operators import lifecycle as lc

    config = spark.createDataFrame([(1, "prod", False, 0.1)], "id long, scene string, is_active boolean, ic_min double").withColumn("created_at", F.lit("2024-01-01").cast("timestamp"))
    runs = spark.createDataFrame([("f", 0.2)], "factor_id string, ic_value double")
    judged, limits = lc.with_limits(runs, lc.threshold_row(config, "prod"))
    with pytest.raises(Exception, match="no active thresholds"):
        judged.where(lc._holds([("ic_value", ">=", limits["ic_min"])])).collect()
    judged, limits = lc.with_limits(runs, lc.threshold_row(config.withColumn("is_active", F.lit(True)), "prod"))
    assert judged.where(lc._holds([("ic_value", ">=", limits["ic_min"])])).count() == 1


def test_document_table(spark, tmp_path, monkeypatch):
    docs = spark.createDataFrame([(f"d{i:03}", f"text {i}") for i in range(300)], "doc_path string, text string").repartition(20)
    monkeypatch.setattr(writers, "FILE_BYTES", 1000)
    writers.write_document_table(docs, str(tmp_path / "d"))
    assert 2 <= len(list((tmp_path / "d").glob("*.parquet"))) <= 4  # by bytes, not by documents
    wanted = spark.createDataFrame([("d007",), ("d007",), ("none",)], "doc_path string")
    assert [tuple(r) for r in readers.read_document_table(spark, str(tmp_path / "d"), wanted).collect()] == [("d007", "text 7")]
    assert readers.read_document_table(spark, str(tmp_path / "d")).count() == 300
