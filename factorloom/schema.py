"""Layouts of the tables the library reads and writes."""

from pyspark.sql.types import (
    BooleanType,
    DateType,
    DoubleType,
    IntegerType,
    LongType,
    StringType,
    StructType,
    TimestampType,
)

_TYPES = {
    "string": StringType(),
    "date": DateType(),
    "timestamp": TimestampType(),
    "double": DoubleType(),
    "boolean": BooleanType(),
    "int": IntegerType(),
    "bigint": LongType(),
}


def _layout(columns: str) -> StructType:
    """A schema from 'name type, name type'; needs no session, unlike Spark's own parsing."""
    out = StructType()
    for column in columns.split(","):
        name, kind = column.split()
        out = out.add(name, _TYPES[kind])
    return out


BARS = _layout(
    "stock_code string, trade_date date, open double, high double, low double, close double, volume double,"
    " turnover double, pre_close double, high_limit double, low_limit double, return double,"
    " is_suspend boolean, multiple int, update_time timestamp"
)
BAR_KEYS = ("trade_date", "stock_code")
PANEL_COLUMNS = ("stock_code", "trade_date", "open", "high", "low", "close", "volume", "turnover")

CALENDAR = _layout("trade_date date, is_trade_day int, update_time timestamp")

FACTOR_VALUES = _layout("trade_date date, stock_code string, factor_value double")

FACTOR_BASIC = _layout(
    "factor_id string, factor_name string, factor_type string, test_universe string, trading_cycle string,"
    " source_url string, create_time timestamp, is_valid boolean, deprecate_reason string,"
    " deprecate_time timestamp, reactivated_time timestamp"
)

FACTOR_BACKTEST = _layout(
    "id bigint, factor_id string, test_universe string, backtest_period string, horizon string, ic_value double,"
    " ic_ir double, sharpe_ratio double, max_drawdown double, turnover double, pass_standard boolean,"
    " backtest_time timestamp, result_json_rel_path string, comment string"
)

UNIVERSE_STATUS = _layout("factor_id string, test_universe string, is_valid boolean, updated_at timestamp")
STATUS_KEYS = ("factor_id", "test_universe")

FACTOR_FILES = _layout(
    "factor_id string, doc_path string, backtest_json_path string, log_path string, factor_values_path string"
)

VALUE_FILES = _layout(
    "id bigint, factor_id string, universe string, artifact_type string, rel_path string, date_start date,"
    " date_end date, trade_date date, created_at timestamp, comment string"
)
BATCH_KEYS = ("factor_id", "universe", "artifact_type", "date_start", "date_end")
DAILY_KEYS = ("factor_id", "universe", "artifact_type", "trade_date")

THRESHOLDS = _layout(
    "id bigint, scene string, version string, ic_min double, ic_ir_min double, sharpe_min double,"
    " max_drawdown_max double, turnover_max double, ic_decay_threshold double, latest_ic_min double,"
    " ic_min_reactivate double, ic_ir_min_reactivate double, sharpe_min_reactivate double,"
    " max_drawdown_max_reactivate double, is_active boolean, created_at timestamp, comment string"
)

FACTOR_DOCS = _layout(
    "factor_id string, factor_name string, formula string, description string, factor_type string,"
    " test_universe string, trading_cycle string, factor_direction string, source_url string, doc_path string"
)
