"""Factor documents as tables: fields out of texts, texts out of rows."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions import text as T
from ..functions.codes import generated_id
from .lineage import cut_lineage
from .upsert import same_keys


def parse_documents(docs: DataFrame, text: str = "text", path: str = "doc_path") -> tuple[DataFrame, DataFrame]:
    """Factor definitions, and the documents rejected with the required fields they lack.

    The DSL formula is preferred to the plain one; optional fields default to ''.
    """
    raw = {name: T.labelled_field(text, labels) for name, labels in T.FIELD_LABELS.items()}
    # through inline, so that no later filter is pushed into the patterns and evaluates them again
    found = docs.select(path, F.inline(F.array(F.struct(*[c.alias(name) for name, c in raw.items()]))))
    found = found.withColumn("formula", F.coalesce("formula_dsl", "formula_raw"))
    lacking = F.filter(
        F.array(*[F.when(F.col(c).isNull(), F.lit(c)) for c in T.REQUIRED_FIELDS]), lambda c: c.isNotNull()
    )
    found = found.withColumn("missing_fields", lacking)
    good = found.where(F.size("missing_fields") == 0).select(
        "factor_id",
        "factor_name",
        "formula",
        *[F.coalesce(c, F.lit("")).alias(c) for c in T.OPTIONAL_FIELDS[:-1]],
        T.direction(F.col("factor_direction")).alias("factor_direction"),
        F.coalesce("source_url", F.lit("")).alias("source_url"),
        F.col(path).alias("doc_path"),
    )
    bad = found.where(F.size("missing_fields") > 0).select(F.col(path).alias("doc_path"), "missing_fields")
    return good, bad


def extract_blocks(
    pages: DataFrame, keep: list[str], html: str = "html", heading: str = "h4", id_prefix: str = "alpha"
) -> DataFrame:
    """One row per factor block found in a page, next to the page's ``keep`` columns.

    Each step is a column of its own, so that a page is cut and its segments parsed once.
    """
    cut = pages.select(*keep, T.block_segments(html, heading, id_prefix).alias("_segments"))
    parsed = cut.select(*keep, F.transform("_segments", lambda s: T.block_parts(s, heading, id_prefix)).alias("_parts"))
    return parsed.select(*keep, F.explode(T.resolve_blocks("_parts")).alias("b")).select(*keep, "b.*")


# Label of each rendered line, in order.
RENDERED = [
    ("factor_id", "因子ID"),
    ("factor_name", "因子名称"),
    ("formula", "公式(DSL)"),
    ("description", "描述"),
    ("factor_type", "因子类型"),
    ("test_universe", "适用股票池"),
    ("trading_cycle", "调仓周期"),
    ("factor_direction", "因子方向"),
    ("source_url", "来源URL"),
]


def render_document(title: str = "因子说明文档") -> Column:
    """Labelled text of a factor definition row; missing values become empty."""
    last = len(RENDERED) - 1
    lines = [
        F.concat(F.lit(f"{label}: "), F.coalesce(F.col(c), F.lit("")), F.lit("" if i == last else "  "))
        for i, (c, label) in enumerate(RENDERED)
    ]
    return F.concat(F.lit(f"# {title}\n\n"), F.concat_ws("\n", *lines), F.lit("\n"))


def number_raw_factors(raw: DataFrame, order: str, day, max_factors: int | None = None) -> DataFrame:
    """Generated ids by ordinal within each source, which may have any number of rows.

    Rows are sorted by (source, order) over all partitions; a row's ordinal is its place in its partition plus
    the source's rows in the partitions before. ``max_factors`` keeps the first of each source only.
    """
    at = F.monotonically_increasing_id()  # the partition above 33 bits of row number
    ranged = raw.repartitionByRange("source", order).sortWithinPartitions("source", order).withColumn("_at", at)
    placed = cut_lineage(ranged.withColumn("_part", F.shiftright("_at", 33)))
    blocks = placed.groupBy("source", "_part").agg(F.count("*").alias("_n"), F.min("_at").alias("_first"))
    upto = Window.partitionBy("source").orderBy("_part").rowsBetween(Window.unboundedPreceding, 0)
    blocks = blocks.select("source", "_part", (F.sum("_n").over(upto) - F.col("_n") + 1 - F.col("_first")).alias("_shift"))
    ordinal = (F.col("_at") + F.col("_shift")).cast("int")
    numbered = same_keys(placed, blocks, ["source", "_part"], "inner").withColumn("ordinal", ordinal).drop("_at", "_part", "_shift")
    if max_factors is not None:
        numbered = numbered.where(F.col("ordinal") <= max_factors)
    return numbered.withColumn("factor_id", generated_id("source", F.lit(day).cast("date"), "ordinal"))
