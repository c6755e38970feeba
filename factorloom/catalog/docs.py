"""Document jobs over conversations, pages and parts."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions import text as T
from ..operators import documents as dc
from ..operators.lineage import run_folder
from ..sources import readers, writers
from .base import table

QUERIES, SQL = {}, {}


def _definitions(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Conversation turns as factor definitions; the text is the description, on one line."""
    user = F.col("role") == "user"
    return table(spark, sf_dir, "conversations").select(
        F.concat_ws("_", F.lit("C"), "conv_id", "turn").alias("factor_id"),
        F.when(F.col("role") != "system", F.concat(F.lit("turn "), "turn")).alias("factor_name"),
        F.concat(F.lit("RANK(close) * "), "turn").alias("formula"),
        F.trim(F.regexp_replace("text", r"\s+", " ")).alias("description"),
        F.when(user, "量价").alias("factor_type"),
        F.lit("ALL").alias("test_universe"),
        F.col("role").alias("trading_cycle"),
        F.when(user, "SHORT").otherwise(F.col("role")).alias("factor_direction"),
        F.concat(F.lit("http://x/"), "conv_id").alias("source_url"),
    )


def _rendered(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Rendered documents: users' with other labels and colons and a plain formula, systems' without a name label."""
    df = _definitions(spark, sf_dir).withColumn("text", dc.render_document())
    other = F.replace(F.replace(F.col("text"), F.lit("公式(DSL): "), F.lit("公式：")), F.lit("因子方向: "), F.lit("方向："))
    nameless = F.replace(F.col("text"), F.lit("因子名称"), F.lit("名称"))
    role = F.col("trading_cycle")
    text = F.when(role == "user", other).when(role == "system", nameless).otherwise(F.col("text"))
    return df.select(F.col("factor_id").alias("doc_path"), text.alias("text"))


def doc_render(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _definitions(spark, sf_dir).select("factor_id", dc.render_document().alias("text"))


def doc_fields(spark: SparkSession, sf_dir: str) -> DataFrame:
    good, _ = dc.parse_documents(_rendered(spark, sf_dir))
    return good


def doc_table(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The rendered documents written as a table of few files, read and parsed again; then those of users once more by path."""
    path = run_folder(spark, "documents")
    writers.write_document_table(_rendered(spark, sf_dir), path)
    good, _ = dc.parse_documents(readers.read_document_table(spark, path))
    users = _definitions(spark, sf_dir).where("trading_cycle = 'user'").select(F.col("factor_id").alias("doc_path"))
    again, _ = dc.parse_documents(readers.read_document_table(spark, path, users))
    return good.unionByName(again)


def doc_rejects(spark: SparkSession, sf_dir: str) -> DataFrame:
    _, bad = dc.parse_documents(_rendered(spark, sf_dir))
    return bad.select("doc_path", F.concat_ws(",", "missing_fields").alias("missing_fields"))


def html_blocks(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Whole pages, each followed by three factor blocks: nested, plain, and one without a formula of its own."""
    i = F.col("page_id").cast("string")
    blocks = F.concat(
        F.lit('<div id="preview-contents"><h3>Factors</h3><h4 id="alpha'), i, F.lit('">Alpha_'), i,
        F.lit(" factor</h4><p>text</p><ul><li>说明: first of <b>page</b> "), i,
        F.lit("</li><li>因子公式<ul><li>RANK(CLOSE) &lt; "), i,
        F.lit(' &amp;&amp; <i>VOLUME</i></li></ul></li></ul><h4 class="x" id="alpha'), i,
        F.lit('b">no name</h4><ul><li>note</li></ul><h4 id="alphac">alpha7</h4><ul><li>因子公式：MEAN(OPEN,'), i,
        F.lit(")&gt;0</li><li>描述: late</li></ul><h4 id='other'>alpha9</h4><ul><li>x</li></ul></div>"),
    )
    pages = table(spark, sf_dir, "pages").withColumn("html", F.concat("html", blocks))
    return dc.extract_blocks(pages, ["page_id", "url"])


def _formula() -> Column:
    n = F.col("p_size").cast("string")
    return F.concat(
        F.when(F.col("p_size") % 2 == 0, "SMA(CLOSE，").otherwise("STDDEV((CL OSE,"), n,
        F.lit(")^2 && (DELA Y(HI GH,"), n,
        F.lit(")=OPEN || AMOUNT>=RET\\<"), F.col("p_retailprice").cast("int").cast("string"),
        F.when(F.col("p_size") % 3 == 0, ".*TSRANK(VWAP,6)./MEAN(LOW,4) ").otherwise("!=OPENED==VOLUME？1:"), n,
    )


def formula_cleanup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "part").select("p_partkey", T.clean_formula(_formula()).alias("formula"))


for _q in (doc_render, doc_fields, doc_table, doc_rejects, html_blocks, formula_cleanup):
    QUERIES[_q.__name__] = _q

_DEF = """
d AS (
  SELECT 'C_' || conv_id || '_' || turn AS factor_id, CASE WHEN role <> 'system' THEN 'turn ' || turn END AS factor_name,
    'RANK(close) * ' || turn AS formula, trim(regexp_replace(text, '\\s+', ' ', 'g')) AS description,
    CASE WHEN role = 'user' THEN '量价' END AS factor_type, 'ALL' AS test_universe, role AS trading_cycle,
    CASE WHEN role = 'user' THEN 'SHORT' ELSE role END AS factor_direction, 'http://x/' || conv_id AS source_url
  FROM conversations
)"""
SQL["doc_render"] = f"""WITH {_DEF}
SELECT factor_id, '# 因子说明文档' || chr(10) || chr(10) || '因子ID: ' || factor_id || '  ' || chr(10)
  || '因子名称: ' || coalesce(factor_name, '') || '  ' || chr(10) || '公式(DSL): ' || formula || '  ' || chr(10)
  || '描述: ' || description || '  ' || chr(10) || '因子类型: ' || coalesce(factor_type, '') || '  ' || chr(10)
  || '适用股票池: ' || test_universe || '  ' || chr(10) || '调仓周期: ' || trading_cycle || '  ' || chr(10)
  || '因子方向: ' || factor_direction || '  ' || chr(10) || '来源URL: ' || source_url || chr(10) AS text
FROM d"""
# an empty field's pattern runs on to the next line, as the documents' format has it
SQL["doc_fields"] = f"""WITH {_DEF}
SELECT factor_id, factor_name, formula, description,
  coalesce(factor_type, '适用股票池: ALL') AS factor_type, test_universe, trading_cycle,
  CASE WHEN trading_cycle = 'user' THEN 'short' ELSE 'long' END AS factor_direction, source_url, factor_id AS doc_path
FROM d WHERE trading_cycle <> 'system'"""
SQL["doc_table"] = f"""{SQL["doc_fields"]} UNION ALL
SELECT * FROM ({SQL["doc_fields"]}) WHERE trading_cycle = 'user'"""
SQL["doc_rejects"] = f"WITH {_DEF}\nSELECT factor_id AS doc_path, 'factor_name' AS missing_fields FROM d WHERE trading_cycle = 'system'"
SQL["html_blocks"] = """
SELECT page_id, url, 'Alpha_' || page_id AS alpha_name, format('JQ_ALPHA_{:03d}', page_id) AS factor_id,
  'RANK(CLOSE) < ' || page_id || ' && VOLUME' AS raw_formula, '说明: first of page ' || page_id AS description FROM pages
UNION ALL
SELECT page_id, url, 'alpha_' || format('{:03d}', page_id), format('JQ_ALPHA_{:03d}', page_id), 'MEAN(OPEN,' || page_id || ')>0', '' FROM pages
UNION ALL
SELECT page_id, url, 'alpha7', 'JQ_ALPHA_007', 'MEAN(OPEN,' || page_id || ')>0', '' FROM pages"""
SQL["formula_cleanup"] = """
WITH p AS (SELECT *, CAST(p_size AS VARCHAR) AS n FROM part)
SELECT p_partkey,
  CASE WHEN p_size % 2 = 0 THEN 'MA(close,' ELSE 'STD((close,' END || n || ')**2 & (REF(high,' || n || ')==open | turnover>=RET<'
  || CAST(trunc(p_retailprice) AS INTEGER)
  || CASE WHEN p_size % 3 = 0 THEN '*TS_RANK(vwap,6)/MA(low,4) ' ELSE '!=OPENED==volume?1:' END || n
  || CASE WHEN p_size % 2 = 0 THEN ')' ELSE '))' END AS formula
FROM p"""
