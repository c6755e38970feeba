"""Extraction from factor documents, HTML pages and formula text. Patterns run over whole texts."""

from __future__ import annotations

import json
from html.entities import html5

from pyspark.sql import Column
from pyspark.sql import functions as F

from .codes import id_from_name, zero_pad
from .elem import col, once

# Labels of the document fields; several labels of one field are synonyms.
FIELD_LABELS = {
    "factor_id": ["因子ID"],
    "factor_name": ["因子名称"],
    "formula_dsl": ["公式(DSL)"],
    "formula_raw": ["公式"],
    "description": ["描述"],
    "factor_type": ["因子类型"],
    "test_universe": ["适用股票池", "测试股票池"],
    "trading_cycle": ["调仓周期", "交易周期"],
    "factor_direction": ["因子方向", "方向"],
    "source_url": ["来源URL", "来源链接"],
}
REQUIRED_FIELDS = ["factor_id", "factor_name", "formula", "factor_direction"]
OPTIONAL_FIELDS = ["description", "factor_type", "test_universe", "trading_cycle", "source_url"]
# Labels inside an HTML factor block.
FORMULA_LABEL = "因子公式"
DESCRIPTION_LABELS = ["说明", "描述"]
# Text repairs of crawled formulas, in this order.
FORMULA_REPAIRS = {"，": ",", "DELA Y": "DELAY", "HI GH": "HIGH", "CL OSE": "CLOSE", "\\<": "<", "？": "?"}
# Whole-word renames, in this order.
FORMULA_WORDS = {
    "OPEN": "open",
    "HIGH": "high",
    "LOW": "low",
    "CLOSE": "close",
    "VOLUME": "volume",
    "AMOUNT": "turnover",
    "TURNOVER": "turnover",
    "VWAP": "vwap",
    "DELAY": "REF",
    "MEAN": "MA",
    "SMA": "MA",
    "SMEAN": "MA",
    "STDDEV": "STD",
    "TSRANK": "TS_RANK",
    "TSMIN": "TS_MIN",
    "TSMAX": "TS_MAX",
    "YSRANK": "TS_RANK",
}
# Operator spellings, in this order.
FORMULA_OPERATORS = {"^": "**", "./": "/", ".*": "*", "&&": "&", "||": "|"}


def strip(text: Column) -> Column:
    """Without white space of any script at either end."""
    return F.regexp_replace(text, r"(?U)^\s+|\s+$", "")


def labelled_field(text, labels: list[str]) -> Column:
    """Rest of the line after the first ``label:`` (either colon), trimmed; NULL when absent or empty."""
    names = "|".join(label.replace("(", r"\(").replace(")", r"\)") for label in labels)
    found = strip(F.regexp_extract(col(text), rf"(?U)(?:{names})[:：]\s*([^\n]+)", 1))
    return F.nullif(found, F.lit(""))


def direction(raw: Column) -> Column:
    """long or short; anything else counts as long."""
    low = F.lower(raw)
    return F.when(low.isin("long", "short"), low).otherwise("long")


def unescape(text: Column) -> Column:
    """Character references resolved in one pass, numeric ones and all names of HTML; no-break spaces become blanks."""
    names = {n[:-1]: " " if n == "nbsp;" else c for n, c in html5.items() if n.endswith(";")}
    known = F.from_json(F.lit(json.dumps(names)), "map<string,string>")

    def one(piece: Column) -> Column:
        named = F.regexp_extract(piece, r"^(#[0-9]{1,7}|#[xX][0-9a-fA-F]{1,6}|[A-Za-z][A-Za-z0-9]{0,31});", 1)
        return once(named, lambda name: of_name(piece, name))

    def of_name(piece: Column, name: Column) -> Column:
        hexadecimal = F.lower(F.substring(name, 2, 1)) == "x"
        point = F.when(hexadecimal, F.conv(F.substring(name, 3, 9), 16, 10)).otherwise(F.substring(name, 2, 9)).cast("int")
        valid = point.between(1, 0x10FFFF) & ~point.between(0xD800, 0xDFFF)
        code = F.decode(F.unhex(F.lpad(F.hex(point), 8, "0")), "UTF-32")
        number = F.when(point == 160, F.lit(" ")).when(valid, code).otherwise("\ufffd")
        char = F.when(F.startswith(name, F.lit("#")), number).when(name != "", F.try_element_at(known, name))
        return F.coalesce(F.concat(char, F.substr(piece, F.length(name) + 2)), F.concat(F.lit("&"), piece))

    def resolved(parts: Column) -> Column:
        return F.concat(parts[0], F.array_join(F.transform(F.slice(parts, 2, F.size(parts)), one), ""))

    return once(text, lambda t: F.when(F.contains(t, F.lit("&")), once(F.split(t, "&", -1), resolved)).otherwise(t))


def plain_text(markup: Column) -> Column:
    """Text of a piece of markup, tags replaced by single blanks, entities resolved."""
    return unescape(strip(F.regexp_replace(markup, r"(?U)\s*+(?:<[^>]*+>\s*+)++", " ")))


def page_scope(html, name: str = "preview-contents") -> Column:
    """The element with that id or class from its start tag to its end; the whole page if there is none."""
    def step(acc: Column, piece: Column) -> Column:
        depth = acc["depth"] + F.when(F.startswith(piece, F.lit("</")), -1).when(F.startswith(piece, F.lit("<")), 1).otherwise(0)
        return F.struct(
            depth.alias("depth"), (acc["n"] + F.when(acc["open"], 1).otherwise(0)).alias("n"), (acc["open"] & (depth > 0)).alias("open")
        )

    start = F.struct(F.lit(0).alias("depth"), F.lit(0).alias("n"), F.lit(True).alias("open"))

    def element(rest: Column) -> Column:
        tag = F.regexp_extract(rest, r"^<([A-Za-z][A-Za-z0-9]*)", 1)
        pieces = F.split(rest, F.concat(F.lit("(?i)(?=</?"), tag, F.lit(r"\b)")), -1)
        return once(pieces, lambda p: F.array_join(F.slice(p, 1, F.aggregate(p, start, step)["n"]), ""))

    cut = F.split(col(html), rf"""(?i)(?=<[a-z][^<>]*\b(?:id|class)=["'][^"'<>]*\b{name}\b)""", 2)
    return once(cut, lambda c: F.when(F.size(c) < 2, c[0]).otherwise(element(c[1])))


def block_segments(html, heading: str = "h4", id_prefix: str = "alpha") -> Column:
    """A page cut before each heading whose id has the prefix; what comes before the first is left out."""
    start = rf"""<{heading}\b[^>]*\bid=["']{id_prefix}"""
    return F.filter(F.split(page_scope(html), rf"(?is)(?={start})"), lambda s: s.rlike(rf"(?is)^{start}"))


def block_parts(segment: Column, heading: str = "h4", id_prefix: str = "alpha") -> Column:
    """Struct of a segment's alpha_name, formula and the note before the formula; NULL where it has none.

    The segment is cut at its list items first, so no pattern has to step over text one character at a time.
    """
    content = lambda x: F.split(F.regexp_replace(x, r"(?i)^<li\b[^>]*>", ""), r"(?i)</li\b", 2)
    is_note = lambda x: F.contains(x, F.lit(DESCRIPTION_LABELS[0])) | F.contains(x, F.lit(DESCRIPTION_LABELS[1]))

    def of_label(labelled: Column) -> Column:
        """Formula in the labelled item's text: that of the first item of a list inside it, else its own."""
        inside = F.coalesce(F.get(F.split(labelled, r"(?i)<ul\b[^>]*>", 2), F.lit(1)), F.lit(""))
        inner = F.coalesce(F.get(F.split(inside, r"(?i)<li\b[^>]*>", 2), F.lit(1)), F.lit(""))
        own = F.regexp_replace(plain_text(labelled), rf"(?U)^{FORMULA_LABEL}[:：]\s*", "")
        return strip(F.coalesce(F.nullif(plain_text(inner), F.lit("")), own))

    def of_items(items: Column, own_text: Column, place: Column) -> Column:
        # the labelled item up to the first item end, its own or a nested item's
        tail = content(F.array_join(F.slice(items, F.greatest(place, F.lit(1)), F.size(items)), ""))
        labelled = once(tail, lambda t: F.when((place > 0) & (F.size(t) > 1), t[0]).otherwise(""))
        before = F.when(place > 0, F.slice(own_text, 1, place - 1)).otherwise(own_text)
        note = plain_text(F.coalesce(F.get(F.filter(before, is_note), F.lit(0)), F.lit("")))
        return F.struct(
            name(segment).alias("alpha_name"),
            F.nullif(once(labelled, of_label), F.lit("")).alias("formula"),
            F.nullif(note, F.lit("")).alias("note"),
        )

    def name(segment: Column) -> Column:
        title = plain_text(F.regexp_extract(segment, rf"(?is)<{heading}\b[^>]*>(.*?)</{heading}>", 1))
        named = F.nullif(F.regexp_extract(title, r"(?i)(alpha_?\d+)", 1), F.lit(""))
        own_id = F.regexp_extract(segment, rf"""(?is)\bid=["']({id_prefix}[^"']*)""", 1)
        return F.coalesce(named, F.concat(F.lit("alpha_"), zero_pad(F.regexp_replace(own_id, r"\D", ""), 3)))

    def of_text(items: Column, own_text: Column) -> Column:
        labels = F.transform(own_text, lambda x: F.contains(x, F.lit(FORMULA_LABEL)))
        place = F.coalesce(F.array_position(labels, True), F.lit(0)).cast("int")
        return once(place, lambda p: of_items(items, own_text, p))

    items = F.filter(F.split(segment, r"(?i)(?=<li\b)"), lambda x: x.rlike(r"(?i)^<li\b"))
    return once(items, lambda i: once(F.transform(i, lambda x: content(x)[0]), lambda t: of_text(i, t)))


def resolve_blocks(parts) -> Column:
    """Array of structs (alpha_name, factor_id, raw_formula, description), one per heading with a formula.

    A heading's formula is the first one at or after it, its description the first note up to that formula.
    """
    parts = col(parts)

    def one(part: Column, i: Column) -> Column:
        rest = F.slice(parts, i + 1, F.size(parts))
        source = F.filter(rest, lambda p: p["formula"].isNotNull())
        place = F.array_position(F.transform(rest, lambda p: p["formula"].isNotNull()), True)
        upto = F.slice(rest, 1, F.greatest(place, F.lit(1)).cast("int"))
        notes = F.filter(upto, lambda p: p["note"].isNotNull())
        return F.struct(
            part["alpha_name"].alias("alpha_name"),
            id_from_name(part["alpha_name"]).alias("factor_id"),
            F.get(source, F.lit(0))["formula"].alias("raw_formula"),
            F.coalesce(F.get(notes, F.lit(0))["note"], F.lit("")).alias("description"),
        )

    return F.filter(F.transform(parts, one), lambda b: b["raw_formula"].isNotNull())


def clean_formula(raw) -> Column:
    """Crawled formula text with the panel's field and function names and Python operators.

    Conditional ``a ? b : c`` expressions stay as they are; missing closing brackets are added at the end.
    """
    f = col(raw)
    for bad, good in FORMULA_REPAIRS.items():
        f = F.replace(f, F.lit(bad), F.lit(good))
    for word, name in FORMULA_WORDS.items():
        f = F.regexp_replace(f, rf"\b{word}\b", name)
    for old, new in FORMULA_OPERATORS.items():
        f = F.replace(f, F.lit(old), F.lit(new))
    f = F.regexp_replace(f, r"(^|[^<>=!])=(?!=)", "$1==")
    opened, closed = [F.length(f) - F.length(F.replace(f, F.lit(c), F.lit(""))) for c in "()"]
    return F.concat(f, F.repeat(F.lit(")"), F.greatest(opened - closed, F.lit(0))))
