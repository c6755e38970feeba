"""Instrument codes, universe codes, dates, ids and paths."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from .elem import col

# Exchange suffixes.
VENDOR_TO_INTERNAL = {".XSHE": ".SZ", ".XSHG": ".SH"}
VENDOR_DROPPED = [".CCFX", ".XDCE", ".XSGE", ".XZCE", ".XINE"]
# Source keys of generated ids.
SOURCE_TAGS = {"fd": "FD", "bq": "BQ", "jq": "JQ"}


def universe_code(u, blank: str = "CUSTOM") -> Column:
    """Trimmed upper case, ALL_A written ALL, blank or NULL replaced by ``blank``."""
    u = F.upper(F.trim(F.coalesce(col(u), F.lit(""))))
    return F.when(u == "", blank).when(u == "ALL_A", "ALL").otherwise(u)


def _suffix_end(*suffixes: str) -> str:
    return "(?:" + "|".join(s.replace(".", r"\.") for s in suffixes) + ")$"


def vendor_to_internal(code) -> Column:
    """000001.XSHE -> 000001.SZ, 600000.XSHG -> 600000.SH; futures lose their suffix."""
    out = col(code)
    for vendor, internal in VENDOR_TO_INTERNAL.items():
        out = F.regexp_replace(out, _suffix_end(vendor), internal)
    return F.regexp_replace(out, _suffix_end(*VENDOR_DROPPED), "")


def source_to_internal(symbol) -> Column:
    """``vendor_to_internal`` on a trimmed symbol; NULL and blank give ''."""
    return vendor_to_internal(F.trim(F.coalesce(col(symbol), F.lit(""))))


def internal_to_vendor(code) -> Column:
    out = F.trim(col(code))
    for vendor, internal in VENDOR_TO_INTERNAL.items():
        out = F.regexp_replace(out, _suffix_end(internal), vendor)
    return out


def infer_suffix(code) -> Column:
    """A code without .SH or .SZ gets .SH when it starts with 6, else .SZ; blank gives NULL."""
    c = F.trim(col(code))
    return (
        F.when(c == "", None)
        .when(c.endswith(".SH") | c.endswith(".SZ"), c)
        .when(c.startswith("6"), F.concat(c, F.lit(".SH")))
        .otherwise(F.concat(c, F.lit(".SZ")))
    )


def to_date(v) -> Column:
    """A date from 'YYYY-MM-DD' or 'YYYYMMDD' text; blank or unreadable gives NULL."""
    iso = F.regexp_replace(F.trim(col(v)), r"^(\d{4})(\d{2})(\d{2})$", "$1-$2-$3")
    return iso.try_cast("date")


def to_yyyymmdd(v) -> Column:
    """Text form YYYYMMDD of ``to_date``, '' when there is no date."""
    return F.coalesce(F.date_format(to_date(v), "yyyyMMdd"), F.lit(""))


def split_list(s) -> Column:
    """Trimmed non-empty items of a comma list."""
    items = F.transform(F.split(F.coalesce(col(s), F.lit("")), ","), lambda x: F.trim(x))
    return F.filter(items, lambda x: x != "")


def file_tag(u) -> Column:
    """A universe name fit for a file name; blank gives ALL."""
    u = F.trim(F.coalesce(col(u), F.lit("")))
    return F.when(u == "", "ALL").otherwise(F.regexp_replace(u, r'[\\/:*?"<>|]', "_"))


def rel_path(*parts) -> Column:
    """Path parts joined with '/', back slashes turned."""
    return F.replace(F.concat_ws("/", *[F.lit(p) if isinstance(p, str) else p for p in parts]), F.lit("\\"), F.lit("/"))


def generated_id(source_key, day, ordinal) -> Column:
    """FACTOR_<SRC>_<YYYYMMDD>_<nnn>; an unknown source key is upper-cased."""
    key = col(source_key)
    tag = F.upper(key)
    for k, v in SOURCE_TAGS.items():
        tag = F.when(key == k, v).otherwise(tag)
    return F.concat_ws(
        "_", F.lit("FACTOR"), tag, F.date_format(col(day), "yyyyMMdd"), zero_pad(col(ordinal).cast("string"), 3)
    )


def zero_pad(digits: Column, width: int) -> Column:
    """Left zeros up to the width; longer text stays whole."""
    return F.when(F.length(digits) >= width, digits).otherwise(F.lpad(digits, width, "0"))


def id_from_name(name) -> Column:
    """alpha_1 -> JQ_ALPHA_001 (000 when the name has no number)."""
    return F.concat(F.lit("JQ_ALPHA_"), zero_pad(F.regexp_extract(col(name), r"(\d+)", 1), 3))
