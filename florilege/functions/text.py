"""Scalar functions on strings, numbers and places."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def nth_token(col: Column, sep: str, n: int = 1) -> Column:
    return F.split_part(col, F.lit(sep), F.lit(n))


def strip_suffix(col: Column, regex: str) -> Column:
    return F.regexp_replace(col, f"{regex}$", "")


def prefix_if_present(col: Column, prefix: str) -> Column:
    return F.when(col.isNotNull(), F.concat(F.lit(prefix), col.cast("string"))).otherwise("")


def join_non_null(cols: list[Column], sep: str = ",") -> Column:
    return F.concat_ws(sep, *(c.cast("string") for c in cols))


def pad_id(col: Column, prefix: str, width: int) -> Column:
    return F.concat(F.lit(prefix), F.lpad(col.cast("string"), width, "0"))


def ordered_range(start: Column, stop: Column) -> tuple[Column, Column]:
    return F.least(start, stop), F.greatest(start, stop)


def strand_code(col: Column) -> Column:
    return F.when(col.isin("-", "minus"), -1).otherwise(1)


def resolve_name(kind: Column, gene: Column, product: Column, tag: Column, placeholders: tuple[str, ...], nameless: tuple[str, ...]) -> Column:
    """Gene, else product unless it is a placeholder, else tag; nothing for the nameless kinds."""
    real = F.when(~product.isin(*placeholders), product)
    found = F.coalesce(*(F.nullif(c, F.lit("")) for c in (gene, real, tag)))
    return F.when(kind.isin(*nameless), "").otherwise(F.coalesce(found, F.lit("")))


def pick_keys(col: Column, keys: list[str]) -> list[Column]:
    """Values of a JSON object's keys as columns."""
    return [F.get_json_object(col, f"$.{k}").alias(k) for k in keys]


def valid_id(col: Column, regex: str = r"^\w+\.\d+$") -> Column:
    return F.coalesce(col.rlike(regex), F.lit(False))


def hit_coverage(length: Column, gaps: Column, subject_length: Column) -> Column:
    return F.try_divide(100 * (length - gaps), subject_length)


def categorize(rules: list[tuple[Column, str]], default: str) -> Column:
    out = None
    for condition, name in rules:
        out = F.when(condition, name) if out is None else out.when(condition, name)
    return F.lit(default) if out is None else out.otherwise(default)


def prefer(a: Column, b: Column) -> Column:
    return F.coalesce(a, b)


def split_list(col: Column, sep: str = ",") -> Column:
    """Distinct items of a delimited list, trimmed and without blanks."""
    return F.array_distinct(F.filter(F.transform(F.split(col, sep), F.trim), lambda x: x != ""))


def join_list(items: Column, sep: str = ",") -> Column:
    """Null for no item, the item for one, else all joined in order."""
    return F.when(F.size(items) > 0, F.array_join(F.array_sort(items), sep))


def row_terms(cols: list[Column], sep: str = " ") -> Column:
    return F.array_join(F.array_compact(F.array(*(F.nullif(F.trim(c), F.lit("")) for c in cols))), sep)


def normalize_term(col: Column) -> Column:
    """Lower case; runs of anything but letters and digits become one blank."""
    return F.trim(F.regexp_replace(F.lower(col), r"[^\p{L}\p{N}]+", " "))


def lowest_rank(cols: list[str], with_rank: bool = False) -> Column:
    """The deepest non-empty of the ranks, given from the top."""
    return F.coalesce(*(F.when(F.nullif(F.col(c), F.lit("")).isNotNull(), F.concat(F.lit(f"{c}:" if with_rank else ""), F.col(c))) for c in reversed(cols)))


def parse_latlng(col: Column) -> tuple[Column, Column]:
    """From ``lat;lng``; null where a part is no number."""
    return F.split_part(col, F.lit(";"), F.lit(1)).try_cast("double"), F.split_part(col, F.lit(";"), F.lit(2)).try_cast("double")


def haversine_km(lat1: Column, lng1: Column, lat2: Column, lng2: Column) -> Column:
    a = F.pow(F.sin(F.radians(lat2 - lat1) / 2), 2) + F.cos(F.radians(lat1)) * F.cos(F.radians(lat2)) * F.pow(F.sin(F.radians(lng2 - lng1) / 2), 2)
    return 2 * 6371.0 * F.asin(F.sqrt(F.least(a, F.lit(1.0))))


def midpoint(lat1: Column, lng1: Column, lat2: Column, lng2: Column) -> tuple[Column, Column]:
    """Of the great circle between two places, in degrees."""
    x = F.cos(F.radians(lat1)) * F.cos(F.radians(lng1)) + F.cos(F.radians(lat2)) * F.cos(F.radians(lng2))
    y = F.cos(F.radians(lat1)) * F.sin(F.radians(lng1)) + F.cos(F.radians(lat2)) * F.sin(F.radians(lng2))
    z = F.sin(F.radians(lat1)) + F.sin(F.radians(lat2))
    return F.degrees(F.atan2(z, F.sqrt(x * x + y * y))), F.degrees(F.atan2(y, x))


def levenshtein_ratio(a: Column, b: Column) -> Column:
    """0 to 100; two empty strings are alike."""
    longest = F.greatest(F.length(a), F.length(b))
    return F.when(longest == 0, 100.0).otherwise(100.0 * (1 - F.levenshtein(a, b) / longest))


def needs_location_review(dist_km: Column, similarity: Column, far: float = 20, alike: float = 80) -> Column:
    return (dist_km > far) & (similarity < alike)


def p_stars(p: Column) -> Column:
    return F.when(p <= 0.0001, "****").when(p <= 0.001, "***").when(p <= 0.01, "**").when(p <= 0.05, "*").otherwise("ns")
