"""Scalar helpers as Spark columns. All of them give null, never an error, for text they can't read."""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import Column
from pyspark.sql import functions as F


def blank_to_null(c: Column) -> Column:
    return F.nullif(F.trim(c), F.lit(""))


def first_text(*columns: Column) -> Column:
    """The first that is neither null nor blank, trimmed."""
    return F.coalesce(*(blank_to_null(c) for c in columns))


def safe_timestamp(c: Column) -> Column:
    return blank_to_null(c).try_cast("timestamp")


def safe_date(c: Column) -> Column:
    """From the first ten characters, if they look like a date."""
    head = F.substring(F.trim(c), 1, 10)
    return F.when(head.rlike(r"^\d{4}-\d{2}-\d{2}$"), head.try_cast("date"))


def safe_decimal(c: Column, kind: str = "decimal(38,10)") -> Column:
    return blank_to_null(c).try_cast(kind)


def utc_text(c: Column) -> Column:
    return F.date_format(c, "yyyy-MM-dd'T'HH:mm:ss.SSSSSS'Z'")


def newest(*columns: Column) -> Column:
    """The largest that is not null."""
    return F.greatest(*columns)


def clamp(n: int | None, default: int, most: int, least: int = 1) -> int:
    return min(max(default if n is None else n, least), most)


def slug(c: Column) -> Column:
    """ASCII letters and digits, other runs as one hyphen; `unknown` if there are none."""
    clean = F.regexp_replace(F.regexp_replace(F.lower(F.trim(c)), "[^a-z0-9]+", "-"), "^-+|-+$", "")
    return F.when(clean == "", "unknown").otherwise(clean)


def unicode_slug(c: Column, most: int = 80) -> Column:
    """Word characters of any script; spaces and hyphens become one hyphen, all else goes; cut at `most`; `row` if nothing is left."""
    worded = F.regexp_replace(F.lower(F.trim(c)), r"(?U)[^\w\s-]", "")
    clean = F.regexp_replace(F.regexp_replace(worded, r"(?U)[-\s]+", "-"), "^-+|-+$", "")
    return F.when(clean == "", "row").otherwise(F.substring(clean, 1, most))


def has_path(payload: Column, path: str) -> Column:
    """Whether a JSON text has a path, a null at its end included, in contrast to one without it; false for text that can't be read."""
    return F.variant_get(F.try_parse_json(payload), path, "variant").isNotNull()


def is_json_null(payload: Column, path: str) -> Column:
    """Whether the path is there and holds null."""
    return F.coalesce(F.is_variant_null(F.variant_get(F.try_parse_json(payload), path, "variant")), F.lit(False))


def sorted_map(m: Column) -> Column:
    return F.map_from_entries(F.array_sort(F.map_entries(m)))


def without_keys(m: Column, keys: Iterable[str]) -> Column:
    return F.map_filter(m, lambda k, _: ~k.isin(list(keys)))


def canonical_json(*fields: Column) -> Column:
    """JSON of named columns in the order given; sort maps first. Nulls are kept."""
    return F.to_json(F.struct(*fields), {"ignoreNullFields": "false"})


def contains_any(text: Column, phrases: Iterable[str]) -> Column:
    return F.coalesce(F.lower(text).rlike("|".join(phrases)), F.lit(False))


def label_text(labels: Column) -> Column:
    """All labels of a map in one lower-case text."""
    return F.lower(F.array_join(F.map_values(F.coalesce(labels, F.map_from_arrays(F.array().cast("array<string>"), F.array().cast("array<string>")))), " "))


def joined(ids: Column) -> Column:
    return F.array_join(ids, ",")


def split_ids(text: Column) -> Column:
    return F.filter(F.transform(F.split(text, ","), lambda x: F.trim(x)), lambda x: x != "")


def arrow_split(text: Column) -> tuple[Column, Column]:
    """Both sides of `a→b`; one period stands for both."""
    parts = F.split(text, "→", 2)
    return F.trim(F.get(parts, F.lit(0))), F.trim(F.coalesce(F.get(parts, F.lit(1)), F.get(parts, F.lit(0))))


def resolve_url(url: Column, base: str) -> Column:
    clean = blank_to_null(url)
    return F.when(clean.startswith("http://") | clean.startswith("https://"), clean).when(clean.startswith("/"), F.concat(F.lit(base), clean)).otherwise(F.concat(F.lit(base + "/"), clean))


def source_event_id(external_id: Column, status: Column, version: Column) -> Column:
    return F.concat_ws(":", external_id, F.coalesce(status, F.lit("UNKNOWN")), F.coalesce(version, F.lit("unversioned")))


def period_key(period: Column) -> Column:
    """Sort key: years by number first, then any other text, null last."""
    clean = F.trim(period)
    is_year = clean.rlike(r"^\d{4}$")
    return F.struct(F.when(period.isNull(), 2).when(is_year, 0).otherwise(1).alias("kind"), F.when(is_year, clean.try_cast("int")).alias("year"), F.coalesce(clean, F.lit("")).alias("text"))


def period_type(period: Column) -> Column:
    clean = F.trim(period)
    return F.when(period.isNull(), "unknown").when(clean.rlike(r"^\d{4}$"), "calendar_year").when(clean.rlike(r"(?i)^\d{4}K[1-4]$"), "ssb_quarter").when(clean.rlike(r"^\d{6}$"), "year_month").otherwise("other")


def period_granularity(period: Column) -> Column:
    kind = period_type(period)
    return F.when(kind == "calendar_year", "year").when(kind == "ssb_quarter", "quarter").when(kind == "year_month", "month").otherwise("unknown")


def period_pair_valid(start: Column, end: Column) -> Column:
    a, b = period_granularity(start), period_granularity(end)
    return (a != "unknown") & (a == b)


def half_even(c: Column, digits: int) -> Column:
    return F.bround(c, digits)


def half_even_scaled(c: Column, digits: int) -> Column:
    """half_even of a double that isn't negative, where a tie is one of the scaled double: what misses it by rounding alone is a tie, too."""
    nearest = lambda x: F.floor(x * 10.0**digits + 0.5) / 10.0**digits
    return F.when((c * 10.0 ** (digits + 1)) % 10 == 5, nearest(c / 2) * 2).otherwise(nearest(c))


def seconds_between(later: Column, earlier: Column) -> Column:
    return F.unix_timestamp(later) - F.unix_timestamp(earlier)


def backoff_minutes(attempts: Column, most_power: int = 8, most: int = 360) -> Column:
    return F.least(F.pow(F.lit(2.0), F.least(attempts, F.lit(most_power))), F.lit(float(most))).cast("int")


def whole_number_text(c: Column) -> Column:
    return F.when(c == F.floor(c), c.cast("long").cast("string")).otherwise(c.cast("string"))
