"""Text clean-up, list and name expressions."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

__all__ = [
    "basename", "safe_int", "regex_first", "list_items", "list_size", "strip_trailing_quote", "digits_only",
    "address_chars_only", "strip_leading_zeros", "sanitize_label", "strip_quotes", "site_label",
    "normalize_user", "login_of", "sector_path", "gb_to_mb", "map_tier", "file_parts", "DAY_PATTERN", "TIME_PATTERN",
]

DAY_PATTERN = r"\d\d\d\d-\d\d-\d\d"
TIME_PATTERN = r"\d\d:\d\d:\d\d"

# Storage tier names.
STORAGE_TIERS = {
    "Tier 1": "SAN replicated DR",
    "Tier 2": "SAN",
    "Tier 3": "NAS",
    "DAS": "DAS",
    "Local": "Local",
    "Exclude": "Exclude",
}


def basename(path: Column) -> Column:
    return F.regexp_extract(path, r"([^/]*)/?$", 1)


def safe_int(text: Column) -> Column:
    """Whole number, or -1 when the text is not one."""
    return F.coalesce(F.when(text.rlike(r"^[+-]?[0-9]+$"), text.try_cast("int")), F.lit(-1))


def regex_first(text: Column, pattern: str) -> Column:
    """First match of ``pattern``, or an empty string."""
    return F.coalesce(F.regexp_extract(text, pattern, 0), F.lit(""))


def list_items(text: Column, separator: str = ",") -> Column:
    """Non-empty items of a delimited list; NULL and '' give an empty array."""
    quoted = "".join("\\" + c if not c.isalnum() else c for c in separator)
    return F.coalesce(F.array_remove(F.split(text, quoted), ""), F.array().cast("array<string>"))


def list_size(text: Column, separator: str = ",") -> Column:
    return F.size(list_items(text, separator))


def strip_trailing_quote(text: Column) -> Column:
    return F.regexp_replace(text, '"$', "")


def digits_only(text: Column) -> Column:
    return F.regexp_replace(text, "[^0-9]", "")


def address_chars_only(text: Column) -> Column:
    return F.regexp_replace(text, "[^0-9.]", "")


def strip_leading_zeros(text: Column) -> Column:
    return F.regexp_replace(text, "^0*", "")


def sanitize_label(text: Column) -> Column:
    """Spaces to ``_``, ``|`` to ``&``, opening parentheses to ``-``, closing ones dropped."""
    return F.translate(text, " |()", "_&-")


def strip_quotes(text: Column) -> Column:
    return F.translate(text, '"\\', "")


def site_label(site: Column, country: Column) -> Column:
    return F.concat(site, F.lit("-"), F.coalesce(country, F.lit("NA")))


def normalize_user(name: Column, domain_suffix: str) -> Column:
    """Lower case without the given domain suffix at its end."""
    lowered, suffix = F.lower(name), domain_suffix.lower()
    return F.when(lowered.endswith(suffix), F.substring(lowered, F.lit(1), F.length(lowered) - len(suffix))).otherwise(lowered)


def login_of(login: Column, domain: Column) -> Column:
    return F.concat(F.lower(login), F.lit("@"), F.lower(domain))


def sector_path(sector: Column, subsector: Column) -> Column:
    return F.when(F.coalesce(subsector, F.lit("")) != "", F.concat(sector, F.lit("/"), subsector)).otherwise(sector)


def gb_to_mb(text: Column) -> Column:
    """Decimal-comma gigabytes to whole megabytes; 0 when the text is no number."""
    number = F.replace(text, F.lit(","), F.lit(".")).try_cast("double")
    return F.coalesce(F.floor(number * 1000 + 0.5).cast("bigint"), F.lit(0).cast("bigint"))


def map_tier(tier: Column) -> Column:
    table = F.create_map(*[F.lit(x) for pair in STORAGE_TIERS.items() for x in pair])
    return F.coalesce(F.try_element_at(table, tier), F.lit("Unknown"))


def file_parts(name: Column) -> dict[str, Column]:
    """What a file name carries: type before the first ``_``, engine, date part, and the extract date as ISO."""
    base = basename(name)
    stem = F.regexp_replace(base, r"\.[^_]+$", "")
    stamp = F.regexp_extract(base, r"^[^_]+_[^_]+_([^.]+)", 1)
    last = F.substring_index(stem, "_", -1)
    iso = F.when(
        last.rlike("^[0-9]{8}"),
        F.concat_ws("-", F.substring(last, 1, 4), F.substring(last, 5, 2), F.substring(last, 7, 2)),
    )
    return {
        "filetype": F.substring_index(base, "_", 1),
        "engine": F.regexp_extract(base, r"^[^_]+_([^_]+)_", 1),
        "filedt": stamp,
        "filedate": iso,
    }
