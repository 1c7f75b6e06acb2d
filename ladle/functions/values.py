"""Small scalar expressions on Columns."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from ladle.schemas import STATUS_CODES

# Unicode white space: Java's \s is ASCII only, so the separator class is added.
_SPACE = r"[\s\x{85}\p{Z}]"
_NOT_SPACE = r"[^\s\x{85}\p{Z}]"


def trim_space(text: Column) -> Column:
    """Trim every kind of Unicode white space, not just the ASCII blank."""
    return F.regexp_replace(text, rf"^{_SPACE}++|{_SPACE}++$", "")


def not_blank(text: Column) -> Column:
    return F.coalesce(text.rlike(_NOT_SPACE), F.lit(False))


def keep_not_blank(items: Column) -> Column:
    """Drop null and blank items; the rest keep their outer spaces."""
    return F.filter(items, not_blank)


def collapse_space(text: Column) -> Column:
    """Strip and collapse ASCII white space, as a document title is read."""
    return F.trim(F.regexp_replace(text, r"[\t\n\f\r ]+", " "))


def clean_title(title: Column, suffix: str) -> Column:
    """Remove every `suffix`, trim; a missing title is ''."""
    return F.coalesce(trim_space(F.replace(title, F.lit(suffix), F.lit(""))), F.lit(""))


def pad_id(number: Column, width: int = 8) -> Column:
    """Zero-pad on the left to `width` digits without cutting longer numbers."""
    digits = number.cast("string")
    return F.lpad(digits, F.greatest(F.lit(width), F.length(digits)), F.lit("0"))


def batch_key(first: Column, last: Column) -> Column:
    return F.concat(pad_id(first), F.lit("-"), pad_id(last))


def index_name(source: Column) -> Column:
    return F.concat(F.lit("recipes-from-"), F.regexp_replace(source, "/+$", ""))


def matches_pattern(name: Column, pattern: str) -> Column:
    """Index pattern with `*` wildcards as a LIKE predicate."""
    escaped = pattern.replace("\\", "\\\\").replace("%", "\\%").replace("_", "\\_")
    return name.like(escaped.replace("*", "%"))


def status_code(status: Column) -> Column:
    codes = F.create_map(*[F.lit(x) for pair in STATUS_CODES.items() for x in pair])
    return codes[status]


def status_name(code: Column) -> Column:
    names = F.create_map(*[F.lit(x) for k, v in STATUS_CODES.items() for x in (v, k)])
    return names[code]


def retryable(http_status: Column) -> Column:
    """Statuses after which a fetch is worth repeating later."""
    return http_status.isin(400, 401, 403, 429) | http_status.between(500, 599)
