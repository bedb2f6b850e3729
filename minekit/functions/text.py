"""Text to text, number and date: pure column expressions."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, functions as F


def clean_text(
    c: Column, strip: bool = True, lower: bool = False, remove_quotes: bool = True, normalize_spaces: bool = True
) -> Column:
    """Quotes go first, then white space is squeezed, then trimmed, then lower-cased."""
    if remove_quotes:
        c = F.translate(c, "\"'", "")
    if normalize_spaces:
        c = F.regexp_replace(c, r"\s+", " ")
    if strip:
        c = F.regexp_replace(c, r"^\s+|\s+$", "")
    return F.lower(c) if lower else c


def number_from_text(c: Column, decimal: str = ".", thousands: str = ",", keep_sign: bool = True) -> Column:
    """The number left after white space, thousands marks and other signs are removed, else null."""
    c = F.regexp_replace(c, r"\s", "")
    if thousands:
        c = F.replace(c, F.lit(thousands), F.lit(""))
    if decimal != ".":
        c = F.replace(c, F.lit(decimal), F.lit("."))
    c = F.regexp_replace(c, r"[^0-9.\-+]" if keep_sign else r"[^0-9.]", "")
    return c.try_cast("double")


def safe_float(c: Column) -> Column:
    digits = F.regexp_replace(c.cast("string"), "[^0-9.,-]", "")
    return F.replace(digits, F.lit(","), F.lit("")).try_cast("double")


def safe_int(c: Column) -> Column:
    """The first run of digits as a long."""
    return F.nullif(F.regexp_extract(c.cast("string"), r"(\d+)", 1), F.lit("")).try_cast("long")


def slugify(c: Column) -> Column:
    c = F.lower(F.trim(F.coalesce(c, F.lit(""))))
    c = F.regexp_replace(c, "[^a-z0-9áéíóúñü]+", "_")
    c = F.regexp_replace(c, "^_+|_+$", "")
    return F.coalesce(F.nullif(F.regexp_replace(c, "_+", "_"), F.lit("")), F.lit("na"))


def to_date_time(c: Column, formats: Sequence[str] = ()) -> Column:
    """The first parse that works, as a zone-less timestamp; text that is no date becomes null."""
    text = c.cast("string")
    tries = [F.try_to_timestamp(text, F.lit(f)).cast("timestamp_ntz") for f in formats]
    return F.coalesce(*tries, text.try_cast("timestamp_ntz"))


def absolute_url(base: Column, href: Column) -> Column:
    """Resolve a link found on page `base`."""
    scheme = F.regexp_extract(base, "^([a-zA-Z][a-zA-Z0-9+.-]*:)", 1)
    host = F.regexp_extract(base, "^([a-zA-Z][a-zA-Z0-9+.-]*://[^/?#]*)", 1)
    page = F.regexp_replace(base, "[?#].*$", "")
    folder = F.when(F.length(page) == F.length(host), F.concat(host, F.lit("/"))).otherwise(
        F.regexp_extract(page, "^(.*/)", 1)
    )
    path = F.regexp_extract(href, "^([^?#]*)", 1)
    rest = F.substr(href, F.length(path) + 1)
    below = F.when(path.startswith("/"), path).otherwise(
        F.concat(F.substr(folder, F.length(host) + 1), path)
    )
    return (
        F.when(href == "", base)
        .when(href.rlike("^[a-zA-Z][a-zA-Z0-9+.-]*:"), href)
        .when(href.startswith("//"), F.concat(scheme, href))
        .when(href.startswith("#"), F.concat(F.regexp_replace(base, "#.*$", ""), href))
        .when(href.startswith("?"), F.concat(page, href))
        .otherwise(F.concat(host, _without_dots(below), rest))
    )


def _without_dots(path: Column) -> Column:
    """Drop `.` steps and let `..` cancel the step before it; a leading `/` is kept."""
    steps = F.split(path, "/")
    kept = F.aggregate(
        F.slice(steps, F.lit(2), F.greatest(F.size(steps) - 1, F.lit(0))),
        F.array().cast("array<string>"),
        lambda done, step: F.when(step == ".", done)
        .when(step == "..", F.slice(done, F.lit(1), F.greatest(F.size(done) - 1, F.lit(0))))
        .otherwise(F.concat(done, F.array(step))),
    )
    ends_open = path.rlike(r"/\.{1,2}$")
    return F.concat(
        F.lit("/"), F.array_join(kept, "/"), F.when(ends_open & (F.size(kept) > 0), F.lit("/")).otherwise(F.lit(""))
    )


def list_items(c: Column, separator: str = ",") -> Column:
    """A delimited text cell as an array of trimmed, non-empty items."""
    parts = F.transform(F.split(c, "\\Q" + separator + "\\E"), lambda x: F.regexp_replace(x, r"^\s+|\s+$", ""))
    return F.filter(parts, lambda item: item != "")


def item_count(c: Column) -> Column:
    """How many items a comma-joined text names."""
    return F.coalesce(F.size(list_items(c)), F.lit(0))
