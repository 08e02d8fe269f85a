"""Scalar column expressions (all built-in, so they stay inside whole-stage codegen)."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column
from pyspark.sql import functions as F

# Binary byte units, the truncation marker and widths, the redaction mark.
BYTE_UNITS = ("B", "KiB", "MiB", "GiB", "TiB")
ELLIPSIS = "…"
RENDER_LIMIT = 80
REDACTED = "[redacted]"
# ISO 8601 calendar and week dates, basic and extended, with an optional time and offset.
ISO_DATETIME = (r"^(\d{4})(?:-(\d{2})-(\d{2})|(\d{2})(\d{2})|-W(\d{2})(?:-([1-7]))?|W(\d{2})([1-7])?)"
                r"(?:[T ](\d{2})(?::?(\d{2})(?::?(\d{2})(?:[.,](\d{1,6})\d*)?)?)?(Z|[+-]\d{2}(?::?\d{2})?)?)?$")


def format_bytes(n: Column) -> Column:
    """``0 B``, ``1.00 KiB`` ... ``TiB`` (two decimals, half-even); NULL when negative."""
    expr = None
    for i, unit in enumerate(BYTE_UNITS):
        scaled = n.cast("double") / float(1024 ** i)
        text = (F.concat(n.cast("bigint").cast("string"), F.lit(" B")) if i == 0 else
                F.concat(F.format_string("%.2f", F.bround(scaled, 2)), F.lit(f" {unit}")))
        cond = n < 1024 ** (i + 1) if i < len(BYTE_UNITS) - 1 else F.lit(True)
        expr = F.when(cond, text) if expr is None else expr.when(cond, text)
    return F.when(n < 0, F.lit(None).cast("string")).otherwise(expr)


def thousands(n: Column) -> Column:
    """``{n:,}``."""
    return F.format_number(n, 0)


def render_value(json_text: Column, limit: int = RENDER_LIMIT) -> Column:
    """Keep ``limit`` code points, else ``limit - 1`` and an ellipsis."""
    return F.when(F.length(json_text) <= limit, json_text).otherwise(
        F.concat(F.substring(json_text, 1, limit - 1), F.lit(ELLIPSIS)))


def json_string(text: Column) -> Column:
    """A string as JSON text (quoted, escaped)."""
    wrapped = F.to_json(F.struct(text.alias("v")))
    return F.regexp_extract(wrapped, r'(?s)^\{"v":(.*)\}$', 1)


def acquired_at_utc(text: Column) -> Column:
    """ISO date or datetime (``Z``, offsets; naive = UTC) -> UTC timestamp; NULL if bad.

    All parts are read by one regex and put together in one form, so what passes doesn't
    depend on the cast (which accepts ``2026-08`` and rejects ``20260817``).
    Needs the session time zone at UTC (``session.configure``).
    """
    part = lambda *gs: F.coalesce(*[F.nullif(F.regexp_extract(text, ISO_DATETIME, g), F.lit("")) for g in gs])
    week = part(6, 8).cast("int")
    fourth = F.make_date(part(1).cast("int"), F.lit(1), F.lit(4))  # always in week 1
    by_week = F.date_add(fourth, (week - 1) * 7 - F.weekday(fourth) + F.coalesce(part(7, 9).cast("int"), F.lit(1)) - 1)
    day = F.when(week.between(1, 53), by_week.cast("string")).when(week.isNull(), F.concat_ws("-", part(1), part(2, 4), part(3, 5)))
    clock = F.concat_ws(":", *[F.coalesce(part(g), F.lit("00")) for g in (10, 11, 12)])
    offset = F.coalesce(F.when(part(14) == "Z", F.lit("+00:00")), F.regexp_replace(
        F.rpad(F.regexp_replace(part(14), ":", ""), 5, "0"), r"^(...)(..)$", "$1:$2"), F.lit("+00:00"))
    whole = F.concat(day, F.lit("T"), clock, F.lit("."), F.coalesce(part(13), F.lit("0")), offset)
    return F.when(text.rlike(ISO_DATETIME), F.try_to_timestamp(whole))


def redact(text: Column, secrets: tuple[str, ...]) -> Column:
    """F16: replace each non-empty secret, in order."""
    return reduce(lambda acc, s: F.replace(acc, F.lit(s), F.lit(REDACTED)),
                  [s for s in secrets if s], text)


def url_parts(url: Column) -> dict[str, Column]:
    """X11: scheme, host, path, user info of a URL (NULL parts when unparsable)."""
    part = lambda p: F.try_parse_url(url, F.lit(p))
    return {"scheme": part("PROTOCOL"), "host": part("HOST"), "path": part("PATH"),
            "userinfo": part("USERINFO")}


def url_target(url: Column) -> Column:
    """Target label without credentials: ``scheme://host[:port]/path`` with trailing ``/`` removed."""
    p = url_parts(url)
    place = F.regexp_replace(F.try_parse_url(url, F.lit("AUTHORITY")), "^.*@", "")
    return F.regexp_replace(F.concat(p["scheme"], F.lit("://"), F.when(p["host"].isNotNull(), place),
                                     F.coalesce(p["path"], F.lit(""))), "/+$", "")


def versioned_name(name: Column, sep: str = "_") -> dict[str, Column]:
    """``NNN<sep>rest`` -> numeric version and the rest; ``valid`` flags the form."""
    pat = rf"^([0-9]+){sep}(.*)$"
    valid = name.rlike(pat)
    return {"version": F.when(valid, F.regexp_extract(name, pat, 1).cast("bigint")),
            "name": F.when(valid, F.regexp_extract(name, pat, 2)), "valid": valid}


def yes_no(cond: Column) -> Column:
    """X9."""
    return F.when(cond, "yes").otherwise("NO")


def error_tail(msg: Column, n: int) -> Column:
    """The last ``n`` characters of a message."""
    return F.right(msg, F.lit(n))
