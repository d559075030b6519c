"""Text helpers: whitespace rules, one-pass group extraction, stable identifiers."""

from pyspark.sql import Column, functions as F

# The characters Python's str.strip() removes.
WHITESPACE = (
    "\t\n\x0b\x0c\r\x1c\x1d\x1e\x1f \x85\xa0 "
    "           "
    "    　"
)

# Regex flags and classes with the same meaning of white space in Java.
FLAGS = "(?U)(?d)"
S = r"[\s\x1c-\x1f]"
NS = r"[^\s\x1c-\x1f]"

_MARK = "\x01"


def strip(c: Column) -> Column:
    return F.btrim(c, F.lit(WHITESPACE))


def lstrip(c: Column) -> Column:
    return F.ltrim(c, F.lit(WHITESPACE))


def blank_to_null(c: Column) -> Column:
    return F.nullif(c, F.lit(""))


def dash_to_null(c: Column) -> Column:
    return F.nullif(c, F.lit("-"))


def let(value: Column, body) -> Column:
    """``body(value)`` with the value computed once, however often the body uses it.

    The body runs as a lambda and so stays out of the generated code of the projection, which
    keeps that small. Meant for rare branches: the usual case belongs in a plain expression.
    """
    return F.transform(F.array(value), body)[0]


def pinned(c: Column) -> Column:
    """The same value, marked so that filters on it stay where they are.

    Pushed below the parse, the test of ``errors`` would be rewritten in terms of the raw line and
    repeat the whole parse inside the filter.
    """
    return F.when(F.spark_partition_id() >= 0, c)


def regex_groups(c: Column, pattern: str, count: int) -> Column:
    """All ``count`` groups of a fully anchored pattern as an array.

    A line that does not match gives an array of another size (or null for null). The match runs
    once per row instead of once per group: the groups are rewritten with a marker between them
    and split. Lines that contain the marker themselves take the slower per-group path.
    """
    joined = _MARK.join(f"${i}" for i in range(1, count + 1))
    fast = F.split(F.regexp_replace(c, pattern, joined), _MARK)
    slow = let(c, lambda x: F.when(
        x.rlike(pattern), F.array(*[F.regexp_extract(x, pattern, i) for i in range(1, count + 1)])
    ).otherwise(F.array().cast("array<string>")))
    return F.when(F.contains(c, F.lit(_MARK)), slow).otherwise(fast)


def uuid_text(h: Column) -> Column:
    """32 lower-case hex digits in the 8-4-4-4-12 form."""
    return F.concat_ws(
        "-", F.substring(h, 1, 8), F.substring(h, 9, 4), F.substring(h, 13, 4),
        F.substring(h, 17, 4), F.substring(h, 21, 12),
    )


def stable_uuid(*cols: Column) -> Column:
    """An identifier that a retried task or batch computes again with the same value."""
    parts = [F.coalesce(c.cast("string"), F.lit("\x00")) for c in cols]
    return uuid_text(F.md5(F.concat_ws("\x1f", *parts)))


def parse_uuid(c: Column) -> Column:
    """A UUID in plain, hyphenated, braced or URN notation; anything else is null."""
    hyphened = "[0-9a-f]{8}-[0-9a-f]{4}-[0-9a-f]{4}-[0-9a-f]{4}-[0-9a-f]{12}"
    accepted = rf"(?i)^(?:[0-9a-f]{{32}}|{hyphened}|\{{{hyphened}\}}|urn:uuid:{hyphened})$"
    usual = F.when(c.rlike("^[0-9a-f]{32}$"), uuid_text(c)).when(c.rlike(f"^{hyphened}$"), c)
    digits = F.regexp_replace(F.regexp_replace(c, "(?i)^urn:uuid:", ""), r"[{}\-]", "")
    return F.coalesce(usual, F.when(c.rlike(accepted), let(F.lower(digits), uuid_text)))


def percent(c: Column) -> Column:
    """A share as text with one decimal, such as 70.0%."""
    return F.format_string("%.1f%%", F.bround(c * 100, 1))
