"""Timestamp parsing. Every function returns TIMESTAMP, null where the text is no valid time."""

from pyspark.sql import Column, functions as F

from lograil.functions.text import S, let, strip

# The usual spelling, which a plain cast reads correctly.
_PLAIN = (
    r"^[0-9]{4}-[0-9]{2}-[0-9]{2}"
    r"(?:[T ][0-9]{2}:[0-9]{2}:[0-9]{2}(?:\.[0-9]{1,9})?(?:Z|[+-][0-9]{2}:[0-9]{2})?)?$"
)
# Every other ISO 8601 spelling: basic or week dates, any separator, short times, any offset.
_CLOCK = (
    r"[0-9]{2}(?::[0-9]{2}(?::[0-9]{2}(?:[.,][0-9]+)?)?|[0-9]{2}(?:[0-9]{2}(?:[.,][0-9]+)?)?)?"
)
_ISO = (
    r"^([0-9]{4}-[0-9]{2}-[0-9]{2}|[0-9]{8}|[0-9]{4}-W[0-9]{2}(?:-[0-9])?|[0-9]{4}W[0-9]{2}[0-9]?)"
    rf"(?:.({_CLOCK})(Z|[+-]{_CLOCK})?)?$"
)
# Unpadded date and clock fields.
_LOOSE = (
    r"^([0-9]{4})-([0-9]{1,2})-([0-9]{1,2})(?:T|" + S + r"+)"
    r"([0-9]{1,2}):([0-9]{1,2}):([0-9]{1,2})((?:\.[0-9]{1,6})?)(?:Z?)$"
)
_LOOSE_VALID = (
    r"^[^T]*(?:T[^.Z]*Z?|T[^.Z]*\.[0-9]+Z)$|^[^TZ.]*$"
)
_CLF = (
    r"^([0-9]{1,2})/((?i)jan|feb|mar|apr|may|jun|jul|aug|sep|oct|nov|dec)/([0-9]{4}):"
    r"([0-9]{1,2}):([0-9]{1,2}):([0-9]{1,2})"
    r"((?:\s+(?:[+-][0-9]{2}:?[0-5][0-9](?::?[0-5][0-9](?:\.[0-9]{1,6})?)?|(?-i:Z)))?)$"
)
# The usual spellings of it, which a date format reads correctly.
_CLF_LOCAL = "^[0-9]{2}/[A-Z][a-z]{2}/[0-9]{4}:[0-9]{2}:[0-9]{2}:[0-9]{2}$"
_CLF_ZONED = _CLF_LOCAL[:-1] + " [+-][0-9]{4}$"
_MONTHS = "janfebmaraprmayjunjulaugsepoctnovdec"

MICROS_PER_SECOND = 1_000_000


def _int(c: Column) -> Column:
    return c.try_cast("int")


def _build(year, month, day, hour, minute, second, micros) -> Column:
    """A UTC timestamp from parts; out-of-range parts give null."""
    seconds = (second + micros / F.lit(MICROS_PER_SECOND)).cast("decimal(16,6)")
    ok = (year >= 1) & second.between(0, 59)
    return F.when(
        ok, F.try_make_timestamp(year, month, day, hour, minute, seconds, F.lit("UTC")))


def _clock_parts(text: Column):
    """Hour, minute, second and microseconds of ``HH[[:]MM[[:]SS[.f]]]`` text."""
    digits = F.regexp_replace(F.regexp_replace(text, "[.,].*$", ""), ":", "")
    fraction = F.regexp_extract(text, "[.,]([0-9]+)$", 1)

    def part(start):
        return F.coalesce(_int(F.nullif(F.substring(digits, start, 2), F.lit(""))), F.lit(0))

    micros = F.coalesce(_int(F.rpad(F.nullif(F.substring(fraction, 1, 6), F.lit("")), 6, "0")),
                        F.lit(0))
    return part(1), part(3), part(5), micros


def _offset_micros(text: Column) -> Column:
    """A numeric zone offset in microseconds (0 for none or Z); null from 24 hours on."""
    hour, minute, second, micros = _clock_parts(F.substring(text, 2, 64))
    size = ((hour * 60 + minute) * 60 + second).cast("bigint") * MICROS_PER_SECOND + micros
    signed = F.when(F.startswith(text, F.lit("-")), -size).otherwise(size)
    return (
        F.when(text.isin("", "Z"), F.lit(0).cast("bigint"))
        .when(size < F.lit(24 * 3600 * MICROS_PER_SECOND), signed)
    )


def _shift(ts: Column, minus_micros: Column) -> Column:
    return F.timestamp_micros(F.unix_micros(ts) - minus_micros)


def _iso_date(text: Column) -> Column:
    """Date of an extended, basic or week date spelling."""
    return let(F.regexp_replace(text, "-", ""), _compact_date)


def _compact_date(compact: Column) -> Column:
    year = _int(F.substring(compact, 1, 4))
    week = _int(F.substring(compact, 6, 2))
    weekday = F.coalesce(_int(F.nullif(F.substring(compact, 8, 1), F.lit(""))), F.lit(1))
    jan4 = F.try_to_date(F.concat(F.substring(compact, 1, 4), F.lit("-01-04")))
    monday = F.date_sub(jan4, F.weekday(jan4))
    # The last week of a year is the one that holds 28 December.
    last_week = F.weekofyear(F.try_to_date(F.concat(F.substring(compact, 1, 4), F.lit("-12-28"))))
    by_week = F.when(
        week.between(1, last_week) & weekday.between(1, 7) & (year >= 1),
        F.date_add(monday, (week - 1) * 7 + weekday - 1))
    by_day = F.try_to_date(compact, "yyyyMMdd")
    return F.when(F.contains(compact, F.lit("W")), by_week).otherwise(by_day)


def _parts(text: Column, pattern: str, count: int, body) -> Column:
    """``body`` of the groups of a matching text, null for any other."""
    groups = F.array(*[F.regexp_extract(text, pattern, i) for i in range(1, count + 1)])
    return F.when(text.rlike(pattern), let(groups, body))


def _iso_any(text: Column) -> Column:
    def build(g):
        return let(
            F.struct(_iso_date(g[0]).alias("d"), F.struct(*_clock_parts(g[1])).alias("t")),
            lambda x: _shift(
                _build(F.year(x.d), F.month(x.d), F.day(x.d), *[x.t[f"col{i}"] for i in (1, 2, 3, 4)]),
                _offset_micros(g[2])))
    return _parts(text, "(?d)" + _ISO, 3, build)


def _loose(text: Column) -> Column:
    def build(g):
        micros = F.coalesce(
            _int(F.rpad(F.nullif(F.substring(g[6], 2, 6), F.lit("")), 6, "0")), F.lit(0))
        return F.when(
            text.rlike(_LOOSE_VALID),
            _build(_int(g[0]), _int(g[1]), _int(g[2]), _int(g[3]), _int(g[4]), _int(g[5]), micros))
    return _parts(text, "(?U)(?d)" + _LOOSE, 7, build)


def iso_timestamp(text: Column) -> Column:
    """ISO 8601 text to an instant; text without zone is UTC."""
    plain = F.when(
        text.rlike(_PLAIN) & ~F.startswith(text, F.lit("0000")), text.try_cast("timestamp"))
    rare = let(text, lambda t: F.when(t.isNotNull() & (t != "-"), _iso_any(t)))
    return F.coalesce(plain, rare)


def event_time_text(text: Column) -> Column:
    """Event time from text: ISO 8601, else the four loose date-time formats, else null."""
    plain = F.when(
        text.rlike(_PLAIN) & ~F.startswith(text, F.lit("0000")), text.try_cast("timestamp"))
    rare = let(strip(text), lambda t: F.when(
        t.isNotNull() & ~t.isin("", "-"), F.coalesce(iso_timestamp(t), _loose(t))))
    return F.coalesce(plain, rare)


def event_time_epoch(seconds: Column) -> Column:
    """Event time from epoch seconds; outside the years 1..9999 it is null."""
    s = seconds.cast("double")
    in_range = s.between(F.lit(-62135596800.0), F.lit(253402300799.0))
    return F.when(in_range, F.timestamp_micros(F.rint(s * MICROS_PER_SECOND).cast("bigint")))


def clf_timestamp(text: Column) -> Column:
    """Access-log time ``dd/Mon/yyyy:HH:MM:SS [zone]``; without zone it is UTC."""
    plain = (
        F.when(text.rlike(_CLF_ZONED),
               F.try_to_timestamp(text, F.lit("dd/MMM/yyyy:HH:mm:ss Z")))
        .when(text.rlike(_CLF_LOCAL), F.try_to_timestamp(text, F.lit("dd/MMM/yyyy:HH:mm:ss")))
    )

    def build(g):
        month = ((F.instr(F.lit(_MONTHS), F.lower(g[1])) + 2) / 3).cast("int")
        local = _build(
            _int(g[2]), month, _int(g[0]), _int(g[3]), _int(g[4]), _int(g[5]), F.lit(0))
        return _shift(local, _offset_micros(strip(g[6])))

    return F.coalesce(plain, let(text, lambda t: _parts(t, "(?U)(?d)" + _CLF, 7, build)))


def to_millis(ts: Column) -> Column:
    """Storage precision: milliseconds, the rest cut off."""
    return F.date_trunc("MILLISECOND", ts)


def iso_text(ts: Column) -> Column:
    """Timestamp as ISO text; the fraction is left out when it is zero."""
    base = F.date_format(ts, "yyyy-MM-dd'T'HH:mm:ss")
    millis = F.date_format(ts, "SSS")
    return F.when(millis == "000", base).otherwise(F.concat(base, F.lit("."), millis, F.lit("000")))
