"""Log search: filters, total, newest-first pages, deep pages and ad hoc queries."""

import datetime as dt
from dataclasses import dataclass, replace
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession, Window, functions as F

from lograil.functions.times import iso_text
from lograil.schema import LOG_COLUMNS

# Limits of the search parameters.
DEFAULT_LIMIT = 100
MAX_LIMIT = 1000
MAX_LENGTHS = {
    "source": 50, "source_service": 100, "level": 10, "query": 1000, "trace_id": 255,
    "user_id": 255,
}
DEFAULT_RANGE = dt.timedelta(hours=24)
# Rows a page may skip within its narrowest time bucket before ids are used as well.
MAX_SKIP = 10_000


@dataclass(frozen=True)
class Search:
    """Search parameters. Empty text means no filter; times are inclusive and in UTC."""

    source: str | None = None
    source_service: str | None = None
    level: str | None = None
    time_from: dt.datetime | None = None
    time_to: dt.datetime | None = None
    query: str | None = None
    trace_id: str | None = None
    user_id: str | None = None
    event_time_missing: bool | None = None
    offset: int = 0
    limit: int = DEFAULT_LIMIT

    def checked(self, as_of: dt.datetime) -> "Search":
        """Validate the parameters, upper-case the level and fill the default time range."""
        self.check()
        time_to = self.time_to or as_of
        return replace(
            self, level=self.level.upper() if self.level is not None else None, time_to=time_to,
            time_from=self.time_from or time_to - DEFAULT_RANGE)

    def check(self) -> None:
        """Raise ValueError for parameters out of bounds; every search does this first."""
        for name, longest in MAX_LENGTHS.items():
            value = getattr(self, name)
            if value is not None and len(value) > longest:
                raise ValueError(f"{name}: longer than {longest} characters")
        if self.offset < 0:
            raise ValueError("offset: must be at least 0")
        if not 1 <= self.limit <= MAX_LIMIT:
            raise ValueError(f"limit: must be 1 to {MAX_LIMIT}")


def _instant(value: dt.datetime) -> Column:
    """A time literal in UTC, whatever the zone of the driver's clock."""
    if value.tzinfo is not None:
        value = value.astimezone(dt.timezone.utc).replace(tzinfo=None)
    micros = (value - dt.datetime(1970, 1, 1)) // dt.timedelta(microseconds=1)
    return F.timestamp_micros(F.lit(micros).cast("bigint"))


def predicates(search: Search, partitioned=False) -> list[Column]:
    """One predicate per parameter that is set.

    Values are literals, never query text. ``partitioned`` adds the day range, so that only the
    day folders of the time range are read.
    """
    found = []
    if search.time_from is not None:
        found.append(F.col("created_at") >= _instant(search.time_from))
        if partitioned:
            found.append(F.col("event_date") >= F.to_date(_instant(search.time_from)))
    if search.time_to is not None:
        found.append(F.col("created_at") <= _instant(search.time_to))
        if partitioned:
            found.append(F.col("event_date") <= F.to_date(_instant(search.time_to)))
    for name in ("source", "source_service", "level", "trace_id", "user_id"):
        value = getattr(search, name)
        if value:
            found.append(F.col(name) == F.lit(value))
    if search.event_time_missing is not None:
        found.append(F.col("event_time_missing") == F.lit(int(search.event_time_missing)))
    if search.query:
        # % and _ keep their meaning as wildcards; a backslash is itself.
        text = search.query.replace("\\", "\\\\")
        found.append(F.col("message").ilike(f"%{text}%"))
    return found


def matching(logs: DataFrame, search: Search) -> DataFrame:
    """The records that satisfy every set parameter; none set means all."""
    search.check()
    wanted = predicates(search, "event_date" in logs.columns)
    return logs.filter(reduce(Column.__and__, wanted)) if wanted else logs


def field(logs: DataFrame, name: str, kind: str = "string") -> Column:
    """A member of the metadata (members of members as ``a.b``) as text or another type; null where it is not.

    On a table that was stored with ``fields`` it is a typed column of the files, which a filter on it
    reaches; on other frames the metadata is parsed.
    """
    if not name or not all(part.replace("_", "").replace("-", "").isalnum() for part in name.split(".")):
        raise ValueError(f"field: no member name: {name!r}")
    record = F.col("fields") if "fields" in logs.columns else F.try_parse_json("metadata")
    return F.try_variant_get(record, "$" + "".join(f"['{part}']" for part in name.split(".")), kind)


def total(logs: DataFrame, search: Search) -> DataFrame:
    """Number of matches, independent of the page."""
    return matching(logs, search).agg(F.count("*").alias("total"))


def volume_serves(search: Search) -> bool:
    """Whether the ``hourly_volume`` rollup knows every filter of the search: time, source and level."""
    return not any((search.source_service, search.trace_id, search.user_id, search.query)) and (
        search.event_time_missing is None)


HOUR, _MICRO = dt.timedelta(hours=1), dt.timedelta(microseconds=1)


def hour_counts(volume: DataFrame, logs: DataFrame, search: Search) -> DataFrame:
    """Matches per hour (hour, n): whole hours from the rollup, the cut hours at both ends from the records.

    Without bounds, or with bounds on the hour, no record is read for the lower end; the upper bound is
    inclusive, so its hour is. The rollup must hold what the table holds, as one stream writes both.
    """
    def floor(t):
        t = t if t.tzinfo is None else t.astimezone(dt.timezone.utc).replace(tzinfo=None)
        return t.replace(minute=0, second=0, microsecond=0), t

    whole, edges = [], []
    low = None if search.time_from is None else floor(search.time_from)
    high = None if search.time_to is None else floor(search.time_to)
    if low and high and low[0] == high[0]:
        whole.append(F.lit(False))
        edges.append((low[1], high[1] + _MICRO))
    else:
        if low:
            cut = low[1] != low[0]
            whole.append(F.col("hour") >= _instant(low[0] + HOUR * cut))
            edges += [(low[1], low[0] + HOUR)] * cut
        if high:
            whole.append(F.col("hour") < _instant(high[0]))
            edges.append((high[0], high[1] + _MICRO))
    for name in ("source", "level"):
        if getattr(search, name):
            whole.append(F.col(name) == F.lit(getattr(search, name)))
    known = volume.filter(reduce(Column.__and__, whole, F.lit(True))).groupBy("hour").agg(F.sum("log_count").alias("n"))
    found = matching(logs, search)
    for start, end in edges:
        at = (F.col("created_at") >= _instant(start)) & (F.col("created_at") < _instant(end))
        if "event_date" in logs.columns:
            at = at & (F.col("event_date") == F.to_date(_instant(start)))
        known = known.unionByName(found.filter(at).groupBy(F.date_trunc("hour", "created_at").alias("hour")).agg(
            F.count("*").alias("n")))
    return known.groupBy("hour").agg(F.sum("n").alias("n"))


def rolled_total(volume: DataFrame, logs: DataFrame, search: Search) -> DataFrame:
    """The total from the ``hourly_volume`` rollup where it knows the filters, else from the records."""
    search.check()
    if not volume_serves(search):
        return total(logs, search)
    return hour_counts(volume, logs, search).agg(F.coalesce(F.sum("n"), F.lit(0)).alias("total"))


NEWEST_FIRST = ["created_at", "id"]


def _newest_first():
    return [F.desc("created_at"), F.asc("id")]


def page(logs: DataFrame, search: Search) -> DataFrame:
    """The page of matches, newest first; records of the same time order by id.

    Every task keeps only its best ``offset + limit`` rows. For large offsets use ``deep_page``
    or continue from the last row with ``page_after``.
    """
    return matching(logs, search).select(*LOG_COLUMNS).orderBy(*_newest_first()).offset(
        search.offset).limit(search.limit)


def page_after(logs: DataFrame, search: Search, created_at: dt.datetime, id: str) -> DataFrame:
    """The page that follows the record with this time and id (offset is not used)."""
    at = _instant(created_at)
    older = (F.col("created_at") < at) | ((F.col("created_at") == at) & (F.col("id") > id))
    found = matching(logs, replace(search, time_to=created_at)).filter(older)
    return found.select(*LOG_COLUMNS).orderBy(*_newest_first()).limit(search.limit)


# Ever narrower groups of the result order: (group of a row, its width or None for one time or id
# prefix, newest group first?).
_BUCKETS = [
    (lambda: F.date_trunc("day", "created_at"), dt.timedelta(days=1), True),
    (lambda: F.date_trunc("hour", "created_at"), dt.timedelta(hours=1), True),
    (lambda: F.date_trunc("second", "created_at"), dt.timedelta(seconds=1), True),
    (lambda: F.col("created_at"), None, True),
    (lambda: F.substring("id", 1, 2), None, False),
    (lambda: F.substring("id", 1, 4), None, False),
    (lambda: F.substring("id", 1, 6), None, False),
]


def _time_slice(start: dt.datetime, width, partitioned: bool) -> Column:
    """Rows of a time bucket as plain bounds, which the scan can use to skip days and row groups."""
    at = F.col("created_at")
    found = (at == _instant(start)) if width is None else (
        (at >= _instant(start)) & (at < _instant(start + width)))
    if partitioned:
        found = found & (F.col("event_date") == F.to_date(_instant(start)))
    return found


def deep_page(logs: DataFrame, search: Search, max_skip=MAX_SKIP, volume: DataFrame = None) -> DataFrame:
    """The same page as ``page`` for any offset, without sorting what comes before it.

    Counts per day, hour, second, time and id prefix find the narrow range in which the page
    starts; each count is an aggregation of a slice of the one before. The page itself skips no
    more than ``max_skip`` rows unless more share their time and first six id characters. With the
    ``hourly_volume`` rollup as ``volume`` the counts per day and hour come from it where it knows the
    filters, so that records are read of one hour only.
    """
    found, skip = matching(logs, search), search.offset
    scope = found
    hours = hour_counts(volume, logs, search) if volume is not None and volume_serves(search) else None
    # The group the page starts in, and the groups after it (the page may run past the first).
    inside, beyond = F.lit(True), F.lit(False)
    partitioned = "event_date" in logs.columns
    for bucket, width, newest in _BUCKETS:
        if skip <= max_skip:
            break
        if hours is not None and width is not None and width >= HOUR:
            unit = "day" if width > HOUR else "hour"
            counts = hours.groupBy(F.date_trunc(unit, "hour").alias("b")).agg(F.sum("n").alias("n"))
        else:
            counts = scope.groupBy(bucket().alias("b")).agg(F.count("*").alias("n"))
        # One row per group of this width inside one group of the width before.
        w = Window.orderBy(F.desc("b") if newest else F.asc("b"))
        running = counts.withColumn("upto", F.sum("n").over(w)).filter(F.col("upto") > skip)
        first = running.orderBy("upto").limit(1)
        hit = (first.withColumn("b", F.unix_micros("b")) if newest else first).collect()
        if not hit:
            return found.select(*LOG_COLUMNS).limit(0)
        skip -= hit[0]["upto"] - hit[0]["n"]
        start = hit[0]["b"]
        if newest:
            start = dt.datetime(1970, 1, 1) + dt.timedelta(microseconds=start)
            if hours is not None and width is not None:
                hours = hours.filter((F.col("hour") >= _instant(start)) & (F.col("hour") < _instant(start + width)))
            beyond = beyond | (inside & (F.col("created_at") < _instant(start)))
            inside = inside & _time_slice(start, width, partitioned)
            # No later row is on the page: bounds that prune the last read too.
            reach = F.col("created_at") < _instant(start + width) if width else F.col("created_at") <= _instant(start)
            found = found.filter(reach & (F.col("event_date") <= F.to_date(_instant(start))) if partitioned else reach)
        else:
            beyond = beyond | (inside & (bucket() > start))
            inside = inside & (bucket() == start)
        scope = found.filter(inside)
    rows = found.filter(inside | beyond)
    return rows.select(*LOG_COLUMNS).orderBy(*_newest_first()).offset(skip).limit(search.limit)


def rendered(rows: DataFrame) -> DataFrame:
    """Result rows with both times as ISO text."""
    return rows.withColumns({c: iso_text(F.col(c)) for c in ("created_at", "ingested_at")})


def adhoc(spark: SparkSession, logs: DataFrame, sql: str, args=None, view="logs") -> DataFrame:
    """A parameterised query over the log table; ``args`` are bound, not pasted."""
    logs.createOrReplaceTempView(view)
    return spark.sql(sql, args=args or {})
