"""Level names and the mappings onto them."""

from pyspark.sql import Column, functions as F

from lograil.functions.text import strip

# Accepted spellings and the level each one stands for.
LEVEL_ALIASES = {
    "DEBUG": "DEBUG",
    "TRACE": "DEBUG",
    "INFO": "INFO",
    "INFORMATION": "INFO",
    "WARN": "WARN",
    "WARNING": "WARN",
    "ERROR": "ERROR",
    "ERR": "ERROR",
    "FATAL": "FATAL",
    "CRITICAL": "FATAL",
    "PANIC": "FATAL",
}

# Level per syslog severity 0..7.
SEVERITY_LEVELS = ["FATAL", "FATAL", "FATAL", "ERROR", "WARN", "INFO", "INFO", "DEBUG"]

# Level per first digit of an HTTP status.
STATUS_LEVELS = {1: "DEBUG", 2: "INFO", 3: "INFO", 4: "WARN", 5: "ERROR"}

ERROR_LEVELS = ("ERROR", "FATAL")


def normalise_level(level: Column) -> Column:
    """One of the five levels, null for an unknown spelling."""
    pairs = [F.lit(x) for pair in LEVEL_ALIASES.items() for x in pair]
    usual = [name for name, alias in LEVEL_ALIASES.items() if name == alias]
    return F.when(level.isin(usual), level).otherwise(
        F.try_element_at(F.create_map(*pairs), strip(F.upper(level))))


def severity_level(severity: Column) -> Column:
    return F.element_at(F.array(*map(F.lit, SEVERITY_LEVELS)), severity + 1)


def status_level(status: Column) -> Column:
    first_digit = F.floor(status / 100).cast("int")
    pairs = [F.lit(x) for pair in STATUS_LEVELS.items() for x in pair]
    return F.coalesce(F.try_element_at(F.create_map(*pairs), first_digit), F.lit("INFO"))
