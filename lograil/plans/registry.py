"""Registry of the named queries and of the SQL that gives the same rows."""

QUERIES = {}
ORACLES = {}


def query(name, sql=None):
    """Register ``function(spark, folder) -> DataFrame`` under a name."""
    def add(function):
        QUERIES[name] = function
        if sql:
            ORACLES[name] = sql
        return function
    return add
