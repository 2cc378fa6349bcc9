"""Where queries and their checking SQL are collected."""

QUERIES = {}
ORACLES = {}


def query(name: str, sql: str | None = None):
    """Register a query under a name, with the SQL that must give the same rows."""

    def add(function):
        if name in QUERIES:
            raise ValueError(f"query {name} is registered twice")
        QUERIES[name] = function
        if sql is not None:
            ORACLES[name] = sql
        return function

    return add
