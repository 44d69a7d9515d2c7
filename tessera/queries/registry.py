"""Queries by name with the SQL that checks them; modules of this package fill it."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from tessera.session import spread

Query = Callable[[SparkSession, str], DataFrame]

_QUERIES: dict[str, Query] = {}
_ORACLE: dict[str, str] = {}


def query(name: str, sql: str | None = None) -> Callable[[Query], Query]:
    """Register a query and, where SQL can express it, the SQL that must give the same rows."""

    def keep(f: Query) -> Query:
        if name in _QUERIES:
            raise ValueError(f"query {name} is registered twice")
        _QUERIES[name] = f
        if sql is not None:
            _ORACLE[name] = sql
        return f

    return keep


#: Tables of long texts and arrays, whose rows cost enough to be spread over all cores when their files have fewer splits.
_LONG = frozenset({"documents", "code_chunks", "file_diffs", "examples", "packed_sequences"})


def table(spark: SparkSession, directory: str, name: str) -> DataFrame:
    df = spark.read.parquet(f"{directory}/{name}.parquet")
    return spread(df) if name in _LONG else df


def _load() -> None:
    from importlib import import_module
    from pkgutil import iter_modules

    import tessera.queries as package

    for m in iter_modules(package.__path__):
        if m.name != "registry":
            import_module(f"tessera.queries.{m.name}")


def queries() -> dict[str, Query]:
    _load()
    return dict(_QUERIES)


def oracle_sql() -> dict[str, str]:
    _load()
    return dict(_ORACLE)
