"""Registered queries: a Spark function and, where SQL can say it, the SQL to compare with.

The SQL is written for another engine and independently of the Spark code. It reads the role
tables as common table expressions over the same Parquet tables.
"""

from __future__ import annotations

from collections.abc import Callable
from datetime import datetime

from pyspark.sql import DataFrame, SparkSession

from catalog.role_sql import with_roles
from scanyard.session import tune
from scanyard.sources.roles import Roles, derive_roles

# The moment all registered queries run "as of", and the start date of the test data.
AS_OF = datetime(2001, 6, 15, 10, 0, 0)
START = datetime(1995, 1, 1)

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
# Those on role tables, as they are given them.
ON_ROLES: dict[str, Callable[[Roles], DataFrame]] = {}
SQL: dict[str, str] = {}


def case(name: str, sql: str | None = None):
    """Register a query on role tables, ``f(roles) -> DataFrame``."""
    def register(build: Callable[[Roles], DataFrame]):
        def run(spark: SparkSession, sf_dir: str) -> DataFrame:
            return build(derive_roles(tune(spark), sf_dir))
        ON_ROLES[name] = build
        return _add(name, run, sql, build)
    return register


def table_case(name: str, sql: str | None = None):
    """Register a query on the session and table folder, ``f(spark, sf_dir) -> DataFrame``."""
    def register(build: Callable[[SparkSession, str], DataFrame]):
        def run(spark: SparkSession, sf_dir: str) -> DataFrame:
            return build(tune(spark), sf_dir)
        return _add(name, run, sql, build)
    return register


def _add(name, run, sql, build):
    if name in QUERIES:
        raise ValueError(f"query {name} is registered twice")
    QUERIES[name] = run
    if sql is not None:
        SQL[name] = with_roles(sql)
    return build
