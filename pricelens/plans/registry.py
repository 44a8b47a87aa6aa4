"""Registered queries: one per operator of the inventory, each paired (where the
operator is expressible in SQL) with an independent DuckDB oracle text.

Every query reads the driver's tables through the fixture views, over whole
tables; parameters are the operator's own (a vendor slug, a facet value, a
top-k size where the report *is* a top-k).
"""

from __future__ import annotations

import uuid
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from pricelens.plans.fixtures import oracle_with, register_views
from pricelens.session import shared_path
from pricelens.sinks.nameindex import NameIndex

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLE: dict[str, str] = {}

# Parameters the registered queries use (fixture vocabulary).
BASELINE = "supplier-000000000"
VENDOR = "supplier-000000003"
CATEGORY = "MEDIUM"
BRAND = "Brand#4"
SEARCH = "ring"


def R(x: str, n: int) -> str:
    """SQL text of the engine's rounding rule (matches functions.numeric.pround)."""
    return f"CAST(round(TRY_CAST(({x}) AS DECIMAL(28,10)), {n}) AS DOUBLE)"


def query(name: str, sql: str | None = None, views=None):
    def deco(fn):
        QUERIES[name] = fn
        if sql is not None:
            ORACLE[name] = oracle_with(sql, views)
        return fn
    return deco


def stored_names(spark: SparkSession, products: DataFrame) -> NameIndex:
    """A name index in the shared folder, of the offers that are in stock and then of all."""
    index = NameIndex(spark, shared_path(spark, f"name-index-{uuid.uuid4().hex}"))
    index.update(products.where("in_stock"), "first")
    index.update(products, "second")
    return index


def V(spark: SparkSession, sf_dir: str) -> dict[str, DataFrame]:
    return register_views(spark, sf_dir)
