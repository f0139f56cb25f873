"""Named plans over the test tables, each with its DuckDB oracle SQL.

A plan is ``fn(spark, sf_dir) -> DataFrame``; ``register`` records it with the
equivalent SQL (omitted for operators that are not expressible in SQL, which
get a rows-only check plus their own tests).
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

Plan = Callable[[SparkSession, str], DataFrame]

PLANS: dict[str, Plan] = {}
ORACLES: dict[str, str] = {}


def register(name: str, sql: str | None = None):
    def deco(fn: Plan) -> Plan:
        if name in PLANS:
            raise ValueError(f"duplicate plan {name}")
        PLANS[name] = fn
        if sql is not None:
            ORACLES[name] = bigint_counts(sql.strip())
        return fn

    return deco


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """Read one of the given parquet tables."""
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def bigint_counts(sql: str) -> str:
    """DuckDB's ``count_if`` returns HUGEINT; Spark's returns BIGINT. Wrap every
    ``count_if(...)`` in a BIGINT cast so both sides have the same type."""
    out, i, key = [], 0, "count_if("
    while True:
        j = sql.find(key, i)
        if j < 0 or (j > 0 and (sql[j - 1].isalnum() or sql[j - 1] == "_")):
            if j < 0:
                out.append(sql[i:])
                return "".join(out)
            out.append(sql[i:j + len(key)])
            i = j + len(key)
            continue
        depth, k = 1, j + len(key)
        while depth and k < len(sql):
            depth += {"(": 1, ")": -1}.get(sql[k], 0)
            k += 1
        inner = bigint_counts(sql[j + len(key):k - 1])
        out.append(sql[i:j] + "CAST(" + key + inner + ") AS BIGINT)")
        i = k
