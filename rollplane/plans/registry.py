"""Registry of named queries (Spark builder + DuckDB SQL twin).

Every query reads the driver tables of ``sf_dir`` (or fixtures Spark
derives from them) in full; its SQL twin reads the same tables.
"""

from __future__ import annotations

from collections.abc import Callable

import functools

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from ..session import configure

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLE: dict[str, str] = {}


def register(name: str, sql: str | None = None):
    def deco(fn: Callable[[SparkSession, str], DataFrame]):
        if name in QUERIES:
            raise ValueError(f"duplicate query {name}")

        @functools.wraps(fn)
        def run(spark: SparkSession, sf_dir: str) -> DataFrame:
            configure(spark)
            return fn(spark, sf_dir)

        QUERIES[name] = run
        if sql is not None:
            ORACLE[name] = positive_zero_rounds(sql)
        return run
    return deco


def positive_zero_rounds(sql: str) -> str:
    """Wrap every ``round(...)`` of a SQL twin as ``(round(...) + 0.0)``.
    DuckDB's round keeps the sign of a negative zero while Spark's decimal
    rounding returns +0.0; adding +0.0 gives +0.0 on both sides."""
    out, i = [], 0
    while True:
        j = _find_round(sql, i)
        if j < 0:
            out.append(sql[i:])
            return "".join(out)
        k = _matching_paren(sql, j + 5)
        out.append(sql[i:j])
        out.append("(round(" + positive_zero_rounds(sql[j + 6:k]) + ") + 0.0)")
        i = k + 1


def _find_round(sql: str, start: int) -> int:
    quoted = False
    i = start
    while i < len(sql):
        c = sql[i]
        if c == "'":
            quoted = not quoted
        elif not quoted and sql.startswith("round(", i) and (i == 0 or not (sql[i - 1].isalnum() or sql[i - 1] == "_")):
            return i
        i += 1
    return -1


def _matching_paren(sql: str, open_at: int) -> int:
    depth, quoted = 0, False
    for i in range(open_at, len(sql)):
        c = sql[i]
        if c == "'":
            quoted = not quoted
        elif not quoted:
            if c == "(":
                depth += 1
            elif c == ")":
                depth -= 1
                if depth == 0:
                    return i
    raise ValueError("unbalanced parentheses in SQL twin")


def r6(c: Column | str) -> Column:
    """Round a double output to 6 digits (the SQL twin does the same)."""
    return F.round(F.col(c) if isinstance(c, str) else c, 6)
