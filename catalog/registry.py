"""The register and the SQL building blocks shared by the counterparts."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLES: dict[str, str] = {}
# name -> (needed blocks, body)
BLOCKS: dict[str, tuple[tuple[str, ...], str]] = {}


def query(name: str, sql: str | None = None):
    """Registers a query; ``sql`` may start with ``@a,b|`` to name the blocks it reads."""

    def register(function):
        if name in QUERIES:
            raise ValueError(f"{name} is registered twice")
        QUERIES[name] = function
        if sql is not None:
            ORACLES[name] = sql
        return function

    return register


def block(name: str, needs: str, body: str) -> None:
    BLOCKS[name] = (tuple(n for n in needs.split(",") if n), body)


def assemble(sql: str) -> str:
    if not sql.startswith("@"):
        return sql
    wanted, body = sql[1:].split("|", 1)
    ordered: list[str] = []

    def visit(name: str) -> None:
        if name in ordered:
            return
        for need in BLOCKS[name][0]:
            visit(need)
        ordered.append(name)

    for name in wanted.split(","):
        visit(name.strip())
    blocks = ",\n".join(f"{n} AS MATERIALIZED ({BLOCKS[n][1]})" for n in ordered)
    body = body.strip()
    if body[:15].upper() == "WITH RECURSIVE ":
        return f"WITH RECURSIVE {blocks},\n{body[15:]}"
    if body[:5].upper() == "WITH ":
        return f"WITH {blocks},\n{body[5:]}"
    return f"WITH {blocks}\n{body}"


def r(expression: str, digits: int) -> str:
    """Half-up rounding on a decimal, as Spark rounds a double."""
    return f"CAST(round(CAST(({expression}) AS DECIMAL(30,{digits + 6})), {digits}) AS DOUBLE)"


def big(expression: str) -> str:
    return f"CAST({expression} AS BIGINT)"
