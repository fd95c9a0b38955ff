"""Reading a relational source over JDBC in parts (A4).

The bounds of the key are asked for in one query, and the table is read in as many parts as its
rows need, each a range of the key, so that the server scans ranges and every task has its own
connection.  Columns and filters are pushed down by Spark.  A key with gaps gives uneven parts;
``quantiles`` takes the cuts from the server's own percentiles instead.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession

ROWS_PER_PART = 500_000


@dataclass(frozen=True)
class Source:
    url: str
    table: str
    key: str
    fetch: int = 20_000
    properties: tuple[tuple[str, str], ...] = ()


def bounds_query(src: Source, where: str | None = None) -> str:
    cond = f" WHERE {where}" if where else ""
    return f"SELECT MIN({src.key}) AS least, MAX({src.key}) AS greatest, COUNT(*) AS n FROM {src.table}{cond}"


def quantile_query(src: Source, parts: int, where: str | None = None) -> str:
    """Cuts at equal shares of the rows; one row, a column per cut."""
    cond = f" WHERE {where}" if where else ""
    cuts = ", ".join(f"PERCENTILE_DISC({i / parts:.6f}) WITHIN GROUP (ORDER BY {src.key}) AS c{i}" for i in range(1, parts))
    return f"SELECT {cuts} FROM {src.table}{cond}"


def part_count(n: int, rows_per_part: int = ROWS_PER_PART, most: int = 10_000) -> int:
    return max(1, min(most, -(-n // rows_per_part)))


def even_cuts(least: int, greatest: int, parts: int) -> list[int]:
    """Inner cuts of [least, greatest] into ranges of equal width, without empty ones."""
    width = greatest - least + 1
    return sorted({least + width * i // parts for i in range(1, parts)} - {least})


def part_predicates(key: str, cuts: list[int]) -> list[str]:
    """Conditions of the parts: every row, null keys too, is in exactly one."""
    if not cuts:
        return ["1 = 1"]
    inner = [f"{key} >= {a} AND {key} < {b}" for a, b in zip(cuts, cuts[1:], strict=False)]
    return [f"{key} < {cuts[0]} OR {key} IS NULL", *inner, f"{key} >= {cuts[-1]}"]


def jdbc_options(src: Source) -> dict[str, str]:
    return {"fetchsize": str(src.fetch), "pushDownPredicate": "true", "pushDownAggregate": "true", "pushDownLimit": "true",
            **dict(src.properties)}


def read_source(spark: SparkSession, src: Source, where: str | None = None, rows_per_part: int = ROWS_PER_PART) -> DataFrame:
    """The rows of ``src`` (that fit ``where``), in parts by ranges of its key."""
    table = f"(SELECT * FROM {src.table} WHERE {where}) source" if where else src.table
    options = jdbc_options(src)
    bounds = (spark.read.format("jdbc").options(url=src.url, query=bounds_query(src, where), **options).load().first())
    if not bounds["n"] or bounds["least"] is None:
        predicates = ["1 = 1"]
    else:
        predicates = part_predicates(src.key, even_cuts(int(bounds["least"]), int(bounds["greatest"]), part_count(int(bounds["n"]), rows_per_part)))
    return spark.read.jdbc(src.url, table, predicates=predicates, properties=options)
