"""Data-quality and load-report jobs.

Each check is one aggregation or one anti-join; none collects rows to the driver.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions.dates import vocab_date


def load_report(eligible: DataFrame, existing: DataFrame | None, key: str) -> DataFrame:
    """D1 + D2 + D13: eligible rows, rows already loaded, rows still to insert, and the
    share already done.  ``existing`` is the target's current key set."""
    ex = existing.select(key) if existing is not None else eligible.select(key).limit(0)
    tagged = eligible.select(key).join(ex.withColumn("_loaded", F.lit(1)), key, "left")
    return tagged.agg(
        F.count(F.lit(1)).alias("eligible_rows"),
        F.count("_loaded").alias("already_loaded"),
        F.count_if(F.col("_loaded").isNull()).alias("to_insert"),
    ).select("*", F.when(F.col("eligible_rows") > 0,
                         F.round(F.col("already_loaded") * 100.0 / F.col("eligible_rows"), 4))
             .alias("completion_pct"))


def date_order(df: DataFrame, key: str, start: str, end: str) -> DataFrame:
    """K1: rows whose end precedes their start."""
    return df.where(F.col(end) < F.col(start)).select(key, start, end)


def orphans(tables: dict[str, DataFrame], persons: DataFrame, person: str = "person_id") -> DataFrame:
    """K2: per table, rows and rows whose person is not a loaded person (null counts as orphan).

    Rows of all tables are counted per person in one pass (map-side first, so a hot person is one
    row a task), and those counts meet the persons once."""
    rows = reduce(DataFrame.unionAll, [df.select(F.col(person), F.lit(i).alias("_t")) for i, df in enumerate(tables.values())])
    per = rows.groupBy(person).agg(*[F.count_if(F.col("_t") == i).alias(f"_n{i}") for i in range(len(tables))])
    known = persons.select(person).withColumn("_known", F.lit(1))
    sums = per.join(known, person, "left").agg(*[
        F.coalesce(F.sum(c), F.lit(0)).alias(name) for i in range(len(tables)) for name, c in (
            (f"_n{i}", F.col(f"_n{i}")), (f"_o{i}", F.when(F.col("_known").isNull(), F.col(f"_n{i}"))))])
    return sums.select(F.inline(F.array(*[
        F.struct(F.lit(name).alias("table_name"), F.col(f"_n{i}").alias("n_rows"), F.col(f"_o{i}").alias("n_orphans"))
        for i, name in enumerate(tables)])))


def null_counts(df: DataFrame, columns: list[str]) -> DataFrame:
    """K3: one aggregation pass, then unpivot to (column_name, n_rows, n_null)."""
    agg = df.agg(F.count(F.lit(1)).alias("n_rows"),
                 *[F.count_if(F.col(c).isNull()).alias(c) for c in columns])
    return agg.unpivot("n_rows", columns, "column_name", "n_null").select("column_name", "n_rows", "n_null")


def duplicates(df: DataFrame, keys: list[str]) -> DataFrame:
    """K4: keys that occur more than once, with their count."""
    return df.groupBy(*keys).agg(F.count(F.lit(1)).alias("n")).where(F.col("n") > 1)


def date_range(df: DataFrame, key: str, text_col: str, floor: str) -> DataFrame:
    """K5: date text that does not parse, or parses to a date on/before the floor."""
    d = vocab_date(text_col)
    reason = (F.when(F.col(text_col).isNull(), F.lit("missing"))
               .when(d.isNull(), F.lit("unparseable"))
               .when(d <= F.lit(floor).cast("date"), F.lit("before_floor")))
    return df.select(key, text_col, reason.alias("reason")).where(F.col("reason").isNotNull())


def profile_source(df: DataFrame, contract: dict[str, str]) -> DataFrame:
    """B10 / K7 re-aimed: per configured column, is it present, how many non-null values,
    how many cast to the contract type.  One aggregation over the source."""
    present = {c.lower(): c for c in df.columns}
    aggs, rows = [F.count(F.lit(1)).alias("_n")], []
    for i, (column, type_name) in enumerate(contract.items()):
        real = present.get(column.lower())
        if real is None:
            rows.append((column, False, None, None))
            continue
        c = F.col(real)
        aggs.append(F.count(c).alias(f"_nn{i}"))
        aggs.append(F.count(F.expr(f"try_cast(`{real}` AS {type_name})")).alias(f"_ok{i}"))
        rows.append((column, True, f"_nn{i}", f"_ok{i}"))
    null = F.lit(None).cast("long")
    lines = [F.struct(F.lit(column).alias("column_name"), F.lit(is_present).alias("present"), F.col("_n").alias("n_rows"),
                      (F.col(nn) if nn else null).alias("n_non_null"), (F.col(ok) if ok else null).alias("n_castable"))
             for column, is_present, nn, ok in rows]
    return df.agg(*aggs).select(F.inline(F.array(*lines)))


def validate_vocabulary(raw: DataFrame, schema: T.StructType, keys: list[str]) -> DataFrame:
    """A3 re-aimed: rows, failed casts per typed column, null keys, repeated keys.  One pass:
    counts per key (pre-aggregated map-side), then their sums."""
    aggs = [F.count(F.lit(1)).alias("n_rows")]
    for f in schema.fields:
        if isinstance(f.dataType, T.StringType):
            continue
        c = F.col(f.name)
        typed = vocab_date(c) if isinstance(f.dataType, T.DateType) else c.try_cast(f.dataType)
        aggs.append(F.count_if(c.isNotNull() & typed.isNull()).alias(f"bad_{f.name}"))
    aggs.append(F.count_if(reduce(lambda a, b: a | b, [F.col(k).isNull() for k in keys])).alias("null_keys"))
    per_key = raw.groupBy(*keys).agg(*aggs)
    sums = [F.coalesce(F.sum(c), F.lit(0)).alias(c) for c in per_key.columns if c not in keys]
    return per_key.agg(*sums, F.coalesce(F.sum(F.col("n_rows") - 1), F.lit(0)).alias("repeated_keys"))
