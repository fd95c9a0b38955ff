"""Mapping reports (D5-D12, I13): aggregations over a mapped frame.

Everything is one aggregation (or one grouped count) on the executors; the "top n"
reports are ``orderBy(...).limit(n)``, which Spark runs as a per-partition top-n
followed by one small merge (TakeOrderedAndProject), never a global sort.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def mapping_report(mapped: DataFrame, score_col: str = "similarity_score") -> DataFrame:
    """D5 + D6: totals, mapped / unmapped, rate (NULL on zero rows), score stats of
    mapped rows."""
    is_mapped = F.col("concept_id").isNotNull()
    agg = mapped.agg(
        F.count(F.lit(1)).alias("total_records"),
        F.count_if(is_mapped).alias("mapped_records"),
        F.count_if(~is_mapped).alias("unmapped_records"),
        F.avg(F.when(is_mapped, F.col(score_col))).alias("avg_similarity"),
        F.min(F.when(is_mapped, F.col(score_col))).alias("min_similarity"),
        F.max(F.when(is_mapped, F.col(score_col))).alias("max_similarity"),
    )
    rate = F.when(F.col("total_records") > 0, F.col("mapped_records") * 100.0 / F.col("total_records"))
    return agg.select(
        "total_records", "mapped_records", "unmapped_records", F.round(rate, 4).alias("mapping_rate"),
        F.round("avg_similarity", 4).alias("avg_similarity"), F.round("min_similarity", 4).alias("min_similarity"),
        F.round("max_similarity", 4).alias("max_similarity"))


def strategy_breakdown(mapped: DataFrame, col: str = "matching_strategy") -> DataFrame:
    """Rows per strategy / method (NULL strategy left out)."""
    return mapped.where(F.col(col).isNotNull()).groupBy(col).agg(F.count(F.lit(1)).alias("n_records"))


def confidence_band(mapped: DataFrame, value_col: str, low: float = 0.7, high: float = 0.9,
                    score_col: str = "similarity_score") -> DataFrame:
    """Mapped rows with low <= score < high, grouped by (value, concept) with counts."""
    band = mapped.where(F.col("concept_id").isNotNull() & (F.col(score_col) >= low) & (F.col(score_col) < high))
    return band.groupBy(F.col(value_col).alias("source_value"), "matched_concept_name").agg(
        F.round(F.max(score_col), 4).alias("similarity_score"), F.count(F.lit(1)).alias("n_records"))


def confidence_total(mapped: DataFrame, value_col: str, low: float = 0.7, high: float = 0.9,
                     score_col: str = "similarity_score") -> DataFrame:
    """The band as one row: records, distinct (value, concept) pairs, mean score."""
    band = mapped.where(F.col("concept_id").isNotNull() & (F.col(score_col) >= low) & (F.col(score_col) < high))
    pairs = band.groupBy(F.col(value_col).alias("v"), "matched_concept_name").agg(
        F.count(F.lit(1)).alias("n"), F.sum(score_col).alias("s"))
    return pairs.agg(F.coalesce(F.sum("n"), F.lit(0)).alias("n_records"), F.count(F.lit(1)).alias("n_pairs"),
                     F.round(F.sum("s") / F.sum("n"), 4).alias("avg_similarity"))


def mapping_sample(mapped: DataFrame, value_col: str, n: int = 10) -> DataFrame:
    """The first ``n`` distinct (source value, concept) pairs, by value, then concept."""
    return (mapped.select(F.col(value_col).alias("source_value"), "concept_id").distinct()
            .orderBy(F.col("source_value").asc_nulls_first(), F.col("concept_id").asc_nulls_first()).limit(n))


def load_stats(spark, name: str, eligible: int, existing: int, inserted: int, rejected: int, elapsed_s: float) -> DataFrame:
    """One row per load, for a load-history table."""
    row = (name, eligible, existing, inserted, rejected, float(elapsed_s),
           round(100.0 * (existing + inserted) / eligible, 4) if eligible else None)
    return spark.createDataFrame([row], "table_name string, eligible bigint, existing bigint, inserted bigint, "
                                        "rejected bigint, elapsed_s double, completion_pct double")


def confidence_samples(mapped: DataFrame, value_col: str, n: int = 10, **kw) -> DataFrame:
    """the first ``n`` band entries in a stated order (score desc, value)."""
    return confidence_band(mapped, value_col, **kw).orderBy(F.col("similarity_score").desc(),
                                                            "source_value").limit(n)


def top_unmapped(mapped: DataFrame, value_col: str, n: int = 10) -> DataFrame:
    """Most frequent unmapped source values (count desc, value asc)."""
    un = mapped.where(F.col("concept_id").isNull())
    return (un.groupBy(F.col(value_col).alias("source_value")).agg(F.count(F.lit(1)).alias("n_records"))
              .orderBy(F.col("n_records").desc(), F.col("source_value").asc_nulls_first()).limit(n))


def concept_distribution(mapped: DataFrame, id_col: str = "concept_id", n: int = 10) -> DataFrame:
    """Top ``n`` concept ids by row count (count desc, id asc)."""
    return (mapped.groupBy(id_col).agg(F.count(F.lit(1)).alias("n_records"))
                  .orderBy(F.col("n_records").desc(), F.col(id_col).asc_nulls_first()).limit(n))


def mapping_counts(mapped: DataFrame, id_col: str = "concept_id") -> DataFrame:
    """D10 caution: mapped = non-null and not 0; unmapped = null or 0; non_null = not null."""
    c = F.col(id_col)
    return mapped.agg(F.count_if(c.isNotNull() & (c != 0)).alias("mapped"),
                      F.count_if(c.isNull() | (c == 0)).alias("unmapped"),
                      F.count(c).alias("non_null"))


def mapped_by_domain(mapped: DataFrame) -> DataFrame:
    """Mapped rows per matched domain."""
    return (mapped.where(F.col("concept_id").isNotNull())
                  .groupBy("matched_domain").agg(F.count(F.lit(1)).alias("n_records")))
