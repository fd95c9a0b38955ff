"""Mapping config: which source column feeds which CDM field, and named functions.

Config shape (JSON): ``tables.<name>.{source_columns, required_columns,
optional_columns, column_mappings}``.  ``column_mappings.<col>`` may spell the field
key ``omop field`` or ``omop_field`` and may carry ``mapping_function``; both
spellings are accepted.
"""

from __future__ import annotations

import json
from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .functions import rules

FUNCTIONS: dict[str, Callable[[Column], Column]] = dict(rules.REGISTRY)


#: Config type names -> Spark types.
SPARK_TYPES = {"int": "bigint", "float": "double", "date": "date", "datetime": "timestamp_ntz", "string": "string"}


def register_function(name: str, fn: Callable[[Column], Column]) -> None:
    """M1: add a Column -> Column mapping function that configs may name."""
    FUNCTIONS[name] = fn


def load_config(path_or_text: str) -> dict:
    text = path_or_text
    if not path_or_text.lstrip().startswith("{"):
        with open(path_or_text, encoding="utf-8") as fh:
            text = fh.read()
    return json.loads(text)


def table_config(config: dict, table: str) -> dict:
    return config.get("tables", {}).get(table, {})


def omop_field(mapping: dict) -> str | None:
    return mapping.get("omop field", mapping.get("omop_field"))


def bind_source(src: DataFrame, config: dict, table: str) -> DataFrame:
    """Rename configured source columns to their CDM field names.

    Absent optional columns become NULLs of the type their mapping states (text where it
    states none), so every job sees the same shape.
    """
    tc = table_config(config, table)
    present = {c.lower() for c in src.columns}
    cols = []
    for field, column in tc.get("source_columns", {}).items():
        if column.lower() in present:
            cols.append(F.col(column).alias(field))
        else:
            kind = tc.get("column_mappings", {}).get(column, {}).get("data type", "string")
            cols.append(F.lit(None).cast(SPARK_TYPES.get(kind, "string")).alias(field))
    return src.select(*cols)


def apply_config(src: DataFrame, config: dict, table: str) -> DataFrame:
    """M1: bind the source and add ``<field>`` columns produced by named functions.

    For a column mapping with ``mapping_function``, the function is applied to the
    bound source field and the result is written under the mapping's CDM field.
    """
    tc = table_config(config, table)
    bound = bind_source(src, config, table)
    by_column = {v: k for k, v in tc.get("source_columns", {}).items()}
    extra = []
    for column, mapping in tc.get("column_mappings", {}).items():
        fn_name = mapping.get("mapping_function")
        target = omop_field(mapping)
        if not fn_name or not target or column not in by_column:
            continue
        if fn_name not in FUNCTIONS:
            raise KeyError(f"unknown mapping function {fn_name!r}")
        extra.append(FUNCTIONS[fn_name](F.col(by_column[column])).alias(target))
    return bound.select("*", *extra)


def required_columns(config: dict, table: str) -> list[str]:
    return list(table_config(config, table).get("required_columns", []))


def optional_columns(config: dict, table: str) -> list[str]:
    return list(table_config(config, table).get("optional_columns", []))


#: Example: a registry extract bound to the person table. The key spellings ("omop field" with a
#: space) are the ones configs use; the column names are the extract's own.
PERSON_CONFIG = {
    "tables": {
        "person": {
            "source_columns": {"person_id": "reg_no", "gender": "sex_txt", "race": "race_txt",
                               "ethnicity": "ethn_txt", "birth_datetime": "born_at"},
            "required_columns": ["reg_no", "born_at"],
            "optional_columns": ["sex_txt", "race_txt", "ethn_txt"],
            "column_mappings": {
                "reg_no": {"omop field": "person_id", "data type": "int"},
                "born_at": {"omop field": "birth_datetime", "data type": "datetime"},
                "sex_txt": {"omop_field": "gender_concept_id", "data type": "string",
                            "mapping_function": "map_gender"},
                "race_txt": {"omop_field": "race_concept_id", "data type": "string",
                             "mapping_function": "map_race"},
                "ethn_txt": {"omop_field": "ethnicity_concept_id", "data type": "string",
                             "mapping_function": "map_ethnicity"},
            },
        }
    }
}
