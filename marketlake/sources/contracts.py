"""Checks of records against their contract."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import DatetimeType, DecimalType, FractionalType, IntegralType, NumericType, StringType, VariantType

from ..schemas import Contract

VIOLATIONS = "violations"


def _has_type(df: DataFrame, name: str, kind: str) -> Column:
    """Whether a value has its JSON type: the column's type decides first, and a text is never
    a number, whatever it holds."""
    stored = df.schema[name].dataType
    if isinstance(stored, VariantType):
        found = F.schema_of_variant(name)
        if kind == "string":
            return found == "STRING"
        number = F.try_variant_get(name, "$", "double")
        return found.rlike("^(BIGINT|DECIMAL|DOUBLE|FLOAT)") & ((number == F.floor(number)) if kind == "integer" else F.lit(True))
    if kind == "string":
        return F.lit(isinstance(stored, (StringType, DatetimeType)))
    if not isinstance(stored, NumericType):
        return F.lit(False)
    value = F.col(name)
    if isinstance(stored, IntegralType):
        return F.lit(True)
    if isinstance(stored, FractionalType) and not isinstance(stored, DecimalType):
        finite = ~F.isnan(value) & (F.abs(value) < float("inf"))
    else:
        finite = F.lit(True)
    return finite if kind == "number" else finite & (value == F.floor(value))


def violations(df: DataFrame, contract: Contract) -> Column:
    """Array of ``field:reason`` texts, empty for rows that keep the contract."""
    checks = []
    for name, kind in contract.properties.items():
        required = name not in contract.optional
        if name not in df.columns:
            if required:
                checks.append(F.lit(f"{name}:missing"))
            continue
        if required:
            checks.append(F.when(F.col(name).isNull(), F.lit(f"{name}:missing")))
        wrong = F.col(name).isNotNull() & ~_has_type(df, name, kind)
        checks.append(F.when(wrong, F.lit(f"{name}:not {kind}")))
    return F.array_compact(F.array(*checks))


def schema_contract_check(df: DataFrame, contract: Contract) -> tuple[DataFrame, DataFrame]:
    """(rows that keep the contract, rejected rows with their violations)."""
    checked = df.withColumn(VIOLATIONS, violations(df, contract))
    valid = checked.where(F.size(VIOLATIONS) == 0).drop(VIOLATIONS)
    return valid, checked.where(F.size(VIOLATIONS) > 0)
