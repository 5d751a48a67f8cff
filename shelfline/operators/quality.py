"""Data-quality checks. A check passes when it finds nothing."""

from __future__ import annotations

from collections.abc import Iterable, Mapping
from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from shelfline.operators.lookups import orphans


def duplicates(df: DataFrame, column: str, include_null: bool = True) -> DataFrame:
    rows = df if include_null else df.where(F.col(column).isNotNull())
    return rows.groupBy(column).agg(F.count("*").alias("rows")).where("rows > 1")


def missing(df: DataFrame, column: str) -> DataFrame:
    return df.where(F.col(column).isNull())


def below(df: DataFrame, column: str, minimum: int = 0) -> DataFrame:
    return df.where(F.col(column) < minimum)


def inverted(df: DataFrame, start: str = "start_date", end: str = "end_date") -> DataFrame:
    return df.where(F.col(start) > F.col(end))


@dataclass(frozen=True)
class Check:
    """One rule: ``unique``, ``not_null``, ``minimum``, ``ordered`` or ``reference``."""

    table: str
    column: str
    rule: str
    severity: str = "error"
    other: str | None = None  # end column of ``ordered``; ``table.column`` of ``reference``
    include_null: bool = False

    @property
    def name(self) -> str:
        return f"{self.table}.{self.column}.{self.rule}" + ("_or_null" if self.include_null else "")


# The rules attached to the silver models.
MODEL_CHECKS = (
    Check("fct_pos_sales", "pos_sale_sk", "unique"),
    Check("fct_pos_sales", "pos_sale_sk", "not_null"),
    Check("fct_pos_sales", "transaction_date", "not_null"),
    Check("fct_pos_sales", "units_sold", "not_null"),
    Check("fct_pos_sales", "units_sold", "minimum"),
    Check("fct_pos_sales", "store_key", "reference", "warn", "dim_store.store_key"),
    Check("fct_inventory", "inventory_sk", "unique"),
    Check("fct_inventory", "inventory_sk", "not_null"),
    Check("fct_inventory", "on_hand_qty", "not_null"),
    Check("fct_inventory", "on_hand_qty", "minimum"),
    Check("fct_promotions", "promo_id", "unique"),
    Check("fct_promotions", "promo_id", "not_null"),
    Check("fct_promotions", "start_date", "not_null"),
    Check("fct_promotions", "material_number", "not_null"),
    Check("fct_promotions", "material_number", "reference", "warn", "dim_product.material_number"),
)
# The stand-alone assertions: keys and references here also count null.
ASSERTIONS = (
    Check("fct_pos_sales", "pos_sale_sk", "unique", include_null=True),
    Check("fct_pos_sales", "store_key", "reference", other="dim_store.store_key"),
    Check("fct_pos_sales", "units_sold", "minimum"),
    Check("fct_inventory", "on_hand_qty", "minimum"),
    Check("fct_promotions", "start_date", "ordered", other="end_date"),
    Check("fct_promotions", "material_number", "reference", other="dim_product.material_number", include_null=True),
)


def _row_rule(check: Check) -> Column:
    column = F.col(check.column)
    if check.rule == "not_null":
        return column.isNull()
    if check.rule == "minimum":
        return column < 0
    return column > F.col(check.other)


def run_checks(tables: Mapping[str, DataFrame], checks: Iterable[Check] = MODEL_CHECKS) -> DataFrame:
    """One row per check: its severity, how many violations it found, whether it passed.

    All row-level rules of a table are counted in one scan; each key rule is one
    aggregation of that key.
    """
    checks = list(checks)
    parts: list[DataFrame] = []
    by_table: dict[str, list[Check]] = {}
    for check in checks:
        if check.rule in ("not_null", "minimum", "ordered"):
            by_table.setdefault(check.table, []).append(check)
            continue
        df = tables[check.table]
        if check.rule == "unique":
            found = duplicates(df, check.column, check.include_null).agg(F.count("*").alias("violations"))
        else:
            parent, parent_column = check.other.split(".")
            found = orphans(df, tables[parent], check.column, parent_column, check.include_null).agg(
                F.coalesce(F.sum("rows"), F.lit(0)).alias("violations")
            )
        parts.append(found.select(F.lit(check.name).alias("check_name"), F.lit(check.severity).alias("severity"), "violations"))
    for table, rules in by_table.items():
        counted = tables[table].agg(*[F.count_if(_row_rule(c)).alias(f"v{i}") for i, c in enumerate(rules)])
        lines = F.array(*[
            F.struct(F.lit(c.name).alias("check_name"), F.lit(c.severity).alias("severity"), F.col(f"v{i}").alias("violations"))
            for i, c in enumerate(rules)
        ])
        parts.append(counted.select(F.inline(lines)))
    report = reduce(DataFrame.unionByName, parts)
    status = F.when(F.col("violations") == 0, "PASS").when(F.col("severity") == "warn", "WARN").otherwise("ERROR")
    return report.withColumn("passed", F.col("violations") == 0).withColumn("status", status)


class ChecksFailed(Exception):
    """A check of severity ``error`` found something."""


def stop_on_errors(report: DataFrame) -> None:
    """Raises ``ChecksFailed`` if a line of the report, which has one per check, is an error. Warnings pass."""
    failed = report.where("status = 'ERROR'").orderBy("check_name").collect()
    if failed:
        raise ChecksFailed(", ".join(f"{r['check_name']}: {r['violations']}" for r in failed))
