"""Data-quality checks: each gives the violating rows; the suite counts them."""

from __future__ import annotations

from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from firmweave.operators.skew import spread_join
from firmweave.schemas import DATA_SOURCES, MATCH_METHODS
from firmweave.sources.tables import has_table


def not_unique(df: DataFrame, *columns: str) -> DataFrame:
    """Values that occur more than once, with their count; NULLs do not count."""
    present = reduce(lambda a, b: a & b, [F.col(c).isNotNull() for c in columns])
    return df.filter(present).groupBy(*columns).agg(F.count(F.lit(1)).alias("n_records")).filter(F.col("n_records") > 1)


def nulls(df: DataFrame, column: str) -> DataFrame:
    return df.filter(F.col(column).isNull())


def not_accepted(df: DataFrame, column: str, values: list[str]) -> DataFrame:
    """Rows with a value outside the list; NULL passes."""
    return df.filter(~F.col(column).isin(values))


def out_of_range(df: DataFrame, column: str, low: float, high: float) -> DataFrame:
    return df.filter(~F.col(column).between(low, high))


def orphans(child: DataFrame, column: str, parent: DataFrame, parent_column: str) -> DataFrame:
    """Child rows whose non-NULL key is missing in the parent."""
    keys = parent.select(F.col(parent_column).alias(column)).filter(F.col(column).isNotNull()).distinct()
    present = child.filter(F.col(column).isNotNull())
    return spread_join(present, keys, column, [F.xxhash64(*child.columns)], "left_anti")


@dataclass(frozen=True)
class Check:
    kind: str
    table: str
    column: str
    values: tuple[str, ...] = ()
    parent: str = ""
    parent_column: str = ""

    def row_test(self) -> Column | None:
        """True for a violating row, when one row is enough to tell."""
        column = F.col(self.column)
        if self.kind == "not_null":
            return column.isNull()
        if self.kind == "accepted_values":
            return ~column.isin(list(self.values))
        if self.kind == "range_0_1":
            return ~column.between(0, 1)
        return None

    def violations(self, tables: dict[str, DataFrame]) -> DataFrame:
        df = tables[self.table]
        test = self.row_test()
        if test is not None:
            return df.filter(test)
        if self.kind == "unique":
            return not_unique(df, *self.column.split(","))
        return orphans(df, self.column, tables[self.parent], self.parent_column)


STAGING_CHECKS = [
    Check("unique", "registry", "abn"),
    Check("not_null", "registry", "abn"),
    Check("unique", "crawl", "id"),
    Check("not_null", "crawl", "id"),
    Check("unique", "crawl", "website_url"),
    Check("not_null", "crawl", "website_url"),
    Check("unique", "matches", "match_id"),
    Check("not_null", "matches", "match_id"),
    Check("not_null", "matches", "cc_id"),
    Check("relationships", "matches", "cc_id", parent="crawl", parent_column="id"),
    Check("not_null", "matches", "abn"),
    Check("relationships", "matches", "abn", parent="registry", parent_column="abn"),
    Check("not_null", "matches", "match_method"),
    Check("accepted_values", "matches", "match_method", values=tuple(MATCH_METHODS)),
    Check("not_null", "matches", "match_confidence"),
    Check("range_0_1", "matches", "match_confidence"),
    Check("unique", "matches", "cc_id,abn"),
]

MART_CHECKS = [
    Check("unique", "companies", "company_id"),
    Check("not_null", "companies", "company_id"),
    Check("not_null", "companies", "company_name"),
    Check("not_null", "companies", "data_source"),
    Check("accepted_values", "companies", "data_source", values=tuple(DATA_SOURCES)),
]


def run_suite(tables: dict[str, DataFrame], checks: list[Check]) -> DataFrame:
    """One row per check: check_name, table_name, column_name, failures.

    All row-wise checks of a table are counted in one pass over it.
    """
    results: list[DataFrame] = []
    for table in dict.fromkeys(check.table for check in checks):
        row_wise = [c for c in checks if c.table == table and c.row_test() is not None]
        if row_wise:
            counted = tables[table].agg(
                *[F.count_if(c.row_test()).alias(f"c{i}") for i, c in enumerate(row_wise)]
            )
            lines = [
                F.struct(
                    F.lit(c.kind).alias("check_name"),
                    F.lit(c.table).alias("table_name"),
                    F.lit(c.column).alias("column_name"),
                    F.col(f"c{i}").alias("failures"),
                )
                for i, c in enumerate(row_wise)
            ]
            results.append(counted.select(F.explode(F.array(*lines)).alias("line")).select("line.*"))
        for check in checks:
            if check.table == table and check.row_test() is None:
                results.append(
                    check.violations(tables)
                    .agg(F.count(F.lit(1)).alias("failures"))
                    .select(
                        F.lit(check.kind).alias("check_name"),
                        F.lit(check.table).alias("table_name"),
                        F.lit(check.column).alias("column_name"),
                        "failures",
                    )
                )
    return reduce(DataFrame.unionByName, results)


def split_valid_matches(new: DataFrame, crawl: DataFrame, registry: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(valid, quarantined) new matches by the constraints of the match table.

    A match is valid when its method is present, its confidence is within 0..1 or
    NULL, and its keys exist in the parents (NULL passes). Of several copies of a
    pair (cc_id, abn) the most confident stays. Quarantined rows carry a ``reason``.
    """
    columns = new.columns
    ids = crawl.select(F.col("id").alias("cc_id"), F.lit(True).alias("_site"))
    numbers = registry.select("abn", F.lit(True).alias("_entity"))
    checked = spread_join(new.join(ids, "cc_id", "left"), numbers, "abn", [F.col("cc_id")], "left")
    reason = (
        F.when(F.col("match_method").isNull(), F.lit("match_method is null"))
        .when(~F.col("match_confidence").between(0, 1), F.lit("match_confidence out of range"))
        .when(F.col("cc_id").isNotNull() & F.col("_site").isNull(), F.lit("cc_id not in crawl"))
        .when(F.col("abn").isNotNull() & F.col("_entity").isNull(), F.lit("abn not in registry"))
    )
    marked = checked.withColumn("reason", reason).select(*columns, "reason")
    good = marked.filter(F.col("reason").isNull()).drop("reason")
    return one_per_pair(good), marked.filter(F.col("reason").isNotNull())


def one_per_pair(matches: DataFrame) -> DataFrame:
    """The most confident match of each (cc_id, abn); rows with a NULL key stay as they are.

    An aggregate, so copies of one pair shrink before the shuffle.
    """
    keyed = F.col("cc_id").isNotNull() & F.col("abn").isNotNull()
    rest = [name for name in matches.columns if name not in ("cc_id", "abn")]
    rank = F.struct(F.col("match_confidence"), F.col("match_method"), F.col("match_reasoning"))
    best = (
        matches.filter(keyed)
        .groupBy("cc_id", "abn")
        .agg(F.max_by(F.struct(*rest), rank).alias("_best"))
        .select("cc_id", "abn", *[F.col(f"_best.{name}").alias(name) for name in rest])
    )
    return best.select(*matches.columns).unionByName(matches.filter(~keyed))


def missing_tables(spark: SparkSession, root: str, names: list[str]) -> list[str]:
    """Tables of which no version under ``root`` was written to the end."""
    return [name for name in names if not has_table(spark, root, name)]
