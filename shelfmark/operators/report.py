"""Table statistics, comparison with the model, alerts and the run report."""

from __future__ import annotations

import re
from collections.abc import Collection, Mapping
from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from shelfmark.functions.scalars import pretty_size
from shelfmark.operators import manifest
from shelfmark.operators.publish import resolve
from shelfmark.plans.catalog import TABLES, default_of, ensure_tables

# Fixed value: a metric above this raises an alert.
THRESHOLD = 90.0


def table_stats(
    tables: Mapping[str, DataFrame],
    paths: Mapping[str, str] | None = None,
    ours: Collection[str] = tuple(TABLES),
    schema: str = "default",
) -> DataFrame:
    """Schema, table, row count, size and whether the model knows it; largest first."""
    parts = []
    for name, rows in tables.items():
        part = rows.agg(F.count("*").alias("row_count"))
        if paths and name in paths:
            part = part.withColumn("size", pretty_size(F.lit(_stored_bytes(rows.sparkSession, paths[name]))))
        else:
            part = part.withColumn("size", F.lit(None).cast("string"))
        parts.append(
            part.select(
                F.lit(schema).alias("schema_name"),
                F.lit(name).alias("table_name"),
                "row_count",
                "size",
                F.lit(name in ours).alias("in_model"),
            )
        )
    return reduce(DataFrame.unionByName, parts).orderBy(F.desc("row_count"), "table_name")


def _stored_bytes(spark: SparkSession, path: str) -> int:
    where = spark._jvm.org.apache.hadoop.fs.Path(path)
    return where.getFileSystem(spark._jsc.hadoopConfiguration()).getContentSummary(where).getLength()


def catalog_stats(spark: SparkSession, database: str) -> DataFrame:
    """:func:`table_stats` over every table of a database."""
    names = [t.name for t in spark.catalog.listTables(database)]
    return table_stats({n: spark.table(f"`{database}`.`{n}`") for n in names}, schema=database)


def fill_tables(spark: SparkSession, root: str, database: str, names: Collection[str] | None = None) -> list[str]:
    """Put the current rows of the loaded tables into the catalog's tables, with statistics; their names.

    The tables are created as the model says, with defaults and comments. Columns that were not loaded
    take their default, or NULL. Row counts and sizes, and minimum, maximum and distinct values of plain
    columns, are computed once here, so that `described` and `analysed` read no data.
    """
    filled = []
    for name in names or TABLES:
        rows = resolve(spark, root, name)
        if rows is None:
            continue
        ensure_tables(spark, database, [name])
        spec, table = TABLES[name], f"`{database}`.`{name}`"
        columns = [F.col(f.name) if f.name in rows.columns else F.expr(default_of(f) or "NULL").cast(f.type).alias(f.name) for f in spec.fields]
        rows.select(*columns).write.insertInto(table, overwrite=True)
        plain = ", ".join(f"`{f.name}`" for f in spec.fields if "<" not in f.type and f.type != "variant")
        spark.sql(f"ANALYZE TABLE {table} COMPUTE STATISTICS FOR COLUMNS {plain}")
        filled.append(name)
    return filled


def analysed(spark: SparkSession, database: str) -> DataFrame:
    """(table_name, row_count, bytes) as the catalog's statistics say; NULL for a table never analysed."""
    found = []
    for table in spark.catalog.listTables(database):  # metadata
        rows = spark.sql(f"DESCRIBE EXTENDED `{database}`.`{table.name}`").where("col_name = 'Statistics'").collect()
        said = re.findall(r"(\d+) (bytes|rows)", rows[0].data_type) if rows else []
        found.append((table.name, *({unit: int(n) for n, unit in said}.get(u) for u in ("rows", "bytes"))))
    return spark.createDataFrame(found, "table_name string, row_count bigint, bytes bigint")


def described(spark: SparkSession, database: str) -> DataFrame:
    """(table_name, place, column_name, data_type, comment) of all columns of a database's tables."""
    found = []
    for table in spark.catalog.listTables(database):  # metadata
        columns = spark.catalog.listColumns(f"`{database}`.`{table.name}`")
        found += [(table.name, n, c.name, c.dataType, table.description) for n, c in enumerate(columns)]
    return spark.createDataFrame(found, "table_name string, place int, column_name string, data_type string, comment string")


def compare_with_model(spark: SparkSession, database: str) -> DataFrame:
    """(table_name, column_name, problem): where a database's tables and the model differ.

    ``missing`` and ``unknown`` columns as in `column_diff`, and ``type <found> instead of <wanted>``.
    Tables of the model that are not in the database count with all their columns.
    """
    found = described(spark, database).select("table_name", "column_name", "data_type")
    rows = [(t.name, f.name, f.type) for t in TABLES.values() for f in t.fields]
    wanted = spark.createDataFrame(rows, "table_name string, column_name string, wanted string")
    other = found.join(wanted, ["table_name", "column_name"]).where(F.col("data_type") != F.col("wanted"))
    types = other.select("table_name", "column_name", F.concat(F.lit("type "), "data_type", F.lit(" instead of "), "wanted").alias("problem"))
    return column_diff(wanted.drop("wanted"), found.drop("data_type")).unionByName(types)


def list_tables(spark: SparkSession, database: str) -> DataFrame:
    return spark.sql(f"SHOW TABLES IN `{database}`").select("namespace", "tableName").orderBy("tableName")


def schema_diff(spark: SparkSession, present: Mapping[str, Collection[str]], wanted=None) -> DataFrame:
    """Columns the model has but the given tables lack, and the other way round."""
    wanted = wanted or {t.name: t.columns for t in TABLES.values()}
    schema = "table_name string, column_name string"
    pairs = lambda m: [(t, c) for t, cols in m.items() for c in cols]
    return column_diff(
        spark.createDataFrame(pairs(wanted), schema), spark.createDataFrame(pairs(present), schema)
    )


def column_diff(wanted: DataFrame, found: DataFrame) -> DataFrame:
    """(table_name, column_name, problem): ``missing`` from ``found``, or ``unknown`` there."""
    keys = ["table_name", "column_name"]
    return (
        wanted.join(found, keys, "left_anti")
        .withColumn("problem", F.lit("missing"))
        .unionByName(found.join(wanted, keys, "left_anti").withColumn("problem", F.lit("unknown")))
    )


def alerts(metrics: DataFrame, thresholds: Mapping[str, float], default: float = THRESHOLD) -> DataFrame:
    """Metric rows (``metric``, ``value``) above the threshold of their metric."""
    limit = F.lit(default)
    for name, bound in thresholds.items():
        limit = F.when(F.col("metric") == name, F.lit(float(bound))).otherwise(limit)
    return metrics.withColumn("threshold", limit).where(F.col("value") > F.col("threshold"))


def run_metrics(log: DataFrame) -> DataFrame:
    """Share of bad lines per file (percent), as metric rows for :func:`alerts`."""
    done = manifest.state(log).where(F.col("event").isin("done", "failed"))
    bad = F.coalesce("n_malformed", F.lit(0)) + F.coalesce("n_rejected", F.lit(0))
    total = F.coalesce("n_rows", F.lit(0)) + bad
    share = F.when(total > 0, 100.0 * bad / total).otherwise(0.0)
    return done.select("entity", "file", F.lit("bad_share").alias("metric"), share.alias("value"))


def run_report(
    log: DataFrame, tables: Mapping[str, DataFrame], thresholds: Mapping[str, float] | None = None
) -> dict[str, DataFrame]:
    """The sections of the monitoring report."""
    errors = log.where(F.col("event").isin("error", "failed"))
    return {
        "tables": table_stats(tables),
        "state": manifest.summary(log),
        "errors": manifest.tail_errors(errors),
        "alerts": alerts(run_metrics(log), thresholds or {}),
    }


def report_rows(sections: Mapping[str, DataFrame]) -> DataFrame:
    """The sections of :func:`run_report` as one table of (section, name, metric, value).

    ``name`` is the table, entity or file that a row tells of, ``value`` is text, NULL where nothing is known.
    """
    told = {
        "tables": ("table_name", ("row_count", "size")),
        "state": ("entity", ("status", "last_file", "n_files", "n_rows")),
        "errors": ("file", ("entity", "message")),
        "alerts": ("file", ("metric", "value", "threshold")),
    }
    parts = []
    for section, (name, metrics) in told.items():
        pairs = F.array(*[F.struct(F.lit(m).alias("metric"), F.col(m).cast("string").alias("value")) for m in metrics])
        parts.append(sections[section].select(F.lit(section).alias("section"), F.col(name).alias("name"), F.inline(pairs)))
    return reduce(DataFrame.unionByName, parts)
