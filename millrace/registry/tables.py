"""Outliers, counts, constraint checks, file round trips and measurement rollups."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from millrace.functions import round_half_up
from millrace.operators import constraints, counts
from millrace.operators.outliers import outlier_stats, outliers
from millrace.plans import measurements
from millrace.registry.common import Inputs, query, sql_round
from millrace.session import DENSE_TASK_BYTES
from millrace.sinks.files import write_csv
from millrace.sinks.measurements import append_measurements
from millrace.sinks.versions import LoadRejected, read_collection, replace_collection
from millrace.sources.files import read_csv
from millrace.sources.generators import HEX_DIGITS, uniform_value
from millrace.sources.measurements import read_log, sorted_records

SIGMAS = 2.0
LOW_SIGMAS = 0.2
PRICE_SIGMAS = 1.5


def event_outlier_stats(data: Inputs) -> DataFrame:
    stats = outlier_stats(data["events"], "value", SIGMAS)
    rounded = [round_half_up(name, 6).alias(name) for name in ("mean", "deviation", "threshold")]
    return stats.select("row_count", *rounded)


OUTLIER_STATS_SQL = f"""
SELECT count(value) AS row_count, {sql_round("avg(value)", 6)} AS mean,
       {sql_round("stddev_pop(value)", 6)} AS deviation,
       {sql_round(f"{SIGMAS} * stddev_pop(value)", 6)} AS threshold
FROM events
"""


def event_outliers(data: Inputs, k: float) -> DataFrame:
    return outliers(data["events"].select("event_id", "value"), "value", k)


def outliers_sql(table: str, columns: str, value: str, k: float) -> str:
    return f"""
SELECT {columns} FROM {table}
WHERE abs({value} - (SELECT avg({value}) FROM {table}))
      > {k} * (SELECT stddev_pop({value}) FROM {table})
"""


def price_outliers(data: Inputs) -> DataFrame:
    rows = data["lineitem"].select("l_orderkey", "l_linenumber", "l_extendedprice")
    return outliers(rows, "l_extendedprice", PRICE_SIGMAS)


COUNTED = ["customer", "orders", "lineitem", "nation", "region"]
PROFILED = ["nation", "part", "orders", "documents"]


def _pick(data: Inputs, names: list[str]) -> dict[str, DataFrame]:
    return {name: data[name] for name in names}


ROW_COUNTS_SQL = " UNION ALL ".join(
    f"SELECT '{name}' AS table_name, count(*) AS row_count FROM {name}" for name in COUNTED
)
TABLE_PROFILE_SQL = """
SELECT 'nation' AS table_name, count(*) AS row_count, 3 AS column_count,
       'n_nationkey, n_name, n_regionkey' AS column_names FROM nation
UNION ALL
SELECT 'part', count(*), 6, 'p_partkey, p_name, p_brand, p_type, p_size, p_retailprice' FROM part
UNION ALL
SELECT 'orders', count(*), 6,
       'o_orderkey, o_custkey, o_orderstatus, o_totalprice, o_orderdate, o_orderpriority'
FROM orders
UNION ALL
SELECT 'documents', count(*), 5, 'doc_id, text, lang, source, n_chars' FROM documents
"""


def latest_events(data: Inputs) -> DataFrame:
    return counts.latest_rows(data["events"].select("event_id", "event_type", "value"), "event_id")


LATEST_EVENTS_SQL = """
SELECT event_id, event_type, value FROM events ORDER BY event_id DESC LIMIT 10
"""


def check_not_null(data: Inputs) -> DataFrame:
    """Zero discounts and taxes stand for missing values."""
    rows = data["lineitem"].select(
        "l_orderkey",
        F.nullif("l_discount", F.lit(0.0)).alias("l_discount"),
        F.nullif("l_tax", F.lit(0.0)).alias("l_tax"),
    )
    return constraints.null_violations(rows, ["l_orderkey", "l_discount", "l_tax"])


CHECK_NOT_NULL_SQL = """
WITH gaps AS (
    SELECT l_orderkey, nullif(l_discount, 0) AS l_discount, nullif(l_tax, 0) AS l_tax
    FROM lineitem
)
SELECT *, 'l_discount' AS violated FROM gaps WHERE l_discount IS NULL
UNION ALL SELECT *, 'l_tax' FROM gaps WHERE l_tax IS NULL
"""


def check_unique(data: Inputs) -> DataFrame:
    return constraints.duplicate_keys(data["lineitem"], ["l_orderkey", "l_linenumber"])


CHECK_UNIQUE_SQL = """
SELECT l_orderkey, l_linenumber, count(*) AS row_count FROM lineitem
GROUP BY ALL HAVING count(*) > 1
"""


def check_fk(data: Inputs) -> DataFrame:
    """Orders that no line refers to."""
    return constraints.orphan_keys(
        data["orders"], data["lineitem"], {"o_orderkey": "l_orderkey"}
    )


CHECK_FK_SQL = """
SELECT o_orderkey, count(*) AS row_count FROM orders
WHERE o_orderkey NOT IN (SELECT l_orderkey FROM lineitem WHERE l_orderkey IS NOT NULL)
GROUP BY o_orderkey
"""


def check_fk_documents(data: Inputs) -> DataFrame:
    """Documents without a label."""
    return constraints.orphan_keys(data["documents"], data["labels"], {"doc_id": "doc_id"})


CHECK_FK_DOCUMENTS_SQL = """
SELECT doc_id, count(*) AS row_count FROM documents
WHERE NOT EXISTS (SELECT 1 FROM labels WHERE labels.doc_id = documents.doc_id)
GROUP BY doc_id
"""


def check_expr(data: Inputs) -> DataFrame:
    rows = data["lineitem"].select("l_orderkey", "l_linenumber", "l_quantity", "l_discount")
    return constraints.expression_violations(
        rows, (F.col("l_quantity") < 45) | (F.col("l_discount") < 0.05)
    )


CHECK_EXPR_SQL = """
SELECT l_orderkey, l_linenumber, l_quantity, l_discount FROM lineitem
WHERE NOT (l_quantity < 45 OR l_discount < 0.05)
"""


def check_types(data: Inputs) -> DataFrame:
    """Part names beyond VARCHAR(10) and prices beyond NUMERIC(5,2)."""
    rows = data["part"].select("p_partkey", "p_name", "p_retailprice")
    return constraints.type_limit_violations(
        rows, {"p_name": 10}, {"p_retailprice": T.DecimalType(5, 2)}
    )


CHECK_TYPES_SQL = """
SELECT p_partkey, p_name, p_retailprice, 'p_name' AS violated FROM part WHERE length(p_name) > 10
UNION ALL
SELECT p_partkey, p_name, p_retailprice, 'p_retailprice' FROM part
WHERE abs(round(p_retailprice, 2)) >= 1000
"""


def csv_roundtrip(data: Inputs) -> DataFrame:
    """Documents through a semicolon file whose delimiter is found from its header line.

    Texts hold quotes, blanks and line breaks; one column has empty strings and nulls.
    """
    marked = F.when(F.col("doc_id") % 3 == 0, F.lit("")).when(F.col("doc_id") % 3 == 1, F.lit(" x "))
    documents = data["documents"].withColumn("marked", marked)

    def build(path: str) -> str:
        write_csv(documents, path, delimiter=";", multi_line=True)
        return path

    path = data.stored("documents-csv", build)
    return read_csv(data.spark, path, documents.schema, multi_line=True)


def event_samples(data: Inputs) -> DataFrame:
    """The first rows of the events in a total order."""
    return counts.sample_rows(data["events"].select("event_id", "event_type", "value"), 5, ["event_id"])


def replaced_documents(data: Inputs) -> DataFrame:
    """A collection of labels that replaced another one, after a version with a key twice failed."""

    def build(path: str) -> str:
        labels = data["labels"]
        replace_collection(labels.select("doc_id"), path, ["doc_id"])
        replace_collection(labels, path, ["doc_id"])
        try:
            replace_collection(labels.unionByName(labels.limit(1)), path, ["doc_id"])
        except LoadRejected:
            return path
        raise RuntimeError("a collection with a key twice must be refused")

    return read_collection(data.spark, data.stored("labels", build))


def event_uniform(data: Inputs) -> DataFrame:
    """A repeatable uniform value in [-1000, 1000) for every event."""
    return data["events"].select("event_id", uniform_value("event_id").alias("value"))


UNIFORM_SQL = f"""
SELECT event_id,
       -1000.0 + 2000.0 * (CAST(CAST('0x' || substr(md5('42:' || event_id), 1, {HEX_DIGITS})
           AS BIGINT) AS DOUBLE) / {float(16**HEX_DIGITS)}) AS value
FROM events
"""


def _runs(data: Inputs) -> DataFrame:
    """Lines as measured runs: part = size, discount = k, line number = workers."""
    return data["lineitem"].select(
        F.col("l_partkey").alias("len_values"),
        F.col("l_discount").alias("k"),
        F.col("l_linenumber").alias("workers"),
        F.col("l_extendedprice").alias("sequential_time"),
        F.col("l_quantity").alias("parallel_time"),
    )


RUNS_SQL = """
    SELECT l_partkey AS len_values, l_discount AS k, l_linenumber AS workers,
           l_extendedprice AS sequential_time, l_quantity AS parallel_time,
           l_extendedprice / l_quantity AS speedup,
           l_extendedprice / l_quantity / l_linenumber AS efficiency
    FROM lineitem
"""
RUN_ORDER = ["k", "len_values", "workers", "sequential_time", "parallel_time"]


def _log(data: Inputs) -> DataFrame:
    def build(path: str) -> str:
        append_measurements(_runs(data), path, RUN_ORDER)
        return path

    return read_log(data.spark, data.stored("measurements", build))


def experiment_rows(data: Inputs) -> DataFrame:
    """All runs, appended to a log and read back, with their record ids."""
    return sorted_records(_log(data))


EXPERIMENT_ROWS_SQL = f"""
SELECT row_number() OVER (ORDER BY k, len_values, workers, sequential_time, parallel_time) - 1
           AS record_id, *
FROM ({RUNS_SQL}) AS runs
"""


def experiment_rollup(data: Inputs) -> DataFrame:
    """Mean metrics per worker count."""
    means = measurements.mean_metrics(_log(data), "workers")
    return means.select(
        "workers",
        "runs",
        *[round_half_up(f"mean_{name}", 6).alias(f"mean_{name}") for name in measurements.METRICS],
    )


EXPERIMENT_ROLLUP_SQL = f"""
SELECT workers, count(*) AS runs,
       {", ".join(f"{sql_round(f'avg({name})', 6)} AS mean_{name}"
                  for name in measurements.METRICS)}
FROM ({RUNS_SQL}) AS runs
GROUP BY workers
"""


def experiment_baseline(data: Inputs) -> DataFrame:
    """Mean sequential time of the one-worker runs per k."""
    baseline = measurements.sequential_baseline(_log(data))
    return baseline.groupBy("k").agg(
        round_half_up(F.avg("sequential_time"), 6).alias("mean_sequential_time")
    )


EXPERIMENT_BASELINE_SQL = f"""
SELECT k, {sql_round("avg(sequential_time)", 6)} AS mean_sequential_time
FROM ({RUNS_SQL}) AS runs WHERE workers = 1 GROUP BY k
"""


def experiment_best(data: Inputs) -> DataFrame:
    return measurements.best_runs(_log(data), "k")


EXPERIMENT_BEST_SQL = f"""
SELECT k, len_values AS best_len_values, k AS best_k, workers AS best_workers,
       speedup AS best_speedup, efficiency AS best_efficiency
FROM (
    SELECT *, row_number() OVER (
        PARTITION BY k ORDER BY speedup DESC, workers, len_values) AS place
    FROM ({RUNS_SQL}) AS runs
) AS ranked
WHERE place = 1
"""


def experiment_scaling(data: Inputs) -> DataFrame:
    profile = measurements.scaling_profile(_log(data))
    counts_text = F.array_join(F.col("worker_counts").cast("array<string>"), ",")
    return profile.select("k", "len_values", "baseline_time", counts_text.alias("worker_counts"))


EXPERIMENT_SCALING_SQL = f"""
SELECT k, len_values, first(sequential_time ORDER BY workers, sequential_time) AS baseline_time,
       string_agg(DISTINCT CAST(workers AS VARCHAR), ',' ORDER BY CAST(workers AS VARCHAR))
           AS worker_counts
FROM ({RUNS_SQL}) AS runs
GROUP BY k, len_values
"""

QUERIES = {
    "outlier_stats": query(event_outlier_stats),
    "outliers": query(lambda data: event_outliers(data, SIGMAS)),
    "outliers_low_k": query(lambda data: event_outliers(data, LOW_SIGMAS)),
    "outliers_price": query(price_outliers),
    "row_counts": query(lambda data: counts.row_counts(_pick(data, COUNTED))),
    "table_profile": query(lambda data: counts.table_profile(_pick(data, PROFILED))),
    "latest_events": query(latest_events),
    "check_not_null": query(check_not_null),
    "check_unique": query(check_unique),
    "check_fk": query(check_fk),
    "check_fk_documents": query(check_fk_documents),
    "check_expr": query(check_expr),
    "check_types": query(check_types),
    "csv_roundtrip": query(csv_roundtrip),
    "event_samples": query(event_samples),
    "replaced_documents": query(replaced_documents),
    "uniform_source": query(event_uniform),
    "experiment_rows": query(experiment_rows, DENSE_TASK_BYTES),
    "experiment_rollup": query(experiment_rollup, DENSE_TASK_BYTES),
    "experiment_baseline": query(experiment_baseline, DENSE_TASK_BYTES),
    "experiment_best": query(experiment_best, DENSE_TASK_BYTES),
    "experiment_scaling": query(experiment_scaling, DENSE_TASK_BYTES),
}

ORACLES = {
    "outlier_stats": OUTLIER_STATS_SQL,
    "outliers": outliers_sql("events", "event_id, value", "value", SIGMAS),
    "outliers_low_k": outliers_sql("events", "event_id, value", "value", LOW_SIGMAS),
    "outliers_price": outliers_sql(
        "lineitem", "l_orderkey, l_linenumber, l_extendedprice", "l_extendedprice", PRICE_SIGMAS
    ),
    "row_counts": ROW_COUNTS_SQL,
    "table_profile": TABLE_PROFILE_SQL,
    "latest_events": LATEST_EVENTS_SQL,
    "check_not_null": CHECK_NOT_NULL_SQL,
    "check_unique": CHECK_UNIQUE_SQL,
    "check_fk": CHECK_FK_SQL,
    "check_fk_documents": CHECK_FK_DOCUMENTS_SQL,
    "check_expr": CHECK_EXPR_SQL,
    "check_types": CHECK_TYPES_SQL,
    "csv_roundtrip": """
SELECT *, CASE doc_id % 3 WHEN 0 THEN '' WHEN 1 THEN ' x ' END AS marked FROM documents
""",
    "replaced_documents": "SELECT * FROM labels",
    "event_samples": "SELECT event_id, event_type, value FROM events ORDER BY event_id LIMIT 5",
    "uniform_source": UNIFORM_SQL,
    "experiment_rows": EXPERIMENT_ROWS_SQL,
    "experiment_rollup": EXPERIMENT_ROLLUP_SQL,
    "experiment_baseline": EXPERIMENT_BASELINE_SQL,
    "experiment_best": EXPERIMENT_BEST_SQL,
    "experiment_scaling": EXPERIMENT_SCALING_SQL,
}
