"""Sources of unlike formats under one catalog, and tables that are created over delivered files.

Roles as in the university and hospital marts; here each side is first written in the format its
source delivers, and is read through the session catalog.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from millrace.plans.federated import COURSE_QUALITY
from millrace.registry.common import Inputs, query, sql_round
from millrace.registry.university import (
    QUALITY_MART_SQL,
    assignments_by_customer,
    courses,
    feedback,
    submissions_by_customer,
)
from millrace.session import DENSE_TASK_BYTES
from millrace.sinks.files import write_csv
from millrace.sources.documents import read_documents_any_case
from millrace.sources.external_tables import (
    ExternalTable,
    columnar_table,
    csv_table,
    document_table,
    federated,
    mount,
)
from millrace.sources.files import folder_sizes, list_files
from millrace.sources.schemas import HOSPITAL

# File manifest as delivered: every column is text. Feedback: only what the marts need.
MANIFEST_TEXT = "assignment_id STRING, student_id STRING, submission_id STRING, file_path STRING, size_kb STRING"
FEEDBACK_NEEDED = "submission_id BIGINT, rubric ARRAY<STRUCT<criterion: STRING, points: DOUBLE>>"


def _manifest_text(data: Inputs) -> DataFrame:
    return data["lineitem"].select(
        F.col("l_suppkey").cast("string").alias("assignment_id"),
        F.col("l_partkey").cast("string").alias("student_id"),
        F.col("l_orderkey").cast("string").alias("submission_id"),
        F.concat_ws("/", F.lit("files"), "l_orderkey", "l_linenumber").alias("file_path"),
        F.col("l_quantity").cast("int").cast("string").alias("size_kb"),
    )


def mounted_sources(data: Inputs) -> dict[str, str]:
    """Three sources in their own formats, mounted; the full name of each table by its role."""

    def build(path: str) -> dict[str, str]:
        tag = path.rsplit("-", 1)[-1]
        lms, store, documents = (f"{kind}_{tag}" for kind in ("lms", "store", "documents"))
        for name, rows in (
            ("courses", courses(data)),
            ("assignments", assignments_by_customer(data)),
            ("submissions", submissions_by_customer(data)),
        ):
            rows.write.parquet(f"{path}/{name}")
        # Both are text that repeats itself in every line: a tenth of it is left when compressed.
        write_csv(_manifest_text(data), f"{path}/files", compression="gzip")
        feedback(data).write.option("compression", "gzip").json(f"{path}/feedback")
        return mount(
            data.spark,
            [
                columnar_table(lms, "courses", f"{path}/courses"),
                columnar_table(lms, "assignments", f"{path}/assignments"),
                columnar_table(lms, "submissions", f"{path}/submissions"),
                csv_table(store, "files", f"{path}/files", MANIFEST_TEXT),
                document_table(documents, "feedback", f"{path}/feedback", FEEDBACK_NEEDED),
            ],
        )

    return data.stored("federation", build)


def federated_mart(data: Inputs) -> DataFrame:
    """The course quality mart as one SQL text over columnar files, delimited text and documents."""
    return federated(data.spark, COURSE_QUALITY, mounted_sources(data))


def _mixed_case_feedback(data: Inputs) -> DataFrame:
    """Feedback documents of two writers, who spell the fields in their own ways."""

    def item(names: tuple[str, str, str], criterion: str, points: Column) -> Column:
        values = (F.lit(criterion), points, F.lit("ok"))
        return F.struct(*(value.alias(name) for name, value in zip(names, values)))

    def document(names: tuple[str, str], inner: tuple[str, str, str]) -> Column:
        items = F.array(
            item(inner, "correctness", F.col("l_quantity")), item(inner, "tests", F.col("l_tax") * 100)
        )
        return F.to_json(F.struct(F.col("l_orderkey").alias(names[0]), items.alias(names[1]), F.lit("x").alias("Note")))

    one = document(("submissionId", "rubric"), ("criterion", "points", "comment"))
    other = document(("SubmissionID", "Rubric"), ("Criterion", "POINTS", "Comment"))
    return data["lineitem"].select(F.when(F.col("l_linenumber") % 2 == 0, one).otherwise(other).alias("value"))


def document_scan(data: Inputs) -> DataFrame:
    """Rubric items of documents whose field names differ in case."""

    def build(path: str) -> str:
        _mixed_case_feedback(data).write.text(path)
        return path

    schema = "submissionid BIGINT, rubric ARRAY<STRUCT<criterion: STRING, points: DOUBLE>>"
    documents = read_documents_any_case(data.spark, data.stored("mixed-case", build), schema)
    return documents.select("submissionid", F.inline("rubric")).where("criterion = 'correctness'")


DOCUMENT_SCAN_SQL = """
SELECT l_orderkey AS submissionid, 'correctness' AS criterion, l_quantity AS points FROM lineitem
"""


def _filled(rows: DataFrame, schema: str, **columns: Column) -> DataFrame:
    """``rows`` with the columns of a schema, in its order; those not named are null."""
    kinds = [item.strip().split(" ", 1) for item in schema.split(",")]
    return rows.select(
        *(columns.get(name, F.lit(None)).cast(kind).alias(name) for name, kind in kinds)
    )


def hospital_files(data: Inputs) -> dict[str, DataFrame]:
    """The five record files of a hospital, from the driver tables."""
    col = F.col
    return {
        "patients": _filled(
            data["customer"], HOSPITAL["patients"], id=col("c_custkey"), last=col("c_name"),
            city=col("c_mktsegment"), state=col("c_nationkey"), lat=col("c_acctbal"),
        ),
        "organizations": _filled(
            data["region"], HOSPITAL["organizations"], id=col("r_regionkey"), name=col("r_name"), lat=col("r_regionkey"),
        ),
        "payers": _filled(data["nation"], HOSPITAL["payers"], id=col("n_nationkey"), name=col("n_name")),
        "encounters": _filled(
            data["orders"], HOSPITAL["encounters"], id=col("o_orderkey"), start_ts=col("o_orderdate"),
            patient=col("o_custkey"), payer=F.pmod("o_custkey", F.lit(25)),
            organization=F.pmod("o_orderkey", F.lit(5)), encounterclass=col("o_orderpriority"),
            total_claim_cost=col("o_totalprice"),
        ),
        "procedures": _filled(
            data["lineitem"], HOSPITAL["procedures"], start_ts=col("l_shipdate"), encounter=col("l_orderkey"),
            code=col("l_partkey"), description=col("l_returnflag"), base_cost=col("l_extendedprice"),
        ),
    }


def hospital_tables(data: Inputs) -> dict[str, ExternalTable]:
    """The five files as external tables, dropped once and created again over the same files."""

    def build(path: str) -> dict[str, ExternalTable]:
        source = f"records_{path.rsplit('-', 1)[-1]}"
        for name, rows in hospital_files(data).items():
            write_csv(rows, f"{path}/{name}.csv")
        tables = {
            name: csv_table(source, name, f"{path}/{name}.csv", schema) for name, schema in HOSPITAL.items()
        }
        mount(data.spark, tables.values())
        files = list_files(data.spark, path).count()
        for table in tables.values():
            table.drop(data.spark)
        if list_files(data.spark, path).count() != files:
            raise RuntimeError("dropping external tables must leave their files")
        mount(data.spark, tables.values())
        return tables

    return data.stored("records", build)


# Key, amount and time of each table; a table without one of them has null there.
_MEASURES = {
    "patients": ("id", "lat", None),
    "organizations": ("id", "lat", None),
    "payers": ("id", None, None),
    "encounters": ("id", "total_claim_cost", "start_ts"),
    "procedures": ("encounter", "base_cost", "start_ts"),
}


def external_tables(data: Inputs) -> DataFrame:
    """Rows, keys, amounts and first day of the five external tables."""
    parts = []
    for name, table in hospital_tables(data).items():
        key, amount, time = _MEASURES[name]
        total = F.sum(amount).cast("decimal(38,10)") if amount else F.lit(None)
        parts.append(
            table.read(data.spark).agg(
                F.lit(name).alias("table_name"),
                F.count("*").alias("row_count"),
                F.countDistinct(key).alias("key_count"),
                F.round(total, 2).cast("double").alias("amount"),
                (F.min(time).cast("date") if time else F.lit(None).cast("date")).alias("first_day"),
            )
        )
    result = parts[0]
    for part in parts[1:]:
        result = result.unionByName(part)
    return result


EXTERNAL_TABLES_SQL = f"""
SELECT 'patients' AS table_name, count(*) AS row_count, count(DISTINCT c_custkey) AS key_count,
       {sql_round("sum(c_acctbal)", 2)} AS amount, CAST(NULL AS DATE) AS first_day FROM customer
UNION ALL SELECT 'organizations', count(*), count(DISTINCT r_regionkey), {sql_round("sum(r_regionkey)", 2)}, NULL FROM region
UNION ALL SELECT 'payers', count(*), count(DISTINCT n_nationkey), NULL, NULL FROM nation
UNION ALL SELECT 'encounters', count(*), count(DISTINCT o_orderkey), {sql_round("sum(o_totalprice)", 2)},
    CAST(min(o_orderdate) AS DATE) FROM orders
UNION ALL SELECT 'procedures', count(*), count(DISTINCT l_orderkey), {sql_round("sum(l_extendedprice)", 2)},
    CAST(min(l_shipdate) AS DATE) FROM lineitem
"""


def file_inventory(data: Inputs) -> DataFrame:
    """Folders of an object store with the number and bytes of their files, contents unread."""

    def build(path: str) -> str:
        lines = data["orders"].select(
            F.col("o_orderpriority").alias("folder"), F.concat_ws("|", "o_orderkey", "o_orderstatus").alias("line")
        )
        lines.repartition("folder").write.partitionBy("folder").text(f"{path}/store")
        return f"{path}/store"

    return folder_sizes(list_files(data.spark, data.stored("inventory", build)).where("length > 0"), "folder")


FILE_INVENTORY_SQL = """
SELECT o_orderpriority AS folder, 1 AS file_count,
       CAST(sum(length(o_orderkey || '|' || o_orderstatus) + 1) AS BIGINT) AS bytes
FROM orders GROUP BY o_orderpriority
"""

QUERIES = {
    "file_inventory": query(file_inventory),
    "federated_mart": query(federated_mart, DENSE_TASK_BYTES),
    "document_scan": query(document_scan),
    "external_tables": query(external_tables),
}

ORACLES = {
    "file_inventory": FILE_INVENTORY_SQL,
    "federated_mart": QUALITY_MART_SQL,
    "document_scan": DOCUMENT_SCAN_SQL,
    "external_tables": EXTERNAL_TABLES_SQL,
}
