"""University marts over the driver tables.

Each role is played by a driver table, with the same rows in the Spark query and in its SQL twin:
courses = nation, students = part or customer, assignments = orders, part or customer,
submissions = lineitem or orders, files = pages or lineitem, feedback = lineitem.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from millrace.operators.documents import feedback_documents
from millrace.operators.keys import assign_dense_ids
from millrace.operators.manifest import file_manifest
from millrace.plans import marts
from millrace.plans.university_load import (
    load_assignments,
    load_enrollments,
    load_students,
    replace_university,
)
from millrace.registry.common import Inputs, query, sql_round
from millrace.session import DENSE_TASK_BYTES
from millrace.sinks.files import write_csv
from millrace.sinks.versions import Collection, LoadRejected
from millrace.sources.files import read_csv, read_text_csv
from millrace.sources.schemas import FEEDBACK_CSV, UNIVERSITY

MAX_POINTS = 50.0


def courses(data: Inputs) -> DataFrame:
    return data["nation"].select(
        F.col("n_nationkey").alias("course_id"), F.col("n_name").alias("course_name")
    )


def course_load(data: Inputs) -> DataFrame:
    enrollments = data["customer"].select(
        F.col("c_nationkey").alias("course_id"), F.col("c_custkey").alias("student_id")
    )
    assignments = data["supplier"].select(F.col("s_nationkey").alias("course_id"))
    return marts.course_load(courses(data), enrollments, assignments)


COURSE_LOAD_SQL = """
SELECT n_nationkey AS course_id, n_name AS course_name,
       (SELECT count(DISTINCT c_custkey) FROM customer WHERE c_nationkey = n_nationkey)
           AS student_count,
       (SELECT count(*) FROM supplier WHERE s_nationkey = n_nationkey) AS assignment_count
FROM nation
ORDER BY student_count DESC, assignment_count DESC, course_id
LIMIT 5
"""


def punctuality(data: Inputs) -> DataFrame:
    submissions = data["lineitem"].select(
        F.col("l_orderkey").alias("assignment_id"),
        F.col("l_partkey").alias("student_id"),
        F.col("l_shipdate").alias("submitted_ts"),
    )
    assignments = data["orders"].select(
        F.col("o_orderkey").alias("assignment_id"),
        F.col("o_custkey").alias("course_id"),
        F.date_add(F.col("o_orderdate").cast("date"), 30).alias("due_dt"),
    )
    students = data["part"].select(
        F.col("p_partkey").alias("student_id"), F.col("p_brand").alias("group_name")
    )
    return marts.submission_punctuality(submissions, assignments, students)


PUNCTUALITY_SQL = f"""
WITH late AS (
    SELECT o_custkey, p_brand,
           date_diff('day', CAST(o_orderdate AS DATE) + 30, CAST(l_shipdate AS DATE)) AS days
    FROM lineitem, orders, part
    WHERE l_orderkey = o_orderkey AND l_partkey = p_partkey
)
SELECT o_custkey AS course_id, p_brand AS group_name, count(*) AS submission_count,
       {sql_round("avg(CASE WHEN days > 0 THEN days ELSE 0 END)", 2)} AS avg_positive_delay_days,
       {sql_round("avg(CASE WHEN days > 0 THEN 1.0 ELSE 0.0 END)", 3)} AS late_rate
FROM late
GROUP BY o_custkey, p_brand
"""


def grade_distribution(data: Inputs) -> DataFrame:
    submissions = data["lineitem"].select(
        F.col("l_partkey").alias("assignment_id"),
        F.col("l_shipdate").alias("submitted_ts"),
        F.when(F.col("l_discount") == 0, 0.0).otherwise(F.col("l_quantity")).alias("grade"),
    )
    assignments = data["part"].select(
        F.col("p_partkey").alias("assignment_id"),
        F.col("p_size").alias("course_id"),
        F.col("p_name").alias("title"),
        F.date_add(F.lit("1998-01-01").cast("date"), F.col("p_size") * 10).alias("due_dt"),
        F.lit(MAX_POINTS).alias("max_score"),
    )
    return marts.grade_distribution(submissions, assignments)


GRADE_DISTRIBUTION_SQL = f"""
WITH graded AS (
    SELECT p_size, p_partkey, p_name,
           CASE WHEN l_discount = 0 THEN 0.0 ELSE l_quantity END AS grade,
           CAST(l_shipdate AS DATE) > DATE '1998-01-01' + p_size * 10 AS late
    FROM part JOIN lineitem ON l_partkey = p_partkey
), stats AS (
    SELECT p_size AS course_id, p_partkey AS assignment_id, p_name AS title,
           count(*) AS submission_count,
           {sql_round("avg(grade)", 2)} AS avg_grade,
           round(quantile_disc(grade, 0.5), 2) AS median_grade,
           {sql_round("avg(CASE WHEN grade = 0 THEN 1.0 ELSE 0.0 END)", 3)} AS zero_rate,
           {sql_round("avg(CASE WHEN late THEN 1.0 ELSE 0.0 END)", 3)} AS late_rate
    FROM graded
    GROUP BY p_size, p_partkey, p_name
)
SELECT *, avg_grade / {MAX_POINTS} < 0.6 AND late_rate >= 0.4 AS is_too_hard FROM stats
"""


def submissions_by_customer(data: Inputs) -> DataFrame:
    return data["orders"].select(
        F.col("o_orderkey").alias("submission_id"),
        F.col("o_custkey").alias("assignment_id"),
        F.col("o_orderdate").alias("submitted_ts"),
        (F.col("o_totalprice") / 10000).alias("grade"),
    )


def assignments_by_customer(data: Inputs) -> DataFrame:
    return data["customer"].select(
        F.col("c_custkey").alias("assignment_id"),
        F.col("c_nationkey").alias("course_id"),
        F.date_add(F.lit("1995-01-01").cast("date"), F.col("c_nationkey") * 100).alias("due_dt"),
    )


def _rubric_array(*extra: Column) -> Column:
    """Three rubric items per line; ``extra`` are further fields of every item."""

    def item(criterion: str, points: Column) -> Column:
        comment = F.concat(F.lit('said "'), F.col("l_returnflag"), F.lit('", ok'))
        return F.struct(
            F.lit(criterion).alias("criterion"),
            points.alias("points"),
            *extra,
            comment.alias("comment"),
        )

    return F.array(
        item("correctness", F.col("l_quantity")),
        item("style", F.col("l_discount") * 100),
        item("tests", F.col("l_tax") * 100),
    )


def feedback(data: Inputs) -> DataFrame:
    """Feedback as a document store returns it: one nested document per line."""
    limit = F.when(F.col("l_linestatus") == "F", 0.0).otherwise(MAX_POINTS)
    return data["lineitem"].select(
        F.col("l_orderkey").alias("submission_id"),
        _rubric_array(limit.alias("max_points")).alias("rubric"),
    )


def _feedback_file(data: Inputs) -> DataFrame:
    """Feedback as delivered in a file: all text, the rubric a JSON array."""
    return data["lineitem"].select(
        F.concat_ws("-", "l_orderkey", "l_linenumber").alias("_id"),
        F.col("l_orderkey").cast("string").alias("submission_id"),
        F.col("l_suppkey").cast("string").alias("teacher_id"),
        F.date_format("l_shipdate", "yyyy-MM-dd").alias("ts"),
        F.to_json(_rubric_array()).alias("rubric"),
        F.col("l_linestatus").alias("overall_comment"),
    )


ITEMS_SQL = """
    SELECT l_orderkey, l_linestatus, 'correctness' AS criterion, l_quantity AS points
    FROM lineitem
    UNION ALL
    SELECT l_orderkey, l_linestatus, 'style', l_discount * 100 FROM lineitem
    UNION ALL
    SELECT l_orderkey, l_linestatus, 'tests', l_tax * 100 FROM lineitem
"""
LIMIT_SQL = f"CASE WHEN l_linestatus = 'F' THEN 0.0 ELSE {MAX_POINTS} END"


def rubric_items(data: Inputs) -> DataFrame:
    return marts.rubric_items(
        submissions_by_customer(data), assignments_by_customer(data), feedback(data)
    )


RUBRIC_ITEMS_SQL = f"""
SELECT c_nationkey AS course_id, c_custkey AS assignment_id, o_orderkey AS submission_id,
       criterion, points, CAST({LIMIT_SQL} AS DOUBLE) AS max_points
FROM ({ITEMS_SQL}) AS items
JOIN orders ON o_orderkey = l_orderkey
JOIN customer ON c_custkey = o_custkey
"""


def rubric_stats(data: Inputs) -> DataFrame:
    return marts.rubric_evaluation(rubric_items(data))


RUBRIC_STATS_SQL = f"""
WITH scored AS (
    SELECT criterion, points, points / NULLIF({LIMIT_SQL}, 0) AS score
    FROM ({ITEMS_SQL}) AS items
    JOIN orders ON o_orderkey = l_orderkey
    JOIN customer ON c_custkey = o_custkey
)
SELECT criterion, count(*) AS evaluation_count,
       {sql_round("avg(points)", 2)} AS avg_points,
       {sql_round("avg(score)", 3)} AS avg_score_ratio,
       {sql_round("avg(CASE WHEN score < 0.6 THEN 1.0 ELSE 0.0 END)", 3)} AS weak_rate
FROM scored
GROUP BY criterion
ORDER BY weak_rate DESC, avg_points, criterion
LIMIT 10
"""


def rubric_load(data: Inputs) -> DataFrame:
    """Feedback through a CSV file with JSON inside a quoted field, and back to documents."""

    def build(path: str) -> str:
        write_csv(_feedback_file(data), path)
        return path

    path = data.stored("feedback-csv", build)
    documents = feedback_documents(read_text_csv(data.spark, path, FEEDBACK_CSV))
    return documents.select("submission_id", "teacher_id", F.inline("rubric"))


RUBRIC_LOAD_SQL = """
SELECT l_orderkey AS submission_id, l_suppkey AS teacher_id, criterion, points,
       CAST(5 AS DOUBLE) AS max_points,
       'said "' || l_returnflag || '", ok' AS comment
FROM (
    SELECT l_orderkey, l_suppkey, l_returnflag, 'correctness' AS criterion, l_quantity AS points
    FROM lineitem
    UNION ALL
    SELECT l_orderkey, l_suppkey, l_returnflag, 'style', l_discount * 100 FROM lineitem
    UNION ALL
    SELECT l_orderkey, l_suppkey, l_returnflag, 'tests', l_tax * 100 FROM lineitem
) AS items
"""


def _manifest(data: Inputs) -> DataFrame:
    raw = data["pages"].select(
        F.col("page_id").cast("string").alias("submission_id"),
        F.length(F.split_part("url", F.lit("/"), F.lit(3))).cast("string").alias("assignment_id"),
        F.length("url").cast("string").alias("student_id"),
        F.col("url").alias("file_path"),
        F.length("html").cast("string").alias("size_kb"),
    )
    return file_manifest(raw)


MANIFEST_SQL = """
    SELECT CAST(page_id AS INT) AS submission_id,
           CAST(length(split_part(url, '/', 3)) AS INT) AS assignment_id,
           CAST(length(url) AS INT) AS student_id,
           regexp_extract(url, '[^/]+$', 0) AS file_name,
           CAST(length(html) AS DOUBLE) AS size_kb,
           CAST(length(html) AS BIGINT) * 1024 AS size_bytes,
           's3://course-data/' || url AS object_path
    FROM pages
"""

FILE_SIZES_SQL = f"""
SELECT assignment_id, count(*) AS file_count,
       {sql_round("avg(size_kb)", 2)} AS avg_file_size_kb
FROM ({MANIFEST_SQL}) AS files
GROUP BY assignment_id
"""

LARGEST_FILES_SQL = f"""
SELECT submission_id, assignment_id, file_name, size_kb, size_bytes, object_path
FROM ({MANIFEST_SQL}) AS files
ORDER BY size_kb DESC, submission_id
LIMIT 10
"""


def missing_files(data: Inputs) -> DataFrame:
    """Orders without a line shipped in the year of the order."""
    submissions = data["orders"].select(
        F.col("o_orderkey").alias("submission_id"),
        F.year("o_orderdate").alias("assignment_id"),
        F.col("o_custkey").alias("student_id"),
        F.col("o_orderdate").alias("submitted_ts"),
        F.col("o_totalprice").alias("grade"),
    )
    manifest = data["lineitem"].select(
        F.col("l_orderkey").alias("submission_id"), F.year("l_shipdate").alias("assignment_id")
    )
    return marts.missing_files(submissions, manifest)


MISSING_FILES_SQL = """
SELECT o_orderkey AS submission_id, CAST(year(o_orderdate) AS INT) AS assignment_id,
       o_custkey AS student_id, o_orderdate AS submitted_ts, o_totalprice AS grade
FROM orders
WHERE NOT EXISTS (
    SELECT 1 FROM lineitem
    WHERE l_orderkey = o_orderkey AND year(l_shipdate) = year(o_orderdate)
)
"""


def quality_mart(data: Inputs) -> DataFrame:
    manifest = data["lineitem"].select(
        F.col("l_suppkey").cast("string").alias("assignment_id"),
        F.col("l_quantity").cast("int").cast("string").alias("size_kb"),
    )
    return marts.course_quality(
        courses(data),
        assignments_by_customer(data),
        submissions_by_customer(data),
        manifest,
        feedback(data),
    )


QUALITY_MART_SQL = f"""
WITH grades AS (
    SELECT c_nationkey AS id, {sql_round("avg(o_totalprice / 10000)", 2)} AS avg_grade,
           {sql_round('''avg(CASE WHEN CAST(o_orderdate AS DATE) >
               DATE '1995-01-01' + c_nationkey * 100 THEN 1.0 ELSE 0.0 END)''', 3)} AS late_rate
    FROM customer JOIN orders ON o_custkey = c_custkey
    GROUP BY c_nationkey
), files AS (
    SELECT c_nationkey AS id,
           {sql_round("avg(CAST(CAST(l_quantity AS INT) AS DOUBLE))", 2)} AS avg_file_size_kb
    FROM lineitem JOIN customer ON l_suppkey = c_custkey
    GROUP BY c_nationkey
), correctness AS (
    SELECT c_nationkey AS id, {sql_round("avg(l_quantity)", 2)} AS avg_correctness_points
    FROM lineitem JOIN orders ON l_orderkey = o_orderkey JOIN customer ON o_custkey = c_custkey
    GROUP BY c_nationkey
)
SELECT n_nationkey AS course_id, n_name AS course_name, avg_grade, late_rate,
       avg_file_size_kb, avg_correctness_points
FROM nation
LEFT JOIN grades ON grades.id = n_nationkey
LEFT JOIN files ON files.id = n_nationkey
LEFT JOIN correctness ON correctness.id = n_nationkey
"""


def student_load(data: Inputs) -> DataFrame:
    raw = data["customer"].select(
        F.col("c_custkey").alias("student_id"),
        F.col("c_name").alias("name"),
        F.col("c_mktsegment").alias("group_name"),
        F.col("c_nationkey").alias("enrollment_year"),
    )
    return load_students(raw)


STUDENT_LOAD_SQL = """
SELECT c_custkey AS student_id, c_name AS full_name, c_mktsegment AS group_name,
       c_nationkey AS enrollment_year, 'student' || c_custkey || '@example.edu' AS email
FROM customer
"""


def assignment_load(data: Inputs) -> DataFrame:
    raw = data["orders"].select(
        F.col("o_orderkey").alias("assignment_id"),
        F.col("o_custkey").alias("course_id"),
        F.col("o_orderdate").cast("date").alias("due_dt"),
        F.col("o_totalprice").alias("max_score"),
    )
    return load_assignments(raw)


ASSIGNMENT_LOAD_SQL = """
SELECT o_orderkey AS assignment_id, o_custkey AS course_id,
       'Assignment_' || o_orderkey AS title, CAST(o_orderdate AS DATE) AS due_dt,
       o_totalprice AS max_score
FROM orders
"""


def enrollment_load(data: Inputs) -> DataFrame:
    raw = data["orders"].select(
        F.col("o_custkey").alias("course_id"),
        F.year("o_orderdate").alias("student_id"),
        F.trunc(F.col("o_orderdate").cast("date"), "month").alias("enrolled_dt"),
    )
    return load_enrollments(raw)


SURROGATE_KEYS_SQL = """
SELECT row_number() OVER (ORDER BY course_id, student_id, enrolled_dt) AS enrollment_id,
       course_id, student_id, enrolled_dt
FROM (
    SELECT DISTINCT o_custkey AS course_id, CAST(year(o_orderdate) AS INT) AS student_id,
           CAST(date_trunc('month', o_orderdate) AS DATE) AS enrolled_dt
    FROM orders
) AS pairs
"""


def university_files(data: Inputs, path: str) -> dict[str, DataFrame]:
    """The six files of a university, whose keys and references hold.

    Three of them are made of lines with their customers; these are joined once and kept at ``path``.
    """
    col = F.col
    joined = data["lineitem"].join(data["orders"], col("l_orderkey") == col("o_orderkey"))
    needed = joined.select("l_partkey", "l_suppkey", "l_shipdate", "l_quantity", "o_custkey")
    needed.write.option("compression", "zstd").parquet(path)
    lines = data.spark.read.schema(needed.schema).parquet(path)
    taken = lines.groupBy(col("l_suppkey").alias("course_id"), col("o_custkey").alias("student_id")).agg(
        F.min(col("l_shipdate").cast("date")).alias("enrolled_dt")
    )
    handed_in = lines.groupBy(col("l_partkey").alias("assignment_id"), col("o_custkey").alias("student_id")).agg(
        F.max("l_shipdate").alias("submitted_ts"), F.max("l_quantity").cast("decimal(5,2)").alias("score")
    )
    set_by = lines.groupBy(col("l_partkey").alias("assignment_id")).agg(
        F.min("l_suppkey").alias("course_id"), F.max(col("l_shipdate").cast("date")).alias("due_dt")
    )
    return {
        "students": data["customer"].selectExpr(
            "c_custkey AS student_id", "c_name AS name", "c_mktsegment AS group_name", "c_nationkey AS enrollment_year"
        ),
        "teachers": data["nation"].selectExpr("n_nationkey AS teacher_id", "n_name AS name", "'science' AS department"),
        "courses": data["supplier"].selectExpr(
            "s_suppkey AS course_id", "s_name AS title", "s_nationkey AS teacher_id", "'2025-Fall' AS semester"
        ),
        "enrollments": taken.select("student_id", "course_id", "enrolled_dt"),
        "assignments": set_by.select("assignment_id", "course_id", "due_dt", F.lit(50).cast("decimal(5,2)").alias("max_score")),
        "submissions": assign_dense_ids(handed_in, ["assignment_id", "student_id"], "submission_id").select(
            "submission_id", "assignment_id", "student_id", "submitted_ts", "score"
        ),
    }


# Key and text of each table in the summary.
_SUMMARY = {
    "students": ("student_id", "email"),
    "teachers": ("teacher_id", "full_name"),
    "courses": ("course_id", "course_name"),
    "enrollments": ("enrollment_id", "enrolled_dt"),
    "assignments": ("assignment_id", "title"),
    "submissions": ("submission_id", "grade"),
}


def university_load(data: Inputs) -> DataFrame:
    """Summary of six tables loaded as one, after a later load with one bad row was refused."""

    def build(path: str) -> str:
        good, bad, root = f"{path}/good", f"{path}/bad", f"{path}/tables"
        for name, rows in university_files(data, f"{path}/lines").items():
            write_csv(rows, f"{good}/{name}.csv", compression="gzip")
        version = replace_university(data.spark, good, root)
        for name in UNIVERSITY.keys() - {"submissions"}:
            same = read_csv(data.spark, f"{good}/{name}.csv", UNIVERSITY[name], delimiter=",")
            write_csv(same, f"{bad}/{name}.csv", compression="gzip")
        # The last file of the second delivery holds a student that no file knows.
        stray = data.spark.sql("SELECT 1 AS i, 1 AS a, -1 AS s, timestamp_ntz'2025-01-01' AS t, 1.00 AS g")
        write_csv(stray.toDF("submission_id", "assignment_id", "student_id", "submitted_ts", "score"), f"{bad}/submissions.csv")
        try:
            replace_university(data.spark, bad, root)
        except LoadRejected:
            if Collection(data.spark, root).current() == version:
                return root
        raise RuntimeError("a load with a stray student must be refused")

    tables = Collection(data.spark, data.stored("university", build))
    parts = [
        tables.table(name).agg(
            F.lit(name).alias("table_name"),
            F.count("*").alias("row_count"),
            F.sum(F.col(key).cast("long")).alias("key_sum"),
            F.max(F.col(text).cast("string")).alias("last_text"),
        )
        for name, (key, text) in _SUMMARY.items()
    ]
    return reduce(DataFrame.unionByName, parts)


UNIVERSITY_LOAD_SQL = """
WITH lines AS (SELECT * FROM lineitem JOIN orders ON l_orderkey = o_orderkey),
taken AS (SELECT l_suppkey, o_custkey, min(CAST(l_shipdate AS DATE)) AS d FROM lines GROUP BY ALL),
handed AS (SELECT l_partkey, o_custkey, max(l_quantity) AS q FROM lines GROUP BY ALL),
counted(table_name, row_count, key_sum, last_text) AS (
    SELECT 'students', count(*), sum(c_custkey), max('student' || c_custkey || '@example.edu') FROM customer
    UNION ALL SELECT 'teachers', count(*), sum(n_nationkey), max(n_name) FROM nation
    UNION ALL SELECT 'courses', count(*), sum(s_suppkey), max(s_name) FROM supplier
    UNION ALL SELECT 'enrollments', count(*), count(*) * (count(*) + 1) // 2, CAST(max(d) AS VARCHAR) FROM taken
    UNION ALL SELECT 'assignments', count(DISTINCT l_partkey), sum(DISTINCT l_partkey), max('Assignment_' || l_partkey) FROM lines
    UNION ALL SELECT 'submissions', count(*), count(*) * (count(*) + 1) // 2,
        max(CAST(CAST(q AS DECIMAL(5, 2)) AS VARCHAR)) FROM handed)
SELECT table_name, row_count, CAST(key_sum AS BIGINT) AS key_sum, last_text FROM counted
"""

QUERIES = {
    "university_load": query(university_load, DENSE_TASK_BYTES),
    "course_load": query(course_load),
    "punctuality": query(punctuality),
    "grade_distribution": query(grade_distribution, DENSE_TASK_BYTES),
    "rubric_items": query(rubric_items),
    "rubric_stats": query(rubric_stats),
    "rubric_load": query(rubric_load),
    "file_manifest": query(_manifest),
    "file_sizes": query(lambda data: marts.file_sizes(_manifest(data))),
    "largest_files": query(lambda data: marts.largest_files(_manifest(data))),
    "missing_files": query(missing_files),
    "quality_mart": query(quality_mart),
    "student_load": query(student_load),
    "assignment_load": query(assignment_load),
    "surrogate_keys": query(enrollment_load),
}

ORACLES = {
    "university_load": UNIVERSITY_LOAD_SQL,
    "course_load": COURSE_LOAD_SQL,
    "punctuality": PUNCTUALITY_SQL,
    "grade_distribution": GRADE_DISTRIBUTION_SQL,
    "rubric_items": RUBRIC_ITEMS_SQL,
    "rubric_stats": RUBRIC_STATS_SQL,
    "rubric_load": RUBRIC_LOAD_SQL,
    "file_manifest": MANIFEST_SQL,
    "file_sizes": FILE_SIZES_SQL,
    "largest_files": LARGEST_FILES_SQL,
    "missing_files": MISSING_FILES_SQL,
    "quality_mart": QUALITY_MART_SQL,
    "student_load": STUDENT_LOAD_SQL,
    "assignment_load": ASSIGNMENT_LOAD_SQL,
    "surrogate_keys": SURROGATE_KEYS_SQL,
}
