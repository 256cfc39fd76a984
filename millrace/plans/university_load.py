"""Load-time projections from delivered university files to the analytic tables."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from millrace.functions import labelled
from millrace.operators.constraints import duplicate_keys, expression_violations, null_violations, orphan_keys
from millrace.operators.keys import surrogate_keys
from millrace.sinks.versions import Check, Collection, replace_all
from millrace.sources.files import read_csv
from millrace.sources.schemas import UNIVERSITY


def load_students(raw: DataFrame) -> DataFrame:
    return raw.select(
        "student_id",
        F.col("name").alias("full_name"),
        "group_name",
        "enrollment_year",
        labelled("student", "student_id", "@example.edu").alias("email"),
    )


def load_teachers(raw: DataFrame) -> DataFrame:
    return raw.select("teacher_id", F.col("name").alias("full_name"), "department")


def load_courses(raw: DataFrame) -> DataFrame:
    return raw.select("course_id", "teacher_id", F.col("title").alias("course_name"), "semester")


def load_enrollments(raw: DataFrame) -> DataFrame:
    """Distinct enrollments with dense ids in (course, student, date) order."""
    return surrogate_keys(raw, ["course_id", "student_id", "enrolled_dt"], "enrollment_id")


def load_assignments(raw: DataFrame) -> DataFrame:
    return raw.select(
        "assignment_id",
        "course_id",
        labelled("Assignment_", "assignment_id").alias("title"),
        "due_dt",
        "max_score",
    )


def load_submissions(raw: DataFrame) -> DataFrame:
    return raw.select(
        "submission_id",
        "assignment_id",
        "student_id",
        "submitted_ts",
        F.col("score").alias("grade"),
    )


LOADERS = {
    "students": load_students,
    "teachers": load_teachers,
    "courses": load_courses,
    "enrollments": load_enrollments,
    "assignments": load_assignments,
    "submissions": load_submissions,
}


def load_university(spark: SparkSession, folder: str, names: list[str]) -> dict[str, DataFrame]:
    """Read ``<folder>/<name>.csv`` strictly and map each file to its analytic table."""
    return {
        name: LOADERS[name](
            read_csv(spark, f"{folder}/{name}.csv", UNIVERSITY[name], delimiter=",")
        )
        for name in names
    }


# Keys, references and required columns of the analytic tables.
UNIQUE = {
    "students": [["student_id"], ["email"]],
    "teachers": [["teacher_id"]],
    "courses": [["course_id"]],
    "enrollments": [["enrollment_id"], ["course_id", "student_id"]],
    "assignments": [["assignment_id"]],
    "submissions": [["submission_id"], ["assignment_id", "student_id"]],
}
REFERENCES = [
    ("courses", "teacher_id", "teachers"),
    ("enrollments", "course_id", "courses"),
    ("enrollments", "student_id", "students"),
    ("assignments", "course_id", "courses"),
    ("submissions", "assignment_id", "assignments"),
    ("submissions", "student_id", "students"),
]


def _no_nulls(name: str) -> Check:
    def check(tables: Mapping[str, DataFrame]) -> DataFrame:
        rows = tables[name]
        optional = {"max_score"} if name == "assignments" else set()
        return null_violations(rows, [c for c in rows.columns if c not in optional])

    return check


def _unique(name: str, key: list[str]) -> Check:
    return lambda tables: duplicate_keys(tables[name], key)


def _refers(child: str, key: str, parent: str) -> Check:
    return lambda tables: orphan_keys(tables[child], tables[parent], {key: key})


def _grades(tables: Mapping[str, DataFrame]) -> DataFrame:
    return expression_violations(tables["submissions"], F.col("grade") >= 0)


def university_checks() -> dict[str, Check]:
    """The rules of all six tables by name; each gives the rows or keys that break it."""
    checks = {f"{name} without nulls": _no_nulls(name) for name in LOADERS}
    for name, keys in UNIQUE.items():
        checks |= {f"{name} unique {', '.join(key)}": _unique(name, key) for key in keys}
    for child, key, parent in REFERENCES:
        checks[f"{child}.{key} in {parent}"] = _refers(child, key, parent)
    checks["grade not negative"] = _grades
    return checks


def replace_university(spark: SparkSession, folder: str, root: str, keep: int = 1) -> str:
    """Load the six files of a folder into the collection at ``root``: all of them, or none.

    A malformed row in any file, or a broken rule of any table, fails the load and leaves the
    collection as it was.
    """
    tables = load_university(spark, folder, list(LOADERS))
    return replace_all(Collection(spark, root), tables, university_checks(), keep)
