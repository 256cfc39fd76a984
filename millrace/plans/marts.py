"""University marts: course load, punctuality, grades, rubrics, files and course quality.

Every function takes the tables it needs as DataFrames, from whatever source they come. Sides
that only contribute totals are aggregated before they are joined. Small sides are broadcast by
Spark's own size threshold; there are no unconditional broadcast hints.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from millrace.functions import (
    days_late,
    flag,
    is_late,
    positive_part,
    rate,
    rounded_avg,
    rounded_ratio,
    safe_ratio,
)
from millrace.operators.documents import unnest_rubric

WEAK_SCORE = 0.60
HARD_SCORE = 0.60
HARD_LATE_RATE = 0.40


def course_load(
    courses: DataFrame, enrollments: DataFrame, assignments: DataFrame, top: int = 5
) -> DataFrame:
    """Courses with the most distinct students, with their number of assignments."""
    students = enrollments.groupBy("course_id").agg(
        F.countDistinct("student_id").alias("students")
    )
    tasks = assignments.groupBy("course_id").agg(F.count("*").alias("tasks"))
    return (
        courses.join(students, "course_id", "left")
        .join(tasks, "course_id", "left")
        .select(
            "course_id",
            "course_name",
            F.coalesce("students", F.lit(0)).alias("student_count"),
            F.coalesce("tasks", F.lit(0)).alias("assignment_count"),
        )
        .orderBy(F.desc("student_count"), F.desc("assignment_count"), F.asc_nulls_last("course_id"))
        .limit(top)
    )


def submission_punctuality(
    submissions: DataFrame, assignments: DataFrame, students: DataFrame
) -> DataFrame:
    """Submissions, mean days late and share of late ones per course and student group."""
    dated = (
        submissions.select("assignment_id", "student_id", "submitted_ts")
        .join(students.select("student_id", "group_name"), "student_id")
        .join(assignments.select("assignment_id", "course_id", "due_dt"), "assignment_id")
    )
    return (
        dated.groupBy("course_id", "group_name")
        .agg(
            F.count("*").alias("submission_count"),
            rounded_avg(positive_part(days_late("submitted_ts", "due_dt")), 2).alias(
                "avg_positive_delay_days"
            ),
            rate(is_late("submitted_ts", "due_dt")).alias("late_rate"),
        )
        .orderBy(F.asc_nulls_last("course_id"), F.asc_nulls_last("group_name"))
    )


def grade_distribution(submissions: DataFrame, assignments: DataFrame) -> DataFrame:
    """Grade statistics per assignment; too hard means a low mean score and many late ones.

    Submissions are counted per assignment, day and grade in their scan, so what is moved by
    assignment is bounded by days times grades, however many submissions an assignment has. The
    counts meet the assignments once and are then reduced to grades. The median over them is
    exact: the lowest grade that at least half of the submissions do not exceed. The label
    compares the rounded statistics that are shown.
    """
    owner = "assignment_id"
    daily = submissions.groupBy(
        owner,
        F.col("submitted_ts").cast("date").alias("day"),
        F.col("grade").cast("double").alias("grade"),
    ).agg(F.count("*").alias("day_rows"))
    attributes = ["course_id", "title", "max_score"]
    counted = (
        daily.join(assignments.select(owner, "due_dt", *attributes), owner)
        .groupBy(owner, *attributes, "grade")
        .agg(
            F.sum("day_rows").alias("rows"),
            F.sum(F.when(is_late("day", "due_dt"), F.col("day_rows")).otherwise(0)).alias("late"),
        )
        .withColumn("grades", F.when(F.col("grade").isNotNull(), F.col("rows")).otherwise(0))
    )
    by_grade = Window.partitionBy(owner).orderBy(F.asc_nulls_last("grade"))
    up_to = F.sum("grades").over(by_grade.rowsBetween(Window.unboundedPreceding, 0))
    of_all = F.sum("grades").over(Window.partitionBy(owner))
    ranked = counted.withColumn("upper_half", up_to * 2 >= of_all)
    stats = ranked.groupBy(owner, *attributes).agg(
        F.sum("rows").alias("submission_count"),
        rounded_ratio(F.sum(F.col("grade") * F.col("grades")), F.sum("grades"), 2).alias(
            "avg_grade"
        ),
        F.round(F.min(F.when(F.col("upper_half"), F.col("grade"))), 2).alias("median_grade"),
        rounded_ratio(
            F.sum(F.when(F.col("grade") == 0, F.col("rows")).otherwise(0)), F.sum("rows"), 3
        ).alias("zero_rate"),
        rounded_ratio(F.sum("late"), F.sum("rows"), 3).alias("late_rate"),
    )
    low_score = F.col("avg_grade") / F.col("max_score").cast("double") < HARD_SCORE
    hard = low_score & (F.col("late_rate") >= HARD_LATE_RATE)
    return stats.select(
        "course_id",
        "assignment_id",
        "title",
        "submission_count",
        "avg_grade",
        "median_grade",
        "zero_rate",
        "late_rate",
        F.coalesce(hard, F.lit(False)).alias("is_too_hard"),
    ).orderBy(
        F.desc("is_too_hard"),
        F.asc_nulls_last("avg_grade"),
        F.desc_nulls_last("late_rate"),
        F.asc_nulls_last("assignment_id"),
    )


def rubric_items(
    submissions: DataFrame, assignments: DataFrame, feedback: DataFrame
) -> DataFrame:
    """One row per evaluated criterion of every submission that has feedback."""
    owners = submissions.select("submission_id", "assignment_id").join(
        assignments.select("assignment_id", "course_id"), "assignment_id"
    )
    return unnest_rubric(feedback, "submission_id").join(owners, "submission_id").select(
        "course_id", "assignment_id", "submission_id", "criterion", "points", "max_points"
    )


def rubric_evaluation(items: DataFrame, top: int = 10) -> DataFrame:
    """Criteria with the highest share of weak scores. An item without max points has no score
    and is not weak."""
    score = safe_ratio("points", "max_points")
    return (
        items.groupBy("criterion")
        .agg(
            F.count("*").alias("evaluation_count"),
            rounded_avg("points", 2).alias("avg_points"),
            rounded_avg(score, 3).alias("avg_score_ratio"),
            rate(score < WEAK_SCORE).alias("weak_rate"),
        )
        .orderBy(F.desc("weak_rate"), F.asc_nulls_last("avg_points"), F.asc_nulls_last("criterion"))
        .limit(top)
    )


def file_sizes(manifest: DataFrame) -> DataFrame:
    """Files and mean file size per assignment."""
    return (
        manifest.groupBy("assignment_id")
        .agg(
            F.count("*").alias("file_count"),
            rounded_avg("size_kb", 2).alias("avg_file_size_kb"),
        )
        .orderBy(F.asc_nulls_last("assignment_id"))
    )


def largest_files(manifest: DataFrame, top: int = 10) -> DataFrame:
    return (
        manifest.select(
            "submission_id", "assignment_id", "file_name", "size_kb", "size_bytes", "object_path"
        )
        .orderBy(F.desc_nulls_last("size_kb"), F.asc_nulls_last("submission_id"))
        .limit(top)
    )


def missing_files(submissions: DataFrame, manifest: DataFrame) -> DataFrame:
    """Submissions without a file for the same submission and assignment.

    The manifest is reduced to distinct keys first: it hashes on the same two columns as the
    join, so this adds no exchange and turns many files of one submission into one row.
    """
    pair = ["submission_id", "assignment_id"]
    return (
        submissions.select(*pair, "student_id", "submitted_ts", "grade")
        .join(manifest.select(*pair).distinct(), pair, "left_anti")
        .orderBy(F.asc_nulls_last("assignment_id"), F.asc_nulls_last("submission_id"))
    )


def _grades_by_course(submissions: DataFrame, assignments: DataFrame) -> DataFrame:
    """Submissions meet the due dates as they are: a sum per assignment and day would hardly be
    fewer rows and would move all of them first. A busy assignment is split by adaptive execution."""
    grade = F.col("grade").cast("double")
    dated = submissions.select("assignment_id", "submitted_ts", "grade").join(
        assignments.select("assignment_id", "course_id", "due_dt"), "assignment_id"
    )
    late = F.count_if(is_late("submitted_ts", "due_dt"))
    return dated.groupBy("course_id").agg(
        rounded_ratio(F.sum(grade), F.count(grade), 2).alias("avg_grade"),
        rounded_ratio(late, F.count("*"), 3).alias("late_rate"),
    )


def _totals_by_course(totals: DataFrame, assignments: DataFrame, name: str) -> DataFrame:
    """Average per course from (assignment_id, total, items) rows."""
    return (
        totals.join(assignments.select("assignment_id", "course_id"), "assignment_id")
        .groupBy("course_id")
        .agg(rounded_ratio(F.sum("total"), F.sum("items"), 2).alias(name))
    )


def _file_size_by_course(manifest: DataFrame, assignments: DataFrame) -> DataFrame:
    size = F.col("size_kb").cast("double")
    totals = manifest.groupBy(F.col("assignment_id").cast("bigint").alias("assignment_id")).agg(
        F.sum(size).alias("total"), F.count(size).alias("items")
    )
    return _totals_by_course(totals, assignments, "avg_file_size_kb")


def _correctness_by_course(
    submissions: DataFrame, assignments: DataFrame, feedback: DataFrame, criterion: str
) -> DataFrame:
    # The points are added up inside the array: no row per item, and no comment is read.
    chosen = F.filter(
        F.arrays_zip(F.col("rubric.criterion").alias("criterion"), F.col("rubric.points").alias("points")),
        lambda item: (item["criterion"] == criterion) & item["points"].isNotNull(),
    )
    points = F.aggregate(
        chosen, F.lit(0.0), lambda total, item: total + item["points"].cast("double")
    )
    scores = (
        feedback.select("submission_id", points.alias("total"), F.size(chosen).alias("items"))
        .where(F.col("items") > 0)
        .groupBy("submission_id")
        .agg(F.sum("total").alias("total"), F.sum("items").alias("items"))
    )
    totals = (
        submissions.select("submission_id", "assignment_id")
        .join(scores, "submission_id")
        .groupBy("assignment_id")
        .agg(F.sum("total").alias("total"), F.sum("items").alias("items"))
    )
    return _totals_by_course(totals, assignments, "avg_correctness_points")


def course_quality(
    courses: DataFrame,
    assignments: DataFrame,
    submissions: DataFrame,
    manifest: DataFrame,
    feedback: DataFrame,
    criterion: str = "correctness",
) -> DataFrame:
    """One row per course with grade, lateness, file size and correctness; missing ones null.

    Files and scores are summed per assignment before they meet the assignments, so a busy
    assignment is a few rows there.
    """
    return (
        courses.select("course_id", "course_name")
        .join(_grades_by_course(submissions, assignments), "course_id", "left")
        .join(_file_size_by_course(manifest, assignments), "course_id", "left")
        .join(
            _correctness_by_course(submissions, assignments, feedback, criterion),
            "course_id",
            "left",
        )
        .select(
            "course_id",
            "course_name",
            "avg_grade",
            "late_rate",
            "avg_file_size_kb",
            "avg_correctness_points",
        )
        .orderBy(F.asc_nulls_last("course_id"))
    )
