"""Input schemas. Column names and types are fixed values: they must equal the source files."""

from __future__ import annotations

from pyspark.sql import types as T

# Hospital record files, one CSV with a header line each.
PATIENTS = (
    "id string, birthdate date, deathdate date, prefix string, first string, last string, "
    "suffix string, maiden string, marital string, race string, ethnicity string, gender string, "
    "birthplace string, address string, city string, state string, county string, zip string, "
    "lat double, lon double"
)
ORGANIZATIONS = (
    "id string, name string, address string, city string, state string, zip string, "
    "lat double, lon double"
)
PAYERS = (
    "id string, name string, address string, city string, state_headquartered string, "
    "zip string, phone string"
)
ENCOUNTERS = (
    "id string, start_ts timestamp, stop_ts timestamp, patient string, organization string, "
    "payer string, encounterclass string, code string, description string, "
    "base_encounter_cost double, total_claim_cost double, payer_coverage double, "
    "reasoncode string, reasondescription string"
)
PROCEDURES = (
    "start_ts timestamp, stop_ts timestamp, patient string, encounter string, code string, "
    "description string, base_cost double, reasoncode string, reasondescription string"
)
HOSPITAL = {
    "patients": PATIENTS,
    "organizations": ORGANIZATIONS,
    "payers": PAYERS,
    "encounters": ENCOUNTERS,
    "procedures": PROCEDURES,
}

# University files as delivered; plans.university_load maps them to the analytic tables.
UNIVERSITY = {
    "students": "student_id int, name string, group_name string, enrollment_year int",
    "teachers": "teacher_id int, name string, department string",
    "courses": "course_id int, title string, teacher_id int, semester string",
    "enrollments": "student_id int, course_id int, enrolled_dt date",
    "assignments": "assignment_id int, course_id int, due_dt date, max_score decimal(5,2)",
    "submissions": (
        "submission_id int, assignment_id int, student_id int, "
        "submitted_ts timestamp_ntz, score decimal(5,2)"
    ),
}

# Feedback file: the rubric column holds a JSON array inside a quoted CSV field.
FEEDBACK_CSV = [
    "_id",
    "submission_id",
    "teacher_id",
    "ts",
    "rubric",
    "overall_comment",
]
RUBRIC_JSON = "array<struct<criterion: string, points: double, comment: string>>"

# File manifest: every column is text and is typed later.

# One recorded measurement of a sequential and a parallel run.
MEASUREMENT = (
    "len_values bigint, k double, workers int, sequential_time double, parallel_time double, "
    "speedup double, efficiency double"
)

SEGMENT_COUNTS = "table_name string, segment_id int, row_count bigint"

# Message body of the wine stream, in message order.
WINE_MESSAGE = T.StructType(
    [
        T.StructField("fixed_acidity", T.DoubleType()),
        T.StructField("volatile_acidity", T.DoubleType()),
        T.StructField("citric_acid", T.DoubleType()),
        T.StructField("residual_sugar", T.DoubleType()),
        T.StructField("chlorides", T.DoubleType()),
        T.StructField("free_sulfur_dioxide", T.DoubleType()),
        T.StructField("total_sulfur_dioxide", T.DoubleType()),
        T.StructField("density", T.DoubleType()),
        T.StructField("pH", T.DoubleType()),
        T.StructField("sulphates", T.DoubleType()),
        T.StructField("alcohol", T.DoubleType()),
        T.StructField("quality", T.IntegerType()),
    ]
)

# CSV header names of the wine file and the message fields they become.
WINE_FIELDS = {
    "fixed acidity": "fixed_acidity",
    "volatile acidity": "volatile_acidity",
    "citric acid": "citric_acid",
    "residual sugar": "residual_sugar",
    "chlorides": "chlorides",
    "free sulfur dioxide": "free_sulfur_dioxide",
    "total sulfur dioxide": "total_sulfur_dioxide",
    "density": "density",
    "pH": "pH",
    "sulphates": "sulphates",
    "alcohol": "alcohol",
    "quality": "quality",
}
