"""Tables of several sources in one catalog, external tables and documents."""

import json

import pytest
from plans_text import plan_text

from millrace.plans.federated import COURSE_QUALITY
from millrace.registry import federation
from millrace.registry.common import Inputs
from millrace.sources.documents import read_documents_any_case
from millrace.sources.external_tables import (
    ExternalTable,
    columnar_table,
    csv_table,
    document_table,
    federated,
    literal,
    mount,
    quoted,
    unmount,
)


def write(path, *lines):
    path.mkdir(parents=True, exist_ok=True)
    (path / "part.txt").write_text("".join(line + "\n" for line in lines))
    return f"file:{path}"


@pytest.fixture
def sources(spark, tmp_path):
    """A relational, a delimited and a document source of one small course."""
    at = f"file:{tmp_path}"
    spark.createDataFrame([(1, "One"), (2, "Two")], "course_id bigint, course_name string").write.parquet(f"{at}/courses")
    spark.sql("SELECT 10L AS assignment_id, 1L AS course_id, DATE'2025-01-10' AS due_dt").write.parquet(f"{at}/assignments")
    spark.sql(
        "SELECT * FROM VALUES (100L, 10L, TIMESTAMP'2025-01-09 10:00:00', 8.0D), (101L, 10L, TIMESTAMP'2025-01-11 10:00:00', 5.0D) "
        "AS t(submission_id, assignment_id, submitted_ts, grade)"
    ).write.parquet(f"{at}/submissions")
    files = write(tmp_path / "files", "assignment_id,student_id,submission_id,file_path,size_kb", "10,7,100,a/b,30", "10,8,101,a/c,41")
    items = [{"criterion": "correctness", "points": 4, "comment": "x"}, {"criterion": "style", "points": 1}]
    feedback = write(
        tmp_path / "feedback",
        json.dumps({"submission_id": 100, "rubric": items, "overall": {"deep": ["a"]}}),
        json.dumps({"submission_id": 101, "rubric": []}),
        json.dumps({"submission_id": 999, "rubric": None}),
    )
    tables = [
        columnar_table("lms_t", "courses", f"{at}/courses"),
        columnar_table("lms_t", "assignments", f"{at}/assignments"),
        columnar_table("lms_t", "submissions", f"{at}/submissions"),
        csv_table("store_t", "files", files, federation.MANIFEST_TEXT),
        document_table("docs_t", "feedback", feedback, federation.FEEDBACK_NEEDED),
    ]
    yield tables
    unmount(spark, tables)


def test_one_text_joins_three_formats(spark, sources):
    rows = federated(spark, COURSE_QUALITY, mount(spark, sources)).collect()
    assert [tuple(r) for r in rows] == [(1, "One", 6.5, 0.5, 35.5, 4.0), (2, "Two", None, None, None, None)]


def test_every_source_reads_only_what_is_needed(spark, sources):
    plan = plan_text(federated(spark, COURSE_QUALITY, mount(spark, sources)))
    scans = {}
    for line in plan.splitlines():
        if "FileScan" in line:
            kind = line.split("FileScan ")[1].split()[0]
            scans.setdefault(kind, []).append(line)
    assert set(scans) == {"parquet", "csv", "json"}
    assert all("ReadSchema: struct<assignment_id:string,size_kb:string>" in line for line in scans["csv"])
    assert all("PushedFilters: [IsNotNull(assignment_id)]" in line for line in scans["csv"])
    assert all("struct<submission_id:bigint,rubric:array<struct<criterion:string,points:double>>>" in line for line in scans["json"])
    assert all("IsNotNull(submission_id)" in line for line in scans["json"])
    submissions = [line for line in scans["parquet"] if "submission_id" in line]
    assert any("IsNotNull(submission_id)" in line and "grade" not in line for line in submissions)
    # The key is cast on the side of the text; the join stays an equality on numbers.
    assert "cast(assignment_id" in plan and "CartesianProduct" not in plan and "NestedLoop" not in plan


def test_names_are_found_whatever_their_case(spark, sources):
    mount(spark, sources)
    assert spark.table("LMS_T.Courses").count() == 2
    assert spark.sql("SELECT Rubric[0].CRITERION AS c FROM Docs_T.FEEDBACK WHERE SUBMISSION_ID = 100").first()["c"] == "correctness"


def test_tables_are_dropped_and_created_over_the_same_files(spark, sources, tmp_path):
    mount(spark, sources)
    before = sorted(str(p) for p in tmp_path.rglob("*"))
    mount(spark, sources)  # again, in place of themselves
    assert spark.table("store_t.files").count() == 2
    unmount(spark, sources)
    assert not spark.catalog.databaseExists("store_t") and sorted(str(p) for p in tmp_path.rglob("*")) == before
    names = mount(spark, sources)
    assert spark.table(names["files"]).count() == 2
    with pytest.raises(Exception, match="TABLE_OR_VIEW_ALREADY_EXISTS"):
        sources[0].create(spark)


def test_a_database_with_other_tables_stays(spark, sources):
    mount(spark, sources)
    spark.sql("CREATE TABLE docs_t.own (a int) USING parquet")
    unmount(spark, sources)
    assert [t.name for t in spark.catalog.listTables("docs_t")] == ["own"]
    spark.sql("DROP TABLE docs_t.own")


def test_odd_names_and_texts(spark, tmp_path):
    path = write(tmp_path / "it's a folder", "a|b", "1|x'y")
    table = ExternalTable("odd_db", "a_table", "csv", path, "a INT, b STRING", {"header": "true", "sep": "|"})
    mount(spark, [table])
    assert [tuple(r) for r in table.read(spark).collect()] == [(1, "x'y")]
    unmount(spark, [table])
    assert quoted("a`b") == "`a``b`" and spark.sql(f"SELECT {literal(chr(39) + chr(92) + 'n')} AS t").first()["t"] == "'\\n"
    with pytest.raises(ValueError, match="different names"):
        mount(spark, [table, columnar_table("other", "A_TABLE", path)])


def test_rows_that_do_not_fit_the_schema_fail(spark, tmp_path):
    table = csv_table("bad_t", "numbers", write(tmp_path / "n", "a,b", "1,2", "x,3"), "a INT, b INT")
    mount(spark, [table])
    with pytest.raises(Exception, match="MALFORMED|malformed|Malformed"):
        table.read(spark).collect()
    unmount(spark, [table])


SCHEMA = "submissionid BIGINT, rubric ARRAY<STRUCT<criterion: STRING, points: DOUBLE>>, missing STRING"


def test_documents_of_one_spelling_read_only_the_wanted_fields(spark, tmp_path):
    path = write(
        tmp_path / "d",
        json.dumps({"SubmissionId": 1, "Rubric": [{"Criterion": "c", "Points": 2, "Comment": "z"}], "Big": {"x": 1}}),
        json.dumps({"SubmissionId": 2, "Rubric": [None, {"Criterion": None}], "Big": None}),
        json.dumps({"SubmissionId": 3}),
    )
    rows = read_documents_any_case(spark, path, SCHEMA)
    assert rows.columns == ["submissionid", "rubric", "missing"]
    assert [r.asDict(True) for r in rows.orderBy("submissionid").collect()] == [
        {"submissionid": 1, "rubric": [{"criterion": "c", "points": 2.0}], "missing": None},
        {"submissionid": 2, "rubric": [None, {"criterion": None, "points": None}], "missing": None},
        {"submissionid": 3, "rubric": None, "missing": None},
    ]
    assert "ReadSchema: struct<SubmissionId:bigint,Rubric:array<struct<Criterion:string,Points:double>>>" in plan_text(rows)
    assert "ReadSchema: struct<SubmissionId:bigint>" in plan_text(rows.select("submissionid"))
    assert "GreaterThan(SubmissionId,1)" in plan_text(rows.where("submissionid > 1"))


def test_documents_of_several_spellings(spark, tmp_path):
    path = write(
        tmp_path / "d",
        json.dumps({"submissionId": 1, "rubric": [{"criterion": "a", "Points": 1}, {"CRITERION": "b", "points": 2}]}),
        json.dumps({"SUBMISSIONID": 2, "Rubric": [{"Criterion": "c", "POINTS": 3}]}),
        json.dumps({"submissionid": 3, "SubmissionId": 30, "rubric": []}),
        "",
    )
    rows = read_documents_any_case(spark, path, SCHEMA).orderBy("submissionid").collect()
    assert [(r["submissionid"], [tuple(x) for x in r["rubric"]]) for r in rows] == [
        (1, [("a", 1.0), ("b", 2.0)]), (2, [("c", 3.0)]), (3, []),
    ]


def test_malformed_documents_fail(spark, tmp_path):
    for lines in (['{"a": 1}', "{broken"], ['{"a": 1}', '{"A": 2}', "{broken"]):
        path = write(tmp_path / str(len(lines)), *lines)
        with pytest.raises(Exception, match="MALFORMED|malformed|Malformed"):
            read_documents_any_case(spark, path, "a INT").collect()


def test_the_mart_reads_three_formats_of_the_tables(spark, small):
    plan = plan_text(federation.federated_mart(Inputs(spark, small)))
    assert {kind for kind in ("parquet", "csv", "json") if f"FileScan {kind}" in plan} == {"parquet", "csv", "json"}


def test_delivered_texts_are_compressed(spark, small):
    tables = federation.mounted_sources(Inputs(spark, small))
    for role in ("files", "feedback"):
        found = spark.table(tables[role]).inputFiles()
        assert found and all(name.endswith(".gz") for name in found)
