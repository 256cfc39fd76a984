"""Collections that change as a whole, and the all-or-nothing load of the six files."""

import threading

import pytest

from millrace.plans.university_load import LOADERS, replace_university
from millrace.sinks.versions import Collection, LoadRejected, read_collection, replace_all, replace_collection
from millrace.sources.folders import child_names

FILES = {
    "students": ["student_id,name,group_name,enrollment_year", "1,Ann,G1,2024", "2,Bob,G2,2023"],
    "teachers": ["teacher_id,name,department", "7,Cy,Maths"],
    "courses": ["course_id,title,teacher_id,semester", "5,Algebra,7,2025-Fall"],
    "enrollments": ["student_id,course_id,enrolled_dt", "2,5,2025-01-01", "1,5,2025-01-02"],
    "assignments": ["assignment_id,course_id,due_dt,max_score", "9,5,2025-02-01,10.00"],
    "submissions": ["submission_id,assignment_id,student_id,submitted_ts,score", "3,9,1,2025-01-30T10:00:00,8.50"],
}


def deliver(folder, **more):
    """The six files, with further lines for those named."""
    folder.mkdir(parents=True, exist_ok=True)
    for name, lines in FILES.items():
        (folder / f"{name}.csv").write_text("".join(x + "\n" for x in [*lines, *more.get(name, [])]))
    return f"file:{folder}"


def shown(spark, root):
    tables = Collection(spark, root)
    return {name: sorted(map(str, tables.table(name).collect())) for name in LOADERS}


def versions(spark, root):
    return child_names(spark, f"{root}/versions")


def test_all_six_files_are_shown_at_once(spark, tmp_path):
    root = f"file:{tmp_path}/tables"
    version = replace_university(spark, deliver(tmp_path / "in"), root)
    assert Collection(spark, root).current() == version and versions(spark, root) == [version]
    tables = Collection(spark, root)
    assert [tuple(r)[:3] for r in tables.table("enrollments").orderBy("enrollment_id").collect()] == [(1, 5, 1), (2, 5, 2)]
    assert tables.table("students").where("student_id = 1").first()["email"] == "student1@example.edu"


@pytest.mark.parametrize(
    "name,line,reason",
    [
        ("students", "x,Ann,G1,2024", "malformed|MALFORMED|Malformed"),
        ("students", "1,Other,G1,2024", "students unique student_id"),
        ("students", "3,\\N,G1,2024", "students without nulls"),
        ("teachers", "7,Dan,Arts", "teachers unique"),
        ("courses", "6,Arts,99,2025-Fall", "courses.teacher_id in teachers"),
        ("enrollments", "1,5,2025-03-03", "enrollments unique course_id, student_id"),
        ("enrollments", "1,44,2025-03-03", "enrollments.course_id in courses"),
        ("assignments", "10,5,2025-02-30,10.00", "malformed|MALFORMED|Malformed"),
        ("assignments", "10,5,\\N,10.00", "assignments without nulls"),
        ("submissions", "4,9,1,2025-01-30T10:00:00,8.50", "submissions unique assignment_id, student_id"),
        ("submissions", "4,9,2,2025-01-30T10:00:00,-1.00", "grade not negative"),
        ("submissions", "4,9,77,2025-01-30T10:00:00,1.00", "submissions.student_id in students"),
        ("submissions", "4,9", "malformed|MALFORMED|Malformed"),
    ],
)
def test_one_bad_row_leaves_all_tables_as_they_were(spark, tmp_path, name, line, reason):
    root = f"file:{tmp_path}/tables"
    version = replace_university(spark, deliver(tmp_path / "good"), root)
    before = shown(spark, root)
    # The bad delivery differs in every file, so that a table that changed would show.
    more = {"students": ["8,New,G1,2024"], "teachers": ["8,New,Maths"], "courses": ["8,New,8,2025-Fall"],
            "enrollments": ["8,8,2025-01-01"], "assignments": ["8,8,2025-01-01,1.00"],
            "submissions": ["8,8,8,2025-01-01T00:00:00,1.00"]}
    more[name] = [*more[name], line]
    with pytest.raises(Exception, match=reason):
        replace_university(spark, deliver(tmp_path / "bad", **more), root)
    assert Collection(spark, root).current() == version and shown(spark, root) == before
    assert versions(spark, root) == [version]
    more[name].remove(line)
    replace_university(spark, deliver(tmp_path / "mended", **more), root)
    assert all(len(rows) > len(before[table]) for table, rows in shown(spark, root).items())


def test_all_broken_rules_are_reported(spark, tmp_path):
    bad = deliver(tmp_path / "bad", courses=["6,Arts,99,2025-Fall"], submissions=["4,9,2,2025-01-30T10:00:00,-1.00"])
    with pytest.raises(LoadRejected) as error:
        replace_university(spark, bad, f"file:{tmp_path}/tables")
    assert [r.split(":")[0] for r in error.value.reasons] == ["courses.teacher_id in teachers", "grade not negative"]
    with pytest.raises(FileNotFoundError):
        Collection(spark, f"file:{tmp_path}/tables").table("courses")


def test_replaced_collection_refuses_duplicates(spark, tmp_path):
    root = f"file:{tmp_path}/docs"
    replace_collection(spark.range(3), root, ["id"])
    replace_collection(spark.range(2), root, ["id"])
    with pytest.raises(LoadRejected, match="unique id"):
        replace_collection(spark.range(3).union(spark.range(1)), root, ["id"])
    assert read_collection(spark, root).count() == 2


def test_a_write_that_breaks_off_keeps_the_old_rows(spark, tmp_path):
    root = f"file:{tmp_path}/docs"
    replace_collection(spark.range(3), root, ["id"])
    broken = spark.range(100).selectExpr("IF(id = 99, raise_error('lost'), id) AS id")
    with pytest.raises(Exception, match="lost"):
        replace_collection(broken, root, ["id"])
    assert read_collection(spark, root).count() == 3 and len(versions(spark, root)) == 1
    # A collection may be replaced by what is read from itself.
    replace_collection(read_collection(spark, root).where("id > 0"), root, ["id"])
    assert read_collection(spark, root).count() == 2


def test_readers_keep_to_their_version_and_old_ones_go(spark, tmp_path):
    root = f"file:{tmp_path}/docs"
    for n in range(1, 5):
        replace_collection(spark.range(n), root, ["id"], keep=1)
        if n == 3:
            reader = read_collection(spark, root)
    assert reader.count() == 3 and read_collection(spark, root).count() == 4
    collection = Collection(spark, root)
    assert len(collection.history()) == 2 and sorted(collection.history()) == versions(spark, root)
    collection.show(collection.history()[1])
    assert read_collection(spark, root).count() == 3
    with pytest.raises(ValueError, match="keeps no version"):
        collection.show("other")
    replace_collection(spark.range(9), root, ["id"], keep=0)
    assert versions(spark, root) == [collection.current()] and read_collection(spark, root).count() == 9


def test_readers_never_see_a_mixture(spark, tmp_path):
    """Two tables that always agree, read while they are replaced again and again."""
    root = f"file:{tmp_path}/pair"

    def replace(n):
        rows = spark.range(1).selectExpr(f"{n} AS n")
        replace_all(Collection(spark, root), {"a": rows, "b": rows}, {}, keep=50)

    replace(0)
    stop = threading.Event()
    wrong = []

    def read():
        while not stop.is_set():
            try:
                version = Collection(spark, root).current()
                a, b = (spark.read.parquet(f"{root}/versions/{version}/{t}").first()["n"] for t in "ab")
            except Exception as error:
                wrong.append(error)
                return
            if a != b:
                wrong.append((a, b))

    reader = threading.Thread(target=read)
    reader.start()
    for n in range(1, 8):
        replace(n)
    stop.set()
    reader.join()
    assert not wrong and Collection(spark, root).table("a").first()["n"] == 7
