"""The two jobs end to end over files: publish a CSV, stream the messages."""

import pytest
from pyspark.sql import functions as F

from millrace import jobs
from millrace.sources.files import INPUT_ORDER, read_text_csv, with_input_order
from millrace.streaming.pipeline import FileSinks

HEADER = (
    '"fixed acidity";"volatile acidity";"citric acid";"residual sugar";"chlorides";'
    '"free sulfur dioxide";"total sulfur dioxide";"density";"pH";"sulphates";"alcohol";"quality"\n'
)
LINE = "7.4;0.7;0;1.9;0.076;11;34;0.9978;3.51;{sulphates};9.4;{quality}\n"


def wine(path, *rows):
    path.write_text(HEADER + "".join(LINE.format(sulphates=s, quality=q) for s, q in rows))


def test_publish_then_stream(spark, tmp_path):
    wine(tmp_path / "wine.csv", (0.56, 5), (0.9, 6), (1.56, 6), (0.8, 7))
    jobs.main(
        ["publish", "--csv", f"file:{tmp_path}/wine.csv", "--format", "json",
         "--path", f"file:{tmp_path}/topic", "--rounds", "2"]
    )
    messages = spark.read.json(f"file:{tmp_path}/topic")
    assert sorted(row["key"] for row in messages.collect()) == sorted(list("1234") * 2)
    first = messages.where("key = '1'").first()["value"]
    assert first.startswith('{"fixed_acidity":7.4,') and first.endswith('"quality":5}')
    jobs.main(
        ["stream", "--format", "json", "--path", f"file:{tmp_path}/topic",
         "--output", f"file:{tmp_path}/out", "--checkpoint", f"file:{tmp_path}/progress",
         "--available-now"]
    )
    out = FileSinks(f"file:{tmp_path}/out")
    grades = [row["quality"] for row in out.read(spark, "events").orderBy("quality").collect()]
    assert grades == [6, 6, 7, 7]
    assert out.read(spark, "anomalies").count() == 2


def test_input_order_spans_files(spark, tmp_path):
    folder = tmp_path / "files"
    folder.mkdir()
    (folder / "a.csv").write_text("n\n" + "".join(f"{i}\n" for i in range(5)))
    (folder / "b.csv").write_text("n\n" + "".join(f"{i}\n" for i in range(5, 500)))
    rows = with_input_order(read_text_csv(spark, f"file:{folder}")).orderBy(*INPUT_ORDER)
    assert [int(row["n"]) for row in rows.select(F.col("n")).collect()] == list(range(500))


def test_arguments_are_required():
    with pytest.raises(SystemExit):
        jobs.parser().parse_args(["stream", "--topic", "t"])
