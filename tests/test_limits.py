"""No cap on labels, classes or categories; missing values of every kind."""

import math
import subprocess
import sys

import numpy as np
import pytest
from pyspark.sql import functions as F

from tabulark.operators import committer, evaluation, image_jobs, lookups, preprocess, profile, sampling
from tabulark.operators.quantiles import exact_percentiles
from tabulark.sources import tables

NAN = float("nan")


def test_many_labels(spark):
    df = spark.range(1001).selectExpr("CAST(id AS INT) a", "CAST((id * 7) % 1001 AS INT) p")
    grid = evaluation.confusion_matrix(df, "a", "p")
    assert grid.count() == 1001**2 and grid.agg(F.sum("count")).first()[0] == 1001
    assert evaluation.classification_report(df, "a", "p", labels=list(range(1001))).count() == 1004


def test_many_classes(spark):
    df = spark.range(30_003).selectExpr("id", "id % 10001 AS label")
    folds = sampling.stratified_kfold(df, "label", "id", k=3)
    sizes = folds.groupBy("label").agg(F.countDistinct("fold").alias("n"))
    assert sizes.where("n = 3").count() == 10_001
    split = sampling.stratified_split(df, "label", "id", fraction=0.4)
    assert split.where("split = 'test'").count() == math.ceil(0.4 * 30_003)


def test_many_categories(spark):
    df = spark.range(100_001).selectExpr("CAST(id AS STRING) c")
    found = preprocess.fit_vocab(df, ["c"])
    assert found.count() == 100_001 and found.agg(F.max("place")).first()[0] == 100_000


def test_percentiles_agree_to_the_last_bit(spark):
    draw = np.random.default_rng(3)
    df = spark.createDataFrame([(float(x),) for x in draw.lognormal(size=4000)], "x double")
    wanted = [i / 97 for i in range(98)]
    assert exact_percentiles(df, ["x"], wanted) == exact_percentiles(df, ["x"], wanted, gather=50)


def test_nan_is_missing(spark):
    df = spark.createDataFrame(
        [(0.0, 1.0, [1.0, NAN]), (NAN, NAN, [NAN, 3.0]), (1.0, 0.0, [300.0, None]), (None, None, None)],
        "g double, y double, p array<double>",
    )
    assert profile.target_rate(df, "y").first()[0] == 0.5
    assert profile.distinct_count(df, "g").first()[0] == 2
    assert {r.value for r in profile.group_rate(df, ["g"], "y").collect()} == {"0.0", "1.0"}
    assert tuple(profile.range_check(df, "g", "p").first()) == (0.0, 1.0, 1.0, 300.0)
    assert profile.bad_label_count(df, "g", 1).first()[0] == 1
    assert profile.bad_pixel_rows(df, "p").first()[0] == 1
    assert tuple(profile.class_balance(df, "g").first()) == (1, 1, 1.0)
    moments = profile.pixel_moments(df, "p").first()
    assert math.isclose(moments["mean"], 304 / 3)
    image = {r.g: r.mean_image for r in profile.class_mean_image(df.where("NOT isnan(g)"), "g", "p").collect()}
    assert image == {0.0: [1.0, None], 1.0: [300.0, None]}


def test_unscored_rows_count_nowhere(spark):
    df = spark.createDataFrame([(0, 0), (1, 1), (1, None), (None, 0)], "a int, p int")
    report = {r["class"]: r for r in evaluation.classification_report(df, "a", "p").collect()}
    assert set(report) == {"0", "1", "accuracy", "macro avg", "weighted avg"}
    assert report["macro avg"].f1 == 1.0 and report["accuracy"].support == 2
    assert evaluation.confusion_matrix(df, "a", "p").count() == 4
    assert evaluation.binary_metrics(df, "a", "p").first()["accuracy"] == 1.0


FRAMES = "sid long, ts timestamp, seq long, letter string, conf double"


def frames(spark, sid, letters, conf=0.9):
    import datetime as dt

    start = dt.datetime(2024, 1, 1)
    return spark.createDataFrame(
        [(sid, start + dt.timedelta(seconds=i), i, c, conf) for i, c in enumerate(letters)], FRAMES
    )


@pytest.mark.parametrize("sid", [1, None])
def test_null_sessions_keep_their_rows(spark, sid):
    rows = frames(spark, sid, "AAAABBBB")
    commits = committer.letter_commit(rows, stable_frames=4)
    assert [r.letter for r in commits.orderBy("ts").collect()] == ["A", "B"]
    text = committer.text_fold(committer.text_items(commits)).collect()
    assert [(r.sid, r.text) for r in text] == [(sid, "AB")]
    assert committer.monotonic_ts(rows.withColumn("ms", F.lit(5)), "ms", chunk_rows=3).count() == 8


def test_nan_confidence_is_accepted_in_batch_and_stream(spark, tmp_path):
    from tabulark.session import scratch_path
    from tabulark.streaming.committer import CommitterSettings, commit_stream

    rows = frames(spark, 1, "AAAA", NAN)
    assert committer.letter_commit(rows, stable_frames=4).count() == 1
    rows.write.parquet(str(tmp_path / "in"))
    arriving = spark.readStream.schema(rows.schema).parquet(str(tmp_path / "in"))
    out = commit_stream(arriving, CommitterSettings(stable_frames=4))
    query = (
        out.writeStream.format("parquet").outputMode("append").trigger(availableNow=True)
        .option("path", str(tmp_path / "out")).option("checkpointLocation", scratch_path(spark, "state"))
        .start()
    )
    query.awaitTermination(120)
    assert spark.read.parquet(str(tmp_path / "out")).count() == 1


def test_no_box_no_pixels(spark):
    box = "struct<x1: int, y1: int, x2: int, y2: int>"
    df = spark.createDataFrame(
        [(1, 2, 2, 1, bytearray([0, 255, 255, 0]), (0, 0, 2, 2)), (2, 2, 2, 1, bytearray([9] * 4), None),
         (3, None, None, None, None, (0, 0, 2, 2))],
        f"id int, height int, width int, nChannels int, data binary, box {box}",
    )
    got = {r.id: r.pixels for r in image_jobs.image_crop_resize(df, ["id"], side=2).collect()}
    assert got == {1: [0.0, 1.0, 1.0, 0.0], 2: None, 3: None}


def test_csv_line_breaks_tokens_and_types(spark, tmp_path):
    path = tmp_path / "t.csv"
    path.write_text('id,name,age\n1,"two\nlines, ""q""",NA\n2,nan,3.5\n3,NULL,\n')
    rows = tables.csv_scan(spark, str(path), "id INT, name STRING, age DOUBLE")
    assert [tuple(r) for r in rows.orderBy("id").collect()] == [
        (1, 'two\nlines, "q"', None), (2, None, 3.5), (3, None, None)
    ]
    path.write_text("id,name,age\n1,x,abc\n")
    with pytest.raises(Exception, match="age cannot be abc"):
        tables.csv_scan(spark, str(path), "id INT, name STRING, age DOUBLE").collect()


def test_payload_does_not_depend_on_partitions(spark):
    assets = spark.createDataFrame([("A", "z"), ("A", "b"), ("B", "q")], "letter string, image string")
    words = spark.createDataFrame([(1, "aB?")], "id int, text string")
    for n in (1, 5):
        out = lookups.text_to_sign_join(words, "text", assets.repartition(n), ["id"], "image")
        assert [r.image for r in out.orderBy("pos").collect()] == ["b", "q", None]


def test_package_reaches_workers_from_another_folder(tmp_path):
    code = (
        "import sys; sys.path.insert(0, ROOT)\n"
        "import __spark_entry__ as e\n"
        "from tabulark.session import local_session\n"
        "spark = local_session('2', 'elsewhere')\n"
        "print('ROWS', e.queries()['image_crop_resize'](spark, SF).count())\n"
    )
    root = str(__import__("pathlib").Path(__file__).resolve().parents[1])
    text = code.replace("ROOT", repr(root)).replace("SF", repr("/root/testdata/sf0.001"))
    import os

    env = {k: v for k, v in os.environ.items() if k != "PYTHONPATH"}
    done = subprocess.run([sys.executable, "-c", text], cwd=tmp_path, env=env, capture_output=True, text=True, timeout=300)
    assert "ROWS" in done.stdout, done.stderr[-2000:]
