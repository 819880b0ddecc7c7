"""Landmark geometry against NumPy, image jobs against brute force."""

import math
import random

import numpy as np
from pyspark.sql import functions as F

from tabulark.functions import landmarks as L
from tabulark.operators import image_jobs, landmark_jobs, lookups
from tabulark.plans.fixtures import bitmap
from tabulark.sources import images

POINTS = "id long, hand string, points array<struct<x: double, y: double, z: double>>"


def numpy_features(points, hand):
    p = np.array(points, dtype=np.float64)
    p = p - p[0]
    if hand and hand.lower().startswith("left"):
        p[:, 0] *= -1
    knuckle = p[9, :2]
    if np.hypot(*knuckle) > 1e-6:
        angle = -math.pi / 2 - math.atan2(knuckle[1], knuckle[0])
        turn = np.array([[math.cos(angle), -math.sin(angle)], [math.sin(angle), math.cos(angle)]])
        p[:, :2] = p[:, :2] @ turn.T
    reach = np.hypot(p[:, 0], p[:, 1]).max()
    return (p / reach if reach > 0 else p).ravel()


def hands(n, seed=0):
    rng = np.random.default_rng(seed)
    return rng.uniform(0, 1, (n, 21, 3))


def normalized(spark, rows):
    df = spark.createDataFrame([(i, h, [tuple(map(float, q)) for q in p]) for i, h, p in rows], POINTS)
    out = df.select("id", L.landmark_normalize(F.col("points"), F.col("hand")).alias("f")).collect()
    return {r["id"]: np.array(r["f"]) for r in out}


def test_normalize_matches_numpy_and_is_pose_free(spark):
    raw = hands(20)
    odd = raw[0].copy()
    odd[9] = odd[0]
    flat = np.zeros((21, 3))
    turn = 0.7
    spin = np.array([[math.cos(turn), -math.sin(turn), 0], [math.sin(turn), math.cos(turn), 0], [0, 0, 1]])
    rows = [(i, ["Left", "Right", None, "LEFTish"][i % 4], p) for i, p in enumerate(raw)]
    rows += [(100, "Right", odd), (101, "Right", flat)]
    base = raw[1]
    rows += [
        (200, "Right", base), (201, "Right", base + [3, -2, 1]), (202, "Right", base * 4.0),
        (203, "Right", base @ spin.T), (204, "Left", base * [-1, 1, 1]),
    ]
    got = normalized(spark, rows)
    for i, hand, p in rows:
        assert np.allclose(got[i], numpy_features(p, hand), atol=1e-9), i
    f = got[200].reshape(21, 3)
    assert np.allclose(f[0], 0) and abs(f[9, 0]) < 1e-9 and f[9, 1] < 0
    assert math.isclose(np.hypot(f[:, 0], f[:, 1]).max(), 1.0)
    for i in (201, 202, 203, 204):
        assert np.allclose(got[i], got[200], atol=1e-9)


def test_boxes(spark):
    df = spark.createDataFrame(
        [(1, [(0.1, 0.2, 0.0), (0.5, 0.9, 0.0)]), (2, [(0.5, 0.5, 0.0), (0.5, 0.5, 0.0)]),
         (3, [(0.0, 0.0, 0.0), (1.0, 1.0, 0.0)])],
        "id int, points array<struct<x: double, y: double, z: double>>")
    box = L.hand_bbox(F.col("points"), F.lit(640), F.lit(480))
    out = df.select("id", box.alias("b")).withColumn("s", L.square_box(F.col("b"), F.lit(640), F.lit(480)))
    got = {r["id"]: r for r in out.collect()}
    assert tuple(got[1]["b"]) == (12, 28, 371, 480)
    assert got[2]["b"] is None and got[2]["s"] is None
    assert tuple(got[3]["b"]) == (0, 0, 640, 480)
    assert tuple(got[3]["s"]) == (0, -80, 640, 560, 80, 80, 0, 0)


def test_augment(spark):
    rows = [(i, "Right", [tuple(map(float, q)) for q in p]) for i, p in enumerate(hands(40))]
    df = spark.createDataFrame(rows, POINTS)
    flat = F.flatten(F.transform("points", lambda p: F.array(p["x"], p["y"], p["z"])))
    one = landmark_jobs.landmark_augment(df, "id", "points").select("id", "copy", flat.alias("v")).collect()
    two = landmark_jobs.landmark_augment(df.repartition(7), "id", "points").select("id", "copy", flat.alias("v"))
    assert len(one) == 200
    first = {(r["id"], r["copy"]): r["v"] for r in one}
    assert first == {(r["id"], r["copy"]): r["v"] for r in two.collect()}
    noise = np.array([np.subtract(first[(i, c)], first[(i, 0)]) for i in range(40) for c in range(1, 5)])
    assert abs(noise.mean()) < 5e-4 and abs(noise.std() - 0.008) < 5e-4
    assert abs(np.corrcoef(noise[:, 0], noise[:, 1])[0, 1]) < 0.3


def test_training_table_keeps_test_hands_out(spark):
    rows = [(i, "Right", [tuple(map(float, q)) for q in p]) for i, p in enumerate(hands(60))]
    df = spark.createDataFrame(rows, POINTS).withColumn("letter", F.when(F.col("id") % 2 == 0, "A").otherwise("B"))
    out = landmark_jobs.landmark_training_table(df, "id", "points", "letter", "hand").select("id", "split", "copy").collect()
    train = {r["id"] for r in out if r["split"] == "train"}
    test = {r["id"] for r in out if r["split"] == "test"}
    assert not train & test and len(test) == 9
    assert len(out) == 9 + 51 * 5


def brute_resize(gray, side):
    n = gray.shape[0]
    out = np.zeros((side, side))
    for i in range(side):
        for j in range(side):
            total = area = 0.0
            for y in range(n):
                for x in range(n):
                    h = max(0, min((i + 1) * n / side, y + 1) - max(i * n / side, y))
                    w = max(0, min((j + 1) * n / side, x + 1) - max(j * n / side, x))
                    total, area = total + gray[y, x] * h * w, area + h * w
            out[i, j] = total / area
    return np.floor(out + 0.5) / 255


def test_crop_resize(spark):
    rng = np.random.default_rng(1)
    pixels = rng.integers(0, 256, (9, 11, 3), dtype=np.uint8)
    df = spark.createDataFrame(
        [(1, 9, 11, 3, pixels.tobytes(), (-2, -1, 8, 9)), (2, 9, 11, 3, pixels.tobytes(), (4, 2, 11, 9))],
        "id int, height int, width int, nChannels int, data binary, box struct<x1:int,y1:int,x2:int,y2:int>")
    got = {r["id"]: np.array(r["pixels"]) for r in image_jobs.image_crop_resize(df, ["id"], 4).collect()}
    for i, (x1, y1, x2, y2) in ((1, (-2, -1, 8, 9)), (2, (4, 2, 11, 9))):
        cut = np.array([[pixels[min(max(y, 0), 8), min(max(x, 0), 10)] for x in range(x1, x2)] for y in range(y1, y2)])
        gray = np.floor(cut @ [0.114, 0.587, 0.299] + 0.5)
        assert np.allclose(got[i].reshape(4, 4), brute_resize(gray, 4), atol=1e-6)
    flipped = image_jobs.image_crop_resize(df.where("id = 2"), ["id"], 4, flip=True).first()["pixels"]
    mirrored = df.where("id = 2").collect()[0]
    again = image_jobs.crop_to_gray(pixels[:, ::-1], mirrored["box"], 4, False, None)
    assert np.allclose(flipped, again.ravel())


def test_warp(spark):
    rng = np.random.default_rng(2)
    stack = rng.uniform(0, 255, (3, 8, 8))
    zero, one = np.zeros(3), np.ones(3)
    assert np.allclose(image_jobs.warp(stack, zero, zero, zero, one), stack)
    moved = image_jobs.warp(stack, zero, zero + 1 / 8, zero, one)
    assert np.allclose(moved[:, :, 1:], stack[:, :, :-1]) and np.allclose(moved[:, :, 0], 0)
    quarter = image_jobs.warp(stack, zero + math.pi / 2, zero, zero, one)
    assert np.allclose(quarter, np.rot90(stack, -1, axes=(1, 2)))
    df = spark.createDataFrame([(i, s.ravel().tolist()) for i, s in enumerate(stack)], "id int, pixels array<double>")
    a = image_jobs.image_augment(df, "id", "pixels", ["id"], side=8, copies=3, seed=1)
    b = image_jobs.image_augment(df.repartition(3), "id", "pixels", ["id"], side=8, copies=3, seed=1)
    key = lambda r: (r["id"], r["copy"])
    assert sorted(a.collect(), key=key) == sorted(b.collect(), key=key) and a.count() == 9


def test_image_folders(spark, tmp_path):
    good = bitmap(np.arange(16).reshape(4, 4))
    layout = {
        "a/x2.JPG": good, "a/x1.png": good, "a/x3.jpeg": b"junk", "a/notes.txt": b"text", "b/y.bmp": good,
        "bb/z.jpg": good, "1/w.jpg": good, "top.jpg": good, "a/deep/c/v.jpg": good,
    }
    for name, data in layout.items():
        path = tmp_path / name
        path.parent.mkdir(parents=True, exist_ok=True)
        path.write_bytes(data)
    got = images.image_tree_scan(spark, str(tmp_path)).collect()
    assert sorted((r["letter"], r["file"]) for r in got) == [
        ("A", "x1.png"), ("A", "x2.JPG"), ("A", "x3.jpeg"), ("B", "y.bmp")]
    capped = images.image_tree_scan(spark, "file://" + str(tmp_path), 2).collect()
    assert sorted(r["file"] for r in capped) == ["x1.png", "x2.JPG", "y.bmp"]
    decoded = {r["path"].rsplit("/", 1)[1]: r for r in images.image_decode(spark, str(tmp_path / "a")).collect()}
    assert "x3.jpeg" not in decoded and "notes.txt" not in decoded
    first = decoded["x1.png"]
    assert (first["height"], first["width"], first["nChannels"]) == (4, 4, 3)
    assert np.frombuffer(first["data"], np.uint8).reshape(4, 4, 3)[..., 0].tolist() == np.arange(16).reshape(4, 4).tolist()
    found = images.asset_lookup_scan(spark, str(tmp_path)).collect()
    assert [r["letter"] for r in found] == ["TOP"]
    import base64
    assert base64.b64decode(found[0]["content"]) == good


def test_messages_and_words(spark):
    messages = spark.createDataFrame([(1, "Hi J!"), (2, ""), (3, "é 1")], "id int, text string")
    assets = spark.createDataFrame([(c, c.lower()) for c in "HI"], "letter string, img string")
    out = lookups.text_to_sign_join(messages, "text", assets, ["id"], "img").orderBy("id", "pos").collect()
    assert [(r["id"], r["ch"], r["kind"], r["img"]) for r in out] == [
        (1, "H", "image", "h"), (1, "i", "image", "i"), (1, " ", "space", None), (1, "J", "motion", None),
        (1, "!", "other", None), (3, "é", "motion", None), (3, " ", "space", None), (3, "1", "other", None)]
    rng = random.Random(1)
    samples = spark.createDataFrame(
        [(i, i % 3, "ABC"[i % 3] if rng.random() < 0.8 else "?") for i in range(60)], "sid int, label int, got string")
    words = spark.createDataFrame([(1, "cab"), (2, "AAAAAA"), (3, "ad")], "wid int, word string")
    read = {r["wid"]: r for r in lookups.word_readback(words, samples, "wid", "word", "label", "sid", "got").collect()}
    assert read[1]["word"] == "CAB" and len(read[1]["recognized"]) == 3 and read[3]["recognized"][1] == "?"
    for r in read.values():
        assert r["is_match"] == (r["recognized"] == r["word"])
        assert r["right_letters"] == sum(a == b for a, b in zip(r["recognized"], r["word"]))
