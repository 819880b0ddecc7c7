"""Views over the shared tables that stand in for passengers, frames, images, hands.

Each view is stated once for Spark and, where the dialects part, once for the
SQL check. Every view covers all rows of its table.
"""

from __future__ import annotations

import re
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, SparkSession

SIDE = 8
PIXELS = SIDE * SIDE
CLASSES = 10


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


PASSENGERS = """
SELECT c_custkey AS PassengerId,
 CASE WHEN c_custkey % 7 < CASE WHEN c_custkey % 2 = 1 THEN 5 ELSE 1 END
      THEN 1 ELSE 0 END AS Survived,
 c_nationkey % 3 + 1 AS Pclass,
 concat(c_name, CASE c_custkey % 9
   WHEN 0 THEN ', Mr. A' WHEN 1 THEN ', Mrs. B (C)' WHEN 2 THEN ', Miss. D'
   WHEN 3 THEN ', Master. E' WHEN 4 THEN ', Dr. F' WHEN 5 THEN ', Mlle. G'
   WHEN 6 THEN ', Mme. H' WHEN 7 THEN ', the Countess. I'
   ELSE ' no title' END) AS Name,
 CASE WHEN c_custkey % 2 = 1 THEN 'female' ELSE 'male' END AS Sex,
 CASE WHEN c_custkey % 5 = 0 THEN NULL
      ELSE CAST(c_custkey % 79 + 1 AS DOUBLE) END AS Age,
 CASE WHEN c_custkey % 11 = 0 THEN NULL ELSE CAST(c_custkey % 4 AS DOUBLE) END AS SibSp,
 c_custkey % 3 AS Parch,
 CASE WHEN c_custkey % 97 = 0 THEN NULL ELSE abs(c_acctbal) / 20 END AS Fare,
 CASE WHEN c_custkey % 4 = 0
      THEN concat(chr(CAST(65 + c_custkey % 7 AS INT)), '12')
      ELSE NULL END AS Cabin,
 CASE WHEN c_custkey % 101 = 0 THEN NULL
      WHEN c_mktsegment IN ('BUILDING','MACHINERY') THEN 'C'
      WHEN c_mktsegment = 'HOUSEHOLD' THEN 'Q' ELSE 'S' END AS Embarked
FROM {customer}
"""

FRAMES = """
SELECT user_id AS sid, event_id AS seq, ts,
 CASE WHEN event_type = 'error' THEN NULL ELSE upper(substr(event_type, 1, 1)) END AS letter,
 least(1.0, value / 100) AS conf
FROM {events}
"""

# Views of events also hold manual edits: every fiftieth event that is a view.
SESSIONS = """
SELECT user_id AS sid, event_id AS seq, ts,
 CASE WHEN event_type = 'error' OR event_type = 'view' AND event_id % 50 = 0
      THEN NULL ELSE upper(substr(event_type, 1, 1)) END AS letter,
 least(1.0, value / 100) AS conf,
 CASE WHEN event_type = 'view' AND event_id % 50 = 0
      THEN CASE event_id / 50 % 5 WHEN 0 THEN 'space' WHEN 1 THEN 'backspace'
           WHEN 2 THEN 'clear' WHEN 3 THEN 'char' ELSE 'set_text' END END AS action,
 CASE WHEN event_type = 'view' AND event_id % 50 = 0
      THEN CASE event_id / 50 % 5 WHEN 3 THEN '!' WHEN 4 THEN 'ok' END END AS ch
FROM {events}
""".replace("event_id / 50 % 5", "CAST(floor(event_id / 50) AS BIGINT) % 5")

REQUESTS = """
SELECT c_custkey AS id,
 CASE WHEN c_custkey % 13 = 0 THEN concat('{"Age": ', c_custkey)
      WHEN c_custkey % 17 = 0 THEN '[]' WHEN c_custkey % 19 = 0 THEN '[1]'
 ELSE concat('{"Sex": "', CASE WHEN c_custkey % 2 = 1 THEN 'female' ELSE 'male' END, '"',
  CASE WHEN c_custkey % 23 = 0 THEN ', "Pclass": ""' WHEN c_custkey % 5 = 0 THEN ', "Pclass": "2"'
   WHEN c_custkey % 5 = 1 THEN ', "Pclass": 1' WHEN c_custkey % 5 = 2 THEN ', "Pclass": 2.0'
   ELSE '' END,
  CASE c_custkey % 6 WHEN 0 THEN ', "Age": 0' WHEN 1 THEN ', "Age": "0"'
   WHEN 2 THEN concat(', "Age": "', c_custkey % 79, '"') WHEN 3 THEN ', "Age": ""'
   WHEN 4 THEN concat(', "Age": ', c_custkey % 79, '.5') ELSE '' END,
  CASE WHEN c_custkey % 29 = 0 THEN ', "Fare": "abc"'
   WHEN c_custkey % 3 = 0 THEN concat(', "Fare": ', c_custkey % 300) ELSE '' END,
  CASE c_custkey % 4 WHEN 0 THEN concat(', "SibSp": ', c_custkey % 9)
   WHEN 1 THEN ', "Parch": "2"' WHEN 2 THEN ', "SibSp": null' ELSE '' END,
  CASE c_custkey % 8 WHEN 0 THEN ', "Deck": "C"' WHEN 1 THEN ', "Deck": "Unknown"' ELSE '' END,
  CASE c_custkey % 10 WHEN 0 THEN ', "Title": "Mrs"' WHEN 1 THEN ', "Title": ""' ELSE '' END,
  CASE c_custkey % 7 WHEN 0 THEN ', "Embarked": "C"' ELSE '' END, '}') END AS body
FROM {customer}
"""

MESSAGES = "SELECT conv_id, turn, text FROM {conversations}"

PREDICTIONS = "SELECT doc_id, quality AS actual, 1 - toxic AS predicted FROM {labels}"

PREDICTIONS_MULTI = """
SELECT vec_id, label AS actual,
 (label + CASE WHEN vec_id % 5 = 0 THEN 1 ELSE 0 END) % 10 AS predicted
FROM {embeddings}
"""

SAMPLES = """
SELECT vec_id, CAST(vec_id % 25 AS INT) AS label,
 chr(CAST(65 + (vec_id % 25 + CASE WHEN vec_id % 6 = 0 THEN 1 ELSE 0 END) % 25 AS INT)) AS read_letter
FROM {embeddings}
"""

LABEL_TEXTS = """
SELECT c_custkey AS id, CASE c_custkey % 12
  WHEN 0 THEN 'space' WHEN 1 THEN ' Blank ' WHEN 2 THEN 'del' WHEN 3 THEN 'Nothing'
  WHEN 4 THEN '' WHEN 5 THEN '  ' WHEN 6 THEN concat('sign_', c_mktsegment)
  WHEN 7 THEN lower(c_mktsegment) WHEN 8 THEN concat('  7: ', lower(c_name))
  WHEN 9 THEN '12#' WHEN 10 THEN 'NONE' ELSE c_name END AS text
FROM {customer}
"""

LANDMARKS = """
SELECT vec_id, chr(CAST(65 + label AS INT)) AS letter,
 CASE WHEN vec_id % 2 = 1 THEN 'Left' ELSE 'Right' END AS handedness,
 transform(sequence(0, 20), i -> named_struct('x', CAST(embedding[3 * i] AS DOUBLE),
  'y', CAST(embedding[3 * i + 1] AS DOUBLE), 'z', CAST(embedding[3 * i + 2] AS DOUBLE))) AS points
FROM {embeddings}
"""
LANDMARKS_SQL = """
SELECT vec_id, chr(CAST(65 + label AS INT)) AS letter,
 CASE WHEN vec_id % 2 = 1 THEN 'Left' ELSE 'Right' END AS handedness,
 i AS point, CAST(embedding[3 * i + 1] AS DOUBLE) AS x,
 CAST(embedding[3 * i + 2] AS DOUBLE) AS y, CAST(embedding[3 * i + 3] AS DOUBLE) AS z
FROM {embeddings}, range(0, 21) r(i)
"""

PIXEL_TABLE = """
SELECT vec_id, label,
 transform(embedding, x -> least(255, greatest(0,
   CAST(round((CAST(x AS DOUBLE) + 1) * 127.5D) AS INT)))) AS pixels
FROM {embeddings}
"""
PIXEL_TABLE_SQL = """
SELECT vec_id, label,
 list_transform(embedding, lambda x: least(255, greatest(0,
   CAST(round((CAST(x AS DOUBLE) + 1) * 127.5::DOUBLE) AS INT)))) AS pixels
FROM {embeddings}
"""

DIRTY_LABEL = (
    "CASE WHEN vec_id % 23 = 0 THEN 10 WHEN vec_id % 29 = 0 THEN -1 "
    "WHEN vec_id % 37 = 0 THEN NULL ELSE label END"
)
DIRTY_PIXEL = "CASE WHEN vec_id % 31 = 0 THEN 300 WHEN vec_id % 41 = 0 THEN NULL ELSE {0} END"
COPIES = "CASE WHEN vec_id % 7 = 0 THEN 2 ELSE 1 END"


def _dirty(first: int) -> str:
    names = []
    for i in range(PIXELS):
        value = f"pixels[{i + first}]"
        names.append(f"{DIRTY_PIXEL.format(value) if i == 4 else value} AS pixel{i + 1}")
    return f"CAST({DIRTY_LABEL} AS INT) AS label, {', '.join(names)}"


PIXELS_DIRTY = f"""
SELECT {_dirty(0)} FROM ({PIXEL_TABLE.strip()}) LATERAL VIEW explode(sequence(1, {COPIES})) c AS copy
"""
PIXELS_DIRTY_SQL = f"""
SELECT {_dirty(1)} FROM (SELECT *, unnest(range({COPIES})) FROM ({PIXEL_TABLE_SQL.strip()}))
"""

SCORES = """
SELECT vec_id, label, transform(s, x -> x / aggregate(s, 0D, (a, b) -> a + b)) AS scores
FROM (SELECT vec_id, label, transform(slice(embedding, 1, 10), x -> exp(CAST(x AS DOUBLE))) AS s
      FROM {embeddings})
"""
SCORES_SQL = """
SELECT vec_id, label, i AS place, chr(CAST(65 + i AS INT)) AS letter,
 exp(CAST(embedding[i + 1] AS DOUBLE))
  / list_sum(list_transform(embedding[1:10], lambda x: exp(CAST(x AS DOUBLE)))) AS score
FROM {embeddings}, range(0, 10) r(i)
"""

_SPARK = {
    "passengers": PASSENGERS, "frames": FRAMES, "sessions": SESSIONS, "requests": REQUESTS,
    "messages": MESSAGES, "predictions": PREDICTIONS, "predictions_multi": PREDICTIONS_MULTI,
    "samples": SAMPLES, "label_texts": LABEL_TEXTS, "landmarks": LANDMARKS, "pixels": PIXEL_TABLE,
    "pixels_dirty": PIXELS_DIRTY, "scores": SCORES,
}
_OTHER_SQL = {
    "landmarks": LANDMARKS_SQL, "pixels": PIXEL_TABLE_SQL, "pixels_dirty": PIXELS_DIRTY_SQL,
    "scores": SCORES_SQL,
}
_TABLES = ("customer", "events", "embeddings", "labels", "conversations")


def _filled(text: str, put) -> str:
    for name in _TABLES:
        text = text.replace("{" + name + "}", put(name))
    return text


def view(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    text = _SPARK[name]
    base = next(t for t in _TABLES if "{" + t + "}" in text)
    table(spark, sf_dir, base).createOrReplaceTempView(f"base_{base}")
    return spark.sql(_filled(text, lambda t: f"base_{t}"))


def with_views(names: str, body: str) -> str:
    """SQL text with the named views as leading common table expressions; ``body``
    may go on with further ``name AS (...)`` entries."""
    parts = [
        f"{n} AS ({_filled(_OTHER_SQL.get(n, _SPARK[n]), lambda t: t).strip()})"
        for n in names.split()
    ]
    more = re.match(r"\s*\w+ AS \(", body) is not None
    return "WITH RECURSIVE " + ", ".join(parts) + (", " if more else " ") + body.strip() + " "


def bitmap(pixels: np.ndarray) -> bytes:
    """24-bit bitmap file of a gray square."""
    side = pixels.shape[0]
    stride = -(-side * 3 // 4) * 4
    rows = np.zeros((side, stride), np.uint8)
    rows[:, : side * 3] = np.repeat(pixels[::-1].astype(np.uint8), 3, axis=1)
    body = rows.tobytes()
    number = lambda v, size: int(v).to_bytes(size, "little")
    head = b"BM" + number(54 + len(body), 4) + number(0, 4) + number(54, 4)
    info = number(40, 4) + number(side, 4) + number(side, 4) + number(1, 2) + number(24, 2)
    return head + info + number(0, 4) + number(len(body), 4) + number(0, 16) + body


def image_tree(spark: SparkSession, sf_dir: str, root: str) -> str:
    """Write every pixel row as an image file below a folder named by its letter;
    tasks write through the file system of ``root``."""
    if root.startswith("file:/") and not root.startswith("file:///"):
        root = "file://" + root[len("file:"):]
    rows = view(spark, sf_dir, "pixels").selectExpr(
        "vec_id", "lower(chr(CAST(65 + label AS INT))) AS folder", "pixels"
    )

    def write(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        from pyarrow import fs

        system, base = fs.FileSystem.from_uri(root)
        for batch in batches:
            for number, folder, pixels in zip(batch["vec_id"], batch["folder"], batch["pixels"]):
                suffix = ("jpg", "PNG", "bmp", "txt")[number % 4]
                system.create_dir(f"{base}/{folder}", recursive=True)
                data = bitmap(np.asarray(pixels).reshape(SIDE, SIDE))
                if suffix == "txt" or number % 10 == 1:
                    data = b"not an image"
                with system.open_output_stream(f"{base}/{folder}/img{number:08d}.{suffix}") as out:
                    out.write(data)
            yield pd.DataFrame({"n": [len(batch)]})

    rows.mapInPandas(write, "n long").agg({"n": "sum"}).collect()
    return root
