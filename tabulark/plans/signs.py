"""Queries over letters, pixel images and hand landmarks."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tabulark import constants as K
from tabulark.functions import landmarks as L
from tabulark.functions import letters as T
from tabulark.functions import pixels as X
from tabulark.operators import cleaning, image_jobs, landmark_jobs, lookups, profile, sampling
from tabulark.plans import fixtures
from tabulark.plans.fixtures import CLASSES, PIXELS, SIDE, table, view, with_views
from tabulark.plans.registry import query
from tabulark.session import scratch_path
from tabulark.sources import images

PIXEL_NAMES = [f"pixel{i + 1}" for i in range(PIXELS)]


def cells(df: DataFrame, keep: list[str], values: Column, name: str) -> DataFrame:
    """Array column as rows, so results compare value by value."""
    return df.select(*keep, F.posexplode(values).alias("pos", name))


# --- labels, letters, texts --------------------------------------------------

LETTER = "CASE WHEN {0} BETWEEN 0 AND 25 THEN chr(CAST(65 + {0} AS INT)) ELSE '?' END"


@query("label_to_letter", f"""
SELECT vec_id, {LETTER.format('vec_id % 30')} AS letter FROM embeddings""")
def _(spark, sf):
    return table(spark, sf, "embeddings").select(
        "vec_id", T.label_to_letter(F.col("vec_id") % 30).alias("letter")
    )


@query("letter_to_label", """
SELECT p_partkey, CASE WHEN regexp_matches(c, '^[A-Z]$') THEN CAST(ascii(c) - 65 AS INT) ELSE -1 END AS label
FROM (SELECT p_partkey, substr(p_name, CAST(1 + p_partkey % 3 AS INT), 1) AS c FROM
 (SELECT p_partkey, upper(p_name) AS p_name FROM part))""")
def _(spark, sf):
    letter = F.substr(F.upper("p_name"), (1 + F.col("p_partkey") % 3).cast("int"), F.lit(1))
    return table(spark, sf, "part").select("p_partkey", T.letter_to_label(letter).alias("label"))


@query("normalize_label", with_views("label_texts", r"""
SELECT id, CASE WHEN lower(trim(text)) IN ('space', 'blank') THEN ' '
 WHEN lower(trim(text)) IN ('del', 'delete', 'nothing', 'none') THEN '?'
 WHEN NOT regexp_matches(text, '\p{L}') THEN '?'
 ELSE upper(regexp_extract(text, '\p{L}')) END AS letter FROM label_texts"""))
def _(spark, sf):
    return view(spark, sf, "label_texts").select("id", T.normalize_label(F.col("text")).alias("letter"))


@query("nonblank_text", with_views("label_texts", """
SELECT id, trim(text) AS text FROM label_texts WHERE length(trim(text)) > 0"""))
def _(spark, sf):
    return view(spark, sf, "label_texts").select("id", T.nonblank_text(F.col("text")).alias("text")).where(
        "text IS NOT NULL"
    )


@query("text_edit", """
SELECT conv_id, turn, CASE turn % 4 WHEN 0 THEN concat(text, '!') WHEN 1 THEN concat(text, ' ')
 WHEN 2 THEN substr(text, 1, greatest(length(text) - 1, 0)) ELSE '' END AS text FROM conversations""")
def _(spark, sf):
    action = F.element_at(
        F.array(*map(F.lit, ["append", "space", "backspace", "clear"])), (F.col("turn") % 4 + 1).cast("int")
    )
    return table(spark, sf, "conversations").select(
        "conv_id", "turn", T.text_edit(F.col("text"), action, F.lit("!")).alias("text")
    )


@query("word_validate", """
SELECT conv_id, turn, bad, length(bad) AS n_bad FROM (SELECT conv_id, turn,
 regexp_replace(upper(replace(role || text, 'ß', 'ss')), '[A-IK-Y]', '', 'g') AS bad FROM conversations)""")
def _(spark, sf):
    bad = T.word_bad_letters(F.concat("role", "text"))
    return table(spark, sf, "conversations").select(
        "conv_id", "turn", F.array_join(bad, "").alias("bad"), F.size(bad).cast("long").alias("n_bad")
    )


@query("dim_lookup_join", """
SELECT e.vec_id, coalesce(d.letter, '?') AS letter FROM embeddings e
LEFT JOIN (SELECT i AS label, chr(CAST(65 + i AS INT)) AS letter FROM range(0, 26) r(i)) d
 ON d.label = e.vec_id % 30""")
def _(spark, sf):
    coded = table(spark, sf, "embeddings").selectExpr("vec_id", "CAST(vec_id % 30 AS INT) AS label")
    found = lookups.dim_lookup_join(coded, lookups.letter_dimension(spark), "label", "letter", "?")
    return found.select("vec_id", "letter")


@query("text_to_sign_join", with_views("messages", r"""
chars AS (SELECT conv_id, turn, i AS pos, substr(text, i + 1, 1) AS ch
 FROM (SELECT *, unnest(range(0, length(text))) AS i FROM messages))
SELECT conv_id, turn, CAST(pos AS INT) AS pos, ch, CASE WHEN ch = ' ' THEN 'space'
 WHEN regexp_matches(upper(ch), '^[A-IK-Y]$') THEN 'image'
 WHEN regexp_matches(ch, '\p{L}') THEN 'motion' ELSE 'other' END AS kind FROM chars"""))
def _(spark, sf):
    assets = lookups.letter_dimension(spark).where(~F.col("letter").isin(K.MOTION_LETTERS))
    return lookups.text_to_sign_join(view(spark, sf, "messages"), "text", assets, ["conv_id", "turn"])


@query("word_readback", with_views("samples", """
numbered AS (SELECT label, read_letter,
  row_number() OVER (PARTITION BY label ORDER BY md5(concat('0-', vec_id)), vec_id) - 1 AS idx FROM samples),
sizes AS (SELECT label, count(*) AS n FROM samples GROUP BY label),
chars AS (SELECT c_custkey AS word_id, c_mktsegment AS word, i AS pos,
  substr(c_mktsegment, i + 1, 1) AS ch
 FROM (SELECT *, unnest(range(0, length(c_mktsegment))) AS i FROM customer)),
met AS (SELECT c.word_id, c.word, c.pos, c.ch, coalesce(n.read_letter, '?') AS got FROM chars c
 LEFT JOIN sizes s ON s.label = ascii(c.ch) - 65
 LEFT JOIN numbered n ON n.label = s.label
  AND n.idx = CAST('0x' || substr(md5(concat('0-', c.word_id, '-', c.pos)), 1, 8) AS BIGINT) % s.n)
SELECT word_id, word, string_agg(got, '' ORDER BY pos) AS recognized,
 CAST(count(*) FILTER (got = ch) AS INT) AS right_letters,
 string_agg(got, '' ORDER BY pos) = word AS is_match FROM met GROUP BY word_id, word"""))
def _(spark, sf):
    words = table(spark, sf, "customer").selectExpr("c_custkey AS word_id", "c_mktsegment AS word")
    return lookups.word_readback(
        words, view(spark, sf, "samples"), "word_id", "word", "label", "vec_id", "read_letter"
    )


# --- class scores ------------------------------------------------------------

def _letters() -> Column:
    return F.array(*[F.lit(c) for c in K.ALPHABET[:CLASSES]])


@query("topk_classes", with_views("scores", """
SELECT vec_id, CAST(k - 1 AS INT) AS pos, letter, round(score, 6) AS confidence FROM (SELECT *,
 row_number() OVER (PARTITION BY vec_id ORDER BY score DESC, letter) AS k FROM scores) WHERE k <= 3"""))
def _(spark, sf):
    best = T.topk_classes(F.col("scores"), _letters(), 3)
    out = cells(view(spark, sf, "scores"), ["vec_id"], best, "s")
    return out.select("vec_id", "pos", "s.letter", F.round("s.confidence", 6).alias("confidence"))


@query("argmax_prediction", with_views("scores", """
SELECT vec_id, letter, CAST(place AS INT) AS label, round(score, 6) AS confidence FROM scores
QUALIFY row_number() OVER (PARTITION BY vec_id ORDER BY score DESC, place) = 1"""))
def _(spark, sf):
    best = T.argmax_prediction(F.col("scores"), _letters())
    out = view(spark, sf, "scores").select("vec_id", best.alias("p"))
    return out.select("vec_id", "p.letter", "p.label", F.round("p.confidence", 6).alias("confidence"))


@query("model_fallback", with_views("scores", """
best AS (SELECT * FROM scores QUALIFY row_number() OVER (PARTITION BY vec_id ORDER BY score DESC, place) = 1)
SELECT vec_id, CASE WHEN vec_id % 3 > 0 THEN letter WHEN vec_id % 2 = 0 THEN 'H' ELSE 'P' END AS letter,
 CASE WHEN vec_id % 3 > 0 THEN 'landmark' WHEN vec_id % 2 = 0 THEN 'photo' ELSE 'pixel' END AS source
FROM best"""))
def _(spark, sf):
    def fixed(letter):
        return F.struct(
            F.lit(letter).alias("letter"), F.lit(0).alias("label"), F.lit(0.5).alias("confidence")
        )

    landmark = F.when(F.col("vec_id") % 3 > 0, T.argmax_prediction(F.col("scores"), _letters()))
    photo = F.when(F.col("vec_id") % 2 == 0, fixed("H"))
    prediction, source = T.model_fallback(
        [("landmark", landmark), ("photo", photo), ("pixel", fixed("P"))]
    )
    return view(spark, sf, "scores").select("vec_id", prediction["letter"].alias("letter"), source.alias("source"))


# --- pixel tables ------------------------------------------------------------

def dirty(spark, sf) -> DataFrame:
    return view(spark, sf, "pixels_dirty")


def packed(spark, sf) -> DataFrame:
    """The dirty table with whole-number pixels in one array."""
    return dirty(spark, sf).select("label", F.array(*PIXEL_NAMES).alias("pixels"))


NAMES_SQL = ", ".join(PIXEL_NAMES)
FULL_ROW = " AND ".join(f"{c} IS NOT NULL" for c in ["label", *PIXEL_NAMES])
CLEAN = with_views("pixels_dirty", f"""
clean AS (SELECT DISTINCT * FROM pixels_dirty WHERE {FULL_ROW} AND label >= 0 AND label < {CLASSES}) """)
LIST = f"[{NAMES_SQL}]"


@query("clean_table", CLEAN + "SELECT * FROM clean")
def clean_table(spark, sf):
    return cleaning.clean_table(dirty(spark, sf), classes=CLASSES)


@query("label_filter", with_views("pixels_dirty", f"""
SELECT * FROM pixels_dirty WHERE label >= 0 AND label < {CLASSES}"""))
def _(spark, sf):
    return cleaning.label_filter(dirty(spark, sf), classes=CLASSES)


@query("clean_removed", CLEAN + """
SELECT (SELECT count(*) FROM pixels_dirty) AS before, (SELECT count(*) FROM clean) AS after,
 (SELECT count(*) FROM pixels_dirty) - (SELECT count(*) FROM clean) AS removed""")
def _(spark, sf):
    return profile.clean_removed(dirty(spark, sf), lambda df: cleaning.clean_table(df, classes=CLASSES))


@query("range_check", with_views("pixels_dirty", f"""
SELECT min(label) AS label_min, max(label) AS label_max,
 min(list_min({LIST})) AS pixel_min, max(list_max({LIST})) AS pixel_max FROM pixels_dirty"""))
def _(spark, sf):
    return profile.range_check(packed(spark, sf), "label", "pixels")


@query("bad_label_count", with_views("pixels_dirty", f"""
SELECT count(*) FILTER (label < 0 OR label >= {CLASSES}) AS bad_labels FROM pixels_dirty"""))
def _(spark, sf):
    return profile.bad_label_count(dirty(spark, sf), "label", CLASSES)


@query("bad_pixel_rows", with_views("pixels_dirty", f"""
SELECT count(*) FILTER (list_min({LIST}) < 0 OR list_max({LIST}) > 255) AS bad_pixel_rows
FROM pixels_dirty"""))
def _(spark, sf):
    return profile.bad_pixel_rows(packed(spark, sf), "pixels")


def as_text(pixels: Column) -> Column:
    """All pixels of an image in one text, gaps as ``?``, to compare whole rows."""
    whole = F.transform(pixels, lambda p: F.coalesce(F.round(p).cast("int").cast("string"), F.lit("?")))
    return F.array_join(whole, ",")


TEXT = f"array_to_string(list_transform({LIST}, lambda p: coalesce(CAST(CAST(p AS INT) AS VARCHAR), '?')), ',')"


@query("pixel_pack", with_views("pixels_dirty", f"SELECT label, {TEXT} AS pixels FROM pixels_dirty"))
def _(spark, sf):
    return dirty(spark, sf).select("label", as_text(X.pixel_pack(PIXEL_NAMES)).alias("pixels"))


PIXEL_ROWS = with_views("pixels", """
long AS (SELECT vec_id, label, i AS pos, pixels[i + 1] AS pixel FROM pixels, range(0, 64) r(i)) """)


@query("pixel_scale", PIXEL_ROWS + """
SELECT vec_id, CAST(pos AS INT) AS pos, round(pixel / 255, 5) AS value FROM long""")
def _(spark, sf):
    out = cells(view(spark, sf, "pixels"), ["vec_id"], X.pixel_scale(F.col("pixels")), "value")
    return out.withColumn("value", F.round(F.col("value").cast("double"), 5))


@query("pixel_reshape", PIXEL_ROWS + """
SELECT vec_id, CAST(pos // 8 AS INT) AS row, CAST(pos % 8 AS INT) AS col, pixel FROM long""")
def _(spark, sf):
    image = X.pixel_reshape(F.col("pixels"), SIDE)
    rows = view(spark, sf, "pixels").select("vec_id", F.posexplode(image).alias("row", "line"))
    return rows.select("vec_id", "row", F.posexplode("line").alias("col", "pixel"))


@query("pixel_dataset", CLEAN + f"""
, parts AS (SELECT 'train' AS split, * FROM clean UNION ALL SELECT 'test', * FROM clean),
long AS (SELECT split, label, {LIST} AS p FROM parts)
SELECT split, label, array_to_string(list_transform(range(0, {SIDE}),
 lambda r: array_to_string(list_transform(p[r * {SIDE} + 1 : (r + 1) * {SIDE}],
  lambda v: CAST(CAST(v AS INT) AS VARCHAR)), ',')), '/') AS image FROM long""")
def _(spark, sf):
    data = cleaning.pixel_dataset(dirty(spark, sf), dirty(spark, sf), side=SIDE, classes=CLASSES)
    lines = F.transform("image", lambda line: as_text(F.transform(line, lambda v: v * 255)))
    return data.select("split", "label", F.array_join(lines, "/").alias("image"))


@query("distinct_sorted", with_views("pixels_dirty", """
SELECT DISTINCT label FROM pixels_dirty WHERE label IS NOT NULL ORDER BY label"""))
def _(spark, sf):
    return profile.distinct_sorted(dirty(spark, sf).where("label IS NOT NULL"), "label")


@query("label_union", with_views("predictions_multi", """
SELECT actual AS label FROM predictions_multi UNION SELECT predicted FROM predictions_multi"""))
def _(spark, sf):
    return cleaning.label_union(view(spark, sf, "predictions_multi"), "actual", "predicted")


@query("class_balance", with_views("pixels", """
SELECT min(n) AS smallest, max(n) AS largest, round(max(n) / min(n), 6) AS ratio
FROM (SELECT label, count(*) AS n FROM pixels GROUP BY label)"""))
def _(spark, sf):
    out = profile.class_balance(view(spark, sf, "pixels"), "label")
    return out.withColumn("ratio", F.round("ratio", 6))


@query("class_mean_image", PIXEL_ROWS + """
SELECT label, CAST(pos AS INT) AS pos, round(avg(pixel), 6) AS mean FROM long GROUP BY ALL""")
def _(spark, sf):
    means = profile.class_mean_image(view(spark, sf, "pixels"), "label", "pixels")
    return cells(means, ["label"], F.col("mean_image"), "mean").withColumn("mean", F.round("mean", 6))


@query("class_brightness", PIXEL_ROWS + """
SELECT label, round(avg(m), 10) AS brightness FROM (SELECT label, pos, avg(pixel) AS m FROM long GROUP BY ALL)
GROUP BY label""")
def _(spark, sf):
    out = profile.class_brightness(view(spark, sf, "pixels"), "label", "pixels")
    return out.withColumn("brightness", F.round("brightness", 10))


@query("pixel_moments", PIXEL_ROWS + """
SELECT round(avg(pixel), 6) AS mean, round(stddev_pop(pixel), 6) AS std FROM long""")
def _(spark, sf):
    out = profile.pixel_moments(view(spark, sf, "pixels"), "pixels")
    return out.select(F.round("mean", 6).alias("mean"), F.round("std", 6).alias("std"))


# --- landmarks ---------------------------------------------------------------

@query("landmark_normalize", with_views("landmarks", """
shifted AS (SELECT vec_id, point,
  (x - first(x) OVER w) * CASE WHEN handedness = 'Left' THEN -1 ELSE 1 END AS x,
  y - first(y) OVER w AS y, z - first(z) OVER w AS z
 FROM landmarks WINDOW w AS (PARTITION BY vec_id ORDER BY point)),
knuckle AS (SELECT vec_id, -pi() / 2 - atan2(y, x) AS a, sqrt(x * x + y * y) AS len
 FROM shifted WHERE point = 9),
turned AS (SELECT s.vec_id, point,
  CASE WHEN len > 1e-6 THEN x * cos(a) - y * sin(a) ELSE x END AS x,
  CASE WHEN len > 1e-6 THEN x * sin(a) + y * cos(a) ELSE y END AS y, z
 FROM shifted s JOIN knuckle k ON s.vec_id = k.vec_id),
sized AS (SELECT *, max(sqrt(x * x + y * y)) OVER (PARTITION BY vec_id) AS r FROM turned),
done AS (SELECT vec_id, point, CASE WHEN r > 0 THEN x / r ELSE x END AS x,
  CASE WHEN r > 0 THEN y / r ELSE y END AS y, CASE WHEN r > 0 THEN z / r ELSE z END AS z FROM sized)
SELECT vec_id, CAST(point * 3 AS INT) AS pos, round(x, 4) + 0.0 AS value FROM done
UNION ALL SELECT vec_id, CAST(point * 3 + 1 AS INT), round(y, 4) + 0.0 FROM done
UNION ALL SELECT vec_id, CAST(point * 3 + 2 AS INT), round(z, 4) + 0.0 FROM done"""))
def landmark_normalize(spark, sf):
    features = L.landmark_normalize(F.col("points"), F.col("handedness"))
    out = cells(view(spark, sf, "landmarks"), ["vec_id"], features, "value")
    return out.withColumn("value", F.round("value", 4) + F.lit(0.0))


FRAME = (640, 480)
UNIT = """
unit AS (SELECT vec_id, point, x + 0.5 AS x, y + 0.5 AS y FROM landmarks),
ends AS (SELECT vec_id, min(x) AS lx, max(x) AS hx, min(y) AS ly, max(y) AS hy FROM unit GROUP BY vec_id),
box AS (SELECT vec_id,
  CAST(trunc(greatest(0, (lx - (hx - lx) * 0.2::DOUBLE) * 640)) AS INT) AS x1,
  CAST(trunc(greatest(0, (ly - (hy - ly) * 0.2::DOUBLE) * 480)) AS INT) AS y1,
  CAST(trunc(least(640, (hx + (hx - lx) * 0.2::DOUBLE) * 640)) AS INT) AS x2,
  CAST(trunc(least(480, (hy + (hy - ly) * 0.2::DOUBLE) * 480)) AS INT) AS y2 FROM ends),
kept AS (SELECT * FROM box WHERE x2 > x1 AND y2 > y1)
"""


def boxes(spark, sf) -> DataFrame:
    """Hands moved into the unit frame, with their pixel box."""
    moved = F.transform(
        "points",
        lambda p: F.struct((p["x"] + 0.5).alias("x"), (p["y"] + 0.5).alias("y"), p["z"].alias("z")),
    )
    hands = view(spark, sf, "landmarks").withColumn("points", moved)
    return hands.withColumn("box", L.hand_bbox(F.col("points"), F.lit(FRAME[0]), F.lit(FRAME[1])))


@query("hand_bbox", with_views("landmarks", UNIT + "SELECT * FROM kept"))
def _(spark, sf):
    return boxes(spark, sf).where("box IS NOT NULL").select("vec_id", "box.*")


@query("square_box", with_views("landmarks", UNIT + """
, half AS (SELECT *, (x1 + x2) // 2 AS cx, (y1 + y2) // 2 AS cy,
  greatest(CAST(trunc(greatest(x2 - x1, y2 - y1) / 2) AS INT), 1) AS h FROM kept)
SELECT vec_id, cx - h AS x1, cy - h AS y1, cx + h AS x2, cy + h AS y2,
 greatest(0, h - cy) AS pad_top, greatest(0, cy + h - 480) AS pad_bottom,
 greatest(0, h - cx) AS pad_left, greatest(0, cx + h - 640) AS pad_right FROM half"""))
def _(spark, sf):
    square = L.square_box(F.col("box"), F.lit(FRAME[0]), F.lit(FRAME[1]))
    return boxes(spark, sf).where("box IS NOT NULL").select("vec_id", square.alias("s")).select("vec_id", "s.*")


@query("center_square_box", """
SELECT event_id, (w - least(w, h)) // 2 AS x1, (h - least(w, h)) // 2 AS y1,
 (w - least(w, h)) // 2 + least(w, h) AS x2, (h - least(w, h)) // 2 + least(w, h) AS y2
FROM (SELECT event_id, CAST(320 + event_id % 641 AS INT) AS w, CAST(240 + user_id % 300 AS INT) AS h FROM events)""")
def _(spark, sf):
    frames = table(spark, sf, "events").selectExpr(
        "event_id", "CAST(320 + event_id % 641 AS INT) AS w", "CAST(240 + user_id % 300 AS INT) AS h"
    )
    return frames.select("event_id", L.center_square_box(F.col("w"), F.col("h")).alias("b")).select(
        "event_id", "b.*"
    )


@query("landmark_augment", with_views("landmarks", """
SELECT vec_id, CAST(c AS INT) AS copy, count(*) AS n_points,
 CASE WHEN c = 0 THEN round(sum(x + y + z), 5) END AS original
FROM landmarks, range(0, 5) r(c) GROUP BY vec_id, c"""))
def _(spark, sf):
    out = landmark_jobs.landmark_augment(view(spark, sf, "landmarks"), "vec_id", "points")
    total = F.aggregate("points", F.lit(0.0), lambda a, p: a + p["x"] + p["y"] + p["z"])
    return out.select(
        "vec_id", "copy", F.size("points").cast("long").alias("n_points"),
        F.when(F.col("copy") == 0, F.round(total, 5)).alias("original"),
    )


@query("stratified_split", with_views("landmarks", """
hands AS (SELECT DISTINCT vec_id, letter FROM landmarks),
sizes AS (SELECT letter, count(*) AS n FROM hands GROUP BY letter),
wanted AS (SELECT CAST(ceil(0.15 * sum(n)) AS BIGINT) AS w, CAST(sum(n) AS BIGINT) AS total FROM sizes),
shares AS (SELECT letter, n * w / total AS exact, floor(n * w / total) AS base, w FROM sizes, wanted),
quota AS (SELECT letter, base + CASE WHEN row_number() OVER (ORDER BY exact - base DESC, letter)
  <= w - sum(base) OVER () THEN 1 ELSE 0 END AS q FROM shares)
SELECT h.vec_id, h.letter, CASE WHEN row_number() OVER (PARTITION BY h.letter
  ORDER BY md5(concat('0-', h.vec_id)), h.vec_id) <= q THEN 'test' ELSE 'train' END AS split
FROM hands h JOIN quota USING (letter)"""))
def _(spark, sf):
    hands = view(spark, sf, "landmarks").select("vec_id", "letter")
    return sampling.stratified_split(hands, "letter", "vec_id")


@query("yield_per_class", with_views("landmarks", UNIT + """
SELECT letter, count(*) FILTER (x2 > x1 AND y2 > y1 AND x1 >= 30) AS kept, count(*) AS scanned
FROM box JOIN (SELECT DISTINCT vec_id, letter FROM landmarks) USING (vec_id) GROUP BY letter"""))
def _(spark, sf):
    found = F.col("box").isNotNull() & (F.col("box.x1") >= 30)
    return profile.yield_per_class(boxes(spark, sf), "letter", found)


# --- image files -------------------------------------------------------------

FILES = with_views("pixels", """
files AS (SELECT vec_id, chr(CAST(65 + label AS INT)) AS letter, pixels,
  CASE vec_id % 4 WHEN 0 THEN 'jpg' WHEN 1 THEN 'PNG' WHEN 2 THEN 'bmp' ELSE 'txt' END AS suffix,
  vec_id % 4 <> 3 AND vec_id % 10 <> 1 AS is_image,
  'img' || lpad(CAST(vec_id AS VARCHAR), 8, '0') AS stem FROM pixels) """)


def tree(spark, sf) -> str:
    return fixtures.image_tree(spark, sf, scratch_path(spark, "images"))


@query("image_tree_scan", FILES + """
SELECT letter, stem || '.' || suffix AS file FROM files WHERE suffix <> 'txt'
QUALIFY row_number() OVER (PARTITION BY letter ORDER BY stem) <= 20""")
def _(spark, sf):
    return images.image_tree_scan(spark, tree(spark, sf), 20).select("letter", "file")


@query("image_decode", FILES + """
SELECT stem || '.' || suffix AS file, CAST(8 AS INT) AS height, CAST(8 AS INT) AS width,
 CAST(3 AS INT) AS channels, CAST(192 AS INT) AS n_bytes, array_to_string(
  list_transform(pixels, lambda p: repeat(lpad(lower(hex(p)), 2, '0'), 3)), '') AS bytes
FROM files WHERE is_image""")
def _(spark, sf):
    out = images.image_decode(spark, tree(spark, sf))
    return out.select(
        F.regexp_extract("path", r"([^/]+)$", 1).alias("file"), "height", "width",
        F.col("nChannels").alias("channels"), F.length("data").alias("n_bytes"),
        F.lower(F.hex("data")).alias("bytes"),
    )


@query("asset_lookup_scan", FILES + """
SELECT letter AS folder, upper(stem) AS letter, CASE WHEN is_image THEN 'Qk' ELSE 'bm' END AS head
FROM files WHERE suffix = 'jpg'""")
def _(spark, sf):
    found = images.asset_lookup_scan(spark, tree(spark, sf) + "/*")
    labels = view(spark, sf, "pixels").selectExpr(
        "chr(CAST(65 + label AS INT)) AS folder", "concat('IMG', lpad(vec_id, 8, '0')) AS letter"
    )
    return found.join(labels, "letter").select(
        "folder", "letter", F.substring("content", 1, 2).alias("head")
    )


@query("image_crop_resize", PIXEL_ROWS + """
, grown AS (SELECT vec_id, pos // 8 // 2 AS r, pos % 8 // 2 AS c,
  floor(0.114::DOUBLE * pixel + 0.587::DOUBLE * pixel + 0.299::DOUBLE * pixel + 0.5) AS gray FROM long)
SELECT vec_id, CAST(r * 4 + c AS INT) AS pos, round(floor(avg(gray) + 0.5) / 255, 5) AS value
FROM grown WHERE vec_id % 4 <> 3 AND vec_id % 10 <> 1 GROUP BY vec_id, r, c""")
def _(spark, sf):
    decoded = images.image_decode(spark, tree(spark, sf))
    number = F.regexp_extract("path", r"img(\d+)", 1).cast("long")
    box = L.center_square_box(F.col("width"), F.col("height"))
    ready = decoded.select(number.alias("vec_id"), "height", "width", "nChannels", "data", box.alias("box"))
    out = image_jobs.image_crop_resize(ready, ["vec_id"], side=4)
    return cells(out, ["vec_id"], F.col("pixels"), "value").withColumn(
        "value", F.round(F.col("value").cast("double"), 5)
    )


@query("crop_or_center", PIXEL_ROWS + """
, gray AS (SELECT vec_id, pos // 8 AS r, pos % 8 AS c,
  floor(0.114::DOUBLE * pixel + 0.587::DOUBLE * pixel + 0.299::DOUBLE * pixel + 0.5) AS gray FROM long),
cut AS (SELECT vec_id, (r - 2) * 4 + c - 2 AS pos, gray AS value FROM gray
  WHERE vec_id % 3 = 0 AND r BETWEEN 2 AND 5 AND c BETWEEN 2 AND 5
 UNION ALL SELECT vec_id, r // 2 * 4 + c // 2, floor(avg(gray) + 0.5) FROM gray
  WHERE vec_id % 3 <> 0 GROUP BY vec_id, r // 2, c // 2)
SELECT vec_id, CAST(pos AS INT) AS pos, round(value / 255, 5) AS value FROM cut
WHERE vec_id % 4 <> 3 AND vec_id % 10 <> 1""")
def _(spark, sf):
    """Hands cut out by their box, frames without one by the centre square."""
    decoded = images.image_decode(spark, tree(spark, sf))
    number = F.regexp_extract("path", r"img(\d+)", 1).cast("long")
    hand = F.struct(*[F.lit(v).alias(k) for k, v in (("x1", 2), ("y1", 2), ("x2", 6), ("y2", 6))])
    found = F.when(number % 3 == 0, hand)
    box = L.crop_box(found, F.col("width"), F.col("height"))
    ready = decoded.select(number.alias("vec_id"), "height", "width", "nChannels", "data", box.alias("box"))
    out = image_jobs.image_crop_resize(ready, ["vec_id"], side=4)
    return cells(out, ["vec_id"], F.col("pixels"), "value").withColumn(
        "value", F.round(F.col("value").cast("double"), 5)
    )


@query("image_augment")
def _(spark, sf):
    out = image_jobs.image_augment(
        view(spark, sf, "pixels"), "vec_id", "pixels", ["vec_id", "label"], side=SIDE, copies=2
    )
    return out.select(
        "vec_id", "label", "copy", F.size("pixels").alias("n_pixels"),
        F.round(F.aggregate("pixels", F.lit(0.0), lambda a, p: a + p), 3).alias("total"),
    )
