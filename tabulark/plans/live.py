"""Queries over frame sessions: the committer in batch and stream form."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tabulark.operators import committer as C
from tabulark.plans.fixtures import FRAMES, SESSIONS, table, view, with_views
from tabulark.plans.registry import query
from tabulark.session import scratch_path
from tabulark.sources.tables import frame_stream_source
from tabulark.streaming.committer import CommitterSettings, commit_stream
from tabulark.streaming.scoring import decode_frames, run_to_files, write_isolated
from tabulark.streaming.upserts import LatestTable

STABLE, CONFIDENCE, GAP = 2, 0.1, 600.0

# The rules as whole-session windows.
COMMITS = """
marked AS (SELECT *, action IS NULL AND letter IS NOT NULL AND conf >= 0.1 AS acc FROM {source}),
flagged AS (SELECT *, action IS NULL AND NOT acc AS rel,
  CASE WHEN action IS NULL AND NOT acc OR action IN ('clear', 'set_text') THEN 1 ELSE 0 END AS hard
 FROM marked),
counted AS (SELECT *, sum(hard) OVER w AS segment,
  sum(CASE WHEN rel OR action IS NOT NULL THEN 1 ELSE 0 END) OVER w AS epoch
 FROM flagged WINDOW w AS (PARTITION BY sid ORDER BY ts, seq)),
accepted AS (SELECT *, CASE WHEN letter = lag(letter) OVER (PARTITION BY sid, segment ORDER BY ts, seq)
  THEN 0 ELSE 1 END AS fresh FROM counted WHERE acc),
runs AS (SELECT *, sum(fresh) OVER (PARTITION BY sid, segment ORDER BY ts, seq) AS run FROM accepted),
placed AS (SELECT *, row_number() OVER (PARTITION BY sid, segment, run ORDER BY ts, seq) AS pos FROM runs),
full_runs AS (SELECT *, lag(letter) OVER (PARTITION BY sid, epoch ORDER BY ts, seq) AS prior
 FROM placed WHERE pos % 2 = 0),
commits AS (SELECT sid, ts, seq, letter FROM full_runs WHERE prior IS NULL OR prior <> letter)
"""
PLAIN = "plain AS (SELECT *, CAST(NULL AS VARCHAR) AS action FROM frames), "
PAUSES = """
, hands AS (SELECT *, count(letter) OVER (PARTITION BY sid ORDER BY ts, seq) AS hand FROM frames),
away AS (SELECT sid, ts, seq, hand, first(ts) OVER (PARTITION BY sid, hand ORDER BY ts, seq) AS start
 FROM hands WHERE letter IS NULL),
reached AS (SELECT sid, hand, min((ts, seq)) AS k FROM away
 WHERE ts - start >= INTERVAL 600 SECOND GROUP BY sid, hand),
both_kinds AS (SELECT sid, ts, seq, letter FROM commits
 UNION ALL SELECT sid, k[1], k[2], ' ' FROM reached),
items AS (SELECT sid, ts, seq, letter FROM (SELECT *, lag(letter) OVER (PARTITION BY sid ORDER BY ts, seq) AS prior
 FROM both_kinds) WHERE letter <> ' ' OR prior <> ' ')
"""
EDITED_TEXT = """
, steps AS (SELECT sid, ts, seq, 0 AS sub, 'push' AS kind, letter AS ch FROM commits
 UNION ALL SELECT sid, ts, seq, 0, 'push', ' ' FROM sessions WHERE action = 'space'
 UNION ALL SELECT sid, ts, seq, 0, 'push', ch FROM sessions WHERE action = 'char'
 UNION ALL SELECT sid, ts, seq, 0, 'pop', NULL FROM sessions WHERE action = 'backspace'
 UNION ALL SELECT sid, ts, seq, 0, 'reset', NULL FROM sessions WHERE action IN ('clear', 'set_text')
 UNION ALL SELECT sid, ts, seq, CAST(i + 1 AS INT), 'push', substr(ch, CAST(i + 1 AS INT), 1)
  FROM sessions, range(0, 2) r(i) WHERE action = 'set_text'),
resets AS (SELECT sid, max((ts, seq)) AS last_reset FROM steps WHERE kind = 'reset' GROUP BY sid),
live AS (SELECT s.* FROM steps s LEFT JOIN resets r ON r.sid = s.sid
 WHERE r.sid IS NULL OR (s.ts, s.seq) > r.last_reset OR (s.ts, s.seq) = r.last_reset AND kind = 'push'),
levels AS (SELECT *, sum(CASE kind WHEN 'push' THEN 1 ELSE -1 END) OVER
 (PARTITION BY sid ORDER BY ts, seq, sub) AS level FROM live),
lows AS (SELECT *, min(level) OVER (PARTITION BY sid ORDER BY ts, seq, sub
 ROWS BETWEEN 1 FOLLOWING AND UNBOUNDED FOLLOWING) AS low FROM levels),
final_text AS (SELECT k.sid, coalesce(string_agg(ch, '' ORDER BY ts, seq, sub)
  FILTER (kind = 'push' AND (low IS NULL OR low >= level)), '') AS text
 FROM (SELECT DISTINCT sid FROM steps) k LEFT JOIN lows l ON l.sid = k.sid GROUP BY k.sid)
"""


def frames(spark, sf) -> DataFrame:
    return view(spark, sf, "frames")


def sessions(spark, sf) -> DataFrame:
    return view(spark, sf, "sessions")


@query("confidence_gate", with_views("frames", """
SELECT seq, coalesce(letter IS NOT NULL AND conf >= 0.1, false) AS accepted FROM frames"""))
def _(spark, sf):
    gate = C.confidence_gate(F.col("letter"), F.col("conf"), CONFIDENCE)
    return frames(spark, sf).select("seq", gate.alias("accepted"))


@query("letter_commit", with_views("sessions", COMMITS.replace("{source}", "sessions") + "SELECT * FROM commits"))
def letter_commit(spark, sf):
    return C.letter_commit(sessions(spark, sf), STABLE, CONFIDENCE)


@query("auto_space", with_views("frames", PLAIN + COMMITS.replace("{source}", "plain") + PAUSES
       + "SELECT sid, ts, seq FROM items WHERE letter = ' '"))
def _(spark, sf):
    return C.auto_space(frames(spark, sf), STABLE, CONFIDENCE, GAP)


@query("text_fold", with_views("frames", PLAIN + COMMITS.replace("{source}", "plain") + PAUSES
       + "SELECT sid, string_agg(letter, '' ORDER BY ts, seq) AS text FROM items GROUP BY sid"))
def _(spark, sf):
    df = frames(spark, sf)
    commits = C.letter_commit(df, STABLE, CONFIDENCE)
    return C.text_fold(C.text_items(commits, None, C.auto_space(df, STABLE, CONFIDENCE, GAP)))


@query("edit_actions", with_views("sessions", COMMITS.replace("{source}", "sessions") + EDITED_TEXT
       + "SELECT * FROM final_text"))
def edit_actions(spark, sf):
    df = sessions(spark, sf)
    commits = C.letter_commit(df, STABLE, CONFIDENCE)
    return C.text_fold(C.text_items(commits, df))


# The rules row by row: what the windows above cannot say, as a space depends on the text
# that edits have left.
STEPS = """
rowed AS (SELECT *, row_number() OVER (PARTITION BY sid ORDER BY ts, seq) AS n FROM sessions),
walk AS (
 SELECT sid, CAST(0 AS BIGINT) AS n, CAST(NULL AS BIGINT) AS seq, CAST(NULL AS VARCHAR) AS run_letter, 0 AS run_length,
  CAST(NULL AS VARCHAR) AS held, '' AS text, CAST(NULL AS TIMESTAMP) AS gap_start, false AS space_done, false AS spaced
 FROM (SELECT DISTINCT sid FROM rowed)
 UNION ALL
 SELECT sid, n, seq, run_letter, run_length, held,
  CASE WHEN spaced THEN text || ' ' ELSE text END, gap_start, space_done OR spaced, spaced
 FROM (
  SELECT *, away AND ts - gap_start >= INTERVAL {gap} MILLISECOND AND NOT space_done AND text <> ''
   AND NOT ends_with(text, ' ') AS spaced
  FROM (
   SELECT sid, next_n AS n, next_seq AS seq, ts, away,
    CASE WHEN keeps THEN run_letter WHEN accepted AND NOT full_run THEN letter END AS run_letter,
    CASE WHEN keeps THEN run_length WHEN accepted AND NOT full_run THEN length ELSE 0 END AS run_length,
    CASE WHEN NOT accepted THEN NULL WHEN full_run THEN letter ELSE held END AS held,
    CASE WHEN accepted AND full_run AND letter IS DISTINCT FROM held THEN text || letter
     WHEN action = 'space' THEN text || ' ' WHEN action = 'char' THEN text || ch
     WHEN action = 'backspace' THEN left(text, greatest(length(text) - 1, 0)) WHEN action = 'clear' THEN ''
     WHEN action = 'set_text' THEN ch ELSE text END AS text,
    CASE WHEN away THEN coalesce(gap_start, ts) WHEN action IS NOT NULL THEN gap_start END AS gap_start,
    (away OR action IS NOT NULL) AND space_done AS space_done
   FROM (
    SELECT w.*, r.ts, r.letter, r.action, r.ch, r.n AS next_n, r.seq AS next_seq,
     r.action IN ('space', 'char', 'backspace') AS keeps,
     r.action IS NULL AND r.letter IS NULL AS away,
     r.action IS NULL AND r.letter IS NOT NULL AND coalesce(r.conf >= {conf}, false) AS accepted,
     CASE WHEN r.letter = w.run_letter THEN w.run_length + 1 ELSE 1 END AS length,
     CASE WHEN r.letter = w.run_letter THEN w.run_length + 1 ELSE 1 END >= {stable} AS full_run
    FROM walk w JOIN rowed r ON r.sid = w.sid AND r.n = w.n + 1)))),
ends AS (SELECT sid, text FROM walk QUALIFY row_number() OVER (PARTITION BY sid ORDER BY n DESC) = 1)
"""


def _steps(stable: int, conf: float, gap_seconds: float) -> str:
    return STEPS.format(stable=stable, conf=conf, gap=int(gap_seconds * 1000))


@query("live_text", with_views("sessions", _steps(STABLE, CONFIDENCE, GAP) + "SELECT sid, text FROM ends"))
def _(spark, sf):
    return C.live_text(sessions(spark, sf), STABLE, CONFIDENCE, GAP)


@query("live_spaces", with_views("sessions", _steps(STABLE, CONFIDENCE, GAP) + "SELECT sid, seq FROM walk WHERE spaced"))
def _(spark, sf):
    return C.auto_space(sessions(spark, sf), STABLE, CONFIDENCE, GAP).select("sid", "seq")


@query("monotonic_ts", """
WITH arrivals AS (SELECT user_id AS sid, event_id AS seq, CAST(floor(event_id / 7) AS BIGINT) - event_id % 5 AS ms
 FROM events),
placed AS (SELECT *, row_number() OVER (PARTITION BY sid ORDER BY seq) AS n FROM arrivals)
SELECT sid, seq, ms, CAST(n + greatest(0, max(ms - n) OVER (PARTITION BY sid ORDER BY seq)) AS BIGINT) AS mono_ms
FROM placed""")
def _(spark, sf):
    arrivals = table(spark, sf, "events").selectExpr(
        "user_id AS sid", "event_id AS seq",
        "CAST(floor(event_id / 7) AS BIGINT) - event_id % 5 AS ms",
    )
    return C.monotonic_ts(arrivals, "ms")


LATEST = """
SELECT sid, CAST(date_trunc('day', ts) AS TIMESTAMP) AS window_start, ts, seq, letter, conf FROM frames
QUALIFY row_number() OVER (PARTITION BY sid, date_trunc('day', ts) ORDER BY ts DESC, seq DESC) = 1"""


@query("latest_wins", with_views("frames", LATEST))
def _(spark, sf):
    return C.latest_wins(frames(spark, sf), "1 day", ["ts", "seq", "letter", "conf"])


# --- streams -----------------------------------------------------------------

EVENTS_SCHEMA = (
    "event_id BIGINT, ts TIMESTAMP_NTZ, user_id BIGINT, event_type STRING, value DOUBLE, props STRING"
)


def event_stream(spark, sf) -> DataFrame:
    return frame_stream_source(spark, f"{sf}/events.parquet*", EVENTS_SCHEMA)


def _stream_view(spark, sf, text: str) -> DataFrame:
    event_stream(spark, sf).createOrReplaceTempView("arriving_events")
    rows = spark.sql(text.replace("{events}", "arriving_events"))
    return rows.withColumn("ts", F.col("ts").cast("timestamp"))


def _drained(spark, rows: DataFrame, name: str) -> DataFrame:
    path = scratch_path(spark, name)
    run_to_files(rows, path, scratch_path(spark, f"{name}-state"))
    return spark.read.schema(rows.schema).parquet(path)


@query("frame_stream_source", "SELECT event_id, user_id, event_type, value FROM events")
def _(spark, sf):
    rows = event_stream(spark, sf).select("event_id", "user_id", "event_type", "value")
    return _drained(spark, rows, "arrived")


@query("letter_commit_stream", with_views("sessions", COMMITS.replace("{source}", "sessions")
       + "SELECT sid, seq, letter FROM commits"))
def _(spark, sf):
    rows = _stream_view(spark, sf, SESSIONS)
    events = commit_stream(rows, CommitterSettings(STABLE, CONFIDENCE), "events")
    return _drained(spark, events, "commits").select("sid", "seq", "letter")


@query("text_snapshot", with_views("sessions", COMMITS.replace("{source}", "sessions") + EDITED_TEXT + """
SELECT s.sid, coalesce(f.text, '') AS text FROM (SELECT DISTINCT sid FROM sessions) s
LEFT JOIN final_text f ON f.sid = s.sid"""))
def _(spark, sf):
    rows = _stream_view(spark, sf, SESSIONS)
    shots = commit_stream(rows, CommitterSettings(STABLE, CONFIDENCE), "snapshots")
    texts = LatestTable(scratch_path(spark, "texts"), ["sid"], ["ts", "seq"],
                        "sid long, ts timestamp, seq long, text string")
    texts.keep(shots, scratch_path(spark, "texts-state")).awaitTermination()
    return texts.read(spark).select("sid", "text")


@query("latest_wins_stream", with_views("frames", LATEST))
def _(spark, sf):
    rows = _stream_view(spark, sf, FRAMES)
    newest = C.latest_wins(rows, "1 day", ["ts", "seq", "letter", "conf"], delay="2 days")
    table_ = LatestTable(scratch_path(spark, "latest"), ["sid", "window_start"], ["ts", "seq"],
                         "sid long, window_start timestamp, ts timestamp, seq long, letter string, conf double")
    table_.keep(newest, scratch_path(spark, "latest-state"), "update").awaitTermination()
    return table_.read(spark)


@query("bad_record_isolation", """
SELECT event_id, CASE WHEN event_id % 11 = 0 THEN NULL
  ELSE CAST(json_extract_string(props, '$.k') AS DOUBLE) END AS k, event_id % 11 = 0 AS bad FROM events""")
def _(spark, sf):
    broken = "CASE WHEN event_id % 11 = 0 THEN substr(props, 1, length(props) - 1) ELSE props END AS payload"
    rows = event_stream(spark, sf).selectExpr("event_id", broken)
    decoded = decode_frames(rows, "payload", "k DOUBLE")
    good, bad = scratch_path(spark, "good"), scratch_path(spark, "bad")
    write_isolated(decoded, F.col("bad"), good, bad, scratch_path(spark, "split")).awaitTermination()
    kept = spark.read.parquet(good).unionByName(spark.read.parquet(bad))
    return kept.select("event_id", "k", "bad")
