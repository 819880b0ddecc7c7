"""Batch committer against a plain deque model, and stream against batch."""

import random
from collections import deque
from datetime import datetime, timedelta

import pytest

from tabulark.operators import committer as C
from tabulark.operators.borders import with_parts
from tabulark.session import scratch_path
from tabulark.streaming.committer import CommitterSettings, commit_stream
from tabulark.streaming.upserts import LatestTable

BASE = datetime(2024, 1, 1)


class Model:
    """Independent statement of the rules, frame by frame."""

    def __init__(self, n, m, gap=None, lost_releases=True):
        self.n, self.m, self.gap, self.lost = n, m, gap, lost_releases
        self.recent, self.last, self.text = deque(maxlen=n), None, ""
        self.start, self.done = None, False
        self.commits, self.spaces = [], []

    def update(self, row):
        if row["conf"] is None or row["letter"] is None or row["conf"] < self.m:
            self.recent.clear()
            self.last = None
            return
        self.recent.append(row["letter"])
        if len(self.recent) == self.n and len(set(self.recent)) == 1:
            self.recent.clear()
            if row["letter"] != self.last:
                self.last = row["letter"]
                self.text += row["letter"]
                self.commits.append((row["seq"], row["letter"]))

    def feed(self, row):
        a = row["action"]
        if a:
            self.last = None
            if a in ("clear", "set_text"):
                self.recent.clear()
                self.text = row["ch"] if a == "set_text" else ""
            elif a == "backspace":
                self.text = self.text[:-1]
            else:
                self.text += " " if a == "space" else row["ch"]
            return
        if row["letter"] is not None:
            self.start, self.done = None, False
            self.update(row)
            return
        if self.start is None:
            self.start = row["ts"]
        if self.lost:
            self.update(row)
        if self.gap is None or self.done or not self.text or self.text.endswith(" "):
            return
        if (row["ts"] - self.start).total_seconds() >= self.gap:
            self.text += " "
            self.last, self.done = None, True
            self.spaces.append(row["seq"])


def sessions(seed, count, edits):
    rng = random.Random(seed)
    rows, seq = [], 0
    for sid in range(count):
        now = BASE + timedelta(seconds=sid)
        letter = "A"
        for _ in range(rng.randint(0, 60)):
            seq += 1
            now += timedelta(milliseconds=rng.choice([1, 40, 300, 700]))
            if edits and rng.random() < 0.15:
                action = rng.choice(["space", "backspace", "clear", "char", "set_text", "backspace"])
                ch = {"char": rng.choice([".", "xy"]), "set_text": rng.choice(["", "hello"])}.get(action)
                rows.append((sid, now, seq, None, None, action, ch))
                continue
            if rng.random() < 0.35:
                letter = rng.choice(["A", "B", None])
            conf = None if letter is None else rng.choice([0.9, 0.9, 0.9, 0.5, 0.4])
            rows.append((sid, now, seq, letter, conf, None, None))
    return rows


SCHEMA = "sid long, ts timestamp, seq long, letter string, conf double, action string, ch string"
NAMES = ["sid", "ts", "seq", "letter", "conf", "action", "ch"]


def run_model(rows, *args, **kw):
    models = {}
    for r in rows:
        models.setdefault(r[0], Model(*args, **kw)).feed(dict(zip(NAMES, r)))
    return models


def frame(spark, rows):
    return spark.createDataFrame(rows, SCHEMA)


def test_commit_matches_model_with_edits(spark):
    rows = sessions(1, 150, True)
    df = frame(spark, rows).cache()
    for n, lost, part in [(3, True, 3), (2, False, 1), (1, True, 500_000), (4, True, 7)]:
        want = {
            (sid, s, c)
            for sid, m in run_model(rows, n, 0.5, lost_releases=lost).items() for s, c in m.commits
        }
        got = C.letter_commit(df, n, 0.5, lost, part, 0.2).collect()
        assert {(r.sid, r.seq, r.letter) for r in got} == want
        assert len(got) == len(want)


def test_text_fold_with_edits(spark):
    rows = sessions(2, 150, True)
    df = frame(spark, rows).cache()
    for chunk in (0.7, 86400.0):
        commits = C.letter_commit(df, 2, 0.5, True, 10, chunk)
        got = {r.sid: r.text for r in C.text_fold(C.text_items(commits, df), chunk).collect()}
        for sid, m in run_model(rows, 2, 0.5).items():
            assert got.get(sid, "") == m.text


def check_live(df, rows, part, bucket):
    want = run_model(rows, 2, 0.5, 1.0)
    settings = {"part_rows": part, "bucket_seconds": bucket}
    spaces = C.auto_space(df, 2, 0.5, 1.0, **settings)
    assert sorted((r.sid, r.seq) for r in spaces.collect()) == sorted(
        (sid, s) for sid, m in want.items() for s in m.spaces
    )
    got = {r.sid: r.text for r in C.live_text(df, 2, 0.5, 1.0, **settings).collect()}
    assert got == {sid: m.text for sid, m in want.items()}
    return spaces


def test_auto_space(spark):
    rows = sessions(3, 150, False)
    df = frame(spark, rows).cache()
    for part, bucket in ((2, 0.4), (500_000, 60.0)):
        spaces = check_live(df, rows, part, bucket)
        commits = C.letter_commit(df, 2, 0.5, True, part, bucket)
        text = C.text_fold(C.text_items(commits, None, spaces), 0.8).collect()
        got = {r.sid: r.text for r in text}
        assert all(got.get(sid, "") == m.text for sid, m in run_model(rows, 2, 0.5, 1.0).items())


@pytest.mark.parametrize("batch", [3, 10_000])
def test_spaces_and_edits_together(spark, batch):
    """Drops reach into earlier parts and meet the spaces that pauses have set there."""
    rows = sessions(13, 250, True)
    df = frame(spark, rows)
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", batch)
    try:
        for part, bucket in ((1, 0.1), (6, 0.3), (500_000, 60.0)):
            check_live(df, rows, part, bucket)
    finally:
        spark.conf.unset("spark.sql.execution.arrow.maxRecordsPerBatch")


def test_no_job_while_planning_and_even_parts(spark):
    rows = [(1, BASE + timedelta(milliseconds=40 * i), i, "AB"[i // 30 % 2], 0.9, None, None) for i in range(6_000)]
    rows += [(2, BASE, 10**6 + i, "A", 0.9, None, None) for i in range(50)]
    rows += [(None, BASE, 2 * 10**6 + i, "A", 0.9, None, None) for i in range(50)]
    df = frame(spark, rows)
    tracker = spark.sparkContext.statusTracker()
    spark.sparkContext.setJobGroup("planning", "planning")
    commits = C.letter_commit(df, 12, 0.5, True, 500, 1.0)
    text = C.live_text(df, 12, 0.5, 1.2, part_rows=500, bucket_seconds=1.0)
    assert not tracker.getJobIdsForGroup("planning")
    spark.sparkContext.setJobGroup("tests", "tests")
    sizes = [r["count"] for r in with_parts(df, 500, 1.0).groupBy("part").count().collect()]
    assert len(sizes) >= 14 and max(sizes) <= 525
    want = run_model(rows, 12, 0.5, 1.2)
    got = [(r.sid, r.seq, r.letter) for r in commits.collect()]
    assert sorted(got, key=str) == sorted(((sid, s, c) for sid, m in want.items() for s, c in m.commits), key=str)
    assert {r.sid: r.text for r in text.collect()} == {sid: m.text for sid, m in want.items()}


def test_transitions_compose_in_any_grouping():
    """Steps of a stretch cut anywhere, reduced in pieces and applied, give the whole."""
    rng = random.Random(21)
    for _ in range(400):
        steps, gap = [], 0
        for i in range(rng.randint(0, 14)):
            gap += rng.random() < 0.4
            kind = rng.choice(["push", "pop", "try", "try", "reset"])
            steps.append((kind, rng.choice("ab ") if kind == "push" else None, gap, i))

        def play(cuts):
            text, places = C.Text(), []
            for a, b in zip([0, *cuts], [*cuts, len(steps)]):
                edits = C.Edits((steps[a][2], 0) if a < len(steps) and a else None)
                for kind, ch, gap, i in steps[a:b]:
                    if kind == "try":
                        edits.attempt((gap, 0), (i, i))
                    else:
                        getattr(edits, kind)(*([ch] if ch else []))
                for op in edits.steps():
                    place = text.apply(*op)
                    places += [place] if place else []
                places += edits.spaces
            return "".join(text.chars), sorted(places)

        whole = C.Text(), []
        for kind, ch, gap, i in steps:
            place = whole[0].apply(kind, ch, (gap, 0) if kind == "try" else None, (i, i))
            whole[1].extend([place] if place else [])
        want = "".join(whole[0].chars), whole[1]
        n = len(steps)
        for cuts in ([], sorted(rng.sample(range(n + 1), min(n, 3))), list(range(n))):
            assert play(cuts) == want


def test_literal_runs(spark):
    def commits(letters, n):
        rows = [
            (1, BASE + timedelta(milliseconds=i), i, c if c != "-" else None, 0.9, None, None)
            for i, c in enumerate(letters)
        ]
        out = C.letter_commit(frame(spark, rows), n, 0.9, True, 5, 0.002)
        return "".join(r.letter for r in out.orderBy("seq").collect())

    assert commits("A" * 12 + "B" * 3 + "A" * 12, 12) == "A"
    assert commits("AAAAAA", 3) == "A"
    assert commits("AAA-AAA", 3) == "AA"
    assert commits("AAB" * 5, 3) == ""


def test_monotonic(spark):
    rng = random.Random(5)
    rows, want = [], {}
    for sid in range(40):
        last, t = 0, 0
        for i in range(rng.randint(1, 40)):
            t += rng.choice([-5, 0, 0, 1, 7])
            last = max(t, last + 1)
            seq = sid * 1000 + i
            rows.append((sid, seq, t))
            want[seq] = last
    df = spark.createDataFrame(rows, "sid long, seq long, ms long")
    for chunk in (7, 1_000_000):
        got = {r.seq: r.mono_ms for r in C.monotonic_ts(df, "ms", chunk).collect()}
        assert got == want


def _stream(spark, rows, parts, settings, output, delay=None):
    folder, out = scratch_path(spark, "frames"), scratch_path(spark, "out")
    size = max(1, -(-len(rows) // parts))
    for i in range(0, len(rows), size):
        # one file per arrival step; file order is arrival order
        frame(spark, rows[i:i + size]).coalesce(1).write.mode("append").parquet(folder)
    source = spark.readStream.schema(SCHEMA).option("maxFilesPerTrigger", 1).parquet(folder)
    query = (
        commit_stream(source, settings, output, delay).writeStream.outputMode("append")
        .format("parquet").option("path", out)
        .option("checkpointLocation", scratch_path(spark, "state"))
        .trigger(availableNow=True).start()
    )
    query.awaitTermination()
    return spark.read.parquet(out)


def test_stream_equals_model_for_any_batching(spark):
    rows = sorted(sessions(4, 30, True), key=lambda r: (r[1], r[2]))
    settings = CommitterSettings(2, 0.5, True, 1.0)
    want = run_model(rows, 2, 0.5, 1.0)
    for parts in (1, 5):
        shots = _stream(spark, rows, parts, settings, "snapshots")
        got = {r.sid: r.text for r in C.text_snapshot(shots).collect()}
        assert got == {sid: m.text for sid, m in want.items()}


def test_stream_events_equal_batch(spark):
    rows = sorted(sessions(6, 30, False), key=lambda r: (r[1], r[2]))
    df = frame(spark, rows)
    commits = C.letter_commit(df, 2, 0.5)
    spaces = C.auto_space(df, 2, 0.5, 1.0)
    events = _stream(spark, rows, 3, CommitterSettings(2, 0.5, True, 1.0), "events")
    got = {(r.sid, r.seq, r.letter) for r in events.collect()}
    want = {(r.sid, r.seq, r.letter) for r in commits.collect()}
    want |= {(r.sid, r.seq, " ") for r in spaces.collect()}
    assert got == want


def test_late_rows_wait_for_the_watermark(spark):
    rows = sorted(sessions(8, 12, True), key=lambda r: (r[1], r[2]))
    # arrival jumbled within one second; a far-off frame at the end moves the watermark
    rng = random.Random(9)
    jumbled = sorted(rows, key=lambda r: r[1] + timedelta(milliseconds=rng.randint(0, 900)))
    jumbled.append((99, BASE + timedelta(days=1), 10**6, None, None, None, None))
    settings = CommitterSettings(2, 0.5, True, 1.0)
    shots = _stream(spark, jumbled, 4, settings, "snapshots", "1 second")
    got = {r.sid: r.text for r in C.text_snapshot(shots).collect() if r.sid != 99}
    assert got == {sid: m.text for sid, m in run_model(rows, 2, 0.5, 1.0).items()}


def test_heartbeat_commits_what_waits_and_idle_sessions_end(spark):
    """Nothing waits for ever, and a session that comes back after its end starts anew."""
    rows = sorted(sessions(17, 12, True), key=lambda r: (r[1], r[2]))
    later = [
        (sid, BASE + timedelta(hours=2, milliseconds=40 * i), 10**5 + 10 * sid + i, "A", 0.9, None, None)
        for sid in range(3) for i in range(2)
    ]
    beats = [(None, BASE + timedelta(hours=h), 10**6 + h, None, None, None, None) for h in (1, 5)]
    settings = CommitterSettings(2, 0.5, True, 1.0)
    # in steps, so that the first heartbeat ends the sessions before they come back
    steps = [[*rows, beats[0]], [*later, beats[1]]]
    shots = _stream_steps(spark, steps, settings, "1 second", 600)
    first = run_model(rows, 2, 0.5, 1.0)
    got = {r.sid: r.text for r in C.text_snapshot(shots.where("seq < 100000")).collect()}
    assert got == {sid: m.text for sid, m in first.items()}
    again = {r.sid: r.text for r in C.text_snapshot(shots.where("seq >= 100000")).collect()}
    assert again == {0: "A", 1: "A", 2: "A"}


def _stream_steps(spark, steps, settings, delay, idle):
    folder, out, state = (scratch_path(spark, n) for n in ("frames", "out", "state"))
    for step in steps:
        frame(spark, step).coalesce(1).write.mode("append").parquet(folder)
        source = spark.readStream.schema(SCHEMA).parquet(folder)
        (
            commit_stream(source, settings, "snapshots", delay, idle).writeStream.outputMode("append")
            .format("parquet").option("path", out).option("checkpointLocation", state)
            .trigger(availableNow=True).start().awaitTermination()
        )
    return spark.read.parquet(out)


def test_upserts_are_idempotent(spark):
    schema = "sid long, ts timestamp, seq long, text string"
    table = LatestTable(scratch_path(spark, "upserts"), ["sid"], ["ts", "seq"], schema, 4)
    assert table.read(spark).count() == 0
    rng = random.Random(3)
    batches, newest = [], {}
    for n in range(5):
        rows = [(rng.choice([None, *range(20)]), BASE + timedelta(seconds=rng.randint(0, 50)), 100 * n + i, f"{n}-{i}")
                for i in range(30)]
        batches.append(spark.createDataFrame(rows, schema))
        for sid, ts, seq, text in rows:
            newest[sid] = max(newest.get(sid, (BASE, -1, "")), (ts, seq, text))
        table.upsert(batches[-1], n)
        if n % 2:
            table.upsert(batches[-1], n)  # the batch is run again
        assert {r.sid: r.text for r in table.read(spark).collect()} == {s: v[2] for s, v in newest.items()}
    # a batch that stopped before its manifest does not show, and is done again
    lost = spark.createDataFrame([(1, BASE + timedelta(days=1), 1, "lost")], schema)
    lost.selectExpr("*", "3 AS bucket").write.partitionBy("bucket").parquet(f"{table.path}/data/5")
    assert table.read(spark).where("text = 'lost'").isEmpty()
    table.upsert(lost, 5)
    assert table.read(spark).where("sid = 1").first().text == "lost"
    table.upsert(spark.createDataFrame([], schema), 6)
    assert table.read(spark).count() == len(newest)


def test_latest_wins_on_a_stream(spark):
    rng = random.Random(4)
    rows = [(rng.randint(0, 3), BASE + timedelta(seconds=2 * i + rng.randint(-40, 0)), i, "A", i / 500, None, None)
            for i in range(300)]
    late = (1, BASE - timedelta(hours=1), 999, "B", 0.1, None, None)
    folder = scratch_path(spark, "frames")
    for part in (rows[:100], rows[100:200], rows[200:], [late]):
        frame(spark, part).coalesce(1).write.mode("append").parquet(folder)
    source = spark.readStream.schema(SCHEMA).option("maxFilesPerTrigger", 1).parquet(folder)
    columns = ["ts", "seq", "letter", "conf"]
    table = LatestTable(scratch_path(spark, "latest"), ["sid", "window_start"], ["ts", "seq"],
                        "sid long, window_start timestamp, ts timestamp, seq long, letter string, conf double", 4)
    stream = C.latest_wins(source, "30 seconds", columns, delay="60 seconds")
    table.keep(stream, scratch_path(spark, "state"), "update").awaitTermination()
    want = C.latest_wins(frame(spark, rows), "30 seconds", columns)
    assert sorted(map(tuple, table.read(spark).collect())) == sorted(map(tuple, want.collect()))
