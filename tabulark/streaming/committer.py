"""From noisy per-frame letters to text: the stream form.

One keyed state per session. With a ``delay`` rows wait in state, in slices of time, until
the watermark has passed their slice; a timer for each slice hands it on. So a task holds
one slice of one session at a time, whatever waits. With ``idle`` a session that has been
silent for so long (by the watermark) is forgotten.

A watermark only moves with rows. A row without a session id is a heartbeat: it moves the
watermark and is dropped, so a source that ends can send one to have all that waits
committed and all idle state removed.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.streaming import StatefulProcessor, StatefulProcessorHandle

from tabulark import constants as K
from tabulark.operators.committer import with_actions
from tabulark.operators.ordered import micros

COMMITTER_STATE = (
    "run_letter string, run_length int, last string, text string, gap_start long, space_done boolean"
)
ROW = "at long, seq long, letter string, conf double, action string, ch string"
OUTPUT = "sid long, at long, seq long, event string, letter string, text string"
#: state of this kind needs a store with more than one column family
STATE_STORE = "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"
SLICE_MS = 1_000


@dataclass
class CommitterSettings:
    stable_frames: int = K.STABLE_FRAMES
    min_confidence: float = K.MIN_CONFIDENCE
    hand_lost_releases: bool = True
    gap_seconds: float | None = None

    def __post_init__(self) -> None:
        if self.stable_frames < 1:
            raise ValueError("stable_frames must be at least 1")


@dataclass
class Committer:
    """Text of one session. Of the recent frames only the trailing run matters."""

    settings: CommitterSettings
    run_letter: str | None = None
    run_length: int = 0
    last: str | None = None
    text: str = ""
    gap_start: int | None = None
    space_done: bool = False

    def release(self) -> None:
        self.run_letter, self.run_length, self.last = None, 0, None

    def accept(self, letter: str) -> str | None:
        self.run_length = self.run_length + 1 if letter == self.run_letter else 1
        self.run_letter = letter
        if self.run_length < self.settings.stable_frames:
            return None
        self.run_letter, self.run_length = None, 0
        if letter == self.last:
            return None
        self.last = letter
        self.text += letter
        return letter

    def edit(self, action: str, ch: str | None) -> None:
        self.last = None
        if action == "space":
            self.text += " "
        elif action == "char":
            self.text += ch or ""
        elif action == "backspace":
            self.text = self.text[:-1]
        else:
            self.text = (ch or "") if action == "set_text" else ""
            self.run_letter, self.run_length = None, 0

    def frame(self, micros: int, letter: str | None, conf: float | None) -> str | None:
        """Feed one frame; the letter or space it adds to the text, if any."""
        if letter is not None:
            self.gap_start, self.space_done = None, False
            if conf is None or not conf >= self.settings.min_confidence:
                self.release()
                return None
            return self.accept(letter)
        if self.gap_start is None:
            self.gap_start = micros
        if self.settings.hand_lost_releases:
            self.release()
        gap = self.settings.gap_seconds
        if gap is None or self.space_done or not self.text or self.text.endswith(" "):
            return None
        if micros - self.gap_start < int(round(gap * 1_000_000)):
            return None
        self.edit("space", None)
        self.space_done = True
        return " "


def _missing(value) -> bool:
    return value is None or value != value


class _Sessions(StatefulProcessor):
    """The committer of each session, its waiting rows by slice of time, and the time of the
    timer that ends it."""

    def __init__(self, settings: CommitterSettings, output: str, waits: bool, idle_ms: int | None):
        self.settings, self.output, self.waits, self.idle_ms = settings, output, waits, idle_ms

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.handle = handle
        self.committer = handle.getValueState("committer", COMMITTER_STATE)
        if self.waits:
            self.slices = handle.getMapState("slices", "slice long", f"rows array<struct<{_fields(ROW)}>>")
        if self.idle_ms is not None:
            self.ends = handle.getValueState("ends", "ms long")

    def close(self) -> None:
        pass

    def handleInputRows(self, key, rows, timerValues) -> Iterator[pd.DataFrame]:
        parts = [part[ROW_NAMES] for part in rows]
        if _missing(key[0]):  # a heartbeat; a filter before would be moved below the watermark
            return
        if self.idle_ms is not None:
            newest = max(int(part["at"].max()) for part in parts) // 1000
            self._put_off(newest + self.idle_ms)
        if not self.waits:
            yield self._advance(key, pd.concat(parts))
            return
        for part in parts:
            for number, some in part.groupby(part["at"] // (SLICE_MS * 1000)):
                held = self.slices.getValue((int(number),)) if self.slices.containsKey((int(number),)) else None
                if held is None:
                    # rows that the watermark lets through may belong to a slice it has passed
                    due = max((int(number) + 1) * SLICE_MS, timerValues.getCurrentWatermarkInMs() + 1)
                    self.handle.registerTimer(due)
                known = [tuple(r) for r in held[0]] if held else []
                self.slices.updateValue((int(number),), ([*known, *_tuples(some)],))

    def handleExpiredTimer(self, key, timerValues, expiredTimerInfo) -> Iterator[pd.DataFrame]:
        passed = timerValues.getCurrentWatermarkInMs()
        if self.waits:
            due = sorted(n for (n,) in self.slices.keys() if (n + 1) * SLICE_MS <= passed)
            for number in due:
                held = [tuple(r) for r in self.slices.getValue((number,))[0]]
                self.slices.removeKey((number,))
                yield self._advance(key, pd.DataFrame(held, columns=ROW_NAMES))
        if self.idle_ms is not None and self.ends.exists() and self.ends.get()[0] <= passed:
            self.ends.clear()
            self.committer.clear()

    def _put_off(self, end: int) -> None:
        """The session ends at ``end`` at the earliest."""
        before = self.ends.get()[0] if self.ends.exists() else None
        if before is None or before < end:
            if before is not None:
                self.handle.deleteTimer(before)
            self.ends.update((end,))
            self.handle.registerTimer(end)

    def _advance(self, key, rows: pd.DataFrame) -> pd.DataFrame:
        """Feed rows to the committer in order; what they change."""
        state = self.committer.get() if self.committer.exists() else ()
        committer = Committer(self.settings, *state)
        out, place = [], None
        for at, seq, letter, conf, action, ch in sorted(_tuples(rows), key=lambda r: r[:2]):
            place = at, seq
            if action is not None:
                committer.edit(action, ch)
                continue
            added = committer.frame(at, letter, conf)
            if added is not None and self.output == "events":
                out.append((key[0], at, seq, "space" if added == " " else "letter", added, None))
        if self.output == "snapshots" and place:
            out.append((key[0], *place, "snapshot", None, committer.text))
        self.committer.update((
            committer.run_letter, committer.run_length, committer.last, committer.text,
            committer.gap_start, committer.space_done,
        ))
        return pd.DataFrame(out, columns=["sid", "at", "seq", "event", "letter", "text"])


ROW_NAMES = [f.split()[0] for f in ROW.split(",")]


def _fields(schema: str) -> str:
    return schema.replace(" long", ": long").replace(" string", ": string").replace(" double", ": double")


def _tuples(rows: pd.DataFrame) -> list[tuple]:
    """Rows as (at, seq, letter, conf, action, ch) of plain values."""
    return [
        (int(at), int(seq), *[None if _missing(v) else v for v in rest])
        for at, seq, *rest in rows[ROW_NAMES].itertuples(index=False, name=None)
    ]


def commit_stream(
    frames: DataFrame,
    settings: CommitterSettings,
    output: str = "events",
    delay: str | None = None,
    idle_seconds: float | None = None,
) -> DataFrame:
    """Committed letters and automatic spaces (``events``), or the text of each session that
    a micro-batch touches (``snapshots``); for append sinks.

    Rows are put in (ts, seq) order; an action precedes the frame it arrives with
    by its ``seq``. Without ``delay`` the source is taken to be in order per session
    and rows are used on arrival; its batches should be bounded (files or offsets per
    trigger). With ``delay`` rows wait until the watermark has passed them, so the result
    does not depend on how rows that are at most that late fall into micro-batches. With
    ``idle_seconds`` a session ends after so long without a row, by event time; a later row
    begins it anew. Rows without a session id only move the watermark.

    Needs the state store ``STATE_STORE`` in ``spark.sql.streaming.stateStore.providerClass``.
    """
    rows = with_actions(frames).select(
        F.col("sid").cast("long").alias("sid"), "ts", micros(F.col("ts")).alias("at"), "seq",
        # NaN is no smaller than the least confidence and passes, null does not
        "letter", F.when(F.isnan("conf"), F.lit(float("inf"))).otherwise(F.col("conf")).alias("conf"),
        "action", "ch",
    )
    timed = delay is not None or idle_seconds is not None
    if timed:
        rows = rows.withWatermark("ts", delay or f"{max(idle_seconds, 1)} seconds")
    idle_ms = None if idle_seconds is None else int(idle_seconds * 1000)
    frames.sparkSession.conf.set("spark.sql.streaming.stateStore.providerClass", STATE_STORE)
    changes = rows.groupBy("sid").transformWithStateInPandas(
        _Sessions(settings, output, delay is not None, idle_ms), OUTPUT, "append",
        "EventTime" if timed else "None",
    )
    return changes.select(
        "sid", F.timestamp_micros("at").alias("ts"), "seq", "event", "letter", "text"
    )
