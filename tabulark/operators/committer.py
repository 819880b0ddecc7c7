"""From noisy per-frame letters to text: the batch form.

Rows are ordered by (ts, seq) inside a session ``sid``. A frame row has a
``letter`` (null: no hand) and ``conf``; an action row has ``action`` in
space, backspace, clear, char, set_text and, for the last two, ``ch``.
"""

from __future__ import annotations

from collections.abc import Sequence

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tabulark import constants as K
from tabulark.operators.borders import BUCKET_SECONDS, PART, PART_ROWS, carried_states, fields, runs, with_parts
from tabulark.operators.ordered import CHUNK, Chunks, micros, sequence_chunk


def confidence_gate(letter: Column, conf: Column, min_confidence: float) -> Column:
    """True for an accepted frame, false for a release."""
    return F.coalesce((conf >= min_confidence) & letter.isNotNull(), F.lit(False))


def with_actions(df: DataFrame) -> DataFrame:
    """Add empty action columns to a table of plain frames."""
    for c in ("action", "ch"):
        if c not in df.columns:
            df = df.withColumn(c, F.lit(None).cast("string"))
    return df


class Frames:
    """A stretch of a session's rows in order, as arrays."""

    def __init__(self, batch: pa.RecordBatch, min_confidence: float, lost_releases: bool):
        letter = batch.column("letter")
        self.letters = letter
        self.at = batch.column("at").to_numpy(zero_copy_only=False)
        self.seq = batch.column("seq").to_numpy(zero_copy_only=False)
        hand = pc.is_valid(letter).to_numpy(zero_copy_only=False)
        action = batch.column("action")
        self.is_action = pc.is_valid(action).to_numpy(zero_copy_only=False)
        conf = pc.greater_equal(batch.column("conf"), min_confidence)
        sure = pc.fill_null(conf, False).to_numpy(zero_copy_only=False)
        self.accepted = ~self.is_action & hand & sure
        self.away = ~self.is_action & ~hand
        self.hand = ~self.is_action & hand
        release = ~self.is_action & ~self.accepted
        if not lost_releases:
            release &= hand
        wipes = pc.is_in(action, pa.array(["clear", "set_text"])).to_numpy(zero_copy_only=False)
        self.hard = release | (self.is_action & wipes)
        self.rearm = release | self.is_action
        self.marks = np.flatnonzero(self.accepted | self.hard)
        code = pc.fill_null(letter.dictionary_encode().indices, -1).to_numpy(zero_copy_only=False)
        marked = np.where(self.hard[self.marks], -2, code[self.marks])
        change = np.ones(len(marked), bool)
        change[1:] = (marked[1:] != marked[:-1]) | (marked[1:] == -2)
        #: marks where a run begins (a hard break is one of its own), each mark's run and place in it
        self.starts = np.flatnonzero(change)
        self.run = np.cumsum(change) - 1
        self.place = np.arange(1, len(marked) + 1) - self.starts[self.run] if len(marked) else marked
        self.run_hard = marked[self.starts] == -2

    def letter(self, i: int) -> str:
        return self.letters[int(i)].as_py()

    def triggers(self, stable: int, letter: str | None = None, length: int = 0) -> np.ndarray:
        """Marks that close a run of ``stable`` frames, a run of ``length`` times ``letter``
        going on from before."""
        if not len(self.marks):
            return self.marks
        before = np.zeros(len(self.starts), np.int64)
        if not self.run_hard[0] and self.letter(self.marks[0]) == letter:
            before[0] = length
        return np.flatnonzero(~self.run_hard[self.run] & ((self.place + before[self.run]) % stable == 0))

    def gap_starts(self, at: int | None, seq: int | None) -> tuple[np.ndarray, np.ndarray]:
        """For each row the start (time, number) of the pause it lies in, given the one that
        goes on from before (None: none); only of meaning for rows without a hand."""
        hands = np.cumsum(self.hand)
        begins = np.flatnonzero(self.away)
        _, first = np.unique(hands[begins], return_index=True)
        begins = begins[first]
        start = np.zeros(int(hands[-1]) + 1 if len(hands) else 1, np.int64)
        start_seq = np.zeros_like(start)
        start[hands[begins]], start_seq[hands[begins]] = self.at[begins], self.seq[begins]
        if at is not None:
            start[0], start_seq[0] = at, seq
        return start[hands], start_seq[hands]


START = {"run_letter": None, "run_length": 0, "last": None, "gap_at": None, "gap_seq": None}
STATE = "run_letter string, run_length long, last string, gap_at long, gap_seq long"
SUMMARY = (
    "piece long, head_letter string, head_length long, head_only boolean, head_from long, "
    "tail_letter string, tail_length long, marks boolean, rearmed boolean, known_last string, "
    "hands boolean, new_gap_at long, new_gap_seq long"
)


def summary(f: Frames, stable: int) -> dict:
    """How a stretch of frames changes a session's state, whatever that is.

    The first run may go on from before, so its length and the place of the last re-arming
    in it (``head_from``) are kept; everything after it is known.
    """
    out = dict.fromkeys(fields(SUMMARY))
    rearms = np.flatnonzero(f.rearm)
    last_rearm = int(rearms[-1]) if len(rearms) else -1
    out |= {"marks": bool(len(f.marks)), "rearmed": last_rearm >= 0, "head_length": 0, "tail_length": 0,
            "head_only": False, "head_from": -1, "hands": bool(f.hand.any())}
    if len(f.marks):
        sizes = np.diff(np.append(f.starts, len(f.marks)))
        if not f.run_hard[0]:
            head = f.marks[: sizes[0]]
            out |= {"head_letter": f.letter(head[0]), "head_length": int(sizes[0]),
                    "head_only": len(sizes) == 1}
            if last_rearm < head[-1]:
                out["head_from"] = int((head < last_rearm).sum())
        if not f.run_hard[-1]:
            out |= {"tail_letter": f.letter(f.marks[-1]), "tail_length": int(sizes[-1])}
        closed = f.triggers(stable)
        closed = closed[f.marks[closed] > last_rearm]
        if not f.run_hard[0]:
            closed = closed[f.run[closed] > 0]
        if len(closed):
            out["known_last"] = f.letter(f.marks[closed[-1]])
    hands = np.flatnonzero(f.hand)
    away = np.flatnonzero(f.away)
    away = away[away > hands[-1]] if len(hands) else away
    if len(away):
        out |= {"new_gap_at": int(f.at[away[0]]), "new_gap_seq": int(f.seq[away[0]])}
    return out


def after(state: dict, s: dict, stable: int) -> dict:
    """The state behind a stretch of frames, from the one before it and its summary."""
    base = state["run_length"] if s["head_length"] and state["run_letter"] == s["head_letter"] else 0
    out = dict(state)
    if s["known_last"] is not None:
        out["last"] = s["known_last"]
    else:
        if s["rearmed"]:
            out["last"] = None
        start = s["head_from"]
        if start >= 0 and (base + s["head_length"]) // stable > (base + start) // stable:
            out["last"] = s["head_letter"]
    if s["marks"]:
        if s["head_only"]:
            out["run_letter"], length = s["head_letter"], base + s["head_length"]
        else:
            out["run_letter"], length = s["tail_letter"], s["tail_length"]
        out["run_length"] = length % stable
    if s["hands"] or state["gap_at"] is None:
        out["gap_at"], out["gap_seq"] = s["new_gap_at"], s["new_gap_seq"]
    return out


def commits_of(f: Frames, state: dict, stable: int) -> np.ndarray:
    """Rows whose letter commits, given the state before."""
    closed = f.triggers(stable, state["run_letter"], state["run_length"])
    rows = f.marks[closed]
    if not len(rows):
        return rows
    epoch = np.cumsum(f.rearm)[rows]
    letters = f.letters.take(pa.array(rows)).to_pylist()
    before = [state["last"] if epoch[0] == 0 else None, *letters[:-1]]
    same_epoch = np.concatenate([[True], epoch[1:] == epoch[:-1]])
    held = same_epoch & np.array([x == y for x, y in zip(letters, before)])
    return rows[~held]


def _parts_and_states(
    frames: DataFrame, stable: int, min_confidence: float, lost_releases: bool,
    part_rows: int, bucket_seconds: float,
) -> DataFrame:
    """Rows of all parts, each with the state in which its part begins, in order."""
    if stable < 1:
        raise ValueError("stable_frames must be at least 1")
    rows = with_parts(with_actions(frames), part_rows, bucket_seconds).select(
        PART, "at", F.col("seq").cast("long").alias("seq"), F.col("letter").cast("string").alias("letter"),
        # NaN is no smaller than the least confidence and passes, null does not
        F.when(F.isnan("conf"), F.lit(float("inf"))).otherwise(F.col("conf")).cast("double").alias("conf"),
        F.col("action").cast("string").alias("action"), F.col("ch").cast("string").alias("ch"),
    )
    in_order = [F.col(f"{PART}.sid"), F.col(f"{PART}.number"), "at", "seq"]

    def summarise(batches):
        piece = 0
        for begins, run in runs(batches):
            piece = 0 if begins else piece + 1
            found = summary(Frames(run, min_confidence, lost_releases), stable)
            found |= {"piece": piece}
            arrays = [run.column(PART).slice(0, 1)]
            arrays += [pa.array([found[n]], t) for n, t in kinds.items()]
            yield pa.RecordBatch.from_arrays(arrays, [PART, *kinds])

    kinds = fields(SUMMARY)
    part_type = rows.schema[PART].dataType.simpleString()
    summaries = rows.sortWithinPartitions(*in_order).mapInArrow(summarise, f"{PART} {part_type}, {SUMMARY}")
    states = carried_states(summaries, START, lambda state, s: after(state, s, stable), STATE)
    joined = rows.join(states, F.col(PART) == F.col("of_part")).drop("of_part")
    return joined.sortWithinPartitions(*in_order)


def _with_states(batches, stable: int, min_confidence: float, lost_releases: bool):
    """(whether a part begins, rows, frames, state before) of each stretch of rows."""
    state = None
    for begins, run in runs(batches):
        if begins:
            state = {n: run.column(n)[0].as_py() for n in START}
        f = Frames(run, min_confidence, lost_releases)
        yield begins, run, f, state
        state = after(state, summary(f, stable), stable)


def letter_commit(
    frames: DataFrame,
    stable_frames: int = K.STABLE_FRAMES,
    min_confidence: float = K.MIN_CONFIDENCE,
    hand_lost_releases: bool = True,
    part_rows: int = PART_ROWS,
    bucket_seconds: float = BUCKET_SECONDS,
) -> DataFrame:
    """Committed letters: (sid, ts, seq, letter) of the frame that completes one.

    A letter commits when it closes a run of ``stable_frames`` equal accepted
    frames, unless it repeats the previous full run without a release or an edit
    in between.
    """
    settings = stable_frames, min_confidence, hand_lost_releases
    rows = _parts_and_states(frames, *settings, part_rows, bucket_seconds)

    def commit(batches):
        for _, run, f, state in _with_states(batches, *settings):
            at = pa.array(commits_of(f, state, stable_frames))
            some = run.take(at)
            yield pa.RecordBatch.from_arrays(
                [some.column(PART).field(0), some.column("at"), some.column("seq"), some.column("letter")],
                ["sid", "at", "seq", "letter"],
            )

    sid = frames.schema["sid"].dataType.simpleString()
    found = rows.mapInArrow(commit, f"sid {sid}, at long, seq long, letter string")
    return found.select("sid", _time(frames), F.col("seq").cast(frames.schema["seq"].dataType).alias("seq"), "letter")


def _time(frames: DataFrame) -> Column:
    return F.timestamp_micros("at").cast(frames.schema["ts"].dataType).alias("ts")


class Edits:
    """What a stretch of a session does to its text: a composable transition.

    Characters that are pushed and dropped again cancel; an automatic space is settled as
    soon as the end of the text is known. What stays open needs the text before: drops
    beyond the stretch's own characters, and tries to set a space on such a text. Appending
    the open steps of a later stretch to those of an earlier one gives the steps of both,
    in any grouping.
    """

    def __init__(self, gap: tuple | None = None):
        #: (kind, character or None, pause or None, (time, number) or None)
        self.ops: list[tuple] = []
        #: the pause that was under way at the start, of which a space may have been set already
        self.open_gap = gap
        self.gap: tuple | None = gap
        self.done: bool | None = None if gap else False
        self.spaces: list[tuple] = []

    def push(self, text: str) -> None:
        self.ops += [("push", c, None, None) for c in text]

    def pop(self) -> None:
        last = self.ops[-1][0] if self.ops else None
        if last == "push":
            self.ops.pop()
        elif last != "reset":  # an empty text stays empty
            self.ops.append(("pop", None, None, None))

    def reset(self) -> None:
        # open tries may have set spaces: those are still to be told
        if not any(o[0] == "try" for o in self.ops):
            self.ops.clear()
        self.ops.append(("reset", None, None, None))

    def attempt(self, gap: tuple, place: tuple) -> None:
        """A moment in a pause that has lasted long enough: a space, once a pause, if the
        text ends in something else."""
        if gap != self.gap:
            self.gap, self.done = gap, False
        if self.done:
            return
        last = self.ops[-1] if self.ops else None
        if self.done is False and last and last[0] in ("push", "reset"):
            if last[0] == "push" and last[1] != " ":
                self.push(" ")
                self.done = True
                self.spaces.append(place)
            return
        self.ops.append(("try", None, gap, place))
        self.done = None

    def steps(self) -> list[tuple]:
        """The open steps, and that the pause under way has got its space if so."""
        return [*self.ops, ("spaced", None, self.gap, None)] if self.done else self.ops

    def step(self, action: str, ch: str | None) -> None:
        if action == "space":
            self.push(" ")
        elif action == "char":
            self.push(ch or "")
        elif action == "backspace":
            self.pop()
        elif action in ("clear", "set_text"):
            self.reset()
            if action == "set_text":
                self.push(ch or "")


class Text:
    """The text of a session, and the pause that has got its space."""

    def __init__(self):
        self.chars: list[str] = []
        self.spaced: tuple | None = None

    def apply(self, kind: str, ch: str | None, gap: tuple | None, place: tuple | None) -> tuple | None:
        """One open step; the place of the space that it sets, if any."""
        if kind == "push":
            self.chars += ch
        elif kind == "pop":
            if self.chars:
                self.chars.pop()
        elif kind == "reset":
            self.chars.clear()
        elif kind == "spaced":
            self.spaced = gap
        elif gap != self.spaced and self.chars and self.chars[-1] != " ":
            self.chars.append(" ")
            self.spaced = gap
            return place
        return None


EDITS = (
    "ops array<struct<kind: string, ch: string, gap_at: long, gap_seq: long, at: long, seq: long>>, "
    "spaces array<struct<at: long, seq: long>>"
)


def _ops_array(ops: list[tuple]) -> list[dict]:
    """Steps for a row; neighbouring characters are one string."""
    out: list[dict] = []
    for kind, ch, gap, place in ops:
        if kind == "push" and out and out[-1]["kind"] == "push":
            out[-1]["ch"].append(ch)
            continue
        gap, place = gap or (None, None), place or (None, None)
        out.append({"kind": kind, "ch": [ch] if kind == "push" else None, "gap_at": gap[0],
                    "gap_seq": gap[1], "at": place[0], "seq": place[1]})
    for o in out:
        o["ch"] = "".join(o["ch"]) if o["ch"] is not None else None
    return out


def _edits_row(part: pa.Array, edits: Edits) -> pa.RecordBatch:
    place = [("at", pa.int64()), ("seq", pa.int64())]
    op = pa.struct([("kind", pa.string()), ("ch", pa.string()), ("gap_at", pa.int64()), ("gap_seq", pa.int64()), *place])
    spaces = [{"at": at, "seq": seq} for at, seq in edits.spaces]
    return pa.RecordBatch.from_arrays(
        [part, pa.array([_ops_array(edits.steps())], pa.list_(op)), pa.array([spaces], pa.list_(pa.struct(place)))],
        [PART, "ops", "spaces"],
    )


def live_edits(
    frames: DataFrame,
    stable_frames: int = K.LIVE_STABLE_FRAMES,
    min_confidence: float = K.LIVE_MIN_CONFIDENCE,
    gap_seconds: float | None = K.GAP_SECONDS,
    part_rows: int = PART_ROWS,
    bucket_seconds: float = BUCKET_SECONDS,
) -> DataFrame:
    """One row for each part of a session: what it does to the text as far as the part alone
    tells (``ops``), the places of the automatic spaces it has settled (``spaces``) and the
    number of letters it commits. Committed letters, automatic spaces and edits meet in the
    order of the rows; a hand that is lost is a release."""
    settings = stable_frames, min_confidence, True
    rows = _parts_and_states(frames, *settings, part_rows, bucket_seconds)
    wait = None if gap_seconds is None else int(round(gap_seconds * 1_000_000))

    def changes(batches):
        edits, part = None, None

        for begins, run, f, state in _with_states(batches, *settings):
            if begins:
                if edits is not None:
                    yield _edits_row(part, edits)
                gap = (state["gap_at"], state["gap_seq"])
                edits, part = Edits(gap if gap[0] is not None else None), run.column(PART).slice(0, 1)
            events = {int(i): None for i in commits_of(f, state, stable_frames)}
            events |= {int(i): None for i in np.flatnonzero(f.is_action)}
            if wait is not None:
                start, start_seq = f.gap_starts(state["gap_at"], state["gap_seq"])
                reached = f.away & (f.at - start >= wait)
                # between two such rows side by side nothing changes the text
                fresh = reached & ~np.concatenate([[False], reached[:-1]])
                events |= {int(i): (int(start[i]), int(start_seq[i])) for i in np.flatnonzero(fresh)}
            actions, chs = run.column("action"), run.column("ch")
            for i in sorted(events):
                if events[i] is not None:
                    edits.attempt(events[i], (int(f.at[i]), int(f.seq[i])))
                elif f.is_action[i]:
                    edits.step(actions[i].as_py(), chs[i].as_py())
                else:
                    edits.push(f.letter(i))
        if edits is not None:
            yield _edits_row(part, edits)

    part_type = rows.schema[PART].dataType.simpleString()
    return rows.mapInArrow(changes, f"{PART} {part_type}, {EDITS}")


def _folded(edits: DataFrame, with_spaces: bool) -> DataFrame:
    """The parts of each session one after the other: its text at the end, or the places of
    the spaces that only the text before a part could settle."""
    sid_type = edits.schema[PART].dataType["sid"].dataType.simpleString()

    def fold(batches):
        text = sid = None
        for batch in batches:
            out, kind = [], batch.column(PART).field(0).type
            for part, ops, spaces in zip(*(batch.column(c).to_pylist() for c in (PART, "ops", "spaces"))):
                if text is None or part["sid"] != sid:
                    if text is not None and not with_spaces:
                        out.append((sid, "".join(text.chars)))
                    text, sid = Text(), part["sid"]
                for o in ops:
                    gap = o["gap_at"], o["gap_seq"]
                    place = text.apply(o["kind"], o["ch"], gap, (o["at"], o["seq"]))
                    if place and with_spaces:
                        out.append((sid, *place))
                if with_spaces:
                    out += [(sid, s["at"], s["seq"]) for s in spaces]
            yield rows(out, kind)
        if text is not None and not with_spaces:
            yield rows([(sid, "".join(text.chars))], kind)

    def rows(out, kind):
        kinds = [kind, pa.int64(), pa.int64()] if with_spaces else [kind, pa.string()]
        columns = list(zip(*out)) or [[] for _ in kinds]
        names = ["sid", "at", "seq"] if with_spaces else ["sid", "text"]
        return pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(columns, kinds)], names)

    schema = f"sid {sid_type}, " + ("at long, seq long" if with_spaces else "text string")
    dealt = edits.withColumn("sid", F.col(f"{PART}.sid")).repartition("sid")
    ordered = dealt.sortWithinPartitions("sid", F.col(f"{PART}.number"))
    return ordered.drop("sid").mapInArrow(fold, schema)


def live_text(frames: DataFrame, *args, **settings) -> DataFrame:
    """Text of each session: (sid, text), from committed letters, spaces set by pauses and
    manual edits. See ``live_edits`` for the settings."""
    return _folded(live_edits(frames, *args, **settings), False)


def auto_space(frames: DataFrame, *args, **settings) -> DataFrame:
    """Spaces set by pauses: (sid, ts, seq) of the no-hand frame that sets one.

    A pause sets one space, as soon as it has lasted ``gap_seconds`` and the text, edits
    included, ends in something other than a space. See ``live_edits`` for the settings.
    """
    found = _folded(live_edits(frames, *args, **settings), True)
    seq = F.col("seq").cast(frames.schema["seq"].dataType).alias("seq")
    return found.select("sid", _time(frames), seq)


def text_items(
    commits: DataFrame, actions: DataFrame | None = None, spaces: DataFrame | None = None
) -> DataFrame:
    """Everything that changes the text, one row per pushed or dropped character:
    (sid, ts, seq, sub, kind, ch) with kind push, pop or reset."""

    def items(df: DataFrame, kind: Column, ch: Column, sub: Column) -> DataFrame:
        return df.select("sid", "ts", "seq", sub.alias("sub"), kind.alias("kind"), ch.alias("ch"))

    out = items(commits, F.lit("push"), F.col("letter"), F.lit(0))
    if spaces is not None:
        out = out.unionByName(items(spaces, F.lit("push"), F.lit(" "), F.lit(0)))
    if actions is not None:
        pushed = F.when(F.col("action") == "space", F.lit(" ")).when(
            F.col("action").isin("char", "set_text"), F.coalesce("ch", F.lit(""))
        ).otherwise(F.lit(""))
        chars = F.filter(F.split(pushed, ""), lambda c: c != "")
        steps = F.concat(
            F.when(
                F.col("action").isin("clear", "set_text"),
                F.array(F.struct(F.lit("reset").alias("kind"), F.lit(None).cast("string").alias("ch"))),
            ).when(
                F.col("action") == "backspace",
                F.array(F.struct(F.lit("pop").alias("kind"), F.lit(None).cast("string").alias("ch"))),
            ).otherwise(F.expr("CAST(array() AS array<struct<kind: string, ch: string>>)")),
            F.transform(chars, lambda c: F.struct(F.lit("push").alias("kind"), c.alias("ch"))),
        )
        exploded = actions.where("action IS NOT NULL").select(
            "sid", "ts", "seq", F.posexplode(steps).alias("sub", "step")
        )
        out = out.unionByName(
            items(exploded, F.col("step.kind"), F.col("step.ch"), F.col("sub"))
        )
    return out


def text_fold(items: DataFrame, bucket_seconds: float = 3_600.0) -> DataFrame:
    """Final text per session: (sid, text).

    The items of a session and hour are reduced to what they do to the text before them
    (drops and characters that cancel are gone), and these reductions are applied one
    after the other.
    """
    hour = F.floor(micros(F.col("ts")) / int(bucket_seconds * 1_000_000))
    rows = items.select(F.struct("sid", hour.alias("number")).alias(PART), micros(F.col("ts")).alias("at"),
                        "seq", "sub", "kind", "ch")
    ordered = rows.repartition(PART).sortWithinPartitions(
        F.col(f"{PART}.sid"), F.col(f"{PART}.number"), "at", "seq", "sub"
    )

    def reduce(batches):
        edits, part = None, None
        for begins, run in runs(batches):
            if begins:
                if edits is not None:
                    yield _edits_row(part, edits)
                edits, part = Edits(), run.column(PART).slice(0, 1)
            for kind, ch in zip(run.column("kind").to_pylist(), run.column("ch").to_pylist()):
                if kind == "push":
                    edits.push(ch or "")
                elif kind == "pop":
                    edits.pop()
                else:
                    edits.reset()
        if edits is not None:
            yield _edits_row(part, edits)

    part_type = rows.schema[PART].dataType.simpleString()
    return _folded(ordered.mapInArrow(reduce, f"{PART} {part_type}, {EDITS}"), False)


def text_snapshot(snapshots: DataFrame) -> DataFrame:
    """Latest known text of each session from a log of snapshots."""
    newest = F.max_by(F.struct("ts", "seq", "text"), F.struct("ts", "seq"))
    return snapshots.groupBy("sid").agg(newest.alias("s")).select("sid", "s.text")


def monotonic_ts(
    frames: DataFrame, millis: str, chunk_rows: int = 1_000_000
) -> DataFrame:
    """Strictly increasing milliseconds in arrival order (``seq``): each at least
    one after the last. Closed form: the i-th value is i plus the largest excess
    of a value over its own number so far, if positive."""
    order = Chunks(["sid"], ["seq"])
    rows = frames.withColumn(CHUNK, sequence_chunk(F.col("seq"), chunk_rows))
    rows = rows.withColumn("_n", F.row_number().over(order.lag_rows()))
    rows = rows.withColumns(
        {
            "_excess": F.max(F.col(millis) - F.col("_n")).over(order.rows()),
            "_tail": order.is_tail(),
        }
    )
    chunks = rows.where("_tail").select(
        "sid", CHUNK, "_n", F.col("_excess").alias("_top"),
        F.coalesce(F.sum("_n").over(order.earlier()), F.lit(0)).alias("_offset"),
    )
    chunks = chunks.withColumn("_best", F.max(F.col("_top") - F.col("_offset")).over(order.earlier()))
    rows = order.attach(rows, chunks, ["_offset", "_best"])
    excess = F.col("_excess") - F.col("_offset")
    return rows.withColumn(
        "mono_ms", F.col("_n") + F.col("_offset") + F.greatest(F.lit(0), excess, F.col("_best"))
    ).select(*frames.columns, "mono_ms")


def latest_wins(
    frames: DataFrame, every: str, columns: Sequence[str], delay: str | None = None
) -> DataFrame:
    """What a consumer that wakes up once per interval sees: the newest frame of
    each session and interval; older ones are superseded before the shuffle.

    On a stream ``delay`` is how late a frame may come: the watermark closes an interval
    so long after its end, and frames of closed intervals are dropped. In update mode each
    micro-batch gives the intervals it changes, in append mode the closed ones."""
    if delay is not None:
        frames = frames.withWatermark("ts", delay)
    newest = F.max_by(F.struct(*columns), F.struct("ts", "seq"))
    return (
        frames.groupBy("sid", F.window("ts", every).alias("w"))
        .agg(newest.alias("f"))
        .select("sid", F.col("w.start").alias("window_start"), "f.*")
    )
