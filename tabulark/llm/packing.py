"""Documents packed into sequences of a fixed number of tokens, by bounded-space best fit.

A document is its token ids and an end mark. Only what is longer than a sequence is cut,
into full pieces and a rest. Each task places its pieces as they come: into the open
sequence with the least free space that holds the piece, else into a new one. A bitset
with one bit for each amount of free space finds it in one step. A task keeps at most
``open_bins`` sequences open; the fullest closes first.

What a task leaves open is placed again, as pieces of its used length, together with what
``fan_in`` - 1 other tasks left open, in rounds until one group remains. So every group
holds at most ``fan_in * open_bins`` rows, whatever the size of the table.

The rows are staged before the rounds: the order in which a task met its pieces does not
matter any more afterwards, and a lost executor changes nothing.

Defined results: a null text counts as empty and is one piece, its end mark. Repeated
rows and null ids are documents of their own. An empty table gives no rows. Columns other
than id and text are not read.
"""

from __future__ import annotations

import zlib
from collections import defaultdict
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tabulark.llm.batches import Stages, slices
from tabulark.llm.word_table import word_table

CAPACITY, OPEN_BINS, FAN_IN = 4_096, 512, 8
#: sequence numbers: round, group of the round, sequence of the group
ROUND_STEP, GROUP_STEP = 1 << 57, 1 << 31


class OpenBins:
    """Open sequences by their free space."""

    def __init__(self, capacity: int, most: int):
        self.capacity, self.most = capacity, most
        self.by_free: dict[int, list[int]] = defaultdict(list)
        self.mask = self.count = self.made = 0

    def _take(self, free: int) -> int:
        bins = self.by_free[free]
        taken = bins.pop()
        if not bins:
            self.mask ^= 1 << free
        self.count -= 1
        return taken

    def place(self, size: int) -> tuple[int, int]:
        """(sequence, offset) for a piece of ``size`` tokens."""
        fits = self.mask >> size
        if fits:
            free = size + (fits & -fits).bit_length() - 1
            found = self._take(free)
        else:
            free, found = self.capacity, self.made
            self.made += 1
        if free > size:
            if self.count == self.most:  # the fullest closes
                self._take((self.mask & -self.mask).bit_length() - 1)
            self.by_free[free - size].append(found)
            self.mask |= 1 << (free - size)
            self.count += 1
        return found, self.capacity - free

    def still_open(self) -> list[tuple[int, int]]:
        """(sequence, used tokens) of those that are open."""
        return sorted((b, self.capacity - free) for free, bins in self.by_free.items() for b in bins)


def pieces_of(n_ids: int, capacity: int) -> Iterator[tuple[int, int, int]]:
    """(piece, start, length) of a document."""
    for piece, start in enumerate(range(0, max(n_ids, 1), capacity)):
        yield piece, start, min(capacity, n_ids - start)


def _numbered(round_no: int, group: Column, bin_no: Column) -> Column:
    return F.lit(round_no * ROUND_STEP) + group * GROUP_STEP + bin_no


def pack_documents(
    docs: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    tokenizer: str = "word_bpe_49k.json",
    end_id: int = 1,
    capacity: int = CAPACITY,
    open_bins: int = OPEN_BINS,
    fan_in: int = FAN_IN,
    with_ids: bool = False,
) -> DataFrame:
    """``id, piece, start, length, ids_crc32, sequence_id, offset`` of every piece, with
    ``with_ids`` also ``ids`` (little-endian 32-bit token ids).

    ``start`` counts the document's ids before the piece, ``offset`` the tokens before it
    in its sequence. Pieces of a sequence follow each other without a gap.
    """
    spark = docs.sparkSession
    id_type = docs.schema[id_col].dataType.simpleString()
    rows = docs.select(F.col(id_col).alias("id"), F.col(text_col).alias("text"))
    end_mark = int(end_id).to_bytes(4, "little")
    schema = (
        f"id {id_type}, piece int, start long, length long, ids_crc32 long, ids binary, "
        "group long, bin long, offset long, used long"
    )

    def place(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        import numpy as np
        from pyspark import TaskContext

        group = TaskContext.get().partitionId()
        table, bins = word_table(tokenizer), OpenBins(capacity, open_bins)
        id_arrow = None

        def batch(ids, numbers, blobs, used) -> pa.RecordBatch:
            columns = np.array(numbers, np.int64).reshape(-1, 6).T
            n = columns.shape[1]
            whole = [pa.array(columns[i]) for i in range(6)]
            return pa.RecordBatch.from_arrays(
                [ids, whole[0].cast(pa.int32()), *whole[1:4], pa.array(blobs, pa.binary()),
                 pa.array(np.full(n, group)), *whole[4:], pa.array(used, pa.int64())],
                ["id", "piece", "start", "length", "ids_crc32", "ids", "group", "bin", "offset", "used"],
            )

        for part in slices(batches, "text"):
            id_arrow = part.column("id").type
            numbers, of, blobs = [], [], []
            for i, found in enumerate(table.ids(part.column("text").cast(pa.binary()).to_pylist())):
                found += end_mark
                for piece, start, length in pieces_of(len(found) // 4, capacity):
                    ids = found[4 * start: 4 * (start + length)]
                    numbers.append((piece, start, length, zlib.crc32(ids), *bins.place(length)))
                    blobs.append(ids if with_ids else None)
                    of.append(i)
            yield batch(part.column("id").take(pa.array(of, pa.int64())), numbers, blobs, [None] * len(of))
        left = bins.still_open()
        if left:
            nothing = pa.nulls(len(left), id_arrow)
            yield batch(nothing, [(-1, 0, 0, 0, b, 0) for b, _ in left], [None] * len(left),
                        [used for _, used in left])

    stages = Stages(spark)
    placed = stages.write(rows.mapInArrow(place, schema), "placed")
    pieces = placed.where("used IS NULL")
    left = placed.where("used IS NOT NULL").select("group", "bin", "used")
    moved = _rounds(stages, left, capacity, open_bins, fan_in)
    final = pieces.select(
        F.col("id").alias(id_col), "piece", "start", "length", "ids_crc32",
        *(["ids"] if with_ids else []), "group", "bin", "offset",
    )
    if moved is None:
        home, offset = _numbered(0, F.col("group"), F.col("bin")), F.col("offset")
    else:
        final = final.join(moved, ["group", "bin"], "left")
        home = F.coalesce("home", _numbered(0, F.col("group"), F.col("bin")))
        offset = F.col("offset") + F.coalesce("base", F.lit(0))
    return final.select(
        *[c for c in final.columns if c not in ("group", "bin", "offset", "home", "base")],
        home.alias("sequence_id"), offset.alias("offset"),
    )


def _rounds(stages: Stages, left: DataFrame, capacity: int, open_bins: int, fan_in: int):
    """``group, bin, home, base``: the sequence that a first-round sequence goes into and
    where it begins there; None where there is but one group."""
    out = "parent long, group long, bin long, new_bin long, base long, used long"

    def again(key, table):
        table = table.sort_by([("group", "ascending"), ("bin", "ascending")])
        parent, bins = key[0].as_py(), OpenBins(capacity, open_bins)
        rows = [
            (parent, g, b, *bins.place(used), None)
            for g, b, used in zip(*(table.column(c).to_pylist() for c in ("group", "bin", "used")))
        ]
        rows += [(parent, None, None, b, None, used) for b, used in bins.still_open()]
        names = ["parent", "group", "bin", "new_bin", "base", "used"]
        return pa.table({n: pa.array(c, pa.int64()) for n, c in zip(names, zip(*rows))})

    total, round_no = None, 0
    highest = left.agg(F.max("group")).first()[0]
    while highest:
        round_no += 1
        grouped = left.withColumn("parent", F.floor(F.col("group") / fan_in).cast("long"))
        placed = stages.write(grouped.groupBy("parent").applyInArrow(again, out), f"round{round_no}")
        steps = placed.where("used IS NULL").select(
            "group", "bin", "parent", "new_bin", F.col("base").alias("step")
        )
        if total is None:
            total = steps.withColumnRenamed("step", "base")
        else:
            # of those that were still open after the round before
            ends = [F.col("group").alias("parent"), F.col("bin").alias("new_bin"),
                    F.lit(round_no - 1).alias("round"),
                    F.col("parent").alias("to"), F.col("new_bin").alias("to_bin"), "step"]
            joined = total.join(steps.select(*ends), ["parent", "new_bin", "round"], "left")
            went = F.col("to").isNotNull()
            total = joined.select(
                "group", "bin", F.coalesce("to", "parent").alias("parent"),
                F.coalesce("to_bin", "new_bin").alias("new_bin"),
                (F.col("base") + F.coalesce("step", F.lit(0))).alias("base"),
                F.when(went, F.lit(round_no)).otherwise(F.col("round")).alias("round"),
            )
        if "round" not in total.columns:
            total = total.withColumn("round", F.lit(round_no))
        left = placed.where("used IS NOT NULL").select(
            F.col("parent").alias("group"), F.col("new_bin").alias("bin"), "used"
        )
        highest //= fan_in
    if total is None:
        return None
    home = F.col("round") * ROUND_STEP + F.col("parent") * GROUP_STEP + F.col("new_bin")
    return total.select("group", "bin", home.alias("home"), "base")
