"""Mixing sources to target weights by hash-threshold histograms, without a sort.

Every row has a 36-bit hash of its id. A source takes ``floor(target / size)`` whole
copies of all its rows and, for the rest of its budget, the rows below a hash
threshold. The threshold is found level by level: sizes are summed by source and hash
bucket (4,096 buckets a level), the running sum names the bucket where the budget
ends, and only that bucket is refined on the next level.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tabulark.llm.batches import broadcast_if_small
from tabulark.session import stage_table

LEVEL_BITS, LEVELS = 12, 3
MAX_COPIES = 3
MAX_BROADCAST_SOURCES = 10_000
WORDS = r"[^ \t\n\u000B\f\r]+"


def source_targets(
    sizes: DataFrame, weights: Sequence[int] = (5, 2, 1), cap: int = MAX_COPIES
) -> DataFrame:
    """``source, source_size, target`` from ``source, source_size``.

    Sources by code point, null last, weigh ``weights`` in turn and share the sum of all
    sizes; a target stops at ``cap`` times its source's size and the excess is shared
    again by weight. That ends at one common rate: sources whose cap is reached at a
    lower rate than the common one are capped, so one running sum in the order of those
    rates settles all rounds. One row per source passes through it.
    """
    order = Window.orderBy(F.col("source").asc_nulls_last())
    turn = F.pmod(F.row_number().over(order) - 1, F.lit(len(weights)))
    weight = F.element_at(F.array(*[F.lit(int(w)) for w in weights]), turn.cast("int") + 1)
    weighed = sizes.withColumn("weight", weight.cast("long"))
    everything = Window.partitionBy()
    rates = [F.col("source_size") / F.col("weight"), F.col("source").asc_nulls_last()]
    before = Window.orderBy(*rates).rowsBetween(Window.unboundedPreceding, -1)
    ranked = weighed.select(
        "*",
        F.row_number().over(Window.orderBy(*rates)).alias("rank"),
        F.sum("source_size").over(everything).alias("total"),
        F.sum("weight").over(everything).alias("weights"),
        F.coalesce(F.sum("source_size").over(before), F.lit(0)).alias("size_before"),
        F.coalesce(F.sum("weight").over(before), F.lit(0)).alias("weight_before"),
    )
    # the rate if exactly the sources before this one are capped
    share = (F.col("total") - cap * F.col("size_before")).cast("double") / (
        F.col("weights") - F.col("weight_before")
    )
    most = (cap * F.col("source_size")).cast("double")
    free = F.when(most > share * F.col("weight"), F.struct("rank", share.alias("rate")))
    settled = ranked.withColumn("first_free", F.min(free).over(everything))
    return settled.select(
        "source",
        "source_size",
        F.when(F.col("rank") >= F.col("first_free.rank"), F.col("first_free.rate") * F.col("weight"))
        .otherwise(most)
        .alias("target"),
    )


def row_hash(id_col: str, text_col: str):
    """36-bit hash of the id, of the text's digest for a null id."""
    key = F.coalesce(
        F.col(id_col).cast("string"),
        F.concat(F.lit("null "), F.md5(F.coalesce(F.col(text_col), F.lit("")))),
    )
    return F.conv(F.substring(F.md5(key), 1, 9), 16, 10).cast("long")


def thresholds(rows: DataFrame, budgets: DataFrame) -> DataFrame:
    """``source, below`` so that the rows with ``hash < below`` fill the ``budget`` of each
    source as far as whole hashes fit. rows: source, size, hash; budgets: source, budget.
    """
    bits = LEVEL_BITS * LEVELS
    open_ = budgets.select("source", "budget", F.lit(0).cast("long").alias("prefix"))
    for level in range(1, LEVELS + 1):
        shift = bits - LEVEL_BITS * level
        bucket = F.shiftright("hash", shift)
        sums = rows.select("source", "size", bucket.alias("bucket"))
        if level > 1:
            edge = open_.select(F.col("source").alias("s"), "prefix").where("prefix IS NOT NULL")
            sums = sums.join(
                broadcast_if_small(edge, MAX_BROADCAST_SOURCES),
                F.col("source").eqNullSafe(F.col("s"))
                & (F.shiftright("bucket", LEVEL_BITS) == F.col("prefix")),
                "left_semi",
            )
        sums = sums.groupBy("source", "bucket").agg(F.sum("size").alias("size"))
        running = Window.partitionBy("source").orderBy("bucket")
        sums = sums.withColumn("upto", F.sum("size").over(running)).withColumnsRenamed(
            {"source": "s"}
        )
        joined = open_.join(
            sums,
            F.col("source").eqNullSafe(F.col("s")) & (F.col("upto") > F.col("budget")),
            "left",
        )
        found = joined.groupBy("source").agg(
            F.first("budget").alias("budget"),
            F.min(F.struct("bucket", "upto", "size")).alias("first"),
        )
        left = F.col("budget") - (F.col("first.upto") - F.col("first.size"))
        over = F.col("first.upto") - F.col("budget")
        open_ = stage_table(
            found.select(
                "source",
                left.alias("budget"),
                F.col("first.bucket").alias("prefix"),
                (over < left).alias("nearer"),
            ),
            "edge",
        )
    # a source whose rows all fit has no boundary bucket: everything is below 2^bits
    last = F.col("prefix") + F.when(F.col("nearer"), 1).otherwise(0)
    return open_.select(
        "source", F.coalesce(last, F.lit(1 << bits).cast("long")).alias("below")
    )


def mix_plan(
    docs: DataFrame, id_col: str, text_col: str, source_col: str, weights: Sequence[int], cap: int
) -> tuple[DataFrame, DataFrame]:
    """(``id, source, size, hash`` of every row, ``s, source_size, target, copies, below`` of
    every source); both are written once."""
    measured = docs.select(
        F.col(id_col).alias("id"),
        F.col(source_col).alias("source"),
        F.coalesce(F.regexp_count(F.col(text_col), F.lit(WORDS)), F.lit(0))
        .cast("long").alias("size"),
        row_hash(id_col, text_col).alias("hash"),
    )
    rows = stage_table(measured, "mix")
    sizes = rows.groupBy("source").agg(F.sum("size").alias("source_size"))
    targets = source_targets(sizes, weights, cap)
    copies = F.when(F.col("source_size") > 0, F.floor(F.col("target") / F.col("source_size")))
    targets = stage_table(
        targets.withColumn("copies", F.coalesce(copies, F.lit(0)).cast("long")), "targets"
    )
    rest = F.col("target") - F.col("copies") * F.col("source_size")
    cuts = thresholds(rows, targets.select("source", rest.alias("budget")))
    cuts = targets.withColumnRenamed("source", "s").join(
        cuts, F.col("source").eqNullSafe(F.col("s"))
    )
    return rows, stage_table(cuts.drop("source"), "cuts")


def mix_sources(
    docs: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    source_col: str = "source",
    weights: Sequence[int] = (5, 2, 1),
    cap: int = MAX_COPIES,
) -> DataFrame:
    """``id, size, source_size, target, taken`` of every row, ``taken`` a multiple of size.

    Size is the number of words between ASCII white space (null text: 0). Rows with the
    same id share their hash and are decided together, so reruns agree; a source of
    size 0 takes nothing. Null sources form one source; null ids go by their texts.
    Other columns are not read.
    """
    rows, cuts = mix_plan(docs, id_col, text_col, source_col, weights, cap)
    mixed = rows.join(
        broadcast_if_small(cuts, MAX_BROADCAST_SOURCES), F.col("source").eqNullSafe(F.col("s"))
    )
    times = F.col("copies") + F.when(F.col("hash") < F.col("below"), 1).otherwise(0)
    return mixed.select(
        F.col("id").alias(id_col), "size", "source_size", "target",
        (times * F.col("size")).alias("taken"),
    )


def mixed_rows(
    docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", source_col: str = "source",
    weights: Sequence[int] = (5, 2, 1), cap: int = MAX_COPIES,
) -> DataFrame:
    """The rows of the mix, all columns, each as often as it is taken; rows without a word
    are not taken."""
    _, cuts = mix_plan(docs, id_col, text_col, source_col, weights, cap)
    names = {c: f"_cut_{c}" for c in cuts.columns}
    limits = broadcast_if_small(cuts.withColumnsRenamed(names), MAX_BROADCAST_SOURCES)
    times = F.col("_cut_copies") + F.when(
        row_hash(id_col, text_col) < F.col("_cut_below"), 1
    ).otherwise(0)
    worded = docs.where(F.col(text_col).rlike(WORDS))
    taken = worded.join(limits, F.col(source_col).eqNullSafe(F.col("_cut_s"))).withColumn(
        "_cut_times", times
    )
    each = F.explode(F.sequence(F.lit(1).cast("long"), F.col("_cut_times")))
    return (
        taken.where("_cut_times > 0").withColumn("_cut_time", each)
        .select(*[F.col(f"`{c}`") for c in docs.columns])
    )


SQL = r"""
WITH rows AS (
  SELECT doc_id, source,
    CASE WHEN text IS NULL THEN 0
         ELSE len(regexp_extract_all(text, '[^ \t\n\x0B\f\r]+')) END::BIGINT AS size,
    ('0x' || substr(md5(coalesce(doc_id::VARCHAR, 'null ' || md5(coalesce(text, '')))), 1, 9))
      ::BIGINT AS hash
  FROM documents),
sizes AS (SELECT source, sum(size)::BIGINT AS source_size FROM rows GROUP BY source),
weighed AS (
  SELECT *, [5, 2, 1][((row_number() OVER (ORDER BY source COLLATE "C" NULLS LAST) - 1) % 3 + 1)::INT]
    ::BIGINT AS weight FROM sizes),
ranked AS (
  SELECT *, row_number() OVER (ORDER BY source_size::DOUBLE / weight, source NULLS LAST) AS rank,
    sum(source_size) OVER ()::BIGINT AS total, sum(weight) OVER ()::BIGINT AS weights,
    coalesce(sum(source_size) OVER w, 0)::BIGINT AS size_before,
    coalesce(sum(weight) OVER w, 0)::BIGINT AS weight_before
  FROM weighed
  WINDOW w AS (ORDER BY source_size::DOUBLE / weight, source NULLS LAST
               ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING)),
shared AS (
  SELECT *, (total - 3 * size_before)::DOUBLE / (weights - weight_before)::DOUBLE AS share FROM ranked),
free AS (
  SELECT rank AS first_rank, share AS rate FROM shared
  WHERE (3 * source_size)::DOUBLE > share * weight ORDER BY rank LIMIT 1),
targets AS (
  SELECT source, source_size,
    CASE WHEN rank >= first_rank THEN rate * weight ELSE (3 * source_size)::DOUBLE END AS target
  FROM shared LEFT JOIN free ON TRUE),
budgets AS (
  SELECT *, CASE WHEN source_size > 0 THEN floor(target / source_size) ELSE 0 END::BIGINT AS copies
  FROM targets),
placed AS (
  SELECT r.doc_id, r.size, b.source_size, b.target, b.copies,
    b.target - b.copies * b.source_size AS rest,
    sum(r.size) OVER (PARTITION BY r.source ORDER BY r.hash RANGE UNBOUNDED PRECEDING) AS upto,
    sum(r.size) OVER (PARTITION BY r.source, r.hash) AS own
  FROM rows r JOIN budgets b ON r.source IS NOT DISTINCT FROM b.source)
SELECT doc_id, size, source_size, target,
  ((copies + CASE WHEN upto <= rest OR upto - rest < rest - (upto - own) THEN 1 ELSE 0 END) * size)::BIGINT AS taken FROM placed
"""
