"""Dense surrogate keys (1..N in a given order) without a single-partition window.

A SQL ``row_number() OVER (ORDER BY k)`` is one task in Spark. Instead:

1. ``orderBy`` range-partitions on the whole sort key (sampled boundaries, so a
   hot leading column is split by the following columns) and sorts each range;
2. ``monotonically_increasing_id`` then holds (partition index, position) of every row;
3. the sorted rows are written once under ``spark.checkpoint.dir`` - that fixes the
   positions, so a lost executor re-reads them instead of re-sampling boundaries;
4. a per-partition row count (one row per sort partition, so its size is bounded
   by the partition count) gives running offsets, joined back by broadcast.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..session import stage_path
from .values import quoted

_POS_BITS = 33  # monotonically_increasing_id: partition index << 33 | row position
_POS_MASK = (1 << _POS_BITS) - 1
_MAX_BUCKET_IDS = 10_000_000  # ids per bucket: one window group, one task's share
TASK_ROWS = 200_000  # wide registry rows that one task sorts in memory, about 1 kB each


def shuffle_partitions(spark) -> int | None:
    """``spark.sql.shuffle.partitions`` as a number, or None when it is not numeric."""
    try:
        return int(spark.conf.get("spark.sql.shuffle.partitions"))
    except (TypeError, ValueError):
        return None


def sized_partitions(spark, rows: int | None) -> int | None:
    """Partitions of about ``TASK_ROWS`` rows, or None where ``spark.sql.shuffle.partitions`` makes smaller ones already.

    A task's rows, and with them its memory, then stay the same however many rows there are.
    """
    n = -(-(rows or 0) // TASK_ROWS)
    return n if n > (shuffle_partitions(spark) or 200) else None


def _cols(cols: Sequence[str | Column]) -> list[Column]:
    return [F.col(c) if isinstance(c, str) else c for c in cols]


def sorted_positions(df: DataFrame, order_by: Sequence[str | Column], name: str = "positions",
                     rows: int | None = None, drop: Sequence[str] = ()) -> DataFrame:
    """Sort, tag each row with its (partition, position), and cut lineage.

    Returns the staged frame with ``_pos_part`` and ``_pos_local``, without the columns ``drop``. ``rows``, if known,
    sizes the sort partitions.
    """
    spark = df.sparkSession
    order, n = _cols(order_by), sized_partitions(spark, rows)
    ordered = df.repartitionByRange(n, *order).sortWithinPartitions(*order) if n else df.orderBy(*order)
    tagged = ordered.withColumn("_pos_mid", F.monotonically_increasing_id()).drop(*drop)
    path = stage_path(spark, name)
    tagged.write.mode("overwrite").parquet(path)
    staged = spark.read.parquet(path)
    return staged.withColumn("_pos_part", F.shiftright("_pos_mid", _POS_BITS)).withColumn(
        "_pos_local", F.col("_pos_mid").bitwiseAND(F.lit(_POS_MASK))
    ).drop("_pos_mid")


def partition_offsets(staged: DataFrame, weight: Column | None = None) -> DataFrame:
    """Running start offset of every sort partition: ``(_pos_part, _pos_offset, _pos_total)``.

    The frame has one row per sort partition; the window over it is tiny.
    """
    w = F.count(F.lit(1)) if weight is None else F.sum(weight)
    totals = staged.groupBy("_pos_part").agg(w.cast("long").alias("_pos_total"),
                                             F.count(F.lit(1)).alias("_pos_rows"))
    # row positions live in the low 33 bits of monotonically_increasing_id: fail loudly, never wrap
    guarded = F.when(F.col("_pos_rows") < F.lit(1 << _POS_BITS), F.col("_pos_total")).otherwise(
        F.raise_error(F.lit("a sort partition holds 2^33 rows or more; raise spark.sql.shuffle.partitions"))
        .cast("long"))
    totals = totals.select("_pos_part", guarded.alias("_pos_total"))
    run = Window.orderBy("_pos_part").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    return totals.select(
        "_pos_part", (F.sum("_pos_total").over(run) - F.col("_pos_total")).alias("_pos_offset"), "_pos_total"
    )


def input_position(df: DataFrame) -> list[Column]:
    """(file, row index) of each row of a frame that reads one Parquet scan directly.

    A deterministic, unique last tie-break: even a group of identical rows holding a third
    of the input is then split by the range partitioner, and a recomputed task sees the
    same values (unlike a random salt).
    """
    meta = df.metadataColumn("_metadata")
    return [meta.getField("file_path"), meta.getField("row_index")]


def _attach_offsets(staged: DataFrame, offsets: DataFrame) -> DataFrame:
    """Join the per-partition offsets back: one 24-byte row per sort partition, and a range sort yields at
    most ``spark.sql.shuffle.partitions`` of them, so the broadcast is bounded by that setting."""
    return staged.join(F.broadcast(offsets), "_pos_part")


def with_dense_key(
    df: DataFrame,
    order_by: Sequence[str | Column],
    key: str,
    start: int | Column = 1,
    tiebreak: bool = True,
    name: str = "dense-key",
    restart_by: Sequence[str] = (),
    file_position: bool = False,
    rows: int | None = None,
) -> DataFrame:
    """Add ``key`` = ``start`` + (0-based rank of the row in ``order_by`` order).

    With ``tiebreak`` the remaining columns join the sort key, so rows that tie on
    ``order_by`` are ordered by content and only identical rows can swap ids. With
    ``file_position`` (``df`` reads one Parquet scan) the row's file position, which is unique,
    breaks ties instead: the sort key stays narrow, and even a hot group of identical rows is
    split across sort partitions. ``rows``, if known, sizes the sort partitions.
    ``restart_by`` (leading columns of ``order_by``) numbers every group from ``start``
    again - several tables keyed by one sort: the group starts come from the same
    small (partition, group) count frame as the partition offsets.
    """
    columns = list(df.columns)
    order = _cols(order_by)
    if tiebreak and not file_position:
        named = {c for c in order_by if isinstance(c, str)}
        order += [F.col(quoted(c)) for c in columns if c not in named]
    place = []
    if file_position:
        place = ["_at_file", "_at_row"]
        df = df.select("*", *[c.alias(p) for c, p in zip(input_position(df), place, strict=True)])
        order += _cols(place)
    staged = sorted_positions(df, order, name, rows, place)
    start_col = start if isinstance(start, Column) else F.lit(start).cast("long")
    if not restart_by:
        keyed = _attach_offsets(staged, partition_offsets(staged))
        rank = F.col("_pos_offset") + F.col("_pos_local")
    else:
        groups = list(restart_by)
        # one row per (sort partition, group): bounded by partitions x groups
        counts = staged.groupBy("_pos_part", *groups).agg(F.count(F.lit(1)).alias("_n"))
        run_p = Window.orderBy("_pos_part").rowsBetween(Window.unboundedPreceding, Window.currentRow)
        per_part = counts.groupBy("_pos_part").agg(F.sum("_n").alias("_t"))
        per_part = per_part.withColumn("_t", F.when(F.col("_t") < F.lit(1 << _POS_BITS), F.col("_t")).otherwise(
            F.raise_error(F.lit("a sort partition holds 2^33 rows or more")).cast("long")))
        part_off = per_part.select("_pos_part", (F.sum("_t").over(run_p) - F.col("_t")).alias("_pos_offset"))
        run_g = Window.orderBy(*groups).rowsBetween(Window.unboundedPreceding, Window.currentRow)
        per_group = counts.groupBy(*groups).agg(F.sum("_n").alias("_g"))
        group_off = per_group.select(*groups, (F.sum("_g").over(run_g) - F.col("_g")).alias("_group_start"))
        keyed = _attach_offsets(staged, part_off)
        keyed = keyed.join(group_off, groups)
        rank = F.col("_pos_offset") + F.col("_pos_local") - F.col("_group_start")
    return keyed.select(*[F.col(quoted(c)) for c in columns], (start_col + rank).alias(key))


def id_bounds(df: DataFrame, id_col: str) -> tuple[int, int]:
    """(least, largest) id of ``df``: two numbers to the driver; (1, 1) for an empty frame."""
    low, high = df.agg(F.min(id_col), F.max(id_col)).first()
    return (1, 1) if low is None else (int(low), int(high))


def id_bucket_width(spark, span: int, buckets: int | None = None) -> int:
    """Ids per bucket for ``span`` consecutive ids: about 4 buckets per shuffle partition, 16 per sized one (their hashes
    then fill the partitions evenly), at most 10M ids each."""
    sized = sized_partitions(spark, span)
    n_buckets = buckets or (16 * sized if sized else 4 * (shuffle_partitions(spark) or 200))
    n_buckets = max(n_buckets, -(-int(span) // _MAX_BUCKET_IDS))
    return max(1, -(-int(span) // max(1, n_buckets)))


def _bucket(id_col: str, low: int, width: int) -> Column:
    return F.floor((F.col(id_col) - F.lit(low)) / F.lit(width)).cast("long")


def rule_offsets(rows: DataFrame, fires: Sequence[Column], id_col: str, low: int, width: int,
                 restart: Sequence[int] = (0,)) -> DataFrame:
    """(_kb, _offs): how many events come before each id bucket's first one, per rule.

    ``fires[i]`` says whether rule i emits an event for a row. One pass over ``rows`` sums the
    predicates per bucket, without making any event row. ``restart`` lists the rules at which the numbering
    starts at zero again. One row per non-empty bucket (bounded by ``id_bucket_width``).
    """
    counts = rows.groupBy(_bucket(id_col, low, width).alias("_kb")).agg(
        *[F.count_if(f).alias(f"_c{i}") for i, f in enumerate(fires)])
    earlier = Window.orderBy("_kb").rowsBetween(Window.unboundedPreceding, -1)
    every = Window.orderBy("_kb").rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    sums = counts.select("_kb", *[F.coalesce(F.sum(f"_c{i}").over(earlier), F.lit(0)).alias(f"_b{i}")
                                  for i in range(len(fires))],
                         *[F.sum(f"_c{i}").over(every).alias(f"_t{i}") for i in range(len(fires))])
    starts = []
    for i in range(len(fires)):
        first = max(r for r in restart if r <= i)
        offset = F.col(f"_b{i}")
        for j in range(first, i):
            offset = offset + F.col(f"_t{j}")
        starts.append(offset.cast("long"))
    return sums.select("_kb", F.array(*starts).alias("_offs"))


def with_event_ids(rows: DataFrame, fires: Sequence[Column], offsets: DataFrame, id_col: str, low: int, width: int,
                   start: int | Column | Sequence[int | Column] = 1, first_rule: int = 0,
                   out: str = "_event_ids", span: int | None = None) -> DataFrame:
    """Add the array ``out``: for each rule, the dense id that its event for this row gets.

    Ids follow (rule, ``id_col``) order. The rank inside an id bucket is a running count of the predicate,
    so only the narrow rows are shuffled (once, by bucket); events are made afterwards, already numbered.
    A bucket spans ``width`` ids, so none is hot while ids are unique. Rows that share an id are ordered by
    their content. ``offsets`` has one row per bucket (``id_bucket_width``), so it is broadcast;
    ``first_rule`` is the place of ``fires[0]`` in its arrays. ``start`` may differ from rule to rule.
    ``span`` is the number of ids there can be; it sizes the partitions that the buckets are dealt to.
    """
    columns = list(rows.columns)
    ties = [F.col(quoted(c)) for c in columns if c != id_col]
    upto = (Window.partitionBy("_kb").orderBy(F.col(id_col), *ties)
            .rowsBetween(Window.unboundedPreceding, Window.currentRow))
    tagged = rows.withColumn("_kb", _bucket(id_col, low, width))
    if sized := sized_partitions(rows.sparkSession, span):
        tagged = tagged.repartition(sized, "_kb")
    ranked = tagged.select("*", *[F.count_if(f).over(upto).alias(f"_r{i}") for i, f in enumerate(fires)])
    starts = list(start) if isinstance(start, Sequence) else [start] * len(fires)
    starts = [s if isinstance(s, Column) else F.lit(s).cast("long") for s in starts]
    ids = F.array(*[starts[i] + F.col("_offs")[first_rule + i] + F.col(f"_r{i}") - F.lit(1)
                    for i in range(len(fires))])
    return ranked.join(F.broadcast(offsets), "_kb").select(*[F.col(quoted(c)) for c in columns], ids.alias(out))


def next_key_start(existing: DataFrame, key: str) -> Column:
    """First free id after an earlier load: ``max(id) + 1`` (1 for an empty table).

    Returned as a scalar-subquery column so the key pass needs no driver round trip.
    """
    mx = existing.agg(F.coalesce(F.max(key), F.lit(0)).cast("long").alias("m"))
    return F.lit(1).cast("long") + mx.scalar()
