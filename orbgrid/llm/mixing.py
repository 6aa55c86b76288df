"""Mixing sources to target weights: a Pfair schedule of source blocks, earliest deadline first."""

from __future__ import annotations

from collections.abc import Mapping
from functools import reduce
from math import gcd

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from orbgrid.llm.common import dense_index, join_summary, packed, require_new, stored, unpacked
from orbgrid.session import keep_copartitioning

#: Slots that one row schedules; a longer period takes a row after another.
CHUNK_SLOTS = 1 << 17
#: Slots whose candidates are looked at together.
BATCH_SLOTS = 256
#: Tickets up to which the schedule is broadcast.
BROADCAST_TICKETS = 100_000


def period(sources: DataFrame, chunk_slots: int = CHUNK_SLOTS, batch_slots: int = BATCH_SLOTS) -> DataFrame:
    """One period of the schedule: source, tickets, k (the source's k-th block, from 0), slot, total.

    ``sources`` has ``source`` (unique) and integer ``tickets``; a source's weight is its
    tickets over their sum Q.  Its block j (from 1) may not come before slot
    ``floor((j-1) * Q / tickets)`` and must come before slot
    ``ceil(j * Q / tickets)``.  In each slot the released block with the
    earliest deadline goes (ties: smaller source).  Weights sum to 1, so every
    deadline is met and every prefix has each source within one block of its share.

    Blocks are made where their slots are scheduled, ``chunk_slots`` at a time.
    What one chunk leaves for the next is a block or two of each source, stored
    between them.  No sources give no rows.
    """
    spark = sources.sparkSession
    total = sources.agg(F.sum("tickets")).first()[0]
    named = sources.select("source", F.col("tickets").cast("long").alias("tickets"))
    if total is None:
        return named.select("*", F.lit(0).cast("long").alias("k"), F.lit(0).cast("long").alias("slot"), F.lit(0).cast("long").alias("total"))
    waiting, parts = None, []
    for low in range(0, total, chunk_slots):
        done = _chunk(named, waiting, total, low, min(low + chunk_slots, total), batch_slots)
        if total > chunk_slots:
            done = stored(spark, done)
        waiting = done.select("waiting")
        parts.append(done.select(F.explode("out").alias("e")).select("e.*"))
    slots = reduce(DataFrame.unionByName, parts)
    return slots.select("source", "tickets", "k", "slot", F.lit(total).cast("long").alias("total"))


_JOB = "struct<d:bigint,source:string,r:bigint,k:bigint,tickets:bigint>"
_SLOT = "struct<source:string,tickets:bigint,k:bigint,slot:bigint>"


def _bound(value, use):
    """``use(value)`` with the value computed once and then used by name."""
    return F.get(F.transform(F.array(value), use), F.lit(0))


def _chunk(sources: DataFrame, waiting: DataFrame | None, total: int, low: int, high: int, batch: int) -> DataFrame:
    """Slots ``low`` to before ``high`` in one row: ``out``, and the blocks ``waiting`` for the next chunk.

    A batch looks at the blocks released in it and at as many of the waiting
    ones, by deadline, as it has slots: no other can have its turn.
    """
    q, n = F.lit(total).cast("long"), F.col("tickets")

    def div(x, y):
        return F.call_function("div", x, y)

    def released_before(slot):
        return div(F.lit(slot).cast("long") * n + q - 1, q)

    first, last = released_before(low), released_before(high) - 1
    k = F.col("k")
    jobs = sources.where(first <= last).select("source", "tickets", F.explode(F.sequence(first, last)).alias("k"))
    job = F.struct(
        div((k + 1) * q + n - 1, n).alias("d"), "source", div(k * q, n).alias("r"), "k", "tickets"
    ).alias("job")
    batches = jobs.select(job).groupBy(div(F.col("job.r") - low, F.lit(batch)).alias("b")).agg(F.array_sort(F.collect_list("job")).alias("jobs"))
    one = batches.agg(F.map_from_entries(F.collect_list(F.struct("b", "jobs"))).alias("released"))
    if waiting is None:
        one = one.withColumn("waiting", F.array().cast(f"array<{_JOB}>"))
    else:
        both = one.withColumn("waiting", F.lit(None).cast(f"array<{_JOB}>")).unionByName(waiting, allowMissingColumns=True)
        one = both.agg(*[F.first(c, ignorenulls=True).alias(c) for c in ("released", "waiting")])
    none = F.array().cast(f"array<{_JOB}>")

    def slot_step(state, t):
        pick = F.get(F.filter(state["ready"], lambda x: x["r"] <= t), F.lit(0))
        return _bound(
            pick,
            lambda p: F.struct(
                F.filter(state["ready"], lambda x: (x["d"] != p["d"]) | (x["source"] != p["source"])).alias("ready"),
                F.concat(state["out"], F.array(F.struct(p["source"].alias("source"), p["tickets"].alias("tickets"), p["k"].alias("k"), t.alias("slot")))).alias("out"),
            ),
        )

    def batch_step(state, b):
        start = F.lit(low).cast("long") + b * batch
        slots = F.sequence(start, F.least(start + batch, F.lit(high).cast("long")) - 1)
        come = F.coalesce(F.element_at(F.col("released"), b), none)
        ready = F.array_sort(F.concat(F.slice(state["waiting"], 1, batch), come))
        ran = F.aggregate(slots, F.struct(ready.alias("ready"), F.array().cast(f"array<{_SLOT}>").alias("out")), slot_step)
        rest = F.slice(state["waiting"], F.lit(batch + 1), F.greatest(F.size(state["waiting"]), F.lit(1)))
        return _bound(
            ran,
            lambda x: F.struct(
                F.array_sort(F.concat(x["ready"], rest)).alias("waiting"), F.concat(state["out"], x["out"]).alias("out")
            ),
        )

    start = F.struct("waiting", F.array().cast(f"array<{_SLOT}>").alias("out"))
    every = F.sequence(F.lit(0).cast("long"), F.lit((high - low - 1) // batch).cast("long"))
    return one.select(F.aggregate(every, start, batch_step).alias("s")).select("s.waiting", "s.out")


def schedule(
    spark: SparkSession,
    docs: DataFrame,
    tickets: Mapping[str, int],
    default: int = 1,
    block_rows: int = 1,
    source_col: str = "source",
    order: tuple[str, ...] = ("doc_id",),
) -> DataFrame:
    """``docs`` (packed) with _source, _block, _slot and _in_source: where the schedule puts each row.

    Rows of a source keep ``order`` and are cut into blocks of ``block_rows``.
    A block's slot is unique; sorting by it gives the mixture.  Sources that
    ``tickets`` doesn't name get ``default``; a null source is a source of its own, named by
    the empty string together with rows that have one.  Every row is placed
    once.  When a source runs out, its later slots stay empty and the others
    go on in their own proportions.
    """
    for name, n in {**tickets, "(default)": default}.items():
        if int(n) != n or n < 1:
            raise ValueError(f"tickets of {name} must be a whole number of 1 or more")
    keep = _kept(source_col, order)
    named = packed(docs, *keep).withColumn("_source", F.coalesce(F.col(source_col).cast("string"), F.lit("")))
    rows = dense_index(spark, named, ["_source", *order], "_row")
    sources = rows.groupBy("_source").agg(F.min("_row").alias("_first"))
    # Tickets with a common divisor give the same order as without it.
    unit = gcd(default, *tickets.values())
    weight = F.lit(default // unit).cast("long")
    for name, n in sorted(tickets.items()):
        weight = F.when(F.col("_source") == name, F.lit(n // unit).cast("long")).otherwise(weight)
    sources = stored(spark, sources.withColumn("_tickets", weight))
    cycle = period(sources.select(F.col("_source").alias("source"), F.col("_tickets").alias("tickets")))
    slots = cycle.select(
        F.col("source").alias("_source"), F.col("k").alias("_k"), F.col("slot").alias("_at"), F.col("total").alias("_total")
    )
    inside = F.col("_row") - F.col("_first")
    block = F.call_function("div", inside, F.lit(block_rows).cast("long"))
    few = (sources.agg(F.sum("_tickets")).first()[0] or 0) <= BROADCAST_TICKETS
    known = rows.join(F.broadcast(sources), "_source") if few else join_summary(rows, sources, "_source")
    blocks = (
        known.withColumn("_in_source", inside)
        .withColumn("_block", block)
        .withColumn("_k", F.pmod(F.col("_block"), F.col("_tickets")))
    )
    # Blocks of a hot source are spread by their numbers; with few tickets the schedule goes to the rows.
    return (
        blocks.join(F.broadcast(slots) if few else slots, ["_source", "_k"])
        .withColumn("_slot", F.call_function("div", F.col("_block"), F.col("_tickets")) * F.col("_total") + F.col("_at"))
        .drop("_row", "_first", "_tickets", "_k", "_at", "_total")
    )


def _kept(source_col: str, order: tuple[str, ...]) -> tuple[str, ...]:
    return tuple(dict.fromkeys((source_col, *order)))


def mix(
    spark: SparkSession,
    docs: DataFrame,
    tickets: Mapping[str, int],
    default: int = 1,
    block_rows: int = 1,
    source_col: str = "source",
    order: tuple[str, ...] = ("doc_id",),
    names: tuple[str, str, str] = ("block", "slot", "position"),
) -> DataFrame:
    """``docs`` with each row's block, its slot and the row's dense place in the mixture; see ``schedule``.

    ``names`` are the columns added, which may not exist.  An empty table stays empty.
    """
    require_new(docs, names)
    placed = schedule(spark, docs, tickets, default, block_rows, source_col, order)
    ordered = dense_index(spark, placed, ["_slot", "_in_source"], "_position")
    added = [F.col(c).alias(n) for c, n in zip(("_block", "_slot", "_position"), names, strict=True)]
    return unpacked(ordered, docs.columns, _kept(source_col, order), *added)


def with_places(
    spark: SparkSession,
    docs: DataFrame,
    tickets: Mapping[str, int],
    default: int = 1,
    block_rows: int = 1,
    source_col: str = "source",
    id_col: str = "doc_id",
    text_col: str = "text",
    name: str = "position",
) -> DataFrame:
    """``docs`` with each row's dense place in the mixture (``name``), as ``mix`` gives it.

    Only ids, sources and a hash of the row are mixed; the texts move once, to
    meet their places.  Rows alike in id, source and text are numbered on both
    sides and share their places among them.  An empty table stays empty.
    """
    require_new(docs, (name,))
    keep_copartitioning(spark)  # numbering and join share one shuffle
    key = F.xxhash64(id_col, source_col, text_col).alias("_k")
    small = mix(spark, docs.select(id_col, source_col, key), tickets, default, block_rows, source_col, (id_col,), ("_block", "_slot", "_place"))
    nth = lambda order: F.row_number().over(Window.partitionBy("_k").orderBy(order))
    places = small.select("_k", "_place").withColumn("_n", nth("_place"))
    rows = packed(docs, id_col, source_col, text_col).withColumn("_k", key).withColumn("_n", nth("_k"))
    met = rows.join(places, ["_k", "_n"])
    return unpacked(met, docs.columns, (id_col, source_col, text_col), F.col("_place").alias(name))


def mixed_order(
    spark: SparkSession,
    docs: DataFrame,
    tickets: Mapping[str, int],
    default: int = 1,
    block_rows: int = 1,
    source_col: str = "source",
    order: tuple[str, ...] = ("doc_id",),
) -> DataFrame:
    """The rows of ``docs``, columns unchanged, in the order of the mixture (for writing)."""
    placed = schedule(spark, docs, tickets, default, block_rows, source_col, order)
    sorted_rows = placed.repartitionByRange("_slot", "_in_source").sortWithinPartitions("_slot", "_in_source")
    return unpacked(sorted_rows, docs.columns, _kept(source_col, order))
