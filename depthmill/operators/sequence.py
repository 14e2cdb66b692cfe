"""Update-id continuity, gap-free epochs and snapshot anchors."""

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from depthmill.operators.book import book_state
from depthmill.operators.ordered import running_last
from depthmill.session import written

# Ids per slice of a symbol's sequence: bounds a task, and the carried borders stay one row per slice.
SLICE_IDS = 1 << 18


def by_id(width: int = SLICE_IDS) -> Column:
    return F.floor(F.col("first_update_id") / F.lit(width))


def linked(messages: DataFrame, slice_ids: int = SLICE_IDS) -> DataFrame:
    """Add `prev_update_id`, the last id of the message before, and `epoch`, the number of breaks so far, from one read of the messages.

    Slices are worked out by themselves and stored. A slice's summary (first id, last id, breaks) is all that the others need: summaries
    add up along a symbol, one row per slice, and give each slice its predecessor and the breaks before it.
    """
    first, last = F.col("first_update_id"), F.col("last_update_id")
    inside = Window.partitionBy("symbol", "_slice").orderBy(first, last)
    rows = messages.withColumn("_slice", by_id(slice_ids)).withColumn("_before", F.lag(last).over(inside))
    broken = F.coalesce(first != F.col("_before") + 1, F.lit(False)).cast("long")
    rows = rows.withColumn("_broken", broken).withColumn("_run", F.sum("_broken").over(inside.rowsBetween(Window.unboundedPreceding, 0)))
    rows = written(rows.drop("_broken"), "sliced-messages")

    summary = rows.groupBy("symbol", "_slice").agg(F.min(first).alias("_first"), F.max_by(last, F.struct(first, last)).alias("_last"), F.max("_run").alias("_breaks"))
    along = Window.partitionBy("symbol").orderBy("_slice")
    summary = summary.withColumn("_carried", F.lag("_last").over(along))
    border = F.coalesce(F.col("_first") != F.col("_carried") + 1, F.lit(False)).cast("long")
    summary = summary.withColumn("_border", border)
    earlier = F.coalesce(F.sum("_breaks").over(along.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    base = F.sum("_border").over(along.rowsBetween(Window.unboundedPreceding, 0)) + earlier
    summary = summary.select(F.col("symbol").alias("_symbol"), F.col("_slice").alias("_of"), "_carried", base.alias("_base"))
    placed = rows.join(summary, rows["symbol"].eqNullSafe(F.col("_symbol")) & rows["_slice"].eqNullSafe(F.col("_of")))
    return placed.select(*messages.columns, F.coalesce("_before", "_carried").alias("prev_update_id"), (F.col("_base") + F.col("_run")).alias("epoch"))


def continuity(messages: DataFrame, slice_ids: int = SLICE_IDS) -> DataFrame:
    """Per message: the id expected after the previous message, the gap, and PASS or FAIL.

    The first message of a symbol has no predecessor: expected id, gap and result are NULL.
    """
    return _checked(linked(messages, slice_ids).drop("epoch"))


def _checked(rows: DataFrame) -> DataFrame:
    expected = F.col("prev_update_id") + 1
    return rows.withColumn("expected_id", expected).withColumns(
        {
            "gap": F.col("first_update_id") - expected,
            "result": F.when(F.col("first_update_id") == expected, "PASS").when(expected.isNotNull(), "FAIL"),
        }
    )


def gap_summary(checked: DataFrame) -> DataFrame:
    """Transitions, failures and lost ids per symbol."""
    failed = F.contains(F.col("result"), F.lit("FAIL"))
    return checked.groupBy("symbol").agg(
        F.count("gap").alias("transitions"),
        F.count_if(failed).alias("failures"),
        F.coalesce(F.sum(F.when(F.col("gap") > 0, F.col("gap"))), F.lit(0)).alias("lost_ids"),
    )


def epochs(messages: DataFrame, slice_ids: int = SLICE_IDS) -> DataFrame:
    """Continuity with `epoch`: the number of breaks so far, so every epoch is one gap-free run."""
    rows = linked(messages, slice_ids)
    return _checked(rows).select(*messages.columns, "prev_update_id", "expected_id", "gap", "result", "epoch")


def snapshot_anchors(messages: DataFrame, snapshots: DataFrame, slice_ids: int = SLICE_IDS) -> DataFrame:
    """Pair each snapshot with the message whose id range holds the snapshot's next id.

    An as-of join: both sides are put in one order by id, and each snapshot takes the newest message before it, if that
    one's range holds the id. Of messages that start at one id the longest counts; a message inside another's range hides it, so one
    with a wrong first id can't take what others hold. Nothing is listed per id, whatever a message spans.
    """
    message = F.struct(*messages.columns)
    first, none = F.col("first_update_id"), F.lit(None)
    here = messages.select("symbol", first.alias("_at"), F.lit(0).alias("_kind"), F.col("last_update_id").alias("_until"), none.cast("long").alias("snapshot_id"), message.alias("_message"))
    next_id = (F.col("snapshot_id") + 1).alias("_at")
    wanted = snapshots.select("symbol", next_id, F.lit(1).alias("_kind"), none.cast("long").alias("_until"), F.col("snapshot_id").cast("long").alias("snapshot_id"))
    both = here.unionByName(wanted, allowMissingColumns=True)
    slices = F.floor(F.col("_at") / F.lit(slice_ids))
    paired = running_last(both, ["symbol"], ["_at", "_kind", "_until"], slices, "_found", F.col("_message"))
    held = paired.where((F.col("_kind") == 1) & (F.col("_at") <= F.col("_found.last_update_id")))
    return held.select(*[F.col("_found")[c].alias(c) for c in messages.columns], "snapshot_id")


def synchronise(messages: DataFrame, snapshots: DataFrame, slice_ids: int = SLICE_IDS) -> DataFrame:
    """Status of every message under the snapshot rules, epoch by epoch.

    An epoch is anchored by its earliest snapshot that connects to one of its messages. Messages that end
    at or before that snapshot are `stale`, the anchor and all later ones are `applied`, and an epoch no
    snapshot connects to stays `unanchored`.
    """
    numbered = epochs(messages, slice_ids).select(*messages.columns, "epoch")
    anchored = snapshot_anchors(numbered.select("symbol", "epoch", "first_update_id", "last_update_id"), snapshots)
    bases = anchored.groupBy("symbol", "epoch").agg(F.min("snapshot_id").alias("snapshot_id"))
    status = (
        F.when(F.col("snapshot_id").isNull(), "unanchored")
        .when(F.col("last_update_id") <= F.col("snapshot_id"), "stale")
        .otherwise("applied")
    )
    # An epoch can be a whole symbol, so the join is left to adaptive skew handling; one row per epoch is small.
    return numbered.join(bases, ["symbol", "epoch"], "left").withColumn("status", status)


def epoch_books(synchronised: DataFrame, levels: DataFrame, snapshot_levels: DataFrame | None = None) -> DataFrame:
    """Book at the end of every anchored epoch: (symbol, epoch, side, price, qty, last_update_id).

    `synchronised` is what `synchronise` returns, `levels` the level changes of its messages (joined by symbol and
    ids), `snapshot_levels` the levels of snapshots by `snapshot_id`, which lie under the epoch's applied changes.
    """
    applied = synchronised.where(F.col("status") == "applied")
    ids = ["symbol", "first_update_id", "last_update_id"]
    changes = levels.join(applied.select(*ids, "epoch"), ids)
    base = None
    if snapshot_levels is not None:
        anchors = applied.select("symbol", "epoch", "snapshot_id").distinct()
        base = snapshot_levels.join(anchors, ["symbol", "snapshot_id"]).select(*changes.columns)
    return book_state(changes, base=base, keys=("symbol", "epoch"))
