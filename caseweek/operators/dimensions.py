"""Dimension maintenance: batch members, dense surrogate ids, merges, account upsert.

Surrogate dimensions are handled together in a *long* form
``(dimension, member, id)`` so one scan and one shuffle serve all of them.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..functions import account_id
from ..session import fits_broadcast, pin, row_bytes, within_bounds
from ..specs import SURROGATE_DIMENSIONS, DimensionSpec
from .coding import natural_key

def batch_members(extract: DataFrame, specs: list[DimensionSpec] = SURROGATE_DIMENSIONS,
                  drop: str | None = None) -> DataFrame:
    """Distinct ``(dimension, member)`` of a batch, all dimensions in one pass; with the column ``drop`` of an
    extract of several drops also ``_first``, the drop that has the member first.

    Null is a member; the Ambari version's null is stored as its null member.
    Partial aggregation de-duplicates before the shuffle, so a hot member
    costs one row per map task.
    """
    pairs = F.array(*[F.struct(F.lit(s.name).alias("dimension"),
                               natural_key(s).cast("string").alias("member")) for s in specs])
    if drop is None:
        return extract.select(F.explode(pairs).alias("m")).select("m.*").distinct()
    each = extract.select(F.col(drop).alias("_drop"), F.explode(pairs).alias("m")).select("m.*", "_drop")
    return each.groupBy("dimension", "member").agg(F.min("_drop").alias("_first"))


def new_members(members: DataFrame, current: DataFrame) -> DataFrame:
    """Members absent from the current dimension (null-safe anti join)."""
    m, c = members.alias("m"), current.select("dimension", "member").alias("c")
    cond = (F.col("m.dimension") == F.col("c.dimension")) & \
        F.col("m.member").eqNullSafe(F.col("c.member"))
    return m.join(c, cond, "left_anti").select(*[f"m.{c}" for c in members.columns])


def max_ids(current: DataFrame) -> DataFrame:
    """Largest id per dimension (0 when a dimension is empty or absent)."""
    return current.groupBy("dimension").agg(F.max("id").alias("_base"))


#: New members up to this many are numbered by one window a dimension.
WINDOW_KEYS = 200_000


def _order(keys: DataFrame) -> list[str]:
    return ["_first", "member"] if "_first" in keys.columns else ["member"]


def dense_ids(keys: DataFrame, base: DataFrame | None = None, sizes: dict[str, int] | None = None,
              window_keys: int = WINDOW_KEYS) -> DataFrame:
    """Number distinct ``(dimension, member)`` keys 1, 2, ... per dimension,
    in member order (nulls first), after the dimension's ``base`` id. Keys
    with a column ``_first`` are numbered by it first: the members of an
    earlier drop come before those of a later one.

    A count decides on the way. Few keys (at most ``window_keys``, and few
    bytes) are numbered by a window over each dimension; more are spread by
    ``range_ids``. The ids are the same. ``sizes`` receives the number of
    keys per dimension.
    """
    stats = keys.groupBy("dimension").agg(F.count(F.lit(1)).alias("n"), F.sum(row_bytes(keys)).alias("bytes"),
                                          F.lit(0).cast("long").alias("start"))
    if base is not None:       # the largest ids ride along
        stats = stats.unionByName(base.select(
            "dimension", F.lit(0).cast("long").alias("n"), F.lit(0).cast("long").alias("bytes"),
            F.coalesce(F.col("_base"), F.lit(0)).cast("long").alias("start")))
    per_dimension = stats.collect()             # two rows a dimension at most
    start = {r["dimension"]: r["start"] for r in per_dimension if r["start"]}
    if sizes is not None:
        sizes.update({r["dimension"]: r["n"] for r in per_dimension if r["n"]})
    if not within_bounds(sum(r["n"] for r in per_dimension), sum(r["bytes"] for r in per_dimension), window_keys):
        return range_ids(keys, start)
    before = F.lit(0)
    for dimension, largest in start.items():
        before = F.when(F.col("dimension") == dimension, largest).otherwise(before)
    place = F.row_number().over(Window.partitionBy("dimension").orderBy(*[F.col(c).asc_nulls_first() for c in _order(keys)]))
    return keys.select("dimension", "member", (place + before).cast("int").alias("id"))


def range_ids(keys: DataFrame, start: dict[str, int]) -> DataFrame:
    """``dense_ids`` without funnelling a dimension through one task: the keys are
    range-partitioned and sorted, each row gets its position inside its
    partition, and the row counts per (partition, dimension) give every
    partition its starting offset (the same scheme as ``zipWithIndex``).
    The positioned keys are checkpointed once, so the offsets and the ids
    see the same partitioning even if an executor is lost. Only the offset
    table - at most (range partitions x dimensions) rows - travels to the
    driver and back as a broadcast.
    """
    spark = keys.sparkSession
    order = ["dimension", *_order(keys)]
    ranged = (keys.repartitionByRange(*order).sortWithinPartitions(*order)
              .withColumn("_pos", F.monotonically_increasing_id()))
    tagged = pin(ranged).withColumn("_pid", F.shiftright("_pos", 33))
    rows = (tagged.groupBy("_pid", "dimension")
            .agg(F.count(F.lit(1)).alias("n"), F.min("_pos").alias("first"))).collect()
    seen: dict[str, int] = {}
    offsets = []
    for r in sorted(rows, key=lambda r: (r["dimension"], r["_pid"])):
        before = seen.get(r["dimension"], 0)
        offsets.append((r["_pid"], r["dimension"], start.get(r["dimension"], 0) + before - r["first"]))
        seen[r["dimension"]] = before + r["n"]
    shift = spark.createDataFrame(offsets, "_pid long, dimension string, _shift long")
    return (tagged.join(F.broadcast(shift), ["_pid", "dimension"])
            .select("dimension", "member",
                    (F.col("_pos") + F.col("_shift") + F.lit(1)).cast("int").alias("id")))


def merge_surrogates(current: DataFrame, members: DataFrame,
                     sizes: dict[str, int] | None = None) -> tuple[DataFrame, DataFrame]:
    """Keep every existing id; give new members max+1, max+2, ... per dimension.

    Returns ``(merged, added)`` in long form. Both are plans over ``current``:
    write ``added`` before that changes.
    ``sizes`` (optional) receives the number of added members per dimension.
    """
    added = dense_ids(new_members(members, current), max_ids(current), sizes)
    merged = current.select("dimension", "member", "id").unionByName(added)
    return merged, added


def to_long(dim: DataFrame, spec: DimensionSpec) -> DataFrame:
    return dim.select(F.lit(spec.name).alias("dimension"),
                      F.col(spec.key).cast("string").alias("member"),
                      F.col("id").cast("int").alias("id"))


def from_long(long: DataFrame, spec: DimensionSpec) -> DataFrame:
    return (long.where(F.col("dimension") == F.lit(spec.name))
            .select(F.col("member").alias(spec.key), F.col("id")))


# ---- account dimension: natural key, type-1 name ------------------------------

def batch_accounts(extract: DataFrame, drop: str | None = None) -> DataFrame:
    """One ``(id, name)`` per account id in the batch; several names -> largest.
    With the column ``drop`` of an extract of several drops: the name that the
    last drop with the account has for it."""
    name = F.max("name") if drop is None else F.max(F.struct("_drop", "name"))["name"]
    own = [] if drop is None else [F.col(drop).alias("_drop")]
    return (extract.select(account_id(F.col("accountID")).alias("id"), F.col("account").alias("name"), *own)
            .groupBy("id").agg(name.alias("name")))


def account_merge(current: DataFrame, batch: DataFrame, broadcast_check: bool = True) -> DataFrame:
    """Type-1 merge on id: ``(id, name, change)``.

    The batch's name wins (even a null one), other accounts keep theirs;
    ``change`` is ``new`` (id not in the dimension), ``renamed`` (name
    differs, null-safe) or null.

    The batch holds one row per account of one week, the dimension every
    account ever seen. When a count shows the batch fits the broadcast
    bound, the batch is broadcast: untouched accounts pass through an anti
    join where they are read, and only the old rows of the batch's ids meet
    the batch. Otherwise one full outer join on the id does the same.
    """
    def label(sent_name, old_name, known):
        return (F.when(~known, F.lit("new"))
                .when(~sent_name.eqNullSafe(old_name), F.lit("renamed")))

    if broadcast_check and fits_broadcast(batch):
        b = F.broadcast(batch.select("id", "name"))
        kept = (current.select("id", "name").join(b.select("id"), "id", "left_anti")
                .select("id", "name", F.lit(None).cast("string").alias("change")))
        before = current.select("id", F.col("name").alias("_old"), F.lit(True).alias("_known")) \
            .join(b.select("id"), "id", "left_semi")
        sent = b.join(before, "id", "left")
        changed = sent.select("id", "name", label(F.col("name"), F.col("_old"),
                                                   F.col("_known").isNotNull()).alias("change"))
        return kept.unionByName(changed)

    c = current.select("id", F.col("name").alias("_old"), F.lit(True).alias("_known"))
    bt = batch.select("id", F.col("name").alias("_new"), F.lit(True).alias("_sent"))
    j = c.join(bt, "id", "full_outer")
    sent = F.col("_sent").isNotNull()
    change = F.when(sent, label(F.col("_new"), F.col("_old"), F.col("_known").isNotNull()))
    return j.select("id", F.when(sent, F.col("_new")).otherwise(F.col("_old")).alias("name"),
                    change.alias("change"))


def changed_accounts(current: DataFrame, batch: DataFrame, small: bool) -> DataFrame:
    """The batch's accounts ``(id, name, change)`` that are new or whose name differs. The dimension is read in
    place where the batch is ``small``, that is, fits a broadcast: only rows of the batch's ids leave the scan."""
    batch = batch.select("id", "name")
    ids = batch.select(F.col("id").alias("_id"))
    known = current.select(F.col("id").alias("_id"), F.col("name").alias("_old"), F.lit(True).alias("_known"))
    if small:
        known = known.join(F.broadcast(ids), "_id", "left_semi")
    both = batch.join(known, F.col("id") == F.col("_id"), "left")
    change = (F.when(F.col("_known").isNull(), F.lit("new"))
              .when(~F.col("name").eqNullSafe(F.col("_old")), F.lit("renamed")))
    return both.select("id", "name", change.alias("change")).where(F.col("change").isNotNull())


def upsert_accounts(current: DataFrame, batch: DataFrame) -> DataFrame:
    """Account dimension after the type-1 upsert: ``(id, name)``."""
    return account_merge(current, batch).select("id", "name")


def account_changes(current: DataFrame, batch: DataFrame) -> DataFrame:
    """Batch accounts that are new or renamed, with a ``change`` label."""
    return account_merge(current, batch).where(F.col("change").isNotNull())
