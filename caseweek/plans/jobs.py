"""Weekly jobs: load (append / overwrite touched weeks) and update (upsert).

``read -> maintain dimensions -> code rows -> look up ids -> assign week
partitions -> write facts -> write findings``; every step is a lazy
DataFrame plan and no row data is collected to the driver. Driver-side
values are bounded metadata only: per-dimension counts of added members,
row and byte counts before broadcasts, the list of touched (year, week)
partitions of an upsert (bounded by the calendar, capped), and the data
folders of the tables' versions.

Facts and dimensions are versioned tables (``versions``): a load writes new
folders and puts them in place at the end, so it may run beside others.
"""

from __future__ import annotations

import datetime as _dt
import uuid
from dataclasses import dataclass

from pyspark import StorageLevel
from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StringType, StructField, StructType

from ..functions import run_stamp
from ..operators import (batch_accounts, batch_members, changed_accounts, code_cases, dense_ids, explode_findings,
                         last_drops, lookup_ids, max_ids, merge_partitions, new_members, to_facts, to_long,
                         touched_partitions)
from ..schemas import (ACCOUNT_DIM_SCHEMA, FACT_COLUMNS, FACT_SCHEMA, FINDINGS_SCHEMA, NAME_DIM_SCHEMA,
                       PARTITION_COLUMNS, VERSION_DIM_SCHEMA)
from ..session import fits_broadcast, path_exists, row_bytes
from ..sinks import replace_table, write_batch, write_facts, write_findings
from ..sources import (DROP, DROP_NUMBER, fact_versions, number_drops, read_dimension, read_extract, read_facts,
                       read_partitions, read_staging, refused_findings, refused_rows, split_refused)
from ..sources import read_accounts as _read_accounts
from ..sources.tables import LOAD
from ..specs import SURROGATE_DIMENSIONS, DimensionSpec
from ..versions import ATTEMPTS, Conflict, Folder, Version, VersionedTable


@dataclass(frozen=True)
class Warehouse:
    """Folder layout of one warehouse (a shared file-system root).

    ``table`` names the fact table and its folder. With ``catalog_prefix``
    set, the tables are also kept in the catalog (``<prefix><table>`` and so
    on, created on first use): every load registers the week folders that it
    put in place and removes those it replaced, so that the catalog answers
    partition filters on ``spark.table``.
    """
    root: str
    fmt: str = "orc"
    catalog_prefix: str | None = None
    table: str = "cases"

    @property
    def fact_table(self) -> str | None:
        return None if self.catalog_prefix is None else f"{self.catalog_prefix}{self.table}"

    @property
    def facts(self) -> str:
        return f"{self.root}/{self.table}"

    @property
    def refused(self) -> str:
        return f"{self.root}/refused"

    @property
    def findings(self) -> str:
        return f"{self.root}/findings"

    @property
    def ledger(self) -> str:
        return f"{self.root}/processed"

    def dimension(self, name: str) -> str:
        return f"{self.root}/{name}"


def _dim_schema(spec: DimensionSpec):
    return VERSION_DIM_SCHEMA if spec.key == "version" else NAME_DIM_SCHEMA


def dimension_versions(spark: SparkSession, wh: Warehouse) -> dict[str, Version]:
    """The newest version of each surrogate dimension."""
    return {s.name: VersionedTable(spark, wh.dimension(s.name)).current() for s in SURROGATE_DIMENSIONS}


def read_surrogates(spark: SparkSession, wh: Warehouse, versions: dict[str, Version] | None = None) -> DataFrame:
    """All surrogate dimensions in long form ``(dimension, member, id)``."""
    versions, out = versions or dimension_versions(spark, wh), None
    for spec in SURROGATE_DIMENSIONS:
        stored = read_dimension(spark, wh.dimension(spec.name), _dim_schema(spec), wh.fmt, versions[spec.name])
        d = to_long(stored, spec)
        out = d if out is None else out.unionByName(d)
    return out


def fact_rows(spark: SparkSession, wh: Warehouse) -> DataFrame:
    """The fact table: the catalog table in catalog mode, else the folder."""
    if wh.fact_table is None:
        return read_facts(spark, wh.facts, wh.fmt)
    register_tables(spark, wh, prefix=wh.catalog_prefix)
    return spark.table(wh.fact_table).select(*FACT_COLUMNS, *PARTITION_COLUMNS)


def read_accounts(spark: SparkSession, wh: Warehouse) -> DataFrame:
    return _read_accounts(spark, wh.dimension("account"), wh.fmt)


@dataclass
class DimensionUpdate:
    surrogates: DataFrame        # stored surrogate dimensions after the update, long form
    added: dict[str, int]        # new members per surrogate dimension
    account_changes: int         # new or renamed accounts
    batch: str | None = None     # label of the load in the findings and the refused rows
    rows: int = 0                # rows of the extract, refused ones too
    refused: int = 0             # rows without a readable case number, or that don't fit the layout


#: Folder beside the dimensions' own that holds the members added by each load, all dimensions in one write.
MEMBERS = "members"


def grow_surrogates(spark: SparkSession, wh: Warehouse, members: DataFrame) -> dict[str, int]:
    """Add the new ones among ``members(dimension, member[, _first])`` to the dimensions, with dense ids after
    the largest; how many each dimension got.

    The ids go by the version that was read. A dimension that another load has added to since then isn't
    given these ids: its members are compared and numbered again on its new state, so that two loads at
    once never give an id twice, nor a member two ids.
    """
    added: dict[str, int] = {}
    waiting = {s.name for s in SURROGATE_DIMENSIONS}
    for _ in range(ATTEMPTS):
        versions = dimension_versions(spark, wh)
        current, sizes = read_surrogates(spark, wh, versions), {}
        new = new_members(members.where(F.col("dimension").isin(sorted(waiting))), current).persist(StorageLevel.MEMORY_AND_DISK)
        try:
            numbered = dense_ids(new, max_ids(current), sizes)
            if not sizes:
                return added
            folder = f"{LOAD}={uuid.uuid4().hex}"
            # a dimension reads its own key column of the two
            (numbered.select("dimension", F.col("member").alias("version"), F.col("member").alias("name"), "id")
             .hint("rebalance", "dimension").write.format(wh.fmt).partitionBy("dimension").save(f"{wh.root}/{MEMBERS}/{folder}"))
        finally:
            new.unpersist()
        for name in sorted(sizes):
            own = Folder(f"../{MEMBERS}/{folder}/dimension={name}", ("members",))
            try:
                VersionedTable(spark, wh.dimension(name)).publish(versions[name], [*versions[name].folders, own])
            except Conflict:
                continue
            added[name] = sizes[name]
            waiting.discard(name)
        if not waiting & set(sizes):
            return added
    raise Conflict(f"dimensions {sorted(waiting)} kept changing")


#: Changed accounts, as a share of the base, and change files after which the account table is written anew.
COMPACT_SHARE = 0.25
COMPACT_FILES = 64
#: Parts that a change of at most what fits a broadcast is dealt into before AQE joins the small ones.
CHANGE_PARTS = 8


def grow_accounts(spark: SparkSession, wh: Warehouse, batch: DataFrame) -> int:
    """Upsert a batch's account names ``(id, name)``; how many are new or renamed.

    Only those accounts are written, as a change that readers put over the base. Once the changes are many,
    base and changes are written anew as one base.
    """
    path = wh.dimension("account")
    table = VersionedTable(spark, path)
    batch = batch.persist(StorageLevel.MEMORY_AND_DISK)
    try:
        small = fits_broadcast(batch)
        for _ in range(ATTEMPTS):
            now = table.current()
            current = _read_accounts(spark, path, wh.fmt, now)
            folder, size = table.new_folder(now), Observation()
            changed = changed_accounts(current, batch, small).select("id", "name")
            # few files; a coalesce(1) would pull the join and its sorts of all partitions into the one writing task
            changed = changed.hint("rebalance", CHANGE_PARTS) if small else changed
            (changed.observe(size, F.count(F.lit(1)).alias("n"), F.sum(row_bytes(changed)).alias("bytes"))
             .write.format(wh.fmt).save(f"{path}/{folder}"))
            n, bytes_ = size.get["n"], size.get["bytes"] or 0    # counted while it was written
            if not n:
                table.drop_folder(folder)
                return 0
            kind = "change" if now.folders else "base"
            try:
                new = table.publish(now, [*now.folders, Folder(folder, (kind, n, bytes_))])
            except Conflict:
                table.drop_folder(folder)
                continue
            if _many_changes(new):
                compact_accounts(spark, wh)
            return n
        raise Conflict(f"{path} kept changing")
    finally:
        batch.unpersist()


def _many_changes(version: Version) -> bool:
    changes = [f.part[1] for f in version.folders if f.part[0] == "change"]
    base = [f.part[1] for f in version.folders if f.part[0] == "base" and len(f.part) > 1]
    return len(changes) > COMPACT_FILES or bool(base) and sum(changes) > max(COMPACT_SHARE * sum(base), 1000)


def compact_accounts(spark: SparkSession, wh: Warehouse) -> None:
    """Write the account table anew as one base. If another load changes it meanwhile, its changes stay."""
    path = wh.dimension("account")
    table = VersionedTable(spark, path)
    now = table.current()
    folder = table.new_folder(now)
    _read_accounts(spark, path, wh.fmt, now).hint("rebalance").write.format(wh.fmt).save(f"{path}/{folder}")
    rows = sum(f.part[1] for f in now.folders if len(f.part) > 1)
    for _ in range(ATTEMPTS):
        latest = table.current()
        later = [f for f in latest.folders if f not in now.folders]
        if not all(f in latest.folders for f in now.folders):
            break                                     # somebody else has compacted it
        try:
            table.publish(latest, [Folder(folder, ("base", rows)), *later])
            return
        except Conflict:
            continue
    table.drop_folder(folder)


def maintain_dimensions(spark: SparkSession, wh: Warehouse, extract: DataFrame) -> DimensionUpdate:
    """Add the batch's new members (dense ids after the current max) and
    upsert account names; write only what is new or changed. An extract of
    several drops gives what loading them one after another gives. Dimensions
    are written before any fact row, as a reload relies on it.
    """
    drop = next((c for c in (DROP_NUMBER, DROP) if c in extract.columns), None)
    added = grow_surrogates(spark, wh, batch_members(extract, drop=drop))
    changes = grow_accounts(spark, wh, batch_accounts(extract, drop))
    # not persisted: the lookups then share one broadcast, and the tables are small files
    return DimensionUpdate(read_surrogates(spark, wh), added, changes)


def compact_dimensions(spark: SparkSession, wh: Warehouse) -> None:
    """Rewrite each dimension into few files: weekly appends of a
    few new members leave one small file per load. A REBALANCE lets AQE size
    the output (one file for a small table). Contents and ids stay the same.
    """
    for spec in SURROGATE_DIMENSIONS:
        path = wh.dimension(spec.name)
        table = VersionedTable(spark, path)
        now = table.current()
        if len(now.folders) < 2:
            continue
        folder = table.new_folder(now)
        dim = read_dimension(spark, path, _dim_schema(spec), wh.fmt, now)
        dim.hint("rebalance").write.format(wh.fmt).save(f"{path}/{folder}")
        try:
            table.publish(now, [Folder(folder, ("base",))])
        except Conflict:
            table.drop_folder(folder)                 # a load has added members; compact another time
    compact_accounts(spark, wh)


def remove_unused(spark: SparkSession, wh: Warehouse, keep_versions: int = 2, older_than_hours: float = 24.0) -> int:
    """Delete the folders of facts and dimensions that none of the newest versions lists. How many went."""
    gone, members = fact_versions(spark, wh.facts).clean(keep_versions, older_than_hours), set()
    for name in ("account", *(s.name for s in SURROGATE_DIMENSIONS)):
        table = VersionedTable(spark, wh.dimension(name))
        gone += table.clean(keep_versions, older_than_hours)
        members |= {f.path.split("/")[2] for f in table.listed(keep_versions) if f.path.startswith(f"../{MEMBERS}/")}
    return gone + VersionedTable(spark, f"{wh.root}/{MEMBERS}").drop_others(members, older_than_hours)


# ---- Fixed values: staging text layouts (separator, header line) -------------
ACCOUNT_STAGING_SEP = "$"
PRODUCT_STAGING_SEP = ","
# ------------------------------------------------------------------------------


def bootstrap_dimensions(spark: SparkSession, wh: Warehouse, *, account_staging: str | None = None,
                         product_staging: str | None = None) -> None:
    """Load the account and/or product dimension from delimited staging text
    (``name``, ``ID``; one header line; ``$`` resp. ``,`` separated),
    replacing the table. The id text becomes an int; rows whose id is none
    are left out. A product name listed several times gets its smallest id
    and an account id its largest name, so that every member has one row.
    """
    number = F.col("ID").try_cast("int").alias("id")
    if account_staging:
        stg = read_staging(spark, account_staging, ACCOUNT_STAGING_SEP).select(number, "name")
        replace_table(stg.where("id IS NOT NULL").groupBy("id").agg(F.max("name").alias("name")),
                      wh.dimension("account"), wh.fmt)
    if product_staging:
        stg = read_staging(spark, product_staging, PRODUCT_STAGING_SEP).select("name", number)
        replace_table(stg.where("id IS NOT NULL").groupBy("name").agg(F.min("id").alias("id")),
                      wh.dimension("product"), wh.fmt)


def _label(label: str, extract: DataFrame) -> Column:
    """Label of a row's load: the load's own, with a digest of the file where each file is a drop."""
    if DROP not in extract.columns:
        return F.lit(label)
    return F.concat(F.lit(f"{label}-"), F.substring(F.sha1(F.col(f"{DROP}.file")), 1, 12))


def load_frame(spark: SparkSession, extract: DataFrame, wh: Warehouse, *, mode: str = "append",
               as_of: _dt.date | None = None, batch_label: str | None = None) -> DimensionUpdate:
    """Load an extract DataFrame: ``mode`` is append, overwrite (only the
    touched week partitions are replaced) or upsert (case number within its
    week partition is the key).

    Rows without a readable case number have no key, and lines with too few or
    too many fields can't be trusted: they are kept apart in the ``refused``
    table, as raw lines under the load's label, and reach neither facts nor
    dimensions. The label is unique unless given.

    An extract with the column ``_drop`` holds several drops (files). It is
    loaded in one pass, with the rows that loading them one after another, in
    the column's order, would leave; findings, refused rows and ledger rows
    are kept for each drop under a label of its own.
    """
    if mode not in ("append", "overwrite", "upsert"):
        raise ValueError(f"unknown load mode {mode!r}")
    as_of = as_of or _dt.date.today()
    label = batch_label or f"{_dt.datetime.now():%Y%m%d%H%M%S}-{uuid.uuid4().hex[:12]}"
    own = (DROP,) if DROP in extract.columns else ()
    held = extract.storageLevel.useMemory or extract.storageLevel.useDisk     # by the caller, who reads it again later
    scanned = extract if held else extract.persist(StorageLevel.MEMORY_AND_DISK)
    coded = listed = None
    try:
        numbered, listed = number_drops(scanned) if own else (scanned, None)
        cases, refused = split_refused(numbered)
        dims = maintain_dimensions(spark, wh, cases)
        # coded rows feed both the fact and the findings write: code once
        coded = code_cases(cases, as_of, (*own, DROP_NUMBER) if own else ()).persist(StorageLevel.MEMORY_AND_DISK)
        batch = last_drops(coded, DROP_NUMBER, mode) if own else coded
        facts = to_facts(lookup_ids(batch, dims.surrogates))
        _store_facts(spark, wh, facts, touched_partitions(coded), mode)
        n = scanned.agg(F.count(F.lit(1)).alias("rows"), F.count(F.when(refused_rows(scanned), 1)).alias("refused")).first()
        counts = n["rows"], n["refused"]
        findings = explode_findings(coded, own)
        if counts[1]:
            findings = findings.unionByName(refused_findings(refused))
            write_batch(refused.select("line", "reason", _label(label, extract).alias("batch")), wh.refused, wh.fmt)
        write_findings(findings.select("case_num", "code", "message", _label(label, extract).alias("batch")),
                       wh.findings, wh.fmt)
        if wh.catalog_prefix is not None:
            register_tables(spark, wh, prefix=wh.catalog_prefix)
        dims.batch, dims.rows, dims.refused = label, *counts
        return dims
    finally:
        for kept in (coded, listed):
            if kept is not None:
                kept.unpersist()
        if not held:
            scanned.unpersist()


def _store_facts(spark: SparkSession, wh: Warehouse, facts: DataFrame, touched: DataFrame, mode: str) -> None:
    """Append the rows, overwrite their weeks or put them into their weeks by case number. An upsert whose weeks
    another load changes meanwhile is made again from their new rows."""
    if mode != "upsert":
        write_facts(facts, wh.facts, mode, wh.fmt)
        return
    for _ in range(ATTEMPTS):
        version = fact_versions(spark, wh.facts).current()
        # the partition keys come straight from the coded rows (no lookups needed)
        current = read_partitions(spark, wh.facts, touched, wh.fmt, version=version)
        try:
            write_facts(merge_partitions(current, facts, scoped=True), wh.facts, "overwrite", wh.fmt, version)
            return
        except Conflict:
            continue
    raise Conflict(f"{wh.facts} kept changing")


def write_ledger(spark: SparkSession, wh: Warehouse, extract: DataFrame, label: str, query_id: str,
                 batch_id: int) -> None:
    """A ledger row for each drop of an extract that has been loaded."""
    ledger = extract.groupBy(DROP).agg(F.count(F.lit(1)).alias("rows")).select(
        F.lit(query_id).alias("query_id"), F.lit(batch_id).cast("long").alias("batch_id"),
        F.col(f"{DROP}.file").alias("file"), F.col(f"{DROP}.time").alias("time"),
        run_stamp(F.current_date()).alias("run_date"), "rows", _label(label, extract).alias("batch"))
    write_batch(ledger, wh.ledger, wh.fmt)


def _load_file(spark: SparkSession, path: str, wh: Warehouse, mode: str, as_of: _dt.date | None, sep: str,
               once: bool) -> DimensionUpdate:
    if not once:
        return load_frame(spark, read_extract(spark, path, sep, raw_line=True), wh, mode=mode, as_of=as_of)
    extract = read_extract(spark, path, sep, drops=True)
    if path_exists(spark, wh.ledger):
        known = spark.read.format(wh.fmt).load(wh.ledger).select(F.col("file").alias("_file"), F.col("time").alias("_time"))
        extract = extract.join(known, (F.col(f"{DROP}.file") == F.col("_file")) & (F.col(f"{DROP}.time") == F.col("_time")),
                               "left_anti")
    extract = extract.persist(StorageLevel.MEMORY_AND_DISK)
    try:
        loaded = load_frame(spark, extract, wh, mode=mode, as_of=as_of)
        if loaded.rows:
            write_ledger(spark, wh, extract, loaded.batch, "load", 0)
        return loaded
    finally:
        extract.unpersist()


def load_batch(spark: SparkSession, path: str, wh: Warehouse, *, overwrite: bool = False,
               as_of: _dt.date | None = None, sep: str = ",", once: bool = False) -> DimensionUpdate:
    """Weekly load of an extract file (append, or overwrite touched weeks). With ``once``, files whose name and
    time the ledger has are left out, and the others are entered in it."""
    return _load_file(spark, path, wh, "overwrite" if overwrite else "append", as_of, sep, once)


def update_batch(spark: SparkSession, path: str, wh: Warehouse, *, as_of: _dt.date | None = None,
                 sep: str = ",", once: bool = False) -> DimensionUpdate:
    """Weekly update: upsert by case number inside each touched week. ``once`` as for ``load_batch``."""
    return _load_file(spark, path, wh, "upsert", as_of, sep, once)


def _ddl_columns(schema) -> str:
    return ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in schema.fields)


#: Partitions registered or removed by one statement.
DDL_PARTITIONS = 500


def _sync(spark: SparkSession, name: str, table: VersionedTable, spec) -> None:
    """Make a catalog table's partitions those of the newest version: ``spec(folder)`` gives a folder's
    partition values."""
    want = {spec(f): table.location(f) for f in table.current().folders}
    have = {tuple(p.split("=", 1)[1] for p in r[0].split("/")) for r in spark.sql(f"SHOW PARTITIONS `{name}`").collect()}
    columns = [LOAD, *PARTITION_COLUMNS]

    def clause(values: tuple[str, ...]) -> str:
        return "PARTITION (" + ", ".join(f"{c}='{v}'" for c, v in zip(columns, values)) + ")"

    new, gone = sorted(set(want) - have), sorted(have - set(want))
    for i in range(0, len(new), DDL_PARTITIONS):
        added = " ".join(f"{clause(v)} LOCATION '{want[v]}'" for v in new[i:i + DDL_PARTITIONS])
        spark.sql(f"ALTER TABLE `{name}` ADD IF NOT EXISTS {added}")
    for i in range(0, len(gone), DDL_PARTITIONS):
        spark.sql(f"ALTER TABLE `{name}` DROP IF EXISTS " + ", ".join(map(clause, gone[i:i + DDL_PARTITIONS])))
    spark.catalog.refreshTable(name)


def _load_of(folder: Folder) -> str:
    """The load that a folder was written by; a text of its own for folders that have none."""
    return next((p.split("=", 1)[1] for p in folder.path.split("/") if p.startswith(f"{LOAD}=")), "plain")


def register_tables(spark: SparkSession, wh: Warehouse, prefix: str = "") -> dict[str, str]:
    """Expose the warehouse as catalog tables (``USING <fmt>``): the
    partitioned fact table, the five dimensions, the findings and the refused
    lines.

    Tables are external, so dropping one keeps its files. Facts and dimensions
    have the load that wrote a row as one more partition column; every call
    makes their partitions those of the newest version. The accounts are a
    view that takes each one's last name from ``<prefix>account_changes``.
    Findings and refused lines have a partition for each load.
    Returns ``{logical name: table name}``.
    """
    names = {}

    def create(logical: str, schema, location: str, partitioned: str) -> str:
        name = names[logical] = f"{prefix}{logical}"
        if not spark.catalog.tableExists(name):
            spark.sql(f"CREATE TABLE IF NOT EXISTS `{name}` ({_ddl_columns(schema)}) USING {wh.fmt} "
                      f"PARTITIONED BY ({partitioned}) LOCATION '{location}'")
        return name

    load = StructField(LOAD, StringType(), True)
    facts = create(wh.table, StructType([*FACT_SCHEMA.fields, load]), wh.facts, f"{LOAD}, year, week")
    _sync(spark, facts, fact_versions(spark, wh.facts), lambda f: (_load_of(f), *f.part))
    for spec in SURROGATE_DIMENSIONS:
        path = wh.dimension(spec.name)
        name = create(spec.name, StructType([*_dim_schema(spec).fields, load]), path, LOAD)
        _sync(spark, name, VersionedTable(spark, path), lambda f: (_load_of(f),))
    accounts = create("account_changes", StructType([*ACCOUNT_DIM_SCHEMA.fields, load]), wh.dimension("account"), LOAD)
    _sync(spark, accounts, VersionedTable(spark, wh.dimension("account")), lambda f: (_load_of(f),))
    names["account"] = f"{prefix}account"
    spark.sql(f"CREATE OR REPLACE VIEW `{names['account']}` AS SELECT id, max(struct({LOAD}, name)).name AS name "
              f"FROM `{accounts}` GROUP BY id")
    batch = StructField("batch", StringType(), True)
    texts = [StructField(c, StringType(), True) for c in ("line", "reason")]
    for logical, schema, location in (("findings", StructType([*FINDINGS_SCHEMA.fields, batch]), wh.findings),
                                      ("refused", StructType([*texts, batch]), wh.refused)):
        name = create(logical, schema, location, "batch")
        if path_exists(spark, location):
            spark.sql(f"ALTER TABLE `{name}` RECOVER PARTITIONS")
            spark.catalog.refreshTable(name)
    return names
