"""Saving tables: load date, create-or-merge, keyed upsert (operators S4-S9).

Without a table format that supports row-level MERGE, an upsert is expressed with plain
DataFrame operations over the parts of a table that the batch's keys fall in:

    kept   = touched target LEFT ANTI JOIN source ON all keys equal
    result = kept UNION ALL source

which is "update every matched row with the source row, insert unmatched source rows,
keep target-only rows" whenever each target row matches at most one source row.  The
result is written next to the last version (``sources.versions``), so a failed job leaves
that version in place, and parts no key falls in are neither read nor written.
"""

from __future__ import annotations

import datetime as dt
import re
import zlib
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from orderlake.functions.naming import snake_case_columns, to_snake_case
from orderlake.operators.metrics import materialize
from orderlake.sources import versions as V
from orderlake.sources.changes import KIND, SIGN, compare, prefixed, same_keys
from orderlake.sources.reconcile import common_schema, conform
from orderlake.sources.versions import stored_versions

__all__ = ["check_unique_source_keys", "merge_by_key", "read_changes", "replace_groups", "save_with_merge",
           "stored_versions", "touched_parts", "with_load_date"]

#: Stored bytes per part when a table is first dealt into parts, and the most parts it gets.
PART_BYTES = 256 << 20
MOST_PARTS = 4096
INTEGRAL = ("tinyint", "smallint", "int", "bigint")


def with_load_date(df: DataFrame, date: dt.date | None = None) -> DataFrame:
    """Add ``load_date``: today's date, or the given one for reproducible loads."""
    return df.withColumn("load_date", F.current_date() if date is None else F.lit(date))


def _key_condition(target: DataFrame, source: DataFrame, keys: list[str], null_safe: bool):
    cond = None
    for k in keys:
        part = target[k].eqNullSafe(source[k]) if null_safe else target[k] == source[k]
        cond = part if cond is None else cond & part
    return cond


def check_unique_source_keys(target: DataFrame, source: DataFrame, keys: list[str],
                             null_safe: bool = False) -> None:
    """Raise if two source rows share a key that matches a target row.

    One aggregate over the source keys (map-side partial counts) and a semi join with the
    target; only a yes/no comes back to the driver.
    """
    dup = source.groupBy(*keys).count().where(F.col("count") > 1).drop("count")
    if not null_safe:
        dup = dup.dropna(subset=keys)
    if dup.limit(1).count() == 0:  # the usual case: the target is not read for the check
        return
    hit = dup.join(target.select(*keys), _key_condition(dup, target.select(*keys), keys,
                                                        null_safe), "left_semi")
    if hit.limit(1).count() > 0:
        raise ValueError(f"merge source has several rows for one target key {keys}")


def merge_by_key(target: DataFrame, source: DataFrame, keys: list[str],
                 null_safe: bool = False, check: bool = True) -> DataFrame:
    """Upsert ``source`` into ``target`` on ``keys`` (S7), columns matched by name.

    A null key never matches (so it is inserted again), unless ``null_safe``.
    """
    if check:
        check_unique_source_keys(target, source, keys, null_safe)
    src_keys = source.select(*[F.col(k).alias(f"__src_{k}") for k in keys])
    cond = None
    for k in keys:
        part = (target[k].eqNullSafe(src_keys[f"__src_{k}"]) if null_safe
                else target[k] == src_keys[f"__src_{k}"])
        cond = part if cond is None else cond & part
    kept = target.join(src_keys, cond, "left_anti")
    return kept.unionByName(source.select(*target.columns))


# --- parts -----------------------------------------------------------------------------

@dataclass(frozen=True)
class Layout:
    """Rows dealt into ``count`` parts by a hash of ``keys``; rows with a null key, which never
    match, into a part per version (unless ``null_safe``)."""

    keys: tuple[str, ...]
    count: int
    null_safe: bool

    @property
    def tag(self) -> str:
        """What a part name says of the layout, so that a table tells its layout by itself."""
        named = ",".join(self.keys) + ("?" if self.null_safe else "")
        return f"{self.count:05d}-{zlib.crc32(named.encode()):08x}"

    def part(self, number: int) -> Column:
        """The part of a row that version ``number`` writes."""
        # as text, so that a key keeps its part when its column is widened
        keys = [F.col(f"`{k}`").cast("string") for k in self.keys]
        hashed = F.format_string(f"%05d-{self.tag}", F.pmod(F.xxhash64(*keys), F.lit(self.count)).cast("int"))
        if self.null_safe:
            return hashed
        missing = F.lit(False)
        for k in keys:
            missing = missing | k.isNull()
        return F.when(missing, F.lit(f"null-{number:05d}")).otherwise(hashed)


def _layout_of(state: V.State, keys: list[str], null_safe: bool) -> Layout | None:
    """The layout of a stored table if it is the one that ``keys`` need."""
    names = [p for p in state.parts if re.fullmatch(r"\d{5}-\d{5}-[0-9a-f]{8}", p)]
    if not names or any(p not in names and not p.startswith("null-") for p in state.parts):
        return None
    layout = Layout(tuple(keys), int(names[0][6:11]), null_safe)
    return layout if all(p[6:] == layout.tag for p in names) else None


def touched_parts(state: V.State, keys: list[str], null_safe: bool, rows: DataFrame) -> set[str] | None:
    """The stored parts that hold the keys of ``rows``; None where the table is not dealt by these keys.  At most as
    many names as the table has parts come to the driver."""
    layout = _layout_of(state, keys, null_safe)
    if layout is None:
        return None
    names = {r[0] for r in rows.select(layout.part(0)).distinct().collect()}
    if any(n.startswith("null-") for n in names):
        names |= {p for p in state.parts if p.startswith("null-")}
    return names & set(state.parts)


def _kept_types(stored: T.StructType, merged: T.StructType, keys: list[str]) -> bool:
    """Whether the keys' text, and so their part, is the same under both schemas."""
    old = {f.name: f.dataType.simpleString() for f in stored.fields}
    new = {f.name: f.dataType.simpleString() for f in merged.fields}
    return all(k in old and (old[k] == new[k] or {old[k], new[k]} <= set(INTEGRAL)) for k in keys)


def _write_parts(rows: DataFrame, part: Column, folder: str, fmt: str) -> None:
    """Rows to the folders of their parts.  The shuffle gathers a part in one task, or in several where it is large."""
    dealt = rows.withColumn(V.PART, part).hint("rebalance", F.col(V.PART))
    dealt.write.mode("errorifexists").partitionBy(V.PART).format(fmt).save(folder)


def _keep_schema(rows: DataFrame, folder: str, fmt: str) -> None:
    """A whole version without rows still has a file, which has its columns."""
    files = V.Files(rows.sparkSession, folder)
    if not files.has_data(files.at):
        rows.limit(0).write.mode("append").format(fmt).save(folder)


# --- saving ----------------------------------------------------------------------------

def save_with_merge(df: DataFrame, path: str, database: str, table: str,
                    keys: list[str] | str | None, load_date: dt.date | None = None,
                    null_safe: bool = False, fmt: str = "parquet",
                    replace_by: list[str] | None = None, append: bool = False,
                    keep_versions: int = 2, groups: DataFrame | None = None,
                    batch: str | None = None, parts: int | None = None,
                    changes: bool = False) -> DataFrame:
    """Snake-case the columns, stamp the load date, then create or merge.

    Whether this is the first load is told from ``path`` (S6): data files there, whoever wrote
    them, are the table, and are never written over.

    * ``keys`` (a list or comma-separated text, snake-cased like the columns) upserts by key (S7);
    * ``replace_by`` replaces the groups that the batch holds and keeps all others; ``groups``, rows
      with those columns, names groups to replace that the batch may have no rows for;
    * ``append`` adds the rows; under the name ``batch`` they replace those of an earlier save of
      that name, so a repeated load changes nothing;
    * with none of them the batch replaces the content (the gold tables).

    The batch and the stored rows are brought to one schema first (``sources.reconcile``): columns that
    one of them lacks are null, types are widened where that is safe, and the save fails before
    it writes anything where it is not.  A table is dealt into parts by a hash of the keys when it is
    first merged (or at once with ``parts``): ``parts`` of them, or one for each ``PART_BYTES`` stored, ``MOST_PARTS``
    at most.  From then on a batch reads and writes the parts its keys fall in.  Of a
    changed table the last ``keep_versions`` versions can be read.

    ``changes`` stores what the save inserted, updated, removed or left (``read_changes``).  Returns the
    table as stored.
    """
    spark = df.sparkSession
    if isinstance(keys, str):
        keys = [k.strip() for k in keys.split(",") if k.strip()]
    keys = [to_snake_case(k) for k in keys] if keys else []
    by = keys or list(replace_by or [])
    rows = with_load_date(snake_case_columns(df), load_date)
    missing = [k for k in by if k not in rows.columns]
    if missing:
        raise ValueError(f"merge keys {missing} are not columns of {rows.columns}")
    if groups is not None:
        groups = snake_case_columns(groups).select(*by)
    path = path.rstrip("/")
    spark.sql(f"CREATE DATABASE IF NOT EXISTS {database}")
    with V.claimed(spark, path):
        state = V.current(spark, path, fmt)
        if state.schema is None:
            _first_load(rows, path, state.number + 1, by, parts, null_safe, append, batch, fmt, changes)
        elif by:
            _merge(rows, path, state, by, bool(keys), null_safe, parts, groups, fmt, changes)
        elif append:
            _append(rows, path, state, batch, fmt, changes)
        else:
            _replace(rows, path, state, fmt, changes)
        V.drop_unused(spark, path, keep_versions)
    saved = V.current(spark, path, fmt)
    _register(spark, f"{database}.{table}", path, saved)
    return saved.read(spark)


def _appended(batch: str | None, number: int) -> str:
    return f"append-{number:05d}" if batch is None else "batch-" + re.sub(r"[^0-9A-Za-z_.]", lambda c: f"-{ord(c[0]):x}-", batch)


def _first_load(rows, path, number, by, parts, null_safe, append, batch, fmt, changes) -> None:
    folder = V.place(path, number, True)
    V.begin(rows.sparkSession, folder)
    if by and parts:
        part = Layout(tuple(by), parts, null_safe).part(number)
    elif append and batch is not None:
        part = F.lit(_appended(batch, number))
    else:
        part = None
    if part is None:
        # the folder may be there, without data files; nothing in it is written over
        rows.write.mode("append").format(fmt).save(folder)
    else:
        rows.withColumn(V.PART, part).hint("rebalance", F.col(V.PART)) \
            .write.mode("append").partitionBy(V.PART).format(fmt).save(folder)
        _keep_schema(rows, folder, fmt)
    if changes:
        # there is nothing to compare with: every row is new
        written = V.State(number, {V.WHOLE: folder}, rows.schema, fmt).read(rows.sparkSession)
        _store_changes(written.select("*", F.lit("inserted").alias(KIND), F.lit(1).alias(SIGN)), path, number)
    V.commit(rows.sparkSession, folder)


def _merge(rows, path, state, by, keyed, null_safe, parts, groups, fmt, changes) -> None:
    spark, number = rows.sparkSession, state.number + 1
    schema = common_schema(state.schema, rows.schema)
    rows = materialize(conform(rows, schema), "batch")
    layout = _layout_of(state, by, null_safe and keyed)
    whole = layout is None or (parts is not None and parts != layout.count) \
        or not _kept_types(state.schema, schema, by)
    if whole:
        stored = V.stored_bytes(spark, state)
        layout = Layout(tuple(by), parts or max(1, min(MOST_PARTS, -(-stored // PART_BYTES))), null_safe and keyed)
    named = rows.select(*by)
    if groups is not None:
        named = named.unionByName(materialize(groups.select(*(F.col(c).cast(schema[c].dataType) for c in by)), "groups"))
    # part names, at most as many as the table has parts
    touched = {r[0] for r in named.select(layout.part(number)).distinct().collect()}
    target = conform(state.read(spark, None if whole else touched), schema)
    if keyed:
        merged = merge_by_key(target, rows, by, null_safe=null_safe)
    else:
        merged = _replaced(target, rows, named, by)
    folder = V.place(path, number, whole)
    V.begin(spark, folder)
    _write_parts(merged, layout.part(number), folder, fmt)
    if whole:
        _keep_schema(merged, folder, fmt)
    if changes:
        right = prefixed(named.distinct(), by)
        old = target.join(right, same_keys(target, right, by, null_safe and keyed), "left_semi")
        _store_changes(compare(old, rows, by), path, number)
    emptied = [] if whole else sorted(touched & set(state.parts) - V.written_parts(spark, folder))
    V.commit(spark, folder, emptied)


def _append(rows, path, state, batch, fmt, changes) -> None:
    spark, number = rows.sparkSession, state.number + 1
    schema = common_schema(state.schema, rows.schema)
    part = _appended(batch, number)
    folder = V.place(path, number, False)
    V.begin(spark, folder)
    conform(rows, schema).withColumn(V.PART, F.lit(part)).write.mode("errorifexists") \
        .partitionBy(V.PART).format(fmt).save(folder)
    if changes:
        new = V.State(number, {part: f"{folder}/{V.PART}={part}"} if V.written_parts(spark, folder) else {}, schema, fmt)
        _store_changes(compare(conform(state.read(spark, {part}), schema), new.read(spark), []), path, number)
    emptied = sorted({part} & set(state.parts) - V.written_parts(spark, folder))
    V.commit(spark, folder, emptied)


def _replace(rows, path, state, fmt, changes) -> None:
    spark, number = rows.sparkSession, state.number + 1
    folder = V.place(path, number, True)
    V.begin(spark, folder)
    rows.write.mode("errorifexists").format(fmt).save(folder)
    if changes:
        schema = common_schema(state.schema, rows.schema)
        new = V.State(number, {V.WHOLE: folder}, rows.schema, fmt).read(spark)
        _store_changes(compare(conform(state.read(spark), schema), conform(new, schema), []), path, number)
    V.commit(spark, folder)


def _replaced(target: DataFrame, rows: DataFrame, named: DataFrame, by: list[str]) -> DataFrame:
    right = prefixed(named.distinct(), by)
    return target.join(right, same_keys(target, right, by, False), "left_anti").unionByName(rows.select(*target.columns))


def replace_groups(target: DataFrame, source: DataFrame, columns: list[str]) -> DataFrame:
    """``target`` without the groups (values of ``columns``) that ``source`` has, plus
    ``source``: for tables with several rows per order.  A null group is never replaced."""
    return _replaced(target, source, source.select(*columns), columns)


# --- changes ---------------------------------------------------------------------------

def _store_changes(rows: DataFrame, path: str, number: int) -> None:
    """The changes of one version, in a folder of its own; written before the version counts."""
    rows.write.mode("overwrite").parquet(f"{path}__changes/version={number}")


def read_changes(spark: SparkSession, path: str, version: int | None = None) -> DataFrame:
    """What saves with ``changes`` did: rows of the table with ``change_kind``, ``change_sign`` and ``version``;
    of one version or, by default, of the last."""
    path = path.rstrip("/")
    if version is None:
        files = V.Files(spark, f"{path}__changes")
        done = {v for v, _ in stored_versions(spark, path)}
        found = [int(n.partition("=")[2]) for n, _ in files.folders(files.at)]
        version = max((n for n in found if n in done), default=None)
        if version is None:
            raise FileNotFoundError(f"no changes are stored for {path}")
    return spark.read.parquet(f"{path}__changes/version={version}").withColumn("version", F.lit(version))


# --- the catalog -----------------------------------------------------------------------

def _sql_type(spark: SparkSession, kind: T.DataType) -> str:
    return spark.sparkContext._jvm.org.apache.spark.sql.types.DataType.fromJson(kind.json()).sql()


def _register(spark: SparkSession, name: str, path: str, state: V.State) -> None:
    """Let the catalog table ``name`` show the parts of ``state``; a table in parts has the column ``key_part``."""
    folders = {p: d for p, d in state.parts.items() if d is not None}
    flat = set(folders) == {V.WHOLE}
    columns = [(f.name, f.dataType) for f in state.schema.fields]
    known: dict[str, str] | None = None
    if spark.catalog.tableExists(name):
        listed = {c.name: c for c in spark.catalog.listColumns(name)}
        same = [(f.name, f.dataType) for f in spark.table(name).schema.fields if f.name != V.PART] == columns
        if same and flat == (V.PART not in listed):
            known = {} if flat else {r[0].partition("=")[2] for r in spark.sql(f"SHOW PARTITIONS {name}").collect()}
        else:
            spark.sql(f"DROP TABLE {name}")  # external: its files stay
    if flat:
        if known is None:
            spark.catalog.createTable(name, path=folders[V.WHOLE], source=state.fmt, schema=state.schema)
        else:
            spark.sql(f"ALTER TABLE {name} SET LOCATION '{folders[V.WHOLE]}'")
    else:
        if known is None:
            made = ", ".join(f"`{n}` {_sql_type(spark, k)}" for n, k in columns)
            spark.sql(f"CREATE TABLE {name} ({made}, {V.PART} STRING) USING {state.fmt} "
                      f"PARTITIONED BY ({V.PART}) LOCATION '{path}__table'")
            known = set()
        for part in sorted(set(known) - set(folders)):
            spark.sql(f"ALTER TABLE {name} DROP PARTITION ({V.PART}='{part}')")
        new = " ".join(f"PARTITION ({V.PART}='{p}') LOCATION '{d}'" for p, d in sorted(folders.items()) if p not in known)
        if new:
            spark.sql(f"ALTER TABLE {name} ADD {new}")
        for part in sorted(set(known) & set(folders)):
            spark.sql(f"ALTER TABLE {name} PARTITION ({V.PART}='{part}') SET LOCATION '{folders[part]}'")
    spark.catalog.refreshTable(name)
