"""Table reads and staged overwrites.

A written table is a catalog entry that points at one version folder (or one a partition);
an overwrite writes the next version and then moves the pointer.
"""

from __future__ import annotations

import json
import logging
import uuid
from urllib.parse import unquote

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from lapworks.session import remove_folder

log = logging.getLogger("lapworks.tables")


class EmptyTableError(ValueError):
    pass


def table_name(layer: str, name: str, season: int | None = None, catalog: str = "spark_catalog") -> str:
    """``catalog.layer.name`` with the ``_<season>`` suffix used by Bronze tables."""
    base = f"{name}_{season}" if season is not None else name
    return f"{catalog}.{layer}.{base}"


def read_table(spark: SparkSession, full_name: str, on_empty: str = "warn") -> DataFrame:
    """Read a table; unreadable -> ``RuntimeError`` (cause chained).

    ``on_empty``: ``warn`` (Bronze: log and return), ``raise`` (Silver: ``EmptyTableError``),
    ``ignore``.  Emptiness is a ``LIMIT 1`` probe, not a full count.
    """
    try:
        df = spark.read.table(full_name)
    except Exception as ex:
        raise RuntimeError(f"Cannot read table '{full_name}'") from ex
    if on_empty != "ignore" and df.isEmpty():
        if on_empty == "raise":
            raise EmptyTableError(f"Table '{full_name}' is empty")
        log.warning("Table %s is empty - downstream results may be incomplete.", full_name)
    return df


def write_table(df: DataFrame, full_name: str, *, fmt: str = "parquet", partition_by=None,
                staged: bool = True, dynamic: bool = False, metrics: dict | None = None,
                require_rows: bool = False) -> dict:
    """Overwrite ``full_name`` with ``df`` (schema replaced), idempotently.

    Staged: the rows go to a new version folder beside the old one; then the catalog entry
    is pointed at it, in one catalog operation (one a partition for a partitioned table).
    The table is there all the time: a reader finds the old rows or the new ones, and one
    that has begun keeps the old files, which stay until the next overwrite but one.  A
    failure at any point leaves the old rows.  A plan that reads the target can overwrite
    it.  A table of another schema, format or partitioning is replaced by renames (see
    ``_swap``).  The row count comes from an ``Observation`` on the same write job.
    Failure -> ``RuntimeError`` naming the table, cause chained.

    ``dynamic=True`` with ``partition_by`` replaces only the partitions present
    in ``df`` (e.g. one season) of an existing table, keeping the others.
    ``metrics`` (name -> aggregate Column) are observed on the same job and returned.
    ``require_rows``: an empty result leaves the target as it is (``rows`` is then 0).
    """
    spark = df.sparkSession
    obs = Observation(f"write_{uuid.uuid4().hex[:8]}")
    extra = [c.alias(n) for n, c in (metrics or {}).items()]
    observed = df.observe(obs, F.count(F.lit(1)).alias("rows"), *extra)
    by = [partition_by] if isinstance(partition_by, str) else list(partition_by or [])
    exists = spark.catalog.tableExists(full_name)
    keep_others = bool(dynamic and by and exists and _partitioned_by(spark, full_name, by))
    if keep_others:
        observed = observed.select(*spark.read.table(full_name).columns)
    if not staged:
        return _write_in_place(observed, full_name, fmt, by, obs)
    path, unused = f"{_root(spark, full_name)}/{uuid.uuid4().hex}", True
    try:
        observed.write.format(fmt).partitionBy(*by).save(path)
        got = dict(obs.get)
        if require_rows and not got["rows"]:
            remove_folder(spark, path)
            return {"table": full_name, **got}
        if exists and (keep_others or _same_shape(spark, full_name, observed, fmt, by)):
            if by:
                unused = False                   # some partitions may have it whatever happens
                _point_partitions(spark, full_name, fmt, path, by, drop_others=not keep_others)
            else:
                old = _places(spark, full_name, by)
                _point(spark, full_name, path)
                unused = False
                _retire(spark, full_name, old)
        else:
            stage = f"{full_name}__staging_{uuid.uuid4().hex[:8]}"
            _create(spark, stage, fmt, path, by)
            unused = _swap(spark, stage, full_name)
    except Exception as ex:
        if unused:
            remove_folder(spark, path)
        raise RuntimeError(f"Cannot write table '{full_name}'") from ex
    spark.catalog.refreshTable(full_name)
    log.info("Written %s (%s)", full_name, got)
    return {"table": full_name, **got}


def _write_in_place(observed: DataFrame, full_name: str, fmt: str, by: list[str], obs: Observation) -> dict:
    try:
        observed.write.format(fmt).mode("overwrite").option("overwriteSchema", "true").partitionBy(*by) \
            .saveAsTable(full_name)
    except Exception as ex:
        raise RuntimeError(f"Cannot write table '{full_name}'") from ex
    return {"table": full_name, **obs.get}


# ---------------------------------------------------------------- version folders
def _text(value: str) -> str:
    return "'" + value.replace("\\", "\\\\").replace("'", "\\'") + "'"


def _root(spark: SparkSession, full_name: str) -> str:
    """Where a table's version folders lie: beside the tables of its schema."""
    schema, name = full_name.rsplit(".", 1)
    return f"{spark.catalog.getDatabase(schema).locationUri.rstrip('/')}/{name}.versions"


def _details(spark: SparkSession, full_name: str, partition: str = "") -> dict[str, str]:
    out: dict[str, str] = {}
    for r in spark.sql(f"DESCRIBE FORMATTED {full_name} {partition}").collect():
        out.setdefault(r["col_name"], r["data_type"])      # a partition's entries come before its table's
    return out


def _location(spark: SparkSession, full_name: str, partition: str = "") -> str:
    return _details(spark, full_name, partition)["Location"]


def _create(spark: SparkSession, full_name: str, fmt: str, path: str, by: list[str]) -> None:
    spark.catalog.createTable(full_name, path=path, source=fmt)
    try:
        if by:
            spark.sql(f"ALTER TABLE {full_name} RECOVER PARTITIONS")
    except Exception:
        _drop_quietly(spark, full_name)
        raise


def _same_shape(spark: SparkSession, full_name: str, df: DataFrame, fmt: str, by: list[str]) -> bool:
    """Whether the catalog entry needs no change but its folder."""
    if _details(spark, full_name).get("Provider", "").lower() != fmt.lower() or not _partitioned_by(spark, full_name, by):
        return False
    have = [(f.name, f.dataType.simpleString()) for f in spark.read.table(full_name).schema]
    want = [(f.name, f.dataType.simpleString()) for f in df.schema]
    return have == [x for x in want if x[0] not in by] + [x for x in want if x[0] in by]


def _point(spark: SparkSession, full_name: str, path: str, partition: str = "") -> None:
    """The atomic step: one change of the catalog entry."""
    spark.sql(f"ALTER TABLE {full_name} {partition} SET LOCATION {_text(path)}")


def _spec(name: str) -> str:
    """``k=v/k2=v2`` of SHOW PARTITIONS as a partition clause."""
    pairs = [part.split("=", 1) for part in name.split("/")]
    value = {k: "null" if v == "__HIVE_DEFAULT_PARTITION__" else _text(unquote(v)) for k, v in pairs}
    return "PARTITION (" + ", ".join(f"`{unquote(k)}` = {v}" for k, v in value.items()) + ")"


def _partitions(spark: SparkSession, full_name: str) -> list[str]:
    return [r["partition"] for r in spark.sql(f"SHOW PARTITIONS {full_name}").collect()]


def _places(spark: SparkSession, full_name: str, by) -> dict[str, str]:
    """The folders of a table: by partition, or one."""
    if not by:
        return {"": _location(spark, full_name)}
    return {p: _location(spark, full_name, _spec(p)) for p in _partitions(spark, full_name)}


def _point_partitions(spark: SparkSession, full_name: str, fmt: str, path: str, by: list[str], drop_others: bool) -> None:
    """Points each partition that ``path`` holds at it; a reader sees each partition either
    as it was or as it is."""
    stage = f"{full_name}__staging_{uuid.uuid4().hex[:8]}"
    try:
        _create(spark, stage, fmt, path, by)               # finds the partitions' folders
        places = _places(spark, stage, by)
    finally:
        _drop_quietly(spark, stage)
    had, old = set(_partitions(spark, full_name)), {}
    for name, place in places.items():
        if name in had:
            old[name] = _location(spark, full_name, _spec(name))
            _point(spark, full_name, place, _spec(name))
        else:
            spark.sql(f"ALTER TABLE {full_name} ADD IF NOT EXISTS {_spec(name)} LOCATION {_text(place)}")
    for name in sorted(had - set(places)) if drop_others else ():
        old[name] = _location(spark, full_name, _spec(name))
        spark.sql(f"ALTER TABLE {full_name} DROP IF EXISTS {_spec(name)}")
    _retire(spark, full_name, old)


_PREVIOUS = "lapworks.previous"      # table property: the folders before the current ones


def _retire(spark: SparkSession, full_name: str, old: dict[str, str]) -> None:
    """Remembers the folders just replaced, for readers that have begun, and removes those
    that they had replaced themselves."""
    try:
        props = {r["key"]: r["value"] for r in spark.sql(f"SHOW TBLPROPERTIES {full_name}").collect()}
        before = json.loads(props.get(_PREVIOUS, "{}"))
        gone = [before[k] for k in old if k in before and before[k] != old[k]]
        spark.sql(f"ALTER TABLE {full_name} SET TBLPROPERTIES ({_text(_PREVIOUS)} = {_text(json.dumps({**before, **old}))})")
        for path in gone:
            remove_folder(spark, path)
    except Exception:
        log.warning("Old versions of %s could not be cleared.", full_name, exc_info=True)


def _partitioned_by(spark: SparkSession, name: str, by) -> bool:
    """Whether the table has these partition columns (else it is replaced as a whole)."""
    have = [c.name for c in spark.catalog.listColumns(name) if c.isPartition]
    same = have == ([by] if isinstance(by, str) else list(by))
    if not same:
        log.warning("Table %s is partitioned by %s, not %s: it is replaced as a whole.", name, have, by)
    return same


def _drop_quietly(spark: SparkSession, name: str) -> None:
    try:
        spark.sql(f"DROP TABLE IF EXISTS {name}")
    except Exception:
        log.warning("Table %s could not be dropped.", name)


def _rename(spark: SparkSession, old: str, new: str) -> None:
    # RENAME TO takes <schema>.<table> in the session catalog
    spark.sql(f"ALTER TABLE {old} RENAME TO {'.'.join(new.split('.')[-2:])}")


def _swap(spark: SparkSession, stage: str, target: str) -> bool:
    """Puts the written ``stage`` in the place of ``target`` (if there is one), by renames;
    the old table is there again if that fails.  Returns False: the stage's folder is used."""
    backup = f"{target}__backup_{uuid.uuid4().hex[:8]}" if spark.catalog.tableExists(target) else None
    try:
        if backup:
            _rename(spark, target, backup)
        _rename(spark, stage, target)
    except Exception:
        if backup and spark.catalog.tableExists(backup):
            if spark.catalog.tableExists(target):        # the new rows got in: set them aside
                _rename(spark, target, stage)
            _rename(spark, backup, target)
        _drop_quietly(spark, stage)
        raise
    if backup:
        by = [c.name for c in spark.catalog.listColumns(backup) if c.isPartition]
        old = _places(spark, backup, by) if _details(spark, backup).get("Type") == "EXTERNAL" else {}
        _drop_quietly(spark, backup)
        _retire(spark, target, old)
    return False
