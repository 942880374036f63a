"""Tables that appear together under numbered versions, with a digest of the content of every shard.

Under a root folder lie ``data/<table>/<load>/_shard=<n>`` with the rows, the entries of each version as a Parquet table, and
``versions/<number>.json``, one small file a version that names those entries. Nothing is ever overwritten: a version is there
when its file is, which one rename puts in place, so readers see all tables of a version or none. What a writer that died left
behind belongs to no version and is deleted by ``remove_unused``.

The digest of a shard sums two hashes of every row in its JSON form: rows in any order and any number of files give the same
one; equal counts of other rows, exchanged nulls or a row held twice do not. Shards that a version already holds with the
same rows are not written again. Two writers that publish at once cannot both get a number: the second one's call fails, as
far as the file system's rename refuses a name that is taken; where it doesn't, let one writer publish.
"""

from __future__ import annotations

import json
import re
import uuid
from collections.abc import Mapping
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tagloom.checks import require_columns, require_positive
from tagloom.functions.casts import as_integer
from tagloom.operators.sizing import small_or_whole, staged
from tagloom.sources import paths

FOLDER = "_shard"
ENTRY = "table string, shard bigint, rows bigint, digest string, load string"
_SAME = ["shard", "rows", "digest"]
_JSON = {"ignoreNullFields": "false", "timeZone": "UTC", "timestampFormat": "yyyy-MM-dd'T'HH:mm:ss.SSSSSSXXX"}


@dataclass(frozen=True)
class Version:
    """What the file of a version says; number 0 is the state before the first one."""

    number: int
    entries: str | None
    schemas: dict[str, str]


def versions(spark: SparkSession, root: str) -> list[int]:
    found = (re.fullmatch(r"(\d{12})\.json", n) for n in paths.names(spark, f"{root}/versions"))
    return sorted(int(m[1]) for m in found if m)


def load_version(spark: SparkSession, root: str, number: int | None = None) -> Version:
    """A version by its number, or the newest one."""
    known = versions(spark, root)
    if number is None and not known:
        return Version(0, None, {})
    if number is not None and number not in known:
        raise ValueError(f"{root} has no version {number}")
    number = known[-1] if number is None else number
    said = json.loads(paths.read_text(spark, _file(root, number)))
    return Version(number, said["entries"], said["schemas"])


def _file(root: str, number: int) -> str:
    return f"{root}/versions/{number:012d}.json"


def entries(spark: SparkSession, root: str, version: Version) -> DataFrame:
    """One row for each shard of each table: its rows, digest and the load that wrote it."""
    if version.entries is None:
        return spark.createDataFrame([], ENTRY)
    return spark.read.schema(ENTRY).parquet(f"{root}/entries/{version.entries}")


def shard_digests(rows: DataFrame, shard: str = "shard_id") -> DataFrame:
    """``shard``, ``rows`` and ``digest`` of every shard."""
    return _digests(rows, rows.columns, {"shard": as_integer(F.col(f"`{shard}`"))})


def _digests(rows: DataFrame, columns: list[str], groups: Mapping[str, Column]) -> DataFrame:
    """Row counts and digests over ``columns`` by group; partial sums meet, never rows."""
    whole = F.to_json(F.struct(*[F.col(f"`{c}`") for c in columns]), _JSON)
    narrow = rows.select(*[c.alias(name) for name, c in groups.items()], whole.alias("whole"))
    sums = [F.sum(F.xxhash64(F.lit(seed), "whole").cast("decimal(20,0)")).cast("string") for seed in (1, 2)]
    return narrow.groupBy(*groups).agg(F.count(F.lit(1)).alias("rows"), F.concat_ws("/", *sums).alias("digest"))


def publish(
    root: str,
    tables: Mapping[str, DataFrame],
    *,
    shard: str = "shard_id",
    keep_others: bool = False,
    check_files: bool = False,
) -> int:
    """Publish all ``tables`` as one new version and return its number.

    A table becomes what is given; ``keep_others`` keeps its published shards that are not given, for tables that are written
    part by part. Tables that are not named stay as they are. ``check_files`` reads the published files too, and writes
    shards anew that lost rows since. Rows need a whole number in ``shard``, and must be the same each time they are read:
    what was written is read back, and other rows than those judged before are an error.
    """
    if not tables:
        raise ValueError("no tables to publish")
    spark = next(iter(tables.values())).sparkSession
    now = load_version(spark, root)
    published = entries(spark, root, now)
    kept = [published.filter(~F.col("table").isin(list(tables)))]
    schemas = dict(now.schemas)
    for name, rows in tables.items():
        _require_table_name(name)
        require_columns(rows, [shard], f"table {name}")
        there = published.filter(F.col("table") == name)
        if name in now.schemas and _types(now.schemas[name]) != rows.schema.simpleString():
            if keep_others:
                raise ValueError(f"{name} was published with other columns; its shards can't be kept")
            there = there.limit(0)
        elif check_files and name in now.schemas:
            there = there.join(damaged_shards(spark, root, name, now.number).select("shard"), "shard", "left_anti").select(*there.columns)
        schemas[name] = rows.schema.json()
        kept += _write_changed(root, name, rows, shard, there, keep_others)
    folder = uuid.uuid4().hex
    whole = kept[0]
    for part in kept[1:]:
        whole = whole.unionByName(part)
    whole.write.parquet(f"{root}/entries/{folder}")
    said = json.dumps({"entries": folder, "schemas": schemas})
    if not paths.publish_text(spark, _file(root, now.number + 1), said):
        raise RuntimeError(f"version {now.number + 1} of {root} was published by another writer in the meantime")
    return now.number + 1


def _write_changed(root: str, name: str, rows: DataFrame, shard: str, there: DataFrame, keep_others: bool) -> list[DataFrame]:
    """Write the shards that are not there with the same rows; entries of the table's new version."""
    spark = rows.sparkSession
    wanted = staged(shard_digests(rows, shard), "wanted")
    if not wanted.filter("shard IS NULL").isEmpty():
        raise ValueError(f"table {name} has rows without a whole number in {shard}")
    out = [there.join(wanted, _SAME, "left_semi").select(*there.columns)]
    if keep_others:
        out.append(there.join(wanted, "shard", "left_anti").select(*there.columns))
    changed = wanted.join(there, _SAME, "left_anti")
    if changed.isEmpty():
        return out
    load = uuid.uuid4().hex
    target = f"{root}/data/{name}/{load}"
    fresh = rows.withColumn(FOLDER, as_integer(F.col(f"`{shard}`")))
    fresh = fresh.join(small_or_whole(changed.select(F.col("shard").alias(FOLDER))), FOLDER, "left_semi")
    fresh.hint("rebalance", F.col(FOLDER)).write.partitionBy(FOLDER).parquet(target)
    files = spark.read.schema(rows.schema).option("recursiveFileLookup", True).parquet(target)
    written = staged(shard_digests(files, shard), "written")
    if written.count() != changed.count() or not changed.join(written, _SAME, "left_anti").isEmpty():
        raise RuntimeError(f"table {name} gave other rows when it was written than when it was judged")
    out.append(written.select(F.lit(name).alias("table"), *_SAME, F.lit(load).alias("load")))
    return out


def read_version(spark: SparkSession, root: str, table: str, version: int | None = None) -> DataFrame:
    """A table as of a version, the newest one by default; only the folders of its shards are listed."""
    which, schema = _table(spark, root, table, version)
    shards = entries(spark, root, which).filter(F.col("table") == table).select("load", "shard").collect()
    if not shards:
        return spark.createDataFrame([], schema)
    return spark.read.schema(schema).parquet(*[f"{root}/data/{table}/{load}/{FOLDER}={n}" for load, n in shards])


def damaged_shards(spark: SparkSession, root: str, table: str, version: int | None = None) -> DataFrame:
    """``shard``, and its rows as published and as found, where the files no longer hold what was published."""
    which, schema = _table(spark, root, table, version)
    wanted = entries(spark, root, which).filter(F.col("table") == table).drop("table")
    loads = [f"{root}/data/{table}/{r['load']}" for r in wanted.select("load").distinct().collect()]
    loads = [path for path in loads if paths.exists(spark, path)]
    if not loads:
        return wanted.select("shard", "rows", F.lit(0).cast("bigint").alias("found"))
    place = F.col("_metadata.file_path")
    load = F.regexp_extract(place, rf"/([0-9a-f]+)/{FOLDER}=[^/]*/[^/]*$", 1)
    number = F.regexp_extract(place, rf"/{FOLDER}=(-?\d+)/[^/]*$", 1).try_cast("bigint")
    files = spark.read.schema(schema).option("recursiveFileLookup", True).parquet(*loads)
    found = _digests(files, schema.names, {"load": load, "shard": number})
    met = wanted.join(found.withColumnsRenamed({"rows": "found", "digest": "now"}), ["load", "shard"], "left")
    return met.filter("NOT (found <=> rows AND now <=> digest)").select("shard", "rows", F.coalesce("found", F.lit(0)).alias("found"))


def remove_unused(spark: SparkSession, root: str, keep: int = 1) -> int:
    """Delete all versions but the newest ``keep``, and the loads and entries only they used; the count of loads deleted.

    Only for times when nobody publishes or reads older versions. A load stays while one of its shards is in use.
    """
    require_positive(keep=keep)
    known = versions(spark, root)
    lasting = [load_version(spark, root, n) for n in known[-keep:]]
    used: set[tuple[str, str]] = set()
    for version in lasting:
        used |= {(r["table"], r["load"]) for r in entries(spark, root, version).select("table", "load").distinct().collect()}
    for number in known[:-keep]:
        paths.remove(spark, _file(root, number))
    for folder in set(paths.names(spark, f"{root}/entries")) - {v.entries for v in lasting}:
        paths.remove(spark, f"{root}/entries/{folder}")
    there = [(t, load) for t in paths.names(spark, f"{root}/data") for load in paths.names(spark, f"{root}/data/{t}")]
    gone = [pair for pair in there if pair not in used]
    for table, load in gone:
        paths.remove(spark, f"{root}/data/{table}/{load}")
    return len(gone)


def _table(spark: SparkSession, root: str, table: str, version: int | None) -> tuple[Version, T.StructType]:
    which = load_version(spark, root, version)
    if table not in which.schemas:
        raise ValueError(f"{root} has no table {table}")
    return which, T.StructType.fromJson(json.loads(which.schemas[table]))


def _types(schema: str) -> str:
    return T.StructType.fromJson(json.loads(schema)).simpleString()


def _require_table_name(name: str) -> None:
    if not re.fullmatch(r"[A-Za-z0-9][A-Za-z0-9_-]*", name):
        raise ValueError(f"'{name}' is no name for a table: letters, digits, - and _ only")
