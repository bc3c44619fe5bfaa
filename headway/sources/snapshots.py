"""Table snapshots: versioned folders and one manifest under a root.

A table's rows lie in a folder that is written once and never changed. The
manifest lists which folder holds which table; a commit appends one file to it,
for any number of tables, and Spark's committer puts that file in place with a
single rename. So readers and crashes meet the tables as they were before a commit or
as they are after it, all of them together, and never half of it.

Readers resolve the manifest once, when a ``Snapshot`` is made, and go on reading its
folders while others commit. ``expire`` removes folders some time after
their last use; it must leave the slowest reader time to end.

Of two writers at once the later commit wins, table by table. Marks are numbers
that are committed with the tables, such as the last batch they hold.
"""

from __future__ import annotations

import json
import time
import uuid
from collections.abc import Callable

from pyspark.sql import Column, DataFrame, Observation, Row, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

MANIFEST = "manifest"
ENTRY = (
    "number bigint, name string, folder string, part string, row_count bigint, columns string,"
    " committed timestamp"
)
FIELDS = [f.split()[0] for f in ENTRY.split(", ")]
#: Column that deals the rows of one write to several tables.
PART = "table_part"
#: Names of marks in the manifest start with this.
MARK = "mark:"


def _entries(spark: SparkSession, root: str) -> DataFrame | None:
    path = spark._jvm.org.apache.hadoop.fs.Path(f"{root}/{MANIFEST}")
    if not path.getFileSystem(spark._jsc.hadoopConfiguration()).exists(path):
        return None
    return spark.read.schema(ENTRY).json(f"{root}/{MANIFEST}")


def _newest(entries: DataFrame) -> DataFrame:
    """The entry in force of each name."""
    entry = F.struct(*FIELDS)
    return entries.groupBy(F.col("name").alias("of")).agg(F.max(entry).alias("e")).select("e.*")


class Snapshot:
    """The tables under a root as they are when this is made, and what is saved
    through it, which others see from ``commit`` on."""

    def __init__(self, spark: SparkSession, root: str):
        self.spark, self.root = spark, root.rstrip("/")
        entries = _entries(spark, self.root)
        # A row for each table.
        newest = [] if entries is None else _newest(entries).collect()
        self.entries: dict[str, Row] = {r["name"]: r for r in newest}
        self.pending: dict[str, Row] = {}

    def _entry(self, name: str) -> Row | None:
        entry = self.pending.get(name) or self.entries.get(name)
        return None if entry is None or entry["folder"] is None else entry

    def exists(self, name: str) -> bool:
        return self._entry(name) is not None or bool(self.parts(name))

    def rows(self, name: str) -> int:
        """The number of rows, as counted when they were written."""
        return self._entry(name)["row_count"]

    def parts(self, name: str) -> list[str]:
        """The tables ``name/key=value`` that make up a table."""
        names = {*self.entries, *self.pending}
        return sorted(n for n in names if n.startswith(f"{name}/") and self._entry(n))

    def load(self, name: str) -> DataFrame:
        """A table; one made up of parts has their keys as columns."""
        entry = self._entry(name)
        if entry is None:
            return self._load_parts(name)
        rows = self._read(entry, f"{self.root}/{entry['folder']}")
        if entry["part"] is not None:
            rows = rows.where(F.col(PART) == entry["part"]).drop(PART)
        return rows

    def _read(self, entry: Row, *folders: str, **options: str) -> DataFrame:
        schema = T.StructType.fromJson(json.loads(entry["columns"]))
        return self.spark.read.schema(schema).options(**options).parquet(*folders)

    def _load_parts(self, name: str) -> DataFrame:
        parts = self.parts(name)
        if not parts:
            raise ValueError(f"no table {name} under {self.root}")
        if self._entry(parts[0])["part"] is not None:
            return self.load_split(name, parts).drop(PART)
        # Folders of their own, whose names are the keys.
        entries = [self._entry(part) for part in parts]
        rows, own = self._scan(name, entries)
        keys = [p.partition("=")[0] for p in parts[0].removeprefix(f"{name}/").split("/")]
        return rows.select(*own, *keys)

    def load_split(self, name: str, parts: list[str]) -> DataFrame:
        """Some of the parts that ``save_split`` wrote under ``name``, in one scan, with
        the column ``table_part``."""
        entries = [self._entry(part) for part in parts]
        rows, own = self._scan(name, entries)
        # The folder of a write may also hold parts that have been replaced.
        of = [f"{e['folder'].rpartition('version=')[2]}/{e['part']}" for e in entries]
        return rows.where(F.concat_ws("/", "version", PART).isin(of)).select(*own)

    def _scan(self, name: str, entries: list[Row]) -> tuple[DataFrame, list[str]]:
        folders = sorted({f"{self.root}/{e['folder']}" for e in entries})
        own = T.StructType.fromJson(json.loads(entries[0]["columns"])).names
        return self._read(entries[0], *folders, basePath=f"{self.root}/{name}"), own

    def _write(self, df: DataFrame, name: str, by: tuple[str, ...], **counts: Column) -> tuple[str, Row]:
        folder = f"{name}/version={uuid.uuid4().hex}"
        seen = Observation(f"{name} rows")
        counted = df.observe(seen, F.count(F.lit(1)).alias("rows"), *[c.alias(n) for n, c in counts.items()])
        counted.write.partitionBy(*by).parquet(f"{self.root}/{folder}")
        return folder, Row(**seen.get)

    def _put(self, name: str, folder: str | None, rows: int, columns: T.StructType, part: str | None = None) -> None:
        self.pending[name] = Row(*FIELDS)(0, name, folder, part, rows, columns.json(), None)

    def save(self, df: DataFrame, name: str, by: tuple[str, ...] = ()) -> int:
        """Writes the rows of a table, in folders ``by`` columns; returns their
        number, counted during the write."""
        folder, counts = self._write(df, name, by)
        self._put(name, folder, counts["rows"], df.schema)
        return counts["rows"]

    def save_split(
        self, df: DataFrame, folder: str, names: dict[str, str],
        only: dict[str, list[str]] | None = None, rows: dict[str, int] | None = None,
        **counts: Column,
    ) -> dict[str, int]:
        """Writes the rows of several tables in one pass, under ``folder``: ``names``
        maps values of the column ``table_part`` to tables, ``only`` names the columns of
        tables that don't have all. Returns the rows of each table, and any other ``counts``
        asked for. Rows of tables are counted during the write, which is for a few
        tables; give ``rows`` (0 for unknown) where there are many. Tables
        ``folder/key=value`` are parts of one table ``folder``."""
        few = {} if rows is not None else {f"part_{n}": value for n, value in enumerate(names)}
        of_part = {n: F.count_if(F.col(PART) == value) for n, value in few.items()}
        where, found = self._write(df, folder, (PART,), **of_part, **counts)
        if rows is None:
            rows = {names[value]: found[n] for n, value in few.items()}
        for value, name in names.items():
            columns = (only or {}).get(name, df.columns)
            schema = T.StructType([f for f in df.schema.fields if f.name in columns or f.name == PART])
            self._put(name, where, rows.get(name, 0), schema, value)
        return rows | {n: found[n] for n in counts}

    def drop(self, name: str) -> None:
        """The table is there no more from the commit on."""
        if self._entry(name) is not None:
            self._put(name, None, 0, T.StructType())

    def mark(self, name: str, value: int) -> None:
        self._put(MARK + name, "", value, T.StructType())

    def marked(self, name: str) -> int | None:
        entry = self._entry(MARK + name)
        return entry and entry["row_count"]

    def commit(self) -> None:
        """Shows everything saved and marked since the last commit, at once."""
        if not self.pending:
            return
        entries = _entries(self.spark, self.root)
        last = None if entries is None else entries.agg(F.max("number")).first()[0]
        rows = self.spark.createDataFrame(list(self.pending.values()), ENTRY).withColumns(
            {"number": F.lit((last or 0) + 1).cast("bigint"), "committed": F.current_timestamp()}
        )
        rows.coalesce(1).write.mode("append").json(f"{self.root}/{MANIFEST}")
        self.entries |= self.pending
        self.pending = {}


def update(spark: SparkSession, root: str, change: Callable[[Snapshot], None]) -> None:
    """Commits what ``change`` saves, or nothing if it fails."""
    snapshot = Snapshot(spark, root)
    change(snapshot)
    snapshot.commit()


def expire(spark: SparkSession, root: str, keep_seconds: float = 86_400) -> int:
    """Removes folders that no table has used for ``keep_seconds``: those replaced
    that long ago, and those of writers that died before their commit. Returns how
    many. The manifest becomes one file, so it doesn't grow with the commits.

    A crash on the way costs nothing: entries written twice count once, and a
    folder that has lost its entries goes next time.
    """
    root = root.rstrip("/")
    path = spark._jvm.org.apache.hadoop.fs.Path
    files = path(root).getFileSystem(spark._jsc.hadoopConfiguration())
    manifest = path(f"{root}/{MANIFEST}")
    if not files.exists(manifest):
        return 0
    before = [s.getPath() for s in files.listStatus(manifest)]
    # The driver looks at folders, not rows: a few for each table and day.
    limit = time.time() - keep_seconds
    entries = spark.read.schema(ENTRY).json([str(p) for p in before if p.getName().startswith("part-")])
    found = sorted(entries.distinct().collect(), key=lambda r: (r["number"], r["folder"] or ""))
    kept: dict[str, Row] = {}
    latest: dict[str, Row] = {}
    for entry in found:
        if (last := latest.get(entry["name"])) and entry["committed"].timestamp() >= limit:
            kept[f"{last['name']} {last['number']} {last['folder']}"] = last  # replaced lately
        latest[entry["name"]] = entry
    in_use = {entry["name"] for entry in kept.values()}
    kept |= {name: e for name, e in latest.items() if e["folder"] is not None or name in in_use}
    spark.createDataFrame(list(kept.values()), ENTRY).coalesce(1).write.mode("append").json(f"{root}/{MANIFEST}")
    for old in before:
        files.delete(old, False)
    used = {entry["folder"] for entry in kept.values()}
    gone = 0
    for table in {entry["folder"].rpartition("/")[0] for entry in found if entry["folder"]} - {""}:
        for status in files.listStatus(path(f"{root}/{table}")):
            name = status.getPath().getName()
            if not name.startswith("version=") or f"{table}/{name}" in used:
                continue
            replaced = any(entry["folder"] == f"{table}/{name}" for entry in found)
            if replaced or status.getModificationTime() / 1000 < limit:
                files.delete(status.getPath(), True)
                gone += 1
    return gone
