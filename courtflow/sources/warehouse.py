"""The thirteen tables on Parquet, and a batch of writes that shows all at once.

A table is a list of directories. Inserts add directories of new rows; updates and upserts
write the table anew, or where a table has parts by a hash of its key, the parts that hold
given keys: a directory belongs to one part, and the others are neither read nor
written. A version names the directories of every table and of
its rejects, and
writing the next version, one small file, is what makes a batch visible. A batch that
dies before that leaves the tables as they were, and can be run again.
"""

from __future__ import annotations

import uuid
from collections.abc import Iterable
from concurrent.futures import ThreadPoolExecutor

from py4j.protocol import Py4JJavaError
from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from courtflow.operators.keyed import DOCUMENT_TIME, absent_from
from courtflow.operators.writes import (
    WriteAction,
    drop_null_keys,
    rows_to_insert,
    union_rows,
    with_fill_update,
    with_reject_reason,
    with_upsert,
)
from courtflow.schemas import TABLES, TableSpec

_VERSION_DDL = "version BIGINT, name STRING, paths ARRAY<STRING>"
_REJECTS_DDL = "reject_reason STRING, row STRING"
_PART = "_part"
# tables written at the same time, so that small ones need not wait for large ones
TABLES_AT_ONCE = 4

# a table's name, an action, rows, and for updates how they are made, by the names of
# ``fill_update``'s arguments
Write = tuple[str, WriteAction, DataFrame] | tuple[str, WriteAction, DataFrame, dict]
Rows = dict[tuple[str, WriteAction], int]


def _observed(seen: Observation, name: str, unknown: int) -> int:
    """An observed count. Spark reports none if it found out, while running, that the
    observed part of the plan is not needed."""
    try:
        return seen.get.get(name, unknown)
    except Py4JJavaError:
        return unknown


def _rejects_of(name: str) -> str:
    """The name under which a version lists a table's rejects."""
    return f"rejects of {name}"


def _part_of(spec: TableSpec) -> F.Column:
    """The part of a table that a key belongs to."""
    return F.pmod(F.xxhash64(*spec.primary_key), F.lit(spec.parts)).cast("int")


def _part_in(path: str) -> int:
    """The part that a directory of a table with parts belongs to."""
    return int(path.rpartition(f"{_PART}=")[2])


class Warehouse:
    def __init__(self, spark: SparkSession, root: str):
        self.spark = spark
        self.root = root.rstrip("/")

    def create_tables(self, erase: bool = False) -> Warehouse:
        """Create all tables where absent; ``erase`` starts again with empty ones."""
        empty = {name: [] for table in TABLES for name in (table, _rejects_of(table))}
        path = f"{self.root}/versions/v=0"
        self._version_frame(0, empty).write.mode("ignore").json(path)
        if erase:
            version, _ = self._current()
            self._commit(version + 1, empty)
        return self

    def read_table(self, name: str) -> DataFrame:
        """A table by name."""
        _, tables = self._current()
        return self._read(TABLES[name], tables[name])

    def rejects(self, name: str) -> DataFrame:
        """Rows turned away from a table, with the reason; each row and reason once."""
        _, tables = self._current()
        row = F.from_json("row", TABLES[name].ddl).alias("row")
        rows = self._read_rejects(tables[_rejects_of(name)])
        return rows.select(row, "reject_reason").select("row.*", "reject_reason")

    def _read_rejects(self, paths: list[str]) -> DataFrame:
        if not paths:
            return self.spark.createDataFrame([], _REJECTS_DDL)
        return self.spark.read.schema(_REJECTS_DDL).parquet(*paths)

    def write_batch(self, writes: Iterable[Write]) -> Rows:
        """Write frames to their tables; returns affected rows per table and action.

        Frames for the same table and action become one. Rows that break a rule of
        the table go to the rejects, the others are written.
        """
        grouped: dict[str, dict[WriteAction, list[DataFrame]]] = {}
        rules: dict[tuple[str, WriteAction], dict] = {}
        for name, action, frame, *rule in writes:
            grouped.setdefault(name, {}).setdefault(action, []).append(frame)
            rules.setdefault((name, action), {}).update(*rule)

        version, tables = self._current()
        rows: Rows = {}

        def write_table(name: str) -> None:
            turned_away = _rejects_of(name)
            for action, frames in grouped[name].items():
                tables[name], rows[name, action], bad = self._write(
                    TABLES[name], action, union_rows(frames), tables[name], rules[name, action]
                )
                if bad is not None:
                    tables[turned_away] = self._reject(TABLES[name], bad, tables[turned_away])

        with ThreadPoolExecutor(TABLES_AT_ONCE) as pool:
            list(pool.map(write_table, grouped))
        self._commit(version + 1, tables)
        return rows

    @staticmethod
    def total_rows(rows: Rows) -> int:
        return sum(rows.values())

    def _write(
        self, spec: TableSpec, action: WriteAction, frame: DataFrame, paths: list[str], rule: dict
    ) -> tuple[list[str], int, DataFrame | None]:
        """The table's directories, affected rows and, if there are any, bad rows."""
        frame = frame.select(*[c for c in frame.columns if c in (*spec.columns, DOCUMENT_TIME)])
        if action is WriteAction.UPDATE:
            # an update brings some columns only, so only its key can be judged
            unkeyed = F.lit(False)
            for key in spec.primary_key:
                unkeyed = unkeyed | F.col(key).isNull()
            bad = frame.filter(unkeyed).withColumn("reject_reason", F.lit("null key"))
            given = drop_null_keys(frame, spec)
            touched, others = self._touched(spec, given, paths)
            after = with_fill_update(self._read(spec, touched), given, spec, **rule)
            # without rows to update there is nothing to write anew
            written, n = self._save(spec, after) if touched else ([], 0)
            if n:
                paths = [*others, *written]
            else:
                self._delete(written)
            return paths, n, bad if bad.limit(1).count() else None

        checked = with_reject_reason(frame, spec)
        is_bad = F.col("reject_reason").isNotNull()
        seen = Observation()
        valid = (
            checked.observe(seen, F.count_if(is_bad).alias("bad"))
            .filter(~is_bad)
            .drop("reject_reason")
        )
        if action is WriteAction.INSERT:
            written, n = self._save(spec, rows_to_insert(self._read(spec, paths), valid, spec))
            if n:
                paths = [*paths, *written]
            else:
                # nothing new, nothing to list
                self._delete(written)
        else:
            touched, others = self._touched(spec, checked.filter(~is_bad), paths)
            written, n = self._save(spec, with_upsert(self._read(spec, touched), valid, spec))
            paths = [*others, *written]
        # the frame is worked out again for its rejects only if it has any
        bad = checked.filter(is_bad) if _observed(seen, "bad", unknown=1) else None
        return paths, n, bad

    def _touched(self, spec: TableSpec, rows: DataFrame, paths: list[str]) -> tuple[list[str], list[str]]:
        """The directories of parts to which keys of the rows belong, and the others."""
        if spec.parts == 1 or not paths:
            return paths, []
        # as many rows as the table has parts, at most
        parts = {r[0] for r in rows.select(_part_of(spec)).distinct().collect()}
        return [p for p in paths if _part_in(p) in parts], [p for p in paths if _part_in(p) not in parts]

    def _save(self, spec: TableSpec, df: DataFrame) -> tuple[list[str], int]:
        """Write files of even size, the rows of a game or part together; counts those set or added.

        The count is taken from the files, so it is exact even if a lost task ran twice:
        of all rows, or where rows have a flag ``_written``, of those with it. The flag
        stays in the files, and no table's schema reads it.

        Rebalancing splits what is too large, so a hot game does not end in one task.
        Kept together, plays of a game combine on the map side when they are analysed.
        """
        path = f"{self.root}/tables/{spec.name}/{uuid.uuid4().hex}"
        flag = [c for c in df.columns if c == "_written"]
        rows = df.select(*spec.columns, *flag)
        if spec.parts > 1:
            rows = rows.withColumn(_PART, _part_of(spec)).hint("rebalance", _PART)
            rows.write.partitionBy(_PART).parquet(path)
            paths = [p for p in self._listed(path) if f"{_PART}=" in p]
        else:
            rows = rows.hint("rebalance", *map(F.col, spec.cluster_by))
            if spec.cluster_by:
                rows = rows.sortWithinPartitions(*spec.cluster_by, *spec.primary_key)
            rows.write.parquet(path)
            paths = [path]
        if flag and paths:
            n = self.spark.read.schema("_written BOOLEAN").parquet(*paths).filter("_written").count()
        else:
            n = self._read(spec, paths).count()
        return paths, n

    def _listed(self, path: str) -> list[str]:
        where = self.spark._jvm.org.apache.hadoop.fs.Path(path)
        files = where.getFileSystem(self.spark._jsc.hadoopConfiguration())
        return sorted(f"{path}/{f.getPath().getName()}" for f in files.listStatus(where))

    def _delete(self, paths: list[str]) -> None:
        """Remove directories that no version has named."""
        for path in paths:
            where = self.spark._jvm.org.apache.hadoop.fs.Path(path)
            where.getFileSystem(self.spark._jsc.hadoopConfiguration()).delete(where, True)

    def _reject(self, spec: TableSpec, bad: DataFrame, paths: list[str]) -> list[str]:
        """Directories of the table's rejects after those not yet listed are added."""
        row = F.to_json(F.struct(*[c for c in bad.columns if c in spec.columns]))
        rows = bad.select("reject_reason", row.alias("row")).distinct()
        new = absent_from(rows, self._read_rejects(paths), ["reject_reason", "row"], few=True)
        path = f"{self.root}/rejects/{spec.name}/{uuid.uuid4().hex}"
        new.write.parquet(path)
        if self._read_rejects([path]).count():
            return [*paths, path]
        self._delete([path])
        return paths

    def _read(self, spec: TableSpec, paths: list[str]) -> DataFrame:
        if not paths:
            return self.spark.createDataFrame([], spec.schema)
        return self.spark.read.schema(spec.schema).parquet(*paths)

    def _version_frame(self, version: int, tables: dict[str, list[str]]) -> DataFrame:
        rows = [(version, name, paths) for name, paths in tables.items()]
        return self.spark.createDataFrame(rows, _VERSION_DDL).coalesce(1)

    def _commit(self, version: int, tables: dict[str, list[str]]) -> None:
        # fails if another batch has taken this version in the meantime
        self._version_frame(version, tables).write.mode("errorifexists").json(
            f"{self.root}/versions/v={version}"
        )

    def _current(self) -> tuple[int, dict[str, list[str]]]:
        root = self.spark._jvm.org.apache.hadoop.fs.Path(f"{self.root}/versions")
        files = root.getFileSystem(self.spark._jsc.hadoopConfiguration())
        newest = max(int(f.getPath().getName().removeprefix("v=")) for f in files.listStatus(root))
        # one row of directory names per table
        rows = self.spark.read.schema(_VERSION_DDL).json(f"{self.root}/versions/v={newest}").collect()
        return newest, {row["name"]: list(row["paths"]) for row in rows}
