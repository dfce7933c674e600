"""The document store: append-only documents and the manifest of discovered keys."""

from __future__ import annotations

import uuid
from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from courtflow.functions.payloads import EMPTY_PAYLOAD, cull_payload
from courtflow.operators.keyed import absent_from
from courtflow.schemas import CULL_PATHS, DOCUMENTS_DDL, MANIFEST_DDL, PAYLOADS, RecordType
from courtflow.session import DOCUMENT_FILES

_COMPACTED_DDL = "by STRING, loads ARRAY<STRING>"
#: How names of loads begin that stand for others.
_REWRITE = "rewrite-"


def latest_documents(
    documents: DataFrame, keys: Sequence[str] = ("document_key", "record_type")
) -> DataFrame:
    """Newest document per key and record type, for all keys at once.

    Spark keeps one candidate per key and map task before the shuffle, so a key with
    very many versions moves few of them.
    """
    newest = Window.partitionBy(*keys).orderBy(
        F.col("document_timestamp").desc_nulls_last(), F.xxhash64("payload").desc()
    )
    return (
        documents.withColumn("_rank", F.row_number().over(newest))
        .filter("_rank = 1")
        .drop("_rank")
        .withColumn("payload", F.coalesce("payload", F.lit(EMPTY_PAYLOAD)))
    )


def parse_payload(documents: DataFrame, schema: str) -> DataFrame:
    """Add ``parsed``, a struct; fields the payload lacks are null."""
    return documents.withColumn("parsed", F.from_json("payload", schema))


def parse_documents(documents: DataFrame, record_type: RecordType) -> DataFrame:
    """Documents of one type, parsed by that type's schema."""
    kept = documents.filter(F.col("record_type") == record_type.value)
    return parse_payload(kept, PAYLOADS[record_type])


def is_json(payload: str = "payload") -> F.Column:
    return F.coalesce(F.try_parse_json(payload).isNotNull(), F.lit(False))


def rejected_documents(documents: DataFrame) -> DataFrame:
    """Documents no transform can use, with the reason."""
    empty = F.regexp_replace(F.coalesce("payload", F.lit("")), r"\s", "").isin("", EMPTY_PAYLOAD)
    reason = (
        F.when(~F.col("record_type").isin(RecordType.labels()), "unknown record type")
        .when(empty, "empty payload")
        .when(~is_json(), "malformed payload")
    )
    return documents.withColumn("reject_reason", reason).filter(reason.isNotNull())


def cull_documents(documents: DataFrame) -> DataFrame:
    """Remove the payload keys that are not worth storing, by record type."""
    culled = F.col("payload")
    for record_type, paths in CULL_PATHS.items():
        if paths:
            culled = F.when(
                F.col("record_type") == record_type.value,
                cull_payload(F.col("payload"), paths),
            ).otherwise(culled)
    return documents.withColumn("payload", culled)


#: Parts of the manifest by a hash of the key; a batch reads those of its own keys.
MANIFEST_PARTS = 64


def key_part(key: F.Column) -> F.Column:
    return F.pmod(F.xxhash64(key), F.lit(MANIFEST_PARTS)).cast("int")


class DocumentStore:
    """Two Parquet tables below one root.

    Every load writes a directory of its own, so a load that is run again under the
    same name replaces itself instead of adding its rows twice. ``compact`` rewrites many small
    loads as one; the loads it stands for are named in a small file, whose writing is what
    makes readers change over.
    """

    def __init__(self, spark: SparkSession, root: str):
        self.spark = spark
        self.root = root.rstrip("/")

    def create(self) -> DocumentStore:
        """Create both tables where absent."""
        for name, ddl, by in (
            ("documents", DOCUMENTS_DDL, ["record_type"]),
            ("manifest", f"{MANIFEST_DDL}, part INT", ["record_type", "part"]),
        ):
            empty = self.spark.createDataFrame([], ddl)
            empty.write.mode("ignore").partitionBy(*by).parquet(f"{self.root}/{name}")
            nothing = self.spark.createDataFrame([], _COMPACTED_DDL)
            nothing.write.mode("ignore").json(f"{self.root}/compacted-{name}/as=none")
        return self

    def _compacted(self, name: str) -> dict[str, list[str]]:
        """Loads that stand for others, and those that each of them replaces."""
        files, where = self._path(f"{self.root}/compacted-{name}")
        if not any(_REWRITE in f.getPath().getName() for f in files.listStatus(where)):
            return {}
        rows = self.spark.read.schema(_COMPACTED_DDL).json(f"{self.root}/compacted-{name}/*").collect()
        return {r["by"]: r["loads"] for r in rows}

    def _read(self, name: str, ddl: str, load: str | None = None) -> DataFrame:
        path = f"{self.root}/{name}"
        reader = self.spark.read.schema(f"{ddl}, load STRING").option("basePath", path)
        # one load is read without listing the others
        if load is not None:
            return reader.parquet(f"{path}/load={load}")
        compacted = self._compacted(name)
        gone = [load for loads in compacted.values() for load in loads]
        # a rewrite that died is not named, so its rows do not count
        unnamed = F.col("load").startswith(_REWRITE) & ~F.col("load").isin(list(compacted))
        return reader.parquet(path).filter(~(F.col("load").isin(gone) | unnamed) | F.col("load").isNull())

    def documents(self, load: str | None = None) -> DataFrame:
        """All documents, or those of one load."""
        return self._read("documents", DOCUMENTS_DDL, load).drop("load")

    def manifest(self, except_load: str | None = None) -> DataFrame:
        return self._manifest(except_load).drop("part")

    def _manifest(self, except_load: str | None = None) -> DataFrame:
        rows = self._read("manifest", f"{MANIFEST_DDL}, part INT")
        if except_load is not None:
            rows = rows.filter(F.col("load") != except_load)
        return rows.drop("load")

    def _write(self, df: DataFrame, name: str, load: str, by: Sequence[str]) -> None:
        files = df.write.mode("overwrite").options(**DOCUMENT_FILES).partitionBy(*by)
        files.parquet(f"{self.root}/{name}/load={load}")

    def append_documents(self, records: DataFrame, load: str | None = None) -> str:
        """Append complete records, stamped with the load time; no deduplication.

        Rows without a key or a type are no records and are left out.
        """
        load = load or uuid.uuid4().hex
        rows = records.dropna(subset=["document_key", "record_type"]).select(
            F.col("document_key").cast("string"),
            "record_type",
            F.current_timestamp().alias("document_timestamp"),
            "up_to_date",
            "payload",
        )
        self._write(rows, "documents", load, ["record_type"])
        return load

    def known_keys(self, keys: DataFrame, except_load: str | None = None) -> DataFrame:
        """The manifest as far as keys of a batch may be in it: only their parts are read."""
        # as many rows as the manifest has parts, at most
        parts = keys.select(key_part(F.col("document_key").cast("string"))).distinct().collect()
        return self._manifest(except_load).filter(F.col("part").isin([r[0] for r in parts])).drop("part")

    def load_manifest(self, keys: DataFrame, load: str | None = None) -> str:
        """Insert (document_key, record_type) pairs the manifest does not hold."""
        load = load or uuid.uuid4().hex
        new = new_manifest_keys(keys, self.known_keys(keys, except_load=load))
        new = new.withColumn("part", key_part(F.col("document_key"))).repartition("record_type", "part")
        self._write(new, "manifest", load, ["record_type", "part"])
        return load

    def compact(self, least: int = 2) -> dict[str, str]:
        """Rewrite the loads of each table as one, if there are so many; names the new loads.

        Documents are gathered by type and day, the manifest by its parts, in files as large as Spark's
        advisory size. Rows stay as they are. Nothing changes for readers until the new load is named;
        a run that dies before leaves rows that do not count, and one that dies later leaves
        directories that are no longer read and go with the next call. No load may be written meanwhile.
        """
        named = {}
        for name, ddl, by, near in (
            ("documents", DOCUMENTS_DDL, ["record_type"], F.to_date("document_timestamp")),
            ("manifest", f"{MANIFEST_DDL}, part INT", ["record_type", "part"], F.col("part")),
        ):
            compacted = self._compacted(name)
            gone = {load for loads in compacted.values() for load in loads}
            there = self._loads(name)
            self._remove(name, [x for x in there if x in gone or (x.startswith(_REWRITE) and x not in compacted)])
            loads = [x for x in there if x not in gone and (x in compacted or not x.startswith(_REWRITE))]
            if len(loads) < least:
                continue
            new = f"{_REWRITE}{uuid.uuid4().hex}"
            rows = self._read(name, ddl).drop("load").withColumn("_near", near)
            rows = rows.hint("rebalance", F.col("record_type"), F.col("_near"))
            self._write(rows.sortWithinPartitions("record_type", "_near").drop("_near"), name, new, by)
            made = self.spark.createDataFrame([(new, sorted({*loads, *gone}))], _COMPACTED_DDL)
            # what earlier rewrites replaced is named again, so the newest name tells all
            made.coalesce(1).write.mode("errorifexists").json(f"{self.root}/compacted-{name}/as={new}")
            self._remove(name, loads)
            named[name] = new
        return named

    def _path(self, path: str):
        where = self.spark._jvm.org.apache.hadoop.fs.Path(path)
        return where.getFileSystem(self.spark._jsc.hadoopConfiguration()), where

    def _loads(self, name: str) -> list[str]:
        files, where = self._path(f"{self.root}/{name}")
        names = [f.getPath().getName() for f in files.listStatus(where)]
        return [n.removeprefix("load=") for n in names if n.startswith("load=")]

    def _remove(self, name: str, loads: Sequence[str]) -> None:
        for load in loads:
            files, where = self._path(f"{self.root}/{name}/load={load}")
            files.delete(where, True)


def new_manifest_keys(keys: DataFrame, manifest: DataFrame) -> DataFrame:
    """Distinct pairs that the manifest lacks; keys as text, null records left out."""
    pair = ["document_key", "record_type"]
    new = keys.select(F.col("document_key").cast("string"), "record_type")
    return absent_from(new.dropna(subset=pair).distinct(), manifest, pair, few=True)
