"""Tables as Parquet folders: appends, replacements and updates that run again without changing anything.

There is no MERGE without a table format, so a table is a list of immutable folders, and a change a new list.
"""

from __future__ import annotations

import json
import uuid
from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .. import schema

TABLES = {"filings": schema.FILINGS, "members": schema.MEMBERS, "scores": schema.SCORES, "texts": schema.TEXTS, "records": schema.SECTION_RECORDS}


def first_of_each(rows: DataFrame, keys: list[str]) -> DataFrame:
    """One row for each key: the least by all other columns, so that the choice is always the same. Aggregated on the map side."""
    others = [c for c in rows.columns if c not in keys]
    if not others:
        return rows.distinct()
    least = rows.groupBy(*keys).agg(F.min(F.struct(*(F.col(c) for c in others))).alias("__row"))
    return least.select(*keys, "__row.*").select(*rows.columns)


def insert_or_ignore(old: DataFrame, new: DataFrame, keys: list[str]) -> DataFrame:
    """The rows to append: new keys only, one row each."""
    return first_of_each(new, keys).join(old.select(*keys), keys, "left_anti").select(*new.columns)


def insert_or_replace(old: DataFrame, new: DataFrame, keys: list[str]) -> DataFrame:
    """The new state: new rows, and old ones whose key isn't among them."""
    return old.join(new.select(*keys), keys, "left_anti").select(*old.columns).unionByName(first_of_each(new, keys), allowMissingColumns=True)


def with_status(filings: DataFrame, status: DataFrame) -> DataFrame:
    """filings with parse_status from status (accession, parse_status) where it has one."""
    return filings.join(status.select("accession", F.col("parse_status").alias("__new")), "accession", "left").withColumn("parse_status", F.coalesce("__new", "parse_status")).drop("__new")


def replaced_members(page: DataFrame, updated_at: str) -> DataFrame:
    """The whole membership table anew; numbers may be null, weights are unknown (0)."""
    return page.select("ticker", F.col("cik").cast("bigint").alias("cik"), "name", "sector", F.lit(0.0).alias("weight_pct"), F.lit(updated_at).alias("updated_at"))


def duplicates(rows: DataFrame, keys: list[str]) -> DataFrame:
    return rows.groupBy(*keys).agg(F.count("*").alias("n")).where("n > 1")


def require_unique(rows: DataFrame, keys: list[str]) -> DataFrame:
    if found := duplicates(rows, keys).limit(5).collect():
        raise ValueError(f"{keys} aren't unique: {[tuple(r)[:-1] for r in found]}")
    return rows


def with_columns_of(rows: DataFrame, spec: str) -> DataFrame:
    """The schema's columns; those that an older table lacks are null."""
    empty = rows.sparkSession.createDataFrame([], spec)
    return empty.unionByName(rows, allowMissingColumns=True).select(*empty.columns)


class Store:
    """Tables in buckets by the hash of their key, each bucket a list of immutable folders that a manifest names.

    A change writes new folders, for the buckets that have new rows alone, then a manifest with the next number, by one rename.
    Readers take the manifest with the highest number, so a change that breaks off anywhere leaves the table as it was. One
    writer at a time; a second one that comes to the same number fails. buckets is fixed when a table is made.
    """

    #: Folders of a bucket after which an append rewrites it.
    FOLDERS = 16

    def __init__(self, spark: SparkSession, root: str, buckets: int = 16):
        self.spark, self.root, self.buckets = spark, root.rstrip("/"), buckets
        jvm = spark.sparkContext._jvm
        self._path = jvm.org.apache.hadoop.fs.Path
        self._fs = self._path(self.root).getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())

    def path(self, name: str) -> str:
        if name not in TABLES:
            raise ValueError(f"unknown table {name!r}")
        return f"{self.root}/{name}"

    def _listed(self, path: str) -> list[str]:
        where = self._path(path)
        return sorted(s.getPath().getName() for s in self._fs.listStatus(where)) if self._fs.exists(where) else []

    def _manifests(self, name: str) -> list[int]:
        return sorted(int(f[9:-5]) for f in self._listed(self.path(name)) if f.startswith("manifest-") and f.endswith(".json"))

    def _manifest(self, name: str, number: int | None = None) -> tuple[int, dict]:
        """The number and the content of the newest manifest, or of a given one."""
        if number is None:
            if not (found := self._manifests(name)):
                raise LookupError(f"there is no table {name!r} in {self.root}; ensure() makes it")
            number = found[-1]
        stream = self._fs.open(self._path(f"{self.path(name)}/manifest-{number:09d}.json"))
        try:
            return number, json.loads(bytes(stream.readAllBytes()).decode())
        finally:
            stream.close()

    def _commit(self, name: str, number: int, content: dict) -> None:
        """The one step that changes a table."""
        path = self.path(name)
        new, final = self._path(f"{path}/_new-{uuid.uuid4().hex}"), self._path(f"{path}/manifest-{number:09d}.json")
        stream = self._fs.create(new, False)
        try:
            stream.write(bytearray(json.dumps(content).encode()))
        finally:
            stream.close()
        if self._fs.exists(final) or not self._fs.rename(new, final):
            raise RuntimeError(f"another writer changed {name!r}; run the change again")

    def ensure(self) -> Store:
        """Makes the tables that aren't there, empty; what is there stays as it is."""
        for name in TABLES:
            if not self._manifests(name):
                self._fs.mkdirs(self._path(self.path(name)))
                self._commit(name, 0, {"buckets": self.buckets, "folders": {}})
        return self

    def _read(self, name: str, content: dict, only: set[int] | None = None) -> DataFrame:
        paths = [f"{self.path(name)}/data/{folder}/__bucket={b}" for b, folders in content["folders"].items() if only is None or int(b) in only for folder in folders]
        if not paths:
            return self.spark.createDataFrame([], TABLES[name])
        return with_columns_of(self.spark.read.option("mergeSchema", "true").parquet(*paths), TABLES[name])

    def read(self, name: str) -> DataFrame:
        """The table as the newest manifest has it; later changes don't touch what this reads."""
        return self._read(name, self._manifest(name)[1])

    def stage(self, name: str, rows: DataFrame) -> DataFrame:
        """The rows written aside and read back, so that several tables are made from the same ones."""
        path = f"{self.root}/_stage/{name}"
        rows.write.mode("overwrite").parquet(path)
        return self.spark.read.schema(rows.schema).parquet(path)

    def _bucketed(self, name: str, rows: DataFrame, keys: list[str], buckets: int) -> DataFrame:
        return with_columns_of(rows, TABLES[name]).withColumn("__bucket", F.pmod(F.xxhash64(*keys), F.lit(buckets)).cast("int"))

    def _write(self, name: str, rows: DataFrame) -> tuple[str, set[int]]:
        """Writes rows that have __bucket; the folder's name and the buckets it has."""
        folder = uuid.uuid4().hex
        path = f"{self.path(name)}/data/{folder}"
        rows.repartition("__bucket").write.partitionBy("__bucket").parquet(path)
        return folder, {int(f.split("=")[1]) for f in self._listed(path) if f.startswith("__bucket=")}

    def _keys(self, name: str, keys: list[str] | None) -> list[str]:
        own = schema.KEYS.get(name, ["accession"])
        if keys and keys != own:
            raise ValueError(f"the key of {name!r} is {own}")
        return own

    def replace(self, name: str, rows: DataFrame) -> None:
        """A new state of the whole table; rows may read the table itself."""
        number, content = self._manifest(name)
        folder, made = self._write(name, self._bucketed(name, rows, self._keys(name, None), content["buckets"]))
        self._commit(name, number + 1, content | {"folders": {str(b): [folder] for b in sorted(made)}})

    def _change(self, name: str, rows: DataFrame, keys: list[str] | None, ignore: bool) -> None:
        keys = self._keys(name, keys)
        number, content = self._manifest(name)
        new = self.stage(f"change_{name}", self._bucketed(name, rows, keys, content["buckets"]))
        touched = {r[0] for r in new.select("__bucket").distinct().collect()}  # of at most as many as there are buckets
        if not touched:
            return
        old = self._bucketed(name, self._read(name, content, touched), keys, content["buckets"])
        full = any(len(content["folders"].get(str(b), [])) >= self.FOLDERS for b in touched)
        added = insert_or_ignore(old, new, keys)
        rewrite = full or not ignore
        state = added if not rewrite else old.unionByName(added) if ignore else insert_or_replace(old, new, keys)
        folder, made = self._write(name, state)
        folders = dict(content["folders"])
        for b in map(str, sorted(touched)):
            before = [] if rewrite else folders.get(b, [])
            folders[b] = before + [folder] * (int(b) in made)
        self._commit(name, number + 1, content | {"folders": folders})

    def append_new(self, name: str, rows: DataFrame) -> None:
        """Insert-or-ignore by the table's key: folders are added, none is read again but to know the keys."""
        self._change(name, rows, None, ignore=True)

    def upsert(self, name: str, rows: DataFrame, keys: list[str] | None = None) -> None:
        """Insert-or-replace by the table's key: the buckets of the rows are rewritten, others stay."""
        self._change(name, rows, keys, ignore=False)

    def clean(self, name: str, keep: int = 2) -> int:
        """Deletes folders that none of the newest manifests names, and older manifests; the number of deleted folders."""
        numbers = self._manifests(name)
        used = {f for n in numbers[-keep:] for folders in self._manifest(name, n)[1]["folders"].values() for f in folders}
        unused = [f for f in self._listed(f"{self.path(name)}/data") if f not in used]
        for n in numbers[:-keep]:
            self._fs.delete(self._path(f"{self.path(name)}/manifest-{n:09d}.json"), False)
        for f in unused:
            self._fs.delete(self._path(f"{self.path(name)}/data/{f}"), True)
        return len(unused)

    def counts(self) -> DataFrame:
        parts = [self.read(n).agg(F.lit(n).alias("table_name"), F.count("*").alias("n")) for n in ("filings", "members", "scores")]
        return reduce(DataFrame.unionByName, parts)
