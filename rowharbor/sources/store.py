"""Stored datasets: Parquet folders and a commit list that names them.

A version is a list of parts. A dataset with a row identifier has a part for each bucket of the
identifier's hash, written as partitions of a folder; a merge writes the buckets that incoming
rows fall in, and the new version names the old folders for all others. A dataset without one has a
part for each folder: appending adds a folder. Written folders are never changed: readers of an
older version need not wait, and a failed write leaves the dataset as it was. Publishing appends one
row to the commit list; of two writers that started from the same version the second is refused.
"""

from __future__ import annotations

import json
import math
import uuid
from collections.abc import Collection, Sequence
from dataclasses import dataclass

from py4j.protocol import Py4JJavaError
from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from rowharbor.operators import sketches
from rowharbor.operators.shape import drop_system_columns
from rowharbor.runtime import field

COMMITS = (
    "version bigint, rows bigint, hash_xor bigint, hash_sum decimal(38,0), batch string, "
    "schema string, key array<string>, signed boolean, folders array<string>, "
    "part_rows array<bigint>, part_digests array<decimal(38,0)>"
)
BUCKET, FOLDER, SIGNATURE = ":bucket", ":folder", ":signature"
BUCKET_ROWS = 1_000_000  # rows a bucket is made for
LEAST_BUCKETS, MOST_BUCKETS = 16, 1 << 16


class PublishFailed(RuntimeError):
    """A version that is not what was meant to be written."""


class PublishConflict(RuntimeError):
    """Another writer published, or is publishing, a version made from the same one."""


@dataclass(frozen=True)
class Layout:
    """How a dataset is stored. ``key``: columns whose hash names a row's bucket, none for one part
    per folder. ``signed``: digests of all rows are kept beside them."""

    key: tuple[str, ...] = ()
    buckets: int = 1
    signed: bool = False

    def bucket(self, columns: Sequence[Column] | None = None) -> Column:
        """A row's bucket. It follows from Spark's own partitioning by the same columns into a
        multiple of ``buckets``, so a table that is shuffled so is written without another shuffle."""
        values = [field(k) for k in self.key] if columns is None else columns
        return F.pmod(F.hash(*values), F.lit(self.buckets)).cast("int")


@dataclass(frozen=True)
class Version:
    """A published version: of each part the folder that holds it (none: no rows), its rows, and for
    signed layouts the sum of the hashes of its signatures, which doesn't depend on their order."""

    number: int
    schema: T.StructType
    layout: Layout
    folders: tuple[str | None, ...]
    rows: tuple[int, ...]
    digests: tuple[int | None, ...]

    def parts_unlike(self, other: Version) -> list[int]:
        """Buckets whose rows differ from those of another version of the same layout."""
        if self.layout != other.layout or not self.layout.signed:
            raise ValueError("only signed versions of one layout can be compared by bucket")
        sides = zip(self.folders, other.folders, self.digests, other.digests, strict=True)
        return [i for i, (a, b, x, y) in enumerate(sides) if a != b and x != y]


@dataclass(frozen=True)
class Staged:
    """A working copy nobody reads yet: the parts it replaces (none: all), or adds to."""

    version: int
    folder: str
    base: Version | None
    layout: Layout
    schema: T.StructType
    parts: frozenset[int] | None
    append: bool


def buckets_for(rows: int) -> int:
    """A power of two, for some million rows a bucket."""
    wanted = 1 << max(0, math.ceil(math.log2(max(1, rows) / BUCKET_ROWS)))
    return min(MOST_BUCKETS, max(LEAST_BUCKETS, wanted))


def signature_of(columns: Sequence[str]) -> Column:
    """32-byte digest of a row's values. Nulls are part of it: (1, null) differs from (1)."""
    row = F.struct(*[field(c).alias(c) for c in columns])
    return F.unhex(F.sha2(F.to_json(row, {"ignoreNullFields": "false"}), 256))


def digest_sum(key: Sequence[str], signature: str = SIGNATURE) -> Column:
    """One number for all signatures of a group of rows, whatever their order."""
    return F.sum(F.xxhash64(*[field(k) for k in key], field(signature)).cast("decimal(38,0)"))


@dataclass(frozen=True)
class Fingerprint:
    rows: int
    hash_xor: int | None = None
    hash_sum: int | None = None


def row_hash(df: DataFrame) -> Column:
    """64-bit hash of a row; nulls count by their position."""
    nulls = [F.when(field(c).isNull(), F.lit(i)) for i, c in enumerate(df.columns)]
    return F.xxhash64(*[field(c) for c in df.columns], F.array_compact(F.array(*nulls)))


def fingerprint_columns(df: DataFrame) -> list[Column]:
    """Aggregates that tell two tables apart, whatever the order of their rows."""
    return [
        F.count(F.lit(1)).alias("rows"),
        F.coalesce(F.bit_xor(row_hash(df)), F.lit(0)).alias("hash_xor"),
        F.coalesce(F.sum(row_hash(df).cast("decimal(38,0)")), F.lit(0).cast("decimal(38,0)"))
        .alias("hash_sum"),
    ]


def table_fingerprint(df: DataFrame) -> DataFrame:
    return df.agg(*fingerprint_columns(df))


def fingerprint(df: DataFrame) -> Fingerprint:
    row = table_fingerprint(df).first()
    return Fingerprint(row["rows"], row["hash_xor"], int(row["hash_sum"]))


def export_dataset(df: DataFrame) -> DataFrame:
    """Everything a reader may see of a dataset, in one scan."""
    return drop_system_columns(df)


class DatasetStore:
    """Datasets below one root folder on storage all executors share."""

    def __init__(self, spark: SparkSession, root: str, deep_check: bool = False):
        """``deep_check`` compares hashes of all written rows with those that were sent, which
        reads them again; row counts, from file footers, are always compared."""
        self.spark = spark
        self.root = root.rstrip("/")
        self.deep_check = deep_check
        self._staged: dict[tuple[str, int], Staged] = {}

    def _path(self, dataset_id: str, kind: str, folder: str | None = None) -> str:
        top = f"{self.root}/{dataset_id}/{kind}"
        return top if folder is None else f"{top}/%3Afolder={folder}"

    def register(self, dataset_id: str) -> None:
        """Start a dataset with an empty commit list; repeating this changes nothing."""
        schema = T.StructType.fromDDL(COMMITS)
        none = self.spark.createDataFrame([], schema)
        none.write.mode("append").parquet(self._path(dataset_id, "commits"))

    def commits(self, dataset_id: str) -> DataFrame:
        """The commit list."""
        schema = T.StructType.fromDDL(COMMITS)
        try:
            return self.spark.read.schema(schema).parquet(self._path(dataset_id, "commits"))
        except AnalysisException as e:
            if e.getCondition() == "PATH_NOT_FOUND":
                raise LookupError(f"there is no dataset '{dataset_id}'") from e
            raise

    def version(self, dataset_id: str, number: int | None = None) -> Version | None:
        """A published version, by default the newest one, if any."""
        commits = self.commits(dataset_id)
        if number is not None:
            commits = commits.filter(F.col("version") == number)
        row = commits.orderBy(F.col("version").desc()).first()
        if row is None:
            return None
        key = tuple(row["key"])
        layout = Layout(key, len(row["folders"]) if key else 1, row["signed"])
        return Version(row["version"], T.StructType.fromJson(json.loads(row["schema"])), layout, tuple(row["folders"]),
                       tuple(row["part_rows"]), tuple(None if d is None else int(d) for d in row["part_digests"]))

    def current_version(self, dataset_id: str) -> int | None:
        """Number of the newest published version, if any."""
        newest = self.version(dataset_id)
        return newest.number if newest else None

    def published(self, dataset_id: str) -> Version:
        newest = self.version(dataset_id)
        if newest is None:
            raise LookupError(f"dataset '{dataset_id}' was never published")
        return newest

    def has_batch(self, dataset_id: str, batch: str) -> bool:
        """Whether a batch of that name was published before."""
        return bool(self.commits(dataset_id).filter(F.col("batch") == batch).head(1))

    def _read(self, dataset_id: str, kind: str, schema: T.StructType, version: Version, parts: Collection[int] | None) -> DataFrame:
        wanted = range(len(version.folders)) if parts is None else sorted(parts)
        places = [(self._path(dataset_id, kind, version.folders[i]), i) for i in wanted if version.folders[i] is not None]
        paths = [f"{path}/%3Abucket={i}" if version.layout.key else path for path, i in places]
        if not paths:
            return self.spark.createDataFrame([], schema)
        stored = T.StructType([*schema.fields, T.StructField(FOLDER, T.StringType())])
        if version.layout.key:
            stored = stored.add(BUCKET, T.IntegerType())
        reader = self.spark.read.schema(stored).option("basePath", self._path(dataset_id, kind))
        return reader.parquet(*paths).select(*[field(f.name) for f in schema.fields])

    def read(self, dataset_id: str, version: Version | None = None, parts: Collection[int] | None = None) -> DataFrame:
        """The published rows, of all parts or of some: only those files are listed and read."""
        version = version or self.published(dataset_id)
        return self._read(dataset_id, "versions", version.schema, version, parts)

    def read_signatures(self, dataset_id: str, version: Version, parts: Collection[int] | None = None) -> DataFrame:
        """Key and ``:signature`` of every row of a signed version."""
        return self._read(dataset_id, "signatures", self._signed_schema(version.schema, version.layout), version, parts)

    @staticmethod
    def _signed_schema(schema: T.StructType, layout: Layout) -> T.StructType:
        return T.StructType([*[schema[k] for k in layout.key], T.StructField(SIGNATURE, T.BinaryType())])

    def statistics(self, dataset_id: str, version: Version | None = None) -> DataFrame:
        """Statistics of each column, merged from those kept of each part; no stored row is read."""
        version = version or self.published(dataset_id)
        schema = T.StructType.fromDDL(sketches.SKETCHES)
        return sketches.merge(self._read(dataset_id, "statistics", schema, version, None))

    def describe_staged(self, dataset_id: str, version: int) -> None:
        """Keep statistics of what was written for a version, for ``statistics``."""
        staged = self._staged[dataset_id, version]
        path = self._path(dataset_id, "statistics", staged.folder)
        by = [BUCKET] if staged.layout.key else []
        names = [field(f.name) for f in staged.schema.fields]
        written = self.read_staged(dataset_id, version).select(*names, *[field(b) for b in by])
        found = sketches.describe(written, by)
        (found.write.partitionBy(*by) if by else found.write).mode("overwrite").parquet(path)

    def read_staged(self, dataset_id: str, version: int) -> DataFrame:
        """What was written for a version, with its system columns."""
        staged = self._staged[dataset_id, version]
        return self.spark.read.parquet(self._path(dataset_id, "versions", staged.folder))

    def stage(
        self,
        df: DataFrame,
        dataset_id: str,
        layout: Layout | None = None,
        parts: Collection[int] | None = None,
        append: bool = False,
    ) -> tuple[int, Fingerprint]:
        """Write a working copy nobody reads yet: the version after the current one.

        ``df`` is the whole table, or the whole of some ``parts``, or rows to ``append`` to a dataset
        without buckets. ``layout`` is that of the current version unless it is given; changing it
        needs the whole table. The rows are counted on their way out.
        """
        base = self.version(dataset_id)
        layout = layout or (base.layout if base else Layout())
        schema = drop_system_columns(df).schema
        if (parts is not None or append) and (base is None or layout != base.layout or append == bool(layout.key)):
            raise ValueError("parts can be written into the layout they have only")
        number = (base.number if base else 0) + 1
        staged = Staged(number, f"v{number}-{uuid.uuid4().hex[:12]}", base, layout, schema, None if parts is None else frozenset(parts), append)
        sent = Observation()
        wanted = (
            fingerprint_columns(drop_system_columns(df))
            if self.deep_check
            else [F.count(F.lit(1)).alias("rows")]
        )
        seen = df.observe(sent, *wanted)
        path = self._path(dataset_id, "versions", staged.folder)
        if layout.key:
            seen.withColumn(BUCKET, layout.bucket()).write.partitionBy(BUCKET).parquet(path)
        else:
            seen.write.parquet(path)
        self._staged[dataset_id, number] = staged
        got = sent.get
        if not self.deep_check:
            return number, Fingerprint(got["rows"])
        return number, Fingerprint(got["rows"], got["hash_xor"], int(got["hash_sum"]))

    def _parts_written(self, dataset_id: str, staged: Staged) -> dict[int, tuple[int, int | None]]:
        """Rows, and digest where they are signed, of each part that was written: one row per bucket."""
        layout = staged.layout
        try:
            written = self.spark.read.parquet(self._path(dataset_id, "versions", staged.folder))
        except AnalysisException:  # not one row, so not one partition
            return {}
        if not layout.key:
            return {0: (written.count(), None)}
        none = F.lit(None).cast("decimal(38,0)")
        if layout.signed:
            rest = [f.name for f in staged.schema.fields if f.name not in layout.key]
            path = self._path(dataset_id, "signatures", staged.folder)
            signed = written.select(*[field(k) for k in layout.key], signature_of(rest).alias(SIGNATURE), field(BUCKET))
            signed.write.mode("overwrite").partitionBy(BUCKET).parquet(path)
            written = self.spark.read.schema(signed.schema).parquet(path)
        digest = digest_sum(layout.key) if layout.signed else none
        counted = written.groupBy(field(BUCKET)).agg(F.count(F.lit(1)).alias("n"), (digest if layout.signed else F.max(none)).alias("d"))
        return {r[0]: (r["n"], None if r["d"] is None else int(r["d"])) for r in counted.collect()}

    def publish(
        self, dataset_id: str, version: int, expected: Fingerprint, batch: str | None = None
    ) -> None:
        """Make a staged version the current one, after reading back what was written."""
        staged = self._staged[dataset_id, version]
        parts = self._parts_written(dataset_id, staged)
        found = Fingerprint(sum(n for n, _ in parts.values()))
        if expected.hash_xor is not None:
            found = fingerprint(drop_system_columns(self.read_staged(dataset_id, version))) if parts else Fingerprint(0, 0, 0)
        if found != expected:
            raise PublishFailed(f"expected {expected}, found {found}")
        base, size = staged.base, staged.layout.buckets if staged.layout.key else 1
        if staged.append:
            new = [*zip(base.folders, base.rows, base.digests, strict=True), (staged.folder, found.rows, None)]
        else:
            replaced = range(size) if staged.parts is None else staged.parts
            new = list(zip(base.folders, base.rows, base.digests, strict=True)) if staged.parts is not None else [(None, 0, None)] * size
            for i in replaced:
                new[i] = (staged.folder, *parts[i]) if i in parts else (None, 0, None)
            if not set(parts) <= set(replaced):
                raise PublishFailed("rows were written into parts that were not to be replaced")
        if not staged.layout.key:
            new = [p for p in new if p[0] is not None] or [(staged.folder, 0, None)]
        self._claim(dataset_id, staged, batch)
        folders, rows, digests = (list(x) for x in zip(*new, strict=True))
        row = (version, sum(rows), found.hash_xor, found.hash_sum, batch, staged.schema.json(), list(staged.layout.key),
               staged.layout.signed, folders, rows, digests)
        schema = T.StructType.fromDDL(COMMITS.replace("decimal(38,0)", "string"))
        text = [*row[:3], None if row[3] is None else str(row[3]), *row[4:10], [None if d is None else str(d) for d in digests]]
        commit = self.spark.createDataFrame([tuple(text)], schema).select(
            *[F.col(f.name).cast(f.dataType) for f in T.StructType.fromDDL(COMMITS).fields])
        commit.coalesce(1).write.mode("append").parquet(self._path(dataset_id, "commits"))
        del self._staged[dataset_id, version]

    def _claim_file(self, dataset_id: str, version: int) -> tuple:
        path = self.spark._jvm.org.apache.hadoop.fs.Path(f"{self._path(dataset_id, 'claims')}/v{version}")
        return path, path.getFileSystem(self.spark._jsc.hadoopConfiguration())

    def _claim(self, dataset_id: str, staged: Staged, batch: str | None) -> None:
        """Take the number of a version: the file system lets one writer create its file. A batch
        that runs again after a failure finds its own name in the file and goes on."""
        path, files = self._claim_file(dataset_id, staged.version)
        owner = batch or staged.folder
        try:
            out = files.create(path, False)
        except Py4JJavaError:
            if not files.exists(path):
                raise
            into = files.open(path)
            holder = bytes(into.readAllBytes()).decode()
            into.close()
            if holder == owner and self.version(dataset_id, staged.version) is None:
                return
            raise PublishConflict(
                f"version {staged.version} of '{dataset_id}' is taken by {holder}; if that writer died, release it"
            ) from None
        out.write(bytearray(owner.encode()))
        out.close()

    def release(self, dataset_id: str, version: int) -> None:
        """Give up the claim of a writer that died before its commit."""
        if self.version(dataset_id, version) is not None:
            raise ValueError(f"version {version} of '{dataset_id}' is published")
        path, files = self._claim_file(dataset_id, version)
        files.delete(path, False)


def write_dataset(df: DataFrame, path: str) -> None:
    """A published table as plain Parquet, without system columns."""
    drop_system_columns(df).write.mode("overwrite").parquet(path)
