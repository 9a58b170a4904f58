"""A stored table that is appended to and updated by id, one version per batch, without copying what stays.

The rows lie in folders by part (a date, or a share of the ids). A version is a manifest, which names the folders of each
part; it is written last and in one file, so a version is there as a whole or not at all. A new version
writes new rows, and the parts in which a value changes, and names the old folders for everything else. Nothing is
overwritten: who reads an older version goes on undisturbed until ``expire`` is called for it.
"""

from __future__ import annotations

import uuid
from collections.abc import Iterable
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tallyboard.operators.lookup import id_filter, maybe_held, merged_filters
from tallyboard.schemas import MANIFEST
from tallyboard.session import remove_path, scratch_scope, stored
from tallyboard.sources.tables import read_batches, write_batch, write_snapshot

# The name that Spark gives the folder of a missing value.
NO_VALUE = "__HIVE_DEFAULT_PARTITION__"
DATA, FILTER = "data", "filter"
#: Filters of so many appends are merged into one.
MOST_FILTERS = 64


@dataclass(frozen=True)
class Published:
    """What a version changed: of ``updates``, those that hit a stored row (matched) and changed it (modified), and new rows."""

    version: int
    updates: int = 0
    matched: int = 0
    modified: int = 0
    appended: int = 0
    rewritten_parts: int = 0

    @property
    def no_op(self) -> int:
        return self.updates - self.matched


@dataclass(frozen=True)
class VersionedTable:
    """Rows of ``schema`` under ``root`` with an id each, cut by the column ``part``.

    Rows of a part are in order of ``sort`` if that is given. ``filter_bits`` is the size of the filter of all ids, best at 16 for each id expected; a smaller one costs more
    exact checks and loses nothing.
    """

    root: str
    schema: T.StructType
    id_column: str
    part: str = "session_date"
    sort: str | None = None
    filter_bits: int = 1 << 24

    # ---- Reading ------------------------------------------------------------------

    def version(self, spark: SparkSession) -> int | None:
        """The latest version, or None before the first."""
        return read_batches(spark, f"{self.root}/manifests", MANIFEST).agg(F.max("batch_id")).first()[0]

    def manifest(self, spark: SparkSession, version: int | None) -> list:
        """(kind, part, folder) of a version: a row for each part and folder, so as many as there are days, or a few times that."""
        if version is None:
            return []
        return read_batches(spark, f"{self.root}/manifests", MANIFEST).where(F.col("batch_id") == version).collect()

    def read(self, spark: SparkSession, version: int | None = None, parts: Iterable[str] | None = None) -> DataFrame:
        """The rows of a version (the latest, if none is named), or of some parts alone."""
        version = self.version(spark) if version is None else version
        return self._read(spark, self.manifest(spark, version), parts)

    def _read(self, spark: SparkSession, manifest: list, parts: Iterable[str] | None = None) -> DataFrame:
        wanted = None if parts is None else set(parts)
        paths = [
            f"{self.root}/data/written={row.folder}/{self.part}={row.part}"
            for row in manifest
            if row.kind == DATA and (wanted is None or row.part in wanted)
        ]
        if not paths:
            return spark.createDataFrame([], self.schema)
        full = T.StructType([*self.schema.fields, T.StructField("written", T.StringType())])
        found = spark.read.schema(full).option("basePath", f"{self.root}/data").parquet(*paths)
        return found.select(*self.schema.fieldNames())

    def _part_text(self) -> Column:
        return F.coalesce(F.col(self.part).cast("string"), F.lit(NO_VALUE))

    # ---- Writing ------------------------------------------------------------------

    def publish(
        self,
        spark: SparkSession,
        version: int,
        appended: DataFrame | None = None,
        updates: DataFrame | None = None,
        target: str | None = None,
    ) -> Published | None:
        """Write one more version; None if it (or a later one) is there already, as when a batch runs again.

        ``updates`` (record_id, ``target``, and the part column where it is known) set ``target`` in stored rows of that id. Ids
        that are not stored change nothing. Only parts in which a value differs are written anew. An id not found in
        the part that its update names is looked for in the others if the filter of ids lets it pass.

        Of ``appended`` rows those whose id is not stored yet are added, in any part: an append that is
        tried twice adds nothing. Ids of 24 hex digits count without case. Of several new rows of one id the least stays.
        """
        now = self.version(spark)
        if now is not None and now >= version:
            return None
        old = self.manifest(spark, now)
        with scratch_scope(spark):
            counts, parts, rows = {}, set(), []
            if updates is not None:
                found = stored(self._located(spark, old, updates, target), "located")
                counts = {"updates": updates.count(), "matched": found.count()}
                changed = found.where(~F.col("stored_value").eqNullSafe(F.col("new_value")))
                touched = changed.groupBy("in_part").count().collect()  # a row per touched part
                parts = {row.in_part for row in touched}
                counts |= {"modified": sum(row["count"] for row in touched), "rewritten_parts": len(parts)}
                if parts:
                    rows.append(self._set(self._read(spark, old, parts), changed, target))
            fresh = None
            if appended is not None:
                fresh = stored(self._unstored(spark, old, appended), "fresh")
                counts["appended"] = fresh.count()
                rows += [fresh] if counts["appended"] else []
            new = self._written(spark, rows, counts.get("appended", 0), fresh, old)
        kept = [tuple(row)[:3] for row in old if row.part not in parts and not (row.kind == FILTER and new.replaces_filters)]
        listed = spark.createDataFrame([*kept, *new.rows], MANIFEST)
        write_batch(listed.coalesce(1), f"{self.root}/manifests", version)
        return Published(version, **counts)

    def _set(self, rows: DataFrame, changed: DataFrame, target: str) -> DataFrame:
        values = changed.select("record_id", "new_value", F.lit(True).alias("hit"))
        joined = rows.join(values, F.lower(self.id_column) == F.col("record_id"), "left")
        value = F.when(F.col("hit"), F.col("new_value")).otherwise(F.col(target)).alias(target)
        return joined.select(*[value if name == target else rows[name] for name in self.schema.fieldNames()])

    def _located(self, spark: SparkSession, old: list, updates: DataFrame, target: str) -> DataFrame:
        """(record_id, new_value, stored_value, in_part) of the updates that hit a stored row."""
        wanted = updates.select("record_id", F.col(target).alias("new_value"))

        def among(some: DataFrame, parts: set[str] | None) -> DataFrame:
            held = self._read(spark, old, parts).select(
                F.lower(self.id_column).alias("record_id"), F.col(target).alias("stored_value"), self._part_text().alias("in_part")
            )
            return some.join(held, "record_id").select("record_id", "new_value", "stored_value", "in_part")

        if self.part not in updates.columns:
            return among(wanted, None)
        named = {row[0] for row in updates.select(self._part_text()).distinct().collect()}  # parts of one batch
        first = stored(among(wanted, named), "hits")
        rest = wanted.join(first, "record_id", "left_anti")
        others = {row.part for row in old if row.kind == DATA} - named
        maybe = stored(maybe_held(rest, "record_id", self._filters(spark, old), self.filter_bits), "maybe")
        return first if not others or maybe.isEmpty() else first.unionByName(among(maybe, others))

    def _unstored(self, spark: SparkSession, old: list, appended: DataFrame) -> DataFrame:
        """The appended rows whose id no stored row has, one per id."""
        names = self.schema.fieldNames()
        rest = [name for name in names if name != self.id_column]
        one = appended.select(*names).groupBy(F.lower(self.id_column).alias("record_id")).agg(
            F.min(F.struct(self.id_column, *rest)).alias("row")
        )
        rows = stored(one.select("record_id", "row.*"), "appended")
        if not old:
            return rows.select(*names)
        parts = {row[0] for row in rows.select(self._part_text()).distinct().collect()}

        def held(some: Iterable[str]) -> DataFrame:
            return self._read(spark, old, some).select(F.lower(self.id_column).alias("record_id"))

        new = rows.join(held(parts), "record_id", "left_anti")
        others = {row.part for row in old if row.kind == DATA} - parts
        maybe = stored(maybe_held(new.select("record_id"), "record_id", self._filters(spark, old), self.filter_bits), "maybe")
        if others and not maybe.isEmpty():
            elsewhere = maybe.join(held(others), "record_id", "left_semi")
            new = new.join(elsewhere, "record_id", "left_anti")
        return new.select(*names)

    def _filters(self, spark: SparkSession, manifest: list) -> DataFrame:
        paths = [f"{self.root}/filters/{row.folder}" for row in manifest if row.kind == FILTER]
        schema = "bucket long, bitmap binary"
        return spark.read.schema(schema).parquet(*paths) if paths else spark.createDataFrame([], schema)

    def _written(self, spark: SparkSession, frames: list[DataFrame], appended: int, fresh: DataFrame | None, old: list) -> _New:
        folder = uuid.uuid4().hex
        rows, replaces = [], False
        if frames:
            whole = frames[0]
            for more in frames[1:]:
                whole = whole.unionByName(more)
            path = f"{self.root}/data/written={folder}"
            write_snapshot(whole, path, self.part, self.sort)
            written = spark.read.schema(self.schema).parquet(path)  # names of folders only
            rows = [(DATA, row[0], folder) for row in written.select(self._part_text()).distinct().collect()]
        if appended:
            bits = id_filter(fresh, self.id_column, self.filter_bits)
            replaces = sum(row.kind == FILTER for row in old) >= MOST_FILTERS
            if replaces:
                bits = merged_filters(self._filters(spark, old).unionByName(bits))
            bits.write.parquet(f"{self.root}/filters/{folder}")
            rows.append((FILTER, None, folder))
        return _New(rows, replaces)

    def replace_parts(self, spark: SparkSession, version: int, rows: DataFrame, notes: dict[str, str]) -> None:
        """A version in which the parts that ``rows`` has hold these rows, and all others what they did. ``notes`` replace the earlier ones."""
        old = [row for row in self.manifest(spark, self.version(spark)) if row.kind in (DATA, FILTER)]
        new = self._written(spark, [rows], 0, None, old).rows
        parts = {part for _, part, _ in new}
        kept = [tuple(row)[:3] for row in old if row.part not in parts]
        told = [(kind, value, None) for kind, value in notes.items()]
        listed = spark.createDataFrame([*kept, *new, *told], MANIFEST)
        write_batch(listed.coalesce(1), f"{self.root}/manifests", version)

    def expire(self, spark: SparkSession, before: int) -> int:
        """Delete versions before ``before`` (never the latest) and the folders that no later one names; returns how many went.

        To be called once nobody reads those versions any more.
        """
        latest = self.version(spark)
        if latest is None:
            return 0
        listed = read_batches(spark, f"{self.root}/manifests", MANIFEST)
        kept = listed.where((F.col("batch_id") >= before) | (F.col("batch_id") == latest))
        gone = listed.where((F.col("batch_id") < before) & (F.col("batch_id") != latest))
        folders = gone.select("kind", "folder").distinct().join(kept, ["kind", "folder"], "left_anti")
        paths = {
            f"{self.root}/data/written={row.folder}" if row.kind == DATA else f"{self.root}/filters/{row.folder}"
            for row in folders.collect()
        }
        versions = [row.batch_id for row in gone.select("batch_id").distinct().collect()]
        for path in [*paths, *[f"{self.root}/manifests/batch_id={v}" for v in versions]]:
            remove_path(spark, path)
        return len(versions)


@dataclass(frozen=True)
class _New:
    rows: list[tuple]
    replaces_filters: bool


def with_id_part(rows: DataFrame, id_column: str, parts: int = 256) -> DataFrame:
    """Rows with a column ``part`` by a hash of the id, for tables that have no date; an update's part is thus known."""
    return rows.withColumn("part", F.pmod(F.xxhash64(F.lower(id_column)), F.lit(parts)).cast("int"))
