"""Left joins of a large table to a uniquely keyed one, and small tables held as rows."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

import pyarrow as pa
from pyspark.sql import Column, DataFrame, Row
from pyspark.sql import functions as F
from pyspark.sql import types as T


@dataclass(frozen=True)
class BroadcastBound:
    """The most a side may hold to be broadcast."""

    rows: int = 500_000
    text_bytes: int = 64 << 20


DEFAULT_BOUND = BroadcastBound()


def _text_columns(df: DataFrame) -> list[str]:
    return [f.name for f in df.schema.fields if isinstance(f.dataType, T.StringType)]


def within_bound(df: DataFrame, bound: BroadcastBound = DEFAULT_BOUND) -> bool:
    """Count rows and text bytes of ``df``: one aggregate, one row to the driver."""
    sizes = [F.sum(F.octet_length(name)) for name in _text_columns(df)]
    total = F.lit(0).cast("bigint")
    for size in sizes:
        total = total + F.coalesce(size, F.lit(0))
    measured = df.agg(F.count(F.lit(1)).alias("n"), total.alias("b")).first()
    return measured.n <= bound.rows and measured.b <= bound.text_bytes


def bounded_rows(df: DataFrame, bound: BroadcastBound = DEFAULT_BOUND) -> list[Row] | None:
    """The rows of ``df`` if they fit the bound, else None; measured before any is fetched."""
    return df.collect() if within_bound(df, bound) else None


def local_frame(template: DataFrame, rows: Sequence[Row]) -> DataFrame:
    """Rows already fetched, as a frame with the schema of ``template``."""
    columns = {name: [row[name] for row in rows] for name in template.columns}
    arrow = pa.table({name: pa.array(values) for name, values in columns.items()}) if rows else None
    if arrow is None:
        return template.sparkSession.createDataFrame([], template.schema)
    frame = template.sparkSession.createDataFrame(arrow)
    return frame.select(*[F.col(f.name).cast(f.dataType).alias(f.name) for f in template.schema.fields])


def attach(
    fact: DataFrame,
    keyed: DataFrame,
    keys: Sequence[str],
    bound: BroadcastBound = DEFAULT_BOUND,
    measured: DataFrame | None = None,
) -> DataFrame:
    """``fact`` left-joined to ``keyed``, which has at most one row per key.

    Within ``bound`` the keyed side is broadcast: no shuffle, so no hot partition.
    Beyond it the join shuffles, reading ``fact`` once; a partition swollen by a hot key
    or by rows without a key is split at run time (adaptive skew join), as only the fact side repeats keys.
    ``measured`` is a stored table at least as large as ``keyed``, where ``keyed``
    itself would have to be computed to be measured.
    """
    if within_bound(keyed if measured is None else measured, bound):
        keyed = F.broadcast(keyed)
    joined = fact.join(keyed, list(keys), "left")
    return joined.select(*fact.columns, *[c for c in keyed.columns if c not in keys])


# ---- Id filters ---------------------------------------------------------------
# A Bloom filter of record ids as a table of bitmaps, so that it may be of any size.

#: Bits that an id sets.
ID_HASHES = 4


def _id_bits(record_id: Column, bits: int) -> Column:
    return F.array(*[F.pmod(F.xxhash64(F.lower(record_id), F.lit(n)), F.lit(bits)) for n in range(ID_HASHES)])


def id_filter(ids: DataFrame, record_id: str, bits: int) -> DataFrame:
    """(bucket, bitmap) over ``bits`` bits. Filters of several tables are merged by ``merged_filters``."""
    places = ids.select(F.explode(_id_bits(F.col(record_id), bits)).alias("place"))
    return places.groupBy(F.bitmap_bucket_number("place").alias("bucket")).agg(
        F.bitmap_construct_agg(F.bitmap_bit_position("place")).alias("bitmap")
    )


def merged_filters(filters: DataFrame) -> DataFrame:
    return filters.groupBy("bucket").agg(F.bitmap_or_agg("bitmap").alias("bitmap"))


def maybe_held(ids: DataFrame, record_id: str, filters: DataFrame, bits: int) -> DataFrame:
    """The rows of ``ids`` whose id the filter may hold: all that it does, and few others."""
    probes = ids.select(F.lower(record_id).alias("_probe"), F.explode(_id_bits(F.col(record_id), bits)).alias("place"))
    at = probes.select(
        "_probe", F.bitmap_bucket_number("place").alias("bucket"), F.bitmap_bit_position("place").alias("bit")
    )
    byte = F.conv(F.hex(F.substring("bitmap", F.expr("cast(bit div 8 as int) + 1"), F.lit(1))), 16, 10).cast("int")
    is_set = F.coalesce(F.getbit(byte.cast("long"), (F.col("bit") % 8).cast("int")), F.lit(0))
    found = at.join(merged_filters(filters), "bucket", "left").groupBy("_probe").agg(F.min(is_set).alias("held")).where("held = 1")
    return ids.join(found, F.lower(record_id) == F.col("_probe"), "left_semi")
