"""Keyed upsert as a DataFrame expression.

Built-in Parquet tables cannot be the target of MERGE INTO, so the merge is a full
outer join on the key. sources.tables.ChangeTable keeps batches as changes instead.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

STAMPS = ("inserted_at", "updated_at")


def fold_batch(
    source: DataFrame,
    keys: Sequence[str],
    order: Sequence[str],
    update_cols: Sequence[str],
) -> DataFrame:
    """One row per key, as if the records had been merged one after another.

    The earliest record inserts the row, the latest one gives the updatable columns.
    Both are aggregates, so repeated keys shrink before the shuffle.
    """
    fixed = [c for c in source.columns if c not in keys and c not in update_cols]
    updated = [c for c in source.columns if c in update_cols]
    comparable = [
        f.name for f in source.schema.fields if f.dataType.typeName() not in ("map", "variant")
    ]
    # The hash only decides between records with equal times, so that a retry repeats itself.
    position = F.struct(*order, F.xxhash64(*comparable))
    aggregates = []
    if fixed:
        aggregates.append(F.min_by(F.struct(*fixed), position).alias("_first"))
    if updated:
        aggregates.append(F.max_by(F.struct(*updated), position).alias("_last"))
    folded = source.groupBy(*keys).agg(*aggregates)
    columns = [
        F.col(c) if c in keys else F.col("_first" if c in fixed else "_last")[c].alias(c)
        for c in source.columns
    ]
    return folded.select(*columns)


def upsert(
    target: DataFrame,
    source: DataFrame,
    keys: Sequence[str],
    as_of: Column,
    order: Sequence[str] = ("fetched_at",),
    update_cols: Sequence[str] | None = None,
    newer_by: str | None = None,
) -> DataFrame:
    """The state of target after merging source.

    Rows found in both take update_cols (all source columns by default) from source
    and as_of as updated_at; new rows take every source column and as_of as both
    stamps; the other rows stay. With newer_by, an existing row only changes where
    the source value of that column is not older. Columns and order are target's.
    Records without a complete key are left out, after the join: before it, the condition
    would be pushed below the parsing of the records and parse them a second time.
    """
    if update_cols is None:
        update_cols = [c for c in source.columns if c not in keys]
    incoming = fold_batch(source, keys, order, update_cols)
    t = target.withColumn("_stored", F.lit(True)).alias("t")
    s = incoming.withColumn("_arrived", F.lit(True)).alias("s")
    matching = [F.col(f"t.{k}") == F.col(f"s.{k}") for k in keys]
    joined = t.join(s, matching, "full_outer")
    for k in keys:
        joined = joined.filter(F.coalesce(f"t.{k}", f"s.{k}").isNotNull())

    arrived = F.col("s._arrived").isNotNull()
    stored = F.col("t._stored").isNotNull()
    changes = arrived
    if newer_by is not None:
        old, new = F.col(f"t.{newer_by}"), F.col(f"s.{newer_by}")
        changes = arrived & (~stored | old.isNull() | F.coalesce(new >= old, F.lit(False)))

    def merged(name: str) -> Column:
        if name in keys:
            value = F.coalesce(F.col(f"t.{name}"), F.col(f"s.{name}"))
        elif name == "updated_at":
            value = F.when(changes, as_of).otherwise(F.col("t.updated_at"))
        elif name == "inserted_at":
            value = F.when(stored, F.col("t.inserted_at")).otherwise(as_of)
        elif name not in source.columns:
            value = F.col(f"t.{name}")
        elif name in update_cols:
            value = F.when(changes, F.col(f"s.{name}")).otherwise(F.col(f"t.{name}"))
        else:
            value = F.when(stored, F.col(f"t.{name}")).otherwise(F.col(f"s.{name}"))
        return value.cast(target.schema[name].dataType).alias(name)

    return joined.select(*[merged(name) for name in target.columns])


def merge_into(
    table: str,
    source: DataFrame,
    keys: Sequence[str],
    as_of: Column,
    order: Sequence[str] = ("fetched_at",),
    update_cols: Sequence[str] | None = None,
) -> None:
    """The same upsert by the table's own MERGE, for a catalogue that supports it.

    The tests here have no such catalogue, so this form is not covered by them.
    """
    if update_cols is None:
        update_cols = [c for c in source.columns if c not in keys]
    keyed = source.dropna(subset=list(keys))
    incoming = fold_batch(keyed, keys, order, update_cols).alias("arriving")
    matching = F.lit(True)
    for key in keys:
        matching = matching & (F.col(f"{table}.{key}") == F.col(f"arriving.{key}"))
    changes = {c: F.col(f"arriving.{c}") for c in update_cols} | {"updated_at": as_of}
    new_row = {c: F.col(f"arriving.{c}") for c in source.columns}
    new_row |= {stamp: as_of for stamp in STAMPS}
    (
        incoming.mergeInto(table, matching)
        .whenMatched()
        .update(changes)
        .whenNotMatched()
        .insert(new_row)
        .merge()
    )
