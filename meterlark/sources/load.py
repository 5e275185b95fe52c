"""Keyed loading that never changes a row that is already there."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from meterlark import schemas as S
from meterlark.operators.clean import enforce_lengths, enforce_present, null_out_nan
from meterlark.operators.quality import orphan_summary
from meterlark.session import materialize
from meterlark.sources.files import read_table
from meterlark.sources.snapshots import Log, Snapshot, read_snapshot


def _all_present(keys: Sequence[str]) -> Column:
    present = F.col(keys[0]).isNotNull()
    for key in keys[1:]:
        present = present & F.col(key).isNotNull()
    return present


def _first_per_key(df: DataFrame, keys: Sequence[str], order: Sequence[str]) -> DataFrame:
    others = [c for c in df.columns if c not in keys and c not in order]
    ranked = [c for c in order if c not in keys] + others
    keyed = df.where(_all_present(keys))
    if not ranked:
        return keyed.dropDuplicates(list(keys))
    first = keyed.groupBy(*keys).agg(F.min(F.struct(*ranked)).alias("_first"))
    return first.select(*keys, "_first.*").select(*df.columns)


def keep_first(df: DataFrame, keys: Sequence[str], order: Sequence[str]) -> DataFrame:
    """First row per key by `order`; rows with a NULL in the key are all kept.

    The minimum of a struct combines on the map side, so a key that holds a large part of
    the rows sends one row per task instead of all its rows to one task. Columns outside
    `order` decide remaining ties, so the result does not depend on row order.
    """
    return _first_per_key(df, keys, order).unionByName(df.where(~_all_present(keys)))


def insert_if_absent(
    batch: DataFrame, target: DataFrame | None, keys: Sequence[str], order: Sequence[str]
) -> DataFrame:
    """The rows of `batch` to append to `target`: first row per key, and only keys it lacks.

    NULL never equals NULL here, so rows with a NULL in the key are always new. The
    anti-join reuses the shuffle that found the first rows.
    """
    first = _first_per_key(batch, keys, order)
    if target is not None:
        first = first.join(target.select(*keys).dropna(), list(keys), "left_anti")
    return first.unionByName(batch.where(~_all_present(keys)))


def with_running_id(df: DataFrame, name: str, start: int = 1) -> DataFrame:
    """Add an increasing id that is unique within this frame and not below `start`, with gaps."""
    return df.select((F.monotonically_increasing_id() + F.lit(start)).alias(name), "*")


def with_dense_id(df: DataFrame, name: str, order: Sequence[str], start: int = 1) -> DataFrame:
    """Add the ids start, start+1, ... in the order of the `order` columns.

    Rows are range-sorted over all tasks and written once. The position inside each sorted
    part, plus the sizes of the parts before it, is the id, so no task sees all rows.
    `order` should identify a row.
    """
    part_bits = 33
    placed = df.orderBy(*order).withColumn("_place", F.monotonically_increasing_id())
    placed = materialize(placed, "dense-id").withColumn("_part", F.shiftright("_place", part_bits))
    sizes = placed.groupBy("_part").agg(F.count("*").alias("_size"))
    # One row per part, so this window holds as many rows as the sort had tasks.
    before = Window.partitionBy(F.lit(0)).orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
    offsets = sizes.select("_part", F.coalesce(F.sum("_size").over(before), F.lit(0)).alias("_before"))
    position = F.col("_place") - F.shiftleft(F.col("_part"), part_bits)
    # Broadcast: one row per part.
    return placed.join(F.broadcast(offsets), "_part").select(
        (F.col("_before") + position + F.lit(start)).alias(name), *df.columns
    )


#: The tables of a load, as folders and in the log.
BUILDINGS, MEASURES = "buildings", "energy_performance"
LOADED = {BUILDINGS: S.BUILDINGS, MEASURES: S.ENERGY_WITH_ID}


def read_loaded(spark: SparkSession, folder: str, number: int | None = None) -> tuple[DataFrame, DataFrame]:
    """Buildings and measures of the last published state, or of an earlier one by its number."""
    tables = read_snapshot(spark, folder, LOADED, number)
    return tables[BUILDINGS], tables[MEASURES]


def load_tables(
    spark: SparkSession,
    folder: str,
    buildings: DataFrame,
    energy: DataFrame,
    building_order: Sequence[str],
    energy_order: Sequence[str],
) -> tuple[DataFrame, DataFrame]:
    """Load the new buildings and the new measures, and return both tables. Runs jobs.

    The order columns tell which of several rows with one key came first. Both batches are written
    to fresh folders and validated, and one manifest then publishes both at once (see `snapshots`): a
    broken rule, a failed job or a killed driver before that leaves both tables as they were, for
    every reader of `read_loaded`. Loads may overlap. One that finds its number taken drops what
    it wrote and begins again from the newer state, so known keys stay known and ids unique.
    Measures get ids that go on after the largest one loaded, which the manifest remembers. They are
    stored by year, and only the batch's years are read to find known keys. A batch without new
    rows publishes nothing.
    """
    log = Log(spark, folder)
    while True:
        before = log.adopt(LOADED, "performance_id")
        made = {BUILDINGS: log.fresh(BUILDINGS), MEASURES: log.fresh(MEASURES)}
        published = None
        try:
            counts = _write_batches(log, before, made, buildings, energy, building_order, energy_order)
            tables = {t: before.tables.get(t, []) + ([made[t]] if counts[t] else []) for t in made}
            after = Snapshot(before.number + 1, tables, before.next_id + counts[MEASURES])
            if not any(counts.values()):
                published = before
            elif log.publish(after):
                published = after
        finally:
            for table, name in made.items():
                if published is None or name not in published.tables.get(table, []):
                    log.remove(f"{log.folder}/{name}")
        if published is not None:
            return log.read(published, BUILDINGS, S.BUILDINGS), log.read(published, MEASURES, S.ENERGY_WITH_ID)


def _write_batches(
    log: Log,
    before: Snapshot,
    made: dict[str, str],
    buildings: DataFrame,
    energy: DataFrame,
    building_order: Sequence[str],
    energy_order: Sequence[str],
) -> dict[str, int]:
    """Write both batches of new rows, check them, and return their numbers of rows."""
    known = log.read(before, BUILDINGS, S.BUILDINGS)
    checked = enforce_lengths(enforce_present(buildings.select(*S.BUILDINGS.names, *_extra(building_order, S.BUILDINGS)), [S.KEY]))
    new_buildings = insert_if_absent(checked, known if before.tables.get(BUILDINGS) else None, [S.KEY], building_order)
    new_buildings.select(*S.BUILDINGS.names).write.parquet(f"{log.folder}/{made[BUILDINGS]}")
    new_buildings = read_table(log.spark, f"{log.folder}/{made[BUILDINGS]}", S.BUILDINGS)

    measures = null_out_nan(energy.select(*S.ENERGY.names, *_extra(energy_order, S.ENERGY)))
    measures = enforce_lengths(measures, {S.KEY: S.TEXT_LIMITS[S.KEY]})
    present = None
    if before.tables.get(MEASURES):
        # One row per year.
        years = [r[S.YEAR] for r in measures.select(S.YEAR).distinct().collect()]
        present = log.read(before, MEASURES, S.ENERGY_WITH_ID).where(F.col(S.YEAR).isin([y for y in years if y is not None]))
    new_measures = insert_if_absent(measures, present, [S.KEY, S.YEAR], energy_order)
    order = list(dict.fromkeys([S.KEY, S.YEAR, *energy_order]))
    new_measures = with_dense_id(new_measures, "performance_id", order, before.next_id)
    new_measures = new_measures.select(*S.ENERGY_WITH_ID.names)
    new_measures.write.partitionBy(S.YEAR).parquet(f"{log.folder}/{made[MEASURES]}")
    new_measures = read_table(log.spark, f"{log.folder}/{made[MEASURES]}", S.ENERGY_WITH_ID)
    orphans = orphan_summary(new_measures, known.unionByName(new_buildings), S.KEY).first()["orphan_rows"]
    if orphans:
        raise ValueError(f"{orphans} energy rows refer to a building that is not loaded")
    return {BUILDINGS: new_buildings.count(), MEASURES: new_measures.count()}


def _extra(order: Sequence[str], schema) -> list[str]:
    return [c for c in order if c not in schema.names]
