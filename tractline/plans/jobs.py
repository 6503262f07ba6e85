"""From input folders and clinical tables to every output, in one call each."""

from __future__ import annotations

import uuid
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tractline.operators.geocode import DEFAULT_THRESHOLD
from tractline.operators.tracts import TractIndex, build_tract_index
from tractline.operators.visits import DEFAULT_CUTOFF
from tractline.plans.linkage import link_addresses, link_coordinates, link_visits, refresh_location
from tractline.session import discard, stored
from tractline.sinks import files
from tractline.sinks.location_store import LocationStore
from tractline.sources.csv_folder import COORDINATES, LOCATION, LOCATION_HISTORY, MULTI, SINGLE, FolderScan, scan_folder
from tractline.sources.tables import CdmTables
from tractline.streaming.incremental import run_new_files


def _with_number_ids(df: DataFrame) -> DataFrame:
    """LOCATION rows whose ids sort as the numbers they are, unless one is none."""
    numbers = df.where(F.col("location_id").try_cast("bigint").isNull()).isEmpty()
    return df.withColumn("location_id", F.col("location_id").try_cast("bigint")) if numbers else df


def write_scan(
    spark: SparkSession,
    scan: FolderScan,
    output: str,
    address_points: DataFrame,
    tracts: DataFrame | TractIndex,
    hospitals: DataFrame | None = None,
    threshold: float = DEFAULT_THRESHOLD,
    pivot: int = 2020,
    input_folder: str | None = None,
    mode: str = "errorifexists",
    store: LocationStore | None = None,
    delivery: str = "",
) -> None:
    """Link what a scan found and write it below ``output``.

    ``with_coordinates/<shape>`` and ``with_fips/<shape>`` hold one folder per source file, ``LOCATION``
    and ``LOCATION_HISTORY`` the clinical tables, ``rejected`` the files that were not read and why. LOCATION
    rows also join the table of a ``store`` as its ``delivery``. Scratch tables go when they are written out.
    """
    index = tracts if isinstance(tracts, TractIndex) else build_tract_index(tracts)
    for shape, df in scan.frames.items():
        if shape == COORDINATES:
            files.write_with_fips(link_coordinates(df, index, pivot), f"{output}/with_fips/{shape}", input_folder, mode)
        elif shape in (MULTI, SINGLE):
            linked = stored(link_addresses(df, address_points, index, hospitals, threshold, pivot), f"linked-{shape}")
            files.write_with_coordinates(linked, f"{output}/with_coordinates/{shape}", input_folder, mode)
            files.write_with_fips(linked, f"{output}/with_fips/{shape}", input_folder, mode)
            discard(linked)
        elif shape == LOCATION:
            refreshed = stored(refresh_location(df, address_points, threshold), "refreshed")
            files.write_location(_with_number_ids(refreshed), f"{output}/LOCATION", input_folder, mode)
            if store is not None:
                store.merge(delivery, refreshed)
            discard(refreshed)
        elif shape == LOCATION_HISTORY:
            files.write_location_history(df, f"{output}/LOCATION_HISTORY", input_folder, mode)
    if scan.rejected:
        report = spark.createDataFrame(sorted(scan.rejected.items()), "path string, reason string")
        report.write.csv(f"{output}/rejected", mode=mode, header=True, escape='"')


def run_folder(
    spark: SparkSession,
    folder: str,
    output: str,
    address_points: DataFrame,
    tracts: DataFrame | TractIndex,
    hospitals: DataFrame | None = None,
    threshold: float = DEFAULT_THRESHOLD,
    pivot: int = 2020,
    progress: str | None = None,
) -> None:
    """Read every CSV file of ``folder``, link its rows and write all results below ``output``.

    With ``progress``, a checkpoint folder, only files that no earlier run finished are taken, and each
    run's batches go to ``output/batch_id=<n>``. The LOCATION rows of all runs make up one table, kept in
    ``output/location_table`` and written as ``output/LOCATION`` when a run has added to it.
    """
    files.check_target(output, folder)
    index = tracts if isinstance(tracts, TractIndex) else build_tract_index(tracts)
    write: Callable[..., None] = lambda scan, target, **more: write_scan(
        spark, scan, target, address_points, index, hospitals, threshold, pivot, folder, **more
    )
    if progress is None:
        write(scan_folder(spark, folder), output)
    else:
        store = LocationStore(spark, f"{output}/location_table")
        before = store.version()
        # A batch that failed half-way comes again with the same number and replaces what it wrote. To the
        # LOCATION table it is a new delivery, whose rows are held already; numbers begin anew with a checkpoint.
        run_new_files(
            spark,
            folder,
            progress,
            lambda scan, batch: write(
                scan, f"{output}/batch_id={batch}", mode="overwrite", store=store, delivery=f"batch-{batch}-{uuid.uuid4().hex}"
            ),
        )
        table = store.read()
        if table is not None and store.version() > before:
            files.write_location(_with_number_ids(table), f"{output}/LOCATION", folder, "overwrite")


def run_cdm(
    cdm: CdmTables,
    output: str,
    tracts: DataFrame | TractIndex,
    address_points: DataFrame | None = None,
    hospitals: DataFrame | None = None,
    threshold: float = DEFAULT_THRESHOLD,
    cutoff: str | None = DEFAULT_CUTOFF,
    pivot: int = 2020,
    open_ended: bool = False,
) -> None:
    """Match visits to residences, place them and write all results below ``output``.

    ``categories`` are pages per category, ``invalid`` the visits without a usable place,
    ``with_coordinates`` and ``with_fips`` all linked visits, ``LOCATION`` the places they refer to and
    ``LOCATION_HISTORY`` the residences as read.
    """
    linked = link_visits(
        cdm.person, cdm.visit, cdm.location, cdm.history, tracts, address_points, hospitals, threshold, cutoff, pivot, open_ended
    )
    linked = stored(linked, "linked-visits")
    files.write_category_batches(linked, f"{output}/categories")
    files.write_invalid(linked, f"{output}/invalid")
    files.write_with_coordinates(linked, f"{output}/with_coordinates")
    files.write_with_fips(linked, f"{output}/with_fips")
    files.write_location(linked, f"{output}/LOCATION")
    files.write_location_history(cdm.history, f"{output}/LOCATION_HISTORY")
    discard(linked)
