"""Expiry of raw rows by date.

A day is a partition, so expiry drops whole partition folders and their files. The cutoff day
itself stays, and so do rows without a date.
"""
from __future__ import annotations

import datetime as dt
from collections.abc import Iterable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..config import PipelineConfig, parse_retention
from ..sources.tables import (day_folders, file_system, has_data_files, path_exists,
                              read_raw)
from .compare import unredacted_rows

# Fixed value: annotations never expire by default.
EXPIRING = ("spans", "logs")
_STATEMENT_SIZE = 500


def expired(retention, as_of: dt.date | None = None, date: str = "date") -> Column:
    """True for rows past the retention; never true if retention is off."""
    days = parse_retention(retention)
    if days is None:
        return F.lit(False)
    today = F.current_date() if as_of is None else F.lit(as_of)
    return F.coalesce(F.col(date) < F.date_sub(today, days), F.lit(False))


def plan_expiry(df: DataFrame, retention, as_of: dt.date | None = None) -> DataFrame:
    """Rows per day that expiry would drop."""
    return df.where(expired(retention, as_of)).groupBy("date").agg(F.count("*").alias("rows"))


def keep(df: DataFrame, retention, as_of: dt.date | None = None) -> DataFrame:
    """The rows that expiry leaves."""
    return df.where(~expired(retention, as_of))


def _cutoff(spark: SparkSession, retention, as_of: dt.date | None) -> dt.date | None:
    days = parse_retention(retention)
    if days is None:
        return None
    today = as_of or spark.range(1).select(F.current_date()).first()[0]
    return today - dt.timedelta(days=days)


def expire_folder(spark: SparkSession, path: str, retention,
                  as_of: dt.date | None = None) -> list[dt.date]:
    """Delete the ``date=`` folders below the cutoff; returns the days that were dropped.

    Safe to run again after a failure: what is already gone is not listed.
    """
    cutoff = _cutoff(spark, retention, as_of)
    if cutoff is None:
        return []
    folders = day_folders(spark, path)
    if not folders and has_data_files(spark, path):
        raise ValueError(f"{path} is not partitioned by date, so its days cannot be dropped")
    dropped = {day: folder for day, folder in folders.items() if day < cutoff}
    for folder in dropped.values():
        fs, folder_path = file_system(spark, folder)
        if not fs.delete(folder_path, True):
            raise OSError(f"cannot delete {folder}")
    return sorted(dropped)


def expire_table(spark: SparkSession, table: str, retention,
                 as_of: dt.date | None = None) -> list[dt.date]:
    """The same for a catalog table that is partitioned by ``date``."""
    cutoff = _cutoff(spark, retention, as_of)
    if cutoff is None:
        return []
    days = []
    for (partition,) in spark.sql(f"SHOW PARTITIONS {table}").toLocalIterator():
        values = dict(part.split("=", 1) for part in partition.split("/"))
        try:
            days.append(dt.date.fromisoformat(values["date"]))
        except ValueError:
            continue
    dropped = sorted({day for day in days if day < cutoff})
    for i in range(0, len(dropped), _STATEMENT_SIZE):
        specs = ", ".join(f"PARTITION (date = '{day}')" for day in dropped[i:i + _STATEMENT_SIZE])
        spark.sql(f"ALTER TABLE {table} DROP IF EXISTS {specs}")
    return dropped


def expire(spark: SparkSession, config: PipelineConfig, as_of: dt.date | None = None,
           kinds: Iterable[str] = EXPIRING, redacted: dict[str, DataFrame] | None = None,
           ) -> dict[str, list[dt.date]]:
    """Expire raw tables. With ``redacted`` given, refuse to drop rows not yet redacted."""
    dropped = {}
    for kind in kinds:
        path = config.raw_path(kind)
        if redacted is not None and path_exists(spark, path):
            # A row keeps its date, so both sides read the expired days only.
            past = expired(config.retention_days, as_of)
            old, done = read_raw(spark, config, kind).where(past), redacted[kind].where(past)
            if not unredacted_rows(old.select("record_id"), done).isEmpty():
                raise ValueError(f"{path} holds expired rows that are not redacted yet")
        dropped[kind] = expire_folder(spark, path, config.retention_days, as_of)
    return dropped
