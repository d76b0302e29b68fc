"""Features that grow by the day: each new day is featured from the stored tail of its series, not from the history.

Two slice tables under one folder: ``features`` by date, and ``tails`` by the day each was taken after. A step drops the
tails from its first day on, writes the features, then the new tail; it may stop anywhere and be repeated. Where it was
not repeated, the features have days that no tail covers, and a later step is refused.
"""

from __future__ import annotations

import datetime as dt

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ripecast import constants as K
from ripecast import schemas
from ripecast.operators import tails
from ripecast.operators.series import MAX_SERIES_ROWS
from ripecast.plans import features
from ripecast.sources import snapshots, tables

AS_OF = "as_of"


def features_after(
    tail: DataFrame, rows: DataFrame, max_rows: int | None = MAX_SERIES_ROWS, min_history: int | None = K.MIN_HISTORY_ROWS
) -> DataFrame:
    """``features_enriched`` of clean rows that come after a tail."""
    return tails.columns_after(
        tail, rows, K.SERIES, "date", features.LOOKBACK, features.series_features,
        min_history=min_history, ties=features.TIES, max_rows=max_rows,
    )


class DailyFeatures:
    """Enriched features of clean rows under ``root``, one step of days after another.

    The tails of the last ``keep`` steps are kept, so a step can begin again where one of them ended; within the days of
    an earlier step it is refused. ``max_rows=None`` states that clean rows are unique per (date, store, item).
    """

    def __init__(self, spark: SparkSession, root: str, max_rows: int | None = MAX_SERIES_ROWS, keep: int = 8):
        if keep < 1:
            raise ValueError("at least one tail has to be kept")
        self.spark, self.max_rows, self.keep = spark, max_rows, keep
        self.features = snapshots.SliceTable(spark, f"{root}/features", schemas.TABLES["features_enriched"], "date", K.SERIES)
        tail = f"{schemas.CLEAN}, {tails.NTH} BIGINT, {AS_OF} DATE"
        self.tails = snapshots.SliceTable(spark, f"{root}/tails", tail, AS_OF, K.SERIES)

    def read(self) -> DataFrame:
        return self.features.read()

    def tail(self, before: str | dt.date | None = None) -> DataFrame:
        """The last rows of every series before a day, or after all days, with their positions."""
        days = [d for d in _days(self.tails) if before is None or d < str(before)]
        if not days:
            return self.tails.read().where(F.lit(False)).drop(AS_OF)
        return self.tails.read().where(F.col(AS_OF) == F.lit(days[-1]).cast("date")).drop(AS_OF)

    def start(self, clean: DataFrame, end: str | dt.date) -> DataFrame:
        """Begin anew with all rows up to ``end``, and return their features. Rows without a date are not part of it."""
        rows = clean.select(*features.CLEAN_COLUMNS).where(F.col("date") <= F.lit(str(end)).cast("date"))
        done = features.features_enriched(rows, self.max_rows)
        self.tails.replace(tables.empty(self.spark, self.tails.schema))
        self.features.replace(done)
        self._keep(tails.start_tail(rows, K.SERIES, "date", features.LOOKBACK, features.TIES), end)
        return self.read()

    def append(self, clean: DataFrame, start: str | dt.date, end: str | dt.date) -> DataFrame:
        """Feature the days from ``start`` to ``end``, both included, and return their features.

        Only these days of ``clean`` and one tail are read. Days from ``start`` on that are stored already, and all after
        them, whose lags depend on them, are replaced: the later ones have to be appended again.
        """
        start, end = str(start), str(end)
        if start > end:
            raise ValueError(f"{start} is after {end}")
        days = [d for d in _days(self.tails) if d < start]
        if not days:
            raise ValueError(f"no tail is kept from before {start}; start anew")
        uncovered = [d for d in _days(self.features) if days[-1] < d < start]
        if uncovered:
            raise ValueError(f"no tail covers {uncovered[0]}; append from that day on")
        day = F.col("date")
        rows = clean.select(*features.CLEAN_COLUMNS).where((day >= F.lit(start).cast("date")) & (day <= F.lit(end).cast("date")))
        tail = self.tail(start)
        if any(d >= start for d in _days(self.tails)):
            self.tails.write(tables.empty(self.spark, self.tails.schema), start, None)
        self.features.write(features_after(tail, rows, self.max_rows), start, None)
        self._keep(tails.move_tail(tail, rows, K.SERIES, "date", features.LOOKBACK, features.TIES), end)
        return self.read().where(day >= F.lit(start).cast("date"))

    def _keep(self, tail: DataFrame, end: str | dt.date) -> None:
        self.tails.write(tail.withColumn(AS_OF, F.lit(str(end)).cast("date")), end, end)
        days = _days(self.tails)
        if len(days) > self.keep:
            self.tails.write(tables.empty(self.spark, self.tails.schema), None, days[-self.keep - 1])


def _days(table: snapshots.SliceTable) -> list[str]:
    """The partition values of a table that hold rows, from its log alone."""
    live = {folder.split("=", 1)[1] for entry in table.state().commits.values() for folder in entry["folders"]}
    return sorted(live)
