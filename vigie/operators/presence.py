"""Cohort reports from a stored state: in which surveys a parcel of a zone was seen.

The state has one row for each (zone, parcel) with a mask, one bit for each survey year. Masks are merged with ``bit_or``, so a new
survey is merged in without the detections of the earlier ones, in any order and as often as one likes. The reports of
``cohort`` (C3–C9) take a state in the place of the detections.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from vigie.operators.cohort import BASE_YEAR, LAST_YEAR, MASK, PARCEL, YEAR, ZONE, survey_bit
from vigie.sources.named import NamedTables, Table

COLUMNS = f"{ZONE} bigint, {PARCEL} string, {MASK} bigint"


def _bit_of(year: Column) -> Column:
    inside = year.between(BASE_YEAR, LAST_YEAR)
    message = F.concat(F.lit(f"survey years lie between {BASE_YEAR} and {LAST_YEAR}, not "), year.cast("string"))
    return F.when(inside, F.call_function("shiftleft", F.lit(1).cast("long"), (year - BASE_YEAR).cast("int"))).otherwise(F.raise_error(message).cast("long"))


def presence_state(det: DataFrame) -> DataFrame:
    """State of the detections ``det`` (geozone_id, batch_year, id_parcellaire). Rows without a year are of no survey; rows without a
    parcel keep their zone's row (parcel NULL), which tells an empty survey from none."""
    rows = det.where(F.col(YEAR).isNotNull()).select(F.col(ZONE).cast("long").alias(ZONE), PARCEL, _bit_of(F.col(YEAR)).alias(MASK))
    return rows.groupBy(ZONE, PARCEL).agg(F.bit_or(MASK).alias(MASK))


def merged(*states: DataFrame) -> DataFrame:
    return reduce(DataFrame.unionByName, states).groupBy(ZONE, PARCEL).agg(F.bit_or(MASK).alias(MASK))


def without_survey(state: DataFrame, year: int) -> DataFrame:
    """``state`` as if the survey had never been."""
    left = F.col(MASK).bitwiseAND(F.lit(~survey_bit(year)).cast("long"))
    return state.withColumn(MASK, left).where(F.col(MASK) != 0)


class PresenceStore:
    """The state as a named table."""

    def __init__(self, tables: NamedTables, name: str = "survey_presence"):
        self.tables, self.name = tables, name

    def create(self) -> Table:
        return self.tables.create(self.name, COLUMNS, if_not_exists=True)

    def read(self) -> DataFrame:
        return self.tables.read(self.name)

    def add(self, det: DataFrame) -> Table:
        """Merge the detections of one or more surveys in; reads the state and ``det`` only."""
        return self.tables.refresh(self.name, merged(self.read(), presence_state(det)))

    def replace_survey(self, year: int, det: DataFrame) -> Table:
        """Put the detections ``det``, all of ``year``, in the place of that survey."""
        fresh = presence_state(det.where(F.col(YEAR) == year))
        return self.tables.refresh(self.name, merged(without_survey(self.read(), year), fresh))
