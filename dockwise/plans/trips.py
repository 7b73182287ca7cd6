"""Trip pipeline: harmonised trips to station table and yearly rollups."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame

from dockwise.operators.trips import (
    complete_trips,
    stations_of_trips,
    trips_summary_all,
    trips_summary_year,
)
from dockwise.session import settle


def trip_tables(
    trips: DataFrame, stations: DataFrame, years: Sequence[int]
) -> dict[str, DataFrame]:
    """Station table of the trips, and summaries per year and over all years."""
    yearly = settle(trips_summary_year(complete_trips(trips), stations, years))
    return {
        "trip_stations": stations_of_trips(trips),
        "trips_summary_year": yearly,
        "trips_summary": trips_summary_all(yearly, stations.select("station_id", "capacity")),
    }
