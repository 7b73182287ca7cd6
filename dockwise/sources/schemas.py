"""Explicit schemas of the raw feeds. Nothing is inferred."""

from __future__ import annotations

# Columns of the raw feeds, in file order where the file has one.
TURNSTILE_RAW = {
    "C/A": "controlarea",
    "UNIT": "remoteunit",
    "SCP": "subunit_channel_position",
    "STATION": "station",
    "LINENAME": "linenames",
    "DIVISION": "division",
    "DATE": "date",
    "TIME": "time",
    "DESC": "description",
    "ENTRIES": "entries",
    "EXITS": "exits",
}
TURNSTILE_REQUIRED = (
    "id",
    "unit_id",
    "controlarea",
    "remoteunit",
    "subunit_channel_position",
    "station",
    "linenames",
    "division",
    "date",
    "time",
    "observed_at",
    "description",
    "entries",
    "exits",
    "filename",
)
LOOKUP = (
    "remote string, booth string, complex_id string, "
    "station string, line_name string, division string"
)
STATION_INFO = (
    "data struct<stations: array<struct<"
    "station_id: string, legacy_id: string, external_id: string, lon: double, lat: double, "
    "name: string, short_name: string, station_type: string, capacity: int, "
    "eightd_has_key_dispenser: boolean, rental_methods: array<string>, has_kiosk: boolean, "
    "electric_bike_surcharge_waiver: boolean, region_id: string>>>"
)
VALET = (
    "struct<valet_revision: string, active: boolean, off_dock_count: int, "
    "off_dock_capacity: int, dock_blocked_count: int>"
)
STATION_STATUS = (
    "data struct<stations: array<struct<"
    "station_id: string, legacy_id: string, is_installed: int, is_renting: int, "
    "is_returning: int, num_bikes_available: int, num_bikes_disabled: int, "
    "num_docks_available: int, num_docks_disabled: int, num_ebikes_available: int, "
    "num_scooters_available: int, num_scooters_unavailable: int, "
    "eightd_has_available_keys: boolean, eightd_active_station_services: array<string>, "
    f"station_status: string, last_reported: long, valet: {VALET}>>>"
)
STATUS_REQUIRED = (
    "station_id",
    "legacy_id",
    "is_installed",
    "eightd_has_available_keys",
    "is_returning",
    "is_renting",
    "capture_datetime",
    "reported_datetime",
)
STATUS_FLAGS = ("is_installed", "eightd_has_available_keys", "is_returning", "is_renting", "stale")
RENTAL_FLAGS = {"KEY": "rental_method_key", "CREDITCARD": "rental_method_credit"}
OLD_TRIP_FILE = (
    "starttime",
    "stoptime",
    "start station id",
    "start station name",
    "start station latitude",
    "start station longitude",
    "end station id",
    "end station name",
    "end station latitude",
    "end station longitude",
)
NEW_TRIP_FILE = (
    "rideable_type",
    "started_at",
    "ended_at",
    "start_station_name",
    "start_station_id",
    "end_station_name",
    "end_station_id",
    "start_lat",
    "start_lng",
    "end_lat",
    "end_lng",
    "member_casual",
)
CRASH_PROPERTIES = (
    "zip_code string, crash_date string, number_of_cyclist_killed string, "
    "number_of_cyclist_injured string, latitude string, longitude string, borough string"
)
CRASH_NUMBERS = {
    "number_of_cyclist_killed": "double",
    "number_of_cyclist_injured": "double",
    "latitude": "double",
    "longitude": "double",
}
POPULATION_VARIABLE = "B01003_001E"
