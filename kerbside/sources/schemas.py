"""Declared schemas of the raw tables: everything dirty is read as text."""

from pyspark.sql import types as T

from kerbside.functions import codes

RENAMES = {"circumstances": codes.CIRCUMSTANCES, "locations": codes.LOCATIONS,
           "vehicles": codes.VEHICLES, "users": codes.USERS}
# Raw file prefix per table.
FILE_PREFIX = {"circumstances": "characteristics", "locations": "locations",
               "vehicles": "vehicles", "users": "users"}


def raw_schema(columns: list[str]) -> T.StructType:
    return T.StructType([T.StructField(c, T.StringType()) for c in columns])


# Type of each column after cleaning; columns not named stay text.
LONGS = ["id_accident", "id_vehicle"]
DOUBLES = ["latitude", "longitude", "nearest_reference_marker",
           "nearest_reference_marker_distance", "number_of_traffic_lanes"]
TEXTS = ["hour_minute", "department_code", "commune_code", "postal_address", "road_number",
         "road_number_index", "road_number_letter", "number_vehicle", "id_user",
         "pedestrian_action", "width_central_reservation", "carriageway_width"]
