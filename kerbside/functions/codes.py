"""Code lists of the road-accident register.

Fixed values: every table below must equal the published register (or the
published preparation rules) for results to be right.  They are data, not logic.
"""

# Raw column -> column used here, one map per raw table.
CIRCUMSTANCES = {
    "Num_Acc": "id_accident", "jour": "day", "mois": "month", "an": "year",
    "hrmn": "hour_minute", "lum": "lighting_condition", "dep": "department_code",
    "com": "commune_code", "agg": "location", "int": "intersection",
    "atm": "weather_condition", "col": "type_of_collision", "adr": "postal_address",
    "lat": "latitude", "long": "longitude",
}
LOCATIONS = {
    "Num_Acc": "id_accident", "catr": "road_category", "voie": "road_number",
    "v1": "road_number_index", "v2": "road_number_letter", "circ": "traffic_regime",
    "nbv": "number_of_traffic_lanes", "vosp": "reserved_lane_present",
    "prof": "longitudinal_profile", "pr": "nearest_reference_marker",
    "pr1": "nearest_reference_marker_distance", "plan": "horizontal_alignment",
    "lartpc": "width_central_reservation", "larrout": "carriageway_width",
    "surf": "pavement_condition", "infra": "infrastructure",
    "situ": "accident_situation", "vma": "speed_limit",
}
VEHICLES = {
    "Num_Acc": "id_accident", "id_vehicule": "id_vehicle", "num_veh": "number_vehicle",
    "senc": "direction_of_travel", "catv": "vehicle_category",
    "obs": "fixed_obstacle_struck", "obsm": "mobile_obstacle_struck",
    "choc": "initial_point_of_impact", "manv": "main_maneuver_before_accident",
    "motor": "motor_type", "occutc": "number_occupants_in_public_transport",
}
USERS = {
    "Num_Acc": "id_accident", "id_usager": "id_user", "id_vehicule": "id_vehicle",
    "num_veh": "number_vehicle", "place": "position", "catu": "user_category",
    "grav": "injury_severity", "sexe": "sex", "an_nais": "year_of_birth",
    "trajet": "trip_purpose", "secu1": "safety_equipment_1",
    "secu2": "safety_equipment_2", "secu3": "safety_equipment_3",
    "locp": "pedestrian_location", "actp": "pedestrian_action",
    "etatp": "injured_pedestrian_alone",
}

# Register vehicle codes -> six classes; any other code is "other".
VEHICLE_CLASSES = {
    "bicycle": [1, 80],
    "powered_2_3_wheeler": [2, 30, 31, 32, 33, 34, 41, 42, 43],
    "light_motor_vehicle": [7, 10],
    "hgv_truck": [13, 14, 15, 16, 17],
    "bus_coach": [37, 38],
}
SIX_CLASSES = ["bicycle", "bus_coach", "hgv_truck", "light_motor_vehicle", "other",
               "powered_2_3_wheeler"]

# Vehicle class -> impact weight used to pick the heaviest opponent; default 1.
OPPONENT_WEIGHTS = {
    "rail_vehicle": 7, "hgv_truck": 6, "bus_coach": 5, "light_motor_vehicle": 4,
    "powered_2_3_wheeler": 3, "bicycle": 2, "other": 1, "unknown": 1,
}
# Vehicle class -> impact score feature; default 1.
IMPACT_WEIGHTS = {
    "hgv_truck": 6, "bus_coach": 5, "light_motor_vehicle": 4, "powered_2_3_wheeler": 3,
    "bicycle": 2, "other": 1, "unknown": 1, "n/a": 0,
}

# Vehicle columns where -1 means "not specified".
VEHICLE_SENTINELS = {
    "vehicle_category": [-1], "main_maneuver_before_accident": [-1],
    "initial_point_of_impact": [-1], "fixed_obstacle_struck": [-1],
    "mobile_obstacle_struck": [-1], "motor_type": [-1], "direction_of_travel": [-1],
    "number_occupants_in_public_transport": [-1],
}
# Vehicle columns that exist twice after the merge, with and without "_other".
MIRRORED = [
    "id_vehicle", "number_vehicle", "direction_of_travel", "vehicle_category",
    "fixed_obstacle_struck", "mobile_obstacle_struck", "initial_point_of_impact",
    "main_maneuver_before_accident", "motor_type", "number_occupants_in_public_transport",
]

# Location completeness score: weight per column that is filled.
LOCATION_SCORE = {
    "road_category": 2, "road_number": 1, "road_number_index": 1, "road_number_letter": 1,
    "traffic_regime": 1, "number_of_traffic_lanes": 1, "reserved_lane_present": 1,
    "longitudinal_profile": 1, "nearest_reference_marker": 1,
    "nearest_reference_marker_distance": 1, "horizontal_alignment": 1,
    "width_central_reservation": 1, "carriageway_width": 1, "pavement_condition": 1,
    "infrastructure": 1, "accident_situation": 1, "speed_limit": 2,
}

# Road complexity weights; codes not listed count 1, lanes are cut at 8.
INTERSECTION_WEIGHTS = {1: 0, 2: 4, 3: 3, 4: 3, 5: 6, 6: 7, 7: 8, 8: 5, 9: 2}
ROAD_CATEGORY_WEIGHTS = {1: 2, 2: 3, 3: 4, 4: 5, 5: 1, 6: 3, 7: 4, 9: 1}
TRAFFIC_REGIME_WEIGHTS = {-1: 1, 1: 1, 2: 4, 3: 2, 4: 6}
MAX_LANES_SCORE = 8

# Ordinal scales; codes not listed count 0.
LIGHTING_SCALE = {1: 0, 5: 1, 2: 2, 3: 3, 4: 3}
WEATHER_SCALE = {1: 0, 8: 1, 2: 2, 7: 2, 6: 3, 3: 3, 5: 4, 4: 4}
# Injury code -> target: 0 uninjured, 1 lightly injured, 2 hospitalised or killed.
TARGET_SCALE = {1: 0, 4: 1, 3: 2, 2: 2}
ROLES = {1: "driver", 2: "passenger", 3: "pedestrian"}

# Safety equipment code -> flag; code 7 stands for gloves and airbag together.
SAFETY_FLAGS = {
    "used_belt": [1], "used_helmet": [2], "used_child_restraint": [3],
    "used_reflective_vest": [4], "used_airbag": [5, 7], "used_gloves": [6, 7],
    "used_other": [9],
}

# Half-open [from, to) cuts.
TIME_OF_DAY = [(0, 6, "Night"), (6, 10, "Morning_Rush"), (10, 16, "Midday"),
               (16, 20, "Evening_Rush"), (20, 24, "Night")]
DAY_PERIOD = [(5, 12, "Morning"), (12, 17, "Afternoon"), (17, 22, "Evening")]
AGE_GROUPS = [(0, 18, "child_teen"), (18, 25, "young_adult"), (25, 40, "adult"),
              (40, 65, "middle_aged"), (65, 100, "senior")]

SPEED_LIMIT_MAX = 130

# Columns that leave the table before modelling.
NOT_FOR_MODEL = [
    "id_accident", "id_vehicle", "id_user", "number_vehicle", "department_code",
    "commune_code", "postal_address", "road_number", "road_number_index",
    "road_number_letter", "id_vehicle_other", "number_vehicle_other",
    "width_central_reservation", "number_occupants_in_public_transport",
    "number_occupants_in_public_transport_other", "nearest_reference_marker_distance",
    "nearest_reference_marker", "year_of_birth", "year", "month", "day", "hour_minute",
    "hour", "minute", "safety_equipment_1", "safety_equipment_2", "safety_equipment_3",
    "vehicle_category", "vehicle_category_other", "number_of_traffic_lanes",
    "intersection", "road_category", "traffic_regime", "pavement_condition",
    "longitudinal_profile", "user_category", "weather_condition", "lighting_condition",
    "injury_severity", "injured_pedestrian_alone", "trip_purpose", "direction_of_travel",
    "direction_of_travel_other", "carriageway_width", "used_other", "used_gloves",
    "used_reflective_vest",
]
# Columns stored as 16-bit integers in the final table.
SMALLINT_COLUMNS = [
    "location", "type_of_collision", "reserved_lane_present", "horizontal_alignment",
    "infrastructure", "accident_situation", "position", "fixed_obstacle_struck",
    "mobile_obstacle_struck", "initial_point_of_impact", "main_maneuver_before_accident",
    "motor_type", "fixed_obstacle_struck_other", "mobile_obstacle_struck_other",
    "initial_point_of_impact_other", "main_maneuver_before_accident_other",
    "motor_type_other", "vehicle_category_involved_bicycle",
    "vehicle_category_involved_bus_coach", "vehicle_category_involved_hgv_truck",
    "vehicle_category_involved_light_motor_vehicle", "vehicle_category_involved_other",
    "vehicle_category_involved_powered_2_3_wheeler", "used_belt", "used_helmet",
    "used_child_restraint", "used_airbag", "impact_score", "impact_score_other",
    "impact_delta", "surface_quality_indicator", "lighting_ordinal", "weather_ordinal",
    "injury_target", "sex", "day_of_week", "speed_limit", "age", "cluster",
]

# Columns for clustering: measured as numbers (plain and ordinal); the rest are categories.
CLUSTER_NUMERIC = [
    "latitude", "longitude", "speed_limit", "age", "hour_sin", "hour_cos",
    "day_of_week_sin", "day_of_week_cos", "month_sin", "month_cos", "day_of_year_sin",
    "day_of_year_cos",
]
CLUSTER_ORDINAL = ["lighting_ordinal", "weather_ordinal", "road_complexity_index",
                   "impact_score", "impact_score_other", "impact_delta"]

# Model preparation.
MODEL_DROPS = [
    "latitude", "longitude", "pedestrian_location", "pedestrian_action", "hour_sin",
    "hour_cos", "day_of_week_sin", "day_of_week_cos", "month_sin", "month_cos",
    "day_of_year_sin", "day_of_year_cos", "age",
]
MINUS_ONE_HAS_MEANING = [
    "fixed_obstacle_struck", "mobile_obstacle_struck", "initial_point_of_impact",
    "main_maneuver_before_accident", "motor_type", "fixed_obstacle_struck_other",
    "mobile_obstacle_struck_other", "initial_point_of_impact_other",
    "main_maneuver_before_accident_other", "motor_type_other", "sex",
    "vehicle_category_simplified", "vehicle_category_simplified_other",
]
ORDERED_DOMAINS = {
    "time_of_day": ["Morning_Rush", "Midday", "Evening_Rush", "Night"],
    "day_of_week": [0, 1, 2, 3, 4, 5, 6],
    "age_group": ["Unknown", "child_teen", "young_adult", "adult", "middle_aged", "senior"],
    "lighting_ordinal": [0, 1, 2, 3],
    "weather_ordinal": [0, 1, 2, 3, 4],
    "injury_target": [0, 1, 2],
}

# Scoring: divisor that brings a report field to 0..1, and the risk label per class.
RISK_FACTORS = {
    "Speed Limit": ("speed_limit", 130.0), "Road Complexity": ("road_complexity_index", 10.0),
    "Weather Severity": ("weather_ordinal", 4.0), "Lighting Conditions": ("lighting_ordinal", 3.0),
}
RISK_LABELS = {0: "LOW RISK", 1: "MEDIUM RISK", 2: "HIGH RISK"}

# Readable labels of register codes.
CODEBOOKS = {
    "injury_severity": {-1: "not specified", 1: "uninjured", 2: "killed",
                        3: "hospitalised", 4: "lightly injured"},
    "road_category": {1: "motorway", 2: "national road", 3: "departmental road",
                      4: "communal way", 5: "off public network", 6: "public parking lot",
                      7: "urban metropolis road", 9: "other"},
    "traffic_regime": {-1: "not specified", 1: "one way", 2: "two way",
                       3: "separated carriageways", 4: "variable lanes"},
    "reserved_lane_present": {-1: "not specified", 0: "none", 1: "cycle path",
                              2: "cycle lane", 3: "reserved lane"},
    "longitudinal_profile": {-1: "not specified", 1: "flat", 2: "slope", 3: "hilltop",
                             4: "bottom of slope"},
    "horizontal_alignment": {-1: "not specified", 1: "straight", 2: "left curve",
                             3: "right curve", 4: "S curve"},
    "lighting_condition": {-1: "not specified", 1: "full day", 2: "twilight or dawn",
                           3: "night without lighting", 4: "night, lighting off",
                           5: "night, lighting on"},
    "user_category": {1: "driver", 2: "passenger", 3: "pedestrian"},
    "sex": {-1: "not specified", 1: "male", 2: "female"},
}
