"""Domain constants.

FIXED VALUES — these must equal the values the original incident pipeline uses,
otherwise labels, features and plans differ. They are listed plainly, in their
natural order, and nothing else in the package re-encodes them.
"""

from __future__ import annotations

# ---- FIXED VALUES: class labels and resource tables -------------------------
SEVERITY_LABELS = {0: "Low", 1: "Moderate", 2: "High", 3: "Severe"}
MANPOWER_OFFICERS = {0: 2, 1: 4, 2: 8, 3: 12, 4: 20}
BARRICADE_UNITS = {0: 0, 1: 2, 2: 5, 3: 10}
BARRICADE_LABELS = {0: "None", 1: "Light", 2: "Medium", 3: "Heavy"}
DIVERSION_LABELS = {0: "No Diversion", 1: "Diversion Required"}

# ---- FIXED VALUES: event cause -> base severity score (17 spellings) --------
CAUSE_SEVERITY = {
    "vehicle_breakdown": 1,
    "pot_holes": 1,
    "others": 0,
    "road_conditions": 0,
    "Debris": 1,
    "debris": 1,
    "Fog / Low Visibility": 1,
    "tree_fall": 1,
    "water_logging": 1,
    "construction": 2,
    "accident": 2,
    "public_event": 2,
    "vip_movement": 2,
    "congestion": 2,
    "procession": 2,
    "protest": 2,
    "test_demo": 0,
}

# ---- FIXED VALUES: causes that call for a diversion when high priority ------
DIVERSION_CAUSES = ["congestion", "construction", "vip_movement", "procession", "protest", "public_event", "accident"]

# ---- FIXED VALUES: geography and clock --------------------------------------
CITY_LAT = 12.9716
CITY_LON = 77.5946
EARTH_RADIUS_KM = 6371.0
MORNING_PEAK_HOURS = [7, 8, 9, 10]
EVENING_PEAK_HOURS = [17, 18, 19, 20, 21]
NIGHT_HOURS = [22, 23, 0, 1, 2, 3, 4, 5]

# ---- FIXED VALUES: severity score bins, right-closed ------------------------
# (-0.1, 0.9] -> 0, (0.9, 1.9] -> 1, (1.9, 2.9] -> 2, (2.9, 10] -> 3
SEVERITY_BIN_EDGES = [-0.1, 0.9, 1.9, 2.9, 10.0]
LONG_EVENT_MINUTES = 120
DRIFT_ACCURACY_FLOOR = 0.70
FALLBACK_DURATION_MIN = 180.0
FALLBACK_SEVERITY_CONFIDENCE = 60.0
FALLBACK_CLASS_CONFIDENCE = 70.0

# ---- FIXED VALUES: datetime columns, dropped metadata columns ---------------
DATETIME_COLUMNS = ["start_datetime", "end_datetime", "closed_datetime", "resolved_datetime", "modified_datetime", "created_date"]
DROP_COLUMNS = [
    "map_file", "comment", "meta_data", "direction", "route_path", "citizen_accident_id",
    "assigned_to_police_id", "resolved_by_id", "closed_by_id", "last_modified_by_id",
    "created_by_id", "id", "description", "resolved_at_address", "gba_identifier",
    "cargo_material", "age_of_truck",
]
# Constant fills applied during cleaning.
CATEGORICAL_FILLS = {
    "corridor": "Unknown",
    "veh_type": "Unknown",
    "veh_no": "Unknown",
    "reason_breakdown": "None",
    "kgid": "Unknown",
    "junction": "None",
}
MEDIAN_FILL_COORDS = ["endlatitude", "endlongitude", "resolved_at_latitude", "resolved_at_longitude"]
LABEL_ENCODED = ["zone", "police_station", "corridor", "event_cause", "veh_type"]

# ---- FIXED VALUES: targets and the ordered 51-column feature vector ---------
TARGET_COLUMNS = ["congestion_severity", "duration_min", "manpower_req", "barricade_req", "diversion_req"]
CLASS_TARGETS = ["congestion_severity", "manpower_req", "barricade_req", "diversion_req"]
FEATURE_COLUMNS = [
    # time
    "hour", "minute", "day", "weekday", "month", "week_of_year",
    "is_weekend", "is_peak", "is_night", "is_morning_peak", "is_evening_peak",
    "time_since_midnight", "hour_sin", "hour_cos",
    "weekday_sin", "weekday_cos", "month_sin", "month_cos",
    # spatial
    "latitude", "longitude",
    "dist_from_center_km", "spatial_cluster", "cluster_density", "has_junction",
    # categorical
    "zone_enc", "police_station_enc", "corridor_enc",
    "event_cause_enc", "veh_type_enc",
    "event_type_enc", "priority_enc", "road_closure_enc",
    "has_veh_no", "authenticated_enc",
    "corridor_freq", "cause_target_enc",
    # history
    "zone_events_1d", "zone_events_7d", "zone_events_30d",
    "prev_severity_zone", "zone_mean_severity",
    "cause_zone_avg_dur", "station_avg_dur",
    # interactions
    "cause_x_peak", "cause_x_weekend", "zone_x_priority",
    "dist_x_priority", "cluster_x_cause", "hour_x_event_type",
    "closure_x_priority", "sev_x_cluster",
]

# ---- FIXED VALUES: serving table columns (order of the published table) -----
SERVING_COLUMNS = [
    "start_datetime", "event_cause", "event_type", "priority", "zone", "police_station",
    "requires_road_closure", "latitude", "longitude", "congestion_severity", "duration_min",
    "manpower_req", "barricade_req", "diversion_req", "status",
]

# ---- FIXED VALUES: dashboard limits ------------------------------------------
TOP_CAUSES = 14
HISTOGRAM_BUCKET_MIN = 30
HISTOGRAM_CAP_MIN = 1440
HISTORY_PAGE = 500
MAP_POINTS = 1000
TOP_IMPORTANCES = 20
