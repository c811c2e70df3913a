"""Fixed values that must equal the source project's for identical results.

FIXED VALUES — decode labels, bin edges, name patterns, unit factors and
code tables are stated here as plain text, in the order they apply.
"""

# ---- FIXED VALUES: unit conversions -------------------------------------
SQ_METERS_PER_ACRE = 4046.8564224
SQ_METERS_PER_SQ_MILE = 2589988.11
LB_PER_TON = 2000.0
SECONDS_PER_DAY = 86400.0
CUBIC_FEET_PER_ACRE_FOOT = 43560.0
EARTH_RADIUS_M = 6371008.8          # mean earth radius for spherical formulas
NULL_KEY_PLACEHOLDER = "_dbt_utils_surrogate_key_null_"
KEY_SEPARATOR = "-"

# ---- FIXED VALUES: code -> label decodes ---------------------------------
# (code, label) pairs; ``default`` is used when no code matches (None = NULL).
PLOT_STATUS = ([(1, "Sampled - forest"), (2, "Sampled - nonforest"), (3, "Nonsampled")], "Unknown")
CONDITION_STATUS = ([(1, "Forest"), (2, "Nonforest"), (3, "Water"), (4, "Census water"),
                     (5, "Nonsampled")], "Unknown")
OWNER_GROUP = ([(10, "Forest Service"), (20, "Other federal"), (30, "State and local government"),
                (40, "Private")], "Unknown")
TREE_STATUS = ([(0, "No status"), (1, "Live"), (2, "Dead"), (3, "Removed")], "Unknown")
CROWN_CLASS = ([(1, "Open grown"), (2, "Dominant"), (3, "Co-dominant"), (4, "Intermediate"),
                (5, "Overtopped")], None)
WOOD_TYPE = ([("S", "Softwood"), ("H", "Hardwood")], None)

# ---- FIXED VALUES: ordered threshold bins (value < bound -> label) --------
# The last label is the ``else`` branch; NULL falls to it unless null_label given.
ELEVATION_BANDS = ([(1000, "Lowland (<1000 ft)"), (3000, "Montane (1000-3000 ft)"),
                    (5000, "Upper montane (3000-5000 ft)")], "Subalpine (>5000 ft)")
DIAMETER_CLASSES = ([(5, "1-5 in"), (10, "5-10 in"), (15, "10-15 in"), (20, "15-20 in"),
                     (30, "20-30 in"), (40, "30-40 in")], "40+ in")
STAND_STAGES = ([(20, "Regeneration (<20 yr)"), (40, "Young (20-40 yr)"), (80, "Mature (40-80 yr)"),
                 (150, "Late (80-150 yr)")], "Old growth (150+ yr)")
STAND_STAGE_NULL = "Unknown"
# fire size classes use value >= bound, largest first
FIRE_SIZE_CLASSES = ([(100000, "Megafire (100k+ ac)"), (10000, "Large (10k-100k ac)"),
                      (1000, "Moderate (1k-10k ac)"), (100, "Small (100-1k ac)")], "Minor (<100 ac)")

# ---- FIXED VALUES: first-match name patterns (case-insensitive contains) --
RIVER_PATTERNS = ([("MERCED", "Merced"), ("TUOLUMNE", "Tuolumne"), ("STANISLAUS", "Stanislaus"),
                   ("CHERRY", "Tuolumne"), ("ELEANOR", "Tuolumne"), ("BIG C", "Tuolumne")], "Other")

# ---- FIXED VALUES: payload keys of the raw envelopes (output column -> key) --
WQP_RESULT_KEYS = {"lake_id": "_alpine_lake_id", "station_id": "MonitoringLocationIdentifier",
                   "sample_date": "ActivityStartDate", "characteristic": "CharacteristicName",
                   "result_value": "ResultMeasureValue", "detection_condition": "ResultDetectionConditionText"}
WQP_UNIT_KEYS = ["ResultMeasure/MeasureUnitCode", "MeasureUnitCode"]
WQP_STATION_KEYS = {"station_id": "MonitoringLocationIdentifier", "station_name": "MonitoringLocationName",
                    "latitude": "LatitudeMeasure", "longitude": "LongitudeMeasure", "huc8": "HUCEightDigitCode",
                    "organization_id": "OrganizationIdentifier"}

# ---- FIXED VALUES: USGS parameter code -> unit ---------------------------
PARAMETER_UNITS = {"00060": "cfs", "00065": "ft", "00010": "degC"}

# ---- FIXED VALUES: model parameters --------------------------------------
LOOKBACK_DAYS = {"lake_measurements": 3, "streamflow": 7, "daily_flow": 14}
MIN_DAYS_OF_RECORD = 300
GROWTH_MIN_TREES = 50
MORTALITY_MIN_TREES = 200
GROWTH_INTERVAL_YEARS = (5, 15)
GROWTH_DIAMETER_RANGE = (-1, 15)
FIRE_YEAR_RANGE = (1900, 2026)
FIRE_JOIN_MIN_YEAR = 1980
SAWTIMBER_MIN_DIAMETER_IN = 12
CHLOROPHYLL_RANGE = (0, 500)
BASIN_AREA_TOLERANCE = 0.25
FRESHNESS_WARN_DAYS = 4
FRESHNESS_ERROR_DAYS = 8
GAGE_POINT = ("12082500", "Nisqually River near National, WA", -122.0825, 46.7528)
LONG_RECORD_MIN_DAYS = 3650
