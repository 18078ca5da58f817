"""Default parameters of the engine."""

from __future__ import annotations

import datetime as dt

# These must equal the published defaults for results to agree.
WEEKDAYS = ("monday", "tuesday", "wednesday", "thursday", "friday", "saturday", "sunday")
BUSINESS_DAYS = WEEKDAYS[:5]
TIME_ZONE = "Europe/Zurich"
SUNDAY_INDEX = 1
SATURDAY_INDEX = 7
MIN_DEPARTURE_HOUR = 7
MAX_ARRIVAL_HOUR = 20
VALID_YEARS = (2022, 2023, 2024)
INFERENCE_PERIOD = (dt.date(2022, 1, 1), dt.date(2024, 12, 31))
TRAINING_PERIOD = (dt.date(2022, 1, 1), dt.date(2024, 3, 31))
VALIDATION_PERIOD = (dt.date(2024, 4, 1), dt.date(2024, 12, 31))
STATION_ID_LENGTH = 7
TRANSFER_TIME_S = 120
WALKING_SPEED_MPS = 50 / 60
RAIN_THRESHOLD = 2.5
LOW_TEMPERATURE = 6
MEDIUM_TEMPERATURE = 14
MIN_SAMPLES = 30
EXACT_SAMPLES = 10_000
PERCENTILE_ACCURACY = 1000
#: Size of the mergeable quantile sketches: ranks within about 0.0007 of the sample, exact for samples up to this size.
SKETCH_SIZE = 8192
#: What a sketched percentile's rank may be off, as a share of the sample.
RANK_ERROR = 0.001
FALLBACK_RATE = 1.6
GROUP_COLUMNS = ("stop_id", "hour", "rain", "temperature")
VALUE_COLUMN = "delay"
MAX_DELAY_S = 1800
ACCEPTED_ARRIVAL_STATUS = ("REAL", "GESCHAETZT", "PROGNOSE")
EXCLUDED_PRODUCTS = ("Taxi", "Schiff", "")
BUS_PRODUCTS = ("WM-BUS", "BUS", "Bus")
TRAIN_PRODUCTS = ("Zug", "Zahnradbahn", "Standseilbahn", "CS")
METRO_PRODUCTS = ("Tram", "Metro", "Stadtbahn")
SHAPE_LEVEL = "district"
WALKING = "walking"

# Own choices.
EARTH_RADIUS_M = 6371008.0
DAY_S = 86400
SEQUENCE_CHUNK = 512
KS_TERMS = 100
