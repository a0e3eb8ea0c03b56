"""Fixed values.

These must equal the original programs' values for the results to match;
they are stated here once, in plain form, and referenced everywhere else.
"""

# Great-circle distance and the hotel search.
EARTH_RADIUS_KM = 6371.0
HOTEL_TERM = "hotel"
HOTEL_RADIUS_KM = 10.0

# Input text conventions.
FLIGHT_NULL_TOKEN = "NA"
SOCIAL_LINE = r"^\s*(\d+)\s*\|\s*(\d+)\s*$"   # "<digits> | <digits>", any other line skipped
MALE_TOKEN = "male"
PAID_TOKEN = "yes"

# Temp-view names callers' SQL refers to.
FLIGHT_VIEW = "airtraffic"
CARRIER_VIEW = "carriers"
AIRPORT_VIEW = "airports"

# Flight questions.
SECURITY_CANCELLATION_CODE = "D"
WEATHER_MONTHS = (1, 3)
VEGAS_TO_JFK = ("LAS", "JFK")
MEDIAN_P = 0.5
SCORE_P = 0.95
MOVING_AVERAGE_DAYS = 5
DOMESTIC_COUNTRY = "USA"

# Graph and model.
PAGERANK_RESET = 0.15
PAGERANK_TOL = 1e-6
LOGISTIC_MAX_ITER = 5
SPLIT_WEIGHTS = (0.9, 0.1)
SPLIT_SEED = 10
