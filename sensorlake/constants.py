"""Fixed values that results depend on.

FIXED VALUES (must stay equal to the pipeline being re-expressed; stated
here plainly, in their natural order):
- accepted sensor types for silver (18)
- rejection reasons (3), in precedence order
- junk sensor types rejected from silver
- European country codes used by region assignment (37)
- customer pools per region, and the six seeded customers
- pressure alert threshold in pascals, alert type names
- mapping of JSON measurement keys to silver columns
- partition-marker look-back in hours, profile sample size
"""

ACCEPTED_SENSOR_TYPES = [
    "SDS011", "DHT22", "BME280", "BMP280", "SPS30", "SHT31", "SHT30",
    "PMS5003", "PMS7003", "PMS1003", "SDS021", "HTU21D", "DS18B20",
    "BMP180", "SEN5x", "Radiation Si22G", "Radiation SBM-20", "DNMS (Laerm)",
]

REJECTION_REASONS = ["null_reading_id", "unparseable_ingested_at", "invalid_sensor_type"]

INVALID_SENSOR_TYPES = ["", "test"]

EUROPE_COUNTRIES = [
    "DE", "FR", "IT", "ES", "PL", "NL", "BE", "SE", "AT", "CH",
    "CZ", "HU", "RO", "BG", "HR", "SK", "SI", "PT", "GR", "FI",
    "DK", "NO", "LT", "LV", "EE", "LU", "IE", "GB", "RS", "BA",
    "UA", "BY", "MD", "AL", "MK", "ME", "XK",
]

# Region boxes, inclusive bounds, tested in this order after the Europe list.
NORTH_AMERICA_BOX = {"lon": (-170, -30), "lat": (10, 85)}
ASIA_PACIFIC_BOX = {"lon": (60, 180), "lat": (-15, 75)}

REGION_CUSTOMERS = {
    "Europe": [1, 2],
    "North America": [3, 4],
    "Asia-Pacific": [5],
    "Other": [6],
}

SEED_CUSTOMERS = [
    (1, "AirWatch EU North", "Europe"),
    (2, "AirWatch EU South", "Europe"),
    (3, "ClimaCorp Americas", "North America"),
    (4, "SkyNet Americas", "North America"),
    (5, "AirWatch APAC", "Asia-Pacific"),
    (6, "ClimaCorp Other", "Other"),
]

PRESSURE_THRESHOLD_PA = 130000.0
ALERT_PRESSURE = "pressure_threshold_exceeded"
ALERT_UNREGISTERED = "unregistered_device"

# JSON key in the reading's ``values`` object -> silver column.
METRIC_COLUMNS = {
    "P1": "pm25",
    "P2": "pm10",
    "temperature": "temperature",
    "humidity": "humidity",
    "pressure": "pressure",
    "pressure_at_sealevel": "pressure_at_sealevel",
}

MARKER_LOOKBACK_HOURS = 48
PROFILE_SAMPLE_SIZE = 1000
FEED_WINDOW_ROWS = 30
