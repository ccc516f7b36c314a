"""Fixed values.

FIXED VALUES: these constants must equal the ones of the original sensor ETL
so that results match (error code, file name patterns, box list, calibration
coefficients, compass and wind-speed labels).  They are stated here once, in
their natural order, and every other module imports them from this file.
"""

# -- FIXED VALUES ------------------------------------------------------------

# Error code written by the acquisition boxes instead of a measure.
SENTINEL = 61440.0

# Timestamp format of the first column of an .acq file.
ACQ_TIMESTAMP_FORMAT = "dd/MM/yyyy HH:mm"
# Date format inside file names ("... le dd MM yyyy.acq").
FILE_DATE_FORMAT = "dd MM yyyy"

# Boxes whose files are household (logement) readings.
HOUSEHOLD_BOXES = ("162", "093", "088", "182", "177", "223")

# File name patterns (date part generalised to any dd MM yyyy).
FILE_DATE_PATTERN = r"\d{2} \d{2} \d{4}"
STATION_PREFIX = "Station météo"
CAISSON_PREFIX = "caisson"
# Box id: last word before " le <date>.acq".
BOX_PATTERN = r"(\S+) le (\d{2} \d{2} \d{4})\.acq$"

# Sensor types and rooms used by the formulas.
TYPE_AIR_INLET = "EA"
TYPE_EXTRACT_VENT = "Bouche"
TYPE_STATION = "Station"
ROOM_WC = "WC"

# Temperature: 0.01 * raw - fct1
TEMP_SCALE = 0.01
# Relative humidity: (t - 25) * (0.01 + 0.00008 b) + 0.0405 b - 0.0000028 b^2 - 4
HR_T_REF = 25.0
HR_A = 0.01
HR_B = 0.00008
HR_C = 0.0405
HR_D = -0.0000028
HR_E = 4.0
# Raw counts are on a 10-bit scale.
RAW_FULL_SCALE = 1023.0
# Flow position 1: raw / 1023 * 2.5 - fct1
FLOW_POSITION_SPAN = 2.5
# Flow pressure 1: raw / 1023 * 4.5
FLOW_PRESSURE_SPAN = 4.5
# CO2: raw * 2000 / 818
CO2_NUM = 2000.0
CO2_DEN = 818.0
# Absolute humidity: hr / 100 * exp(18.8161 - 4110.34 / (t + 235))
AH_A = 18.8161
AH_B = 4110.34
AH_C = 235.0
# Wind direction: round(raw / 1023 * 360), 360 -> 0
FULL_CIRCLE = 360.0
# Wind speed: raw / 1023 * 2.1 * 207.5 / 2.1 + 2.5
WIND_GAIN = 2.1
WIND_SPAN = 207.5
WIND_OFFSET = 2.5
# Fan box: power 1.1122 b - 5.4133, pressure 0.7177 b - 43.485
FAN_POWER_A = 1.1122
FAN_POWER_B = 5.4133
FAN_PRESSURE_A = 0.7177
FAN_PRESSURE_B = 43.485

# 8-point compass: (label, lower bound inclusive, upper bound exclusive), checked
# after "Nord" (<= 22.5 or > 337.5).
COMPASS_NORTH = "Nord"
COMPASS_NORTH_LOW = 22.5
COMPASS_NORTH_HIGH = 337.5
COMPASS_SECTORS = (
    ("Nord Est", 22.5, 67.5),
    ("Est", 67.5, 112.5),
    ("Sud Est", 112.5, 157.5),
    ("Sud", 157.5, 202.5),
    ("Sud Ouest", 202.5, 247.5),
    ("Ouest", 247.5, 292.5),
    ("Nord Ouest", 292.5, 337.5),
)
COMPASS_NONE = ""

# Wind speed classes: (upper bound exclusive, label); last label otherwise.
WIND_CLASSES = (
    (0.5, "<0.5 m/s"),
    (2.0, "0.5-2 m/s"),
    (4.0, "2-4 m/s"),
    (6.0, "4-6 m/s"),
    (8.0, "6-8 m/s"),
    (10.0, "8-10 m/s"),
)
WIND_CLASS_TOP = ">10 m/s"

# -- end of fixed values -----------------------------------------------------
