"""The data model: column names, labels, thresholds and schemas."""

from __future__ import annotations

from pyspark.sql import types as T

# --- Fixed values: names that appear in the input files and in the reports ---------

MONTH_NAMES = (
    "January", "February", "March", "April", "May", "June",
    "July", "August", "September", "October", "November", "December",
)

CANCELLATION_REASONS = {"A": "Carrier", "B": "Weather", "C": "NAS", "D": "Security"}
NO_REASON = "Not Cancelled"

DELAY_CAUSES = {
    "carrier_delay": "Delay_Carrier",
    "weather_delay": "Delay_Weather",
    "nas_delay": "Delay_NAS",
    "security_delay": "Delay_Security",
    "late_aircraft_delay": "Delay_LateAircraft",
}
CANCELLATION_PREFIX = "Canc_"

# Minutes of departure delay: below 15 is low, 15 to 60 is medium, above 60 is high.
LOW_BELOW = 15
HIGH_ABOVE = 60
BAND_NAMES = ("low", "medium", "high")

MANDATORY = ("month", "op_unique_carrier", "origin", "cancelled", "diverted")

SUBSET_SIZES = {"500k": 500_000, "1M": 1_000_000, "3M": 3_000_000, "5M": 5_000_000}
SUBSET_SEED = 42

# -----------------------------------------------------------------------------------

FLIGHTS_RAW = T.StructType(
    [
        T.StructField("month", T.IntegerType()),
        T.StructField("op_unique_carrier", T.StringType()),
        T.StructField("origin", T.StringType()),
        T.StructField("dep_delay", T.DoubleType()),
        T.StructField("arr_delay", T.DoubleType()),
        T.StructField("cancelled", T.IntegerType()),
        T.StructField("cancellation_code", T.StringType()),
        T.StructField("diverted", T.IntegerType()),
        *(T.StructField(name, T.DoubleType()) for name in DELAY_CAUSES),
    ]
)

FLIGHTS = T.StructType(
    [field for field in FLIGHTS_RAW if field.name != "diverted"]
    + [T.StructField("cancellation_reason", T.StringType())]
)

# The columns each report reads, for scans that should not parse anything else.
CARRIER_REPORT_COLUMNS = ("month", "op_unique_carrier", "origin", "arr_delay", "cancelled")
AIRPORT_REPORT_COLUMNS = (
    "month", "origin", "dep_delay", "arr_delay", "cancelled",
    *DELAY_CAUSES, "cancellation_reason",
)

# All cause labels, in the order that breaks ties between equal counts.
CAUSE_LABELS = (
    *DELAY_CAUSES.values(),
    *(CANCELLATION_PREFIX + reason for reason in CANCELLATION_REASONS.values()),
)


def subset_of(schema: T.StructType, columns) -> T.StructType:
    """The fields of ``schema`` named in ``columns``, in schema order."""
    wanted = set(columns)
    unknown = wanted - set(schema.names)
    if unknown:
        raise ValueError(f"not in the schema: {sorted(unknown)}")
    return T.StructType([field for field in schema if field.name in wanted])
