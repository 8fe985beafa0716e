"""Declared schemas; nothing on a main path is inferred."""

from pyspark.sql import types as T


_TYPES = {
    "string": T.StringType(),
    "double": T.DoubleType(),
    "int": T.IntegerType(),
    "bigint": T.LongType(),
    "timestamp": T.TimestampType(),
    "date": T.DateType(),
    "map": T.MapType(T.StringType(), T.StringType()),
    "array": T.ArrayType(T.StringType()),
}


def _struct(spec: str) -> T.StructType:
    """``name type`` pairs; DDL text would need a running session at import."""
    pairs = [pair.split() for pair in spec.split(",")]
    return T.StructType([T.StructField(name, _TYPES[kind]) for name, kind in pairs])


TRAINING = _struct(
    "ArrDelay double, Carrier string, DayOfMonth int, DayOfWeek int, DayOfYear int, "
    "DepDelay double, Dest string, Distance double, FlightDate string, FlightNum string, Origin string"
)

REQUEST = _struct(
    "UUID string, Carrier string, Origin string, Dest string, DepDelay double, Distance double, "
    "DayOfMonth int, DayOfWeek int, DayOfYear int, Timestamp string"
)

# The typed variant of the same message: real timestamp and date, plus the
# index columns an upstream encoder may already have filled.
REQUEST_TYPED = _struct(
    "Origin string, FlightNum string, DayOfWeek int, DayOfYear int, DayOfMonth int, Dest string, "
    "DepDelay double, Prediction string, Timestamp timestamp, FlightDate date, Carrier string, "
    "UUID string, Distance double, Carrier_index double, Origin_index double, Dest_index double, "
    "Route_index double"
)

PREDICTION = _struct(
    "UUID string, Prediction double, Origin string, Dest string, Carrier string, "
    "DepDelay double, Timestamp string"
)

STORED_PREDICTION = _struct(
    "uuid string, prediction string, timestamp timestamp, origin string, dest string, "
    "carrier string, dep_delay double"
)

DISTANCE = _struct("Origin string, Dest string, Distance double")

MODEL_REF = _struct(
    "model_name string, model_path string, trained_at string, accuracy double, run_id string"
)

RUN = _struct("run_id string, params map, features array, accuracy double")

VERSION = _struct("name string, version bigint, stage string, run_id string")

# Column roles of the delay model.
CATEGORICAL = ["Carrier", "Origin", "Dest", "Route"]
NUMERIC = ["DepDelay", "Distance", "DayOfMonth", "DayOfWeek", "DayOfYear"]
FEATURES = CATEGORICAL + NUMERIC
LABEL = "ArrDelayBucket"
