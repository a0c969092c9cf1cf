"""Explicit schemas of every record the package reads or writes.

Pickup times are local wall-clock times, so ``dt`` is TIMESTAMP_NTZ: hour-of-day
reports must not change with the session time zone.
"""

from pyspark.sql import types as T

# Fixed: names, types and order of the trip records, and the catalog below, are the wire contract.
TRIP = T.StructType(
    [
        T.StructField("dt", T.TimestampNTZType()),
        T.StructField("lat", T.DoubleType()),
        T.StructField("lon", T.DoubleType()),
        T.StructField("base", T.StringType()),
    ]
)

TRIP_CLUSTERED = T.StructType(
    [
        T.StructField("dt", T.TimestampNTZType()),
        T.StructField("lat", T.DoubleType()),
        T.StructField("lon", T.DoubleType()),
        T.StructField("cid", T.IntegerType()),
        T.StructField("base", T.StringType()),
    ]
)

TRIP_ENRICHED = T.StructType(
    [
        T.StructField("dt", T.TimestampNTZType()),
        T.StructField("lat", T.DoubleType()),
        T.StructField("lon", T.DoubleType()),
        T.StructField("cid", T.IntegerType()),
        T.StructField("clat", T.DoubleType()),
        T.StructField("clon", T.DoubleType()),
        T.StructField("base", T.StringType()),
    ]
)

# Field order of an enriched message: the join key comes first.
ENRICHED_WIRE_ORDER = ("cid", "dt", "lat", "lon", "base", "clat", "clon")

CENTER = T.StructType(
    [
        T.StructField("cid", T.IntegerType()),
        T.StructField("clat", T.DoubleType()),
        T.StructField("clon", T.DoubleType()),
    ]
)

# Row of the keyed trip table; ``version`` is the position of the message that wrote it.
KV_ROW = T.StructType(
    [
        T.StructField("rowkey", T.StringType()),
        T.StructField("lat", T.DoubleType()),
        T.StructField("lon", T.DoubleType()),
        T.StructField("version", T.DecimalType(38, 0)),
    ]
)

# JSON catalog of the keyed trip table: logical name -> family, column, type.
TRIP_CATALOG = """{
  "table": {"namespace": "default", "name": "trips"},
  "rowkey": "key",
  "columns": {
    "key": {"cf": "rowkey", "col": "key", "type": "string"},
    "lat": {"cf": "data", "col": "lat", "type": "double"},
    "lon": {"cf": "data", "col": "lon", "type": "double"}
  }
}"""


def conform(df, schema):
    """Select and cast ``df`` to ``schema`` by column name."""
    return df.select(*[df[f.name].cast(f.dataType).alias(f.name) for f in schema])
