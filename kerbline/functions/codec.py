"""Message codecs as column expressions.

Decoders never fail a task. They return the decoded fields plus ``_corrupt``,
which holds the raw message when it could not be decoded and is null otherwise.
"""

from pyspark.sql import functions as F

from kerbline.schemas import ENRICHED_WIRE_ORDER, TRIP

CORRUPT = "_corrupt"
PERMISSIVE = {"mode": "PERMISSIVE", "columnNameOfCorruptRecord": CORRUPT}


def _ddl(schema):
    return ", ".join(f"{f.name} {f.dataType.simpleString()}" for f in schema)


def _unpack(df, record, *keep):
    """The fields of a decoded record as columns.

    A generator is used because a later filter on the fields would be pushed below
    a plain projection, which would parse every message twice.
    """
    return df.select(*keep, F.inline(F.array(record)))


def finite(name):
    """The number is there and neither NaN nor infinite."""
    column = F.col(name)
    return F.coalesce(~F.isnan(column) & (F.abs(column) < float("inf")), F.lit(False))


def decode_csv(messages, value="value", strict=False):
    """Decode ``dt,lat,lon,base`` lines into the TRIP columns plus ``_corrupt``.

    Fields after the fourth are ignored. A line is corrupt when the time or a
    coordinate cannot be read, when a coordinate is not finite, or when fields are
    missing. ``strict`` raises on such a line instead.
    """
    raw = F.col(value)
    record = F.from_csv(raw, f"{_ddl(TRIP)}, {CORRUPT} string", PERMISSIVE)
    unreadable = (
        F.col("dt").isNull()
        | ~finite("lat")
        | ~finite("lon")
        | (F.col(CORRUPT).isNotNull() & (F.size(F.split(raw, ",")) < len(TRIP)))
    )
    corrupt = F.when(unreadable, raw)
    if strict:
        message = F.concat(F.lit("malformed trip line: "), raw)
        corrupt = F.when(unreadable, F.raise_error(message)).cast("string")
    kept = [c for c in messages.columns if c != value]
    return _unpack(messages, record, *messages.columns).select(
        *kept, *TRIP.names, corrupt.alias(CORRUPT)
    )


def decode_json(messages, schema, value="value", strict=False, required=()):
    """Decode JSON messages by field name; unknown fields are ignored.

    A message is corrupt when it cannot be parsed, holds none of the fields, lacks a ``required`` one, or has a number
    that is not finite. ``strict`` raises on such a message instead.
    """
    raw = F.col(value)
    record = F.from_json(raw, f"{_ddl(schema)}, {CORRUPT} string", PERMISSIVE)
    nothing = F.lit(True)
    for field in schema:
        nothing = nothing & F.col(field.name).isNull()
    broken = F.col(CORRUPT).isNotNull() | nothing
    for name in required:
        broken = broken | F.col(name).isNull()
    for field in schema:
        if field.dataType.typeName() in ("double", "float"):
            broken = broken | (F.col(field.name).isNotNull() & ~finite(field.name))
    corrupt = F.when(broken, F.coalesce(raw, F.lit("")))
    if strict:
        message = F.concat(F.lit("malformed message: "), F.coalesce(raw, F.lit("")))
        corrupt = F.when(broken, F.raise_error(message)).cast("string")
    kept = [c for c in messages.columns if c != value]
    return _unpack(messages, record, *messages.columns).select(*kept, *schema.names, corrupt.alias(CORRUPT))


def good(decoded):
    """Rows that decoded, without the ``_corrupt`` column."""
    return decoded.where(F.col(CORRUPT).isNull()).drop(CORRUPT)


def dead_letters(decoded):
    """Raw messages that did not decode."""
    return decoded.where(F.col(CORRUPT).isNotNull()).select(F.col(CORRUPT).alias("value"))


def json_to_map(column):
    """JSON object text to MAP<STRING, STRING>."""
    return F.from_json(column, "map<string,string>")


def json_to_variants(column):
    """JSON object text to MAP<STRING, VARIANT>: values keep their types, numbers, booleans, lists and objects alike.

    Text that is no JSON, or no object, gives a null map; a JSON null is a value. ``variant_value`` reads one.
    """
    return F.try_variant_get(F.try_parse_json(column), "$", "map<string,variant>")


def variant_value(variants, key, kind, path="$"):
    """A value of a map of VARIANT as ``kind``, from ``path`` inside it; null if it is missing or of another kind."""
    return F.try_variant_get(F.try_element_at(variants, F.lit(key)), path, kind)


def encode_map(variants):
    """A map as JSON text: keys in code point order, values of any type, null values written as null. A null map is null."""
    ordered = F.transform(
        F.array_sort(F.map_keys(variants)), lambda key: F.struct(key.alias("key"), F.element_at(variants, key).alias("value"))
    )
    return F.when(variants.isNotNull(), F.to_json(F.map_from_entries(ordered)))


def _wire(df, names):
    # A cast keeps all six fraction digits; the JSON and CSV writers cut to three.
    types = dict(df.dtypes)
    return [
        F.col(n).cast("string").alias(n) if types[n].startswith("timestamp") else F.col(n)
        for n in names
    ]


def encode_json(df, columns=None, carry=()):
    """One JSON object per row in ``value``; null fields are left out."""
    names = columns or df.columns
    return df.select(*carry, F.to_json(F.struct(*_wire(df, names))).alias("value"))


def encode_enriched(df, carry=()):
    return encode_json(df, ENRICHED_WIRE_ORDER, carry)


def encode_csv(df, columns=("dt", "lat", "lon", "base"), carry=()):
    """One comma-separated line per row in ``value``."""
    return df.select(*carry, F.to_csv(F.struct(*_wire(df, columns))).alias("value"))


def encode_items(df):
    """Items as JSON with every number written as a string."""
    return df.select(
        F.to_json(F.struct(*[F.col(c).cast("string").alias(c) for c in ("id", "value")])).alias(
            "value"
        )
    )
