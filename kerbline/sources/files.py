"""CSV and JSON trip files, always read with an explicit schema."""

from pyspark.sql import functions as F
from pyspark.sql import types as T

from kerbline.operators.ordering import order_spread
from kerbline.schemas import TRIP, TRIP_CLUSTERED

TIME_FORMAT = "yyyy-MM-dd HH:mm:ss.SSSSSS"
TIME_OPTIONS = {"timestampFormat": TIME_FORMAT, "timestampNTZFormat": TIME_FORMAT}
CORRUPT = "_corrupt"
_OFFSET = r"\s*(Z|[+-]\d{2}:?\d{2})$"


def _scan(reader, kind, path, schema, corrupt, **options):
    """Read times as text and parse them here: plain, or with an offset, which is left out to give wall-clock time. The cast
    does so itself for most forms; only what it cannot read is tried again without its offset.

    A file record that cannot be read, or a time that cannot be parsed, is reported in ``_corrupt`` if ``corrupt`` is set;
    its other cells are kept.
    """
    times = [f.name for f in schema if isinstance(f.dataType, T.TimestampNTZType)]
    raw = T.StructType([T.StructField(f.name, T.StringType() if f.name in times else f.dataType) for f in schema])
    raw = raw.add(CORRUPT, T.StringType())
    rows = getattr(reader.schema(raw).options(columnNameOfCorruptRecord=CORRUPT, **options), kind)(path)
    bad = F.col(CORRUPT)
    parsed = {}
    for name in times:
        plain = F.regexp_replace(name, _OFFSET, "").try_cast("timestamp_ntz")
        parsed[name] = F.coalesce(F.col(name).try_cast("timestamp_ntz"), plain)
        bad = F.coalesce(bad, F.when(F.col(name).isNotNull() & parsed[name].isNull(), F.col(name)))
    out = [parsed.get(f.name, F.col(f.name)).alias(f.name) for f in schema]
    return rows.select(*out, *([bad.alias(CORRUPT)] if corrupt else []))


def csv_scan(spark, path, schema=TRIP, corrupt=False):
    """Headerless CSV bound by position; ``corrupt`` adds the text of records or times that cannot be read."""
    return _scan(spark.read, "csv", path, schema, corrupt, header=False)


def json_scan(spark, path, schema=TRIP_CLUSTERED, corrupt=False):
    """JSON lines bound by name; ``corrupt`` adds the text of records or times that cannot be read."""
    return _scan(spark.read, "json", path, schema, corrupt)


def write_csv(df, path, mode="errorifexists"):
    df.write.mode(mode).options(**TIME_OPTIONS).csv(path, header=False)


def write_json(df, path, mode="errorifexists"):
    df.write.mode(mode).options(**TIME_OPTIONS).json(path)


def write_json_sorted(df, path, by=("dt",), mode="errorifexists"):
    """Write JSON files in global order of ``by``; see ``order_spread`` for ties."""
    write_json(order_spread(df, *by), path, mode)
