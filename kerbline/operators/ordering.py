"""Global sorts that stay balanced under heavy ties."""

from pyspark.sql import functions as F


def order_spread(df, *by):
    """Sort by ``by``, then by all other columns and the row position.

    The tie-breakers let range partitioning split a value, or a block of identical
    rows, that holds much of the data. ``df`` should be row-local over a scan,
    where a retried task meets its rows at the same positions.
    """
    rest = [c for c in df.columns if c not in by]
    placed = df.withColumn("_pos", F.monotonically_increasing_id())
    return placed.orderBy(*by, *rest, "_pos").drop("_pos")
