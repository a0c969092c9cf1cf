"""String expressions: row keys, key predicates and tokens."""

from pyspark.sql import functions as F


def rowkey(*columns):
    """Join columns with ``_``; a null prints as ``null`` instead of vanishing."""
    return F.concat_ws(
        "_", *[F.coalesce(F.col(c).cast("string"), F.lit("null")) for c in columns]
    )


def key_at_most(key, bound):
    """String-order upper bound, so ``'19' > '11'`` but ``'100' <= '11'``."""
    return F.col(key) <= F.lit(bound)


def key_has_prefix(key, prefix):
    return F.col(key).startswith(prefix)


def key_of_cluster(key, cid):
    """All keys of one cluster. The separator keeps cluster 2 apart from 20 to 29."""
    return key_has_prefix(key, f"{cid}_")


def key_cluster(key):
    """Cluster id parsed from a row key, null when the key has none."""
    return F.expr(f"try_cast(substring_index({key}, '_', 1) AS INT)")


def words(column):
    """Split on single spaces.

    Trailing empty tokens are dropped, leading and inner ones stay; an empty text
    is one empty token and a text of spaces only has none.
    """
    text = F.col(column)
    trimmed = F.rtrim(text)
    return (
        F.when(text == "", F.array(F.lit("")))
        .when(trimmed == "", F.array().cast("array<string>"))
        .otherwise(F.split(trimmed, " "))
    )
