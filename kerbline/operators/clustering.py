"""K-means over pickup coordinates, and nearest-centre assignment."""

from pyspark.ml.clustering import KMeans, KMeansModel
from pyspark.ml.feature import VectorAssembler
from pyspark.ml.functions import array_to_vector
from pyspark.sql import functions as F

from kerbline.functions import codec
from kerbline.operators import center_index
from kerbline.schemas import CENTER

SPLIT_SEED = 5043
FIT_SEED = 5043

# Distances to so many centres are unrolled in ``nearest``: the generated methods stay below the 8,000 bytes of code that
# HotSpot compiles. More centres are looked up in an index.
BLOCK = 50

# Proven size bound of a broadcast centre table: 100,000 rows of 20 bytes.
BROADCAST_LIMIT = 100_000


def assemble(df, columns=("lat", "lon"), output="features"):
    """Add a vector column of the given numeric columns."""
    return VectorAssembler(
        inputCols=list(columns), outputCol=output, handleInvalid="keep"
    ).transform(df)


def array_features(df, column, output="features"):
    """Add a vector column made from an array column."""
    return df.withColumn(output, array_to_vector(F.col(column).cast("array<double>")))


def located(points):
    """The rows with finite coordinates."""
    return points.where(codec.finite("lat") & codec.finite("lon"))


def collapse(points):
    """Identical coordinates as one point with a weight.

    Pickups lie on a fixed decimal grid, so this shrinks the data that each
    k-means pass reads, and a hot spot becomes a single row.
    """
    return (
        located(points)
        .groupBy("lat", "lon")
        .agg(F.count(F.lit(1)).cast("double").alias("weight"))
    )


def fit(trips, k=20, max_iter=5, seed=FIT_SEED):
    """Fit k-means on lat and lon, weighting identical pickups by their count."""
    points = assemble(collapse(trips))
    return KMeans(k=k, maxIter=max_iter, seed=seed, weightCol="weight").fit(points)


def fit_arrays(df, column, k, max_iter=5, seed=FIT_SEED):
    """Fit k-means on an array column of any width."""
    return KMeans(k=k, maxIter=max_iter, seed=seed).fit(array_features(df.select(column), column))


def save_model(model, path):
    model.write().overwrite().save(path)


def load_model(path):
    return KMeansModel.load(path)


def centers_of(model):
    """Centres of a fitted model as (clat, clon) pairs, for any k."""
    return [(float(c[0]), float(c[1])) for c in model.clusterCenters()]


def center_table(spark, centers):
    """CENTER rows; the cluster id is the position in ``centers``."""
    rows = [(i, float(lat), float(lon)) for i, (lat, lon) in enumerate(centers)]
    return spark.createDataFrame(rows, CENTER).coalesce(1)


def predict(model, df, columns=("lat", "lon")):
    """Assign with the model; the cluster id is ``cid``, null where a coordinate is missing or not finite."""
    filled = [f"_filled_{c}" for c in columns]
    whole = F.lit(True)
    for name, column in zip(filled, columns):
        whole = whole & codec.finite(column)
        df = df.withColumn(name, F.when(codec.finite(column), F.col(column)).otherwise(0.0))
    out = model.transform(assemble(df, filled))
    cid = F.when(whole, F.col(model.getPredictionCol()))
    return out.withColumn("cid", cid).drop(model.getPredictionCol(), "features", *filled)


def _squared_distance(clat, clon):
    # Non-null inputs keep null checks out of the generated code; NaN marks a
    # missing coordinate and sorts after every number.
    lat, lon = (f"coalesce({c}, double('NaN'))" for c in ("lat", "lon"))
    return f"({lat} - {clat}) * ({lat} - {clat}) + ({lon} - {clon}) * ({lon} - {clon})"


def _distances(centers):
    """Array of squared distances as one SQL expression, which is quick to build."""
    terms = [_squared_distance(f"({float(a)!r}D)", f"({float(b)!r}D)") for a, b in centers]
    return F.expr(f"array({', '.join(terms)})")


def nearest(df, centers, distance=None):
    """Add ``cid``, the nearest centre; ties go to the lowest id.

    Up to ``BLOCK`` centres are literals in the plan: assignment is row-local, with no join and no shuffle. More of them are
    looked up in an index of plane cells (``center_index``), so that neither the plan nor the cost of a row grows with
    their number. A row without finite coordinates gets a null id. ``distance`` names an extra column for the squared
    distance.

    The result of the literals leaves through a one-row generator. Expressions above it, as a filter on ``cid``, would
    otherwise be merged with copies of all distances.
    """
    own = list(df.columns)
    if len(centers) > BLOCK:
        out = center_index.nearest(df, centers, codec.finite("lat") & codec.finite("lon"))
        best = [F.col("_best.cid").alias("cid")] + ([F.col("_best.d2").alias(distance)] if distance else [])
        return out.select(*own, *best)
    measured = df.withColumn("_d", _distances(centers)).withColumn("_m", F.array_min("_d"))
    place = (F.array_position("_d", F.col("_m")) - 1).cast("int")
    out = measured.select(*own, F.inline(F.array(F.struct("_m", place.alias("_c")))))
    known = F.col("_m") < float("inf")
    added = [F.when(known, F.col("_c")).alias("cid")]
    if distance:
        added.append(F.when(known, F.col("_m")).alias(distance))
    return out.select(*own, *added)


def cost(df, centers):
    """One row ``cost``: sum of squared distances to the nearest centre."""
    return nearest(df.select("lat", "lon"), centers, "d2").agg(F.sum("d2").alias("cost"))


def training_cost(model):
    """The cost that the fit recorded, taken before its last move of the centres.

    ``cost`` with the model's centres gives the cost of the model as it stands.
    """
    return model.summary.trainingCost


def refine(trips, centers, rounds):
    """Lloyd iterations from given centres; returns the new centres.

    Each round is one aggregation with k result rows. A centre without pickups
    stays where it is.
    """
    points = collapse(trips).persist()
    try:
        for _ in range(rounds):
            means = (
                nearest(points, centers)
                .groupBy("cid")
                .agg(
                    (F.sum(F.col("lat") * F.col("weight")) / F.sum("weight")).alias("clat"),
                    (F.sum(F.col("lon") * F.col("weight")) / F.sum("weight")).alias("clon"),
                )
                .collect()
            )
            moved = {r["cid"]: (r["clat"], r["clon"]) for r in means}
            centers = [moved.get(i, c) for i, c in enumerate(centers)]
    finally:
        points.unpersist()
    return centers


def first_points(trips, k, order):
    """The first k pickups with coordinates, by ``order``, as starting centres."""
    rows = located(trips).orderBy(order).select("lat", "lon").limit(k).collect()
    return [(r["lat"], r["lon"]) for r in rows]


def random_split(df, train=0.7, seed=SPLIT_SEED):
    """Random train and test parts; the draw depends on the input partitioning.

    Spark sorts every input partition for it, so on large data keep few columns or
    use ``hash_split``.
    """
    return df.randomSplit([train, 1 - train], seed)


def hash_split(df, key=None, train=0.7):
    """Add ``in_train`` from a hash of ``key``, or of the whole row: stable under any partitioning.

    A null hashes as a value of its own, so every row is in one part. Without a key, identical rows are in the same part.
    """
    if key is None:
        bucket = F.pmod(F.xxhash64(*df.columns), F.lit(100))
    else:
        text = F.coalesce(F.col(key).cast("string"), F.lit("null"))
        bucket = F.conv(F.substring(F.md5(text), 1, 8), 16, 10).cast("bigint") % 100
    return df.withColumn("in_train", bucket < round(train * 100))


def attach_centers(clustered, centers):
    """Join the centre of each row's cluster on ``cid``.

    The centre table has ``len(centers)`` rows, which decides the strategy: within
    the bound it is broadcast; beyond it the join shuffles, and adaptive execution
    splits a cluster that holds too much of the data.
    """
    table = center_table(clustered.sparkSession, centers)
    if len(centers) <= BROADCAST_LIMIT:
        table = F.broadcast(table)
    return clustered.join(table, ["cid"])


def enrich(trips, centers):
    """Nearest cluster and its centre for every trip that has coordinates."""
    return attach_centers(nearest(trips, centers), centers)
