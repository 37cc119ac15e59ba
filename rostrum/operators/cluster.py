"""K-means clustering of topic vectors, model selection and representatives
(inventory H6-H11).

Vectors are ``(id, vector array<double>)``.  Fits and sweeps are in ``kmeans``;
silhouette uses MLlib's cosine evaluator, which is linear in the number of points (the
reference sampled 10,000 points to afford a quadratic one).  Assignment
compares each Arrow batch of vectors with the model's centres (k rows);
representatives join each point with its own centre.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.ml.evaluation import ClusteringEvaluator
from pyspark.ml.functions import array_to_vector, vector_to_array
from pyspark.ml.stat import Summarizer
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from rostrum.operators import kmeans
from rostrum.session import stored

RANK_DIGITS = 9


def normalize(vectors: DataFrame, col: str = "vector") -> DataFrame:
    """H6: rows scaled to unit L2 norm; zero rows stay zero.  The norm is its
    own projection (a lambda would recompute it per element)."""
    sq = F.aggregate(col, F.lit(0.0), lambda a, x: a + x * x)
    n = vectors.withColumn("_norm", F.sqrt(sq))
    scaled = F.transform(col, lambda x: F.when(F.col("_norm") > 0, x / F.col("_norm")).otherwise(x))
    return n.withColumn(col, scaled).drop("_norm")


def silhouette(assigned: DataFrame, features: str = "features", cluster: str = "cluster") -> float:
    """H8: mean silhouette with cosine distance over all points."""
    ev = ClusteringEvaluator(featuresCol=features, predictionCol=cluster, metricName="silhouette",
                             distanceMeasure="cosine")
    return ev.evaluate(assigned)


def centres_of(vectors: DataFrame, cluster: str = "cluster", col: str = "vector") -> DataFrame:
    """Mean vector of every cluster: (cluster, centre array<double>), partial
    sums first."""
    means = vectors.groupBy(cluster).agg(Summarizer.mean(array_to_vector(col)).alias("m"))
    return means.select(cluster, vector_to_array("m").alias("centre"))


def with_own_distance(vectors: DataFrame, centres: DataFrame, cluster: str = "cluster",
                      col: str = "vector") -> DataFrame:
    """Adds ``distance``, the Euclidean distance of a point to its own centre."""
    j = vectors.join(centres.select(F.col(cluster).alias("_c"), "centre"), F.col(cluster) == F.col("_c")).drop("_c")
    sq = F.aggregate(F.zip_with("centre", col, lambda a, b: (a - b) * (a - b)), F.lit(0.0), lambda s, x: s + x)
    return j.withColumn("distance", F.sqrt(sq)).drop("centre")


def wcss(vectors: DataFrame, cluster: str = "cluster", col: str = "vector") -> DataFrame:
    """H11 (inertia for given labels): sum of squared distances of the points
    to the mean of their cluster, as one row."""
    d = with_own_distance(vectors, centres_of(vectors, cluster, col), cluster, col)
    return d.agg(F.sum(F.col("distance") * F.col("distance")).alias("wcss"))


def assign(vectors: DataFrame, centres: DataFrame, cluster: str = "cluster", col: str = "vector") -> DataFrame:
    """Nearest centre (Euclidean; ties to the lowest cluster id) for every
    point: (id, cluster, distance).  The centres are the model, k rows, and go
    to the tasks as one matrix."""
    spark = vectors.sparkSession
    rows = centres.orderBy(cluster).collect()
    model = spark.sparkContext.broadcast((np.array([r[cluster] for r in rows], np.int32), np.array([r["centre"] for r in rows], float)))

    def run(batches: Iterator[pa.RecordBatch]):
        ids, points = model.value
        for b in batches:
            x = b.column(1).flatten().to_numpy(zero_copy_only=False).reshape(b.num_rows, -1)
            best, at = np.full(b.num_rows, np.inf), np.zeros(b.num_rows, np.int64)
            for i, c in enumerate(points):
                sq = ((x - c) ** 2).sum(1)
                near = sq < best
                best[near], at[near] = sq[near], i
            yield pa.RecordBatch.from_arrays([b.column(0), pa.array(ids[at]), pa.array(np.sqrt(best))], ["id", cluster, "distance"])

    kind = vectors.schema["id"].dataType.simpleString()
    return vectors.select("id", col).mapInArrow(run, f"id {kind}, {cluster} int, distance double")


def representatives(vectors: DataFrame, centres: DataFrame, n: int = 2, cluster: str = "cluster",
                    col: str = "vector") -> DataFrame:
    """H9: the ``n`` members of each cluster nearest (Euclidean) to its centre,
    ties by id.  Distance is computed to the point's own centre only."""
    d = with_own_distance(vectors, centres, cluster, col)
    w = Window.partitionBy(cluster).orderBy(F.round("distance", RANK_DIGITS), "id")
    return d.withColumn("rank", F.row_number().over(w)).filter(F.col("rank") <= n).select(
        cluster, "rank", "id", "distance")


def clustered(vectors: DataFrame, k: int, seed: int = kmeans.SEED, max_iter: int = 300, tol: float = 1e-4) -> DataFrame:
    """H6 + H7: (id, vector, cluster, distance) of the normalised vectors."""
    return kmeans.fit(normalize(vectors.select("id", "vector")), k, seed, max_iter, tol)[1]


def topic_cluster_report(vectors: DataFrame, k: int, details: DataFrame, n: int = 2) -> DataFrame:
    """E8 + H6 + H7 + H9 + H10: document vectors of a topic model normalised,
    clustered, the ``n`` nearest to each centre joined with their details by
    id, as report lines."""
    v = stored(clustered(vectors, k).drop("distance"), "clusters")
    return report_lines(representatives(v, centres_of(v), n), details)


def report_lines(reps: DataFrame, details: DataFrame, cluster: str = "cluster") -> DataFrame:
    """H10 + A10: the representatives report as (cluster, line_no, line) rows,
    in the layout of the reference's text file (``None`` for missing values,
    200-character speech prefix)."""
    d = details.select(F.col("id"), "member_name", "sitting_date", "political_party", "roles", "merged_speech")
    j = reps.join(d, "id")

    def s(c):
        return F.coalesce(F.col(c).cast("string"), F.lit("None"))

    body = F.array(
        F.concat(F.lit("  Speech ID: "), F.col("id").cast("string")),
        F.concat(F.lit("  Member Name: "), s("member_name")),
        F.concat(F.lit("  Sitting Date: "), s("sitting_date")),
        F.concat(F.lit("  Political Party: "), s("political_party")),
        F.concat(F.lit("   Role: "), s("roles")),
        F.concat(F.lit("  Speech: "), F.substring("merged_speech", 1, 200), F.lit("...")),
        F.lit(""),
    )
    per_rep = j.select(cluster, "rank", F.posexplode(body).alias("i", "line"))
    # line numbers inside a cluster: header 0, then 7 lines per representative, then a blank line
    lines = per_rep.select(cluster, (1 + (F.col("rank") - 1) * 7 + F.col("i")).cast("int").alias("line_no"), "line")
    heads = reps.select(cluster).distinct()
    head = heads.select(cluster, F.lit(0).alias("line_no"), F.concat(F.lit("Cluster "), F.col(cluster).cast("string"),
                                                                       F.lit(":")).alias("line"))
    n_reps = reps.groupBy(cluster).agg(F.max("rank").alias("n"))
    tail = n_reps.select(cluster, (1 + F.col("n") * 7).cast("int").alias("line_no"), F.lit("").alias("line"))
    return head.unionByName(lines).unionByName(tail)
