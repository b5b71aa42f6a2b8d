"""Hybrid clustering of jobs: features, K-means, model choice and cluster description."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.ml.clustering import KMeans, KMeansModel
from pyspark.ml.evaluation import ClusteringEvaluator
from pyspark.ml.feature import HashingTF, Normalizer
from pyspark.ml.functions import array_to_vector, vector_to_array
from pyspark.ml.stat import Summarizer
from pyspark.sql import Column, DataFrame, functions as F

from hirelake.functions.vectors import distance, squared_distance
from hirelake.operators.dedup import top_per_group
from hirelake.session import stage

N_CLUSTERS = 10
SEED = 42
UNKNOWN = "Unknown"
UNPOPULATED = "Unpopulated Cluster"
#: Bytes of the vectors of a block, of which a task holds two when distances are summed exactly.
BLOCK_BYTES = 8 << 20
#: Parts of the blocks that pass by all others; each adds a line per vector and cluster to what is exchanged.
STREAMS = 8
BATCH_SETTING = "spark.sql.execution.arrow.maxRecordsPerBatch"


# --- features ---------------------------------------------------------------

def text_vectors(df: DataFrame, text: str, output: str = "vector", size: int = 3072) -> DataFrame:
    """Offline text vectors: hashed word counts of unit length, zeros for blank text."""
    words = F.filter(F.split(F.lower(F.coalesce(text, F.lit(""))), r"\s+"), lambda w: w != "")
    hashed = HashingTF(inputCol="_words", outputCol="_hashed", numFeatures=size)
    unit = Normalizer(p=2.0, inputCol="_hashed", outputCol=output)
    return unit.transform(hashed.transform(df.withColumn("_words", words))).drop("_words", "_hashed")


def dense_index(values: DataFrame, column: str, index: str) -> DataFrame:
    """Number the distinct values 0..n-1 in ascending order, without one task seeing all of them.

    Values are range-partitioned and written; a row's number is its position in
    its partition plus the size of the partitions before it. Only one count per
    partition reaches the driver.
    """
    spark = values.sparkSession
    ordered = (
        values.select(column).distinct()
        .repartitionByRange(F.col(column).asc_nulls_last())
        .sortWithinPartitions(F.col(column).asc_nulls_last())
        .withColumn("_at", F.monotonically_increasing_id())
    )
    ordered = stage(ordered, "index")
    part, place = F.shiftright("_at", 33), F.col("_at").bitwiseAND((1 << 33) - 1)
    sizes = ordered.groupBy(part.alias("_part")).count().orderBy("_part").collect()
    offsets, total = [], 0
    for row in sizes:
        offsets.append((row["_part"], total))
        total += row["count"]
    starts = spark.createDataFrame(offsets, "_part bigint, _start bigint")
    return (
        ordered.withColumn("_part", part).join(F.broadcast(starts), "_part")
        .select(column, (F.col("_start") + place).alias(index))
    )


def categorical_pairs(jobs: DataFrame) -> DataFrame:
    """Distinct (category, company) pairs with the number of jobs of each.

    Jobs of one pair have the same one-hot vector, so the categorical model
    needs one weighted row per pair. A missing category counts as 'Unknown'; a
    missing company stays a value of its own.
    """
    filled = jobs.fillna({"category_label": UNKNOWN})
    return filled.groupBy("category_label", "company_name").agg(F.count(F.lit(1)).alias("jobs"))


def one_hot(pairs: DataFrame) -> DataFrame:
    """Add the places of the two ones in the one-hot vector of distinct (category, company) pairs.

    Categories come first in the vector, then companies, both in ascending order. Only the places are
    kept, so a row does not grow with the number of companies; both value lists are numbered in a
    distributed way, and only their sizes reach the driver.
    """
    categories = stage(dense_index(pairs, "category_label", "category_place"), "categories")
    companies = dense_index(pairs, "company_name", "_company")
    placed = companies.select(
        F.col("company_name").alias("_name"), (F.col("_company") + categories.count()).alias("company_place"))
    return pairs.join(categories, "category_label").join(
        placed, F.col("company_name").eqNullSafe(F.col("_name"))).drop("_name")


# --- models -----------------------------------------------------------------

def fit_kmeans(df: DataFrame, features: str = "features", k: int = N_CLUSTERS, seed: int = SEED) -> KMeansModel:
    return KMeans(k=k, seed=seed, featuresCol=features, predictionCol="cluster_id").fit(df)


def assign_vectors(df: DataFrame, vector: str, centers: list[tuple[int, list[float]]]) -> DataFrame:
    """Add ``cluster_id`` and the squared distance ``off`` of the nearest centre; a tie goes to the smaller id."""
    point = F.col(vector).cast("array<double>")
    found = F.array_min(F.array(*[
        F.struct(squared_distance(point, F.lit(center)).alias("off"), F.lit(number).alias("cluster_id")) for number, center in centers]))
    return df.withColumn("_best", found).select(*df.columns, "_best.cluster_id", "_best.off")


def refine_centers(df: DataFrame, vector: str, centers: list[tuple[int, list[float]]], rounds: int) -> list[tuple[int, list[float]]]:
    """Centres after so many rounds of assignment and averaging from given ones; a cluster that lost all its rows keeps its centre.

    Only the centres come to the driver: a vector per cluster.
    """
    for _ in range(rounds):
        moved = centers_of(assign_vectors(df.select(vector), vector, centers), vector)
        found = {row["cluster_id"]: [float(x) for x in row["center"]] for row in moved.collect()}
        centers = [(number, found.get(number, center)) for number, center in centers]
    return centers


def silhouette(df: DataFrame, features: str = "features", cluster: str = "cluster_id") -> float:
    """Mean silhouette for squared Euclidean distance, from per-cluster sums in linear time."""
    labelled = df.withColumn("_label", F.col(cluster).cast("double"))
    evaluator = ClusteringEvaluator(
        featuresCol=features, predictionCol="_label", metricName="silhouette",
        distanceMeasure="squaredEuclidean",
    )
    return evaluator.evaluate(labelled)


def _packed(size: int, width: int):
    """Rows (point, own, row) as blocks of ``size`` rows: their numbers, clusters and points, each as the bytes of an array."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def block(pieces: list[pa.RecordBatch]) -> pa.RecordBatch:
            points = np.concatenate([x.column(0).flatten().to_numpy().reshape(x.num_rows, width) for x in pieces])
            own, rows = (np.concatenate([np.asarray(x.column(k)) for x in pieces]) for k in (1, 2))
            return pa.record_batch([pa.array([x.tobytes()], pa.binary()) for x in (rows, own, points)], ["rows", "owns", "points"])

        held, room = [], size
        for batch in batches:
            at = 0
            while at < batch.num_rows:
                held.append(batch.slice(at, room))
                at, room = at + held[-1].num_rows, room - held[-1].num_rows
                if not room:
                    yield block(held)
                    held, room = [], size
        if held:
            yield block(held)

    return run


def _far(points: np.ndarray, targets: np.ndarray, member: np.ndarray, same: bool) -> np.ndarray:
    """Distances of every point to the targets, added up per cluster; ``same`` says that both are one block."""
    out, square = np.empty((len(points), member.shape[1])), (targets ** 2).sum(axis=1)
    for first in range(0, len(points), 512):
        part = points[first:first + 512]
        far = part @ targets.T
        far *= -2.0
        far += (part ** 2).sum(axis=1)[:, None] + square
        np.maximum(far, 0.0, out=far)
        if same:
            far[np.arange(len(part)), first + np.arange(len(part))] = 0.0
        out[first:first + 512] = np.sqrt(far, out=far) @ member
    return out


def distance_sums(df: DataFrame, vector: str, cluster: str, block_bytes: int | None = None) -> DataFrame:
    """Euclidean distances of every vector to all of a cluster, added up: ``row`` (any number), ``own``, ``other``, ``far``.

    Vectors are packed into blocks, which are written once, and each two blocks meet in a product of the files with
    themselves, so no vector is exchanged again: at most :data:`STREAMS` parts of the blocks pass by every other part. A task
    holds a part of one side and a block of the other, and what leaves it is a number for each vector it holds and each cluster, so
    the result has rows x clusters lines, of which at most :data:`STREAMS` are added up. Only the work and what is read are quadratic in
    the rows. Rows with a null vector or cluster are left out; all vectors must have one length.
    """
    spark = df.sparkSession
    point = F.col(vector).cast("array<double>").alias("point")
    rows = df.select(point, F.col(cluster).cast("long").alias("own")).filter("point IS NOT NULL AND own IS NOT NULL")
    rows = stage(rows.withColumn("row", F.monotonically_increasing_id()), "points")
    count, width = rows.agg(F.count("*"), F.max(F.size("point"))).first()
    width = width or 0
    size = max(1, (block_bytes or BLOCK_BYTES) // (8 * max(width, 1)))
    files = min(max(1, -(-count // size)), 1024)
    packed = rows.repartition(files, "row").mapInArrow(_packed(size, width), "rows binary, owns binary, points binary")
    packed = stage(packed.withColumn("block", F.monotonically_increasing_id()), "blocks")
    met = packed.select(F.col("block").alias("met"), F.col("owns").alias("others"), F.col("points").alias("targets")).coalesce(STREAMS)
    pairs = met.hint("shuffle_replicate_nl").crossJoin(packed)

    def sums(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: dict[int, tuple[np.ndarray, np.ndarray, dict[int, np.ndarray]]] = {}
        for batch in batches:
            for met, others, targets, row, own, points, block in zip(*batch.columns):
                numbers = [np.frombuffer(x.as_buffer(), np.int64) for x in (others, row, own)]
                one, two = (np.frombuffer(x.as_buffer()).reshape(-1, width) if width else np.zeros((len(n), 0))
                            for x, n in ((points, numbers[1]), (targets, numbers[0])))
                names, at = np.unique(numbers[0], return_inverse=True)
                member = np.zeros((len(at), len(names)))
                member[np.arange(len(at)), at] = 1.0
                far = _far(one, two, member, met.as_py() == block.as_py())
                sums = held.setdefault(block.as_py(), (numbers[1].copy(), numbers[2].copy(), {}))[2]
                for k, name in enumerate(names.tolist()):
                    sums[name] = sums[name] + far[:, k] if name in sums else far[:, k].copy()
        for row, own, sums in held.values():
            for name, far in sums.items():
                yield pa.record_batch([pa.array(row), pa.array(own), pa.array(np.full(len(row), name)), pa.array(far)],
                                      ["row", "own", "other", "far"])

    parts = pairs.mapInArrow(sums, "row long, own long, other long, far double")
    before = spark.conf.get(BATCH_SETTING)
    spark.conf.set(BATCH_SETTING, str(max(1, min(int(before), BLOCK_BYTES // (16 * size * max(width, 1))))))  # two blocks a row
    try:
        return stage(parts.groupBy("row", "own", "other").agg(F.sum("far").alias("far")), "distance-sums")
    finally:
        spark.conf.set(BATCH_SETTING, before)


def silhouette_exact(df: DataFrame, vector: str, cluster: str, block_bytes: int | None = None) -> DataFrame:
    """Mean silhouette of all vectors for the Euclidean distance, as one row, from :func:`distance_sums`.

    A row alone in its cluster scores 0, as does one without another cluster or at distance 0 from all; without rows the
    result is null. Use :func:`silhouette` where the squared distance will do: it takes one pass.
    """
    sums = distance_sums(df, vector, cluster, block_bytes)
    sizes = sums.filter("own = other").groupBy("other").agg(F.count("*").alias("size"))
    mine = F.col("own") == F.col("other")
    scored = sums.join(sizes, "other").groupBy("row").agg(
        F.max(F.when(mine & (F.col("size") > 1), F.col("far") / (F.col("size") - 1))).alias("inner"),
        F.min(F.when(~mine, F.col("far") / F.col("size"))).alias("outer"))
    score = F.coalesce(F.try_divide(F.col("outer") - F.col("inner"), F.greatest("outer", "inner")), F.lit(0.0))
    return scored.agg(F.avg(score).alias("silhouette"))


def _value_shares(clustered: DataFrame) -> tuple[dict[str, DataFrame], DataFrame]:
    """The mean one-hot vector of every cluster in long form: (cluster, value, share) per column, and its squared length."""
    k = "cluster_id"
    sizes = clustered.groupBy(k).agg(F.sum("jobs").alias("size"))
    shares = {
        column: clustered.groupBy(k, column).agg(F.sum("jobs").alias("n")).join(sizes, k)
        .select(k, F.col(column).alias("_value"), (F.col("n") / F.col("size")).alias("share"))
        for column in ("category_label", "company_name")
    }
    squares = [df.select(k, (F.col("share") ** 2).alias("square")) for df in shares.values()]
    return shares, squares[0].unionByName(squares[1]).groupBy(k).agg(F.sum("square").alias("norm"))


def assign_categories(pairs: DataFrame, clustered: DataFrame) -> DataFrame:
    """The nearest centre of ``clustered`` for each (category, company) pair: ``cluster_id`` and the squared ``off``.

    From |x - c|^2 = 2 - 2 (c[category] + c[company]) + |c|^2, only clusters that share a value with the pair
    can be nearer than the one with the shortest centre, so the pairs are joined with the shares of
    their two values: at most twice as many rows as clusters for each, and no vector is ever built. A
    tie goes to the smaller id.
    """
    a, b, k = "category_label", "company_name", "cluster_id"
    shares, norms = _value_shares(clustered)
    lengths = {row[k]: row["norm"] for row in norms.collect()}  # a number per cluster
    shortest = min(lengths, key=lambda c: (round(lengths[c], 9), c))
    met = [
        pairs.join(df, F.col(column).eqNullSafe(F.col("_value"))).select(a, b, "jobs", k, "share")
        for column, df in shares.items()
    ]
    near = met[0].unionByName(met[1]).groupBy(a, b, "jobs", k).agg(F.sum("share").alias("near")).join(norms, k)
    off = F.round(2.0 - 2.0 * F.col("near") + F.col("norm"), 9)
    fallback = F.struct(F.lit(round(2.0 + lengths[shortest], 9)).alias("off"), F.lit(shortest).cast("int").alias(k))
    candidates = near.select(a, b, "jobs", F.struct(off.alias("off"), F.col(k).cast("int").alias(k)).alias("best"))
    every = candidates.unionByName(pairs.select(a, b, "jobs", fallback.alias("best")))
    return every.groupBy(a, b, "jobs").agg(F.min("best").alias("best")).select(a, b, "jobs", f"best.{k}", "best.off")


def categorical_kmeans(
    pairs: DataFrame, k: int = N_CLUSTERS, seed: int = SEED, rounds: int = 100, first: list[tuple[str | None, str | None]] | None = None,
) -> DataFrame:
    """K-means of jobs by the one-hot vector of category and company, from distinct pairs and their ``jobs``.

    The first centres are ``k`` pairs drawn by their number of jobs, or those given as ``first``. Rounds end when no pair changes its cluster;
    each is written to the shared folder. The result has a ``cluster_id`` (0 to k - 1) per pair and ``off``, its squared
    distance to the centre it was assigned by.
    """
    a, b = "category_label", "company_name"
    chance = (F.pmod(F.xxhash64(F.lit(seed), a, b), F.lit(1 << 30)) + 1) / F.lit(float((1 << 30) + 1))
    # The smallest of exponential draws with the jobs as rate: a weighted draw without replacement.
    if first is None:
        drawn = pairs.withColumn("_draw", -F.log(chance) / F.col("jobs")).orderBy("_draw", a, b).limit(k)
        first = [(row[a], row[b]) for row in drawn.collect()]
    rows = [(*pair, i, 1) for i, pair in enumerate(first)]
    if not rows:
        return pairs.select(a, b, "jobs", F.lit(0).alias("cluster_id"), F.lit(0.0).alias("off"))
    start = pairs.sparkSession.createDataFrame(rows, f"{a} string, {b} string, cluster_id int, jobs bigint")
    current = stage(assign_categories(pairs, start), "assigned")
    for _ in range(rounds):
        moved = stage(assign_categories(pairs, current), "assigned")
        same = F.col(f"x.{a}").eqNullSafe(F.col(f"y.{a}")) & F.col(f"x.{b}").eqNullSafe(F.col(f"y.{b}"))
        changed = not moved.alias("x").join(current.alias("y"), same).where("x.cluster_id != y.cluster_id").isEmpty()
        current = moved
        if not changed:
            break
    return current


def categorical_silhouette(clustered: DataFrame, cluster: str = "cluster_id", squared: bool = True) -> DataFrame:
    """Mean silhouette of jobs by one-hot (category, company) for squared Euclidean distance, as one row.

    This is the metric of :func:`silhouette`, so the two can be compared; ``squared=False`` takes the plain
    distance, as :func:`silhouette_exact` does. ``clustered`` holds (category_label, company_name, cluster, jobs). Two jobs
    are 2 apart when one of the two values differs and 4 when both do (or the roots of these), so the distance sum from a
    pair of values to a cluster follows from four counts, and no two jobs are ever paired. A cluster
    that shares neither value is exactly 4 (or 2) away and needs no row.
    """
    one, both = (2.0, 4.0) if squared else (2.0 ** 0.5, 2.0)
    a, b = "category_label", "company_name"
    units = clustered.groupBy(a, b, cluster).agg(F.sum("jobs").alias("jobs"))
    sizes = units.groupBy(cluster).agg(F.sum("jobs").alias("size"))
    n_clusters = sizes.count()
    pairs = units.select(a, b).distinct()

    def part(df: DataFrame, column: str) -> DataFrame:
        counts = [F.col("n") if c == column else F.lit(0) for c in ("in_a", "in_b", "in_ab")]
        return df.select(
            a, b, cluster, *[x.alias(c) for x, c in zip(counts, ("in_a", "in_b", "in_ab"))]
        )

    same_category = units.groupBy(F.col(a).alias("_a"), cluster).agg(F.sum("jobs").alias("n"))
    same_company = units.groupBy(F.col(b).alias("_b"), cluster).agg(F.sum("jobs").alias("n"))
    shares = (
        part(pairs.join(same_category, F.col(a).eqNullSafe(F.col("_a"))), "in_a")
        .unionByName(part(pairs.join(same_company, F.col(b).eqNullSafe(F.col("_b"))), "in_b"))
        .unionByName(part(units.withColumnRenamed("jobs", "n"), "in_ab"))
        .groupBy(a, b, cluster).agg(*[F.sum(c).alias(c) for c in ("in_a", "in_b", "in_ab")])
        .join(sizes, cluster)
    )
    one_off = F.col("in_a") + F.col("in_b") - 2 * F.col("in_ab")
    both_off = F.col("size") - F.col("in_a") - F.col("in_b") + F.col("in_ab")
    far = one * one_off + both * both_off
    shares = shares.select(
        F.col(a).alias("_a"), F.col(b).alias("_b"), F.col(cluster).alias("_other"), "size",
        far.alias("far"),
    )
    met = units.join(
        shares, F.col(a).eqNullSafe(F.col("_a")) & F.col(b).eqNullSafe(F.col("_b"))
    )
    own = F.col(cluster) == F.col("_other")
    scored = met.groupBy(a, b, cluster, "jobs").agg(
        F.max(F.when(own & (F.col("size") > 1), F.col("far") / (F.col("size") - 1))).alias("inner"),
        F.min(F.when(~own, F.col("far") / F.col("size"))).alias("outer"),
        F.count(F.lit(1)).alias("met"),
    )
    outer = F.when(
        F.col("met") < n_clusters, F.least(F.coalesce("outer", F.lit(both)), F.lit(both))
    ).otherwise(F.col("outer"))
    score = F.coalesce(
        F.try_divide(outer - F.col("inner"), F.greatest(outer, F.col("inner"))), F.lit(0.0)
    )
    return scored.agg((F.sum(score * F.col("jobs")) / F.sum("jobs")).alias("silhouette"))


def choose_model(embedding_score: float, categorical_score: float) -> tuple[str, float]:
    """Name and score of the better model; the embedding model wins a tie."""
    if embedding_score >= categorical_score:
        return "Embeddings", embedding_score
    return "Categorical", categorical_score


# --- description ------------------------------------------------------------

def centers_of(df: DataFrame, vector: str) -> DataFrame:
    """Mean vector (array) per cluster."""
    mean = Summarizer.mean(array_to_vector(F.col(vector).cast("array<double>")))
    return df.groupBy("cluster_id").agg(vector_to_array(mean).alias("center"))


def model_distance(df: DataFrame, vector: str, model: KMeansModel) -> DataFrame:
    """Add the Euclidean distance of each row to the centre of its own cluster in a fitted model, without any exchange.

    The centres are few and ride along. ``vector`` is a vector column; only the numbers that it holds leave the JVM.
    """
    held = df.sparkSession.sparkContext.broadcast(np.array([np.asarray(c, float) for c in model.clusterCenters()]))

    @F.arrow_udf("double")
    def far(points: pa.Array, clusters: pa.Array) -> pa.Array:
        centers, out = held.value, np.empty(len(points))
        own = clusters.to_numpy(zero_copy_only=False)
        dense = points.field("type").to_numpy(zero_copy_only=False) == 1
        indices, values = (pc.list_flatten(points.field(name)).to_numpy(zero_copy_only=False) for name in ("indices", "values"))
        placed, valued = (pc.fill_null(pc.list_value_length(points.field(name)), 0).to_numpy(zero_copy_only=False).astype(np.int64)
                          for name in ("indices", "values"))
        place_ends, value_ends = np.cumsum(placed), np.cumsum(valued)
        width = centers.shape[1]
        for first in range(0, len(points), 256):
            last = min(first + 256, len(points))
            off = -centers[own[first:last]]
            for row in np.flatnonzero(dense[first:last]):
                off[row] += values[value_ends[first + row] - width:value_ends[first + row]]
            rows = np.flatnonzero(~dense[first:last])
            if len(rows):
                at = np.repeat(rows, placed[first + rows])
                mine = np.repeat(~dense[first:last], valued[first:last])
                off[at, indices[place_ends[first] - placed[first]:place_ends[last - 1]]] += values[
                    value_ends[first] - valued[first]:value_ends[last - 1]][mine]
            out[first:last] = np.sqrt(np.einsum("ij,ij->i", off, off))
        return pa.array(out)

    return df.withColumn("distance", far(F.unwrap_udt(vector), F.col("cluster_id")))


def with_center_distance(df: DataFrame, vector: str, centers: DataFrame) -> DataFrame:
    """Add the Euclidean distance of each row to the centre of its own cluster.

    The centres are written first, so that Spark sees how few they are and does not exchange the rows by cluster.
    """
    measured = df.join(stage(centers.select("cluster_id", "center"), "centers"), "cluster_id")
    point = F.col(vector).cast("array<double>")
    return measured.withColumn("distance", distance(point, F.col("center"))).drop("center")


def categorical_distance(clustered: DataFrame) -> DataFrame:
    """Add the distance of each (category, company) pair to the mean one-hot vector of its cluster.

    The mean is the share of the cluster's jobs per value, so the distance
    follows from counts: |x - c|^2 = 2 - 2 (c[category] + c[company]) + |c|^2.
    """
    a, b, k = "category_label", "company_name", "cluster_id"
    shares, norms = _value_shares(clustered)
    wide = clustered.select(a, b, k, "jobs")
    for column, df in shares.items():
        other = df.select(F.col(k).alias("_k"), "_value", F.col("share").alias(f"{column}_share"))
        same = (F.col(k) == F.col("_k")) & F.col(column).eqNullSafe(F.col("_value"))
        wide = wide.join(other, same).drop("_k", "_value")
    squared = 2.0 - 2.0 * (F.col(f"{a}_share") + F.col(f"{b}_share")) + F.col("norm")
    return wide.join(norms, k).select(
        a, b, k, F.sqrt(F.greatest(squared, F.lit(0.0))).alias("distance")
    )


def join_pairs(jobs: DataFrame, pairs: DataFrame) -> DataFrame:
    """Give each job the columns of its (category, company) pair.

    The pairs are written first, so that Spark sees their size and exchanges no jobs by pair if they are few.
    """
    renamed = stage(pairs, "pair-columns").withColumnsRenamed({"category_label": "_category", "company_name": "_company"})
    same = (F.col("category_label") == F.col("_category")) & F.col("company_name").eqNullSafe(
        F.col("_company"))
    return jobs.join(renamed, same).drop("_category", "_company")


def nearest_members(measured: DataFrame, key: str, n: int = 5) -> DataFrame:
    """The ``n`` rows closest to the centre of their cluster, with their rank."""
    return top_per_group(measured, ["cluster_id"], [F.asc("distance"), F.asc(key)], n)


def cluster_names(keywords: DataFrame, cluster: str = "cluster_id", named: DataFrame | None = None) -> DataFrame:
    """Name and keyword list per cluster, from ranked keywords.

    The name is made of the two heaviest terms (one, if there is no second); a caller's table
    (cluster, cluster_name) wins where it has a name. Quotes are dropped.
    """
    terms = keywords.groupBy(cluster).agg(
        F.transform(F.array_sort(F.collect_list(F.struct("rank", "term"))), lambda p: p["term"])
        .alias("terms")
    )
    template = F.concat(F.lit("Cluster_"), F.array_join(F.slice("terms", 1, 2), "_"))
    result = terms.select(cluster, template.alias("_template"), F.array_join("terms", ", ").alias("top_terms"))
    name = F.col("_template")
    if named is not None:
        given = named.select(
            cluster, F.nullif(F.replace(F.trim("cluster_name"), F.lit('"')), F.lit("")).alias("_given")
        )
        result = result.join(given, cluster, "left")
        name = F.coalesce("_given", name)
    return result.select(cluster, name.alias("cluster_name"), "top_terms")


def cluster_registry(
    members: DataFrame, names: DataFrame, model_version: Column, updated_at: Column, k: int = N_CLUSTERS
) -> DataFrame:
    """One row per cluster id 0..k-1 with name, keywords, size and mean salaries."""
    ids = members.sparkSession.range(k).select(F.col("id").cast("int").alias("cluster_id"))
    facts = members.groupBy("cluster_id").agg(
        F.count(F.lit(1)).alias("job_count"),
        F.avg("salary_min").alias("avg_salary_min"),
        F.avg("salary_max").alias("avg_salary_max"),
    )
    return (
        ids.join(facts, "cluster_id", "left").join(names, "cluster_id", "left")
        .select(
            "cluster_id",
            F.when(F.col("job_count").isNull(), F.lit(UNPOPULATED))
            .otherwise(F.col("cluster_name")).alias("cluster_name"),
            F.coalesce("top_terms", F.lit("")).alias("top_terms"),
            F.coalesce("job_count", F.lit(0)).alias("job_count"),
            "avg_salary_min",
            "avg_salary_max",
            model_version.alias("model_version"),
            updated_at.alias("updated_at"),
        )
    )


def job_clusters(members: DataFrame, model_version: Column, processed_at: Column) -> DataFrame:
    return members.select(
        "job_id", "cluster_id", model_version.alias("model_version"),
        processed_at.alias("processed_at"),
    )


def samples_text(nearest: DataFrame, cluster: str, title: str, n: int = 5) -> DataFrame:
    """JSON list of the titles of the ``n`` best-ranked members per cluster, in rank order."""
    ordered = F.array_sort(F.collect_list(F.struct("rank", F.col(title).alias("title"))))
    return nearest.filter(F.col("rank") <= n).groupBy(cluster).agg(
        F.to_json(F.transform(ordered, lambda p: p["title"])).alias("samples")
    )
