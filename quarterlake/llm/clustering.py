"""K-means of integer vectors by Yinyang's bounds, exact in every round.

Centroids are clustered into groups once. Each vector keeps an upper bound of the distance to its own centroid and, for each group, one lower
bound of the distance to the group's other centroids. After a round the bounds move by as much as centroids did. A vector whose least lower
bound is above its upper bound keeps its centroid (the global filter); else groups are passed over whose own bound is above it (the group
filter), and the centroids of the other groups are scanned exactly.

A round is one pass over the vectors in Spark: it writes them with their bounds to the shared folder, and adds up each task's vectors by cluster.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from decimal import Decimal

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from quarterlake.llm.common import Scratch, materialize, table

#: Bounds are compared with this relative slack, far over what rounding can change in them.
SLACK = 1e-6
#: Under this size of components squared distances are whole numbers that doubles hold exactly.
EXACT = 1 << 20
#: More than any squared distance.
NEVER = 1 << 200
LONG = (1 << 63) - 1


def groups_of(centroids: np.ndarray, number: int) -> np.ndarray:
    """The group of each centroid, by a few rounds of plain k-means over the centroids themselves."""
    points = centroids.astype(np.float64)
    heads = points[np.linspace(0, len(points) - 1, number).astype(int)] if len(points) else points
    group = np.zeros(len(points), np.int64)
    for _ in range(5):
        group = ((points[:, None] - heads[None]) ** 2).sum(2).argmin(1) if len(points) else group
        heads = np.stack([points[group == g].mean(0) if (group == g).any() else heads[g] for g in range(len(heads))]) if len(points) else heads
    return group


def squared(vectors: np.ndarray, centroids: np.ndarray) -> np.ndarray:
    """Exact squared distances of each vector to each centroid: doubles that are whole numbers, or integers of any length."""
    most = max((int(abs(x).max(initial=0)) for x in (vectors, centroids)), default=0)
    if 0 <= most < EXACT and vectors.shape[-1] <= 256:
        v, c = vectors.astype(np.float64), centroids.astype(np.float64)
        return (v * v).sum(1)[:, None] - 2 * (v @ c.T) + (c * c).sum(1)
    v, c = vectors.astype(object), centroids.astype(object)
    return np.stack([((v - x) ** 2).sum(1) for x in c], 1)


class Step:
    """One round's assignment: the centroids, their groups, and how far each has moved since the bounds were made."""

    def __init__(self, centroids: np.ndarray, group: np.ndarray, moved: np.ndarray) -> None:
        self.centroids, self.group, self.moved = centroids, group, moved
        self.groups = int(group.max(initial=0)) + 1
        self.drift = np.array([moved[group == g].max(initial=0.0) for g in range(self.groups)])

    def __call__(self, v: np.ndarray, own: np.ndarray, upper: np.ndarray, lower: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, int]:
        """New clusters and bounds; and how many distances were computed."""
        upper, lower, own = upper + self.moved[own], np.maximum(lower - self.drift, 0.0), own.copy()
        above = lambda low, high: low > high + SLACK * (1 + high)
        rows = np.flatnonzero(~above(lower.min(1), upper))
        at = np.arange(len(rows))
        near = np.full((len(rows), len(self.centroids)), np.inf)
        exact = near if (squared(v[:1], self.centroids).dtype != object and int(abs(v).max(initial=0)) < EXACT) else np.full(near.shape, NEVER, object)
        for c in np.unique(own[rows]):  # the distance to its own centroid makes the upper bound tight
            mine = at[own[rows] == c]
            exact[mine, c] = squared(v[rows[mine]], self.centroids[c : c + 1])[:, 0]
            near[mine, c] = np.sqrt(exact[mine, c].astype(np.float64))
        upper[rows] = near[at, own[rows]]
        asked, low = len(rows), lower[rows]
        for g in range(self.groups):
            mine, of = at[~above(low[:, g], upper[rows])], np.flatnonzero(self.group == g)
            if len(mine) and len(of):
                exact[np.ix_(mine, of)] = found = squared(v[rows[mine]], self.centroids[of])
                near[np.ix_(mine, of)] = np.sqrt(found.astype(np.float64))
                low[mine, g] = np.inf
                asked += len(mine) * len(of)
        new = exact.argmin(1) if len(rows) else own[rows]  # ties: the smaller number
        upper[rows] = near[at, new]
        near[at, new] = np.inf
        for g in range(self.groups):
            lower[rows, g] = np.minimum(low[:, g], near[:, self.group == g].min(1, initial=np.inf))
        own[rows] = new
        return own, upper, lower, asked


def assigned(state: DataFrame, step: Step, dims: int) -> DataFrame:
    """``state`` after a round: vectors with clusters and bounds (total is null), and for each task and cluster a row whose total is
    the sum of its vectors, their number and their squared distances."""
    names = ["vec_id", "v", "cluster", "distance", "upper", "lower", "total"]
    kinds = [pa.int64(), pa.list_(pa.int64()), pa.int32(), pa.int64(), pa.float64(), pa.list_(pa.float64()), pa.list_(pa.decimal128(38, 0))]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sums = [[0] * (dims + 2) for _ in step.centroids]
        for batch in batches:
            n = batch.num_rows
            if not n:
                continue
            v = batch.column("v").flatten().to_numpy().reshape(n, dims)
            own, upper, lower, _ = step(v, batch.column("cluster").to_numpy(), batch.column("upper").to_numpy(), batch.column("lower").flatten().to_numpy().reshape(n, step.groups))
            distance = np.zeros(n, np.int64)
            for c in np.unique(own):
                mine = own == c
                far = squared(v[mine], step.centroids[c : c + 1])[:, 0]
                distance[mine] = [min(int(x), LONG) for x in far] if far.dtype == object else far.astype(np.int64)
                small = int(abs(v[mine]).max(initial=0)) < 1 << 40
                parts = v[mine].sum(0) if small else v[mine].astype(object).sum(0)
                sums[c] = [a + int(b) for a, b in zip(sums[c], [*parts, mine.sum(), sum(map(int, far))], strict=True)]
            yield pa.RecordBatch.from_arrays([batch.column("vec_id"), batch.column("v"), pa.array(own, pa.int32()), pa.array(distance), pa.array(upper), pa.array(list(lower), kinds[5]), pa.nulls(n, kinds[6])], names)
        rows = [(None, None, c, None, None, None, [Decimal(x) for x in s]) for c, s in enumerate(sums) if s[dims]]
        if rows:
            yield pa.RecordBatch.from_arrays([pa.array(x, t) for x, t in zip(zip(*rows, strict=True), kinds, strict=True)], names)

    return state.select(*names[:3], "upper", "lower").mapInArrow(run, "vec_id long, v array<long>, cluster int, distance long, upper double, lower array<double>, total array<decimal(38,0)>")


def totals(state: DataFrame, k: int, dims: int) -> list[list[int]]:
    """Each cluster's sums, number and squared distances: k times dims + 2 numbers."""
    out = [[0] * (dims + 2) for _ in range(k)]
    each = state.where("total IS NOT NULL").select("cluster", F.posexplode("total")).groupBy("cluster", "pos").agg(F.sum("col").alias("s"))
    for r in each.collect():
        out[r["cluster"]][r["pos"]] = int(r["s"])
    return out


def centroid_clusters(vectors: DataFrame, k: int = 8, rounds: int = 10, groups: int = 3, dims: int = 64, scale: int = 1024, seed: int = 3, key: str = "vec_id", vector: str = "embedding") -> DataFrame:
    """(vec_id, cluster, distance, cluster_inertia, inertia, centroid_sha256) of every vector of ``dims`` finite components, as integers
    floor(scale * x): ``rounds`` of k-means from the k vectors of least sha256 of ``seed:id``, then one more assignment. Centroids are exact
    floors of means, ties go to the smaller number, empty clusters keep their centroid.

    Only k times dims numbers go to the driver in a round, and k centroids to the tasks. The rounds end early when no centroid moves, as
    all later ones would give the same.

    Defined results: vectors that are null, of another length, or with null or non-finite components are left out; a null id counts as the
    empty text; repeated rows are vectors each, and equal hashes are ordered by the vectors; with fewer than k vectors there are fewer clusters;
    an empty table gives an empty table; other columns are ignored. Integers are exact within 64 bits, beyond which floor() ends; a
    distance or inertia over 2**63 - 1 is told as that.
    """
    scratch = Scratch(vectors.sparkSession, "kmeans")
    x = F.col("x").cast("array<double>")
    finite = lambda c: c.isNotNull() & ~F.isnan(c) & (F.abs(c) < float("inf"))
    kept = vectors.select(F.col(key).cast("long").alias("vec_id"), F.col(vector).alias("x")).where((F.size("x") == dims) & F.forall(x, finite))
    kept = kept.select("vec_id", F.transform(x, lambda c: F.floor(c * scale)).alias("v"))
    order = F.sha2(F.concat(F.lit(f"{seed}:"), F.coalesce(F.col("vec_id").cast("string"), F.lit(""))), 256)
    first = kept.select(order.alias("h"), "v").orderBy("h", "v").limit(k).collect()
    centroids = np.array([r["v"] for r in first], np.int64).reshape(-1, dims)
    k = len(centroids)
    group = groups_of(centroids, max(1, min(groups, k)))
    step = Step(centroids, group, np.zeros(max(k, 1)))
    state = kept.select("vec_id", "v", F.lit(0).alias("cluster"), F.lit(float("inf")).alias("upper"), F.array_repeat(F.lit(0.0), step.groups).alias("lower"))
    last = None
    for r in range(rounds + 1 if k else 0):
        written = scratch.write(assigned(state, step, dims), "state")
        if last is not None:
            scratch.drop(last)
        last, state = written, written.where("total IS NULL")
        sums = totals(written, k, dims)
        if r == rounds:
            break
        new = np.array([[s // t[dims] for s in t[:dims]] if t[dims] else list(c) for c, t in zip(centroids.tolist(), sums, strict=True)], np.int64)
        if (new == centroids).all():
            break
        moved = np.sqrt(((new.astype(np.float64) - centroids.astype(np.float64)) ** 2).sum(1)) * (1 + SLACK)
        centroids, step = new, Step(new, group, moved)
    if not k:
        return kept.selectExpr("vec_id", "0 AS cluster", "0L AS distance", "0L AS cluster_inertia", "0L AS inertia", "'' AS centroid_sha256").where("false")
    sha = [hashlib.sha256(",".join(map(str, c)).encode()).hexdigest() for c in centroids.tolist()]
    of = lambda xs: F.element_at(F.array(*[F.lit(x) for x in xs]), F.col("cluster") + 1)
    inertia = [min(t[dims + 1], LONG) for t in sums]
    out = state.select("vec_id", "cluster", "distance", of(inertia).cast("long").alias("cluster_inertia"), F.lit(min(sum(t[dims + 1] for t in sums), LONG)).cast("long").alias("inertia"), of(sha).alias("centroid_sha256"))
    out = materialize(out, "clusters")
    scratch.close()
    return out


def op12_centroid_clustering(spark: SparkSession, sf_dir: str) -> DataFrame:
    return centroid_clusters(table(spark, sf_dir, "embeddings"))


def _sql(rounds: int = 10) -> str:
    """Plain k-means, a step a round."""
    parts = ["""kept AS (SELECT row_number() OVER () AS r, vec_id, list_transform(embedding, lambda x: floor(1024 * x::DOUBLE)::BIGINT) AS v
  FROM embeddings WHERE len(embedding) = 64 AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0)""",
        "c0 AS MATERIALIZED (SELECT row_number() OVER (ORDER BY sha256('3:' || vec_id)) - 1 AS c, v FROM kept ORDER BY sha256('3:' || vec_id) LIMIT 8)"]
    for i in range(rounds + 1):
        parts.append(f"""a{i} AS MATERIALIZED (SELECT r, any_value(k.vec_id) AS vec_id, any_value(k.v) AS v, min({{'d': list_sum(list_transform(list_zip(k.v, c.v), lambda z: (z[1] - z[2]) * (z[1] - z[2])))::BIGINT, 'c': c.c}}) AS best
  FROM kept k, c{i} c GROUP BY r)""")
        if i < rounds:
            parts.append(f"""c{i + 1} AS MATERIALIZED (SELECT c, coalesce(m.v, o.v) AS v FROM c{i} o LEFT JOIN (
  SELECT c, list(((s - (s % n + n) % n) // n)::BIGINT ORDER BY i) AS v FROM (
    SELECT best.c AS c, i, sum(v[i]) AS s, count(*) AS n FROM a{i}, range(1, 65) AS g(i) GROUP BY 1, 2) GROUP BY 1) m USING (c))""")
    return "WITH " + ",\n".join(parts) + f"""
SELECT vec_id, best.c::INTEGER AS cluster, best.d AS distance, (sum(best.d) OVER (PARTITION BY best.c))::BIGINT AS cluster_inertia,
  (sum(best.d) OVER ())::BIGINT AS inertia, sha256(array_to_string(c.v, ',')) AS centroid_sha256
FROM a{rounds} JOIN c{rounds} c ON c.c = best.c
"""


OP12_SQL = _sql()
