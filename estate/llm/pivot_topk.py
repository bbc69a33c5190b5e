"""Exact top-k search with a pivot-distance index.

Component ``x`` becomes the integer ``floor(scale * x)``; the score of two
vectors is their integer inner product.  Largest products become nearest
neighbours by one more coordinate: with ``M`` the largest squared norm, a
candidate ``c`` gets ``sqrt(M - |c|^2)`` and a query 0, and then

    dist(q, c)^2 = |q|^2 + M - 2 * score(q, c).

Index: ``pivots`` (a bounded sample, the k-means centres of at most
``SAMPLE_ROWS`` vectors) split the space; a vector is keyed by its nearest pivot
and its distance to it, and the vectors of a pivot, sorted by distance, are cut
into annuli of about ``ANNULUS`` vectors - many vectors at one distance are cut
by id, so an annulus is bounded even if a third of all vectors are equal.

Search, in two expansions:

1. every query compares itself with its home annulus, the one of its nearest
   pivot around its own distance; the k-th best score there bounds its radius;
2. the triangle inequality, ``dist(q, c) >= |dist(q, p) - dist(c, p)|``, gives
   the range of distances around every pivot that can still hold a better or
   equal score; only annuli in range are searched.

Queries are packed in blocks, so every comparison is one small matrix product
of bounded size.  Products are exact in 64-bit floats while
``dim * (scale * max|x|)^2 < 2^53``, which is checked.

Defined results: vectors that are null or hold null or non-finite components
take no part.  Vectors shorter than the longest count as padded with zeros.  An
id that repeats keeps its smallest vector (by array order); a null id takes no
part.  Ties go to the smaller id.  Other columns are ignored; with fewer than k
candidates all are returned; an empty table gives an empty result.
"""

from __future__ import annotations

import math

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from estate.llm._ship import release, ship, stored

PIVOTS = 32
SAMPLE_ROWS = 4096       # vectors the pivots are fitted on, by hash order of the id
ANNULUS = 1024           # vectors of an annulus
RINGS = 64               # rings of a pivot at most
BLOCK = 512              # queries compared at once
SLACK = 1e-6             # relative, for distances computed in floats


def quantised(vec: Column, scale: int) -> Column:
    """``floor(scale * x)`` of every component, as array<long>."""
    return F.transform(vec, lambda x: F.floor(x.cast("double") * F.lit(float(scale))))


def _usable(vec: Column) -> Column:
    bad = F.exists(vec, lambda x: x.isNull() | F.isnan(x.cast("double")) | (F.abs(x.cast("double")) == F.lit(math.inf)))
    return vec.isNotNull() & ~F.coalesce(bad, F.lit(True))


def matrix(col: pa.ListArray, dim: int) -> np.ndarray:
    """Rows of a list column as floats, padded with zeros to ``dim``."""
    if isinstance(col, pa.ChunkedArray):
        col = col.combine_chunks()
    n = col.value_lengths().to_numpy(zero_copy_only=False)
    flat = col.flatten().to_numpy(zero_copy_only=False).astype(np.float64)
    out = np.zeros((len(col), dim))
    row = np.repeat(np.arange(len(n)), n)
    out[row, np.arange(len(flat)) - np.repeat(np.cumsum(n) - n, n)] = flat
    return out


def fit_pivots(sample: np.ndarray, most: float, pivots: int, rounds: int = 8) -> np.ndarray:
    """k-means centres of the sample, each vector with its added coordinate."""
    x = _lifted(sample, most)
    x = np.unique(x, axis=0)
    if not len(x):
        return np.zeros((1, sample.shape[1] + 1))
    rng = np.random.default_rng(11)
    centres = x[rng.choice(len(x), min(pivots, len(x)), replace=False)]
    for _ in range(rounds):
        near = _distances(x, centres).argmin(1)
        centres = np.array([x[near == k].mean(0) if (near == k).any() else c for k, c in enumerate(centres)])
    return centres


def _lifted(x: np.ndarray, most: float) -> np.ndarray:
    return np.hstack([x, np.sqrt(np.maximum(most - (x * x).sum(1), 0))[:, None]])


def _distances(x: np.ndarray, centres: np.ndarray) -> np.ndarray:
    sq = (x * x).sum(1)[:, None] + (centres * centres).sum(1) - 2 * x @ centres.T
    return np.sqrt(np.maximum(sq, 0))


def _keys(centres: np.ndarray, most: float, dim: int):
    def run(batches):
        for b in batches:
            d = _distances(_lifted(matrix(b.column(1), dim), most), centres)
            near = d.argmin(1)
            yield pa.RecordBatch.from_arrays([b.column(0), b.column(1), pa.array(near.astype(np.int32)),
                                              pa.array(d[np.arange(len(near)), near])], names=["id", "vec", "pivot", "dist"])
    return run


def _query_keys(centres: np.ndarray, dim: int):
    def run(batches):
        for b in batches:
            x = matrix(b.column(1), dim)
            d = _distances(np.hstack([x, np.zeros((len(x), 1))]), centres)
            yield pa.RecordBatch.from_arrays(
                [b.column(0), b.column(1), pa.array(list(d), pa.list_(pa.float64())), pa.array((x * x).sum(1))],
                names=["q", "q_vec", "q_dist", "q_norm"])
    return run


def _best(k: int, dim: int):
    """The k best candidates of one annulus for each query of one block."""
    schema = pa.schema([("q", pa.int64()), ("id", pa.int64()), ("score", pa.int64())])

    def run(left: pa.Table, right: pa.Table) -> pa.Table:
        if not left.num_rows or not right.num_rows:
            return schema.empty_table()
        ids = left["id"].to_numpy()
        order = np.argsort(ids, kind="stable")           # so that ties go to the smaller id
        ids, x = ids[order], matrix(left["vec"], dim)[order]
        qs = right["q"].to_numpy()
        out = []
        scores = matrix(right["q_vec"], dim) @ x.T
        for q, s in zip(qs.tolist(), scores):
            s = np.where(ids == q, -np.inf, s)
            keep = min(k, len(s))
            least = np.partition(s, len(s) - keep)[len(s) - keep]
            above, equal = np.flatnonzero(s > least), np.flatnonzero(s == least)
            at = np.concatenate([above, equal[:keep - len(above)]])
            at = at[np.isfinite(s[at])]
            out.append((np.full(len(at), q), ids[at], s[at].astype(np.int64)))
        return pa.table([pa.array(np.concatenate([o[i] for o in out])) for i in range(3)], schema=schema)
    return run


def _search(annuli: DataFrame, probes: DataFrame, k: int, dim: int) -> DataFrame:
    """``q, id, score`` of the best of every probed annulus.  An annulus meets
    the queries that probe it in blocks of ``BLOCK``."""
    sizes = probes.groupBy("annulus").agg(F.count("*").alias("probes"))
    blocks = F.ceil(F.col("probes") / BLOCK).cast("int")
    dealt = (probes.join(sizes, "annulus")
             .withColumn("block", F.pmod(F.xxhash64("q"), blocks.cast("long")).cast("int")).drop("probes"))
    copies = annuli.join(sizes, "annulus").withColumn("block", F.explode(F.sequence(F.lit(0), blocks - 1)))
    return (copies.select("annulus", "block", "id", "vec").groupBy("annulus", "block")
            .cogroup(dealt.select("annulus", "block", "q", "q_vec").groupBy("annulus", "block"))
            .applyInArrow(_best(k, dim), "q long, id long, score long"))


def _ranked(found: DataFrame, k: int) -> DataFrame:
    """The k best of each query: an array of bounded size per query."""
    best = F.slice(F.sort_array(F.collect_list(F.struct((-F.col("score")).alias("s"), F.col("id")))), 1, k)
    return found.groupBy("q").agg(best.alias("best"))


def top_k(vectors: DataFrame, k: int = 5, is_query: Column | None = None, scale: int = 256,
          id_col: str = "vec_id", vec_col: str = "embedding", pivots: int = PIVOTS) -> DataFrame:
    """``query_id, rank, id_col, score``: the ``k`` highest scores of every
    query (rows where ``is_query`` holds; all rows if None) among all other rows."""
    spark = vectors.sparkSession
    ship(spark)
    flag = F.lit(True) if is_query is None else F.coalesce(is_query, F.lit(False))
    vec = F.col(f"`{vec_col}`")
    clean = (vectors.select(F.col(f"`{id_col}`").cast("long").alias("id"), vec.alias("raw"), flag.alias("is_query"))
             .filter(F.col("id").isNotNull() & _usable(F.col("raw")))
             .groupBy("id", "is_query").agg(F.min("raw").alias("raw"))
             .select("id", "is_query", quantised(F.col("raw"), scale).alias("vec")))
    clean = stored(clean.withColumn("norm", F.aggregate("vec", F.lit(0).cast("long"), lambda s, x: s + x * x)), "topk-vectors")
    dim, most = clean.agg(F.max(F.size("vec")), F.max("norm")).first()
    if dim is None:
        return spark.createDataFrame([], f"query_id long, rank int, `{id_col}` long, score long")
    if most >= 2 ** 52:
        raise ValueError("components too large for exact products in 64-bit floats")
    sample = [r.vec for r in clean.orderBy(F.xxhash64("id")).limit(SAMPLE_ROWS).select("vec").collect()]
    centres = fit_pivots(np.array([list(v) + [0] * (dim - len(v)) for v in sample], np.float64), float(most), pivots)

    # index: pivot and distance, cut into annuli of bounded size
    keyed = stored(clean.select("id", "vec").mapInArrow(_keys(centres, float(most), dim),
                                                        "id long, vec array<long>, pivot int, dist double"), "topk-keys")
    annuli = stored(_annuli(keyed), "topk-annuli")
    bounds = annuli.groupBy("annulus", "pivot").agg(F.min("dist").alias("lo"), F.max("dist").alias("hi"))
    bounds = stored(bounds, "topk-bounds")
    queries = stored(clean.filter("is_query").select("id", "vec").mapInArrow(
        _query_keys(centres, dim), "q long, q_vec array<long>, q_dist array<double>, q_norm double"), "topk-queries")

    # 1. the annulus around the query's own distance to its nearest pivot
    # (annulus bounds of one pivot lie side by side: the nearest one is a grouped minimum)
    home = queries.select("q", "q_vec", F.array_position("q_dist", F.array_min("q_dist")).cast("int").alias("at"), F.array_min("q_dist").alias("d"))
    away = F.greatest(F.col("lo") - F.col("d"), F.col("d") - F.col("hi"), F.lit(0.0))
    first = (home.join(bounds, F.col("at") - 1 == F.col("pivot"))
             .groupBy("q").agg(F.min_by("annulus", F.struct(away, F.col("annulus"))).alias("annulus"), F.first("q_vec").alias("q_vec")))
    first = stored(first, "topk-first")
    found = stored(_ranked(_search(annuli, first, k, dim), k), "topk-first")

    # 2. all annuli that can hold a score as good as the k-th so far
    radius = F.when(F.size("best") >= k, F.sqrt(F.greatest(F.col("q_norm") + F.lit(float(most))
                                                           + 2 * F.element_at("best", -1)["s"].cast("double"), F.lit(0.0)))
                    * (1 + SLACK) + SLACK).otherwise(F.lit(math.inf))
    reach = (queries.join(found, "q", "left").join(first.select("q", F.col("annulus").alias("done")), "q", "left")
             .withColumn("best", F.coalesce("best", F.array().cast("array<struct<s:long,id:long>>")))
             .select("q", "q_vec", "done", radius.alias("r"), F.posexplode("q_dist").alias("pivot", "d")))
    probes = (reach.join(bounds, "pivot")
              .filter((F.col("lo") <= F.col("d") + F.col("r")) & (F.col("hi") >= F.col("d") - F.col("r"))
                      & ~F.col("annulus").eqNullSafe(F.col("done")))
              .select("annulus", "q", "q_vec"))
    rest = _search(annuli, stored(probes, "topk-probes"), k, dim)
    release(spark)
    both = rest.unionByName(found.select("q", F.explode("best").alias("b")).select("q", F.col("b.id").alias("id"), (-F.col("b.s")).alias("score")))
    return (_ranked(both, k).select(F.col("q").alias("query_id"), F.posexplode("best").alias("at", "b"))
            .select("query_id", (F.col("at") + 1).alias("rank"), F.col("b.id").alias(id_col), (-F.col("b.s")).alias("score")))


def _annuli(keyed: DataFrame) -> DataFrame:
    """``annulus, pivot, dist, id, vec``: each pivot's vectors cut by distance
    quantiles into at most ``RINGS`` rings, as many as its size asks for, and a
    ring larger than an annulus (vectors at one distance, or a very large pivot)
    by a hash of the id."""
    cuts = F.percentile_approx("dist", [i / RINGS for i in range(1, RINGS)], 2000)
    rings = keyed.groupBy("pivot").agg(cuts.alias("cuts"), F.least(F.ceil(F.count("*") / ANNULUS), F.lit(RINGS)).alias("rings"))
    at = F.size(F.filter("cuts", lambda c: c < F.col("dist")))
    ringed = (keyed.join(rings, "pivot").withColumn("ring", F.floor(at * F.col("rings") / RINGS)).drop("cuts", "rings"))
    counts = ringed.groupBy("pivot", "ring").agg(F.count("*").alias("n"))
    return (ringed.join(counts, ["pivot", "ring"])
            .withColumn("part", F.pmod(F.xxhash64("id"), F.ceil(F.col("n") / ANNULUS).cast("long")))
            .select(F.concat_ws("-", "pivot", "ring", "part").alias("annulus"), "pivot", "dist", "id", "vec"))
