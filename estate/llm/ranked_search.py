"""Ranked lexical search over norm buckets.

A query is a text; its terms weigh ``w`` (rarer terms more), and a document's
impact for a term is ``10^9 * tf div (1000 * tf + 12 * m)`` with ``m`` following
the document's length.  The score is their integer inner product.

Index: the impact vectors of the documents, over the terms of the queries only,
are ordered by length (each coordinate scaled by the square root of its term's
weight, as are the queries') and written in that order, so that a stretch of rows is a
bucket of nearly equal lengths, its longest known from Parquet's statistics.

Search, in rounds from the longest vectors to the shortest.  The k-th best score
so far is each query's threshold; it tightens inside a task and between rounds.

1. A round reads no row whose length times the longest query-to-threshold ratio
   stays below every threshold (a filter that reaches the scan).
2. A bucket is skipped for a query if ``|q| * |longest|`` (Cauchy-Schwarz) or the
   sum over the query's coordinates of ``q_t`` times the bucket's largest
   coordinate is below the threshold.
3. Inside, the query's heaviest coordinates are added up; what the others can add
   is at most the product of the remaining lengths, and at most the bucket's
   largest coordinates.  A document whose bound is below the threshold goes.
4. Survivors are rescored on all coordinates in 64-bit integers.

A task gives at most k rows a query; Spark's window keeps k of them, in part before
they are shuffled.  Queries go out in blocks of bounded vocabulary
(``BLOCK_QUERIES``, ``BLOCK_TERMS``), one after another, however many there are.

Defined results: a null text has no terms; queries without terms and queries with
null ids give no rows; an id that repeats among the queries keeps its smallest
text.  Documents are ranked row by row: repeated ids and null ids (last among
equals) take part, as do copies.  Very long texts are counted in bounded pieces.
Other columns are ignored; empty tables give an empty result.
"""

from __future__ import annotations

import math
from collections import Counter

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from estate.llm._ship import dropped, ship, slices, stored

SLICE_BYTES = 4 * 1024 * 1024
PIECE_BYTES = 1024 * 1024            # of one text split at once
BLOCK_QUERIES, BLOCK_TERMS = 2048, 200_000
BUCKET_ROWS = 2048                   # rows of a bucket
ROUNDS = (0.97, 0.8, 0.4)            # share of shorter vectors left by each round; the last takes the rest
FOCUS = 0.95                         # share of a query's squared length in the coordinates that are added up
SLACK = 1e-9                         # relative, for bounds computed in floats
NO_ID = np.iinfo(np.int64).max

# terms are runs of ASCII letters and digits and all other characters; A-Z are lower-cased
_FOLD = bytes(b + 32 if 65 <= b <= 90 else b if 48 <= b <= 57 or 97 <= b <= 122 or b >= 128 else 32 for b in range(256))


def terms(raw: bytes):
    """The terms of a UTF-8 text, in lists from bounded pieces."""
    raw, at = raw.translate(_FOLD), 0
    while len(raw) - at > PIECE_BYTES:
        cut = raw.find(b" ", at + PIECE_BYTES)
        if cut < 0:
            break
        yield raw[at:cut].split()
        at = cut
    yield (raw[at:] if at else raw).split()


def _counted_queries(batches):
    for b in batches:
        rows = []
        for t in b.column(1):
            found = Counter()
            for piece in terms((t.as_py() or "").encode()):
                found.update(piece)
            rows.append(sorted(found.items()))
        yield pa.RecordBatch.from_arrays(
            [b.column(0), pa.array([[w.decode() for w, _ in r] for r in rows], pa.list_(pa.string())),
             pa.array([[c for _, c in r] for r in rows], pa.list_(pa.int64()))], names=["query", "terms", "counts"])


def _counted(vocabulary):
    """Per document its number of terms, and the places in the vocabulary of
    those that are in it with their frequencies."""
    def run(batches):
        get = vocabulary.value.get
        for b in slices(batches, SLICE_BYTES, 1):
            n, sizes, places, tf = [], [0], [], []
            for t in b.column(1):
                total, found = 0, Counter()
                for piece in terms((t.as_py() or "").encode()):
                    total += len(piece)
                    found.update(map(get, piece))
                found.pop(None, None)
                n.append(total)
                places.extend(found)
                tf.extend(found.values())
                sizes.append(len(places))
            at = pa.array(sizes, pa.int32())
            yield pa.RecordBatch.from_arrays(
                [b.column(0), pa.array(n, pa.int64()), pa.ListArray.from_arrays(at, pa.array(places, pa.int32())),
                 pa.ListArray.from_arrays(at, pa.array(tf, pa.int64()))], names=["doc", "n", "terms", "tf"])
    return run


def _lists(col: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """Values and offsets of a list column without nulls."""
    off = col.offsets.to_numpy(zero_copy_only=False).astype(np.int64)
    return col.values.to_numpy(zero_copy_only=False)[off[0]:off[-1]], off - off[0]


def weight(n_docs: int, df: int) -> int:
    return math.floor(1000 * math.log((2 * n_docs + 2) / (2 * df + 1)))


def _impacts(weights, n_docs: int, n_terms: int):
    """Impacts and the length of the vector, scaled by the roots of the weights."""
    def run(batches):
        w = weights.value.astype(np.float64)
        for b in batches:
            places, off = _lists(b.column(2))
            tf, _ = _lists(b.column(3))
            n = b.column(1).to_numpy(zero_copy_only=False)
            m = np.repeat(100 - 25 + (25 * n * n_docs) // n_terms, np.diff(off))
            impact = (1_000_000_000 * tf) // (1000 * tf + 12 * m)
            squared = w[places] * impact.astype(np.float64) ** 2
            full = np.flatnonzero(np.diff(off))
            norm = np.zeros(len(n))
            if len(full):
                norm[full] = np.sqrt(np.add.reduceat(squared, off[full]))
            yield pa.RecordBatch.from_arrays(
                [b.column(0), b.column(2), pa.ListArray.from_arrays(pa.array(off, pa.int32()), pa.array(impact.astype(np.int32))),
                 pa.array(norm)], names=["doc", "terms", "impacts", "norm"])
    return run


class Queries:
    """Queries over places of a vocabulary, with bounds' ingredients."""

    def __init__(self, places: list[np.ndarray], counts: list[np.ndarray], weights: np.ndarray):
        self.flat = np.concatenate([*places, np.zeros(0, np.int64)]).astype(np.int64)
        self.weight = np.concatenate([weights[p] * c for p, c in zip(places, counts)] + [np.zeros(0, np.int64)])
        self.start = np.concatenate([[0], np.cumsum([len(p) for p in places])]).astype(np.int64)
        self.root = weights.astype(np.float64)
        self.norm = np.zeros(len(places))
        self.focus = []                                # per query: coordinates, heaviest first, and the rest's length
        for q, (p, c) in enumerate(zip(places, counts)):
            square = weights[p].astype(np.float64) * c.astype(np.float64) ** 2
            self.norm[q] = math.sqrt(square.sum())
            order = np.argsort(-square, kind="stable")
            take = int(np.searchsorted(np.cumsum(square[order]), FOCUS * square.sum())) + 1
            heavy, light = order[:take], order[take:]
            self.focus.append((p[heavy], (weights[p] * c)[heavy], p[light], (weights[p] * c)[light], math.sqrt(square[light].sum())))

    def __len__(self):
        return len(self.norm)


class Bucket:
    """Impact vectors of nearly equal length, by row and by coordinate."""

    def __init__(self, docs: np.ndarray, places: np.ndarray, off: np.ndarray, impacts: np.ndarray, norms: np.ndarray, size: int):
        self.docs, self.places, self.off, self.impacts, self.norms = docs, places, off, impacts.astype(np.int64), norms
        self.longest = norms.max()
        order = np.argsort(places, kind="stable")
        self.row = np.repeat(np.arange(len(docs)), np.diff(off))[order]
        self.value = self.impacts[order]
        self.begin = np.searchsorted(places[order], np.arange(size + 1))
        self.most = np.zeros(size, np.int64)
        full = np.flatnonzero(np.diff(self.begin))
        if len(full):
            self.most[full] = np.maximum.reduceat(self.value, self.begin[full])

    def bounds(self, queries: Queries) -> np.ndarray:
        """What no document of the bucket can exceed, for each query."""
        by_norm = queries.norm * self.longest * (1 + SLACK)
        reach = np.concatenate([[0], np.cumsum(queries.weight * self.most[queries.flat])])
        return np.minimum(by_norm, reach[queries.start[1:]] - reach[queries.start[:-1]])

    def survivors(self, queries: Queries, q: int, least: float) -> np.ndarray:
        """Rows whose bound reaches ``least``: the heaviest coordinates exactly,
        the others by the lengths that remain."""
        places, weights, light, light_weights, rest = queries.focus[q]
        sums, seen = np.zeros(len(self.docs)), np.zeros(len(self.docs))
        for p, w in zip(places.tolist(), weights.tolist()):
            a, b = self.begin[p], self.begin[p + 1]
            if a < b:
                row, value = self.row[a:b], self.value[a:b].astype(np.float64)
                sums[row] += w * value
                seen[row] += queries.root[p] * value * value
        left = np.sqrt(np.maximum(self.norms * self.norms * (1 + SLACK) - seen, 0))
        more = np.minimum(rest * left, float((light_weights * self.most[light]).sum()))
        return np.flatnonzero((sums + more) * (1 + SLACK) >= least)

    def scores(self, queries: Queries, q: int, rows: np.ndarray, dense: np.ndarray) -> np.ndarray:
        """Exact scores of rows; ``dense`` is a zeroed vector of the vocabulary."""
        span = slice(queries.start[q], queries.start[q + 1])
        dense[queries.flat[span]] = queries.weight[span]
        n = np.diff(self.off)[rows]
        ends = np.cumsum(n)
        at = np.repeat(self.off[rows] - (ends - n), n) + np.arange(ends[-1] if len(ends) else 0)
        each = np.concatenate([[0], np.cumsum(dense[self.places[at]] * self.impacts[at])])
        dense[queries.flat[span]] = 0
        return each[ends] - each[ends - n]


def _search(queries, least, k: int, size: int):
    """The best k of each query among a task's rows, bucket after bucket.
    ``least``: the thresholds that earlier rounds reached (1: none)."""
    def run(batches):
        qs, floor = queries.value, least.copy()
        best = [(np.zeros(0, np.int64), np.zeros(0, np.int64)) for _ in range(len(qs))]     # scores, docs
        dense = np.zeros(size, np.int64)
        for whole in batches:
            for at in range(0, whole.num_rows, BUCKET_ROWS):
                b = whole.slice(at, BUCKET_ROWS)
                docs = b.column(0).fill_null(NO_ID).to_numpy(zero_copy_only=False)
                places, off = _lists(b.column(1))
                impacts, _ = _lists(b.column(2))
                bucket = Bucket(docs, places, off, impacts, b.column(3).to_numpy(zero_copy_only=False), size)
                for q in np.flatnonzero(bucket.bounds(qs) >= floor).tolist():
                    rows = bucket.survivors(qs, q, floor[q])
                    scores = bucket.scores(qs, q, rows, dense)
                    good = scores >= floor[q]
                    if not good.any():
                        continue
                    s = np.concatenate([best[q][0], scores[good]])
                    d = np.concatenate([best[q][1], docs[rows[good]]])
                    keep = np.lexsort((d, -s))[:k]
                    best[q] = s[keep], d[keep]
                    if len(keep) == k:
                        floor[q] = max(floor[q], best[q][0][-1])
        n = [len(s) for s, _ in best]
        made = [np.concatenate([x[i] for x in best] + [np.zeros(0, np.int64)]) for i in (1, 0)]
        docs = pa.array(made[0], pa.int64(), mask=made[0] == NO_ID)
        yield pa.RecordBatch.from_arrays([pa.array(np.repeat(np.arange(len(qs)), n), pa.int32()), docs, pa.array(made[1])],
                                         names=["at", "doc", "score"])
    return run


def _best(found: DataFrame, k: int) -> DataFrame:
    order = Window.partitionBy("at").orderBy(F.col("score").desc(), F.col("doc").asc_nulls_last())
    return found.withColumn("rank", F.row_number().over(order)).filter(F.col("rank") <= k)


def index(docs: DataFrame, vocabulary: dict[bytes, int], id_col: str, text_col: str):
    """Impact vectors over ``vocabulary``, longest first, stored; and the
    weights of its terms.  None if no document has a term."""
    spark = docs.sparkSession
    shared = spark.sparkContext.broadcast(vocabulary)          # at most BLOCK_TERMS terms
    counted = stored(docs.select(F.col(f"`{id_col}`").cast("long").alias("doc"), F.col(f"`{text_col}`").cast("string").alias("text"))
                     .mapInArrow(_counted(shared), "doc long, n long, terms array<int>, tf array<long>"), "search-terms")
    n_docs, n_terms = counted.agg(F.count(F.when(F.col("n") > 0, 1)), F.coalesce(F.sum("n"), F.lit(0))).first()
    df = np.zeros(len(vocabulary), np.int64)
    for r in counted.select(F.explode("terms").alias("t")).groupBy("t").count().collect():      # one row a term
        df[r.t] = r["count"]
    weights = np.array([weight(n_docs, int(x)) for x in df], np.int64)
    if not n_docs:
        dropped(counted)
        return None, weights
    vectors = counted.filter(F.size("terms") > 0).mapInArrow(
        _impacts(spark.sparkContext.broadcast(weights), n_docs, n_terms), "doc long, terms array<int>, impacts array<int>, norm double")
    # rows of one length are dealt by a hash of the id, so none of them crowd a task
    ordered = (vectors.filter("norm > 0").withColumn("deal", F.xxhash64("doc"))
               .repartitionByRange(F.col("norm").desc(), "deal").sortWithinPartitions(F.col("norm").desc()).drop("deal"))
    out = stored(ordered, "search-index")
    dropped(counted)
    return out, weights


def _block(docs: DataFrame, queries: list, k: int, id_col: str, text_col: str) -> DataFrame | None:
    """``at, doc, score, rank`` of queries (id, terms, counts)."""
    spark = docs.sparkSession
    vocabulary: dict[bytes, int] = {}
    places = [np.array([vocabulary.setdefault(t.encode(), len(vocabulary)) for t in q.terms], np.int64) for q in queries]
    vectors, weights = index(docs, vocabulary, id_col, text_col)
    if vectors is None:
        return None
    qs = Queries(places, [np.array(q.counts, np.int64) for q in queries], weights)
    shared, size = spark.sparkContext.broadcast(qs), len(vocabulary)
    cuts = vectors.agg(F.percentile_approx("norm", [float(x) for x in ROUNDS], 1000)).first()[0] or []
    least = np.ones(len(qs), np.int64)                 # only scores above 0 count
    best = None
    for high, low in zip([None, *cuts], [*cuts, None]):
        # no vector shorter than this can reach any query's threshold
        reach = np.where(qs.norm > 0, least / np.maximum(qs.norm, 1e-300), np.inf).min(initial=np.inf) * (1 - SLACK)
        rows = vectors.filter(F.col("norm") >= float(reach if low is None else max(low, reach)))
        if high is not None:
            rows = rows.filter(F.col("norm") < high)
        found = rows.mapInArrow(_search(shared, least, k, size), "at int, doc long, score long")
        before = best
        if before is not None:
            found = found.unionByName(before.drop("rank"))
        best = stored(_best(found, k), "search-best")
        if before is not None:
            dropped(before)
        for r in best.filter(F.col("rank") == k).select("at", "score").collect():     # one row a query
            least[r["at"]] = max(least[r["at"]], r["score"])
    dropped(vectors)
    return best


def search(docs: DataFrame, queries: DataFrame, k: int = 20, doc_id: str = "doc_id", doc_text: str = "text",
           query_id: str = "item_id", query_text: str = "text") -> DataFrame:
    """``query_id, rank, doc_id, score``: the ``k`` best documents of every query
    with a score above 0, equal scores by ascending id."""
    spark = docs.sparkSession
    ship(spark)
    kind = queries.schema[query_id].dataType.simpleString()
    one = (queries.select(F.col(f"`{query_id}`").alias("query"), F.col(f"`{query_text}`").cast("string").alias("text"))
           .filter(F.col("query").isNotNull()).groupBy("query").agg(F.min("text").alias("text")))
    counted = stored(one.mapInArrow(_counted_queries, f"query {kind}, terms array<string>, counts array<long>")
                     .filter(F.size("terms") > 0), "search-queries")
    n, total = counted.agg(F.count("*"), F.coalesce(F.sum(F.size("terms")), F.lit(0))).first()
    blocks = math.ceil(max(n / BLOCK_QUERIES, total / BLOCK_TERMS))
    out = spark.createDataFrame([], f"`{query_id}` {kind}, rank int, `{doc_id}` long, score long")
    for b in range(blocks):
        part = counted if blocks == 1 else counted.filter(F.pmod(F.xxhash64("query"), F.lit(blocks)) == b)
        block = part.orderBy("query").collect()
        best = _block(docs, block, k, doc_id, doc_text)
        if best is not None:
            ids = spark.createDataFrame([(i, q["query"]) for i, q in enumerate(block)], f"at int, query {kind}")
            out = out.unionByName(best.join(ids, "at").select(F.col("query").alias(query_id), "rank", F.col("doc").alias(doc_id), "score"))
    return out
