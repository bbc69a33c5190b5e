"""MinHash near-dedup with an LSH forest.

A document's set holds its distinct shingles of ``width`` words.  Documents
with equal sets form one class; each class has a signature of ``TREES * DEPTH``
minimum hashes.  The forest is ``TREES`` sorted orders of the signatures, each
reading them from another starting block, so that the first ``DEPTH`` hashes of
all trees are different hashes.

Candidates come from the longest common prefixes in the sorted orders:

1. *neighbours*: every tree is range-sorted by prefix and class (ties are split
   by class, so a prefix shared by very many classes still spreads over tasks),
   and neighbours that share at least ``least_depth`` hashes are candidates.
   A class checks its best neighbour of all trees first; the links found join
   classes to provisional components, and then the neighbours of different
   components are checked.
2. *regions*: classes that share ``least_depth`` hashes with one of another
   component are all joined, whatever the size of their region, by an exact
   prefix filter: each set is put in order of its shingles' frequency among
   these classes, rarest first, and a pair that is similar enough shares a
   shingle within the first few of both.  A bitmap of each set bounds how much a
   pair can have in common before it is built.  Both only drop pairs that can't
   be similar enough.

All candidates are confirmed on the full shingle sets.  Pairs whose set sizes
alone rule the similarity out are never built.  Components are computed over
the confirmed links (:mod:`estate.llm.components`).

Defined results: a null or empty text, or one without words, has an empty set,
links with nothing and is its own component.  With fewer words than ``width``
the whole sequence is the one shingle.  Rows that share an id are versions of
one document and share a component.  A row with a null id gets a null component
if no other row has its set, and is kept.  Other columns are ignored; an empty
table gives an empty result.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from estate.llm._ship import release, ship, slices, stored, string_parts, tidied
from estate.llm.components import components, extended
from estate.llm.cover import Rolling, _BYTE, mixed, word_bounds

TREES = 16
DEPTH = 4             # hashes that a tree has to itself; it reads on into the others' blocks
LEAST_DEPTH = 4       # hashes that make a region
DEEPEST = 16          # hashes that an order is sorted by
BITMAP = 1024         # bits of a set's bitmap
DEALT = 512           # classes of one shingle that a task joins with all others
MARKS = 32            # bits that a class has in the marks that choose texts
CHUNK = 8 * 4096      # bits of one chunk of marks (what bitmap_construct_agg holds)
CHUNKS = 4096         # chunks at most (16 MB)
SLICE_BYTES = 256 * 1024   # of text that a task turns into shingles at once (some 60 bytes each)
HASHES = TREES * DEPTH
_SEEDS = mixed(np.arange(1, HASHES + 1, dtype=np.uint64))
_STEPS = mixed(np.arange(1001, 1001 + HASHES, dtype=np.uint64)) | np.uint64(1)


def shingles(raw: np.ndarray, off: np.ndarray, width: int, fold_case: bool = True) -> tuple[np.ndarray, np.ndarray]:
    """Distinct shingle hashes of concatenated documents, sorted within each
    document, and the documents' offsets among them."""
    if fold_case:
        raw = np.where((raw >= 65) & (raw <= 90), raw + 32, raw)
    starts, ends, docs = word_bounds(raw, off)
    words = Rolling(_BYTE[raw]).at(starts, ends - starts) + (ends - starts).astype(np.uint64)
    n = np.diff(docs)
    rolling = Rolling(words)
    # every start with `width` words left in its document; short documents whole
    left = np.repeat(docs[1:], n) - np.arange(len(words))
    first = np.zeros(len(words), bool)
    first[docs[:-1][n > 0]] = True
    at = np.flatnonzero((left >= width) | first)
    owner = np.searchsorted(docs, at, "right") - 1
    h = rolling.at(at, np.minimum(left[at], width)) + np.minimum(left[at], width).astype(np.uint64)
    order = np.lexsort((h, owner))
    h, owner = h[order], owner[order]
    keep = np.concatenate([[True], (h[1:] != h[:-1]) | (owner[1:] != owner[:-1])])[:len(h)]
    h, owner = h[keep], owner[keep]
    return h, np.searchsorted(owner, np.arange(len(off)))


def signatures(h: np.ndarray, cuts: np.ndarray) -> np.ndarray:
    """``HASHES`` minimum hashes (16 bits each) of every non-empty set."""
    out = np.empty((len(cuts), HASHES), ">u2")
    for j in range(HASHES):
        least = np.minimum.reduceat((h ^ _SEEDS[j]) * _STEPS[j], cuts)
        out[:, j] = (mixed(least) >> np.uint64(48)).astype(np.uint16)
    return out


def _signed(width: int, fold_case: bool):
    names = ["id", "n", "k1", "k2", "sig"]

    def run(batches):
        for b in slices(batches, SLICE_BYTES):
            raw, off = string_parts(b.column(1))
            h, at = shingles(raw, off, width, fold_case)
            n = np.diff(at)
            some = np.flatnonzero(n)
            k1, k2 = np.zeros((2, len(n)), np.uint64)
            sig = [None] * len(n)
            if len(some):
                cuts = at[:-1][some]
                k1[some], k2[some] = np.add.reduceat(mixed(h), cuts), np.add.reduceat(mixed(h ^ _SEEDS[0]) * _STEPS[1], cuts)
                table = signatures(h, cuts)
                for i, d in enumerate(some.tolist()):
                    sig[d] = table[i].tobytes()
            yield pa.RecordBatch.from_arrays([b.column(0), pa.array(n, pa.int64()), pa.array(k1.view(np.int64)),
                                              pa.array(k2.view(np.int64)), pa.array(sig, pa.binary())], names=names)
    return run


def _tree(sig: Column, tree: int) -> Column:
    """The signature as tree ``tree`` reads it: rotated by its block, cut to
    the deepest level."""
    start, length = 2 * DEPTH * tree, 2 * DEEPEST
    return F.substring(F.concat(sig, sig), start + 1, length)


def _shared(a: bytes, b: bytes) -> int:
    """Length of the common prefix, in hashes."""
    if a == b:
        return len(a) // 2
    k = 0
    while a[2 * k:2 * k + 2] == b[2 * k:2 * k + 2]:
        k += 1
    return k


CUT = "kind int, tree int, prefix binary, id long, n long, other long, other_n long, depth int"
CUT_TYPES = (pa.int32(), pa.int32(), pa.binary(), pa.int64(), pa.int64(), pa.int64(), pa.int64(), pa.int32())


def _neighbours(least_depth: int):
    """Pairs of neighbours in a sorted partition (kind -1), and its two ends."""
    names = [c.split()[0] for c in CUT.split(", ")]

    def batch(rows):
        return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*rows), CUT_TYPES)], names=names)

    def run(batches):
        last, rows = None, []
        for b in batches:
            for now in zip(*(b.column(i).to_pylist() for i in range(5))):
                part, tree, prefix, i, n = now
                if last is None:
                    rows.append((2 * part, tree, prefix, i, n, None, None, None))
                elif last[1] == tree:
                    k = _shared(last[2], prefix)
                    if k >= least_depth:
                        rows.append((-1, None, None, i, n, last[3], last[4], k))
                last = now
            if len(rows) > 50_000:
                yield batch(rows)
                rows = []
        if last is not None:
            rows.append((2 * last[0] + 1, last[1], last[2], last[3], last[4], None, None, None))
        if rows:
            yield batch(rows)
    return run


def _adjacent(cut: DataFrame, least_depth: int) -> DataFrame:
    """All neighbours ``id, n, other, other_n, depth``; those in different
    partitions come from a partition's last row and the next one's first (two
    rows for each partition)."""
    from pyspark.sql import Window
    ends = cut.filter("kind >= 0").select("kind", "tree", "prefix", "id", "n")
    w = Window.orderBy("kind")
    prior = {c: F.lag(c).over(w).alias(f"p_{c}") for c in ("tree", "prefix", "id", "n")}
    pairs = ends.select("*", *prior.values()).filter((F.col("kind") % 2 == 0) & (F.col("tree") == F.col("p_tree")))
    same = F.col("prefix").substr(1, 2 * least_depth) == F.col("p_prefix").substr(1, 2 * least_depth)
    across = pairs.filter(same).select("id", "n", F.col("p_id").alias("other"), F.col("p_n").alias("other_n"), F.lit(least_depth).alias("depth"))
    return (cut.filter("kind < 0").select("id", "n", "other", "other_n", "depth").unionByName(across).filter("id <> other"))


def _marked(rows: DataFrame, ids: DataFrame) -> DataFrame:
    """The rows of every id in ``ids``, and a few others: each id sets one bit,
    and the chunks of bits are broadcast.  An exact join follows, which then
    shuffles the texts of few rows instead of all.  Beyond ``CHUNKS`` chunks the
    bits get crowded and more rows pass, but none is lost."""
    chunks = min(CHUNKS, max(1, -(-MARKS * ids.count() // CHUNK)))
    bit = F.pmod(F.xxhash64("id"), F.lit(chunks * CHUNK))
    at = F.pmod(bit, F.lit(CHUNK))
    chunk = F.floor(bit / CHUNK).alias("chunk")
    marks = ids.select(chunk, at.alias("at")).repartition("chunk").groupBy("chunk").agg(F.bitmap_construct_agg("at").alias("marks"))
    names = rows.columns
    byte = F.conv(F.hex(F.substring("marks", (F.floor(at / 8) + 1).cast("int"), F.lit(1))), 16, 10).cast("int")
    return (rows.select("*", chunk).join(F.broadcast(marks), "chunk")
            .filter(F.getbit(byte, F.pmod(at, F.lit(8)).cast("int")) == 1).select(names))


def _sizes_fit(a: str, b: str, percent: int) -> Column:
    return F.least(a, b) * 100 >= F.greatest(a, b) * percent


def _confirm(width: int, fold_case: bool, percent: int):
    def run(batches):
        for b in batches:
            for s in slices([b], SLICE_BYTES, text=2):
                sets = []
                for c in (2, 3):
                    raw, off = string_parts(s.column(c))
                    h, at = shingles(raw, off, width, fold_case)
                    sets.append([h[x:y] for x, y in zip(at[:-1], at[1:])])
                ok = []
                for x, y in zip(*sets):
                    both = len(np.intersect1d(x, y, assume_unique=True))
                    ok.append(both > 0 and 100 * both >= percent * (len(x) + len(y) - both))
                if any(ok):
                    keep = pa.array(ok)
                    yield pa.RecordBatch.from_arrays([s.column(0).filter(keep), s.column(1).filter(keep)], names=["a", "b"])
    return run


def _linked(pairs: DataFrame, texts: DataFrame, width: int, fold_case: bool, percent: int) -> DataFrame:
    """The pairs ``(a, b)`` whose full sets are similar enough."""
    ta = texts.select(F.col("id").alias("a"), F.col("text").alias("text_a"))
    tb = texts.select(F.col("id").alias("b"), F.col("text").alias("text_b"))
    return (pairs.join(ta, "a").join(tb, "b").select("a", "b", "text_a", "text_b")
            .mapInArrow(tidied(_confirm(width, fold_case, percent), "near_duplicates"), "a long, b long"))


def _apart(pairs: DataFrame, comp: DataFrame) -> DataFrame:
    """The pairs whose ends lie in different components."""
    for c in ("a", "b"):
        pairs = pairs.join(comp.select(F.col("node").alias(c), F.col("component").alias(f"c_{c}")), c, "left")
    return pairs.filter(F.coalesce("c_a", "a") != F.coalesce("c_b", "b")).select("a", "b")


def near_duplicates(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", width: int = 5,
                    percent: int = 80, fold_case: bool = True, least_depth: int = LEAST_DEPTH) -> DataFrame:
    """``id, n_shingles, component_id, kept`` of every row; documents are
    linked where 100 * intersection >= ``percent`` * union of their sets."""
    spark = docs.sparkSession
    ship(spark)
    base = docs.select(F.col(f"`{id_col}`").cast("long").alias("id"),
                       F.coalesce(F.col(f"`{text_col}`").cast("string"), F.lit("")).alias("text"))
    signed = stored(base.mapInArrow(tidied(_signed(width, fold_case), "near_duplicates"), "id long, n long, k1 long, k2 long, sig binary"), "minhash-sets")
    rep = stored(signed.filter("n > 0 AND id IS NOT NULL").groupBy("k1", "k2", "n").agg(F.min("id").alias("rep")), "minhash-classes")
    heads = rep.select(F.col("rep").alias("id"), "k1", "k2")
    # one row per class: its representative's signature (several where an id repeats)
    signs = signed.join(heads, ["id", "k1", "k2"], "left_semi").dropDuplicates(["id", "k1", "k2"]).select("id", "n", "sig")
    entries = stored(signs.select("id", "n", F.posexplode(F.array(*[_tree(F.col("sig"), t) for t in range(TREES)]))
                                  .alias("tree", "prefix")), "minhash-trees")

    # 1. neighbours in every sorted order
    order = ["tree", "prefix", "id"]
    parts = int(spark.conf.get("spark.sql.shuffle.partitions"))
    cut = stored(entries.repartitionByRange(parts, *order).sortWithinPartitions(*order)
                 .select(F.spark_partition_id().alias("part"), "tree", "prefix", "id", "n")
                 .mapInArrow(tidied(_neighbours(least_depth), "near_duplicates"), CUT), "minhash-neighbours")
    beside = _adjacent(cut, least_depth)
    # only classes that share a region with another one can ever be compared
    some = stored(beside.select("id").unionByName(beside.select(F.col("other").alias("id"))).distinct(), "minhash-some")
    # (an inner join: Spark would move a semi join below the marks)
    texts = stored(_marked(base, some).join(some, "id"), "minhash-texts")
    near = beside.filter(_sizes_fit("n", "other_n", percent))
    both = near.select("id", "other", "depth").unionByName(near.select(F.col("other").alias("id"), F.col("id").alias("other"), "depth"))
    best = stored(both.groupBy("id").agg(F.max(F.struct("depth", (-F.col("other")).alias("neg"))).alias("m"))
                  .select(F.greatest("id", -F.col("m.neg")).alias("a"), F.least("id", -F.col("m.neg")).alias("b")).distinct(), "minhash-best")
    first = stored(_linked(best, texts, width, fold_case, percent), "minhash-links")
    release(spark)
    comp = stored(components(first), "minhash-components")
    pairs = stored(near.select(F.greatest("id", "other").alias("a"), F.least("id", "other").alias("b")).distinct(), "minhash-near")
    apart = _apart(pairs.join(best, ["a", "b"], "left_anti"), comp)
    second = stored(_linked(apart, texts, width, fold_case, percent), "minhash-links")
    release(spark)
    comp = stored(extended(comp, second), "minhash-components")

    # 2. regions that span components
    member = (entries.select("id", "tree", F.substring("prefix", 1, 2 * least_depth).alias("region"))
              .join(comp, F.col("id") == F.col("node"), "left").select("id", "tree", "region", F.coalesce("component", "id").alias("comp")))
    found = _region_pairs(member, texts, width, fold_case, percent)
    rest = stored(found.join(pairs, ["a", "b"], "left_anti"), "minhash-candidates")
    third = stored(_linked(rest, texts, width, fold_case, percent), "minhash-links")
    release(spark)
    final = stored(extended(comp, third.unionByName(_versions(signed, rep))), "minhash-components")

    # every row: its class, the class's representative, the representative's component
    classes = (rep.join(final.withColumnRenamed("node", "rep"), "rep", "left")
               .select("k1", "k2", F.col("n").alias("c_n"), F.coalesce("component", "rep").alias("component")))
    out = (signed.select("id", "n", "k1", "k2")
           .join(classes.withColumnsRenamed({"k1": "c1", "k2": "c2"}),
                 (F.col("k1") == F.col("c1")) & (F.col("k2") == F.col("c2")) & (F.col("n") == F.col("c_n")), "left"))
    component = F.coalesce("component", "id")
    return out.select(F.col("id").alias(id_col), F.col("n").alias("n_shingles"), component.alias("component_id"),
                      (F.col("id").isNull() & F.col("component").isNull() | F.coalesce(F.col("id") == component, F.lit(False))).alias("kept"))


def _versions(signed: DataFrame, rep: DataFrame) -> DataFrame:
    """Links between the classes of rows that share an id."""
    rows = signed.filter("n > 0 AND id IS NOT NULL").join(rep, ["k1", "k2", "n"]).select("id", "rep").distinct()
    shared = (rows.groupBy("id").agg(F.min("rep").alias("b"), F.max("rep").alias("hi")).filter("b < hi").select("id", "b"))
    return rows.join(shared, "id").filter("rep <> b").select(F.col("rep").alias("a"), "b")


def _region_pairs(member: DataFrame, texts: DataFrame, width: int, fold_case: bool, percent: int) -> DataFrame:
    """Candidate pairs ``(a, b)`` of different components that share a region."""
    spans = member.groupBy("tree", "region").agg(F.min("comp").alias("lo"), F.max("comp").alias("hi")).filter("lo < hi")
    left = stored(member.join(spans, ["tree", "region"], "left_semi").select("id", "comp").distinct(), "minhash-regions")
    return _prefix_pairs(left, texts, width, fold_case, percent)


WORDS = [f"w{k}" for k in range(BITMAP // 64)]


def bitmaps(h: np.ndarray, at: np.ndarray) -> np.ndarray:
    """For each set the parity of its shingles in ``BITMAP`` buckets, in words of
    64 bits.  A shingle in one of two sets flips one bit, so their bitmaps
    differ in no more bits than the sets in shingles."""
    bucket = (mixed(h) >> np.uint64(32)).astype(np.int64) % BITMAP
    out = np.empty((len(at) - 1, len(WORDS)), np.int64)
    for lo in range(0, len(out), 1024):
        hi = min(len(out), lo + 1024)
        place = np.repeat(np.arange(hi - lo), np.diff(at[lo:hi + 1])) * BITMAP + bucket[at[lo]:at[hi]]
        odd = (np.bincount(place, minlength=(hi - lo) * BITMAP) & 1).astype(bool)
        out[lo:hi] = np.packbits(odd).view(np.int64).reshape(hi - lo, len(WORDS))
    return out


def _sets(width: int, fold_case: bool):
    def run(batches):
        for b in slices(batches, SLICE_BYTES):
            raw, off = string_parts(b.column(1))
            h, at = shingles(raw, off, width, fold_case)
            rows = pa.ListArray.from_arrays(pa.array(at, pa.int32()), pa.array(h.view(np.int64)))
            bits = bitmaps(h, at)
            yield pa.RecordBatch.from_arrays([b.column(0), pa.array(np.diff(at), pa.int64()), rows, *map(pa.array, bits.T.copy())],
                                             names=["id", "n", "set", *WORDS])
    return run


def _prefix_pairs(left: DataFrame, texts: DataFrame, width: int, fold_case: bool, percent: int) -> DataFrame:
    """Pairs ``(a, b)`` of different components among the classes ``id, comp``
    that can be similar enough.

    Sets of ``n <= m`` shingles need ``o = ceil(percent (n + m) / (100 +
    percent))`` in common, so in one order of all shingles the first ``n - o +
    1`` of one and ``m - o + 1`` of the other meet.  ``o`` is least at ``m = n``
    for the smaller set, and at least ``percent`` of the larger one; from the
    first common shingle on, both must have ``o`` left, and the sets, so also
    their bitmaps, may differ by ``n + m - 2 o``."""
    from pyspark.sql import Window
    sets = (texts.join(left, "id", "left_semi").select("id", "text")
                  .mapInArrow(tidied(_sets(width, fold_case), "near_duplicates"), f"id long, n long, set array<long>, {', '.join(f'{w} long' for w in WORDS)}")
            .withColumn("hash", F.xxhash64("set")).dropDuplicates(["id", "hash"]))
    # an id may have several texts: its rows are numbered
    sets = stored(sets.withColumn("row", F.row_number().over(Window.partitionBy("id").orderBy("hash"))).drop("hash"), "minhash-sets")
    each = sets.select("id", "row", "n", F.explode("set").alias("g"))
    # shingles of one set only come first in its order and meet nothing: they are counted, not sorted
    often = (sets.select(F.explode("set").alias("g")).groupBy("g").agg(F.count("*").cast("int").alias("often")).filter("often > 1"))
    mine = Window.partitionBy("id", "row")
    first = (each.join(often, "g").withColumn("at", F.col("n") - F.count("*").over(mine) + F.row_number().over(mine.orderBy("often", "g")) - 1)
             .drop("often"))
    # a shingle that only one component has in front joins nothing
    first = stored(first.filter(f"at <= n - ({percent} * n + 99) div 100").join(left, "id"), "minhash-prefixes")
    per = first.groupBy("g", "comp").agg(F.count("*").alias("size"))
    spans = (per.groupBy("g").agg(F.max(F.struct("size", "comp")).alias("main"), F.sum("size").alias("size"), F.count("*").alias("comps"))
             .filter("comps > 1").select("g", F.col("main.comp").alias("main"), F.ceil(F.col("size") / DEALT).cast("int").alias("deals")))
    first = stored(first.join(spans, "g").join(sets.drop("set", "n"), ["id", "row"]).drop("row"), "minhash-prefixes")
    small = (first.filter(f"at <= n - ({2 * percent} * n + {99 + percent}) div {100 + percent}")
             .withColumn("deal", F.pmod(F.xxhash64("id"), F.col("deals"))).drop("deals"))
    large = (first.withColumn("deal", F.explode(F.sequence(F.lit(0), F.col("deals") - 1))).drop("deals")
             .withColumnsRenamed({c: f"o_{c}" for c in ("id", "comp", "n", "at", "main", *WORDS)}))
    differ = sum((F.bit_count(F.col(w).bitwiseXOR(F.col(f"o_{w}"))) for w in WORDS), F.lit(0))
    both = F.expr(f"({percent} * (n + o_n) + {99 + percent}) div {100 + percent}")
    fits = ((F.col("n") <= F.col("o_n")) & (F.col("comp") != F.col("o_comp")) & _sizes_fit("n", "o_n", percent)
            & (F.least(F.col("n") - F.col("at"), F.col("o_n") - F.col("o_at")) >= both)
            & (differ <= F.col("n") + F.col("o_n") - 2 * both))
    # members of a shingle's main component are only joined with the others
    out = None
    for one, other in ((small.filter("comp <> main"), large), (small.filter("comp = main"), large.filter("o_comp <> o_main"))):
        one = one.withColumnsRenamed({"g": "a_g", "deal": "a_deal"})
        met = one.join(other, (F.col("a_g") == F.col("g")) & (F.col("a_deal") == F.col("deal")) & fits)
        met = met.select(F.greatest("id", "o_id").alias("a"), F.least("id", "o_id").alias("b"))
        out = met if out is None else out.unionByName(met)
    return out.distinct()


def drop_near_duplicates(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", **rule) -> DataFrame:
    """``docs`` with one document of each component (the one with the smallest
    id), with their columns; of rows that share its id the one with the smallest
    text stays.  Rows without an id belong to no group and stay."""
    ids = near_duplicates(docs, id_col, text_col, **rule).filter(f"kept AND `{id_col}` IS NOT NULL").select(id_col).distinct()
    names = docs.columns
    rest = docs.filter(F.col(f"`{id_col}`").isNotNull()).join(ids, id_col, "left_semi")
    row = F.struct(*[F.col(f"`{c}`") for c in names])
    order = F.struct(F.col(f"`{text_col}`"), F.xxhash64(*[F.col(f"`{c}`") for c in names]))
    one = rest.groupBy(F.col(f"`{id_col}`").alias("_key")).agg(F.min_by(row, order).alias("_row")).select("_row.*")
    return one.unionByName(docs.filter(F.col(f"`{id_col}`").isNull()))
