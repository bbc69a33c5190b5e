"""Quality classifier from weak labels.

Two questions are asked of a document: is it low quality, is it toxic?  For each
there are several overlapping heuristic labellers that vote 1 (bad), 0 (good)
or abstain, and the table of human labels is one more labeller that abstains on
most documents.

1. *Votes* of all documents are counted by vote pattern: at most ``3^labellers``
   rows, whatever the size of the corpus.
2. *Expectation-maximisation* over the pattern counts estimates each labeller's
   confusion (how it votes given the truth) and the posterior of each pattern.
3. *Scorer*: documents with a confident posterior, up to ``TRAIN_ROWS``, half of
   them bad where there are enough and spread over all vote patterns, train a
   logistic regression over hashed words and style features.  First those with
   a human label train one that is one more labeller of the others; then all of
   them train the scorer, at any size.
4. Every document is scored over its whole text; it is rejected where either
   probability reaches ``THRESHOLD``.

Votes, counts and scores cover all documents; only the training rows are a
bounded sample, and the model (two rows of ``2^BITS`` weights) is of fixed size.

Defined results: a null or empty text has no features and is kept.  A null id
has no human label.  Where a document has several label rows the worst one
counts; null labels abstain.  If only one class is to be seen, its prior decides.
Repeated rows repeat their result; other columns are kept by
:func:`keep_good`; an empty table gives an empty result.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from estate.llm._ship import ship, slices, stored, string_parts, tables, tidied, tidy
from estate.llm.cover import Rolling, _BYTE

BITS = 16
STYLES = 8                       # style features, in 10 steps each
TRAIN_ROWS = 12_000              # documents the scorer is fitted on, at most
THRESHOLD = 0.5
CONFIDENT = 0.9
HUMAN_RIGHT = 0.999              # share of human labels taken to be right
TELLING = 3.0                    # standard errors
DECAY = {"low": 1e-4, "toxic": 3e-5}
SLICE_BYTES = 1024 * 1024
TASKS = ("low", "toxic")

# common insults; two overlapping lists make two labellers
INSULTS = ("idiot moron imbecile stupid dumb fool loser clown scum trash bastard jerk freak creep "
           "pig liar coward").split()
CONTEMPT = ("pathetic worthless disgusting stupid trash scum vile filthy useless ugly hateful "
            "despicable loathsome repulsive idiotic moronic").split()

LABELLERS = {"low": ("symbols", "capitals", "repeats", "marks", "human"),
             "toxic": ("insults", "contempt", "human")}
ABSTAIN = 2


def tokens(raw: np.ndarray, off: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Hashes of the words (runs of letters; ASCII case folded), their lengths,
    and the documents' offsets among them."""
    low = np.where((raw >= 65) & (raw <= 90), raw + 32, raw)
    letter = ((low >= 97) & (low <= 122)) | (low >= 128)
    edge = np.zeros(len(raw) + 1, bool)
    edge[off] = True
    before, after = np.concatenate([[False], letter]), np.concatenate([letter, [False]])
    starts, ends = np.flatnonzero(after & (~before | edge)), np.flatnonzero(before & (~after | edge))
    n = ends - starts
    return Rolling(_BYTE[low]).at(starts, n) + n.astype(np.uint64), n, np.searchsorted(starts, off)


def word_hashes(words: list[str]) -> np.ndarray:
    raw = np.frombuffer("".join(words).encode(), np.uint8)
    off = np.concatenate([[0], np.cumsum([len(w.encode()) for w in words])])
    return tokens(raw, off)[0]


def _sums(flags: np.ndarray, off: np.ndarray) -> np.ndarray:
    total = np.concatenate([[0], np.cumsum(flags)])
    return total[off[1:]] - total[off[:-1]]


class Described:
    """Style figures and hashed features of a slice of documents."""

    def __init__(self, raw: np.ndarray, off: np.ndarray):
        h, n, at = tokens(raw, off)
        size = np.diff(off)
        self.size, self.words = size, np.diff(at)
        doc = np.repeat(np.arange(len(size)), self.words)
        # distinct words of each document
        order = np.lexsort((h, doc))
        hs, ds = h[order], doc[order]
        new = np.concatenate([[True], (hs[1:] != hs[:-1]) | (ds[1:] != ds[:-1])])[:len(hs)]
        self.hash, self.doc = hs[new], ds[new]
        distinct = np.bincount(self.doc, minlength=len(size))
        blank = (raw == 32) | ((raw >= 9) & (raw <= 13))
        upper = (raw >= 65) & (raw <= 90)
        letter = upper | ((raw >= 97) & (raw <= 122)) | (raw >= 128)
        digit = (raw >= 48) & (raw <= 57)
        symbol = ~(blank | letter | digit)
        plain = (raw == 46) | (raw == 44)                     # full stop and comma
        solid = np.maximum(size - _sums(blank, off), 1)
        again = symbol & np.concatenate([[False], raw[1:] == raw[:-1]])[:len(raw)]   # a doubled mark
        alone = (raw == 124) | (raw == 92) | (raw == 126)
        letters = np.maximum(_sums(letter, off), 1)
        self.symbols = _sums(symbol & ~plain, off) / solid
        self.capitals = _sums(upper, off) / letters
        self.repeats = 1 - distinct / np.maximum(self.words, 1)
        # words that come again at once, as in "a a a": no prose does that often
        same = np.concatenate([[False], (h[1:] == h[:-1]) & (doc[1:] == doc[:-1])])[:len(h)]
        self.runs = np.bincount(doc[same], minlength=len(size)) / np.maximum(self.words, 1)
        self.marks = _sums(again | alone, off) / np.maximum(self.words, 1)
        self.digits = _sums(digit, off) / solid
        self.lines = _sums(raw == 10, off) / np.maximum(self.words, 1)
        self.length = letters / np.maximum(self.words, 1) / 20

    def votes(self) -> dict[str, np.ndarray]:
        """Votes of the heuristic labellers (columns in the order of
        :data:`LABELLERS`, without the human one)."""
        def vote(figure, bad, good):
            v = np.where(figure >= bad, 1, np.where(figure <= good, 0, ABSTAIN))
            return np.where(self.words < 5, ABSTAIN, v)

        def lexicon(words):
            hits = np.bincount(self.doc[np.isin(self.hash, word_hashes(words))], minlength=len(self.size))
            return np.where(hits > 0, 1, 0)
        return {"low": np.stack([vote(self.symbols, 0.10, 0.03), vote(self.capitals, 0.5, 0.15), vote(self.runs, 0.10, 0.02),
                                 vote(self.marks, 0.15, 0.02)], 1),
                "toxic": np.stack([lexicon(INSULTS), lexicon(CONTEMPT)], 1)}

    def features(self) -> tuple[np.ndarray, np.ndarray]:
        """Feature numbers and the documents' offsets among them: distinct words
        hashed to ``2^BITS`` and one step of each style figure."""
        word = (self.hash >> np.uint64(64 - BITS)).astype(np.int64)
        code = np.unique(self.doc.astype(np.int64) << 32 | word)
        styles = np.stack([self.symbols, self.capitals, self.repeats, self.runs, self.marks, self.digits, self.lines,
                           self.length], 1)
        step = np.clip((np.sqrt(styles) * 10).astype(np.int64), 0, 9)
        some = np.flatnonzero(self.words)
        extra = ((some[:, None] << 32) | ((1 << BITS) + np.arange(STYLES) * 10 + step[some])).ravel()
        code = np.sort(np.concatenate([code, extra]))
        return (code & 0xFFFFFFFF).astype(np.int32), np.searchsorted(code >> 32, np.arange(len(self.size) + 1))


WEIGHTS = (1 << BITS) + STYLES * 10


def _vote_rows(batches):
    for b in slices(batches, SLICE_BYTES):
        v = Described(*string_parts(b.column(1))).votes()
        cols = [pa.array(["".join(map(str, r)) for r in v[t].tolist()]) for t in TASKS]
        yield pa.RecordBatch.from_arrays([b.column(0), *cols], names=["id", *TASKS])


def _feature_rows(batches):
    for b in slices(batches, SLICE_BYTES):
        f, at = Described(*string_parts(b.column(1))).features()
        rows = pa.ListArray.from_arrays(pa.array(at, pa.int32()), pa.array(f))
        yield pa.RecordBatch.from_arrays([*b.columns[2:], rows], names=["p_low", "p_toxic", "weight", "said_low", "said_toxic", "features"])


def _score_udf(model: np.ndarray, bias: np.ndarray):
    @F.arrow_udf("struct<p_low:double,p_toxic:double>")
    def score(texts: pa.Array) -> pa.Array:
        tables("quality")
        out = []
        for b in slices([pa.RecordBatch.from_arrays([texts, texts], names=["a", "b"])], SLICE_BYTES):
            f, at = Described(*string_parts(b.column(1))).features()
            p = np.stack([1 / (1 + np.exp(-np.clip(_row_sums(w, f, at) + c, -30, 30))) for w, c in zip(model, bias)], 1)
            p[np.diff(at) == 0] = 0.0                        # no features: nothing against it
            out.append(p)
        p = np.concatenate(out) if out else np.zeros((0, 2))
        tidy()
        return pa.StructArray.from_arrays([pa.array(p[:, 0]), pa.array(p[:, 1])], names=["p_low", "p_toxic"])
    return score


def _row_sums(w: np.ndarray, f: np.ndarray, at: np.ndarray) -> np.ndarray:
    total = np.concatenate([[0.0], np.cumsum(w[f], dtype=np.float64)])
    return total[at[1:]] - total[at[:-1]]


def expectation_maximisation(patterns: np.ndarray, counts: np.ndarray, human: int, rounds: int = 100):
    """Posterior of "bad" for each vote pattern (rows of 0, 1, abstain), and
    each labeller's confusion ``[truth][vote]``.  Where the human labeller
    voted, its (given) accuracy is the posterior, so that labellers which err
    together can't outvote it; elsewhere the posterior starts from the vote."""
    voted = patterns != ABSTAIN
    bad = (patterns == 1).sum(1)
    q = np.where(voted.any(1), (bad + 0.1) / (voted.sum(1) + 1.0), 0.2)
    known = patterns[:, human] != ABSTAIN
    said = np.where(patterns[:, human] == 1, HUMAN_RIGHT, 1 - HUMAN_RIGHT)
    q = np.where(known, said, q)
    n = counts.astype(float)
    for _ in range(rounds):
        prior = np.clip((q * n).sum() / n.sum(), 1e-4, 1 - 1e-4)
        confusion = np.empty((patterns.shape[1], 2, 3))
        for j in range(patterns.shape[1]):
            for y, w in enumerate((n * (1 - q), n * q)):
                c = np.bincount(patterns[:, j], w, 3) + 0.5
                confusion[j, y] = c / c.sum()
        # whether a label was given says nothing about the truth; given, it is nearly always right
        confusion[human] = [[HUMAN_RIGHT, 1 - HUMAN_RIGHT, 1.0], [1 - HUMAN_RIGHT, HUMAN_RIGHT, 1.0]]
        log = np.log(confusion)
        odds = np.log(prior / (1 - prior)) + sum(log[j, 1, patterns[:, j]] - log[j, 0, patterns[:, j]]
                                                 for j in range(patterns.shape[1]))
        new = np.where(known, said, 1 / (1 + np.exp(-np.clip(odds, -30, 30))))
        if np.abs(new - q).max() < 1e-6:
            q = new
            break
        q = new
    return q, confusion


def telling(f: np.ndarray, rows: np.ndarray, p: np.ndarray, least: float = TELLING) -> np.ndarray:
    """Features whose log odds between the classes lie ``least`` standard errors
    from zero: with far more features than training rows the others only fit
    noise."""
    bad, good = np.bincount(f, p[rows], WEIGHTS) + 0.5, np.bincount(f, 1 - p[rows], WEIGHTS) + 0.5
    odds = np.log(bad / (p.sum() + 1)) - np.log(good / ((1 - p).sum() + 1))
    return np.abs(odds) / np.sqrt(1 / bad + 1 / good) >= least


def fit(f: np.ndarray, at: np.ndarray, p: np.ndarray, rounds: int = 300, rate: float = 0.3, decay: float = 1e-3):
    """Logistic regression on posterior labels, over the telling features, by
    full-batch AdaGrad."""
    w, c = np.zeros(WEIGHTS), 0.0
    if not len(p) or p.min() > 0.5 or p.max() < 0.5:          # one class only
        m = float(np.clip(p.mean() if len(p) else 0.0, 1e-3, 1 - 1e-3))
        return w, float(np.log(m / (1 - m)))
    rows = np.repeat(np.arange(len(p)), np.diff(at))
    use = telling(f, rows, p)
    keep = use[f]
    f, rows = f[keep], rows[keep]
    at = np.searchsorted(rows, np.arange(len(p) + 1))
    g2, c2 = np.full(WEIGHTS, 1e-8), 1e-8
    for _ in range(rounds):
        e = 1 / (1 + np.exp(-np.clip(_row_sums(w, f, at) + c, -30, 30))) - p
        g = np.bincount(f, e[rows], WEIGHTS) / len(p) + decay * w
        g2 += g * g
        w -= rate * g / np.sqrt(g2)
        gc = e.mean()
        c2 += gc * gc
        c -= rate * gc / np.sqrt(c2)
    return w, float(c)


def _posteriors(votes: DataFrame, labels: DataFrame) -> tuple[DataFrame, dict]:
    """Posteriors of all documents by their vote patterns, and the confusions."""
    spark = votes.sparkSession
    human = (labels.filter("doc_id IS NOT NULL").groupBy("doc_id")
             .agg(F.min("quality").alias("quality"), F.max("toxic").alias("toxic_label")))
    said = {"low": F.when(F.col("quality") == 0, "1").when(F.col("quality") == 1, "0").otherwise("2"),
            "toxic": F.when(F.col("toxic_label") == 1, "1").when(F.col("toxic_label") == 0, "0").otherwise("2")}
    rows = (votes.join(human, votes.id == human.doc_id, "left")
            .select("id", *[F.concat(F.col(t), said[t]).alias(t) for t in TASKS]))
    found = {}
    for t in TASKS:
        tally = rows.groupBy(t).count().collect()             # at most 3^labellers rows
        if not tally:
            return rows.withColumns({f"p_{x}": F.lit(0.0) for x in TASKS}), found
        patterns = np.array([list(map(int, r[0])) for r in tally])
        q, confusion = expectation_maximisation(patterns, np.array([r[1] for r in tally]), patterns.shape[1] - 1)
        found[t] = confusion
        known = spark.createDataFrame([(r[0], float(x)) for r, x in zip(tally, q)], f"{t} string, p_{t} double")
        rows = rows.join(F.broadcast(known), t)
    return rows, found


def quotas(counts: np.ndarray, total: int) -> np.ndarray:
    """``total`` dealt over strata of the given sizes: the same to each, and
    what small ones leave over to the others."""
    level, order = 0.0, np.sort(counts)
    for k, c in enumerate(order):
        level = total / (len(order) - k)
        if c >= level:
            break
        total -= c
        level = c
    return np.minimum(counts, level)


def _sample(rows: DataFrame) -> DataFrame:
    """Bad and good documents with a confident posterior in either task, half of ``TRAIN_ROWS``
    of each at most, spread over all vote patterns and in hash order of their
    ids within each.  The human labeller's vote is part of the pattern, so at
    any size labelled and unlabelled documents train the scorer together."""
    spark = rows.sparkSession
    sure = rows.filter((F.col("p_low") >= CONFIDENT) | (F.col("p_low") <= 1 - CONFIDENT)
                       | (F.col("p_toxic") >= CONFIDENT) | (F.col("p_toxic") <= 1 - CONFIDENT))
    bad = (F.col("p_low") >= 0.5) | (F.col("p_toxic") >= 0.5)
    strata = sure.groupBy(*TASKS, bad.alias("bad")).count().collect()    # at most 3^labellers rows
    half, share, picked = TRAIN_ROWS // 2, [], []
    for x in (True, False):
        mine = [r for r in strata if r.bad == x]
        n = np.array([r["count"] for r in mine], float)
        share += [(*(r[t] for t in TASKS), float(f)) for r, f in zip(mine, quotas(n, half) / np.maximum(n, 1))]
    known = spark.createDataFrame(share, f"{', '.join(f'{t} string' for t in TASKS)}, share double")
    some = sure.join(F.broadcast(known), list(TASKS)).filter(F.pmod(F.xxhash64("id"), F.lit(1 << 30)) < F.col("share") * (1 << 30))
    for x in (bad, ~bad):
        picked.append(some.filter(x).orderBy(F.xxhash64(F.xxhash64("id")), "id").limit(half))
    return picked[0].unionByName(picked[1]).dropDuplicates(["id"]).select(
        "id", "p_low", "p_toxic", (1 / F.col("share")).alias("weight"), *[(~F.col(t).endswith(str(ABSTAIN))).alias(f"said_{t}") for t in TASKS])


def train(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text"):
    """``(model, bias, confusions)`` fitted on the corpus."""
    spark = docs.sparkSession
    ship(spark)
    base = docs.select(F.col(f"`{id_col}`").cast("long").alias("id"),
                       F.coalesce(F.col(f"`{text_col}`").cast("string"), F.lit("")).alias("text"))
    votes = stored(base.mapInArrow(tidied(_vote_rows, "quality"), "id long, low string, toxic string"), "quality-votes")
    rows, confusions = _posteriors(votes, labels)
    rows = stored(rows.select("id", *TASKS, "p_low", "p_toxic").filter("id IS NOT NULL"), "quality-posteriors")
    sample = _sample(rows)
    # the sample is bounded, so it is the side to send to every task
    chosen = base.join(F.broadcast(sample), "id").select("id", "text", "p_low", "p_toxic", "weight", "said_low", "said_toxic")
    got = chosen.mapInArrow(tidied(_feature_rows, "quality"), "p_low double, p_toxic double, weight double, said_low boolean, said_toxic boolean, features array<int>").toArrow()
    feats = got["features"].combine_chunks()
    f = feats.flatten().to_numpy(zero_copy_only=False).astype(np.int64)
    at = np.concatenate([[0], np.cumsum(feats.value_lengths().to_numpy(zero_copy_only=False))]).astype(np.int64)
    weight = got["weight"].to_numpy()        # documents that a training row stands for
    model, bias = [], []
    for t in TASKS:
        p = got[f"p_{t}"].to_numpy()
        said = got[f"said_{t}"].to_numpy(zero_copy_only=False).astype(bool) if len(p) else np.zeros(0, bool)
        sure = (p >= CONFIDENT) | (p <= 1 - CONFIDENT)
        if said.any():
            p = _seen_by_words(f, at, p, said, DECAY[t])
        w, c = fit(*_part(f, at, sure), p[sure], decay=DECAY[t])
        if sure.any():                      # half of the sample is bad: back to the corpus's share
            c += _logit(np.average(p, weights=weight)) - _logit(p[sure].mean())
        model.append(w)
        bias.append(c)
    return np.array(model, np.float32), np.array(bias), confusions


def _part(f: np.ndarray, at: np.ndarray, rows: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The features of some rows, and their offsets among them."""
    n = np.diff(at)
    return f[np.repeat(rows, n)], np.concatenate([[0], np.cumsum(n[rows])]).astype(np.int64)


def _seen_by_words(f: np.ndarray, at: np.ndarray, p: np.ndarray, said: np.ndarray, decay: float) -> np.ndarray:
    """The posteriors after one more labeller has spoken on the documents
    without a human label: a scorer fitted on those that have one.  It sees what
    no heuristic has a rule for, and heuristics see kinds that no human label
    shows, so the worse of both counts; with one class of human labels it is
    silent."""
    w, c = fit(*_part(f, at, said), p[said], decay=decay)
    if not w.any():
        return p
    heard = 1 / (1 + np.exp(-np.clip(_row_sums(w, f, at) + c, -30, 30)))
    return np.where(said, p, np.maximum(p, heard))


def _logit(p: float) -> float:
    p = min(max(float(p), 1e-4), 1 - 1e-4)
    return float(np.log(p / (1 - p)))


def score_documents(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``id, p_low, p_toxic, keep`` of every row."""
    model, bias, _ = train(docs, labels, id_col, text_col)
    scored = docs.select(F.col(f"`{id_col}`"), _score_udf(model, bias)(F.coalesce(F.col(f"`{text_col}`").cast("string"), F.lit(""))).alias("_s"))
    return scored.select(F.col(f"`{id_col}`"), "_s.p_low", "_s.p_toxic",
                         ((F.col("_s.p_low") < THRESHOLD) & (F.col("_s.p_toxic") < THRESHOLD)).alias("keep"))


def keep_good(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """The rows of ``docs`` that the classifier keeps, with their columns."""
    model, bias, _ = train(docs, labels, id_col, text_col)
    s = _score_udf(model, bias)(F.coalesce(F.col(f"`{text_col}`").cast("string"), F.lit("")))
    name = "_quality_score"
    return (docs.withColumn(name, s).filter((F.col(f"{name}.p_low") < THRESHOLD) & (F.col(f"{name}.p_toxic") < THRESHOLD))
            .drop(name))
