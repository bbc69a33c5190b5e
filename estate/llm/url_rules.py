"""URL filters: pattern rules found through their rarest literal token.

Two kinds of rule decide on a URL:

* place rules ``host/path``: fit their host and every subdomain of it, if the
  URL's path starts with the rule's path; the longest fitting rule wins;
* pattern rules: regular expressions over the lower-cased URL.  They decide
  where no place rule fits: block if a blocking pattern matches and no
  allowing pattern does, else allow.

Running every pattern on every URL costs rules x URLs.  Instead each pattern
is indexed under one literal token that any matching URL must contain as a
whole token (a run of ``[a-z0-9]`` between other characters); of a pattern's
literal tokens the one that is rarest in the corpus is taken.  A URL's own
tokens then fetch the few candidate rules, and only those run their regular
expression.  A pattern without a literal token is a candidate for every URL.

Everything is DataFrame functions: a join on the token, no Python on the rows.
Work is done once per distinct URL and joined back, so repeated URLs and
repeated ids are handled row by row; a very common token or host only skews
joins that Spark can split, and every aggregate is partial before it shuffles.

Defined results: a null URL, an empty one, or one without ``://`` has an empty
host and path, fits no place rule and is still shown to the pattern rules
(a null URL matches none and is allowed).
"""

from __future__ import annotations

import re

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

# fixed values: the place rules of the task, (host/path, verdict)
PLACE_RULES = (("org/", "allow"), ("example.org/es/", "block"), ("example.org/en/1", "block"),
               ("com/fr/", "allow"), ("com/de/", "block"))

# default pattern rules: (pattern over the lower-cased URL, verdict)
PATTERN_RULES = (
    (r"[?&]utm_source=(feed|mail)", "block"),
    (r"[?&]ref=x(&|$)", "block"),
    (r"[?&]sessionid=[0-9a-f]+", "block"),
    (r"/print/[0-9]+", "block"),
    (r"://ads\.", "block"),
    (r"/tag/[^/?#]+/?$", "block"),
    (r"[?&]page=1(&|$)", "allow"),
    (r"/es/[0-9]*7\.html$", "block"),
    (r"/archive/", "block"),
)

TOKEN = "[a-z0-9]+"


def host_of(url: Column) -> Column:
    """Lower-cased host: after the first ``://`` up to ``/ ? #`` or the end."""
    rest = _after_scheme(url)
    return F.translate(F.regexp_extract(rest, r"^([^/?#]*)", 1),
                       "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def path_of(url: Column) -> Column:
    """What follows the host, up to ``? #`` or the end."""
    return F.regexp_extract(_after_scheme(url), r"^[^/?#]*([^?#]*)", 1)


def _after_scheme(url: Column) -> Column:
    url = F.coalesce(url, F.lit(""))
    at = F.locate("://", url)
    return F.when(at > 0, url.substr(at + 3, F.length(url))).otherwise(F.lit(""))


def literal_tokens(pattern: str) -> list[str]:
    """Whole tokens that every URL matching ``pattern`` contains: literal runs
    of ``[a-z0-9]`` outside classes, groups and quantified parts, with a
    literal or anchored non-token character on both sides."""
    if "|" in re.sub(r"\([^()]*\)|\[[^\]]*\]", "", pattern):
        return []                                   # a top-level alternative: nothing is certain
    flat = re.sub(r"\[[^\]\^\\a-zA-Z0-9-]+\](?![*?{])", "\x01", pattern)   # only separators
    flat = re.sub(r"\[[^\]]*\][*+?]?|\\[a-zA-Z][*+?]?", "\x00", flat)  # other classes: unknown
    while re.search(r"\([^()]*\)", flat):
        flat = re.sub(r"\([^()]*\)[*+?]?", "\x00", flat)
    flat = re.sub(r"\{[^}]*\}", "*", flat)
    flat = re.sub(r"^\^|\$$", "\x01", flat)         # ends of the URL
    flat = re.sub(r"(?<!\\)\.[*+?]?", "\x00", flat)  # any character
    flat = flat.replace("\\", "")
    flat = re.sub(r"[^\x00][*+?]", "\x00", flat)      # optional or repeated: not certain
    out = []
    for m in re.finditer(TOKEN, flat):
        left = flat[m.start() - 1] if m.start() else "\x00"
        right = flat[m.end()] if m.end() < len(flat) else "\x00"
        if left != "\x00" and right not in "\x00+":
            out.append(m.group())
    return sorted(set(out))


def _url_tokens(url: Column) -> Column:
    return F.array_distinct(F.regexp_extract_all(F.lower(url), F.lit(f"({TOKEN})"), F.lit(1)))


def index_patterns(spark: SparkSession, tokens: DataFrame, patterns) -> DataFrame:
    """``rule_id, pattern, verdict, token``: each pattern under its literal
    token that is rarest among ``tokens`` (column ``token``); null if it has none."""
    rows = [(i, p, v, literal_tokens(p)) for i, (p, v) in enumerate(patterns)]
    rules = spark.createDataFrame(rows, "rule_id int, pattern string, verdict string, tokens array<string>")
    wanted = rules.select("rule_id", F.explode_outer("tokens").alias("token"))
    # only rule tokens are counted: the semi join comes before the aggregate
    counts = (tokens.join(wanted.select("token").distinct(), "token", "left_semi")
              .groupBy("token").agg(F.count("*").alias("n")))
    rarest = (wanted.join(counts, "token", "left")
              .groupBy("rule_id")
              .agg(F.min_by("token", F.struct(F.coalesce("n", F.lit(0)), F.col("token"))).alias("token")))
    return rules.drop("tokens").join(rarest, "rule_id")


def judge_urls(pages: DataFrame, url_col: str = "url", place_rules=PLACE_RULES,
               patterns=PATTERN_RULES) -> DataFrame:
    """Every row of ``pages`` with ``host, path, rule, pattern, verdict`` (see
    the module text).  Input columns of those names are replaced."""
    spark = pages.sparkSession
    out = ("host", "path", "rule", "pattern", "verdict")
    urls = pages.select(F.col(f"`{url_col}`").alias("_url")).distinct()
    parts = urls.select("_url", host_of(F.col("_url")).alias("host"), path_of(F.col("_url")).alias("path"))

    # place rules: the host's suffixes fetch rules, the path decides
    place = spark.createDataFrame(
        [(r, r.split("/", 1)[0], "/" + r.split("/", 1)[1], v) for r, v in place_rules],
        "rule string, r_host string, r_path string, r_verdict string")
    labels = F.split("host", r"\.")
    suffixes = F.transform(F.sequence(F.lit(1), F.size(labels)),
                           lambda i: F.array_join(F.slice(labels, i, F.size(labels)), "."))
    fits = (parts.select("_url", "path", F.explode(suffixes).alias("r_host"))
            .join(place, "r_host").filter(F.expr("startswith(path, r_path)"))
            .groupBy("_url")
            .agg(F.max(F.struct(F.length("rule").alias("n"), F.col("rule"), F.col("r_verdict"))).alias("_fit")))

    # pattern rules: the URL's tokens fetch rules, the expression decides
    tokens = urls.select("_url", F.explode(_url_tokens(F.col("_url"))).alias("token"))
    index = index_patterns(spark, tokens.select("token"), patterns)
    fetched = tokens.join(index.filter(F.col("token").isNotNull()), "token")
    always = [(p, v) for p, v in patterns if not literal_tokens(p)]
    hit = fetched.filter(F.expr("regexp_like(lower(_url), pattern)")).select("_url", "pattern", F.col("verdict").alias("p_verdict"))
    for p, v in always:                              # patterns without a literal: one filter each
        hit = hit.unionByName(urls.filter(F.lower("_url").rlike(p))
                              .select("_url", F.lit(p).alias("pattern"), F.lit(v).alias("p_verdict")))
    # an allowing pattern beats a blocking one; ties to the smaller pattern text
    hits = hit.groupBy("_url").agg(F.min(F.struct("p_verdict", "pattern")).alias("_hit"))

    judged = (parts.join(fits, "_url", "left").join(hits, "_url", "left")
              .select("_url", "host", "path", F.col("_fit.rule").alias("rule"),
                      F.col("_hit.pattern").alias("pattern"),
                      F.coalesce("_fit.r_verdict", "_hit.p_verdict", F.lit("allow")).alias("verdict")))
    rows = pages.drop(*out).withColumn("_url", F.col(f"`{url_col}`"))
    # a null URL finds no partner in the join and gets its defined result here
    return (rows.join(judged, "_url", "left").drop("_url")
            .withColumns({"host": F.coalesce("host", F.lit("")), "path": F.coalesce("path", F.lit("")),
                          "verdict": F.coalesce("verdict", F.lit("allow"))}))
