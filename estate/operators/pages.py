"""Paged API listings from dumped responses.

Input: one row per dumped page - ``workspace_name, dataset, day, page_no,
continuation_token, value`` where ``value`` is the page's array of objects.
Every step is set-based and runs on executors for any number of
workspaces, datasets and days at once:

* a chain (one listing request: workspace, dataset, day) is followed from
  page 1 while the previous page carried a continuation token;
* the end of each chain comes from an anti-join and a grouped minimum,
  joined back - no window, so a chain holding a third of all pages is still
  read by all tasks;
* objects are flattened with ``explode`` and projected with keep / remove
  lists on their field names.
"""

from __future__ import annotations

from collections.abc import Iterable, Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from estate.functions.timefns import utc_wall_clock
from estate.operators.filters import project

CHAIN = ("workspace_name", "dataset", "day")

# fixed values: default field keep-lists of the listings that have one
DEFAULT_KEEP = {
    "workspace_info": ["id", "name", "type", "workspace_uid", "location", "provisioning_state",
                       "default_data_lake_storage", "workspace_repository_configuration",
                       "purview_configuration", "extra_properties"],
    "sql_pools": ["id", "name", "type", "location", "sku", "provisioning_state", "status",
                  "creation_date"],
}

# fixed values: listing datasets staged per workspace
LISTINGS = ("workspace_info", "sql_pools", "spark_pools", "linked_services", "dataflows",
            "pipelines", "spark_jobs", "notebooks", "sql_scripts", "triggers", "libraries",
            "datasets")
RUN_LISTINGS = ("pipeline_runs", "trigger_runs")


def reachable_pages(pages: DataFrame, chain: Sequence[str] = CHAIN,
                    max_pages: int | None = None) -> DataFrame:
    """The pages the continuation loop would have read.

    Page 1 is always read; page ``k + 1`` is read when page ``k`` has a
    token (neither null nor empty); a page missing from the dump ends the
    chain.  So a chain's last page is the smaller of its first page without a
    token and its first page whose successor is missing.  Chains without a
    page 1 yield nothing.  ``max_pages`` (run history only: the reference
    loop fetches at most ``max_pages + 1`` pages of it) cuts longer chains;
    by default nothing is cut.

    Pages without a successor come from an anti-join on ``page_no + 1``, and
    the end of a chain is a grouped minimum, so no chain is gathered anywhere,
    however long; the ends are joined back.
    """
    chain = list(chain)
    keys = pages.select(*chain, "page_no", "continuation_token")
    before = keys.select(*[F.col(c).alias(f"_e_{c}") for c in chain],
                         (F.col("page_no") - 1).alias("_prior")).distinct()
    last = keys.join(before, _null_safe(chain, "_e_") & (F.col("page_no") == F.col("_prior")), "left_anti")
    ended = keys.filter(F.coalesce("continuation_token", F.lit("")) == "")
    stops = last.unionByName(ended).select(*chain, "page_no", F.lit(False).alias("_opens"))
    opens = keys.filter("page_no = 1").select(*chain, F.lit(None).cast("int").alias("page_no"), F.lit(True).alias("_opens"))
    end = F.min(F.when(F.col("page_no") >= 1, F.col("page_no")))
    ends = (stops.unionByName(opens).groupBy(*chain).agg(end.alias("_end"), F.max("_opens").alias("_open"))
            .filter("_open").select(*[F.col(c).alias(f"_e_{c}") for c in chain],
                                    (F.least("_end", F.lit(max_pages + 1)) if max_pages is not None
                                     else F.col("_end")).alias("_end")))
    joined = pages.join(ends, _null_safe(chain, "_e_"), "inner")
    return (joined.filter(F.col("page_no").between(1, F.col("_end")))
            .drop("_end", *[f"_e_{c}" for c in chain]))


def _null_safe(cols, prefix):
    """Join condition ``col <=> prefix+col`` for each column (chain keys such
    as the day of a listing that is not per day may be null)."""
    cond = None
    for c in cols:
        eq = F.col(c).eqNullSafe(F.col(f"{prefix}{c}"))
        cond = eq if cond is None else cond & eq
    return cond


def flatten(pages: DataFrame, keep: Iterable[str] = (), remove: Iterable[str] = (),
            carry: Sequence[str] = ("workspace_name", "dataset")) -> DataFrame:
    """S39 + P1: one row per listed object, fields projected by keep / remove;
    ``carry`` columns of the page are kept in front.  Zoned times of the
    objects become UTC wall clock (timestamp without time zone)."""
    carry = [c for c in carry if c in pages.columns]
    items = pages.select(*carry, F.explode("value").alias("_item")).select(*carry, "_item.*")
    item_cols = [c for c in items.columns if c not in carry]
    kept = project(items.select(*item_cols), keep, remove).columns
    return utc_wall_clock(items.select(*carry, *[F.col(f"`{c}`") for c in kept]))


def read_listing(dumps: DataFrame, dataset: str, keep: Iterable[str] | None = None,
                 remove: Iterable[str] = ()) -> DataFrame:
    """The objects of one listing dataset, with its default keep-list;
    listings are read to the end of their chain, without a page cap."""
    keep = DEFAULT_KEEP.get(dataset, []) if keep is None else list(keep)
    pages = reachable_pages(dumps.filter(F.col("dataset") == dataset))
    return flatten(pages, keep, remove)


# kinds of values that JSON has, and the column type for each mixture
_NUMBERS = {"BIGINT", "DECIMAL", "DOUBLE"}


def _column_type(kinds: set[str]) -> str:
    kinds = kinds - {"VOID"}
    if len(kinds) == 1:
        return {"BIGINT": "bigint", "DECIMAL": "double", "DOUBLE": "double", "BOOLEAN": "boolean"}.get(*kinds, "string")
    return "double" if kinds and kinds <= _NUMBERS else "string"


def listing_fields(dumps: DataFrame) -> dict[str, dict[str, str]]:
    """The fields of each dataset's objects and a column type for each, over all
    pages and workspaces (``value``: array of VARIANT).

    Objects drift: fields are missing, added and retyped between workspaces.  All
    top-level fields are kept; whole numbers are ``bigint``, mixtures of numbers
    ``double``, and whatever differs otherwise, objects and lists ``string`` (JSON
    text for the latter).  One grouped pass; one row per dataset, field and kind
    reaches the driver."""
    items = dumps.select("dataset", F.explode("value").alias("_item"))
    fields = items.lateralJoin(dumps.sparkSession.tvf.variant_explode(F.col("_item").outer()))
    kind = F.regexp_extract(F.schema_of_variant("value"), "^[A-Z]+", 0)
    out: dict[str, dict[str, set]] = {}
    for r in fields.filter(F.col("key").isNotNull()).select("dataset", "key", kind.alias("kind")).distinct().collect():
        out.setdefault(r.dataset, {}).setdefault(r.key, set()).add(r.kind)
    return {d: {k: _column_type(v) for k, v in sorted(f.items())} for d, f in out.items()}


def _path(field: str) -> str:
    return f'$["{field}"]' if "'" in field else f"$['{field}']"


def read_drifting(dumps: DataFrame, dataset: str, fields: dict[str, str], keep: Iterable[str] | None = None,
                  remove: Iterable[str] = (), carry: Sequence[str] = ("workspace_name", "dataset")) -> DataFrame:
    """S23-S34 over objects of drifting shape: typed columns of the given fields
    (:func:`listing_fields`), null where an object lacks one; default keep-lists,
    keep and remove lists as in :func:`flatten`."""
    keep = DEFAULT_KEEP.get(dataset, []) if keep is None else list(keep)
    wanted, unwanted = frozenset(keep), frozenset(remove)
    names = [f for f in fields if (not wanted or f.lower() in wanted) and f.lower() not in unwanted]
    carry = [c for c in carry if c in dumps.columns]
    names = [f for f in names if f not in carry]
    pages = reachable_pages(dumps.filter(F.col("dataset") == dataset))
    return (pages.select(*carry, F.explode("value").alias("_item"))
            .select(*carry, *[F.try_variant_get("_item", _path(f), fields[f]).alias(f) for f in names]))


def drifts(dumps: DataFrame) -> bool:
    """Whether a dump's objects are VARIANT values."""
    return dumps.schema["value"].dataType.simpleString() == "array<variant>"


def runs(dumps: DataFrame, dataset: str, days: Iterable | None = None,
         keep: Iterable[str] = (), remove: Iterable[str] = (),
         max_pages: int | None = None) -> DataFrame:
    """Pipeline or trigger runs, one chain per requested day; the
    chain's day becomes the ``last_upd`` partition column.  ``days`` limits
    the chains read (e.g. from :func:`estate.operators.filters.day_list`)."""
    d = dumps.filter(F.col("dataset") == dataset)
    if days is not None:
        d = d.filter(F.col("day").isin(list(days)))
    out = flatten(reachable_pages(d, max_pages=max_pages), keep, remove,
                  carry=("workspace_name", "dataset", "day"))
    return out.withColumnRenamed("day", "last_upd")


def first_page(dumps: DataFrame, dataset: str, keep: Iterable[str] = (),
               remove: Iterable[str] = ()) -> DataFrame:
    """Objects of page 1 only (the older single-request form)."""
    return flatten(dumps.filter((F.col("dataset") == dataset) & (F.col("page_no") == 1)),
                   keep, remove)
