"""JDBC sources for SQL pools.

Readers are plain ``spark.read.format("jdbc")``.  Unlike a single-partition
read, :func:`read_table` can split a scan over a numeric column
(``partitionColumn`` / ``lowerBound`` / ``upperBound`` / ``numPartitions``)
and always applies the configured ``fetchsize``.  Filters and column
selections written as DataFrame operations on the result are pushed to the
source by Catalyst, so no predicate is ever concatenated into SQL text.
"""

from __future__ import annotations

from collections.abc import Callable, Iterable
from dataclasses import dataclass, field
from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

# fixed values: connection defaults of the extract settings
LOGIN_TIMEOUT_S = 30
FETCH_SIZE = 1000


@dataclass(frozen=True)
class PoolConnection:
    """Where and how to reach one SQL pool database."""
    url: str
    user: str | None = None
    password: str | None = field(default=None, repr=False)
    driver: str | None = None
    fetch_size: int = FETCH_SIZE
    login_timeout_s: int = LOGIN_TIMEOUT_S
    extra: dict = field(default_factory=dict)

    def options(self) -> dict[str, str]:
        # Source datetimes are server wall-clock values: read them as
        # timestamps without time zone, so no session zone shifts them.
        opts = {"url": self.url, "fetchsize": str(self.fetch_size),
                "loginTimeout": str(self.login_timeout_s), "preferTimestampNTZ": "true"}
        if self.user is not None:
            opts["user"] = self.user
        if self.password is not None:
            opts["password"] = self.password
        if self.driver:
            opts["driver"] = self.driver
        opts.update({k: str(v) for k, v in self.extra.items()})
        return opts


def pool_url(template: str, endpoint: str, database: str | None = None) -> str:
    """Fill a URL template such as
    ``jdbc:sqlserver://{endpoint}:1433;database={database}``."""
    return template.format(endpoint=endpoint, database=database or "")


def reader(spark: SparkSession, conn: PoolConnection):
    """A JDBC reader with the connection's options."""
    return spark.read.format("jdbc").options(**conn.options())


def run_query(spark: SparkSession, conn: PoolConnection, relation: str) -> DataFrame:
    """S3: a table name or a parenthesised, aliased subquery as a DataFrame."""
    return reader(spark, conn).option("dbtable", relation).load()


def read_table(spark: SparkSession, conn: PoolConnection, table: str,
               partition_column: str | None = None, lower: int | None = None,
               upper: int | None = None, num_partitions: int | None = None) -> DataFrame:
    """A table scan, split into ``num_partitions`` ranges of a numeric column
    when one is given (parallel reads instead of a single connection)."""
    r = reader(spark, conn).option("dbtable", table)
    if partition_column and num_partitions and lower is not None and upper is not None:
        r = (r.option("partitionColumn", partition_column).option("lowerBound", lower)
             .option("upperBound", upper).option("numPartitions", num_partitions))
    return r.load()


def quoted(name: str) -> str:
    """An identifier in brackets, safe inside SQL text."""
    return "[" + name.replace("]", "]]") + "]"


def union_databases(per_database: Callable[[str], DataFrame], databases: Iterable[str],
                    label: str | None = "table_catalog") -> DataFrame | None:
    """One scan per database, for sources that answer for one database
    at a time (a JDBC connection); a relation that holds all databases is one
    scan instead (:func:`scan_databases`).  The branches are united by position,
    as ``UNION ALL`` does; ``label`` adds the database name as a column.  ``None``
    when no database is in scope."""
    frames = []
    for db in databases:
        df = per_database(db)
        if label:
            df = df.withColumn(label, F.lit(db))
        frames.append(df)
    if not frames:
        return None
    return reduce(lambda a, b: a.union(b), frames)


def _common_type(types: list[T.DataType]) -> T.DataType:
    """The least type that holds all of them: one type stays, whole numbers widen,
    numbers of several kinds become double (decimals and whole numbers a wide
    decimal), dates and timestamps a timestamp, everything else text."""
    kinds = [t for t in dict.fromkeys(types) if not isinstance(t, T.NullType)]
    if len(kinds) <= 1:
        return kinds[0] if kinds else T.StringType()
    if all(isinstance(t, T.IntegralType) for t in kinds):
        order = (T.ByteType, T.ShortType, T.IntegerType, T.LongType)
        return max(kinds, key=lambda t: order.index(type(t)))
    if all(isinstance(t, T.NumericType) for t in kinds):
        if any(isinstance(t, T.FractionalType) and not isinstance(t, T.DecimalType) for t in kinds):
            return T.DoubleType()
        scale = max(t.scale for t in kinds if isinstance(t, T.DecimalType))
        return T.DecimalType(38, scale)
    if all(isinstance(t, (T.DateType, T.TimestampNTZType)) for t in kinds):
        return T.TimestampNTZType()
    return T.StringType()


def union_by_position(frames: list[DataFrame]) -> DataFrame:
    """``UNION ALL`` of frames that differ in names and types: columns meet by
    position, under the first frame's names, each cast to the least common type of
    its position.  The branches form one balanced tree, so a plan over many
    databases stays ``log2`` deep."""
    width = {len(f.columns) for f in frames}
    if len(width) != 1:
        raise ValueError(f"UNION ALL needs equally many columns, not {sorted(width)}")
    names = frames[0].columns
    types = [_common_type([f.schema.fields[i].dataType for f in frames]) for i in range(len(names))]
    level = [f.toDF(*[f"_c{i}" for i in range(len(names))]) for f in frames]
    level = [f.select(*[F.col(f"_c{i}").cast(t).alias(n) for i, (t, n) in enumerate(zip(types, names))]) for f in level]
    while len(level) > 1:
        level = [a[0] if len(a) == 1 else a[0].union(a[1]) for a in (level[i:i + 2] for i in range(0, len(level), 2))]
    return level[0]


def union_by_collation(per_database: Callable[[str], DataFrame], databases: Iterable[tuple[str, str | None]],
                       label: str = "table_catalog", collation: str = "collation_name") -> DataFrame | None:
    """U1 / X3 / A5 as the source unites its catalog views: one union per collation
    (texts of different collations can't meet in one statement), each branch
    labelled with its database, and the groups united with their collation as a
    column.  ``databases``: (name, collation) pairs of one server, null collations
    being a group; ``None`` when there are none."""
    groups: dict[str | None, list[DataFrame]] = {}
    for name, group in databases:
        branch = per_database(name)
        groups.setdefault(group, []).append(branch.withColumn(label, F.lit(name)))
    if not groups:
        return None
    united = [union_by_position(frames).withColumn(collation, F.lit(group).cast("string")) for group, frames in groups.items()]
    return union_by_position(united)


def scan_databases(relation: DataFrame, databases: DataFrame, name: str = "name",
                   label: str = "table_catalog") -> DataFrame:
    """U1 over one relation that carries its database in column ``label``: one
    scan, kept to the databases in ``databases`` (column ``name``) by a join,
    whatever their number; no name passes through the driver."""
    wanted = databases.select(F.col(name).alias("_db")).distinct()
    return relation.join(wanted, F.col(label) == F.col("_db"), "left_semi")
