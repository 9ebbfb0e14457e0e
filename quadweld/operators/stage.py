"""Cutting lineage with a written table, and the guards against heavy keys.

Results never depend on which keys are found heavy: the list only decides how
rows are spread over tasks.
"""

from __future__ import annotations

import uuid
from collections.abc import Iterator
from contextlib import contextmanager
from contextvars import ContextVar

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.group import GroupedData
from pyspark.sql.types import MapType, StringType

# Tables below this many rows cannot hold a key worth splitting.
HEAVY_FLOOR = 1_000_000
# A key is heavy when it holds more than this share of all rows, or more rows than one task
# should hold; a sketch of at most MOST_HEAVY keys finds them.
HEAVY_SHARE = 1 / 5_000
TASK_ROWS = 20_000_000
MOST_HEAVY = 50_000
# Copies made of the matching lookup row of a heavy key.
SALTS = 64


def scratch_dir(spark: SparkSession) -> str:
    """Shared folder named by the session, else the warehouse, which is shared as well."""
    return spark.conf.get("spark.checkpoint.dir", None) or spark.conf.get("spark.sql.warehouse.dir")


# Folder of the innermost run that is open, in this thread or task.
_RUN: ContextVar[str | None] = ContextVar("run", default=None)


def new_run(spark: SparkSession) -> str:
    return f"{scratch_dir(spark)}/quadweld/run-{uuid.uuid4().hex}"


@contextmanager
def writing_to(folder: str) -> Iterator[None]:
    """Copies made inside go to ``folder``, whose owner removes it."""
    token = _RUN.set(folder)
    try:
        yield
    finally:
        _RUN.reset(token)


def file_system(spark: SparkSession, path: str):
    """The Hadoop file system of a path, and the path as it wants it."""
    place = spark._jvm.org.apache.hadoop.fs.Path(path)
    return place.getFileSystem(spark._jsc.hadoopConfiguration()), place


def remove(spark: SparkSession, path: str) -> None:
    store, place = file_system(spark, path)
    store.delete(place, True)


#: Tasks over which a copy may stay dealt; Spark allows no more buckets.
MOST_BUCKETS = 100_000


def materialize(df: DataFrame, label: str, key: str | None = None, tasks: int = 0) -> DataFrame:
    """Write ``df`` once to the shared folder and read it back.

    The copy survives lost executors, has a short lineage, and its file sizes
    let Catalyst choose joins from real sizes. Rows that lie by ``key`` in ``tasks`` tasks (see ``distinct_dealt``) still do
    so in the copy, one bucket for each task, so groupings and windows over it need no exchange.
    """
    spark = df.sparkSession
    top = _RUN.get() or f"{scratch_dir(spark)}/quadweld"
    path = f"{top}/{label}-{uuid.uuid4().hex}"
    if key is None or not 1 < tasks <= MOST_BUCKETS:
        df.write.parquet(path)
        return spark.read.schema(df.schema).parquet(path)
    # Only a table knows its buckets. Its name goes at once; the rows read are those of the folder.
    name = f"quadweld_{label}_{uuid.uuid4().hex}"
    df.write.format("parquet").bucketBy(tasks, key).option("path", path).saveAsTable(name)
    copy = spark.read.table(name)
    spark.sql(f"DROP TABLE {name}")
    return copy


def key_hash(keys: list[str]) -> Column:
    return F.xxhash64(*keys)


def grouped(df: DataFrame, keys: list[str]) -> GroupedData:
    """Rows grouped by ``keys``, with the hash of the keys in front of them as ``_key``.

    Aggregates of texts, structs and lists sort their rows. Names begin alike, so a sort by the names compares
    them to the end; the hash differs in its first bytes. The groups are the same.
    """
    return df.groupBy(key_hash(keys).alias("_key"), *keys)


def heavy_keys(
    df: DataFrame,
    keys: list[str],
    share: float | None = None,
    floor: int | None = None,
) -> list[int]:
    """Hashes of the keys that hold more than ``share`` of the rows.

    Meant for scans and written tables, where a pass reads only the key.
    """
    return heavy_columns(df, {"keys": keys}, share, floor)["keys"]


def heavy_columns(
    df: DataFrame,
    keys: dict[str, list[str]],
    share: float | None = None,
    floor: int | None = None,
) -> dict[str, list[int]]:
    """Heavy hashes of several keys in one pass with bounded heavy-hitter sketches.

    A share of None means ``HEAVY_SHARE``, or what one task should hold of very large tables.
    """
    floor = HEAVY_FLOOR if floor is None else floor
    n = df.count()
    if n < floor:
        return {name: [] for name in keys}
    if share is None:
        share = max(min(HEAVY_SHARE, TASK_ROWS / n), 1 / MOST_HEAVY)
    most = int(1 / share)
    tops = [
        F.expr(f"approx_top_k(xxhash64({', '.join(f'`{k}`' for k in columns)}), {most}, {8 * most})").alias(name)
        for name, columns in keys.items()
    ]
    row, limit = df.agg(*tops).first(), max(1, int(n * share))
    return {name: [t["item"] for t in row[name] or [] if t["count"] > limit] for name in keys}


# Rows that one task groups and sorts.
EVEN_ROWS = 500_000


def tasks_for(df: DataFrame, n: int) -> int:
    """Tasks that ``n`` rows need, never fewer than the session's."""
    return max(int(df.sparkSession.conf.get("spark.sql.shuffle.partitions")), -(-n // EVEN_ROWS))


def spread(df: DataFrame, keys: list[str], n: int) -> DataFrame:
    """The ``n`` rows of ``df`` dealt by ``keys`` over as many tasks as they need, never fewer than the session's."""
    return df if n < HEAVY_FLOOR else df.repartition(tasks_for(df, n), *keys)


def distinct_near(df: DataFrame, key: str) -> DataFrame:
    """Distinct rows, those of one ``key`` in one task, so that grouping them further needs no new exchange."""
    return distinct_dealt(df, key)[0]


def distinct_dealt(df: DataFrame, key: str) -> tuple[DataFrame, int]:
    """Distinct rows, those of one ``key`` in one task, and the number of such tasks; 0 if a key is too heavy for that, 1
    if the rows are few, wherever they lie.

    Rows made from one row of the input travel side by side and pack well. Rows of keys that are too heavy for one task, found in
    a first pass over the key, are dealt by all their columns.
    """
    most = int(1 / HEAVY_SHARE)
    top = F.expr(f"approx_top_k(xxhash64(`{key}`), {most}, {8 * most})").alias("top")
    found = df.agg(F.count(F.lit(1)).alias("n"), top).first()
    n = found["n"]
    if n < HEAVY_FLOOR:
        return df.distinct(), 1
    limit = max(1, int(n * min(HEAVY_SHARE, TASK_ROWS / n)))
    heavy = [t["item"] for t in found["top"] or [] if t["count"] > limit]
    if not heavy:
        return spread(df, [key], n).distinct(), tasks_for(df, n)
    is_heavy = key_hash([key]).isin(heavy)
    return spread(df.where(~is_heavy), [key], n).distinct().unionByName(df.where(is_heavy).distinct()), 0


def lookup(
    fact: DataFrame,
    dim: DataFrame,
    on: list[str],
    heavy: list[int] | None = None,
    how: str = "left",
) -> DataFrame:
    """Equi-join that spreads the fact rows of heavy keys over ``SALTS`` tasks.

    Without heavy keys this is the plain join, and Catalyst or AQE broadcasts
    ``dim`` when its measured size allows. With heavy keys only their rows in
    ``dim`` are copied; all other keys keep salt 0.
    """
    if not heavy:
        return fact.join(dim, on, how)
    is_heavy = key_hash(on).isin(heavy)
    # Any other columns that can be hashed tell the rows of one key apart.
    others = [
        f.name for f in fact.schema if f.name not in on and not isinstance(f.dataType, MapType)
    ] or on
    salted = fact.withColumn(
        "_salt",
        F.when(is_heavy, F.pmod(F.xxhash64(*others), F.lit(SALTS))).otherwise(F.lit(0)).cast("int"),
    )
    copies = F.when(is_heavy, F.sequence(F.lit(0), F.lit(SALTS - 1))).otherwise(F.array(F.lit(0)))
    copied = dim.withColumn("_salt", F.explode(copies))
    return salted.join(copied, [*on, "_salt"], how).drop("_salt")


def keyed_lookup(
    fact: DataFrame,
    dim: DataFrame,
    on: list[str],
    heavy: list[int] | None = None,
    how: str = "left",
    keep: bool = False,
) -> DataFrame:
    """``lookup`` by long names: the rows are sorted by the hash of the names first, see ``grouped``.

    ``keep`` leaves the hash in the column ``_key``, so that a grouping by it and the names needs no new exchange.
    """
    if heavy:
        met = lookup(fact, dim, on, heavy, how)
        return met.withColumn("_key", key_hash(on)) if keep else met
    fact, dim = (df.withColumn("_key", key_hash(on)) for df in (fact, dim))
    met = fact.join(dim, ["_key", *on], how)
    return met if keep else met.drop("_key")


# A key whose rows make more than the square of this many pairs is dealt over a grid of such cells.
CELL_ROWS = 4_096


def grid_join(left: DataFrame, right: DataFrame, on: list[str]) -> DataFrame:
    """Inner equi-join for keys that can be heavy on both sides; meant for written tables.

    A key with l and r rows becomes ceil(l / CELL_ROWS) times ceil(r / CELL_ROWS) cells. A left row goes to all cells
    of one line, a right row to all cells of one column, so each pair meets once, no cell makes more
    than about CELL_ROWS squared pairs, and the copies are few beside the pairs. Other keys are one cell.
    """
    if left.count() + right.count() < HEAVY_FLOOR:
        return left.join(right, on)
    counts = [
        df.groupBy(*on).agg(F.count(F.lit(1)).alias(name)) for df, name in ((left, "_lines"), (right, "_columns"))
    ]
    both = counts[0].join(counts[1], on)
    # Two counts as doubles: their product may pass 64 bits.
    pairs = F.col("_lines").cast("double") * F.col("_columns")
    cells = {c: F.ceil(F.col(c) / F.lit(CELL_ROWS)) for c in ("_lines", "_columns")}
    large = materialize(both.where(pairs > F.lit(float(CELL_ROWS) ** 2)).withColumns(cells), "grid")
    if large.isEmpty():
        return left.join(right, on)

    def dealt(df: DataFrame, own: str, other: str) -> DataFrame:
        fields = [f.name for f in df.schema if f.name not in on and not isinstance(f.dataType, MapType)] or on
        place = F.pmod(F.xxhash64(*fields), F.coalesce(own, F.lit(1)))
        every = F.sequence(F.lit(0), (F.coalesce(other, F.lit(1)) - 1).cast("int"))
        met = attach(df, large, on)
        return met.withColumn(f"{own}_at", place.cast("int")).withColumn(f"{other}_at", F.explode(every)).drop(own, other)

    cell = ["_lines_at", "_columns_at"]
    joined = dealt(left, "_lines", "_columns").join(dealt(right, "_columns", "_lines"), [*on, *cell])
    return joined.drop(*cell)


# A lookup table of at most this many rows and bytes of text may be broadcast.
BROADCAST_ROWS = 1_000_000
BROADCAST_BYTES = 64 << 20


def is_small(df: DataFrame, rows: int | None = None) -> bool:
    """Whether ``df`` has at most ``rows`` rows, and little text; reads no more rows than that."""
    rows = BROADCAST_ROWS if rows is None else rows
    texts = [F.coalesce(F.octet_length(f.name), F.lit(0)) for f in df.schema if isinstance(f.dataType, StringType)]
    size = sum(texts, F.lit(0)).cast("long")
    found = df.limit(rows + 1).agg(F.count(F.lit(1)).alias("n"), F.sum(size).alias("bytes")).first()
    return found["n"] <= rows and (found["bytes"] or 0) <= BROADCAST_BYTES


def attach(fact: DataFrame, dim: DataFrame, on: list[str], how: str = "left") -> DataFrame:
    """Join a lookup table: broadcast after counting it, else spread heavy keys."""
    if is_small(dim):
        return fact.join(F.broadcast(dim), on, how)
    return lookup(fact, dim, on, heavy_keys(fact, on), how)
