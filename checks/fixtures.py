"""Quad tables derived from the given tables.

Each text is in the common subset of Spark SQL and DuckDB, with ``{table}`` for a
table. It defines the inputs of the checks and is not part of the engine.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from quadweld.model import OWL_SAME_AS, QUADS_SCHEMA, RDF_TYPE  # noqa: F401  the schema is for the queries

PART = "'http://ex/part/' || cast(l_partkey AS string)"
SOURCE = "'http://ex/g/' || cast(l_suppkey AS string)"


def claims_sql(where: str = "") -> str:
    """Conflicting claims about parts; the supplier is the source."""
    columns = {
        "price": "cast(cast(l_extendedprice AS decimal(18,2)) AS string)",
        "discount": "cast(cast(l_discount AS decimal(18,2)) AS string)",
        "flag": "l_returnflag",
        "qty": "CASE WHEN l_linenumber = 7 THEN 'n/a' "
        "ELSE cast(cast(l_quantity AS decimal(18,2)) AS string) END",
        "shipped": "cast(cast(l_shipdate AS date) AS string)",
    }
    return " UNION ALL ".join(
        f"SELECT {PART} AS s, 'http://ex/p/{name}' AS p, 'lit' AS o_kind, {value} AS o, "
        f"{SOURCE} AS g FROM {{lineitem}}{where}"
        for name, value in columns.items()
    )


CLAIMS = claims_sql()


def claims(spark: SparkSession, sf_dir: str, where: str = "true") -> DataFrame:
    """The claims in one scan of the items; DuckDB makes them from ``claims_sql``."""
    money = lambda c: F.col(c).cast("decimal(18,2)").cast("string")
    values = {
        "price": money("l_extendedprice"),
        "discount": money("l_discount"),
        "flag": F.col("l_returnflag"),
        "qty": F.when(F.col("l_linenumber") == 7, F.lit("n/a")).otherwise(money("l_quantity")),
        "shipped": F.col("l_shipdate").cast("date").cast("string"),
    }
    pairs = F.array(
        *[F.struct(F.lit(f"http://ex/p/{k}").alias("p"), v.alias("o")) for k, v in values.items()]
    )
    items = spark.read.parquet(f"{sf_dir}/lineitem.parquet").where(where)
    return items.select(F.expr(PART).alias("s"), F.expr(SOURCE).alias("g"), F.explode(pairs).alias("c")).selectExpr(
        "0 AS src", "s", "c.p", "'lit' AS o_kind", "c.o",
        "cast(null AS string) AS o_dt", "cast(null AS string) AS o_lang", "g",
    )


# Links between parts, between customers (objects of orders) and between two properties.
LINKS = f"""
SELECT 'http://ex/part/' || cast(p_partkey AS string) AS s, '{OWL_SAME_AS}' AS p, 'iri' AS o_kind,
       'http://ex/part/' || cast(p_partkey + 1 AS string) AS o, 'http://ex/g/links' AS g
FROM {{part}} WHERE p_partkey % 5 IN (0, 1)
UNION ALL
SELECT 'http://ex/customer/' || cast(c_custkey AS string), '{OWL_SAME_AS}', 'iri',
       'http://ex/customer/' || cast(c_custkey + 2 AS string), 'http://ex/g/links'
FROM {{customer}} WHERE c_custkey % 4 = 1
UNION ALL
SELECT 'http://ex/p/segment', '{OWL_SAME_AS}', 'iri', 'http://ex/p/branch', 'http://ex/g/links'
FROM {{nation}} WHERE n_nationkey = 0
"""

PREFERRED = """
SELECT 'http://ex/part/' || cast(p_partkey AS string) AS uri
FROM {part} WHERE p_partkey % 5 = 1 AND p_brand = 'Brand#13'
"""

CLASSES = f"""
SELECT 'http://ex/part/' || cast(p_partkey AS string) AS s, '{RDF_TYPE}' AS p, 'iri' AS o_kind,
       'http://ex/class/' || p_type AS o, 'http://ex/g/catalog' AS g FROM {{part}}
"""

SCORES = """
SELECT 'http://ex/g/' || cast(s_suppkey AS string) AS s, 'http://ex/meta/score' AS p, 'lit' AS o_kind,
       cast(cast(cast((s_suppkey * 37) % 101 AS decimal(9,4)) / 100 AS decimal(5,2)) AS string) AS o,
       'http://ex/g/meta' AS g
FROM {supplier} WHERE s_suppkey % 7 <> 6
UNION ALL
SELECT 'http://ex/nation/' || cast(n_nationkey AS string), 'http://ex/meta/publisherScore', 'lit',
       cast(cast(cast((n_nationkey * 13) % 101 AS decimal(9,4)) / 100 AS decimal(5,2)) AS string),
       'http://ex/g/meta' FROM {nation}
UNION ALL
SELECT 'http://ex/g/' || cast(s_suppkey AS string), 'http://ex/meta/publishedBy', 'iri',
       'http://ex/nation/' || cast(s_nationkey AS string), 'http://ex/g/meta' FROM {supplier}
"""

ORDERS = """
SELECT 'http://ex/order/' || cast(o_orderkey AS string) AS s, 'http://ex/p/placedBy' AS p, 'iri' AS o_kind,
       'http://ex/customer/' || cast(o_custkey AS string) AS o, 'http://ex/g/orders' AS g FROM {orders}
UNION ALL
SELECT 'http://ex/customer/' || cast(c_custkey AS string), 'http://ex/p/segment', 'lit', c_mktsegment,
       'http://ex/g/crm' FROM {customer}
"""

# Names with languages and datatypes: the same text in another language is another value.
TAGGED = """
SELECT 'http://ex/nation/' || cast(n_nationkey AS string) AS s, 'http://ex/p/name' AS p, 'lit' AS o_kind,
       'name ' || cast(n_regionkey AS string) AS o, cast(null AS string) AS o_dt,
       CASE WHEN n_nationkey % 3 = 0 THEN 'en' WHEN n_nationkey % 3 = 1 THEN 'fr' END AS o_lang,
       'http://ex/g/nations' AS g FROM {nation}
UNION ALL
SELECT 'http://ex/nation/' || cast(s_nationkey AS string), 'http://ex/p/name', 'lit',
       'name ' || cast(s_suppkey % 5 AS string),
       CASE WHEN s_suppkey % 4 = 0 THEN 'http://www.w3.org/2001/XMLSchema#string' END,
       CASE WHEN s_suppkey % 4 = 1 THEN 'en' END,
       'http://ex/g/' || cast(s_suppkey AS string) FROM {supplier}
UNION ALL
SELECT 'http://ex/nation/' || cast(s_nationkey AS string), 'http://ex/p/office', 'bnode',
       '_:b' || cast(s_suppkey % 7 AS string), cast(null AS string), cast(null AS string),
       'http://ex/g/' || cast(s_suppkey AS string) FROM {supplier}
"""

CHAINS = """
SELECT 'http://ex/customer/' || cast(c_custkey AS string) AS s,
       'http://ex/customer/' || cast(c_custkey + 1 AS string) AS o
FROM {customer} WHERE c_custkey % 50 < 49
"""

TABLES = ("part", "lineitem", "supplier", "nation", "orders", "customer")


def run(spark: SparkSession, sf_dir: str, sql: str) -> DataFrame:
    frames = {
        t: spark.read.parquet(f"{sf_dir}/{t}.parquet") for t in TABLES if f"{{{t}}}" in sql
    }
    return spark.sql(sql, **frames)


def quads(spark: SparkSession, sf_dir: str, sql: str) -> DataFrame:
    """The quads of a fixture, with the columns that it leaves out."""
    return run(spark, sf_dir, sql).selectExpr(
        "0 AS src", "s", "p", "o_kind", "o",
        "cast(null AS string) AS o_dt", "cast(null AS string) AS o_lang", "g",
    )


def duck(sql: str) -> str:
    """The fixture text for DuckDB, where the tables are plain views."""
    return sql.format(**{t: t for t in TABLES})
