"""The test tables in the roles that the operators need; each view has its SQL beside it.

documents are records (language as country, source as one of three origins),
lineitem and orders are scored pairs and their entities, customers with their
nations are raw addresses. Every view covers its whole tables and whole texts.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from rowkin.functions.text import ACCENTED, LIGATURES, PLAIN, fold


def read(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def sql_fold(text: str) -> str:
    out = f"lower(coalesce({text}, ''))"
    for sign, letters in LIGATURES:
        out = f"replace({out}, '{sign}', '{letters}')"
    return f"translate({out}, '{ACCENTED}', '{PLAIN}')"


def records(spark: SparkSession, sf_dir: str) -> DataFrame:
    """rid, country, source, text, norm (folded words), tokens (distinct words of two letters or more), lines."""
    docs = read(spark, sf_dir, "documents")
    n = F.substring("source", 4, 9).cast("int")
    folded = fold(F.col("text"))
    norm = F.trim(F.regexp_replace(folded, "[^a-z0-9]+", " "))
    return docs.select(
        F.col("doc_id").alias("rid"),
        F.col("lang").alias("country"),
        F.when(n < 4, 1).when(n < 12, 2).otherwise(3).alias("source"),
        F.coalesce("text", F.lit("")).alias("text"),
        norm.alias("norm"),
        F.array_distinct(F.filter(F.split(norm, " "), lambda t: F.length(t) >= 2)).alias("tokens"),
        F.filter(F.transform(F.split(folded, "\n"), lambda x: F.trim(F.regexp_replace(x, "[^a-z0-9]+", " "))), lambda x: x != "").alias("lines"),
    )


RECORDS = rf"""
rec0 AS (
  SELECT doc_id AS rid, lang AS country, CAST(substr(source, 4) AS INTEGER) AS sn, coalesce(text, '') AS text,
         {sql_fold("text")} AS folded, trim(regexp_replace({sql_fold("text")}, '[^a-z0-9]+', ' ', 'g')) AS norm
  FROM documents
), rec AS (
  SELECT rid, country, CASE WHEN sn < 4 THEN 1 WHEN sn < 12 THEN 2 ELSE 3 END AS source, text, norm,
         list_distinct(list_filter(string_split(norm, ' '), lambda t: length(t) >= 2)) AS tokens,
         list_filter(list_transform(string_split(folded, chr(10)), lambda x: trim(regexp_replace(x, '[^a-z0-9]+', ' ', 'g'))), lambda x: x <> '') AS lines
  FROM rec0
)"""


def pairs(spark: SparkSession, sf_dir: str) -> DataFrame:
    """s, q, p, label: an order and a part that it holds, with a probability from discount and tax."""
    p = F.round(0.9 * (10 * F.col("l_discount")) + F.col("l_tax") + 0.01, 6)
    return read(spark, sf_dir, "lineitem").groupBy(F.col("l_orderkey").alias("s"), F.col("l_partkey").alias("q")).agg(F.max(p).alias("p"), F.bool_or(F.col("l_returnflag") == "R").alias("label"))


def entities(spark: SparkSession, sf_dir: str) -> DataFrame:
    """s, country, t: orders, with one match more than their pairs show where the order is pending."""
    found = pairs(spark, sf_dir).where("label").groupBy("s").agg(F.count(F.lit(1)).alias("n"))
    orders = read(spark, sf_dir, "orders").select(F.col("o_orderkey").alias("s"), F.col("o_orderpriority").alias("country"), F.col("o_orderstatus").alias("status"))
    return orders.join(found, "s", "left").select("s", "country", (F.coalesce("n", F.lit(0)) + F.when(F.col("status") == "P", 1).otherwise(0)).alias("t"))


PAIRS = """
pairs AS (
  SELECT l_orderkey AS s, l_partkey AS q, max(round(0.9::DOUBLE * (10 * l_discount) + l_tax + 0.01::DOUBLE, 6)) AS p, bool_or(l_returnflag = 'R') AS label
  FROM lineitem GROUP BY 1, 2
), ents AS (
  SELECT o_orderkey AS s, o_orderpriority AS country, CAST(coalesce(n, 0) + CASE WHEN o_orderstatus = 'P' THEN 1 ELSE 0 END AS BIGINT) AS t
  FROM orders LEFT JOIN (SELECT s, count(*) AS n FROM pairs WHERE label GROUP BY 1) f ON f.s = o_orderkey
)"""


def addresses(spark: SparkSession, sf_dir: str) -> DataFrame:
    """rid, country, name, address: customers and suppliers as they might be written."""
    nation = read(spark, sf_dir, "nation").join(read(spark, sf_dir, "region"), F.col("n_regionkey") == F.col("r_regionkey"))
    cust = read(spark, sf_dir, "customer").join(nation, F.col("c_nationkey") == F.col("n_nationkey"))
    number = F.col("c_custkey").cast("string")
    return cust.select(
        F.col("c_custkey").alias("rid"),
        F.col("r_name").alias("country"),
        F.concat_ws(" ", "c_mktsegment", "c_name", F.lit("Co Ltd")).alias("name"),
        F.concat(number, F.lit(" "), F.lower("c_mktsegment"), F.lit(" st, near "), F.lower("r_name"), F.lit(" gate, "), F.lower("n_name"), F.lit(", "), F.lpad(number, 5, "7"), F.lit(" "), F.lower("r_name")).alias("address"),
    )


ADDRESSES = """
adr AS (
  SELECT c_custkey AS rid, r_name AS country, c_mktsegment || ' ' || c_name || ' Co Ltd' AS name,
         CAST(c_custkey AS VARCHAR) || ' ' || lower(c_mktsegment) || ' st, near ' || lower(r_name) || ' gate, ' || lower(n_name) || ', '
           || lpad(CAST(c_custkey AS VARCHAR), 5, '7') || ' ' || lower(r_name) AS address
  FROM customer JOIN nation ON c_nationkey = n_nationkey JOIN region ON n_regionkey = r_regionkey
)"""


def house_pairs(spark: SparkSession, sf_dir: str) -> DataFrame:
    """line, a, b: a part number and what could be made of it, by line number."""
    a, n = F.col("l_partkey").cast("string"), F.col("l_linenumber")
    b = F.when(n == 1, a).when(n == 2, F.concat(F.lit("0"), a)).when(n == 3, F.concat(a, F.lit("c"))).when(n == 4, (F.col("l_partkey") + 1).cast("string")).when(n == 5, F.substring(a, 2, 20)).when(n == 6, F.reverse(a)).otherwise(F.col("l_suppkey").cast("string"))
    return read(spark, sf_dir, "lineitem").select(F.col("l_orderkey").alias("line"), a.alias("a"), b.alias("b"))


HOUSES = """
houses AS (
  SELECT l_orderkey AS line, CAST(l_partkey AS VARCHAR) AS a,
         CASE l_linenumber WHEN 1 THEN CAST(l_partkey AS VARCHAR) WHEN 2 THEN '0' || CAST(l_partkey AS VARCHAR) WHEN 3 THEN CAST(l_partkey AS VARCHAR) || 'c'
           WHEN 4 THEN CAST(l_partkey + 1 AS VARCHAR) WHEN 5 THEN substr(CAST(l_partkey AS VARCHAR), 2) WHEN 6 THEN reverse(CAST(l_partkey AS VARCHAR)) ELSE CAST(l_suppkey AS VARCHAR) END AS b
  FROM lineitem
), houses2 AS (
  SELECT *, CASE WHEN regexp_matches(a, '^0+$') THEN '0' ELSE ltrim(regexp_replace(a, '[^0-9]', '', 'g'), '0') END AS x,
            CASE WHEN regexp_matches(regexp_replace(b, '[^0-9]', '', 'g'), '^0+$') THEN '0' ELSE ltrim(regexp_replace(b, '[^0-9]', '', 'g'), '0') END AS y
  FROM houses
)"""


def name_pairs(spark: SparkSession, sf_dir: str) -> DataFrame:
    """a, b: distinct part names that share a word."""
    names = read(spark, sf_dir, "part").select(F.col("p_name").alias("n")).distinct()
    words = names.select("n", F.explode(F.array_distinct(F.split("n", " "))).alias("w"))
    return words.withColumnRenamed("n", "a").join(words.withColumnRenamed("n", "b"), "w").where("a < b").select("a", "b").distinct()


NAME_PAIRS = """
words AS (SELECT DISTINCT p_name AS n, unnest(string_split(p_name, ' ')) AS w FROM part),
npairs AS (SELECT DISTINCT x.n AS a, y.n AS b FROM words x JOIN words y ON x.w = y.w AND x.n < y.n)"""


def crowd_records(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Parts as records: small ones are reference entities, the brand is the country."""
    part = read(spark, sf_dir, "part")
    return part.select(F.col("p_partkey").alias("rid"), F.when(F.col("p_size") <= 25, 1).otherwise(2).alias("source"), F.col("p_brand").alias("country"), F.col("p_name").alias("name_core"), F.concat_ws(" ", "p_type", F.col("p_size").cast("string")).alias("addr"), F.col("p_type").alias("street"))


def crowd_pairs(spark: SparkSession, sf_dir: str) -> DataFrame:
    """q, s, p: the part and, as a part number, the supplier of a line."""
    p = F.round(0.9 * (10 * F.col("l_discount")) + F.col("l_tax") + 0.01, 6)
    return read(spark, sf_dir, "lineitem").groupBy(F.col("l_partkey").alias("q"), F.col("l_suppkey").alias("s")).agg(F.max(p).alias("p"))


CROWD = """
crec AS (
  SELECT p_partkey AS rid, CASE WHEN p_size <= 25 THEN 1 ELSE 2 END AS source, p_brand AS country, p_name AS name_core, p_type || ' ' || CAST(p_size AS VARCHAR) AS addr, p_type AS street FROM part
), cpairs AS (
  SELECT l_partkey AS q, l_suppkey AS s, max(round(0.9::DOUBLE * (10 * l_discount) + l_tax + 0.01::DOUBLE, 6)) AS p FROM lineitem GROUP BY 1, 2
)"""
