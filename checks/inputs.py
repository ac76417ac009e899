"""Inputs that Spark derives from the supplied tables, with the same derivation in SQL."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from clientele.constants import ANALYSIS_FEATURES, CLUSTER_FEATURES
from clientele.operators.cleaning import clean_lines, typed_lines
from clientele.operators.features import engineer_features
from clientele.operators.scaling import robust_scale
from clientele.sources.tables import order_lines, table
from clientele.storage import materialize

MARKETS = ["AUTOMOBILE", "BUILDING", "FURNITURE", "HOUSEHOLD", "MACHINERY"]
DIMENSIONS = 64
VECTOR = [f"e{i}" for i in range(DIMENSIONS)]
K_LABELS = [f"k{k}" for k in range(2, 9)]


def features(spark: SparkSession, folder: str, log_mode: str = "auto") -> DataFrame:
    return engineer_features(clean_lines(order_lines(spark, folder)), log_mode)


def stored_features(spark: SparkSession, folder: str) -> DataFrame:
    return materialize(features(spark, folder), "features")


def scaled(spark: SparkSession, folder: str) -> DataFrame:
    return materialize(robust_scale(features(spark, folder), CLUSTER_FEATURES), "points")


def dirty_lines(spark: SparkSession, folder: str) -> DataFrame:
    """The order lines with every kind of fault, placed by the values of other columns."""
    lines = table(spark, folder, "lineitem")
    orders = table(spark, folder, "orders")
    number = F.col("l_linenumber")
    key, invoice = F.col("o_custkey").cast("string"), F.col("l_orderkey").cast("string")
    joined = lines.join(orders, lines.l_orderkey == orders.o_orderkey).select(
        F.when(number == 7, F.lit(None)).when(number == 6, F.concat(F.lit("  "), key, F.lit(" ")))
        .when(number == 5, F.concat(key, F.lit(".0"))).otherwise(key).alias("CustomerID"),
        F.when(F.col("l_returnflag") == "R", F.concat(F.lit("C"), invoice))
        .when((number == 1) & (F.col("l_linestatus") == "F"), F.concat(F.lit("Void"), invoice))
        .when((number == 4) & (F.col("l_returnflag") == "N"), F.lit(None))
        .otherwise(invoice).alias("InvoiceNo"),
        F.when(number == 3, F.lit(None)).otherwise(F.col("l_partkey").cast("string"))
        .alias("StockCode"),
        F.when(F.col("l_quantity") == 50, F.lit(float("nan")))
        .otherwise(F.col("l_quantity") - 5).alias("Quantity"),
        F.when(F.col("l_discount") == 0, F.lit(0.0))
        .when(F.col("l_tax") == 0, F.lit(None).cast("double"))
        .otherwise(F.col("l_extendedprice")).alias("UnitPrice"),
        F.when(F.col("o_orderstatus") == "P", F.lit(None).cast("timestamp_ntz"))
        .otherwise(F.col("o_orderdate").cast("timestamp_ntz")).alias("InvoiceDate"),
    )
    return joined.union(joined.where(F.col("InvoiceNo").endswith("7")))


def clean_dirty(spark: SparkSession, folder: str) -> DataFrame:
    return clean_lines(typed_lines(dirty_lines(spark, folder)))


def market_label() -> Column:
    """The market segment as a cluster number from 1; customers in debt count as noise."""
    place = F.array_position(F.array(*map(F.lit, MARKETS)), F.col("c_mktsegment")).cast("int")
    return F.when(F.col("c_acctbal") < 0, F.lit(-1)).otherwise(place)


def labeled_customers(spark: SparkSession, folder: str) -> DataFrame:
    given = table(spark, folder, "customer").select(
        F.col("c_custkey").cast("string").alias("CustomerID"), market_label().alias("cluster")
    )
    return materialize(features(spark, folder).join(given, "CustomerID"), "labeled")


def labeled_points(spark: SparkSession, folder: str) -> DataFrame:
    given = table(spark, folder, "customer").select(
        F.col("c_custkey").cast("string").alias("CustomerID"), market_label().alias("cluster")
    )
    return materialize(scaled(spark, folder).join(given, "CustomerID"), "labeled")


def leveled_points(spark: SparkSession, folder: str) -> DataFrame:
    """Scaled points with nested labels made from how often a customer bought."""
    customers = stored_features(spark, folder)
    level = customers.select(
        "CustomerID", F.floor(F.col("Frequency") / 3).cast("int").alias("level")
    )
    points = robust_scale(customers, CLUSTER_FEATURES).join(level, "CustomerID")
    of_level = F.col("level")
    return materialize(points.select(
        "CustomerID",
        *CLUSTER_FEATURES,
        F.lit(0).alias("k1"),
        *[F.least(of_level, F.lit(int(c[1:]) - 1)).alias(c) for c in K_LABELS],
        of_level.alias("KMeans"),
        F.least(of_level, F.lit(3)).alias("Agglomerative"),
        (of_level - 1).alias("DBSCAN"),
    ), "leveled")


def vectors(spark: SparkSession, folder: str) -> DataFrame:
    """Embeddings as columns with their label, and a version of it that has noise."""
    return materialize(table(spark, folder, "embeddings").select(
        "vec_id",
        *[F.col("embedding")[i].cast("double").alias(c) for i, c in enumerate(VECTOR)],
        "label",
        (F.col("label") - 1).alias("noisy"),
    ), "vectors")


# ---- The same inputs in SQL -----------------------------------------------------------------

LINES = """
lines AS (
  SELECT CAST(o_custkey AS VARCHAR) AS "CustomerID",
         CASE WHEN l_returnflag = 'R' THEN 'C' || l_orderkey ELSE CAST(l_orderkey AS VARCHAR) END
           AS "InvoiceNo",
         CAST(l_partkey AS VARCHAR) AS "StockCode", l_quantity AS "Quantity",
         l_extendedprice / l_quantity AS "UnitPrice",
         CAST(o_orderdate AS TIMESTAMP) AS "InvoiceDate"
  FROM lineitem JOIN orders ON l_orderkey = o_orderkey)"""

EVENT_LINES = """
lines AS (
  SELECT CAST(user_id AS VARCHAR) AS "CustomerID", CAST(event_id AS VARCHAR) AS "InvoiceNo",
         props AS "StockCode", CAST(1.0 AS DOUBLE) AS "Quantity", value AS "UnitPrice",
         CAST(ts AS TIMESTAMP) AS "InvoiceDate"
  FROM events WHERE event_type = 'purchase')"""

DIRTY = """
raw AS (
  SELECT CASE l_linenumber WHEN 7 THEN NULL WHEN 6 THEN '  ' || o_custkey || ' '
              WHEN 5 THEN o_custkey || '.0' ELSE CAST(o_custkey AS VARCHAR) END AS "CustomerID",
         CASE WHEN l_returnflag = 'R' THEN 'C' || l_orderkey
              WHEN l_linenumber = 1 AND l_linestatus = 'F' THEN 'Void' || l_orderkey
              WHEN l_linenumber = 4 AND l_returnflag = 'N' THEN NULL
              ELSE CAST(l_orderkey AS VARCHAR) END AS "InvoiceNo",
         CASE WHEN l_linenumber <> 3 THEN CAST(l_partkey AS VARCHAR) END AS "StockCode",
         CASE WHEN l_quantity <> 50 THEN l_quantity - 5 END AS "Quantity",
         CASE WHEN l_discount = 0 THEN 0.0::DOUBLE WHEN l_tax = 0 THEN NULL
              ELSE l_extendedprice END AS "UnitPrice",
         CASE WHEN o_orderstatus <> 'P' THEN CAST(o_orderdate AS TIMESTAMP) END AS "InvoiceDate"
  FROM lineitem JOIN orders ON l_orderkey = o_orderkey),
doubled AS (SELECT * FROM raw UNION ALL SELECT * FROM raw WHERE "InvoiceNo" LIKE '%7'),
lines AS (
  SELECT * REPLACE (regexp_replace(trim("CustomerID"), '^(-?[0-9]+)[.]0+$', '\\1')
                    AS "CustomerID") FROM doubled)"""

VALID = """
valid AS (
  SELECT *, "Quantity" * "UnitPrice" AS "TotalPrice" FROM lines
  WHERE "CustomerID" IS NOT NULL AND "Quantity" > 0 AND "UnitPrice" > 0
    AND NOT coalesce(lower("InvoiceNo") SIMILAR TO '(c|void).*', false)),
uniq AS (SELECT DISTINCT * FROM valid),
bounds AS (
  SELECT quantile_cont("TotalPrice", 0.01) AS lo, quantile_cont("TotalPrice", 0.99) AS hi
  FROM uniq),
clean AS (SELECT uniq.* FROM uniq, bounds WHERE "TotalPrice" BETWEEN lo AND hi)"""

FEATURES = """
invoices AS (
  SELECT "CustomerID", "InvoiceNo", sum("TotalPrice") AS "TotalPrice",
         min("InvoiceDate") AS "InvoiceDate", sum("Quantity") AS "Quantity"
  FROM clean WHERE "InvoiceNo" IS NOT NULL GROUP BY 1, 2),
reference AS (SELECT max("InvoiceDate") + INTERVAL 1 DAY AS reference_date FROM invoices),
rfm AS (
  SELECT "CustomerID",
         CAST(date_sub('day', max("InvoiceDate"), any_value(reference_date)) AS DOUBLE)
           AS "Recency",
         CAST(count("InvoiceDate") AS DOUBLE) AS "Frequency",
         CAST(date_sub('day', min("InvoiceDate"), any_value(reference_date)) AS DOUBLE)
           AS "Tenure",
         sum("TotalPrice") AS "Monetary", avg("TotalPrice") AS "Avg_Transaction_Value",
         max("TotalPrice") AS "Max_Transaction", stddev_samp("TotalPrice") AS "Std_Transaction",
         sum("Quantity") AS "Total_Items", avg("Quantity") AS "Avg_Items_Per_Transaction"
  FROM invoices, reference GROUP BY 1),
behavior AS (
  SELECT "CustomerID", CAST(count(DISTINCT "StockCode") AS DOUBLE) AS "Unique_Products",
         count(DISTINCT "StockCode") / count(*) AS "Transaction_Variety"
  FROM clean GROUP BY 1),
merged AS (SELECT * FROM rfm LEFT JOIN behavior USING ("CustomerID")),
tenured AS (
  SELECT * REPLACE (CASE WHEN "Tenure" = 0 THEN 1.0::DOUBLE ELSE "Tenure" END AS "Tenure")
  FROM merged),
rated AS (
  SELECT *, "Frequency" / nullif("Tenure", 0) AS "Frequency_Rate",
         "Monetary" / nullif("Tenure", 0) AS "Monetary_Rate",
         "Total_Items" / nullif("Frequency", 0) AS "Items_Per_Transaction"
  FROM tenured),
features AS (
  SELECT "CustomerID", coalesce(COLUMNS(* EXCLUDE ("CustomerID")), 0) FROM rated)"""


def unpivoted(names: list[str], source: str = "features") -> str:
    listed = ", ".join(f'"{n}"' for n in names)
    return f'long AS (UNPIVOT (FROM {source}) ON {listed} INTO NAME feature VALUE x)'


LONG = unpivoted(ANALYSIS_FEATURES)

SCALED = "scaled AS (SELECT \"CustomerID\", " + ", ".join(
    f'("{c}" - "{c}_m") / (CASE WHEN "{c}_s" = 0 THEN 1 ELSE "{c}_s" END) AS "{c}"'
    for c in CLUSTER_FEATURES
) + " FROM features, (SELECT " + ", ".join(
    f'quantile_cont("{c}", 0.5) AS "{c}_m", '
    f'quantile_cont("{c}", 0.75) - quantile_cont("{c}", 0.25) AS "{c}_s"'
    for c in CLUSTER_FEATURES
) + " FROM features) AS fitted)"

GIVEN = """
given AS (
  SELECT CAST(c_custkey AS VARCHAR) AS "CustomerID",
         CAST(CASE WHEN c_acctbal < 0 THEN -1 ELSE list_position([%s], c_mktsegment) END AS INTEGER)
           AS cluster
  FROM customer)""" % ", ".join(f"'{m}'" for m in MARKETS)

LABELED = "labeled AS (SELECT * FROM features JOIN given USING (\"CustomerID\"))"
KNOWN = LABELED + ", known AS (SELECT * FROM labeled WHERE cluster <> -1)"


def with_(*parts: str) -> str:
    return "WITH " + ",\n".join(p.strip() for p in parts)


TO_FEATURES = (LINES, VALID, FEATURES)
TO_LABELED = (*TO_FEATURES, GIVEN, KNOWN)

# Labeled rows in long form: (labeling, cluster, id, v) and one cell per dimension.
VECTOR_LABELS = {"label": "label", "noisy": "label - 1"}
LEVEL_LABELS = {
    "k1": "0", **{c: f"least(level, {int(c[1:]) - 1})" for c in K_LABELS},
    "KMeans": "level", "Agglomerative": "least(level, 3)", "DBSCAN": "level - 1",
}


def labeled_rows(names: list[str], labels: dict[str, str], id_col: str, source: str) -> str:
    union = " UNION ALL ".join(
        f"SELECT '{n}' AS labeling, CAST({labels[n]} AS INTEGER) AS cluster, {id_col}, v "
        f"FROM {source} WHERE {labels[n]} <> -1"
        for n in names
    )
    return f"""
members AS ({union}),
cells AS (
  SELECT labeling, cluster, {id_col}, unnest(v) AS x, generate_subscripts(v, 1) AS d
  FROM members),
centers AS (
  SELECT labeling, cluster, d, avg(x) AS m, count(*) AS n FROM cells GROUP BY ALL),
apart AS (
  SELECT labeling, cluster, {id_col}, sum((x - m) * (x - m)) AS square
  FROM cells JOIN centers USING (labeling, cluster, d) GROUP BY ALL)"""


def vector_rows(names: list[str]) -> str:
    source = "(SELECT vec_id, label, CAST(embedding AS DOUBLE[]) AS v FROM embeddings)"
    return labeled_rows(names, VECTOR_LABELS, "vec_id", source)


LEVELED = "leveled AS (SELECT scaled.\"CustomerID\", CAST(floor(features.\"Frequency\" / 3) AS " \
    "INTEGER) AS level, [" + ", ".join(f'scaled."{c}"' for c in CLUSTER_FEATURES) + "] AS v " \
    "FROM scaled JOIN features USING (\"CustomerID\"))"


def level_rows(names: list[str]) -> str:
    return LEVELED + ",\n" + labeled_rows(names, LEVEL_LABELS, '"CustomerID"', "leveled").strip()


CLUSTER_QUALITY = """
inner_sums AS (SELECT labeling, sum(square) AS wcss FROM apart GROUP BY 1),
shape AS (
  SELECT labeling, count(DISTINCT cluster) AS k, count(*) AS n FROM apart GROUP BY 1),
grand AS (SELECT labeling, d, avg(x) AS g FROM cells GROUP BY 1, 2),
outer_sums AS (
  SELECT labeling, sum(n * (m - g) * (m - g)) AS between_sum
  FROM centers JOIN grand USING (labeling, d) GROUP BY 1),
ch AS (
  SELECT labeling, (between_sum / (k - 1)) / (wcss / (n - k)) AS calinski_harabasz
  FROM outer_sums JOIN inner_sums USING (labeling) JOIN shape USING (labeling) WHERE k > 1),
scatter AS (SELECT labeling, cluster, avg(sqrt(square)) AS s FROM apart GROUP BY 1, 2),
center_gaps AS (
  SELECT a.labeling, a.cluster AS a, b.cluster AS b, sqrt(sum((a.m - b.m) * (a.m - b.m))) AS gap
  FROM centers AS a JOIN centers AS b ON a.labeling = b.labeling AND a.d = b.d
   AND a.cluster <> b.cluster GROUP BY 1, 2, 3),
db AS (
  SELECT labeling, avg(worst) AS davies_bouldin FROM (
    SELECT g.labeling, g.a, max((x.s + y.s) / g.gap) AS worst
    FROM center_gaps AS g JOIN scatter AS x ON g.labeling = x.labeling AND g.a = x.cluster
    JOIN scatter AS y ON g.labeling = y.labeling AND g.b = y.cluster GROUP BY 1, 2)
  GROUP BY 1)"""


def silhouettes(id_col: str, gap: str, source: str = "members") -> str:
    """Rows (labeling, cluster, id, silhouette) of ``source``, by brute force."""
    return f"""
pair_means AS (
  SELECT a.labeling, a."{id_col}", a.cluster, b.cluster AS other, sum({gap}) AS total,
         count(*) AS n
  FROM {source} AS a JOIN {source} AS b ON a.labeling = b.labeling GROUP BY 1, 2, 3, 4),
own_other AS (
  SELECT labeling, "{id_col}", cluster,
         max(CASE WHEN other = cluster THEN n END) AS own_n,
         max(CASE WHEN other = cluster THEN total END) AS own_total,
         min(CASE WHEN other <> cluster THEN total / n END) AS b
  FROM pair_means GROUP BY 1, 2, 3),
silhouettes AS (
  SELECT labeling, cluster, "{id_col}",
         CASE WHEN own_n = 1 THEN 0.0::DOUBLE
              ELSE coalesce((b - own_total / (own_n - 1))
                   / nullif(greatest(b, own_total / (own_n - 1)), 0), 0) END AS silhouette
  FROM own_other)"""


def point_gap(names: list[str]) -> str:
    squares = " + ".join(f'(a."{c}" - b."{c}") * (a."{c}" - b."{c}")' for c in names)
    return f"sqrt({squares})"
