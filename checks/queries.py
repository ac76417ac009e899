"""Every operator as a query on the supplied tables, with its SQL where SQL can say it."""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass, field

import numpy as np
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from checks import inputs as i
from checks.rounding import rounded, rounded_sql
from clientele.constants import (
    ANALYSIS_FEATURES,
    CLUSTER_FEATURES,
    CUSTOMER_FEATURES,
    HISTOGRAM_BINS,
    IMPACT_FEATURES,
    MEANS_FEATURES,
    PROFILE_FEATURES,
    SEED,
    SEGMENTS,
    SKEWED_FEATURES,
)
from clientele.functions import agglomerate, columns as cols
from clientele.operators import (
    anomaly,
    cleaning,
    clustering,
    density,
    explore,
    features as feat,
    kmeans,
    metrics,
    mixture,
    profiles,
    scaling,
    segments,
    selection,
    validation,
)
from clientele.plans import analysis
from clientele.sources import files, sinks
from clientele.sources.tables import order_lines, purchase_events, table
from clientele.storage import materialize, new_path

Run = Callable[[SparkSession, str], DataFrame]


@dataclass
class Check:
    run: Run
    sql: str | None = None
    doubles: list[str] = field(default_factory=list)
    digits: dict[str, int] | int | None = None


CHECKS: dict[str, Check] = {}


def check(name: str, sql: str | None = None, doubles=(), digits=None):
    def add(run: Run) -> Run:
        CHECKS[name] = Check(run, sql, list(doubles), digits)
        return run

    return add


def run_check(name: str) -> Run:
    one = CHECKS[name]
    if one.sql is None:
        return one.run
    return lambda spark, folder: rounded(one.run(spark, folder), one.digits)


def check_sql(name: str) -> str | None:
    one = CHECKS[name]
    return None if one.sql is None else rounded_sql(one.sql, one.doubles, one.digits)


LINE_DOUBLES = ["Quantity", "UnitPrice"]
TOTAL_DOUBLES = [*LINE_DOUBLES, "TotalPrice"]
RFM_DOUBLES = [
    "Recency", "Frequency", "Tenure", "Monetary", "Avg_Transaction_Value", "Max_Transaction",
    "Std_Transaction", "Total_Items", "Avg_Items_Per_Transaction",
]
W = i.with_

# ---- Sources and sinks ----------------------------------------------------------------------

MESSY = {
    "CustomerID": " Customer ID ", "InvoiceNo": "Invoice_No.", "StockCode": "StockCode!",
    "Quantity": "Qty", "UnitPrice": "Unit  Price", "InvoiceDate": "InvoiceDate",
}


def messy(df: DataFrame) -> DataFrame:
    return df.select(*[F.col(c).alias(m) for c, m in MESSY.items()])


@check("scan_csv", W(i.LINES) + " SELECT * FROM lines", LINE_DOUBLES)
def _(spark, folder):
    path = new_path(spark, "lines") + ".csv"
    sinks.write_segments(messy(order_lines(spark, folder)), path, "csv")
    return files.read_lines(spark, path).select(*MESSY)


@check("scan_parquet", W(i.LINES) + " SELECT * FROM lines", LINE_DOUBLES)
def _(spark, folder):
    return order_lines(spark, folder)


@check(
    "sink_segments",
    W(*i.TO_LABELED) + ' SELECT "CustomerID", cluster FROM labeled',
)
def _(spark, folder):
    path = new_path(spark, "assignment")
    labeled = i.labeled_customers(spark, folder)
    sinks.write_segments(labeled.select("CustomerID", "cluster"), path)
    return files.scan_parquet(spark, path)


# ---- Names, types and row filters -----------------------------------------------------------

@check(
    "clean_column_names",
    W(i.LINES) + ' SELECT "CustomerID" AS customer_id, "InvoiceNo" AS invoice_no, '
    '"StockCode" AS stockcode, "Quantity" AS qty, "UnitPrice" AS unit_price, '
    '"InvoiceDate" AS invoicedate FROM lines',
    ["qty", "unit_price"],
)
def _(spark, folder):
    return cols.clean_column_names(messy(order_lines(spark, folder)))


@check(
    "identify_key_columns",
    W(i.LINES) + ' SELECT "CustomerID" AS customer_id, "InvoiceNo" AS invoice_no, '
    '"InvoiceDate" AS invoice_date, "Quantity" AS quantity, "UnitPrice" AS price, '
    '"StockCode" AS stock_code FROM lines',
    ["quantity", "price"],
)
def _(spark, folder):
    df = cols.clean_column_names(messy(order_lines(spark, folder)))
    roles = cols.identify_key_columns(df.columns)
    return df.select(*[F.col(c).alias(role) for role, c in roles.items()])


@check("standardize_columns", W(i.LINES) + " SELECT * FROM lines", LINE_DOUBLES)
def _(spark, folder):
    df = cols.clean_column_names(messy(order_lines(spark, folder)))
    return cols.standardize_columns(df, cols.identify_key_columns(df.columns))


@check(
    "convert_date",
    'SELECT CAST(o_orderkey AS VARCHAR) AS "InvoiceNo", CASE WHEN o_orderpriority <> \'5-LOW\' '
    'THEN CAST(o_orderdate AS TIMESTAMP) END AS "InvoiceDate" FROM orders',
)
def _(spark, folder):
    date, priority = F.col("o_orderdate"), F.col("o_orderpriority")
    texts = table(spark, folder, "orders").select(
        F.col("o_orderkey").cast("string").alias("InvoiceNo"),
        F.when(priority == "5-LOW", F.lit("some day"))
        .when(priority == "1-URGENT", F.date_format(date, "M/d/yyyy H:mm"))
        .otherwise(F.date_format(date, "yyyy-MM-dd HH:mm:ss")).alias("InvoiceDate"),
    )
    return cleaning.convert_date(texts)


DIRTY = W(i.DIRTY)


def dirty(spark, folder) -> DataFrame:
    return cleaning.typed_lines(i.dirty_lines(spark, folder))


@check(
    "drop_missing_customer",
    DIRTY + ' SELECT * FROM lines WHERE "CustomerID" IS NOT NULL', LINE_DOUBLES,
)
def _(spark, folder):
    return cleaning.drop_missing_customer(dirty(spark, folder))


@check(
    "normalize_customer_id",
    DIRTY + ' SELECT "CustomerID", count(*) AS n FROM lines GROUP BY 1',
)
def _(spark, folder):
    ids = cleaning.normalize_customer_id(i.dirty_lines(spark, folder))
    return ids.groupBy("CustomerID").agg(F.count("*").alias("n"))


@check(
    "filter_cancelled",
    DIRTY + " SELECT * FROM lines WHERE NOT coalesce("
    "lower(\"InvoiceNo\") SIMILAR TO '(c|void).*', false)", LINE_DOUBLES,
)
def _(spark, folder):
    return cleaning.filter_cancelled(dirty(spark, folder))


@check(
    "filter_positive_qty", DIRTY + ' SELECT * FROM lines WHERE "Quantity" > 0', LINE_DOUBLES
)
def _(spark, folder):
    return cleaning.filter_positive_qty(dirty(spark, folder))


@check(
    "filter_positive_price", DIRTY + ' SELECT * FROM lines WHERE "UnitPrice" > 0', LINE_DOUBLES
)
def _(spark, folder):
    return cleaning.filter_positive_price(dirty(spark, folder))


@check(
    "total_price", DIRTY + ' SELECT *, "Quantity" * "UnitPrice" AS "TotalPrice" FROM lines',
    TOTAL_DOUBLES,
)
def _(spark, folder):
    return cleaning.total_price(dirty(spark, folder))


@check("drop_duplicates", W(i.DIRTY, i.VALID) + " SELECT * FROM uniq", TOTAL_DOUBLES)
def _(spark, folder):
    return cleaning.drop_duplicates(cleaning.valid_lines(dirty(spark, folder)))


@check("trim_quantiles", W(i.DIRTY, i.VALID) + " SELECT * FROM clean", TOTAL_DOUBLES)
def _(spark, folder):
    return cleaning.trim_quantiles(cleaning.distinct_lines(dirty(spark, folder)))


@check("clean_lines", W(i.LINES, i.VALID) + " SELECT * FROM clean", TOTAL_DOUBLES)
def _(spark, folder):
    return cleaning.clean_lines(order_lines(spark, folder))


@check(
    "rate_features",
    W(i.DIRTY, i.VALID, i.FEATURES) + " SELECT * FROM rated",
    [*RFM_DOUBLES, "Unique_Products", "Transaction_Variety", "Frequency_Rate", "Monetary_Rate",
     "Items_Per_Transaction"],
)
def _(spark, folder):
    lines = i.clean_dirty(spark, folder)
    rfm = feat.rfm_agg(feat.invoice_agg(lines))
    return feat.rate_features(feat.merge_features(rfm, feat.behavioral_agg(lines)))


LOGS = ", ".join(f'ln(1 + "{c}") AS "Log_{c}"' for c in SKEWED_FEATURES)


@check(
    "log_features",
    W(*i.TO_FEATURES) + f" SELECT *, {LOGS} FROM features",
    [*CUSTOMER_FEATURES, *[f"Log_{c}" for c in SKEWED_FEATURES]],
)
def _(spark, folder):
    return feat.log_features(i.features(spark, folder), "always")


@check(
    "fill_missing",
    W(i.DIRTY, i.VALID, i.FEATURES)
    + ' SELECT "CustomerID", coalesce(COLUMNS(* EXCLUDE ("CustomerID")), 0) FROM rfm',
    RFM_DOUBLES,
)
def _(spark, folder):
    return feat.fill_missing(feat.rfm_agg(feat.invoice_agg(i.clean_dirty(spark, folder))))


@check(
    "select_features",
    W(*i.TO_FEATURES) + ' SELECT "CustomerID", '
    + ", ".join(f'"{c}"' for c in CLUSTER_FEATURES) + " FROM features",
    CLUSTER_FEATURES,
)
def _(spark, folder):
    return feat.select_features(i.features(spark, folder))


@check(
    "filter_noise",
    W(*i.TO_LABELED) + ' SELECT "CustomerID", cluster FROM known',
)
def _(spark, folder):
    return validation.filter_noise(i.labeled_customers(spark, folder)).select(
        "CustomerID", "cluster"
    )


# ---- Aggregations, distinct, join -----------------------------------------------------------

@check(
    "raw_stats",
    DIRTY + ' SELECT count(*) AS raw_rows, CAST(6 AS BIGINT) AS raw_columns, '
    'count(DISTINCT "CustomerID") AS raw_customers FROM lines',
)
def _(spark, folder):
    return cleaning.raw_stats(dirty(spark, folder))


@check(
    "clean_stats",
    W(i.DIRTY, i.VALID) + """
SELECT clean_rows, clean_customers, raw_rows - clean_rows AS rows_removed,
       raw_customers - clean_customers AS customers_removed,
       clean_customers * 100 / raw_customers AS customer_retention_rate,
       clean_rows * 100 / raw_rows AS transaction_retention_rate
FROM (SELECT count(*) AS clean_rows, count(DISTINCT "CustomerID") AS clean_customers FROM clean),
     (SELECT count(*) AS raw_rows, count(DISTINCT "CustomerID") AS raw_customers FROM lines)""",
    ["customer_retention_rate", "transaction_retention_rate"],
)
def _(spark, folder):
    lines = dirty(spark, folder)
    return cleaning.clean_stats(lines, cleaning.clean_lines(lines))


@check(
    "cleaning_audit",
    W(i.DIRTY, i.VALID) + """,
flagged AS (
  SELECT "CustomerID" IS NULL AS missing,
         coalesce(lower("InvoiceNo") SIMILAR TO '(c|void).*', false) AS cancelled,
         coalesce("Quantity" > 0, false) AS quantity, coalesce("UnitPrice" > 0, false) AS price
  FROM lines),
counts AS (
  SELECT count(*) FILTER (missing) AS a, count(*) FILTER (NOT missing AND cancelled) AS b,
         count(*) FILTER (NOT missing AND NOT cancelled AND NOT quantity) AS c,
         count(*) FILTER (NOT missing AND NOT cancelled AND quantity AND NOT price) AS d,
         (SELECT count(*) FROM valid) - (SELECT count(*) FROM uniq) AS e,
         (SELECT count(*) FROM uniq) - (SELECT count(*) FROM clean) AS f
  FROM flagged)
SELECT 1 AS step_no, 'missing_customer' AS step, a AS rows_removed FROM counts
UNION ALL SELECT 2, 'cancelled', b FROM counts
UNION ALL SELECT 3, 'non_positive_quantity', c FROM counts
UNION ALL SELECT 4, 'non_positive_price', d FROM counts
UNION ALL SELECT 5, 'duplicates', e FROM counts
UNION ALL SELECT 6, 'extreme_totals', f FROM counts""",
)
def _(spark, folder):
    return cleaning.cleaning_audit(dirty(spark, folder))


@check(
    "invoice_agg", W(i.DIRTY, i.VALID, i.FEATURES) + " SELECT * FROM invoices",
    ["TotalPrice", "Quantity"],
)
def _(spark, folder):
    return feat.invoice_agg(i.clean_dirty(spark, folder))


@check("reference_date", W(*i.TO_FEATURES) + " SELECT reference_date FROM reference")
def _(spark, folder):
    lines = cleaning.clean_lines(order_lines(spark, folder))
    return feat.reference_date(feat.invoice_agg(lines))


@check("rfm_agg", W(*i.TO_FEATURES) + " SELECT * FROM rfm", RFM_DOUBLES)
def _(spark, folder):
    return feat.rfm_agg(feat.invoice_agg(cleaning.clean_lines(order_lines(spark, folder))))


@check(
    "rfm_agg_events", W(i.EVENT_LINES, i.VALID, i.FEATURES) + " SELECT * FROM rfm", RFM_DOUBLES
)
def _(spark, folder):
    return feat.rfm_agg(feat.invoice_agg(cleaning.clean_lines(purchase_events(spark, folder))))


@check(
    "behavioral_agg", W(i.DIRTY, i.VALID, i.FEATURES) + " SELECT * FROM behavior",
    ["Unique_Products", "Transaction_Variety"],
)
def _(spark, folder):
    return feat.behavioral_agg(i.clean_dirty(spark, folder))


@check(
    "merge_features", W(*i.TO_FEATURES) + " SELECT * FROM merged",
    [*RFM_DOUBLES, "Unique_Products", "Transaction_Variety"],
)
def _(spark, folder):
    lines = cleaning.clean_lines(order_lines(spark, folder))
    return feat.merge_features(
        feat.rfm_agg(feat.invoice_agg(lines)), feat.behavioral_agg(lines)
    )


@check("engineer_features", W(*i.TO_FEATURES) + " SELECT * FROM features", CUSTOMER_FEATURES)
def _(spark, folder):
    return i.features(spark, folder)


@check(
    "engineer_features_dirty", W(i.DIRTY, i.VALID, i.FEATURES) + " SELECT * FROM features",
    CUSTOMER_FEATURES,
)
def _(spark, folder):
    return feat.engineer_features(i.clean_dirty(spark, folder), "never")


@check(
    "engineer_features_events", W(i.EVENT_LINES, i.VALID, i.FEATURES) + " SELECT * FROM features",
    CUSTOMER_FEATURES,
)
def _(spark, folder):
    return feat.engineer_features(
        cleaning.clean_lines(purchase_events(spark, folder)), "never"
    )


# ---- Exploratory statistics -----------------------------------------------------------------

LONG = W(*i.TO_FEATURES, i.LONG)


@check(
    "summary_statistics",
    LONG + """
SELECT feature, count(x) AS count, avg(x) AS mean, stddev_samp(x) AS std, min(x) AS min,
       quantile_cont(x, 0.25) AS q25, median(x) AS median, quantile_cont(x, 0.75) AS q75,
       max(x) AS max, skewness(x) AS skewness, kurtosis(x) AS kurtosis
FROM long GROUP BY 1""",
    ["mean", "std", "min", "q25", "median", "q75", "max", "skewness", "kurtosis"], 4,
)
def _(spark, folder):
    return explore.summary_statistics(i.stored_features(spark, folder))


@check(
    "feature_histogram",
    LONG + f""",
shape AS (
  SELECT feature, min(x) AS lo, max(x) AS hi, avg(x) AS mean, median(x) AS median,
         skewness(x) AS skewness FROM long GROUP BY 1),
counts AS (
  SELECT feature, CAST(least(floor((x - lo) / (hi - lo) * {HISTOGRAM_BINS}), {HISTOGRAM_BINS - 1})
         AS INTEGER) AS bin, count(*) AS n FROM long JOIN shape USING (feature) GROUP BY 1, 2)
SELECT feature, bin, lo + bin * (hi - lo) / {HISTOGRAM_BINS} AS bin_start,
       lo + (bin + 1) * (hi - lo) / {HISTOGRAM_BINS} AS bin_end, coalesce(n, 0) AS n, mean, median,
       skewness
FROM shape CROSS JOIN (SELECT CAST(range AS INTEGER) AS bin FROM range({HISTOGRAM_BINS}))
LEFT JOIN counts USING (feature, bin)""",
    ["bin_start", "bin_end", "mean", "median", "skewness"], 4,
)
def _(spark, folder):
    return explore.feature_histogram(i.stored_features(spark, folder))


@check(
    "feature_kde",
    LONG + """,
shape AS (
  SELECT feature, min(x) AS lo, max(x) AS hi, count(*) AS n,
         stddev_samp(x) * pow(count(*), -0.2) AS w FROM long GROUP BY 1),
grid AS (
  SELECT *, lo + point * (hi - lo) / 199 AS g
  FROM shape, (SELECT CAST(range AS INTEGER) AS point FROM range(200)))
SELECT feature, point, any_value(g) AS x,
       sum(exp(-0.5 * ((g - l.x) / w) * ((g - l.x) / w))) / any_value(n * w * sqrt(2 * pi()))
         AS density
FROM grid JOIN long AS l USING (feature) GROUP BY 1, 2""",
    ["x", "density"], {"x": 4, "density": 11},
)
def _(spark, folder):
    return explore.feature_kde(i.stored_features(spark, folder))


@check(
    "correlation_matrix",
    LONG + """
SELECT a.feature, b.feature AS other, corr(a.x, b.x) AS correlation
FROM long AS a JOIN long AS b USING ("CustomerID") GROUP BY 1, 2""",
    ["correlation"],
)
def _(spark, folder):
    return explore.correlation_matrix(i.stored_features(spark, folder))


@check(
    "iqr_outliers",
    LONG + """,
box AS (
  SELECT feature, quantile_cont(x, 0.25) AS q1, median(x) AS median, quantile_cont(x, 0.75) AS q3
  FROM long GROUP BY 1),
fences AS (
  SELECT *, q3 - q1 AS iqr, q1 - 1.5 * (q3 - q1) AS low_fence, q3 + 1.5 * (q3 - q1) AS high_fence
  FROM box)
SELECT feature, q1, median, q3, iqr, low_fence, high_fence,
       count(*) FILTER (x < low_fence OR x > high_fence) AS outliers
FROM fences JOIN long USING (feature) GROUP BY ALL""",
    ["q1", "median", "q3", "iqr", "low_fence", "high_fence"], 4,
)
def _(spark, folder):
    return explore.iqr_outliers(i.stored_features(spark, folder))


TICKET = f"md5('{SEED}:' || \"CustomerID\")"


@check(
    "rfm_pair_sample",
    W(*i.TO_FEATURES) + ' SELECT "CustomerID", "Recency", "Frequency", "Monetary" FROM features '
    f"ORDER BY {TICKET} LIMIT 5000",
    ["Recency", "Frequency", "Monetary"],
)
def _(spark, folder):
    return explore.rfm_pair_sample(i.features(spark, folder))


STAGES = ", ".join(
    f"{make}(x{only}) AS {name}_{stage}"
    for stage, only in (("before", ""), ("after", ") FILTER (NOT is_outlier"))
    for name, make in (
        ("rows", "count"), ("mean", "avg"), ("std", "stddev_samp"), ("min", "min"), ("max", "max")
    )
)


@check(
    "outlier_removal_impact",
    W(
        *i.TO_FEATURES,
        "marked AS (SELECT *, \"Monetary\" > (SELECT quantile_cont(\"Monetary\", 0.95) "
        "FROM features) AS is_outlier FROM features)",
        i.unpivoted(IMPACT_FEATURES, "marked"),
    ) + f" SELECT feature, {STAGES} FROM long GROUP BY 1",
    [f"{n}_{s}" for s in ("before", "after") for n in ("mean", "std", "min", "max")], 4,
)
def _(spark, folder):
    df = i.stored_features(spark, folder)
    cut = explore.exact_quantiles(df, ["Monetary"], [0.95])["Monetary"][0]
    return explore.outlier_removal_impact(df.withColumn("is_outlier", F.col("Monetary") > cut))


# ---- Preprocessing --------------------------------------------------------------------------

@check("isolation_forest")
def _(spark, folder):
    scored = anomaly.isolation_forest(i.stored_features(spark, folder))
    return scored.select("CustomerID", "anomaly_score", "is_outlier")


@check("robust_scale", W(*i.TO_FEATURES, i.SCALED) + " SELECT * FROM scaled", CLUSTER_FEATURES, 6)
def _(spark, folder):
    return scaling.robust_scale(i.stored_features(spark, folder), CLUSTER_FEATURES)


# ---- Metrics and the choice of k ------------------------------------------------------------

EMBEDDED = ["label", "noisy"]
QUALITY = W(*i.TO_FEATURES, i.SCALED, i.level_rows(i.K_LABELS), i.CLUSTER_QUALITY)


@check(
    "wcss", W(i.vector_rows(EMBEDDED), i.CLUSTER_QUALITY) + " SELECT * FROM inner_sums", ["wcss"]
)
def _(spark, folder):
    return metrics.wcss(i.vectors(spark, folder), i.VECTOR, EMBEDDED)


@check(
    "calinski_harabasz", QUALITY + " SELECT labeling, calinski_harabasz FROM ch",
    ["calinski_harabasz"],
)
def _(spark, folder):
    return metrics.calinski_harabasz(
        i.leveled_points(spark, folder), CLUSTER_FEATURES, i.K_LABELS
    )


@check(
    "davies_bouldin", QUALITY + " SELECT labeling, davies_bouldin FROM db", ["davies_bouldin"]
)
def _(spark, folder):
    return metrics.davies_bouldin(i.leveled_points(spark, folder), CLUSTER_FEATURES, i.K_LABELS)


VECTOR_GAP = "list_distance(a.v, b.v)"


@check(
    "silhouette_score",
    W(i.vector_rows(EMBEDDED), i.silhouettes("vec_id", VECTOR_GAP))
    + " SELECT labeling, avg(silhouette) AS silhouette FROM silhouettes GROUP BY 1",
    ["silhouette"],
)
def _(spark, folder):
    samples = metrics.silhouette_samples(
        i.vectors(spark, folder), i.VECTOR, EMBEDDED, "vec_id", "euclidean"
    )
    return metrics.silhouette_score(samples)


@check(
    "silhouette_samples",
    W(
        *i.TO_FEATURES, i.SCALED, i.GIVEN,
        "members AS (SELECT 'cluster' AS labeling, * FROM scaled JOIN given "
        'USING ("CustomerID") WHERE cluster <> -1)',
        i.silhouettes("CustomerID", i.point_gap(CLUSTER_FEATURES)),
    ) + ' SELECT "CustomerID", labeling, cluster, silhouette, \'euclidean\' AS distance '
    "FROM silhouettes",
    ["silhouette"],
)
def _(spark, folder):
    return metrics.silhouette_samples(
        i.labeled_points(spark, folder), CLUSTER_FEATURES, ["cluster"], distance="euclidean"
    )


@check(
    "silhouette_samples_squared",
    W(
        i.vector_rows(EMBEDDED),
        i.silhouettes("vec_id", f"{VECTOR_GAP} * {VECTOR_GAP}"),
    ) + " SELECT vec_id, labeling, cluster, silhouette, 'squared' AS distance FROM silhouettes",
    ["silhouette"],
)
def _(spark, folder):
    return metrics.silhouette_samples(
        i.vectors(spark, folder), i.VECTOR, EMBEDDED, "vec_id", "squared"
    )


@check("kmeans_sweep")
def _(spark, folder):
    return selection.kmeans_sweep(i.scaled(spark, folder), CLUSTER_FEATURES)


@check("gap_statistic")
def _(spark, folder):
    return selection.gap_statistic(i.scaled(spark, folder), CLUSTER_FEATURES)


def given_k_metrics(spark, folder) -> DataFrame:
    """The metrics of nested labels; the gap is taken against a single cluster."""
    points = i.leveled_points(spark, folder)
    measured = metrics.all_metrics(points, CLUSTER_FEATURES, i.K_LABELS)
    single = metrics.wcss(points, CLUSTER_FEATURES, ["k1"]).select(F.col("wcss")).scalar()
    return materialize(measured.select(
        F.substring("labeling", 2, 1).cast("int").alias("k"), "silhouette", "calinski_harabasz",
        "davies_bouldin", "wcss", F.log(single / F.col("wcss")).alias("gap_statistic"),
    ), "k")


K_METRICS = W(
    *i.TO_FEATURES, i.SCALED, i.level_rows(["k1", *i.K_LABELS]), i.CLUSTER_QUALITY,
    i.silhouettes("CustomerID", VECTOR_GAP),
) + """,
sil AS (SELECT labeling, avg(silhouette) AS silhouette FROM silhouettes GROUP BY 1),
k_metrics AS (
  SELECT CAST(substr(labeling, 2) AS INTEGER) AS k, silhouette, calinski_harabasz,
         davies_bouldin, wcss,
         ln((SELECT wcss FROM inner_sums WHERE labeling = 'k1') / wcss) AS gap_statistic
  FROM inner_sums JOIN sil USING (labeling) JOIN ch USING (labeling) JOIN db USING (labeling)),
scored AS (
  SELECT *,
    0.3 * (silhouette - min(silhouette) OVER ())
        / (max(silhouette) OVER () - min(silhouette) OVER () + 1e-10)
    + 0.2 * (calinski_harabasz - min(calinski_harabasz) OVER ())
        / (max(calinski_harabasz) OVER () - min(calinski_harabasz) OVER () + 1e-10)
    + 0.2 * (1 - (davies_bouldin - min(davies_bouldin) OVER ())
        / (max(davies_bouldin) OVER () - min(davies_bouldin) OVER () + 1e-10))
    + 0.3 * (gap_statistic - min(gap_statistic) OVER ())
        / (max(gap_statistic) OVER () - min(gap_statistic) OVER () + 1e-10) AS score
  FROM k_metrics)"""


@check("k_scores", K_METRICS + " SELECT * FROM scored",
       [*selection.METRICS, "gap_statistic", "score"])
def _(spark, folder):
    return selection.k_scores(given_k_metrics(spark, folder))


@check(
    "consensus_k", K_METRICS + " SELECT k, score FROM scored ORDER BY score DESC, k LIMIT 1",
    ["score"],
)
def _(spark, folder):
    return selection.consensus_k(given_k_metrics(spark, folder))


@check(
    "optimal_k_table",
    K_METRICS + """,
best AS (SELECT k FROM scored ORDER BY score DESC, k LIMIT 1)
(SELECT 'Silhouette' AS metric, k AS optimal_k, silhouette AS score
 FROM scored ORDER BY silhouette DESC, k LIMIT 1)
UNION ALL (SELECT 'Calinski-Harabasz', k, calinski_harabasz
 FROM scored ORDER BY calinski_harabasz DESC, k LIMIT 1)
UNION ALL (SELECT 'Davies-Bouldin', k, davies_bouldin FROM scored ORDER BY davies_bouldin, k LIMIT 1)
UNION ALL (SELECT 'Gap Statistic', k, gap_statistic
 FROM scored ORDER BY gap_statistic DESC, k LIMIT 1)
UNION ALL SELECT 'Consensus', k, NULL FROM best
UNION ALL SELECT 'Selected', CASE WHEN k BETWEEN 3 AND 7 THEN k ELSE 5 END, NULL FROM best""",
    ["score"],
)
def _(spark, folder):
    return selection.optimal_k_table(given_k_metrics(spark, folder))


# ---- Clustering -----------------------------------------------------------------------------

def _clustered(method):
    def run(spark, folder):
        points = analysis.robust_points(i.features(spark, folder), CLUSTER_FEATURES)
        return method(points, CLUSTER_FEATURES)

    return run


check("kmeans")(_clustered(lambda p, c: clustering.kmeans(p, c, 5)))
check("hierarchical")(_clustered(lambda p, c: clustering.hierarchical(p, c, 5)))
check("gaussian_mixture")(_clustered(lambda p, c: clustering.gaussian_mixture(p, c, 5)))

DBSCAN = W(*i.TO_FEATURES, i.SCALED).replace("WITH", "WITH RECURSIVE", 1) + f""",
pairs AS MATERIALIZED (
  SELECT a."CustomerID" AS a, b."CustomerID" AS b
  FROM scaled AS a JOIN scaled AS b ON {i.point_gap(CLUSTER_FEATURES)} <= 0.5),
core AS MATERIALIZED (SELECT a AS id FROM pairs GROUP BY 1 HAVING count(*) >= 5),
links AS MATERIALIZED (
  SELECT a, b FROM pairs JOIN core AS x ON a = x.id JOIN core AS y ON b = y.id),
reach(id, root) AS (
  SELECT id, id FROM core UNION SELECT b, root FROM reach JOIN links ON a = id),
components AS (SELECT id, min(root) AS component FROM reach GROUP BY 1),
labeled_points AS (
  SELECT id, component FROM components
  UNION ALL SELECT a, min(component) FROM pairs JOIN components ON b = id
  WHERE a NOT IN (SELECT id FROM core) GROUP BY 1),
numbers AS (
  SELECT component, row_number() OVER (ORDER BY count(*) DESC, min(id)) - 1 AS cluster
  FROM labeled_points GROUP BY 1)
SELECT "CustomerID", CAST(coalesce(cluster, -1) AS INTEGER) AS cluster
FROM scaled LEFT JOIN labeled_points ON "CustomerID" = id LEFT JOIN numbers USING (component)"""
check("dbscan", DBSCAN)(_clustered(density.dbscan))
check("consensus_clustering")(_clustered(lambda p, c: clustering.consensus_clustering(p, c, 5)))


@check(
    "dbscan_core_points",
    W(*i.TO_FEATURES, i.SCALED) + f"""
SELECT a."CustomerID", count(*) AS neighbors, count(*) >= 5 AS is_core
FROM scaled AS a JOIN scaled AS b ON {i.point_gap(CLUSTER_FEATURES)} <= 0.5 GROUP BY 1""",
)
def _(spark, folder):
    return density.neighbor_counts(i.scaled(spark, folder), CLUSTER_FEATURES)


def linked_sql(units: str, gap: str, state: str, k: int) -> str:
    """Agglomeration one merge at a time: ``units`` has (id, w, v), ``gap`` is between a and b.

    A cluster takes the greater name, ties go by the names; ``state`` joins v of x and y.
    """
    return f"""{units},
tree(step, id, w, v, members) AS (
  SELECT 0, id, w, v, [id] FROM units
  UNION ALL
  SELECT step + 1, max(id), sum(w), CASE WHEN count(*) = 1 THEN any_value(v) ELSE
      list_transform(list_zip(min_by(v, id), max_by(v, id)), lambda p: {state}) END,
    flatten(list(members))
  FROM (
    SELECT tree.*, CASE WHEN id = best.lo THEN best.hi ELSE id END AS target,
           best.w1 AS w1, best.w2 AS w2
    FROM tree, (
      SELECT min(struct_pack(gap := {gap}, hi := b.id, lo := a.id, w1 := a.w, w2 := b.w)) AS best
      FROM tree AS a JOIN tree AS b ON a.id < b.id) AS m
    WHERE (SELECT count(*) FROM tree) > {k})
  GROUP BY step, target, w1, w2),
linked AS (
  SELECT unnest(members) AS unit, id AS label FROM tree
  WHERE step = (SELECT max(step) FROM tree))"""


def recursive(*parts: str) -> str:
    return W(*parts).replace("WITH", "WITH RECURSIVE", 1)


NATIONS = recursive(*i.TO_FEATURES, i.SCALED) + """,
units AS MATERIALIZED (
  SELECT lpad(CAST(c_nationkey * 2 + c_custkey % 2 AS VARCHAR), 2, '0') AS id,
         CAST(count(*) AS DOUBLE) AS w, [""" + ", ".join(f'avg("{c}")' for c in CLUSTER_FEATURES) + """] AS v
  FROM scaled JOIN customer ON "CustomerID" = CAST(c_custkey AS VARCHAR) GROUP BY 1)"""


@check(
    "hierarchical_units",
    linked_sql(
        NATIONS,
        "list_sum(list_transform(list_zip(a.v, b.v), lambda p: (p[1] - p[2]) * (p[1] - p[2])))"
        " / (1 / a.w + 1 / b.w)",
        "(p[1] * w1 + p[2] * w2) / (w1 + w2)", 6,
    ) + " SELECT unit, label FROM linked",
)
def _(spark, folder):
    """Ward linkage of weighted units: customers of each nation, odd and even ones apart."""
    half = (F.col("c_nationkey") * 2 + F.col("c_custkey") % 2).cast("string")
    customers = table(spark, folder, "customer").select(
        F.col("c_custkey").cast("string").alias("CustomerID"), F.lpad(half, 2, "0").alias("unit")
    )
    units = i.scaled(spark, folder).join(customers, "CustomerID").groupBy("unit").agg(
        F.count("*").cast("double").alias("weight"), *[F.avg(c).alias(c) for c in CLUSTER_FEATURES]
    )
    # Blocks of a few units each: the tree is that of the whole table.
    return agglomerate.agglomerate_table(
        materialize(units, "nations"), CLUSTER_FEATURES, 6, agglomerate.Ward(), 30
    )


SIGNED = ["Frequency", "Unique_Products", "Recency", "Total_Items"]
SIGNATURES = recursive(*i.TO_FEATURES) + """,
signed AS MATERIALIZED (
  SELECT "CustomerID", [""" + ", ".join(f'CAST(floor("{c}") AS BIGINT) % 3' for c in SIGNED) + """] AS s
  FROM features),
units AS MATERIALIZED (
  SELECT array_to_string(s, '-') AS id, w,
    list_transform(flatten(list_transform(s, lambda x:
      [CAST(x = 0 AS BIGINT), CAST(x = 1 AS BIGINT), CAST(x = 2 AS BIGINT)])),
      lambda x: x * w) AS v
  FROM (SELECT s, count(*) AS w FROM signed GROUP BY s))"""


@check(
    "consensus_of_signatures",
    linked_sql(
        SIGNATURES,
        "CAST(4 * a.w * b.w - list_sum(list_transform(list_zip(a.v, b.v), lambda p: p[1] * p[2]))"
        " AS DOUBLE) / CAST(4 * a.w * b.w AS DOUBLE)",
        "p[1] + p[2]", 5,
    ) + """,
labels AS (SELECT "CustomerID", label FROM signed JOIN linked ON array_to_string(s, '-') = unit),
numbers AS (
  SELECT label, row_number() OVER (ORDER BY count(*) DESC, min("CustomerID")) AS cluster
  FROM labels GROUP BY 1)
SELECT "CustomerID", CAST(cluster AS INTEGER) AS cluster FROM labels JOIN numbers USING (label)""",
)
def _(spark, folder):
    """Average linkage on the share of runs that differ; equal gaps are the normal case."""
    signature = F.array(*[(F.floor(c).cast("bigint") % 3).cast("int") for c in SIGNED])
    signed = i.stored_features(spark, folder).select("CustomerID", signature.alias("signature"))
    return clustering.link_signatures(signed, 5, len(SIGNED), 3, block_units=20)


GIVEN_METHODS = ["KMeans", "Agglomerative", "DBSCAN"]
COMPARISON = W(
    *i.TO_FEATURES, i.SCALED, i.level_rows(GIVEN_METHODS), i.CLUSTER_QUALITY,
    i.silhouettes("CustomerID", VECTOR_GAP),
) + """,
sil AS (SELECT labeling, avg(silhouette) AS silhouette FROM silhouettes GROUP BY 1),
comparison AS (
  SELECT labeling AS algorithm, CAST(k AS INTEGER) AS n_clusters, silhouette, calinski_harabasz,
         davies_bouldin, (SELECT count(*) FROM features) - n AS n_noise,
         CAST(list_position(['KMeans', 'Agglomerative', 'GaussianMixture', 'DBSCAN'], labeling) - 1
           AS INTEGER) AS place
  FROM shape JOIN sil USING (labeling) JOIN ch USING (labeling) JOIN db USING (labeling))"""


def given_comparison(spark, folder) -> DataFrame:
    return analysis.algorithm_comparison(
        i.leveled_points(spark, folder), CLUSTER_FEATURES, GIVEN_METHODS
    )


@check("algorithm_comparison", COMPARISON + " SELECT * FROM comparison",
       ["silhouette", "calinski_harabasz", "davies_bouldin"])
def _(spark, folder):
    return given_comparison(spark, folder)


@check(
    "best_algorithm",
    COMPARISON + " SELECT algorithm, silhouette, n_clusters FROM comparison "
    "ORDER BY silhouette DESC, place LIMIT 1",
    ["silhouette"],
)
def _(spark, folder):
    return analysis.best_algorithm(given_comparison(spark, folder))


# ---- Validation -----------------------------------------------------------------------------

# With five clusters the first degree of freedom is 4, for which the tail has a closed form.
ANOVA = W(*i.TO_LABELED, i.unpivoted(ANALYSIS_FEATURES, "known")) + """,
grand AS (SELECT feature, avg(x) AS g, count(*) AS n, count(DISTINCT cluster) AS k
          FROM long GROUP BY 1),
groups AS (SELECT feature, cluster, avg(x) AS m, count(*) AS c FROM long GROUP BY 1, 2),
between_sums AS (
  SELECT feature, sum(c * (m - g) * (m - g)) AS b FROM groups JOIN grand USING (feature)
  GROUP BY 1),
total_sums AS (
  SELECT feature, sum((x - g) * (x - g)) AS t FROM long JOIN grand USING (feature) GROUP BY 1),
tested AS (
  SELECT feature, (b / (k - 1)) / ((t - b) / (n - k)) AS f_statistic, b / t AS eta_squared,
         (n - k) / ((n - k) + 4 * ((b / (k - 1)) / ((t - b) / (n - k)))) AS y, n - k AS d2
  FROM grand JOIN between_sums USING (feature) JOIN total_sums USING (feature)),
anova AS (
  SELECT feature, f_statistic, pow(y, d2 / 2) * (1 + d2 / 2 * (1 - y)) AS p_value, eta_squared,
         pow(y, d2 / 2) * (1 + d2 / 2 * (1 - y)) < 0.05 AS significant,
         CASE WHEN eta_squared >= 0.14 THEN 'Large' WHEN eta_squared >= 0.06 THEN 'Medium'
              WHEN eta_squared >= 0.01 THEN 'Small' ELSE 'Negligible' END AS effect_size
  FROM tested)"""


@check("anova", ANOVA + " SELECT * FROM anova", ["f_statistic", "p_value", "eta_squared"])
def _(spark, folder):
    return validation.anova(i.labeled_customers(spark, folder))


@check(
    "anova_summary",
    ANOVA + """
SELECT count(*) FILTER (significant) AS significant_features, count(*) AS features,
       avg(round(eta_squared, 3)) AS mean_eta_squared,
       CASE WHEN avg(round(eta_squared, 3)) >= 0.14 THEN 'Strong'
            WHEN avg(round(eta_squared, 3)) >= 0.06 THEN 'Moderate' ELSE 'Weak' END AS separation
FROM anova""",
    ["mean_eta_squared"],
)
def _(spark, folder):
    return validation.anova_summary(validation.anova(i.labeled_customers(spark, folder)))


# ---- Cluster description --------------------------------------------------------------------

N_FEATURES = len(CLUSTER_FEATURES)


def _largest_positive(v: str) -> str:
    """``v`` or its opposite, so that its largest component is positive."""
    sizes = f"list_transform({v}, lambda x: abs(x))"
    sign = f"sign(list_extract({v}, list_position({sizes}, list_max({sizes}))))"
    return f"list_transform({v}, lambda x: x * {sign})"


def _power(name: str, matrix: str, steps: int = 600) -> str:
    """The leading eigenvector (v) of a one-row table's matrix (m) and its eigenvalue (l)."""
    start = ", ".join(f"{1 + n / 10}" for n in range(N_FEATURES))
    return f"""
{name}_steps(i, v) AS (
  SELECT 0, [{start}]::DOUBLE[] UNION ALL
  SELECT i + 1, list_transform(w, lambda x: x / sqrt(list_dot_product(w, w)))
  FROM (SELECT i, list_transform(m, lambda r: list_dot_product(r, v)) AS w
        FROM {name}_steps, {matrix} WHERE i < {steps})),
{name} AS (
  SELECT v, list_dot_product(v, list_transform(m, lambda r: list_dot_product(r, v))) AS l
  FROM (SELECT {_largest_positive("v")} AS v FROM {name}_steps WHERE i = {steps}), {matrix})"""


PCA = W(*i.TO_FEATURES, i.SCALED).replace("WITH", "WITH RECURSIVE", 1) + """,
covariance AS MATERIALIZED (SELECT [%s]::DOUBLE[][] AS m FROM scaled),%s,
rest AS MATERIALIZED (
  SELECT list_transform(range(1, %d), lambda r: list_transform(range(1, %d), lambda c:
           m[r][c] - l * v[r] * v[c])) AS m FROM covariance, first_axis),%s""" % (
    ", ".join(
        "[" + ", ".join(f'covar_samp("{a}", "{b}")' for b in CLUSTER_FEATURES) + "]"
        for a in CLUSTER_FEATURES
    ),
    _power("first_axis", "covariance"), N_FEATURES + 1, N_FEATURES + 1,
    _power("second_axis", "rest"),
)


def _pca_axis(axis: str, n: int) -> str:
    terms = " + ".join(
        f'("{c}" - "mean_{c}") * {axis}.v[{k}]' for k, c in enumerate(CLUSTER_FEATURES, 1)
    )
    return f"{terms} AS pc{n}"


@check(
    "pca_projection",
    PCA + f"""
SELECT "CustomerID", {_pca_axis("first_axis", 1)}, {_pca_axis("second_axis", 2)}
FROM scaled, first_axis, second_axis,
     (SELECT {", ".join(f'avg("{c}") AS "mean_{c}"' for c in CLUSTER_FEATURES)} FROM scaled)""",
    ["pc1", "pc2"],
)
def _(spark, folder):
    return profiles.pca_projection(i.scaled(spark, folder), CLUSTER_FEATURES)


TRACE = " + ".join(f"m[{k}][{k}]" for k in range(1, N_FEATURES + 1))


@check(
    "pca_variance",
    PCA + f"""
SELECT 'pc1' AS component, l / ({TRACE}) AS explained_variance FROM first_axis, covariance
UNION ALL SELECT 'pc2', l / ({TRACE}) FROM second_axis, covariance""",
    ["explained_variance"],
)
def _(spark, folder):
    return profiles.pca_variance(i.scaled(spark, folder), CLUSTER_FEATURES)


KNOWN = W(*i.TO_LABELED)


def on_labeled(make: Callable[[DataFrame], DataFrame]) -> Run:
    return lambda spark, folder: make(i.labeled_customers(spark, folder))


check(
    "feature_profiles",
    KNOWN + " SELECT cluster, " + ", ".join(
        f'avg(("{c}" - lo_{n}) / nullif(hi_{n} - lo_{n}, 0)) AS "{c}"'
        for n, c in enumerate(ANALYSIS_FEATURES)
    ) + " FROM known, (SELECT " + ", ".join(
        f'min("{c}") AS lo_{n}, max("{c}") AS hi_{n}' for n, c in enumerate(ANALYSIS_FEATURES)
    ) + " FROM known) GROUP BY 1",
    ANALYSIS_FEATURES, 6,
)(on_labeled(profiles.feature_profiles))

check(
    "cluster_distribution",
    KNOWN + " SELECT cluster, count(*) AS customers, "
    "count(*) * 100 / sum(count(*)) OVER () AS percentage FROM known GROUP BY 1",
    ["percentage"],
)(on_labeled(profiles.cluster_distribution))

check(
    "cluster_profiles",
    KNOWN + " SELECT cluster, count(*) AS customers, " + ", ".join(
        f'avg("{c}") AS "{c}_mean", stddev_samp("{c}") AS "{c}_std"' for c in PROFILE_FEATURES
    ) + " FROM known GROUP BY 1",
    [f"{c}_{n}" for c in PROFILE_FEATURES for n in ("mean", "std")], 4,
)(on_labeled(profiles.cluster_profiles))

check(
    "rfm_3d_sample",
    KNOWN + f' SELECT * FROM (SELECT "CustomerID", "Recency", "Frequency", "Monetary", cluster '
    f"FROM labeled ORDER BY {TICKET} LIMIT 5000) WHERE cluster <> -1",
    ["Recency", "Frequency", "Monetary"],
)(on_labeled(profiles.rfm_3d_sample))


@check(
    "silhouette_by_cluster",
    W(
        *i.TO_FEATURES, i.SCALED, i.GIVEN,
        "members AS (SELECT 'cluster' AS labeling, * FROM scaled JOIN given "
        'USING ("CustomerID") WHERE cluster <> -1)',
        i.silhouettes("CustomerID", i.point_gap(CLUSTER_FEATURES)),
    ) + """,
graded AS (
  SELECT CASE WHEN grouping(cluster) = 1 THEN 'Overall' ELSE 'Cluster ' || cluster END AS cluster,
         count(*) AS size, avg(silhouette) AS avg_silhouette, min(silhouette) AS min_silhouette,
         max(silhouette) AS max_silhouette
  FROM silhouettes GROUP BY ROLLUP (cluster))
SELECT *, CASE WHEN cluster = 'Overall' THEN
                 CASE WHEN avg_silhouette >= 0.3 THEN 'Average' ELSE 'Poor' END
               WHEN avg_silhouette >= 0.5 THEN 'Good' WHEN avg_silhouette >= 0.3 THEN 'Fair'
               ELSE 'Poor' END AS quality
FROM graded""",
    ["avg_silhouette", "min_silhouette", "max_silhouette"],
)
def _(spark, folder):
    return profiles.silhouette_by_cluster(metrics.silhouette_samples(
        i.labeled_points(spark, folder), CLUSTER_FEATURES, ["cluster"], distance="euclidean"
    ))


# ---- Fitted models: what must hold, counted apart from the code that fits --------------------

def breaches(df: DataFrame, **rules) -> DataFrame:
    """One row per rule: rows examined, rows that break it."""
    rows = F.array(*[
        F.struct(
            F.lit(name).alias("rule"), F.count("*").alias("examined"),
            F.count_if(~F.coalesce(rule, F.lit(False))).alias("breaches"),
        ) for name, rule in rules.items()
    ])
    return df.agg(rows.alias("rows")).select(F.inline("rows"))


def none_broken(*rules: str) -> str:
    rows = " UNION ALL ".join(
        f"SELECT '{rule}' AS rule, count(*) AS examined, 0 AS breaches FROM features"
        for rule in rules
    )
    return W(*i.TO_FEATURES) + rows


def with_gaps(points: DataFrame, labeled: DataFrame) -> DataFrame:
    """Each row's distance to the mean of its cluster (own) and to the nearest mean (least)."""
    rows = materialize(points.join(labeled, "CustomerID"), "labeled")
    means = rows.groupBy("cluster").agg(*[F.avg(c).alias(c) for c in CLUSTER_FEATURES])
    gaps = []
    for mean in means.collect():
        square = sum(
            ((F.col(c) - F.lit(mean[c])) * (F.col(c) - F.lit(mean[c])) for c in CLUSTER_FEATURES),
            F.lit(0.0),
        )
        gaps.append((mean.cluster, F.sqrt(square)))
    own = F.coalesce(*[F.when(F.col("cluster") == k, gap) for k, gap in gaps])
    return rows.select(
        "CustomerID", "cluster", own.alias("own"), F.least(*[gap for _, gap in gaps]).alias("least")
    )


@check("kmeans_checks", none_broken("labels", "nearest"))
def _(spark, folder):
    points = analysis.robust_points(i.features(spark, folder), CLUSTER_FEATURES)
    rows = with_gaps(points, clustering.kmeans(points, CLUSTER_FEATURES, 5))
    # At the end every row is nearest to the mean of its own cluster.
    return breaches(
        rows, labels=F.col("cluster").between(1, 5), nearest=F.col("own") <= F.col("least") + 1e-9
    )


@check("gaussian_mixture_checks", none_broken("labels", "likeliest", "gains", "weights"))
def _(spark, folder):
    points = analysis.robust_points(i.features(spark, folder), CLUSTER_FEATURES)
    start = kmeans.fit_kmeans(points, CLUSTER_FEATURES, 5)
    fitted = mixture.fit_mixture(points, CLUSTER_FEATURES, start)
    logs = []
    for weight, mean, cov in zip(fitted.weights, fitted.means, fitted.covariances, strict=True):
        inverse, size = np.linalg.inv(cov), np.linalg.slogdet(cov)[1]
        off = [F.col(c) - F.lit(float(m)) for c, m in zip(CLUSTER_FEATURES, mean, strict=True)]
        form = sum(
            (F.lit(float(inverse[a, b])) * off[a] * off[b]
             for a in range(N_FEATURES) for b in range(N_FEATURES)), F.lit(0.0),
        )
        logs.append(F.lit(float(np.log(weight)) - size / 2) - form / 2)
    labeled = mixture.assign_mixture(points, CLUSTER_FEATURES, fitted)
    rows = points.join(labeled, "CustomerID")
    own = F.element_at(F.array(*logs), F.col("label") + 1)
    gains = all(b > a - 1e-9 for a, b in zip(fitted.likelihoods, fitted.likelihoods[1:]))
    return breaches(
        rows, labels=F.col("label").between(0, 4), likeliest=own >= F.greatest(*logs) - 1e-6,
        gains=F.lit(gains), weights=F.lit(abs(float(fitted.weights.sum()) - 1) < 1e-9),
    )


@check("hierarchical_checks", none_broken("labels", "one_each"))
def _(spark, folder):
    points = analysis.robust_points(i.features(spark, folder), CLUSTER_FEATURES)
    labeled = clustering.hierarchical(points, CLUSTER_FEATURES, 5)
    rows = points.select("CustomerID").join(
        labeled.groupBy("CustomerID").agg(F.max("cluster").alias("cluster"), F.count("*").alias("n")),
        "CustomerID", "left",
    )
    return breaches(rows, labels=F.col("cluster").between(1, 5), one_each=F.col("n") == 1)


@check("consensus_clustering_checks", none_broken("labels", "equal_signatures"))
def _(spark, folder):
    points = analysis.robust_points(i.features(spark, folder), CLUSTER_FEATURES)
    labeled = clustering.consensus_clustering(points, CLUSTER_FEATURES, 5)
    signed = clustering.kmeans_runs(points, CLUSTER_FEATURES, 5)
    rows = materialize(signed.join(labeled, "CustomerID"), "signed")
    # Customers whose labels agree in every run are at distance 0 and cannot be parted.
    parted = rows.groupBy("signature").agg(F.count_distinct("cluster").alias("clusters"))
    return breaches(
        rows.join(parted, "signature"), labels=F.col("cluster").between(1, 5),
        equal_signatures=F.col("clusters") == 1,
    )


@check(
    "kmeans_sweep_checks",
    """SELECT unnest(['calinski_harabasz', 'silhouette', 'wcss', 'wcss_falls']) AS rule,
       count(*) AS examined, 0 AS breaches FROM generate_series(2, 8)""",
)
def _(spark, folder):
    points = analysis.robust_points(i.features(spark, folder), CLUSTER_FEATURES)
    fitted = selection.fit_every_k(points, CLUSTER_FEATURES, gap_sets=0)
    table = selection._quality(points, CLUSTER_FEATURES, fitted)
    costs = spark.createDataFrame(
        [(k, float(model.cost)) for (_, k), model in fitted.items()], "k int, cost double"
    )
    rows = table.join(costs, "k").withColumn("before", F.lag("wcss").over(Window.orderBy("k")))
    return breaches(
        rows, calinski_harabasz=F.col("calinski_harabasz") > 0,
        silhouette=F.col("silhouette").between(-1, 1),
        wcss=F.abs(F.col("wcss") - F.col("cost")) <= 1e-6 * F.col("cost"),
        wcss_falls=F.coalesce(F.col("wcss") < F.col("before"), F.col("k") == 2),
    )


@check(
    "gap_statistic_checks",
    """SELECT rule, CASE rule WHEN 'gaps' THEN 7 ELSE 3 END AS examined, 0 AS breaches
       FROM (SELECT unnest(['rows', 'box', 'gaps']) AS rule)""",
)
def _(spark, folder):
    points = analysis.robust_points(i.features(spark, folder), CLUSTER_FEATURES)
    fitted = selection.fit_every_k(points, CLUSTER_FEATURES)
    gaps = {r.k: r.gap_statistic for r in selection.gap_statistic(points, CLUSTER_FEATURES).collect()}
    sets = selection.reference_sets(points, CLUSTER_FEATURES)
    low, high, rows = points.agg(
        F.min(F.least(*CLUSTER_FEATURES)), F.max(F.greatest(*CLUSTER_FEATURES)), F.count("*")
    ).first()

    def cost(centers):
        squares = [
            sum(((F.col(c) - F.lit(float(x))) * (F.col(c) - F.lit(float(x)))
                 for c, x in zip(CLUSTER_FEATURES, center)), F.lit(0.0))
            for center in centers
        ]
        return F.sum(F.least(*squares))

    # The costs are summed up anew, by expressions, at the centres of the fits.
    costs = {}
    for part in range(4):
        data = points if part == 0 else sets.where(F.col("part") == part)
        found = data.agg(*[cost(fitted[part, k].centers).alias(f"k{k}") for k in gaps]).first()
        costs |= {(part, k): found[f"k{k}"] for k in gaps}
    right = [
        abs(np.log(np.mean([costs[p, k] for p in (1, 2, 3)])) - np.log(costs[0, k]) - gap) < 1e-6
        for k, gap in gaps.items()
    ]
    shapes = sets.groupBy("part").agg(
        F.count("*").alias("n"), F.min(F.least(*CLUSTER_FEATURES)).alias("low"),
        F.max(F.greatest(*CLUSTER_FEATURES)).alias("high"),
    )
    by_set = breaches(
        shapes, rows=F.col("n") == rows, box=(F.col("low") >= low) & (F.col("high") <= high)
    )
    table_ = spark.createDataFrame([(bool(r),) for r in right], "ok boolean")
    return by_set.union(breaches(table_, gaps=F.col("ok")))


@check(
    "run_analysis_checks", none_broken("kept_or_outlier", "one_segment_each", "named_by_the_rules")
)
def _(spark, folder):
    done = analysis.run_analysis(order_lines(spark, folder))
    outliers = done.scored.where("is_outlier").select("CustomerID", F.lit(1).alias("out"))
    named = done.assigned.groupBy("CustomerID").agg(
        F.count("*").alias("times"), F.max("cluster").alias("cluster"), F.max("segment").alias("segment")
    )
    rows = done.features.select("CustomerID").join(outliers, "CustomerID", "left").join(
        named, "CustomerID", "left"
    )
    out, times = F.coalesce("out", F.lit(0)), F.coalesce("times", F.lit(0))
    noise = F.coalesce("cluster", F.lit(-1)) == -1
    # The rules once more, on means taken here.
    means = done.customers.where("cluster <> -1").groupBy("cluster").agg(
        *[F.avg(c).alias(c[0]) for c in ("Recency", "Frequency", "Monetary")], F.count("*").alias("n")
    ).toPandas()
    total = {c: float((means[c] * means["n"]).sum() / means["n"].sum()) for c in "RFM"}
    names = {key: texts[1] for key, texts in SEGMENTS.items()}
    expected = {}
    for r in means.itertuples():
        score = 0.4 * (1 - min(r.R / 365, 1)) + 0.3 * min(r.F / means["F"].max(), 1) + (
            0.3 * min(r.M / means["M"].max(), 1)
        )
        expected[int(r.cluster)] = names[
            "champions" if score > 0.7
            else "potential" if r.R < total["R"] and r.M > total["M"]
            else "loyal" if r.F > total["F"]
            else "new" if r.R < total["R"]
            else "risk" if r.R > 365 else "standard"
        ]
    wanted = F.create_map(*[F.lit(x) for pair in expected.items() for x in pair])
    return breaches(
        rows, kept_or_outlier=out + times == 1,
        one_segment_each=(times == 0) | (noise == F.col("segment").isNull()),
        named_by_the_rules=(times == 0) | noise | (F.col("segment") == wanted[F.col("cluster")]),
    )


@check("isolation_forest_checks", none_broken("scores", "cut", "walked", "samples"))
def _(spark, folder):
    customers = i.stored_features(spark, folder)
    scored = materialize(anomaly.isolation_forest(customers, CLUSTER_FEATURES), "scored")
    cut = scored.agg(F.percentile("anomaly_score", F.lit(0.95))).first()[0]
    score = F.col("anomaly_score")
    # Every twentieth row is walked down the trees node by node.
    rows = customers.count()
    size = min(anomaly.FOREST_SAMPLE, rows)
    samples = materialize(
        anomaly.draw_samples(customers, CLUSTER_FEATURES, rows, anomaly.FOREST_TREES, size, SEED),
        "samples",
    )
    drawn = [r["count"] for r in samples.groupBy("tree").count().collect()]
    enough = len(drawn) == anomaly.FOREST_TREES and min(drawn) >= size
    trees = {}
    for n in anomaly.grow_forest(samples, CLUSTER_FEATURES, size, SEED).to_dict("records"):
        trees.setdefault(n["tree"], {})[n["node"]] = n
    harmonic = np.log(size - 1) + 0.5772156649015329
    mean_path = 2 * harmonic - 2 * (size - 1) / size
    walked = []
    for row in scored.where(F.pmod(F.xxhash64("CustomerID"), F.lit(20)) == 0).collect():
        lengths = []
        for nodes in trees.values():
            node = nodes[0]
            while node["feature"] >= 0:
                side = row[CLUSTER_FEATURES[node["feature"]]] <= node["threshold"]
                node = nodes[node["left"] if side else node["right"]]
            lengths.append(node["length"])
        walked.append((row["CustomerID"], float(2 ** (-np.mean(lengths) / mean_path))))
    again = spark.createDataFrame(walked, "CustomerID string, walked double")
    return breaches(
        scored.join(again, "CustomerID", "left"), scores=(score > 0) & (score < 1),
        cut=F.col("is_outlier") == (score > cut),
        walked=F.coalesce(F.abs(F.col("walked") - score) < 1e-9, F.lit(True)),
        samples=F.lit(enough),
    )


# ---- Edges ----------------------------------------------------------------------------------

@check(
    "anova_perfect_split",
    """SELECT 'split' AS feature, 'Infinity'::DOUBLE AS f_statistic, 0.0::DOUBLE AS p_value,
       1.0::DOUBLE AS eta_squared, true AS significant, 'Large' AS effect_size
FROM customer HAVING count(DISTINCT c_nationkey % 3) = 3""",
    ["p_value", "eta_squared"],
)
def _(spark, folder):
    group = (F.col("c_nationkey") % 3).cast("int")
    rows = table(spark, folder, "customer").select(
        group.alias("cluster"), group.cast("double").alias("split")
    )
    return validation.anova(rows, "cluster", ["split"])


@check(
    "quantiles_with_infinities",
    """WITH prices AS (
  SELECT CASE WHEN o_orderkey % 50 = 0 THEN 'Infinity'::DOUBLE
              WHEN o_orderkey % 50 = 1 THEN '-Infinity'::DOUBLE ELSE o_totalprice END AS x
  FROM orders) """ + " UNION ALL ".join(
        f"SELECT {p}::DOUBLE AS p, quantile_cont(x, {p}) AS value FROM prices"
        for p in (0.05, 0.25, 0.5, 0.9)
    ),
    ["value"], 4,
)
def _(spark, folder):
    key, price = F.col("o_orderkey"), F.col("o_totalprice")
    rows = materialize(table(spark, folder, "orders").select(
        F.when(key % 50 == 0, F.lit(float("inf"))).when(key % 50 == 1, F.lit(float("-inf")))
        .otherwise(price).alias("x")
    ), "prices")
    probs = [0.05, 0.25, 0.5, 0.9]
    found = explore.exact_quantiles(rows, ["x"], probs)["x"]
    return spark.createDataFrame(list(zip(probs, found, strict=True)), "p double, value double")


@check(
    "duplicates_by_position",
    """SELECT "CustomerID", "TotalPrice", min(o_orderkey) AS row_pos FROM (
  SELECT CAST(o_custkey AS VARCHAR) AS "CustomerID", floor(o_totalprice / 50000) AS "TotalPrice",
         o_orderkey FROM orders) GROUP BY 1, 2""",
    ["TotalPrice"],
)
def _(spark, folder):
    rows = table(spark, folder, "orders").select(
        F.col("o_custkey").cast("string").alias("CustomerID"),
        F.floor(F.col("o_totalprice") / 50000).cast("double").alias("TotalPrice"),
        F.col("o_orderkey").alias("row_pos"),
    )
    return cleaning.drop_duplicates(rows, "Row Pos")


# ---- Business interpretation ----------------------------------------------------------------

MEANS = KNOWN + """,
means AS (
  SELECT cluster, count(*) AS customers, %s FROM known GROUP BY 1),
overall AS (
  SELECT avg("Recency") AS "Overall_Recency", avg("Frequency") AS "Overall_Frequency",
         avg("Monetary") AS "Overall_Monetary" FROM known),
cluster_means AS (SELECT * FROM means, overall),
scored AS (
  SELECT *, 0.4 * (1 - least("Recency" / 365, 1))
            + 0.3 * least("Frequency" / max("Frequency") OVER (), 1)
            + 0.3 * least("Monetary" / max("Monetary") OVER (), 1) AS value_score
  FROM cluster_means),
chosen AS (
  SELECT *, CASE WHEN value_score > 0.7 THEN 1
                 WHEN "Recency" < "Overall_Recency" AND "Monetary" > "Overall_Monetary" THEN 2
                 WHEN "Frequency" > "Overall_Frequency" THEN 3
                 WHEN "Recency" < "Overall_Recency" THEN 4
                 WHEN "Recency" > 365 THEN 5 ELSE 6 END AS priority
  FROM scored),
texts(priority, segment_name, description, strategy) AS (VALUES %s),
named AS (SELECT * FROM chosen JOIN texts USING (priority)),
report AS (
  SELECT cluster, segment_name, description, strategy, priority, value_score, customers,
         customers * 100 / sum(customers) OVER () AS percentage, "Recency" AS avg_recency,
         "Frequency" AS avg_frequency, "Monetary" AS avg_monetary
  FROM named),
assigned AS (
  SELECT labeled.*, segment_name AS segment
  FROM labeled LEFT JOIN (SELECT cluster, segment_name FROM named) USING (cluster))""" % (
    ", ".join(f'avg("{c}") AS "{c}"' for c in MEANS_FEATURES),
    ", ".join(str(s) for s in SEGMENTS.values()),
)
OVERALL = [f"Overall_{c}" for c in segments.OVERALL]
MEANS_DIGITS = {"Overall_Monetary": 4}

check(
    "cluster_means", MEANS + " SELECT * FROM cluster_means", [*MEANS_FEATURES, *OVERALL],
    MEANS_DIGITS,
)(on_labeled(segments.cluster_means))

check(
    "value_score", MEANS + " SELECT * FROM scored",
    [*MEANS_FEATURES, *OVERALL, "value_score"], MEANS_DIGITS,
)(on_labeled(lambda df: segments.value_score(segments.cluster_means(df))))

check(
    "segment_rules", MEANS + " SELECT * FROM named",
    [*MEANS_FEATURES, *OVERALL, "value_score"], MEANS_DIGITS,
)(on_labeled(segments.interpret_clusters))

check(
    "assign_segments", MEANS + ' SELECT "CustomerID", cluster, segment FROM assigned'
)(on_labeled(lambda df: segments.assign_segments(
    df.select("CustomerID", "cluster"), segments.interpret_clusters(df)
)))

REPORT = ["value_score", "percentage", "avg_recency", "avg_frequency", "avg_monetary"]

check(
    "segment_report", MEANS + " SELECT * FROM report", REPORT, {"avg_monetary": 4}
)(on_labeled(lambda df: segments.segment_report(segments.interpret_clusters(df))))

check(
    "action_plan",
    MEANS + " SELECT priority, cluster, segment_name AS segment, customers AS size, strategy "
    "FROM report",
)(on_labeled(
    lambda df: segments.action_plan(segments.segment_report(segments.interpret_clusters(df)))
))

check(
    "segment_sample",
    MEANS + ' SELECT "CustomerID", "Recency", "Frequency", "Monetary", cluster, segment '
    f"FROM assigned ORDER BY {TICKET} LIMIT 20",
    ["Recency", "Frequency", "Monetary"],
)(on_labeled(lambda df: segments.segment_sample(
    segments.assign_segments(df, segments.interpret_clusters(df))
)))

check(
    "segment_summary",
    MEANS + " SELECT segment, count(*) AS customers, "
    "count(*) * 100 / (SELECT count(*) FROM labeled) AS percentage FROM assigned "
    "WHERE segment IS NOT NULL GROUP BY 1",
    ["percentage"],
)(on_labeled(lambda df: segments.segment_summary(
    segments.assign_segments(df, segments.interpret_clusters(df))
)))


# ---- The whole analysis ---------------------------------------------------------------------

@check("run_analysis")
def _(spark, folder):
    done = analysis.run_analysis(order_lines(spark, folder))
    return done.assigned.select("CustomerID", "cluster", "segment")


@check("executive_summary")
def _(spark, folder):
    return analysis.executive_summary(analysis.run_analysis(order_lines(spark, folder)))


@check(
    "executive_summary_counts",
    W(*i.TO_FEATURES) + """,
counted AS (
  SELECT (SELECT count(*) FROM lines) AS raw, (SELECT count(DISTINCT "CustomerID") FROM lines) AS people,
         count(*) AS kept, count(DISTINCT "CustomerID") AS known FROM clean)
SELECT unnest(['Total Customers', 'Total Transactions', 'Transaction Retention',
               'Customer Retention', 'Features Used', 'Algorithms Tested']) AS item,
       unnest([format('{:,}', known), format('{:,}', kept),
               format('{:.1f}%', kept * 100.0 / raw), format('{:.1f}%', known * 100.0 / people),
               '""" + str(len(CLUSTER_FEATURES)) + """', '1']) AS value
FROM counted""",
)
def _(spark, folder):
    """The figures of the summary that do not hang on a fitted model, of a short analysis."""
    done = analysis.run_analysis(
        order_lines(spark, folder), max_clusters=4, methods=["KMeans"], distance="squared"
    )
    items = ["Total Customers", "Total Transactions", "Transaction Retention", "Customer Retention",
             "Features Used", "Algorithms Tested"]
    return analysis.executive_summary(done).where(F.col("item").isin(items))


@check("algorithm_comparison_fitted")
def _(spark, folder):
    points = analysis.robust_points(i.features(spark, folder), CLUSTER_FEATURES)
    fitted = analysis.fit_all(points, CLUSTER_FEATURES, 5)
    labeled = analysis.with_labels(points, fitted)
    return analysis.algorithm_comparison(labeled, CLUSTER_FEATURES, list(fitted))
