"""Names, thresholds and texts that results depend on."""

# ---- Fixed values: column roles and the spellings accepted for each -------------------------
ROLE_ALIASES = {
    "customer_id": ["customerid", "customer_id", "customer", "clientid"],
    "invoice_no": ["invoiceno", "invoice_no", "invoice_number", "orderid"],
    "invoice_date": ["invoicedate", "invoice_date", "orderdate", "date"],
    "quantity": ["quantity", "qty", "amount", "units"],
    "price": ["unitprice", "price", "unit_price", "cost"],
    "stock_code": ["stockcode", "stock_code", "productcode", "sku"],
}
ROLE_NAMES = {
    "customer_id": "CustomerID",
    "invoice_no": "InvoiceNo",
    "invoice_date": "InvoiceDate",
    "quantity": "Quantity",
    "price": "UnitPrice",
    "stock_code": "StockCode",
}

# ---- Fixed values: texts a CSV file uses for a missing value --------------------------------
MISSING_TEXTS = [
    "", "#N/A", "#N/A N/A", "#NA", "-1.#IND", "-1.#QNAN", "-NaN", "-nan", "1.#IND", "1.#QNAN",
    "<NA>", "N/A", "NA", "NULL", "NaN", "None", "n/a", "nan", "null",
]
DATE_FORMATS = ["M/d/yyyy H:mm", "M/d/yyyy H:mm:ss", "M/d/yyyy"]

# ---- Fixed values: feature groups -----------------------------------------------------------
ANALYSIS_FEATURES = [
    "Recency", "Frequency", "Monetary", "Avg_Transaction_Value", "Tenure", "Total_Items",
    "Unique_Products",
]
CLUSTER_FEATURES = [
    "Recency", "Frequency", "Monetary", "Avg_Transaction_Value", "Tenure", "Unique_Products",
    "Total_Items", "Frequency_Rate", "Monetary_Rate", "Items_Per_Transaction",
]
CUSTOMER_FEATURES = [
    "Recency", "Frequency", "Tenure", "Monetary", "Avg_Transaction_Value", "Max_Transaction",
    "Std_Transaction", "Total_Items", "Avg_Items_Per_Transaction", "Unique_Products",
    "Transaction_Variety", "Frequency_Rate", "Monetary_Rate", "Items_Per_Transaction",
]
SKEWED_FEATURES = ["Monetary", "Avg_Transaction_Value", "Total_Items", "Max_Transaction"]
IMPACT_FEATURES = ["Recency", "Frequency", "Monetary", "Total_Items"]
PROFILE_FEATURES = [
    "Recency", "Frequency", "Monetary", "Avg_Transaction_Value", "Total_Items", "Unique_Products",
]
MEANS_FEATURES = [
    "Recency", "Frequency", "Monetary", "Avg_Transaction_Value", "Tenure", "Unique_Products",
]

# ---- Fixed values: parameters ---------------------------------------------------------------
SEED = 42
MAX_CLUSTERS = 8
STARTS = 10
CONSENSUS_RUNS = 10
CONTAMINATION = 0.05
FOREST_TREES = 100
FOREST_SAMPLE = 256
TRIM_PROBS = (0.01, 0.99)
SKEW_GATE = 1.0
HISTOGRAM_BINS = 50
PLOT_SAMPLE = 5000
REPORT_SAMPLE = 20
DBSCAN_EPS = 0.5
DBSCAN_MIN_SAMPLES = 5
GAP_SETS = 3
K_WEIGHTS = {
    "silhouette": 0.3, "calinski_harabasz": 0.2, "davies_bouldin": 0.2, "gap_statistic": 0.3,
}
K_RANGE_OK = (3, 7)
K_DEFAULT = 5
ALGORITHM_ORDER = ["KMeans", "Agglomerative", "GaussianMixture", "DBSCAN", "Consensus"]

# ---- Fixed values: effect sizes, from the largest down --------------------------------------
EFFECT_SIZES = [(0.14, "Large"), (0.06, "Medium"), (0.01, "Small")]
EFFECT_FLOOR = "Negligible"
SIGNIFICANCE = 0.05
SEPARATION = [(0.14, "Strong"), (0.06, "Moderate")]
SEPARATION_FLOOR = "Weak"

# ---- Fixed values: customer segments, in the order the rules are tried ----------------------
SEGMENTS = {
    "champions": (1, "Champions", "High-value, frequent, recent customers",
                  "VIP treatment, premium offers, loyalty programs"),
    "potential": (2, "High-Potential", "Recent customers with high spending",
                  "Upsell, cross-sell, personalized recommendations"),
    "loyal": (3, "Loyal Customers", "Frequent but moderate spending",
              "Loyalty rewards, subscription models"),
    "new": (4, "New Customers", "Recent but low engagement",
            "Onboarding, education, welcome offers"),
    "risk": (5, "At Risk", "Inactive for over a year",
             "Win-back campaigns, special offers"),
    "standard": (6, "Standard", "Average customers with balanced metrics",
                 "General marketing, value-based offers"),
}
CHAMPION_SCORE = 0.7
YEAR_DAYS = 365
SCORE_WEIGHTS = (0.4, 0.3, 0.3)
