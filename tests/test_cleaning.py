import datetime as dt

import pytest
from pyspark.sql import functions as F

from clientele.functions import columns as cols
from clientele.operators import cleaning, features
from clientele.sources.files import detect_encoding, read_lines, scan_csv
from clientele.sources.sinks import write_segments

SCHEMA = (
    "CustomerID string, InvoiceNo string, StockCode string, description string, "
    "Quantity double, UnitPrice double, InvoiceDate string"
)
NAN = float("nan")
DIRTY = [
    (None, "1", "a", "x", 1.0, 1.0, "2011-01-01 10:00:00"),
    (" 17850.0 ", "2", "a", "x", 2.0, 3.0, "12/1/2010 8:26"),
    ("17850", "C3", "a", "x", 2.0, 3.0, "2011-01-01 10:00:00"),
    ("17850", "cancel4", "a", "x", 2.0, 3.0, "2011-01-01 10:00:00"),
    ("17850", "VOID5", "a", "x", 2.0, 3.0, "2011-01-01 10:00:00"),
    ("17850", None, "b", "x", 2.0, 3.0, "2011-01-01 10:00:00"),
    ("17850", "6", "a", "x", 0.0, 3.0, "2011-01-01 10:00:00"),
    ("17850", "6", "a", "x", -1.0, 3.0, "2011-01-01 10:00:00"),
    ("17850", "6", "a", "x", None, 3.0, "2011-01-01 10:00:00"),
    ("17850", "6", "a", "x", NAN, 3.0, "2011-01-01 10:00:00"),
    ("17850", "6", "a", "x", 1.0, 0.0, "2011-01-01 10:00:00"),
    ("17850", "6", "a", "x", 1.0, None, "2011-01-01 10:00:00"),
    ("17850", "7", "a", "x", 1.0, 4.0, "no date"),
    ("9", "8", "a", "x", 1.0, 5.0, "2011-01-03 09:00:00"),
    ("9", "8", "a", "x", 1.0, 5.0, "2011-01-03 09:00:00"),
    ("9", "8", "b", "x", 1.0, 5.0, "2011-01-03 08:00:00"),
    ("10", None, "b", "x", 1.0, 6.0, "2011-01-03 08:00:00"),
]


@pytest.fixture(scope="module")
def dirty(spark):
    return cleaning.standard_lines(spark.createDataFrame(DIRTY, SCHEMA))


def test_names():
    assert cols.clean_name("  Unit  Price (GBP)! ") == "unit_price_gbp"
    assert cols.clean_name("Größe") == "größe"
    assert cols.identify_key_columns(["date", "orderdate", "qty", "clientid"]) == {
        "customer_id": "clientid", "invoice_date": "date", "quantity": "qty",
    }


def test_no_customer_column(spark):
    with pytest.raises(ValueError, match="customer id"):
        cleaning.standard_lines(spark.range(1))


def test_valid_lines(dirty):
    rows = cleaning.valid_lines(dirty).collect()
    assert sorted((r.CustomerID, r.InvoiceNo or "", r.TotalPrice) for r in rows) == [
        ("10", "", 6.0), ("17850", "", 6.0), ("17850", "2", 6.0), ("17850", "7", 4.0),
        ("9", "8", 5.0), ("9", "8", 5.0), ("9", "8", 5.0),
    ]
    dates = {r.InvoiceNo: r.InvoiceDate for r in rows}
    assert dates["2"] == dt.datetime(2010, 12, 1, 8, 26)
    assert dates["7"] is None


def test_audit_adds_up(dirty):
    audit = {r.step: r.rows_removed for r in cleaning.cleaning_audit(dirty).collect()}
    assert audit == {
        "missing_customer": 1, "cancelled": 3, "non_positive_quantity": 4,
        "non_positive_price": 2, "duplicates": 1, "extreme_totals": 1,
    }
    clean = cleaning.clean_lines(dirty)
    assert clean.count() == len(DIRTY) - sum(audit.values())
    stats = cleaning.clean_stats(dirty, clean).first()
    assert (stats.clean_rows, stats.rows_removed) == (5, 12)


def test_numeric_ids(spark):
    df = spark.createDataFrame([(123456789.0,), (1.5,), (None,)], "CustomerID double")
    ids = [r.CustomerID for r in cleaning.normalize_customer_id(df).collect()]
    assert ids == ["123456789", "1.5", None]


def test_features_of_odd_customers(dirty):
    lines = cleaning.distinct_lines(dirty)
    table = {r.CustomerID: r for r in features.engineer_features(lines, "never").collect()}
    # Customer 10 has no invoice number and drops out; 9 has one invoice, dated by its first line.
    assert sorted(table) == ["17850", "9"]
    nine, other = table["9"], table["17850"]
    assert (nine.Frequency, nine.Monetary, nine.Std_Transaction) == (1.0, 10.0, 0.0)
    assert (nine.Recency, nine.Tenure, nine.Unique_Products) == (1.0, 1.0, 2.0)
    # Two invoices, one of them without a date: only the dated one counts.
    assert (other.Frequency, other.Monetary) == (1.0, 10.0)
    assert (other.Unique_Products, other.Transaction_Variety) == (2.0, 2 / 3)
    assert other.Items_Per_Transaction == 3.0


def test_customer_without_dates(spark):
    lines = spark.createDataFrame(
        [("a", "1", "p", 2.0, 8.0, None), ("b", "2", "p", 1.0, 1.0, dt.datetime(2011, 1, 1))],
        "CustomerID string, InvoiceNo string, StockCode string, Quantity double, "
        "TotalPrice double, InvoiceDate timestamp_ntz",
    )
    row = features.engineer_features(lines, "never").where("CustomerID = 'a'").first()
    assert (row.Recency, row.Frequency, row.Tenure, row.Monetary_Rate) == (0.0, 0.0, 0.0, 0.0)
    assert row.Items_Per_Transaction == 0.0


def test_elapsed_days_are_whole(spark):
    invoices = spark.createDataFrame(
        [
            ("a", "1", 1.0, dt.datetime(2011, 1, 1, 12), 1.0),
            ("b", "2", 1.0, dt.datetime(2011, 1, 2, 11, 50), 1.0),
        ],
        "CustomerID string, InvoiceNo string, TotalPrice double, InvoiceDate timestamp_ntz, "
        "Quantity double",
    )
    days = {r.CustomerID: r.Recency for r in features.rfm_agg(invoices).collect()}
    assert days == {"a": 1.0, "b": 1.0}


def test_first_date_in_file_order(spark):
    lines = spark.createDataFrame(
        [
            (0, "a", "1", 1.0, None, 1.0),
            (1, "a", "1", 1.0, dt.datetime(2011, 1, 5), 1.0),
            (2, "a", "1", 1.0, dt.datetime(2011, 1, 1), 1.0),
        ],
        "pos int, CustomerID string, InvoiceNo string, TotalPrice double, "
        "InvoiceDate timestamp_ntz, Quantity double",
    )
    assert features.invoice_agg(lines, "pos").first().InvoiceDate == dt.datetime(2011, 1, 5)
    assert features.invoice_agg(lines).first().InvoiceDate == dt.datetime(2011, 1, 1)


def test_duplicates_keep_the_first_position(spark):
    df = spark.createDataFrame([(3, "a"), (1, "a"), (2, "b")], "pos int, x string")
    rows = cleaning.drop_duplicates(df, "pos").collect()
    assert sorted((r.pos, r.x) for r in rows) == [(1, "a"), (2, "b")]


CSV = "Invoice No,Customer ID,Qty,Price,Date,Description\n" \
    "1,17850,2,1.5,12/1/2010 8:26,\"two\nlines, \"\"quoted\"\"\"\n" \
    "2,NA,1,2.0,12/1/2010 8:26,café\n"


@pytest.mark.parametrize("encoding", ["utf-8-sig", "iso-8859-1"])
def test_csv_encodings(spark, tmp_path, encoding):
    path = tmp_path / "lines.CSV"
    path.write_bytes(CSV.encode(encoding))
    wanted = "UTF-8" if encoding.startswith("utf") else "ISO-8859-1"
    assert detect_encoding(spark, str(path)) == wanted
    # Both cost a scan or the splitting of files, so the caller asks for them.
    asked = {"encoding": None, "multi_line": True}
    rows = read_lines(spark, str(path), **asked).orderBy("InvoiceNo").collect()
    assert [r.CustomerID for r in rows] == ["17850", None]
    assert [r.description for r in rows] == ['two\nlines, "quoted"', "café"]
    assert rows[0].Quantity * rows[0].UnitPrice == 3.0
    ordered = scan_csv(spark, str(path), order_col="pos", **asked).orderBy("pos").collect()
    assert [r["Invoice No"] for r in ordered] == ["1", "2"]


def test_unreadable_files(spark, tmp_path):
    with pytest.raises(ValueError, match="unsupported"):
        read_lines(spark, str(tmp_path / "lines.xlsx"))
    (tmp_path / "empty.csv").write_text("customerid,qty\n")
    with pytest.raises(ValueError, match="no rows"):
        read_lines(spark, str(tmp_path / "empty.csv"))


def test_sinks(spark, tmp_path):
    df = spark.createDataFrame([("1", "a,b")], "CustomerID string, segment string")
    for kind in ("parquet", "csv"):
        write_segments(df, str(tmp_path / kind), kind)
        back = spark.read.format(kind).option("header", True).load(str(tmp_path / kind))
        assert [tuple(r) for r in back.collect()] == [("1", "a,b")]
    with pytest.raises(ValueError):
        write_segments(df, str(tmp_path / "x"), "png")


def test_log_gate(spark):
    rows = [(str(i), float(i), 1.0, 1.0, 1.0) for i in range(20)] + [("x", 1e6, 1.0, 1.0, 1.0)]
    df = spark.createDataFrame(
        rows, "CustomerID string, Monetary double, Avg_Transaction_Value double, "
        "Total_Items double, Max_Transaction double",
    )
    logged = features.log_features(df)
    assert [c for c in logged.columns if c.startswith("Log_")] == ["Log_Monetary"]
    assert features.feature_columns(logged)[-1] == "Log_Monetary"
    assert logged.where(F.col("Log_Monetary") < 0).isEmpty()
    with pytest.raises(ValueError):
        features.log_features(df, "sometimes")


def test_duplicates_go_whatever_the_name_of_the_order_column(spark):
    rows = [("1", 5.0, 2), ("1", 5.0, 1), ("2", 5.0, 3)]
    for stored, asked in (("rowpos", "RowPos"), ("RowPos", "rowpos"), ("row_pos", "Row Pos!")):
        df = spark.createDataFrame(rows, f"CustomerID string, TotalPrice double, `{stored}` int")
        left = cleaning.drop_duplicates(df, asked).collect()
        assert sorted((r.CustomerID, r[stored]) for r in left) == [("1", 1), ("2", 3)]


def test_the_audit_skips_steps_without_their_column(spark):
    df = spark.createDataFrame([("1", 2.0), (None, 1.0), ("1", 2.0)], "CustomerID string, Quantity double")
    removed = {r.step: r.rows_removed for r in cleaning.cleaning_audit(df).collect()}
    assert removed == {"missing_customer": 1, "cancelled": 0, "non_positive_quantity": 0,
                       "non_positive_price": 0, "duplicates": 1, "extreme_totals": 0}
