"""Small hand-typed inputs (retyped from the behaviour spec, FIXTURES.md)."""
import datetime as dt

from pyspark.sql import types as T

BRONZE_SCHEMA = T.StructType([
    T.StructField("invoice", T.StringType()), T.StructField("stock_code", T.StringType()),
    T.StructField("description", T.StringType()), T.StructField("quantity", T.LongType()),
    T.StructField("invoice_date", T.TimestampNTZType()), T.StructField("unit_price", T.DoubleType()),
    T.StructField("customer_id", T.DoubleType()), T.StructField("country", T.StringType()),
])


def d(s):
    return dt.datetime.strptime(s, "%Y-%m-%d %H:%M:%S") if " " in s else dt.datetime.strptime(s, "%Y-%m-%d")


SAMPLE_TRANSACTIONS = [
    ("5001", "10001", "Small Widget", 2, d("2023-01-05 10:00:00"), 5.0, 1001.0, "United Kingdom"),
    ("5002", "10002", "Large Widget", 1, d("2023-01-20 11:00:00"), 12.5, 1001.0, "United Kingdom"),
    ("5003", "10001", "Small Widget", 3, d("2023-04-15 09:00:00"), 5.0, 1001.0, "United Kingdom"),
    ("5004", "10003", "Ceramic Mug", 4, d("2023-01-10 14:00:00"), 3.25, 1002.0, "United Kingdom"),
    ("5005", "10004", "Tea Towel", 1, d("2023-01-01 08:30:00"), 2.0, 1003.0, "Germany"),
    ("C5006", "10004", "Tea Towel", -1, d("2023-01-02 09:00:00"), 2.0, 1003.0, "Germany"),
    ("5007", "10005", "Gift Box", 5, d("2023-01-12 12:00:00"), 8.0, 1004.0, "France"),
    ("5007", "10005", "Gift Box", 5, d("2023-01-12 12:00:00"), 8.0, 1004.0, "France"),
    ("5009", "POST", "Postage", 1, d("2023-01-12 12:05:00"), 15.0, 1004.0, "France"),
    ("5010", "10006", "Photo Frame", 0, d("2023-01-13 10:00:00"), 6.5, 1005.0, "United Kingdom"),
    ("5011", "10007", "Candle Set", 2, d("2023-01-14 10:00:00"), -1.0, 1006.0, "United Kingdom"),
    ("5012", "10008", "Notebook", 3, d("2023-01-15 10:00:00"), 4.0, None, "United Kingdom"),
    ("5013", "10009", "Desk Lamp", 1, d("2023-01-18 10:00:00"), 22.0, 1007.0, "United Kingdom"),
    ("5014", "10009", "Desk Lamp", 1, d("2023-02-25 10:00:00"), 22.0, 1007.0, "United Kingdom"),
    ("5015", "10010", "Wall Clock", 2, d("2023-01-22 10:00:00"), 18.0, 1008.0, "EIRE"),
]

SMOKE_CODES = ["POST", "DOT", "M", "D", "S", "B", "BANK CHARGES", "ADJUST", "AMAZONFEE", "PADS", "CRUK", "GIFT"]

FACT_SCHEMA = ("customer_id string, invoice string, stock_code string, invoice_date timestamp_ntz, "
               "revenue double, country string")
