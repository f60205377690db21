"""Column layout, text formats and report names of the sales data."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import types as T

# Staged columns in file order and their widest text in bytes.
STAGED_WIDTHS = {
    "invoice_id": 15,
    "branch_code": 3,
    "city": 15,
    "customer_type": 10,
    "gender": 10,
    "product_line": 40,
    "unit_price": 7,
    "quantity": 5,
    "tax": 7,
    "total": 8,
    "sales_date": 10,
    "sales_time": 10,
    "payment": 15,
    "cogs": 10,
    "gross_margin_percentage": 15,
    "gross_income": 10,
    "rating": 5,
}
STAGED_COLUMNS = list(STAGED_WIDTHS)

# Number formats by column. The leading S admits a sign, so that
# returns (negative amounts) are kept.
NUMBER_FORMATS = {
    "unit_price": "S9999999.99",
    "tax": "S9999999.99999",
    "total": "S9999999.99999",
    "cogs": "S9999999.99",
    "gross_margin_percentage": "S9999999.999999999",
    "gross_income": "S9999999.99999",
    "rating": "S9999999.99",
}

# Fixed value: month/day/year, with or without leading zeros.
DATE_FORMAT = "M/d/yyyy"

SALES_SCHEMA = T.StructType(
    [
        T.StructField("company_name", T.StringType()),
        T.StructField("invoice_id", T.StringType()),
        T.StructField("branch_code", T.StringType()),
        T.StructField("city", T.StringType()),
        T.StructField("customer_type", T.StringType()),
        T.StructField("gender", T.StringType()),
        T.StructField("product_line", T.StringType()),
        T.StructField("unit_price", T.DecimalType(9, 2)),
        T.StructField("quantity", T.IntegerType()),
        T.StructField("tax", T.DecimalType(12, 5)),
        T.StructField("total", T.DecimalType(12, 5)),
        T.StructField("sales_date", T.DateType()),
        T.StructField("sales_time", T.StringType()),
        T.StructField("payment", T.StringType()),
        T.StructField("cogs", T.DecimalType(9, 2)),
        T.StructField("gross_margin_percentage", T.DecimalType(16, 9)),
        T.StructField("gross_income", T.DecimalType(12, 5)),
        T.StructField("rating", T.DecimalType(9, 2)),
    ]
)
SALES_COLUMNS = SALES_SCHEMA.names

# The stored table carries the load it came from; company and load are its
# directory levels.
HISTORY_SCHEMA = T.StructType(
    [f for f in SALES_SCHEMA if f.name != "company_name"]
    + [T.StructField("company_name", T.StringType()), T.StructField("batch_id", T.StringType())]
)
HISTORY_PARTITIONS = ["company_name", "batch_id"]

# One sale is known by its invoice within its company.
INVOICE_KEY = ["company_name", "invoice_id"]

# Finest grouping that every report can be rolled up from.
SUMMARY_KEYS = ["company_name", "branch_code", "city", "product_line", "payment"]

# Of these, what reports of the whole industry are grouped by.
INDUSTRY_KEYS = [k for k in SUMMARY_KEYS if k not in ("company_name", "branch_code")]

INDUSTRY_MEASURES = [
    "company_tot_sales",
    "total_industry_sales",
    "company_avg_sales",
    "average_industry_sales",
]


@dataclass(frozen=True)
class Report:
    """One report file: its name, grouping columns and kind."""

    file_name: str
    keys: tuple[str, ...]
    industry: bool = False

    @property
    def measure(self) -> str:
        return "total_industry_sales" if self.industry else "total_sales"

    @property
    def columns(self) -> list[str]:
        return [*self.keys, *(INDUSTRY_MEASURES if self.industry else ["total_sales"])]


# Report file names and grouping columns. Files get the suffix 000.
REPORTS = [
    Report("Branch_Sales.csv_", ("branch_code",)),
    Report("Payment_Type_Sales.csv_", ("payment",)),
    Report("Product_Sales.csv_", ("product_line",)),
    Report("Product_Branch_Sales.csv_", ("product_line", "branch_code")),
    Report("Product_Payment_Sales.csv_", ("product_line", "payment")),
    Report("Avg_Industry_Sales.csv_", (), industry=True),
    Report("Ind_Product_City_Sales.csv_", ("product_line", "city"), industry=True),
    Report("Ind_Product_Payment_Sales.csv_", ("product_line", "payment"), industry=True),
    Report("Ind_Product_Sales.csv_", ("product_line",), industry=True),
]
REPORT_FILE_SUFFIX = "000"
