"""The sales columns seen over order tables, for tests and benchmarks."""

from __future__ import annotations

from collections.abc import Iterator
from urllib.parse import unquote

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from salesmill.operators import sizes
from salesmill.schema import STAGED_COLUMNS
from salesmill.session import open_writers
from salesmill.sources.drop_files import DROP_SUFFIXES
from salesmill.sources.files import list_files, move_files, qualified

# Stand-in texts are wider than those of real drop files.
STANDIN_WIDTHS = {
    "invoice_id": 15,
    "branch_code": 11,
    "city": 15,
    "customer_type": 10,
    "gender": 10,
    "product_line": 40,
    "unit_price": 10,
    "quantity": 5,
    "tax": 7,
    "total": 10,
    "sales_date": 10,
    "sales_time": 10,
    "payment": 15,
    "cogs": 10,
    "gross_margin_percentage": 15,
    "gross_income": 10,
    "rating": 5,
}

# A row is shuffled and written as one text, the line of its file.
HEADER = ",".join(STAGED_COLUMNS)
# Contested files are cut so that each is made of about so many sales, over five companies.
CONTESTED_SALES = 4_000_000
# Files that a task writes at a time.
OPEN_FILES = 100


def sales_view(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Sales made of order lines.

    Customers join the orders first, so the lines are shuffled once for both.
    """

    def table(name: str) -> DataFrame:
        return spark.read.parquet(f"{sf_dir}/{name}.parquet")

    orders = table("orders").join(table("customer"), F.expr("o_custkey = c_custkey"))
    places = table("nation").join(table("region"), F.expr("n_regionkey = r_regionkey"))
    suppliers = table("supplier").join(places, F.expr("s_nationkey = n_nationkey"))
    suppliers = suppliers.select("s_suppkey", "n_name", "r_name")
    # Sent if they fit, so that the lines are not shuffled once more for them.
    suppliers = F.broadcast(suppliers) if sizes.fits(suppliers) else suppliers
    lines = (
        table("lineitem")
        .join(orders, F.expr("l_orderkey = o_orderkey"))
        .join(table("part"), F.expr("l_partkey = p_partkey"))
        .join(suppliers, F.expr("l_suppkey = s_suppkey"))
    )
    return lines.selectExpr(
        "c_mktsegment AS company_name",
        "concat(CAST(l_orderkey AS STRING), '-', CAST(l_linenumber AS STRING)) AS invoice_id",
        "r_name AS branch_code",
        "n_name AS city",
        "o_orderstatus AS customer_type",
        "l_linestatus AS gender",
        "p_type AS product_line",
        "CAST(p_retailprice AS DECIMAL(9,2)) AS unit_price",
        "CAST(l_quantity AS INT) AS quantity",
        "CAST(l_tax AS DECIMAL(12,2)) AS tax",
        "CAST(l_extendedprice AS DECIMAL(12,2)) AS total",
        "CAST(l_shipdate AS DATE) AS sales_date",
        "l_returnflag AS sales_time",
        "o_orderpriority AS payment",
        "CAST(p_retailprice AS DECIMAL(9,2)) AS cogs",
        "CAST(l_discount AS DECIMAL(12,2)) AS gross_margin_percentage",
        "CAST(l_extendedprice AS DECIMAL(12,2)) AS gross_income",
        "CAST(p_size AS DECIMAL(9,2)) AS rating",
    )


def staged_text(sales: DataFrame) -> DataFrame:
    """The same rows as the text of a drop file."""
    dates = F.date_format("sales_date", "M/d/yyyy")
    return sales.select(
        *[
            (dates if c == "sales_date" else F.col(c).cast("string")).alias(c)
            for c in sales.columns
        ]
    )


def write_drop_files(staged: DataFrame, drop: str, stage: str) -> None:
    """Write text rows as drop files, a folder per company.

    All rows of an invoice go to one file, so results do not hang on the order in
    which files arrive.
    """
    rows = staged.select("company_name", "invoice_id", _text(STAGED_COLUMNS).alias(HEADER))
    _write_lines(rows.repartition("company_name", "invoice_id").drop("invoice_id"), ["company_name"], stage)
    moves = []
    for location, (company,) in _written(staged.sparkSession, stage):
        moves.append((location, f"{drop}/{company}/{location.rsplit('/', 1)[1]}"))
    move_files(staged.sparkSession, moves)


def write_contested_files(staged: DataFrame, drop: str, stage: str) -> None:
    """Write text rows as three drop files per company, with the rows of one invoice in several.

    By order of arrival: ``first`` has the even order lines; ``bad`` has the odd ones and
    one that cannot be read in each company, so it is rejected whole; ``last`` has all
    lines, with a larger quantity where ``first`` has them, too. Each of the three is cut
    by invoice into several such files if the rows are many.
    """
    spark = staged.sparkSession
    cuts = 1 + staged.count() // CONTESTED_SALES
    line = F.substring_index("invoice_id", "-", -1).cast("int")
    odd = line % 2 != 0
    staged = staged.withColumn("cut", F.pmod(F.xxhash64("invoice_id"), F.lit(cuts)))
    ones = staged.filter(line == 1).groupBy("company_name", "cut")
    worst = F.broadcast(ones.agg(F.min("invoice_id").alias("worst")))
    at = STAGED_COLUMNS.index("quantity")
    # A row is shuffled once and becomes the lines of two files after that.
    rows = staged.join(worst, ["company_name", "cut"], "left").select(
        "company_name",
        "cut",
        F.when(odd & F.col("worst").isNotNull(), F.lit(1)).when(~odd, F.lit(0)).alias("early"),
        (F.col("invoice_id") == F.col("worst")).alias("spoilt"),
        _text(STAGED_COLUMNS[:at]).alias("before"),
        "quantity",
        _text(STAGED_COLUMNS[at + 1 :]).alias("after"),
    )
    parts = F.explode(F.array("early", F.lit(2))).alias("part")
    both = rows.repartition("company_name", "cut").select("*", parts).filter("part IS NOT NULL")
    more = (F.col("quantity").cast("int") + 100).cast("string")
    quantity = (
        F.when((F.col("part") == 1) & F.col("spoilt"), "many")
        .when((F.col("part") == 2) & (F.col("early") == 0), more)
        .otherwise(F.col("quantity"))
    )
    # A file per company, part and cut, as a rejected file is rejected whole.
    folders = ["company_name", "part", "cut"]
    whole = F.concat_ws(",", "before", F.coalesce(quantity, F.lit("")), "after")
    _write_lines(both.select(*folders, whole.alias(HEADER)), folders, stage)
    moves = []
    for location, (company, part, cut) in _written(spark, stage):
        name = location.rsplit("/", 1)[1]
        moves.append((location, f"{drop}/{company}/{part}-{cut}-{name}", 1_000_000 * (1 + int(part))))
    move_files(spark, moves)


def _text(columns: list[str]) -> Column:
    """Fields side by side, as they stand in a drop file."""
    return F.concat_ws(",", *[F.coalesce(F.col(c), F.lit("")) for c in columns])


def _write_lines(rows: DataFrame, partitions: list[str], stage: str) -> None:
    """Lines as gzipped files with the column names on top."""
    options = {"header": True, "sep": "\u0001", "quote": "", "compression": "gzip"}
    kept = {"ignoreLeadingWhiteSpace": False, "ignoreTrailingWhiteSpace": False}
    with open_writers(rows.sparkSession, OPEN_FILES):
        rows.write.partitionBy(*partitions).options(**options, **kept).csv(stage)


def _written(spark: SparkSession, stage: str) -> Iterator[tuple[str, list[str]]]:
    """Files below a folder and the values of the partitions they lie in."""
    base = qualified(spark, stage)
    for _, location in list_files(spark, stage):
        *folders, name = location[len(base) + 1 :].split("/")
        if name.endswith(DROP_SUFFIXES):
            yield location, [unquote(f.split("=", 1)[1]) for f in folders]
