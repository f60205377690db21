"""Sales totals of a company, alone and beside those of the whole industry."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from salesmill.schema import INDUSTRY_KEYS, SUMMARY_KEYS, Report
from salesmill.session import scratch_path

CUBE_KEYS = ["product_line", "city", "payment"]


def for_company(sales: DataFrame, company: str) -> DataFrame:
    """Rows of one company; prunes folders of the stored history."""
    return sales.filter(F.col("company_name") == F.lit(company))


def _sum(sales: DataFrame, column: str, value: Column) -> Column:
    """Exact sum with the scale of the summed column."""
    return F.sum(value).cast(T.DecimalType(22, sales.schema[column].dataType.scale))


def sales_summary(sales: DataFrame) -> DataFrame:
    """Sum and count of ``total`` by the finest keys any report needs.

    Both add up, so every report can be had from here without another scan, and
    summaries of single loads add up to that of the history.
    """
    return sales.groupBy(*SUMMARY_KEYS).agg(
        _sum(sales, "total", F.col("total")).alias("total_sales"),
        F.count("total").alias("n_sales"),
    )


def company_by(sales: DataFrame, company: str, keys: Sequence[str]) -> DataFrame:
    """A company's sales by ``keys``."""
    rows = for_company(sales, company)
    return rows.groupBy(*keys).agg(_sum(sales, "total", F.col("total")).alias("total_sales"))


def _average(total: str, count: str, exact: bool) -> Column:
    value = F.col(total) if exact else F.col(total).cast("double")
    average = value / F.nullif(F.col(count), F.lit(0))
    return F.round(average, 5).cast(T.DecimalType(22, 5)) if exact else average


def with_averages(sums: DataFrame, keys: Sequence[str], exact: bool = False) -> DataFrame:
    """The four measures from sums and counts of company and industry.

    Averages are doubles, or with ``exact`` decimals rounded to 5 places, as the
    report files show them: rounding a double would take some halves down.
    """
    return sums.select(
        *keys,
        "company_tot_sales",
        "total_industry_sales",
        _average("company_tot_sales", "_company_n", exact).alias("company_avg_sales"),
        _average("total_industry_sales", "_industry_n", exact).alias("average_industry_sales"),
    )


def _beside_industry(sales: DataFrame, company: str, total: str, count: Column) -> list[Column]:
    """Sums and counts of all rows, and of those of the company."""
    own = F.col("company_name") == F.lit(company)
    return [
        _sum(sales, total, F.when(own, F.col(total))).alias("company_tot_sales"),
        _sum(sales, total, F.col(total)).alias("total_industry_sales"),
        F.sum(F.when(own, count)).alias("_company_n"),
        F.sum(count).alias("_industry_n"),
    ]


def industry_by(
    sales: DataFrame, company: str, keys: Sequence[str], exact: bool = False
) -> DataFrame:
    """Sum and average of a company beside those of all companies, by ``keys``.

    Without keys there is always one row, all NULL when there are no sales.
    """
    counted = F.col("total").isNotNull().cast("bigint")
    sums = sales.groupBy(*keys).agg(*_beside_industry(sales, company, "total", counted))
    return with_averages(sums, keys, exact)


def industry_total(sales: DataFrame, company: str) -> DataFrame:
    """:func:`industry_by` over everything."""
    return industry_by(sales, company, [])


def industry_cube(summary: DataFrame, company: str) -> DataFrame:
    """All four industry groupings at once, told apart by ``grouping_id``.

    Takes a summary, so only its few rows are repeated per grouping.
    """
    sets = [[], ["product_line", "city"], ["product_line", "payment"], ["product_line"]]
    columns = [[F.col(c) for c in s] for s in sets]
    sums = summary.groupingSets(columns, *CUBE_KEYS).agg(
        F.grouping_id().cast("int").alias("grouping_id"),
        *_beside_industry(summary, company, "total_sales", F.col("n_sales")),
    )
    return with_averages(sums, [*CUBE_KEYS, "grouping_id"])


def grouping_number(keys: Sequence[str]) -> int:
    """``grouping_id`` over the summary keys of rows grouped by ``keys``."""
    return sum(1 << n for n, c in enumerate(reversed(SUMMARY_KEYS)) if c not in keys)


def _grouped(summary: DataFrame, sets: set[tuple[str, ...]], keys: Sequence[str]) -> DataFrame:
    columns = [[F.col(c) for c in s] for s in sorted(sets)]
    return summary.groupingSets(columns, *keys).agg(
        F.grouping_id().cast("int").alias("grouping_id"),
        _sum(summary, "total_sales", F.col("total_sales")).alias("total_sales"),
        F.sum("n_sales").alias("n_sales"),
    )


def company_sums(
    summary: DataFrame, companies: Sequence[str], reports: Sequence[Report]
) -> DataFrame:
    """Sums and counts for all reports of some companies.

    ``grouping_id`` over the summary keys tells the groupings apart.
    """
    own = summary.filter(F.col("company_name").isin(list(companies)))
    return _grouped(own, {("company_name", *r.keys) for r in reports}, SUMMARY_KEYS)


def industry_sums(summary: DataFrame, reports: Sequence[Report]) -> DataFrame:
    """Sums and counts of the whole industry for its reports.

    ``summary`` needs no column but the keys and sums of the industry. Companies are
    added up first, so that only the few rows left are repeated per grouping.
    """
    keys = INDUSTRY_KEYS
    whole = summary.groupBy(*keys).agg(
        _sum(summary, "total_sales", F.col("total_sales")).alias("total_sales"),
        F.sum("n_sales").alias("n_sales"),
    )
    rows = _grouped(whole, {r.keys for r in reports if r.industry}, keys)
    # Numbered as the same grouping of one company, which has no branch either.
    branch = grouping_number([k for k in SUMMARY_KEYS if k != "branch_code"])
    return rows.withColumn("grouping_id", F.col("grouping_id") + branch)


def industry_rows(industry: DataFrame, own: DataFrame, companies: Column) -> DataFrame:
    """The rows of :func:`industry_by` for several companies at once.

    Every company is shown all groups of the industry, so these are repeated per
    company by the ``companies`` generator, and then meet the sums of the company.
    """
    shown = industry.withColumnsRenamed(
        {"total_sales": "total_industry_sales", "n_sales": "_industry_n"}
    ).select("*", companies)
    keys = ["grouping_id", "company_name", "city", "product_line", "payment"]
    sums = own.select(
        *[F.col(c).alias(f"_own_{c}") for c in keys],
        F.col("total_sales").alias("company_tot_sales"),
        F.col("n_sales").alias("_company_n"),
    )
    match = F.lit(True)
    for c in keys:
        match = match & shown[c].eqNullSafe(sums[f"_own_{c}"])
    return with_averages(shown.join(sums, match, "left"), ["company_no", *keys], exact=True)


def report_order(report: Report) -> list[Column]:
    """Largest amounts first and NULL above them, then keys with NULL last."""
    keys = [F.col(k).asc_nulls_last() for k in report.keys]
    return [F.col(report.measure).desc_nulls_first(), *keys]


def in_report_order(rows: DataFrame, report: Report) -> DataFrame:
    return rows.orderBy(*report_order(report))


def report_places(rows: DataFrame, report: Report) -> DataFrame:
    """The rows with their ``place`` in the report, counted from 1.

    Rows are dealt by ranges of the report's order and sorted within them; a place is
    the number within its range plus the rows of all ranges before, of which there is one
    count per range. So no task sees more than its range. The sorted rows are written
    to the scratch space first: ranges are drawn from a sample, and a second look must
    find the same ones.
    """
    spark = rows.sparkSession
    ranges = int(spark.conf.get("spark.sql.shuffle.partitions"))
    order = report_order(report)
    dealt = rows.repartitionByRange(ranges, *order).sortWithinPartitions(*order)
    # Its upper bits are the number of the range, its lower 33 bits that of the row.
    numbered = dealt.withColumn("_at", F.monotonically_increasing_id())
    path = scratch_path(spark, "places")
    numbered.write.parquet(path)
    stored = spark.read.schema(numbered.schema).parquet(path)
    part = F.shiftright("_at", 33)
    before, offsets = 0, []
    for at, n in sorted(stored.groupBy(part.alias("at")).count().collect()):
        offsets.append((at, before))
        before += n
    known = F.broadcast(spark.createDataFrame(offsets, "_range long, _before long"))
    within = F.col("_at").bitwiseAND(F.lit((1 << 33) - 1))
    placed = stored.join(known, part == F.col("_range"))
    return placed.select(*rows.columns, (F.col("_before") + within + 1).alias("place"))
