"""Reports on hand-made sales."""

import pathlib
from decimal import Decimal

import pytest
from conftest import rows

from salesmill.operators.reports import (
    company_by,
    in_report_order,
    industry_by,
    industry_cube,
    industry_total,
    report_places,
    sales_summary,
)
from salesmill.schema import REPORTS, Report
from salesmill.sinks.report_files import write_report_csv, write_report_pipe, write_reports
from salesmill.sources.sales_table import append_summary
from salesmill.streaming.ingest import refresh_reports

SALES = (
    "company_name string, branch_code string, city string, product_line string,"
    " payment string, total decimal(12,5)"
)
DATA = [
    ("acme", "A", "Rome", "tea", "Cash", "10.00000"),
    ("acme", "A", "Rome", "tea", "Card", "5.50000"),
    ("acme", "B", "Oslo", "jam", "Cash", "-2.00000"),
    ("acme", "B", None, "jam", "Cash", None),
    ("zeta", "A", "Rome", "tea", "Cash", "1.00001"),
    ("zeta", "C", "Bern", 'a|b, "c"', "Cash", "7.00000"),
]


@pytest.fixture(scope="module")
def sales(spark):
    data = [(*r[:5], None if r[5] is None else Decimal(r[5])) for r in DATA]
    return spark.createDataFrame(data, SALES)


def lines(out, company, name):
    return pathlib.Path(out, company, name + "000").read_text().splitlines()


def test_company_report(sales):
    assert rows(company_by(sales, "acme", ["branch_code"]), "*") == [
        ("A", Decimal("15.50000")),
        ("B", Decimal("-2.00000")),
    ]


def test_unknown_company(sales):
    assert company_by(sales, "nobody", ["payment"]).count() == 0
    row = industry_total(sales, "nobody").first()
    assert row[0] is None and row[2] is None
    assert (row[1], row[3]) == (Decimal("21.50001"), 21.50001 / 5)


def test_empty_history(sales):
    assert rows(industry_total(sales.limit(0), "acme"), "*") == [(None,) * 4]


def test_industry_by_product(sales):
    found = {r.product_line: r for r in industry_by(sales, "acme", ["product_line"]).collect()}
    assert found["tea"].company_tot_sales == Decimal("15.50000")
    assert found["tea"].total_industry_sales == Decimal("16.50001")
    assert found["jam"].company_avg_sales == -2.0
    assert found['a|b, "c"'].company_tot_sales is None


def test_order(spark):
    data = [("b", 1), ("a", 1), (None, 1), ("c", None), ("d", 2)]
    df = spark.createDataFrame(data, "branch_code string, total_sales int")
    report = Report("x", ("branch_code",))
    got = [r.branch_code for r in in_report_order(df, report).collect()]
    assert got == ["c", "d", "a", "b", None]


def test_cube_equals_single_reports(sales):
    cube = industry_cube(sales_summary(sales), "acme")
    for report in REPORTS:
        if report.industry:
            bits = sum(b for c, b in [("product_line", 4), ("city", 2), ("payment", 1)]
                       if c not in report.keys)
            part = cube.filter(f"grouping_id = {bits}")
            single = industry_by(sales, "acme", report.keys)
            assert rows(part, *report.columns) == rows(single, *report.columns)


def test_comma_file(sales, tmp_path):
    df = company_by(sales, "zeta", ["product_line"])
    for _ in range(2):
        write_report_csv(df, str(tmp_path), "zeta", "Product_Sales.csv_")
    assert lines(tmp_path, "zeta", "Product_Sales.csv_") == [
        "product_line,total_sales",
        '"a|b, ""c""",7.00000',
        "tea,1.00001",
    ]
    assert [p.name for p in tmp_path.iterdir()] == ["zeta"]


def test_pipe_file(sales, tmp_path):
    df = industry_by(sales, "acme", ["product_line", "city"], exact=True)
    write_report_pipe(df, str(tmp_path), "acme", "Ind_Product_City_Sales.csv_")
    assert lines(tmp_path, "acme", "Ind_Product_City_Sales.csv_") == [
        "product_line|city|company_tot_sales|total_industry_sales|company_avg_sales"
        "|average_industry_sales",
        "jam|||||",
        "tea|Rome|15.50000|16.50001|7.75000|5.50000",
        'a|b, "c"|Bern||7.00000||7.00000',
        "jam|Oslo|-2.00000|-2.00000|-2.00000|-2.00000",
    ]


def test_all_files_of_all_companies(spark, sales, tmp_path):
    """Written together from two loads they equal those written one by one."""
    companies = ["zeta", "acme", "nobody"]
    many, single = str(tmp_path / "many"), str(tmp_path / "single")
    summary = str(tmp_path / "summary")
    append_summary(sales_summary(sales.filter("payment = 'Cash'")), summary, "1")
    append_summary(sales_summary(sales.filter("payment != 'Cash'")), summary, "2")
    refresh_reports(spark, summary, companies, many, str(tmp_path / "totals"))
    for company in companies:
        for report in REPORTS:
            if report.industry:
                df = industry_by(sales, company, report.keys, exact=True)
                write_report_pipe(df, single, company, report.file_name)
            else:
                df = company_by(sales, company, report.keys)
                write_report_csv(df, single, company, report.file_name)
            assert lines(many, company, report.file_name) == lines(
                single, company, report.file_name
            )
    assert lines(many, "nobody", "Branch_Sales.csv_") == ["branch_code,total_sales"]


def test_company_names_are_values(spark, sales, tmp_path):
    odd = "x' OR '1'='1"
    assert company_by(sales, odd, ["payment"]).count() == 0
    write_reports(sales_summary(sales), [odd], str(tmp_path))
    assert len(list((tmp_path / odd).glob("[!.]*"))) == len(REPORTS)


def test_places_over_many_ranges(spark):
    """Every range numbers its own rows; no task sees them all."""
    report = next(r for r in REPORTS if r.keys == ("product_line", "branch_code"))
    data = [(f"p{n % 50}", f"b{n // 50}", None if n % 97 == 0 else Decimal(n % 13)) for n in range(1000)]
    rows = spark.createDataFrame(data, "product_line string, branch_code string, total_sales decimal(22,5)")
    placed = report_places(rows.repartition(7), report)
    assert "SinglePartition" not in placed._jdf.queryExecution().executedPlan().toString()
    got = {r["place"]: (r["product_line"], r["branch_code"], r["total_sales"]) for r in placed.collect()}
    order = sorted(data, key=lambda r: (r[2] is not None, -(r[2] or 0), r[0], r[1]))
    assert [got[n + 1] for n in range(1000)] == order
    assert report_places(rows.limit(0), report).count() == 0
