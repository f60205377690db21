"""Reading, checking and typing drop files."""

import datetime
import pathlib
from decimal import Decimal

import pytest
from conftest import LINE, drop, line, rows, shuffled_rows
from pyspark.sql import functions as F

from salesmill.operators import sizes
from salesmill import read_drop, split_rejects, type_sales, validate_staged
from salesmill.operators.staging import REASON
from salesmill.schema import SALES_SCHEMA, STAGED_COLUMNS


def staged(spark, layout):
    return type_sales(validate_staged(read_drop(spark, layout.drop)), keep=(REASON, "file_path"))


def reasons(spark, layout):
    return [r[0] for r in rows(staged(spark, layout), REASON)]


def test_fields_are_kept_as_text(spark, layout):
    drop(layout, "g a+b", "1.csv", line(city="", gender=" F "), header=line())
    df = read_drop(spark, layout.drop)
    assert rows(df, "company_name", "field_count") == [("g a+b", 17)]
    row = df.select(STAGED_COLUMNS).first()
    assert row.asDict() == {**LINE, "city": "", "gender": " F "}


def test_header_only_and_other_files_give_no_rows(spark, layout):
    drop(layout, "acme", "1.csv")
    pathlib.Path(layout.drop, "acme", "notes.txt").write_text("a\nb\n")
    assert read_drop(spark, layout.drop).count() == 0


def test_types(spark, layout):
    drop(layout, "acme", "1.csv", line(total="-5.00"))
    df = type_sales(read_drop(spark, layout.drop))
    assert [(f.name, f.dataType) for f in df.schema] == [(f.name, f.dataType) for f in SALES_SCHEMA]
    row = df.first()
    assert (row.company_name, row.quantity, row.total) == ("acme", 7, Decimal("-5.00000"))
    assert (row.sales_date, row.sales_time) == (datetime.date(2019, 1, 5), "13:08")
    assert row.gross_margin_percentage == Decimal("4.761904762")


@pytest.mark.parametrize(
    ("bad", "reason"),
    [
        (line()[: -len(",9.1")], "field count"),
        (line() + ",x", "field count"),
        (line(city='"q,z"'), "field count"),
        (line() + "\x01x,y", "field count"),
        (line(invoice_id=""), "no invoice"),
        (line(invoice_id="1234567890123456"), "too wide: invoice_id"),
        (line(city="ééééééééx"), "too wide: city"),
        (line(total="1042.65000"), "too wide: total"),
        (line(sales_date="13/05/2019"), "not readable: sales_date"),
        (line(sales_date="2019-01-05"), "not readable: sales_date"),
        (line(quantity="7.5"), "not readable: quantity"),
        (line(unit_price=""), "not readable: unit_price"),
        (line(unit_price="16.2155"), "not readable: unit_price"),
        (line(rating="abc"), "not readable: rating"),
    ],
)
def test_bad_lines(spark, layout, bad, reason):
    drop(layout, "acme", "1.csv", bad)
    assert reasons(spark, layout) == [reason]


def test_good_lines(spark, layout):
    drop(layout, "acme", "1.csv", line(), line(total="-5.00"), line(city=""), line(tax=" 1.5"))
    assert reasons(spark, layout) == [None] * 4


@pytest.mark.parametrize("few_files", [True, False])
def test_a_bad_row_rejects_its_file_only(spark, layout, monkeypatch, few_files):
    if not few_files:
        monkeypatch.setattr(sizes, "BROADCAST_BYTES", -1)
    drop(layout, "acme", "1.csv", line(invoice_id="1"), line(invoice_id="2", quantity="x"))
    drop(layout, "acme", "2.csv", line(invoice_id="3"), line(invoice_id="4"))
    good, rejects = split_rejects(staged(spark, layout))
    assert rows(good, "invoice_id") == [("3",), ("4",)]
    assert rows(rejects, "invoice_id") == [("1",), ("2",)]
    assert rows(rejects.filter(F.col(REASON).isNotNull()), "invoice_id") == [("2",)]
    assert good.columns == rejects.columns == staged(spark, layout).columns


def test_rows_are_not_shuffled_to_meet_few_verdicts(spark, layout):
    for n in range(5):
        drop(layout, "acme", f"{n}.csv", *[line(quantity="x" if n == 3 else "1")] * 20)
    good, rejects = split_rejects(staged(spark, layout))
    assert good.count() == 80 and rejects.count() == 20
    assert [width for width, _ in shuffled_rows(good) if width > 2] == []
    assert [width for width, _ in shuffled_rows(rejects) if width > 2] == []
