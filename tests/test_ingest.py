"""Drop files to history, reports, archive and alerts."""

import gzip
import os
import pathlib

import pytest
from conftest import LINE, drop, line, rows, shuffled_rows

from salesmill import read_drop, run_ingest, sales_table
from salesmill.plans import standin
from salesmill.schema import REPORTS
from salesmill.sources.files import move_files
from salesmill.sources.totals import running_totals
from salesmill.streaming import ingest


def history(spark, layout):
    return rows(sales_table(spark, layout.history), "company_name", "invoice_id", "quantity")


def files(folder):
    return sorted(str(p.relative_to(folder)) for p in pathlib.Path(folder).rglob("*.csv"))


def test_load_dedup_reports_and_archive(spark, layout):
    drop(layout, "g a+b", "1.csv", line(invoice_id="1"), line(invoice_id="1"), line(invoice_id="2"))
    drop(layout, "007", "1.csv", line(invoice_id="1", quantity="3"))
    run_ingest(spark, layout)
    first = [("007", "1", 3), ("g a+b", "1", 7), ("g a+b", "1", 7), ("g a+b", "2", 7)]
    assert history(spark, layout) == first
    assert files(layout.drop) == [] and files(layout.claimed) == []
    archived = files(layout.archive)
    assert [f.split("_sales_")[0] for f in archived] == ["007/007", "g a+b/g a+b"]
    for company in ["007", "g a+b"]:
        reports = sorted(p.name for p in pathlib.Path(layout.reports, company).glob("[!.]*"))
        assert reports == sorted(r.file_name + "000" for r in REPORTS)
    assert pathlib.Path(layout.reports, "g a+b", "Branch_Sales.csv_000").read_text() == (
        "branch_code,total_sales\nA,1646.91450\n"
    )

    # The same name again, with an old and a new invoice; nothing for 007.
    drop(layout, "g a+b", "1.csv", line(invoice_id="2"), line(invoice_id="3"))
    run_ingest(spark, layout)
    assert history(spark, layout) == [*first, ("g a+b", "3", 7)]
    assert len(files(layout.archive)) == 3

    # A file that is known altogether, and a run without files.
    drop(layout, "g a+b", "2.csv", line(invoice_id="2"), line(invoice_id="3"))
    run_ingest(spark, layout)
    run_ingest(spark, layout)
    assert history(spark, layout) == [*first, ("g a+b", "3", 7)]
    sums, industry = running_totals(spark, layout.summary, layout.totals)
    assert [t.groupBy().sum("n_sales").first()[0] for t in (sums, industry)] == [5, 5]

    # A file without sales renews the reports of its company.
    report = pathlib.Path(layout.reports, "007", "Avg_Industry_Sales.csv_000")
    before = report.read_text()
    drop(layout, "007", "none.csv")
    run_ingest(spark, layout)
    assert report.read_text() != before
    assert len(files(layout.archive)) == 5


def test_files_of_one_load(spark, layout):
    """Reject first, then the earlier file wins; other companies do not matter."""
    drop(layout, "a", "1-bad.csv", line(invoice_id="1", quantity="1"), line(quantity="x"))
    drop(layout, "a", "2.csv", line(invoice_id="1", quantity="2"), line(invoice_id="5"))
    drop(layout, "a", "3.csv", line(invoice_id="1", quantity="3"), line(invoice_id="6"))
    drop(layout, "b", "4.csv", line(invoice_id="1", quantity="4"))
    drop(layout, "b", "5-empty.csv")
    for n, name in enumerate(["a/1-bad.csv", "a/2.csv", "a/3.csv", "b/4.csv"]):
        os.utime(pathlib.Path(layout.drop, name), (1000 + n, 1000 + n))
    run_ingest(spark, layout)
    assert history(spark, layout) == [("a", "1", 2), ("a", "5", 7), ("a", "6", 7), ("b", "1", 4)]
    assert len(files(layout.archive)) == 4
    assert [f.split("/", 1)[1] for f in files(layout.rejected)] == ["a/1-bad.csv"]
    alert = spark.read.parquet(layout.alerts).first()
    assert (alert.company, alert.file) == ("a", "a/1-bad.csv")
    assert alert.error_message == "not readable: quantity (1 bad rows)"


def test_arrival_decides_and_loads_may_be_cut(spark, layout):
    """One file per load: the later load finds the earlier one in the history."""
    drop(layout, "a", "1.csv", line(invoice_id="1", quantity="1"))
    drop(layout, "a", "2.csv", line(invoice_id="1", quantity="2"), line(invoice_id="2"))
    os.utime(pathlib.Path(layout.drop, "a/1.csv"), (2000, 2000))
    os.utime(pathlib.Path(layout.drop, "a/2.csv"), (1000, 1000))
    run_ingest(spark, layout, max_files=1)
    assert history(spark, layout) == [("a", "1", 2), ("a", "2", 7)]


@pytest.fixture
def waiting(spark, layout):
    drop(layout, "a", "1.csv", line(invoice_id="1"), line(invoice_id="1"), line(invoice_id="2"))
    drop(layout, "b", "_1.csv", line(invoice_id="1"))
    ingest.claim_drops(spark, layout)
    batch = read_drop(spark, layout.claimed, level=1)
    return batch.withColumn("company_name", batch.company_name.substr(4, 100))


def test_repeated_load_before_the_list_is_written(spark, layout, waiting, monkeypatch):
    """The first try dies after the append; the second finds its own rows."""

    def fail(*_):
        raise RuntimeError("lost")

    with monkeypatch.context() as patched:
        patched.setattr(ingest, "write_text", fail)
        with pytest.raises(RuntimeError):
            ingest.load_batch(waiting, "x-1", layout)
    ingest.load_batch(waiting, "x-1", layout)
    assert history(spark, layout) == [("a", "1", 7), ("a", "1", 7), ("a", "2", 7), ("b", "1", 7)]
    assert len(files(layout.archive)) == 2


def test_repeated_load_while_archiving(spark, layout, waiting, monkeypatch):
    """The first try dies with one file moved, so its rows cannot be read again."""

    def half(spark, loaded):
        move_files(spark, [(f.source, f.target) for f in loaded[:1]])
        raise RuntimeError("lost")

    with monkeypatch.context() as patched:
        patched.setattr(ingest, "archive_consumed", half)
        with pytest.raises(RuntimeError):
            ingest.load_batch(waiting, "x-1", layout)
    before = history(spark, layout)
    ingest.load_batch(waiting, "x-1", layout)
    assert history(spark, layout) == before and len(before) == 4
    assert len(files(layout.archive)) == 2 and files(layout.claimed) == []


def test_scan_of_some_companies(spark, layout):
    for company in ["a", "b=c", "d%e"]:
        drop(layout, company, "1.csv", line(invoice_id=company))
    run_ingest(spark, layout, reports=False)
    found = sales_table(spark, layout.history, ["b=c", "d%e", "nobody"])
    assert rows(found, "company_name", "invoice_id") == [("b=c", "b=c"), ("d%e", "d%e")]
    assert sales_table(spark, layout.history, ["nobody"]).count() == 0
    one = sales_table(spark, layout.history).filter("company_name = 'a'")
    assert "PartitionFilters: [isnotnull(company_name" in one._jdf.queryExecution().toString()


@pytest.mark.parametrize("step,job", [("_append", "load"), ("refresh_reports", "reports")])
def test_a_failed_job_leaves_an_alert(spark, layout, monkeypatch, step, job):
    drop(layout, "acme", "1.csv", line(invoice_id="1"))

    def fail(*_):
        raise ValueError(f"no {step}")

    with monkeypatch.context() as m:
        m.setattr(ingest, step, fail)
        with pytest.raises(Exception, match=f"no {step}"):
            run_ingest(spark, layout)
    (alert,) = spark.read.parquet(layout.alerts).collect()
    assert (alert["job"], alert["error_type"], alert["error_message"]) == (job, "ValueError", f"no {step}")
    assert (alert["company"], alert["file"]) == ("acme", "acme/1.csv")
    assert "Traceback" in alert["stack_trace"]
    run_ingest(spark, layout)
    assert history(spark, layout) == [("acme", "1", 7)]


@pytest.mark.parametrize(
    "step,job,company",
    [("claim_drops", "claim", None), ("_archive_empty", "archive", None), ("refresh_reports", "reports", "none")],
)
def test_a_step_outside_a_load_leaves_an_alert(spark, layout, monkeypatch, step, job, company):
    """Half a surrogate pair in the message does not hinder the alert."""
    drop(layout, "none", "empty.csv")

    def fail(*_):
        raise ValueError("bad \ud800 text")

    with monkeypatch.context() as m:
        m.setattr(ingest, step, fail)
        with pytest.raises(ValueError):
            run_ingest(spark, layout)
    (alert,) = spark.read.parquet(layout.alerts).collect()
    assert (alert["job"], alert["company"], alert["file"]) == (job, company, None)
    assert (alert["error_type"], alert["error_message"]) == ("ValueError", "bad ? text")
    run_ingest(spark, layout)
    assert files(layout.claimed) == [] and os.listdir(layout.claimed) == []


def test_claims_are_bounded_and_leave_nothing(spark, layout, monkeypatch):
    """Seven files, two a round, oldest first; numbers go on after the counter."""
    for n in range(7):
        drop(layout, "a", f"{n}.csv", line(invoice_id="1" if n % 2 else str(n), quantity=str(n)))
        os.utime(pathlib.Path(layout.drop, f"a/{n}.csv"), (1000 - n, 1000 - n))
    rounds = []
    claim = ingest.claim_drops
    monkeypatch.setattr(ingest, "claim_drops", lambda *a: rounds.append(claim(*a)) or rounds[-1])
    run_ingest(spark, layout, reports=False, claim_files=2)
    assert rounds == [2, 2, 2, 1, 0]
    # The files came in falling order, so the highest odd one was the first to name invoice 1.
    assert history(spark, layout) == [("a", "0", 0), ("a", "1", 5), ("a", "2", 2), ("a", "4", 4), ("a", "6", 6)]
    assert os.listdir(layout.claimed) == [] and len(files(layout.archive)) == 7
    counter = int(pathlib.Path(layout.counter).read_text())
    drop(layout, "a", "next.csv", line(invoice_id="9"))
    assert ingest.claim_drops(spark, layout) == 1
    assert os.listdir(layout.claimed) == [f"{counter:015d}"]


def test_claims_of_a_crashed_run_are_loaded_first(spark, layout, monkeypatch):
    drop(layout, "a", "1.csv", line(invoice_id="1"))
    drop(layout, "a", "empty.csv")
    ingest.claim_drops(spark, layout)
    pathlib.Path(layout.claimed, "000000000000007", "in-a").mkdir(parents=True)
    drop(layout, "a", "2.csv", line(invoice_id="1", quantity="9"), line(invoice_id="2"))
    run_ingest(spark, layout, claim_files=1)
    assert history(spark, layout) == [("a", "1", 7), ("a", "2", 7)]
    assert os.listdir(layout.claimed) == [] and len(files(layout.archive)) == 3


def test_many_loads_of_one_company(spark, layout):
    """Folders stay few, totals and filters follow, and every invoice is still known."""
    limits = {"at_least": 4, "below": 1 << 30}
    for n in range(9):
        drop(layout, "a", "1.csv", line(invoice_id=str(n)), line(invoice_id=str(n + 1)))
        run_ingest(spark, layout, reports=n == 8, merge=limits)
    expected = sorted([("a", str(n), 7) for n in range(10)])
    assert history(spark, layout) == expected
    loads = os.listdir(pathlib.Path(layout.history, "company_name=a"))
    assert len([f for f in loads if f.startswith("batch_id=")]) < 5
    filters = os.listdir(pathlib.Path(layout.filters, "company_name=a"))
    assert len([f for f in filters if f.startswith("batch_id=")]) < 5
    assert sales_table(spark, layout.history).select("batch_id").distinct().count() == 9
    sums, _ = running_totals(spark, layout.summary, layout.totals)
    assert sums.groupBy().sum("n_sales").first()[0] == 10


def test_large_loads_ask_the_filters(spark, layout, monkeypatch):
    """No load is small here, so each asks the filters before the history."""
    from salesmill.operators import sizes

    monkeypatch.setattr(sizes, "BROADCAST_BYTES", -1)
    for n in range(3):
        drop(layout, "a", "1.csv", *(line(invoice_id=str(i)) for i in range(n * 20, n * 20 + 40)))
        drop(layout, "b", "1.csv", *(line(invoice_id=str(i)) for i in range(5)))
        run_ingest(spark, layout, reports=False)
    found = [("a", str(i), 7) for i in range(80)] + [("b", str(i), 7) for i in range(5)]
    assert history(spark, layout) == sorted(found, key=repr)


def test_gzipped_files(spark, layout):
    """Loaded as others are, archived or rejected as they came."""
    for name, quantity in (("1.csv", "2"), ("2.csv", "x")):
        drop(layout, "a", name, line(invoice_id=name, quantity=quantity))
        plain = pathlib.Path(layout.drop, "a", name)
        pathlib.Path(f"{plain}.gz").write_bytes(gzip.compress(plain.read_bytes()))
        plain.unlink()
    drop(layout, "a", "3.csv", line(invoice_id="3"))
    run_ingest(spark, layout)
    assert history(spark, layout) == [("a", "1.csv", 2), ("a", "3", 7)]
    assert len(files(layout.archive)) == 1 and not files(layout.rejected)
    assert len([*pathlib.Path(layout.archive).rglob("*.csv.gz")]) == 1
    assert [p.name for p in pathlib.Path(layout.rejected).rglob("*.csv.gz")] == ["2.csv.gz"]


def test_a_large_load_is_written_as_it_was_read(spark, layout, monkeypatch):
    spreads = []

    def watched(rows, table, batch_id, spread=True):
        spreads.append(spread)
        append_sales(rows, table, batch_id, spread)

    append_sales = ingest.append_sales
    monkeypatch.setattr(ingest, "append_sales", watched)
    monkeypatch.setattr(ingest, "UNSPREAD_ROWS", 3)
    drop(layout, "a", "1.csv", *(line(invoice_id=str(i)) for i in range(5)))
    drop(layout, "b", "1.csv", line(invoice_id="1"))
    run_ingest(spark, layout)
    drop(layout, "a", "2.csv", *(line(invoice_id=str(i)) for i in range(4, 6)))
    run_ingest(spark, layout)
    assert spreads == [False, True]
    assert history(spark, layout) == [*(("a", str(i), 7) for i in range(6)), ("b", "1", 7)]


def test_stand_in_files_shuffle_a_row_once_as_a_line(spark, tmp_path, monkeypatch):
    made = [{**LINE, "company_name": c, "invoice_id": f"{o}-{n}"} for c in "ab" for o in range(20) for n in (1, 2, 3)]
    frame = spark.createDataFrame(made).select("company_name", *LINE)
    seen, write = [], standin._write_lines

    def watched(rows, *args):
        seen.append(shuffled_rows(rows))
        write(rows, *args)

    monkeypatch.setattr(standin, "_write_lines", watched)
    monkeypatch.setattr(standin, "CONTESTED_SALES", 40)
    standin.write_drop_files(frame, f"{tmp_path}/drop", f"{tmp_path}/s0")
    standin.write_contested_files(frame, f"{tmp_path}/more", f"{tmp_path}/s1")
    assert seen[0] == [(3, 120)]
    assert [n for width, n in seen[1] if width > 4] == [120]
    dropped = standin_rows(spark, f"{tmp_path}/drop")
    assert dropped == sorted((r["company_name"], r["invoice_id"], "7") for r in made)
    parts = {p: standin_rows(spark, f"{tmp_path}/more", f"{p}-*.csv.gz") for p in range(3)}
    odd = [not i.endswith("-2") for _, i, _ in dropped]
    assert parts[0] == [r for r, o in zip(dropped, odd) if not o]
    assert parts[2] == [r if o else (*r[:2], "107") for r, o in zip(dropped, odd)]
    assert [r[:2] for r in parts[1]] == [r[:2] for r, o in zip(dropped, odd) if o]
    for file in pathlib.Path(tmp_path, "more").rglob("1-*.csv.gz"):
        assert gzip.decompress(file.read_bytes()).count(b",many,") == 1


def standin_rows(spark, folder, pattern="*.csv.gz"):
    """Company, invoice and quantity of the files of a folder."""
    found = []
    for file in pathlib.Path(folder).rglob(pattern):
        head, *lines = gzip.decompress(file.read_bytes()).decode().splitlines()
        assert head == ",".join(LINE)
        fields = [dict(zip(LINE, text.split(","), strict=True)) for text in lines]
        found += [(file.parent.name, f["invoice_id"], f["quantity"]) for f in fields]
    return sorted(found)


def test_claims_are_bounded_in_bytes(spark, layout, monkeypatch):
    """Oldest first, gzipped bytes count for more, and a file too large is claimed alone."""
    monkeypatch.setattr(ingest, "GZIP_RATIO", 1000)
    lines = [line(invoice_id=str(n)) for n in range(3)]
    for n in range(6):
        drop(layout, "a", f"{n}.csv", *lines, line(invoice_id=f"own {n}"))
    plain = pathlib.Path(layout.drop, "a", "3.csv")
    pathlib.Path(f"{plain}.gz").write_bytes(gzip.compress(plain.read_bytes()))
    plain.unlink()
    for n, path in enumerate(sorted(pathlib.Path(layout.drop, "a").iterdir())):
        os.utime(path, (1000 + n, 1000 + n))
    size = pathlib.Path(layout.drop, "a", "0.csv").stat().st_size
    rounds = []
    claim = ingest.claim_drops
    monkeypatch.setattr(ingest, "claim_drops", lambda *a: rounds.append(claim(*a)) or rounds[-1])
    run_ingest(spark, layout, reports=False, claim_bytes=2 * size)
    assert rounds == [2, 1, 1, 2, 0]
    assert history(spark, layout) == [*(("a", str(n), 7) for n in range(3)), *(("a", f"own {n}", 7) for n in range(6))]
    assert sales_table(spark, layout.history).select("batch_id").distinct().count() == 4


@pytest.mark.parametrize("broadcast_bytes", [-1, None])
def test_a_load_leaves_nothing_persisted(spark, layout, monkeypatch, broadcast_bytes):
    from salesmill.operators import sizes

    if broadcast_bytes is not None:
        monkeypatch.setattr(sizes, "BROADCAST_BYTES", broadcast_bytes)
    monkeypatch.setattr(ingest, "UNSPREAD_ROWS", 1)
    writers = spark.conf.get("spark.sql.maxConcurrentOutputFileWriters")
    before = set(spark.sparkContext._jsc.getPersistentRDDs().keySet())
    for n in range(2):
        drop(layout, "a", "1.csv", *(line(invoice_id=str(i)) for i in range(n * 5, n * 5 + 10)))
        drop(layout, "a", "2.csv", *(line(invoice_id=str(i)) for i in range(n * 5 + 8, n * 5 + 12)))
        run_ingest(spark, layout, reports=False)
    assert set(spark.sparkContext._jsc.getPersistentRDDs().keySet()) <= before
    assert spark.conf.get("spark.sql.maxConcurrentOutputFileWriters") == writers
    assert history(spark, layout) == sorted((("a", str(n), 7) for n in range(17)), key=repr)


def test_rows_that_are_not_spread_are_not_sorted(spark, tmp_path, monkeypatch):
    """A task keeps a file open for each company instead of sorting by company."""
    from salesmill.sources import sales_table as stored

    seen, replace = [], stored._replace

    def watched(*args):
        seen.append(spark.conf.get("spark.sql.maxConcurrentOutputFileWriters"))
        replace(*args)

    monkeypatch.setattr(stored, "_replace", watched)
    before = spark.conf.get("spark.sql.maxConcurrentOutputFileWriters")
    made = [(f"{n}", c, "load") for n in range(50) for c in "abc"]
    frame = spark.createDataFrame(made, "invoice_id string, company_name string, batch_id string").coalesce(2)
    for spread in (False, True):
        stored._replace_load(frame, f"{tmp_path}/{spread}", spread)
        assert rows(spark.read.parquet(f"{tmp_path}/{spread}"), "invoice_id") == sorted((n,) for n, *_ in made)
    assert seen == [str(stored.OPEN_FOLDERS), before]
    assert spark.conf.get("spark.sql.maxConcurrentOutputFileWriters") == before


def test_lines_of_the_stand_in_are_not_shuffled_for_suppliers(spark, tmp_path):
    tables = {
        "region": "SELECT 1 AS r_regionkey, 'AFRICA' AS r_name",
        "nation": "SELECT 2 AS n_nationkey, 'KENYA' AS n_name, 1 AS n_regionkey",
        "supplier": "SELECT id AS s_suppkey, 2 AS s_nationkey FROM range(20)",
        "customer": "SELECT id AS c_custkey, 'BUILDING' AS c_mktsegment FROM range(5)",
        "part": "SELECT id AS p_partkey, 'SMALL' AS p_type, 1.5D AS p_retailprice, 3 AS p_size FROM range(30)",
        "orders": "SELECT id AS o_orderkey, id % 5 AS o_custkey, 'O' AS o_orderstatus, '5-LOW' AS o_orderpriority FROM range(60)",
        "lineitem": """SELECT id % 60 AS l_orderkey, id % 30 AS l_partkey, id % 20 AS l_suppkey,
            CAST(id % 7 AS INT) AS l_linenumber, 2D AS l_quantity, 10D AS l_extendedprice, 0.1D AS l_discount,
            0.05D AS l_tax, 'A' AS l_returnflag, 'F' AS l_linestatus, timestamp'2001-01-01' AS l_shipdate FROM range(420)""",
    }
    for name, text in tables.items():
        spark.sql(text).write.parquet(f"{tmp_path}/{name}.parquet")
    before = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", -1)
    try:
        sales = standin.sales_view(spark, str(tmp_path))
        assert [n for _, n in shuffled_rows(sales)].count(420) == 2
        assert sales.count() == 420
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", before)
