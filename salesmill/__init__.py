"""Multi-company sales: ingest of drop files, history and reports on Spark."""

from salesmill.operators.alerts import alert_text, failure_alerts, parse_fanout, parse_load_events
from salesmill.operators.dedup import first_file_wins, fresh_sales, not_in_history, not_in_strict
from salesmill.operators.reports import (
    company_by,
    for_company,
    in_report_order,
    industry_by,
    industry_cube,
    industry_total,
    report_places,
    sales_summary,
)
from salesmill.operators.staging import split_rejects, validate_staged
from salesmill.operators.typing import type_sales
from salesmill.sinks.alert_table import alert_table
from salesmill.sinks.report_files import write_report_csv, write_report_pipe, write_reports
from salesmill.sources.drop_files import read_drop
from salesmill.sources.sales_table import (
    append_sales,
    build_filters,
    merge_filters,
    merge_history,
    sales_table,
)
from salesmill.sources.totals import fold_totals, running_totals
from salesmill.streaming.event_log import run_alerts, start_alerts
from salesmill.streaming.ingest import (
    Layout,
    archive_consumed,
    refresh_reports,
    run_ingest,
    start_ingest,
)

__all__ = [
    "Layout",
    "alert_table",
    "alert_text",
    "append_sales",
    "archive_consumed",
    "build_filters",
    "company_by",
    "failure_alerts",
    "first_file_wins",
    "fold_totals",
    "for_company",
    "fresh_sales",
    "in_report_order",
    "industry_by",
    "industry_cube",
    "industry_total",
    "merge_filters",
    "merge_history",
    "not_in_history",
    "not_in_strict",
    "parse_fanout",
    "parse_load_events",
    "read_drop",
    "refresh_reports",
    "report_places",
    "run_alerts",
    "run_ingest",
    "running_totals",
    "sales_summary",
    "sales_table",
    "split_rejects",
    "start_alerts",
    "start_ingest",
    "type_sales",
    "validate_staged",
    "write_report_csv",
    "write_report_pipe",
    "write_reports",
]
