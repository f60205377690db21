import pathlib
import sys

import pytest

sys.path.insert(0, str(pathlib.Path(__file__).resolve().parents[1]))

from salesmill.session import local_session  # noqa: E402
from salesmill.streaming.ingest import Layout  # noqa: E402

LINE = {
    "invoice_id": "750-67-8428",
    "branch_code": "A",
    "city": "Yangon",
    "customer_type": "Member",
    "gender": "Female",
    "product_line": "Health and beauty",
    "unit_price": "74.69",
    "quantity": "7",
    "tax": "26.1415",
    "total": "548.9715",
    "sales_date": "1/5/2019",
    "sales_time": "13:08",
    "payment": "Ewallet",
    "cogs": "522.83",
    "gross_margin_percentage": "4.761904762",
    "gross_income": "26.1415",
    "rating": "9.1",
}


@pytest.fixture(scope="session")
def spark():
    return local_session(8)


@pytest.fixture
def layout(tmp_path):
    return Layout.under(str(tmp_path))


def line(**changes):
    """One line of a drop file."""
    return ",".join({**LINE, **changes}.values())


def drop(layout, company, name, *lines, header="any header"):
    folder = pathlib.Path(layout.drop, company)
    folder.mkdir(parents=True, exist_ok=True)
    folder.joinpath(name).write_text("\n".join([header, *lines]) + "\n")


def rows(df, *columns):
    """Rows as sorted tuples."""
    return sorted((tuple(r) for r in df.select(*columns).collect()), key=repr)


def shuffled_rows(df):
    """Columns and rows written of each shuffle of a frame, which is run."""
    df.collect()
    found = []

    def walk(node):
        name = node.getClass().getSimpleName()
        if name == "AdaptiveSparkPlanExec":
            return walk(node.executedPlan())
        if name == "ShuffleExchangeExec":
            written = node.metrics().apply("shuffleRecordsWritten").value()
            found.append((node.output().size(), written))
        if name in ("ShuffleQueryStageExec", "BroadcastQueryStageExec", "ResultQueryStageExec"):
            return walk(node.plan())
        if name == "InputAdapter" or name == "WholeStageCodegenExec":
            return walk(node.child())
        children = node.children()
        for i in range(children.size()):
            walk(children.apply(i))

    walk(df._jdf.queryExecution().executedPlan())
    return found
