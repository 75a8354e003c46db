"""Sources and sinks: CSV/Parquet round trips, params store, HTML."""

from pyspark.sql import functions as F

from lendwise.fixtures import loans, raw_loans, table
from lendwise.sources import files
from lendwise.sources.html import list_links, table_rows
from lendwise.sources.params import ParamStore


def test_csv_roundtrip_keeps_values(spark, sf):
    d = files.scratch_path(spark, "t-csv")
    raw = raw_loans(spark, sf).withColumn("Issue Date", F.col("Issue Date").cast("string"))
    files.write_csv(raw, d)
    back = files.read_csv(spark, d)
    want = loans(spark, sf).withColumn("issue_date", F.col("issue_date").cast("string"))
    assert back.columns[0] == "loan_id"
    assert back.select(*want.columns).exceptAll(want).count() == 0
    assert back.count() == want.count()


def test_params_store_latest_wins(spark):
    st = ParamStore.scratch(spark, "t")
    st.save({"a": 1.0, "b": "x"})
    st.save({"a": 2.0})
    assert st.load() == {"a": 2.0}
    assert st.get("missing") is None


def test_cached_or_compute_reuses(spark):
    d = files.scratch_path(spark, "t-cache")
    calls = []

    def compute():
        calls.append(1)
        return spark.range(5)
    assert files.cached_or_compute(spark, d, compute).count() == 5
    assert files.cached_or_compute(spark, d, compute).count() == 5
    assert len(calls) == 1


def test_html_table_and_links(spark, sf):
    html = ("<table><tbody><tr><td>Alabama</td><td>x</td><td> AL </td></tr>"
            "<tr><td>only</td></tr><tr class='r'><td>Texas</td><td>y</td><td>TX</td></tr></tbody></table>")
    pages = spark.createDataFrame([(1, html)], "page_id long, html string")
    rows = [(r["code"], r["name"]) for r in table_rows(pages).orderBy("row").collect()]
    assert rows == [("AL", "Alabama"), ("TX", "Texas")]
    links = list_links(table(spark, sf, "pages"))
    assert links.count() > 0 and links.where(F.col("href").isNull()).count() == 0
