"""Raw CSV -> stored tables -> reports -> CSV and back."""

from __future__ import annotations

import csv
from pathlib import Path

import pytest
from pyspark.sql import functions as F

from tests.fixture_data import fixture_rows
from tests.test_fixture import rows
from tillwise import __main__ as command_line
from tillwise import schemas
from tillwise.config import AnalyticsConfig
from tillwise.plans import pipeline
from tillwise.plans.pipeline import build_tables, run_reports
from tillwise.plans.reports import CATALOG
from tillwise.sources.raw_csv import read_raw_csv
from tillwise.sources.reports import read_report
from tillwise.sources.staging import release, stage, staging_folder
from tillwise.sources.tables import drop_old_versions, read_audit, read_table, read_tables

HEADER = ["Invoice", "StockCode", "Description", "Quantity", "InvoiceDate", "Price",
          "Customer ID", "Country"]
CONFIG = AnalyticsConfig()


def write_feed(path: Path, lines: list[tuple]) -> str:
    with open(path, "w", encoding="latin-1", newline="") as f:
        writer = csv.writer(f)
        writer.writerow(HEADER)
        for row in lines:
            writer.writerow(["" if cell is None else cell for cell in row])
    return str(path)


@pytest.fixture(scope="module")
def feed(tmp_path_factory):
    return write_feed(tmp_path_factory.mktemp("feed") / "lines.csv", fixture_rows())


@pytest.fixture(scope="module")
def folder(spark, feed, tmp_path_factory):
    out = str(tmp_path_factory.mktemp("tables"))
    build_tables(read_raw_csv(spark, feed), out, CONFIG)
    return out


def test_csv_reads_by_position_with_contract_types(spark, feed):
    raw = read_raw_csv(spark, feed)
    assert raw.dtypes == [(f.name, f.dataType.simpleString()) for f in schemas.RAW]
    assert sorted(map(repr, rows(raw))) == sorted(map(repr, fixture_rows()))


def test_csv_details(spark, tmp_path):
    path = tmp_path / "odd.csv"
    path.write_bytes(
        b"a,b,c,d,e,f,g,h\r\n"
        b'1,22,"POT ""BLUE"", \xa3 5",3,2010-01-01 00:05:00,2.5,17850.0,Caf\xe9\r\n'
        b"2,NA,,1,2010-01-01 00:06:00,1e2,nan,N/A\r\n"
        b"\r\n"
    )
    first, second = read_raw_csv(spark, str(path)).collect()
    assert first.description == 'POT "BLUE", £ 5'
    assert (first.country, first.customer_id, first.quantity) == ("Café", 17850.0, 3)
    assert (second.stock_code, second.description, second.country) == (None, None, None)
    assert (second.price, second.customer_id) == (100.0, None)


def feed_of(tmp_path, *lines: str) -> str:
    path = tmp_path / "feed.csv"
    path.write_text("\n".join(["a,b,c,d,e,f,g,h", *lines]) + "\n")
    return str(path)


GOOD = "1,2,x,3,2010-01-01 00:05:00,2.5,1,UK"


@pytest.mark.parametrize("ansi", ["true", "false"])
@pytest.mark.parametrize(
    ("line", "message"),
    [
        ("1,2,x,three,2010-01-01 00:05:00,2.5,1,UK", "quantity does not parse: three"),
        ("1,2,x,3.5,2010-01-01 00:05:00,2.5,1,UK", "quantity does not parse: 3.5"),
        ("1,2,x,3,someday,2.5,1,UK", "invoice_date does not parse: someday"),
        ("1,2,x,3,2010-01-01 00:05:00,2.5,one,UK", "customer_id does not parse: one"),
        (GOOD + ",more", "line with more than 8 cells: .*more"),
        (GOOD + ",", "line with more than 8 cells"),
        (GOOD + ",a,b", "line with more than 8 cells"),
    ],
)
def test_csv_rejects_what_it_cannot_hold(spark, tmp_path, line, message, ansi):
    spark.conf.set("spark.sql.ansi.enabled", ansi)
    try:
        with pytest.raises(Exception, match=message):
            read_raw_csv(spark, feed_of(tmp_path, GOOD, line)).collect()
    finally:
        spark.conf.unset("spark.sql.ansi.enabled")


def test_csv_counts_cells_whatever_is_read(spark, tmp_path):
    raw = read_raw_csv(spark, feed_of(tmp_path, GOOD, GOOD + ",more"))
    with pytest.raises(Exception, match="more than 8 cells"):
        raw.select("invoice").collect()


def test_csv_short_lines_and_decimals(spark, tmp_path):
    line = '1,2,"a, ""b""",4.0,2010-01-01 00:05:00,2.5,1,UK'
    whole, short = read_raw_csv(spark, feed_of(tmp_path, line, "1,2,x,3")).collect()
    assert (whole.quantity, whole.description) == (4, 'a, "b"')
    assert tuple(short) == ("1", "2", "x", 3, None, None, None, None)


def test_csv_line_breaks_in_quotes(spark, tmp_path):
    broken = '1,2,"two\nlines",3,2010-01-01 00:05:00,2.5,1,UK'
    feed = feed_of(tmp_path, GOOD, broken)
    with pytest.raises(Exception, match="multi_line"):
        read_raw_csv(spark, feed).collect()
    assert [r.description for r in read_raw_csv(spark, feed, multi_line=True).collect()] == [
        "x", "two\nlines",
    ]


def test_csv_timestamp_format(spark, tmp_path):
    path = tmp_path / "slashes.csv"
    path.write_text("a,b,c,d,e,f,g,h\n1,2,x,3,12/1/2010 8:26,2.5,1,UK\n")
    row = read_raw_csv(spark, str(path), timestamp_format="M/d/yyyy H:mm").first()
    assert row.invoice_date.isoformat() == "2010-12-01T08:26:00"


def test_tables_are_stored_with_their_contract(spark, folder):
    tables = read_tables(spark, folder)
    counts = {name: getattr(tables, name).count() for name in schemas.TABLES}
    assert counts == {
        "transactions": 10,
        "anonymous_tx": 2,
        "cancellations": 2,
        "orders": 8,
        "customers": 4,
    }
    for name, schema in schemas.TABLES.items():
        assert getattr(tables, name).columns == schema.names


def test_one_line_table_reads_only_its_files(spark, folder):
    plan = read_table(spark, folder, "cancellations")._jdf.queryExecution().toString()
    assert "PartitionFilters: [isnotnull(line_class" in plan
    files = read_table(spark, folder, "cancellations").inputFiles()
    assert files


def test_build_replaces_what_is_there(spark, feed, folder):
    build_tables(read_raw_csv(spark, feed), folder, CONFIG)
    assert read_table(spark, folder, "transactions").count() == 10


def test_replace_leaves_no_old_lines(spark, feed, tmp_path):
    out = str(tmp_path)
    spark.conf.set("spark.sql.sources.partitionOverwriteMode", "dynamic")
    try:
        raw = read_raw_csv(spark, feed)
        assert build_tables(raw, out, CONFIG).cancellations.count() == 2
        tables = build_tables(raw.filter("invoice not like 'C%'"), out, CONFIG)
    finally:
        spark.conf.unset("spark.sql.sources.partitionOverwriteMode")
    assert tables.cancellations.count() == 0
    assert tables.customers.filter("had_return = 1").count() == 0
    drop_old_versions(spark, out)
    assert len(list(tmp_path.glob("tables-*"))) == 1 and read_tables(spark, out).orders.count() == 8


def test_a_failed_build_leaves_the_old_tables(spark, feed, tmp_path):
    out = str(tmp_path)
    raw = read_raw_csv(spark, feed)
    build_tables(raw, out, CONFIG)
    broken = raw.withColumn("price", F.when(F.col("invoice") == "500003", F.raise_error(F.lit("no"))).otherwise(F.col("price")))
    with pytest.raises(Exception, match="no"):
        build_tables(broken, out, CONFIG)
    assert read_tables(spark, out).orders.count() == 8


def test_missing_staging_folder_is_noticed_first(spark, feed, tmp_path, monkeypatch):
    def refuse(_):
        raise ValueError("set spark.checkpoint.dir")

    monkeypatch.setattr(pipeline, "staging_folder", refuse)
    with pytest.raises(ValueError, match="spark.checkpoint.dir"):
        build_tables(read_raw_csv(spark, feed), str(tmp_path / "t"), CONFIG)
    assert not (tmp_path / "t").exists()


def test_build_cleans_its_staging_and_keeps_an_audit(spark, feed, tmp_path):
    staging = tmp_path / "staging"
    build_tables(read_raw_csv(spark, feed), str(tmp_path / "t"), CONFIG, str(staging))
    assert staging.exists() and not list(staging.iterdir())
    assert dict(rows(read_audit(spark, str(tmp_path / "t")))) == {
        "raw_rows": 17.0,
        "identified_rows": 15.0,
        "anonymous_rows": 2.0,
        "transaction_rows": 10.0,
        "cancellation_rows": 2.0,
        "order_rows": 8.0,
        "customers": 4.0,
        "churn_pct": 75.0,
    }


def test_views_answer_sql(spark, folder):
    read_tables(spark, folder).register_views()
    found = spark.sql(
        "SELECT rfm_tier, COUNT(*) AS n FROM customers GROUP BY rfm_tier ORDER BY rfm_tier"
    )
    assert rows(found) == [("At Risk", 1), ("Lost", 2), ("New", 1)]


def test_reports_round_trip(spark, folder, tmp_path):
    tables = read_tables(spark, folder)
    written = run_reports(tables, str(tmp_path), CONFIG)
    assert list(written) == sorted(CATALOG)
    for name, schema in schemas.REPORTS.items():
        report = CATALOG[name](tables, CONFIG)
        assert report.dtypes == [(f.name, f.dataType.simpleString()) for f in schema]
        back = read_report(spark, str(tmp_path), name)
        assert back.storageLevel.useMemory
        assert rows(back) == rows(report)
        assert written[name] == back.count()
        back.unpersist()
        (file,) = (tmp_path / name).glob("*.csv")
        assert file.read_text().splitlines()[0] == ",".join(schema.names)


def test_runs_can_be_repeated(spark, folder, tmp_path):
    tables = read_tables(spark, folder)
    assert run_reports(tables, str(tmp_path), CONFIG) == run_reports(
        tables, str(tmp_path), CONFIG
    )


def test_command_line(spark, feed, tmp_path, capsys):
    tables, out = str(tmp_path / "tables"), str(tmp_path / "reports")
    command_line.main(["build", "--raw", feed, "--tables", tables])
    assert "transaction_rows: 10" in capsys.readouterr().out
    command_line.main(["report", "--tables", tables, "--out", out])
    assert "cohort_retention: 5 rows" in capsys.readouterr().out
    command_line.main(["kpis", "--tables", tables, "--min-cohort", "1"])
    assert "peak_weekly_customers" in capsys.readouterr().out


def test_staging_uses_the_named_folder(spark, checkpoint_folder):
    assert staging_folder(spark) == checkpoint_folder
    before = set(Path(checkpoint_folder).iterdir())
    staged = stage(spark.range(5).withColumn("twice", F.col("id") * 2), "numbers")
    assert staged.agg(F.sum("twice")).first()[0] == 20
    (written,) = set(Path(checkpoint_folder).iterdir()) - before
    assert written.name.startswith("numbers-")
    release(spark)
    assert set(Path(checkpoint_folder).iterdir()) <= before


class SessionWith:
    """Just the settings of a session."""

    def __init__(self, **settings):
        self.conf = self
        self.settings = {key.replace("_", "."): value for key, value in settings.items()}

    def get(self, key, default=None):
        return self.settings.get(key, default)


def test_staging_falls_back_to_a_local_folder_in_local_mode_only():
    assert staging_folder(SessionWith(spark_master="local[2]")) == "/tmp/checkpoints"
    with pytest.raises(ValueError, match="spark.checkpoint.dir"):
        staging_folder(SessionWith(spark_master="yarn"))
    named = SessionWith(spark_master="yarn", spark_checkpoint_dir="hdfs://nn/stage/")
    assert staging_folder(named) == "hdfs://nn/stage"
