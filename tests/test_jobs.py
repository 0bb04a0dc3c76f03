"""Every job from files to files."""

import os

import pytest
from retail import plain

from tillcube import jobs
from tillcube.sources import files, shared, sinks
from tillcube.sources.warehouse import current_set, write_set

HEADER = "InvoiceNo,StockCode,Description,Quantity,InvoiceDate,UnitPrice,CustomerID,Country\n"
SECOND_HEADER = "Invoice,StockCode,Description,Quantity,InvoiceDate,Price,Customer ID,Country\n"
LINES = """536365,A,LAMP,6,12/1/10 8:26,2.55,17850.0,France
536365,B,,2,12/1/10 8:26,3.5,17850.0,France
C536366,A,LAMP,-1,12/2/10 9:00,2.55,17850.0,France
536367,A,LAMP,3,1/4/11 10:00,2.55,,Spain
536368,B,CUP,4,1/5/11 11:30,3.5,13047.0,Spain
"""
# What each job writes.
TABLES = {
    "entities": {"country", "customer", "product", "invoice", "invoice_line"},
    "star": {"dim_country", "dim_customer", "dim_product", "dim_date", "fact_sales"},
    "history": {"dim_country", "dim_customer", "dim_product", "dim_date", "dim_invoice", "fact_sales"},
    "load": {"fact_sales"},
    "integrate": {"fact_sales", "duplicates"},
}


@pytest.fixture(scope="module")
def inputs(tmp_path_factory):
    folder = tmp_path_factory.mktemp("inputs")
    (folder / "store.csv").write_text(HEADER + LINES, encoding="latin-1")
    for sheet, lines in (("Year 2010", LINES[:90]), ("Year 2011", LINES)):
        (folder / "book" / sheet).mkdir(parents=True)
        text = SECOND_HEADER + lines[: lines.rindex("\n") + 1]
        (folder / "book" / sheet / "sheet.csv").write_text(text, encoding="latin-1")
    return folder


@pytest.fixture(autouse=True)
def own_shared_folder(spark, tmp_path, monkeypatch):
    """A shared folder for each test, so that what is left in it shows."""
    os.mkdir(tmp_path / "shared")
    monkeypatch.setattr(shared, "shared_folder", lambda _: str(tmp_path / "shared"))


@pytest.mark.parametrize("job", sorted(jobs.JOBS))
def test_job(spark, inputs, folder, job):
    arguments = ["--source", f"{inputs}/store.csv", "--output", folder, "--country", "France", "--year", "2010"]
    jobs.run(spark, [job, *arguments, "--parts", f"{inputs}/book"])
    written = current_set(spark, folder)
    folder = written.folder
    assert set(written.tables) >= TABLES.get(job, set()) and not os.listdir(shared.shared_folder(spark))
    for table in TABLES.get(job, ()):
        assert spark.read.parquet(f"{folder}/tables/{table}").columns
    if job == "integrate":
        assert spark.read.parquet(f"{folder}/tables/fact_sales").count() == 3
        counts = files.read_csv(spark, f"{folder}/reports/source_rows_count")
        assert plain(counts) == [("store.csv", "csv", "3")]
    if job == "olap":
        years = files.read_csv(spark, f"{folder}/reports/rollup_year")
        assert plain(years) == [("2010", "22.3000000000", "8.0000"), ("2011", "14.0000000000", "4.0000")]
    if job == "methods":
        normal, large = (
            {(r.report, r.key): float(r.value) for r in files.read_csv(spark, f"{folder}/reports/{s}_groupby").collect()}
            for s in ("normal", "large")
        )
        assert large["sales_by_country", "France"] == 5 * normal["sales_by_country", "France"]
        assert plain(files.read_csv(spark, f"{folder}/reports/large_pivot")) == plain(
            files.read_csv(spark, f"{folder}/reports/large_pre_keyed")
        )
    if job == "narrow":
        for report in ("sales_by_country", "sales_by_month", "top10_customers"):
            before, after = (files.read_csv(spark, f"{folder}/reports/{v}_{report}") for v in ("before", "after"))
            assert plain(before) == plain(after)


def test_job_needs_input(spark, folder):
    with pytest.raises(SystemExit):
        jobs.run(spark, ["star", "--output", folder])


def test_a_second_run_takes_the_place_of_the_first(spark, inputs, folder):
    arguments = ["star", "--source", f"{inputs}/store.csv", "--output", folder]
    jobs.run(spark, arguments)
    first = current_set(spark, folder)
    jobs.run(spark, arguments)
    second = current_set(spark, folder)
    assert first.folder != second.folder and first.tables == second.tables and second.tables["fact_sales"] == 5
    assert os.listdir(f"{folder}/sets") == [second.folder.rsplit("/", 1)[1]]


def test_a_killed_run_leaves_the_last_whole_set(spark, folder, monkeypatch):
    tables = {"a": spark.range(3), "b": spark.range(5)}
    reports = {"c": spark.range(2)}
    with pytest.raises(FileNotFoundError):
        current_set(spark, folder)
    write_set(spark, folder, tables, reports)
    kept = current_set(spark, folder)

    def killed(*_):
        raise KeyboardInterrupt

    monkeypatch.setattr("tillcube.sources.warehouse.write_csv", killed)
    with pytest.raises(KeyboardInterrupt):
        write_set(spark, folder, {"a": spark.range(9), "b": spark.range(9)}, reports)
    assert current_set(spark, folder) == kept and len(os.listdir(f"{folder}/sets")) == 2
    assert spark.read.parquet(kept.table_path("a")).count() == 3
    monkeypatch.setattr("tillcube.sources.warehouse.write_csv", sinks.write_csv)
    write_set(spark, folder, {"a": spark.range(9)}, {})
    final = current_set(spark, folder)
    assert final.tables == {"a": 9} and final.reports == () and len(os.listdir(f"{folder}/sets")) == 1
    os.rename(f"{folder}/current.json", f"{folder}/current.next")
    assert current_set(spark, folder) == final
    with open(f"{folder}/current.next", "w") as file:
        file.write('{"set": ')
    with pytest.raises(FileNotFoundError):
        current_set(spark, folder)


def test_a_job_that_fails_removes_what_it_wrote(spark, inputs, folder, monkeypatch):
    monkeypatch.setattr("tillcube.jobs.write_set", lambda *_: 1 / 0)
    with pytest.raises(ZeroDivisionError):
        jobs.run(spark, ["star", "--source", f"{inputs}/store.csv", "--output", folder])
    assert os.listdir(shared.shared_folder(spark)) == []
