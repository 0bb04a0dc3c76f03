"""Scans and sinks: encodings, quoting, parts, suffixes, typing of text."""

from datetime import datetime
from decimal import Decimal

import pytest
from pyspark.sql import functions as F
from retail import line, lines, plain

from tillcube.functions.typing import as_identifier, as_price, as_quantity, as_timestamp
from tillcube.operators import align
from tillcube.operators.align import Source
from tillcube.sources import files, shared, sinks


def write_text(path, text, encoding="latin-1"):
    with open(path, "w", encoding=encoding) as file:
        file.write(text)


def test_latin1_file_with_quotes_and_gaps(spark, folder):
    path = f"{folder}/store.csv"
    write_text(
        path,
        "InvoiceNo,StockCode,Description,Quantity,InvoiceDate,UnitPrice,CustomerID,Country\n"
        '536365,85123A,"CAFÉ ""BLEU"", façade",6,12/1/10 8:26,2.55,17850.0,Réunion\n'
        "C1,B,,x,junk,,,\n",
    )
    read = align.typed(align.align(files.read_retail_file(spark, path), keep=["source_file"]))
    first, second = sorted(read.collect(), key=lambda row: row.invoice_no)
    assert first.description == 'CAFÉ "BLEU", façade'
    assert first.country == "Réunion"
    assert first.invoice_date == datetime(2010, 12, 1, 8, 26)
    assert (first.quantity, first.unit_price, first.customer_id) == (6, Decimal("2.5500"), 17850)
    assert first.source_file == "store.csv"
    assert tuple(second)[2:8] == (None, None, None, None, None, None)


def test_round_trip_keeps_text(spark, folder):
    rows = [(" padded ", 'a "quoted" word'), ("back\\slash", "comma, here"), (None, "é")]
    df = spark.createDataFrame(rows, "a string, b string")
    sinks.write_csv(df, f"{folder}/out", "ISO-8859-1")
    assert plain(files.read_csv(spark, f"{folder}/out", encoding="ISO-8859-1")) == plain(df)


def test_a_file_with_another_header_is_an_error(spark, folder):
    for name, header in (("a", "x,y"), ("b", "y,x")):
        write_text(f"{folder}/{name}.csv", f"{header}\n1,2\n")
    with pytest.raises(Exception, match="(?i)header"):
        files.read_csv(spark, folder).collect()


def test_line_breaks_inside_quotes(spark, folder):
    path = f"{folder}/notes.csv"
    write_text(path, 'a,b\n1,"two\nlines"\n')
    assert plain(files.read_csv(spark, path, multi_line=True)) == [("1", "two\nlines")]


def test_parts_keep_their_name(spark, folder):
    df = spark.createDataFrame([("1",)], "Invoice string")
    sinks.write_csv(df, f"{folder}/book/Year 2009-2010", "ISO-8859-1")
    sinks.write_csv(df.union(df), f"{folder}/book/Year 2010-2011", "ISO-8859-1")
    parts = files.read_parts(spark, f"{folder}/book")
    assert files.part_names(spark, f"{folder}/book") == ["Year 2009-2010", "Year 2010-2011"]
    assert plain(parts.groupBy("source_sheet").count()) == [("Year 2009-2010", 1), ("Year 2010-2011", 2)]


def test_unknown_suffix_is_refused(spark):
    with pytest.raises(ValueError, match="lines.xlsx"):
        files.read_retail_file(spark, "/data/lines.xlsx")


@pytest.mark.parametrize(
    ("text", "expected"),
    [
        ("12/1/10 8:26", datetime(2010, 12, 1, 8, 26)),
        ("1/31/70 23:05:09", datetime(1970, 1, 31, 23, 5, 9)),
        ("3/4/2011 9:00", datetime(2011, 3, 4, 9, 0)),
        ("2011-03-04 09:00:00", datetime(2011, 3, 4, 9, 0)),
        ("13/45/10 8:26", None),
        ("junk", None),
        ("", None),
        (None, None),
    ],
)
def test_timestamp_text(spark, text, expected):
    df = spark.createDataFrame([(text,)], "t string")
    assert df.select(as_timestamp(F.col("t"))).first()[0] == expected


def test_timestamp_text_does_not_depend_on_the_time_zone(spark):
    """2:30 on this day does not exist in New York, but the file says so."""
    df = spark.createDataFrame([("3/13/11 2:30",)], "t string")
    before = spark.conf.get("spark.sql.session.timeZone")
    try:
        spark.conf.set("spark.sql.session.timeZone", "America/New_York")
        found = df.select(as_timestamp(F.col("t")).cast("string")).first()[0]
    finally:
        spark.conf.set("spark.sql.session.timeZone", before)
    assert found == "2011-03-13 02:30:00"


def test_number_text(spark):
    df = spark.createDataFrame([("6",), ("17850.0",), ("2.5",), ("x",), ("",), ("NaN",), ("99999999999",)], "t string")
    t = F.col("t")
    found = df.select(as_quantity(t), as_identifier(t), as_price(t)).collect()
    assert [row[0] for row in found] == [6, 17850, Decimal("2.5"), None, None, None, 99999999999]
    assert [row[1] for row in found] == [6, 17850, 2, None, None, None, 99999999999]
    assert [row[2] for row in found[:4]] == [Decimal(6), Decimal(17850), Decimal("2.5"), None]


def test_header_spellings(spark):
    df = spark.createDataFrame(
        [("1",) * 8],
        "`Invoice` string, `StockCode ` string, `Description` string, `Quantity` string, "
        "`Invoice Date` string, `Price` string, `Customer Id` string, ` Country` string",
    )
    assert align.align(df).columns == list(lines(spark, line()).columns)


def test_missing_columns_are_named_or_added(spark):
    df = spark.createDataFrame([("1", "A")], "InvoiceNo string, StockCode string")
    with pytest.raises(ValueError, match="description, quantity, invoice_date, unit_price, customer_id, country"):
        align.align(df)
    row = align.align(df, fill_missing=True).first()
    assert (row.invoice_no, row.country, row.quantity) == ("1", None, None)


def test_two_headers_for_one_column_are_refused(spark):
    df = spark.createDataFrame([("1", "1")], "Invoice string, InvoiceNo string")
    with pytest.raises(ValueError, match="invoice_no"):
        align.rename_headers(df)


def test_stacked_sources_have_lineage(spark):
    one = Source(lines(spark, line()), "shop", "csv", "a.csv")
    two = Source(lines(spark, line(invoice_no="2")).drop("country"), "web", "s1", "b")
    stacked = align.stack_sources([one, two])
    assert plain(stacked, "invoice_no", "source_rank", "source_system", "country") == [
        ("1", 1, "shop", "France"),
        ("2", 2, "web", None),
    ]
    assert plain(align.rows_per_source(stacked)) == [("shop", "csv", 1), ("web", "s1", 1)]


def test_union_fills_absent_columns(spark):
    left = spark.createDataFrame([(1, 2)], "a int, b int")
    right = spark.createDataFrame([(3,)], "b int")
    assert plain(align.stack([left, right])) == [(1, 2), (None, 3)]


def test_shared_folder_is_read_from_the_session(spark):
    configured = spark.conf.get("spark.checkpoint.dir", None)
    if configured:
        assert shared.shared_folder(spark) == configured.rstrip("/")
    assert shared.new_path(spark, "x") != shared.new_path(spark, "x")


def test_warehouse_layout(spark, folder):
    df = spark.createDataFrame([(1, 2011, 1), (2, 2011, 2), (3, 2010, 1)], "id int, year int, month int")
    sinks.write_warehouse({"fact": df, "dim": df.select("id")}, folder, {"fact": ["year", "month"]})
    back = sinks.read_warehouse(spark, folder, ["fact", "dim"])
    assert plain(back["fact"], "id", "year", "month") == plain(df)
    directories = {path.split("/fact/")[1].rsplit("/", 1)[0] for path in back["fact"].inputFiles()}
    assert directories == {"year=2010/month=1", "year=2011/month=1", "year=2011/month=2"}
    assert len(back["fact"].inputFiles()) == 3


def test_warehouse_derives_columns_and_sorts_files(spark, folder):
    df = spark.range(5000).select((F.col("id") * 7919 % 5000).alias("id"), (F.col("id") % 3).cast("int").alias("year"))
    twice = {"fact": lambda table: table.withColumn("twice", F.col("id") * 2)}
    sinks.write_warehouse({"fact": df}, folder, {"fact": ["year"]}, {"fact": ["id"]}, twice)
    back = sinks.read_warehouse(spark, folder, ["fact"])["fact"]
    assert back.columns == ["id", "twice", "year"] and plain(back.drop("twice")) == plain(df)
    assert back.where("twice <> 2 * id").isEmpty()
    for path in back.inputFiles():
        ids = [row.id for row in spark.read.parquet(path).coalesce(1).collect()]
        assert ids == sorted(ids)


def test_replicate(spark):
    df = spark.createDataFrame([(1,), (2,)], "a int")
    assert plain(sinks.replicate(df, 3)) == [(1,)] * 3 + [(2,)] * 3
    assert sinks.replicate(df, 0).count() == 0
    assert "Exchange" not in sinks.replicate(df, 3)._jdf.queryExecution().toString()
