"""Landing files as they come: large XML files, malformed records, CSV files with other headers."""

import pytest

from lakestay import fixed_values as fv
from lakestay.operators.frames import stringify
from lakestay.operators.quality import ContractError
from lakestay.plans.bronze import bronze_ingest
from lakestay.sources import readers
from tests import landing as land

XML = """<?xml version="1.0" encoding="UTF-8"?>
<bookings>
<booking><id>007</id><n>1.50</n><extra><a>1</a><b>x</b></extra><s/></booking>
<booking><id>1<x></booking>
<booking k="3" ><id> &amp; é </id><m>1</m><m>2</m></booking><booking><id></id></booking>
<booking><id><![CDATA[a<b]]></id><!-- c --><n q='1'>2</n></booking>
  <booking>
    <id>9</id>
  </booking >
<bookingless><id>no record</id></bookingless>
<booking><id>cut off</id>"""


def put(folder, name, text):
    folder.mkdir(exist_ok=True)
    (folder / name).write_text(text, encoding="utf-8")
    return str(folder / name)


def rows(df):
    return [r.asDict(recursive=True) for r in df.collect()]


def test_records_of_all_kinds(spark, tmp_path):
    found = rows(readers.read_xml_raw(spark, put(tmp_path, "b.xml", XML), "booking"))
    assert {c for r in found for c in r} == {"id", "n", "extra", "s", "m", "_k", fv.CORRUPT}
    good = {r["id"]: r for r in found if r[fv.CORRUPT] is None}
    assert set(good) == {"007", "& é", "", "a<b", "9"}
    assert good["007"]["extra"] == {"a": "1", "b": "x"} and good["& é"]["m"] == ["1", "2"] and good["& é"]["_k"] == "3"
    bad = [r[fv.CORRUPT] for r in found if r[fv.CORRUPT] is not None]
    assert sorted(bad) == ["<booking><id>1<x></booking>", "<booking><id>cut off</id>"]


def test_same_rows_as_the_reader_of_whole_files(spark, tmp_path):
    """Spark's own record reader, one task for a file, gives the same."""
    text = XML.replace("<booking><id>cut off</id>", "</bookings>").replace("</booking >", "</booking>")
    path = put(tmp_path, "b.xml", text)
    whole = spark.read.format("xml").options(
        rowTag="booking", inferSchema=False, mode="PERMISSIVE", columnNameOfCorruptRecord=fv.CORRUPT, useLegacyXMLParser=True,
    ).load(path)
    own = readers.read_xml_raw(spark, path, "booking")
    text = lambda df: sorted(map(str, stringify(df).select(*sorted(df.columns)).collect()))
    assert sorted(own.columns) == sorted(whole.columns) and text(own) == text(whole)


def test_a_large_file_takes_many_tasks(spark, tmp_path):
    records = "".join(f"\n<hotel><id>{i}</id><name>{'n' * (i % 50)}</name></hotel>" for i in range(5000))
    path = put(tmp_path, "h.xml", f"<hotels>{records}\n</hotels>\n")
    before = spark.conf.get("spark.sql.files.maxPartitionBytes")
    try:
        spark.conf.set("spark.sql.files.maxPartitionBytes", "20000")
        df = readers.read_xml_raw(spark, path, "hotel")
        assert df.rdd.getNumPartitions() > 5
        got = sorted((int(r["id"]), len(r["name"])) for r in df.collect())
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", before)
    assert got == [(i, i % 50) for i in range(5000)]
    assert df.filter(f"{fv.CORRUPT} is not null").count() == 0


def test_names_that_begin_like_the_record(spark, tmp_path):
    """And records with attributes, in files that start with either kind."""
    text = "<bookings><booking{}><booking_id>1</booking_id></booking>\n<booking{}>\n<booking_id>2</booking_id></booking></bookings>"
    put(tmp_path, "a.xml", text.format("", ' k="1"'))
    put(tmp_path, "b.xml", "\n" + text.format(' k="2"', ""))
    put(tmp_path, "c.xml", "<bookings>\n</bookings>")
    put(tmp_path, "d.xml", "\ufeff" + text.format("", ""))
    found = readers.read_xml_raw(spark, f"{tmp_path}/*.xml", "booking").collect()
    assert sorted((r["booking_id"], str(r["_k"])) for r in found) == [
        ("1", "2"), ("1", "None"), ("1", "None"), ("2", "1"), ("2", "None"), ("2", "None"),
    ]
    assert {r[fv.CORRUPT] for r in found} == {None}


def test_no_records(spark, tmp_path):
    assert readers.read_xml_raw(spark, put(tmp_path, "e.xml", "<hotels/>"), "hotel").collect() == []
    only_bad = rows(readers.read_xml_raw(spark, put(tmp_path, "x.xml", "<hs><h><a></h></hs>"), "h"))
    assert only_bad == [{fv.CORRUPT: "<h><a></h>"}]


def test_files_with_other_headers(spark, tmp_path):
    """Moved, missing and further columns land by name; an empty file gives nothing."""
    put(tmp_path, "a.csv", "id,name,n\n1,x,5\n2,y\n")
    put(tmp_path, "b.csv", "n,id,name\n6,3,z\n")
    put(tmp_path, "c.csv", 'id,"na,me"\n4,"q,r"\n')
    put(tmp_path, "d.csv", "id,name,n\n5,w,7\n")
    put(tmp_path, "e.csv", "")
    got = readers.read_csv_raw(spark, f"{tmp_path}/*.csv")
    assert got.columns[:3] == ["id", "name", "n"]
    found = sorted((tuple(r[c] for c in ("id", "name", "n", "na,me")) for r in got.filter(f"{fv.CORRUPT} is null").collect()))
    assert found == [("1", "x", "5", None), ("3", "z", "6", None), ("4", None, None, "q,r"), ("5", "w", "7", None)]
    assert [r[1] for r in got.filter(f"{fv.CORRUPT} is not null").select("id", fv.CORRUPT).collect()] == ["2,y"]


def test_a_file_without_a_required_column_is_rejected_alone(spark, tmp_path):
    root = str(tmp_path)
    land.put(root, "payments", land.DAY1, "p1.csv", land.PAYMENTS_CSV)
    land.put(root, "payments", land.DAY1, "p2.csv", "payment_id,amount\nP50,1\nP51,2\n")
    moved = land.PAYMENTS_CSV.splitlines()[:2]
    fields = [line.split(",") for line in moved]
    swapped = "\n".join(",".join([f[1], f[0], *f[2:], extra]) for f, extra in zip(fields, ("branch", "north")))
    land.put(root, "payments", land.DAY1, "p3.csv", swapped.replace("P1", "P60") + "\n")
    done = bronze_ingest(spark, readers.SOURCES["payments"], root, land.DAY1, "r")
    assert done == {"bronze_rows": 8, "rejected_rows": 2}
    bronze = readers.read_layer(spark, root, "bronze", "payments", land.DAY1)
    new = bronze.filter("payment_id = 'P60'").first()
    assert (new["booking_id"], new["branch"], new["_source_file"].rsplit("/", 1)[1]) == ("R1", "north", "p3.csv")
    rejected = spark.read.json(f"{root}/rejected/payments/_batch_date={land.DAY1}")
    assert sorted(r[0].strip() for r in spark.read.text(f"{root}/rejected/payments/_batch_date={land.DAY1}").collect())[0].count("P50") == 1
    assert rejected.count() == 2


def test_all_files_without_a_required_column_fail(spark, tmp_path):
    land.put(str(tmp_path), "payments", land.DAY1, "p.csv", "payment_id,amount\nP1,1\n")
    with pytest.raises(ContractError, match="missing columns"):
        bronze_ingest(spark, readers.SOURCES["payments"], str(tmp_path), land.DAY1, "r")


def test_structures_are_judged_once_each(spark, tmp_path):
    """Not record by record before they are told apart."""
    path = put(tmp_path, "b.xml", XML)
    options = {"inferSchema": "false", "mode": "PERMISSIVE", "columnNameOfCorruptRecord": fv.CORRUPT}
    shapes = readers._xml_shapes(readers._xml_records(spark, path, "booking"), options)
    plan = shapes._jdf.queryExecution().optimizedPlan().toString()
    above, below = plan.split("Aggregate", 1)
    assert "from_xml" in above and "from_xml" not in below
    assert [r[0] for r in shapes.collect()].count("<booking><id>x</id></booking>") == 1
