"""Readers, sinks, pages and the two jobs, on temporary directories."""

import datetime

import pytest
from pyspark.sql import functions as F

import loadlens
from loadlens.operators import pages
from loadlens.plans import pipeline
from loadlens.plans import rulesets as rs
from loadlens.sources import documents, tables


@pytest.fixture
def folder(tmp_path):
    base = tmp_path / "txt_pymupdf4llm"
    (base / "sub").mkdir(parents=True)
    (base / "1 a.txt").write_bytes(b"Load 1\r\nx")
    (base / "2.txt").write_bytes(b"Load 2 \xff")
    (base / "3.TXT").write_text("no")
    (base / "empty.txt").write_text("")
    (base / "sub" / "4.txt").write_text("Load 4")
    (base / "sub" / "5.PdF").write_bytes(b"%PDF")
    (base / "6.pdf").write_bytes(b"%PDF-1")
    return base


def test_read_text(spark, folder):
    rows = {r.source_file: r.text for r in documents.read_text(spark, str(folder)).collect()}
    home = str(folder.parent)
    strip = lambda p: p.replace("///", "/")
    assert {strip(k) for k in rows} == {f"{home}/pdf/1 a.pdf", f"{home}/pdf/2.pdf"}
    assert {t[:6] for t in rows.values()} == {"Load 1", "Load 2"}


def test_read_binary(spark, folder):
    rows = documents.read_binary(spark, str(folder), encoded_path=False, file_columns=True).collect()
    assert {r.path.rsplit("/", 1)[1] for r in rows} >= {"1 a.txt", "2.txt"}
    by_name = {r.path.rsplit("/", 1)[1]: r for r in rows}
    assert by_name["2.txt"].text == "Load 2 \ufffd"
    assert by_name["1 a.txt"].length == 9
    assert isinstance(rows[0].modificationTime, datetime.datetime)
    encoded = documents.read_binary(spark, str(folder)).collect()
    assert any("1%20a.txt" in r.source_file for r in encoded)
    deep = documents.read_binary(spark, str(folder), recursive=True).collect()
    assert any(r.source_file.endswith("sub/4.txt") for r in deep)


def test_list_pdfs(spark, folder):
    names = {r.path.rsplit("/", 1)[1] for r in documents.list_pdfs(spark, str(folder)).collect()}
    assert names == {"5.PdF", "6.pdf"}


def test_truncate_overwrite_and_old_columns(spark):
    assert tables.truncate(spark, "not_there") is False
    old = spark.createDataFrame([("a", 1)], "k string, gone int")
    assert tables.overwrite(old, "evolving") == 1
    assert tables.truncate(spark, "evolving") is True
    assert documents.read_table(spark, "evolving").count() == 0
    new = spark.createDataFrame([("b", 2.0), ("c", 3.0)], "k string, added double")
    assert tables.overwrite(new, "evolving") == 2
    rows = documents.read_table(spark, "evolving").orderBy("k").collect()
    assert [r.asDict() for r in rows] == [{"k": "b", "added": 2.0, "gone": None}, {"k": "c", "added": 3.0, "gone": None}]
    assert tables.overwrite(new, "evolving", merge_schema=False) == 2
    assert documents.read_table(spark, "evolving").columns == ["k", "added"]


def _failing(spark, columns):
    """Rows of which some are written before one of them fails its task."""
    rows = spark.range(0, 4000, 1, 4).selectExpr(*columns)
    return rows.filter(F.when(F.col("k") == 3999, F.raise_error(F.lit("broken row"))).otherwise(F.lit(True)))


@pytest.mark.parametrize("columns", [["id AS k"], ["id AS k", "'x' AS added"]])
def test_failed_overwrite_leaves_the_old_rows(spark, columns):
    name = f"kept_{len(columns)}"
    assert tables.overwrite(spark.range(5).selectExpr("id AS k"), name) == 5
    before = set(spark.catalog.listTables()[i].name for i in range(len(spark.catalog.listTables())))
    with pytest.raises(Exception, match="broken row"):
        tables.overwrite(_failing(spark, columns), name)
    assert [r.k for r in spark.table(name).orderBy("k").collect()] == [0, 1, 2, 3, 4]
    assert spark.table(name).columns == ["k"]
    with pytest.raises(ValueError, match="refused"):
        tables.overwrite(spark.range(2).selectExpr(*columns), name, accept=lambda rows: (_ for _ in ()).throw(ValueError("refused")))
    assert spark.table(name).count() == 5
    assert {t.name for t in spark.catalog.listTables()} == before
    assert tables.overwrite(spark.range(7).selectExpr(*columns), name) == 7
    assert tables.overwrite(spark.table(name).filter("k < 3"), name) == 3  # it may read what it replaces
    assert spark.table(name).count() == 3 and {t.name for t in spark.catalog.listTables()} == before
    places = spark.sql(f"DESCRIBE TABLE EXTENDED {name}").filter("col_name IN ('Location', 'Type')").collect()
    assert {r.col_name: r.data_type for r in places}["Type"] == "MANAGED"
    assert tables.truncate(spark, name) and spark.table(name).count() == 0


def test_failed_first_write_leaves_no_table(spark):
    with pytest.raises(Exception, match="broken row"):
        tables.overwrite(_failing(spark, ["id AS k"]), "never_there")
    assert not spark.catalog.tableExists("never_there")
    assert tables.overwrite(spark.range(3), "never_there") == 3


def test_old_files_go_and_interrupted_changes_are_put_back(spark, tmp_path):
    import os

    place = lambda: spark.sql("DESCRIBE TABLE EXTENDED swapped").filter("col_name = 'Location'").first().data_type.removeprefix("file:")
    tables.overwrite(spark.range(3), "swapped")
    first = place()
    tables.overwrite(spark.range(4), "swapped")
    assert place() != first and os.path.isdir(place()) and not os.path.isdir(first)
    # a job ended after the old table was renamed
    spark.sql("ALTER TABLE swapped RENAME TO swapped__old")
    assert tables.put_back(spark, "swapped") and spark.table("swapped").count() == 4
    spark.sql("ALTER TABLE swapped RENAME TO swapped__old")
    assert tables.overwrite(spark.range(6).selectExpr("id", "id AS more"), "swapped") == 6
    assert spark.table("swapped").count() == 6 and not spark.catalog.tableExists("swapped__old")


def test_overwrite_in_a_named_database(spark):
    spark.sql("CREATE DATABASE IF NOT EXISTS lake")
    for rows in (3, 4):
        assert tables.overwrite(spark.range(rows), "lake.loads") == rows
        assert tables.overwrite(spark.range(rows).selectExpr("id", "'a' AS extra"), "lake.loads") == rows
    assert spark.table("lake.loads").count() == 4
    assert [t.name for t in spark.catalog.listTables("lake")] == ["loads"]


def test_load_and_validate(spark, folder):
    assert pipeline.load(spark, str(folder), "loads_cy") == 2
    written = spark.table("loads_cy")
    assert {r.loadConfirmationNumber for r in written.collect()} == {"1", "2"}
    truth = written.withColumn("broker_city", F.when(F.col("loadConfirmationNumber") == "2", "Rome").otherwise(F.col("broker_city")))
    with pytest.raises(ValueError, match="1 errors"):
        loadlens.validate(spark, "loads_cy", truth)
    out = loadlens.validate(spark, "loads_cy", truth, raise_on_error=False)
    assert out["results"].filter("status = 'Mismatch'").select("load", "field").collect() == [("2", "broker_city")]
    assert out["missing_loads"].count() == 0
    loadlens.validate(spark, "loads_cy", written)


def test_load_vendors(spark, tmp_path):
    for source, text in (("CY", "Load 8"), ("UTB", "Trip #: 9"), ("NEW", "Load 10")):
        (tmp_path / f"source={source}").mkdir()
        (tmp_path / f"source={source}" / "x.txt").write_text(text)
    assert pipeline.load_vendors(spark, str(tmp_path), "loads_all", {"CY": rs.CY, "UTB": rs.UTB}) == 3
    rows = spark.table("loads_all").collect()
    assert {(r.source, r.routed, r.loadConfirmationNumber) for r in rows} == {("CY", True, "8"), ("UTB", True, "9"), ("NEW", False, "")}
    routed = documents.read_vendors(spark, str(tmp_path)).filter("source = 'CY'")
    assert "PartitionFilters: [isnotnull(source" in routed._jdf.queryExecution().executedPlan().toString()


PAGES = [("a", 2, "two"), ("a", 1, None), ("a", 3, "three"), ("b", 1, ""), ("b", 2, None), ("c", 1, "one")]


def test_assemble(spark):
    df = spark.createDataFrame(PAGES, "doc string, page_no int, text string")
    whole = {r.doc: r.text for r in pages.assemble(df, ["doc"]).collect()}
    assert whole == {"a": "\n\ntwo\n\nthree", "b": "\n\n", "c": "one"}
    filled = {r.doc: r.text for r in pages.assemble_filled(df, ["doc"]).collect()}
    assert filled == {"a": "two\nthree\n", "b": "", "c": "one\n"}


def test_long_documents_are_one_row(spark):
    df = spark.range(25_000).select(F.lit("d").alias("doc"), F.col("id").alias("page_no"), F.col("id").cast("string").alias("text"))
    (row,) = pages.assemble(df, ["doc"]).collect()
    assert row.text == "\n\n".join(str(i) for i in range(25_000))
    some = df.withColumn("text", F.when(F.col("page_no") % 7 == 0, F.col("text")))
    (row,) = pages.assemble_filled(some, ["doc"], pages_per_range=100).collect()
    assert row.text == "".join(f"{i}\n" for i in range(0, 25_000, 7))


def test_pages_without_a_number_come_last(spark):
    df = spark.createDataFrame([("a", None, "z"), ("a", 2, "two"), ("a", None, "b"), ("a", 1, "one")], "doc string, page_no int, text string")
    assert [r.text for r in pages.assemble(df, ["doc"]).collect()] == ["one\n\ntwo\n\nb\n\nz"]
    assert [r.text for r in pages.assemble_filled(df, ["doc"]).collect()] == ["one\ntwo\nb\nz\n"]


def test_convert(spark):
    rows = [("/in/x/a.pdf", 1, "one", True), ("/in/x/a.pdf", 2, "bad", False), ("/in/b.PDF", 1, None, None)]
    df = spark.createDataFrame(rows, "source_file string, page_no int, text string, ok boolean")
    assert [tuple(r) for r in pipeline.convert(df, "converted", "/in", "/out").collect()] == [(1, 1)]
    assert [tuple(r) for r in spark.table("converted").collect()] == [("/in/x/a.pdf", "/out/x/a.txt", "one\n\n", "/out/x")]
    with pytest.raises(ValueError):
        pipeline.convert(df.filter("page_no = 9"), "converted", "/in", "/out")
    assert spark.table("converted").count() == 1
    again = df.withColumn("ok", F.lit(True))
    assert [tuple(r) for r in pipeline.convert(again, "converted", "/in", "/out").collect()] == [(2, 0)]
    assert {r.target_path for r in spark.table("converted").collect()} == {"/out/x/a.txt", "/out/b.txt"}


def test_convert_shows_nothing_when_no_document_was_converted(spark):
    df = spark.createDataFrame([("/in/a.pdf", 1, "x", False)], "source_file string, page_no int, text string, ok boolean")
    with pytest.raises(ValueError, match="no document"):
        pipeline.convert(df, "unconverted", "/in", "/out")
    assert not [t.name for t in spark.catalog.listTables() if t.name.startswith("unconverted")]


def test_convert_reads_its_pages_once(spark, tmp_path):
    rows = [(f"/in/{i % 7}.pdf", i, "text", i % 7 != 3) for i in range(50)]
    read = spark.sparkContext.accumulator(0)

    def count(batches):
        for b in batches:
            read.add(b.num_rows)
            yield b

    df = spark.createDataFrame(rows, "source_file string, page_no int, text string, ok boolean")
    assert [tuple(r) for r in pipeline.convert(df.mapInArrow(count, df.schema), "read_once", "/in", "/out").collect()] == [(6, 1)]
    assert read.value == 50


def test_load_as_each_rule_set_reads(spark, folder):
    for name, ruleset in rs.RULESETS.items():
        table = f"loads_{name}"
        written = pipeline.load(spark, str(folder), table, ruleset)
        paths = {r.source_file.replace("file:", "").replace("///", "/") for r in spark.table(table).collect()}
        columns = set(spark.table(table).columns)
        assert ({"path", "modificationTime", "length"} <= columns) == ruleset.reader.file_columns
        # Spark gives no row for a file without bytes
        if name == "utb":  # paths as they are
            assert written == 2 and f"{folder}/1%20a.txt" in paths
        elif name == "utb_flat":  # every file of the folder
            assert written == 4
        else:
            assert written == 2 and any(p.endswith("1 a.pdf") for p in paths)


def test_validate_a_table_that_is_not_there(spark, folder):
    truth = documents.truth_rows(spark, [{"loadConfirmationNumber": "1"}, {"loadConfirmationNumber": "2"}], ["loadConfirmationNumber"])
    with pytest.raises(ValueError):
        loadlens.validate(spark, "no_such_table", truth)
    out = loadlens.validate(spark, "no_such_table", truth, raise_on_error=False)
    assert {r.kind: r.errors for r in out["errors"].collect()}["unreadable_table"] == 2
    assert out["missing_loads"].count() == 2


def test_ledger(spark):
    df = spark.createDataFrame([("x", True), ("x", False), ("y", None)], "source string, ok boolean")
    counts = pages.ledger(df, F.col("ok"), ["source"])
    assert {tuple(r) for r in counts.collect()} == {("x", 1, 1), ("y", 0, 1)}
    assert pages.require_converted(counts) == 1
    with pytest.raises(ValueError):
        pages.require_converted(counts.filter("source = 'y'"))


def _exchanges_of_the_target(df, table):
    """Exchanges above the scan of the table in the physical plan, up to the first join."""
    lines = df._jdf.queryExecution().executedPlan().toString().split("\n")
    depth = lambda line: len(line) - len(line.lstrip(" :+-*()0123456789"))
    scans = [i for i, line in enumerate(lines) if "FileScan" in line and f".{table}[" in line]
    assert scans
    found = []
    for i in scans:
        below = depth(lines[i])
        for line in reversed(lines[:i]):
            if depth(line) < below:
                below = depth(line)
                if "Join" in line:
                    break
                if "Exchange" in line:
                    found.append(line)
    return found


def test_validation_where_the_target_lies(spark, folder):
    rows = spark.range(0, 900, 1, 3).selectExpr(
        "CASE WHEN id % 3 = 0 THEN '' ELSE cast(id % 400 AS string) END AS loadConfirmationNumber",
        "concat('f', id) AS source_file", "concat('city ', id % 7) AS broker_city",
    )
    tables.overwrite(rows, "loads_any")
    assert pipeline.store_by_load(spark, "loads_any", "loads_by_load") == rows.select("loadConfirmationNumber").distinct().count()
    truth = spark.range(0, 450).selectExpr(
        "CASE WHEN id = 0 THEN '' ELSE cast(id AS string) END AS loadConfirmationNumber", "concat('f', id) AS source_file",
        "'city 1' AS broker_city", "'x' AS carrier_mc",
    )
    before = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        plain = loadlens.validate(spark, "loads_any", truth, raise_on_error=False)
        stored = loadlens.validate(spark, "loads_by_load", truth, raise_on_error=False)
        for part, frame in plain.items():
            assert sorted(map(str, frame.collect())) == sorted(map(str, stored[part].collect())), part
        for part in ("results", "missing_loads"):
            assert _exchanges_of_the_target(plain[part], "loads_any")
            assert not _exchanges_of_the_target(stored[part], "loads_by_load"), part
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", before)
    # the buckets stay when the table is replaced, also by a writer that does not know of them
    assert tables.overwrite(spark.table("loads_any").limit(50), "loads_by_load") == 50
    about = tables._described(spark, "loads_by_load")
    assert tables._buckets(about) == (8, ("loadConfirmationNumber",)) and spark.table("loads_by_load").count() == 50
