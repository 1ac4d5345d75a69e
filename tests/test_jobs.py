import glob
import gzip
import json
import shutil
import threading
from dataclasses import replace

import pytest
from pyspark.sql import functions as F
from tablelift.jobs import export_table, export_tables, verify_export
from tablelift.operators.results import audit
from tablelift.operators.validate import added_figures, validate
from tablelift.plans.options import ExportOptions
from tablelift.plans.spec import ColumnSpec, TableSpec
from tablelift.sinks.files import TableDir, read_export
from tablelift.sinks.manifest import (
    compact_records, delete_manifest, forget_export, lost_values, manifest_checks, read_manifest, read_refusals, record_history, schema_rows,
)
from tablelift.sinks.publish import load_table, publish_table, published_versions
from tablelift.sources.chunks import Chunk
from tablelift.sources.statement import stated_by_spark, statement_query, statement_rows


def people(spark, spec=None):
    return spark.range(500).selectExpr(
        "id AS ID", "concat('n', id % 7) AS NAME", "id / 4 AS PAY", "timestamp_ntz'2024-01-01' + make_dt_interval(cast(id % 3 AS int)) AS AT"
    )


@pytest.fixture
def spec(spark):
    return TableSpec.from_frame(
        people(spark), "HR", "PEOPLE", pk_cols=["ID"], partition_cols=["AT"], index_cols=["NAME"],
        virtual={"TWICE": "PAY * 2"}, comments={"PAY": 'per "month"'},
    )


def results(df):
    return {r["table"]: r for r in df.collect()}


@pytest.mark.parametrize("fmt", ["csv", "parquet"])
def test_export_counts_what_it_writes(spark, spec, tmp_path, fmt):
    done = export_table(spark, people, spec, str(tmp_path), ExportOptions(fmt=fmt, row_hash=True))
    assert (done["rows"], done["status"]) == (500, "SUCCESS") and done["bytes"] > 500 * 64
    checked = verify_export(spark, spec, str(tmp_path))
    # Rows, key hash total, row hashes, two sums, four counts of values.
    assert checked.count() == 9 and checked.where("NOT matches").count() == 0
    back = read_export(spark, TableDir(str(tmp_path), "HR", "PEOPLE").data, spec, fmt, row_hash=True)
    assert back.columns == ["ID", "NAME", "PAY", "AT", "ROW_HASH"]
    assert back.select("ROW_HASH").distinct().count() == 500


def test_verify_notices_lost_and_changed_rows(spark, spec, tmp_path):
    export_table(spark, people, spec, str(tmp_path), ExportOptions(fmt="parquet", row_hash=True))
    place = TableDir(str(tmp_path), "HR", "PEOPLE")
    kept = spark.createDataFrame(read_export(spark, place.data, spec, "parquet", True).where("ID <> 7").collect())
    kept.write.mode("overwrite").parquet(place.data)
    bad = {(r["metric"], r["column_name"]) for r in verify_export(spark, spec, str(tmp_path)).where("NOT matches").collect()}
    assert bad == {("ROW_COUNT", ""), ("PK_HASH", ""), ("SUM", "ID"), ("SUM", "PAY"), *[("NON_NULL", c) for c in ("ID", "NAME", "PAY", "AT")]}


def test_verify_notices_one_changed_text(spark, spec, tmp_path):
    export_table(spark, people, spec, str(tmp_path), ExportOptions(fmt="parquet", row_hash=True))
    place = TableDir(str(tmp_path), "HR", "PEOPLE")
    rows = spark.createDataFrame(read_export(spark, place.data, spec, "parquet", True).collect())
    rows.withColumn("NAME", F.when(F.col("ID") == 7, "nobody").otherwise(F.col("NAME"))).write.mode("overwrite").parquet(place.data)
    bad = verify_export(spark, spec, str(tmp_path)).where("NOT matches").collect()
    assert [(r["metric"], r["source_value"], r["target_value"]) for r in bad] == [("HASH_MISMATCHES", "0", "1")]


def test_damaged_csv_cells_fail_the_read(spark, tmp_path):
    spec = TableSpec.from_frame(spark.range(3).selectExpr("id AS ID", "id = 1 AS FLAG"), "HR", "FLAGS")
    export_table(spark, lambda s, _: s.range(3).selectExpr("id AS ID", "id = 1 AS FLAG"), spec, str(tmp_path), ExportOptions(fmt="csv", sep=","))
    place = TableDir(str(tmp_path), "HR", "FLAGS")
    text = [line for f in sorted(glob.glob(f"{place.data}/*.gz")) for line in gzip.open(f, "rt")]
    with gzip.open(f"{place.data}/part-damaged.csv.gz", "wt") as f:
        f.write('"ID","FLAG"\n"9","tr?e"\n')
    assert len(text) > 3
    with pytest.raises(Exception, match="a cell is no boolean: tr.e"):
        read_export(spark, place.data, spec, "csv", sep=",").collect()


def test_values_lost_in_casts(spark, tmp_path):
    spec = TableSpec("HR", "PAY", (ColumnSpec("ID", "NUMBER(9,0)", "INT64", "bigint"), ColumnSpec("PAY", "NUMBER(5,1)", "BIGNUMERIC", "decimal(5,1)")))

    def source(spark, _):
        return spark.createDataFrame([(1, "1.5"), (2, "oops"), (3, "99999999.0"), (4, None)], "ID long, PAY string")

    done = export_table(spark, source, spec, str(tmp_path), ExportOptions(fmt="parquet"))
    assert (done["status"], done["lost"]) == ("FAILED", 2) and done["error"] == "values lost in casts: PAY: 2"
    assert read_manifest(spark, str(tmp_path)).count() == 0
    done = export_table(spark, source, spec, str(tmp_path), ExportOptions(fmt="parquet", lost_values="record"))
    assert (done["status"], done["lost"]) == ("SUCCESS", 2)
    lost = {r["column_name"]: r["lost"] for r in lost_values(read_manifest(spark, str(tmp_path))).collect()}
    assert lost == {"ID": 0, "PAY": 2}
    # The source's own sum is what the files are held against.
    bad = verify_export(spark, spec, str(tmp_path)).where("NOT matches").collect()
    assert [(r["metric"], r["column_name"], r["target_value"]) for r in bad] == [("SUM", "PAY", "1.5")]


def test_casts_that_round_are_noticed(spark, tmp_path):
    spec = TableSpec("HR", "PAY", (ColumnSpec("PAY", "NUMBER(5,1)", "BIGNUMERIC", "decimal(5,1)"),))
    done = export_table(spark, lambda s, _: s.createDataFrame([("1.25",), ("2.5",)], "PAY string"), spec, str(tmp_path), ExportOptions(fmt="parquet"))
    assert (done["status"], done["lost"]) == ("FAILED", 0) and done["error"].startswith("sums changed by casts: PAY: 3.75")


def test_odd_column_names(spark, tmp_path):
    rows = spark.range(4).selectExpr("id AS `a``b`", "'x' AS `c.d`")
    spec = TableSpec.from_frame(rows, "HR", "ODD", pk_cols=["a`b"])
    for fmt in ("csv", "parquet"):
        assert export_table(spark, lambda s, _: rows, spec, str(tmp_path), ExportOptions(fmt=fmt, row_hash=True))["status"] == "SUCCESS"
        assert verify_export(spark, spec, str(tmp_path)).where("NOT matches").count() == 0
    assert publish_table(rows, spec).endswith("ODD`") and spark.table("ODD").count() == 4


def test_source_is_read_once(spark, spec, tmp_path):
    seen = spark.sparkContext.accumulator(0)

    def counted(spark, spec):
        def count(batches):
            for b in batches:
                seen.add(b.num_rows)
                yield b

        df = people(spark)
        return df.mapInArrow(count, df.schema)

    export_table(spark, counted, spec, str(tmp_path), ExportOptions(fmt="csv", row_hash=True))
    assert seen.value == 500


def test_failing_table_stops_nothing_and_is_resumed(spark, spec, tmp_path):
    broken = {"on": True}

    def source(spark, s):
        df = people(spark)
        if s.table == "BROKEN" and broken["on"]:
            return df.withColumn("PAY", F.raise_error(F.lit("disk on fire")).cast("double"))
        return df

    other = replace(spec, table="BROKEN")
    options = ExportOptions(fmt="parquet")
    first = results(export_tables(spark, source, [spec, other], str(tmp_path), options))
    assert (first["PEOPLE"]["status"], first["PEOPLE"]["rows"]) == ("SUCCESS", 500)
    assert first["BROKEN"]["status"] == "FAILED" and "disk on fire" in first["BROKEN"]["error"]
    assert [r["table"] for r in read_manifest(spark, str(tmp_path)).collect()] == ["PEOPLE"]

    broken["on"] = False
    second = results(export_tables(spark, source, [spec, other], str(tmp_path), options))
    assert (second["PEOPLE"]["rows"], second["BROKEN"]["rows"]) == (0, 500)
    assert (second["PEOPLE"]["status"], second["BROKEN"]["status"]) == ("SKIPPED", "SUCCESS")
    checks = audit(spark.createDataFrame(list(second.values()), "schema string, table string, rows long, bytes long, seconds double, status string, error string, lost long"), manifest_checks(read_manifest(spark, str(tmp_path))))
    assert all(r["rows_match"] for r in checks.collect())

    # Another filter means other content: the table runs again, and old files go.
    third = results(export_tables(spark, source, [spec], str(tmp_path), replace(options, where="ID < 10")))
    assert third["PEOPLE"]["rows"] == 10
    assert read_export(spark, TableDir(str(tmp_path), "HR", "PEOPLE").data, spec, "parquet").count() == 10
    reports = sorted(tmp_path.glob("report_*/summary/*.json"))
    assert [json.loads(f.read_text())["failed"] for f in reports] == [1, 0, 0]


def test_no_tables_at_all(spark, tmp_path):
    assert export_tables(spark, people, [], str(tmp_path)).count() == 0


def test_completion_record(spark, spec, tmp_path):
    export_table(spark, people, spec, str(tmp_path), ExportOptions(row_hash=True, sep=";"))
    r = read_manifest(spark, str(tmp_path)).first()
    assert (r["schema"], r["table"], r["fmt"], r["sep"], r["pk"], r["rows"]) == ("HR", "PEOPLE", "csv", ";", ["ID"], 500)
    assert [tuple(c) for c in r["columns"]] == schema_rows(spec, True)
    assert [c["name"] for c in r["columns"]] == ["ID", "NAME", "PAY", "AT", "ROW_HASH"]
    assert r["columns"][-1]["mode"] == "REQUIRED" and r["validation"]["row_count"] == 500
    c = manifest_checks(read_manifest(spark, str(tmp_path))).first()
    assert c["pk_hash"] and c["sums"] == 2


def test_records_are_a_log_with_history(spark, spec, tmp_path):
    out, names = str(tmp_path), ("A", "B", "C")
    specs = [replace(spec, table=t) for t in names]
    assert read_manifest(spark, out).count() == 0 and record_history(spark, out).count() == 0 and not compact_records(spark, out)
    for where in ("ID < 10", "ID < 20"):
        for s in specs:
            export_table(spark, people, s, out, ExportOptions(fmt="parquet", where=where))
    delete_manifest(spark, TableDir(out, "HR", "C"))
    now = lambda: sorted((r["table"], r["rows"]) for r in read_manifest(spark, out).collect())
    past = lambda: [(r["table"], r["rows"]) for r in record_history(spark, out).orderBy("logged_at").collect()]
    assert now() == [("A", 20), ("B", 20)] and past() == [(t, n) for n in (10, 20) for t in names]
    entries, history = len(list(tmp_path.glob("records/new/*.json"))), past()
    assert entries == 13 and not compact_records(spark, out, files=13) and compact_records(spark, out, files=5)
    assert not list(tmp_path.glob("records/new/*.json")) and now() == [("A", 20), ("B", 20)] and past() == history
    # The log goes on behind its compacted part; a compaction that was cut short leaves entries twice, and counts them once.
    kept = tmp_path / "kept"
    shutil.copytree(next(tmp_path.glob("records/compacted-*")), kept)
    export_table(spark, people, specs[2], out, ExportOptions(fmt="parquet", where="ID < 5"))
    assert compact_records(spark, out, files=1)
    shutil.copytree(kept, tmp_path / "records/compacted-1")
    assert now() == [("A", 20), ("B", 20), ("C", 5)] and past() == [*history, ("C", 5)]


def test_verify_needs_a_record(spark, spec, tmp_path):
    with pytest.raises(ValueError, match="no completion record"):
        verify_export(spark, spec, str(tmp_path))


def test_published_table_and_view(spark, spec, tmp_path, monkeypatch):
    spark.sql("CREATE DATABASE IF NOT EXISTS lift_test")
    for fmt, where, rows in (("parquet", None, 500), ("csv", "ID < 100", 100)):
        export_table(spark, people, spec, str(tmp_path), ExportOptions(fmt=fmt, row_hash=True, where=where))
        view = load_table(spark, str(tmp_path), spec, fmt, True, database="lift_test", location=str(tmp_path / "pub"))
        got = spark.table(view)
        assert got.columns == ["ID", "NAME", "PAY", "AT", "TWICE", "ROW_HASH"] and got.count() == rows
        assert got.where("TWICE <> PAY * 2").count() == 0
    # The version before stays for queries that still read it; older ones go with their files.
    assert len(list((tmp_path / "pub" / "PEOPLE_PHYSICAL").iterdir())) == 2
    load_table(spark, str(tmp_path), spec, "csv", True, database="lift_test", location=str(tmp_path / "pub"))
    assert len(list((tmp_path / "pub" / "PEOPLE_PHYSICAL").iterdir())) == 2
    versions = published_versions(spark, "PEOPLE_PHYSICAL", "lift_test")
    assert [spark.catalog.tableExists(f"lift_test.`{v}`") for v in versions] == [True, True]
    # A load that fails at the last step leaves the old rows under the name, and nothing else.
    failing = type(spark).sql

    def sql(self, text, *a, **k):
        if "CREATE OR REPLACE VIEW `lift_test`.`PEOPLE_PHYSICAL`" in text:
            raise RuntimeError("catalog away")
        return failing(self, text, *a, **k)

    with monkeypatch.context() as broken:
        broken.setattr(type(spark), "sql", sql)
        with pytest.raises(RuntimeError, match="catalog away"):
            load_table(spark, str(tmp_path), spec, "csv", True, database="lift_test", location=str(tmp_path / "pub"))
    assert spark.table("lift_test.PEOPLE_PHYSICAL").count() == 100
    assert published_versions(spark, "PEOPLE_PHYSICAL", "lift_test") == versions and len(list((tmp_path / "pub" / "PEOPLE_PHYSICAL").iterdir())) == 2
    physical = spark.table("lift_test.PEOPLE_PHYSICAL")
    assert {f.name: f.metadata.get("comment") for f in physical.schema}["PAY"] == 'per "month"'
    for name in ("PEOPLE_PHYSICAL", versions[-1]):
        props = {r["key"]: r["value"] for r in spark.sql(f"SHOW TBLPROPERTIES lift_test.`{name}`").collect()}
        assert props["primary_key"] == "ID" and props["clustered_by"] == "ID,NAME"
    assert [c.name for c in spark.catalog.listColumns(f"lift_test.`{versions[-1]}`") if c.isPartition] == ["AT_DAY"]
    days = spark.table("lift_test.PEOPLE_PHYSICAL").where("AT_DAY = DATE'2024-01-02'")
    assert "PartitionFilters: [isnotnull(AT_DAY" in days._jdf.queryExecution().executedPlan().toString()


def test_a_reader_never_misses_a_published_table(spark, tmp_path):
    """Loads of 1, 2, 3 ... rows while another thread reads: the name is always there, the rows are those of one load."""
    spec = TableSpec.from_frame(spark.range(1).toDF("ID"), "HR", "STEADY")
    spark.sql("CREATE DATABASE IF NOT EXISTS lift_test")
    spark.range(1).toDF("ID").write.mode("overwrite").saveAsTable("lift_test.STEADY")  # a plain table of earlier days
    publish_table(spark.range(1).toDF("ID"), spec, "lift_test", str(tmp_path))
    seen, failed, stop = set(), [], threading.Event()

    def read():
        while not stop.is_set():
            try:
                seen.add(tuple(sorted(r["ID"] for r in spark.table("lift_test.STEADY").collect())))
            except Exception as e:  # noqa: BLE001 - the test reports it
                failed.append(str(e)[:300])

    reader = threading.Thread(target=read)
    reader.start()
    for n in range(2, 8):
        publish_table(spark.range(n).toDF("ID"), spec, "lift_test", str(tmp_path))
    stop.set()
    reader.join()
    assert not failed and seen <= {tuple(range(n)) for n in range(1, 8)} and len(seen) > 1


class Stated:
    """A table with a statement of its own; some rows may get lost on the way."""

    def __init__(self, lost="false", chunks=0):
        self.lost, self.n, self.read = lost, chunks, []

    def __call__(self, spark, spec):
        return people(spark).where(f"NOT ({self.lost})")

    def statement(self, spark, spec, where=None):
        return stated_by_spark(people(spark).where(where or "true"), spec)


class Cut(Stated):
    def chunks(self, spark, spec, n, where=None):
        return [Chunk(i, f"ID % {self.n} = {i}", rows=people(spark).where(f"ID % {self.n} = {i}").count()) for i in range(self.n)]

    def load_chunk(self, spark, spec, chunk):
        self.read.append(chunk.chunk_id)
        return self(spark, spec).where(chunk.predicate)


def test_rows_that_never_arrive_are_noticed(spark, spec, tmp_path):
    out = str(tmp_path)
    done = export_table(spark, Stated("ID = 13"), spec, out, ExportOptions(fmt="parquet"))
    assert done["status"] == "FAILED" and done["error"].startswith("the source disagrees: ROW_COUNT: source 500, arrived 499; ")
    assert read_manifest(spark, out).count() == 0
    refused = {(r.metric, r.column_name): (r.stated, r.arrived) for r in read_refusals(spark, out).collect()}
    assert len(refused) == 7 and refused["SUM", "ID"] == ("124750", "124737") and refused["NON_NULL", "AT"] == ("500", "499")
    # A row read twice is noticed too; an honest source and one that fails no more leave no refusal.
    twice = Stated()
    twice.__class__ = type("Twice", (Stated,), {"__call__": lambda self, s, _: people(s).union(people(s).where("ID = 3"))})
    assert "source 500, arrived 501" in export_table(spark, twice, spec, out, ExportOptions(fmt="csv"))["error"]
    for fmt in ("csv", "parquet"):
        assert export_table(spark, Stated(), spec, out, ExportOptions(fmt=fmt, row_hash=True, where="ID < 50", string_nulls="empty"))["status"] == "SUCCESS"
    assert read_refusals(spark, out).count() == 0
    record = read_manifest(spark, out).first()
    assert {(r["metric"], r["column_name"]): r["value"] for r in record["stated"]}["ROW_COUNT", None] == "50"


def test_a_statement_in_the_sources_sql(spark, spec):
    """The pushed query, run by Spark in the database's place."""
    people(spark).withColumn("NAME", F.when(F.col("ID") % 2 == 0, F.col("NAME"))).createOrReplaceTempView("people_view")
    answer = spark.sql(f"SELECT * FROM {statement_query('people_view', spec, 'ID < 100').replace(chr(34), chr(96))}")
    said = {(r.metric, r.column_name): r.value for r in statement_rows(answer, spec).collect()}
    assert said == {("ROW_COUNT", None): "100", ("NON_NULL", "ID"): "100", ("NON_NULL", "NAME"): "50", ("NON_NULL", "PAY"): "100", ("NON_NULL", "AT"): "100", ("SUM", "ID"): "4950"}
    empty = spark.sql(f"SELECT * FROM {statement_query('people_view', spec, '1 = 0').replace(chr(34), chr(96))}")
    assert {(r.metric, r.column_name): r.value for r in statement_rows(empty, spec).collect()}["NON_NULL", "ID"] == "0"


def test_chunks_are_units_of_work_and_restart(spark, spec, tmp_path):
    out, options = str(tmp_path), ExportOptions(fmt="parquet", row_hash=True, parallel=3)
    place, source = TableDir(out, "HR", "PEOPLE"), Cut(chunks=5)
    small = replace(spec, table="SMALL", size_gb=0.5)
    done = results(export_tables(spark, source, [spec, small], out, options))
    assert {n: (r["status"], r["rows"]) for n, r in done.items()} == {"PEOPLE": ("SUCCESS", 500), "SMALL": ("SUCCESS", 500)}
    assert sorted(source.read) == list(range(5))
    assert sorted(x.name for x in (tmp_path / "HR/PEOPLE/data").iterdir()) == [f"chunk_{i:04d}" for i in range(5)]
    record = {r["table"]: r for r in read_manifest(spark, out).collect()}
    assert (record["PEOPLE"]["chunks"], record["SMALL"]["chunks"], record["PEOPLE"]["rows"]) == (5, None, 500)
    # Sums, counts and key hash totals of chunks add up to those of the table.
    assert {a["column_name"]: a["value"] for a in record["PEOPLE"]["validation"]["aggregates"]} == {a["column_name"]: a["value"] for a in record["SMALL"]["validation"]["aggregates"]}
    assert record["PEOPLE"]["validation"]["pk_hash"] == record["SMALL"]["validation"]["pk_hash"]
    assert verify_export(spark, spec, out).where("NOT matches").count() == 0
    assert read_export(spark, place.data, spec, "parquet", True).count() == 500

    files = {f: f.stat().st_mtime_ns for f in (tmp_path / "HR/PEOPLE/data").rglob("*.parquet")}
    (tmp_path / "HR/PEOPLE/config/chunks/chunk_0003.json").unlink()
    delete_manifest(spark, place)
    source.read.clear()
    again = results(export_tables(spark, source, [spec, small], out, options))
    assert source.read == [3] and (again["PEOPLE"]["status"], again["PEOPLE"]["rows"], again["SMALL"]["status"]) == ("SUCCESS", 500, "SKIPPED")
    kept = {f: t for f, t in files.items() if "chunk_0003" not in str(f)}
    assert kept and all(f.stat().st_mtime_ns == t for f, t in kept.items())
    # Forgetting the export means to read all of it again.
    forget_export(spark, place)
    source.read.clear()
    assert results(export_tables(spark, source, [spec], out, options))["PEOPLE"]["status"] == "SUCCESS" and sorted(source.read) == list(range(5))
    # Another filter is another export: new plan, old chunks go.
    third = results(export_tables(spark, Cut(chunks=2), [spec], out, replace(options, where="ID < 10")))
    assert third["PEOPLE"]["rows"] == 10 or third["PEOPLE"]["error"]


def test_chunks_that_fail_or_disagree(spark, spec, tmp_path):
    out, options = str(tmp_path), ExportOptions(fmt="csv", parallel=2)
    done = results(export_tables(spark, Cut("ID = 7", chunks=4), [spec], out, options))["PEOPLE"]
    assert (done["status"], done["error"]) == ("FAILED", "chunk 3: source 125 rows, arrived 124")
    assert read_manifest(spark, out).count() == 0
    # The next run reads that chunk alone.
    healed = Cut(chunks=4)
    done = results(export_tables(spark, healed, [spec], out, options))["PEOPLE"]
    assert healed.read == [3] and (done["status"], done["rows"]) == ("SUCCESS", 500)
    # Chunks that say nothing of their rows: the table's own statement still counts, and the next run plans anew.
    class Silent(Cut):
        def chunks(self, *a, **k):
            return [replace(c, rows=None) for c in super().chunks(*a, **k)]

    other, silent = replace(spec, table="OTHER"), Silent("ID = 7", chunks=2)
    done = results(export_tables(spark, silent, [other], out, options))["OTHER"]
    assert done["status"] == "FAILED" and "source 500, arrived 499" in done["error"]
    silent.lost = "false"
    assert results(export_tables(spark, silent, [other], out, options))["OTHER"]["status"] == "SUCCESS" and sorted(silent.read) == [0, 0, 1, 1]


def test_figures_of_parts_add_up(spark):
    values = [1.5, 2.25, 1 / 3, 1e300, float("nan"), float("inf"), float("-inf"), 1e12 / 7, 1e25, -4.0, 1e-30, None]
    df = spark.createDataFrame([(i, v) for i, v in enumerate(values * 3)], "ID int, X double")
    spec = TableSpec.from_frame(df, "S", "T")
    total = lambda d: {r["column_name"]: r["value"] for r in validate(d, spec).collect()}["X"]
    for n in (1, 2, 5):
        assert added_figures([total(df.where(f"ID % {n} = {i}")) for i in range(n)]) == total(df)
    assert added_figures([]) is None and added_figures([None, "3", "-1.50"]) == "1.50"
