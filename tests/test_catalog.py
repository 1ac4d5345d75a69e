from tablelift.jobs import specs_of
from tablelift.sources.catalog import (
    columns_of, discover, drop_tables, keep_tables, list_tables, name_set, table_sizes, virtual_exprs,
)

COLUMNS = (
    "owner string, table_name string, column_name string, data_type string, data_precision int, data_scale int, "
    "virtual_column string, hidden_column string, identity_column string, user_generated string, column_id int, "
    "internal_column_id int, data_default string"
)


def column(name, type_, number, virtual=None, hidden="NO", user="YES", precision=None, scale=None, table="T"):
    return (
        "HR", table, name, type_, precision, scale, "YES" if virtual else "NO", hidden, "NO", user,
        None if hidden == "YES" else number, number, virtual,
    )


def frames(spark):
    make = spark.createDataFrame
    return {
        "tables": make([("HR", "T", 10, 100, 50), ("HR", "U", None, None, None)], "owner string, table_name string, num_rows long, avg_row_len long, blocks long"),
        "columns": make(
            [
                column("HID", "VARCHAR2", 1, hidden="YES"), column("SYS$1", "RAW", 2, hidden="YES", user="NO"),
                column("ID", "NUMBER", 4, precision=10, scale=0), column("NAME", "VARCHAR2", 3),
                column("TOTAL", "NUMBER", 5, virtual=" ID * 2 "), column("AT", "TIMESTAMP(6) WITH TIME ZONE", 6),
            ],
            COLUMNS,
        ),
        "comments": make([("HR", "T", "ID", "the key")], "owner string, table_name string, column_name string, comments string"),
        "constraints": make(
            [("HR", "T", "PK", "P"), ("HR", "T", "UK", "U")],
            "owner string, table_name string, constraint_name string, constraint_type string",
        ),
        "cons_columns": make(
            [("HR", "PK", "NAME", 2), ("HR", "PK", "ID", 1), ("HR", "UK", "AT", 1)],
            "owner string, constraint_name string, column_name string, position int",
        ),
        "part_keys": make(
            [("HR", "T", "TABLE", "AT", 1), ("HR", "T", "INDEX", "ID", 1)],
            "owner string, name string, object_type string, column_name string, column_position int",
        ),
        "indexes": make(
            [("HR", "T", "IX2", "ID", 1), ("HR", "T", "IX1", "NAME", 2), ("HR", "T", "IX1", "ID", 1)],
            "table_owner string, table_name string, index_name string, column_name string, column_position int",
        ),
        "segments": make([("HR", "T", 2**30), ("HR", "T", 2**29)], "owner string, segment_name string, bytes long"),
    }


def test_discover(spark):
    t, u = sorted(specs_of(discover(**frames(spark))), key=lambda s: s.table)
    assert [c.name for c in t.columns] == ["NAME", "ID", "TOTAL", "AT", "HID"]
    by = {c.name: c for c in t.columns}
    assert by["ID"].spark_type == "bigint" and by["ID"].comment == "the key"
    assert by["TOTAL"].virtual_expr == "ID * 2" and not by["TOTAL"].is_physical
    assert by["AT"].is_transformed and by["HID"].is_hidden
    assert (t.pk_cols, t.partition_cols, t.index_cols) == (("ID", "NAME"), ("AT",), ("ID", "NAME", "ID"))
    assert t.size_gb == 1.5 and t.day_column == "AT" and t.needs_view
    assert u.columns == () and u.size_gb == 0 and u.pk_cols == ()


def test_sizes_fall_back(spark):
    tables = spark.createDataFrame(
        [("A", "T1", 1, 1), ("A", "T2", 2**20, 1024), ("A", "T3", None, 5), ("A", "T4", 9, 9)],
        "owner string, table_name string, num_rows long, avg_row_len long",
    )
    segments = spark.createDataFrame([("A", "T1", 2**31)], "owner string, segment_name string, bytes long")
    own = spark.createDataFrame([("T4", 2**32), ("T1", 7)], "segment_name string, bytes long")
    got = {r["table_name"]: r["size_gb"] for r in table_sizes(tables, segments, own).collect()}
    assert got == {"T1": 2.0, "T2": 1.0, "T3": 0.0, "T4": 4.0}


def test_name_sets(spark, tmp_path):
    names = lambda df: [r["name"] for r in df.collect()]
    f = tmp_path / "names.txt"
    f.write_text("sales\r\n\n  hr \nops")
    assert names(name_set(spark, "hr", ["Fin", "HR"], str(f))) == ["FIN", "HR", "OPS", "SALES"]
    assert names(name_set(spark, default="scott")) == ["SCOTT"]
    assert names(name_set(spark)) == []


def test_include_and_exclude(spark):
    tables = spark.createDataFrame([("A", "X"), ("A", "Y"), ("B", "X"), ("A", "Z")], "owner string, table_name string")
    kept = keep_tables(list_tables(tables, ["a"]), name_set(spark, many=["x", "y"]))
    assert sorted(r["table_name"] for r in kept.collect()) == ["X", "Y"]
    left = drop_tables(kept, name_set(spark, "X"))
    assert [r["table_name"] for r in left.collect()] == ["Y"]
    assert keep_tables(tables, None) is tables and drop_tables(tables, None) is tables


def test_long_expressions_are_marked(spark):
    df = spark.createDataFrame([column("a", "NUMBER", 1, virtual="x" * 32760), column("b", "NUMBER", 2, virtual=" y ")], COLUMNS)
    assert [(r["column_name"], r["may_be_cut"]) for r in virtual_exprs(df).collect()] == [("A", True), ("B", False)]


def test_columns_without_comment_stay(spark):
    f = frames(spark)
    assert columns_of(f["columns"], f["comments"]).count() == 5


def test_comments_are_found_without_a_shuffle_of_columns(spark):
    """Comments join the list of their table; a column has a row for each of its comments, as a join would give."""
    f = frames(spark)
    more = [("HR", "T", "ID", "a second"), ("HR", "T", "NAME", None), ("HR", "T", None, "nobody's"), ("HR", None, "ID", "no table's"), ("HR", "U", "X", "no column's")]
    f["comments"] = f["comments"].union(spark.createDataFrame(more, f["comments"].schema))
    specs = discover(**f)
    t, u = specs.orderBy("table").collect()
    assert [(c["column_name"], c["comments"]) for c in t["columns"]] == [
        ("NAME", None), ("ID", "a second"), ("ID", "the key"), ("TOTAL", None), ("AT", None), ("HID", None)
    ]
    assert u["columns"] == []
    joins = [x for x in specs._jdf.queryExecution().optimizedPlan().toString().splitlines() if "Join " in x]
    assert joins and not any("column_name" in x for x in joins)
