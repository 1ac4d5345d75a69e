import pytest
from tablelift.plans.spec import TableSpec, hashable
from tablelift.plans.types import map_types


def mapped(spark, *rows, **kw):
    df = spark.createDataFrame(list(rows), "data_type string, data_precision int, data_scale int")
    return [tuple(r) for r in map_types(df, **kw).select("target_type", "spark_type", "is_transformed").collect()]


@pytest.mark.parametrize(
    "row, want",
    [
        (("NUMBER(10,0)", None, None), ("INT64", "bigint")),
        (("NUMBER(38,0)", None, None), ("BIGNUMERIC", "decimal(38,0)")),
        (("NUMBER(10,2)", None, None), ("BIGNUMERIC", "decimal(10,2)")),
        (("NUMBER", 18, 0), ("INT64", "bigint")),
        (("NUMBER", 19, 0), ("BIGNUMERIC", "decimal(19,0)")),
        (("NUMBER", None, 0), ("BIGNUMERIC", "decimal(38,0)")),
        (("NUMBER", 2, 5), ("BIGNUMERIC", "decimal(5,5)")),
        (("NUMBER", 10, -3), ("BIGNUMERIC", "decimal(13,0)")),
        (("NUMBER", 38, -3), ("BIGNUMERIC", "string")),
        (("NUMBER", None, 4), ("BIGNUMERIC", "string")),
        (("NUMBER", 5, 50), ("BIGNUMERIC", "string")),
        (("NUMBER", None, None), ("STRING", "string")),
        (("NUMBER", 126, -127), ("FLOAT64", "double")),
        (("FLOAT", 126, None), ("FLOAT64", "double")),
        (("binary_float", None, None), ("FLOAT64", "double")),
        (("NVARCHAR2", None, None), ("STRING", "string")),
        (("DATE", None, None), ("DATETIME", "timestamp_ntz")),
        (("TIMESTAMP(6)", None, None), ("DATETIME", "timestamp_ntz")),
        (("TIMESTAMP(6) WITH TIME ZONE", None, None), ("TIMESTAMP", "timestamp")),
        (("TIMESTAMP(6) WITH LOCAL TIME ZONE", None, None), ("TIMESTAMP", "timestamp")),
        (("BLOB", None, None), ("BYTES", "binary")),
        (("LONG RAW", None, None), ("STRING", "string")),
        (("XMLTYPE", None, None), ("STRING", "string")),
        (("JSON", None, None), ("JSON", "string")),
        (("BOOLEAN", None, None), ("BOOL", "boolean")),
        (("INTERVAL DAY(2) TO SECOND(6)", None, None), ("STRING", "string")),
        (("MDSYS.SDO_GEOMETRY", None, None), ("STRING", "string")),
        (("WHATEVER", None, None), ("STRING", "string")),
    ],
)
def test_mapping(spark, row, want):
    assert mapped(spark, row)[0][:2] == want


def test_number_fallback(spark):
    assert mapped(spark, ("NUMBER", None, None), number_fallback="decimal(38,9)")[0][:2] == ("STRING", "decimal(38,9)")


def test_transformed_types(spark):
    names = [
        "TIMESTAMP(6) WITH TIME ZONE", "XMLTYPE", "JSON", "SDO_GEOMETRY", "ROWID", "UROWID", "INTERVAL YEAR TO MONTH",
        "DATE", "VARCHAR2", "SYS.XMLTYPE",
    ]
    got = [t for _, _, t in mapped(spark, *[(n, None, None) for n in names])]
    assert got == [True] * 7 + [False] * 3


def test_unhashed_types():
    assert not any(map(hashable, ["CLOB", "blob", "LONG RAW", "LONG", "XMLTYPE", "SDO_GEOMETRY", " NCLOB (10)"]))
    assert all(map(hashable, ["RAW(16)", "VARCHAR2(10)", "NUMBER", "ROWID", "TIMESTAMP(6) WITH TIME ZONE", "JSON"]))


def test_spec_from_frame(spark):
    df = spark.sql("SELECT 1 AS a, 'x' AS b, interval '1-2' year to month AS i")
    spec = TableSpec.from_frame(
        df, "S", "T", raw_types={"b": "CLOB"}, virtual={"v": "a + 1"}, pk_cols=["a"], index_cols=["b", "a", "c", "d", "e"]
    )
    assert [c.name for c in spec.physical] == ["a", "b", "i"]
    assert spec.needs_view and spec.physical_name == "T_PHYSICAL"
    assert spec.cluster_cols == ("a", "b", "c", "d")
    assert spec.columns[2].spark_type == "string" and spec.columns[2].is_transformed
