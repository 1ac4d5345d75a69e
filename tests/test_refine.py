import pytest
from pyspark.sql import types as T
from tablelift.plans import refine as R
from tablelift.plans.refine import refine, refine_specs
from tablelift.plans.spec import ColumnSpec, TableSpec


def column(raw, target, kind, **more):
    return ColumnSpec("C", raw, target, kind, **more)


OPEN = column("NUMBER", "STRING", "string")
FIVE = column("NUMBER(5,0)", "INT64", "bigint")
PRICE = column("NUMBER(7,2)", "BIGNUMERIC", "decimal(7,2)")
DAY = column("DATE", "DATETIME", "timestamp_ntz")
TEXT = column("VARCHAR2", "STRING", "string")


@pytest.mark.parametrize("column, scanned, kind, target, note", [
    (OPEN, "decimal(12,3)", "decimal(12,3)", "BIGNUMERIC", R.VAGUE), (OPEN, "int", "bigint", "INT64", R.VAGUE), (OPEN, "float", "double", "FLOAT64", R.VAGUE),
    (OPEN, "decimal(38,10)", "string", "STRING", None), (OPEN, "string", "string", "STRING", None),
    (FIVE, "decimal(5,0)", "bigint", "INT64", None), (FIVE, "bigint", "bigint", "INT64", None), (FIVE, "decimal(30,0)", "decimal(30,0)", "BIGNUMERIC", R.WIDENED),
    (FIVE, "decimal(8,2)", "decimal(21,2)", "BIGNUMERIC", R.WIDENED), (FIVE, "double", "double", "FLOAT64", R.FLOATING),
    (PRICE, "decimal(7,2)", "decimal(7,2)", "BIGNUMERIC", None), (PRICE, "decimal(6,1)", "decimal(7,2)", "BIGNUMERIC", None), (PRICE, "decimal(9,4)", "decimal(9,4)", "BIGNUMERIC", R.WIDENED),
    (PRICE, "decimal(38,36)", "string", "STRING", R.WIDENED), (PRICE, "decimal(38,10)", "decimal(7,2)", "BIGNUMERIC", None), (PRICE, "string", "decimal(7,2)", "BIGNUMERIC", R.AS_TEXT),
    (DAY, "date", "timestamp_ntz", "DATETIME", None), (DAY, "timestamp", "timestamp_ntz", "DATETIME", None), (DAY, "bigint", "bigint", "INT64", R.OTHER_KIND),
    (TEXT, "string", "string", "STRING", None), (TEXT, "binary", "binary", "BYTES", R.OTHER_KIND),
    (column("", "STRING", "string"), "boolean", "boolean", "BOOL", R.SILENT), (column("ENUM8", "STRING", "string"), "smallint", "bigint", "INT64", R.UNKNOWN),
    (column("ENUM8", "STRING", "string"), "array<int>", "string", "STRING", R.UNKNOWN), (column("BINARY_DOUBLE", "FLOAT64", "double"), "decimal(38,10)", "double", "FLOAT64", None),
    (column("XMLTYPE", "STRING", "string", is_transformed=True), "binary", "string", "STRING", None),
])
def test_rules(spark, column, scanned, kind, target, note):
    new, why = R.refined(column, T.DataType.fromDDL(scanned))
    assert (new.spark_type, new.target_type, why) == (kind, target, note)
    # What was refined once stays as it is.
    assert R.refined(new, T.DataType.fromDDL(scanned))[0].spark_type == kind


def test_columns_of_one_side_only(spark):
    spec = TableSpec("S", "T", (ColumnSpec("A", "NUMBER(5,0)", "INT64", "bigint"), ColumnSpec("GONE", "DATE", "DATETIME", "timestamp_ntz"), ColumnSpec("V", "NUMBER", "STRING", "string", is_virtual=True)))
    out = refine(spec, T.StructType.fromDDL("a int, extra decimal(4,1), span interval day to second"))
    assert [c.name for c in out.spec.columns] == ["A", "GONE", "V", "extra", "span"]
    assert [d[1:] for d in out.decisions] == [
        ("bigint", "bigint", None), ("timestamp_ntz", "timestamp_ntz", R.NOT_SCANNED), ("string", "string", None),
        (None, "decimal(4,1)", R.NOT_LISTED), (None, "string", R.NOT_LISTED),
    ]
    assert out.spec.columns[-1].is_transformed


def test_no_row_is_read(spark):
    from pyspark.sql import functions as F

    def source(spark, spec):
        return spark.range(3).select(F.raise_error(F.lit("read")).cast("int").alias("A"))

    spec = TableSpec("S", "T", (ColumnSpec("A", "NUMBER", "STRING", "string"),))
    assert refine_specs(spark, source, [spec])[0].spec.columns[0].spark_type == "bigint"
