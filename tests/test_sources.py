import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from starloom.sources import (
    append_table,
    normalise_headers,
    read_delimited,
    read_delimited_inferred,
    read_format,
    read_label_list,
    read_parquet,
    run_sql,
    write_table,
)
from starloom.session import scratch_path
from tests.conftest import values

SCHEMA = T.StructType(
    [T.StructField("code", T.StringType()), T.StructField("n", T.IntegerType()), T.StructField("x", T.DoubleType())]
)


def test_delimited_with_declared_schema(spark, tmp_path):
    (tmp_path / "a.csv").write_text('any;header;here\nA1;7;1.5\n"B;2";seven;\n;8;2\n', "utf-8")
    found = read_delimited(spark, str(tmp_path / "a.csv"), SCHEMA, ";")
    assert values(found) == [("A1", 7, 1.5), ("B;2", None, None), (None, 8, 2.0)]


def test_delimited_inferred(spark, tmp_path):
    (tmp_path / "a.csv").write_bytes("code|City\n1|Orléans\n2|\n".encode("latin-1"))
    found = read_delimited_inferred(spark, str(tmp_path / "a.csv"), "|")
    assert values(found) == [(1, "Orléans"), (2, None)]


def test_headers(spark):
    df = spark.createDataFrame([(1, 2)], ["  'Code' ", "\tCity\t"])
    assert normalise_headers(df).columns == ["Code", "City"]
    assert normalise_headers(df, lower=True).columns == ["code", "city"]


def test_label_lists(spark, tmp_path):
    (tmp_path / "country.csv").write_text("   Code = Country\n   582 =  'MEXICO Air'\n     0  =  'ARGENTINA '\n")
    found = read_label_list(spark, str(tmp_path / "country.csv"), {"Code": "long"})
    assert found.columns == ["Code", "Country"]
    assert values(found) == [(582, "'MEXICO Air'"), (0, "'ARGENTINA '")]

    (tmp_path / "state.csv").write_text("Code = City\n'AL'='ALABAMA'\n\t'WY'='WYOMING' \n\t'99'='All Other Codes'")
    found = read_label_list(spark, str(tmp_path / "state.csv"), lower_headers=True)
    assert found.columns == ["code", "city"]
    assert values(found) == [("'AL'", "'ALABAMA'"), ("'WY'", "'WYOMING'"), ("'99'", "'All Other Codes'")]


def test_any_format(spark, tmp_path):
    spark.range(3).write.orc(str(tmp_path / "t"))
    assert read_format(spark, str(tmp_path / "t"), "orc").count() == 3
    spark.range(3).write.json(str(tmp_path / "j"))
    assert read_format(spark, str(tmp_path / "j"), "json", {"primitivesAsString": "true"}).dtypes == [("id", "string")]


def test_sql_over_tables(spark):
    found = run_sql(spark, "SELECT id FROM numbers WHERE id > :least", {"numbers": spark.range(5)}, least=2)
    assert sorted(values(found)) == [(3,), (4,)]
    assert run_sql(spark, "SELECT 1 AS one").columns == ["one"]


def rows(spark, *codes):
    return spark.createDataFrame([(code, i, float(i)) for i, code in enumerate(codes)], SCHEMA)


def test_partition_values_keep_their_type(spark, tmp_path):
    path = str(tmp_path / "t")
    write_table(rows(spark, "060", "A1", None), path, ["code"])
    found = read_parquet(spark, path, SCHEMA)
    assert found.schema == SCHEMA
    assert sorted(values(found), key=str) == [("060", 0, 0.0), ("A1", 1, 1.0), (None, 2, 2.0)]


def test_appended_rows_take_the_type_of_the_table(spark, tmp_path):
    path = str(tmp_path / "t")
    write_table(rows(spark, "a"), path, ["code"])
    wide = spark.createDataFrame([("b", 5, 6)], "code string, n long, x int")
    append_table(wide, path, SCHEMA, ["code"])
    found = read_parquet(spark, path, SCHEMA)
    assert sorted(values(found)) == [("a", 0, 0.0), ("b", 5, 6.0)]
    with pytest.raises(Exception, match="overflow|OVERFLOW"):
        append_table(spark.createDataFrame([("b", 2**40, 6)], "code string, n long, x int"), path, SCHEMA, ["code"])


def test_overwrite_replaces_all_or_only_the_partitions_written(spark, tmp_path):
    path = str(tmp_path / "t")
    write_table(rows(spark, "a", "b"), path, ["code"])
    write_table(rows(spark, "b"), path, ["code"], refresh_partitions=True)
    assert sorted(values(read_parquet(spark, path, SCHEMA))) == [("a", 0, 0.0), ("b", 0, 0.0)]
    write_table(rows(spark, "c"), path, ["code"])
    assert values(read_parquet(spark, path, SCHEMA)) == [("c", 0, 0.0)]
    flat = str(tmp_path / "flat")
    write_table(rows(spark, "a"), flat)
    write_table(rows(spark, "b"), flat)
    assert values(read_parquet(spark, flat)) == [("b", 0, 0.0)]


def test_small_partitions_get_one_file_and_big_ones_several(spark, tmp_path, settings):
    settings(spark__sql__adaptive__advisoryPartitionSizeInBytes="20000", spark__sql__shuffle__partitions="200")
    df = spark.range(20_000).select(
        F.when(F.col("id") % 3 == 0, F.lit("hot")).otherwise((F.col("id") % 20).cast("string")).alias("code"),
        F.col("id").cast("int").alias("n"),
        F.rand(1).alias("x"),
    )
    path = str(tmp_path / "t")
    write_table(df.repartition(16), path, ["code"], sort_by=["n"])
    files = {folder.name: len(list(folder.glob("*.parquet"))) for folder in (tmp_path / "t").glob("code=*")}
    assert files["code=hot"] > 2
    assert [count for name, count in files.items() if name != "code=hot"] == [1] * 20
    assert read_parquet(spark, path, SCHEMA).count() == 20_000


def test_scratch_is_in_the_shared_folder(spark, settings):
    first, second = scratch_path(spark, "x"), scratch_path(spark, "x")
    assert first != second
    shared = spark.conf.get("spark.checkpoint.dir", None)
    assert shared is None or first.startswith(shared)
