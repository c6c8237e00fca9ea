"""Reading of landed files without a schema or with defects, layouts, and partitions."""

import glob

import pyarrow.parquet as pq
import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from brisalake.sources import catalog, readers, writers
from brisalake.sources.lineage import changed_records


def test_merged_json_schema(spark):
    docs = ['{"a": 1, "b": {"c": "x", "d-e": 2.5}}', '{"b": {"f": [1, 2], "g": null}, "h": true}', '{"a": "text", "empty": {}}',
            "not json", None, "[1, 2]", "7", '{"OBJECT": 1, "VOID x": {"VARIANT": "y"}}']
    frame = spark.createDataFrame([(i, d) for i, d in enumerate(docs)], "id int, doc string").repartition(4)
    out = readers.flatten_json(frame, "doc").orderBy("id").collect()
    assert set(out[0].asDict()) == {"id", "doc_a", "doc_b_c", "doc_b_d_e", "doc_b_f", "doc_b_g", "doc_h", "doc_empty", "doc_OBJECT", "doc_VOID x_VARIANT"}
    assert (out[0].doc_a, out[0].doc_b_c, out[0].doc_b_d_e) == ("1", "x", 2.5)
    assert (out[1].doc_b_f, out[1].doc_h, out[2].doc_a, out[7]["doc_VOID x_VARIANT"]) == ([1, 2], True, "text", "y")
    assert all(v is None for k, v in out[3].asDict().items() if k != "id")


def test_json_without_documents(spark):
    frame = spark.createDataFrame([(1, None)], "id int, doc string")
    assert readers.flatten_json(frame, "doc").columns == ["id"]
    assert readers.flatten_json(frame.filter("false"), "doc").count() == 0


SCHEMA = T.StructType([T.StructField("id", T.LongType(), False), T.StructField("nome", T.StringType()), T.StructField("dia", T.DateType()), T.StructField("v", T.DoubleType())])


def test_quarantine(spark, tmp_path):
    for name, lines in (("a", ["id,nome,dia,v", '1,"x, y",2024-01-02,1.5', "2,,,", "3,z,2024-13-45,1", "4,z"]),
                        ("b", ["id,nome,dia,v", "abc,z,2024-01-01,1", "5,z,2024-01-01,1,9", ",n,2024-01-01,2", '6,"a ""q"", b",,0'])):
        (tmp_path / f"{name}.csv").write_text("\n".join(lines) + "\n")
    good, bad = readers.scan_csv_checked(spark, str(tmp_path / "*.csv"), SCHEMA)
    assert sorted(r.id for r in good.collect()) == [1, 2, 6]
    got = {(r._file[-5:], r._record, r._reason) for r in bad.collect()}
    assert got == {("a.csv", "3,z,2024-13-45,1", "tipo:dia"), ("a.csv", "4,z", "campos:2"), ("b.csv", "abc,z,2024-01-01,1", "tipo:id"),
                   ("b.csv", "5,z,2024-01-01,1,9", "campos:5"), ("b.csv", ",n,2024-01-01,2.0", "nulo:id")}
    path = str(tmp_path / "dead")
    readers.quarantine(bad, path, "r1")
    readers.quarantine(bad, path, "r1")  # the same run again
    assert readers.quarantine(bad.limit(2), path, "r2").groupBy("_run").count().count() == 2
    assert spark.read.parquet(path).count() == 7


def test_quarantine_of_empty_files(spark, tmp_path):
    (tmp_path / "a.csv").write_text("id,nome,dia,v\n")
    good, bad = readers.scan_csv_checked(spark, str(tmp_path / "a.csv"), SCHEMA)
    assert good.count() == 0 and bad.count() == 0


def test_first_readable_source(spark, tmp_path):
    missing = ("parquet", lambda: readers.scan_parquet(spark, str(tmp_path / "none")))
    spark.range(3).write.parquet(str(tmp_path / "there"))
    found = readers.first_readable([missing, ("copy", lambda: readers.scan_parquet(spark, str(tmp_path / "there")))])
    assert {r["_source"] for r in found.collect()} == {"copy"}
    with pytest.raises(FileNotFoundError, match="parquet: .*; again: "):
        readers.first_readable([missing, ("again", missing[1])])


def bounds(folder, column):
    """(rows, least, greatest) of a column per file."""
    out = []
    for f in sorted(glob.glob(f"{folder}/*.parquet")):
        m = pq.ParquetFile(f).metadata
        stats = [m.row_group(g).column(next(i for i in range(m.num_columns) if m.schema.column(i).name == column)).statistics for g in range(m.num_row_groups)]
        out.append((m.num_rows, min(s.min for s in stats), max(s.max for s in stats)))
    return out


def test_curve_prunes_by_every_column(spark, tmp_path):
    rows = spark.range(40_000).select((F.xxhash64("id", F.lit(1)) % 1000).alias("a"), (F.rand(5) * 1000).alias("b"),
                                      F.date_add(F.lit("2024-01-01").cast("date"), (F.rand(6) * 300).cast("int")).alias("d"))
    writers.compact_cluster(rows, str(tmp_path / "z"), 64, ["a", "b", "d"])
    for column, low, high in (("a", 100, 110), ("b", 500.0, 510.0)):
        files = bounds(str(tmp_path / "z"), column)
        touched = [f for f in files if f[1] <= high and f[2] >= low]
        assert len(files) > 50 and len(touched) <= len(files) * 0.45


def test_hot_values_spread(spark, tmp_path):
    rows = spark.range(30_000).select(F.when(F.col("id") % 3 > 0, F.lit("hot")).otherwise(F.concat(F.lit("k"), F.col("id") % 500)).alias("k"), F.lit(1).alias("n"))
    writers.compact_cluster(rows, str(tmp_path / "z"), 12, ["k", "n"])
    sizes = sorted(f[0] for f in bounds(str(tmp_path / "z"), "k"))
    assert sum(sizes) == 30_000 and sizes[-1] <= 2 * sizes[len(sizes) // 2]


def test_curve_of_nulls_and_empty_tables(spark, tmp_path):
    rows = spark.createDataFrame([(None, None), (1, None), (None, "b"), (2, "é")], "a int, b string")
    writers.compact_cluster(rows, str(tmp_path / "n"), 2, ["a", "b"])
    assert spark.read.parquet(str(tmp_path / "n")).count() == 4
    writers.compact_cluster(rows.filter("false"), str(tmp_path / "e"), 2, ["a", "b"])
    assert spark.read.schema(rows.schema).parquet(str(tmp_path / "e")).count() == 0


@pytest.fixture
def table_name(spark):
    name = "brisalake_partitions"
    spark.sql(f"DROP TABLE IF EXISTS {name}")
    yield name
    spark.sql(f"DROP TABLE IF EXISTS {name}")


def test_only_brought_partitions_are_registered(spark, tmp_path, table_name):
    path = str(tmp_path / "t")
    rows = spark.createDataFrame([(1, "a", 1), (2, "it's", 1), (3, None, 2)], "id int, p string, q int")
    writers.write_partitioned(rows, path, ["p", "q"])
    first = catalog.external_table(spark, table_name, "id INT, p STRING, q INT", ["p", "q"], path, rows.filter("id < 3"))
    assert {r.id for r in first.collect()} == {1, 2}  # the third is there, but nobody said so
    late = spark.createDataFrame([(4, "b", 1), (1, "a", 1)], "id int, p string, q int")
    writers.write_partitioned(late, path, ["p", "q"])
    assert catalog.add_partitions(spark, table_name, late, ["p", "q"]) == 1
    assert catalog.add_partitions(spark, table_name, rows, ["p", "q"]) == 1
    assert {r.id for r in spark.table(table_name).collect()} == {1, 2, 3, 4}
    assert catalog.add_partitions(spark, table_name, rows, ["p", "q"]) == 0


def test_negative_zero_is_no_change(spark):
    old = spark.createDataFrame([(1, -0.0), (2, 0.0), (3, None), (4, 1.5), (5, float("nan"))], "id int, v double")
    new = spark.createDataFrame([(1, 0.0), (2, -0.0), (3, None), (4, -1.5), (5, float("nan"))], "id int, v double")
    got = {r.id: r.change for r in changed_records(old, new, ["id"]).collect()}
    assert got == {1: "same", 2: "same", 3: "same", 4: "changed", 5: "same"}
