import pytest
from pyspark.sql import functions as F

from loomstat import sources
from loomstat.plans import jobs
from loomstat.session import scratch_path, shared_folder
from loomstat.sources.files import unpack_vector


def write(tmp_path, name, text):
    path = tmp_path / name
    path.write_text(text)
    return str(path)


def test_people_are_trimmed_and_extra_fields_ignored(spark, tmp_path):
    path = write(tmp_path, "p.txt", "Ann, 29, 50000\nBob,21 , 40000,extra\n")
    df = sources.read_delimited(spark, path, [("name", "string"), ("age", "int"), ("salary", "int")])
    assert [tuple(r) for r in df.collect()] == [("Ann", 29, 50000), ("Bob", 21, 40000)]
    assert [r["name"] for r in df.filter("age > 21").collect()] == ["Ann"]


@pytest.mark.parametrize("line", ["1::2", "1::x::3", "1::2::"])
def test_short_or_bad_records_stop_the_job(spark, tmp_path, line):
    path = write(tmp_path, "r.txt", f"1::2::3\n{line}\n")
    df = sources.read_delimited(spark, path, [("user", "int"), ("product", "int"), ("rating", "double")], "::")
    with pytest.raises(Exception, match="expected 3 fields|not a int"):
        df.collect()


def test_double_rows(spark, tmp_path):
    path = write(tmp_path, "s.txt", "1 0.8\n2 -3e2 5 \n")
    got = [r[0] for r in sources.read_double_rows(spark, path, " ").collect()]
    assert got == [[1.0, 0.8], [2.0, -300.0, 5.0]]
    with pytest.raises(Exception, match="not a double"):
        sources.read_double_rows(spark, write(tmp_path, "b.txt", "1  2\n"), " ").collect()


def test_csv_by_name_drops_repeated_headers_and_keeps_quotes(spark, tmp_path):
    text = 'id,note,full_sq\n1,"a, ""b""",43\nid,note,full_sq\n2,,NA\n,x,9\n'
    path = write(tmp_path, "c.csv", text)
    df = sources.read_csv_by_name(spark, path, ["full_sq", "note"])
    assert [tuple(r) for r in df.collect()] == [("43", 'a, "b"'), ("NA", None), ("9", "x")]
    with pytest.raises(ValueError, match="life_sq"):
        sources.read_csv_by_name(spark, path, ["life_sq"])


def test_sales_cells(spark):
    cells = spark.createDataFrame(
        [("100", "NA", "7"), ("200", None, "8"), ("300", "55", "9")], "price_doc string, full_sq string, life_sq string"
    )
    assert [r["full_sq"] for r in jobs.sales_rows(cells).collect()] == [40.0, 40.0, 55.0]
    bad = spark.createDataFrame([("100", "5", "")], cells.schema)
    with pytest.raises(Exception, match="not a double"):
        jobs.sales_rows(bad).collect()


def test_libsvm_indices_start_at_zero(spark, tmp_path):
    path = write(tmp_path, "d.txt", "1 1:2 3:4\n0 2:5\n")
    for width in (3, -1):
        df = unpack_vector(sources.read_libsvm(spark, path, width), "features", ["a", "b", "c"])
        assert sorted(tuple(r) for r in df.collect()) == [(0.0, 0.0, 5.0, 0.0), (1.0, 2.0, 0.0, 4.0)]


def test_labeled_dense(spark, tmp_path):
    path = write(tmp_path, "t.csv", "1,0.5 2\n0, 3 4 \n")
    got = [tuple(r) for r in sources.read_labeled_dense(spark, path).collect()]
    assert got == [(1.0, [0.5, 2.0]), (0.0, [3.0, 4.0])]


def test_min_partitions(spark, tmp_path):
    path = write(tmp_path, "l.txt", "a\n\nb\n")
    assert sources.read_lines(spark, path, 6).rdd.getNumPartitions() == 6
    assert sources.read_lines(spark, path).count() == 3


def test_word_count_sink_is_ordered_and_replaced(spark, tmp_path):
    lines = spark.createDataFrame([("blue blue cow",), ("",), ("blue  Cows cows the sing sing ",)], "value string")
    out = str(tmp_path / "results")
    for _ in range(2):
        top = jobs.count_words(lines, "value", out)
    assert [tuple(r) for r in top.collect()] == [("blue", 3), ("sing", 2), ("Cows", 1), ("cows", 1)]
    text = []
    for part in sorted((tmp_path / "results").glob("part-*")):
        text += part.read_text().splitlines()
    assert text == ["(3,blue)", "(2,sing)", "(1,Cows)", "(1,cows)"]


def test_scratch_lies_in_the_sessions_folder(spark):
    named = spark.conf.get("spark.checkpoint.dir", None)
    if named:
        assert shared_folder(spark) == named.rstrip("/")
    a, b = scratch_path(spark, "x"), scratch_path(spark, "x")
    assert a != b and a.startswith(shared_folder(spark))
