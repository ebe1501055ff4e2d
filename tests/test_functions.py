import pytest
from pyspark.sql import functions as F

from loomstat import functions as fn
from loomstat.functions.text import longer_than


def column(spark, values, data_type="string"):
    return spark.createDataFrame([(v,) for v in values], f"v {data_type}")


def test_words_keep_empty_ones_and_end_at_line_ends(spark):
    df = column(spark, ["a  b ", "one\ntwo\r\nthree", ""])
    got = [r[0] for r in df.select(fn.words("v")).collect()]
    assert got == [["a", "", "b", ""], ["one", "two", "", "three"], [""]]


def test_lines_like_a_text_reader(spark):
    got = column(spark, ["a\r\nb\rc\n\nd"]).select(fn.lines("v")).first()[0]
    assert got == ["a", "b", "c", "", "d"]


def test_word_length_counts_utf16_units(spark):
    df = column(spark, ["abc", "abcd", "\U0001F600\U0001F600", "\U0001F600a", "éééé", ""])
    got = [tuple(r) for r in df.select(fn.utf16_length("v"), longer_than(F.col("v"), 3)).collect()]
    assert got == [(3, False), (4, True), (4, True), (3, False), (4, True), (0, False)]


def test_fields_take_the_separator_literally_and_drop_empty_ends(spark):
    df = column(spark, ["1::2::3", "1::2::", "::"])
    assert [r[0] for r in df.select(fn.fields("v", "::")).collect()] == [["1", "2", "3"], ["1", "2"], [""]]
    dotted = column(spark, ["a.b..", "a"]).select(fn.fields("v", "."))
    assert [r[0] for r in dotted.collect()] == [["a", "b"], ["a"]]


def test_strict_cast_trims_and_stops_on_bad_cells(spark):
    df = column(spark, [" 29", "30 "]).select(fn.strict_cast(F.col("v"), "int"))
    assert [r[0] for r in df.collect()] == [29, 30]
    for bad in ["x", "", "3.5", None]:
        with pytest.raises(Exception, match="not a int"):
            column(spark, [bad]).select(fn.strict_cast(F.col("v"), "int")).collect()


def test_strict_cast_stops_without_ansi_mode(spark):
    before = spark.conf.get("spark.sql.ansi.enabled")
    spark.conf.set("spark.sql.ansi.enabled", "false")
    try:
        with pytest.raises(Exception, match="not a double"):
            column(spark, ["NA"]).select(fn.strict_cast(F.col("v"), "double")).collect()
    finally:
        spark.conf.set("spark.sql.ansi.enabled", before)


def test_cast_or_default(spark):
    df = column(spark, ["12.5", "NA", "", None, " 7 "])
    assert [r[0] for r in df.select(fn.cast_or_default(F.col("v"), 40.0)).collect()] == [12.5, 40.0, 40.0, 40.0, 7.0]


def test_thresholds_on_the_cut(spark):
    df = column(spark, [-1.0, 0.0, 0.5, 2.0], "double")
    got = df.select(fn.above(F.col("v")), fn.at_least(F.col("v")), fn.clip_unit(F.col("v"))).collect()
    assert [tuple(r) for r in got] == [(0.0, 0.0, 0.0), (0.0, 0.0, 0.0), (1.0, 1.0, 0.5), (1.0, 1.0, 1.0)]


def test_labels_and_text(spark):
    df = column(spark, [2.5], "double")
    row = df.select(
        fn.log_label(F.col("v") * 0),
        fn.implicit_confidence(F.col("v")),
        fn.number_text(F.col("v"), F.lit(-0.12345)),
        fn.clean_zero(F.lit(-0.0)),
    ).first()
    assert tuple(row)[:3] == (0.0, 0.0, "2.5000,-0.1235")
    assert str(row[3]) == "0.0"
