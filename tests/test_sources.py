import pytest
from pyspark.sql import functions as F

from loomframe.sources import files


def lines(spark, *texts):
    return spark.createDataFrame([(t,) for t in texts], "value string")


def test_ratings_keep_good_lines_and_report_bad_ones(spark):
    good, bad = files.parse_ratings(lines(spark, "1::2::3.5::99", "1::2", "a::2::3::4", "1::2::3::4::5"))
    assert [tuple(r) for r in good.collect()] == [(1, 2, 3.5, 99)]
    assert {r[0] for r in bad.collect()} == {"1::2", "a::2::3::4", "1::2::3::4::5"}


def test_strict_ratings_fail(spark):
    good, _ = files.parse_ratings(lines(spark, "1::2"), strict=True)
    with pytest.raises(Exception, match="malformed rating line"):
        good.collect()


def test_tab_ratings(spark):
    good, _ = files.parse_ratings(lines(spark, "196\t242\t3\t881250949"), sep="\t")
    assert [tuple(r) for r in good.collect()] == [(196, 242, 3.0, 881250949)]


def test_labelled_text_keeps_the_whole_message(spark):
    good, bad = files.parse_labelled(lines(spark, "ham see you = later", "spam"), " ")
    row = good.first()
    assert (row["label"], row["text"], row["tokens"]) == ("ham", "see you = later", ["see", "you", "=", "later"])
    assert [r[0] for r in bad.collect()] == ["spam"]
    marked, _ = files.parse_labelled(lines(spark, "3[-]up [-] down"), "[-]")
    assert tuple(marked.select("label", "text").first()) == ("3", "up [-] down")


def test_chinese_text_in_its_own_charset(spark, tmp_path):
    (tmp_path / "a.txt").write_bytes("利润缩减\n股价上涨".encode("gb2312"))
    good, bad = files.read_encoded_lines(spark, str(tmp_path))
    assert sorted(r["text"] for r in good.collect()) == ["利润缩减", "股价上涨"] and bad.count() == 0


def test_line_numbers_across_file_blocks(spark, tmp_path):
    texts = [f"line {i} " + "x" * (i % 50) for i in range(5000)]
    (tmp_path / "a.txt").write_text("\n".join(texts) + "\n")
    before = spark.conf.get("spark.sql.files.maxPartitionBytes")
    spark.conf.set("spark.sql.files.maxPartitionBytes", "16384")
    try:
        numbered = files.read_numbered_lines(spark, str(tmp_path))
        assert spark.read.text(str(tmp_path)).rdd.getNumPartitions() > 4
        wrong = numbered.filter(F.split("value", " ")[1].cast("bigint") + 1 != F.col("line_number"))
        assert (numbered.count(), wrong.count()) == (5000, 0)
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", before)


def test_carriage_return_lines_with_inferred_types(spark, tmp_path):
    (tmp_path / "iris.csv").write_text("5.1,3.5,setosa\r4.9,3.0,setosa\r7.0,3.2,versicolor\r")
    rows = files.read_csv_inferred(spark, str(tmp_path / "iris.csv"), header=False)
    assert rows.count() == 3
    assert [t for _, t in rows.dtypes] == ["double", "double", "string"]


def test_malformed_csv_row_becomes_null_not_failure(spark, tmp_path):
    (tmp_path / "t.csv").write_text("id,text,label\n7,fine,1.0\n8,missing-4.0\n")
    rows = files.read_csv(spark, str(tmp_path / "t.csv"), "id int, text string, label double", header=True)
    assert [tuple(r) for r in rows.orderBy("id").collect()] == [(7, "fine", 1.0), (8, "missing-4.0", None)]


def test_encoded_lines_in_blocks_and_a_broken_one(spark, tmp_path):
    lines = [f"第{k}行 利润缩减" * (k % 9 + 1) for k in range(3000)] + [""]
    raw = "\n".join(lines).encode("gb2312").split(b"\n")
    raw[1234] = raw[1234][:3] + b"\xff" + raw[1234][3:]
    (tmp_path / "a.txt").write_bytes(b"\n".join(raw) + b"\n")
    before = spark.conf.get("spark.sql.files.maxPartitionBytes")
    spark.conf.set("spark.sql.files.maxPartitionBytes", "16384")
    try:
        good, bad = files.read_encoded_lines(spark, str(tmp_path))
        assert good.rdd.getNumPartitions() > 4
        assert sorted(r["text"] for r in good.collect()) == sorted(lines[:1234] + lines[1235:])
        assert [bytes(r["raw"]) for r in bad.collect()] == [raw[1234]]
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", before)
    files.write_encoded_lines(good.limit(50), str(tmp_path / "out"), "text")
    again, broken = files.read_encoded_lines(spark, str(tmp_path / "out"))
    assert again.count() == 50 and broken.count() == 0
    with pytest.raises(ValueError):
        files.read_encoded_lines(spark, str(tmp_path), "utf-16")
