"""Metric files are read to their last line."""

from salesmart.operators import macro


def test_metric_file_of_more_than_a_million_lines(spark, tmp_path):
    folder = tmp_path / "metric=m"
    folder.mkdir()
    (folder / "a.csv").write_text("year,month,value\n" + "2020,1,5\n" * 1_000_001 + "2020,2,6\n")
    read = macro.read_metric_dir(spark, str(tmp_path))
    assert read.count() == 1_000_002 and read.where("report_month = 2").count() == 1
