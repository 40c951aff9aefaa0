"""Headers of CSV files, kept in a catalog."""

import os

import pytest
from pyspark.sql import DataFrameReader

from feedloom import schemas as S
from feedloom.sources import csvfeeds


@pytest.fixture()
def opened(monkeypatch):
    """Names of the files that were read as text."""
    seen, text = [], DataFrameReader.text

    def spy(self, paths, *args, **kwargs):
        seen.extend(os.path.basename(p) for p in ([paths] if isinstance(paths, str) else paths))
        return text(self, paths, *args, **kwargs)
    monkeypatch.setattr(DataFrameReader, "text", spy)
    return seen


def test_only_new_and_changed_files_are_opened(spark, tmp_path, rows, opened):
    land, seen = tmp_path / "in", str(tmp_path / "seen")
    land.mkdir()

    def read():
        opened.clear()
        return rows(csvfeeds.read_csv_by_name(spark, str(land), S.SEED_AREAS, marker="region",
                                              glob="*.csv", catalog=seen))

    (land / "a.csv").write_text("region,coord\neast,1\n")
    (land / "none.csv").write_text("")
    assert read() == [("east", "1")] and opened == ["a.csv"]
    assert read() == [("east", "1")] and opened == []
    (land / "b.csv").write_text("x,coord,region\n0,2,west\n")
    assert read() == [("east", "1"), ("west", "2")] and opened == ["b.csv"]
    # A file written anew under its name has another length or time.
    (land / "a.csv").write_text("coord,region\n3,north and south\n")
    assert read() == [("north and south", "3"), ("west", "2")] and opened == ["a.csv"]
    assert spark.read.parquet(seen).count() == 3


def test_a_file_without_a_header_is_not_remembered(spark, tmp_path):
    land, seen = tmp_path / "in", str(tmp_path / "seen")
    land.mkdir()
    (land / "a.csv").write_text("region,coord\neast,1\n")
    (land / "b.csv").write_text("east,1\n")
    for _ in range(2):
        with pytest.raises(ValueError, match="no header with 'region'"):
            csvfeeds.headers(spark, str(land), "region", catalog=seen)
    (land / "b.csv").write_text("region\nwest\n")
    got = dict(csvfeeds.headers(spark, str(land), "region", catalog=seen))
    assert sorted(got.values()) == ["region", "region,coord"]
    # Another marker asks anew, and an empty folder has no headers.
    assert set(csvfeeds.headers(spark, str(land / "a.csv"), "coord", catalog=seen))
    (tmp_path / "empty").mkdir()
    assert csvfeeds.headers(spark, str(tmp_path / "empty"), "region", catalog=seen) == []
