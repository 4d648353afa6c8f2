"""Queries that write files: rows are written by the tasks, and never pass through the driver."""

import json

import pytest
from pyspark.sql.classic.dataframe import DataFrame

from marlspan.plans import catalog
from marlspan.sources import records

SF = "/root/testdata/sf0.001"
WRITTEN = ["web_dataset", "shard_index", "chunk_lookup", "zip_lookup", "zip_introspection", "source_archives", "json_array_scan"]


@pytest.mark.parametrize("name", WRITTEN)
def test_rows_do_not_pass_through_the_driver(spark, monkeypatch, name):
    def refuse(*_, **__):
        raise AssertionError("rows go to the driver")

    for how in ("toLocalIterator", "toPandas", "toArrow"):
        monkeypatch.setattr(DataFrame, how, refuse)
    assert catalog.QUERIES[name](spark, SF).count() > 0


def test_archives(spark, tmp_path):
    data = [(f"a{i % 2}.zip", f"images/{i}.png", bytes([i])) for i in range(6)]
    told = records.write_archives(spark.createDataFrame(data, "archive string, member string, data binary"), str(tmp_path), "x").collect()
    assert sorted(map(tuple, told)) == [("a0.zip", 3), ("a1.zip", 3)] and sorted(p.name for p in tmp_path.iterdir()) == ["a0.zip", "a1.zip"]
    assert sorted(map(tuple, records.zip_layouts(spark.createDataFrame(told), str(tmp_path)).collect())) == [(f"a{i}.zip", "root/meta_data_x.json", "x", "root/") for i in (0, 1)]
    asked = [(0, "a0.zip", "root/images/4.png"), (1, "a1.zip", "root/images/4.png"), (2, None, "root/images/4.png"), (3, "a9.zip", "root/images/4.png"), (4, "a1.zip", None), (5, "a1.zip", "root/images/5.png")]
    got = records.zip_members(spark.createDataFrame(asked, "k int, archive string, member string"), str(tmp_path), of="archive").collect()
    assert {r.k: r.data and bytes(r.data) for r in got} == {0: b"\4", 1: None, 2: None, 3: None, 4: None, 5: b"\5"}


@pytest.mark.parametrize("compact", [False, True])
def test_an_array_is_the_rows_in_order(spark, tmp_path, compact):
    df = spark.range(0, 2500, 1, 3).selectExpr("id", "array(named_struct('a', string(id), 'b', 'h\u00e9 \n,\"')) AS x", "map('k', id) AS m", "IF(id % 2 = 0, NULL, 1.5D) AS d")
    n = records.export_array(df.where("id NOT BETWEEN 800 AND 1700"), str(tmp_path / "a.json"), compact)
    want = [r.asDict(recursive=True) for r in df.collect() if not 800 <= r.id <= 1700]
    own = {"separators": (",", ":")} if compact else {"indent": 2}
    assert n == len(want) and (tmp_path / "a.json").read_text() == json.dumps(want, ensure_ascii=False, **own)
    assert records.export_array(df.where("false"), str(tmp_path / "b.json"), compact) == 0 and (tmp_path / "b.json").read_text() == "[]"
