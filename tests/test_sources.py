from __future__ import annotations

import json

import pytest
from conftest import rows
from pyspark.sql import types as T

from geomart.sources import files
from geomart.sources.tables import CatalogTables, FolderTables, first_rows, load_star, replace_append


def test_csv_encodings_and_bad_lines(spark, tmp_path):
    schema = T.StructType().add("id", "long").add("name", "string")
    path = tmp_path / "a.csv"
    path.write_bytes('id,name\n1,"Café, ""B"""\nx,bad\n'.encode("latin-1"))
    got = files.read_csv(spark, str(path), schema).collect()
    assert got[0].name == 'Café, "B"' and got[0][files.CORRUPT] is None
    assert got[1].id is None and got[1][files.CORRUPT] == "x,bad"
    utf = tmp_path / "b.csv"
    utf.write_text('id,name\n1,"two\nlines é"\n', encoding="utf-8")
    assert files.read_csv(spark, str(utf), schema, "UTF-8", multiline=True).first().name == "two\nlines é"
    with pytest.raises(Exception, match="PATH_NOT_FOUND"):
        files.read_csv(spark, str(tmp_path / "none.csv"), schema).count()


def test_pages(spark, tmp_path):
    place = {
        "fsq_id": "a",
        "name": "n",
        "geocodes": {"main": {"latitude": 1.5, "longitude": 2.5}},
        "categories": [{"id": 7, "name": "Café"}, {"id": 8, "name": "Bar"}],
        "location": {"formatted_address": "x, y", "region": "NY"},
        "price": 2,
        "stats": {"total_tips": 3},
    }
    bare = {"fsq_id": "b", "categories": []}
    for n, results in ((1, [place]), (2, [bare, {"fsq_id": "c"}]), (6, [{"fsq_id": "late"}])):
        (tmp_path / f"p{n}.json").write_text(json.dumps({"area": "Bronx", "page": n, "results": results}))
    flat = {r.fsq_id: r for r in files.flatten_places(files.read_pages(spark, str(tmp_path))).collect()}
    assert set(flat) == {"a", "b", "c", "late"}
    assert files.read_pages(spark, str(tmp_path), max_page=5).count() == 3
    a = flat["a"]
    assert (a.latitude, a.category_main_name, a.category_main_id, a.tips_count, a.area_searched) == (1.5, "Café", 7, 3, "Bronx")
    assert json.loads(a.all_categories) == place["categories"]
    assert flat["b"].category_main_name is None and flat["b"].all_categories == "[]" == flat["c"].all_categories


def test_load_star_twice_equals_once(spark, tmp_path):
    target = FolderTables(spark, str(tmp_path / "star"))
    dim = spark.createDataFrame([(1, "a"), (2, "b")], "k int, v string")
    fact = spark.createDataFrame([(1, 5.0)], "k int, m double")
    tables = {"fact_publication": fact, "dim_host": dim, "dim_date": dim.limit(0)}
    assert load_star(tables, target) == ["dim_host", "fact_publication"]
    load_star(tables, target)
    assert rows(target.read("dim_host")) == rows(dim) and rows(target.read("fact_publication")) == rows(fact)
    assert not target.exists("dim_date")


def test_failed_load_leaves_the_old_tables(spark, tmp_path):
    target = FolderTables(spark, str(tmp_path / "star"))
    good = spark.createDataFrame([(1,)], "k int")
    load_star({"dim_host": good}, target)
    broken = good.selectExpr("raise_error('no') AS k")
    with pytest.raises(Exception, match="no"):
        load_star({"dim_host": good.limit(1), "fact_publication": broken}, target)
    assert rows(target.read("dim_host")) == [(1,)]


def test_replace_append(spark, tmp_path):
    target = FolderTables(spark, str(tmp_path))
    df = spark.createDataFrame([(1,)], "k int")
    replace_append(df, target, "t")
    assert rows(replace_append(df, target, "t")) == [(1,)]
    target.append("t", df)
    assert rows(target.read("t")) == [(1,), (1,)]


def test_catalog_tables(spark, tmp_path):
    spark.sql(f"CREATE DATABASE mart LOCATION '{tmp_path}'")
    try:
        target = CatalogTables(spark, "mart")
        df = spark.createDataFrame([(2,), (1,)], "k int")
        assert not target.exists("dim_host")
        for _ in range(2):
            assert load_star({"dim_host": df}, target) == ["dim_host"]
        assert target.exists("dim_host") and rows(target.read("dim_host")) == [(1,), (2,)]
        assert rows(spark.sql("SELECT * FROM mart.dim_host ORDER BY k LIMIT 1")) == [(1,)]
        assert rows(first_rows(target.read("dim_host"), ["k"], 1)) == [(1,)]
    finally:
        spark.sql("DROP DATABASE mart CASCADE")
