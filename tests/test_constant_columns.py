"""Queries that rank columns, on a table large enough that every day holds the least and the greatest quantity."""

import datetime as dt
import math

import duckdb
import pytest

from checks import registry
from checks.common import r, with_panel
from checks.statistics import panel_mi_sql

CONSTANT = {"t2m_max", "t2m_min", "t2m_range"}


@pytest.fixture(scope="module")
def tables(spark, tmp_path_factory):
    rows = []
    for day in range(60):
        for flag in "AN":
            # 1 and 50 everywhere; the rest differs from day to day
            for line, quantity in enumerate([1, 50, *[2 + (day * day * 7 + ord(flag) + 11 * k) % 48 for k in range(day * 5 % 4)]]):
                at = dt.datetime(2000, 1, 1) + dt.timedelta(days=day)
                price, mixed = quantity * 900.5 + (day * 37 + line * 13) % 101, day * 3 + line * 5 + ord(flag)
                rows.append((day, 1, line, line, float(quantity), price, mixed % 11 / 100, mixed % 7 / 100, flag, "O", at))
    kind = ("l_orderkey long, l_partkey long, l_suppkey long, l_linenumber int, l_quantity double, l_extendedprice double, "
            "l_discount double, l_tax double, l_returnflag string, l_linestatus string, l_shipdate timestamp")
    folder = str(tmp_path_factory.mktemp("tables"))
    spark.createDataFrame(rows, kind).repartition(3).write.parquet(f"{folder}/lineitem.parquet")
    return folder


def both(spark, tables, name):
    """Rows of the query and of its SQL, as dictionaries; the SQL's not-a-number is null."""
    con = duckdb.connect()
    con.execute(f"CREATE VIEW lineitem AS SELECT * FROM '{tables}/lineitem.parquet/*.parquet'")
    cursor = con.execute(registry.oracle_sql()[name])
    names = [d[0] for d in cursor.description]
    sql = [{n: None if isinstance(v, float) and math.isnan(v) else v for n, v in zip(names, row)} for row in cursor.fetchall()]
    return [row.asDict() for row in registry.queries()[name](spark, tables).collect()], sql


def last_if_constant(sql, key):
    """The SQL's rows in its order, but with constant columns, which DuckDB ranks as not-a-number first, at the end."""
    return [*[row for row in sql if row[key] not in CONSTANT], *[row for row in sql if row[key] in CONSTANT]]


def test_ranking(spark, tables):
    got, sql = both(spark, tables, "c5_selection_ranking")
    expected = [{**row, "rank": i} for i, row in enumerate(last_if_constant(sql, "feature"), start=1)]
    assert sorted(got, key=lambda r: r["rank"]) == expected
    assert [r["feature"] for r in expected if r["r"] is None] == ["t2m_max", "t2m_min"]


def test_matrix_holds_all_pairs(spark, tables):
    got, sql = both(spark, tables, "c5_selection_report")
    pairs = {(r["a"], r["b"]): r["r"] for r in got}
    assert len(got) == len(pairs) == 64 and pairs == {(r["a"], r["b"]): r["r"] for r in sql}
    assert pairs["t2m", "t2m_max"] is None and pairs["t2m_min", "t2m_min"] is None and pairs["t2m", "t2m"] == 1.0


def test_feature_list(spark, tables):
    got, sql = both(spark, tables, "m8_feature_list")
    order = [r["feature"] for r in last_if_constant(sorted(sql, key=lambda r: r["rank"]), "feature")]
    assert [r["feature"] for r in sorted(got, key=lambda r: r["rank"])] == order and order[-2:] == ["t2m_max", "t2m_min"]


def test_top_features(spark, tables):
    got, sql = both(spark, tables, "t2_top_features")
    assert sql[0]["abs_r"] is None and got[:3] == [r for r in sql if r["feature"] not in CONSTANT]
    assert len(got) >= 3 and all(r["abs_r"] > 0.01 and r["feature"] not in CONSTANT for r in got)


def test_information_of_the_columns_that_vary(spark, tables):
    """The SQL has no bins for constant columns; the same SQL over the others is what is expected."""
    got = registry.queries()["c5_selection_information"](spark, tables).collect()
    con = duckdb.connect()
    con.execute(f"CREATE VIEW lineitem AS SELECT * FROM '{tables}/lineitem.parquet/*.parquet'")
    varying = ("prectotcorr", "ws10m")
    sql = with_panel(f"SELECT feature, {r('mi')} AS mi FROM (" + " UNION ALL ".join(panel_mi_sql(c, 20) for c in varying) + ")", ("t2m", *varying))
    assert sorted(tuple(row) for row in got) == sorted(con.execute(sql).fetchall()) and len(got) == 2


def test_information_where_no_column_varies(spark, tables, tmp_path):
    """One quantity on one line a day: no column has a correlation, so the report keeps none."""
    one = spark.read.parquet(f"{tables}/lineitem.parquet").where("l_linenumber = 0 AND l_returnflag = 'A'")
    one.write.parquet(f"{tmp_path}/lineitem.parquet")
    got = registry.queries()["c5_selection_information"](spark, str(tmp_path))
    assert got.columns == ["feature", "mi"] and got.collect() == []
    assert registry.queries()["t2_top_features"](spark, str(tmp_path)).collect() == []
    assert len(registry.queries()["m8_feature_list"](spark, str(tmp_path)).collect()) == 7
