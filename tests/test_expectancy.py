"""Lookup tables: published values, the full state grid, end-of-game rules."""

import pytest
from pyspark.sql import functions as F

from diamondlake.functions import expectancy as ex

GOLDEN = [
    (7, "bot", 2, "13", 0.943),
    (7, "bot", 3, "1", 0.963),
    (7, "bot", 0, "0", 0.512),
    (5, "bot", 0, "0", 0.515),
    (1, "top", 0, "0", 0.449),
    (15, "top", -9, "123", 0.139),
    (6, "bot", 9, "0", 0.25 * 0.866 + 0.75 * 0.984),
]


def test_published_values(spark):
    rows = spark.createDataFrame(GOLDEN, "i int, h string, s int, b string, want double")
    got = rows.select("want", ex.win_expectancy(F.col("i"), F.col("h"), F.col("s"), F.col("b")).alias("we")).collect()
    for row in got:
        assert row.we == pytest.approx(row.want, abs=1e-12)


def test_unknown_state_is_null(spark):
    rows = spark.createDataFrame([(7, "mid", 0, "0"), (7, "bot", 0, "31"), (7, None, 0, "0"), (7, "bot", None, "0"), (None, "bot", 0, "0")], "i int, h string, s int, b string")
    got = rows.select(ex.win_expectancy(F.col("i"), F.col("h"), F.col("s"), F.col("b")).alias("we")).collect()
    assert [r.we for r in got] == [None] * 5


def test_run_expectancy(spark):
    rows = spark.createDataFrame([(0, "0"), (2, "123"), (3, "0"), (4, "123"), (1, "x")], "o int, b string")
    got = [r.re for r in rows.select(ex.run_expectancy(F.col("o"), F.col("b")).alias("re")).collect()]
    assert got == [0.549, 0.729, 0.0, 0.0, None]
    assert len(ex.RUN_EXPECTANCY) == 8 and all(v >= 0 for cells in ex.RUN_EXPECTANCY.values() for v in cells)


def test_end_rules(spark):
    rows = spark.createDataFrame(
        [(9, "bot", 1, 1, "0", 1.0), (12, "bot", 0, 3, "0", 0.5), (12, "top", 2, 3, "0", 1.0), (12, "bot", -1, 3, "0", 0.0),
         (9, "top", 1, 1, "0", 0.682), (10, "bot", 1, 1, "0", 0.795), (12, "bot", 0, 2, "0", 0.512)],
        "i int, h string, s int, o int, b string, want double",
    )
    columns = [F.col(c) for c in "ihsob"]
    for row in rows.select("want", ex.win_expectancy_with_end(*columns).alias("we")).collect():
        assert row.we == pytest.approx(row.want, abs=1e-12)


@pytest.fixture(scope="module")
def grid(spark):
    one = spark.range(1)
    for name, values in (("i", list(range(1, 13))), ("h", ex.HALVES), ("s", list(range(-4, 5))), ("o", [0, 1, 2]), ("b", ex.BASE_STATES)):
        one = one.withColumn(name, F.explode(F.lit(values)))
    return one.withColumn("we", ex.win_expectancy(F.col("i"), F.col("h"), F.col("s"), F.col("b"))).cache()


def test_grid_bounds_and_order(grid):
    assert grid.count() == 12 * 2 * 9 * 3 * 8
    assert grid.where(~F.col("we").between(0, 1) | F.col("we").isNull()).isEmpty()
    cells = {(r.i, r.h, r.s, r.b): r.we for r in grid.where("o = 1").collect()}
    for h in ex.HALVES:
        for b in ex.BASE_STATES:
            assert all(cells[i, h, s, b] <= cells[i, h, s + 1, b] for i in (3, 5, 7) for s in range(-4, 4))
            assert cells[3, h, 1, b] <= cells[7, h, 1, b]
    assert all(cells[i, "bot", 0, "0"] > cells[i, "top", 0, "0"] for i in (3, 5, 7))
    assert grid.groupBy("i", "h", "s", "b").agg(F.countDistinct("we").alias("n")).where("n > 1").isEmpty()


def test_own_table(spark, tmp_path):
    path = tmp_path / "we.csv"
    text = "anchor_inning,half,base_state,minus4,minus3,minus2,minus1,tied,plus1,plus2,plus3,plus4\n"
    path.write_text(text + "3,top,0" + ",0.2" * 9 + "\n7,top,0" + ",0.6" * 9 + "\n")
    table = ex.load_win_table(str(path))
    rows = spark.createDataFrame([(5, "top", 0, "0"), (5, "bot", 0, "0")], "i int, h string, s int, b string")
    got = [r.we for r in rows.select(ex.win_expectancy(F.col("i"), F.col("h"), F.col("s"), F.col("b"), table).alias("we")).collect()]
    assert got == [pytest.approx(0.4), None]
