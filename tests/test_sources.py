import datetime as dt

import pytest
from pyspark.sql import functions as F

from marketlens import schemas
from marketlens.functions.placement import keep_members
from marketlens.sources import landing, tables, watchlist as wl

DAY0 = dt.date(2024, 1, 2)


def test_watchlist_sets(spark, tmp_path):
    assert wl.category(wl.DEFAULT_WATCHLIST, wl.UNIVERSE) == ["CVX", "NVDA", "PG", "TSLA", "XOM"]
    assert len(wl.ingest_set(watchlist=wl.DEFAULT_WATCHLIST)) == 10
    assert wl.ingest_set(tmp_path / "missing.yml") == ["NVDA", "TSLA", "^GSPC"]
    (tmp_path / "w.json").write_text('{"equities": ["B", "A", "A"], "spotlight_tickers": ["Z"]}')
    assert wl.ingest_set(tmp_path / "w.json") == ["A", "B"]
    pytest.importorskip("yaml")
    (tmp_path / "w.yml").write_text("equities:\n  - B  # note\n  - ^A\nuniverse_tickers: ['B']\n")
    assert wl.ingest_set(tmp_path / "w.yml") == ["B", "^A"]
    frame = wl.watchlist_frame(spark, wl.load_watchlist(tmp_path / "w.yml"))
    assert {tuple(r) for r in frame.collect()} == {
        ("equities", "B"), ("equities", "^A"), ("universe_tickers", "B"),
    }


def test_keep_members_short_and_long_lists(spark):
    df = spark.createDataFrame([("A",), ("B",)], "ticker string")
    assert [r.ticker for r in keep_members(df, ["A"]).collect()] == ["A"]
    long = ["A"] + [f"X{i}" for i in range(2000)]
    assert [r.ticker for r in keep_members(df, long).collect()] == ["A"]


def _wide(spark):
    return spark.createDataFrame(
        [
            (dt.datetime(2024, 1, 2), 1.0, 2.0, 0.5, 1.5, 10, 7.0, None),
            (dt.datetime(2024, 1, 3), None, None, None, None, None, None, 9),
        ],
        "Date timestamp, A_Open double, A_High double, A_Low double, A_Close double, A_Volume long,"
        " `^B.X_Close` double, `^B.X_Volume` long",
    )


def test_wide_to_long(spark):
    rows = landing.wide_to_long(_wide(spark)).orderBy("date", "ticker").collect()
    assert [tuple(r) for r in rows] == [
        ("A", DAY0, 1.0, 2.0, 0.5, 1.5, 1.5, 10),
        ("^B.X", DAY0, None, None, None, 7.0, 7.0, None),
        ("^B.X", dt.date(2024, 1, 3), None, None, None, None, None, 9),
    ]
    assert landing.wide_to_long(_wide(spark), drop_empty_bars=False).count() == 4
    with pytest.raises(ValueError):
        landing.wide_to_long(_wide(spark).select("Date"))


def test_wide_to_long_does_not_shuffle(spark):
    plan = landing.wide_to_long(_wide(spark))._jdf.queryExecution().executedPlan().toString()
    assert "Exchange" not in plan


@pytest.mark.parametrize("fmt", ["parquet", "csv"])
def test_read_landed(spark, tmp_path, fmt):
    rows = [("A", DAY0 + dt.timedelta(days=i), 1.0, 1.0, 1.0, 1.0, 1.0, i) for i in range(4)]
    rows += [("B", DAY0, 2.0, 2.0, 2.0, 2.0, 2.0, 5)]
    path = str(tmp_path / "landing")
    spark.createDataFrame(rows, schemas.LANDED_BARS).write.option("header", True).format(fmt).save(path)
    got = landing.read_landed(
        spark, path, fmt, ["A"], start=DAY0 + dt.timedelta(days=1), end=DAY0 + dt.timedelta(days=3)
    )
    assert sorted(r.volume for r in got.collect()) == [1, 2]
    assert landing.read_landed(spark, path, fmt).count() == 5


def test_old_bars_are_not_left_out(spark, tmp_path):
    rows = [("A", dt.date(y, 1, 2), 1.0, 1.0, 1.0, 1.0, 1.0, y) for y in (1999, 2023, 2024)]
    spark.createDataFrame(rows, schemas.LANDED_BARS).write.parquet(str(tmp_path / "landing"))
    assert landing.read_landed(spark, str(tmp_path / "landing"), tickers=["A"]).count() == 3


def test_unknown_wide_columns_are_an_error(spark):
    wide = _wide(spark).withColumn("C_Dividend", F.lit(1.0))
    with pytest.raises(ValueError, match="C_Dividend"):
        landing.wide_to_long(wide)


def _bars(spark, ids, date=DAY0, ticker="A", price=1.0):
    rows = [(i, ticker, date, price, price, price, price, price, 1, dt.datetime(2024, 1, 1)) for i in ids]
    return spark.createDataFrame(rows, schemas.BRONZE_BARS)


def test_tables_round_trip(spark, tmp_path):
    root, name = str(tmp_path), "bronze_price_history"
    tables.create_tables(spark, root)
    for table, (schema, _) in schemas.TABLES.items():
        empty = tables.read(spark, root, table)
        assert empty.columns == schema.fieldNames() and empty.count() == 0
    tables.append(_bars(spark, [1, 2]), root, name)
    tables.append(_bars(spark, [3], dt.date(2025, 1, 2)), root, name)
    assert tables.read(spark, root, name).count() == 3
    assert tables.read(spark, root, name, first_year=2025).count() == 1
    assert tables.years_of(tables.read(spark, root, name), name) == [2024, 2025]
    # a table can be read and have some of its years replaced in one job
    kept = tables.read(spark, root, name, 2024, 2024).filter("id = 2")
    tables.replace_years(kept, root, name)
    assert sorted(r.id for r in tables.read(spark, root, name).collect()) == [2, 3]
    # years that end up without rows are given by name
    tables.replace_years(_bars(spark, [4]), root, name, years=[2025])
    assert [r.id for r in tables.read(spark, root, name).collect()] == [4]
    assert tables.version(spark, root, name).highest == 4
    # creating again leaves contents alone, an initial setup empties them
    tables.create_tables(spark, root)
    assert tables.read(spark, root, name).count() == 1
    tables.create_tables(spark, root, initial_setup=True)
    assert tables.read(spark, root, name).count() == 0
    with pytest.raises(KeyError):
        tables.table_path(root, "nope")


def test_year_filter_prunes_partitions(spark, tmp_path):
    root, name = str(tmp_path), "bronze_price_history"
    tables.append(_bars(spark, [1]), root, name)
    tables.append(_bars(spark, [2], dt.date(2025, 1, 2)), root, name)
    for got in (tables.read(spark, root, name, 2025, 2025), tables.read(spark, root, name, years=[2025])):
        files = got.inputFiles()
        assert files and all("part_year=2025" in f for f in files)
        assert [r.id for r in got.collect()] == [2]


def test_a_change_that_breaks_off_leaves_the_table(spark, tmp_path, monkeypatch):
    root, name = str(tmp_path), "bronze_price_history"
    tables.append(_bars(spark, [1]), root, name)
    before = tables.read(spark, root, name)

    def lost(*_):
        raise OSError("the driver is lost")

    with monkeypatch.context() as patch:
        patch.setattr(tables, "_commit", lost)
        with pytest.raises(OSError):
            tables.replace_years(_bars(spark, [2]), root, name)
    assert [r.id for r in tables.read(spark, root, name).collect()] == [1]
    # a reader of the version before a change goes on reading it
    tables.replace_years(_bars(spark, [3]), root, name)
    assert [r.id for r in before.collect()] == [1]
    assert [r.id for r in tables.read(spark, root, name).collect()] == [3]
    tables.vacuum(spark, root, name)
    assert len(list((tmp_path / name / "data").iterdir())) == 1
    assert [r.id for r in tables.read(spark, root, name).collect()] == [3]


def test_two_writers_do_not_lose_rows(spark, tmp_path):
    root, name = str(tmp_path), "bronze_price_history"
    tables.append(_bars(spark, [1]), root, name)
    now = tables.version(spark, root, name)
    tables.append(_bars(spark, [2]), root, name)
    with pytest.raises(RuntimeError, match="another writer"):
        tables._commit(spark, root, name, tables.Version(now.number + 1))
    assert sorted(r.id for r in tables.read(spark, root, name).collect()) == [1, 2]


def test_bar_ids_continue_and_differ(spark):
    landed = spark.range(100).repartition(4).select(
        F.lit("A").alias("ticker"), F.lit(DAY0).alias("date"),
        *[F.lit(1.0).alias(f) for f in ("open", "high", "low", "close", "adj_close")],
        F.col("id").alias("volume"),
    )
    ids = [r.id for r in landing.with_bar_ids(landed, 41).collect()]
    assert len(set(ids)) == 100 and min(ids) == 42
