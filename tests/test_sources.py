import datetime as dt

import pytest

import tabloom as t
from tabloom.sources import jdbc

SCHEMA = "a int, b double, c date"


@pytest.fixture
def csv_file(tmp_path):
    path = tmp_path / "acme" / "files" / "x.csv"
    path.parent.mkdir(parents=True)
    path.write_text("x;y;z\n1;2.5;2024-01-05\nbad;1;no\n;;\n4;1e3;2024-02-29\n")
    return path


def test_csv_schema_by_position(spark, csv_file, ansi):
    df = t.read_csv(spark, str(csv_file), SCHEMA, ";")
    assert df.dtypes == [("a", "int"), ("b", "double"), ("c", "date")]
    assert [tuple(r) for r in df.collect()] == [
        (1, 2.5, dt.date(2024, 1, 5)), (None, 1.0, None), (None, None, None),
        (4, 1000.0, dt.date(2024, 2, 29))]


def test_csv_limit_and_cache(spark, csv_file):
    df = t.read_csv(spark, str(csv_file), SCHEMA, ";", row_limit="2", cache=True)
    assert df.count() == 2 and df.storageLevel.useMemory
    df.unpersist()


def test_tenant_path(spark, csv_file):
    base = f"file:{csv_file.parent.parent.parent}"
    assert t.read_tenant_csv(spark, "acme", "x.csv", SCHEMA, ";", base=base).count() == 4


def test_csv_round_trip(spark, table, tmp_path):
    orders = table("orders")
    t.write_csv(orders, str(tmp_path / "o"), "|")
    schema = ", ".join(f"{n} {k}" for n, k in orders.dtypes)
    back = t.read_csv(spark, str(tmp_path / "o"), schema, "|")
    assert back.exceptAll(orders).isEmpty() and back.count() == orders.count()


class Recorder:
    """Stands in for Spark's reader and writer and notes how they are called."""

    def __init__(self, first=None):
        self.calls, self.current, self.bounds = [], {}, first
        self.read = self.write = self

    def format(self, name):
        self.current = {"format": name}
        return self

    def option(self, key, value):
        self.current = {**self.current, key: value}
        return self

    def options(self, **kwargs):
        self.current = {**self.current, **kwargs}
        return self

    def mode(self, name):
        self.current = {**self.current, "mode": name}
        return self

    def load(self):
        self.calls.append(self.current)
        return self

    save = load

    def first(self):
        return self.bounds


CONNECTION = {"url": "jdbc:x://h/db", "user": "u", "password": "p"}


def test_connection_options():
    assert t.connection_options("h", 5432, "db", "u", "p") == {
        "url": "jdbc:postgresql://h:5432/db", "driver": "org.postgresql.Driver",
        "user": "u", "password": "p"}
    assert t.connection_options(url="jdbc:x:") == {"url": "jdbc:x:"}


def test_jdbc_read_options():
    spark = Recorder()
    t.read_jdbc(spark, "(select 1) t", CONNECTION)
    assert spark.calls == [{"format": "jdbc", **CONNECTION, "fetchsize": "10000",
                            "dbtable": "(select 1) t"}]
    spark = Recorder(first=(1, 900))
    t.read_jdbc(spark, "orders", CONNECTION, "id", num_partitions=4)
    probe, read = spark.calls
    assert probe["dbtable"] == "(select min(id) lo, max(id) hi from orders t) b"
    assert (read["partitionColumn"], read["lowerBound"], read["upperBound"],
            read["numPartitions"], read["dbtable"]) == ("id", "1", "900", "4", "orders")
    spark = Recorder(first=(None, None))
    t.read_jdbc(spark, "empty", CONNECTION, "id", num_partitions=4)
    assert "partitionColumn" not in spark.calls[-1]
    with pytest.raises(ValueError):
        t.read_jdbc(spark, "orders", CONNECTION, "id")


def test_jdbc_write_options(monkeypatch):
    df = Recorder()
    df.columns = ["a", "b"]
    monkeypatch.setattr(jdbc, "source_tables", lambda _: ["orders"])
    for mode in ("append", "ignore", "error"):
        t.write_jdbc(df, "orders", CONNECTION, mode, num_partitions=3)
        assert df.calls[-1]["mode"] == mode and df.calls[-1]["numPartitions"] == "3"
    t.write_jdbc(df, "orders_new", CONNECTION)
    assert df.calls[-1]["mode"] == "overwrite" and df.calls[-1]["dbtable"] == "orders_new"
    with pytest.raises(ValueError, match="overwrite"):
        t.write_jdbc(df, '"orders"', CONNECTION)
    monkeypatch.setattr(jdbc, "written", lambda d, name: d)
    t.write_jdbc(df, "orders", CONNECTION, stage=True)
    assert df.calls[-1]["dbtable"] == "orders"
    with pytest.raises(ValueError):
        t.write_jdbc(df, "orders", CONNECTION, "upsert")


def test_table_names_in_plans():
    assert jdbc.reads_table(["orders"], "orders")
    assert jdbc.reads_table(['(select * from "Orders" o) t'], "orders")
    assert jdbc.reads_table(["my.orders"], "orders") and jdbc.reads_table(["orders"], "my.orders")
    assert jdbc.reads_table(["[db].[my].[orders]"], "my.orders")
    assert not jdbc.reads_table(["orders_old", "my.orders"], "your.orders")


def test_views(spark):
    df = spark.range(5)
    assert t.publish_view(df, "acme", "B001") == "acme_tbl_B001"
    t.publish_view(t.scan_view(spark, "acme", "B001").where("id > 2"), "acme", "B001")
    kept = t.scan_view(spark, "acme", "B001")
    assert t.drop_view(spark, "acme", "B001") and not t.drop_view(spark, "acme", "B001")
    assert kept.count() == 2
