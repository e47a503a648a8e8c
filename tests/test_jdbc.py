"""JDBC sink wiring, without a database: DataFrameWriter.jdbc is intercepted."""

from pyspark.sql import DataFrameWriter

from footfall.sinks import jdbc


def test_jdbc_sinks_pass_options_and_audit(spark, monkeypatch):
    calls = []

    def fake_jdbc(self, url, table, mode=None, properties=None):
        calls.append((url, table, mode, properties, self._df.columns, self._df.rdd.getNumPartitions()))

    monkeypatch.setattr(DataFrameWriter, "jdbc", fake_jdbc)
    df = spark.range(100).repartition(20).selectExpr("cast(id as int) as district_id")
    props = {"user": "u", "driver": "org.example.Driver"}
    jdbc.append_report_jdbc(df, "jdbc:example://host/db", "visitor_flow_dur", props)
    jdbc.overwrite_dim_jdbc(df, "jdbc:example://host/db", "dim_district", props)
    (u1, t1, m1, p1, c1, n1), (u2, t2, m2, p2, c2, n2) = calls
    assert (t1, m1, t2, m2) == ("visitor_flow_dur", "append", "dim_district", "overwrite")
    assert p1 == props and c1 == ["district_id", "update_time"] and n1 <= 8
