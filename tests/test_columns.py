from pyspark.sql import functions as F

from sensorweave.functions import columns


def test_column_rules(spark):
    df = spark.createDataFrame([(1, 2.0, 3.0)], "packetcounter int, trunk_acc_x double, trunk_gyr_x double")
    assert columns.names_containing(df, "gyr") == ["trunk_gyr_x"]
    assert columns.names_containing(df, "trunk", exclude=["trunk_acc_x"]) == ["trunk_gyr_x"]
    ordered = columns.order_columns(df.withColumn("sid", F.lit(1)), ["sid", "time_ms", "packetcounter"])
    assert ordered.columns == ["sid", "packetcounter", "trunk_acc_x", "trunk_gyr_x"]
