"""Hive-enabled session in its own process: RCFile table scan/overwrite.

Run by ``tests/test_hive.py``. Embedded metastore in in-memory Derby: no server, no port.
"""

import os
import sys

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from pyspark.sql import SparkSession  # noqa: E402
from pyspark.sql import functions as F  # noqa: E402

from sluice.sinks.table import write_table  # noqa: E402
from sluice.sources.inventory import file_inventory  # noqa: E402
from sluice.sources.table import scan_table  # noqa: E402


def main(wh: str) -> None:
    spark = (SparkSession.builder.master("local[2]").appName("sluice-hive-check")
             .config("spark.sql.catalogImplementation", "hive")
             .config("spark.sql.warehouse.dir", wh)
             .config("spark.hadoop.javax.jdo.option.ConnectionURL", "jdbc:derby:memory:sluice_hms;create=true")
             .config("spark.hadoop.datanucleus.schema.autoCreateAll", "true")
             .config("spark.hadoop.hive.metastore.schema.verification", "false")
             .config("spark.ui.enabled", "false").config("spark.sql.session.timeZone", "UTC")
             .enableHiveSupport().getOrCreate())
    spark.sparkContext.setLogLevel("ERROR")
    spark.sql("CREATE TABLE rc (a STRING, b INT) PARTITIONED BY (load_date STRING) STORED AS RCFILE")
    spark.sql("CREATE TABLE sq (a STRING, b INT) STORED AS SEQUENCEFILE")
    day1 = spark.createDataFrame([("x", 1), ("y", None)], "a string, b int")
    day2 = spark.createDataFrame([("z", 3)], "a string, b int")
    write_table(day1, name="rc", partition="20151101")           # bare value = first partition column
    write_table(day2, name="rc", partition="load_date=20151102")
    write_table(day1.withColumn("a", F.upper("a")), name="rc", partition="20151101")  # replace one partition
    got = sorted((r.a, r.b, r.load_date) for r in scan_table(spark, name="rc").collect())
    assert got == [("X", 1, "20151101"), ("Y", None, "20151101"), ("z", 3, "20151102")], got
    one = scan_table(spark, name="rc", partition="20151102").collect()
    assert [(r.a, r.b) for r in one] == [("z", 3)], one
    write_table(day1, name="sq")
    assert scan_table(spark, name="sq").count() == 2
    kinds = {r.type for r in file_inventory(spark, os.path.join(wh, "rc")).collect()}
    assert kinds == {"rcfile"}, kinds
    kinds = {r.type for r in file_inventory(spark, os.path.join(wh, "sq")).collect()}
    assert kinds == {"sequence"}, kinds
    print("HIVE_CHECK_OK")


if __name__ == "__main__":
    main(sys.argv[1])
