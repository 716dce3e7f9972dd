"""The command line jobs, end to end on CSV files written from the test tables (run as subprocesses)."""

import os
import subprocess
import sys

from meterlake.sources import tables

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
SF = "/root/testdata/sf0.001"


def cli(*args):
    env = dict(os.environ, PYTHONPATH=ROOT)
    r = subprocess.run([sys.executable, "-m", "meterlake.cli", *args, "--master", "local[2]"],
                       env=env, cwd="/", capture_output=True, text=True, timeout=600)
    assert r.returncode == 0, r.stderr[-3000:]


def test_jobs_end_to_end(spark, tmpdir_path):
    d = tmpdir_path
    tables.readings_raw(spark, SF).select("LCLid", "tstp", "`energy(kWh/hh)`").repartition(2) \
        .write.option("header", True).csv(f"{d}/half")
    tables.households_raw(spark, SF).coalesce(1).write.option("header", True).csv(f"{d}/house")
    tables.weather_raw(spark, SF).coalesce(1).write.option("header", True).csv(f"{d}/weather")
    cli("replay", "--readings", f"{d}/half/*.csv", "--messages", f"{d}/msgs")
    cli("consume", "--once", "--messages", f"{d}/msgs", "--households", f"{d}/house",
        "--weather", f"{d}/weather", "--root", f"{d}/lake")
    cli("insights", "--root", f"{d}/lake")
    silver = spark.read.parquet(f"{d}/lake/silver").drop("day")
    # Rows whose energy the CSV writer quoted as "" pass the replay (quotes are not
    # interpreted) and carry a NULL reading; all others equal the silver layer.
    from meterlake.plans import layers
    want = layers.silver_layer(spark, SF)
    assert silver.filter("consumption IS NOT NULL").exceptAll(want).count() == 0
    assert silver.filter("consumption IS NOT NULL").count() == want.filter("consumption IS NOT NULL").count()
    # written reports are whole: one row for every hour that has readings
    hours = spark.read.parquet(f"{d}/lake/reports/par_index")
    assert hours.count() == hours.select("hour").distinct().count() > 5
