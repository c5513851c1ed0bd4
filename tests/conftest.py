import os

import pytest

os.environ.setdefault("TZ", "UTC")
DATA = "/root/testdata"


@pytest.fixture(scope="session")
def spark(tmp_path_factory):
    from pyspark.sql import SparkSession

    s = (
        SparkSession.builder.master("local[4]").appName("tests")
        .config("spark.sql.shuffle.partitions", "4").config("spark.sql.session.timeZone", "UTC")
        .config("spark.ui.enabled", "false").config("spark.ui.showConsoleProgress", "false")
        .config("spark.driver.memory", "4g").config("spark.sql.warehouse.dir", str(tmp_path_factory.mktemp("warehouse")))
        .config("spark.checkpoint.dir", str(tmp_path_factory.mktemp("shared")))
        .getOrCreate()
    )
    s.sparkContext.setLogLevel("ERROR")
    yield s
    s.stop()


SILVER = (
    "ts_local string, ts_utc timestamp, interval_start_date date, year int, month int, park_id string, park_capacity_kwp double, "
    "signal_name string, unit string, value double, source_file string, source_file_hash string, run_id string, ingested_at_utc string, "
    "ingest_key string, prepared_at_utc string, flag_missing_required boolean, flag_invalid_value boolean, flag_invalid_unit_range boolean, flag_duplicate boolean"
)
META = (
    "line_no bigint, park_name string, timezone string, park_id string, capacity_kwp double, latitude double, longitude double"
)


@pytest.fixture(scope="session")
def silver(spark):
    """Makes a silver table of dicts; columns that are not given are null."""
    from pyspark.sql import types as T

    schema = T._parse_datatype_string(SILVER)

    def make(rows, extra=()):
        out = spark.createDataFrame([[r.get(f.name) for f in schema.fields] for r in rows], schema)
        from pyspark.sql import functions as F

        for name in extra:  # columns of other makers, with names that operators use inside
            out = out.withColumn(name, F.lit("x"))
        return out

    return make


@pytest.fixture(scope="session")
def meta(spark):
    from pyspark.sql import types as T

    schema = T._parse_datatype_string(META)
    return lambda rows: spark.createDataFrame([[r.get(f.name) for f in schema.fields] for r in rows], schema)
