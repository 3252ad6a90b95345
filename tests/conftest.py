import datetime as dt
import tempfile

import pytest
from pyspark.sql import SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from curbflow.contracts import ZONES
from curbflow.functions.columns import with_derived


@pytest.fixture(scope="session")
def spark():
    session = (
        SparkSession.builder.master("local[*]")
        .appName("tests")
        .config("spark.sql.shuffle.partitions", "8")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.ui.enabled", "false")
        .config("spark.driver.memory", "8g")
        .config("spark.python.sql.dataFrameDebugging.enabled", "false")
        .getOrCreate()
    )
    session.sparkContext.setLogLevel("ERROR")
    return session


@pytest.fixture
def folder():
    """A new folder for each test; left where it is."""
    return tempfile.mkdtemp(prefix="run-", dir="/tmp")


TRIP_SCHEMA = T.StructType(
    [
        T.StructField("vendor_id", T.IntegerType()),
        T.StructField("pickup_ts", T.TimestampType()),
        T.StructField("dropoff_ts", T.TimestampType()),
        T.StructField("passenger_count", T.IntegerType()),
        T.StructField("trip_distance", T.DoubleType()),
        T.StructField("pu_location_id", T.IntegerType()),
        T.StructField("do_location_id", T.IntegerType()),
        T.StructField("payment_type", T.IntegerType()),
        T.StructField("fare_amount", T.DoubleType()),
        T.StructField("extra", T.DoubleType()),
        T.StructField("mta_tax", T.DoubleType()),
        T.StructField("tip_amount", T.DoubleType()),
        T.StructField("tolls_amount", T.DoubleType()),
        T.StructField("improvement_surcharge", T.DoubleType()),
        T.StructField("total_amount", T.DoubleType()),
        T.StructField("congestion_surcharge", T.DoubleType()),
        T.StructField("airport_fee", T.DoubleType()),
        T.StructField("pickup_longitude", T.DoubleType()),
        T.StructField("pickup_latitude", T.DoubleType()),
        T.StructField("dropoff_longitude", T.DoubleType()),
        T.StructField("dropoff_latitude", T.DoubleType()),
    ]
)
# A plain valid trip in the default window: 26 March 2024, 22:00, ten minutes, two miles.
PLAIN = {
    "vendor_id": 1,
    "pickup_ts": dt.datetime(2024, 3, 26, 22, 0),
    "dropoff_ts": dt.datetime(2024, 3, 26, 22, 10),
    "passenger_count": 1,
    "trip_distance": 2.0,
    "pu_location_id": 1,
    "do_location_id": 2,
    "payment_type": 1,
    "fare_amount": 10.0,
    "extra": 1.0,
    "mta_tax": 0.5,
    "tip_amount": 2.0,
    "tolls_amount": 0.0,
    "improvement_surcharge": 1.0,
    "total_amount": 14.5,
    "congestion_surcharge": None,
    "airport_fee": None,
    "pickup_longitude": -73.98,
    "pickup_latitude": 40.75,
    "dropoff_longitude": -73.95,
    "dropoff_latitude": 40.77,
}


def at(day=26, hour=22, minute=0, month=3, second=0):
    return dt.datetime(2024, month, day, hour, minute, second)


@pytest.fixture
def make_trips(spark):
    """Trips from the differences to a plain trip; ``minutes`` sets the dropoff time."""

    def make(*changes, derived=True):
        rows = []
        for change in changes:
            change = dict(change)
            minutes = change.pop("minutes", 10)
            row = PLAIN | change
            if "dropoff_ts" not in change and row["pickup_ts"] is not None:
                row["dropoff_ts"] = row["pickup_ts"] + dt.timedelta(minutes=minutes)
            rows.append(tuple(row[f.name] for f in TRIP_SCHEMA))
        df = spark.createDataFrame(rows, TRIP_SCHEMA)
        return with_derived(df) if derived else df

    return make


@pytest.fixture
def zones(spark):
    rows = [
        (1, "Queens", "JFK Airport", "Airports"),
        (2, "Manhattan", "Midtown", "Yellow Zone"),
        (3, "Manhattan", "Harlem", "Boro Zone"),
        (4, "EWR", "Newark", "EWR"),
        (5, "Queens", "Corona", "Boro Zone"),
        (6, "Queens", "Corona", "Boro Zone"),
    ]
    return spark.createDataFrame(rows, ZONES)


def rows_of(df, *names):
    """Rows as plain tuples, optionally of some columns."""
    return [tuple(row) for row in (df.select(*names) if names else df).collect()]


def one(df):
    (row,) = df.collect()
    return row


__all__ = ["F", "PLAIN", "TRIP_SCHEMA", "at", "one", "rows_of"]
