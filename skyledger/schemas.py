"""Declared shapes: the weather target, payloads, load requests, size tiers."""

from pyspark.sql import types as T

# Column names, stored types and their order.
WEATHER_TARGET = T.StructType(
    [
        T.StructField("id", T.LongType(), False),
        T.StructField("latitude", T.DecimalType(8, 6)),
        T.StructField("longitude", T.DecimalType(9, 6)),
        T.StructField("temperature", T.DecimalType(3, 1)),
        T.StructField("windspeed", T.DecimalType(4, 1)),
        T.StructField("winddirection", T.ShortType()),
        T.StructField("weathercode", T.ShortType()),
        T.StructField("is_day", T.BooleanType()),
        T.StructField("event_time", T.TimestampType()),
        T.StructField("batch_id", T.IntegerType()),
        T.StructField("loaded_at", T.TimestampType()),
    ]
)

# The target fills this column itself when a load leaves it out.
LOADED_AT_DEFAULT = {"loaded_at": "current_timestamp()"}

# Fixed value: number of load batches; batch_id runs from 0 to BATCHES - 1.
BATCHES = 1000

# Field names and types of a payload.
PERSON = T.StructType(
    [T.StructField("craft", T.StringType()), T.StructField("name", T.StringType())]
)
PAYLOAD = T.StructType(
    [T.StructField("number", T.IntegerType()), T.StructField("people", T.ArrayType(PERSON))]
)

# The (craft, name) rows used when a payload cannot be read.
FALLBACK_PEOPLE = [
    ("ISS", "Oleg Kononenko"),
    ("ISS", "Nikolai Chub"),
    ("ISS", "Tracy Caldwell Dyson"),
    ("ISS", "Matthew Dominick"),
    ("ISS", "Michael Barratt"),
    ("ISS", "Jeanette Epps"),
    ("ISS", "Alexander Grebenkin"),
    ("ISS", "Butch Wilmore"),
    ("ISS", "Sunita Williams"),
    ("Tiangong", "Li Guangsu"),
    ("Tiangong", "Li Cong"),
    ("Tiangong", "Ye Guangfu"),
]

# Fixed value: the greeting that ends every sentence.
GREETING = "Hello! :)"

# Columns of the sample file, in order.
SAMPLE_CSV = T.StructType(
    [
        T.StructField("id", T.IntegerType()),
        T.StructField("name", T.StringType()),
        T.StructField("age", T.IntegerType()),
        T.StructField("city", T.StringType()),
        T.StructField("salary", T.IntegerType()),
    ]
)

LOAD_REQUEST = T.StructType(
    [
        T.StructField("num_records", T.LongType()),
        T.StructField("table_name", T.StringType()),
        T.StructField("data_size", T.StringType()),
    ]
)

# What a load request means where a field is left out.
REQUEST_DEFAULTS = {"num_records": 1_000_000, "table_name": "weather_data", "data_size": "medium"}

# The tier used for a size name that is not listed below.
DEFAULT_TIER = "medium"

# Fixed values, one row per size tier:
# name, executor memory, executor cores, driver memory, shuffle partitions,
# parallelism, rows per second.
TIER_ROWS = [
    ("small", "1g", 2, "1g", 50, 20, 15_000),
    ("medium", "2g", 2, "1g", 200, 50, 75_000),
    ("large", "4g", 4, "2g", 400, 100, 300_000),
    ("xlarge", "8g", 6, "4g", 1200, 400, 800_000),
]
TIERS = T.StructType(
    [
        T.StructField("data_size", T.StringType(), False),
        T.StructField("executor_memory", T.StringType(), False),
        T.StructField("executor_cores", T.IntegerType(), False),
        T.StructField("driver_memory", T.StringType(), False),
        T.StructField("shuffle_partitions", T.IntegerType(), False),
        T.StructField("parallelism", T.IntegerType(), False),
        T.StructField("rate_per_sec", T.LongType(), False),
    ]
)

RUN_LOG = T.StructType(
    [
        T.StructField("run_id", T.StringType()),
        T.StructField("status", T.StringType()),
        T.StructField("records_requested", T.LongType()),
        T.StructField("records_written", T.LongType()),
        T.StructField("elapsed_seconds", T.DoubleType()),
        T.StructField("table_size", T.StringType()),
        T.StructField("avg_temperature", T.DecimalType(5, 2)),
        T.StructField("report_error", T.StringType()),
    ]
)

# What a load of this package also logs: the finalize step's own time, and the rows its scan found.
LOAD_LOG = T.StructType(
    [
        *RUN_LOG.fields,
        T.StructField("finalization_seconds", T.DoubleType()),
        T.StructField("records_stored", T.LongType()),
    ]
)
