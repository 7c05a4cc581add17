"""Layer schemas: raw/bronze, silver and gold."""

from pyspark.sql import types as T


def _strings(*names: str) -> list[T.StructField]:
    return [T.StructField(n, T.StringType()) for n in names]


# Older raw files carry only the first six columns; they are a prefix of the ten.
RAW = T.StructType(
    _strings(
        "Job_ID", "Role", "Company", "Location", "Publish_Time", "URL",
        "country", "job_desc", "salary", "work_type",
    )
)

# Raw columns plus where and when they came from, and how many raw rows each
# staged row stands for.
_ORIGIN = [T.StructField("source", T.StringType()), T.StructField("table_date", T.DateType())]
STAGING = T.StructType([*RAW.fields, T.StructField("copies", T.LongType()), *_ORIGIN])
BRONZE = T.StructType([*RAW.fields, *reversed(_ORIGIN)])

# Columns a bronze row must have to reach silver.
REQUIRED_RAW = ["Job_ID", "Role", "URL", "Publish_Time"]
# Columns that the quality check expects to be filled in silver.
REQUIRED_SILVER = ["job_id_platform", "role", "company", "posted_time", "url"]

SILVER = T.StructType(
    [T.StructField("job_id", T.LongType())]
    + _strings("job_id_platform", "role", "company", "location")
    + [T.StructField("posted_time", T.TimestampNTZType())]
    + _strings("url", "job_desc", "salary", "work_type", "country")
    + [
        T.StructField("salary_min_cleaned", T.DecimalType(38, 9)),
        T.StructField("salary_max_cleaned", T.DecimalType(38, 9)),
    ]
)

GOLD = T.StructType(
    [T.StructField("word", T.StringType()), T.StructField("frequency", T.LongType())]
)
