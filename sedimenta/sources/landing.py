"""Raw JSON documents: landing, reading back, parsing, flattening, rejects.

Documents travel as rows (document, landed_at, ingest_date, source_file). They
are landed many to a file; one object per document would leave a large lake with
more files than a listing can take.
"""

from __future__ import annotations

from datetime import date, datetime

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from sedimenta.functions import (
    day_of,
    epoch_of,
    epoch_to_ntz,
    falsy_to_null,
    micros_to_ntz,
    nan_to_null,
    object_key,
    reading_identity,
    sql_timestamp,
)
from sedimenta.operators.conform import apply_ranges, clean_text, reject_reason
from sedimenta.operators.keys import dense_ids
from sedimenta.operators.latest import latest_rows
from sedimenta.operators.quality import too_large
from sedimenta.schemas import BRONZE, PAYLOAD_DDL

# bronze column -> (path in the payload, bronze type); epoch columns are seconds.
_FIELDS = {
    "city": ("r.name", "varchar(100)"),
    "country": ("r.sys.country", "varchar(50)"),
    "latitude": ("r.coord.lat", "decimal(9,6)"),
    "longitude": ("r.coord.lon", "decimal(9,6)"),
    "temperature": ("r.main.temp", "decimal(5,2)"),
    "pressure": ("r.main.pressure", "decimal(10,2)"),
    "sea_level": ("r.main.sea_level", "bigint"),
    "grnd_level": ("r.main.grnd_level", "bigint"),
    "humidity": ("r.main.humidity", "bigint"),
    "wind_speed": ("r.wind.speed", "decimal(5,2)"),
    "wind_deg": ("r.wind.deg", "decimal(5,2)"),
    "wind_gust": ("r.wind.gust", "decimal(5,2)"),
    "clouds": ("r.clouds.all", "bigint"),
    "weather_condition": ("first.main", "varchar(100)"),
    "descriptions": ("first.description", "varchar(200)"),
    "sunrise": ("r.sys.sunrise", "epoch"),
    "sunset": ("r.sys.sunset", "epoch"),
    "timezone": ("r.timezone", "seconds"),
    "data_timestamp": ("r.dt", "epoch"),
}
_TYPES = {c: dtype for c, (_, dtype) in _FIELDS.items()}
_DOUBLES = [c for c, t in _TYPES.items() if t.startswith("decimal") or t == "bigint"]

_INTEGERS = ("epoch", "seconds")

LANDING_DDL = "document STRING, landed_at TIMESTAMP_NTZ"


def as_documents(df: DataFrame, document: Column, landed_at: datetime | str | Column) -> DataFrame:
    """Rows of any feed in document form."""
    if not isinstance(landed_at, Column):
        landed_at = sql_timestamp(landed_at)
    return df.select(document.alias("document"), landed_at.alias("landed_at")).select(
        "document",
        "landed_at",
        day_of(F.col("landed_at")).alias("ingest_date"),
        F.lit(None).cast("string").alias("source_file"),
    )


def land(documents: DataFrame, path: str, rows_per_file: int = 200_000) -> None:
    """Append documents, verbatim, under ingest_date=.../ as JSON lines.

    Nothing is replaced on write. A gzip file is read by one task, so files are bounded:
    200,000 documents are about 100 MB of text.
    """
    (
        documents.select("document", "landed_at", "ingest_date")
        .write.mode("append")
        .partitionBy("ingest_date")
        .option("maxRecordsPerFile", rows_per_file)
        .option("compression", "gzip")
        .json(path)
    )


def _envelopes(reader, path: str) -> DataFrame:
    schema = LANDING_DDL + ", ingest_date DATE"
    return reader.schema(schema).json(path).select(
        "document",
        "landed_at",
        "ingest_date",
        F.col("_metadata.file_path").alias("source_file"),
    )


def _plain(reader, path: str, whole_file: bool) -> DataFrame:
    modified = micros_to_ntz(F.unix_micros("_metadata.file_modification_time"))
    text = reader.text(path, wholetext=whole_file, recursiveFileLookup=True)
    return text.select(
        F.col("value").alias("document"),
        modified.alias("landed_at"),
        day_of(modified).alias("ingest_date"),
        F.col("_metadata.file_path").alias("source_file"),
    )


def read_landed(
    spark: SparkSession,
    path: str,
    layout: str = "landed",
    stream: bool = False,
    files_per_batch: int | None = None,
) -> DataFrame:
    """Documents of a folder.

    `landed`: written by land(). `lines`: one JSON document per line.
    `files`: one document per file, as in city/year/month/day/dt.json.
    For the last two, the file's modification time is the landing time.
    """
    reader = spark.readStream if stream else spark.read
    if files_per_batch:
        reader = reader.option("maxFilesPerTrigger", files_per_batch)
    if layout == "landed":
        return _envelopes(reader, path)
    if layout in ("lines", "files"):
        return _plain(reader, path, whole_file=layout == "files")
    raise ValueError(f"unknown layout {layout!r}")


def landing_months(spark: SparkSession, path: str, layout: str = "landed") -> list[date]:
    """First days of the months in which documents were landed, oldest first.

    Taken from the file listing: as `content` is not selected, no file is read.
    """
    files = spark.read.format("binaryFile")
    if layout == "landed":
        day = F.col("ingest_date").cast("date")
        listed = files.load(path)
    else:
        day = day_of(micros_to_ntz(F.unix_micros("modificationTime")))
        listed = files.option("recursiveFileLookup", "true").load(path)
    months = listed.select(F.trunc(day, "month").alias("month")).distinct()
    return [row["month"] for row in months.sort("month").collect()]


def parse(documents: DataFrame) -> DataFrame:
    """Adds the payload struct `r`; malformed documents keep r._corrupt_record.

    The struct comes out of explode(): a later filter on it then works on the
    parsed value. Pushed below a plain column it would parse the document once
    more for every field it looks at.
    """
    options = {"mode": "PERMISSIVE", "columnNameOfCorruptRecord": "_corrupt_record"}
    parsed = F.from_json("document", PAYLOAD_DDL, options)
    return documents.select("*", F.explode(F.array(parsed)).alias("r"))


def flatten(parsed: DataFrame, falsy_as_null: bool = False) -> DataFrame:
    """Payload struct -> the flat bronze columns, a missing leaf -> NULL.

    Adds `reject_reason` for documents that cannot become a bronze row. With
    `falsy_as_null`, 0 and '' count as missing.
    """

    def leaf(c: str) -> Column:
        path, dtype = _FIELDS[c]
        value = F.col(path)
        if c in _DOUBLES:
            value = nan_to_null(value)
        elif dtype in _INTEGERS:
            value = value.try_cast("bigint")
        if falsy_as_null:
            value = falsy_to_null(value, dtype)
        return value.alias(c)

    first = F.get("r.weather", F.lit(0)).alias("first")
    others = [c for c in parsed.columns if c != "r"]
    raw = parsed.select(*others, "r", first).select(
        *others, F.col("r._corrupt_record").alias("_corrupt"), *[leaf(c) for c in _FIELDS]
    )

    too_big = F.coalesce(
        *[F.when(too_large(c, t), F.lit(c)) for c, t in _TYPES.items() if t not in _INTEGERS]
    )
    epochs = {c: epoch_to_ntz(F.col(c)) for c, t in _TYPES.items() if t == "epoch"}
    reason = (
        F.when(F.col("_corrupt").isNotNull(), "malformed")
        .when(F.col("data_timestamp").isNull(), "data_timestamp missing")
        .when(epochs["data_timestamp"].isNull(), "data_timestamp out of range")
        .otherwise(F.concat(F.lit("overflow: "), too_big))
    )
    typed = {c: F.col(c).try_cast(t) for c, t in _TYPES.items() if t.startswith("decimal")}
    typed |= {c: F.round(c).try_cast(t) for c, t in _TYPES.items() if t == "bigint"}
    return raw.withColumn("reject_reason", reason).withColumns(typed | epochs).drop("_corrupt")


def good_documents(flat: DataFrame) -> DataFrame:
    return flat.where(F.col("reject_reason").isNull()).drop("reject_reason")


def rejected_documents(flat: DataFrame) -> DataFrame:
    return flat.where(F.col("reject_reason").isNotNull()).select(
        "document", "source_file", "landed_at", "reject_reason"
    )


_COPY_KEYS = ("identity", "ingest_date", "data_timestamp")


def _without_documents(flat: DataFrame) -> DataFrame:
    """Adds `identity`, whose reading it is, and `_tie`, which tells copies landed at the same
    moment apart, so that the documents themselves are not shuffled. A document with neither
    a name nor coordinates is a copy of equal documents only."""
    own = reading_identity(
        F.col("city"), F.col("country"), F.col("latitude"), F.col("longitude")
    )
    nobody = F.concat(F.lit("  "), F.md5("document"))
    return flat.withColumns(
        {"identity": F.coalesce(own, nobody), "_tie": F.xxhash64("document")}
    ).drop("document", "source_file")


def latest_landed(flat: DataFrame) -> DataFrame:
    """One row per identity, landing day and reading time: the last one landed."""
    slim = _without_documents(flat)
    return latest_rows(slim, _COPY_KEYS, ["landed_at", "_tie"]).drop("_tie")


def first_landed(flat: DataFrame) -> DataFrame:
    """One row per identity, landing day and reading time: the first one landed that silver
    takes for valid, or the first of all when none is.

    A load takes a reading over once and later copies never replace it, so loading step
    by step and replaying all that was landed give the same rows.
    """
    slim = _without_documents(flat).withColumn(
        "_age",
        F.timestamp_diff("MICROSECOND", F.col("landed_at"), sql_timestamp("1970-01-01 00:00:00")),
    )
    # judged on a cleaned copy; the calendar looks at the reading time, which copies share
    judged = apply_ranges(clean_text(slim.withColumn("_raw", F.struct(*slim.columns)))).select(
        "_raw.*", reject_reason().isNull().alias("_valid")
    )
    return latest_rows(judged, _COPY_KEYS, ["_valid", "_age", "_tie"]).drop("_valid", "_tie", "_age")


def bronze_rows(good: DataFrame, after: int = 0) -> DataFrame:
    """Bronze columns with dense ids, of the rows of latest_landed() or first_landed(); the
    landing time is the collection time.

    Ids follow city, landing day and reading time; namesakes and nameless stations of one
    time follow each other by identity. 65,536 id ranges keep each at a few million rows for
    10**11 readings.
    """
    # A missing city is numbered as '', so that the key is never NULL.
    keyed = good.withColumn("_city", F.coalesce("city", F.lit("")))
    keys = ["_city", "ingest_date", "data_timestamp"]
    numbered = dense_ids(keyed, keys, "id", after=after, digits=4, ties=["identity"])
    columns = [c for c, _ in BRONZE.columns if c != "collected_at"]
    return numbered.select(*columns, F.col("landed_at").alias("collected_at"))


def with_object_key(flat: DataFrame) -> DataFrame:
    """Adds the document's object path, from its landing day as the feed writes it."""
    seconds = epoch_of(F.col("data_timestamp"))
    return flat.withColumn("object_key", object_key(F.col("city"), F.col("landed_at"), seconds))


def payload() -> Column:
    """Bronze-shaped columns back as JSON documents: the inverse of flatten()."""

    def group(**fields: str) -> Column:
        return F.struct(*[F.col(c).alias(name) for name, c in fields.items()])

    sky = group(main="weather_condition", description="descriptions")
    return F.to_json(
        F.struct(
            epoch_of(F.col("data_timestamp")).alias("dt"),
            F.col("timezone"),
            F.col("city").alias("name"),
            group(lon="longitude", lat="latitude").alias("coord"),
            group(
                temp="temperature",
                pressure="pressure",
                humidity="humidity",
                sea_level="sea_level",
                grnd_level="grnd_level",
            ).alias("main"),
            group(speed="wind_speed", deg="wind_deg", gust="wind_gust").alias("wind"),
            group(all="clouds").alias("clouds"),
            F.array(sky).alias("weather"),
            F.struct(
                F.col("country"),
                epoch_of(F.col("sunrise")).alias("sunrise"),
                epoch_of(F.col("sunset")).alias("sunset"),
            ).alias("sys"),
        )
    )
