"""Raw JSON files as variant rows."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from orelode.sources.objects import read_pieces, split_records
from orelode.sources.paths import file_stream, materialise

BRONZE_SCHEMA = "payload variant, ingestion_ts timestamp_ntz, source_file string"


LAYOUTS = ("auto", "lines", "array")
BLANK = " \t\r\n"


def _parsed(raw: DataFrame) -> DataFrame:
    """``raw`` with the one JSON value each ``value`` is as ``payload``, or NULL: nothing may follow it.

    The parser stops after a first value. Inside brackets of our own it has to go on to the last of
    them; a text with a closing bracket, which might be taken for ours, must also fit into an object.
    """
    inside = F.try_parse_json(F.concat(F.lit("["), "value", F.lit("]")))
    member = F.try_parse_json(F.concat(F.lit('{"v":'), "value", F.lit("}")))
    whole = F.expr("try_variant_get(_inside, '$[1]', 'variant')").isNull() & (
        ~F.col("value").contains("]") | member.isNotNull()
    )
    payload = F.when(whole, F.expr("try_variant_get(_inside, '$[0]', 'variant')"))
    return raw.withColumn("_inside", inside).withColumn("payload", payload).drop("_inside")


def _text(spark: SparkSession, path: str | list[str]) -> DataFrame:
    return spark.read.option("recursiveFileLookup", "true").text(path)


def file_names(spark: SparkSession, path: str, max_files: int) -> DataFrame:
    """The files that arrive under ``path`` as a stream, without their contents."""
    stream = file_stream(spark).option("recursiveFileLookup", "true").option("maxFilesPerTrigger", max_files)
    schema = "path string, modificationTime timestamp, length bigint, content binary"
    return stream.schema(schema).format("binaryFile").load(path).select("path")


def read_raw(spark: SparkSession, path: str | list[str], layout: str = "auto") -> DataFrame:
    """One row per JSON record: ``payload`` and ``source_file``. Unreadable records have no payload.

    Every layout splits inside files. ``lines`` has one value a line; the elements of an array are records
    of their own. ``array`` takes files for objects in arrays, however indented, or one after the other: each
    object is a record, see :func:`split_records`. ``auto`` looks at each file: one that begins with an
    object and most of whose lines are objects is read by lines, any other by objects.
    """
    if layout not in LAYOUTS:
        raise ValueError(f"unknown layout {layout!r}")
    if layout == "array":
        return split_records(read_pieces(spark, path))
    lines = _text(spark, path).select("value", F.col("_metadata.file_path").alias("source_file"))
    lines = lines.where(F.trim("value", F.lit(BLANK)) != "")
    if layout == "lines":
        return _elements(lines)
    kinds = materialise(_kinds(spark, path), "file-kinds")
    by_line = kinds.where("by_line").select("source_file")
    by_object = kinds.where("not by_line").select("source_file")
    raw = _elements(lines.join(by_line, "source_file", "left_semi"))
    if by_object.isEmpty():
        return raw
    pieces = read_pieces(spark, path).join(by_object, "source_file", "left_semi")
    return raw.unionByName(split_records(pieces))


def _kinds(spark: SparkSession, path: str | list[str]) -> DataFrame:
    """Whether each file is one of lines; the lines are counted of files that begin with an object alone."""
    first = materialise(_first_signs(spark, path), "first-signs")
    objects = first.where(F.col("first") == ord("{"))
    # An array is never read by lines. Scalars or other text on lines of their own are lines.
    known = first.where(F.col("first") != ord("{")).select("source_file", (F.col("first") != ord("[")).alias("by_line"))
    if objects.isEmpty():
        return known
    line = F.trim("value", F.lit(BLANK))
    lines = _text(spark, path).select(F.col("_metadata.file_path").alias("source_file"), line.alias("line"))
    lines = lines.where(F.col("line") != "").join(objects.select("source_file"), "source_file", "left_semi")
    one = F.col("line").startswith("{") & (F.col("line").endswith("}") | (F.length("line") > 2))
    counted = lines.groupBy("source_file").agg(
        F.count(F.when(one, 1)).alias("objects"), F.count(F.lit(1)).alias("lines")
    )
    by_line = 2 * F.col("objects") >= F.col("lines")
    return known.unionByName(counted.select("source_file", by_line.alias("by_line")))


def _first_signs(spark: SparkSession, path: str | list[str]) -> DataFrame:
    """The code of each file's first sign but blanks, in splits of the usual size; files of blanks have none.

    Read up to closing braces: an array on one line is no value of its own, nor read by every split of it.
    """
    reader = spark.newSession().read.option("recursiveFileLookup", "true").option("lineSep", "}")
    piece = F.trim("value", F.lit(BLANK))
    pieces = reader.text(path).select(
        F.col("_metadata.file_path").alias("source_file"), F.col("_metadata.file_block_start").alias("block"),
        F.monotonically_increasing_id().alias("row"),
        # Behind blanks alone stands the brace, or the file's end.
        F.when(piece != "", F.ascii(piece)).when(F.octet_length("value") < F.col("_metadata.file_size"), ord("}"))
        .otherwise(0).cast("long").alias("sign"),
    ).where(F.col("block") == 0)
    # The sign as the lower bits of its place: numbers alone, so nothing is sorted. The lower 33 bits of
    # Spark's growing ids are the row's place in its task, so in its split.
    place = F.col("row").bitwiseAND(F.lit((1 << 33) - 1))
    first = F.min(F.shiftleft(place, 21).bitwiseOR(F.col("sign"))).bitwiseAND(F.lit((1 << 21) - 1))
    return pieces.groupBy("source_file").agg(first.alias("first")).where(F.col("first") != 0)


def _elements(lines: DataFrame) -> DataFrame:
    """The records of lines: their values, or the elements of those that are arrays."""
    raw = _parsed(lines)
    elements = F.coalesce(F.expr("try_variant_get(payload, '$', 'array<variant>')"), F.array("payload"))
    return raw.select(F.explode(elements).alias("payload"), "source_file")


def bronze_rows(raw: DataFrame, load_ts: Column) -> DataFrame:
    """The readable records in bronze shape."""
    return raw.where(F.col("payload").isNotNull()).select(
        "payload", load_ts.alias("ingestion_ts"), "source_file"
    )


def bad_records(raw: DataFrame) -> DataFrame:
    """Unreadable records per file."""
    return (
        raw.where(F.col("payload").isNull())
        .groupBy("source_file")
        .agg(F.count(F.lit(1)).alias("bad_records"))
    )


def file_manifest(bronze: DataFrame) -> DataFrame:
    """The files a bronze batch came from, one row each, so the list may be as long as it likes."""
    return bronze.groupBy("source_file").agg(F.count(F.lit(1)).alias("rows_loaded"))
