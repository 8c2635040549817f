"""JSON objects cut out of large files, in as many tasks as the files have splits.

A file is read in pieces that end at closing braces, so that every split of a file is a task of its own,
even where the file has no line ends. Whether a brace counts depends on all text before it: it may stand
in a string. A first pass over the files keeps a row a split: what the split does to both possible states.
Prefix sums over the splits of a file say what each begins with. A second pass then tells inside each split
where records end, and puts together the pieces between; only what reaches over a split's ends meets the
same of other splits. Small splits are read several to a task, one after the other.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from orelode.sources.paths import compact_write, length, scratch_dir

#: Bytes of a record beyond which it is unreadable: an object that is never closed takes the rest of its file.
MOST_BYTES = 64 * 1024 * 1024
#: Bytes of splits that a task reads at least, once there are ``TASKS`` a core.
TASK_BYTES, TASKS = 32 * 1024 * 1024, 4
_SPLIT = ("source_file", "block")
_START, _REACH = Window.unboundedPreceding, Window.currentRow


def read_pieces(spark: SparkSession, path: str | list[str]) -> DataFrame:
    """The files' text up to each closing brace, with its file, the split it is read in, and its place there."""
    text = spark.read.option("recursiveFileLookup", "true").option("lineSep", "}").text(path)
    pieces = text.select(
        F.col("_metadata.file_path").alias("source_file"),
        F.col("_metadata.file_block_start").alias("block"),
        F.monotonically_increasing_id().alias("row"),
        "value",
        F.col("_metadata.file_size").alias("file_size"),
    )
    # Splits stay what they are; beyond some a core, a task for each would cost more than reading it.
    return pieces.coalesce(max(TASKS * spark.sparkContext.defaultParallelism, length(spark, path) // TASK_BYTES))


def _count(text, sign: str):
    return F.octet_length(text) - F.octet_length(F.replace(text, F.lit(sign), F.lit("")))


def _pieces(raw: DataFrame, *columns: str) -> DataFrame:
    """Each piece with its place, its quotes (odd or even) and the braces it opens by either state."""
    # An escaped sign, a quote or another, is no sign of its own.
    plain = F.when(F.col("value").contains("\\"), F.regexp_replace("value", r"(?s)\\.", "")).otherwise(F.col("value"))
    rows = raw.select(
        *_SPLIT, "row", *columns, (F.octet_length("value") + 1).cast("long").alias("bytes"), plain.alias("plain")
    )
    rows = rows.withColumn("braces", _count(F.col("plain"), "{"))
    # Nearly all pieces open one brace: what stands before it tells for which state. Of others the strings go.
    odd = _count(F.substring_index("plain", "{", 1), '"') % 2
    outside = _count(F.regexp_replace("plain", '"[^"]*("|$)', ""), "{")
    opened = F.when(F.col("braces") == 0, 0).when(F.col("braces") == 1, 1 - odd).otherwise(outside)
    rows = rows.select(
        *_SPLIT, "row", *columns, "bytes", (_count(F.col("plain"), '"') % 2).alias("quotes"), "braces",
        opened.alias("opened_0"),
    )
    # What is outside of strings by the one state is inside by the other.
    return rows.withColumn("opened_1", F.col("braces") - F.col("opened_0")).drop("braces")


def _inside():
    return Window.partitionBy(*_SPLIT).orderBy("row")


def _with_depths(pieces: DataFrame, states: dict[str, object]) -> DataFrame:
    """For each state that a split may begin in: the depth of braces after a piece, and the least so far.

    Both count from the split's beginning, as do the quotes ``q`` and bytes ``b`` up to the piece. ``rest`` is
    the next piece. What does not depend on another window stands beside it: a window copies its rows.
    """
    running = _inside().rowsBetween(_START, _REACH)
    out = pieces.withColumns({
        "q": F.sum("quotes").over(running), "b": F.sum("bytes").over(running), "rest": F.lead("row").over(_inside()),
    })
    changes = {}
    for name, begin in states.items():
        state = (begin + F.col("q") - F.col("quotes")) % 2
        ends = (begin + F.col("q")) % 2 == 0
        opened = F.when(state == 0, F.col("opened_0")).otherwise(F.col("opened_1"))
        changes[f"ends_{name}"] = ends
        changes[f"change_{name}"] = opened - F.when(ends, 1).otherwise(0)
    out = out.withColumns(changes).drop("quotes", "opened_0", "opened_1", "bytes")
    out = out.withColumns({f"own_{name}": F.sum(f"change_{name}").over(running) for name in states})
    out = out.drop(*(f"change_{name}" for name in states))
    return out.withColumns({f"least_{name}": F.min(f"own_{name}").over(running) for name in states})


def _starts(raw: DataFrame) -> DataFrame:
    """What each split begins with: in a string or not, depth, least depth; and whether its last piece is cut.

    A closing brace too many counts for nothing, so the least depth so far is the ground.
    """
    told = _with_depths(_pieces(raw, "file_size"), {"0": F.lit(0), "1": F.lit(1)})
    totals = told.where(F.col("rest").isNull()).select(
        *_SPLIT, "file_size", "q", "b", "own_0", "own_1", "least_0", "least_1"
    )
    file = Window.partitionBy("source_file").orderBy("block")
    earlier = file.rowsBetween(_START, -1)
    state = (F.coalesce(F.sum("q").over(earlier), F.lit(0)) % 2).cast("int")
    totals = totals.withColumn("state", state)
    totals = totals.withColumn("d", F.when(F.col("state") == 0, F.col("own_0")).otherwise(F.col("own_1")))
    least = F.when(F.col("state") == 0, F.col("least_0")).otherwise(F.col("least_1"))
    totals = totals.withColumn("depth_before", F.coalesce(F.sum("d").over(earlier), F.lit(0)))
    totals = totals.withColumn("least_here", F.col("depth_before") + least)
    before = F.least(F.coalesce(F.min("least_here").over(earlier), F.lit(0)), F.lit(0))
    # The last piece of a file that does not end in a brace seems to reach beyond its end.
    cut = F.sum("b").over(file.rowsBetween(_START, _REACH)) > F.col("file_size")
    return totals.select(*_SPLIT, "state", "depth_before", before.alias("least_before"), cut.alias("cut"))


def _placed(raw: DataFrame, starts: DataFrame) -> DataFrame:
    """Each piece's text with the number of its record in its split, and whether it ends one or is all of one."""
    pieces = _pieces(raw, "value").join(starts, [*_SPLIT])
    told = _with_depths(pieces, {"here": F.col("state")})
    earlier = _inside().rowsBetween(_START, -1)
    closed = ~(F.col("cut") & F.col("rest").isNull())
    depth = F.col("depth_before") + F.col("own_here")
    ground = F.least("least_before", F.col("depth_before") + F.col("least_here"))
    told = told.select(
        *_SPLIT, "row", "value", "b", closed.alias("closed"),
        (closed & F.col("ends_here") & (depth == ground)).cast("int").alias("last"),
    )
    told = told.withColumns({
        "number": F.coalesce(F.sum("last").over(earlier), F.lit(0)),
        "begun": F.coalesce(F.max(F.when(F.col("last") == 1, F.col("b"))).over(earlier), F.lit(0)),
        "before": F.lag("last").over(_inside()),
    }).withColumn("size", F.col("b") - F.col("begun"))
    text = F.concat("value", F.when(F.col("closed"), "}").otherwise(""))
    alone = (F.col("last") == 1) & (F.coalesce("before", F.lit(0)) == 1) & (F.col("size") <= MOST_BYTES)
    # So many bytes at most: of a longer record its size is kept.
    return told.select(
        *_SPLIT, "row", "number", "size", "last", alone.alias("alone"),
        F.when(F.col("size") <= MOST_BYTES, text).alias("text"),
    )


def _parts(placed: DataFrame) -> DataFrame:
    """What of records lies in one split: with their number there, and whether they end in it."""
    text = F.when(F.col("text").isNotNull(), F.struct("row", "text"))
    parts = placed.groupBy(*_SPLIT, "number").agg(
        F.max("size").alias("size"), F.max("last").alias("ended"), F.sort_array(F.collect_list(text)).alias("parts")
    )
    joined = F.array_join(F.transform("parts", lambda p: p["text"]), "")
    return parts.select(*_SPLIT, "number", "size", "ended", joined.alias("text"))


def _scratch(df: DataFrame, name: str) -> DataFrame:
    """:func:`materialise`, read in splits of the usual size, whatever the session reads its input in."""
    stored = scratch_dir(df.sparkSession, name)
    compact_write(df).parquet(stored)
    return df.sparkSession.newSession().read.schema(df.schema).parquet(stored)


def split_records(raw: DataFrame) -> DataFrame:
    """``(payload, source_file)`` of the text that :func:`read_pieces` gives; it is read twice.

    Each object that is not inside another is a record, be it an element of an array (on one line or many) or
    one of several values. An object that does not parse, and anything else between two objects but blanks,
    commas and square brackets, is one unreadable record without payload; the other records are not
    touched by it, unless quotes or braces of it are missing: then the record lasts until the braces are even.
    Empty files have no records.
    """
    placed = _scratch(_placed(raw, _scratch(_starts(raw), "starts")), "pieces")
    # An object without objects inside is one piece; only others are put together.
    parts = _scratch(_parts(placed.where(~F.col("alone"))), "parts")
    # What a split begins with may go on from the one before, what it ends with may go on.
    inner = (F.col("number") > 0) & (F.col("ended") == 1)
    outer = parts.where(~inner)
    before = Window.partitionBy("source_file").orderBy("block", "number").rowsBetween(_START, -1)
    record = F.coalesce(F.sum("ended").over(before), F.lit(0))
    chains = outer.select(*_SPLIT, "number", "size", record.alias("record"))
    sizes = chains.groupBy("source_file", "record").agg(F.sum("size").alias("size"))
    large = sizes.where(F.col("size") > MOST_BYTES).select("source_file", "record")
    chains = chains.join(large, ["source_file", "record"], "left_anti").select(*_SPLIT, "number", "record")
    whole = outer.select(*_SPLIT, "number", "text").join(chains, [*_SPLIT, "number"])
    # The pieces of one record: so many bytes at most.
    whole = whole.groupBy("source_file", "record").agg(
        F.sort_array(F.collect_list(F.struct("block", "number", "text"))).alias("parts")
    )
    joined = F.array_join(F.transform("parts", lambda p: p["text"]), "")
    texts = whole.select("source_file", joined.alias("text")).unionByName(
        parts.where(inner & (F.col("size") <= MOST_BYTES)).select("source_file", "text")
    ).unionByName(placed.where("alone").select("source_file", "text"))
    large = large.select("source_file").unionByName(
        parts.where(inner & (F.col("size") > MOST_BYTES)).select("source_file")
    )
    brace = F.locate("{", F.col("text"))
    lead = F.when(brace > 0, F.substring("text", F.lit(1), brace - 1)).otherwise(F.col("text"))
    other = F.regexp_replace(lead, r"[\[\],\s]+", "")
    out = texts.select(
        "source_file",
        F.filter(
            F.array(
                F.when(brace > 0, F.struct(F.substr("text", brace).alias("object"), F.lit(True).alias("is_object"))),
                F.when(other != "", F.struct(other.alias("object"), F.lit(False).alias("is_object"))),
            ),
            lambda r: r.isNotNull(),
        ).alias("found"),
    )
    found = out.select("source_file", F.explode("found").alias("r"))
    payload = F.when(F.col("r.is_object"), F.try_parse_json(F.col("r.object")))
    good = found.select(payload.alias("payload"), "source_file")
    return good.unionByName(large.select(F.lit(None).cast("variant").alias("payload"), "source_file"))
