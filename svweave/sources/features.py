"""Features of a genome from BED text whose ``track`` lines say what becomes of the lines after them."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.window import Window

#: Fixed values of the format: what a track may ask for.
ACTIONS = {"ignore": "ignore", "filter:reads": "filter", "annotate:transposon": "annotate"}


def read_features(spark: SparkSession, path: str, fixed_action: str | None = None, keys: tuple[str, ...] = ("action",)) -> DataFrame:
    """``action, chr, start, end, name`` (0-based, half-open) of the features of ``path`` (gz too).

    A line takes the action of the last ``track`` line before it in its file: the first of ``keys`` that the line sets, to one of
    :data:`ACTIONS`; lines after a track without one, or before any, are left out. ``fixed_action`` holds for all lines; a track
    that says another one, or none, is an error then. Lines are ``chr start end [name]`` with tabs, or ``chr:first-last`` (1-based,
    closed). Empty lines, comments and ``browser`` lines are skipped. An unknown action and a line of another form are errors, and so
    is a file without features unless ``fixed_action`` is given. Lines of a file keep their order over its blocks: each block
    carries on with the last track of those before, of which a row a block is looked at.
    """
    text = spark.read.text(path).select("value", F.col("_metadata.file_path").alias("file"), F.col("_metadata.file_block_start").alias("block"), F.monotonically_increasing_id().alias("at"))
    lines = text.filter((F.col("value") != "") & ~F.col("value").startswith("#") & ~F.col("value").startswith("browser"))
    track = F.col("value").startswith("track")

    def wrong(words: str) -> F.Column:
        return F.raise_error(F.concat(F.lit(words + ": "), F.col("value")))

    said = F.lit(None).cast("string")
    for key in reversed(keys):
        # a value in quotes may hold escaped characters and white space
        found = F.regexp_extract("value", rf"""[ \t]{key}=("(?:[^"\\]|\\.)*"|'(?:[^'\\]|\\.)*'|[^ \t"'][^ \t]*)""", 1)
        bare = F.regexp_replace(F.regexp_replace(found, "^[\"']|[\"']$", ""), r"\\(.)", "$1")
        said = F.when(F.col("value").rlike(rf"[ \t]{key}="), bare).otherwise(said)
    known = F.lit(None).cast("string")
    for name, action in ACTIONS.items():
        known = F.when(said == name, action).otherwise(known)
    state = F.when(said.isNotNull() & known.isNull(), wrong("unknown action")).otherwise(F.coalesce(known, F.lit("none")))
    if fixed_action is not None:
        state = F.when(state != fixed_action, wrong("another action is given")).otherwise(state)
    marked = lines.withColumn("state", F.when(track, state))
    inside = Window.partitionBy("file", "block").orderBy("at").rowsBetween(Window.unboundedPreceding, 0)
    last = marked.filter(track).groupBy("file", "block").agg(F.max_by("state", "at").alias("last"))
    blocks = lines.select("file", "block").distinct().join(last, ["file", "block"], "left")
    before = F.last("last", True).over(Window.partitionBy("file").orderBy("block").rowsBetween(Window.unboundedPreceding, -1))
    carried = blocks.select(F.col("file").alias("_file"), F.col("block").alias("_block"), before.alias("before"))
    held = marked.withColumn("now", F.last("state", True).over(inside)).join(carried, (F.col("file") == F.col("_file")) & (F.col("block") == F.col("_block")))
    start = fixed_action or "none"
    rows = held.filter(~track).withColumn("action", F.coalesce("now", "before", F.lit(start))).filter("action <> 'none'")
    f = F.split(F.trim(F.regexp_replace("value", r"[ \t]+", "\t")), "\t")
    bed, first, end = F.col("value").contains("\t"), F.get(f, F.lit(1)).try_cast("long"), F.get(f, F.lit(2)).try_cast("long")
    spot = [F.regexp_extract("value", r"^(.+):([0-9]+)-([0-9]+)$", k) for k in (1, 2, 3)]
    place = F.when(bed & (F.size(f) >= 3) & first.isNotNull() & end.isNotNull(), F.struct(F.get(f, F.lit(0)).alias("chr"), first.alias("start"), end.alias("end"), F.coalesce(F.get(f, F.lit(3)), F.lit("")).alias("name")))
    place = place.when(bed, wrong("too few fields")).when(spot[0] == "", wrong("neither fields nor a range"))
    place = place.otherwise(F.struct(spot[0].alias("chr"), (spot[1].try_cast("long") - 1).alias("start"), spot[2].try_cast("long").alias("end"), F.lit("").alias("name")))
    out = rows.select("action", place.alias("p")).select("action", "p.*")
    if fixed_action is None and out.isEmpty():
        raise ValueError("no features are selected; a track line must give an action")
    return out
