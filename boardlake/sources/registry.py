"""Company registry scans: one JSON array of {slug, name, sector} per ATS."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import Window as W
from pyspark.sql import functions as F
from pyspark.sql.utils import AnalysisException

from .landing import file_system, pinned
from .schemas import ATS_NAMES, ATS_ORD, REGISTRY_DDL

#: Size of a registry file up to which one task reads it.
WHOLE_BYTES = 32 << 20
REGISTRY_COLS = ("ats", "ats_ord", "ord", "slug", "name", "sector")


def _empty_registry(spark: SparkSession) -> DataFrame:
    return spark.createDataFrame(
        [], "ats STRING, ats_ord INT, ord INT, slug STRING, name STRING, sector STRING"
    )


def _before(df: DataFrame, value, name: str) -> DataFrame:
    """``name``: the sum of ``value`` over all rows before, in the order of (block, row).  Sums
    run inside the blocks, which are byte ranges of the file; only one sum a block goes on."""
    own = W.partitionBy("block").orderBy("row").rowsBetween(W.unboundedPreceding, -1)
    total = df.groupBy("block").agg(F.sum(value).alias("_total"))
    upto = W.orderBy("block").rowsBetween(W.unboundedPreceding, -1)  # as many rows as the file has ranges
    total = total.select("block", F.coalesce(F.sum("_total").over(upto), F.lit(0)).alias("_base"))
    return df.join(F.broadcast(total), "block").withColumn(name, F.col("_base") + F.coalesce(F.sum(value).over(own), F.lit(0))).drop("_base")


def array_elements(spark: SparkSession, path: str) -> DataFrame:
    """(ord, element): the objects of one JSON array file, however large, in their order.

    The file is read in pieces that end at closing braces, by byte ranges.  Two running sums
    over the pieces tell what each one is: the number of quotes before it, whether it starts
    inside a string, and the braces outside strings, how deep it is.  An object ends where the
    depth is zero again, and a third sum numbers the objects.  A file that is no array of
    objects gives none.
    """
    pieces = spark.read.option("lineSep", "}").text(path).select(
        F.col("_metadata.file_block_start").alias("block"), F.monotonically_increasing_id().alias("row"), "value")
    count = lambda c, mark: F.length(c) - F.length(F.replace(c, F.lit(mark), F.lit("")))
    # an escape never ends at a closing brace
    pieces = pieces.withColumn("plain", F.regexp_replace("value", r"(?s)\\.", "")).withColumn("quotes", count(F.col("plain"), '"'))
    pieces = _before(pieces, F.col("quotes"), "quotes_before")
    inside, until = F.col("quotes_before") % 2 == 1, (F.col("quotes_before") + F.col("quotes")) % 2 == 1
    bare = F.regexp_replace(F.when(inside, F.concat(F.lit('"'), "plain")).otherwise(F.col("plain")), '"[^"]*(?:"|$)', '""')
    pieces = pieces.select("block", "row", "value", bare.alias("bare"), (count(bare, "{") - F.when(until, 0).otherwise(1)).alias("delta"), until.alias("open"))
    pieces = pinned(pieces, "pieces")
    pieces = _before(pieces, F.col("delta"), "depth")
    ends = ~F.col("open") & (F.col("depth") + F.col("delta") == 0)
    pieces = pieces.withColumn("ends", ends.cast("int")).withColumn("starts", (F.col("depth") == 0) & F.contains("bare", F.lit("{")))
    pieces = _before(pieces, F.col("ends"), "ord")
    # what stands outside of objects: one bracket before the first, commas between, one bracket behind the last
    first = F.col("ord") == 0
    lead = F.regexp_extract("bare", r"^([^{]*)", 1)
    wrong = F.when(F.col("starts"), ~F.when(first, lead.rlike(r"^\s*\[\s*$")).otherwise(lead.rlike(r"^\s*,\s*$"))).otherwise(
        (F.col("depth") == 0) & ~F.col("bare").rlike(r"^\s*\]\s*$"))
    tails = F.count_if((F.col("depth") == 0) & ~F.col("starts"))
    bad = pieces.agg((F.coalesce(F.max(wrong), F.lit(False)) | (tails != 1)).alias("bad"))
    whole = pieces.where("depth > 0 or starts").groupBy("ord").agg(
        F.sort_array(F.collect_list(F.struct("block", "row", "value"))).alias("parts"), F.max("ends").alias("done"))  # of one object
    text = F.regexp_replace(F.concat(F.array_join(F.transform("parts", lambda p: p["value"]), "}"), F.lit("}")), r"^[\s,\[]+", "")
    return whole.where("done = 1").crossJoin(F.broadcast(bad)).where("NOT bad").select("ord", text.alias("element"))


def load_registry_ats(spark: SparkSession, registry_dir: str, ats: str, whole_bytes: int = WHOLE_BYTES) -> DataFrame:
    """Registry of one ATS with its order: a JSON array file, or the folder of
    JSON lines that the registry export writes.  An unknown or unreadable ATS
    gives an empty table with the registry schema.

    A file of up to ``whole_bytes`` is read as one text, a larger one in pieces
    by many tasks; the rows are the same."""
    if ats not in ATS_ORD:
        return _empty_registry(spark)
    folder = registry_dir.rstrip("/")
    fs, path = file_system(spark, f"{folder}/{ats}.json")
    if not fs.exists(path):
        return _load_export(spark, folder, ats)
    if fs.getFileStatus(path).getLen() <= whole_bytes:
        text = spark.read.text(f"{folder}/{ats}.json", wholetext=True)
        rows = text.select(F.from_json("value", f"ARRAY<STRUCT<{REGISTRY_DDL}>>").alias("a")).select(F.posexplode("a").alias("ord", "c"))
    else:
        rows = array_elements(spark, f"{folder}/{ats}.json").select("ord", F.from_json("element", f"STRUCT<{REGISTRY_DDL}>").alias("c"))
    return rows.select(
        F.lit(ats).alias("ats"),
        F.lit(ATS_ORD[ats]).alias("ats_ord"),
        F.col("ord").cast("int").alias("ord"),
        "c.slug",
        "c.name",
        "c.sector",
    )


def _load_export(spark: SparkSession, folder: str, ats: str) -> DataFrame:
    """One platform of a registry export (JSON lines, read by many tasks)."""
    try:
        rows = spark.read.schema(f"ord INT, {REGISTRY_DDL}").json(f"{folder}/ats={ats}")
    except AnalysisException:
        return _empty_registry(spark)
    return rows.select(F.lit(ats).alias("ats"), F.lit(ATS_ORD[ats]).alias("ats_ord"), "ord", "slug", "name", "sector")


def load_registry(spark: SparkSession, registry_dir: str) -> DataFrame:
    """All platforms, in the fixed order greenhouse, lever, ashby."""
    out = None
    for ats in ATS_NAMES:
        df = load_registry_ats(spark, registry_dir, ats)
        out = df if out is None else out.unionByName(df)
    return out


def registry_from_table(df: DataFrame) -> DataFrame:
    """Adopt a registry held as a table (ats, slug, name, sector[, ord])."""
    cols = set(df.columns)
    ords = F.col("ord").cast("int") if "ord" in cols else F.lit(0)
    ats_ord = F.when(F.col("ats") == ATS_NAMES[0], 0)
    for i, name in enumerate(ATS_NAMES[1:], start=1):
        ats_ord = ats_ord.when(F.col("ats") == name, i)
    return df.select(
        "ats", ats_ord.alias("ats_ord"), ords.alias("ord"), "slug", "name",
        (F.col("sector") if "sector" in cols else F.lit(None).cast("string")).alias("sector"),
    )
