"""Sources and sinks.

Link rows live in a region/day tree ``<root>/<region_type>/<region>/<hazard>/
<YYYY>/<MM>/<DD>/results.csv`` (not key=value).  ``read_links`` scans it once
with the CSV source and derives the partition columns from the file path;
``write_links`` rewrites them Hive-partitioned so later reads get native
partition pruning.  Articles and run statistics are JSON.
"""

from __future__ import annotations

import json
import re
import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

LINK_COLUMNS = ["Title", "Link", "Date", "Source", "Summary", "Term", "LanguageQueried"]
LINK_SCHEMA = T.StructType([T.StructField(c, T.StringType()) for c in LINK_COLUMNS])
PATH_RE = r"/([^/]+)/([^/]+)/([^/]+)/(\d{4})/(\d{2})/(\d{2})/results\.csv$"

OTHER_INFO = T.StructType([T.StructField(c, T.StringType()) for c in
                           ["csv_title", "csv_source", "csv_summary", "csv_date", "csv_term", "csv_language_queried"]])
ARTICLE_SCHEMA = T.StructType([
    T.StructField("id", T.StringType()), T.StructField("title", T.StringType()),
    T.StructField("final_url", T.StringType()), T.StructField("original_url", T.StringType()),
    T.StructField("normalized_url", T.StringType()), T.StructField("article_text", T.StringType()),
    T.StructField("article_language", T.StringType()), T.StructField("other_info", OTHER_INFO),
    T.StructField("state", T.StringType()), T.StructField("disaster_type", T.StringType()),
    T.StructField("extraction_timestamp", T.StringType()), T.StructField("extraction_quality", T.StringType()),
])
LANG_ENTRY = T.StructType([T.StructField("count", T.LongType()), T.StructField("percentage", T.DoubleType())])
STATS_SCHEMA = T.StructType([
    T.StructField("extraction_date", T.StringType()), T.StructField("total_articles", T.LongType()),
    T.StructField("language_stats", T.StructType([
        T.StructField("total_articles", T.LongType()),
        T.StructField("language_distribution", T.MapType(T.StringType(), LANG_ENTRY))])),
    T.StructField("quality_breakdown", T.StructType([T.StructField(q, T.LongType()) for q in ("high", "medium", "low")])),
    T.StructField("region_breakdown", T.MapType(T.StringType(), T.LongType())),
    T.StructField("disaster_breakdown", T.MapType(T.StringType(), T.LongType())),
    T.StructField("deduplication", T.StructType([
        T.StructField("original_count", T.LongType()), T.StructField("final_count", T.LongType()),
        T.StructField("removal_percentage", T.DoubleType()), T.StructField("url_duplicates_removed", T.LongType()),
        T.StructField("title_duplicates_removed", T.LongType()), T.StructField("content_duplicates_removed", T.LongType())])),
    T.StructField("extraction_timestamp", T.StringType()),
])
DIRECTORY_SCHEMA = T.StructType([T.StructField(c, T.StringType()) for c in
                                 ["State/UT", "Newspaper Name", "Website", "Language(s)"]])
FEED_SCHEMA = T.StructType([
    T.StructField("title", T.StringType()), T.StructField("link", T.StringType()),
    T.StructField("published", T.StringType()), T.StructField("summary", T.StringType()),
    T.StructField("source", T.StructType([T.StructField("title", T.StringType())])),
])


ITEM_SCHEMA = T.StructType([
    T.StructField("title", T.StringType()), T.StructField("link", T.StringType()),
    T.StructField("pubDate", T.StringType()), T.StructField("description", T.StringType()),
    T.StructField("source", T.StructType([T.StructField("_VALUE", T.StringType()), T.StructField("_url", T.StringType())])),
])


def _exists(spark: SparkSession, path: str) -> bool:
    jvm = spark.sparkContext._jvm
    p = jvm.org.apache.hadoop.fs.Path(path)
    return p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).exists(p)


def _link_files(spark: SparkSession, root: str) -> DataFrame:
    """One row a ``results.csv``: file, width (cells of its header), reason (why it can't be read, or null)."""
    whole = (spark.read.option("recursiveFileLookup", True).option("pathGlobFilter", "results.csv").text(root, wholetext=True)
             .select(F.col("_metadata.file_path").alias("file"), "value"))
    head = F.split(F.regexp_replace(F.split_part("value", F.lit("\n"), F.lit(1)), "\r$", ""), ",")
    names = F.transform(head, lambda c: F.btrim(c, F.lit('"\ufeff')))
    return whole.select("file", F.size(head).alias("width"), (
        F.when(~F.is_valid_utf8("value"), "not UTF-8")
        .when(F.length(F.regexp_replace("value", '[^"]', "")) % 2 == 1, "unclosed quote")
        .when(~F.array_contains(names, "Link"), "no Link column")).alias("reason"))


def _link_cells(spark: SparkSession, root: str, files: DataFrame) -> DataFrame:
    """file, _row, _cells of the readable files, as wide as the widest header and a cell more."""
    width = (files.where("reason IS NULL").agg(F.max("width")).first()[0] or 0) + 1
    raw = (spark.read.option("header", False).option("multiLine", True).option("escape", '"')
           .option("recursiveFileLookup", True).option("pathGlobFilter", "results.csv")
           .schema(T.StructType([T.StructField(f"_c{i}", T.StringType()) for i in range(width)])).csv(root))
    raw = raw.select(F.array(*[F.col(f"_c{i}") for i in range(width)]).alias("_cells"), F.col("_metadata.file_path").alias("file"),
                     F.monotonically_increasing_id().alias("_row"))
    raw = raw.join(files.where("reason IS NULL").select("file"), "file", "left_semi")
    # a CSV with multi-line rows isn't split, so a file's rows are numbered in one task; its header is the first
    head = raw.groupBy("file").agg(F.min_by("_cells", "_row").alias("_head"), F.min("_row").alias("_first"))
    x = raw.join(head, "file").where(F.col("_row") > F.col("_first"))
    return x.withColumn("_over", F.exists(F.slice("_cells", F.size(F.array_compact("_head")) + 1, width), lambda c: c.isNotNull()))


def link_rejects(spark: SparkSession, root: str) -> DataFrame:
    """A1 — the files that ``read_links`` leaves out, as a reader that gives up on a damaged file does: (file, reason).

    ``not UTF-8``, ``unclosed quote`` (also of a truncated file), ``no Link
    column``, ``more cells than the header``. Trailing empty cells are none.
    """
    if not _exists(spark, root):
        return spark.createDataFrame([], "file string, reason string")
    files = _link_files(spark, root)
    over = _link_cells(spark, root, files).where("_over").select("file").distinct().withColumn("reason", F.lit("more cells than the header"))
    return files.where("reason IS NOT NULL").select("file", "reason").unionByName(over)


def read_links(spark: SparkSession, root: str) -> DataFrame:
    """A1 — every ``results.csv`` of the region/day tree, with the partition
    columns parsed from the path and ``seq``, the struct (file, row in file).

    Columns are found by the name in each file's header, whatever their order
    and number.  A damaged file, or one without a ``Link`` column, is left out
    whole, as the reference does; ``link_rejects`` names them.
    ``escape='"'`` is required: summaries hold doubled quotes.
    """
    if not _exists(spark, root):
        return spark.createDataFrame([], LINK_SCHEMA).select(
            "*", *[F.lit(None).cast("string").alias(c) for c in ("region_type", "region", "disaster_type", "file")],
            F.lit(None).cast("date").alias("run_date"), F.lit(None).cast("struct<file:string,row:bigint>").alias("seq"))
    x = _link_cells(spark, root, _link_files(spark, root))
    over = x.where("_over").select("file").distinct()
    x = x.join(over, "file", "left_anti")
    names = F.transform("_head", lambda c: F.btrim(c, F.lit("\ufeff")))
    value = lambda c: F.try_element_at("_cells", F.nullif(F.array_position(names, c), F.lit(0)).cast("int"))
    df = x.select(*[value(c).alias(c) for c in LINK_COLUMNS], "file",
                  F.struct("file", (F.col("_row") - F.col("_first")).alias("row")).alias("seq"))
    g = lambda i: F.regexp_extract("file", PATH_RE, i)
    out = df.select("*", g(1).alias("region_type"), g(2).alias("region"), g(3).alias("disaster_type"),
                    F.try_to_date(F.concat_ws("-", g(4), g(5), g(6)), "yyyy-MM-dd").alias("run_date"))
    return out.where(F.col("region") != "")


def links_for_dates(links: DataFrame, today: str, days_range: int = 0) -> DataFrame:
    """A2 — partitions whose run date is in [today − days_range, today]."""
    t = F.to_date(F.lit(today))
    return links.where(F.col("run_date").between(F.date_sub(t, days_range), t))


LINK_KEYS = ["region_type", "region", "disaster_type", "run_date"]


def write_links(df: DataFrame, root: str, fmt: str = "csv") -> None:
    """Idempotent per-partition overwrite (dynamic partition overwrite),
    Hive-partitioned by region_type / region / disaster_type / run_date.

    The rebalance hint gathers a partition's rows into few files and splits
    a large region/day; the session's own overwrite mode is left alone.
    """
    (df.hint("rebalance", *LINK_KEYS).write.mode("overwrite").partitionBy(*LINK_KEYS)
     .option("partitionOverwriteMode", "dynamic").option("maxRecordsPerFile", 1_000_000)
     .option("header", True).option("escape", '"').format(fmt).save(root))


def clear_link_range(spark: SparkSession, root: str, start: str, end: str, region: str | None = None) -> int:
    """Remove the Hive partitions of [start, end] (one region or all).

    Only the folders of the days asked for are listed, by name; partition
    folders are metadata, so this is file-system work on the driver.
    """
    import datetime as dt
    jvm = spark.sparkContext._jvm
    base = jvm.org.apache.hadoop.fs.Path(root)
    fs = base.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    if not fs.exists(base):
        return 0
    lo, hi = dt.date.fromisoformat(start), dt.date.fromisoformat(end)
    removed = 0
    for i in range((hi - lo).days + 1):
        pattern = f"{root}/region_type=*/region={region or '*'}/disaster_type=*/run_date={lo + dt.timedelta(i)}"
        for st in fs.globStatus(jvm.org.apache.hadoop.fs.Path(pattern)) or []:
            fs.delete(st.getPath(), True)
            removed += 1
    return removed


# A published link table: ``_versions/<n>.json`` lists its folders, the newest
# file counts.  Folders of a write that was never published are not listed.
VERSIONS, ATTEMPTS = "_versions", "_attempts"
FOLDER_RE = r"region_type=([^/]+)/region=([^/]+)/disaster_type=([^/]+)/run_date=([^/]+)"


def _fs(spark: SparkSession, path: str):
    p = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    return p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()), p


def _folders(spark: SparkSession, root: str, under: str = "") -> list[str]:
    """The region/day folders under ``root``, relative to it."""
    base = f"{root}/{under}" if under else root
    fs, p = _fs(spark, f"{base}/region_type=*/region=*/disaster_type=*/run_date=*")
    tail = lambda st: "/".join(st.getPath().toString().split("/")[-4:])
    return [f"{under}/{tail(st)}" if under else tail(st) for st in fs.globStatus(p) or []]


def published_links(spark: SparkSession, root: str) -> tuple[int, list[str]]:
    """(version, folders) of the link table; version 0 is a table that no commit has published yet: all its folders."""
    fs, p = _fs(spark, f"{root}/{VERSIONS}/*.json")
    names = sorted(st.getPath().getName() for st in fs.globStatus(p) or [])
    if not names:
        return 0, _folders(spark, root)
    lines = spark.read.text(f"{root}/{VERSIONS}/{names[-1]}").collect()  # one folder a line
    return int(names[-1].removesuffix(".json")), [json.loads(r["value"])["folder"] for r in lines]


def _publish(spark: SparkSession, root: str, version: int, folders: list[str]) -> None:
    """Make ``folders`` the table, in one rename; a version that another writer has published is an error."""
    fs, target = _fs(spark, f"{root}/{VERSIONS}/{version:012d}.json")
    _, draft = _fs(spark, f"{root}/{VERSIONS}/.{uuid.uuid4().hex}")
    out = fs.create(draft, False)
    out.write(bytearray("".join(json.dumps({"folder": f}) + "\n" for f in folders), "utf-8"))
    out.close()
    if fs.exists(target) or not fs.rename(draft, target):
        fs.delete(draft, False)
        raise RuntimeError(f"version {version} of {root} has been published by another writer")


def replace_links(df: DataFrame, root: str, start: str, end: str, region: str | None = None, fmt: str = "csv") -> int:
    """A3 — the whole write: each link once (the first by ``seq``), then the
    rows whose ``Date`` lies in [start, end], under the end date, in place of
    those days (of one region or all).  No such row: nothing changes.

    Repeated links go first, as in the reference: a link whose first copy has
    no date is not written.  The reference would also write dated rows outside
    the range, which its collection has filtered out before.  New folders are written
    first, under a name of this attempt, and become the table together with
    the removal of the old ones by one new version file, so a reader sees the
    old days or the new, and a writer that stops in between changes nothing.
    ``drop_unpublished`` removes folders that no version lists any more.

    Returns the number of links written.
    """
    spark = df.sparkSession
    payload = [c for c in df.columns if c not in ("seq", "run_date")]
    once = (df.groupBy("region_type", "region", "disaster_type", "Link")
            .agg(F.min(F.struct("seq", *[c for c in payload if c not in LINK_KEYS and c != "Link"])).alias("_r"))
            .select("region_type", "region", "disaster_type", "Link", "_r.*").drop("seq"))
    dated = once.where(F.try_to_date(F.substring("Date", 1, 10), "yyyy-MM-dd").between(F.to_date(F.lit(start)), F.to_date(F.lit(end))))
    version, live = published_links(spark, root)
    attempt = f"{ATTEMPTS}/{uuid.uuid4().hex}"
    write_links(dated.select(*payload, F.to_date(F.lit(end)).alias("run_date")), f"{root}/{attempt}", fmt)
    added = _folders(spark, root, attempt)
    if not added:
        return 0
    n = _read_folders(spark, root, added, fmt).count()

    def replaced(folder: str) -> bool:
        _, reg, _, day = re.search(FOLDER_RE, folder).groups()
        return start <= day <= end and region in (None, reg)
    _publish(spark, root, version + 1, [f for f in live if not replaced(f)] + added)
    return n


def drop_unpublished(spark: SparkSession, root: str) -> int:
    """Delete the folders that the newest version doesn't list; returns how many.  Not while a writer or an older reader runs."""
    version, live = published_links(spark, root)
    if not version:
        return 0
    fs, p = _fs(spark, f"{root}/{ATTEMPTS}/*")
    every = _folders(spark, root) + [f for st in fs.globStatus(p) or [] for f in _folders(spark, root, f"{ATTEMPTS}/{st.getPath().getName()}")]
    gone = [f for f in every if f not in set(live)]
    for f in gone:
        fs.delete(_fs(spark, f"{root}/{f}")[1], True)
    return len(gone)


def _read_folders(spark: SparkSession, root: str, folders: list[str], fmt: str) -> DataFrame:
    r = spark.read.format(fmt).option("header", True).option("escape", '"').option("multiLine", True)
    df = r.load([f"{root}/{f}" for f in folders]).withColumn("_path", F.col("_metadata.file_path"))
    keys = [F.regexp_extract("_path", FOLDER_RE, i + 1).alias(k) for i, k in enumerate(LINK_KEYS)]
    df = df.select("*", *[F.nullif(c, F.lit("__HIVE_DEFAULT_PARTITION__")).alias(k) for c, k in zip(keys, LINK_KEYS)])
    return df.drop("_path").withColumn("run_date", F.col("run_date").cast("date"))


def read_links_hive(spark: SparkSession, root: str, fmt: str = "csv", start: str | None = None, end: str | None = None) -> DataFrame:
    """The link table written by ``write_links`` or ``replace_links``.

    A published table is read by its newest version, and of it only the
    folders of the days [start, end] where they are given.
    """
    version, folders = published_links(spark, root)
    day = lambda f: re.search(FOLDER_RE, f).group(4)
    if version and folders:
        df = _read_folders(spark, root, [f for f in folders if (start or "") <= day(f) <= (end or "9999")] or folders[:1], fmt)
    else:
        r = spark.read.format(fmt).option("header", True).option("escape", '"').option("multiLine", True)
        df = r.load(root)
        df = df.withColumn("run_date", F.col("run_date").cast("date"))
    return df.where(F.col("run_date").between(start or "0001-01-01", end or "9999-12-31")) if start or end else df


def write_articles(df: DataFrame, root: str, extraction_date: str) -> None:
    """A4 — all articles partitioned by date and grade (the "combined" main
    output is the high ∪ medium filter of the same data, not a copy).
    Other dates stay as they are."""
    (df.withColumn("extraction_date", F.lit(extraction_date))
     .write.mode("overwrite").option("partitionOverwriteMode", "dynamic")
     .partitionBy("extraction_date", "extraction_quality").json(root))


def read_articles(spark: SparkSession, root: str, json_arrays: bool = False) -> DataFrame:
    """A7 — articles back, from our partitioned JSON or from files holding one
    JSON array each (``json_arrays=True``)."""
    if json_arrays:
        return (spark.read.schema(ARTICLE_SCHEMA).option("multiLine", True).json(root)
                .withColumn("file", F.col("_metadata.file_path")))
    data_cols = T.StructType([f for f in ARTICLE_SCHEMA.fields if f.name != "extraction_quality"])
    return spark.read.schema(data_cols).json(root)  # partition columns come from the folders


def main_articles(articles: DataFrame) -> DataFrame:
    """The main output: high then medium."""
    return articles.where(F.col("extraction_quality").isin("high", "medium"))


def write_run_stats(stats: DataFrame, path: str) -> None:
    """A5 — the one-row nested statistics document."""
    stats.coalesce(1).write.mode("overwrite").json(path)


def read_run_stats(spark: SparkSession, root: str) -> DataFrame:
    """A8 — every statistics file (explicit schema: language keys stay map keys)."""
    return (spark.read.schema(STATS_SCHEMA).option("multiLine", True).json(root)
            .withColumn("file", F.col("_metadata.file_path")))


def latest_run_stats(stats: DataFrame) -> DataFrame:
    """A8 — the newest document by extraction_timestamp."""
    return stats.agg(F.max_by(F.struct(*stats.columns), F.col("extraction_timestamp")).alias("s")).select("s.*")


def read_source_directory(spark: SparkSession, path: str) -> DataFrame:
    """A6 — the newspaper directory; a missing file is an empty frame."""
    if not _exists(spark, path):
        return spark.createDataFrame([], DIRECTORY_SCHEMA)
    return spark.read.schema(DIRECTORY_SCHEMA).option("header", True).option("escape", '"').csv(path)


def read_feed(spark: SparkSession, path: str, fmt: str = "json") -> DataFrame:
    """A9 — landed feed entries (JSON lines, or RSS XML with rowTag=item);
    missing summary / source become ''."""
    if fmt == "xml":
        df = spark.read.format("xml").option("rowTag", "item").schema(ITEM_SCHEMA).load(path)
        return df.select("title", "link", F.col("pubDate").alias("published"),
                         F.coalesce("description", F.lit("")).alias("summary"),
                         F.coalesce("source._VALUE", F.lit("")).alias("source_title"))
    df = spark.read.schema(FEED_SCHEMA).json(path)
    return df.select("title", "link", "published", F.coalesce("summary", F.lit("")).alias("summary"),
                     F.coalesce(F.col("source.title"), F.lit("")).alias("source_title"))
