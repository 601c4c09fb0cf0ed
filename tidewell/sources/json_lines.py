"""JSON Lines files: listing, reading with source positions, batch loads."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Observation, SparkSession, Window
from pyspark.sql import functions as F

from tidewell.sources.records import RAW_COLUMNS, RAW_SCHEMA, is_malformed
from tidewell.streaming.publish import batch_folders, path_exists, write_once

# Fixed value: the files an automatic load takes.
FILE_PATTERN = ".*[.]json[.]gz"

LOADED, REJECTED = "loaded", "rejected"
_REFUSED = "malformed row "


class RejectedLoad(ValueError):
    """A load that accepts all rows or none met a malformed one."""


def list_source(spark: SparkSession, prefix: str, pattern: str | None = None) -> DataFrame:
    """Files under a prefix, optionally those whose path matches a regular expression."""
    files = (spark.read.format("binaryFile").option("recursiveFileLookup", "true").load(prefix)
             .select("path", "length", "modificationTime"))
    return files if pattern is None else files.filter(F.col("path").rlike(f"^{pattern}$"))


def positioned(lines: DataFrame) -> DataFrame:
    """Give each line its 1-based number within its file.

    `lines` has `value`, `source_filename` and `block_start`. A scan task reads a
    block front to back, so within a block the running row id counts lines; the
    lines of earlier blocks of the file come from a table with one row per block.
    No window holds a whole file, and large uncompressed files may be split.
    """
    walked = lines.withColumn("_id", F.monotonically_increasing_id())
    blocks = walked.groupBy("source_filename", "block_start").agg(
        F.min("_id").alias("_first"), F.count("*").alias("_lines"))
    earlier = Window.partitionBy("source_filename").orderBy("block_start").rowsBetween(Window.unboundedPreceding, -1)
    shifts = blocks.withColumn("_before", F.coalesce(F.sum("_lines").over(earlier), F.lit(0)))
    number = F.col("_id") - F.col("_first") + F.col("_before") + 1
    return walked.join(shifts, ["source_filename", "block_start"]).select(
        F.col("value").alias("payload"), "source_filename", number.cast("bigint").alias("source_row_number"))


def with_position(text: DataFrame) -> DataFrame:
    """The columns `positioned` needs, from a batch or streaming text scan."""
    return text.select("value", F.col("_metadata.file_path").alias("source_filename"),
                       F.col("_metadata.file_block_start").alias("block_start"))


def read_json_lines(spark: SparkSession, prefix: str, glob: str = "*.json.gz", now: Column | None = None) -> DataFrame:
    """One raw row per line, in the envelope; compression follows from the file name."""
    text = spark.read.option("recursiveFileLookup", "true").option("pathGlobFilter", glob).text(prefix)
    moment = F.current_timestamp() if now is None else now
    return positioned(with_position(text)).withColumn("ingested_at", moment)


def read_manifest(spark: SparkSession, path: str) -> DataFrame:
    """A manifest file: one JSON document over many lines, with `files`, an array of (path, physical_records)."""
    schema = "files array<struct<path:string,physical_records:bigint>>"
    return spark.read.schema(schema).option("multiLine", "true").option("mode", "FAILFAST").json(path)


def as_variant(raw: DataFrame) -> DataFrame:
    """Raw rows with a VARIANT payload; malformed lines become null."""
    return raw.withColumn("payload", F.try_parse_json("payload"))


def unseen_files(offered: DataFrame, loaded: DataFrame) -> DataFrame:
    """Rows of files that were never loaded; a copy under a new name is unseen."""
    names = loaded.select("source_filename").distinct()
    return offered.join(names, "source_filename", "left_anti")


def mark_malformed(raw: DataFrame) -> DataFrame:
    """Add `load_status`, loaded or rejected; both go to one table in one write."""
    bad = is_malformed(F.col("payload"))
    return raw.withColumn("load_status", F.when(bad, REJECTED).otherwise(LOADED))


def raw_files(spark: SparkSession, table: str) -> DataFrame:
    """All rows of a raw table; a load that was refused leaves none."""
    return spark.read.schema(f"{RAW_SCHEMA}, load_status string").parquet(table)


def raw_table(spark: SparkSession, table: str) -> DataFrame:
    """Loaded rows of a raw table."""
    return raw_files(spark, table).filter(F.col("load_status") == LOADED).select(*RAW_COLUMNS)


def rejected_rows(spark: SparkSession, table: str) -> DataFrame:
    """Malformed rows of a raw table, kept as they came."""
    return (raw_files(spark, table).filter(F.col("load_status") == REJECTED).select(*RAW_COLUMNS)
            .withColumn("reason", F.lit("malformed JSON")))


# ---- load ledger ---------------------------------------------------------

#: One row per file and load: what it held, and when it came.
LEDGER_SCHEMA = "source_filename string, load string, row_count bigint, error_count bigint, loaded_at timestamp"


def _ledger_folder(table: str) -> str:
    return f"{table}/_ledger"  # readers of the raw table pass over names with an underscore


def counted_files(marked: DataFrame, load: Column) -> DataFrame:
    """Ledger rows of marked lines: counted by each task before the shuffle, so a file of any size is one row."""
    return marked.groupBy("source_filename").agg(
        F.count_if(F.col("load_status") == LOADED).alias("row_count"), F.count_if(F.col("load_status") == REJECTED).alias("error_count"),
        F.max("ingested_at").alias("loaded_at")).select(
        "source_filename", load.alias("load"), "row_count", "error_count", "loaded_at")


def note_load(spark: SparkSession, table: str, load: str) -> None:
    """Enter a finished batch of a raw table into its ledger; it reads that batch alone, and of it no payload."""
    batch = spark.read.schema(f"{RAW_SCHEMA}, load_status string").parquet(f"{table}/batch={load}")
    write_once(counted_files(batch, F.lit(load)).coalesce(1), _ledger_folder(table), load)


def ledger(spark: SparkSession, table: str) -> DataFrame:
    """Files of a raw table, one row per file and load.

    A batch counts as loaded when it is written. One whose ledger entry is missing, because
    its run was lost in between, is entered here, so no file is taken for new.
    """
    for load in sorted(set(batch_folders(spark, table)) - set(batch_folders(spark, _ledger_folder(table)))):
        note_load(spark, table, load)
    if not path_exists(spark, _ledger_folder(table)):
        return spark.createDataFrame([], LEDGER_SCHEMA)
    return spark.read.schema(LEDGER_SCHEMA).parquet(f"{_ledger_folder(table)}/batch=*")


def ingest_batch(
    spark: SparkSession, prefix: str, table: str, load: str, glob: str = "*.json.gz", on_error: str = "abort"
) -> dict[str, int]:
    """Load the prefix's files that are not in the raw table yet, as the load `load`; how many rows came, and were rejected.

    `abort` fails the write, and so loads nothing, when any row is malformed.
    `continue` keeps malformed rows aside as rejected. Files count as loaded by their
    names in the ledger, not by the load's: a load name used before takes what is new as `load.2`.
    """
    if on_error not in ("abort", "continue"):
        raise ValueError(f"on_error is abort or continue, not {on_error}")
    raw = read_json_lines(spark, prefix, glob)
    if path_exists(spark, table):
        raw = unseen_files(raw, ledger(spark, table))
    name, times = load, 1
    while path_exists(spark, f"{table}/batch={name}/_SUCCESS"):
        times += 1
        name = f"{load}.{times}"
    if times > 1 and raw.isEmpty():
        return {"rows": 0, "rejected": 0}
    return load_rows(raw, table, name, on_error)


def load_rows(raw: DataFrame, table: str, load: str, on_error: str = "abort") -> dict[str, int]:
    """Write raw rows as one batch and enter it into the ledger; what was written is counted in the same pass."""
    marked = mark_malformed(raw)
    if on_error == "abort":
        refusal = F.raise_error(F.concat(F.lit(_REFUSED), F.col("source_row_number").cast("string"),
                                         F.lit(" of "), F.col("source_filename")))
        marked = marked.withColumn(
            "load_status", F.when(F.col("load_status") == REJECTED, refusal.cast("string")).otherwise(F.col("load_status")))
    seen = Observation()
    counted = marked.observe(seen, F.count(F.lit(1)).alias("rows"), F.count_if(F.col("load_status") == REJECTED).alias("rejected"))
    try:
        written = write_once(counted, table, load, ("load_status",))
    except Exception as e:
        if _REFUSED in str(e):
            raise RejectedLoad(f"{load} of {table} holds a malformed row; nothing was loaded") from e
        raise
    note_load(raw.sparkSession, table, load)
    return dict(seen.get) if written else {"rows": 0, "rejected": 0}
