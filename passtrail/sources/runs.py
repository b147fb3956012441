"""Run trees: run directories, manifests, snapshot files."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from passtrail.functions import ir
from passtrail.functions import text as tx
from passtrail.sources.streams import read_files, run_dir_of

def _fields(**kinds: T.DataType) -> T.StructType:
    return T.StructType([T.StructField(name, kind) for name, kind in kinds.items()])


_TEXT, _INT, _LONG = T.StringType(), T.IntegerType(), T.LongType()
SNAPSHOT_TYPE = _fields(
    index=_INT, pass_class=_TEXT, pass_name=_TEXT, filename=_TEXT, bytes=_LONG, lines=_INT, sha256=_TEXT, parent_sha256=_TEXT,
    roundtrip_status=_TEXT,
)
MANIFEST_TYPE = _fields(
    source=_TEXT, source_sha256=_TEXT, stream_file=_TEXT, stream_sha256=_TEXT, snapshot_count=_INT,
    snapshots=T.ArrayType(_TEXT), snapshots_kept=_INT, snapshots_dropped=_INT,
)


def scan_runs(listing: DataFrame, run_dir: str = "run_dir") -> DataFrame:
    """Benchmark name and time stamp of run directories; other directories are left out."""
    name = F.col(run_dir)
    return listing.filter(ir.is_run_dir(name)).withColumns(
        {"benchmark_name": ir.run_dir_benchmark(name), "run_timestamp": ir.run_dir_timestamp(name)}
    )


def parse_manifest(raw: Column) -> Column:
    """A manifest's fields, each taken for itself: a value of another type makes that field null and no other.

    The elements of ``snapshots`` are parsed one by one, so one that is broken stands alone with null fields. Numbers may be
    written as text.
    """
    texts = F.from_json(raw, _as_text(MANIFEST_TYPE))

    def element(text: Column) -> Column:
        return _typed(F.from_json(text, _as_text(SNAPSHOT_TYPE)), SNAPSHOT_TYPE)

    def parsed(fields: Column) -> Column:
        typed = _typed(fields, MANIFEST_TYPE)
        return typed.withField("snapshots", F.transform(F.from_json(fields["snapshots"], "array<string>"), element))

    return tx.let(texts, parsed)


def _as_text(fields: T.StructType) -> T.StructType:
    return T.StructType([T.StructField(f.name, T.StringType()) for f in fields])


def _typed(texts: Column, fields: T.StructType) -> Column:
    columns = [
        texts[f.name].try_cast(f.dataType).alias(f.name) if not isinstance(f.dataType, T.ArrayType) else texts[f.name].alias(f.name)
        for f in fields
    ]
    return F.struct(*columns)


def decode_manifests(documents: DataFrame, raw: str = "raw") -> DataFrame:
    """Add ``manifest``, null where the document is not valid JSON, and ``source_sha256``.

    The hash is '' only where its key is absent; an explicit null stays null.
    """
    # The keys of the outermost object; unlike json_object_keys, this takes numbers such as NaN, as the parser does.
    keys = F.map_keys(F.from_json(raw, "map<string,string>"))
    # The parser stops after the first value. Read as the elements of an array, a document with more text after it is
    # either broken or has a second element.
    elements = F.from_json(F.concat(F.lit("["), raw, F.lit("]")), "array<string>")
    manifest = parse_manifest(F.col(raw))
    listed = ~F.array_contains(keys, "snapshots") | manifest["snapshots"].isNotNull()
    valid = keys.isNotNull() & (F.size(elements) == 1) & listed
    return (
        documents.withColumn("manifest", F.when(valid, manifest))
        .withColumn(
            "source_sha256",
            F.when(F.array_contains(keys, "source_sha256"), F.col("manifest.source_sha256")).otherwise(F.lit("")),
        )
    )


def read_manifest_documents(spark: SparkSession, root: str) -> DataFrame:
    """One row per ``<run>/snapshots/manifest*.json``, decoded. A large run may have its manifest in parts."""
    return manifest_documents(_in_snapshot_folders(spark, root, "manifest*.json"))


def manifest_documents(files: DataFrame) -> DataFrame:
    """Manifest files (path, content), decoded; files that are not a run's manifest are left out."""
    path = F.col("path")
    files = files.select(
        path,
        F.regexp_extract(path, r"\A(.*)/[^/]*\z", 1).alias("snapshot_dir"),
        run_dir_of(path, 1).alias("_inner"),
        run_dir_of(path, 2).alias("run_dir"),
        F.coalesce(F.regexp_extract(path, r"/manifest\.part-(\d+)\.json\z", 1).try_cast("bigint"), F.lit(0)).alias(
            "manifest_part"
        ),
        F.make_valid_utf8(F.col("content").cast("string")).alias("raw"),
    )
    named = files.filter((F.col("_inner") == "snapshots") & path.rlike(r"/manifest(\.part-\d+)?\.json\z"))
    return decode_manifests(scan_runs(named.drop("_inner")))


def read_manifests(spark: SparkSession, root: str) -> DataFrame:
    return of_documents(read_manifest_documents(spark, root).filter("manifest is not null"))


def of_documents(documents: DataFrame) -> DataFrame:
    return documents.select(
        "run_dir", "benchmark_name", "run_timestamp", "snapshot_dir", "manifest_part", "source_sha256",
        F.col("manifest.snapshots").alias("snapshots"),
    )


def rejected_manifests(spark: SparkSession, root: str) -> DataFrame:
    """Manifests that are not one JSON object with a list of snapshots; their runs are skipped."""
    return read_manifest_documents(spark, root).filter("manifest is null").select("path", "run_dir", "raw")


def run_times(spark: SparkSession, root: str) -> DataFrame:
    """(run_dir, benchmark_name, run_timestamp, modified) of run directories, by the newest file directly in each."""
    files = spark.read.format("binaryFile").load(f"{root}/*/*")
    files = files.select(run_dir_of(F.col("path"), 1).alias("run_dir"), "modificationTime")
    return scan_runs(files.groupBy("run_dir").agg(F.max("modificationTime").alias("modified")))


def _in_snapshot_folders(spark: SparkSession, root: str, name_glob: str = "*") -> DataFrame:
    """Files directly in the ``snapshots`` folders of runs directly below ``root``: the one scope of manifests, listing and texts."""
    return spark.read.format("binaryFile").option("pathGlobFilter", name_glob).load(f"{root}/*/snapshots")


def snapshot_listing(spark: SparkSession, root: str) -> DataFrame:
    """Paths of all snapshot files; no content is read."""
    return _in_snapshot_folders(spark, root).select("path")


def snapshot_texts(spark: SparkSession, root: str) -> DataFrame:
    """(path, text) of snapshot files.

    Only the snapshot folders are loaded: a filter by path would come after the content of the dump streams and logs that
    lie next to them had been read.
    """
    return _in_snapshot_folders(spark, root).select("path", tx.decode_text(F.col("content")).alias("text"))
