"""File readers: CSV with and without header, schema-inferred previews,
directory listings, binary files, many CSVs with differing headers, zip
archives.

Readers are lazy DataFrames; listings use Spark's ``binaryFile`` source (the
listing itself runs on the cluster for large directories).
"""

from __future__ import annotations

import hashlib
import io
import zipfile

import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, BinaryType, LongType, StringType, StructField, StructType

# Extension -> reader format for schema-inferred previews.
WHOLE = (1 << 31) - 1           # bytes: the longest value that a row can hold
FORMAT_BY_EXTENSION = {
    ".parquet": "parquet", ".csv": "csv", ".json": "json", ".jsonl": "json",
    ".orc": "orc", ".txt": "text", ".avro": "avro",
}


def detect_format(path: str) -> str:
    p = path.rstrip("/").lower()
    for ext, fmt in FORMAT_BY_EXTENSION.items():
        if p.endswith(ext) or f"{ext}/" in p or p.endswith(ext + "/*"):
            return fmt
    return "parquet"


def read_files(spark: SparkSession, path: str, fmt: str | None = None, **options) -> DataFrame:
    """Schema-inferred read of a file or directory; format from the extension.

    CSV gets ``header`` and schema inference on; for production pipelines give
    a schema instead (inference reads the data once more).
    """
    fmt = fmt or detect_format(path)
    reader = spark.read.format(fmt)
    if fmt == "csv":
        reader = reader.option("header", "true").option("inferSchema", "true")
    for k, v in options.items():
        reader = reader.option(k, v)
    return reader.load(path)


def read_csv_headerless(spark: SparkSession, path: str, names: list[str] | None = None,
                        schema: StructType | None = None) -> DataFrame:
    """CSV without header: columns arrive as ``_c0.._cN`` strings; ``names``
    renames them positionally."""
    reader = spark.read.option("header", "false")
    if schema is not None:
        reader = reader.schema(schema)
    df = reader.csv(path)
    return df.toDF(*names) if names else df


def list_files(spark: SparkSession, path: str, glob: str | None = None,
               recursive: bool = False) -> DataFrame:
    """``LIST path``: path, size and modification time; contents are not read
    (column pruning drops the content column from the scan)."""
    reader = spark.read.format("binaryFile")
    if glob:
        reader = reader.option("pathGlobFilter", glob)
    if recursive:
        reader = reader.option("recursiveFileLookup", "true")
    return reader.load(path).select("path", "length", "modificationTime")


def read_binary_files(spark: SparkSession, path: str, glob: str | None = None) -> DataFrame:
    """Non-tabular files with content (one row per file)."""
    reader = spark.read.format("binaryFile")
    if glob:
        reader = reader.option("pathGlobFilter", glob)
    return reader.load(path)


def file_digests(spark: SparkSession, path: str, glob: str | None = None) -> DataFrame:
    """(file_name, length, sha256) of every file.  Files too long for a value of a row
    are read in pieces."""
    name = F.regexp_extract("path", r"([^/]+)$", 1).alias("file_name")
    out = (read_binary_files(spark, path, glob).filter(F.col("length") <= WHOLE)
           .select(name, "length", F.sha2("content", 256).alias("sha256")))
    large = [r.path for r in list_files(spark, path, glob).filter(F.col("length") > WHOLE).select("path").collect()]
    return out.unionByName(digests_of_pieces(spark, large)) if large else out


def digests_of_pieces(spark: SparkSession, paths: list[str]) -> DataFrame:
    """(file_name, length, sha256) of uncompressed files, read by many tasks as the runs
    of bytes between line feeds.  SHA-256 is a chain over the bytes in order, so one task
    then takes all pieces of a file, sorted; it holds one batch of them at a time."""
    pieces = spark.read.option("lineSep", "\n").text(paths).select(
        F.col("_metadata.file_name").alias("file_name"), F.col("_metadata.file_path").alias("path"),
        F.col("_metadata.file_size").alias("length"), F.col("_metadata.file_block_start").alias("start"),
        F.monotonically_increasing_id().alias("i"), F.col("value").cast("binary").alias("piece"))

    def digests(batches):
        mark = b"\xef\xbb\xbf"       # the reader leaves it out at the start of a file, and the last line feed
        file, seen, plain, marked = None, 0, None, None

        def ended():
            left = file[2] - seen
            if left not in (0, 1, 3, 4):
                raise ValueError(f"{file[1]}: {seen} of {file[2]} bytes read")
            digest = marked if left >= 3 else plain
            digest.update(b"\n" * (left % 3))
            return pa.RecordBatch.from_arrays([pa.array([file[0]]), pa.array([file[2]], pa.int64()), pa.array([digest.hexdigest()])],
                                              ["file_name", "length", "sha256"])

        for batch in batches:
            at, rows = 0, batch.num_rows
            paths, lines = batch.column("path").to_pylist(), batch.column("piece").to_pylist()
            while at < rows:
                if file is None or paths[at] != file[1]:
                    if file:
                        yield ended()
                    file = (batch.column("file_name")[at].as_py(), paths[at], batch.column("length")[at].as_py())
                    seen, plain, marked, first = 0, hashlib.sha256(), hashlib.sha256(mark), b""
                to = next((k for k in range(at, rows) if paths[k] != file[1]), rows)
                run = first + b"\n".join(lines[at:to])
                plain.update(run)
                marked.update(run)
                seen, first, at = seen + len(run), b"\n", to
        if file:
            yield ended()

    return (pieces.repartition("path").sortWithinPartitions("path", "start", "i")
            .select("file_name", "path", "length", "piece")
            .mapInArrow(digests, "file_name string, length long, sha256 string"))


def read_csv_files_by_header(spark: SparkSession, paths: list[str], null_value: str = "nan",
                             year_pattern: str | None = None, year_offset: int = 0) -> DataFrame:
    """Many CSV files whose headers differ, combined by column name.

    One read over all files would apply the first header to every file and
    silently shift values.  Files are grouped by their header (Spark reads only
    the first line of each file for this), each group is read in one scan, and
    the groups are combined with ``unionByName(allowMissingColumns=True)``.
    With ``year_pattern`` the first regex group of the file name, plus
    ``year_offset``, becomes an integer ``year`` column.
    """
    groups: dict[tuple, list[str]] = {}
    for p in paths:
        header = tuple(spark.read.option("header", "true").csv(p).columns)
        groups.setdefault(header, []).append(p)
    out = None
    for files in groups.values():
        df = (spark.read.option("header", "true").option("nullValue", null_value)
              .option("enforceSchema", "false").csv(files))
        if year_pattern:
            df = df.withColumn(
                "year", F.regexp_extract(F.col("_metadata.file_path"), year_pattern, 1)
                .cast("int") + year_offset)
        out = df if out is None else out.unionByName(df, allowMissingColumns=True)
    return out


def records_to_rows(df: DataFrame, body_col: str, record_schema: StructType,
                    field: str = "dataframe_records") -> DataFrame:
    """``{"dataframe_records": [{...}, ...]}`` JSON text -> one row per record."""
    schema = StructType([StructField(field, ArrayType(record_schema))])
    parsed = df.select(F.from_json(F.col(body_col), schema).alias("__b"))
    return parsed.select(F.inline(F.col(f"__b.{field}")))


_ZIP_SCHEMA = StructType([StructField("archive", StringType()), StructField("member", StringType()),
                          StructField("size", LongType()), StructField("content", BinaryType())])


def expand_zip_archives(spark: SparkSession, path: str, glob: str = "*.zip") -> DataFrame:
    """One row per archive member (archive path, member name, size, bytes).

    Archives are spread over tasks by the ``binaryFile`` source; each task
    opens its archives in memory with ``mapInPandas`` (Arrow batches).
    """
    def expand(batches):
        for pdf in batches:
            rows = []
            for archive, blob in zip(pdf["path"], pdf["content"]):
                with zipfile.ZipFile(io.BytesIO(bytes(blob))) as z:
                    for info in z.infolist():
                        if info.is_dir():
                            continue
                        rows.append((archive, info.filename, info.file_size, z.read(info)))
            yield pd.DataFrame(rows, columns=["archive", "member", "size", "content"])

    return read_binary_files(spark, path, glob).select("path", "content").mapInPandas(expand, _ZIP_SCHEMA)
