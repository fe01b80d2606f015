"""Readers and writers of the exchange tables.

Readers take explicit schemas (no inference) and return keyed DataFrames; a missing
path gives an empty DataFrame, as the analysed pipeline treats a missing file as an
empty collection.  Rows that have a place in their file get it as a number, counted over byte ranges
of the file, so a listing of any size is read by many tasks.

Writers partition by ``binary_id`` so every binary's output lands in its own folder and is written by many
tasks at once.  A write replaces the folders of the binaries it holds rows of and no others; the
replacement is staged and takes place when all rows are written, so an aborted write leaves the old rows.
A binary without a row in a write keeps what it has.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, DataFrameWriter, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from binlens.functions import catalog as C
from binlens.functions import names as N
from binlens.operators import text as X
from binlens.session import path_exists

FUNCTION_BOUNDARIES = T.StructType([
    T.StructField("name", T.StringType()), T.StructField("entry_address", T.StringType()),
    T.StructField("end_address", T.StringType()), T.StructField("size", T.LongType()),
    T.StructField("param_count", T.IntegerType()), T.StructField("return_type", T.StringType()),
    T.StructField("calling_convention", T.StringType()), T.StructField("is_thunk", T.BooleanType()),
    T.StructField("is_external", T.BooleanType())])
CALL_GRAPH = T.StructType([T.StructField(c, T.StringType()) for c in
                           ("caller_name", "caller_address", "callee_name", "callee_address", "ref_type")])
FUNCTION_MAP = T.StructType([
    T.StructField("ghidra_function_name", T.StringType()), T.StructField("ghidra_address", T.StringType()),
    T.StructField("source_file", T.StringType()), T.StructField("source_line", T.LongType()),
    T.StructField("confidence", T.StringType()), T.StructField("match_method", T.StringType()),
    T.StructField("original_name", T.StringType()), T.StructField("source_language", T.StringType())])
IDENTITY = T.StructType([
    T.StructField("name", T.StringType()), T.StructField("version", T.StringType()),
    T.StructField("repo_url", T.StringType()), T.StructField("tag", T.StringType()),
    T.StructField("languages", T.ArrayType(T.StringType())), T.StructField("confidence", T.StringType()),
    T.StructField("evidence", T.ArrayType(T.StringType())), T.StructField("source_dir_hint", T.StringType()),
    T.StructField("local_source_path", T.StringType())])
TASK = T.StructType([
    T.StructField("id", T.StringType()), T.StructField("title", T.StringType()),
    T.StructField("description", T.StringType()), T.StructField("ghidraFunctions", T.ArrayType(T.StringType())),
    T.StructField("addressRange", T.StringType()), T.StructField("sourceFiles", T.ArrayType(T.StringType())),
    T.StructField("targetSourceFile", T.StringType()), T.StructField("clusterType", T.StringType()),
    T.StructField("calledFrameworkAPIs", T.ArrayType(T.StringType())),
    T.StructField("acceptanceCriteria", T.ArrayType(T.StringType())), T.StructField("priority", T.IntegerType()),
    T.StructField("passes", T.BooleanType()), T.StructField("notes", T.StringType())])
PLAN = T.StructType([
    T.StructField("binaryTarget", T.StringType()), T.StructField("binaryType", T.StringType()),
    T.StructField("cycle", T.IntegerType()), T.StructField("analysisMode", T.StringType()),
    T.StructField("triageResults", T.ArrayType(T.StructType([
        T.StructField("prefix", T.StringType()), T.StructField("classification", T.StringType()),
        T.StructField("libraryGuess", T.StringType()), T.StructField("reason", T.StringType())]))),
    T.StructField("userStories", T.ArrayType(TASK))])

LINE_BREAK = r"\r\n|\r|\n"


def _empty(spark: SparkSession, schema: T.StructType) -> DataFrame:
    return spark.createDataFrame([], schema)


def _with_key(df: DataFrame, key: str, value) -> DataFrame:
    if key in df.columns:
        return df
    return df.withColumn(key, F.lit(value).cast("int"))


def _placed() -> list[Column]:
    """File and first byte of the range that a scanned row comes from."""
    return [F.col("_metadata.file_path").alias("_file"), F.col("_metadata.file_block_start").alias("_block")]


def _numbered(rows: DataFrame, name: str) -> DataFrame:
    """``name``: each row's place in its file, from 0.  ``rows`` are as scanned, with ``_file`` and ``_block``.

    Ids rise within a byte range; the rows of the ranges before it, one number per range, are added up."""
    rows = rows.withColumn("_at", F.monotonically_increasing_id())
    ranges = rows.groupBy("_file", "_block").agg(F.min("_at").alias("_first"), F.count(F.lit(1)).alias("_rows"))
    earlier = Window.partitionBy("_file").orderBy("_block").rowsBetween(Window.unboundedPreceding, -1)
    starts = ranges.select("_file", "_block", "_first", F.coalesce(F.sum("_rows").over(earlier), F.lit(0)).alias("_before"))
    return (rows.join(starts, ["_file", "_block"]).withColumn(name, F.col("_at") - F.col("_first") + F.col("_before"))
            .drop("_at", "_first", "_before", "_block"))


def read_tsv(spark: SparkSession, path: str, schema: T.StructType, binary_id: int | None = 0) -> DataFrame:
    """S1/S2/S4 base: tab-separated with header, fixed schema; missing -> empty."""
    if not path_exists(spark, path):
        df = _empty(spark, schema)
    else:
        df = spark.read.schema(schema).csv(path, sep="\t", header=True, quote="", escape="\\")
    return _with_key(df, "binary_id", binary_id) if binary_id is not None else df


def read_functions(spark: SparkSession, path: str, binary_id: int | None = 0) -> DataFrame:
    """S1, with ``row_no``, the row's place in its file: of rows with one address the last one counts."""
    rows = read_tsv(spark, path, FUNCTION_BOUNDARIES, binary_id)
    if not path_exists(spark, path):
        return rows.withColumn("row_no", F.lit(None).cast("long"))
    return _numbered(rows.select("*", *_placed()), "row_no").drop("_file")


def read_call_graph(spark: SparkSession, path: str, binary_id: int | None = 0) -> DataFrame:
    """S2/S3 input: the call-graph table (distinct edges are taken by the operators)."""
    return read_tsv(spark, path, CALL_GRAPH, binary_id)


def read_function_map(spark: SparkSession, path: str, binary_id: int | None = 0) -> DataFrame:
    """S4 input."""
    return read_tsv(spark, path, FUNCTION_MAP, binary_id)


def split_lines(text: Column) -> Column:
    """Lines of a document: split on CRLF, CR or LF; a final line break ends the last line."""
    parts = F.split(text, LINE_BREAK)
    return F.when(F.element_at(parts, -1) == "", F.slice(parts, 1, F.size(parts) - 1)).otherwise(parts)


# A key taken from a file's path: the first group of the pattern, as an integer.  One call then
# reads any number of binaries or trees.
def _key(value: int, pattern: str | None, file: str = "_metadata.file_path") -> Column:
    if pattern is None:
        return F.lit(value)
    return F.regexp_extract(_file_path(file), pattern, 1).try_cast("int")


def _file_path(file: str = "_metadata.file_path") -> Column:
    """Path of the file a row comes from, without scheme and host, percent codes decoded."""
    path = F.regexp_replace(F.col(file), r"^[A-Za-z][A-Za-z0-9+.-]*:(//[^/]*)?", "")
    return F.url_decode(F.regexp_replace(path, r"\+", "%2B"))  # a plus sign stands for itself in a path


def _root_path(spark: SparkSession, directory: str) -> str:
    """The directory as its file system names it, without scheme and host."""
    p = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(directory)
    return p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).makeQualified(p).toUri().getPath().rstrip("/") + "/"


def _lines(spark: SparkSession, directory: str, extensions: list[str] | None) -> DataFrame | None:
    """value, _file, _block: a row per line (CRLF, CR or LF) of the files under a directory, None if there is none."""
    if not path_exists(spark, directory):
        return None
    reader = spark.read.option("recursiveFileLookup", True)
    if extensions:
        reader = reader.option("pathGlobFilter", "*{" + ",".join(extensions) + "}")
    scan = reader.text(directory)
    return scan.select("value", *_placed())


def _whole_files(spark: SparkSession, directory: str, extensions: list[str] | None) -> DataFrame | None:
    """A row per file under a directory (None if there is no such directory); a file is at most 2 GB."""
    if not path_exists(spark, directory):
        return None
    reader = spark.read.option("recursiveFileLookup", True)
    if extensions:
        reader = reader.option("pathGlobFilter", "*{" + ",".join(extensions) + "}")
    # text()'s own wholetext argument overrides a previously set option, so pass it there
    return reader.text(directory, wholetext=True)


def read_function_corpus(spark: SparkSession, directory: str, binary_id: int = 0, key_pattern: str | None = None) -> DataFrame:
    """The per-function corpus ``<prefix>/<name>_<addr>.c``; key = stem minus its last
    '_' part.  One row per file with its whole text; missing folder -> empty."""
    df = _whole_files(spark, directory, [".c"])
    if df is None:
        return spark.createDataFrame([], "binary_id int, func_name string, file_name string, text string")
    name = F.regexp_extract(_file_path(), r"([^/]*)$", 1)
    return df.select(_key(binary_id, key_pattern).alias("binary_id"), X.corpus_function_key(name).alias("func_name"),
                     name.alias("file_name"), F.col("value").alias("text"))


def read_source_tree(spark: SparkSession, directory: str, tree_id: int = 0, key_pattern: str | None = None,
                     extensions: list[str] | None = None) -> DataFrame:
    """The files of a source tree as (tree_id, rel_path, line_no, text), lines from 1;
    ``extensions`` keeps other files from being read; missing folder -> empty.

    Undecodable bytes become U+FFFD (the text source decodes with replacement)."""
    lines = _lines(spark, directory, extensions)
    if lines is None:
        return spark.createDataFrame([], "tree_id int, rel_path string, line_no int, text string")
    path = _file_path("_file")
    rel = F.substring(path, F.lit(len(_root_path(spark, directory)) + 1), F.length(path))
    return _numbered(lines, "_no").select(_key(tree_id, key_pattern, "_file").alias("tree_id"), rel.alias("rel_path"),
                                          (F.col("_no") + 1).cast("int").alias("line_no"), F.col("value").alias("text"))


def read_binary_strings(spark: SparkSession, path: str, min_len: int = 6, binary_id: int = 0, key_pattern: str | None = None) -> DataFrame:
    """Printable ASCII runs (space..~ and tab) of at least ``min_len`` bytes, in file order; missing -> empty.

    The file (or every file of a folder) is read as records that end with a NUL byte, which no run holds: Spark splits it
    into byte ranges of any number, and a record that crosses a border belongs to the range where it starts, so
    no run is cut.  A stretch without any NUL byte has to be under 2 GB."""
    if not path_exists(spark, path):
        return spark.createDataFrame([], "binary_id int, ord long, s string")
    scan = spark.read.option("recursiveFileLookup", True).option("lineSep", "\0").text(path)
    records = scan.select("value", *_placed()).where(F.octet_length("value") >= min_len)
    runs = F.regexp_extract_all(F.decode(F.col("value").cast("binary"), "ISO-8859-1"), F.lit(r"([\x20-\x7E\t]{%d,})" % min_len), 1)
    found = _numbered(records.select("_file", "_block", F.explode(runs).alias("s")), "ord")
    return found.select(_key(binary_id, key_pattern, "_file").alias("binary_id"), "ord", "s")


def read_symbols(spark: SparkSession, path: str, binary_id: int = 0, key_pattern: str | None = None) -> DataFrame:
    """One symbol per line of an exported listing (or of every listing in a folder), in order; missing -> empty."""
    lines = _lines(spark, path, None)
    if lines is None:
        return spark.createDataFrame([], "binary_id int, ord long, symbol string")
    return _numbered(lines, "ord").select(_key(binary_id, key_pattern, "_file").alias("binary_id"), "ord", F.col("value").alias("symbol"))


def read_identity(spark: SparkSession, path: str) -> DataFrame:
    """Identity JSON; missing -> empty."""
    if not path_exists(spark, path):
        return _empty(spark, IDENTITY)
    return spark.read.schema(IDENTITY).json(path, multiLine=True)


def _plan_documents(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.schema(PLAN).json(path, multiLine=True) if path_exists(spark, path) else _empty(spark, PLAN)


def read_plan(spark: SparkSession, path: str) -> DataFrame:
    """One row per task of a plan document, with its position; missing -> empty."""
    return _plan_documents(spark, path).select("binaryTarget", "cycle", F.posexplode("userStories").alias("pos", "t")).select(
        "binaryTarget", "cycle", "pos", "t.*")


def read_triage(spark: SparkSession, path: str, binary_id: int = 0) -> DataFrame:
    """The cluster labels of plan documents (one per cycle), as the input of J18; missing -> empty."""
    return _plan_documents(spark, path).select(F.lit(binary_id).alias("binary_id"), "cycle", F.posexplode("triageResults").alias("pos", "r")).select(
        "binary_id", "cycle", "pos", "r.prefix", F.col("r.classification").alias("label"), "r.libraryGuess", "r.reason")


# ---- sinks ------------------------------------------------------------------------

def _replacing(writer: DataFrameWriter, mode: str = "overwrite") -> DataFrameWriter:
    """Replace the partitions that the write holds rows of, when it is complete; leave all others."""
    return writer.mode(mode).option("partitionOverwriteMode", "dynamic")


def write_tsv(df: DataFrame, path: str, partition_by=("binary_id",), mode: str = "overwrite") -> None:
    w = _replacing(df.write, mode).option("sep", "\t").option("header", True).option("quote", "").option("escape", "\\")
    parts = [c for c in partition_by if c in df.columns]
    if parts:
        w = w.partitionBy(*parts)
    w.csv(path)


def write_function_map(function_map: DataFrame, path: str) -> None:
    """The function map, rows in function (address) order within each binary."""
    write_tsv(function_map.sortWithinPartitions("binary_id", "ghidra_address"), path)


def write_aliases(aliases: DataFrame, path: str) -> None:
    """Aliases sorted by (ghidra_name, original_name)."""
    write_tsv(aliases.orderBy("binary_id", "ghidra_name", "original_name"), path)


def write_json_report(report: DataFrame, path: str, partition_by=("binary_id",)) -> None:
    """Stats / composition / identity / chunk index as JSON lines of nested structs."""
    w = _replacing(report.write)
    parts = [c for c in partition_by if c in report.columns]
    if parts:
        w = w.partitionBy(*parts)
    w.json(path)


def corpus_documents(functions_text: DataFrame) -> DataFrame:
    """Per-function documents: header ``// name @ addr``, sanitized file name, prefix dir."""
    return functions_text.select(
        "binary_id", N.addr_dir_key("entry_address").alias("addr_prefix"),
        N.corpus_file_name("name", "entry_address").alias("file_name"),
        F.concat(F.format_string(C.CORPUS_DOC_HEADER, F.col("name"), F.col("entry_address")), F.col("code"))
        .alias("document"))


def write_partitioned_corpus(functions_text: DataFrame, path: str, as_text: bool = False) -> None:
    """One document per function under (binary_id, addr_prefix) folders, as Parquet rows or, on
    request, as text, each document in a folder named after its file."""
    docs = corpus_documents(functions_text)
    if as_text:
        _replacing(docs.write).partitionBy("binary_id", "addr_prefix", "file_name").text(path)
    else:
        _replacing(docs.write).partitionBy("binary_id", "addr_prefix").parquet(path)
    # hexadecimal digits; at most one prefix per 4 KB of addresses
    _drop_stale(functions_text.sparkSession, path, docs.select("binary_id", "addr_prefix").distinct())


def _drop_stale(spark: SparkSession, path: str, written: DataFrame) -> None:
    """Remove the folders of the second column that the written keys of the first had before and have no more; other keys are
    not touched.  ``written`` has one row per folder."""
    key, part = written.columns
    fs_path = spark.sparkContext._jvm.org.apache.hadoop.fs.Path
    fs = fs_path(path).getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    for row in written.groupBy(key).agg(F.collect_set(part).alias("parts")).toLocalIterator():
        folder = fs_path(f"{path}/{key}={row[key]}")
        keep = {f"{part}={p}" for p in row["parts"]}
        for status in fs.listStatus(folder):
            if status.isDirectory() and status.getPath().getName().startswith(f"{part}=") and status.getPath().getName() not in keep:
                fs.delete(status.getPath(), True)


def write_chunk_documents(document_lines: DataFrame, path: str) -> None:
    """Each chunk's document (``chunk_document_lines``) as text in a folder named after its file, under its bundle.

    Lines are dealt by range, so a long chunk is written by many tasks; its part files in name order are the document.
    A bundle that is written replaces its earlier chunks."""
    ordered = (document_lines.repartitionByRange("bundle_id", "file", "pos").sortWithinPartitions("bundle_id", "file", "pos")
               .select("bundle_id", "file", F.col("text").alias("value")))
    _replacing(ordered.write).partitionBy("bundle_id", "file").text(path)
    _drop_stale(document_lines.sparkSession, path, document_lines.where("pos = 0").select("bundle_id", "file"))


def write_combined_corpus(functions_text: DataFrame, names: DataFrame, path: str) -> None:
    """Per binary a header (target name, function count) then every document followed
    by a blank line, ordered by (prefix, file name).  Range partitioning keeps the order
    across part files, so their concatenation in name order is the combined file."""
    docs = corpus_documents(functions_text)
    counts = docs.groupBy("binary_id").agg(F.count(F.lit(1)).alias("n"))
    header = (counts.join(names, ["binary_id"])
              .select("binary_id", F.lit("").alias("addr_prefix"), F.lit("").alias("file_name"), F.lit(0).alias("part"),
                      F.format_string(C.CORPUS_COMBINED_HEADER, F.col("target_name"), F.col("n")).alias("value")))
    body = docs.select("binary_id", "addr_prefix", "file_name", F.lit(1).alias("part"),
                       F.concat(F.col("document"), F.lit("\n")).alias("value"))
    out = header.unionByName(body)
    ordered = (out.repartitionByRange("binary_id", "part", "addr_prefix", "file_name")
               .sortWithinPartitions("binary_id", "part", "addr_prefix", "file_name").select("binary_id", "value"))
    _replacing(ordered.write).partitionBy("binary_id").text(path)


def write_function_index(functions: DataFrame, path: str) -> None:
    """5-column index of every function."""
    write_tsv(functions.select("binary_id", "name", F.col("entry_address").alias("address"), "size",
                               F.col("param_count").alias("params"), "return_type"), path)


def write_module_chunks(chunks: DataFrame, path: str) -> None:
    """Module chunks sorted by prefix."""
    write_tsv(chunks.orderBy("binary_id", "prefix"), path)
