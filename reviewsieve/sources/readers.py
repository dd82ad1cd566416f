"""Readers for JSON lines, JSON documents, CSV and Parquet."""

from __future__ import annotations

import csv
import io
import re
from collections import Counter
from collections.abc import Callable
from pathlib import PurePosixPath

from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from reviewsieve.session import WrittenTable, write_once
from reviewsieve.sources.csv_records import csv_records
from reviewsieve.sources.json_records import document_items

# The rating stays text until it is validated, so that bad values survive. The
# keys of an image are not fixed, hence the maps.
RAW_REVIEW_SCHEMA = T.StructType(
    [
        T.StructField("rating", T.StringType()),
        T.StructField("title", T.StringType()),
        T.StructField("text", T.StringType()),
        T.StructField("images", T.ArrayType(T.MapType(T.StringType(), T.StringType()))),
        T.StructField("asin", T.StringType()),
        T.StructField("parent_asin", T.StringType()),
        T.StructField("user_id", T.StringType()),
        T.StructField("timestamp", T.LongType()),
        T.StructField("helpful_vote", T.LongType()),
        T.StructField("verified_purchase", T.BooleanType()),
    ]
)

_CORRUPT = "_corrupt_record"
FILE_PLACE = "_file_place"
LAYOUTS = ("auto", "document", "lines")


# --- JSON lines ------------------------------------------------------------------------


def _bad_line(line: Column, record: Column) -> Column:
    """Whether a line is anything but one object that fits the schema.

    Parsing ends with the first value; where another may follow, the line is counted as an array.
    """
    several = line.rlike(r"\}\s*,?\s*\{") & ~F.coalesce(F.json_array_length(F.concat(F.lit("["), line, F.lit("]"))) == 1, F.lit(False))
    return ~line.rlike(r"(?s)^\s*\{.*\}\s*$") | record[_CORRUPT].isNotNull() | several


def _stop_on(bad: Column, line: Column, file: Column) -> Column:
    """True, unless the line is bad: then the job ends and names it."""
    message = F.concat(F.lit("Bad JSON record in "), file, F.lit(": "), line)
    return F.when(bad, F.raise_error(message).cast("boolean")).otherwise(True)


def _parsed_lines(
    lines: DataFrame, schema: T.StructType, strict: bool, dropped: Observation | None = None
) -> DataFrame:
    """Records from lines (value, and the file's metadata); each line is parsed once."""
    fields = [f for f in schema.fields if f.name != _CORRUPT]
    wanted = T.StructType([*fields, T.StructField(_CORRUPT, T.StringType())])
    options = {"mode": "PERMISSIVE", "columnNameOfCorruptRecord": _CORRUPT}
    record = F.from_json("value", wanted, options)
    file, block = F.col("_metadata.file_path"), F.col("_metadata.file_block_start")
    some = lines.where(~F.col("value").rlike(r"^[\s﻿]*$"))
    # The array keeps the parse from being repeated for every field.
    read = some.select("value", file.alias("_file"), block.alias("_block"), F.explode(F.array(record)).alias("_record"))
    bad = _bad_line(F.col("value"), F.col("_record"))
    if strict:
        read = read.where(_stop_on(bad, F.col("value"), F.col("_file")))
    else:
        if dropped is not None:
            read = read.observe(dropped, F.count_if(bad).alias("dropped"))
        read = read.where(~bad)
    place = F.struct(F.col("_file").alias("file"), F.col("_block").alias("block"))
    return read.select(*[F.col("_record")[f.name].alias(f.name) for f in fields], place.alias(FILE_PLACE))


def _inferred_lines(spark: SparkSession, paths: str | list[str]) -> T.StructType:
    schema = spark.read.json(paths).schema
    fields = [f for f in schema.fields if f.name != _CORRUPT]
    if not fields:
        raise ValueError(f"No JSON object in {paths}.")
    return T.StructType(fields)


def read_jsonl(
    spark: SparkSession,
    path: str | list[str],
    schema: T.StructType | None = None,
    strict: bool = True,
    dropped: Observation | None = None,
) -> DataFrame:
    """One JSON object per line; blank lines are skipped.

    Strict reading fails on a line that is not one object of the schema's types,
    when the line is reached. Otherwise such lines are dropped, and their number
    is observed as `dropped`.
    """
    schema = schema or _inferred_lines(spark, path)
    return _parsed_lines(spark.read.text(path), schema, strict, dropped).drop(FILE_PLACE)


def read_json_records(spark: SparkSession, path: str | list[str], strict: bool = True) -> DataFrame:
    """One JSON object per line as it is, in the variant column `record`; blank lines are skipped.

    No schema is given or inferred, so every field of every record is there. Strict reading fails on a line that is
    not one object, or that repeats a field; otherwise such lines are dropped.
    """
    lines = spark.read.text(path).where(~F.col("value").rlike(r"^[\s﻿]*$"))
    value = F.regexp_replace("value", "^﻿", "")
    record = F.parse_json(value) if strict else F.try_parse_json(value)
    read = lines.select("value", F.col("_metadata.file_path").alias("file"), F.explode(F.array(record)).alias("record"))
    bad = ~F.coalesce(F.schema_of_variant("record").startswith("OBJECT"), F.lit(False))
    return read.where(_stop_on(bad, F.col("value"), F.col("file")) if strict else ~bad).select("record")


# --- JSON documents --------------------------------------------------------------------


def _is_object(value: Column) -> Column:
    return F.schema_of_variant(value).startswith("OBJECT")


def _holds_items(root: Column) -> Column:
    """Whether a document's records are the items of its root array or of its only list, which then holds
    nothing but objects; else it is an object and the record itself. Anything else stops the job."""
    variants = "array<variant>"
    lists = F.filter(F.map_values(root.cast("map<string,variant>")), lambda v: F.schema_of_variant(v).startswith("ARRAY"))
    wrapper = F.when(F.size(lists) == 1, F.forall(F.element_at(lists, 1).cast(variants), _is_object)).otherwise(False)
    kind = F.schema_of_variant(root)
    stop = lambda message: F.raise_error(F.lit(message)).cast("boolean")
    return (
        F.when(kind.startswith("OBJECT"), wrapper)
        .when(~kind.startswith("ARRAY"), stop("A JSON root is neither an object nor an array."))
        .when(F.forall(root.cast(variants), _is_object), True)
        .otherwise(stop("A JSON array holds items that are not objects."))
    )


def _roots(texts: DataFrame) -> DataFrame:
    """(file, root) and other columns of texts (file, value). A text is parsed as the only item of an array, so that
    anything behind the root is an error."""
    value = F.regexp_replace("value", "^\ufeff", "")
    boxed = F.parse_json(F.concat(F.lit("["), value, F.lit("]"))).cast("array<variant>")
    others = [c for c in texts.columns if c != "value"]
    roots = texts.select(*others, F.explode(F.array(boxed)).alias("roots"))
    single = F.when(F.size("roots") == 1, F.col("roots")[0]).otherwise(
        F.raise_error(F.lit("A JSON file holds no value, or several.")).cast("variant")
    )
    return roots.select(*others, single.alias("root"))


def _documents(spark: SparkSession, path: str | list[str]) -> DataFrame:
    """(_record) of every record. Items are cut out in many tasks for each file, and what is left of a
    document tells whether they are its records. Only a document that is the record itself is read as one value, and
    once more only if items were cut out of it."""
    items, outlines = document_items(spark, path)
    roots = _roots(outlines.select("file", "cut", "outline", F.col("outline").alias("value")))
    judged = roots.select("file", "cut", "outline", _holds_items(F.col("root")).alias("wrapper"))
    judged = write_once(judged.select("file", "cut", "wrapper", F.when(~F.col("wrapper") & ~F.col("cut"), F.col("outline")).alias("value")), "documents")
    # File names, which Spark's index of the files holds as well.
    singles = [r.file for r in judged.data.where("NOT wrapper AND cut").select("file").collect()]
    records = items
    if singles:
        others = write_once(judged.data.where("NOT wrapper AND cut").select("file"), "single-documents")
        records = items.join(others.sized_for_join(), "file", "left_anti")
    records = records.select(F.parse_json("record").alias("_record"))
    plain = judged.data.where("value IS NOT NULL").select("file", "value")
    records = records.unionByName(_roots(plain).select(F.col("root").alias("_record")))
    if singles:
        whole = spark.read.text(singles, wholetext=True).select(F.col("_metadata.file_path").alias("file"), "value")
        records = records.unionByName(_roots(whole).select(F.col("root").alias("_record")))
    return records


def _inferred_records(records: DataFrame) -> T.StructType:
    """Schema of all records together; what has no type or several is text."""
    found = records.agg(F.schema_of_variant_agg("_record")).first()[0] or ""
    if not found.startswith("OBJECT<"):
        raise ValueError("No JSON record to take a schema from.")
    ddl = found.replace("OBJECT<", "STRUCT<")
    ddl = re.sub(r"\b(VOID|VARIANT)\b(?=[,>])", "STRING", ddl)
    ddl = re.sub(r"DECIMAL\(\d+, ?0\)", "BIGINT", ddl)
    ddl = re.sub(r"DECIMAL\(\d+, ?\d+\)", "DOUBLE", ddl)
    return T._parse_datatype_string(ddl)


def read_json_document(
    spark: SparkSession, path: str | list[str], schema: T.StructType | None = None
) -> DataFrame:
    """Whole-document JSON, each file by itself.

    An array gives its items. An object whose only list holds nothing but objects gives the
    items of that list, any other object is one row. Large files are read by many tasks, which cut the items
    out; all files are read twice. `schema` describes the rows; without one it
    is taken from all records. Files without a byte are passed over. A malformed document stops the job.
    """
    records = _documents(spark, path)
    schema = schema or _inferred_records(records)
    parsed = F.from_json(F.to_json("_record"), schema, {"mode": "FAILFAST"})
    return records.select(F.explode(F.array(parsed)).alias("_r")).select("_r.*")


# --- Other formats ---------------------------------------------------------------------


def _column_names(header: list[str]) -> list[str]:
    """Names of a header's fields: empty ones go by their place, repeated ones get it."""
    copies = Counter(n.lower() for n in header)
    return [f"_c{i}" if not n else f"{n}{i}" if copies[n.lower()] > 1 else n for i, n in enumerate(header)]


def _csv_type(fields: list[T.StructField]) -> str:
    return ", ".join(f"`{f.name.replace('`', '``')}` {f.dataType.simpleString()}" for f in fields)


def _split_csv(spark: SparkSession, path: str, schema: T.StructType | None, strict: bool) -> DataFrame:
    """CSV from records that were put together block by block; each is parsed once, by Spark."""
    records = csv_records(spark, path)
    if schema is None:
        # One line of text; all other headers are compared with it in tasks.
        first = records.where("head").orderBy("file").first()
        header = next(csv.reader(io.StringIO(first["record"], newline=""))) if first else []
        schema = T.StructType([T.StructField(n, T.StringType()) for n in _column_names(header)])
    else:
        header = schema.names
    options = {"escape": '"', "multiLine": "true", "mode": "PERMISSIVE"}
    wanted = F.array(*[F.lower(F.lit(n or None)) for n in header], F.lit(None).cast("string"))
    names = F.from_csv("record", _csv_type([T.StructField(f"f{i}", T.StringType()) for i in range(len(header) + 1)]), options)
    same = F.array(*[F.lower(names[f"f{i}"]) for i in range(len(header) + 1)]).eqNullSafe(wanted)
    other = F.raise_error(F.concat(F.lit("The CSV header in "), F.col("file"), F.lit(f" is not that of {header}: "), F.col("record"))).cast("boolean")
    row = F.from_csv("record", _csv_type([*schema.fields, T.StructField(_CORRUPT, T.StringType())]), {**options, "columnNameOfCorruptRecord": _CORRUPT})
    body = records.where(F.when(~F.col("head"), True).when(same, False).otherwise(other))
    parsed = body.select("file", "block", "number", F.explode(F.array(row)).alias("_row"))
    bad = F.col("_row")[_CORRUPT].isNotNull()
    message = F.concat(F.lit("Malformed CSV row in "), F.col("file"), F.lit(": "), F.col("_row")[_CORRUPT])
    parsed = parsed.where(F.when(bad, F.raise_error(message).cast("boolean")).otherwise(True) if strict else ~bad)
    place = F.struct("file", "block", "number").alias(FILE_PLACE)
    return parsed.select(*[F.col("_row")[f.name].alias(f.name) for f in schema.fields], place)


def read_csv(
    spark: SparkSession,
    path: str,
    schema: T.StructType | None = None,
    multi_line: bool = True,
    strict: bool = True,
    place: bool = False,
) -> DataFrame:
    """CSV with a header; all columns are text unless a schema is given.

    Quoted fields may hold line breaks, and large files are still read by many tasks; lines end with a line feed.
    Where no field holds a line break, `multi_line=False` saves a pass over the files. All files must have the header
    of the first, or of the schema. Strict reading fails on a row with too many or too few
    fields or with a value that does not fit the schema; otherwise such rows are dropped. `place` adds
    the column that `numbered` builds on.
    """
    if multi_line:
        df = _split_csv(spark, path, schema, strict)
        return df if place else df.drop(FILE_PLACE)
    reader = (
        spark.read.option("header", True)
        .option("escape", '"')
        .option("enforceSchema", False)
        .option("mode", "FAILFAST" if strict else "DROPMALFORMED")
    )
    df = (reader.schema(schema) if schema else reader).csv(path)
    if schema is None:
        # Rows are only checked against a schema that is given.
        df = reader.schema(df.schema).csv(path)
    return _with_place(df) if place else df


def _wrapper_files(spark: SparkSession, files: list[str], fields: list[str]) -> set[str]:
    """Of files with one line, those whose object is a wrapper and not a record.

    The only list of a wrapper holds nothing but objects, of which one has as many of the fields as the wrapper.
    """
    entries = "map<string,variant>"
    known = lambda keys: F.size(F.array_intersect(keys, F.array(*[F.lit(f) for f in fields]).cast("array<string>")))
    root = F.try_parse_json(F.regexp_replace("value", r"^[\s﻿]+", "")).cast(entries)
    read = spark.read.text(files).select(F.col("_metadata.file_path").alias("file"), root.alias("root"))
    lists = F.filter(F.map_values("root"), lambda v: F.schema_of_variant(v).startswith("ARRAY"))
    read = read.select("file", "root", lists.alias("lists")).where("size(lists) = 1").select("file", "root", F.col("lists")[0].cast("array<variant>").alias("items"))
    # Nothing but objects is cast to a map.
    most = F.when(F.forall("items", _is_object), F.coalesce(F.array_max(F.transform("items", lambda v: known(F.map_keys(v.cast(entries))))), F.lit(0)))
    return {r.file for r in read.where(most >= known(F.map_keys("root"))).select("file").collect()}


def _line_files(spark: SparkSession, path: str, schema: T.StructType | None) -> tuple[list[str], list[str]]:
    """Files of JSON lines, and files that are documents.

    A file whose first line is a whole object holds lines if more lines follow. With no more than
    that line it is a document if the object is a wrapper by the fields of the schema. A record alone in its file is the
    same row in both layouts. Without a schema an object whose only list holds nothing but objects may be
    either: it is a document among documents, but beside files of lines the job stops.
    """
    text = F.regexp_replace("value", r"^[\s﻿]+", "")
    lines = spark.read.text(path).select(
        F.col("_metadata.file_path").alias("file"),
        F.struct("_metadata.file_block_start", F.monotonically_increasing_id()).alias("place"),
        text.alias("line"),
    )
    # Only these small values are aggregated: a line may be a whole document.
    # Only a file's first block can hold its first line; a larger blank head makes it a document, which then fails.
    whole = F.when(F.col("place.file_block_start") == 0, F.json_object_keys("line").isNotNull())
    found = (
        lines.where("line <> ''")
        .select("file", "place", whole.alias("whole"))
        .groupBy("file")
        .agg(F.min_by("whole", "place").alias("whole"), F.count(F.lit(1)).alias("lines"))
        .collect()
    )
    several = [r.file for r in found if r.whole and r.lines > 1]
    documents = [r.file for r in found if not r.whole]
    single = [r.file for r in found if r.whole and r.lines == 1]
    if single and (schema or several):
        wrappers = _wrapper_files(spark, single, schema.fieldNames() if schema else [])
        if wrappers and not schema:
            raise ValueError(f"{min(wrappers)} holds one object with a list of objects, which may be a record or a document; name a schema or a layout.")
        several += [f for f in single if f not in wrappers]
        single = [f for f in single if f in wrappers]
    return several, documents + single


def _read_json(
    spark: SparkSession, path: str, schema: T.StructType | None, strict: bool, layout: str
) -> DataFrame:
    """A `.json` path by its layout; "auto" takes each file for itself."""
    if layout == "lines":
        return read_jsonl(spark, path, schema, strict)
    if layout == "document":
        return read_json_document(spark, path, schema)
    lines, documents = _line_files(spark, path, schema)
    if not documents:
        # All files, so that their names need not travel with the plan.
        return read_jsonl(spark, path, schema, strict) if lines else read_json_document(spark, path, schema)
    if not lines:
        return read_json_document(spark, documents, schema)
    parts = read_jsonl(spark, lines, schema, strict), read_json_document(spark, documents, schema)
    return parts[0].unionByName(parts[1], allowMissingColumns=True)


_Reader = Callable[[SparkSession, str, T.StructType | None, bool, str, bool], DataFrame]

# What reads a file, by its extension.
READERS: dict[str, _Reader] = {
    "csv": lambda spark, path, schema, strict, layout, multi_line: read_csv(spark, path, schema, multi_line, strict),
    "json": lambda spark, path, schema, strict, layout, multi_line: _read_json(spark, path, schema, strict, layout),
    "jsonl": lambda spark, path, schema, strict, layout, multi_line: read_jsonl(spark, path, schema, strict),
    "parquet": lambda spark, path, schema, strict, layout, multi_line: (spark.read.schema(schema) if schema else spark.read).parquet(path),
}


def detect_file_format(path: str) -> str:
    """The entry of `READERS` that a path's extension names."""
    name = re.sub(r"^.*\.", "", PurePosixPath(str(path)).name).lower()
    if name in READERS:
        return name
    raise ValueError(f"No reader for {path}; there is one for each of {', '.join(READERS)}.")


def read_reviews(
    spark: SparkSession,
    path: str,
    schema: T.StructType | None = None,
    strict: bool = True,
    layout: str = "auto",
    multi_line: bool = True,
) -> DataFrame:
    """Read by file extension. `layout` says whether `.json` files are documents or hold lines,
    `multi_line` whether quoted CSV fields may hold line breaks."""
    if layout not in LAYOUTS:
        raise ValueError(f"layout must be one of {LAYOUTS}")
    return READERS[detect_file_format(path)](spark, path, schema, strict, layout, multi_line)


def read_uploaded_data(
    spark: SparkSession,
    path: str,
    schema: T.StructType | None = None,
    layout: str = "auto",
    multi_line: bool = True,
) -> DataFrame:
    """`read_reviews` for an upload, which must hold a row."""
    df = read_reviews(spark, path, schema, True, layout, multi_line)
    if df.isEmpty():
        raise ValueError(f"'{PurePosixPath(str(path)).name}' holds no rows.")
    return df


# --- Streams and order -----------------------------------------------------------------


def read_reviews_stream(
    spark: SparkSession,
    directory: str,
    schema: T.StructType = RAW_REVIEW_SCHEMA,
    files_per_trigger: int = 1000,
    file_format: str = "jsonl",
) -> DataFrame:
    """New files of a folder, a bounded number at a time: JSON lines, or CSV with a header.

    A bad line or row stops the stream. Each row carries the place of its block, for `numbered` to build on.
    """
    stream = spark.readStream.option("maxFilesPerTrigger", files_per_trigger)
    if file_format == "jsonl":
        return _parsed_lines(stream.text(directory), schema, strict=True)
    if file_format != "csv":
        raise ValueError("a stream reads jsonl or csv")
    options = {"header": True, "multiLine": True, "escape": '"', "enforceSchema": False, "mode": "FAILFAST"}
    return _with_place(stream.options(**options).schema(schema).csv(directory))


def read_stream_files(spark: SparkSession, files: list[str], schema: T.StructType) -> DataFrame:
    """Rows of some files of a stream of JSON lines, once more."""
    return _parsed_lines(spark.read.text(files), schema, strict=True).drop(FILE_PLACE)


def _with_place(df: DataFrame) -> DataFrame:
    place = F.struct(
        F.col("_metadata.file_path").alias("file"),
        F.col("_metadata.file_block_start").alias("block"),
    )
    return df.withColumn(FILE_PLACE, place)


def numbered(df: DataFrame, name: str = "ingest_seq") -> WrittenTable:
    """Rows with a unique order column, from rows that carry their block's place.

    The order is that of file name and position in the file. The rows are
    written once, since the numbering would otherwise depend on how a later job
    splits the files.
    """
    order = F.struct(f"{FILE_PLACE}.*", F.monotonically_increasing_id().alias("row"))
    return write_once(df.withColumn(name, order).drop(FILE_PLACE), "numbered")


def with_ingest_seq(df: DataFrame, name: str = "ingest_seq") -> DataFrame:
    """`numbered` for a DataFrame that is read straight from files, or with a place."""
    return numbered(df if FILE_PLACE in df.columns else _with_place(df), name).data
