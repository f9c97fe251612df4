"""Landing files as text, lake layers as Parquet."""

from __future__ import annotations

import re
from collections.abc import Mapping, Sequence
from concurrent.futures import ThreadPoolExecutor
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, StringType, StructField, StructType

from lakestay import fixed_values as fv
from lakestay.operators.frames import union_frames


_FILE = "_source_file"
# Files whose headers are read at the same time.
OPENED_AT_ONCE = 16
# Bytes read at once in search of a file's first record.
HEAD_BYTES = 1 << 16


@dataclass(frozen=True)
class SourceSpec:
    """A landing source: (format, row tag, optional) entries and the columns it must have."""

    name: str
    formats: tuple[tuple[str, str | None, bool], ...]
    required: tuple[str, ...]


SOURCES = {
    name: SourceSpec(name, formats, fv.RAW_COLUMNS[name])
    for name, formats in fv.SOURCE_FORMATS.items()
}


def layer_path(root: str, layer: str, dataset: str) -> str:
    if layer not in fv.LAYERS:
        raise ValueError(f"unknown lake layer: {layer}")
    return f"{root.rstrip('/')}/{layer}/{dataset}"


def day_path(table: str, date: str) -> str:
    return f"{table.rstrip('/')}/{fv.BATCH_DATE}={date}"


def path_exists(spark: SparkSession, glob: str) -> bool:
    path = spark._jvm.org.apache.hadoop.fs.Path(glob)
    found = path.getFileSystem(spark._jsc.hadoopConfiguration()).globStatus(path)
    return bool(found)


def _files(spark: SparkSession, path: str) -> list[str]:
    """The data files of a path or glob, a folder's own files included."""
    Path = spark._jvm.org.apache.hadoop.fs.Path
    store = Path(path).getFileSystem(spark._jsc.hadoopConfiguration())
    found: list[str] = []
    for status in store.globStatus(Path(path)) or []:
        inner = store.listStatus(status.getPath()) if status.isDirectory() else [status]
        for file in inner:
            if file.isFile() and not file.getPath().getName().startswith(("_", ".")):
                found.append(str(file.getPath()))
    return sorted(found)


def _first_line(spark: SparkSession, file: str) -> str | None:
    """The first line of a text file, None for an empty one; no more of it is read."""
    jvm = spark._jvm
    conf = spark._jsc.hadoopConfiguration()
    path = jvm.org.apache.hadoop.fs.Path(file)
    stream = path.getFileSystem(conf).open(path)
    try:
        codec = jvm.org.apache.hadoop.io.compress.CompressionCodecFactory(conf).getCodec(path)
        plain = codec.createInputStream(stream) if codec is not None else stream
        return jvm.java.io.BufferedReader(jvm.java.io.InputStreamReader(plain, "UTF-8")).readLine()
    finally:
        stream.close()


def _csv_rows(spark: SparkSession, path: str, required: Sequence[str] = ()) -> DataFrame:
    """CSV with a header, all columns as text, malformed rows kept in _corrupt_record.

    Files are grouped by their header; each group is read with its own columns and the
    groups are united by name, so moved, missing and further columns land where they
    belong. The lines of a file that lacks a required column are malformed rows, unless
    every file lacks one. Column pruning is off so that a row of the wrong length is found
    whichever columns a query uses.
    """
    files = _files(spark, path)
    with ThreadPoolExecutor(OPENED_AT_ONCE) as pool:
        headers = list(pool.map(lambda f: _first_line(spark, f), files))
    groups: dict[str, list[str]] = {}
    for file, header in zip(files, headers):
        if header is not None:
            groups.setdefault(header, []).append(file)
    if not groups:
        return spark.createDataFrame([], f"{fv.CORRUPT} string, {_FILE} string")
    options = {"header": True, "encoding": "UTF-8"}
    names = {h: spark.read.options(**options).csv(g[0]).columns for h, g in groups.items()}
    whole = [h for h in groups if set(required) <= set(names[h])]
    frames = []
    for header, group in groups.items():
        if whole and header not in whole:
            lines = spark.read.text(group).filter(F.col("value") != F.lit(header))
            frames.append(lines.select(F.col("value").alias(fv.CORRUPT), F.col("_metadata.file_path").alias(_FILE)))
            continue
        schema = StructType([StructField(c, StringType()) for c in [*names[header], fv.CORRUPT]])
        body = spark.read.schema(schema).options(
            **options, mode="PERMISSIVE", columnNameOfCorruptRecord=fv.CORRUPT, columnPruning=False, enforceSchema=False,
        )
        frames.append(body.csv(group).select("*", F.col("_metadata.file_path").alias(_FILE)))
    # The columns of the most files come first.
    order = sorted(range(len(frames)), key=lambda i: -len(list(groups.values())[i]))
    union = union_frames([frames[i] for i in order], allow_missing=True)
    return union.select(*[c for c in union.columns if c not in (fv.CORRUPT, _FILE)], fv.CORRUPT, _FILE)


def _xml_start(spark: SparkSession, file: str, row_tag: str) -> tuple[str, str] | None:
    """How the first record of a file starts, up to the character after its name, and all
    text before it; None for a file without records."""
    path = spark._jvm.org.apache.hadoop.fs.Path(file)
    stream = path.getFileSystem(spark._jsc.hadoopConfiguration()).open(path)
    start, head = re.compile(rf"<{re.escape(row_tag)}[\s>]"), b""
    try:
        while True:
            more = bytes(stream.readNBytes(HEAD_BYTES))
            head += more
            text = head.decode("utf-8", "ignore")
            found = start.search(text)
            if found or not more:
                return (found.group(), text[: found.start()]) if found else None
    finally:
        stream.close()


def _xml_records(spark: SparkSession, path: str, row_tag: str) -> DataFrame:
    """(record, file) of all records by tag, each from its start tag to its end tag.

    The text reader cuts files where a record starts as the file's first one does, so a
    large file is read by many tasks; records that start otherwise, with attributes or
    without, are cut apart afterwards. A record without an end tag goes up to the next
    record. An element of a record must not bear the record's name; an empty record
    (<tag/>) is none.
    """
    tag = re.escape(row_tag)
    files = _files(spark, path)
    with ThreadPoolExecutor(OPENED_AT_ONCE) as pool:
        starts = list(pool.map(lambda f: _xml_start(spark, f, row_tag), files))
    frames = []
    for start in sorted({s[0] for s in starts if s}):
        own = [f for f, s in zip(files, starts) if s and s[0] == start]
        before = sorted({s[1] for s in starts if s and s[0] == start})
        pieces = spark.read.option("lineSep", start).text(own)
        # What stands before the first record of a file; it may be cut like a record.
        pieces = pieces.filter(~F.col("value").isin(before))
        cut = F.split(F.concat(F.lit(start), F.col("value")), f"(?=<{tag}[\\s/>])")
        frames.append(pieces.select(F.explode(cut).alias("record"), F.col("_metadata.file_path").alias(_FILE)))
    if not frames:
        return spark.createDataFrame([], f"record string, {_FILE} string")
    records = union_frames(frames).filter(F.col("record").rlike(f"^<{tag}[\\s>]") & ~F.col("record").rlike(f"^<{tag}[^<>]*/>"))
    # Most end tags are plain and found by their bytes; others, as </tag >, by the pattern.
    plain = f"</{row_tag}>"
    first, spaced = F.instr("record", plain), F.col("record").rlike(f"</{tag}\\s")
    whole = F.substring("record", F.lit(1), first + F.lit(len(plain) - 1))
    ended = F.regexp_extract("record", f"(?s)^(.*?</{tag}\\s*>)", 1)
    ended = F.when((first > 0) & ~spaced, whole).when(ended != "", ended).otherwise(F.col("record"))
    return records.select(ended.alias("record"), _FILE)


def _xml_shapes(records: DataFrame, options: Mapping[str, str]) -> DataFrame:
    """The structures of all well-formed records, each once: their texts are taken out and
    what differs is left, of which there is little."""
    bare = F.regexp_replace("record", "(?s)<!--.*?-->", "")
    bare = F.regexp_replace(bare, "(?s)<!\\[CDATA\\[.*?\\]\\]>", "x")
    bare = F.regexp_replace(bare, "=\\s*(\"[^\"]*\"|'[^']*')", "=''")
    bare = F.regexp_replace(F.regexp_replace(bare, ">\\s+<", "><"), ">[^<]+<", ">x<")
    # Records without their texts are few, so the rest is done once for each that differs.
    bare, records = F.col("bare"), records.select(bare.alias("bare")).distinct()
    # An empty element is a leaf like another.
    bare = F.regexp_replace(bare, "<([\\w.:-]+)(\\s[^<>]*)?/>", "<$1$2>x</$1>")
    bare = F.regexp_replace(bare, "<([\\w.:-]+)(\\s[^<>]*)?></\\1>", "<$1$2>x</$1>")
    bare = F.regexp_replace(bare, "(<([\\w.:-]+)(?:\\s[^<>]*)?>x</\\2>)\\1+", "$1$1")
    shapes = records.groupBy(bare.alias("shape")).agg(F.count(F.lit(1)).alias("n"))
    # Judged with the number beside it, or Spark would judge every record before it counts them.
    corrupt = F.from_xml("shape", f"{fv.CORRUPT} string", dict(options))[fv.CORRUPT]
    return shapes.filter(F.when(F.col("n") > 0, corrupt).isNull()).select("shape")


def _xml_schema(records: DataFrame, options: Mapping[str, str]) -> StructType:
    """The columns of all well-formed records, nested and repeated elements as such.

    Spark's own rules find the columns of one document of all structures.
    """
    shapes = [r[0] for r in _xml_shapes(records, options).collect()]
    if not shapes:
        return StructType([])
    document = f"<all><record>{'</record><record>'.join(shapes)}</record><record/><record/></all>"
    found = records.sparkSession.range(1).select(F.schema_of_xml(F.lit(document), dict(options))).first()[0]
    outer = StructType.fromDDL(f"x {found}")["x"].dataType["record"].dataType
    outer = outer.elementType if isinstance(outer, ArrayType) else outer
    inner = outer.fields[0].dataType if isinstance(outer, StructType) else None
    if isinstance(inner, ArrayType):
        inner = inner.elementType
    return inner if isinstance(inner, StructType) else StructType([])


def _xml_rows(
    spark: SparkSession, path: str, row_tag: str, columns: Sequence[str] | None = None
) -> DataFrame:
    """XML records by row tag, leaves as text.

    Records are cut out of the text and parsed one by one, so a malformed one is rejected
    alone and a large file takes many tasks. Each is parsed once; the columns are found by
    a pass that compares structures only, or are named, which saves that pass.
    """
    options = {"inferSchema": "false", "mode": "PERMISSIVE", "columnNameOfCorruptRecord": fv.CORRUPT}
    records = _xml_records(spark, path, row_tag)
    if columns is None:
        known = _xml_schema(records, options)
    else:
        known = StructType([StructField(c, StringType()) for c in columns])
    # A record of text alone, or of nothing, has no columns.
    schema = StructType([*[f for f in known.fields if f.name != "_VALUE"], StructField(fv.CORRUPT, StringType())])
    parsed = records.select(F.from_xml("record", _ddl(schema), options).alias("_parsed"), _FILE)
    return parsed.select("_parsed.*", _FILE)


def _ddl(schema: StructType) -> str:
    return ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in schema.fields)


def read_csv_raw(spark: SparkSession, path: str) -> DataFrame:
    """CSV files with a header as text, without the file each row is from."""
    return _csv_rows(spark, path).drop(_FILE)


def read_xml_raw(
    spark: SparkSession, path: str, row_tag: str, columns: Sequence[str] | None = None
) -> DataFrame:
    """XML records as text, without the file each is from."""
    return _xml_rows(spark, path, row_tag, columns).drop(_FILE)


def read_source(spark: SparkSession, spec: SourceSpec, folder: str) -> DataFrame:
    """All files of a source, with _source_format, _source_file and _corrupt_record."""
    frames = []
    for fmt, row_tag, optional in spec.formats:
        glob = f"{folder.rstrip('/')}/*.{fmt}"
        if not path_exists(spark, glob):
            if optional:
                continue
            raise FileNotFoundError(f"{spec.name}: nothing at {glob}")
        if fmt == "csv":
            df = _csv_rows(spark, glob, spec.required)
        else:
            df = _xml_rows(spark, glob, row_tag)
        if fv.CORRUPT not in df.columns:
            df = df.withColumn(fv.CORRUPT, F.lit(None).cast("string"))
        elif set(df.columns) == {fv.CORRUPT, _FILE}:
            # Every record is malformed: read with the agreed columns.
            df = _xml_rows(spark, glob, row_tag, spec.required)
        frames.append(
            df.select(
                *[c for c in df.columns if c != _FILE],
                F.lit(fmt).alias("_source_format"),
                _FILE,
            )
        )
    if not frames:
        raise FileNotFoundError(f"{spec.name}: no files in {folder}")
    return union_frames(frames, allow_missing=True)


def with_provenance(df: DataFrame, date: str, run_id: str) -> DataFrame:
    """Add ingest time, batch date and run id; format and file come with the scan."""
    return (
        df.withColumn("_ingested_at", F.current_timestamp())
        .withColumn(fv.BATCH_DATE, F.lit(date).cast("date"))
        .withColumn("_run_id", F.lit(run_id))
    )


def read_day(spark: SparkSession, table: str, date: str, row_id: bool = False) -> DataFrame:
    """One batch of a Parquet table; an error when that day was never written.

    row_id adds _row_id, a hash of the file and the position of a row in it: stable
    over retries and different even between exact copies.
    """
    if not path_exists(spark, day_path(table, date)):
        raise FileNotFoundError(f"no batch {date} in {table}")
    df = spark.read.parquet(day_path(table, date))
    day = F.lit(date).cast("date").alias(fv.BATCH_DATE)
    if not row_id:
        return df.select("*", day)
    place = F.concat_ws("#", F.hex(F.xxhash64("_metadata.file_path")), "_metadata.row_index")
    return df.select("*", day, place.alias("_row_id"))


def read_layer(
    spark: SparkSession, root: str, layer: str, dataset: str, date: str, row_id: bool = False
) -> DataFrame:
    return read_day(spark, layer_path(root, layer, dataset), date, row_id)


def read_rejected(spark: SparkSession, path: str, schema: StructType) -> DataFrame:
    """Rejected records; the corrupt text is an ordinary field of these files."""
    options = {"columnNameOfCorruptRecord": "_unreadable"}
    return spark.read.schema(schema).options(**options).json(path)


def read_table(spark: SparkSession, table: str) -> DataFrame:
    """A whole table by batch date; filters on the date prune folders.

    Of a table changed by key these are its current rows.
    """
    # Sinks read what they write, so this one is imported here.
    from lakestay.sinks.versioned import VersionedTable, is_versioned

    if is_versioned(spark, table):
        return VersionedTable.open(spark, table).read()
    df = spark.read.parquet(table)
    if fv.BATCH_DATE in df.columns:
        df = df.withColumn(fv.BATCH_DATE, F.col(fv.BATCH_DATE).cast("date"))
    return df
