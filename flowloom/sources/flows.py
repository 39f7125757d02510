"""Flow CSV files: reading, inventory and header checks."""

from __future__ import annotations

from urllib.parse import quote

from pyspark.sql import Column, DataFrame, SparkSession, Window, functions as F, types as T

from ..functions.constants import SHORT_NAMES
from ..functions.labels import short_name
from ..plans.bounded import lookup_join
from .schemas import FLOW_SCHEMA


def decoded(uri: Column) -> Column:
    """Readable form of a file URI; a plus sign is a plus sign."""
    return F.url_decode(F.replace(uri, F.lit("+"), F.lit("%2B")))


def file_name(uri: Column) -> Column:
    return decoded(F.regexp_extract(uri, r"([^/]+)$", 1))


def read_flows(
    spark: SparkSession,
    path: str | list[str],
    schema: T.StructType = FLOW_SCHEMA,
    encoding: str | None = "UTF-8",
    rules: list[tuple[str, str]] = SHORT_NAMES,
    check_headers: bool = True,
) -> DataFrame:
    """Read capture CSVs with provenance. Columns are positional, so a repeated header name is fine.

    A file whose header is not that of ``schema`` (the second copy of a name ends in ``.1``, the third in
    ``.2``) raises; only the first lines are read for that. ``check_headers=False`` skips it.
    ``encoding=None`` looks through the files first and reads those that are not UTF-8 as Latin-1.
    The label clean-up copes with undecodable dashes, so large captures need no such extra scan.
    """

    def read(paths, charset: str) -> DataFrame:
        reader = (
            spark.read.schema(schema)
            .option("header", True)
            .option("enforceSchema", True)
            .option("ignoreLeadingWhiteSpace", True)
            .option("ignoreTrailingWhiteSpace", True)
            .option("nanValue", "NaN")
            .option("positiveInf", "Infinity")
            .option("negativeInf", "-Infinity")
            .option("encoding", charset)
        )
        return reader.csv(paths).withColumn("source_file", short_name(decoded(F.col("_metadata.file_name")), rules))

    if check_headers:
        assert_headers(spark, path, schema.names)
    if encoding is not None:
        return read(path, encoding)
    broken = files_not_utf8(spark, path)
    whole = read(path, "UTF-8")
    if not broken:
        return whole
    other = F.col("_metadata.file_path").isin([raw for raw, _ in broken])
    return whole.filter(~other).unionByName(read([name for _, name in broken], "ISO-8859-1"))


def files_not_utf8(spark: SparkSession, path: str | list[str]) -> list[tuple[str, str]]:
    """(URI, readable path) of the files that hold a line which is not valid UTF-8."""
    uri = F.col("_metadata.file_path")
    bad = spark.read.text(path).filter(~F.is_valid_utf8("value")).select(uri.alias("uri")).distinct()
    return [tuple(r) for r in bad.select("uri", decoded(F.col("uri"))).collect()]


def assert_headers(spark: SparkSession, path: str | list[str], names: list[str]) -> None:
    """Raise unless every file has the columns ``names`` in their order; names a few of the others."""
    wrong = header_columns(spark, path).filter("size(columns) > 0").filter(F.col("columns") != F.array(*[F.lit(n) for n in names]))
    found = wrong.orderBy("file").limit(3).collect()
    if found:
        told = "; ".join(f"{r['file']}: {[c for c in r['columns'] if c not in names] or 'missing or in another order'}" for r in found)
        raise ValueError(f"files with other columns than the schema: {told}")


# Schemes that Spark knows by another name than Arrow does.
SCHEMES = {"s3a": "s3", "s3n": "s3", "wasbs": "abfss"}


def _stored_at(path: str) -> str:
    """URI of a listed file: Spark names it without percent signs for blanks and the like."""
    scheme, colon, rest = path.partition(":")
    rest = quote(rest, safe="/:@+=,;!$&'()*~")
    if scheme == "dbfs":
        return "file:///dbfs/" + rest.lstrip("/")
    return SCHEMES.get(scheme, scheme) + colon + rest


def _numbered(names: list[str]) -> list[str]:
    """Later copies of a name get .1, .2 and so on."""
    seen: dict[str, int] = {}
    out = []
    for name in names:
        n = seen.get(name, 0)
        seen[name] = n + 1
        out.append(f"{name}.{n}" if n else name)
    return out


def header_columns(spark: SparkSession, path: str | list[str]) -> DataFrame:
    """Trimmed header of each file. Tasks open the listed files and read one line, not the data."""

    def first_lines(batches):
        import csv

        from pyarrow import fs

        for batch in batches:
            heads = []
            for uri in batch["path"]:
                system, inner = fs.FileSystem.from_uri(_stored_at(uri))
                with system.open_input_stream(inner) as stream:
                    head = b""
                    while b"\n" not in head and (chunk := stream.read(1 << 16)):
                        head += chunk
                line = head.split(b"\n", 1)[0].decode("utf-8-sig", "replace").rstrip("\r")
                heads.append(_numbered([c.strip() for c in next(csv.reader([line], skipinitialspace=True), [])]))
            yield batch.assign(columns=heads)

    paths = spark.read.format("binaryFile").load(path).select("path")
    heads = paths.mapInPandas(first_lines, "path string, columns array<string>")
    return heads.select(file_name(F.col("path")).alias("file"), "columns")


def schema_check(spark: SparkSession, path: str | list[str]) -> DataFrame:
    """Compare every file's header with the header of the first file by name."""
    heads = header_columns(spark, path)
    reference = heads.agg(F.min_by("columns", "file"))
    checked = heads.withColumn("_ref", reference.scalar())
    missing = F.array_sort(F.array_except("_ref", "columns"))
    extra = F.array_sort(F.array_except("columns", "_ref"))
    return checked.select(
        "file",
        F.size("columns").cast("long").alias("n"),
        (F.col("columns") == F.col("_ref")).alias("compatible"),
        F.array_join(missing, ", ").alias("missing"),
        F.array_join(extra, ", ").alias("extra"),
    )


def file_inventory(spark: SparkSession, path: str | list[str], rules=SHORT_NAMES, folders: bool = False) -> DataFrame:
    """Number, name, short name and size in MB of the input files; contents are not read.

    With ``folders`` an input is the folder a file lies in, such as one partition of a table.
    """
    listed = F.col("path") if not folders else F.regexp_replace("path", "/[^/]*$", "")
    files = spark.read.format("binaryFile").load(path).select(file_name(listed).alias("file"), F.col("length"))
    if folders:
        files = files.groupBy("file").agg(F.sum("length").alias("length"))
    ordered = Window.orderBy("file")  # one row per file
    return files.select(
        F.row_number().over(ordered).cast("long").alias("n"),
        "file",
        short_name(F.col("file"), rules).alias("short_name"),
        F.round(F.col("length") / (1024 * 1024), 2).alias("size_mb"),
    )


def missing_inputs(inventory: DataFrame, expected: list[str] | DataFrame) -> DataFrame:
    """Expected file names (a list, or a table with ``file``) that the inventory lacks."""
    if isinstance(expected, DataFrame):
        wanted = expected.select("file").distinct()
    else:
        wanted = inventory.sparkSession.createDataFrame([(n,) for n in expected], "file string")
    return lookup_join(wanted, inventory.select("file").distinct(), ["file"], "left_anti")


def assert_inputs(inventory: DataFrame, expected: list[str] | int) -> None:
    """Raise unless the inventory has the expected file count or every expected name."""
    if isinstance(expected, int):
        found = inventory.count()
        if found != expected:
            raise ValueError(f"{expected} files expected, {found} found")
        return
    absent = [r["file"] for r in missing_inputs(inventory, expected).collect()]
    if absent:
        raise FileNotFoundError(f"missing input files: {sorted(absent)}")
