"""Static schedule (GTFS) packages and the coverage cube (SRC-05, SRC-06, SRC-21)."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from feedlake.sources.lines import quoted_records, read_lines

# pandas' default missing-value tokens (compat mode of SRC-05).
PANDAS_NULL_TOKENS = ("", "#N/A", "#N/A N/A", "#NA", "-1.#IND", "-1.#QNAN", "-NaN", "-nan", "1.#IND", "1.#QNAN",
                      "<NA>", "N/A", "NA", "NULL", "NaN", "None", "n/a", "nan", "null")


def read_gtfs_table(spark: SparkSession, path: str, table: str | None = None,
                    null_tokens: Sequence[str] = ("",), multiline: bool | None = None) -> DataFrame:
    """SRC-05: CSV with header, every column STRING (no inference), BOM stripped, quoted
    commas and line feeds kept; cells equal to a null token become null.

    A file is read in splits whatever its cells hold: record starts follow from the quotes
    before each line (``quoted_records``), in one pass over the text. ``multiline`` uses
    Spark's reader instead: ``False`` for files whose cells hold no line feeds, ``True`` for a
    file read as a whole.
    """
    options = {"header": True, "inferSchema": False, "escape": '"', "encoding": "UTF-8"}
    if multiline is None:
        names = spark.read.options(**options).csv(path).columns
        schema = T.StructType([T.StructField(f"_c{i}", T.StringType()) for i in range(len(names))])
        # The header is the first record of each file.
        body = quoted_records(read_lines(spark, path)).where(~F.col("first") & ~F.col("record").rlike(r"^\s*$"))
        cells = F.from_csv("record", F.lit(schema.simpleString().removeprefix("struct<").removesuffix(">").replace(":", " ")),
                           {"escape": '"', "multiLine": "true"})
        df = body.select(cells.alias("c")).select("c.*").toDF(*names)
    else:
        df = spark.read.options(**options).option("multiLine", multiline).csv(path)
    df = df.toDF(*[c.lstrip("\ufeff").strip() for c in df.columns])
    toks = list(null_tokens)
    return df.select(*[F.when(F.col(c).isin(*toks) | F.col(c).isNull(), F.lit(None).cast("string"))
                       .otherwise(F.col(c)).alias(c) for c in df.columns])


def gtfs_package_tables(spark: SparkSession, package_dir: str) -> list[str]:
    """Table names of an unpacked package: every ``*.txt`` entry minus ``.txt`` (SRC-06).

    Lists one folder (metadata only) through the Hadoop file system of the session.
    """
    jvm = spark.sparkContext._jvm
    conf = spark.sparkContext._jsc.hadoopConfiguration()
    p = jvm.org.apache.hadoop.fs.Path(package_dir)
    fs = p.getFileSystem(conf)
    names = [s.getPath().getName() for s in fs.listStatus(p)]
    return sorted(n[:-4] for n in names if n.endswith(".txt"))


COVERAGE_DOC_SCHEMA = T.StructType([
    T.StructField("agency", T.StringType()), T.StructField("name", T.StringType()),
    T.StructField("is_rt", T.BooleanType()), T.StructField("url", T.StringType()),
    T.StructField("streams", T.MapType(T.StringType(), T.MapType(T.StringType(), T.LongType()))),
])


def read_coverage(docs: DataFrame, col: str = "value") -> DataFrame:
    """Nested coverage documents -> long form ``(agency, stream, day, rows)`` (SRC-21)."""
    d = docs.select(F.from_json(F.col(col), COVERAGE_DOC_SCHEMA).alias("d")).select("d.*")
    s = d.select("agency", F.explode("streams").alias("stream", "days"))
    return s.select("agency", "stream", F.explode("days").alias("day", "rows")) \
        .withColumn("day", F.to_date("day")).withColumn("rows", F.col("rows").cast("bigint"))


ZIP_LINES = 50_000  # lines of a member held at a time


def _zip_members(batches):
    """mapInPandas body: one row per text line of every ``*.txt`` member, in order, a bounded
    number of lines at a time. Lines end at line feeds only; a member that is not UTF-8
    stops the job."""
    import io
    import zipfile

    import pandas as pd

    def frame(package, table, first, lines):
        return pd.DataFrame({"package": package, "table": table, "line_no": range(first, first + len(lines)), "value": lines})
    for pdf in batches:
        for path, content in zip(pdf["path"], pdf["content"]):
            package = path.rstrip("/").rsplit("/", 1)[-1].rsplit(".", 1)[0]
            with zipfile.ZipFile(io.BytesIO(content)) as zf:
                for name in zf.namelist():
                    if not name.endswith(".txt") or name.endswith("/"):
                        continue
                    table = name.rsplit("/", 1)[-1][:-4]
                    with zf.open(name) as raw, io.TextIOWrapper(raw, encoding="utf-8", newline="\n") as text:
                        lines, first = [], 0
                        for line in text:
                            lines.append(line.rstrip("\n").removesuffix("\r"))
                            if len(lines) == ZIP_LINES:
                                yield frame(package, table, first, lines)
                                lines, first = [], first + ZIP_LINES
                        if lines:
                            yield frame(package, table, first, lines)


def land_zip_packages(spark: SparkSession, zip_glob: str, out_root: str) -> None:
    """Unpack zipped schedule packages into ``<out_root>/package=<zip name>/table=<member>/``
    text files, one task per zip so lines keep their order (header first) (SRC-06).

    Python only opens the archives; the tables are then read by ``read_gtfs_table``.
    """
    zips = spark.read.format("binaryFile").load(zip_glob).select("path", "content")
    lines = zips.mapInPandas(_zip_members, "package string, table string, line_no int, value string")
    # An explicit per-task sort on (package, table, line_no) keeps each member's lines in
    # file order (the writer's own grouping sort would not promise order within a group).
    ordered = lines.sortWithinPartitions("package", "table", "line_no").select("package", "table", "value")
    ordered.write.mode("overwrite").partitionBy("package", "table").text(out_root)


def landed_tables(spark: SparkSession, out_root: str, package: str) -> list[str]:
    """Table names landed for one package by ``land_zip_packages``."""
    jvm = spark.sparkContext._jvm
    p = jvm.org.apache.hadoop.fs.Path(f"{out_root.rstrip('/')}/package={package}")
    fs = p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    return sorted(s.getPath().getName().split("=", 1)[1] for s in fs.listStatus(p)
                  if s.isDirectory() and s.getPath().getName().startswith("table="))
