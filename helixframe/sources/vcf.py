"""VCF, gVCF, panel and BED text as DataFrames.

All readers take plain or compressed text (``.gz`` by name) and any number of files or
folders. Headers are told apart by their leading ``#``, never by a fixed number of lines.

Many small files may come in packs: text files in a folder whose name ends in ``PACK``, each of
whose lines is led by the path of its member file and ``PACK_MARK``. A member's lines stand
together in one pack. All readers name a member ``<path of the pack>/<path of the member>`` and
treat it as a file of its own, so the cost of opening files follows bytes, not members.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from helixframe.functions import fields as V
from helixframe.functions.text import split_alts, split_ids
from helixframe.session import small

HEADER = "#"
COLUMN_LINE = "#CHROM"
FIXED_COLUMNS = 9
PACK, PACK_MARK = ".vcfpack", "\x1f"

PANEL_SCHEMA = "sample_id string, pop string, super_pop string, gender string"
BED_SCHEMA = "chrom string, start_pos int, end_plus1 int"


def _packed() -> Column:
    return F.col("_metadata.file_path").contains(f"{PACK}/")


def named_lines(lines: DataFrame) -> DataFrame:
    """``filename``, ``block_start`` and ``text`` of lines as Spark's text source gives them,
    stream or not."""
    path, value = F.col("_metadata.file_path"), F.col("value")
    member = F.concat(path, F.lit("/"), F.substring_index(value, PACK_MARK, 1))
    text = F.substr(value, F.instr(value, PACK_MARK) + F.lit(1))
    return lines.select(
        F.when(_packed(), member).otherwise(path).alias("filename"),
        F.col("_metadata.file_block_start").alias("block_start"),
        F.when(_packed(), text).otherwise(value).alias("text"),
    )


def read_lines(
    spark: SparkSession,
    path: str | list[str],
    pattern: str | None = None,
    partitions: int | None = None,
) -> DataFrame:
    """Text lines with ``filename`` (full path); ``pattern`` selects files by their path.

    The file condition is on file metadata, so Spark drops other files before reading them;
    members of packs are selected by their own path once their pack is read.
    A gzip file is one task; ``partitions`` spreads the lines of few large ones before they
    are parsed.
    """
    lines = spark.read.option("recursiveFileLookup", "true").text(path)
    if pattern is not None:
        lines = lines.where(_packed() | F.col("_metadata.file_path").rlike(pattern))
    named = named_lines(lines)
    if pattern is not None:
        named = named.where(F.col("filename").rlike(pattern))
    return named.repartition(partitions) if partitions else named


def select_files(spark: SparkSession, path: str | list[str], pattern: str) -> DataFrame:
    """Lines (``filename``, ``text``) of the files whose path matches the pattern."""
    return read_lines(spark, path, pattern).select("filename", "text")


def body_lines(lines: DataFrame) -> DataFrame:
    return lines.where(~F.startswith(F.col("text"), F.lit(HEADER)))


def header_lines(lines: DataFrame) -> DataFrame:
    return lines.where(F.startswith(F.col("text"), F.lit(HEADER)))


def scan_vcf_lines(
    spark: SparkSession, path: str | list[str], pattern: str | None = None
) -> DataFrame:
    """Every line of every file: ``filename, line, text`` with the 1-based line number.

    A file's lines are numbered without gathering them: rows are numbered within their
    input split, and a running sum over the few splits of a file gives each its offset.
    """
    lines = read_lines(spark, path, pattern).withColumn("__row", F.monotonically_increasing_id())
    splits = lines.groupBy("filename", "block_start").agg(
        F.min("__row").alias("__first"), F.count(F.lit(1)).alias("__rows")
    )
    earlier = (
        Window.partitionBy("filename")
        .orderBy("block_start")
        .rowsBetween(Window.unboundedPreceding, -1)
    )
    offsets = splits.withColumn("__before", F.coalesce(F.sum("__rows").over(earlier), F.lit(0)))
    numbered = lines.join(
        small(offsets.select("filename", "block_start", "__first", "__before")),
        ["filename", "block_start"],
    )
    line = F.col("__row") - F.col("__first") + F.col("__before") + F.lit(1)
    return numbered.select("filename", line.alias("line"), "text")


def scan_vcf_headers(
    spark: SparkSession,
    path: str | list[str],
    *,
    name: Column | None = None,
    pattern: str | None = None,
) -> DataFrame:
    """Header lines: ``vcfname, filename, line, text``.

    ``name`` is any expression over ``filename``: a literal, a regular-expression group or
    the file stem, which is the default. Headers open a file, so their order among header
    lines is their line number; only header rows are sorted.
    """
    lines = read_lines(spark, path, pattern).withColumn("__row", F.monotonically_increasing_id())
    in_file = Window.partitionBy("filename").orderBy("block_start", "__row")
    headers = header_lines(lines).withColumn("line", F.row_number().over(in_file))
    source = V.file_stem(F.col("filename")) if name is None else name
    return headers.select(source.alias("vcfname"), "filename", "line", "text")


def _column_lines(lines: DataFrame) -> DataFrame:
    return lines.where(F.startswith(F.col("text"), F.lit(COLUMN_LINE)))


def sample_columns(lines: DataFrame) -> DataFrame:
    """Per file the sample names of its column line, in column order."""
    names = F.slice(F.split(F.col("text"), "\t"), FIXED_COLUMNS + 1, F.lit(2**31 - 1))
    return _column_lines(lines).select("filename", names.alias("samples"))


def sample_lookup(lines: DataFrame) -> DataFrame:
    """Sample of each single-sample file: the tenth name of its column line."""
    return _column_lines(lines).select(
        "filename", F.get(F.split(F.col("text"), "\t"), F.lit(FIXED_COLUMNS)).alias("sample_id")
    )


def with_sample(rows: DataFrame, lookup: DataFrame) -> DataFrame:
    """Rows with the sample of their file."""
    return rows.join(small(lookup), "filename")


def _at(index: int) -> Column:
    return F.get(F.col("__part"), F.lit(index))


def _parts(lines: DataFrame) -> DataFrame:
    return lines.withColumn("__part", F.split(F.col("text"), "\t"))


def _site_columns() -> list[Column]:
    return [
        _at(0).alias("chrom"),
        _at(1).try_cast("int").alias("pos"),
        _at(2).alias("id"),
        _at(3).alias("ref"),
        _at(4).alias("alt"),
        _at(5).alias("qual"),
        _at(6).alias("filter"),
        _at(7).alias("info"),
    ]


def parse_sites(lines: DataFrame) -> DataFrame:
    """Body lines of a sites-only VCF as its eight columns, texts as they stand."""
    return _parts(body_lines(lines)).select("filename", *_site_columns())


def scan_vcf_sites(
    spark: SparkSession, path: str | list[str], pattern: str | None = None
) -> DataFrame:
    return parse_sites(read_lines(spark, path, pattern))


def typed_sites(raw: DataFrame) -> DataFrame:
    """Sites with ID and ALT as arrays and QUAL as a number."""
    return raw.withColumns(
        {
            "id": split_ids(F.col("id")),
            "alt": split_alts(F.col("alt")),
            "qual": V.qual_number(F.col("qual")),
        }
    )


def parse_wide(lines: DataFrame) -> DataFrame:
    """Body lines of a multi-sample VCF: the nine fixed columns and the array ``calls``.

    One array column instead of thousands of sample columns keeps the plan small.
    """
    calls = F.slice(F.col("__part"), FIXED_COLUMNS + 1, F.lit(2**31 - 1))
    return _parts(body_lines(lines)).select(
        "filename", *_site_columns(), _at(8).alias("format"), calls.alias("calls")
    )


def scan_vcf_wide(
    spark: SparkSession, path: str | list[str], pattern: str | None = None
) -> tuple[DataFrame, DataFrame]:
    """Wide rows and, per file, the sample names that go with their calls."""
    lines = read_lines(spark, path, pattern)
    return parse_wide(lines), sample_columns(lines)


def parse_gvcf(lines: DataFrame, sample: Column | None = None) -> DataFrame:
    """Body lines of per-sample gVCFs as span genotypes.

    ``sample`` is an expression over ``filename``, by default the file stem.
    """
    pos, info = _at(1).try_cast("int"), _at(7)
    return _parts(body_lines(lines)).select(
        V.norm_chrom(_at(0)).alias("chrom"),
        pos.alias("pos"),
        V.gvcf_end(info, pos).alias("end_pos"),
        V.norm_missing(_at(2)).alias("id"),
        _at(3).alias("ref"),
        _at(4).alias("alt_string"),
        V.qual_number(_at(5)).alias("qual"),
        _at(6).alias("filter"),
        V.norm_block_info(info).alias("info"),
        (V.file_stem(F.col("filename")) if sample is None else sample).alias("sample_id"),
        _at(8).alias("format"),
        V.gt_only(_at(9)).alias("gt"),
        _at(9).alias("vals"),
        "filename",
    )


def scan_gvcf(
    spark: SparkSession,
    path: str | list[str],
    *,
    sample: Column | None = None,
    pattern: str | None = None,
) -> DataFrame:
    return parse_gvcf(read_lines(spark, path, pattern), sample)


def parse_vcf_body(lines: DataFrame, drop_single_key_info: bool = True) -> DataFrame:
    """Body lines of single-sample VCFs as typed columns, GT taken by its FORMAT position."""
    return _parts(body_lines(lines)).select(
        V.norm_chrom(_at(0)).alias("chrom"),
        _at(1).try_cast("int").alias("pos"),
        V.norm_missing(_at(2)).alias("id"),
        _at(3).alias("ref"),
        V.norm_missing_alts(split_alts(_at(4))).alias("alt"),
        V.norm_missing(_at(5)).alias("qual"),
        _at(6).alias("filter"),
        V.norm_single_info(_at(7), drop_single_key_info).alias("info"),
        _at(8).alias("format"),
        V.format_field(_at(8), _at(9), "GT").alias("gt"),
        "filename",
    )


def bad_site_line(columns: int = 8) -> Column:
    """A body line that does not fit the VCF columns: fewer than ``columns`` (8 for sites, 10
    where samples follow), or POS or QUAL not a number."""
    qual = V.norm_missing(_at(5))
    return (
        (F.size(F.col("__part")) < columns)
        | _at(1).try_cast("int").isNull()
        | (qual.isNotNull() & qual.try_cast("double").isNull())
    )


def checked_lines(lines: DataFrame, columns: int = 8, keep: tuple[str, ...] = ()) -> DataFrame:
    """``filename``, ``text``, ``cells`` (columns of the line), ``bad`` and columns to keep; header
    lines are never bad.

    What a load stores from its one pass over the text: bad files, dictionary and sample
    names all follow from it.
    """
    header = F.startswith(F.col("text"), F.lit(HEADER))
    return _parts(lines.select("filename", "text", *keep)).select(
        "filename", "text", *keep, F.size("__part").alias("cells"),
        (~header & F.coalesce(bad_site_line(columns), F.lit(True))).alias("bad"),
    )


def mark_wrong_cells(checked: DataFrame, samples: DataFrame) -> DataFrame:
    """Marks body lines bad whose cells differ in number from their file's ``#CHROM`` line."""
    sizes = samples.groupBy("filename").agg(F.max(F.size("samples")).alias("__samples"))
    body = ~F.startswith(F.col("text"), F.lit(HEADER))
    wrong = F.col("__samples").isNull() | (F.col("cells") != F.col("__samples") + FIXED_COLUMNS)
    return (
        checked.join(small(sizes), "filename", "left")
        .withColumn("bad", F.col("bad") | (body & wrong))
        .drop("__samples")
    )


def split_bad_files(checked: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Lines of clean files, and the bad body lines that made their whole file drop out."""
    bad = checked.where("bad").select("filename", "text")
    bad_files = small(bad.select("filename").distinct())
    return checked.select("filename", "text").join(bad_files, "filename", "left_anti"), bad


def skip_bad_files(lines: DataFrame, columns: int = 8) -> tuple[DataFrame, DataFrame]:
    """``split_bad_files`` of lines as they are read; the lines are read twice."""
    bad = _parts(body_lines(lines)).where(bad_site_line(columns)).drop("__part")
    bad_files = small(bad.select("filename").distinct())
    return lines.join(bad_files, "filename", "left_anti"), bad


def scan_panel(spark: SparkSession, path: str | list[str]) -> DataFrame:
    """Sample panel: tab separated, one header line."""
    return spark.read.csv(path, sep="\t", header=True, schema=PANEL_SCHEMA)


def scan_bed(spark: SparkSession, path: str | list[str]) -> DataFrame:
    """BED intervals: tab separated, 0-based half-open."""
    return spark.read.csv(path, sep="\t", schema=BED_SCHEMA, comment="#")
