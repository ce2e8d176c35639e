"""VCF-family text files made by Spark from the test tables, for the reader queries.

Files go below the shared scratch folder, once per application and source folder. A file
holds one shard, a fixed stretch of positions of a sample or contig, so that no file grows
with the genome; every file has its own header. There are as many of them as samples times
shards, so they are written as members of compressed packs (``sources.vcf``), one pack per task.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from helixframe.fixtures import SITE_HEADER, fixture
from helixframe.operators.reshape import filled_text
from helixframe.session import discard, new_scratch_path, shuffles_released, small
from helixframe.sinks.tables import written
from helixframe.sources.vcf import PACK, PACK_MARK

SHARD_POSITIONS = 200_000
# Lines that one write shuffles at most: the disk holds the shuffle of one slice, not of all text.
LINES_PER_SLICE = 25_000_000
SITE_COLUMNS = ("chrom", "pos", "id", "ref", "alt_string", "qual", "filter", "info")
WIDE_COLUMNS = ("#CHROM", "POS", "ID", "REF", "ALT", "QUAL", "FILTER", "INFO", "FORMAT")

def _shard():
    return F.floor(F.col("pos") / F.lit(SHARD_POSITIONS)).cast("int").alias("shard")


_made: dict[tuple[str, str, str], str] = {}


def _once(spark: SparkSession, sf: str, name: str, write) -> str:
    key = (spark.sparkContext.applicationId, sf, name)
    if key not in _made:
        path = new_scratch_path(spark, name)
        write(path)
        _made[key] = path
    return _made[key]


def _member(folders: list[str]):
    """The path of a file in its folders, with Spark's name for a folder without a value."""
    def named(folder):
        value = F.nullif(F.col(folder).cast("string"), F.lit(""))
        return F.concat(F.lit(f"{folder}="), F.coalesce(value, F.lit("__HIVE_DEFAULT_PARTITION__")))

    return F.concat_ws("/", *[named(folder) for folder in folders], F.lit("part.txt"))


def write_files(
    lines: DataFrame, folders: list[str], order: list[str], path: str, compression: str = "gzip", slices: int = 1
):
    """One text file per folder, its lines in the given order, as members of packs below ``path``.

    ``slices`` writes deal the files by a hash, each with the shuffle of its own share only;
    ``lines`` are then read that often, so they should be stored.
    """
    value = F.concat(_member(folders), F.lit(PACK_MARK), F.coalesce("value", F.lit("")))
    for part in range(slices):
        own = lines.where(F.pmod(F.xxhash64(*folders), F.lit(slices)) == part) if slices > 1 else lines
        ordered = own.repartition(*folders).sortWithinPartitions(*folders, *order)
        with shuffles_released(lines.sparkSession):
            ordered.select(value.alias("value")).write.mode("append").text(f"{path}/files{PACK}", compression=compression)


def slices_of(lines: DataFrame) -> int:
    """Slices for stored lines."""
    return max(1, -(-lines.count() // LINES_PER_SLICE))


def gvcf_lines(spark: SparkSession, sf: str, path: str | None = None) -> DataFrame:
    """Header and body lines of every (sample, shard) file with their order keys.

    Body lines are stored first (at ``path``): they name the files that get a header, and line
    items are grouped once.
    """
    rows = fixture(spark, sf, "gvcf_lines_fx").select("sample_id", "shard", "chrom", "pos", F.col("line_text").alias("value"))
    body = written(rows, "gvcf-lines", path).select("sample_id", "shard", F.lit(99).alias("line"), "chrom", "pos", "value")
    files = body.select("sample_id", "shard").distinct()
    head = fixture(spark, sf, "headers_fx").join(files, "sample_id").select(
        "sample_id", "shard", "line", F.lit("").alias("chrom"), F.lit(0).alias("pos"),
        F.col("line_text").alias("value"),
    )
    return head.unionByName(body)


def gvcf_files(spark: SparkSession, sf: str) -> str:
    """Folders ``sample_id=*/shard=*`` with one gVCF text each, packed."""

    def write(path):
        stored = new_scratch_path(spark, "gvcf-lines")
        lines = gvcf_lines(spark, sf, stored)
        write_files(lines, ["sample_id", "shard"], ["line", "chrom", "pos"], path, slices=slices_of(lines))
        discard(spark, stored)

    return _once(spark, sf, "gvcf-text", write)


def site_lines(spark: SparkSession, sf: str) -> DataFrame:
    rows = fixture(spark, sf, "sites_fx")
    body = rows.select(
        "chrom", _shard(), F.lit(99).alias("line"), "pos",
        F.concat_ws("\t", *[F.col(c).cast("string") for c in SITE_COLUMNS]).alias("value"),
    )
    head = rows.select("chrom", _shard()).distinct().select(
        "chrom", "shard",
        F.posexplode(
            F.array(
                F.lit("##fileformat=VCFv4.2"),
                *[F.lit(line) for line in SITE_HEADER],
                F.concat(F.lit("##contig=<ID="), F.col("chrom"), F.lit(">")),
                F.lit("\t".join(WIDE_COLUMNS[:8])),
            )
        ).alias("line", "value"),
    )
    return head.select("chrom", "shard", "line", F.lit(0).alias("pos"), "value").unionByName(body)


def site_files(spark: SparkSession, sf: str) -> str:
    """Folders ``contig=*/shard=*`` with one sites-only VCF each, in gzip-compressed packs."""
    return _once(
        spark, sf, "sites-text",
        lambda path: write_files(
            site_lines(spark, sf).withColumnRenamed("chrom", "contig"), ["contig", "shard"],
            ["line", "pos"], path,
        ),
    )


def wide_lines(spark: SparkSession, sf: str) -> DataFrame:
    """Multi-sample lines by contig; contig Y has the columns of male samples only.

    The sample list is the files' column layout: one row per layout, joined as such. Calls take
    their places in the layout, and the gaps between them are filled, so a line costs its calls
    and its length, not a search per sample.
    """
    panel = fixture(spark, sf, "panel_fx")
    everyone = panel.agg(F.sort_array(F.collect_list("sample_id")).alias("samples"))
    males = panel.where(F.col("gender") == "male").agg(
        F.sort_array(F.collect_list("sample_id")).alias("samples")
    )
    layouts = everyone.select(F.lit("all").alias("layout"), "samples").unionByName(
        males.select(F.lit("male").alias("layout"), "samples")
    )
    layout = F.when(F.col("chrom") == "Y", F.lit("male")).otherwise(F.lit("all")).alias("layout")
    places = layouts.select("layout", F.posexplode("samples").alias("place", "sample_id"))
    placed = fixture(spark, sf, "genotypes_fx").select("*", layout).join(small(places), ["layout", "sample_id"])
    calls = placed.groupBy("chrom", "pos").agg(
        F.sort_array(F.collect_list(F.struct("place", F.coalesce("gt", F.lit("./.")).alias("__value")))).alias("calls")
    )
    places_of = F.transform("calls", lambda c: c["place"])
    several = F.raise_error(F.lit("a sample has several calls at a site")).cast(calls.schema["calls"].dataType)
    single = F.when(F.size(F.array_distinct(places_of)) == F.size("calls"), F.col("calls")).otherwise(several)
    calls = calls.withColumn("calls", single)
    sites = fixture(spark, sf, "sites_fx").join(calls, ["chrom", "pos"], "left")
    sizes = layouts.select("layout", F.size("samples").alias("total"))
    body = sites.select("*", layout).join(sizes, "layout").select(
        "chrom", _shard(), F.lit(99).alias("line"), "pos",
        F.concat_ws(
            "\t", *[F.col(c).cast("string") for c in SITE_COLUMNS], F.lit("GT"),
            filled_text(F.coalesce("calls", F.array().cast("array<struct<place:int,__value:string>>")), F.col("total"), "./."),
        ).alias("value"),
    )
    files = fixture(spark, sf, "sites_fx").select(
        "chrom", _shard(), layout
    ).distinct()
    head = files.join(layouts, "layout").select(
        "chrom", "shard",
        F.posexplode(
            F.array(
                F.lit("##fileformat=VCFv4.2"),
                *[F.lit(line) for line in SITE_HEADER],
                F.concat_ws("\t", F.lit("\t".join(WIDE_COLUMNS)), "samples"),
            )
        ).alias("line", "value"),
    )
    return head.select("chrom", "shard", "line", F.lit(0).alias("pos"), "value").unionByName(body)


def wide_files(spark: SparkSession, sf: str) -> str:
    """Folders ``contig=*/shard=*`` with one multi-sample VCF text each, packed."""
    return _once(
        spark, sf, "wide-text",
        lambda path: write_files(
            wide_lines(spark, sf).withColumnRenamed("chrom", "contig"), ["contig", "shard"],
            ["line", "pos"], path, compression="lz4",
        ),
    )


def panel_files(spark: SparkSession, sf: str) -> str:
    return _once(
        spark, sf, "panel-text",
        lambda path: fixture(spark, sf, "panel_fx").write.csv(path, sep="\t", header=True),
    )


def bed_files(spark: SparkSession, sf: str) -> str:
    return _once(
        spark, sf, "bed-text",
        lambda path: fixture(spark, sf, "bed_fx").write.csv(path, sep="\t"),
    )
