"""Readers over text files, the load rules, clustered writes and incremental runs."""

from __future__ import annotations

from pyspark.sql import functions as F

from helixframe.fixtures import fixture
from helixframe.functions import fields as V
from helixframe.operators.info import parse_info
from helixframe.operators.reshape import unpivot_samples
from helixframe.plans import loading as L
from helixframe.plans.tables import gvcf_view, with_alleles
from helixframe.plans.tables import variants_flattened as flatten_sites
from helixframe.registry import inputs as src
from helixframe.registry import texts
from helixframe.registry.inputs import check, flat
from helixframe.registry.scalars import dictionary
from helixframe.session import new_scratch_path
from helixframe.sinks import tables as K
from helixframe.sources import vcf as S
from helixframe.streaming import incremental as X

SAMPLE_OF_PATH = r"sample_id=([^/]+)/"
FILE_OF_PATH = r"(sample_id=[^/]+/shard=\d+)/"


def _file():
    return V.path_part(F.col("filename"), FILE_OF_PATH)


def _sample():
    return V.path_part(F.col("filename"), SAMPLE_OF_PATH)


def scan_vcf_lines(spark, sf):
    rows = S.scan_vcf_lines(spark, texts.gvcf_files(spark, sf))
    return rows.select(_file().alias("file"), F.col("line").cast("bigint").alias("line"), "text")


def scan_vcf_headers(spark, sf):
    rows = S.scan_vcf_headers(spark, texts.gvcf_files(spark, sf), name=_sample())
    return rows.select("vcfname", _file().alias("file"), "line", "text")


def scan_gvcf(spark, sf):
    rows = S.scan_gvcf(spark, texts.gvcf_files(spark, sf), sample=_sample())
    return rows.drop("filename").withColumn("qual", F.col("qual").cast("bigint"))


def gvcf_from_text(spark, sf):
    """The gVCF view over files: FORMAT keys parsed on read."""
    rows = gvcf_view(S.scan_gvcf(spark, texts.gvcf_files(spark, sf), sample=_sample()))
    return rows.select("chrom", "pos", "end_pos", "sample_id", "gt", "dp", "gq", "min_dp", "ps", "str_times")


def scan_vcf_sites(spark, sf):
    return S.scan_vcf_sites(spark, texts.site_files(spark, sf)).drop("filename")


def typed_sites(spark, sf):
    return flat(S.typed_sites(S.scan_vcf_sites(spark, texts.site_files(spark, sf))).drop("filename", "info"))


def scan_vcf_wide(spark, sf):
    wide, _ = S.scan_vcf_wide(spark, texts.wide_files(spark, sf))
    return flat(wide.select("chrom", "pos", "id", "ref", "alt", "format", "calls"))


def unpivot(spark, sf):
    wide, samples = S.scan_vcf_wide(spark, texts.wide_files(spark, sf))
    long = unpivot_samples(wide, samples, ["chrom", "pos", "ref", "alt"])
    return long.select("chrom", "pos", "ref", "alt", "sample_id", V.gt_only(F.col("call")).alias("gt"))


def select_files(spark, sf):
    rows = S.select_files(spark, texts.gvcf_files(spark, sf), r"sample_id=S0+[0-4]\d?/shard=[02]/")
    return rows.select(_file().alias("file"), "text")


def sample_lookup(spark, sf):
    lines = S.read_lines(spark, texts.gvcf_files(spark, sf))
    return S.sample_lookup(lines).select(_file().alias("file"), "sample_id")


def rows_with_sample(spark, sf):
    """Body rows with the sample that the column line of their own file names."""
    lines = S.read_lines(spark, texts.gvcf_files(spark, sf))
    rows = S.with_sample(S.parse_vcf_body(lines), S.sample_lookup(lines))
    return rows.select("sample_id", "chrom", "pos", "gt")


def parse_vcf_body(spark, sf):
    lines = fixture(spark, sf, "gvcf_lines_fx").select(
        F.col("sample_id").alias("filename"), F.col("line_text").alias("text")
    )
    return flat(S.parse_vcf_body(lines))


def file_parts(spark, sf):
    lines = S.read_lines(spark, texts.gvcf_files(spark, sf)).groupBy("filename").agg(F.count("*").alias("lines"))
    path = F.col("filename")
    return lines.select(
        _sample().alias("sample_id"),
        V.path_part(path, r"shard=(\d+)/").cast("int").alias("shard"),
        F.substring(V.file_stem(path), 1, 4).alias("stem"),
        "lines",
    )


def scan_panel(spark, sf):
    return S.scan_panel(spark, texts.panel_files(spark, sf))


def scan_bed(spark, sf):
    return S.scan_bed(spark, texts.bed_files(spark, sf))


def _risky(spark, sf):
    return fixture(spark, sf, "risky_lines_fx").withColumnRenamed("line_text", "text")


def skip_bad_files(spark, sf):
    good, _ = S.skip_bad_files(_risky(spark, sf))
    return S.parse_sites(good).select("filename", "chrom", "pos", "id", "ref", "alt")


def bad_lines(spark, sf):
    _, bad = S.skip_bad_files(_risky(spark, sf))
    return bad


def incremental_ingest(spark, sf):
    """Files arrive in two lots; three runs load each of them once."""
    landing, target, log = (new_scratch_path(spark, n) for n in ("landing", "ingested", "load-log"))
    lines = texts.gvcf_lines(spark, sf)
    slices = texts.slices_of(lines)

    def arrive(part):
        files = lines.where(part)
        texts.write_files(files, ["sample_id", "shard"], ["line", "chrom", "pos"], landing, slices=slices)

    def run():
        X.incremental_ingest(spark, landing, target, log, lambda rows: S.parse_gvcf(rows, _sample()))

    first_lot = F.pmod(F.xxhash64("sample_id"), F.lit(2)) == 0
    arrive(first_lot)
    run()
    arrive(~first_lot)
    run()
    run()
    return spark.read.parquet(target).select("chrom", "pos", "end_pos", "sample_id", "gt", "vals")


def write_clustered(spark, sf):
    rows = src.genotypes(spark, sf)
    path = new_scratch_path(spark, "genotypes")
    K.write_clustered(rows, path, K.LOCUS_ORDER)
    return flat(K.read_clustered(spark, path, rows.schema))


def genotypes_by_sample(spark, sf):
    rows = src.genotypes(spark, sf)
    locus, sample = (new_scratch_path(spark, n) for n in ("by-locus", "by-sample"))
    K.write_genotypes(rows, locus, sample)
    return flat(K.read_clustered(spark, sample, rows.schema))


def refresh_by_sample(spark, sf):
    """The second copy kept up after a load of contigs with numeric names, then merged."""
    rows = src.genotypes(spark, sf).drop("id")
    table, copy, merged, log = (
        new_scratch_path(spark, n) for n in ("growing", "by-sample", "by-sample-merged", "refresh-log")
    )
    loaded = (F.col("gt") == "./.") & ~F.col("chrom").isin("X", "Y")
    K.write_genotypes(rows.where(loaded), table, copy)
    X.mark_loaded(spark, table, rows.schema, log)
    K.write_clustered(rows.where(~loaded), table, K.LOCUS_ORDER, mode="append")
    X.refresh_by_sample(spark, table, copy, log, rows.schema)
    X.refresh_by_sample(spark, table, copy, log, rows.schema)
    return flat(X.merge_batches(spark, copy, merged, rows.schema))


def genotypes_by_position(spark, sf):
    rows = src.spans(spark, sf)
    path = new_scratch_path(spark, "by-position")
    K.write_clustered(rows, path, ("chrom", "pos"))
    return flat(K.read_clustered(spark, path, rows.schema)).select(
        "chrom", "pos", "end_pos", "ref", "alt", "sample_id", "gt", "dp", "gq"
    )


def materialize(spark, sf):
    K.materialize(src.spans(spark, sf), "range_base")
    return spark.sql("select chrom, filter, count(*) as n from range_base group by chrom, filter")


def append_all(spark, sf):
    """Three site sources with different columns in one table."""
    parts = [
        fixture(spark, sf, name).select("chrom", "pos", "ref", *extra)
        for name, extra in (("sites_fx", ["qual"]), ("snp_fx", ["geneinfo"]), ("clinvar_fx", ["clndn"]))
    ]
    return K.append_all(parts)


def overwrite_reload(spark, sf):
    """A table loaded twice with overwrite holds the second load only."""
    path = new_scratch_path(spark, "reload")
    src.panel(spark, sf).write.mode("overwrite").parquet(path)
    src.panel(spark, sf).where(F.col("gender") == "male").write.mode("overwrite").parquet(path)
    return spark.read.parquet(path)


def variants_flattened(spark, sf):
    K.create_view(src.alleles(spark, sf), "alleles_view")
    return flat(spark.sql("select chrom, pos, id, ref, alt, alt_allele_id, alt_allele, af from alleles_view"))


def flattened_from_text(spark, sf):
    """Sites read from text, INFO parsed by the header, flattened to alleles."""
    sites = S.typed_sites(S.scan_vcf_sites(spark, texts.site_files(spark, sf)))
    return flatten_sites(parse_info(sites, dictionary(spark))).select(
        "chrom", "pos", "ref", "alt_allele_id", "alt_allele", "ac", "af"
    )


def genotypes_from_text(spark, sf):
    """Wide text to decoded long genotypes, written by locus and read back."""
    wide, samples = S.scan_vcf_wide(spark, texts.wide_files(spark, sf))
    long = unpivot_samples(wide, samples, ["chrom", "pos", "ref", "alt"])
    rows = with_alleles(
        long.select(
            "chrom", "pos", "ref", F.split("alt", ",").alias("alt"), "sample_id",
            V.gt_only(F.col("call")).alias("gt"),
        )
    )
    path = new_scratch_path(spark, "loaded-genotypes")
    K.write_clustered(rows, path, K.LOCUS_ORDER)
    stored = K.read_clustered(spark, path, rows.schema)
    return stored.groupBy("chrom", "pos", "ref", "gt", "allele1", "allele2").agg(F.count("*").alias("n"))


def _loaded(name):
    """A fresh output folder of a load."""
    return lambda spark: new_scratch_path(spark, name)


def load_sites(spark, sf):
    sites = L.load_sites(spark, texts.site_files(spark, sf), _loaded("site-load")(spark))
    return sites.select(
        "chrom", "pos", F.array_join("id", ";").alias("id"), "ref", F.array_join("alt", ",").alias("alt"),
        "qual", "filter", F.get("info.AF", F.lit(0)).alias("af0"), F.col("info.AN").alias("an"),
        F.coalesce("info.DB", F.lit(False)).alias("db"),
    )


def load_genotypes(spark, sf):
    """The by-sample copy of a load from multi-sample text."""
    _, by_sample = L.load_genotypes(spark, texts.wide_files(spark, sf), _loaded("wide-load")(spark))
    return flat(by_sample)


def _spoilt_wide(spark, sf):
    """The multi-sample text, where one file's rows lack their last cell and another has a bad POS."""
    lines = texts.wide_lines(spark, sf).withColumnRenamed("chrom", "contig")
    body = F.col("line") == 99
    short = F.regexp_replace("value", r"\t[^\t]*$", "")
    spoilt = F.when(body & (F.col("contig") == "2"), short).when(
        body & (F.col("contig") == "5"), F.regexp_replace("value", r"^([^\t]*\t)", "$1x")
    ).otherwise(F.col("value"))
    path = new_scratch_path(spark, "spoilt-text")
    texts.write_files(lines.withColumn("value", spoilt), ["contig", "shard"], ["line", "pos"], path)
    return path


def load_genotypes_skip_bad(spark, sf):
    _, by_sample = L.load_genotypes(spark, _spoilt_wide(spark, sf), _loaded("spoilt-load")(spark))
    return flat(by_sample)


def quarantine(spark, sf):
    """Bad lines that such a load leaves behind, by contig."""
    out = _loaded("spoilt-load")(spark)
    L.load_genotypes(spark, _spoilt_wide(spark, sf), out)
    chrom = F.split_part("text", F.lit("\t"), F.lit(1))
    return L.quarantine(spark, out, "genotypes").groupBy(chrom.alias("chrom")).agg(F.count("*").alias("n"))


def load_gvcf(spark, sf):
    _, by_position = L.load_gvcf(
        spark, texts.gvcf_files(spark, sf), _loaded("gvcf-load")(spark), sample=_sample()
    )
    return flat(by_position).select("chrom", "pos", "end_pos", "ref", "alt", "sample_id", "gt", "dp", "gq", "min_dp")


def load_single_sample(spark, sf):
    rows = L.load_single_sample(spark, texts.gvcf_files(spark, sf), _loaded("single-load")(spark))
    return flat(rows.drop("info")).withColumn("filename", _sample())


def load_headers(spark, sf):
    rows = L.load_headers(spark, texts.gvcf_files(spark, sf), _loaded("headers")(spark), _sample())
    return rows.groupBy("line", "text").agg(F.count("*").alias("files"))


def duplicate_keys(spark, sf):
    """Rows that repeat a declared key: (part, supplier) of the raw line items."""
    spark.read.parquet(f"{sf}/lineitem.parquet").createOrReplaceTempView("lineitem")
    return K.duplicate_keys(spark.table("lineitem"), ["l_partkey", "l_suppkey"])


QUERIES = {
    "scan_vcf_lines": scan_vcf_lines,
    "scan_vcf_headers": scan_vcf_headers,
    "scan_gvcf": scan_gvcf,
    "gvcf_view": gvcf_from_text,
    "scan_vcf_sites": scan_vcf_sites,
    "typed_sites": typed_sites,
    "scan_vcf_wide": scan_vcf_wide,
    "unpivot_samples": unpivot,
    "select_files": select_files,
    "sample_lookup": sample_lookup,
    "rows_with_sample": rows_with_sample,
    "parse_vcf_body": parse_vcf_body,
    "file_parts": file_parts,
    "scan_panel": scan_panel,
    "scan_bed": scan_bed,
    "skip_bad_files": skip_bad_files,
    "bad_lines": bad_lines,
    "incremental_ingest": incremental_ingest,
    "write_clustered": write_clustered,
    "genotypes_by_sample": genotypes_by_sample,
    "refresh_by_sample": refresh_by_sample,
    "genotypes_by_position": genotypes_by_position,
    "materialize": materialize,
    "append_all": append_all,
    "overwrite_reload": overwrite_reload,
    "variants_flattened": variants_flattened,
    "flattened_from_text": flattened_from_text,
    "genotypes_from_text": genotypes_from_text,
    "load_sites": load_sites,
    "load_genotypes": load_genotypes,
    "load_genotypes_skip_bad": load_genotypes_skip_bad,
    "quarantine": quarantine,
    "load_gvcf": load_gvcf,
    "load_single_sample": load_single_sample,
    "load_headers": load_headers,
    "duplicate_keys": duplicate_keys,
}

_FILE = "'sample_id='||sample_id||'/shard='||shard"
_FILES = "select distinct sample_id, shard from gvcf_lines_fx"
_LINES = (
    "select sample_id, shard, line, '' as chrom, 0 as pos, line_text from headers_fx "
    "join files using (sample_id) union all "
    "select sample_id, shard, 99, chrom, pos, line_text from gvcf_lines_fx"
)
_WIDE = (
    "select v.chrom, v.pos, v.id, v.ref, v.alt_string as alt, p.sample_id, "
    "coalesce(g.gt,'./.') as gt from variants_fx v join panel_fx p "
    "on v.chrom<>'Y' or p.gender='male' left join genotypes_fx g on g.chrom=v.chrom "
    "and g.pos=v.pos and g.sample_id=p.sample_id"
)
_GENO = (
    "select chrom, pos, replace(id,';',',') as id, ref, alt_string as alt, sample_id, gt, allele1, "
    "allele2 from geno"
)
_RISKY = (
    "select filename, split_part(line_text,chr(9),1) as chrom, try_cast(split_part(line_text,chr(9),2)"
    " as int) as pos, split_part(line_text,chr(9),3) as id, split_part(line_text,chr(9),4) as ref, "
    "split_part(line_text,chr(9),5) as alt from risky_lines_fx"
)

_LOADED = (
    "select chrom, pos, replace(id,';',',') as id, ref, alt, sample_id, gt, "
    + src.allele_sql(1, "ref", "alt") + " as allele1, " + src.allele_sql(2, "ref", "alt")
    + " as allele2 from wide"
)

ORACLES = {
    "scan_vcf_lines": check(
        f"select {_FILE} as file, row_number() over (partition by sample_id, shard "
        "order by line, chrom, pos) as line, line_text as text from all_lines",
        files=_FILES,
        all_lines=_LINES,
    ),
    "scan_vcf_headers": check(
        f"select sample_id as vcfname, {_FILE} as file, line, line_text as text from headers_fx "
        "join files using (sample_id)",
        files=_FILES,
    ),
    "scan_gvcf": check(
        "select chrom, pos, end_pos, cast(null as varchar) as id, ref, alt_string, "
        "cast(null as bigint) as qual, filter, '.' as info, sample_id, format, gt, vals from spans"
    ),
    "gvcf_view": check(
        "select chrom, pos, end_pos, sample_id, gt, dp, gq, min_dp, cast(null as int) as ps, "
        "cast(null as double) as str_times from spans"
    ),
    "scan_vcf_sites": check(
        "select chrom, pos, id, ref, alt_string as alt, qual, filter, info from sites_fx"
    ),
    "typed_sites": check(
        "select chrom, pos, replace(id,';',',') as id, ref, alt_string as alt, "
        "cast(qual as bigint) as qual, filter from sites_fx"
    ),
    "scan_vcf_wide": check(
        "select chrom, pos, id, ref, alt, 'GT' as format, string_agg(gt, ',' order by sample_id) "
        "as calls from wide group by all",
        wide=_WIDE,
    ),
    "unpivot_samples": check("select chrom, pos, ref, alt, sample_id, gt from wide", wide=_WIDE),
    "select_files": check(
        f"select {_FILE} as file, line_text as text from all_lines where "
        "regexp_matches(sample_id,'^S0+[0-4][0-9]?$') and shard in (0, 2)",
        files=_FILES,
        all_lines=_LINES,
    ),
    "sample_lookup": check(f"select {_FILE} as file, sample_id from files", files=_FILES),
    "rows_with_sample": check("select sample_id, chrom, pos, gt from spans"),
    "parse_vcf_body": check(
        "select chrom, pos, cast(null as varchar) as id, ref, alt_string as alt, "
        "cast(null as varchar) as qual, filter, cast(null as varchar) as info, format, gt, "
        "sample_id as filename from spans"
    ),
    "file_parts": check(
        "select sample_id, shard, 'part' as stem, count(*) as lines from all_lines "
        "group by sample_id, shard",
        files=_FILES,
        all_lines=_LINES,
    ),
    "scan_panel": check("select * from panel_fx"),
    "scan_bed": check("select * from bed_fx"),
    "skip_bad_files": check(
        "select * from risky where filename not in (select filename from risky where pos is null)",
        risky=_RISKY,
    ),
    "bad_lines": check(
        "select filename, line_text as text from risky_lines_fx where "
        "try_cast(split_part(line_text,chr(9),2) as int) is null"
    ),
    "incremental_ingest": check("select chrom, pos, end_pos, sample_id, gt, vals from spans"),
    "write_clustered": check(_GENO),
    "genotypes_by_sample": check(_GENO),
    "refresh_by_sample": check(
        "select chrom, pos, ref, alt_string as alt, sample_id, gt, allele1, allele2 from geno"
    ),
    "genotypes_by_position": check(
        "select chrom, pos, end_pos, ref, alt_string as alt, sample_id, gt, dp, gq from spans"
    ),
    "materialize": check("select chrom, filter, count(*) as n from gvcf_fx group by chrom, filter"),
    "append_all": check(
        "select chrom, pos, ref, qual, null as geneinfo, null as clndn from sites_fx union all "
        "select chrom, pos, ref, null, geneinfo, null from snp_fx union all "
        "select chrom, pos, ref, null, null, clndn from clinvar_fx"
    ),
    "overwrite_reload": check("select * from panel_fx where gender='male'"),
    "variants_flattened": check(
        "select chrom, pos, replace(id,';',',') as id, ref, alt_string as alt, alt_allele_id, "
        "alt_allele, af from flat"
    ),
    "flattened_from_text": check(
        "select f.chrom, f.pos, f.ref, f.alt_allele_id, f.alt_allele, cast(split_part("
        "regexp_extract(s.info,'AC=([^;]*)',1),',',f.alt_allele_id+1) as bigint) as ac, f.af "
        "from flat f join sites_fx s on f.chrom=s.chrom and f.pos=s.pos"
    ),
    "genotypes_from_text": check(
        "select chrom, pos, ref, gt, allele1, allele2, count(*) as n from (select w.*, "
        + src.allele_sql(1, "ref", "alt") + " as allele1, " + src.allele_sql(2, "ref", "alt")
        + " as allele2 from wide w) d group by all",
        wide=_WIDE,
    ),
    "load_sites": check(
        "select chrom, pos, id, ref, alt_string as alt, cast(qual as bigint) as qual, filter, "
        "cast(split_part(af_string,',',1) as double) as af0, cast(regexp_extract(info,'AN=([0-9]+)',1)"
        " as bigint) as an, contains(info,';DB;') as db from sites_fx"
    ),
    "load_genotypes": check(_LOADED, wide=_WIDE),
    "load_genotypes_skip_bad": check(f"{_LOADED} where chrom not in ('2', '5')", wide=_WIDE),
    "quarantine": check("select chrom, count(*) as n from sites_fx where chrom in ('2', '5') group by chrom"),
    "load_gvcf": check(
        "select chrom, pos, end_pos, ref, alt_string as alt, sample_id, gt, dp, gq, min_dp from spans"
    ),
    "load_single_sample": check(
        "select chrom, pos, cast(null as varchar) as id, ref, alt_string as alt, "
        "cast(null as bigint) as qual, filter, format, gt, sample_id as filename from spans"
    ),
    "load_headers": check(
        "select line, line_text as text, count(*) as files from headers_fx join files "
        "using (sample_id) group by line, line_text",
        files=_FILES,
    ),
    "duplicate_keys": (
        "select l_partkey, l_suppkey, count(*) as copies from lineitem "
        "group by l_partkey, l_suppkey having count(*)>1"
    ),
}
