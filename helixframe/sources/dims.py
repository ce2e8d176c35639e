"""Small literal dimensions."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from helixframe.session import literal_table

# RefSeq accessions of chromosomes 1-22, X, Y in both builds.
GRCH37_CONTIGS = {
    "NC_000001.10": "1", "NC_000002.11": "2", "NC_000003.11": "3", "NC_000004.11": "4",
    "NC_000005.9": "5", "NC_000006.11": "6", "NC_000007.13": "7", "NC_000008.10": "8",
    "NC_000009.11": "9", "NC_000010.10": "10", "NC_000011.9": "11", "NC_000012.11": "12",
    "NC_000013.10": "13", "NC_000014.8": "14", "NC_000015.9": "15", "NC_000016.9": "16",
    "NC_000017.10": "17", "NC_000018.9": "18", "NC_000019.9": "19", "NC_000020.10": "20",
    "NC_000021.8": "21", "NC_000022.10": "22", "NC_000023.10": "X", "NC_000024.9": "Y",
}
GRCH38_CONTIGS = {
    "NC_000001.11": "1", "NC_000002.12": "2", "NC_000003.12": "3", "NC_000004.12": "4",
    "NC_000005.10": "5", "NC_000006.12": "6", "NC_000007.14": "7", "NC_000008.11": "8",
    "NC_000009.12": "9", "NC_000010.11": "10", "NC_000011.10": "11", "NC_000012.12": "12",
    "NC_000013.11": "13", "NC_000014.9": "14", "NC_000015.10": "15", "NC_000016.10": "16",
    "NC_000017.11": "17", "NC_000018.10": "18", "NC_000019.10": "19", "NC_000020.11": "20",
    "NC_000021.9": "21", "NC_000022.11": "22", "NC_000023.11": "X", "NC_000024.10": "Y",
}
BUILDS = {"GRCh37": GRCH37_CONTIGS, "GRCh38": GRCH38_CONTIGS}

# CYP2C19 star-allele loci of the CPIC clopidogrel guideline, GRCh38.
CYP2C19_CHROM = "10"
CYP2C19_LOCI = (
    (94759304, "C", "T"), (94760676, "C", "T"), (94760686, "C", "A"), (94761267, "T", "C"),
    (94761665, "G", "A"), (94761900, "C", "T"), (94762693, "G", "A"), (94762706, "A", "G"),
    (94762712, "C", "T"), (94762715, "T", "C"), (94762755, "T", "C"), (94762760, "A", "C"),
    (94762788, "A", "T"), (94762804, "C", "T"), (94762856, "A", "G"), (94775106, "C", "T"),
    (94775121, "C", "T"), (94775160, "G", "C"), (94775185, "A", "G"), (94775367, "A", "G"),
    (94775416, "T", "C"), (94775453, "G", "A"), (94775489, "G", "A"), (94775507, "G", "A"),
    (94780574, "G", "C"), (94780579, "G", "A"), (94780653, "G", "A"), (94781858, "C", "T"),
    (94781859, "G", "A"), (94781944, "G", "A"), (94781999, "T", "A"), (94842861, "G", "A"),
    (94842865, "C", "T"), (94842866, "A", "G"), (94842879, "G", "A"), (94842995, "G", "A"),
    (94849964, "A", "G"), (94849995, "C", "T"), (94850018, "A", "C"), (94852738, "C", "T"),
    (94852765, "C", "T"), (94852785, "C", "G"), (94852914, "A", "C"),
)

# CYP2C19 identifiers of the literature list (one carries a trailing blank).
CYP2C19_RSIDS = (
    "rs11188072", "rs113164681", "rs111490789", "rs17878739", "rs7902257", "rs12248560",
    "rs367543001", "rs28399504", "rs367543002", "rs367543003", "rs55752064", "rs17882687",
    "rs17885098", "rs145328984", "rs118203756", "rs12769205", "rs41291556", "rs72552267 ",
    "rs17884712", "rs58973490", "rs140278421", "rs370803989", "rs4986893", "rs6413438",
    "rs4244285", "rs72558186", "rs138142612", "rs3758580", "rs3758581", "rs118203757",
    "rs113934938", "rs377184510", "rs17879685", "rs17886522", "rs56337013", "rs192154563",
    "rs118203759", "rs55640102",
)

# Gene regions of the interval query, GRCh37:
# gene, chromosome, gene start, gene end, region start, region end.
GENE_REGIONS = (
    ("PRCC", "1", 156736274, 156771607, 156636274, 156871607),
    ("NTRK1", "1", 156785541, 156852640, 156685541, 156952640),
    ("PAX8", "2", 113972574, 114037496, 113872574, 114137496),
    ("FHIT", "3", 59734036, 61238131, 59634036, 61338131),
    ("PPARG", "3", 12328349, 12476853, 12228349, 12576853),
)


def contig_aliases(build: str = "GRCh38") -> dict[str, str]:
    """Accession to chromosome name; X and Y take the numbers 23 and 24."""
    return dict(BUILDS[build])


def contig_alias_dim(spark: SparkSession, build: str = "GRCh38") -> DataFrame:
    return literal_table(
        spark, list(contig_aliases(build).items()), "genbank_id string, chrom string"
    )


def cyp2c19_dim(spark: SparkSession) -> DataFrame:
    return literal_table(
        spark,
        [(CYP2C19_CHROM, *locus) for locus in CYP2C19_LOCI],
        "chrom string, pos int, ref string, alt string",
    )


def gene_regions_dim(spark: SparkSession) -> DataFrame:
    return literal_table(
        spark,
        list(GENE_REGIONS),
        "gene string, chrom string, gene_start int, gene_end int, "
        "region_start int, region_end int",
    )
