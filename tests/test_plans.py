"""Queries over clustered tables prune partitions and push position filters to the scan."""

import re

import pytest

from helixframe import fixtures
from helixframe.registry import all_queries

SF_DIR = "/root/testdata/sf0.001"
TABLES = ("variants_fx", "genotypes_fx", "gvcf_fx", "snp_fx")


@pytest.fixture(scope="module")
def clustered(spark, tmp_path_factory):
    spark.conf.set("spark.sql.maxMetadataStringLength", "10000")
    fixtures.store_clustered(spark, SF_DIR, TABLES, str(tmp_path_factory.mktemp("clustered")))
    yield SF_DIR
    fixtures.forget_stored()
    spark.conf.unset("spark.sql.maxMetadataStringLength")


def _scans(df, table):
    plan = df._jdf.queryExecution().executedPlan().toString()
    return [line for line in plan.split("\n") if "FileScan" in line and f"{table}" in line]


@pytest.mark.parametrize(
    "name,table",
    [
        ("rare_carriers", "genotypes_fx"),
        ("rare_carriers", "variants_fx"),
        ("genotypes_at_nonref_sites_in_range", "gvcf_fx"),
        ("interval_allele_frequency", "genotypes_fx"),
        ("interval_allele_frequency", "snp_fx"),
    ],
)
def test_filters_reach_the_scan(spark, clustered, name, table):
    scans = _scans(all_queries()[name](spark, clustered), table)
    assert scans
    for scan in scans:
        partition = re.search(r"PartitionFilters: \[(.*?)\], PushedFilters", scan)
        pushed = re.search(r"PushedFilters: \[(.*?)\], ReadSchema", scan)
        assert partition and "chrom" in partition[1]
        assert pushed and re.search(r"(Greater|Less)ThanOrEqual\((pos|end_pos)", pushed[1])


def test_same_rows_as_from_base_tables(spark, clustered):
    stored = sorted(map(tuple, all_queries()["rare_carriers"](spark, clustered).collect()), key=repr)
    fixtures.forget_stored()
    derived = sorted(map(tuple, all_queries()["rare_carriers"](spark, clustered).collect()), key=repr)
    assert stored == derived
