"""Pairs of formulations that must agree, and skewed inputs against plain counting."""

from collections import Counter

from pyspark.sql import functions as F

from helixframe.operators import joins as J
from helixframe.operators import predicates as P
from helixframe.operators.reshape import sample_line
from helixframe.plans import cohort as C
from helixframe.plans import frequency as N
from helixframe.plans import population as Q
from helixframe.plans import quality as U
from helixframe.plans.tables import gvcf_view, with_alleles
from helixframe.sources.dims import CYP2C19_RSIDS

GENOTYPE = "chrom string, pos int, id array<string>, ref string, alt array<string>, sample_id string, gt string"


def _genotypes(spark, hot=3000):
    """One site holds a third of all rows; phased, unphased, haploid and missing calls."""
    calls = ["0|0", "0|1", "1|1", "1|2", "./.", "0/1", "1", "."]
    rows = []
    for n in range(hot):
        rows.append(("1", 100, ["rs1"], "A", ["C", "G"], f"S{n:05d}", calls[n % 5]))
    for n in range(2 * hot):
        pos = 200 + n % 97
        rows.append(("12X"[n % 3], pos, [f"rs{pos}"], "C", ["T"], f"S{n % 61:05d}", calls[n % 8]))
    return with_alleles(spark.createDataFrame(rows, GENOTYPE).repartition(9))


def _alleles(spark):
    rows = [("1", 100, ["rs1"], "A", ["C", "G"], i, a, f) for i, a, f in ((0, "C", 0.0005), (1, "G", 0.3))]
    for chrom in "12X":
        rows += [(chrom, 200 + n, [f"rs{200 + n}"], "C", ["T"], 0, "T", n / 50000) for n in range(97)]
    return spark.createDataFrame(
        rows, "chrom string, pos int, id array<string>, ref string, alt array<string>, "
        "alt_allele_id int, alt_allele string, af double",
    )


def _plain(df):
    return [r.asDict() for r in df.collect()]


def test_interval_frequency_with_a_hot_site(spark):
    genotypes, alleles = _genotypes(spark), _alleles(spark)
    regions = spark.createDataFrame(
        [("g1", "1", 90, 250), ("g2", "1", 240, 260), ("g3", "X", 1, 10**9)],
        "gene string, chrom string, region_start int, region_end int",
    )
    snp = spark.createDataFrame(
        [("1", 100, "rs1", "A", ["C"], "G1:1"), ("1", 100, "rs2", "A", ["C", "T"], "G2:1"), ("X", 205, "rs3", "C", ["A"], "G")],
        "chrom string, pos int, id string, ref string, alt array<string>, geneinfo string",
    )
    got = Counter(
        (r["chrom"], r["pos"], r["alt_allele"], r["gene"], r["num_variant_alleles"], r["total_num_alleles"], r["snp_id"])
        for r in _plain(Q.interval_allele_frequency(alleles, genotypes, regions, snp, 0.001))
    )
    calls = _plain(genotypes)
    expected = Counter()
    for v in _plain(alleles):
        at = [g for g in calls if all(g[k] == v[k] for k in ("chrom", "pos", "ref", "alt"))]
        for r in _plain(regions):
            if v["af"] < 0.001 and at and r["chrom"] == v["chrom"] and r["region_start"] <= v["pos"] <= r["region_end"]:
                carried = sum((g["allele1"] == v["alt_allele"]) + (g["allele2"] == v["alt_allele"]) for g in at)
                total = sum(1 + g["gt"].count("|") + g["gt"].count("/") for g in at)
                notes = [
                    s["id"] for s in _plain(snp)
                    if (s["chrom"], s["pos"], s["ref"]) == (v["chrom"], v["pos"], v["ref"]) and v["alt_allele"] in s["alt"]
                ]
                for note in notes or [None]:
                    expected[(v["chrom"], v["pos"], v["alt_allele"], r["gene"], carried, total, note)] += 1
    assert got == expected and len(got) > 50


def test_condition_counts_are_join_counts(spark):
    """Several annotation rows at one locus multiply the counts, as a plain join does."""
    genotypes = _genotypes(spark, 300)
    clinvar = spark.createDataFrame(
        [("1", 100, "a", "A", ["C"], ["x"]), ("1", 100, "b", "A", ["G"], ["x", "y"]), ("2", 201, "c", "C", ["N"], ["x"]),
         ("2", 204, "d", "C", ["T"], ["y"])],
        "chrom string, pos int, id string, ref string, alt array<string>, clndn array<string>",
    )
    notes = [c for c in _plain(clinvar) if "x" in c["clndn"]]
    for plan, carrier in ((Q.condition_genotypes, False), (Q.condition_carriers, True)):
        got = {
            (r["chrom"], r["pos"], r["gt"]): r["samples"] for r in _plain(plan(genotypes, clinvar, "x"))
        }
        expected = Counter(
            (g["chrom"], g["pos"], g["gt"]) for g in _plain(genotypes) for c in notes
            if (g["chrom"], g["pos"], g["ref"]) == (c["chrom"], c["pos"], c["ref"])
            and (not carrier or {g["allele1"], g["allele2"]} & set(c["alt"]))
        )
        assert got == dict(expected)


def test_join_paths_agree(spark, rows, monkeypatch):
    """Broadcast and shuffle joins give the same rows."""
    genotypes, alleles = _genotypes(spark, 200), _alleles(spark)
    near = rows(Q.rare_carriers(alleles, genotypes, 0.001))
    monkeypatch.setattr(J, "small", lambda df, **k: df)
    monkeypatch.setattr(Q, "broadcast_if_small", lambda df, **k: (df, False))
    assert rows(Q.rare_carriers(alleles, genotypes, 0.001)) == near and near
    clinvar = alleles.select("chrom", "pos", "id", "ref", "alt", F.array(F.lit("x")).alias("clndn"))
    far = rows(Q.condition_genotypes(genotypes, clinvar, "x"))
    counts = rows(J.allele_totals(alleles, genotypes, ["chrom", "pos", "alt_allele"], False))
    assert rows(J.allele_totals(alleles, genotypes, ["chrom", "pos", "alt_allele"], True)) == counts
    monkeypatch.undo()
    assert rows(Q.condition_genotypes(genotypes, clinvar, "x")) == far


def test_titv_forms_agree_on_phased_diploid_calls(spark, rows):
    phased = _genotypes(spark, 500).where(F.col("gt").rlike(r"^[01]\|[01]$"))
    single = phased.where(F.size("alt") == 1)
    decoded, stored = rows(U.titv(single)), rows(U.titv_materialized(single))
    assert decoded == stored
    # C->T is a transition, so no sample has a transversion to divide by.
    assert decoded == []
    other = single.withColumn("alt", F.when(F.col("pos") % 2 == 0, F.array(F.lit("G"))).otherwise(F.col("alt")))
    other = with_alleles(other.drop("allele1", "allele2"))
    nested = other.groupBy("chrom", "pos", "ref", "alt").agg(
        F.collect_list(F.struct("sample_id", U.G.gt_numbers(F.col("gt")).alias("genotype"))).alias("calls")
    )
    assert rows(U.titv(other)) == rows(U.titv_materialized(other)) != []
    assert rows(U.titv(other)) == rows(U.titv_nested(P.autosomes(nested)))


def test_overlap_alt_counts_as_biallelic(spark):
    df = spark.createDataFrame(
        [("A", ["C"]), ("A", ["C", "<*>"]), ("A", ["C", "G"]), ("AT", ["C"]), ("A", ["<*>"]), ("A", None)],
        "ref string, alt array<string>",
    )
    assert P.biallelic_snps(df).count() == 2


def test_variant_qc_per_site(spark):
    genotypes = _genotypes(spark, 900)
    sites = _alleles(spark).select("chrom", "pos", "ref", "alt").distinct().withColumn("an", F.lit(1800))
    calls = _plain(genotypes)
    got = {(r["chrom"], r["pos"]): r for r in _plain(U.variant_qc(sites, genotypes, F.col("an")))}
    hot = [g for g in calls if (g["chrom"], g["pos"]) == ("1", 100)]
    called = [g for g in hot if "." not in g["gt"]]
    row = got[("1", 100)]
    assert row["n_called"] == len(called) and row["n_not_called"] == len(hot) - len(called)
    assert row["n_het"] == sum(g["allele1"] != g["allele2"] for g in called)
    assert row["n_non_ref"] == sum("1" in g["gt"] or "2" in g["gt"] for g in called)
    assert row["call_rate"] == len(called) / 1800 * 2.0
    homozygous = Counter((g["gt"], g["allele1"]) for g in hot if g["allele1"] and g["allele1"] == g["allele2"])
    assert {(h["gt"], h["allele"]): h["n"] for h in row["homozygotes"]} == dict(homozygous)


def test_same_position_on_another_contig_does_not_match(spark):
    genotypes = _genotypes(spark, 60).where("chrom = '2'")
    sites = _alleles(spark).select("chrom", "pos", "ref", "alt").distinct().withColumn("an", F.lit(2))
    got = U.variant_qc(sites, genotypes, F.col("an"))
    assert {r["chrom"] for r in got.collect()} == {"2"}


SPAN = "chrom string, pos int, end_pos int, ref string, alt_string string, filter string, sample_id string, format string, vals string"


def _spans(spark, hot=900):
    """A locus covered by a third of all rows, variant rows in both ALT orders, long blocks."""
    rows = []
    for n in range(hot):
        alts = "T,G,<NON_REF>" if n % 2 else "G,T,<NON_REF>"
        rows.append(("1", 500, 500, "C", alts, "PASS", f"S{n:04d}", "GT:DP", f"{n % 3}/{(n + 1) % 3}:{n % 40}"))
    for n in range(hot):
        start = 1 + n % 450
        rows.append(("1", start, start + 10 ** (n % 6), "A", "<NON_REF>", "PASS", f"S{n:04d}", "DP:GT", f"{n % 40}:0/0"))
    for n in range(hot):
        pos = 400 + n % 200
        rows.append(("2", pos, pos, "C", "T,<NON_REF>", ("PASS", "LowQ")[n % 4 == 0], f"S{n:04d}", "GT:DP", f"{n % 2}:.") )
    return gvcf_view(spark.createDataFrame(rows, SPAN).repartition(8))


def test_cohort_counts_agree_with_lists_and_brute_force(spark):
    spans = _spans(spark)
    variants, loci = C.cohort_tables(spans)
    counts = {tuple(r)[:5]: r["cnt"] for r in C.compute_variant_counts(spans, loci).collect()}
    lists = C.cohort_calls(spans, loci).collect()
    assert {tuple(r)[:5]: r["cnt"] for r in lists} == counts
    all_spans, expected = _plain(spans), Counter()
    members = {}
    for locus in _plain(loci):
        for s in all_spans:
            if s["chrom"] == locus["chrom"] and s["pos"] <= locus["pos"] <= s["end_pos"]:
                out = []
                for token in s["gt"].split("/"):
                    old = s["alt"][int(token) - 1] if token != "0" else None
                    out.append("0" if token == "0" else str(locus["alt"].index(old) + 1) if old in locus["alt"] else ".")
                key = (locus["chrom"], locus["pos"], locus["ref"], locus["alt_string"], "/".join(out))
                expected[key] += 1
                members.setdefault(key, []).append(s["sample_id"])
    assert counts == dict(expected)
    for r in lists:
        assert r["samples"] == ",".join(sorted(members[tuple(r)[:5]]))


def test_counts_without_broadcast(spark, monkeypatch):
    spans = _spans(spark, 200)
    _, loci = C.cohort_tables(spans)
    near = sorted(map(tuple, C.compute_variant_counts(spans, loci).collect()))
    from helixframe.operators.extent import Extent

    monkeypatch.setattr(Extent, "is_small", lambda self, max_rows=0, copies=1: False)
    assert sorted(map(tuple, C.compute_variant_counts(spans, loci).collect())) == near


def test_site_genotypes_count_to_the_distribution(spark):
    spans = _spans(spark, 300)
    detail = C.genotypes_at_nonref_sites(spans)
    keys = ["chrom", "pos", "ref", "allele1", "allele2", "gt"]
    counted = sorted(map(repr, (tuple(r) for r in detail.groupBy(*keys).count().collect())))
    assert sorted(map(repr, (tuple(r) for r in C.genotype_counts_at_sites(spans).collect()))) == counted
    some = C.genotypes_at_nonref_sites(spans, "2", 450, 460)
    assert {r["pos"] for r in some.collect()} <= set(range(450, 461))


def test_multisample_record_values(spark):
    rows = [
        ("1", 5, 5, "A", "C,<NON_REF>", "PASS", "S1", "GT:DP:GQ:MIN_DP", "0/1:10:20:."),
        ("1", 5, 5, "A", "<NON_REF>,C", "PASS", "S2", "GT:DP", "2/2:7"),
        ("1", 1, 9, "N", "<NON_REF>", "LowQ", "S3", "GT:GQ:MIN_DP", "0/0:3:4"),
        ("1", 5, 5, "A", "G", "LowQ", "S4", "GT", "1/1"),
    ]
    spans = gvcf_view(spark.createDataFrame(rows, SPAN))
    panel = spark.createDataFrame([(s,) for s in ("S3", "S1", "S5", "S4", "S0", "S2")], "sample_id string")
    got = C.multisample_vcf(spans, panel).collect()
    assert sample_line(panel).first()["samples"].split("\t") == ["S0", "S1", "S2", "S3", "S4", "S5"]
    assert len(got) == 1
    row = got[0].asDict()
    assert row["alt"] == "<NON_REF>,C" and row["format"] == "GT:DP:GQ:MIN_DP:FT"
    assert row["values"].split("\t") == [
        ".", "0/2:10:20:.:PASS", "2/2:7:.:.:PASS", "0/0:.:3:4:LowQ", "./.:.:.:.:LowQ", "."
    ]


def test_haplotypes(spark):
    rows = [
        ("1", 5, 5, "A", "C", "PASS", "S1", "GT", "0/1"), ("1", 1, 20, "N", "<NON_REF>", "PASS", "S2", "GT", "0/0"),
        ("1", 9, 9, "G", "T", "PASS", "S1", "GT", "./."), ("1", 1, 20, "N", "<NON_REF>", "PASS", "S3", "GT", "0/0"),
    ]
    loci = spark.createDataFrame([("1", 9, "G", "T"), ("1", 5, "A", "C")], "chrom string, pos int, ref string, alt string")
    got = C.pgx_haplotypes(gvcf_view(spark.createDataFrame(rows, SPAN)), loci).collect()
    assert [tuple(r) for r in got] == [("A-C , .-.", 1, 1), ("A-A , G-G", 0, 2)]


def test_depth_bins_round_half_up(spark):
    rows = [("1", n, n, "A", "C", "PASS", "S", "GT:DP", f"0/1:{d}") for n, d in enumerate([0, 2, 3, 7, 8, 12, 13])]
    got = C.depth_histogram(gvcf_view(spark.createDataFrame(rows, SPAN))).collect()
    assert [tuple(r) for r in got] == [(0, 2), (5, 2), (10, 2), (15, 1)]


def test_frequency_counts_join_rows(spark, rows):
    genotypes = _genotypes(spark, 300)
    annotation = spark.createDataFrame(
        [("1", 100, "A", "C", 0.01, 0.7), ("1", 100, "G", "C", 0.01, 0.7), ("2", 201, "C", "T", 0.05, 0.6),
         ("2", 204, "C", "T", 0.5, 0.6)],
        "chrom string, pos int, ref string, alt_allele string, af double, af_fin double",
    )
    calls = _plain(genotypes)

    def carriers(chrom, pos, allele):
        return sum(
            (g["chrom"], g["pos"]) == (chrom, pos) and allele in (g["allele1"], g["allele2"]) for g in calls
        )

    loose = {(r["pos"], r["ref"]): r["cnt"] for r in _plain(N.gnomad_carriers(annotation, genotypes))}
    assert loose == {
        (100, "A"): carriers("1", 100, "C"), (100, "G"): carriers("1", 100, "C"), (201, "C"): carriers("2", 201, "T")
    }
    strict = {(r["pos"], r["ref"]) for r in _plain(N.gnomad_carriers(annotation, genotypes, match_ref=True))}
    assert strict == {(100, "A"), (201, "C")}
    panel = genotypes.select("sample_id").distinct().withColumn("pop", F.substring("sample_id", 6, 1))
    by_pop = _plain(N.gnomad_carriers_by_pop(annotation, genotypes, panel))
    assert sum(r["cnt"] for r in by_pop) == sum(loose.values())


def test_rsids_match_literally(spark, rows):
    df = spark.createDataFrame([(["rs72552267"], 1), (["rs4244285", "x"], 2), (["x", "rs4244285"], 3)], "id array<string>, n int")
    assert rows(P.by_rsid(df, CYP2C19_RSIDS), "n") == [(2,)]
    listed = spark.createDataFrame([("rs72552267",), ("rs72552267",)], "rsid string")
    assert rows(P.by_rsid(df, listed), "n") == [(1,)]


def test_preview_limit_is_in_locus_order(spark):
    panel = spark.createDataFrame([("S00001", "FIN", "EUR", "female")], "sample_id string, pop string, super_pop string, gender string")
    got = Q.alleles_by_population(_genotypes(spark, 300), panel, "1", 1, 10**6, "FIN", "female", limit=3)
    positions = [r["pos"] for r in got.collect()]
    assert len(positions) == 3 and positions == sorted(positions)
