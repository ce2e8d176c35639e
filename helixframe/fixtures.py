"""Genomics-shaped views over the star-schema test tables.

Every statement is plain SQL that Spark and DuckDB read alike, so the same text defines
the input of a query and the input of its check. ``end_pos`` stands for a span's END.
"""

from __future__ import annotations

import re

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T

from helixframe.sinks.tables import LOCUS_ORDER, read_clustered, write_clustered

BASE_TABLES = ("region", "nation", "supplier", "part", "lineitem")

# Line items that one task groups into calls, and the fewest that are worth a task.
CALLS_PER_TASK, LEAST_PER_TASK = 500_000, 20_000

# Declarations of the INFO keys that sites_fx uses.
SITE_HEADER = (
    '##INFO=<ID=AC,Number=A,Type=Integer,Description="Allele count, per ALT">',
    '##INFO=<ID=AF,Number=A,Type=Float,Description="Allele frequency">',
    '##INFO=<ID=AN,Number=1,Type=Integer,Description="Called alleles">',
    '##INFO=<ID=DB,Number=0,Type=Flag,Description="Known site">',
    '##INFO=<ID=VT,Number=.,Type=String,Description="Variant types">',
    '##INFO=<ID=DP,Number=1,Type=Integer,Description="Depth">',
)

FIXTURES = {
    "variants_fx": """
select pk, case when pk%24=22 then 'X' when pk%24=23 then 'Y' else cast(pk%24+1 as varchar(2)) end as chrom,
  cast(1000+pk*37 as int) as pos,
  'rs'||cast(pk as varchar(20))||case when pk%10=0 then ';ss'||cast(pk as varchar(20)) else '' end as id,
  substr('ACGT',cast(pk%4 as int)+1,1) as ref,
  substr('ACGT',cast((pk+1+k%3)%4 as int)+1,1)
    ||case when p_size%5=0 then ','||substr('ACGT',cast((pk+1+(k+1)%3)%4 as int)+1,1) else '' end as alt_string,
  case when p_size%11=0 then 'q10' else 'PASS' end as filter,
  '0.'||lpad(cast(case when pk%7=0 then 6000+p_size*50 else p_size end as varchar(5)),4,'0')
    ||case when p_size%5=0 then ',0.'||lpad(cast((p_size*3)%100 as varchar(5)),4,'0') else '' end as af_string,
  p_size
from (select p_partkey as pk, cast(floor(p_partkey/4.0) as bigint) as k, p_size from part) x""",
    "calls_fx": """
select l_partkey as pk, l_suppkey as sk, 'S'||lpad(cast(l_suppkey as varchar(10)),5,'0') as sample_id,
  min(cast(l_quantity as int)) as q, min(l_linenumber) as ln
from lineitem group by l_partkey, l_suppkey""",
    "genotypes_fx": """
select v.chrom, v.pos, v.id, v.ref, v.alt_string, c.sample_id,
  case when c.ln=7 then './.' when v.chrom='Y' then cast(c.q%2 as varchar(2))
       else cast(c.q%2 as varchar(2))||'|'||cast((c.q+c.ln)%(case when v.p_size%5=0 then 3 else 2 end) as varchar(2)) end as gt
from calls_fx c join variants_fx v on v.pk=c.pk""",
    "panel_fx": """
select 'S'||lpad(cast(s_suppkey as varchar(10)),5,'0') as sample_id, n_name as pop, r_name as super_pop,
  case when s_suppkey%2=0 then 'female' else 'male' end as gender
from supplier join nation on s_nationkey=n_nationkey join region on n_regionkey=r_regionkey""",
    "snp_fx": """
select chrom, pos, 'rs'||cast(pk as varchar(20)) as id, ref,
  case when pk%2=0 then alt_string else substr(alt_string,1,1) end as alt_string,
  case when pk%5=0 then 'CYP2C19:1557' else 'GENE'||cast(pk%20 as varchar(3))||':'||cast(pk as varchar(20)) end as geneinfo
from variants_fx where pk%3<>0""",
    "clinvar_fx": """
select chrom, pos, cast(pk as varchar(20)) as id, ref,
  case when pk%8=0 then substr(alt_string,1,1) else 'N' end as alt_string,
  case when pk%12=0 then 'Hereditary_nonpolyposis_colon_cancer,not_provided' else 'not_provided' end as clndn
from variants_fx where pk%4=0""",
    "gnomad_fx": """
select chrom, pos, id, ref, substr(alt_string,1,1) as alt_allele,
  '0.'||lpad(cast((p_size*2000)%100000 as varchar(6)),5,'0') as af_fin,
  '0.'||lpad(cast((pk*131)%100000 as varchar(6)),5,'0') as af
from variants_fx where pk%2=0""",
    "gvcf_fx": """
select v.chrom,
  case when c.ln<=4 then v.pos else v.pos-c.q end as pos,
  case when c.ln<=4 then v.pos else v.pos+37*c.ln end as end_pos,
  case when c.ln<=4 then v.ref else 'N' end as ref,
  case when c.ln>4 then '<NON_REF>'
       when c.sk%2=0 and length(v.alt_string)=3 then substr(v.alt_string,3,1)||','||substr(v.alt_string,1,1)||',<NON_REF>'
       else v.alt_string||',<NON_REF>' end as alt_string,
  case when c.q%4=0 then 'LowQ' else 'PASS' end as filter, c.sample_id, 'GT:DP:GQ:MIN_DP' as format,
  case when c.ln>4 then '0/0' when v.chrom='Y' then cast(c.q%2 as varchar(2)) when c.ln=4 then './.'
       else cast(c.q%2 as varchar(2))||'/'||cast((c.q+c.ln)%(case when v.p_size%5=0 then 3 else 2 end) as varchar(2)) end
    ||':'||cast(c.q as varchar(3))||':'||cast((c.q*7)%99 as varchar(3))||':'||case when c.ln>4 then cast(c.q-1 as varchar(3)) else '.' end as vals
from calls_fx c join variants_fx v on v.pk=c.pk""",
    "bed_fx": """
select cast(n_nationkey%22+1 as varchar(2)) as chrom, 1000+n_nationkey*1000 as start_pos, 1000+n_nationkey*1000+200 as end_plus1 from nation""",
    "intervals_fx": """
select r_name as gene, cast(r_regionkey+1 as varchar(2)) as chrom, 1000+r_regionkey*5000 as region_start, 41000+r_regionkey*5000 as region_end from region""",
    # Sites as VCF columns, with an INFO text to parse: per-ALT, scalar, flag and list keys.
    "sites_fx": """
select chrom, pos, id, ref, alt_string, cast(30+pk%60 as varchar(5)) as qual, filter, af_string,
  'AC='||cast(pk%90+1 as varchar(5))||case when p_size%5=0 then ','||cast(pk%40+1 as varchar(5)) else '' end
    ||';AF='||af_string||';AN='||cast(180+2*(pk%11) as varchar(5))
    ||case when pk%3=0 then ';DB' else '' end
    ||';VT='||case when p_size%5=0 then 'SNP,MULTI' else 'SNP' end
    ||case when pk%4=0 then ';DP=.' else ';DP='||cast(pk as varchar(12)) end as info
from variants_fx""",
    # Sites named by accession; some versions are not in the alias table.
    "accession_fx": """
select 'NC_'||lpad(cast(pk%24+1 as varchar(2)),6,'0')||'.'||cast(10+pk%3 as varchar(2)) as chrom, pos, id, ref, alt_string
from variants_fx""",
    # Site lines in files of 1000 positions each, some rows with a POS that is no number.
    "risky_lines_fx": """
select 'chr'||chrom||'/part-'||cast(cast(floor(pos/1000.0) as int) as varchar(9)) as filename,
  chrom||chr(9)||case when pk%31=0 then 'n'||cast(pos as varchar(12)) else cast(pos as varchar(12)) end||chr(9)||id||chr(9)||ref
    ||chr(9)||alt_string||chr(9)||qual||chr(9)||filter||chr(9)||info as line_text
from (select s.*, v.pk from sites_fx s join variants_fx v on s.chrom=v.chrom and s.pos=v.pos) x""",
    # Body lines of one gVCF per sample, in shards of 200,000 positions.
    "gvcf_lines_fx": """
select sample_id, cast(floor(pos/200000.0) as int) as shard, chrom, pos,
  'chr'||chrom||chr(9)||cast(pos as varchar(12))||chr(9)||'.'||chr(9)||ref||chr(9)||alt_string||chr(9)||'.'||chr(9)||filter
    ||chr(9)||case when end_pos>pos then 'END='||cast(end_pos as varchar(12)) else '.' end||chr(9)||format||chr(9)||vals as line_text
from gvcf_fx""",
    # Header lines of those files; the INFO dictionary has one key per super-population.
    "headers_fx": """
select sample_id, line, line_text from (
  select sample_id, 1 as line, '##fileformat=VCFv4.2' as line_text from panel_fx
  union all select sample_id, 2, '##source='||pop from panel_fx
  union all select sample_id, 3, '##INFO=<ID=AC,Number=A,Type=Integer,Description="Allele count, per ALT">' from panel_fx
  union all select sample_id, 4, '##INFO=<ID=AN,Number=1,Type=Integer,Description="Total alleles">' from panel_fx
  union all select sample_id, 5, '##INFO=<ID=DB,Number=0,Type=Flag,Description="dbSNP member">' from panel_fx
  union all select sample_id, 6, '##INFO=<ID='||replace(super_pop,' ','_')||'_AF,Number=A,Type=Float,Description="Frequency in '||super_pop||'">' from panel_fx
  union all select sample_id, 7, '#CHROM'||chr(9)||'POS'||chr(9)||'ID'||chr(9)||'REF'||chr(9)||'ALT'||chr(9)||'QUAL'||chr(9)||'FILTER'||chr(9)||'INFO'||chr(9)||'FORMAT'||chr(9)||sample_id from panel_fx
) h""",
}


def needed(sql: str) -> list[str]:
    """Fixtures a statement reads, directly or through others, in definition order."""
    found: set[str] = set()

    def visit(text: str) -> None:
        for name in FIXTURES:
            if name not in found and re.search(rf"\b{name}\b", text):
                found.add(name)
                visit(FIXTURES[name])

    visit(sql)
    return [name for name in FIXTURES if name in found]


def with_fixtures(sql: str, **extra: str) -> str:
    """Put the fixtures (and further named statements) in front of ``sql`` as CTEs."""
    whole = " ".join([sql, *extra.values()])
    ctes = [f"{name} as ({FIXTURES[name].strip()})" for name in needed(whole)]
    ctes += [f"{name} as ({text.strip()})" for name, text in extra.items()]
    return f"with {', '.join(ctes)} {sql}" if ctes else sql


# Fixtures kept as clustered tables, by table folder and name.
_stored: dict[tuple[str, str], tuple[str, T.StructType]] = {}


def store_clustered(spark: SparkSession, sf_dir: str, names: tuple[str, ...], folder: str) -> None:
    """Write fixtures as the clustered tables that a load leaves; ``fixture`` then reads those."""
    for name in names:
        rows = fixture(spark, sf_dir, name)
        path = f"{folder}/{name}"
        write_clustered(rows, path, LOCUS_ORDER)
        _stored[(sf_dir, name)] = (path, rows.schema)


def forget_stored() -> None:
    """Derive all fixtures from the base tables again."""
    _stored.clear()


def spread_calls(lines: DataFrame) -> DataFrame:
    """Line items dealt by (part, supplier), so that grouping them holds a bounded number in a task.

    The number of tasks follows from the rows that the files' footers state, whatever the size
    that adaptive execution merges shuffle partitions to.
    """
    rows, cores = lines.count(), lines.sparkSession.sparkContext.defaultParallelism
    tasks = max(1, -(-rows // CALLS_PER_TASK), min(cores, -(-rows // LEAST_PER_TASK)))
    return lines.repartition(tasks, "l_partkey", "l_suppkey")


def fixture(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """One derived table as a DataFrame over the parquet tables below ``sf_dir``."""
    if (sf_dir, name) in _stored:
        path, schema = _stored[(sf_dir, name)]
        return read_clustered(spark, path, schema)
    sql = with_fixtures(f"select * from {name}")
    for table in BASE_TABLES:
        if re.search(rf"\b(?:from|join) {table}\b", sql):
            rows = spark.read.parquet(f"{sf_dir}/{table}.parquet")
            if table == "lineitem":
                rows = spread_calls(rows)
            rows.createOrReplaceTempView(table)
    return spark.sql(sql)
