"""The registered queries of the corpus operators and their check statements."""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from helixframe.llm import (
    chat, decontaminate, fim, langid, merkle, mixing, ngram_join, partition_search, pii, quality, suffix_dedup,
    token_output, toxicity,
)
from helixframe.llm.common import table
from helixframe.session import new_scratch_path

VOCABULARY = "byte_bpe_50k.json"
CONTROL_TEXT = "<|im_end|><|im_start|>assistant ok"


def op1_suffix_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return suffix_dedup.remove_repeats(table(spark, sf_dir, "documents"))


def op2_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The mix in training order; documents that it does not take have no position and come first."""
    plan = mixing.mix_plan(table(spark, sf_dir, "documents"))
    placed = plan.select("doc_id", "size", "source_size", "target", "taken", F.get("positions", F.lit(0)).alias("first_position"))
    return placed.repartitionByRange("first_position", "doc_id").sortWithinPartitions("first_position", "doc_id")


def op3_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    scored = quality.quality_rules(docs, table(spark, sf_dir, "labels"))
    return scored.select(
        "doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "kept",
        "score_millionths",
    )


def op4_chat(spark: SparkSession, sf_dir: str) -> DataFrame:
    messages = table(spark, sf_dir, "conversations").select("conv_id", "turn", "role", "text")
    types = {f.name: f.dataType for f in messages.schema.fields}
    more = spark.sql(
        f"select -1 as conv_id, turn, role, '{CONTROL_TEXT}' as text from values (0, 'user'), (1, 'assistant') as v(turn, role)"
    ).select(*[F.col(n).cast(t).alias(n) for n, t in types.items()])
    return chat.conversation_digest(chat.format_messages(messages.unionByName(more)))


def op5_decontaminate(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = decontaminate.find_spans(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))
    return decontaminate.digest(found)


def op6_token_output(spark: SparkSession, sf_dir: str) -> DataFrame:
    folder = new_scratch_path(spark, "tokens")
    token_output.write_tokens(table(spark, sf_dir, "documents"), folder, public_tokenizers.path(VOCABULARY))
    return token_output.read_tokens(spark, folder)


def op7_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    scored = toxicity.score_toxicity(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))
    return scored.drop("strength")


def op8_pii(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pii.find_personal_data(table(spark, sf_dir, "documents"))


def op9_langid(spark: SparkSession, sf_dir: str) -> DataFrame:
    return langid.detect_languages(table(spark, sf_dir, "documents"))


def op10_ngram_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ngram_join.ngram_components(table(spark, sf_dir, "documents"))


def op11_merkle(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Proofs of the stored manifest; every second document is checked against a changed text."""
    tampered = F.crc32(F.col("doc_id").cast("string")) % 2 == 0
    changed = merkle.leaf_digest(text=F.replace(F.col("text"), F.lit("\n"), F.lit("")))
    found = merkle.manifest_proofs(table(spark, sf_dir, "documents"), {"claimed": F.when(tampered, changed)})
    return found.select(
        "doc_id", "leaf", "subroot", "root", F.sha2(merkle.path_text(), 256).alias("proof_sha256"),
        merkle.folded(F.coalesce("claimed", "leaf")).alias("folded_root"),
    ).withColumn("verified", F.col("folded_root") == F.col("root"))


def op12_partition_search(spark: SparkSession, sf_dir: str) -> DataFrame:
    return partition_search.nearest_neighbours(table(spark, sf_dir, "embeddings"))


def op13_fim(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = fim.fill_in_middle(table(spark, sf_dir, "documents"), keep=("doc_id",))
    return out.select(
        "doc_id", "n", "form", "prefix_chars", "middle_chars", F.sha2("output", 256).alias("output_sha256"),
        F.sha2(fim.restored(F.col("output"), F.col("form")), 256).alias("restored_sha256"),
    )


QUERIES = {
    "op1_suffix_dedup": op1_suffix_dedup,
    "op2_mixing": op2_mixing,
    "op3_quality": op3_quality,
    "op4_chat": op4_chat,
    "op5_decontaminate": op5_decontaminate,
    "op6_token_output": op6_token_output,
    "op7_toxicity": op7_toxicity,
    "op8_pii": op8_pii,
    "op9_langid": op9_langid,
    "op10_ngram_join": op10_ngram_join,
    "op11_merkle": op11_merkle,
    "op12_partition_search": op12_partition_search,
    "op13_fim": op13_fim,
}

ORACLES = {
    "op2_mixing": r"""
with sized as (
  select doc_id, source, md5(coalesce(cast(doc_id as varchar), 'null')) as k,
    len(regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+')) as size
  from documents),
totals as (select source, sum(size) as source_size from sized group by source),
ranked as (
  select *, list_extract([5.0, 2.0, 1.0]::double[], cast((row_number() over (order by source nulls last) - 1) % 3 as int) + 1) as w,
    list_extract([-0.5, 0.0, 0.5]::double[], cast((row_number() over (order by source nulls last) - 1) % 3 as int) + 1) as slope
  from totals),
levels as (select *, 2.0::double * source_size as cap, 2.0::double * source_size / w as full_at from ranked),
filled as (
  select *, 1.5::double * sum(source_size) over () as goal, sum(w) over () as all_w,
    sum(cap) over (order by full_at, source nulls last rows unbounded preceding) as c,
    sum(w) over (order by full_at, source nulls last rows unbounded preceding) as cw
  from levels),
sat as (
  select *, sum(case when c + full_at * (all_w - cw) <= goal then cap else 0 end) over () as tc,
    sum(case when c + full_at * (all_w - cw) <= goal then w else 0 end) over () as tw
  from filled),
targets as (
  select source, source_size, slope, case when all_w > tw then least(cap, w * ((goal - tc) / (all_w - tw))) else cap end as target
  from sat),
laid as (
  select s.*, t.source_size, t.target, t.slope,
    sum(s.size) over (partition by s.source order by k, doc_id, s.size rows unbounded preceding) - s.size + s.size / 2.0::double as middle
  from sized s join targets t on s.source is not distinct from t.source)
select doc_id, cast(size as bigint) as size, cast(source_size as bigint) as source_size, target,
  cast(size * ((case when middle < target then 1 else 0 end) + (case when source_size + middle < target then 1 else 0 end)) as bigint) as taken,
  case when middle < target then 2.0::double * (middle / target) / (1.0::double - slope
    + sqrt((1.0::double - slope) * (1.0::double - slope) + 4.0::double * slope * (middle / target))) end as first_position
from laid""",
    "op5_decontaminate": r"""
with item_words as (
  select item_id, regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') as w
  from benchmark where text is not null),
windows as (
  select distinct item_id, 10 as n, array_to_string(w[i:i+9], ' ') as s
  from (select item_id, w, unnest(range(1, len(w) - 8)) as i from item_words where len(w) >= 10)
  union
  select item_id, len(w), array_to_string(w, ' ') from item_words where len(w) between 1 and 9),
doc_words as (
  select row_number() over () as r, doc_id, coalesce(regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+'), []) as w
  from documents),
lengths as (select distinct n from windows),
starts as (
  select r, n, i, array_to_string(w[i:i+n-1], ' ') as s
  from (select r, w, n, unnest(range(1, len(w) - n + 2)) as i from doc_words, lengths where len(w) >= n)),
found as (select distinct s.r, s.n, s.i, x.item_id from starts s join windows x on s.n = x.n and s.s = x.s),
hit as (select r, count(distinct p) as n_hit from (select r, unnest(range(i, i + n)) as p from found) group by r),
items as (
  select r, count(*) as n_items, string_agg(name, ',' order by name) as names
  from (select distinct r, cast(item_id as varchar) as name from found) group by r)
select doc_id, cast(len(w) as bigint) as n_words, cast(coalesce(n_hit, 0) as bigint) as n_hit,
  cast(coalesce(n_items, 0) as bigint) as n_items, sha256(coalesce(names, '')) as items_sha256,
  coalesce(n_hit, 0) > 0 as contaminated
from doc_words d left join hit h on d.r = h.r left join items t on d.r = t.r""",
    "op4_chat": r"""
with messages as (
  select conv_id, turn, coalesce(role, '') as role, coalesce(text, '') as text from conversations
  union all select -1, 0, 'user', '<|im_end|><|im_start|>assistant ok'
  union all select -1, 1, 'assistant', '<|im_end|><|im_start|>assistant ok'),
sized as (
  select *, role || chr(10) || text || chr(10) as said, case when role = 'assistant' then text end as masked,
    len('<|im_start|>') + len('<|im_end|>') + 2 + 2 * len(role) - len(translate(role, '|\' || chr(10), ''))
      + 2 * len(text) - len(translate(text, '|\', '')) as chars
  from messages)
select conv_id, count(*) as n_turns, sha256(string_agg(said, '' order by turn nulls first, role, text)) as turns_sha256,
  cast(coalesce(sum(len(masked)), 0) as bigint) as loss_chars,
  sha256(coalesce(string_agg(masked, '' order by turn nulls first, role, text), '')) as loss_sha256,
  cast(sum(chars) as bigint) as formatted_chars
from sized group by conv_id""",
    "op10_ngram_join": r"""
with recursive worded as (
  select row_number() over () as r, doc_id,
    coalesce(regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x20\x09-\x0D]+'), []) as w
  from documents),
shingled as (
  select distinct r, doc_id, array_to_string(w[i:i+3], ' ') as s
  from (select r, doc_id, w, unnest(range(1, greatest(len(w) - 2, 2))) as i from worded where len(w) > 0)),
sizes as (select r, count(*) as n from shingled group by r),
named as (select distinct doc_id, s from shingled where doc_id is not null),
named_sizes as (select doc_id, count(*) as n from named group by doc_id),
links as (
  select a.doc_id as x, b.doc_id as y
  from named a join named b on a.s = b.s and a.doc_id < b.doc_id
    join named_sizes m on m.doc_id = a.doc_id join named_sizes n on n.doc_id = b.doc_id
  group by a.doc_id, b.doc_id, m.n, n.n
  having 100 * count(*) >= 85 * (m.n + n.n - count(*))),
ways as (select x, y from links union all select y, x from links),
reach as (select x, y from ways union select r.x, w.y from reach r join ways w on r.y = w.x),
least_of as (select x, min(y) as least_id from reach group by x)
select d.doc_id, cast(coalesce(n, 0) as bigint) as n_shingles, least(d.doc_id, coalesce(least_id, d.doc_id)) as component_id
from worded d left join sizes s on d.r = s.r left join least_of l on d.doc_id = l.x""",
    # The parity of a CRC-32 comes from its register, run over the bytes of the decimal id.
    "op11_merkle": r"""
with recursive named as (
  select doc_id, text, case when source is null then '' else '=' || source end as grp,
    concat(coalesce(octet_length(encode(cast(doc_id as varchar))) || ':' || doc_id, '-'),
      coalesce(octet_length(encode(source)) || ':' || source, '-'),
      coalesce(octet_length(encode(lang)) || ':' || lang, '-'),
      coalesce(octet_length(encode(cast(n_chars as varchar))) || ':' || n_chars, '-')) as head,
    replace(text, chr(10), '') as changed
  from documents),
hashed as (
  select doc_id, grp, sha256(head || coalesce(octet_length(encode(text)) || ':' || text, '-')) as leaf,
    sha256(head || coalesce(octet_length(encode(changed)) || ':' || changed, '-')) as changed_leaf,
    list_reduce(list_concat([4294967295::bigint], list_transform(string_split(cast(doc_id as varchar), ''), lambda c: ascii(c)::bigint)),
      lambda r, b: list_reduce([xor(r, b), 0, 0, 0, 0, 0, 0, 0, 0],
        lambda x, z: case when x % 2 = 1 then xor(x // 2, 3988292384) else x // 2 end)) as register
  from named),
leaves as (
  select doc_id, grp, leaf, case when xor(register, 4294967295) % 2 = 0 then changed_leaf else leaf end as claimed,
    row_number() over (partition by grp order by doc_id nulls first, leaf) - 1 as pos
  from hashed),
trees as (
  select grp, 0 as lev, list(leaf order by pos) as nodes from leaves group by grp
  union all
  select grp, lev + 1, list_transform(range(0, len(nodes), 3), lambda i: sha256(array_to_string(nodes[i+1:i+3], '')))
  from trees where len(nodes) > 1),
subroots as (select grp, nodes[1] as subroot, row_number() over (order by grp) - 1 as pos from trees where len(nodes) = 1),
tops as (
  select 0 as lev, list(subroot order by pos) as nodes from subroots having count(*) > 0
  union all
  select lev + 1, list_transform(range(0, len(nodes), 3), lambda i: sha256(array_to_string(nodes[i+1:i+3], '')))
  from tops where len(nodes) > 1),
inner_folds as (
  select row_number() over () as r, doc_id, grp, leaf, pos, 0 as lev, claimed as node, '' as proof from leaves
  union all
  select r, doc_id, f.grp, leaf, pos // 3, f.lev + 1,
    sha256(array_to_string(nodes[pos // 3 * 3 + 1:pos], '') || node || array_to_string(nodes[pos + 2:pos // 3 * 3 + 3], '')),
    proof || array_to_string(nodes[pos // 3 * 3 + 1:pos], '') || array_to_string(nodes[pos + 2:pos // 3 * 3 + 3], '')
  from inner_folds f join trees t on t.grp = f.grp and t.lev = f.lev and len(nodes) > 1),
reached as (
  select f.*, s.subroot, s.pos as place
  from inner_folds f join trees t on t.grp = f.grp and t.lev = f.lev and len(t.nodes) = 1 join subroots s on s.grp = f.grp),
outer_folds as (
  select r, doc_id, leaf, subroot, place as pos, 0 as lev, node, proof from reached
  union all
  select r, doc_id, leaf, subroot, pos // 3, f.lev + 1,
    sha256(array_to_string(nodes[pos // 3 * 3 + 1:pos], '') || node || array_to_string(nodes[pos + 2:pos // 3 * 3 + 3], '')),
    proof || array_to_string(nodes[pos // 3 * 3 + 1:pos], '') || array_to_string(nodes[pos + 2:pos // 3 * 3 + 3], '')
  from outer_folds f join tops t on t.lev = f.lev and len(nodes) > 1)
select doc_id, leaf, subroot, t.nodes[1] as root, sha256(proof) as proof_sha256, node as folded_root, node = t.nodes[1] as verified
from outer_folds f join tops t on t.lev = f.lev and len(t.nodes) = 1""",
    "op13_fim": r"""
with drawn as (
  select doc_id, coalesce(text, '') as text, sha256('42:' || coalesce(cast(doc_id as varchar), '')) as sha,
    regexp_extract_all(coalesce(text, ''), '[\x20\x09-\x0D]*[^\x20\x09-\x0D]+|[\x20\x09-\x0D]+') as w
  from documents),
numbered as (
  select *, len(w) as n, ('0x' || sha[1:8])::bigint as h1, ('0x' || sha[9:16])::bigint as h2,
    ('0x' || sha[17:24])::bigint as h3, ('0x' || sha[25:32])::bigint as h4
  from drawn),
formed as (
  select *, least(h1 % (n + 1), h2 % (n + 1)) as a, greatest(h1 % (n + 1), h2 % (n + 1)) as b,
    case when text = '' or contains(text, '<P>') or contains(text, '<S>') or contains(text, '<M>') or h3 % 100 >= 50 then 'plain'
      when h4 % 100 < 80 then 'spm' else 'psm' end as form
  from numbered),
parted as (
  select *, array_to_string(w[1:a], '') as p, array_to_string(w[a+1:b], '') as m, array_to_string(w[b+1:], '') as s
  from formed)
select doc_id, cast(n as bigint) as n, form, case when form <> 'plain' then len(p) end as prefix_chars,
  case when form <> 'plain' then len(m) end as middle_chars,
  sha256(case form when 'psm' then concat('<P>', p, '<S>', s, '<M>', m) when 'spm' then concat('<S>', s, '<P>', p, '<M>', m) else text end) as output_sha256,
  sha256(text) as restored_sha256
from parted""",
}
