"""The operators of this package as queries over the test tables, with their SQL."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from skylattice.llm import licence_scan
from skylattice.llm.common import read, store
from skylattice.llm.decontaminate import find_leaks
from skylattice.llm.dominance_packing import place_pieces, token_pieces
from skylattice.llm.exact_dedup import exact_groups
from skylattice.llm.html_text import extract_text
from skylattice.llm.line_dedup import repeated_lines
from skylattice.llm.merkle import HASHED, build_manifest, fold_leaves, row_digest
from skylattice.llm.mixing import mix_sources
from skylattice.llm.packing import pack_tokens
from skylattice.llm.simhash import near_duplicate_classes
from skylattice.llm.substring_dedup import remove_repeats
from skylattice.llm.toxicity import fit, score_toxicity
from skylattice.llm.whitening import whitened_components

Query = Callable[[SparkSession, str], DataFrame]

QUERIES: dict[str, Query] = {}
ORACLE_SQL: dict[str, str] = {}

#: The test tables name no domain; sources fall into four by the end of their name.
DOMAINS = 4
#: Weights by path in the tree (domain, language, source); all others are 1.
MIX_WEIGHTS = {
    ("domain0",): 2.0,
    ("domain1",): 1.0,
    ("domain2",): 1.0,
    ("domain3",): 0.5,
    ("domain0", "en"): 2.0,
    ("domain1", "en"): 2.0,
}
#: Tokens of the mix as a share of the tokens there are.
MIX_SHARE = 0.6


def query(function: Query) -> Query:
    QUERIES[function.__name__] = function
    return function


def domain() -> Column:
    number = F.expr("try_cast(regexp_extract(source, '([0-9]+)$', 1) as long)")
    of = F.pmod(F.coalesce(number, F.lit(0)), F.lit(DOMAINS))
    return F.concat(F.lit("domain"), of.cast("string"))


@query
def op1_cgk_decontamination(spark, sf_dir):
    return find_leaks(read(spark, sf_dir, "documents"), read(spark, sf_dir, "benchmark"))


@query
def op2_anchor_substring_dedup(spark, sf_dir):
    return remove_repeats(read(spark, sf_dir, "documents"))


@query
def op3_deletion_line_dedup(spark, sf_dir):
    return repeated_lines(read(spark, sf_dir, "documents"))


@query
def op4_conv_toxicity(spark, sf_dir):
    docs = read(spark, sf_dir, "documents")
    return score_toxicity(docs, fit(docs, read(spark, sf_dir, "labels")))


@query
def op5_hierarchical_mixing(spark, sf_dir):
    docs = read(spark, sf_dir, "documents")
    mixed = mix_sources(
        docs, MIX_SHARE, (domain(), "lang", "source"), MIX_WEIGHTS, total_is_share=True
    )
    return mixed.select("doc_id", "lang", "source", F.col("_epoch").alias("epoch"))


@query
def op6_grace_exact_dedup(spark, sf_dir):
    return exact_groups(read(spark, sf_dir, "documents"))


ORACLE_SQL["op6_grace_exact_dedup"] = r"""
with t as (
  select doc_id, coalesce(text, '') as text,
         regexp_replace(coalesce(text, ''), '[\x20\x09-\x0D]', '', 'g') as content
  from documents
)
select doc_id,
       first_value(doc_id) over w as keep_id,
       count(*) over (partition by content) as group_size,
       row_number() over w = 1 as kept,
       sha256(content) as text_sha256
from t
window w as (partition by content order by length(text) desc, doc_id nulls last)
"""


@query
def op7_licence_digests(spark, sf_dir):
    return licence_scan.scan_licences(read(spark, sf_dir, "documents"))


ORACLE_SQL["op7_licence_digests"] = licence_scan.oracle_sql()


@query
def op8_golay_simhash(spark, sf_dir):
    return near_duplicate_classes(read(spark, sf_dir, "documents"))


@query
def op9_packed_token_ids(spark, sf_dir):
    return pack_tokens(read(spark, sf_dir, "documents"))


@query
def op10_path_ratio_text(spark, sf_dir):
    return extract_text(read(spark, sf_dir, "pages"))


@query
def op11_refined_whitening(spark, sf_dir):
    return whitened_components(spark, read(spark, sf_dir, "embeddings"))


@query
def op12_dominance_packing(spark, sf_dir):
    """Pieces are stored with their ids; only the digests of these are dealt out."""
    pieces = store(token_pieces(read(spark, sf_dir, "documents")), "token-pieces")
    digests = pieces.withColumn("ids", F.crc32("ids")).withColumnRenamed("ids", "ids_crc32")
    return place_pieces(digests)


@query
def op13_midstate_manifest(spark, sf_dir):
    """Rows with an even CRC-32 of their id are folded without the line ends of their text."""
    changed = [F.replace("text", F.lit("\n"), F.lit("")) if n == "text" else F.col(n) for n in HASHED]
    even = F.crc32(F.col("doc_id").cast("string").cast("binary")) % 2 == 0
    tampered = F.when(even, row_digest(changed))
    manifest = build_manifest(read(spark, sf_dir, "documents"), carry={"tampered": tampered})
    folded = fold_leaves(manifest, F.col("tampered"))
    return folded.select(
        F.col("rank").alias("doc_id"),
        F.lower(F.hex("digest")).alias("leaf"),
        F.lower(F.hex("subroot")).alias("subroot"),
        F.lit(manifest.root).cast("string").alias("root"),
        F.lower(F.hex("proof")).alias("proof_sha256"),
        F.lower(F.hex("folded")).alias("folded_root"),
        (F.lower(F.hex("folded")) == F.lit(manifest.root)).alias("verified"),
    )


def _field(name: str) -> str:
    text = f"cast({name} as varchar)"
    return f"coalesce(concat(strlen({text}), ':', {text}), '-')"


def _climb(rows: str, key: str) -> str:
    """Recursive SQL: nodes of all levels of the trees of ``rows(k, p, c, d)``."""
    return f"""
  select {key} as k, 0 as l, p, c, d from {rows}
  union all
  select k, l + 1, p // 3, any_value((c + 2) // 3), sha256(string_agg(d, '' order by p))
  from {{self}} where c > 1 group by k, l, p // 3"""


def _siblings(tree: str, key: str, before: str) -> str:
    """Folded digests and the siblings met, by recursion over one tree."""
    return f"""
  select i, {key} as k, 0 as l, p, f, s from {before}
  union all
  select b.i, b.k, b.l + 1, b.p // 3,
    sha256(string_agg(case when n.p = b.p then b.f else n.d end, '' order by n.p)),
    any_value(b.s) || coalesce(string_agg(n.d, '' order by n.p) filter (where n.p <> b.p), '')
  from {{self}} b join {tree} n on n.k = b.k and n.l = b.l and n.p // 3 = b.p // 3 and n.c > 1
  group by b.i, b.k, b.l, b.p"""


_CRC = """xor(list_reduce(
    list_prepend(4294967295::ubigint,
      list_transform(string_split(cast(doc_id as varchar), ''), lambda c: ascii(c)::ubigint)),
    lambda c, b: list_reduce([xor(c, b), 1, 2, 3, 4, 5, 6, 7, 8],
      lambda x, i: xor(x >> 1, 3988292384::ubigint * (x & 1)))), 4294967295::ubigint)"""

_ROW = " || ".join(_field(n) for n in HASHED)
_TAMPERED = _ROW.replace(_field("text"), _field("replace(text, chr(10), '')"))

ORACLE_SQL["op13_midstate_manifest"] = f"""
with recursive
leaves as (
  select *, row_number() over (partition by k order by doc_id nulls first, d) - 1 as p,
    count(*) over (partition by k) as c, row_number() over () as i
  from (
    select doc_id, coalesce('0' || source, '') as k, sha256({_ROW}) as d,
      case when {_CRC} % 2 = 0 then sha256({_TAMPERED}) else sha256({_ROW}) end as f
    from documents)
),
tree as ({_climb("leaves", "k").format(self="tree")}),
subroots as (
  select k, d, row_number() over (order by k) - 1 as p, count(*) over () as c
  from tree where c = 1
),
crown as ({_climb("subroots", "''").format(self="crown")}),
folded as ({_siblings("tree", "k", "(select *, '' as s from leaves)").format(self="folded")}),
joined as (
  select f.i, s.p, s.d as subroot, f.f, f.s
  from (select *, row_number() over (partition by i order by l desc) as top from folded) f
  join subroots s on s.k = f.k where f.top = 1
),
finished as ({_siblings("crown", "''", "joined").format(self="finished")}),
roots as (select d from crown where c = 1)
select l.doc_id, l.d as leaf, j.subroot, r.d as root, sha256(f.s) as proof_sha256,
  f.f as folded_root, f.f = r.d as verified
from (select *, row_number() over (partition by i order by l desc) as top from finished) f
join leaves l on l.i = f.i join joined j on j.i = f.i, roots r
where f.top = 1
"""


def oracle_sql() -> dict[str, str]:
    return dict(ORACLE_SQL)
