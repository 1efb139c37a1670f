"""One query per operator, with production parameters, over whole tables."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from lettora.llm.conversation_repair import repaired_conversations
from lettora.llm.decontamination import benchmark_leaks
from lettora.llm.html_text import extract_text
from lettora.llm.line_dedup import dedup_lines
from lettora.llm.mixing import mix, words_taken
from lettora.llm.pii import personal_data
from lettora.llm.quality_knn import quality_scores
from lettora.llm.quality_rules import COUNTS, quality_verdicts
from lettora.llm.repeat_removal import repeat_digest
from lettora.llm.secret_scan import KEYWORDS, secret_digest
from lettora.llm.simhash import simhash_components
from lettora.llm.tables import table
from lettora.llm.token_alignment import token_alignment
from lettora.llm.warc import archive_round_trip

LLM_QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
LLM_ORACLE: dict[str, str] = {}


def query(function: Callable[[SparkSession, str], DataFrame]) -> Callable[[SparkSession, str], DataFrame]:
    LLM_QUERIES[function.__name__] = function
    return function


@query
def op1_simhash_near_dedup(spark: SparkSession, folder: str) -> DataFrame:
    return simhash_components(table(spark, folder, "documents"))


@query
def op2_quality_rules(spark: SparkSession, folder: str) -> DataFrame:
    judged = quality_verdicts(table(spark, folder, "documents"), table(spark, folder, "labels"))
    return judged.select("doc_id", *COUNTS, "base_failed", "kept", "anomaly")


@query
def op8_quality_classifier(spark: SparkSession, folder: str) -> DataFrame:
    return quality_scores(table(spark, folder, "documents"), table(spark, folder, "labels"))


@query
def op9_line_dedup(spark: SparkSession, folder: str) -> DataFrame:
    cut = dedup_lines(table(spark, folder, "documents"))
    return cut.select("row.doc_id", "n_lines", "n_dropped", F.sha2("text", 256).alias("kept_sha256"))


LLM_ORACLE["op9_line_dedup"] = """
with split as (
  select doc_id, string_split(coalesce(text, ''), chr(10)) as parts from documents
), lines as (
  select doc_id, unnest(parts) as line, generate_subscripts(parts, 1) as pos from split
), keyed as (
  select doc_id, line, pos, translate(trim(line, concat(' ', chr(9), chr(10), chr(11), chr(12), chr(13))),
    'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') as line_key
  from lines
), shared as (
  select line_key, max(doc_id) as keeper from keyed where length(line_key) >= 40
  group by line_key having count(distinct doc_id) >= 5
), marked as (
  select k.doc_id, k.line, k.pos, s.line_key is not null and k.doc_id <> s.keeper as gone
  from keyed k left join shared s on k.line_key = s.line_key
)
select doc_id, count(*) as n_lines, count(*) filter (where gone) as n_dropped,
  sha256(coalesce(string_agg(line, chr(10) order by pos) filter (where not gone), '')) as kept_sha256
from marked group by doc_id
"""


@query
def op7_benchmark_decontamination(spark: SparkSession, folder: str) -> DataFrame:
    return benchmark_leaks(table(spark, folder, "documents"), table(spark, folder, "benchmark")).drop("text_hash")


@query
def op3_mix_sources(spark: SparkSession, folder: str) -> DataFrame:
    taken = words_taken(mix(table(spark, folder, "documents")))
    return taken.select("doc_id", "size", "source_size", "target", "taken", "source")


@query
def op5_warc(spark: SparkSession, folder: str) -> DataFrame:
    return archive_round_trip(table(spark, folder, "pages")).drop("url")


LLM_ORACLE["op5_warc"] = """
with sized as (
  select page_id, coalesce(html, '') as payload, strlen(coalesce(html, '')) as payload_bytes from pages
), kept as (
  select *, case when payload_bytes >= 1000 then max(page_id) over (partition by payload) end as keeper from sized
)
select page_id, payload_bytes, sha1(payload) as payload_digest,
  case when keeper <> page_id then 'revisit' else 'response' end as record_type,
  case when keeper <> page_id then keeper end as refers_to
from kept
"""


@query
def op6_html_text(spark: SparkSession, folder: str) -> DataFrame:
    return extract_text(table(spark, folder, "pages"))


@query
def op4_secret_scan(spark: SparkSession, folder: str) -> DataFrame:
    return secret_digest(table(spark, folder, "documents"))


@query
def op11_token_alignment(spark: SparkSession, folder: str) -> DataFrame:
    return token_alignment(table(spark, folder, "documents"))


@query
def op12_conversation_repair(spark: SparkSession, folder: str) -> DataFrame:
    return repaired_conversations(table(spark, folder, "conversations"))


@query
def op13_repeat_removal(spark: SparkSession, folder: str) -> DataFrame:
    return repeat_digest(table(spark, folder, "documents"))


@query
def op10_pii(spark: SparkSession, folder: str) -> DataFrame:
    return personal_data(table(spark, folder, "documents"))


_ASSIGN = rf"""(?:{KEYWORDS})["'']?\x20*[:=]\x20*["'']?([A-Za-z0-9+/_.=-]+)"""
_SECRETS = [
    ("assign", _ASSIGN, "length(regexp_extract(m, pattern, 1)) >= 12"),
    ("access", "AKIA[A-Z0-9]+", "length(m) >= 18"),
    ("hex", "[0-9a-f]+", "length(m) >= 16"),
    ("pem", "-----BEGIN [A-Z ]{0,40}PRIVATE KEY-----", "true"),
    ("bearer", "(?:gh[pousr]_|xox[abprs]-|glpat-)[A-Za-z0-9_-]{20,}", "true"),
]
LLM_ORACLE["op4_secret_scan"] = (
    "with matched as ("
    + " union all ".join(
        f"""select doc_id, '{kind}' as kind, {k} as rank, regexp_extract_all(coalesce(text, ''), '{pattern}') as ms,
        regexp_split_to_array(coalesce(text, ''), '{pattern}') as gaps from documents"""
        for k, (kind, pattern, _) in enumerate(_SECRETS)
    )
    + """), pieces as (
  select doc_id, kind, rank, unnest(ms) as m, unnest(gaps[1:len(ms)]) as gap, generate_subscripts(ms, 1) as i from matched
), placed as (
  select *, cast(sum(length(gap) + length(m)) over (partition by doc_id, kind order by i) as bigint) as span_end from pieces
), found as (
  select *, kind || ':' || (span_end - length(m)) || ':' || span_end as span, span_end - length(m) as span_start
  from placed where case kind """
    + " ".join(f"when '{kind}' then {test.replace('pattern', f"'{pattern}'")}" for kind, pattern, test in _SECRETS)
    + """ end
)
select d.doc_id, count(f.kind) filter (where f.kind = 'assign') as n_assign,
  count(f.kind) filter (where f.kind = 'access') as n_access, count(f.kind) filter (where f.kind = 'hex') as n_hex,
  sha256(coalesce(string_agg(f.span, ',' order by f.span_start, f.rank) filter (where f.rank < 3), '')) as base_sha256,
  coalesce(string_agg(f.span, ',' order by f.span_start, f.rank), '') as spans
from documents d left join found f on d.doc_id = f.doc_id group by d.doc_id
"""
)
