"""The library's operators applied to the driver's tables, each with the same result in DuckDB SQL.

The tables hold no filings, so domain rows are derived from them: orders stand for statements whose
lines are sums of their line items, documents for pages, events for runs and corrections.
"""

from __future__ import annotations

import hashlib
import uuid
from decimal import Decimal
from functools import reduce

import yaml
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from filingmill.functions import exprs, periods
from filingmill.operators import agreement, classify, corrections, facts, keywords, profile, publish, rawtables, realign, register, review, validate, views
from filingmill.sources import rulepack
from filingmill.sources.rulepack import Role, RulePack
from filingmill.sources.schemas import active_conflicts, conformed, orphans
from filingmill.sources.store import Lake, scratch_root

QUERIES: dict = {}
SQL: dict[str, str] = {}
EPOCH = "2026-01-01 00:00:00"
D = "decimal(38,6)"


def query(sql: str | None = None):
    def add(f):
        QUERIES[f.__name__] = f
        if sql:
            SQL[f.__name__] = sql
        return f

    return add


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def pack(market: str, roles=(), scopes=None, aliases=(), currencies=(), scales=(), periods=(), notes=()) -> RulePack:
    return RulePack(market, "query", tuple(roles), scopes or {}, tuple(aliases), tuple(currencies), tuple(scales), tuple(periods), tuple(notes), Decimal(2), Decimal("0.0001"), {})


# Registration and lifecycle ------------------------------------------------------------------------


@query("select sha256(text) as file_sha256, min(doc_id) as report_id, count(*) as copies from documents group by 1")
def q_dedup_hash(spark: SparkSession, sf_dir: str) -> DataFrame:
    files = register.content_hash(table(spark, sf_dir, "documents").select("doc_id", "text"), "text")
    return files.groupBy("file_sha256").agg(F.min("doc_id").alias("report_id"), F.count("*").alias("copies"))


@query("select min(doc_id) as doc_id, sha256(text) as file_sha256 from documents d where not exists (select 1 from benchmark b where sha256(b.text) = sha256(d.text)) group by 2")
def q_dedup_anti(spark: SparkSession, sf_dir: str) -> DataFrame:
    batch = register.content_hash(table(spark, sf_dir, "documents").select("doc_id", "text"), "text").select("doc_id", "file_sha256")
    known = register.content_hash(table(spark, sf_dir, "benchmark").select("text"), "text").select("file_sha256")
    return register.new_reports(batch, known, ["doc_id"]).select("doc_id", "file_sha256")


@query("select user_id, arg_max(event_type, (ts, event_id)) as status, max(event_id) filter (event_id = event_id) as last_event, count(*) as n_events from events group by 1".replace("max(event_id) filter (event_id = event_id)", "arg_max(event_id, (ts, event_id))"))
def q_latest_run(spark: SparkSession, sf_dir: str) -> DataFrame:
    last = register.latest_status(table(spark, sf_dir, "events").select("user_id", "ts", "event_id", "event_type"), "user_id", ["ts", "event_id"])
    return last.select("user_id", F.col("last.event_type").alias("status"), F.col("last.event_id").alias("last_event"), "n_events")


@query("select count(*) as n_orders, (select count(*) from orders o where not exists (select 1 from lineitem l where l.l_orderkey = o.o_orderkey)) as n_without_lines, (select count(*) from lineitem l where not exists (select 1 from orders o where l.l_orderkey = o.o_orderkey)) as n_orphans from orders")
def q_fk_orphans(spark: SparkSession, sf_dir: str) -> DataFrame:
    orders, lines = table(spark, sf_dir, "orders"), table(spark, sf_dir, "lineitem")
    empty = orphans(orders, "o_orderkey", lines.select("l_orderkey").distinct(), "l_orderkey")
    lost = orphans(lines, "l_orderkey", orders, "o_orderkey")
    names = ("n_orders", "n_without_lines", "n_orphans")
    counts = [df.select(*[F.lit(int(n == m)).cast("bigint").alias(m) for m in names]) for n, df in zip(names, (orders, empty, lost))]
    return counts[0].unionByName(counts[1]).unionByName(counts[2]).agg(*[F.coalesce(F.sum(n), F.lit(0)).alias(n) for n in names])


def _rulepack_sql() -> str:
    """The shipped aliases as VALUES, read from the files by plain means."""
    rows, fold = [], lambda t: " ".join(t.lower().split())
    for market in rulepack.MARKETS:
        files = [rulepack.RULES_ROOT / market / f"{f}.yml" for f in rulepack.FILES]
        version = hashlib.sha256(b"".join(f.name.encode() + b"\0" + f.read_bytes() + b"\0" for f in files)).hexdigest()
        held = yaml.safe_load(files[1].read_text(encoding="utf-8"))["concepts"]
        named = [(concept, str(a), rule["confidence"]) for concept, rule in held.items() for a in rule["aliases"]]
        for alias in dict.fromkeys(fold(a) for _, a, _ in named):
            claims = [(c, k) for c, a, k in named if fold(a) == alias]
            said = alias.replace("'", "''")
            rows.append(f"('{market}', '{said}', '{claims[0][0]}', {claims[0][1]}::double, 'concept_aliases.{claims[0][0]}', {len({c for c, _ in claims})}::int, '{version}')")
    return "select * from (values " + ", ".join(rows) + ") as t(market, alias, normalized_concept_id, mapping_confidence, mapping_rule_id, concepts, rule_pack_version)"


@query(f"""with p as ({_rulepack_sql()}), n as (select market, normalized_concept_id, alias, concepts, rule_pack_version, row_number() over (partition by market order by alias) - 1 as r, count(*) over (partition by market) as m from p where mapping_confidence > 0),
l as (select l_orderkey, l_linenumber, case l_orderkey % 3 when 0 then 'us' when 1 then 'hk' else 'a_share' end as market, l_partkey from lineitem)
select l.market, normalized_concept_id, rule_pack_version, count(*) as n_lines, max(concepts) as concepts from l join n on n.market = l.market and n.r = l_partkey % n.m group by 1, 2, 3""")
def q_rulepack(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Line items under the shipped packs' aliases, noisily written, mapped back to concepts by the packs."""
    packs = rulepack.load_all()
    aliases = rulepack.alias_table(spark, packs)
    ranked = aliases.withColumns({"r": F.row_number().over(Window.partitionBy("market").orderBy("alias")) - 1, "m": F.count("*").over(Window.partitionBy("market"))}).select("market", "r", "m", F.concat(F.lit("  "), F.upper("alias"), F.lit(" ")).alias("raw_label"))
    k = F.col("l_orderkey") % 3
    lines = table(spark, sf_dir, "lineitem").select(F.when(k == 0, "us").when(k == 1, "hk").otherwise("a_share").alias("market"), "l_partkey").alias("l")
    named = lines.join(F.broadcast(ranked), "market").where(F.col("l_partkey") % F.col("m") == F.col("r")).select("market", "raw_label")
    versions = spark.createDataFrame([(m, p.version) for m, p in packs.items()], "market string, rule_pack_version string")
    found = facts.concepts(named, aliases.where("mapping_confidence > 0")).join(F.broadcast(versions), "market")
    return found.groupBy("market", "normalized_concept_id", "rule_pack_version").agg(F.count("*").alias("n_lines"), F.max("concepts").alias("concepts"))


@query("select user_id as report_id, arg_max(event_id::varchar, (ts, event_id::varchar)) as extraction_run_id from events group by 1")
def q_latest_runs(spark: SparkSession, sf_dir: str) -> DataFrame:
    runs = table(spark, sf_dir, "events").select(F.col("user_id").alias("report_id"), F.col("event_id").cast("string").alias("extraction_run_id"), F.col("ts").alias("run_started_at"))
    return register.latest_runs(runs)


@query("select c_custkey::varchar as page_id, c_nationkey::varchar as report_id, case when c_nationkey % 3 = 0 then 2 else 1 end::int as page_number from customer where c_nationkey % 5 <> 4")
def q_lake_replace(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Pages of every nation, then those of each third again, then none for the nations of rest 4 by 5."""
    lake = Lake(spark, f"{scratch_root(spark)}/lake-{uuid.uuid4().hex}")
    lake.initialize()
    k = F.col("c_nationkey")
    pages = table(spark, sf_dir, "customer").select(F.col("c_custkey").cast("string").alias("page_id"), k.cast("string").alias("report_id"), F.lit(1).alias("page_number"), F.lit(0).alias("text_char_count"), F.lit(False).alias("has_statement_keywords"), "c_nationkey")
    nations = table(spark, sf_dir, "nation").select(F.col("n_nationkey").alias("c_nationkey"), F.col("n_nationkey").cast("string").alias("report_id"))
    lake.replace("pdf_pages", pages, nations)
    lake.replace("pdf_pages", pages.where(k % 3 == 0).withColumn("page_number", F.lit(2)), nations.where(k % 3 == 0))
    lake.replace("pdf_pages", pages.limit(0), nations.where(k % 5 == 4))
    return lake.read("pdf_pages").select("page_id", "report_id", "page_number")


@query("select o_orderkey::varchar as page_id, (o_custkey % 40)::varchar as report_id, case when o_custkey % 40 % 3 = 0 then 2 else 1 end::int as page_number from orders where o_custkey % 40 % 5 <> 4 and o_custkey % 40 in (0, 3, 5, 7, 9, 11)")
def q_lake_compacted(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Pages of forty reports, some replaced, compacted, some cleared; six reports read from the files of their buckets alone."""
    lake = Lake(spark, f"{scratch_root(spark)}/lake-{uuid.uuid4().hex}")
    lake.initialize()
    k = F.col("o_custkey") % 40
    pages = table(spark, sf_dir, "orders").select(F.col("o_orderkey").cast("string").alias("page_id"), k.cast("string").alias("report_id"), F.lit(1).alias("page_number"), F.lit(0).alias("text_char_count"), F.lit(False).alias("has_statement_keywords"), k.alias("k"))
    reports = spark.range(40).select(F.col("id").alias("k"), F.col("id").cast("string").alias("report_id"))
    lake.replace("pdf_pages", pages, reports)
    lake.replace("pdf_pages", pages.where("k % 3 = 0").withColumn("page_number", F.lit(2)), reports.where("k % 3 = 0"))
    lake.compact("pdf_pages")
    lake.replace("pdf_pages", pages.limit(0), reports.where("k % 5 = 4"))
    return lake.read("pdf_pages", ["0", "3", "5", "7", "9", "11"]).select("page_id", "report_id", "page_number")


# Profiles -----------------------------------------------------------------------------------------

KEYWORDS = {"en": ("the", "tion"), "de": ("und ", "ung"), "fr": ("est", "dans")}
DEFAULT = ("que", "ción")
_HIT = "case lang when 'en' then contains(lower(text), 'the') or contains(lower(text), 'tion') when 'de' then contains(lower(text), 'und ') or contains(lower(text), 'ung') when 'fr' then contains(lower(text), 'est') or contains(lower(text), 'dans') else contains(lower(text), 'que') or contains(lower(text), 'ción') end"
_PROFILE = rf"p as (select doc_id, source, lang, coalesce({_HIT}, false) as hit, regexp_replace(coalesce(text, ''), '^[\s\p{{Z}}]+|[\s\p{{Z}}]+$', '', 'g') as t from documents)"


def _profiles(spark: SparkSession, sf_dir: str) -> DataFrame:
    pages = table(spark, sf_dir, "documents").select("doc_id", "source", "lang", "text", F.lit(595.0).alias("width"), F.lit(842.0).alias("height"))
    return profile.page_profiles(pages, "text", "lang", KEYWORDS, DEFAULT)


@query(f"with {_PROFILE} select doc_id, length(t)::int as text_char_count, round(length(t) / (595.0::double * 842.0::double), 9) as text_density, hit as has_statement_keywords, md5(nullif(substring(t, 1, 1000), '')) as sample_md5 from p")
def q_page_profile(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _profiles(spark, sf_dir).select("doc_id", "text_char_count", F.round("text_density", 9).alias("text_density"), "has_statement_keywords", F.md5("page_text_sample").alias("sample_md5"))


@query(f"with {_PROFILE} select source, count(*) as page_count, count(*) filter (hit) as keyword_page_count, bool_or(length(t) > 0) as is_text_pdf, case when not bool_or(length(t) > 0) then 'no_text_layer' end as unsupported_reason from p group by 1")
def q_report_profile(spark: SparkSession, sf_dir: str) -> DataFrame:
    return profile.report_profiles(_profiles(spark, sf_dir), "source")


@query(r"select page_id, nullif(regexp_replace(regexp_extract(html, '<title>([^<]*)', 1), '^[\s\p{Z}]+|[\s\p{Z}]+$', '', 'g'), '') as title from pages")
def q_html_title(spark: SparkSession, sf_dir: str) -> DataFrame:
    title = F.regexp_extract("html", "<title>([^<]*)", 1)
    return table(spark, sf_dir, "pages").select("page_id", exprs.or_null(exprs.strip(title)).alias("title"))


# Grids --------------------------------------------------------------------------------------------

_GRID = """rows as (select doc_id, unnest(string_split(text, chr(10))) as line, unnest(range(len(string_split(text, chr(10))))) as r from documents),
g as (select doc_id, r::int as row_index, (unnest(range(len(string_split(line, ' | ')))))::int as column_index, nullif(unnest(string_split(line, ' | ')), '') as raw_text from rows)"""


def _grid(spark: SparkSession, sf_dir: str) -> DataFrame:
    return rawtables.grid_cells(table(spark, sf_dir, "documents").select("doc_id", "text"), ["doc_id"], "text")


@query(rf"with {_GRID} select doc_id, row_index, column_index, raw_text, nullif(trim(regexp_replace(raw_text, '[\s\p{{Z}}]+', ' ', 'g')), '') as normalized_text, row_index = 0 as is_header_candidate from g")
def q_grid_cells(spark: SparkSession, sf_dir: str) -> DataFrame:
    cells = rawtables.raw_cell_columns(_grid(spark, sf_dir).withColumn("raw_table_id", F.col("doc_id")))
    return cells.select("doc_id", "row_index", "column_index", "raw_text", "normalized_text", "is_header_candidate")


@query(f"with {_GRID} select doc_id, max(row_index) + 1 as row_count, max(column_index) + 1 as column_count from g group by 1")
def q_grid_size(spark: SparkSession, sf_dir: str) -> DataFrame:
    return rawtables.grid_size(_grid(spark, sf_dir), ["doc_id"])


@query(
    f"""with {_GRID}, w as (select doc_id, max(column_index) as w, max(row_index) as h from g group by 1),
    d as (select doc_id, unnest(range(h + 1)) as row_index, w from w), e as (select doc_id, row_index, unnest(range(w + 1)) as column_index from d),
    l as (select e.doc_id, e.row_index, string_agg(coalesce(g.raw_text, ''), chr(9) order by e.column_index) as line from e left join g on e.doc_id = g.doc_id and e.row_index = g.row_index and e.column_index = g.column_index group by 1, 2)
    select doc_id, md5(string_agg(line, chr(10) order by row_index)) as text_md5 from l group by 1"""
)
def q_grid_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    cells = _grid(spark, sf_dir).withColumn("emit_order", F.lit(0))
    return rawtables.table_text(cells, ["doc_id"]).select("doc_id", F.md5("raw_table_text").alias("text_md5"))


@query(f"with {_GRID} select doc_id, row_index, count(raw_text) as n_cells, md5(coalesce(string_agg(column_index || '=' || raw_text, chr(31) order by column_index), '')) as cells_md5 from g group by 1, 2")
def q_display_pivot(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every cell of every document in its row's display map, shown as a digest."""
    shown = review.display_cells(_grid(spark, sf_dir), ["doc_id"])
    cells = F.transform(F.array_sort(F.map_entries("display")), lambda x: F.concat(x["key"].cast("string"), F.lit("="), x["value"]))
    return shown.select("doc_id", "row_index", F.size("display").cast("bigint").alias("n_cells"), F.md5(F.array_join(cells, "\x1f")).alias("cells_md5"))


@query(
    r"""with c as (select conv_id, string_agg(text, chr(10) order by turn, role) as lines from conversations where text is not null group by 1)
    select conv_id, md5(concat_ws(chr(10), nullif(nullif(substring(regexp_replace(coalesce(d.text, ''), '^[\s\p{Z}]+|[\s\p{Z}]+$', '', 'g'), 1, 1000), ''), null), nullif(lines, ''))) as evidence_md5 from c left join documents d on d.doc_id = c.conv_id"""
)
def q_evidence_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    turns = table(spark, sf_dir, "conversations").select("conv_id", F.col("turn").alias("row_index"), F.col("role").alias("column_index"), F.col("text").alias("raw_text"))
    lines = rawtables.cell_lines(turns, ["conv_id"]).withColumn("raw_table_text", F.lit(None).cast("string"))
    sample = table(spark, sf_dir, "documents").select(F.col("doc_id").alias("conv_id"), exprs.or_null(F.substring(exprs.strip("text"), 1, profile.SAMPLE_CHARS)).alias("page_text_sample"))
    return lines.join(sample, "conv_id", "left").select("conv_id", F.md5(classify.evidence()).alias("evidence_md5"))


# Classification -----------------------------------------------------------------------------------

ROLES = (
    Role("statement.balance_sheet", ("erth", "ung"), ("the erth", "ungen"), ("###",)),
    Role("statement.income_statement", ("tion",), ("tion tion", "ation"), ("!!",)),
    Role("statement.cash_flow", ("que",), ("de que",), ()),
)
NOTES = (Role("note.revenue_by_product", ("thing", "ment"), (), ()), Role("note.revenue_by_region", ("ander", "oire"), (), ()))
SCOPES = {"parent": ("company", " wh "), "consolidated": ("the", "der")}
DOC_PACKS = {m: pack(m, ROLES, SCOPES, notes=NOTES) for m in ("en", "fr", "de")}


def _hit(words) -> str:
    return "(" + (" or ".join(f"contains(t, '{w}')" for w in words) or "false") + ")"


def _role_case(roles, confidences=True) -> tuple[str, str, str]:
    order = [(r, "prefer", 0.95) for r in roles] + [(r, "include", 0.85) for r in roles]
    arms = [(f"{_hit(getattr(r, k))} and not {_hit(r.exclude)}", r.name, c, k) for r, k, c in order if getattr(r, k)]
    case = lambda value, other: "case " + " ".join(f"when known and {cond} then {value(n, c, k)}" for cond, n, c, k in arms) + f" else {other} end"
    return case(lambda n, c, k: f"'{n}'", "'unknown'"), case(lambda n, c, k: f"{c}::double", "0.0::double"), case(lambda n, c, k: f"'%s.{n}.{k}'", "null")


_ROLE, _CONFIDENCE, _RULE = _role_case(ROLES)
_CLASSIFIED = f"""t as (select doc_id, lang, source, lower(text) as t, lang in ('en', 'fr', 'de') as known from documents),
c as (select doc_id, lang, source, {_ROLE} as table_role, {_CONFIDENCE} as classification_confidence, {_RULE.replace('%s', 'table_titles')} as classification_rule_id,
case when known and {_hit(SCOPES['parent'])} then 'parent' when known and {_hit(SCOPES['consolidated'])} then 'consolidated' else 'unknown' end as statement_scope from t),
k as (select *, classification_confidence < 0.95 or statement_scope <> 'consolidated' as requires_review from c)"""


def _classified(spark: SparkSession, sf_dir: str) -> DataFrame:
    return classify.classified(table(spark, sf_dir, "documents").select("doc_id", "lang", "source", "text"), DOC_PACKS, F.col("text"), "lang")


@query(f"with {_CLASSIFIED} select doc_id, table_role, statement_scope, classification_confidence, classification_rule_id, requires_review from k")
def q_classify(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _classified(spark, sf_dir).select("doc_id", "table_role", "statement_scope", "classification_confidence", "classification_rule_id", "requires_review")


@query(f"with {_CLASSIFIED} select doc_id, table_role, statement_scope, classification_confidence, classification_rule_id, requires_review from k")
def q_classify_indexed(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The same classes by the index of keywords."""
    rows = table(spark, sf_dir, "documents").select("doc_id", F.col("lang").alias("market"), "source", "text")
    found = classify.classified(rows, DOC_PACKS, F.col("text"), indexed=["doc_id"])
    return found.select("doc_id", "table_role", "statement_scope", "classification_confidence", "classification_rule_id", "requires_review")


# The words that stand fifth in the texts are the keywords.
_FIFTH = r"select doc_id, 'm' || (doc_id % 3) as market, lower(text) as t, lower(regexp_extract(text, '^(?:[^ ]* ){4}([^ ]{2,})', 1)) as w from documents"


@query(f"with d as ({_FIFTH}), k as (select distinct market, w from d where w <> '') select d.doc_id, k.w as keyword from d join k on d.market = k.market and contains(d.t, k.w)")
def q_keyword_index(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Hundreds of keywords, one from each document, found in all documents of their market."""
    docs = table(spark, sf_dir, "documents").select("doc_id", F.concat(F.lit("m"), (F.col("doc_id") % 3).cast("string")).alias("market"), F.lower("text").alias("text"), F.lower(F.regexp_extract("text", "^(?:[^ ]* ){4}([^ ]{2,})", 1)).alias("keyword"))
    return keywords.keyword_hits(docs.select("doc_id", "market", "text"), docs.select("market", "keyword"), ["doc_id"]).select("doc_id", "keyword")


@query(f"with {_CLASSIFIED} select table_role, statement_scope, count(*) as classified_count, count(*) filter (requires_review) as review_required_count from k group by 1, 2")
def q_classify_summary(spark: SparkSession, sf_dir: str) -> DataFrame:
    return classify.summary(_classified(spark, sf_dir), ["table_role", "statement_scope"])


_NOTE = _role_case(NOTES)


@query(f"with t as (select doc_id, lower(text) as t, lang in ('en', 'fr', 'de') as known from documents) select doc_id, {_NOTE[0]} as note_role, {_NOTE[1]} as note_confidence, {_NOTE[2].replace('%s', 'note_roles')} as note_rule_id from t")
def q_note_roles(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = classify.note_roles(table(spark, sf_dir, "documents").select("doc_id", "lang", "text"), DOC_PACKS, F.col("text"), "lang")
    return rows.select("doc_id", "note_role", "note_confidence", "note_rule_id")


# Concepts, units, numbers -------------------------------------------------------------------------

PART_ALIASES = [("red", "total_assets", 0.99), ("blue widget", "total_equity", 0.99), ("small ring", "revenue", 0.98), ("red widget", "total_liabilities", 0.9), ("blue bolt", "net_profit", 0.98)]


@query(
    """with p as (select p_partkey, case p_partkey % 3 when 0 then '  ' || upper(p_name) || ' ' when 1 then replace(p_name, ' ', '   ') else p_name end as raw_label from part),
    a(alias, normalized_concept_id, mapping_confidence) as (values """
    + ", ".join(f"('{a}', '{c}', {k}::double)" for a, c, k in PART_ALIASES)
    + r""") select p_partkey, raw_label, normalized_concept_id, mapping_confidence, 'concept_aliases.' || normalized_concept_id as mapping_rule_id from p join a on trim(regexp_replace(lower(raw_label), '[\s\p{Z}]+', ' ', 'g')) = alias"""
)
def q_concept_map(spark: SparkSession, sf_dir: str) -> DataFrame:
    own = {"parts": pack("parts", aliases=[(i, c, a, k) for i, (a, c, k) in enumerate(PART_ALIASES)])}
    noisy = F.when(F.col("p_partkey") % 3 == 0, F.concat(F.lit("  "), F.upper("p_name"), F.lit(" "))).when(F.col("p_partkey") % 3 == 1, F.replace("p_name", F.lit(" "), F.lit("   "))).otherwise(F.col("p_name"))
    rows = table(spark, sf_dir, "part").select("p_partkey", noisy.alias("raw_label"), F.lit("parts").alias("market"))
    return facts.concepts(rows, rulepack.alias_table(spark, own)).select("p_partkey", "raw_label", "normalized_concept_id", "mapping_confidence", "mapping_rule_id")


@query(
    """with l as (select distinct trim(lower(p_name)) as label from part), a(alias, normalized_concept_id) as (values ('smal ring', 'revenue'), ('red widgets', 'total_assets'), ('blue nut', 'total_equity'))
    select label, alias, normalized_concept_id, levenshtein(label, alias)::int as edits from l, a where levenshtein(label, alias) between 1 and 2"""
)
def q_fuzzy_candidates(spark: SparkSession, sf_dir: str) -> DataFrame:
    own = {"parts": pack("parts", aliases=[(0, "revenue", "smal ring", 0.9), (1, "total_assets", "red widgets", 0.9), (2, "total_equity", "blue nut", 0.9)])}
    rows = table(spark, sf_dir, "part").select(F.col("p_name").alias("raw_label"), F.lit("parts").alias("market"))
    return facts.candidates(rows, rulepack.alias_table(spark, own), "raw_label").select("label", "alias", "normalized_concept_id", "edits")


@query(
    """with l as (select trim(lower(p_name)) as label, count(*) as n_rows from part group by 1), a(alias, normalized_concept_id) as (values ('smal ring', 'revenue'), ('red widgets', 'total_assets'), ('blue nut', 'total_equity'), ('red gizmo', 'revenue')),
     o as (select * from l where label not in (select alias from a))
    select label, n_rows, coalesce(string_agg(levenshtein(label, alias) || ' ' || alias || ' ' || normalized_concept_id, '; ' order by levenshtein(label, alias), alias), '') as candidates
    from o left join a on levenshtein(label, alias) between 1 and 2 group by 1, 2"""
)
def q_alias_suggestions(spark: SparkSession, sf_dir: str) -> DataFrame:
    own = {"parts": pack("parts", aliases=[(0, "revenue", "smal ring", 0.9), (1, "total_assets", "red widgets", 0.9), (2, "total_equity", "blue nut", 0.9), (3, "revenue", "red gizmo", 0.9)])}
    rows = table(spark, sf_dir, "part").select(F.col("p_name").alias("raw_label"), F.lit("parts").alias("market"))
    said = F.transform("candidates", lambda c: F.concat_ws(" ", c["edits"].cast("string"), c["alias"], c["normalized_concept_id"]))
    return facts.suggestions(rows, rulepack.alias_table(spark, own)).select("label", "n_rows", F.array_join(said, "; ").alias("candidates"))


CURRENCIES = (("EUR", ("europe",)), ("USD", ("america", "us$")), ("CNY", ("asia",)))
SCALES = (("1", ("dollars",)), ("1000", ("in thousands", "us$ thousands")), ("1000000", ("million dollars",)))
UNIT_PACKS = {"world": pack("world", currencies=CURRENCIES, scales=SCALES)}
_CONTEXT = "select c_custkey, lower(r_name || ' ' || case c_custkey % 5 when 0 then 'dollars in thousands' when 1 then 'US$ thousands' when 2 then 'million dollars' when 3 then 'in thousands' else '' end) as t from customer join nation on c_nationkey = n_nationkey join region on n_regionkey = r_regionkey"


def _unit_context(spark: SparkSession, sf_dir: str) -> DataFrame:
    k = F.col("c_custkey") % 5
    said = F.when(k == 0, "dollars in thousands").when(k == 1, "US$ thousands").when(k == 2, "million dollars").when(k == 3, "in thousands").otherwise("")
    rows = table(spark, sf_dir, "customer").join(table(spark, sf_dir, "nation"), F.col("c_nationkey") == F.col("n_nationkey")).join(table(spark, sf_dir, "region"), F.col("n_regionkey") == F.col("r_regionkey"))
    return rows.select("c_custkey", "c_nationkey", "c_mktsegment", F.concat("r_name", F.lit(" "), said).alias("context"), F.lit("world").alias("market"))


def _first(groups, longest: bool, value: int) -> str:
    tries = [(g, p) for g, ps in groups for p in ps]
    if longest:
        tries.sort(key=lambda x: -len(x[1]))
    return "case " + " ".join(f"when contains(t, '{x[1]}') then '{x[value]}'" for x in tries) + " end"


def _units_sql(longest: bool) -> str:
    return f"""with x as ({_CONTEXT}), f as (select c_custkey, {_first(CURRENCIES, longest, 0)} as currency, {_first(CURRENCIES, longest, 1)} as cp, {_first(SCALES, longest, 0)} as s, {_first(SCALES, longest, 1)} as sp from x)
    select c_custkey, currency, s::{D} as scale_factor, case when contains(sp, cp) then sp else nullif(concat_ws(' ', cp, sp), '') end as raw_unit, case when cp is not null and sp is not null then 0.99::double else 0.0::double end as unit_confidence from f"""


def _units(spark: SparkSession, sf_dir: str, longest: bool) -> DataFrame:
    return _unit_context(spark, sf_dir).select("c_custkey", facts.units(F.col("context"), UNIT_PACKS, longest=longest).alias("u")).select("c_custkey", "u.*")


@query(_units_sql(False))
def q_units(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _units(spark, sf_dir, False)


@query(_units_sql(True))
def q_units_longest(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _units(spark, sf_dir, True)


@query(
    """with x as (select c_custkey, case when c_custkey % 3 = 0 then 'cell' end as cell, case when c_custkey % 2 = 0 then c_mktsegment end as tbl, n_name as page, 'report' as report from customer join nation on c_nationkey = n_nationkey)
    select c_custkey, coalesce(cell, tbl, page, report) as unit, coalesce(cell <> coalesce(cell, tbl, page, report), false) or coalesce(tbl <> coalesce(cell, tbl, page, report), false) as conflict from x"""
)
def q_unit_precedence(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = table(spark, sf_dir, "customer").join(table(spark, sf_dir, "nation"), F.col("c_nationkey") == F.col("n_nationkey"))
    rows = rows.select("c_custkey", F.when(F.col("c_custkey") % 3 == 0, "cell").alias("cell"), F.when(F.col("c_custkey") % 2 == 0, F.col("c_mktsegment")).alias("tbl"), F.col("n_name").alias("page"), F.lit("report").alias("report"))
    unit, _ = facts.nearest_unit(["cell", "tbl", "page", "report"])
    _, conflict = facts.nearest_unit(["cell", "tbl"])
    return rows.select("c_custkey", unit.alias("unit"), conflict.alias("conflict"))


_RAW = "case l_linenumber % 7 when 0 then format('{:,}', l_orderkey) || '.50' when 1 then '(' || l_orderkey || '.25)' when 2 then '-' when 3 then '' when 4 then l_quantity::int || '%' when 5 then ' Note ' || l_partkey || ' x' else '--' end"


@query(
    rf"""with r as (select l_orderkey, l_linenumber, l_partkey, l_suppkey, {_RAW} as raw_value from lineitem), s as (select *, replace(regexp_replace(raw_value, '^[\s\p{{Z}}]+|[\s\p{{Z}}]+$', '', 'g'), ',', '') as t from r),
    u as (select *, case when starts_with(t, '(') and ends_with(t, ')') then '-' || t[2:-2] else t end as n from s)
    select l_orderkey, l_linenumber, l_partkey, l_suppkey, raw_value, case when t not in ('', '-', '--') then try_cast(nullif(regexp_extract(n, '-?[0-9]+(\.[0-9]+)?', 0), '') as {D}) end as parsed_decimal from u"""
)
def q_parse_decimal(spark: SparkSession, sf_dir: str) -> DataFrame:
    k, order = F.col("l_linenumber") % 7, F.col("l_orderkey")
    raw = (
        F.when(k == 0, F.concat(F.format_number(order, 0), F.lit(".50")))
        .when(k == 1, F.concat(F.lit("("), order.cast("string"), F.lit(".25)")))
        .when(k == 2, "-").when(k == 3, "")
        .when(k == 4, F.concat(F.col("l_quantity").cast("int").cast("string"), F.lit("%")))
        .when(k == 5, F.concat(F.lit(" Note "), F.col("l_partkey").cast("string"), F.lit(" x")))
        .otherwise("--")
    )
    rows = table(spark, sf_dir, "lineitem").select("l_orderkey", "l_linenumber", "l_partkey", "l_suppkey", raw.alias("raw_value"))
    return rows.withColumn("parsed_decimal", exprs.parse_decimal("raw_value"))


PERIOD_PACKS = {"web": pack("web", periods=(("point_in_time", ("view",)), ("cumulative", ("purchase", "sign")), ("single_period", ("click",))))}


@query("select event_id, case when contains(lower(event_type), 'view') then 'point_in_time' when contains(lower(event_type), 'purchase') or contains(lower(event_type), 'sign') then 'cumulative' when contains(lower(event_type), 'click') then 'single_period' else 'unknown' end as period_basis from events")
def q_period_basis(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = table(spark, sf_dir, "events").select("event_id", "event_type", F.lit("web").alias("market"))
    return rows.select("event_id", facts.period_basis(F.col("event_type"), PERIOD_PACKS).alias("period_basis"))


# Statements: facts and identities -----------------------------------------------------------------

_STATEMENTS = f"""li as (select l_orderkey as k, sum(l_extendedprice::decimal(18,2)) as total, sum(case when l_returnflag = 'R' then l_extendedprice::decimal(18,2) else 0 end) as part from lineitem group by 1),
b as (select k, total, part, total - part + case k % 6 when 0 then 1 when 1 then 7 when 2 then 900 else 0 end as equity, case k % 8 when 7 then 'no unit' when 6 then 'amounts in thousands' when 5 then 'US$ in millions' else 'USD thousands' end as ctx from li),
u as (select *, case when k % 8 in (7, 6) then null else 'USD' end as currency, case when k % 8 = 7 then null when k % 8 = 5 then 1000000 else 1000 end as scale, case when k % 8 in (7, 6) then 0.0::double else 0.99::double end as unit_confidence,
case when k % 8 = 7 then null when k % 8 = 6 then 'in thousands' when k % 8 = 5 then 'US$ in millions' else 'USD thousands' end as raw_unit from b),
f as (select k, 1 as row_index, 'total_assets' as concept, total::varchar as raw_value, total::{D} as parsed, * exclude (k) from u union all
select k, 2, 'total_liabilities', case when k % 11 = 10 then '--' else part::varchar end, case when k % 11 = 10 then null else part::{D} end, * exclude (k) from u union all
select k, 3, 'total_equity', equity::varchar, equity::{D}, * exclude (k) from u where k % 10 <> 9),
n as (select k, row_index, concept, raw_value, raw_unit, currency, scale::{D} as scale_factor, parsed as parsed_decimal, (parsed * scale::decimal(9,0))::{D} as normalized_value, unit_confidence, case when parsed is not null and unit_confidence >= 0.95 then 'normalized' else 'needs_review' end as fact_status from f)"""


def _statements(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Cells of one two-column table per order with lines: a header, three totals and a line of no concept."""
    price = F.col("l_extendedprice").cast("decimal(18,2)")
    sums = table(spark, sf_dir, "lineitem").groupBy(F.col("l_orderkey").alias("k")).agg(F.sum(price).alias("total"), F.sum(F.when(F.col("l_returnflag") == "R", price).otherwise(F.lit(0).cast("decimal(18,2)"))).alias("part"))
    d, k = F.col("k") % 6, F.col("k")
    sums = sums.withColumn("equity", F.col("total") - F.col("part") + F.when(d == 0, 1).when(d == 1, 7).when(d == 2, 900).otherwise(0))
    context = F.when(k % 8 == 7, "no unit").when(k % 8 == 6, "amounts in thousands").when(k % 8 == 5, "US$ in millions").otherwise("USD thousands")
    last = F.when(k % 10 == 9, "Unmapped line").otherwise("Total stockholders'  equity")
    rows = [("Caption", F.lit("Figures")), ("TOTAL assets", F.col("total").cast("string")), (" Total liabilities ", F.when(k % 11 == 10, "--").otherwise(F.col("part").cast("string"))), (last, F.col("equity").cast("string")), ("Unmapped line", F.lit("999"))]
    cells = [F.struct(F.lit(r).alias("row_index"), F.lit(c).alias("column_index"), (F.lit(x) if isinstance(x, str) else x).alias("raw_text")) for r, row in enumerate(rows) for c, x in enumerate(row)]
    out = sums.select("k", "equity", context.alias("context"), F.explode(F.array(*cells)).alias("c")).select("k", "equity", "context", "c.*")
    return out.withColumns({"raw_cell_id": F.concat_ws("-", F.col("k").cast("string"), F.col("row_index").cast("string"), F.col("column_index").cast("string")), "bbox": F.lit(None).cast("array<double>")})


US = rulepack.load("us")


def _facts(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = facts.label_values(_statements(spark, sf_dir), ["k", "context"]).withColumn("market", F.lit("us"))
    rows = rows.withColumn("u", facts.units(F.col("context"), {"us": US}, longest=True)).select("*", "u.*").drop("u")
    rows = facts.values(facts.concepts(rows, rulepack.alias_table(spark, {"us": US})))
    return rows.withColumn("fact_id", F.concat_ws("-", F.col("k").cast("string"), F.col("row_index").cast("string")))


@query(f"with {_STATEMENTS} select k, row_index, concept as normalized_concept_id, raw_value, raw_unit, currency, scale_factor, parsed_decimal, normalized_value, unit_confidence, fact_status, 'Figures' as column_label from n")
def q_facts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _facts(spark, sf_dir).select("k", "row_index", "normalized_concept_id", "raw_value", "raw_unit", "currency", "scale_factor", "parsed_decimal", "normalized_value", "unit_confidence", "fact_status", "column_label")


@query(f"with {_STATEMENTS} select concept as normalized_concept_id, count(*) as fact_count, count(*) filter (fact_status = 'needs_review') as needs_review_count from n group by 1")
def q_fact_summary(spark: SparkSession, sf_dir: str) -> DataFrame:
    return facts.summary(_facts(spark, sf_dir), ["normalized_concept_id"])


def _fact_side(c: str) -> str:
    return f"max(normalized_value) filter (concept = '{c}') as {c[6:7]}_v, count(*) filter (concept = '{c}') as {c[6:7]}_n, max(scale_factor) filter (concept = '{c}') as {c[6:7]}_s, max(unit_confidence) filter (concept = '{c}') as {c[6:7]}_c"


_CHECKED = f"""{_STATEMENTS}, w as (select k, {_fact_side('total_assets')}, {_fact_side('total_liabilities')}, {_fact_side('total_equity')} from n group by 1),
x as (select *, (a_n = 0 or l_n = 0 or e_n = 0) as missing, (a_s is null or l_s is null or e_s is null or a_c < 0.95 or l_c < 0.95 or e_c < 0.95) as unsure, (a_v is null or l_v is null or e_v is null) as empty from w),
y as (select k, missing, unsure, empty, case when not missing and not unsure and not empty then a_v end::{D} as lhs_value, case when not missing and not unsure and not empty then l_v + e_v end::{D} as rhs_value from x),
v as (select k, lhs_value, rhs_value, (lhs_value - rhs_value)::{D} as difference_value, case when missing then 'requires_manual_review' when unsure then 'blocked_unit_unknown' when empty then 'requires_manual_review' when lhs_value = rhs_value then 'verified'
when abs(lhs_value - rhs_value) <= 2 or (lhs_value <> 0 and abs(lhs_value - rhs_value) <= abs(lhs_value)::decimal(28,6) * 0.0001::decimal(9,4)) then 'verified_with_rounding' else 'failed' end as status, k % 10 = 9 as no_equity from y)"""


def _checked(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = validate.pivoted(_facts(spark, sf_dir), ["k"], validate.BALANCE.concepts, ["row_index"])
    return validate.check(rows, validate.BALANCE, US.absolute_tolerance, US.relative_tolerance)


def _checked_facts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every fact with its statement's verdict, without a second look at the statements."""
    rows = validate.beside(_facts(spark, sf_dir), ["k"], validate.BALANCE.concepts, ["row_index"])
    return validate.check(rows, validate.BALANCE, US.absolute_tolerance, US.relative_tolerance)


@query(f"with {_CHECKED} select k, lhs_value, rhs_value, difference_value, status, case when no_equity then k || '-1,' || k || '-2' else k || '-1,' || k || '-2,' || k || '-3' end as involved_fact_ids from v")
def q_validate(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _checked(spark, sf_dir).select("k", "lhs_value", "rhs_value", "difference_value", "status", F.array_join("involved_fact_ids", ",").alias("involved_fact_ids"))


@query(f"with {_CHECKED} select count(*) as result_count, count(*) filter (status in ('failed', 'blocked_unit_unknown')) as failed_count from v")
def q_validate_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return validate.summary(_checked(spark, sf_dir))


_LAST = ", ".join(f"arg_max(o_orderkey::varchar, (o_orderdate, o_orderkey)) filter (o_orderstatus = '{c}') as {c.lower()}_id, arg_max(o_totalprice::decimal(18,2), (o_orderdate, o_orderkey)) filter (o_orderstatus = '{c}')::{D} as {c.lower()}_value" for c in "FOP")


@query(f"select o_custkey, {_LAST} from orders group by 1")
def q_validate_dup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Of repeated concepts the last counts, by the aggregate that every validation uses."""
    rows = table(spark, sf_dir, "orders").select("o_custkey", "o_orderdate", "o_orderkey", F.col("o_orderstatus").alias("normalized_concept_id"), F.col("o_orderkey").cast("string").alias("fact_id"), F.col("o_totalprice").cast("decimal(18,2)").alias("normalized_value"), F.lit(1).alias("scale_factor"), F.lit(0.99).alias("unit_confidence"))
    wide = validate.pivoted(rows, ["o_custkey"], list("FOP"), ["o_orderdate", "o_orderkey"])
    return wide.select("o_custkey", *[F.col(f"{c}.{f}").alias(f"{c.lower()}_{f}") for c in "FOP" for f in ("id", "value")])


@query(
    f"""with s as (select l_suppkey, sum(l_quantity::decimal(18,2))::{D} as q, sum(l_quantity::decimal(18,2)) filter (l_linestatus = 'O')::{D} as o, sum(l_quantity::decimal(18,2)) filter (l_linestatus = 'F')::{D} as f from lineitem group by 1)
    select l_suppkey, (q)::{D} as lhs_value, (o + f + case when l_suppkey % 4 = 0 then 50 else 0 end)::{D} as rhs_value, case when o is null or f is null then 'requires_manual_review' when l_suppkey % 4 <> 0 then 'verified' when 50 <= q * 0.0001 then 'verified_with_rounding' else 'failed' end as status from s"""
)
def q_subtotals(spark: SparkSession, sf_dir: str) -> DataFrame:
    rule = validate.Identity("sums.quantity", "total = open + filled", "total", ((1, "open"), (1, "filled")))
    q = F.col("l_quantity").cast("decimal(18,2)")
    sums = table(spark, sf_dir, "lineitem").groupBy("l_suppkey").agg(F.sum(q).alias("total"), F.sum(F.when(F.col("l_linestatus") == "O", q)).alias("open"), F.sum(F.when(F.col("l_linestatus") == "F", q)).alias("filled"))
    sums = sums.withColumn("filled", F.col("filled") + F.when(F.col("l_suppkey") % 4 == 0, 50).otherwise(0))
    fact = lambda c: F.when(F.col(c).isNotNull(), F.struct(F.lit(c).alias("id"), F.col(c).cast(D).alias("value"), F.lit(1).alias("scale"), F.lit(0.99).alias("sure"))).alias(c)
    return validate.check(sums.select("l_suppkey", fact("total"), fact("open"), fact("filled")), rule, "2", "0.0001").select("l_suppkey", "lhs_value", "rhs_value", "status")


@query(
    f"""with a as (select s_nationkey as nation, s_suppkey % 7 as period, sum(s_acctbal::decimal(18,2))::{D} as v from supplier group by 1, 2), b as (select s_nationkey as nation, s_suppkey % 7 as period, (sum(s_acctbal::decimal(18,2)) + case s_nationkey % 3 when 0 then 1 when 1 then 40 else 0 end)::{D} as v from supplier where s_suppkey % 7 <> 6 group by 1, 2)
    select coalesce(a.nation, b.nation) as nation, coalesce(a.period, b.period) as period, a.v as value_a, b.v as value_b, case when coalesce(abs(a.v - b.v) <= 2 or (a.v <> 0 and abs(a.v - b.v) <= abs(a.v)::decimal(28,6) * 0.0001::decimal(9,4)), false) then 'agreed' else 'blocked_extractor_conflict' end as agreement_status from a full outer join b on a.nation = b.nation and a.period = b.period"""
)
def q_agreement(spark: SparkSession, sf_dir: str) -> DataFrame:
    s = table(spark, sf_dir, "supplier").select(F.col("s_nationkey").alias("nation"), (F.col("s_suppkey") % 7).alias("period"), F.col("s_acctbal").cast("decimal(18,2)").alias("v"))
    a = s.groupBy("nation", "period").agg(F.sum("v").alias("normalized_value"))
    k = F.col("nation") % 3
    b = s.where("period <> 6").groupBy("nation", "period").agg(F.sum("v").alias("normalized_value")).withColumn("normalized_value", F.col("normalized_value") + F.when(k == 0, 1).when(k == 1, 40).otherwise(0))
    return agreement.agreement(a, b, ["nation", "period"])


_SIDES = f"""a as (select s_nationkey as nation, s_suppkey % 3 as part, round(s_acctbal, 0)::{D} as v, row_number() over (partition by s_nationkey, s_suppkey % 3, round(s_acctbal, 0)::{D}) as r from supplier),
b as (select s_nationkey as nation, s_suppkey % 3 as part, (round(s_acctbal, 0) + case s_suppkey % 4 when 1 then 1 when 2 then 50 else 0 end)::{D} as v, row_number() over (partition by s_nationkey, s_suppkey % 3, (round(s_acctbal, 0) + case s_suppkey % 4 when 1 then 1 when 2 then 50 else 0 end)::{D}) as r from supplier where s_suppkey % 7 <> 6)"""


@query(
    f"""with {_SIDES}, u as (select nation, part, v, 'a' as side from (select * from a anti join b using (nation, part, v, r)) union all select nation, part, v, 'b' from (select * from b anti join a using (nation, part, v, r))),
    d as (select *, v - lag(v) over w as gap, greatest(abs(v), abs(lag(v) over w)) as reach from (select distinct nation, part, v from u) window w as (partition by nation, part order by v)),
    s as (select nation, part, v, sum(case when gap is null or not (gap <= 2 or (reach <> 0 and gap <= reach::decimal(28,6) * 0.0002::decimal(9,4))) then 1 else 0 end) over (partition by nation, part order by v) as st from d),
    x as (select nation, part, v, st, side, row_number() over (partition by nation, part, st, side order by v) as r from u join s using (nation, part, v)),
    p as (select coalesce(y.nation, z.nation) as nation, coalesce(y.part, z.part) as part, y.v as value_a, z.v as value_b from (select * from x where side = 'a') y full outer join (select * from x where side = 'b') z on y.nation = z.nation and y.part = z.part and y.st = z.st and y.r = z.r),
    oa as (select nation, part, value_a, row_number() over (partition by nation, part order by value_a) as r from p where value_b is null), ob as (select nation, part, value_b, row_number() over (partition by nation, part order by value_b) as r from p where value_a is null)
    select nation, part, v as value_a, v as value_b, 'agreed' as agreement_status from a semi join b using (nation, part, v, r)
    union all select nation, part, value_a, value_b, case when coalesce(abs(value_a - value_b) <= 2 or (value_a <> 0 and abs(value_a - value_b) <= abs(value_a)::decimal(28,6) * 0.0001::decimal(9,4)), false) then 'agreed' else 'blocked_extractor_conflict' end from p where value_a is not null and value_b is not null
    union all select coalesce(oa.nation, ob.nation), coalesce(oa.part, ob.part), value_a, value_b, 'blocked_extractor_conflict' from oa full outer join ob on oa.nation = ob.nation and oa.part = ob.part and oa.r = ob.r"""
)
def q_agreement_pairs(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Many facts of a key on each side, some repeated, some moved, some on one side only."""
    k = F.col("s_suppkey")
    s = table(spark, sf_dir, "supplier").select(F.col("s_nationkey").alias("nation"), (k % 3).alias("part"), k.alias("k"), F.round("s_acctbal", 0).cast(D).alias("normalized_value"))
    moved = s.where("k % 7 <> 6").withColumn("normalized_value", F.col("normalized_value") + F.expr("case k % 4 when 1 then 1 when 2 then 50 else 0 end"))
    return agreement.agreement(s, moved, ["nation", "part"])


_FORMS = {  # form: (header in Spark's pattern, basis, SQL of the date, months)
    0: ("'As of 'MMMM d, yyyy", "point_in_time", "d", None),
    1: ("'Three months ended 'd MMM yyyy", "single_period", "d", 3),
    2: ("yyyy-MM-dd", "point_in_time", "d", None),
    3: ("'Nine months ended 'MM/dd/yyyy", "cumulative", "d", 9),
    4: ("yyyy年M月d日", "point_in_time", "d", None),
    5: ("'前三季度 'yyyy年MM月", "cumulative", "last_day(d)", 9),
    6: ("'Year ended 'yyyy", "cumulative", "make_date(year(d), 12, 31)", 12),
    7: ("'截至 'yyyy'年度'", "cumulative", "make_date(year(d), 12, 31)", 12),
    8: ("'Amount (note 'd')'", "cumulative", "null::date", None),
}


def _dates_sql() -> str:
    case = lambda k: "case o_orderkey % 9 " + " ".join(f"when {n} then {v}" for n, v in k.items()) + " end"
    end, months = case({n: f[2] for n, f in _FORMS.items()}), case({n: f[3] or "null::int" for n, f in _FORMS.items()})
    instant = case({n: str(f[1] == "point_in_time").lower() for n, f in _FORMS.items()})
    return f"""with o as (select o_orderkey, o_orderdate::date as d from orders), p as (select o_orderkey, ({end})::date as e, ({months})::int as m, {instant} as i from o)
    select o_orderkey, case when not i then (last_day(e) + 1 - to_months(m))::date end as period_start, case when not i then e end as period_end, case when i then e end as instant_date from p"""


@query(_dates_sql())
def q_period_dates(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Headers written from order dates in nine forms; their dates must be read back."""
    pick = lambda k, f: reduce(lambda out, n: out.when(F.col("o_orderkey") % 9 == n, f(n)), list(_FORMS)[1:], F.when(F.col("o_orderkey") % 9 == 0, f(0)))
    header = pick("header", lambda n: F.date_format("o_orderdate", _FORMS[n][0]))
    dates = periods.period(header, pick("basis", lambda n: F.lit(_FORMS[n][1])))
    return table(spark, sf_dir, "orders").select("o_orderkey", dates.alias("p")).select("o_orderkey", "p.*")


@query("select l_suppkey::varchar as extraction_run_id, count(*) as n_facts from lineitem group by 1 having bool_or(l_suppkey % 5 = 0 and l_linenumber = 3)")
def q_changed_runs(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Suppliers stand for runs, line items for their facts: after a correction only the runs that it touches are to be judged."""
    key = F.concat_ws("-", "l_orderkey", "l_linenumber")
    held = table(spark, sf_dir, "lineitem").select(F.col("l_suppkey").cast("string").alias("extraction_run_id"), key.alias("fact_id"), F.col("l_extendedprice").cast(D).alias("normalized_value"), "l_suppkey", "l_linenumber")
    columns = ["fact_id", "normalized_value"]
    rules = F.lit("rules").alias("rule_pack_version")
    noted = validate.fact_digests(held, columns=columns).select("*", rules, F.col("extraction_run_id").alias("validation_run_id"), F.lit(EPOCH).cast("timestamp").alias("finished_at"))
    touched = held.withColumn("normalized_value", F.when((F.col("l_suppkey") % 5 == 0) & (F.col("l_linenumber") == 3), F.col("normalized_value") + 1).otherwise(F.col("normalized_value")).cast(D))
    now = validate.fact_digests(touched, columns=columns).withColumn("rule_pack_version", rules)
    changed = validate.changed_runs(now, noted)
    return changed.select("extraction_run_id", F.split_part("facts_digest", F.lit("/"), F.lit(1)).cast("bigint").alias("n_facts"))


# Review and corrections ---------------------------------------------------------------------------


@query(f"with {_CHECKED} select k::varchar as validation_result_id, status, lhs_value::varchar as lhs_value, rhs_value::varchar as rhs_value, case k % 3 when 0 then 'balance_sheet_raw' when 1 then 'notes_revenue_raw' end as sheet from v where not starts_with(status, 'verified')")
def q_review_failures(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = review.failures(_checked(spark, sf_dir).withColumn("validation_result_id", F.col("k")))
    k = F.col("validation_result_id").cast("bigint") % 3
    role = F.when(k == 0, "statement.balance_sheet").when(k == 1, "note.revenue").otherwise("note.revenue_by_product")
    return rows.select("validation_result_id", "status", "lhs_value", "rhs_value", review.target_sheet(role).alias("sheet"))


_SHEET = """select event_id as row_number, user_id::varchar as fact_id, case event_type when 'view' then 'confirm' when 'click' then 'correct' when 'purchase' then 'remap' when 'signup' then 'ignore' else 'delete' end as correction_action,
case when event_id % 3 = 0 then value::decimal(18,2)::varchar when event_id % 3 = 1 then 'n/a' end as corrected_value, case when event_id % 5 = 0 then 'USD' when event_id % 5 = 1 then 'pounds' end as corrected_unit, case when event_id % 4 = 0 then 'total_assets' end as normalized_concept_id,
case when event_id % 2 = 0 then 'checked' end as correction_reason, ts from events"""


def _sheet(spark: SparkSession, sf_dir: str) -> DataFrame:
    e, t = F.col("event_id"), F.col("event_type")
    none = F.lit(None).cast("string")
    return table(spark, sf_dir, "events").select(
        e.alias("row_number"), F.col("user_id").cast("string").alias("fact_id"),
        F.when(t == "view", "confirm").when(t == "click", "correct").when(t == "purchase", "remap").when(t == "signup", "ignore").otherwise("delete").alias("correction_action"),
        F.when(e % 3 == 0, F.col("value").cast("decimal(18,2)").cast("string")).when(e % 3 == 1, "n/a").alias("corrected_value"), F.when(e % 5 == 0, "USD").when(e % 5 == 1, "pounds").alias("corrected_unit"),
        F.when(e % 4 == 0, "total_assets").alias("normalized_concept_id"), none.alias("period_basis"), none.alias("statement_scope"), none.alias("table_role"), F.when(e % 2 == 0, "checked").alias("correction_reason"), F.col("ts").alias("created_at"),
    )


@query(
    f"""with s as ({_SHEET}), k as (select c_custkey::varchar as id, c_nationkey from customer where c_custkey % 9 <> 0), j as (select s.*, id is null as unknown, c_nationkey, count(*) over (partition by fact_id, correction_action) as n from s left join k on id = fact_id),
    e as (select row_number, fact_id, unnest(list_filter([case when unknown then 'UNKNOWN_FACT_ID' end, case when not unknown and c_nationkey <> 3 then 'FACT_NOT_IN_EXTRACTION_RUN' end, case when correction_action = 'delete' then 'INVALID_ACTION' end, case when correction_action in ('correct', 'remap', 'ignore') and correction_reason is null then 'MISSING_REASON' end,
    case when (correction_action = 'correct' and corrected_value is null and corrected_unit is null) or (correction_action = 'remap' and normalized_concept_id is null) then 'MISSING_CORRECTED_VALUE' end, case when corrected_value = 'n/a' then 'INVALID_DECIMAL' end, case when corrected_unit = 'pounds' then 'INVALID_UNIT' end, case when n > 1 then 'DUPLICATE_CORRECTION_ROW' end], lambda x: x is not null)) as error_code from j)
    select row_number, fact_id, error_code from e"""
)
def q_corrections_validate(spark: SparkSession, sf_dir: str) -> DataFrame:
    known = table(spark, sf_dir, "customer").where("c_custkey % 9 <> 0").select(F.col("c_custkey").cast("string").alias("fact_id"), F.col("c_nationkey").cast("string").alias("extraction_run_id"))
    return corrections.error_rows(_sheet(spark, sf_dir), known, run_id="3")


@query(
    f"""with s as ({_SHEET}), l as (select fact_id, arg_max(corrected_value, (ts, row_number)) filter (corrected_value is not null and corrected_value <> 'n/a') as v, arg_max(corrected_unit, (ts, row_number)) filter (corrected_unit is not null) as u, arg_max(normalized_concept_id, (ts, row_number)) filter (normalized_concept_id is not null) as c, arg_max(correction_action, (ts, row_number)) as a from s where corrected_value is null or corrected_value <> 'n/a' group by 1)
    select c_custkey::varchar as fact_id, coalesce(l.v::{D}, c_acctbal::decimal(18,2)::{D}) as normalized_value, coalesce(l.u, 'CNY') as raw_unit, coalesce(l.c, 'revenue') as normalized_concept_id, l.a as correction_action from customer left join l on l.fact_id = c_custkey::varchar"""
)
def q_corrections_latest(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _effective(spark, sf_dir).select("fact_id", "normalized_value", "raw_unit", "normalized_concept_id", "correction_action")


def _effective(spark: SparkSession, sf_dir: str) -> DataFrame:
    none = F.lit(None).cast("string")
    held = table(spark, sf_dir, "customer").select(F.col("c_custkey").cast("string").alias("fact_id"), F.col("c_acctbal").cast("decimal(18,2)").cast(D).alias("normalized_value"), F.lit("CNY").alias("raw_unit"), F.lit("revenue").alias("normalized_concept_id"), none.alias("period_basis"), none.alias("statement_scope"), none.alias("table_role"), F.col("c_mktsegment").alias("segment"))
    sheet = _sheet(spark, sf_dir).where("corrected_value is null or corrected_value <> 'n/a'")
    fields = F.array_compact(F.array(*[F.when(F.col(c).isNotNull(), F.struct(F.lit(f).alias("field_name"), F.col(c).alias("new_value"))) for c, f in [*corrections.FIELDS.items(), ("correction_action", "correction_action")]]))
    long = sheet.select("fact_id", "created_at", F.col("row_number").alias("correction_id"), F.explode(fields).alias("p")).select("fact_id", "created_at", "correction_id", "p.*")
    return corrections.effective(held, long)


@query(f"with q as ({SQL['q_corrections_latest']}) select fact_id, case when correction_action = 'confirm' then 'manually_confirmed' when c_mktsegment = 'BUILDING' then 'failed' else 'verified' end as validation_status from q join customer on c_custkey::varchar = fact_id where coalesce(correction_action <> 'ignore', true)")
def q_correction_status(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = _effective(spark, sf_dir).withColumn("validation_status", F.when(F.col("segment") == "BUILDING", "failed").otherwise("verified"))
    return corrections.candidate_status(rows).select("fact_id", "validation_status")


# Publishing and views -----------------------------------------------------------------------------

_TRUSTED = f"""{_CHECKED}, t as (select 'v' || (n.k % 50) as trusted_version_id, n.k || '-' || n.row_index as fact_id, (n.k % 50)::varchar as report_id, n.k, 'c' || (n.k % 20) as company_id, (1992 + n.k % 7)::int as fiscal_year, case n.k % 2 when 0 then 'annual' else 'quarterly' end as report_type, n.concept, n.normalized_value as effective_value, n.raw_unit as effective_unit, n.currency, (n.k % 100)::int as source_page, v.status as trusted_status
from n join v on n.k = v.k where v.status in ('verified', 'verified_with_rounding', 'manually_confirmed') and n.k % 5 <> 0)"""


def _trusted(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Statements are reports k % 50 of run k % 5; version of run 0 are inactive."""
    k = F.col("k")
    rows = _checked_facts(spark, sf_dir).withColumnRenamed("status", "validation_status").withColumns(
        {
            "report_id": (k % 50).cast("string"), "extraction_run_id": (k % 5).cast("string"), "company_id": F.concat(F.lit("c"), (k % 20).cast("string")), "fiscal_year": (1992 + k % 7).cast("int"), "report_type": F.when(k % 2 == 0, "annual").otherwise("quarterly"),
            "statement_scope": F.lit("consolidated"), "statement_type": F.lit("balance_sheet"), "table_role": F.lit("statement.balance_sheet"), "period_basis": F.lit("point_in_time"), "raw_table_id": k.cast("string"), "page_number": (k % 100).cast("int"), "row_label": F.col("raw_label"),
        }
    )
    ids = F.col("id")
    versions = spark.range(50).select(F.concat(F.lit("v"), ids.cast("string")).alias("trusted_version_id"), ids.cast("string").alias("report_id"), (ids % 5).cast("string").alias("extraction_run_id"), F.lit("report").alias("scope"), F.lit(None).cast("string").alias("scope_key"), F.when(ids % 5 == 0, "inactive").otherwise("active").alias("status"))
    reports = versions.select("report_id", F.lit("Co").alias("company_name"))
    return publish.trusted_facts(rows, versions, reports)


@query(f"with {_TRUSTED} select trusted_version_id, fact_id, report_id, concept as effective_concept_id, effective_value, effective_unit, trusted_status from t")
def q_trusted_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _trusted(spark, sf_dir).select("trusted_version_id", "fact_id", "report_id", "effective_concept_id", "effective_value", "effective_unit", "trusted_status")


@query(f"select s_nationkey::varchar as report_id, case when s_nationkey % 2 = 0 then '2' else '1' end as extraction_run_id, s_suppkey::varchar as fact_id, (s_acctbal::decimal(18,2) * case when s_nationkey % 2 = 0 then 2 else 1 end)::{D} as effective_value, case s_suppkey % 4 when 0 then 'verified' when 1 then 'verified_with_rounding' else 'manually_confirmed' end as trusted_status from supplier where s_suppkey % 4 <> 3")
def q_published(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Two runs of every nation's report: the first is published for all, the second for the even ones, whose first versions are superseded."""
    lake = Lake(spark, f"{scratch_root(spark)}/lake-{uuid.uuid4().hex}")
    lake.initialize()
    k, run = F.col("s_suppkey") % 4, F.col("run").cast("string")
    status = F.when(k == 0, "verified").when(k == 1, "verified_with_rounding").when(k == 2, "manually_confirmed").otherwise("failed")
    found = table(spark, sf_dir, "supplier").withColumn("run", F.explode(F.array(F.lit(1), F.lit(2)))).select(F.col("s_nationkey").cast("string").alias("report_id"), run.alias("extraction_run_id"), F.col("s_suppkey").cast("string").alias("fact_id"), (F.col("s_acctbal").cast("decimal(18,2)") * F.col("run")).cast(D).alias("normalized_value"), F.lit("total_assets").alias("normalized_concept_id"), F.lit("USD").alias("raw_unit"), F.lit(1).alias("page_number"), F.lit("balance_sheet").alias("statement_type"), F.lit("t").alias("raw_table_id"), status.alias("validation_status"))
    nations = table(spark, sf_dir, "nation").select(F.col("n_nationkey").cast("string").alias("report_id"), F.col("n_name").alias("company_name"), "n_nationkey")
    at = lambda day: F.lit(f"2026-01-0{day} 00:00:00").cast("timestamp")
    for day, reports in ((1, nations), (2, nations.where("n_nationkey % 2 = 0"))):
        versions = publish.version_rows(reports.select("report_id", F.lit(str(day)).alias("extraction_run_id")), "report", None, at(day))
        publish.publish(lake, found.where(F.col("extraction_run_id") == str(day)), nations, versions)
    return publish.published(lake).select("report_id", "extraction_run_id", "fact_id", "effective_value", "trusted_status")


@query("select o_custkey::varchar as report_id, 'statement' as scope, coalesce(case when o_orderpriority <> '5-LOW' then o_orderpriority end, '') as scope_key, count(*) as n from orders where o_orderstatus = 'P' group by 1, 2, 3 having count(*) > 1")
def q_active_unique(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = table(spark, sf_dir, "orders").select(F.col("o_custkey").cast("string").alias("report_id"), F.lit("statement").alias("scope"), F.when(F.col("o_orderpriority") != "5-LOW", F.col("o_orderpriority")).alias("scope_key"), F.when(F.col("o_orderstatus") == "P", "active").otherwise("inactive").alias("status"))
    return active_conflicts(rows)


@query(f"with {_TRUSTED} select company_id, fiscal_year, report_type, concept as concept_id, effective_value, currency, source_page, trusted_status from t")
def q_statement_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    return views.statement_lines(_trusted(spark, sf_dir)).select("company_id", "fiscal_year", "report_type", "concept_id", "effective_value", "currency", "source_page", "trusted_status")


@query(f"with {_TRUSTED} select company_id, fiscal_year, report_type, " + ", ".join(f"arg_max(effective_value, (source_page, k)) filter (concept = '{c}') as {c}" for c in ("total_assets", "total_liabilities", "total_equity")) + " from t group by 1, 2, 3")
def q_wide(spark: SparkSession, sf_dir: str) -> DataFrame:
    lines = _trusted(spark, sf_dir).withColumns({"concept_id": F.col("effective_concept_id"), "k": F.split_part("fact_id", F.lit("-"), F.lit(1)).cast("bigint")})
    return views.wide(lines, "balance_sheet", ["total_assets", "total_liabilities", "total_equity"], ["company_id", "fiscal_year", "report_type"], ["source_page", "k"])


@query(f"with {_TRUSTED} select company_id, fiscal_year, report_type, count(*) as fact_count, count(distinct concept) as concept_count, count(distinct report_id) as report_count from t group by 1, 2, 3")
def q_period_summary(spark: SparkSession, sf_dir: str) -> DataFrame:
    return views.period_summary(_trusted(spark, sf_dir)).drop("latest_period_end")


@query(f"with {_TRUSTED} " + " union all ".join(f"select {n} as level, " + ", ".join(c if k < n else f"null::{t} as {c}" for k, (c, t) in enumerate((("company_id", "varchar"), ("fiscal_year", "int"), ("report_type", "varchar")))) + ", count(*) as fact_count, count(distinct concept) as concept_count, count(distinct report_id) as report_count from t" + (" group by " + ", ".join(str(k + 2) for k in range(n)) if n else " having count(*) > 0") for n in range(4)))
def q_rollups(spark: SparkSession, sf_dir: str) -> DataFrame:
    return views.rollups(_trusted(spark, sf_dir)).drop("latest_period_end")


@query(f"with {_CHECKED} select n.k || '-' || n.row_index as fact_id, n.concept as normalized_concept_id, v.status as validation_status, case when n.k % 4 = 0 then 1 else 0 end::bigint as correction_count from n join v on n.k = v.k")
def q_debug(spark: SparkSession, sf_dir: str) -> DataFrame:
    k = F.col("o_orderkey")
    fixed = table(spark, sf_dir, "orders").where(k % 4 == 0).select(F.explode(F.array(*[F.concat_ws("-", k.cast("string"), F.lit(str(r))) for r in (1, 2, 3)])).alias("fact_id"))
    return views.debug_facts(_facts(spark, sf_dir), _checked(spark, sf_dir), fixed).select("fact_id", "normalized_concept_id", "validation_status", "correction_count")


# Whole stages over the lake's tables ----------------------------------------------------------------

LONG = "1234567890123456789012345"
_FILED = f"""{_STATEMENTS.rsplit("n as (", 1)[0].rstrip().rstrip(",")},
filed as (select k, row_index, concept, 0 as table_index_on_page, case when concept = 'total_assets' and k % 13 = 0 then '{LONG}' else raw_value end as raw_value, case when concept = 'total_assets' and k % 13 = 0 then '{LONG}'::{D} else parsed end as parsed, scale, currency, raw_unit, unit_confidence from f
union all select k, 1, 'total_equity', 1, (equity + 900)::varchar, (equity + 900)::{D}, scale, currency, raw_unit, unit_confidence from u where k % 3 = 0),
fact as (select *, case when not (concept = 'total_assets' and k % 13 = 0) then (parsed * scale::decimal(9,0))::{D} end as normalized_value, case when parsed is not null and unit_confidence >= 0.95 and not (concept = 'total_assets' and k % 13 = 0) then 'normalized' else 'needs_review' end as fact_status from filed)"""


def _filings(spark: SparkSession, sf_dir: str) -> dict[str, DataFrame]:
    """The lake's tables for one report, run and balance sheet per order; some cells are repeated, some numbers too long, some equity in a second table."""
    own = _statements(spark, sf_dir)
    k, at = F.col("k"), (F.col("row_index"), F.col("column_index"))
    raw = F.when((k % 13 == 0) & (at[0] == 1) & (at[1] == 1), LONG).otherwise(F.col("raw_text"))
    own = own.withColumns({"raw_text": raw, "table_index_on_page": F.lit(0), "emit_order": at[0] * 10 + at[1] + 1})
    again = own.where((k % 7 == 0) & (at[1] == 1)).withColumns({"raw_text": F.lit("5"), "emit_order": F.lit(0)})
    second = own.where((k % 3 == 0) & at[0].isin(0, 3)).withColumn("raw_text", F.when(at[0] == 0, F.col("raw_text")).when(at[1] == 0, "Total stockholders' equity").otherwise((F.col("equity") + 900).cast("string")))
    second = second.withColumns({"row_index": F.when(at[0] == 3, 1).otherwise(0), "table_index_on_page": F.lit(1)})
    ids = {"report_id": k.cast("string"), "extraction_run_id": k.cast("string"), "page_number": F.lit(1), "raw_table_id": F.concat_ws("/", k.cast("string"), F.col("table_index_on_page").cast("string"))}
    written = f"{scratch_root(spark)}/filings-{uuid.uuid4().hex}"  # as in the lake, where cells are stored rows and not derived for each reader
    own.unionByName(again).unionByName(second).withColumns(ids).write.parquet(written)
    cells = spark.read.parquet(written)
    tables = cells.groupBy("k", "context", "raw_table_id", "extraction_run_id", "report_id", "page_number", "table_index_on_page").agg(F.lit("fake").alias("extractor_name")).withColumnRenamed("context", "raw_table_text")
    orders = table(spark, sf_dir, "orders").select(F.col("o_orderkey").cast("string").alias("report_id"))
    reports = orders.withColumns({"market": F.lit("us"), "company_id": F.lit("c"), "fiscal_year": F.lit(2026), "report_type": F.lit("annual"), "source_type": F.lit("pdf")})
    return {
        "classified": tables.select("raw_table_id", F.lit(facts.BALANCE_SHEET).alias("table_role"), F.lit("consolidated").alias("statement_scope")),
        "tables": tables, "cells": cells, "reports": reports, "runs": orders.withColumn("extraction_run_id", F.col("report_id")),
        "pages": orders.withColumns({"page_number": F.lit(1), "page_text_sample": F.lit("Consolidated Balance Sheets")}),
    }


def _extracted(spark: SparkSession, sf_dir: str) -> tuple[DataFrame, dict[str, DataFrame]]:
    x = _filings(spark, sf_dir)
    found = facts.extract_facts(x["classified"], x["tables"], x["cells"], x["pages"], x["runs"], x["reports"], {"us": US}, rulepack.alias_table(spark, {"us": US}), F.lit(EPOCH).cast("timestamp"), longest_unit=True)
    return found, x


@query(f"with {_FILED} select k::varchar as report_id, table_index_on_page, row_index, concept as normalized_concept_id, raw_value, parsed as parsed_decimal, normalized_value, fact_status, 'Figures' as column_label from fact")
def q_extract_facts(spark: SparkSession, sf_dir: str) -> DataFrame:
    found, _ = _extracted(spark, sf_dir)
    return conformed(found, "extracted_facts").select("report_id", "table_index_on_page", "row_index", "normalized_concept_id", "raw_value", "parsed_decimal", "normalized_value", "fact_status", "column_label")


def _last_side(c: str) -> str:
    s, at = c[6:7], "(table_index_on_page, row_index)"
    return f"arg_max((normalized_value, scale, unit_confidence), {at}) filter (concept = '{c}') as {s}"


_RUNS = f"""{_FILED}, w as (select k, {_last_side('total_assets')}, {_last_side('total_liabilities')}, {_last_side('total_equity')} from fact group by 1),
z as (select o_orderkey as k, a, l, e from orders left join w on k = o_orderkey),
x as (select k, (a is null or l is null or e is null) as missing, (a[2] is null or l[2] is null or e[2] is null or a[3] < 0.95 or l[3] < 0.95 or e[3] < 0.95) as unsure, (a[1] is null or l[1] is null or e[1] is null) as empty, a[1] as lhs, (l[1] + e[1])::{D} as rhs from z),
y as (select *, not missing and not unsure and not empty as ok from x),
v as (select k::varchar as extraction_run_id, case when ok then lhs end as lhs_value, case when ok then rhs end as rhs_value, case when ok then (lhs - rhs)::{D} end as difference_value, case when missing then 'requires_manual_review' when unsure then 'blocked_unit_unknown' when empty then 'requires_manual_review' when lhs = rhs then 'verified'
when abs(lhs - rhs) <= 2 or (lhs <> 0 and abs(lhs - rhs) <= abs(lhs)::decimal(28,6) * 0.0001::decimal(9,4)) then 'verified_with_rounding' else 'failed' end as status, case when missing then 'a required concept is missing' when unsure then 'a unit is unknown' when empty then 'a value is missing' end as said from y)"""


@query(f"with {_RUNS} select extraction_run_id, 'balance_sheet.assets_equal_liabilities_plus_equity' as rule_id, 'error' as severity, status, lhs_value, rhs_value, difference_value, coalesce(said, 'total_assets ' || lhs_value || ' against ' || rhs_value || ' differs by ' || difference_value) as message from v")
def q_validate_runs(spark: SparkSession, sf_dir: str) -> DataFrame:
    found, x = _extracted(spark, sf_dir)
    rows = validate.validate_runs(found, x["runs"], x["reports"], {"us": US}, F.lit(EPOCH).cast("timestamp"))
    return conformed(rows, "validation_results").select("extraction_run_id", "rule_id", "severity", "status", "lhs_value", "rhs_value", "difference_value", "message")


@query(
    rf"""with lines as (select conv_id, string_agg(text, chr(10) order by turn, role) as t from conversations where text is not null group by 1),
    t as (select d.doc_id, d.lang, lower(concat_ws(chr(10), nullif(substring(regexp_replace(coalesce(d.text, ''), '^[\s\p{{Z}}]+|[\s\p{{Z}}]+$', '', 'g'), 1, 1000), ''), nullif(lines.t, ''))) as t, lang in ('en', 'fr', 'de') as known from documents d left join lines on conv_id = doc_id),
    c as (select doc_id, {_ROLE} as table_role, {_CONFIDENCE} as classification_confidence, {_RULE.replace('%s', 'table_titles')} as classification_rule_id, case when known and {_hit(SCOPES['parent'])} then 'parent' when known and {_hit(SCOPES['consolidated'])} then 'consolidated' else 'unknown' end as statement_scope from t)
    select doc_id::varchar as raw_table_id, table_role, statement_scope, classification_confidence, classification_rule_id, classification_confidence < 0.95 or statement_scope <> 'consolidated' as requires_review from c"""
)
def q_classify_runs(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Documents as pages of a table each, conversations as the tables' cells."""
    docs = table(spark, sf_dir, "documents").withColumn("id", F.col("doc_id").cast("string"))
    tables = docs.select(F.col("id").alias("raw_table_id"), F.col("id").alias("extraction_run_id"), F.col("id").alias("report_id"), F.lit(1).alias("page_number"), F.lit(None).cast("string").alias("raw_table_text"))
    cells = table(spark, sf_dir, "conversations").select(F.col("conv_id").cast("string").alias("raw_table_id"), F.col("turn").alias("row_index"), F.col("role").alias("column_index"), F.col("text").alias("raw_text"))
    pages = docs.select(F.col("id").alias("report_id"), F.lit(1).alias("page_number"), exprs.or_null(F.substring(exprs.strip(F.coalesce("text", F.lit(""))), 1, profile.SAMPLE_CHARS)).alias("page_text_sample"))
    runs = docs.select(F.col("id").alias("extraction_run_id"), F.col("id").alias("report_id"))
    rows = classify.classify_runs(tables, cells, pages, runs, docs.select(F.col("id").alias("report_id"), F.col("lang").alias("market")), DOC_PACKS, F.lit(EPOCH).cast("timestamp"))
    return rows.select("raw_table_id", "table_role", "statement_scope", "classification_confidence", "classification_rule_id", "requires_review")


@query(f"select c_custkey::varchar as concept_id, c_name as raw_label, case when c_custkey % 3 = 0 then 'segment' when c_custkey % 3 = 1 then 'sales_by_area' end as dimension_name, case when c_custkey % 3 < 2 then c_name end as dimension_value, c_acctbal::decimal(18,2)::{D} as effective_value from customer where c_custkey % 4 <> 0")
def q_note_facts(spark: SparkSession, sf_dir: str) -> DataFrame:
    k = F.col("c_custkey")
    role = F.when(k % 4 == 0, "statement.balance_sheet").when(k % 3 == 0, "note.revenue_by_segment").when(k % 3 == 1, "note.revenue_by_sales_by_area").otherwise("note.revenue")
    trusted = conformed(table(spark, sf_dir, "customer").withColumns({"table_role": role, "raw_label": F.col("c_name"), "effective_concept_id": k.cast("string"), "effective_value": F.col("c_acctbal").cast("decimal(18,2)")}), "trusted_facts")
    return views.note_facts(trusted).select("concept_id", "raw_label", "dimension_name", "dimension_value", "effective_value")


@query(f"with {_TRUSTED} select report_id, source_page, trusted_status, company_id, fiscal_year, report_type, concept as effective_concept_id, effective_value, effective_unit, currency from t")
def q_ai_facts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return views.ai_facts(_trusted(spark, sf_dir)).select("report_id", "source_page", "trusted_status", "company_id", "fiscal_year", "report_type", "effective_concept_id", "effective_value", "effective_unit", "currency")


@query(f"with g as ({SQL['q_agreement']}) select s_suppkey, coalesce(agreement_status = 'agreed', false) and s_suppkey % 5 <> 0 and s_suppkey % 4 <> 1 and s_suppkey % 6 <> 5 as auto_trusted from supplier left join g on nation = s_nationkey and period = s_suppkey % 7")
def q_auto_trust(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Extractors agree, the unit is known, the mapping is sure and the rule holds."""
    k = F.col("s_suppkey")
    rows = table(spark, sf_dir, "supplier").select("s_suppkey", F.col("s_nationkey").alias("nation"), (k % 7).alias("period"), F.when(k % 5 == 0, 0.0).otherwise(0.99).alias("unit_confidence"), F.when(k % 4 == 1, 0.9).otherwise(0.98).alias("mapping_confidence"), F.when(k % 6 == 5, "failed").when(k % 6 == 4, "verified_with_rounding").otherwise("verified").alias("validation_status"))
    return publish.auto_trust(rows, q_agreement(spark, sf_dir), ["nation", "period"]).select("s_suppkey", "auto_trusted")


@query("select o_orderkey::varchar as trusted_version_id, case when o_orderstatus = 'P' then 'inactive' when row_number() over (partition by o_custkey, coalesce(case when o_orderpriority <> '5-LOW' then o_orderpriority end, ''), o_orderstatus = 'P' order by o_orderdate desc, o_orderkey::varchar desc) > 1 then 'superseded' else 'active' end as status from orders")
def q_activated(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = table(spark, sf_dir, "orders").select(F.col("o_orderkey").cast("string").alias("trusted_version_id"), F.col("o_custkey").cast("string").alias("report_id"), F.lit("statement").alias("scope"), F.when(F.col("o_orderpriority") != "5-LOW", F.col("o_orderpriority")).alias("scope_key"), F.when(F.col("o_orderstatus") == "P", "inactive").otherwise("active").alias("status"), F.col("o_orderdate").alias("published_at"))
    return publish.activated(rows).select("trusted_version_id", "status")


@query(
    f"""with s as ({_SHEET}), p as (select row_number, fact_id, correction_reason, unnest([{{'f': 'normalized_value', 'v': corrected_value}}, {{'f': 'raw_unit', 'v': corrected_unit}}, {{'f': 'normalized_concept_id', 'v': normalized_concept_id}}, {{'f': 'correction_action', 'v': correction_action}}]) as x from s)
    select p.fact_id, x.f as field_name, x.v as new_value, case x.f when 'normalized_value' then c_acctbal::decimal(18,2)::{D}::varchar when 'raw_unit' then case when c_custkey is not null then 'CNY' end when 'normalized_concept_id' then case when c_custkey is not null then 'revenue' end end as old_value, correction_reason from p left join customer on c_custkey::varchar = p.fact_id where x.v is not null"""
)
def q_history(spark: SparkSession, sf_dir: str) -> DataFrame:
    none = F.lit(None).cast("string")
    held = table(spark, sf_dir, "customer").select(F.col("c_custkey").cast("string").alias("fact_id"), F.col("c_acctbal").cast("decimal(18,2)").cast(D).alias("normalized_value"), F.lit("CNY").alias("raw_unit"), F.lit("revenue").alias("normalized_concept_id"), none.alias("period_basis"), none.alias("statement_scope"), none.alias("table_role"))
    log = corrections.history(_sheet(spark, sf_dir).drop("created_at"), held, F.lit("b"), F.lit(EPOCH).cast("timestamp"))
    return log.select("fact_id", "field_name", "new_value", "old_value", "correction_reason")


# Two runs of a report -------------------------------------------------------------------------------

#: An order's lines are a table's rows. The second run lacks every third line, has titles before the table of every second order and a column
#: before that of every fifth, and reads returned lines differently; it reads the units of every eleventh order differently.
_RUNS = """
 line as (select l_orderkey as k, row_number() over (partition by l_orderkey order by l_linenumber, l_partkey, l_suppkey, l_extendedprice) - 1 as r, l_returnflag, l_linestatus, cast(cast(l_quantity as decimal(18,2)) as varchar) as v from lineitem),
 kept as (select *, row_number() over (partition by k order by r) - 1 + case when k % 2 = 0 then 2 else 0 end as s, case when k % 5 = 0 then 1 else 0 end as shift from line where r % 3 <> 2)"""


def _lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    by = Window.partitionBy("k").orderBy("l_linenumber", "l_partkey", "l_suppkey", "l_extendedprice")
    rows = table(spark, sf_dir, "lineitem").withColumn("k", F.col("l_orderkey"))
    return rows.select("k", (F.row_number().over(by) - 1).alias("r"), "l_returnflag", "l_linestatus", F.col("l_quantity").cast("decimal(18,2)").cast("string").alias("v"))


def _two_runs(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The cells of both runs, the label and the value of each line, with ``new``: all come from one pass over the lines."""
    k, r = F.col("k"), F.col("r")
    shift = F.when(k % 5 == 0, 1).otherwise(0)

    def cell(run: str, row, column, text, ident, when=None):
        out = F.struct(F.lit(run == "new").alias("new"), row.cast("int").alias("row_index"), column.cast("int").alias("column_index"), text.alias("raw_text"), ident.alias("raw_cell_id"))
        return out if when is None else F.when(when, out)

    def line(run: str, row, by, value, when=None):
        texts = (F.concat(F.lit("Line  "), r.cast("string")), value)
        return [cell(run, row, c + by, t, F.concat_ws("/", F.lit(run), k, r, F.lit(c)), when) for c, t in enumerate(texts)]

    kept = r - F.floor(r / 3) + F.when(k % 2 == 0, 2).otherwise(0)  # the lines of r % 3 = 2 are left out
    old = line("old", r, F.lit(0), F.col("v"))
    new = line("new", kept, shift, F.when(F.col("l_returnflag") == "R", F.concat("v", F.lit("*"))).otherwise(F.col("v")), r % 3 != 2)
    titles = [cell("new", F.lit(i), shift, F.lit("Schedule"), F.concat_ws("/", F.lit("title"), k, F.lit(i)), (k % 2 == 0) & (r == 0)) for i in range(2)]
    cells = _lines(spark, sf_dir).select("k", F.explode(F.array(*old, *new, *titles)).alias("x")).where("x is not null")
    return cells.select(k.alias("report_id"), F.lit(1).alias("page_number"), F.lit(0).alias("table_index_on_page"), "x.*")


@query(f"""with {_RUNS},
 old as (select k, r, c, case when c = 0 then 'Line ' || r else v end as t, case when r % 3 = 2 then 'gone' end as lost from line, (values (0), (1)) x(c)),
 new as (select k, r, s, c, c + shift as d, case when c = 0 then 'Line ' || r when l_returnflag = 'R' then v || '*' else v end as t from kept, (values (0), (1)) x(c)),
 cell as (
  select o.k as report_id, case when n.k is null then 'gone' when n.t <> o.t then 'changed' when n.s = o.r and n.d = o.c then 'kept' else 'moved' end as kind, o.r as old_row, o.c as old_column, o.t as old_text, n.s as new_row, n.d as new_column, n.t as new_text
  from old o left join new n on n.k = o.k and n.r = o.r and n.c = o.c)
 select * from cell
 union all select k, 'added', null, null, null, x.r, case when k % 5 = 0 then 1 else 0 end, 'Schedule' from (select distinct k from line where k % 2 = 0), (values (0), (1)) x(r)""")
def q_aligned_runs(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = realign.aligned_runs(_two_runs(spark, sf_dir))
    at = {"row": "row_index", "column": "column_index", "text": "symbol"}
    return found.select("report_id", "kind", *[F.col(f"{side}.{c}").alias(f"{side}_{name}") for side in ("old", "new") for name, c in at.items()])


@query(f"""with {_RUNS}
 select k || '/' || r as fact_id, case when r % 3 = 2 then 'gone' when l_returnflag = 'R' then 'changed' when k % 11 = 0 then 'unit' else 'carried' end as outcome,
  case when r % 3 <> 2 and l_returnflag <> 'R' and k % 11 <> 0 then 'new/' || k || '/' || r end as new_fact_id from line where l_linestatus = 'F'""")
def q_carried_facts(spark: SparkSession, sf_dir: str) -> DataFrame:
    k, r, name = F.col("k"), F.col("r"), F.concat_ws("/", "k", "r")

    def fact(new: bool, ident, unit, when):
        run = "new" if new else "old"
        return F.when(when, F.struct(F.lit(new).alias("new"), ident.alias("fact_id"), F.concat(F.lit(f"{run}/"), name, F.lit("/1")).alias("raw_cell_id"), unit.alias("raw_unit")))

    old = fact(False, name, F.lit("pieces"), F.col("l_linestatus") == "F")
    new = fact(True, F.concat(F.lit("new/"), name), F.when(k % 11 == 0, "dozens").otherwise("pieces"), r % 3 != 2)
    facts = _lines(spark, sf_dir).select("k", F.explode(F.array(old, new)).alias("x")).where("x is not null")
    facts = facts.select(k.alias("report_id"), F.lit(1).alias("page_number"), F.lit("quantity").alias("normalized_concept_id"), "x.*")
    return realign.outcomes_on_pages(facts, _two_runs(spark, sf_dir))
