"""Queries of records made ready to publish over whole tables."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..functions import text
from ..operators import evidence, publishing
from .registry import clean, query, space

_D = "strftime(o_orderdate::DATE, '%Y-%m-%d')"


@query("prj_canonical_paper", f"SELECT o_orderkey, CASE WHEN o_orderkey % 2 = 0 THEN '10.1/x' || o_orderkey::VARCHAR END AS doi, 'PMC' || o_orderkey::VARCHAR AS pmcid, 'A title' AS title, ['Ann', 'Bo'] AS authors, 'J' AS journal, ['Crossref', 'PubMed'] AS sources, CASE WHEN o_orderkey % 3 = 0 THEN {_D} ELSE 'later' END AS d, CASE WHEN o_orderkey % 3 = 0 THEN 'online_date' ELSE 'basis' END AS basis FROM orders")
def _(t):
    k, key = F.col("o_orderkey"), F.col("o_orderkey").cast("string")
    day = F.date_format(F.col("o_orderdate").cast("date"), "yyyy-MM-dd")
    rows = t("orders").select("o_orderkey", F.when(k % 2 == 0, F.concat(F.lit("doi:10.1/X"), key)).alias("doi"), key.alias("pmcid"), F.lit(" A  title").alias("title"), F.array(F.lit("Ann"), F.lit("ann"), F.lit("Bo")).alias("authors"), F.lit("").alias("journal"), F.lit("J").alias("venue"), F.array(F.lit("Crossref")).alias("sources"), F.lit("PubMed").alias("source"), F.lit("n/a").alias("first_publication_date"), F.when(k % 3 == 0, day).alias("online_date"), F.lit("later").alias("availability_date"), F.lit("basis").alias("availability_date_basis"))
    return publishing.canonical_paper(rows).select("o_orderkey", "doi", "pmcid", "title", "authors", "journal", "sources", F.col("canonical_publication_date").alias("d"), F.col("canonical_publication_date_basis").alias("basis"))


@query("prj_citation_id", f"SELECT doc_id, CASE doc_id % 4 WHEN 0 THEN '10.1/x' WHEN 1 THEN 'PMID:' || doc_id::VARCHAR WHEN 2 THEN 'PMCID:PMC1' ELSE coalesce(nullif(left({space('text')}, 120), ''), 'unidentified-publication') END AS cite FROM documents")
def _(t):
    k = F.col("doc_id") % 4
    return t("documents").select("doc_id", publishing.citation_id(F.when(k == 0, "10.1/x"), F.when(k == 1, F.col("doc_id").cast("string")), F.when(k == 2, "PMC1").otherwise(" "), F.col("text")).alias("cite"))


@query("prj_supplementary_view", "SELECT doc_id::VARCHAR AS paper_id, source, CASE doc_id % 3 WHEN 0 THEN 'supplementary_related' ELSE 'primary_candidate' END AS relevance_route, CASE doc_id % 3 WHEN 0 THEN 'biologically_related_non_target_entity' WHEN 1 THEN 'relevant_evidence_not_selected_for_primary_top_n' ELSE 'verified_metadata_without_public_abstract_or_full_text' END AS supplementary_reason, CASE doc_id % 3 WHEN 0 THEN 'supplementary_related' ELSE 'metadata_only' END AS display_mode FROM documents")
def _(t):
    k = F.col("doc_id") % 3
    d = t("documents").select(F.col("doc_id").cast("string").alias("paper_id"), "source", F.when(k == 0, "supplementary_related").otherwise("primary_candidate").alias("relevance_route"), F.col("text").alias("full_text"), (k == 1).alias("has"))
    return publishing.supplementary_view(d, publishing.supplementary_reason(F.col("relevance_route"), F.lit(None).cast("string"), F.col("has")))


@query("prj_without_deep", f"SELECT count_if(trim(text) <> '')::BIGINT AS full_text, count_if(doc_id % 2 = 0)::BIGINT AS summary_en FROM documents")
def _(t):
    d = t("documents").select("doc_id", F.col("text").alias("full_text"), F.when(F.col("doc_id") % 2 == 0, "x").alias("summary_en"))
    rest, counts = publishing.without_deep(d)
    assert rest.columns == ["doc_id"]
    return counts


@query("prj_anchor_summary", "SELECT p_partkey, ['virus p' || p_partkey::VARCHAR, 'spread'] AS anchors FROM part")
def _(t):
    q = F.concat(F.lit('("virus"[tiab] AND p'), F.col("p_partkey").cast("string"), F.lit("[MeSH Terms])"))
    return t("part").select("p_partkey", publishing.anchor_summary(F.array(q, q, F.lit(" OR spread"))).alias("anchors"))


_SENT = f"list_filter(list_transform(string_split(regexp_replace({clean('text')}, '([.!?。！？]) ', '\\1' || chr(1), 'g'), chr(1)), lambda s: trim(s)), lambda s: s <> '')"
_UNIQ = "list_filter(s, lambda x, i: list_position(list_transform(s, lambda y: lower(y)), lower(x)) = i)"


@query("prj_evidence_sentences", f"WITH a AS (SELECT doc_id, {_SENT} AS s FROM documents), b AS (SELECT doc_id, {_UNIQ} AS u FROM a) SELECT doc_id, CASE WHEN len(u) <= 30 THEN u ELSE list_concat(u[1:2], u[-3:]) END AS sentences FROM b")
def _(t):
    """All sentences up to thirty, else the first two and the last three (the packet's own numbers)."""
    return t("documents").select("doc_id", publishing.evidence_sentences(F.col("text")).alias("sentences"))


@query("qry_prohibited", "SELECT p_partkey, CASE WHEN p_partkey % 3 = 0 THEN ['transmission', 'vaccine'] ELSE []::VARCHAR[] END AS tokens FROM part")
def _(t):
    term = F.when(F.col("p_partkey") % 3 == 0, "Virus vaccine and transmission").when(F.col("p_partkey") % 3 == 1, "Genomic").otherwise("marburg virus")
    return t("part").select("p_partkey", publishing.prohibited_directions(term).alias("tokens"))


@query("dup_findings", "SELECT p_partkey, ['The virus spread in ' || p_name || '.', 'Something else entirely was seen.'] AS kept FROM part")
def _(t):
    one = F.concat(F.lit("The virus spread in "), "p_name", F.lit("."))
    return t("part").select("p_partkey", publishing.distinct_findings()(F.array(one, F.upper(one), F.lit(""), F.lit("Something else entirely was seen."))).alias("kept"))


@query("jon_supplementary_news", "SELECT o_orderkey FROM orders WHERE o_orderkey % 3 > 0 AND o_orderkey % 5 > 0 ORDER BY o_totalprice DESC, o_orderkey LIMIT 100")
def _(t):
    """News that are not shown and have a title, the first 100 by rank (the list's size)."""
    from ..operators.order import placed

    o = placed(t("orders").select("o_orderkey", "o_totalprice"), -F.col("o_totalprice"), [F.col("o_orderkey")], name="rank")
    c = o.select("o_orderkey", F.col("o_orderkey").cast("string").alias("news_id"), F.when(F.col("o_orderkey") % 5 == 0, " ").otherwise("t").alias("title"), F.lit("2024").alias("published_date"), "rank")
    shown = t("orders").where("o_orderkey % 3 = 0").select(F.col("o_orderkey").cast("string").alias("news_id"))
    return publishing.supplementary_news(c, shown).select("o_orderkey")


@query("jon_schedule", "SELECT n_name AS profile, CASE n_nationkey % 4 WHEN 0 THEN 'scheduled_without_profile' WHEN 1 THEN 'profile_not_scheduled' ELSE 'scheduled_twice' END AS issue FROM nation WHERE n_nationkey % 4 < 3")
def _(t):
    n = t("nation").withColumn("k", F.col("n_nationkey") % 4)
    row = n.select(F.lit(1).alias("day"), F.col("n_nationkey").alias("pos"), F.col("n_name").alias("profile"), "k")
    schedule = row.where("k <> 1").unionByName(row.where("k = 2")).drop("k")
    return publishing.schedule_mismatches(schedule, n.where("k <> 0").select(F.col("n_name").alias("profile")))


@query("snk_portal", "SELECT n_nationkey AS pos, n_name AS profile, (DATE '2024-01-01' + n_nationkey::INT)::VARCHAR AS issue_date FROM nation")
def _(t):
    n = t("nation")
    schedule = n.select(F.lit(1).alias("day"), F.col("n_nationkey").alias("pos"), F.col("n_name").alias("profile"))
    issues = n.select(F.col("n_name").alias("profile"), F.explode(F.array(F.lit(0), F.lit(-3))).alias("x"), "n_nationkey").select("profile", F.date_add(F.lit("2024-01-01").cast("date"), (F.col("n_nationkey") + F.col("x")).cast("int")).cast("string").alias("issue_date"))
    return publishing.portal(schedule, issues).select("pos", "profile", "issue_date")


@query("agg_review_summary", "SELECT 'method' AS kind, CASE WHEN event_id % 2 = 0 THEN 'cache' ELSE 'not_recorded' END AS value, count(*) AS n FROM events GROUP BY 2 UNION ALL SELECT 'decision', event_type, count(*) FROM events GROUP BY 2 UNION ALL SELECT 'cache', 'not_used', count(*) FROM events")
def _(t):
    e = t("events").select(F.when(F.col("event_id") % 2 == 0, "cache").otherwise(" ").alias("m"), F.col("event_type").alias("d"), F.lit(None).cast("string").alias("c"))
    return publishing.review_summary(e, "m", "d", "c")


@query("agg_group_summary", "SELECT event_type, count(*) AS analyzable, count_if(event_id % 3 = 0)::BIGINT AS fallback, round(count_if(event_id % 3 = 0) / count(*)::DOUBLE, 4) AS fallback_ratio FROM events WHERE event_id % 7 > 0 GROUP BY 1")
def _(t):
    e = t("events").select("event_type", F.when(F.col("event_id") % 7 == 0, "not_applicable").when(F.col("event_id") % 3 == 0, "fallback_source_extract").otherwise("ok").alias("s"))
    return publishing.group_summary(e, "event_type", "s")


@query("agg_continuity", "SELECT o_orderkey, CASE WHEN o_orderkey % 2 = 0 THEN 'standard' WHEN o_orderkey % 10 >= 5 THEN 'recovered_output' WHEN o_orderkey % 10 > 0 THEN 'below_target' ELSE 'empty_valid_issue' END AS status, CASE WHEN o_orderkey % 10 >= 5 THEN 'primary_target_reached' WHEN o_orderkey % 3 = 0 THEN 'candidate_exhausted' ELSE 'completion_budget_exhausted' END AS stop FROM orders")
def _(t):
    k = F.col("o_orderkey")
    return t("orders").select("o_orderkey", publishing.continuity(k % 10, F.lit(5), k % 2 == 1).alias("status"), publishing.completion_stop(k % 10, F.lit(5), F.when(k % 3 == 0, 7).otherwise(6), F.lit(7)).alias("stop"))


@query("flt_render_findings", "SELECT page_id, 'critical' AS severity, 'empty_title' AS code FROM pages WHERE page_id % 3 = 0 UNION ALL SELECT page_id, 'warning', 'long' FROM pages WHERE length(html) > 500")
def _(t):
    p = t("pages").select("page_id", F.when(F.col("page_id") % 3 > 0, "t").alias("title"), "html")
    return publishing.findings(p, [("critical", "empty_title", text.blank(F.col("title"))), ("warning", "long", F.length("html") > 500)], "page_id")


@query("scl_placeholders", "SELECT p_partkey, 11 / (12 + length(p_name))::DOUBLE AS share FROM part")
def _(t):
    return t("part").select("p_partkey", publishing.placeholder_coverage(F.concat(F.lit("Unavailable "), "p_name"), ("unavailable",)).alias("share"))


@query("bud_ladder", "WITH d AS (SELECT *, coalesce(sum(length(text)) OVER (PARTITION BY conv_id ORDER BY turn % 3, turn DESC ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS before FROM (SELECT conv_id, turn, max(text) AS text FROM conversations GROUP BY 1, 2)) SELECT conv_id, turn, 900 - before > 600 AS applied FROM d")
def _(t):
    c = t("conversations").groupBy("conv_id", "turn").agg(F.max("text").alias("text")).select("conv_id", "turn", (F.col("turn") % 3).alias("step"), F.col("turn").alias("pos"), F.length("text").alias("saved"))
    return publishing.budget_ladder(c, "conv_id", F.lit(900), 600).select("conv_id", "turn", "applied")


@query("bud_truncated", "SELECT count_if(length(text) > 120)::BIGINT AS text, count_if(length(lang) > 1)::BIGINT AS lang FROM documents")
def _(t):
    return publishing.truncated_fields(t("documents").select("text", "lang"), {"text": 120, "lang": 1})[1]


@query("bud_attempts", "WITH r AS (SELECT o_orderkey, row_number() OVER (ORDER BY o_totalprice DESC, o_orderkey) AS place, o_orderstatus = 'F' AS ok FROM orders QUALIFY place <= 150), d AS (SELECT *, coalesce(sum(ok::INT) OVER (ORDER BY place ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS done FROM r) SELECT o_orderkey, place::INT AS place FROM d WHERE done < 50")
def _(t):
    """At most 150 attempts until 50 have succeeded (the queue's own numbers)."""
    o = t("orders").select("o_orderkey", "o_totalprice", "o_orderstatus")
    return publishing.attempt_queue(o, [F.col("o_totalprice").desc(), F.col("o_orderkey")], F.col("o_orderstatus") == "F", 150, 50).select("o_orderkey", "place")


@query("txt_paper_kind", "SELECT doc_id, CASE WHEN doc_id % 3 = 0 THEN 'review' ELSE 'research' END AS kind, CASE WHEN doc_id % 3 = 2 THEN 'research' ELSE 'review' END AS voted FROM documents")
def _(t):
    k = F.col("doc_id") % 3
    title = F.when(k == 0, "A systematic review").when(k == 1, "A cohort and a cohort, a perspective, a commentary").otherwise("A cohort in a trial")
    none = text.EMPTY()
    terms = {"research": ("cohort", "trial"), "narrative_review": ("perspective", "review", "commentary")}
    return t("documents").select("doc_id", evidence.paper_kind(none, title, F.lit("")).alias("kind"), evidence.paper_kind(none, title, F.lit(""), terms).alias("voted"))


@query("set_difference", "SELECT doc_id FROM documents WHERE doc_id NOT IN (SELECT doc_id FROM labels WHERE quality = 1)")
def _(t):
    """Pending rows: those that are not accepted yet."""
    return t("documents").select("doc_id").join(t("labels").where("quality = 1").select("doc_id"), "doc_id", "left_anti")


@query("set_union", "SELECT page_id AS id, 0 AS provider_rank FROM pages UNION ALL SELECT item_id, 1 FROM benchmark UNION ALL SELECT doc_id, 2 FROM documents")
def _(t):
    """Providers' rows in a fixed order of providers."""
    parts = [t("pages").select(F.col("page_id").alias("id")), t("benchmark").select(F.col("item_id").alias("id")), t("documents").select(F.col("doc_id").alias("id"))]
    out = [p.withColumn("provider_rank", F.lit(i)) for i, p in enumerate(parts)]
    return out[0].unionByName(out[1]).unionByName(out[2])
