"""Queries of packets, guards and model lists over whole tables."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..functions import similarity
from ..operators import packets
from . import gating
from .registry import clean, query, space


@query("prj_compact_packet", gating.ASSESS + " SELECT doc_id, doc_id::VARCHAR AS id, route, decision AS py, score::INT AS ps, source AS src, ['virus'] AS q FROM q")
def _(t):
    """The packet's JSON read back."""
    x = gating.assessed(t)
    j = packets.compact_packet(F.col("doc_id"), F.left("text", F.lit(80)), F.col("x"), F.array(F.lit("virus[tiab]")), F.array(F.lit("a")), F.array(F.lit("s")), F.col("source"))
    back = F.from_json(j, "id string, route string, py string, ps int, src string, q array<string>")
    return x.select("doc_id", back.alias("j")).select("doc_id", "j.*")


@query("prj_full_packet", f"SELECT doc_id, {clean('text')} AS evidence FROM documents WHERE len(regexp_extract_all(text, '[.!?。！？]\\s')) < 28")
def _(t):
    """Bodies of up to thirty sentences go whole."""
    d = t("documents").where(F.regexp_count("text", F.lit(r"[.!?。！？]\s")) < 28)
    return d.select("doc_id", packets.full_packet(F.col("text"), F.array(F.lit("x")), True).alias("evidence"))


@query("prj_news_pack", f"SELECT doc_id, length({clean('text')})::INT AS source_char_count, length({clean('text')}) >= 500 AS generate_brief FROM documents")
def _(t):
    return packets.news_pack(t("documents"), "doc_id", "text")[0]


@query("flt_background_guard", gating.ASSESS + """ , bb AS (SELECT *, doc_id % 3 = 0 AS verified, b_target OR b_member OR b_disease AS bid FROM q),
gg AS (SELECT *, route = 'primary_candidate' AND decision = 'accept' AS p, (tid OR qok) AND (bid OR qok) AND (ctx OR freq >= 2) AS e FROM bb)
SELECT doc_id, p AND doc_id % 7 > 0 AND NOT hard AND e AND verified AS accepted, CASE WHEN NOT p THEN 'not_deterministic_primary_accept' WHEN doc_id % 7 = 0 OR hard THEN 'hard_or_identifier_conflict' WHEN NOT e THEN 'insufficient_independent_target_evidence' WHEN NOT verified THEN 'paper_identity_or_evidence_unverified' ELSE 'strong_deterministic_identity_disagrees_with_background_code' END AS reason FROM gg""")
def _(t):
    k = F.col("doc_id")
    g = packets.background_guard("paper", F.col("x"), F.col("x"), k % 7 == 0, k % 3 == 0, F.lit(True))
    return gating.assessed(t).select("doc_id", g.alias("g")).select("doc_id", "g.*")


@query("flt_continuity", "SELECT doc_id, doc_id % 4 < 3 AS eligible FROM documents")
def _(t):
    k, none = F.col("doc_id") % 4, F.lit(None).cast("string")
    return t("documents").select("doc_id", packets.continuity_eligible(k == 0, F.when(k == 1, "10.1/x"), none, none, F.when(k == 2, F.array(F.lit("a"), F.lit("b"))).otherwise(F.array(F.lit("a")))).alias("eligible"))


@query("flt_summary")
def _(t):
    """Summaries that are ones (no SQL form: composed of diagnostics that have one)."""
    return t("documents").select("doc_id", packets.summary_valid(F.left("text", F.lit(400)), F.lit("A headline"), F.lit(False)).alias("valid"))


@query("sta_translator", """WITH a AS (SELECT user_id, event_id, CASE WHEN event_type = 'error' THEN 'network_error' WHEN event_type = 'click' AND user_id % 5 = 0 THEN 'authentication_failed' WHEN event_type IN ('view', 'signup') THEN NULL ELSE 'field_failure' END AS c FROM events), g AS (SELECT user_id, max(event_id) FILTER (c IS NULL) AS good FROM a GROUP BY 1),
s AS (SELECT user_id, count_if(c = 'authentication_failed') AS auth, count_if(c = 'network_error' AND (good IS NULL OR event_id > good)) AS net FROM a JOIN g USING (user_id) GROUP BY 1) SELECT user_id::VARCHAR AS provider, CASE WHEN auth > 0 THEN 'authentication_failed' WHEN net >= 2 THEN 'repeated_network_failure' END AS disabled_reason FROM s""")
def _(t):
    e = F.col("event_type")
    message = F.when(e == "error", "Read timed out").when((e == "click") & (F.col("user_id") % 5 == 0), "Forbidden").otherwise("odd")
    category = F.when(~e.isin("view", "signup"), packets.translation_failure(message, F.lit(500)))
    return packets.translator_states(t("events").select(F.col("user_id").cast("string").alias("provider"), F.col("event_id").alias("at"), category.alias("category")))


@query("jsn_translation", "SELECT doc_id, '译文 ' || doc_id::VARCHAR AS told FROM documents")
def _(t):
    """Answers as text, list, named field, container and single value."""
    k, v = F.col("doc_id") % 5, F.concat(F.lit("译文 "), F.col("doc_id").cast("string"))
    q = F.concat(F.lit('"'), v, F.lit('"'))
    j = F.when(k == 0, v).when(k == 1, F.concat(F.lit('["", '), q, F.lit("]"))).when(k == 2, F.concat(F.lit('{"other": "x", "title": '), q, F.lit("}"))).when(k == 3, F.concat(F.lit('{"fields": {"title": '), q, F.lit('}, "text": "x"}'))).otherwise(F.concat(F.lit('{"anything": '), q, F.lit("}")))
    return t("documents").select("doc_id", packets.translation_value("title")(j).alias("told"))


@query("rnk_models", "SELECT p_brand AS provider, 'm' || (p_partkey % 40)::VARCHAR AS name, row_number() OVER (PARTITION BY p_brand ORDER BY max(p_partkey % 2 = 0) DESC, 'm' || (p_partkey % 40)::VARCHAR)::INT AS place FROM part GROUP BY 1, p_partkey % 40 QUALIFY place <= 30")
def _(t):
    """Each provider's first thirty models (the list's size): named ones first, then by name."""
    m = t("part").select(F.col("p_brand").alias("provider"), F.concat(F.lit("m"), (F.col("p_partkey") % 40).cast("string")).alias("name"), (F.col("p_partkey") % 2 == 0).alias("explicit"), F.lit(True).alias("active"), F.lit(8000).alias("context"))
    return packets.discovered_models(m).select("provider", "name", "place")


@query("rnk_providers", "SELECT n_nationkey, CASE n_nationkey % 3 WHEN 0 THEN 1 WHEN 1 THEN 7 END::BIGINT AS place FROM nation")
def _(t):
    k = F.col("n_nationkey") % 3
    return t("nation").select("n_nationkey", packets.provider_place(F.when(k == 0, "Gemini").when(k == 1, "groq").otherwise("none"), "relevance").alias("place"))


@query("sim_agreement", f"SELECT doc_id, CASE WHEN {space('text')} = '' THEN 0 ELSE 1 END::DOUBLE AS same, 0.0::DOUBLE AS none FROM documents WHERE length(text) < 2000")
def _(t):
    c = F.col("text")
    return t("documents").where("length(text) < 2000").select("doc_id", similarity.agreement({"a": c, "b": F.lit("")}, {"a": c, "b": F.lit("x")}).alias("same"), similarity.agreement({"a": c}, {"b": c}).alias("none"))


@query("prj_excerpt")
def _(t):
    """Excerpts of 1,800 characters of whole texts (no SQL form; a test holds one against the rule)."""
    return t("documents").select("doc_id", packets.excerpt()("text").alias("excerpt"))
