"""Queries of gates, relevance and routing over whole tables."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..operators import entities, evidence, gates, ranking, relevance
from .registry import count, query, space, term, times

#: A topic of words that occur in the corpus, and one whose terms overlap.
TOPIC = entities.Contract(target=("that",), member=("with",), disease=("from",), related=("which", "une"), hard_excluded=("und",), context=("for", "was"), qualified=(("on", ("is", "es")),))
OVERLAP = entities.Contract(target=("of the",), related=("the", "and of the"), hard_excluded=("is the",))
_T, _B = "left(text, 80)", "substr(text, 81)"
_ALL = f"({_T} || ' ' || {_B})"
_ROLES = {"target": ["that"], "member": ["with"], "disease": ["from"], "related": ["which", "une"], "hard": ["und"]}


def _in(e: str, ws: list[str]) -> str:
    return "(" + " OR ".join(term(e, w) for w in ws) + ")"


_FLAGS = ", ".join(f"{_in(e, ws)} AS {p}_{r}" for r, ws in _ROLES.items() for p, e in (("t", _T), ("b", _B)))
_FREQ = " + ".join(f"CASE WHEN {_in(_T, [w])} OR {_in(_B, [w])} THEN {times(_ALL, w)} ELSE 0 END" for w in ("that", "with", "from"))
ASSESS = f"""WITH f AS (SELECT doc_id, source, lang, n_chars, {_FLAGS}, {_in(_ALL, ['for', 'was'])} AS ctx, {_in(_ALL, ['on'])} AND {_in(_ALL, ['is', 'es'])} AS qok, {_in(_ALL, ['on'])} AND NOT {_in(_ALL, ['is', 'es'])} AS qbad, {_FREQ} + CASE WHEN {_in(_ALL, ['on'])} AND {_in(_ALL, ['is', 'es'])} THEN {times(_ALL, 'on')} ELSE 0 END AS freq FROM documents),
g AS (SELECT *, t_target OR t_member OR t_disease AS tid, t_target OR t_member OR t_disease OR b_target OR b_member OR b_disease AS direct, t_related OR b_related AS rel FROM f),
h AS (SELECT *, direct OR qok AS ident, t_hard AND NOT (direct OR qok) AS ht FROM g),
i AS (SELECT *, b_hard AND NOT ident AND NOT rel AND NOT ht AS hb FROM h),
a AS (SELECT *, ht OR hb AS hard, (6 * t_target::INT + 5 * t_member::INT + 4 * t_disease::INT + 3 * (b_target AND NOT t_target)::INT + 2 * (b_member AND NOT t_member)::INT + 2 * (b_disease AND NOT t_disease)::INT
 + CASE WHEN t_related THEN 2 WHEN b_related THEN 1 ELSE 0 END + ctx::INT + 3 * (qok AND NOT direct)::INT - 4 * (qbad AND NOT direct AND NOT rel)::INT - 4 * (ctx AND NOT ident AND NOT rel)::INT - 10 * ht::INT - 7 * hb::INT + (ident AND freq >= 2)::INT) AS score FROM i),
r AS (SELECT *, CASE WHEN hard THEN 'reject' WHEN ident THEN CASE WHEN rel THEN 'review' WHEN score >= 6 OR tid THEN 'accept' WHEN score >= 3 THEN 'review' ELSE 'reject' END WHEN rel THEN 'review' ELSE 'reject' END AS decision FROM a),
q AS (SELECT *, CASE WHEN hard OR ident AND decision = 'reject' THEN 'reject' WHEN ident THEN 'primary_candidate' WHEN rel THEN 'supplementary_related' ELSE 'reject' END AS route FROM r)"""


def assessed(t):
    d = t("documents")
    return relevance.assessed(d, F.left("text", F.lit(80)), F.substring("text", 81, 1 << 30), TOPIC, "x")


@query("rel_assess", ASSESS + " SELECT doc_id, score::INT AS score, decision, route, ident AS identity_present, rel AS related_present, hard AS hard_conflict, freq::INT AS frequency, least(1.0, greatest(0.0, score / 10.0))::DOUBLE AS normal FROM q")
def _(t):
    """Entities of title and body resolved, then the additive score, decision and route."""
    x = F.col("x")
    return assessed(t).select("doc_id", *(x[c].alias(c) for c in ("score", "decision", "route", "identity_present", "related_present", "hard_conflict", "frequency")), relevance.normalised(x["score"]).alias("normal"))


@query("rel_eligibility", ASSESS + " SELECT doc_id, route = 'primary_candidate' AS primary_eligible, route = 'supplementary_related' OR route = 'primary_candidate' AND rel AS supplementary_eligible, ident AND rel OR route = 'supplementary_related' OR qbad AS needs_review FROM q")
def _(t):
    x = F.col("x")
    return assessed(t).select("doc_id", *(x[c].alias(c) for c in ("primary_eligible", "supplementary_eligible", "needs_review")))


@query("rel_annotate", ASSESS + " SELECT doc_id, score::INT AS score, decision, 2::INT AS concepts, 1::INT AS providers FROM q WHERE decision <> 'reject'")
def _(t):
    out = relevance.annotated(t("documents"), "candidate", F.left("text", F.lit(80)), [F.substring("text", 81, 1 << 30)], TOPIC, ("accept", "review"), F.array("lang", "source"), F.array("source", "source"))
    return out.select("doc_id", F.col("relevance_raw_score").alias("score"), F.col("relevance_decision").alias("decision"), F.col("retrieval_concept_count").alias("concepts"), F.col("provider_convergence_count").alias("providers"))


@query("flt_candidate_gate", ASSESS + " SELECT doc_id, decision <> 'reject' OR doc_id % 2 = 0 AND NOT (t_hard OR b_hard) AS kept, CASE WHEN decision = 'reject' AND doc_id % 2 = 0 AND NOT (t_hard OR b_hard) THEN 'metadata_pending' ELSE decision END AS decision FROM q")
def _(t):
    g = relevance.candidate_gate(F.col("x"), F.col("doc_id") % 2 == 0, F.lit(True))
    return assessed(t).select("doc_id", g.alias("g")).select("doc_id", "g.kept", "g.decision")


@query("flt_post_enrichment", ASSESS + """, k AS (SELECT *, doc_id % 7 = 0 AS conflict, doc_id % 5 = 0 AND route <> 'supplementary_related' AS content FROM q),
m AS (SELECT *, route = 'primary_candidate' AND decision <> 'reject' AND NOT content AND NOT conflict AND NOT hard AS p, route = 'supplementary_related' AND NOT conflict AND NOT hard AS s FROM k)
SELECT doc_id, p OR s AS kept, CASE WHEN s THEN 'supplementary_only' WHEN p THEN 'primary_candidate' END AS eligibility, CASE WHEN p OR s THEN NULL WHEN conflict THEN 'identifier_conflict' WHEN hard THEN 'hard_entity_conflict' WHEN content THEN 'content_identity_rejected' WHEN decision = 'reject' THEN 'post_enrichment_relevance_rejected' ELSE 'missing_enriched_evidence' END AS reason FROM m""")
def _(t):
    g = relevance.post_enrichment(F.col("x"), F.col("text"), F.col("doc_id") % 7 == 0, F.col("doc_id") % 5 == 0, F.lit(True))
    return assessed(t).where("trim(text) <> ''").select("doc_id", g.alias("g")).select("doc_id", "g.*")


@query("flt_medium_accept", ASSESS + """, k AS (SELECT *, doc_id % 2 = 0 AS reliable, b_target OR b_member OR b_disease AS bid FROM q)
SELECT doc_id, route = 'primary_candidate' AND ident AND NOT ((t_hard OR b_hard) AND NOT (tid OR bid OR qok)) AND (tid OR bid OR qok OR ctx AND reliable) AND (tid OR reliable OR bid) AS accepted FROM k""")
def _(t):
    return assessed(t).select("doc_id", relevance.deterministic_accept(F.col("x"), F.col("doc_id") % 2 == 0).alias("accepted"))


_TITLE = f"""WITH x AS (SELECT doc_id, {_in(_T, ['that'])} AS tt, {_in(_T, ['with'])} AS tm, {_in(_T, ['from'])} AS td, {_in(_T, ['which', 'une'])} AS rel, {_in(_T, ['und'])} AS hx, {_in(_T, ['for', 'was'])} AS ctx, {_in(_T, ['on'])} AND {_in(_T, ['is', 'es'])} AS qok, {_in(_T, ['on'])} AND NOT {_in(_T, ['is', 'es'])} AS qbad,
 CASE WHEN {_in(_T, ['that'])} THEN {times(_T, 'that')} ELSE 0 END + CASE WHEN {_in(_T, ['with'])} THEN {times(_T, 'with')} ELSE 0 END + CASE WHEN {_in(_T, ['from'])} THEN {times(_T, 'from')} ELSE 0 END + CASE WHEN {_in(_T, ['on'])} AND {_in(_T, ['is', 'es'])} THEN {times(_T, 'on')} ELSE 0 END AS freq FROM documents),
y AS (SELECT *, tt OR tm OR td AS tid, tt OR tm OR td OR qok AS ident FROM x),
z AS (SELECT *, 6 * tt::INT + 5 * tm::INT + 4 * td::INT + 2 * rel::INT + ctx::INT + 3 * (qok AND NOT tid)::INT - 4 * (qbad AND NOT tid AND NOT rel)::INT - 4 * (ctx AND NOT ident AND NOT rel)::INT - 10 * (hx AND NOT ident)::INT + (ident AND freq >= 2)::INT AS score FROM y)"""


@query("flt_accept_field", _TITLE + """ SELECT doc_id, ident AND NOT hx AND (score >= 4 OR tid AND score >= 3) AS l0, ident AND (NOT hx OR tid OR freq >= 2) AND (score >= 3 OR tid AND score >= 2) AS l1, ident AND (NOT hx OR tid OR freq >= 1 AND ctx) AND (score >= 2 OR tid AND score >= 1) AS l2,
 ident AND (NOT hx OR tid AND freq >= 1) AND (tid OR score >= 1 AND freq >= 2) AS l3 FROM z""")
def _(t):
    """The title's assessment at the four levels of relaxation."""
    d = relevance.assessed(t("documents"), F.left("text", F.lit(80)), F.lit(""), TOPIC, "x")
    return d.select("doc_id", *(relevance.accept_field(F.col("x"), "title", level, "paper").alias(f"l{level}") for level in range(4)))


@query("rel_route", ASSESS + """ , l AS (SELECT doc_id, CASE WHEN quality = 1 AND toxic = 0 THEN 'A' WHEN quality = 1 THEN 'S' WHEN toxic = 1 THEN 'N' ELSE 'U' END AS code FROM labels)
SELECT doc_id, code, CASE WHEN code = 'A' THEN 'primary' WHEN code = 'S' THEN 'supplementary' WHEN code = 'N' THEN 'rejected' WHEN decision = 'accept' THEN 'primary' WHEN decision = 'review' THEN 'supplementary' ELSE 'rejected' END AS route FROM q LEFT JOIN l USING (doc_id)""")
def _(t):
    """Reviewers' words become codes and decide; without one, or uncertain, the assessment does."""
    word = F.when((F.col("quality") == 1) & (F.col("toxic") == 0), "accept").when(F.col("quality") == 1, " Related ").when(F.col("toxic") == 1, "n").otherwise("UNCERTAIN")
    decided = t("labels").select("doc_id", relevance.decision_code(word).alias("code"))
    return assessed(t).join(decided, "doc_id", "left").select("doc_id", "code", relevance.route(F.col("code"), F.col("x.decision")).alias("route"))


@query("rel_parse_decisions", "SELECT doc_id::VARCHAR AS id, CASE WHEN quality = 1 THEN 'A' ELSE 'N' END AS code, '0.5' AS confidence, 'why so' AS reason FROM labels WHERE quality IN (0, 1) AND toxic = 0")
def _(t):
    rows = t("labels").where("quality in (0, 1)").distinct()
    word = F.when(F.col("toxic") == 1, "maybe").when(F.col("quality") == 1, "relevant").otherwise("N")
    answer = F.to_json(F.struct(F.array(F.struct(F.col("doc_id").cast("string").alias("id"), word.alias("c"), F.lit("0.5").alias("p"), F.lit("why  so").alias("r"))).alias("d")))
    return relevance.parsed_decisions(rows.select(answer.alias("j")), "j")


@query("rel_review_key", f"SELECT doc_id, sha256('{relevance.POLICY}|paper|fp|' || doc_id::VARCHAR || '|' || {space('text')}) AS key FROM documents")
def _(t):
    return t("documents").select("doc_id", relevance.review_key("paper", F.lit("fp"), [F.lit(" "), F.col("doc_id").cast("string")], [F.col("text")]).alias("key"))


@query("rel_cliff_guard", ASSESS + """ , c AS (SELECT doc_id AS seq, score >= 12 AS accepted, CASE WHEN score >= 5 THEN 1 WHEN score >= 3 THEN 2 WHEN score >= 1 THEN 3 END AS level FROM q),
n AS (SELECT count(*) AS n, count_if(accepted) AS a FROM c),
m AS (SELECT greatest(0, least(n, greatest(CASE WHEN n >= 100 AND a < 10 THEN 10 ELSE 0 END, CASE WHEN n >= 10 AND a < 0.3 * n THEN ceil(n * 15 / 100.0) ELSE 0 END, CASE WHEN n >= 10 AND a < 0.2 * 400 THEN ceil(400 * 20 / 100.0) ELSE 0 END)) - a) AS missing FROM n),
k AS (SELECT seq, row_number() OVER (ORDER BY level, seq) AS place FROM c WHERE NOT accepted AND level IS NOT NULL)
SELECT c.seq, c.accepted, c.level::INT AS level, coalesce(place <= (SELECT missing FROM m), false) AS recovered FROM c LEFT JOIN k USING (seq)""")
def _(t):
    s = F.col("x.score")
    level = F.when(s >= 5, 1).when(s >= 3, 2).when(s >= 1, 3)
    return relevance.cliff_guard(assessed(t).select(F.col("doc_id").alias("seq"), (s >= 12).alias("accepted"), level.alias("level")), 400)


@query("rel_rejections", ASSESS + """ SELECT doc_id, list_concat(CASE WHEN qbad THEN ['ambiguous_abbreviation_without_context'] ELSE [] END, list_concat(CASE WHEN t_hard OR b_hard THEN ['hard_excluded_entity_hit'] ELSE [] END, list_concat(CASE WHEN rel THEN ['related_entity_supplementary_route'] ELSE [] END,
 CASE WHEN NOT ident THEN ['identity_not_established'] ELSE [] END))) || ['score_below_final_threshold'] AS codes FROM q WHERE decision = 'reject'""")
def _(t):
    codes = relevance.rejection_codes(F.col("x"), F.lit(False), F.lit(None).cast("string"), F.lit(None).cast("string"))
    return assessed(t).where("x.decision = 'reject'").select("doc_id", codes.alias("codes"))


@query("ent_resolve")
def _(t):
    """Overlapping terms of three categories resolved in every text (no SQL form; held against a second implementation)."""
    return t("documents").select("doc_id", entities.resolve(OVERLAP)(F.col("text")).alias("found"))


@query("rel_snippets", f"""WITH s AS (SELECT doc_id, string_split(regexp_replace({space('text')}, '([.!?。！？]) ', '\\1' || chr(1), 'g'), chr(1)) AS p FROM documents),
e AS (SELECT doc_id, unnest(p) AS sentence, generate_subscripts(p, 1) AS pos FROM s),
u AS (SELECT doc_id, arg_min(trim(sentence), pos) AS sentence, min(pos) AS pos FROM e WHERE trim(sentence) <> '' GROUP BY doc_id, lower(trim(sentence))),
v AS (SELECT *, 12 * ({_in('sentence', ['that'])}::INT + {_in('sentence', ['with'])}::INT + {_in('sentence', ['from'])}::INT + {_in('sentence', ['on'])}::INT) + 7 * ({_in('sentence', ['which'])}::INT + {_in('sentence', ['une'])}::INT) + 2 * ({_in('sentence', ['for'])}::INT + {_in('sentence', ['was'])}::INT) + 4 * {_in('sentence', ['und'])}::INT AS score FROM u),
w AS (SELECT *, row_number() OVER (PARTITION BY doc_id ORDER BY score DESC, pos) AS place, max(score) OVER (PARTITION BY doc_id) AS best, min(pos) OVER (PARTITION BY doc_id) AS a, max(pos) OVER (PARTITION BY doc_id) AS b FROM v)
SELECT doc_id, place::INT AS place, sentence, score::INT AS score FROM w WHERE score > 0 AND place <= 4 OR best = 0 AND (pos = a OR pos = b)""")
def _(t):
    """The four sentences with most evidence (the operator's own number)."""
    return relevance.snippets(t("documents"), "doc_id", "text", TOPIC)


# gates ------------------------------------------------------------------------------------------
_V = space("text")
_LINES = "list_filter(list_transform(string_split_regex(text, '[\\r\\n]+'), lambda x: trim(regexp_replace(x, '\\s+', ' ', 'g'))), lambda x: x <> '')"
_NAV = " + ".join(f"floor((length(low) - length(replace(low, '{w}', ''))) / {len(w)})" for w in gates.NAVIGATION)
_NAVC = " + ".join(f"{len(w)} * floor((length(low) - length(replace(low, '{w}', ''))) / {len(w)})" for w in gates.NAVIGATION)
_CUT = "string_split(regexp_replace(regexp_replace(v, '([。！？!?])\\s*', '\\1' || chr(1), 'g'), '([.!?])\\s+([A-Z0-9])', '\\1' || chr(1) || '\\2', 'g'), chr(1))"
_BODY = f"""WITH a AS (SELECT doc_id, {_V} AS v, lower({_V}) AS low, {_LINES} AS ls FROM documents),
b AS (SELECT *, length(v) AS n, len(ls) AS lines, {_NAV} AS hits, {_NAVC} AS navc, list_transform(list_filter(ls, lambda x: length(x) BETWEEN 2 AND 180), lambda x: regexp_replace(lower(x), '[^\\p{{L}}\\p{{M}}\\p{{N}}_]+', '', 'g')) AS rs, list_filter({_CUT}, lambda x: length(trim(x)) >= 20) AS ss, {count('v', '[A-Za-z0-9\\x{4e00}-\\x{9fff}]+')} AS tokens FROM a),
c AS (SELECT *, CASE WHEN len(rs) >= 8 THEN (len(rs) - len(list_distinct(rs))) / len(rs)::DOUBLE ELSE 0 END AS dup, CASE WHEN lines >= 8 THEN len(list_filter(ls, lambda x: length(x) < 45)) / lines::DOUBLE ELSE 0 END AS short, len(list_filter(ls, lambda x: length(x) >= 60)) AS paras, coalesce(list_sum(list_transform(ss, lambda x: length(x))), 0) / greatest(1, n)::DOUBLE AS share, least(1.0, navc / greatest(1, n)::DOUBLE) AS nav FROM b)"""


@query("flt_body_diagnostics", _BODY + """ SELECT doc_id, n::INT AS chars, lines::INT AS lines, paras::INT AS paragraphs, len(ss)::INT AS sentences, round(share, 4) AS sentence_ratio, round(nav, 4)::DOUBLE AS navigation_ratio, round(dup, 4) AS duplicate_line_ratio, round(short, 4) AS short_line_ratio,
 list_filter([CASE WHEN n < 300 THEN 'article_too_short' END, CASE WHEN tokens >= 80 AND share < 0.25 AND short > 0.35 THEN 'category_matrix_detected' END, CASE WHEN dup > 0.3 THEN 'duplicate_line_ratio_exceeded' END, CASE WHEN n >= 500 AND (contains(low, 'open in our app') OR contains(low, 'skip to content menu')) THEN 'hard_boilerplate_phrase' END,
  CASE WHEN nav > 0.25 OR hits >= greatest(12, floor(n / 180)) THEN 'navigation_ratio_exceeded' END, CASE WHEN share < 0.35 AND n >= 500 THEN 'sentence_ratio_too_low' END, CASE WHEN short > 0.45 AND lines >= 8 THEN 'short_line_ratio_exceeded' END, CASE WHEN paras < 3 AND n < 1000 THEN 'too_few_article_paragraphs' END], lambda x: x IS NOT NULL) AS reasons FROM c""")
def _(t):
    return t("documents").select("doc_id", gates.body_diagnostics(F.col("text")).alias("x")).select("doc_id", "x.*")


@query("flt_record_type", """SELECT p_partkey, list_filter([CASE WHEN p_partkey % 5 = 0 THEN 'rejected_publication_type' END, CASE WHEN p_partkey % 7 = 0 OR p_partkey % 11 = 0 OR p_partkey % 13 = 0 THEN 'rejected_repository_platform' END, CASE WHEN p_partkey % 3 = 0 THEN 'rejected_non_article_title_cue' END], lambda x: x IS NOT NULL) AS reasons,
 p_partkey % 5 > 0 AND p_partkey % 7 > 0 AND p_partkey % 11 > 0 AND p_partkey % 13 > 0 AND p_partkey % 3 > 0 AS accepted FROM part""")
def _(t):
    k = F.col("p_partkey")
    types, title = F.array(F.when(k % 5 == 0, "Posted_Content Dataset").otherwise("journal-article")), F.concat("p_name", F.when(k % 3 == 0, ": Source Data").otherwise(""))
    g = gates.record_type(types, [F.when(k % 7 == 0, "Zenodo (CERN)").otherwise(F.col("p_brand"))], [F.when(k % 11 == 0, "https://x.figshare.com/1").otherwise("https://journal.org/1")], F.when(k % 13 == 0, "10.5281/ZENODO.1").otherwise("10.1/x"), title)
    return t("part").select("p_partkey", g["reasons"].alias("reasons"), g["accepted"].alias("accepted"))


@query("flt_payload", f"""WITH p AS (SELECT page_id, {space(chr(39).join(['regexp_replace(html, ', '<[^>]+>', ', ', ' ', ', ', 'g', ')']))} AS v, CASE page_id % 6 WHEN 0 THEN 'Sign in to read' WHEN 1 THEN 'Error 404: page not found' WHEN 2 THEN 'Please enable JavaScript' END AS made FROM pages)
SELECT page_id, CASE page_id % 6 WHEN 0 THEN 'login_wall' WHEN 1 THEN 'http_404' WHEN 2 THEN 'javascript_placeholder' WHEN 3 THEN 'http_503' WHEN 4 THEN 'empty_payload' ELSE 'article_like_payload' END AS reason FROM p""")
def _(t):
    k = F.col("page_id") % 6
    c = F.when(k == 0, "Sign in to read").when(k == 1, "Error 404: page not found").when(k == 2, "Please enable JavaScript").when(k == 4, " \n").otherwise("An article about something else entirely.")
    return t("pages").select("page_id", gates.payload_reason(c, F.when(k == 3, 503).otherwise(200)).alias("reason"))


@query("flt_metadata", "SELECT o_orderkey, CASE WHEN o_orderkey % 11 = 0 THEN 'identity_conflict' WHEN o_orderkey % 3 = 0 OR o_orderkey % 5 = 0 THEN 'identity_uncertain' ELSE 'identity_verified' END AS status, CASE WHEN o_orderkey % 11 = 0 AND o_orderkey % 3 > 0 AND o_orderkey % 5 > 0 THEN true ELSE o_orderkey % 3 > 0 AND o_orderkey % 5 > 0 END AS clear FROM orders")
def _(t):
    k, none = F.col("o_orderkey"), F.lit(None).cast("string")
    ids = F.when(k % 2 == 0, F.create_map(F.lit("doi"), F.lit("10.1/x"))).otherwise(F.create_map().cast("map<string,string>"))
    v = gates.metadata_verification(F.when(k % 3 == 0, "The a").otherwise(F.concat(F.lit("Order of "), "o_orderpriority")), F.when(k % 5 == 0, "").otherwise(F.col("o_orderdate").cast("string")), ids, F.array("o_orderpriority", F.lit("x")), none, F.array().cast("array<string>"), none, none, none, k % 11 == 0, none)
    return t("orders").select("o_orderkey", v["status"].alias("status"), (F.size(v["reasons"]) == 0).alias("clear"))


@query("flt_evidence", "SELECT doc_id, CASE WHEN doc_id % 2 = 0 AND NOT (doc_id % 5 = 0 AND doc_id % 3 > 0) THEN 'E2' WHEN doc_id % 3 = 0 THEN 'E1' ELSE 'E0' END AS level FROM documents")
def _(t):
    k = F.col("doc_id")
    e = gates.evidence_status(F.when(k % 3 == 0, "abstract"), F.when(k % 2 == 0, "body"), F.lit("provider"), k % 5 == 0)
    return t("documents").select("doc_id", e["evidence_level"].alias("level"))


@query("sta_news_state", "SELECT doc_id, doc_id % 2 = 0 AS source_qualified, doc_id % 3 > 0 AS analysis_ready, doc_id % 5 = 0 AS translation_complete, doc_id % 2 = 0 AND doc_id % 3 > 0 AS display_ready, CASE WHEN doc_id % 5 = 0 THEN 'complete' WHEN doc_id % 2 = 0 AND doc_id % 3 > 0 THEN 'english_fallback' ELSE 'unavailable' END AS translation_status FROM documents")
def _(t):
    k = F.col("doc_id")
    every = F.map_from_arrays(F.array(*map(F.lit, gates.NEWS_FIELDS)), F.array(*(F.lit("x") for _ in gates.NEWS_FIELDS)))
    partly = F.map_from_arrays(F.array(*map(F.lit, gates.NEWS_FIELDS)), F.array(*(F.lit("x") for _ in gates.NEWS_FIELDS[1:]), F.lit(" ")))
    s = gates.news_state(k % 2 == 0, F.lit("brief"), F.when(k % 3 == 0, partly).otherwise(every), F.lit("t"), F.lit("b"), F.when(k % 5 == 0, every).otherwise(partly), F.lit(False))
    return t("documents").select("doc_id", s.alias("s")).select("doc_id", "s.*")


@query("prj_display_fallback", "SELECT doc_id, CASE WHEN doc_id % 2 = 0 THEN lang ELSE 'en time' END AS time, 'en event' AS event, CASE WHEN doc_id % 2 = 0 THEN 4 ELSE 5 END::INT AS filled FROM documents WHERE lang <> ''")
def _(t):
    zh = F.when(F.col("doc_id") % 2 == 0, F.create_map(F.lit("time"), F.col("lang"))).otherwise(F.create_map(F.lit("event"), F.lit(" ")))
    out = gates.display_fallback(zh, F.create_map(F.lit("time"), F.lit("en time"), F.lit("event"), F.lit("en event")))
    return t("documents").where("lang <> ''").select("doc_id", F.element_at(out["values"], "time").alias("time"), F.element_at(out["values"], "event").alias("event"), F.size(out["filled"]).alias("filled"))


@query("prj_public_text", "SELECT doc_id, 'Kept one. Kept two.' AS shown, doc_id % 2 = 0 AS told FROM documents")
def _(t):
    c = F.concat(F.lit("结论是：Kept one. "), F.when(F.col("doc_id") % 2 == 0, "See the full audit of "). otherwise("The selection policy of "), F.col("doc_id").cast("string"), F.lit(". Kept two."))
    return t("documents").select("doc_id", gates.public_text(c).alias("shown"), gates.operational(F.when(F.col("doc_id") % 2 == 0, c).otherwise("Kept")).alias("told"))


@query("scl_english_only", "SELECT doc_id, 'a plain text' AS a, 'The default.' AS b, ['b'] AS replaced FROM documents")
def _(t):
    m = F.create_map(F.lit("a"), F.lit("a  plain text"), F.lit("b"), F.concat(F.lit("これは日本語です"), F.col("doc_id").cast("string")))
    out = gates.english_only(m, {"b": "The default."})
    return t("documents").select("doc_id", F.element_at(out["values"], "a").alias("a"), F.element_at(out["values"], "b").alias("b"), out["replaced"].alias("replaced"))


# ranking ----------------------------------------------------------------------------------------
_HOT = " + ".join(f"contains(low, '{w}')::INT" for w in ranking.HOTSPOTS)
_QUALITY = ASSESS + f""" , d AS (SELECT q.*, {space('text')} AS v, lower({space('text')}) AS low FROM q JOIN documents USING (doc_id)),
s AS (SELECT *, CASE doc_id % 3 WHEN 0 THEN 18 WHEN 1 THEN 9 ELSE 5 END + CASE WHEN doc_id % 3 = 0 THEN 3 ELSE 0 END AS sp, CASE doc_id % 4 WHEN 0 THEN 24 WHEN 1 THEN 10 ELSE 0 END AS dp, {_HOT} AS hot, doc_id % 40 AS cites, doc_id % 20 AS age FROM d),
y AS (SELECT *, round(36 * least(1.0, greatest(0.0, score / 10.0)) + sp + 4 + least(9.0, 1.5 * hot) + dp + CASE WHEN v <> '' THEN 10 ELSE 0 END + 3 + least(8.0, cites / 10.0) + greatest(0.0, 8 - age * 0.5) - CASE WHEN doc_id % 3 = 2 THEN 5 ELSE 0 END, 3)::DOUBLE AS quality FROM s)"""


def _scored(t):
    k = F.col("doc_id")
    d = assessed(t)
    sources = F.when(k % 3 == 0, F.array(F.lit("PubMed"), F.lit("Crossref"))).when(k % 3 == 1, F.array(F.lit("OpenAlex"))).otherwise(F.array(F.lit("the bioRxiv server")))
    types = F.when(k % 4 == 0, F.array(F.lit("Meta-Analysis"), F.lit("Review"))).when(k % 4 == 1, F.array(F.lit("Review"))).otherwise(F.array(F.lit("Journal Article")))
    published = F.date_format(F.date_sub(F.lit("2024-06-30").cast("date"), (k % 20).cast("int")), "yyyy-MM-dd")
    quality = ranking.paper_quality(relevance.normalised(F.col("x.score")), sources, F.array("lang", "source"), F.lit(""), F.col("text"), types, F.lit(False), F.lit("10.1/x"), k % 40, published, F.lit("2024-06-30").cast("date"))
    d = d.withColumns({"sources": sources, "types": types, "quality": quality, "relevance": relevance.normalised(F.col("x.score")), "published": published})
    return d.withColumn("tier", ranking.paper_tier(F.col("relevance"), F.col("quality"), F.col("sources"), F.col("types"), F.trim("text") != "", F.when(k % 10 == 0, "E2").otherwise("E1"), k % 40, F.lit(0)))


_TIER = "CASE WHEN least(1.0, greatest(0.0, score / 10.0)) >= 0.6 AND v <> '' AND (dp >= 16 OR doc_id % 10 = 0 OR cites >= 20 OR doc_id % 3 < 2 AND quality >= 62) THEN 'A' WHEN least(1.0, greatest(0.0, score / 10.0)) >= 0.6 AND (v <> '' OR doc_id % 3 < 2) THEN 'B' ELSE 'C' END"


@query("rnk_quality", _QUALITY + f" SELECT doc_id, quality, {_TIER} AS tier FROM y")
def _(t):
    return _scored(t).select("doc_id", "quality", "tier")


@query("rnk_rank", _QUALITY + f" SELECT doc_id, row_number() OVER (ORDER BY {_TIER}, quality DESC, (DATE '2024-06-30' - (doc_id % 20)::INT)::VARCHAR DESC, source DESC, doc_id) AS rank FROM y")
def _(t):
    return ranking.ranked(_scored(t), "tier", "quality", "published", "source", "doc_id").select("doc_id", "rank")


@query("rnk_news", f"""WITH d AS (SELECT doc_id, doc_id % 5 AS k, lower({space('text')}) AS low FROM documents)
SELECT doc_id, round(17.5 + CASE k WHEN 0 THEN 45 WHEN 1 THEN 25 WHEN 2 THEN 35 ELSE 8 END + least(15, 3 * (doc_id % 7)) + 2 + least(12, 2 * ({_HOT})) + CASE WHEN doc_id % 2 = 0 THEN 12 ELSE 4 END + greatest(0.0, 8 - (doc_id % 20) * 0.5), 3)::DOUBLE AS quality, CASE WHEN k = 0 THEN 'A' WHEN k IN (1, 2) OR doc_id % 2 = 0 THEN 'B' ELSE 'C' END AS tier FROM d""")
def _(t):
    k = F.col("doc_id") % 5
    url, publisher = F.when(k == 0, "https://www.cdc.gov/x").otherwise("https://news.org/x"), F.when(k == 1, "The University Press").when(k == 2, "ReliefWeb").otherwise("Daily")
    content = F.when(F.col("doc_id") % 2 == 0, "body")
    q = ranking.news_quality(F.lit(0.5), F.lit(False), url, publisher, F.lit("feed"), F.col("doc_id") % 7, F.array("lang"), F.lit(""), F.col("text"), content, F.when(F.col("doc_id") % 2 == 0, "full"), F.date_format(F.date_sub(F.lit("2024-06-30").cast("date"), (F.col("doc_id") % 20).cast("int")), "yyyy-MM-dd"), F.lit("2024-06-30").cast("date"))
    return t("documents").select("doc_id", q.alias("quality"), ranking.news_tier(F.lit(False), url, publisher, F.lit("feed"), content).alias("tier"))


@query("rnk_overview", """WITH o AS (SELECT o_orderkey, o_totalprice, o_orderdate::DATE AS d, o_orderkey % 3 AS k FROM orders)
SELECT o_orderkey, (round(o_totalprice) + CASE k WHEN 0 THEN 55 WHEN 1 THEN 25 ELSE 5 END + CASE WHEN o_orderkey % 7 = 0 THEN -35 WHEN d > DATE '1997-12-31' THEN -70 WHEN d >= DATE '1997-07-01' THEN 120 - 8 * date_diff('day', d, DATE '1997-12-31') ELSE -least(80, 2 * date_diff('day', d, DATE '1997-07-01')) END + CASE k WHEN 0 THEN 22 WHEN 1 THEN 12 ELSE -12 END + 12 + 5 + CASE WHEN o_orderkey % 2 = 0 THEN 25 ELSE 12 END)::DOUBLE AS score FROM o""")
def _(t):
    k = F.col("o_orderkey") % 3
    pick = lambda a, b, c: F.when(k == 0, a).when(k == 1, b).otherwise(c)
    published = F.when(F.col("o_orderkey") % 7 == 0, "undated").otherwise(F.date_format(F.col("o_orderdate").cast("date"), "yyyy-MM-dd"))
    types = F.when(F.col("o_orderkey") % 2 == 0, F.array(F.lit("Systematic Review"))).otherwise(F.array(F.lit("x")))
    s = ranking.overview_score(F.round("o_totalprice"), pick("A", "b", "C"), published, F.lit("1997-07-01").cast("date"), F.lit("1997-12-31").cast("date"), pick("E2", "E1", "E0"), F.array(F.lit("a"), F.lit("A"), F.lit("b")), F.array(F.lit("c")), "literature", F.lit("Research"), types, F.lit(False), F.lit(""))
    return t("orders").select("o_orderkey", s.alias("score"))


@query("rnk_diversified_topk", """SELECT doc_id, source, n_chars FROM (SELECT *, row_number() OVER (PARTITION BY source ORDER BY lang = 'en' DESC, n_chars DESC, doc_id) AS place FROM documents) WHERE place <= 4 ORDER BY lang = 'en' DESC, n_chars DESC, doc_id LIMIT 25""")
def _(t):
    """The best 25 with at most four of a source (the report's own numbers), English ones first."""
    d = t("documents").select("doc_id", "source", "n_chars", "lang")
    return ranking.diversified_top(d, [F.col("n_chars").desc(), F.col("doc_id")], "source", 25, 4, 15, F.col("lang") == "en").drop("lang")


@query("rnk_top_split", """WITH p AS (SELECT o_orderkey, o_totalprice FROM orders WHERE o_orderstatus = 'F' ORDER BY o_totalprice DESC, o_orderkey LIMIT 50),
s AS (SELECT o_orderkey, o_totalprice FROM orders WHERE o_orderpriority <> '5-LOW' AND o_orderkey NOT IN (SELECT o_orderkey FROM p) ORDER BY o_totalprice DESC, o_orderkey LIMIT 100)
SELECT o_orderkey, o_totalprice, 'primary' AS list FROM p UNION ALL SELECT o_orderkey, o_totalprice, 'supplementary' FROM s""")
def _(t):
    o = t("orders").select("o_orderkey", "o_totalprice", "o_orderstatus", "o_orderpriority")
    return ranking.top_split(o, "o_orderkey", F.col("o_orderstatus") == "F", [F.col("o_totalprice").desc(), F.col("o_orderkey")], 50, 100, F.col("o_orderpriority") != "5-LOW").drop("o_orderstatus", "o_orderpriority")


# evidence ---------------------------------------------------------------------------------------
@query("txt_evidence_rows")
def _(t):
    """Every sentence of whole texts with its role (no SQL form: nine cue patterns; tests hold roles against examples)."""
    return evidence.evidence_rows(t("documents"), "doc_id", "text", most=None)


@query("txt_role_carry", """WITH c AS (SELECT conv_id, turn, max(text) AS text FROM conversations GROUP BY 1, 2)
SELECT conv_id, (row_number() OVER (PARTITION BY conv_id ORDER BY turn) - 1)::INT AS pos, CASE WHEN turn >= 2 THEN 'methods' ELSE 'general' END AS role FROM c WHERE turn < 5""")
def _(t):
    """A heading's role carries on to the sentences behind it (those of cues of their own apart)."""
    c = t("conversations").where("turn < 5").groupBy("conv_id", "turn").agg(F.max("text").alias("text"))
    line = F.concat(F.when(F.col("turn") == 2, "METHODS: ").otherwise(""), F.lit("Nnn "), F.col("turn").cast("string"), F.lit(" qqq www eee rrr ttt yyy."))
    joined = c.groupBy("conv_id").agg(F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("turn", line.alias("l")))), lambda x: x["l"]), " ").alias("text"))
    return evidence.evidence_rows(joined, "conv_id", "text").select("conv_id", "pos", "role")


@query("bud_evidence_pack")
def _(t):
    """Balanced evidence packs of 2,500 characters from all sentences (no SQL form; tests hold the choice against brute force)."""
    return evidence.select_rows(evidence.evidence_rows(t("documents"), "doc_id", "text", most=None), "doc_id", 2500)


@query("bud_extract_fields")
def _(t):
    """Fields of a paper stated by single sentences (no SQL form; tests hold scores against examples)."""
    return evidence.extract_fields(evidence.evidence_rows(t("documents"), "doc_id", "text", most=None), "doc_id")
