"""Queries of merges, joins, budgets, audits, state and query plans over whole tables."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..functions import similarity, text
from ..operators import curation, dedup, querying
from ..operators.order import placed
from ..sources import sinks
from ..streaming import audit as streams
from .registry import clean, query, space, title


# keys and merges --------------------------------------------------------------------------------
@query("dup_paper_key", "SELECT p_partkey, CASE p_partkey % 4 WHEN 0 THEN 'doi:10.1/x' || p_partkey::VARCHAR WHEN 1 THEN 'pmid:' || p_partkey::VARCHAR WHEN 2 THEN 'pmcid:pmc' || p_partkey::VARCHAR ELSE 'title:' || " + title("p_name") + " || '|author:smith j' END AS key FROM part")
def _(t):
    k, key = F.col("p_partkey") % 4, F.col("p_partkey").cast("string")
    return t("part").select("p_partkey", dedup.paper_key(F.when(k == 0, F.concat(F.lit("10.1/X"), key)), F.when(k <= 1, key), F.concat(F.lit("PMC"), F.when(k <= 2, key)), F.col("p_name"), F.lit("Smith, J.")).alias("key"))


@query("dup_authors", "SELECT p_partkey, ['Alice B Smith', 'Bob Jones'] AS authors, 'smith|a' AS key, ['smith', 'jones'] AS families, '1997-02' AS first FROM part")
def _(t):
    names = F.array(F.lit("Smith AB"), F.lit("Bob  Jones"), F.lit(" "), F.lit("Alice B Smith"))
    return t("part").select("p_partkey", dedup.dedup_authors(names).alias("authors"), F.get(dedup.author_key(F.lit("Smith AB")), 0).alias("key"), dedup.families(F.array(F.lit("Alice Smith"), F.lit("J. Smith"), F.lit("Bob Jones"))).alias("families"), dedup.earliest(F.lit("1997-02"), F.lit("1997-02-01")).alias("first"))


@query("dup_merge", f"""WITH k AS (SELECT sha256(lower({clean('text')})) AS key, doc_id AS seq, source, lang, text FROM documents)
SELECT key, min(seq) AS seq, count(*) AS members, arg_max(text, (length({clean('text')}), -seq)) AS abstract, arg_min(lang, seq) FILTER (lang <> '') AS journal, string_agg(DISTINCT source, ',' ORDER BY source) AS sources FROM k GROUP BY key""")
def _(t):
    """Records of one text merged: first non-blank, longest, ordered union, members."""
    d = t("documents").select(F.sha2(F.lower(text.clean_space(F.col("text"))), 256).alias("key"), F.col("doc_id").alias("seq"), F.lit("t").alias("title"), F.col("text").alias("abstract"), F.col("lang").alias("journal"), "source")
    return dedup.merged(d, "key").select("key", "seq", "members", "abstract", "journal", F.array_join(F.array_sort("sources"), ",").alias("sources"))


def _papers(t):
    """Papers of the documents' first sentences: every fourth with an identifier."""
    d = t("documents")
    # cleaning costs far more than reading: a small file that one task reads is dealt first
    d = d.repartition(int(d.sparkSession.conf.get("spark.sql.shuffle.partitions")), "doc_id")
    return d.select(F.col("doc_id").alias("seq"), text.truncate(F.col("text"), 70).alias("title"), F.array(F.concat(F.lit("Ann "), F.coalesce("lang", F.lit("x")))).alias("authors"), F.lit("2024").alias("year"), F.when(F.col("doc_id") % 4 == 0, F.concat(F.lit("10.1/"), (F.col("doc_id") % 50).cast("string"))).alias("doi"), F.col("text").alias("abstract"), "source")


@query("dup_papers")
def _(t):
    """Papers by key, conflicts of title and author apart, then fuzzy leaders (no SQL form: rules applied in order; tests hold
    them against brute force)."""
    return dedup.dedup_papers(_papers(t)).select("paper_id", "seq", "title", "members", F.size("authors").alias("n_authors"))


@query("dup_news")
def _(t):
    """Stories of news (no SQL form; tests hold them against brute force)."""
    d = t("documents").select(F.col("doc_id").alias("seq"), text.truncate(F.col("text"), 70).alias("title"), F.concat(F.lit("https://x.org/"), (F.col("doc_id") % 400).cast("string")).alias("url"), F.lit("2024-01-01").alias("published_date"), F.col("source").alias("publisher"), F.left("text", F.lit(200)).alias("excerpt"), "source")
    return dedup.dedup_news(d).select("seq", "leader", "news_id", "story_url", "snippet_repeats_title")


@query("dup_circuit_breaker", f"""WITH p AS (SELECT page_id, url, length(html) AS n, {title("regexp_extract(html, '<title>([^<]*)', 1)")} AS t, sha256(html) AS h FROM pages), g AS (SELECT *, count(*) OVER (PARTITION BY url) AS c, row_number() OVER (PARTITION BY url ORDER BY n DESC, page_id) AS i FROM p),
k AS (SELECT *, CASE WHEN c = 1 OR i = 1 THEN 'kept' ELSE 'duplicate_content_after_enrichment' END AS s FROM g), v AS (SELECT *, row_number() OVER (PARTITION BY h, s ORDER BY n DESC, page_id) AS j FROM k)
SELECT page_id, CASE WHEN s = 'kept' AND j > 1 THEN 'duplicate_content_after_enrichment' ELSE s END AS status FROM v""")
def _(t):
    """Pages of one address, then of one content, of which titles are alike: the largest stays."""
    p = t("pages").select("page_id", F.col("page_id").alias("seq"), F.lit("The one headline of all").alias("title"), F.col("url").alias("resolved_url"), F.sha2("html", 256).alias("content_hash"), F.lit("full").alias("content_status"), F.length("html").alias("chars"))
    return dedup.circuit_breaker(p).select("page_id", "status")


@query("dup_shared_error", "SELECT p_partkey, CASE WHEN count(*) OVER (PARTITION BY p_size) > 1 THEN 'shared_error_page_suspected' ELSE 'kept' END AS status FROM part")
def _(t):
    """Unlike headlines at one address: all go."""
    p = t("part").select("p_partkey", F.col("p_partkey").alias("seq"), F.sha2(F.col("p_partkey").cast("string"), 256).alias("title"), F.concat(F.lit("https://x.org/"), F.col("p_size").cast("string")).alias("resolved_url"), F.lit("").alias("content_hash"), F.lit("full").alias("content_status"), F.lit(10).alias("chars"))
    return dedup.circuit_breaker(p).select("p_partkey", "status")


@query("jon_attach", "SELECT doc_id, CASE WHEN doc_id % 3 = 0 THEN doc_id WHEN doc_id % 3 = 1 AND doc_id % 2 = 1 THEN doc_id END AS related_seq FROM documents")
def _(t):
    """News with a paper's DOI, or its title; news of events stay apart."""
    code = F.sha2(F.col("doc_id").cast("string"), 256)
    papers = t("documents").select(F.col("doc_id").alias("seq"), F.concat(F.lit("On "), F.left(code, F.lit(30))).alias("title"), F.concat(F.lit("10.1234/x"), F.col("doc_id").cast("string")).alias("doi"))
    k = F.col("doc_id") % 3
    news = t("documents").select("doc_id", F.col("doc_id").alias("seq"), F.when(k == 1, F.concat(F.lit("The on "), F.left(code, F.lit(30)))).otherwise("Something else altogether").alias("title"), F.when(k == 0, F.concat(F.lit("see 10.1234/X"), F.col("doc_id").cast("string"))).when(F.col("doc_id") % 2 == 0, "a new outbreak").otherwise("calm").alias("excerpt"))
    return dedup.attach_news(news, papers).select("doc_id", "related_seq")


@query("jon_identity", "SELECT o_orderkey, CASE WHEN o_orderkey % 5 = 0 THEN 'identity_conflict' WHEN o_orderkey % 5 IN (1, 2) THEN 'identity_verified' WHEN o_orderkey % 5 = 3 THEN 'identity_conflict' ELSE 'identity_uncertain' END AS status, CASE o_orderkey % 5 WHEN 0 THEN 'explicit_identifier_mismatch' WHEN 1 THEN 'shared_identifier' WHEN 2 THEN 'bibliographic_multifactor_match' WHEN 3 THEN 'bibliographic_conflict' ELSE 'insufficient_identity_evidence' END AS reason, CASE WHEN o_orderkey % 5 IN (1, 2) THEN 'filled' END AS journal FROM orders")
def _(t):
    """A completion candidate of an order's record judged and, if verified, merged."""
    k, none = F.col("o_orderkey") % 5, F.lit(None).cast("string")
    ids = (dedup.identifiers(F.lit("10.1/a"), none, none), dedup.identifiers(F.when(k == 0, "10.1/b").when(k == 1, "https://doi.org/10.1/A"), none, none))
    same, other = F.concat(F.lit("A study of "), "o_orderpriority"), F.lit("zz")
    s = dedup.completion_identity(ids, (same, F.when(k.isin(2, 3), same).otherwise(other)), (F.array(F.lit("Ann Lee")), F.array(F.when(k == 2, "A Lee").otherwise("Bo Ray"))), (F.lit("J of X"), F.lit("J of X")), (F.lit(2020), F.when(k == 3, 2010).otherwise(2021)))
    done = dedup.merge_candidate({"journal": none}, {"journal": F.lit("filled")}, s["status"] == "identity_verified")
    return t("orders").select("o_orderkey", s["status"].alias("status"), s["reason"].alias("reason"), done["journal"].alias("journal"))


@query("dup_identity_status", "SELECT user_id, CASE WHEN bool_or(event_type = 'error') THEN 'identity_conflict' ELSE arg_max(event_type, event_id) END AS status FROM events GROUP BY 1")
def _(t):
    e = t("events").withColumn("s", F.when(F.col("event_type") == "error", "identity_conflict").otherwise(F.col("event_type")))
    listed = F.transform(F.array_sort(F.collect_list(F.struct("event_id", "s"))), lambda x: x["s"])
    return e.groupBy("user_id").agg(listed.alias("l")).select("user_id", dedup.identity_status(F.col("l")).alias("status"))


@query("sim_ratios")
def _(t):
    """String similarities of each benchmark item with the next (no SQL form; tests hold them against their definitions)."""
    b = t("benchmark").select("item_id", "text")
    x = b.join(b.select((F.col("item_id") - 1).alias("item_id"), F.col("text").alias("other")), "item_id")
    args = ("text", "other")
    return x.select("item_id", similarity.indel_ratio(*args).alias("indel"), similarity.token_set_ratio(*args).alias("token_set"), similarity.difflib_ratio(*args).alias("difflib"), similarity.sentence_similarity(*args).alias("sentence"))


@query("sim_equal", "SELECT p_partkey, 100.0::DOUBLE AS indel, 100.0::DOUBLE AS token_set, 100.0::DOUBLE AS part, 1.0::DOUBLE AS blocks, 1.0::DOUBLE AS sentence, 0.0::DOUBLE AS none, 200.0 * length(p_name) / (2 * length(p_name) + 4)::DOUBLE AS longer FROM part")
def _(t):
    """Equal, contained and empty strings, and one with four characters more."""
    c, e = F.col("p_name"), F.lit("")
    return t("part").select("p_partkey", similarity.indel_ratio(c, c).alias("indel"), similarity.token_set_ratio(c, F.concat(c, F.lit(" more words"))).alias("token_set"), similarity.partial_ratio(c, F.concat(F.lit("zz"), c, F.lit("yy"))).alias("part"), similarity.block_ratio(c, c).alias("blocks"), similarity.sentence_similarity(c, F.upper(c)).alias("sentence"), similarity.token_set_ratio(c, e).alias("none"), similarity.indel_ratio(c, F.concat(c, F.lit("~~~~"))).alias("longer"))


# budgets ----------------------------------------------------------------------------------------
@query("bud_pack", """WITH RECURSIVE c AS (SELECT conv_id, turn, length(text)::BIGINT + 12 AS n, row_number() OVER (PARTITION BY conv_id ORDER BY turn) AS i FROM (SELECT conv_id, min(turn) AS turn, max(text) AS text FROM conversations GROUP BY conv_id, conversations.turn)),
p(conv_id, i, turn, used, batch) AS (SELECT conv_id, i, turn, n, 0::BIGINT FROM c WHERE i = 1 UNION ALL SELECT c.conv_id, c.i, c.turn, CASE WHEN p.used >= 600 OR p.used + c.n > 600 THEN c.n ELSE p.used + c.n END, CASE WHEN p.used >= 600 OR p.used + c.n > 600 THEN p.batch + 1 ELSE p.batch END FROM p JOIN c ON c.conv_id = p.conv_id AND c.i = p.i + 1)
SELECT conv_id, turn, batch FROM p""")
def _(t):
    c = t("conversations").groupBy("conv_id", "turn").agg(F.length(F.max("text")).alias("n"))
    return curation.pack(c, "conv_id", "turn", "n", 1800, 1200, 12)


@query("bud_completion", """WITH r AS (SELECT row_number() OVER (ORDER BY o_totalprice DESC, o_orderkey) AS place, o_orderstatus = 'F' AS ok FROM orders), b AS (SELECT floor((place - 1) / 25)::BIGINT AS batch, count(*) AS n, count_if(ok)::BIGINT AS ok FROM r GROUP BY 1),
t AS (SELECT batch, n, ok, sum(ok) OVER (ORDER BY batch)::BIGINT AS total FROM b) SELECT batch, n, ok, total, total - ok < 100 AS runs FROM t""")
def _(t):
    o = placed(t("orders").select("o_orderkey", "o_totalprice", (F.col("o_orderstatus") == "F").alias("done")), -F.col("o_totalprice"), [F.col("o_orderkey")])
    return curation.completion(o, "place", F.col("done"), 25, 100)


@query("bud_chunks", f"SELECT doc_id, CASE WHEN length({space('text')}) = 0 THEN 0 END AS n FROM documents WHERE length({space('text')}) = 0")
def _(t):
    """Texts cut between sentences: whole texts that do not lose a character but blanks (rows tell those that would)."""
    d = t("documents").select("doc_id", "text", text.chunks(2600)(F.col("text")).alias("c"))
    bare = lambda c: F.regexp_replace(c, r"(?U)\s", "")
    bad = (F.array_max(F.transform("c", F.length)) > 2600) | (F.length(bare(F.array_join("c", ""))) > F.length(bare(F.col("text"))))
    return d.where(bad | (F.size("c") == 0)).select("doc_id", F.when(F.size("c") == 0, 0).alias("n"))


@query("bud_clip", f"SELECT doc_id, true AS whole FROM documents WHERE {clean('text')} <> '' AND length({clean('text')}) <= 200 AND NOT regexp_matches(text, '…|\\.\\.\\.')")
def _(t):
    """Whole sentences of at most 200 characters: texts that are no longer stay whole."""
    c = text.clean_space(F.col("text"))
    d = t("documents").where((c != "") & (F.length(c) <= 200) & ~F.col("text").rlike(r"…|\.\.\."))
    return d.select("doc_id", c.alias("c"), text.clip_sentences(200)(F.col("text")).alias("x")).select("doc_id", F.col("x").startswith(F.col("c")).alias("whole"))


# audits -----------------------------------------------------------------------------------------
_STATUS = "CASE WHEN event_type IN ('view', 'purchase') THEN 'success' WHEN event_type = 'error' THEN 'failed' ELSE 'skipped' END"
_HEALTH = f"""WITH e AS (SELECT user_id, {_STATUS} AS status, floor(value)::BIGINT AS records FROM events),
s AS (SELECT user_id, count_if(status = 'success')::BIGINT AS ok, count_if(status = 'failed')::BIGINT AS failed, count_if(status = 'skipped')::BIGINT AS skipped, sum(CASE WHEN status = 'success' THEN records ELSE 0 END)::BIGINT AS records FROM e GROUP BY 1),
h AS (SELECT *, CASE WHEN ok > 0 AND records > 0 THEN CASE WHEN failed > 0 THEN 'degraded' ELSE 'healthy' END WHEN ok > 0 THEN 'empty' WHEN skipped > 0 AND failed = 0 THEN 'skipped' ELSE 'failed' END AS health FROM s)"""


def _calls(t):
    status = F.when(F.col("event_type").isin("view", "purchase"), "success").when(F.col("event_type") == "error", "failed").otherwise("skipped")
    return t("events").select("event_id", "user_id", "ts", status.alias("status"), F.floor("value").alias("records"))


@query("agg_source_audit", _HEALTH + " SELECT * FROM h")
def _(t):
    return curation.source_health(_calls(t), "user_id", "status", F.col("records"))


@query("agg_health_counts", _HEALTH + " SELECT " + ", ".join(f"count_if(health = '{h}')::BIGINT AS {h}" for h in ("healthy", "degraded", "empty", "failed", "skipped")) + " FROM h")
def _(t):
    return curation.health_counts(curation.source_health(_calls(t), "user_id", "status", F.col("records")), "health")


@query("agg_funnel", """WITH c AS (SELECT count(*) AS a0, count_if(n_chars >= 300) AS a1, count_if(n_chars >= 300 AND lang = 'en') AS a2, count_if(n_chars >= 300 AND lang = 'en' AND source = 'src0') AS a3 FROM documents),
r AS (SELECT 0 AS pos, 'long' AS stage, a0 AS before, a1 AS after FROM c UNION ALL SELECT 1, 'english', a1, a2 FROM c UNION ALL SELECT 2, 'main_source', a2, a3 FROM c)
SELECT pos::INT AS pos, stage, before, after, before - after AS dropped, before >= 10 AND after < 0.3 * before AS triggered FROM r""")
def _(t):
    return curation.funnel(t("documents"), [("long", F.col("n_chars") >= 300), ("english", F.col("lang") == "en"), ("main_source", F.col("source") == "src0")], 0.3)


@query("agg_severity", "SELECT role, count(*) AS n, count_if(length(text) < 100)::BIGINT AS lost, CASE WHEN count_if(length(text) < 100) >= 0.5 * count(*) THEN 'critical' WHEN count_if(length(text) < 100) >= 0.2 * count(*) THEN 'warning' ELSE 'normal' END AS severity FROM conversations GROUP BY 1")
def _(t):
    c = t("conversations").groupBy("role").agg(F.count("*").alias("n"), F.count_if(F.length("text") < 100).alias("lost"))
    return c.withColumn("severity", curation.severity(F.col("lost"), F.col("n")))


@query("agg_usage", f"""WITH a AS (SELECT user_id::VARCHAR AS provider, event_type AS model, {_STATUS} AS status, floor(value)::BIGINT AS p FROM events)
SELECT provider, model, count(*) AS requests, count_if(status = 'success')::BIGINT AS successes, count_if(status = 'failed')::BIGINT AS failures, sum(p)::BIGINT AS prompt_tokens, (2 * sum(p))::BIGINT AS completion_tokens FROM a GROUP BY GROUPING SETS ((provider, model), (provider))""")
def _(t):
    a = _calls(t).join(t("events").select("event_id", "event_type"), "event_id")
    a = a.select(F.col("user_id").cast("string").alias("provider"), F.col("event_type").alias("model"), "status", F.col("records").alias("prompt_tokens"), (2 * F.col("records")).alias("completion_tokens"))
    return curation.usage(a).drop("whole")


@query("agg_fingerprint", "WITH b AS (SELECT page_id % 64 AS b, sha256(string_agg(sha256(url), '' ORDER BY page_id)) AS h, count(*) AS n FROM pages GROUP BY 1) SELECT sha256(string_agg(h, '' ORDER BY b)) AS fingerprint, sum(n)::BIGINT AS n FROM b")
def _(t):
    """One hash over an ordered table, through 64 buckets."""
    return curation.bundle_hash(t("pages"), "page_id", F.col("url"))


@query("agg_terciles", "WITH r AS (SELECT n_nationkey, row_number() OVER (ORDER BY n_nationkey % 7 DESC, n_nationkey) AS p, (count(*) OVER () + 2) // 3 AS k FROM nation) SELECT n_nationkey, CASE WHEN p <= k THEN 'heavy' WHEN p <= 2 * k THEN 'medium' ELSE 'light' END AS tier FROM r")
def _(t):
    return curation.terciles(t("nation").select("n_nationkey", (F.col("n_nationkey") % 7).alias("score")), "score", "n_nationkey").select("n_nationkey", "tier")


@query("agg_attempts", """WITH a AS (SELECT user_id, CASE WHEN event_type = 'error' THEN 'failed' WHEN event_type = 'purchase' THEN 'success' ELSE 'skipped' END AS s, CASE event_id % 3 WHEN 0 THEN 'timeout' WHEN 1 THEN 'rate_limited' ELSE 'invalid_json' END AS c FROM events WHERE event_id % 5 = 0),
f AS (SELECT user_id, min(CASE c WHEN 'rate_limited' THEN 1 WHEN 'timeout' THEN 2 ELSE 3 END) AS p FROM a WHERE s = 'failed' GROUP BY 1), k AS (SELECT user_id, c, count(*) AS n FROM a WHERE s = 'skipped' GROUP BY 1, 2), q AS (SELECT user_id, c, row_number() OVER (PARTITION BY user_id ORDER BY n DESC, c) AS i FROM k)
SELECT u.user_id, CASE p WHEN 1 THEN 'rate_limited' WHEN 2 THEN 'timeout' WHEN 3 THEN 'invalid_json' ELSE coalesce(c, 'unknown') END AS category FROM (SELECT DISTINCT user_id FROM a) u LEFT JOIN f USING (user_id) LEFT JOIN q ON q.user_id = u.user_id AND q.i = 1""")
def _(t):
    """Of every fifth event as an attempt, each user's most telling failure."""
    k = F.col("event_id") % 3
    a = t("events").where("event_id % 5 = 0").select("user_id", F.when(F.col("event_type") == "error", "failed").when(F.col("event_type") == "purchase", "success").otherwise("skipped").alias("status"), F.when(k == 0, "timeout").when(k == 1, "rate_limited").otherwise("invalid_json").alias("category"))
    return curation.attempt_summary(a, "user_id", "status", "category")


_MESSAGES = (
    ("validation_failed: x", "validation_failed"), ("no VALID json here", "invalid_json"), ("could not parse JSON", "invalid_json"), ("Model is disabled", "model_not_found"), ("HTTP 401", "authentication_failed"), ("Quota exceeded for model: m, limit: 0", "model_quota_exhausted"),
    ("HTTP 429", "rate_limited"), ("402 Payment Required", "quota_exhausted"), ("monthly limit reached", "quota_exhausted"), ("Request timed out", "timeout"), ("maximum context is 8k", "context_or_output_limit"), ("empty response", "empty_response"), ("unknown model x", "model_not_found"),
    ("Unsupported parameter: y", "unsupported_parameter"), ("HTTP 422", "invalid_request"), ("HTTP 503", "provider_unavailable"), ("SSL trouble", "network_error"), ("", "no_provider_configured"), ("[]", "no_provider_configured"), ("odd", "unknown"),
)


@query("sta_failure_taxonomy", f"SELECT event_id, [{', '.join(repr(c) for _, c in _MESSAGES)}][1 + event_id % {len(_MESSAGES)}] AS category FROM events")
def _(t):
    message = F.element_at(F.array(*(F.lit(m) for m, _ in _MESSAGES)), (1 + F.col("event_id") % len(_MESSAGES)).cast("int"))
    return t("events").select("event_id", curation.failure_category(message).alias("category"))


_RUNS = (("exit", "runtime_timeout"), ("Traceback: KeyError", "code_failure"), ("quota is gone", "provider_quota_failure"), ("calm", "llm_attempts_excessive"), ("calm too", "candidate_volume_excessive"), ("calm as well", "unknown_failure"))


@query("agg_run_failure", f"SELECT event_id, [{', '.join(repr(c) for _, c in _RUNS)}][1 + event_id % {len(_RUNS)}] AS reason FROM events")
def _(t):
    k = F.col("event_id") % len(_RUNS)
    log = F.element_at(F.array(*(F.lit(m) for m, _ in _RUNS)), (1 + k).cast("int"))
    return t("events").select("event_id", curation.run_failure(log, F.when(k == 0, 124).otherwise(1), F.lit(10.0), F.when(k == 3, 100), F.lit(0), F.when(k == 4, 800), F.lit(None).cast("int")).alias("reason"))


# state ------------------------------------------------------------------------------------------
@query("sta_baseline", "WITH o AS (SELECT user_id, count(*) AS n FROM events WHERE event_id % 2 = 0 GROUP BY 1), w AS (SELECT user_id, 2 * count(*) AS n FROM events WHERE event_type = 'view' GROUP BY 1) SELECT coalesce(o.user_id, w.user_id) AS user_id, greatest(coalesce(o.n, 0), coalesce(w.n, 0)) AS n FROM o FULL JOIN w ON o.user_id = w.user_id")
def _(t):
    old = t("events").where("event_id % 2 = 0").groupBy("user_id").agg(F.count("*").alias("n"))
    new = t("events").where("event_type = 'view'").groupBy("user_id").agg((2 * F.count("*")).alias("n"))
    return curation.raised_baseline(old, new, ["user_id"], "n")


@query("sta_provider_states", f"""WITH a AS (SELECT user_id, event_id, {_STATUS} AS status, CASE event_id % 4 WHEN 0 THEN 'quota_exhausted' WHEN 1 THEN 'timeout' WHEN 2 THEN 'rate_limited' ELSE 'invalid_json' END AS c FROM events), b AS (SELECT * FROM a WHERE status <> 'skipped'),
s AS (SELECT user_id, count(*) AS requests, count_if(status = 'success')::BIGINT AS successes, count_if(status = 'failed')::BIGINT AS failures, coalesce(max(event_id) FILTER (status = 'success'), -1) AS good, coalesce(max(event_id) FILTER (status = 'failed' AND c = 'quota_exhausted'), -1) AS ended, coalesce(max(event_id) FILTER (status = 'failed' AND c = 'timeout'), -1) AS rested FROM b GROUP BY 1)
SELECT user_id::VARCHAR AS provider, requests, successes, failures, CASE WHEN ended > greatest(good, rested) THEN 'quota_exhausted' WHEN rested > greatest(good, ended) THEN 'cooldown' ELSE 'healthy' END AS status, CASE WHEN rested > greatest(good, ended) THEN rested + 60 END AS cooldown_until FROM s""")
def _(t):
    k = F.col("event_id") % 4
    a = _calls(t).select(F.col("user_id").cast("string").alias("provider"), F.col("event_id").alias("at"), "status", F.when(k == 0, "quota_exhausted").when(k == 1, "timeout").when(k == 2, "rate_limited").otherwise("invalid_json").alias("category"))
    return curation.provider_states(a)


@query("sta_first_success", "SELECT user_id, min(event_id) AS event_id, arg_min(value, event_id) AS value FROM events WHERE event_type = 'purchase' GROUP BY 1")
def _(t):
    return curation.first_success(t("events").select("user_id", "event_id", "value", "event_type"), "user_id", "event_id", F.col("event_type") == "purchase").drop("event_type")


@query("jon_cache", "SELECT doc_id, quality, quality IS NOT NULL AS cache_hit FROM documents LEFT JOIN (SELECT doc_id, any_value(quality) AS quality FROM labels GROUP BY 1) l USING (doc_id)")
def _(t):
    return curation.cached(t("documents").select("doc_id"), t("labels").groupBy("doc_id").agg(F.first("quality").alias("quality")), "doc_id", "quality")


@query("sta_keep_latest", "SELECT user_id, event_id, event_type FROM (SELECT *, row_number() OVER (PARTITION BY user_id ORDER BY event_id DESC) AS place FROM events) WHERE place = 1 ORDER BY event_id DESC LIMIT 100")
def _(t):
    """The newest entry of each key, and of those the newest 100 (the cache's capacity)."""
    return curation.keep_latest(t("events").select("user_id", "event_id", "event_type"), "user_id", "event_id", 100)


@query("snk_capped_cache", "SELECT user_id, event_id, event_type FROM (SELECT *, row_number() OVER (PARTITION BY user_id ORDER BY event_id DESC) AS place FROM events) WHERE place = 1 ORDER BY event_id DESC LIMIT 5000")
def _(t):
    """A cache's newest 5,000 entries (its capacity)."""
    return sinks.capped_cache(t("events").select("user_id", "event_id", "event_type"), "user_id", "event_id")


@query("snk_history_index", "WITH d AS (SELECT DISTINCT o_orderdate::DATE AS d FROM orders) SELECT d::VARCHAR AS issue_date, CASE WHEN d >= DATE '1998-01-01' THEN 'new' ELSE 'old' END AS issue_id FROM d WHERE d < DATE '1998-02-01' OR d >= DATE '1998-01-01' ORDER BY d DESC LIMIT 365")
def _(t):
    """The newest 365 issues (the index's capacity); those of January 1998 are written again."""
    d = t("orders").select(F.col("o_orderdate").cast("date").alias("d")).distinct()
    row = lambda name: (F.col("d").cast("string").alias("issue_date"), F.lit(name).alias("issue_id"), F.lit("p").alias("profile_id"))
    return sinks.upserted_index(d.where("d < date'1998-02-01'").select(*row("old")), d.where("d >= date'1998-01-01'").select(*row("new"))).drop("profile_id")


@query("sta_cache_key", "SELECT doc_id, sha256('v1|' || lang || '|' || source || '|' || sha256(text)) AS key FROM documents")
def _(t):
    return t("documents").select("doc_id", F.sha2(F.concat_ws("|", F.lit("v1"), "lang", "source", F.sha2("text", 256)), 256).alias("key"))


# concepts and query plans -----------------------------------------------------------------------
@query("ann_concepts", "SELECT l_orderkey, string_agg(DISTINCT p_brand, ',' ORDER BY p_brand) AS concepts, count(DISTINCT p_brand) AS n_concepts FROM lineitem JOIN part ON p_partkey = l_partkey GROUP BY 1")
def _(t):
    lines = t("lineitem").select("l_orderkey", F.col("l_partkey").alias("q"))
    return curation.coverage(lines, t("part").select(F.col("p_partkey").alias("q"), "p_brand"), "l_orderkey", "q", "p_brand")


def _concepts(t):
    p = t("part").select(F.col("p_brand").alias("profile"), F.col("p_partkey").alias("pos"), F.col("p_name").alias("scholarly"))
    return querying.core_concepts(p)


_CONCEPTS = """WITH n AS (SELECT p_brand AS profile, p_partkey AS pos, p_name, trim(regexp_replace(lower(p_name), '[^a-z0-9]+', ' ', 'g')) AS k FROM part), d AS (SELECT profile, k, min(pos) AS pos, arg_min(p_name, pos) AS scholarly FROM n GROUP BY 1, 2),
c AS (SELECT *, row_number() OVER (PARTITION BY profile ORDER BY pos) AS place FROM d), k AS (SELECT *, count(*) OVER (PARTITION BY profile) AS n FROM c WHERE place <= 5)"""


@query("qry_core", _CONCEPTS + " SELECT profile, place::INT AS place, 'concept_' || place::VARCHAR AS id, scholarly, n = 5 AS exact FROM k")
def _(t):
    """The first five concepts of each profile (the contract's own number), by their normalised terms."""
    return _concepts(t).select("profile", "place", "id", "scholarly", "exact")


@query("qry_plan", _CONCEPTS + f""", v AS (SELECT * FROM (VALUES {', '.join(f"({i}, '{p}', '{w}')" for i, (p, w) in enumerate(querying.PROVIDERS) if w != 'zh' and not p.endswith('_supplemental'))}) x(rank, provider, way)),
q AS (SELECT profile, place, provider, CASE way WHEN 'semantic' THEN trim(regexp_replace(regexp_replace(scholarly, '[^A-Za-z0-9\\s]', ' ', 'g'), '\\s+', ' ', 'g')) WHEN 'gdelt' THEN CASE WHEN contains(scholarly, ' ') THEN '"' || scholarly || '"' ELSE scholarly END ELSE scholarly END AS query, rank FROM k, v)
SELECT profile, provider || '-' || lpad(row_number() OVER (PARTITION BY profile, provider ORDER BY place)::VARCHAR, 2, '0') AS group_id, provider, 'concept_' || place::VARCHAR AS concept_id, query FROM q""")
def _(t):
    core = _concepts(t)
    none = core.sparkSession.createDataFrame([], "profile string, place int, term string")
    return querying.query_plan(core, none)


@query("qry_supplemental", "WITH n AS (SELECT p_brand AS profile, p_type AS term, min(p_partkey) AS pos FROM part GROUP BY 1, 2) SELECT profile, place, term FROM (SELECT profile, term, row_number() OVER (PARTITION BY profile ORDER BY pos)::INT AS place FROM n) WHERE place <= 8")
def _(t):
    """The first eight further terms of each profile (the contract's own number)."""
    terms = t("part").select(F.col("p_brand").alias("profile"), F.col("p_partkey").alias("pos"), F.col("p_type").alias("term"))
    return querying.supplemental(terms, _concepts(t)).select("profile", "place", "term")


@query("qry_plan_issues", _CONCEPTS + ", x AS (SELECT profile, count(*) AS n FROM k GROUP BY 1 HAVING count(*) <> 5) SELECT profile, 'core concept count must be exactly 5, got ' || n::VARCHAR AS issue FROM x")
def _(t):
    core = _concepts(t)
    none = core.sparkSession.createDataFrame([], "profile string, place int, term string")
    return querying.plan_issues(core, querying.query_plan(core, none))


@query("qry_pubmed_window", """SELECT o_orderkey, '(virus) AND (("1998/01/01"[EPDAT] : "' || strftime(o_orderdate::DATE, '%Y/%m/%d') || '"[EPDAT]) OR ("1998/01/01"[PPDAT] : "' || strftime(o_orderdate::DATE, '%Y/%m/%d') || '"[PPDAT]) OR ("1998/01/01"[PDAT] : "' || strftime(o_orderdate::DATE, '%Y/%m/%d') || '"[PDAT]))' AS term FROM orders""")
def _(t):
    return t("orders").select("o_orderkey", querying.pubmed_window(F.lit("virus"), F.lit("1998-01-01").cast("date"), F.col("o_orderdate").cast("date")).alias("term"))


@query("qry_locations", "SELECT p_partkey, CASE WHEN p_partkey % 2 = 0 THEN ['kenya', 'Rift Valley'] ELSE ['New York City', 'Ghent'] END AS places FROM part")
def _(t):
    said = F.when(F.col("p_partkey") % 2 == 0, "Cases in Rift Valley of Kenya and in the south").otherwise("Deaths within New York City, from Ghent, in The")
    return t("part").select("p_partkey", querying.locations(said).alias("places"))


@query("qry_event_queries", """SELECT place::INT AS place, '"Marburg" ' || loc || ' outbreak 2024' AS query, seq FROM (VALUES (1, 'uganda', 0), (2, 'rwanda', 1), (3, 'kenya', 2), (4, 'ghana', 3)) v(place, loc, seq)""")
def _(t):
    """The first four queries (the plan's own number) that papers about an event suggest."""
    k = F.col("doc_id") % 4
    place = F.when(k == 0, "Uganda").when(k == 1, "Rwanda").when(k == 2, "Kenya").otherwise("Ghana")
    papers = t("documents").select(F.col("doc_id").alias("seq"), F.concat(F.lit("Marburg outbreak 2024 near "), place).alias("title"), F.lit("").alias("abstract"))
    return querying.event_queries(papers, "Marburg", ("Marburg",)).select("place", "query", "seq")


@query("set_contradictions", "WITH r AS (SELECT DISTINCT trim(regexp_replace(lower(p_type), '[^a-z0-9]+', ' ', 'g')) AS term, CASE WHEN p_size < 15 THEN 'identity' WHEN p_size < 30 THEN 'related' ELSE 'hard' END AS role FROM part) SELECT a.role || '_' || b.role AS kind, a.term FROM r a JOIN r b USING (term) WHERE (a.role, b.role) IN (('identity', 'hard'), ('identity', 'related'), ('related', 'hard'))")
def _(t):
    role = F.when(F.col("p_size") < 15, "identity").when(F.col("p_size") < 30, "related").otherwise("hard")
    return querying.contradictions(t("part").select(F.col("p_type").alias("term"), role.alias("role")))


@query("set_without_evidence", "SELECT DISTINCT p_brand AS category, p_name AS term FROM part WHERE p_partkey % 3 = 0 AND lower(p_name) NOT IN (SELECT lower(p_name) FROM part WHERE p_partkey % 3 > 0)")
def _(t):
    p = t("part")
    terms = p.where("p_partkey % 3 = 0").select(F.col("p_brand").alias("category"), F.col("p_name").alias("term")).distinct()
    return querying.without_evidence(terms, p.where("p_partkey % 3 > 0").select(F.upper("p_name").alias("term")))


@query("dup_vocabulary", "WITH a AS (SELECT p_brand AS category, p_partkey AS pos, p_type AS term, lower(p_type) AS k, CASE WHEN p_partkey % 2 = 0 THEN 0 ELSE 1 END AS p FROM part) SELECT category, arg_min(pos, (p, pos)) AS pos, arg_min(term, (p, pos)) AS term FROM a GROUP BY category, k")
def _(t):
    rows = t("part").select(F.col("p_brand").alias("category"), F.col("p_partkey").alias("pos"), F.col("p_type").alias("term"))
    return querying.merged_vocabulary(rows.where("pos % 2 = 0"), rows.where("pos % 2 = 1"))


# windows ----------------------------------------------------------------------------------------
@query("str_window_7d", "SELECT event_type, (DATE '2024-01-01' + (7 * floor(date_diff('day', DATE '2024-01-01', ts::DATE) / 7.0))::INT)::VARCHAR AS week, count(*) AS n FROM events GROUP BY 1, 2")
def _(t):
    return t("events").groupBy("event_type", querying.seven_days(F.col("ts")).cast("string").alias("week")).agg(F.count("*").alias("n"))


@query("str_windowed", "SELECT event_type, time_bucket(INTERVAL 7 DAY, ts::TIMESTAMP, TIMESTAMP '1970-01-01')::VARCHAR AS start, count(*) AS n FROM events GROUP BY 1, 2")
def _(t):
    """The streaming operator over the table as a batch."""
    e = t("events").withColumn("ts", F.col("ts").cast("timestamp"))
    return streams.windowed(e, "ts", ["event_type"]).select("event_type", F.date_format("start", "yyyy-MM-dd HH:mm:ss").alias("start"), "n")


