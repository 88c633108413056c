"""Queries of the text, URL and date scalars over whole tables."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..functions import dates, text, urls
from ..operators import dedup, evidence
from .registry import clean, count, query, space, title

D = "documents"


@query("scl_clean_space", f"SELECT doc_id, {clean('text')} AS clean, length({clean('text')})::INT AS n FROM documents")
def _(t):
    c = text.clean_space(F.col("text"))
    return t(D).select("doc_id", c.alias("clean"), F.length(c).alias("n"))


@query("scl_strip_tags", f"WITH u AS (SELECT page_id, {clean('html')} AS h FROM pages) SELECT page_id, {clean(chr(39).join(['regexp_replace(h, ', '<[^>]+>', ', ', ' ', ', ', 'g', ')']))} AS plain FROM u")
def _(t):
    return t("pages").select("page_id", text.strip_tags(F.col("html")).alias("plain"))


@query("scl_html_escape", "SELECT page_id, replace(replace(replace(replace(replace(html, '&', '&amp;'), '<', '&lt;'), '>', '&gt;'), '\"', '&quot;'), '''', '&#x27;') AS safe FROM pages")
def _(t):
    return t("pages").select("page_id", text.html_escape(F.col("html")).alias("safe"))


_SHOWN = "regexp_replace(html, '(?is)<script\\b.*?</script\\s*>|<style\\b.*?</style\\s*>|<noscript\\b.*?</noscript\\s*>|<template\\b.*?</template\\s*>', '', 'g')"
_SHOWN = f"regexp_replace({_SHOWN}, '<[^>]+>', '', 'g')"


@query("scl_visible_count", f"SELECT page_id, length(regexp_replace({clean(_SHOWN)}, '\\s+', '', 'g'))::INT AS n FROM pages")
def _(t):
    return t("pages").select("page_id", text.visible_text_count(F.col("html")).alias("n"))


_KEY = "o_orderkey::VARCHAR"
_DOI = f"'10.' || (1000 + o_orderkey % 9000)::VARCHAR || '/x' || {_KEY}"


@query("scl_ids", f"SELECT o_orderkey, {_DOI} AS doi, {_KEY} AS pmid, 'PMC' || {_KEY} AS pmcid, map {{'doi': {_DOI}, 'pmid': {_KEY}, 'pmcid': 'PMC' || {_KEY}}}['pmid'] AS by_map FROM orders")
def _(t):
    """Normalised identifiers from their dressed forms."""
    key = F.col("o_orderkey").cast("string")
    bare = F.concat(F.lit("10."), (1000 + F.col("o_orderkey") % 9000).cast("string"), F.lit("/x"), key)
    dressed = F.when(F.col("o_orderkey") % 2 == 0, F.concat(F.lit("https://doi.org/"), F.upper(bare))).otherwise(F.concat(F.lit("doi: "), bare, F.lit(".]")))
    pmid, pmcid = F.concat(F.lit("PMID "), key), F.when(F.col("o_orderkey") % 2 == 0, F.concat(F.lit("pmc "), key)).otherwise(key)
    return t("orders").select("o_orderkey", text.normalize_doi(dressed).alias("doi"), text.normalize_pmid(pmid).alias("pmid"), text.normalize_pmcid(pmcid).alias("pmcid"), F.element_at(dedup.identifiers(dressed, pmid, pmcid), "pmid").alias("by_map"))


@query("scl_extract_doi", f"SELECT o_orderkey, CASE WHEN o_orderkey % 3 > 0 THEN {_DOI} END AS doi FROM orders")
def _(t):
    key = F.col("o_orderkey").cast("string")
    note = F.when(F.col("o_orderkey") % 3 > 0, F.concat(F.lit("see (10."), (1000 + F.col("o_orderkey") % 9000).cast("string"), F.lit("/X"), key, F.lit("). more"))).otherwise(F.concat(F.lit("none 10.1/x"), key))
    return t("orders").select("o_orderkey", text.extract_doi(note).alias("doi"))


_NUMS = f"replace({space('text')}, ',', '')"
for _ in range(2):
    _NUMS = f"regexp_replace({_NUMS}, '([0-9]) ([0-9]{{3}})([^0-9]|$)', '\\1\\2\\3', 'g')"


@query("scl_numbers", f"SELECT doc_id, list_filter(regexp_extract_all({_NUMS}, '[A-Za-z][0-9]|[0-9]+(?:\\.[0-9]+)?%?'), lambda x: NOT regexp_matches(x, '^[A-Za-z]')) AS numbers FROM documents")
def _(t):
    return t(D).select("doc_id", text.extract_numbers(F.col("text")).alias("numbers"))


@query("scl_number_loss", "SELECT conv_id, turn, true AS kept, regexp_matches(text, '[0-9]') = false AS kept_nothing FROM conversations")
def _(t):
    """No number of a text is missing from the text with more behind it; from an empty one all are."""
    c = F.col("text")
    return t("conversations").select("conv_id", "turn", text.numbers_kept(c, F.concat(c, F.lit(" and more"))).alias("kept"), (F.size(text.number_set(c)) == 0).alias("x"), c.alias("y")).select("conv_id", "turn", "kept", (~F.col("y").rlike("[0-9]")).alias("kept_nothing"))


@query("scl_truncate", f"SELECT doc_id, CASE WHEN length({clean('text')}) > 80 THEN rtrim(left({clean('text')}, 79)) || '…' ELSE {clean('text')} END AS short FROM documents")
def _(t):
    return t(D).select("doc_id", text.truncate(F.col("text"), 80).alias("short"))


@query("scl_normalize_title", f"SELECT doc_id, {title('left(text, 200)')} AS title FROM documents")
def _(t):
    return t(D).select("doc_id", text.normalize_title(F.left("text", F.lit(200))).alias("title"))


@query("dup_title_signature", f"SELECT page_id, {title(chr(39).join(['regexp_extract(html, ', '<title>([^<]*)', ', 1)']))} AS sig FROM pages")
def _(t):
    """Titles with version wording added, which goes again."""
    c = F.concat(F.regexp_extract("html", "<title>([^<]*)", 1), F.lit(" (Preprint, version 3)"))
    return t("pages").select("page_id", text.title_signature(c).alias("sig"))


@query("scl_semantic_key", "SELECT doc_id, regexp_replace(lower(text), '[^a-z0-9\\x{4e00}-\\x{9fff}]+', '', 'g') AS skey FROM documents")
def _(t):
    return t(D).select("doc_id", text.semantic_key(F.concat("text", F.lit(" [A1, B22]"))).alias("skey"))


_SAFE = f"regexp_replace({clean('text')}, '(?i)([?&](?:key|api_key|apikey)=)[^&\\s]+', '\\1[REDACTED]', 'g')"


@query("scl_redact_secrets", f"SELECT doc_id, left(regexp_replace({_SAFE}, '(?i)(bearer\\s+)[A-Za-z0-9._~-]+', '\\1[REDACTED]', 'g'), 900) AS safe, 'at ?key=[REDACTED] by Bearer [REDACTED]' AS told FROM documents")
def _(t):
    """Error messages keep their first 900 characters; that is the operator's own bound."""
    message = F.concat(F.lit("at ?key="), F.col("doc_id").cast("string"), F.lit(" by Bearer x"), F.col("doc_id").cast("string"))
    return t(D).select("doc_id", text.redact_secrets(F.col("text")).alias("safe"), text.redact_secrets(message).alias("told"))


@query("scl_slugify", "SELECT p_partkey, regexp_replace(regexp_replace(lower(p_name), '[^a-z0-9]+', '_', 'g'), '^_+|_+$', '', 'g') AS slug FROM part")
def _(t):
    return t("part").select("p_partkey", text.slugify(F.col("p_name")).alias("slug"))


@query("scl_alpha_code", "SELECT o_orderkey, CASE WHEN o_orderkey % 702 < 26 THEN chr((65 + o_orderkey % 702)::INT) ELSE chr((64 + (o_orderkey % 702) // 26)::INT) || chr((65 + (o_orderkey % 702) % 26)::INT) END AS code FROM orders")
def _(t):
    return t("orders").select("o_orderkey", text.alpha_code(F.col("o_orderkey") % 702).alias("code"))


@query("scl_distinct_ci", "SELECT doc_id, CASE WHEN lower(lang) = lower(source) THEN [lang] ELSE [lang, source] END AS kept FROM documents WHERE lang <> '' AND source <> ''")
def _(t):
    rows = t(D).where("lang <> '' and source <> ''")
    return rows.select("doc_id", text.distinct_ci(F.array("lang", F.upper("lang"), F.lit(" "), "source", F.concat(F.lit(" "), "source"))).alias("kept"))


@query("scl_first_nonempty", "SELECT doc_id, CASE WHEN doc_id % 3 = 0 THEN lang ELSE source END AS first, [source] AS listed FROM documents")
def _(t):
    first = text.first_nonempty(F.lit(None).cast("string"), F.when(F.col("doc_id") % 3 == 0, F.col("lang")).otherwise(" "), F.col("source"))
    return t(D).select("doc_id", first.alias("first"), text.ensure_list(F.col("source")).alias("listed"))


# languages --------------------------------------------------------------------------------------
_N = {s: count("text", p) for s, p in text.SCRIPTS.items()}


@query("scl_script_profile", "SELECT doc_id, " + ", ".join(f"{n}::INT AS {s}" for s, n in _N.items()) + " FROM documents")
def _(t):
    return t(D).select("doc_id", text.script_profile(F.col("text")).alias("p")).select("doc_id", "p.*")


_P = "WITH p AS (SELECT doc_id, text, split_part(replace(lower(lang), '_', '-'), '-', 1) AS hint, " + ", ".join(f"{n} AS {s}" for s, n in _N.items()) + " FROM documents)"


@query("scl_language", f"""{_P} SELECT doc_id, CASE WHEN hiragana + katakana > 0 THEN 'ja' WHEN hangul > 0 THEN 'ko' WHEN cyrillic > greatest(2, latin) THEN 'ru' WHEN han >= 2 AND latin < 2 * han THEN CASE WHEN hint = 'ja' THEN 'ja' ELSE 'zh' END
 WHEN hint IN ('en', 'ja', 'zh', 'ko', 'ru') THEN hint WHEN latin >= 3 THEN 'en' ELSE 'und' END AS detected, hint AS normal FROM p""")
def _(t):
    return t(D).select("doc_id", text.detect_language(F.col("text"), F.col("lang")).alias("detected"), text.normalize_language(F.col("lang")).alias("normal"))


@query("flt_verified_english", f"""{_P} SELECT doc_id, trim(text) = '' OR NOT (hiragana + katakana + hangul > 0 OR cyrillic >= 2) AND NOT (han >= 2 AND han >= 0.08 * greatest(1, latin + han)) AND (latin >= 3 OR han + hiragana + katakana + hangul + cyrillic = 0) AS ok,
 {count('text', '[\\x{4e00}-\\x{9fff}]')} >= 12 AND {count('text', '[\\x{4e00}-\\x{9fff}]')} >= 0.28 * {count('text', '[A-Za-z\\x{4e00}-\\x{9fff}]')} AS chinese FROM p""")
def _(t):
    return t(D).select("doc_id", text.verified_english(F.col("text")).alias("ok"), text.adequate_chinese(F.col("text")).alias("chinese"))


# sentences --------------------------------------------------------------------------------------
_PARTS = f"string_split(regexp_replace({clean('text')}, '([.!?。！？]) ', '\\1' || chr(1), 'g'), chr(1))"
_SENTENCES = f"list_filter({_PARTS}, lambda s: length(s) >= 20 AND len(regexp_extract_all(s, '(?:^|[;；])\\s*[A-Za-z0-9][A-Za-z0-9+./_-]{{1,24}}\\s*[:：]')) < 2)"


@query("txt_sentences", f"SELECT doc_id, {_SENTENCES} AS sentences FROM documents")
def _(t):
    """All sentences of whole texts."""
    return t(D).select("doc_id", text.sentences(F.col("text"), None).alias("sentences"))


@query("txt_sentences_50", f"SELECT doc_id, len(({_SENTENCES})[1:50])::INT AS n FROM documents")
def _(t):
    """The first 50 sentences of each text, as the operator's default bound says."""
    return t(D).select("doc_id", F.size(text.sentences(F.col("text"))).alias("n"))


@query("txt_headings", "SELECT conv_id, turn, CASE turn % 3 WHEN 0 THEN 'methods' WHEN 1 THEN 'results' END AS role, trim(text) AS rest FROM conversations WHERE NOT regexp_matches(text, '^[\\s.:-]')")
def _(t):
    c = t("conversations").where(~F.col("text").rlike(r"^[\s.:-]"))
    dressed = F.concat(F.when(F.col("turn") % 3 == 0, "METHODOLOGY: ").when(F.col("turn") % 3 == 1, "Findings - ").otherwise(""), "text")
    return c.select("conv_id", "turn", evidence.heading_role(dressed).alias("role"), evidence.without_heading(dressed).alias("rest"))


@query("bud_token_estimate", "SELECT doc_id, greatest(1, ceil(len(regexp_extract_all(text, '[\\x00-\\x7F]')) / 3.6::DOUBLE + (length(text) - len(regexp_extract_all(text, '[\\x00-\\x7F]'))) / 1.5::DOUBLE))::BIGINT AS tokens FROM documents")
def _(t):
    return t(D).select("doc_id", text.token_estimate(F.col("text")).alias("tokens"))


@query("enr_tokens", "SELECT doc_id, regexp_extract_all(lower(text), '[a-z][a-z0-9_-]{2,}|[\\x{4e00}-\\x{9fff}]{2,}') AS tokens FROM documents")
def _(t):
    return t(D).select("doc_id", dedup.tokens(F.col("text")).alias("tokens"))


_BAG = "list_distinct(regexp_extract_all(lower({0}), '[a-z][a-z0-9_-]{{2,}}|[\\x{{4e00}}-\\x{{9fff}}]{{2,}}'))"


@query("dup_near_sentence", f"""WITH c AS (SELECT conv_id, turn, max(text) AS text FROM conversations GROUP BY 1, 2), p AS (SELECT a.conv_id, a.turn, {_BAG.format('a.text')} AS x, {_BAG.format('b.text')} AS y FROM c a JOIN c b ON a.conv_id = b.conv_id AND b.turn = a.turn + 1)
SELECT conv_id, turn, len(x) > 0 AND len(y) > 0 AND len(list_intersect(x, y)) >= 0.84 * len(list_distinct(list_concat(x, y))) AS near FROM p""")
def _(t):
    """Whether a turn nearly repeats the one before it."""
    c = t("conversations").groupBy("conv_id", "turn").agg(F.max("text").alias("text"))
    after = c.select("conv_id", (F.col("turn") - 1).alias("turn"), F.col("text").alias("next"))
    return c.join(after, ["conv_id", "turn"]).select("conv_id", "turn", dedup.near_duplicate(F.col("text"), F.col("next")).alias("near"))


# urls -------------------------------------------------------------------------------------------
_U = "trim(url)"
_NET = f"regexp_extract({_U}, '^[A-Za-z][A-Za-z0-9+.-]*://([^/?#]*)', 1)"
_HOST = f"lower(regexp_replace(regexp_replace({_NET}, '^.*@', ''), ':[0-9]*$', ''))"
_LABELS = f"string_split(regexp_replace({_HOST}, '^www\\.', ''), '.')"
_PATH = f"regexp_extract({_U}, '^[A-Za-z][A-Za-z0-9+.-]*://[^/?#]*([^?#]*)', 1)"
_QS = f"regexp_extract({_U}, '^[^?#]*\\?([^#]*)', 1)"
_SCHEME = f"lower(regexp_extract({_U}, '^([A-Za-z][A-Za-z0-9+.-]*)://', 1))"


@query("scl_site_key", f"""SELECT page_id, {_HOST} AS host, CASE WHEN len({_LABELS}) >= 3 AND length({_LABELS}[-1]) = 2 AND {_LABELS}[-2] IN ('co','com','org','net','gov','ac') THEN array_to_string({_LABELS}[-3:], '.') ELSE array_to_string({_LABELS}[-2:], '.') END AS site,
 {_HOST} <> '' AS own FROM pages""")
def _(t):
    u = F.col("url")
    return t("pages").select("page_id", urls.host(u).alias("host"), urls.site_key(u).alias("site"), urls.same_site(u, F.concat(u, F.lit("/more"))).alias("own"))


def _kept(drop: str, blanks: bool) -> str:
    own = "p <> ''" if blanks else "regexp_matches(p, '=.')"
    return f"array_to_string(list_filter(string_split({_QS}, '&'), lambda p: {own} AND NOT starts_with(lower(p), 'utm_') AND lower(split_part(p, '=', 1)) NOT IN ({drop})), '&')"


_CANON = _kept("'gclid', 'fbclid', 'ref'", True)
_NEWS = _kept(", ".join(f"'{k}'" for k in urls.TRACKING_NEWS), False)


@query("dup_canonical_url", f"""SELECT page_id, {_SCHEME} || '://' || lower({_NET}) || CASE WHEN rtrim({_PATH}, '/') = '' THEN '/' ELSE rtrim({_PATH}, '/') END || CASE WHEN {_CANON} <> '' THEN '?' || {_CANON} ELSE '' END AS canonical FROM pages""")
def _(t):
    return t("pages").select("page_id", urls.canonical_url(F.col("url")).alias("canonical"))


@query("scl_clean_news_url", f"""SELECT page_id, {_SCHEME} || '://' || {_NET} || {_PATH} || CASE WHEN {_NEWS} <> '' THEN '?' || {_NEWS} ELSE '' END AS cleaned, 'https://x.org/a?b=' || page_id::VARCHAR AS inner_, '' AS none FROM pages""")
def _(t):
    """Addresses without tracking; the destination inside a redirect; nothing of what is no web address."""
    key = F.col("page_id").cast("string")
    redirect = F.concat(F.lit("https://news.google.com/x?hl=en&url=https%3A%2F%2Fx.org%2Fa%3Fb%3D"), key, F.lit("%26utm_source%3Dy%26ocid%3D1#top"))
    return t("pages").select("page_id", urls.clean_news_url(F.col("url")).alias("cleaned"), urls.clean_news_url(redirect).alias("inner_"), urls.clean_news_url(F.concat(F.lit("ftp://"), key)).alias("none"))


@query("src_safe_public", f"SELECT page_id, {_SCHEME} = 'https' AND {_HOST} <> '' AND NOT contains({_NET}, '@') AND NOT regexp_matches({_HOST}, '(^|\\.)(localhost|local|internal|home\\.arpa)$') AS safe, page_id % 4 = 0 AS safe_made FROM pages")
def _(t):
    made = F.when(F.col("page_id") % 4 == 0, "https://8.8.8.8/x").when(F.col("page_id") % 4 == 1, "https://[::1]/x").when(F.col("page_id") % 4 == 2, "https://0.0.0.0:80/").otherwise("https://u:p@x.org/")
    return t("pages").select("page_id", urls.safe_public(F.col("url")).alias("safe"), urls.safe_public(made).alias("safe_made"))


@query("flt_url_kinds", "SELECT page_id, page_id % 3 = 0 AS aggregator, page_id % 3 = 1 AS blocked, page_id % 3 = 2 AS official FROM pages")
def _(t):
    u = F.when(F.col("page_id") % 3 == 0, F.concat(F.lit("https://News.Google.com/"), F.col("url"))).when(F.col("page_id") % 3 == 1, "http://www.W3.org/x").otherwise("https://www.cdc.gov/x")
    return t("pages").select("page_id", urls.aggregator(u).alias("aggregator"), urls.blocked_destination(u).alias("blocked"), urls.official_source(F.lit(False), u).alias("official"))


@query("rnk_candidate_urls", "SELECT page_id, ['https://b.org/' || page_id::VARCHAR, 'https://long.org/' || page_id::VARCHAR || '?q=1', 'https://news.google.com/a'] AS urls FROM pages")
def _(t):
    key = F.col("page_id").cast("string")
    made = [F.lit("https://news.google.com/a"), F.concat(F.lit("https://long.org/"), key, F.lit("?q=1&utm_medium=x#y")), F.concat(F.lit("https://b.org/"), key), F.lit("https://schema.org/x"), F.concat(F.lit("https://b.org/"), key, F.lit("?ocid=2"))]
    return t("pages").select("page_id", urls.candidate_urls(*made).alias("urls"))


# dates ------------------------------------------------------------------------------------------
_O = "o_orderdate::DATE"


def _date(fmt: str):
    return F.date_format(F.col("o_orderdate").cast("date"), fmt)


@query("dat_span", f"""SELECT o_orderkey, CASE o_orderkey % 4 WHEN 0 THEN 'year' WHEN 1 THEN 'month' WHEN 2 THEN 'day' END AS precision, CASE o_orderkey % 4 WHEN 0 THEN date_trunc('year', {_O}) WHEN 1 THEN date_trunc('month', {_O}) WHEN 2 THEN {_O} END::DATE::VARCHAR AS a,
 CASE o_orderkey % 4 WHEN 0 THEN date_trunc('year', {_O}) + INTERVAL 1 YEAR - INTERVAL 1 DAY WHEN 1 THEN last_day({_O}) WHEN 2 THEN {_O} END::DATE::VARCHAR AS b, CASE o_orderkey % 4 WHEN 0 THEN date_trunc('year', {_O}) WHEN 1 THEN date_trunc('month', {_O}) WHEN 2 THEN {_O} END::DATE::VARCHAR AS iso FROM orders""")
def _(t):
    """Dates of each precision inside a text, and impossible ones, which are no date."""
    k = F.col("o_orderkey") % 4
    raw = F.concat(F.lit("published "), F.when(k == 0, _date("yyyy")).when(k == 1, _date("yyyy/M")).when(k == 2, _date("yyyy-MM-dd")).otherwise(F.concat(_date("yyyy"), F.lit("-13-40"))))
    s = dates.span(raw)
    return t("orders").select("o_orderkey", s["precision"].alias("precision"), s["start"].cast("date").cast("string").alias("a"), s["end"].cast("date").cast("string").alias("b"), dates.safe_date_string(raw).alias("iso"))


_W = "DATE '1998-01-01', DATE '1998-06-30'"


@query("flt_date_gate", f"""WITH x AS (SELECT o_orderkey, o_orderkey % 5 AS k, {_O} AS d, CASE WHEN o_orderkey % 5 = 1 THEN date_trunc('month', {_O})::DATE ELSE {_O} END AS a, CASE WHEN o_orderkey % 5 = 1 THEN last_day({_O}) ELSE {_O} END AS b FROM orders),
y AS (SELECT *, CASE WHEN k = 4 THEN 'missing_real_publication_date' WHEN k = 3 THEN 'real_publication_date_too_imprecise' WHEN b < DATE '1998-01-01' THEN 'canonical_publication_date_before_window' WHEN a > DATE '1998-06-30' + INTERVAL 30 DAY THEN 'canonical_publication_date_beyond_future_grace' ELSE 'accepted_canonical_publication_date' END AS reason FROM x)
SELECT o_orderkey, reason = 'accepted_canonical_publication_date' AS accepted, CASE k WHEN 0 THEN 'first_publication_date' WHEN 1 THEN 'online_date' WHEN 2 THEN 'print_date' END AS basis, reason,
 CASE WHEN reason <> 'accepted_canonical_publication_date' THEN 'rejected' WHEN a > DATE '1998-06-30' THEN 'future_scheduled' WHEN k = 1 THEN 'in_window_month_precision' ELSE 'in_window' END AS status FROM y""")
def _(t):
    """The first usable of four dates, in order of trust, against a window with 30 days of grace; year-only dates are passed over."""
    k, day = F.col("o_orderkey") % 5, _date("yyyy-MM-dd")
    fields = {
        "first_publication_date": F.when(k == 0, day).when(k.isin(1, 2, 3), _date("yyyy")), "online_date": F.when(k == 0, F.lit("1990-01-01")).when(k == 1, _date("yyyy-MM")), "published_date": F.when(k == 1, day).when(k == 2, _date("yyyy")),
        "print_date": F.when(k == 2, day), "created_date": day,
    }
    g = dates.assess(fields, F.lit("1998-01-01").cast("date"), F.lit("1998-06-30").cast("date"), 30)
    return t("orders").select("o_orderkey", g.alias("g")).select("o_orderkey", "g.accepted", F.col("g.canonical_basis").alias("basis"), "g.reason", "g.status")


@query("dat_from_parts", f"""SELECT o_orderkey, CASE o_orderkey % 4 WHEN 0 THEN strftime({_O}, '%Y') WHEN 1 THEN strftime({_O}, '%Y-%m') WHEN 2 THEN strftime({_O}, '%Y-%m-%d') END AS made FROM orders""")
def _(t):
    k, d = F.col("o_orderkey") % 4, F.col("o_orderdate").cast("date")
    month = F.when(k == 0, None).when(k == 1, F.date_format(d, "MMM")).when(k == 3, "13").otherwise(F.month(d).cast("string"))
    return t("orders").select("o_orderkey", dates.from_parts(F.year(d).cast("string"), month, F.when(k >= 2, F.dayofmonth(d).cast("string"))).alias("made"))


@query("dat_feed_date", f"SELECT o_orderkey, CASE WHEN o_orderkey % 3 < 2 THEN {_O}::VARCHAR END AS made FROM orders")
def _(t):
    k, d = F.col("o_orderkey") % 3, F.col("o_orderdate").cast("date")
    mail = F.date_format(d, "EEE, dd MMM yyyy 10:00:00 'GMT'")
    return t("orders").select("o_orderkey", dates.feed_date(F.when(k == 0, mail), F.when(k == 1, F.date_format(d, "yyyy-MM-dd'T'00:00:00")).when(k == 2, "soon")).alias("made"))


@query("dat_windows", f"""SELECT o_orderkey, ({_O} - INTERVAL 6 DAY)::DATE::VARCHAR AS a, ({_O} + INTERVAL 90 DAY)::DATE::VARCHAR AS search_end, CASE WHEN o_orderkey % 5 = 0 THEN 30::BIGINT ELSE greatest(0, date_diff('day', {_O}, DATE '1998-01-01')) END::INT AS age,
 o_orderkey % 5 <> 0 AND {_O} BETWEEN DATE '1997-01-01' AND DATE '1997-12-31' OR o_orderkey % 5 = 0 AS news FROM orders""")
def _(t):
    d = F.col("o_orderdate").cast("date")
    raw = F.when(F.col("o_orderkey") % 5 == 0, "undated").otherwise(_date("yyyy-MM-dd"))
    day = lambda s: F.lit(s).cast("date")
    return t("orders").select("o_orderkey", dates.window(d, 7)["start"].cast("string").alias("a"), dates.search_end(d, 90).cast("string").alias("search_end"), dates.days_old(raw, day("1998-01-01")).alias("age"), dates.news_in_window(F.lit("t"), F.lit("u"), raw, day("1997-01-01"), day("1997-12-31")).alias("news"))
