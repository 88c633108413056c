"""Queries of the source normalisers and of model JSON: payloads made of whole tables, and read back."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..functions import text
from ..operators import structured
from ..sources import landed
from .registry import query

_D = "o_orderdate::DATE"
_DATE = "strftime(o_orderdate::DATE, '%Y-%m-%d')"


def _orders(t):
    """Orders with what payloads need: key, day, title."""
    d = F.col("o_orderdate").cast("date")
    key = F.col("o_orderkey").cast("string")
    return t("orders").select("o_orderkey", key.alias("key"), F.date_format(d, "yyyy-MM-dd").alias("day"), F.year(d).alias("y"), F.month(d).alias("m"), F.dayofmonth(d).alias("d"), F.concat(F.lit("<i>Order</i> &amp; "), "o_orderpriority").alias("title"))


@query("src_europe_pmc", f"SELECT o_orderkey, 'Europe PMC' AS source, '10.1/x' || o_orderkey::VARCHAR AS doi, 'Order & ' || o_orderpriority AS title, ['Ann Lee', 'Bo Ray'] AS authors, {_DATE} AS online_date, o_orderkey % 2 = 0 AS open_access, 'https://europepmc.org/article/MED/' || o_orderkey::VARCHAR AS url FROM orders")
def _(t):
    item = F.struct(F.col("key").alias("id"), F.concat(F.lit("10.1/X"), "key").alias("doi"), F.col("title"), F.lit("Ann Lee, Bo Ray").alias("authorString"), F.col("day").alias("firstPublicationDate"), F.when(F.col("o_orderkey") % 2 == 0, "Y").otherwise("N").alias("isOpenAccess"))
    o = _orders(t).select("o_orderkey", F.to_json(F.struct(F.struct(F.array(item).alias("result")).alias("resultList"))).alias("payload"))
    return landed.europe_pmc(o, "payload").select("o_orderkey", "source", "doi", "title", "authors", "online_date", "open_access", "url")


@query("src_crossref", f"SELECT o_orderkey, '10.1/x' || o_orderkey::VARCHAR AS doi, 'Order & ' || o_orderpriority AS title, ['Ann Lee'] AS authors, {_DATE} AS online_date, strftime({_D}, '%Y-%m') AS published_date, {_DATE} AS created_date, (o_orderkey % 30)::INT AS citation_count, 'https://doi.org/10.1/X' || o_orderkey::VARCHAR AS url FROM orders")
def _(t):
    parts = lambda *c: F.struct(F.array(F.array(*c)).alias("date-parts"))
    item = F.struct(
        F.concat(F.lit("10.1/X"), "key").alias("DOI"), F.array("title").alias("title"), F.array(F.struct(F.lit("Ann").alias("given"), F.lit("Lee").alias("family"))).alias("author"), parts("y", "m", "d").alias("published-online"), parts("y", "m").alias("issued"),
        F.struct(F.concat("day", F.lit("T01:02:03Z")).alias("date-time")).alias("created"), (F.col("o_orderkey") % 30).cast("int").alias("is-referenced-by-count"),
    )
    o = _orders(t).select("o_orderkey", F.to_json(F.struct(F.struct(F.array(item).alias("items")).alias("message"))).alias("payload"))
    return landed.crossref(o, "payload").select("o_orderkey", "doi", "title", "authors", "online_date", "published_date", "created_date", "citation_count", "url")


@query("src_semantic_scholar", f"SELECT o_orderkey, '10.1/x' || o_orderkey::VARCHAR AS doi, 'A  study'.replace('  ', ' ') AS title, ['Ann Lee'] AS authors, {_DATE} AS published_date, 'https://x.org/p.pdf' AS open_access_pdf FROM orders")
def _(t):
    item = F.struct(F.struct(F.concat(F.lit("10.1/X"), "key").alias("DOI")).alias("externalIds"), F.lit("A  study").alias("title"), F.array(F.struct(F.lit("Ann Lee").alias("name")), F.struct(F.lit("").alias("name"))).alias("authors"), F.col("day").alias("publicationDate"), F.struct(F.lit("https://x.org/p.pdf").alias("url")).alias("openAccessPdf"))
    o = _orders(t).select("o_orderkey", F.to_json(F.struct(F.array(item).alias("data"))).alias("payload"))
    return landed.semantic_scholar(o, "payload").select("o_orderkey", "doi", "title", "authors", "published_date", "open_access_pdf")


@query("src_openalex", f"SELECT o_orderkey, '10.1/x' || o_orderkey::VARCHAR AS doi, 'the order of the day' AS abstract, 'J' AS journal, {_DATE} AS published_date, true AS open_access, ['openalex_exact'] AS retrieval_channels FROM orders")
def _(t):
    places = F.create_map(F.lit("the"), F.array(F.lit(0), F.lit(3)), F.lit("day"), F.array(F.lit(4)), F.lit("order"), F.array(F.lit(1)), F.lit("of"), F.array(F.lit(2)))
    item = F.struct(F.concat(F.lit("https://doi.org/10.1/X"), "key").alias("doi"), places.alias("abstract_inverted_index"), F.struct(F.struct(F.lit("J").alias("display_name")).alias("source")).alias("primary_location"), F.col("day").alias("publication_date"), F.struct(F.lit(True).alias("is_oa")).alias("open_access"))
    o = _orders(t).select("o_orderkey", F.to_json(F.struct(F.array(item).alias("results"))).alias("payload"))
    return landed.openalex(o, "payload", "exact").select("o_orderkey", "doi", "abstract", "journal", "published_date", "open_access", "retrieval_channels")


@query("src_pubmed", f"SELECT o_orderkey, o_orderkey::VARCHAR AS pmid, '10.1/x' || o_orderkey::VARCHAR AS doi, 'Order ' || o_orderpriority AS title, 'AIM: to order. It was ordered.' AS abstract, ['Ann Lee', 'The Group'] AS authors, {_DATE} AS online_date, strftime({_D}, '%Y-%m') AS print_date, 'https://pubmed.ncbi.nlm.nih.gov/' || o_orderkey::VARCHAR || '/' AS url FROM orders")
def _(t):
    xml = F.concat(
        F.lit("<PubmedArticleSet><PubmedArticle><MedlineCitation><PMID>"), "key", F.lit("</PMID><Article><Journal><Title>J</Title><JournalIssue><PubDate><Year>"), F.col("y").cast("string"), F.lit("</Year><Month>"), F.col("m").cast("string"), F.lit("</Month></PubDate></JournalIssue></Journal><ArticleTitle>Order "),
        F.regexp_extract("title", "&amp; (.*)$", 1), F.lit("</ArticleTitle><Abstract><AbstractText Label=\"AIM\">to order.</AbstractText><AbstractText>It was <i>ordered</i>.</AbstractText></Abstract><AuthorList><Author><LastName>Lee</LastName><ForeName>Ann</ForeName></Author><Author><CollectiveName>The Group</CollectiveName></Author></AuthorList><ArticleDate><Year>"),
        F.col("y").cast("string"), F.lit("</Year><Month>"), F.col("m").cast("string"), F.lit("</Month><Day>"), F.col("d").cast("string"), F.lit("</Day></ArticleDate></Article></MedlineCitation><PubmedData><ArticleIdList><ArticleId IdType=\"pubmed\">"), "key", F.lit("</ArticleId><ArticleId IdType=\"doi\">10.1/X"), "key", F.lit("</ArticleId></ArticleIdList></PubmedData></PubmedArticle></PubmedArticleSet>"),
    )
    # parsing costs far more than reading: a small file that one task reads is dealt first
    o = _orders(t)
    o = o.repartition(int(o.sparkSession.conf.get("spark.sql.shuffle.partitions")), "o_orderkey")
    return landed.pubmed(o.select("o_orderkey", xml.alias("payload")), "payload").select("o_orderkey", "pmid", "doi", "title", "abstract", "authors", "online_date", "print_date", "url")


@query("src_preprints", "SELECT o_orderkey FROM (SELECT o_orderkey, o_orderpriority, row_number() OVER (PARTITION BY o_orderstatus ORDER BY o_orderdate DESC, 'Study of ' || o_orderpriority || ' ' || o_orderkey::VARCHAR) AS n FROM orders) WHERE n <= 300 AND contains(lower(o_orderpriority), 'urgent')")
def _(t):
    """The newest 300 of each server (the feed's capacity) that name the topic."""
    o = t("orders").select("o_orderkey", "o_orderstatus", "o_orderdate", F.concat(F.lit("Study of "), "o_orderpriority", F.lit(" "), F.col("o_orderkey").cast("string")).alias("title"), F.lit("").alias("abstract"))
    return landed.preprints(o, "o_orderstatus", "o_orderdate", ("URGENT", "abc")).select("o_orderkey")


@query("src_rss", f"SELECT o_orderkey, 0::INT AS pos, 'Order & more' AS title, 'https://x.org/' || o_orderkey::VARCHAR AS url, {_DATE} AS published_date, 'see this' AS excerpt, ['https://x.org/' || o_orderkey::VARCHAR, 'https://y.org/a'] AS candidate_urls, 'Daily' AS publisher FROM orders WHERE {_D} BETWEEN DATE '1997-01-01' AND DATE '1997-12-31'")
def _(t):
    mail = F.date_format(F.to_date("day"), "EEE, dd MMM yyyy 08:00:00 'GMT'")
    xml = F.concat(F.lit("<rss><channel><title>feed</title><item><title><![CDATA[Order &amp; more]]></title><link>https://x.org/"), "key", F.lit("</link><pubDate>"), mail, F.lit("</pubDate><description>&lt;a href=\"https://y.org/a\"&gt;see this&lt;/a&gt;</description><source url=\"https://y.org\">Daily</source></item></channel></rss>"))
    day = lambda s: F.lit(s).cast("date")
    return landed.rss(_orders(t).select("o_orderkey", xml.alias("payload")), "payload", "feed", day("1997-01-01"), day("1997-12-31")).select("o_orderkey", "pos", "title", "url", "published_date", "excerpt", "candidate_urls", "publisher")


@query("src_gdelt", f"SELECT o_orderkey, 'A title' AS title, {_DATE} AS published_date, 'en' AS language FROM orders")
def _(t):
    item = F.struct(F.lit("https://x.org").alias("url"), F.lit(" A title").alias("title"), F.concat(F.regexp_replace("day", "-", ""), F.lit("T000000Z")).alias("seendate"), F.lit("English").alias("language"))
    return landed.gdelt(_orders(t).select("o_orderkey", F.to_json(F.struct(F.array(item).alias("articles"))).alias("payload")), "payload").select("o_orderkey", "title", "published_date", "language")


@query("src_reliefweb", f"SELECT o_orderkey, 'A report' AS title, {_DATE} AS published_date, 'WHO, IFRC' AS publisher, 'the body' AS excerpt, true AS official FROM orders")
def _(t):
    fields = F.struct(F.lit("A report").alias("title"), F.lit("<p>the body</p>").alias("body"), F.struct(F.concat("day", F.lit("T00:00:00+00:00")).alias("original")).alias("date"), F.array(F.struct(F.lit("WHO").alias("name")), F.struct(F.lit("IFRC").alias("name"))).alias("source"))
    return landed.reliefweb(_orders(t).select("o_orderkey", F.to_json(F.struct(F.array(F.struct(fields.alias("fields"))).alias("data"))).alias("payload")), "payload").select("o_orderkey", "title", "published_date", "publisher", "excerpt", "official")


@query("src_anchors", "SELECT page_id, pos::INT AS pos, 'https://who.int/news/' || page_id::VARCHAR || '/' || pos::VARCHAR AS url, 'News ' || pos::VARCHAR AS title FROM pages, (SELECT unnest([0, 1]) AS pos)")
def _(t):
    key = F.col("page_id").cast("string")
    page = F.concat(F.lit("<ul><li><a class='n' href='https://who.int/news/"), key, F.lit("/0'><b>News</b> 0</a><a href=\"https://who.int/news/"), key, F.lit("/1\">News 1</a><a href='/about'>About</a></ul>"))
    return landed.anchors(t("pages").select("page_id", page.alias("payload")), "payload", "/news/")


@query("src_page_identity", "SELECT page_id, '10.1234/x' || page_id::VARCHAR AS doi, 'A <title>'.replace('<', '').replace('>', '') AS title, ['Ann Lee', 'Bo Ray'] AS authors, 'J of X' AS journal, 2024::INT AS year FROM pages")
def _(t):
    page = F.concat(F.lit("<head><meta content='10.1234/X"), F.col("page_id").cast("string"), F.lit("' name='citation_doi'><meta name=\"citation_title\" content=\"A title\"><meta name='citation_author' content='Ann Lee'><meta name='citation_author' content='Bo Ray'><meta name='dc.source' content='J of X'><meta name='dc.date' content='2024-05'></head>"))
    return t("pages").select("page_id", landed.page_identity(page, F.lit("https://x.org")).alias("i")).select("page_id", "i.doi", "i.title", "i.authors", "i.journal", "i.year")


@query("src_json_ld", "SELECT page_id, 'Head ' || page_id::VARCHAR AS title, CASE WHEN page_id % 3 = 2 THEN '' ELSE 'the body' END AS body FROM pages")
def _(t):
    k, key = F.col("page_id") % 3, F.col("page_id").cast("string")
    node = F.concat(F.lit('{"@type": "NewsArticle", "headline": "Head '), key, F.when(k == 2, '"}').otherwise('", "articleBody": "the  body"}'))
    data = F.when(k == 0, F.concat(F.lit('{"@graph": [{"@type": "WebSite", "name": "x"}, '), node, F.lit("]}"))).when(k == 1, F.concat(F.lit("["), node, F.lit("]"))).otherwise(node)
    page = F.concat(F.lit('<script>var a = 1</script><script type="application/ld+json">'), data, F.lit("</script>"))
    return t("pages").select("page_id", landed.json_ld(page).alias("x")).select("page_id", "x.*")


@query("src_paragraphs", "SELECT page_id, 'A paragraph that is long enough to be kept, number ' || page_id::VARCHAR || '.' AS body, map {'abstract': 'short one', 'methods': 'Materials we did', 'other': 'Aside a b'} AS sections FROM pages")
def _(t):
    key = F.col("page_id").cast("string")
    one = F.concat(F.lit("<p>A paragraph that is long enough to be kept, number "), key, F.lit(".</p>"))
    xml = F.lit("<article><abstract><p>short one</p></abstract><body><sec><title>Materials</title><p>we did</p></sec><sec><title>Aside</title><p>a <b>b</b></p></sec></body></article>")
    return t("pages").select("page_id", landed.paragraphs(F.concat(F.lit("<nav><p>menu</p></nav>"), one, one, F.lit("<p>short</p>"))).alias("body"), landed.jats_sections(xml).alias("sections"))


# model JSON -------------------------------------------------------------------------------------
@query("jsn_parsed", """SELECT doc_id, CASE doc_id % 4 WHEN 3 THEN NULL WHEN 1 THEN '{"a": ' || doc_id::VARCHAR || ', "b": ["x"], "t": true}' ELSE '{"a": ' || doc_id::VARCHAR || ', "b": ["x"]}' END AS json, ['direct_json', 'balanced_json_trailing_comma_repair', 'direct_json_python_literal_repair', 'context_or_output_limit'][1 + doc_id % 4] AS method FROM documents""")
def _(t):
    """Answers in fences, among words with trailing commas, as Python literals, and cut off."""
    k, key = F.col("doc_id") % 4, F.col("doc_id").cast("string")
    raw = F.when(k == 0, F.concat(F.lit('```json\n{"b": ["x"], "a": '), key, F.lit("}\n```"))).when(k == 1, F.concat(F.lit('Here it is: {"a": '), key, F.lit(', "b": ["x",], "t": true,} as asked'))).when(k == 2, F.concat(F.lit("{'a': "), key, F.lit(", 'b': ['x']}"))).otherwise(F.concat(F.lit('{"a": '), key))
    return t("documents").select("doc_id", structured.parsed(raw).alias("p")).select("doc_id", "p.*")


@query("jsn_fields", "SELECT doc_id, 'we did ' || doc_id::VARCHAR AS value, 'Core-Methods' AS used, 'core_methods' AS key, 'moderate' AS confidence, 'reputable_media' AS source, CASE WHEN lang = '' THEN NULL END AS nothing FROM documents")
def _(t):
    m = F.create_map(F.lit("Other"), F.lit("x"), F.lit("Core-Methods"), F.concat(F.lit("we did "), F.col("doc_id").cast("string")))
    v = structured.find_value(m, "methods", ("methodology", "core_methods"))
    return t("documents").select("doc_id", v["value"].alias("value"), v["key"].alias("used"), structured.field_key(F.lit(" Core-Methods ")).alias("key"), structured.confidence(F.lit("Mid")).alias("confidence"), structured.source_assessment(F.lit("Major Media")).alias("source"), structured.find_value(m, "results")["value"].alias("nothing"))


@query("jsn_refs", "SELECT doc_id, ['S1', 's2', 'X9'] AS refs, ['S1', 'S2', 'X9'] AS canonical FROM documents")
def _(t):
    c = F.when(F.col("doc_id") % 2 == 0, "['S1', 's2', 'X9', 'S1']").otherwise("S1; s2 | X9")
    return t("documents").select("doc_id", structured.parse_refs(c).alias("refs"), structured.canonical_refs(structured.parse_refs(c), F.array(F.lit("S1"), F.lit("S2"))).alias("canonical"))


@query("jsn_issues", """SELECT doc_id, CASE doc_id % 3 WHEN 0 THEN []::VARCHAR[] WHEN 1 THEN ['required_field_missing:methods', 'evidence_ids_missing:methods', 'summary_missing:summary_en', 'invalid_confidence:confidence'] ELSE ['field_too_short:methods', 'evidence_id_unknown:methods'] END AS issues,
 CASE doc_id % 3 WHEN 0 THEN []::VARCHAR[] WHEN 1 THEN ['methods', 'summary_en', 'confidence'] ELSE ['methods'] END AS targets, CASE WHEN doc_id % 3 = 0 THEN 'A long and proper method.' ELSE 'repaired' END AS repaired FROM documents""")
def _(t):
    k = F.col("doc_id") % 3
    value = F.when(k == 0, "A long and proper method.").when(k == 1, " ").otherwise("short")
    analysis, refs = F.create_map(F.lit("methods"), value), F.create_map(F.lit("methods"), F.when(k == 0, F.array(F.lit("S1"))).when(k == 1, text.EMPTY()).otherwise(F.array(F.lit("S7"))))
    found = structured.issues(analysis, refs, ("methods",), F.array(F.lit("S1")), F.when(k == 1, "").otherwise("A summary of it."), F.when(k == 1, "sure").otherwise("high"))
    targets = structured.repair_targets(found, ("methods",))
    return t("documents").select("doc_id", found.alias("issues"), targets.alias("targets"), F.element_at(structured.merge_repair(analysis, F.create_map(F.lit("methods"), F.lit("repaired")), targets), "methods").alias("repaired"))
