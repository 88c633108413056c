"""Normalisers of landed provider payloads (a column of JSON, XML or HTML) to canonical records.

Each takes a table with the payload of one response a row and gives one row a record, with its place (pos). Fields that a
payload lacks are null or empty; a payload that does not parse gives no rows. Further columns of the table stay.
"""

from __future__ import annotations

from xml.parsers import expat

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.functions import pandas_udf
from pyspark.sql.types import BooleanType, StringType, StructField, StructType

from ..functions import dates, text, urls
from ..operators.evidence import jats_section

EMPTY = text.EMPTY


def _blank_null(c: Column) -> Column:
    return F.when(~text.blank(c), c)


def _doi(c: Column) -> Column:
    return _blank_null(F.lower(text.fast_space(c)))


def _names(c: Column) -> Column:
    return F.filter(F.transform(F.coalesce(c, EMPTY()), text.fast_space), lambda x: x != "")


def _rows(df: DataFrame, payload: str, schema: str, items: str) -> DataFrame:
    """One row per element of the JSON's list ``items``, as struct x."""
    others = [c for c in df.columns if c != payload]
    return df.withColumn("__j", F.from_json(payload, schema)).select(*others, F.posexplode(F.col(f"__j.{items}")).alias("pos", "x"))


def _record(rows: DataFrame, source: str, fields: dict[str, Column]) -> DataFrame:
    return rows.select(*[c for c in rows.columns if c != "x"], F.lit(source).alias("source"), *(c.alias(n) for n, c in fields.items()))


# papers -----------------------------------------------------------------------------------------
def europe_pmc(df: DataFrame, payload: str) -> DataFrame:
    item = (
        "struct<id:string,source:string,pmid:string,pmcid:string,doi:string,title:string,abstractText:string,authorString:string,authorList:struct<author:array<struct<fullName:string>>>,journalTitle:string,pubYear:string,"
        "journalVolume:string,issue:string,pageInfo:string,firstPublicationDate:string,electronicPublicationDate:string,creationDate:string,journalInfo:struct<printPublicationDate:string>,pubType:string,isOpenAccess:string,"
        "fullTextUrlList:struct<fullTextUrl:array<struct<url:string>>>>"
    )
    rows = _rows(df, payload, f"resultList struct<result:array<{item}>>", "resultList.result")
    listed = _names(F.col("x.authorList.author.fullName"))
    return _record(rows, "Europe PMC", {
        "pmid": F.col("x.pmid"), "pmcid": F.col("x.pmcid"), "doi": _doi(F.col("x.doi")), "title": text.strip_tags(F.col("x.title")), "abstract": text.strip_tags(F.col("x.abstractText")),
        "authors": F.when(F.size(listed) > 0, listed).otherwise(text.distinct_ci(F.split(F.coalesce("x.authorString", F.lit("")), ","))), "journal": text.fast_space(F.col("x.journalTitle")), "year": F.col("x.pubYear"), "volume": text.fast_space(F.col("x.journalVolume")),
        "issue": text.fast_space(F.col("x.issue")), "pages": text.fast_space(F.col("x.pageInfo")), "online_date": dates.safe_date_string(F.coalesce("x.firstPublicationDate", "x.electronicPublicationDate")), "first_publication_date": dates.safe_date_string(F.col("x.firstPublicationDate")),
        "created_date": dates.safe_date_string(F.col("x.creationDate")), "published_date": dates.safe_date_string(F.col("x.journalInfo.printPublicationDate")), "publication_types": F.array_compact(F.array(_blank_null(F.col("x.pubType")))),
        "open_access": F.coalesce(F.upper("x.isOpenAccess") == "Y", F.lit(False)), "full_text_urls": _names(F.col("x.fullTextUrlList.fullTextUrl.url")), "url": F.concat(F.lit("https://europepmc.org/article/"), F.coalesce("x.source", F.lit("MED")), F.lit("/"), F.coalesce("x.id", F.lit("None"))),
    })


def _crossref_date(c: Column) -> Column:
    first = F.get(c["date-parts"], 0)
    return dates.from_parts(F.get(first, 0).cast("string"), F.get(first, 1).cast("string"), F.get(first, 2).cast("string"))


def crossref(df: DataFrame, payload: str) -> DataFrame:
    part = "struct<`date-parts`:array<array<int>>>"
    item = (
        "struct<DOI:string,title:array<string>,abstract:string,author:array<struct<given:string,family:string>>,`container-title`:array<string>,`published-online`:" + part + ",published:" + part + ",issued:" + part + ",`published-print`:" + part + ","
        "created:struct<`date-time`:string>,indexed:struct<`date-time`:string>,type:string,volume:string,issue:string,page:string,`is-referenced-by-count`:int,link:array<struct<URL:string>>,URL:string>"
    )
    rows = _rows(df, payload, f"message struct<items:array<{item}>>", "message.items")
    x = F.col("x")
    return _record(rows, "Crossref", {
        "doi": _doi(x["DOI"]), "title": text.strip_tags(F.array_join(x["title"], " ")), "abstract": text.strip_tags(x["abstract"]), "authors": _names(F.transform(x["author"], lambda a: F.concat_ws(" ", a["given"], a["family"]))), "journal": text.fast_space(F.array_join(x["container-title"], " ")),
        "online_date": _crossref_date(x["published-online"]), "created_date": dates.safe_date_string(x["created"]["date-time"]), "indexed_date": dates.safe_date_string(x["indexed"]["date-time"]), "published_date": F.coalesce(_crossref_date(x["published"]), _crossref_date(x["issued"])), "print_date": _crossref_date(x["published-print"]),
        "publication_types": F.array_compact(F.array(_blank_null(x["type"]))), "volume": text.fast_space(x["volume"]), "issue": text.fast_space(x["issue"]), "pages": text.fast_space(x["page"]), "citation_count": F.coalesce(x["is-referenced-by-count"], F.lit(0)), "full_text_links": _names(x["link"]["URL"]),
        "url": F.coalesce(_blank_null(x["URL"]), F.when(~text.blank(x["DOI"]), F.concat(F.lit("https://doi.org/"), x["DOI"])), F.lit("")),
    })


def semantic_scholar(df: DataFrame, payload: str) -> DataFrame:
    item = "struct<paperId:string,externalIds:struct<DOI:string,PubMed:string,ArXiv:string>,title:string,abstract:string,authors:array<struct<name:string>>,venue:string,year:int,publicationDate:string,publicationTypes:array<string>,citationCount:int,openAccessPdf:struct<url:string>,url:string>"
    rows = _rows(df, payload, f"data array<{item}>", "data")
    x = F.col("x")
    return _record(rows, "Semantic Scholar", {
        "semantic_scholar": x["paperId"], "pmid": x["externalIds"]["PubMed"], "arxiv": x["externalIds"]["ArXiv"], "doi": _doi(x["externalIds"]["DOI"]), "title": text.clean_space(x["title"]), "abstract": text.clean_space(x["abstract"]), "authors": _names(x["authors"]["name"]), "journal": text.clean_space(x["venue"]),
        "year": x["year"], "online_date": dates.safe_date_string(x["publicationDate"]), "published_date": dates.safe_date_string(x["publicationDate"]), "publication_types": F.coalesce(x["publicationTypes"], EMPTY()), "citation_count": F.coalesce(x["citationCount"], F.lit(0)), "open_access_pdf": x["openAccessPdf"]["url"], "url": x["url"],
    })


def inverted_abstract(m: Column) -> Column:
    """Text of an inverted index (word to places): words by place, then by word."""
    pairs = F.flatten(F.transform(F.map_entries(m), lambda e: F.transform(F.coalesce(e["value"], F.array().cast("array<int>")), lambda p: F.struct(p.alias("p"), e["key"].alias("w")))))
    return F.coalesce(text.fast_space(F.array_join(F.transform(F.array_sort(pairs), lambda x: x["w"]), " ")), F.lit(""))


def openalex(df: DataFrame, payload: str, channel: str = "normal") -> DataFrame:
    item = (
        "struct<id:string,doi:string,display_name:string,title:string,abstract_inverted_index:map<string,array<int>>,authorships:array<struct<author:struct<display_name:string>>>,primary_location:struct<landing_page_url:string,source:struct<display_name:string>>,"
        "publication_year:int,publication_date:string,type:string,cited_by_count:int,open_access:struct<is_oa:boolean>,best_oa_location:struct<pdf_url:string>>"
    )
    rows = _rows(df, payload, f"results array<{item}>", "results")
    x = F.col("x")
    return _record(rows, "OpenAlex", {
        "openalex": x["id"], "doi": _doi(F.regexp_replace(text.fast_space(x["doi"]), "^https://doi.org/", "")), "title": text.clean_space(text.first_nonempty(x["display_name"], x["title"])), "abstract": inverted_abstract(x["abstract_inverted_index"]), "authors": _names(x["authorships"]["author"]["display_name"]),
        "journal": text.clean_space(x["primary_location"]["source"]["display_name"]), "year": x["publication_year"], "online_date": dates.safe_date_string(x["publication_date"]), "published_date": dates.safe_date_string(x["publication_date"]), "publication_types": F.array_compact(F.array(_blank_null(x["type"]))),
        "citation_count": F.coalesce(x["cited_by_count"], F.lit(0)), "open_access": F.coalesce(x["open_access"]["is_oa"], F.lit(False)), "open_access_pdf": x["best_oa_location"]["pdf_url"], "url": F.coalesce(x["primary_location"]["landing_page_url"], x["id"]), "retrieval_channels": F.array(F.lit(f"openalex_{channel}")),
    })


def preprints(df: DataFrame, server: str, published: str, terms: tuple[str, ...] = (), most: int = 300) -> DataFrame:
    """The newest ``most`` records of each server (the feed's capacity), of those the ones whose title or abstract names the
    topic: a term of four letters or more, both normalised. Without terms all stay."""
    from pyspark.sql.window import Window

    place = F.row_number().over(Window.partitionBy(server).orderBy(F.col(published).desc(), "title"))
    return df.withColumn("__n", place).where(f"__n <= {most}").drop("__n").where(names_topic(F.col("title"), F.col("abstract"), terms))


def names_topic(title: Column, abstract: Column, terms: tuple[str, ...]) -> Column:
    hay = text.normalized_text(F.concat_ws(" ", title, abstract))
    plain = [t for t in (" ".join("".join(ch if ch.isascii() and ch.isalnum() else " " for ch in t.lower()).split()) for t in terms) if len(t) >= 4]
    return F.lit(True) if not terms else urls.any_of(hay, tuple(plain))


_CITATION, _ARTICLE = "/PubmedArticle/MedlineCitation", "/PubmedArticle/MedlineCitation/Article"
#: fixed values: dates of an article; its elements by name; kinds of its identifiers
_DATES = {"online": f"{_ARTICLE}/ArticleDate", "printed": f"{_ARTICLE}/Journal/JournalIssue/PubDate", "created": f"{_CITATION}/DateCreated"}
_PLACES = {
    f"{_CITATION}/PMID": "pmid", f"{_ARTICLE}/ArticleTitle": "title", f"{_ARTICLE}/Journal/Title": "journal", f"{_ARTICLE}/Journal/JournalIssue/Volume": "volume", f"{_ARTICLE}/Journal/JournalIssue/Issue": "issue", f"{_ARTICLE}/Pagination/MedlinePgn": "pages",
    **{f"{p}/{part}": f"{name}_{part}" for name, p in _DATES.items() for part in ("Year", "Month", "Day")},
}
_IDS, _ID = ("pubmed", "pmc", "doi"), "/PubmedArticle/PubmedData/ArticleIdList/ArticleId"
_FOUND = [*_PLACES.values(), *(f"id_{k}" for k in _IDS)]


def article_elements(xml: str) -> tuple[str, ...] | None:
    """The texts of an article's elements (``_FOUND``), each of the first of its path, blank if there is none; None for what
    does not parse. One pass without name spaces, as articles use prefixes that the whole answer declares."""
    path, found, open_ = [""], {}, []

    def start(tag: str, attrs: dict[str, str]) -> None:
        path.append(f"{path[-1]}/{tag}")
        name = _PLACES.get(path[-1]) or (path[-1] == _ID and f"id_{attrs.get('IdType')}")
        if name and name not in found:
            found[name] = []
            open_.append((len(path), found[name]))

    def end(tag: str) -> None:
        if open_ and open_[-1][0] == len(path):
            open_.pop()
        path.pop()

    def text_(data: str) -> None:
        for _, parts in open_:
            parts.append(data)

    parser = expat.ParserCreate()
    parser.buffer_text = True
    parser.StartElementHandler, parser.EndElementHandler, parser.CharacterDataHandler = start, end, text_
    try:
        parser.Parse(xml, True)
    except expat.ExpatError:
        return None
    return tuple("".join(found.get(name, ())) for name in _FOUND)


@pandas_udf(StructType([StructField(name, StringType()) for name in _FOUND] + [StructField("parsed", BooleanType())]))
def _elements(xml: pd.Series) -> pd.DataFrame:
    rows = [article_elements(x) if x is not None else None for x in xml]
    return pd.DataFrame([(*r, True) if r else (*[None] * len(_FOUND), False) for r in rows], columns=[*_FOUND, "parsed"])


def pubmed(df: DataFrame, payload: str) -> DataFrame:
    """Articles of an EFetch answer: labelled abstract parts, authors, identifiers and three dates. An article that does not
    parse gives no row."""
    others = [c for c in df.columns if c != payload]
    rows = df.select(*others, F.posexplode(F.regexp_extract_all(F.col(payload), F.lit(r"(?s)(<PubmedArticle\b.*?</PubmedArticle>)"), F.lit(1))).alias("pos", "x"))
    rows = rows.withColumn("__e", _elements("x")).where("__e.parsed")
    x = F.col("x")
    # columns of their own, so that each is computed once
    rows = rows.select(*others, "pos", "x", *(text.fast_space(F.col(f"__e.{name}")).alias(f"__{name}") for name in _FOUND))
    tag = lambda name: F.col(f"__{name}")
    rows = rows.withColumns({f"__{name}": dates.from_parts(_blank_null(tag(f"{name}_Year")), tag(f"{name}_Month"), tag(f"{name}_Day")) for name in _DATES})
    inner = lambda tag, c: F.regexp_extract_all(c, F.lit(rf"(?s)<{tag}\b[^>]*>(.*?)</{tag}>"), F.lit(1))
    attr = lambda c: F.regexp_extract(c, r"Label=\"([^\"]*)\"", 1)
    parts = F.transform(F.regexp_extract_all(x, F.lit(r"(?s)(<AbstractText\b.*?</AbstractText>)"), F.lit(1)), lambda p: F.struct(attr(p).alias("l"), text.clean_space(F.regexp_replace(p, "<[^>]+>", "")).alias("t")))
    abstract = F.array_join(F.transform(F.filter(parts, lambda p: p["t"] != ""), lambda p: F.when(p["l"] != "", F.concat_ws(": ", p["l"], p["t"])).otherwise(p["t"])), " ")
    first = lambda tag, c: text.strip_tags(F.coalesce(F.get(inner(tag, c), 0), F.lit("")))
    authors = _names(F.transform(inner("Author", x), lambda a: F.when(first("CollectiveName", a) != "", first("CollectiveName", a)).otherwise(F.concat_ws(" ", first("ForeName", a), first("LastName", a)))))
    pmid = F.coalesce(_blank_null(tag("id_pubmed")), _blank_null(tag("pmid")))
    online, printed, created = (tag(name) for name in _DATES)
    return _record(rows, "PubMed", {
        "pmid": pmid, "pmcid": _blank_null(tag("id_pmc")), "doi": _doi(tag("id_doi")), "title": tag("title"), "abstract": abstract, "authors": authors, "journal": tag("journal"), "year": text.year_of(F.coalesce(online, printed)),
        "volume": tag("volume"), "issue": tag("issue"), "pages": tag("pages"), "online_date": online, "created_date": created, "published_date": printed, "print_date": printed,
        "publication_types": _names(F.transform(inner("PublicationType", x), text.strip_tags)), "url": F.coalesce(F.concat(F.lit("https://pubmed.ncbi.nlm.nih.gov/"), pmid, F.lit("/")), F.lit("")),
    }).drop(*(f"__{name}" for name in (*_FOUND, *_DATES)))


# news -------------------------------------------------------------------------------------------
def _inner(c: Column, tag: str) -> Column:
    raw = F.regexp_extract(c, rf"(?s)<{tag}\b[^>]*>(.*?)</{tag}>", 1)
    return F.regexp_replace(raw, r"(?s)^\s*<!\[CDATA\[(.*?)\]\]>\s*$", "$1")


def feed_links(summary: Column, *more: Column) -> Column:
    """Addresses of an entry and of the anchors in its summary, once each."""
    return text.distinct_ci(F.concat(F.array(*more), F.regexp_extract_all(F.coalesce(summary, F.lit("")), F.lit(r"(?i)<a\b[^>]*href=[\"']([^\"']+)"), F.lit(1))))


def rss(df: DataFrame, payload: str, source: str, start: Column | None = None, end: Column | None = None, most: int = 35, language: str = "") -> DataFrame:
    """The first ``most`` entries of each feed (a request's size); dated ones outside the window go."""
    others = [c for c in df.columns if c != payload]
    rows = df.select(*others, F.posexplode(F.slice(F.regexp_extract_all(F.col(payload), F.lit(r"(?s)<item\b[^>]*>(.*?)</item>"), F.lit(1)), 1, most)).alias("pos", "x"))
    x = F.col("x")
    summary, link = text.unescape(_inner(x, "description")), text.clean_space(_inner(x, "link"))
    out = _record(rows, source, {
        "title": text.clean_space(_inner(x, "title")), "url": link, "published_date": dates.feed_date(_inner(x, "pubDate"), _inner(x, "updated")), "excerpt": text.strip_tags(_inner(x, "description")), "candidate_urls": feed_links(summary, link),
        "publisher": text.clean_space(_inner(x, "source")), "publisher_url": F.regexp_extract(x, r"<source\b[^>]*url=[\"']([^\"']*)", 1), "language": F.lit(language),
    })
    return out if start is None else out.where(F.col("published_date").isNull() | F.col("published_date").between(F.date_format(start, "yyyy-MM-dd"), F.date_format(end, "yyyy-MM-dd")))


def locale(query: Column) -> Column:
    """Language of the feed that a query goes to, by its script."""
    return F.when(query.rlike(r"[\x{4e00}-\x{9fff}]"), "zh").otherwise("en")


def gdelt(df: DataFrame, payload: str) -> DataFrame:
    rows = _rows(df, payload, "articles array<struct<url:string,title:string,seendate:string,domain:string,language:string,sourcecountry:string>>", "articles")
    x = F.col("x")
    return _record(rows, "GDELT", {"title": text.clean_space(x["title"]), "url": text.clean_space(x["url"]), "published_date": F.date_format(F.try_to_date(F.left(x["seendate"], F.lit(8)), "yyyyMMdd"), "yyyy-MM-dd"), "publisher": text.clean_space(x["domain"]), "language": text.normalize_language(x["language"]), "excerpt": F.lit("")})


def reliefweb(df: DataFrame, payload: str) -> DataFrame:
    rows = _rows(df, payload, "data array<struct<id:string,fields:struct<title:string,url:string,body:string,`body-html`:string,date:struct<original:string,created:string>,source:array<struct<name:string>>>>>", "data")
    x = F.col("x")["fields"]
    return _record(rows, "ReliefWeb", {"title": text.clean_space(x["title"]), "url": text.clean_space(x["url"]), "published_date": dates.safe_date_string(F.coalesce(x["date"]["original"], x["date"]["created"])), "publisher": F.array_join(_names(x["source"]["name"]), ", "), "excerpt": text.strip_tags(F.coalesce(x["body"], x["body-html"])), "official": F.lit(True)})


def anchors(df: DataFrame, payload: str, pattern: str) -> DataFrame:
    """(…, pos, url, title): anchors of a page whose address matches, undated."""
    others = [c for c in df.columns if c != payload]
    rows = df.select(*others, F.posexplode(F.regexp_extract_all(F.col(payload), F.lit(r"(?is)(<a\b[^>]*href=[\"'][^\"']+[\"'][^>]*>.*?</a>)"), F.lit(1))).alias("pos", "x"))
    return rows.select(*others, "pos", F.regexp_extract("x", r"(?is)href=[\"']([^\"']+)", 1).alias("url"), text.strip_tags(F.col("x")).alias("title")).where(F.col("url").rlike(pattern))


# pages ------------------------------------------------------------------------------------------
def meta_content(page: Column, names: tuple[str, ...]) -> Column:
    """Content of the first of these meta names (or properties) that a page has; empty without."""
    found = []
    for n in names:
        a = F.regexp_extract(page, rf"(?is)<meta\b[^>]*(?:name|property)\s*=\s*[\"']{n}[\"'][^>]*content\s*=\s*[\"']([^\"']*)[\"']", 1)
        b = F.regexp_extract(page, rf"(?is)<meta\b[^>]*content\s*=\s*[\"']([^\"']*)[\"'][^>]*(?:name|property)\s*=\s*[\"']{n}[\"']", 1)
        found += [_blank_null(text.clean_space(a)), _blank_null(text.clean_space(b))]
    return F.coalesce(*found, F.lit(""))


#: fixed values: meta names of an article's identity, in order
META = {
    "doi": ("citation_doi", "dc.identifier", "DC.Identifier", "og:doi"), "pmid": ("citation_pmid", "pmid"), "pmcid": ("citation_pmcid", "pmcid"), "title": ("citation_title", "dc.title", "og:title", "twitter:title"),
    "journal": ("citation_journal_title", "dc.source", "prism.publicationName"), "date": ("citation_publication_date", "citation_date", "dc.date", "prism.publicationDate"),
}


def page_identity(page: Column, url: Column) -> Column:
    """struct of an article page's identity by its meta data, its address's DOI and its title."""
    own = {n: meta_content(page, names) for n, names in META.items()}
    title = F.coalesce(_blank_null(own["title"]), text.strip_tags(F.regexp_extract(page, r"(?is)<title\b[^>]*>(.*?)</title>", 1)))
    authors = text.distinct_ci(F.regexp_extract_all(page, F.lit(r"(?is)<meta\b[^>]*name\s*=\s*[\"']citation_author[\"'][^>]*content\s*=\s*[\"']([^\"']*)[\"']"), F.lit(1)))
    return F.struct(F.coalesce(_blank_null(F.lower(own["doi"])), text.extract_doi(url)).alias("doi"), _blank_null(own["pmid"]).alias("pmid"), _blank_null(own["pmcid"]).alias("pmcid"), title.alias("title"), authors.alias("authors"), own["journal"].alias("journal"), own["date"].alias("published_date"), text.year_of(own["date"]).alias("year"))


def json_ld(page: Column) -> Column:
    """struct(title, body) of the first article, report or news node in a page's JSON-LD, in lists and graphs too."""
    node = "struct<`@type`:string,headline:string,name:string,articleBody:string,description:string>"
    blocks = F.regexp_extract_all(F.coalesce(page, F.lit("")), F.lit(r"(?is)<script\b[^>]*application/ld\+json[^>]*>(.*?)</script>"), F.lit(1))
    nodes = lambda b: F.concat(
        F.coalesce(F.from_json(b, f"struct<`@graph`:array<{node}>>")["@graph"], F.array().cast(f"array<{node}>")),
        F.coalesce(F.when(F.trim(b).startswith("["), F.from_json(b, f"array<{node}>")), F.array().cast(f"array<{node}>")), F.when(F.trim(b).startswith("{"), F.array(F.from_json(b, node))).otherwise(F.array().cast(f"array<{node}>")),
    )
    found = F.filter(F.flatten(F.transform(blocks, nodes)), lambda n: F.lower(n["@type"]).rlike("article|report|news"))
    pick = lambda a, b: F.coalesce(F.get(F.filter(F.transform(found, lambda n: text.clean_space(text.first_nonempty(n[a], n[b]))), lambda v: v != ""), 0), F.lit(""))
    return F.struct(pick("headline", "name").alias("title"), pick("articleBody", "description").alias("body"))


def paragraphs(page: Column, least: int = 35) -> Column:
    """Text of a page's paragraphs of ``least`` characters or more, once each."""
    rows = F.transform(F.regexp_extract_all(F.coalesce(page, F.lit("")), F.lit(r"(?is)<p\b[^>]*>(.*?)</p>"), F.lit(1)), text.strip_tags)
    return F.array_join(text.distinct_ci(F.filter(rows, lambda x: F.length(x) >= least)), " ")


def jats_sections(xml: Column) -> Column:
    """map(section, text) of a JATS article: abstract, methods, results, discussion, conclusion, other; sections within
    sections count with the outer one."""
    abstract = F.transform(F.regexp_extract_all(xml, F.lit(r"(?s)<abstract\b[^>]*>(.*?)</abstract>"), F.lit(1)), lambda a: F.struct(F.lit("abstract").alias("k"), text.strip_tags(a).alias("v")))
    body = F.regexp_extract(xml, r"(?s)<body\b[^>]*>(.*)</body>", 1)
    secs = F.transform(F.regexp_extract_all(body, F.lit(r"(?s)<sec\b[^>]*>(.*?)</sec>"), F.lit(1)), lambda s: F.struct(jats_section(text.strip_tags(F.regexp_extract(s, r"(?s)<title\b[^>]*>(.*?)</title>", 1))).alias("k"), text.strip_tags(s).alias("v")))
    rows = F.filter(F.concat(abstract, secs), lambda r: r["v"] != "")
    return F.map_from_entries(F.transform(F.array_distinct(F.transform(rows, lambda r: r["k"])), lambda k: F.struct(k, F.array_join(F.transform(F.filter(rows, lambda r: r["k"] == k), lambda r: r["v"]), " "))))
