"""Topics compiled to provider queries: core concepts, rewrites, plan, checks, and queries that events suggest."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from ..functions import dates, text

#: fixed values: limits, providers in order of the plan with the rewrite each takes, prohibited words of directions
PUBMED_LIMIT, NEWS_LIMIT, CORE, SUPPLEMENTAL = 1800, 350, 5, 8
PROVIDERS = (
    ("pubmed", "plain"), ("europe_pmc", "plain"), ("crossref", "plain"), ("semantic_scholar", "semantic"), ("openalex", "plain"), ("pubmed_supplemental", "plain"), ("europe_pmc_supplemental", "plain"),
    ("crossref_supplemental", "plain"), ("semantic_scholar_supplemental", "semantic"), ("openalex_supplemental", "plain"), ("news_en", "news"), ("news_zh", "zh"), ("gdelt", "gdelt"), ("reliefweb", "news"),
)
#: fixed values: words of events and the countries that are sought
EVENT = r"(?i)\b(outbreak|epidemic|cluster|case(?:s)?|death(?:s)?|fatalit(?:y|ies)|emergence|public health emergency|spillover|transmission)\b|疫情|暴发|爆发|病例|死亡|病死率|突发"
COUNTRIES = (
    "ethiopia", "uganda", "rwanda", "tanzania", "kenya", "guinea", "ghana", "nigeria", "angola", "congo", "democratic republic of the congo", "sierra leone", "liberia", "germany", "chile", "argentina", "united states",
    "canada", "australia", "india", "china", "singapore", "ukraine", "brazil", "bolivia", "peru", "colombia", "mexico", "埃塞俄比亚", "乌干达", "卢旺达", "坦桑尼亚", "肯尼亚", "几内亚", "刚果", "中国",
    "美国", "澳大利亚", "印度", "新加坡", "智利", "阿根廷", "巴西", "秘鲁",
)
SCARCE = ("marburg_virus", "nipah_virus", "ebola_viruses", "arenaviridae", "sftsv")


def norm(c: Column) -> Column:
    return text.normalized_text(c)


def pubmed_window(query: Column, start: Column, end: Column) -> Column:
    """A query bounded by the three dates of publication, never by those of record keeping."""
    a, b = (F.date_format(d, "yyyy/MM/dd") for d in (start, end))
    bounds = [F.concat(F.lit('("'), a, F.lit(f'"[{f}] : "'), b, F.lit(f'"[{f}])')) for f in ("EPDAT", "PPDAT", "PDAT")]
    return F.concat(F.lit("("), query, F.lit(") AND ("), F.concat_ws(" OR ", *bounds), F.lit(")"))


def rewritten(c: Column, way: str) -> Column:
    """A concept in a provider's syntax."""
    v = text.fast_space(c)
    if way == "semantic":
        return text.fast_space(F.regexp_replace(v, r"[^A-Za-z0-9\s]", " "))
    if way == "gdelt":
        v = F.replace(v, F.lit('"'), F.lit(""))
        return F.when(v.contains(" "), F.concat(F.lit('"'), v, F.lit('"'))).otherwise(v)
    return F.left(v, F.lit(NEWS_LIMIT)) if way == "news" else v


def core_concepts(df: DataFrame, most: int = CORE) -> DataFrame:
    """Concepts (profile, pos, scholarly, semantic_key, news_en, news_zh, role) -> the first ``most`` of each profile, once by
    semantic key (else the normalised term), with id and news_en filled. Blank terms go. ``exact`` tells whether there are
    exactly that many, which a profile needs."""
    have = lambda n: F.col(n) if n in df.columns else F.lit(None).cast("string")
    key = F.when(norm(have("semantic_key")) != "", norm(have("semantic_key"))).otherwise(norm(F.col("scholarly")))
    d = df.select("profile", "pos", text.fast_space(F.col("scholarly")).alias("scholarly"), key.alias("semantic_key"), text.first_nonempty(have("news_en"), F.col("scholarly")).alias("news_en"), F.coalesce(have("news_zh"), F.lit("")).alias("news_zh"), text.first_nonempty(have("role"), F.lit("identity")).alias("role"))
    d = d.where("scholarly <> '' and semantic_key <> ''")
    first = d.groupBy("profile", "semantic_key").agg(F.min(F.struct("pos", "scholarly", "news_en", "news_zh", "role")).alias("x")).select("profile", "semantic_key", "x.*")
    w = Window.partitionBy("profile")
    d = first.withColumn("place", F.row_number().over(w.orderBy("pos"))).where(f"place <= {most}")
    return d.withColumns({"id": F.concat(F.lit("concept_"), F.col("place").cast("string")), "exact": F.count("*").over(w) == most})


def supplemental(terms: DataFrame, core: DataFrame, most: int = SUPPLEMENTAL) -> DataFrame:
    """Terms (profile, pos, term) that are no core concept, once, the first ``most`` of each profile."""
    t = terms.select("profile", "pos", text.fast_space(F.col("term")).alias("term")).withColumn("n", norm(F.col("term"))).where("n <> ''")
    t = t.groupBy("profile", F.lower("term").alias("low")).agg(F.min(F.struct("pos", "term", "n")).alias("x")).select("profile", "x.*")
    t = t.join(core.select("profile", norm(F.col("scholarly")).alias("n")), ["profile", "n"], "left_anti")
    return t.withColumn("place", F.row_number().over(Window.partitionBy("profile").orderBy("pos"))).where(f"place <= {most}").drop("n")


def query_plan(core: DataFrame, extra: DataFrame, most: int = 200) -> DataFrame:
    """Rows (profile, group_id, provider, concept_id, query): each concept in each provider's syntax, once a provider,
    numbered, in the fixed order of providers; the first ``most`` of a profile (a plan's capacity)."""
    base = core.select("profile", "place", F.col("id").alias("concept_id"), F.col("scholarly").alias("plain"), "news_en", "news_zh", F.lit(False).alias("more"))
    base = base.unionByName(extra.select("profile", "place", F.concat(F.lit("supplemental_"), F.col("place").cast("string")).alias("concept_id"), F.col("term").alias("plain"), F.col("term").alias("news_en"), F.lit("").alias("news_zh"), F.lit(True).alias("more")))
    made = []
    for i, (provider, way) in enumerate(PROVIDERS):
        source = F.col("news_zh") if way == "zh" else F.col("news_en") if provider in ("news_en", "gdelt", "reliefweb") else F.col("plain")
        made.append(F.when(F.col("more") == F.lit(provider.endswith("_supplemental")), F.struct(F.lit(i).alias("at"), F.lit(provider).alias("provider"), rewritten(source, way).alias("query"))))
    rows = base.select("profile", "place", "concept_id", F.explode(F.array_compact(F.array(*made))).alias("x")).select("profile", "place", "concept_id", "x.*").where("query <> ''")
    rows = rows.groupBy("profile", "at", "provider", F.lower("query").alias("low")).agg(F.min(F.struct("place", "concept_id", "query")).alias("x")).select("profile", "at", "provider", "x.*")
    number = F.row_number().over(Window.partitionBy("profile", "at").orderBy("place"))
    rows = rows.withColumn("n", number).withColumn("total", F.row_number().over(Window.partitionBy("profile").orderBy("at", "n"))).where(f"total <= {most}")
    return rows.select("profile", F.concat_ws("-", "provider", F.when(F.col("n") < 10, F.lpad(F.col("n").cast("string"), 2, "0")).otherwise(F.col("n").cast("string"))).alias("group_id"), "provider", "concept_id", "query")


def plan_issues(core: DataFrame, plan: DataFrame) -> DataFrame:
    """(profile, issue): not exactly five concepts, concepts that read alike, a provider without every concept, queries too long."""
    counts = core.groupBy("profile").agg(F.count("*").alias("n"), F.count_distinct(norm(F.col("scholarly"))).alias("d"))
    out = counts.where(f"n <> {CORE}").select("profile", F.concat(F.lit(f"core concept count must be exactly {CORE}, got "), F.col("n").cast("string")).alias("issue"))
    out = out.unionByName(counts.where("d < n").select("profile", F.lit("semantic duplicate core concepts").alias("issue")))
    need = ("pubmed", "europe_pmc", "crossref", "semantic_scholar", "openalex")
    per = plan.where(F.col("provider").isin(*need)).groupBy("profile", "provider").agg(F.count("*").alias("q"))
    every = counts.select("profile", "n", F.explode(F.array(*map(F.lit, need))).alias("provider")).join(per, ["profile", "provider"], "left")
    out = out.unionByName(every.where("coalesce(q, 0) <> n").select("profile", F.concat("provider", F.lit("_core does not cover every core concept")).alias("issue")))
    long_ = plan.where(((F.col("provider") == "pubmed") & (F.length("query") > PUBMED_LIMIT)) | (F.col("provider").startswith("news") & (F.length("query") > NEWS_LIMIT)))
    return out.unionByName(long_.select("profile", F.when(F.col("provider") == "pubmed", "PubMed query length exceeded").otherwise("news query length exceeded").alias("issue")).distinct())


# events -----------------------------------------------------------------------------------------
def locations(c: Column, most: int = 4) -> Column:
    """Countries that a text names, in the order of the list, then capitalised places behind in, from, across or within;
    once each, the first ``most``."""
    low = F.lower(F.coalesce(c, F.lit("")))
    named = F.array_compact(F.array(*(F.when(low.contains(x), x) for x in COUNTRIES)))
    near = F.filter(F.regexp_extract_all(F.coalesce(c, F.lit("")), F.lit(r"\b(?:in|from|across|within)\s+([A-Z][A-Za-z-]+(?:\s+[A-Z][A-Za-z-]+){0,2})"), F.lit(1)), lambda x: ~F.lower(x).isin("the", "this", "our"))
    return F.slice(text.distinct_ci(F.concat(named, near)), 1, most)


def event_queries(papers: DataFrame, identity: str, terms: tuple[str, ...], most: int = 4) -> DataFrame:
    """Papers (seq, title, abstract) -> the first ``most`` queries (place, query, seq, location, event_word) of papers about
    an event of the topic, one a location, once each by text."""
    said = text.clean_space(F.concat_ws(" ", "title", "abstract"))
    p = papers.select("seq", said.alias("said")).where(F.col("said").rlike(EVENT))
    if terms:
        hit = F.lit(False)
        for t in terms:
            hit = hit | F.lower("said").contains(t.lower())
        p = p.where(hit)
    p = p.select("seq", F.regexp_extract("said", f"({EVENT})", 1).alias("event_word"), F.regexp_extract("said", r"\b(20\d{2})\b", 1).alias("year"), F.posexplode(locations(F.col("said"))).alias("pos", "location"))
    q = p.withColumn("query", text.fast_space(F.concat_ws(" ", F.lit(f'"{identity}"'), "location", "event_word", "year")))
    q = q.groupBy(F.lower("query").alias("low")).agg(F.min(F.struct("seq", "pos", "query", "location", "event_word")).alias("x")).select("x.*").orderBy("seq", "pos").limit(most)
    return q.withColumn("place", F.row_number().over(Window.partitionBy(F.lit(0)).orderBy("seq", "pos"))).drop("pos")


def append_events(plan: DataFrame, events: DataFrame, profile: str) -> DataFrame:
    """A plan with the event queries that it does not hold yet, numbered."""
    new = events.join(plan.select(F.lower("query").alias("low")), F.lower(events["query"]) == F.col("low"), "left_anti")
    n = F.row_number().over(Window.partitionBy(F.lit(0)).orderBy("place"))
    return plan.unionByName(new.select(F.lit(profile).alias("profile"), F.concat(F.lit("event-news-"), F.lpad(n.cast("string"), 2, "0")).alias("group_id"), F.lit("event_driven_news").alias("provider"), F.lit("dynamic_event").alias("concept_id"), "query"))


def scarce(profile: Column) -> Column:
    return profile.isin(*SCARCE)


# vocabularies -----------------------------------------------------------------------------------
def merged_vocabulary(proposal: DataFrame, base: DataFrame) -> DataFrame:
    """Terms (category, pos, term, ...) of a proposal before those of the base, once by category and normalised term."""
    both = proposal.withColumn("__p", F.lit(0)).unionByName(base.withColumn("__p", F.lit(1)), allowMissingColumns=True).withColumn("__n", norm(F.col("term"))).where("__n <> ''")
    w = Window.partitionBy("category", "__n").orderBy("__p", "pos")
    return both.withColumn("__r", F.row_number().over(w)).where("__r = 1").drop("__r", "__n", "__p")


def contradictions(terms: DataFrame) -> DataFrame:
    """(kind, term): terms of two roles (term, role) that must not share any: identity and hard, identity and related,
    related and hard."""
    t = terms.select(norm(F.col("term")).alias("term"), "role").where("term <> ''").distinct()
    out = None
    for a, b in (("identity", "hard"), ("identity", "related"), ("related", "hard")):
        both = t.where(F.col("role") == a).select("term").intersect(t.where(F.col("role") == b).select("term")).select(F.lit(f"{a}_{b}").alias("kind"), "term")
        out = both if out is None else out.unionByName(both)
    return out


def without_evidence(terms: DataFrame, evidence: DataFrame) -> DataFrame:
    """Terms (category, term) for which no evidence (term, source) is there."""
    known = evidence.select(norm(F.col("term")).alias("n")).distinct()
    return terms.withColumn("n", norm(F.col("term"))).join(known, "n", "left_anti").drop("n")


def seven_days(c: Column, origin: str = "2024-01-01") -> Column:
    """First day of the seven-day window, counted from ``origin``, that a time falls in."""
    start = F.lit(origin).cast("date")
    return F.date_add(start, (F.floor(F.datediff(c.cast("date"), start) / 7) * 7).cast("int"))


__all__ = [n for n in dir() if not n.startswith("_") and n not in ("annotations", "Column", "DataFrame", "F", "Window", "dates", "text")]
