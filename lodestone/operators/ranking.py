"""Quality scores, tiers, ranks and selections of papers and news."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from ..functions import dates, text, urls
from .order import placed

#: fixed values: points of sources, designs and news sources; trusted sources; words of topics in motion
SOURCE_POINTS = {"PubMed": 18, "Europe PMC": 17, "Crossref": 10, "Semantic Scholar": 9, "OpenAlex": 9, "bioRxiv": 4, "medRxiv": 4}
TRUSTED = ("PubMed", "Europe PMC", "OpenAlex", "Crossref", "Semantic Scholar")
DESIGN_POINTS = {
    "meta-analysis": 24, "systematic review": 22, "randomized controlled trial": 22, "practice guideline": 20, "clinical trial": 18, "guideline": 18,
    "multicenter study": 16, "cohort study": 14, "case-control study": 12, "review": 10,
}
OFFICIAL = ("who.int", "cdc.gov", "ecdc.europa.eu", "gov.", ".gov", "health.gov", "nhs.uk", "reliefweb.int", "afro.who.int", "paho.org")
INSTITUTIONS = ("university", "hospital", "institute", "laboratory", "public health")
HOTSPOTS = (
    "outbreak", "epidemic", "surveillance", "transmission", "spillover", "vaccine", "vaccination", "treatment", "antiviral", "clinical trial", "variant", "lineage", "genomic", "genome", "mutation",
    "resistance", "emerging", "case", "hospitalization", "mortality",
)
EMPTY = text.EMPTY


def _num(c: Column) -> Column:
    return F.coalesce(c.cast("double"), F.lit(0.0))


def _listed(sources: Column) -> Column:
    return F.filter(F.coalesce(sources, EMPTY()), lambda x: F.coalesce(x, F.lit("")) != "")


def hotspots(c: Column) -> Column:
    """How many of the words a text holds."""
    low = F.lower(text.fast_space(c))
    return sum((F.coalesce(low.contains(t).cast("int"), F.lit(0)) for t in HOTSPOTS), F.lit(0))


def priority_hits(haystack: Column, terms: dict[str, float]) -> Column:
    """The terms of a profile, as given, that a text holds."""
    low = F.lower(text.fast_space(haystack))
    return F.array_compact(F.array(*(F.when(low.contains(t.lower()), t) for t in terms))) if terms else EMPTY()


def priority_points(haystack: Column, terms: dict[str, float]) -> Column:
    low = F.lower(text.fast_space(haystack))
    return F.least(F.lit(24.0), sum((F.when(low.contains(t.lower()), float(w)).otherwise(0.0) for t, w in terms.items()), F.lit(0.0)))


def design_points(types: Column) -> Column:
    low = F.lower(F.array_join(F.coalesce(types, EMPTY()), " "))
    return F.greatest(F.lit(0), F.lit(0), *(F.when(low.contains(t), n).otherwise(0) for t, n in DESIGN_POINTS.items()))


def recency_points(published: Column, as_of: Column) -> Column:
    return F.greatest(F.lit(0.0), 8 - dates.days_old(published, as_of) * 0.5)


def source_points(sources: Column) -> Column:
    points = F.transform(_listed(sources), lambda s: F.coalesce(F.try_element_at(F.create_map(*(F.lit(x) for kv in SOURCE_POINTS.items() for x in kv)), s), F.lit(5)))
    return F.coalesce(F.array_max(points), F.lit(0))


def paper_quality(relevance: Column, sources: Column, concepts: Column, title: Column, abstract: Column, types: Column, has_full_text: Column, doi: Column, citations: Column, published: Column, as_of: Column, terms: dict[str, float] | None = None, haystack: Column | None = None) -> Column:
    """Additive score of a paper, to three digits: relevance, sources, concepts, topics, design, text, citations, recency."""
    own = F.array_distinct(_listed(sources))
    preprint = F.lower(F.array_join(own, " ")).rlike("biorxiv|medrxiv")
    score = (
        36 * _num(relevance) + source_points(sources) + F.least(F.lit(12), 3 * F.greatest(F.lit(0), F.size(own) - 1)) + F.least(F.lit(8), 2 * F.greatest(F.lit(0), F.size(F.coalesce(concepts, EMPTY()))))
        + F.least(F.lit(9.0), 1.5 * hotspots(F.concat_ws(" ", title, abstract))) + (priority_points(haystack if haystack is not None else F.concat_ws(" ", title, abstract), terms) if terms else F.lit(0.0))
        + design_points(types) + F.when(~text.blank(abstract), 10).otherwise(0) + F.when(F.coalesce(has_full_text, F.lit(False)), 5).otherwise(0) + F.when(~text.blank(doi), 3).otherwise(0)
        + F.least(F.lit(8.0), F.least(F.lit(100), F.coalesce(citations.cast("int"), F.lit(0))) / 10) + recency_points(published, as_of) - F.when(preprint, 5).otherwise(0)
    )
    return F.round(score, 3)


def paper_tier(relevance: Column, quality: Column, sources: Column, types: Column, evidence: Column, level: Column, citations: Column, priority: Column) -> Column:
    """A, B or C. ``evidence``: has an abstract or full text; ``level``: E0 to E2."""
    fits, has = _num(relevance) >= 0.6, F.coalesce(evidence, F.lit(False))
    trusted = F.arrays_overlap(_listed(sources), F.array(*map(F.lit, TRUSTED)))
    strong = (design_points(types) >= 16) | F.coalesce(level == "E2", F.lit(False)) | (_num(citations) >= 20) | (trusted & (_num(quality) >= 62)) | (_num(priority) >= 5)
    return F.when(fits & has & strong, "A").when(fits & (has | trusted), "B").otherwise("C")


def _origin(url: Column, publisher: Column, source: Column) -> Column:
    return F.concat_ws(" ", urls.host(url), F.lower(text.fast_space(publisher)), F.lower(text.fast_space(source)))


def news_quality(relevance: Column, official: Column, url: Column, publisher: Column, source: Column, duplicates: Column, concepts: Column, title: Column, excerpt: Column, content: Column, status: Column, published: Column, as_of: Column) -> Column:
    """Additive score of a news record, to three digits. ``duplicates``: how many further sources carry it."""
    origin = _origin(url, publisher, source)
    kind = F.when(F.coalesce(official, F.lit(False)) | urls.any_of(origin, OFFICIAL), 45).when(urls.any_of(origin, INSTITUTIONS), 25).when(origin.contains("reliefweb"), 35).otherwise(8)
    has = ~text.blank(content)
    body = F.when(F.coalesce(status.isin("full", "captured", "partial"), F.lit(False)) & has, 12).when(F.coalesce(status == "syndicated_summary", F.lit(False)) & has, 7).when(~text.blank(excerpt), 4).otherwise(0)
    score = (
        35 * _num(relevance) + kind + F.least(F.lit(15), 3 * F.coalesce(duplicates.cast("int"), F.lit(0))) + F.least(F.lit(8), 2 * F.greatest(F.lit(0), F.size(F.coalesce(concepts, EMPTY()))))
        + F.least(F.lit(12), 2 * hotspots(F.concat_ws(" ", title, excerpt, content))) + body + recency_points(published, as_of)
    )
    return F.round(score, 3)


def news_tier(official: Column, url: Column, publisher: Column, source: Column, content: Column) -> Column:
    origin = _origin(url, publisher, source)
    return F.when(F.coalesce(official, F.lit(False)) | urls.any_of(origin, OFFICIAL), "A").when(urls.any_of(origin, (*INSTITUTIONS, "reliefweb")) | ~text.blank(content), "B").otherwise("C")


def ranked(df: DataFrame, tier: str, score: str, date: str, title: str, seq: str) -> DataFrame:
    """``df`` with rank: by tier (A first), score, date and title, all descending, then seq; null scores count as 0, null
    dates and titles as empty. No window spans the table: ranges of tier and score are numbered apart."""
    letter = F.coalesce(F.element_at(F.create_map(F.lit("A"), F.lit(3), F.lit("B"), F.lit(2), F.lit("C"), F.lit(1)), F.coalesce(F.col(tier), F.lit("C"))), F.lit(0))
    key = -(letter * 1e6 + _num(F.col(score)))
    empty = lambda c: F.coalesce(F.col(c).cast("string"), F.lit(""))
    return placed(df, key, [empty(date).desc(), empty(title).desc(), F.col(seq)], name="rank")


def overview_score(quality: Column, tier: Column, published: Column, start: Column, end: Column, level: Column, sources: Column, concepts: Column, kind: str, paper_type: Column, types: Column, official: Column, status: Column) -> Column:
    """How strongly a record asks to be in an overview of the window."""
    d = dates.iso_date(published)
    when = F.when(d.isNull(), -35).when(start.isNull() | end.isNull(), F.least(F.lit(25), F.greatest(F.lit(0), F.year(d) - 2020))).when(d > end, -70).when(d >= start, 120 - 8 * F.datediff(end, d)).otherwise(-F.least(F.lit(80), 2 * F.datediff(start, d)))
    pick = lambda c, table: F.coalesce(F.try_element_at(F.create_map(*(F.lit(x) for kv in table.items() for x in kv)), F.coalesce(c, F.lit(""))), F.lit(0))
    unique = lambda c: F.size(text.distinct_ci(F.coalesce(c, EMPTY())))
    score = _num(quality) + pick(F.upper(tier), {"A": 55, "B": 25, "C": 5}) + when + pick(level, {"E2": 22, "E1": 12, "E0": -12}) + F.least(F.lit(24), 6 * unique(sources)) + F.least(F.lit(20), 5 * unique(concepts))
    if kind == "literature":
        return score + F.when(F.lower(F.array_join(F.coalesce(types, EMPTY()), " ")).rlike("meta-analysis|systematic review"), 25).when(F.lower(paper_type) == "research", 12).otherwise(0)
    return score + F.when(F.coalesce(official, F.lit(False)), 35).otherwise(0) + pick(status, {"full": 24, "partial": 14, "syndicated_summary": 6})


def diversified_top(df: DataFrame, order: list[Column], source: str, k: int = 25, each: int = 4, least: int = 15, recent: Column | None = None) -> DataFrame:
    """At most ``each`` rows of a source among the first k, recent ones before others; if they are fewer than ``least``, rows
    passed over so far fill up in order. Up to k rows in all: everything. ``order`` should tell all rows apart. The limits
    are the operator's own."""
    if len(df.limit(k + 1).take(k + 1)) <= k:
        return df
    order = [*([F.coalesce(recent, F.lit(False)).desc()] if recent is not None else []), *order]
    # no selected row, first or fill, stands beyond place each + least of its source
    per = df.withColumn("__n", F.row_number().over(Window.partitionBy(source).orderBy(*order))).where(f"__n <= {each + least}")
    first = per.where(f"__n <= {each}").orderBy(*order).limit(k).withColumn("__t", F.lit(0))
    fill = per.where(f"__n > {each}").orderBy(*order).limit(least).withColumn("__t", F.lit(1))
    # at most k + least rows meet here
    both = first.unionByName(fill).withColumn("__p", F.row_number().over(Window.partitionBy(F.lit(0)).orderBy("__t", *order)))
    return both.where(f"__t = 0 or __p <= {least}").drop("__n", "__t", "__p")


def top_split(df: DataFrame, key: str, ready: Column, order: list[Column], primary: int, supplementary: int, verified: Column | None = None) -> DataFrame:
    """The first ``primary`` ready rows as primary, and of the others that are verified (all, unless told) the first
    ``supplementary``; the rest goes. ``key`` tells rows apart, with null as a key."""
    first = df.where(ready).orderBy(*order).limit(primary)
    rest = df if verified is None else df.where(verified)
    rest = rest.join(first.select(F.col(key).alias("__k")), F.col(key).eqNullSafe(F.col("__k")), "left_anti").orderBy(*order).limit(supplementary)
    return first.withColumn("list", F.lit("primary")).unionByName(rest.withColumn("list", F.lit("supplementary")))


def capped(df: DataFrame, order: list[Column], cap: int) -> DataFrame:
    """The first ``cap`` rows; 0: all."""
    return df.orderBy(*order).limit(cap) if cap > 0 else df
