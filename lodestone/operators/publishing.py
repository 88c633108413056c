"""Records made ready to publish: canonical objects, views, packets, issue figures, pages under a budget, and their audits."""

from __future__ import annotations

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, StringType
from pyspark.sql.window import Window

from ..functions import dates, similarity, text
from .dedup import identifiers

#: fixed values: fields of the supplementary view, and deep fields that it never has
SUPPLEMENTARY_FIELDS = (
    "paper_id", "title", "title_zh", "authors", "journal", "year", "volume", "issue", "pages", "doi", "source_ids", "url", "sources", "source", "canonical_publication_date", "canonical_publication_date_basis",
    "availability_date", "availability_date_basis", "publication_date_status", "priority_tier", "priority_tier_reason", "quality_score", "metadata_verification", "evidence_status", "content_completion", "publication_types",
    "relevance_route", "display_eligibility", "primary_eligible", "supplementary_eligible", "related_hits", "related_hit_details", "relevance_decision", "relevance_review_method",
)
DEEP_FIELDS = ("analysis", "elements_en", "elements_zh", "analysis_en", "analysis_zh", "full_text", "content", "summary_en", "summary_zh")
#: fixed values: research words that no identity term may hold beside a name
DIRECTIONS = (
    "antiviral", "prevention", "prophylaxis", "transmission", "spillover", "genomic", "genome", "sequencing", "mutation", "variant", "effectiveness", "wastewater", "seroprevalence", "incidence", "prevalence", "model",
    "assay", "nirsevimab", "functional", "cure", "vaccine", "vaccination", "treatment", "therapy", "diagnosis", "surveillance", "epidemiology",
)


def _is(c: Column) -> Column:
    return F.coalesce(c, F.lit(False))


# records ----------------------------------------------------------------------------------------
def canonical_paper(df: DataFrame) -> DataFrame:
    """Papers with canonical identifiers, clean title, authors and sources once, a journal (else venue, else publisher), and
    the first publication date in order of trust with its field (else the availability date). Columns that are not there
    count as null."""
    have = lambda n, kind="string": F.col(n) if n in df.columns else F.lit(None).cast(kind)
    ids = identifiers(have("doi"), have("pmid"), have("pmcid"))
    spans = [(n, dates.span(F.col(n))) for n in dates.PUBLICATION_FIELDS if n in df.columns]
    date = F.coalesce(*(s["raw"] for _, s in spans), have("availability_date"))
    basis = F.coalesce(*(F.when(s.isNotNull(), n) for n, s in spans), have("availability_date_basis"))
    sources = F.concat(F.coalesce(have("sources", "array<string>"), text.EMPTY()), F.array(F.coalesce(have("source"), F.lit(""))))
    get = lambda k: F.try_element_at(F.col("__ids"), F.lit(k))
    out = df.withColumn("__ids", ids).withColumns({
        "doi": get("doi"), "pmid": get("pmid"), "pmcid": get("pmcid"), "title": text.clean_space(have("title")), "authors": text.distinct_ci(have("authors", "array<string>")), "journal": F.coalesce(text.first_nonempty(have("journal"), have("venue"), have("publisher")), F.lit("")),
        "sources": text.distinct_ci(sources), "canonical_publication_date": date, "canonical_publication_date_basis": basis,
    })
    return out.drop("__ids")


def citation_id(doi: Column, pmid: Column, pmcid: Column, title: Column) -> Column:
    """DOI, else PMID, else PMCID, else the title's first 120 characters."""
    given = lambda c: F.when(text.fast_space(c) != "", text.fast_space(c))
    return F.coalesce(given(doi), F.concat(F.lit("PMID:"), given(pmid)), F.concat(F.lit("PMCID:"), given(pmcid)), F.nullif(F.left(text.fast_space(title), F.lit(120)), F.lit("")), F.lit("unidentified-publication"))


def supplementary_reason(route: Column, eligibility: Column, evidence: Column) -> Column:
    """Why a record is supplementary. ``evidence``: whether it has any that is verified."""
    related = _is(route == "supplementary_related") | _is(eligibility == "supplementary_only")
    return F.when(related, "biologically_related_non_target_entity").when(_is(evidence), "relevant_evidence_not_selected_for_primary_top_n").otherwise("verified_metadata_without_public_abstract_or_full_text")


def supplementary_view(df: DataFrame, reason: Column) -> DataFrame:
    """The fields that the supplementary list shows, the reason and the mode of display."""
    route = F.col("relevance_route") if "relevance_route" in df.columns else F.lit(None).cast("string")
    related = (reason == "biologically_related_non_target_entity") | _is(route == "supplementary_related")
    return df.select(*[c for c in SUPPLEMENTARY_FIELDS if c in df.columns], reason.alias("supplementary_reason"), F.when(related, "supplementary_related").otherwise("metadata_only").alias("display_mode"))


def without_deep(df: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Rows without deep fields, and how many rows had each."""
    own = [c for c in DEEP_FIELDS if c in df.columns]
    counts = df.agg(*(F.count_if(~text.blank(F.col(c).cast("string"))).alias(c) for c in own)) if own else df.sparkSession.createDataFrame([(0,)], "none long")
    return df.drop(*own), counts


def public_columns(columns: list[str], private: tuple[str, ...]) -> list[str]:
    """Columns that readers may see: neither private nor with a leading underscore."""
    return [c for c in columns if c not in private and not c.startswith("_")]


def anchor_summary(queries: Column, most: int = 4) -> Column:
    """What a record's queries asked for, without field tags, operators and quotes; once each, the first ``most``."""
    plain = lambda q: text.fast_space(F.regexp_replace(F.regexp_replace(F.regexp_replace(q, r"\[[A-Za-z/ ]+\]", " "), r"(?i)\b(AND|OR|NOT)\b", " "), r"[\"()]", " "))
    return F.slice(text.distinct_ci(F.transform(F.coalesce(queries, text.EMPTY()), plain)), 1, most)


def evidence_sentences(c: Column, whole: int = 30, head: int = 2, tail: int = 3) -> Column:
    """Sentences of a review packet: all up to ``whole``, else the first and the last ones."""
    return text.let(text.review_sentences(c), lambda s: F.when(F.size(s) <= whole, s).otherwise(F.array_distinct(F.concat(F.slice(s, 1, head), F.slice(s, F.size(s) - tail + 1, tail)))))


def prohibited_directions(term: Column) -> Column:
    """Research words of a term of several words, sorted; names of one word have none."""
    words = F.array_distinct(F.regexp_extract_all(F.lower(F.coalesce(term, F.lit(""))), F.lit("([a-z]+)"), F.lit(1)))
    return F.when(F.size(words) <= 1, text.EMPTY()).otherwise(F.array_sort(F.array_intersect(words, F.array(*map(F.lit, DIRECTIONS)))))


def distinct_findings(limit: int = 520, least: float = 0.90, most: int | None = None):
    """A function of an array of texts: complete sentences of each, without those alike to an earlier one."""

    @F.pandas_udf(ArrayType(StringType()))
    def run(c: pd.Series) -> pd.Series:
        def kept(values) -> list[str]:
            out: list[str] = []
            for v in values if values is not None else ():
                v = text.folded(v or "")
                if v and not any(similarity.sentence(similarity.key(v), similarity.key(x)) >= least for x in out):
                    out.append(v[:limit] if len(v) > limit and "." not in v[:limit] else v)
            return out[:most]

        return c.map(kept)

    return run


# selections -------------------------------------------------------------------------------------
def supplementary_news(candidates: DataFrame, shown: DataFrame, most: int = 100) -> DataFrame:
    """News (news_id, title, published_date, rank, ...) that are not shown yet, once by id (else title and date), titled, in
    order of rank, the first ``most`` (the list's size)."""
    key = F.coalesce(F.when(text.fast_space(F.col("news_id")) != "", text.fast_space(F.col("news_id"))), F.sha2(F.concat_ws("|", F.lower(text.fast_space(F.col("title"))), text.fast_space(F.col("published_date"))), 256))
    c = candidates.where(~text.blank(F.col("title"))).withColumn("__k", key).join(shown.select(F.col("news_id").alias("__k")), "__k", "left_anti")
    first = c.withColumn("__n", F.row_number().over(Window.partitionBy("__k").orderBy("rank"))).where("__n = 1").drop("__n", "__k")
    return first.orderBy("rank").limit(most)


def schedule_mismatches(schedule: DataFrame, profiles: DataFrame) -> DataFrame:
    """(profile, issue) of a schedule (day, pos, profile) against the profiles that exist: missing, unscheduled, twice."""
    s = schedule.groupBy("profile").agg(F.count("*").alias("n"))
    both = s.join(profiles.select("profile").distinct().withColumn("there", F.lit(True)), "profile", "full_outer")
    issue = F.when(F.col("there").isNull(), "scheduled_without_profile").when(F.col("n").isNull(), "profile_not_scheduled").when(F.col("n") > 1, "scheduled_twice")
    return both.select("profile", issue.alias("issue")).where("issue is not null")


def portal(schedule: DataFrame, issues: DataFrame) -> DataFrame:
    """The schedule with each profile's latest issue (profile, issue_date, ...), in order of day and place."""
    latest = issues.groupBy("profile").agg(F.max_by(F.struct(*[c for c in issues.columns if c != "profile"]), "issue_date").alias("x")).select("profile", "x.*")
    return schedule.join(latest, "profile", "left").orderBy("day", "pos")


def accepted_clusters(clusters: DataFrame, groups: DataFrame, supported: DataFrame, least: float = 0.90) -> DataFrame:
    """Clusters (cluster, members, keep, confidence, same_work) of a reviewer that may be merged: of two members or more, all
    of one asked group, kept one among them, sure enough, and every other member supported (a, b) against the kept one."""
    c = clusters.where((F.size("members") >= 2) & F.array_contains("members", F.col("keep")) & (F.col("confidence") >= least) & F.col("same_work"))
    c = c.join(groups.select(F.col("members").alias("asked")), F.size(F.array_except("members", "asked")) == 0, "left_semi")
    pairs = c.select("cluster", "keep", F.explode("members").alias("m")).where("m <> keep").select("cluster", F.least("m", "keep").alias("a"), F.greatest("m", "keep").alias("b"))
    bad = pairs.join(supported, ["a", "b"], "left_anti").select("cluster").distinct()
    return c.join(bad, "cluster", "left_anti")


# figures ----------------------------------------------------------------------------------------
def review_summary(df: DataFrame, method: str, decision: str, cache: str) -> DataFrame:
    """(kind, value, n): reviews by method, decision and cache state, blanks under a name of their own."""
    named = lambda c, other: F.coalesce(text.first_nonempty(F.col(c)), F.lit(other))
    rows = df.select(named(method, "not_recorded").alias("method"), named(decision, "not_recorded").alias("decision"), named(cache, "not_used").alias("cache"))
    return rows.groupingSets([["method"], ["decision"], ["cache"]], "method", "decision", "cache").agg(F.count("*").alias("n"), F.grouping_id().alias("g")).select(
        F.when(F.col("g") == 3, "method").when(F.col("g") == 5, "decision").otherwise("cache").alias("kind"), F.coalesce("method", "decision", "cache").alias("value"), "n"
    )


def continuity(accepted: Column, target: Column, triggered: Column) -> Column:
    """Status of a list's continuity: no alarm, recovered, below its target, empty."""
    return F.when(~_is(triggered), "standard").when(accepted >= target, "recovered_output").when(accepted > 0, "below_target").otherwise("empty_valid_issue")


def completion_stop(evidence: Column, target: Column, processed: Column, total: Column) -> Column:
    return F.when(evidence >= target, "primary_target_reached").when(processed >= total, "candidate_exhausted").otherwise("completion_budget_exhausted")


def group_summary(df: DataFrame, group: str, status: str) -> DataFrame:
    """(group, analyzable, fallback, fallback_ratio): of analyses by group those that fell back to extraction; records without
    evidence do not count."""
    out = df.where(F.coalesce(F.col(status), F.lit("")) != "not_applicable").groupBy(group).agg(F.count("*").alias("analyzable"), F.count_if(F.col(status) == "fallback_source_extract").alias("fallback"))
    return out.withColumn("fallback_ratio", F.round(F.col("fallback") / F.col("analyzable"), 4))


def placeholder_coverage(c: Column, placeholders: tuple[str, ...]) -> Column:
    """Share of a text that placeholders make up."""
    low = F.lower(text.fast_space(c))
    left = low
    for p in placeholders:
        left = F.replace(left, F.lit(p.lower()), F.lit(""))
    return F.when(low == "", 0.0).otherwise((F.length(low) - F.length(left)) / F.length(low))


def findings(df: DataFrame, rules: list[tuple[str, str, Column]], key: str) -> DataFrame:
    """(key, severity, code) of every rule (severity, code, condition) that a row breaks."""
    told = F.array_compact(F.array(*(F.when(_is(cond), F.struct(F.lit(severity).alias("severity"), F.lit(code).alias("code"))) for severity, code, cond in rules)))
    return df.select(key, F.explode(told).alias("x")).select(key, "x.severity", "x.code")


# budgets ----------------------------------------------------------------------------------------
def budget_ladder(df: DataFrame, key: str, total: Column, budget: int) -> DataFrame:
    """Degradations (key, step, pos, saved) of pages that exceed a budget -> rows with applied: steps in order, within a step
    from the bottom up, until the page's visible text fits. A page's degradations meet in one window partition."""
    w = Window.partitionBy(key).orderBy("step", F.col("pos").desc()).rowsBetween(Window.unboundedPreceding, -1)
    before = F.coalesce(F.sum("saved").over(w), F.lit(0))
    return df.withColumn("applied", total - before > budget)


def truncated_fields(df: DataFrame, limits: dict[str, int]) -> tuple[DataFrame, DataFrame]:
    """Rows with fields cut to their limits, and how many of each were cut."""
    cut = {c: F.left(F.col(c), F.lit(n)) for c, n in limits.items()}
    return df.withColumns(cut), df.agg(*(F.count_if(F.length(c) > n).alias(c) for c, n in limits.items()))


def attempt_queue(df: DataFrame, order: list[Column], ok: Column, attempts: int, target: int) -> DataFrame:
    """The rows that are attempted: at most ``attempts``, until ``target`` of them have succeeded (both the queue's own
    numbers), with place."""
    first = df.orderBy(*order).limit(attempts)
    w = Window.partitionBy(F.lit(0)).orderBy(*order)
    done = F.coalesce(F.sum(ok.cast("int")).over(w.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    return first.withColumn("place", F.row_number().over(w)).withColumn("__d", done).where(f"__d < {target}").drop("__d")
