"""Packets for reviewers and models, guards on their answers, and the ranking of the models themselves."""

from __future__ import annotations

import json
import re

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import StringType

from ..functions import similarity, text
from . import gates, publishing
from .entities import Contract
from .evidence import evidence_rows

#: fixed values: order of providers by purpose
PROVIDER_ORDER = {
    "extract": ("gemini", "bigmodel", "siliconflow", "mistral", "deepseek", "openrouter", "groq"), "rescue": ("gemini", "deepseek", "bigmodel", "mistral", "siliconflow", "openrouter", "groq"),
    "overview": ("gemini", "deepseek", "bigmodel", "mistral", "siliconflow", "openrouter", "groq"), "relevance": ("gemini", "bigmodel", "siliconflow", "mistral", "deepseek", "openrouter", "groq"),
    "translation": ("gemini", "bigmodel", "mistral", "siliconflow", "deepseek", "openrouter", "groq"),
}
#: fixed values: names under which a translation may stand, outer ones first
CONTAINERS = ("translations", "fields", "result", "data", "output")
ANSWERS = ("translation_zh", "translation", "translated_text", "translatedText", "text", "result", "output", "content", "answer")


# packets ----------------------------------------------------------------------------------------
def compact_packet(key: Column, title: Column, assessment: Column, queries: Column, channels: Column, snippets: Column, source: Column) -> Column:
    """A reviewer's packet as JSON: short names, lists cut to the packet's own lengths."""
    a = assessment
    return F.to_json(F.struct(
        key.cast("string").alias("id"), text.clean_space(title).alias("t"), publishing.anchor_summary(queries).alias("q"), F.slice(text.distinct_ci(channels), 1, 4).alias("ch"), F.slice(a["identity_hits"], 1, 12).alias("ih"), F.slice(a["qualified_hits"], 1, 8).alias("qh"),
        F.slice(a["context_hits"], 1, 10).alias("cx"), F.slice(a["related_hits"], 1, 10).alias("rh"), F.slice(a["hard_hits"], 1, 8).alias("xh"), a["route"].alias("route"), snippets.alias("ev"), a["decision"].alias("py"), a["score"].alias("ps"), text.clean_space(source).alias("src"),
    ))


def full_packet(body: Column, snippets: Column, whole: bool) -> Column:
    """Evidence of an escalated packet: the whole body of up to thirty sentences (``whole``: papers), else the first two
    sentences, the selected ones and the last three, once each."""
    return text.let(text.review_sentences(body), lambda s: F.when(F.lit(whole) & (F.size(s) <= 30), text.clean_space(body)).otherwise(F.array_join(text.distinct_ci(F.concat(F.slice(s, 1, 2), F.coalesce(snippets, text.EMPTY()), F.slice(s, F.greatest(F.lit(1), F.size(s) - 2), 3))), " ")))


def news_pack(df: DataFrame, key: str, content: str, least: int = 500, most: int = 70) -> tuple[DataFrame, DataFrame]:
    """(key, source_char_count, generate_brief), and the evidence rows: the first ``most`` sentences of each article."""
    n = F.length(text.clean_space(F.col(content)))
    return df.select(key, n.alias("source_char_count"), (n >= least).alias("generate_brief")), evidence_rows(df, key, content, "N", most)


def rules(terms: dict[str, tuple], accept: int = 5, review: int = 2) -> Contract:
    """A topic's contract from its vocabulary: terms by category (identity, member, disease, related, hard_exclusion, else
    exclusion, context) and abbreviations with the context they need."""
    get = lambda k: tuple(dict.fromkeys(terms.get(k, ())))
    return Contract(get("identity"), get("member"), get("disease"), get("related"), get("hard_exclusion") or get("exclusion"), get("context"), tuple((t, n) for t, n in terms.get("qualified", ()) if n), accept, review, bool(terms.get("core")))


def excerpt(limit: int = 1800):
    """An abstract-like excerpt of a full text: sentences of method, result and conclusion, then of figures, to 65 % of the
    limit, then others in order; cut with an ellipsis."""
    wanted = (re.compile(r"\b(we (?:conducted|used|analy[sz]ed|found|observed|identified)|methods?|results?|findings?|conclusion|study|review)\b", re.I), re.compile(r"\b(hazard ratio|odds ratio|confidence interval|\d+(?:\.\d+)?%|p\s*[=<])\b", re.I))

    def run(x: str) -> str:
        parts = text.plain_sentences(x)[:80]
        out: list[str] = []
        size = lambda: sum(map(len, out)) + max(0, len(out) - 1)
        for pool, full in (*(([p for p in parts if w.search(p)], 0.65 * limit) for w in wanted), (parts, limit)):
            for p in pool:
                if size() >= full:
                    break
                if p not in out:
                    out.append(p)
        joined = " ".join(out)
        return joined if len(joined) <= limit else joined[: limit - 1].rstrip() + "…"

    return F.pandas_udf(lambda c: c.map(lambda x: run(x or "")), StringType())


# guards -----------------------------------------------------------------------------------------
def continuity_eligible(verified: Column, doi: Column, pmid: Column, pmcid: Column, sources: Column) -> Column:
    """Whether a paper's identity can be checked: verified, identified, or of two sources."""
    given = ~text.blank(doi) | ~text.blank(pmid) | ~text.blank(pmcid)
    return F.coalesce(verified, F.lit(False)) | given | (F.size(F.coalesce(sources, text.EMPTY())) >= 2)


def background_guard(kind: str, a: Column, independent: Column, conflict: Column, verified: Column, evident: Column) -> Column:
    """struct(accepted, reason): whether a record that a reviewer called background stays, because title, body and context each
    establish the topic and its identity and evidence are verified (for news: authority and address)."""
    no = ~F.coalesce(conflict, F.lit(False)) & ~a["hard_conflict"]
    hits = lambda *names: F.greatest(*(F.size(independent[n]) for n in names)) > 0
    enough = hits("title_hits", "qualified_hits") & hits("body_hits", "qualified_hits") & ((F.size(independent["context_hits"]) > 0) | (independent["frequency"] >= 2))
    checked = F.coalesce(verified, F.lit(False)) & F.coalesce(evident, F.lit(False))
    primary = (a["route"] == "primary_candidate") & (a["decision"] == "accept")
    last = "paper_identity_or_evidence_unverified" if kind == "paper" else "news_body_not_authoritatively_verified"
    reason = F.when(~primary, "not_deterministic_primary_accept").when(~no, "hard_or_identifier_conflict").when(~enough, "insufficient_independent_target_evidence").when(~checked, last).otherwise("strong_deterministic_identity_disagrees_with_background_code")
    return F.struct((primary & no & enough & checked).alias("accepted"), reason.alias("reason"))


def summary_valid(body: Column, title: Column, official: Column, least: int = 100) -> Column:
    """Whether a syndicated summary is one: long and whole enough, not its title again, no boilerplate; official ones may be
    short."""
    value, official = text.remove_boilerplate(body), F.coalesce(official, F.lit(False))
    alike = similarity.indel_ratio(text.normalize_title(title), text.normalize_title(value)) / 100
    clean = F.size(gates.body_diagnostics(body, official, False)["reasons"]) == 0
    words, parts = F.regexp_count(value, F.lit(r"[A-Za-z0-9\x{4e00}-\x{9fff}]+")), F.size(text.sentences(value, 20))
    standard = clean & (F.length(value) >= least) & (words >= 18) & (alike < 0.90) & ((parts >= 2) | (F.length(value) >= 220))
    return standard | (official & (value != "") & (alike < 0.90) & clean)


# translators and models -------------------------------------------------------------------------
def translation_failure(message: Column, status: Column) -> Column:
    """Category of a translator's failure."""
    low, s = F.lower(F.coalesce(message, F.lit(""))), F.coalesce(status, F.lit(0))
    return (
        F.when((s == 429) | low.rlike("429|too many requests|rate limit"), "rate_limited").when(s.isin(401, 403) | low.rlike("unauthorized|forbidden|authentication|invalid api key"), "authentication_failed")
        .when(low.rlike("timeout|timed out|connection|network|dns"), "network_error").otherwise("field_failure")
    )


def translator_states(attempts: DataFrame, threshold: int = 2) -> DataFrame:
    """Attempts (provider, at, category; a null category is a success) -> per provider whether it is disabled, and why: by any
    authentication failure, or ``threshold`` network failures since a success."""
    ok = F.max(F.when(F.col("category").isNull(), F.col("at")))
    last = attempts.groupBy("provider").agg(ok.alias("good"))
    since = attempts.join(last, "provider").groupBy("provider").agg(F.count_if(F.col("category") == "authentication_failed").alias("auth"), F.count_if((F.col("category") == "network_error") & (F.col("good").isNull() | (F.col("at") > F.col("good")))).alias("net"))
    return since.select("provider", F.when(F.col("auth") > 0, "authentication_failed").when(F.col("net") >= threshold, "repeated_network_failure").alias("disabled_reason"))


def translation_of(value, key: str = "") -> str:
    """The translation in a model's answer, whatever its shape: a text, the first of a list, a field by name or container, the
    only value of an object."""
    if isinstance(value, str):
        return text.folded(value)
    if isinstance(value, list):
        return next((t for t in (translation_of(v, key) for v in value) if t), "")
    if not isinstance(value, dict):
        return ""
    places = [(value[c][key], "") for c in CONTAINERS if key and isinstance(value.get(c), dict) and key in value[c]]
    places += [(value[key], "")] if key and key in value else []
    places += [(value[n], key) for n in ANSWERS if n in value]
    found = next((t for t in (translation_of(v, k) for v, k in places) if t), "")
    shown = [v for n, v in value.items() if not n.startswith("_")]
    return found or (translation_of(shown[0], key) if len(shown) == 1 else "")


def translation_value(key: str = ""):
    """``translation_of`` of a column of JSON (a plain text counts as itself)."""

    def one(x: str) -> str:
        try:
            return translation_of(json.loads(x), key)
        except ValueError:
            return text.folded(x)

    return F.pandas_udf(lambda c: c.map(lambda x: one(x or "")), StringType())


def model_points(provider: Column, name: Column, explicit: Column, active: Column, context: Column) -> Column:
    """How early a listed model is tried: named ones, then active, light, stable, free and small ones."""
    low = F.lower(F.coalesce(name, F.lit("")))
    pts = lambda cond, n: F.when(F.coalesce(cond, F.lit(False)), n).otherwise(0)
    family = F.when(low.startswith("gemini-3.5-"), 70).when(low.startswith("gemini-3.1-"), 60).when(low.startswith("gemini-2.5-"), 40).otherwise(0)
    gemini = F.when(low.contains("flash-lite"), 260).when(low.contains("flash") & ~low.contains("pro"), 80).otherwise(0) + family
    return (
        pts(explicit, 1000) + pts(F.coalesce(active, F.lit(True)), 120) + F.when(provider == "gemini", gemini).otherwise(0) + pts(~low.rlike("preview|experimental|exp-|beta|deprecated"), 100)
        + F.when(low.rlike("flash-lite|small|mini|ministral|instant|8b|7b"), 100).when(low.contains("flash"), 85).otherwise(0) + pts(low.rlike("qwen|mistral|llama|gemma|glm|deepseek|gemini"), 45) + pts((provider == "openrouter") & low.endswith(":free"), 180)
        - pts(low.rlike("reasoning|thinking|r1|pro|large|120b|70b"), 30) + pts(context >= 16000, 10)
    )


def discovered_models(df: DataFrame, most: int = 30) -> DataFrame:
    """Models (provider, name, explicit, active, context) of each provider once, in the order that they are tried, the first
    ``most`` (the list's size)."""
    from pyspark.sql.window import Window

    one = df.groupBy("provider", "name").agg(F.max("explicit").alias("explicit"), F.max("active").alias("active"), F.max("context").alias("context"))
    place = F.row_number().over(Window.partitionBy("provider").orderBy(model_points(F.col("provider"), F.col("name"), F.col("explicit"), F.col("active"), F.col("context")).desc(), F.lower("name"), "name"))
    return one.withColumn("place", place).where(f"place <= {most}")


def provider_place(provider: Column, purpose: str) -> Column:
    """1-based place of a provider for a purpose; null if it has none."""
    return F.nullif(F.array_position(F.array(*map(F.lit, PROVIDER_ORDER.get(purpose, PROVIDER_ORDER["extract"]))), F.lower(provider)), F.lit(0).cast("long"))
