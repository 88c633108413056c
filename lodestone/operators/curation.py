"""Keyed merges, budgets, audits, failures and state as DataFrame operators."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from ..functions.text import fast_space
from ..functions.urls import any_of


# keyed merges ----------------------------------------------------------------------------------
def merge_by_key(df: DataFrame, key: str, seq: str, longest: str, union: str) -> DataFrame:
    """One row per key: the first seq, the longest of a text (ties: first), the ordered distinct values of another, and how many rows met."""
    ranked = F.struct(F.length(longest).alias("n"), (-F.col(seq)).alias("s"))
    return df.groupBy(key).agg(F.min(seq).alias(seq), F.max_by(longest, ranked).alias(longest), F.array_join(F.sort_array(F.collect_set(union)), ",").alias(union), F.count("*").alias("members"))


# budgets ---------------------------------------------------------------------------------------
def pack(df: DataFrame, key: str, order: str, cost: str, budget: int, fixed: int = 0, each: int = 0) -> DataFrame:
    """Batches (key, order, batch) of a key's items in order: a batch closes when the next item would exceed what the budget
    leaves behind ``fixed``, or when it is full; an item too large is a batch of its own. Every item costs ``each`` besides.

    The running state is no window sum, so a fold over the key's ordered costs assigns the batches; a key's items meet in
    one row.
    """
    room = budget - fixed
    lists = df.groupBy(key).agg(F.array_sort(F.collect_list(F.struct(F.col(order).cast("long").alias("o"), (F.col(cost).cast("long") + each).alias("c")))).alias("items"))
    folded = F.expr(
        f"""aggregate(items, named_struct('b', 0L, 'used', 0L, 'any', false, 'out', cast(array() as array<struct<o:bigint,b:bigint>>)),
        (s, x) -> named_struct(
            'b', if(if(s.any and s.used + x.c > {room}L, x.c, s.used + x.c) >= {room}L, s.b + if(s.any and s.used + x.c > {room}L, 2L, 1L), s.b + if(s.any and s.used + x.c > {room}L, 1L, 0L)),
            'used', if(if(s.any and s.used + x.c > {room}L, x.c, s.used + x.c) >= {room}L, 0L, if(s.any and s.used + x.c > {room}L, x.c, s.used + x.c)),
            'any', if(s.any and s.used + x.c > {room}L, x.c, s.used + x.c) < {room}L,
            'out', array_append(s.out, named_struct('o', x.o, 'b', s.b + if(s.any and s.used + x.c > {room}L, 1L, 0L)))),
        s -> s.out)"""
    )
    return lists.select(key, F.explode(folded).alias("x")).select(key, F.col("x.o").alias(order), F.col("x.b").alias("batch"))


def completion(df: DataFrame, order: str, success: Column, size: int, target: int) -> DataFrame:
    """Ordered batches of ``size``: cumulative successes and whether a batch still runs (the target not reached before it)."""
    ranked = df.select(F.col(order), success.cast("long").alias("ok"))
    batches = ranked.groupBy(F.floor((F.col(order) - 1) / size).cast("long").alias("batch")).agg(F.count("*").alias("n"), F.sum("ok").alias("ok"))
    w = Window.orderBy("batch").rowsBetween(Window.unboundedPreceding, 0)
    return batches.withColumn("total", F.sum("ok").over(w)).withColumn("runs", F.col("total") - F.col("ok") < target)


# audits ----------------------------------------------------------------------------------------
def source_health(df: DataFrame, source: str, status: str, records: Column) -> DataFrame:
    """Per source its calls by status, its records, and the health that follows."""
    count = lambda s: F.count_if(F.col(status) == s)
    out = df.groupBy(source).agg(count("success").alias("ok"), count("failed").alias("failed"), count("skipped").alias("skipped"), F.sum(F.when(F.col(status) == "success", records).otherwise(0)).alias("records"))
    health = F.when((F.col("ok") > 0) & (F.col("records") > 0), F.when(F.col("failed") > 0, "degraded").otherwise("healthy")).when(F.col("ok") > 0, "empty").when((F.col("skipped") > 0) & (F.col("failed") == 0), "skipped").otherwise("failed")
    return out.withColumn("health", health)


def funnel(df: DataFrame, stages: list[tuple[str, Column]], threshold: float) -> DataFrame:
    """Rows that pass each stage and all before it, with drop, ratio to the stage before and the continuity alarm."""
    passed, counts = F.lit(True), []
    for _, cond in stages:
        passed = passed & F.coalesce(cond, F.lit(False))
        counts.append(F.count_if(passed))
    one = df.agg(F.array(*counts).alias("n"), F.count("*").alias("all"))
    names = F.array(*(F.lit(s) for s, _ in stages))
    rows = one.select(F.posexplode(F.arrays_zip(names.alias("stage"), F.col("n").alias("after"))).alias("pos", "x"), "n", "all")
    before = F.when(F.col("pos") == 0, F.col("all")).otherwise(F.get(F.col("n"), F.col("pos") - 1))
    rows = rows.select("pos", F.col("x.stage").alias("stage"), before.alias("before"), F.col("x.after").alias("after"))
    return rows.withColumn("dropped", F.col("before") - F.col("after")).withColumn("triggered", (F.col("before") >= 10) & (F.col("after") < threshold * F.col("before")))


# state -----------------------------------------------------------------------------------------
# fixed values: failure categories by substrings, first match wins
FAILURES = (
    ("validation_failed", ("validation_failed", "schema validation", "validator")), ("invalid_json", ("valid json", "jsondecode")),
    ("model_not_found", ("model disabled", "model is disabled", "model access denied", "permission denied for model", "model is not enabled", "model permission", "model is restricted")),
    ("authentication_failed", ("401", "403", "unauthorized", "forbidden", "invalid api key", "api_key_invalid", "authentication")),
    ("rate_limited", ("429", "rate limit", "resource_exhausted", "too many requests", "请求过于频繁", "并发超额")),
    ("quota_exhausted", ("402", "insufficient credit", "insufficient balance", "negative credit", "payment required", "余额不足", "余额已用完", "账户余额", "赠送余额不可用", "free granted balance is unavailable", "quota", "billing", "insufficient_quota", "daily limit", "monthly limit", "token budget exhausted")),
    ("timeout", ("timeout", "timed out", "read timed out", "connect timeout", "deadline exceeded")),
    ("context_or_output_limit", ("context length", "maximum context", "token limit", "request too large", "payload too large")),
    ("empty_response", ("no candidates", "no choices", "empty response", "empty content")),
    ("model_not_found", ("model not found", "unknown model", "model_not_found", "does not exist", "model is not available", "invalid model", "404: model", "404 model")),
    ("unsupported_parameter", ("unsupported parameter", "unsupported_parameter", "unrecognized request argument", "unknown field", "response_format is not supported", "thinking is not supported", "enable_thinking is not supported")),
    ("invalid_request", ("400", "422", "bad request", "invalid request", "invalid_request_error")),
    ("provider_unavailable", ("500", "502", "503", "504", "server error", "service unavailable", "upstream error")),
    ("network_error", ("connection", "dns", "network", "http request failed", "ssl", "certificate verify", "proxyerror", "connection reset", "remote disconnected", "name resolution", "temporary failure in name resolution", "eof occurred")),
)
# fixed values: categories of attempts, the most actionable first
ATTEMPT_PRIORITY = (
    "authentication_failed", "quota_exhausted", "model_quota_exhausted", "rate_limited", "model_not_found", "unsupported_parameter", "invalid_request", "timeout", "network_error",
    "provider_unavailable", "model_discovery_failed", "context_or_output_limit", "invalid_json", "empty_response", "validation_failed", "unknown",
)


def failure_category(c: Column) -> Column:
    """Category of an error message; without a message no provider is configured."""
    low = F.lower(fast_space(c))
    out = F.when(low.isin("", "[]"), "no_provider_configured")
    for name, parts in FAILURES:
        cond = any_of(low, parts)
        if name == "invalid_json":
            cond = cond | (low.contains("json") & low.contains("parse"))
        out = out.when(cond, name)
        if name == "authentication_failed":
            # a model's own quota of zero, not the provider's
            out = out.when(low.contains("quota exceeded") & low.contains("model:") & any_of(low, ("limit: 0", "limit=0", "free_tier", "generate_content")), "model_quota_exhausted")
    return out.otherwise("unknown")


def attempt_summary(df: DataFrame, key: str, status: str, category: str) -> DataFrame:
    """(key, category): the most actionable category of a task's failed attempts; without failures the most frequent of its
    skipped ones but for unconfigured providers (ties: first by name), else unknown."""
    given = F.col(category) != ""
    place = F.array_position(F.array(*map(F.lit, ATTEMPT_PRIORITY)), F.col(category))
    place = F.when(place > 0, place).otherwise(len(ATTEMPT_PRIORITY) + 1)
    failed = df.where((F.col(status) == "failed") & given).groupBy(key).agg(F.min(F.struct(place.alias("p"), F.col(category).alias("c")))["c"].alias("failed"))
    skipped = df.where((F.col(status) == "skipped") & given & (F.col(category) != "provider_not_configured")).groupBy(key, category).count()
    skipped = skipped.groupBy(key).agg(F.min(F.struct((-F.col("count")).alias("n"), F.col(category).alias("c")))["c"].alias("skipped"))
    return df.select(key).distinct().join(failed, key, "left").join(skipped, key, "left").select(key, F.coalesce("failed", "skipped", F.lit("unknown")).alias("category"))


# fixed values: classes of a failed run by its log, first match wins; exit codes of timeouts; limits of its figures
RUN_FAILURES = (
    ("runtime_timeout", ("timed out", "timeout", "exit status 124", "terminated", "signal term", "profile timeout")), ("provider_authentication_failure", ("401", "403", "unauthorized", "invalid api key", "authentication", "permission denied")),
    ("provider_quota_failure", ("quota", "insufficient balance", "credit", "billing", "exceeded your current quota")), ("provider_rate_limited", ("429", "rate limit", "rate_limited", "retry-after")),
    ("network_failure", ("ssl connection", "connection reset", "connection refused", "name or service not known", "read timed out", "connect timeout")), ("schema_or_validation_failure", ("schema", "validationerror", "manifest", "invalid json", "jsondecodeerror")),
    ("dispatch_failure", ("repository_dispatch", "wechat dispatch failed", "dispatches")), ("runner_failure", ("runner listener", "listening for jobs", "session for this runner", "self-hosted")),
    ("code_failure", ("traceback", "assertionerror", "typeerror", "keyerror", "valueerror", "runtimeerror")),
)
WORKLOAD = ("runtime_timeout", "candidate_volume_excessive", "llm_attempts_excessive", "fulltext_volume_excessive")


def run_failure(log: Column, exit_status: Column, elapsed: Column, attempts: Column, completed: Column, unique: Column, raw: Column) -> Column:
    """Class of a failed run: by exit status, log, then its figures."""
    low, n = F.lower(F.coalesce(log, F.lit(""))), lambda c: F.coalesce(c, F.lit(0))
    out = F.when(exit_status.isin(124, 137, 143), "runtime_timeout")
    for name, parts in RUN_FAILURES:
        out = out.when(any_of(low, parts), name)
    out = out.when(n(elapsed) >= 0.95 * 150 * 60, "runtime_timeout").when(n(attempts) >= 100, "llm_attempts_excessive").when(n(completed) >= 150, "fulltext_volume_excessive")
    return out.when((n(unique) >= 750) | (n(raw) >= 1500), "candidate_volume_excessive").otherwise("unknown_failure")


def severity(lost: Column, total: Column, warning: float = 0.20, critical: float = 0.50) -> Column:
    """Of a share of failed analyses: unavailable without any, critical, warning or normal."""
    return F.when(F.coalesce(total, F.lit(0)) == 0, "unavailable").when(lost >= critical * total, "critical").when(lost >= warning * total, "warning").otherwise("normal")


def usage(df: DataFrame) -> DataFrame:
    """Attempts (provider, model, status, prompt_tokens, completion_tokens) -> per provider and model, and per provider (null
    model): requests, successes, failures and tokens."""
    n = lambda c: F.coalesce(F.sum(c), F.lit(0)).cast("long")
    return df.rollup("provider", "model").agg(F.count("*").alias("requests"), F.count_if(F.col("status") == "success").alias("successes"), F.count_if(F.col("status") == "failed").alias("failures"), n("prompt_tokens").alias("prompt_tokens"), n("completion_tokens").alias("completion_tokens"), F.grouping("model").alias("whole")).where("provider is not null")


def health_counts(df: DataFrame, health: str) -> DataFrame:
    """One row: how many sources are of each health."""
    return df.agg(*(F.count_if(F.col(health) == h).alias(h) for h in ("healthy", "degraded", "empty", "failed", "skipped")))


def bundle_hash(df: DataFrame, order: str, value: Column, ranges: int = 64) -> DataFrame:
    """One row (fingerprint, n) of an ordered table: hashes of ``ranges`` buckets (order modulo their number), each over its
    values' hashes in order, hashed in order of the buckets. Null orders are not defined."""
    rows = df.select(F.pmod(F.col(order), F.lit(ranges)).alias("b"), F.struct(F.col(order).alias("o"), F.sha2(value, 256).alias("h")).alias("x"))
    parts = rows.groupBy("b").agg(F.sha2(F.array_join(F.transform(F.array_sort(F.collect_list("x")), lambda x: x["h"]), ""), 256).alias("h"), F.count("*").alias("n"))
    return parts.agg(F.sha2(F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("b", "h"))), lambda x: x["h"]), ""), 256).alias("fingerprint"), F.coalesce(F.sum("n"), F.lit(0)).alias("n"))


def terciles(df: DataFrame, score: str, key: str) -> DataFrame:
    """Load tier of each row, heavy first: places up to (n + 2) div 3 heavy, then as many medium, the rest light. For tables
    of schedules: a window spans them."""
    w = Window.partitionBy(F.lit(0))
    place, third = F.row_number().over(w.orderBy(F.col(score).desc(), key)), F.floor((F.count("*").over(w) + 2) / 3)
    return df.withColumn("tier", F.when(place <= third, "heavy").when(place <= 2 * third, "medium").otherwise("light"))


# provider state ---------------------------------------------------------------------------------
def provider_states(attempts: DataFrame, cooldown: int = 60) -> DataFrame:
    """Attempts (provider, at, status, category) -> per provider its requests, successes, failures, state after the last
    attempt and until when it rests. A success restores it; authentication and quota failures end it until then; outages
    rest it; other failures leave it. No order is replayed: the last attempt of each effect decides."""
    at = lambda cond: F.max(F.when(cond, F.col("at")))
    failed = F.col("status") == "failed"
    ends, rests = failed & F.col("category").isin("authentication_failed", "quota_exhausted"), failed & F.col("category").isin("provider_unavailable", "network_error", "timeout")
    out = attempts.where("status in ('success', 'failed')").groupBy("provider").agg(
        F.count("*").alias("requests"), F.count_if(F.col("status") == "success").alias("successes"), F.count_if(failed).alias("failures"), at(F.col("status") == "success").alias("good"), at(ends).alias("ended"),
        F.max_by(F.when(ends, F.col("category")), F.when(ends, F.col("at"))).alias("why"), at(rests).alias("rested"),
    )
    low = lambda c: F.coalesce(F.col(c).cast("long"), F.lit(-1))
    ended, rested = low("ended") > F.greatest(low("good"), low("rested")), low("rested") > F.greatest(low("good"), low("ended"))
    return out.select("provider", "requests", "successes", "failures", F.when(ended, F.col("why")).when(rested, "cooldown").otherwise("healthy").alias("status"), F.when(rested, low("rested") + cooldown).alias("cooldown_until"))


def first_success(attempts: DataFrame, key: str, order: str, ok: Column) -> DataFrame:
    """The first attempt in order of each task that succeeded (a router's or a chain's result); tasks without one are left out."""
    return attempts.where(ok).groupBy(key).agg(F.min_by(F.struct(*[c for c in attempts.columns if c != key]), order).alias("x")).select(key, "x.*")


def cached(df: DataFrame, cache: DataFrame, key: str, value: str) -> DataFrame:
    """``df`` with a cache's value (null if it has none) and whether it was a hit. The cache has a key once."""
    return df.join(cache.select(key, value), key, "left").withColumn("cache_hit", F.col(value).isNotNull())


def raised_baseline(old: DataFrame, new: DataFrame, keys: list[str], value: str) -> DataFrame:
    """Baselines after a run: the larger of the old and the new count, of keys of either."""
    return old.select(*keys, value).unionByName(new.select(*keys, value)).groupBy(*keys).agg(F.max(value).alias(value))


def keep_latest(df: DataFrame, key: str, seq: str, cap: int) -> DataFrame:
    """The newest entry of each key, and of those the newest ``cap`` (a cache's capacity)."""
    newest = df.groupBy(key).agg(F.max_by(F.struct(*[c for c in df.columns if c != key]), seq).alias("x")).select(key, "x.*")
    return newest.orderBy(F.col(seq).desc(), key).limit(cap)


def coverage(df: DataFrame, concepts: DataFrame, item: str, query: str, concept: str) -> DataFrame:
    """Items with the ordered distinct concepts of their queries; the lookup is broadcast only if it stays small."""
    lookup = concepts.select(query, concept).distinct()
    return df.join(lookup, query).groupBy(item).agg(F.array_join(F.array_sort(F.collect_set(concept)), ",").alias("concepts"), F.countDistinct(concept).alias("n_concepts"))
