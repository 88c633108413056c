"""Relevance: assessment, gates, routing of reviewed records, evidence snippets, and the acceptance-cliff guard."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from ..functions.text import EMPTY, contains_term, distinct_ci, fast_space, review_sentences
from .entities import IDENTITY, Contract, evidence
from .lineage import cut
from .order import placed

POLICY = "related-entity-evidence-retention"


def _some(c: Column) -> Column:
    return F.coalesce(F.size(c) > 0, F.lit(False))


def scored(e: Column, accept: int, review: int, core_concepts: bool = False) -> Column:
    """The assessment of an ``evidence`` struct."""
    t, b = e["title"], e["body"]
    has = {f"{p}_{c}": _some(s[c]) for p, s in (("t", t), ("b", b)) for c in (*IDENTITY, "related", "hard_excluded")}
    title_identity = has["t_target"] | has["t_member"] | has["t_disease"]
    direct = title_identity | has["b_target"] | has["b_member"] | has["b_disease"]
    target = direct | _some(e["qualified"])
    related, context = has["t_related"] | has["b_related"], _some(e["context"])
    mixed = target & related
    hard_title = has["t_hard_excluded"] & ~target
    hard_body = has["b_hard_excluded"] & ~target & ~related & ~hard_title
    pts = lambda cond, n: F.when(cond, n).otherwise(0)
    # fixed values: points by role and place
    score = (
        pts(has["t_target"], 6) + pts(has["t_member"], 5) + pts(has["t_disease"], 4)
        + pts(has["b_target"] & ~has["t_target"], 3) + pts(has["b_member"] & ~has["t_member"], 2) + pts(has["b_disease"] & ~has["t_disease"], 2)
        + F.when(has["t_related"], 2).when(has["b_related"], 1).otherwise(0) + pts(context, 1)
        + pts(_some(e["qualified"]) & ~direct, 3) + pts(_some(e["ambiguous"]) & ~direct & ~related, -4) + pts(context & ~target & ~related, -4)
        + pts(hard_title, -10) + pts(hard_body, -7) + pts(target & (e["frequency"] >= 2), 1)
    )
    hard = hard_title | hard_body
    primary = F.when(mixed, "review").when((score >= accept) | title_identity, "accept").when(score >= review, "review").otherwise("reject")
    decision = F.when(hard, "reject").when(target, primary).when(related, "review").otherwise("reject")
    route = F.when(hard | (target & (primary == "reject")), "reject").when(target, "primary_candidate").when(related, "supplementary_related").otherwise("reject")
    joined = lambda s, cs: distinct_ci(F.flatten(F.array(*(F.coalesce(s[c], EMPTY()) for c in cs))))
    title_hits, body_hits = joined(t, IDENTITY), joined(b, IDENTITY)
    return F.struct(
        score.cast("int").alias("score"), decision.alias("decision"), route.alias("route"), target.alias("identity_present"), related.alias("related_present"),
        title_hits.alias("title_hits"), body_hits.alias("body_hits"), distinct_ci(F.concat(title_hits, body_hits, F.coalesce(e["qualified"], EMPTY()))).alias("identity_hits"),
        F.coalesce(e["qualified"], EMPTY()).alias("qualified_hits"), F.coalesce(e["ambiguous"], EMPTY()).alias("ambiguous_hits"), F.coalesce(e["context"], EMPTY()).alias("context_hits"),
        distinct_ci(F.concat(joined(t, ["related"]), joined(b, ["related"]))).alias("related_hits"), distinct_ci(F.concat(joined(t, ["hard_excluded"]), joined(b, ["hard_excluded"]))).alias("hard_hits"),
        e["frequency"].alias("frequency"), hard.alias("hard_conflict"), mixed.alias("mixed"), (route == "primary_candidate").alias("primary_eligible"),
        ((route == "supplementary_related") | ((route == "primary_candidate") & related)).alias("supplementary_eligible"),
        (mixed | (route == "supplementary_related") | _some(e["ambiguous"]) | (~target & F.lit(core_concepts))).alias("needs_review"),
    )


def assessed(df: DataFrame, title: Column, body: Column, contract: Contract, name: str = "relevance") -> DataFrame:
    """``df`` with the assessment struct. The terms are found once (an Arrow function), in a projection of their own; null
    texts count as empty."""
    e = f"__{name}"
    return df.withColumn(e, evidence(contract)(title, body)).withColumn(name, scored(F.col(e), contract.accept, contract.review, contract.core_concepts)).drop(e)


def normalised(score: Column) -> Column:
    """A score in 0 to 1."""
    return F.least(F.lit(1.0), F.greatest(F.lit(0.0), score / 10))


def annotated(df: DataFrame, stage: str, title: Column, bodies: list[Column], contract: Contract, keep: tuple[str, ...] | None = None, concepts: Column | None = None, sources: Column | None = None) -> DataFrame:
    """Rows with the assessment as relevance_<stage>, its score, decision, route and eligibility as columns, and how many
    concepts and providers found them; of the decisions ``keep`` only."""
    name = f"relevance_{stage}"
    out = assessed(df, title, F.concat_ws(" ", *(F.when(F.trim(b) != "", b) for b in bodies)), contract, name)
    a = F.col(name)
    out = out.withColumns({"relevance_raw_score": a["score"], "relevance_score": normalised(a["score"]), "relevance_decision": a["decision"], "relevance_route": a["route"], "primary_eligible": a["primary_eligible"], "supplementary_eligible": a["supplementary_eligible"]})
    out = out.withColumns({"retrieval_concept_count": F.greatest(F.lit(0), F.size(concepts)) if concepts is not None else F.lit(0), "provider_convergence_count": F.size(F.array_distinct(F.filter(sources, lambda x: x != ""))) if sources is not None else F.lit(0)})
    return out if keep is None else out.where(F.col("relevance_decision").isin(*keep))


# gates ------------------------------------------------------------------------------------------
def candidate_gate(a: Column, retrieved: Column, titled: Column) -> Column:
    """struct(kept, decision): accepted and reviewable records pass; a titled one that a query returned waits for its
    body unless a hard exclusion was found."""
    passed = a["decision"].isin("accept", "review")
    rescued = ~passed & F.coalesce(retrieved, F.lit(False)) & F.coalesce(titled, F.lit(False)) & (F.size(a["hard_hits"]) == 0)
    return F.struct((passed | rescued).alias("kept"), F.when(rescued, "metadata_pending").otherwise(a["decision"]).alias("decision"))


def post_enrichment(a: Column, body: Column, conflict: Column, content_rejected: Column, identifiable: Column) -> Column:
    """struct(kept, eligibility, reason) once the body is there. ``conflict``: the record's identifiers disagree;
    ``content_rejected``: its body is another's; ``identifiable``: it has a title, body, identifier or address."""
    no = lambda c: ~F.coalesce(c, F.lit(False))
    content = ~no(content_rejected) & (a["route"] != "supplementary_related")
    primary = (fast_space(body) != "") & (a["route"] == "primary_candidate") & a["decision"].isin("accept", "review") & ~content & no(conflict) & ~a["hard_conflict"]
    supplementary = (a["route"] == "supplementary_related") & no(conflict) & ~a["hard_conflict"] & F.coalesce(identifiable, F.lit(False))
    reason = F.when(~no(conflict), "identifier_conflict").when(a["hard_conflict"], "hard_entity_conflict").when(content, "content_identity_rejected").when(a["decision"] == "reject", "post_enrichment_relevance_rejected").otherwise("missing_enriched_evidence")
    return F.struct((primary | supplementary).alias("kept"), F.when(supplementary, "supplementary_only").when(primary, "primary_candidate").alias("eligibility"), F.when(~(primary | supplementary), reason).alias("reason"))


def deterministic_accept(a: Column, reliable: Column) -> Column:
    """Acceptance without a reviewer: by identity evidence, never by length."""
    title, body, short = (F.size(a[c]) > 0 for c in ("title_hits", "body_hits", "qualified_hits"))
    reliable = F.coalesce(reliable, F.lit(False))
    excluded = (F.size(a["hard_hits"]) > 0) & ~(title | body | short)
    return (a["route"] == "primary_candidate") & a["identity_present"] & ~excluded & (title | body | short | ((F.size(a["context_hits"]) > 0) & reliable)) & (title | reliable | body)


def hard_conflict(identifier_conflict: Column, metadata_conflict: Column, content_status: Column, content_reason: Column, code: Column) -> Column:
    """Conflicts that nothing relaxes: of identifiers, metadata or content, or a reviewer's N."""
    no = lambda c: F.coalesce(c, F.lit(False))
    return no(identifier_conflict) | no(metadata_conflict) | no(content_status == "identity_conflict") | no(content_reason.isin("identity_conflict", "wrong_entity")) | no(code == "N")


# review -----------------------------------------------------------------------------------------
#: fixed values: words that stand for reviewers' codes
CODES = {"ACCEPT": "A", "RELEVANT": "A", "REJECT": "N", "IRRELEVANT": "N", "UNCERTAIN": "U", "SUPPLEMENTARY": "S", "RELATED": "S", "RELATED_ONLY": "S"}


def decision_code(c: Column) -> Column:
    """A reviewer's code (A, C, S, B, N, U) from a code or word; null if it is none."""
    up = F.upper(F.trim(F.coalesce(c, F.lit(""))))
    code = F.coalesce(F.try_element_at(F.create_map(*(F.lit(x) for kv in CODES.items() for x in kv)), up), up)
    return F.when(code.isin("A", "C", "S", "B", "N", "U"), code)


def parsed_decisions(df: DataFrame, payload: str) -> DataFrame:
    """(id, code, confidence, reason) of reviewers' answers in JSON: lists d or decisions of id, c or decision, p or
    confidence, r or reason (its first 120 characters). Of several answers for an id any later one may stand."""
    row = "array<struct<id:string,c:string,decision:string,p:string,confidence:string,r:string,reason:string>>"
    rows = df.select(F.from_json(payload, f"d {row}, decisions {row}").alias("x")).select(F.explode(F.coalesce("x.d", "x.decisions")).alias("x")).select("x.*")
    rows = rows.select("id", decision_code(F.coalesce("c", "decision")).alias("code"), F.coalesce("p", "confidence").alias("confidence"), F.left(fast_space(F.coalesce("r", "reason")), F.lit(120)).alias("reason"))
    return rows.where("id <> '' and code is not null").groupBy("id").agg(F.max_by(F.struct("code", "confidence", "reason"), F.col("code")).alias("x")).select("id", "x.*")


def route(code: Column, decision: Column) -> Column:
    """Final route from a reviewer's code (A, C, S, B, N, U); without one the assessment decides."""
    return F.when(code.isin("A", "C"), "primary").when(code.isin("S", "B"), "supplementary").when(code == "N", "rejected").when(decision == "accept", "primary").when(decision == "review", "supplementary").otherwise("rejected")


def review_key(kind: str, fingerprint: Column, identity: list[Column], evidence_: list[Column]) -> Column:
    """Key of a review in the cache: policy, kind, profile, identity and evidence."""
    first = lambda cs: F.coalesce(*(F.when(fast_space(c) != "", fast_space(c)) for c in cs), F.lit(""))
    return F.sha2(F.concat_ws("|", F.lit(POLICY), F.lit(kind), fast_space(fingerprint), first(identity), first(evidence_)), 256)


def snippets(df: DataFrame, key: str, text: str, contract: Contract, most: int = 4) -> DataFrame:
    """Rows (key, place, sentence, score): the sentences with most evidence, at most ``most``; of texts without any the
    first and the last. Every sentence counts; equal scores in order of the text."""
    rows = df.select(key, F.posexplode(review_sentences(F.col(text))).alias("pos", "sentence"))
    # fixed values: points of a term by class
    groups = (((*contract.target, *contract.member, *contract.disease, *(t for t, _ in contract.qualified)), 12), (contract.related, 7), (contract.context, 2), (contract.hard_excluded, 4))
    score = F.lit(0)
    for terms, points in groups:
        for t in dict.fromkeys(x if isinstance(x, str) else x[0] for x in terms):
            score = score + F.when(contains_term(F.col("sentence"), t), points).otherwise(0)
    w = Window.partitionBy(key)
    rows = rows.withColumn("score", score).withColumn("none", F.max("score").over(w) == 0).withColumn("last", F.max("pos").over(w))
    place = F.row_number().over(w.orderBy(F.col("score").desc(), "pos"))
    return rows.withColumn("place", place).where(f"(score > 0 and place <= {most}) or (none and (pos = 0 or pos = last))").select(key, "place", "sentence", "score")


# cliff guard ------------------------------------------------------------------------------------
#: fixed values: thresholds of the fields, lowered by a point a level
FIELD_THRESHOLDS = {"paper": {"title": 4, "abstract": 5, "full_body": 4}, "news": {"title": 5, "brief": 6, "full_body": 4}}
#: fixed values: alarms and targets
SETTINGS = {"min_candidates": 100, "ratio_min_candidates": 10, "min_accepted": 10, "previous_ratio": 0.20, "trigger_ratio": 0.30, "minimum_ratio": 0.15}


def field_threshold(field: str, level: int, kind: str) -> int:
    return max(1 if level >= 3 else 2, FIELD_THRESHOLDS[kind][field] - level)


def accept_field(a: Column, field: str, level: int, kind: str) -> Column:
    """Whether a field's assessment suffices at a level of relaxation (0 to 3); identity must be there at any."""
    title, body, context, excluded = (F.size(a[c]) > 0 for c in ("title_hits", "body_hits", "context_hits", "hard_hits"))
    limit, often = field_threshold(field, level, kind), a["frequency"]
    spared = {0: F.lit(False), 1: title | (often >= 2), 2: title | body | ((often >= 1) & context)}.get(level, title & (often >= 1))
    if level >= 3:
        enough = title | ((a["score"] >= limit) & ((often >= 2) | (body & context)))
    else:
        enough = (a["score"] >= limit) | (F.lit(field == "title") & title & (a["score"] >= limit - 1))
    return F.coalesce(a["identity_present"] & (~excluded | spared) & enough, F.lit(False))


def relaxed_accept(fields: dict[str, Column], level: int, kind: str, conflict: Column, eligible: Column) -> Column:
    """Acceptance of a record at a level by any of its fields' assessments (null: no such field), or by several that
    support each other; ``eligible``: its identity can be checked, which the last level asks for."""
    any_ = lambda cs: F.coalesce(F.greatest(*(F.coalesce(c, F.lit(False)).cast("int") for c in cs), F.lit(0)) > 0, F.lit(False))
    ok = any_([accept_field(a, f, level, kind) for f, a in fields.items()])
    if level == 2:
        identity = [F.coalesce(a["identity_present"], F.lit(False)) for a in fields.values()]
        ok = ok | (sum((i.cast("int") for i in identity), F.lit(0)) >= 2) | (any_(identity) & any_([F.size(a["context_hits"]) > 0 for a in fields.values()]))
    if level >= 3:
        ok = (ok | any_([(F.size(a["title_hits"]) > 0) | ((a["frequency"] >= 2) & (F.size(a["context_hits"]) > 0)) for a in fields.values()])) & F.coalesce(eligible, F.lit(False))
    return ok & ~F.coalesce(conflict, F.lit(False))


def alarms(n: int, accepted: int, previous: int = 0, settings: dict | None = None) -> list[str]:
    """Which alarms of a fall in acceptance go off."""
    s = settings or SETTINGS
    out = []
    if n >= s["min_candidates"] and accepted < s["min_accepted"]:
        out.append("absolute_acceptance_floor")
    if n >= s["ratio_min_candidates"] and accepted < s["trigger_ratio"] * n:
        out.append("candidate_acceptance_ratio")
    if n >= s["ratio_min_candidates"] and previous >= s["min_accepted"] and accepted < s["previous_ratio"] * previous:
        out.append("historical_acceptance_ratio")
    return out


def recovery_target(n: int, previous: int, reasons: list[str], settings: dict | None = None) -> int:
    """How many accepted records the alarms that went off ask for, each for its own."""
    s, up = settings or SETTINGS, lambda x: -int(-x // 1)
    asked = {"absolute_acceptance_floor": s["min_accepted"], "candidate_acceptance_ratio": up(round(n * s["minimum_ratio"], 9)), "historical_acceptance_ratio": up(round(previous * s["previous_ratio"], 9))}
    return min(n, max((asked[r] for r in reasons), default=0))


def cliff_guard(candidates: DataFrame, previous: int = 0, settings: dict | None = None) -> DataFrame:
    """(seq, accepted, level, ...) -> rows with recovered. Where acceptance fell off a cliff, rows that satisfy a level
    come back, in order of level and seq, until the target is reached. Null accepted counts as not accepted; rows with a
    null level never come back; without an alarm, or in an empty table, nothing does. Repeated seqs may swap places.

    Levels are counted, and only the level that the target cuts is put in order (by ranges of seq)."""
    told = cut(candidates.withColumn("accepted", F.coalesce("accepted", F.lit(False))))
    counts = told.groupBy("accepted", "level").count().collect()
    n, accepted = sum(r["count"] for r in counts), sum(r["count"] for r in counts if r["accepted"])
    missing = max(0, recovery_target(n, previous, alarms(n, accepted, previous, settings), settings) - accepted)
    open_ = sorted((r["level"], r["count"]) for r in counts if not r["accepted"] and r["level"] is not None)
    edge = None
    for level, count in open_:
        if count > missing:
            edge = level
            break
        missing -= count
    free = ~F.col("accepted") & F.col("level").isNotNull()
    if edge is None:
        return told.withColumn("recovered", free)
    if missing == 0:
        return told.withColumn("recovered", free & (F.col("level") < edge))
    first = placed(told.where(free & (F.col("level") == edge)), F.col("seq"), [F.col("seq")]).withColumn("recovered", F.col("place") <= missing).drop("place")
    return told.where(~(free & (F.col("level") == edge)) | (free & (F.col("level") == edge)).isNull()).withColumn("recovered", F.coalesce(free & (F.col("level") < edge), F.lit(False))).unionByName(first)


def rejection_codes(a: Column, identifier_conflict: Column, content_reason: Column, code: Column) -> Column:
    """Why a record was rejected, once each, in a fixed order."""
    no = lambda c: F.coalesce(c, F.lit(False))
    code = F.coalesce(code, F.lit(""))
    told = F.array_compact(F.array(
        F.when(no(identifier_conflict), "identifier_conflict"), F.when(F.coalesce(content_reason, F.lit("")) != "", content_reason), F.when(code != "", F.concat(F.lit("llm_code_"), code)),
        F.when(F.size(a["ambiguous_hits"]) > 0, "ambiguous_abbreviation_without_context"), F.when(F.size(a["hard_hits"]) > 0, "hard_excluded_entity_hit"), F.when(F.size(a["related_hits"]) > 0, "related_entity_supplementary_route"),
        F.when(~a["identity_present"], "identity_not_established"), F.when(a["decision"] == "reject", "score_below_final_threshold"),
    ))
    return F.array_distinct(F.when(F.size(told) == 0, F.array(F.lit("unclassified_rejection"))).otherwise(told))
