"""Evidence sentences: headings, roles, sections, balanced selection under a budget, and fields extracted without a model."""

from __future__ import annotations

import math
import re
from collections import Counter

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from ..functions import text

# fixed values: headings and their roles; roles by cue, first match wins
HEADINGS = {
    "background": "background", "introduction": "background", "objective": "objective", "objectives": "objective", "aim": "objective", "aims": "objective", "purpose": "objective",
    "design": "design_population", "setting": "design_population", "participants": "design_population", "patients": "design_population", "methods": "methods", "methodology": "methods",
    "results": "results", "findings": "results", "interpretation": "interpretation", "discussion": "interpretation", "conclusion": "conclusion", "conclusions": "conclusion",
    "limitations": "limitations", "implications": "implications",
}
ROLE_CUES = (
    ("background", r"^(background|introduction)\b|\b(knowledge gap|remains unclear|is unknown|has emerged|is poorly understood|little is known|lack of)\b"),
    ("objective", r"^(objective|objectives|aim|aims|purpose)\b|\b(we aimed|this study aimed|the study aimed|we sought|we investigated|we evaluated|we assessed|our objective)\b"),
    ("methods", r"^(methods|methodology|procedures|statistical analysis)\b|\b(we used|we performed|we conducted|we analy[sz]ed|we measured|we tested|we sequenced|we modeled|was measured|were measured|were tested|was assessed|were assessed|data were collected|samples were collected|sequencing|assay|elisa|pcr|rt-pcr|serolog|immunoassay|regression|phylogen|variant calling|machine learning|force[- ]of[- ]infection|meta-analysis|systematic search|databases were searched|prisma|model was|using a|using an)\b"),
    ("results", r"^(results|findings)\b|\b(we found|we observed|we identified|showed|demonstrated|revealed|reported|was associated|were associated|were detected|was detected|were seropositive|was seropositive|increased|decreased|survived|died|accounted for|compared with|compared to|odds ratio|hazard ratio|risk ratio|confidence interval|p\s*[=<]|\d+(?:\.\d+)?%|\d+\s+of\s+\d+)\b"),
    ("design_population", r"^(design|setting|participants|patients|population|samples|materials)\b|\b(cross-sectional|cohort|case-control|randomi[sz]ed|non-randomi[sz]ed|retrospective|prospective|multicentre|multicenter|case series|case report|animal model|participants were|patients were|samples were|individuals were|subjects were|enrolled|included|recruited|hospitali[sz]ed|specimens from|samples from|n\s*[=:]\s*\d+|\d+\s+(patients|participants|subjects|samples|animals|cases|records|studies))\b"),
    ("interpretation", r"^(interpretation|discussion)\b|\b(we interpret|these findings suggest|these results suggest|authors suggest|authors stated|may indicate|indicates that|supports the hypothesis|to our knowledge|first report|first nationwide|novel)\b"),
    ("conclusion", r"^(conclusion|conclusions)\b|\b(in conclusion|we conclude|we suggest|the study concludes|supports the|highlight(?:s|ed) the need)\b"),
    ("limitations", r"^(limitations|limitation)\b|\b(limited by|small sample|selection bias|recall bias|confounding|cannot establish|could not establish|generalizability|generalisability|single[- ]cent(?:er|re)|abstract only|further studies are needed|evidence remains limited|heterogeneity|data were unavailable)\b"),
    ("implications", r"^(implications|significance|recommendations)\b|\b(public health|surveillance|clinical practice|future research|further study|prevention|preparedness|risk assessment|diagnosis|vaccination|treatment|monitoring|control measures|policy)\b"),
)
#: fixed values: sections of a paper with prefix, most sentences and role
SECTIONS = (("methods", "M", 10, "methods"), ("results", "R", 14, "results"), ("discussion", "D", 8, "interpretation"), ("conclusion", "C", 6, "conclusion"), ("abstract", "B", 18, "general"), ("full_text", "F", 18, "general"), ("other", "O", 5, "general"))
_HEADING = r"(?i)^(" + "|".join(sorted(HEADINGS, key=len, reverse=True)) + r")\s*[:.-]\s*"


def heading_role(c: Column) -> Column:
    """Role of the heading that a sentence begins with; null without one."""
    return F.try_element_at(F.create_map(*(F.lit(x) for kv in HEADINGS.items() for x in kv)), F.lower(F.regexp_extract(c, _HEADING, 1)))


def without_heading(c: Column) -> Column:
    return F.trim(F.regexp_replace(c, _HEADING, ""))


def sentence_role(c: Column, default: Column | str = "general") -> Column:
    """Role by heading, else by the first cue, else ``default``."""
    own, out = without_heading(c), F.when(heading_role(c).isNotNull(), heading_role(c))
    for name, cue in ROLE_CUES:
        out = out.when(own.rlike("(?i)" + cue), name)
    return out.otherwise(F.lit(default) if isinstance(default, str) else default)


def evidence_rows(df: DataFrame, key: str, column: str, prefix: str = "S", most: int | None = 50, default: str = "general") -> DataFrame:
    """Rows (key, pos, id, role, text): the first ``most`` sentences (None: all) of each record. A sentence without heading
    or cue takes the role of the last heading before it. Null texts have none."""
    rows = df.select(key, F.posexplode(text.sentences(F.col(column), most)).alias("pos", "sentence"))
    last = F.last(heading_role(F.col("sentence")), True).over(Window.partitionBy(key).orderBy("pos").rowsBetween(Window.unboundedPreceding, 0))
    rows = rows.withColumn("carried", F.coalesce(last, F.lit(default)))
    return rows.select(key, "pos", F.concat(F.lit(prefix), (F.col("pos") + 1).cast("string")).alias("id"), sentence_role(F.col("sentence"), F.col("carried")).alias("role"), F.when(without_heading(F.col("sentence")) == "", F.col("sentence")).otherwise(without_heading(F.col("sentence"))).alias("text"))


def section_rows(df: DataFrame, key: str, sections: str) -> DataFrame:
    """``evidence_rows`` of a map of sections, each with its prefix, role and most sentences, in the fixed order."""
    out = None
    for place, (name, prefix, most, role) in enumerate(SECTIONS):
        own = evidence_rows(df.select(key, F.try_element_at(F.col(sections), F.lit(name)).alias("t")), key, "t", prefix, most, role).withColumn("section", F.lit(place))
        out = own if out is None else out.unionByName(own)
    return out


def jats_section(title: Column) -> Column:
    """Which section a heading belongs to."""
    t = F.lower(F.coalesce(title, F.lit("")))
    return F.when(t.rlike("method|material|patient|study design"), "methods").when(t.rlike("result|finding"), "results").when(t.contains("discussion"), "discussion").when(t.rlike("conclusion|summary"), "conclusion").otherwise("other")


#: fixed values: priorities of roles, and signs of results and methods
PRIORITY = {"results": 9.0, "methods": 8.5, "design_population": 8.0, "limitations": 7.5, "conclusion": 7.0, "interpretation": 6.5, "implications": 6.0, "objective": 5.5, "background": 4.0, "general": 2.0}
RESERVED = ("methods", "results", "design_population", "limitations", "conclusion", "interpretation", "implications", "objective", "background", "general")
NUMERIC = re.compile(r"(?:\b\d+(?:\.\d+)?%|\b\d+\s+of\s+\d+|\bp\s*[=<]|confidence interval|odds ratio|hazard ratio|risk ratio)", re.I)
METHOD = re.compile(r"\b(?:assay|ELISA|PCR|sequenc|regression|model|phylogen|sampling|questionnaire|database|machine learning|statistical)\b", re.I)


def word_list(s: str) -> list[str]:
    return re.findall(r"[a-z][a-z0-9_-]{2,}|[一-鿿]{2,}", s.lower())


def row_scores(roles: list[str], texts: list[str]) -> list[float]:
    """Worth of each sentence: role, rarity of its words in the record, numbers, methods, length, place."""
    words = [Counter(word_list(t)) for t in texts]
    spread = Counter(w for c in words for w in c)
    n, out = len(texts), []
    for i, (role, own, t) in enumerate(zip(roles, words, texts, strict=True)):
        rarity = sum(min(k, 3) * (math.log((n + 1) / (spread[w] + 0.5)) + 1) for w, k in own.items())
        late = role in ("results", "conclusion", "limitations", "implications") and i / max(1, n - 1) > 0.35
        out.append(PRIORITY.get(role, 2.0) + min(rarity / 8, 5.0) + 5 * bool(NUMERIC.search(t)) + 3 * bool(METHOD.search(t)) + 1.5 * (60 <= len(t) <= 900) + late)
    return out


def chosen(roles: list[str], texts: list[str], budget: int, each: int = 1) -> list[int]:
    """Places of the sentences of an evidence pack: the best of every role first, then the best of all that do not repeat
    a chosen one (token Jaccard 0.84), while they fit (80 characters each besides their own)."""
    budget, score = max(2500, budget), row_scores(roles, texts)
    best = sorted(range(len(texts)), key=lambda i: (-score[i], i))
    bags = [set(word_list(t)) for t in texts]
    taken: list[int] = []
    room = budget

    def take(i: int) -> None:
        nonlocal room
        if i not in taken and len(texts[i]) + 80 <= room:
            taken.append(i)
            room -= len(texts[i]) + 80

    for role in RESERVED:
        for i in [i for i in best if roles[i] == role][: max(1, each)]:
            take(i)
    for i in best:
        if not any(bags[i] and bags[j] and len(bags[i] & bags[j]) >= 0.84 * len(bags[i] | bags[j]) for j in taken):
            take(i)
    return sorted(taken)


def select_rows(df: DataFrame, key: str, budget: int, each: int = 1) -> DataFrame:
    """Rows (key, pos, id, role, text) of ``evidence_rows`` that make each record's pack. A record's sentences meet in one
    group, so records are taken to have boundedly many."""
    schema = df.select(key, "pos", "id", "role", "text").schema

    def run(rows: pd.DataFrame) -> pd.DataFrame:
        rows = rows.sort_values("pos").reset_index(drop=True)
        return rows.iloc[chosen(rows["role"].tolist(), rows["text"].tolist(), budget, each)]

    return df.where("id <> '' and text <> ''").select(key, "pos", "id", "role", "text").groupBy(key).applyInPandas(run, schema)


def compacted(df: DataFrame, key: str, budget: int, per_role: int = 2, cost: int = 40) -> DataFrame:
    """Rows of a prompt: the first ``per_role`` sentences of each role, then in order those that still fit (``cost``
    characters each besides their own); all where all fit."""
    schema = df.schema

    def run(rows: pd.DataFrame) -> pd.DataFrame:
        rows = rows.sort_values("pos").reset_index(drop=True)
        size = rows["text"].str.len() + cost
        if size.sum() <= budget:
            return rows
        first = rows.groupby("role").cumcount() < per_role
        used, keep = int(size[first].sum()), first.tolist()
        for i in rows.index[~first]:
            if used + size[i] <= budget:
                used += int(size[i])
                keep[i] = True
        return rows[keep]

    return df.groupBy(key).applyInPandas(run, schema)


# fields without a model -------------------------------------------------------------------------
#: fixed values: fields of research papers with the roles they take, their place in the text and their cues, in order of choice
FIELDS = {
    "methods": (("methods",), 0.38, r"\b(using|used|performed|conducted|analy[sz]ed|measured|tested|sequenced|assay|elisa|pcr|rt-pcr|regression|model|phylogen|variant calling|sampling|collected|questionnaire|database|machine learning|meta-analysis|systematic search|force[- ]of[- ]infection)\b"),
    "main_results": (("results",), 0.62, r"\b(found|observed|identified|detected|showed|demonstrated|revealed|associated|increased|decreased|survived|died|significant|confidence interval|odds ratio|hazard ratio|risk ratio|\d+(?:\.\d+)?%|\d+\s+of\s+\d+|p\s*[=<])\b"),
    "study_design_and_population": (("design_population",), 0.25, r"\b(retrospective|prospective|cross-sectional|cohort|case-control|randomi[sz]ed|study|survey|patients?|participants?|subjects?|workers?|samples?|specimens?|animals?|records?|cases?|between\s+\w+\s+and|n\s*[=:]\s*\d+)\b"),
    "research_question_and_background": (("objective", "background", "general"), 0.08, r"\b(aim|objective|purpose|investigat|evaluat|assess|knowledge gap|unknown|unclear|risk|burden|causes?)\b"),
    "interpretation_and_novelty": (("interpretation", "conclusion"), 0.82, r"\b(suggest|indicat|interpret|conclude|supports?|to our knowledge|first|novel|driven by|unlikely)\b"),
    "scientific_and_public_health_significance": (("implications", "conclusion"), 0.92, r"\b(surveillance|public health|prevention|preparedness|diagnos|treat|vaccin|monitor|risk assessment|clinical practice|future research|control|policy|need for)\b"),
    "limitations_and_evidence_strength": (("limitations",), 0.95, r"\b(limit|bias|confound|small sample|single[- ]cent|generaliz|heterogeneity|cannot establish|further studies|abstract only|uncertain|evidence remains)\b"),
}
MODELLING = re.compile(r"\b(mathematical|compartmental|fractional[- ]order|caputo|simulation|algorithm|machine learning|neural network|pinn|bayesian|regression|model(?:ing|ling)?|optimization|sensitivity analysis|cost[- ]effectiveness|phylogenetic|genomic|bioinformatic)\b", re.I)
#: fixed values: words that count more in computational work
MODELLING_CUES = {"methods": (26.0, r"\b(model|simulation|algorithm|network|regression|optimization|sensitivity)\b"), "main_results": (22.0, r"\b(predicted|estimated|simulation|scenario|accuracy|performance|reproduction number|r0|cost[- ]effective)\b"), "study_design_and_population": (12.0, r"\b(dataset|records?|surveillance data|parameters?|scenarios?|model)\b")}


def track(texts: list[str]) -> str:
    return "computational_or_modeling" if MODELLING.search(" ".join(texts)) else "empirical_or_clinical"


def candidate_score(field: str, role: str, sentence: str, place: int, total: int, kind: str) -> float:
    """How well a sentence states a field: role, cue, place, numbers."""
    roles, target, cue = FIELDS[field]
    at = place / max(1, total - 1) if total > 1 else 0.5
    score = (28.0 if role == "general" else 80.0) if role in roles else 0.0
    score += 58.0 * bool(re.search(cue, sentence, re.I)) + max(0.0, 24.0 - 38.0 * abs(at - target))
    if re.search(r"\d", sentence):
        score += {"main_results": 18.0, "study_design_and_population": 8.0}.get(field, 0.0)
    if kind == "computational_or_modeling" and field in MODELLING_CUES and re.search(MODELLING_CUES[field][1], sentence, re.I):
        score += MODELLING_CUES[field][0]
    return score + 8.0 * (at > 0.65 and field in ("interpretation_and_novelty", "scientific_and_public_health_significance"))


def extracted(roles: list[str], texts: list[str], least: float = 36.0) -> dict[str, int | None]:
    """For each field, in order of choice, the place of the best sentence not yet used; null below ``least``."""
    kind, used, out = track(texts), set(), {}
    for field in FIELDS:
        best = max(((candidate_score(field, roles[i], texts[i], i, len(texts), kind), -i) for i in range(len(texts)) if i not in used), default=(0.0, 0))
        out[field] = -best[1] if best[0] >= least else None
        if out[field] is not None:
            used.add(out[field])
    return out


def extract_fields(df: DataFrame, key: str) -> DataFrame:
    """Rows (key, field, id, text) for ``evidence_rows``: what each field of a research paper says, null where no sentence
    states it. A sentence serves one field."""
    kind = df.schema[key].dataType.simpleString()

    def run(rows: pd.DataFrame) -> pd.DataFrame:
        rows = rows.sort_values("pos")
        ids, texts = rows["id"].tolist(), rows["text"].tolist()
        found = extracted(rows["role"].tolist(), texts)
        return pd.DataFrame([(rows[key].iloc[0], f, None if i is None else ids[i], None if i is None else texts[i]) for f, i in found.items()], columns=[key, "field", "id", "text"])

    return df.groupBy(key).applyInPandas(run, f"`{key}` {kind}, field string, id string, text string")


#: fixed values: signs of a review
REVIEW = r"(?i)\b(systematic review|meta-analysis|scoping review|narrative review|literature review|review article|overview)\b"


def paper_kind(types: Column, title: Column, abstract: Column, terms: dict[str, tuple[str, ...]] | None = None) -> Column:
    """research or review: by most terms of the configured categories (ties: reviews), else by signs of a review. The first
    1,200 characters of the abstract count (the operator's own bound)."""
    hay = F.lower(F.concat_ws(" ", F.array_join(F.coalesce(types, text.EMPTY()), " "), title, F.left(text.fast_space(abstract), F.lit(1200))))
    plain = F.when(hay.rlike(REVIEW), "review").otherwise("research")
    if not terms:
        return plain
    votes = [F.struct(sum((hay.contains(t.lower()).cast("int") for t in ts), F.lit(0)).alias("n"), F.lit(c in ("systematic_review", "narrative_review")).alias("review")) for c, ts in terms.items()]
    best = F.greatest(*votes) if len(votes) > 1 else votes[0]
    return F.when(best["n"] == 0, plain).when(best["review"], "review").otherwise("research")
