"""Terms of a topic found in a text: complete entities before the shorter ones inside them."""

from __future__ import annotations

import re
from dataclasses import dataclass, field
from functools import cached_property

import pandas as pd
from pyspark.sql import Column
from pyspark.sql import functions as F

from ..functions.text import contained_pattern, folded, term_pattern

#: fixed values: categories, first preferred among hits of equal length
CATEGORIES = ("hard_excluded", "related", "target", "member", "disease")
#: fixed values: relation and route of a term that names none
DEFAULTS = {"related": ("taxonomic_or_biological_neighbour", "supplementary"), "hard_excluded": ("unrelated_or_lexical_noise", "reject")}
IDENTITY = ("target", "member", "disease")


@dataclass(frozen=True)
class Contract:
    """Terms of a topic by role (a term, or term, relation and route), abbreviations that count in context only, thresholds."""

    target: tuple = ()
    member: tuple = ()
    disease: tuple = ()
    related: tuple = ()
    hard_excluded: tuple = ()
    context: tuple[str, ...] = ()
    qualified: tuple[tuple[str, tuple[str, ...]], ...] = ()
    accept: int = 6
    review: int = 3
    core_concepts: bool = False
    _made: dict = field(default_factory=dict, repr=False, compare=False)

    @cached_property
    def patterns(self) -> list[tuple[re.Pattern, str, int, str, str]]:
        """Pattern, term, rank of its category, relation and route; the first of equal terms of a category counts."""
        out = []
        for rank, category in enumerate(CATEGORIES):
            for term, relation, route in term_rows(getattr(self, category), *DEFAULTS.get(category, ("", ""))):
                out.append((re.compile(term_pattern(term)), term, rank, relation, route))
        return out

    def scarce(self) -> Contract:
        """Thresholds a point lower, for topics with little news."""
        return Contract(self.target, self.member, self.disease, self.related, self.hard_excluded, self.context, self.qualified, max(4, self.accept - 1), max(2, self.review - 1), self.core_concepts)


def term_rows(terms, relation: str = "", route: str = "") -> list[tuple[str, str, str]]:
    """Terms with relation and route, once by their normalised form; those without letters or digits go."""
    out = {}
    for t in terms:
        term, own_relation, own_route = (t, "", "") if isinstance(t, str) else (*t, "", "")[:3]
        key = " ".join(re.findall("[a-z0-9]+", folded(term).lower()))
        if key:
            out.setdefault(key, (folded(term), own_relation or relation, own_route or route))
    return list(out.values())


def hay_of(text: str) -> str:
    return folded(text).lower().replace("–", "-").replace("—", "-")


def hits(text: str, contract: Contract) -> list[tuple[int, int, int, str, str, str]]:
    """All finds: start, end, rank of the category, term, relation, route."""
    hay = hay_of(text)
    return [(m.start(), m.end(), rank, term, relation, route) for p, term, rank, relation, route in contract.patterns for m in p.finditer(hay)]


def stronger(a: tuple, b: tuple) -> bool:
    """Whether find a wins over an overlapping find b: hard exclusions first; of a related and a target entity the one that
    begins first; else the longer; else by category."""
    if (a[2] == 0) != (b[2] == 0):
        return a[2] == 0
    if (a[2] == 1) != (b[2] == 1) and a[0] != b[0] and 0 not in (a[2], b[2]):
        return a[0] < b[0]
    if a[1] - a[0] != b[1] - b[0]:
        return a[1] - a[0] > b[1] - b[0]
    return a[2] < b[2]


def resolved(found: list[tuple]) -> list[tuple]:
    """Finds that do not overlap: from left to right, longest first, each replaces those it overlaps if it wins over all of them."""
    kept: list[tuple] = []
    for hit in sorted(found, key=lambda h: (h[0], h[0] - h[1], h[2])):
        rivals = [k for k in kept if k[0] < hit[1] and hit[0] < k[1]]
        if all(stronger(hit, r) for r in rivals):
            kept = [k for k in kept if k not in rivals] + [hit]
    return sorted(kept, key=lambda h: (h[0], h[1], h[2]))


def terms_by_category(text: str, contract: Contract) -> dict[str, list[str]]:
    out: dict[str, dict[str, str]] = {c: {} for c in CATEGORIES}
    for _, _, rank, term, _, _ in resolved(hits(text, contract)):
        out[CATEGORIES[rank]].setdefault(term.lower(), term)
    return {c: list(v.values()) for c, v in out.items()}


_SIDE = "struct<" + ",".join(f"{c}:array<string>" for c in CATEGORIES) + ">"
EVIDENCE = f"title {_SIDE}, body {_SIDE}, context array<string>, qualified array<string>, ambiguous array<string>, frequency int"


def evidence(contract: Contract):
    """A function of title and body columns: struct of the terms of each category in either, context terms, abbreviations
    with and without their context, and how often identity terms occur. Null counts as empty."""
    contexts = [(c, re.compile(contained_pattern(c))) for c in dict.fromkeys(contract.context) if c.strip()]
    short = [(t, re.compile(contained_pattern(t)), [re.compile(contained_pattern(r)) for r in need]) for t, need in contract.qualified if t.strip()]

    @F.pandas_udf(EVIDENCE)
    def run(title: pd.Series, body: pd.Series) -> pd.DataFrame:
        rows = []
        for t, b in zip(title.fillna(""), body.fillna(""), strict=True):
            t, b = folded(t), folded(b)
            hay = f"{t} {b}".strip().lower()
            one, two = terms_by_category(t, contract), terms_by_category(b, contract)
            seen = [(name, any(n.search(hay) for n in need)) for name, p, need in short if p.search(hay)]
            good, bad = [n for n, ok in seen if ok], [n for n, ok in seen if not ok]
            identity = dict.fromkeys(x.lower() for x in [*(x for side in (one, two) for c in IDENTITY for x in side[c]), *good])
            rows.append((one, two, [c for c, p in contexts if p.search(hay)], good, bad, sum(len(re.findall(contained_pattern(x), hay)) for x in identity)))
        return pd.DataFrame(rows, columns=["title", "body", "context", "qualified", "ambiguous", "frequency"])

    return run


def resolve(contract: Contract):
    """A function of a text column: array of struct(term, category, start, end, relation, route), offsets in the cleaned text."""

    @F.pandas_udf("array<struct<term:string,category:string,start:int,end:int,relation:string,route:string>>")
    def run(c: pd.Series) -> pd.Series:
        return c.fillna("").map(lambda x: [{"term": t, "category": CATEGORIES[r], "start": a, "end": b, "relation": rel, "route": route} for a, b, r, t, rel, route in resolved(hits(x, contract))])

    return run


def overlap(a: Column, b: Column) -> Column:
    """Whether two intervals (start, end) overlap."""
    return (a["start"] < b["end"]) & (b["start"] < a["end"])
