"""JSON of models: tolerant parsing, fields under other names, references, validation."""

from __future__ import annotations

import ast
import json
import re

import pandas as pd
from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql.types import StringType, StructField, StructType

from ..functions import text

#: fixed values: words that stand for confidences and sources
CONFIDENCE = {"high": "high", "strong": "high", "very high": "high", "moderate": "moderate", "medium": "moderate", "mid": "moderate", "low": "low", "weak": "low"}
SOURCES = {
    "official": "official", "government": "official", "public health authority": "official", "reputable media": "reputable_media", "major media": "reputable_media", "secondary media": "secondary_media",
    "aggregator": "aggregator", "rss": "aggregator", "unclear": "unclear", "unknown": "unclear",
}


def balanced(raw: str) -> list[str]:
    """Substrings from an opening bracket to its closing one, strings respected: of the first object that closes, and of
    the first list, in that order."""
    out = []
    for pair in ("{}", "[]"):
        for start in (m.start() for m in re.finditer(re.escape(pair[0]), raw)):
            depth, quoted = 0, False
            for m in re.finditer(rf'\\.|["{re.escape(pair)}]', raw[start:]):
                c = m[0]
                if c == '"':
                    quoted = not quoted
                elif not quoted and c in pair:
                    depth += 1 if c == pair[0] else -1
                    if not depth:
                        out.append(raw[start : start + m.end()])
                        break
            if out and out[-1][0] == pair[0]:
                break
    return out


def loaded(raw: str) -> tuple[str | None, str]:
    """(canonical JSON, method) of a model's answer: fences dropped; as it is, or a balanced part; with trailing commas
    dropped; as a Python literal. (None, category) if nothing parses."""
    raw = re.sub(r"\s*```\s*$", "", re.sub(r"^```(?:json|javascript|python)?\s*", "", (raw or "").replace("﻿", "").strip(), flags=re.I))
    for name, part in dict.fromkeys([("direct_json", raw), *(("balanced_json", b) for b in balanced(raw))]):
        bare = re.sub(r",\s*([}\]])", r"\1", part)
        for method, x in ((name, part), (f"{name}_trailing_comma_repair", bare)):
            try:
                return json.dumps(json.loads(x), ensure_ascii=False, sort_keys=True), method
            except ValueError:
                pass
            try:
                value = ast.literal_eval(x)
                if isinstance(value, (dict, list)):
                    return json.dumps(value, ensure_ascii=False, sort_keys=True, default=str), f"{method}_python_literal_repair"
            except (SyntaxError, ValueError, MemoryError, RecursionError):
                pass
    return None, "context_or_output_limit" if raw.count("{") > raw.count("}") else "invalid_json"


@F.pandas_udf(StructType([StructField("json", StringType()), StructField("method", StringType())]))
def parsed(c: pd.Series) -> pd.DataFrame:
    """struct(json, method) of ``loaded``; json is null where nothing parses."""
    return pd.DataFrame([loaded(x) for x in c], columns=["json", "method"])


def field_key(c: Column) -> Column:
    """A name in lower case with underscores."""
    return F.regexp_replace(F.regexp_replace(F.lower(text.fast_space(c)), "[^a-z0-9]+", "_"), "^_+|_+$", "")


def _named(name: str):
    return lambda r: r["k"] == name


def find_value(m: Column, name: str, aliases: tuple[str, ...] = ()) -> Column:
    """struct(value, key) of the first of a field's names that a map has, however written; nulls if it has none."""
    rows = F.transform(F.map_entries(m), lambda e: F.struct(field_key(e["key"]).alias("k"), e["key"].alias("key"), e["value"].alias("value")))
    found = [F.get(F.filter(rows, _named(a)), 0) for a in (name, *aliases)]
    one = F.coalesce(*found)
    return F.struct(one["value"].alias("value"), one["key"].alias("key"))


def parse_refs(c: Column) -> Column:
    """References of a list in brackets, or separated by commas, semicolons, bars or blanks; once each, in order."""
    return F.array_distinct(F.filter(F.split(F.regexp_replace(F.coalesce(c, F.lit("")), r"[\[\](){}'\"]", " "), r"[,;|\s]+"), lambda x: x != ""))


def canonical_refs(refs: Column, valid: Column) -> Column:
    """References as the valid ids are written, case apart; unknown ones as they are; once each."""
    return F.array_distinct(F.transform(F.coalesce(refs, text.EMPTY()), lambda r: F.coalesce(F.get(F.filter(valid, lambda v: F.lower(v) == F.lower(r)), 0), r)))


def _word(c: Column, table: dict[str, str]) -> Column:
    low = F.regexp_replace(F.lower(text.fast_space(c)), "[-_]", " ")
    return F.coalesce(F.try_element_at(F.create_map(*(F.lit(x) for kv in table.items() for x in kv)), low), F.replace(low, F.lit(" "), F.lit("_")))


def confidence(c: Column) -> Column:
    return _word(c, CONFIDENCE)


def source_assessment(c: Column) -> Column:
    return _word(c, SOURCES)


def issues(analysis: Column, refs: Column, fields: tuple[str, ...], valid: Column, summary: Column, confidence_: Column, news: bool = False, require_brief: bool = False) -> Column:
    """Issues of a candidate as category:field, in order of the fields, then summary and confidence. ``analysis``: map of
    texts; ``refs``: map of lists of ids."""
    least, told = 8 if news else 12, []
    for f in fields:
        v = text.fast_space(F.try_element_at(analysis, F.lit(f)))
        r = F.coalesce(F.try_element_at(refs, F.lit(f)), text.EMPTY())
        told += [
            F.when(v == "", f"required_field_missing:{f}").when(F.length(v) < least, f"field_too_short:{f}"), F.when(~text.verified_english(v), f"language_region_error:{f}"),
            F.when(F.size(r) == 0, f"evidence_ids_missing:{f}").when(F.size(F.array_except(r, valid)) > 0, f"evidence_id_unknown:{f}"),
        ]
    s, key = text.fast_space(summary), "brief_en" if news else "summary_en"
    if news and not require_brief:
        told.append(F.when(s != "", f"short_source_brief_must_be_empty:{key}"))
    else:
        told.append(F.when(s == "", f"summary_missing:{key}").when(~text.verified_english(s), f"language_region_error:{key}"))
    told.append(F.when(~F.coalesce(confidence_.isin("high", "moderate", "low"), F.lit(False)), "invalid_confidence:confidence"))
    return F.array_compact(F.array(*told))


def repair_targets(found: Column, fields: tuple[str, ...]) -> Column:
    """Fields to repair: those that issues name, all where fields repeat each other; once each."""
    named = F.transform(found, lambda i: F.substring_index(i, ":", -1))
    every = F.when(F.exists(found, lambda i: i.startswith("cross_field_duplicate")), F.array(*map(F.lit, fields))).otherwise(text.EMPTY())
    return F.array_distinct(F.filter(F.concat(named, every), lambda f: f.isin(*fields, "summary_en", "brief_en", "confidence", "source_assessment")))


def merge_repair(base: Column, repair: Column, targets: Column) -> Column:
    """A map of fields with the targets' values from a repair, where it has them."""
    return F.transform_values(base, lambda k, v: F.when(F.array_contains(targets, k), F.coalesce(F.try_element_at(repair, k), v)).otherwise(v))
