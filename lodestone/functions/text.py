"""Text scalars as Column expressions; Arrow batches only where Spark has no built-in (Unicode folding, ordered folds)."""

from __future__ import annotations

import html
import re
import unicodedata

import pandas as pd
from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, StringType

SPACE = r"(?U)\s+"
EMPTY = lambda: F.array().cast("array<string>")


def _each(f, kind=None):
    """A Column function from a Python one over strings, in Arrow batches; null counts as empty."""

    @F.pandas_udf(kind or StringType())
    def run(c: pd.Series) -> pd.Series:
        return c.map(lambda x: f(x or ""), na_action=None)

    return run


def let(value: Column, body) -> Column:
    """``body`` of a value that is computed once; inlined into a lambda it would be computed for each element."""
    return F.transform(F.array(value), body)[0]


# white space and markup -------------------------------------------------------------------------
def blank(c: Column) -> Column:
    """Null or empty after trimming."""
    return F.coalesce(F.trim(c) == "", F.lit(True))


def first_nonempty(*cs: Column) -> Column:
    """The first value that is not blank (text) or not null (other types)."""
    return F.coalesce(*(F.when(~blank(c.cast("string")), c) for c in cs))


def ensure_list(c: Column, is_list: bool = False) -> Column:
    """Null becomes an empty list, a single value a list of it."""
    return F.coalesce(c if is_list else F.when(c.isNotNull(), F.array(c)), EMPTY())


def fast_space(c: Column) -> Column:
    """White space collapsed and trimmed, built-in functions only; null gives an empty string."""
    return F.trim(F.regexp_replace(F.coalesce(c, F.lit("")), SPACE, " "))


def folded(x: str) -> str:
    return " ".join(unicodedata.normalize("NFKC", html.unescape(x)).split())


#: Entities, all Unicode compatibility forms and white space, in Arrow batches: for a column of its own (Spark allows no
#: Python function inside array functions). ``clean_space`` covers the common cases in built-in functions.
clean_space_exact = _each(folded)
#: fixed values: common entities (the ampersand's last), full-width ASCII
ENTITIES = (("&lt;", "<"), ("&gt;", ">"), ("&quot;", '"'), ("&#39;", "'"), ("&#x27;", "'"), ("&apos;", "'"), ("&nbsp;", "\u00a0"), ("&amp;", "&"))
WIDE, NARROW = "".join(map(chr, range(0xFF01, 0xFF5F))) + "\u3000\u00a0", "".join(map(chr, range(0x21, 0x7F))) + "  "


def unescape(c: Column) -> Column:
    """Common entities resolved."""
    c = F.coalesce(c, F.lit(""))
    for name, char in ENTITIES:
        c = F.replace(c, F.lit(name), F.lit(char))
    return c


def clean_space(c: Column) -> Column:
    """Common entities and full-width ASCII resolved, white space collapsed and trimmed; null gives an empty string."""
    return fast_space(F.translate(unescape(c), WIDE, NARROW))


def strip_tags(c: Column) -> Column:
    """Entities first, so that encoded markup goes too, then tags, then white space."""
    return clean_space(F.regexp_replace(unescape(c), "<[^>]+>", " "))


def html_escape(c: Column) -> Column:
    c = F.coalesce(c, F.lit(""))
    for raw, safe in (("&", "&amp;"), ("<", "&lt;"), (">", "&gt;"), ('"', "&quot;"), ("'", "&#x27;")):
        c = F.replace(c, F.lit(raw), F.lit(safe))
    return c


def visible_text_count(c: Column) -> Column:
    """Characters of an HTML page that a reader sees: no scripts, styles, tags or white space."""
    shown = F.regexp_replace(F.coalesce(c, F.lit("")), r"(?is)<(script|style|noscript|template)\b.*?</\1\s*>", "")
    return F.length(F.regexp_replace(unescape(F.regexp_replace(shown, "<[^>]+>", "")), SPACE, ""))


#: fixed values: elements and class words that never belong to an article's body
REMOVED_TAGS = ("nav", "header", "footer", "aside", "script", "style", "noscript", "form", "button", "svg")
REMOVED_CLASSES = ("cookie", "cookies", "menu", "navigation", "navbar", "sidebar", "related", "recommended", "subscribe", "newsletter", "advertisement", "advert", "share", "social", "app-banner")


def clean_dom(c: Column) -> Column:
    """A page without navigation, forms, scripts, and elements (without inner ones of their kind) of those classes or ids."""
    c = F.coalesce(c, F.lit(""))
    for tag in REMOVED_TAGS:
        c = F.regexp_replace(c, rf"(?is)<{tag}\b[^>]*>.*?</{tag}\s*>", " ")
    words = "|".join(REMOVED_CLASSES)
    return F.regexp_replace(c, rf"(?is)<(div|ul|section|p|span)\b[^>]*(?:class|id)\s*=\s*[\"'][^\"']*(?:{words})[^\"']*[\"'][^>]*>(?:(?!<\1\b).)*?</\1\s*>", " ")


def authority_text(c: Column, limit: int = 30000) -> Column:
    """Plain text of a page's content, its first ``limit`` characters (the operator's own bound)."""
    c = F.regexp_replace(F.coalesce(c, F.lit("")), r"(?is)<(script|style|noscript|svg|nav|footer|form)\b.*?</\1\s*>", " ")
    return F.left(strip_tags(c), F.lit(limit))


# titles and identifiers -------------------------------------------------------------------------
_WORD = r"[^\p{L}\p{N}_]+"


def normalize_title(c: Column) -> Column:
    """Lower case, articles dropped, everything but letters, digits and underscore a space."""
    c = F.regexp_replace(F.lower(clean_space(c)), r"(?U)\b(the|a|an)\b", " ")
    return F.trim(F.regexp_replace(c, _WORD, " "))


def title_signature(c: Column) -> Column:
    """A normalised title without version wording."""
    c = F.regexp_replace(normalize_title(c), r"\b(preprint|early view|online ahead of print|accepted manuscript|version \d+)\b", " ")
    return fast_space(c)


def normalize_doi(c: Column) -> Column:
    c = F.lower(clean_space(c))
    c = F.regexp_replace(F.regexp_replace(c, r"^https?://(dx\.)?doi\.org/", ""), r"^doi:\s*", "")
    return F.rtrim(c, F.lit(".,;)]}"))


def normalize_pmid(c: Column) -> Column:
    return F.regexp_replace(F.coalesce(c, F.lit("")), "[^0-9]", "")


def normalize_pmcid(c: Column) -> Column:
    c = F.regexp_replace(F.upper(clean_space(c)), " ", "")
    return F.when(c.rlike("^[0-9]+$"), F.concat(F.lit("PMC"), c)).otherwise(c)


def extract_doi(c: Column) -> Column:
    """The first DOI, lower case, without closing punctuation; null if there is none."""
    found = F.regexp_extract(F.coalesce(c, F.lit("")), r"(?i)(10\.[0-9]{4,9}/[-._;()/:A-Z0-9]+)", 1)
    return F.when(found != "", F.lower(F.rtrim(found, F.lit(".,;)]}"))))


def extract_numbers(c: Column) -> Column:
    """Numbers in order, thousands folded, a percent sign kept; digits that follow a letter are no number."""
    c = F.regexp_replace(F.replace(fast_space(c), F.lit(","), F.lit("")), r"(?<=\d) (?=\d{3}(\D|$))", "")
    return F.regexp_extract_all(c, F.lit(r"(?<![A-Za-z])(\d+(?:\.\d+)?%?)"), F.lit(1))


def number_set(c: Column) -> Column:
    return F.array_sort(F.array_distinct(extract_numbers(c)))


def numbers_kept(source: Column, target: Column) -> Column:
    """No number of the source is missing from the target."""
    return F.size(F.array_except(extract_numbers(source), extract_numbers(target))) == 0


def truncate(c: Column, limit: int) -> Column:
    c = clean_space(c)
    return F.when(F.length(c) > limit, F.concat(F.regexp_replace(F.left(c, F.lit(max(1, limit - 1))), r"(?U)\s+$", ""), F.lit("…"))).otherwise(c)


def year_of(c: Column) -> Column:
    """The year that a date, or a bare number, begins with."""
    return F.try_to_number(F.regexp_extract(F.coalesce(c, F.lit("")), "^([0-9]{4})", 1), F.lit("9999")).cast("int")


def semantic_key(c: Column) -> Column:
    """Letters and digits only, reference marks such as [A1, B2] dropped."""
    c = F.regexp_replace(F.lower(F.coalesce(c, F.lit(""))), r"\[[a-z]\d+(\s*,\s*[a-z]\d+)*\]", "")
    return F.regexp_replace(c, r"[^a-z0-9\x{4e00}-\x{9fff}]+", "")


def slugify(c: Column) -> Column:
    return F.regexp_replace(F.regexp_replace(F.lower(F.coalesce(c, F.lit(""))), "[^a-z0-9]+", "_"), "^_+|_+$", "")


def alpha_code(index: Column) -> Column:
    """0 A, 25 Z, 26 AA, ...: letters that number placeholders."""
    step = lambda s, _: F.when(s["v"] < 0, s).otherwise(F.struct(F.expr("0").cast("long").alias("z"), (F.floor(s["v"] / 26) - 1).alias("v"), F.concat(F.char(65 + s["v"] % 26), s["code"]).alias("code")))
    start = F.struct(F.lit(0).cast("long").alias("z"), index.cast("long").alias("v"), F.lit("").alias("code"))
    return F.aggregate(F.sequence(F.lit(1), F.lit(14)), start, step, lambda s: s["code"])


def redact_secrets(c: Column, secrets: tuple[str, ...] = (), limit: int = 900) -> Column:
    """An error message without keys: given ones, key parameters of URLs and bearer tokens; its first ``limit`` characters."""
    c = clean_space(c)
    for s in secrets:
        c = F.replace(c, F.lit(s), F.lit("[REDACTED]"))
    c = F.regexp_replace(c, r"(?i)([?&](?:key|api_key|apikey)=)[^&\s]+", "$1[REDACTED]")
    return F.left(F.regexp_replace(c, r"(?i)(bearer\s+)[A-Za-z0-9._~-]+", "$1[REDACTED]"), F.lit(limit))


#: fixed values: phrases of aggregators
BOILERPLATE = (
    "comprehensive up[- ]to[- ]date news coverage", "aggregated from sources all over the world", "google news provides",
    "by google news", "view full coverage", "click here to read more", "original abstract or excerpt is unavailable",
)


def remove_boilerplate(c: Column) -> Column:
    c = F.regexp_replace(clean_space(c), "(?i)" + "|".join(BOILERPLATE), " ")
    return fast_space(F.regexp_replace(c, r"(?U)^[\s,;:.\-–—]+|[\s,;:.\-–—]+$", ""))


def distinct_ci(c: Column) -> Column:
    """Ordered distinct strings without regard to case; the first spelling wins, blanks go."""
    rows = F.filter(F.transform(F.coalesce(c, EMPTY()), lambda x: let(fast_space(x), lambda v: F.struct(F.lower(v).alias("k"), v.alias("v")))), lambda x: x["k"] != "")

    def first(rows: Column) -> Column:
        return let(F.transform(rows, lambda x: x["k"]), lambda keys: F.transform(F.filter(rows, lambda x, i: F.array_position(keys, x["k"]) == i + 1), lambda x: x["v"]))

    return let(rows, first)


# languages --------------------------------------------------------------------------------------
# fixed values: script ranges, aliases of language names and labels
SCRIPTS = {
    "latin": r"[A-Za-z\x{00C0}-\x{024F}]", "han": r"[\x{3400}-\x{4DBF}\x{4E00}-\x{9FFF}]", "hiragana": r"[\x{3040}-\x{309F}]",
    "katakana": r"[\x{30A0}-\x{30FF}\x{31F0}-\x{31FF}]", "hangul": r"[\x{1100}-\x{11FF}\x{3130}-\x{318F}\x{AC00}-\x{D7AF}]", "cyrillic": r"[\x{0400}-\x{04FF}]",
}
ALIASES = {
    "eng": "en", "english": "en", "en-us": "en", "en-gb": "en", "jpn": "ja", "japanese": "ja", "jp": "ja", "zho": "zh", "chi": "zh",
    "chinese": "zh", "zh-cn": "zh", "zh-tw": "zh", "kor": "ko", "korean": "ko",
}
LABELS = {"en": "English", "ja": "Japanese", "zh": "Chinese", "ko": "Korean", "ru": "Cyrillic-language", "und": "source-language"}


def _lookup(table: dict[str, str], key: Column, default: Column) -> Column:
    return F.coalesce(F.try_element_at(F.create_map(*(F.lit(x) for kv in table.items() for x in kv)), key), default)


def normalize_language(c: Column) -> Column:
    c = F.replace(F.lower(fast_space(c)), F.lit("_"), F.lit("-"))
    return _lookup(ALIASES, c, F.substring_index(c, "-", 1))


def language_label(c: Column) -> Column:
    return _lookup(LABELS, F.when(normalize_language(c) == "", "und").otherwise(normalize_language(c)), F.lit("source-language"))


def script_count(c: Column, name: str) -> Column:
    return F.regexp_count(F.coalesce(c, F.lit("")), F.lit(SCRIPTS[name]))


def script_profile(c: Column) -> Column:
    """struct of the six scripts' letters."""
    return F.struct(*(script_count(c, s).alias(s) for s in SCRIPTS))


def language_of(p: Column, hint: Column) -> Column:
    """Language by a script profile, then the hint, then Latin letters as English, else und."""
    explicit = normalize_language(hint)
    return (
        F.when((p["hiragana"] > 0) | (p["katakana"] > 0), "ja").when(p["hangul"] > 0, "ko").when(p["cyrillic"] > F.greatest(F.lit(2), p["latin"]), "ru")
        .when((p["han"] >= 2) & (p["latin"] < 2 * p["han"]), F.when(explicit == "ja", "ja").otherwise("zh"))
        .when(explicit.isin("en", "ja", "zh", "ko", "ru"), explicit).when(p["latin"] >= 3, "en").otherwise("und")
    )


def detect_language(c: Column, hint: Column) -> Column:
    return F.transform(F.array(script_profile(c)), lambda p: language_of(p, hint))[0]


def verified_english(c: Column) -> Column:
    """Nothing, or text without a foreign script to speak of."""

    def told(p: Column) -> Column:
        foreign = p["han"] + p["hiragana"] + p["katakana"] + p["hangul"] + p["cyrillic"]
        asian = (p["hiragana"] + p["katakana"] + p["hangul"] > 0) | (p["cyrillic"] >= 2)
        many = (p["han"] >= 2) & (p["han"] >= 0.08 * F.greatest(F.lit(1), p["latin"] + p["han"]))
        return ~asian & ~many & ((p["latin"] >= 3) | (foreign == 0))

    return blank(c) | F.transform(F.array(script_profile(c)), told)[0]


def adequate_chinese(c: Column, least: int = 12, ratio: float = 0.28) -> Column:
    c = F.coalesce(c, F.lit(""))
    han, letters = F.regexp_count(c, F.lit(r"[\x{4e00}-\x{9fff}]")), F.regexp_count(c, F.lit(r"[A-Za-z\x{4e00}-\x{9fff}]"))
    return (han >= least) & ((letters == 0) | (han >= ratio * letters))


def translation_fault(c: Column, source: Column, short: bool = False, forbidden: tuple[str, ...] = ()) -> Column:
    """ok, or the first fault of a Chinese translation."""
    v = fast_space(c)
    han, letters = F.regexp_count(v, F.lit(r"[\x{4e00}-\x{9fff}]")), F.regexp_count(v, F.lit(r"[A-Za-z\x{4e00}-\x{9fff}]"))
    out = F.when(v == "", "empty")
    for term in forbidden:
        out = out.when(v.contains(term), "forbidden_pathogen_translation")
    out = out.when(F.upper(v).rlike("ZXQTERM|PDITERM"), "unrestored_placeholder").when(v.rlike(r"(.)\1{5,}"), "repeated_character_gibberish")
    out = out.when(han < (2 if short else 6), "insufficient_chinese").when((letters > 0) & (han < (0.08 if short else 0.12) * letters), "excessive_untranslated_english")
    return out.when(~numbers_kept(source, v), "number_loss").otherwise("ok")


# sentences --------------------------------------------------------------------------------------
# fixed values: headings of glossaries
GLOSSARY = r"(?i)(?:^|[.!?。！？]\s+|[\r\n]+)\s*(?:abbreviations?|list\s+of\s+abbreviations|acronyms?|缩写(?:词)?(?:表)?|缩略语(?:表)?)\s*[:：]"
GLOSSARY_PAIR = r"(?:^|[;；])\s*[A-Za-z0-9][A-Za-z0-9+./_-]{1,24}\s*[:：]"
ENDS = r"(?<=[.!?。！？]) "


def strip_terminal_glossary(c: Column) -> Column:
    return clean_space(F.split(unescape(c), GLOSSARY, 2)[0])


def glossary_fragment(c: Column) -> Column:
    """Nothing, or two definitions or more."""
    return blank(c) | (F.regexp_count(F.coalesce(c, F.lit("")), F.lit(GLOSSARY_PAIR)) >= 2)


def sentences(c: Column, most: int | None = 50, least: int = 20) -> Column:
    """Split behind . ! ? and their full-width forms; short ones and glossary fragments go, the first ``most`` stay
    (None: all of the text's)."""
    out = F.filter(F.split(strip_terminal_glossary(c), ENDS), lambda s: (F.length(s) >= least) & ~glossary_fragment(s))
    return out if most is None else F.slice(out, 1, most)


def review_sentences(c: Column) -> Column:
    """All sentences, of any length, once."""
    return distinct_ci(F.split(clean_space(c), ENDS))


_LABEL = r"^(?:abstract|background|objective|methods?|results?|findings?|conclusions?|importance)\s*[:：]?\s*"


def clean_abstract(c: Column, least: int = 70) -> Column:
    """Text without markup, glossary and repeated long sentences."""

    def kept(rows: Column) -> Column:
        long_ = F.transform(rows, lambda r: F.when(F.length(r["s"]) >= least, r["k"]))
        return let(long_, lambda keys: F.array_join(F.transform(F.filter(rows, lambda r, i: (F.length(r["s"]) < least) | (F.array_position(keys, r["k"]) == i + 1)), lambda r: r["s"]), " "))

    def told(plain: Column) -> Column:
        rows = F.transform(sentences(plain, 240), lambda s: F.struct(s.alias("s"), F.trim(F.regexp_replace(F.regexp_replace(F.lower(s), _LABEL, ""), r"[^a-z0-9\x{4e00}-\x{9fff}]+", " ")).alias("k")))
        return let(rows, lambda r: F.when(F.size(r) == 0, plain).otherwise(kept(r)))

    return let(strip_terminal_glossary(strip_tags(c)), told)


def token_estimate(c: Column) -> Column:
    """One token for 3.6 ASCII or 1.5 other characters, rounded up, one at least."""
    c = F.coalesce(c, F.lit(""))
    ascii_ = F.regexp_count(c, F.lit(r"[\x00-\x7F]"))
    return F.greatest(F.lit(1), F.ceil(ascii_ / 3.6 + (F.length(c) - ascii_) / 1.5)).cast("long")


def _ended(s: str) -> str:
    return s if s[-1:] in "。.!?！？" else s + ("。" if re.search("[一-鿿]", s) else ".")


def fitted(parts: list[str], limit: int, whole_first: bool = True) -> str:
    """Sentences from the first on while they fit together; the first stays however long."""
    used, out = 0, []
    for part in parts:
        if out and used + len(part) > limit:
            break
        out.append(part)
        used += len(part)
        if whole_first and used > limit:
            break
    return " ".join(out)


def plain_sentences(text: str, least: int = 20) -> list[str]:
    """``sentences`` for Python code."""
    text = folded(re.split(GLOSSARY, html.unescape(text), maxsplit=1)[0])
    return [s for s in re.split(ENDS, text) if len(s) >= least and len(re.findall(GLOSSARY_PAIR, s)) < 2]


def clip_sentences(limit: int):
    """Whole sentences of at most ``limit`` characters together, ellipses dropped, an end mark added."""

    def run(x: str) -> str:
        x = re.sub(r"…|\.\.\.", "", folded(x))
        if len(x) <= limit:
            return _ended(x) if x else ""
        return fitted([_ended(s.strip(" ,;，；:：")) for s in plain_sentences(x) if s.strip(" ,;，；:：")], limit, False)

    return _each(run)


#: fixed values: corruption tails, and what makes a text no translation
CUT_AT = ("之前关联的替换", "previously associated replacement")
NO_TEXT = ("translation unavailable", "翻译暂不可用")


def complete_text(limit: int = 760, banned: tuple[str, ...] = ()):
    """Complete sentences only, cut at corruption tails, ellipses as sentence ends, without banned ones."""

    def run(x: str) -> str:
        x = folded(x)
        for mark in CUT_AT:
            x = x.partition(mark)[0]
        x = re.sub(r"\.{6}|…+|\.\.\.", "。" if re.search("[一-鿿]", x) else ".", x)
        if any(m in x.lower() for m in NO_TEXT):
            return ""
        parts = [p.strip().strip(" ,;，；:：") for p in re.findall(r".+?[.!?。！？](?:\s+|$)|.+$", x)]
        return fitted([_ended(p) for p in parts if p and not any(b.lower() in p.lower() for b in banned)][:80], limit)

    return _each(run)


def chunks(limit: int = 2600):
    """A text in pieces of at most ``limit`` characters, cut between sentences, longer ones by length."""

    def run(x: str) -> list[str]:
        x = folded(x)
        if len(x) <= limit:
            return [x] if x else []
        out: list[str] = []
        room = False
        for s in plain_sentences(x) or [x]:
            if len(s) > limit:
                out += [s[i : i + limit] for i in range(0, len(s), limit)]
                room = False
            elif room and len(out[-1]) + 1 + len(s) <= limit:
                out[-1] += " " + s
            else:
                out.append(s)
                room = True
        return out

    return _each(run, ArrayType(StringType()))


def clip_piece(limit: int):
    """Sentences that fit, joined without blanks; else the text cut with an ellipsis."""

    def run(x: str) -> str:
        x, out = folded(x), ""
        if len(x) <= limit:
            return x
        for s in plain_sentences(x)[:30]:
            if len(out) + len(s) > limit:
                break
            out += s
        return out or x[: max(1, limit - 1)].rstrip() + "…"

    return _each(run)


# terms ------------------------------------------------------------------------------------------
def normalized_text(c: Column) -> Column:
    """Lower case ASCII letters and digits, single blanks between."""
    return F.trim(F.regexp_replace(F.lower(fast_space(c)), "[^a-z0-9]+", " "))


def term_pattern(term: str) -> str:
    """A term bounded by anything but letters and digits, any run of separators between its parts; empty if it has none."""
    parts = re.findall("[a-z0-9]+", term.lower())
    return "(?<![a-z0-9])" + "[^a-z0-9]+".join(parts) + "(?![a-z0-9])" if parts else ""


def contained_pattern(term: str) -> str:
    """How a plain term is sought: bounded if it is short and simple, else anywhere."""
    term = " ".join(term.lower().split())
    return f"(?<![a-z0-9]){re.escape(term)}(?![a-z0-9])" if re.fullmatch("[a-z0-9-]{1,8}", term) else re.escape(term)


def contains_term(c: Column, term: str) -> Column:
    return F.lower(fast_space(c)).rlike(contained_pattern(term)) if term.strip() else F.lit(False)


def count_term(c: Column, term: str) -> Column:
    return F.regexp_count(F.lower(fast_space(c)), F.lit(contained_pattern(term))) if term.strip() else F.lit(0)
