"""License scan: fuzzy search for short notices.

A notice that may have e errors is split into e + 1 pieces: wherever it occurs with at most
e errors, one piece occurs exactly. An automaton finds all pieces in one pass; around each
the regex library's bounded-error matching verifies the notice and reports span and errors.
"""

from __future__ import annotations

from dataclasses import dataclass

import pyarrow as pa
import regex
from pyspark.sql import DataFrame

from .bytes_np import ALNUM, LOWER, slices, word_bounds
from .work import pick

#: Exact phrases of the base labels.
BASE = (("cc-by", "cc by"), ("gpl", "general public license"), ("reserved", "all rights reserved"))
#: Notices in words, with the errors they may have.
NOTICES = (
    ("gpl", "gnu general public license", 3),
    ("gpl", "licensed under the gnu general public license", 5),
    ("cc-by", "creative commons attribution", 3),
    ("cc-by", "licensed under cc by", 2),
    ("apache", "licensed under the apache license", 3),
    ("mit", "permission is hereby granted free of charge", 5),
    ("mit", "released under the mit license", 3),
    ("bsd", "redistribution and use in source and binary forms", 5),
    ("mpl", "subject to the terms of the mozilla public license", 5),
    ("reserved", "all rights reserved", 2),
)


@dataclass(frozen=True)
class Scanner:
    notices: tuple = NOTICES

    def build(self) -> Scanner:
        import ahocorasick

        seeds, patterns = ahocorasick.Automaton(), []
        places: dict[str, list] = {}
        for k, (_, phrase, errors) in enumerate(self.notices):
            patterns.append(regex.compile(f"(?b)(?:{regex.escape(phrase)}){{e<={errors}}}"))
            cut = [round(i * len(phrase) / (errors + 1)) for i in range(errors + 2)]
            for a, b in zip(cut, cut[1:], strict=False):
                places.setdefault(phrase[a:b], []).append((k, a))
        for piece, at in places.items():
            seeds.add_word(piece, (len(piece), at))
        seeds.make_automaton()
        object.__setattr__(self, "seeds", seeds)
        object.__setattr__(self, "patterns", patterns)
        return self

    def spans(self, text: str) -> list[tuple[str, int, int, int]]:
        """(label, start, end, errors) in the text of single-spaced words; overlapping finds of a notice keep the one with fewest errors."""
        windows: dict[int, list[list[int]]] = {}
        for end, (n, at) in self.seeds.iter(text):
            for k, a in at:
                _, phrase, errors = self.notices[k]
                low, high = max(0, end + 1 - n - a - errors), end + 1 - n - a + len(phrase) + errors
                own = windows.setdefault(k, [])
                if own and low <= own[-1][1]:
                    own[-1][1] = max(own[-1][1], high)
                else:
                    own.append([low, high])
        out = []
        for k, own in windows.items():
            label, phrase, errors = self.notices[k]
            for low, high in own:
                # a window long after many seeds is verified in pieces that overlap by a notice
                for a in range(low, high, 4000):
                    parts = [(a, min(high, a + 4000 + 2 * len(phrase)))]
                    while parts:
                        # the best find of a part comes first, so what lies before it is searched as well as what follows
                        c, d = parts.pop()
                        if d - c >= len(phrase) - errors and (m := self.patterns[k].search(text, c, d)):
                            out.append((label, m.start(), m.end(), sum(m.fuzzy_counts)))
                            parts += [(c, m.start()), (m.end(), d)]
        best: list[tuple[str, int, int, int]] = []
        for s in sorted(set(out), key=lambda s: (s[3], s[1], s[2], s[0])):
            if not any(s[0] == t[0] and s[1] < t[2] and t[1] < s[2] for t in best):
                best.append(s)
        return sorted(best, key=lambda s: (s[1], s[2], s[0]))


def scan(docs: DataFrame, notices: tuple = NOTICES) -> DataFrame:
    """One row per row of ``docs`` (doc_id, text): doc_id, n_words, n_base, first_word, last_word, base_labels, labels, score, found.

    Words are `[^\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]+` after A-Z are lower-cased; base places are
    runs of a phrase's words. ``labels`` adds those of the fuzzy finds; ``found`` lists their
    label:start:end:errors in the text of single-spaced words; ``score`` is 1 with a base label,
    else that of the best find, 1 - errors / (2 * allowed). Null and empty texts have no words
    and no labels. Repeated rows get equal results; further columns are ignored.
    """
    docs = docs.select(*pick(docs, "doc_id", "text"))
    allowed = {(label, errors) for label, _, errors in notices}
    most = {label: max(e for n, e in allowed if n == label) for label, _ in allowed}

    def run(batches):
        scanner = Scanner(notices).build()
        phrases = [(label, f" {phrase} ") for label, phrase in BASE]
        for batch in batches:
            for a, b, data, offsets in slices(batch.column("text"), 1 << 18):
                data = LOWER[data]
                starts, ends, first = word_bounds(data, offsets, ALNUM)
                out = []
                # every text as its words, one blank between
                kept = data.copy()
                kept[~ALNUM[data]] = 32
                for i in range(b - a):
                    n = int(first[i + 1] - first[i])
                    text = " " + " ".join(kept[offsets[i] : offsets[i + 1]].tobytes().decode("utf-8", "replace").split(" ")) + " "
                    while "  " in text:
                        text = text.replace("  ", " ")
                    places = []
                    for label, phrase in phrases:
                        at = text.find(phrase)
                        while at >= 0:
                            places.append((at, label))
                            at = text.find(phrase, at + 1)
                    where = sorted({at for at, _ in places})
                    words, last, seen = [], 0, 0
                    for at in where:
                        seen += text.count(" ", last, at)
                        last = at
                        words.append(seen)
                    base = sorted({label for _, label in places})
                    finds = scanner.spans(text)
                    labels = sorted({*base, *(s[0] for s in finds)})
                    score = 1.0 if base else max((1 - s[3] / (2 * most[s[0]]) for s in finds), default=0.0)
                    out.append((n, len(places), min(words, default=None), max(words, default=None), ",".join(base), ",".join(labels), score, ",".join(f"{s[0]}:{s[1]}:{s[2]}:{s[3]}" for s in finds)))
                types = (pa.int64(), pa.int64(), pa.int64(), pa.int64(), pa.string(), pa.string(), pa.float64(), pa.string())
                yield pa.RecordBatch.from_arrays([batch.slice(a, b - a).column("doc_id"), *(pa.array(c, t) for c, t in zip(zip(*out, strict=True), types, strict=True))], ["doc_id", "n_words", "n_base", "first_word", "last_word", "base_labels", "labels", "score", "found"])

    return docs.mapInArrow(run, f"doc_id {docs.schema['doc_id'].dataType.simpleString()}, n_words long, n_base long, first_word long, last_word long, base_labels string, labels string, score double, found string")
