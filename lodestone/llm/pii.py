"""Personal data: high-recall candidates, boosted trees on format and context, calibrated thresholds.

Base kinds (email, ip, card, phone) have exact rules and always stay. Further generators
propose spans that may overlap: keys and assigned secrets, spelled-out addresses, account
numbers, national numbers, bare dates and long digit runs. Trees trained on seeded examples
of each kind and of look-alikes score every proposal by its format and what stands around;
each kind's threshold is the lowest that keeps 99 % precision on its held-out examples. Of overlapping
accepted proposals the best stays, and none may overlap a base span; of a secret, the parts
outside base and better spans stay, so that all of its value goes.
"""

from __future__ import annotations

import hashlib
import random
import re

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

from . import gbdt
from .work import pick

KINDS = ("email", "ip", "card", "phone")
#: Fixed patterns of the base kinds. Local parts and octets are anchored at the start of their run, which the leftmost match starts at anyway.
DOMAIN = re.compile(r"[A-Za-z0-9-]+(?:\.[A-Za-z0-9-]+)+")
LOCAL_END = re.compile(r"[A-Za-z0-9._%+-]+\Z")
IP = re.compile(r"(?<![0-9])[0-9]+(?:\.[0-9]+)(?:\.[0-9]+)(?:\.[0-9]+)")
CARD = re.compile(r"[0-9](?:[\x20-]?[0-9])+")
PHONE = re.compile(r"\+[0-9][\x20().0-9-]+[0-9]")
LOCAL = frozenset("ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789._%+-")

#: Generators of proposals: kind and pattern. All are linear in the text.
PROPOSE = (
    ("key", re.compile(r"(?<![A-Za-z0-9])[A-Z]{4}[A-Z0-9]{16}(?![A-Za-z0-9])")),
    ("secret", re.compile(r"(?i)(?<![a-z])(?:password|passwd|secret|token|api[_-]?key|pwd)[\x20]{0,2}[=:][\x20]{0,2}[\"']?([^\s\"']{6,})")),
    ("spelled", re.compile(r"(?i)(?<![a-z0-9._-])[a-z0-9._-]{2,}[\x20]?[\[(]?[\x20]?at[\x20]?[\])]?[\x20][a-z0-9-]{2,}[\x20]?[\[(]?[\x20]?dot[\x20]?[\])]?[\x20][a-z]{2,10}(?![a-z0-9])")),
    ("iban", re.compile(r"(?<![A-Za-z0-9])[A-Z]{2}[0-9]{2}(?:[\x20]?[A-Z0-9]{4}){3,7}(?:[\x20]?[A-Z0-9]{1,3})?(?![A-Za-z0-9])")),
    ("national", re.compile(r"(?<![0-9-])[0-9]{3}-[0-9]{2}-[0-9]{4}(?![0-9-])")),
    ("phone_local", re.compile(r"(?<![0-9+])\(?[0-9]{3}\)?[\x20.-][0-9]{3}[\x20.-][0-9]{4}(?![0-9])")),
    ("hex", re.compile(r"(?<![A-Za-z0-9])[0-9a-fA-F]{32,64}(?![A-Za-z0-9])")),
    ("number", re.compile(r"(?<![0-9.])[0-9]{9,12}(?![0-9.])")),
    ("date", re.compile(r"(?<![0-9])(?:19|20)[0-9]{2}-[0-9]{2}-[0-9]{2}(?![0-9])")),
)
NAMES = tuple(k for k, _ in PROPOSE)
CUES = re.compile(r"(?i)pass|secret|token|key|mail|phone|tel|call|ssn|social|iban|account|card|born|birth|contact|login|id\b")


def luhn(digits: str) -> bool:
    total = 0
    for i, c in enumerate(reversed(digits)):
        d = int(c) * (1 + i % 2)
        total += d - 9 * (d > 9)
    return total % 10 == 0


def emails(text: str) -> list[tuple[int, int]]:
    """Leftmost matches of the email pattern, from each @: the run of local characters before it (after the last match) and the domain behind it."""
    out, last = [], 0
    at = text.find("@")
    while at >= 0:
        a = at
        while a > last and text[a - 1] in LOCAL:
            a -= 1
        m = DOMAIN.match(text, at + 1) if a < at else None
        if m:
            out.append((a, m.end()))
            last = m.end()
            at = text.find("@", last)
        else:
            last = max(last, at + 1)
            at = text.find("@", at + 1)
    return out


def base_spans(text: str) -> dict[str, list[tuple[int, int]]]:
    found = {k: [] for k in KINDS}
    found["email"] = emails(text)
    for m in IP.finditer(text):
        if all(int(x[-4:]) <= 255 and len(x.lstrip("0")) <= 3 for x in m[0].split(".")):
            found["ip"].append(m.span())
    for m in CARD.finditer(text):
        digits = m[0].replace(" ", "").replace("-", "")
        if 13 <= len(digits) <= 19 and luhn(digits):
            found["card"].append(m.span())
    for m in PHONE.finditer(text):
        if 9 <= sum(c.isdigit() for c in m[0]) <= 15:
            found["phone"].append(m.span())
    return found


def features(text: str, kind: str, a: int, b: int) -> list[float]:
    s, before, after = text[a:b], text[max(0, a - 40) : a], text[b : b + 20]
    letters, digits = sum(c.isalpha() for c in s), sum(c.isdigit() for c in s)
    value = re.split(r"[=:]\s*[\"']?", s, maxsplit=1)[-1]
    kinds = len(set(value))
    return [
        *(float(kind == k) for k in NAMES), len(s), digits / len(s), letters / len(s), sum(c.isupper() for c in s) / len(s), len(set(s)), kinds / max(len(value), 1),
        len(value), sum(c.isdigit() for c in value) / max(len(value), 1), float(bool(CUES.search(before))), float(before[-1:].isspace() or not before), float(after[:1].isspace() or not after),
        sum(c.isdigit() for c in before), sum(c.isdigit() for c in after), s.count("-"), s.count("."), s.count(" "), float(value.isalpha()), float(value.islower()),
    ]


def examples(n: int = 6000, seed: int = 11) -> tuple[np.ndarray, np.ndarray]:
    """Seeded proposals with labels: personal data and secrets of each kind, and look-alikes (serial numbers, part numbers, prose)."""
    rng = random.Random(seed)
    pool = lambda chars, k: "".join(rng.choice(chars) for _ in range(k))
    word = lambda: pool("abcdefghilmnoprstu", rng.randint(2, 9))
    digits, upper = "0123456789", "ABCDEFGHIJKLMNOPQRSTUVWXYZ"
    good = [
        lambda: "AKIA" + pool(upper + digits, 16), lambda: rng.choice(["password", "secret", "token", "api_key", "TOKEN"]) + rng.choice(["=", " = ", ": "]) + rng.choice(['"', ""]) + pool("0123456789abcdef", rng.randint(10, 40)),
        lambda: "pwd=" + pool("abcdefgh" + upper + digits + "!_", rng.randint(8, 16)), lambda: f"{word()}.{word()} at {word()} dot {rng.choice(['com', 'org', 'net', 'de'])}", lambda: f"{word()} [at] {word()} [dot] com",
        lambda: rng.choice(["DE", "FR", "ES"]) + pool(digits, 18), lambda: pool(digits, 3) + "-" + pool(digits, 2) + "-" + pool(digits, 4), lambda: f"({pool(digits, 3)}) 555-{pool(digits, 4)}", lambda: "token " + pool("0123456789abcdef", 40), lambda: "tel " + pool(digits, 10), lambda: "born " + f"19{pool(digits, 2)}-0{rng.randint(1, 9)}-1{rng.randint(0, 9)}",
        lambda: rng.choice(["token=", "secret: ", "api_key="]) + ".".join(pool("abcdefghijklmnopqrstuvwxyz" + upper + digits + "-_", rng.randint(30, 400)) for _ in range(rng.randint(2, 3))), lambda: "password=" + pool("0123456789abcdef", rng.randint(81, 600)),
    ]
    bad = [
        lambda: "part " + pool(upper, 20), lambda: "password: " + word() + word(), lambda: f"{word()} at {word()} dot {word()}", lambda: f"look at the dot {word()}", lambda: "token: " + word() + "ing", lambda: "token: " + "-".join(word() for _ in range(rng.randint(15, 60))), lambda: "checksum " + pool("0123456789abcdef", 32), lambda: "serial " + pool(digits, 9), lambda: "updated " + f"20{pool(digits, 2)}-0{rng.randint(1, 9)}-1{rng.randint(0, 9)}", lambda: pool(digits, 12),
        lambda: "chapter " + pool(digits, 3) + "." + pool(digits, 3) + "." + pool(digits, 4),
    ]
    x, y = [], []
    while len(x) < n:
        label = rng.random() < 0.5
        core = rng.choice(good if label else bad)()
        left = " ".join(word() for _ in range(6)) + " "
        text = left + core + " " + " ".join(word() for _ in range(4))
        for kind, pattern in PROPOSE:
            for m in pattern.finditer(text):
                if m.start() >= len(left) - 1 and m.end() <= len(left) + len(core) + 1:
                    x.append(features(text, kind, *m.span()))
                    y.append(float(label))
    return np.array(x), np.array(y)


def outside(a: int, b: int, taken: list[tuple[int, int]]) -> list[tuple[int, int]]:
    """The parts of a span that no taken span covers."""
    out = []
    for c, d in sorted(s for s in taken if s[0] < b and a < s[1]):
        if a < c:
            out.append((a, c))
        a = max(a, d)
    return [*out, (a, b)] if a < b else out


class Finder:
    def __init__(self, trees: gbdt.Trees, threshold: float | dict[str, float]):
        self.trees = trees
        self.threshold = threshold if isinstance(threshold, dict) else dict.fromkeys(NAMES, threshold)

    def spans(self, texts: list[str]) -> list[tuple[dict, list[tuple[str, int, int, float]]]]:
        """For each text its base spans and the further accepted ones."""
        base, asked, owner, x = [], [], [], []
        for i, text in enumerate(texts):
            found = base_spans(text)
            base.append(found)
            taken = sorted(s for v in found.values() for s in v)
            for kind, pattern in PROPOSE:
                for m in pattern.finditer(text):
                    a, b = m.span()
                    if kind == "secret" or not any(c < b and a < d for c, d in taken):
                        owner.append(i)
                        asked.append((kind, a, b, m.start(m.lastindex or 0)))
                        x.append(features(text, kind, a, b))
        more: list[list] = [[] for _ in texts]
        if x:
            scores = self.trees.score(np.array(x))
            for j in np.lexsort(([s[1] for s in asked], -scores)):
                kind, a, b, value = asked[j]
                own = more[owner[j]]
                if scores[j] < self.threshold[kind]:
                    continue
                if kind == "secret":
                    taken = [*(s for v in base[owner[j]].values() for s in v), *((c, d) for _, c, d, _ in own)]
                    own += [(kind, c, d, float(scores[j])) for c, d in outside(a, b, taken) if d > value]
                elif not any(c < b and a < d for _, c, d, _ in own):
                    own.append((kind, a, b, float(scores[j])))
        return [(f, sorted(m, key=lambda s: (s[1], s[2]))) for f, m in zip(base, more, strict=True)]


def train(n: int = 6000, precision: float = 0.99) -> Finder:
    """Trees on three quarters of the examples; each kind's threshold is the lowest that keeps ``precision`` on its
    proposals of the last quarter (0.99 where none does, 0.5 where all of them are personal data)."""
    x, y = examples(n)
    cut = len(x) * 3 // 4
    trees = gbdt.fit(x[:cut], y[:cut], trees=40)
    scores, labels, kinds = trees.score(x[cut:]), y[cut:], x[cut:, : len(NAMES)]
    threshold = {}
    for i, name in enumerate(NAMES):
        own = kinds[:, i] == 1
        levels = [t for t in np.linspace(0.5, 0.99, 50) if (own & (scores >= t)).any() and labels[own & (scores >= t)].mean() >= precision]
        threshold[name] = float(levels[0]) if levels else 0.99
    return Finder(trees, threshold)


def redact(text: str, spans: list[tuple[str, int, int]]) -> str:
    """Each span, and each run of overlapping ones, becomes the name of its first kind in brackets."""
    out, last = [], 0
    for kind, a, b in sorted(spans, key=lambda s: (s[1], -s[2])):
        if a >= last:
            out += [text[last:a], f"[{kind.upper()}]"]
        last = max(last, b)
    return "".join([*out, text[last:]]) if out else text


def _columns(finder, texts):
    rows = []
    for text, (base, more) in zip(texts, finder.spans(texts), strict=True):
        told = ",".join(f"{k}:{a}:{b}" for k in KINDS for a, b in base[k])
        rest = ",".join(f"{k}:{a}:{b}" for k in NAMES for kind, a, b, _ in more if kind == k)
        spans = [(k, a, b) for k in KINDS for a, b in base[k]] + [(k, a, b) for k, a, b, _ in more]
        rows.append((len(spans), len(more), *(len(base[k]) for k in KINDS), hashlib.sha256(told.encode()).hexdigest(), ",".join(x for x in (told, rest) if x), redact(text, spans)))
    return list(zip(*rows, strict=True)) or [()] * 9


def personal_data(docs: DataFrame, examples_: int = 6000) -> DataFrame:
    """One row per row of ``docs`` (doc_id, text): doc_id, n_email, n_ip, n_card, n_phone, base_sha256, spans.

    ``spans`` lists kind:start:end, base kinds first, in code points, end exclusive; n_spans and
    n_added (columns too) count all and those beyond the base kinds. Null and empty texts have none.
    Repeated rows get equal results; an empty table gives no rows; further columns are ignored.
    """
    found = docs.sparkSession.sparkContext.broadcast(train(examples_))
    docs = docs.select(*pick(docs, "doc_id", "text"))

    def run(batches):
        for batch in batches:
            for a in range(0, batch.num_rows, 512):
                part = batch.slice(a, 512)
                c = _columns(found.value, [t or "" for t in part.column("text").to_pylist()])
                yield pa.RecordBatch.from_arrays([part.column("doc_id"), *(pa.array(x, pa.int64()) for x in c[2:6]), pa.array(c[6], pa.string()), pa.array(c[7], pa.string()), *(pa.array(x, pa.int64()) for x in c[:2])], ["doc_id", "n_email", "n_ip", "n_card", "n_phone", "base_sha256", "spans", "n_spans", "n_added"])

    return docs.mapInArrow(run, f"doc_id {docs.schema['doc_id'].dataType.simpleString()}, n_email long, n_ip long, n_card long, n_phone long, base_sha256 string, spans string, n_spans long, n_added long")


def redacted(docs: DataFrame, examples_: int = 6000) -> DataFrame:
    """``docs`` with every found span of ``text`` replaced; n_chars, if there, follows. A null text stays null, an
    empty one empty; repeated rows are replaced alike; further columns, whatever their names, stay as they are."""
    found = docs.sparkSession.sparkContext.broadcast(train(examples_))

    def run(batches):
        for batch in batches:
            at = batch.schema.get_field_index("text")
            for a in range(0, batch.num_rows, 512):
                part = batch.slice(a, 512)
                texts = part.column(at).to_pylist()
                new = [None if t is None else x for t, x in zip(texts, _columns(found.value, [t or "" for t in texts])[8], strict=True)]
                part = part.set_column(at, batch.schema.field(at).name, pa.array(new, pa.string()))
                if (n := batch.schema.get_field_index("n_chars")) >= 0:
                    part = part.set_column(n, "n_chars", pa.array([None if t is None else len(t) for t in new], batch.schema.field(n).type))
                yield part

    return docs.mapInArrow(run, docs.schema)
