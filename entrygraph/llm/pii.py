"""Personal data: proposed spans, boosted trees, calibrated thresholds.

Generators with high recall propose overlapping spans; gradient-boosted trees
score each by its format and its context; spans above a calibrated threshold
are redacted. Spans of the exact base patterns always stay.

The trees are fitted on the driver, on TRAIN_SPANS invented examples drawn with
a fixed seed: no table has labels for spans, and the model is then the same for
every corpus.

Defined cases: a null text is empty; an empty text has no spans and the digest
of nothing; whole texts are searched, of any length; repeated rows give
repeated results; an empty table an empty one; other columns are ignored by
``find_spans`` and carried by ``redact``.
"""

from __future__ import annotations

import bisect
import hashlib
import math
import random
import re
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

from entrygraph.llm.common import arrow_map, arrow_schema, map_rows

KINDS = ("email", "ip", "card", "phone", "secret")
#: Invented examples for the trees; a quarter of them is held out to calibrate the thresholds.
TRAIN_SPANS, TREES, DEPTH, RATE, BINS = 6000, 40, 3, 0.3, 16
#: A span is added only where the calibrated precision on held-out examples is at least this.
PRECISION = 0.995

# The base patterns, in forms that read a long run of characters once: what may stand before an @ is taken
# backwards from it, and numbers are tried from their first digit only.
LOCAL = "ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789._%+-"
DOMAIN = re.compile(r"[A-Za-z0-9-]+(?:\.[A-Za-z0-9-]+)+")
IP = re.compile(r"(?<![0-9])[0-9]++(\.[0-9]++){3}")
CARD = re.compile(r"[0-9]([\x20-]?[0-9])+")
PHONE = re.compile(r"\+[0-9][\x20().0-9-]+[0-9]")
_DIGIT, _AT = re.compile("[0-9]"), re.compile("@")


def luhn(digits: str) -> bool:
    total = 0
    for i, c in enumerate(reversed(digits)):
        d = int(c) * (1 + i % 2)
        total += d - 9 * (d > 9)
    return total % 10 == 0


def digits_of(s: str) -> str:
    return "".join(c for c in s if "0" <= c <= "9")


def addresses(text: str, at: re.Pattern, domain: re.Pattern) -> list[tuple[int, int]]:
    """Leftmost non-overlapping runs of LOCAL, then ``at``, then ``domain``."""
    out, free, last = [], 0, 0
    for m in at.finditer(text):
        low = max(free, last)
        start = low + len(text[low : m.start()].rstrip(LOCAL))
        last = m.end()
        if start < m.start() and (found := domain.match(text, m.end())):
            out.append((start, found.end()))
            free = found.end()
    return out


def base_spans(text: str) -> list[tuple[int, int, int]]:
    """(start, kind, end) of the exact patterns, by start and kind."""
    out = []
    if "@" in text:
        out += [(a, 0, b) for a, b in addresses(text, _AT, DOMAIN)]
    if _DIGIT.search(text):
        for m in IP.finditer(text):
            parts = [p.lstrip("0") for p in m.group().split(".")]
            if all(len(p) <= 3 and int(p or 0) <= 255 for p in parts):
                out.append((m.start(), 1, m.end()))
        for m in CARD.finditer(text):
            d = digits_of(m.group())
            if 12 <= len(d) <= 19 and luhn(d):
                out.append((m.start(), 2, m.end()))
        if "+" in text:
            out += [(m.start(), 3, m.end()) for m in PHONE.finditer(text) if 9 <= len(digits_of(m.group())) <= 15]
    return sorted(out)


#: Generators of candidates: (kind, pattern, what the text must hold for it to be tried).
GENERATORS = (
    (0, re.compile(r" ?(?:@|\(at\)|\[at\]) ?"), ("@", "(at)", "[at]")),
    (1, re.compile(r"(?<![0-9A-Fa-f:])(?:[0-9A-Fa-f]{1,4}:){7}[0-9A-Fa-f]{1,4}(?![0-9A-Fa-f:])"), (":",)),
    (2, re.compile(r"(?<![0-9])[0-9]{4}([ ./-])[0-9]{4,6}\1[0-9]{4,5}(?:\1[0-9]{1,4})?(?![0-9])"), ()),
    (3, re.compile(r"(?<![0-9A-Za-z+])(?:00[1-9]|\(0?[0-9]{2,4}\) ?|[0-9]{2,4}[ ./-])[0-9][0-9 ()./-]{4,14}[0-9](?![0-9A-Za-z])"), ()),
    (4, re.compile(r"(?<![A-Za-z0-9_-])(?=[A-Za-z_-]*[0-9])[A-Za-z0-9_-]{16,}+(?![A-Za-z0-9_])"), ()),
)
_DOTTED = re.compile(r"[A-Za-z0-9-]+(?: ?(?:\.|\(dot\)|\[dot\]) ?[A-Za-z0-9-]+)+")
_CUES = (
    re.compile(r"mail|contact|write|kontakt|correo|courriel", re.I),
    re.compile(r"\bip\b|host|server|address", re.I),
    re.compile(r"card|visa|payment|konto|iban|carte|tarjeta", re.I),
    re.compile(r"phone|tel\b|tel[.:]|call|mobile|fax", re.I),
    re.compile(r"token|secret|key|passw|pwd|credential|bearer", re.I),
)
REACH = 32


def proposed(text: str) -> list[tuple[int, int, int]]:
    """Overlapping candidates (start, kind, end) of all generators."""
    if not _DIGIT.search(text) and not any(m in text for m in GENERATORS[0][2]):
        return []
    out = []
    for kind, pattern, needs in GENERATORS:
        if not needs or any(x in text for x in needs):
            found = addresses(text, pattern, _DOTTED) if kind == 0 else [m.span() for m in pattern.finditer(text)]
            out += [(a, kind, b) for a, b in found]
    return out


def describe(text: str, start: int, kind: int, end: int) -> list[float]:
    """Format and context features of a candidate."""
    s = text[start:end]
    d = digits_of(s)
    left, right = text[max(0, start - REACH) : start], text[end : end + 8]
    n = len(s)
    counts = {c: s.count(c) for c in set(s)}
    entropy = -sum(v / n * math.log2(v / n) for v in counts.values())
    changes = sum(a.isdigit() != b.isdigit() for a, b in zip(s, s[1:]))
    return [
        kind, n, len(d), len(d) / n, sum(c in "abcdefABCDEF0123456789" for c in s) / n, sum(c.isupper() for c in s) / n,
        sum(not c.isalnum() for c in s), entropy, changes / n, float(len(d) > 11 and luhn(d)), float(s.count(".")),
        float("@" in s), float(bool(_CUES[kind].search(left))), float(left[-1:] in "\"'=:"), float(right[:1] in "\"'"),
        float("=" in left[-4:]), float(left[-1:].isalnum() or right[:1].isalnum()), float(left.rstrip()[-1:].isdigit() or right.lstrip()[:1].isdigit()),
    ]


class Trees:
    """Boosted regression trees on binned features, logistic loss."""

    def __init__(self, x: np.ndarray, y: np.ndarray):
        self.edges = [np.unique(np.quantile(c, np.linspace(0, 1, BINS + 1)[1:-1])) for c in x.T]
        b = self.binned(x)
        self.start = float(np.log((y.mean() + 1e-6) / (1 - y.mean() + 1e-6)))
        score = np.full(len(y), self.start)
        self.trees: list = []
        for _ in range(TREES):
            p = 1 / (1 + np.exp(-score))
            tree = self.grow(b, y - p, p * (1 - p), np.arange(len(y)), DEPTH)
            self.trees.append(tree)
            score += RATE * self.value(tree, b)

    def binned(self, x: np.ndarray) -> np.ndarray:
        return np.stack([np.searchsorted(e, c, side="right") for e, c in zip(self.edges, x.T)], 1)

    def grow(self, b, g, h, rows, depth):
        G, H = g[rows].sum(), h[rows].sum()
        leaf = float(G / (H + 1))
        if not depth or len(rows) < 20:
            return leaf
        best = (1e-6, None, None)
        for f in range(b.shape[1]):
            gs = np.bincount(b[rows, f], g[rows], BINS + 1).cumsum()[:-1]
            hs = np.bincount(b[rows, f], h[rows], BINS + 1).cumsum()[:-1]
            gain = gs**2 / (hs + 1) + (G - gs) ** 2 / (H - hs + 1) - G**2 / (H + 1)
            k = int(gain.argmax())
            if gain[k] > best[0]:
                best = (gain[k], f, k)
        if best[1] is None:
            return leaf
        _, f, k = best
        low = b[rows, f] <= k
        return f, k, self.grow(b, g, h, rows[low], depth - 1), self.grow(b, g, h, rows[~low], depth - 1)

    def value(self, tree, b):
        if not isinstance(tree, tuple):
            return np.full(len(b), tree)
        f, k, low, high = tree
        left = b[:, f] <= k
        out = np.empty(len(b))
        out[left], out[~left] = self.value(low, b[left]), self.value(high, b[~left])
        return out

    def predict(self, x: np.ndarray) -> np.ndarray:
        b = self.binned(x)
        return 1 / (1 + np.exp(-self.start - RATE * sum(self.value(t, b) for t in self.trees)))


def invented(n: int, seed: int = 7) -> list[tuple[str, int, int, int, bool]]:
    """Examples (text, start, kind, end, private?) with positives and hard negatives of each kind."""
    r = random.Random(seed)
    word = lambda: "".join(r.choice(["an", "er", "on", "st", "tion", "re", "le", "ou", "ing"]) for _ in range(r.randint(1, 3)))
    num = lambda k: "".join(r.choice("0123456789") for _ in range(k))
    any_of = lambda s, k: "".join(r.choice(s) for _ in range(k))

    def luhned(k):
        head = str(r.randint(3, 6)) + num(k - 2)
        return next(head + str(c) for c in range(10) if luhn(head + str(c)))

    good = {
        0: lambda: (r.choice(["", "mail ", "contact "]), f"{word()}.{num(2)}{r.choice([' (at) ', '(at)', ' [at] '])}{word()}{r.choice([' (dot) ', '.', '[dot]'])}{r.choice(['com', 'org', 'de'])}", ""),
        1: lambda: (r.choice(["", "host ", "ip "]), ":".join(any_of("0123456789abcdef", r.randint(2, 4)) for _ in range(8)), ""),
        2: lambda: (r.choice(["", "card ", "visa "]), (lambda c, x: x.join(c[i : i + 4] for i in range(0, 16, 4)))(luhned(16), r.choice("./")), ""),
        3: lambda: (r.choice(["tel: ", "phone ", "call ", "mobile "]), r.choice([f"0{num(2)} {num(3)} {num(4)}", f"(0{num(2)}) {num(7)}", f"00{r.randint(1, 9)}{num(2)} {num(7)}", f"{num(3)}-{num(3)}-{num(4)}"]), ""),
        4: lambda: (r.choice(['token = "', "api_key='", 'secret: "', 'password="', "key = "]), any_of(r.choice(["0123456789abcdef", "0123456789ABCDEFGHJKabcdefghjkmnpqrstuvwxyz"]), r.randint(20, 48)), r.choice(['"', "'"])),
    }
    bad = {
        0: lambda: ("", f"{word()} @ {word()}.{word().capitalize()}", ""),
        1: lambda: (r.choice(["at ", "mac "]), ":".join(num(2) for _ in range(8)), ""),
        2: lambda: (r.choice(["", "no ", "part "]), "-".join(num(4) for _ in range(4)), ""),
        3: lambda: (r.choice(["", "pages ", "in ", "from ", "isbn "]), r.choice([f"{num(4)}-{num(2)}-{num(2)}", f"{num(2)}.{num(2)}.{num(4)}", f"{num(3)}-{num(5)}", f"{num(3)} {num(3)} {num(3)}"]), ""),
        4: lambda: (r.choice(["", "see ", "id "]), r.choice([f"{word()}-{word()}-{word()}-{word()}{num(1)}", f"{word()}{word()}{word()}{word()}{num(1)}", "_".join(word() for _ in range(5)) + num(2), num(20), f"section-{num(2)}-{word()}-{word()}"]), ""),
    }
    out = []
    while len(out) < n:
        kind = r.randrange(5)
        private = r.random() < 0.5
        before, s, after = (good if private else bad)[kind]()
        lead = " ".join(word() for _ in range(r.randint(2, 8))) + " " + before
        text = lead + s + after + " " + word()
        spans = [c for c in proposed(text) if c[1] == kind and c[0] < len(lead) + len(s) and c[2] > len(lead)]
        out += [(text, *c, private and c[0] == len(lead) and c[2] == len(lead) + len(s)) for c in spans]
    return out[:n]


@lru_cache(1)
def model() -> tuple[Trees, dict[int, float]]:
    """The trees, and for each kind the least score at which held-out precision is PRECISION; 2 if nowhere."""
    rows = invented(TRAIN_SPANS)
    x = np.array([describe(t, a, k, b) for t, a, k, b, _ in rows])
    y = np.array([p for *_, p in rows], float)
    cut = len(rows) * 3 // 4
    trees = Trees(x[:cut], y[:cut])
    p, truth, kinds = trees.predict(x[cut:]), y[cut:], x[cut:, 0]
    least = {}
    for kind in range(len(KINDS)):
        own = np.flatnonzero(kinds == kind)
        order = own[np.argsort(-p[own])]
        right = truth[order].cumsum() / np.arange(1, len(order) + 1) if len(order) else np.zeros(0)
        fine = np.flatnonzero(right >= PRECISION)
        least[kind] = float(max(0.5, p[order[fine[-1]]])) if len(fine) else 2.0
    return trees, least


def added_spans(text: str, base: list[tuple[int, int, int]], trees: Trees, least: dict[int, float]) -> list[tuple[int, int, int]]:
    """Accepted candidates that touch no base span, best first among overlapping ones."""
    found = proposed(text)
    if not found:
        return []
    scores = trees.predict(np.array([describe(text, *c) for c in found]))
    out: list[tuple[int, int, int]] = []
    # begins and ends of what is taken, which never overlap each other
    begins: list[int] = []
    ends: list[int] = []
    for a, _, b in base:
        if ends and a < ends[-1]:
            ends[-1] = max(b, ends[-1])
        else:
            begins.append(a)
            ends.append(b)
    for p, c in sorted(zip(scores.tolist(), found), key=lambda x: (-x[0], x[1])):
        if p < least[c[1]]:
            continue
        i = bisect.bisect_right(begins, c[0])
        if (not i or ends[i - 1] <= c[0]) and (i == len(begins) or begins[i] >= c[2]):
            out.append(c)
            begins.insert(i, c[0])
            ends.insert(i, c[2])
    return sorted(out)


def written(spans: list[tuple[int, int, int]]) -> str:
    return ",".join(f"{KINDS[k]}:{a}:{b}" for a, k, b in spans)


SCHEMA = "doc_id long, n_email long, n_ip long, n_card long, n_phone long, base_sha256 string, spans string, n_added long, n_spans long"


def find_spans(docs: DataFrame) -> DataFrame:
    """One row a document: counts and digest of the base spans, all spans, how many the trees added and how many there are."""
    shared = docs.sparkSession.sparkContext.broadcast(model())

    def make():
        trees, least = shared.value

        def one(doc_id, text):
            text = text or ""
            base = base_spans(text)
            more = added_spans(text, base, trees, least)
            n = [sum(k == i for _, k, _ in base) for i in range(4)]
            return (doc_id, *n, hashlib.sha256(written(base).encode()).hexdigest(), written(sorted(base + more)), len(more), len(base) + len(more))

        return one

    return map_rows(docs, ["doc_id", "text"], make, SCHEMA, arrow_schema(SCHEMA))


def redact(docs: DataFrame) -> DataFrame:
    """``docs`` with all its columns, every span of its texts replaced by its kind in angle brackets; overlapping spans go as one."""
    shared = docs.sparkSession.sparkContext.broadcast(model())

    def clean(text: str | None, trees, least) -> str | None:
        if not text:
            return text
        base = base_spans(text)
        out, at = [], 0
        for a, k, b in sorted(base + added_spans(text, base, trees, least)):
            if a >= at:
                out += [text[at:a], f"<{KINDS[k]}>"]
            at = max(at, b)
        return "".join([*out, text[at:]])

    def run(batches):
        trees, least = shared.value
        for batch in batches:
            at = batch.schema.get_field_index("text")
            texts = pa.array([clean(t, trees, least) for t in batch.column(at).to_pylist()], batch.schema.field(at).type)
            yield pa.RecordBatch.from_arrays([texts if i == at else c for i, c in enumerate(batch.columns)], names=batch.schema.names)

    return arrow_map(docs, run, docs.schema)
