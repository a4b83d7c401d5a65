"""Personal data by candidate gradient boosting.

High-recall generators propose overlapping spans: anything with an at-sign or a spelled-out one, and runs of
digits with separators, whole and in part. Boosted trees score each span from its format (lengths, groups,
separators) and its context (words before it, neighbouring characters). The threshold of each kind is the
lowest that keeps the wanted precision on held-out candidates. Known formats (the base spans) always stay.

The trees learn from planted examples, since the known formats need no trees. A training window is a piece of a
document's own text with an example in it: a base span of that document in a broken format, a made-up value in a
broken format, with or without a telling word before it, or a number of another meaning (a version, an ISBN, an
order). The planted span is the positive; what overlaps it otherwise, the other meanings, and candidates of digits
elsewhere in the documents are negatives. Candidates that touch a base span or may be in a broken format themselves
are left out. Learning uses a bounded sample (about `sample_docs` documents, `sample_spans` candidates of each); scanning is a
vectorised map over all whole texts, without a shuffle.
"""

from __future__ import annotations

import hashlib
import re
from bisect import bisect_left, insort
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import ROW, packed, unpacked

KINDS = ["email", "ip", "card", "phone"]
SAMPLE_DOCS, SAMPLE_SPANS = 4000, 64
TREES, DEPTH, RATE, BINS = 30, 3, 0.3, 16
PRECISION = 0.98
MOST_GROUPS = 6  #: groups of digits in a number that is proposed from a longer row of them
WINDOW = 64  #: characters of a document's own text on each side of a planted example

Span = tuple[str, int, int]

_LOCAL = frozenset("ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789._%+-")
_DOMAIN = re.compile(r"[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+")
_IP = re.compile(r"(?<![0-9])[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)")
_CARD = re.compile(r"[0-9]([\x20-]?[0-9])+")
_PHONE = re.compile(r"\+[0-9][\x20().0-9-]+[0-9]")
_AT = r"(?:\x20?(?:[\[(]at[\])]|@)\x20?|\x20at\x20)"
_DOT = r"(?:\x20?[\[(](?:dot|\.)[\])]\x20?|\x20dot\x20|\x20\.\x20|\.)"
_SPELLED = re.compile(rf"(?i)(?<![\w.])[\w.+-]{{1,64}}{_AT}[\w-]{{1,63}}(?:{_DOT}[\w-]{{1,63}}){{0,3}}{_DOT}[a-z]{{2,24}}(?!\w)")
_AT_SIGN = re.compile(r"(?i)@|[\[(]at[\])]|\x20at\x20(?=[\w-]{1,63}\x20?[\[(]?dot)")
_BROKEN_IP = re.compile(r"(?<![0-9.])[0-9]{1,3}(?:(?:\[\.\]|\(\.\)|\x20\.\x20)[0-9]{1,3}){3}(?![0-9])")
_NUMBER = re.compile(r"\+?[0-9(][0-9().\x20/:-]*[0-9]")
_PART = re.compile(r"[0-9][0-9.:-]*[0-9]")
_DIGIT = re.compile(r"[0-9]")
_WORDS = re.compile(r"\w+")
#: Words that come before personal data of a kind, or before other numbers.
_CUES = [
    {"mail", "email", "contact", "write", "address", "to", "from"}, {"ip", "host", "server", "from", "login", "client"},
    {"card", "visa", "credit", "payment", "pay", "number"}, {"phone", "tel", "call", "fax", "mobile", "cell"},
    {"version", "license", "licence", "section", "page", "figure", "table", "isbn", "chapter", "v"},
]


# Last labels of addresses, words before planted examples, and words of spelled-out text that is no address.
_DOMAINS = ["com", "org", "net", "edu", "gov", "io", "info", "de", "fr", "es", "it", "uk", "br", "example"]
_BEFORE = {
    "email": ["email", "mail", "contact", "write to", ""], "ip": ["ip", "host", "server", "login from", ""],
    "card": ["card", "visa", "credit card", "payment", "pay with"], "phone": ["phone", "tel", "call", "fax", "mobile"],
}
_NO_ADDRESS = ["product", "plot", "matrix", "size", "pattern", "line"]
_OTHER = ["version", "isbn", "order", "section", "table", "figure", "license", "part", "in", "of"]


def _luhn(digits: str) -> bool:
    total = 0
    for i, c in enumerate(reversed(digits)):
        d = ord(c) - 48
        total += d if i % 2 == 0 else (d * 2 - 9 if d > 4 else d * 2)
    return total % 10 == 0


def _digits(s: str) -> str:
    return "".join(c for c in s if "0" <= c <= "9")


def base_spans(text: str) -> list[Span]:
    """The known formats: leftmost, non-overlapping per kind, failing matches dropped without a retry."""
    out: list[Span] = []
    end, at = 0, text.find("@")
    while at >= 0:  # from each at-sign outwards, which stays linear in texts without spaces
        start = at
        while start > end and text[start - 1] in _LOCAL:
            start -= 1
        m = _DOMAIN.match(text, at + 1) if start < at else None
        if m:
            end = m.end()
            out.append(("email", start, end))
        at = text.find("@", at + 1)
    if not _DIGIT.search(text):
        return out
    for m in _IP.finditer(text):
        if all(len(p.lstrip("0")) <= 3 and int(p.lstrip("0") or 0) <= 255 for p in m[0].split(".")):
            out.append(("ip", *m.span()))
    for m in _CARD.finditer(text):
        if m.end() - m.start() < 40 and 13 <= len(d := _digits(m[0])) <= 19 and _luhn(d):
            out.append(("card", *m.span()))
    if "+" in text:
        for m in _PHONE.finditer(text):
            if 9 <= len(_digits(m[0])) <= 15:
                out.append(("phone", *m.span()))
    return out


def candidates(text: str) -> list[Span]:
    """Overlapping proposals with high recall, each with the kind that its form suggests."""
    out: set[Span] = set()
    for near in _AT_SIGN.finditer(text):
        at = near.start()
        for m in _SPELLED.finditer(text, max(0, at - 66), min(len(text), at + 200)):
            if m.start() <= at < m.end():
                out.add(("email", *m.span()))
    if _DIGIT.search(text):
        out.update(("ip", *m.span()) for m in _BROKEN_IP.finditer(text))
        for m in _NUMBER.finditer(text):
            parts = [m.span()]
            if m.end() - m.start() > 8:
                parts += [p.span() for p in _PART.finditer(text, *m.span())]
            if m.end() - m.start() > 40:  # several numbers in a row: what consecutive groups make
                groups = [g.span() for g in re.finditer(r"\+?\(?[0-9]+", text[m.start() : m.end()])]
                parts += [(m.start() + g[0], m.start() + h[1]) for i, g in enumerate(groups) for h in groups[i : i + MOST_GROUPS]]
            for s, e in parts:
                n = len(_digits(text[s:e])) if e - s <= 64 else 0
                if 6 <= n <= 19 and e - s <= 40:
                    dots = text.count(".", s, e)
                    kind = "ip" if dots == 3 and n <= 12 and " " not in text[s:e] else "card" if n >= 13 else "phone"
                    out.add((kind, s, e))
                elif dots_like(text, s, e):
                    out.add(("ip", s, e))
    return sorted(out, key=lambda x: (x[1], x[2], x[0]))


def dots_like(text: str, start: int, end: int) -> bool:
    return end - start <= 15 and text.count(".", start, end) == 3


def features(text: str, span: Span) -> list[float]:
    """Format and context of a span."""
    kind, s, e = span
    body = text[s:e]
    groups = re.findall(r"[0-9]+", body)
    sizes = [len(g) for g in groups] or [0]
    before = [w.lower() for w in _WORDS.findall(text, max(0, s - 48), s)][-4:]
    prev, after = text[s - 1 : s], text[e : e + 1]
    return [
        float(KINDS.index(kind)), float(len(body)), float(sum(sizes)), float(len(groups)), float(max(sizes)), float(min(sizes)), float(sizes[0]),
        float(body.count(" ")), float(body.count("-")), float(body.count(".")), float(body.count("(")), float("@" in body), float(body[:1] == "+"),
        float(sum(c.isalpha() for c in body)), float(prev.isalnum()), float(after.isalnum()), float(prev in ("", " ", "\n")),
        float(after in ("", " ", "\n", ".", ",")), float(_WORDS.findall(body)[-1].lower() in _DOMAINS), float(len(_digits(body)) >= 13 and _luhn(_digits(body))),
        float("[.]" in body or "(.)" in body or " . " in body), *[float(any(w in cue for w in before)) for cue in _CUES],
    ]


class Boosted:
    """Gradient-boosted trees of fixed depth for two classes, on quantile bins (Newton steps of the logistic loss)."""

    def __init__(self, trees: int = TREES, depth: int = DEPTH, rate: float = RATE, bins: int = BINS) -> None:
        self.trees, self.depth, self.rate, self.bins = trees, depth, rate, bins
        self.start, self.cuts, self.model = 0.0, [], []

    def fit(self, x: np.ndarray, y: np.ndarray) -> "Boosted":
        self.cuts = [np.unique(np.quantile(c, np.linspace(0, 1, self.bins + 1)[1:-1])) for c in x.T]
        binned = self._bin(x)
        mean = min(max(y.mean(), 1e-3), 1 - 1e-3)
        self.start = float(np.log(mean / (1 - mean)))
        score = np.full(len(y), self.start)
        for _ in range(self.trees):
            p = 1 / (1 + np.exp(-score))
            tree, leaf = self._tree(binned, y - p, p * (1 - p))
            self.model.append(tree)
            score += tree["value"][leaf]
        return self

    def _bin(self, x: np.ndarray) -> np.ndarray:
        return np.stack([np.searchsorted(c, v, side="left") for c, v in zip(self.cuts, x.T)], 1)

    def _tree(self, b: np.ndarray, g: np.ndarray, h: np.ndarray) -> tuple[dict, np.ndarray]:
        leaf = np.zeros(len(g), np.int64)
        feature, cut = [], []
        for level in range(self.depth):
            f_of, c_of = np.zeros(1 << level, np.int64), np.full(1 << level, self.bins)
            for node in range(1 << level):
                rows = np.flatnonzero(leaf == node)
                best = 1e-6
                for f in range(b.shape[1] if len(rows) > 1 else 0):
                    gs = np.bincount(b[rows, f], g[rows], self.bins + 1).cumsum()
                    hs = np.bincount(b[rows, f], h[rows], self.bins + 1).cumsum()
                    gain = gs**2 / (hs + 1) + (gs[-1] - gs) ** 2 / (hs[-1] - hs + 1) - gs[-1] ** 2 / (hs[-1] + 1)
                    if gain.max() > best:
                        best, f_of[node], c_of[node] = gain.max(), f, gain.argmax()
            feature.append(f_of)
            cut.append(c_of)
            leaf = leaf * 2 + (b[np.arange(len(g)), f_of[leaf]] > c_of[leaf])
        n = 1 << self.depth
        value = self.rate * np.bincount(leaf, g, n) / (np.bincount(leaf, h, n) + 1)
        return {"feature": feature, "cut": cut, "value": value}, leaf

    def predict(self, x: np.ndarray) -> np.ndarray:
        if not len(x):
            return np.zeros(0)
        b = self._bin(x)
        score = np.full(len(x), self.start)
        for tree in self.model:
            leaf = np.zeros(len(x), np.int64)
            for f, c in zip(tree["feature"], tree["cut"]):
                leaf = leaf * 2 + (b[np.arange(len(x)), f[leaf]] > c[leaf])
            score += tree["value"][leaf]
        return 1 / (1 + np.exp(-score))


def train(sample: pd.DataFrame) -> tuple[Boosted | None, dict[str, float]]:
    """Trees and a threshold for each kind from rows (features, label, fold); fold 0 calibrates.

    Without both labels nothing is learned, and a kind that no threshold makes precise enough adds nothing.
    """
    if sample.empty or sample["label"].nunique() < 2:
        return None, {}
    x, y, held = np.array(sample["features"].tolist()), sample["label"].to_numpy(float), (sample["fold"] == 0).to_numpy()
    if len(set(y[~held])) < 2:
        return None, {}
    model = Boosted().fit(x[~held], y[~held])
    p, limits = model.predict(x[held]), {}
    for i, kind in enumerate(KINDS):
        mine = x[held][:, 0] == i
        order = np.argsort(-p[mine], kind="stable")
        ps, right = p[mine][order], y[held][mine][order].cumsum()
        precise = np.flatnonzero(right / np.arange(1, len(ps) + 1) >= PRECISION) if len(ps) else []
        # Scores that tie must be on one side.
        precise = [j for j in precise if j + 1 == len(ps) or ps[j + 1] < ps[j]]
        if len(precise):
            # Midway to the next score below: every limit in between has the same precision on the held-out rows.
            last = precise[-1]
            limits[kind] = float(max(0.5, (ps[last] + (ps[last + 1] if last + 1 < len(ps) else 0.0)) / 2))
    return model, limits


def _broken(kind: str, value: str, r: np.random.Generator) -> str:
    """value, a span of a known format, in a format that the base patterns don't know."""
    pick = lambda *options: options[int(r.integers(len(options)))]
    if kind == "email":
        name, _, host = value.partition("@")
        return name + pick(" at ", " (at) ", "(at)", " [at] ", " @ ") + host.replace(".", pick(" dot ", " (dot) ", "(dot)", " [dot] "))
    if kind == "ip":
        return value.replace(".", pick("[.]", "(.)", " . "))
    digits = _digits(value)
    if kind == "card":
        return pick(".", "/", "  ", " - ").join(digits[i : i + 4] for i in range(0, len(digits), 4))
    digits = digits[-10:].rjust(10, "5")
    return pick("({}) {}-{}", "{}-{}-{}", "{}.{}.{}", "{} {} {}").format(digits[:3], digits[3:6], digits[6:])


def _made_up(kind: str, r: np.random.Generator) -> str:
    number = lambda n: "".join(map(str, r.integers(0, 10, n)))
    if kind == "email":
        letters = "".join(chr(97 + c) for c in r.integers(0, 26, 12))
        return f"{letters[:5]}@{letters[5:]}.{_DOMAINS[int(r.integers(len(_DOMAINS)))]}"
    if kind == "ip":
        return ".".join(map(str, r.integers(0, 256, 4)))
    if kind == "card":
        body = "4" + number(14)
        return next(body + str(d) for d in range(10) if _luhn(body + str(d)))
    return f"+1{number(10)}"


def _other_meaning(kind: str, r: np.random.Generator) -> str:
    """Something that a generator proposes as this kind and that isn't personal."""
    n = r.integers(0, 10, 16)
    if kind == "email":
        return f"look at {_NO_ADDRESS[int(n[0]) % 6]} dot {_NO_ADDRESS[int(n[1]) % 6]}"
    if kind == "ip":
        return ".".join(map(str, n[:4])) + "." + str(n[4]) if n[5] % 2 else " . ".join(map(str, n[:4]))
    if kind == "card":
        return f"978-{n[0]}-{n[1]}{n[2]}-{''.join(map(str, n[3:9]))}-{n[9]}"
    return f"{1900 + 10 * n[0] + n[1]}-{1900 + 10 * n[2] + n[3]}" if n[4] % 2 else f"{n[0]}{n[1]}.{n[2]}{n[3]}.{n[4]}{n[5]}"


def planted(text: str, base: list[Span], r: np.random.Generator) -> Iterator[tuple[str, Span, int]]:
    """(window, place of the example, label): pieces of text with an example in them."""
    for i, kind in enumerate(KINDS):
        own = [s for s in base if s[0] == kind]
        if own:
            _, s, e = own[int(r.integers(len(own)))]
            before, value, after, label = text[max(0, s - WINDOW) : s], _broken(kind, text[s:e], r), text[e : e + WINDOW], 1
            yield before + value + after, (kind, len(before), len(before) + len(value)), label
        for label in (1, 0):
            at = int(r.integers(len(text) + 1))
            words = _BEFORE[kind] if label else _OTHER
            value = _broken(kind, _made_up(kind, r), r) if label else _other_meaning(kind, r)
            before = f"{text[max(0, at - WINDOW) : at]} {words[int(r.integers(len(words)))]} "
            yield f"{before}{value} {text[at : at + WINDOW]}", (kind, len(before), len(before) + len(value)), label


def _maybe_broken(text: str, c: Span) -> bool:
    """Whether a candidate that nobody planted may be personal data in a broken format, and so is no sure negative."""
    kind, body = c[0], text[c[1] : c[2]]
    sizes = [len(g) for g in re.findall(r"[0-9]+", body)]
    return (
        kind == "email" or (kind == "ip" and _IP.fullmatch(body) is None) or (kind == "card" and _luhn(_digits(body)))
        or (kind == "phone" and (sizes[-3:] == [3, 3, 4] or body[:1] == "+"))
    )


def examples(text: str, seed: int) -> Iterator[tuple[list[float], int]]:
    """(features, label) of the candidates of a document's windows and of its own."""
    base = base_spans(text)
    for window, (kind, s, e), label in planted(text, base, np.random.default_rng(seed)):
        for c in candidates(window):
            if c[1] < e and s < c[2]:
                yield features(window, c), int(label and c == (kind, s, e))
    taken = _merged(base)
    for c in candidates(text)[:SAMPLE_SPANS]:
        if not _maybe_broken(text, c) and not _touches(taken, c):
            yield features(text, c), 0


def _sampled(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    for batch in batches:
        rows = [(*x, int(h % 4)) for text, h in zip(batch["text"], batch["h"]) for x in examples(text, int(h))]
        yield pd.DataFrame(rows, columns=["features", "label", "fold"])


def sample_of(docs: DataFrame, text: str, sample_docs: int = SAMPLE_DOCS) -> DataFrame:
    """Training candidates of about `sample_docs` of the documents with a text, chosen by a hash of the row."""
    some = docs.filter(F.col(text) != "")
    share = min(1.0, sample_docs / max(1, some.count()))
    h = F.pmod(F.xxhash64(packed(docs)), F.lit(1 << 40))
    chosen = some.select(F.col(text).alias("text"), h.alias("h")).filter(F.col("h") < int(share * (1 << 40)))
    return chosen.mapInPandas(_sampled, "features array<double>, label int, fold int")


def scan(text: str, model: Boosted | None, limits: dict[str, float]) -> tuple[list[Span], list[Span]]:
    """Base spans in order of kind, and the spans that the trees add: none that touches a base span or a better one."""
    base = base_spans(text)
    base.sort(key=lambda s: (KINDS.index(s[0]), s[1]))
    if model is None or not limits:
        return base, []
    taken = _merged(base)
    proposed = [c for c in candidates(text) if c[0] in limits and not _touches(taken, c)]
    if not proposed:
        return base, []
    p = model.predict(np.array([features(text, c) for c in proposed]))
    added: list[Span] = []
    placed: list[tuple[int, int]] = []
    for i in sorted(range(len(proposed)), key=lambda i: (-p[i], proposed[i][1], -proposed[i][2])):
        c = proposed[i]
        if p[i] >= limits[c[0]] and not _touches(placed, c):
            added.append(c)
            insort(placed, (c[1], c[2]))
    return base, added


def _merged(spans: list[Span]) -> list[tuple[int, int]]:
    """The places that spans cover, ascending and disjoint."""
    out: list[tuple[int, int]] = []
    for start, end in sorted((s, e) for _, s, e in spans):
        if out and start < out[-1][1]:
            out[-1] = (out[-1][0], max(end, out[-1][1]))
        else:
            out.append((start, end))
    return out


def _touches(places: list[tuple[int, int]], c: Span) -> bool:
    """Whether c overlaps one of places, which are ascending and disjoint."""
    at = bisect_left(places, (c[2], 0))
    return at > 0 and places[at - 1][1] > c[1]


def find_personal_data(docs: DataFrame, text: str = "text", sample_docs: int = SAMPLE_DOCS) -> DataFrame:
    """docs with n_email, n_ip, n_card, n_phone (base spans), base_sha256, spans and n_added.

    Spans are kind:start:end in code points, end exclusive, by kind, then start. A null text counts as empty:
    no spans, and the hash of "". Very long texts are scanned whole. Input columns named like a result column give way. Repeated rows are scanned one by one; an empty table gives an empty one.
    """
    rows = sample_of(docs, text, sample_docs).toPandas()
    rows["features"] = rows["features"].map(tuple)
    model, limits = train(rows.sort_values(["fold", "label", "features"]).reset_index(drop=True))

    @F.pandas_udf("n array<long>, base string, spans string, added long")
    def find(texts: pd.Series) -> pd.DataFrame:
        empty = ([0] * len(KINDS), hashlib.sha256(b"").hexdigest(), "", 0)
        out = []
        for t in texts:
            if not isinstance(t, str):
                out.append(empty)
                continue
            base, added = scan(t, model, limits)
            joined = lambda spans: ",".join(f"{k}:{s}:{e}" for k, s, e in spans)
            every = sorted(base + added, key=lambda s: (KINDS.index(s[0]), s[1]))
            counts = [sum(s[0] == k for s in base) for k in KINDS]
            out.append((counts, hashlib.sha256(joined(base).encode()).hexdigest(), joined(every), len(added)))
        return pd.DataFrame(out, columns=["n", "base", "spans", "added"])

    found = docs.select(packed(docs), find(F.col(text)).alias("f"))
    return unpacked(found, docs.columns, {
        **{f"n_{k}": F.get("f.n", F.lit(i)) for i, k in enumerate(KINDS)},
        "base_sha256": F.col("f.base"), "spans": F.col("f.spans"), "n_added": F.col("f.added"),
    })


def redacted(text: str, spans: str, mark: str = "[{}]") -> str:
    """text with each span of the `spans` column replaced by its kind; of overlapping spans the first counts."""
    out, at = [], 0
    for kind, start, end in sorted((s.split(":") for s in spans.split(",") if s), key=lambda s: (int(s[1]), -int(s[2]))):
        if int(start) >= at:
            out += [text[at : int(start)], mark.format(kind.upper())]
            at = int(end)
    return "".join(out) + text[at:]
