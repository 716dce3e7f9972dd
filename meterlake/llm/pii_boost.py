"""Personal data by candidate generation and gradient-boosted selection.

Base rules find e-mail addresses, IPv4 addresses, card and phone numbers.
High-recall generators propose further, overlapping spans: digit groups,
assigned or bare keys, spelled-out addresses, account numbers. Boosted trees
score every candidate from the format of its text and the words around it.
Their labels come from validators (base rules, check digits, assignments); a
candidate's generator and validator results are not features, so the trees
have to learn from format and context. The threshold is calibrated on
documents held out of the training: the lowest score at which the share of
right selections reaches the target. Selected candidates that overlap no base
span and no better candidate are added to the base spans.

Trees and threshold come from every candidate of every different text. Tasks
label the candidates and put their features into bins whose edges are
quantiles over all training candidates; equal binned rows are counted. Each
level of a tree takes the sums of gradients by node, feature and bin from all
these rows, added up by Spark as whole numbers, so the trees do not depend on
how rows are dealt; only the sums, the edges and the counts by score reach the
driver. A corpus without both labels on both sides adds nothing.

Defined results: a null or empty text has no spans and the hash of the empty
string; equal scores go by start, then length; repeated rows get equal
results; an empty table gives an empty result; extra columns are ignored by
``personal_data`` and passed through by ``redacted``.
"""

from __future__ import annotations

import hashlib
import math
import re
from collections import Counter
from collections.abc import Callable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from meterlake.llm.common import materialise, slices, two_columns

PRECISION = 0.98
ROWS_PER_TASK = 1 << 18
STEPS = 1 << 16  # scores are told apart in so many steps for the threshold
UNIT = 1 << 24  # gradients are summed as whole multiples of 1 / UNIT

BASE_KINDS = ("email", "ip", "card", "phone")
ADDED_KINDS = ("secret", "account", "number", "address")

# The e-mail rule is matched from each @ outwards; an address can only start where a run of digits does, so a run is
# read once. All rules take time in proportion to the text, whatever it holds.
EMAIL_LOCAL = frozenset("ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789._%+-")
EMAIL_DOMAIN = re.compile(r"@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+")
DOTTED = re.compile(r"[0-9.]+")
IP = re.compile(r"(?<![0-9])[0-9]++(\.[0-9]++){3}")
CARD = re.compile(r"[0-9]([\x20-]?[0-9])+")
PHONE = re.compile(r"\+[0-9][\x20().0-9-]+[0-9]")

ASSIGNED = re.compile(r"[=:]\s*[\"']?([A-Za-z0-9+/_=.-]{12,})")
BARE_KEY = re.compile(r"(?<![A-Za-z0-9+/_=-])(?=[A-Za-z+/_=-]*[0-9])[A-Za-z0-9+/_=-]{20,}")
ACCOUNT = re.compile(r"\b[A-Z]{2}[0-9]{2}(?:[\x20]?[A-Z0-9]{4}){2,7}(?:[\x20]?[A-Z0-9]{1,3})?\b")
DIGIT_GROUP = re.compile(r"[0-9](?:[\x20().-]{0,2}[0-9]){6,}")
SPELLED = re.compile(r"(?<![A-Za-z0-9._-])[A-Za-z0-9._-]++\s?(?:\[at\]|\(at\))\s?[A-Za-z0-9-]+(?:\s?(?:\.|\[dot\]|\(dot\))\s?[A-Za-z0-9-]+)+")

# Words that speak of personal data or of secrets.
CUES = ["token", "secret", "password", "passwd", "pwd", "key", "api", "auth", "iban", "account", "konto", "ssn",
        "social", "tel", "phone", "call", "fax", "mobile", "mail", "contact", "card", "visa", "ip", "host"]
WORD = re.compile(r"[a-z]+")

FEATURES = ("length", "digits", "letters", "upper", "separators", "distinct", "entropy", "digit_runs", "longest_run",
            "hex_share", "quoted", "assigned", "cue_before", "secret_cue", "contact_cue", "letter_before",
            "letter_after", "digit_before", "digit_after", "spaces_inside", "dots_inside", "numbers_near")

RESULT = ("doc_id long, n_email long, n_ip long, n_card long, n_phone long, base_sha256 string, spans string")


def luhn(digits: str) -> bool:
    total = 0
    for k, c in enumerate(reversed(digits)):
        d = int(c) * (1 + k % 2)
        total += d - 9 if d > 9 else d
    return total % 10 == 0


def digits_of(text: str) -> str:
    return "".join(c for c in text if "0" <= c <= "9")


def email_spans(t: str) -> list[tuple[int, int]]:
    """Matches of the e-mail rule: before each @ the longest run of its characters that no earlier match or @ holds."""
    out = []
    free, at = 0, t.find("@")
    while at >= 0:
        lo = at
        while lo > free and t[lo - 1] in EMAIL_LOCAL:
            lo -= 1
        domain = EMAIL_DOMAIN.match(t, at) if lo < at else None
        if domain:
            out.append((lo, domain.end()))
        free = domain.end() if domain else at + 1
        at = t.find("@", free)
    return out


def base_spans(t: str) -> dict[str, list[tuple[int, int]]]:
    """Spans of the base rules, per kind in order of start."""
    found: dict[str, list[tuple[int, int]]] = {k: [] for k in BASE_KINDS}
    found["email"] = email_spans(t)
    for run in DOTTED.finditer(t):
        if run[0].count(".") >= 3:
            found["ip"] += [m.span() for m in IP.finditer(t, *run.span())
                            if all(len(p) <= 3 and int(p or "0") <= 255 for p in (x.lstrip("0") for x in m[0].split(".")))]
    for m in CARD.finditer(t):
        if m.end() - m.start() >= 16:
            digits = digits_of(m[0])
            if 16 <= len(digits) <= 19 and luhn(digits):
                found["card"].append(m.span())
    if "+" in t:
        found["phone"] = [m.span() for m in PHONE.finditer(t) if 8 <= len(digits_of(m[0])) <= 15]
    return found


def account_checks(text: str) -> bool:
    """Remainder 1 of the rearranged account number modulo 97."""
    s = text.replace(" ", "")
    return int("".join(str(int(c, 36)) for c in s[4:] + s[:4])) % 97 == 1


def candidates(t: str) -> list[tuple[str, int, int]]:
    """High-recall proposals (kind, start, end); they may overlap each other and the base spans."""
    out = []
    for m in ASSIGNED.finditer(t) if "=" in t or ":" in t else ():
        out.append(("secret", *m.span(1)))
    for m in BARE_KEY.finditer(t):
        out.append(("secret", *m.span()))
    for m in ACCOUNT.finditer(t):
        out.append(("account", *m.span()))
    for m in DIGIT_GROUP.finditer(t):
        out.append(("number", *m.span()))
    if "[at]" in t or "(at)" in t:
        out += [("address", *m.span()) for m in SPELLED.finditer(t)]
    return list(dict.fromkeys(out))


def valid(t: str, kind: str, start: int, end: int, base: list[tuple[int, int]]) -> bool:
    """Weak label: the candidate is what a base rule or another validator accepts."""
    if any(a < end and start < b for a, b in base):
        return True
    if kind == "account":
        return account_checks(t[start:end])
    if kind == "address":
        return True
    if kind == "secret":
        before = t[max(0, start - 24):start].lower()
        assigned = re.search(r"[=:]\s*[\"']?$", before)
        cue = any(w in ("token", "secret", "password", "passwd", "pwd", "key", "auth") for w in WORD.findall(before))
        return bool(assigned) and cue and any(c.isdigit() for c in t[start:end])
    return False


def features(t: str, start: int, end: int) -> list[float]:
    """Format of the candidate's text and context; nothing that only its validator knows."""
    s = t[start:end]
    n = len(s)
    count = Counter(s)
    digits = sum(v for c, v in count.items() if "0" <= c <= "9")
    letters = sum(v for c, v in count.items() if c.isalpha())
    runs = re.findall(r"[0-9]+", s)
    before, after = t[max(0, start - 24):start].lower(), t[end:end + 24]
    words = WORD.findall(before)[-3:]
    entropy = -sum(v / n * math.log2(v / n) for v in count.values())
    return [
        n, digits / n, letters / n, sum(v for c, v in count.items() if c.isupper()) / n,
        sum(v for c, v in count.items() if c in " ().-_/+=") / n, len(count) / n, entropy, len(runs),
        max(map(len, runs), default=0), sum(v for c, v in count.items() if c in "0123456789abcdefABCDEF") / n,
        float(bool(before) and before[-1] in "\"'"), float("=" in before[-4:] or ":" in before[-4:]),
        float(any(w in CUES for w in words)), float(any(w in CUES[:8] for w in words)),
        float(any(w in CUES[13:] for w in words)),
        float(bool(before) and before[-1].isalpha()), float(bool(after) and after[0].isalpha()),
        float(any(c.isdigit() for c in before[-3:])), float(any(c.isdigit() for c in after[:3])),
        s.count(" "), s.count("."), len(re.findall(r"[0-9]+", before + " " + after)),
    ]


@dataclass
class BoostedTrees:
    """Second-order boosting of shallow trees over binned features, with logistic loss."""

    rounds: int = 60
    depth: int = 3
    rate: float = 0.2
    bins: int = 32
    smooth: float = 1.0

    def fit(self, x: np.ndarray, y: np.ndarray) -> BoostedTrees:
        inner = np.linspace(0, 1, self.bins + 1)[1:-1]
        self.edges = [np.unique(np.quantile(x[:, k], inner)) for k in range(x.shape[1])]
        binned, once = self.bin(x), np.ones(len(y))
        self.boost(float(y.mean()), lambda tree, nodes: self.sums(tree, nodes, binned, once, y))
        return self

    def boost(self, share: float, sums: Callable[[list, list[int]], np.ndarray]) -> None:
        """All trees, level by level; ``sums`` gives ``self.sums`` over all training rows, ``share`` is that of true labels."""
        share = np.clip(share, 1e-4, 1 - 1e-4)
        self.base = float(np.log(share / (1 - share)))
        self.trees: list[list[tuple[int, int, float]]] = []
        for _ in range(self.rounds):
            tree = [(-1, 0, 0.0)] * (2 ** (self.depth + 1) - 1)
            nodes = [0]
            for _ in range(self.depth):
                if nodes:
                    nodes = self.split(tree, nodes, sums(tree, nodes) / UNIT)
            self.trees.append(tree)

    def bin(self, x: np.ndarray) -> np.ndarray:
        return np.stack([np.searchsorted(e, x[:, k], side="right") for k, e in enumerate(self.edges)], axis=1)

    def sums(self, tree: list[tuple[int, int, float]], nodes: list[int], binned: np.ndarray, n: np.ndarray,
             positive: np.ndarray) -> np.ndarray:
        """Gradient and hessian in UNITs by node, feature and bin, of rows found ``n`` times, ``positive`` of them true."""
        p = self.chance(binned)
        g = n * np.rint(p * UNIT) - positive * UNIT
        h = n * np.rint(p * (1 - p) * UNIT)
        at = self.place(tree, binned)
        out = np.zeros((2, len(nodes), binned.shape[1], self.bins))
        for i, node in enumerate(nodes):
            own = np.flatnonzero(at == node)
            for k in range(binned.shape[1]):
                out[0, i, k] = np.bincount(binned[own, k], g[own], self.bins)
                out[1, i, k] = np.bincount(binned[own, k], h[own], self.bins)
        return out

    def split(self, tree: list[tuple[int, int, float]], nodes: list[int], sums: np.ndarray) -> list[int]:
        """Splits the nodes of ``tree`` (feature, highest bin to the left, value; feature -1 is a leaf) where that gains; their children."""
        children = []
        for node, g, h in zip(nodes, *sums):
            whole_g, whole_h = g[0].sum(), h[0].sum()
            gl, hl = np.cumsum(g, axis=1)[:, :-1], np.cumsum(h, axis=1)[:, :-1]
            gr, hr = whole_g - gl, whole_h - hl
            gain = gl ** 2 / (hl + self.smooth) + gr ** 2 / (hr + self.smooth) - whole_g ** 2 / (whole_h + self.smooth)
            k, at = np.unravel_index(gain.argmax(), gain.shape)
            if gain[k, at] <= 1e-6:
                tree[node] = (-1, 0, float(-self.rate * whole_g / (whole_h + self.smooth)))
                continue
            tree[node] = (int(k), int(at), 0.0)
            for child, cg, ch in ((2 * node + 1, gl[k, at], hl[k, at]), (2 * node + 2, gr[k, at], hr[k, at])):
                tree[child] = (-1, 0, float(-self.rate * cg / (ch + self.smooth)))
                children.append(child)
        return children

    def place(self, tree: list[tuple[int, int, float]], binned: np.ndarray) -> np.ndarray:
        """The leaf of each row."""
        feature, split, _ = (np.array(v) for v in zip(*tree))
        at, rows = np.zeros(len(binned), np.int64), np.arange(len(binned))
        for _ in range(self.depth):
            inner = feature[at] >= 0
            right = binned[rows, np.maximum(feature[at], 0)] > split[at]
            at = np.where(inner, 2 * at + 1 + right, at)
        return at

    def chance(self, binned: np.ndarray) -> np.ndarray:
        score = np.full(len(binned), self.base)
        for tree in self.trees:
            score += np.array([v for _, _, v in tree])[self.place(tree, binned)]
        return 1 / (1 + np.exp(-score))

    def probability(self, x: np.ndarray) -> np.ndarray:
        return self.chance(self.bin(x))


@dataclass
class Selector:
    """Fitted trees with their calibrated threshold."""

    trees: BoostedTrees
    threshold: float


def calibrated_threshold(p: np.ndarray, y: np.ndarray, precision: float = PRECISION,
                         n: np.ndarray | None = None) -> float:
    """Lowest score from which on the selection's precision is at least ``precision``; above 1 if there is none.

    With ``n``, each score stands for so many candidates, ``y`` of them right.
    """
    order = np.argsort(-p, kind="stable")
    right = np.cumsum(y[order]) / np.cumsum(np.ones(len(y)) if n is None else n[order])
    last = np.append(p[order][1:] != p[order][:-1], True)
    good = np.flatnonzero((right >= precision) & last)
    return float(p[order][good[-1]]) if len(good) else 2.0


def training_rows(df: DataFrame) -> DataFrame:
    """(held, label, x): every candidate of every different text, with its weak label and features."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for _, texts in slices(batches):
            keys, held, label, values = [], [], [], []
            for t in texts.to_pylist():
                found = candidates(t)
                if not found:
                    continue
                base = [s for spans in base_spans(t).values() for s in spans]
                doc = hashlib.blake2b(t.encode("utf-8", "surrogatepass"), digest_size=8).digest()
                for k, (kind, a, b) in enumerate(found):
                    keys.append(doc.hex() + f":{k:08d}")
                    held.append(doc[0] % 3 == 0)
                    label.append(valid(t, kind, a, b, base))
                    values.append(features(t, a, b))
            yield pa.RecordBatch.from_arrays(
                [pa.array(keys, pa.string()), pa.array(held, pa.bool_()), pa.array(label, pa.bool_()),
                 pa.array(values, pa.list_(pa.float64()))], names=["key", "held", "label", "x"])

    found = two_columns(df, "doc_id", "text").mapInArrow(run, "key string, held boolean, label boolean, x array<double>")
    return found.dropDuplicates(["key"]).select("held", "label", "x")


def quantile_edges(rows: DataFrame, bins: int, n_rows: int) -> list[np.ndarray]:
    """Per feature, the ``bins`` - 1 inner quantiles of all rows, as ``np.quantile`` has them (between two values, linear)."""
    place = (n_rows - 1) * np.linspace(0, 1, bins + 1)[1:-1]
    below = np.floor(place).astype(np.int64)
    above = np.minimum(below + 1, n_rows - 1)
    ranks = F.array(*(F.lit(int(r)) for r in np.union1d(below, above)))
    counts = rows.select(F.posexplode("x").alias("k", "v")).groupBy("k", "v").agg(F.count("*").alias("n"))
    ranked = counts.select("k", "v", "n", F.sum("n").over(Window.partitionBy("k").orderBy("v")).alias("upto"))
    asked = F.exists(ranks, lambda r: (r >= F.col("upto") - F.col("n")) & (r < F.col("upto")))
    found = ranked.filter(asked).select("k", "v", "upto").orderBy("k", "v").toArrow()  # two values a quantile at most
    k, v, upto = (found[c].to_numpy() for c in ("k", "v", "upto"))
    edges, share = [], place - below
    for i in range(len(FEATURES)):
        own, ends = v[k == i], upto[k == i]
        lo, hi = (own[np.searchsorted(ends, r, side="right")] for r in (below, above))
        edges.append(np.unique(np.where(share < 0.5, lo + (hi - lo) * share, hi - (hi - lo) * (1 - share))))
    return edges


def binned_rows(rows: DataFrame, trees: BoostedTrees, n_rows: int) -> DataFrame:
    """(held, bins, n, positive): how often each different row of bins is found, and how often with a true label."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            x = batch.column(2).flatten().to_numpy().reshape(-1, len(FEATURES))
            bins = [r.tobytes() for r in trees.bin(x).astype(np.uint8)]
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), pa.array(bins, pa.binary())],
                                             names=["held", "label", "bins"])

    return (rows.select("held", "label", "x").mapInArrow(run, "held boolean, label boolean, bins binary")
            .groupBy("held", "bins").agg(F.count("*").alias("n"), F.sum(F.col("label").cast("long")).alias("positive"))
            .coalesce(max(1, -(-n_rows // ROWS_PER_TASK))))


def unpacked(batch: pa.RecordBatch) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Bins, n and positive of a batch of binned rows."""
    bins = np.frombuffer(b"".join(batch.column(0).to_pylist()), np.uint8).reshape(-1, len(FEATURES))
    return bins, batch.column(1).to_numpy(), batch.column(2).to_numpy()


def boosted(train: DataFrame, trees: BoostedTrees, share: float, n_rows: int) -> None:
    """Grows the trees over all rows (bins, n, positive): one job a level, whose tasks send sums alone."""
    adders = -(-n_rows // (16 * ROWS_PER_TASK))

    def sums(tree: list, nodes: list[int]) -> np.ndarray:
        shape = (2, len(nodes), len(FEATURES), trees.bins)

        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            total = np.zeros(shape)
            for batch in batches:
                total += trees.sums(tree, nodes, *unpacked(batch))
            flat = total.astype(np.int64).ravel()
            at = np.flatnonzero(flat)
            yield pa.RecordBatch.from_arrays([pa.array(at), pa.array(flat[at])], names=["at", "v"])

        parts = train.mapInArrow(run, "at long, v long")
        parts = parts.repartition(adders, "at") if n_rows > ROWS_PER_TASK else parts.coalesce(1)
        told = parts.groupBy("at").agg(F.sum("v").alias("v")).toArrow()
        out = np.zeros(shape)
        out.flat[told["at"].to_numpy()] = told["v"].to_numpy()
        return out

    trees.boost(share, sums)


def score_counts(rows: DataFrame, trees: BoostedTrees) -> pa.Table:
    """(step, n, positive) of all rows (bins, n, positive), by the step of their score."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            bins, n, positive = unpacked(batch)
            step = np.floor(trees.chance(bins) * STEPS).astype(np.int64)
            yield pa.RecordBatch.from_arrays([pa.array(c) for c in (step, n, positive)], names=["step", "n", "positive"])

    return (rows.mapInArrow(run, "step long, n long, positive long").groupBy("step")
            .agg(F.sum("n").alias("n"), F.sum("positive").alias("positive")).toArrow())


def fit_selector(docs: DataFrame, precision: float = PRECISION) -> Selector | None:
    """Selector from all candidates of all texts (doc_id, text); None without both labels on both sides."""
    rows = materialise(training_rows(docs), "pii_candidates")
    counts = {(r["held"], r["label"]): r["n"] for r in rows.groupBy("held", "label").agg(F.count("*").alias("n")).collect()}
    if len(counts) < 4:
        return None
    n_train = counts[False, True] + counts[False, False]
    trees = BoostedTrees()
    trees.edges = quantile_edges(rows.filter("not held"), trees.bins, n_train)
    binned = materialise(binned_rows(rows, trees, sum(counts.values())), "pii_binned")
    boosted(binned.filter("not held").select("bins", "n", "positive"), trees, counts[False, True] / n_train, n_train)
    told = score_counts(binned.filter("held").select("bins", "n", "positive"), trees)
    step, n, positive = (told[c].to_numpy() for c in ("step", "n", "positive"))
    return Selector(trees, calibrated_threshold(step / STEPS, positive, precision, n))


def selected_spans(texts: list[str], selector: Selector | None) -> list[dict[str, list[tuple[int, int]]]]:
    """Base spans and selected candidates of each text, per kind in order of start."""
    out, places, values = [], [], []
    for i, t in enumerate(texts):
        out.append(base_spans(t) | {k: [] for k in ADDED_KINDS})
        if selector is not None:
            for c in candidates(t):
                places.append((i, *c))
                values.append(features(t, *c[1:]))
    if values:
        p = selector.trees.probability(np.array(values, float))
        taken = {i: [s for spans in out[i].values() for s in spans] for i in {x[0] for x in places}}
        for k in sorted(np.flatnonzero(p >= selector.threshold), key=lambda k: (-p[k], places[k][2], -places[k][3])):
            i, kind, a, b = places[k]
            if not any(x < b and a < y for x, y in taken[i]):
                taken[i].append((a, b))
                out[i][kind].append((a, b))
    for spans in out:
        for k in ADDED_KINDS:
            spans[k].sort()
    return out


def joined(spans: dict[str, list[tuple[int, int]]], kinds: tuple[str, ...]) -> str:
    return ",".join(f"{k}:{a}:{b}" for k in kinds for a, b in spans[k])


def personal_data(df: DataFrame, key: str = "doc_id", text: str = "text") -> DataFrame:
    """Counts and digest of the base spans, and all spans, of every whole text."""
    docs = two_columns(df, key, text)
    selector = fit_selector(docs)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for keys, texts in slices(batches):
            found = selected_spans(texts.to_pylist(), selector)
            base = [joined(s, BASE_KINDS) for s in found]
            yield pa.RecordBatch.from_arrays(
                [keys, *(pa.array([len(s[k]) for s in found], pa.int64()) for k in BASE_KINDS),
                 pa.array([hashlib.sha256(b.encode()).hexdigest() for b in base], pa.string()),
                 pa.array([joined(s, BASE_KINDS + ADDED_KINDS) for s in found], pa.string())],
                names=["doc_id", *(f"n_{k}" for k in BASE_KINDS), "base_sha256", "spans"])

    return docs.mapInArrow(run, RESULT)


def without_spans(t: str, spans: dict[str, list[tuple[int, int]]]) -> str:
    """The text with each maximal run of spans replaced by the upper-case kind of its first span in brackets."""
    flat = sorted((a, b, k) for k, each in spans.items() for a, b in each)
    out, at = [], 0
    while flat:
        a, b, kind = flat.pop(0)
        while flat and flat[0][0] < b:
            b = max(b, flat.pop(0)[1])
        out += [t[at:a], f"[{kind.upper()}]"]
        at = b
    return "".join([*out, t[at:]])


def redacted(df: DataFrame, key: str = "doc_id", text: str = "text", length: str | None = "n_chars") -> DataFrame:
    """``df`` with personal data replaced in the text column (a null text stays null) and the length column renewed."""
    selector = fit_selector(two_columns(df, key, text))
    names = df.columns

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            at = names.index(text)
            old = batch.column(at).cast(pa.string())
            new = []
            for _, part in slices(iter([pa.RecordBatch.from_arrays([old, old], names=["k", "t"])])):
                plain = part.to_pylist()
                new += [without_spans(t, s) for t, s in zip(plain, selected_spans(plain, selector))]
            column = pc.if_else(pc.is_valid(old), pa.array(new, pa.string()), pa.scalar(None, pa.string()))
            columns = list(batch.columns)
            columns[at] = column.cast(columns[at].type)
            if length in names:
                n = names.index(length)
                columns[n] = pc.if_else(pc.is_valid(old), pc.utf8_length(column).cast(columns[n].type), columns[n])
            yield pa.RecordBatch.from_arrays(columns, schema=batch.schema)

    return df.mapInArrow(run, df.schema)
