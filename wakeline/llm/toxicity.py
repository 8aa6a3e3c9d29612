"""Toxicity by a weighted finite-state grammar over clauses.

Five small transducers (insult, threat, target, negation, reported speech) read the same classes of
tokens; their product is one deterministic machine. A clause is run through it only where the
lexicon matches. An insult gives its weight, raised beside a target and lowered under negation or
reported speech; a threat needs a target. Clause scores are summed up over the whole text and a
logistic curve over the sums gives the score.

The lexicon holds a few fixed words and what labelled texts teach: word starts (or whole words)
whose weight of evidence for the label is high beyond doubt.
"""

from __future__ import annotations

import math
import re
from collections.abc import Iterable
from dataclasses import dataclass, field
from itertools import product

import ahocorasick
import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from wakeline.sources.scratch import materialise

#: Labelled texts of each class that the fit reads at most (in expectation: a hash picks them).
FIT_TEXTS = 6000
#: Letters of a learned word start.
LONGEST_START = 8
_FOLDS = 5

# Word lists of the grammar in the four languages of the tables.
INSULTS = "idiot moron stupid loser scum trash clown pathetic worthless disgusting".split()
THREATS = "kill hurt destroy beat crush burn shoot stab töten schlagen tuer frapper matar golpear".split()
TARGETS = "you your yours u he she they them him her du dich dir ihr euch tu te toi vous tú usted ustedes".split()
# Targets that are objects wherever they stand: before the verb they are threatened too.
OBJECTS = "dich dir euch ihn te toi os".split()
NEGATIONS = "not never no isn't aren't don't nicht kein keine nie ne pas jamais nunca".split()
REPORTS = "said says told wrote quoted claimed reported sagte schrieb dit écrit dijo escribió".split()
INSULT_WEIGHT, THREAT_WEIGHT = 6.0, 2.0
TARGET_FACTOR, NEGATION_FACTOR, REPORT_FACTOR = 1.5, 0.5, 0.5
NEGATION_SCOPE, THREAT_SCOPE = 2, 3

_CLAUSE = re.compile(r"[.;:!?,\n\r]+")
_TOKEN = re.compile(r"[^\W\d_]+(?:'[^\W\d_]+)?")


@dataclass(frozen=True)
class Transducer:
    """Arcs (state, symbol) -> (state, output); a missing arc goes to ``rest(state)`` without output."""

    arcs: dict
    rest: dict

    def step(self, state: int, symbol: str) -> tuple[int, str]:
        return self.arcs.get((state, symbol), (self.rest[state], ""))


def _counting_down(opens: str, scope: int, on: Iterable[str], output: str) -> Transducer:
    """``opens`` starts a scope of tokens; a symbol of ``on`` inside it makes ``output``."""
    arcs = {(s, opens): (scope, "") for s in range(scope + 1)}
    arcs |= {(s, x): (s - 1, output) for s in range(1, scope + 1) for x in on}
    return Transducer(arcs, {s: max(0, s - 1) for s in range(scope + 1)})


def _threats(scope: int) -> Transducer:
    """A threat needs whom it is aimed at: a target up to ``scope`` tokens after the verb, or an object as many before it.
    States from 1 count down behind a verb, those above ``scope`` behind an object."""
    arcs = {(0, "threat"): (scope, ""), (0, "object"): (2 * scope, "")}
    for s in range(1, scope + 1):
        arcs |= {(s, "threat"): (scope, ""), (s, "target"): (s - 1, "threat"), (s, "object"): (s - 1, "threat")}
        arcs |= {(scope + s, "threat"): (0, "threat"), (scope + s, "object"): (2 * scope, "")}
    rest = {s: max(0, s - 1) for s in range(scope + 1)} | {scope + s: scope + s - 1 if s > 1 else 0 for s in range(1, scope + 1)}
    return Transducer(arcs, rest)


HITS = ("insult", "threat")
MACHINES = (
    Transducer({(0, "insult"): (0, "insult")}, {0: 0}),
    _threats(THREAT_SCOPE),
    # A target before an insult raises it; the first target after an insult raises it too.
    Transducer(
        {(0, t): (1, "") for t in ("target", "object")}
        | {(1, "insult"): (1, "aimed"), (0, "insult"): (2, "")}
        | {(2, t): (1, "aim back") for t in ("target", "object")},
        {0: 0, 1: 1, 2: 2},
    ),
    _counting_down("negation", NEGATION_SCOPE, HITS, "negated"),
    Transducer({(0, "report"): (1, ""), **{(1, h): (1, "reported") for h in HITS}}, {0: 0, 1: 1}),
)
SYMBOLS = ("insult", "threat", "target", "object", "negation", "report", "other")


def compose(machines: tuple[Transducer, ...] = MACHINES) -> dict:
    """The product machine: state -> symbol -> (state, factor of an insult, factor of the last insult, weight of a threat that is
    complete, factor of a threat that begins or is complete here)."""
    table: dict = {}
    todo = [tuple(0 for _ in machines)]
    while todo:
        state = todo.pop()
        if state in table:
            continue
        table[state] = {}
        for symbol in SYMBOLS:
            moves = [m.step(s, symbol) for m, s in zip(machines, state)]
            out = {o for _, o in moves}
            softer = (NEGATION_FACTOR if "negated" in out else 1.0) * (REPORT_FACTOR if "reported" in out else 1.0)
            factor = softer * ("insult" in out) * (TARGET_FACTOR if "aimed" in out else 1.0)
            back = TARGET_FACTOR - 1 if "aim back" in out else 0.0
            table[state][symbol] = (tuple(n for n, _ in moves), factor, back, THREAT_WEIGHT * ("threat" in out), softer)
            todo.append(table[state][symbol][0])
    number = {s: i for i, s in enumerate(table)}
    number_of = {number[s]: {x: (number[n], *out) for x, (n, *out) in row.items()} for s, row in table.items()}
    return {"start": number[tuple(0 for _ in machines)], "arcs": number_of}


@dataclass
class Model:
    """Lexicon (word start, or whole word with ``$``) -> weight; logistic weights, the first a constant."""

    lexicon: dict[str, float] = field(default_factory=lambda: {w + "$": INSULT_WEIGHT for w in INSULTS})
    weights: tuple[float, ...] = (-4.0, 2.0, 1.0, 0.0)


class Grammar:
    def __init__(self, lexicon: dict[str, float]):
        self.lexicon = lexicon
        self.longest = max(map(len, lexicon), default=0)
        self.fixed = {
            **dict.fromkeys(REPORTS, "report"),
            **dict.fromkeys(NEGATIONS, "negation"),
            **dict.fromkeys(TARGETS, "target"),
            **dict.fromkeys(OBJECTS, "object"),
            **dict.fromkeys(THREATS, "threat"),
        }
        self.machine = compose()
        self.finder = ahocorasick.Automaton()
        for w in [*(x.rstrip("$") for x in lexicon), *THREATS]:
            self.finder.add_word(w, len(w))
        self.finder.make_automaton()

    def insult(self, word: str) -> float:
        """Weight of the longest entry that the word begins with."""
        whole = self.lexicon.get(word + "$")
        if whole is not None:
            return whole
        for size in range(min(len(word), self.longest), 0, -1):
            found = self.lexicon.get(word[:size])
            if found is not None:
                return found
        return 0.0

    def clause(self, text: str) -> float:
        """Sum over the clause: insults, raised by a target and lowered by negation and reported speech, and threats that are
        aimed at somebody, lowered alike."""
        state, arcs = self.machine["start"], self.machine["arcs"]
        total = last = 0.0
        softer = 1.0  # of the last verb of a threat
        for word in _TOKEN.findall(text):
            weight = self.insult(word)
            symbol = "insult" if weight else self.fixed.get(word, "other")
            state, factor, back, threat, here = arcs[state][symbol]
            softer = here if symbol == "threat" else softer
            gain = factor * weight
            total += gain + back * last + threat * softer
            last = gain or last
        return total

    def matches(self, text: str | None) -> list[tuple[int, int, float]]:
        """(begin, end, score) of the clauses of the lower-cased text that score above 0."""
        low = (text or "").lower()
        hits = [
            end - size + 1
            for end, size in self.finder.iter(low)
            if end < size or not low[end - size].isalpha()
        ]
        if not hits:
            return []
        hits.sort()
        found, begin, at = [], 0, 0
        for cut in [*(m.span() for m in _CLAUSE.finditer(low)), (len(low), len(low))]:
            if at < len(hits) and hits[at] < cut[0]:
                score = self.clause(low[begin : cut[0]])
                if score > 0:
                    found.append((begin, cut[0], score))
                while at < len(hits) and hits[at] < cut[1]:
                    at += 1
            begin = cut[1]
        return found

    def features(self, text: str | None) -> tuple[float, float, float]:
        scores = [s for _, _, s in self.matches(text)]
        if not scores:
            return 0.0, 0.0, 0.0
        total = sum(scores)
        return math.log1p(total), math.log1p(max(scores)), math.log1p(1e4 * total / max(len(text), 1))


def features(text: Column, lexicon: dict[str, float]) -> Column:
    """Array of three sums over the matched clauses of a text."""

    @F.pandas_udf("array<double>")
    def run(texts: pd.Series) -> pd.Series:
        grammar = Grammar(lexicon)
        return texts.map(grammar.features, na_action=None)

    return run(text.cast("string"))


def score(text: Column, model: Model) -> Column:
    """Probability of the label from 0 to 1; null and empty texts get the curve's value at no match."""
    w = model.weights
    x = features(text, model.lexicon)
    return F.aggregate(
        F.zip_with(x, F.array(*(F.lit(v) for v in w[1:])), lambda a, b: a * b),
        F.lit(float(w[0])),
        lambda a, b: a + b,
        lambda z: 1 / (1 + F.exp(-z)),
    )


def fold(id_col: str = "doc_id") -> Column:
    return F.crc32(F.col(f"`{id_col}`").cast("string").cast("binary")) % _FOLDS


def _prefixes(longest: int) -> Column:
    word = F.col("word")
    starts = F.transform(F.sequence(F.lit(3), F.least(F.lit(longest), F.char_length(word))), lambda n: F.substring(word, F.lit(1), n))
    return F.concat(F.when(F.char_length(word) >= 3, starts).otherwise(F.array().cast("array<string>")), F.array(F.concat(word, F.lit("$"))))


def choose(rows: list[tuple[str, int, int]], pos: int, neg: int, least: int, strict: float) -> dict[str, float]:
    """Lexicon from (entry, positive count, negative count). An entry stays if the lower bound of its
    weight of evidence reaches ``strict``; it gives way to longer entries that are surer
    or make up nearly all of it, and is then judged by what they leave."""
    count = {f: (p, n) for f, p, n in rows}
    children: dict[str, list[str]] = {}
    for f in count:
        up = f[:-1]
        if up in count:
            children.setdefault(up, []).append(f)
    chosen: dict[str, float] = {}

    def weigh(p: int, n: int) -> tuple[float, float]:
        w = math.log((p + 0.5) / (pos + 1)) - math.log((n + 0.5) / (neg + 1))
        return w, w - 3 * math.sqrt(1 / (p + 0.5) + 1 / (n + 0.5))

    def visit(f: str) -> tuple[int, int, dict[str, float], float]:
        p, n = count[f]
        below = [visit(c) for c in children.get(f, ())]
        weight, sure = weigh(p, n)
        better = [b for b in below if b[3] > sure or b[0] >= 0.95 * p]
        if p >= least and sure >= strict and not better:
            return p, n, {f: weight}, sure
        taken = {k: w for b in below for k, w in b[2].items()}
        tp, tn = sum(b[0] for b in below), sum(b[1] for b in below)
        weight, sure = weigh(p - tp, n - tn)
        if p - tp >= least and sure >= strict:
            return p, n, {**taken, f: weight}, max([sure, *(b[3] for b in below)])
        return tp, tn, taken, max([-math.inf, *(b[3] for b in below)])

    for f in count:
        if f[:-1] not in count:
            chosen |= visit(f)[2]
    return chosen


def fit(
    docs: DataFrame,
    labels: DataFrame,
    id_col: str = "doc_id",
    text: str = "text",
    label: str = "toxic",
    fit_texts: int = FIT_TEXTS,
) -> Model:
    """Learns from the labelled rows whose crc32(id as text) mod 5 is not 0.

    Remainders 1 to 3 make the lexicon, 4 the curve. Of each class a hash of the id picks about
    ``fit_texts`` rows; the driver gets one row per lexicon candidate and three numbers per row of
    the curve. Learned word starts have at most ``LONGEST_START`` letters, whole words any number. Rows without id, text or a
    label of 0 or 1 teach nothing, an id labelled both ways counts as 1, copies and repeated rows count once, other columns are not
    read. Without usable labels, or with an empty table, the fixed lexicon and curve stay.
    """
    model = Model()
    known = labels.select(F.col(f"`{id_col}`").alias("id"), F.col(f"`{label}`").cast("int").alias("y")).where(
        F.col("id").isNotNull() & F.col("y").isin(0, 1)
    ).groupBy("id").agg(F.max("y").alias("y"))
    known = known.where(fold("id") != 0)
    sizes = {r["y"]: r["count"] for r in known.groupBy("y").count().collect()}
    if len(sizes) < 2:
        return model
    share = F.lit(0.0)
    for y, n in sizes.items():
        share = F.when(F.col("y") == y, F.lit(min(1.0, fit_texts / n))).otherwise(share)
    known = known.where(F.pmod(F.xxhash64("id", F.lit("fit")), F.lit(1_000_000)) < share * 1_000_000)
    texts = docs.select(F.col(f"`{id_col}`").alias("id"), F.col(f"`{text}`").cast("string").alias("t"))
    # At most about 2 * fit_texts ids, whatever the tables' size: small enough to broadcast and store.
    rows = materialise(texts.join(F.broadcast(known), "id").select("t", "y", fold("id").alias("fold")), "fit")
    # Copies of one text are one witness: what only they have in common says nothing about the label.
    known = rows.withColumn("w", F.split(F.lower("t"), r"[^\p{L}]+"))

    def least(seed: int) -> Column:
        return F.array_min(F.transform("w", lambda x, i: F.xxhash64(x, F.get("w", i + 1), F.get("w", i + 2), F.lit(seed))))

    known = known.select("t", "y", "fold", *(least(i).alias(f"least{i}") for i in range(3)))
    for i in range(3):
        known = known.dropDuplicates(["y", "fold", f"least{i}"])
    known = materialise(known.select("t", "y", "fold"), "fit")
    pairs = known.where("fold < 4").select("y", F.explode(F.array_distinct(F.split(F.lower("t"), r"[^\p{L}]+"))).alias("word")).where("word != ''")
    counted = pairs.groupBy("word").agg(F.sum("y").alias("p"), F.sum(1 - F.col("y")).alias("n"))
    # Positive pairs first: entries of too few of them are never looked at.
    all_counts = counted.select(F.explode(_prefixes(LONGEST_START)).alias("f"), "p", "n").groupBy("f").agg(F.sum("p").alias("p"), F.sum("n").alias("n"))
    totals = counted.agg(F.sum("p"), F.sum("n")).first()
    if totals[0] and totals[1]:
        ratio = (F.col("p") + 0.5) / (F.col("n") + 0.5) * (totals[1] + 1) / (totals[0] + 1)
        found = [tuple(r) for r in all_counts.where((F.col("p") >= 5) & (ratio >= 1.5)).collect()]
        model.lexicon = {**model.lexicon, **choose(found, totals[0], totals[1], 5, 1.0)}
    curve = known.where("fold = 4").select("y", features(F.col("t"), model.lexicon).alias("x")).collect()
    if len({r.y for r in curve}) == 2:
        model.weights = logistic(np.array([r.x for r in curve]), np.array([r.y for r in curve], float))
    return model


def logistic(x: np.ndarray, y: np.ndarray, ridge: float = 1.0) -> tuple[float, ...]:
    """Ridge logistic regression by Newton steps."""
    x = np.column_stack([np.ones(len(x)), x])
    w, pull = np.zeros(x.shape[1]), np.diag([1e-6, *[ridge] * (x.shape[1] - 1)])
    for _ in range(50):
        p = 1 / (1 + np.exp(-np.clip(x @ w, -30, 30)))
        step = np.linalg.solve((x * (p * (1 - p))[:, None]).T @ x + pull, x.T @ (y - p) - pull @ w)
        w = w + step
        if np.abs(step).max() < 1e-8:
            break
    return tuple(float(v) for v in w)
