"""Toxicity by weak supervision: voters, a generative label model, a linear classifier on its posteriors.

Learning uses a bounded sample of labelled rows (`sample`, chosen by a hash of the id). Voters are the themes of a general lexicon
and style patterns, which no label chooses, the annotator's own label, and for what the lexicon lacks the words that are
strongly and significantly associated with the label. The label model estimates by EM how often each voter fires for either class, and from the voters' conditional correlations how much of a vote is
new; correlated voters share their weight. An L1 logistic regression on word presence and patterns learns the posteriors, and
scores every whole text.

Defined results: null and empty texts get the score of the intercept; without labels of both classes every score is the smoothed
prior; null labels teach nothing, several labels of a document count as toxic if one does; repeated rows score alike.
"""

from __future__ import annotations

import re
from collections.abc import Callable, Iterator
from dataclasses import dataclass, field

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from benthoframe.session import settle

# General insults and hostile words by theme and language; each theme is a voter. Words that are common in another of
# the languages are left out.
LEXICONS = {
    "mind": "idiot idiots idiotic moron morons moronic imbecile imbeciles stupid stupidity dumb dumbass dimwit halfwit fool fools brainless clueless",
    "worth": "loser losers worthless useless pathetic failure",
    "filth": "trash garbage scum scumbag filth filthy vermin parasite parasites cockroach cockroaches",
    "disgust": "disgusting disgrace disgraceful revolting repulsive vile sickening nasty",
    "mockery": "clown clowns laughable ridiculous crybaby coward cowards freak freaks weirdo",
    "looks": "ugly hideous fatso",
    "hostility": "hate hateful despise loathe detest",
    "threat": "kill strangle punch destroy hurt",
    "profanity": "damn damned crap bastard bastards asshole assholes bullshit fuck fucking fucker shit shitty bitch",
    "insults_de": "trottel depp vollidiot arschloch abschaum widerlich versager scheiße dreckig",
    "insults_fr": "imbécile débile connard connasse salaud ordure crétin",
    "insults_es": "idiota estúpido estúpida imbécil basura asqueroso asquerosa inútil payaso",
}
# Style patterns over the text in lower case, each with a text that it cannot match without, so that a scan is quick.
PATTERNS = {
    "exclaims": ("!", re.compile(r"!\s*!")),
    "addresses": ("you", re.compile(r"you(?: are|'re)? (?:an?|such) ")),
    "accuses": ("you", re.compile(r"\byou (?:all |people |lot )?(?:make me sick|deserve|should be ashamed|are nothing)")),
    "silences": ("shut", re.compile(r"\bshut (?:up|your)\b")),
    "dismisses": ("get ", re.compile(r"\bget (?:lost|out of here|a life)\b")),
    "curses": ("go ", re.compile(r"\bgo (?:to hell|die|kill yourself|hang yourself)\b")),
    "masks": ("", re.compile(r"[*@#$]{2,}\w")),
    "stars": ("*", re.compile(r"\b[a-z]{1,3}\*+[a-z]{1,3}\b")),
    "digits": ("", re.compile(r"\b(?=[a-z]*[013])(?:[i1]d[i1][o0]t|m[o0]r[o0]n|l[o0]s[e3]r|stup[i1]d)s?\b")),
}
_WORD = re.compile(r"\w+")
_THEME = {word: f" {theme}" for theme, words in LEXICONS.items() for word in words.split()}
_SHOUTS = re.compile(r"[A-ZÀ-Þ]{3,}\W+[A-ZÀ-Þ]{3,}\W+[A-ZÀ-Þ]{3,}")
_STRETCHES = tuple(4 * c for c in "aeiouhmrs")


def signs(text: str) -> set[str]:
    """Words in lower case, and names of the themes and patterns that occur, marked by a leading space."""
    lower = text.lower()
    found = set(_WORD.findall(lower))
    insults = _THEME.keys() & found
    found.update(f" {name}" for name, (needs, p) in PATTERNS.items() if needs in lower and p.search(lower))
    found.update(_THEME[w] for w in insults)
    if len(insults) > 1:
        found.add(" several")
    if _SHOUTS.search(text):
        found.add(" shouts")
    if any(s in lower for s in _STRETCHES):
        found.add(" stretches")
    return found


#: The voters that no label chooses.
_SIGNS = [*(f" {name}" for name in (*LEXICONS, *PATTERNS)), " several", " shouts", " stretches"]


@dataclass
class Model:
    weights: dict[str, float] = field(default_factory=dict)
    bias: float = 0.0
    #: Voter to (fires for class 0, fires for class 1, share of its vote that is new).
    voters: dict[str, tuple[float, float, float]] = field(default_factory=dict)

    def score(self, text: str) -> float:
        z = self.bias + sum(self.weights[w] for w in sorted(signs(text) & self.weights.keys()))
        return float(1 / (1 + np.exp(-np.clip(z, -500, 500))))


def label_model(fires: np.ndarray, gold: np.ndarray, rounds: int = 12) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Posterior of class 1 of each row, firing rates (2, voters) and the new share of each voter.

    `fires` is rows by voters; `gold` is the annotator's label, the starting point and one more voter. The first half of the
    rounds takes the voters for independent, so that wrong labels do not look like correlation; then the votes of a voter
    count by the share that its correlations with the others within the classes leave.
    """
    votes = np.column_stack([fires, gold]).astype(np.float64)
    q, share = np.where(gold > 0, 0.9, 0.1), np.ones(votes.shape[1])
    for done in range(rounds):
        mass = np.array([(1 - q).sum(), q.sum()])
        rate = np.stack([(votes.T @ (1 - q) + 0.1) / (mass[0] + 0.2), (votes.T @ q + 0.1) / (mass[1] + 0.2)])
        if done >= rounds // 2:
            together = np.zeros((votes.shape[1],) * 2)
            for y, w in enumerate((1 - q, q)):
                centred = (votes - rate[y]) * np.sqrt(w)[:, None]
                together += centred.T @ centred
            spread = np.sqrt(np.maximum(np.diag(together), 1e-12))
            correlation = np.clip(together / spread / spread[:, None], 0, 1)
            np.fill_diagonal(correlation, 0)
            correlation[correlation < 0.1] = 0  # what independent voters show by chance
            share = 1 / (1 + correlation.sum(1))
        on, off = np.log(rate[1] / rate[0]), np.log((1 - rate[1]) / (1 - rate[0]))
        z = np.log(mass[1] / mass[0]) + votes @ (share * (on - off)) + (share * off).sum()
        q = 1 / (1 + np.exp(-np.clip(z, -50, 50)))
    return q, rate[:, :-1], share[:-1]


def fit_linear(owner: np.ndarray, sign: np.ndarray, q: np.ndarray, signs_: int, l1: float = 2e-4, rounds: int = 300) -> tuple[np.ndarray, float]:
    """Weights and bias of an L1 logistic regression on presences (owner: row, sign: column) by accelerated proximal steps."""
    rows = len(q)
    w, b = np.zeros(signs_), float(np.log((q.mean() + 1e-6) / (1 - q.mean() + 1e-6)))
    v, vb, t = w.copy(), b, 1.0
    count = np.bincount(sign, minlength=signs_) / rows
    # each column steps by its own curvature bound: presences in a row times a quarter of the column's share
    most = np.bincount(owner, minlength=rows).max(initial=0) + 1
    typical = max(4.0, min(most, 40.0))
    step, bias_step = 1 / (0.25 * typical * np.maximum(count, 1 / rows)), 1 / (0.25 * typical)
    for _ in range(rounds):
        p = 1 / (1 + np.exp(-np.clip(np.bincount(owner, v[sign], rows) + vb, -50, 50)))
        gap = (p - q) / rows
        new = v - step * np.bincount(sign, gap[owner], signs_)
        new = np.sign(new) * np.maximum(np.abs(new) - step * l1 * np.sqrt(np.maximum(count, 1 / rows)), 0)
        new_b = vb - bias_step * gap.sum()
        if ((v - new) @ (new - w)) + (vb - new_b) * (new_b - b) > 0:
            t = 1.0  # restart where momentum points uphill
        later = (1 + np.sqrt(1 + 4 * t * t)) / 2
        v, vb = new + (t - 1) / later * (new - w), new_b + (t - 1) / later * (new_b - b)
        w, b, t = new, new_b, later
    return w, float(b)


def train(docs: DataFrame, labels: DataFrame, sample: int = 20_000, vocabulary: int = 2_000, lexicon: int = 200, lift: float = 2.0) -> Model:
    """Learn from the labelled documents given; `labels` (doc_id, toxic) holds learning rows only.

    A word outside the themes is a voter if significant and strong (log odds of at least `lift`): in a large sample weak signs such
    as the function words of a language are significant too, and so many that they would turn the label model to that language.
    """
    known = labels.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("toxic").cast("int").alias("toxic")).dropna()
    known = known.groupBy("doc_id").agg((F.max("toxic") > 0).cast("int").alias("toxic"))
    there = known.count()
    chosen = known.where(F.pmod(F.xxhash64("doc_id"), F.lit(1 << 20)) < int(min(1.0, sample / max(there, 1)) * (1 << 20)))
    # About `sample` rows of two numbers, whatever the size of the tables.
    texts = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text").join(F.broadcast(chosen), "doc_id")

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = [sorted(signs(t.as_py() or "")) for t in batch.column("text")]
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), batch.column("toxic"), pa.array(found, pa.list_(pa.string()))], ["doc_id", "toxic", "signs"])

    seen = settle(texts.mapInArrow(read, "doc_id long, toxic int, signs array<string>"), "toxic-sample")
    size = {r["toxic"]: r["count"] for r in seen.groupBy("toxic").count().collect()}
    clean, toxic = size.get(0, 0), size.get(1, 0)
    if not clean or not toxic:
        return Model(bias=float(np.log((toxic + 0.5) / (clean + 0.5))))
    counted = seen.select("toxic", F.explode("signs").alias("sign")).groupBy("sign").agg(F.sum("toxic").alias("t"), F.count("*").alias("n"))
    t, c = F.col("t") + 0.5, F.col("n") - F.col("t") + 0.5
    odds = F.log(t / (toxic + 1.0 - t)) - F.log(c / (clean + 1.0 - c))
    z = odds / F.sqrt(1 / t + 1 / c)
    ranked = counted.where("n >= 3").select("sign", z.alias("z"), odds.alias("odds"))
    top = ranked.orderBy(F.desc("z"), "sign").limit(vocabulary // 2).union(ranked.orderBy("z", "sign").limit(vocabulary // 2)).distinct().collect()
    scores = {r["sign"]: r["z"] for r in top}
    strong = {r["sign"] for r in top if r["z"] > 3 and r["odds"] >= lift} - _THEME.keys() - set(_SIGNS)
    for name in _SIGNS:
        scores.setdefault(name, 0.0)
    names = sorted(scores)
    at = {n: i for i, n in enumerate(names)}

    def place(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = [sorted(at[s] for s in row if s in at) for row in batch.column("signs").to_pylist()]
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), batch.column("toxic"), pa.array(found, pa.list_(pa.int32()))], ["doc_id", "toxic", "signs"])

    # about `sample` rows of at most `vocabulary` numbers
    kept = seen.mapInArrow(place, "doc_id long, toxic int, signs array<int>").orderBy("doc_id").collect()
    owner = np.repeat(np.arange(len(kept)), [len(r["signs"]) for r in kept])
    sign = np.array([s for r in kept for s in r["signs"]], np.int64)
    gold = np.array([r["toxic"] for r in kept], np.float64)
    fired = {names[i] for i in np.unique(sign)} & set(_SIGNS)  # the others have no vote
    voters = sorted(fired | set(sorted(strong, key=lambda n: (-scores[n], n))[:lexicon]))
    column = np.full(len(names), -1)
    column[[at[n] for n in voters]] = np.arange(len(voters))
    fires = np.zeros((len(kept), len(voters)), np.float32)
    mine = column[sign] >= 0
    fires[owner[mine], column[sign[mine]]] = 1
    q, rate, share = label_model(fires, gold)
    w, b = fit_linear(owner, sign, q, len(names))
    used = {n: float(w[i]) for n, i in at.items() if w[i]}
    return Model(used, b, {n: (float(rate[0, i]), float(rate[1, i]), float(share[i])) for i, n in enumerate(voters)})


def score_column(model: Model) -> Callable[[str], Column]:
    """A column function: the score of each text of a column."""
    shared = SparkSession.active().sparkContext.broadcast(model)  # at most `vocabulary` weights

    @F.pandas_udf("double")
    def rated(texts: pd.Series) -> pd.Series:
        return pd.Series([shared.value.score(t or "") for t in texts], dtype="float64")

    return rated


def score(docs: DataFrame, model: Model) -> DataFrame:
    """doc_id, score and predicted of every row."""
    rated = docs.select(F.col("doc_id").cast("long").alias("doc_id"), score_column(model)("text").alias("score"))
    return rated.withColumn("predicted", (F.col("score") >= 0.5).cast("int"))
