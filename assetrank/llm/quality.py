"""Quality classifier from weak labels.

1. Heuristic labellers vote on every document: good, bad or no vote. They
   overlap on purpose (several look at the same fault in different ways).
2. The votes of the whole corpus are counted by pattern (a partial aggregate; a
   labeller votes for one side or not at all, so 2^labellers patterns at most).
   Expectation-maximisation on these counts estimates each labeller's accuracy;
   a missing vote says nothing. The posterior of a pattern is a soft label.
3. A linear scorer over hashed features (words, word shapes, votes) is fitted to
   the soft labels of a bounded sample: at most ``sample`` documents with votes,
   picked by hash.
4. Every document is scored; those below ``threshold`` are rejected.

Defined cases: null and empty texts get no vote and no feature but the constant,
hence the scorer's constant decides; rows alike in id and text get the same
result; an empty table gives an empty result; other columns are kept by
``keep_good`` whatever their names, and ignored by ``classify``.
"""

from __future__ import annotations

import operator
import re
import string
from collections import Counter
from collections.abc import Callable, Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from assetrank.llm import tables, words

GOOD, BAD, NONE = 1, 2, 0

# Frequent function words of four languages.
STOPWORDS = frozenset(
    w.encode()
    for w in (
        "the of and to in a is that it was for on are as with at be this by from or an have not you they which but his her"
        " der die das und ist von den mit zu ein eine nicht auf für dem des sich im auch als er sie es war bei nach aus"
        " le la les de des et est un une que qui en pour dans du au avec sur pas par il elle ce sont"
        " el los las del y que una por con para se no al lo su es como más o pero"
    ).split()
)
# Common insults.
INSULTS = frozenset(
    w.encode()
    for w in (
        "idiot idiots moron morons loser losers trash pathetic clown clowns worthless scum stupid disgusting imbecile dumbass"
        " retard retarded bastard asshole bitch shithead dickhead fuckwit scumbag lowlife vermin filth"
        " idiota idiotas estúpido estúpida imbécil imbécile connard connasse crétin salaud dummkopf arschloch trottel abschaum"
    ).split()
)

_PUNCTUATION = string.punctuation.encode()
_LONE_MARK = re.compile(r"(?<!\S)[^\w\s]{1,2}(?!\S)")
_SYMBOL_RUN = re.compile(r"([^\w\s])\1(?=\s|$)")
_CLASSES = {ord(c): "9" for c in string.digits}
_CLASSES |= {k: "X" if chr(k).isupper() else "x" for k in range(0x250) if chr(k).isalpha()}
_SAME = re.compile(r"(.)\1+", re.DOTALL)


class Measures:
    """What the labellers look at."""

    def __init__(self, text: str):
        self.tokens = text.split()
        self.plain = words.plain_words(text)
        n = max(1, len(self.tokens))
        raw = text.encode("utf-8", "surrogatepass")
        self.n = len(self.tokens)
        self.symbols = (len(raw) - len(raw.translate(None, _PUNCTUATION))) / max(1, len(raw))
        self.upper = sum(map(str.isupper, self.tokens)) / n
        self.shouts = text.count("!") / n
        self.runs = len(_SYMBOL_RUN.findall(text)) / n
        self.lone = len(_LONE_MARK.findall(text)) / n
        self.repeats = sum(map(operator.eq, self.tokens, self.tokens[1:])) / n
        self.separators = (text.count(" | ") + text.count(" / ") + text.count(" - ") + text.count(" • ") + text.count(" > ")) / n
        # distinct words among each 50: a long text is not blamed for its length
        parts = [self.plain[k : k + 50] for k in range(0, len(self.plain), 50)]
        self.variety = sum(len(set(p)) for p in parts) / max(1, len(self.plain))
        self.distinct = set(self.plain)
        self.stops = sum(map(STOPWORDS.__contains__, self.plain)) / max(1, len(self.plain))
        self.insulting = self.distinct & INSULTS
        self.insults = sum(map(INSULTS.__contains__, self.plain)) if self.insulting else 0


def _votes_bad(test: Callable[[Measures], bool]) -> Callable[[Measures], int]:
    return lambda m: BAD if test(m) else NONE


LABELLERS: dict[str, Callable[[Measures], int]] = {
    "upper_case": _votes_bad(lambda m: m.n >= 5 and m.upper > 0.5),
    "exclamations": _votes_bad(lambda m: m.n >= 5 and m.shouts > 0.5),
    "symbols": _votes_bad(lambda m: m.n >= 5 and m.symbols > 0.18),
    "symbol_runs": _votes_bad(lambda m: m.n >= 5 and m.runs > 0.3),
    "lone_marks": _votes_bad(lambda m: m.n >= 5 and m.lone > 0.2),
    "separators": _votes_bad(lambda m: m.n >= 5 and m.separators > 0.2),
    "no_function_words": _votes_bad(lambda m: m.n >= 30 and m.stops < 0.02),
    "repeats": _votes_bad(lambda m: m.n >= 5 and m.repeats > 0.3),
    "little_variety": _votes_bad(lambda m: m.n >= 20 and m.variety < 0.3),
    "insult": _votes_bad(lambda m: m.insults > 0),
    "insult_share": _votes_bad(lambda m: m.insults * 500 > m.n),
    "insults": _votes_bad(lambda m: len(m.insulting) > 1),
    # good needs the absence of every fault, else a majority of good votes would outvote the one labeller that sees it
    "prose": lambda m: GOOD
    if m.n >= 10 and m.stops > 0.08 and m.symbols < 0.1 and m.upper < 0.3 and m.repeats < 0.1 and m.lone < 0.1 and m.variety > 0.4 and not m.insults
    else NONE,
    "plain_words": lambda m: GOOD
    if m.n and m.runs < 0.05 and m.shouts < 0.1 and m.upper < 0.3 and m.lone < 0.1 and m.repeats < 0.15 and m.variety > 0.3 and not m.insults
    else NONE,
}


def vote(m: Measures) -> int:
    """All votes as one number in base 3 (first labeller first)."""
    pattern = 0
    if m.n:
        for labeller in LABELLERS.values():
            pattern = pattern * 3 + labeller(m)
    return pattern


def unpack(patterns: np.ndarray) -> np.ndarray:
    """Votes by pattern and labeller."""
    powers = 3 ** np.arange(len(LABELLERS) - 1, -1, -1)
    return patterns[:, None] // powers[None, :] % 3


class LabelModel:
    """Accuracies of the labellers.

    Both classes count as equally likely: a prior in favour of good would, round
    by round, talk down every labeller that is alone in seeing its fault.
    """

    def __init__(self, accuracy: np.ndarray):
        self.accuracy = accuracy

    def good(self, votes: np.ndarray) -> np.ndarray:
        """Posterior of good per pattern."""
        weight = np.log(self.accuracy / (1 - self.accuracy))
        score = ((votes == GOOD) * weight).sum(1) - ((votes == BAD) * weight).sum(1)
        return 1 / (1 + np.exp(-np.clip(score, -500, 500)))


def fit_labels(patterns: np.ndarray, counts: np.ndarray, rounds: int = 50) -> LabelModel:
    """Expectation-maximisation from accuracies of 0.8, with a weak prior that keeps them off 0 and 1."""
    votes = unpack(patterns)
    model = LabelModel(np.full(len(LABELLERS), 0.8))
    for _ in range(rounds):
        good = model.good(votes)
        right = np.where(votes == GOOD, good[:, None], np.where(votes == BAD, 1 - good[:, None], 0)) * counts[:, None]
        cast = (votes != NONE) * counts[:, None]
        accuracy = (right.sum(0) + 8.0) / (cast.sum(0) + 10.0)
        model = LabelModel(np.clip(accuracy, 0.55, 0.995))
    return model


def features(m: Measures, pattern: int, bits: int) -> tuple[np.ndarray, np.ndarray]:
    """Hashed features and values: words share one unit, votes and shapes have one each."""
    top = np.uint64(64 - bits)
    if not m.n:
        return np.empty(0, dtype="int32"), np.empty(0, dtype="float32")
    word = np.unique((words.hashes(m.plain) >> top).astype("int32"))
    # shapes of all words, runs of one class as one sign; each distinct word is shaped once
    times = Counter(m.tokens)
    shapes: dict[str, int] = {}
    for shape, n in zip(_SAME.sub(r"\1", " ".join(times).translate(_CLASSES)).split(" "), times.values(), strict=True):
        shapes[shape] = shapes.get(shape, 0) + n
    total = sum(shapes.values())
    named = [f"shape {s}" for s in shapes] + [f"vote {k} {v}" for k, v in enumerate(unpack(np.array([pattern]))[0]) if v]
    other = np.array([xxhash.xxh64_intdigest(name) >> int(top) for name in named], dtype="int32")
    value = np.concatenate([np.full(len(word), 1 / np.sqrt(max(1, len(word)))), [c / total for c in shapes.values()], np.ones(len(named) - len(shapes))])
    return np.concatenate([word, other]), value.astype("float32")


def fit_scorer(rows: list[tuple[np.ndarray, np.ndarray]], good: np.ndarray, bits: int, epochs: int = 3, rate: float = 0.5, decay: float = 1e-6) -> np.ndarray:
    """Logistic regression on soft labels, AdaGrad; the last weight is the constant."""
    weights = np.zeros((1 << bits) + 1)
    squares = np.full((1 << bits) + 1, 1e-2)
    constant = np.array([1 << bits])
    for _ in range(epochs):
        for (at, value), target in zip(rows, good, strict=True):
            at, value = np.concatenate([at, constant]), np.append(value, 1.0)
            error = 1 / (1 + np.exp(-np.clip(weights[at] @ value, -30, 30))) - target
            slope = error * value + decay * weights[at]
            squares[at] += slope**2
            weights[at] -= rate * slope / np.sqrt(squares[at])
    return weights.astype("float32")


def _voted(docs: DataFrame, share: float, bits: int) -> DataFrame:
    """pattern, pick (a hash of the text) and, for about ``share`` of all texts, their features
    (at, value), which come with a text's first row in a task."""
    limit = int(share * 2**32)

    def voted(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seen: set[int] = set()
        for batch in tables.each(batches):
            patterns, ats, values = [], [], []
            for text, pick in zip(batch.column(1), batch.column(0).to_pylist(), strict=True):
                m = Measures(text.as_py() or "")
                patterns.append(vote(m))
                chosen = pick & 0xFFFFFFFF < limit and pick not in seen
                if chosen:
                    seen.add(pick)
                at, value = features(m, patterns[-1], bits) if chosen else (None, None)
                ats.append(at.tobytes() if chosen else None)
                values.append(value.tobytes() if chosen else None)
            columns = [pa.array(patterns, pa.int64()), batch.column(0), pa.array(ats, pa.binary()), pa.array(values, pa.binary())]
            yield pa.RecordBatch.from_arrays(columns, names=["pattern", "pick", "at", "value"])

    text = F.col("text").cast("string")
    only = docs.select(F.xxhash64(F.lit("sample"), F.coalesce(text, F.lit("\x00"))).alias("pick"), text.alias("text"))
    return only.mapInArrow(voted, "pattern long, pick long, at binary, value binary")


class Model:
    def __init__(self, labels: LabelModel, weights: np.ndarray, bits: int):
        self.labels, self.weights, self.bits = labels, weights, bits

    def judge(self, text: str | None) -> tuple[float, float]:
        """(score, posterior): the scorer's and the labellers' probability of good."""
        m = Measures(text or "")
        pattern = vote(m)
        at, value = features(m, pattern, self.bits)
        score = float(self.weights[at] @ value + self.weights[-1])
        return 1 / (1 + float(np.exp(-np.clip(score, -30, 30)))), float(self.labels.good(unpack(np.array([pattern])))[0])


def fit(docs: DataFrame, sample: int = 10_000, bits: int = 16) -> Model | None:
    """Fit both models; None for an empty table. The sample is at most ``sample`` texts,
    each once, however many rows hold it."""
    tables.ship(docs.sparkSession)
    total = docs.count()
    if not total:
        return None
    voted = tables.stored(_voted(docs, min(1.0, sample / total), bits), "votes")
    counted = voted.groupBy("pattern").count().collect()  # at most 2^labellers rows
    labels = fit_labels(np.array([r["pattern"] for r in counted]), np.array([r["count"] for r in counted], dtype="float64"))

    def train(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        rows: list[tuple[np.ndarray, np.ndarray]] = []
        patterns: list[int] = []
        for batch in batches:
            rows += [(np.frombuffer(a, dtype="int32"), np.frombuffer(v, dtype="float32")) for a, v in zip(batch["at"], batch["value"], strict=True)]
            patterns += batch["pattern"].tolist()
        yield pd.DataFrame({"weights": [fit_scorer(rows, labels.good(unpack(np.array(patterns, dtype="int64").reshape(-1))), bits).tobytes()]})

    texts = voted.where("at IS NOT NULL AND pattern > 0").dropDuplicates(["pick"])
    picked = texts.orderBy("pick", "pattern").limit(sample).coalesce(1)
    fitted = picked.select("pattern", "at", "value").mapInPandas(train, "weights binary").first()
    weights = np.frombuffer(fitted["weights"], dtype="float32") if fitted else np.zeros((1 << bits) + 1, dtype="float32")
    return Model(labels, weights, bits)


def classify(docs: DataFrame, threshold: float = 0.3, sample: int = 10_000, bits: int = 16) -> DataFrame:
    """doc_id, score, posterior, keep for every row."""
    schema = "doc_id long, score double, posterior double"
    only = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    model = fit(docs, sample, bits)
    shared = docs.sparkSession.sparkContext.broadcast(model)

    def judged(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in tables.each(batches):
            scores = [shared.value.judge(text.as_py()) for text in batch.column(1)]
            columns = [batch.column(0), *(pa.array([s[k] for s in scores], pa.float64()) for k in range(2))]
            yield pa.RecordBatch.from_arrays(columns, names=["doc_id", "score", "posterior"])

    return only.mapInArrow(judged, schema).withColumn("keep", F.col("score") >= threshold)


def keep_good(docs: DataFrame, threshold: float = 0.3, sample: int = 10_000, bits: int = 16) -> DataFrame:
    """``docs`` without rejected rows, all columns kept."""
    model = fit(docs, sample, bits)
    if model is None:
        return docs
    shared = docs.sparkSession.sparkContext.broadcast(model)

    @F.pandas_udf("double")
    def score(texts: pd.Series) -> pd.Series:
        return pd.Series([shared.value.judge(t)[0] for t in texts], dtype="float64")

    return docs.where(score(docs["text"].cast("string")) >= threshold)
