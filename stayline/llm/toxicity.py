"""Toxicity by weak supervision.

Many voters look at a text: fixed lexicons of insults, patterns, and lexicons of word
starts mined from the labelled rows that may be learned from.  A generative label model
(a latent class, and a tree of dependencies between voters that are still correlated
within a class) estimates their accuracies and correlations by expectation
maximisation over counts of vote patterns, of which there are at most ``2**voters``.
Its posterior labels train a linear classifier on hashed words and word starts, which
scores every whole text.  Labels, language, source and ids are never inputs of a score.

Defined results: a null or empty text gets the score of no features; a null id is not
held out; several labels of one id count as toxic if one is; null labels are ignored;
repeated rows are scored each; without labels only the fixed voters speak; an empty
table gives an empty result.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.ml.classification import LogisticRegression
from pyspark.ml.linalg import SparseVector, VectorUDT
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from stayline.llm.texts import U, Words, column_of, slices
from stayline.sources.shared import saved

# Insults by kind, English
LEXICONS = (
    ("idiot", "moron", "stupid", "fool", "dumb", "imbecile", "clown", "brainless"),
    ("loser", "pathetic", "worthless", "trash", "scum", "garbage", "useless", "failure"),
    ("disgusting", "vile", "filthy", "ugly", "hate", "despicable", "creep", "pig"),
)

#: Mined features, spread over so many voters, and the least sure share of toxic rows with one.
MINED, MINED_VOTERS, PURE = 192, 8, 0.8
#: Rows on which the classifier is fitted at most, and its features.
SAMPLE, FEATURES = 20_000, 2048
THRESHOLD = 0.7
#: Bytes of text whose word starts a worker holds at a time.
SLICE = 1 << 20
#: Bytes of word starts (``None``: whole words); a start is dense in a text if it begins two
#: words or more and at least one word in ``DENSE``.
STARTS, DENSE = (None, 4, 5, 6, 8), 200


def _held_out(doc_id: str = "doc_id"):
    return F.coalesce(F.crc32(F.col(doc_id).cast("long").cast("string").cast("binary")) % 3 == 1, F.lit(False))


def _starts(column: pa.Array) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Hashes of all words and word starts, the text of each, and the words per text."""
    words = Words.of(column, letters=True)
    text = np.repeat(np.arange(len(column)), words.counts())
    hashes = np.concatenate([words.hashes(most) ^ U(k) for k, most in enumerate(STARTS)])
    return hashes, np.tile(text, len(STARTS)), words.counts()


def _events(column: pa.Array) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Distinct features of texts: start, whether dense, and the text."""
    hashes, text, sizes = _starts(column)
    order = np.lexsort((hashes, text))
    hashes, text = hashes[order], text[order]
    new = np.ones(len(text), bool)
    new[1:] = (hashes[1:] != hashes[:-1]) | (text[1:] != text[:-1])
    at = np.flatnonzero(new)
    n = np.diff(np.append(at, len(text)))
    hashes, text = hashes[at], text[at]
    dense = (n > 1) & (n * DENSE >= sizes[text])
    return (np.concatenate((hashes, hashes[dense])), np.repeat((False, True), (len(hashes), dense.sum())),
            np.concatenate((text, text[dense])))


class _Finder:
    """Finds given features ``(start, dense)`` in texts without sorting all their words."""

    def __init__(self, features: list[tuple[int, bool]]):
        starts = np.array([f[0] for f in features], np.int64).view(U)
        self.bases = np.unique(starts)
        self.place = np.full((2, len(self.bases)), -1)
        for i, (start, (_, dense)) in enumerate(zip(starts, features)):
            self.place[int(dense), np.searchsorted(self.bases, start)] = i

    def find(self, column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """Text and number of every feature found."""
        if not len(self.bases):
            return np.zeros(0, int), np.zeros(0, int)
        hashes, text, sizes = _starts(column)
        at = np.minimum(np.searchsorted(self.bases, hashes), len(self.bases) - 1)
        hit = self.bases[at] == hashes
        codes, n = np.unique(text[hit] * len(self.bases) + at[hit], return_counts=True)
        text, at = codes // len(self.bases), codes % len(self.bases)
        dense = (n > 1) & (n * DENSE >= sizes[text])
        found = np.concatenate((self.place[0, at], np.where(dense, self.place[1, at], -1)))
        text = np.tile(text, 2)
        return text[found >= 0], found[found >= 0]


# --- voters ----------------------------------------------------------------


_COUNTS = "start long, dense boolean, bad double, n long"


def _count_events(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Texts with each feature and their toxic share ``p``, added up per slice."""
    for batch in slices(batches, "text", SLICE):
        p = batch.column("p").to_numpy()
        starts, dense, text = _events(batch.column("text"))
        for kind in (False, True):
            values, at, n = np.unique(starts[dense == kind], return_inverse=True, return_counts=True)
            bad = np.bincount(at, weights=p[text[dense == kind]], minlength=len(values))
            yield pa.RecordBatch.from_arrays(
                [pa.array(values.view(np.int64)), pa.array(np.full(len(values), kind)), pa.array(bad), pa.array(n)],
                ["start", "dense", "bad", "n"])


def _counted(rows: DataFrame) -> tuple[DataFrame, float, int]:
    """Features of ``rows(text, p)`` in three texts or more, the toxic share and number of rows."""
    counts = rows.mapInArrow(_count_events, _COUNTS).groupBy("start", "dense").agg(F.sum("bad").alias("bad"), F.sum("n").alias("n"))
    total = rows.agg(F.sum("p").alias("bad"), F.count("*").alias("n")).first()
    return saved(counts.where("n >= 3")), total["bad"] or 0.0, total["n"]


def mined_features(labelled: DataFrame) -> list[tuple[int, bool]]:
    """Features most typical of toxic rows of ``labelled(text, p)``, from the most frequent."""
    counts, bad, n = _counted(labelled)
    if not bad or bad == n:
        return []
    # lower bound (Wilson) of the toxic share of rows with the feature, as if classes were even
    good = F.col("n") - F.col("bad")
    share, z = F.col("bad") / ((good + 0.01) * F.lit(bad / (n - bad)) + F.col("bad")), 1.96
    sure = (share + z * z / (2 * F.col("n")) - z * F.sqrt(share * (1 - share) / F.col("n") + z * z / (4 * F.col("n") * F.col("n")))) / (1 + z * z / F.col("n"))
    best = counts.where((F.col("bad") > 2) & (sure > PURE)).orderBy(F.desc("bad"), "start", "dense").limit(MINED)
    return [(r["start"], r["dense"]) for r in best.collect()]


def _fixed_hashes(words: tuple[str, ...]) -> np.ndarray:
    return Words.of(pa.array([" ".join(words)]), letters=True).hashes()


def _vote(mined: list[tuple[int, bool]]):
    """A bit per voter: mined lexicons, fixed lexicons, then patterns."""

    def vote(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        finder = _Finder(mined)
        fixed = [(int(h), False) for words in LEXICONS for h in _fixed_hashes(words).view(np.int64)]
        kinds = np.repeat(np.arange(len(LEXICONS)), [len(words) for words in LEXICONS])
        lexicons = _Finder(fixed)
        spoken = "|".join(w for words in LEXICONS for w in words)
        address = re.compile(rf"\b(?:you|your|you're|u)\b[^.!?\n]{{0,40}}\b(?:{spoken})\b", re.IGNORECASE)
        sign = re.compile(r"[*@$!01][A-Za-z]")
        # addresses are passed over, whatever signs they have
        masked = re.compile(
            r"\b(?:https?://|www\.)\S+|(?<![\w.%+-])[\w.%+-]++@[\w-]++(?:\.[\w-]++)+|(\b[a-z]+[*@$!01]{1,3}[a-z]+\b)", re.IGNORECASE)
        low = MINED_VOTERS + len(LEXICONS)
        for batch in slices(batches, "text", SLICE):
            votes = np.zeros(batch.num_rows, np.int64)
            text, at = finder.find(batch.column("text"))
            np.bitwise_or.at(votes, text, np.int64(1) << (at % MINED_VOTERS))
            text, at = lexicons.find(batch.column("text"))
            np.bitwise_or.at(votes, text, np.int64(1) << (MINED_VOTERS + kinds[at]))
            for i, t in enumerate(batch.column("text").to_pylist()):
                if not t:
                    continue
                if votes[i] >> MINED_VOTERS and address.search(t):  # a fixed lexicon has a word of it
                    votes[i] |= 1 << low
                if "!!" in t or t.isupper():
                    votes[i] |= 1 << (low + 1)
                if sign.search(t) and any(m[1] for m in masked.finditer(t)):
                    votes[i] |= 1 << (low + 2)
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), pa.array(votes)], ["doc_id", "votes"])
    return vote


VOTERS = MINED_VOTERS + len(LEXICONS) + 3


# --- label model -------------------------------------------------------------


@dataclass
class LabelModel:
    """Posterior of each vote pattern and what is known of the voters."""

    prior: float
    fires: np.ndarray  # by class and voter: share of documents on which it fires
    parents: list[int]  # the voter each one depends on, or -1
    correlations: np.ndarray  # of pairs of voters, averaged within the classes
    posterior: np.ndarray  # of the given patterns, without their labels


def _dependence(x: np.ndarray, weight: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Mutual information and correlation of pairs of voters within the classes."""
    information = np.zeros((x.shape[1], x.shape[1]))
    correlation = np.zeros_like(information)
    total = max(weight.sum(), 1)
    for c in range(2):
        w = weight[:, c]
        share = max(w.sum(), 1e-9)
        both = (x * w[:, None]).T @ x / share
        mean = np.diag(both)
        sd = np.sqrt(np.maximum(mean * (1 - mean), 1e-12))
        correlation += (both - np.outer(mean, mean)) / np.outer(sd, sd) * share / total
        for a in (0, 1):
            for b in (0, 1):
                # chances of (a, b) together and apart
                joint = both if a and b else mean[:, None] - both if a else mean[None, :] - both if b else 1 - mean[:, None] - mean[None, :] + both
                apart = np.outer(mean if a else 1 - mean, mean if b else 1 - mean)
                joint = np.maximum(joint, 1e-12)
                information += share / total * joint * np.log(joint / np.maximum(apart, 1e-12))
    return information, correlation


def fit_label_model(patterns: np.ndarray, unknown: np.ndarray, good: np.ndarray, bad: np.ndarray,
                    voters: int = VOTERS, rounds: int = 30, least: float = 1e-3) -> LabelModel:
    """Expectation maximisation over distinct vote patterns with their counts by known label."""
    x = ((patterns[:, None] >> np.arange(voters)) & 1).astype(int)
    parents = [-1] * voters

    def tables(weight):
        """Per class: prior, and the chance to fire given whether the parent fired."""
        prior = (weight.sum(axis=0) + 1) / (weight.sum() + 2)
        fire = np.zeros((2, voters, 2))
        for j in range(voters):
            for p in range(2):
                rows = x[:, parents[j]] == p if parents[j] >= 0 else slice(None)
                w = weight[rows]
                fire[:, j, p] = (w[x[rows, j] == 1].sum(axis=0) + [0.1, 0.5]) / (w.sum(axis=0) + 1)
        return prior, fire

    def posterior(prior, fire):
        logs = np.tile(np.log(prior), (len(x), 1))
        for j in range(voters):
            p = x[:, parents[j]] if parents[j] >= 0 else np.zeros(len(x), int)
            chance = np.clip(fire[:, j, :][:, p].T, 1e-6, 1 - 1e-6)
            logs += np.where(x[:, j: j + 1] == 1, np.log(chance), np.log(1 - chance))
        logs -= logs.max(axis=1, keepdims=True)
        return np.exp(logs[:, 1]) / np.exp(logs).sum(axis=1)

    # to begin with, a text without a vote is fine and each vote speaks for toxicity
    q = 1 / (1 + np.exp(2.0 - 2.0 * x.sum(axis=1)))
    q[x.sum(axis=1) == 0] = 0.02
    for stage in range(2):
        for _ in range(rounds):
            weight = np.stack((good + unknown * (1 - q), bad + unknown * q), axis=1)
            prior, fire = tables(weight)
            q = posterior(prior, fire)
        information, correlation = _dependence(x, weight)
        if stage:
            break
        # strongest dependencies first, as a forest
        group = list(range(voters))
        links: dict[int, list[int]] = {j: [] for j in range(voters)}
        for value, a, b in sorted(((information[a, b], a, b) for a in range(voters) for b in range(a)), reverse=True):
            if value > least and group[a] != group[b]:
                links[a].append(b)
                links[b].append(a)
                group = [group[a] if g == group[b] else g for g in group]
        done: set[int] = set()
        for root in range(voters):
            todo = [(root, -1)] if root not in done else []
            while todo:
                j, parent = todo.pop()
                done.add(j)
                parents[j] = parent
                todo += [(k, j) for k in links[j] if k not in done]
    fires = np.stack([(x * weight[:, c: c + 1]).sum(axis=0) / max(weight[:, c].sum(), 1e-9) for c in range(2)])
    return LabelModel(float(prior[1]), fires, parents, correlation, q)


# --- classifier --------------------------------------------------------------


def _chosen(features: list[tuple[int, bool]]):
    """Numbers of the chosen features that a text has."""

    def chosen(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        finder = _Finder(features)
        for batch in slices(batches, "text", SLICE):
            text, at = finder.find(batch.column("text"))
            order = np.lexsort((at, text))
            cuts = np.searchsorted(text[order], np.arange(batch.num_rows + 1)).astype(np.int32)
            lists = pa.ListArray.from_arrays(pa.array(cuts), pa.array(at[order].astype(np.int32)))
            yield pa.RecordBatch.from_arrays([batch.column("p"), lists], ["p", "at"])
    return chosen


def _score(features: list[tuple[int, bool]], weights: np.ndarray, bias: float, carry: str):
    def score(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        finder, place = _Finder(features), "row.text" if carry == "row" else "text"
        for batch in slices(batches, place, SLICE):
            text, at = finder.find(column_of(batch, place))
            total = bias + (np.bincount(text, weights=weights[at], minlength=batch.num_rows) if len(at) else np.zeros(batch.num_rows))
            score = pa.array(1 / (1 + np.exp(-np.clip(total, -500, 500))))
            yield pa.RecordBatch.from_arrays([batch.column(carry), score], [carry, "score"])
    return score


@dataclass
class Classifier:
    """Chosen features with their weights, and the label model behind them."""

    features: list[tuple[int, bool]]
    weights: np.ndarray
    bias: float
    labels: LabelModel


def fit(docs: DataFrame, labels: DataFrame) -> Classifier:
    """Learn from ``docs(doc_id, text)`` and the ``labels(doc_id, toxic)`` of rows not held out."""
    docs = docs.select(F.col("doc_id").cast("long"), "text")
    known = labels.where("doc_id IS NOT NULL AND toxic IS NOT NULL").where(~_held_out())
    known = known.groupBy(F.col("doc_id").cast("long").alias("doc_id")).agg(F.max("toxic").cast("int").alias("toxic"))
    mined = mined_features(docs.join(known, "doc_id").select("text", F.when(F.col("toxic") != 0, 1.0).otherwise(0.0).alias("p")))
    votes = saved(docs.mapInArrow(_vote(mined), "doc_id long, votes long"))
    kinds = votes.join(known, "doc_id", "left").groupBy("votes").agg(
        F.count(F.when(F.col("toxic").isNull(), 1)).alias("unknown"), F.count(F.when(F.col("toxic") == 0, 1)).alias("good"),
        F.count(F.when(F.col("toxic") != 0, 1)).alias("bad"))
    rows = kinds.orderBy("votes").collect()  # at most 2 ** VOTERS
    patterns, unknown, good, bad = (np.array([r[c] for r in rows], np.int64) for c in ("votes", "unknown", "good", "bad"))
    model = fit_label_model(patterns, unknown, good, bad)
    posterior = docs.sparkSession.createDataFrame(
        [(int(v), float(p)) for v, p in zip(patterns, model.posterior)], "votes long, p double")
    fitting = docs.where(~_held_out() & F.col("doc_id").isNotNull())
    share = min(1.0, SAMPLE / max(1, fitting.count()))
    taken = F.pmod(F.xxhash64(F.col("doc_id"), F.lit("sample")), F.lit(1 << 30)) < int(share * (1 << 30))
    labelled = votes.where(taken).join(F.broadcast(posterior), "votes").groupBy("doc_id").agg(F.max("p").alias("p"))
    sample = saved(fitting.where(taken).join(labelled, "doc_id").select("text", "p"))
    counts, bad, n = _counted(sample)
    if not n:
        return Classifier([], np.zeros(0), -20.0, model)
    good = F.col("n") - F.col("bad")
    rate = F.log((F.col("bad") + 0.5) / (bad + 1)) - F.log((good + 0.5) / (n - bad + 1))
    spread = F.sqrt(1 / (F.col("bad") + 0.5) + 1 / (good + 0.5))
    best = counts.orderBy(F.desc(F.abs(rate / spread)), "start", "dense").limit(FEATURES).collect()
    features = sorted((r["start"], r["dense"]) for r in best)
    width = max(1, len(features))
    vector = F.udf(lambda at: SparseVector(width, at, [1.0] * len(at)), VectorUDT())
    chosen = sample.select("text", "p").mapInArrow(_chosen(features), "p double, at array<int>")
    # a row counts for both classes, by its posterior
    sides = F.explode(F.array(F.struct(F.lit(1.0).alias("label"), F.col("p").alias("weight")),
                              F.struct(F.lit(0.0).alias("label"), (1 - F.col("p")).alias("weight"))))
    training = saved(chosen.select(vector("at").alias("features"), sides.alias("s")).select("features", "s.*").where("weight > 0"))
    fitted = LogisticRegression(featuresCol="features", labelCol="label", weightCol="weight", regParam=1e-4, elasticNetParam=0.0,
                                standardization=False, maxIter=60, aggregationDepth=2).fit(training)
    return Classifier(features, fitted.coefficients.toArray(), float(fitted.intercept), model)


def score(docs: DataFrame, classifier: Classifier) -> DataFrame:
    """``doc_id, held_out, score, predicted`` of every row of ``docs(doc_id, text)``."""
    run = _score(classifier.features, classifier.weights, classifier.bias, "doc_id")
    scored = docs.select(F.col("doc_id").cast("long"), "text").mapInArrow(run, "doc_id long, score double")
    return scored.select("doc_id", _held_out().alias("held_out"), "score", (F.col("score") >= THRESHOLD).cast("int").alias("predicted"))


def clean(docs: DataFrame, classifier: Classifier) -> DataFrame:
    """The rows of ``docs``, all columns, that are not predicted toxic."""
    run = _score(classifier.features, classifier.weights, classifier.bias, "row")
    rows = docs.select(F.struct("*").alias("row"))
    kind = rows.schema["row"].dataType.simpleString()
    scored = rows.mapInArrow(run, f"row {kind}, score double")
    return scored.where(F.col("score") < THRESHOLD).select("row.*")
