"""Toxicity by weak supervision.

Many weak voters look at every text: a public lexicon, patterns, and words and word
beginnings that are mined from labelled documents. A generative model explains their votes
by a hidden label: each voter fires with one probability on toxic and another on clean
texts, which expectation maximisation estimates over the votes on all documents; voters
that fire together more often than their accuracies explain are correlated, and share
their weight. The model's posterior labels, soft ones, then train a linear classifier,
which also knows words that no voter has, and scores every text.

Votes are counted per distinct set of voters that fired, so the model's steps are sums over
a small table in Spark; the driver gets a few numbers per voter. Nothing is sampled: voters
are mined from all labelled documents, every feature with enough evidence for their number
is one, and the classifier is fitted on all documents that are not held out, by gradients
that Spark sums over the distinct sets of features that may tell. The driver and the workers
hold a number for each such feature. Posteriors are worked out from the text where they are
needed, so only labelled texts are shuffled, once.
"""

from __future__ import annotations

import math
import re
from array import array
from collections import Counter
from collections.abc import Callable, Iterable, Iterator
from itertools import chain, combinations, islice, pairwise

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import xxhash
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, DoubleType, IntegerType, StructField, StructType

from cabtally.llm.common import free_name, freeing, stored, table

#: How many times as often as in clean documents a voter has to be found in toxic ones.
ODDS = 20
#: Rounds of estimating accuracies before and after correlations are known.
ROUNDS = 5
#: Correlation from which two voters say the same. Below it, it is mostly that documents
#: differ in language or in length, not that voters see the same words.
CORRELATED = 0.4
#: Word beginnings that are features beside whole words, by length.
BEGINNINGS = (4, 5, 6, 8)
THRESHOLD = 0.7
#: Words and features that a worker knows about at a time; bounds of memory only.
KEPT_WORDS, KEPT_FEATURES = 200_000, 250_000
#: Features of the distinct sets that a task sums the gradients of.
TASK_FEATURES = 4_000_000
#: Numbers that are added up over tasks together.
BLOCK = 1024
#: Texts that are looked at together, and their bytes, about.
TOGETHER, CHUNK_BYTES = 1000, 1 << 20
#: Steps of fitting the classifier, at most; each is a Spark job.
STEPS = 150

LEXICON = ("idiot", "moron", "stupid", "scum", "trash", "loser", "pathetic", "worthless", "disgusting", "bastard")
#: Patterns over lower-case text; each is a voter. Only texts that have one of the parts
#: before a pattern can match it, which is faster to tell.
PATTERNS = (
    (("**",), r"\b\w+\*{2,}\w*\b"),
    (("you're ", "you are "), r"\byou(?:'re| are) (?:an? |such |so )?(?:complete |total |utter )?(?:idiot|moron|stupid|loser|trash|scum|pathetic)"),
    (("shut up",), r"\bshut up\b"),
    (("go to hell", "go die", "go kill"), r"\bgo (?:to hell|die|kill)\b"),
    (("hate ", "despise "), r"\b(?:hate|despise) (?:you|them|those|these)\b"),
    (("!!!",), r"!{3,}"),
)

#: Words are runs of letters. What is beyond ASCII stays in a word at first.
_TOKEN = re.compile(r"[^\W\d_]+")
LETTERS = bytes(b if b >= 128 or 97 <= b <= 122 else 32 for b in range(256))


def held_out(doc_id: Column) -> Column:
    return F.crc32(F.coalesce(doc_id.cast("string"), F.lit(""))) % 3 == 1


def _features(word: str) -> list[str]:
    """The word, and its beginnings where they are shorter than it."""
    return [word] + [f"{word[:n]}-" for n in BEGINNINGS if len(word) > n]


class _Places(dict):
    """Numbers words in the order they are asked for."""

    def __missing__(self, word: bytes) -> int:
        number = self[word] = len(self)
        return number


class Lookup:
    """The numbers that a function gives the features of a text's words. It is asked once for
    each word; a bounded number of words is kept."""

    def __init__(self, of_features: Callable[[list[str]], Iterable[int]]):
        self._of_features = of_features
        self.clear()

    def clear(self) -> None:
        self._places, self._numbers, self._ends = _Places(), array("q"), array("q", [0])

    def of_texts(self, texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """``(row, number)``, each pair once and in order, of lower-case texts."""
        if len(self._places) > KEPT_WORDS:
            self.clear()
        words, sizes = [], []
        for text in texts:
            own = text.encode().translate(LETTERS).split()
            words.extend(map(self._places.__getitem__, own))
            sizes.append(len(own))
        numbers, of_features = self._numbers, self._of_features
        extend, end = numbers.extend, self._ends.append
        for word in islice(self._places, len(self._ends) - 1, None):
            if word.isascii():
                extend(of_features(_features(word.decode())))
            else:
                for token in _TOKEN.findall(word.decode()):
                    extend(of_features(_features(token)))
            end(len(numbers))
        row, word = _distinct(np.repeat(np.arange(len(texts)), sizes), np.array(words, np.int64))
        if not len(row) or not numbers:
            return np.zeros(0, np.int64), np.zeros(0, np.int64)
        ends, known = np.frombuffer(self._ends, np.int64), np.frombuffer(numbers, np.int64)
        first, lengths = ends[word], ends[word + 1] - ends[word]
        at = np.arange(lengths.sum()) + np.repeat(first - (np.cumsum(lengths) - lengths), lengths)
        return _distinct(np.repeat(row, lengths), known[at])


def _distinct(row: np.ndarray, number: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    if not len(row):
        return row, number
    least = number.min()
    span = number.max() - least + 1
    key = np.sort(row * span + (number - least))
    key = key[np.append(True, key[1:] != key[:-1])]
    return key // span, key % span + least


def _chunks(batches: Iterator[pa.RecordBatch], text: int = 0) -> Iterator[tuple[pa.RecordBatch, list[str]]]:
    """Rows, so many at a time that their texts are bounded, and the texts in lower case."""
    for batch in batches:
        ends = np.cumsum(pc.fill_null(pc.binary_length(batch.column(text)), 0).to_numpy(zero_copy_only=False))
        first = 0
        while first < batch.num_rows:
            before = ends[first - 1] if first else 0
            last = min(first + TOGETHER, max(first + 1, int(np.searchsorted(ends, before + CHUNK_BYTES, "right"))))
            part = batch.slice(first, last - first)
            yield part, [(t or "").lower() for t in part.column(text).to_pylist()]
            first = last


def feature_counts(labelled: DataFrame) -> DataFrame:
    """``(feature, toxic, clean)``: in how many of the documents ``(text, toxic)`` of either
    label a feature is. Counts are added up in the task before they are shuffled."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        places: dict[str, int] = {}
        lookup = Lookup(lambda features: [places.setdefault(f, len(places)) for f in features])
        counts = np.zeros((2, 0), np.int64)

        def taken() -> pa.RecordBatch:
            names = pa.array(list(places)[: counts.shape[1]], pa.string())
            return pa.RecordBatch.from_arrays([names, pa.array(counts[1]), pa.array(counts[0])], ["feature", "toxic", "clean"])

        for rows, texts in _chunks(batches):
            row, feature = lookup.of_texts(texts)
            counts = np.pad(counts, ((0, 0), (0, len(places) - counts.shape[1])))
            np.add.at(counts, (rows.column(1).to_numpy()[row], feature), 1)
            if len(places) > KEPT_FEATURES:
                yield taken()
                places.clear(), lookup.clear()
                counts = np.zeros((2, 0), np.int64)
        yield taken()

    return (
        labelled.select("text", "toxic")
        .mapInArrow(freeing(run), "feature string, toxic long, clean long")
        .groupBy("feature")
        .agg(F.sum("toxic").alias("toxic"), F.sum("clean").alias("clean"))
    )


def evidence(toxic: Column, clean: Column, all_toxic: int, all_clean: int) -> Column:
    """Logarithm of one over a bound of the chance that at least this share of the documents
    with a feature is toxic although the feature does not tell."""
    base = all_toxic / (all_toxic + all_clean)
    share = toxic / (toxic + clean)
    other = F.when(clean > 0, clean * F.log((1 - share) / F.lit(1 - base))).otherwise(0.0)
    return toxic * F.log(share / F.lit(base)) + other


def mined_voters(labelled: DataFrame, toxic: int, clean: int) -> list[str]:
    """The features that tell toxic documents, best first: all that would stand out by chance
    less than once among as many features as there are labelled documents. A word and its
    beginnings are one family, of which the best votes."""
    if not toxic or not clean:
        return []
    ratio = (F.col("toxic") / toxic) / ((F.col("clean") + 0.5) / clean)
    found = (
        feature_counts(labelled)
        .where((F.col("toxic") > 0) & (ratio > ODDS))
        .withColumn("evidence", evidence(F.col("toxic"), F.col("clean"), toxic, clean))
        .where(F.col("evidence") > math.log(toxic + clean))
        .orderBy(F.col("evidence").desc(), F.length("feature"), "feature")
        .select("feature")
        .collect()
    )
    rank = {row.feature: i for i, row in enumerate(found)}
    return [f for f, i in rank.items() if all(rank.get(b, i) >= i for b in _features(f.rstrip("-"))[1:])]


class Voters:
    """Numbers of the voters: lexicon, patterns, then mined features."""

    def __init__(self, mined: list[str]):
        self._lexicon = {word: i for i, word in enumerate(LEXICON)}
        self._patterns = [(len(LEXICON) + i, parts, p) for i, (parts, p) in enumerate(PATTERNS)]
        first = len(LEXICON) + len(PATTERNS)
        self._mined = {f: first + i for i, f in enumerate(mined)}
        self.size = first + len(mined)

    def of_text(self, lower: str) -> set[int]:
        return {i for i, parts, p in self._patterns if any(part in lower for part in parts) and re.search(p, lower)}

    def of_texts(self, texts: list[str], row: np.ndarray, hit: np.ndarray) -> list[list[int]]:
        """All voters that fire on each text, sorted: ``hit`` by its words, and patterns."""
        ends = np.searchsorted(row, np.arange(len(texts) + 1))
        own = (hit[a:b].tolist() for a, b in pairwise(ends.tolist()))
        return [sorted({*hits, *self.of_text(text)}) for hits, text in zip(own, texts, strict=True)]

    def of_features(self, features: list[str]) -> list[int]:
        """The lexicon's voter for a word, and the best of the mined ones of its family."""
        fired = [self._lexicon[features[0]]] if features[0] in self._lexicon else []
        if not self._mined.keys().isdisjoint(features):
            fired.append(min(self._mined[f] for f in features if f in self._mined))
        return fired


def votes(documents: DataFrame, voters: Voters) -> DataFrame:
    """``(doc_id, hits)``: the sorted numbers of the voters that fire on each document
    ``(doc_id, text)``."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        lookup = Lookup(voters.of_features)
        for rows, texts in _chunks(batches, 1):
            hits = voters.of_texts(texts, *lookup.of_texts(texts))
            yield pa.RecordBatch.from_arrays([rows.column(0), pa.array(hits, pa.list_(pa.int32()))], ["doc_id", "hits"])

    kind = dict(documents.dtypes)["doc_id"]
    return documents.select("doc_id", "text").mapInArrow(freeing(run), f"doc_id {kind}, hits array<int>")


class LabelModel:
    """Voters that fire or abstain, independently given the label but for the correlations
    found. ``silent`` has the shares of toxic and of clean documents on which none fires;
    these and the prior are given, since votes alone cannot tell them."""

    def __init__(self, prior: float, silent: tuple[float, float], toxic: np.ndarray, clean: np.ndarray):
        self.prior, self.silent, self.toxic, self.clean = prior, silent, toxic, clean
        self.share = np.ones(len(toxic))  # what is left of a voter's weight
        self.correlations: dict[tuple[int, int], float] = {}

    def judge(self):
        """A function from lists of hits to the probabilities of toxic given which voters
        fired; the others have abstained."""
        base = math.log(self.prior / (1 - self.prior))
        weights = np.log(self.toxic / self.clean) * self.share
        none = base + math.log(self.silent[0] / self.silent[1])

        def probabilities(hits: list[list[int]]) -> np.ndarray:
            sizes = np.fromiter(map(len, hits), np.int64, len(hits))
            flat = np.fromiter(chain.from_iterable(hits), np.int64, sizes.sum())
            total = base + np.bincount(np.repeat(np.arange(len(hits)), sizes), weights[flat], len(hits))
            return 1 / (1 + np.exp(-np.clip(np.where(sizes == 0, none, total), -500, 500)))

        return probabilities

    def fit(self, patterns: DataFrame, rounds: int = ROUNDS) -> LabelModel:
        """``patterns``: ``(hits, n)``, how many documents have exactly these votes."""
        for at in range(2 * rounds):
            if at == rounds:
                self._correlate(patterns)
            fired = {r.voter: (r.toxic, r["all"]) for r in self._fired(patterns).collect()}
            toxic, every = fired.pop(-1)
            before = np.concatenate([self.toxic, self.clean])
            for j in range(len(self.toxic)):
                t, n = fired.get(j, (0.0, 0))
                # A voter's prior opinion: it says toxic, on one document in a thousand.
                self.toxic[j] = min((t + 0.1) / (toxic + 10), 0.99)
                self.clean[j] = min((n - t + 0.001) / (every - toxic + 10), 0.99)
            moved = np.abs(np.concatenate([self.toxic, self.clean]) - before).max(initial=0)
            if moved < 1e-6 and at >= rounds:
                break
        return self

    def _fired(self, patterns: DataFrame) -> DataFrame:
        """``(voter, toxic, all)``: how many documents each voter fires on, toxic ones by
        their posteriors; all documents as voter -1."""
        judge, size = self.judge(), len(self.toxic)

        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            toxic, every = np.zeros(size + 1), np.zeros(size + 1, np.int64)
            for batch in batches:
                hits, n = batch.column(0).to_pylist(), batch.column(1).to_numpy()
                p = judge(hits) * n
                for own, one, number in zip(hits, p.tolist(), n.tolist(), strict=True):
                    own = [-1, *own]
                    toxic[own] += one
                    every[own] += number
            some = np.flatnonzero(every)
            yield pa.RecordBatch.from_arrays(
                [pa.array(np.where(some == size, -1, some), pa.int32()), pa.array(toxic[some]), pa.array(every[some])],
                ["voter", "toxic", "all"],
            )

        found = patterns.select("hits", "n").mapInArrow(run, "voter int, toxic double, all long")
        return found.groupBy("voter").agg(F.sum("toxic").alias("toxic"), F.sum("all").alias("all"))

    def _correlate(self, patterns: DataFrame) -> None:
        """Correlations within toxic documents; a voter's weight is shared with those that
        fire with it beyond chance."""
        judge, rates = self.judge(), self.toxic.copy()
        total = max(self._fired(patterns).where("voter = -1").first().toxic, 1.0)

        def pairs(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for batch in batches:
                hits, both = batch.column(0).to_pylist(), Counter()
                for own, p in zip(hits, (judge(hits) * batch.column(1).to_numpy()).tolist(), strict=True):
                    for pair in combinations(own, 2):
                        both[pair] += p
                yield pa.RecordBatch.from_arrays(
                    [
                        pa.array([i for i, _ in both], pa.int32()),
                        pa.array([j for _, j in both], pa.int32()),
                        pa.array(both.values(), pa.float64()),
                    ],
                    ["i", "j", "both"],
                )

        def correlated(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for batch in batches:
                i, j, both = (c.to_numpy() for c in batch.columns)
                a, b = rates[i], rates[j]
                spread = np.sqrt(a * (1 - a) * b * (1 - b))
                value = np.minimum((both / total - a * b) / np.where(spread > 0, spread, np.inf), 1.0)
                far = value > CORRELATED
                yield pa.RecordBatch.from_arrays([pa.array(c[far]) for c in (i, j, value)], ["i", "j", "value"])

        found = patterns.where("size(hits) > 1").select("hits", "n").mapInArrow(pairs, "i int, j int, both double")
        found = found.groupBy("i", "j").agg(F.sum("both").alias("both"))
        found = found.mapInArrow(correlated, "i int, j int, value double").collect()
        self.correlations = {(r.i, r.j): r.value for r in found}
        beside = np.zeros(len(self.toxic))
        for (i, j), value in self.correlations.items():
            beside[i] += value
            beside[j] += value
        self.share = 1 / (1 + beside)


def _hash(feature: str) -> int:
    return xxhash.xxh64_intdigest(feature) >> 1


def _with_voters(voters: Voters, of_features: Callable[[list[str]], list[int]]) -> Lookup:
    """What ``of_features`` says of a word, and its voters as negative numbers."""

    def both(features: list[str]) -> list[int]:
        fired, numbers = voters.of_features(features), of_features(features)
        return [*numbers, *(-1 - v for v in fired)] if fired else numbers

    return Lookup(both)


def _judged(
    batches: Iterator[pa.RecordBatch], voters: Voters, model: LabelModel, lookup: Lookup
) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray]]:
    """``(row, number, p)`` of the texts of ``batches``, some at a time: the numbers of each
    row's words that are no voters, in order, and all rows' posteriors."""
    judge = model.judge()
    for _, texts in _chunks(batches):
        yield _judge(texts, voters, judge, lookup)


def _judge(texts: list[str], voters: Voters, judge, lookup: Lookup) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    row, number = lookup.of_texts(texts)
    fired = number < 0
    return row[~fired], number[~fired], judge(voters.of_texts(texts, row[fired], -1 - number[fired]))


def _scores(z: np.ndarray) -> np.ndarray:
    return 1 / (1 + np.exp(-np.clip(z, -30.0, 30.0)))


def _may_tell(number, toxic, base: float, log):
    """Whether a feature of ``number`` documents, ``toxic`` of them by posteriors, may tell."""
    odds = (toxic + 0.1 * base) / (number - toxic + 0.1 * (1 - base)) * ((1 - base) / max(base, 1e-9))
    return (number >= 3) & (log(odds) > 1.5)


def _slopes(row, column, n, p, w, bias) -> tuple[np.ndarray, float, float]:
    """Derivatives of the loss to ``w`` and ``bias``, and the loss, over sets of features
    that ``n`` documents have each, of which ``p`` are toxic."""
    z = bias + np.bincount(row, w[column], len(p))
    error = n / (1 + np.exp(-np.clip(z, -500, 500))) - p
    loss = (n * np.logaddexp(0, z) - p * z).sum()
    return np.bincount(column, error[row], len(w)), float(error.sum()), float(loss)


def _added(rows: pa.Table) -> pa.Table:
    values = rows.column("values").combine_chunks()
    total = values.flatten().to_numpy().reshape(len(values), -1).sum(axis=0)
    return pa.table({"block": rows.column("block").slice(0, 1), "values": pa.array([total])})


class Classifier:
    """Logistic regression on which features a text has. Weights are not negative: more
    clean words do not make up for a toxic one, so long texts need no other treatment."""

    def __init__(self, bias: float, weights: dict[int, float]):
        self.bias, self.weights = bias, weights

    @classmethod
    def fit(cls, features: np.ndarray, offsets: np.ndarray, p: np.ndarray, steps: int = STEPS) -> Classifier:
        """From documents at hand: their features, where each one's begin, posteriors."""
        if not len(p):
            return cls(math.log(0.05 / 0.95), {})
        row = np.repeat(np.arange(len(p)), np.diff(offsets))
        names, column = np.unique(features, return_inverse=True)
        base = p.sum() / len(p)
        good = _may_tell(np.bincount(column, minlength=len(names)), np.bincount(column, p[row], len(names)), base, np.log)
        keep = good[column]
        row, column = row[keep], (np.cumsum(good) - 1)[column[keep]]
        own = np.bincount(row, minlength=len(p)) + 1
        curve = np.bincount(column, own[row], good.sum()) / 4
        return cls._descend(names[good], base, curve, own.sum() / 4, lambda w, b: _slopes(row, column, 1, p, w, b), steps)

    @classmethod
    def _descend(cls, names, base: float, curve, bias_curve: float, slopes, steps: int, whole: bool = False) -> Classifier:
        """Only features of some weight are kept, or with ``whole`` all, in order. Accelerated descent with a small ridge, weights projected to zero or more. The
        steps' sizes follow from bounds of the loss's second derivatives."""
        w, bias = np.zeros(len(names)), math.log(max(base, 1e-3) / max(1 - base, 1e-3))
        curve = curve + 0.05
        at_w, at_bias, pace = w, bias, 1.0
        for _ in range(steps):
            grad, bias_grad, _ = slopes(at_w, at_bias)
            grad = grad + 0.05 * at_w
            new = np.maximum(at_w - grad / curve, 0)
            new_bias = at_bias - bias_grad / bias_curve
            if ((at_w - new) * curve) @ (new - w) + (at_bias - new_bias) * bias_curve * (new_bias - bias) > 0:
                pace = 1.0
            after = (1 + math.sqrt(1 + 4 * pace * pace)) / 2
            at_w = new + (pace - 1) / after * (new - w)
            at_bias = new_bias + (pace - 1) / after * (new_bias - bias)
            moved = max(np.abs(new - w).max(initial=0), abs(new_bias - bias))
            w, bias, pace = new, new_bias, after
            if moved < 1e-3:
                break
        w = np.where(w > 1e-3, w, 0.0)
        used = np.ones(len(w), bool) if whole else w > 0
        return cls(float(bias), dict(zip(names[used].tolist(), w[used].tolist(), strict=True)))

    @classmethod
    def fit_all(
        cls, documents: DataFrame, voters: Voters, model: LabelModel, steps: int = STEPS
    ) -> tuple[Classifier, DataFrame | None]:
        """From all ``documents`` ``(text, learned, ...)`` that are to be learned from, and their
        posteriors. Also gives, of all documents, the other columns and ``weighed``, the places
        of their features among the classifier's ``names``; none if there is nothing to learn."""

        def counts(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            places: dict[str, int] = {}
            lookup = _with_voters(voters, lambda features: [places.setdefault(f, len(places)) for f in features])
            number, toxic = np.zeros(0, np.int64), np.zeros(0)

            def rows(names, number, toxic) -> pa.RecordBatch:
                columns = [pa.array(names, pa.int64()), pa.array(number, pa.int64()), pa.array(toxic, pa.float64())]
                return pa.RecordBatch.from_arrays(columns, ["feature", "number", "toxic"])

            for row, place, p in _judged(batches, voters, model, lookup):
                number, toxic = (np.pad(x, (0, len(places) - len(x))) for x in (number, toxic))
                np.add.at(number, place, 1)
                np.add.at(toxic, place, p[row])
                yield rows([-1], [len(p)], [p.sum()])
                if len(places) > KEPT_FEATURES:
                    yield rows(list(map(_hash, places)), number, toxic)
                    places.clear(), lookup.clear()
                    number, toxic = np.zeros(0, np.int64), np.zeros(0)
            yield rows(list(map(_hash, places)), number, toxic)

        learned = documents.where("learned").select("text")
        found = learned.mapInArrow(freeing(counts), "feature long, number long, toxic double")
        found = found.groupBy("feature").agg(F.sum("number").alias("number"), F.sum("toxic").alias("toxic"))
        found = stored(found, "features")
        every = found.where("feature = -1").first()
        if every is None:
            return cls(math.log(0.05 / 0.95), {}), None
        base = every.toxic / every.number
        good = found.where((F.col("feature") >= 0) & _may_tell(F.col("number"), F.col("toxic"), base, F.log))
        names = np.sort(good.select("feature").toArrow().column(0).to_numpy())
        numbers = {name: i for i, name in enumerate(names.tolist())}

        def of_features(features: list[str]) -> list[int]:
            return [numbers[h] for h in map(_hash, features) if h in numbers]

        carried = [field for field in documents.schema if field.name != "text"]

        def sets(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            lookup, judge = _with_voters(voters, of_features), model.judge()
            for rows, texts in _chunks(batches):
                row, feature, p = _judge(texts, voters, judge, lookup)
                offsets = np.searchsorted(row, np.arange(len(p) + 1))
                lists = pa.ListArray.from_arrays(pa.array(offsets, pa.int32()), pa.array(feature, pa.int32()))
                yield pa.RecordBatch.from_arrays([*rows.columns[1:], lists, pa.array(p)], [*(c.name for c in carried), "weighed", "p"])

        schema = StructType([*carried, StructField("weighed", ArrayType(IntegerType())), StructField("p", DoubleType())])
        weighed = stored(documents.select("text", *(c.name for c in carried)).mapInArrow(freeing(sets), schema), "weighed")
        found = weighed.where("learned").groupBy(F.col("weighed").alias("features"))
        found = stored(found.agg(F.count("*").alias("n"), F.sum("p").alias("p")), "feature-sets")
        # Each step is a job over these; a task has so many that its work outweighs its start.
        held = found.agg(F.sum(F.size("features") + 1)).first()[0] or 0
        found = found.coalesce(1 + held // TASK_FEATURES)
        size = len(names)

        def summed(of) -> tuple[np.ndarray, float, float]:
            """Sums over all sets of what ``of`` says, a number per feature and two more."""

            def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
                total = np.zeros(size + 2)
                for batch in batches:
                    lists = batch.column(0)
                    row = np.repeat(np.arange(len(lists)), np.diff(lists.offsets.to_numpy()))
                    total += np.append(*of(row, lists.flatten().to_numpy(), *(c.to_numpy() for c in batch.columns[1:])))
                blocks = [total[at : at + BLOCK] for at in range(0, len(total), BLOCK)]
                yield pa.RecordBatch.from_arrays([pa.array(range(len(blocks)), pa.int64()), pa.array(blocks)], ["block", "values"])

            # A task sends its sums in blocks, of which Spark adds up those of all tasks.
            parts = found.mapInArrow(run, "block long, values array<double>").repartition(1 + size // 1_000_000, "block")
            whole = parts.groupBy("block").applyInArrow(_added, "block long, values array<double>").toArrow().sort_by("block")
            total = whole.column("values").combine_chunks().flatten().to_numpy()
            return total[:size], float(total[size]), float(total[size + 1])

        def curves(row, column, n, p):
            own = n * (np.bincount(row, minlength=len(n)) + 1)
            return np.bincount(column, own[row], size) / 4, (own.sum() / 4, 0.0)

        def slopes(w, bias):
            def of(row, column, n, p):
                grad, bias_grad, loss = _slopes(row, column, n, p, w, bias)
                return grad, (bias_grad, loss)

            return summed(of)

        curve, bias_curve, _ = summed(curves)
        return cls._descend(names, base, curve, bias_curve, slopes, steps, whole=True), weighed

    def score_weighed(self, weighed: DataFrame, name: str) -> DataFrame:
        """What :meth:`fit_all` gave of the documents, with their scores as ``name`` in place of
        ``weighed``, ``learned`` and ``p``."""
        bias, weights = self.bias, np.fromiter(self.weights.values(), float, len(self.weights))
        kept = [field for field in weighed.schema if field.name not in ("weighed", "learned", "p")]
        names = [*(field.name for field in kept), name]

        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for batch in batches:
                lists = batch.column(0)
                row = np.repeat(np.arange(len(lists)), np.diff(lists.offsets.to_numpy()))
                scores = _scores(bias + np.bincount(row, weights[lists.flatten().to_numpy()], len(lists)))
                yield pa.RecordBatch.from_arrays([*batch.columns[1:], pa.array(scores, pa.float64())], names)

        schema = StructType([*kept, StructField(name, DoubleType())])
        return weighed.select("weighed", *names[:-1]).mapInArrow(run, schema)

    def score(self, documents: DataFrame, name: str) -> DataFrame:
        """``documents`` with their scores as ``name``, from their column ``text``; nothing is
        moved. ``name`` has to be free."""
        used = {feature: weight for feature, weight in self.weights.items() if weight}
        bias, place = self.bias, {feature: i for i, feature in enumerate(used)}
        weights = np.fromiter(used.values(), float, len(place))
        text = documents.columns.index("text")

        def of_features(features: list[str]) -> list[int]:
            return [place[h] for h in map(_hash, features) if h in place]

        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            lookup = Lookup(of_features)
            for rows, texts in _chunks(batches, text):
                row, feature = lookup.of_texts(texts)
                scores = _scores(bias + np.bincount(row, weights[feature], len(texts)))
                yield pa.RecordBatch.from_arrays([*rows.columns, pa.array(scores, pa.float64())], names)

        names = [*documents.columns, name]
        return documents.mapInArrow(freeing(run), StructType([*documents.schema.fields, StructField(name, DoubleType())]))


def train(documents: DataFrame, labels: DataFrame, weigh_all: bool = False) -> tuple[Classifier, DataFrame | None]:
    """``documents``: ``(doc_id, text)``; ``labels``: ``(doc_id, toxic)``, of which those of
    held-out ids and null ones are not used. Of several labels of an id the highest counts.
    With ``weigh_all`` also what :meth:`Classifier.fit_all` gives of all documents."""
    known = (
        labels.where(F.col("toxic").isNotNull() & F.col("doc_id").isNotNull() & ~held_out(F.col("doc_id")))
        .groupBy("doc_id")
        .agg(F.max((F.col("toxic") != 0).cast("int")).alias("toxic"))
    )
    known = stored(known, "labelled")
    number = {r.toxic: r["count"] for r in documents.select("doc_id").join(known, "doc_id").groupBy("toxic").count().collect()}
    toxic, clean = number.get(1, 0), number.get(0, 0)
    documents = documents.withColumn("learned", ~held_out(F.col("doc_id")))
    learned = documents.where("learned")
    voters = Voters(mined_voters(learned.join(known, "doc_id").select("text", "toxic"), toxic, clean))

    voted = stored(votes(documents, voters), "votes")
    patterns = stored(voted.groupBy("hits").agg(F.count("*").alias("n")), "vote-patterns")
    labelled = stored(voted.join(known, "doc_id").groupBy("hits", "toxic").count(), "labelled-votes")
    rows = labelled.select("toxic", "count", F.explode("hits").alias("voter"))
    fired = np.zeros((2, voters.size))
    for r in rows.groupBy("voter", "toxic").agg(F.sum("count").alias("n")).collect():
        fired[r.toxic, r.voter] = r.n
    spoke = {
        r.toxic: r.n for r in labelled.where("size(hits) > 0").groupBy("toxic").agg(F.sum("count").alias("n")).collect()
    }
    quiet = [(n - spoke.get(k, 0) + 1) / (n + 2) for k, n in ((1, toxic), (0, clean))]
    model = LabelModel(
        min(max(toxic / max(toxic + clean, 1), 1e-4), 0.5),
        (quiet[0], quiet[1]),
        np.minimum((fired[1] + 0.1) / (toxic + 10), 0.99),
        np.minimum((fired[0] + 0.001) / (clean + 10), 0.99),
    )
    if not patterns.isEmpty():
        model.fit(patterns)
    return Classifier.fit_all(documents if weigh_all else learned, voters, model)


def toxicity(documents: DataFrame, labels: DataFrame) -> DataFrame:
    """``(doc_id, score)`` of each of the ``documents``.

    Needs ``doc_id`` and ``text`` of the documents, ``doc_id`` and ``toxic`` of the labels;
    other columns are not read. Null and empty texts get the score of a text without
    features. Repeated rows and null ids are scored as any other; a null id has no label.
    Without any toxic or any clean label the voters are the fixed ones. An empty table gives
    an empty result.
    """
    rows = documents.select("doc_id", "text")
    classifier, weighed = train(rows, labels.select("doc_id", "toxic"), weigh_all=True)
    scored = classifier.score(rows, "score") if weighed is None else classifier.score_weighed(weighed, "score")
    return scored.select("doc_id", "score")


def clean_documents(documents: DataFrame, labels: DataFrame, threshold: float = THRESHOLD) -> DataFrame:
    """The ``documents`` that score below ``threshold``, all their columns. They are read
    several times, in any order."""
    classifier, _ = train(documents.select("doc_id", "text"), labels.select("doc_id", "toxic"))
    score = free_name(documents, "score")
    return classifier.score(documents, score).where(F.col(score) < threshold).drop(score)


def op3_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    documents = table(spark, sf_dir, "documents", "doc_id", "text")
    scored = toxicity(documents, table(spark, sf_dir, "labels", "doc_id", "toxic"))
    return scored.select(
        "doc_id",
        held_out(F.col("doc_id")).alias("held_out"),
        "score",
        (F.col("score") >= THRESHOLD).cast("int").alias("predicted"),
    )
