"""Quality classifier from weak labels.

Overlapping heuristic labellers vote on every document, or abstain: on bad quality by style,
on toxicity by word lists, on both by given labels. The votes of all documents are counted by
pattern, and expectation-maximisation over the patterns estimates each labeller's accuracy
per class and the posterior of each pattern. Posterior labels of a bounded sample train a
hashed linear scorer (logistic loss, L1 penalty), which then scores every document.

Bounds: the word lists are fitted on the ``labelled`` labelled rows with the smallest hashes of
their ids. The scorer learns from these, from ``others`` rows of the whole table and from
``per_pattern`` rows of every pattern of votes that occurs, a rarer pattern in full, so that a
kind of junk that any labeller knows is learnt however rare it is (parameters of :func:`fit`).
Votes, their counts and the scores cover all documents.

Rows
----
Null and empty texts get no votes, score as the scorer's bias says, and are kept. A null id has
no label. Of repeated labels the larger counts. Without labels the fixed heuristics vote
alone; where nothing was voted bad, nothing is rejected. Extra columns stay in :func:`keep` and
are left out elsewhere. Empty tables give empty results.
"""

from __future__ import annotations

import math
import re
from collections.abc import Iterable, Iterator
from dataclasses import dataclass
from functools import cached_property
from operator import eq

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from ..session import small_batches
from .common import WordCache, slices, stored, strings, text_columns
from .jaccard_join import shingles
from .word_tokens import forget

ABSTAIN, GOOD, BAD = 0, 1, 2
TASKS = ("low", "toxic")

# Insults in common use.
INSULTS = frozenset(
    "idiot moron stupid loser pathetic worthless disgusting scum trash clown imbecile dumbass "
    "dimwit halfwit lowlife filth vermin degenerate".split()
)

_WORD = re.compile(r"\w+")
# Marks at the end of a word, and words of marks alone. What stands before is looked at from the
# first mark, as a search for marks passes over letters quickly.
_MARKED = re.compile(r"[^\w\s](?<=\w.)[^\w\s]+(?=\s|$)", re.DOTALL)
_BARE = re.compile(r"[^\w\s](?<!\S.)[^\w\s]*(?!\S)", re.DOTALL)
THRESHOLDS = (0.0, 0.01, 0.02, 0.05, 0.1, 0.2, 0.5)

# What is known of labellers beforehand counts as so many documents, whatever the corpus.
PRIOR_VOTES = 1000.0

# Hits by chance: one is assumed in so many words beside those of the labelled clean texts, and
# a text must exceed the mean of its length by so many standard deviations.
UNSEEN_WORDS = 100_000
DEVIATIONS = 4.0

# Words a scoring task remembers per generation, of two.
SCORED_WORDS = 150_000

VOTES = "doc_id bigint, low int, toxic int"
FEATURES = "doc_id bigint, low int, toxic int, features array<int>, size bigint"
SCORES = "doc_id bigint, p_low double, p_toxic double"


def style(text: str) -> dict[str, float]:
    """Shares that tell prose from junk."""
    words = text.split()
    n = max(len(words), 1)
    raw = np.frombuffer(text.encode(), np.uint8)
    upper = int(((raw >= 65) & (raw <= 90)).sum())
    lower = int(((raw >= 97) & (raw <= 122)).sum())
    # Only words that end in a mark can be marked or bare.
    ends = " ".join([w for w in words if not w[-1].isalnum()])
    alike = bytes(map(eq, words, words[1:]))
    pairs = alike.count(1)
    in_runs = sum(len(run) + 1 for run in alike.split(b"\0") if len(run) > 1) if pairs else 0
    return {
        "marked": len(_MARKED.findall(ends)) / n,
        "bare": len(_BARE.findall(ends)) / n,
        "caps": upper / max(upper + lower, 1),
        "runs": in_runs / n,
        "pairs": pairs / n if n >= 10 else 0.0,
        "repeated": 1 - len(set(words)) / n if n >= 50 else 0.0,
    }


def low_votes(shares: dict[str, float]) -> list[int]:
    """One labeller per kind of junk; each knows its own kind only, so it never votes good."""
    limits = {"marked": 0.05, "bare": 0.05, "caps": 0.4, "runs": 0.05, "pairs": 0.3, "repeated": 0.7}
    return [BAD if shares[k] >= limit else ABSTAIN for k, limit in limits.items()]


def feature_hash(name: str) -> int:
    return xxhash.xxh3_64_intdigest(name) & 0x7FFFFFFF


def stems(word: str) -> list[str]:
    """The first four to seven letters of a longer word."""
    return [word[:size] for size in range(4, min(8, len(word)))]


def word_features(word: str) -> tuple[int, ...]:
    """A word and its stems."""
    names = [word, *[word[:size] + "*" for size in range(4, min(8, len(word)))]]
    return tuple([xxhash.xxh3_64_intdigest(name) & 0x7FFFFFFF for name in names])


STYLE_NAMES = [f"{k} > {limit}" for k in ("marked", "bare", "caps", "runs", "pairs", "repeated") for limit in THRESHOLDS]


def style_features(shares: dict[str, float]) -> list[int]:
    return [feature_hash(f"{k} > {limit}") for k, share in shares.items() for limit in THRESHOLDS if share > limit]


def words_of(text: str) -> tuple[set[str], int]:
    """The distinct words of a text, and how many words it has in all."""
    words = _WORD.findall(text.lower())
    return set(words), len(words)


@dataclass(frozen=True)
class Lists:
    """Words and stems that mark toxic texts, and how many hits a word of a clean text gives by chance.

    `chance` is for the insults, the words and the stems.
    """

    words: frozenset[str] = frozenset()
    stems: frozenset[str] = frozenset()
    chance: tuple[float, float, float] = (1 / UNSEEN_WORDS,) * 3

    @cached_property
    def starts(self) -> frozenset[str]:
        """How words with a marked stem begin."""
        return frozenset(stem[:4] for stem in self.stems)


def by_chance(mean: float, variance: float) -> float:
    """What chance alone seldom exceeds."""
    return mean + DEVIATIONS * math.sqrt(variance)


def toxic_votes(words: set[str], size: int, lists: Lists) -> list[int]:
    """By the fixed list, and by the words and the stems that mark labelled texts.

    A text of `size` words is toxic where it has more hits than chance gives to a clean one of
    that size. One marked word may be chance in any text, so the latter two take two at least.
    """
    by_list = len(words & INSULTS)
    by_word = len(words & lists.words)
    starts = lists.starts
    by_stem = sum(not lists.stems.isdisjoint(stems(w)) for w in words if w[:4] in starts) if starts else 0
    usual = [by_chance(size * rate, size * rate) for rate in lists.chance]

    def vote(hits: int, usual: float) -> int:
        return BAD if hits > max(1, usual) else ABSTAIN if hits else GOOD

    return [
        BAD if by_list > usual[0] else ABSTAIN,
        vote(by_word, usual[1]) if lists.words else ABSTAIN,
        vote(by_stem, usual[2]) if lists.stems else ABSTAIN,
    ]


def packed(votes: list[int]) -> int:
    """A pattern of votes as one number, three values per labeller."""
    return sum(v * 3**k for k, v in enumerate(votes))


def unpacked(pattern: int, labellers: int) -> list[int]:
    return [pattern // 3**k % 3 for k in range(labellers)]


def estimate(
    counts: dict[int, int], labellers: int, rounds: int = 100, prior_votes: float = PRIOR_VOTES
) -> tuple[dict[int, float], np.ndarray]:
    """Posterior of "bad" per pattern, and each labeller's vote shares per class (good, bad).

    The start takes given labels, or else any vote for "bad", as likely right. Prior votes say what labellers are
    for: they seldom call a good document bad, each finds some of the bad ones, and the last,
    the given labels, is seldom wrong. Without them a large kind of junk would be taken for the
    class, and the labeller of another kind for a bad one.

    There are `prior_votes` of them for good documents and up to a quarter of that for bad ones,
    however large the corpus. Labelled documents count in full, so that they correct any
    labeller. Others together weigh at most a quarter of the prior votes and the labelled
    documents, or they would outvote both in a large corpus; each pattern keeps its share.
    """
    patterns = np.array([unpacked(p, labellers) for p in counts], int).reshape(-1, labellers)
    weights = np.array(list(counts.values()), float)
    bad = np.where((patterns == BAD).any(axis=1), 0.9, 0.1)
    shares = np.full((labellers, 2, 3), 1 / 3)
    if not (patterns == BAD).any():
        return dict.fromkeys(counts, 0.0), shares
    gold = patterns[:, -1] != ABSTAIN
    bad[gold] = np.where(patterns[gold, -1] == BAD, 0.9, 0.1)
    most = (prior_votes + weights[gold].sum()) / 4
    weights = np.where(gold, weights, weights * min(1.0, most / max(weights[~gold].sum(), 1)))
    one_sided = ~(patterns == GOOD).any(axis=0)[:, None, None]
    prior = np.where(one_sided, [[1.0, 0.0, 0.0], [0.7, 0.0, 0.3]], [[0.5, 0.5, 0.0], [0.4, 0.1, 0.5]])
    prior[-1] = [[0.7, 0.3, 0.0], [0.7, 0.0, 0.3]]
    for _ in range(rounds):
        sizes = np.array([weights @ (1 - bad), weights @ bad])
        for k in range(labellers):
            strength = np.array([prior_votes, min(prior_votes / 4, sizes[1])])
            for vote in (ABSTAIN, GOOD, BAD):
                cast = weights * (patterns[:, k] == vote)
                seen = np.array([cast @ (1 - bad), cast @ bad])
                shares[k, :, vote] = (seen + strength * prior[k, :, vote] + 1) / (sizes + strength + 3)
        likely = np.log((sizes + 1) / (weights.sum() + 2))
        logs = likely[:, None] + sum(np.log(shares[k][:, patterns[:, k]]) for k in range(labellers))
        new = 1 / (1 + np.exp(np.clip(logs[0] - logs[1], -500, 500)))
        if np.abs(new - bad).max(initial=0) < 1e-9:
            break
        bad = new
    return dict(zip(counts, bad.tolist(), strict=True)), shares


def train(
    features: np.ndarray, lengths: np.ndarray, targets: np.ndarray, penalty: float = 1e-3, rounds: int = 1000, seen: int = 4
) -> tuple[dict[int, float], float]:
    """Weights of hashed features, and the bias, of an L1-penalised logistic model with soft targets.

    `features` holds those of all rows behind one another, `lengths` how many each row has.
    Weights are not negative: a trait can only speak for "bad", so that traits of a long text
    don't outvote it. Features whose gradient at the start is below the penalty stay out.
    """
    n = len(lengths)
    if not n or targets.max(initial=0) < 0.5:
        return {}, -10.0
    # Classes weigh the same, so that a rare class is not outvoted.
    bad = np.clip(targets.mean(), 1e-3, 1 - 1e-3)
    weights = (targets / bad + (1 - targets) / (1 - bad)) / (2 * n)
    ideal = targets / bad / (2 * n) / weights  # the soft target under these weights
    # Features seen a few times, found without an inverse of all of them, which is several times as large.
    names, counts = np.unique(features, return_counts=True)
    names = names[counts >= seen]
    columns = np.searchsorted(names, features).astype(np.int32)
    known = columns < len(names)
    known[known] = names[columns[known]] == features[known]
    of, columns = np.repeat(np.arange(n, dtype=np.int32), lengths)[known], columns[known]
    pull = np.bincount(columns, weights=(weights * (ideal - 0.5))[of], minlength=len(names))
    usable = (pull > penalty)[columns]
    of, columns = of[usable], columns[usable]
    used, columns = np.unique(columns, return_inverse=True)
    names = names[used]
    theta, bias = np.zeros(len(names)), 0.0
    ahead, ahead_bias, momentum = theta.copy(), bias, 1.0
    # A step per feature from the curvature bound of its column and the features of its rows.
    width = np.bincount(of, minlength=n) + 1.0
    curvature = np.bincount(columns, weights=(weights * width)[of], minlength=len(names)) * 0.25
    step, bias_step = 1 / np.maximum(curvature, 1e-9), 4 / (weights @ width)
    for _ in range(rounds):
        margins = np.bincount(of, weights=ahead[columns], minlength=n) + ahead_bias
        residual = weights * (1 / (1 + np.exp(-np.clip(margins, -30, 30))) - ideal)
        gradient = np.bincount(columns, weights=residual[of], minlength=len(names))
        new = np.maximum(ahead - step * (gradient + penalty), 0)
        new_bias = ahead_bias - bias_step * residual.sum()
        faster = (1 + np.sqrt(1 + 4 * momentum**2)) / 2
        if (ahead - new) @ (new - theta) + (ahead_bias - new_bias) * (new_bias - bias) > 0:
            momentum = faster = 1.0  # momentum leads uphill; start it anew
        ahead = new + (momentum - 1) / faster * (new - theta)
        ahead_bias = new_bias + (momentum - 1) / faster * (new_bias - bias)
        settled = max(np.abs(new - theta).max(initial=0), abs(new_bias - bias)) < 1e-6
        theta, bias, momentum = new, new_bias, faster
        if settled:
            break
    kept = np.flatnonzero(theta)
    return dict(zip(names[kept].tolist(), theta[kept].tolist(), strict=True)), float(bias)


@dataclass
class Classifier:
    """A fitted scorer: weights per hashed feature (low, toxic), biases, and what EM found."""

    weights: dict[int, tuple[float, float]]
    biases: tuple[float, float]
    shares: dict[str, np.ndarray]
    limit: float = 0.5
    usual_words: float = 0.0
    chance: tuple[tuple[float, float], tuple[float, float]] = ((0.0, 0.0), (0.0, 0.0))

    def allowance(self, task: int, size: int) -> float:
        """The weight that a clean text of `size` words has by chance beyond that of a usual text."""
        more = max(size - self.usual_words, 0.0)
        mean, variance = self.chance[task]
        return by_chance(more * mean, more * variance)

    def scores(self, texts: list[str], cache: WordCache) -> np.ndarray:
        """Probabilities (low, toxic) per text; words count as far as they exceed the allowance."""
        found = [words_of(t) for t in texts]
        lists = [words for words, _ in found]
        known = cache.lookup(lists)
        out = np.empty((len(texts), 2))
        for k, (text, words) in enumerate(zip(texts, lists, strict=True)):
            low = toxic = 0.0
            for hit in filter(None, map(known.__getitem__, words)):
                low, toxic = low + hit[0], toxic + hit[1]
            low, toxic = (max(v - self.allowance(task, found[k][1]), 0.0) for task, v in enumerate((low, toxic)))
            for feature in style_features(style(text)) if text else ():
                hit = self.weights.get(feature)
                if hit:
                    low, toxic = low + hit[0], toxic + hit[1]
            out[k] = low + self.biases[0], toxic + self.biases[1]
        return 1 / (1 + np.exp(-np.clip(out, -30, 30)))

    def word_weights(self, words: list[str]) -> list[tuple[float, float] | None]:
        out, weights = [], self.weights
        for word in words:
            hits = [hit for f in word_features(word) if (hit := weights.get(f))]
            out.append((sum(h[0] for h in hits), sum(h[1] for h in hits)) if hits else None)
        return out


def _sample(docs: DataFrame, ids: DataFrame, rows: int) -> DataFrame:
    """The documents among `ids` with the `rows` smallest hashes, texts included.

    Near copies mostly share the smallest hash of their word triples; one of them counts, or a
    group of copies would pass for many witnesses.
    """
    return _texts(docs, _first(ids, rows))


def _first(ids: DataFrame, rows: int) -> DataFrame:
    return ids.distinct().orderBy(F.xxhash64("doc_id"), "doc_id").limit(rows)


def _of_patterns(votes: DataFrame, counted: list, most: int) -> DataFrame:
    """Ids of `most` documents of every pattern of votes, all of a rarer one.

    Of frequent patterns a share by the hash of the id, about twice what is wanted, is ranked.
    """
    share = [min(1.0, 2 * (most + 10) / r["count"]) for r in counted]
    columns = [pa.array([r[task] for r in counted], pa.int32()) for task in TASKS]
    # From Arrow, as rows of Python would start Python workers of their own kind on every executor.
    wanted = votes.sparkSession.createDataFrame(pa.table([*columns, pa.array(share, pa.float64())], [*TASKS, "share"]))
    key = F.xxhash64("doc_id")
    near = F.pmod(key, F.lit(1 << 30)) < F.col("share") * (1 << 30)
    some = votes.where("doc_id is not null").join(F.broadcast(wanted), ["low", "toxic"]).where(near)
    rank = F.row_number().over(Window.partitionBy("low", "toxic").orderBy(key, "doc_id"))
    return some.withColumn("rank", rank).where(F.col("rank") <= most).select("doc_id")


def _texts(docs: DataFrame, chosen: DataFrame) -> DataFrame:
    """The texts of a bounded number of documents, one of each group of near copies."""

    def sketched(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        forget()
        for batch in slices(batches, "text"):
            found = [shingles(text, 3)[:1] for text in strings(batch, "text")]
            least = [int(f[0].astype(np.int64)) if len(f) else 0 for f in found]
            yield batch.append_column("sketch", pa.array(least, pa.int64()))

    texts = docs.join(F.broadcast(chosen), "doc_id").mapInArrow(sketched, "doc_id bigint, text string, sketch bigint")
    # Stored, as texts go on to another function: a task that runs two has two Python workers, which stay.
    texts = stored(texts, "weak-texts")
    first = texts.groupBy("sketch").agg(F.min("doc_id").alias("doc_id"))
    return texts.join(F.broadcast(first), ["sketch", "doc_id"]).select("doc_id", "text")


def _lists(sample: DataFrame, least: float = 0.01, odds: float = 50.0) -> Lists:
    """Words and stems that mark toxic texts: in a share `least` of them, `odds` times as often as elsewhere."""

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches, "text"):
            for text, toxic in zip(strings(batch, "text"), batch.column("gold_toxic").to_pylist(), strict=True):
                words, size = words_of(text)
                names = ["", *words, *{f"{stem}*" for w in words for stem in stems(w)}]
                times = [size, *[1] * (len(names) - 1)]  # without a name: all words
                yield pa.RecordBatch.from_arrays(
                    [pa.array(names, pa.string()), pa.array([int(toxic == 1)] * len(names), pa.int64()), pa.array(times, pa.int64())],
                    ["name", "toxic", "times"],
                )

    sizes = sample.agg(F.sum((F.col("gold_toxic") == 1).cast("int")), F.count("gold_toxic")).first()
    toxic, clean = sizes[0] or 0, (sizes[1] or 0) - (sizes[0] or 0)
    if not toxic or not clean:
        return Lists()
    counted = sample.mapInArrow(run, "name string, toxic bigint, times bigint").groupBy("name").agg(
        F.sum(F.col("toxic") * F.col("times")).alias("in_toxic"), F.sum((1 - F.col("toxic")) * F.col("times")).alias("in_clean")
    )
    rate = (F.col("in_toxic") / toxic) / ((F.col("in_clean") + 0.5) / (clean + 1))
    marks = (F.col("name") != "") & (F.col("in_toxic") >= max(3, least * toxic)) & (rate >= odds)
    fixed = F.col("name").isin("", *INSULTS)
    rows = counted.withColumn("marks", marks).where(marks | fixed).collect()
    in_clean = {r.name: r.in_clean for r in rows}
    names = [r.name for r in rows if r.marks]
    words, found = [n for n in names if n[-1] != "*"], [n for n in names if n[-1] == "*"]

    def chance(names: Iterable[str], unseen: float) -> float:
        """Those chosen because they are rare in clean texts are less rare in others."""
        return (1 + sum(in_clean.get(n, 0) + unseen for n in names)) / (UNSEEN_WORDS + in_clean[""])

    rates = (chance(INSULTS, 0), chance(words, 0.5), chance(found, 0.5))
    return Lists(frozenset(words), frozenset(n[:-1] for n in found), rates)


def _voted(docs: DataFrame, lists: Lists, features: bool) -> DataFrame:
    """Vote patterns without given labels, and on demand the features, per document."""

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        forget()
        for batch in slices(batches, "text"):
            low, toxic, found, sizes = [], [], [], []
            for text in strings(batch, "text"):
                shares, (words, size) = style(text), words_of(text)
                low.append(packed(low_votes(shares)) if text else 0)
                toxic.append(packed(toxic_votes(words, size, lists)) if text else 0)
                if features:
                    own = [f for w in words for f in word_features(w)]
                    found.append([*own, *style_features(shares)] if text else [])
                    sizes.append(size)
            columns = [batch.column("doc_id"), pa.array(low, pa.int32()), pa.array(toxic, pa.int32())]
            names = ["doc_id", "low", "toxic"]
            if features:
                columns += [pa.array(found, pa.list_(pa.int32())), pa.array(sizes, pa.int64())]
                names += ["features", "size"]
            yield pa.RecordBatch.from_arrays(columns, names)

    return docs.select("doc_id", "text").mapInArrow(run, FEATURES if features else VOTES)


LOW_LABELLERS, TOXIC_LABELLERS = 7, 4  # the given labels are the last of each


def _with_labels(votes: DataFrame, labels: DataFrame) -> DataFrame:
    """Add the given labels as one more labeller of each task."""
    low = F.when(F.col("gold_low") == 1, BAD).when(F.col("gold_low") == 0, GOOD).otherwise(ABSTAIN)
    toxic = F.when(F.col("gold_toxic") == 1, BAD).when(F.col("gold_toxic") == 0, GOOD).otherwise(ABSTAIN)
    kept = [c for c in votes.columns if c not in TASKS]
    return votes.join(labels, "doc_id", "left").select(
        *kept,
        (F.col("low") + low * 3 ** (LOW_LABELLERS - 1)).alias("low"),
        (F.col("toxic") + toxic * 3 ** (TOXIC_LABELLERS - 1)).alias("toxic"),
    )


def _chance(
    features: np.ndarray, lengths: np.ndarray, sizes: np.ndarray, clean: np.ndarray, weights: dict[int, float]
) -> tuple[float, float]:
    """Mean and variance of the weight that one more word gives to a clean text.

    Every weighted feature counts half a time more than it was seen, as training shuns those seen.
    """
    ends = np.cumsum(lengths)
    styles = set(map(feature_hash, STYLE_NAMES))
    of_rows, half, half_squared = np.zeros(len(lengths)), 0.0, 0.0
    for feature, weight in weights.items():
        if feature not in styles:
            hits = np.searchsorted(ends, np.flatnonzero(features == feature), side="right")
            np.add.at(of_rows, hits, weight)
            half, half_squared = half + weight / 2, half_squared + weight**2 / 2
    words = sizes[clean].sum() + UNSEEN_WORDS
    return float((of_rows[clean].sum() + half) / words), float(((of_rows[clean] ** 2).sum() + half_squared) / words)


def fit(
    docs: DataFrame,
    labels: DataFrame,
    labelled: int = 6000,
    others: int = 2000,
    per_pattern: int = 20,
    id_col: str = "doc_id",
    text_col: str = "text",
    prior_votes: float = PRIOR_VOTES,
) -> Classifier:
    """Fit on `docs`; `labels` has ``doc_id, quality`` (0 is low) and ``toxic`` (0 or 1).

    `prior_votes` is the weight of what is known of labellers beforehand, see :func:`estimate`.
    """
    small_batches(docs.sparkSession)
    rows = text_columns(docs, id_col, text_col)
    given = labels.where("doc_id is not null").groupBy(F.col("doc_id").cast("bigint").alias("doc_id")).agg(
        F.max(1 - F.col("quality")).cast("int").alias("gold_low"), F.max("toxic").cast("int").alias("gold_toxic")
    )
    given = stored(given, "weak-given")
    sample = _sample(rows, given.select("doc_id"), labelled).join(F.broadcast(given.orderBy(F.xxhash64("doc_id"), "doc_id").limit(labelled)), "doc_id")
    sample = stored(sample, "weak-labelled")
    lists = _lists(sample)

    votes = stored(_with_labels(_voted(rows, lists, False), given), "weak-votes")
    counted = votes.groupBy("low", "toxic").count().collect()  # at most 3 ** labellers patterns
    posteriors, shares = {}, {}
    for task, labellers in zip(TASKS, (LOW_LABELLERS, TOXIC_LABELLERS), strict=True):
        counts: dict[int, int] = {}
        for row in counted:
            counts[row[task]] = counts.get(row[task], 0) + row["count"]
        posteriors[task], shares[task] = estimate(counts, labellers, prior_votes=prior_votes)

    wide = _first(votes.where("doc_id is not null").select("doc_id"), others)
    more = _texts(rows, wide.unionAll(_of_patterns(votes, counted, per_pattern)).distinct())
    training = _voted(sample.select("doc_id", "text").unionAll(more), lists, True)
    known = _with_labels(training, given).toArrow()  # a bounded sample
    column = known.column("features").combine_chunks()
    features = column.flatten().to_numpy()
    lengths = pc.list_value_length(column).to_numpy()
    sizes = known.column("size").to_numpy()
    learned, biases, chance = {}, [], []
    for k, (task, labellers) in enumerate(zip(TASKS, (LOW_LABELLERS, TOXIC_LABELLERS), strict=True)):
        patterns = known.column(task).to_pylist()
        targets = np.array([posteriors[task].get(p, 0.0) for p in patterns])
        weights, bias = train(features, lengths, targets)
        biases.append(bias)
        good = np.array([p // 3 ** (labellers - 1) == GOOD for p in patterns], bool)
        chance.append(_chance(features, lengths, sizes, good if good.any() else targets < 0.5, weights))
        for feature, weight in weights.items():
            pair = learned.setdefault(feature, [0.0, 0.0])
            pair[k] = weight
    usual = float(sizes.mean()) if len(sizes) else 0.0
    return Classifier({f: tuple(w) for f, w in learned.items()}, tuple(biases), shares, usual_words=usual, chance=tuple(chance))


def _scored(batches: Iterable[pa.RecordBatch], text: str, fitted: Classifier) -> Iterator[tuple[pa.RecordBatch, np.ndarray]]:
    forget()
    cache = WordCache(fitted.word_weights, SCORED_WORDS)
    for batch in slices(batches, text):
        yield batch, fitted.scores(strings(batch, text), cache)


def score(docs: DataFrame, fitted: Classifier, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``doc_id, p_low, p_toxic, keep`` of every whole text."""
    shared = docs.sparkSession.sparkContext.broadcast(fitted)

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch, found in _scored(batches, "text", shared.value):
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id"), pa.array(found[:, 0].copy()), pa.array(found[:, 1].copy())],
                ["doc_id", "p_low", "p_toxic"],
            )

    rows = text_columns(docs, id_col, text_col).mapInArrow(run, SCORES)
    return rows.withColumn("keep", (F.col("p_low") < fitted.limit) & (F.col("p_toxic") < fitted.limit))


def keep(docs: DataFrame, fitted: Classifier, text_col: str = "text") -> DataFrame:
    """The rows of `docs` that the scorer does not reject."""
    shared = docs.sparkSession.sparkContext.broadcast(fitted)

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        limit = shared.value.limit
        for batch, found in _scored(batches, text_col, shared.value):
            yield batch.filter(pa.array((found < limit).all(axis=1)))

    return docs.mapInArrow(run, docs.schema)
