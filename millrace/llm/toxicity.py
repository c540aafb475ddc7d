"""Toxicity classifier with a counterfactual penalty.

A logistic regression over the different words of a text and their beginnings. For every labelled
text that names a group of people, the terms are swapped within their set and the squared change of
the score is part of the loss, so that a neutral mention of a group counts for nothing. A text that names
none is given a mention, drawn by its row's hash, so that the penalty acts on every term of the sets even where
the corpus has none of them. The sets are a parameter. Corpora whose groups have other names add their own: words of the labelled texts that
are mentioned alike in both classes, each paired with the one that stands most often in the same texts.
"""

from __future__ import annotations

import re
from collections.abc import Iterable
from functools import lru_cache

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from millrace.llm.common import by_batch, texts
from millrace.storage import saved

#: Labelled rows that the model is fitted on at most, chosen by a hash of doc_id, and features at most.
MAX_TRAIN, MAX_FEATURES, MIN_DOCS = 20_000, 4096, 3
FEATURE_BITS = 22
PREFIXES = (4, 5, 6)
#: Weights of the ridge and of the counterfactual penalty.
RIDGE, COUNTERFACTUAL = 2e-4, 1.0
STEPS = 300
#: Neutral terms found in the labelled rows: at most, letters at least, share of the rows from and to which one is
#: held, and how far the share of toxic ones among its rows may be from that of all, in standard errors.
MAX_TERMS, TERM_LETTERS, TERM_SHARE, TERM_ERRORS = 256, 4, (0.005, 0.2), 1.0

#: Sets of terms that stand for groups of people; one is swapped for the next of its set.
IDENTITIES = (
    ("women", "men"), ("woman", "man"), ("gay", "straight", "lesbian", "bisexual"), ("black", "white", "asian", "latino"),
    ("muslim", "christian", "jewish", "hindu", "buddhist"), ("muslims", "christians", "jews", "hindus", "buddhists"),
    ("immigrants", "natives", "refugees"), ("old", "young"), ("disabled", "deaf", "blind"), ("transgender", "cisgender"),
    ("frauen", "männer"), ("muslime", "christen", "juden"), ("femmes", "hommes"), ("musulmans", "chrétiens", "juifs"),
    ("mujeres", "hombres"), ("musulmanes", "cristianos", "judíos"),
)

WORD = re.compile(r"[^\W\d_]+").findall


@lru_cache(maxsize=200_000)
def word_features(word: str) -> tuple[int, ...]:
    """Hashes of the word and of its beginnings."""
    own = [f"={word}", *(word[:n] for n in PREFIXES if len(word) >= n)]
    return tuple(xxhash.xxh3_64_intdigest(x.encode()) >> (64 - FEATURE_BITS) for x in own)


def words_of(text: str) -> set[str]:
    return set(WORD(text.lower()))


def features(words: set[str]) -> set[int]:
    found: set[int] = set()
    for w in words:
        found.update(word_features(w))
    return found


def swaps(sets: Iterable[tuple[str, ...]]) -> dict[str, str]:
    """For each term the next of its set; a term of two sets counts in the first."""
    found: dict[str, str] = {}
    for terms in sets:
        own = [t for t in dict.fromkeys(terms) if t not in found]
        found |= {t: own[(i + 1) % len(own)] for i, t in enumerate(own) if len(own) > 1}
    return found


def swapped(words: set[str], swap: dict[str, str]) -> set[str] | None:
    """The words with every identity term swapped; None if there are none."""
    return {swap.get(w, w) for w in words} if not swap.keys().isdisjoint(words) else None


def training_rows(docs: DataFrame, labels: DataFrame, max_train: int) -> DataFrame:
    """(toxic, place, words) of at most ``max_train`` labelled documents outside the held-out fold."""
    learn = F.crc32(F.col("doc_id").cast("string")) % 5 != 0
    own = labels.where(learn & F.col("toxic").isNotNull()).groupBy("doc_id").agg((F.max("toxic") > 0).cast("int").alias("toxic"))
    place = F.xxhash64("doc_id")
    chosen = own.orderBy(place, "doc_id").limit(max_train).select("doc_id", "toxic", place.alias("place"))

    def run(batch: pa.RecordBatch) -> pa.RecordBatch:
        words = pa.array([sorted(words_of(t)) for t in texts(batch)], pa.list_(pa.string()))
        return pa.RecordBatch.from_arrays([batch.column("toxic"), batch.column("place"), words], ["toxic", "place", "words"])

    # the chosen ids are at most max_train rows
    joined = docs.select("doc_id", "text").join(F.broadcast(chosen), "doc_id").select("text", "toxic", "place")
    return joined.mapInArrow(by_batch(run), "toxic int, place bigint, words array<string>")


def neutral_terms(rows: DataFrame, known: Iterable[str] = (), max_terms: int = MAX_TERMS) -> list[tuple[str, str]]:
    """Pairs of terms that the labelled rows mention alike in toxic and other texts, found in company of one another.

    The terms are the ``max_terms`` most frequent of such words; a pair are the two unpaired ones whose
    rows agree most. Rows without both labels give none.
    """
    n, p = rows.agg(F.count("*"), F.coalesce(F.sum("toxic"), F.lit(0))).first()
    if not 0 < p < n:
        return []
    held = rows.select("toxic", F.explode("words").alias("w")).where((F.length("w") >= TERM_LETTERS) & ~F.col("w").isin(*known))
    counted = held.groupBy("w").agg(F.count("*").alias("d"), F.sum("toxic").alias("a")).where(F.col("d").between(max(2, TERM_SHARE[0] * n), TERM_SHARE[1] * n))
    even = F.abs(F.col("a") / F.col("d") - F.lit(p / n)) <= TERM_ERRORS * F.sqrt(F.lit(p / n * (1 - p / n)) / F.col("d"))
    terms = [r["w"] for r in counted.where(even).orderBy(F.desc("d"), "w").limit(max_terms).collect()]
    if len(terms) < 2:
        return []
    both = rows.select(F.expr("array_intersect(words, array({}))".format(", ".join(f"'{t}'" for t in terms))).alias("w"))  # letters only
    pairs = both.select(F.explode("w").alias("x"), "w").select("x", F.explode("w").alias("y")).groupBy("x", "y").agg(F.count("*").alias("c")).collect()
    at, met = {t: i for i, t in enumerate(terms)}, np.zeros((len(terms), len(terms)))
    for r in pairs:  # at most max_terms squared
        met[at[r["x"]], at[r["y"]]] = r["c"]
    alike = met / np.sqrt(np.outer(met.diagonal(), met.diagonal()))
    free, found = set(range(len(terms))), []
    for k in np.argsort(-np.triu(alike, 1), axis=None, kind="stable"):
        i, j = divmod(int(k), len(terms))
        if i < j and {i, j} <= free:
            free -= {i, j}
            found.append((terms[i], terms[j]))
    return found


def mentions(words: set[str], swap: dict[str, str], given: list[tuple[str, str]], draw: int) -> tuple[set[str], set[str]] | None:
    """A text's words and the same with identity terms swapped; one of ``given`` is put in where no term stands."""
    other = swapped(words, swap)
    if other is not None:
        return words, other
    if not given:
        return None
    one, two = given[draw % len(given)]
    return words | {one}, words | {two}


def with_features(rows: DataFrame, swap: dict[str, str], given: dict[str, str] | None = None) -> DataFrame:
    """(toxic, place, features, plus, minus) of training rows: what a swap takes away and adds; null where nothing is swapped.

    Terms and successors of ``given`` are mentioned in the texts that hold none of ``swap``.
    """
    pairs = sorted((given or {}).items())

    def run(batch: pa.RecordBatch) -> pa.RecordBatch:
        plain, plus, minus = [], [], []
        for own, draw in zip(batch.column("words").to_pylist(), batch.column("place").to_pylist(), strict=True):
            words = set(own)
            plain.append(sorted(features(words)))
            pair = mentions(words, swap, pairs, draw)
            before, after = map(features, pair) if pair else (None, None)
            plus.append(sorted(before - after) if pair else None)
            minus.append(sorted(after - before) if pair else None)
        lists = [pa.array(x, pa.list_(pa.int32())) for x in (plain, plus, minus)]
        return pa.RecordBatch.from_arrays([batch.column("toxic"), batch.column("place"), *lists], ["toxic", "place", "features", "plus", "minus"])

    return rows.mapInArrow(by_batch(run), "toxic int, place bigint, features array<int>, plus array<int>, minus array<int>")


def telling(rows: DataFrame, max_features: int, swap: dict[str, str]) -> list[int]:
    """The features that tell most by chi-square, and those of the identity terms."""
    totals = rows.agg(F.count("*").alias("n"), F.coalesce(F.sum("toxic"), F.lit(0)).alias("p")).first()
    counted = rows.select("toxic", F.explode("features").alias("f")).groupBy("f").agg(F.count("*").alias("d"), F.sum("toxic").alias("a"))
    n, p = float(totals["n"]), float(totals["p"])
    expected = F.col("d") * F.lit(p / max(n, 1.0))
    spread = expected * F.lit(1 - p / max(n, 1.0)) + F.lit(1e-9)
    ranked = counted.where(F.col("d") >= MIN_DOCS).withColumn("chi", (F.col("a") - expected) ** 2 / spread)
    best = [r["f"] for r in ranked.orderBy(F.desc("chi"), "f").limit(max_features).select("f").collect()]
    return sorted({*best, *(f for term in swap for f in word_features(term))})


class Model:
    """Weights of features and a bias; ``swap`` and ``n_pairs`` tell which swaps it was held to, and on how many texts."""

    def __init__(self, weights: dict[int, float], bias: float, swap: dict[str, str] | None = None, n_pairs: int = 0):
        self.weights, self.bias, self.of_word = weights, bias, {}
        self.swap, self.n_pairs = swap or {}, n_pairs

    def score(self, text: str) -> float:
        found: set[int] = set()
        known = self.of_word
        for w in words_of(text):
            own = known.get(w)
            if own is None:
                if len(known) > 300_000:
                    known.clear()
                own = known[w] = tuple(f for f in word_features(w) if f in self.weights)
            if own:
                found.update(own)
        z = self.bias + sum(self.weights[f] for f in sorted(found))
        return float(1 / (1 + np.exp(-np.clip(z, -50, 50))))


def cells(lists: pa.ListArray, chosen: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(row, place in ``chosen``) of every listed feature that is chosen; a null list has none."""
    lengths = np.nan_to_num(pc.list_value_length(lists).to_numpy(zero_copy_only=False)).astype(np.int64)
    rows, own = np.repeat(np.arange(len(lists)), lengths), lists.flatten().to_numpy(zero_copy_only=False)
    place = np.minimum(np.searchsorted(chosen, own), len(chosen) - 1)
    known = chosen[place] == own
    return rows[known], place[known]


class Objective:
    """Logistic loss, ridge and counterfactual penalty over training rows, as a function of weights and bias."""

    def __init__(self, labels: np.ndarray, plain: pa.ListArray, plus: pa.ListArray, minus: pa.ListArray, chosen: np.ndarray, penalty: float):
        self.y, self.n, self.size, self.penalty = labels.astype(float), len(labels), len(chosen), penalty
        self.rows, self.columns = cells(plain, chosen)
        paired = plus.is_valid().to_numpy(zero_copy_only=False)
        self.n_pairs, of_pair = int(paired.sum()), np.cumsum(paired) - 1
        (pr, pc_), (mr, mc) = cells(plus, chosen), cells(minus, chosen)
        self.pair_rows, self.pair_columns = of_pair[np.append(pr, mr)], np.append(pc_, mc)
        self.signs = np.append(np.ones(len(pr)), -np.ones(len(mr)))

    def at(self, w: np.ndarray, b: float) -> tuple[float, np.ndarray]:
        """The loss and its gradient, the bias last."""
        z = np.clip(b + np.bincount(self.rows, w[self.columns], self.n), -50, 50)
        r = (1 / (1 + np.exp(-z)) - self.y) / self.n
        loss = float((np.logaddexp(0, z) - self.y * z).sum() / self.n + RIDGE / 2 * (w * w).sum())
        g = np.append(np.bincount(self.columns, r[self.rows], self.size) + RIDGE * w, r.sum())
        if self.n_pairs and self.penalty:
            d = np.bincount(self.pair_rows, w[self.pair_columns] * self.signs, self.n_pairs)
            loss += float(self.penalty / self.n_pairs * (d * d).sum())
            g[:-1] += 2 * self.penalty / self.n_pairs * np.bincount(self.pair_columns, d[self.pair_rows] * self.signs, self.size)
        return loss, g


def fit(labels: np.ndarray, plain: pa.ListArray, plus: pa.ListArray, minus: pa.ListArray, chosen: list[int], penalty: float = COUNTERFACTUAL) -> Model:
    """Full-batch Adam on the objective."""
    n = len(labels)
    if not n or not chosen or len(set(labels.tolist())) < 2:
        rate = (labels.sum() + 0.25) / (n + 1)
        return Model({}, float(np.log(rate / (1 - rate))))
    objective = Objective(labels, plain, plus, minus, np.array(chosen), penalty)
    mean = objective.y.mean()
    w, b = np.zeros(len(chosen)), float(np.log(mean / (1 - mean)))
    m, v = np.zeros(len(chosen) + 1), np.zeros(len(chosen) + 1)
    for step in range(1, STEPS + 1):
        g = objective.at(w, b)[1]
        m, v = 0.9 * m + 0.1 * g, 0.999 * v + 0.001 * g * g
        move = 0.05 * (m / (1 - 0.9**step)) / (np.sqrt(v / (1 - 0.999**step)) + 1e-8)
        w, b = w - move[:-1], b - move[-1]
    return Model({f: float(x) for f, x in zip(chosen, w, strict=True) if abs(x) > 1e-3}, float(b), n_pairs=objective.n_pairs)


def trained(
    docs: DataFrame, labels: DataFrame, max_train: int = MAX_TRAIN, max_features: int = MAX_FEATURES,
    identities: tuple[tuple[str, ...], ...] = IDENTITIES, penalty: float | None = None,
) -> Model:
    """A model fitted on at most ``max_train`` labelled documents outside the held-out fold.

    Labels that are null are left out; of several labels for a document the highest counts. The swaps
    are those of ``identities`` and of the neutral terms that the same rows show.
    """
    rows = saved(training_rows(docs, labels, max_train), "toxicity-words")
    given = {t for terms in identities for t in terms}
    swap = swaps([*identities, *neutral_terms(rows, given)])
    featured = saved(with_features(rows, swap, swaps(identities)), "toxicity-rows")
    chosen = telling(featured, max_features, swap)
    own = np.array(chosen)

    def run(batch: pa.RecordBatch) -> pa.RecordBatch:
        few = lambda x: None if x is None else [f for f in np.array(x, int)[np.isin(x, own)].tolist()]
        kept = [pa.array([few(x) for x in batch.column(c).to_pylist()], pa.list_(pa.int32())) for c in ("features", "plus", "minus")]
        return pa.RecordBatch.from_arrays([batch.column("toxic"), batch.column("place"), *kept], batch.schema.names)

    # at most max_train rows of at most max_features and the terms' own, in an order that is the same in every run
    table = saved(featured.mapInArrow(by_batch(run), featured.schema), "toxicity-chosen").orderBy("place", "toxic", "features").toArrow().combine_chunks()
    column = lambda c: table.column(c).chunk(0) if table.num_rows else pa.array([], table.schema.field(c).type)
    model = fit(column("toxic").to_numpy(), column("features"), column("plus"), column("minus"), chosen, COUNTERFACTUAL if penalty is None else penalty)
    model.swap = swap
    return model


def scored(df: DataFrame, labels: DataFrame, doc_id: str = "doc_id", text: str = "text", max_train: int = MAX_TRAIN) -> DataFrame:
    """Per row: doc_id, held_out, score (0 to 1) and predicted (score of at least 0.5).

    Null and empty texts get the score of a text without words. A null doc_id is held out of
    learning: held_out true. Without labels every score is 0.25.
    """
    docs = df.selectExpr(f"cast(`{doc_id}` as bigint) as doc_id", f"`{text}` as text")
    model = docs.sparkSession.sparkContext.broadcast(trained(docs, labels, max_train))  # at most MAX_FEATURES weights

    def run(batch: pa.RecordBatch) -> pa.RecordBatch:
        scores = [model.value.score(t) for t in texts(batch)]
        return pa.RecordBatch.from_arrays([batch.column("doc_id"), pa.array(scores, pa.float64())], ["doc_id", "score"])

    found = docs.mapInArrow(by_batch(run), "doc_id bigint, score double")
    held_out = F.coalesce(F.crc32(F.col("doc_id").cast("string")) % 5 == 0, F.lit(True))
    return found.select("doc_id", held_out.alias("held_out"), "score", (F.col("score") >= 0.5).cast("int").alias("predicted"))
