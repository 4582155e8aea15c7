"""Quality classification: document evidence combined with host and path posteriors, shrunk by empirical Bayes."""

from __future__ import annotations

import math
import re
import sys
import types
from collections import Counter
from collections.abc import Iterable, Iterator
from dataclasses import dataclass, field

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import fresh, give_back, stage

#: At most this many labelled rows, those of the least hashed ids, fit the document classifier.
MAX_LABELLED = 20_000
#: Sites are broadcast up to this many; beyond it the join is left to Catalyst.
MAX_BROADCAST_SITES = 100_000

LETTERS = re.compile(r"[^\W\d_]+")
#: Kinds of UTF-8 bytes: 0 other (multi-byte letters), 1 lower, 2 upper, 3 digit, 4 space, 5 line end, 6 sentence mark, 7 symbol.
KIND = np.zeros(256, np.uint8)
KIND[0x21:0x7F] = 7
KIND[ord("a") : ord("z") + 1], KIND[ord("A") : ord("Z") + 1], KIND[ord("0") : ord("9") + 1] = 1, 2, 3
KIND[[0x20, 0x09, 0x0B, 0x0C]], KIND[[0x0A, 0x0D]] = 4, 5
KIND[[ord(c) for c in ".,;:'\"-()?"]] = 6


#: Letters of a word's beginnings that count as evidence beside the word, and words whose weights a worker keeps.
BEGINNINGS, KEPT_WORDS = (5, 6, 7), 500_000


def units(words: Iterable[str]) -> set[str]:
    """What a text's words are known by: each word, and the beginnings of longer ones, with a star."""
    out = set(words)
    return out.union(*({w[:k] + "*" for w in out if len(w) > k} for k in BEGINNINGS))


class WordWeights(dict):
    """The largest weight that speaks for each word: its own or that of a beginning of it. Words are kept, as they come up again."""

    def __init__(self, by_unit: dict[str, float]):
        super().__init__()
        self.by_unit = by_unit

    def __missing__(self, word: str) -> float:
        if len(self) > KEPT_WORDS:
            self.clear()
        out = self[word] = max(self.by_unit.get(u, 0.0) for u in units([word]))
        return out


@dataclass(frozen=True)
class Lexicon:
    """For units in toxic texts: in how many toxic texts and how many others each is, of how many in all."""

    counts: dict[str, tuple[int, int]] = field(default_factory=dict)
    yes: int = 0
    no: int = 0

    def weight(self, unit: str, own: bool | None, strength: float = 10.0) -> float:
        """How much a unit adds to the log odds of being toxic, shrunk to nothing as if `strength` more texts held it by chance.
        `own` tells of a text that was counted whether it is toxic: it doesn't count for itself."""
        yes, no = self.counts.get(unit, (0, 0))
        yes, no = yes - (own is True), no - (own is False)
        if yes <= 0:
            return 0.0
        rate = (self.yes + 0.5) / (self.yes + self.no + 1)
        return max(math.log((yes + strength * rate) / (no + strength * (1 - rate))) - math.log(rate / (1 - rate)), 0.0)

    def word_weights(self, own: bool | None = None) -> WordWeights:
        return WordWeights({u: w for u in self.counts if (w := self.weight(u, own)) > 0})


def features(text: str | None, weights: WordWeights) -> list[float]:
    """Numbers from a whole text: its mix of characters, its repetition and length; last three: the weights of its toxic words, by
    its words and in sum, and the largest."""
    text = text or ""
    kinds = np.bincount(KIND[np.frombuffer(text.encode("utf-8", "replace"), np.uint8)], minlength=8)
    size, letters = max(int(kinds.sum()), 1), max(int(kinds[0] + kinds[1] + kinds[2]), 1)
    words, lines = LETTERS.findall(text.lower()), text.split("\n")
    n, different = max(len(words), 1), len(set(words))
    toxic = list(map(weights.__getitem__, words)) if weights.by_unit else []
    bad = math.fsum(toxic)
    return [
        kinds[2] / letters, kinds[3] / size, kinds[6] / size, kinds[7] / size, min(kinds[7] / n, 2.0), kinds[5] / size,
        1 - len(set(lines)) / len(lines), 1 - different / n, np.log1p(len(words)), letters / n / 10, float(not words),
        bad / n, np.log1p(bad), max(toxic, default=0.0),
    ]


TOXIC = slice(-3, None)
PLAIN = slice(0, -3)


def fit_logistic(x: np.ndarray, y: np.ndarray, ridge: float = 1.0, rounds: int = 25) -> np.ndarray:
    """Weights (the last for a constant) on standardised features, by Newton steps, in terms of the features as given."""
    mean, sd = x.mean(axis=0), x.std(axis=0) + 1e-9
    z = np.c_[(x - mean) / sd, np.ones(len(x))]
    w, keep = np.zeros(z.shape[1]), np.diag(np.r_[np.full(x.shape[1], ridge), 1e-3])
    for _ in range(rounds):
        p = 1 / (1 + np.exp(-np.clip(z @ w, -30, 30)))
        step = np.linalg.solve((z * (p * (1 - p))[:, None]).T @ z + keep, z.T @ (y - p) - keep @ w)
        w = w + step
        if np.abs(step).max() < 1e-8:
            break
    return np.r_[w[:-1] / sd, w[-1] - (w[:-1] * mean / sd).sum()]


@dataclass(frozen=True)
class Classifier:
    """Document classifier: the chance that a text is of good quality times the chance that it is not toxic."""

    quality: np.ndarray
    toxic: np.ndarray
    lexicon: Lexicon = field(default_factory=Lexicon)

    def __call__(self, texts: list[str | None]) -> tuple[np.ndarray, np.ndarray]:
        kept = sys.modules.setdefault("_fieldglass_weights", types.ModuleType("_fieldglass_weights")).__dict__
        if kept.get("lexicon") != self.lexicon:
            kept |= {"lexicon": self.lexicon, "weights": self.lexicon.word_weights()}
        x = np.array([features(t, kept["weights"]) for t in texts], float).reshape(len(texts), -1)
        chance = lambda w, x: 1 / (1 + np.exp(-np.clip(x @ w[:-1] + w[-1], -30, 30)))
        return chance(self.quality, x[:, PLAIN]), chance(self.toxic, x[:, TOXIC])


def toxic_lexicon(rows: DataFrame, least: int = 3, ratio: float = 5.0, most: int = 5_000) -> Lexicon:
    """Units, see there, of the words of `rows` (text, toxic): those in at least `least` toxic texts and `ratio` times as often
    among the toxic as among the others; of more than `most`, those of the most texts."""

    def counted(of: DataFrame, wanted: frozenset[str] | None) -> DataFrame:
        def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            found: Counter[str] = Counter()
            for batch in give_back(batches):
                for text in batch.column(0).to_pylist():
                    own = units(LETTERS.findall((text or "").lower()))
                    found.update(own if wanted is None else own & wanted)
            yield pa.RecordBatch.from_arrays([pa.array(list(found), pa.string()), pa.array(list(found.values()), pa.int64())], ["unit", "n"])

        return of.select("text").mapInArrow(count, "unit string, n long").groupBy("unit").agg(F.sum("n").alias("n"))

    n = rows.agg(F.count_if(F.expr("toxic > 0")).alias("yes"), F.count_if(F.expr("toxic <= 0")).alias("no")).first()
    yes = {r["unit"]: r["n"] for r in counted(rows.where("toxic > 0"), None).where(F.col("n") >= least).orderBy(F.desc("n"), "unit").limit(20 * most).collect()}
    no = {r["unit"]: r["n"] for r in counted(rows.where("toxic <= 0"), frozenset(yes)).collect()}
    often = [u for u in yes if yes[u] / max(n["yes"], 1) >= ratio * (no.get(u, 0) + 0.5) / max(n["no"], 1)]
    often.sort(key=lambda u: (-yes[u], u))
    return Lexicon({u: (yes[u], no.get(u, 0)) for u in often[:most]}, n["yes"], n["no"])


def fit_classifier(docs: DataFrame, labels: DataFrame, *, most: int = MAX_LABELLED, id_col: str = "doc_id", text_col: str = "text") -> Classifier:
    """Fit on at most `most` rows of `labels` (doc_id, quality 0/1, toxic 0/1) and documents, those of the least hashes; repeated
    labels and repeated documents of one id are rows each.

    A null quality counts as 1 and a null toxic as 0; rows of null id are left out. Without any rows, or with rows of one
    kind only, that part of the classifier is constant.
    """
    some = labels.select(F.col("doc_id").alias("label id"), F.coalesce("quality", F.lit(1)).alias("quality"), F.coalesce("toxic", F.lit(0)).alias("toxic"))
    some = some.where(F.col("label id").isNotNull()).orderBy(F.xxhash64("label id"), "label id").limit(most)
    texts = docs.select(F.col(id_col).alias("label id"), F.col(text_col).alias("text"))
    found = texts.join(F.broadcast(some), "label id")  # at most `most` labels
    place = F.struct(F.xxhash64("label id", "text", "quality", "toxic").alias("hash"), F.monotonically_increasing_id().alias("row"))
    rows = stage(found.select("text", "quality", "toxic", place.alias("place")))
    if rows.count() > most:  # by their places alone, which are small
        last = rows.select("place").orderBy("place").limit(most).agg(F.max("place").alias("p")).first()["p"]
        rows = rows.where(F.col("place") <= F.struct(F.lit(last["hash"]).alias("hash"), F.lit(last["row"]).alias("row")))
    rows = rows.drop("place")
    lexicon = toxic_lexicon(rows)

    @F.pandas_udf("array<double>")
    def numbers(texts: pd.Series, toxic: pd.Series) -> pd.Series:
        weights = {own: lexicon.word_weights(own) for own in (False, True)}
        return pd.Series([features(t, weights[bool(y > 0)]) for t, y in zip(texts, toxic, strict=True)], dtype=object)

    found = rows.select("quality", "toxic", numbers("text", "toxic").alias("x")).collect()  # numbers only
    good, bad = np.array([r[0] for r in found], float), np.array([r[1] for r in found], float)
    x = np.array([r[2] for r in found], float).reshape(len(found), len(features("", WordWeights({}))))

    def head(part: slice, y: np.ndarray, alone: float) -> np.ndarray:
        if len(set(y.tolist())) == 2:
            return fit_logistic(x[:, part], y)
        rate = (y.sum() + alone) / (len(y) + 1)
        return np.r_[np.zeros(x[:, part].shape[1]), np.log((rate + 1e-3) / (1 - rate + 1e-3))]

    return Classifier(head(PLAIN, good, 0.9), head(TOXIC, bad, 0.02), lexicon)


def document_score(text: Column, classifier: Classifier) -> Column:
    """A struct for each whole text: good (chance of good quality) and toxic (chance of being toxic)."""

    @F.pandas_udf("good double, toxic double")
    def scores(parts: Iterator[pd.Series]) -> Iterator[pd.DataFrame]:
        for part in give_back(parts):
            good, toxic = classifier(part.tolist()) if len(part) else ([], [])
            yield pd.DataFrame({"good": good, "toxic": toxic})

    return scores(text)


def _strength(sites: DataFrame, mean: Column, least: float = 1.0, most: float = 1e4) -> float:
    """The strength of the beta prior around `mean` from which the sites' rates s / n are drawn, by the method of moments:
    how much more the rates vary than binomial draws of their sizes would."""
    gap = F.col("n") * F.pow(F.col("s") / F.col("n") - mean, 2)
    row = sites.agg(F.count("*").alias("k"), F.sum("n").alias("n"), F.sum(F.col("n") * F.col("n")).alias("n2"), F.sum(gap).alias("gap"), F.sum(F.col("n") * mean * (1 - mean)).alias("var")).first()
    if row["k"] < 2 or not row["var"]:
        return most
    size = (row["n"] - row["n2"] / row["n"]) / (row["k"] - 1)
    spread = (row["gap"] / ((row["k"] - 1) * row["var"] / row["n"]) - 1) / max(size - 1, 1e-9)
    return most if spread <= 0 else float(np.clip(1 / spread - 1, least, most))


def _key(column: str) -> Column:
    """A site's name that is never null: null is a site of its own."""
    return F.coalesce(F.concat(F.lit("="), F.col(column).cast("string")), F.lit(""))


def site_posteriors(scored: DataFrame) -> DataFrame:
    """From rows (host, path, p): for each (host, path) its n, s (sum of p) and strength, prior, host_score (the host's posterior
    mean), and the host's host_n, host_s and host_strength.

    Documents are summed to paths and paths to hosts; hosts shrink towards the mean of all documents and paths towards
    their host, the more the fewer documents they have. All rows count.
    """
    paths = stage(scored.groupBy("host", "path").agg(F.count("*").alias("n"), F.sum("p").alias("s")))  # read several times
    hosts = paths.groupBy("host").agg(F.sum("n").alias("n"), F.sum("s").alias("s"))
    whole = hosts.agg(F.sum("n").alias("n"), F.sum("s").alias("s")).first()
    prior = (whole["s"] or 0) / whole["n"] if whole["n"] else 0.5
    strong = _strength(hosts, F.lit(prior))
    hosts = hosts.select("host", ((F.col("s") + strong * prior) / (F.col("n") + strong)).alias("host_score"), F.col("n").alias("host_n"), F.col("s").alias("host_s"), F.lit(float(strong)).alias("host_strength"))
    paths = paths.join(hosts, "host")
    strong = _strength(paths, F.col("host_score"))
    return paths.withColumn("strength", F.lit(float(strong))).withColumn("prior", F.lit(float(prior)))


def _logit(c: Column) -> Column:
    c = F.least(F.greatest(c, F.lit(1e-6)), F.lit(1 - 1e-6))
    return F.log(c / (1 - c))


def _judged(rows: DataFrame, sites: DataFrame, threshold: float) -> DataFrame:
    """`rows` (host, path, own, p) with their sites, and a column found: the struct that score and classify return.

    A document's log odds are those of its own text plus what its path adds to the mean of all: the path's posterior, shrunk to
    its host's, both without the document itself.
    """
    small = sites.count() <= MAX_BROADCAST_SITES
    joined = rows.join(F.broadcast(sites) if small else sites, ["host", "path"])
    host = (F.col("host_s") - F.col("p") + F.col("host_strength") * F.col("prior")) / (F.col("host_n") - 1 + F.col("host_strength"))
    path = (F.col("s") - F.col("p") + F.col("strength") * host) / (F.col("n") - 1 + F.col("strength"))
    score = 1 / (1 + F.exp(-(_logit(F.col("p")) + _logit(path) - _logit(F.col("prior")))))
    return joined.withColumn("found", F.struct(score.alias("score"), (score >= threshold).alias("keep"), F.col("p").alias("doc_score"), F.col("own.toxic").alias("toxic_score"), host.alias("host_score"), path.alias("path_score")))


def _own_scores(docs: DataFrame, classifier: Classifier, columns: list[Column], host_col: str, path_col: str, text_col: str) -> DataFrame:
    rows = docs.select(*columns, _key(host_col).alias("host"), _key(path_col).alias("path"), document_score(F.col(text_col), classifier).alias("own"))
    return rows.withColumn("p", F.col("own.good") * (1 - F.col("own.toxic")))


def score(
    docs: DataFrame, labels: DataFrame, *, host_col: str = "source", path_col: str = "lang", threshold: float = 0.5,
    most_labelled: int = MAX_LABELLED, id_col: str = "doc_id", text_col: str = "text",
) -> DataFrame:
    """doc_id, score, keep, doc_score, toxic_score, host_score and path_score of each row of `docs`, as classify gives them. Without
    the texts in its result it reads them once."""
    classifier = fit_classifier(docs, labels, most=most_labelled, id_col=id_col, text_col=text_col)
    rows = stage(_own_scores(docs, classifier, [F.col(id_col).alias("doc_id")], host_col, path_col, text_col))
    return _judged(rows, stage(site_posteriors(rows.select("host", "path", "p"))), threshold).select("doc_id", "found.*")


def classify(
    docs: DataFrame, labels: DataFrame, *, host_col: str = "source", path_col: str = "lang", threshold: float = 0.5,
    most_labelled: int = MAX_LABELLED, id_col: str = "doc_id", text_col: str = "text",
) -> DataFrame:
    """`docs` with a column quality (with underscores added if there is one): a struct of score, keep, doc_score,
    toxic_score, host_score and path_score. `keep` tells whether score reaches `threshold`; see _judged.

    Nulls: a null text counts as empty; null hosts and paths are sites of their own; a null id only keeps a row from being
    learned from. Repeated rows count and are returned each. An empty table gives no rows. Clashing names of other
    columns do no harm.
    """
    classifier = fit_classifier(docs, labels, most=most_labelled, id_col=id_col, text_col=text_col)
    whole = F.struct(*(F.col(f"`{c}`") for c in docs.columns)).alias("row")
    #: The classifier runs twice rather than keep a copy of all texts.
    rows = _own_scores(docs, classifier, [whole], host_col, path_col, text_col)
    sites = stage(site_posteriors(rows.select("host", "path", "p")))
    (name,) = fresh(docs, "quality")
    return _judged(rows, sites, threshold).select("row.*", F.col("found").alias(name))
