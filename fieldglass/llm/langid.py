"""Language identification: each document is a mixture of languages, inferred from its letter n-grams."""

from __future__ import annotations

import sys
import types
from collections.abc import Iterator, Sequence
from dataclasses import dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark import Broadcast
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import give_back

#: N-grams are hashed to 2 ** BUCKET_BITS buckets, so a model has a fixed size for each language.
BUCKET_BITS = 16
#: A model of more languages than this is refused: its table is held by the driver and sent to all executors.
MAX_LANGUAGES = 500
#: Documents, and characters of them, that are taken together; a longer text is taken alone, and by pieces of so many.
AT_ONCE, CHARS_AT_ONCE = 128, 500_000
UNKNOWN = "und"


@dataclass(frozen=True)
class Model:
    languages: list[str]
    table: Broadcast  # float32, languages x buckets: the likelihood of each bucket


def _is_letter(points: np.ndarray) -> np.ndarray:
    """Which code points are letters, by a table that a worker makes once."""
    kept = sys.modules.setdefault("_fieldglass_letters", types.ModuleType("_fieldglass_letters")).__dict__
    if "low" not in kept:
        kept["low"] = np.array([chr(i).isalpha() for i in range(1 << 16)])
    out = kept["low"][np.minimum(points, 0xFFFF)]
    for i in np.flatnonzero(points > 0xFFFF):
        out[i] = chr(points[i]).isalpha()
    return out


def _spaced(points: np.ndarray, which: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Code points of several texts with each run of other characters than letters as one space: the points, their texts, and
    which of the points given are kept."""
    letter = _is_letter(points)
    kept = letter | np.r_[True, letter[:-1] | (which[1:] != which[:-1])]
    return np.where(letter, points, 32)[kept].astype(np.uint32), which[kept], kept


def _buckets(points: np.ndarray) -> np.ndarray:
    """The buckets of all 3-grams of code points."""
    mixed = points[:-2] * np.uint32(0x9E3779B1) + points[1:-1] * np.uint32(0x85EBCA77) + points[2:] * np.uint32(0xC2B2AE3D)
    mixed ^= mixed >> np.uint32(15)
    mixed *= np.uint32(0x2C1B3C6D)
    return (mixed >> np.uint32(32 - BUCKET_BITS)).astype(np.int64)


def _points(text: str) -> np.ndarray:
    return np.frombuffer(text.encode("utf-32-le", "surrogatepass"), "<u4")


def ngrams(texts: list[str | None]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """For several texts: the text and the bucket of each of their 3-grams, and which texts have any letter.

    Texts are lower-cased; what is not a letter becomes one space. Each text has a space before and after it.
    """
    lowered = [(" " + t.lower() + " ") if t else " " for t in texts]
    which = np.repeat(np.arange(len(texts)), np.fromiter(map(len, lowered), np.int64, len(texts)))
    points, which, _ = _spaced(_points("".join(lowered)), which)
    has = np.bincount(which[points != 32], minlength=len(texts)) > 0
    if len(points) < 3:
        return np.zeros(0, np.int64), np.zeros(0, np.int64), has
    inside = which[:-2] == which[2:]
    return which[:-2][inside], _buckets(points)[inside], has


def long_counts(text: str) -> tuple[np.ndarray, bool]:
    """The same for one text of any length, by pieces: the number of 3-grams in each bucket, and whether it has a letter."""
    lowered, counts, has, before = " " + text.lower() + " ", np.zeros(1 << BUCKET_BITS, np.int64), False, np.zeros(0, np.uint32)
    for a in range(0, len(lowered), CHARS_AT_ONCE):
        points = _points(lowered[a : a + CHARS_AT_ONCE])
        points, _, _ = _spaced(points, np.zeros(len(points), np.int64))
        if len(before) and before[-1] == 32 and points[0] == 32:
            points = points[1:]
        has |= bool((points != 32).any())
        joined = np.concatenate([before, points])
        if len(joined) >= 3:
            counts += np.bincount(_buckets(joined), minlength=1 << BUCKET_BITS)
        before = joined[-2:]
    return counts, has


def bucket_counts(texts: list[str | None]) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """For several texts, by text and bucket: the text, the bucket, the number of its 3-grams; and which texts have a letter."""
    short = [None if t and len(t) > CHARS_AT_ONCE else t for t in texts]
    which, bucket, has = ngrams(short)
    keys, n = np.unique(which << BUCKET_BITS | bucket, return_counts=True)
    for i, t in enumerate(texts):
        if t and len(t) > CHARS_AT_ONCE:
            counts, has[i] = long_counts(t)
            at = np.flatnonzero(counts)
            keys, n = np.concatenate([keys, i << BUCKET_BITS | at]), np.concatenate([n, counts[at]])
    order = np.argsort(keys, kind="stable")
    keys, n = keys[order], n[order]
    return keys >> BUCKET_BITS, keys & ((1 << BUCKET_BITS) - 1), n, has


def _batches(texts: Sequence[str | None], chars: int) -> Iterator[tuple[int, list[str | None]]]:
    """Some texts at a time, with where they start: AT_ONCE at most, and of so many characters, or one longer text."""
    first, size, held = 0, 0, []
    for i, t in enumerate(texts):
        n = len(t) if t else 0
        if held and (len(held) == AT_ONCE or size + n > chars):
            yield first, held
            first, size, held = i, 0, []
        held.append(t)
        size += n
    if held:
        yield first, held


def train(docs: DataFrame, *, text_col: str = "text", lang_col: str = "lang", smoothing: float = 0.5) -> Model:
    """Count the n-grams of all rows of `docs` with a text and a language, and smooth them to likelihoods.

    Each task adds up its own rows, so what is shuffled is at most one count a task, language and bucket.
    """

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counts: dict[str, np.ndarray] = {}

        def out() -> Iterator[pa.RecordBatch]:
            for name, own in counts.items():
                at = np.flatnonzero(own)
                yield pa.RecordBatch.from_arrays([pa.array([name] * len(at), pa.string()), pa.array(at.astype(np.int32)), pa.array(own[at])], ["lang", "bucket", "n"])

        for batch in give_back(batches):
            langs = batch.column(0).to_pylist()
            for first, texts in _batches(batch.column(1).to_pylist(), CHARS_AT_ONCE):
                owner, bucket, n, _ = bucket_counts(texts)
                names, code = np.unique(np.array(langs[first : first + len(texts)], object).astype(str), return_inverse=True)
                for i, name in enumerate(names.tolist()):
                    own = code[owner] == i
                    counts.setdefault(name, np.zeros(1 << BUCKET_BITS, np.int64))
                    counts[name] += np.bincount(bucket[own], n[own], minlength=1 << BUCKET_BITS).astype(np.int64)
                if len(counts) > 64:  # a task's memory is bounded; the sum comes after
                    yield from out()
                    counts.clear()
        yield from out()

    def smooth(table: pa.Table) -> pa.Table:
        row = np.full(1 << BUCKET_BITS, smoothing)
        row[table.column("bucket").to_numpy()] += table.column("n").to_numpy()
        return pa.table({"lang": table.column("lang")[:1], "row": pa.array([(row / row.sum()).astype(np.float32).tobytes()], pa.binary())})

    known = docs.select(F.col(lang_col).cast("string").alias("lang"), F.col(text_col).alias("text")).where("lang is not null and text is not null")
    counts = known.mapInArrow(count, "lang string, bucket int, n long").groupBy("lang", "bucket").agg(F.sum("n").alias("n"))
    rows = counts.groupBy("lang").applyInArrow(smooth, "lang string, row binary")
    found = sorted((r["lang"], r["row"]) for r in rows.limit(MAX_LANGUAGES + 1).collect())
    if len(found) > MAX_LANGUAGES:
        raise ValueError(f"more than {MAX_LANGUAGES} languages")
    table = np.frombuffer(b"".join(row for _, row in found), np.float32).reshape(len(found), 1 << BUCKET_BITS)
    return Model([lang for lang, _ in found], docs.sparkSession.sparkContext.broadcast(table))


#: Rounds of expectation-maximisation after which fits that don't change any more are put aside.
ROUNDS_BETWEEN = 4


def _fit(p: np.ndarray, n: np.ndarray, lengths: np.ndarray, theta: np.ndarray, rounds: int, change: float = 1e-4) -> tuple[np.ndarray, np.ndarray]:
    """Expectation-maximisation for documents whose rows lie one after the other, each until no share changes by more than
    `change` in a round, or for `rounds`. p: languages x rows, theta: languages x documents. Returns theta and each
    document's log-likelihood."""
    theta, open_ = theta.copy(), np.arange(len(lengths))
    op, on, own_lengths = p, n, lengths
    total = np.add.reduceat(n, np.cumsum(lengths) - lengths)
    for done in range(rounds):
        starts, before = np.cumsum(own_lengths) - own_lengths, theta[:, open_]
        mixed = np.einsum("lr,lr->r", op, np.repeat(before, own_lengths, axis=1))
        theta[:, open_] = before * np.add.reduceat(op * (on / mixed), starts, axis=1) / total[open_]
        if done % ROUNDS_BETWEEN == ROUNDS_BETWEEN - 1:
            moving = np.abs(theta[:, open_] - before).max(axis=0) > change
            if not moving.any():
                break
            if not moving.all():
                kept = np.repeat(moving, own_lengths)
                op, on, own_lengths, open_ = op[:, kept], on[kept], own_lengths[moving], open_[moving]
    mixed = np.einsum("lr,lr->r", p, np.repeat(theta, lengths, axis=1))
    return theta, np.add.reduceat(n * np.log(mixed), np.cumsum(lengths) - lengths)


def mixtures(texts: list[str | None], table: np.ndarray, *, rounds: int = 200, least: float = 0.01, penalty: float = 1.0) -> tuple[np.ndarray, np.ndarray]:
    """Language shares of each text (languages x texts), and which texts have a letter.

    The shares maximise the likelihood of the text's n-grams (`rounds` bounds the rounds of a fit that goes on changing). Of the sets of the 1, 2 ... largest languages the one with
    the best penalised likelihood is taken: log-likelihood over 3 (n-grams of 3 letters overlap), less `penalty` times
    half the log of their number for each further language. Languages outside the set have share 0. A language joins a
    set only if the fit of all languages together gives it a share of at least `least`; sets have no other bound.
    """
    owner, rows, n, has = bucket_counts(texts)
    owners, lengths = np.unique(owner, return_counts=True)
    shares = np.zeros((len(table), len(texts)))
    if not len(owners) or not len(table):
        return shares, has & bool(len(table))
    p, n = table[:, rows], n.astype(np.float32)
    theta, _ = _fit(p, n, lengths, np.full((len(table), len(owners)), 1 / len(table), np.float32), rounds)
    order = np.argsort(-theta, axis=0, kind="stable")
    rank = np.argsort(order, axis=0, kind="stable")
    cost = penalty / 2 * np.log(np.add.reduceat(n, np.cumsum(lengths) - lengths))
    found, best = _fit(p, n, lengths, (rank == 0).astype(np.float32), 0)
    best = best / 3
    for size in range(2, len(table) + 1):
        open_ = np.flatnonzero(np.where(rank == size - 1, theta, 0).sum(axis=0) >= least)
        if not len(open_):
            break
        own = np.repeat(np.isin(np.arange(len(lengths)), open_), lengths)
        start = np.where(rank < size, np.maximum(theta, 1e-6), 0)[:, open_]
        fitted, score = _fit(p[:, own], n[own], lengths[open_], (start / start.sum(axis=0)).astype(np.float32), rounds)
        score = score / 3 - cost[open_] * (size - 1)
        better = score > best[open_]
        best[open_[better]] = score[better]
        found[:, open_[better]] = fitted[:, better]
    shares[:, owners] = found / found.sum(axis=0)
    return shares, has


def identify(text: Column, model: Model, **options) -> Column:
    """A struct for each whole text: lang (the language of the largest share, ties to the first in order of name), score
    (its share, 0 to 1), langs and shares (the set of languages chosen and their shares, largest first).

    A null text, one without any letter, and any text where the model has no language gives `und`, 0 and empty arrays.
    """
    table, languages = model.table, model.languages

    @F.pandas_udf("lang string, score double, langs array<string>, shares array<double>")
    def infer(parts: Iterator[pd.Series]) -> Iterator[pd.DataFrame]:
        for part in give_back(parts):
            rows = []
            for _, texts in _batches(part.tolist(), max(1, CHARS_AT_ONCE // max(len(languages) // 8, 1))):
                shares, known = mixtures(texts, table.value, **options)
                for own, ok in zip(shares.T, known.tolist(), strict=True):
                    chosen = [i for i in np.argsort(-own, kind="stable").tolist() if own[i] > 0] if ok else []
                    if chosen:
                        rows.append((languages[chosen[0]], float(own[chosen[0]]), [languages[i] for i in chosen], own[chosen].tolist()))
                    else:
                        rows.append((UNKNOWN, 0.0, [], []))
            yield pd.DataFrame(rows, columns=["lang", "score", "langs", "shares"])

    return infer(text)


def predict(docs: DataFrame, *, held_out_of: int = 4, held_out: int = 2, id_col: str = "doc_id", text_col: str = "text", lang_col: str = "lang") -> DataFrame:
    """Learn from documents whose crc32 of the id, as text, modulo `held_out_of` is not `held_out`, and predict all.

    Returns doc_id, held_out, lang_pred, score, langs, shares. Nulls: a null id counts as an empty one and is kept; rows of
    null language or text are not learned from; for a null text see identify. Repeated rows count and are returned each.
    An empty table gives no rows. Other columns, whatever their names, are not looked at.
    """
    rest = F.crc32(F.coalesce(F.col(id_col).cast("string"), F.lit(""))) % held_out_of
    rows = docs.select(F.col(id_col).alias("doc_id"), (rest == held_out).alias("held_out"), F.col(text_col).alias("text"), F.col(lang_col).alias("lang"))
    model = train(rows.where("not held_out"))
    found = rows.select("doc_id", "held_out", identify(F.col("text"), model).alias("found"))
    return found.select("doc_id", "held_out", F.col("found.lang").alias("lang_pred"), "found.score", "found.langs", "found.shares")
