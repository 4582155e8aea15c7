"""Best-fit-decreasing packing of token sequences, with a segment tree over remaining capacities."""

from __future__ import annotations

import json
import os
import re
import sys
import types
import unicodedata
import zlib
from array import array
from collections.abc import Iterable, Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .common import give_back, running_total, stage

#: Words whose ids a worker keeps at once; beyond it they are made anew, so this bounds memory and
#: nothing else.
KEPT_WORDS = 400_000
#: The apostrophe is none of these marks: with letters after it, it can be a token of its own.
MARKS = b".,;:!?%$&*#|"
#: Words of lower-case Latin letters that no normalisation changes: where `_model_alone` holds, the tokenizer's model can be
#: asked directly.
PLAIN = re.compile(rb"(?:[a-z]|\xc3[\x9f-\xb6\xb8-\xbf])+")
#: How byte-level models write bytes that are no printable Latin-1 character: as the characters from 256 on, in order.
BYTES = {b: 256 + i for i, b in enumerate(b for b in range(256) if not (0x21 <= b <= 0x7E or 0xA1 <= b <= 0xAC or 0xAE <= b))}
#: Documents turned into ids at a time.
AT_ONCE = 256


class Capacities:
    """Which remaining capacities have open bins: a segment tree, asked for the tightest fit in logarithmic time."""

    def __init__(self, capacity: int):
        self.leaves = 1 << capacity.bit_length()
        self.open = [0] * (2 * self.leaves)

    def add(self, remaining: int, change: int) -> None:
        at = self.leaves + remaining
        while at:
            self.open[at] += change
            at >>= 1

    def tightest(self, length: int) -> int | None:
        """The least remaining capacity of at least `length` that has an open bin."""
        at = self.leaves + length
        if self.open[at]:
            return length
        while at > 1:  # up, to the first subtree on the right that has one
            if not at & 1 and self.open[at + 1]:
                at += 1
                break
            at >>= 1
        else:
            return None
        while at < self.leaves:  # down, to its leftmost
            at = 2 * at if self.open[2 * at] else 2 * at + 1
        return at - self.leaves


def best_fit_decreasing(counts: dict[int, int], capacity: int) -> np.ndarray:
    """Where best-fit decreasing puts `counts[length]` pieces of each length.

    Returns rows (length, first rank, first bin, pieces a bin, offset): from that rank on among the pieces of that
    length, so many at a time go to one bin after the other, from that offset. Pieces are placed longest first, each in
    the open bin that it fills most. Bins alike in content stay together as one run, and a run takes all pieces that
    it would take one by one: after a piece the same bin is the tightest as long as it has room. A step ends a run or a
    length, and a bin's room at least halves when it ends; so the steps are bounded by the capacity (about 4 capacity
    log2 capacity), however many pieces there are.
    """
    tree, runs, rows, bins = Capacities(capacity), {}, [], 0

    def put(remaining: int, first: int, count: int) -> None:
        if count and remaining:
            runs.setdefault(remaining, []).append((first, count))
            tree.add(remaining, 1)

    for length in sorted(counts, reverse=True):
        left, rank = counts[length], 0
        while left:
            room = tree.tightest(length)
            if room is None:
                room, first, count = capacity, bins, -(-left // (capacity // length))
                bins += count
            else:
                first, count = runs[room].pop()
                tree.add(room, -1)
            each = room // length
            full = min(count, left // each)
            if full:
                rows.append((length, rank, first, each, capacity - room))
                put(room - each * length, first, full)
                left, rank = left - full * each, rank + full * each
            if left and full < count:
                rows.append((length, rank, first + full, left, capacity - room))
                put(room - left * length, first + full, 1)
                left, full = 0, full + 1
            put(room, first + full, count - full)
    return np.array(rows, np.int64).reshape(-1, 5)


@lru_cache(maxsize=1 << 16)
def _ends_in_letter(last: str) -> bool:
    """Whether a word that ends in the character `last` ends in a letter for the tokenizer too, which composes and lower-cases
    before it cuts: some letters become a letter and a combining mark, and that goes with the marks after it."""
    return last.isalpha() and unicodedata.normalize("NFC", unicodedata.normalize("NFC", last).lower())[-1].isalpha()


def _model_alone(tokenizer) -> bool:
    """Whether all that happens to a plain word before the model sees it is that its bytes are written as characters: the
    normalisers leave lower-case precomposed letters alone, the split takes a run of letters whole, and no added token can
    start within one."""
    spec = json.loads(tokenizer.to_str())
    steps = lambda part, name: (part or {}).get(name, [part] if part else [])
    normal = [n["type"] for n in steps(spec["normalizer"], "normalizers") if n != {"type": "Replace", "pattern": {"Regex": r"\s+"}, "content": " "}]
    cuts = steps(spec["pre_tokenizer"], "pretokenizers")
    split = [c for c in cuts if c["type"] == "Split"]
    rest = [c for c in cuts if c["type"] != "Split"]
    whole = len(split) == 1 and split[0]["invert"] and r"|[\p{L}]+|" in split[0]["pattern"].get("Regex", "") and split[0]["pattern"]["Regex"].startswith("'")
    levels = len(rest) == 1 and rest[0]["type"] == "ByteLevel" and not rest[0]["add_prefix_space"] and not rest[0]["use_regex"]
    added = any(re.match(r"[a-z\u00df-\u00f6\u00f8-\u00ff]", t["content"]) for t in spec["added_tokens"])
    return set(normal) <= {"NFC", "Lowercase"} and whole and levels and spec["post_processor"] is None and not added and not spec["model"].get("dropout")


def _direct(model, word: bytes) -> bytes:
    """The ids of a plain word from the tokenizer's model alone: a model over bytes, each written as one character."""
    text = word.decode() if word.isascii() else word.decode("latin-1").translate(BYTES)
    return array("I", [t.id for t in model.tokenize(text)]).tobytes()


def _ids_of(words: list[list[bytes]], path: str, kept_words: int) -> dict[bytes, bytes]:
    """A table with the ids of each lower-cased word, packed as little-endian 32-bit numbers.

    A word with a tail of marks after a letter is put together from those two, as the tokenizer always cuts between a
    letter and a mark (see _ends_in_letter); so it sees few of the words. The table stays from task to task in the worker. When it is full,
    it gives way to a new one, which takes over the words that still come up.
    """
    kept = sys.modules.setdefault("_fieldglass_words", types.ModuleType("_fieldglass_words")).__dict__
    if kept.get("path") != path:
        os.environ["TOKENIZERS_PARALLELISM"] = "false"  # an executor's cores are taken by its tasks
        from tokenizers import Tokenizer

        made = Tokenizer.from_file(path)
        probes = ["a", "the", "zzqx", "größe", "ÿ", "çàéß", "internationalisation"]
        ids = [array("I", made.encode(p, add_special_tokens=False).ids).tobytes() for p in probes]
        kept |= {"path": path, "tokenizer": made, "model": made.model, "ids": {}, "old": {}}
        kept["direct"] = _model_alone(made) and ids == [_direct(made.model, p.encode()) for p in probes]
    if len(kept["ids"]) > kept_words:
        kept["old"], kept["ids"] = kept["ids"], {}
    ids, old = kept["ids"], kept["old"]
    missing, tails = set(), []
    for word in set().union(*words).difference(ids):
        if (found := old.get(word)) is not None:
            ids[word] = found
            continue
        stem = word.rstrip(MARKS)
        if len(stem) < len(word) and stem and (97 <= stem[-1] <= 122 or (stem[-1] > 127 and _ends_in_letter(stem.decode()[-1]))):
            tail = word[len(stem) :]
            tails.append((word, stem, tail))
            for part in (stem, tail):
                if part not in ids:
                    if (found := old.get(part)) is not None:
                        ids[part] = found
                    else:
                        missing.add(part)
        else:
            missing.add(word)
    if kept["direct"]:
        plain = [w for w in missing if PLAIN.fullmatch(w)]
        ids.update((w, _direct(kept["model"], w)) for w in plain)
        missing.difference_update(plain)
    missing = list(missing)
    for i in range(0, len(missing), 4096):
        some = missing[i : i + 4096]
        made = kept["tokenizer"].encode_batch_fast([w.decode() for w in some], add_special_tokens=False)
        ids.update((w, array("I", e.ids).tobytes()) for w, e in zip(some, made, strict=True))
    ids.update([(word, ids[stem] + ids[tail]) for word, stem, tail in tails])
    return ids


def token_bytes(texts: Iterable[str | None], path: str, end_id: int | None, kept_words: int = KEPT_WORDS) -> Iterator[bytes]:
    """For each text the ids of its words, then `end_id`, as little-endian 32-bit numbers.

    A tokenizer that ignores case, drops white space and looks at nothing across it gives the same ids word by word as for
    the whole text; words repeat, so most are looked up.
    """
    end = b"" if end_id is None else end_id.to_bytes(4, "little")
    words = [(t or "").encode("utf-8", "replace").lower().split() for t in texts]
    ids = _ids_of(words, path, kept_words)
    for own in words:
        yield b"".join(map(ids.__getitem__, own)) + end


def cut_pieces(docs: DataFrame, path: str, *, capacity: int = 4096, end_id: int | None = 1, keep_ids: bool = False, kept_words: int = KEPT_WORDS, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Each document's ids, cut where they are longer than `capacity`: doc_id, piece, start, length, ids_crc32 and, with
    `keep_ids`, ids (array of int). A document without ids makes no piece.

    `path` is the tokenizer's file; it must be one that ignores case and drops white space.
    """
    ids_type = [T.StructField("ids", T.ArrayType(T.IntegerType()))] if keep_ids else []
    id_type = docs.schema[id_col].dataType
    schema = T.StructType([T.StructField("doc_id", id_type), T.StructField("piece", T.IntegerType()), *(T.StructField(c, T.LongType()) for c in ("start", "length", "ids_crc32")), *ids_type])
    size = 4 * capacity

    def pieces(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in give_back(batches):
            for at in range(0, batch.num_rows, AT_ONCE):
                own = batch.slice(at, AT_ONCE)
                which, rows, ids = [], [], []
                for i, packed in enumerate(token_bytes(own.column(1).to_pylist(), path, end_id, kept_words)):
                    for k, a in enumerate(range(0, len(packed), size)):
                        part = packed[a : a + size]
                        which.append(i)
                        rows.append((k, a // 4, len(part) // 4, zlib.crc32(part)))
                        if keep_ids:
                            ids.append(np.frombuffer(part, "<i4"))
                table = np.array(rows, np.int64).reshape(-1, 4)
                columns = [own.column(0).take(pa.array(which, pa.int64())), pa.array(table[:, 0].astype(np.int32)), *(pa.array(table[:, j]) for j in (1, 2, 3))]
                if keep_ids:
                    columns.append(pa.array(ids, pa.list_(pa.int32())))
                yield pa.RecordBatch.from_arrays(columns, schema.names)

    return docs.select(F.col(id_col).alias("doc_id"), F.col(text_col).alias("text")).mapInArrow(pieces, schema)


def pack(docs: DataFrame, path: str, *, capacity: int = 4096, end_id: int | None = 1, keep_ids: bool = False, kept_words: int = KEPT_WORDS, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Pack all documents into sequences of at most `capacity` ids: doc_id, piece, start, length, ids_crc32, sequence_id,
    offset and, with `keep_ids`, ids.

    Only the number of pieces of each length goes to the driver (at most `capacity` numbers), where best-fit decreasing
    packs all pieces of the corpus at once. A piece's rank among those of its length then tells its place. `kept_words`
    trades a worker's memory (about 250 bytes a word, twice) for time.

    Nulls: a null text counts as an empty one, which has only the end id; a null id is kept. Repeated rows are packed
    each. Ties between pieces of one length go by id, piece and place in the input. An empty table gives no rows. Other
    columns, whatever their names, are not looked at.
    """
    spark = docs.sparkSession
    cut = cut_pieces(docs, path, capacity=capacity, end_id=end_id, keep_ids=keep_ids, kept_words=kept_words, id_col=id_col, text_col=text_col)
    cut = stage(cut.withColumn("row", F.monotonically_increasing_id()))
    counts = {r["length"]: r["count"] for r in cut.groupBy("length").count().collect()}
    rows = best_fit_decreasing(counts, capacity)
    rows = rows[np.lexsort((rows[:, 1], rows[:, 0]))]
    #: Bounded by the capacity, not by the data; see best_fit_decreasing.
    plan = spark.sparkContext.broadcast((rows[:, 0] << 44 | rows[:, 1], rows[:, 1], rows[:, 2], rows[:, 3], rows[:, 4]))

    narrow = cut.select("length", "doc_id", "piece", "row", F.lit(1).cast("long").alias("one"))
    ranked = running_total(narrow, ["length"], ["doc_id", "piece", "row"], {"rank": "one"})

    @F.pandas_udf("sequence_id long, offset long")
    def place(length, rank):
        import pandas as pd

        keys, firsts, bins, each, offsets = plan.value
        length, rank = length.to_numpy(), rank.to_numpy()
        at = np.searchsorted(keys, length << 44 | rank, side="right") - 1
        bin_, slot = np.divmod(rank - firsts[at], each[at])
        return pd.DataFrame({"sequence_id": bins[at] + bin_, "offset": offsets[at] + slot * length})

    placed = ranked.select("row", place("length", "rank").alias("place")).select("row", "place.*")
    return cut.join(placed, "row").drop("row").select("doc_id", "piece", "start", "length", "ids_crc32", "sequence_id", "offset", *(["ids"] if keep_ids else []))
