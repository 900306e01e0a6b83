"""Substring dedup by seed and extend.

A window is ``window`` consecutive words of one document.  Winnowing picks in every window the seed of
``seed`` words with the smallest hash (the last of equal ones), so equal windows pick the same seed at the same
place.  The consecutive windows around one seed are a stretch: the seed extended both ways as far as
the seed stays the pick.  Documents meet on seeds:

- all stretches of the seed are equal: each in a document that is not the smallest is a repeat;
- they differ: one document per different stretch extends it window by window, and a window that also
  starts in a smaller document is a repeat.

Repeats that overlap are merged to maximal spans, and every word inside is removed.  Hashes have 64 bits.

Definitions: words are maximal runs of anything but 0x20 and 0x09-0x0D, unchanged.  Null text has no words.  A
row with null ``doc_id`` neither removes nor loses anything.  Rows with one ``doc_id`` are one document to each other:
none of them is smaller, so they lose nothing to each other.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from factlake.llm.text import Words, keyed, mix, passes, range_hashes, utf8
from factlake.session import materialize

WINDOW = 13
SEED = 5
_U = np.uint64


def _windows(words: Words, window: int) -> np.ndarray:
    """First word of every window."""
    n = len(words.hashes) - window + 1
    if n <= 0:
        return np.zeros(0, np.int64)
    return np.flatnonzero(words.row[:n] == words.row[window - 1 :])


def _picks(words: Words, window: int, seed: int) -> np.ndarray:
    """Place of the seed that each run of ``window`` words picks (runs across documents included)."""
    at = np.arange(len(words.hashes) - seed + 1)
    grams = range_hashes(words.hashes, at, at + seed)
    width = window - seed + 1
    least, span = grams, 1
    while span * 2 <= width:
        least = np.minimum(least[:-span], least[span:])
        span *= 2
    if span < width:
        least = np.minimum(least[: len(least) - (width - span)], least[width - span :])
    pick = np.zeros(len(least), np.int64)
    for k in range(width):
        pick = np.where(grams[k : k + len(least)] == least, at[k : k + len(least)], pick)
    return pick


def stretches(docs: DataFrame, window: int = WINDOW, seed: int = SEED) -> DataFrame:
    """``doc_id``, ``text_key``, ``start`` (word), ``n_windows``, ``seed`` and ``stretch`` hashes.

    In a batch only the smallest document of equal stretches keeps its seed hash.  The others are repeats for certain; they
    get a seed of their own, so that a passage that is everywhere is not shuffled to one place.
    """

    def run(batches):
        for batch in batches:
            batch = batch.filter(batch.column("doc_id").is_valid())
            ids = batch.column("doc_id").to_numpy(zero_copy_only=False)
            keys = batch.column("text_key").to_numpy()
            data, offsets = utf8(batch.column("text"))
            for first, last in passes(offsets):
                words = Words(data, offsets, first, last)
                starts = _windows(words, window)
                if not len(starts):
                    continue
                pick = _picks(words, window, seed)[starts]
                new = np.append(True, (np.diff(pick) != 0) | (np.diff(words.row[starts]) != 0))
                a = np.flatnonzero(new)
                n = np.diff(np.append(a, len(starts)))
                begin, place = starts[a], pick[a]
                seeds = range_hashes(words.hashes, place, place + seed)
                shape = ((place - begin).astype(_U) << _U(32)) | n.astype(_U)
                whole = mix(range_hashes(words.hashes, begin, begin + n + window - 1) ^ mix(shape))
                row = words.row[begin]
                doc = ids[first + row]
                order = np.lexsort((doc, whole))
                same = np.append(False, whole[order][1:] == whole[order][:-1])
                head = np.maximum.accumulate(np.where(same, 0, np.arange(len(order))))
                sure = np.zeros(len(order), bool)
                sure[order] = doc[order] > doc[order][head]
                seeds = np.where(sure, mix(seeds ^ mix(doc.astype(_U) * _U(0x9FB21C651E98DF25) ^ begin.astype(_U))), seeds)
                yield pa.RecordBatch.from_arrays(
                    [
                        pa.array(doc.astype(np.int64)),
                        pa.array(keys[first + row]),
                        pa.array((begin - words.bounds[row]).astype(np.int32)),
                        pa.array(n.astype(np.int32)),
                        pa.array(seeds.view(np.int64)),
                        pa.array(whole.view(np.int64)),
                        pa.array(sure),
                    ],
                    ["doc_id", "text_key", "start", "n_windows", "seed", "stretch", "sure"],
                )

    return keyed(docs).mapInArrow(run, "doc_id long, text_key long, start int, n_windows int, seed long, stretch long, sure boolean")


def _window_hashes(docs: DataFrame, wanted: DataFrame, window: int) -> DataFrame:
    """``doc_id``, ``text_key``, ``start`` and ``hash`` of the windows that ``wanted(doc_id, text_key, spans)`` names."""

    def run(batches):
        for batch in batches:
            data, offsets = utf8(batch.column("text"))
            ids, keys = batch.column("doc_id").to_numpy(), batch.column("text_key").to_numpy()
            spans = batch.column("spans").to_pylist()
            for first, last in passes(offsets):
                words = Words(data, offsets, first, last)
                rows, starts = [], []
                for k in range(last - first):
                    named = np.concatenate([np.arange(s["start"], s["start"] + s["n_windows"]) for s in spans[first + k]])
                    rows.append(np.full(len(named), k))
                    starts.append(named)
                rows, starts = np.concatenate(rows), np.concatenate(starts).astype(np.int64)
                at = words.bounds[rows] + starts
                yield pa.RecordBatch.from_arrays(
                    [pa.array(ids[first + rows]), pa.array(keys[first + rows]), pa.array(starts.astype(np.int32)), pa.array(range_hashes(words.hashes, at, at + window).view(np.int64))],
                    ["doc_id", "text_key", "start", "hash"],
                )

    return docs.join(wanted, ["doc_id", "text_key"]).select("doc_id", "text_key", "text", "spans").mapInArrow(run, "doc_id long, text_key long, start int, hash long")


def repeated_windows(docs: DataFrame, window: int = WINDOW, seed: int = SEED) -> DataFrame:
    """``doc_id``, ``text_key``, ``start``, ``n_windows``: runs of windows that also start in a smaller document."""
    docs = keyed(docs)
    by_seed, by_stretch = Window.partitionBy("seed"), Window.partitionBy("seed", "stretch")
    met = (
        stretches(docs, window, seed)
        .withColumns({"least": F.min("doc_id").over(by_seed), "most": F.max("doc_id").over(by_seed), "differ": F.min("stretch").over(by_seed) != F.max("stretch").over(by_seed)})
        .where("sure OR least < most")
        .withColumn("first", F.min("doc_id").over(by_stretch))
        .withColumn("repeat", F.col("sure") | (F.col("doc_id") > F.col("first")))
        .where("repeat OR differ")
        .select("doc_id", "text_key", "start", "n_windows", "repeat")
    )
    met = materialize(met)
    repeats = met.where("repeat").drop("repeat")
    open_spans = met.where("NOT repeat").groupBy("doc_id", "text_key").agg(F.collect_list(F.struct("start", "n_windows")).alias("spans"))
    extended = _window_hashes(docs, open_spans, window).withColumn("first", F.min("doc_id").over(Window.partitionBy("hash"))).where("doc_id > first")
    return repeats.union(extended.select("doc_id", "text_key", "start", F.lit(1).alias("n_windows")))


def remove_repeats(docs: DataFrame, window: int = WINDOW, seed: int = SEED, keep: tuple[str, ...] = ()) -> DataFrame:
    """``doc_id``, ``text`` (as it came), ``kept`` (kept words joined by one space), ``n_words``, ``n_removed`` and ``spans``
    (maximal repeats as first word and number of words) of every row, with the columns ``keep`` of ``docs`` after them."""
    found = repeated_windows(docs, window, seed).groupBy("doc_id", "text_key").agg(F.collect_list(F.struct("start", "n_windows")).alias("found"))
    found = materialize(found)  # what was shuffled to find them is gone before whole rows are moved
    more = [F.col(c).alias(f"keep_{k}") for k, c in enumerate(keep)]
    names = [f"keep_{k}" for k in range(len(keep))]
    rows = docs.select(*more, F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text")).withColumn("text_key", F.xxhash64("text"))
    schema = "doc_id long, text string, kept string, n_words long, n_removed long, spans array<struct<first:int,n:int>>"
    schema += "".join(f", keep_{k} {docs.schema[c].dataType.simpleString()}" for k, c in enumerate(keep))
    joined = rows.join(found, ["doc_id", "text_key"], "left").select("doc_id", "text", "found", *names)
    out = joined.mapInArrow(lambda batches: _cut(batches, window, names), schema)
    return out.select(*out.columns[:6], *(F.col(f"keep_{k}").alias(c) for k, c in enumerate(keep)))


_SPANS = pa.list_(pa.struct([("first", pa.int32()), ("n", pa.int32())]))


def _cut(batches, window: int, names: list[str]):
    for batch in batches:
        data, offsets = utf8(batch.column("text"))
        found = batch.column("found").to_pylist()
        for first, last in passes(offsets):
            words = Words(data, offsets, first, last)
            kept, n_words, n_removed, spans = [], [], [], []
            for k in range(last - first):
                a, b = words.bounds[k], words.bounds[k + 1]
                gone = np.zeros(b - a + 1, np.int64)
                for s in found[first + k] or ():
                    gone[s["start"]] += 1
                    gone[s["start"] + s["n_windows"] + window - 1] -= 1
                out = np.cumsum(gone)[:-1] > 0
                edge = np.flatnonzero(np.diff(np.concatenate([[False], out, [False]]).astype(np.int8)))
                spans.append([{"first": int(i), "n": int(j - i)} for i, j in zip(edge[::2], edge[1::2])])
                raw = words.bytes[words.starts[a] : words.ends[b - 1]].tobytes() if b > a else b""
                zero = words.starts[a] if b > a else 0
                stay = np.flatnonzero(~out)
                # runs of kept words are taken at once; only the white space in them is made even
                runs = np.split(stay, np.flatnonzero(np.diff(stay) != 1) + 1) if len(stay) else []
                parts = [b" ".join(raw[words.starts[a + r[0]] - zero : words.ends[a + r[-1]] - zero].split()) for r in runs]
                kept.append(b" ".join(parts).decode())
                n_words.append(b - a)
                n_removed.append(int(out.sum()))
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column("doc_id").slice(first, last - first),
                    batch.column("text").slice(first, last - first),
                    pa.array(kept, pa.string()),
                    pa.array(n_words, pa.int64()),
                    pa.array(n_removed, pa.int64()),
                    pa.array(spans, _SPANS),
                    *(batch.column(c).slice(first, last - first) for c in names),
                ],
                ["doc_id", "text", "kept", "n_words", "n_removed", "spans", *names],
            )
