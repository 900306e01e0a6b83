"""N-gram Jaccard join with parity sketches.

A document's set holds the 64-bit hashes of its distinct shingles of ``n`` words (A-Z in lower case); a shorter
document is one shingle, one without words is empty and links with nothing.  Two link if
``100 * intersection >= percent * union``.

Set sizes are cut into bands.  A pair is looked for in the band of its larger set, whose size bounds the symmetric
difference of a linked pair by D.  Hashing spreads a set over m > D parts, each summed up by the XOR of its hashes; one
element of the difference changes one part, so a linked pair agrees in at least m - D parts (pigeonhole) and
meets under one of those keys.  Empty parts are keys only for sets with m - D or more of them, which is enough: a pair
that agrees in empty parts alone has so many on both sides.

Large groups never become all their pairs.  Equal sets are one vertex.  Under each key the members are first
compared with its smallest and largest vertex, and the links found join components.  Only keys whose members then
still lie in different components compare those across.  Every candidate is compared by parity sketches of 1024
bits, whose Hamming distance is a lower bound of the symmetric difference; texts are moved only for pairs that
these leave open, which are verified on the sets of the whole texts.
A link between two sets of one component changes nothing and is not looked for.

Rows with null ``doc_id`` link with nothing.  Rows of one ``doc_id`` with different texts are linked by their texts
only.  Sets are told apart by 64 bits.
"""

from __future__ import annotations

import math

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from factlake.llm.components import components
from factlake.llm.text import keyed, mix, passes, range_hashes, unused, utf8, Words
from factlake.session import discard, materialize

#: Ratio of the sizes at the ends of a band.
BAND = 1.3
SKETCH_LONGS = 16
#: Hashes of sets that the verification of pairs holds at once, about.
HELD_HASHES = 1 << 20
_U = np.uint64
_I = np.int64


def shingle_sets(data: np.ndarray, offsets: np.ndarray, first: int, last: int, n: int) -> list[np.ndarray]:
    """Sorted distinct shingle hashes of each row."""
    words = Words(data, offsets, first, last, lower=True)
    bounds, total = words.bounds, len(words.hashes)
    at = np.arange(max(0, total - n + 1))
    hashes = range_hashes(words.hashes, at, at + n)
    size = np.diff(bounds)
    short = np.flatnonzero((size > 0) & (size < n))
    whole = dict(zip(short.tolist(), range_hashes(words.hashes, bounds[short], bounds[short + 1])))
    return [np.unique(hashes[a : b - n + 1]) if b - a >= n else np.array([whole[k]] if b > a else [], _U) for k, (a, b) in enumerate(zip(bounds[:-1], bounds[1:]))]


def set_id(shingles: np.ndarray) -> int:
    """64 bits that stand for a set."""
    total = np.add.reduce(mix(shingles ^ _U(0x6A09E667F3BCC909)), keepdims=True, dtype=_U)
    return int(mix(total ^ mix(np.array([len(shingles)], _U))).view(_I)[0])


class Bands:
    def __init__(self, percent: int):
        if not 1 <= percent <= 100:
            raise ValueError("percent must be from 1 to 100")
        self.percent = percent
        starts = [1]
        while starts[-1] < 1 << 40:
            starts.append(max(starts[-1] + 1, math.ceil(starts[-1] * BAND)))
        self.starts = np.array(starts, _I)

    def of(self, size: int) -> range:
        """Bands in which a set of this size can be the larger or the smaller of a pair."""
        own, most = np.searchsorted(self.starts, [size, size * 100 // self.percent], side="right") - 1
        return range(int(own), int(most) + 1)

    def parts(self, band: int) -> tuple[int, int]:
        """(m, m - D) of a band; m is 0 where a link means equal sets."""
        low, high = int(self.starts[band]), int(self.starts[band + 1]) - 1
        differ = 2 * high * (100 - self.percent) // (100 + self.percent)
        if differ == 0:
            return 0, 0
        # parts to spare, so that few sets have empty parts enough to make keys of them
        spare = 1 + math.ceil(1.5 * differ * math.exp(-low * self.percent / 100 / (differ + 1)))
        return differ + 1 + spare, 1 + spare


def _keys(shingles: np.ndarray, bands: Bands) -> np.ndarray:
    out = []
    for band in bands.of(len(shingles)):
        m, least = bands.parts(band)
        if m == 0:
            continue
        part = (mix(shingles + _U(band + 1)) % _U(m)).astype(_I)
        value = np.zeros(m, _U)
        np.bitwise_xor.at(value, part, shingles)
        where = np.arange(m, dtype=_U) + (_U(band) << _U(40))
        full = np.bincount(part, minlength=m) > 0
        if m - np.count_nonzero(full) < least:
            value, where = value[full], where[full]
        out.append(mix(value ^ mix(where)))
    return np.concatenate(out).view(_I) if out else np.zeros(0, _I)


def document_sets(docs: DataFrame, n: int) -> DataFrame:
    """``doc_id``, ``text_key``, ``n_shingles`` and ``node`` (null if empty or without ``doc_id``) of every row."""

    def run(batches):
        for batch in batches:
            data, offsets = utf8(batch.column("text"))
            sizes, nodes = [], []
            for first, last in passes(offsets):
                for s in shingle_sets(data, offsets, first, last, n):
                    sizes.append(len(s))
                    nodes.append(set_id(s) if len(s) else None)
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), batch.column("text_key"), pa.array(sizes, pa.int64()), pa.array(nodes, pa.int64())], ["doc_id", "text_key", "n_shingles", "node"])

    sets = keyed(docs).mapInArrow(run, "doc_id long, text_key long, n_shingles long, node long")
    return sets.withColumn("node", F.when(F.col("doc_id").isNotNull(), F.col("node")))


def pigeonhole_keys(docs: DataFrame, n: int, percent: int) -> DataFrame:
    """``key`` and ``node`` for every part of every set; a batch gives the keys of equal sets once."""
    bands = Bands(percent)

    def run(batches):
        for batch in batches:
            batch = batch.filter(batch.column("doc_id").is_valid())
            data, offsets = utf8(batch.column("text"))
            seen: set[int] = set()
            for first, last in passes(offsets):
                keys, nodes = [np.zeros(0, _I)], [np.zeros(0, _I)]
                for s in shingle_sets(data, offsets, first, last, n):
                    if len(s) and (node := set_id(s)) not in seen:
                        seen.add(node)
                        keys.append(_keys(s, bands))
                        nodes.append(np.full(len(keys[-1]), node, _I))
                yield pa.RecordBatch.from_arrays([pa.array(np.concatenate(keys)), pa.array(np.concatenate(nodes))], ["key", "node"])

    return keyed(docs).mapInArrow(run, "key long, node long")


def _sketched(texts: DataFrame, n: int) -> DataFrame:
    """Adds ``size`` and the longs ``s0``.. of the parity sketch."""

    def run(batches):
        for batch in batches:
            data, offsets = utf8(batch.column("text"))
            sizes, sketches = [], []
            for first, last in passes(offsets):
                for s in shingle_sets(data, offsets, first, last, n):
                    bits = (mix(s ^ _U(0x3C6EF372FE94F82B)) % _U(64 * SKETCH_LONGS)).astype(_I)
                    odd = (np.bincount(bits, minlength=64 * SKETCH_LONGS) & 1).astype(np.uint8)
                    sizes.append(len(s))
                    sketches.append(np.packbits(odd).view("<i8"))
            cols = np.array(sketches, _I).reshape(-1, SKETCH_LONGS)
            yield pa.RecordBatch.from_arrays([batch.column("node"), pa.array(sizes, pa.int64()), *map(pa.array, np.ascontiguousarray(cols.T))], ["node", "size", *_LONGS])

    return texts.select("node", "text").mapInArrow(run, "node long, size long, " + ", ".join(f"{c} long" for c in _LONGS))


_LONGS = [f"s{k}" for k in range(SKETCH_LONGS)]


def _may_link(percent: int) -> Column:
    """Whether the sizes and sketches ``a_..`` and ``b_..`` of two sets leave a link open."""
    differ = sum((F.bit_count(F.col(f"a_{c}").bitwiseXOR(F.col(f"b_{c}"))) for c in _LONGS), F.lit(0))
    return (F.least("a_size", "b_size") * 100 >= F.greatest("a_size", "b_size") * percent) & (differ * (100 + percent) <= (F.col("a_size") + F.col("b_size")) * (100 - percent))


def _open(pairs: DataFrame, sketches: DataFrame, percent: int) -> DataFrame:
    """The pairs ``(a, b)`` that may link by their sketches."""
    for side in "ab":
        pairs = pairs.join(sketches.select(*(F.col(c).alias(side if c == "node" else f"{side}_{c}") for c in ("node", "size", *_LONGS))), side)
    return pairs.where(_may_link(percent)).select("a", "b")


def _verified(pairs: DataFrame, texts: DataFrame, n: int, percent: int) -> DataFrame:
    """The pairs ``(a, b)`` that link."""
    pairs = materialize(pairs)  # what was shuffled to find them is gone before texts are moved
    left = texts.select(F.col("node").alias("a"), F.col("text").alias("text_a"))
    right = texts.select(F.col("node").alias("b"), F.col("text").alias("text_b"))

    def run(batches):
        for batch in batches:
            known: dict[int, np.ndarray] = {}
            held = 0
            sides = [(batch.column(node).to_pylist(), *utf8(batch.column(text))) for node, text in (("a", "text_a"), ("b", "text_b"))]
            good = []
            for k in range(len(batch)):
                if held > HELD_HASHES:
                    known, held = {}, 0
                for ids, data, offsets in sides:
                    if ids[k] not in known:
                        known[ids[k]] = shingle_sets(data, offsets, k, k + 1, n)[0]
                        held += len(known[ids[k]])
                x, y = (known[ids[k]] for ids, *_ in sides)
                if 100 * min(len(x), len(y)) < percent * max(len(x), len(y)):
                    good.append(False)
                    continue
                both = np.concatenate([x, y])
                both.sort()
                common = int(np.count_nonzero(both[1:] == both[:-1]))
                good.append(100 * common >= percent * (len(both) - common))
            yield batch.select(["a", "b"]).filter(pa.array(good, pa.bool_()))

    return pairs.join(left, "a").join(right, "b").select("a", "b", "text_a", "text_b").mapInArrow(run, "a long, b long")


def linked_components(docs: DataFrame, n: int = 5, percent: int = 80) -> DataFrame:
    """``doc_id``, ``text_key``, ``n_shingles``, ``component_id`` (smallest ``doc_id`` reachable by links) and ``head_key`` (text key of that document) of every row."""
    docs = keyed(docs)
    sets = materialize(document_sets(docs, n))
    classes = materialize(sets.where("node IS NOT NULL").groupBy("node").agg(F.min(F.struct("doc_id", "text_key")).alias("first")).select("node", "first.*"))

    by_key = Window.partitionBy("key")
    met = pigeonhole_keys(docs, n, percent).withColumns({"least": F.min("node").over(by_key), "most": F.max("node").over(by_key)})
    met = materialize(met.where("least < most").distinct())
    wanted = met.select("node").distinct().join(classes, "node")
    texts = materialize(docs.join(wanted, ["doc_id", "text_key"]).dropDuplicates(["doc_id", "text_key", "node"]).select("node", "text"))
    sketches = materialize(_sketched(texts, n))

    # one partner each
    one = materialize(met.where("node > least").groupBy("node").agg(F.min("least").alias("b")).select(F.col("node").alias("a"), "b"))
    links = materialize(_verified(_open(one, sketches, percent), texts, n, percent))
    parts = materialize(components(links))

    # every further smallest and largest one of a key, where it would join components
    def whole(df: DataFrame, node: str, name: str) -> DataFrame:
        known = parts.select(F.col("node").alias(node), F.col("component").alias(name))
        return df.join(known, node, "left").withColumn(name, F.coalesce(name, node))

    more = met.where("node > least").select(F.col("node").alias("a"), F.col("least").alias("b"))
    more = more.union(met.where("node < most").select(F.col("most").alias("a"), F.col("node").alias("b"))).distinct()
    more = whole(whole(more.join(one, ["a", "b"], "left_anti"), "a", "part_a"), "b", "part_b").where("part_a != part_b").select("a", "b")
    links = materialize(links.union(_verified(_open(more, sketches, percent), texts, n, percent)))
    parts = materialize(components(links))

    # what is left under a key: members of different components
    held = whole(met.select("key", "node"), "node", "part")
    apart = held.groupBy("key").agg(F.min("part").alias("x"), F.max("part").alias("y")).where("x < y").select("key")
    left_over = materialize(held.join(apart, "key", "left_semi"))
    side = left_over.join(sketches, "node")
    a = side.select("key", *(F.col(c).alias(f"a_{c}") for c in ("node", "part", "size", *_LONGS)))
    b = side.select("key", *(F.col(c).alias(f"b_{c}") for c in ("node", "part", "size", *_LONGS)))
    near = (F.col("a_key") == F.col("b_key")) & (F.col("a_node") > F.col("b_node")) & (F.col("a_part") != F.col("b_part")) & _may_link(percent)
    across = a.withColumnRenamed("key", "a_key").join(b.withColumnRenamed("key", "b_key"), near)
    across = across.select(F.col("a_node").alias("a"), F.col("b_node").alias("b")).distinct()
    links = materialize(links.union(_verified(across, texts, n, percent)))
    parts = materialize(components(links))
    discard(met, texts, sketches, left_over)

    of_class = whole(classes, "node", "part")
    head = of_class.groupBy("part").agg(F.min(F.struct("doc_id", "text_key")).alias("head"))
    named = of_class.join(head, "part").select("node", F.col("head.doc_id").alias("component_id"), F.col("head.text_key").alias("head_key"))
    return sets.join(named, "node", "left").select("doc_id", "text_key", "n_shingles", F.coalesce("component_id", "doc_id").alias("component_id"), F.coalesce("head_key", "text_key").alias("head_key"))


def keep_one(docs: DataFrame, n: int = 5, percent: int = 80) -> DataFrame:
    """One row of each group of linked rows of ``docs``, unchanged: that with the smallest ``doc_id``, once if it repeats.

    Rows without words and rows with null ``doc_id`` link with nothing and all stay.
    """
    key, doc, is_head, nth = unused(docs, "__text_key", "__doc_id", "__head", "__copy")
    rows = docs.withColumns({doc: F.col("doc_id").cast("long"), key: F.xxhash64(F.col("text").cast("string"))})
    found = linked_components(docs, n, percent).where("doc_id IS NOT NULL AND n_shingles > 0")
    head = (F.col("doc_id") == F.col("component_id")) & (F.col("text_key") == F.col("head_key"))
    verdict = found.groupBy(F.col("doc_id").alias(doc), F.col("text_key").alias(key)).agg(F.max(head).alias(is_head))
    copy = Window.partitionBy(doc, key).orderBy(F.xxhash64(*docs.columns))
    judged = rows.where(F.col(doc).isNotNull()).join(verdict, [doc, key], "left").withColumn(nth, F.row_number().over(copy))
    stay = judged.where(F.col(is_head).isNull() | (F.col(is_head) & (F.col(nth) == 1))).select(*(judged[f"`{c}`"] for c in docs.columns))
    return stay.union(docs.where(F.col("doc_id").cast("long").isNull()))
