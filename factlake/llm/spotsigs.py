"""Document fingerprints by SpotSigs.

A text is lower-cased (A-Z) and cut into words at white space and ASCII punctuation.  Every common word (``ANCHORS``) gives a
signature: the hash of the anchor and the chain of the next ``CHAIN`` content words, common words between them skipped (of
the next words as they are, where ``REACH`` words hold too few content words).  In a stretch without common words every word
after ``REACH`` others anchors too.  A signature used k times counts k times.  The set of signatures, sorted, is the
fingerprint.  A text of fewer than ``SHORT`` words, which may hold hardly any signature, also carries the set of its 4-byte
grams.

The likeness of two fingerprints is the Jaccard similarity of their signatures where both have ``LEAST_SPOTS`` or more,
else that of their grams where both carry them, else that of their signatures; equal fingerprints have likeness 1.

``near_pairs`` partitions sets by their number of signatures, so that a set meets only those of its own and of the next
partition, and compares through rare signatures first: a pair is looked at only if their numbers of signatures allow
the threshold, and one shared signature lies among the rarest few of both.

A null text is an empty one.  Rows that repeat, and null keys, come out as they came in; further columns do no harm; an
empty table gives no rows.
"""

from __future__ import annotations

import hashlib
import math
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from factlake.llm.text import Words, documents, mix, passes, utf8
from factlake.session import materialize

#: Common words of English, German, French and Spanish that anchor signatures.
ANCHORS = tuple(
    "the of and to a in is that it for on was with as be by this are at from or an not "
    "der die und den von zu das mit sich für des auf ist im nicht dem eine ein als auch "
    "de la le et les un du une est que pour dans qui au par sur pas avec "
    "el en y los se del las por con para una no su al lo".split()
)
CHAIN = 2
#: Words that a chain may span, and that a stretch without common words has before its words anchor.
REACH = 12
SHORT = 64
LEAST_SPOTS = 8
GRAM = 4
#: Bytes of text that one task takes, about.
BLOCK_BYTES = 16 << 20

_U = np.uint64
_FOLD = np.array([b if b >= 128 or chr(b).isalnum() else 32 for b in range(256)], np.uint8)
_FOLD[65:91] += 32


def _word_hashes(words: tuple[str, ...]) -> np.ndarray:
    column = pa.array([" ".join(words)], pa.string())
    data, offsets = utf8(column)
    return np.unique(Words(data, offsets, 0, 1).hashes)


_ANCHORED: dict[tuple[str, ...], np.ndarray] = {}


def _anchor_hashes(anchors: tuple[str, ...]) -> np.ndarray:
    if anchors not in _ANCHORED:
        _ANCHORED[anchors] = _word_hashes(anchors)
    return _ANCHORED[anchors]


def _grams(folded: bytes) -> np.ndarray:
    """Hashes of the 4-byte grams of a folded text with single spaces; a shorter text is one gram."""
    data = np.frombuffer(b" ".join(folded.split()), np.uint8).astype(np.uint32)
    if not len(data):
        return np.zeros(0, np.uint32)
    if len(data) < GRAM:
        data = np.append(data, np.zeros(GRAM - len(data), np.uint32))
    return np.unique(sum(data[k : len(data) - GRAM + 1 + k] << np.uint32(8 * k) for k in range(GRAM)))


def _signatures(words: Words, common: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Row and hash of every signature; the k-th use of one signature in a row has a hash of its own."""
    n = len(common)
    place = np.arange(n)
    last_common = np.maximum.accumulate(np.where(common, place, -1)) if n else place
    start, end = words.bounds[words.row], words.bounds[words.row + 1]
    spot = np.flatnonzero(common | (place - np.maximum(last_common, start) >= REACH))
    content = np.append(np.flatnonzero(~common), np.full(CHAIN, n + REACH + 1))
    nth = np.searchsorted(content, spot, "right")
    far = np.minimum(end[spot] - 1, spot + REACH)
    chained = content[nth + CHAIN - 1] <= far
    links = [np.where(chained, content[nth + k], spot + 1 + k) for k in range(CHAIN)]
    fits = links[-1] < end[spot]
    spot, links = spot[fits], [x[fits] for x in links]
    row, value = words.row[spot], words.hashes[spot]
    for x in links:
        value = mix(value * _U(3) + words.hashes[x])
    order = np.lexsort((value, row))
    row, value = row[order], value[order]
    new = np.ones(len(row), bool)
    new[1:] = (row[1:] != row[:-1]) | (value[1:] != value[:-1])
    at = np.arange(len(row))
    use = at - np.maximum.accumulate(np.where(new, at, 0)) if len(row) else at
    return row, mix(value + use.astype(_U) * _U(0x9E3779B97F4A7C15))


class Sets:
    """Signatures of consecutive rows: ``keys`` (row in the high, signature in the low 32 bits, sorted) and the grams of short rows."""

    def __init__(self, texts: pa.Array, anchors: tuple[str, ...] = ANCHORS):
        data, offsets = utf8(texts)
        self.n = len(offsets) - 1
        self.grams: list[np.ndarray | None] = [None] * self.n
        found = [np.zeros(0, _U)]
        for first, last in passes(offsets):
            base, end = int(offsets[first]), int(offsets[last])
            folded = _FOLD[data[base:end]]
            own = offsets[first : last + 1] - base
            words = Words(folded, own, 0, last - first)
            row, value = _signatures(words, np.isin(words.hashes, _anchor_hashes(anchors)))
            found.append(np.unique((row + first).astype(_U) << _U(32) | value >> _U(32)))
            for k in np.flatnonzero(np.diff(words.bounds) < SHORT):
                self.grams[first + k] = _grams(folded[own[k] : own[k + 1]].tobytes())
        self.keys = np.concatenate(found)
        self.bounds = np.searchsorted(self.keys, np.arange(self.n + 1, dtype=_U) << _U(32))

    def sizes(self) -> np.ndarray:
        return np.diff(self.bounds)

    def fingerprints(self) -> list[str]:
        spots = (self.keys & _U(0xFFFFFFFF)).astype(">u4")
        out = []
        for k in range(self.n):
            text = spots[self.bounds[k] : self.bounds[k + 1]].tobytes().hex()
            grams = self.grams[k]
            out.append(text if grams is None else f"{text}-{grams.astype('>u4').tobytes().hex()}")
        return out

    def likeness(self, other: Sets) -> np.ndarray:
        """Likeness of each row to the row of the same number in ``other``."""
        common = np.bincount((np.intersect1d(self.keys, other.keys, assume_unique=True) >> _U(32)).astype(np.int64), minlength=self.n)
        a, b = self.sizes(), other.sizes()
        out = np.divide(common, a + b - common, out=np.zeros(self.n), where=a + b > 0)
        for k in np.flatnonzero((a < LEAST_SPOTS) | (b < LEAST_SPOTS)):
            x, y = self.grams[k], other.grams[k]
            if x is not None and y is not None:
                both = len(np.intersect1d(x, y, assume_unique=True))
                out[k] = both / (len(x) + len(y) - both) if len(x) + len(y) else 1.0
        return out


def _parse(fingerprint: str) -> tuple[np.ndarray, np.ndarray | None]:
    spots, dash, grams = fingerprint.partition("-")
    read = lambda text: np.frombuffer(bytes.fromhex(text), ">u4")
    return read(spots), read(grams) if dash else None


def likeness(a: str, b: str) -> float:
    """Likeness of two fingerprints."""
    if a == b:
        return 1.0
    (x, p), (y, q) = _parse(a), _parse(b)
    if (len(x) < LEAST_SPOTS or len(y) < LEAST_SPOTS) and p is not None and q is not None:
        x, y = p, q
    both = len(np.intersect1d(x, y, assume_unique=True))
    return both / (len(x) + len(y) - both) if len(x) + len(y) else 0.0


def fingerprints(docs: DataFrame) -> DataFrame:
    """``doc_id``, ``fingerprint`` and ``n_spots`` (number of signatures) of every row."""

    def run(batches):
        for batch in batches:
            for first, last in _row_runs(batch.column("text")):
                part = batch.slice(first, last - first)
                sets = Sets(part.column("text"))
                yield pa.RecordBatch.from_arrays([part.column("doc_id"), pa.array(sets.fingerprints(), pa.string()), pa.array(sets.sizes().astype(np.int32))], ["doc_id", "fingerprint", "n_spots"])

    return documents(docs).mapInArrow(run, "doc_id long, fingerprint string, n_spots int")


def _row_runs(texts: pa.Array, size: int = 1 << 20) -> Iterator[tuple[int, int]]:
    yield from passes(utf8(texts)[1], size)


# ------------------------------------------------------------------------------ each document and the next one


def _positions(docs: DataFrame) -> DataFrame:
    """Rows with ``down``, the position of a key in descending order (nulls last), and ``text_key``, which tells rows of one key apart."""
    return documents(docs).withColumns({"down": F.coalesce(F.bitwise_not(F.col("doc_id")), F.lit((1 << 63) - 1)), "text_key": F.xxhash64(F.coalesce("text", F.lit("")))})


def _blocks(rows: DataFrame, block_bytes: int) -> tuple[np.ndarray, np.ndarray]:
    """Upper ends of blocks of about ``block_bytes`` of text, as pairs (position, text hash).

    They are quantiles of a sample by hash; the driver gets about 64 pairs a block, 16 bytes each: a millionth or so of the text.
    """
    told = rows.agg(F.count("*").alias("n"), F.sum(F.octet_length("text")).alias("size")).first()
    n_blocks = int((told["size"] or 0) // block_bytes) + 1
    if n_blocks == 1:
        return np.zeros(0, np.int64), np.zeros(0, np.int64)
    share = min(1.0, 64.0 * n_blocks / told["n"])
    drawn = rows.where(F.pmod(F.xxhash64("down", "text_key"), F.lit(1 << 30)) < int(share * (1 << 30))).select("down", "text_key").toArrow()
    down, key = (drawn.column(c).to_numpy() for c in ("down", "text_key"))
    order = np.lexsort((key, down))
    at = order[(np.arange(1, n_blocks) * len(order)) // n_blocks] if len(order) else order
    return down[at], key[at]


def next_documents(docs: DataFrame, block_bytes: int = BLOCK_BYTES) -> DataFrame:
    """Rows in blocks for ``with_edited``: ``doc_id``, ``text``, ``block``, ``down``, ``text_key`` and ``borrowed``.

    The order is descending ``doc_id``, nulls last, rows of one key by the hash of their text.  Blocks are ranges of that order;
    the first row of the following block (for the last block: of the first) comes at the end of each, marked ``borrowed``.
    Texts are dealt out once; beside them only one row a block is copied.
    """
    rows = _positions(docs)
    ends_down, ends_key = _blocks(rows, block_bytes)

    @F.pandas_udf("int")
    def block_of(down: pd.Series, key: pd.Series) -> pd.Series:
        d, h = down.to_numpy(), key.to_numpy()
        low, high = np.searchsorted(ends_down, d, "left"), np.searchsorted(ends_down, d, "right")
        for k in np.flatnonzero(low < high):  # ends of the same key are told apart by the hash
            low[k] += np.searchsorted(ends_key[low[k] : high[k]], h[k], "right")
        return pd.Series(low.astype(np.int32))

    blocks = materialize(rows.select("down", "text_key").withColumn("block", block_of("down", "text_key")).groupBy("block").agg(F.min(F.struct("down", "text_key")).alias("head")))
    line = Window.orderBy("block")  # one row a block
    last = F.max("block").over(Window.partitionBy())
    heads = blocks.select(F.col("head.down").alias("h_down"), F.col("head.text_key").alias("h_key"), F.coalesce(F.lag("block").over(line), last).alias("h_block"))
    # one row a block, each of which stands for some 16 MB of text
    found = rows.join(F.broadcast(heads), (F.col("down") == F.col("h_down")) & (F.col("text_key") == F.col("h_key")))
    found = found.dropDuplicates(["h_block"]).select("doc_id", "text", F.col("h_block").alias("block"), "down", "text_key", F.lit(True).alias("borrowed"))
    own = rows.select("doc_id", "text", block_of("down", "text_key").alias("block"), "down", "text_key", F.lit(False).alias("borrowed"))
    return own.unionByName(found).repartition(len(ends_down) + 1, "block").sortWithinPartitions("block", "borrowed", "down", "text_key")


def edit(text: str, following: str) -> str:
    """The text with its last third replaced by as many first code points of the following one."""
    n = len(text) // 3
    return text[: len(text) - n] + following[:n]


def with_edited(docs: DataFrame, block_bytes: int = BLOCK_BYTES) -> DataFrame:
    """Per row: ``doc_id``, ``n_chars``, ``edited_sha256``, ``fingerprint``, ``edited_fingerprint``, ``near_edited``, ``near_next``.

    The edited text is ``edit`` of the text and the next one (see ``next_documents``; a single row is its own next).
    """

    def compare(texts: list[str], nexts: list[str], ids: list) -> pa.RecordBatch:
        edited = [edit(a, b) for a, b in zip(texts, nexts)]
        own, changed, after = (Sets(pa.array(x, pa.large_string())) for x in (texts, edited, nexts))
        columns = {
            "doc_id": pa.array(ids, pa.int64()),
            "n_chars": pa.array([len(t) for t in texts], pa.int64()),
            "edited_sha256": pa.array([hashlib.sha256(t.encode()).hexdigest() for t in edited], pa.string()),
            "fingerprint": pa.array(own.fingerprints(), pa.string()),
            "edited_fingerprint": pa.array(changed.fingerprints(), pa.string()),
            "near_edited": pa.array(own.likeness(changed), pa.float64()),
            "near_next": pa.array(own.likeness(after), pa.float64()),
        }
        return pa.RecordBatch.from_arrays(list(columns.values()), list(columns))

    def run(batches):
        held: list[tuple[int | None, str]] = []  # rows that wait for the next one, the last of them at least
        block, size = None, 0
        for batch in batches:
            columns = (batch.column(c).to_pylist() for c in ("doc_id", "text", "block", "borrowed"))
            for doc, text, own, borrowed in zip(*columns):
                text = text or ""
                if own != block:
                    held, block, size = [], own, 0
                held.append((doc, text))
                size += len(text)
                if len(held) > 1 and (borrowed or size > 1 << 19):
                    texts = [t for _, t in held]
                    yield compare(texts[:-1], texts[1:], [d for d, _ in held[:-1]])
                    held, size = held[-1:], len(text)

    schema = "doc_id long, n_chars long, edited_sha256 string, fingerprint string, edited_fingerprint string, near_edited double, near_next double"
    return next_documents(docs, block_bytes).select("doc_id", "text", "block", "borrowed").mapInArrow(run, schema)


# -------------------------------------------------------------------------------------------- near pairs


def near_pairs(found: DataFrame, least: float = 0.8) -> tuple[DataFrame, DataFrame]:
    """Classes of equal fingerprints (``class_id``, smallest ``doc_id``, ``n_docs``, by ``fingerprint``) and the pairs of classes
    (``a``, ``b``, ``likeness``) whose signature sets have a Jaccard similarity of ``least`` or more.

    ``found`` holds ``doc_id``, ``fingerprint`` and ``n_spots``; sets of fewer than ``LEAST_SPOTS`` signatures pair with nothing.
    """
    classes = materialize(found.where("doc_id IS NOT NULL").groupBy("fingerprint", "n_spots").agg(F.min("doc_id").alias("class_id"), F.count("*").alias("n_docs")))
    sets = classes.where(F.col("n_spots") >= LEAST_SPOTS)

    def spots(batches):
        for batch in batches:
            read = [_parse(x)[0].astype(np.int64) for x in batch.column("fingerprint").to_pylist()]
            n = np.array([len(x) for x in read], np.int64)
            yield pa.RecordBatch.from_arrays(
                [pa.array(np.repeat(batch.column("class_id").to_numpy(), n)), pa.array(np.repeat(n, n).astype(np.int32)), pa.array(np.concatenate(read) if read else np.zeros(0, np.int64))],
                ["class_id", "n_spots", "spot"],
            )

    members = materialize(sets.mapInArrow(spots, "class_id long, n_spots int, spot long"))
    use = members.groupBy("spot").agg(F.count("*").alias("use"))
    rarest = Window.partitionBy("class_id").orderBy("use", "spot")  # one document's signatures
    must = F.col("n_spots") - F.ceil(F.col("n_spots") * F.lit(least) - F.lit(1e-9)) + 1
    few = members.join(use.where("use > 1"), "spot").withColumn("r", F.row_number().over(rarest) + F.lit(0))
    # signatures that no other set has count among the rarest as well, so they take up places
    alone = members.join(use.where("use = 1"), "spot").groupBy("class_id").agg(F.count("*").alias("alone"))
    few = few.join(alone, "class_id", "left").where(F.col("r") + F.coalesce("alone", F.lit(0)) <= must)
    part = F.floor(F.log(F.col("n_spots").cast("double")) / F.lit(-math.log(least)) + F.lit(1e-9)).cast("int")
    few = materialize(few.select("spot", "class_id", "n_spots", part.alias("part")))
    ahead = few.select("spot", F.col("class_id").alias("b"), F.col("n_spots").alias("m"), F.explode(F.array("part", F.col("part") - 1)).alias("part"))
    fits = (F.col("n_spots") <= F.col("m")) & (F.col("n_spots") >= F.col("m") * F.lit(least) - F.lit(1e-9))
    pairs = few.withColumnRenamed("class_id", "a").join(ahead, ["part", "spot"]).where(fits & ((F.col("n_spots") < F.col("m")) | (F.col("a") < F.col("b")))).where("a != b")
    text = sets.select("class_id", "fingerprint")
    with_text = pairs.select("a", "b").distinct().join(text.withColumnsRenamed({"class_id": "a", "fingerprint": "x"}), "a").join(text.withColumnsRenamed({"class_id": "b", "fingerprint": "y"}), "b")

    def verify(batches):
        for batch in batches:
            got = [likeness(x, y) for x, y in zip(batch.column("x").to_pylist(), batch.column("y").to_pylist())]
            yield pa.RecordBatch.from_arrays([batch.column("a"), batch.column("b"), pa.array(got, pa.float64())], ["a", "b", "likeness"])

    return classes, with_text.select("a", "b", "x", "y").mapInArrow(verify, "a long, b long, likeness double").where(F.col("likeness") >= least - 1e-12)
