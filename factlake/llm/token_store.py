"""Raw token ids in shards, with a minimal perfect hash index from document keys to shard offsets.

Shards hold the ids of all documents in ascending ``doc_id`` order (null first, equal keys side by side),
each followed by an end id, as unsigned little-endian numbers of 2 bytes if the vocabulary allows it, else
4.  A shard file is: payload, one 8-byte offset per document and one for the end, one 8-byte key and one
null flag per document, then a footer.  The index is cut by a hash of the key into buckets of about
``BUCKET_KEYS`` keys; each bucket is one hash-and-displace minimal perfect hash with a 32-bit fingerprint
and (first shard, place, copies there, last shard) at the key's slot, so that a lookup reads one slot.

Tasks write files of unique names and hand the names on as rows; only rows of tasks that succeeded reach
the manifest, so a lost executor leaves at most files that nothing names.  Null text is an empty one.  Repeated
keys all stay: a key that fills several shards is read from each of them.
"""

from __future__ import annotations

import itertools
import uuid
from dataclasses import dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
from pyarrow import fs as arrow_fs
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from factlake.llm.bpe import encoder
from factlake.llm.text import documents, mix
from factlake.session import new_folder

#: Bytes of text that go to one shard, about.
SHARD_BYTES = 1 << 24
BUCKET_KEYS = 4000
#: Keys of a bucket that share one displacement, on average.
GROUP_KEYS = 4
_U = np.uint64
_STEP = _U(0x9E3779B97F4A7C15)
_MAGIC = 0x54534844


def _file(uri: str) -> tuple[arrow_fs.FileSystem, str]:
    return arrow_fs.FileSystem.from_uri(uri)


def _write(uri: str, chunks) -> None:
    fs, path = _file(uri)
    fs.create_dir(path.rsplit("/", 1)[0], recursive=True)
    with fs.open_output_stream(path) as out:
        for chunk in chunks:
            out.write(chunk)


@dataclass
class Store:
    spark: SparkSession
    folder: str

    def read(self, name: str) -> DataFrame:
        return self.spark.read.parquet(f"{self.folder}/{name}")


def write_store(docs: DataFrame, tokenizer: str, end_id: int = 1, folder: str | None = None) -> Store:
    """Encode ``docs``, write the shards and their index below ``folder`` (by default a new shared one)."""
    spark = docs.sparkSession
    folder = folder or new_folder(spark, "token-store")
    docs = documents(docs)
    size = docs.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    n_shards = int(size // SHARD_BYTES) + 1

    def write(batches):
        enc = encoder(tokenizer)
        wide = max(len(enc.strings), end_id + 1) > 1 << 16
        kind = np.dtype("<u4" if wide else "<u2")
        shard = TaskContext.get().partitionId()
        name = f"{folder}/ids/shard-{shard:06d}-{uuid.uuid4().hex}"
        keys, nulls, lens = [], [], []

        def payload():
            for batch in batches:
                ids, bounds = enc.encode(batch.column("text"))
                n = len(bounds) - 1
                with_end = np.insert(ids, bounds[1:], end_id).astype(kind)
                lens.append(np.diff(bounds) + 1)
                column = batch.column("doc_id")
                keys.append(column.fill_null(0).to_numpy(zero_copy_only=False).astype("<i8"))
                nulls.append(column.is_null().to_numpy(zero_copy_only=False).astype(np.uint8))
                assert len(keys[-1]) == n
                yield with_end.tobytes()
            if lens:
                ends = np.cumsum(np.concatenate([[0], *lens]))
                yield ends.astype("<i8").tobytes() + np.concatenate(keys).tobytes() + np.concatenate(nulls).tobytes()
                yield np.array([_MAGIC, kind.itemsize, len(ends) - 1, ends[-1]], "<i8").tobytes()

        rows = payload()
        first = next(rows, None)
        if first is None:
            return
        _write(name, itertools.chain([first], rows))
        length, key, null = np.concatenate(lens), np.concatenate(keys), np.concatenate(nulls).astype(bool)
        n = len(length)
        yield pa.RecordBatch.from_arrays(
            [
                pa.array(np.full(n, shard, np.int32)),
                pa.array([name] * n, pa.string()),
                pa.array(key, mask=null),
                pa.array(np.arange(n, dtype=np.int64)),
                pa.array(length.astype(np.int64)),
            ],
            ["shard", "file", "doc_id", "place", "n_tokens"],
        )

    dealt = docs.repartitionByRange(n_shards, F.asc("doc_id"), F.xxhash64("text")).sortWithinPartitions("doc_id")
    dealt.mapInArrow(write, "shard int, file string, doc_id long, place long, n_tokens long").write.parquet(f"{folder}/records")
    store = Store(spark, folder)
    records = store.read("records")
    shards = records.groupBy("shard", "file").agg(F.sum("n_tokens").alias("n_tokens"), F.count("*").alias("n_docs"))
    before = Window.orderBy("shard").rowsBetween(Window.unboundedPreceding, -1)  # one row per shard
    shards.withColumn("base", F.coalesce(F.sum("n_tokens").over(before), F.lit(0))).write.parquet(f"{folder}/shards")
    _write_index(store, records)
    return store


def _hashed(df: DataFrame, n_buckets: int) -> DataFrame:
    h1 = F.xxhash64(F.lit(1), "doc_id")
    return df.withColumns({"h1": h1, "h2": F.xxhash64(F.lit(2), "doc_id"), "bucket": F.pmod(h1, F.lit(n_buckets))})


def _slot(h2: np.ndarray, displacement: np.ndarray, n: int) -> np.ndarray:
    moved = mix(h2 + displacement.astype(_U) * _STEP) % _U(n)
    return np.where(displacement < 0, -displacement - 1, moved.astype(np.int64))


def perfect_hash(h2: np.ndarray) -> np.ndarray:
    """One displacement per group of keys, so that ``len(h2)`` different keys get different slots 0..n-1.

    Large groups look for a free place first; a key alone in its group is given one that is left.
    """
    n = len(h2)
    m = n // GROUP_KEYS + 1
    group = (mix(h2 ^ _STEP) % _U(m)).astype(np.int64)
    order = np.argsort(group, kind="stable")
    sizes = np.bincount(group, minlength=m)
    firsts = np.cumsum(sizes) - sizes
    free = np.ones(n, dtype=bool)
    out = np.zeros(m, dtype=np.int64)
    for g in np.argsort(-sizes, kind="stable"):
        size = sizes[g]
        if size < 2:
            break
        own = h2[order[firsts[g] : firsts[g] + size]]
        start, step = 0, 64
        while True:
            tried = np.arange(start, start + step)
            slots = mix(own[None, :] + tried.astype(_U)[:, None] * _STEP) % _U(n)
            slots = np.sort(slots.astype(np.int64), axis=1)
            good = free[slots].all(axis=1) & (np.diff(slots, axis=1) > 0).all(axis=1)
            if good.any():
                at = int(np.argmax(good))
                out[g] = start + at
                free[slots[at]] = False
                break
            start, step = start + step, min(step * 2, 1 << 14)
    alone = np.flatnonzero(sizes == 1)
    out[alone] = -np.flatnonzero(free)[: len(alone)] - 1
    return out


def _write_index(store: Store, records: DataFrame) -> None:
    per_shard = records.groupBy("doc_id", "shard").agg(F.min("place").alias("place"), F.count("*").alias("copies"))
    keys = per_shard.groupBy("doc_id").agg(F.min(F.struct("shard", "place", "copies")).alias("at"), F.max("shard").alias("last_shard"))
    keys = keys.select("doc_id", "at.*", "last_shard")
    n_buckets = records.count() // BUCKET_KEYS + 1
    folder = store.folder

    def build(rows: pd.DataFrame) -> pd.DataFrame:
        h1, h2 = (rows[c].to_numpy(np.int64).view(_U) for c in ("h1", "h2"))
        displacements = perfect_hash(h2)
        n = len(rows)
        slots = _slot(h2, displacements[(mix(h2 ^ _STEP) % _U(len(displacements))).astype(np.int64)], n)
        entry = np.zeros(n, dtype=_ENTRY)
        entry["print"][slots] = (h1 >> _U(32)).astype(np.uint32)
        for c in ("shard", "place", "copies", "last_shard"):
            entry[c][slots] = rows[c].to_numpy(np.int64)
        bucket = int(rows["bucket"].iloc[0])
        name = f"{folder}/index/bucket-{bucket:06d}-{uuid.uuid4().hex}"
        _write(name, [np.array([n, len(displacements)], "<i8").tobytes(), displacements.astype("<i8").tobytes(), entry.tobytes()])
        return pd.DataFrame({"bucket": [bucket], "index_file": [name], "n_keys": [n]})

    built = _hashed(keys, n_buckets).groupBy("bucket").applyInPandas(build, "bucket long, index_file string, n_keys long")
    built.withColumn("n_buckets", F.lit(n_buckets)).write.parquet(f"{folder}/buckets")


_ENTRY = np.dtype([("print", "<u4"), ("shard", "<i4"), ("place", "<i8"), ("copies", "<i8"), ("last_shard", "<i4")])


def _read_bucket(name: str) -> tuple[np.ndarray, np.ndarray]:
    fs, path = _file(name)
    with fs.open_input_file(path) as f:
        data = f.read()
    n, m = np.frombuffer(data, "<i8", 2)
    return np.frombuffer(data, "<i8", m, 16), np.frombuffer(data, _ENTRY, n, 16 + 8 * m)


def lookup(store: Store, keys: DataFrame) -> DataFrame:
    """``doc_id``, ``shard``, ``place``, ``copies``, ``last_shard`` of each key row; keys that are not there give no row."""
    buckets = store.read("buckets")
    n_buckets = buckets.select(F.max("n_buckets")).first()[0] or 1
    asked = _hashed(keys.select(F.col("doc_id").cast("long")), n_buckets).join(buckets.select("bucket", "index_file"), "bucket")

    def find(batches):
        name, known = None, None
        for batch in batches:
            files = batch.column("index_file").to_pylist()
            edges = [0, *(k for k in range(1, len(files)) if files[k] != files[k - 1]), len(files)] if files else []
            for first, last in itertools.pairwise(edges):
                part = batch.slice(first, last - first)
                if files[first] != name:
                    name, known = files[first], _read_bucket(files[first])
                displacements, entry = known
                h1, h2 = (part.column(c).to_numpy().view(_U) for c in ("h1", "h2"))
                got = entry[_slot(h2, displacements[(mix(h2 ^ _STEP) % _U(len(displacements))).astype(np.int64)], len(entry))]
                same = got["print"] == (h1 >> _U(32)).astype(np.uint32)
                # keys stay Arrow's integers: beside a null, pandas would make them doubles
                out = [part.column("doc_id").filter(pa.array(same)), *(pa.array(got[c][same].astype(np.int64)) for c in ("shard", "place", "copies", "last_shard"))]
                yield pa.RecordBatch.from_arrays(out, ["doc_id", "shard", "place", "copies", "last_shard"])

    ordered = asked.repartition("bucket").sortWithinPartitions("bucket")
    return ordered.mapInArrow(find, "doc_id long, shard long, place long, copies long, last_shard long")


class _Shard:
    def __init__(self, name: str):
        fs, path = _file(name)
        self.file = fs.open_input_file(path)
        size = self.file.size()
        magic, self.width, n, self.total = np.frombuffer(self.file.read_at(32, size - 32), "<i8")
        assert magic == _MAGIC, f"{name} is no shard"
        meta = self.file.read_at(int(size - 32 - self.total * self.width), int(self.total * self.width))
        self.ends = np.frombuffer(meta, "<i8", n + 1)
        self.keys = np.frombuffer(meta, "<i8", n, 8 * (n + 1))
        self.nulls = int(np.frombuffer(meta, np.uint8, n, 16 * n + 8).sum())

    def holds(self, key: int | None, place: int) -> bool:
        """Whether the document at a place has this key; a fingerprint alone may be that of another one."""
        return place < self.nulls if key is None else place >= self.nulls and int(self.keys[place]) == key

    def run(self, key: int | None) -> tuple[int, int]:
        """Places of a key that goes on from an earlier shard."""
        if key is None:
            return 0, self.nulls
        first, last = np.searchsorted(self.keys[self.nulls :], [key, key + 1])
        return self.nulls + first, self.nulls + last

    def ids(self, first: int, last: int) -> np.ndarray:
        a, b = int(self.ends[first]), int(self.ends[last])
        return np.frombuffer(self.file.read_at((b - a) * self.width, a * self.width), f"<u{self.width}").astype("<u4")


#: Bytes of payload that one read takes at least, if neighbouring documents are asked for.
READ_TOKENS = 1 << 20


def fetch(store: Store, keys: DataFrame) -> DataFrame:
    """``doc_id``, ``start``, ``n_tokens`` and ``ids`` (binary, little-endian unsigned 32 bits, end id included) of each key row."""
    shards = store.read("shards")
    n_shards = shards.count()
    at = lookup(store, keys)
    pieces = at.withColumn("piece", F.explode(F.sequence("shard", "last_shard")))
    pieces = pieces.select(
        "doc_id",
        F.col("piece").alias("shard"),
        F.when(F.col("piece") == F.col("shard"), F.col("place")).alias("place"),
        "copies",
    ).join(shards.select("shard", "file", "base"), "shard")

    def read(batches):
        name, shard = None, None
        for batch in batches:
            columns = [batch.column(c).to_pylist() for c in ("doc_id", "file", "base", "place", "copies")]
            wanted = []
            for key, file, base, place, copies in zip(*columns):
                if file != name:
                    yield from _emit(shard, wanted)
                    name, shard, wanted = file, _Shard(file), []
                if place is not None and not shard.holds(key, place):
                    continue
                first, last = (place, place + copies) if place is not None else shard.run(key)
                wanted.extend((key, base, p) for p in range(first, last))
            yield from _emit(shard, wanted)

    out = "doc_id long, start long, n_tokens long, ids binary"
    return pieces.repartition(max(1, n_shards), "shard").sortWithinPartitions("shard", "place").mapInArrow(read, out)


def _emit(shard: _Shard | None, wanted: list[tuple]):
    """Rows of the places asked for; neighbouring places are read at once."""
    k = 0
    while k < len(wanted):
        first = last = wanted[k][2]
        some = []
        while k < len(wanted) and first <= wanted[k][2] <= last + 1 and shard.ends[wanted[k][2] + 1] - shard.ends[first] <= max(READ_TOKENS, shard.ends[first + 1] - shard.ends[first]):
            last = max(last, wanted[k][2])
            some.append(wanted[k])
            k += 1
        ids = shard.ids(first, last + 1).tobytes()
        places = np.array([p for _, _, p in some])
        a, b = shard.ends[places], shard.ends[places + 1]
        zero = shard.ends[first]
        yield pa.RecordBatch.from_arrays(
            [
                pa.array([x[0] for x in some], pa.int64()),
                pa.array(np.array([x[1] for x in some], np.int64) + a),
                pa.array((b - a).astype(np.int64)),
                pa.array([ids[4 * (i - zero) : 4 * (j - zero)] for i, j in zip(a.tolist(), b.tolist())], pa.binary()),
            ],
            ["doc_id", "start", "n_tokens", "ids"],
        )
