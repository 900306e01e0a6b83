"""Language of a text by compression.

Each language has a raw-content Zstandard dictionary of ``dict_bytes`` bytes, cut from a bounded sample of labelled
texts.  Case does not matter.  A text is compressed whole, in blocks, with every dictionary; the language with the smallest sum
wins, a tie goes to the language with more labelled rows.  The score is the margin: the share of bytes that the best
saves against the second.  A text is rejected if it has no letter or its margin is below ``min_margin``.

The sample takes, per language, the ``sample_rows`` different labelled texts with the smallest hash, whatever
the size of the table.  Null or empty text gives ``und``; so does any text if no labelled row exists.  With a single
learned language the margin is 1.
"""

from __future__ import annotations

import functools
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from factlake.llm.text import documents

UNKNOWN = "und"
LEVEL = 6
BLOCK = 4096
MIN_MARGIN = 0.002


@dataclass(frozen=True)
class LanguageModel:
    #: (language, dictionary), most frequent first.
    dictionaries: tuple[tuple[str, bytes], ...]
    level: int = LEVEL
    block: int = BLOCK


def fit(labelled: DataFrame, dict_bytes: int = 110_000, sample_rows: int = 400, level: int = LEVEL, block: int = BLOCK) -> LanguageModel:
    """Learn from ``text`` and non-null ``lang``.  One row per language and at most ``sample_rows`` texts each reach the driver."""
    rows = labelled.select("text", "lang").where("lang IS NOT NULL AND text IS NOT NULL AND text != ''")
    counts = {r["lang"]: r["n"] for r in rows.groupBy("lang").agg(F.count("*").alias("n")).collect()}
    if not counts:
        return LanguageModel((), level, block)
    # first a share of each language's rows by hash that is larger than the sample, then the exact smallest of those
    place = F.pmod(F.xxhash64("text"), F.lit(1 << 40))
    limit = F.create_map(*(F.lit(x) for lang, n in counts.items() for x in (lang, float(min(1.0, (3.0 * sample_rows + 50) / n) * (1 << 40)))))
    # copies are folded, so that no group of them fills the sample; a dictionary holds no more of a text than its own size
    near = rows.withColumn("place", place).where(F.col("place") < limit[F.col("lang")])
    near = near.select("lang", "place", F.substring("text", 1, dict_bytes).alias("text")).distinct()
    order = Window.partitionBy("lang").orderBy("place", "text")
    taken = near.withColumn("k", F.row_number().over(order)).where(F.col("k") <= sample_rows)
    texts: dict[str, list[tuple[int, str]]] = {}
    for r in taken.select("lang", "k", "text").collect():
        texts.setdefault(r["lang"], []).append((r["k"], r["text"]))
    out = []
    for lang in sorted(counts, key=lambda x: (-counts[x], x)):
        some = "\n".join(t for _, t in sorted(texts.get(lang, []))).lower()
        out.append((lang, some.encode()[:dict_bytes]))
    return LanguageModel(tuple(out), level, block)


@functools.lru_cache(maxsize=2)
def _compressors(model: LanguageModel):
    import zstandard as z

    def one(content: bytes):
        data = z.ZstdCompressionDict(content, dict_type=z.DICT_TYPE_RAWCONTENT) if len(content) >= 8 else None
        if data is not None:
            data.precompute_compress(level=model.level)
        return z.ZstdCompressor(level=model.level, dict_data=data, write_content_size=False, write_checksum=False, write_dict_id=False)

    return [(lang, one(content).compress) for lang, content in model.dictionaries]


def classify(model: LanguageModel, text: str | None) -> tuple[str, float]:
    if not text or not model.dictionaries or not any(map(str.isalpha, text)):
        return UNKNOWN, 0.0
    data = text.lower().encode()
    blocks = [data[k : k + model.block] for k in range(0, len(data), model.block)]
    sizes = [sum(len(compress(b)) for b in blocks) for _, compress in _compressors(model)]
    best = int(np.argmin(sizes))
    if len(sizes) == 1:
        return model.dictionaries[0][0], 1.0
    second = min(s for k, s in enumerate(sizes) if k != best)
    return model.dictionaries[best][0], (second - sizes[best]) / second


def predict(docs: DataFrame, model: LanguageModel, min_margin: float = MIN_MARGIN) -> DataFrame:
    """``doc_id``, ``lang_pred``, ``score`` and ``rejected`` of every row.  The model is at most one dictionary per language."""

    def run(batches):
        for batch in batches:
            got = [classify(model, t) for t in batch.column("text").to_pylist()]
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column("doc_id"),
                    pa.array([g[0] for g in got], pa.string()),
                    pa.array([g[1] for g in got], pa.float64()),
                    pa.array([g[0] == UNKNOWN or g[1] < min_margin for g in got], pa.bool_()),
                ],
                ["doc_id", "lang_pred", "score", "rejected"],
            )

    return documents(docs).mapInArrow(run, "doc_id long, lang_pred string, score double, rejected boolean")


def keep_identified(docs: DataFrame, model: LanguageModel, min_margin: float = MIN_MARGIN) -> DataFrame:
    """Rows of ``docs``, unchanged, whose language is not rejected."""
    schema, at = docs.schema, docs.columns.index("text")

    def run(batches):
        for batch in batches:
            got = [classify(model, t) for t in batch.column(at).to_pylist()]
            yield batch.filter(pa.array([g[0] != UNKNOWN and g[1] >= min_margin for g in got], pa.bool_()))

    return docs.mapInArrow(run, schema)
