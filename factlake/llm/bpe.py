"""BPE encoding and decoding with tree concatenation.

A text of more than ``long_chars`` characters is cut into halves, and these into halves, wherever the middle falls; the
leaves are dealt over all tasks and encoded in parallel.  Around each join a growing window of both sides is encoded again
until its first token is the one the left side already had there and its last the one of the right side, and both
sides hold the rest of their part of the window as it stands.  Joins follow the tree, level by level.

Inside a leaf, words between ASCII white space, where the vocabularies of this kind never merge, are encoded once per
worker.  A run without white space that is longer than ``LONG_RUN`` bytes is normalised and pre-tokenised; a pre-token
longer than ``LEAF`` symbols is encoded in halves and joined in the same way over its symbols.  A sequence of tokens is the
BPE encoding exactly if each two neighbours are the encoding of their own text, so that agreement makes the joined
sequence exact.

A null text is encoded as an empty one.  Rows that repeat, and null keys, come out as they came in.
"""

from __future__ import annotations

import functools
import itertools
import json
import os
import re
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from factlake.llm.text import documents, passes

LONG_RUN = 512
LEAF = 256
#: Characters beyond which a document is encoded in parallel leaves.
LONG_CHARS = 1 << 15
#: Most bytes of a leaf of a document that is encoded in parallel.
PART_BYTES = 1 << 14
#: Bytes of either side in the first window around the join of two leaves.
WINDOW = 48
#: Fixed value: the pattern by which the lower-case vocabulary's file cuts text.
LETTER_RUNS = {"Regex": r"'s|'t|'re|'ve|'m|'ll|'d|[\p{L}]+|[\p{N}]|[^\s\p{L}\p{N}]+"}
#: Latin-1 letters.
SIMPLE = re.compile("[A-Za-z\u00c0-\u00d6\u00d8-\u00f6\u00f8-\u00ff]+")
#: Bytes that a worker's memory of words may take; beyond it only words met again are kept, up to half of it.
MEMORY_BYTES = 24 << 20
#: What a word takes beside its text and ids: place, length and count, and its entry in the table of a look-up.
WORD_BYTES = 80
#: Bytes of text that are encoded, and rows handed on, at once.
ENCODE_BYTES = 1 << 20
#: Rows that are decoded before they are handed on.
DECODE_ROWS = 500
#: Words that go to the tokenizer in one call.
CALL = 20_000
SPACES = (b" ", b"\t", b"\n", b"\r", b"\x0b", b"\x0c")
SPACE = re.compile(rb"[ \t\n\r\x0b\x0c]")


class Encoder:
    """One tokenizer file in one worker."""

    def __init__(self, path: str):
        os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")  # Spark runs one worker per core already
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        self.tokenizer.no_truncation()
        self.tokenizer.no_padding()
        ids = lambda text: self.tokenizer.encode(text, add_special_tokens=False).ids
        if ids("a b \n c, ") != ids("a") + ids("b") + ids("c,"):
            raise ValueError(f"{path}: white space is no boundary for this vocabulary")
        spec = json.loads(self.tokenizer.to_str())
        self.suffix = spec["model"].get("end_of_word_suffix") or ""
        self.words = pa.array([], pa.large_string())
        self.store, self.used = np.zeros(1 << 16, "<u4"), 0
        self.starts, self.lens, self.met = (np.zeros(0, np.int64) for _ in range(3))
        self.letters = self._letters(spec)
        added = {t.content: i for i, t in self.tokenizer.get_added_tokens_decoder().items()}
        self.added = added
        self.split_added = re.compile("(" + "|".join(map(re.escape, sorted(added, key=len, reverse=True))) + ")") if added else None

    @functools.cached_property
    def inner(self):
        """Encodes text from the middle of a pre-token, which has no word end."""
        if not self.suffix:
            return self.tokenizer
        spec = json.loads(self.tokenizer.to_str())
        spec["model"]["end_of_word_suffix"] = None
        return type(self.tokenizer).from_str(json.dumps(spec))

    def _letters(self, spec: dict) -> dict[int, str] | None:
        """Byte-level symbols of lower-case Latin-1 letters, if the file cuts letters from punctuation and nothing else."""
        norm = [x["type"] for x in (spec["normalizer"] or {}).get("normalizers", [])]
        pre = (spec["pre_tokenizer"] or {}).get("pretokenizers", [{}])
        if norm != ["NFC", "Replace", "Lowercase"] or len(pre) != 2 or pre[0].get("pattern") != LETTER_RUNS or pre[1]["type"] != "ByteLevel":
            return None
        one = self.tokenizer.pre_tokenizer.pre_tokenize_str
        return {ord(c): one(c)[0][0] for c in map(chr, range(0x61, 0x100)) if c.isalpha() and c.islower() and c not in "\u00aa\u00ba"}

    @functools.cached_property
    def strings(self) -> list[str | None]:
        t = self.tokenizer
        return [t.id_to_token(i) for i in range(max(t.get_vocab().values(), default=-1) + 1)]

    def model(self, piece: str, last: bool) -> list[int]:
        return [t.id for t in (self.tokenizer if last else self.inner).model.tokenize(piece)]

    def symbols(self, ids: list[int], ends_word: bool) -> str:
        text = "".join(self.strings[i] for i in ids)
        return text[: -len(self.suffix)] if ends_word and self.suffix else text

    def join(self, left: list[int], right: list[int], last: bool) -> list[int]:
        """Encoding of the joined text of two encodings; ``last``: the right one ends its pre-token."""
        i = j = 4
        while True:
            i, j = min(i, len(left)), min(j, len(right))
            end = last and j == len(right)
            window = self.model(self.symbols(left[-i:], False) + self.symbols(right[:j], end), end)
            left_agrees = i == len(left) or window[0] == left[-i]
            right_agrees = j == len(right) or window[-1] == right[j - 1]
            if left_agrees and right_agrees:
                return left[:-i] + window + right[j:]
            i, j = i * (1 if left_agrees else 2), j * (1 if right_agrees else 2)

    def join_all(self, parts: list[list[int]], last: bool) -> list[int]:
        """Neighbours are joined level by level, as a tree."""
        while len(parts) > 1:
            pairs = range(0, len(parts), 2)
            parts = [self.join(parts[k], parts[k + 1], last and k + 2 >= len(parts)) if k + 1 < len(parts) else parts[k] for k in pairs]
        return parts[0] if parts else []

    def piece(self, piece: str, last: bool = True) -> list[int]:
        leaves = [piece[k : k + LEAF] for k in range(0, len(piece), LEAF)]
        return self.join_all([self.model(x, last and k == len(leaves) - 1) for k, x in enumerate(leaves)], last)

    def pieces(self, run: str) -> Iterator[int | str]:
        """Pre-tokens of a run; an added token as its id."""
        for part in self.split_added.split(run) if self.split_added else [run]:
            if part in self.added:
                yield self.added[part]
            elif part:
                t = self.tokenizer
                part = t.normalizer.normalize_str(part) if t.normalizer else part
                yield from (x for x, _ in t.pre_tokenizer.pre_tokenize_str(part)) if t.pre_tokenizer else (part,)

    def run(self, run: str) -> list[int]:
        out: list[int] = []
        for x in self.pieces(run):
            if isinstance(x, int):
                out.append(x)
            else:
                out.extend(self.piece(x))
        return out

    def plainer(self, texts: pa.Array) -> pa.Array:
        """Texts with the same ids but fewer different words: punctuation apart from letters, ASCII in lower case."""
        if not self.letters:
            return texts
        if not pc.any(pc.match_substring(texts, "<")).as_py():  # lower case could turn a text into an added token
            texts = pc.ascii_lower(texts)
        return pc.replace_substring_regex(texts, r"([a-zA-Z])([.,;:!?]+[ \n])", r"\1 \2")

    def word(self, word: str) -> list[int] | None:
        """Ids of a word of Latin-1 letters, straight from the file's model; None for any other word."""
        if not self.letters or not SIMPLE.fullmatch(word):
            return None
        return [t.id for t in self.tokenizer.model.tokenize(word.lower().translate(self.letters))]

    def ids_of(self, texts: list[str]) -> list[list[int]]:
        """Ids of words between white space, without the memory."""
        ids = [self.word(w) if len(w) <= LONG_RUN else self.run(w) for w in texts]
        rest = [k for k, x in enumerate(ids) if x is None]
        for k in range(0, len(rest), CALL):
            some = rest[k : k + CALL]
            for place, e in zip(some, self.tokenizer.encode_batch_fast([texts[p] for p in some], add_special_tokens=False)):
                ids[place] = e.ids
        return ids

    def learn(self, words: pa.Array) -> None:
        """Remember the ids of new words."""
        ids = self.ids_of(words.to_pylist())
        lens = np.fromiter(map(len, ids), np.int64, len(ids))
        first = self.used
        self.used += int(lens.sum())
        while self.used > len(self.store):
            self.store = np.concatenate([self.store, np.zeros_like(self.store)])
        self.store[first : self.used] = np.fromiter(itertools.chain.from_iterable(ids), "<u4", self.used - first)
        self.words = pa.concat_arrays([self.words, words])
        self.starts = np.concatenate([self.starts, first + np.cumsum(lens) - lens])
        self.lens = np.concatenate([self.lens, lens])
        self.met = np.concatenate([self.met, np.zeros_like(lens)])

    def forget(self) -> None:
        """Keep the words met more than once, most often first, up to half of the memory."""
        again = np.flatnonzero(self.met > 1)
        again = again[np.argsort(-self.met[again], kind="stable")]
        sizes = pc.binary_length(self.words.take(pa.array(again))).to_numpy(zero_copy_only=False) + 4 * self.lens[again] + WORD_BYTES
        kept = np.sort(again[np.cumsum(sizes) <= MEMORY_BYTES // 2])
        self.words, self.lens, self.met = self.words.take(pa.array(kept)), self.lens[kept], self.met[kept] // 2
        ends = np.cumsum(self.lens)
        ids = self._ids(kept, self.starts, self.lens, ends)
        self.starts, self.used = ends - self.lens, len(ids)
        self.store = np.concatenate([ids, np.zeros(1 << 16, "<u4")])

    def _ids(self, of: np.ndarray, starts: np.ndarray, lens: np.ndarray, ends: np.ndarray) -> np.ndarray:
        """The ids of remembered words, one after another; ``lens`` and their sums ``ends`` are those of the words ``of``."""
        where = np.repeat(starts[of] - (ends - lens), lens)
        where += np.arange(len(where))
        return self.store[where]

    def _some(self, texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        split = pc.ascii_split_whitespace(self.plainer(texts))
        coded = split.flatten().dictionary_encode()
        words = coded.dictionary
        place = pc.index_in(words, value_set=self.words)
        if place.null_count:
            new = words.filter(place.is_null())
            if (len(self.words) + len(new)) * WORD_BYTES + self.words.nbytes + new.nbytes + 4 * self.used > MEMORY_BYTES:
                self.forget()
                place = pc.index_in(words, value_set=self.words)
                new = words.filter(place.is_null())
            place = place.fill_null(-1).to_numpy().copy()
            place[place < 0] = len(self.words) + np.arange(len(new))
            self.learn(new)
        else:
            place = place.to_numpy()
        self.met[place] += 1
        of = place[coded.indices.to_numpy()]
        lens = self.lens[of]
        ends = np.cumsum(lens)
        bounds = np.append(0, ends)[split.offsets.to_numpy() - split.offsets[0].as_py()]
        return self._ids(of, self.starts, lens, ends), bounds

    def encode_some(self, texts: pa.Array, size: int = ENCODE_BYTES) -> Iterator[tuple[int, np.ndarray, np.ndarray]]:
        """Runs of rows of about ``size`` bytes: number of rows, their ids, and where each row's begin (with the end of the last)."""
        texts = texts.cast(pa.large_string()).fill_null("")
        offsets = np.frombuffer(texts.buffers()[1], np.int64)[texts.offset : texts.offset + len(texts) + 1]
        for first, last in passes(offsets, size):
            yield last - first, *self._some(texts.slice(first, last - first))

    def encode(self, texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """The ids of all texts, one after another, and where each text's begin (with the end of the last)."""
        ids, bounds = [np.zeros(0, "<u4")], [np.zeros(1, np.int64)]
        for _, some, ends in self.encode_some(texts):
            ids.append(some)
            bounds.append(ends[1:] + bounds[-1][-1])
        return np.concatenate(ids), np.concatenate(bounds)

    def encode_one(self, text: bytes) -> np.ndarray:
        return self.encode(pa.array([text.decode()], pa.large_string()))[0]

    def encode_leaves(self, leaves: pa.RecordBatch) -> Iterator[tuple[int, list[np.ndarray]]]:
        """Runs of leaves as ``cut`` makes them: number of rows and the ids of each; many meet the memory of words at once."""
        texts = pc.if_else(pc.equal(leaves.column("kind"), "text"), leaves.column("payload"), None).cast(pa.large_string())
        first = 0
        for n, some, bounds in self.encode_some(texts):
            ids = np.split(some, bounds[1:-1])
            rows = zip(*(leaves.column(c).slice(first, n).to_pylist() for c in ("kind", "payload", "last")))
            for k, (kind, payload, last) in enumerate(rows):
                if kind != "text":
                    ids[k] = np.array([int(payload)] if kind == "id" else self.piece(payload.decode(), last), "<u4")
            yield n, ids
            first += n

    def encode_window(self, text: bytes) -> np.ndarray:
        """As ``encode_one``, for a few words: a look-up in the memory costs as much as all words in it, whatever the text."""
        ids = self.ids_of([w.decode() for w in text.split()])
        return np.fromiter(itertools.chain.from_iterable(ids), "<u4")

    def join_texts(self, left: tuple[bytes, np.ndarray], right: tuple[bytes, np.ndarray]) -> tuple[bytes, np.ndarray]:
        """Text and ids of two neighbouring stretches as one, wherever they were cut apart."""
        (before, l_ids), (after, r_ids) = left, right
        i = j = WINDOW
        while True:
            a = max(map(before.rfind, SPACES, itertools.repeat(0), itertools.repeat(max(0, len(before) - i)))) + 1
            space = SPACE.search(after, j)
            b = space.start() if space else len(after)
            had_l, had_r = self.encode_window(before[a:]), self.encode_window(after[:b])
            window = self.encode_window(before[a:] + after[:b])
            m, n = len(l_ids) - len(had_l), len(had_r)
            left_agrees = a == 0 or (0 < len(had_l) and m >= 0 and np.array_equal(l_ids[m:], had_l) and window[0] == had_l[0])
            right_agrees = b == len(after) or (0 < n and np.array_equal(r_ids[:n], had_r) and window[-1] == had_r[-1])
            if left_agrees and right_agrees:
                return before + after, np.concatenate([l_ids[: m if a else 0], window, r_ids[n if b < len(after) else len(r_ids) :]])
            i, j = i * (1 if left_agrees else 2), j * (1 if right_agrees else 2)

    def join_tree(self, parts: list[tuple[bytes, np.ndarray]]) -> np.ndarray:
        """Ids of neighbouring stretches, joined level by level."""
        while len(parts) > 1:
            parts = [self.join_texts(*parts[k : k + 2]) if k + 1 < len(parts) else parts[k] for k in range(0, len(parts), 2)]
        return parts[0][1]


@functools.lru_cache(maxsize=4)
def encoder(path: str) -> Encoder:
    return Encoder(path)


@functools.lru_cache(maxsize=4)
def _decoder(path: str):
    """Text of a list of ids.  A file without a decoder joins the tokens by spaces; its tokens alone are loaded then."""
    with open(path, encoding="utf-8") as f:
        spec = json.load(f)
    if spec["decoder"] is not None:
        tokenizer = encoder(path).tokenizer
        return lambda ids: tokenizer.decode(ids, skip_special_tokens=False)
    known = spec["model"]["vocab"] | {t["content"]: t["id"] for t in spec["added_tokens"]}
    strings: list[str | None] = [None] * (max(known.values(), default=-1) + 1)
    for token, i in known.items():
        strings[i] = token
    return lambda ids: " ".join([strings[i] for i in ids if i < len(strings) and strings[i] is not None])


def as_lists(ids: np.ndarray, bounds: np.ndarray) -> pa.Array:
    return pa.ListArray.from_arrays(pa.array(bounds, pa.int32()), pa.array(ids.view("<i4"), pa.int32()))


def halves(text: bytes) -> list[bytes]:
    """The leaves of a tree of halves, each cut at the character in its middle."""
    if len(text) <= PART_BYTES:
        return [text]
    k = len(text) // 2
    while text[k] & 0xC0 == 0x80:  # inside a character
        k += 1
    return halves(text[:k]) + halves(text[k:])


def cut(text: bytes, enc: Encoder) -> list[tuple[str, bytes, int, bool]]:
    """Leaves of a long text: (kind, payload, number of the stretch, whether it ends there).

    Kind ``text`` is a part of a stretch between long runs, ``piece`` of one long pre-token, ``id`` an added token.
    """
    out, start, number = [], 0, 0
    runs = [m.span() for m in re.finditer(rb"[^ \t\n\r\x0b\x0c]{%d,}" % (LONG_RUN + 1), text)]
    for a, b in [*runs, (len(text), len(text))]:
        number += 1
        leaves = halves(text[start:a])
        out.extend(("text", x, number, k == len(leaves) - 1) for k, x in enumerate(leaves))
        for x in enc.pieces(text[a:b].decode()) if b > a else ():
            number += 1
            if isinstance(x, int):
                out.append(("id", str(x).encode(), number, True))
            else:
                step = PART_BYTES // 2
                out.extend(("piece", x[k : k + step].encode(), number, k + step >= len(x)) for k in range(0, len(x), step))
        start = b
    return out


def encode(docs: DataFrame, path: str, long_chars: int = LONG_CHARS) -> DataFrame:
    """``doc_id`` and ``ids`` (array of int) of every row."""
    docs = documents(docs)
    ids_type = "doc_id long, ids array<int>"

    def whole(batches):
        enc = encoder(path)
        for batch in batches:
            first = 0
            for n, *ids in enc.encode_some(batch.column("text")):
                yield pa.RecordBatch.from_arrays([batch.column("doc_id").slice(first, n), as_lists(*ids)], ["doc_id", "ids"])
                first += n

    def leaves(batches):
        enc = encoder(path)
        for batch in batches:
            for doc, digest, text in zip(batch.column("doc_id").to_pylist(), batch.column("digest").to_pylist(), batch.column("text").cast(pa.binary()).to_pylist()):
                rows = [(doc, digest, k, *leaf) for k, leaf in enumerate(cut(text, enc))]
                for k in range(0, len(rows), 64):
                    yield pa.RecordBatch.from_pylist([dict(zip(leaf_type.names, r)) for r in rows[k : k + 64]], schema=leaf_type)

    def encode_leaves(batches):
        enc = encoder(path)
        for batch in batches:
            first = 0
            for n, ids in enc.encode_leaves(batch):
                names = ["doc_id", "digest", "part", "kind", "payload", "number"]
                own = [batch.column(c).slice(first, n) for c in names]
                yield pa.RecordBatch.from_arrays([*own, pa.array([x.tobytes() for x in ids], pa.binary())], [*names, "ids"])
                first += n

    def concatenate(rows: pd.DataFrame) -> pd.DataFrame:
        enc = encoder(path)
        copies = int((rows["part"] == 0).sum())
        rows = rows.drop_duplicates("part").sort_values("part")
        out: list[np.ndarray] = []
        for _, own in itertools.groupby(zip(rows["number"], rows["kind"], rows["payload"], rows["ids"]), key=lambda r: r[0]):
            own = [(kind, payload, np.frombuffer(ids, "<u4")) for _, kind, payload, ids in own]
            if own[0][0] == "text":
                out.append(enc.join_tree([(payload, ids) for _, payload, ids in own]))
            else:  # an added token is its only part
                out.append(np.array(enc.join_all([ids.tolist() for *_, ids in own], True), "<u4"))
        ids = np.concatenate(out).astype(np.int32)
        return pd.DataFrame({"doc_id": [rows["doc_id"].iloc[0]] * copies, "ids": [ids] * copies})

    leaf_type = pa.schema([("doc_id", pa.int64()), ("digest", pa.string()), ("part", pa.int32()), ("kind", pa.string()), ("payload", pa.binary()), ("number", pa.int32()), ("last", pa.bool_())])
    is_long = F.coalesce(F.length("text") > long_chars, F.lit(False))
    short = docs.where(~is_long).mapInArrow(whole, ids_type)
    parts = (
        docs.where(is_long)
        .withColumn("digest", F.sha2("text", 256))
        .mapInArrow(leaves, "doc_id long, digest string, part int, kind string, payload binary, number int, last boolean")
        .repartition("doc_id", "digest", "part")
        .mapInArrow(encode_leaves, "doc_id long, digest string, part int, kind string, payload binary, number int, ids binary")
    )
    long = parts.groupBy("doc_id", "digest").applyInPandas(concatenate, ids_type)
    return short.unionByName(long)


def decode(encoded: DataFrame, path: str) -> DataFrame:
    """``doc_id``, ``ids`` and the decoded ``text`` (special tokens kept); null ids decode to an empty text."""

    def texts(batches):
        decoded = _decoder(path)
        for batch in batches:
            for first in range(0, len(batch), DECODE_ROWS):  # only so many texts and one list of ids are held at once
                some = batch.slice(first, DECODE_ROWS)
                out = [decoded(ids.values.to_numpy().tolist() if ids.is_valid else []) for ids in some.column("ids")]
                yield pa.RecordBatch.from_arrays([some.column("doc_id"), some.column("ids"), pa.array(out, pa.string())], ["doc_id", "ids", "text"])

    return encoded.select("doc_id", "ids").mapInArrow(texts, "doc_id long, ids array<int>, text string")


def digests(decoded: DataFrame, keep: tuple[str, ...] = ()) -> DataFrame:
    """Number of tokens and the two digests of each row."""
    return decoded.select(
        "doc_id",
        *keep,
        F.size("ids").cast("long").alias("n_tokens"),
        F.sha2(F.array_join(F.col("ids").cast("array<string>"), " "), 256).alias("ids_sha256"),
        F.sha2(F.col("text"), 256).alias("decoded_sha256"),
    )
