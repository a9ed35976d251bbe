"""Packing token sequences of bounded length with a bounded number of open windows.

Each partition is one online packer.  It keeps ``open_windows`` windows open; a
piece goes into the window it fits best.  When it fits none, the fullest window
is filled up with the head of the piece and emitted.  At its end a partition
merges its open windows; what is then left of each partition is merged with
others in a tree until one window is left.
"""

from __future__ import annotations

import json
import os
import re
import zlib
from collections.abc import Callable, Iterable, Iterator
from itertools import compress, count, repeat
from operator import is_

import numpy as np
import pandas as pd
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.ship import ship
from .common import _IS_SPACE, _LOWER, materialise, table

MEMO_PIECES = 300_000
#: Texts whose words are looked up together have at most so many bytes; a longer text is taken alone, in parts.
SLICE_BYTES = 4 << 20
#: New pieces of words that are encoded together.
TOGETHER = 8192
PIECES = (
    "doc_id long, start long, length long, ids_crc32 long, doc_tokens long, "
    "sequence_id long, offset long, sequence_order long, ids binary, source_part long"
)


#: Latin letters that stay themselves, or become their small ones, in all steps before the model.
LATIN_LETTERS = re.compile("[A-Za-z\xc0-\xd6\xd8-\xf6\xf8-\u012f\u0131-\u024f]+")
#: Small Latin letters that no normalizer changes.
SMALL_LETTERS = re.compile("[a-z\\xdf-\\xf6\\xf8-\\xff]+")
#: Of each byte: white space, ASCII letter, part of a longer character, ASCII sign, control.
_SPACE, _LETTER, _HIGH, _SIGN, _CONTROL = 0, 1, 2, 4, 8
_KIND = np.full(256, _CONTROL, np.uint8)
_KIND[33:127], _KIND[128:], _KIND[_IS_SPACE] = _SIGN, _HIGH, _SPACE
_KIND[65:91] = _KIND[97:123] = _LETTER
_KINDS, _SMALL, _SPACES = _KIND.tobytes(), _LOWER.tobytes(), re.compile(rb"[\x20\x09-\x0D]")


def _latin(raw: np.ndarray, at: np.ndarray) -> np.ndarray:
    """Whether the bytes of UTF-8 at the places ``at`` belong to ``LATIN_LETTERS``."""
    byte, before = raw[at], raw[at - 1]
    lead = (byte >= 0xC3) & (byte <= 0xC9)  # U+00C0 to U+027F
    behind = (byte < 0xC0) & (before >= 0xC3) & (before <= 0xC9)
    other = (before == 0xC3) & ((byte == 0x97) | (byte == 0xB7)) | (before == 0xC4) & (byte == 0xB0) | (before == 0xC9) & (byte >= 0x90)
    return lead | behind & ~other


def cut_words(raw: np.ndarray, starts: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Words of UTF-8 texts that begin at ``starts`` in ``raw``, as pieces: their bytes, each one's place there, and its place in ``raw``.

    A word of Latin letters with ASCII signs behind is cut before the first
    sign: pre-tokenizers that part letters from the rest cut there too.  It and
    any other word of such letters or ASCII signs gets small ASCII letters.  Others
    stay as they are, and so do those with ``<|``, which may be special tokens.
    """
    data = raw.tobytes()
    kind = np.frombuffer(data.translate(_KINDS), np.uint8)
    solid = kind != _SPACE
    fresh = np.ones(len(raw), bool)
    np.logical_not(solid[:-1], out=fresh[1:])
    fresh[starts[starts < len(raw)]] = True
    letter = (kind == _LETTER) | (kind == _HIGH)
    turns = np.flatnonzero((kind[1:] == _SIGN) & letter[:-1] & ~fresh[1:]) + 1
    fresh &= solid
    words = np.flatnonzero(fresh)
    owner = np.searchsorted(words, turns, "right") - 1
    first = (np.diff(owner, prepend=-1) != 0) & letter[words[owner]]
    turns, owner = turns[first], owner[first]
    # words that stay as they are
    odd = np.zeros(len(words), bool)
    strange = np.flatnonzero((kind == _CONTROL) | (raw == ord("<")))
    strange = strange[(kind[strange] == _CONTROL) | (raw[np.minimum(strange + 1, len(raw) - 1)] == ord("|"))]
    odd[np.searchsorted(words, strange, "right") - 1] = True
    high = np.flatnonzero(kind == _HIGH)
    if len(high):
        sign = np.where(letter[words], len(raw), words)  # the first one of each word
        sign[owner] = turns
        holder = np.searchsorted(words, high, "right") - 1
        odd[holder[(high > sign[holder]) | ~_latin(raw, high)]] = True
    small = np.frombuffer(bytearray(data.translate(_SMALL)), np.uint8)
    if odd.any():
        ends = np.append(words[1:], len(raw))
        edges = np.zeros(len(raw) + 1, np.int8)
        edges[words[odd]] += 1
        edges[ends[odd]] -= 1
        np.copyto(small, raw, where=np.cumsum(edges[:-1], dtype=np.int8).view(bool))
    fresh[turns[~odd[owner]]] = True
    return small[solid], np.flatnonzero(fresh[solid]), np.flatnonzero(fresh)


class WordTokenizer:
    """Token ids of texts, by memory of words.

    For vocabularies that lower-case, drop white space and part letters from
    other signs, a text's ids are its words' ids in a row, and a word's ids those
    of its letters and of the signs behind.  Memory of such pieces has two
    generations: those that recur move to the young one, the old one is let go
    when the young one is full.  New pieces are encoded together, a special token
    (found before any other step) between them.
    """

    def __init__(self, path: str) -> None:
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer

        self.model = Tokenizer.from_file(path)
        self.pieces: tuple[dict[bytes, bytes], dict[bytes, bytes]] = ({}, {})
        special = self.model.get_added_tokens_decoder()
        self.specials = [t.content for t in special.values()]
        self.mark = next(((i, t.content) for i, t in special.items() if t.special), None)
        parts = json.loads(self.model.to_str())
        steps = json.dumps([parts["normalizer"], parts["pre_tokenizer"]])
        #: Whether the vocabulary is of that kind and its special tokens are known by ``<|``; with any other, texts are encoded whole.
        self.parted = '"Lowercase"' in steps and "[\\\\p{L}]+" in steps and all("<|" in t and not re.search("\\s", t) for t in self.specials)
        self.ends = self._letters(parts) if self.parted else None

    def _letters(self, parts: dict) -> np.ndarray | None:
        """Whether each id ends a word, and as ``bare`` the model without other steps; null unless those leave words of small Latin letters whole."""
        model, suffix = parts["model"], parts["model"].get("end_of_word_suffix")
        steps = [parts["normalizer"], parts["pre_tokenizer"]]
        steps = [x for y in steps for x in (y.get("normalizers") or y.get("pretokenizers") or [y])]
        cuts = {x for y in steps if y["type"] == "Split" for x in y["pattern"].get("Regex", "?").split("|")}
        if (
            model["type"] != "BPE"
            or not suffix
            or model["dropout"]
            or not {"Split", "ByteLevel"} <= {y["type"] for y in steps} <= {"NFC", "Lowercase", "Replace", "Split", "ByteLevel"}
            or any(y["pattern"] != {"Regex": "\\s+"} for y in steps if y["type"] == "Replace")
            or any(y["add_prefix_space"] or y.get("use_regex") for y in steps if y["type"] == "ByteLevel")
            or not {x for x in cuts if not x.startswith("'")} <= {"[\\p{L}]+", "[\\p{N}]", "[^\\s\\p{L}\\p{N}]+"}
            or any(map(SMALL_LETTERS.fullmatch, self.specials))
        ):
            return None
        from tokenizers import Tokenizer, normalizers, pre_tokenizers

        self.bare = Tokenizer.from_str(self.model.to_str())
        self.bare.normalizer, self.bare.pre_tokenizer = normalizers.Sequence([]), pre_tokenizers.Sequence(
            [pre_tokenizers.WhitespaceSplit(), pre_tokenizers.ByteLevel(add_prefix_space=False, use_regex=False)]
        )
        vocabulary = self.model.get_vocab()
        ends = np.zeros(max(vocabulary.values()) + 1, bool)
        ends[[i for token, i in vocabulary.items() if token.endswith(suffix)]] = True
        return ends

    def _encode(self, texts: list[str]) -> list[bytes]:
        if self.ends is None:
            return self._encode_any(texts)
        words = list(filter(SMALL_LETTERS.fullmatch, texts))
        if not words:
            return self._encode_any(texts)
        ids = np.array(self.bare.encode_batch_fast([" ".join(words)], add_special_tokens=False)[0].ids, "<u4")
        ends = np.flatnonzero(self.ends[ids]) + 1
        if len(ends) != len(words):
            return self._encode_any(texts)
        raw, at = ids.tobytes(), [0, *(4 * ends).tolist()]
        found = dict(zip(words, map(raw.__getitem__, map(slice, at, at[1:])), strict=False))
        if others := [t for t in texts if t not in found]:
            found.update(zip(others, self._encode_any(others), strict=True))
        return [found[t] for t in texts]

    def _encode_any(self, texts: list[str]) -> list[bytes]:
        joined = "" if self.mark is None else self.mark[1].join(texts)
        if self.mark is None or sum(map(joined.count, self.specials)) >= len(texts):
            return [np.array(e.ids, "<u4").tobytes() for e in self.model.encode_batch(texts, add_special_tokens=False)]
        ids = np.array(self.model.encode_batch_fast([joined], add_special_tokens=False)[0].ids, "<u4")
        ends = np.append(np.flatnonzero(ids == self.mark[0]), len(ids))
        starts = np.concatenate([[0], ends[:-1] + 1])
        raw = ids.tobytes()
        return [raw[4 * a : 4 * b] for a, b in zip(starts.tolist(), ends.tolist(), strict=True)]

    def ids(self, text: str) -> bytes:
        """Little-endian unsigned 32-bit ids of the whole text."""
        return next(self.each(pa.array([text.encode("utf-8", "surrogatepass")], pa.large_binary()).view(pa.large_string())))

    def each(self, texts: pa.Array) -> Iterator[bytes]:
        """Of each text, little-endian unsigned 32-bit ids of the whole; null is an empty one.

        Distinct words of a slice of texts are found first and looked up once.
        """
        if not self.parted:  # white space may be part of ids, or words depend on what is beside them
            for text in texts.to_pylist():
                yield np.array(self.model.encode(text or "", add_special_tokens=False).ids, "<u4").tobytes()
            return
        ends = np.cumsum(pc.fill_null(pc.binary_length(texts), 0).to_numpy(zero_copy_only=False), dtype=np.int64)
        at = 0
        while at < len(texts):
            done = ends[at - 1] if at else 0
            stop = max(at + 1, int(np.searchsorted(ends, done + SLICE_BYTES, "right")))
            some = texts.slice(at, stop - at).cast(pa.large_string())
            yield from self._slice(some) if ends[stop - 1] - done <= SLICE_BYTES else [b"".join(self._slice(_split(some)))]
            at = stop

    def _slice(self, texts: pa.Array) -> Iterator[bytes]:
        texts = pc.fill_null(texts, "")
        _, offsets, data = texts.buffers()
        offsets = np.frombuffer(offsets, np.int64, len(texts) + 1, 8 * texts.offset)
        raw = np.frombuffer(data or b"", np.uint8)[offsets[0] : offsets[-1]]
        if not len(raw):
            yield from repeat(b"", len(texts))
            return
        letters, places, at = cut_words(raw, offsets[:-1] - offsets[0])
        places = np.append(places, len(letters))
        pieces = pa.Array.from_buffers(pa.large_binary(), len(at), [None, pa.py_buffer(places), pa.py_buffer(letters)]).dictionary_encode()
        known = pa.array(self._piece_ids(pieces.dictionary.to_pylist()), pa.large_binary())
        _, ends, ids = known.take(pieces.indices).buffers()
        ends = np.frombuffer(ends, np.int64, len(at) + 1)[np.searchsorted(at, offsets - offsets[0])].tolist()
        view = memoryview(ids or b"")
        for a, b in zip(ends, ends[1:], strict=False):
            yield view[a:b].tobytes()

    def _piece_ids(self, pieces: list[bytes]) -> list[bytes]:
        """Ids of each of some distinct pieces of words."""
        young = self.pieces[0]
        out = list(map(young.get, pieces))
        gaps = list(compress(count(), map(is_, out, repeat(None))))
        new = _recall(self.pieces, {pieces[i] for i in gaps})
        for at in range(0, len(new), TOGETHER):
            some = new[at : at + TOGETHER]
            young.update(zip(some, self._encode(list(map(_text, some))), strict=True))
        for i in gaps:
            out[i] = young[pieces[i]]
        if len(young) > MEMO_PIECES:
            self.pieces = ({}, young)
        return out


def _split(text: pa.Array) -> pa.Array:
    """A long text, parted before white space into parts of ``SLICE_BYTES`` and the word that ends there."""
    data = text.view(pa.large_binary())[0].as_py()
    cuts = [0]
    while cuts[-1] < len(data):
        space = _SPACES.search(data, cuts[-1] + SLICE_BYTES)
        cuts.append(space.start() if space else len(data))
    places = pa.py_buffer(np.array(cuts, np.int64))
    return pa.Array.from_buffers(pa.large_string(), len(cuts) - 1, [None, places, pa.py_buffer(data)])


def _text(piece: bytes) -> str:
    text = piece.decode("utf-8", "replace")
    return text.lower() if not text.isascii() and LATIN_LETTERS.fullmatch(text) else text


def _recall(memory: tuple[dict, dict], keys: set) -> list:
    """The keys that neither generation holds; those of the old one move to the young one."""
    young, old = memory
    known = old.keys() & keys
    for k in known:
        young[k] = old[k]
    return list(keys - known)


_tokenizers: dict[str, WordTokenizer] = {}


def tokenizer(path: str) -> WordTokenizer:
    if path not in _tokenizers:
        _tokenizers[path] = WordTokenizer(path)
    return _tokenizers[path]


class Packer:
    """Bounded-space best-fit packing of one stream of documents."""

    def __init__(self, size: int, open_windows: int, first_id: int) -> None:
        self.size, self.limit, self.next_id = size, open_windows, first_id
        self.open: list[list] = []  # [free ids, pieces]

    def _emit(self, pieces: list[tuple]) -> list[tuple]:
        out, offset = [], 0
        order = max(p[4] for p in pieces)
        for doc, start, ids, total, _ in pieces:
            n = len(ids) // 4
            out.append((doc, start, n, zlib.crc32(ids), total, self.next_id, offset, order, ids))
            offset += n
        self.next_id += 1
        return out

    def add(self, doc: int | None, start: int, ids: bytes, total: int, order: int = 0) -> Iterator[list[tuple]]:
        """Place a run of a document's ids; yield each window that is full by it."""
        while ids:
            n = len(ids) // 4
            if n >= self.size:
                cut = self.size
                yield self._emit([(doc, start, ids[: 4 * cut], total, order)])
            else:
                fits = [w for w in self.open if w[0] >= n]
                if not fits and len(self.open) < self.limit:
                    self.open.append([self.size, []])
                    fits = self.open[-1:]
                window = min(fits or self.open, key=lambda w: w[0])  # the best fit, or else the fullest
                cut = min(n, window[0])
                window[0] -= cut
                window[1].append((doc, start, ids[: 4 * cut], total, order))
                if not window[0]:
                    self.open = [w for w in self.open if w is not window]
                    yield self._emit(window[1])
            start, ids = start + cut, ids[4 * cut :]

    def merge(self) -> Iterator[list[tuple]]:
        """Merge the open windows, fullest first, until one at most is left open."""
        windows, self.open, self.limit = sorted(self.open, key=lambda w: w[0]), [], 1
        for _, pieces in windows:
            for piece in pieces:
                yield from self.add(*piece)

    def rest(self) -> list[tuple]:
        return self._emit(self.open[0][1]) if self.open else []


def _table(rows: Iterable[tuple], part: int | None, keep_ids: bool) -> pa.RecordBatch:
    kinds = [pa.int64()] * 8 + [pa.binary(), pa.int64()]
    cols = list(zip(*rows, strict=True)) or [()] * 9
    cols = [*cols[:8], cols[8] if keep_ids else [None] * len(cols[8]), [part] * len(cols[0])]
    names = [x.split()[0] for x in PIECES.split(", ")]
    return pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(cols, kinds, strict=True)], names)


def _merger(level: int, size: int, fan_in: int) -> Callable[[pd.DataFrame], pd.DataFrame]:
    """Merges what is left of ``fan_in`` tasks; what is then left belongs to their group."""

    def merge(rows: pd.DataFrame) -> pd.DataFrame:
        group = int(rows["source_part"].iloc[0]) // fan_in
        packer = Packer(size, 1, (level << 58) | (group << 28))
        rows = rows.sort_values(["source_part", "offset"])
        full: list[tuple] = []
        for doc, start, ids, total, order in zip(
            rows["doc_id"], rows["start"], rows["ids"], rows["doc_tokens"], rows["sequence_order"], strict=True
        ):
            for window in packer.add(None if pd.isna(doc) else int(doc), int(start), bytes(ids), int(total), int(order)):
                full += window
        both = [_table(full, None, True).to_pandas(), _table(packer.rest(), group, True).to_pandas()]
        out = pd.concat([b for b in both if len(b)], ignore_index=True)
        return out.astype({"doc_id": "Int64", "source_part": "Int64"})

    return merge


def pack(
    docs: DataFrame,
    tokenizer_path: str,
    size: int = 2048,
    end_id: int = 1,
    open_windows: int = 16,
    with_ids: bool = True,
    fan_in: int = 64,
    order: Column | None = None,
) -> DataFrame:
    """Pack all documents into sequences of at most ``size`` ids; one row per piece.

    A document is its text's ids followed by ``end_id``; null text is an empty
    one, so each row gives one id at least.  Every id lies in exactly one piece.
    Returns ``doc_id, start, length, ids_crc32, doc_tokens, sequence_id, offset``,
    ``sequence_order`` and, unless ``with_ids`` is false, the ids as little-endian
    unsigned 32-bit integers.  All sequences are full but the last one; ids of
    sequences are unique, not gapless.  Ids of documents are carried along: null
    and repeated ones are packed like others.  An empty table gives no rows, and
    other columns aren't read.

    ``order``, a long over ``docs``, says where a document is to come;
    ``sequence_order`` is then the greatest of the sequence's documents, so
    sequences sorted by it follow that order but for the open windows.  Without
    ``order`` it is null.

    Scale: texts aren't shuffled.  A task's memory is its open windows; less than
    one window of each task goes to the merging tree (``fan_in`` tasks a step).
    Pieces are written once, so a lost executor can't change the packing.
    """
    spark = docs.sparkSession
    ship(spark)

    def pack_part(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        part = TaskContext.get().partitionId()
        encode, packer = tokenizer(tokenizer_path).each, Packer(size, open_windows, part << 28)
        last = np.array([end_id], "<u4").tobytes()
        for batch in batches:
            rows: list[tuple] = []
            docs, texts, places = batch.columns
            for doc, ids, at in zip(docs.to_pylist(), encode(texts), places.to_pylist(), strict=True):
                ids += last
                for window in packer.add(doc, 0, ids, len(ids) // 4, at):
                    rows += window
                if len(rows) >= 512:
                    yield _table(rows, None, with_ids)
                    rows = []
            if rows:
                yield _table(rows, None, with_ids)
        full = [x for window in packer.merge() for x in window]
        if full:
            yield _table(full, None, with_ids)
        if left := packer.rest():
            yield _table(left, part, True)

    at = F.coalesce(order.cast("long"), F.lit(0)) if order is not None else F.lit(0).cast("long")
    slim = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"), at.alias("at"))
    pieces = materialise(slim.mapInArrow(pack_part, PIECES), "pieces")
    done = [pieces.where("source_part IS NULL")]
    left = pieces.where("source_part IS NOT NULL")
    parts = (left.agg(F.max("source_part")).first()[0] or 0) + 1
    level = 0
    while True:
        level += 1

        key = F.floor(F.col("source_part") / fan_in).alias("_group")
        merged = materialise(left.groupBy(key).applyInPandas(_merger(level, size, fan_in), PIECES), "merged")
        done.append(merged.where("source_part IS NULL"))
        left = merged.where("source_part IS NOT NULL")
        if parts <= fan_in:
            break
        parts = -(-parts // fan_in)
    out = done[0]
    for more in [*done[1:], left]:
        out = out.unionByName(more)
    if order is None:
        out = out.withColumn("sequence_order", F.lit(None).cast("long"))
    return out.drop("source_part", *([] if with_ids else ["ids"]))


def default_tokenizer() -> str:
    import public_tokenizers

    return public_tokenizers.path("word_bpe_49k.json")


def op6_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All documents in sequences of 2,048 ids."""
    return pack(table(spark, sf_dir, "documents"), default_tokenizer(), with_ids=False).drop("sequence_order")
