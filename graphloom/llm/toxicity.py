"""Toxicity scores through a noisy channel.

Writers hide words by look-alike digits and signs, by separators between letters
and by repeating letters.  A suspicious token is a lattice: each character may
stand for a letter it looks like, for nothing (a separator or a repeat), or for
itself.  Viterbi finds the likeliest letters under a character trigram model of
the corpus and the channel's costs.  White space in a run of single
characters, or inside a telling word, may be left out too.  The restored words
are then scored by how surely words like them mark toxic documents among the
labelled ones.
"""

from __future__ import annotations

import re
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.ship import ship
from .common import materialise, table
from .sparse_text import id_hash_mod, map_texts

#: Labelled documents learned from at most: clean ones, toxic ones.
TRAIN_PER_LABEL = (12_000, 4_000)
#: A document is called toxic from this score on.
CALL_FROM = 0.3
MEMO_WORDS = 200_000

# ---- fixed values: what a sign may stand for
LOOK_ALIKES = {
    "0": "o", "1": "il", "2": "z", "3": "e", "4": "a", "5": "s", "6": "g", "7": "t", "8": "b", "9": "g",
    "@": "a", "$": "s", "!": "i", "|": "il", "+": "t", "(": "c", "€": "e", "£": "l",
}
# ---- end of fixed values
#: Costs in nats: a look-alike, a separator or repeat left out, a sign kept as a gap between words.
COST_ALIKE, COST_DROP, COST_GAP = 1.0, 0.7, 3.0
STEM_LENGTHS = range(3, 8)
OUTER = ".,;:?!\"'()[]{}<>«»“”‘’`#%&*|~^=…-_/\\"
OUTER_ONLY = "".join(c for c in OUTER if c not in LOOK_ALIKES)
SPACED = re.compile(r"(?<!\S)\S(?:\s+\S){2,}(?!\S)")
#: Costs in nats of white space kept between words of a run, each tried: how evenly its writer spaced letters isn't known.
COST_SPACE = (0.0, 1.5, 3.0)
#: Share of toxic texts from which a word or stem is telling.
TELLING = 0.2
WIDE = re.compile(r"\s{2,}")
TRIPLE = re.compile(r"(.)\1\1")

SIZE = 64  # classes of characters: 0 gap, 1-26 a-z, 27-62 accented Latin letters, 63 other letters
_CLASS = np.zeros(0x250, np.uint8)
_CLASS[97:123] = np.arange(1, 27)
for _c in range(0xDF, 0x250):
    if chr(_c).isalpha():
        _CLASS[_c] = 27 + (_c - 0xDF) % 36


def char_class(c: str) -> int:
    n = ord(c)
    return int(_CLASS[n]) if n < 0x250 else 63 if c.isalpha() else 0


def trigram_counts(text: str) -> np.ndarray:
    """Indices of all trigrams of classes of the lower-cased text, a gap before and after."""
    units = np.frombuffer(text.lower().encode("utf-32-le", "surrogatepass"), "<u4")
    classes = np.where(units < 0x250, _CLASS[np.minimum(units, 0x24F)], 63).astype(np.int32)
    framed = np.concatenate([np.zeros(2, np.int32), classes, np.zeros(1, np.int32)])
    return (framed[:-2] * SIZE + framed[1:-1]) * SIZE + framed[2:]


@dataclass
class CharModel:
    """Log-probability of a class after two others, trigrams backed off to bigrams and single ones."""

    log_p: np.ndarray

    @staticmethod
    def of(counts: np.ndarray) -> CharModel:
        three = counts.reshape(SIZE, SIZE, SIZE).astype(np.float64)
        two, one = three.sum(axis=0), three.sum(axis=(0, 1))
        p1 = (one + 1) / (one.sum() + SIZE)
        p2 = (two + 5 * p1) / (two.sum(axis=1, keepdims=True) + 5)
        p3 = (three + 5 * p2) / (three.sum(axis=2, keepdims=True) + 5)
        return CharModel(np.log(p3).astype(np.float32))


def restore(token: str, model: CharModel, best: int = 3, space: float = COST_GAP) -> list[str]:
    """The likeliest readings of a lower-cased token, best first; gaps are spaces.

    White space may be left out, or kept at the cost ``space``.  Viterbi over states of the last two classes; a state keeps its best prefix.
    """
    log_p = model.log_p
    # A prefix is a chain of pairs (the one before, letter), so time and memory are linear in the token.
    states: dict[tuple[int, int], tuple[float, tuple | None]] = {(0, 0): (0.0, None)}
    for i, c in enumerate(token):
        letters: list[tuple[str, float]] = []
        if c.isalpha():
            letters.append((c, 0.0))
        letters += [(x, COST_ALIKE) for x in LOOK_ALIKES.get(c, "")]
        if not c.isalpha():
            letters.append((" ", space if c.isspace() else COST_GAP))
        dropped = not c.isalnum() or (i > 0 and token[i - 1] == c)
        after: dict[tuple[int, int], tuple[float, tuple | None]] = {}
        for (a, b), (score, text) in states.items():
            if dropped:
                was = after.get((a, b))
                if was is None or score - COST_DROP > was[0]:
                    after[(a, b)] = (score - COST_DROP, text)
            for x, cost in letters:
                k = char_class(x)
                if x == " " and b == 0:
                    continue
                s = score + float(log_p[a, b, k]) - cost
                was = after.get((b, k))
                if was is None or s > was[0]:
                    after[(b, k)] = (s, (text, x))
        states = after or states
    ends = sorted(((s + float(log_p[a, b, 0]), spelled(t)) for (a, b), (s, t) in states.items()), reverse=True)
    return [t.strip() for _, t in ends[:best] if t.strip()]


def spelled(chain: tuple | None) -> str:
    letters: list[str] = []
    while chain is not None:
        chain, x = chain
        letters.append(x)
    return "".join(reversed(letters))


def core(token: str) -> str:
    """The token without signs around it."""
    return token.lstrip(OUTER).rstrip(OUTER + "$@+€£")


def edged(token: str) -> str:
    """The token without signs around it, but look-alikes kept: they may be its first or last letters."""
    return token.strip(OUTER_ONLY)


def legible(word: str) -> bool:
    return any(c.isalpha() or c in LOOK_ALIKES for c in word)


def readings(token: str, model: CharModel) -> list[str]:
    """Words that a lower-cased token may be: itself, or if it is suspicious what the channel restores.

    A token with look-alikes at its edges is read with them and without them.
    """
    word, whole = core(token), edged(token)
    plain = word.isalpha() and not TRIPLE.search(word)
    texts = [word] if plain else restore(word, model) if legible(word) else []
    if whole != word and legible(whole):
        texts = texts + restore(whole, model)
    return list(dict.fromkeys([w for text in texts for w in text.split()]))


def run_readings(run: str, model: CharModel) -> list[str]:
    """Words of a run of single characters: segmented by the lattice, split at wider white space only, and all of it joined."""
    texts: list[str] = []
    for strip in (core, edged):
        for joined in ["".join(map(strip, part.split())) for part in (run, *WIDE.split(run))]:
            if legible(joined):
                texts += [joined] if joined.isalpha() else restore(joined, model)
    for pieces in stripped(run):
        for cost in COST_SPACE:
            texts += restore(pieces, model, space=cost)
    return list(dict.fromkeys([w for text in texts for w in text.split()]))


def stripped(passage: str) -> list[str]:
    """The passage with its tokens' outer signs left out, without and with look-alikes at edges."""
    both = dict.fromkeys([" ".join(filter(None, map(strip, passage.split()))) for strip in (core, edged)])
    return [x for x in both if legible(x)]


def spaced_words(text: str, model: CharModel) -> list[str]:
    """Readings of runs of single characters between white space."""
    return [w for run in dict.fromkeys(SPACED.findall(text)) for w in run_readings(run, model)]


def doc_words(text: str, model: CharModel) -> set[str]:
    """Restored words of a whole text."""
    low = text.lower()
    words = {w for token in set(low.split()) for w in readings(token, model)}
    words.update(spaced_words(low, model))
    return words


def lower_bound(p: np.ndarray, n: np.ndarray, z: float = 5.5) -> np.ndarray:
    """Wilson's lower bound of a share ``p`` of ``n``; ``z`` is high since it holds for many thousands of traits at once."""
    return (p + z * z / (2 * n) - z * np.sqrt(p * (1 - p) / n + z * z / (4 * n * n))) / (1 + z * z / n)


_ONE = {c: x[0] for c, x in LOOK_ALIKES.items()} | {"1": "i", "|": "i", "l": "i", "£": "i"}


def skeleton(word: str) -> str:
    """The word with look-alikes as letters, i and l as one, and other signs left out."""
    return "".join([x for x in (_ONE.get(c, c) for c in word) if x.isalpha()])


@dataclass
class ToxicityModel:
    """Character model, and how surely each telling word marks a toxic document.

    ``words`` holds words seen often enough, clean ones too where a telling stem
    begins them; ``stems`` holds beginnings that unseen words are judged by.
    """

    chars: CharModel
    words: dict[str, float]
    stems: dict[str, float]
    base: float
    memo: dict[str, float] = field(default_factory=dict)
    skeleton_memo: dict[str, tuple[str, ...]] = field(default_factory=dict)

    def __post_init__(self) -> None:
        self.telling_words = {skeleton(w) for w, p in self.words.items() if p >= TELLING}
        self.telling_stems = {skeleton(w) for w in self.stems}
        self.beginnings = {w[:n] for w in self.telling_words | self.telling_stems for n in range(1, len(w))}

    def __getstate__(self) -> dict:
        return {**self.__dict__, "memo": {}, "skeleton_memo": {}}

    def sureness(self, word: str) -> float:
        known = self.words.get(word)
        if known is None:
            known = max((self.stems.get(word[:n], 0.0) for n in STEM_LENGTHS), default=0.0)
        return known

    def word_score(self, token: str) -> float:
        known = self.memo.get(token)
        if known is None:
            known = max(map(self.sureness, readings(token, self.chars)), default=0.0)
            if len(self.memo) >= MEMO_WORDS:
                self.memo.clear()
            self.memo[token] = known
        return known

    def skeletons(self, token: str) -> tuple[str, ...]:
        """Skeletons of the token without and with look-alikes at its edges."""
        known = self.skeleton_memo.get(token)
        if known is None:
            known = tuple({skeleton(core(token)), skeleton(edged(token))})
            if len(self.skeleton_memo) >= MEMO_WORDS:
                self.skeleton_memo.clear()
            self.skeleton_memo[token] = known
        return known

    def is_telling(self, bones: str) -> bool:
        return bones in self.telling_words or any(bones[:n] in self.telling_stems for n in STEM_LENGTHS)

    def chunked(self, tokens: list[str]) -> set[str]:
        """Passages where tokens in a row, joined, spell a telling word or begin with a telling stem.

        A passage goes on over single characters beside it, so the lattice sees all of a spaced word.
        """
        found = set()
        heads = {t: x for t in set(tokens) if (x := self.beginnings.intersection(self.skeletons(t)))}
        for i in [i for i, t in enumerate(tokens) if t in heads] if heads else []:
            begun, j = heads[tokens[i]], i + 1
            while begun and j < len(tokens):
                joined, j = {x + y for x in begun for y in self.skeletons(tokens[j])}, j + 1
                if any(map(self.is_telling, joined)) and any(len(t) > 1 for t in tokens[i:j]):
                    a, b = i, j
                    while a and len(tokens[a - 1]) == 1:
                        a -= 1
                    while b < len(tokens) and len(tokens[b]) == 1:
                        b += 1
                    found.add(" ".join(tokens[a:b]))
                begun = self.beginnings & joined
        return found

    def score(self, text: str) -> float:
        """That of the surest word of the restored text, and at least ``base``."""
        low = text.lower()
        tokens = low.split()
        best = max(map(self.word_score, set(tokens)), default=0.0)
        for w in spaced_words(low, self.chars):
            best = max(best, self.sureness(w))
        for passage in self.chunked(tokens):
            known = self.memo.get(passage)
            if known is None:
                # As such chunks may be words of their own, their white space costs nothing to keep.
                words = [w for p in stripped(passage) for x in restore(p, self.chars, space=0.0) for w in x.split()]
                known = self.memo[passage] = max(map(self.sureness, words), default=0.0)
            best = max(best, known)
        return max(best, self.base)


def corpus_characters(docs: DataFrame) -> CharModel:
    """Character model from every whole text of ``docs``."""
    ship(docs.sparkSession)

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(SIZE**3, np.int64)
        for b in batches:
            joined = np.concatenate([trigram_counts(t) for t in b.column(0).to_pylist()])
            total += np.bincount(joined, minlength=SIZE**3)
        at = np.flatnonzero(total)
        yield pa.RecordBatch.from_arrays([pa.array(at.astype(np.int32)), pa.array(total[at])], ["at", "n"])

    texts = docs.select(F.col("text").cast("string").alias("text")).where("text IS NOT NULL")
    rows = texts.mapInArrow(count, "at int, n long").groupBy("at").agg(F.sum("n").alias("n")).toPandas()
    counts = np.zeros(SIZE**3, np.int64)
    counts[rows["at"].to_numpy()] = rows["n"].to_numpy()
    return CharModel.of(counts)


def train(
    docs: DataFrame,
    labels: DataFrame,
    chars: CharModel,
    label: str = "toxic",
    per_label: tuple[int, int] = TRAIN_PER_LABEL,
    least_hits: int = 8,
) -> ToxicityModel:
    """Learn the lexicon from at most ``per_label`` labelled documents (clean, toxic), by a seeded hash of the id.

    A word counts once per distinct text, weighted by how many labelled documents
    one of the sample stands for.  Telling words are in ``least_hits`` toxic texts
    or more and their share of toxic texts is surely a fifth.  A stem counts words,
    not texts, so one common word doesn't make its beginning telling.
    """
    ship(docs.sparkSession)
    rated = labels.where(F.col("doc_id").isNotNull() & F.col(label).isin(0, 1))
    rated = rated.select("doc_id", F.col(label).cast("int").alias("_label"))
    drawn = [rated.where(F.col("_label") == y).orderBy(F.xxhash64(F.lit(5), "doc_id"), "doc_id").limit(m) for y, m in enumerate(per_label)]
    ids = drawn[0].unionByName(drawn[1]).dropDuplicates(["doc_id"])
    sample = docs.select("doc_id", "text").join(F.broadcast(ids), "doc_id").where("text IS NOT NULL")
    all_of = {r["_label"]: r["count"] for r in rated.groupBy("_label").count().collect()}
    weight = [max(1.0, all_of.get(y, 0) / per_label[y]) for y in (0, 1)]
    sample = materialise(sample.select("_label", "text").dropDuplicates(), "toxicity-sample")

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        hits: list[Counter[str]] = [Counter(), Counter()]
        for b in batches:
            for y, t in zip(b.column(0).to_pylist(), b.column(1).to_pylist(), strict=True):
                hits[y].update(doc_words(t, chars))
        names = list(hits[0] | hits[1])
        counts = [pa.array([h[x] for x in names], pa.int64()) for h in hits]
        yield pa.RecordBatch.from_arrays([pa.array(names, pa.string()), *counts], ["word", "clean", "toxic"])

    found = (
        sample.mapInArrow(count, "word string, clean long, toxic long")
        .groupBy("word")
        .agg(F.sum("toxic").alias("toxic"), F.sum("clean").alias("clean"), F.sum(F.col("toxic") + F.col("clean")).alias("n"))
        .withColumn("share", F.col("toxic") * weight[1] / (F.col("toxic") * weight[1] + F.col("clean") * weight[0]))
    )
    found = materialise(found, "toxicity-words")
    beginnings = F.array_distinct(F.transform(F.array(*map(F.lit, STEM_LENGTHS)), lambda n: F.left("word", n)))
    stems = (
        found.withColumn("stem", F.explode(beginnings))
        .where(F.length("stem") >= STEM_LENGTHS[0])
        .groupBy("stem")
        .agg(
            F.sum(F.col("toxic") / F.col("n")).alias("t"),
            F.sum(F.col("clean") / F.col("n")).alias("c"),
            F.count(F.lit(1)).alias("n"),
            F.sum("toxic").alias("toxic"),
        )
        .withColumn("share", F.col("t") * weight[1] / (F.col("t") * weight[1] + F.col("c") * weight[0]))
    )
    telling = stems.where((F.col("toxic") >= least_hits) & (F.col("n") >= least_hits) & (F.col("share") >= 0.2)).toPandas()
    sure = lower_bound(telling["share"].to_numpy(np.float64), telling["n"].to_numpy(np.float64), 3.0)
    stem_table = {t: float(p) for t, p in zip(telling["stem"], sure, strict=True) if p >= 0.2}
    # Words of the sample that matter: often toxic ones, and known ones under a telling stem.
    under = F.exists(beginnings, lambda x: x.isin([*stem_table])) if stem_table else F.lit(False)
    hot = (F.col("toxic") >= least_hits) & (F.col("share") >= 0.2)
    words = found.where(hot | ((F.col("n") >= 4) & under)).toPandas()
    sure = lower_bound(words["share"].to_numpy(np.float64), words["n"].to_numpy(np.float64))
    word_table = {
        w: float(p)
        for w, p, q, n in zip(words["word"], sure, words["share"], words["n"], strict=True)
        if p >= 0.2 or q < 0.5 or n >= 12
    }
    return ToxicityModel(chars, word_table, stem_table, 0.01)


def score(docs: DataFrame, model: ToxicityModel, call_from: float = CALL_FROM) -> DataFrame:
    """``doc_id, score, predicted`` for every document, from its whole text.

    Null and empty texts get the lowest score.  Null and repeated ids are scored
    like others; an empty table gives no rows; other columns aren't read.
    """
    ship(docs.sparkSession)

    def judge(text: str | None) -> tuple[float, int]:
        s = model.score(text or "")
        return s, int(s >= call_from)

    return map_texts(docs, judge, "score double, predicted int")


def op3_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All documents; labels of ids whose hash is 2 modulo 4 are never seen."""
    docs, labels = table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels")
    held_out = F.coalesce(id_hash_mod(F.col("doc_id"), 4) == 2, F.lit(False))
    model = train(docs, labels.where(~held_out), corpus_characters(docs))
    return score(docs, model).select("doc_id", held_out.alias("held_out"), "score", "predicted")
