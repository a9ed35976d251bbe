"""Removal of word passages that an earlier document has, with suffix automata.

A window is ``length`` words in a row.  Its anchor is the run of ``length // 2``
words in it with the least hash, so equal windows have equal anchors, and
consecutive windows mostly share one: a context is a maximal run of windows with
the same anchor, its content their words.  Anchors that one document alone has
are done with: none of their windows is anywhere else.

The reference is every distinct content under the anchors left, once, with the
smallest id that has it.  It is dealt by anchor into shards.  A shard adds the
real words of its contents, by rising id, to a suffix automaton whose states know
the smallest id that holds them, and streams each content through it: where the
matching statistic reaches ``length``, the state names the first document with
that window.  Every removed word is under a window that an automaton has matched;
hashes only decide what meets.  All documents take over what was found for their
contents.

:func:`reference_spans` does the same for a small reference: automata of its
shards are broadcast and all documents streamed through each.
"""

from __future__ import annotations

from collections.abc import Iterable, Iterator
from hashlib import blake2b

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.ship import ship
from .common import broadcast_if, bytes_of, materialise, table, window_hashes, word_hashes

#: Contents of an anchor beyond which its windows are dealt to shards one by one, instead of all to one.
HOT_CONTENTS = 200
#: Contents of a shard, about.
SHARD_CONTENTS = 2_000
#: What is wanted of texts is broadcast to them up to so many bytes; beyond that only its ids, up to so many; beyond that texts are shuffled whole.
TO_TEXTS_BYTES, IDS_BYTES = 8 << 20, 64 << 20
_ROW = ("doc_id", "row")


class SuffixAutomaton:
    """Suffix automaton of several sequences of hashable symbols; states know the first owner that holds them."""

    def __init__(self) -> None:
        self.next: list[dict] = [{}]
        self.link, self.length = [-1], [0]
        self.owner: list[int | None] = [None]

    def _clone(self, p: int, symbol: object, q: int) -> int:
        clone = len(self.next)
        self.next.append(dict(self.next[q]))
        self.link.append(self.link[q])
        self.length.append(self.length[p] + 1)
        self.owner.append(self.owner[q])
        self.link[q] = clone
        while p >= 0 and self.next[p].get(symbol) == q:
            self.next[p][symbol] = clone
            p = self.link[p]
        return clone

    def add(self, sequence: Iterable, owner: int | None = None) -> None:
        """Add a sequence; owners come in rising order, so a state keeps the one it was made for."""
        last = 0
        for symbol in sequence:
            q = self.next[last].get(symbol)
            if q is not None:
                last = q if self.length[q] == self.length[last] + 1 else self._clone(last, symbol, q)
                continue
            state = len(self.next)
            self.next.append({})
            self.length.append(self.length[last] + 1)
            self.link.append(0)
            self.owner.append(owner)
            p = last
            while p >= 0 and symbol not in self.next[p]:
                self.next[p][symbol] = state
                p = self.link[p]
            if p >= 0:
                q = self.next[p][symbol]
                self.link[state] = q if self.length[q] == self.length[p] + 1 else self._clone(p, symbol, q)
            last = state

    def matching(self, sequence: Iterable) -> list[int]:
        """At each symbol, the length of the longest suffix so far that some sequence holds."""
        state = n = 0
        out = []
        for symbol in sequence:
            while state and symbol not in self.next[state]:
                state = self.link[state]
                n = self.length[state]
            state = self.next[state].get(symbol, 0)
            n = n + 1 if state else 0
            out.append(n)
        return out

    def owners(self, sequence: Iterable, length: int) -> list[int | None]:
        """For each window of ``length`` symbols the first owner that holds it, or null where no sequence does."""
        goto, link, size = self.next, self.link, self.length
        state = n = 0
        out: list[int | None] = []
        for i, symbol in enumerate(sequence):
            while state and symbol not in goto[state]:
                state = link[state]
                n = size[state]
            state = goto[state].get(symbol, 0)
            n = n + 1 if state else 0
            while n >= length and size[link[state]] >= length:
                state = link[state]  # shorter suffixes than a window don't matter, and longer ones neither
            n = min(n, length)
            if i + 1 >= length:
                out.append(self.owner[state] if n >= length else None)
        return out


def contexts(words: np.ndarray, length: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """First window, number of windows and anchor of each context of a document's word hashes."""
    gram = max(1, length // 2)
    if len(words) < length:
        none = np.empty(0, np.int64)
        return none, none, none
    h = window_hashes(words, gram)
    offset = np.lib.stride_tricks.sliding_window_view(h, length - gram + 1).argmin(axis=1)
    at = offset + np.arange(len(offset))
    first = np.flatnonzero(np.diff(at, prepend=-1))
    count = np.diff(np.append(first, len(at)))
    return first, count, h[at[first]].view(np.int64)


def spaced(text: str) -> tuple[bytes, np.ndarray]:
    """The words of a text joined by one space, and where each begins; at the end where one more would."""
    data = b" ".join(text.encode("utf-8", "surrogatepass").split())
    if not data:
        return data, np.zeros(1, np.int64)
    gaps = np.flatnonzero(np.frombuffer(data, np.uint8) == 32)
    return data, np.concatenate([[0], gaps + 1, [len(data) + 1]])


def digests(data: bytes, begins: np.ndarray, first: np.ndarray, n_words: np.ndarray | int, size: int) -> bytes:
    """Digests of ``size`` bytes of the runs of words from ``first`` on, one after the other."""
    a, b = begins[first].tolist(), (begins[first + n_words] - 1).tolist()
    return b"".join([blake2b(data[i:j], digest_size=size).digest() for i, j in zip(a, b, strict=True)])


def _scan(docs: DataFrame, length: int) -> DataFrame:
    """All contexts: ``doc_id, row, first, count, anchor, digest`` (of the content)."""

    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            parts, whole, owners = [], [], []
            for doc, row, text in zip(*(c.to_pylist() for c in b.columns), strict=True):
                data, begins = spaced(text)
                found = contexts(word_hashes(data), length)
                if len(found[0]):
                    parts.append(found)
                    whole.append(digests(data, begins, found[0], found[1] - 1 + length, 8))
                    owners.append((doc, row, len(found[0])))
            if parts:
                first, count, anchor = (np.concatenate(x) for x in zip(*parts, strict=True))
                doc, row, n = (np.array(x, np.int64) for x in zip(*owners, strict=True))
                columns = [np.repeat(doc, n), np.repeat(row, n).astype(np.int32), first.astype(np.int32), count.astype(np.int32), anchor, np.frombuffer(b"".join(whole), "<i8")]
                yield pa.RecordBatch.from_arrays([pa.array(c) for c in columns], ["doc_id", "row", "first", "count", "anchor", "digest"])

    rows = docs.where("doc_id IS NOT NULL AND text IS NOT NULL").select(*_ROW, "text")
    return rows.mapInArrow(scan, "doc_id long, row int, first int, count int, anchor long, digest long")


def _with_text(docs: DataFrame, per_row: DataFrame, how: str) -> DataFrame:
    """Documents with what ``per_row`` has of them (``inner``) or with null where it has nothing (``left``)."""
    if bytes_of(per_row) <= TO_TEXTS_BYTES:
        return docs.join(F.broadcast(per_row), [*_ROW], how)
    ids = per_row.select("doc_id")
    if bytes_of(ids) > IDS_BYTES:
        return docs.join(per_row.hint("merge"), [*_ROW], how)
    # Only texts that something is wanted of are shuffled.
    some = docs.join(F.broadcast(ids), "doc_id", "left_semi").join(per_row.hint("merge"), [*_ROW], how)
    if how == "inner":
        return some
    rest = docs.where("doc_id IS NULL").unionByName(docs.where("doc_id IS NOT NULL").join(F.broadcast(ids), "doc_id", "left_anti"))
    return some.unionByName(rest, allowMissingColumns=True)


def _spans(rows: DataFrame, *columns: str) -> DataFrame:
    return materialise(rows.groupBy(*_ROW).agg(F.collect_list(F.struct(*columns)).alias("spans")), "spans")


def _fetch(docs: DataFrame, contents: DataFrame, length: int) -> DataFrame:
    """The words of ``contents``, read where their lead has them."""

    def fetch(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            rows = []
            for doc, text, spans in zip(*(c.to_pylist() for c in b.columns), strict=True):
                data, begins = spaced(text)
                for s in spans:
                    end = begins[s["first"] + s["count"] - 1 + length] - 1
                    rows.append((s["anchor"], s["digest"], doc, s["shared"], data[begins[s["first"]] : end]))
            if rows:
                kinds = [pa.int64(), pa.int64(), pa.int64(), pa.bool_(), pa.binary()]
                columns = [pa.array(c, k) for c, k in zip(zip(*rows, strict=True), kinds, strict=True)]
                yield pa.RecordBatch.from_arrays(columns, ["anchor", "digest", "lead", "shared", "words"])

    leads = contents.select("lead.*", "anchor", "digest", (F.col("lead.doc_id") < F.col("most")).alias("shared"))
    rows = _with_text(docs, _spans(leads, "first", "count", "anchor", "digest", "shared"), "inner").select("doc_id", "text", "spans")
    return rows.mapInArrow(fetch, "anchor long, digest long, lead long, shared boolean, words binary")


def _in_shard(length: int):
    """The automata of a shard: for each content the runs of windows that some smaller id may know, with the first that does."""

    def run(rows: pd.DataFrame) -> pd.DataFrame:
        out: list[tuple[int, int, int, int, int]] = []
        rows = rows.sort_values(["anchor", "lead", "digest"], kind="stable")
        edges = np.append(np.flatnonzero(np.diff(rows["anchor"].to_numpy(), prepend=rows["anchor"].iloc[0] - 1)), len(rows)).tolist()
        anchors, marks, leads, shared = (rows[c].tolist() for c in ("anchor", "digest", "lead", "shared"))
        words = [w.split(b" ") for w in rows["words"]]
        for a, b in zip(edges[:-1], edges[1:], strict=True):
            automaton = SuffixAutomaton()
            for i in range(a, b):
                automaton.add(words[i], leads[i])
            for i in range(a, b):
                known = np.array(automaton.owners(words[i], length), np.int64)
                starts = np.flatnonzero(np.diff(known, prepend=known[0] - 1))
                for start, n in zip(starts.tolist(), np.diff(np.append(starts, len(known))).tolist(), strict=True):
                    if shared[i] or known[start] < leads[i]:
                        out.append((anchors[i], marks[i], start, n, int(known[start])))
        kinds = {"anchor": "int64", "digest": "int64", "start": "int32", "n": "int32", "owner": "int64"}
        return pd.DataFrame(out, columns=[*kinds]).astype(kinds)

    return run


def _contents(rows: DataFrame) -> DataFrame:
    """Distinct contents with the first place of their smallest id (``lead``) and their greatest id (``most``)."""
    return rows.groupBy("anchor", "digest").agg(F.min(F.struct(*_ROW, "first", "count")).alias("lead"), F.max("doc_id").alias("most"))


def _through_shards(docs: DataFrame, contents: DataFrame, length: int) -> DataFrame:
    """What the automata of shards of ``contents`` know: ``anchor, digest, start, n, owner``."""
    shards = max(64, -(-contents.count() // SHARD_CONTENTS))
    words = _fetch(docs, contents, length).withColumn("shard", F.pmod(F.xxhash64("anchor"), F.lit(shards)))
    known = words.groupBy("shard").applyInPandas(_in_shard(length), "anchor long, digest long, start int, n int, owner long")
    return materialise(known, "known")


def _windows(docs: DataFrame, contents: DataFrame, length: int) -> DataFrame:
    """Each window of ``contents`` where their lead has it: ``start`` in the content, and 128 bits of its words."""
    kept = ("anchor", "digest", "most")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for doc, row, text, spans in zip(*(c.to_pylist() for c in b.columns), strict=True):
                data, begins = spaced(text)
                count = np.array([s["count"] for s in spans])
                start = np.concatenate([np.arange(n) for n in count])
                first = np.repeat([s["first"] for s in spans], count) + start
                both = np.frombuffer(digests(data, begins, first, length, 16), "<i8").reshape(-1, 2)
                columns = [np.repeat(np.array([s[c] for s in spans], np.int64), count) for c in kept]
                columns += [start.astype(np.int32), np.full(len(first), doc, np.int64), np.full(len(first), row, np.int32), first.astype(np.int32), both[:, 0].copy(), both[:, 1].copy()]
                yield pa.RecordBatch.from_arrays([pa.array(c) for c in columns], [*kept, "start", "doc_id", "row", "first", "one", "two"])

    spans = _spans(contents.select("lead.*", *kept), "first", "count", *kept)
    joined = _with_text(docs, spans, "inner").select(*_ROW, "text", "spans")
    return joined.mapInArrow(run, "anchor long, digest long, most long, start int, doc_id long, row int, first int, one long, two long")


def known_windows(docs: DataFrame, length: int = 50) -> DataFrame:
    """Runs of windows (``doc_id``, ``row``, ``first``, ``count``) that start in a document with a smaller id, too.

    ``docs``: ``doc_id``, ``row`` (tells rows of one id apart), ``text``.  Rows of
    null id or text have none and make none known.
    """
    found = materialise(_scan(docs, length), "contexts")
    shared = found.groupBy("anchor").agg(F.min("doc_id").alias("a"), F.max("doc_id").alias("b")).where("a < b").select("anchor")
    there = materialise(found.join(broadcast_if(materialise(shared, "anchors")), "anchor"), "shared-contexts")
    contents = materialise(_contents(there), "contents")
    hot = contents.groupBy("anchor").agg(F.count(F.lit(1)).alias("n")).where(F.col("n") > HOT_CONTENTS)
    hot = materialise(hot.select("anchor", F.lit(True).alias("hot")), "hot-anchors")
    marked = contents.join(broadcast_if(hot), "anchor", "left")
    known = _through_shards(docs, marked.where("hot IS NULL").drop("hot"), length)
    if hot.limit(1).count():
        # The windows of a hot anchor's contents are contents of their own, with an anchor each.
        windows = materialise(_windows(docs, marked.where("hot").drop("hot"), length), "hot-windows")
        place = F.struct(*_ROW, "first", F.lit(1).alias("count"))
        single = windows.groupBy(F.col("one").alias("anchor"), F.col("two").alias("digest")).agg(F.min(place).alias("lead"), F.max("most").alias("most"))
        single = materialise(single.where("lead.doc_id < most"), "hot-contents")
        owned = _through_shards(docs, single, length).select(F.col("anchor").alias("one"), F.col("digest").alias("two"), "owner")
        back = windows.join(broadcast_if(owned), ["one", "two"]).where("owner < most")
        known = known.unionByName(back.select("anchor", "digest", "start", F.lit(1).alias("n"), "owner"))
        known = materialise(known, "known")
    met = there.join(broadcast_if(known), ["anchor", "digest"]).where("owner < doc_id")
    return met.select(*_ROW, (F.col("first") + F.col("start")).alias("first"), F.col("n").alias("count"))


def merged(runs: Column, length: int) -> Column:
    """Runs of windows as disjoint ranges of words ``a`` to ``b`` (exclusive), in order."""
    ranges = F.array_sort(F.transform(runs, lambda r: F.struct(r["first"].alias("a"), (r["first"] + r["count"] - 1 + length).alias("b"))))
    empty = F.array().cast("array<struct<a: int, b: int>>")

    def step(done: Column, r: Column) -> Column:
        last = F.element_at(done, -1)
        wider = F.concat(F.slice(done, F.lit(1), F.size(done) - 1), F.array(F.struct(last["a"].alias("a"), F.greatest(last["b"], r["b"]).alias("b"))))
        return F.when((F.size(done) > 0) & (F.try_element_at(done, F.lit(-1))["b"] >= r["a"]), wider).otherwise(F.concat(done, F.array(r)))

    return F.aggregate(ranges, empty, step)


def cut(text: str | None, ranges: list[dict] | None) -> tuple[int, int, bytes]:
    """Number of words, number removed, and the words left, joined by one space."""
    words = (text or "").encode("utf-8", "surrogatepass").split()
    kept, at = [], 0
    for r in ranges or []:
        kept += words[at : r["a"]]
        at = r["b"]
    kept += words[at:]
    return len(words), len(words) - len(kept), b" ".join(kept)


def _told_apart(docs: DataFrame) -> DataFrame:
    """``docs`` with ``row``: a hash of the text for ids that are there with several texts, else 0."""
    mark = F.hash("text")
    several = docs.groupBy("doc_id").agg(F.min(mark).alias("a"), F.max(mark).alias("b")).where("a < b AND doc_id IS NOT NULL")
    several = materialise(several.select("doc_id", F.lit(True).alias("_several")), "repeated-ids")
    if not several.limit(1).count():
        return docs.withColumn("row", F.lit(0))
    return docs.join(broadcast_if(several), "doc_id", "left").withColumn("row", F.when(F.col("_several"), mark).otherwise(0)).drop("_several")


def remove_runs(docs: DataFrame, runs: DataFrame, length: int) -> DataFrame:
    """``doc_id, n_words, n_removed, text`` of every document, text being the words left."""

    def apply(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            found = [cut(t, r) for t, r in zip(b.column(1).to_pylist(), b.column(2).to_pylist(), strict=True)]
            yield pa.RecordBatch.from_arrays(
                [b.column(0), pa.array([x[0] for x in found], pa.int64()), pa.array([x[1] for x in found], pa.int64()), pa.array([x[2].decode("utf-8", "surrogatepass") for x in found], pa.string())],
                ["doc_id", "n_words", "n_removed", "text"],
            )

    per_row = runs.groupBy(*_ROW).agg(F.collect_list(F.struct("first", "count")).alias("runs"))
    per_row = materialise(per_row.select(*_ROW, merged(F.col("runs"), length).alias("ranges")), "ranges")
    rows = _with_text(docs, per_row, "left").select("doc_id", "text", "ranges")
    return rows.mapInArrow(apply, "doc_id long, n_words long, n_removed long, text string")


def substring_dedup(docs: DataFrame, length: int = 50) -> DataFrame:
    """``doc_id, n_words, n_removed, text``: each document without passages that a smaller id has.

    Words are parted by ASCII white space and otherwise compared as they are.  A
    word goes if one of the ``length``-word windows over it starts in a document
    with a smaller id, judged on the input.  A null text has no words; a null id
    loses none and hides none; rows of one id don't remove each other's words, and
    each is judged by its own text.  Texts under ``length`` words stay whole.  An
    empty table gives no rows; other columns aren't read.

    Scale: contexts, not windows, are shuffled: 40 bytes for some dozen words.
    Copies of a content count as one before they reach a shard.  Windows of an
    anchor with very many contents are dealt to shards one by one, so a shard
    holds a bounded number of words.  Texts are shuffled only to fetch contents
    and to cut, and only those with spans, if these are too many bytes to broadcast.
    """
    ship(docs.sparkSession)
    slim = _told_apart(docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text")))
    return remove_runs(slim, known_windows(slim, length), length)


def reference_spans(docs: DataFrame, reference: list[str], length: int = 50, shard_words: int = 200_000) -> DataFrame:
    """Runs of windows (``doc_id, first, count``) that a small reference holds, by broadcast automata of its shards."""
    ship(docs.sparkSession)
    shards: list[list[list[bytes]]] = [[]]
    for text in reference:
        if sum(map(len, shards[-1])) > shard_words:
            shards.append([])
        shards[-1].append(text.encode().split())

    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        automata = []
        for shard in shards:
            automata.append(SuffixAutomaton())
            for words in shard:
                automata[-1].add(words)
        for b in batches:
            rows = []
            for doc, text in zip(b.column(0).to_pylist(), b.column(1).to_pylist(), strict=True):
                words = (text or "").encode("utf-8", "surrogatepass").split()
                for a in automata:
                    rows += [(doc, i - length + 1, 1) for i, n in enumerate(a.matching(words)) if n >= length]
            yield pa.RecordBatch.from_arrays(
                [pa.array([r[i] for r in rows], k) for i, k in enumerate([pa.int64(), pa.int32(), pa.int32()])], ["doc_id", "first", "count"]
            )

    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text").mapInArrow(scan, "doc_id long, first int, count int")


def op4_substring_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All documents without the 50-word passages that an earlier one has."""
    rows = substring_dedup(table(spark, sf_dir, "documents"))
    return rows.select("doc_id", "n_words", "n_removed", F.sha2(F.col("text"), 256).alias("kept_sha256"))


OP4_SQL = r"""
WITH words AS (
  SELECT doc_id, list_filter(regexp_split_to_array(coalesce(text, ''), '[\x20\x09-\x0D]+'), lambda x: x <> '') AS w
  FROM documents
),
starts AS (
  SELECT doc_id, w, unnest(range(1, len(w) - 48)) AS i FROM words WHERE len(w) >= 50
),
windows AS (SELECT doc_id, i, md5(array_to_string(w[i:i + 49], ' ')) AS h FROM starts),
known AS (
  SELECT doc_id, i FROM (SELECT doc_id, i, min(doc_id) OVER (PARTITION BY h) AS first_doc FROM windows) WHERE first_doc < doc_id
),
gone AS (SELECT DISTINCT doc_id, unnest(range(i, i + 50)) AS j FROM known),
lost AS (SELECT doc_id, list(j) AS js FROM gone GROUP BY doc_id),
kept AS (
  SELECT words.doc_id, w, CASE WHEN js IS NULL THEN w
         ELSE list_transform(list_filter(range(1, len(w) + 1), lambda j: NOT list_contains(js, j)), lambda j: w[j]) END AS k
  FROM words LEFT JOIN lost USING (doc_id)
)
SELECT doc_id, len(w) AS n_words, len(w) - len(k) AS n_removed, sha256(array_to_string(k, ' ')) AS kept_sha256 FROM kept
"""
