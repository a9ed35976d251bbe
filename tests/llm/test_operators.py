"""The corpus operators against plain versions, on small tables with odd rows."""

import collections
import math
import random
import re
import zlib

import numpy as np
import pytest
from pyspark.sql import functions as F

from graphloom.llm import exact_dedup as x5
from graphloom.llm import language_id as x8
from graphloom.llm import minhash_dedup as x7
from graphloom.llm import mixing as x10
from graphloom.llm import packing as x6
from graphloom.llm import quality as x2
from graphloom.llm import sharding as x1
from graphloom.llm import substring_dedup as x4
from graphloom.llm import topk_search as x9
from graphloom.llm import toxicity as x3
from graphloom.llm.common import window_hashes, word_hashes

SCHEMA = "doc_id long, text string, lang string, source string, n_chars long, bucket int, digest string"
RNG = random.Random(4)
VOCABULARY = ["".join(RNG.choice("abcdefgh") for _ in range(RNG.randrange(2, 7))) for _ in range(300)]


def prose(n):
    return " ".join(RNG.choice(VOCABULARY) for _ in range(n))


def corpus():
    base = [prose(RNG.randrange(60, 140)) for _ in range(12)]
    passage = prose(70)
    texts = [*base, *base[:4], None, None, "", " ", "x", "x y", passage, f"{prose(30)} {passage}\n{prose(30)}", f"{passage} {passage}", prose(6000)]
    for t in base[:6]:  # near copies
        words = t.split()
        for _ in range(3):
            w = list(words)
            w[RNG.randrange(len(w))] = "changed"
            texts.append(" ".join(w))
    rows = [(i, t, RNG.choice(["en", None]), RNG.choice(["a", "a", "a", "b", None]), 1, 5, "z") for i, t in enumerate(texts)]
    return [*rows, (None, "no id", "en", "a", 1, 5, "z"), (None, base[0], "en", "b", 1, 5, "z")]


@pytest.fixture(scope="module")
def rows():
    return corpus()


@pytest.fixture(scope="module")
def docs(spark, rows):
    return spark.createDataFrame(rows, SCHEMA).repartition(3)


@pytest.fixture(scope="module")
def none(spark):
    return spark.createDataFrame([], SCHEMA)


def test_hashes_tell_words_apart():
    words = [f"w{i}" for i in range(2000)]
    h = word_hashes(" ".join(words).encode())
    assert len(set(h.tolist())) == 2000 and (word_hashes(b"A\tb", lower=True) == word_hashes(b"\ra  B\n", lower=True)).all()
    assert (window_hashes(h[:9], 3)[4:] == window_hashes(h[4:9], 3)).all() and not len(window_hashes(h[:2], 3))


def test_sharding(docs, rows, none):
    got = x1.shard(docs, n_shards=7, min_buckets=5).toPandas()
    assert len(got) == len(rows) and set(map(str, got.text)) == {str(r[1]) for r in rows}
    sizes = got.groupby("shard").size()
    assert sizes.max() - sizes.min() <= 1 and set(sizes.index) == set(range(7))
    assert all(sorted(g.slot) == list(range(len(g))) for _, g in got.groupby("shard"))
    again = x1.shard(docs.repartition(5), n_shards=7, min_buckets=5).toPandas()
    key = lambda d: sorted(zip(map(str, d.doc_id), map(str, d.text), d.shard, d.slot))
    assert key(got) == key(again)
    assert x1.shard(none, 3).count() == 0
    assert sorted(x1.fisher_yates(50, 3)) == list(range(50))


def test_perfect_hash():
    keys = np.random.default_rng(1).integers(0, 2**63, (5000, 4)).astype(np.uint64)
    h = x5.PerfectHash(keys)
    assert sorted(h.slots(keys)) == list(range(5000)) == list(range(h.size))


@pytest.mark.parametrize("cut", [0, 10, 1000])
def test_exact_dedup(docs, rows, none, cut):
    want = collections.defaultdict(list)
    norm = lambda t: re.sub(r"[\x20\x09-\x0D]+", " ", t or "")
    for r in rows:
        want[norm(r[1])].append(r[0])
    got = x5.exact_dedup(docs, F.col("doc_id") < cut).join(docs.select("doc_id", "text"), "doc_id").toPandas()
    for r in got.itertuples():
        group = want[norm(None if r.text is None else str(r.text))]
        assert r.keep_id == min(i for i in group if i is not None) and r.group_size == len(group) and r.kept == (r.doc_id == r.keep_id)
    assert x5.exact_dedup(none, x5.history_half(none)).count() == 0
    assert x5.exact_dedup(docs, F.lit(False)).count() == len(rows)


def plain_removal(rows, n):
    words = {r[0]: [w for w in re.split(r"[\x20\x09-\x0D]+", r[1] or "") if w] for r in rows if r[0] is not None}
    first = {}
    for d in sorted(words):
        for i in range(len(words[d]) - n + 1):
            first.setdefault(tuple(words[d][i : i + n]), d)
    out = {}
    for d, w in words.items():
        gone = set()
        for i in range(len(w) - n + 1):
            if first[tuple(w[i : i + n])] < d:
                gone.update(range(i, i + n))
        out[d] = (len(w), len(gone), " ".join(x for i, x in enumerate(w) if i not in gone))
    return out


@pytest.mark.parametrize(("hot", "limit"), [(200, 8 << 20), (1, 0)])
def test_substring_dedup(docs, rows, none, monkeypatch, hot, limit):
    monkeypatch.setattr(x4, "HOT_CONTENTS", hot)
    monkeypatch.setattr(x4, "TO_TEXTS_BYTES", limit)
    got = {r.doc_id: (r.n_words, r.n_removed, r.text) for r in x4.substring_dedup(docs, 20).where("doc_id IS NOT NULL").collect()}
    assert got == plain_removal(rows, 20)
    assert x4.substring_dedup(none).count() == 0


def test_substring_words_of_like_hashes(spark):
    base = [f"w{i}" for i in range(61)]
    texts = [" ".join([*base[:30], x, *base[31:]]) for x in ("w48449x", "w99124x")]  # hashes alike in 32 bits
    df = spark.createDataFrame([*enumerate(texts), (7, texts[0]), (7, prose(60)), (7, texts[0])], "doc_id long, text string")
    got = sorted((r.doc_id, r.n_words, r.n_removed) for r in x4.substring_dedup(df).collect())
    assert got == [(0, 61, 0), (1, 61, 0), (7, 60, 0), (7, 61, 61), (7, 61, 61)]


def test_suffix_automaton(spark):
    owned = x4.SuffixAutomaton()
    words = [[RNG.choice("ab") for _ in range(40)] for _ in range(6)]
    for i, s in enumerate(words):
        owned.add(s, i)
    for s in [*words, [RNG.choice("abc") for _ in range(40)]]:
        first = [next((o for o, w in enumerate(words) if "".join(s[i : i + 4]) in "".join(w)), None) for i in range(37)]
        assert owned.owners(s, 4) == first
    a = x4.SuffixAutomaton()
    sequences = [[RNG.choice("ab") for _ in range(30)] for _ in range(4)]
    for s in sequences:
        a.add(s)
    text = [RNG.choice("abc") for _ in range(60)]
    held = {"".join(s[i:j]) for s in sequences for i in range(30) for j in range(i, 31)}
    want = [max(n for n in range(i + 2) if "".join(text[i + 1 - n : i + 1]) in held) for i in range(60)]
    assert a.matching(text) == want
    docs = spark.createDataFrame([(1, "q a b c d z")], "doc_id long, text string")
    assert [tuple(r) for r in x4.reference_spans(docs, ["a b c d"], 3).collect()] == [(1, 1, 1), (1, 2, 1)]


@pytest.mark.parametrize(("size", "percent", "limit"), [(3, 85, 4096), (5, 80, 2)])
def test_near_duplicates(docs, rows, none, monkeypatch, size, percent, limit):
    monkeypatch.setattr(x7, "CLASS_ROWS", limit)
    sets = {}
    for r in rows:
        if r[0] is not None:
            w = [x for x in re.split(r"[\x20\x09-\x0D]+", (r[1] or "").lower()) if x]
            k = min(size, len(w))
            sets[r[0]] = {tuple(w[i : i + k]) for i in range(len(w) - k + 1)} if w else set()
    up = {d: d for d in sets}
    for _ in sets:
        for a in sets:
            for b in sets:
                both = len(sets[a] & sets[b])
                if both and 100 * both >= percent * len(sets[a] | sets[b]):
                    up[a] = up[b] = min(up[a], up[b])
    got = x7.near_duplicates(docs, size, percent).collect()
    assert len(got) == len(rows)
    assert {r.doc_id: (r.n_shingles, r.component_id, r.kept) for r in got if r.doc_id is not None} == {d: (len(s), up[d], up[d] == d) for d, s in sets.items()}
    assert all(r.kept and r.component_id is None for r in got if r.doc_id is None)
    assert x7.near_duplicates(none).count() == 0


def test_pigeonhole():
    a = np.arange(x7.COMPONENTS, dtype=np.uint32)[None]
    for _ in range(200):
        b = a.copy()
        b[0, RNG.sample(range(x7.COMPONENTS), 2 * x7.CHUNKS - 1)] += 1000
        assert (x7.keys(a) == x7.keys(b)).any()
    assert all(x7.farthest(p) < 2 * x7.CHUNKS and x7.miss(p) < 1e-6 for p in (80, 85))


def test_packing(docs, rows, none):
    got = x6.pack(docs, x6.default_tokenizer(), size=256, open_windows=3).toPandas()
    from tokenizers import Tokenizer

    model = Tokenizer.from_file(x6.default_tokenizer())
    want = collections.Counter(np.array([*model.encode(r[1] or "", add_special_tokens=False).ids, 1], "<u4").tobytes() for r in rows)
    whole = collections.Counter()
    for _, g in got[got.doc_id.notna()].sort_values("start").groupby("doc_id"):
        whole[b"".join(g.ids)] += 1
        assert (g.length.cumsum() - g.length == g.start).all() and g.length.sum() == g.doc_tokens.iloc[0]
    assert not whole - want
    assert all(zlib.crc32(i) == c for i, c in zip(got.ids, got.ids_crc32, strict=True))
    fill = got.groupby("sequence_id").length.sum()
    assert (fill != 256).sum() <= 1 and fill.max() <= 256
    for _, g in got.sort_values("offset").groupby("sequence_id"):
        assert (g.length.cumsum() - g.length == g.offset).all()
    assert x6.pack(none, x6.default_tokenizer()).count() == 0


@pytest.mark.parametrize("text", ["Ünïcödé Don't it's 12,5 a<|endoftext|>b <|startoftext|> éx ªº ſ İI ΑΣ 中文 x y", "", " \t", "a" * 3000])
def test_word_memory(text):
    from tokenizers import Tokenizer

    direct = Tokenizer.from_file(x6.default_tokenizer()).encode(text, add_special_tokens=False).ids
    assert np.frombuffer(x6.tokenizer(x6.default_tokenizer()).ids(text), "<u4").tolist() == direct


def test_pfair():
    weights = [5, 3, 1, 1]
    order = x10.pfair_period(weights)
    ran = [0] * 4
    for t, i in enumerate(order, 1):
        ran[i] += 1
        assert all(abs(r - t * w / 10) < 1 for r, w in zip(ran, weights, strict=True))
    plan = x10.schedule([7, 30, 2, 0], [5, 3, 1, 1])
    slots = sorted(p + j // len(s) * q + s[j % len(s)] for _, a, b, p, q, s in plan for j in range(b - a))
    assert slots == list(range(39))


def test_mixing(docs, rows, none):
    got = x10.mix(docs, {"a": 2.0, "b": 1.0}, block_rows=2, piece_rows=3).toPandas()
    assert len(got) == len(rows) and got.position.is_unique
    for _, g in got.assign(source=got.source.fillna("?")).groupby("source"):
        assert sorted(g.block) == sorted(i // 2 for i in range(len(g)))
    assert x10.mix(none, x10.tempered()).count() == 0


def test_mixing_deviation():
    assert [i for i, _ in x10.slots_of([5, 3, 1, 1], [5, 3, 1, 1])] == x10.pfair_period([5, 3, 1, 1])
    for wanted, blocks in (([0.9, 0.0999, 0.0001], [9000, 999, 1]), ([900.0, 7.3, 1.1, 0.31], [20000, 50, 40, 7]), ([1.0] * 300, [*range(1, 301)])):
        weights, ran, ideal = x10.exact(wanted), [0] * len(blocks), [0.0] * len(blocks)
        for i, k in x10.slots_of(blocks, weights):
            assert k == ran[i]
            ran[i] += 1
            room = 1.0
            while room > 1e-9 and (on := [j for j, n in enumerate(blocks) if n - ideal[j] > 1e-7]):
                total = sum(wanted[j] for j in on)
                part = min(room, *((blocks[j] - ideal[j]) * total / wanted[j] for j in on))
                for j in on:
                    ideal[j] += part * wanted[j] / total
                room -= part
            assert all(abs(r - x) < 1 + 1e-4 for r, x in zip(ran, ideal, strict=True))
        assert ran == blocks


def test_mixing_many_sources(spark):
    df = spark.range(1200).selectExpr("id AS doc_id", "'t' AS text", "CASE WHEN id < 600 THEN 'big' ELSE concat('s', id % 300) END AS source")
    got = x10.mix(df, {"big": 300.0, "s7": 3.0, "s8": 1.0}, block_rows=1).toPandas()
    assert len(got) == 1200 and sorted(got.slot) == list(range(1200))
    # Weights: 300 of 602 for big, 3 for s7, 1 for each of 299 others.
    for t in range(1, 400):
        early = got[got.slot < t].source.value_counts()
        assert abs(early.get("big", 0) - t * 300 / 602) < 1 and abs(early.get("s7", 0) - t * 3 / 602) < 1


def test_top_k(spark):
    rng = np.random.default_rng(3)
    rows = [(i, [float(v) for v in rng.normal(size=6)]) for i in range(300)] + [(300, None), (301, [math.nan] * 6), (None, [1.0] * 6), (302, [0.0] * 6), (303, [1.0, 2.0])]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<float>")
    df = df.select("vec_id", x9.quantise(F.col("embedding")).alias("embedding"))
    got = collections.defaultdict(list)
    for r in x9.top_k(df, F.col("vec_id") % 50 == 0, k=7, block_rows=64, query_rows=3).orderBy("rank").collect():
        got[r.query_id].append((r.vec_id, r.score))
    v = {i: np.floor(1024 * np.array(e, np.float32).astype(float)).astype(int) for i, e in rows if i is not None and i not in (300, 301, 303)}
    assert set(got) == {i for i in v if i % 50 == 0}
    for q, found in got.items():
        assert found == sorted(((i, int(v[i] @ v[q])) for i in v if i != q), key=lambda p: (-p[1], p[0]))[:7]
    assert x9.top_k(df.limit(0), F.lit(True)).count() == 0


def test_quality(spark, none):
    kinds = [lambda: prose(40), lambda: " ".join(w + "%%%" for w in prose(40).split()), lambda: prose(40).upper()]
    rows = [(i, kinds[i % 3](), 2 - i % 3) for i in range(240)]
    labels = spark.createDataFrame([(i, g) for i, _, g in rows if i < 150], "doc_id long, quality int")
    table = spark.createDataFrame([(i, t) for i, t, _ in rows] + [(None, None), (999, "")], "doc_id long, text string")
    model = x2.train(table, labels)
    assert len(model.thresholds) == 2 and model.thresholds[0] < model.thresholds[1]
    got = {r.doc_id: r for r in x2.assess(table, model).collect()}
    assert len(got) == 242 and sum(round(got[i].expected_grade) == g for i, _, g in rows if i >= 150) >= 85
    assert x2.assess(none, model).count() == 0 and x2.keep_good(table, model, 0.0).count() == 242
    assert x2.fit([]).assess((np.zeros(0, int), np.zeros(0)), 0)[1] == 1.0


def test_language(spark, none):
    words = {"aa": ["tion", "ever", "ness", "able"], "bb": ["sch", "ung", "keit", "ver"], "cc": ["ción", "que", "ado", "ñar"]}
    rows = [(i, " ".join(RNG.choice(words[k]) + RNG.choice(words[k]) for _ in range(30)), k) for i, k in enumerate(list(words) * 40)]
    table = spark.createDataFrame([*rows, (500, None, "aa"), (501, "12 !!", None), (None, "tionever", "aa")], "doc_id long, text string, lang string")
    model = x8.train(table.where("doc_id % 2 = 0"))
    got = {r.doc_id: r for r in x8.identify(table, model).collect()}
    assert all(got[i].lang_pred == k for i, _, k in rows) and got[500].lang_pred == got[501].lang_pred == "und"
    assert all(0 <= r.score <= 1 for r in got.values())
    assert x8.identify(none, model).count() == 0 and x8.fit([]).nearest((np.zeros(0, int), np.zeros(0))) == (None, 0.0)


def toxic_letters():
    text = " ".join(["you are a stupid idiot", "the garden and a river in the morning", "we listen to a letter and you read it", "an ass and a river"] * 200)
    return x3.CharModel.of(np.bincount(x3.trigram_counts(text), minlength=x3.SIZE**3))


def test_toxicity_long_tokens():
    chars = toxic_letters()
    assert "stupid" in x3.readings("s" + "t" * 70 + "upid", chars)
    assert "stupid" in x3.readings("you.are.in.the.garden." * 4 + "stup1d", chars)
    assert "idiot" in x3.readings("the-river-" * 5000 + "id1ot", chars)


def test_toxicity_spacing():
    chars = toxic_letters()
    model = x3.ToxicityModel(chars, {"stupid": 0.9, "idiot": 0.9}, {}, 0.01)
    spaced = [
        "you are a s t u p i d", "y o u i d i o t", "y o u a r e s t u p i d", "s\tt\nu  p i d", "read a letter, stu pid", "s tu p1d river", "listen, id\nio t!",
        "y o u   a r e   a n   i d i o t", "you i d i o t a",
    ]
    assert [t for t in spaced if model.score(t) < 0.9] == []
    assert model.score("you are in a garden and i read a b c d") == 0.01


def test_toxicity_edges():
    chars = toxic_letters()
    model = x3.ToxicityModel(chars, {"stupid": 0.9, "idiot": 0.9, "ass": 0.9}, {}, 0.01)
    hidden = ["you !diot", "an idio+ you", "|diot!", "a$$", "@$$", "455", "($tupid)", "! d i o t", "i d i o +", "!d iot"]
    assert [t for t in hidden if model.score(t) < 0.9] == []
    assert [model.score(t) for t in ("river! (garden) letter$$$", "12:30 +49 2024", "$$$ !!! | + @")] == [0.01] * 3


def test_toxicity(spark, none):
    plain_words = ["morning", "garden", "window", "letter", "river", "summer", "paper", "listen"]
    sentence = lambda bad: " ".join([*RNG.choices(plain_words, k=12), *(["grobnik"] if bad else [])])
    rows = [(i, f"{sentence(i % 4 == 0)} t{i}", int(i % 4 == 0)) for i in range(400)]
    odd = [(1000, "river gr0bn1k"), (1001, "g r o b n i k"), (1002, "g.r.o.b.n.i.k paper"), (1003, "grrrrobnik"), (1004, ""), (1005, None), (1006, "garden 12:30 window")]
    table = spark.createDataFrame([(i, t) for i, t, _ in rows] + odd, "doc_id long, text string")
    labels = spark.createDataFrame([(i, y) for i, _, y in rows if i < 300], "doc_id long, toxic int")
    model = x3.train(table, labels, x3.corpus_characters(table))
    got = {r.doc_id: r.predicted for r in x3.score(table, model).collect()}
    assert all(got[i] == y for i, _, y in rows)
    assert [got[i] for i in range(1000, 1007)] == [1, 1, 1, 1, 0, 0, 0]
    assert x3.score(none, model).count() == 0

