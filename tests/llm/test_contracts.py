"""Each query and each pipeline stage over small tables with odd rows, against plain versions of what it has to return."""

import collections
import hashlib
import random
import re
import zlib

import duckdb
import numpy as np
import pandas as pd
import pytest

import corpus_pipeline as pipeline
from graphloom.llm import common, mixing, packing, quality, toxicity
from graphloom.llm import registry as corpus

RNG = random.Random(11)
SPACE = r"[\x20\x09-\x0D]+"
DOCUMENTS = "doc_id long, text string, lang string, source string, n_chars long, shard int, slot int, block string, row int, kept int, digest string, `Position` long"
VOCABULARY = {
    "aa": ["morning", "garden", "window", "letter", "river", "summer", "paper", "listen", "every", "walking", "nothing"],
    "bb": ["zeitung", "schule", "ordnung", "wichtig", "freude", "zwischen", "kirche", "schnell", "werkzeug", "gestern"],
}


def prose(lang, n):
    return " ".join(RNG.choice(VOCABULARY[lang]) + RNG.choice(["", "s", "en", "er"]) for _ in range(n))


def documents():
    rows = [(i, prose("aa" if i % 3 else "bb", RNG.randrange(40, 120)), "aa" if i % 3 else "bb") for i in range(150)]
    toxic = {i for i in range(0, 150, 4)}
    rows = [(i, t + (" you grobnik" if i in toxic else ""), lang) for i, t, lang in rows]
    passage = prose("aa", 70)
    rows += [(200 + i, f"{prose('aa', 5)} {passage}\n{prose('bb', 9 + i)}", "aa") for i in range(6)]
    rows += [(300 + i, rows[i][1].replace(" ", "\t ", 1), None) for i in range(5)]  # copies but for white space
    for i in range(5):  # near copies
        words = rows[10 + i][1].split()
        words[len(words) // 2] = "changed"
        rows.append((320 + i, " ".join(words).upper() if i % 2 else " ".join(words), rows[10 + i][2]))
    rows += [(400, None, "aa"), (401, "", None), (402, " \n", "bb"), (403, "x", None), (404, "12 !!", None), (405, prose("aa", 9000), "aa"), (406, "y Y", "aa")]
    made = [(i, t, lang, ["a", "a", "a", "b", None][i % 5], None, 1, 2, "b", 3, 4, "d", 5) for i, t, lang in rows]
    return made, {i: int(i in toxic) for i in range(150)}


@pytest.fixture(scope="module")
def tables(spark, tmp_path_factory):
    path = tmp_path_factory.mktemp("tables")
    rows, toxic = documents()
    spark.createDataFrame(rows, DOCUMENTS).repartition(3).write.parquet(f"{path}/documents.parquet")
    labels = [(i, 1 - y, y) for i, y in toxic.items() if i < 140] + [(None, 1, 0), (9999, 1, 1), (3, None, None)]
    spark.createDataFrame(labels, "doc_id long, quality int, toxic int").write.parquet(f"{path}/labels.parquet")
    vectors = [(i, [float(x) for x in np.random.default_rng(i % 260).normal(size=8)]) for i in range(300)]
    vectors += [(300, [0.0] * 8), (400, None), (500, [1.0, None] * 4), (600, [float("nan")] * 8), (601, [float("inf")] * 8), (None, [1.0] * 8)]
    spark.createDataFrame(vectors, "vec_id long, embedding array<float>").write.parquet(f"{path}/embeddings.parquet")
    return str(path), [(r[0], r[1]) for r in rows], toxic, vectors


def run(spark, tables, name):
    got = corpus.QUERIES[name](spark, tables[0]).toPandas()
    return got.set_index("doc_id", drop=False).sort_index() if "doc_id" in got.columns else got


def words_of(text):
    return [w for w in re.split(SPACE, text or "") if w]


def crc(i):
    return zlib.crc32(str(i).encode())


def test_op1(spark, tables):
    got, docs = run(spark, tables, "op1_sharding"), dict(tables[1])
    assert sorted(got.doc_id) == sorted(docs) and set(got.law) == {"rows"} and got.grown_shard.isna().all()
    for r in got.itertuples():
        raw = (docs[r.doc_id] or "").encode()
        assert (r.size, r.text_crc32) == (len(raw) + 16, zlib.crc32(raw))
    sizes = got.groupby("shard").size().reindex(range(40), fill_value=0)
    assert sizes.max() - sizes.min() <= 1
    assert all(sorted(g.slot) == list(range(len(g))) for _, g in got.groupby("shard"))


def test_op2(spark, tables):
    got = run(spark, tables, "op2_quality_classifier")
    assert sorted(got.doc_id) == sorted(i for i, _ in tables[1])
    assert got.expected_grade.between(0, 1).all() and (got.kept == (got.tail_prob >= quality.KEEP_FROM)).all()
    toxic = tables[2]  # quality is the opposite here
    assert np.mean([got.tail_prob[i] for i in range(140, 150) if not toxic[i]]) > np.mean([got.tail_prob[i] for i in range(140, 150) if toxic[i]])


def test_op3(spark, tables):
    got, toxic = run(spark, tables, "op3_toxicity"), tables[2]
    assert sorted(got.doc_id) == sorted(i for i, _ in tables[1])
    assert all(r.held_out == (crc(r.doc_id) % 4 == 2) and r.predicted == int(r.score >= toxicity.CALL_FROM) and 0 <= r.score <= 1 for r in got.itertuples())
    assert all(got.predicted[i] == toxic[i] for i in range(150)) and got.predicted[[400, 401, 402, 404]].sum() == 0


def test_op4(spark, tables):
    got, docs = run(spark, tables, "op4_substring_dedup"), {i: words_of(t) for i, t in tables[1]}
    first = {}
    for d in sorted(docs):
        for i in range(len(docs[d]) - 49):
            first.setdefault(tuple(docs[d][i : i + 50]), d)
    assert len(got) == len(docs) and got.n_removed.sum() > 0
    for d, w in docs.items():
        gone = {j for i in range(len(w) - 49) if first[tuple(w[i : i + 50])] < d for j in range(i, i + 50)}
        left = " ".join(x for i, x in enumerate(w) if i not in gone)
        assert tuple(got.loc[d, ["n_words", "n_removed", "kept_sha256"]]) == (len(w), len(gone), hashlib.sha256(left.encode()).hexdigest())


def test_op5(spark, tables):
    groups = collections.defaultdict(list)
    for i, t in tables[1]:
        groups[re.sub(SPACE, " ", t or "")].append(i)
    want = {i: (min(g), len(g), i == min(g), hashlib.sha256(t.encode()).hexdigest()) for t, g in groups.items() for i in g}
    got = run(spark, tables, "op5_exact_dedup")
    assert {r.doc_id: (r.keep_id, r.group_size, r.kept, r.text_sha256) for r in got.itertuples()} == want


def check_pieces(got, texts, size=2048):
    from tokenizers import Tokenizer

    model = Tokenizer.from_file(packing.default_tokenizer())
    for d, t in texts.items():
        ids = np.array([*model.encode(t or "", add_special_tokens=False).ids, 1], "<u4")
        pieces = got[got.doc_id == d].sort_values("start")
        assert (pieces.start == pieces.length.cumsum() - pieces.length).all() and pieces.length.sum() == len(ids)
        assert (pieces.doc_tokens == len(ids)).all()
        assert [zlib.crc32(ids[r.start : r.start + r.length].tobytes()) for r in pieces.itertuples()] == list(pieces.ids_crc32)
    assert set(got.doc_id) == set(texts)
    for _, g in got.sort_values("offset").groupby("sequence_id"):
        assert (g.offset == g.length.cumsum() - g.length).all() and g.length.sum() <= size
    assert (got.groupby("sequence_id").length.sum() < size).sum() <= 1


def test_op6(spark, tables):
    check_pieces(corpus.QUERIES["op6_packing"](spark, tables[0]).toPandas(), dict(tables[1]))


def shingles(text, n):
    w = words_of(re.sub("[A-Z]", lambda m: m[0].lower(), text or ""))
    return {tuple(w[i : i + n]) for i in range(max(1, len(w) - n + 1))} if w else set()


def components(sets, percent):
    up = {d: d for d in sets}
    links = [(a, b) for a in sets for b in sets if a < b and (c := len(sets[a] & sets[b])) and 100 * c >= percent * len(sets[a] | sets[b])]
    for _ in links:
        for a, b in links:
            up[a] = up[b] = min(up[a], up[b])
    return up


def test_op7(spark, tables):
    sets = {i: shingles(t, 3) for i, t in tables[1]}
    up = components(sets, 85)
    got = run(spark, tables, "op7_minhash_near_dedup")
    assert {r.doc_id: (r.n_shingles, r.component_id, r.kept) for r in got.itertuples()} == {d: (len(s), up[d], up[d] == d) for d, s in sets.items()}
    con = duckdb.connect()
    con.sql(f"CREATE VIEW documents AS SELECT * FROM '{tables[0]}/documents.parquet/*.parquet'")
    want = con.sql(corpus.SQL["op7_minhash_near_dedup"]).df().sort_values("doc_id")
    assert want[["doc_id", "n_shingles", "component_id", "kept"]].values.tolist() == got[["doc_id", "n_shingles", "component_id", "kept"]].values.tolist()


def test_op8(spark, tables):
    got = run(spark, tables, "op8_language_id")
    assert all(r.held_out == (crc(r.doc_id) % 3 == 1) and 0 <= r.score <= 1 for r in got.itertuples())
    assert all(got.lang_pred[i] == ("aa" if i % 3 else "bb") for i in range(150))
    assert set(got.lang_pred[[400, 401, 402, 404]]) == {"und"} and got.lang_pred[405] == "aa"


def test_op9(spark, tables):
    good = {i: np.floor(1024 * np.array(v, np.float32).astype(float)).astype(int) for i, v in tables[3] if i is not None and v is not None and None not in v and np.isfinite(v).all()}
    got = run(spark, tables, "op9_topk_search").sort_values(["query_id", "rank"])
    want = [(q, k + 1, i, s) for q in good if q % 100 == 0 for k, (i, s) in enumerate(sorted(((i, int(v @ good[q])) for i, v in good.items() if i != q), key=lambda p: (-p[1], p[0]))[:10])]
    assert [tuple(map(int, r)) for r in got[["query_id", "rank", "vec_id", "score"]].itertuples(index=False)] == sorted(want)


def test_op10(spark, tables):
    got = run(spark, tables, "op10_mixing")
    assert sorted(got.doc_id) == sorted(i for i, _ in tables[1]) and got.position.is_unique
    assert (got.slot == got.position // 16).all()
    sizes = got.source.fillna("?").value_counts()
    weight = sizes**0.7
    blocks = -(-sizes // 16)
    until = int(min(blocks[s] * weight.sum() / weight[s] for s in sizes.index))  # all sources last so long
    for t in range(1, until):
        ran = got[got.slot < t].drop_duplicates("slot").source.fillna("?").value_counts()
        assert all(abs(ran.get(s, 0) - t * weight[s] / weight.sum()) < 1 for s in sizes.index)


def test_pipeline(spark, tables):
    path, rows = tables[0], dict(tables[1])
    docs = common.table(spark, path, "documents")
    columns, seen = docs.columns, {}
    for name, stage in pipeline.STAGES:
        before, docs = docs, common.materialise(stage(spark, docs, path), name)
        seen[name] = docs.toPandas()
        if name != "packing":
            assert docs.columns == columns
            assert {(r.doc_id, r.text) for r in docs.select("doc_id", "text").collect()} <= {(r.doc_id, r.text) for r in before.select("doc_id", "text").collect()}
    assert [n for n, _ in pipeline.STAGES] == ["quality", "exact_dedup", "near_dedup", "mixing", "packing"]
    verdicts = corpus.QUERIES["op2_quality_classifier"](spark, path).toPandas()
    kept = sorted(verdicts.doc_id[verdicts.kept])
    assert sorted(seen["quality"].doc_id) == kept and len(kept) < len(rows)
    texts = {}
    for i in kept:
        texts.setdefault(re.sub(SPACE, " ", rows[i] or ""), i)
    assert sorted(seen["exact_dedup"].doc_id) == sorted(texts.values())
    sets = {i: shingles(rows[i], 5) for i in texts.values()}
    up = components(sets, 80)
    left = sorted(i for i in sets if up[i] == i)
    assert sorted(seen["near_dedup"].doc_id) == left == sorted(seen["mixing"].doc_id)
    check_pieces(seen["packing"], {i: rows[i] for i in left})
    at = dict(before.select("doc_id", mixing.written_order(before)).collect())
    for _, g in seen["packing"].groupby("sequence_id"):
        assert set(g.sequence_order) == {max(at[d] for d in g.doc_id)}
    last = pipeline.run(spark, path).toPandas()
    assert sorted(last.doc_id) == sorted(seen["packing"].doc_id)


def test_empty_tables(spark, tables, tmp_path):
    for name in ("documents", "labels", "embeddings"):
        spark.read.parquet(f"{tables[0]}/{name}.parquet").limit(0).write.parquet(f"{tmp_path}/{name}.parquet")
    for name, query in corpus.QUERIES.items():
        assert query(spark, str(tmp_path)).count() == 0, name
    assert pipeline.run(spark, str(tmp_path)).count() == 0


def test_order_as_written(spark, tmp_path):
    spark.range(5000).repartition(7, "id").selectExpr("id AS position").write.parquet(f"{tmp_path}/a")
    mixing.in_order(spark.read.parquet(f"{tmp_path}/a"), ["position"]).write.parquet(f"{tmp_path}/b")
    docs = spark.read.parquet(f"{tmp_path}/b")
    got = docs.select("position", mixing.written_order(docs).alias("at")).toPandas().sort_values("at")
    assert got.position.tolist() == list(range(5000)) and got["at"].is_unique
    assert spark.range(3).select(mixing.written_order(spark.range(3))).count() == 3


def test_other_vocabularies():
    from tokenizers import Tokenizer

    path = packing.default_tokenizer().replace("word_bpe_49k", "byte_bpe_50k")
    text = "One  two\n three, 12,5 four's  "
    assert np.frombuffer(packing.tokenizer(path).ids(text), "<u4").tolist() == Tokenizer.from_file(path).encode(text, add_special_tokens=False).ids


def test_shared_folder(spark):
    assert common.unused(["a", "_Place"], "_place", "_place_", "b") == ["_place_", "_place__", "b"]
    common.materialise(spark.range(3), "probe")
    path = spark._jvm.org.apache.hadoop.fs.Path(common._tables(spark))
    files = path.getFileSystem(spark._jsc.hadoopConfiguration())
    assert files.exists(path)
    common.drop_tables(spark)
    assert not files.exists(path)


def test_sample_is_bounded(spark):
    from graphloom.llm.sparse_text import bounded_sample

    rows = spark.range(60_000).selectExpr("id AS doc_id", "CASE WHEN id % 100 = 0 THEN 'rare' WHEN id = 1 THEN NULL ELSE 'hot' END AS lang")
    got = bounded_sample(rows.where("lang IS NOT NULL"), "lang", 500).toPandas()
    assert got.lang.value_counts().to_dict() == {"hot": 500, "rare": 500} and got.doc_id.is_unique
    assert isinstance(got, pd.DataFrame)
