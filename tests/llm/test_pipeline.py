"""The corpus pipeline on small fixtures: its stages against brute force, edge rows, empty tables, clashing columns."""

import itertools
import random
import re
import zlib

import numpy as np
import pytest

import corpus_pipeline
from pelagos.llm import chat, common, exact_dedup, near_dedup, packing, pieces, pii, quality, simhash, toxicity, url_filter
from pelagos.llm import embedding_dedup
from test_llm import EDGE

DOCUMENTS = "doc_id long, text string, lang string, source string, n_chars long"


def write(spark, folder, rows, labels=()):
    spark.createDataFrame(rows, DOCUMENTS).write.parquet(f"{folder}/documents.parquet")
    spark.createDataFrame(list(labels), "doc_id long, quality int, toxic int").write.parquet(f"{folder}/labels.parquet")
    return str(folder)


def test_stages_take_effect(spark, tmp_path):
    prose = "the quiet harbour of the old town lies north of a long row of painted boats and nets drying in the evening sun"
    rows = [(i, f"{prose} number {i * 7919 % 1000} " + " ".join(f"word{(i * k) % 97}x{k}" for k in range(1, 40)), "en", "s", None) for i in range(20)]
    rows += [(50, "Buy!!! $$$ 4u CLICK http://x.y " * 30, "en", "s", None), (51, "Buy!!! $$$ 4u WIN http://x.y " * 30, "en", "s", None)]
    rows += [(60, re.sub(" ", "  ", rows[3][1]), "en", "s", None), (61, rows[4][1], None, None, 7), (70, "mail jo@harbour.example.com about the old boats in the harbour today please", "en", "s", None)]
    labels = [(i, 1, 0) for i in range(10)] + [(50, 0, 0), (51, 0, 0)]
    folder = write(spark, tmp_path / "in", rows, labels)
    docs = spark.read.parquet(f"{folder}/documents.parquet")
    left = {}
    for name, stage in corpus_pipeline.STAGES[:-1]:
        before = {r.doc_id for r in docs.collect()}
        docs = stage(spark, docs, folder)
        assert docs.columns == list(corpus_pipeline.COLUMNS)
        docs.write.parquet(str(tmp_path / name))
        docs = spark.read.parquet(str(tmp_path / name))
        left[name] = {r.doc_id: r.text for r in docs.collect()}
        assert set(left[name]) <= before
    assert set(left["quality"]) == {r[0] for r in rows} - {50, 51}
    assert set(left["exact_dedup"]) == set(left["quality"]) - {60, 61}
    assert set(left["simhash"]) == {r.doc_id for r in simhash.near_groups(spark.read.parquet(str(tmp_path / "exact_dedup"))).where("doc_id = component_id").collect()}
    assert "jo@" not in left["pii"][70] and "@" in left["pii"][70] and left["pii"][0] == left["simhash"][0]
    encoder = packing.encoder()
    packed = corpus_pipeline.STAGES[-1][1](spark, docs, folder).collect()
    want = {i: encoder._raw([t])[0] + (1).to_bytes(4, "little") for i, t in left["pii"].items()}
    assert {(r.doc_id, r.ids_crc32) for r in packed if r.doc_tokens <= 2048} == {(i, zlib.crc32(ids)) for i, ids in want.items() if len(ids) <= 8192}


def test_run_equals_its_stages_on_edges(spark, tmp_path):
    folder = write(spark, tmp_path / "in", [(i, t, None, s, None) for i, t, s in EDGE])
    got = corpus_pipeline.run(spark, folder).collect()
    kept = {r.doc_id for r in simhash.near_groups(exact_dedup.exact_groups(spark.read.parquet(f"{folder}/documents.parquet")).where("kept").select("doc_id").join(spark.read.parquet(f"{folder}/documents.parquet").dropDuplicates(["doc_id"]), "doc_id")).where("doc_id = component_id").collect()}
    assert {r.doc_id for r in got} == kept


def test_run_without_documents(spark, tmp_path):
    assert corpus_pipeline.run(spark, write(spark, tmp_path / "in", [])).count() == 0


CLASHING = "doc_id long, text string, score string, keep_id string, component_id string, fingerprint string, ids string, entities string, start string, path string, h string, block string, held_out string, label string, n string, length string, value string"


@pytest.mark.parametrize("apply", [
    lambda d, l: pii.surrogates(d, b"k"), lambda d, l: toxicity.judged(d, l), lambda d, l: packing.pack(d), lambda d, l: simhash.near_groups(d), lambda d, l: exact_dedup.exact_groups(d), lambda d, l: quality.judged(d, l), lambda d, l: pieces.encode(d),
], ids=["pii", "toxicity", "packing", "simhash", "exact_dedup", "quality", "pieces"])
def test_clashing_columns_and_edge_rows(spark, apply):
    width = len(CLASHING.split(",")) - 2
    rows = [(i, t, *["x"] * width) for i, t, _ in EDGE] + [(9, "long " * 60_000, *[None] * width), (10, "😀\u0000퟿ é İ", *[None] * width)]
    labels = spark.createDataFrame([(4, 1, 0), (6, 0, 1), (None, 1, 1), (7, None, None), (999, 1, 1)], "doc_id long, quality int, toxic int")
    got = apply(spark.createDataFrame(rows, CLASHING), labels).collect()
    assert {r.doc_id for r in got} == {r[0] for r in rows} and len(got) >= len(rows)
    assert apply(spark.createDataFrame([], CLASHING), labels).count() == 0


def test_clashing_columns_of_vectors_and_pages(spark):
    vectors = spark.createDataFrame([(1, [1.0, 0.0], "a", "b", "c"), (2, [1.0, 0.01], None, None, None), (3, [0.0, None], "a", "b", "c"), (4, [float("inf"), 1.0], "a", "b", "c")], "vec_id long, embedding array<float>, component_id string, n_links string, cell string")
    assert {r.vec_id: (r.n_links, r.component_id) for r in embedding_dedup.near_links(vectors).collect()} == {1: (1, 1), 2: (1, 1), 3: (0, 3), 4: (0, 4)}
    assert embedding_dedup.near_links(vectors.limit(0)).count() == 0
    pages = spark.createDataFrame([(1, "http://a.net/", "x", "y", "z"), (1, "http://a.net/", "x", "y", "z"), (None, None, None, None, None)], "page_id long, url string, rule string, verdict string, path string")
    assert sorted((r.page_id is None, r.verdict, r.rule) for r in url_filter.judge(pages, url_filter.rules_table(spark)).collect()) == [(False, "block", "net/"), (False, "block", "net/"), (True, "allow", None)]
    assert url_filter.judge(pages.limit(0), url_filter.rules_table(spark)).count() == 0


def test_near_copies_match_exact_similarity(spark):
    draw = np.random.default_rng(5)
    texts = []
    for _ in range(30):
        words = [f"w{k}" for k in draw.integers(0, 5000, int(draw.integers(30, 400)))]
        texts.append(words)
        for share in (0.002, 0.01, 0.03, 0.08):
            texts.append([f"e{k}" if draw.random() < share else w for k, w in enumerate(words)])
    texts += [[], [" "], ["one", "two"], ["One", "Two"], ["one", "three"]]
    rows = [(i, " ".join(t), None, None, None) for i, t in enumerate(texts)]
    sets = [{tuple(w.lower() for w in t[k : k + 5]) for k in range(max(1, len(t) - 4))} for t in (r[1].split() for r in rows)]
    root = list(range(len(sets)))
    for a, b in itertools.combinations(root[:], 2):
        if len(sets[a] & sets[b]) >= 0.8 * len(sets[a] | sets[b]):
            low, high = sorted((root[a], root[b]))
            root = [low if r == high else r for r in root]
    docs = spark.createDataFrame(rows, DOCUMENTS)
    assert sorted(r.doc_id for r in corpus_pipeline.drop_near_copies(spark, docs, "").collect()) == sorted(set(root))
    assert sorted(r.doc_id for r in near_dedup.first_of_near(docs, tile=2).collect()) == sorted(set(root))


def test_near_copies_keep_rows(spark):
    text = " ".join(f"w{k}" for k in range(100))
    rows = [(3, text), (5, text + " x"), (5, "other"), (5, "other"), (None, "alone"), (None, text), (None, "lone pair a"), (None, "lone  pair A")]
    got = corpus_pipeline.drop_near_copies(spark, spark.createDataFrame([(*r, None, None, None) for r in rows], DOCUMENTS), "").collect()
    assert sorted((r.doc_id or 0, r.text.lower().split()) for r in got) == sorted([(3, text.split()), (5, ["other"]), (0, ["alone"]), (0, ["lone", "pair", "a"])])


def test_copies_keep_rows(spark):
    rows = [(3, "A"), (5, "A"), (5, "B"), (5, "B"), (None, "alone"), (None, "B"), (None, "two"), (None, "two"), (7, None), (7, "")]
    docs = spark.createDataFrame([(*r, None, None, None) for r in rows], DOCUMENTS)
    want = [(0, "alone"), (0, "two"), (3, "A"), (5, "B"), (7, "")]
    got = corpus_pipeline.drop_copies(spark, docs, "")
    assert sorted((r.doc_id or 0, r.text or "") for r in got.collect()) == want
    assert sorted((r.doc_id or 0, r.text or "") for r in corpus_pipeline.drop_near_copies(spark, got, "").collect()) == want


def test_run_keeps_rows_without_id_and_no_repeats(spark, tmp_path):
    texts = {i: f"the quiet harbour number {i} " + " ".join(f"w{i}x{k}" for k in range(20)) for i in range(6)}
    rows = [(1, texts[0]), (1, texts[0]), (2, texts[1]), (2, texts[2]), (3, texts[2]), (None, texts[3]), (None, texts[4]), (None, texts[0])]
    folder = write(spark, tmp_path / "in", [(*r, None, None, None) for r in rows])
    got = corpus_pipeline.run(spark, folder).collect()
    assert sorted(r.doc_id or 0 for r in got) == [0, 0, 1, 2, 2]


def _rows(found):
    return sorted((repr((r.doc_id, r.text, r.lang, r.source, r.n_chars)) for r in found))


def test_each_stage_against_brute_force(spark, tmp_path):
    """Whole rows of every stage, with null and repeated ids, repeated rows, null texts, ties, and columns that clash."""
    draw = np.random.default_rng(9)
    prose = [" ".join(f"w{k}" for k in draw.integers(0, 400, 60)) for _ in range(12)]
    rows = [(i, t, "en", "s", None) for i, t in enumerate(prose)] + [(3, prose[3], "en", "s", None), (None, prose[4].replace(" ", "  "), None, "s", 1), (None, "alone here", None, None, None), (None, "alone here", None, None, None)]
    rows += [(20, prose[0] + " tail", "en", "s", None), (21, prose[1].upper(), "en", "s", None), (5, "another text of id five", "en", "t", None), (22, None, "en", "s", None), (23, "", "en", "s", None)]
    rows += [(24, "mail jo.81@mail7.example.com or JO.81@mail7.example.com", "en", "s", None), (24, "mail jo.81@mail7.example.com or JO.81@mail7.example.com", "en", "s", None), (25, "BUY!!! $$$ 4u " * 40, "en", "s", None)]
    folder = write(spark, tmp_path / "in", rows, [(i, 1, 0) for i in range(12)] + [(25, 0, 0), (24, 1, 0), (22, 1, 0), (None, 0, 0)])
    docs = spark.read.parquet(f"{folder}/documents.parquet")
    stages = dict(corpus_pipeline.STAGES)
    clash = lambda d: d.selectExpr("*", "text AS score", "doc_id AS row", "text AS _row", "lang AS key", "text AS entities", "doc_id AS node", "text AS bands")

    def after(name, df):
        out = stages[name](spark, df, folder)
        assert out.columns == list(corpus_pipeline.COLUMNS)
        assert _rows(out.collect()) == _rows(stages[name](spark, clash(df), folder).collect())
        out.write.parquet(str(tmp_path / name))
        return spark.read.parquet(str(tmp_path / name)), out.collect()

    weights, bias = quality.fit(docs, spark.read.parquet(f"{folder}/labels.parquet"), quality.F.lit(True))
    good = lambda t: 1 / (1 + np.exp(-(sum(float(weights[k]) * v for k, v in zip(*quality.features(t or ""))) + bias))) >= quality.THRESHOLD
    kept, got = after("quality", docs)
    want = [r for r in docs.collect() if good(r.text)]
    assert _rows(got) == _rows(want) and 25 not in {r.doc_id for r in got} and len(got) < len(rows)

    plain = lambda t: re.sub(r"[\x20\x09-\x0D]+", " ", t or "")
    order = lambda r: (r.doc_id is None, r.doc_id or 0)
    one = {}
    for r in sorted(want, key=order):
        one.setdefault(plain(r.text), r)
    kept, got = after("exact_dedup", kept)
    key = lambda rs: sorted((order(r), plain(r.text)) for r in rs)
    assert key(got) == key(one.values())

    shingles = lambda t: (lambda w: {tuple(w[i : i + 5]) for i in range(max(1, len(w) - 4))})(re.findall(r"[^\x20\x09-\x0D]+", (t or "").lower()))
    top = list(range(len(got)))
    sets = [shingles(r.text) for r in got]
    for a, b in itertools.combinations(range(len(got)), 2):
        if len(sets[a] & sets[b]) >= 0.8 * len(sets[a] | sets[b]) and top[a] != top[b]:
            top = [top[a] if x == top[b] else x for x in top]
    first = {}
    for r, c in zip(got, top):
        first[c] = min(first.get(c, r), r, key=order)
    kept, got = after("simhash", kept)
    assert _rows(got) == _rows(first.values()) and len(got) < len(one)

    spark.conf.set(pii.KEY_SETTING, "tests")
    try:
        want = sorted(repr((r.doc_id, r.text and pii.replaced(r.text, b"tests")[0])) for r in got)
        kept, got = after("pii", kept)
    finally:
        spark.conf.unset(pii.KEY_SETTING)
    assert sorted(repr((r.doc_id, r.text)) for r in got) == want and all(r.n_chars == (None if r.text is None else len(r.text)) for r in got)

    encoder = packing.encoder()
    ids = [encoder._raw([r.text or ""])[0] + (1).to_bytes(4, "little") for r in got]
    packed = stages["packing"](spark, kept, folder).collect()
    assert sorted(repr((r.doc_id, r.ids_crc32, r.length)) for r in packed) == sorted(repr((r.doc_id, zlib.crc32(x), len(x) // 4)) for r, x in zip(got, ids))
    for s in {r.sequence_id for r in packed}:
        mine = sorted((r.offset, r.length) for r in packed if r.sequence_id == s)
        assert [o for o, _ in mine] == [sum(n for _, n in mine[:k]) for k in range(len(mine))] and sum(n for _, n in mine) <= packing.WINDOW


def test_clashing_columns_of_paths(spark):
    nodes = spark.createDataFrame([(1, 1, None, "user", "a", 1.0, "x", "y"), (1, 2, 1, "assistant", None, None, "x", "y")], "tree long, node long, parent long, role string, text string, score double, rank string, formatted string")
    assert [(r.leaf, r.n_turns) for r in chat.format_paths(nodes).collect()] == [(2, 2)]
    turns = spark.createDataFrame([(1, 0, "user", "a", 5), (1, 0, "user", "a", 5), (None, None, None, None, None)], "conv_id long, turn long, role string, text string, node long")
    assert sorted(r.n_turns for r in chat.digests(chat.format_paths(chat.chain(turns))).collect()) == [1, 2]
    assert chat.digests(chat.format_paths(chat.reply_trees(turns.limit(0))), ("rank",)).count() == 0


def test_near_copies_meet_by_their_fingerprints(spark, monkeypatch):
    """BK-trees alone, without bands, bring together what lies within the radius; those pairs that are similar link."""
    draw = random.Random(5)
    texts = []
    for _ in range(30):
        words = [f"w{draw.randrange(10**6)}" for _ in range(400)]
        texts += [" ".join(words), " ".join([*words[:-1], "other"]), " ".join(words[3:]), " ".join(words[:250])]
    fps = [simhash.majority(near_dedup.grams(t)) for t in texts]
    root = list(range(len(texts)))
    for _ in texts:
        root = [min(r for r, b in zip(root, fps) if (a ^ b).bit_count() <= near_dedup.RADIUS) for a in fps]
    nodes = spark.createDataFrame([(i, fp - (1 << 64) if fp >> 63 else fp) for i, fp in enumerate(fps)], "node long, fp long")
    with common.Tables() as t:
        found = {}
        for r in near_dedup.fingerprint_buckets(nodes, t).collect():
            found.setdefault(r.band, set()).add(r.node)
    want = {}
    for i, r in enumerate(root):
        want.setdefault(r, set()).add(i)
    assert sorted(map(sorted, found.values())) == sorted(sorted(x) for x in want.values() if len(x) > 1)

    monkeypatch.setattr(near_dedup, "_signed", lambda rows, shingle, made=near_dedup._signed: made(rows, shingle).withColumn("bands", near_dedup.F.array(near_dedup.F.xxhash64("row"))))
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    grams = [near_dedup.grams(t) for t in texts]
    gone = set(range(len(texts))) - {r.doc_id for r in near_dedup.first_of_near(docs).collect()}
    sure = {i for i in range(len(texts)) if any(i > j and root[i] == root[j] and near_dedup.similarity(grams[i], grams[j]) >= 0.8 for j in range(i))}
    assert sure and gone == sure
