"""The ten operators on small fixtures: brute force, round trips, held-out accuracy and edge cases."""

import itertools
import re
import time
import zlib

import duckdb
import numpy as np
import pandas as pd
import pytest
import xxhash
from pyspark.sql import functions as F

import oracle
from pelagos.llm import chat, common, embedding_dedup, exact_dedup, graph, labelled, packing, pieces, pii, quality, queries, simhash, toxicity, url_filter
from pelagos.llm.common import Tables

EDGE = [(1, None, "a"), (2, "", "b"), (3, " \t\n ", "c"), (4, "same  text", "d"), (5, "same text", None), (5, "same text", None), (None, "same\ttext", "f"), (6, "x" * 9000 + " y", "g"), (7, "x" * 9000 + "  y", "h"), (8, "x" * 9000 + " z", "i")]
SCHEMA = "doc_id long, text string, keep_id string"


def docs(spark, rows=EDGE):
    return spark.createDataFrame(rows, SCHEMA)


@pytest.mark.parametrize("name", sorted(queries.ORACLE_SQL))
def test_queries_match_their_sql(spark, name):
    assert oracle.found(queries.QUERIES[name](spark, oracle.DATA)) == oracle.expected(queries.ORACLE_SQL[name])


def test_exact_groups_edges(spark):
    got = {tuple(r) for r in exact_dedup.exact_groups(docs(spark), block=64).select("doc_id", "keep_id", "group_size").collect()}
    assert got == {(1, 1, 2), (2, 1, 2), (3, 3, 1), (4, 4, 4), (5, 4, 4), (None, 4, 4), (6, 6, 2), (7, 6, 2), (8, 8, 1)}
    assert exact_dedup.exact_groups(docs(spark)).where("kept").count() == 5
    assert exact_dedup.exact_groups(docs(spark, [])).count() == 0


def test_simhash_links_match_brute_force():
    draw = np.random.default_rng(1)
    base = draw.integers(0, 1 << 63, 60).tolist()
    values = sorted({b ^ sum(1 << int(k) for k in draw.choice(64, draw.integers(0, 4), replace=False)) for b in base for _ in range(6)})
    tree = simhash.BKTree()
    for v in values:
        tree.add(v)
    for v in values[:50]:
        assert sorted(tree.near(v, 2)) == [w for w in values if (v ^ w).bit_count() <= 2]


def test_simhash_groups(spark):
    rows = simhash.near_groups(docs(spark)).collect()
    assert len(rows) == len(EDGE)
    of = {r.doc_id: (r.fingerprint, r.component_id) for r in rows}
    assert of[1][0] == of[2][0] == of[3][0] == "0" * 16 and of[3][1] == 1
    assert of[5][1] == of[4][1] == of[None][1] == 4
    assert simhash.near_groups(docs(spark, [])).count() == 0


def _plain_fingerprint(text):
    """By the contract's words: counts of every bit over all shingles, one by one."""
    words = re.findall(rb"[^\x20\x09-\x0D]+", re.sub(rb"[A-Z]", lambda m: m[0].lower(), (text or "").encode()))
    found = [b" ".join(words[i : i + 3]) for i in range(max(1, len(words) - 2))] if words else []
    hashes = [xxhash.xxh64_intdigest(x, 42) for x in found]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def test_simhash_query_matches_brute_force(spark):
    rows = spark.read.parquet(f"{oracle.DATA}/documents.parquet").select("doc_id", "text").collect()
    words = rows[0].text.split()
    rows = [(r.doc_id, r.text) for r in rows] + [(10**6 + k, " ".join(words[:k] + ["changed"] + words[k + 1 :])) for k in range(12)] + [(None, rows[1].text), (7 * 10**6, "One Two"), (7 * 10**6, "one  two")]
    fps = [_plain_fingerprint(t) for _, t in rows]
    top = list(range(len(rows)))
    for a, b in itertools.combinations(range(len(rows)), 2):
        if (fps[a] ^ fps[b]).bit_count() <= 2 and top[a] != top[b]:
            top = [top[a] if x == top[b] else x for x in top]
    least = {}
    for (i, _), c in zip(rows, top):
        least[c] = min((x for x in (least.get(c), i) if x is not None), default=None)
    want = sorted([(i, f"{f:016x}", least[c]) for (i, _), f, c in zip(rows, fps, top)], key=repr)
    table = spark.createDataFrame(rows, "doc_id long, text string")
    for full in (simhash.FULL, 2):
        assert sorted([tuple(r) for r in simhash.near_groups(table, full=full).collect()], key=repr) == want


def test_simhash_full_shards(spark):
    """100,000 fingerprints that agree in 32 bits: dealt again, none but small shards is left and no link is lost."""
    draw = np.random.default_rng(8)
    values = np.unique(draw.integers(0, 1 << 32, 100_000, np.uint64)) | np.uint64(0xABCD1234 << 32)
    near = np.unique(np.concatenate([values, values[:300] ^ np.uint64(5), values[:300] ^ np.uint64(7)])).view(np.int64)
    classes = spark.createDataFrame(pd.DataFrame({"fp": near}))
    with Tables() as t:
        largest = simhash.shards(classes, 2, 4, 500, t).groupBy("mask", "shard").count().agg({"count": "max"}).first()[0]
        assert largest <= 500
        began = time.time()
        got = {frozenset((r.src, r.dst)) for r in simhash.links(classes, t, full=500).collect()}
        assert time.time() - began < 120
    roots = {}

    def find(x):
        while roots.setdefault(x, x) != x:
            x = roots[x]
        return x

    for a, b in map(tuple, got):
        assert (int(a) ^ int(b)).bit_count() <= 2
        roots[find(a)] = find(b)
    have = set(near.tolist())
    for v in near[:2000].tolist():
        for k in [0, *(1 << i for i in range(32))]:
            for j in (1 << i for i in range(32)):
                if (w := v ^ k ^ j) in have and w != v:
                    assert find(v) == find(w)


def test_components(spark):
    chain = [(i, i + 1) for i in range(0, 40)] + [(100, i) for i in range(101, 160)] + [(7, 7), (None, 3)]
    got = {r.node: r.root for r in graph.components(spark.createDataFrame(chain, "src long, dst long")).collect()}
    assert got == {i: 0 for i in range(41)} | {i: 100 for i in range(100, 160)}


def test_packing(spark):
    lengths = np.random.default_rng(2).integers(1, 2049, 3000)
    where, offset, used = packing.best_fit_decreasing(lengths)
    for w in range(used):
        mine = np.flatnonzero(where == w)
        order = mine[np.argsort(offset[mine])]
        assert offset[order].tolist() == np.concatenate(([0], np.cumsum(lengths[order])[:-1])).tolist()
        assert lengths[mine].sum() <= 2048
    rows = packing.pack(docs(spark), window=256, with_ids=True).collect()
    encoder = packing.encoder()
    want = [encoder._raw([t or ""])[0] + (1).to_bytes(4, "little") for _, t, _ in EDGE]
    by = {}
    for r in rows:
        assert zlib.crc32(r.ids) == r.ids_crc32 and r.length == len(r.ids) // 4 <= 256
        by.setdefault((r.doc_id, r.doc_tokens), set()).add((r.start, bytes(r.ids)))
    for (i, _, _), ids in zip(EDGE, want):
        assert b"".join(p for _, p in sorted(by[i, len(ids) // 4])) == ids
    assert packing.pack(docs(spark, [])).count() == 0


def test_encoder_matches_the_tokenizer():
    said = ["Hello, World. ΣΑΣ İstanbul 12.5, x.\x1cy <|endoftext|> É.", "á. Ａ１. ., ,. ß.", "", " . , ", "re's 'll s t"]
    e = packing.encoder()
    assert e.encode(said) == [e._raw([t])[0] for t in said]


def test_encoder_matches_the_tokenizer_for_every_character():
    e = packing.encoder()
    signs = [chr(c) for c in range(1, 0x110000) if not 0xD800 <= c < 0xE000 and (c < 0x3000 or chr(c).isprintable())]
    for at in range(0, len(signs), 4000):
        for form in ("{}.", "a{},", "{}{}. x", "x{}", "x.{} y{},"):
            said = [form.replace("{}", c) for c in signs[at : at + 4000]]
            assert [s for s, got, want in zip(said, e.encode(said), e._raw(said)) if got != want] == []


def _slow_best_fit(lengths, window):
    left, out = [], []
    for i in sorted(range(len(lengths)), key=lambda i: -lengths[i]):
        fit = [x for x in left if x >= lengths[i]]
        if fit:
            left.remove(min(fit))
        left.append((min(fit) if fit else window) - lengths[i])
        out.append((i, min(fit) if fit else window))
    return len(left), dict(out), sorted(left)


@pytest.mark.parametrize("window", [7, 64, 100, 2048])
def test_best_fit_matches_a_slow_one(window):
    draw = np.random.default_rng(window)
    for n in (0, 1, 2, 50, 400):
        lengths = draw.integers(1, window + 1, n)
        where, offset, used = packing.best_fit_decreasing(lengths, window)
        windows, had, left = _slow_best_fit(lengths.tolist(), window)
        assert used == windows and (window - offset).tolist() == [had[i] for i in range(n)]
        assert sorted((window - np.bincount(where, weights=lengths, minlength=used)).astype(int).tolist()) == left


def _brute_links(ids, x, cosine=0.9):
    """(links, component) by id, by all pairs."""
    x = np.asarray(x, float)
    x = x / np.abs(x).max(axis=1, keepdims=True)
    x /= np.linalg.norm(x, axis=1, keepdims=True)
    link = (x @ x.T >= cosine) & ~np.eye(len(x), dtype=bool)
    root = np.arange(len(x))
    while True:
        low = np.minimum(root, np.where(link, root[None, :], len(x)).min(axis=1))
        if np.array_equal(low, root):
            break
        root = low
    least = {}
    for i, r in zip(ids, root.tolist()):
        least[r] = min(least.get(r, i), i)
    return {i: (int(n), least[r]) for i, n, r in zip(ids, link.sum(axis=1), root.tolist())}


@pytest.mark.parametrize("how", [None, embedding_dedup.Hashing(4, 1, 24, 0.5), embedding_dedup.Hashing(8, 2, 16, 0.4)])
def test_embeddings_match_brute_force(spark, how):
    """Every row's number of links and component, with cells dealt out to many tasks and without; ids of two types."""
    draw = np.random.default_rng(3)
    base = draw.normal(size=(40, 16))
    near = [b + draw.normal(size=16) * s for b in base for s in (0, 0.02, 0.05, 0.1)] + [base[0] + draw.normal(size=16) * 0.01 for _ in range(60)]
    near += [near[0], near[5]]
    odd = [(900, None), (901, [0.0] * 16), (902, [float("nan")] * 16), (903, [1.0]), (904, [2.0]), (None, [1.0])]
    want = _brute_links(range(len(near)), near) | {900: (0, 900), 901: (0, 901), 902: (0, 902), 903: (1, 903), 904: (1, 903), None: (0, None)}
    for cell in (4096, 3):
        for kind, name in (("long", lambda i: i), ("string", lambda i: None if i is None else f"v{i:04d}")):
            rows = [(name(i), [float(x) for x in v], "x") for i, v in enumerate(near)] + [(name(i), v, "x") for i, v in odd]
            vectors = spark.createDataFrame(rows, f"vec_id {kind}, embedding array<double>, class string")
            got = {r.vec_id: (r.n_links, r.component_id) for r in embedding_dedup.near_links(vectors, how=how, cell=cell).collect()}
            assert got == {name(i): (n, name(c)) for i, (n, c) in want.items()}


def test_large_doubles_link(spark):
    rows = [(1, [1e300, 1.0]), (2, [1e300, 2.0]), (3, [1.0, 1e300]), (4, [-1e-300, 0.0]), (5, [-2e-300, 0.0]), (6, [float("inf"), 1.0])]
    got = {r.vec_id: (r.n_links, r.component_id) for r in embedding_dedup.near_links(spark.createDataFrame(rows, "vec_id long, embedding array<double>")).collect()}
    assert got == {1: (1, 1), 2: (1, 1), 3: (0, 3), 4: (1, 4), 5: (1, 4), 6: (0, 6)}


@pytest.mark.parametrize("how", [h for _, h in embedding_dedup.HASHINGS])
def test_recall_of_the_hashings(how):
    """Pairs at a cosine of exactly 0.9 meet in at least nine of ten cases (the README has the figures)."""
    draw = np.random.default_rng(6)
    a = draw.normal(size=(2000, 64))
    a /= np.linalg.norm(a, axis=1, keepdims=True)
    r = draw.normal(size=a.shape)
    r -= (r * a).sum(axis=1, keepdims=True) * a
    b = 0.9 * a + 0.19**0.5 * r / np.linalg.norm(r, axis=1, keepdims=True)
    x, y = embedding_dedup.keys(a, how), embedding_dedup.keys(b, how)
    met = ((x == y[:, :, :1]) | (y == x[:, :, :1])).any(axis=(1, 2))
    far = (x[:, :, :, None] == np.roll(x, 1, axis=0)[:, :, :1, None]).any(axis=(1, 2, 3))
    print(how, "recall at 0.9:", met.mean(), "unrelated:", far.mean())
    assert met.mean() >= 0.95 and far.mean() < 0.03


def test_links_do_not_depend_on_the_size_of_the_table(spark):
    """Of 2,000 pairs at a cosine of 0.9 in a small table, those link that would in the largest."""
    draw = np.random.default_rng(8)
    a = draw.normal(size=(2000, 64))
    a /= np.linalg.norm(a, axis=1, keepdims=True)
    r = draw.normal(size=a.shape)
    r -= (r * a).sum(axis=1, keepdims=True) * a
    b = 0.9001 * a + (1 - 0.9001**2) ** 0.5 * r / np.linalg.norm(r, axis=1, keepdims=True)
    how = embedding_dedup.HASHINGS[-1][1]
    x, y = embedding_dedup.keys(a, how), embedding_dedup.keys(b, how)
    met = ((x == y[:, :, :1]) | (y == x[:, :, :1])).any(axis=(1, 2))
    vectors = spark.createDataFrame([(i, v.tolist()) for i, v in enumerate(np.concatenate([a, b]))], "vec_id long, embedding array<double>")
    linked = {r.component_id for r in embedding_dedup.near_links(vectors).where("n_links > 0").collect()}
    assert 0 < len(linked) < 2000 and linked == set(np.flatnonzero(met).tolist())


def test_chat_trees_and_round_trip(spark):
    rows = [(1, 0, None, "user", "<|im_end|> <\\|x|>", 1.0), (1, 1, 0, "assistant", "a", 5.0), (1, 2, 0, "ass\nist<|%", None, None), (1, 3, 2, "assistant", "<|im_start|>", 1.0), (1, 4, 9, "user", "lone", 0.5), (1, 5, 6, "user", "cycle", 1.0), (1, 6, 5, "user", "cycle", 1.0), (None, 0, None, "assistant", "", 1.0)]
    nodes = spark.createDataFrame(rows, "tree long, node long, parent long, role string, text string, score double")
    got = {(r.tree, r.leaf): r for r in chat.format_paths(nodes).withColumn("turns", chat.parse(chat.F.col("formatted"))).collect()}
    assert set(got) == {(1, 1), (1, 3), (1, 4), (None, 0)}
    assert got[1, 1]["rank"] == 1 and got[1, 3]["rank"] == 2
    assert [tuple(t) for t in got[1, 3].turns] == [("user", "<|im_end|> <\\|x|>"), ("ass\nist<|%", ""), ("assistant", "<|im_start|>")]
    span = got[1, 3].loss_spans[0]
    assert got[1, 3].formatted[span.start : span.start + span.length] == "<\\|im_start|>"
    assert len(chat.format_paths(nodes, top=1).collect()) == 2
    assert chat.format_paths(nodes.limit(0)).count() == 0


def test_url_rules(spark):
    urls = ["http://a.net/x", "http://net", "HTTP://A.EXAMPLE.NET/en/q?z", "x://example.com/de/#", "x://badexample.com/de/", None, "", "no scheme", "http://u@k.org:80/fr/", "http://k.org/fr/", "a://b://c.net/"]
    pages = spark.createDataFrame([(i, u, "h") for i, u in enumerate(urls)], "page_id long, url string, host string")
    got = {r.page_id: (r.rule, r.verdict) for r in url_filter.judge(pages, url_filter.rules_table(spark)).collect()}
    assert got == {0: ("net/", "block"), 1: (None, "allow"), 2: ("example.net/en/", "allow"), 3: ("example.com/de/", "block"), 4: (None, "allow"), 5: (None, "allow"), 6: (None, "allow"), 7: (None, "allow"), 8: (None, "allow"), 9: ("org/fr/", "allow"), 10: (None, "allow")}
    assert url_filter.judge(pages, url_filter.rules_table(spark).limit(0)).where("rule is null").count() == len(urls)


def test_surrogates(spark):
    text = "Mail Jo.81@mail7.example.com or jo.81@mail7.example.com, call +1 (017) 555-7713, 10.1.2.3, card 4111 1111 1111 1111, token = \"0a1b2c3d4e5f\". Frau Anna Schmidt."
    before = spark.createDataFrame([(1, text, "x"), (2, None, "y"), (3, "", "z"), (4, "nothing here 3.14 on 2024-01-02", "w")], "doc_id long, text string, entities string")
    after = pii.surrogates(before, b"k", pairs="_pairs")
    got = {r.doc_id: r for r in after.collect()}
    assert [e.type for e in got[1].entities] == ["email", "email", "phone", "ip", "card", "secret", "person"]
    new = [got[1].text[e.new_start : e.new_start + e.new_length] for e in got[1].entities]
    assert new[0].lower() == new[1].lower() and new[2].startswith("+1 (") and new[3].startswith("10.") and pii._luhn(new[4].replace(" ", "")[:-1]) == int(new[4][-1])
    assert new[6].split()[0] in pii.NAMES["female", "latin"] and not any(got[1].text.find(text[e.start : e.start + e.length]) >= 0 for e in got[1].entities)
    assert got[2].text is None and got[3].text == "" and got[4].text == "nothing here 3.14 on 2024-01-02"
    assert pii.collisions(after).count() == 0


@pytest.mark.parametrize("size", [2, 3, 10, 97, 300])
def test_permutation_moves_everything(size):
    image = [pii.permute(x, size, b"k", "t") for x in range(size)]
    assert sorted(image) == list(range(size)) and all(a != b for a, b in enumerate(image))


def test_name_surrogates_are_distinct():
    names = ["".join(p) for p in itertools.product("AB", "an", "na", "an", "aei")] + [n for ns in pii.NAMES.values() for n in ns]
    made = [pii.surrogate("person", f"{n} Xu", b"k").split()[0] for n in dict.fromkeys(names)]
    assert len(set(made)) == len(made)


def _best(p, part):
    out = []

    def go(i, score, ids):
        if i == len(part):
            out.append((score, tuple(ids)))
            return
        for j in range(i + 1, len(part) + 1):
            if part[i:j] in p.piece:
                k, s = p.piece[part[i:j]]
                go(j, score + s, [*ids, k])
        if part[i] not in p.piece:
            go(i + 1, score + p.unknown, [*ids, *(p.bytes[b] for b in part[i].encode())])

    go(0, 0.0, [])
    return sorted(out, key=lambda x: -x[0])


def test_n_best_pieces_match_brute_force(spark):
    p = pieces.pieces()
    for text in ("hello the world", "a  b\nc ሴ", "naïve"):
        want, got = _best(p, (" " + text).replace(" ", "▁")), p.encode(text, 6)
        assert [s for s, _ in want[:6]] == [s for s, _ in got]
        assert all((s, tuple(np.frombuffer(i, "<u4").tolist())) in want for s, i in got) and len({i for _, i in got}) == len(got)
        assert all(p.decode(i) == text for _, i in got)
    rows = pieces.encode(docs(spark)).collect()
    assert all(r.round_trip for r in rows) and len(rows) == len(EDGE)
    assert pieces.decode(pieces.encode(docs(spark)).selectExpr("doc_id", "ids[0] AS ids")).where("doc_id = 4").first().decoded == "same  text"


@pytest.mark.parametrize("module, label, least", [(quality, "quality", 0.95), (toxicity, "toxic", 0.8)])
def test_classifiers_hold_out(spark, module, label, least):
    data = "/root/testdata/sf0.01"
    labels = spark.read.parquet(f"{data}/labels.parquet")
    got = module.judged(spark.read.parquet(f"{data}/documents.parquet"), labels).join(labels, "doc_id").where("held_out").toPandas()
    y, s = got[label].to_numpy(), got["score"].to_numpy()
    auc = np.mean([(a > b) + 0.5 * (a == b) for a in s[y == 1] for b in s[y == 0]])
    assert auc > least and s.min() >= 0 and s.max() <= 1


@pytest.mark.parametrize("module", [quality, toxicity])
def test_classifiers_without_labels(spark, module):
    labels = spark.createDataFrame([], "doc_id long, quality int, toxic int")
    assert module.judged(docs(spark), labels).count() == len(EDGE)
    assert module.judged(docs(spark, []), labels).count() == 0


def test_toxic_words_with_gaps():
    toxic = [(1, ["you", "idiot", f"w{i}xyz"]) for i in range(30)]
    clean = [(0, ["you", "thing", "idea", f"w{i}xyz", f"or{i}ing"]) for i in range(30)]
    table, bias, slope, shift = toxicity.learn(toxic + clean)
    m = dict(zip(words := ["idiot", "i.d.i.o.t", "idiiot", "idio-t", "thing", "idea"], toxicity.margins(words, table, bias)))
    assert min(m["idiot"], m["idiiot"], m["idio-t"]) > max(m["thing"], m["idea"]) and m["i.d.i.o.t"] > m["thing"]
    assert "idiot" in toxicity.units("an i d i o t here")


def test_hashes_agree_with_duckdb(spark):
    r = exact_dedup.exact_groups(docs(spark)).where("doc_id = 4").first()
    assert r.text_sha256 == duckdb.sql("SELECT sha256('same text')").fetchall()[0][0]


def test_packing_does_not_depend_on_partitions(spark):
    rows = [(i, "word " * int(n), None) for i, n in enumerate(np.random.default_rng(7).integers(1, 120, 300))]
    used = [packing.pack(docs(spark, rows).repartition(n), window=128).select("sequence_id").distinct().count() for n in (1, 60)]
    assert used[1] <= used[0] + 1


def test_url_join_is_on_the_short_prefix(spark):
    """The plan joins on the short prefix alone; a rule of the same prefix but another digest fits nothing."""
    plan = url_filter.judge(spark.createDataFrame([(1, "http://a.net/")], "page_id long, url string"), url_filter.rules_table(spark))._jdf.queryExecution().optimizedPlan().toString()
    joins = [x for x in plan.splitlines() if "Join" in x]
    assert len(joins) == 1 and "short" in joins[0] and "digest" not in joins[0] and "full" not in joins[0]
    short, url_filter.SHORT = url_filter.SHORT, 1  # 16 prefixes: many rules and expressions share one
    try:
        rules = spark.createDataFrame([(f"h{i}.org", "/a", "block") for i in range(200)] + [("org", "/a/b", "allow")], "host string, path string, verdict string")
        pages = spark.createDataFrame([(i, f"http://x.h{i}.org/a{'/b' if i % 2 else ''}") for i in range(150, 260)], "page_id long, url string")
        for r in url_filter.judge(pages, rules).collect():
            want = f"h{r.page_id}.org/a" if r.page_id < 200 else "org/a/b" if r.page_id % 2 else None
            assert (r.rule, r.verdict) == (want, "block" if r.page_id < 200 else "allow")
    finally:
        url_filter.SHORT = short


def test_blocks_of_one_digest(spark):
    got = {tuple(r) for r in exact_dedup.exact_groups(docs(spark), block=64, digest=lambda b: exact_dedup.F.length(b)).select("doc_id", "keep_id", "group_size").collect()}
    assert got == {(1, 1, 2), (2, 1, 2), (3, 3, 1), (4, 4, 4), (5, 4, 4), (None, 4, 4), (6, 6, 2), (7, 6, 2), (8, 8, 1)}


def test_many_paths_are_merged():
    p = pieces.pieces()
    text = "hello the world again and then some more words of a longer sentence here"
    began = time.time()
    got = p.encode(text, 12)
    assert time.time() - began < 5 and len({i for _, i in got}) == 12 and [s for s, _ in got] == sorted([s for s, _ in got], reverse=True)
    assert [s for s, _ in p.encode(text, 3)] == pytest.approx([s for s, _ in got[:3]])


@pytest.mark.parametrize("module", [quality, toxicity])
def test_classifiers_of_any_id_and_hot_ids(spark, module):
    rows = [(f"d{i % 7}", f"word{i} text {'!!! $$$ idiot' if i % 7 < 3 else 'quiet harbour'}") for i in range(40)]
    labels = spark.createDataFrame([(f"d{i}", int(i < 3), int(i < 3)) for i in range(7)] * 2, "doc_id string, quality int, toxic int")
    table = spark.createDataFrame(rows, "doc_id string, text string")
    assert labelled.sample(table, labels, "quality", F.lit(True), 5).count() <= 7
    assert module.judged(table, labels).count() == 40


_M = (1 << 64) - 1


def _plain_features(text):
    """The hashed n-grams, one by one."""
    words = re.findall(r"\w+|[^\w\s]+", text)
    shape = lambda w: w[:3] if not (w[0].isalnum() or w[0] == "_") else "9" if w.isdigit() else "A" if w.isupper() and len(w) > 1 else "T" if w[0].isupper() else "a"
    w = [zlib.crc32(x.encode("utf-8", "replace")) for x in words]
    s = [zlib.crc32(shape(x).encode("utf-8", "replace"), 1) for x in words]

    def mixed(*parts):
        h = parts[0] * 0x9E3779B97F4A7C15 & _M
        for p in parts[1:]:
            h = (h ^ p ^ h >> 29) * 0x9E3779B97F4A7C15 & _M
        return h >> 46

    found = [mixed(a) for a in w] + [mixed(a) for a in s] + [mixed(*p) for p in zip(w, w[1:])] + [mixed(*p) for p in zip(s, s[1:])] + [mixed(*p) for p in zip(s, s[1:], s[2:])] + [1 for a, b in zip(w, w[1:]) if a == b]
    values = {k: np.log1p(found.count(k)) for k in sorted(set(found))}
    size = sum(v * v for v in values.values()) ** 0.5
    return {k: v / size for k, v in values.items()}


def test_quality_matches_a_plain_learner(spark):
    """Features, follow-the-regularised-leader updates and scores against dictionaries and single steps."""
    rows = [(i, f"Good harbour, boats {i} and nets." if i % 2 else f"BUY BUY {i} $$$ now now", i % 2) for i in range(30)]
    learned = [(y, *quality.features(t)) for _, t, y in rows]
    for (_, t, _), (_, numbers, values) in zip(rows, learned):
        assert dict(zip(numbers.tolist(), values.tolist())) == pytest.approx(_plain_features(t))
    alpha, beta, l1, l2 = 0.5, 1.0, 0.02, 0.1
    z, n, bias = {}, {}, [0.0, 0.0]
    at = lambda k: 0.0 if abs(z.get(k, 0.0)) <= l1 else (np.sign(z[k]) * l1 - z[k]) / ((beta + n[k] ** 0.5) / alpha + l2)
    b = lambda: -bias[0] / ((beta + bias[1] ** 0.5) / alpha + l2)
    order = np.random.default_rng(7)
    for _ in range(quality.PASSES):
        for i in order.permutation(len(rows)).tolist():
            f = _plain_features(rows[i][1])
            g0 = (1 + rows[i][2]) * (1 / (1 + np.exp(-(sum(at(k) * v for k, v in f.items()) + b()))) - rows[i][2])  # as many of both: good ones count twice
            steps = {k: (g0 * v, at(k)) for k, v in f.items()}
            for k, (g, w) in steps.items():
                z[k] = z.get(k, 0.0) + g - ((n.get(k, 0.0) + g * g) ** 0.5 - n.get(k, 0.0) ** 0.5) / alpha * w
                n[k] = n.get(k, 0.0) + g * g
            here = b()
            bias = [bias[0] + g0 - ((bias[1] + g0 * g0) ** 0.5 - bias[1] ** 0.5) / alpha * here, bias[1] + g0 * g0]
    weights, offset = model = quality.learn(learned)
    assert offset == pytest.approx(b(), abs=1e-6) and all(weights[k] == pytest.approx(at(k), abs=1e-5) for k in z)
    said = [(1, None), (2, ""), (3, rows[0][1]), (4, rows[1][1] * 50), (4, "other words")]
    got = quality.score(spark.createDataFrame(said, "doc_id long, text string"), model).collect()
    for r, (_, t) in zip(got, said):
        assert r.score == pytest.approx(1 / (1 + np.exp(-(sum(float(weights[k]) * v for k, v in _plain_features(t or "").items()) + offset))), abs=1e-6)


def _plain_kernel(a, b):
    """By definition: products of decayed occurrences of all triples of characters, gaps allowed, over the norms."""
    def phi(w):
        codes, out = toxicity._coded([w])[0].tolist(), {}
        for i, j, k in itertools.combinations(range(len(w)), 3):
            if k - i < toxicity.SPAN:
                key = codes[i], codes[j], codes[k]
                out[key] = out.get(key, 0.0) + toxicity.DECAY ** (k - i + 1)
        return out
    x, y = phi(a), phi(b)
    return sum(v * y.get(k, 0.0) for k, v in x.items()) / (sum(v * v for v in x.values()) * sum(v * v for v in y.values())) ** 0.5


def test_toxicity_matches_the_kernel(spark):
    """Kernels by definition; the folded table gives the machine's margins on Nyström features; a text has its worst word's score."""
    words = ["^idiot$", "^i.d.i.o.t$", "^idiiot$", "^thing$", "^idea$", "^hello$", "^ab$"]
    marks = toxicity.Landmarks(words[:4])
    assert np.allclose(marks.kernels(words), [[_plain_kernel(a, b) for b in words[:4]] for a in words], atol=1e-5)
    weights = np.random.default_rng(2).normal(size=marks.root.shape[1])
    table = marks.folded(weights)
    assert np.allclose(toxicity._values(words, table), marks.features(words) @ weights, atol=1e-3)
    model = (table, -0.25, 4.0, 0.5)
    texts = [None, "", "a", "hello thing", "Hello idea i.d.i.o.t!", "the idiiot " + "thing " * 500]
    got = toxicity.score(spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string"), model).collect()
    for r, t in zip(got, texts):
        cores = [f"^{w.strip('!.')}$" for w in (t or "").lower().split()]
        best = max([sum(float(f) * w for f, w in zip(marks.features([c])[0], weights)) - 0.25 for c in cores if len(c) >= 3], default=-3.0)
        assert r.score == pytest.approx(1 / (1 + np.exp(-(4.0 * max(best, -3.0) + 0.5))), abs=1e-3)


def test_tables_go(spark):
    """A block's tables go with it or before; what is saved is registered to go with the application; clusters need a folder."""
    with Tables() as t:
        first, second = t.save(spark.range(3)), t.save(spark.range(4))
        paths = [p for _, p in t.held]
        t.drop(first)
        gone = [not files.exists(at) for files, at in (common._files(spark, p) for p in paths)]
        assert gone == [True, False] and second.count() == 4
    assert not any(files.exists(at) for files, at in (common._files(spark, p) for p in paths))
    kept = common.save(spark.range(5))
    files, at = common._files(spark, kept.inputFiles()[0].rpartition("/")[0].removeprefix("file://"))
    assert files.exists(at) and files.cancelDeleteOnExit(at)
    files.delete(at, True)


def test_keys_tell_rows_apart(spark, tmp_path):
    rows = spark.range(0, 1000, 1, 7).selectExpr("id % 10 AS doc_id", "'same' AS text")
    rows.write.parquet(str(tmp_path / "a"))
    read = spark.read.parquet(str(tmp_path / "a"))
    for df in (read, read.where("doc_id > 4").select("text", "doc_id"), rows, read.union(read), read.join(read.select("doc_id").distinct(), "doc_id")):
        keyed = common.keyed(df)
        assert keyed.select("_row").distinct().count() == keyed.count() == df.count()
        assert keyed.join(keyed.select("_row"), "_row").count() == df.count()
