"""Each operator against a plain version, on rows with nulls, empty and long texts, ties, repeats and clashing columns."""

import base64
import hashlib
import math
import pickle
import random
import re
import time
import zlib
from collections import Counter

import numpy as np
import public_tokenizers
import pyarrow as pa
import pytest

from postlens.llm import bpe, chat_format, decontaminate, embedding_dedup, minhash, resampling, sharding, suffix_dedup, toxicity, url_filter


def pairs_of(df, *names):
    return sorted((tuple(r[n] for n in names) for r in df.collect()), key=str)


# 1 -------------------------------------------------------------------------------------------------------------------
def shingle_set(text, size):
    words = re.findall(r"[^\x20\x09-\x0D]+", re.sub("[A-Z]", lambda m: m[0].lower(), text or ""))
    return frozenset(zip(*(words[i:] for i in range(size)))) if len(words) >= size else frozenset([tuple(words)] if words else [])


def plain_groups(rows, size, per_cent=80):
    sets = [shingle_set(t, size) for _, t in rows]
    top = list(range(len(rows)))

    def root(i):
        while top[i] != i:
            i = top[i]
        return i

    for i in range(len(rows)):
        for j in range(i):
            if sets[i] and sets[j] and 100 * len(sets[i] & sets[j]) >= per_cent * len(sets[i] | sets[j]):
                top[root(i)] = root(j)
    out = []
    for i, (doc, _) in enumerate(rows):
        ids = [rows[j][0] for j in range(len(rows)) if root(j) == root(i) and rows[j][0] is not None]
        low = min(ids) if ids else None
        out.append((doc, len(sets[i]), low, doc == low))
    return sorted(out, key=str)


@pytest.mark.parametrize("size", [2, 5])
def test_minhash_small(spark, docs, rows, size):
    got = pairs_of(minhash.minhash_groups(spark, docs, size), "doc_id", "n_shingles", "component_id", "kept")
    assert got == plain_groups(rows, size)


def test_minhash_near_copies(spark):
    rng = random.Random(3)
    base = [f"v{rng.randrange(900)}" for _ in range(120)]
    rows = []
    for i in range(160):  # one group of near copies at all distances around the limit
        words = list(base)
        for _ in range(rng.randrange(0, 9)):
            words[rng.randrange(120)] = f"n{rng.randrange(10**6)}"
        rows.append((i, " ".join(words)))
    df = spark.createDataFrame(rows, "doc_id long, text string")
    got = pairs_of(minhash.minhash_groups(spark, df, 2), "doc_id", "n_shingles", "component_id", "kept")
    assert got == plain_groups(rows, 2)


def test_minhash_empty(spark, empty):
    assert minhash.minhash_groups(spark, empty).count() == 0


# 2 -------------------------------------------------------------------------------------------------------------------
def test_bpe_functions_need_no_package_on_executors(vocabulary):
    import subprocess
    import sys

    from pyspark import cloudpickle

    plain = pickle.dumps(vars(vocabulary))  # as a broadcast is
    task = cloudpickle.dumps(bpe.Vocabulary)  # as a function's own names are
    code = "import pickle, sys; a, b = pickle.load(sys.stdin.buffer); print(len(pickle.loads(b).of(pickle.loads(a)).ends))"
    out = subprocess.run([sys.executable, "-c", code], input=pickle.dumps((plain, task)), capture_output=True, cwd="/", env={})
    assert out.returncode == 0 and int(out.stdout) == len(vocabulary.ends), out.stderr


@pytest.fixture(scope="module")
def vocabulary():
    return bpe.load_vocabulary(public_tokenizers.path("byte_bpe_multi_50k.tiktoken"), public_tokenizers.PATTERN)


def test_bpe_equals_library(spark, docs, rows, vocabulary):
    import tiktoken

    with open(public_tokenizers.path("byte_bpe_multi_50k.tiktoken"), "rb") as f:
        ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, f)}
    library = tiktoken.Encoding("own", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={})
    extra = ["x" * 2000, "it's <|endoftext|> 12 ٣", "ab" * 600, "  \n\n  z", "é" * 700]
    df = docs.unionByName(spark.createDataFrame([(100 + i, t) for i, t in enumerate(extra)], "doc_id long, text string"), True)
    got = bpe.bpe_decode(spark, bpe.bpe_encode(spark, df, vocabulary), vocabulary).collect()
    assert len(got) == len(rows) + len(extra)
    for r in got:
        assert np.frombuffer(r.ids, "<u4").tolist() == library.encode_ordinary(r.text or "")
        assert bytes(r.decoded) == (r.text or "").encode()
        assert r.doc_id is None or r.doc_id >= 100 or r.tie == "a"


def test_bpe_arrays_and_empty(spark, docs, empty, vocabulary):
    some = bpe.bpe_encode(spark, docs.where("doc_id in (6, 8, 12)"), vocabulary)
    for r in some.join(bpe.token_arrays(some).select("doc_id", F_ids()), "doc_id").collect():
        assert np.frombuffer(r.ids, "<u4").tolist() == r["list"]
    assert bpe.bpe_encode(spark, empty, vocabulary).count() == 0


def F_ids():
    from pyspark.sql import functions as F

    return F.col("ids").alias("list")


# 3 -------------------------------------------------------------------------------------------------------------------
def test_sharding(spark, docs, rows, empty):
    tree = sharding.balanced(8)
    many = spark.range(4000).selectExpr("id AS doc_id", "'t' AS text")
    got = sharding.hash_tree_shards(spark, docs.select("doc_id", "text", "tie").unionByName(many, True), tree, sharding.grown(tree)).collect()
    assert len(got) == len(rows) + 4000
    for s in range(8):
        own = sorted(r.slot for r in got if r.shard == s)
        assert own == list(range(len(own))) and len(own) > 350
    assert all(r.grown_shard in (r.shard, 8) for r in got) and any(r.grown_shard == 8 for r in got)
    assert {(r.doc_id, r.size, r.text_crc32) for r in got if r.text_crc32 != zlib.crc32(b"t")} == {
        (i, len((t or "").encode()) + 1, zlib.crc32((t or "").encode())) for i, t in rows}
    assert len({(r.doc_id, r.shard) for r in got}) == len({r.doc_id for r in got})
    assert sharding.hash_tree_shards(spark, empty, tree).count() == 0


def test_sharding_moves_stay_in_changed_subtrees(spark):
    n = sharding.Node
    before = n("root", (n("a", (n("r", (n("s0", shard=0), n("s1", shard=1))),)), n("b", (n("r", (n("s2", shard=2), n("s3", shard=3))),))))
    after = n("root", (before.children[0], n("b", (n("r", (n("s2", shard=2), n("s3", shard=3, own=2.0))),))))
    rows = sharding.hash_tree_shards(spark, spark.range(3000).selectExpr("id AS doc_id", "'' AS text"), before, after).collect()
    moved = {(r.shard, r.grown_shard) for r in rows if r.shard != r.grown_shard}
    assert moved and all(to in (2, 3) for _, to in moved) and (3, 2) not in moved


# 4 -------------------------------------------------------------------------------------------------------------------
def test_quotation_linking(spark):
    rows = [("c", 0, "user", "Hello there\nHow are you?"), ("c", 1, "bob", "> Hello  THERE\nFine."), ("c", 2, "eve", "Unrelated"),
            ("c", 3, "user", ">> how are you?\n> Fine.\nGood"), ("c", 4, "x", "> nobody said\nHm"), ("d", 0, None, "> Fine.\n"), ("d", 1, "u", None),
            (None, None, "u", "Fine."), ("c", 1, "bob", "> Hello there")]
    df = spark.createDataFrame([(*r, 1) for r in rows], "conv_id string, turn int, role string, text string, c int")
    got = {(r.conv_id, r.turn, r.n_quotes, r.body): r for r in chat_format.chat_messages(spark, df).collect()}
    assert len(got) == len(rows)
    see = lambda *k: (got[k].thread, got[k].parent_turn, got[k].depth, got[k].n_linked)
    assert see("c", 0, 0, "Hello there\nHow are you?") == (0, None, 0, 0)
    assert see("c", 1, 1, "Fine.") == (0, 0, 1, 1)
    assert see("c", 1, 1, "") == (0, 0, 1, 1)
    assert see("c", 2, 0, "Unrelated") == (2, None, 0, 0)
    assert see("c", 3, 2, "Good") == (0, 1, 2, 2)
    assert see("c", 4, 1, "> nobody said\nHm") == (4, None, 0, 0)  # no text is lost
    assert see("d", 0, 1, "> Fine.") == (0, None, 0, 0)
    assert got["d", 0, 1, "> Fine."].chat == "<|unknown|>\n> Fine.\n<|end|>\n"
    assert see("d", 1, 0, "") == (1, None, 0, 0)
    assert chat_format.chat_messages(spark, df.where("turn > 99")).count() == 0


# 5 -------------------------------------------------------------------------------------------------------------------
RULES = {"com/": "allow", "example.com/en/": "block", "www.example.com/en/": "allow", "net/es/": "block"}


def test_url_rules_and_models(spark):
    urls = {"http://a.COM/x?q": ("a.com", "/x", "com/", "allow"), "http://x.example.com/en/1": ("x.example.com", "/en/1", "example.com/en/", "block"),
            "https://m.www.example.com/en/": ("m.www.example.com", "/en/", "www.example.com/en/", "allow"), "http://notcom": ("notcom", "", None, None),
            "http://example.com": ("example.com", "", None, None), "ftp://b.net/es/?": ("b.net", "/es/", "net/es/", "block"), "no scheme": ("", "", None, None),
            None: ("", "", None, None), "": ("", "", None, None), "http://com/#/": ("com", "/", "com/", "allow"), "http://com?/": ("com", "", None, None)}
    rows = [(i, u, "z") for i, u in enumerate(urls)] + [(i, f"http://site{i}.com/good/{i}", "z") for i in range(100, 140)]
    rows += [(i, f"http://site{i}.net/es/spam/{i}", "z") for i in range(200, 240)] + [(300, "http://q.org/es/spam/7", "z"), (301, "http://q.org/good/7", "z")]
    got = url_filter.url_verdicts(spark, spark.createDataFrame(rows, "page_id long, url string, host string"), RULES).collect()
    by = {r.page_id: r for r in got}
    assert len(got) == len(rows)
    for i, (u, (host, path, rule, verdict)) in enumerate(urls.items()):
        assert (by[i].host, by[i].path, by[i].rule) == (host, path, rule), u
        assert by[i].verdict in ([verdict] if verdict else ["allow", "block"])
    assert by[300].verdict == "block" and by[301].verdict == "allow"
    none = url_filter.url_verdicts(spark, spark.createDataFrame([(1, "http://a.org/"), (1, None)], "page_id long, url string"), RULES).collect()
    assert [r.verdict for r in none] == ["allow", "allow"]


# 6 -------------------------------------------------------------------------------------------------------------------
def test_embeddings(spark):
    rng = np.random.default_rng(5)
    rows = []
    for label in (1, 2):
        centres = rng.standard_normal((40, 16))
        for i in range(400):
            v = centres[i % 40] + rng.standard_normal(16) * rng.choice([0.02, 0.15, 0.4])
            rows.append((len(rows), [float(x) for x in v], label))
    rows += [(900, rows[0][1], 1), (901, rows[0][1], 2), (902, rows[0][1], None), (903, None, 1), (904, [0.0] * 16, 1), (905, [], 1),
             (906, [float("nan")] + [1.0] * 15, 1), (907, [None] + [1.0] * 15, 1), (908, [float("inf")] * 16, 1), (909, [1.0, 2.0], 1), (909, [2.0, 4.0], 1)]
    rows += [(1000 + i, [float(x) for x in np.ones(16) + rng.standard_normal(16) * 0.01], 3) for i in range(500)]
    df = spark.createDataFrame([(*r, "z") for r in rows], "vec_id long, embedding array<double>, label int, node string")
    got = pairs_of(embedding_dedup.embedding_groups(spark, df), "vec_id", "n_links", "component_id", "kept")
    ok = [v is not None and len(v) > 0 and label is not None and all(x is not None and math.isfinite(x) for x in v) and any(v) for _, v, label in rows]
    top = list(range(len(rows)))
    n = [0] * len(rows)

    def root(i):
        while top[i] != i:
            i = top[i]
        return i

    for i, (_, v, a) in enumerate(rows):
        for j in range(i):
            if ok[i] and ok[j] and a == rows[j][2] and len(v) == len(rows[j][1]):
                x, y = np.array(v), np.array(rows[j][1])
                if x @ y / math.sqrt((x @ x) * (y @ y)) >= 0.98:
                    n[i] += 1
                    n[j] += 1
                    top[max(root(i), root(j))] = min(root(i), root(j))
    want = [(r[0], n[i], rows[root(i)][0], r[0] == rows[root(i)][0]) for i, r in enumerate(rows)]
    assert got == sorted(want, key=str)
    assert embedding_dedup.embedding_groups(spark, df.where("vec_id < 0")).count() == 0


def test_embeddings_large_group(spark):
    rng = np.random.default_rng(8)
    centre = rng.standard_normal(64)
    group = centre / np.linalg.norm(centre) + rng.standard_normal((3000, 64)) * math.sqrt((1 / 0.982 - 1) / 64)
    x = np.concatenate([group, rng.standard_normal((6000, 64))])
    df = spark.createDataFrame(pa.table({"vec_id": np.arange(len(x)), "embedding": pa.array(x.tolist()), "label": np.ones(len(x), np.int32)}))
    got = embedding_dedup.embedding_groups(spark, df).toPandas().set_index("vec_id")
    x /= np.linalg.norm(x, axis=1, keepdims=True)
    want = np.concatenate([(x[i : i + 1000] @ x.T >= 0.98).sum(axis=1) - 1 for i in range(0, len(x), 1000)])
    assert want[:3000].min() > 0 and not want[3000:].any()
    assert int(np.abs(got.n_links.sort_index().to_numpy() - want).sum()) == 0
    assert got.component_id[got.index < 3000].eq(0).all() and got.kept.sum() == 6001


def test_embeddings_tiers(spark, monkeypatch):
    for name, value in (("LEAF", 40), ("SPLIT", 90), ("SAMPLE", 64), ("PIECE", 500)):  # four levels a tier
        monkeypatch.setattr(embedding_dedup, name, value)
    rng = np.random.default_rng(12)
    x = rng.standard_normal((6000, 32))
    x[3000:4500] = x[:1500] + rng.standard_normal((1500, 32)) * 0.15
    x = x.astype(np.float32)
    df = spark.createDataFrame(pa.table({"vec_id": np.arange(len(x)), "embedding": pa.array(list(x), pa.list_(pa.float32())), "label": np.ones(len(x), np.int32)}))
    nodes = df.selectExpr("vec_id AS node", "7L AS kind", "embedding")
    margin = embedding_dedup.SPILL * math.sqrt(2 - 2 * 0.98)
    sizes = embedding_dedup.forest(spark, nodes, margin, 7).groupBy("leaf").count().toPandas()
    assert sizes["count"].max() <= 90 and len(sizes) > 600  # 16 leaves a tree at most in a single tier
    got = embedding_dedup.embedding_groups(spark, df).toPandas().set_index("vec_id").sort_index()
    x = x.astype(float)
    x /= np.linalg.norm(x, axis=1, keepdims=True)
    want = (x @ x.T >= 0.98).sum(axis=1) - 1
    assert 500 < want.sum() < 3000 and (got.n_links.to_numpy() == want).all()


# 7 -------------------------------------------------------------------------------------------------------------------
def plain_removal(rows, size=100):
    """By (doc_id, CRC-32, text): bytes, removed bytes, spans, digest of the rest."""
    low = -(1 << 63)
    seen, out = set(), {}
    keys = {((low if i is None else i), zlib.crc32((t or "").encode()), t or "") for i, t in rows}
    for key in sorted(keys):
        b = key[2].encode()
        gone = np.zeros(len(b), bool)
        for p in range(len(b) - size + 1):
            if b[p : p + size] in seen:
                gone[p : p + size] = True
            seen.add(b[p : p + size])
        kept = bytes(np.frombuffer(b, np.uint8)[~gone])
        out[key] = (len(b), int(gone.sum()), int((np.diff(np.r_[0, gone.astype(int)]) == 1).sum()), hashlib.sha256(kept).hexdigest())
    return sorted(((i, *out[(low if i is None else i), zlib.crc32((t or "").encode()), t or ""]) for i, t in rows), key=str)


def test_suffix_dedup(spark, docs, rows):
    rng = random.Random(9)
    more = [(2, "another text of id 2 " * 12)]
    passage = "".join(rng.choice("abcde fgh") for _ in range(260))
    for i in range(100, 130):
        cut = rng.randrange(0, 200)
        more.append((i, "".join(rng.choice("uvw xyz") for _ in range(rng.randrange(0, 250))) + passage[cut : cut + rng.randrange(95, 140)]
                     + "".join(rng.choice("klm ") for _ in range(50))))
    df = docs.unionByName(spark.createDataFrame(more, "doc_id long, text string"), True)
    got = pairs_of(suffix_dedup.suffix_dedup(spark, df), "doc_id", "n_bytes", "n_removed", "n_spans", "kept_sha256")
    assert got == plain_removal(rows + more)


def test_suffix_dedup_repeated_rows(spark):
    rng = random.Random(10)
    first, other = ("".join(rng.choice("abcde fgh") for _ in range(400)) for _ in range(2))
    rows = [(1, first), (1, first), (1, other), (2, "x" + first[50:300] + other[:150]), (None, other[200:]), (None, other[200:]),
            (3, "short"), (3, "short"), (4, None), (4, None)]
    df = spark.createDataFrame(rows, "doc_id long, text string")
    for parts in (1, 5):
        got = pairs_of(suffix_dedup.suffix_dedup(spark, df.repartition(parts)), "doc_id", "n_bytes", "n_removed", "n_spans", "kept_sha256")
        assert got == plain_removal(rows)


def test_suffix_dedup_text_and_empty(spark, empty):
    text = "".join(chr(0xC0 + i % 40) for i in range(200))
    df = spark.createDataFrame([(1, text), (2, "x" + text), (3, None)], "doc_id int, text string")
    got = {r.doc_id: r.kept_text for r in suffix_dedup.suffix_dedup(spark, df).collect()}
    assert got[2] == "x" and got[3] is None and len(got[1]) < 200
    assert suffix_dedup.suffix_dedup(spark, empty).count() == 0


# 8 -------------------------------------------------------------------------------------------------------------------
def plain_leaks(docs, items, per_cent=80):
    cut = lambda t: re.findall(r"[^\W_]+", (t or "").lower())
    out = {}
    for item, text in items:
        own = cut(text)
        k = min(5, len(own))
        if not own:
            continue
        want = Counter(zip(*(own[i:] for i in range(k))))
        for doc, body in docs:
            words = cut(body)
            for s in range(max(1, len(words) - len(own) + 1)):
                have = Counter(zip(*(words[s : s + len(own)][i:] for i in range(k))))
                both, either = sum((want & have).values()), sum((want | have).values())
                if 100 * both >= per_cent * either:
                    out[doc, item] = max(out.get((doc, item), (0, 0)), (both / either, -s))
    return sorted((d, i, round(x, 9), -s) for (d, i), (x, s) in out.items())


def test_decontaminate_long_item_and_short_documents(spark):
    rng = random.Random(9)
    word = lambda: "q" + "".join(rng.choice("abcdefghij") for _ in range(5))
    long = [word() for _ in range(17_000)]
    items = [(0, " ".join(long))] + [(i, " ".join(word() for _ in range(9))) for i in range(1, 301)]
    found = [(1000, "before " + " ".join(long[:9000] + [word()] + long[9000:]) + " after"), (1001, " ".join(long[:12_000]))]
    # 8 of an item's 9 words: 4 of 5 shingles, a similarity of exactly 0.8
    found += [(i, " ".join(t.split()[i % 2:][:8])) for i, t in items[1:]] + [(i + 500, " ".join(t.split()[:7])) for i, t in items[1:]]
    df = spark.createDataFrame(found, "doc_id long, text string")
    got = decontaminate.contaminated(spark, df, spark.createDataFrame(items, "item_id long, text string")).collect()
    assert {(r.doc_id, r.item_id) for r in got} == {(1000, 0)} | {(i, i) for i in range(1, 301)}
    assert all(abs(r.similarity - 0.8) < 1e-12 for r in got if r.item_id)


def test_decontaminate(spark, docs, rows):
    rng = random.Random(4)
    word = lambda: "q" + "".join(rng.choice("abcdefg") for _ in range(4))
    items = [(i, " ".join(word() for _ in range(rng.randrange(20, 60)))) for i in range(20)] + [(90, "Tiny pair"), (91, "solo"), (92, None), (93, "..."), (94, "a a a a a a a a a a")]
    found = []
    for i in range(150):
        words = items[i % 20][1].split()
        for _ in range(rng.randrange(0, 4)):  # edits: changed, dropped and added words
            p = rng.randrange(len(words))
            words[p : p + rng.randrange(0, 2)] = [word()] * rng.randrange(0, 2)
        found.append((1000 + i, " ".join(word() for _ in range(rng.randrange(0, 80))) + " " + ", ".join(words).title() + " " + word()))
    found += [(2000, "so TINY... pair"), (2001, "solo"), (2002, "a " * 300), (2003, items[3][1]), (2003, items[3][1])]
    df = docs.unionByName(spark.createDataFrame(found, "doc_id long, text string"), True)
    table = spark.createDataFrame([(*x, "z") for x in items], "item_id long, text string, item string")
    got = decontaminate.contaminated(spark, df, table).collect()
    got = {(r.doc_id, r.item_id): round(r.similarity, 9) for r in got}
    want = {(d, i): x for d, i, x, _ in plain_leaks(rows + found[:-1], items)}  # windows can tie at several places
    assert not set(got) - set(want) and all(got[k] == want[k] for k in got)
    missing = [want[k] for k in set(want) - set(got)]
    assert len(missing) <= 0.02 * len(want) and all(x < 0.85 for x in missing)
    assert decontaminate.contaminated(spark, df, table.where("item_id < 0")).count() == 0
    assert decontaminate.contaminated(spark, df.where("doc_id < 0"), table).count() == 0


# 9 -------------------------------------------------------------------------------------------------------------------
def test_importance_resample(spark, docs, rows, empty):
    texts = [(i, f"good plain words about things {i}") for i in range(100, 200)] + [(i, f"spam $$$ ### spam !!! {i}") for i in range(200, 250)]
    labels = spark.createDataFrame([(i, 1 if i < 200 else 0) for i, _ in texts[::2]] + [(None, 1), (7, None)], "doc_id long, quality int")
    df = spark.createDataFrame(texts, "doc_id long, text string")
    got = resampling.importance_resample(spark, df, labels).collect()
    kept = {r.doc_id for r in got if r.kept}
    assert len(kept) == math.ceil(len(texts) * 50 / 75) and len([i for i in kept if i < 200]) >= 97
    rest = resampling.importance_resample(spark, docs, labels, share=0.5).collect()
    assert len(rest) == len(rows) and math.ceil(len(rows) / 2) <= sum(r.kept for r in rest) <= math.ceil(len(rows) / 2) + 1
    assert all(r.log_weight == 0 for r in rest if r.n_grams == 0)
    assert resampling.importance_resample(spark, empty, labels).count() == 0
    assert all(r.kept and r.log_weight == 0 for r in resampling.importance_resample(spark, docs, labels.where("doc_id < 0")).collect())


def test_importance_resample_counts_all_labels(spark):
    hashed = spark.range(120_000).selectExpr("id AS doc_id", "xxhash64(id) AS h")
    labels = hashed.selectExpr("doc_id", "CAST(h > 0 AS INT) AS quality")
    ids = [r.doc_id for r in hashed.orderBy("h").collect()]
    good, spam = ids[-100:], ids[:100]
    df = spark.createDataFrame([(i, f"good plain words about things {i}") for i in good] + [(i, f"spam $$$ ### spam !!! {i}") for i in spam]
                               + [(-1 - i, None) for i in range(9800)], "doc_id long, text string")
    share = labels.where("quality = 1").count() / 120_000
    got = resampling.importance_resample(spark, df, labels).collect()
    assert sum(r.kept for r in got) == math.ceil(share * 10_000)
    half = resampling.importance_resample(spark, df.where("doc_id >= 0"), labels, share=0.5).collect()
    assert len({r.doc_id for r in half if r.kept} & set(good)) >= 97


@pytest.mark.parametrize("targets", [None, 30])
def test_log_weights_equal_plain_models(spark, targets):
    texts = [(i, f"good plain words, about things {i}" if i % 3 else f"spam $$$ ### Spam !!! {i}") for i in range(90)] + [(90, None), (91, "")]
    quality = {i: int(i % 3 > 0) for i, _ in texts if i % 2} | {500: 1}
    labels = spark.createDataFrame([(i, q) for i, q in quality.items()] + [(1, 0), (None, 1)], "doc_id long, quality int")
    df = spark.createDataFrame(texts, "doc_id long, text string")
    grams = {}
    for i, t in texts:
        raw = (t or "").encode()
        grams[i] = resampling._buckets(np.frombuffer(raw, np.uint8), np.array([0, len(raw)]), resampling.Powers())[0].tolist()
    known = spark.createDataFrame([(i, q) for i, q in quality.items()], "id long, label int")
    n_good = sum(quality.values())
    good = {r.id for r in resampling.target_ids(known, n_good, targets or n_good).collect()}
    assert good == {i for i, q in quality.items() if q} if targets is None else 10 < len(good) < n_good
    raw, target = Counter(range(resampling.BUCKETS)), Counter(range(resampling.BUCKETS))
    for i in grams:
        raw.update(grams[i])
        target.update(grams[i] if i in good else [])
    weight = {b: math.log(target[b] / target.total()) - math.log(raw[b] / raw.total()) for i in grams for b in grams[i]}
    got = resampling.importance_resample(spark, df, labels, targets=targets or resampling.TARGETS).collect()
    assert {r.doc_id: r.n_grams for r in got} == {i: len(g) for i, g in grams.items()}
    assert all(abs(r.log_weight - sum(weight[b] for b in grams[r.doc_id])) < 1e-4 for r in got)


def test_kth_largest(spark):
    rng = random.Random(1)
    values = [rng.choice([1e300, -5.0, 0.1, 0.1 + 1e-17, 0.30000000000000004, 0.3, rng.random()]) for _ in range(500)]
    df = spark.createDataFrame([(v,) for v in values], "x double")
    for k in (1, 2, 250, 499, 500):
        assert resampling.kth_largest(df, "x", k) == sorted(values, reverse=True)[k - 1]
    assert resampling.kth_largest(df, "x", 501) is None


# 10 ------------------------------------------------------------------------------------------------------------------
def test_maximal_segments():
    rng = random.Random(2)
    for _ in range(200):
        s = [rng.choice([-2, -1, -1, 1, 2, 3]) for _ in range(rng.randrange(1, 25))]
        total = np.r_[0, np.cumsum(s)]
        up = [i for i, x in enumerate(s) if x > 0]
        got = toxicity.maximal_segments(up, [total[i] for i in up], [total[i + 1] for i in up])

        def best(lo, hi):  # the highest-scoring stretch, then the same left and right of it
            found = max(((total[b + 1] - total[a], a - b, -a) for a in range(lo, hi) for b in range(a, hi)), default=(0, 0, 0))
            if found[0] <= 0:
                return []
            a = -found[2]
            b = a - found[1]
            return best(lo, a) + [(a, b, found[0])] + best(b + 1, hi)

        assert sum(x[2] for x in got) == sum(x[2] for x in best(0, len(s)))
        assert max((x[2] for x in got), default=0) == max((x[2] for x in best(0, len(s))), default=0)


def test_maximal_segments_are_found_in_linear_time():
    for n in (20_000, 200_000):
        # each positive score starts lower than all before it; then one that joins them all
        before = [-2.0 * i for i in range(n)]
        start = time.process_time()
        got = toxicity.maximal_segments(list(range(n)), before, [x + 1 for x in before])
        assert len(got) == n and time.process_time() - start < 2 + n / 50_000
        assert len(toxicity.maximal_segments(list(range(n)), list(map(float, range(n))), [x + 1.0 for x in range(n)])) == 1


def test_toxicity(spark, docs, rows, empty):
    rng = random.Random(6)
    words = ["w" + "".join(rng.choice("abcdef") for _ in range(3)) for _ in range(300)]
    texts, labels = [], []
    for i in range(1000, 1800):
        body, toxic = [rng.choice(words) for _ in range(rng.randrange(20, 200))], i % 5 == 0
        for _ in range(4 * toxic):
            body.insert(rng.randrange(len(body)), rng.choice(["vile", "rotten", "nasty"]).title() + "!")
        texts.append((i, " ".join(body)))
        labels.append((i, int(toxic)))
    df = docs.unionByName(spark.createDataFrame(texts, "doc_id long, text string"), True)
    table = spark.createDataFrame(labels + [(1, None), (None, 1)], "doc_id long, toxic int")
    got = toxicity.toxicity(spark, df, table).collect()
    truth = dict(labels)
    assert len(got) == len(rows) + len(texts) and all(0 <= r.score <= 1 and r.predicted == (r.score >= 0.5) for r in got)
    assert all(r.held_out == (zlib.crc32(str(r.doc_id).encode()) % 5 == 0) for r in got if r.doc_id is not None)
    out = [r for r in got if r.held_out and r.doc_id in truth]
    assert sum(r.predicted == truth[r.doc_id] for r in out) >= 0.97 * len(out)
    assert any(r.passages for r in out if truth[r.doc_id])
    assert toxicity.toxicity(spark, empty, table).count() == 0
    same = toxicity.toxicity(spark, docs, table.where("doc_id < 0")).collect()
    assert {r.score for r in same} == {0.5}
