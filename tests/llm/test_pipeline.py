"""The corpus pipeline against plain versions of its stages, each on what the one before it kept."""

import base64
import random
import zlib

import public_tokenizers
import tiktoken

import corpus_pipeline
from tests.llm.test_operators import plain_groups, plain_leaks


def plain_near_dedup(rows):
    rows = list(dict.fromkeys(rows))
    low = {i: group for i, _, group, _ in plain_groups([(i, t) for i, (_, t) in enumerate(rows)], 5)}
    ids = {}
    for i, (doc, _) in enumerate(rows):
        ids.setdefault(low[i], []).append(doc)
    return [(doc, t) for i, (doc, t) in enumerate(rows) if doc == min((x for x in ids[low[i]] if x is not None), default=None)]


def plain_rest(rows, size=100):
    seen, out = set(), []
    for doc, t in sorted(rows, key=lambda r: (r[0] is not None, r[0] or 0)):
        b = (t or "").encode()
        gone = set()
        for p in range(len(b) - size + 1):
            if b[p : p + size] in seen:
                gone.update(range(p, p + size))
            seen.add(b[p : p + size])
        out.append((doc, None if t is None else bytes(x for p, x in enumerate(b) if p not in gone).decode("utf-8", "ignore")))
    return out


def write(tables, path):
    for name, df in tables.items():
        df.write.parquet(f"{path}/{name}.parquet")
    return str(path)


def test_pipeline_without_labels(spark, docs, rows, tmp_path):
    rng = random.Random(12)
    prose = lambda n: " ".join("".join(rng.choice("abcdefghij") for _ in range(5)) for _ in range(n))
    item, passage = prose(40), prose(60)
    more = [(100 + i, f"{prose(30)} {passage} {prose(30)}") for i in range(5)]
    more += [(110, f"{prose(20)} {item} {prose(20)}"), (111, prose(80)), (112, prose(80))]
    more += [(113, more[-1][1] + " and more")]
    path = write({
        "documents": docs.unionByName(spark.createDataFrame(more, "doc_id long, text string"), True),
        "labels": spark.createDataFrame([], "doc_id long, quality int, toxic int"),
        "benchmark": spark.createDataFrame([(1, item), (2, None)], "item_id long, text string")}, tmp_path)
    got = corpus_pipeline.run(spark, path).collect()

    want = plain_rest(plain_near_dedup(rows + more))
    leaked = {d for d, *_ in plain_leaks(want, [(1, item)])}
    assert 110 in leaked and 111 not in leaked
    with open(public_tokenizers.path(corpus_pipeline.VOCABULARY), "rb") as f:
        ranks = {base64.b64decode(k): int(v) for k, v in (line.split() for line in f if line.strip())}
    plain = tiktoken.Encoding("plain", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={})
    want = [(d, b"".join(x.to_bytes(4, "little") for x in plain.encode_ordinary(t or ""))) for d, t in want if d not in leaked]
    assert sorted(((r.doc_id, bytes(r.ids)) for r in got), key=str) == sorted(want, key=str)
    assert all(r.n_tokens == len(r.ids) // 4 for r in got)


def test_one_of_each_group_stays(spark):
    rng = random.Random(13)
    one, two, three = (" ".join("".join(rng.choice("abcdefghij") for _ in range(5)) for _ in range(60)) for _ in range(3))
    groups = [[(7, one + " x"), (7, one + " y"), (7, one + " y"), (8, one)], [(None, two + " x"), (None, two + " y"), (None, two + " y")],
              [(None, three), (7, three + " x")], [(9, None)], [(9, "")], [(None, None), (None, None)]]
    docs = spark.createDataFrame([r for g in groups for r in g], "doc_id long, text string")
    got = [(r.doc_id, r.text) for r in corpus_pipeline.near_dedup(spark, docs, "").collect()]
    want = [min(g, key=lambda r: (r[0] is None, r[0] or 0, zlib.crc32((r[1] or "").encode()))) for g in groups]
    assert sorted(got, key=str) == sorted(want, key=str)


def test_toxic_documents_go(spark, tmp_path):
    rng = random.Random(6)
    words = ["w" + "".join(rng.choice("abcdef") for _ in range(3)) for _ in range(300)]
    texts, labels = [], []
    for i in range(1000, 1800):
        body, toxic = [rng.choice(words) for _ in range(rng.randrange(20, 200))], i % 5 == 0
        for _ in range(4 * toxic):
            body.insert(rng.randrange(len(body)), rng.choice(["vile", "rotten", "nasty"]).title() + "!")
        texts.append((i, " ".join(body)))
        labels.append((i, 0, int(toxic)))
    docs = spark.createDataFrame(texts + [(1, None), (2, "")], "doc_id long, text string")
    path = write({"labels": spark.createDataFrame(labels, "doc_id long, quality int, toxic int")}, tmp_path)
    left = {r.doc_id for r in corpus_pipeline.toxic_filter(spark, docs, path).collect()}
    assert {1, 2} <= left
    assert sum((i in left) == (i % 5 != 0) for i, _ in texts) >= 0.97 * len(texts)
