"""Importance resampling, Merkle manifest and sharding against brute force."""

import hashlib
import math
import random
import zlib
from collections import Counter

import numpy as np
import pytest
from pyspark.sql import functions as F

from daypanel.llm import importance, merkle, sharding


def key(row):
    return tuple((x is None, x) for x in row)


def same(got, want):
    assert sorted(map(tuple, got), key=key) == sorted(want, key=key)


# importance resampling


def words11(text):
    folded = "".join(c.lower() if "A" <= c <= "Z" else c if c.isascii() and c.isalnum() or ord(c) > 0x7F else " " for c in text or "")
    return [w for w in folded.split(" ") if w]


def grams(text, n_min, n_max):
    w = words11(text)
    return [" ".join(w[i : i + n]) for n in range(n_min, n_max + 1) for i in range(len(w) - n + 1)]


def brute_resample(docs, target, n_min, n_max, n_buckets, min_words, percent, seed):
    bucket = lambda g: zlib.crc32(g.encode("utf-8")) % n_buckets
    s, t = (Counter(bucket(g) for x in texts for g in grams(x, n_min, n_max)) for texts in ([x for _, x in docs], target))
    total_s, total_t = sum(s.values()), sum(t.values())
    gain = {b: math.floor(1000 * math.log((t[b] + 1) * (total_s + n_buckets) / ((s[b] + 1) * (total_t + n_buckets)))) for b in range(n_buckets)}
    rows = []
    for doc_id, text in docs:
        held = [gain[bucket(g)] for g in grams(text, n_min, n_max)]
        weight = sum(held) // len(held) if held else 0
        h = int(hashlib.sha256(f"{seed}:{'' if doc_id is None else doc_id}".encode()).hexdigest()[:8], 16)
        rows.append([doc_id, len(held), weight, weight + math.floor(-1000 * math.log(-math.log((h + 0.5) / 4294967296))), None, len(words11(text))])
    able = sorted((r for r in rows if r[5] >= min_words), key=lambda r: (-r[3], r[0] is None, r[0]))
    for k, r in enumerate(able[: percent * len(able) // 100]):
        r[4] = k + 1
    return [tuple(r[:5]) for r in rows]


def test_spans_are_all_runs_of_words():
    patterns = [importance.span_pattern(n) for n in (1, 2, 3)]
    for text in (None, "", " .,;", "One", "a-b  C\n\td", "x" * 50 + " é\x85è\x00ü Ünï 7", "Z[`{@ aZ09/:"):
        want = [g.encode() for g in grams(text, 1, 3)]
        assert list(importance.spans(importance.collapse(text), patterns)) == want


@pytest.mark.parametrize(("n_min", "n_max", "n_buckets"), [(1, 1, 10_000), (1, 3, 97), (2, 2, 1)])
def test_resampling_against_brute_force(spark, n_min, n_max, n_buckets):
    rng = random.Random(5)
    vocabulary = [f"w{k}" for k in range(60)] + ["Größe", "naïve", "A-b", "x\x85y"]
    docs = [(k, " ".join(rng.choices(vocabulary, k=rng.randrange(60)))) for k in range(400)]
    docs += [(7, docs[7][1]), (None, "one two three four five"), (None, None), (400, None), (401, ""), (402, " ..."), (403, "long " * 30_000)]
    target = [" ".join(rng.choices(vocabulary[:20], k=30)) for _ in range(20)] + [None, ""]
    frame = spark.createDataFrame(docs, "doc_id long, text string").selectExpr("*", "1 as weight", "2 as place", "3 as buckets").repartition(6)
    got = importance.resample(frame, spark.createDataFrame([(x,) for x in target], "text string"), n_min, n_max, n_buckets, min_words=5, percent=30, seed=3)
    assert got.dtypes == [(c, "bigint") for c in ("doc_id", "n_features", "weight", "score", "rank")]
    same(got.collect(), brute_resample(docs, target, n_min, n_max, n_buckets, 5, 30, 3))


def test_resampling_edge_rows(spark, documents, empty):
    target = spark.createDataFrame([("word1 and word2",)], "text string")
    rows = [tuple(r) for r in documents.select("doc_id", "text").collect()]
    same(importance.resample(documents, target, percent=50).collect(), brute_resample(rows, ["word1 and word2"], 1, 1, 10_000, 20, 50, 2024))
    assert importance.resample(empty, target).count() == 0
    same(importance.resample(documents, target.where("false"), percent=50).collect(), brute_resample(rows, [], 1, 1, 10_000, 20, 50, 2024))


# Merkle manifest


def sha(*parts):
    return hashlib.sha256("".join(parts).encode()).hexdigest()


def leaf(row, text):
    values = [row["doc_id"], row["source"], row.get("lang"), row.get("n_chars"), text]
    return sha(*("-" if v is None else f"{len(str(v).encode())}:{v}" for v in values))


def brute_tree(nodes):
    layers = [nodes]
    while len(layers[-1]) > 1:
        layers.append([sha(*layers[-1][i : i + 16]) for i in range(0, len(layers[-1]), 16)])
    return layers


def path_of(layers, i):
    """(siblings left, siblings right) level by level."""
    out = []
    for layer in layers[:-1]:
        start = i - i % 16
        out.append((layer[start:i], layer[i + 1 : start + 16]))
        i //= 16
    return out


def lowered(text):
    return None if text is None else "".join(c.lower() if "A" <= c <= "Z" else c for c in text)


def brute_manifest(rows):
    sources = sorted({r["source"] for r in rows}, key=lambda s: (s is not None, (s or "").encode()))
    groups, trees = {}, {}
    for s in sources:
        held = [(r["doc_id"], leaf(r, r["text"]), r) for r in rows if r["source"] == s]
        groups[s] = sorted(held, key=lambda x: (x[0] is not None, x[0], x[1]))
        trees[s] = brute_tree([x[1] for x in groups[s]])
    top = brute_tree([trees[s][-1][0] for s in sources])
    root, out = top[-1][0], []
    for k, s in enumerate(sources):
        for i, (doc_id, own, r) in enumerate(groups[s]):
            path = path_of(trees[s], i) + path_of(top, k)
            node = leaf(r, lowered(r["text"])) if doc_id is not None and zlib.crc32(str(doc_id).encode()) % 5 == 0 else own
            for left, right in path:
                node = sha(*left, node, *right)
            out.append((doc_id, own, trees[s][-1][0], root, sha(*(x for left, right in path for x in left + right)), node, node == root))
    return out


def check_manifest(spark, rows, schema="doc_id long, source string, lang string, n_chars long, text string"):
    frame = spark.createDataFrame([tuple(r[c] for c in ("doc_id", "source", "lang", "n_chars", "text")) for r in rows], schema).selectExpr("*", "1 as tree", "2 as place", "3 as chunk", "4 as digest").repartition(5)
    got = merkle.verify(frame, merkle.tampered(F.col("doc_id"), F.col("text")))
    assert got.columns == ["doc_id", "leaf", "subroot", "root", "proof_sha256", "folded_root", "source", "verified"]
    same(got.drop("source").collect(), brute_manifest(rows))


def document(k, source, text="Some Text"):
    return {"doc_id": k, "source": source, "lang": None if k is not None and k % 3 == 0 else "de", "n_chars": len(text) if text else None, "text": text}


@pytest.mark.parametrize("sizes", [{"a": 1}, {"a": 16}, {"a": 17, None: 1, "é": 257}, {f"s{k}": 1 + k % 3 for k in range(40)}])
def test_manifest_against_brute_force(spark, sizes):
    ids = iter(range(10_000))
    rows = [document(next(ids), s, f"Text {k}" if k % 4 else "no capitals") for s, n in sizes.items() for k in range(n)]
    rows.append(document(10_001, next(iter(sizes)), None))
    check_manifest(spark, rows)


def test_manifest_over_several_chunks(spark):
    rows = [document(k, "hot", f"Text {k}") for k in range(4_096 * 3 + 5)] + [document(20_000 + k, "small") for k in range(30)]
    check_manifest(spark, rows)


def test_manifest_edge_rows(spark, documents, empty):
    rows = [document(None, None, None), document(None, "a", ""), document(None, "a", "X"), document(5, None), document(5, None), document(7, "a", "long É " * 50_000)]
    check_manifest(spark, rows)
    none = merkle.verify(empty.selectExpr("*", "'x' as lang", "1 as n_chars"))
    assert none.count() == 0
    whole = merkle.verify(documents.selectExpr("*", "'x' as lang", "1 as n_chars"))
    assert whole.count() == documents.count() and whole.where("not verified").count() == 0


def test_states_resume_without_left_siblings():
    nodes = [sha(str(k)).encode() for k in range(300)]
    tree = merkle.Subtree(nodes, True)
    for i in (0, 15, 16, 299):
        swapped = merkle.Subtree([*nodes[:i], b"0" * 64, *nodes[i + 1 :]], True).root
        assert tree.fold(i, b"0" * 64, [right for _, right in tree.siblings(i)]) == swapped


# sharding


def test_hypergeometric_draws():
    for good, bad, n in ((3, 7, 4), (50, 20, 30), (1, 1, 1), (5, 0, 3), (0, 5, 3), (6, 6, 12)):
        u = (np.arange(20_000) + 0.5) / 20_000
        got = Counter(sharding.hypergeometric(good, bad, n, x) for x in u)
        for k, m in got.items():
            p = math.comb(good, k) * math.comb(bad, n - k) / math.comb(good + bad, n)
            assert abs(m / 20_000 - p) < 2e-4
    assert sharding.hypergeometric(10**13, 15 * 10**13, 10**6, 0.5) in range(62_400, 62_600)


def test_matrix_has_exact_margins():
    rows, shards = [5, 0, 17, 100, 1], [31, 31, 31, 30]
    m = sharding.communication_matrix(rows, shards)
    assert m.sum(axis=1).tolist() == rows and m.sum(axis=0).tolist() == shards and (m >= 0).all()


def check_shards(rows, n):
    groups = {}
    for r in rows:
        groups.setdefault(r.shard, []).append(r.slot)
    sizes = [len(groups.get(s, [])) for s in range(n)]
    assert sum(sizes) == len(rows) and max(sizes) - min(sizes) <= 1
    assert all(sorted(v) == list(range(len(v))) for v in groups.values())


def test_shards_of_documents(spark, documents, empty):
    rows = sharding.shard_rows(documents.selectExpr("*", "1 as part", "2 as shard", "3 as at"), 5).collect()
    check_shards(rows, 5)
    want = [(r.doc_id, 1 + len((r.text or "").encode()), None if r.text is None else zlib.crc32(r.text.encode()), "rows", None) for r in documents.collect()]
    same([(r.doc_id, r["size"], r.text_crc32, r.law, r.grown_shard) for r in rows], want)
    assert sharding.shard_rows(empty).count() == 0


def test_deal_is_uniform_and_repeats(spark):
    docs = spark.range(0, 8_000, 1, 7).selectExpr("id as doc_id", "'same' as text")
    one, two = (sorted(tuple(r) for r in sharding.shard_rows(docs, seed=4).select("doc_id", "shard", "slot").collect()) for _ in range(2))
    assert one == two
    check_shards(sharding.shard_rows(docs).collect(), 16)
    first_half = Counter(s for i, s, _ in one if i < 4_000)
    assert all(180 < first_half[s] < 320 for s in range(16))
    slots = np.array([[i, s * 500 + slot] for i, s, slot in one])
    assert abs(np.corrcoef(slots.T)[0, 1]) < 0.05
    # neighbours in a partition are no neighbours in a shard
    by_place = {(s, slot): i for i, s, slot in one}
    assert sum(by_place.get((s, slot + 1)) == i + 1 for i, s, slot in one) < 10
