"""N-gram join, components and line dedup against brute force."""

import random
from collections import defaultdict

import pytest
from plain_words import words

from daypanel.llm import components as components_module
from daypanel.llm import ngram_join
from daypanel.llm.components import components
from daypanel.llm.decontaminate import align, leaks, passages_of, words_of
from daypanel.llm.line_dedup import chunks, dedup_lines
from daypanel.llm.ngram_join import jaccard_classes


def shingle_sets(rows):
    out = {}
    for k, (_, text) in enumerate(rows):
        w = words(text)
        out[k] = {tuple(w[i : i + 5]) for i in range(max(1, len(w) - 4))} if w else set()
    return out


def brute(rows):
    """Per row its set size and the least id that it reaches."""
    sets = shingle_sets(rows)
    parent = list(range(len(rows)))

    def find(x):
        while parent[x] != x:
            x = parent[x]
        return x

    where = defaultdict(list)
    for k, s in sets.items():
        for g in s:
            where[g].append(k)
    for a, b in {(x, y) for m in where.values() for x in m for y in m if x < y}:
        both = len(sets[a] & sets[b])
        if 100 * both >= 75 * len(sets[a] | sets[b]):
            parent[max(find(a), find(b))] = min(find(a), find(b))
    groups = defaultdict(list)
    for k in range(len(rows)):
        groups[find(k)].append(rows[k][0])
    least = {g: min((i for i in ids if i is not None), default=None) for g, ids in groups.items()}
    return [(rows[k][0], len(sets[k]), least[find(k)]) for k in range(len(rows))]


def same(got, want):
    key = lambda r: tuple((x is None, x) for x in r)
    assert sorted(map(tuple, got), key=key) == sorted(want, key=key)


def edited(base, rng, share):
    return " ".join(rng.choice(["new", "other", "word"]) + str(rng.randrange(99)) if rng.random() < share else w for w in base)


def test_edge_rows(documents):
    rows = [tuple(r) for r in documents.select("doc_id", "text").collect()]
    same(jaccard_classes(documents).select("doc_id", "n_shingles", "component_id").collect(), brute(rows))


def test_group_of_near_copies(spark):
    rng = random.Random(3)
    base = [f"w{rng.randrange(400)}" for _ in range(120)]
    rows = [(k, edited(base, rng, rng.choice([0.0, 0.02, 0.05, 0.08]))) for k in range(120)]
    rows += [(1000 + k, " ".join(f"u{rng.randrange(3000)}" for _ in range(60)) + " " + " ".join(base[:40])) for k in range(60)]
    df = spark.createDataFrame(rows, "doc_id long, text string")
    same(jaccard_classes(df).select("doc_id", "n_shingles", "component_id").collect(), brute(rows))


def links_of(rows):
    """Per row the number of other sets that its set links with."""
    sets = [frozenset(s) for s in shingle_sets(rows).values()]
    other = {s: sum(1 for t in set(sets) if t and t != s and 100 * len(s & t) >= 75 * len(s | t)) if s else 0 for s in set(sets)}
    return [(rows[k][0], other[s]) for k, s in enumerate(sets)]


@pytest.mark.parametrize("block", [ngram_join.BLOCK_GRAMS, 700])
def test_all_links_are_counted(spark, monkeypatch, block):
    monkeypatch.setattr(ngram_join, "BLOCK_GRAMS", block)
    rng = random.Random(11)
    base = [f"w{rng.randrange(400)}" for _ in range(90)]
    rows = [(k, edited(base, rng, rng.choice([0.0, 0.01, 0.02, 0.04]))) for k in range(60)]
    chain = [f"c{k}" for k in range(90)]
    rows += [(100 + k, " ".join(chain[3 * k : 3 * k + 50])) for k in range(12)]
    rows += [(200, "one two"), (201, ""), (202, None), (1, rows[1][1]), (203, rows[5][1]), (None, rows[6][1])]
    got = jaccard_classes(spark.createDataFrame(rows, "doc_id long, text string"))
    same(got.select("doc_id", "n_links").collect(), links_of(rows))


def pairs_counted(spark, monkeypatch, rows):
    """The groups of the rows and the number of pairs whose overlap was counted."""
    tested, kept = [], ngram_join.cut

    def cut(df):
        out = kept(df)
        if df.columns == ["a", "b", "n_a", "n_b"]:
            tested.append(out.count())
        return out

    monkeypatch.setattr(ngram_join, "cut", cut)
    got = jaccard_classes(spark.createDataFrame(rows, "doc_id long, text string"), count_links=False).select("doc_id", "n_shingles", "component_id").collect()
    monkeypatch.setattr(ngram_join, "cut", kept)
    return got, sum(tested)


def test_pairs_of_a_group_of_near_copies(spark, monkeypatch):
    rng = random.Random(7)
    base = [f"w{rng.randrange(400)}" for _ in range(150)]
    rows = [(k, edited(base, rng, 0.015)) for k in range(320)]
    got, tested = pairs_counted(spark, monkeypatch, rows)
    same(got, brute(rows))
    assert tested <= 4 * len(rows)


def test_no_documents(empty):
    assert jaccard_classes(empty).collect() == []


def test_components_of_a_path(spark):
    links = spark.createDataFrame([(k, k + 1) for k in range(1, 40)] + [(100, 101), (101, 100)], "a long, b long")
    got = {r.node: r.comp for r in components(links).collect()}
    assert got == {k: 1 for k in range(1, 41)} | {100: 100, 101: 100}


def test_rounds_of_a_path_of_shuffled_names(spark, monkeypatch):
    path = random.Random(4).sample(range(10**6), 600)
    tables, kept = [], components_module.cut
    monkeypatch.setattr(components_module, "cut", lambda df: tables.append(df) or kept(df))
    got = components(spark.createDataFrame(list(zip(path, path[1:])), "a long, b long")).collect()
    assert {r.node: r.comp for r in got} == dict.fromkeys(path, min(path))
    assert len(tables) <= 14


def test_components_from_an_earlier_call(spark):
    frame = lambda rows: spark.createDataFrame(rows, "a long, b long")
    start = components(frame([(2, 3), (3, 4), (7, 8), (20, 21)]))
    got = {r.node: r.comp for r in components(frame([(8, 4), (1, 30), (21, 22), (5, 5), (3, 2)]), start).collect()}
    assert got == {2: 2, 3: 2, 4: 2, 7: 2, 8: 2, 1: 1, 30: 1, 20: 20, 21: 20, 22: 20}
    again = {r.node: r.comp for r in components(frame([(2, 4)]), start).collect()}
    assert again == {2: 2, 3: 2, 4: 2, 7: 7, 8: 7, 20: 20, 21: 20}


def test_few_pairs_are_few_files(spark, monkeypatch):
    rng = random.Random(8)
    base = [f"w{rng.randrange(400)}" for _ in range(100)]
    rows = [(k, edited(base, rng, 0.01)) for k in range(60)]
    files, kept = [], ngram_join.cut

    def cut(df):
        out = kept(df)
        if df.columns[:2] == ["a", "b"]:
            files.append(len(out.inputFiles()))
        return out

    monkeypatch.setattr(ngram_join, "cut", cut)
    settings = {"spark.sql.shuffle.partitions": "100", "spark.sql.adaptive.coalescePartitions.enabled": "false"}
    before = {k: spark.conf.get(k) for k in settings}
    try:
        for k, v in settings.items():
            spark.conf.set(k, v)
        got = jaccard_classes(spark.createDataFrame(rows, "doc_id long, text string"), count_links=False).select("doc_id", "n_shingles", "component_id").collect()
    finally:
        for k, v in before.items():
            spark.conf.set(k, v)
    same(got, brute(rows))
    assert files and max(files) <= 12


PARAGRAPH = "The first sentence of this passage is here. A second one follows it with more words. Then a third closes what many pages share in full."


def test_lines_against_brute_force(spark):
    rng = random.Random(5)
    passages = [" ".join(f"p{k}x{j}{'.' if j % 9 == 8 else ''}" for j in range(60)) for k in range(6)]
    rows = []
    for k in range(80):
        own = [" ".join(f"d{k}l{n}w{j}" for j in range(rng.randrange(2, 30))) for n in range(6)]
        own.insert(rng.randrange(6), rng.choice(passages))
        rows.append((k, "\n".join(own)))
    rows += [(200, None), (201, ""), (202, rows[0][1]), (None, rows[1][1]), (203, PARAGRAPH + "\n" + PARAGRAPH)]
    got = {r.doc_id: r.text for r in dedup_lines(spark.createDataFrame(rows, "doc_id long, text string")).collect()}
    first = {}
    order = sorted((r for r in rows if r[1] is not None), key=lambda r: (r[0] is not None, r[0] or 0))
    for doc_id, text in order:
        for a, b in sorted(chunks(text)):
            first.setdefault(text[a:b].strip(), (doc_id, a))
    for doc_id, text in rows:
        if text is None:
            assert got[doc_id] is None
            continue
        drop = [(a, b) for a, b in chunks(text) if first[text[a:b].strip()] != (doc_id, a)]
        want = "".join(c for k, c in enumerate(text) if not any(a <= k < b for a, b in drop))
        assert got[doc_id] == want
    left = [p for p in passages for d, t in got.items() if t and p in t]
    assert len(left) <= len(passages)


def test_boundaries_resist_shifts():
    text = "\n".join(" ".join(f"l{n}w{j}" for j in range(9)) for n in range(40))
    cut = lambda t: {t[a:b].strip() for a, b in chunks(t)}
    assert len(cut(text) & cut("a new line\nand another one\n" + text)) >= len(cut(text)) - 2


@pytest.mark.parametrize("n, words_each, joint", [(5, 11, "\n"), (6, 9, "\n"), (4, 15, "\n"), (3, 18, "\n"), (10, 11, "\n"), (5, 11, " "), (3, 25, " "), (2, 30, " "), (1, 60, " ")])
def test_passages_in_differing_surroundings(spark, n, words_each, joint):
    rng = random.Random(n)
    own = lambda: [" ".join(f"o{rng.randrange(10**6)}" for _ in range(rng.randrange(2, 25))) + "." for _ in range(rng.randrange(1, 6))]
    rows, passages = [], []
    for k in range(40):
        passages.append([" ".join(f"p{k}u{u}w{j}" for j in range(words_each)) + "." for u in range(n)])
        rows += [(10 * k + c, joint.join([*own(), *passages[-1], *own()])) for c in range(2)]
    got = {r.doc_id: r.text for r in dedup_lines(spark.createDataFrame(rows, "doc_id long, text string")).collect()}
    for k, passage in enumerate(passages):
        assert got[10 * k] == rows[2 * k][1] and not any(unit in got[10 * k + 1] for unit in passage)
        assert all(unit in got[10 * k + 1] for unit in rows[2 * k + 1][1].replace("\n", " ").split(". ") if not unit.startswith("p"))


def test_lines_edge_rows(documents, empty):
    rows = dedup_lines(documents)
    assert rows.columns == ["doc_id", "text", "source", "node", "n", "key", "count", "n_removed", "chars_removed"]
    assert rows.count() == documents.count() and dedup_lines(empty).count() == 0
    assert {r.doc_id for r in rows.where("n_removed > 0").collect()} == {2}


def brute_align(a, b):
    h = [[0] * (len(b) + 1) for _ in range(len(a) + 1)]
    for i in range(len(a)):
        for j in range(len(b)):
            h[i + 1][j + 1] = max(0, h[i][j] + (2 if a[i] == b[j] else -1), h[i][j + 1] - 1, h[i + 1][j] - 1)
    return max(map(max, h))


def test_alignment_scores():
    import numpy as np

    rng = random.Random(2)
    for _ in range(60):
        a, b = ([rng.randrange(4) for _ in range(rng.randrange(1, 14))] for _ in "ab")
        score, equal, start, stop = align(np.array(a), np.array(b))
        assert score == brute_align(a, b) and 0 <= start <= stop <= len(b) and equal <= stop - start


@pytest.fixture(scope="module")
def benchmark_items(spark):
    rng = random.Random(9)
    items = [(k, " ".join(f"q{rng.randrange(5000)}" for _ in range(rng.randrange(13, 60)))) for k in range(30)]
    return items + [(90, None), (91, " "), (92, "short item")], rng


def test_leaks(spark, benchmark_items):
    items, rng = benchmark_items
    rows, want = [], set()
    for k in range(60):
        body = [f"d{rng.randrange(9000)}" for _ in range(200)]
        if k < 30:
            passage = items[k][1].split()
            if k % 3 == 1:
                passage = [w if n % 9 != 4 else "edited" for n, w in enumerate(passage)]
            if k % 3 == 2:
                passage = [w.upper() + ("," if n % 5 == 0 else "") for n, w in enumerate(passage) if n % 11 != 6]
            body[50:50] = passage
            want.add((k, k))
        rows.append((k, " ".join(body)))
    rows += [(70, None), (71, ""), (None, items[0][1]), (72, "a short item of two words"), (72, "a short item of two words")]
    got = {(r.doc_id, r.item_id) for r in leaks(spark.createDataFrame(rows, "doc_id long, text string"), spark.createDataFrame(items, "item_id long, text string")).collect()}
    assert got == want | {(None, 0), (72, 92)}


@pytest.mark.parametrize("every", [4, 5])
def test_leaks_with_every_nth_word_replaced(spark, every):
    rng = random.Random(every)
    items = [(k, " ".join(f"i{k}x{j}" for j in range((30, 40, 59)[k % 3]))) for k in range(12)]
    rows = []
    for k, text in items:
        passage = [w if n % every != every - 1 else f"other{n}" for n, w in enumerate(text.split())]
        rows.append((k, " ".join(f"d{rng.randrange(9000)}" for _ in range(40)) + " " + " ".join(passage) + " tail"))
        rows.append((100 + k, text))  # an exact copy elsewhere
    got = {(r.doc_id, r.item_id) for r in leaks(spark.createDataFrame(rows, "doc_id long, text string"), spark.createDataFrame(items, "item_id long, text string")).collect()}
    assert got == {(k, k) for k in range(12)} | {(100 + k, k) for k in range(12)}


def test_long_items_leave_no_short_passage(spark):
    items = {n: [f"i{n}x{j}" for j in range(n)] for n in (8, 256, 257, 258, 512, 513, 1000)}
    benchmark = spark.createDataFrame([(n, " ".join(w)) for n, w in items.items()], "item_id long, text string")
    parts = defaultdict(list)
    for r in passages_of(benchmark).orderBy("item_id", "part").collect():
        parts[r.item_id].append(r.text.split())
    for n, w in items.items():
        assert sum(parts[n], []) == w and max(map(len, parts[n])) <= 256 and max(map(len, parts[n])) - min(map(len, parts[n])) <= 1
    rows = [(n, "a clean text " + " ".join(w[-2:]) + " that goes on") for n, w in items.items() if n > 256] + [(1, "leak " + " ".join(items[257]))]
    got = {(r.doc_id, r.item_id) for r in leaks(spark.createDataFrame(rows, "doc_id long, text string"), benchmark).collect()}
    assert got == {(1, 257)}


def test_leaks_without_rows(spark, empty, benchmark_items):
    items = spark.createDataFrame(benchmark_items[0], "item_id long, text string")
    assert leaks(empty, items).count() == 0 and leaks(spark.createDataFrame([(1, "x y z")], "doc_id long, text string"), items.where("false")).count() == 0


def test_words_ignore_case_and_punctuation():
    assert words_of("A-b, «C».") == [b"ab", "«c»".encode()]
