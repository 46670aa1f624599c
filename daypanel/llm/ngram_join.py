"""N-gram Jaccard self-join by vertical partitioning of the n-gram order."""

from __future__ import annotations

import hashlib
import zlib
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from daypanel.llm.base import cut, gathered, shingles
from daypanel.llm.components import components

#: Parts that the global n-gram order is cut into.
FRAGMENTS = 4
#: 64-bit words of the parity bitmap of a small set, and of its folded form; a larger set has two bits per n-gram at least.
PARITY, FOLDED = 32, 8
#: Counters of the corpus that give n-grams their place in the global order, and counters of a row that carries them: 16 MB in all.
COUNTERS, PER_ROW = 1 << 22, 1 << 16
#: Most classes whose ids are broadcast to find their texts; beyond it the texts are shuffled.
BROADCAST_ROWS = 200_000
#: How many times as many classes of an n-gram each round pairs with its others as the round before.
RANKS = 8
#: N-grams of the sets of a block, about; links of a component are counted by pairs of its blocks.
BLOCK_GRAMS = 1 << 17
#: Rows of numbers that a fragment of a set counts for when tasks are dealt.
WIDE = 10
_ROWS = 200_000


def _class_of(grams: np.ndarray) -> int:
    return int.from_bytes(hashlib.blake2b(grams.tobytes(), digest_size=8).digest(), "little", signed=True)


def _parity(grams: np.ndarray) -> np.ndarray:
    """Bit k tells whether an odd number of the n-grams has hash k; the number of bits is a power of two."""
    size = 64 * PARITY
    while size < 2 * len(grams):
        size *= 2
    bits = np.bincount((grams & np.uint64(size - 1)).astype(np.int64), minlength=size) & 1
    return np.packbits(bits.astype(np.uint8), bitorder="little").view(np.int64)


def _longs(values) -> pa.Array:
    return pa.array(values, pa.int64())


def _slot(grams: np.ndarray) -> np.ndarray:
    return (grams >> np.uint64(20)).astype(np.int64) & (COUNTERS - 1)


def _sets(words: int):
    """Per text its set's size, class and bitmap; at the end of a partition the counts of its n-grams, packed."""
    names = ["doc_id", "key", "n", "node", "parity", "part", "counts"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counts = np.zeros(COUNTERS, dtype=np.uint32)  # of one partition
        for batch in batches:
            n, node, parity, seen = [], [], [], {}
            for text in batch.column("text").to_pylist():
                grams = shingles(text, words)
                n.append(len(grams))
                node.append(_class_of(grams) if len(grams) else None)
                parity.append(_parity(grams) if len(grams) else None)
                if len(grams):
                    seen[node[-1]] = grams
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id"), batch.column("key"), _longs(n), _longs(node), pa.array(parity, pa.list_(pa.int64())), pa.nulls(len(n), pa.int32()), pa.nulls(len(n), pa.binary())], names
            )
            if seen:
                slots, times = np.unique(_slot(np.concatenate(list(seen.values()))), return_counts=True)
                counts[slots] += times.astype(np.uint32)
        parts = [k for k in range(COUNTERS // PER_ROW) if counts[k * PER_ROW : (k + 1) * PER_ROW].any()]
        if parts:
            packed = [zlib.compress(counts[k * PER_ROW : (k + 1) * PER_ROW].tobytes(), 1) for k in parts]
            none = pa.nulls(len(parts), pa.int64())
            yield pa.RecordBatch.from_arrays([none, none, none, none, pa.nulls(len(parts), pa.list_(pa.int64())), pa.array(parts, pa.int32()), pa.array(packed, pa.binary())], names)

    return run


def _totals(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The sums of packed counts by their part of the counters; one sum is held at a time per part."""
    sums: dict[int, np.ndarray] = {}
    for batch in batches:
        for part, counts in zip(batch.column("part").to_pylist(), batch.column("counts").to_pylist()):
            more = np.frombuffer(zlib.decompress(counts), dtype=np.uint32).astype(np.int64)
            sums[part] = sums[part] + more if part in sums else more
    if sums:
        yield pa.RecordBatch.from_arrays([pa.array(list(sums), pa.int32()), pa.array([zlib.compress(np.minimum(v, 0xFFFFFFFF).astype(np.uint32).tobytes(), 1) for v in sums.values()], pa.binary())], ["part", "counts"])


def _order(found: DataFrame) -> np.ndarray:
    """Per counter how many n-grams of all documents it has met; ``COUNTERS`` numbers whatever the input's size."""
    counts = np.zeros(COUNTERS, dtype=np.uint32)
    packed = found.where("part is not null").select("part", "counts").repartition("part").mapInArrow(_totals, "part int, counts binary")
    for row in packed.collect():  # 64 rows; an iterator would run a job per partition
        counts[row.part * PER_ROW : (row.part + 1) * PER_ROW] = np.frombuffer(zlib.decompress(row.counts), dtype=np.uint32)
    return counts


def _prefixes(words: int, percent: int, order):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counts = order.value
        held, rows = [], 0

        def out() -> pa.RecordBatch:
            return pa.RecordBatch.from_arrays([pa.array(np.concatenate([h[k] for h in held])) for k in range(3)], ["gram", "place", "node"])

        for batch in batches:
            seen = set()
            for text in batch.column("text").to_pylist():
                grams = shingles(text, words)
                n = len(grams)
                if not n or (node := _class_of(grams)) in seen:
                    continue
                seen.add(node)
                grams = grams[np.argsort(counts[_slot(grams)], kind="stable")]  # ties stay in the order of their hash
                grams = grams[: n + percent * -n // 100 + 1]  # n - ceil(n * percent / 100) + 1
                held.append((grams.view(np.int64), (n << 32) + np.arange(len(grams)), np.full(len(grams), node, np.int64)))
                rows += len(grams)
                if rows >= _ROWS:
                    yield out()
                    held, rows = [], 0
        if held:
            yield out()

    return run


def _fragments(words: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        edges = [np.uint64(k * (1 << 64) // FRAGMENTS) for k in range(1, FRAGMENTS)]
        for batch in batches:
            for node, text in zip(batch.column("node").to_pylist(), batch.column("text").to_pylist()):
                grams = shingles(text, words)
                if len(grams) and _class_of(grams) == node:
                    parts = np.split(grams.view(np.int64), np.searchsorted(grams, edges))
                    yield pa.RecordBatch.from_arrays([_longs([node] * FRAGMENTS), pa.array(range(FRAGMENTS), pa.int32()), pa.array(parts, pa.list_(pa.int64()))], ["node", "fragment", "part"])

    return run


def _whole(words: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for node, text in zip(batch.column("node").to_pylist(), batch.column("text").to_pylist()):
                grams = shingles(text, words)
                if len(grams) and _class_of(grams) == node:
                    yield pa.RecordBatch.from_arrays([_longs([node]), pa.array([grams.view(np.int64)], pa.list_(pa.int64()))], ["node", "grams"])

    return run


def _block_links(percent: int):
    """Per set of two blocks of a component the number of sets of the other block (or of its own, if both are the same) that it links with."""

    def run(key: tuple, sets: pd.DataFrame) -> pd.DataFrame:
        _, i, j = key
        size = sets["grams"].map(len).to_numpy()
        codes = np.unique(np.concatenate(sets["grams"].to_numpy()), return_inverse=True)[1]
        starts = np.concatenate([[0], np.cumsum(size)])
        block, links = sets["block"].to_numpy(), np.zeros(len(sets), dtype=np.int64)
        others = np.flatnonzero(block == j)
        held = np.concatenate([codes[starts[k] : starts[k + 1]] for k in others]) if len(others) else codes[:0]
        first = np.concatenate([[0], np.cumsum(size[others])[:-1]])
        for k in np.flatnonzero(block == i) if len(others) else ():
            has = np.zeros(codes.max() + 1, dtype=np.int64)
            has[codes[starts[k] : starts[k + 1]]] = 1
            both = np.add.reduceat(has[held], first)
            linked = (100 * both >= percent * (size[k] + size[others] - both)) & (others != k)
            links[k] += linked.sum()
            if i != j:
                links[others] += linked
        return pd.DataFrame({"node": sets["node"], "n_links": links})

    return run


def _folded(parity: Column, words: Column) -> Column:
    """A bitmap of ``words`` or twice as many words, as one of ``words``."""
    halves = F.zip_with(F.slice(parity, F.lit(1), words), F.slice(parity, words + 1, words), lambda x, y: x.bitwiseXOR(y))
    return F.when(F.size(parity) > words, halves).otherwise(parity)


def _differ(columns: list[tuple[Column, Column]]) -> Column:
    total = F.lit(0)
    for x, y in columns:
        total = total + F.bit_count(x.bitwiseXOR(y))
    return total


def _similar_size(percent: int, n: str, m: str) -> Column:
    """False where one is null; greatest() and least() skip nulls."""
    return F.col(n).isNotNull() & F.col(m).isNotNull() & (F.lit(percent) * F.greatest(n, m) <= 100 * F.least(n, m))


def jaccard_classes(docs: DataFrame, words: int = 5, percent: int = 75, count_links: bool = True) -> DataFrame:
    """Classes of documents linked by n-gram sets with ``100 * intersection >= percent * union``.

    Takes columns ``doc_id`` and ``text`` and returns per row ``doc_id``, ``n_shingles``, ``component_id``
    (the smallest ``doc_id`` reachable by links), ``n_links`` (how many other sets its set links with;
    left out without ``count_links``), ``group`` (a number of the component, null without a set) and ``text_key`` (xxhash64 of the text).

    All distinct n-grams have one global order, the rare ones first: by the count of the counter that a part of their 64-bit hash
    names, summed over all documents, and then by the hash. Equal
    sets become one class, named by a 64-bit hash of the set. Of each class the prefix is taken that every partner must meet
    (``n - ceil(n * percent / 100) + 1`` n-grams); classes of similar size that meet in an n-gram are
    candidates. A parity bitmap (2,048 bits, two per n-gram for large sets) bounds the size of the symmetric difference from below and
    ends most of them. For the others the order is cut into fragments; each fragment is joined and its overlap counted
    by itself, and the partial counts are summed per pair.

    Groups aren't expanded into all pairs. The classes of an n-gram are first paired with their
    neighbour in size. In n-grams that still hold several components the classes are then ranked by how many others they meet in all
    their n-grams, and rounds pair the first of each n-gram, then the next 7, the next 56 and so on, with all that rank after them in it and
    are still in another component, under the bounds of size, of the n-grams
    that follow the shared one in the order (a linked pair holds them at its first shared n-gram) and of a folded bitmap. Every round merges the components that it links, so
    that the many links of a group need no test; the rounds end when each class has met all others or no n-gram holds several components. What still grows with the square of
    a group are pairs that pass the bounds and don't link. A pair of classes in one component needs no test for the components. Links are between classes of one
    component, so they are counted there: a component whose pairs weren't all verified is dealt into blocks of classes by a hash, and each
    pair of blocks is compared in one task, which returns a number per class and no pairs.

    Empty, blank or null texts have no set and are linked with nothing; texts under ``words`` words
    are one n-gram. Repeated rows come back as often as they came. Rows with a null ``doc_id`` are
    kept; such an id names a component only if the component has no other. Extra columns are ignored; no rows
    give no rows.
    """
    if not 50 <= percent <= 100:
        raise ValueError("percent must be from 50 to 100")  # bitmaps of linked sets are one doubling apart at most
    spark = docs.sparkSession
    docs = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text", F.xxhash64("text").alias("key"))
    found = cut(docs.mapInArrow(_sets(words), "doc_id long, key long, n long, node long, parity array<long>, part int, counts binary"))
    classes = cut(
        found.where("node is not null").groupBy("node")
        .agg(F.min(F.struct("doc_id", "key")).alias("rep"), F.min("doc_id").alias("doc_id"), F.first("n").alias("n"), F.first("parity").alias("parity"))
    )
    order = spark.sparkContext.broadcast(_order(found))

    per_gram = Window.partitionBy("gram").orderBy("place", "node")  # by size: a place is n * 2^32 + the position in the order
    prefix = docs.select("text").mapInArrow(_prefixes(words, percent, order), "gram long, place long, node long")
    once = prefix.withColumn("last", F.lag("node").over(per_gram)).where("last is null or last <> node").selectExpr("gram", "place", "node", "int(shiftright(place, 32)) as n", "int(place & 4294967295) as position")
    near = once.withColumns({"before": F.lag("node").over(per_gram), "before_n": F.lag("n").over(per_gram), "after_n": F.lead("n").over(per_gram)})
    near = near.withColumns({"before": F.when(_similar_size(percent, "n", "before_n"), F.col("before")), "joins": _similar_size(percent, "n", "after_n")})
    shared = cut(near.where("before is not null or joins").select("gram", "n", "position", "node", "before"))

    def pairs(x: str, y: str) -> list[Column]:
        return [F.least(x, y).alias("a"), F.greatest(x, y).alias("b")]

    def verified(candidates: DataFrame, about: int) -> DataFrame:
        """The pairs ``a`` < ``b`` among the candidates that link, written; ``about`` is the number of rows that the candidates were made of."""
        candidates = cut(gathered(candidates, about))
        tested = candidates.count()
        known = classes
        if 2 * tested <= BROADCAST_ROWS:  # else about all classes are needed
            known = classes.join(F.broadcast(candidates.select(F.explode(F.array("a", "b")).alias("node")).distinct()), "node", "left_semi")
        sides = [known.select(F.col("node").alias(s), F.col("n").alias(f"n_{s}"), F.col("parity").alias(f"parity_{s}")) for s in "ab"]
        size = F.least(F.size("parity_a"), F.size("parity_b"))  # sets of similar size are one doubling apart at most
        differ = F.aggregate(F.zip_with(_folded(F.col("parity_a"), size), _folded(F.col("parity_b"), size), lambda x, y: F.bit_count(x.bitwiseXOR(y))), F.lit(0), lambda s, x: s + x)
        # linked sets differ in at most (100 - percent) / (100 + percent) of n_a + n_b n-grams, and in no fewer than in bits
        left = candidates.join(sides[0], "a").join(sides[1], "b").where(differ * (100 + percent) <= F.expr("n_a + n_b") * (100 - percent))
        left = cut(gathered(left.select("a", "b", "n_a", "n_b"), tested))
        if left.isEmpty():
            return left.select("a", "b")
        nodes = left.select(F.explode(F.array("a", "b")).alias("node")).distinct().join(classes.select("node", "rep"), "node")
        nodes = cut(nodes.select("node", F.col("rep.doc_id").alias("rep_id"), F.col("rep.key").alias("rep_key")))
        sets = nodes.count()
        if sets <= BROADCAST_ROWS:
            nodes = F.broadcast(nodes)
        texts = docs.join(nodes, (F.col("key") == F.col("rep_key")) & F.col("doc_id").eqNullSafe(F.col("rep_id"))).select("node", "text")
        parts = texts.mapInArrow(_fragments(words), "node long, fragment int, part array<long>")
        parts = cut(gathered(parts.groupBy("node", "fragment").agg(F.first("part").alias("part")), WIDE * FRAGMENTS * sets))
        each = left.select("a", "b", "n_a", "n_b", F.explode(F.sequence(F.lit(0), F.lit(FRAGMENTS - 1))).alias("fragment"))
        each = each.join(parts.select(F.col("node").alias("a"), "fragment", F.col("part").alias("part_a")), ["a", "fragment"])
        each = each.join(parts.select(F.col("node").alias("b"), "fragment", F.col("part").alias("part_b")), ["b", "fragment"])
        counted = each.select("a", "b", "n_a", "n_b", F.size(F.array_intersect("part_a", "part_b")).alias("overlap"))
        total = counted.groupBy("a", "b").agg(F.sum("overlap").alias("overlap"), F.first("n_a").alias("n_a"), F.first("n_b").alias("n_b"))
        total = total.where(F.expr(f"100 * overlap >= {percent} * (n_a + n_b - overlap)"))
        return cut(gathered(total.select("a", "b"), FRAGMENTS * tested))

    def opened(rows: DataFrame, comps: DataFrame) -> DataFrame:
        """The rows of n-grams that still hold several components."""
        rows = rows.join(comps, "node", "left").withColumn("comp", F.coalesce("comp", "node"))
        several = rows.groupBy("gram").agg(F.min("comp").alias("least"), F.max("comp").alias("most")).where("least <> most").select("gram")
        return rows.join(several, "gram")

    held = shared.count()
    links = verified(shared.where("before is not null").select(*pairs("before", "node")).distinct(), held)
    comps = components(links)
    rows = cut(gathered(opened(shared.select("node", "gram", "n", "position"), comps), held))
    # how many rows of others a class meets in its n-grams: most for the least edited of a group of near copies
    meets = rows.join(rows.groupBy("gram").agg(F.count("*").alias("held")), "gram").groupBy("node").agg(F.sum("held").alias("meets"))
    fold = [F.expr(f"aggregate(filter(parity, (x, i) -> i % {FOLDED} = {k}), 0L, (s, x) -> s ^ x)").alias(f"p{k}") for k in range(FOLDED)]
    met = classes.join(meets, "node").select("node", "meets", *fold)
    rank = F.row_number().over(Window.partitionBy("gram").orderBy(F.desc("meets"), "node")).alias("rank")
    rows = cut(gathered(rows.join(met, "node").select("*", rank).drop("meets"), held))
    last = 1
    while held := rows.count():
        x, y = rows.where(F.col("rank") <= last).alias("x"), rows.alias("y")
        differ = _differ([(F.col(f"x.p{k}"), F.col(f"y.p{k}")) for k in range(FOLDED)])
        apart = x.join(
            y,
            (F.col("x.gram") == F.col("y.gram")) & (F.col("x.rank") < F.col("y.rank")) & (F.col("x.comp") != F.col("y.comp")) & _similar_size(percent, "x.n", "y.n")
            & (F.least(F.expr("x.n - x.position"), F.expr("y.n - y.position")) * (100 + percent) >= (F.col("x.n") + F.col("y.n")) * percent)
            & (differ * (100 + percent) <= (F.col("x.n") + F.col("y.n")) * (100 - percent)),
        )
        more = verified(apart.select(*pairs("x.node", "y.node")).distinct(), held)
        if not more.isEmpty():
            links = links.unionByName(more)
            comps = components(more, comps)
        # the first ranks have met all others of their n-grams
        rows = cut(gathered(opened(rows.where(F.col("rank") > last).drop("comp"), comps), held))
        last *= RANKS

    degree = links.select(F.explode(F.array("a", "b")).alias("node")).groupBy("node").agg(F.count("*").alias("n_links"))
    if count_links:
        inside = classes.select("node", "n", "rep").join(comps, "node")
        sizes = inside.groupBy("comp").agg(F.count("*").alias("sets"), F.sum("n").alias("grams"))
        tested = links.join(comps.withColumnRenamed("node", "a"), "a").groupBy("comp").agg(F.count("*").alias("tested"))
        untested = sizes.join(tested, "comp").where("tested < sets * (sets - 1) div 2").select("comp", F.expr(f"(grams + {BLOCK_GRAMS} - 1) div {BLOCK_GRAMS}").alias("blocks"))
        block = F.pmod(F.xxhash64("node"), "blocks").alias("block")
        members = cut(inside.join(untested, "comp").select("node", "comp", "blocks", block, F.col("rep.doc_id").alias("rep_id"), F.col("rep.key").alias("rep_key")))
        nodes = F.broadcast(members) if members.count() <= BROADCAST_ROWS else members
        texts = docs.join(nodes, (F.col("key") == F.col("rep_key")) & F.col("doc_id").eqNullSafe(F.col("rep_id"))).select("node", "text")
        # rows that repeat id and text are one set
        sets = texts.mapInArrow(_whole(words), "node long, grams array<long>").groupBy("node").agg(F.first("grams").alias("grams"))
        dealt = sets.join(members, "node").select("node", "comp", "block", "grams", F.explode(F.sequence(F.lit(0).cast("long"), F.col("blocks") - 1)).alias("other"))
        dealt = dealt.select("node", "comp", "block", "grams", F.least("block", "other").alias("i"), F.greatest("block", "other").alias("j"))
        counted = dealt.groupBy("comp", "i", "j").applyInPandas(_block_links(percent), "node long, n_links long").groupBy("node").agg(F.sum("n_links").alias("counted"))
        degree = degree.join(counted, "node", "left").select("node", F.coalesce("counted", "n_links").alias("n_links"))
    labelled = classes.select("node", "doc_id").join(comps, "node", "left").withColumn("comp", F.coalesce("comp", "node")).join(degree, "node", "left")
    least = labelled.groupBy("comp").agg(F.min("doc_id").alias("component_id"))
    named = cut(labelled.join(least, "comp").select("node", "component_id", F.coalesce("n_links", F.lit(0)).alias("n_links"), F.col("comp").alias("group")))
    rows = found.where("n is not null").select("doc_id", F.col("n").alias("n_shingles"), "node", F.col("key").alias("text_key"))
    out = rows.join(named, "node", "left").select(
        "doc_id", "n_shingles", F.coalesce("component_id", "doc_id").alias("component_id"), F.coalesce("n_links", F.lit(0)).alias("n_links"), "group", "text_key"
    )
    return out if count_links else out.drop("n_links")
