"""Benchmark passages in training documents: n-gram seeds, then Smith-Waterman alignment."""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pandas.util import hash_array
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from daypanel.llm.base import cut, gram_hashes

SEED_WORDS = 3
#: Items are compared in passages of at most so many words, and passages in blocks of about so many.
PASSAGE_WORDS, BLOCK = 256, 4000
MATCH, MISMATCH, GAP = 2, -1, -1
#: Equal words of a leak at least, or all of a shorter passage.
LEAST_EQUAL = 8
_PUNCTUATION = bytes(c for c in range(33, 127) if not chr(c).isalnum())


def words_of(text: str | None) -> list[bytes]:
    """Words in lower case (A-Z) without ASCII punctuation."""
    return (text or "").encode("utf-8", "surrogatepass").translate(None, _PUNCTUATION).lower().split()


def codes_of(text: str | None) -> np.ndarray:
    return hash_array(np.array(words_of(text), dtype=object), categorize=False)


def align(a: np.ndarray, b: np.ndarray) -> tuple[int, int, int, int]:
    """Best local alignment of two sequences: score, equal words, and its span in ``b``."""
    if not len(a) or not len(b):
        return 0, 0, 0, 0
    j = np.arange(1, len(b) + 1)
    h = np.zeros((len(a) + 1, len(b) + 1), dtype=np.int32)
    for i, code in enumerate(a):
        here = np.maximum(h[i, :-1] + np.where(b == code, MATCH, MISMATCH), h[i, 1:] + GAP)
        np.maximum(here, 0, out=here)
        # a gap in a may follow any earlier column: the running maximum of here - GAP * j
        h[i + 1, 1:] = np.maximum.accumulate(here - GAP * j) + GAP * j
    i, k = np.unravel_index(int(h.argmax()), h.shape)
    score, stop, equal = int(h[i, k]), int(k), 0
    while i > 0 and k > 0 and h[i, k] > 0:
        same = a[i - 1] == b[k - 1]
        if h[i, k] == h[i - 1, k - 1] + (MATCH if same else MISMATCH):
            equal, i, k = equal + int(same), i - 1, k - 1
        elif h[i, k] == h[i - 1, k] + GAP:
            i -= 1
        else:
            k -= 1
    return score, equal, int(k), stop


class Passages:
    """A block of benchmark passages and their n-grams; every n-gram is a seed of the passages that hold it."""

    def __init__(self, rows: list, share: float):
        self.items = [r.item_id for r in rows]
        self.words = [codes_of(r.text) for r in rows]
        sizes = np.array([len(w) for w in self.words], dtype=np.int64)
        self.share, self.need = share, np.maximum(np.ceil(share * sizes - 1e-9), np.minimum(LEAST_EQUAL, sizes))  # equal words that a leak has at least
        grams = [gram_hashes(w, min(SEED_WORDS, len(w))) if len(w) else w for w in self.words]
        self.grams = np.unique(np.concatenate([*grams, np.empty(0, np.uint64)]))
        held = [np.unique(np.searchsorted(self.grams, g)) for g in grams]  # per passage, places in grams
        owner = np.repeat(np.arange(len(held)), np.array([len(h) for h in held], dtype=np.int64))
        places = np.concatenate([*held, np.empty(0, np.int64)]).astype(np.int64)
        self.owners = owner[np.argsort(places, kind="stable")]  # the passages of gram g: owners[first[g] : first[g + 1]]
        self.first = np.concatenate(([0], np.cumsum(np.bincount(places, minlength=len(self.grams)))))
        self.sizes = sorted({min(SEED_WORDS, len(w)) for w in self.words if len(w)})

    def seeded(self, codes: np.ndarray) -> Iterator[tuple[int, np.ndarray]]:
        """The passages that share an n-gram with a document, and where it has them."""
        what, where = self.find(codes)
        if not len(what):
            return
        times = self.first[what + 1] - self.first[what]
        at = np.repeat(where, times)
        start = np.repeat(self.first[what] - (np.cumsum(times) - times), times)
        passage = self.owners[start + np.arange(len(at))]
        order = np.lexsort((at, passage))
        passage, at = passage[order], at[order]
        edges = np.flatnonzero(np.diff(passage)) + 1
        for k, places in zip(passage[np.concatenate(([0], edges))].tolist(), np.split(at, edges)):
            yield k, places

    def find(self, codes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """The n-grams of this block in a document: places in ``grams``, and where."""
        what, where = [], []
        for n in self.sizes:
            grams = gram_hashes(codes, n)
            if len(grams) and len(self.grams):
                at = np.minimum(np.searchsorted(self.grams, grams), len(self.grams) - 1)
                hit = np.flatnonzero(self.grams[at] == grams)
                what.append(at[hit])
                where.append(hit)
        return (np.concatenate(what), np.concatenate(where)) if what else (np.empty(0, np.int64),) * 2

    def leaks(self, codes: np.ndarray, passage: int, places: np.ndarray) -> tuple | None:
        """The best alignment of a passage near its seeds, given in order, in a document, if it is a leak."""
        words = self.words[passage]
        n, best = len(words), (0, 0, 0, 0)
        reach = n + max(8, n // 4)
        edges = np.flatnonzero(np.diff(places) > reach) + 1
        for group in np.split(places, edges):
            for lo in range(max(0, int(group[0]) - reach), int(group[-1]) + 1, 4 * reach):
                # windows of at most six reaches, that overlap by two
                hi = min(lo + 6 * reach, int(group[-1]) + reach + SEED_WORDS, len(codes))
                if np.isin(words, codes[lo:hi]).sum() < self.need[passage]:
                    continue  # too few words in common for a leak, in whatever order
                score, equal, a, b = align(words, codes[lo:hi])
                if score > best[0]:
                    best = (score, equal, lo + a, lo + b)
        return best if best[0] >= self.share * MATCH * n and best[1] >= min(LEAST_EQUAL, n) else None


def _leaks(block):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        names = ["doc_id", "key", "item", "score", "n_equal", "start", "stop"]
        passages = block.value
        for batch in batches:
            out = []
            for doc_id, key, text in zip(*(batch.column(n).to_pylist() for n in ("doc_id", "key", "text"))):
                codes = codes_of(text)
                for k, places in passages.seeded(codes):
                    if best := passages.leaks(codes, k, places):
                        out.append((doc_id, key, k, best[0] / (MATCH * len(passages.words[k])), best[1], best[2], best[3]))
            if out:
                types = (pa.int64(), pa.int64(), pa.int32(), pa.float64(), pa.int32(), pa.int32(), pa.int32())
                yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*out), types)], names)

    return run


def passages_of(benchmark: DataFrame) -> DataFrame:
    """``item_id``, ``text``: long items in passages of about equal length, at most ``PASSAGE_WORDS`` words; nulls and blanks left out, repeats once."""
    words = F.filter(F.split(F.regexp_replace("text", r"^[\x20\x09-\x0D]+", ""), r"[\x20\x09-\x0D]+"), lambda w: w != "")
    rows = benchmark.select(F.col("item_id").cast("long").alias("item_id"), words.alias("words")).where("size(words) > 0").distinct()
    parts = F.ceil(F.size("words") / PASSAGE_WORDS).cast("int")
    rows = rows.select("item_id", "words", parts.alias("parts"), F.explode(F.sequence(F.lit(0), parts - 1)).alias("part"))
    start, stop = (F.floor(F.size("words") * (F.col("part") + k) / F.col("parts")).cast("int") for k in (0, 1))
    return rows.select("item_id", "part", F.array_join(F.slice("words", start + 1, stop - start), " ").alias("text"))


def leaks(docs: DataFrame, benchmark: DataFrame, share: float = 0.5) -> DataFrame:
    """Benchmark items found in documents: ``doc_id``, ``item_id``, ``score`` (share of the greatest), ``n_equal`` words, ``start`` and ``stop`` (words of the document), ``text_key`` (xxhash64 of the text).

    ``docs`` has ``doc_id`` and ``text``, ``benchmark`` ``item_id`` and ``text``. The benchmark is the query set and goes over all documents in
    blocks of some thousand passages, each broadcast, one scan a block. Every word trigram of a passage is a seed: a document that shares any
    is aligned with the passage around it (Smith-Waterman, words; match 2, mismatch and gap -1), unless the words in common are too few for a leak,
    so edited and partly paraphrased copies count while three words in a row are left. A leak scores at least ``share`` of
    the passage's greatest score and has eight equal words, or all of a shorter passage. Per document (id and text) and item the best passage is
    returned.

    Null and blank texts match nothing; no items or documents give no rows. Repeated rows of one id and text count once; extra columns are ignored.
    A null ``doc_id`` is kept.
    """
    spark = docs.sparkSession
    docs = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text", F.xxhash64("text").alias("key")).where("text is not null")
    passages = cut(passages_of(benchmark))
    blocks = math.ceil(passages.count() / BLOCK)
    out = None
    for k in range(blocks):
        block = Passages(passages.where(F.pmod(F.xxhash64("item_id", "part"), F.lit(blocks)) == k).orderBy("item_id", "part", "text").collect(), share)
        found = docs.mapInArrow(_leaks(spark.sparkContext.broadcast(block)), "doc_id long, key long, item int, score double, n_equal int, start int, stop int")
        items = spark.createDataFrame(list(enumerate(block.items)), "item int, item_id long")
        found = found.join(F.broadcast(items), "item").drop("item")
        out = found if out is None else out.unionByName(found)
    if out is None:
        return spark.createDataFrame([], "doc_id long, item_id long, score double, n_equal int, start int, stop int, text_key long")
    best = F.max(F.struct("score", "n_equal", (-F.col("start")).alias("from"), "stop"))
    out = out.groupBy("doc_id", "key", "item_id").agg(best.alias("x"))
    return out.select("doc_id", "item_id", "x.score", "x.n_equal", (-F.col("x.from")).alias("start"), "x.stop", F.col("key").alias("text_key"))
