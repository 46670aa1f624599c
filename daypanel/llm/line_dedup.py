"""Removes runs of lines and sentences that repeat across the corpus, whatever stands around them."""

from __future__ import annotations

import hashlib
import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from daypanel.llm.base import cut

#: Least words of a chunk.
CHUNK_WORDS = 20
_SENTENCE = re.compile(r"[.!?…。！？][\"'”»)]*\s+")


def units(text: str) -> tuple[list[int], list[int]]:
    """Starts of the lines and of the sentences within lines, and their words; blank lines belong to the unit before."""
    starts, words, at = [], [], 0
    for line in text.split("\n"):
        cuts = [0, *(m.end() for m in _SENTENCE.finditer(line))]
        for a, b in zip(cuts, [*cuts[1:], len(line)]):
            if n := len(line[a:b].split()):
                starts.append(at + a)
                words.append(n)
        at += len(line) + 1
    return starts, words


def chunks(text: str | None) -> list[tuple[int, int]]:
    """Spans (code points) of the chunks of a text, which overlap: from each unit the shortest run on of ``CHUNK_WORDS`` words, and to each unit the shortest run back.

    A chunk depends on no text outside it, and the chunks of any run of units of as many words cover the run.
    """
    text = text or ""
    starts, words = units(text)
    stops = [*starts[1:], len(text)]
    out: list[tuple[int, int]] = []
    first, have = 0, 0  # the first unit whose run on isn't found yet, and the words from it
    for k, n in enumerate(words):
        have += n
        if have < CHUNK_WORDS and first:
            out.append((starts[first - 1], stops[k]))
        while have >= CHUNK_WORDS:  # the last of these is the shortest run back, too
            out.append((starts[first], stops[k]))
            have -= words[first]
            first += 1
    return out


def _digest(piece: str) -> bytes:
    # the white space around a chunk, such as a last line's missing break, doesn't count
    return hashlib.blake2b(piece.strip().encode("utf-8", "surrogatepass"), digest_size=16).digest()


def _chunks(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        texts = batch.column("text").to_pylist()
        spans = [chunks(t) for t in texts]
        codes = np.frombuffer(b"".join(_digest(t[a:b]) for t, s in zip(texts, spans) for a, b in s), dtype=np.int64).reshape(-1, 2)
        flat = np.array([x for s in spans for x in s], dtype=np.int32).reshape(-1, 2)
        row = pa.array(np.repeat(np.arange(len(spans)), [len(s) for s in spans]))
        columns = [batch.column("doc_id").take(row), batch.column("key").take(row), *(pa.array(np.ascontiguousarray(x[:, k])) for x in (codes, flat) for k in (0, 1))]
        yield pa.RecordBatch.from_arrays(columns, ["doc_id", "key", "code", "check", "start", "stop"])


def _strip(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        texts, gone = [], []
        for text, spans in zip(batch.column("text").to_pylist(), batch.column("spans").to_pylist()):
            runs = []  # overlapping and touching spans as one
            for a, b in sorted((s["start"], s["stop"]) for s in spans or ()):
                if runs and a <= runs[-1]["stop"]:
                    runs[-1]["stop"] = max(runs[-1]["stop"], b)
                else:
                    runs.append({"start": a, "stop": b})
            if runs:
                text = "".join(text[a:b] for a, b in zip([0, *(r["stop"] for r in runs)], [*(r["start"] for r in runs), len(text)]))
            texts.append(text)
            gone.append(runs or None)
        new = {"text": texts, "spans": gone}
        columns = [pa.array(new[f.name], f.type) if f.name in new else batch.column(f.name) for f in batch.schema]
        yield pa.RecordBatch.from_arrays(columns, batch.schema.names)


def _same(x: str, y: str) -> Column:
    return F.col(f"{x}.doc_id").eqNullSafe(F.col(f"{y}.doc_id")) & (F.col(f"{x}.key") == F.col(f"{y}.key"))


def dedup_lines(docs: DataFrame) -> DataFrame:
    """Documents without the runs of lines and sentences that occurred before.

    Takes ``doc_id``, ``text`` and any other columns and returns the same columns plus ``n_removed`` (runs) and ``chars_removed``.
    Units are lines and the sentences within lines. A run of units of at least ``CHUNK_WORDS`` words that stands in several places, or
    several times in one text, is found whatever stands around it: the chunks in it (``chunks``) depend on nothing else and cover it. Of the places of a chunk the first
    by (``doc_id``, place) stays; the others are cut out. Chunks are equal if the 128-bit BLAKE2b digests of their
    bytes are, half of which finds them first. Of each unit that goes an equal one stays further ahead. A passage that begins or ends within a sentence is found without that sentence.

    Null texts stay null, empty ones empty. Rows that repeat both id and text are one document and all come back alike; a null id comes
    first. Columns named like one of the two added are replaced, all others are kept whatever their name.
    """
    docs = docs.drop("n_removed", "chars_removed")
    others = [c for c in docs.columns if c != "text"]
    keyed = docs.select(F.struct(*(F.col(f"`{c}`") for c in others)).alias("row"), F.col("doc_id").cast("long").alias("doc_id"), F.xxhash64("text").alias("key"), "text")
    ids = keyed.select("doc_id", "key", "text")
    places = cut(ids.where("text is not null").mapInArrow(_chunks, "doc_id long, key long, code long, check long, start int, stop int"))
    often = places.groupBy("code").agg(F.count("*").alias("n")).where("n > 1").select("code")
    found = cut(places.join(often, "code"))
    first = found.groupBy("code", "check").agg(F.min(F.struct("doc_id", "key", "start")).alias("first"))
    other = ~(F.col("doc_id").eqNullSafe(F.col("first.doc_id")) & (F.col("key") == F.col("first.key")) & (F.col("start") == F.col("first.start")))
    gone = found.join(first, ["code", "check"]).where(other)
    gone = cut(gone.groupBy("doc_id", "key").agg(F.collect_set(F.struct("start", "stop")).alias("spans")))
    joined = keyed.alias("d").join(gone.alias("p"), _same("d", "p"), "left").select("row", "text", "spans", F.length("text").alias("before"))
    cleaned = joined.mapInArrow(_strip, joined.schema)
    return cleaned.select(
        *(F.col("text") if c == "text" else F.col("row").getField(c).alias(c) for c in docs.columns),
        F.when(F.col("spans").isNull(), 0).otherwise(F.size("spans")).alias("n_removed"), F.coalesce(F.col("before") - F.length("text"), F.lit(0)).cast("long").alias("chars_removed"),
    )
