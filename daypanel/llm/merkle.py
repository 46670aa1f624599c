"""Merkle manifest of a dataset: leaves, trees per source, proofs and folding."""

from __future__ import annotations

import hashlib
from dataclasses import dataclass

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from daypanel.llm.base import cut
from daypanel.operators.ranges import range_places

#: Children of a node, and levels that one task builds at a time.
FAN, LEVELS = 16, 3
#: Leaves below one task's node.
CHUNK = FAN**LEVELS
FIELDS = ("doc_id", "source", "lang", "n_chars", "text")
_UPPER, _LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


def leaf(*fields: Column) -> Column:
    """SHA-256 over the fields in order, each ``-`` if null, else its UTF-8 length, ``:`` and its value."""
    texts = [f.cast("string") for f in fields]
    return F.sha2(F.concat(*(F.coalesce(F.concat(F.octet_length(t).cast("string"), F.lit(":"), t), F.lit("-")) for t in texts)), 256)


class Subtree:
    """A tree over a run of consecutive nodes whose parents keep a copy of their hash state before each child.

    ``whole``: the run is all that there is, so it is built until one node is left; else ``LEVELS`` levels are.
    """

    def __init__(self, nodes: list[bytes], whole: bool):
        self.layers, self.states = [nodes], []
        while len(self.layers[-1]) > 1 if whole else len(self.states) < LEVELS:
            states, above = [], []
            for start in range(0, len(self.layers[-1]), FAN):
                state = hashlib.sha256()
                for child in self.layers[-1][start : start + FAN]:
                    states.append(state.copy())
                    state.update(child)
                above.append(state.hexdigest().encode())
            self.states.append(states)
            self.layers.append(above)

    @property
    def root(self) -> bytes:
        return self.layers[-1][0]

    def siblings(self, i: int) -> list[tuple[bytes, bytes]]:
        """Level by level the concatenated siblings on the left and on the right of node ``i`` and of the nodes above it."""
        out = []
        for layer in self.layers[:-1]:
            start = i - i % FAN
            out.append((b"".join(layer[start:i]), b"".join(layer[i + 1 : start + FAN])))
            i //= FAN
        return out

    def fold(self, i: int, replacement: bytes, rights: list[bytes]) -> bytes:
        """The root with node ``i`` replaced: each parent's state before its slot goes on with the replacement and what is right of it."""
        node = replacement
        for states, right in zip(self.states, rights):
            state = states[i].copy()
            state.update(node)
            state.update(right)
            node, i = state.hexdigest().encode(), i // FAN
        return node


def _subtree(rows: pd.DataFrame) -> Subtree:
    return Subtree([d.encode() for d in rows["digest"]], rows["group_rows"].iloc[0] <= CHUNK)


def _reduce(key: tuple, rows: pd.DataFrame) -> pd.DataFrame:
    rows = rows.sort_values("place")
    n = int(rows["group_rows"].iloc[0])
    return pd.DataFrame({"tree": [key[0]], "place": [key[1]], "group_rows": [-(-n // CHUNK)], "digest": [_subtree(rows).root.decode()]})


def _chunk() -> Column:
    return F.floor(F.col("place") / CHUNK).alias("chunk")


def _raise(nodes: DataFrame) -> list[DataFrame]:
    """``nodes`` (tree, place, group_rows, digest), then the node above each chunk of them, until every tree has one."""
    steps, most = [nodes], nodes.agg(F.max("group_rows")).first()[0] or 1
    while most > 1:
        steps.append(cut(steps[-1].groupBy("tree", _chunk()).applyInPandas(_reduce, "tree long, place long, group_rows long, digest string")))
        most = -(-most // CHUNK)
    return steps


_PATHS = "tree long, place long, lefts array<string>, rights array<string>, subroot string, root string"


def _extend(key: tuple, rows: pd.DataFrame, path: pd.DataFrame) -> pd.DataFrame:
    """The paths of a chunk's nodes: their siblings within the chunk, then those of the node above it."""
    rows, above = rows.sort_values("place"), path.iloc[0]
    tree, out = _subtree(rows), []
    for i, place in enumerate(rows["place"]):
        own = tree.siblings(i)
        out.append((key[0], place, [a.decode() for a, _ in own] + list(above["lefts"]), [b.decode() for _, b in own] + list(above["rights"]), above["subroot"], above["root"]))
    return pd.DataFrame(out, columns=["tree", "place", "lefts", "rights", "subroot", "root"])


def _lower(steps: list[DataFrame], paths: DataFrame) -> DataFrame:
    """The paths of the nodes ``steps[0]``, chunk by chunk from those of the trees' roots."""
    for nodes in reversed(steps):
        above = paths.withColumnRenamed("place", "chunk").groupBy("tree", "chunk")
        paths = cut(nodes.groupBy("tree", _chunk()).cogroup(above).applyInPandas(_extend, _PATHS))
    return paths


def _fold(key: tuple, rows: pd.DataFrame, path: pd.DataFrame) -> pd.DataFrame:
    rows, above = rows.sort_values("place"), path.iloc[0]
    tree = _subtree(rows)
    lefts, rights = ([x.encode() for x in above[c]] for c in ("lefts", "rights"))
    # the parents above the chunk are the same for all its leaves: their states before the chunk's slot are kept once
    kept, shared = [hashlib.sha256(left) for left in lefts], b"".join(a + b for a, b in zip(lefts, rights))
    proofs, folded = [], []
    for i, replacement in enumerate(rows["shown"]):
        own = tree.siblings(i)
        proof = hashlib.sha256(b"".join(a + b for a, b in own))
        proof.update(shared)
        proofs.append(proof.hexdigest())
        node = tree.fold(i, replacement.encode(), [b for _, b in own])
        for state, right in zip(kept, rights):
            state = state.copy()
            state.update(node)
            state.update(right)
            node = state.hexdigest().encode()
        folded.append(node.decode())
    return pd.DataFrame({"doc_id": rows["doc_id"], "leaf": rows["digest"], "subroot": above["subroot"], "root": above["root"], "proof_sha256": proofs, "folded_root": folded, "source": rows["source"]})


@dataclass
class Manifest:
    """``leaves``: doc_id, source, shown, digest, tree, place, group_rows. ``trees``: source, tree, subroot. ``root`` is None without rows."""

    leaves: DataFrame
    trees: DataFrame
    root: str | None
    steps: list[DataFrame]
    top: list[DataFrame]


def build(docs: DataFrame, shown: Column | None = None) -> Manifest:
    """The manifest of documents: a tree for each source over its leaves by id, and a tree over the sources.

    ``shown`` is the text as found later, where it is to be checked against the manifest; by default it is the text.
    Leaves are hashed in the scan, and only digests are shuffled. Places within a source come from range partitions; each task
    then builds the three levels above 4,096 consecutive nodes, and their roots are the next step's nodes.
    """
    kinds = {"doc_id": "long", "n_chars": "long"}
    fields = docs.select(*(F.col(f).cast(kinds.get(f, "string")).alias(f) for f in FIELDS), (F.col("text").cast("string") if shown is None else shown).alias("_shown"))
    same = F.col("_shown").eqNullSafe(F.col("text"))
    digest, other = leaf(*map(F.col, FIELDS)), leaf(*map(F.col, FIELDS[:-1]), F.col("_shown"))
    hashed = fields.select("doc_id", "source", digest.alias("digest"), F.when(~same, other).alias("_other"), F.monotonically_increasing_id().alias("_tie"))
    placed = range_places(cut(hashed), [F.col("doc_id").asc_nulls_first(), F.substring("digest", 1, 12), "_tie"], ["source"])
    placed = cut(placed.select("doc_id", "source", F.coalesce("_other", "digest").alias("shown"), "digest", "place", "group_rows"))
    sources = cut(range_places(placed.select("source").distinct(), [F.col("source").asc_nulls_first()]).select(F.col("source").alias("name"), F.col("place").alias("tree"), F.col("group_rows").alias("n_trees")))
    leaves = cut(placed.join(sources.drop("n_trees"), F.col("source").eqNullSafe(F.col("name"))).drop("name"))
    steps = _raise(leaves.select("tree", "place", "group_rows", "digest"))
    trees = cut(steps[-1].join(sources, "tree").select(F.col("name").alias("source"), "tree", F.col("digest").alias("subroot"), "n_trees"))
    top = _raise(trees.select(F.lit(0).cast("long").alias("tree"), F.col("tree").alias("place"), F.col("n_trees").alias("group_rows"), F.col("subroot").alias("digest")))
    last = top[-1].first()
    return Manifest(leaves, trees.drop("n_trees"), last.digest if last else None, steps, top)


def prove(manifest: Manifest) -> DataFrame:
    """Per leaf its proof and the root that its shown form folds to.

    Paths come down from the root the way the nodes went up: a task takes one chunk of nodes, at most 4,096, and the path of the node
    above them. It builds the chunk's tree, whose parents keep their hash states before each slot, so that a fold reads
    nothing on the left of a leaf.
    """
    spark = manifest.leaves.sparkSession
    none = spark.createDataFrame([(0, 0, [], [], None, manifest.root)] if manifest.root else [], _PATHS)
    top = _lower(manifest.top, none).select("place", "lefts", "rights", "root")
    roots = manifest.trees.join(top, F.col("tree") == F.col("place")).select("tree", F.lit(0).cast("long").alias("place"), "lefts", "rights", "subroot", "root")
    above = _lower(manifest.steps[1:], roots).withColumnRenamed("place", "chunk").groupBy("tree", "chunk")
    rows = manifest.leaves.groupBy("tree", _chunk()).cogroup(above).applyInPandas(_fold, "doc_id long, leaf string, subroot string, root string, proof_sha256 string, folded_root string, source string")
    return rows.withColumn("verified", F.col("folded_root") == F.col("root"))


def tampered(doc_id: Column, text: Column, share: int = 5) -> Column:
    """The text with A-Z in lower case where ``share`` divides the CRC-32 of the decimal id, else as it is."""
    return F.when(F.crc32(doc_id.cast("long").cast("string")) % share == 0, F.translate(text, _UPPER, _LOWER)).otherwise(text)


def verify(docs: DataFrame, shown: Column | None = None) -> DataFrame:
    """Manifest of ``docs`` and the check of ``shown`` against it.

    Returns per row ``doc_id``, ``leaf``, ``subroot``, ``root``, ``proof_sha256``, ``folded_root``, ``source``, ``verified``.

    Nulls in any column have their own encoding; a null id comes first in its source, a null source is a source and comes first. Rows that repeat
    an id are ordered by digest; equal rows are leaves of their own. A lone leaf is its source's subroot, a lone source the root,
    and a proof without siblings the hash of nothing. No rows give no rows. Extra columns are ignored; ids that aren't
    integers raise.
    """
    return prove(build(docs, shown))
