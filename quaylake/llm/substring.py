"""Passages that repeat across documents: winnowed anchors are the seeds, fixed windows stand in for extension."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from quaylake.llm.common import picked, saved, text_hash, words_of
from quaylake.llm.tokens import gathered

LENGTH = 13  # words of the shortest repeat
SEED = 7  # words of a seed
BATCH_BYTES = 4 << 20

# Odd multipliers of the rolling hashes and of the final mixing; any odd numbers with mixed bits do.
FIRST, SECOND = np.uint64(0x9E3779B97F4A7C15), np.uint64(0xD1B54A32D192ED03)
MIX = np.uint64(0xBF58476D1CE4E5B9)


def rolled(words: np.ndarray, width: int, multiplier: np.uint64) -> np.ndarray:
    """Hash of the `width` words from each place on; places too near the end are left out."""
    out = np.zeros(max(len(words) - width + 1, 0), np.uint64)
    for j in range(width):
        out = out * multiplier + words[j:j + len(out)]
    out = (out ^ (out >> np.uint64(31))) * MIX
    return out ^ (out >> np.uint64(29))


class Winnowed:
    """Anchors of a batch of documents, given as the hashes of all their words and the documents' ends.

    Every window of LENGTH words has one anchor: of the seeds within it the one with the smallest hash,
    the last among equals. That depends on nothing but its words, so equal windows have equal anchors.
    """

    def __init__(self, words: np.ndarray, ends: np.ndarray) -> None:
        self.words = words
        self.begins = np.concatenate([[0], ends[:-1]]).astype(np.int64)
        fit = np.maximum(ends - self.begins - LENGTH + 1, 0)
        self.doc = np.repeat(np.arange(len(ends)), fit)
        inner = np.arange(len(self.doc)) - np.repeat(np.cumsum(fit) - fit, fit)
        self.window = self.begins[self.doc] + inner  # where each window begins
        self.place = inner
        seeds = rolled(words, SEED, FIRST)
        least = seeds[self.window]
        at = self.window.copy()
        for j in range(1, LENGTH - SEED + 1):
            value = seeds[self.window + j]
            lower = value <= least
            least[lower], at[lower] = value[lower], self.window[lower] + j
        new = np.ones(len(at), bool)
        new[1:] = (at[1:] != at[:-1]) | (self.doc[1:] != self.doc[:-1])
        self.anchor = np.cumsum(new) - 1  # of each window
        self.seed = least[new]
        self.anchor_doc = self.doc[new]
        first = np.searchsorted(self.anchor_doc, np.arange(len(ends)))
        self.first = first
        self.number = np.arange(len(self.seed)) - first[self.anchor_doc]


def unpacked(lists: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """Values of all lists and the lists' ends."""
    offsets = lists.offsets.to_numpy().astype(np.int64)
    return lists.flatten().to_numpy(zero_copy_only=False), offsets[1:] - offsets[0]


def seeds_once(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Every document's seeds, each once."""
    for batch in gathered(batches, BATCH_BYTES):
        words, ends = unpacked(batch.column("words"))
        w = Winnowed(words.view(np.uint64), ends)
        order = np.lexsort((w.seed, w.anchor_doc))
        seed, doc = w.seed[order], w.anchor_doc[order]
        new = np.ones(len(seed), bool)
        new[1:] = (seed[1:] != seed[:-1]) | (doc[1:] != doc[:-1])
        yield pa.RecordBatch.from_arrays([pa.array(seed[new].view(np.int64))], names=["seed"])


def anchors(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Every anchor: its document's row, its number there and its seed."""
    for batch in gathered(batches, BATCH_BYTES):
        words, ends = unpacked(batch.column("words"))
        w = Winnowed(words.view(np.uint64), ends)
        yield pa.RecordBatch.from_arrays(
            [batch.column("row").take(pa.array(w.anchor_doc)), pa.array(w.number.astype(np.int32)),
             pa.array(w.seed.view(np.int64))],
            names=["row", "number", "seed"],
        )


def windows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Windows whose anchor's number is listed: place and two hashes of all their words."""
    for batch in gathered(batches, BATCH_BYTES):
        words, ends = unpacked(batch.column("words"))
        w = Winnowed(words.view(np.uint64), ends)
        numbers, stops = unpacked(batch.column("numbers"))
        doc = np.repeat(np.arange(len(ends)), np.diff(np.concatenate([[0], stops])))
        listed = np.zeros(len(w.seed), bool)
        listed[w.first[doc] + numbers] = True
        mine = listed[w.anchor]
        start, doc = w.window[mine], pa.array(w.doc[mine])
        yield pa.RecordBatch.from_arrays(
            [pa.array(rolled(w.words, LENGTH, m)[start].view(np.int64)) for m in (FIRST, SECOND)]
            + [batch.column(c).take(doc) for c in ("row", "none", "id")]
            + [pa.array(w.place[mine].astype(np.int32))],
            names=["a", "b", "row", "none", "id", "place"],
        )


def kept(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Texts without the words that a listed window covers; `later` texts are covered as a whole."""
    for batch in batches:
        totals, gone, texts, spans = [], [], [], []
        for text, later, places in zip(*(batch.column(c).to_pylist() for c in ("text", "later", "places"))):
            words = (text or b"").split()
            n = len(words)
            if later and n >= LENGTH:
                places = range(n - LENGTH + 1)
            step = np.zeros(n + 1, np.int64)
            at = np.array(places if places is not None else [], np.int64)
            np.add.at(step, at, 1)
            np.add.at(step, at + LENGTH, -1)
            covered = np.cumsum(step[:n]) > 0
            edge = np.flatnonzero(np.diff(np.concatenate([[0], covered, [0]])))
            totals.append(n)
            gone.append(int(covered.sum()))
            spans.append(edge.tolist())
            texts.append(b" ".join(words if not len(edge) else [words[i] for i in np.flatnonzero(~covered)]))
        yield pa.RecordBatch.from_arrays(
            [batch.column("id"), pa.array(totals, pa.int64()), pa.array(gone, pa.int64()),
             pa.array(texts, pa.binary()).cast(pa.string()), pa.array(spans, pa.list_(pa.int64()))],
            names=["id", "n_words", "n_removed", "kept_text", "edges"],
        )


def hashed_words(text: Column) -> Column:
    return F.transform(words_of(text), lambda x: F.xxhash64(x))


def repeats_removed(docs: DataFrame, id: str = "doc_id", text: str = "text") -> DataFrame:
    """One row per document: id, `n_words`, `n_removed`, `kept_text` (the words left, joined by spaces)
    and `edges`, begin and end of each maximal repeat in words, one after the other.

    A word goes if a window of LENGTH words over it also begins in a document with a smaller id; what
    overlaps is one repeat. The steps:

    1. Equal texts: all but those with the smallest id are covered as a whole, so one stands for all.
    2. Winnowed anchors: seeds that only one document has are dropped, the anchors with others stay.
    3. The windows round those anchors meet by the hash of all their words (128 bits). Each group is
       reduced to its smallest id before it is joined back: n copies are n rows and never pairs.

    Null ids count as larger than all others and are not told apart; rows with equal ids never remove
    from each other. A null text has no words. An empty table gives an empty result; other columns
    don't matter. Each step is written to the shared folder.
    """
    rows = picked(docs, id=id, text=text).select(
        "id", F.col("id").isNull().alias("none"), "text", text_hash(F.coalesce("text", F.lit(""))).alias("key"),
        F.monotonically_increasing_id().alias("row"),
    )
    rows = saved(rows, "texts")
    kind = rows.schema["id"].dataType.simpleString()
    order = F.struct("none", "id")
    first = saved(rows.groupBy("key").agg(
        F.min(F.struct("none", "id", "row")).alias("first"), F.count(F.lit(1)).alias("n")
    ), "first")
    copies = rows.select("row", "none", "id", "key").join(first.where("n > 1"), "key").select(
        "row", (order > F.struct("first.none", "first.id")).alias("later"), F.col("first.row").alias("like"),
    )
    copies = saved(copies, "copies")

    hashed = rows.select("row", hashed_words(F.col("text")).alias("words"))
    seeds = hashed.mapInArrow(seeds_once, "seed long").groupBy("seed").count().where(F.col("count") > 1)
    seeds = saved(seeds.select("seed"), "seeds")
    found = hashed.mapInArrow(anchors, "row long, number int, seed long").join(seeds, "seed")
    found = saved(found.groupBy("row").agg(F.collect_list("number").alias("numbers")), "anchors")
    alone = saved(found.join(copies.where("row <> like").select("row"), "row", "left_anti"), "alone")

    met = rows.join(alone, "row").select("row", "none", "id", hashed_words(F.col("text")).alias("words"), "numbers")
    met = met.mapInArrow(windows, f"a long, b long, row long, none boolean, id {kind}, place int")
    met = saved(met, "windows")
    least = met.groupBy("a", "b").agg(F.min(order).alias("least"), F.count(F.lit(1)).alias("n"))
    least = saved(least.where("n > 1").select("a", "b", "least"), "least")
    covered = met.join(least, ["a", "b"]).where(order > F.col("least"))
    covered = saved(covered.groupBy("row").agg(F.collect_list("place").alias("places")), "covered")

    # A copy under the first one's own id is treated like it.
    like = copies.where("row <> like AND NOT later").join(covered.withColumnRenamed("row", "like"), "like")
    result = saved(covered.select("row", "places", F.lit(False).alias("later")).unionByName(
        like.select("row", "places", F.lit(False).alias("later"))
    ).unionByName(
        copies.where("later").select("row", F.lit(None).cast("array<int>").alias("places"), "later")
    ), "result")
    joined = rows.join(result, "row", "left").select("id", F.col("text").cast("binary").alias("text"), "later", "places")
    out = joined.mapInArrow(kept, f"id {kind}, n_words long, n_removed long, kept_text string, edges array<bigint>")
    return out.withColumnRenamed("id", id)
