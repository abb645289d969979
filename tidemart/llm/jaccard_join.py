"""N-gram Jaccard join: MinHash banding, then exact verification on the full n-gram sets.

1. Every text becomes its set of word 5-grams; texts with equal sets form one
   class, so copies, however many, are one entry from here on.
2. Rows per band and the number of bands follow from the similarity and the
   target recall. Classes meet in a shuffle on band hashes; each is linked to
   the smallest class of its band group, not to all of them, and connected
   components of these links hold all candidate pairs.
3. Within a component all pairs are compared on the full sets. A component is
   cut into parts of bounded size, and each pair of parts is a task of its own.
   Links are counted there, and only what connects the classes is emitted.

Defined results: a null text is empty. A text of fewer words than an n-gram has
one gram, all its words; texts without words are copies of each other. A row
with a null id can't be named: it has no class and no links. Rows that share an
id share a class, repeated rows among them. Sets at exactly the threshold are linked;
of the ids of a class the smallest stands for it. A very long text is one set of
hashes in one task. An empty table gives no rows. Extra columns, whatever their
names, are not looked at.
"""

from __future__ import annotations

import hashlib
import math
from collections.abc import Iterator
from fractions import Fraction

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemart.llm.common import components, keyed, pin, release

WORDS = 5
THRESHOLD = 0.8
RECALL = 0.9999  # of pairs at exactly the threshold; pairs above it are found more surely
MAX_HASHES = 128
PART_DOCS, PART_GRAMS = 2_000, 1_000_000  # of one part of a component; a task compares two parts
STEP = 4096


def banding(threshold: float, recall: float, max_hashes: int = MAX_HASHES) -> tuple[int, int]:
    """(bands, rows per band): the most rows, so the fewest chance meetings, that reach the recall."""
    best = None
    for rows in range(1, max_hashes + 1):
        bands = math.ceil(math.log(1 - recall) / math.log(1 - threshold ** rows)) if threshold < 1 else 1
        if bands * rows > max_hashes:
            break
        best = bands, rows
    if best is None:
        raise ValueError(f"{max_hashes} hashes can't find pairs of similarity {threshold} with a recall of {recall}")
    return best


def mixed(h: np.ndarray) -> np.ndarray:
    h = (h ^ h >> np.uint64(30)) * np.uint64(0xBF58476D1CE4E5B9)
    h = (h ^ h >> np.uint64(27)) * np.uint64(0x94D049BB133111EB)
    return h ^ h >> np.uint64(31)


def gram_set(text: bytes, size: int = WORDS) -> np.ndarray:
    """Sorted 64-bit hashes of a text's distinct word n-grams (words between ASCII white space)."""
    words = text.split()
    n = len(words)
    if not n:
        return np.zeros(0, dtype=np.uint64)
    h = np.fromiter(map(xxhash.xxh3_64_intdigest, words), dtype=np.uint64, count=n)
    size = min(size, n)
    grams = np.full(n - size + 1, size, dtype=np.uint64)
    for k in range(size):
        grams = mixed(grams + h[k:n - size + 1 + k])
    return np.unique(grams)


class Signer:
    """Band hashes of a set."""

    def __init__(self, bands: int, rows: int):
        self.bands, self.rows = bands, rows
        rng = np.random.default_rng(20)
        self.a = rng.integers(0, 1 << 63, bands * rows, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
        self.b = rng.integers(0, 1 << 63, bands * rows, dtype=np.uint64)

    def __call__(self, grams: np.ndarray) -> list[int]:
        low = np.full(len(self.a), ~np.uint64(0), dtype=np.uint64)
        for at in range(0, len(grams), STEP):
            x = grams[at:at + STEP]
            for k in range(len(low)):
                low[k] = min(low[k], (x * self.a[k] + self.b[k]).min())
        low = low.reshape(self.bands, self.rows)
        h = np.arange(self.bands, dtype=np.uint64)
        for k in range(self.rows):
            h = mixed(h + low[:, k])
        return h.view(np.int64).tolist()


def signatures(docs: DataFrame, size: int, bands: int, rows: int) -> DataFrame:
    """(doc_id, set_id, grams, bands) of every document; set_id is a 128-bit digest of the whole set."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sign = Signer(bands, rows)
        for b in batches:
            keys, n, signs = [], [], []
            for t in b.column(1).cast(pa.binary()):
                grams = gram_set(t.as_py(), size)
                keys.append(hashlib.blake2b(grams.tobytes(), digest_size=16).digest())
                n.append(len(grams))
                signs.append(sign(grams) if len(grams) else [])
            yield pa.RecordBatch.from_arrays(
                [b.column(0), pa.array(keys, pa.binary()), pa.array(n, pa.int64()), pa.array(signs, pa.list_(pa.int64()))],
                ["doc_id", "set_id", "grams", "bands"])
        release()  # the worker lives on beside later stages and the executor's other tasks

    return docs.mapInArrow(run, "doc_id long, set_id binary, grams long, bands array<long>")


def linked(sets: list[np.ndarray], fraction: Fraction, left: np.ndarray | None = None) -> np.ndarray:
    """Matrix of which sets are at least ``fraction`` alike; with ``left`` only pairs of a left and a right set.

    Sets are written as their differences from the core, the grams that more
    than half of them have, so near copies cost little more than their edits.
    """
    k = len(sets)
    sizes = np.array([len(s) for s in sets], dtype=np.int64)
    every = np.concatenate(sets)
    order = np.argsort(every)
    every = every[order]
    ids = np.empty(len(every), dtype=np.int32)
    ids[order] = np.cumsum(np.append(False, every[1:] != every[:-1]), dtype=np.int32)
    del every, order
    owner = np.repeat(np.arange(k, dtype=np.int32), sizes)
    core = np.bincount(ids) * 2 > k
    number = np.cumsum(core, dtype=np.int32) - 1
    has = np.zeros((k, int(core.sum())), dtype=bool)
    inside = core[ids]
    has[owner[inside], number[ids[inside]]] = True
    lacks_owner, lacks = np.nonzero(~has)
    lacking = np.bincount(lacks_owner, minlength=k)
    items = np.concatenate([ids[~inside] + np.int32(has.shape[1]), lacks.astype(np.int32)])
    owners = np.concatenate([owner[~inside], lacks_owner.astype(np.int32)])
    del ids, owner, inside, lacks_owner, lacks
    order = np.argsort(items, kind="stable")
    items, owners = items[order], owners[order]
    del order
    begin = np.flatnonzero(np.diff(items, prepend=-1))
    count = np.diff(begin, append=len(items))
    which = np.repeat(np.arange(len(begin), dtype=np.int32), count)
    by_owner = np.argsort(owners, kind="stable")
    bounds = np.searchsorted(owners[by_owner], np.arange(k + 1))
    out = np.zeros((k, k), dtype=bool)
    p, q = fraction.numerator, fraction.denominator
    for i in range(k):
        own = which[by_owner[bounds[i]:bounds[i + 1]]]
        own = own[count[own] > 1]
        n = count[own]
        at = np.repeat(begin[own] - (np.cumsum(n) - n), n) + np.arange(n.sum())
        both = np.bincount(owners[at], minlength=k) + (has.shape[1] - lacking[i]) - lacking
        out[i] = q * both >= p * (sizes[i] + sizes - both)
    np.fill_diagonal(out, False)
    if left is not None:
        out &= left[:, None] != left[None, :]
    return out


def local_roots(links: np.ndarray, ids: np.ndarray) -> np.ndarray:
    """Smallest id of each entry's connected component."""
    out, seen = ids.copy(), np.zeros(len(ids), dtype=bool)
    for i in np.argsort(ids, kind="stable").tolist():
        if seen[i]:
            continue
        front = np.zeros(len(ids), dtype=bool)
        front[i] = True
        while front.any():
            seen |= front
            out[front] = ids[i]
            front = links[front].any(axis=0) & ~seen
    return out


def candidates(classes: DataFrame) -> DataFrame:
    """(node, root) of classes that share a band with another: components of the links to a band's smallest class."""
    bands = classes.select("rep", F.explode("bands").alias("band"))
    meets = bands.groupBy("band").agg(F.min("rep").alias("low"), F.max("rep").alias("high")).where("low <> high")
    return components(bands.join(meets, "band").select(F.col("rep").alias("a"), F.col("low").alias("b")))


def join(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", threshold: float = THRESHOLD,
         words: int = WORDS, recall: float = RECALL) -> DataFrame:
    """One row per document: doc_id, class_id, copy_of, n_links.

    copy_of is the smallest id with the same set of n-grams, n_links the number
    of other sets at least ``threshold`` alike, and class_id the smallest id
    that the document is connected to through such links.
    """
    rows = keyed(docs, id_col, text_col)
    fraction = Fraction(threshold).limit_denominator(1000)
    signed = pin(signatures(rows, words, *banding(threshold, recall)), "signatures")
    classes = (signed.where("doc_id is not null").groupBy("set_id")
               .agg(F.min("doc_id").alias("rep"), F.first("grams").alias("grams"), F.first("bands").alias("bands")))
    classes = pin(classes, "classes")
    members = classes.drop("bands").join(candidates(classes), classes["rep"] == F.col("node")).drop("node")
    parts = members.groupBy("root").agg(
        F.greatest(F.ceil(F.count("*") / PART_DOCS), F.ceil(F.sum("grams") / PART_GRAMS)).cast("int").alias("parts"))
    # components of one part share tasks; a larger one has a task for each pair of its parts
    packs = max(1, -(-(members.agg(F.sum("grams")).first()[0] or 0) // PART_GRAMS))
    members = members.join(parts, "root")
    part = F.pmod(F.xxhash64("set_id"), F.col("parts")).cast("int")
    placed = (members.withColumn("own", part)
              .withColumn("other", F.explode(F.sequence(F.lit(0), F.col("parts") - 1)))
              .select("set_id", "rep", "root", "own",
                      F.when(F.col("parts") == 1, F.pmod(F.xxhash64("root"), F.lit(packs))).otherwise(F.col("root")).alias("task"),
                      (F.col("parts") == 1).alias("small"),
                      F.least("own", "other").alias("i"), F.greatest("own", "other").alias("j")))
    # any row of the class has its text; ids may repeat, so the set decides
    texts = signed.select("doc_id", "set_id").join(
        members.select("set_id", F.col("rep").alias("doc_id")), ["set_id", "doc_id"], "left_semi").distinct()
    with_text = (rows.join(texts, "doc_id").groupBy("doc_id", "set_id", F.md5("text").alias("m"))
                 .agg(F.first("text").alias("text")).drop("m"))
    tasks = placed.join(with_text.withColumnRenamed("doc_id", "rep"), ["set_id", "rep"])

    def verify(table: pa.Table) -> pa.Table:
        release()
        out = []
        roots = table["root"].to_numpy()
        order = np.argsort(roots, kind="stable")
        for same in np.split(order, np.flatnonzero(np.diff(roots[order])) + 1):
            t = table.take(pa.array(same))
            keys = t["set_id"].to_pylist()
            grams = [gram_set(x, words) for x in t["text"].cast(pa.binary()).to_pylist()]
            # rows that share an id with another text come along: only the set asked for counts
            keep = {}
            for k, g in enumerate(grams):
                if hashlib.blake2b(g.tobytes(), digest_size=16).digest() == keys[k]:
                    keep.setdefault(keys[k], k)
            at = list(keep.values())
            ids = t["rep"].to_numpy()[at]
            own = t["own"].to_numpy()[at]
            cross = t["i"][0].as_py() != t["j"][0].as_py()
            links = linked([grams[k] for k in at], fraction, own if cross else None)
            roots_here = local_roots(links, ids)
            out += [(keys[k], i, r, n) for k, i, r, n in zip(at, ids.tolist(), roots_here.tolist(),
                                                          links.sum(axis=1).tolist(), strict=True)]
        cols = list(zip(*out, strict=True)) or [()] * 4
        return pa.table([pa.array(c, pa.binary() if i == 0 else pa.int64()) for i, c in enumerate(cols)],
                        names=["set_id", "rep", "low", "links"])

    checked = pin(tasks.groupBy("small", "task", "i", "j").applyInArrow(
        verify, "set_id binary, rep long, low long, links long"), "links")
    groups = components(checked.select(F.col("rep").alias("a"), F.col("low").alias("b")))
    found = (classes.select("set_id", "rep")
             .join(checked.groupBy("set_id").agg(F.sum("links").alias("links")), "set_id", "left")
             .join(groups.select(F.col("node").alias("rep"), F.col("root").alias("class")), "rep", "left")
             .select("set_id", "rep", F.coalesce("class", "rep").alias("class"), F.coalesce("links", F.lit(0)).alias("links")))
    named = signed.select("doc_id", "set_id").where("doc_id is not null").join(found, "set_id")
    nameless = signed.where("doc_id is null").select(
        "doc_id", F.lit(None).cast("long").alias("class_id"), F.lit(None).cast("long").alias("copy_of"),
        F.lit(0).cast("long").alias("n_links"))
    return named.select("doc_id", F.col("class").alias("class_id"), F.col("rep").alias("copy_of"),
                        F.col("links").alias("n_links")).unionByName(nameless)
