"""N-gram Jaccard join by grouped prefixes.

1. *Order.* Blocks send the distinct shingles of their documents to buckets, which answer how
   many documents hold each. Shingles of one document only can match nothing; a document
   whose other shingles are too few for the threshold is done.
2. *Prefix.* With shingles ordered rare first, two similar sets share one of their first
   n - ceil(t n) + 1. Documents of one size and one prefix form a group.
3. *Group pairs.* Groups that share a prefix shingle and whose sizes fit are candidates.
   Only a star of candidate pairs is made for each shingle and size class, enough to connect
   all of them, so a shingle in very many prefixes makes as many rows as it has groups.
4. *Members.* Connected groups are expanded to their distinct sets, one document for each
   set, and verified by exact Jaccard similarity. Pairs already connected through others
   are skipped. Up to CELL_SHINGLES a connected part is one cell; a larger one is cut into
   slabs, and each pair of slabs whose sizes fit is a cell. Nothing is left out.
5. Verified links give components; a document of an equal set joins its set's component.
"""

from __future__ import annotations

import math

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from leadline.llm import blocks as B
from leadline.llm.components import components, forest
from leadline.llm.cuckoo import fresh_name
from leadline.llm.words import combine, mix, shingle_sets, words_of

SHINGLE = 5
PERCENT = 80
BLOCK_BYTES = 2 << 20
CELL_SHINGLES = 1_000_000
BIN_SHINGLES = 500_000  # cells of about this size together make a task's group
KEY_BITS_OVER = 5
SETS = "id long, n long, set_id long, group_id long, prefix array<long>, tokens binary"


def needed(sizes: np.ndarray, percent: int) -> np.ndarray:
    """Shingles a similar set must share with one of this size, at least."""
    return -(-sizes * percent // 100)


class Join:
    def __init__(self, size: int, percent: int, buckets: int, key_bits: int) -> None:
        self.size, self.percent, self.buckets = size, percent, buckets
        self.shift = np.uint64(64 - key_bits)

    def _sets(self, docs: pa.Table) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        ids, texts, _ = B.rows_of(docs)
        values, bounds = shingle_sets(words_of(texts, lower=True), self.size)
        return ids, values, bounds

    def _keys(self, values: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Shortened hashes: the distinct ones, where each value is among them, how often."""
        return np.unique(values >> self.shift, return_inverse=True, return_counts=True)

    def send_counts(self, docs: pa.Table) -> pa.Table:
        _, values, _ = self._sets(docs)
        keys, _, counts = self._keys(values)
        return B.pack(
            "bucket",
            docs.column("block")[0].as_py(),
            B.buckets_of(keys, self.buckets),
            [(keys // np.uint64(self.buckets)).astype(np.int64), counts],
        )

    def rank(self, sent: pa.Table) -> pa.Table:
        """0 for shingles of one document, else a rank that grows with their documents."""
        keys, counts = B.joined(sent, 0), B.joined(sent, 1)
        block, _ = B.numbered(sent)
        _, where = np.unique(keys, return_inverse=True)
        total = np.bincount(where, weights=counts)[where] if len(keys) else counts
        ranks = np.minimum(255, np.log2(np.maximum(total, 1)) * 6).astype(np.int64)
        return B.pack("block", sent.column("bucket")[0].as_py(), block, [ranks])

    def sets(self, docs: pa.Table, told: pa.Table) -> pa.Table:
        ids, values, bounds = self._sets(docs) if docs.num_rows else (np.zeros(0, np.int64),) * 3
        if not docs.num_rows:
            return _set_table([], [], [], [], [], [])
        keys, where, _ = self._keys(values)
        ranks = np.zeros(len(keys), np.int64)
        parts = B.unpack(told, 0)
        sent = B.Sent(B.buckets_of(keys, self.buckets))
        ranks[sent.entries(told.column("bucket").to_pylist(), [np.arange(len(p)) for p in parts])] = np.concatenate(
            [np.zeros(0, np.int64), *parts]
        )
        rank = ranks[where]
        sizes = np.diff(bounds)
        owner = np.repeat(np.arange(len(ids)), sizes)
        shared = np.bincount(owner[rank > 0], minlength=len(ids))
        open_ = (sizes > 0) & (shared >= needed(sizes, self.percent))
        order = np.lexsort((values, rank, owner))
        number, set_ids, groups, prefixes, tokens = [], [], [], [], []
        seen: set[tuple[int, int]] = set()
        for i in range(len(ids)):
            own = values[bounds[i] : bounds[i + 1]]
            n = len(own)
            number.append(n)
            if not open_[i]:
                set_ids.append(None)
                groups.append(None)
                prefixes.append(None)
                tokens.append(None)
                continue
            first = order[bounds[i] : bounds[i + 1]][: n - int(needed(np.int64(n), self.percent)) + 1]
            prefix = values[first[rank[first] > 0]]
            set_id = _signed(_fold(own))
            set_ids.append(set_id)
            groups.append(_signed(_fold(prefix) ^ np.uint64(n)))
            new = (set_id, n) not in seen
            seen.add((set_id, n))
            prefixes.append(prefix.view(np.int64).tolist() if new else None)
            tokens.append(own.tobytes() if new else None)
        return _set_table(ids, number, set_ids, groups, prefixes, tokens)


def _set_table(ids, number, set_ids, groups, prefixes, tokens) -> pa.Table:
    return pa.table(
        {
            "id": B.id_column(np.asarray(ids, np.int64)),
            "n": pa.array(number, pa.int64()),
            "set_id": pa.array(set_ids, pa.int64()),
            "group_id": pa.array(groups, pa.int64()),
            "prefix": pa.array(prefixes, pa.list_(pa.int64())),
            "tokens": pa.array(tokens, pa.binary()),
        }
    )


def _fold(values: np.ndarray) -> np.uint64:
    """A hash of a sequence of hashes."""
    place = mix(np.arange(len(values), dtype=np.uint64))
    return mix(np.array([combine(values, place).sum(dtype=np.uint64) + np.uint64(len(values))], np.uint64))[0]


def _signed(value: np.uint64) -> int:
    return int(np.uint64(value).view(np.int64))


def _links(tokens: list[np.ndarray], sides: list[int], percent: int) -> list[tuple[int, int]]:
    """Links that connect all similar sets, at most one fewer than sets.

    With two sides present only pairs across them are compared.
    """
    values = np.concatenate(tokens)
    owner = np.repeat(np.arange(len(tokens)), [len(t) for t in tokens])
    _, where, counts = np.unique(values, return_inverse=True, return_counts=True)
    often = counts[where]
    order = np.lexsort((values, often, owner))
    bounds = np.cumsum([0, *(len(t) for t in tokens)])
    across = len(set(sides)) > 1
    parent = list(range(len(tokens)))

    def find(x: int) -> int:
        while parent[x] != x:
            parent[x] = parent[parent[x]]
            x = parent[x]
        return x

    index: dict[int, dict[int, list[int]]] = {}
    found = []
    for x in sorted(range(len(tokens)), key=lambda i: len(tokens[i])):
        own, n = tokens[x], len(tokens[x])
        first = order[bounds[x] : bounds[x + 1]][: n - int(needed(np.int64(n), percent)) + 1]
        prefix = where[first[often[first] > 1]].tolist()
        near: dict[int, list[list[int]]] = {}
        for token in prefix:
            for old, members in index.get(token, {}).items():
                near.setdefault(find(old), []).append(members)
        for root, lists in near.items():
            if find(root) == find(x):
                continue
            tried: set[int] = set()
            for y in (member for members in lists for member in reversed(members)):
                if y in tried:
                    continue
                tried.add(y)
                if 100 * len(tokens[y]) < percent * n or (across and sides[x] == sides[y]):
                    continue
                both = tokens[y]
                shared = int((both[np.minimum(np.searchsorted(both, own), len(both) - 1)] == own).sum())
                if 100 * shared >= percent * (n + len(both) - shared):
                    parent[find(x)] = find(root)
                    found.append((x, y))
                    break
        mine = find(x)
        for token in prefix:
            index.setdefault(token, {}).setdefault(mine, []).append(x)
    return found


def _verify(percent: int, table: pa.Table) -> pa.Table:
    """Links of one group of cells."""
    cells, set_ids = table.column("cell").to_pylist(), table.column("set_id").to_pylist()
    sides, blobs = table.column("side").to_pylist(), table.column("tokens").to_pylist()
    by_cell: dict[int, dict[int, int]] = {}
    for row, cell in enumerate(cells):
        by_cell.setdefault(cell, {}).setdefault(set_ids[row], row)
    found: list[tuple[int, int]] = []
    for rows in by_cell.values():
        members = [rows[set_id] for set_id in sorted(rows)]
        tokens = [np.frombuffer(blobs[row], np.uint64) for row in members]
        for x, y in _links(tokens, [sides[row] for row in members], percent):
            found.append((set_ids[members[x]], set_ids[members[y]]))
    nodes, roots = forest(found)
    return pa.table({"a": pa.array(nodes, pa.int64()), "b": pa.array(roots, pa.int64())})


def _candidate_parts(sets: DataFrame, percent: int) -> DataFrame:
    """Rows (group_id, part): groups connected by candidate pairs."""
    # A little finer than the threshold, so rounding cannot part two sizes that fit.
    step = math.log(100 / max(1, percent - 1))
    postings = sets.where("prefix IS NOT NULL").select(
        F.explode("prefix").alias("token"), F.floor(F.log("n") / F.lit(step)).alias("scale"), "group_id"
    ).distinct()
    heads = postings.groupBy("token", "scale").agg(F.min("group_id").alias("head"), F.count(F.lit(1)).alias("groups"))
    heads = heads.checkpoint()
    stars = postings.join(heads.where("groups > 1"), ["token", "scale"])
    lower = heads.select("token", (F.col("scale") + 1).alias("scale"), F.col("head").alias("b"))
    between = heads.join(lower, ["token", "scale"]).select(F.col("head").alias("a"), "b")
    edges = stars.select(F.col("group_id").alias("a"), F.col("head").alias("b")).unionByName(between)
    return components(edges).select(F.col("node").alias("group_id"), F.col("root").alias("part"))


def _cells(reps: DataFrame, percent: int) -> tuple[DataFrame, int]:
    """Rows (cell, side, set_id, tokens): where each distinct set is compared; their shingles."""
    step = math.log(100 / max(1, percent - 1))
    reps = reps.withColumn("scale", F.floor(F.log("n") / F.lit(step)))
    narrow = reps.groupBy("part", "scale").agg(F.sum("n").alias("shingles"), F.count(F.lit(1)).alias("members"))
    narrow = narrow.checkpoint()
    parts = narrow.groupBy("part").agg(F.sum("shingles").alias("in_part"), F.sum("members").alias("members"))
    slabs = narrow.select("part", "scale", F.ceil(F.col("shingles") / F.lit(CELL_SHINGLES / 2)).alias("slabs"))
    near = slabs.select("part", (F.col("scale") - 1).alias("scale"), F.col("slabs").alias("above"))
    under = slabs.select("part", (F.col("scale") + 1).alias("scale"), F.col("slabs").alias("below"))
    plan = (
        slabs.join(parts.where("members > 1"), "part")
        .join(near, ["part", "scale"], "left")
        .join(under, ["part", "scale"], "left")
        .join(narrow.select("part", "scale", "shingles"), ["part", "scale"])
        .select("part", "scale", "in_part", "slabs", "shingles", F.coalesce("above", F.lit(0)).alias("above"),
                F.coalesce("below", F.lit(0)).alias("below"))
    )
    copies = F.when(F.col("in_part") <= CELL_SHINGLES, 1).otherwise(F.col("slabs") + F.col("above") + F.col("below"))
    planned = plan.agg(F.sum(F.col("shingles") * copies)).first()[0] or 0
    own = F.pmod(F.xxhash64("set_id"), F.col("slabs"))
    # Pairs of slabs: (scale, slab) with (scale, slab') and with (scale + 1, slab').
    same = F.transform(
        F.sequence(F.lit(0).cast("long"), F.col("slabs") - 1),
        lambda other: F.struct(
            F.xxhash64("part", "scale", F.least(other, own), F.greatest(other, own), F.lit(0)).alias("cell"),
            F.when(other == own, 0).otherwise((own > other).cast("int")).alias("side"),
        ),
    )
    up = F.transform(
        F.sequence(F.lit(0).cast("long"), F.col("above") - 1),
        lambda other: F.struct(F.xxhash64("part", "scale", own, other, F.lit(1)).alias("cell"), F.lit(0).alias("side")),
    )
    down = F.transform(
        F.sequence(F.lit(0).cast("long"), F.col("below") - 1),
        lambda other: F.struct(
            F.xxhash64("part", F.col("scale") - 1, other, own, F.lit(1)).alias("cell"), F.lit(1).alias("side")
        ),
    )
    none = F.array().cast("array<struct<cell:bigint,side:int>>")
    many = F.concat(same, F.when(F.col("above") > 0, up).otherwise(none), F.when(F.col("below") > 0, down).otherwise(none))
    single = F.array(F.struct(F.xxhash64("part").alias("cell"), F.lit(0).alias("side")))
    where = F.when(F.col("in_part") <= CELL_SHINGLES, single).otherwise(many)
    placed = reps.join(plan, ["part", "scale"]).select(F.explode(where).alias("to"), "set_id", "tokens")
    return placed.select("to.cell", "to.side", "set_id", "tokens"), planned


def similar_components(
    documents: DataFrame,
    ident: str = "doc_id",
    text: str = "text",
    size: int = SHINGLE,
    percent: int = PERCENT,
    block_bytes: int = BLOCK_BYTES,
) -> DataFrame:
    """One row for each row of ``documents``: ident, n_shingles, component_id.

    Two rows link if their shingle sets have a Jaccard similarity of percent or more;
    component_id is the least id reachable by links, the row's own included.

    * A-Z in lower case; a text of fewer words than ``size`` is one shingle; one without
      words, or null, has none and links with nothing.
    * Repeated rows have equal sets and link. A null id is larger than all others; it is
      null in the result. Other columns are ignored. An empty table gives an empty result.
    """
    blocks = B.count_blocks(documents, text, block_bytes)
    bits = min(64, max(32, (blocks * block_bytes // 4).bit_length() + KEY_BITS_OVER))
    job = Join(size, percent, blocks, bits)
    docs = B.in_blocks(documents, ident, text, blocks)
    ranks = (
        docs.groupBy("block")
        .applyInArrow(lambda table: job.send_counts(table), B.packed_schema("bucket", 2))
        .groupBy("bucket")
        .applyInArrow(lambda table: job.rank(table), B.packed_schema("block", 1))
    )
    sets = (
        docs.groupBy("block")
        .cogroup(ranks.groupBy("block"))
        .applyInArrow(lambda docs, told: job.sets(docs, told), SETS)
        .checkpoint()
    )
    parts = _candidate_parts(sets, percent)
    open_ = sets.where("set_id IS NOT NULL")
    # Null ids come last, so the least id of a class is null only if all are.
    least = open_.groupBy("set_id", "group_id", "n").agg(F.min("id").alias("least"))
    with_tokens = open_.where("tokens IS NOT NULL").groupBy("set_id", "group_id", "n").agg(
        F.min(F.coalesce("id", F.lit(B.LAST))).alias("holder")
    )
    # A group without partners may still hold several sets.
    reps = with_tokens.join(parts, "group_id", "left").select(
        F.coalesce("part", "group_id").alias("part"), "n", "set_id", F.col("holder").alias("key")
    )
    held = open_.where("tokens IS NOT NULL").select(
        "set_id", F.coalesce("id", F.lit(B.LAST)).alias("key"), "tokens"
    )
    reps = held.join(reps, ["set_id", "key"]).select("part", "n", "set_id", "tokens")
    cells, planned = _cells(reps, percent)
    # As many bins as the planned sets fill, so that what a task holds is bounded by a cell.
    groups = planned // BIN_SHINGLES + 1
    links = (
        cells.withColumn("bin", F.pmod(F.col("cell"), F.lit(groups)))
        .groupBy("bin")
        .applyInArrow(lambda table: _verify(percent, table), "a long, b long")
    )
    roots = components(links)
    classes = least.join(roots, least.set_id == roots.node, "left").select(
        "set_id", F.coalesce("root", "set_id").alias("root"), "least"
    )
    named = classes.groupBy("root").agg(F.min("least").alias("component_id"))
    classes = classes.join(named, "root").select("set_id", "component_id")
    found = open_.select("id", "n", "set_id").join(classes.distinct(), "set_id").select("id", "n", "component_id")
    alone = sets.where("set_id IS NULL").select("id", "n", F.col("id").alias("component_id"))
    return alone.unionByName(found).select(F.col("id").alias(ident), F.col("n").alias("n_shingles"), "component_id")


def keep_one_of_each(
    documents: DataFrame, ident: str = "doc_id", text: str = "text", size: int = SHINGLE, percent: int = PERCENT
) -> DataFrame:
    """The rows of ``documents`` whose id is the least of its component, all columns kept."""
    key = fresh_name(documents.columns, "key")
    found = similar_components(documents, ident, text, size, percent)
    stays = found.where(F.col(ident).eqNullSafe(F.col("component_id"))).select(F.col(ident).alias(key)).distinct()
    return documents.join(stays, F.col(ident).cast("long").eqNullSafe(F.col(key)), "left_semi")

