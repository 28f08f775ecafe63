"""Operator 13: the prefix trie of conversations.

Turns are hashed, numbered within their conversation and put together into one
row a conversation: its path of turn hashes.  Paths are range-partitioned in
lexicographic order and each task encodes its paths, block by block, as a
balanced-parentheses sequence: a node opens where it is first met and closes
after its subtree.  With the excess (opened minus closed) summed up in blocks
that keep their smallest and largest value, ``find_close`` delimits a subtree;
ranks of "()" pairs count leaves, and cumulative arrays in preorder give
members and saved tokens.

Only nodes on the path of a block's first or last conversation, its spines,
can also lie in other blocks.  Spine nodes are keyed by a hash of their path
and merged by an aggregate; what they add to their ancestors, all of which are
spine nodes too, is one row an ancestor.  Nothing else crosses blocks.

A path row holds at most ``LEVEL`` turns.  Longer conversations go on in a
trie of the next level, whose root is the node where the level before ends;
totals of these roots go up by pointer doubling.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from sheetcraft.llm.common import mix, prepare, written
from sheetcraft.operators.numbering import number_rows

LEVEL = 1024  # turns of a path row
BLOCK_TURNS = 1 << 19  # turns after which a block ends (paths are whole)
FAN = 64  # excess values of a block, and blocks of a node above
NO_ENDS = hashlib.sha256(b"").hexdigest()
_U = np.uint64
WORDS = r"[^\x20\x09-\x0D]+"


class Parentheses:
    """A balanced sequence (1 opens, 0 closes) with a range min-max tree over
    its excess."""

    def __init__(self, bits: np.ndarray):
        self.bits = bits
        self.excess = np.cumsum(2 * bits.astype(np.int32) - 1, dtype=np.int32)
        self.opened = np.concatenate(([0], np.cumsum(bits, dtype=np.int64)))
        self.low, self.high = [self.excess], [self.excess]
        while len(self.low[-1]) > 1:
            self.low.append(self._above(self.low[-1], np.iinfo(np.int32).max).min(axis=1))
            self.high.append(self._above(self.high[-1], np.iinfo(np.int32).min).max(axis=1))

    @staticmethod
    def _above(values: np.ndarray, fill: int) -> np.ndarray:
        rows = -(-len(values) // FAN)
        padded = np.full(rows * FAN, fill, dtype=values.dtype)
        padded[: len(values)] = values
        return padded.reshape(rows, FAN)

    def rank(self, at: np.ndarray) -> np.ndarray:
        """How many open before each place."""
        return self.opened[at]

    def find_close(self, opens: np.ndarray) -> np.ndarray:
        """Where each of the given parentheses closes: the next place whose
        excess is below its own, found up and down the tree.  As the excess
        moves by one, a node holds that value if it lies between its smallest
        and largest one."""
        out = np.empty(len(opens), dtype=np.int64)
        for a in range(0, len(opens), 1 << 14):
            out[a : a + (1 << 14)] = self._find(opens[a : a + (1 << 14)])
        return out

    def _find(self, opens: np.ndarray) -> np.ndarray:
        goal = self.excess[opens] - 1
        at, level = opens.astype(np.int64), np.zeros(len(opens), dtype=np.int64)
        pending, places = np.arange(len(opens)), np.arange(FAN)
        for k in range(len(self.low)):  # up, to the first node right of the path that holds the goal
            own = at[pending] // FAN * FAN
            cells = own[:, None] + places
            inside = cells < len(self.low[k])
            cells = np.minimum(cells, len(self.low[k]) - 1)
            wanted = goal[pending][:, None]
            hit = inside & (cells > at[pending][:, None]) & (self.low[k][cells] <= wanted) & (self.high[k][cells] >= wanted)
            found = hit.any(axis=1)
            at[pending[found]] = own[found] + hit[found].argmax(axis=1)
            level[pending[found]] = k
            pending = pending[~found]
            at[pending] //= FAN
            if not len(pending):
                break
        for k in range(len(self.low) - 1, 0, -1):  # down, to the first child that holds it
            some = np.flatnonzero(level == k)
            if len(some):
                cells = np.minimum(at[some][:, None] * FAN + places, len(self.low[k - 1]) - 1)
                wanted = goal[some][:, None]
                hit = (self.low[k - 1][cells] <= wanted) & (self.high[k - 1][cells] >= wanted)
                at[some] = at[some] * FAN + hit.argmax(axis=1)
                level[some] = k - 1
        return at


def path_keys(symbols: np.ndarray, starts: np.ndarray, places: np.ndarray) -> np.ndarray:
    """A hash of every prefix of every path; ``places`` counts from its start."""
    sums = np.cumsum(mix(symbols.view(_U) ^ mix(places.astype(_U) + _U(1))), dtype=_U)
    before = np.where(starts > 0, sums[starts - 1], _U(0))
    sizes = np.diff(np.append(starts, len(symbols)))
    return mix(sums - np.repeat(before, sizes) + places.astype(_U)).view(np.int64)


_NODE = pa.schema(
    [
        ("spine", pa.bool_()),
        ("key", pa.int64()),
        ("parent", pa.int64()),  # key of the parent, where it is on a spine
        ("parent_conv_id", pa.int64()),  # its smallest member, where it is not
        ("conv_id", pa.int64()),
        ("level", pa.int64()),
        ("place", pa.int64()),  # depth within the level
        ("n_convs", pa.int64()),
        ("n_children", pa.int64()),  # of spine nodes: without children on a spine
        ("n_leaves", pa.int64()),  # and without nodes on a spine, as the next
        ("saved", pa.int64()),
        ("words", pa.int64()),
        ("goes_on", pa.bool_()),  # in a trie of the next level
        ("ends_sha256", pa.string()),  # of nodes that are on no spine
        ("ends_from", pa.int64()),
        ("ends", pa.string()),  # of spine nodes: members that end here
        ("lineage", pa.list_(pa.int64())),  # of spine nodes: keys from the root to the node
    ]
)
_NODE_DDL = (
    "spine boolean, key long, parent long, parent_conv_id long, conv_id long, level long, place long, n_convs long,"
    " n_children long, n_leaves long, saved long, words long, goes_on boolean, ends_sha256 string, ends_from long,"
    " ends string, lineage array<long>"
)


def block_nodes(
    convs: np.ndarray, roots: np.ndarray, levels: np.ndarray, reached: np.ndarray, full: np.ndarray, goes: np.ndarray,
    sizes: np.ndarray, digests: np.ndarray, words: np.ndarray,
) -> pa.RecordBatch:
    """Nodes of the trie of some paths in lexicographic order.  ``digests``
    and ``words`` hold the turns of all paths; ``reached`` is the key of the
    node where a path that fills its level ends (``full``), which is the root
    of the next level for those that go on (``goes``)."""
    n = len(convs)
    lengths = sizes + 1  # with the root
    starts = np.cumsum(lengths) - lengths
    total = int(lengths.sum())
    places = np.arange(total) - np.repeat(starts, lengths)
    turn = np.ones(total, dtype=bool)
    turn[starts] = False
    symbols, cost = np.empty(total, dtype=np.int64), np.zeros(total, dtype=np.int64)
    symbols[starts], symbols[turn], cost[turn] = roots, digests, words
    # Common prefix with the path before.
    shift = np.concatenate(([0], starts[:-1]))
    other = np.repeat(np.concatenate(([0], lengths[:-1])), lengths)
    same = (places < other) & (symbols[np.minimum(np.repeat(shift, lengths) + places, total - 1)] == symbols)
    common = np.minimum.reduceat(np.where(same, np.repeat(lengths, lengths), places), starts)
    fresh = places >= np.repeat(common, lengths)
    at = np.flatnonzero(fresh)  # the node's first occurrence, in preorder
    m = len(at)
    opened = lengths - common
    by = np.repeat(np.arange(n), opened)
    last = np.cumsum(opened) - 1  # end node of each path
    depth = places[at]
    closes = np.cumsum(np.concatenate(([0], lengths[:-1] - common[1:])))
    opens = np.arange(m) + closes[by]
    bits = np.zeros(2 * m, dtype=np.uint8)
    bits[opens] = 1
    sequence = Parentheses(bits)
    close = sequence.find_close(opens)
    end = sequence.rank(close)  # one after the subtree, in preorder
    # Parents: the last node of the depth above before the node.
    by_depth = np.lexsort((np.arange(m), depth))
    ranked = depth[by_depth] * (m + 1) + by_depth
    above = np.searchsorted(ranked, (depth - 1) * (m + 1) + np.arange(m)) - 1
    parent = np.where(depth > 0, by_depth[np.maximum(above, 0)], -1)
    # Spines.
    spine = np.zeros(m, dtype=bool)
    spine[: lengths[0]] = True
    spine[depth == 0] = True  # roots of later levels are merged with nodes of the level above
    x = int(last[-1])
    while x >= 0:
        spine[x] = True
        x = int(parent[x])
    keys = path_keys(symbols, starts, places)[at]
    keys[depth == 0] = symbols[at][depth == 0]
    goes_on = np.zeros(m, dtype=bool)
    goes_on[last[goes]] = True
    keys[last[full]] = reached[full]
    held = np.concatenate(([0], np.cumsum(np.bincount(last, minlength=m))))
    members = held[end] - held[:m]
    lo = np.searchsorted(last, np.arange(m))
    bounds = np.column_stack((lo, lo + members)).ravel()
    least = np.minimum.reduceat(np.append(convs, np.iinfo(np.int64).max), bounds)[::2]
    inner = np.where(spine, 0, (members - 1) * cost[at])
    saved = np.concatenate(([0], np.cumsum(inner)))
    saved = saved[end] - saved[:m]
    pair = np.zeros(2 * m + 1, dtype=np.int64)  # "()" of nodes on no spine
    leaf = (bits[opens + 1] == 0) & ~spine & ~goes_on
    pair[opens + 1] = leaf
    pair = np.cumsum(pair)
    leaves = pair[close + 1] - pair[opens]
    children = np.bincount(parent[(parent >= 0) & ~spine], minlength=m)
    up_spine = (parent >= 0) & spine[parent]
    # Members that end at a node: paths are in the order of conversations.
    sha, first, text = np.full(m, NO_ENDS, dtype=object), np.full(m, None, dtype=object), np.full(m, None, dtype=object)
    ending = np.flatnonzero(~goes)
    cuts = np.flatnonzero(np.diff(last[ending])) + 1
    for own in np.split(ending, cuts) if len(ending) else []:
        node, listed = last[own[0]], ",".join(map(str, convs[own].tolist()))
        if spine[node]:
            first[node], text[node] = int(convs[own[0]]), listed
        else:
            sha[node] = hashlib.sha256(listed.encode()).hexdigest()
    sha[spine] = None
    lineage: list[list[int] | None] = [None] * m
    for x in np.flatnonzero(spine):
        lineage[x] = [*(lineage[parent[x]] if parent[x] >= 0 else []), int(keys[x])]
    hidden = ~up_spine
    columns = [
        pa.array(spine),
        pa.array(keys),
        pa.array(keys[parent], mask=hidden),
        pa.array(least[parent], mask=~hidden | (parent < 0)),
        pa.array(least),
        pa.array(levels[by]),
        pa.array(depth),
        pa.array(members),
        pa.array(children),
        pa.array(leaves),
        pa.array(saved),
        pa.array(cost[at]),
        pa.array(goes_on),
        pa.array(sha, pa.string()),
        pa.array(first, pa.int64()),
        pa.array(text, pa.string()),
        pa.array(lineage, pa.list_(pa.int64())),
    ]
    return pa.RecordBatch.from_arrays([c.cast(f.type) for c, f in zip(columns, _NODE)], schema=_NODE)


def _shards(batches) -> Iterator[pa.RecordBatch]:
    rows: list[pa.RecordBatch] = []
    size = 0
    for batch in batches:
        at = 0
        turns = np.cumsum(batch.column("size").to_numpy())
        while at < batch.num_rows:
            before = int(turns[at - 1]) if at else 0
            upto = max(at + 1, int(np.searchsorted(turns, before + BLOCK_TURNS - size, side="right")))
            rows.append(batch.slice(at, upto - at))
            size += int(turns[upto - 1]) - before + upto - at
            at = upto
            if size >= BLOCK_TURNS:
                yield from _encoded(rows)
                rows, size = [], 0
    if rows:
        yield from _encoded(rows)


def _encoded(rows: list[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    table = pa.Table.from_batches(rows).combine_chunks()
    plain = lambda name: table.column(name).to_numpy()
    flat = lambda name: table.column(name).combine_chunks().flatten().to_numpy()
    nodes = block_nodes(
        plain("conv"), plain("root"), plain("level"), plain("reached"), plain("full"),
        ~table.column("onward").is_null().to_numpy(), plain("size"), flat("digests"), flat("words"),
    )
    for at in range(0, nodes.num_rows, 1 << 14):
        yield nodes.slice(at, 1 << 14)


def _lineages(batches) -> Iterator[pa.RecordBatch]:
    """Keys of all nodes on paths that go on, each with the root that follows;
    the root of a later level stands in its own totals already."""
    for batch in batches:
        for row in batch.to_pylist():
            symbols = np.array([row["root"], *row["digests"]], dtype=np.int64)
            keys = path_keys(symbols, np.array([0]), np.arange(len(symbols)))
            keys[0], keys[-1] = row["root"], row["onward"]
            keys = keys[row["level"] > 0 :]
            yield pa.RecordBatch.from_arrays([pa.array(keys), pa.array(np.full(len(keys), row["onward"]))], ["key", "below"])


def _hashed_ends(batches) -> Iterator[pa.RecordBatch]:
    """One digest a key over its parts, which come in order."""
    now, digest, keys, found = None, None, [], []
    for batch in batches:
        for key, text in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
            if digest is None or key != now:
                if digest is not None:
                    keys.append(now)
                    found.append(digest.hexdigest())
                now, digest = key, hashlib.sha256(text.encode())
            else:
                digest.update(b"," + text.encode())
        yield pa.RecordBatch.from_arrays([pa.array(keys, pa.int64()), pa.array(found, pa.string())], ["key", "sha"])
        keys, found = [], []
    if digest is not None:
        yield pa.RecordBatch.from_arrays([pa.array([now], pa.int64()), pa.array([digest.hexdigest()])], ["key", "sha"])


def numbered_turns(rows: DataFrame) -> DataFrame:
    """``(conv, p, digest, words)`` of ``(conv, turn, role, text)``: p numbers
    the turns of a conversation, null turns first; turns of one number follow
    each other by role and text."""
    own = rows.select("conv", "turn", F.xxhash64("role", "text").alias("digest"), F.regexp_count("text", F.lit(WORDS)).cast("long").alias("words"))
    turns = written(own, "turns")
    tied = turns.groupBy("conv", "turn").agg(F.min("digest").alias("a"), F.max("digest").alias("z")).where("a <> z")
    tied = written(tied.select("conv", "turn"), "tied-turns")
    placed = turns.withColumn("place", F.lit(0).cast("bigint"))
    if not tied.isEmpty():
        same = (rows["conv"] == tied["conv"]) & rows["turn"].eqNullSafe(tied["turn"])
        ordered = number_rows(rows.join(tied, same, "left_semi"), ["conv", "turn"], ["role", "text"], "place")
        again = ordered.select("conv", "turn", F.xxhash64("role", "text").alias("digest"), F.regexp_count("text", F.lit(WORDS)).cast("long").alias("words"), "place")
        own_tie = (turns["conv"] == tied["conv"]) & turns["turn"].eqNullSafe(tied["turn"])
        placed = placed.join(tied, own_tie, "left_anti").unionByName(again)
    return written(number_rows(placed, ["conv"], ["turn", "place"], "p").select("conv", "p", "digest", "words"), "numbered-turns")


def rebuilt_turns(turns: DataFrame, shared: Column, base: Column) -> DataFrame:
    """``(conv, at, digest, words)``: the first ``shared`` turns of the
    conversation ``base`` and the conversation's own ones after as many; a row
    with ``at`` 0 for every conversation.  Both are columns over ``conv``."""
    convs = turns.select("conv").distinct().select("conv", shared.cast("long").alias("h"), base.alias("base"))
    most = convs.agg(F.max("h")).first()[0] or 0
    heads = turns.where(F.col("p") <= most).withColumnRenamed("conv", "base")
    taken = convs.join(heads, "base").where("p <= h")
    lent = taken.groupBy("conv").agg(F.count(F.lit(1)).alias("lent"))
    own = turns.join(convs.join(lent, "conv", "left"), "conv").where("p > h")
    at = F.col("p") - F.col("h") + F.coalesce("lent", F.lit(0))
    return (
        taken.select("conv", F.col("p").alias("at"), "digest", "words")
        .unionByName(own.select("conv", at.alias("at"), "digest", "words"))
        .unionByName(convs.select("conv", F.lit(0).cast("long").alias("at"), F.lit(0).cast("long").alias("digest"), F.lit(0).cast("long").alias("words")))
    )


def path_rows(rebuilt: DataFrame, level_turns: int) -> DataFrame:
    """One row a conversation and level: its turns in order, the key of the
    level's root and that of the next level's (``onward``), if it goes on."""
    level = F.floor((F.greatest(F.col("at"), F.lit(1)) - 1) / level_turns)
    parts = rebuilt.groupBy("conv", level.alias("level")).agg(
        F.sort_array(F.collect_list(F.when(F.col("at") > 0, F.struct("at", "digest", "words")))).alias("turns")
    )
    parts = parts.select("conv", "level", F.col("turns.digest").alias("digests"), F.col("turns.words").alias("words"))
    order = Window.partitionBy("conv").orderBy("level")
    part = F.xxhash64("level", "digests")
    so_far = F.bit_xor(part).over(order.rowsBetween(Window.unboundedPreceding, Window.currentRow))
    key = F.xxhash64(F.col("level"), so_far)
    root = F.coalesce(F.lag("reached").over(order), F.lit(0).cast("bigint"))
    onward = F.when(F.lead("level").over(order).isNotNull(), F.col("reached"))
    keyed = parts.withColumn("reached", key)
    size = F.size("digests").cast("long")
    return keyed.select(
        "conv", "level", root.alias("root"), "reached", onward.alias("onward"), size.alias("size"), (size == level_turns).alias("full"), "digests", "words"
    )


def _merged_spines(nodes: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Spine nodes, one row each, with whole totals, and the hash of the
    members that end at each."""
    same = ["parent", "place", "words", "lineage"]
    own = ["key", "level"]  # a node that goes on and the root of the next level share their key
    one = nodes.where("spine").groupBy(*own).agg(
        F.min("conv_id").alias("conv_id"),
        F.max("goes_on").alias("goes_on"),
        *[F.sum(c).alias(c) for c in ("n_convs", "n_children", "n_leaves", "saved")],
        *[F.any_value(c).alias(c) for c in same],
    )
    one = written(one, "spines")
    below = one.where("parent is not null").groupBy(F.col("parent").alias("key"), "level").agg(F.count(F.lit(1)).alias("more"))
    one = written(one.join(below, own, "left").withColumn("n_children", F.col("n_children") + F.coalesce("more", F.lit(0))).drop("more"), "spines")
    adds = one.select(
        F.explode("lineage").alias("key"),
        "level",
        ((F.col("n_children") == 0) & ~F.col("goes_on")).cast("long").alias("leaf"),
        ((F.col("n_convs") - 1) * F.col("words")).alias("own"),
    )
    adds = adds.groupBy(*own).agg(F.sum("leaf").alias("leaf"), F.sum("own").alias("own"))
    one = one.join(adds, own).withColumns({"n_leaves": F.col("n_leaves") + F.col("leaf"), "saved": F.col("saved") + F.col("own")}).drop("leaf", "own", "lineage")
    ends = nodes.where("ends is not null").select("key", "ends", "ends_from")
    parts = int(nodes.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    ends = ends.repartition(parts, "key").sortWithinPartitions("key", "ends_from").select("key", "ends")
    return written(one, "spines"), ends.mapInArrow(_hashed_ends, "key long, sha string")


def _level_totals(paths: DataFrame, spines: DataFrame) -> DataFrame:
    """``(key, leaves, saved, children)`` to add to nodes above roots of later
    levels.  Totals of roots go to the roots above them by pointer doubling:
    after k rounds a root has what lies less than 2**k levels below."""
    roots = spines.where("level > 0 and place = 0").select("key", "n_leaves", "saved", "n_children")
    ups = paths.where("onward is not null").select(F.col("onward").alias("key"), F.col("root").alias("up")).distinct()
    now = written(roots.join(ups, "key"), "level-roots")
    while not now.where("up <> 0").isEmpty():
        gained = now.where("up <> 0").groupBy(F.col("up").alias("key")).agg(F.sum("n_leaves").alias("l"), F.sum("saved").alias("s"))
        far = now.select(F.col("key").alias("up"), F.col("up").alias("above"))
        nxt = now.join(gained, "key", "left").join(far, "up", "left")
        now = written(
            nxt.select(
                "key",
                (F.col("n_leaves") + F.coalesce("l", F.lit(0))).alias("n_leaves"),
                (F.col("saved") + F.coalesce("s", F.lit(0))).alias("saved"),
                "n_children",
                F.coalesce("above", F.lit(0)).cast("long").alias("up"),
            ),
            "level-roots",
        )
    lines = paths.where("onward is not null").select("level", "root", "onward", "digests").dropDuplicates(["onward"])
    lines = lines.mapInArrow(_lineages, "key long, below long")
    totals = lines.join(now.withColumnRenamed("key", "below"), "below")
    return totals.groupBy("key").agg(
        F.sum("n_leaves").alias("more_leaves"),
        F.sum("saved").alias("more_saved"),
        F.sum(F.when(F.col("key") == F.col("below"), F.col("n_children"))).alias("more_children"),
    )


def prefix_trie(
    conversations: DataFrame,
    shared: Column | None = None,
    base: Column | None = None,
    level_turns: int = LEVEL,
) -> DataFrame:
    """One row a node of the trie of all conversations: ``conv_id`` (smallest
    member), ``depth``, ``parent_conv_id``, ``n_convs``, ``n_children``,
    ``n_leaves``, ``saved_tokens``, ``ends_sha256``.

    ``shared`` and ``base``, columns over ``conv``, make each conversation begin
    with the first ``shared`` turns of the conversation ``base`` in place of
    its own.  Null role or text is empty text; turns of one number follow each
    other by role and text, and repeated rows are turns of their own; rows
    without a conv_id belong to no conversation and are left out; only the four
    named columns are read; texts and conversations may have any length; an
    empty table has no node, not even the root.
    """
    spark = conversations.sparkSession
    prepare(spark)
    rows = conversations.select(
        F.col("conv_id").cast("long").alias("conv"),
        F.col("turn").cast("long").alias("turn"),
        F.coalesce(F.col("role").cast("string"), F.lit("")).alias("role"),
        F.coalesce(F.col("text").cast("string"), F.lit("")).alias("text"),
    ).where("conv is not null")
    turns = numbered_turns(rows)
    rebuilt = rebuilt_turns(turns, F.lit(0) if shared is None else shared, F.col("conv") if base is None else base)
    paths = written(path_rows(rebuilt, level_turns), "paths")
    parts = int(spark.conf.get("spark.sql.shuffle.partitions"))
    dealt = paths.repartitionByRange(parts, "root", "digests", "conv").sortWithinPartitions("root", "digests", "conv")
    nodes = written(dealt.mapInArrow(_shards, _NODE_DDL), "trie-nodes")
    spines, ends = _merged_spines(nodes)
    totals = ["conv_id", "level", "place", "n_convs", "n_children", "n_leaves", "saved"]
    inner = nodes.where("not spine").select("key", "parent", "parent_conv_id", "goes_on", *totals, "ends_sha256")
    outer = (
        spines.where("place > 0 or level = 0")
        .join(ends, "key", "left")
        .select("key", "parent", F.lit(None).cast("long").alias("parent_conv_id"), "goes_on", *totals, F.coalesce("sha", F.lit(NO_ENDS)).alias("ends_sha256"))
    )
    every = inner.unionByName(outer)
    # Smallest members of parents on spines, and of nodes that go on.
    above = spines.where("place > 0 or level = 0").unionByName(inner.where("goes_on"), allowMissingColumns=True)
    above = above.select(F.col("key").alias("parent"), F.col("conv_id").alias("up_conv"))
    every = every.join(above, "parent", "left")
    if not paths.where("onward is not null").isEmpty():
        every = every.join(_level_totals(paths, spines), "key", "left").withColumns(
            {
                "n_children": F.col("n_children") + F.coalesce("more_children", F.lit(0)),
                "n_leaves": F.col("n_leaves") + F.coalesce("more_leaves", F.lit(0)),
                "saved": F.col("saved") + F.coalesce("more_saved", F.lit(0)),
            }
        )
    return every.select(
        "conv_id",
        (F.col("level") * level_turns + F.col("place")).alias("depth"),
        F.coalesce("parent_conv_id", "up_conv").alias("parent_conv_id"),
        "n_convs",
        "n_children",
        "n_leaves",
        F.col("saved").alias("saved_tokens"),
        "ends_sha256",
    )
