"""A prefix trie of conversations as burst tries: containers of suffixes under trie heads, swept in sorted order.

A node stands for a sequence of first turns and is known by its depth and two xors of hashes of (turn, place). Conversations are cut into
strata of ``STRATUM`` turns; a conversation's piece in a stratum is a suffix in the container of its head, the node where the stratum
begins. Equal suffixes are one with a count, so that copies cost nothing. A container of more than ``limit`` suffixes bursts by the next
turn: its head gets a child for each turn, and what follows goes to the container of that child; until none is oversized. The containers
left are dealt to shards, each sorted and swept once: neighbours in the order share the nodes of their common prefix.

Totals of subtrees go from the deepest stratum up: a container's totals belong to its head, which is a node of the stratum above or a child
of a burst head. So rounds follow the depth of bursts and the longest conversation divided by ``STRATUM``, never the number of rows.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from graphloom.llm.common import releasing, written

#: Turns of a suffix at most.
STRATUM = 256
HEAD = ["depth", "h1", "h2"]
NUMBERED = "kind int, part int, conv_id long, pos long, key string, bytes long"


def _numbered(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Places of turns in their conversation within one range of the sorted turns; and at its end first and last conversation, the
    last one's rows, and whether it is the only one."""
    part, first, last, n = TaskContext.get().partitionId(), None, None, 0
    for batch in batches:
        conv = batch.column("conv_id").to_numpy()
        if not len(conv):
            continue
        edge = np.flatnonzero(np.concatenate([[True], conv[1:] != conv[:-1]]))
        size = np.diff(np.append(edge, len(conv)))
        pos = np.arange(len(conv)) - np.repeat(edge, size)
        if conv[0] == last:
            pos[: size[0]] += n
        first, last, n = conv[0] if first is None else first, conv[-1], int(pos[-1]) + 1
        yield pa.RecordBatch.from_arrays([pa.array(np.zeros(len(conv), np.int32)), pa.array(np.full(len(conv), part, np.int32)), batch.column("conv_id"), pa.array(pos), batch.column("key"), batch.column("bytes")], ["kind", "part", "conv_id", "pos", "key", "bytes"])
    if first is not None:
        ends = [[1, 2], [part] * 2, [first, last], [n, n], [None, None], [None, None]]
        yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(ends, (pa.int32(), pa.int32(), pa.int64(), pa.int64(), pa.string(), pa.int64()), strict=True)], ["kind", "part", "conv_id", "pos", "key", "bytes"])


def ordered_turns(conversations: DataFrame) -> DataFrame:
    """conv_id, pos (from 0), key (md5 of a turn's role and text) and bytes (of the text in UTF-8) for each turn with a conv_id.

    Turns are ordered by turn, null first, and within one turn by key. Places are counted in ranges of the sorted turns, so that one
    conversation may have any share of them.
    """
    role, text = F.coalesce("role", F.lit("")), F.coalesce("text", F.lit(""))
    key = F.md5(F.concat(F.octet_length(role).cast("string"), F.lit(":"), role, text))
    turns = conversations.filter("conv_id is not null").select(F.col("conv_id").cast("long").alias("conv_id"), "turn", key.alias("key"), F.octet_length(text).cast("long").alias("bytes"))
    order = ["conv_id", F.asc_nulls_first("turn"), "key"]
    found = written(turns.repartitionByRange(*order).sortWithinPartitions(*order).mapInArrow(releasing(_numbered), NUMBERED), "turns")
    before, carried = [], (None, 0)
    ends = sorted((r["part"], r["kind"], r["conv_id"], r["pos"]) for r in found.filter("kind > 0").collect())  # two rows per partition
    for (part, _, first, _), (_, _, last, n) in zip(ends[::2], ends[1::2], strict=True):
        more = carried[1] if first == carried[0] else 0
        if more:
            before.append((part, first, more))
        carried = (last, n + (more if last == first else 0))
    turns = found.filter("kind = 0").drop("kind")
    if before:
        ahead = conversations.sparkSession.createDataFrame(before, "part int, conv_id long, more long")
        turns = turns.join(F.broadcast(ahead), ["part", "conv_id"], "left").withColumn("pos", F.col("pos") + F.coalesce("more", F.lit(0)))
    return turns.select("conv_id", "pos", "key", "bytes")


def rebuilt_turns(turns: DataFrame, family: int = 5, most: int = 8) -> tuple[DataFrame, DataFrame]:
    """Conversations (conv_id, n turns), and their turns (conv_id, n, pos, key, bytes), rebuilt from ordered_turns().

    With h = crc32(conv_id in decimal) % (most + 1), a conversation c has the first h turns of conversation c - c % family, as far as
    there are, and then its own turns after the first h.
    """
    sizes = turns.groupBy("conv_id").agg(F.count(F.lit(1)).alias("own"))
    sizes = sizes.withColumns({"h": F.crc32(F.col("conv_id").cast("string")) % (most + 1), "base": F.col("conv_id") - F.col("conv_id") % family})
    bases = sizes.filter("conv_id = base").select("base", F.col("own").alias("of_base"))
    convs = sizes.join(bases, "base", "left").withColumn("head", F.least("h", F.coalesce("of_base", F.lit(0).cast("long"))))
    convs = written(convs.select("conv_id", "base", "h", "head", (F.col("head") + F.greatest(F.col("own") - F.col("h"), F.lit(0).cast("long"))).alias("n")), "conversations")
    own = turns.join(convs, "conv_id").filter("pos >= h").select("conv_id", "n", (F.col("pos") - F.col("h") + F.col("head")).alias("pos"), "key", "bytes")
    lent = turns.filter((F.col("pos") < most) & (F.col("conv_id") % family == 0)).withColumnRenamed("conv_id", "base")
    lent = lent.join(convs, "base").filter("pos < h").select("conv_id", "n", "pos", "key", "bytes")
    return convs.select("conv_id", "n"), own.unionByName(lent)


def _pieces(turns: DataFrame, stratum: int) -> DataFrame:
    """One row per conversation and stratum: its turns there, the head's hashes and those of its end."""
    hashed = turns.withColumns({"z1": F.xxhash64("key", "pos"), "z2": F.xxhash64("pos", F.reverse("key")), "stratum": F.floor(F.col("pos") / stratum)})
    rows = hashed.groupBy("conv_id", "stratum").agg(F.array_sort(F.collect_list(F.struct("pos", "z1", "z2", "bytes"))).alias("turns"), F.bit_xor("z1").alias("x1"), F.bit_xor("z2").alias("x2"), F.first("n").alias("n"))
    above = Window.partitionBy("conv_id").orderBy("stratum").rowsBetween(Window.unboundedPreceding, -1)
    rows = rows.withColumns({"h1": F.coalesce(F.bit_xor("x1").over(above), F.lit(0).cast("long")), "h2": F.coalesce(F.bit_xor("x2").over(above), F.lit(0).cast("long"))})
    return rows.select("conv_id", "stratum", (F.col("stratum") * stratum).alias("depth"), "h1", "h2", F.col("h1").bitwiseXOR(F.col("x1")).alias("e1"), F.col("h2").bitwiseXOR(F.col("x2")).alias("e2"), "n", *(F.col(f"turns.{c}").alias(c) for c in ("z1", "z2", "bytes")))


def _digests(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Of sorted ends: one digest per node, over the ids as they pass."""
    at, digest, out = None, None, []

    def emit() -> pa.RecordBatch:
        depth, z1, z2, text = zip(*out, strict=True)
        out.clear()
        return pa.RecordBatch.from_arrays([pa.array(depth, pa.int64()), pa.array(z1, pa.int64()), pa.array(z2, pa.int64()), pa.array(text, pa.string())], ["depth", "z1", "z2", "ends_sha256"])

    for batch in batches:
        keys = np.column_stack([batch.column(c).to_numpy() for c in ("depth", "z1", "z2")])
        ids = batch.column("conv_id").to_pylist()
        edge = np.flatnonzero(np.concatenate([[True], (keys[1:] != keys[:-1]).any(axis=1), [True]])) if len(ids) else np.zeros(1, np.int64)
        for a, b in zip(edge[:-1].tolist(), edge[1:].tolist(), strict=True):
            text = ",".join(map(str, ids[a:b])).encode()
            if (key := tuple(keys[a].tolist())) == at:
                digest.update(b"," + text)
                continue
            if at is not None:
                out.append((*at, digest.hexdigest()))
            at, digest = key, hashlib.sha256(text)
        if len(out) > 20_000:
            yield emit()
    if at is not None:
        out.append((*at, digest.hexdigest()))
    if out:
        yield emit()


NODES = "top boolean, depth long, z1 long, z2 long, conv_id long, parent_conv_id long, p1 long, p2 long, n_convs long, n_children long, n_leaves long, saved long"
SWEPT = f"total boolean, {NODES}"


def _swept(shard: pd.DataFrame) -> pd.DataFrame:
    """Nodes below the heads of some containers, and a row of totals for each head: children, leaves and saved bytes of its subtree."""
    cols = [shard[c].to_numpy(np.int64) for c in (*HEAD, "n", "least", "below_children", "below_leaves", "below_saved")]
    both = [np.column_stack([np.asarray(a, np.int64), np.asarray(b, np.int64)]) for a, b in zip(shard["z1"], shard["z2"], strict=True)]
    keys = [x.astype(">i8").tobytes() for x in both]
    sizes, out, totals = shard["bytes"].tolist(), [], []
    order = sorted(range(len(keys)), key=lambda i: (cols[0][i], cols[1][i], cols[2][i], keys[i]))
    n, least, b_children, b_leaves, b_saved = (c.tolist() for c in cols[3:])

    head, total, stack, before = None, None, [], None  # stack entries: [node number, bytes, n, least, children, leaves, saved]

    def pop(depth: int) -> None:
        while len(stack) > depth:
            number, size, count, low, children, leaves, saved = stack.pop()
            leaves, saved = leaves or 1, saved + (count - 1) * size
            out[number] += [low, count, children, leaves, saved]
            into = stack[-1] if stack else total
            into[2] += count
            into[3] = min(into[3], low)
            into[4] += 1
            into[5] += leaves
            into[6] += saved

    for i in order:
        own = tuple(int(c[i]) for c in cols[:3])
        z = both[i]
        if own != head:
            pop(0)
            head, before = own, None
            total = [-1, 0, 0, 2**63 - 1, 0, 0, 0]
            totals.append((head, total))
        common = 0
        if before is not None:
            k = min(len(z), len(before))
            differs = np.flatnonzero((z[:k] != before[:k]).any(axis=1))
            common = int(differs[0]) if len(differs) else k
        pop(common)
        path = np.bitwise_xor.accumulate(np.concatenate([[head[1:]], z]).astype(np.int64)).tolist()
        for d in range(common, len(z)):
            out.append([d == 0, head[0] + d + 1, *path[d + 1], stack[-1][0] if stack else -1, *path[d]])
            stack.append([len(out) - 1, int(sizes[i][d]), 0, 2**63 - 1, 0, 0, 0])
        end = stack[-1]
        end[2] += n[i]
        end[3] = min(end[3], least[i])
        end[4] += b_children[i]
        end[5] += b_leaves[i]
        end[6] += b_saved[i]
        before = z
    pop(0)
    nodes = pd.DataFrame(out, columns=["top", "depth", "z1", "z2", "parent", "p1", "p2", "conv_id", "n_convs", "n_children", "n_leaves", "saved"])
    parent, conv = nodes["parent"].to_numpy(np.int64), nodes["conv_id"].to_numpy(np.int64)
    nodes["parent_conv_id"] = np.where(parent < 0, 0, conv[np.maximum(parent, 0)]) if len(nodes) else parent
    rows = [(True, True, h[0], h[1], h[2], 0, 0, 0, 0, 0, t[4], t[5], t[6]) for h, t in totals]
    found = pd.DataFrame(rows, columns=["total", "top", "depth", "z1", "z2", "conv_id", "parent_conv_id", "p1", "p2", "n_convs", "n_children", "n_leaves", "saved"])
    return pd.concat([nodes.assign(total=False), found], ignore_index=True)[[c.split()[0] for c in SWEPT.split(", ")]]


def _total(df: DataFrame) -> DataFrame:
    return df.select("depth", F.col("z1").alias("t1"), F.col("z2").alias("t2"), F.col("n_children").alias("below_children"), F.col("n_leaves").alias("below_leaves"), F.col("saved").alias("below_saved"))


def prefix_trie(conversations: DataFrame, family: int = 5, most: int = 8, limit: int = 5_000, stratum: int = STRATUM, shard_turns: int = 200_000) -> DataFrame:
    """One row per node of the trie of all rebuilt conversations: conv_id (the least member), depth, parent_conv_id (the parent's conv_id, null
    for the root), n_convs (members), n_children, n_leaves (nodes without children in the subtree, its top included), saved_tokens (over the
    subtree, each node's n_convs - 1 times the bytes of its last text) and ends_sha256 (of the comma-joined ids, ascending, of the
    members that end there; of the empty string where none does).

    Conversations (conv_id, turn, role, text) are ordered by turn, null first, ties by the md5 of role and text, and rebuilt as in
    rebuilt_turns(). A null role or text is empty; rows without a conv_id take no part; repeated rows are turns of their own; other columns
    are ignored. A conversation without turns after that ends at the root. No conversations give no rows. Turns and nodes are told
    apart by 128-bit hashes.

    ``limit``: suffixes of a container before it bursts. ``shard_turns``: about so many turns are swept in one task.
    """
    convs, turns = rebuilt_turns(ordered_turns(conversations), family, most)
    pieces = written(_pieces(turns, stratum), "trie-pieces")
    last = pieces.filter(F.col("stratum") == F.floor((F.col("n") - 1) / stratum)).select(F.col("n").alias("depth"), F.col("e1").alias("z1"), F.col("e2").alias("z2"), "conv_id")
    none = [F.lit(0).cast("long").alias(c) for c in ("depth", "z1", "z2")]
    ends = last.unionByName(convs.filter("n = 0").select(*none, "conv_id"))
    ends = ends.repartition("z1", "z2").sortWithinPartitions("depth", "z1", "z2", "conv_id").mapInArrow(releasing(_digests), "depth long, z1 long, z2 long, ends_sha256 string")

    lists = ("z1", "z2", "bytes")
    suffixes = pieces.groupBy("stratum", *HEAD, "e1", "e2", F.size("z1").alias("size")).agg(F.count(F.lit(1)).alias("n"), F.min("conv_id").alias("least"), *(F.first(c).alias(c) for c in lists))
    suffixes = written(suffixes.withColumn("end", F.col("depth") + F.col("size")).drop("size"), "trie-suffixes")
    at_stratum = suffixes.filter(F.col("end") % stratum == 0).groupBy(F.col("end").alias("depth"), F.col("e1").alias("p1"), F.col("e2").alias("p2")).agg(F.min("least").alias("head_conv_id"))

    # bursts: rows of oversized containers go on below each next turn, which is a node
    left, calm, burst = suffixes, [], []
    while True:
        oversized = written(left.groupBy(*HEAD).agg(F.count(F.lit(1)).alias("rows")).filter(F.col("rows") > limit).select(*HEAD), "trie-oversized")
        if oversized.isEmpty():
            calm.append(left)
            break
        calm.append(left.join(oversized, HEAD, "left_anti").select(*left.columns))
        big = left.join(oversized, HEAD, "left_semi").withColumns({f"c{k}": F.col(f"h{k}").bitwiseXOR(F.col(f"z{k}")[0]) for k in (1, 2)})
        burst.append(written(big.groupBy("stratum", *HEAD, "c1", "c2").agg(F.sum("n").alias("n"), F.min("least").alias("least"), F.first(F.col("bytes")[0]).alias("size")), "trie-burst"))
        below = big.filter(F.size("z1") > 1).withColumns({c: F.slice(c, 2, stratum) for c in lists})
        left = written(below.select("stratum", (F.col("depth") + 1).alias("depth"), F.col("c1").alias("h1"), F.col("c2").alias("h2"), "e1", "e2", "n", "least", *lists, "end"), "trie-below")

    containers = calm[0]
    for more in calm[1:]:
        containers = containers.unionByName(more)
    found = suffixes.agg(F.max("stratum").alias("last"), F.coalesce(F.sum(F.size("z1")), F.lit(0)).alias("turns")).first()
    shards = max(1, -(-found["turns"] // shard_turns))
    nodes, totals = [], None
    for k in range(-1 if found["last"] is None else found["last"], -1, -1):
        rows = containers.filter(F.col("stratum") == k)
        if totals is None:
            rows = rows.withColumns({c: F.lit(0).cast("long") for c in ("below_children", "below_leaves", "below_saved")})
        else:
            rows = rows.join(_total(totals).withColumnRenamed("depth", "end_depth"), (F.col("end") == F.col("end_depth")) & (F.col("e1") == F.col("t1")) & (F.col("e2") == F.col("t2")), "left")
            rows = rows.fillna(0, ["below_children", "below_leaves", "below_saved"])
        rows = rows.select(*HEAD, "n", "least", *lists, "below_children", "below_leaves", "below_saved", F.pmod(F.xxhash64(*HEAD), F.lit(shards)).alias("shard"))
        swept = written(rows.groupBy("shard").applyInPandas(_swept, SWEPT), "trie-swept")
        nodes.append(swept.filter("not total").drop("total"))
        own = swept.filter("total").select("depth", "z1", "z2", "n_children", "n_leaves", "saved")
        totals = own if totals is None else own.unionByName(totals)
        for upper in reversed(burst):
            upper = upper.filter(F.col("stratum") == k).withColumn("node", F.col("depth") + 1)
            below = _total(totals).withColumnRenamed("depth", "t0")
            upper = upper.join(below, (F.col("node") == F.col("t0")) & (F.col("c1") == F.col("t1")) & (F.col("c2") == F.col("t2")), "left").fillna(0, ["below_children", "below_leaves", "below_saved"])
            upper = upper.withColumns({"leaves": F.greatest("below_leaves", F.lit(1).cast("long")), "saved": F.col("below_saved") + (F.col("n") - 1) * F.col("size")})
            upper = written(upper.select(*HEAD, "node", "c1", "c2", "n", "least", "below_children", "leaves", "saved"), "trie-upper")
            nodes.append(upper.select(F.lit(True).alias("top"), F.col("node").alias("depth"), F.col("c1").alias("z1"), F.col("c2").alias("z2"), F.col("least").alias("conv_id"), F.lit(0).cast("long").alias("parent_conv_id"), F.col("h1").alias("p1"), F.col("h2").alias("p2"), F.col("n").alias("n_convs"), F.col("below_children").alias("n_children"), F.col("leaves").alias("n_leaves"), "saved"))
            heads = upper.groupBy(*HEAD).agg(F.count(F.lit(1)).alias("n_children"), F.sum("leaves").alias("n_leaves"), F.sum("saved").alias("saved"))
            totals = totals.unionByName(heads.withColumnsRenamed({"h1": "z1", "h2": "z2"}))
        totals = written(totals.filter(F.col("depth") == k * stratum), "trie-totals")

    root = convs.agg(F.min("conv_id").alias("conv_id"), F.count(F.lit(1)).alias("n_convs")).filter("n_convs > 0")
    of_root = totals.select("n_children", "n_leaves", "saved") if totals is not None else convs.limit(0).select(*(F.lit(0).cast("long").alias(c) for c in ("n_children", "n_leaves", "saved")))
    root = root.join(F.broadcast(of_root), F.lit(True), "left").fillna(0, ["n_children", "saved"]).fillna(1, ["n_leaves"])
    top = root.select(*none, "conv_id", F.lit(None).cast("long").alias("parent_conv_id"), "n_convs", "n_children", "n_leaves", "saved")

    heads = at_stratum.unionByName(root.select(F.lit(0).cast("long").alias("depth"), F.lit(0).cast("long").alias("p1"), F.lit(0).cast("long").alias("p2"), F.col("conv_id").alias("head_conv_id")))
    for upper in burst:
        heads = heads.unionByName(upper.select((F.col("depth") + 1).alias("depth"), F.col("c1").alias("p1"), F.col("c2").alias("p2"), F.col("least").alias("head_conv_id")))
    heads = heads.dropDuplicates(["depth", "p1", "p2"]).withColumn("depth", F.col("depth") + 1)
    columns = ["depth", "z1", "z2", "conv_id", "parent_conv_id", "n_convs", "n_children", "n_leaves", "saved"]
    all_ = top
    for some in nodes:
        of_head = some.filter("top").drop("parent_conv_id").join(heads, ["depth", "p1", "p2"]).withColumnRenamed("head_conv_id", "parent_conv_id")
        all_ = all_.unionByName(some.filter("not top").select(*columns)).unionByName(of_head.select(*columns))
    out = all_.join(ends, ["depth", "z1", "z2"], "left")
    return out.select("conv_id", "depth", "parent_conv_id", "n_convs", "n_children", "n_leaves", F.col("saved").alias("saved_tokens"), F.coalesce("ends_sha256", F.sha2(F.lit("").cast("binary"), 256)).alias("ends_sha256"))
