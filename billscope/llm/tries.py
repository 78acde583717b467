"""The trie of conversation prefixes, with totals over subtrees, by depth bands.

A node is a distinct sequence of first turns. It is known by its depth and the sum of its turns' hashes, each taken
with its place, so a prefix costs a running sum and no conversation is gathered; a conversation longer than a task
is summed up in ranges. Everything about a node is then kept under its smallest member and its depth.

Subtree totals are rolled up in bands of ``BAND`` depths. A node is exploded only to its ancestors within its band,
which are the nodes of its smallest member's own path. That completes the lowest band; the totals of the nodes on top
of the bands form a tree of their own, which is ``BAND`` times lower and is rolled up in the same way, and each of its
completed totals is handed to the at most ``BAND`` nodes of the band above. So a row is exploded at most ``2 BAND``
times and there are as many rounds as digits in the depth to the base ``BAND``.

Turns are ordered by ``turn``, null first, then role and text digest. A null role or text is empty, rows without
``conv_id`` are no conversation's, and further columns are ignored. Repeated rows are turns of their own. Equal
conversations share all nodes. A conversation without turns belongs to the root only. An empty table gives no rows.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator, Sequence

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from billscope.llm.running import running_within
from billscope.work import materialise

BAND = 16
GROUP, OPENINGS = 100, 6
LISTED = 65_536  # ids that are joined to one text at most
HASH = "decimal(38,0)"


def numbered_turns(chats: DataFrame) -> DataFrame:
    """(conv_id, place, turn_digest, points) of every turn; places count from 0, points are its text's characters."""
    role, text = (F.coalesce(F.col(name).cast("string"), F.lit("")) for name in ("role", "text"))
    digest = F.sha2(F.concat_ws(":", F.length(role), F.concat(role, text)), 256)
    rows = chats.select(
        F.col("conv_id").cast("long").alias("conv_id"),
        F.col("turn").isNotNull().alias("has_turn"),
        F.col("turn").alias("turn"),
        role.alias("role"),
        digest.alias("turn_digest"),
        F.length(text).cast("long").alias("points"),
        F.monotonically_increasing_id().alias("row"),  # equal rows, which are as good in any order
    )
    order = ["has_turn", "turn", "role", "turn_digest", "row"]
    placed = running_within(rows.where("conv_id IS NOT NULL"), "conv_id", order, {"count": F.lit(1).cast("long")})
    return placed.select("conv_id", (F.col("count") - 1).alias("place"), "turn_digest", "points")


def with_shared_openings(turns: DataFrame, group: int = GROUP, openings: int = OPENINGS) -> tuple[DataFrame, DataFrame]:
    """Conversations that begin with the first turns of the first of their group, and the ids of all conversations.

    Conversation c takes h = crc32(c) % ``openings`` turns of conversation c - c % ``group`` (the remainder is never
    negative), as far as there are, and goes on with its own turns after its first h.
    """
    whole = turns.groupBy("conv_id").agg(F.count(F.lit(1)).alias("n"))
    first = F.col("conv_id") - F.pmod("conv_id", F.lit(group))
    taken = F.crc32(F.col("conv_id").cast("string").cast("binary")) % openings
    whole = materialise(whole.withColumns({"first": first, "h": taken}), "conversations")
    heads = whole.where("conv_id = first").select("first", F.col("n").alias("first_n"))
    whole = whole.join(heads, "first", "left").withColumn("shared", F.least("h", F.coalesce("first_n", F.lit(0))))
    whole = materialise(whole.select("conv_id", "first", "h", "shared"), "openings")
    some = turns.where((F.pmod("conv_id", F.lit(group)) == 0) & (F.col("place") < openings - 1))
    opened = whole.join(some.withColumnRenamed("conv_id", "first"), "first").where("place < h")
    opened = opened.select("conv_id", (F.col("place") + 1).alias("depth"), "turn_digest", "points")
    own = turns.join(whole, "conv_id").where("place >= h")
    own = own.select("conv_id", (F.col("shared") + F.col("place") - F.col("h") + 1).alias("depth"), "turn_digest", "points")
    return opened.unionByName(own), whole.select("conv_id")


def _hashed(depth: Column, digest: Column) -> Column:
    """88 bits for a turn at its place."""
    digits = F.sha2(F.concat_ws(":", depth, digest), 256)
    high, low = (F.conv(F.substr(digits, F.lit(at), F.lit(11)), 16, 10).cast("decimal(14,0)") for at in (1, 12))
    return (high * F.lit(1 << 44).cast("decimal(14,0)") + low).cast("decimal(28,0)")


def _listed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Sorted (node, conv_id) as rows (node, first, ids): comma-joined ids of a run of one node."""
    node, first, ids, out = None, 0, [], []
    for batch in batches:
        for own, conv in zip(batch["node"].to_pylist(), batch["conv_id"].to_pylist(), strict=True):
            if own != node or len(ids) >= LISTED:
                if ids:
                    out.append((node, first, ",".join(ids)))
                node, first, ids = own, conv, []
            ids.append(str(conv))
        if out:
            yield _rows(out, [pa.string(), pa.int64(), pa.string()], ["node", "first", "ids"])
            out = []
    if ids:
        yield _rows([(node, first, ",".join(ids))], [pa.string(), pa.int64(), pa.string()], ["node", "first", "ids"])


def _digests(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """SHA-256 of each node's lists, fed in their order, so that a task holds one list."""
    node, digest = None, None
    for batch in batches:
        out = []
        for own, ids in zip(batch["node"].to_pylist(), batch["ids"].to_pylist(), strict=True):
            if own == node:
                digest.update(b"," + ids.encode())
                continue
            if node is not None:
                out.append((node, digest.hexdigest()))
            node, digest = own, hashlib.sha256(ids.encode())
        if out:
            yield _rows(out, [pa.string(), pa.string()], ["node", "ends_sha256"])
    if node is not None:
        yield _rows([(node, digest.hexdigest())], [pa.string(), pa.string()], ["node", "ends_sha256"])


def _rows(rows: list[tuple], types: list[pa.DataType], names: list[str]) -> pa.RecordBatch:
    columns = [pa.array(values, kind) for values, kind in zip(zip(*rows, strict=True), types, strict=True)]
    return pa.RecordBatch.from_arrays(columns, names)


def list_digests(members: DataFrame) -> DataFrame:
    """(node, ends_sha256): digest of the comma-joined ids of each node, rising.

    Ids are sorted and joined in ranges, so a node that a third of all ids belong to is joined by many tasks; only the
    digest itself runs along its lists, in one task, which holds one of them.
    """
    ordered = members.repartitionByRange("node", "conv_id").sortWithinPartitions("node", "conv_id")
    lists = ordered.mapInArrow(_listed, "node string, first long, ids string")
    dealt = lists.repartition("node").sortWithinPartitions("node", "first")
    return dealt.mapInArrow(_digests, "node string, ends_sha256 string")


def _within_band(values: DataFrame, paths: DataFrame, sums: Sequence[str], band: int) -> DataFrame:
    """Totals of each node over the nodes below it in its band and itself; ``values`` is under (conv_id, level)."""
    below = values.select(F.col("conv_id"), F.col("level").alias("own"), F.floor(F.col("level") / band).alias("band"), *sums)
    above = paths.select("conv_id", "level", "node_id", F.floor(F.col("level") / band).alias("band"))
    pairs = below.join(above, ["conv_id", "band"]).where("level <= own")
    return pairs.select(F.col("node_id").alias("conv_id"), "level", *sums).groupBy("conv_id", "level").agg(*_sums(sums))


def _sums(names: Sequence[str]) -> list[Column]:
    return [F.sum(name).alias(name) for name in names]


def roll_up(values: DataFrame, prefixes: DataFrame, nodes: DataFrame, sums: Sequence[str], band: int, step: int = 1) -> DataFrame:
    """Totals of ``sums`` over the subtree of each node in ``values`` (conv_id, level, sums): all nodes, or band tops.

    Level n stands for depth ``1 + n * step``. ``prefixes`` has (conv_id, depth, key) of every prefix and ``nodes``
    the smallest member of each (depth, key).
    """
    top = F.col("level") % band == 0
    here = values.select("conv_id", F.floor(F.col("level") / band).alias("band"))
    over = values.where(top & (F.col("level") > 0)).select("conv_id", (F.floor(F.col("level") / band) - 1).alias("band"))
    level = ((F.col("depth") - 1) / step).cast("long")
    paths = prefixes.where((F.col("depth") - 1) % step == 0).withColumn("level", level)
    paths = paths.withColumn("band", F.floor(F.col("level") / band))
    paths = paths.join(here.unionByName(over).distinct(), ["conv_id", "band"], "left_semi").drop("band")
    named = nodes.select("depth", "key", F.col("conv_id").alias("node_id"))
    paths = materialise(paths.join(named, ["depth", "key"]).select("conv_id", "level", "node_id"), "paths")
    within = materialise(_within_band(values, paths, sums, band), "within-band")
    if within.where(F.col("level") >= band).isEmpty():
        return within
    tops = within.where(top).withColumn("level", F.floor(F.col("level") / band))
    whole = roll_up(tops, prefixes, nodes, sums, band, step * band)
    handed = whole.where("level > 0").select("conv_id", (F.col("level") - 1).alias("band"), *sums)
    above = paths.select("conv_id", "level", "node_id", F.floor(F.col("level") / band).alias("band"))
    handed = handed.join(above, ["conv_id", "band"]).select(F.col("node_id").alias("conv_id"), "level", *sums)
    total = within.unionByName(handed).groupBy("conv_id", "level").agg(*_sums(sums))
    return materialise(total, "subtree-totals")


def prefix_trie(turns: DataFrame, conversations: DataFrame, band: int = BAND) -> DataFrame:
    """A row per node of the trie of ``turns`` (conv_id, depth from 1, turn_digest, points).

    (conv_id, depth, parent_conv_id, n_convs, n_children, n_leaves, saved_tokens, ends_sha256); a node is named by its
    smallest member and its depth. ``conversations`` has every conv_id once, those without turns too.
    """
    none = F.lit(0).cast("long")
    weight = _hashed(F.col("depth"), F.col("turn_digest"))
    found = running_within(turns.withColumn("own", weight), "conv_id", ["depth"], {"key": F.col("own")})
    key = F.col("key").cast(HASH)
    found = found.select("conv_id", "depth", key.alias("key"), (key - F.col("own")).cast(HASH).alias("parent"), "points")
    prefixes = materialise(found, "prefixes")
    nodes = prefixes.groupBy("depth", "key").agg(
        F.min("conv_id").alias("conv_id"),
        F.count(F.lit(1)).alias("n_convs"),
        F.min("parent").alias("parent"),
        F.min("points").alias("points"),
    )
    nodes = materialise(nodes, "nodes")
    children = nodes.groupBy((F.col("depth") - 1).alias("depth"), F.col("parent").alias("key"))
    children = children.agg(F.count(F.lit(1)).alias("n_children"))
    counted = nodes.join(children, ["depth", "key"], "left").withColumn("n_children", F.coalesce("n_children", none))
    values = counted.select(
        "conv_id",
        (F.col("depth") - 1).alias("level"),
        "n_children",
        (F.col("n_children") == 0).cast("long").alias("n_leaves"),
        ((F.col("n_convs") - 1) * F.col("points")).alias("saved_tokens"),
        "n_convs",
        "depth",
        "key",
    )
    values = materialise(values, "values")
    sums = ["n_leaves", "saved_tokens"]
    totals = roll_up(values.select("conv_id", "level", *sums), prefixes, nodes, sums, band)

    first = conversations.agg(F.min("conv_id").alias("first"), F.count(F.lit(1)).alias("n")).first()
    ends = prefixes.groupBy("conv_id").agg(F.max(F.struct("depth", "key")).alias("end"))
    ends = conversations.join(ends, "conv_id", "left").select(
        "conv_id", F.coalesce("end.depth", none).alias("depth"), F.coalesce("end.key", none.cast(HASH)).alias("key")
    )
    ends = list_digests(ends.select(_name(F.col("depth"), F.col("key")).alias("node"), "conv_id"))

    # A node's parent holds the node's smallest member, so it is found along that member's own path.
    named = nodes.select("depth", "key", F.col("conv_id").alias("parent_conv_id"))
    way = prefixes.select("conv_id", "depth", "key").join(named, ["depth", "key"])
    way = way.select("conv_id", (F.col("depth") + 1).alias("depth"), "parent_conv_id")
    rows = values.drop(*sums).join(totals, ["conv_id", "level"])
    rows = rows.join(way, ["conv_id", "depth"], "left")
    top = F.when(F.col("depth") == 1, F.lit(first["first"])).otherwise(F.col("parent_conv_id"))
    node = _name(F.col("depth"), F.col("key")).alias("node")
    rows = rows.select("conv_id", "depth", top.alias("parent_conv_id"), "n_convs", "n_children", *sums, node)
    root = values.agg(
        F.lit(first["first"]).cast("long").alias("conv_id"),
        none.alias("depth"),
        F.lit(None).cast("long").alias("parent_conv_id"),
        F.lit(first["n"]).cast("long").alias("n_convs"),
        F.count_if(F.col("depth") == 1).alias("n_children"),
        F.greatest(F.coalesce(F.sum("n_leaves"), none), F.lit(1)).alias("n_leaves"),
        F.coalesce(F.sum("saved_tokens"), none).alias("saved_tokens"),
        _name(none, none.cast(HASH)).alias("node"),
    ).where("n_convs > 0")
    shown = rows.unionByName(root).join(ends, "node", "left")
    return shown.withColumn("ends_sha256", F.coalesce("ends_sha256", F.sha2(F.lit("").cast("binary"), 256))).drop("node")


def _name(depth: Column, key: Column) -> Column:
    return F.concat_ws(":", depth.cast("string"), key.cast("string"))
