"""Prefix trie of conversations: which first turns are shared, by whom, and what storing them once saves.

A turn is an id of fixed width, big-endian: twelve bytes of the digest of its role and text, four bytes with its characters.
A conversation is the string of its ids. Sorted over tasks by range, equal conversations collapsed first, the strings of a
task go into an adaptive radix tree, whose turn-aligned depths are the nodes. Only prefixes of a task's first and last
string can go on in other tasks; their parts are added up afterwards. Long conversations are cut into segments that go in
layers, the deepest first, so that neither a key nor a conversation has to fit anywhere whole.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass
from hashlib import sha256
from itertools import groupby

import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.taskcontext import TaskContext

from folioscope.llm.common import arrow_schema, columns, ready, stored
from folioscope.llm.radix import Entry, Node, Prefixes, insert

WIDTH = 16
NODES = (
    "part int, depth long, conv_id long, parent_conv_id long, n long, kids long, leaves long, saved long, ends long, chars long, "
    "sides int, node binary, parent binary, chain binary"
)


@dataclass(frozen=True)
class TrieParams:
    """``segment`` turns of a conversation go into one key; a task gets about ``task_turns`` turns; lists of members
    are hashed in pieces of ``piece`` ids."""

    segment: int = 4096
    task_turns: int = 200_000
    piece: int = 4096


def turn_id(role: Column, text: Column) -> Column:
    """Big-endian id of a turn; null role or text counts as empty."""
    role, text = (F.coalesce(c.cast("string"), F.lit("")) for c in (role, text))
    whole = F.concat(F.char_length(role).cast("string"), F.lit(":"), role, text)
    return F.unhex(F.concat(F.substring(F.sha2(whole, 256), 1, 24), F.lpad(F.hex(F.char_length(text)), 8, "0")))


def in_order(turns: DataFrame, tasks: int) -> DataFrame:
    """``conv_id, place, id``: the turns of every conversation numbered from 0, by turn (null first), then by id.

    Rows are dealt by ranges of conversation and turn, so a conversation of any length is spread; what stands before a
    task's first conversation in earlier tasks is added from one row per task.
    """
    spark = turns.sparkSession
    dealt = turns.repartitionByRange(tasks, "conv_id", "turn", "id").sortWithinPartitions("conv_id", "turn", "id").select("conv_id", "id")
    schema = "part int, conv_id long, place long, id binary"
    wanted = arrow_schema(spark, schema)

    def number(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        part, last, place = TaskContext.get().partitionId(), None, 0
        for batch in batches:
            convs, places = batch.column(0).to_pylist(), []
            for conv in convs:
                place = place + 1 if conv == last else 0
                last = conv
                places.append(place)
            yield columns([[part] * len(convs), batch.column(0), places, batch.column(1)], wanted)

    numbered = stored(dealt.mapInArrow(number, schema), "turn-places")
    edges = numbered.groupBy("part").agg(
        F.min("conv_id").alias("head"), F.max("conv_id").alias("tail"), F.max_by("place", F.struct("conv_id", "place")).alias("place")
    )
    # one row per task, whatever the table's size
    shifts, tail, before = [], None, 0
    for row in sorted(edges.collect(), key=lambda r: r["part"]):
        shift = before if row["head"] == tail else 0
        if shift:
            shifts.append((row["part"], row["head"], shift))
        before = row["place"] + 1 + (shift if row["head"] == row["tail"] else 0)
        tail = row["tail"]
    moved = spark.createDataFrame(shifts, "part int, conv_id long, shift long")
    joined = numbered.join(F.broadcast(moved), ["part", "conv_id"], "left")
    return joined.select("conv_id", (F.col("place") + F.coalesce("shift", F.lit(0))).alias("place"), "id")


def placed_turns(conversations: DataFrame, params: TrieParams = TrieParams()) -> DataFrame:
    """``conv_id, place, id`` of ``conv_id, turn, role, text``; rows without a conversation are left out."""
    given = conversations.where("conv_id is not null").select(
        F.col("conv_id").cast("long").alias("conv_id"), F.col("turn").cast("long").alias("turn"), turn_id(F.col("role"), F.col("text")).alias("id")
    )
    given = stored(given, "turns")
    return in_order(given, given.count() // params.task_turns + 1)


def present(conversations: DataFrame) -> DataFrame:
    """A row with null place and id for each conversation, so that one without turns is there as well."""
    return conversations.select("conv_id", F.lit(None).cast("long").alias("place"), F.lit(None).cast("binary").alias("id"))


def _segments(sequences: DataFrame, params: TrieParams) -> DataFrame:
    """``conv_id, layer, body, chain, next, last``: the ids of a conversation, ``segment`` at a time.

    ``chain`` stands for all segments before, ``next`` for this one as well (two 64-bit sums without carry of their digests,
    empty before the first). A conversation without turns has one empty segment.
    """
    layer = F.coalesce(F.expr(f"place div {params.segment}"), F.lit(0)).cast("long")
    rows = sequences.groupBy("conv_id", layer.alias("layer")).agg(
        F.array_sort(F.collect_list(F.when(F.col("place").isNotNull(), F.struct("place", "id")))).alias("ids")
    )
    body = F.unhex(F.array_join(F.transform("ids", lambda t: F.hex(t["id"])), ""))
    rows = stored(rows.select("conv_id", "layer", F.coalesce(body, F.unhex(F.lit(""))).alias("body")), "segments")
    # a conversation with a whole number of segments has no empty one after them
    deepest = rows.agg(F.max("layer").alias("layer")).first()["layer"]
    none = F.unhex(F.lit(""))
    if not deepest:
        return rows.select("*", none.alias("chain"), F.lit(None).cast("binary").alias("next"), F.lit(True).alias("last"))
    digest = F.sha2(F.concat("body", F.col("layer").cast("string").cast("binary")), 256)
    halves = [F.conv(F.substring(digest, at, 16), 16, -10).cast("long").alias(name) for at, name in ((1, "high"), (17, "low"))]
    by = Window.partitionBy("conv_id").orderBy("layer")
    upto = by.rowsBetween(Window.unboundedPreceding, 0)
    sums = [F.lpad(F.hex(F.bit_xor(c).over(upto)), 16, "0") for c in ("high", "low")]
    chained = rows.select("*", *halves).withColumn("next", F.unhex(F.concat(*sums)))
    return chained.select(
        "conv_id", "layer", "body", F.coalesce(F.lag("next").over(by), none).alias("chain"), "next", F.lead("layer").over(by).isNull().alias("last")
    )


def _plant(keys: DataFrame, tasks: int) -> DataFrame:
    """Nodes of the radix trees of all chains, as NODES; ``keys`` are distinct by ``chain`` and ``body``."""
    spark = keys.sparkSession
    dealt = keys.repartitionByRange(tasks, "chain", "body").sortWithinPartitions("chain", "body")
    wanted = arrow_schema(spark, NODES)

    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple]:
        for batch in batches:
            yield from zip(*(c.to_pylist() for c in batch.columns))

    def grow(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        part, head, waiting = TaskContext.get().partitionId(), True, None
        for chain, own in groupby(rows(batches), key=lambda r: r[0]):
            if waiting:
                yield from nodes_of(part, *waiting[:3], None)
            root, begin, body = Node(b""), None, b""
            for _, body, *entry in own:
                begin = body if begin is None else begin
                insert(root, body, Entry(*entry))
            waiting, head = (chain, root, begin if head else None, body), False
        if waiting:
            yield from nodes_of(part, *waiting)

    def nodes_of(part: int, chain: bytes, root: Node, begin: bytes | None, border: bytes | None) -> Iterator[pa.RecordBatch]:
        t = Prefixes(root, WIDTH, chain, (begin, border))
        for a in range(0, len(t.depth), 10_000):
            some = range(a, min(a + 10_000, len(t.depth)))
            marked = [t.parent[i] >= 0 and t.sides[t.parent[i]] > 0 for i in some]
            yield columns(
                [
                    [part] * len(some),
                    [t.depth[i] for i in some],
                    [t.first[i] for i in some],
                    [None if m or t.parent[i] < 0 else t.first[t.parent[i]] for i, m in zip(some, marked)],
                    *([c[i] for i in some] for c in (t.n, t.kids, t.leaves, t.saved, t.end, t.chars, t.sides)),
                    [t.key.get(i) for i in some],
                    [t.key[t.parent[i]] if m else None for i, m in zip(some, marked)],
                    [chain] * len(some),
                ],
                wanted,
            )

    return stored(dealt.mapInArrow(grow, NODES), "trie-nodes")


def _joined_up(nodes: DataFrame) -> DataFrame:
    """Whole nodes: parts of nodes on the border of tasks are added up and given to their children."""
    parts = stored(nodes.where("sides > 0"), "trie-borders")
    merged = parts.groupBy("node").agg(
        F.first("parent").alias("parent"), F.max("depth").alias("depth"), F.min("conv_id").alias("conv_id"), F.sum("n").alias("n"),
        F.sum("kids").alias("kids"), F.sum("leaves").alias("leaves"), F.sum("saved").alias("saved"), F.max("ends").alias("ends"),
        F.max("chars").alias("chars"), F.first("chain").alias("chain"),
    )
    border_kids = merged.where("parent is not null").groupBy(F.col("parent").alias("node")).agg(F.count("*").alias("more"))
    merged = merged.join(border_kids, "node", "left").withColumn("kids", F.col("kids") + F.coalesce("more", F.lit(0))).drop("more")
    merged = stored(merged, "trie-merged")
    # own share of a border node, on one of the paths that it lies on; sums along a path give its border descendants there
    paths = parts.select("part", "node", "depth", F.explode(F.filter(F.array(F.lit(1), F.lit(2)), lambda b: F.col("sides").bitwiseAND(b) > 0)).alias("path"))
    owner = paths.groupBy("node").agg(F.min(F.struct("part", "path")).alias("owner"))
    shares = merged.join(owner, "node").select(
        "node", F.col("owner.part").alias("part"), F.col("owner.path").alias("path"),
        (F.col("kids") == 0).cast("long").alias("leaf"), ((F.col("n") - 1) * F.col("chars")).alias("gain"),
    )
    down = Window.partitionBy("part", "path").orderBy(F.desc("depth")).rowsBetween(Window.unboundedPreceding, 0)
    along = paths.join(shares, ["node", "part", "path"], "left").select(
        "node", *(F.sum(F.coalesce(c, F.lit(0))).over(down).alias(c) for c in ("leaf", "gain"))
    )
    added = along.groupBy("node").agg(F.sum("leaf").alias("leaf"), F.sum("gain").alias("gain"))
    whole = merged.join(added, "node").withColumn("leaves", F.col("leaves") + F.col("leaf")).withColumn("saved", F.col("saved") + F.col("gain"))
    whole = stored(whole.drop("leaf", "gain"), "trie-whole")
    above = whole.select(F.col("node").alias("parent"), F.col("conv_id").alias("parent_conv_id"))
    border = whole.join(above, "parent", "left").select(*SHOWN)
    # a task's nodes meet its own border only, so that the root is no hot key
    near = parts.select("part", F.col("node").alias("parent")).distinct().join(above, "parent")
    inside = nodes.where("sides = 0")
    under = inside.where("parent is not null").drop("parent_conv_id").join(near.hint("merge"), ["part", "parent"]).select(*SHOWN)
    return inside.where("parent is null").select(*SHOWN).unionByName(under).unionByName(border)


def _end_lists(segments: DataFrame, tasks: int, params: TrieParams) -> DataFrame:
    """``ends, ends_sha256``: for each group of equal conversations its least id and the digest of its ids in order.

    Groups are cut into pieces by ranges of ids; the pieces of a group are hashed one after the other in constant memory.
    """
    spark = segments.sparkSession
    whole = segments.where("last").select(F.sha2(F.concat(F.col("chain"), F.lit(b":"), F.col("body")), 256).alias("same"), "conv_id")
    dealt = whole.repartitionByRange(tasks, "same", "conv_id").sortWithinPartitions("same", "conv_id")
    pieces_schema, list_schema = "same string, conv_id long, ids string", "ends long, ends_sha256 string"
    pieces_wanted, list_wanted = arrow_schema(spark, pieces_schema), arrow_schema(spark, list_schema)

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            same, convs = (c.to_pylist() for c in batch.columns)
            out = []
            for key, run in groupby(range(len(same)), key=same.__getitem__):
                run = list(run)
                for a in range(0, len(run), params.piece):
                    ids = [convs[i] for i in run[a : a + params.piece]]
                    out.append((key, ids[0], ",".join(map(str, ids))))
            yield columns(list(zip(*out)), pieces_wanted)

    def hashed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        last, least, digest = None, None, sha256()
        for batch in batches:
            done = []
            for key, conv, ids in zip(*(c.to_pylist() for c in batch.columns)):
                if key != last:
                    if last is not None:
                        done.append((least, digest.hexdigest()))
                    last, least, digest = key, conv, sha256(ids.encode())
                else:
                    digest.update(b"," + ids.encode())
            if done:
                yield columns(list(zip(*done)), list_wanted)
        if last is not None:
            yield columns([[least], [digest.hexdigest()]], list_wanted)

    pieces = dealt.mapInArrow(cut, pieces_schema)
    return pieces.repartition("same").sortWithinPartitions("same", "conv_id").mapInArrow(hashed, list_schema)


SHOWN = ("depth", "conv_id", "parent_conv_id", "n", "kids", "leaves", "saved", "ends", "chain")
EMPTY = "depth long, conv_id long, parent_conv_id long, n long, kids long, leaves long, saved long, ends long"
TOTALS = ("kids", "leaves", "saved")


def _tails(alone: DataFrame) -> DataFrame:
    """Nodes of chains with a single conversation: one path with nothing to save."""
    turns = (F.length("body") / WIDTH).cast("long")
    path = alone.withColumn("depth", F.explode(F.sequence(F.lit(1).cast("long"), turns)))
    ends = F.col("last") & (F.col("depth") == turns)
    one, zero = F.lit(1).cast("long"), F.lit(0).cast("long")
    return path.select(
        "depth", "conv_id", F.col("conv_id").alias("parent_conv_id"), one.alias("n"), F.when(ends, zero).otherwise(one).alias("kids"),
        one.alias("leaves"), zero.alias("saved"), F.when(ends, F.col("conv_id")).alias("ends"), "chain", "layer",
    )


def _lower_layers(keys: DataFrame, alone: DataFrame, tasks: dict[int, int]) -> tuple[list[DataFrame], DataFrame]:
    """Nodes of all layers but the first, with their depth in the layer, and the totals that each chain adds above it."""
    one, zero = F.lit(1).cast("long"), F.lit(0).cast("long")
    single = alone.select(F.col("chain").alias("next"), one.alias("_kids"), one.alias("_leaves"), zero.alias("_saved"))
    below, found = single, [_tails(alone)]
    for layer in sorted((k for k in tasks if k), reverse=True):
        nodes = _layer(keys.where(F.col("layer") == layer), below, tasks[layer])
        # the root of a chain is the last node of the layer above, and shown there
        found.append(nodes.where("depth > 0").withColumn("layer", F.lit(layer).cast("long")))
        below = nodes.where("depth = 0").select(F.col("chain").alias("next"), *(F.col(c).alias(f"_{c}") for c in TOTALS)).unionByName(single)
    return found, below


def _layer(keys: DataFrame, below: DataFrame | None, tasks: int) -> DataFrame:
    """Nodes of one layer; ``below`` has the totals of the chains that start after it."""
    zero = F.lit(0).cast("long")
    if below is not None:
        keys = keys.join(below, "next", "left")
    totals = [(F.coalesce(F.col(f"_{c}"), zero) if below is not None else zero).alias(c) for c in TOTALS]
    return stored(_joined_up(_plant(keys.select("chain", "body", "n", "first", "ends", *totals), tasks)), "trie")


def prefix_trie(sequences: DataFrame, params: TrieParams = TrieParams()) -> DataFrame:
    """Nodes of the prefix trie of ``sequences`` (``conv_id, place, id``; a row with null place for every conversation).

    ``conv_id`` (least member), ``depth``, ``parent_conv_id``, ``n_convs``, ``n_children``, ``n_leaves``, ``saved_tokens`` and
    ``ends_sha256``, all totals over whole subtrees. Places run from 0 without gaps; conversations without turns belong to the
    root only. No conversations give no rows. There is one round per ``segment`` turns that two conversations share.
    """
    spark = sequences.sparkSession
    ready(spark)
    segments = stored(_segments(sequences, params), "chained")
    members = segments.where("layer > 0").groupBy("chain").agg((F.count("*") == 1).alias("alone"))
    deep = bool(segments.where("layer > 0").limit(1).count())
    if deep:
        segments = stored(segments.join(members, "chain", "left").withColumn("alone", F.coalesce("alone", F.lit(False))), "chained")
    shared = segments.where("not alone") if deep else segments
    sizes = shared.groupBy("layer").agg(F.count("*").alias("rows"), F.sum(F.length("body")).alias("bytes")).collect()
    tasks = {r["layer"]: (r["bytes"] // WIDTH + r["rows"]) // params.task_turns + 1 for r in sizes}
    if not tasks:
        whole = spark.createDataFrame([], EMPTY)
    else:
        keys = shared.groupBy("layer", "chain", "body").agg(
            F.count("*").alias("n"), F.min("conv_id").alias("first"), F.min(F.when(F.col("last"), F.col("conv_id"))).alias("ends"),
            F.max(F.when(~F.col("last"), F.col("next"))).alias("next"),
        )
        keys = stored(keys, "trie-keys")
        lower, below = _lower_layers(keys, segments.where("alone"), tasks) if deep else ([], None)
        whole = _layer(keys.where("layer = 0"), below, tasks[0]).select(*SHOWN[:-1])
        # a chain's first node hangs below a node that conversations without the chain may end at
        above = keys.where("next is not null").select(F.col("next").alias("chain"), "first")
        for part in lower:
            hung = part.join(above, "chain", "left").withColumn(
                "parent_conv_id", F.when((F.col("depth") == 1) & F.col("first").isNotNull(), F.col("first")).otherwise(F.col("parent_conv_id"))
            )
            whole = whole.unionByName(hung.withColumn("depth", F.col("depth") + F.col("layer") * params.segment).select(*SHOWN[:-1]))
    lists = _end_lists(segments, sum(tasks.values()) or 1, params)
    return whole.join(lists.hint("merge"), "ends", "left").select(
        "conv_id", "depth", "parent_conv_id", F.col("n").alias("n_convs"), F.col("kids").alias("n_children"), F.col("leaves").alias("n_leaves"),
        F.col("saved").alias("saved_tokens"), F.coalesce("ends_sha256", F.sha2(F.lit(""), 256)).alias("ends_sha256"),
    )


def conversation_trie(conversations: DataFrame, params: TrieParams = TrieParams()) -> DataFrame:
    """Prefix trie of conversations as they are (``conv_id, turn, role, text``).

    Turns are ordered by turn, null first, turns of one number by their ids; repeated rows are turns of their own. Null role or
    text counts as empty, rows without a conversation are left out, other columns are not read.
    """
    ready(conversations.sparkSession)
    placed = placed_turns(conversations, params)
    return prefix_trie(placed.unionByName(present(placed.where("place = 0"))), params)
