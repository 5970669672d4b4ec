"""Prefix trie of conversations by burst tries.

A conversation is a sequence of turns, cut into segments of at most SEGMENT turns. A
suffix is what is left of a segment under a trie head, the node that its prefix ends
at; equal suffixes are one row with a count from the start, so a group of copies never
fills a container. All suffixes under one head are a container. A container of more
than CONTAINER different suffixes bursts: every suffix moves by its next turn to the
container of the head one turn deeper. What remains is small: shards (tasks) hold whole
containers, sort their suffixes and sweep them into nodes with one stack.

A node is identified by 128 bits, the exclusive or of a hash of (depth, turn) along its
path, so that heads are known without walking there. Sums over a subtree leave a
container by its head: burst heads add up their children level by level, at most
SEGMENT levels; the head of a later segment lies on the path of its smallest member,
and its sums are handed to that member's earlier segments, whatever their number."""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from replyscope.llm.common import map_batches, own_scratch, stored
from replyscope.operators.ordering import dense_positions

SEGMENT = 64  # turns of a suffix
CONTAINER = 4_096  # different suffixes under a head that one task sweeps
BLOCK = 12  # bits of a conversation's number that its members' list is cut by
GRAFTS = 6  # shared turns of a conversation: fewer than this
FAMILY = 100

HEAD = ["segment", "head_a", "head_b"]
SUFFIX = [*HEAD, "depth", "turns", "members", "conv", "more", "below_leaves", "below_saved"]
SUMS = "conv long, members long, children long, leaves long, saved long, more boolean"
NODES = f"head boolean, segment int, a long, b long, depth int, up_a long, up_b long, parent_conv long, size long, {SUMS}"


def turns_of(conversations: DataFrame, key: str = "conv_id", turn: str = "turn", role: str = "role", text: str = "text") -> DataFrame:
    """(conv, at, turn_a, turn_b, size): the turns of every conversation with their
    place from 0. Turns are ordered by number, null first, then by role and text;
    null role and text are empty. Repeated rows are turns of their own; rows without a
    conversation are left out. Places are dealt by ranges, not by conversation."""
    rows = conversations.filter(F.col(key).isNotNull()).select(
        F.col(key).cast("long").alias("conv"), F.col(turn).alias("turn"),
        F.coalesce(F.col(role).cast("string"), F.lit("")).alias("role"), F.coalesce(F.col(text).cast("string"), F.lit("")).alias("text"),
    )
    placed = dense_positions(rows, [F.col("conv"), F.col("turn").asc_nulls_first(), F.col("role"), F.col("text")], "place")
    hashed = placed.select(
        "conv", "place", F.xxhash64("role", "text").alias("turn_a"), F.xxhash64(F.lit("turn"), "text", "role").alias("turn_b"),
        F.length("text").cast("long").alias("size"),
    )
    hashed = stored(hashed, "turns")
    first = hashed.groupBy("conv").agg(F.min("place").alias("first"))
    return hashed.join(first, "conv").select("conv", (F.col("place") - F.col("first")).cast("int").alias("at"), "turn_a", "turn_b", "size")


def regrown(turns: DataFrame, grafts: int = GRAFTS, family: int = FAMILY) -> tuple[DataFrame, DataFrame]:
    """Conversations that share beginnings: (conv, depth, turn_a, turn_b, size) and
    (conv, n). Conversation c starts with the first h turns of conversation
    c - c % family, h = crc32(c as text) % grafts; its own turns after its first h follow."""
    turns = stored(turns, "turns")
    convs = turns.groupBy("conv").agg(F.count(F.lit(1)).alias("own"))
    shared = F.crc32(F.col("conv").cast("string").cast("binary")) % grafts
    convs = convs.select("conv", "own", shared.alias("h"), (F.col("conv") - F.pmod("conv", F.lit(family))).alias("stem"))
    stems = convs.select(F.col("conv").alias("stem"), F.col("own").alias("stem_turns"))
    convs = convs.join(stems, "stem", "left").withColumn("have", F.least("h", F.coalesce("stem_turns", F.lit(0))))
    convs = stored(convs.withColumn("n", F.col("have") + F.greatest(F.col("own") - F.col("h"), F.lit(0))), "conversations")
    starts = turns.filter(F.col("at") < grafts - 1).withColumnRenamed("conv", "stem")
    start = convs.filter("have > 0").select("conv", "stem", "have").join(starts, "stem").filter("at < have")
    columns = ["conv", "depth", "turn_a", "turn_b", "size"]
    own = turns.join(convs.select("conv", "h", "have"), "conv").filter("at >= h")
    own = own.withColumn("depth", (F.col("have") + F.col("at") - F.col("h") + 1).cast("int"))
    rows = start.withColumn("depth", F.col("at") + 1).select(*columns).unionByName(own.select(*columns))
    return rows, convs.select("conv", "n")


def _segments(rows: DataFrame, convs: DataFrame, segment: int) -> DataFrame:
    """(conv, segment, head_a, head_b, end_a, end_b, turns, more) of every conversation."""
    marked = rows.select(
        "conv", ((F.col("depth") - 1) / segment).cast("int").alias("segment"), "depth",
        F.xxhash64("depth", "turn_a", "turn_b").alias("a"), F.xxhash64("turn_b", "depth", "turn_a").alias("b"), "size",
    )
    cut = marked.groupBy("conv", "segment").agg(
        F.array_sort(F.collect_list(F.struct("depth", "a", "b", "size"))).alias("turns"),  # at most `segment` turns
        F.bit_xor("a").alias("xor_a"), F.bit_xor("b").alias("xor_b"),
    )
    turns = F.transform("turns", lambda t: F.struct(t["a"].alias("a"), t["b"].alias("b"), t["size"].alias("size")))
    silent = convs.filter("n = 0").select("conv", F.lit(0).alias("segment"), F.expr("filter(array(struct(0L AS a, 0L AS b, 0L AS size)), t -> false)").alias("turns"))
    silent = silent.select("*", F.lit(0).cast("long").alias("xor_a"), F.lit(0).cast("long").alias("xor_b"))
    cut = cut.withColumn("turns", turns).unionByName(silent)
    upto = Window.partitionBy("conv").orderBy("segment")
    cut = cut.join(convs, "conv").select(
        "conv", "segment", F.bit_xor("xor_a").over(upto).alias("end_a"), F.bit_xor("xor_b").over(upto).alias("end_b"), "xor_a", "xor_b",
        "turns", (F.col("n") > (F.col("segment") + 1) * segment).alias("more"),
    )
    head = [F.col("end_a").bitwiseXOR(F.col("xor_a")).alias("head_a"), F.col("end_b").bitwiseXOR(F.col("xor_b")).alias("head_b")]
    return cut.select("conv", "segment", *head, "end_a", "end_b", "turns", "more")


def _suffixes(segments: DataFrame, segment: int) -> DataFrame:
    """Equal segments under a head as one suffix."""
    first = segments.groupBy(*HEAD, "end_a", "end_b", "more").agg(
        F.first("turns").alias("turns"), F.count(F.lit(1)).alias("members"), F.min("conv").alias("conv"),
        F.sum("below_leaves").alias("below_leaves"), F.sum("below_saved").alias("below_saved"),
    )
    return first.withColumn("depth", (F.col("segment") * segment).cast("int")).select(*SUFFIX)


def _grown(suffixes: DataFrame, container: int) -> DataFrame:
    """All nodes of the containers (NODES); `head` rows sum up a container's head,
    without that node's own turn, and come once for every head of a segment."""
    open_, whole, levels = suffixes, [], []
    while True:
        sizes = open_.filter(F.size("turns") > 0).groupBy(*HEAD).agg(F.count(F.lit(1)).alias("n")).filter(F.col("n") > container)
        sizes = stored(sizes.select(*HEAD), "oversized")
        if sizes.isEmpty():
            whole.append(open_)
            break
        whole.append(open_.join(sizes, HEAD, "left_anti"))
        bursting = open_.join(sizes, HEAD, "left_semi")
        ended = bursting.filter(F.size("turns") == 0)
        turn = F.get("turns", F.lit(0))
        moved = bursting.filter(F.size("turns") > 0).select(
            "segment", F.col("head_a").alias("from_a"), F.col("head_b").alias("from_b"),
            F.col("head_a").bitwiseXOR(turn["a"]).alias("head_a"), F.col("head_b").bitwiseXOR(turn["b"]).alias("head_b"),
            (F.col("depth") + 1).alias("depth"), turn["size"].alias("size"), F.slice("turns", 2, 1 << 30).alias("turns"),
            "members", "conv", "more", "below_leaves", "below_saved",
        )
        moved = stored(moved, "burst")
        links = moved.groupBy(*HEAD, "from_a", "from_b").agg(F.first("depth").alias("depth"), F.first("size").alias("size"))
        levels.append((stored(links, "links"), ended))
        open_ = moved.select(*SUFFIX)
    remaining = whole[0]
    for part in whole[1:]:
        remaining = remaining.unionByName(part)
    swept = stored(_swept(remaining), "nodes")
    known = swept.filter("head")
    parts = [swept.filter("NOT head")]
    for links, ended in reversed(levels):
        heads = known.select("segment", F.col("a").alias("head_a"), F.col("b").alias("head_b"), "conv", "members", "children", "leaves", "saved", "more")
        leaf = (F.col("children") == 0) & ~F.col("more")
        below = stored(
            links.join(heads, HEAD).withColumn("leaves", F.col("leaves") + leaf.cast("long"))
            .withColumn("saved", F.col("saved") + (F.col("members") - 1) * F.col("size")),
            "below",
        )
        one = F.lit(1).cast("long")
        up = below.select("segment", F.col("from_a").alias("a"), F.col("from_b").alias("b"), (F.col("depth") - 1).alias("depth"), "conv", "members", one.alias("children"), "leaves", "saved", F.lit(False).alias("more"))
        stay = ended.select("segment", F.col("head_a").alias("a"), F.col("head_b").alias("b"), "depth", "conv", "members", (one - 1).alias("children"), F.col("below_leaves").alias("leaves"), F.col("below_saved").alias("saved"), "more")
        sums = up.unionByName(stay).groupBy("segment", "a", "b").agg(
            F.first("depth").alias("depth"), F.min("conv").alias("conv"), *[F.sum(c).alias(c) for c in ("members", "children", "leaves", "saved")], F.max("more").alias("more"),
        )
        sums = stored(sums, "heads")
        parents = sums.select("segment", F.col("a").alias("from_a"), F.col("b").alias("from_b"), F.col("conv").alias("parent_conv"))
        nodes = below.withColumnsRenamed({"head_a": "a", "head_b": "b"}).join(parents, ["segment", "from_a", "from_b"])
        parts.append(nodes.withColumnsRenamed({"from_a": "up_a", "from_b": "up_b"}).withColumn("head", F.lit(False)))
        gone = links.select("segment", F.col("head_a").alias("a"), F.col("head_b").alias("b"))
        none = F.lit(None).cast("long")
        known = known.join(gone, ["segment", "a", "b"], "left_anti").unionByName(
            sums.select(F.lit(True).alias("head"), "*", *[none.alias(c) for c in ("up_a", "up_b", "parent_conv")], (one - 1).alias("size")).select(*known.columns)
        )
        known = stored(known, "known")
    parts.append(known)
    columns = swept.columns
    nodes = parts[0].select(*columns)
    for part in parts[1:]:
        nodes = nodes.unionByName(part.select(*columns))
    return nodes


def sweep(rows: list[tuple]) -> Iterator[tuple]:
    """The nodes of one container from its sorted suffixes (turns, members, conv,
    more, leaves below, sums below): (node, parent's place) with a node as the list
    [a, b, depth below the head, size, conv, members, children, leaves, saved, more];
    place 0 is the head."""
    head = [0, 0, 0, 0, None, 0, 0, 0, 0, False]
    nodes, parents, path, last = [head], [-1], [0], []

    def close() -> None:
        at = path.pop()
        node = nodes[at]
        if not node[6] and not node[9]:
            node[7] += 1
        node[8] += (node[5] - 1) * node[3]
        above = nodes[path[-1]]
        above[4] = node[4] if above[4] is None else min(above[4], node[4])
        above[5] += node[5]
        above[7] += node[7]
        above[8] += node[8]

    for turns, members, conv, more, leaves, saved in rows:
        common = 0
        while common < min(len(last), len(turns)) and last[common][:2] == turns[common][:2]:
            common += 1
        while len(path) - 1 > common:
            close()
        for depth in range(common, len(turns)):
            a, b, size = turns[depth]
            above = nodes[path[-1]]
            above[6] += 1
            parents.append(path[-1])
            path.append(len(nodes))
            nodes.append([above[0] ^ a, above[1] ^ b, depth + 1, size, None, 0, 0, 0, 0, False])
        end = nodes[path[-1]]
        end[4] = conv if end[4] is None else min(end[4], conv)
        end[5] += members
        end[7] += leaves
        end[8] += saved
        end[9] = end[9] or more
        last = turns
    while len(path) > 1:
        close()
    return zip(nodes, parents)


def _swept(suffixes: DataFrame) -> DataFrame:
    """Sorts the containers of every shard and sweeps them into nodes."""
    dealt = suffixes.repartition(*HEAD).sortWithinPartitions(*HEAD, "turns", "more")

    def run(parts: Iterator[dict]) -> Iterator[dict]:
        names = [f.split()[0] for f in NODES.split(", ")]
        out: list[tuple] = []

        def close(head: tuple, held: list[tuple]) -> None:
            segment, a, b, depth = head
            found = list(sweep(held))
            for node, parent in found:
                above = found[max(parent, 0)][0]
                out.append((parent < 0, segment, a ^ node[0], b ^ node[1], depth + node[2], a ^ above[0], b ^ above[1], above[4], *node[3:]))

        def shown() -> dict:
            table = dict(zip(names, zip(*out)))
            out.clear()
            return table

        now, held = None, []
        for part in parts:
            for row in zip(*(part[c] for c in SUFFIX)):
                *head, depth, turns, members, conv, more, leaves, saved = row
                if now != (*head, depth):
                    if held:
                        close(now, held)
                    now, held = (*head, depth), []
                held.append(([(t["a"], t["b"], t["size"]) for t in turns], members, conv, more, leaves, saved))
                if len(out) > 10_000:
                    yield shown()
        if held:
            close(now, held)
        if out:
            yield shown()

    return map_batches(dealt.select(*SUFFIX), run, NODES)


@own_scratch
def prefix_trie(rows: DataFrame, convs: DataFrame, segment: int = SEGMENT, container: int = CONTAINER) -> DataFrame:
    """(a, b, conv_id, depth, parent_conv_id, n_convs, n_children, n_leaves,
    saved_tokens, ends_sha256): one row per distinct beginning of the conversations
    of `convs` (conv, n turns), whose turns are `rows` (conv, depth from 1, turn_a,
    turn_b, size). a, b identify the node; the last column is the hash of the
    ascending numbers, joined by commas, of the conversations that end there.
    Conversations without turns end at the root. Without conversations the result is
    empty. Neither `segment` nor `container` changes the result."""
    zero = F.lit(0).cast("long")
    segments = stored(_segments(rows, convs, segment), "segments")
    plain = segments.withColumns({"below_leaves": zero, "below_saved": zero})
    later = plain.filter("segment > 0")
    long = not later.isEmpty()
    if long:
        sums = stored(_grown(stored(_suffixes(later, segment), "suffixes"), container).filter("head"), "later")
        # the sums of a later segment's head belong to the path of its smallest member
        handed = sums.select("conv", "segment", "leaves", "saved")
        deeper = Window.partitionBy("conv").orderBy(F.desc("segment")).rowsBetween(Window.unboundedPreceding, -1)
        handed = segments.join(handed, ["conv", "segment"], "left")
        plain = handed.withColumns({f"below_{c}": F.coalesce(F.sum(c).over(deeper), zero) for c in ("leaves", "saved")})
    nodes = stored(_grown(stored(_suffixes(plain, segment), "suffixes"), container), "trie")
    root = nodes.filter("head AND segment = 0").withColumn("leaves", F.col("leaves") + ((F.col("children") == 0) & ~F.col("more")).cast("long"))
    every = nodes.filter("NOT head").unionByName(root)
    if long:  # a node at the end of a segment has its children in a container of the next one
        under = nodes.filter("head AND segment > 0").select("a", "b", F.col("children").alias("next_children"))
        over = every.filter("more").select(F.col("a").alias("up_a"), F.col("b").alias("up_b"), F.col("conv").alias("up_conv"))
        every = every.join(under, ["a", "b"], "left").join(over, ["up_a", "up_b"], "left").withColumns(
            {"children": F.coalesce("next_children", "children"), "parent_conv": F.coalesce("up_conv", "parent_conv")}
        )
    ends = _ends(segments.filter("NOT more").select("conv", F.col("end_a").alias("a"), F.col("end_b").alias("b")))
    return every.join(ends, ["a", "b"], "left").select(
        "a", "b", F.col("conv").alias("conv_id"), F.col("depth").cast("long").alias("depth"), F.when(F.col("depth") > 0, F.col("parent_conv")).alias("parent_conv_id"),
        F.col("members").alias("n_convs"), F.col("children").alias("n_children"), F.col("leaves").alias("n_leaves"), F.col("saved").alias("saved_tokens"),
        F.coalesce("ends_sha256", F.lit(hashlib.sha256(b"").hexdigest())).alias("ends_sha256"),
    )


def _ends(members: DataFrame) -> DataFrame:
    """(a, b, ends_sha256): hash of the ascending numbers of the conversations that
    end at a node. Numbers are sorted and written in blocks of 4,096; the hash, which
    has to see them in order, is fed block by block and holds one at a time."""
    numbers = F.array_join(F.transform(F.array_sort(F.collect_list("conv")), lambda c: c.cast("string")), ",")
    blocks = members.withColumn("block", F.shiftright("conv", BLOCK)).groupBy("a", "b", "block").agg(numbers.alias("numbers"))
    dealt = blocks.repartition("a", "b").sortWithinPartitions("a", "b", "block")

    def run(parts: Iterator[dict]) -> Iterator[dict]:
        now, digest = None, None
        for part in parts:
            done = []
            for a, b, numbers in zip(part["a"], part["b"], part["numbers"]):
                if now == (a, b):
                    digest.update(b",")
                else:
                    if now:
                        done.append((*now, digest.hexdigest()))
                    now, digest = (a, b), hashlib.sha256()
                digest.update(numbers.encode())
            if done:
                yield dict(zip(("a", "b", "ends_sha256"), zip(*done)))
        if now:
            yield {"a": [now[0]], "b": [now[1]], "ends_sha256": [digest.hexdigest()]}

    return map_batches(dealt.select("a", "b", "numbers"), run, "a long, b long, ends_sha256 string")
