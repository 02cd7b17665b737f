"""A trie of all conversations' turn sequences, built as a burst trie.

Equal sequences are one class with a count. A container holds the suffixes of the classes below one trie node, its head. All
classes begin in the root's container. A container of more than ``burst_at`` turns bursts: the run of turns that all its
suffixes share becomes nodes, and the next turn id deals the suffixes to containers below. Each round handles
all such containers at once, by sums over (container, place). What remains is bounded: a container's suffixes are sorted and swept
into nodes, one container after the other in each shard; a class alone is a chain of its own turns and is
never gathered. Sums over subtrees are then added up from the last round to the first.

Turns are known by 128 bits of their SHA-256, classes by length and 128 bits over places and turns.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass
from hashlib import sha256

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lakemart.llm.mixing import word_count
from lakemart.llm.numbering import numbered
from lakemart.workspace import durable, durable_observed

BURST_AT = 1 << 14
CHUNK_BITS = 12
NODES_AT_ONCE = 1 << 14


def turn_key(role: Column, text: Column) -> Column:
    """16 bytes that stand for a turn; null is empty."""
    role, text = F.coalesce(role, F.lit("")), F.coalesce(text, F.lit(""))
    return F.substring(F.unhex(F.sha2(F.concat(F.length(role).cast("string"), F.lit(":"), role, text), 256)), 1, 16)


def turn_rows(conversations: DataFrame) -> DataFrame:
    """``(conv_id, place, turn_key, words, before)``: each conversation's turns from 0 in the order of ``turn``, null first, with
    their words and the words ahead of them.

    Turns of one number follow their ids, so repeated rows stay as many turns. Rows without ``conv_id`` belong to no
    conversation and are left out. Texts are not shuffled; a conversation may be of any length.
    """
    turns = conversations.where("conv_id is not null").select(
        F.col("conv_id").cast("bigint").alias("conv_id"), "turn", turn_key(F.col("role"), F.col("text")).alias("turn_key"),
        word_count(F.col("text")).alias("words"),
    )
    return durable(numbered(turns, "conv_id", ["turn", "turn_key"], "words").drop("turn"), "turns")


def graft(turns: DataFrame, source: Column, length: Column, longest: int) -> tuple[DataFrame, DataFrame]:
    """Every conversation with its first ``length`` turns (at most ``longest``, a small number) replaced by those of the
    conversation ``source``: fewer where that has fewer, none where it does not exist.

    ``turns`` as of ``turn_rows``; both expressions see ``conv_id``. Returns ``(turns, conversations)``: the rebuilt turns, and all
    ``conv_id``, also those of which no turn is left.
    """
    entry = F.struct("place", "turn_key", "words")
    firsts = durable(
        turns.where(F.col("place") < longest).groupBy("conv_id").agg(F.sort_array(F.collect_list(entry)).alias("own")), "openings"
    )

    def total(entries: Column) -> Column:
        return F.aggregate(entries, F.lit(0).cast("bigint"), lambda acc, e: acc + e["words"])

    other = firsts.select(F.col("conv_id").alias("source"), F.col("own").alias("other"))
    wanted = firsts.select("conv_id", "own", source.alias("source"), length.cast("int").alias("h"))
    empty = F.slice("own", F.lit(1), F.lit(0))
    plan = durable(
        wanted.join(other, "source", "left").withColumn("taken", F.coalesce(F.slice("other", F.lit(1), F.col("h")), empty)).select(
            "conv_id", "h", "taken", (F.size("taken") - F.col("h")).alias("shift"),
            (total(F.col("taken")) - total(F.slice("own", F.lit(1), F.col("h")))).alias("word_shift"),
        ), "grafts",
    )
    kept = turns.join(plan.select("conv_id", "h", "shift", "word_shift"), "conv_id").where("place >= h").select(
        "conv_id", (F.col("place") + F.col("shift")).alias("place"), "turn_key", "words", (F.col("before") + F.col("word_shift")).alias("before")
    )
    taken = plan.select("conv_id", "taken", F.posexplode("taken").alias("at", "turn")).select(
        "conv_id", F.col("at").cast("bigint").alias("place"), "turn.turn_key", "turn.words", total(F.slice("taken", F.lit(1), F.col("at"))).alias("before")
    )
    return kept.unionByName(taken), plan.select("conv_id")


@dataclass(frozen=True)
class Trie:
    """``nodes(conv_id, depth, parent_conv_id, n_convs, n_children, n_leaves, saved_words, turn_key, class_id)`` and
    ``members(conv_id, class_id)``.

    A node is named by its least member and its depth. ``saved_words`` sums, over the node's subtree, the words of a node's
    last turn for each member but one. ``class_id`` is the class that ends at the node (null: none does).
    """

    nodes: DataFrame
    members: DataFrame


_NODE = ["conv_id", "depth", "parent_conv_id", "n_convs", "n_children", "n_leaves", "saved_words", "turn_key", "class_id"]
_SWEPT = (
    "conv_id bigint, depth bigint, parent_conv_id bigint, n_convs bigint, n_children bigint, n_leaves bigint, saved_words bigint, "
    "turn_key binary, class_id bigint, head boolean"
)
_HEAD = ["m", "d"]


def _classes(turns: DataFrame, conversations: DataFrame) -> tuple[DataFrame, DataFrame]:
    """``classes(rep, n, len)`` and ``members(conv_id, class_id)``."""
    prints = turns.groupBy("conv_id").agg(
        F.count("*").alias("len"), F.bit_xor(F.xxhash64("place", "turn_key")).alias("x"),
        F.bit_xor(F.xxhash64("turn_key", "place", F.lit(1))).alias("y"), F.sum("words").alias("words"),
    )
    zero = F.lit(0).cast("bigint")
    keyed = durable(conversations.join(prints, "conv_id", "left").select(
        "conv_id", *[F.coalesce(c, zero).alias(c) for c in ("len", "x", "y", "words")]
    ), "sequences")
    classes = durable(keyed.groupBy("len", "x", "y").agg(
        F.min("conv_id").alias("rep"), F.count("*").alias("n"), F.max("words").alias("words")
    ), "classes")
    members = keyed.join(classes, ["len", "x", "y"]).select("conv_id", F.col("rep").alias("class_id"))
    return classes.select("rep", "n", "len", "words"), members


def _sweep(burst_depths: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Sorted suffixes ``(m, d, rep, n, keys, words)``, one container after the other, to nodes and a row for each head."""
    out: dict[str, list] = {c: [] for c in (*_NODE, "head")}
    schema = pa.schema([(c, pa.binary() if c == "turn_key" else pa.bool_() if c == "head" else pa.int64()) for c in out])
    now, former, stack = None, [], []
    nodes: list[list] = []  # depth, parent's number, key, words, least, members, children, leaves, saved, class

    def close() -> None:
        head = nodes[0]
        for node in reversed(nodes[1:]):
            above = nodes[node[1]]
            node[8] += (node[5] - 1) * node[3]
            node[7] = node[7] or 1
            above[4], above[5], above[6] = min(above[4], node[4]), above[5] + node[5], above[6] + 1
            above[7], above[8] = above[7] + node[7], above[8] + node[8]
        for i, node in enumerate(nodes):
            parent = None if i == 0 else nodes[node[1]][4]
            row = (node[4], node[0], parent, node[5], node[6], node[7], node[8], node[2], node[9], node is head)
            for column, value in zip(out.values(), row):
                column.append(value)

    def flush() -> pa.RecordBatch:
        batch = pa.RecordBatch.from_pydict(out, schema=schema)
        for column in out.values():
            column.clear()
        return batch

    for batch in burst_depths:
        m, d, rep, n, keys, words = (column.to_pylist() for column in batch.columns)
        for i in range(batch.num_rows):
            if (m[i], d[i]) != now:
                if now is not None:
                    close()
                    if len(out["depth"]) >= NODES_AT_ONCE:
                        yield flush()
                now, former, stack = (m[i], d[i]), [], [0]
                nodes = [[d[i], None, None, 0, rep[i], 0, 0, 0, 0, None]]
            own, shared = keys[i], 0
            for a, b in zip(own, former):
                if a != b:
                    break
                shared += 1
            del stack[shared + 1 :]
            for at in range(shared, len(own)):
                nodes.append([d[i] + at + 1, stack[-1], own[at], words[i][at], rep[i], 0, 0, 0, 0, None])
                stack.append(len(nodes) - 1)
            end = nodes[stack[-1]]
            end[4], end[5], end[9] = min(end[4], rep[i]), end[5] + n[i], rep[i]
            former = own
    if now is not None:
        close()
    yield flush()


def build_trie(turns: DataFrame, conversations: DataFrame, burst_at: int = BURST_AT) -> Trie:
    """The trie over ``turns(conv_id, place, turn_key, words, before)`` of ``conversations(conv_id)``, ids distinct and not null.

    A conversation without turns is a member of the root. No conversation gives no node.
    """
    classes, members = _classes(turns, conversations)
    least = classes.agg(F.min("rep"), F.sum("n")).first()
    seq = durable(
        turns.join(classes.select(F.col("rep").alias("conv_id")), "conv_id", "left_semi").withColumnRenamed("conv_id", "rep"), "class-turns"
    )
    zero, none = F.lit(0).cast("bigint"), F.lit(None).cast("bigint")
    live = classes.select(F.lit(least[0]).cast("bigint").alias("m"), zero.alias("d"), "rep", "n", "len", "words", zero.alias("done"))
    heads = [durable(live.groupBy(*_HEAD).agg(
        F.sum("n").alias("n_convs"), F.count("*").alias("n_classes"), F.sum(F.col("len") - F.col("d")).alias("left"),
    ).select("*", none.alias("pm"), none.alias("pd"), none.alias("parent_conv_id"), zero.alias("own_words"), F.lit(None).cast("binary").alias("turn_key"), zero.alias("done")), "trie-heads")]
    resting, bursts, runs = [], [], []
    big = (F.col("n_classes") > 1) & (F.col("left") > burst_at)
    while True:
        sized = live.join(heads[-1].select(*_HEAD, "n_classes", "left"), _HEAD)
        resting.append(sized.where(~big).drop("left"))
        crowded, seen = durable_observed(sized.where(big), "trie-bursting", F.count("*").alias("rows"))
        if not seen["rows"]:
            break
        ahead = crowded.select(*_HEAD, "rep", "n_classes").join(seq, "rep").where("place >= d")
        places = durable(ahead.groupBy(*_HEAD, "place", "n_classes").agg(
            F.count("*").alias("rows"), F.min("turn_key").alias("turn_key"), F.max("turn_key").alias("other"),
            F.max("words").alias("words"), F.max("before").alias("before"),
        ).select("*", ((F.col("rows") == F.col("n_classes")) & (F.col("turn_key") == F.col("other"))).alias("shared")), "trie-places")
        cut = durable(places.where("not shared").groupBy(*_HEAD).agg(F.min("place").alias("b")), "trie-cuts")
        run = places.join(cut, _HEAD).where("place < b").select(*_HEAD, "place", "turn_key", "words", "before")
        runs.append(run)
        to_b = crowded.join(cut, _HEAD)
        ended = to_b.where("len = b").select(*_HEAD, F.col("rep").alias("class_id"))
        bursts.append(durable(
            heads[-1].select(*_HEAD, "n_convs", "done").join(cut, _HEAD).join(ended, _HEAD, "left")
            .join(run.groupBy(*_HEAD).agg(F.sum("words").alias("run_words")), _HEAD, "left").fillna(0, ["run_words"]), "trie-bursts"
        ))
        opened = durable(
            to_b.select(*_HEAD, "b", "rep", "n", "len", F.col("words").alias("all_words")).join(seq, "rep").where("place = b")
            .select(*_HEAD, "b", "turn_key", "rep", "n", "len", "all_words", "words", (F.col("before") + F.col("words")).alias("done")), "trie-opened",
        )
        below = opened.groupBy(*_HEAD, "b", "turn_key").agg(
            F.min("rep").alias("cm"), F.sum("n").alias("n_convs"), F.count("*").alias("n_classes"), F.sum(F.expr("len - b - 1")).alias("left"),
            F.max("words").alias("own_words"), F.max("done").alias("done"),
        )
        heads.append(durable(below.select(
            F.col("cm").alias("m"), F.expr("b + 1").alias("d"), "n_convs", "n_classes", "left", F.col("m").alias("pm"), F.col("d").alias("pd"),
            F.col("m").alias("parent_conv_id"), "own_words", "turn_key", "done",
        ), "trie-heads"))
        named = heads[-1].select(F.col("pm").alias("m"), F.col("pd").alias("d"), "turn_key", F.col("m").alias("cm"))
        live = durable(opened.join(named, [*_HEAD, "turn_key"]).select(
            F.col("cm").alias("m"), F.expr("b + 1").alias("d"), "rep", "n", "len", F.col("all_words").alias("words"), "done"
        ), "trie-live")

    rest = resting[0]
    for more in resting[1:]:
        rest = rest.unionByName(more)
    rest = durable(rest, "trie-resting")
    chains = rest.where("n_classes = 1")
    gathered = rest.where("n_classes > 1").select(*_HEAD, "rep", "n").join(
        seq.select(F.col("rep").alias("r"), "place", "turn_key", F.col("words").alias("w")), F.expr("rep = r and place >= d"), "left"
    ).groupBy(*_HEAD, "rep", "n").agg(
        F.sort_array(F.collect_list(F.when(F.col("r").isNotNull(), F.struct("place", "turn_key", "w")))).alias("suffix")
    ).select(*_HEAD, "rep", "n", F.col("suffix.turn_key").alias("keys"), F.col("suffix.w").alias("words"))
    shards = gathered.repartition(*_HEAD).sortWithinPartitions(*_HEAD, "keys")
    swept = durable(shards.mapInArrow(_sweep, _SWEPT), "trie-swept")

    # What lies below each head, from the last round to the first.
    columns = ["n_children", "n_leaves", "saved_words", "class_id"]
    goes_on = (F.col("len") > F.col("d")).cast("bigint")
    below = chains.select(
        *_HEAD, goes_on.alias("n_children"), goes_on.alias("n_leaves"), F.expr("(n - 1) * (words - done)").alias("saved_words"),
        F.expr("case when len = d then rep end").alias("class_id"),
    ).unionByName(swept.where("head").select(F.col("conv_id").alias("m"), F.col("depth").alias("d"), *columns))
    totals = durable(below, "trie-totals")
    found = [totals]
    spans = []
    for burst, run, children in zip(reversed(bursts), reversed(runs), reversed(heads[1:])):
        up = children.join(totals, _HEAD).groupBy(F.col("pm").alias("m"), F.col("pd").alias("d")).agg(
            F.count("*").alias("c_b"), F.sum(F.greatest("n_leaves", F.lit(1))).alias("l_b"),
            F.sum(F.expr("saved_words + (n_convs - 1) * own_words")).alias("s_b"),
        )
        tops = durable(burst.join(up, _HEAD), "trie-burst-totals")
        here = tops.select(
            *_HEAD, F.expr("case when b > d then 1 else c_b end").cast("bigint").alias("n_children"), F.col("l_b").alias("n_leaves"),
            F.expr("s_b + (n_convs - 1) * run_words").alias("saved_words"), F.expr("case when b = d then class_id end").alias("class_id"),
        )
        spans.append(run.join(tops, _HEAD).select(
            F.col("m").alias("conv_id"), F.expr("place + 1").alias("depth"), F.col("m").alias("parent_conv_id"), "n_convs",
            F.expr("case when place + 1 < b then 1 else c_b end").cast("bigint").alias("n_children"), F.col("l_b").alias("n_leaves"),
            F.expr("s_b + (n_convs - 1) * (done + run_words - before)").alias("saved_words"), "turn_key",
            F.expr("case when place + 1 = b then class_id end").alias("class_id"),
        ))
        found.append(here)
        totals = durable(totals.unionByName(here), "trie-totals")

    every_head = heads[0]
    for more in heads[1:]:
        every_head = every_head.unionByName(more)
    nodes = every_head.join(totals, _HEAD).select(
        F.col("m").alias("conv_id"), F.col("d").alias("depth"), "parent_conv_id", "n_convs", "n_children",
        F.greatest("n_leaves", F.lit(1)).alias("n_leaves"), F.expr("saved_words + (n_convs - 1) * own_words").alias("saved_words"), "turn_key", "class_id",
    )
    chain_nodes = seq.select("rep", "place", "turn_key", "before").join(chains.select("rep", "d", "n", "len", "words"), "rep").where("place >= d").select(
        F.col("rep").alias("conv_id"), F.expr("place + 1").alias("depth"), F.col("rep").alias("parent_conv_id"), F.col("n").alias("n_convs"),
        F.expr("cast(place + 1 < len as bigint)").alias("n_children"), F.lit(1).cast("bigint").alias("n_leaves"),
        F.expr("(n - 1) * (words - before)").alias("saved_words"), "turn_key", F.expr("case when place + 1 = len then rep end").alias("class_id"),
    )
    for part in (chain_nodes, swept.where("not head").drop("head"), *spans):
        nodes = nodes.unionByName(part)
    return Trie(durable(nodes.select(*_NODE), "trie-nodes"), members)


def with_texts(nodes: DataFrame, conversations: DataFrame) -> DataFrame:
    """Nodes with the ``role`` and ``text`` of their last turn (null at the root), each distinct turn read once."""
    empty = F.lit("")
    said = conversations.select(
        turn_key(F.col("role"), F.col("text")).alias("turn_key"), F.struct(F.coalesce("role", empty).alias("role"), F.coalesce("text", empty).alias("text")).alias("turn")
    ).groupBy("turn_key").agg(F.any_value("turn").alias("turn"))
    last = nodes.where("turn_key is not null").join(said, "turn_key").select(*nodes.columns, "turn.role", "turn.text")
    root = nodes.where("turn_key is null").select(*nodes.columns, F.lit(None).cast("string").alias("role"), F.lit(None).cast("string").alias("text"))
    return last.unionByName(root)


def member_digests(members: DataFrame) -> DataFrame:
    """``(class_id, digest)``: the SHA-256, as lower-case hex, of a class's ids in ascending order, decimal and comma-joined.

    Ids are joined in stretches of at most 4,096 on all executors; one task then streams a class's stretches through
    the hash, which is sequential, and holds one batch of them.
    """
    stretches = members.groupBy("class_id", F.shiftright("conv_id", CHUNK_BITS).alias("stretch")).agg(
        F.array_join(F.sort_array(F.collect_list("conv_id")).cast("array<string>"), ",").alias("ids")
    )

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        now, state, classes, digests = None, None, [], []

        def take() -> pa.RecordBatch:
            batch = pa.RecordBatch.from_pydict({"class_id": pa.array(classes, pa.int64()), "digest": pa.array(digests, pa.string())})
            classes.clear()
            digests.clear()
            return batch

        for batch in batches:
            for class_id, ids in zip(batch.column(0).to_pylist(), batch.column(2).to_pylist()):
                if class_id == now:
                    state.update(b"," + ids.encode())
                    continue
                if now is not None:
                    classes.append(now)
                    digests.append(state.hexdigest())
                now, state = class_id, sha256(ids.encode())
            yield take()
        if now is not None:
            classes.append(now)
            digests.append(state.hexdigest())
        yield take()

    return stretches.repartition("class_id").sortWithinPartitions("class_id", "stretch").mapInArrow(run, "class_id bigint, digest string")
