"""Trie of conversation prefixes: ROLLUP over positional turn-id columns, in blocks of columns.

A turn's id holds a digest of role and text and the text's code points, so texts
are read once and never shuffled. Conversations become rows of ``FIRST`` turn
columns; one ROLLUP over them, told apart by ``grouping_id``, gives every prefix
at once. Longer conversations go on in blocks of ``LATER`` columns, keyed by the
node that the block before ended in; only conversations that still share that
node with others do, the rest of a lone one is a chain of single nodes. So there
are as many rounds as the longest prefix of *several* conversations has blocks.

A node is named by its smallest member and its depth. Sums over subtrees are a
second ROLLUP, last block first: every node lies on the path of its smallest
member, which carries the node's share; an ancestor's sum is that of its members'
shares from its depth on. Only one conversation of each distinct block enters it,
with the sums of the blocks below.

Defined cases: rows without a conversation id belong to no conversation and are
left out; null turns come first; rows of equal turn follow by the digest of role
and text, and equal rows count as often as they occur; null role or text is
empty; an empty table has no nodes, not even a root; other columns are not
looked at.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from functools import reduce

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from newsloom.operators.ordering import running_index
from newsloom.session import stage

from .common import sized_join

FIRST, LATER = 8, 8  # turn columns of the first and of each further block
CHUNK = 4096  # conversation ids of one chunk of an end list span less than this
_ID, _SIZE = 16, 4  # bytes of a turn id: digest, code points


def turn_id(role: Column, text: Column) -> Column:
    """Digest of role and text, then the text's code points."""
    role, text = (F.coalesce(c.cast("string"), F.lit("")) for c in (role, text))
    whole = F.concat(F.char_length(role).cast("string"), F.lit(":"), role, text)
    return F.concat(F.unhex(F.md5(whole)), F.unhex(F.lpad(F.hex(F.char_length(text)), 2 * _SIZE, F.lit("0"))))


def text_size(turn: Column) -> Column:
    return F.conv(F.hex(F.substring(turn, _ID + 1, _SIZE)), 16, 10).cast("long")


def number_turns(turns: DataFrame, *, conv_col: str = "conv_id", turn_col: str = "turn", role_col: str = "role",
                 text_col: str = "text") -> DataFrame:
    """(conv, at, id): each turn's place in its conversation from 0, and its id; written."""
    narrow = turns.filter(F.col(conv_col).isNotNull()).select(
        F.col(conv_col).cast("long").alias("conv"), F.col(turn_col).alias("turn"),
        turn_id(F.col(role_col), F.col(text_col)).alias("id"))
    return stage(running_index(narrow, ["turn", "id"], within=["conv"], out="at").select("conv", "at", "id"), "trie-turns")


def _all(convs: DataFrame, turns: DataFrame) -> DataFrame:
    """(conv, len) of all conversations, also those without turns; written."""
    counted = turns.groupBy("conv").agg(F.count(F.lit(1)).alias("n"))
    return stage(convs.join(counted, "conv", "left").select("conv", F.coalesce("n", F.lit(0)).alias("len")), "trie-lengths")


def share_heads(turns: DataFrame, *, every: int = 100, longest: int = 5) -> tuple[DataFrame, DataFrame]:
    """Turns and conversations with the first turns of one conversation shared by a whole group.

    Of conversation c the first h = crc32(c) % (longest + 1) turns are replaced
    by the first h of conversation c - c % every (fewer, if it has fewer).
    """
    conv = F.col("conv")
    convs = stage(turns.select("conv").distinct(), "trie-convs")
    head = F.when(conv % every == 0, 0).otherwise(F.crc32(conv.cast("string")) % (longest + 1))
    heads = turns.filter((conv % every == 0) & (F.col("at") < longest)).select(
        conv.alias("base"), F.col("at").alias("head_at"), F.col("id").alias("head_id"))
    lent = convs.select("conv", (conv - conv % every).alias("base"), head.alias("h")).filter("h > 0")
    lent = stage(lent.join(heads, "base").filter("head_at < h").select("conv", F.col("head_at").alias("at"), F.col("head_id").alias("id")),
                 "trie-heads")
    given = stage(lent.groupBy("conv").agg(F.count(F.lit(1)).alias("given")), "trie-given")
    own = sized_join(turns.withColumn("h", head).filter("at >= h"), given, "conv", "left", 16)
    own = own.select("conv", (F.col("at") - F.col("h") + F.coalesce("given", F.lit(0))).alias("at"), "id")
    return lent.unionByName(own), convs


def _columns(width: int) -> list[str]:
    return [f"t{i}" for i in range(1, width + 1)]


def _joined(names: list[str]) -> Column:
    """Digest of the turn ids up to the first null."""
    return F.unhex(F.md5(F.concat(*[F.coalesce(F.col(c), F.lit(b"").cast("binary")) for c in names])))


def _blocks(turns: DataFrame, lengths: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Rows of turn columns: the first block of every conversation, and all further blocks by number; written."""
    depth = F.col("at") + 1
    picked = lambda at, width: [F.max(F.when(at == i, F.col("id"))).alias(f"t{i}") for i in range(1, width + 1)]
    first = turns.filter(depth <= FIRST).groupBy("conv").agg(*picked(depth, FIRST))
    first = lengths.join(first, "conv", "left")
    rest = turns.filter(depth > FIRST).select("conv", "at", "id", F.floor((F.col("at") - FIRST) / LATER).cast("int").alias("block"))
    later = rest.groupBy("conv", "block").agg(*picked((F.col("at") - FIRST) % LATER + 1, LATER))
    later = sized_join(later, lengths, "conv", "inner", 16)
    return stage(first, "trie-first"), stage(later, "trie-later")


def _rolled(rows: DataFrame, width: int, start: int) -> DataFrame:
    """Nodes below (and, at the top, of) the rows' keys: one ROLLUP over the block's columns."""
    names = _columns(width)
    rolled = rows.rollup("key", *names).agg(
        F.min("conv").alias("conv_id"), F.count(F.lit(1)).alias("n_convs"), F.grouping_id().alias("grouped"))
    rolled = rolled.withColumn("i", F.lit(width) - F.bit_count("grouped"))
    turns = F.array(*[F.col(c) for c in names])
    last = F.when(F.col("i") > 0, F.get(turns, F.col("i") - 1))
    kept = last.isNotNull() | ((F.col("i") == 0) & F.lit(start == 0))
    # the row's columns without its last one, as a child knows its parent
    above = [F.when(F.col("i") > i, F.col(c)) for i, c in enumerate(names, 1)]
    up = F.unhex(F.md5(F.concat(*[F.coalesce(c, F.lit(b"").cast("binary")) for c in above])))
    return rolled.filter(kept).select(
        "key", "conv_id", "n_convs", "i", (F.col("i") + start).cast("long").alias("depth"), _joined(names).alias("path"), up.alias("up"),
        F.coalesce((F.col("n_convs") - 1) * text_size(last), F.lit(0)).cast("long").alias("saved"))


def _ends_digest(ends: DataFrame) -> DataFrame:
    """SHA-256 over each node's list of conversations, numerically ascending.

    Ids are joined to chunks by value first. A digest over a list has to read it
    in order; tasks do so chunk by chunk and hold one chunk at a time.
    """
    chunks = ends.groupBy("conv_id", "depth", F.floor(F.col("conv") / CHUNK).alias("chunk")).agg(
        F.array_join(F.transform(F.sort_array(F.collect_list("conv")), lambda c: c.cast("string")), ",").alias("ids"))
    return chunks.repartition("conv_id", "depth").sortWithinPartitions("conv_id", "depth", "chunk").mapInArrow(
        _digest_lists, "conv_id long, depth long, ends_sha256 string")


def _digest_lists(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    at, digest = None, None
    for batch in batches:
        done = []
        for conv, depth, ids in zip(*(batch.column(c).to_pylist() for c in ("conv_id", "depth", "ids"))):
            if at == (conv, depth):
                digest.update(b"," + ids.encode())
                continue
            if at is not None:
                done.append((*at, digest.hexdigest()))
            at, digest = (conv, depth), hashlib.sha256(ids.encode())
        if done:
            yield _digest_batch(done)
    if at is not None:
        yield _digest_batch([(*at, digest.hexdigest())])


def _digest_batch(rows: list[tuple[int, int, str]]) -> pa.RecordBatch:
    convs, depths, digests = zip(*rows)
    return pa.RecordBatch.from_arrays([pa.array(convs, pa.int64()), pa.array(depths, pa.int64()), pa.array(digests)],
                                      names=["conv_id", "depth", "ends_sha256"])


def trie_of(turns: DataFrame, convs: DataFrame) -> DataFrame:
    """Nodes of the trie over (conv, at, id); ``convs`` names all conversations, each once."""
    turns = stage(turns, "trie-rebuilt")
    lengths = _all(convs, turns)
    root = lengths.agg(F.min("conv")).first()[0]
    rows, later = _blocks(turns, lengths)
    rows = rows.withColumn("key", F.lit(root).cast("long"))
    start, width, block = 0, FIRST, 0
    nodes, ends, owners, lone = [], [], [], []
    while True:
        found = stage(_rolled(rows, width, start), "trie-nodes")
        above = found.select("key", F.col("path").alias("up"), F.col("conv_id").alias("above"))
        parents = found.filter("i > 1").join(above, ["key", "up"]).select("conv_id", "depth", F.col("above").alias("parent_conv_id"))
        tops = found.filter("i < 2").select("conv_id", "depth", F.when(F.col("i") == 1, F.col("key")).alias("parent_conv_id"))
        named = stage(parents.unionByName(tops), "trie-parents")
        nodes.append((found, named))
        # where each row's block ends: its last node there, and whether others share it
        tails = found.select("key", "path", F.col("conv_id").alias("owner"), F.col("n_convs").alias("sharing"))
        placed = stage(rows.withColumn("path", _joined(_columns(width))).join(tails, ["key", "path"]), "trie-placed")
        done = F.col("len") <= start + width
        ends.append(placed.filter(done).select(F.col("owner").alias("conv_id"), F.col("len").alias("depth"), "conv"))
        owners.append(placed.filter("owner = conv").select("key", "conv", "len", *_columns(width)))
        lone.append(placed.filter(~done & (F.col("sharing") == 1)).select("conv", F.lit(start + width).cast("long").alias("begin")))
        active = placed.filter(~done & (F.col("sharing") > 1)).select("conv", F.col("owner").alias("key"))
        if active.isEmpty():
            break
        start, width = start + width, LATER
        rows = stage(later.filter(F.col("block") == block).drop("block").join(active, "conv"), "trie-rows")
        block += 1
    union = lambda frames: reduce(DataFrame.unionByName, frames)
    # what is left of a conversation that shares its node with no other
    alone = stage(union(lone), "trie-lone")
    chain = sized_join(turns.select("conv", (F.col("at") + 1).alias("depth")), alone, "conv", "inner", 16).filter("depth > begin")
    chain = sized_join(chain.select("conv", "depth"), lengths, "conv", "inner", 16).select(
        F.col("conv").alias("conv_id"), "depth", F.col("conv").alias("parent_conv_id"), F.lit(1).cast("long").alias("n_convs"),
        F.when(F.col("depth") < F.col("len"), 1).otherwise(0).cast("long").alias("n_children"),
        F.lit(1).cast("long").alias("n_leaves"), F.lit(0).cast("long").alias("saved_tokens"))
    ends.append(alone.join(lengths, "conv").select(F.col("conv").alias("conv_id"), F.col("len").alias("depth"), "conv"))
    # children, counted at the parent; a lone rest is one child of the node it leaves
    named = union([n for _, n in nodes])
    child_of = named.filter("depth > 0").select(F.col("parent_conv_id").alias("conv_id"), (F.col("depth") - 1).alias("depth"))
    child_of = child_of.unionByName(alone.select(F.col("conv").alias("conv_id"), F.col("begin").alias("depth")))
    children = stage(child_of.groupBy("conv_id", "depth").agg(F.count(F.lit(1)).alias("n_children")), "trie-children")
    ended = stage(union(ends), "trie-ends")
    leaves = ended.filter("conv_id = conv").join(children.select("conv_id", "depth"), ["conv_id", "depth"], "left_anti").select("conv")
    sums = _subtree_sums([found for found, _ in nodes], owners, stage(leaves, "trie-leaves"))
    table = union([found.select("conv_id", "depth", "n_convs") for found, _ in nodes])
    table = table.join(named, ["conv_id", "depth"]).join(children, ["conv_id", "depth"], "left").join(sums, ["conv_id", "depth"], "left")
    table = table.select("conv_id", "depth", "parent_conv_id", "n_convs", F.coalesce("n_children", F.lit(0).cast("long")).alias("n_children"),
                         "n_leaves", "saved_tokens").unionByName(chain)
    table = table.join(_ends_digest(ended), ["conv_id", "depth"], "left")
    return table.withColumn("ends_sha256", F.coalesce("ends_sha256", F.lit(hashlib.sha256(b"").hexdigest())))


def _subtree_sums(found: list[DataFrame], owners: list[DataFrame], leaves: DataFrame) -> DataFrame:
    """(conv_id, depth, n_leaves, saved_tokens) of all nodes but chains, by one ROLLUP a block over one conversation of each distinct row."""
    flags = leaves.withColumn("leaf", F.lit(1))
    sums, below = [], None
    for k in range(len(found) - 1, -1, -1):
        width = FIRST if k == 0 else LATER
        names = _columns(width)
        held = found[k].groupBy(F.col("conv_id").alias("conv")).agg(
            *[F.sum(F.when(F.col("i") == i, F.col("saved"))).alias(f"s{i}") for i in range(1, width + 1)])
        rows = owners[k].join(held, "conv", "left").join(flags, "conv", "left")
        if below is None:
            rows = rows.withColumns({"below": F.lit(0).cast("long"), "leaves_below": F.lit(None).cast("long")})
        else:
            rows = rows.join(below, "conv", "left")
        share, parts = F.coalesce("below", F.lit(0)), []
        for i in range(width, 0, -1):
            share = share + F.coalesce(f"s{i}", F.lit(0))
            parts.insert(0, share.alias(f"w{i}"))
        leaf = F.coalesce("leaves_below", "leaf").alias("leaf")  # a node that goes on is no leaf itself
        rows = stage(rows.select("key", "conv", leaf, *names, *parts), "trie-shares")
        below = rows.groupBy(F.col("key").alias("conv")).agg(F.sum("w1").alias("below"), F.sum("leaf").alias("leaves_below"))
        rolled = rows.rollup("key", *names).agg(
            F.min("conv").alias("conv_id"), F.sum("leaf").alias("n_leaves"), F.grouping_id().alias("grouped"),
            F.array(*[F.sum(f"w{i}") for i in range(1, width + 1)]).alias("shares"))
        i = F.lit(width) - F.bit_count("grouped")
        last = F.when(i > 0, F.get(F.array(*[F.col(c) for c in names]), i - 1))
        start = 0 if k == 0 else FIRST + (k - 1) * LATER
        sums.append(rolled.filter(last.isNotNull() | ((i == 0) & F.lit(k == 0))).select(
            "conv_id", (i + start).cast("long").alias("depth"), F.coalesce("n_leaves", F.lit(0).cast("long")).alias("n_leaves"),
            F.get("shares", F.greatest(i - 1, F.lit(0))).alias("saved_tokens")))
    return reduce(DataFrame.unionByName, sums)


def conversation_trie(turns: DataFrame, *, conv_col: str = "conv_id", turn_col: str = "turn", role_col: str = "role",
                      text_col: str = "text") -> DataFrame:
    """Nodes of the trie over conversations as they are."""
    numbered = number_turns(turns, conv_col=conv_col, turn_col=turn_col, role_col=role_col, text_col=text_col)
    return trie_of(numbered, numbered.select("conv").distinct())


def shared_head_trie(turns: DataFrame) -> DataFrame:
    """Nodes of the trie over conversations whose first turns come from their group's first conversation."""
    rebuilt, convs = share_heads(number_turns(turns))
    return trie_of(rebuilt, convs)
