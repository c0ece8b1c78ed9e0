"""The trie of the beginnings that conversations share.

A conversation is a row of turn ids. Rows are dealt to shards by ranges of that order, so the rows below
a node of the trie are neighbours. A shard's rows are a padded matrix of turn ids: numpy's lexsort puts
them in order, a column-wise change against the row before, OR-accumulated to the right, marks where a
node starts, and reduceat adds up every depth. Only nodes on the path of a shard's first or last row
can go on in another shard; their shares are sums, which are put together afterwards.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from dayblotter.llm.common import bounded_batches, stored, table

SHARD_TURNS = 1_000_000  # turns to a shard; with fewer in all there are as many shards as shuffle partitions
BLOCK = 8  # columns of a matrix at a time, so that one long conversation does not pad all others
CHUNK = 4096  # conversation ids in a row of those that end at a node of several shards
TIE_CHARACTERS = 64  # of a text that take part in the order of turns with one number
_RECORD = np.dtype([("high", ">u8"), ("low", ">u8"), ("bytes", ">u8")])
_NO_IDS = hashlib.sha256(b"").hexdigest()
_NODE = (
    "conv_id long, depth long, parent_conv_id long, n_convs long, n_children long, n_leaves long, saved_tokens long, "
    "ends_sha256 string, shard int, node string, parent string, chunk int, ids string"
)
_NUMBERS = ["conv_id", "n_convs", "n_children", "n_leaves", "saved_tokens"]
COLUMNS = ["conv_id", "depth", "parent_conv_id", "n_convs", "n_children", "n_leaves", "saved_tokens", "ends_sha256"]


def turn_records(turns: DataFrame, key: str, turn: str, role: str, text: str) -> DataFrame:
    """(conv_id, turns): every conversation's turns in order, each as 48 hex digits.

    A digit string is the turn's 128-bit id, the digest of its role and text, and its text's length in
    bytes. Turns are ordered by number, nulls first, ties by role, the text's first `TIE_CHARACTERS`
    characters and its id. Null roles and texts become empty. Rows without a conversation are left out;
    repeated rows are turns of their own.
    """
    said, who = F.coalesce(F.col(f"`{text}`"), F.lit("")), F.coalesce(F.col(f"`{role}`"), F.lit(""))
    # Digests, not texts, are shuffled.
    record = F.concat(
        F.md5(F.concat(F.octet_length(who).cast("string"), F.lit(":"), who, said)),
        F.lpad(F.lower(F.hex(F.octet_length(said))), 16, "0"),
    )
    ordered = F.struct(
        F.col(f"`{turn}`").alias("turn"), who.alias("role"), F.left(said, F.lit(TIE_CHARACTERS)).alias("begins"), record.alias("record")
    )
    return (
        turns.where(F.col(f"`{key}`").isNotNull())
        .groupBy(F.col(f"`{key}`").alias("conv_id"))
        .agg(F.sort_array(F.collect_list(ordered)).alias("_turns"))
        .select("conv_id", F.transform("_turns", lambda one: one["record"]).alias("turns"))
    )


def sequences(records: DataFrame, turns: str = "turns") -> DataFrame:
    """(conv_id, key) of `turn_records`: a binary of 24 bytes a turn, whose order is that of the trie."""
    return records.select("conv_id", F.unhex(F.array_join(turns, "")).alias("key"))


def prefix_trie(rows: DataFrame, shards: int | None = None) -> DataFrame:
    """The nodes of the trie of `rows` (conv_id, key), a row each; no rows have no nodes.

    A node is a distinct sequence of the first `depth` turns; its members are the rows that begin with it, and
    the root is that of no turns. `conv_id` is the smallest member and names the node together with `depth`;
    `parent_conv_id` is null for the root. `n_leaves` and `saved_tokens` are summed over the node's subtree,
    itself included: nodes without children, and (members - 1) times the bytes of the node's last text.
    `ends_sha256` is the digest of the members of just `depth` turns, ascending, joined by commas.

    A shard is a range of rows by key and conversation, so rows with one key are split too; its size is
    bounded by `SHARD_TURNS` on average. Nodes of one shard are finished there. The rest, as many in a
    shard as its first and last row have turns, are summed by digest of their turns. Ids that end at one
    of these are hashed one after another, in batches, however many they are.
    """
    spark = rows.sparkSession
    bounded_batches(spark)
    rows = stored(rows.select("conv_id", "key"), "trie-rows")
    turns = rows.agg(F.sum(F.octet_length("key"))).first()[0]
    if turns is None:
        return spark.createDataFrame([], _NODE).select(*COLUMNS)
    number = shards or max(
        int(spark.conf.get("spark.sql.shuffle.partitions")), -(-turns // (_RECORD.itemsize * SHARD_TURNS))
    )
    dealt = stored(
        rows.repartitionByRange(number, "key", "conv_id").withColumn("shard", F.spark_partition_id()), "trie-shards"
    )
    nodes = stored(
        dealt.groupBy("shard").cogroup(_neighbours(dealt).groupBy("shard")).applyInPandas(_shard_nodes, _NODE), "trie-nodes"
    )
    whole, shared = nodes.where("node is null"), nodes.where("node is not null")
    ends = (
        shared.where("ids is not null")
        .select("node", "shard", "chunk", "ids")
        .repartition("node")
        .sortWithinPartitions("node", "shard", "chunk")
        .mapInPandas(_digests, "node string, ends_sha256 string")
    )
    sums = [F.sum(name).alias(name) for name in ("n_convs", "n_children", "n_leaves", "saved_tokens")]
    joined = stored(
        shared.where("ids is null")
        .groupBy("node", "depth", "parent")
        .agg(F.min("conv_id").alias("conv_id"), *sums)
        .join(ends, "node", "left"),
        "trie-joined",
    )
    # Who a shared node is, for each shard that holds a part of it: so a child looks in its own shard.
    named = stored(
        shared.where("ids is null").select("node", "shard").join(joined.select("node", F.col("conv_id").alias("_id")), "node"),
        "trie-named",
    )
    below = whole.where("parent is not null").join(named.withColumnRenamed("node", "parent"), ["shard", "parent"])
    parents = joined.select(F.col("node").alias("parent"), F.col("conv_id").alias("_id"))
    return (
        whole.where("parent is null")
        .select(*COLUMNS)
        .unionByName(below.withColumn("parent_conv_id", F.col("_id")).select(*COLUMNS))
        .unionByName(
            joined.join(parents, "parent", "left")
            .withColumn("parent_conv_id", F.col("_id"))
            .withColumn("ends_sha256", F.coalesce("ends_sha256", F.lit(_NO_IDS)))
            .select(*COLUMNS)
        )
    )


def _neighbours(dealt: DataFrame) -> DataFrame:
    """(shard, before, after): the last key of the shard before and the first of the one after, null at either end.

    There is one row for each shard, and as many reach one task.
    """
    from pyspark.sql.window import Window

    ends = stored(dealt.groupBy("shard").agg(F.min("key").alias("first"), F.max("key").alias("last")), "trie-ends")
    order = Window.orderBy("shard")
    return ends.select(
        "shard", F.lag("last").over(order).alias("before"), F.lead("first").over(order).alias("after")
    )


def _common(left: bytes | None, right: bytes | None) -> int:
    """How many turns two keys share from the start; -1 if one is not there."""
    if left is None or right is None:
        return -1
    size = min(len(left), len(right)) // _RECORD.itemsize * _RECORD.itemsize
    differ = np.flatnonzero(np.frombuffer(left[:size], dtype=np.uint8) != np.frombuffer(right[:size], dtype=np.uint8))
    return (int(differ[0]) if len(differ) else size) // _RECORD.itemsize


class _Matrix:
    """Turn ids of rows, padded with zeros, a block of columns at a time. No digest is zero."""

    def __init__(self, keys: list[bytes]) -> None:
        self.length = np.array([len(key) // _RECORD.itemsize for key in keys], dtype=np.int64)
        self.start = np.concatenate([[0], np.cumsum(self.length)[:-1]])
        flat = np.frombuffer(b"".join(keys), dtype=_RECORD)
        self.ids = [np.append(flat[name].astype(np.uint64), np.uint64(0)) for name in ("high", "low")]
        self.bytes = flat["bytes"].astype(np.int64)

    def block(self, rows: np.ndarray, first: int) -> list[np.ndarray]:
        """High and low halves of the ids at `first` to `first + BLOCK` of the rows."""
        columns = first + np.arange(BLOCK)
        inside = columns < self.length[rows, None]
        places = np.where(inside, self.start[rows, None] + columns, len(self.ids[0]) - 1)
        return [half[places] for half in self.ids]


def _changes(halves: list[np.ndarray]) -> np.ndarray:
    """Where a column differs from the row before; there is none for the first row."""
    return np.logical_or(*[half[1:] != half[:-1] for half in halves])


def _order(matrix: _Matrix, conv_id: np.ndarray) -> np.ndarray:
    """The rows sorted by turn ids, shorter ones first, then by conversation.

    Block after block, rows that are still equal are sorted among themselves by lexsort. A row's rank is
    the place at which the rows equal to it begin.
    """
    rank = np.zeros(len(conv_id), dtype=np.int64)
    rows, first = np.arange(len(conv_id)), 0
    while len(rows):
        going = matrix.length[rows] > first
        ended, counts = np.unique(rank[rows[~going]], return_counts=True)
        rows = rows[going]
        if len(ended) and len(rows):
            place = np.minimum(np.searchsorted(ended, rank[rows]), len(ended) - 1)
            rank[rows] += np.where(ended[place] == rank[rows], counts[place], 0)
        if len(rows):
            halves = matrix.block(rows, first)
            columns = [half[:, column] for column in reversed(range(BLOCK)) for half in reversed(halves)]
            order = np.lexsort([*columns, rank[rows]])
            rows = rows[order]
            group = np.concatenate([[True], rank[rows][1:] != rank[rows][:-1]])
            change = group.copy()
            change[1:] |= _changes([half[order] for half in halves]).any(axis=1)
            at = np.arange(len(rows))
            since = lambda mark: np.maximum.accumulate(np.where(mark, at, 0))
            rank[rows] += since(change) - since(group)
        first += BLOCK
    return np.lexsort([conv_id, rank])


def _depths(matrix: _Matrix) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """For each depth from 1 on: the sorted rows that are as long, and which of them start a node."""
    changed = np.zeros(len(matrix.length), dtype=bool)
    first, longest = 0, int(matrix.length.max(initial=0))
    while first < longest:
        rows = np.flatnonzero(matrix.length > first)
        halves = matrix.block(rows, first)
        marks = np.ones((len(rows), BLOCK + 1), dtype=bool)
        # A row whose forerunner has ended starts anew; so does one that differed in an earlier block.
        marks[1:, 0] = (rows[1:] != rows[:-1] + 1) | changed[rows[1:]]
        marks[1:, 1:] = _changes(halves)
        marks = np.logical_or.accumulate(marks, axis=1)
        changed[rows] = marks[:, -1]
        for column in range(min(BLOCK, longest - first)):
            here = matrix.length[rows] > first + column
            yield rows[here], marks[here, column + 1]
        first += BLOCK


def _path(key: bytes, depth: int) -> list[str]:
    """Digests of the first 0, 1, .. `depth` turns of a key."""
    digest, out = hashlib.md5(), []
    for at in range(depth + 1):
        out.append(f"{at}:{digest.hexdigest()}")
        digest.update(key[at * _RECORD.itemsize : (at + 1) * _RECORD.itemsize])
    return out


def _shard_nodes(left: pd.DataFrame, right: pd.DataFrame) -> pd.DataFrame:
    """The nodes of a shard's rows, as `_NODE`.

    Nodes that reach into another shard have the digest of their turns in `node` and hold this shard's
    share; children and leaves count where they begin and end, and so once. Rows with `ids` hold ids
    that end at such a node. `parent` is the digest of a parent that reaches into another shard.
    """
    conv_id, keys = left["conv_id"].to_numpy(np.int64), left["key"].tolist()
    order = _order(_Matrix(keys), conv_id)
    conv_id, keys = conv_id[order], [keys[row] for row in order]
    matrix, shard, last = _Matrix(keys), int(left["shard"].iloc[0]), len(keys) - 1
    before, after = _common(right["before"].iloc[0], keys[0]), _common(keys[-1], right["after"].iloc[0])
    paths = _path(keys[0], before), _path(keys[-1], after)
    length = matrix.length
    root = np.zeros(last + 1, dtype=bool)
    root[0] = True
    levels = [(np.arange(last + 1), root), *_depths(matrix)]

    # Where the row after goes on from all of this one, no leaf ends; the last row's is in another shard.
    goes_on = length == 0
    for depth, (rows, starts) in enumerate(levels):
        inner = rows[~starts] - 1
        goes_on[inner[length[inner] == depth]] = True
    goes_on[last] = after >= length[last]
    leaf = (~goes_on).astype(np.int64)
    saved = np.zeros(last + 1, dtype=np.int64)
    child = np.zeros(last + 1, dtype=np.int64)
    tables: list[dict] = []
    for depth in range(len(levels) - 1, -1, -1):
        rows, starts = levels[depth]
        at = np.flatnonzero(starts)
        first = rows[at]
        members = np.diff(np.append(at, len(rows)))
        text = matrix.bytes[matrix.start[first] + depth - 1] if depth else np.zeros(len(at), dtype=np.int64)
        begins = np.ones(len(at), dtype=np.int64)
        if depth <= before:
            begins[0] = 0
        saved[first] += text * (members - begins)
        tables.append(
            {
                "conv_id": np.minimum.reduceat(conv_id[rows], at),
                "n_convs": members,
                "n_children": np.add.reduceat(child[rows], at),
                "n_leaves": np.add.reduceat(leaf[rows], at),
                "saved_tokens": np.add.reduceat(saved[rows], at),
                "_first": first,
            }
        )
        child[:] = 0
        child[first] = begins
    tables.reverse()

    chunks: list[tuple] = []
    above, up = np.zeros(last + 1, dtype=np.int64), tables[0]
    for depth, (found, (rows, starts)) in enumerate(zip(tables, levels)):
        first = found.pop("_first")
        node = np.full(len(first), None, dtype=object)
        if depth <= before:
            node[0] = paths[0][depth]
        if depth <= after:
            node[-1] = paths[1][depth]
        parent, parent_id = np.full(len(first), None, dtype=object), np.full(len(first), -1)
        if depth:
            parent, parent_id = up["node"][above[first]], up["conv_id"][above[first]]
        within = np.cumsum(starts) - 1
        above[rows] = within
        ends = np.full(len(first), _NO_IDS, dtype=object)
        ending = length[rows] == depth
        # Rows that end at a node come first in it, and by conversation.
        for place, ids in _runs(within[ending], conv_id[rows[ending]]):
            if node[place] is None:
                ends[place] = hashlib.sha256(",".join(map(str, ids.tolist())).encode()).hexdigest()
            else:
                for chunk, at in enumerate(range(0, len(ids), CHUNK)):
                    chunks.append((depth, node[place], chunk, ",".join(map(str, ids[at : at + CHUNK].tolist()))))
        unknown = np.array([one is not None for one in parent]) if depth else np.ones(len(first), dtype=bool)
        found |= {"depth": np.full(len(first), depth), "parent_conv_id": pd.arrays.IntegerArray(parent_id, unknown)}
        found |= {"ends_sha256": ends, "node": node, "parent": parent}
        up = found
    out = pd.concat([pd.DataFrame(found) for found in tables], ignore_index=True)
    extra = pd.DataFrame(chunks, columns=["depth", "node", "chunk", "ids"]).astype({"depth": "int64", "chunk": "Int64"})
    if len(extra):
        out = pd.concat([out.assign(chunk=pd.NA, ids=None).astype({"chunk": "Int64"}), extra.assign(**dict.fromkeys(_NUMBERS, 0))])
    else:
        out = out.assign(chunk=pd.array([pd.NA] * len(out), dtype="Int64"), ids=None)
    return out.assign(shard=shard)[[part.split()[0] for part in _NODE.split(", ")]]


def _runs(groups: np.ndarray, values: np.ndarray) -> Iterator[tuple[int, np.ndarray]]:
    if len(groups):
        cuts = np.flatnonzero(groups[1:] != groups[:-1]) + 1
        for part, place in zip(np.split(values, cuts), groups[np.append(0, cuts)]):
            yield int(place), part


def _digests(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    """A digest for each node of rows sorted by node, whose ids are hashed as they come."""
    name, digest = None, None
    for batch in batches:
        done = []
        for node, ids in zip(batch["node"], batch["ids"]):
            if node != name:
                if digest is not None:
                    done.append((name, digest.hexdigest()))
                name, digest = node, hashlib.sha256()
            else:
                digest.update(b",")
            digest.update(ids.encode())
        if done:
            yield pd.DataFrame(done, columns=["node", "ends_sha256"])
    if digest is not None:
        yield pd.DataFrame([(name, digest.hexdigest())], columns=["node", "ends_sha256"])


GROUP = 5
MOST_BORROWED = 9


def _borrowed(conv_id: Column) -> Column:
    return F.crc32(conv_id.cast("string").cast("binary")) % MOST_BORROWED


def rebuilt(records: DataFrame, group: int = GROUP) -> DataFrame:
    """(conv_id, turns): every conversation with its first turns taken from the first of its group.

    Of conversation c the first h turns are those of c - c mod `group`, all if it has fewer, none if it is
    not there; c's own turns after its first h follow. h is the CRC-32 of the decimal c, mod 9.
    """
    base = F.col("conv_id") - F.pmod(F.col("conv_id"), F.lit(group))
    heads = records.where(base == F.col("conv_id")).select(
        F.col("conv_id").alias("_base"), F.slice("turns", 1, MOST_BORROWED - 1).alias("_head")
    )
    taken = _borrowed(F.col("conv_id")).cast("int")
    none = F.array().cast("array<string>")
    own = F.when(F.size("turns") > taken, F.slice("turns", taken + 1, F.size("turns"))).otherwise(none)
    head = F.when(taken > 0, F.slice(F.coalesce("_head", none), F.lit(1), taken)).otherwise(none)
    return records.join(heads, base == F.col("_base"), "left").select("conv_id", F.concat(head, own).alias("turns"))


def op11_prefix_trie(spark, sf_dir):
    turns = table(spark, sf_dir, "conversations").select("conv_id", "turn", "role", "text")
    records = stored(turn_records(turns, "conv_id", "turn", "role", "text"), "trie-turns")
    return prefix_trie(sequences(rebuilt(records)))


# CRC-32 bit by bit, as SQL has no function for it.
ORACLE = """
with turns as (
    select conv_id, list({'role': coalesce(role, ''), 'text': coalesce(text, '')}
                         order by turn nulls first, coalesce(role, ''), coalesce(text, '')) as own
    from conversations where conv_id is not null group by conv_id
),
crc as (
    select conv_id, own, (xor(list_reduce(
        list_prepend(4294967295::bigint, list_transform(range(1, length(conv_id::varchar) + 1),
            lambda i: ascii(substr(conv_id::varchar, i, 1))::bigint)),
        lambda state, byte: list_reduce(
            list_prepend(xor(state, byte), list_transform(range(8), lambda k: 0::bigint)),
            lambda s, k: xor(s >> 1, 3988292384::bigint * (s & 1)))
    ), 4294967295::bigint) % 9)::int as h
    from turns
),
convs as (
    select c.conv_id, list_concat(coalesce(b.own[1:c.h], []), c.own[c.h + 1:]) as said
    from crc c left join turns b on b.conv_id = c.conv_id - ((c.conv_id % 5) + 5) % 5
),
starts as (
    select conv_id, said, unnest(range(len(said) + 1)) as depth from convs
),
nodes as (
    select said[1:depth] as path, depth, min(conv_id) as conv_id, count(*) as n_convs,
        coalesce(strlen(any_value(said[depth]).text), 0) as bytes,
        sha256(coalesce(string_agg(conv_id::varchar, ',' order by conv_id) filter (where len(said) = depth), '')) as ends_sha256
    from starts group by said[1:depth], depth
),
children as (
    select path[1:depth - 1] as path, count(*) as n_children from nodes where depth > 0 group by 1
),
full_nodes as (
    select n.*, coalesce(c.n_children, 0) as n_children from nodes n left join children c on c.path = n.path
),
above as (
    select path, unnest(range(depth + 1)) as up, (n_convs - 1) * bytes as own, (n_children = 0)::int as leaf from full_nodes
),
subtrees as (
    select path[1:up] as path, sum(own) as saved, sum(leaf) as leaves from above group by 1
)
select n.conv_id, n.depth::bigint as depth, p.conv_id as parent_conv_id, n.n_convs::bigint as n_convs,
    n.n_children::bigint as n_children, s.leaves::bigint as n_leaves, s.saved::bigint as saved_tokens, n.ends_sha256
from full_nodes n
join subtrees s on s.path = n.path
left join nodes p on p.path = n.path[1:n.depth - 1] and p.depth = n.depth - 1
"""
