"""Conversation prefix trie: shared openings of conversations, as nodes with their counts.

Method: z-fast tries. A prefix is known by a polynomial hash, which can be continued from any
place and cut and joined, so no text and no whole conversation has to be in one task. Tries
are compacted: a node stands for an edge of several turns and is found in a hash table under
its handle, its prefix at the two-fattest depth of the edge (the depth in the edge divisible
by the largest power of two). A fat binary search over depths finds the exit node of a
conversation in as many lookups as its length has bits. Each task inserts its units in
batches into tries of bounded size, sums counts up the compacted tree, and expands the edges;
equal nodes of all tries are then added up by their hash, with partial sums before the
shuffle, so an opening in a third of all conversations is one row per trie.

Conversations are cut into units of at most UNIT turns. A unit is a string in a trie whose
root is the prefix before it, so the longest conversation is spread over many tasks.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterable, Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from arealens.llm.common import stored
from arealens.skew import spread_join

FAMILY = 5
HEAD = 9
UNIT = 1024
TRIE_TURNS = 1 << 18
BATCH = 4096
PIECE = 4096
WIDTH = 16
PRIME = (1 << 127) - 1
FACTOR = 0x2545F4914F6CDD1D9E3779B97F4A7C15
ROOT = bytes(WIDTH)

RUNS = "part int, conv_id long, before long, n int, accs binary, sizes binary, first boolean, last boolean"
UNITS = "conv_id long, depth long, above binary, accs binary, sizes binary, ends boolean"
NODES = "hash binary, depth long, above binary, size long, n long, least long"


def _number(value: bytes) -> int:
    return int.from_bytes(value, "big")


def _bytes(value: int) -> bytes:
    return value.to_bytes(WIDTH, "big")


def two_fattest(a: int, b: int) -> int:
    """The number in (a, b] that the largest power of two divides."""
    return b & -1 << (a ^ b).bit_length() - 1


class ZFastTrie:
    """Compacted tries over prefix hashes; a unit is its root (depth and hash) and the hashes of its further prefixes."""

    def __init__(self) -> None:
        # Of each node: depths of the ends of its edge, a unit that runs along the edge, units that end at it, least id.
        self.top: list[int] = []
        self.bottom: list[int] = []
        self.unit: list[tuple[int, bytes, bytes]] = []
        self.up: list[int] = []
        self.count: list[int] = []
        self.least: list[int] = []
        self.roots: dict[tuple[int, bytes], int] = {}
        self.handles: dict[tuple[int, bytes], int] = {}  # by root node and prefix at the two-fattest depth of the edge
        self.children: dict[tuple[int, bytes], int] = {}  # by node and prefix one turn below it

    @staticmethod
    def at(unit: tuple[int, bytes, bytes], depth: int) -> bytes:
        """Hash of a unit's prefix of `depth` turns, which lies below its root."""
        i = (depth - unit[0] - 1) * WIDTH
        return unit[1][i:i + WIDTH]

    def _node(self, top: int, bottom: int, unit: tuple[int, bytes, bytes], up: int) -> int:
        self.top.append(top)
        self.bottom.append(bottom)
        self.unit.append(unit)
        self.up.append(up)
        self.count.append(0)
        self.least.append(1 << 63)
        return len(self.top) - 1

    def locate(self, root: int, unit: tuple[int, bytes, bytes], end: int) -> tuple[int, int]:
        """Exit node of a unit and how deep it agrees with it, by fat binary search over (depth of the root, end]."""
        a, b, node = self.bottom[root], end, root
        while a < b:
            f = two_fattest(a, b)
            found = self.handles.get((root, self.at(unit, f)))
            if found is None:
                b = f - 1
            else:
                node, a = found, self.bottom[found]
        bottom = self.bottom[node]
        if bottom < end and (node == root or self.at(unit, bottom) == self.at(self.unit[node], bottom)):
            node = self.children.get((node, self.at(unit, bottom + 1)), node)
        if node == root:
            return root, bottom
        # Along the edge, agreement ends once; halve the depths that are left.
        low, high = self.top[node], min(self.bottom[node], end)
        while low < high:
            middle = (low + high + 1) // 2
            if self.at(unit, middle) == self.at(self.unit[node], middle):
                low = middle
            else:
                high = middle - 1
        return node, low

    def insert(self, depth: int, above: bytes, accs: bytes, sizes: bytes, count: int, least: int) -> None:
        """Add `count` equal units, of which the smallest conversation is `least`."""
        unit, end = (depth, accs, sizes), depth + len(accs) // WIDTH
        root = self.roots.get((depth, above))
        if root is None:
            root = self.roots[depth, above] = self._node(depth, depth, (depth, b"", b""), -1)
        node, agrees = self.locate(root, unit, end)
        if agrees < self.bottom[node]:
            node = self._split(root, node, agrees)
        if agrees < end:
            leaf = self._node(agrees, end, unit, node)
            self.children[node, self.at(unit, agrees + 1)] = leaf
            self.handles[root, self.at(unit, two_fattest(agrees, end))] = leaf
            node = leaf
        self.count[node] += count
        self.least[node] = min(self.least[node], least)

    def _split(self, root: int, node: int, depth: int) -> int:
        """Cut a node's edge at a depth; the upper part becomes a node of its own."""
        unit, top, bottom = self.unit[node], self.top[node], self.bottom[node]
        upper = self._node(top, depth, unit, self.up[node])
        del self.handles[root, self.at(unit, two_fattest(top, bottom))]
        self.handles[root, self.at(unit, two_fattest(top, depth))] = upper
        self.handles[root, self.at(unit, two_fattest(depth, bottom))] = node
        self.children[self.up[node], self.at(unit, top + 1)] = upper
        self.children[upper, self.at(unit, depth + 1)] = node
        self.top[node], self.up[node] = depth, upper
        return upper

    def expand(self) -> Iterator[tuple[bytes, int, bytes | None, int, int, int]]:
        """(hash, depth, hash above, bytes of the last turn, members, least member) of each prefix along each edge."""
        for node in sorted(range(len(self.top)), key=self.bottom.__getitem__, reverse=True):
            up = self.up[node]
            if up >= 0:
                self.count[up] += self.count[node]
                self.least[up] = min(self.least[up], self.least[node])
        for (depth, above), node in self.roots.items():
            if depth == 0:
                yield above, 0, None, 0, self.count[node], self.least[node]
        above_of = {node: above for (_, above), node in self.roots.items()}
        for node, up in enumerate(self.up):
            if up < 0:
                continue
            unit, top = self.unit[node], self.top[node]
            above = above_of[up] if up in above_of else self.at(unit, top)
            for depth in range(top + 1, self.bottom[node] + 1):
                own, i = self.at(unit, depth), (depth - unit[0] - 1) * 8
                yield own, depth, above, int.from_bytes(unit[2][i:i + 8], "big"), self.count[node], self.least[node]
                above = own


def _records(rows: list[tuple], schema: pa.Schema) -> pa.RecordBatch:
    columns = list(zip(*rows)) if rows else [[] for _ in schema]
    return pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(columns, schema)], schema=schema)


def _rows(batches: Iterable[pa.RecordBatch]) -> Iterator[tuple]:
    for batch in batches:
        yield from zip(*(c.to_pylist() for c in batch.columns))


def hashed_turns(turns: DataFrame, conv_col: str, turn_col: str, role_col: str, text_col: str) -> DataFrame:
    """(conv_id, turn, digest, size) of each turn that has a conversation: what the trie needs of it, without its text."""
    role, text = (F.coalesce(F.col(c).cast("string"), F.lit("")) for c in (role_col, text_col))
    digest = F.unhex(F.md5(F.concat(F.octet_length(role).cast("string"), F.lit(":"), role, text)))
    return turns.select(F.col(conv_col).cast("long").alias("conv_id"), F.col(turn_col).cast("long").alias("turn"), digest.alias("digest"),
                        F.octet_length(text).cast("long").alias("size")).where("conv_id is not null")


def runs(turns: DataFrame) -> DataFrame:
    """Conversations in order, cut into runs of at most UNIT turns with prefix hashes, each counted from the start of its partition.

    A range sort places the turns, so a long conversation lies in several partitions. `accs`
    holds the hash before the run and after each of its turns.
    """

    def fold(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext

        part = TaskContext.get().partitionId()
        schema = pa.schema([("part", pa.int32()), ("conv_id", pa.int64()), ("before", pa.int64()), ("n", pa.int32()), ("accs", pa.binary()),
                            ("sizes", pa.binary()), ("first", pa.bool_()), ("last", pa.bool_())])
        conv, start, n, acc, accs, sizes, out = None, None, 0, 0, [ROOT], [], []
        for own, _, digest, size in _rows(batches):
            if conv is not None and (own != conv or len(sizes) == UNIT):
                out.append((part, conv, n - len(sizes), len(sizes), b"".join(accs), b"".join(sizes), conv == start, False))
                accs, sizes = accs[-1:], []
                if len(out) == BATCH:
                    yield _records(out, schema)
                    out = []
            if own != conv:
                start = own if conv is None else start
                conv, n, acc, accs = own, 0, 0, [ROOT]
            acc = (acc * FACTOR + _number(digest) + 1) % PRIME
            n += 1
            accs.append(_bytes(acc))
            sizes.append(size.to_bytes(8, "big"))
        if conv is not None:
            out.append((part, conv, n - len(sizes), len(sizes), b"".join(accs), b"".join(sizes), conv == start, True))
        yield _records(out, schema)

    order = ["conv_id", F.asc_nulls_first("turn"), "digest"]
    return turns.repartitionByRange(*order).sortWithinPartitions(*order).mapInArrow(fold, RUNS)


def carried(parts: DataFrame) -> dict[int, tuple[int, int]]:
    """For partitions that start inside a conversation: its turns and hash in the partitions before. At most two rows a partition are read."""
    end = F.struct("conv_id", (F.col("before") + F.col("n")).alias("n"), F.expr(f"substring(accs, {WIDTH} * n + 1, {WIDTH})").alias("acc"))
    ends = parts.where("first or last").groupBy("part").agg(F.max_by(F.when(F.col("first"), end), F.when(F.col("first"), F.col("before"))).alias("f"),
                                                            F.max_by(end, F.col("last")).alias("l"))
    out: dict[int, tuple[int, int]] = {}
    conv, turns, acc = None, 0, 0
    for row in sorted(ends.collect()):
        same = row.f.conv_id == conv
        if same:
            out[row.part] = (turns, acc)
        front = (turns, acc) if same and row.l.conv_id == conv else (0, 0)
        conv, turns = row.l.conv_id, front[0] + row.l.n
        acc = (front[1] * pow(FACTOR, row.l.n, PRIME) + _number(row.l.acc)) % PRIME
    return out


def joined_runs(parts: DataFrame) -> DataFrame:
    """Runs counted from the start of the conversation, in whatever partition it starts."""
    carry = carried(parts)  # an entry for each partition at most

    def shift(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        schema = pa.schema([("conv_id", pa.int64()), ("before", pa.int64()), ("n", pa.int32()), ("accs", pa.binary()), ("sizes", pa.binary())])
        for batch in batches:
            out = []
            for part, conv, before, n, accs, sizes, first, _ in _rows([batch]):
                turns, front = carry.get(part, (0, 0)) if first else (0, 0)
                out.append((conv, before + turns, n, _moved(accs, front, before), sizes))
            yield _records(out, schema)

    return parts.mapInArrow(shift, "conv_id long, before long, n int, accs binary, sizes binary")


def _moved(accs: bytes, front: int, power: int) -> bytes:
    """Hashes of consecutive prefixes after something with hash `front` is put before them; the first has `power` turns behind that."""
    if not front:
        return accs
    factor, out = pow(FACTOR, power, PRIME) * front % PRIME, []
    for i in range(0, len(accs), WIDTH):
        out.append(_bytes((factor + _number(accs[i:i + WIDTH])) % PRIME))
        factor = factor * FACTOR % PRIME
    return b"".join(out)


def _joined(turns: Column, field: str) -> Column:
    return F.aggregate(turns, F.lit(b""), lambda acc, t: F.concat(acc, t[field]))


def openings(own: DataFrame, family: int, heads: int) -> DataFrame:
    """Per conversation: its turns (total), how many of its own it gives up (head), the hash of those, and what it opens with instead."""
    most = heads - 1
    places = F.sequence(F.lit(1), F.least(F.col("n"), F.lit(most) - F.col("before")).cast("int"))
    turn = F.transform(places, lambda j: F.struct((F.col("before") + j).alias("i"),
                                                  F.substring("accs", j * WIDTH + 1, F.lit(WIDTH)).alias("acc"),
                                                  F.substring("sizes", j * 8 - 7, F.lit(8)).alias("size")))
    # Only the first turns are collected, at most heads - 1 of a conversation.
    held = F.array_sort(F.flatten(F.collect_list(F.when(F.col("before") < most, turn))))
    convs = stored(own.groupBy("conv_id").agg(F.max(F.col("before") + F.col("n")).alias("total"), held.alias("turns")))
    head = (F.crc32(F.col("conv_id").cast("string").cast("binary")) % heads).cast("int")
    given_up = F.filter("turns", lambda t: t["i"] == F.col("head"))
    mine = convs.withColumn("head", head).select("conv_id", "total", "head", F.coalesce(F.get(given_up, F.lit(0))["acc"], F.lit(ROOT)).alias("own"),
                                                 (F.col("conv_id") - F.col("conv_id") % family).alias("base"))
    theirs = convs.select(F.col("conv_id").alias("base"), "turns")
    opening = F.coalesce(F.filter("turns", lambda t: t["i"] <= F.col("head")), F.filter(F.array(F.struct(
        F.lit(0).cast("long").alias("i"), F.lit(b"").alias("acc"), F.lit(b"").alias("size"))), lambda t: F.lit(False)))
    return mine.join(theirs, "base", "left").withColumn("opening", opening).select(
        "conv_id", "total", "head", "own", _joined(F.col("opening"), "acc").alias("o_accs"), _joined(F.col("opening"), "size").alias("o_sizes"))


def units(turns: DataFrame, family: int, heads: int) -> DataFrame:
    """Rebuilt conversations as units: the depth and hash of the prefix above, hash and size after each turn, whether the conversation ends."""
    own = stored(joined_runs(stored(runs(turns))))
    rebuilt = spread_join(own, stored(openings(own, family, heads)), "conv_id")

    def rebuild(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        schema = pa.schema([("conv_id", pa.int64()), ("depth", pa.int64()), ("above", pa.binary()), ("accs", pa.binary()), ("sizes", pa.binary()),
                            ("ends", pa.bool_())])
        for batch in batches:
            out = []
            for conv, before, n, accs, sizes, total, head, own_head, o_accs, o_sizes in _rows([batch]):
                opened = len(o_accs) // WIDTH
                lead = before < min(head + 1, total) <= before + n
                if before + n <= head and not lead:
                    continue
                # Own hashes after the head are moved from behind the own head to behind the opening.
                skip = max(head - before, 0)
                tail = accs[WIDTH * skip:] if before + n > head else b""
                change = (_number(o_accs[-WIDTH:]) - _number(own_head)) % PRIME
                tail = _moved(tail, change, before + skip - head)
                if lead:
                    out.append((conv, 0, ROOT, o_accs + tail[WIDTH:], o_sizes + (sizes[8 * skip:] if tail else b""), before + n == total))
                else:
                    out.append((conv, opened + before - head, tail[:WIDTH], tail[WIDTH:], sizes, before + n == total))
            yield _records(out, schema)

    columns = ["conv_id", "before", "n", "accs", "sizes", "total", "head", "own", "o_accs", "o_sizes"]
    return stored(rebuilt.select(*columns).mapInArrow(rebuild, UNITS))


def trie_nodes(parts: DataFrame) -> DataFrame:
    """Nodes of the tries of all units, equal ones added up: (hash, depth, above, size, n, least)."""

    def grow(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        schema = pa.schema([("hash", pa.binary()), ("depth", pa.int64()), ("above", pa.binary()), ("size", pa.int64()), ("n", pa.int64()),
                            ("least", pa.int64())])
        trie, held, turns = ZFastTrie(), {}, 0

        def insert() -> None:
            for (depth, above, _), (accs, sizes, count, least) in held.items():
                trie.insert(depth, above, accs, sizes, count, least)
            held.clear()

        def nodes() -> Iterator[pa.RecordBatch]:
            out = []
            for row in trie.expand():
                out.append(row)
                if len(out) == BATCH:
                    yield _records(out, schema)
                    out = []
            yield _records(out, schema)

        for conv, depth, above, accs, sizes in _rows(batches):
            # Units of a batch that end at the same prefix go in as one.
            key = (depth, above, accs[-WIDTH:])
            seen = held.get(key)
            held[key] = (accs, sizes, seen[2] + 1, min(seen[3], conv)) if seen else (accs, sizes, 1, conv)
            turns += 1 + (0 if seen else len(sizes) // 8)
            if len(held) == BATCH:
                insert()
            if turns >= TRIE_TURNS:
                insert()
                yield from nodes()
                trie, turns = ZFastTrie(), 0
        insert()
        yield from nodes()

    grown = parts.select("conv_id", "depth", "above", "accs", "sizes").mapInArrow(grow, NODES)
    return grown.groupBy("hash", "depth").agg(F.min("above").alias("above"), F.max("size").alias("size"), F.sum("n").alias("n"),
                                              F.min("least").alias("least"))


def id_digests(ends: DataFrame) -> DataFrame:
    """SHA-256 of the comma-joined ids of each node, ascending: (hash, depth, ends_sha256).

    A range sort spreads the ids of a crowded node over tasks that write them as pieces of
    text; the digest itself is a stream, so one task reads a node's pieces in order, one at
    a time.
    """

    def write(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        schema = pa.schema([("hash", pa.binary()), ("depth", pa.int64()), ("first", pa.int64()), ("piece", pa.binary())])
        key, first, held, size = None, None, [], 0
        for batch in batches:
            out = []
            for own, depth, conv in _rows([batch]):
                if held and (key != (own, depth) or size >= PIECE):
                    out.append((*key, first, b",".join(held)))
                    held = []
                if not held:
                    key, first, size = (own, depth), conv, 0
                held.append(b"%d" % conv)
                size += len(held[-1]) + 1
            yield _records(out, schema)
        if held:
            yield _records([(*key, first, b",".join(held))], schema)

    def digest(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        schema = pa.schema([("hash", pa.binary()), ("depth", pa.int64()), ("ends_sha256", pa.string())])
        key, state = None, None
        for batch in batches:
            out = []
            for own, depth, _, piece in _rows([batch]):
                if key == (own, depth):
                    state.update(b",")
                else:
                    if key:
                        out.append((*key, state.hexdigest()))
                    key, state = (own, depth), hashlib.sha256()
                state.update(piece)
            yield _records(out, schema)
        if key:
            yield _records([(*key, state.hexdigest())], schema)

    order = ["hash", "depth", "conv_id"]
    pieces = ends.repartitionByRange(*order).sortWithinPartitions(*order).mapInArrow(write, "hash binary, depth long, first long, piece binary")
    pieces = stored(pieces).repartition("hash", "depth").sortWithinPartitions("hash", "depth", "first")
    return pieces.mapInArrow(digest, "hash binary, depth long, ends_sha256 string")


def subtree_sums(parts: DataFrame, nodes: DataFrame) -> DataFrame:
    """Leaves and saved bytes below each node, itself included: (hash, depth, n_leaves, saved).

    A node belongs to its least conversation, which then has all that follows it on its own
    path that is not shared with a smaller one: the end of the path. So what a conversation
    adds to each prefix of its path is a sum over the path from there on.
    """
    places = F.sequence(F.when(F.col("depth") == 0, 0).otherwise(1), (F.octet_length("sizes") / 8).cast("int"))
    paths = parts.select("conv_id", "depth", "above", "accs", F.explode(places).alias("j")).select(
        "conv_id", (F.col("depth") + F.col("j")).alias("depth"),
        F.when(F.col("j") == 0, F.col("above")).otherwise(F.substring("accs", F.col("j") * WIDTH - WIDTH + 1, F.lit(WIDTH))).alias("hash"))
    own = nodes.select(F.col("least").alias("conv_id"), "depth", ((F.col("n") - 1) * F.col("size")).alias("saved"),
                       F.when(F.col("n_children") == 0, 1).otherwise(0).alias("leaf"))
    stretch = F.floor(F.col("depth") / UNIT).alias("stretch")
    valued = stored(paths.join(own, ["conv_id", "depth"], "left").select("conv_id", stretch, "depth", "hash", F.coalesce("saved", F.lit(0)).alias("saved"),
                                                                        F.coalesce("leaf", F.lit(0)).alias("leaf")))
    # Sums along a path go by stretches of UNIT turns, so that a long conversation is not one group.
    within = Window.partitionBy("conv_id", "stretch").orderBy(F.desc("depth")).rowsBetween(Window.unboundedPreceding, 0)
    beyond = Window.partitionBy("conv_id").orderBy(F.desc("stretch")).rowsBetween(Window.unboundedPreceding, -1)
    later = valued.groupBy("conv_id", "stretch").agg(F.sum("saved").alias("s"), F.sum("leaf").alias("l")).select(
        "conv_id", "stretch", F.sum("s").over(beyond).alias("s"), F.sum("l").over(beyond).alias("l")).where("s is not null")
    sums = valued.select("conv_id", "stretch", "depth", "hash", F.sum("saved").over(within).alias("saved"), F.sum("leaf").over(within).alias("leaf"))
    sums = sums.join(later, ["conv_id", "stretch"], "left").select(
        "hash", "depth", (F.col("leaf") + F.coalesce("l", F.lit(0))).alias("leaf"), (F.col("saved") + F.coalesce("s", F.lit(0))).alias("saved"))
    return sums.where("leaf > 0 or saved > 0").groupBy("hash", "depth").agg(F.sum("leaf").alias("n_leaves"), F.sum("saved").alias("saved"))


def prefix_trie(conversations: DataFrame, conv_col: str = "conv_id", turn_col: str = "turn", role_col: str = "role", text_col: str = "text",
                family: int = FAMILY, heads: int = HEAD) -> DataFrame:
    """The prefix trie of all conversations, one row per node.

    Conversation c takes its first h = crc32(c) mod `heads` turns from conversation c - c mod
    `family` (mod as in SQL, with the sign of c), then goes on with its own turns after its
    first h; `heads` = 1 leaves conversations as they are. Returns conv_id (the least member),
    depth, parent_conv_id, n_convs, n_children, n_leaves, saved_tokens and ends_sha256.
    Turns are ordered by `turn`, null first, ties by a digest of role and text, so repeated rows
    are turns of their own; null roles and texts are empty. Rows without a conversation take
    no part. An empty table gives no node, not even a root. Other columns are ignored.
    Prefixes are told apart by 127 bits of hash.
    """
    if family < 1 or heads < 1:
        raise ValueError("family and heads are at least 1")
    parts = units(hashed_turns(conversations, conv_col, turn_col, role_col, text_col), family, heads)
    nodes = stored(trie_nodes(parts))
    children = nodes.where("depth > 0").groupBy(F.col("above").alias("hash"), (F.col("depth") - 1).alias("depth")).agg(
        F.count(F.lit(1)).alias("n_children"))
    nodes = stored(nodes.join(children, ["hash", "depth"], "left").withColumn("n_children", F.coalesce("n_children", F.lit(0))))
    last = F.when(F.octet_length("accs") > 0, F.expr(f"substring(accs, octet_length(accs) - {WIDTH - 1}, {WIDTH})")).otherwise(F.col("above"))
    ends = parts.where("ends").select(last.alias("hash"), (F.col("depth") + F.octet_length("sizes") / 8).cast("long").alias("depth"), "conv_id")
    full = nodes.join(subtree_sums(parts, nodes), ["hash", "depth"], "left").join(id_digests(ends), ["hash", "depth"], "left")
    parents = nodes.select(F.col("hash").alias("above"), F.col("least").alias("parent_conv_id"))
    return spread_join(stored(full), parents, "above", "left").select(
        F.col("least").alias("conv_id"), "depth", "parent_conv_id", F.col("n").alias("n_convs"), "n_children",
        F.coalesce("n_leaves", F.lit(0)).cast("long").alias("n_leaves"), F.coalesce("saved", F.lit(0)).cast("long").alias("saved_tokens"),
        F.coalesce("ends_sha256", F.lit(hashlib.sha256(b"").hexdigest())).alias("ends_sha256"))
