"""Language-model scores by prediction by partial matching over bytes.

Method: a text is spelled as its words, each ended by a space, and one end. Every byte is
predicted from the `ORDER` bytes before it, across word borders; a text starts behind ends.
A context predicts a byte it has seen with (count - 1/2) / total, and else escapes with
(distinct bytes / 2) / total to the next shorter context, where bytes already ruled out are
left out of counts, totals and distinct bytes. Below the empty context the bytes not seen
anywhere share what is left. Contexts count every byte of every training text.

The chance of a word is that of its bytes and its space, so it hangs on the words before it.
It is blended with the document's own adaptive counts: after t words, of
which k are the next word, its chance is (k + m * pretrained chance) / (t + m), that is, an
escape of m / (t + m) from the document to the corpus. Each m of `ESCAPES` scores the
document, and the document's chance is their mean, so repetitive texts escape seldom.

Words and contexts are counted over all training texts and kept as tables. Blocks of
documents ask shards about their distinct words, and about their distinct (context, byte)
pairs; shards hold each word's and pair's count over the corpus and ask the shorter contexts
about pairs that no training text has. So a word or pair that makes up a large part of all
text is one entry per block, and no table is sent whole to any task. Pairs are answered by
their counts, which pack into a third of the room that chances take.
"""

from __future__ import annotations

from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from arealens.llm.common import pack, stored, to_blocks, unpack

ORDER = 5
ESCAPES = (10.0, 100.0, 1000.0, 10000.0)
FOLDS = 10
SHARD_BYTES = 24 << 20
END = b"\n"
SYMBOLS = 256
ROWS_SQL = "shard int, block long, body binary"
PAIR_SQL = "shard int, ctx long, sym int, n long, new boolean"


def held_out(id_col: str = "id", folds: int = FOLDS) -> Column:
    """Whether a row is kept from training: crc32 of the id as text is divisible by `folds`. A null id is kept from it."""
    return F.coalesce(F.crc32(F.col(id_col).cast("string").cast("binary")), F.lit(0)) % folds == 0


def _held(ids: list[int | None], folds: int) -> np.ndarray:
    import zlib

    return np.array([i is None or zlib.crc32(str(i).encode()) % folds == 0 for i in ids], bool)


class _Texts:
    """The tokens and bytes of a block's texts. A text is spelled as its words, each with a space behind it, and one end.

    Distinct tokens are kept with the space behind them, the end as itself.
    """

    def __init__(self, table: pa.Table, order: int, folds: int):
        self.ids = table["id"].to_pylist()
        self.held = _held(self.ids, folds)
        words = ((x or b"").lower().split() for x in table["text"].to_pylist())
        # Every text lies behind `order` ends.
        streams = [b"".join((END * order, b" ".join(w), b" " if w else b"", END)) for w in words]
        size = np.array([len(x) for x in streams], np.int64)
        self.order, self.size, self.flat = order, size - order, np.frombuffer(b"".join(streams), np.uint8)
        self.told = np.ones(len(self.flat), bool)
        self.told[((np.cumsum(size) - size)[:, None] + np.arange(order)).ravel()] = False
        spelt = self.flat[self.told]
        ends = np.flatnonzero((spelt == ord(" ")) | (spelt == ord(END))) + 1
        at = np.append(0, ends).astype(np.int32)
        self.begin = at[:-1]
        tokens = pa.Array.from_buffers(pa.binary(), len(ends), [None, pa.py_buffer(at), pa.py_buffer(spelt)]).dictionary_encode()
        index = tokens.indices.to_numpy().astype(np.int64)
        # The texts' last tokens, the ends, are all the same; the others are words.
        self.last = np.flatnonzero(spelt[ends - 1] == ord(END))
        self.tokens, self.end, self.index = tokens.dictionary, index[self.last[0]], np.delete(index, self.last)
        self.counts = np.diff(self.last, prepend=-1) - 1
        self.owner = np.repeat(np.arange(len(self.ids)), self.counts)

    def token_times(self) -> np.ndarray:
        """How often each distinct token occurs in texts that are not held out."""
        times = np.bincount(self.index[~self.held[self.owner]], minlength=len(self.tokens))
        times[self.end] = (~self.held).sum()
        return times

    def token_parts(self, shards: int) -> list[tuple[int, np.ndarray]]:
        return _by_shard((_hashed(self.tokens) % np.uint64(shards)).astype(np.int64))

    def _pairs(self) -> np.ndarray:
        """Each byte with the `order` bytes before it, as a number: a leading 1, the context's bytes, the byte."""
        # The eight bytes up to each one, read as a number where they lie; the first lie behind seven more.
        pair = np.ndarray(len(self.flat), ">u8", bytes(7) + self.flat.tobytes(), strides=(1,)).astype(np.uint64)[self.told]
        top = 1 << 8 * (self.order + 1)
        pair &= np.uint64(top - 1)
        pair |= np.uint64(top)
        return pair

    def pairs(self) -> tuple[np.ndarray, np.ndarray]:
        """Distinct pairs, ascending, and how often each occurs in texts that are not held out."""
        # A pair takes 57 bits at most, so there is room for a mark of texts held out.
        pair = self._pairs()
        pair <<= np.uint64(1)
        pair |= np.repeat(self.held, self.size)
        pair.sort()
        learnt = ~(pair.astype(np.uint8) & 1).view(bool)
        pair >>= np.uint64(1)
        first = _firsts(pair)
        return pair[first], np.add.reduceat(learnt, first, dtype=np.int64)

    def pair_places(self) -> tuple[np.ndarray, np.ndarray]:
        """Distinct pairs, ascending, and each byte's place among them."""
        there = np.bincount(self.flat, minlength=SYMBOLS) > 0
        kinds, n = int(there.sum()), int(self.size.sum())
        bits = n.bit_length()
        if kinds ** (self.order + 1) >= 1 << 64 - bits:
            pair = self._pairs()
            distinct = np.sort(pair)
            distinct = distinct[_firsts(distinct)]
            return distinct, pc.index_in(pa.array(pair), value_set=pa.array(distinct)).to_numpy()
        # Numbers of the bytes that occur leave room for a pair's place, so that one sort of numbers finds both.
        rank = (np.cumsum(there) - 1).astype(np.uint8)[self.flat]
        code = np.zeros(len(rank), np.uint64)
        for t in range(self.order, -1, -1):
            code *= np.uint64(kinds)
            code[t:] += rank[:len(rank) - t]
        code = code[self.told]
        code <<= np.uint64(bits)
        code |= np.arange(n, dtype=np.uint64)
        code.sort()
        place = (code & np.uint64((1 << bits) - 1)).astype(np.int64)
        code >>= np.uint64(bits)
        first = _firsts(code)
        index = np.empty(n, np.int32)
        index[place] = np.repeat(np.arange(len(first), dtype=np.int32), np.diff(np.append(first, n)))
        at = np.flatnonzero(self.told)[place[first]]
        distinct = np.full(len(first), 1 << 8 * (self.order + 1), np.uint64)
        for t in range(self.order + 1):
            distinct |= self.flat[at - t].astype(np.uint64) << np.uint64(8 * t)
        return distinct, index


def _pair_parts(pairs: np.ndarray, shards: int) -> list[tuple[int, np.ndarray]]:
    # All bytes of a context lie in one shard.
    return _by_shard((_mixed(pairs >> np.uint64(8)) % np.uint64(shards)).astype(np.int64))


def _firsts(x: np.ndarray) -> np.ndarray:
    """Where the runs of equal numbers begin."""
    return np.flatnonzero(np.append(True, x[1:] != x[:-1])[:len(x)])


def _hashed(words: pa.Array) -> np.ndarray:
    """Words, none of them empty, as numbers spread over all 64 bits: a polynomial of their bytes."""
    at = np.frombuffer(words.buffers()[1], np.int32)[words.offset:words.offset + len(words) + 1]
    spelt = np.frombuffer(words.buffers()[2], np.uint8)[at[0]:at[-1]].astype(np.uint64)
    size = np.diff(at)
    start = at[:-1] - at[0]
    powers = np.cumprod(np.full(size.max(), 0x9E3779B97F4A7C15, np.uint64))
    return _mixed(np.add.reduceat((spelt + np.uint64(1)) * powers[np.arange(len(spelt)) - np.repeat(start, size)], start))


def _by_shard(shard: np.ndarray) -> list[tuple[int, np.ndarray]]:
    """Places of a block's entries in each shard, in their order."""
    order = np.argsort(shard, kind="stable")
    return [(int(shard[p[0]]), p) for p in np.split(order, np.flatnonzero(np.diff(shard[order])) + 1)]


def _mixed(x: np.ndarray) -> np.ndarray:
    """Numbers spread over all 64 bits."""
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    return x ^ (x >> np.uint64(31))


def chances(pairs: DataFrame, order: int = ORDER) -> DataFrame:
    """log10 chance of each (ctx, sym) marked `new`, from the counts `n` of training, which may be 0: (ctx, sym, lp)."""
    top = F.lit(1).cast("long")

    def shorter(ctx: Column, k: Column) -> Column:
        bits = (8 * k).cast("int")
        return F.call_function("shiftleft", top, bits).bitwiseOR(ctx.bitwiseAND(F.call_function("shiftleft", top, bits) - 1))

    depth = F.lit(0)
    for k in range(1, order + 1):
        depth = F.when(F.col("ctx") >= (1 << (8 * k)), k).otherwise(depth)
    levels = pairs.select("ctx", "sym", "n", "new", F.explode(F.sequence(F.lit(0), depth)).alias("k")).withColumn("c", shorter(F.col("ctx"), F.col("k")))
    entries = stored(levels.where("n > 0").groupBy("c", "k", "sym").agg(F.sum("n").alias("n")))
    nodes = entries.groupBy("c", "k").agg(F.sum("n").alias("total"), F.count(F.lit(1)).alias("kinds"))
    # What the bytes seen in a context count in the next shorter one: left out there after an escape.
    up = entries.where("k > 0").select(F.col("c").alias("child"), shorter(F.col("c"), F.col("k") - 1).alias("c"), "sym")
    above = up.join(entries.select("c", "sym", "n"), ["c", "sym"]).groupBy(F.col("child").alias("c")).agg(F.sum("n").alias("above"))
    nodes = stored(nodes.join(above, "c", "left").select("c", "total", "kinds", F.coalesce("above", F.lit(0)).alias("above")))
    asked = levels.where("new").join(entries.select("c", "sym", F.col("n").alias("seen")), ["c", "sym"], "left").join(nodes, "c")
    step = F.struct((-F.col("k")).alias("k"), "seen", "total", "kinds", "above")
    chain = asked.groupBy("ctx", "sym").agg(F.array_sort(F.collect_list(step)).alias("chain"))  # at most ORDER + 1 steps

    def down(acc: Column, x: Column) -> Column:
        total, kinds = x["total"] - acc["out"], x["kinds"] - acc["kinds"]
        hit = F.struct((acc["lp"] + F.log10((x["seen"] - 0.5) / total)).alias("lp"), acc["out"].alias("out"), acc["kinds"].alias("kinds"), F.lit(True).alias("done"))
        escape = F.when(total > 0, F.log10(0.5 * kinds / total)).otherwise(0.0)
        miss = F.struct((acc["lp"] + escape).alias("lp"), x["above"].alias("out"), x["kinds"].alias("kinds"), F.lit(False).alias("done"))
        return F.when(acc["done"], acc).when(x["seen"].isNotNull(), hit).otherwise(miss)

    start = F.struct(F.lit(0.0).alias("lp"), F.lit(0).cast("long").alias("out"), F.lit(0).cast("long").alias("kinds"), F.lit(False).alias("done"))
    rest = lambda acc: F.when(acc["done"], acc["lp"]).otherwise(acc["lp"] - F.log10(F.greatest(SYMBOLS - acc["kinds"], F.lit(1))))
    known = chain.select("ctx", "sym", F.aggregate("chain", start, down, rest).alias("lp"))
    # Without any training text there are no nodes: all bytes are as likely.
    return pairs.where("new").select("ctx", "sym").join(known, ["ctx", "sym"], "left").select("ctx", "sym", F.coalesce("lp", F.lit(-float(np.log10(SYMBOLS)))).alias("lp"))


def score(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", order: int = ORDER, folds: int = FOLDS) -> DataFrame:
    """Scores of every document by a model learnt from those not held out.

    Returns (doc_id, held_out, n_tokens, n_known, train_tokens, base_score, score): tokens are
    words `[^\\x20\\x09-\\x0D]+` with A to Z lowered and one end; known tokens occur in training
    texts; the base score is an add-0.1 unigram model's, the score this model's, both log10.
    The contexts of the score are `order` bytes long, at most 6.
    Null and empty texts are an end alone. A null id is held out; rows that share an id are
    scored each. An empty table gives an empty table; other columns are ignored.
    """
    size = docs.agg(F.sum(F.octet_length(F.col(text_col).cast("string"))).alias("n")).first()["n"] or 0
    shards = max(1, -(-size // SHARD_BYTES))
    blocks = to_blocks(docs, id_col, text_col)

    # Shards of words are numbered from 0, those of pairs behind them.
    def ask(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for block, body in zip(batch["block"].to_pylist(), batch["body"]):
                own = _Texts(unpack(body.as_py()), order, folds)
                times = own.token_times()
                rows = [(shard, block, pack(pa.table({"word": own.tokens.take(pa.array(part)), "n": times[part]}))) for shard, part in own.token_parts(shards)]
                pair, times = own.pairs()
                rows += [(shards + shard, block, pack(pa.table({"step": np.diff(pair[part], prepend=np.uint64(0)), "n": times[part]})))
                         for shard, part in _pair_parts(pair, shards)]
                yield from _rows(rows).to_batches()

    def count(table: pa.Table) -> pa.Table:
        """Counts of the words each block asked about, in its order. Block -1 has the shard's numbers of training words and tokens."""
        times, places = _merged([unpack(b) for b in table["body"].to_pylist()], "word")[1:]
        rows = [(table["shard"][0].as_py(), -1, pack(pa.table({"n": np.array([(times > 0).sum(), times.sum()], np.int64)})))]
        for shard, block, place in zip(table["shard"].to_pylist(), table["block"].to_pylist(), places):
            rows.append((shard, block, pack(pa.table({"n": times[place]}))))
        return _rows(rows)

    def pairs(table: pa.Table) -> pa.Table:
        """Distinct pairs of a shard: how often in training texts, and whether only in others."""
        keys, n, _ = _merged([_asked(b) for b in table["body"].to_pylist()], "pair")
        keys = keys.to_numpy()
        return pa.table({"shard": pa.array(np.full(len(keys), table["shard"][0].as_py()), pa.int32()), "ctx": (keys >> np.uint64(8)).astype(np.int64),
                         "sym": (keys & np.uint64(255)).astype(np.int32), "n": n, "new": n == 0})

    def answer(left: pa.Table, right: pa.Table) -> pa.Table:
        """What tells the chances of the pairs each block asked about, in its order."""
        if not left.num_rows:
            return _rows([])
        keys, n, places = _merged([_asked(b) for b in left["body"].to_pylist()], "pair")
        pair = keys.to_numpy()
        _, ctx = np.unique(pair >> np.uint64(8), return_inverse=True)
        total = np.bincount(ctx, weights=n)[ctx].astype(np.int64)
        scores = np.zeros(len(pair))
        known = right["ctx"].to_numpy().astype(np.uint64) << np.uint64(8) | right["sym"].to_numpy().astype(np.uint64)
        fresh, by = np.flatnonzero(n == 0), np.argsort(known)
        scores[fresh] = right["lp"].to_numpy()[by][np.searchsorted(known[by], pair[fresh])]
        return _rows([(shard, block, pack(_counted(ctx[place], n[place], total[place], scores[place])))
                      for shard, block, place in zip(left["shard"].to_pylist(), left["block"].to_pylist(), places)])

    questions = stored(blocks.mapInArrow(ask, ROWS_SQL))
    counted = stored(questions.where(F.col("shard") < shards).groupBy("shard").applyInArrow(count, ROWS_SQL))
    sums = [unpack(r["body"])["n"].to_numpy() for r in counted.where("block = -1").collect()]  # one row a shard
    kinds, tokens = (int(x) for x in sum(sums, np.zeros(2, np.int64)))
    spelling = questions.where(F.col("shard") >= shards)
    spelled = stored(spelling.groupBy("shard").applyInArrow(pairs, PAIR_SQL))
    known = chances(spelled.select("ctx", "sym", "n", "new"), order)
    told = spelled.where("new").select("shard", "ctx", "sym").join(known, ["ctx", "sym"])
    answers = counted.where("block >= 0").unionByName(spelling.groupBy("shard").cogroup(told.groupBy("shard")).applyInArrow(answer, ROWS_SQL))

    def add_up(left: pa.Table, right: pa.Table) -> pa.Table:
        out = []
        replies = dict(zip(right["shard"].to_pylist(), right["body"].to_pylist()))
        for body in left["body"].to_pylist():
            own = _Texts(unpack(body), order, folds)
            pair, at = own.pair_places()
            n, lp = np.zeros(len(own.tokens), np.int64), np.zeros(len(pair))
            for shard, part in own.token_parts(shards):
                n[part] = unpack(replies[shard])["n"].to_numpy()
            for shard, part in _pair_parts(pair, shards):
                lp[part] = _told(unpack(replies[shards + shard]))
            base = np.log10((n + 0.1) / (tokens + 0.1 * (kinds + 1)))
            size, ends = len(own.ids), own.last
            total = lambda x: np.bincount(own.owner, weights=x[own.index], minlength=size) + x[own.end]  # noqa: E731, B023
            scores = np.add.reduceat(lp[at], own.begin)
            words = np.delete(scores, ends)
            before, place = _so_far(own.owner, own.index, own.counts)
            # Of a word's first place only the logarithm is needed, however small its chance.
            again = np.flatnonzero(before)
            times, chance = before[again], 10 ** words[again]
            longest = np.arange(own.counts.max())
            each = []
            for m in ESCAPES:
                told = np.log10(m) + words
                told[again] = np.log10(times + m * chance)
                told -= np.log10(longest + m)[place]
                each.append(np.bincount(own.owner, weights=told, minlength=size) + np.log10(m / (own.counts + m)) + scores[ends])
            each = np.stack(each)
            best = each.max(axis=0)
            blended = best + np.log10((10 ** (each - best)).mean(axis=0))
            out.append(pa.table({
                "doc_id": pa.array(own.ids, pa.int64()), "held_out": own.held, "n_tokens": own.counts + 1,
                "n_known": total((n > 0).astype(float)).astype(np.int64), "train_tokens": np.full(size, tokens, np.int64),
                "base_score": total(base), "score": blended}))
        return pa.concat_tables(out)

    return blocks.groupBy("block").cogroup(answers.groupBy("block")).applyInArrow(
        add_up, "doc_id long, held_out boolean, n_tokens long, n_known long, train_tokens long, base_score double, score double")


def _so_far(owner: np.ndarray, index: np.ndarray, counts: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """For each word of a block: how often its document had it before, and how many words the document had before."""
    place = np.arange(len(owner)) - np.repeat(np.cumsum(counts) - counts, counts)
    # By word, then by place in the block; a document's words lie together there.
    order = (np.sort(index << 32 | np.arange(len(index))) & 0xFFFFFFFF).astype(np.int64)
    first = np.ones(len(order), bool)
    first[1:] = (owner[order][1:] != owner[order][:-1]) | (index[order][1:] != index[order][:-1])
    run = np.arange(len(order))
    before = np.empty(len(order), np.int64)
    before[order] = run - np.maximum.accumulate(np.where(first, run, 0))
    return before, place


def _rows(rows: list[tuple[int, int, bytes]]) -> pa.Table:
    return pa.table({"shard": pa.array([r[0] for r in rows], pa.int32()), "block": pa.array([r[1] for r in rows], pa.int64()),
                     "body": pa.array([r[2] for r in rows], pa.binary())})


def _counted(ctx: np.ndarray, n: np.ndarray, total: np.ndarray, score: np.ndarray) -> pa.Table:
    """Counts of ascending pairs and their contexts' totals, more by 1 and at a context's first pair only. The score is read where the count is 0."""
    first = np.append(True, ctx[1:] != ctx[:-1])[:len(ctx)]
    return pa.table({"n": n, "total": np.where(first, total + 1, 0), "score": score})


def _told(table: pa.Table) -> np.ndarray:
    """log10 chances of the pairs of `_counted`."""
    n, total = table["n"].to_numpy(), table["total"].to_numpy()
    total = total[np.maximum.accumulate(np.where(total > 0, np.arange(len(total)), 0))] - 1
    return np.where(n > 0, np.log10(np.maximum(n - 0.5, 0.5) / np.maximum(total, 1)), table["score"].to_numpy())


def _asked(body: bytes) -> pa.Table:
    """Pairs and their counts in a packed question, where pairs are ascending and told by their steps."""
    table = unpack(body)
    return pa.table({"pair": np.cumsum(table["step"].to_numpy(), dtype=np.uint64), "n": table["n"]})


def _merged(tables: list[pa.Table], key: str) -> tuple[pa.Array, np.ndarray, list[np.ndarray]]:
    """Distinct keys of tables (key, n), the sums of n, and the places of each table's keys among them."""
    whole = pa.concat_tables(tables)
    coded = whole[key].combine_chunks().dictionary_encode()
    at = coded.indices.to_numpy()
    times = np.bincount(at, weights=whole["n"].to_numpy(), minlength=len(coded.dictionary))
    return coded.dictionary, times.astype(np.int64), np.split(at, np.cumsum([t.num_rows for t in tables])[:-1])
