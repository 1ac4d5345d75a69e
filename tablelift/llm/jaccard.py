"""Join of texts by the Jaccard similarity of their five-word shingles: a token-group matrix.

1. *Profile.* Each text becomes a set of 64-bit shingle hashes; of the set only its size, a 128-bit identity, four
   minima under different permutations and a parity sketch are kept. Equal sets are one class from here on.
2. *Groups.* Classes that share a minimum are compared with the least class among them, and then, in an order that
   has nothing to do with their ids, with the next class of another group; those that link make groups
   of similar documents whose members are known to be connected.
3. *Token-group matrix.* Tokens are ordered rarest first, by document frequencies counted over all tokens. Two sets
   of similarity s share a token within their first |x| - ceil(s|x|) + 1 tokens, so these tokens alone are laid out as
   (token, group, class), sorted by token, larger groups first. At each token a class meets the members of larger groups if the
   token's places in both sets leave room for the overlap that their sizes ask for; of those that parity sketches allow it keeps, for
   each block of a group, the one whose sketch is nearest.
4. *One link for two groups.* For each pair of groups the nearest of these pairs is verified first. Where it links, the groups
   are one, and all their other candidates go.
5. *Bound and open.* What is left meets the members of the block whose sizes and sketches allow a link; then the block's token
   union is built, and the block is opened only if the union holds enough of the query's tokens. In an open block the first link
   found ends the search, for its members are connected already.
6. *Components* of all links.

Every bound is safe: no link between different texts is lost, and nothing is capped. Shingle hashes have 64 bits; a
collision could change a similarity by one token at most. Frequent tokens come from a list of at most ``HOT_TOKENS``,
broadcast for ordering; which tokens are in it changes the work, never a link.

Null texts count as empty; texts without words have no shingle and link with nothing. Rows with a null id are
returned with a null component and link with nothing. Repeated rows are returned repeatedly; rows with one id are one
document. Other columns are ignored; an empty table gives an empty result.
"""

from __future__ import annotations

import math

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tablelift.llm.common import release_memory, share_code, shuffle_tasks, stored, tidy
from tablelift.llm.components import components
from tablelift.llm.words import gather, lower, mix, slices, span_hashes, spans, windows

#: Words in a shingle, and the least similarity in hundredths.
WIDTH, PERCENT = 5, 75
#: Frequent tokens that are broadcast at most, and the frequency below which a token is not frequent.
HOT_TOKENS, HOT_FREQUENCY = 1 << 20, 12
#: Classes in a block of a group, and followers compared with one leader in one place.
BLOCK = 128
#: Tokens a task sorts at once while it counts frequencies.
SORTED_TOKENS = 2 << 20

#: Bits of the sieve that spares texts a shuffle.
SIEVE_BITS = 1 << 24

_SEEDS = mix(np.arange(101, 105, dtype=np.uint64))
_MOST_SKETCH = 1 << 16
#: Bytes of the sketches that travel with matrix rows, and pairs compared at once.
_SHORT, _PAIRS = 128, 1 << 17


def token_sets(data: np.ndarray, at: np.ndarray):
    """For each text of a slice, its sorted distinct shingle hashes; also all windows and where each text's begin."""
    data = lower(data)
    start, end, first = spans(data, at)
    words = span_hashes(data, start, end)
    grams = windows(words, WIDTH)
    sets, bounds = [], []
    for a, b in zip(first[:-1].tolist(), first[1:].tolist()):
        if b - a >= WIDTH:
            own = grams[a : b - WIDTH + 1]
        else:
            own = windows(words[a:b], b - a) if b > a else words[:0]
        sets.append(np.unique(own))
        bounds.append(own)
    return sets, bounds


def _sketch(tokens: np.ndarray) -> bytes:
    """Parity of the number of tokens in each of m slots; m grows with the set."""
    m = min(_MOST_SKETCH, max(64, 1 << (len(tokens) - 1).bit_length()))
    slots = (tokens & np.uint64(m - 1)).astype(np.int64)
    return np.packbits((np.bincount(slots, minlength=m) & 1).astype(np.uint8)).tobytes()


def may_link(n: int, sketch: bytes, m: int, other: bytes) -> bool:
    """False only if two sets of these sizes and sketches cannot be similar enough.

    Similarity p/100 leaves at most (100 - p) / (100 + p) of both sizes' sum outside the intersection, and every
    slot of different parity holds at least one token of only one set.
    """
    if 100 * min(n, m) < PERCENT * max(n, m):
        return False
    a, b = np.frombuffer(sketch, np.uint8), np.frombuffer(other, np.uint8)
    if len(a) > len(b):
        a = np.bitwise_xor.reduce(a.reshape(-1, len(b)), axis=0)
    elif len(b) > len(a):
        b = np.bitwise_xor.reduce(b.reshape(-1, len(a)), axis=0)
    apart = int(np.bitwise_count(a ^ b).sum())
    return (100 + PERCENT) * apart <= (100 - PERCENT) * (n + m)


def linked(x: np.ndarray, y: np.ndarray) -> bool:
    """Whether two sorted sets reach the similarity."""
    if 100 * min(len(x), len(y)) < PERCENT * max(len(x), len(y)):
        return False
    both = _common(x, y)
    return 100 * both >= PERCENT * (len(x) + len(y) - both)


def _common(x: np.ndarray, y: np.ndarray) -> int:
    if len(x) > len(y):
        x, y = y, x
    at = np.searchsorted(y, x)
    at[at == len(y)] = 0
    return int((y[at] == x).sum()) if len(y) else 0


def _signed(x: int) -> int:
    return x - (1 << 64) if x >> 63 else x


def _identity(tokens: np.ndarray) -> tuple[int, int]:
    h = xxhash.xxh3_128_intdigest(tokens.tobytes())
    return _signed(h >> 64), _signed(h & ((1 << 64) - 1))


_PROFILE = "doc_id long, n long, fa long, fb long, minima array<long>, sketch binary, short binary"


def _profile(batches):
    for batch in batches:
        for part, data, at in slices(batch, "text"):
            n, fa, fb, minima, sketch, short = [], [], [], [], [], []
            for tokens in token_sets(data, at)[0]:
                n.append(len(tokens))
                a, b = _identity(tokens)
                fa.append(a)
                fb.append(b)
                if len(tokens):
                    minima.append([int(mix(tokens ^ s).min().view(np.int64)) for s in _SEEDS])
                    sketch.append(_sketch(tokens))
                    short.append(_folded(np.frombuffer(sketch[-1], np.uint8)[None], min(len(sketch[-1]), _SHORT)).tobytes())
                else:
                    minima.append([])
                    sketch.append(b"")
                    short.append(b"")
            yield pa.RecordBatch.from_arrays(
                [part.column(0), *(pa.array(x, pa.int64()) for x in (n, fa, fb)), pa.array(minima, pa.list_(pa.int64())), pa.array(sketch, pa.binary()), pa.array(short, pa.binary())],
                names=["doc_id", "n", "fa", "fb", "minima", "sketch", "short"],
            )


def _near(batches):
    """Keep candidate pairs that sizes and sketches allow."""
    for batch in batches:
        columns = [batch.column(k).to_pylist() for k in ("n", "sketch", "m", "other")]
        keep = pa.array([may_link(*x) for x in zip(*columns)], pa.bool_())
        yield batch.filter(keep).select(["q", "x", "block"])


def _folded(sketches: np.ndarray, width: int) -> np.ndarray:
    """Rows of sketches with slots folded onto the first ``width`` bytes."""
    return np.bitwise_xor.reduce(sketches.reshape(len(sketches), -1, width), axis=1)


def _near_blocks(batches):
    """Queries (role 1) with the members (role 0) of their block that :func:`may_link` allows; rows come sorted."""
    block, members = None, {}  # members by length of sketch: ids, sizes, sketches; arrays once a query comes
    ready = False
    for batch in batches:
        q, x, blocks = [], [], []
        for key, role, cls, n, sketch in zip(*(batch.column(k).to_pylist() for k in ("block", "role", "cls", "n", "sketch"))):
            if key != block:
                block, members, ready = key, {}, False
            if role == 0:
                for held, value in zip(members.setdefault(len(sketch), ([], [], [])), (cls, n, sketch)):
                    held.append(value)
                continue
            if not ready:
                members = {k: (np.array(i), np.array(m), np.frombuffer(b"".join(s), np.uint8).reshape(-1, k)) for k, (i, m, s) in members.items()}
                ready = True
            own = np.frombuffer(sketch, np.uint8)[None]
            for width, (ids, sizes, sketches) in members.items():
                least = min(width, own.shape[1])
                apart = np.bitwise_count(_folded(sketches, least) ^ _folded(own, least)).sum(axis=1, dtype=np.int64)
                good = (100 * np.minimum(n, sizes) >= PERCENT * np.maximum(n, sizes)) & ((100 + PERCENT) * apart <= (100 - PERCENT) * (n + sizes))
                found = ids[good].tolist()
                q += [cls] * len(found)
                x += found
                blocks += [key] * len(found)
        if q:
            yield pa.RecordBatch.from_arrays([pa.array(q, pa.int64()), pa.array(x, pa.int64()), pa.array(blocks, pa.string())], names=["q", "x", "block"])


def _verified(batches):
    """Links of queries (role 1) with the members (role 0) of their block; rows come sorted by block and role."""
    block, members, union = None, [], None
    for batch in batches:
        for part, data, at in slices(batch, "text"):
            found = []
            sets = token_sets(data, at)[0]
            for key, role, cls, tokens in zip(part.column("block").to_pylist(), part.column("role").to_pylist(), part.column("cls").to_pylist(), sets):
                if key != block:
                    block, members, union = key, [], None
                if role == 0:
                    members.append((cls, tokens))
                    continue
                if union is None:
                    union = np.unique(np.concatenate([t for _, t in members])) if len(members) > 1 else members[0][1] if members else tokens[:0]
                if 100 * _common(tokens, union) < PERCENT * len(tokens):
                    continue
                for other, held in members:
                    if linked(tokens, held):
                        found.append((cls, other))
                        break
            if found:
                yield pa.RecordBatch.from_arrays([pa.array([x[i] for x in found], pa.int64()) for i in (0, 1)], names=["a", "b"])


def _sifted(docs: DataFrame, wanted: DataFrame) -> DataFrame:
    """Rows of ``docs`` less most of those whose id is not wanted, before any text is moved.

    A bit for each wanted id, in at most ``SIEVE_BITS`` bits: words of 32 bits, so the broadcast table has at most a
    32nd of that many rows. What slips through is dropped by the join that follows.
    """
    bits = min(SIEVE_BITS, max(1 << 10, 16 << wanted.count().bit_length()))
    at = lambda c: F.pmod(F.xxhash64(c), F.lit(bits))
    place = at(F.col("cls"))
    one = lambda place: F.call_function("shiftleft", F.lit(1).cast("long"), F.pmod(place, F.lit(32)).cast("int"))
    words = wanted.groupBy(F.floor(place / 32).alias("_word")).agg(F.bit_or(one(place)).alias("_bits"))
    place = at(F.col("doc_id"))
    kept = docs.withColumn("_word", F.floor(place / 32)).join(F.broadcast(words), "_word")
    return kept.where(F.col("_bits").bitwiseAND(one(place)) != 0).select("doc_id", "text")


def _verify(docs: DataFrame, pairs: DataFrame) -> DataFrame:
    """Links (a, b) among candidate pairs (q, x, block); x's of one block are in one group."""
    rows = pairs.select("block", F.lit(1).alias("role"), F.col("q").alias("cls")).union(
        pairs.select("block", F.lit(0).alias("role"), F.col("x").alias("cls"))
    ).distinct()
    rows = stored(rows)
    texts = _sifted(docs, rows).join(rows, F.col("doc_id") == rows["cls"]).select("block", "role", "cls", "text")
    placed = texts.repartition(shuffle_tasks(docs.sparkSession), "block").sortWithinPartitions("block", "role", "cls")
    return stored(placed.mapInArrow(tidy(_verified), "a long, b long"))


def _salted(owner, member, size):
    """Block of a member among the ``ceil(size / BLOCK)`` blocks of its owner."""
    salt = F.pmod(F.xxhash64(member), F.greatest(F.lit(1), F.ceil(size / BLOCK)))
    return F.concat_ws("/", owner.cast("string"), salt.cast("string"))


def _stars(docs: DataFrame, classes: DataFrame) -> DataFrame:
    """Links of classes with the least class that shares one of their minima."""
    shared = classes.select("cls", "n", "sketch", F.posexplode("minima").alias("r", "minimum"))
    leaders = (
        shared.groupBy("r", "minimum")
        .agg(F.min("cls").alias("x"), F.count(F.lit(1)).alias("size"), F.min(F.struct("cls", "n", "sketch")).alias("least"))
        .where("size > 1")
    )
    pairs = (
        shared.join(leaders, ["r", "minimum"]).where("cls <> x")
        .select(F.col("cls").alias("q"), "n", "sketch", "x", F.col("least.n").alias("m"), F.col("least.sketch").alias("other"), _salted(F.col("x"), F.col("cls"), F.col("size")).alias("block"))
    )
    near = pairs.mapInArrow(tidy(_near), "q long, x long, block string")
    once = near.groupBy("q", "x").agg(F.min("block").alias("block"))
    return _verify(docs, stored(once))


def _chains(docs: DataFrame, grouped: DataFrame) -> DataFrame:
    """Links of classes with the next class of another group that shares one of their minima, in the order of a hash.

    Stars miss copies that are similar to each other but not to the least of them. A minimum that many classes share is
    dealt into salts, and each salt is a chain of its own.
    """
    shared = grouped.select("cls", "group", F.posexplode("minima").alias("r", "minimum"))
    mixed = shared.groupBy("r", "minimum").agg(F.count(F.lit(1)).alias("size"), F.min("group").alias("least"), F.max("group").alias("most")).where("least < most")
    order = F.xxhash64("cls", F.lit(1))
    salted = shared.join(mixed.drop("least", "most"), ["r", "minimum"]).withColumn("salt", F.pmod(order, F.greatest(F.lit(1), F.ceil(F.col("size") / BLOCK))))
    chain = Window.partitionBy("r", "minimum", "salt").orderBy(F.xxhash64("cls", F.lit(2)), "cls")
    met = salted.withColumn("next", F.lead(F.struct("cls", "group")).over(chain)).where("next.group <> group")
    pairs = stored(met.select(F.col("cls").alias("q"), F.col("next.cls").alias("x")).distinct())
    own = grouped.select(F.col("cls").alias("q"), "n", "sketch")
    other = grouped.select(F.col("cls").alias("x"), F.col("n").alias("m"), F.col("sketch").alias("other"))
    near = pairs.join(own, "q").join(other, "x").withColumn("block", F.col("x").cast("string"))
    return _verify(docs, stored(near.mapInArrow(tidy(_near), "q long, x long, block string")))


def _seen_once(batches, sets=100_000):
    """(identity, tokens) of each class of the task, as a rule once."""
    seen: set[tuple[int, int]] = set()
    for batch in batches:
        for _, data, at in slices(batch, "text"):
            for tokens in token_sets(data, at)[0]:
                if len(tokens):
                    key = _identity(tokens)
                    if key not in seen:
                        if len(seen) > sets:
                            seen.clear()
                        seen.add(key)
                        yield key[0], tokens


def frequent_tokens(docs: DataFrame, total: int, most: int = HOT_TOKENS) -> tuple[np.ndarray, np.ndarray, int]:
    """(leading bits of frequent tokens, their frequency class, number of bits), counted over all tokens.

    Tokens travel as sorted blocks of their leading bits, a block for each key range and chunk, not as rows.
    """
    bits = max(32, math.ceil(math.log2(total + 1)) + 5)
    part_bits = max(8, math.ceil(math.log2(total / (1 << 21) + 1)))
    low = bits - part_bits
    width = (low + 7) // 8

    def blocks(batches):
        held, count = [], 0

        def out():
            tokens = np.sort(np.concatenate(held) >> np.uint64(64 - bits))
            cuts = np.searchsorted(tokens, np.arange((1 << part_bits) + 1, dtype=np.uint64) << np.uint64(low))
            raw = tokens.astype("<u8").view(np.uint8).reshape(-1, 8)[:, :width]
            full = np.flatnonzero(np.diff(cuts))
            return pa.RecordBatch.from_arrays(
                [pa.array(full.astype(np.int32)), pa.array([_masked(raw[cuts[p] : cuts[p + 1]], low) for p in full], pa.binary())], names=["part", "tokens"]
            )

        for _, tokens in _seen_once(batches):
            held.append(tokens)
            count += len(tokens)
            if count >= SORTED_TOKENS:
                yield out()
                held, count = [], 0
        if held:
            yield out()

    def counted(batches):
        part, held = None, []

        def out():
            raw = np.frombuffer(b"".join(held), np.uint8).reshape(-1, width)
            wide = np.zeros((len(raw), 8), np.uint8)
            wide[:, :width] = raw
            tokens = np.sort(wide.view("<u8").ravel())
            begin = np.flatnonzero(np.concatenate([[True], tokens[1:] != tokens[:-1]]))
            n = np.diff(np.append(begin, len(tokens)))
            hot = n >= HOT_FREQUENCY
            values = tokens[begin[hot]] + (np.uint64(part) << np.uint64(low))
            return pa.RecordBatch.from_arrays([pa.array(values.astype(np.int64)), pa.array(n[hot].astype(np.int64))], names=["token", "n"])

        for batch in batches:
            for p, tokens in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                if p != part:
                    if held:
                        yield out()
                    part, held = p, []
                held.append(tokens)
        if held:
            yield out()

    spread = docs.mapInArrow(tidy(blocks), "part int, tokens binary").repartition(shuffle_tasks(docs.sparkSession), "part").sortWithinPartitions("part")
    hot = stored(spread.mapInArrow(tidy(counted), "token long, n long").withColumn("level", F.floor(F.log2("n") * 2).cast("int")))
    levels = sorted((r["level"], r["count"]) for r in hot.groupBy("level").count().collect())
    least, kept = 0, 0
    for level, count in reversed(levels):
        kept += count
        if kept > most:
            least = level + 1
            break
    # At most ``most`` rows of two numbers reach the driver.
    rows = hot.where(F.col("level") >= least).select("token", "level").toArrow()
    tokens, level = rows["token"].to_numpy().astype(np.uint64), rows["level"].to_numpy().astype(np.int16)
    order = np.argsort(tokens)
    return tokens[order], level[order], bits


def _masked(raw: np.ndarray, low: int) -> bytes:
    """Bytes of tokens without the bits above ``low``."""
    if low % 8:
        raw = raw.copy()
        raw[:, -1] &= (1 << (low % 8)) - 1
    return raw.tobytes()


_ROW = ["token", "fa", "place", "before"]
_ROWS = "token long, fa long, place int, before long"


def _matrix(docs: DataFrame, hot: tuple[np.ndarray, np.ndarray, int]) -> DataFrame:
    """(token, fa, place, before): the leading tokens of each class, by rarity, where two classes share them.

    ``before`` is the token at the place before, 0 at the first.
    """
    spark = docs.sparkSession
    shared = spark.sparkContext.broadcast(hot)

    def prefixes(batches):
        frequent, level, bits = shared.value
        filter_bits = np.zeros(1 << 22, bool)
        filter_bits[(frequent & np.uint64((1 << 22) - 1)).astype(np.int64)] = True
        tokens_out, class_out, size = [], [], 0

        def out():
            tokens = np.concatenate(tokens_out).view(np.int64)
            lengths = [len(x) for x in tokens_out]
            owners = np.repeat(np.array(class_out, np.int64), lengths)
            places = np.concatenate([np.arange(k, dtype=np.int32) for k in lengths])
            before = np.append(0, tokens[:-1])
            before[places == 0] = 0
            return pa.RecordBatch.from_arrays([pa.array(tokens), pa.array(owners), pa.array(places), pa.array(before)], names=_ROW)

        for fa, tokens in _seen_once(batches):
            n = len(tokens)
            need = n - (PERCENT * n + 99) // 100 + 1
            lead = tokens >> np.uint64(64 - bits)
            maybe = np.flatnonzero(filter_bits[(lead & np.uint64((1 << 22) - 1)).astype(np.int64)])
            if len(maybe):
                ranks = np.zeros(n, np.int16)
                at = np.searchsorted(frequent, lead[maybe])
                at[at == len(frequent)] = 0
                same = frequent[at] == lead[maybe]
                ranks[maybe[same]] = level[at[same]]
                tokens = tokens[np.argsort(ranks, kind="stable")]
            tokens_out.append(tokens[:need])
            class_out.append(fa)
            size += need
            if size > 200_000:
                yield out()
                tokens_out, class_out, size = [], [], 0
        if tokens_out:
            yield out()

    def shared_only(batches):
        """Drop repeats, and tokens of one class only; the last row waits for the next batch."""
        last, last_kept = None, False
        for batch in batches:
            token, fa, place, before = (batch.column(i).to_numpy() for i in range(4))
            if not len(token):
                continue
            if last is not None:
                token, fa, place, before = (np.append(x, y) for x, y in zip(last, (token, fa, place, before)))
            new = np.ones(len(token), bool)
            new[1:] = (token[1:] != token[:-1]) | (fa[1:] != fa[:-1])
            token, fa, place, before = token[new], fa[new], place[new], before[new]
            same = token[1:] == token[:-1]
            keep = np.zeros(len(token), bool)
            keep[1:] |= same
            keep[:-1] |= same
            if last is not None and last_kept:
                keep[0] = False
            last, last_kept = (token[-1:], fa[-1:], place[-1:], before[-1:]), bool(keep[-1]) or (len(token) == 1 and last_kept)
            if keep.any():
                yield pa.RecordBatch.from_arrays([pa.array(x[keep]) for x in (token, fa, place, before)], names=_ROW)

    rows = docs.mapInArrow(tidy(prefixes), _ROWS)
    placed = rows.repartition(shuffle_tasks(spark), "token").sortWithinPartitions("token", "fa")
    return placed.mapInArrow(tidy(shared_only), _ROWS)


def _overlap(n, m):
    """Tokens that similar sets of these sizes (numbers or arrays) have in common at least."""
    return -(-PERCENT * (n + m) // (100 + PERCENT))


_ASKED = "q long, own long, group long, block string, x long, apart double"


class _Sketches:
    """Short sketches of rows, as one matrix for each length."""

    def __init__(self, short: list[bytes]):
        self.widths = np.fromiter(map(len, short), np.int64, len(short))
        self.place, self.tables = np.zeros(len(short), np.int64), {}
        for w in np.unique(self.widths).tolist():
            own = np.flatnonzero(self.widths == w)
            self.place[own] = np.arange(len(own))
            self.tables[w] = np.frombuffer(b"".join([short[k] for k in own.tolist()]), np.uint8).reshape(-1, w)

    def apart(self, i: np.ndarray, j: np.ndarray) -> np.ndarray:
        """Slots of different parity between rows i and j, folded to the shorter sketch."""
        out, both = np.zeros(len(i), np.int64), self.widths[i] << 32 | self.widths[j]
        for key in np.unique(both).tolist():
            at = np.flatnonzero(both == key)
            a, b = self.tables[key >> 32][self.place[i[at]]], self.tables[key & 0xFFFFFFFF][self.place[j[at]]]
            least = min(a.shape[1], b.shape[1])
            out[at] = np.bitwise_count(_folded(a, least) ^ _folded(b, least)).sum(axis=1, dtype=np.int64)
        return out


def _met(token, group, n, place, before, short):
    """Pairs (i, j, apart) of rows of one token, i in a larger group than j, that may be the first common token of similar sets.

    A token at place i of a set of n and place j of a set of m leaves at most min(n - i, m - j) tokens in common when it
    is their first common one, so for the rarest common token both must reach the overlap of these sizes. Where both
    sets have the same token before this one, it isn't their first: the pair comes out there. Rows come by token, larger
    groups first; members of one group don't meet.
    """
    index = np.arange(len(token))
    new_token = np.ones(len(token), bool)
    new_token[1:] = token[1:] != token[:-1]
    new_group = new_token.copy()
    new_group[1:] |= group[1:] != group[:-1]
    run, own = np.maximum.accumulate(np.where(new_token, index, 0)), np.maximum.accumulate(np.where(new_group, index, 0))
    partners = own - run
    asking = np.flatnonzero(partners)
    if not len(asking):
        return
    sketches = _Sketches(short)
    ends = np.cumsum(partners[asking])
    first = 0
    while first < len(asking):
        last = max(first + 1, int(np.searchsorted(ends, (ends[first - 1] if first else 0) + _PAIRS, side="right")))
        rows = asking[first:last]
        first = last
        j = np.repeat(rows, partners[rows])
        i = gather(run[rows], partners[rows])
        small, large = np.minimum(n[i], n[j]), np.maximum(n[i], n[j])
        total = n[i] + n[j]
        keep = (100 * small >= PERCENT * large) & (np.minimum(n[i] - place[i], n[j] - place[j]) >= _overlap(n[i], n[j])) & ((before[i] == 0) | (before[i] != before[j]))
        i, j, total = i[keep], j[keep], total[keep]
        if len(i):
            apart = sketches.apart(i, j)
            keep = (100 + PERCENT) * apart <= (100 - PERCENT) * total
            yield i[keep], j[keep], (apart / total)[keep]


def _queries(batches):
    """(class, its group, larger group, block, member, distance): for each block that a class may link with, its nearest member."""
    def asked(rows: pa.Table):
        token, group, cls, n, place, before, salt = (rows.column(k).to_numpy() for k in ("token", "group", "cls", "n", "place", "before", "salt"))
        for i, j, apart in _met(token, group, n.astype(np.int64), place.astype(np.int64), before, rows.column("short").to_pylist()):
            order = np.lexsort((cls[i], apart, salt[i], group[i], cls[j]))
            i, j, apart = i[order], j[order], apart[order]
            best = np.ones(len(i), bool)
            best[1:] = (cls[j][1:] != cls[j][:-1]) | (group[i][1:] != group[i][:-1]) | (salt[i][1:] != salt[i][:-1])
            i, j, apart = i[best], j[best], apart[best]
            if len(i):
                blocks = [f"{g}/{k}" for g, k in zip(group[i].tolist(), salt[i].tolist())]
                yield pa.RecordBatch.from_arrays(
                    [pa.array(cls[j]), pa.array(group[j]), pa.array(group[i]), pa.array(blocks, pa.string()), pa.array(cls[i]), pa.array(apart)],
                    names=["q", "own", "group", "block", "x", "apart"],
                )

    pending, last = [], None  # rows of a token that may go on in the next batch
    for batch in batches:
        tokens = batch.column("token").to_numpy()
        if not len(tokens):
            continue
        other = np.flatnonzero(tokens != tokens[-1])
        cut = int(other[-1]) + 1 if len(other) else 0
        if cut or tokens[-1] != last:
            yield from asked(pa.Table.from_batches([*pending, batch.slice(0, cut)]))
            pending, last = [], tokens[-1]
        pending.append(batch.slice(cut))
    if pending:
        yield from asked(pa.Table.from_batches(pending))


def _cross_links(docs: DataFrame, classes: DataFrame, hot: tuple) -> DataFrame:
    """Links between classes of different groups."""
    spark = docs.sparkSession
    salt = F.pmod(F.xxhash64("cls"), F.greatest(F.lit(1), F.ceil(F.col("group_size") / BLOCK))).alias("salt")
    handles = classes.select("fa", "cls", "n", "group", "group_size", salt, "short")
    rows = _matrix(docs, hot).join(handles, "fa").select("token", "group_size", "group", "cls", "n", "place", "before", "salt", "short")
    placed = rows.repartition(shuffle_tasks(spark), "token").sortWithinPartitions("token", F.desc("group_size"), "group", "cls")
    nearest = F.min(F.struct("apart", "x")).alias("best")
    asked = stored(placed.mapInArrow(tidy(_queries), _ASKED).groupBy("q", "own", "group", "block").agg(nearest).select("q", "own", "group", "block", "best.*"))

    # One pair for two groups, verified beside all that ask for the same member.
    first = asked.groupBy("own", "group").agg(F.min(F.struct("apart", "q", "x")).alias("p")).select("own", "group", "p.q", "p.x")
    first = stored(first.withColumn("block", F.concat_ws("/", F.col("x").cast("string"), F.pmod(F.xxhash64("q"), F.lit(16)).cast("string"))))
    links = _verify(docs, first.select("q", "x", "block"))
    found = first.join(links, (first["q"] == links["a"]) & (first["x"] == links["b"]), "left_semi")
    label = components(found.select(F.col("own").alias("a"), F.col("group").alias("b")))
    one, two = (label.select(F.col("node").alias(n), F.col("component").alias(f"{n}_label")) for n in ("own", "group"))
    rest = asked.join(one, "own", "left").join(two, "group", "left").where(F.coalesce("own_label", "own") != F.coalesce("group_label", "group"))
    rest = stored(rest.select("q", "block").distinct())

    queries = rest.join(classes.select(F.col("cls").alias("q"), "n", "sketch"), "q").select("block", F.lit(1).alias("role"), F.col("q").alias("cls"), "n", "sketch")
    block = _salted(F.col("group"), F.col("cls"), F.col("group_size")).alias("block")
    members = classes.select(block, F.lit(0).alias("role"), "cls", "n", "sketch").join(rest.select("block").distinct(), "block", "left_semi")
    placed = queries.unionByName(members).repartition(shuffle_tasks(spark), "block").sortWithinPartitions("block", "role", "cls")
    near = placed.mapInArrow(tidy(_near_blocks), "q long, x long, block string")
    return links.union(_verify(docs, stored(near)))


def _labelled(classes: DataFrame, labels: DataFrame, own: str) -> DataFrame:
    """Classes with the component of the node that column ``own`` names as their group, and the group's size."""
    columns = [c for c in classes.columns if c not in ("group", "group_size")]
    grouped = classes.join(labels, classes[own] == labels["node"], "left").select(*columns, F.coalesce("component", own).alias("group"))
    sizes = grouped.groupBy("group").agg(F.count(F.lit(1)).alias("group_size"))
    return stored(grouped.join(sizes, "group"))


def similar_groups(docs: DataFrame, id: str = "doc_id", text: str = "text") -> DataFrame:
    """doc_id, n_shingles and component_id of every row."""
    share_code(docs.sparkSession)
    docs = docs.select(F.col(id).cast("long").alias("doc_id"), F.col(text).cast("string").alias("text"))
    profile = stored(docs.mapInArrow(tidy(_profile), _PROFILE))
    named = profile.where("n > 0 AND doc_id IS NOT NULL")
    classes = stored(
        named.groupBy("n", "fa", "fb").agg(F.min("doc_id").alias("cls"), F.first("minima").alias("minima"), F.first("sketch").alias("sketch"), F.first("short").alias("short"))
    )
    grouped = _labelled(classes, components(_stars(docs, classes)), "cls")
    chains = _chains(docs, grouped)
    ends = [grouped.select(F.col("cls").alias(k), F.col("group").alias(f"g{k}")) for k in ("a", "b")]
    grouped = _labelled(grouped, components(chains.join(ends[0], "a").join(ends[1], "b").select(F.col("ga").alias("a"), F.col("gb").alias("b"))), "group")

    total = classes.agg(F.sum("n")).first()[0] or 0
    links = _cross_links(docs, grouped, frequent_tokens(docs, total))
    release_memory()
    group_of = grouped.select(F.col("cls").alias("a"), F.col("group").alias("ga"))
    other_of = grouped.select(F.col("cls").alias("b"), F.col("group").alias("gb"))
    joined = components(links.join(group_of, "a").join(other_of, "b").select(F.col("ga").alias("a"), F.col("gb").alias("b")))
    final = grouped.join(joined, grouped["group"] == joined["node"], "left").select("n", "fa", "fb", F.coalesce("component", "group").alias("component_id"))
    out = profile.join(final, ["n", "fa", "fb"], "left")
    own = F.when(F.col("doc_id").isNotNull(), F.coalesce("component_id", "doc_id"))
    return out.select("doc_id", F.col("n").alias("n_shingles"), own.alias("component_id"))
