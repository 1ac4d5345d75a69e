"""Language model scores: a hashed maximum-entropy model with a class-factored softmax.

P(word | history) = P(class | history) * P(slot | class, history) * P(word | slot). Every word has one class: the most
frequent words and the end of text have their own; all others, unseen words too, are put into spelling buckets by their
last three bytes, and buckets that follow the same frequent words in the training texts share a class (k-means over those
counts). The class is predicted by a softmax over weights of hashed features of the three words before: the word before,
its class, the pair of classes before (n-grams), and the words two and three back (skips); infrequent words are
represented by their class. Within a class a second softmax, over weights of hashed features of the class and its history
(the word before, the word two back), predicts the slot: the most frequent words of the class have one each,
all others share slots by spelling bucket. Within a slot only the word's own feature is left, whose best weights are its
smoothed share: (c + 1) / (N_slot + V_slot + 1), where one unit is left for all unseen words of that slot. So
probabilities over all seen words and one unseen word per slot sum to one.

Training words are counted over the whole training fold. Weights of classes and slots are trained by distributed gradient
updates: in each round every task updates its own copy in small AdaGrad steps over all of its training texts, and the
updates of each weight row are averaged, weighted by how often tasks met the row. Each round reads the whole training
fold. Scoring works in small sparse batches.

Counts of frequent words (at most ``BROADCAST_WORDS``) are broadcast; all others are joined by hash, for every row's
infrequent words. Words are told apart by 64-bit hashes.

Null texts count as empty: one token, the end. Repeated rows are scored and, if in the training fold, counted each.
A null id is the empty text for the fold. Other columns are ignored. Without training texts all scores are those of
unseen words. An empty table gives an empty result.
"""

from __future__ import annotations

import math
from dataclasses import dataclass, replace

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tablelift.llm.common import share_code, shuffle_tasks, stored
from tablelift.llm.words import LongTable, lower, mix, slices, span_hashes, spans

#: Words with a class of their own, besides the end of text; classes of all other words.
OWN, SPELLED = 15, 32
#: Spelling buckets, and the frequent words whose followers tell buckets apart.
SPELLINGS, CONTEXTS = 1 << 12, 64
CLASSES = OWN + 1 + SPELLED
END_CLASS = OWN
#: Slots of each class of several words: its most frequent words, then groups of all others by spelling bucket.
SINGLE, GROUPED = 12, 4
SLOTS = SINGLE + GROUPED
#: Rows of the weight tables of classes and of slots (below 2^15: they are sorted as 16-bit numbers), and words whose counts are broadcast at most.
ROWS, SLOT_ROWS, BROADCAST_WORDS = 1 << 13, 1 << 15, 1 << 17
#: Words that count as frequent in features.
FEATURE_WORDS = 1 << 12
#: Training rounds (each over all training texts), tokens in a step and in a scoring batch, step size.
ROUNDS, STEP, BATCH, RATE = 2, 4096, 8192, 0.3
#: Different words a task counts before it sends its counts on.
COUNTED = 1 << 20

_END = np.uint64(0x5EED5EED5EED5EED)
_U = np.uint64


def tokens(data: np.ndarray, at: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(word hashes with one end behind each text, spelling bucket of each, first token of each text)."""
    data = lower(data)
    start, end, first = spans(data, at)
    words = span_hashes(data, start, end)
    tail = span_hashes(data, np.maximum(start, end - 3), end)
    spelled = (tail >> _U(64 - 12)).astype(np.int16)
    texts = len(at) - 1
    bounds = first + np.arange(texts + 1)
    h, kind = np.empty(len(words) + texts, np.uint64), np.empty(len(words) + texts, np.int16)
    place = np.arange(len(words)) + np.repeat(np.arange(texts), np.diff(first))
    h[place], kind[place] = words, spelled
    h[bounds[1:] - 1], kind[bounds[1:] - 1] = _END, SPELLINGS
    return h, kind, bounds


def _counts(batches):
    held, size = [], 0

    def merged():
        h = np.concatenate([x[0] for x in held])
        order = np.argsort(h)
        h = h[order]
        n, kind = (np.concatenate([x[i] for x in held])[order] for i in (1, 2))
        begin = np.flatnonzero(np.concatenate([[True], h[1:] != h[:-1]]))
        return h[begin], np.add.reduceat(n, begin), kind[begin]

    def out():
        h, n, kind = merged()
        return pa.RecordBatch.from_arrays([pa.array(h.view(np.int64)), pa.array(n), pa.array(kind.astype(np.int32))], names=["h", "n", "kind"])

    for batch in batches:
        for _, data, at in slices(batch, "text"):
            h, kind, _ = tokens(data, at)
            keys, first, n = np.unique(h, return_index=True, return_counts=True)
            held.append((keys, n, kind[first]))
            size += len(keys)
            if size > COUNTED:
                held = [merged()]
                size = len(held[0][0])
                if size > COUNTED // 2:
                    yield out()
                    held, size = [], 0
    if held:
        yield out()


@dataclass
class Model:
    """What scoring needs; of bounded size."""

    h: np.ndarray  # frequent words, most frequent first
    counts: np.ndarray
    total: int
    different: int
    class_total: np.ndarray
    class_different: np.ndarray
    class_of: np.ndarray  # of each spelling bucket
    weights: np.ndarray
    bias: np.ndarray
    slot_of: np.ndarray  # of each frequent word, -1 where its spelling bucket decides
    slot_total: np.ndarray  # classes x slots
    slot_different: np.ndarray
    slot_weights: np.ndarray
    slot_bias: np.ndarray  # classes x slots

    def lookup(self) -> LongTable:
        table = LongTable(max(16, len(self.h)))
        table.add(self.h, np.arange(len(self.h), dtype=np.int32))
        return table


def _classes(rank: np.ndarray, kind: np.ndarray, own: np.ndarray, class_of: np.ndarray) -> np.ndarray:
    """Class of each token; ``own`` holds the class of the first frequent words, -1 where they have none."""
    out = class_of[kind]
    top = np.flatnonzero((rank >= 0) & (rank < len(own)))
    special = own[rank[top]]
    out[top[special >= 0]] = special[special >= 0]
    return out


def _own_classes(h: np.ndarray) -> np.ndarray:
    """The most frequent words but the end get classes 0, 1, ..."""
    out = np.full(min(len(h), OWN + 1), -1, np.int16)
    words = np.flatnonzero(h[: len(out)] != _END)[:OWN]
    out[words] = np.arange(len(words))
    return out


def _slots(rank: np.ndarray, kind: np.ndarray, classes: np.ndarray, slot_of: np.ndarray) -> np.ndarray:
    """Slot of each token in its class; classes of one word have slot 0 only."""
    out = SINGLE + kind % GROUPED
    top = np.flatnonzero((rank >= 0) & (rank < len(slot_of)))
    own = slot_of[rank[top]]
    out[top[own >= 0]] = own[own >= 0]
    out[classes <= END_CLASS] = 0
    return out


_SALT = mix(np.arange(7, 12, dtype=np.uint64))
_SLOT_SALT = mix(np.arange(17, 19, dtype=np.uint64))


def _history(rank: np.ndarray, classes: np.ndarray, bounds: np.ndarray) -> list[np.ndarray]:
    """The word before, its class, the classes of the two before, the words two and three back, as numbers."""
    n = len(rank)
    # One number for a word as a feature: frequent words by rank, others by class, before the text a start.
    seen = np.where((rank >= 0) & (rank < FEATURE_WORDS), rank.astype(np.int64) + CLASSES + 1, classes.astype(np.int64) + 1)
    place = np.arange(n) - np.repeat(bounds[:-1], np.diff(bounds))

    def back(values, k):
        out = np.zeros(n, np.int64)
        out[k:] = values[:-k] if n > k else out[k:]
        out[place < k] = 0
        return out

    kinds = classes.astype(np.int64) + 1
    one, two = back(kinds, 1), back(kinds, 2)
    return [back(seen, 1), one, one * (CLASSES + 1) + two, back(seen, 2), back(seen, 3)]


def _hashed(columns: list[np.ndarray], salt: np.ndarray, rows: int) -> np.ndarray:
    return np.stack([mix(c.astype(np.uint64) * _U(0x9E3779B97F4A7C15) + s) & _U(rows - 1) for c, s in zip(columns, salt)], axis=1).astype(np.int32)


def _class_rows(history: list[np.ndarray]) -> np.ndarray:
    return _hashed(history, _SALT, ROWS)


def _slot_rows(history: list[np.ndarray], classes: np.ndarray) -> np.ndarray:
    before, _, _, two, _ = history
    return _hashed([c * CLASSES + classes for c in (before, two)], _SLOT_SALT, SLOT_ROWS)


def features(rank: np.ndarray, classes: np.ndarray, bounds: np.ndarray) -> np.ndarray:
    """Weight rows of each token's history (5 of them)."""
    return _class_rows(_history(rank, classes, bounds))


def slot_features(rank: np.ndarray, classes: np.ndarray, bounds: np.ndarray) -> np.ndarray:
    """Slot weight rows of each token's class and history (2 of them)."""
    return _slot_rows(_history(rank, classes, bounds), classes)


def _shifted(weights: np.ndarray, bias: np.ndarray, rows: np.ndarray) -> np.ndarray:
    """Sum of the weight rows of each token and its bias, less the largest."""
    s = np.take(weights, rows[:, 0], axis=0)
    more = np.empty_like(s)
    for f in range(1, rows.shape[1]):
        s += np.take(weights, rows[:, f], axis=0, out=more, mode="clip")
    s += bias
    s -= s.max(axis=1, keepdims=True)
    return s


def log_classes(weights: np.ndarray, bias: np.ndarray, rows: np.ndarray, with_all: bool = False):
    """Log probabilities of all classes, or of all slots of a class, for each token; ``with_all`` adds the probabilities."""
    s = _shifted(weights, bias, rows)
    e = np.exp(s)
    total = e.sum(axis=1, keepdims=True)
    return s - np.log(total), e / total if with_all else None


def _exp(s: np.ndarray) -> np.ndarray:
    """Exponentials in place of the scores, and the sum of each row; rows are lowered by their largest score only where scores are large."""
    if not (s.min() > -80 and s.max() < 80):
        s -= s.max(axis=1, keepdims=True)
    np.exp(s, out=s)
    return s @ np.ones(s.shape[1], np.float32)


def _log_chosen(weights: np.ndarray, bias: np.ndarray, rows: np.ndarray, y: np.ndarray, room: list[np.ndarray]) -> np.ndarray:
    """Log probability of the class, or slot, ``y`` of each token; ``room`` is two arrays of enough rows."""
    s, more = room[0][: len(y)], room[1][: len(y)]
    np.take(weights, rows[:, 0], axis=0, out=s, mode="clip")
    for f in range(1, rows.shape[1]):
        s += np.take(weights, rows[:, f], axis=0, out=more, mode="clip")
    s += bias
    if not (s.min() > -80 and s.max() < 80):
        s -= s.max(axis=1, keepdims=True)
    chosen = s[np.arange(len(y)), y]
    return chosen - np.log(_exp(s))


class _Steps:
    """A task's own copy of one weight table and its bias rows, updated by AdaGrad in steps of at most ``STEP`` tokens."""

    def __init__(self, weights: np.ndarray, bias: np.ndarray, at_once: int):
        self.weights, self.bias, self.before = weights.copy(), bias.copy(), (weights, bias)
        self.state, self.bias_state = np.full(len(weights), 1e-2, np.float32), np.full(bias.shape, 1e-2, np.float32)
        self.met, self.bias_met = np.zeros(len(weights), np.int64), np.zeros(len(bias), np.int64)
        # Features whose gradients are added up together, and room for numbers of a step, so that steps take no new memory.
        self.at_once, width = at_once, weights.shape[1]
        self.room = [np.empty((STEP * k, width), np.float32) for k in (1, 1, at_once)]

    def step(self, rows: np.ndarray, bias_rows: np.ndarray, y: np.ndarray, nested: tuple[np.ndarray, tuple[int, ...]] | None = None) -> None:
        """One step on tokens whose answers are ``y``.

        ``nested`` gives a small number of each token that decides the rows of the columns listed, and the bias row: their gradients are
        added up by that number first.
        """
        n, columns = len(y), np.ascontiguousarray(rows.T)
        g, more = self.room[0][:n], self.room[1][:n]
        np.take(self.weights, columns[0], axis=0, out=g, mode="clip")
        for c in columns[1:]:
            g += np.take(self.weights, c, axis=0, out=more, mode="clip")
        g += np.take(self.bias, bias_rows, axis=0, out=more, mode="clip") if len(self.bias) > 1 else self.bias
        g *= (1 / _exp(g))[:, None]
        g[np.arange(n), y] -= 1
        if nested:
            _, first, times, total = self._sums(g, nested[0])
            for i, c in enumerate(columns):
                if i in nested[1]:
                    self._add(n, total, c[first], self.weights, self.state, self.met, times)
                else:
                    self._add(n, g, c, self.weights, self.state, self.met)
            self._add(n, total, bias_rows[first], self.bias, self.bias_state, self.bias_met, times)
            return
        for i in range(0, len(columns), self.at_once):
            self._add(n, g, columns[i : i + self.at_once].ravel(), self.weights, self.state, self.met)
        self._add(n, g, bias_rows, self.bias, self.bias_state, self.bias_met)

    def _sums(self, g, flat, times=None):
        """(place of the first, how many, sum of the rows of ``g``) of each different number."""
        # Sixteen bits are sorted by counting.
        order = np.argsort(flat.astype(np.int16), kind="stable")
        ordered = flat[order]
        begin = np.flatnonzero(np.concatenate([[True], ordered[1:] != ordered[:-1]]))
        size = np.diff(np.append(begin, len(flat)))
        if len(flat) > len(g):
            order %= len(g)
        first = order[begin]
        total, several = np.take(g, first, axis=0, mode="clip"), np.flatnonzero(size > 1)
        if len(several):
            among, sizes = order[np.repeat(size > 1, size)], size[several]
            gathered = np.take(g, among, axis=0, out=self.room[2][: len(among)], mode="clip")
            # Two numbers are added at once.
            total[several] = np.add.reduceat(gathered.view(np.complex64), np.cumsum(sizes) - sizes, axis=0).view(np.float32)
        return ordered[begin], first, size if times is None else np.add.reduceat(times[order], begin), total

    def _add(self, n, g, flat, value, state, met, times=None):
        """AdaGrad on the rows ``flat`` of a table, for ``n`` tokens; ``times`` tells how many tokens each row of ``g`` stands for."""
        used, _, times, total = self._sums(g, flat, times)
        total /= n
        if state.ndim > 1:
            state[used] = sums = state[used] + total * total
            total *= RATE / np.sqrt(sums)
        else:
            state[used] = sums = state[used] + np.einsum("ij,ij->i", total, total)
            total *= (RATE / np.sqrt(sums))[:, None]
        value[used] = np.subtract(np.take(value, used, axis=0, mode="clip"), total, out=total)
        met[used] += times

    def changes(self):
        """(row, how often it was met, change) of the rows met; bias rows come after the weights."""
        for value, before, met, first in zip((self.weights, self.bias), self.before, (self.met, self.bias_met), (0, len(self.weights))):
            used = np.flatnonzero(met)
            yield first + used, met[used], [x.tobytes() for x in (value - before)[used].astype(np.float32)]


def _train_task(batches, shared, lookup_of):
    model, own = shared.value
    lookup = lookup_of(model)
    tables = _Steps(model.weights, model.bias[None], 1), _Steps(model.slot_weights, model.slot_bias, 2)
    for batch in batches:
        for _, data, at in slices(batch, "text"):
            h, kind, bounds = tokens(data, at)
            rank = lookup.find(h)
            target = _classes(rank, kind, own, model.class_of)
            slot = _slots(rank, kind, target, model.slot_of)
            history = _history(rank, target, bounds)
            rows, slot_rows, pairs = _class_rows(history), _slot_rows(history, target), history[2].astype(np.int32)
            several = np.flatnonzero(target > END_CLASS)
            for i in range(0, len(h), STEP):
                y = target[i : i + STEP]
                # The classes before decide the rows of the class and of the pair of classes before.
                tables[0].step(rows[i : i + STEP], np.zeros(len(y), np.int32), y, (pairs[i : i + STEP], (1, 2)))
            for i in range(0, len(several), STEP):
                k = several[i : i + STEP]
                tables[1].step(slot_rows[k], target[k].astype(np.int32), slot[k])
    for k, table in enumerate(tables):
        for rows, n, changes in table.changes():
            kinds = pa.array(np.full(len(rows), k, np.int32))
            yield pa.RecordBatch.from_arrays([kinds, pa.array(rows.astype(np.int32)), pa.array(n), pa.array(changes, pa.binary())], names=["part", "row", "n", "change"])


def _followers(batches, shared):
    """How often each spelling bucket comes one or two words after each of the most frequent words."""
    lookup = LongTable(max(16, len(shared.value)))
    lookup.add(shared.value, np.arange(len(shared.value), dtype=np.int32))
    counts = np.zeros((SPELLINGS + 1) * CONTEXTS, np.int64)
    for batch in batches:
        for _, data, at in slices(batch, "text"):
            h, kind, bounds = tokens(data, at)
            rank, doc = lookup.find(h), np.repeat(np.arange(len(at) - 1), np.diff(bounds))
            for k in (1, 2):
                both = np.flatnonzero((rank[:-k] >= 0) & (doc[:-k] == doc[k:]))
                counts += np.bincount(kind[k:][both].astype(np.int64) * CONTEXTS + rank[:-k][both], minlength=len(counts))
    counts = counts.reshape(-1, CONTEXTS)[:SPELLINGS]
    used = np.flatnonzero(counts.any(axis=1))
    yield pa.RecordBatch.from_arrays([pa.array(used.astype(np.int32)), pa.array([x.tobytes() for x in counts[used]], pa.binary())], names=["bucket", "counts"])


def _added(batches):
    """Sum of the counts of each bucket; rows come sorted."""
    sums: dict[int, np.ndarray] = {}
    for batch in batches:
        for b, x in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
            sums[b] = sums.get(b, 0) + np.frombuffer(x, np.int64)
    if sums:
        yield pa.RecordBatch.from_arrays([pa.array(list(sums), pa.int32()), pa.array([x.tobytes() for x in sums.values()], pa.binary())], names=["bucket", "counts"])


def _clustered(counts: np.ndarray, classes: int, turns: int = 25) -> np.ndarray:
    """k-means of rows by direction, weighted by their sums; starts from rows far from each other."""
    weight = counts.sum(axis=1)
    x = np.sqrt(counts) / np.sqrt(np.maximum(weight, 1))[:, None]  # unit length
    centres = [x[weight.argmax()]]
    nearest = x @ centres[0]
    for _ in range(classes - 1):
        centres.append(x[((1 - nearest) * np.sqrt(weight)).argmax()])
        nearest = np.maximum(nearest, x @ centres[-1])
    centres = np.array(centres)
    for _ in range(turns):
        of = (x @ centres.T).argmax(axis=1)
        for k in np.unique(of):
            total = (x[of == k] * weight[of == k, None]).sum(axis=0)
            if total.any():
                centres[k] = total / np.sqrt((total * total).sum())
    return of


def _spelled_classes(training: DataFrame, h: np.ndarray) -> np.ndarray:
    """Class of each spelling bucket, and of the end."""
    spark = training.sparkSession
    shared = spark.sparkContext.broadcast(h[h != _END][:CONTEXTS])
    rows = training.select("text").mapInArrow(lambda x: _followers(x, shared), "bucket int, counts binary")
    # At most SPELLINGS rows of CONTEXTS numbers reach the driver.
    rows = rows.repartition(shuffle_tasks(spark), "bucket").mapInArrow(_added, "bucket int, counts binary").toArrow()
    counts = np.zeros((SPELLINGS, CONTEXTS))
    for b, x in zip(rows["bucket"].to_pylist(), rows["counts"].to_pylist()):
        counts[b] = np.frombuffer(x, np.int64)
    return np.append(OWN + 1 + _clustered(counts, SPELLED), END_CLASS).astype(np.int16)


def _averaged(batches):
    """Mean change of each weight row, weighted by how often its tasks met it; rows come sorted."""
    key, n, total = None, 0, None
    done = []
    for batch in batches:
        for part, r, k, change in zip(*(batch.column(i).to_pylist() for i in range(4))):
            change = np.frombuffer(change, np.float32).astype(np.float64)
            if (part, r) != key:
                if key is not None:
                    done.append((*key, total / n))
                key, n, total = (part, r), 0, 0.0
            n += k
            total = total + k * change
    if key is not None:
        done.append((*key, total / n))
    if done:
        parts, rows, changes = zip(*done)
        yield pa.RecordBatch.from_arrays(
            [pa.array(parts, pa.int32()), pa.array(rows, pa.int32()), pa.array([x.astype(np.float32).tobytes() for x in changes], pa.binary())], names=["part", "row", "change"]
        )


def _trained(docs: DataFrame, model: Model, rounds: int) -> Model:
    spark = docs.sparkSession
    own = _own_classes(model.h)
    for _ in range(rounds):
        shared = spark.sparkContext.broadcast((model, own))
        changes = docs.select("text").mapInArrow(lambda x, s=shared: _train_task(x, s, Model.lookup), "part int, row int, n long, change binary")
        placed = changes.repartition(shuffle_tasks(spark), "part", "row").sortWithinPartitions("part", "row")
        # At most one row for each weight and bias row of the two tables reaches the driver.
        rows = placed.mapInArrow(_averaged, "part int, row int, change binary").toArrow()
        tables = [np.vstack([model.weights, model.bias[None]]), np.vstack([model.slot_weights, model.slot_bias])]
        for batch in rows.to_batches():
            for part, r, change in zip(*(batch.column(i).to_pylist() for i in range(3))):
                tables[part][r] += np.frombuffer(change, np.float32)
        weights, slots = tables
        model = replace(model, weights=weights[:ROWS], bias=weights[ROWS], slot_weights=slots[:SLOT_ROWS], slot_bias=slots[SLOT_ROWS:])
    return model


def fit(training: DataFrame, rounds: int = ROUNDS) -> tuple[Model, DataFrame]:
    """The model, and the table (h, n) of all training words with their counts."""
    counted = training.select("text").mapInArrow(_counts, "h long, n long, kind int")
    vocabulary = stored(counted.groupBy("h").agg(F.sum("n").alias("n"), F.min("kind").alias("kind")))
    level = F.floor(F.log2("n") * 4).cast("int")
    levels = vocabulary.groupBy(level.alias("level")).count().collect()
    least, kept = 0, 0
    for r in sorted(levels, key=lambda r: -r["level"]):
        kept += r["count"]
        if kept > BROADCAST_WORDS:
            least = r["level"] + 1
            break
    # At most BROADCAST_WORDS rows.
    top = vocabulary.where(level >= least).select("h", "n", "kind").toArrow()
    h, n, kind = top["h"].to_numpy().view(np.uint64), top["n"].to_numpy(), top["kind"].to_numpy()
    order = np.lexsort((h, -n))
    h, n, kind = h[order], n[order], kind[order]

    own = _own_classes(h)
    class_of = _spelled_classes(training, h) if len(h) else np.append(np.full(SPELLINGS, OWN + 1), END_CLASS).astype(np.int16)
    kinds = vocabulary.groupBy("kind").agg(F.sum("n").alias("n"), F.count(F.lit(1)).alias("v")).collect()
    total, different = np.zeros((CLASSES, SLOTS), np.int64), np.zeros((CLASSES, SLOTS), np.int64)

    def place(k, n, v):
        at = class_of[k], 0 if class_of[k] <= END_CLASS else SINGLE + k % GROUPED
        total[at] += n
        different[at] += v

    for r in kinds:
        place(r["kind"], r["n"], r["v"])
    slot_of, taken = np.full(len(h), -1, np.int8), np.zeros(CLASSES, np.int64)
    for i in range(len(h)):
        mine = class_of[kind[i]]
        if i < len(own) and own[i] >= 0:
            to = own[i], 0
        elif mine > END_CLASS and taken[mine] < SINGLE:
            to = mine, taken[mine]
            slot_of[i] = taken[mine]
            taken[mine] += 1
        else:
            continue
        place(kind[i], -n[i], -1)
        total[to], different[to] = n[i], 1
    slot_of = slot_of[: np.flatnonzero(slot_of >= 0).max(initial=-1) + 1]
    # Slots that stand for no word have next to no share.
    slot_bias = np.log(np.where((np.arange(SLOTS) < SINGLE) & (total == 0), 1e-12, total + 1) / (total.sum(axis=1, keepdims=True) + SLOTS)).astype(np.float32)
    model = Model(
        h, n, int(total.sum()), int(different.sum()), total.sum(axis=1), different.sum(axis=1), class_of, np.zeros((ROWS, CLASSES), np.float32), np.zeros(CLASSES, np.float32),
        slot_of, total, different, np.zeros((SLOT_ROWS, SLOTS), np.float32), slot_bias,
    )
    if len(h):
        model.bias = np.log((model.class_total + 1) / (model.total + CLASSES)).astype(np.float32)
        model = _trained(training, model, rounds)
    return model, vocabulary.select("h", "n")


_PARTIAL = "row long, doc_id long, held_out boolean, n_tokens long, n_known long, log_counts double, log_classes double, log_sizes double, rare array<long>"


def scored(docs: DataFrame, id: str = "doc_id", text: str = "text", folds: int = 7, held_fold: int = 2, rounds: int = ROUNDS) -> DataFrame:
    """doc_id, held_out, n_tokens, n_known, train_tokens, base_score and score of every row."""
    spark = share_code(docs.sparkSession)
    fold = F.crc32(F.coalesce(F.col(id).cast("string"), F.lit(""))) % folds
    rows = docs.select(F.col(id).cast("long").alias("doc_id"), (fold == held_fold).alias("held_out"), F.col(text).cast("string").alias("text"))
    model, vocabulary = fit(rows.where("NOT held_out").select("doc_id", "text"), rounds)
    shared = spark.sparkContext.broadcast(model)

    def partial(batches):
        model = shared.value
        lookup, own = model.lookup(), _own_classes(model.h)
        log_count = np.log10(model.counts + 1.0)
        log_size = np.log10(model.slot_total + model.slot_different + 1.0)
        rooms = [[np.empty((BATCH, width), np.float32) for _ in range(2)] for width in (CLASSES, SLOTS)]
        task = TaskContext.get().partitionId() << 40
        for batch in batches:
            for part, data, at in slices(batch, "text"):
                h, kind, bounds = tokens(data, at)
                rank = lookup.find(h)
                classes = _classes(rank, kind, own, model.class_of)
                slot = _slots(rank, kind, classes, model.slot_of)
                history = _history(rank, classes, bounds)
                wanted, within = _class_rows(history), _slot_rows(history, classes)
                chosen = np.empty(len(h))
                for i in range(0, len(h), BATCH):
                    y = classes[i : i + BATCH]
                    chosen[i : i + BATCH] = _log_chosen(model.weights, model.bias, wanted[i : i + BATCH], y, rooms[0])
                    parted = i + np.flatnonzero(y > END_CLASS)
                    if len(parted):
                        chosen[parted] += _log_chosen(model.slot_weights, model.slot_bias[classes[parted]], within[parted], slot[parted], rooms[1])
                known = rank >= 0
                counts = np.zeros(len(h))
                counts[known] = log_count[rank[known]]
                per = lambda x: np.add.reduceat(x, bounds[:-1])  # noqa: E731  every text has at least its end
                rare = h[~known].view(np.int64)
                cuts = np.concatenate([[0], np.cumsum(~known)])[bounds]
                n = len(at) - 1
                yield pa.RecordBatch.from_arrays(
                    [pa.array(np.arange(task, task + n)), part.column(0), part.column(1), pa.array(np.diff(bounds)), pa.array(per(known.astype(np.int64))),
                     pa.array(per(counts)), pa.array(per(chosen) / math.log(10)), pa.array(per(log_size[classes, slot])),
                     pa.ListArray.from_arrays(pa.array(cuts.astype(np.int32)), pa.array(rare))],
                    names=["row", "doc_id", "held_out", "n_tokens", "n_known", "log_counts", "log_classes", "log_sizes", "rare"],
                )
                task += n

    parts = stored(rows.mapInArrow(partial, _PARTIAL))
    # Infrequent words: one row for each different one of a text, joined to its count.
    rare = parts.select("row", F.explode("rare").alias("h")).join(vocabulary, "h")
    found = rare.groupBy("row").agg(F.count(F.lit(1)).alias("more"), F.sum(F.log10(F.col("n") + 1.0)).alias("logs"))
    joined = parts.drop("rare").join(found, "row", "left")
    counts = F.col("log_counts") + F.coalesce("logs", F.lit(0.0))
    size = math.log10(model.total + model.different + 1)
    return joined.select(
        "doc_id", "held_out", "n_tokens", (F.col("n_known") + F.coalesce("more", F.lit(0))).alias("n_known"), F.lit(model.total).cast("long").alias("train_tokens"),
        (counts - F.col("n_tokens") * F.lit(size)).alias("base_score"), (counts + F.col("log_classes") - F.col("log_sizes")).alias("score"),
    )
