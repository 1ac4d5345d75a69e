"""Toxicity of texts by a small convolutional classifier written in numpy.

Words (lower-cased A-Z, punctuation at their ends removed) are hashed, together with their first four and five bytes,
into one table of embeddings. Filters of several widths run over the text, the largest kept, and a logistic unit turns these into a probability. The network learns from every labelled text outside the
held-out fold but a quarter: it starts from a fit to a bounded sample; then, in each round, every task takes AdaGrad steps
on its own copy over all of its texts, and the changes of each embedding, weight and AdaGrad sum are averaged, weighted by
how often tasks met them. Buckets seen in fewer than ``SEEN`` of all these texts stay unknown. Thresholds are then
calibrated for each language on the other quarter, from counts of all its scores in ``BINS`` steps; scores are bent so that
each threshold lies at 0.5. The language is told from the text's own function words, never from a column.

Null texts count as empty; they are scored like any text. Rows may repeat, ids may be null and other columns are
ignored. Null labels are not learned from. Without labels of both kinds every text scores 0. An empty table gives an
empty result.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import DoubleType, IntegerType, StructField, StructType

from tablelift.llm.common import release_memory, share_code, stored, tidy
from tablelift.llm.words import lower, slices, span_hashes, spans

#: Labelled texts of each label that the driver starts from at most; all others follow in the rounds.
TOXIC, CLEAN = 2000, 3000
#: Buckets of the embedding table, its width, filter widths, filters of each width.
BUCKETS, DIM, WIDTHS, FILTERS = 1 << 17, 8, (1, 2, 3), 8
#: Training texts that must hold a bucket, passes over the sample, texts in a step, step size, decay.
SEEN, EPOCHS, STEP, RATE, DECAY = 4, 8, 32, 0.15, 1e-4
#: Rounds over all labelled texts, texts of a task at least, steps of a score in which thresholds are found.
ROUNDS, TASK_TEXTS, BINS = 2, 1000, 1 << 14

# Frequent function words of four languages; what holds none of them is its own group.
FUNCTION_WORDS = {
    "en": ["the", "of", "and", "to", "is", "that", "for", "it", "was", "with", "are", "this"],
    "de": ["der", "die", "und", "den", "von", "zu", "das", "ist", "mit", "nicht", "ein", "eine"],
    "fr": ["le", "les", "des", "et", "est", "une", "du", "dans", "pour", "qui", "par", "sur"],
    "es": ["el", "los", "las", "y", "del", "se", "por", "con", "una", "para", "su", "al"],
}

_PUNCTUATION = np.zeros(256, bool)
_PUNCTUATION[list(range(0x21, 0x30)) + list(range(0x3A, 0x41)) + list(range(0x5B, 0x61)) + list(range(0x7B, 0x7F))] = True


def _hash(words: list[str]) -> np.ndarray:
    raw = [w.encode() for w in words]
    n = np.array([len(r) for r in raw])
    end = np.cumsum(n)
    return span_hashes(np.frombuffer(b"".join(raw), np.uint8), end - n, end)


_FUNCTION_HASHES = np.concatenate([_hash(w) for w in FUNCTION_WORDS.values()])
_FUNCTION_LANGUAGE = np.repeat(np.arange(len(FUNCTION_WORDS)), [len(w) for w in FUNCTION_WORDS.values()])
_ORDER = np.argsort(_FUNCTION_HASHES)
LANGUAGES = len(FUNCTION_WORDS) + 1


def features(data: np.ndarray, at: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(buckets of each word, first word of each text, language of each text) of a slice."""
    data = lower(data)
    start, end, first = spans(data, at)
    for _ in range(3):
        cut = _PUNCTUATION[data[end - 1]] & (end - start > 1) if len(end) else np.zeros(0, bool)
        end = end - cut
        cut = _PUNCTUATION[data[start]] & (end - start > 1) if len(end) else np.zeros(0, bool)
        start = start + cut
    whole = span_hashes(data, start, end)
    parts = [whole, *(span_hashes(data, start, np.minimum(end, start + k)) + np.uint64(k) for k in (4, 5))]
    buckets = np.stack([(h >> np.uint64(20)).astype(np.int64) % (BUCKETS - 1) + 1 for h in parts], axis=1).astype(np.int32)
    known = _FUNCTION_HASHES[_ORDER]
    place = np.minimum(np.searchsorted(known, whole), len(known) - 1)
    hit = np.flatnonzero(known[place] == whole) if len(whole) else np.zeros(0, np.int64)
    texts = len(at) - 1
    doc = np.repeat(np.arange(texts), np.diff(first))
    votes = np.zeros((texts, LANGUAGES))
    np.add.at(votes, (doc[hit], _FUNCTION_LANGUAGE[_ORDER][place[hit]]), 1)
    votes[:, -1] = 0.5
    return buckets, first, votes.argmax(axis=1)


@dataclass
class Network:
    """Weights; ``known`` tells which buckets have an embedding."""

    known: np.ndarray
    embedding: np.ndarray
    filters: list[np.ndarray]
    bias: list[np.ndarray]
    out: np.ndarray
    out_bias: float

    def padded(self, buckets: np.ndarray, first: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Buckets with unknown ones at 0 and as many empty words behind each text as the widest filter needs."""
        pad = max(WIDTHS)
        sizes = np.diff(first) + pad
        begin = np.cumsum(sizes) - sizes
        out = np.zeros((int(sizes.sum()), buckets.shape[1]), np.int32)
        at = np.arange(len(buckets)) + np.repeat(begin - first[:-1], np.diff(first))
        out[at] = np.where(self.known[buckets], buckets, 0)
        return out, begin

    def forward(self, ids: np.ndarray, begin: np.ndarray):
        """Probability of each text, the pooled answers, and the word vectors and answers of each filter width."""
        x = self.embedding[ids].sum(axis=1)
        pooled, answers = [], []
        for width, w, b in zip(WIDTHS, self.filters, self.bias):
            h = np.full((len(x), FILTERS), -np.inf, np.float32)
            n = len(x) - width + 1
            h[:n] = b
            for j in range(width):
                h[:n] += x[j : j + n] @ w[j]
            # Only windows that start at a word or at the first pad of a text, and end within the text's pads.
            for k in range(1, max(WIDTHS)):
                ends = np.append(begin[1:], len(x)) - k
                h[ends] = -np.inf
            pooled.append(np.maximum.reduceat(h, begin, axis=0))
            answers.append(h)
        z = np.tanh(np.concatenate(pooled, axis=1))
        p = 1 / (1 + np.exp(-np.clip(z @ self.out + self.out_bias, -30, 30)))
        return p, z, x, answers


def _new_network(known: np.ndarray, seed: int = 7) -> Network:
    r = np.random.default_rng(seed)
    e = r.normal(0, 0.1, (BUCKETS, DIM)).astype(np.float32)
    e[0] = 0
    return Network(
        known, e, [r.normal(0, 0.4, (w, DIM, FILTERS)).astype(np.float32) for w in WIDTHS], [np.zeros(FILTERS, np.float32) for _ in WIDTHS],
        r.normal(0, 0.3, len(WIDTHS) * FILTERS).astype(np.float32), -1.0,
    )


def _new_state(net: Network) -> Network:
    """AdaGrad sums, in the shape of the network they belong to."""
    like = lambda x: np.full_like(x, 1e-3)
    return Network(net.known, like(net.embedding), [like(w) for w in net.filters], [like(b) for b in net.bias], like(net.out), 1e-3)


def _copied(net: Network) -> Network:
    return Network(net.known, net.embedding.copy(), [w.copy() for w in net.filters], [b.copy() for b in net.bias], net.out.copy(), net.out_bias)


def _learn(net: Network, state: Network, texts: list[np.ndarray], d_of) -> np.ndarray:
    """One step on a few texts; ``d_of`` turns probabilities into errors. Gives the embeddings met."""
    first = np.concatenate([[0], np.cumsum([len(t) for t in texts])])
    ids, begin = net.padded(np.concatenate(texts), first)
    p, z, x, answers = net.forward(ids, begin)
    d = d_of(p).astype(np.float32)
    gz = d[:, None] * net.out * (1 - z * z)
    ends = np.append(begin[1:], len(x))
    touched, gx = [], []

    def step(value, gradient, sums):
        sums += gradient * gradient
        value -= RATE * gradient / np.sqrt(sums) + DECAY * value

    for i, width in enumerate(WIDTHS):
        g = gz[:, i * FILTERS : (i + 1) * FILTERS]
        best = np.stack([a + answers[i][a:b].argmax(axis=0) for a, b in zip(begin, ends)])
        gw = np.zeros_like(net.filters[i])
        for j in range(width):
            gw[j] = np.einsum("tf,tfd->df", g, x[best + j])
            touched.append((best + j).ravel())
            gx.append((g[:, :, None] * net.filters[i][j].T[None]).reshape(-1, DIM))
        step(net.filters[i], gw, state.filters[i])
        step(net.bias[i], g.sum(axis=0), state.bias[i])
    step(net.out, z.T @ d, state.out)
    g = float(d.sum())
    state.out_bias += g * g
    net.out_bias -= RATE * g / np.sqrt(state.out_bias)
    where = ids[np.concatenate(touched)]
    rows, inverse = np.unique(where.ravel(), return_inverse=True)
    total = np.zeros((len(rows), DIM), np.float32)
    np.add.at(total, inverse.reshape(where.shape), np.concatenate(gx)[:, None, :])
    total[rows == 0] = 0
    state.embedding[rows] += total * total
    net.embedding[rows] -= RATE * total / np.sqrt(state.embedding[rows])
    return rows


def train(texts: list[np.ndarray], labels: np.ndarray, known: np.ndarray, epochs: int = EPOCHS, seed: int = 7) -> tuple[Network, Network]:
    """Network fitted to texts given as their words' buckets, and its AdaGrad sums; the largest answers alone carry gradients."""
    net, r = _new_network(known, seed), np.random.default_rng(seed)
    state = _new_state(net)
    weight = np.where(labels == 1, 0.5 / max(1, labels.sum()), 0.5 / max(1, (labels == 0).sum())) * len(labels)
    for _ in range(epochs):
        order = r.permutation(len(texts))
        for lot in (order[i : i + STEP] for i in range(0, len(order), STEP)):
            _learn(net, state, [texts[i] for i in lot], lambda p, lot=lot: (p - labels[lot]) * weight[lot] / len(lot))
    return net, state


def _small(net: Network) -> np.ndarray:
    """All weights but the embeddings, as rows as wide as an embedding."""
    flat = np.concatenate([*(w.ravel() for w in net.filters), *net.bias, net.out, [net.out_bias]])
    return np.append(flat, np.zeros(-len(flat) % DIM)).astype(np.float32).reshape(-1, DIM)


def _with_small(net: Network, rows: np.ndarray) -> Network:
    flat, at, parts = rows.ravel(), 0, []
    for like in (*net.filters, *net.bias, net.out):
        parts.append(flat[at : at + like.size].reshape(like.shape).copy())
        at += like.size
    n = len(WIDTHS)
    return Network(net.known, net.embedding, parts[:n], parts[n : 2 * n], parts[-1], float(flat[at]))


_CHANGES, _SUMS = [f"c{i}" for i in range(DIM)], [f"s{i}" for i in range(DIM)]


def _train_task(batches, shared):
    """(row, how often it was met, change, change of its AdaGrad sums); the small weights come after the embeddings."""
    before, sums, weigh, seed = shared.value
    net, state = _copied(before), _copied(sums)
    met, done = np.zeros(BUCKETS, np.int64), 0
    r = np.random.default_rng(seed)
    for batch in batches:
        raw, y = batch.column("buckets"), batch.column("toxic").to_numpy()
        order = r.permutation(len(y))
        for lot in (order[i : i + STEP] for i in range(0, len(order), STEP)):
            texts = [np.frombuffer(raw[i].as_buffer(), np.int32).reshape(-1, 3) for i in lot.tolist()]
            met[_learn(net, state, texts, lambda p, lot=lot: (p - y[lot]) * np.where(y[lot] == 1, weigh[1], weigh[0]) / len(lot))] += 1
            done += len(lot)
    if done:
        rows = np.flatnonzero(met)
        small = len(_small(net))
        changes = np.vstack([(net.embedding - before.embedding)[rows], _small(net) - _small(before)])
        added = np.vstack([(state.embedding - sums.embedding)[rows], _small(state) - _small(sums)])
        columns = [np.append(rows, BUCKETS + np.arange(small)).astype(np.int32), np.append(met[rows], np.full(small, done)), *changes.T, *added.T]
        yield pa.RecordBatch.from_arrays([pa.array(np.ascontiguousarray(c)) for c in columns], names=["row", "n", *_CHANGES, *_SUMS])


def _round(training: DataFrame, net: Network, state: Network, weigh: tuple[float, float], seed: int) -> tuple[Network, Network]:
    shared = training.sparkSession.sparkContext.broadcast((net, state, weigh, seed))
    fields = ", ".join(f"{c} float" for c in (*_CHANGES, *_SUMS))
    changes = training.select("toxic", "buckets").mapInArrow(tidy(lambda x: _train_task(x, shared)), f"row int, n long, {fields}")
    mean = [(F.sum(F.col(c) * F.col("n")) / F.sum("n")).cast("float").alias(c) for c in (*_CHANGES, *_SUMS)]
    # At most one row for each embedding, and the small weights.
    got = changes.groupBy("row").agg(*mean).toArrow()
    row = got["row"].to_numpy()
    out = []
    for old, names in ((net, _CHANGES), (state, _SUMS)):
        every = np.vstack([old.embedding, _small(old)])
        every[row] += np.stack([got[c].to_numpy() for c in names], axis=1)
        new = _with_small(old, every[BUCKETS:])
        new.embedding = every[:BUCKETS]
        out.append(new)
    return out[0], out[1]


def _threshold(p: np.ndarray, y: np.ndarray, n: np.ndarray | float = 1.0) -> float:
    """Least wrong answers, the middle of the best gap; ``n`` tells how many texts each answer stands for."""
    order = np.argsort(p, kind="stable")
    n = np.broadcast_to(n, p.shape)[order]
    p, y = p[order], y[order]
    missed = np.concatenate([[0], np.cumsum(n * y)])
    accused = np.concatenate([np.cumsum((n * (y == 0))[::-1])[::-1], [0]])
    wrong = missed + accused
    edges = np.concatenate([[0.0], (p[1:] + p[:-1]) / 2, [1.0]]) if len(p) else np.array([0.5])
    # No edge parts equal answers.
    apart = np.concatenate([[True], p[1:] > p[:-1], [True]]) if len(p) else np.array([True])
    best = np.flatnonzero(apart & (wrong == wrong[apart].min()))
    return float(np.clip(np.median(edges[best]), 0.02, 0.98))


def bend(p: np.ndarray, threshold: np.ndarray) -> np.ndarray:
    """Monotone map of [0, 1] to itself that puts the threshold at 0.5."""
    return np.where(p < threshold, 0.5 * p / threshold, 0.5 + 0.5 * (p - threshold) / (1 - threshold))


def fit(docs: DataFrame, labels: DataFrame, toxic: int = TOXIC, clean: int = CLEAN, rounds: int = ROUNDS) -> tuple[Network, np.ndarray] | None:
    """Network and one threshold for each language, from all labelled texts outside the held-out fold."""
    rows = _labelled(docs, labels)
    found = {(r["toxic"], r["apart"]): r["count"] for r in rows.groupBy("toxic", "apart").count().collect()}
    if any(found.get((k, True), 0) + found.get((k, False), 0) == 0 for k in (0, 1)):
        return None
    parted = all(found.get((k, a), 0) for k in (0, 1) for a in (True, False))
    training, checked = (rows.where("NOT apart"), rows.where("apart")) if parted else (rows, rows)
    n = [found.get((k, False), 0) + (0 if parted else found.get((k, True), 0)) for k in (0, 1)]
    # Files are read in tasks of enough texts to learn from; no shuffle.
    tasks = max(1, sum(n) // TASK_TEXTS)
    known = _known(training)
    net, state = _start(training, known, toxic, clean)
    for k in range(rounds):
        net, state = _round(training.coalesce(tasks), net, state, (0.5 / n[0] * sum(n), 0.5 / n[1] * sum(n)), k)
    return net, _thresholds(checked, net)


def _known(training: DataFrame) -> np.ndarray:
    """Which buckets are held by enough training texts."""

    def run(batches):
        held = np.zeros(BUCKETS, np.int64)
        for batch in batches:
            for raw in batch.column(0):
                held[np.unique(np.frombuffer(raw.as_buffer(), np.int32))] += 1
        rows = np.flatnonzero(held)
        yield pa.RecordBatch.from_arrays([pa.array(rows.astype(np.int32)), pa.array(held[rows])], names=["bucket", "n"])

    held = training.select("buckets").mapInArrow(tidy(run), "bucket int, n long").groupBy("bucket").agg(F.sum("n").alias("n"))
    # At most BUCKETS numbers.
    known = np.zeros(BUCKETS, bool)
    known[held.where(F.col("n") >= SEEN).select("bucket").toArrow()["bucket"].to_numpy()] = True
    known[0] = False
    return known


def _start(training: DataFrame, known: np.ndarray, toxic: int, clean: int) -> tuple[Network, Network]:
    """The network fitted to at most ``toxic`` and ``clean`` texts, where the rounds begin."""
    order = [F.xxhash64("id"), F.col("id")]
    ids = training.select("id", "toxic").distinct()
    picked = ids.where("toxic = 1").orderBy(*order).limit(toxic).union(ids.where("toxic = 0").orderBy(*order).limit(clean))
    # At most toxic + clean ids.
    rows = training.join(F.broadcast(picked), ["id", "toxic"], "left_semi").select("id", "toxic", "buckets").toArrow()
    ids, y = rows["id"].to_numpy(), rows["toxic"].to_numpy().astype(np.int64)
    order = np.lexsort((y, ids, _order(ids)))
    buckets = rows["buckets"].combine_chunks()
    # Views of the gathered bytes, not copies: the driver holds them once.
    return train([np.frombuffer(buckets[i].as_buffer(), np.int32).reshape(-1, 3) for i in order.tolist()], y[order], known)


def _thresholds(checked: DataFrame, net: Network) -> np.ndarray:
    """One threshold for each language; where a language has few texts, that of all."""
    shared = checked.sparkSession.sparkContext.broadcast(net)

    def run(batches):
        for batch in batches:
            raw = batch.column("buckets")
            p = [np.zeros(0)]
            for i in range(0, len(raw), 64):
                p.append(_scores(shared.value, [np.frombuffer(x.as_buffer(), np.int32).reshape(-1, 3) for x in raw[i : i + 64]]))
            bins = np.minimum(np.concatenate(p) * BINS, BINS - 1).astype(np.int32)
            yield pa.RecordBatch.from_arrays([batch.column("toxic"), batch.column("language"), pa.array(bins)], names=["toxic", "language", "bin"])

    scores = checked.select("toxic", "language", "buckets").mapInArrow(tidy(run), "toxic int, language int, bin int")
    # At most BINS rows for each label and language.
    got = scores.groupBy("toxic", "language", "bin").count().toArrow()
    y, language, p, n = got["toxic"].to_numpy(), got["language"].to_numpy(), (got["bin"].to_numpy() + 0.5) / BINS, got["count"].to_numpy()
    thresholds = np.full(LANGUAGES, _threshold(p, y, n))
    for k in range(LANGUAGES):
        own = language == k
        if n[own & (y == 1)].sum() >= 20 and n[own & (y == 0)].sum() >= 20:
            thresholds[k] = _threshold(p[own], y[own], n[own])
    return thresholds


def _scores(net: Network, texts: list[np.ndarray]) -> np.ndarray:
    first = np.concatenate([[0], np.cumsum([len(t) for t in texts])])
    ids, begin = net.padded(np.concatenate(texts), first)
    return net.forward(ids, begin)[0]


def _labelled(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """All labelled texts outside the held-out fold, as buckets, in the shared folder."""
    known = labels.select(F.col("doc_id").cast("long").alias("id"), F.col("toxic").cast("int").alias("toxic")).where("toxic IN (0, 1) AND id IS NOT NULL")
    known = known.where(F.crc32(F.col("id").cast("string")) % 5 != 0).distinct()

    def run(batches):
        for batch in batches:
            for part, data, at in slices(batch, "text"):
                buckets, first, language = features(data, at)
                raw = [buckets[a:b].tobytes() for a, b in zip(first[:-1], first[1:])]
                yield pa.RecordBatch.from_arrays(
                    [part.column(0), part.column(1), part.column(2), pa.array(language.astype(np.int32)), pa.array(raw, pa.binary())],
                    names=["id", "toxic", "apart", "language", "buckets"],
                )

    apart = (F.pmod(F.xxhash64("id", F.lit("apart")), F.lit(4)) == 3).alias("apart")
    own = docs.where(F.crc32(F.col("doc_id").cast("string")) % 5 != 0)
    # Labels grow with the texts: they are never broadcast.
    texts = own.join(known.hint("merge"), own["doc_id"] == known["id"]).select("id", "toxic", apart, "text")
    return stored(texts.mapInArrow(tidy(run), "id long, toxic int, apart boolean, language int, buckets binary"))


def _order(ids: np.ndarray) -> np.ndarray:
    return (ids.astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15)) >> np.uint64(32)


def _predicted(rows: DataFrame, fitted: tuple[Network, np.ndarray] | None) -> DataFrame:
    """The first column of (anything, text) rows, with score and predicted."""
    model = rows.sparkSession.sparkContext.broadcast(fitted)
    release_memory()
    carried = rows.schema[0]

    def run(batches):
        fitted = model.value
        for batch in batches:
            for part, data, at in slices(batch, "text", 1 << 19):
                if fitted is None:
                    score = np.zeros(len(at) - 1)
                else:
                    net, thresholds = fitted
                    buckets, first, language = features(data, at)
                    score = bend(net.forward(*net.padded(buckets, first))[0].astype(np.float64), thresholds[language])
                yield pa.RecordBatch.from_arrays(
                    [part.column(0), pa.array(score), pa.array((score >= 0.5).astype(np.int32))], names=[carried.name, "score", "predicted"]
                )

    return rows.mapInArrow(tidy(run), StructType([carried, StructField("score", DoubleType()), StructField("predicted", IntegerType())]))


def scored(docs: DataFrame, labels: DataFrame, id: str = "doc_id", text: str = "text", toxic: int = TOXIC, clean: int = CLEAN) -> DataFrame:
    """doc_id, held_out, score and predicted of every row."""
    share_code(docs.sparkSession)
    rows = docs.select(F.col(id).cast("long").alias("doc_id"), F.col(text).cast("string").alias("text"))
    held = F.crc32(F.coalesce(F.col("doc_id").cast("string"), F.lit(""))) % 5 == 0
    return _predicted(rows, fit(rows, labels, toxic, clean)).select("doc_id", held.alias("held_out"), "score", "predicted")


def clean_rows(docs: DataFrame, labels: DataFrame, id: str = "doc_id", text: str = "text", toxic: int = TOXIC, clean: int = CLEAN) -> DataFrame:
    """The rows that aren't toxic, with all their columns and without a shuffle of texts."""
    share_code(docs.sparkSession)
    rows = docs.select(F.col(id).cast("long").alias("doc_id"), F.col(text).cast("string").alias("text"))
    carried = docs.select(F.struct("*").alias("_row"), F.col(text).cast("string").alias("text"))
    return _predicted(carried, fit(rows, labels, toxic, clean)).where("predicted = 0").select("_row.*")
