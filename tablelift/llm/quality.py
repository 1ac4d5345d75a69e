"""Quality rules as a learned decision list over text statistics.

Statistics of every whole text are counted in one pass. Rules are learned from labelled texts by sequential
covering: a conjunction of thresholds is grown by information gain until it covers no good text, then pruned on
texts it was not grown on, and kept if it is precise there; the texts it covers are set aside and the next rule is
grown. The ordered rules become one Spark conditional expression.

Null texts count as having no words; they, like empty ones, fail the base rule. Rows may repeat, ids may be null and
other columns are ignored. Labels that are null, or of ids without a text, are not learned from. Without labels of
both kinds the list is empty and the base rule alone decides. An empty table gives an empty result.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import LongType, StructField, StructType

from tablelift.llm.common import share_code, stored, tidy
from tablelift.llm.words import is_space, mix, slices, span_hashes, spans, windows

#: Labelled rows that rules are learned from at most, the least hashes of their ids first.
LABELLED = 20_000
#: Precision a rule needs, on all texts and on those it was not grown on; most conditions of a rule; most rules.
PRECISION, CONDITIONS, RULES = 0.95, 4, 12

WIDTH = 5
_SYMBOL, _UPPER, _DIGIT, _LETTER, _MARK = (np.zeros(256, bool) for _ in range(5))
_SYMBOL[list(b"#*$%&|<>")] = True
_UPPER[65:91] = True
_DIGIT[48:58] = True
_LETTER[65:91] = _LETTER[97:123] = _LETTER[128:] = True
_MARK[list(b"!?")] = True
_STARTS = np.ones(256, bool)  # bytes that begin a code point
_STARTS[0x80:0xC0] = False

COUNTS = ["n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "n_lines", "n_upper", "n_digits", "n_letters", "n_marks", "n_distinct", "n_bytes"]


def _per_text(flags: np.ndarray, at: np.ndarray) -> np.ndarray:
    return np.diff(np.concatenate([[0], np.cumsum(flags)])[at])


def statistics_of(data: np.ndarray, at: np.ndarray) -> dict[str, np.ndarray]:
    """Counts of every text of a slice."""
    texts = len(at) - 1
    start, end, first = spans(data, at)
    doc = np.repeat(np.arange(texts), np.diff(first))
    words = span_hashes(data, start, end)
    salt = mix(np.arange(1, texts + 1, dtype=np.uint64))

    def within(h, d):
        """How many different hashes each text has, and for each element how often its text holds it."""
        keys, inverse, n = np.unique(mix(h ^ salt[d]), return_inverse=True, return_counts=True)
        seen = np.full(len(keys), len(h))
        np.minimum.at(seen, inverse, np.arange(len(h)))
        return np.bincount(d[seen], minlength=texts) if len(h) else np.zeros(texts, np.int64), n[inverse] if len(h) else n

    grams = windows(words, WIDTH)
    covered = np.zeros(len(words) + 1, np.int64)
    inside = np.flatnonzero(doc[: len(grams)] == doc[WIDTH - 1 :]) if len(grams) else np.zeros(0, np.int64)
    if len(inside):
        again = inside[within(grams[inside], doc[inside])[1] > 1]
        np.add.at(covered, again, 1)
        np.add.at(covered, again + WIDTH, -1)
    repeat = np.cumsum(covered)[:-1] > 0 if len(words) else np.zeros(0, bool)

    breaks = np.flatnonzero(data == 10)
    line = np.unique(np.concatenate([at[:-1], breaks + 1]))
    line = line[line < len(data)]
    owner = np.searchsorted(at, line, side="right") - 1
    stop = at[owner + 1]
    if len(breaks):
        nearest = np.searchsorted(breaks, line)
        stop = np.where(nearest < len(breaks), np.minimum(stop, breaks[np.minimum(nearest, len(breaks) - 1)]), stop)
    filled = np.searchsorted(start, stop) > np.searchsorted(start, line)
    line, stop, owner = line[filled], stop[filled], owner[filled]
    lines = np.bincount(owner, minlength=texts)
    different = within(span_hashes(data, line, stop), owner)[0] if len(line) else np.zeros(texts, np.int64)

    n_words = np.diff(first)
    return {
        "n_words": n_words,
        "word_chars": _per_text(_STARTS[data] & ~is_space(data), at),
        "n_symbols": _per_text(_SYMBOL[data], at),
        "n_dup_lines": lines - different,
        "n_repeat_words": np.bincount(doc[repeat], minlength=texts) if len(doc) else np.zeros(texts, np.int64),
        "n_lines": lines,
        "n_upper": _per_text(_UPPER[data], at),
        "n_digits": _per_text(_DIGIT[data], at),
        "n_letters": _per_text(_LETTER[data] & _STARTS[data] | (data >= 0xC0), at),
        "n_marks": _per_text(_MARK[data], at),
        "n_distinct": within(words, doc)[0],
        "n_bytes": np.diff(at),
    }


def _counted(rows: DataFrame) -> DataFrame:
    """The first column of (anything, text) rows, and the counts of each text."""
    share_code(rows.sparkSession)
    carried = rows.schema[0]

    def run(batches):
        for batch in batches:
            for part, data, at in slices(batch, "text"):
                found = statistics_of(data, at)
                yield pa.RecordBatch.from_arrays([part.column(0), *(pa.array(found[c].astype(np.int64)) for c in COUNTS)], names=[carried.name, *COUNTS])

    return rows.mapInArrow(tidy(run), StructType([carried, *(StructField(c, LongType()) for c in COUNTS)]))


def statistics(docs: DataFrame, id: str = "doc_id", text: str = "text") -> DataFrame:
    """doc_id and the counts of every row."""
    return _counted(docs.select(F.col(id).cast("long").alias("doc_id"), F.col(text).cast("string").alias("text")))


def _share(a: str, b: str) -> Column:
    return F.when(F.col(b) > 0, F.col(a) / F.col(b)).otherwise(F.lit(0.0))


#: What thresholds are learned on: name and the counts it is the ratio of.
RATIOS = {
    "words": ("n_words", None), "word_length": ("word_chars", "n_words"), "symbols_per_word": ("n_symbols", "n_words"),
    "dup_lines": ("n_dup_lines", "n_lines"), "repeated": ("n_repeat_words", "n_words"), "upper": ("n_upper", "n_letters"),
    "digits": ("n_digits", "n_bytes"), "letters": ("n_letters", "n_bytes"), "marks_per_word": ("n_marks", "n_words"),
    "distinct": ("n_distinct", "n_words"), "words_per_line": ("n_words", "n_lines"),
}


def ratio(name: str) -> Column:
    a, b = RATIOS[name]
    return F.col(a).cast("double") if b is None else _share(a, b)


@dataclass(frozen=True)
class Condition:
    feature: str
    above: bool
    threshold: float

    def covers(self, x: np.ndarray, names: list[str]) -> np.ndarray:
        column = x[:, names.index(self.feature)]
        return column > self.threshold if self.above else column <= self.threshold

    def column(self) -> Column:
        return ratio(self.feature) > self.threshold if self.above else ratio(self.feature) <= self.threshold

    def __str__(self) -> str:
        return f"{self.feature} {'>' if self.above else '<='} {self.threshold:.6g}"


Rule = tuple[Condition, ...]


def _covered(rule: Rule, x: np.ndarray, names: list[str]) -> np.ndarray:
    out = np.ones(len(x), bool)
    for c in rule:
        out &= c.covers(x, names)
    return out


def _grow(x: np.ndarray, y: np.ndarray, names: list[str]) -> Rule:
    """Add the threshold of most information gain until no good text (y false) is covered."""
    rule: Rule = ()
    inside = np.ones(len(x), bool)
    while len(rule) < CONDITIONS and (~y & inside).any():
        p0, n0 = int((y & inside).sum()), int((~y & inside).sum())
        best: tuple[float, Condition] | None = None
        for f, name in enumerate(names):
            values = np.unique(x[inside & y, f])
            around = np.unique(x[inside, f])
            if len(around) < 2:
                continue
            cuts = np.unique(np.quantile(values, np.linspace(0, 1, 25)))
            for v in cuts:
                for above in (True, False):
                    side = around[around < v] if above else around[around > v]
                    if not len(side):
                        continue
                    threshold = float((side[-1] + v) / 2) if above else float((side[0] + v) / 2)
                    condition = Condition(name, above, threshold)
                    got = inside & condition.covers(x, names)
                    p, n = int((got & y).sum()), int((got & ~y).sum())
                    if p:
                        gain = p * (np.log2(p / (p + n)) - np.log2(p0 / (p0 + n0)))
                        if best is None or gain > best[0] + 1e-9:
                            best = (gain, condition)
        if best is None or best[0] <= 0:
            break
        rule = (*rule, best[1])
        inside &= best[1].covers(x, names)
    return rule


def _prune(rule: Rule, x: np.ndarray, y: np.ndarray, names: list[str]) -> Rule:
    """Shortest leading part of the rule that is worth most on texts it was not grown on."""
    def worth(r):
        got = _covered(r, x, names)
        p, n = int((got & y).sum()), int((got & ~y).sum())
        return (p - n) / (p + n) if p + n else -1.0
    return max((rule[:k] for k in range(len(rule), 0, -1)), key=lambda r: (round(worth(r), 6), -len(r)))


def learn(x: np.ndarray, y: np.ndarray, names: list[str]) -> list[Rule]:
    """Ordered rules that reject; ``y`` is true for texts to reject."""
    rules: list[Rule] = []
    left = np.ones(len(x), bool)
    held = np.arange(len(x)) % 3 == 2
    while len(rules) < RULES and (y & left & ~held).sum() >= 3:
        rule = _grow(x[left & ~held], y[left & ~held], names)
        if not rule:
            break
        rule = _prune(rule, x[left & held], y[left & held], names)
        got = _covered(rule, x, names) & left
        p, n = int((got & y).sum()), int((got & ~y).sum())
        unseen = _covered(rule, x[held & left], names)
        fine = not unseen.any() or y[held & left][unseen].mean() >= PRECISION
        if p < 3 or p / (p + n) < PRECISION or not fine:
            break
        rules.append(rule)
        left &= ~got
    return rules


def verdict(rules: list[Rule]) -> Column:
    """True where no rule rejects; rules are tried in order."""
    out = None
    for rule in rules:
        test = rule[0].column()
        for c in rule[1:]:
            test = test & c.column()
        out = F.when(test, False) if out is None else out.when(test, False)
    return F.lit(True) if out is None else out.otherwise(True)


def rules_of(counted: DataFrame, labels: DataFrame, labelled: int = LABELLED) -> list[Rule]:
    """Rules learned from at most ``labelled`` labelled rows."""
    names = list(RATIOS)
    known = labels.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("quality").cast("int").alias("quality")).where("quality IS NOT NULL AND doc_id IS NOT NULL")
    rows = (
        counted.join(known, "doc_id").select("doc_id", "quality", *[ratio(n).alias(n) for n in names])
        .orderBy(F.xxhash64("doc_id"), "doc_id", "quality", *names).limit(labelled).toArrow()
    )
    y = rows["quality"].to_numpy() == 0
    if not y.any() or y.all():
        return []
    return learn(np.column_stack([rows[n].to_numpy() for n in names]), y, names)


def _judged(counted: DataFrame, rules: list[Rule]) -> DataFrame:
    failed = (F.col("n_words") < 10) | (100 * F.col("n_repeat_words") > 20 * F.col("n_words"))
    return counted.withColumn("base_failed", failed).withColumn("kept", ~F.col("base_failed") & verdict(rules))


def judged(docs: DataFrame, labels: DataFrame, id: str = "doc_id", text: str = "text") -> DataFrame:
    """Counts, base_failed and kept of every row."""
    counted = stored(statistics(docs, id, text))
    return _judged(counted, rules_of(counted, labels))


def kept_rows(docs: DataFrame, labels: DataFrame, id: str = "doc_id", text: str = "text") -> DataFrame:
    """The rows that are kept, with all their columns and without a shuffle of texts."""
    rules = rules_of(stored(statistics(docs, id, text)), labels)
    counted = _counted(docs.select(F.struct("*").alias("_row"), F.col(text).cast("string").alias("text")))
    return _judged(counted, rules).where("kept").select("_row.*")
