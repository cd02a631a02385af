"""Quality verdicts by a learned decision list over text statistics.

The statistics of a text come from one pass over its bytes. Sequential covering then learns an
ordered list of rules from labelled documents: a rule is grown condition by
condition (the threshold with the best information gain), pruned on held-out rows, and taken up if it is
precise enough there; what it covers is removed and the next rule is grown. The
list becomes one conditional expression of Spark columns.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass
from functools import reduce
from operator import and_

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from corpusloom.llm.common import external_key, internal_key, keyed_texts, quoted, unused, written
from corpusloom.llm.grams import SPACES, Texts, chunks, mixed, owners, span_prints, word_prints, word_windows, words_of

MIN_WORDS, MAX_REPEAT_PERCENT, REPEAT_WINDOW = 20, 30, 8
COUNTS = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "n_lines", "n_upper", "n_digits", "n_exclaims", "n_bars")
#: Bound on the labelled rows that a list is learned from; more are sampled by a hash of the id.
MAX_LABELLED = 200_000
MIN_PRECISION, MIN_COVER, MAX_RULES, MAX_CONDITIONS, THRESHOLDS = 0.97, 3, 16, 4, 64
#: Of thresholds with nearly the best gain the one that rejects least is taken.
NEARLY = 0.97


def _table(characters: bytes) -> np.ndarray:
    out = np.zeros(256, bool)
    out[list(characters)] = True
    return out


_SYMBOLS, _UPPER, _DIGITS, _EXCLAIMS, _BARS = (_table(x) for x in (b"#*$%&|<>", bytes(range(65, 91)), b"0123456789", b"!", b"|"))


def _per_text(flags: np.ndarray, texts: Texts) -> np.ndarray:
    total = np.zeros(len(flags) + 1, np.int64)
    np.cumsum(flags, out=total[1:])
    return np.diff(total[texts.offsets])


def _within(prints: np.ndarray, texts_at: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """For prints of (text, string): the group each belongs to, and the groups' sizes."""
    both = mixed(prints + mixed(texts_at.astype(np.uint64), 7))
    _, group, sizes = np.unique(both, return_inverse=True, return_counts=True)
    return group, sizes


def text_statistics(texts: Texts) -> dict[str, np.ndarray]:
    data, words = texts.data, words_of(texts)
    out = {"n_words": words.per_text.astype(np.int64)}
    in_word = ~SPACES[data]
    out["word_chars"] = _per_text(in_word & ((data & 0xC0) != 0x80), texts)
    for name, table in (("n_symbols", _SYMBOLS), ("n_upper", _UPPER), ("n_digits", _DIGITS), ("n_exclaims", _EXCLAIMS), ("n_bars", _BARS)):
        out[name] = _per_text(table[data], texts)

    # Lines with a word.
    breaks = np.flatnonzero(data == 10)
    starts = np.unique(np.concatenate([texts.offsets[:-1], breaks + 1]))
    ends = np.minimum(np.append(starts[1:], len(data)), len(data))
    starts, ends = starts[starts < len(data)], ends[starts < len(data)]
    ends = ends - (data[np.maximum(ends - 1, 0)] == 10)
    has_word = np.zeros(len(data) + 1, np.int64)
    np.cumsum(in_word, out=has_word[1:])
    full = has_word[ends] > has_word[starts] if len(starts) else np.zeros(0, bool)
    starts, ends = starts[full], ends[full]
    line_of = owners(starts, texts.offsets)
    group, sizes = _within(span_prints(texts, starts, ends), line_of)
    out["n_lines"] = np.bincount(line_of, minlength=texts.count)
    first = np.zeros(len(sizes), np.int64)
    first[group[::-1]] = line_of[::-1]
    out["n_dup_lines"] = out["n_lines"] - np.bincount(first, minlength=texts.count) if len(sizes) else out["n_lines"] * 0

    # Words in windows that occur again in the same text.
    prints, at = word_windows(word_prints(texts, words), words.offsets, REPEAT_WINDOW)
    window_of = owners(at, words.offsets)
    group, sizes = _within(prints, window_of)
    again = at[sizes[group] > 1] if len(at) else at
    change = np.zeros(len(words.starts) + 1, np.int32)
    np.add.at(change, again, 1)
    np.add.at(change, again + REPEAT_WINDOW, -1)
    total = np.zeros(len(words.starts) + 1, np.int64)
    np.cumsum(np.cumsum(change[:-1]) > 0, out=total[1:])
    out["n_repeat_words"] = np.diff(total[words.offsets])
    return {name: out[name].astype(np.int64) for name in COUNTS}


def with_counts(docs: DataFrame, text_column: str, column: str) -> DataFrame:
    """`docs` with one more column, a struct of the counts; nothing is shuffled."""
    kind = T.StructType([T.StructField(c, T.LongType()) for c in COUNTS])
    at = docs.columns.index(text_column)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            batch = batch.set_column(at, batch.schema.names[at], pc.fill_null(batch.column(at), ""))
            for part, texts in chunks(batch, at):
                got = text_statistics(texts)
                counts = pa.StructArray.from_arrays([pa.array(got[c]) for c in COUNTS], names=list(COUNTS))
                yield pa.record_batch([*part.columns, counts], names=[*part.schema.names, column])

    return docs.mapInArrow(run, T.StructType([*docs.schema.fields, T.StructField(column, kind)]))


def features(counts: str = "counts") -> dict[str, Column]:
    """What rules may test, from the struct of counts."""
    of = lambda c: F.col(f"{quoted(counts)}.{c}")
    share = lambda part, whole: of(part) / F.greatest(of(whole), F.lit(1))
    return {
        "symbol_share": share("n_symbols", "word_chars"),
        "bar_share": share("n_bars", "n_words"),
        "upper_share": share("n_upper", "word_chars"),
        "exclaim_share": share("n_exclaims", "n_words"),
        "digit_share": share("n_digits", "word_chars"),
        "repeat_share": share("n_repeat_words", "n_words"),
        "dup_line_share": share("n_dup_lines", "n_lines"),
        "mean_word_chars": share("word_chars", "n_words"),
        "words_per_line": share("n_words", "n_lines"),
    }


def base_failed(counts: str = "counts") -> Column:
    n, again = F.col(f"{quoted(counts)}.n_words"), F.col(f"{quoted(counts)}.n_repeat_words")
    return (n < MIN_WORDS) | (100 * again > MAX_REPEAT_PERCENT * n)


@dataclass(frozen=True)
class Condition:
    feature: str
    above: bool
    threshold: float

    def column(self, of: dict[str, Column]) -> Column:
        value = of[self.feature]
        return value > F.lit(self.threshold) if self.above else value <= F.lit(self.threshold)

    def holds(self, table: dict[str, np.ndarray]) -> np.ndarray:
        return table[self.feature] > self.threshold if self.above else table[self.feature] <= self.threshold


Rule = tuple[Condition, ...]


def _holds(rule: Rule, table: dict[str, np.ndarray]) -> np.ndarray:
    out = np.ones(len(next(iter(table.values()))), bool)
    for condition in rule:
        out &= condition.holds(table)
    return out


def _best_condition(table: dict[str, np.ndarray], bad: np.ndarray, inside: np.ndarray) -> Condition | None:
    """The condition with the largest gain: bad rows kept times bits won per row."""
    p0, n0 = int((bad & inside).sum()), int((~bad & inside).sum())
    base, best, found = np.log2(p0 / (p0 + n0)), 1e-9, None
    for name, values in table.items():
        here, is_bad = values[inside], bad[inside]
        cuts = np.unique(np.quantile(here[is_bad], np.linspace(0, 1, THRESHOLDS)))
        order = np.argsort(here, kind="stable")
        where = np.searchsorted(here[order], cuts, side="right")
        total_bad = np.concatenate([[0], np.cumsum(is_bad[order])])
        for above in (True, False):
            p = p0 - total_bad[where] if above else total_bad[where]
            size = len(here) - where if above else where
            with np.errstate(divide="ignore", invalid="ignore"):
                gain = np.where(p > 0, p * (np.log2(p / size) - base), 0)
            near = np.flatnonzero(gain >= NEARLY * gain.max())
            k = int(near[-1] if above else near[0])
            if gain[k] > best:
                best, found = gain[k], Condition(name, above, float(cuts[k]))
    return found


def learn(table: dict[str, np.ndarray], bad: np.ndarray, seed: int = 17, min_precision: float = MIN_PRECISION) -> list[Rule]:
    """Ordered rules for bad rows; empty without rows of both kinds."""
    rules: list[Rule] = []
    grow = np.random.default_rng(seed).random(len(bad)) < 2 / 3
    left = np.ones(len(bad), bool)
    while len(rules) < MAX_RULES:
        inside = grow & left
        if not (bad & inside).any():
            break
        rule: Rule = ()
        while len(rule) < MAX_CONDITIONS and (~bad & inside).any():
            condition = _best_condition(table, bad, inside)
            if condition is None:
                break
            rule += (condition,)
            inside &= condition.holds(table)
        held = ~grow & left

        def worth(candidate: Rule, held=held) -> tuple[float, int]:
            covers = _holds(candidate, table) & held
            p, n = int((bad & covers).sum()), int((~bad & covers).sum())
            return ((p - n) / (p + n) if p + n else -1.0, p)

        if not rule:
            break
        rule = max((rule[:k] for k in range(1, len(rule) + 1)), key=lambda r: (*worth(r), -len(r)))
        covers = _holds(rule, table)
        p, n = int((bad & covers & held).sum()), int((~bad & covers & held).sum())
        pg, ng = int((bad & covers & left).sum()), int((~bad & covers & left).sum())
        if p < MIN_COVER or p < min_precision * (p + n) or pg < min_precision * (pg + ng):
            break
        rules.append(rule)
        left &= ~covers
    return rules


def verdict(rules: list[Rule], counts: str = "counts") -> Column:
    """True for a document that no rule rejects: one conditional expression, tried in order."""
    of = features(counts)
    out = F.when(F.lit(False), F.lit(False))
    for rule in rules:
        out = out.when(reduce(and_, [c.column(of) for c in rule]), F.lit(False))
    return out.otherwise(F.lit(True))


def learn_rules(counted: DataFrame, labels: DataFrame, max_labelled: int = MAX_LABELLED, min_precision: float = MIN_PRECISION) -> list[Rule]:
    """Rules from the documents that `labels` (doc_id, quality 0 or 1) covers; null labels are skipped.

    Documents that the base rule rejects teach nothing. One with several labels counts as
    good if one of them says so.
    """
    marks = (
        labels.filter("doc_id IS NOT NULL AND quality IS NOT NULL").groupBy(internal_key("doc_id").alias("key"))
        .agg(F.max(F.col("quality").cast("int")).alias("quality"))
    )
    named = features()
    sample = (
        counted.filter(~base_failed()).join(marks, "key").select("key", "quality", *[c.alias(n) for n, c in named.items()])
        .orderBy(F.xxhash64("key"), *named).limit(max_labelled).toPandas().sort_values(["key", *named])
    )
    bad = (sample["quality"] == 0).to_numpy(bool)
    return learn({n: sample[n].to_numpy(float) for n in named}, bad, min_precision=min_precision)


def judge(docs: DataFrame, labels: DataFrame, id_column: str = "doc_id", text_column: str = "text", **settings) -> DataFrame:
    """One row per document: doc_id, the counts, base_failed and kept.

    A null text has no words and fails the base rule, like every text below 20 words. Without
    usable labels only the base rule decides. Rows repeating an id are judged one by one; an
    empty table gives no rows; other columns are not read.
    """
    counted = written(with_counts(keyed_texts(docs, id_column, text_column), "text", "counts").select("key", "counts"), "text-counts")
    rules = learn_rules(counted, labels, **settings)
    return counted.select(
        external_key("key").alias("doc_id"), "counts.*", base_failed().alias("base_failed"), (~base_failed() & verdict(rules)).alias("kept")
    )


def keep_good(docs: DataFrame, labels: DataFrame, id_column: str = "doc_id", text_column: str = "text", **settings) -> DataFrame:
    """The documents that stay, with all their columns.

    The list is learned from the counts of the labelled documents; then each row is judged where it is read. Counts alone are
    joined with the labels, so no text is shuffled.
    """
    counted = written(with_counts(keyed_texts(docs, id_column, text_column), "text", "counts").select("key", "counts"), "text-counts")
    rules = learn_rules(counted, labels, **settings)
    counts = unused(docs, "counts")
    judged = with_counts(docs, text_column, counts)
    return judged.filter(~base_failed(counts) & verdict(rules, counts)).drop(counts)
