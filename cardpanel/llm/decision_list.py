"""Quality rules as a learned decision list.

Statistics of every whole text come from one pass over its words and bytes.
Sequential covering learns rules for rejected documents from labelled
statistics: a rule is grown condition by condition (the threshold of highest
information gain on the growing rows), pruned from its end on held-back rows, and
accepted if it covers ``SUPPORT`` rows (a third of them held back) and is precise enough on those held back; rows it covers leave, and the next rule is
grown.  The list becomes one ordered Spark CASE expression; the default keeps.

Only the fit is bounded: about ``SAMPLE`` labelled documents, drawn by id hash.

Defined results: null reads as empty; a document with fewer than 20 words, or with
more than 30 % of its words in repeated 8-word windows, fails the base rule and is
never kept; labels that are null or without a document are not used; several
labels of a document all count; without labels of both kinds no rule is learned;
repeated rows keep their rows; extra columns pass through ``filtered``.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from cardpanel.llm.tables import about, apart, small_batches
from cardpanel.llm.tokens import SPACES, windows, word_slices

SAMPLE, QUANTILES, CONDITIONS, RULES = 20_000, 64, 4, 12
#: Least precision of a rule on held-back rows, as a lower bound at CONFIDENCE standard errors (Wilson).
PRECISION, CONFIDENCE, SUPPORT = 0.8, 1.28, 10
MIN_WORDS, REPEAT_PERCENT, WINDOW = 20, 30, 8

BASE = ["n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words"]
FEATURES = ["n_words", "mean_word_chars", "symbols_per_word", "dup_line_share", "repeat_share", "upper_share", "digit_share",
            "pipe_share", "bang_share", "distinct_share", "words_per_line"]
#: Names of the statistics columns among a document's own.
PREFIX = "_llm_"

# The symbol characters.
SYMBOLS = np.zeros(256, bool)
SYMBOLS[list(b"#*$%&|<>")] = True


def _per_doc(flags: np.ndarray, offsets: np.ndarray) -> np.ndarray:
    total = np.concatenate([[0], np.cumsum(flags, dtype=np.int64)])
    return total[offsets[1:]] - total[offsets[:-1]]


def repeated_words(h: np.ndarray) -> int:
    """Words inside 8-word windows that occur at least twice in the text."""
    seen = windows(h, WINDOW)
    ordered = np.sort(seen)
    again = ordered[1:][ordered[1:] == ordered[:-1]]
    if not len(again):
        return 0
    at = np.flatnonzero(np.isin(seen, again))
    edge = np.zeros(len(h) + 1, np.int64)
    np.add.at(edge, at, 1)
    np.add.at(edge, at + WINDOW, -1)
    return int((np.cumsum(edge)[:-1] > 0).sum())


def _lines(text: bytes) -> tuple[int, int]:
    """(lines with a word, those that equal an earlier line)"""
    lines = [x for x in text.split(b"\n") if x.strip()]
    return len(lines), len(lines) - len(set(lines))


def statistics(col: pa.Array) -> dict[str, np.ndarray]:
    """Base counts and features of every text of an Arrow column."""
    parts: list[dict[str, np.ndarray]] = []
    for _, _, w in word_slices(col):
        d, o = w.data, w.offsets
        n = w.counts()
        inside = ~SPACES[d]
        lines, dups = np.array([_lines(d[o[i] : o[i + 1]].tobytes()) for i in range(w.n)], np.int64).reshape(-1, 2).T
        each = [w.hash[w.first[i] : w.first[i + 1]] for i in range(w.n)]
        repeats = np.array([repeated_words(h) for h in each], np.int64)
        distinct = np.array([len(np.unique(h)) for h in each], np.int64)
        chars = _per_doc(inside & ((d & 0xC0) != 0x80), o)
        symbols, upper = _per_doc(SYMBOLS[d], o), _per_doc((d >= 0x41) & (d <= 0x5A), o)
        digits, bangs = _per_doc((d >= 0x30) & (d <= 0x39), o), _per_doc(d == 0x21, o)
        alone = w.end - w.start == 1
        pipes = np.bincount(w.doc()[alone & (d[w.start] == 0x7C)], minlength=w.n) if len(w.start) else np.zeros(w.n)
        words, letters, rows = np.maximum(n, 1), np.maximum(chars, 1), np.maximum(lines, 1)
        parts.append({
            "n_words": n, "word_chars": chars, "n_symbols": symbols, "n_dup_lines": dups, "n_repeat_words": repeats,
            "mean_word_chars": chars / words, "symbols_per_word": symbols / words, "dup_line_share": dups / rows,
            "repeat_share": repeats / words, "upper_share": upper / letters, "digit_share": digits / letters,
            "pipe_share": pipes / words, "bang_share": bangs / words, "distinct_share": distinct / words,
            "words_per_line": n / rows,
        })
    names = [*BASE, *FEATURES[1:]]
    return {k: np.concatenate([p[k] for p in parts]) if parts else np.empty(0) for k in names}


def with_statistics(documents: DataFrame) -> DataFrame:
    """``documents`` with its statistics in ``_llm_`` columns; adds no shuffle."""
    small_batches(documents.sparkSession)
    names = documents.columns
    types = ", ".join(f"{PREFIX}{k} {'bigint' if k in BASE else 'double'}" for k in [*BASE, *FEATURES[1:]])
    at = names.index("text")

    def run(batches):
        for batch in batches:
            stats = statistics(batch.column(at))
            new = [pa.array(v.astype(np.int64 if k in BASE else np.float64)) for k, v in stats.items()]
            yield pa.RecordBatch.from_arrays([*batch.columns, *new], [*batch.schema.names, *(PREFIX + k for k in stats)])

    schema = StructType(list(documents.schema))
    for field in documents.sparkSession.createDataFrame([], types).schema:
        schema = schema.add(field)
    return documents.mapInArrow(run, schema)


@dataclass(frozen=True)
class Rule:
    """A conjunction of (feature, is_above, threshold)."""

    conditions: tuple[tuple[str, bool, float], ...]

    def covers(self, x: np.ndarray) -> np.ndarray:
        out = np.ones(len(x), bool)
        for name, above, t in self.conditions:
            v = x[:, FEATURES.index(name)]
            out &= v > t if above else v <= t
        return out

    def expression(self) -> Column:
        out = F.lit(True)
        for name, above, t in self.conditions:
            c = F.col(PREFIX + name)
            out = out & (c > t if above else c <= t)
        return out


def _grow(x: np.ndarray, y: np.ndarray, cuts: list[np.ndarray]) -> Rule:
    on, conditions = np.ones(len(y), bool), []
    while len(conditions) < CONDITIONS:
        p, n = y[on].sum(), (~y[on]).sum()
        if not p or not n:
            break
        best = (1e-9, None)
        for f, cut in enumerate(cuts):
            place = np.searchsorted(cut, x[on, f])  # v <= cut[i] holds for place <= i
            pos = np.cumsum(np.bincount(place[y[on]], minlength=len(cut) + 1))[:-1]
            neg = np.cumsum(np.bincount(place[~y[on]], minlength=len(cut) + 1))[:-1]
            for above, (a, b) in ((False, (pos, neg)), (True, (p - pos, n - neg))):
                with np.errstate(divide="ignore", invalid="ignore"):
                    gain = np.where(a > 0, a * (np.log2(a / (a + b)) - np.log2(p / (p + n))), 0.0)
                i = int(np.argmax(gain)) if len(gain) else 0
                if len(gain) and gain[i] > best[0]:
                    best = (gain[i], (FEATURES[f], above, float(cut[i])))
        if best[1] is None:
            break
        conditions.append(best[1])
        on = Rule(tuple(conditions)).covers(x)
    return Rule(tuple(conditions))


def _prune(rule: Rule, x: np.ndarray, y: np.ndarray) -> tuple[Rule, float, int]:
    """(the shortest best head of the rule, its precision on the held-back rows, rows it covers there)"""
    best = (rule, 0.0, 0, -2.0)
    for n in range(1, len(rule.conditions) + 1):
        head = Rule(rule.conditions[:n])
        on = head.covers(x)
        p, k = int((y & on).sum()), int(on.sum())
        worth = (2 * p - k) / k if k else -1.0
        if worth > best[3] + 1e-12:
            best = (head, p / k if k else 0.0, k, worth)
    return best[:3]


def least_share(share: float, n: int, z: float = CONFIDENCE) -> float:
    """Wilson's lower bound of a share seen in ``n`` rows."""
    if not n:
        return 0.0
    return float((share + z * z / (2 * n) - z * np.sqrt(share * (1 - share) / n + z * z / (4 * n * n))) / (1 + z * z / n))


def _cuts(v: np.ndarray) -> np.ndarray:
    """Thresholds midway between a quantile and the next value that occurs, so
    that rules keep a margin to the documents on either side."""
    values = np.unique(v)
    at = np.unique(np.searchsorted(values, np.quantile(v, np.linspace(0, 1, QUANTILES + 1), method="lower")))
    at = np.unique(np.concatenate([at, at - 1]))
    at = at[(at >= 0) & (at < len(values) - 1)]
    return (values[at] + values[at + 1]) / 2


def learned(x: np.ndarray, rejected: np.ndarray, precision: float = PRECISION, support: int = SUPPORT) -> list[Rule]:
    """The ordered rules for rejection; every third row is held back for pruning."""
    rules: list[Rule] = []
    if not len(x) or rejected.all() or not rejected.any():
        return rules
    back = np.arange(len(x)) % 3 == 2
    cuts = [_cuts(x[:, f]) for f in range(x.shape[1])]
    left = np.ones(len(x), bool)
    while len(rules) < RULES and rejected[left & ~back].any():
        rule = _grow(x[left & ~back], rejected[left & ~back], cuts)
        if not rule.conditions:
            break
        rule, exact, n = _prune(rule, x[left & back], rejected[left & back])
        on = left & rule.covers(x)
        if least_share(exact, n) < precision or on.sum() < support:
            break
        rules.append(rule)
        left &= ~on
    return rules


def fit(documents: DataFrame, labels: DataFrame, sample: int = SAMPLE) -> list[Rule]:
    """Rules learned from the statistics of about ``sample`` labelled documents."""
    chosen = labels.filter("quality is not null and doc_id is not null").select(F.col("doc_id").alias("_id"), "quality")
    chosen = about(chosen, "_id", sample, "quality")
    texts = documents.select("doc_id", "text").join(F.broadcast(chosen), F.col("doc_id") == F.col("_id")).drop("_id")
    rows = with_statistics(texts).select(F.xxhash64("doc_id").alias("id"), "quality", *[PREFIX + f for f in FEATURES]).toArrow()
    x = np.column_stack([rows[PREFIX + f].to_numpy().astype(float) for f in FEATURES]) if rows.num_rows else np.empty((0, len(FEATURES)))
    y, ids = rows["quality"].to_numpy() == 0, rows["id"].to_numpy()
    order = np.lexsort([*x.T, y, ids]) if len(y) else np.empty(0, int)
    return learned(x[order], y[order])


def verdict(rules: list[Rule]) -> Column:
    """The number of the first rule that holds (from 1), else null."""
    out = F.lit(None).cast("int")
    for i, rule in reversed(list(enumerate(rules, 1))):
        out = F.when(rule.expression(), F.lit(i)).otherwise(out)
    return out


def base_failed() -> Column:
    n, repeats = F.col(PREFIX + "n_words"), F.col(PREFIX + "n_repeat_words")
    return (n < MIN_WORDS) | (100 * repeats > REPEAT_PERCENT * n)


def judged(documents: DataFrame, rules: list[Rule]) -> DataFrame:
    """One row per document: doc_id, the base counts, base_failed, kept, rule."""
    stats = with_statistics(documents.select("doc_id", "text"))
    return stats.withColumns({"base_failed": base_failed(), "rule": verdict(rules)}).select(
        "doc_id", *[F.col(PREFIX + c).alias(c) for c in BASE], "base_failed", (~F.col("base_failed") & F.col("rule").isNull()).alias("kept"), "rule")


def filtered(documents: DataFrame, rules: list[Rule]) -> DataFrame:
    """``documents`` that the base rule and the list keep, all columns kept."""
    return apart(documents, lambda rows: with_statistics(rows).filter(~base_failed() & verdict(rules).isNull()))
