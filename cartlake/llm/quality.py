"""Quality classifier: ordinal cumulative-link regression on graded ratings.

One weight vector over hashed text features is shared by all grades; ordered thresholds cut its
score into grades: P(grade <= k) = sigmoid(threshold_k - score). It gives an expected grade and
the probability of the upper grades, by which documents are selected.
"""

from __future__ import annotations

from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from cartlake.llm.common import text_of

# Labelled documents that the fit takes at most: they meet the driver as hashed features.
FIT_ROWS = 6000
BITS = 18
GRADES = 3
MIN_TAIL = 0.5
# What a slot needs to take part in the fit: labelled rows, z-score and correlation.
MIN_ROWS = 3
MIN_Z = 4.5
MIN_CORRELATION = 0.1
# Ridge penalty on weights of unit spread: many words that each know a little must not outweigh the
# few signs that know much.
DECAY = 0.03
_CACHE_WORDS = 1_000_000
# Signs that words of running text seldom have.
_SYMBOLS = frozenset("#$%&*+<=>@\\^_`|~")


def _shape(word: str) -> str:
    letters = "".join(c for c in word if c.isalpha())
    case = "-" if not letters else "U" if letters.isupper() and len(letters) > 1 else "l"
    marks = "d" if any(c.isdigit() for c in word) else ""
    symbols = "" if _SYMBOLS.isdisjoint(word) else "#"
    return f"{case}{marks}{'!' if '!' in word else ''}{symbols}"


class Features:
    """Text to sparse features, in hashed slots.

    Words without case and outer marks, and their first four and five letters, have value 1 if the
    text has them, however long it is: one bad word in a long text is as bad as in a short one.
    Shapes of words (case, digits, exclamation marks, symbols) have the root of their share. Two more tell how far lines and words repeat.
    Words are looked up in a cache of bounded size.
    """

    def __init__(self, bits: int = BITS):
        self.mask = (1 << bits) - 1
        self.cache: dict[str, tuple[int, ...]] = {}

    def slot(self, name: str) -> int:
        return xxhash.xxh32_intdigest(name.encode("utf-8", "replace")) & self.mask

    def slots(self, word: str) -> tuple[int, ...]:
        """The slot of the word's shape, then those of the word and its beginnings."""
        bare = word.strip(".,;:!?\"'()[]{}").lower()
        names = (f"s {_shape(word)}", f"w {bare}", f"4 {bare[:4]}", f"5 {bare[:5]}")
        return tuple(self.slot(n) for n in names)

    def repetition(self, text: str, different: int, words: int) -> tuple[int, int]:
        lines = [x for x in text.split("\n") if x.strip()]
        repeated = 10 * len(set(lines)) // max(1, len(lines))
        return self.slot(f"lines {repeated}"), self.slot(f"words {10 * different // words}")

    def _cached(self, word: str) -> tuple[int, ...]:
        found = self.cache.get(word)
        if found is None:
            if len(self.cache) >= _CACHE_WORDS:
                self.cache.clear()
            found = self.cache[word] = self.slots(word)
        return found

    def __call__(self, text: str) -> tuple[np.ndarray, np.ndarray]:
        """Slots (ascending, different) and values; nothing for a text without words."""
        counts = Counter(text.split())
        n = sum(counts.values())
        if not n:
            return np.zeros(0, np.int64), np.zeros(0, np.float64)
        found = np.array([self._cached(w) for w in counts], np.int64)
        share = np.fromiter(counts.values(), np.float64, len(counts)) / n
        shapes, at = np.unique(found[:, 0], return_inverse=True)
        present = np.unique(np.r_[found[:, 1:].ravel(), self.repetition(text, len(counts), n)])
        where, both = np.unique(np.r_[shapes, present], return_inverse=True)
        return where, np.bincount(both, np.r_[np.sqrt(np.bincount(at, share)), np.ones(len(present))])


def _sigmoid(x: np.ndarray) -> np.ndarray:
    return 1 / (1 + np.exp(-np.clip(x, -40, 40)))


@dataclass(frozen=True)
class OrdinalModel:
    weights: np.ndarray
    thresholds: np.ndarray
    bits: int

    def tails(self, scores: np.ndarray) -> np.ndarray:
        """P(grade >= k) for k = 1, 2, ... in columns."""
        return _sigmoid(scores[:, None] - self.thresholds[None, :])


class Scorer:
    """Scores texts as ``weights[slots] @ values`` does, looking up weighted slots only."""

    def __init__(self, model: OrdinalModel):
        self.features = Features(model.bits)
        self.weights = {int(i): float(model.weights[i]) for i in np.flatnonzero(model.weights)}
        self.cache: dict[str, tuple[int, tuple[int, ...]]] = {}

    def _cached(self, word: str) -> tuple[int, tuple[int, ...]]:
        found = self.cache.get(word)
        if found is None:
            if len(self.cache) >= _CACHE_WORDS:
                self.cache.clear()
            shape, *rest = self.features.slots(word)
            found = self.cache[word] = shape, tuple(i for i in rest if i in self.weights)
        return found

    def __call__(self, text: str) -> float | None:
        """None for a text without words."""
        counts = Counter(text.split())
        if not counts:
            return None
        n = 0
        shapes: dict[int, int] = {}
        present: set[int] = set()
        for word, count in counts.items():
            shape, weighted = self._cached(word)
            shapes[shape] = shapes.get(shape, 0) + count
            n += count
            if weighted:
                present.update(weighted)
        present.update(self.features.repetition(text, len(counts), n))
        weights = self.weights
        score = sum(weights[i] * (c / n) ** 0.5 for i, c in shapes.items() if i in weights)
        return score + sum(weights[i] for i in sorted(present) if i in weights)


def _signal(y: np.ndarray, at: np.ndarray, row: np.ndarray, grades: int, size: int) -> np.ndarray:
    """Per slot the largest correlation of its presence with a cut of the grades, and its z-score."""
    n = len(y)
    seen = np.bincount(at, minlength=size)
    spread = np.sqrt(np.maximum(seen * (1 - seen / n), 1e-9))
    best = np.zeros(size)
    for k in range(1, grades):
        above = (y >= k) - (y >= k).mean()
        best = np.maximum(best, np.abs(np.bincount(at, above[row], size)) / (max(above.std(), 1e-9) * spread))
    return np.where(seen >= MIN_ROWS, best, 0)


def fit(
    rows: list[tuple[int, np.ndarray, np.ndarray]],
    grades: int = GRADES,
    bits: int = BITS,
    rounds: int = 400,
    decay: float = 1e-4,
) -> OrdinalModel:
    """Fit weights and thresholds to ``(grade, slots, values)`` rows by accelerated gradients.

    Only slots that correlate with the grades take part (``MIN_CORRELATION`` and ``MIN_Z``), each
    scaled to the same spread, so that rare but sure words count as much as frequent ones.
    Thresholds stay ordered because their distances are exponentials. Without rows the score is
    0 and the thresholds are fixed.
    """
    size, n = 1 << bits, len(rows)
    w = np.zeros(size)
    free = np.r_[-1.0, np.zeros(grades - 2)]
    if rows:
        y = np.array([r[0] for r in rows])
        at = np.concatenate([r[1] for r in rows]).astype(np.int64)
        value = np.concatenate([r[2] for r in rows]).astype(np.float64)
        row = np.repeat(np.arange(n), [len(r[1]) for r in rows])
        chosen = _signal(y, at, row, grades, size) >= max(MIN_Z, MIN_CORRELATION * n**0.5)
        here = chosen[at]
        used, at = np.unique(at[here], return_inverse=True)
        value, row = value[here], row[here]
        spread = np.sqrt(np.bincount(at, value**2, len(used)) / n)
        x = value / spread[at]
        # The largest curvature bounds the step.
        u, steep = np.ones(len(used)), 0.0
        for _ in range(15):
            u = np.bincount(at, x * np.bincount(row, x * u[at], n)[row], len(used)) / n
            steep = float(np.linalg.norm(u))
            u = u / max(steep, 1e-12)
        step = 1 / (0.3 * steep + decay + 1)
        v, old_v, old_free, t = np.zeros(len(used)), np.zeros(len(used)), free, 1.0
        for _ in range(rounds):
            following = (1 + (1 + 4 * t * t) ** 0.5) / 2
            ahead = (t - 1) / following
            t = following
            now_v, now_free = v + ahead * (v - old_v), free + ahead * (free - old_free)
            old_v, old_free = v, free
            cuts = np.cumsum(np.r_[now_free[0], np.exp(now_free[1:])])
            score = np.bincount(row, x * now_v[at], n)
            edges = np.r_[-np.inf, cuts, np.inf]
            high, low = _sigmoid(edges[y + 1] - score), _sigmoid(edges[y] - score)
            p = np.maximum(high - low, 1e-9)
            from_high, from_low = high * (1 - high) / p / n, low * (1 - low) / p / n
            slope = np.bincount(at, x * (from_high - from_low)[row], len(used)) + decay * now_v
            per_cut = [from_low[y == k + 1].sum() - from_high[y == k].sum() for k in range(grades - 1)]
            above = np.cumsum(per_cut[::-1])[::-1]
            v = now_v - step * slope
            free = now_free - step * np.r_[above[0], above[1:] * np.exp(now_free[1:])]
        w[used] = v / spread
    return OrdinalModel(w.astype(np.float32), np.cumsum(np.r_[free[0], np.exp(free[1:])]), bits)


def grade_of(quality: str = "quality", toxic: str = "toxic") -> Column:
    """0 for toxic text, 1 for other bad text, 2 for good text; NULL if a rating is missing.

    What is toxic can pile up without bound, so it belongs at the end of the scale.
    """
    q, t = F.col(quality), F.col(toxic)
    return F.when(q.isNotNull() & t.isNotNull(), F.when(t >= 1, 0).when(q < 1, 1).otherwise(2))


def _arrow_features(bits: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        features = Features(bits)
        for batch in batches:
            found = [features(t) for t in batch.column(1).to_pylist()]
            slots = pa.array([a.astype("<i4").tobytes() for a, _ in found], pa.binary())
            values = pa.array([b.astype("<f4").tobytes() for _, b in found], pa.binary())
            yield pa.RecordBatch.from_arrays([batch.column(0), slots, values], ["grade", "slots", "values"])

    return run


def fit_quality(
    docs: DataFrame,
    labels: DataFrame,
    fit_rows: int = FIT_ROWS,
    bits: int = BITS,
    id_col: str = "doc_id",
    text_col: str = "text",
) -> OrdinalModel:
    """Fit on ``fit_rows`` labelled documents at most, those with the least hash of their id.

    Labels with a missing rating and labels without a document are left out. A document with
    several labels takes part with each.
    """
    rated = labels.select(F.col("doc_id").alias("id"), grade_of().alias("grade")).dropna()
    sample = rated.orderBy(F.xxhash64("id"), "id", "grade").limit(fit_rows)
    texts = docs.select(F.col(f"`{id_col}`").alias("id"), text_of(text_col).alias("text"))
    # The hint is bounded by fit_rows.
    labelled = texts.join(F.broadcast(sample), "id").select("grade", "text")
    schema = "grade int, slots binary, values binary"
    rows = labelled.mapInArrow(_arrow_features(bits), schema).collect()
    rows.sort(key=lambda r: (r.grade, bytes(r.slots), bytes(r["values"])))
    pairs = [(r.grade, np.frombuffer(r.slots, "<i4"), np.frombuffer(r["values"], "<f4")) for r in rows]
    return fit(pairs, bits=bits, decay=DECAY)


def grade_documents(
    docs: DataFrame,
    model: OrdinalModel,
    min_tail: float = MIN_TAIL,
    id_col: str = "doc_id",
    text_col: str = "text",
) -> DataFrame:
    """``docs`` with ``expected_grade``, ``tail_probability``, ``grade`` and ``kept``.

    The expected grade is the sum of the probabilities of grade 1, 2, ... or above; the tail
    probability is that of the highest grade, and ``kept`` holds where it reaches ``min_tail``.
    NULL texts and texts without a word get grade 0 and probability 0. Columns of these names
    are replaced; all others, the id included, pass through. Empty tables give no rows.
    """
    added = ("expected_grade", "tail_probability", "grade", "kept")
    docs = docs.drop(*added)
    shared = docs.sparkSession.sparkContext.broadcast(model)
    texts = docs.columns.index(text_col)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        model = shared.value
        score = Scorer(model)
        for batch in batches:
            tails = np.zeros((batch.num_rows, len(model.thresholds)))
            for i, text in enumerate(batch.column(texts)):
                found = score(text.as_py() or "")
                if found is not None:
                    tails[i] = model.tails(np.array([found]))[0]
            p = -np.diff(np.c_[np.ones(len(tails)), tails, np.zeros(len(tails))], axis=1)
            out = [tails.sum(1), tails[:, -1], p.argmax(1).astype(np.int32), tails[:, -1] >= min_tail]
            yield pa.RecordBatch.from_arrays(
                [*batch.columns, *map(pa.array, out)], names=[*batch.schema.names, *added]
            )

    schema = docs.select(
        "*",
        *(F.lit(v).cast(t).alias(n) for n, v, t in zip(added, (0, 0, 0, True), ("double", "double", "int", "boolean"))),
    ).schema
    return docs.mapInArrow(run, schema)
