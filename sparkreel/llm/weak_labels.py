"""A quality classifier without labels.

Overlapping heuristic labellers vote good, bad or nothing on every document, by counts of its
characters and words. Expectation maximisation over the counts of vote patterns (at most
4 ** labellers of them, whatever the corpus) estimates each labeller's accuracies, abstentions included. The posterior
labels train a linear scorer on hashed words, word pairs and character trigrams, none of which the
labellers see, and the scorer then judges every document by its content.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import map_rows, row_schema, slices, split_words, whole_rows

DIMS = 1 << 14
#: The scorer is fitted on a sample of about so many posterior-labelled distinct texts, chosen by
#: hash. The labellers' accuracies come from all documents, and all are scored.
TRAIN_ROWS = 4_000
THRESHOLD = 0.5
#: The step of the scorer's fit.
RATE = 0.3
#: Words in a window of the share of distinct words, and bytes of texts taken at a time.
WINDOW, SLICE_BYTES = 100, 1 << 19
#: Training texts whose numbers are unfolded at a time.
TRAIN_SLICE = 256

#: Common words of the corpus languages (English, German, French, Spanish).
COMMON = sorted(
    set(
        "the of and to in a is that it for on was as with be by this are or from at an he not have "
        "der die und das den von zu mit sich des auf ein eine nicht dem ist "
        "de la le et les des en un une que est pour du dans qui par il "
        "el y los del las por con para se lo como su".split()
    )
)
_TERMINALS = ".,;:!?"
_LETTER, _CAPITAL, _SYMBOL = 1, 2, 4


def _byte_kinds() -> np.ndarray:
    """Flags of each byte: part of a letter (bytes that lead a character beyond ASCII count as one), capital, symbol."""
    kinds = np.zeros(256, np.uint8)
    kinds[[*range(65, 91), *range(97, 123), *range(0xC3, 0x100)]] |= _LETTER
    kinds[65:91] |= _CAPITAL
    kinds[[ord(c) for c in "#*$%&|<>"]] |= _SYMBOL
    return kinds


_KINDS = _byte_kinds()
STATISTICS = ("words", "symbols", "repeats", "distinct", "capitals", "common", "shouts", "wordless", "terminals")


def _per_text(flags: np.ndarray, bounds: np.ndarray) -> np.ndarray:
    """Sums of ``flags`` over the runs between ``bounds``."""
    return np.diff(np.concatenate(([0], np.cumsum(flags, dtype=np.float64)))[bounds])


class Texts:
    """Some texts as bytes and as numbered words: what labellers and scorer are computed from."""

    def __init__(self, texts: pa.Array):
        texts = texts.fill_null("")
        self.bounds, self.codes, self.distinct = split_words(texts)
        at = np.frombuffer(texts.buffers()[1], np.int32)[texts.offset : texts.offset + len(texts) + 1].astype(np.int64)
        self.bytes = np.frombuffer(texts.buffers()[2] or b"", np.uint8)[at[0] : at[-1]]
        self.byte_bounds = at - at[0]

    def statistics(self) -> dict[str, np.ndarray]:
        """Numbers of each text for the labellers, all but ``words`` rates that hold at any length."""
        n = np.diff(self.bounds)
        per_word = lambda flag: _per_text(flag.to_numpy(zero_copy_only=False)[self.codes], self.bounds) / np.maximum(n, 1)
        word = self.distinct
        bare = pc.ascii_rtrim(pc.ascii_lower(word), characters=_TERMINALS)
        kinds = _KINDS[self.bytes]
        count = lambda kind: _per_text((kinds & kind) > 0, self.byte_bounds)
        same = np.zeros(len(self.codes), bool)
        same[1:] = self.codes[1:] == self.codes[:-1]
        starts = self.bounds[:-1][n > 0]
        same[starts] = False
        text = np.repeat(np.arange(len(n)), n)
        window = (np.arange(len(self.codes)) - np.repeat(self.bounds[:-1], n)) // WINDOW
        most = int(window.max(initial=0)) + 1
        seen = np.unique((text * most + window) * max(1, len(word)) + self.codes)
        own = np.bincount(seen // max(1, len(word)) // most, minlength=len(n))
        return {
            "words": n.astype(float),
            "symbols": count(_SYMBOL) / np.maximum(n, 1),
            "repeats": _per_text(same, self.bounds) / np.maximum(n, 1),
            "distinct": own / np.maximum(n, 1),
            "capitals": count(_CAPITAL) / np.maximum(count(_LETTER), 1),
            "common": per_word(pc.is_in(bare, value_set=pa.array(COMMON))),
            "shouts": per_word(pc.or_(pc.ends_with(word, "!!"), pc.ends_with(word, "|"))),
            "wordless": per_word(pc.invert(pc.match_substring_regex(word, r"\pL"))),
            "terminals": per_word(pc.is_in(pc.utf8_slice_codeunits(word, -1), value_set=pa.array(list(_TERMINALS)))),
        }

    def slots(self) -> list[tuple[np.ndarray, np.ndarray]]:
        """Hashed features in order of place, with the bounds of the texts among them: words, pairs of words, character trigrams (of bytes)."""
        spread = lambda x: ((x * np.uint64(0x9E3779B97F4A7C15)) >> np.uint64(64 - DIMS.bit_length() + 1)).astype(np.int64)
        names = np.array([xxhash.xxh64_intdigest(w) for w in pc.ascii_lower(self.distinct).to_pylist()], np.uint64)
        word = names[self.codes]
        pairs = (word[:-1] * np.uint64(3) + (word[1:] ^ np.uint64(0x5851F42D4C957F2D))) if len(word) else word
        inside = np.ones(len(pairs), bool)
        last = self.bounds[1:-1]
        inside[last[(last > 0) & (last < len(word))] - 1] = False  # no pair over two texts
        b = self.bytes.astype(np.uint64)
        grams = b[:-2] | b[1:-1] << np.uint64(8) | b[2:] << np.uint64(16) | np.uint64(1 << 40)
        whole = np.ones(len(grams), bool)
        for back in (1, 2):
            at = self.byte_bounds[1:-1] - back
            whole[at[(at >= 0) & (at < len(grams))]] = False  # nor a trigram
        out = []
        for x, real, bounds in ((word, None, self.bounds), (pairs, inside, self.bounds), (grams, whole, self.byte_bounds)):
            if real is not None:
                places = np.concatenate(([0], np.cumsum(real)))
                x, bounds = x[real], places[np.minimum(bounds, len(real))]
            out.append((spread(x), bounds))
        return out

    def vectors(self) -> list[tuple[np.ndarray, np.ndarray]]:
        """For each text its slots and values: the mean share of a slot among words, among pairs and among trigrams."""
        out = []
        kinds = self.slots()
        for i in range(len(self.bounds) - 1):
            total = np.zeros(DIMS)
            for slots, bounds in kinds:
                own = slots[bounds[i] : bounds[i + 1]]
                total += np.bincount(own, minlength=DIMS) / max(1, len(own))
            at = np.flatnonzero(total)
            out.append((at.astype("<u2"), total[at].astype("<f4")))
        return out

    def scores(self, weights: np.ndarray) -> np.ndarray:
        """The scorer's chance that each text is good."""
        z = np.full(len(self.bounds) - 1, weights[-1])
        for slots, bounds in self.slots():
            z += _per_text(weights[:-1][slots], bounds) / np.maximum(np.diff(bounds), 1)
        return 1 / (1 + np.exp(-np.clip(z, -700, 700)))


#: Each labeller: the words it needs to vote, its statistic, and the ranges it votes good and bad in.
#: One that knows a single kind of junk has no good range: not to see its kind says little.
LABELLERS = (
    (3, "symbols", None, (0.2, 1e9)),
    (8, "repeats", None, (0.06, 1)),
    (3, "capitals", None, (0.5, 1)),
    (5, "shouts", None, (0.25, 1)),
    (20, "common", (0.1, 1), (0, 0.03)),
    (30, "distinct", (0.5, 1), (0, 0.2)),
    (5, "wordless", None, (0.35, 1)),
    (30, "terminals", (0.02, 0.4), (0.6, 1)),
)


def votes(stats: dict[str, np.ndarray]) -> np.ndarray:
    """A column for each labeller: 1 good, 0 bad, 2 no vote, 3 too short a text for one."""
    out = np.full((len(stats["words"]), len(LABELLERS)), 3)
    for k, (least, name, good, bad) in enumerate(LABELLERS):
        x, enough = stats[name], stats["words"] >= least
        out[enough, k] = 2
        out[enough & (x >= bad[0]) & (x <= bad[1]), k] = 0
        if good:
            out[enough & (x >= good[0]) & (x <= good[1]), k] = 1
    return out


def patterns(rows: np.ndarray) -> list[str]:
    return ["".join(map(str, r)) for r in rows.tolist()]


def fit_labellers(counted: dict[str, int], rounds: int = 200) -> tuple[np.ndarray, float]:
    """How often each labeller votes bad, good or nothing on bad and on good documents (class, labeller, vote), and the share of good ones, by EM.

    Every vote and every abstention of a labeller that could vote counts as evidence. EM starts from documents being bad where any
    labeller says so. Without documents the share is one half.
    """
    keys = sorted(counted)
    v = np.array([[int(c) for c in k] for k in keys], np.int64).reshape(len(keys), len(keys[0]) if keys else len(LABELLERS))
    weight = np.array([counted[k] for k in keys], float)
    cast = np.stack([v == x for x in range(3)], axis=2).astype(float)
    p = np.where((v == 0).any(axis=1), 0.1, 0.9)
    rates, prior = np.full((2, v.shape[1], 3), 1 / 3), 0.5
    for _ in range(rounds):
        shares = np.stack((weight * (1 - p), weight * p))
        now = np.einsum("cd,dlv->clv", shares, cast) + 0.1
        now /= now.sum(axis=2, keepdims=True)
        prior = float((shares[1].sum() + 1) / (weight.sum() + 2))
        p = _posterior(v, now, prior)
        moved, rates = np.abs(now - rates).max(), now
        if moved < 1e-9:
            break
    return rates, prior


def accuracies(rates: np.ndarray) -> np.ndarray:
    """Of the votes a labeller casts on bad and on good documents, the share that is right."""
    return np.stack([rates[c, :, c] / rates[c, :, :2].sum(axis=1) for c in (0, 1)])


def _posterior(v: np.ndarray, rates: np.ndarray, prior: float) -> np.ndarray:
    logs = np.concatenate((np.log(rates), np.zeros((*rates.shape[:2], 1))), axis=2)  # 3 says nothing
    bad, good = (logs[c][np.arange(v.shape[1]), v].sum(axis=1) for c in (0, 1))
    return 1 / (1 + np.exp(np.clip(bad - good + np.log(1 - prior) - np.log(prior), -700, 700)))


def posterior(pattern: str, rates: np.ndarray, prior: float) -> float:
    """The chance that a document with these votes is good."""
    return float(_posterior(np.array([[int(c) for c in pattern]]), rates, prior)[0])


def fit_scorer(vectors: list[tuple[np.ndarray, np.ndarray]], labels: np.ndarray, rounds: int = 150, penalty: float = 1e-6) -> np.ndarray:
    """Weights of a logistic regression on soft labels (the last is the constant), by Adam on all rows."""
    w = np.zeros(DIMS + 1)
    if not vectors:
        return w
    share = float(np.clip(labels.mean(), 0.02, 0.98))
    weight = labels / share + (1 - labels) / (1 - share)  # both classes count alike
    weight /= weight.sum()
    m = s = np.zeros(DIMS + 1)
    for t in range(1, rounds + 1):
        g = penalty * w
        for at in range(0, len(vectors), TRAIN_SLICE):  # the vectors stay as they came, as whole columns of 64 bits they take several times the room
            part, own = vectors[at : at + TRAIN_SLICE], slice(at, at + TRAIN_SLICE)
            row = np.repeat(np.arange(len(part)), [len(s) for s, _ in part])
            col, val = np.concatenate([s for s, _ in part]).astype(np.int64), np.concatenate([v for _, v in part])
            z = np.bincount(row, val * w[col], len(part)) + w[-1]
            error = (1 / (1 + np.exp(-z)) - labels[own]) * weight[own]
            g[:-1] += np.bincount(col, val * error[row], DIMS)
            g[-1] += error.sum()
        m, s = 0.9 * m + 0.1 * g, 0.999 * s + 0.001 * g * g
        w = w - RATE * (m / (1 - 0.9**t)) / (np.sqrt(s / (1 - 0.999**t)) + 1e-8)
    return w


def vote_patterns(docs: DataFrame, text_col: str = "text") -> dict[str, int]:
    """How many documents there are of each vote pattern, over all of them."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counts: dict[str, int] = {}
        for batch in batches:
            for part in slices(batch, 0, SLICE_BYTES):
                found, n = np.unique(votes(Texts(part.column(0)).statistics()), axis=0, return_counts=True)
                for key, times in zip(patterns(found), n.tolist()):
                    counts[key] = counts.get(key, 0) + times
        yield pa.RecordBatch.from_arrays([pa.array(counts.keys(), pa.string()), pa.array(counts.values(), pa.int64())], ["pattern", "n"])

    counted = map_rows(docs.select(F.col(text_col).cast("string")), "pattern string, n long", run)
    return {r[0]: r[1] for r in counted.groupBy("pattern").agg(F.sum("n")).collect()}  # 4 ** 8 rows at most


def fit(docs: DataFrame, text_col: str = "text", train_rows: int = TRAIN_ROWS) -> tuple[np.ndarray, np.ndarray, float]:
    """The scorer's weights, the labellers' accuracies, and the share of good documents.

    The sample is of distinct texts and goes by their hash, and the driver sorts it by that, so
    neither copies nor partitions matter. Its features are made where the texts are.
    """
    counted = vote_patterns(docs, text_col)
    rates, prior = fit_labellers(counted)
    every = 1 << 30
    draw = F.pmod(F.xxhash64(F.col(text_col).cast("string"), F.lit("sample")), F.lit(every))
    part = docs.where(draw < int(every * min(1.0, train_rows / max(1, sum(counted.values()))))).select(F.col(text_col).cast("string").alias("text")).distinct()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in slices(batch, 1, SLICE_BYTES):
                texts = Texts(part.column(1))
                vectors = texts.vectors()
                columns = [pa.array([s.tobytes() for s, _ in vectors], pa.binary()), pa.array([v.tobytes() for _, v in vectors], pa.binary()), pa.array(patterns(votes(texts.statistics())), pa.string())]
                yield pa.RecordBatch.from_arrays([part.column(0), *columns], ["h", "slots", "vals", "pattern"])

    sample = map_rows(part.select(F.xxhash64("text").alias("h"), "text"), "h long, slots binary, vals binary, pattern string", run)
    rows = sorted(sample.toArrow().to_pylist(), key=lambda r: (r["h"], r["slots"]))  # train_rows, about, of DIMS numbers at most
    labels = np.array([posterior(r["pattern"], rates, prior) for r in rows])
    return fit_scorer([(np.frombuffer(r["slots"], "<u2"), np.frombuffer(r["vals"], "<f4")) for r in rows], labels), rates, prior


def score_documents(docs: DataFrame, weights: np.ndarray, rates: np.ndarray, prior: float, text_col: str = "text", keep: list[str] | None = None) -> DataFrame:
    """Columns ``keep`` (all if None) as a struct ``row``, with ``score`` and ``weak_posterior``."""
    rows = docs.select(whole_rows(docs, keep), F.col(text_col).cast("string").alias("text"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in slices(batch, 1, SLICE_BYTES):
                texts = Texts(part.column(1))
                found, at = np.unique(votes(texts.statistics()), axis=0, return_inverse=True)
                chances = _posterior(found, rates, prior)[at.ravel()]
                yield pa.RecordBatch.from_arrays([part.column(0), pa.array(texts.scores(weights)), pa.array(chances)], ["row", "score", "weak_posterior"])

    return map_rows(rows, row_schema(rows, "score double, weak_posterior double"), run)


def classify(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", threshold: float = THRESHOLD) -> DataFrame:
    """``(doc_id, score, weak_posterior, kept)``, one row per document; kept: score >= threshold.

    Null and empty texts get no votes and are scored by the constant. A null doc_id keeps its row,
    repeated rows repeat and score alike, extra columns are ignored, an empty table gives no rows.
    """
    scored = score_documents(docs, *fit(docs, text_col), text_col, [id_col])
    return scored.select(F.col("row").getField(id_col).cast("long").alias("doc_id"), "score", "weak_posterior", (F.col("score") >= threshold).alias("kept"))


def filter_documents(docs: DataFrame, text_col: str = "text", threshold: float = THRESHOLD) -> DataFrame:
    """The rows of ``docs`` that the scorer keeps, as they are, nulls, ties and repeated rows as in ``classify``."""
    return score_documents(docs, *fit(docs, text_col), text_col).where(F.col("score") >= threshold).select("row.*")
