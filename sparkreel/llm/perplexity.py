"""Quality rules: simple counts, then perplexity bands under a modified Kneser-Ney model.

The model is over character n-grams of order 4 of any script, two models a language: texts fall
into two halves by their hash (copies into the same one), and each half is judged by the model of the other, which hasn't
seen its texts. An n-gram is a 64-bit number (four 16-bit symbols), and each is counted by itself,
however many there are. Spark counts, joins discounts and contexts, and sorts the fitted model into files of about
``PART_NGRAMS`` rows: the n-grams of each order with their discounted probabilities, and their contexts
with back-off weights, looked up by binary search. A task loads the models of the languages that it meets;
of a model over ``HELD_BYTES`` it reads the files in turn. Nothing is broadcast.
A document whose perplexity lies outside its language's band is rejected.
"""

from __future__ import annotations

import io
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyarrow import fs
from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from .common import filesystem, map_rows, materialise, new_path, partitions, publish, row_schema, slices, whole_rows

#: N-grams are told apart by so many bits of a hash; by themselves, none left out, if these are as many as they have.
ORDER, BITS, HASH_BITS = 4, 16, 64
#: Rows of a model's file.
PART_NGRAMS = 1 << 20
#: Bytes of models that a task holds at a time (one model at least); any number of languages may occur.
HELD_BYTES = 256 << 20
#: Distinct n-grams that a task holds before it hands their counts on, and characters of a text taken at a time.
HELD_NGRAMS, CHUNK_CHARS = 1 << 20, 1 << 20
#: Bytes of texts scored at a time.
SLICE_BYTES = 1 << 19
#: Half widths of a band, in interquartile ranges of log10 perplexity, below and above the quartiles.
BELOW, ABOVE = 4.0, 3.0
#: The least width on either side of the quartiles (a factor of 1.05 in perplexity), where texts are few or all alike.
MIN_WIDTH = 0.02
#: Quartiles are those of log10 perplexity in steps of this size: exact counts, whatever the partitions.
GRID = 1 / 2048
MIN_WORDS, MAX_REPEATED_PERCENT = 50, 50
SYMBOLS = "#*$%&|<>"
_SPACES = " \t\n\x0b\x0c\r"
_U = np.uint64


def ngram_keys(text: str | None) -> Iterator[np.ndarray]:
    """The n-grams of a text, one for each character and one for the end, ``CHUNK_CHARS`` at a time.

    A symbol is the character's number; ASCII digits are one symbol and so is ASCII white space,
    characters beyond the basic plane share 2,048, and 0 stands for either end of the text.
    """
    text = text or ""
    tail = np.zeros(ORDER - 1, _U)
    for at in range(0, len(text) + 1, CHUNK_CHARS):
        points = np.frombuffer(text[at : at + CHUNK_CHARS].encode("utf-32-le"), "<u4")
        points = np.where((points >= 48) & (points <= 57), 48, np.where((points >= 9) & (points <= 13), 32, points))
        points = np.where(points > 0xFFFF, 0xD800 + points % 2048, points).astype(_U)
        last = at + CHUNK_CHARS > len(text)
        symbols = np.concatenate((tail, points, [0] if last else [])).astype(_U)
        keys = np.zeros(len(symbols) - ORDER + 1, _U)
        for i in range(ORDER):
            keys = keys << _U(BITS) | symbols[i : len(keys) + i]
        tail = symbols[1 - ORDER :]
        yield keys


def _low(keys: np.ndarray, n: int) -> np.ndarray:
    """The last ``n`` symbols."""
    return keys if n == ORDER else keys & _U((1 << BITS * n) - 1)


def hashed(keys: np.ndarray, n: int) -> np.ndarray:
    """Names of ``HASH_BITS`` bits of n-grams of order ``n``: the n-grams themselves, or hashes where bits are fewer."""
    if HASH_BITS == ORDER * BITS:
        return keys
    x = (keys + _U(n)) * _U(0x9E3779B97F4A7C15)
    x = (x ^ (x >> _U(32))) * _U(0xD6E8FEB86659FD93)
    return (x ^ (x >> _U(32))) >> _U(64 - HASH_BITS)


def _half(text: Column) -> Column:
    """0 or 1 for a text, by its hash."""
    return F.pmod(F.xxhash64(F.coalesce(text, F.lit("")), F.lit("half")), F.lit(2)).cast("int")


def _language(column: str):
    """The model's name: the language; "" where it is null."""
    return F.coalesce(F.col(column).cast("string"), F.lit(""))


def count_ngrams(docs: DataFrame, text_col: str = "text", lang_col: str = "lang") -> DataFrame:
    """``(lang, half, key, n)`` over all texts: how often each n-gram occurs."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        waiting: dict[tuple[str, int], list[tuple[np.ndarray, np.ndarray]]] = {}
        size = 0

        def merged(parts: list[tuple[np.ndarray, np.ndarray]]) -> tuple[np.ndarray, np.ndarray]:
            keys, place = np.unique(np.concatenate([k for k, _ in parts]), return_inverse=True)
            return keys, np.bincount(place, np.concatenate([n for _, n in parts]), len(keys)).astype(np.int64)

        def out() -> Iterator[pa.RecordBatch]:
            for (lang, half), parts in waiting.items():
                keys, n = merged(parts)
                yield pa.RecordBatch.from_arrays([pa.array([lang] * len(keys), pa.string()), pa.array(np.full(len(keys), half, np.int32)), pa.array(keys.view(np.int64)), pa.array(n)], ["lang", "half", "key", "n"])
            waiting.clear()

        for batch in batches:
            for part in slices(batch, 1, SLICE_BYTES):
                langs, found = list(zip(part.column(0).to_pylist(), part.column(2).to_pylist())), {}
                for lang, text in zip(langs, part.column(1)):
                    for keys in ngram_keys(text.as_py()):
                        found.setdefault(lang, []).append(keys)
                for lang, keys in found.items():
                    own, n = np.unique(np.concatenate(keys), return_counts=True)
                    waiting.setdefault(lang, []).append((own, n))
                    size += len(own)
                if size > HELD_NGRAMS:
                    waiting = {lang: [merged(parts)] for lang, parts in waiting.items()}
                    size = sum(len(parts[0][0]) for parts in waiting.values())
                    if size > HELD_NGRAMS // 2:
                        yield from out()
                        size = 0
        yield from out()

    text = F.col(text_col).cast("string")
    rows = docs.select(_language(lang_col).alias("lang"), text.alias("text"), _half(text).alias("half"))
    return map_rows(rows, "lang string, half int, key long, n long", run).groupBy("lang", "half", "key").agg(F.sum("n").alias("n"))


def _discounts(counts: np.ndarray) -> np.ndarray:
    """D for counts 0, 1, 2 and 3 or more (Chen and Goodman), kept within (0, count)."""
    return _discounts_of(*(int(np.count_nonzero(counts == i)) for i in (1, 2, 3, 4)))


def _discounts_of(n1: int, n2: int, n3: int, n4: int) -> np.ndarray:
    """The same from how many n-grams occur once, twice, and so on."""
    y = n1 / (n1 + 2 * n2) if n1 + n2 else 0.5
    raw = [1 - 2 * y * n2 / n1 if n1 else 0.5, 2 - 3 * y * n3 / n2 if n2 else 1.0, 3 - 4 * y * n4 / n3 if n3 else 1.5]
    return np.array([0.0, *(min(max(d, 0.05), i - 0.05) for i, d in enumerate(raw, 1))])


def _found(names: np.ndarray, values: np.ndarray, keys: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Which of ``keys`` are among the sorted ``names``, and their values (else 0)."""
    if not len(names):
        return np.zeros(len(keys), bool), np.zeros(len(keys))
    at = np.minimum(np.searchsorted(names, keys), len(names) - 1)
    there = names[at] == keys
    return there, np.where(there, values[at], 0.0)


class Model:
    """For orders 1 to 4: sorted hashes of n-grams, their discounted probabilities, sorted hashes of contexts, back-off weights."""

    def __init__(self, levels: list[list[np.ndarray]]):
        self.levels = levels

    @classmethod
    def fit(cls, keys: np.ndarray, counts: np.ndarray) -> Model:
        """From n-grams of the highest order, one a hash, with their counts.

        The highest order has the counts as they are; each lower one counts distinct left neighbours.
        """
        levels = []
        for n in range(ORDER, 0, -1):
            d = _discounts(counts)[np.minimum(counts, 3)]
            context = hashed(keys >> _U(BITS), n - 1)
            contexts, at = np.unique(context, return_inverse=True)
            totals = np.bincount(at, counts, len(contexts))
            grams = hashed(keys, n)
            by = np.argsort(grams)
            levels.append([grams[by], ((counts - d) / totals[at])[by], contexts, np.bincount(at, d, len(contexts)) / totals])
            if n > 1:  # of n-grams that share a hash the least stands for all
                lower = np.unique(_low(keys, n - 1), return_counts=True)
                _, first, place = np.unique(hashed(lower[0], n - 1), return_index=True, return_inverse=True)
                keys, counts = lower[0][first], np.bincount(place, lower[1], len(first)).astype(np.int64)
        return cls(levels[::-1])

    def probability(self, keys: np.ndarray) -> np.ndarray:
        """Of the last symbol after the others, by binary search at each order from the lowest up."""
        symbols = self.symbols()
        p = np.full(len(keys), 1.0 / (symbols + 1))
        if not symbols:  # a model of no text: all symbols alike
            return np.full(len(keys), 2.0**-BITS)
        for n in range(1, ORDER + 1):
            own = _low(keys, n)
            known, weight = self.found(n, 1, hashed(own >> _U(BITS), n - 1))
            p = np.where(known, weight * p + self.found(n, 0, hashed(own, n))[1], p)
        return p

    def found(self, n: int, kind: int, keys: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Which of ``keys`` are among the n-grams (kind 0) or contexts (1) of order ``n``, and their values (else 0)."""
        return _found(*self.levels[n - 1][2 * kind : 2 * kind + 2], keys)

    def log_perplexity(self, texts: list[str | None]) -> np.ndarray:
        """Mean of -log10 p over the symbols of each text; each distinct n-gram is looked up once."""
        parts = [(i, keys) for i, text in enumerate(texts) for keys in ngram_keys(text)]
        total, count = np.zeros(len(texts)), np.zeros(len(texts))
        at = 0
        while at < len(parts):
            upto, size = at, 0
            while upto < len(parts) and (size == 0 or size + len(parts[upto][1]) <= 2 * CHUNK_CHARS):
                size += len(parts[upto][1])
                upto += 1
            distinct, place = np.unique(np.concatenate([k for _, k in parts[at:upto]]), return_inverse=True)
            values = np.log10(self.probability(distinct))[place]
            starts = np.cumsum([0] + [len(k) for _, k in parts[at : upto - 1]])
            for (i, keys), one in zip(parts[at:upto], np.add.reduceat(values, starts)):
                total[i] -= one
                count[i] += len(keys)
            at = upto
        return total / np.maximum(count, 1)

    def symbols(self) -> int:
        """Distinct symbols: n-grams of order 1."""
        return len(self.levels[0][0])

    def size(self) -> int:
        return sum(x.nbytes for level in self.levels for x in level)

    def write(self, out) -> None:
        for level in self.levels:
            for x in level:
                np.save(out, x, allow_pickle=False)

    @classmethod
    def read(cls, data: bytes) -> Model:
        file = io.BytesIO(data)
        return cls([[np.load(file, allow_pickle=False) for _ in range(4)] for _ in range(ORDER)])


class FiledModel(Model):
    """A model too large to be held: ``parts`` are its files in order, of which one is held at a time."""

    def __init__(self, files: fs.FileSystem, parts: list[tuple[tuple[int, int], str, int]]):
        self.files, self.parts, self.held = files, parts, (-1, None)

    def _part(self, i: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        if self.held[0] != i:
            self.held = (i, _read_part(self.files, self.parts[i][1]))
        return self.held[1]

    def found(self, n: int, kind: int, keys: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        code, there, values = 2 * n + kind, np.zeros(len(keys), bool), np.zeros(len(keys))
        firsts = [first for first, _, _ in self.parts]
        for i, first in enumerate(firsts):
            after = firsts[i + 1] if i + 1 < len(firsts) else (2 * ORDER + 2, 0)
            if first[0] > code or after <= (code, 0):
                continue
            mine = keys >= _U(first[1] if first[0] == code else 0)
            if after[0] == code:
                mine &= keys < _U(after[1])
            if mine.any():
                codes, names, shares = self._part(i)
                own = slice(*np.searchsorted(codes, (code, code + 1)))
                there[mine], values[mine] = _found(names[own], shares[own], keys[mine])
        return there, values

    def symbols(self) -> int:
        return sum(int(np.count_nonzero(self._part(i)[0] == 2)) for i, (first, _, _) in enumerate(self.parts) if first[0] <= 2)

    def size(self) -> int:
        return max(size for _, _, size in self.parts)


def _model_path(folder: str, lang: str, half: int) -> str:
    return f"{folder}/{xxhash.xxh3_128_hexdigest(lang.encode())}-{half}"


def _model_rows(counts: DataFrame) -> DataFrame:
    """``(lang, half, code, key, value)``: of each order n its n-grams with their discounted shares (code 2n) and contexts with their weights (2n + 1).

    Sums are of whole numbers, so values don't depend on the order of rows.
    """

    def discounts(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            d = [_discounts_of(*row)[1:] for row in zip(*(batch.column(i).to_pylist() for i in range(2, 6)))]
            d = [pa.array(x, pa.float64()) for x in zip(*d)] or [pa.array([], pa.float64())] * 3
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), *d], ["lang", "half", "d1", "d2", "d3"])

    of, grams, out = ["lang", "half"], counts.select("lang", "half", "key", F.col("n").alias("c")), []
    c, key = F.col("c"), F.col("key")
    for n in range(ORDER, 0, -1):
        seen = grams.groupBy(*of).agg(*[F.count_if(c == i).alias(f"n{i}") for i in (1, 2, 3, 4)])
        seen = map_rows(seen, "lang string, half int, d1 double, d2 double, d3 double", discounts)
        own = grams.withColumn("context", F.shiftrightunsigned(key, BITS))
        totals = own.groupBy(*of, "context").agg(F.sum("c").alias("total"), F.count_if(c == 1).alias("n1"), F.count_if(c == 2).alias("n2"), F.count_if(c > 2).alias("n3")).join(seen, of)
        held = F.col("n1") * F.col("d1") + F.col("n2") * F.col("d2") + F.col("n3") * F.col("d3")
        d = F.when(c == 1, F.col("d1")).when(c == 2, F.col("d2")).otherwise(F.col("d3"))
        out.append(own.join(totals.select(*of, "context", "total", "d1", "d2", "d3"), [*of, "context"]).select(*of, F.lit(2 * n).alias("code"), "key", ((c - d) / F.col("total")).alias("value")))
        out.append(totals.select(*of, F.lit(2 * n + 1).alias("code"), F.col("context").alias("key"), (held / F.col("total")).alias("value")))
        if n > 1:  # each lower order counts distinct left neighbours
            grams = materialise(grams.groupBy(*of, key.bitwiseAND(F.lit((1 << BITS * (n - 1)) - 1)).alias("key")).agg(F.count("*").alias("c")), "lower")
    rows = out[0]
    for more in out[1:]:
        rows = rows.union(more)
    return materialise(rows, "model-rows")


def fit_models(counts: DataFrame) -> str:
    """The folder with the models of each language's halves, sorted by ranges and written on executors.

    A file is named by the code and n-gram that it begins with; it holds ``PART_NGRAMS`` rows of one model, or what an
    Arrow batch adds to them.
    """
    folder = new_path(counts.sparkSession, "models")

    def write(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        model, waiting, size = None, [], 0

        def out() -> None:
            codes, keys, values = (np.concatenate(x) for x in zip(*waiting))
            name = f"{_model_path(folder, *model)}/{codes[0]:02d}-{keys[0]:016x}"
            publish(name, lambda f: [f.write(x) for x in _bytes_of(codes, keys, values)])

        for batch in batches:
            models = list(zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()))
            codes, keys, values = batch.column(2).to_numpy().astype(np.uint8), batch.column(3).to_numpy().view(_U), batch.column(4).to_numpy()
            cuts = [0, *(i for i in range(1, len(models)) if models[i] != models[i - 1]), len(models)]
            for a, b in zip(cuts, cuts[1:]):
                if a == b:
                    continue
                if waiting and (models[a] != model or size >= PART_NGRAMS):
                    out()
                    waiting, size = [], 0
                model = models[a]
                waiting.append((codes[a:b], keys[a:b], values[a:b]))
                size += b - a
        if waiting:
            out()
        yield pa.RecordBatch.from_arrays([pa.array([0], pa.int64())], ["n"])

    order = ["lang", "half", "code", F.col("key") < 0, "key"]  # as unsigned numbers
    rows = _model_rows(counts).select("lang", "half", "code", "key", "value").repartitionByRange(partitions(counts.sparkSession), *order).sortWithinPartitions(*order)
    map_rows(rows, "n long", write).agg(F.count("*")).collect()
    return folder


def _bytes_of(*arrays: np.ndarray) -> Iterator[bytes]:
    for x in arrays:
        data = io.BytesIO()
        np.save(data, x, allow_pickle=False)
        yield data.getvalue()


def _read_part(files: fs.FileSystem, path: str) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Codes, n-grams and values of one file."""
    with files.open_input_stream(path, compression=None) as f:
        data = io.BytesIO(f.read())
    return tuple(np.load(data, allow_pickle=False) for _ in range(3))


def load_model(folder: str, lang: str, half: int) -> Model:
    """The model of a language's half, read in full if it fits ``HELD_BYTES``; one of no text where the half has none."""
    files, path = filesystem(_model_path(folder, lang, half))
    found = files.get_file_info(fs.FileSelector(path, allow_not_found=True))
    parts = sorted(((int(f.base_name[:2]), int(f.base_name[3:], 16)), f.path, f.size) for f in found if not f.base_name.endswith(".part"))
    if sum(size for _, _, size in parts) > HELD_BYTES:
        return FiledModel(files, parts)
    nothing = (np.empty(0, np.uint8), np.empty(0, _U), np.empty(0))
    codes, keys, values = (np.concatenate(x) for x in zip(nothing, *(_read_part(files, p) for _, p, _ in parts)))
    at = np.searchsorted(codes, np.arange(2, 2 * ORDER + 3))
    by_code = [(keys[a:b], values[a:b]) for a, b in zip(at, at[1:])]
    return Model([[*by_code[2 * n], *by_code[2 * n + 1]] for n in range(ORDER)])


def base_counts(text: str | None) -> tuple[int, int, int, int, int]:
    """n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words of a whole text."""
    text = text or ""
    words = text.encode().split()  # ASCII white space only
    chars = len(text) - sum(map(text.count, _SPACES))
    lines, dups = set(), 0
    if "\n" in text:
        for line in text.split("\n"):
            if line in lines:
                dups += 1
            elif line.strip(_SPACES):
                lines.add(line)
    repeated = 0
    if len(words) > 3:
        numbers: dict[bytes, int] = {}
        ids = np.array([numbers.setdefault(w, len(numbers)) for w in words], np.int64)
        v = len(numbers)
        pair = ids[:-2] * v + ids[1:-1]
        if v >= 1 << 20:
            pair = np.unique(pair, return_inverse=True)[1]
        window = pair * v + ids[2:]
        by = np.argsort(window, kind="stable")
        same = window[by[1:]] == window[by[:-1]]
        if same.any():
            twice = np.zeros(len(window), bool)
            twice[by[1:][same]] = True
            twice[by[:-1][same]] = True
            covered = np.zeros(len(words), bool)
            for k in range(3):
                covered[k : k + len(window)] |= twice
            repeated = int(covered.sum())
    return len(words), chars, sum(map(text.count, SYMBOLS)), dups, repeated


def score_documents(docs: DataFrame, models: str, text_col: str = "text", lang_col: str = "lang", keep: list[str] | None = None) -> DataFrame:
    """Columns ``keep`` of ``docs`` (all if None) as a struct ``row``, with the model's language, a hash of the text, the counts, and log10 perplexity."""
    text = F.col(text_col).cast("string")
    rows = docs.select(whole_rows(docs, keep), _language(lang_col).alias("model_lang"), text.alias("text"), F.xxhash64(text).alias("text_hash"), _half(text).alias("half"))
    fields = ["n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        models_held: dict[tuple[str, int], Model] = {}
        for batch in batches:
            for part in slices(batch, 2, SLICE_BYTES):
                langs, texts = list(zip(part.column(1).to_pylist(), (1 - h for h in part.column(4).to_pylist()))), part.column(2).to_pylist()
                score = np.zeros(len(texts))
                for lang in sorted(set(langs)):  # a model is loaded once a slice at most
                    if lang not in models_held:
                        new = load_model(models, *lang)
                        while models_held and new.size() + sum(m.size() for m in models_held.values()) > HELD_BYTES:
                            del models_held[next(iter(models_held))]
                        models_held[lang] = new
                    at = [i for i, x in enumerate(langs) if x == lang]
                    score[at] = models_held[lang].log_perplexity([texts[i] for i in at])
                counts = [pa.array(c, pa.int64()) for c in zip(*map(base_counts, texts))]
                yield pa.RecordBatch.from_arrays([part.column(0), part.column(1), part.column(3), *counts, pa.array(score)], ["row", "model_lang", "text_hash", *fields, "log_perplexity"])

    schema = f"model_lang string, text_hash long, {', '.join(f'{f} long' for f in fields)}, log_perplexity double"
    scored = map_rows(rows, row_schema(rows, schema), run)
    return scored.withColumn("base_failed", (F.col("n_words") < MIN_WORDS) | (100 * F.col("n_repeat_words") > MAX_REPEATED_PERCENT * F.col("n_words")))


def bands(scored: DataFrame, below: float = BELOW, above: float = ABOVE) -> DataFrame:
    """``(model_lang, low, high)``: lower and upper log10 perplexity of each language, from all distinct texts that pass the base rules.

    A text counts once however many copies it has: copies share one perplexity, and a large group of
    them would close the quartiles on it. A quartile is the least step of ``GRID`` at or below which
    a quarter (three quarters) of the texts lie, from exact counts of the steps.
    """
    texts = scored.where("not base_failed").groupBy("model_lang", "text_hash").agg(F.min("log_perplexity").alias("log_perplexity"))
    steps = texts.groupBy("model_lang", F.floor(F.col("log_perplexity") / GRID).alias("step")).agg(F.count("*").alias("n"))
    by = W.partitionBy("model_lang")
    upto = F.sum("n").over(by.orderBy("step").rowsBetween(W.unboundedPreceding, W.currentRow))
    ranked = steps.withColumns({"upto": upto, "total": F.sum("n").over(by)})
    quartile = lambda q: F.min(F.when(4 * F.col("upto") >= q * F.col("total"), F.col("step"))) * GRID
    low, high = F.col("low"), F.col("high")
    width = lambda k: F.greatest(F.lit(MIN_WIDTH), k * (high - low))
    rows = ranked.groupBy("model_lang").agg(quartile(1).alias("low"), quartile(3).alias("high"))
    return materialise(rows.select("model_lang", (low - width(below)).alias("low"), (high + width(above)).alias("high")), "bands")


def judged(scored: DataFrame, limits: DataFrame) -> DataFrame:
    """``scored`` with kept: passes the base rules and lies within its language's band. Spark picks the join by the size of ``limits``."""
    inside = F.coalesce(F.col("log_perplexity").between(F.col("low"), F.col("high")), F.lit(False))
    return scored.join(limits, "model_lang", "left").withColumn("kept", ~F.col("base_failed") & inside)


def fit(docs: DataFrame, text_col: str = "text", lang_col: str = "lang") -> str:
    return fit_models(materialise(count_ngrams(docs, text_col, lang_col), "ngrams"))


def quality(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", lang_col: str = "lang") -> DataFrame:
    """``(doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed, kept, lang_model, log_perplexity)``.

    One row per document. Null and empty texts have no words and fail; null languages share
    models; where a language's other half has no text, all symbols are alike; a null doc_id keeps its row; repeated rows repeat. An empty table gives no rows.
    Extra columns are ignored.
    """
    models = fit(docs, text_col, lang_col)
    scored = materialise(score_documents(docs, models, text_col, lang_col, [id_col]), "scores")
    return judged(scored, bands(scored)).select(
        F.col("row").getField(id_col).cast("long").alias("doc_id"), "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed",
        "kept", F.col("model_lang").alias("lang_model"), "log_perplexity",
    )


def filter_documents(docs: DataFrame, text_col: str = "text", lang_col: str = "lang") -> DataFrame:
    """The rows of ``docs`` that the rules keep, as they are; rows, nulls and ties as in ``quality``.

    Scores are computed once for the bands (narrow) and once while filtering, so that no text is
    written or shuffled.
    """
    models = fit(docs, text_col, lang_col)
    limits = bands(materialise(score_documents(docs.select(text_col, lang_col), models, text_col, lang_col, [lang_col]).drop("row"), "scores"))
    scored = score_documents(docs, models, text_col, lang_col)
    return judged(scored, limits).where("kept").select("row.*")
