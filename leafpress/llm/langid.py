"""Language identification by interpolated Kneser-Ney character models, one per language.

Models see a word as its letters in lower case between two blanks.  Each order keeps its n-grams as a sorted array of
64-bit hashes beside the fully interpolated probabilities, and its contexts likewise beside their back-off weights.
"""

from __future__ import annotations

import math
import pickle
import re
import uuid
from collections.abc import Iterable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from leafpress.llm.interning import WORD_LIMIT, Spans, WordTable, remembered, runs, text_bytes, text_chunks

ORDER = 5
#: Labelled rows drawn per language at most; one in so many of them is held back to calibrate rejection.
FIT_ROWS, HELD_BACK = 1200, 6
#: Share of labelled calibration rows that the rejection limit lets pass before its margin, and the margin in bits a character.
CALIBRATION_SHARE, MARGIN_BITS = 0.995, 0.75
_WORD = re.compile(r"[^\W\d_]+")
_MUL = np.uint64(0x9E3779B97F4A7C15)
#: Bytes of one worker's remembered entropies; bounds how many words are remembered, never results.
MEMORY = 48_000_000
UNKNOWN = "und"


def _hashes(points: np.ndarray, n: int) -> np.ndarray:
    """Hash of the ``n`` code points that end at each position from n-1 on."""
    out = np.full(max(0, len(points) - n + 1), n, np.uint64)
    for k in range(n):
        out = (out ^ (out >> np.uint64(30))) * _MUL + points[k : len(points) - n + 1 + k] + np.uint64(1)
    return out ^ (out >> np.uint64(32))


def _points(words: list[str]) -> tuple[np.ndarray, np.ndarray]:
    """Code points of all words, each after a blank, with a last blank; and each position's place in its word."""
    text = " " + " ".join(words) + " " if words else ""
    points = np.frombuffer(text.encode("utf-32-le"), np.uint32).astype(np.uint64)
    blanks = np.flatnonzero(points == 32)
    return points, np.arange(len(points)) - np.repeat(blanks, np.diff(np.append(blanks, len(points))))


def _grams(words: list[str], weights: np.ndarray) -> list[tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]]:
    """For n = 1 to ORDER: hashes, hashes of their contexts and of their tails, and weights, of the n-grams inside ' word '."""
    points, place = _points(words)
    word_of = np.cumsum(points == 32) - 1
    out = []
    for n in range(1, ORDER + 1):
        end = np.arange(n - 1, len(points))
        # the blank that ends a word is the next one's first: it counts with the word before it
        at_end = points[end] == 32
        depth = np.where(at_end, np.append(0, place[:-1])[end] + 1, place[end])
        good = (depth >= n - 1) & (end > 0)
        owner = np.where(at_end, word_of[end] - 1, word_of[end])[good]
        gram = _hashes(points, n)[good]
        context = _hashes(points, n - 1)[:-1][good[: len(points) - n + 1]] if n > 1 else np.zeros(len(gram), np.uint64)
        tail = _hashes(points, n - 1)[1:][good] if n > 1 else np.zeros(len(gram), np.uint64)
        out.append((gram, context, tail, weights[owner]))
    return out


@dataclass
class CharModel:
    grams: list[np.ndarray]  # sorted hashes by order
    probabilities: list[np.ndarray]
    contexts: list[np.ndarray]  # sorted hashes by order, without order 1
    backoffs: list[np.ndarray]
    floor: float  # of a character never seen

    @staticmethod
    def fit(words: list[str], weights: np.ndarray) -> CharModel:
        """Absolute discounts by n1 / (n1 + 2 n2); lower orders count distinct predecessors."""
        tables = []
        for gram, context, tail, weight in _grams(words, weights):
            keys, first, inverse = np.unique(gram, return_index=True, return_inverse=True)
            tables.append((keys, context[first], tail[first], np.bincount(inverse, weight, len(keys))))
        model = CharModel([], [], [], [], 0.0)
        lower = None
        for n in range(1, ORDER + 1):
            keys, context, tail, count = tables[n - 1]
            if n < ORDER and len(tables[n][0]):
                # grams at the start of a word have no predecessor, and keep their count
                followed, predecessors = np.unique(tables[n][2], return_counts=True)
                at = np.minimum(np.searchsorted(followed, keys), len(followed) - 1)
                count = np.where(followed[at] == keys, predecessors[at], count).astype(float)
            ones, twos = (count == 1).sum(), (count == 2).sum()
            discount = min(0.95, max(0.1, ones / max(1, ones + 2 * twos)))
            heads, inverse = np.unique(context, return_inverse=True)
            total, kinds = np.bincount(inverse, count, len(heads)), np.bincount(inverse, minlength=len(heads))
            weight = discount * kinds / total
            if n == 1:
                model.floor = float(weight[0] / (len(keys) + 1)) if len(keys) else 1e-6
                probability = (count - discount) / total[inverse] + model.floor
            else:
                probability = (count - discount) / total[inverse] + weight[inverse] * lower[np.searchsorted(model.grams[-1], tail)]
                model.contexts.append(heads)
                model.backoffs.append(weight)
            model.grams.append(keys)
            model.probabilities.append(probability)
            lower = probability
        return model


@dataclass
class LanguageModels:
    languages: list[str]
    models: list[CharModel]
    limits: np.ndarray  # cross-entropy above which a language is rejected
    key: str = ""

    def merge(self) -> None:
        """One sorted array of n-gram hashes an order for all languages, with a column a language; NaN where it has none."""
        self.keys, self.values, self.weights = [], [], []
        for n in range(ORDER if self.models else 0):
            contexts = [(m.contexts[n], m.backoffs[n]) if n + 1 < ORDER else (m.grams[n][:0], m.floor) for m in self.models]
            keys = np.unique(np.concatenate([*(m.grams[n] for m in self.models), *(c for c, _ in contexts)]))
            values, weights = (np.full((len(keys), len(self.models)), np.nan, np.float32) for _ in range(2))
            for k, m in enumerate(self.models):
                values[np.searchsorted(keys, m.grams[n]), k] = m.probabilities[n]
                if len(contexts[k][0]):
                    weights[np.searchsorted(keys, contexts[k][0]), k] = contexts[k][1]
            self.keys.append(keys)
            self.values.append(values)
            self.weights.append(weights)

    def words(self, words: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """log2 probability of each word's letters and closing blank by language; how many characters these are.

        From order 1 up, an n-gram's own probability replaces the lower order's, which is else scaled by the back-off
        weight of its context, if the model knows that.
        """
        points, place = _points(words)
        depth = np.where(points == 32, np.append(0, place[:-1]) + 1, place)
        p = np.empty((len(points), len(self.models)), np.float32)
        p[:] = [m.floor for m in self.models]
        scale = None
        for n in range(1, ORDER + 1):
            keys = self.keys[n - 1]
            hashes = _hashes(points, n)
            at = np.minimum(np.searchsorted(keys, hashes), len(keys) - 1)
            known = keys[at] == hashes
            values = np.where(known[:, None], self.values[n - 1][at], np.float32(np.nan))
            good = (depth[n - 1 :] >= n - 1) & (np.arange(n - 1, len(points)) > 0)
            below = p[n - 1 :]
            if scale is not None:
                below = np.where(np.isnan(scale[:-1]), below, scale[:-1] * below)
            p[n - 1 :] = np.where(good[:, None], np.where(np.isnan(values), below, values), p[n - 1 :])
            scale = np.where(known[:, None], self.weights[n - 1][at], np.float32(np.nan))
        word = np.cumsum(points == 32) - 1
        word = np.where(points == 32, word - 1, word)[1:]
        logs = np.log2(p[1:].astype(np.float64))
        bits = np.stack([np.bincount(word, logs[:, k], len(words)) for k in range(len(self.models))], axis=1)
        return bits, np.array([len(w) + 1 for w in words])

    def table(self) -> WordTable:
        """This worker's memory of words, bounded by bytes."""

        def make() -> WordTable:
            self.merge()
            return WordTable(self._learn, max(1000, min(WORD_LIMIT, MEMORY // (4 * len(self.models) + 30))))

        return remembered(("languages", self.key), make)

    def _learn(self, words: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
        bits, chars = self.words([w.decode() for w in words])
        return bits.astype(np.float32), chars.astype(np.int32)

    def entropies(self, column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """Bits a character by text and language (NaN without words); whether the text holds a letter."""
        spans, letters = letter_runs(column)
        bits, chars = np.zeros((len(spans.starts) + 1, len(self.languages))), np.zeros(len(spans.starts) + 1)
        if len(spans.starts):
            table = self.table()
            rows = table.rows(spans)
            bits[1:], chars[1:] = table.fields[0][rows], table.fields[1][rows]
        np.cumsum(bits, axis=0, out=bits)
        np.cumsum(chars, out=chars)
        ends = np.concatenate([[0], np.cumsum(spans.counts)])
        with np.errstate(invalid="ignore", divide="ignore"):
            return -(bits[ends[1:]] - bits[ends[:-1]]) / (chars[ends[1:]] - chars[ends[:-1]])[:, None], letters


_LETTER = np.zeros(256, bool)
_LETTER[[*range(0x41, 0x5B), *range(0x61, 0x7B), *range(0x80, 0x100)]] = True
_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[0x41:0x5B] += 32


def letter_runs(column: pa.Array) -> tuple[Spans, np.ndarray]:
    """Words of each text: its runs of letters in lower case; and whether it holds a letter.

    Texts with other characters than ASCII and U+00C0 to U+00FF are turned into their words, a blank between them, first.
    """
    data, bounds = text_bytes(column)
    odd = np.flatnonzero((data >= 0xC4) | (data == 0xC2))
    letters = np.zeros(len(column), bool)
    if len(odd):
        texts = column.to_pylist()
        which = np.unique(np.searchsorted(bounds, odd, side="right") - 1).tolist()
        for k in which:
            found = _WORD.findall(texts[k].lower())
            letters[k] = any(c.isalpha() for w in found for c in w)
            texts[k] = " ".join(found)
        data, bounds = text_bytes(pa.array(texts, pa.string()))
    else:
        which = []
    inside = _LETTER[data]
    data = _LOWER[data]
    lead = np.flatnonzero(data == 0xC3)
    last = data[lead + 1]
    inside[lead[(last == 0x97) | (last == 0xB7)]] = inside[lead[(last == 0x97) | (last == 0xB7)] + 1] = False
    upper = lead[(last <= 0x9E) & (last != 0x97)] + 1
    data[upper] += 32
    spans = runs(data, bounds, inside)
    plain = np.ones(len(column), bool)
    plain[which] = False
    return spans, np.where(plain, spans.counts > 0, letters)


def fit(labelled: DataFrame, text_col: str = "text", lang_col: str = "lang", id_col: str = "doc_id", fit_rows: int = FIT_ROWS) -> LanguageModels:
    """Fit on whole texts of at most ``fit_rows`` rows a language, of which one in ``HELD_BACK`` calibrates rejection.

    Rows are drawn by a hash of their id and text, equal ones as one, so the draw does not depend on the input's order.  Words are counted by the
    tasks; their counts, bounded by the draw, come to the driver.  A language none of whose few rows were held back is calibrated on
    the rows that it was fitted on, and no tighter than any other.  Rows with null text, language or without letters
    teach nothing.  Without labelled rows there are no languages, and every text is rejected.
    """
    rows = labelled.where(F.col(text_col).isNotNull() & F.col(lang_col).isNotNull()).select(F.col(text_col).cast("string").alias("text"), F.col(lang_col).cast("string").alias("lang"), F.xxhash64(F.col(id_col).cast("string"), F.col(text_col).cast("string"), F.lit(7)).alias("draw"))
    sizes = rows.groupBy("lang").agg(F.approx_count_distinct("draw", 0.02).alias("count")).collect()  # a row a language
    if not sizes:
        return LanguageModels([], [], np.empty(0), uuid.uuid4().hex)
    # Hashes below a cut that leaves some more than are wanted, then the least of those
    cut = F.create_map(*(F.lit(x) for r in sizes for x in (r["lang"], _cut(fit_rows, r["count"]))))[F.col("lang")]
    least = Window.partitionBy("lang").orderBy("draw")
    last = rows.select("lang", "draw").where(F.col("draw") < cut).distinct().withColumn("k", F.row_number().over(least)).where(F.col("k") <= fit_rows).groupBy("lang").agg(F.max("draw").alias("last")).collect()
    last = F.create_map(*(F.lit(x) for r in last for x in (r["lang"], r["last"])))[F.col("lang")]
    drawn = rows.where(F.col("draw") <= last).dropDuplicates(["lang", "draw"]).withColumn("held", F.pmod(F.xxhash64("draw"), F.lit(HELD_BACK)) == 0)

    def count(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            counts: dict[tuple[str, str], int] = {}
            for lang, t in zip(batch.column("lang").to_pylist(), batch.column("text").to_pylist(), strict=True):
                for w in _WORD.findall(t.lower()):
                    counts[lang, w] = counts.get((lang, w), 0) + 1
            yield pa.RecordBatch.from_arrays([pa.array([k[0] for k in counts], pa.string()), pa.array([k[1] for k in counts], pa.string()), pa.array(list(counts.values()), pa.int64())], ["lang", "word", "n"])

    words = drawn.where("not held").select("lang", "text").mapInArrow(count, "lang string, word string, n long").groupBy("lang", "word").agg(F.sum("n").alias("n"))

    def model(table: pa.Table) -> pa.Table:
        table = table.sort_by("word")
        fitted = CharModel.fit(table.column("word").to_pylist(), table.column("n").to_numpy().astype(float))
        return pa.table({"lang": table.column("lang").slice(0, 1), "model": pa.array([pickle.dumps(fitted)], pa.binary())})

    # A model a language, its size bounded by the draw
    found = sorted((r["lang"], pickle.loads(r["model"])) for r in words.groupBy("lang").applyInArrow(model, "lang string, model binary").toLocalIterator())
    languages, models = [x for x, _ in found], [m for _, m in found]
    fitted = LanguageModels(languages, models, np.full(len(models), np.inf), uuid.uuid4().hex)
    sent = labelled.sparkSession.sparkContext.broadcast(fitted)  # bounded by the draw

    def measure(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        places = {lang: k for k, lang in enumerate(sent.value.languages)}
        for batch in batches:
            for chunk in text_chunks(batch):
                own = [places.get(x, -1) for x in chunk.column("lang").to_pylist()]
                entropy, _ = sent.value.entropies(chunk.column("text"))
                bits = [float(e[k]) if k >= 0 else float("nan") for e, k in zip(entropy, own, strict=True)]
                yield pa.RecordBatch.from_arrays([chunk.column("lang"), pa.array(bits)], ["lang", "bits"])

    def measured(rows: DataFrame) -> dict[str, list[float]]:
        bits: dict[str, list[float]] = {}
        for r in rows.select("lang", "text").mapInArrow(measure, "lang string, bits double").where("not isnan(bits)").collect():  # a number a drawn row
            bits.setdefault(r["lang"], []).append(r["bits"])
        return bits

    limit = lambda own: np.quantile(own, CALIBRATION_SHARE) + MARGIN_BITS
    held = measured(drawn.where("held")) if languages else {}
    lacking = [x for x in languages if x not in held]
    own_rows = measured(drawn.where(~F.col("held") & F.col("lang").isin(lacking))) if lacking else {}
    widest = max((limit(x) for x in held.values()), default=0.0)
    for k, lang in enumerate(languages):
        fitted.limits[k] = limit(held[lang]) if lang in held else max(widest, limit(own_rows[lang]))
    sent.unpersist()
    return fitted


def _cut(wanted: int, rows: int) -> int:
    """A 64-bit hash below which, of so many rows, at least ``wanted`` and not many more fall in all likelihood."""
    share = min(1.0, (wanted + 8 * math.sqrt(wanted) + 64) / rows)
    return min(2**63 - 1, int(-(2**63) + share * 2.0**64))


def identify(df: DataFrame, models: LanguageModels, text_col: str = "text") -> DataFrame:
    """Add ``lang_pred``, ``score`` (share of the best language, 0 to 1), ``bits_per_char`` and ``rejected``.

    The language of the lowest cross-entropy, ties to the first by name.  Null text or text without a letter:
    ``und``, score 0, rejected.  Rejected otherwise: a cross-entropy above the language's calibrated limit.  Input columns of any name
    stay (those of these four names are replaced); only the text goes to Python; an empty table stays empty.
    """
    sent = df.sparkSession.sparkContext.broadcast(models)  # bounded by the fitting draw
    added = ["lang_pred", "score", "bits_per_char", "rejected"]

    def predict(texts: pa.Array) -> pa.Array:
        m, found = sent.value, []
        for chunk in text_chunks(pa.RecordBatch.from_arrays([texts], ["text"])):
            column = chunk.column("text")
            entropy, letters = m.entropies(column) if m.languages else (np.full((len(column), 1), np.nan), np.zeros(len(column), bool))
            good = letters & ~np.isnan(entropy[:, 0])
            filled = np.where(good[:, None], entropy, 0.0)
            best = filled.argmin(axis=1)
            least = filled[np.arange(len(best)), best]
            share = 1.0 / np.exp2(-np.minimum(50, 8 * (filled - least[:, None]))).sum(axis=1)
            names = pa.array([*m.languages, UNKNOWN], pa.string()).take(pa.array(np.where(good, best, len(m.languages))))
            above = least > m.limits[best] if m.languages else good
            found.append(pa.StructArray.from_arrays([names, pa.array(np.where(good, share, 0.0)), pa.array(least, mask=~good), pa.array(~good | above)], added))
        return pa.concat_arrays(found) if found else pa.array([], pa.struct([("lang_pred", pa.string()), ("score", pa.float64()), ("bits_per_char", pa.float64()), ("rejected", pa.bool_())]))

    # Not to be evaluated again for a filter on its result
    judge = F.arrow_udf(predict, "lang_pred string, score double, bits_per_char double, rejected boolean").asNondeterministic()
    kept = [c for c in df.columns if c not in added]
    result = next(f"__found{i}" for i in range(len(kept) + 1) if f"__found{i}" not in kept)
    found = df.select(*(F.col(f"`{c}`") for c in kept), judge(F.col(f"`{text_col}`").cast("string")).alias(result))
    return found.select(*(F.col(f"`{c}`") for c in kept), *(F.col(result)[c].alias(c) for c in added))
