"""Mixing to target weights with soft domain membership.

A classifier fitted on labelled documents gives each document posteriors over domains.  Document rates then solve a
nonnegative least-squares problem by projected gradient: the expected tokens of each domain, summed over documents by
rate, tokens and posterior, should equal the targets.  An iteration sums a few vectors with an entry a domain over all
documents, and a document's rate follows from its posteriors and the steps so far, so no state per document is kept.
"""

from __future__ import annotations

import re
import warnings
from collections.abc import Iterable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from leafpress.llm.interning import WordTable, remembered, text_chunks, words_of
from leafpress.storage import materialize

#: Labelled rows that the classifier is fitted on at most, features it keeps, and hash slots of features.
FIT_ROWS, FEATURES, SLOTS = 8000, 600, 1 << 18
#: Domains of a labelled document and the weights its tokens get in the mixture.
DOMAINS = ("good", "poor", "toxic")
WEIGHTS = {"good": 0.95, "poor": 0.045, "toxic": 0.005}
#: Steps at most, and the share of all tokens to which targets are met.
ITERATIONS, TOLERANCE = 60, 1e-3
#: Steps that an iteration tries at once: lengths of gradients scaled by the Gram matrix plus so much of its trace.
STEP_LENGTHS, DAMPING = (0.1, 0.3, 1.0, 2.0, 4.0, 8.0, 16.0), (1e-9, 1e-6, 1e-5, 1e-4, 3e-4, 1e-3, 1e-2, 1e-1)
_PLAIN = re.compile(rb"[A-Za-z0-9\x80-\xff]+")


def _slot(feature: bytes) -> int:
    return xxhash.xxh3_64_intdigest(feature) % SLOTS


def _word_slots() -> WordTable:
    """Slots of a word in lower case and of the signs around its letters (-1: none); whether it is in capitals."""

    def learn(words: list[bytes]) -> tuple[np.ndarray, ...]:
        cores = [b"".join(_PLAIN.findall(w)).lower() for w in words]
        signs = [_PLAIN.sub(b"", w) for w in words]
        return (
            np.array([_slot(b"w" + c) if c else -1 for c in cores], np.int32),
            np.array([_slot(b"s" + s[:8]) if s else -1 for s in signs], np.int32),
            np.array([len(w) > 1 and w.isupper() for w in words], bool),
        )

    return remembered("domain features", lambda: WordTable(learn))


def _named(name: bytes, values: np.ndarray) -> np.ndarray:
    """Slots of a feature's values, small whole numbers."""
    kinds, at = np.unique(values, return_inverse=True)
    return np.array([_slot(b"%s%d" % (name, v)) for v in kinds.tolist()], np.int64)[at]


def _features(column: pa.Array, kept: np.ndarray | None = None) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(text, feature slot) pairs, each once, by text; and each text's number of words (runs of signs other than ASCII white space).

    With ``kept``, slots where it is negative are left out.
    """
    spans = words_of(column)
    n, tokens = len(column), spans.counts
    table = _word_slots()
    doc, some = spans.of_text(), np.flatnonzero(tokens)
    pairs = [np.stack([np.flatnonzero(tokens == 0), np.full(n - len(some), _slot(b"empty"))])]
    if len(doc):
        rows = table.rows(spans)
        core, sign, capital = (f[rows] for f in table.fields)
        different = np.sort((doc << 32) | rows)
        different = different[np.r_[True, different[1:] != different[:-1]]] >> 32
        share = lambda found: np.bincount(found, minlength=n)[some] / tokens[some]
        shapes = ((b"size", np.log2(tokens[some]) // 2), (b"kinds", 4 * share(different)), (b"capitals", 4 * share(doc[capital])), (b"signs", 4 * share(doc[sign >= 0])))
        pairs += [np.stack([some, _named(name, values.astype(np.int64))]) for name, values in shapes]
        pairs += [np.stack([doc[x >= 0], x[x >= 0]]) for x in (core, sign)]
    text, slot = np.concatenate(pairs, axis=1)
    if kept is not None:
        text, slot = text[kept[slot] >= 0], slot[kept[slot] >= 0]
    both = np.unique(text * SLOTS + slot)
    return both // SLOTS, both % SLOTS, tokens


@dataclass
class DomainModel:
    domains: tuple[str, ...]
    column: np.ndarray  # of each slot, -1 where no feature
    weights: np.ndarray  # feature x domain, the bias last

    def posteriors(self, column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """Of each text, and its number of words."""
        text, slot, tokens = _features(column, self.column)
        own = self.weights[self.column[slot]]
        logits = np.stack([np.bincount(text, own[:, d], len(tokens)) for d in range(len(self.domains))], axis=1) + self.weights[-1]
        e = np.exp(logits - logits.max(axis=1, keepdims=True, initial=-np.inf))
        return e / e.sum(axis=1, keepdims=True), tokens


def fit_domains(labelled: DataFrame, domain: Column, text_col: str = "text", id_col: str = "doc_id", domains: tuple[str, ...] = DOMAINS, fit_rows: int = FIT_ROWS) -> DomainModel:
    """Multinomial logistic regression on the features most associated with a domain.

    ``fit_rows`` bounds the rows drawn (by a hash of the id; of an id with more rows than the bound leaves room for, by a hash of the text, equal ones as one); rows with null text or domain, or a domain not named,
    are left out.
    Without labelled rows all domains are equally likely.
    """
    rows = labelled.select(F.col(text_col).alias("text"), domain.alias("domain"), F.xxhash64(F.col(id_col).cast("string"), F.lit(11)).alias("draw")).where(F.col("text").isNotNull() & F.col("domain").isin(*domains))
    # Ids up to the one with which the bound is reached; of that one, as many rows as there is room for
    sizes = rows.groupBy("draw").agg(F.count("*").alias("n")).orderBy("draw").limit(fit_rows).collect()  # bounded by ``fit_rows``
    last, room = None, fit_rows
    for r in sizes:
        if room <= 0:
            break
        last, room = r, room - r["n"]

    def describe(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for chunk in text_chunks(batch):
                text, slot, tokens = _features(chunk.column("text"))
                lists = pa.ListArray.from_arrays(pa.array(np.searchsorted(text, np.arange(len(tokens) + 1)).astype(np.int32)), pa.array(slot.astype(np.int32)))
                yield pa.RecordBatch.from_arrays([chunk.column("domain"), lists], ["domain", "slots"])

    drawn = None
    if last is not None:
        taken = rows.where(F.col("draw") <= last["draw"])
        if room < 0:
            many = rows.where(F.col("draw") == last["draw"]).dropDuplicates(["text", "domain"]).orderBy(F.xxhash64("text", "domain")).limit(last["n"] + room)
            taken = rows.where(F.col("draw") < last["draw"]).unionByName(many)
        # As Arrow, four bytes a feature: rows of Python's numbers would take over ten times that, in the JVM too
        drawn = taken.select("text", "domain").mapInArrow(describe, "domain string, slots array<int>").toArrow()
    k = len(domains)
    y = np.empty(0, int) if drawn is None else pc.index_in(drawn["domain"], pa.array(domains, pa.string())).to_numpy().astype(int)
    column = np.full(SLOTS, -1, np.int32)
    if not len(y):
        return DomainModel(domains, column, np.zeros((1, k)))
    row = np.repeat(np.arange(len(y), dtype=np.int32), pc.list_value_length(drawn["slots"]).to_numpy())
    slot = pc.list_flatten(drawn["slots"]).to_numpy()
    del drawn
    size = np.bincount(y, minlength=k) / len(y)
    seen = np.bincount(slot, minlength=SLOTS)
    with np.errstate(divide="ignore", invalid="ignore"):
        z = np.stack([(np.bincount(slot[y[row] == d], minlength=SLOTS) - seen * size[d]) ** 2 / (seen * size[d]) for d in range(k)])
    strength = np.where(seen >= 4, np.nan_to_num(z, posinf=0.0).sum(axis=0), 0.0)
    chosen = np.argsort(-strength, kind="stable")[:FEATURES]
    chosen = chosen[strength[chosen] > 16.0]
    column[chosen] = np.arange(len(chosen))
    held = column[slot] >= 0
    r, c = row[held].astype(np.int64), column[slot[held]].astype(np.int64)
    del row, slot, held
    target = np.eye(k)[y]
    w = np.zeros((len(chosen) + 1, k))
    w[-1] = np.log(np.maximum(size, 1e-6))
    m, v = np.zeros_like(w), np.zeros_like(w)
    for step in range(1, 301):
        logits = np.stack([np.bincount(r, w[c, d], len(y)) for d in range(k)], axis=1) + w[-1]
        e = np.exp(logits - logits.max(axis=1, keepdims=True))
        error = (e / e.sum(axis=1, keepdims=True) - target) / len(y)
        g = np.vstack([np.stack([np.bincount(c, error[r, d], len(chosen)) for d in range(k)], axis=1), error.sum(axis=0)]) + 2e-6 * w
        m, v = 0.9 * m + 0.1 * g, 0.99 * v + 0.01 * g * g
        w -= 0.1 * (m / (1 - 0.9**step)) / (np.sqrt(v / (1 - 0.99**step)) + 1e-9)
    return DomainModel(domains, column, w)


def domain_posteriors(df: DataFrame, model: DomainModel, text_col: str = "text", id_col: str = "doc_id") -> DataFrame:
    """Per row: ``doc_id``, ``tokens`` (words of the whole text) and ``posterior`` (array, by domain)."""
    sent = df.sparkSession.sparkContext.broadcast(model)  # bounded by slots and features

    def predict(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for chunk in text_chunks(batch):
                p, tokens = sent.value.posteriors(chunk.column("text"))
                lists = pa.ListArray.from_arrays(pa.array(np.arange(0, p.size + 1, p.shape[1], dtype=np.int32)), pa.array(p.ravel()))
                yield pa.RecordBatch.from_arrays([chunk.column("doc_id"), pa.array(tokens), lists], ["doc_id", "tokens", "posterior"])

    rows = df.select(F.col(id_col).alias("doc_id"), F.col(text_col).cast("string").alias("text"))
    return rows.mapInArrow(predict, f"doc_id {rows.schema['doc_id'].dataType.simpleString()}, tokens long, posterior array<double>")


@dataclass
class RateSteps:
    """Projected-gradient steps from rate one; a document's rate follows from its posteriors alone."""

    residuals: np.ndarray  # of each step, by domain: the negative gradient of a document is its posteriors times this
    moves: np.ndarray  # of each step, by domain: what its posteriors are multiplied with
    targets: dict[str, tuple[float, float]]  # by domain: (target, reached) tokens
    converged: bool

    def rates(self, p: np.ndarray) -> np.ndarray:
        r = np.ones((len(p), 1))
        for residual, move in zip(self.residuals, self.moves, strict=True):
            r = _moved(r, p, residual, move[None])
        return r[:, 0]


def _moved(r: np.ndarray, p: np.ndarray, residual: np.ndarray, moves: np.ndarray) -> np.ndarray:
    """A column of rates for each projected step; a rate of zero whose gradient holds it there stays."""
    held = (r <= 0) & (p @ residual <= 0)[:, None]
    return np.where(held, 0.0, np.maximum(0.0, r + p @ moves.T))


def _posteriors(batch: pa.RecordBatch, domains: int) -> np.ndarray:
    return batch.column("posterior").flatten().to_numpy(zero_copy_only=False).reshape(-1, domains)


def solve_rates(members: DataFrame, weights: dict[str, float], total_tokens: float | None = None, iterations: int = ITERATIONS) -> RateSteps:
    """Nonnegative rates whose expected domain tokens come nearest to ``weights`` times ``total_tokens``.

    Without a total, it is the largest for which no domain needs more tokens than it has, and a twentieth more.  Projected
    gradient in rates scaled by document length; the gradient is scaled further by the damped inverse of the Gram matrix of
    documents with a rate above zero.  Each pass over ``members`` tries several dampings and lengths at once, the unscaled step (1 /
    largest eigenvalue) among them, and the one that comes nearest is taken.  Ends when every domain is within ``TOLERANCE`` of
    all tokens, or no step shrinks the distance by a thousandth (then ``converged`` says whether targets are met).
    """
    w = np.array(list(weights.values()), float)
    w /= w.sum()
    k = len(w)

    def sums(done: RateSteps, residual: np.ndarray, moves: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """By move: tokens of each domain after it, and the Gram matrix of documents with a rate above zero then."""

        def add(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            out = np.zeros((len(moves), k + 1, k))
            for batch in batches:
                p, t = _posteriors(batch, k), batch.column("tokens").to_numpy().astype(float)
                squares = (p[:, :, None] * p[:, None, :]).reshape(len(p), -1)
                after = _moved(done.rates(p)[:, None], p, residual, moves)
                out[:, 0] += (t[:, None] * after).T @ p
                out[:, 1:] += ((t[:, None] * (after > 0)).T @ squares).reshape(-1, k, k)
            yield pa.RecordBatch.from_arrays([pa.array(np.arange(out.size, dtype=np.int32)), pa.array(out.ravel())], ["i", "x"])

        found = members.select("tokens", "posterior").mapInArrow(add, "i int, x double").groupBy("i").agg(F.sum("x").alias("x")).collect()  # moves x (k + 1) k rows
        out = np.zeros(len(moves) * (k + 1) * k)
        for row in found:
            out[row["i"]] = row["x"]
        out = out.reshape(len(moves), k + 1, k)
        return out[:, 0], out[:, 1:]

    steps = RateSteps(np.zeros((0, k)), np.zeros((0, k)), {}, True)
    (reached,), (gram,) = sums(steps, np.zeros(k), np.zeros((1, k)))
    has = reached[w > 0] / w[w > 0]
    total = float(total_tokens) if total_tokens is not None else 1.05 * float(has[has > 0].min(initial=np.inf) if (has > 0).any() else 0.0)
    target = w * total
    met = lambda x: bool(np.abs(x - target).max() <= TOLERANCE * max(total, 1.0))
    for _ in range(iterations):
        residual = target - reached
        size = np.trace(gram)
        if met(reached) or not size > 0:
            break
        scaled = [np.linalg.solve(gram + d * size * np.eye(k), residual) for d in DAMPING]
        moves = np.stack([*(x * length for x in scaled for length in STEP_LENGTHS), residual / np.linalg.eigvalsh(gram)[-1]])
        tried, grams = sums(steps, residual, moves)
        far = np.linalg.norm(target - tried, axis=1)
        best = int(far.argmin())
        if far[best] > 0.999 * np.linalg.norm(residual):
            break
        steps.residuals, steps.moves = np.vstack([steps.residuals, residual]), np.vstack([steps.moves, moves[best]])
        reached, gram = tried[best], grams[best]
    steps.targets = {d: (float(t), float(x)) for d, t, x in zip(weights, target, reached, strict=True)}
    steps.converged = met(reached) or not reached.sum()
    return steps


def mix(df: DataFrame, model: DomainModel, weights: dict[str, float] = WEIGHTS, total_tokens: float | None = None, text_col: str = "text", id_col: str = "doc_id") -> DataFrame:
    """Per row: ``doc_id``, ``tokens``, ``p_<domain>``, ``rate`` and ``copies``.

    ``copies`` rounds the rate by a hash of the id, so its expectation is the rate and a rerun decides alike.  Null or
    empty text: no tokens, a rate like that of any such document.  Repeated rows get equal rates; null ids one common draw;
    other columns are ignored; an empty table gives no rows.  Targets that nonnegative rates cannot reach are approached as near as
    they can be, with a warning that names them.
    """
    members = materialize(domain_posteriors(df, model, text_col, id_col), "members")
    steps = solve_rates(members, weights, total_tokens)
    if not steps.converged:
        warnings.warn(f"mixing targets not met, (target, reached) tokens: {steps.targets}", stacklevel=2)

    def rate(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            p = _posteriors(batch, len(weights))
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), batch.column("tokens"), *(pa.array(np.ascontiguousarray(p[:, i])) for i in range(len(weights))), pa.array(steps.rates(p))], ["doc_id", "tokens", *(f"p_{d}" for d in weights), "rate"])

    shares = "".join(f", p_{d} double" for d in weights)
    kind = members.schema["doc_id"].dataType.simpleString()
    return members.mapInArrow(rate, f"doc_id {kind}, tokens long{shares}, rate double").withColumn("copies", F.expr("cast(floor(rate + pmod(xxhash64(cast(doc_id as string), 13), 1000003) / 1000003.0D) as int)"))


def label_domain(quality: str = "quality", toxic: str = "toxic") -> Column:
    """Domain of a labelled document; null where both labels are."""
    return F.expr(f"case when {toxic} = 1 then 'toxic' when {quality} = 1 then 'good' when {quality} = 0 then 'poor' end")
