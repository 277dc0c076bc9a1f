"""Quality classifier by positive-unlabelled learning.

A logistic model over statistics of the text minimises the non-negative
unbiased risk: with trusted positives P (documents labelled good), unlabelled
documents U and a class prior ``a``,

    a * E_P[l(z)] + max(0, E_U[l(-z)] - a * E_P[l(-z)])

where l is the logistic loss. The second term estimates the loss of the
negatives that U holds; where overfitting makes it negative, the step goes
back up its gradient instead of down the risk. Known negatives are used for the
prior only.

Every training document takes part: texts are read once, for a table of their
statistics (a few hundred bytes a document); each Newton step is one pass over
that table whose sums (some thousand numbers) are grouped before the driver
gets them.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from stackyard.operators.joins import attach

from .common import Saved, stream_texts
from .words import SPACE, Texts, window_hashes

#: Steps of the fit at most, and the change of the weights that ends it.
STEPS, TOLERANCE = 20, 1e-5
#: Share of a Newton step that is taken: whole ones jump over the border where
#: the negatives' risk falls below zero. The fit ends when it was met so often.
DAMPING, TURNS = 0.5, 4
PENALTY = 1e-2
#: Weights end at so many decimals, far coarser than the order of sums makes them differ.
DECIMALS = 7
#: Bytes of texts worked on at once; a longer text is read in pieces cut at white space.
PIECE_BYTES = 2 << 20
PRIOR_BOUNDS = (0.01, 0.99)

SYMBOLS = b"!\"#$%&'()*+,-./:;<=>?@[\\]^_`{|}~"
ASCII = np.arange(256)
UPPER = (ASCII >= 65) & (ASCII <= 90)
LETTER = UPPER | (ASCII >= 97) & (ASCII <= 122) | (ASCII >= 128)
DIGIT = (ASCII >= 48) & (ASCII <= 57)
STOP = np.isin(ASCII, list(b".!?"))
COMMA = np.isin(ASCII, list(b",;:"))
MARK = np.isin(ASCII, list(SYMBOLS))
BYTE_GROUPS = np.stack([ASCII == 10, SPACE & (ASCII != 10), DIGIT, UPPER, (ASCII >= 97) & (ASCII <= 122), ASCII >= 128,
                        (ASCII < 32) & ~SPACE | (ASCII == 127), *[ASCII == b for b in SYMBOLS]], axis=1).astype(np.int64)
WORD_SHARES = 10  # shares of words by their form
N_FEATURES = 4 + WORD_SHARES + 9 + BYTE_GROUPS.shape[1]


# ------------------------------------------------------------ statistics of texts

def _pieces(texts: list[bytes]) -> list[list[tuple[int, bytes]]]:
    """Groups of (text number, piece) of bounded size; a cut is at white space where there is any."""
    groups, held = [[]], 0
    for t, text in enumerate(texts):
        at = 0
        while at < len(text) or at == 0:
            end = min(len(text), at + PIECE_BYTES)
            if end < len(text):
                tail = text[at:end]
                cut = max(tail.rfind(b"\n"), tail.rfind(b" "))
                end = at + cut + 1 if cut > 0 else end
            if held + end - at > PIECE_BYTES and groups[-1]:
                groups.append([])
                held = 0
            groups[-1].append((t, text[at:end]))
            held += end - at
            at = max(end, 1)
    return groups


def _count(of: np.ndarray, n: int, flags: np.ndarray | None = None) -> np.ndarray:
    return np.bincount(of, weights=flags, minlength=n).astype(np.float64)


def _runs(of: np.ndarray, h: np.ndarray, n: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """By text: different values, the count of the most frequent one, sum of c * ln c."""
    if not len(h):
        return np.zeros(n), np.zeros(n), np.zeros(n)
    order = np.lexsort((h, of))
    so, sh = of[order], h[order]
    new = np.ones(len(h), bool)
    new[1:] = (so[1:] != so[:-1]) | (sh[1:] != sh[:-1])
    first = np.flatnonzero(new)
    c = np.diff(np.append(first, len(h))).astype(np.float64)
    own = so[first]
    top = np.zeros(n)
    np.maximum.at(top, own, c)
    return _count(own, n), top, _count(own, n, c * np.log(c))


def text_statistics(texts: list[bytes]) -> np.ndarray:
    """One row of numbers for each text: sizes, shares of words by their form,
    repetition, lines, and square roots of byte shares."""
    n = len(texts)
    bytes_of = np.zeros((n, 256), np.int64)
    forms = np.zeros((n, WORD_SHARES))
    length, square, stops = np.zeros(n), np.zeros(n), np.zeros(n)
    words, lines = [], []
    for group in _pieces(texts):
        owner = np.array([t for t, _ in group], np.int64)
        for t, piece in group:
            bytes_of[t] += np.bincount(np.frombuffer(piece, np.uint8), minlength=256)
        b = Texts([p for _, p in group])
        of = owner[b.text_of]
        size = (b.end - b.start).astype(np.float64)
        upper, letter, digit, mark = (np.concatenate(([0], np.cumsum(f[b.data], dtype=np.int32)))
                                      for f in (UPPER, LETTER, DIGIT, MARK))
        held = lambda c: c[b.end] - c[b.start]
        last = b.data[b.end - 1]
        caps, letters, marks = held(upper), held(letter), held(mark)
        shapes = [(caps >= 2) & (caps == letters), UPPER[b.data[b.start]] & (caps < 2), letters == 0, held(digit) > 0,
                  STOP[last], COMMA[last], MARK[last] & ~STOP[last] & ~COMMA[last], marks > MARK[last],
                  size == 1, size > 12]
        for k, flag in enumerate(shapes):
            forms[:, k] += _count(of, n, flag)
        length += _count(of, n, size)
        square += _count(of, n, size * size)
        words.append((of, b.hashes()))
        # a line is told by its words: its first word's number and the hash of all
        row = np.concatenate(([0], np.cumsum(b.data == 10)))[b.start]
        first = np.flatnonzero(np.diff(row, prepend=-1))
        if len(first):
            with np.errstate(over="ignore"):
                place = np.arange(len(row), dtype=np.uint64) - np.repeat(first, np.diff(np.append(first, len(row)))).astype(np.uint64)
                sums = np.add.reduceat(words[-1][1] * (2 * place + np.uint64(1)), first)
            lines.append((of[first], sums))
            ends = np.append(first[1:], len(row)) - 1
            stops += _count(of[first], n, STOP[last[ends]])
    of, h = (np.concatenate([w[k] for w in words]) for k in (0, 1))
    lof, lh = (np.concatenate([x[k] for x in lines]) if lines else np.zeros(0, np.int64) for k in (0, 1))
    w, size = _count(of, n), bytes_of.sum(axis=1).astype(np.float64)
    per_word, per_line = 1 / np.maximum(w, 1), 1 / np.maximum(_count(lof, n), 1)
    mean = length * per_word
    different, top, plogp = _runs(of, h, n)
    entropy = np.where(w > 1, np.log(np.maximum(w, 1)) - plogp * per_word, 0) / np.maximum(np.log(np.maximum(w, 2)), 1e-9)
    same = (h[1:] == h[:-1]) & (of[1:] == of[:-1])
    three = window_hashes(h, 3)
    whole = of[:len(three)] == of[2:] if len(three) else np.zeros(0, bool)
    n3 = _count(of[:len(three)][whole], n)
    again = n3 - _runs(of[:len(three)][whole], three[whole], n)[0]
    n_lines = _count(lof, n)
    out = [np.log1p(w), np.log1p(size), mean / 10, np.sqrt(np.maximum(square * per_word - mean * mean, 0)) / 10,
           *(forms * per_word[:, None]).T,
           different * per_word, top * per_word, entropy, _count(of[1:][same], n) * per_word, again / np.maximum(n3, 1),
           (n_lines - _runs(lof, lh, n)[0]) * per_line, np.log1p(n_lines), np.log1p(w * per_line), stops * per_line,
           *np.sqrt(bytes_of @ BYTE_GROUPS / np.maximum(size, 1)[:, None]).T]
    return np.stack(out, axis=1)


def _statistics(batches):
    for batch in batches:
        texts = batch.column("text").to_pylist()
        if not texts:
            continue
        x = text_statistics(texts).astype(np.float32)
        yield pa.RecordBatch.from_arrays(
            [batch.column("doc_id"), pa.ListArray.from_arrays(np.arange(0, x.size + 1, x.shape[1], dtype=np.int32), pa.array(x.ravel()))],
            ["doc_id", "x"])


def document_statistics(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(doc_id, x): the numbers of :func:`text_statistics` for every document."""
    return stream_texts(docs, id_col, text_col, _statistics, "doc_id long, x array<float>")


# ------------------------------------------------------------ risk

def scaled(x: np.ndarray, mean: np.ndarray, std: np.ndarray) -> np.ndarray:
    """Standardised statistics within 10 deviations, and a constant."""
    z = np.clip((x - mean) / std, -10, 10)
    return np.concatenate([z, np.ones((len(z), 1))], axis=1)


def sigmoid(z: np.ndarray) -> np.ndarray:
    return 0.5 * (1 + np.tanh(0.5 * z))


def softplus(z: np.ndarray) -> np.ndarray:
    return np.logaddexp(0, z)


class Sums:
    """What one pass adds up for given weights: of the unlabelled rows their
    number, negative loss, its gradient and curvature; of the positive rows their
    number, positive and negative loss, sum and gradient of the negative loss."""

    def __init__(self, d: int):
        self.d = d
        self.upper = np.triu_indices(d)
        self.parts = {"n_u": 1, "loss_u": 1, "grad_u": d, "curve": len(self.upper[0]),
                      "n_p": 1, "loss_p": 1, "loss_pn": 1, "sum_p": d, "grad_pn": d}
        self.size = sum(self.parts.values())

    def of(self, x: np.ndarray, positive: np.ndarray, w: np.ndarray) -> np.ndarray:
        z = x @ w
        s = sigmoid(z)
        p, sp = x[positive], s[positive]
        curve = (x * (s * (1 - s))[:, None]).T @ x
        return np.concatenate([[len(x), softplus(z).sum()], s @ x, curve[self.upper],
                               [len(p), softplus(-z[positive]).sum(), softplus(z[positive]).sum()], p.sum(axis=0), sp @ p])

    def split(self, values: np.ndarray) -> dict[str, np.ndarray]:
        at = np.cumsum([0, *self.parts.values()])
        return {k: values[i:j] if j - i > 1 else values[i] for k, i, j in zip(self.parts, at, at[1:])}


def risk_and_step(sums: Sums, values: np.ndarray, w: np.ndarray, prior: float,
                  penalty: float = PENALTY) -> tuple[float, float, np.ndarray]:
    """The non-negative risk at ``w``, the negatives' risk, and the next step.

    While the negatives' risk is not below zero, the step is Newton's on the
    whole risk (whose curvature is that of the unlabelled rows). Below zero it
    goes up the negatives' risk, as far as its slope says that zero is.
    """
    t = sums.split(values)
    curve = np.zeros((sums.d, sums.d))
    curve[sums.upper] = t["curve"] / t["n_u"]
    curve = curve + np.triu(curve, 1).T
    keep = penalty * np.append(np.ones(sums.d - 1), 1e-3)  # the constant hardly counts
    solve = lambda g: np.linalg.solve(curve + np.diag(keep), g)
    negative = t["loss_u"] / t["n_u"] - prior * t["loss_pn"] / t["n_p"]
    risk = prior * t["loss_p"] / t["n_p"] + max(0.0, negative) + 0.5 * (keep * w * w).sum()
    if negative < 0:
        slope = t["grad_u"] / t["n_u"] - prior * t["grad_pn"] / t["n_p"]
        up = solve(slope)
        return risk, negative, up * min(1.0, -negative / max(slope @ up, 1e-12))
    return risk, negative, -solve(t["grad_u"] / t["n_u"] - prior * t["sum_p"] / t["n_p"] + keep * w)


def descend(measure, w: np.ndarray, steps: int = STEPS) -> tuple[np.ndarray, list[float]]:
    """The weights of least risk among those whose negatives' risk is not below
    zero (else the last ones), and the risks met. ``measure(w)`` gives what
    :func:`risk_and_step` does, or None if there is nothing to learn from."""
    best, best_risk, risks, step, turns = None, None, [], np.zeros(len(w)), 0
    for _ in range(steps):
        trial = w + step
        got = measure(trial)
        if got is None:
            break
        risk, negative, following = got
        risks.append(risk)
        if negative < 0:  # back up, whatever the risk
            turns += 1
            if turns == TURNS:
                break
            w, step = trial, following
        elif best_risk is not None and risk > best_risk + 1e-12:
            step = (trial - best) / 2  # a shorter way from the best weights
            w = best
        else:
            best, best_risk = trial, risk
            w, step = trial, DAMPING * following
        if np.abs(step).max() < TOLERANCE:
            break
    return (w if best is None else best), risks


def _pass(mean, std, w, size):
    """Task side of a step: the sums of this task's rows, by their place."""
    def run(batches):
        sums = Sums(len(w))
        total = np.zeros(size)
        for batch in batches:
            x = batch.column("x").flatten().to_numpy(zero_copy_only=False).reshape(-1, len(mean)).astype(np.float64)
            total += sums.of(scaled(x, mean, std), batch.column("good").to_numpy(zero_copy_only=False), w)
        yield pa.RecordBatch.from_arrays([pa.array(np.arange(size, dtype=np.int32)), pa.array(total)], ["place", "value"])
    return run


def _moments(d: int):
    def run(batches):
        total = np.zeros(2 * d + 1)
        for batch in batches:
            x = batch.column("x").flatten().to_numpy(zero_copy_only=False).reshape(-1, d).astype(np.float64)
            total += np.concatenate([x.sum(axis=0), (x * x).sum(axis=0), [len(x)]])
        yield pa.RecordBatch.from_arrays([pa.array(np.arange(2 * d + 1, dtype=np.int32)), pa.array(total)], ["place", "value"])
    return run


def _added(rows: DataFrame, func, size: int) -> np.ndarray:
    out = np.zeros(size)
    for r in rows.mapInArrow(func, "place int, value double").groupBy("place").agg(F.sum("value").alias("value")).collect():
        out[r["place"]] = r["value"]
    return out


class QualityModel:
    """A fitted classifier: scaling, weights and the prior."""

    def __init__(self, mean: np.ndarray, std: np.ndarray, weights: np.ndarray, prior: float, risks: list[float]):
        self.mean, self.std, self.weights, self.prior, self.risks = mean, std, weights, prior, risks

    def scores(self, x: np.ndarray) -> np.ndarray:
        return sigmoid(scaled(x, self.mean, self.std) @ self.weights)


def estimated_prior(good: int, bad: int) -> float:
    """Share of good documents, from the labelled training rows (one of each kind added)."""
    return min(max((good + 1) / (good + bad + 2), PRIOR_BOUNDS[0]), PRIOR_BOUNDS[1])


def fit_positive_unlabelled(rows: DataFrame, prior: float, steps: int = STEPS) -> QualityModel:
    """A model from training rows (x, good): all of them are the unlabelled
    ones, those marked good the positives. Without positives every document
    scores the prior."""
    d = N_FEATURES
    m = _added(rows, _moments(d), 2 * d + 1)
    n = max(m[-1], 1.0)
    mean = m[:d] / n
    std = np.sqrt(np.maximum(m[d:2 * d] / n - mean * mean, 0))
    std = np.where(std > 1e-6, std, 1.0)
    w = np.zeros(d + 1)
    w[-1] = np.log(prior / (1 - prior))
    sums = Sums(d + 1)

    def measure(w):
        values = _added(rows, _pass(mean, std, w, sums.size), sums.size)
        return risk_and_step(sums, values, w, prior) if sums.split(values)["n_p"] else None

    best, risks = descend(measure, w, steps)
    return QualityModel(mean, std, np.round(best, DECIMALS), prior, risks)


# ------------------------------------------------------------ operator

def is_held_out(id_col: str = "doc_id", folds: int = 5):
    """Whether crc32(id as text) % folds is 0 (no id: as the empty text)."""
    return F.crc32(F.coalesce(F.col(f"`{id_col}`").cast("string"), F.lit("")).cast("binary")) % folds == 0


def labels_by_id(labels: DataFrame, id_col: str = "doc_id", label_col: str = "quality") -> DataFrame:
    """(doc_id, good): one row for each id; rows without an id or a label go,
    an id with different labels is not good."""
    return (labels.select(F.col(f"`{id_col}`").cast("long").alias("doc_id"), F.col(f"`{label_col}`").cast("int").alias("q"))
            .where(F.col("doc_id").isNotNull() & F.col("q").isNotNull())
            .groupBy("doc_id").agg(F.min("q").alias("q")).select("doc_id", (F.col("q") == 1).alias("good")))


def _scores(model: QualityModel, threshold: float):
    def run(batches):
        for batch in batches:
            x = batch.column("x").flatten().to_numpy(zero_copy_only=False).reshape(-1, len(model.mean)).astype(np.float64)
            s = model.scores(x)
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id"), batch.column("held_out"), pa.array(s), pa.array((s >= threshold).astype(np.int32))],
                ["doc_id", "held_out", "score", "predicted"])
    return run


def score_quality(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text",
                  label_col: str = "quality", threshold: float = 0.3, folds: int = 5,
                  prior: float | None = None) -> tuple[DataFrame, QualityModel]:
    """(doc_id, held_out, score, predicted) of every document, and the model.

    Learns from the rows that are not held out: labels of held-out ids are not
    read. The prior is the labelled training rows' share of good ones, unless it
    is given. Defined results: a null text is an empty one; empty texts are
    scored by their statistics (all zero); rows without an id are held out;
    repeated rows are scored each; without positive labels every score is the
    prior (0.5 without labels); an empty table gives no rows. Only the id and the
    text of the documents are read, whatever their other columns.
    """
    known = Saved(labels_by_id(labels.where(~is_held_out("doc_id", folds)), "doc_id", label_col), "labels")
    n_known = known.df.count()
    stats = document_statistics(docs, id_col, text_col).withColumn("held_out", is_held_out("doc_id", folds))
    work = Saved(attach(stats, known.df, "doc_id", "left", n_known), "statistics")
    train = work.df.where(~F.col("held_out"))
    if prior is None:
        good, bad = train.agg(F.count_if("good"), F.count_if(~F.col("good"))).first()
        prior = estimated_prior(good, bad)
    rows = train.select("x", F.coalesce("good", F.lit(False)).alias("good"))
    model = fit_positive_unlabelled(rows, prior)
    known.drop()
    out = work.df.select("doc_id", "held_out", "x").mapInArrow(
        _scores(model, threshold), "doc_id long, held_out boolean, score double, predicted int")
    return out, model
