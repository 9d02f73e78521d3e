"""Quality rules: a linear-chain conditional random field marks lines as content or boilerplate.

The chain of a document is its lines that have a word. Each line has a few dense features of its own text
and of its place in the document; two states are linked by transition weights. The field is fitted by
maximum likelihood on a bounded sample of labelled documents, whose lines first carry the document's
label. Lines of low-quality documents that the fitted field decodes as content are then relabelled and
the field is fitted again. Viterbi decoding gives the best labels of each whole document, and the share
of word characters on content lines decides whether it is kept. Counts that need no model come with it.

Odd input: null, empty and blank texts have no words and fail the base rule; repeated rows are kept;
labels of ids without a text and null labels are ignored, an id with several labels is low if one says
so; with labels of one class only there is no field and every line is content. Other columns of the
inputs are ignored (``keep_content`` keeps them).
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lendlens.llm.common import per_batch
from lendlens.llm.toxicity import held_out
from lendlens.session import materialize

#: Most labelled documents used to fit, chosen by a hash of the id; a class has at most half of them.
SAMPLE = 4_000
#: Least share of word characters on content lines.
SHARE = 0.5
PENALTY = 1.0
MAX_STEPS = 40
MIN_WORDS = 20
WINDOW = 8

FEATURES = (
    "bias symbols capitals marks exclaims digits single_words word_length words repeated_words distinct "
    "window_repeats seen_before ends_sentence starts_capital first last short"
).split()

# classes of bytes: 1 symbol, 2 capital, 4 other mark, 8 digit, 16 exclamation or question
_CLASS = np.zeros(256, np.uint8)
for _chars, _bit in ((b"#*$%&|<>", 1), (bytes(range(65, 91)), 2), (b"\"'()+,-./:;=@[\\]^_`{}~", 4), (b"0123456789", 8), (b"!?", 16)):
    _CLASS[list(_chars)] |= _bit
_BLANK = np.zeros(256, bool)
_BLANK[[32, 9, 10, 11, 12, 13]] = True


def repeated(ids: np.ndarray, window: int = WINDOW) -> np.ndarray:
    """Words covered by a window of ``window`` (a power of two) words that occurs twice or more.

    Windows are named by doubling: equal names of two halves make equal names of the whole.
    """
    covered = np.zeros(len(ids), bool)
    names, width = ids.astype(np.int64), 1
    while width < window:
        if len(names) <= width:
            return covered
        pairs = names[:-width] * (int(names.max()) + 1) + names[width:]
        names = np.unique(pairs, return_inverse=True)[1]
        width *= 2
    often = (np.bincount(names) > 1)[names]
    steps = np.zeros(len(ids) + 1, np.int64)
    steps[: len(often)] += often
    steps[window : window + len(often)] -= often
    return np.cumsum(steps[:-1]) > 0


@dataclass
class Measured:
    """A document's counts, and for each line with a word its number, word characters and features."""

    n_words: int
    word_chars: int
    n_symbols: int
    n_dup_lines: int
    n_repeat_words: int
    lines: np.ndarray
    chars: np.ndarray
    features: np.ndarray


def measure(data: bytes) -> Measured:
    """``data`` is UTF-8."""
    rows = data.split(b"\n")
    split = [r.split() for r in rows]  # bytes split at exactly 0x20 and 0x09-0x0D
    own = np.array([i for i, w in enumerate(split) if w], np.int64)
    codes = np.frombuffer(data, np.uint8)
    visible = ~_BLANK[codes] & ((codes & 0xC0) != 0x80)
    classes = _CLASS[codes]
    n_symbols = int(np.count_nonzero(classes & 1))
    if not len(own):
        none = np.zeros(0)
        return Measured(0, 0, n_symbols, 0, 0, own, none, np.zeros((0, len(FEATURES))))
    sizes = np.array([len(r) + 1 for r in rows], np.int64)
    starts = np.concatenate([[0], np.cumsum(sizes)[:-1]])
    # lines with a word are not empty, so each has its own segment; blanks between them count for nothing
    at = starts[own]

    def per_line(mask: np.ndarray) -> np.ndarray:
        return np.add.reduceat(mask, at, dtype=np.int64).astype(float)

    chars = per_line(visible)
    upper = (classes & 2) > 0
    if len(codes) > 1:  # capitals of the Latin-1 block
        upper[:-1] |= (codes[:-1] == 0xC3) & (codes[1:] >= 0x80) & (codes[1:] <= 0x9E)
    names: dict[bytes, int] = {}
    ids = np.array([names.setdefault(w, len(names)) for i in own for w in split[i]], np.int64)
    words = np.array([len(split[i]) for i in own], np.int64)
    heads = np.concatenate([[0], np.cumsum(words)[:-1]])
    again = repeated(ids)
    same = np.zeros(len(ids), bool)
    same[1:] = ids[1:] == ids[:-1]
    same[heads] = False
    seen: set[bytes] = set()
    dup = np.zeros(len(own), bool)
    for k, i in enumerate(own):
        dup[k] = rows[i] in seen
        seen.add(rows[i])
    ends = np.array([split[i][-1][-1:] in (b".", b":", b";") for i in own], float)
    capital = np.array([split[i][0][:1].isupper() or split[i][0][:1] == b"\xc3" for i in own], float)
    single = np.array([sum(len(w) == 1 for w in split[i]) for i in own], float)
    distinct = np.array([len(set(split[i])) for i in own], float)
    place = np.arange(len(own))
    features = np.column_stack([
        np.ones(len(own)),
        per_line((classes & 1) > 0) / chars,
        per_line(upper) / chars,
        per_line((classes & 4) > 0) / chars,
        per_line((classes & 16) > 0) / chars,
        per_line((classes & 8) > 0) / chars,
        single / words,
        chars / words / 10,
        np.log1p(words) / 5,
        np.add.reduceat(same, heads, dtype=np.int64) / words,
        distinct / words,
        np.add.reduceat(again, heads, dtype=np.int64) / words,
        dup,
        ends,
        capital,
        place == 0,
        place == len(own) - 1,
        words < 4,
    ])
    return Measured(
        len(ids), int(chars.sum()), n_symbols, int(dup.sum()), int(np.count_nonzero(again)), own, chars, features
    )


# ---- the field --------------------------------------------------------------------------------------------------


@dataclass(frozen=True)
class Field:
    """State 1 is boilerplate: its weights a line, and the weights of a step from state i to state j."""

    weights: np.ndarray
    steps: np.ndarray

    def viterbi(self, features: np.ndarray) -> np.ndarray:
        """True for each line that the best labelling marks as boilerplate."""
        if not len(features):
            return np.zeros(0, bool)
        (t00, t01), (t10, t11) = self.steps.tolist()
        scores = (features @ self.weights).tolist()
        clean, junk = 0.0, scores[0]
        back = bytearray(2 * len(scores))  # where each state came from
        for k in range(1, len(scores)):
            a, b = clean + t00, junk + t10
            c, d = clean + t01, junk + t11
            back[2 * k], back[2 * k + 1] = b > a, d > c
            clean, junk = max(a, b), max(c, d) + scores[k]
        out = np.zeros(len(scores), bool)
        state = junk > clean
        for k in range(len(scores) - 1, -1, -1):
            out[k] = state
            state = back[2 * k + state]
        return out


def likelihood(field: Field, rows: list[tuple[np.ndarray, np.ndarray, float]]) -> tuple[float, np.ndarray]:
    """Weighted negative log-likelihood of (features, labels, weight) chains, and its gradient.

    Forward and backward sums run over all chains at once, longest first, so that the chains that
    still have a line at a place are a prefix.
    """
    n_features = len(field.weights)
    grad = np.zeros(n_features + 4)
    rows = sorted(rows, key=lambda r: -len(r[0]))
    if not rows:
        return 0.0, grad
    sizes = np.array([len(r[0]) for r in rows])
    scores = [r[0] @ field.weights for r in rows]
    longest = int(sizes[0])
    active = [int(np.searchsorted(-sizes, -t, side="left")) for t in range(longest)]  # chains longer than t
    unary = [np.column_stack([np.zeros(n), [scores[i][t] for i in range(n)]]) for t, n in enumerate(active)]
    ahead = [unary[0]]
    for t in range(1, longest):
        moved = ahead[-1][: active[t], :, None] + field.steps
        ahead.append(np.logaddexp(moved[:, 0], moved[:, 1]) + unary[t])
    behind = [np.zeros((n, 2)) for n in active]
    for t in range(longest - 2, -1, -1):
        n = active[t + 1]
        moved = field.steps + (unary[t + 1] + behind[t + 1])[:, None, :]
        behind[t][:n] = np.logaddexp(moved[:, :, 0], moved[:, :, 1])
    total = np.logaddexp(*(ahead[0] + behind[0]).T)
    weight = np.array([r[2] for r in rows])
    loss = float(weight @ total)
    for t, n in enumerate(active):
        share = np.exp(ahead[t] + behind[t] - total[:n, None])[:, 1]
        lines = np.array([rows[i][0][t] for i in range(n)])
        label = np.array([rows[i][1][t] for i in range(n)], float)
        grad[:n_features] += (weight[:n] * (share - label)) @ lines
        loss -= float((weight[:n] * label) @ unary[t][:, 1])
        if t:
            joint = ahead[t - 1][:n, :, None] + field.steps + (unary[t] + behind[t])[:, None, :]
            grad[n_features:] += np.einsum("i,ijk->jk", weight[:n], np.exp(joint - total[:n, None, None])).ravel()
            before = np.array([rows[i][1][t - 1] for i in range(n)], int)
            place = 2 * before + label.astype(int)
            taken = np.bincount(place, weight[:n], 4)
            grad[n_features:] -= taken
            loss -= float(taken @ field.steps.ravel())
    return loss, grad


def _field(x: np.ndarray) -> Field:
    return Field(x[:-4], x[-4:].reshape(2, 2))


def _unpack(batch: pa.RecordBatch) -> list[tuple[np.ndarray, np.ndarray, float]]:
    rows = []
    for lines, label, weight in zip(*(batch.column(c).to_pylist() for c in ("features", "labels", "weight"))):
        features = np.frombuffer(lines, float).reshape(-1, len(FEATURES))
        rows.append((features, np.frombuffer(label, np.uint8), weight))
    return rows


def _loss(chains: DataFrame, x: np.ndarray) -> tuple[float, np.ndarray]:
    """One pass over the chains; each task returns one row of sums."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        loss, grad = 0.0, np.zeros(len(x))
        for batch in batches:
            a, b = likelihood(_field(x), _unpack(batch))
            loss, grad = loss + a, grad + b
        yield pa.RecordBatch.from_arrays([pa.array([loss]), pa.array([grad.tolist()], pa.list_(pa.float64()))], ["loss", "grad"])

    rows = chains.mapInArrow(run, "loss double, grad array<double>").collect()
    loss = sum(r["loss"] for r in rows) + 0.5 * PENALTY * float(x @ x)
    return loss, np.sum([r["grad"] for r in rows], axis=0) + PENALTY * x


def _minimise(chains: DataFrame, x: np.ndarray, steps: int = MAX_STEPS) -> np.ndarray:
    """BFGS with backtracking; the loss is convex and has few weights."""
    loss, grad = _loss(chains, x)
    curve = np.eye(len(x)) / max(1.0, float(np.abs(grad).max()))
    for _ in range(steps):
        if np.abs(grad).max() <= 1e-4 * max(1.0, loss):
            break
        move, size = -curve @ grad, 1.0
        while True:
            there, slope = _loss(chains, x + size * move)
            if there <= loss + 1e-4 * size * float(grad @ move) or size < 1e-6:
                break
            size /= 4
        step, turn = size * move, slope - grad
        x, loss, grad = x + step, there, slope
        fit = float(step @ turn)
        if fit > 1e-12:
            side = np.eye(len(x)) - np.outer(step, turn) / fit
            curve = side @ curve @ side.T + np.outer(step, step) / fit
    return x


def _sample(documents: DataFrame, labels: DataFrame, sample: int) -> DataFrame:
    """(text, low, weight) of at most ``sample`` labelled rows outside the held-out ones."""
    own = labels.where("quality IS NOT NULL AND doc_id IS NOT NULL")
    own = own.groupBy(F.col("doc_id").cast("long").alias("doc_id")).agg((F.min("quality") < 1).cast("int").alias("low"))
    own = own.where(~held_out("doc_id"))
    draw = F.pmod(F.xxhash64(F.lit("quality"), "doc_id"), F.lit(1 << 20)) / F.lit(float(1 << 20))
    sizes = {r["low"]: r["count"] for r in own.groupBy("low").count().collect()}
    drawn = {low: min(1.0, sample / 2 / n) for low, n in sizes.items()}
    # the inverse share keeps the labelled prior; a mean weight of about 1 keeps the penalty's meaning
    mean = sum(sizes.values()) / (sum(n * drawn[low] for low, n in sizes.items()) or 1.0) or 1.0
    share = F.lit(1.0)
    for low, value in drawn.items():
        share = F.when(F.col("low") == low, F.lit(value)).otherwise(share)
    own = own.where(draw < share).select("doc_id", "low", (1 / share / mean).alias("weight"))
    # about ``sample`` rows of a few numbers; the texts stay where they are
    texts = documents.select(F.col("doc_id").cast("long").alias("doc_id"), "text")
    return texts.join(F.broadcast(own), "doc_id").select("text", "low", "weight")


def fit(documents: DataFrame, labels: DataFrame, sample: int = SAMPLE) -> Field | None:
    """The field, or None where the labels have one class only."""

    def chains(batch: pa.RecordBatch) -> dict:
        found = [measure((x.as_py() or "").encode()) for x in batch.column("text")]
        low = batch.column("low").to_pylist()
        return {
            "low": low,
            "weight": batch.column("weight"),
            "features": [m.features.tobytes() for m in found],
            "labels": [bytes([v]) * len(m.lines) for v, m in zip(low, found)],
        }

    kind = "low int, weight double, features binary, labels binary"
    rows = per_batch(_sample(documents, labels, sample), chains, kind).where("length(labels) > 0")
    rows = materialize(rows.repartition(8), "chains")  # few rows, from a scan that keeps all its tasks
    if rows.select("low").distinct().count() < 2:
        return None
    x = _minimise(rows, np.zeros(len(FEATURES) + 4))

    def relabelled(batch: pa.RecordBatch) -> dict:
        labels = []
        for low, (lines, label, _) in zip(batch.column("low").to_pylist(), _unpack(batch)):
            junk = _field(x).viterbi(lines) if low else np.zeros(0, bool)
            # a low document without any boilerplate keeps its label
            labels.append(junk.astype(np.uint8).tobytes() if junk.any() else label.tobytes())
        return {n: batch.column(n) for n in ("low", "weight", "features")} | {"labels": labels}

    return _field(_minimise(materialize(per_batch(rows, relabelled, kind), "chains"), x))


def mark(documents: DataFrame, field: Field | None) -> DataFrame:
    """Counts of every row, the numbers (from 0) of its boilerplate lines, and its content share, 0 without words."""

    def work(batch: pa.RecordBatch) -> dict:
        out: dict[str, list] = {n: [] for n in names[1:]}
        for x in batch.column("text"):
            m = measure((x.as_py() or "").encode())
            junk = field.viterbi(m.features) if field else np.zeros(len(m.lines), bool)
            for n in names[1:6]:
                out[n].append(getattr(m, n))
            out["boilerplate"].append(m.lines[junk].tolist())
            out["content_share"].append(float(m.chars[~junk].sum() / m.word_chars) if m.word_chars else 0.0)
        return {"doc_id": batch.column("doc_id")} | out

    names = "doc_id n_words word_chars n_symbols n_dup_lines n_repeat_words boilerplate content_share".split()
    kind = ", ".join([f"{n} bigint" for n in names[:6]] + ["boilerplate array<bigint>", "content_share double"])
    return per_batch(documents.select(F.col("doc_id").cast("long").alias("doc_id"), "text"), work, kind)


def judged(marked: DataFrame, share: float = SHARE) -> DataFrame:
    """Adds ``base_failed`` and ``kept``."""
    failed = (F.col("n_words") < MIN_WORDS) | (100 * F.col("n_repeat_words") > 30 * F.col("n_words"))
    return marked.withColumn("base_failed", failed).withColumn("kept", ~failed & (F.col("content_share") >= share))


def keep_content(documents: DataFrame, field: Field | None, share: float = SHARE) -> DataFrame:
    """The rows that are kept, each judged by its own text, with all their columns."""

    @F.pandas_udf("boolean")
    def verdict(texts):
        import pandas as pd

        out = []
        for text in texts:
            m = measure((text or "").encode())
            junk = field.viterbi(m.features) if field else np.zeros(len(m.lines), bool)
            good = m.n_words >= MIN_WORDS and 100 * m.n_repeat_words <= 30 * m.n_words
            out.append(bool(good and m.chars[~junk].sum() >= share * m.word_chars))
        return pd.Series(out, dtype=bool)

    return documents.where(verdict(F.col("text")))
