"""Language identification by a bidirectional gated recurrent network over bytes.

Texts are read as UTF-8 bytes in segments of ``SEGMENT`` bytes. One GRU reads
a segment forwards, one backwards; both states label every position with
language probabilities, and a document's probability of a language is the mean
over all positions of the whole text. The network is trained in numpy by
backpropagation through time (Adam, cross entropy at every position).

Training uses a bounded sample of labelled rows: per language the
``DOCS_PER_LANGUAGE`` documents with the smallest hash of doc_id, and of each
up to ``SEGMENTS_PER_DOC`` segments spread evenly over its whole text. Rows
whose crc32(doc_id as text) mod 4 is 2 are held out and never learned from.

Defined results: null text, or text without a letter (Unicode categories L),
gives ``und`` and score 0; so does every text if no labelled row can be learned
from, and then the filter keeps every text with a letter; equally probable
languages give the first by name; texts of any length are read whole; a null
doc_id is not held out but is not learned from either; repeated rows are
predicted each; an empty table gives no rows; more than ``MAX_LANGUAGES`` values
of lang raise an error; other columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from stockcast.llm.common import ship_package
from stockcast.llm.words import some

SEGMENT = 64
HIDDEN = 8
DOCS_PER_LANGUAGE = 256
MARGIN = 4
SEGMENTS_PER_DOC = 8
STEPS = 256
BATCH = 256
AT_ONCE = 2048
UNKNOWN = "und"
MAX_LANGUAGES = 256  # the network has one output each, and each brings its sample to the driver
PREDICTED = "doc_id long, held_out boolean, lang_pred string, score double"


def has_letter(text: str) -> bool:
    """Whether a character is in one of the letter categories, as ``\\p{L}`` has it."""
    return any(map(str.isalpha, text))


def held_out(doc_id: Column) -> Column:
    return F.coalesce(F.crc32(doc_id.cast("string")) % 4 == 2, F.lit(False))


def segments(data: bytes) -> np.ndarray:
    """Rows of ``SEGMENT`` bytes; the last one is filled up with zeros."""
    n = -(-len(data) // SEGMENT)
    return np.frombuffer(data + bytes(n * SEGMENT - len(data)), np.uint8).reshape(n, SEGMENT)


def _weights(rng: np.random.Generator, languages: int) -> dict[str, np.ndarray]:
    h = HIDDEN
    out = {}
    for d in "fb":
        out[f"{d}w"] = rng.normal(0, 0.3, (3 * h, 256))          # byte -> z, r, n
        out[f"{d}u"] = rng.normal(0, h ** -0.5, (3 * h, h))      # state -> z, r, n
        out[f"{d}c"] = np.zeros((3 * h, 1))
        out[f"{d}v"] = rng.normal(0, h ** -0.5, (languages, h))  # state -> label
    out["bias"] = np.zeros((languages, 1))
    return {k: v.astype(np.float32) for k, v in out.items()}


def _squash(x: np.ndarray) -> np.ndarray:
    """x / (1 + |x|): the activation of gates and candidate, several times cheaper than tanh."""
    return x / (1 + np.abs(x))


def _gate(x: np.ndarray) -> np.ndarray:
    return 0.5 * _squash(x) + 0.5


def _read(p: dict, d: str, x: np.ndarray) -> dict[str, np.ndarray]:
    """All states of one direction over x (positions, batch), with what backpropagation needs."""
    h, (steps, batch) = HIDDEN, x.shape
    out = {k: np.empty((steps, h, batch), np.float32) for k in ("z", "r", "n", "u", "before", "state")}
    state = np.zeros((h, batch), np.float32)
    for t in range(steps) if d == "f" else range(steps - 1, -1, -1):
        g = p[f"{d}w"][:, x[t]] + p[f"{d}c"]
        a = p[f"{d}u"] @ state
        z, r = _gate(g[:h] + a[:h]), _gate(g[h:2 * h] + a[h:2 * h])
        n = _squash(g[2 * h:] + r * a[2 * h:])
        out["before"][t], out["u"][t], out["z"][t], out["r"][t], out["n"][t] = state, a[2 * h:], z, r, n
        state = n + z * (state - n)
        out["state"][t] = state
    return out


def _back(p: dict, d: str, x: np.ndarray, kept: dict, wanted: np.ndarray, grad: dict) -> None:
    """Backpropagation through time of one direction; ``wanted``: gradient of every state."""
    h, (steps, batch) = HIDDEN, x.shape
    ds = np.zeros((h, batch), np.float32)
    for t in range(steps - 1, -1, -1) if d == "f" else range(steps):
        ds = ds + wanted[t]
        z, r, n, u, before = (kept[k][t] for k in ("z", "r", "n", "u", "before"))
        # squash has the slope (1 - |squash|)^2, a gate half of that
        dn = ds * (1 - z) * (1 - np.abs(n)) ** 2
        dz = ds * (before - n) * 0.5 * (1 - np.abs(2 * z - 1)) ** 2
        dr = dn * u * 0.5 * (1 - np.abs(2 * r - 1)) ** 2
        dg = np.concatenate([dz, dr, dn])
        da = np.concatenate([dz, dr, dn * r])
        for row in range(3 * h):
            grad[f"{d}w"][row] += np.bincount(x[t], weights=dg[row], minlength=256)
        grad[f"{d}c"] += dg.sum(axis=1, keepdims=True)
        grad[f"{d}u"] += da @ before.T
        ds = ds * z + p[f"{d}u"].T @ da


def gradients(p: dict, x: np.ndarray, label: np.ndarray) -> tuple[float, dict]:
    """Mean loss per position and its gradient; x (positions, batch), zero bytes are padding and not labelled."""
    f, b = _read(p, "f", x), _read(p, "b", x)
    logits = p["fv"] @ f["state"] + p["bv"] @ b["state"] + p["bias"]  # (positions, languages, batch)
    e = np.exp(logits - logits.max(axis=1, keepdims=True))
    prob = e / e.sum(axis=1, keepdims=True)
    real = (x != 0).astype(np.float32)
    count = max(1.0, float(real.sum()))
    right = np.take_along_axis(prob, np.broadcast_to(label, (len(x), 1, len(label))), axis=1)[:, 0]
    loss = float(-(np.log(right + 1e-9) * real).sum() / count)
    dl = prob.copy()
    np.put_along_axis(dl, np.broadcast_to(label, (len(x), 1, len(label))), right[:, None] - 1, axis=1)
    dl *= real[:, None] / count
    grad = {k: np.zeros_like(v) for k, v in p.items()}
    grad["bias"] += dl.sum(axis=(0, 2))[:, None]
    for d, kept in (("f", f), ("b", b)):
        grad[f"{d}v"] += np.einsum("tkb,thb->kh", dl, kept["state"])
        _back(p, d, x, kept, p[f"{d}v"].T @ dl, grad)
    return loss, grad


def train(rows: list[tuple[bytes, str]], steps: int = STEPS, seed: int = 7) -> dict:
    """{"languages": [...], "weights": {...}} from (segment, language) rows; no rows give no languages."""
    languages = sorted({lang for _, lang in rows})
    rng = np.random.default_rng(seed)
    p = _weights(rng, max(1, len(languages)))
    if len(languages) > 1:
        x = np.concatenate([segments(s) for s, _ in rows])
        y = np.array([languages.index(lang) for _, lang in rows])
        first, second = ({k: np.zeros_like(v) for k, v in p.items()} for _ in range(2))
        step = 0
        while step < steps:
            order = rng.permutation(len(x))
            for at in range(0, len(x), BATCH)[:steps - step]:
                part = order[at:at + BATCH]
                _, grad = gradients(p, np.ascontiguousarray(x[part].T), y[part])
                step += 1
                rate = 0.03 * (1 - 0.9 * step / steps)
                norm = max(1.0, float(np.sqrt(sum((g * g).sum() for g in grad.values()))) / 1.0)
                for k, g in grad.items():
                    g = g / norm
                    first[k] = 0.9 * first[k] + 0.1 * g
                    second[k] = 0.99 * second[k] + 0.01 * g * g
                    p[k] -= rate * (first[k] / (1 - 0.9 ** step)) / (np.sqrt(second[k] / (1 - 0.99 ** step)) + 1e-8)
    return {"languages": languages, "weights": p}


class Labeller:
    """Position labels of many segments at once; the same network as ``_read``, with its buffers reused."""

    def __init__(self, model: dict):
        p, h = model["weights"], HIDDEN
        self.k = len(p["bias"])
        self.dirs = {}
        for d in "fb":
            w, u = (p[f"{d}w"] + p[f"{d}c"]).T, p[f"{d}u"].T
            at = [slice(0, h), slice(h, 2 * h), slice(2 * h, 3 * h)]
            # the half of gate r goes into the weights of what it multiplies
            self.dirs[d] = ([np.ascontiguousarray(w[:, a]) for a in at],
                            [np.ascontiguousarray(u[:, a] * (1.0 if i < 2 else 0.5), dtype=np.float32) for i, a in enumerate(at)])
        self.v = p["fv"], p["bv"]
        self.bias = p["bias"]

    def _step(self, d: str, x: np.ndarray, state: np.ndarray, out: np.ndarray, buf) -> None:
        (wz, wr, wn), (uz, ur, un) = self.dirs[d]
        r, a, b = buf

        def squash(v):
            np.abs(v, out=b)
            np.add(b, 1.0, out=b)
            np.divide(v, b, out=v)

        np.take(wr, x, axis=0, out=r, mode="clip")
        np.matmul(state, ur, out=a)
        r += a
        squash(r)
        r += 1.0
        np.matmul(state, un, out=a)
        a *= r
        np.take(wn, x, axis=0, out=r, mode="clip")
        r += a
        squash(r)                                    # r is the candidate now
        np.take(wz, x, axis=0, out=out, mode="clip")
        np.matmul(state, uz, out=a)
        out += a
        squash(out)
        out += 1.0
        out *= 0.5
        np.subtract(state, r, out=a)
        out *= a
        out += r

    def sums(self, x: np.ndarray, real: np.ndarray) -> np.ndarray:
        """(languages, batch): probabilities summed over the real positions; x, real (positions, batch)."""
        steps, batch = x.shape
        buf = [np.empty((batch, HIDDEN), np.float32) for _ in range(3)]
        states = np.empty((steps + 1, batch, HIDDEN), np.float32)
        states[0] = 0
        for t in range(steps):
            self._step("f", x[t], states[t], states[t + 1], buf)
        back, nxt = np.zeros((batch, HIDDEN), np.float32), np.empty((batch, HIDDEN), np.float32)
        total = np.zeros((self.k, batch), np.float32)
        for t in range(steps - 1, -1, -1):
            self._step("b", x[t], back, nxt, buf)
            back, nxt = nxt, back
            label = self.v[0] @ states[t + 1].T
            label += self.v[1] @ back.T
            label += self.bias
            label -= label.max(axis=0)
            np.maximum(label, -30.0, out=label)  # keeps denormal numbers, which are slow, out of exp
            np.exp(label, out=label)
            label *= real[t] / label.sum(axis=0)
            total += label
        return total


def predict(model: dict, labeller: Labeller, texts: list[str | None]) -> tuple[list[str], list[float]]:
    """(language, probability) of whole texts."""
    lang, score = [UNKNOWN] * len(texts), [0.0] * len(texts)
    if not model["languages"]:
        return lang, score
    which = [i for i, t in enumerate(texts) if t and has_letter(t)]
    if not which:
        return lang, score
    data = [texts[i].encode() for i in which]
    x = np.concatenate([segments(d) for d in data])
    size = np.array([len(d) for d in data])
    many = -(-size // SEGMENT)
    last = np.cumsum(many) - 1
    length = np.full(len(x), SEGMENT)
    length[last] = size - (many - 1) * SEGMENT
    sums = np.empty((labeller.k, len(x)))
    for at in range(0, len(x), AT_ONCE):
        part = np.ascontiguousarray(x[at:at + AT_ONCE].T).astype(np.intp)
        real = (np.arange(SEGMENT)[:, None] < length[None, at:at + AT_ONCE]).astype(np.float32)
        sums[:, at:at + AT_ONCE] = labeller.sums(part, real)
    total = np.add.reduceat(sums, last - many + 1, axis=1) / size
    best = total.argmax(axis=0)
    for j, i in enumerate(which):
        lang[i], score[i] = model["languages"][best[j]], float(min(1.0, max(0.0, total[best[j], j])))
    return lang, score


def training_rows(documents: DataFrame) -> list[tuple[bytes, str]]:
    """The bounded sample of labelled segments, to the driver.

    A count per language sets how small a hash has to be for about
    ``MARGIN * DOCS_PER_LANGUAGE`` rows to pass; only those are ranked.
    """
    docs = documents.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"),
                            F.col("lang").cast("string").alias("lang"), F.xxhash64(F.col("doc_id").cast("long")).alias("hash"))
    labelled = docs.filter(F.col("doc_id").isNotNull() & F.col("lang").isNotNull() & ~held_out(F.col("doc_id")))
    if labelled.select("lang").distinct().limit(MAX_LANGUAGES + 1).count() > MAX_LANGUAGES:
        raise ValueError(f"lang has more than {MAX_LANGUAGES} values: not a column of languages")
    # one row per language, of which there are at most MAX_LANGUAGES
    counts = labelled.groupBy("lang").agg((MARGIN * DOCS_PER_LANGUAGE / F.count("*")).alias("share"))
    place = F.col("hash") / float(2 ** 64) + 0.5  # from 0 to 1
    near = (labelled.join(F.broadcast(counts), "lang").filter(place <= F.col("share"))
            .filter(F.col("text").isNotNull() & F.col("text").rlike(r"\p{L}")).withColumn("data", F.encode("text", "UTF-8")))
    n = F.greatest(F.lit(1), F.floor(F.octet_length("data") / SEGMENT).cast("int"))
    take = F.least(n, F.lit(SEGMENTS_PER_DOC))
    spots = F.transform(F.sequence(F.lit(0), take - 1), lambda i: F.floor(i * n / take).cast("int") * SEGMENT + 1)
    cut = near.select("lang", "doc_id", "hash", F.transform(spots, lambda s: F.substring("data", s, F.lit(SEGMENT))).alias("s"))
    pick = W.partitionBy("lang").orderBy("hash", "doc_id")
    chosen = cut.withColumn("nth", F.row_number().over(pick)).filter(F.col("nth") <= DOCS_PER_LANGUAGE)
    return sorted((bytes(s), r["lang"]) for r in chosen.select("s", "lang").collect() for s in r["s"])


def model_of(documents: DataFrame) -> dict:
    return train(training_rows(documents))


def identify(documents: DataFrame, model: dict) -> DataFrame:
    """doc_id, held_out, lang_pred, score of every row."""
    ship_package(documents.sparkSession)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        labeller = Labeller(model)
        for batch in batches:
            for part in some(batch, text=2):
                lang, score = predict(model, labeller, part.column(2).to_pylist())
                yield pa.RecordBatch.from_arrays([part.column(0), part.column(1), pa.array(lang, pa.string()),
                                                  pa.array(score, pa.float64())],
                                                 names=[f.split()[0] for f in PREDICTED.split(", ")])

    rows = documents.select(F.col("doc_id").cast("long").alias("doc_id"), held_out(F.col("doc_id")).alias("held_out"),
                            F.col("text").cast("string").alias("text"))
    return rows.mapInArrow(run, PREDICTED)


def keep_identified(documents: DataFrame, model: dict, least: float) -> DataFrame:
    """Rows of ``documents`` (all columns) whose language is known with a score of ``least`` or more.

    A model that has learned no language can reject none: then all rows whose text has a letter stay.
    """
    ship_package(documents.sparkSession)
    if not model["languages"]:
        return documents.filter(F.col("text").cast("string").rlike(r"\p{L}"))
    at = documents.columns.index("text")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        labeller = Labeller(model)
        for batch in batches:
            for part in some(batch, text=at):
                lang, score = predict(model, labeller, part.column(at).to_pylist())
                yield part.filter(pa.array([a != UNKNOWN and s >= least for a, s in zip(lang, score, strict=True)]))

    return documents.mapInArrow(run, documents.schema)
