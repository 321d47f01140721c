"""Language identification with a bidirectional gated recurrent network over bytes.

Two recurrent layers read the bytes of a piece of text, one from each side; from their states at
a byte the language of that position is predicted, and the document's probabilities are the
means over all its positions. The network is trained in numpy by backpropagation through
time on a bounded sample of labelled stretches; every text is then read whole.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tallyfield.llm.common import given_id, own_id, raw, slices

UNKNOWN = "und"
#: Texts are read in pieces of so many bytes, each from a fresh state.
PIECE = 256
#: Pieces that are read side by side; their states take some 30 MB.
LANES = 512
#: The sample: stretches at most for one language and for all, and characters of a stretch.
PER_LANGUAGE, SAMPLE, STRETCH = 400, 8000, 1000
UNITS, STEPS, BATCH, TRAIN_PIECE = 8, 400, 128, 64


def _sigmoid(x: np.ndarray) -> np.ndarray:
    return 1 / (1 + np.exp(-x))


class Layer:
    """One direction: a table of input terms by byte and the recurrent weights."""

    def __init__(self, units: int, random: np.random.Generator):
        self.table = (random.normal(size=(256, 3 * units)) * 0.3).astype(np.float32)
        self.turn = (random.normal(size=(units, 3 * units)) / np.sqrt(units)).astype(np.float32)

    @property
    def weights(self) -> list[np.ndarray]:
        return [self.table, self.turn]

    def read(self, data: np.ndarray, active: np.ndarray, backward: bool, keep: list | None = None) -> np.ndarray:
        """States by position and lane. Lanes are sorted by falling length; ``active[t]`` reach position t."""
        length, lanes = data.shape
        k = self.turn.shape[0]
        states = np.zeros((length, lanes, k), np.float32)
        h = np.zeros((lanes, k), np.float32)
        for t in range(length - 1, -1, -1) if backward else range(length):
            n = active[t]
            old = h[:n]
            x, u = self.table[data[t, :n]], old @ self.turn
            gates = _sigmoid(x[:, : 2 * k] + u[:, : 2 * k])
            z, r = gates[:, :k], gates[:, k:]
            new = np.tanh(x[:, 2 * k :] + r * u[:, 2 * k :])
            if keep is not None:
                keep.append((t, old.copy(), z, r, new, u[:, 2 * k :]))
            h[:n] = new + z * (old - new)
            states[t, :n] = h[:n]
        return states

    def gradients(self, data: np.ndarray, keep: list, outer: np.ndarray) -> list[np.ndarray]:
        """Backpropagation through time of the gradients ``outer`` of the states."""
        k = self.turn.shape[0]
        d_turn, back = np.zeros_like(self.turn), np.zeros_like(outer[0])
        d_input = np.zeros((*outer.shape[:2], 3 * k), np.float32)
        for t, old, z, r, new, u in reversed(keep):
            d = outer[t] + back
            d_new = d * (1 - z) * (1 - new * new)
            d_z = d * (old - new) * z * (1 - z)
            d_r = d_new * u * r * (1 - r)
            d_u = np.concatenate([d_z, d_r, d_new * r], axis=1)
            d_input[t] = np.concatenate([d_z, d_r, d_new], axis=1)
            d_turn += old.T @ d_u
            back = d * z + d_u @ self.turn.T
        flat = data.ravel()
        order = np.argsort(flat, kind="stable")
        begin = np.flatnonzero(np.diff(flat[order], prepend=-1))
        d_table = np.zeros_like(self.table)
        d_table[flat[order][begin]] = np.add.reduceat(d_input.reshape(-1, 3 * k)[order], begin)
        return [d_table, d_turn]


class Network:
    def __init__(self, languages: list[str], units: int = UNITS, seed: int = 5):
        random = np.random.default_rng(seed)
        self.languages = languages
        self.layers = [Layer(units, random), Layer(units, random)]
        self.out = (random.normal(size=(2 * units, len(languages))) * 0.3).astype(np.float32)
        self.bias = np.zeros(len(languages), np.float32)

    @property
    def weights(self) -> list[np.ndarray]:
        return [*self.layers[0].weights, *self.layers[1].weights, self.out, self.bias]

    def probabilities(self, data: np.ndarray, active: np.ndarray, keep: tuple[list, list] | None = None) -> tuple[np.ndarray, np.ndarray]:
        """Language probabilities and states by position and lane."""
        states = np.concatenate([layer.read(data, active, side == 1, keep and keep[side]) for side, layer in enumerate(self.layers)], axis=2)
        logits = states @ self.out + self.bias
        logits -= logits.max(axis=2, keepdims=True)
        np.exp(logits, out=logits)
        logits /= logits.sum(axis=2, keepdims=True)
        return logits, states

    def fit(self, data: np.ndarray, labels: np.ndarray, steps: int = STEPS, batch: int = BATCH, rate: float = 0.02, seed: int = 6) -> Network:
        """Adam on the cross-entropy of every position; ``data`` holds one piece in each row."""
        random = np.random.default_rng(seed)
        first, second = [np.zeros_like(w) for w in self.weights], [np.zeros_like(w) for w in self.weights]
        by_language = [np.flatnonzero(labels == i) for i in range(len(self.languages))]
        for step in range(1, steps + 1):
            pick = np.concatenate([random.choice(rows, -(-batch // len(by_language))) for rows in by_language if len(rows)])
            x, y = np.ascontiguousarray(data[pick].T), labels[pick]
            keep: tuple[list, list] = ([], [])
            p, states = self.probabilities(x, np.full(len(x), len(y)), keep)
            p[:, np.arange(len(y)), y] -= 1
            p /= p.shape[0] * p.shape[1]
            flat_p, flat_s = p.reshape(-1, p.shape[2]), states.reshape(-1, states.shape[2])
            outer = p @ self.out.T
            k = outer.shape[2] // 2
            found = [g for side, layer in enumerate(self.layers) for g in layer.gradients(x, keep[side], outer[:, :, side * k : (side + 1) * k])]
            found += [flat_s.T @ flat_p, flat_p.sum(axis=0)]
            size = np.sqrt(sum(float((g * g).sum()) for g in found))
            now = rate * (1 - step / (steps + 1))
            for w, g, m, v in zip(self.weights, found, first, second):
                g = g / max(1.0, size)
                m += 0.1 * (g - m)
                v += 0.01 * (g * g - v)
                w -= (now * (m / (1 - 0.9**step)) / (np.sqrt(v / (1 - 0.99**step)) + 1e-8)).astype(np.float32)
        return self

    def pooled(self, data: np.ndarray, offsets: np.ndarray) -> np.ndarray:
        """Mean probabilities over all positions of each text; empty texts have zeros."""
        sizes = np.diff(offsets)
        pieces = -(-sizes // PIECE)
        row = np.repeat(np.arange(len(sizes)), pieces)
        turn = np.arange(len(row)) - np.repeat(np.cumsum(pieces) - pieces, pieces)
        start = offsets[row] + turn * PIECE
        length = np.minimum(PIECE, offsets[row + 1] - start)
        order = np.argsort(-length, kind="stable")
        row, start, length = row[order], start[order], length[order]
        sums = np.zeros((len(sizes), len(self.languages)))
        for at in range(0, len(row), LANES):
            r, s, n = row[at : at + LANES], start[at : at + LANES], length[at : at + LANES]
            place = s + np.arange(n[0])[:, None]
            active = np.searchsorted(-n, -np.arange(n[0]), side="left")
            p, _ = self.probabilities(data[np.minimum(place, len(data) - 1)], active)
            p *= (np.arange(n[0])[:, None] < n)[:, :, None]
            total = p.sum(axis=0, dtype=np.float64)
            for i in range(len(self.languages)):
                sums[:, i] += np.bincount(r, total[:, i], len(sizes))
        return sums / np.maximum(sizes, 1)[:, None]


def sample(labelled: DataFrame, text_column: str = "text", label_column: str = "lang", id_column: str = "doc_id") -> list[tuple[str, str]]:
    """(language, stretch): a bounded sample, even over languages, the same on every run.

    At most ``PER_LANGUAGE`` rows of a language and about ``SAMPLE`` in all, the first in hash order, and of each a
    stretch of ``STRETCH`` characters from a hashed place. Languages are counted over all rows.
    """
    rows = labelled.select(F.col(label_column).cast("string").alias("_lang"), F.col(text_column).cast("string").alias("_text"), F.xxhash64(id_column, text_column).alias("_h"))
    rows = rows.where("_lang is not null and rlike(_text, '\\\\p{L}')")
    counts = {r["_lang"]: r["count"] for r in rows.groupBy("_lang").count().collect()}
    if not counts:
        return []
    each = max(1, min(PER_LANGUAGE, SAMPLE // len(counts)))
    share = F.create_map(*[x for k, n in sorted(counts.items()) for x in (F.lit(k), F.lit(min(1.0, 2 * each / n)))])
    place = F.col("_h").bitwiseAND(F.lit(0xFFFFFFFF)) / F.lit(float(2**32)) * F.greatest(F.length("_text") - STRETCH, F.lit(0)) + 1
    drawn = (
        rows.where(F.pmod(F.col("_h"), F.lit(1_000_003)) < share[F.col("_lang")] * 1_000_003)
        .select("_lang", "_h", F.substring("_text", place.cast("int"), F.lit(STRETCH)).alias("_text"))
        .collect()
    )
    drawn.sort(key=lambda r: (r["_lang"], r["_h"], r["_text"]))
    held: dict[str, int] = {}
    out = []
    for r in drawn:
        held[r["_lang"]] = held.get(r["_lang"], 0) + 1
        if held[r["_lang"]] <= each:
            out.append((r["_lang"], r["_text"]))
    return out


def train(labelled: DataFrame, text_column: str = "text", label_column: str = "lang", id_column: str = "doc_id") -> Network:
    """A network fitted on a bounded sample; without labelled rows it knows no language."""
    drawn = sample(labelled, text_column, label_column, id_column)
    languages = sorted({language for language, _ in drawn})
    network = Network(languages)
    data, labels = [], []
    for language, text in drawn:
        content = np.frombuffer(text.encode(), np.uint8)
        short = max(1, -(-TRAIN_PIECE // max(1, len(content))))
        content = np.tile(content, short) if len(content) < TRAIN_PIECE else content
        n = len(content) // TRAIN_PIECE
        data.append(content[: n * TRAIN_PIECE].reshape(n, TRAIN_PIECE))
        labels.append(np.full(n, languages.index(language)))
    return network.fit(np.concatenate(data), np.concatenate(labels)) if len(languages) > 1 else network


def identify(docs: DataFrame, network: Network, id_column: str = "doc_id", text_column: str = "text") -> DataFrame:
    """One row per row of ``docs``: _id, _tx, lang_pred, score.

    ``score`` is the pooled probability of ``lang_pred``. A text that is NULL or has no letter is ``und``
    with score 0, as is every text for a network without languages; with one language all others
    are that one. Ties go to the first language by name. Rows are independent.
    """

    def each(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches, "_text", 1_000_000):
            data, offsets = raw(batch.column("_text"))
            p = network.pooled(data, offsets) if network.languages else np.zeros((batch.num_rows, 1))
            names = network.languages or [UNKNOWN]
            letters = np.array([any(map(str.isalpha, t)) for t in batch.column("_text").to_pylist()], bool) & bool(network.languages)
            best = p.argmax(axis=1)
            score = np.where(letters, np.clip(p[np.arange(len(p)), best], 0, 1), 0.0)
            yield pa.RecordBatch.from_arrays(
                [batch.column("_id"), batch.column("_tx"), pa.array([names[b] if ok else UNKNOWN for b, ok in zip(best, letters)], pa.string()), pa.array(score)],
                names=["_id", "_tx", "lang_pred", "score"],
            )

    text = F.coalesce(F.col(text_column).cast("string"), F.lit(""))
    rows = docs.select(own_id(id_column).alias("_id"), F.xxhash64(text).alias("_tx"), text.alias("_text"))
    return rows.mapInArrow(each, "_id long, _tx long, lang_pred string, score double")


def held_out(id_column: str = "doc_id", folds: int = 5):
    """Whether crc32 of the id as text leaves remainder 0; a NULL id does not, nor is it learned from."""
    return F.crc32(F.col(id_column).cast("string")) % folds == 0


def language_report(docs: DataFrame) -> DataFrame:
    """doc_id, held_out, lang_pred, score, learned from the rows of ``docs`` that are not held out.

    A NULL or empty text and one without a letter are ``und`` with score 0; a NULL doc_id is not held out. Texts are read whole,
    however long. Rows are independent, so repeated rows repeat their result, and other columns are not looked at. Of languages
    with equal probability the first in order of name is given. Without a labelled row all texts are ``und``; an
    empty table gives an empty result.
    """
    network = train(docs.where(~held_out()))
    out = identify(docs, network)
    own = F.coalesce(F.crc32(given_id().cast("string")) % 5 == 0, F.lit(False))
    return out.select(given_id().alias("doc_id"), own.alias("held_out"), "lang_pred", "score")
