"""A small byte-level convolutional network for text quality, in numpy.

Learned filters read ``WIDTH`` bytes at every position of a text. Their highest responses in
each overlapping chunk of ``CHUNK`` bytes (a step is half a chunk, so every byte is in one) go
through a hidden layer to the chunk's logit; the mean and the extremes of the chunks' logits
make one probability. A text of any length is read whole.

Because a byte is one of 256, a filter is a table for each of its ``WIDTH`` places, and a response
a sum of look-ups. Training uses at most ``SAMPLE_ROWS`` labelled documents (a parameter), those with the
smallest hash of their id, each whole. Scoring is independent for each row.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from risklake.llm.language_id import held_out
from risklake.llm.words import blocks, utf8

WIDTH = 5
EMBEDDING = 8
FILTERS = 24
HIDDEN = 16
CHUNK = 256
SAMPLE_ROWS = 2_000
EPOCHS = 12
BATCH_DOCS = 48
THRESHOLD = 0.3
#: Positions whose responses are held at once, and in training, chunks.
TILE = 16_384
TILE_CHUNKS = 512


class Network:
    """Parameters, forward pass over whole texts, and training."""

    def __init__(self, seed: int = 7):
        rng = np.random.default_rng(seed)
        normal = lambda *shape, scale: rng.normal(0, scale, shape).astype(np.float32)
        self.p = {
            "embed": normal(256, EMBEDDING, scale=0.5),
            "conv": normal(WIDTH * EMBEDDING, FILTERS, scale=1 / np.sqrt(WIDTH * EMBEDDING)),
            "conv_b": np.zeros(FILTERS, np.float32),
            "dense": normal(FILTERS, HIDDEN, scale=1 / np.sqrt(FILTERS)),
            "dense_b": np.zeros(HIDDEN, np.float32),
            "out": normal(HIDDEN, scale=1 / np.sqrt(HIDDEN)),
            "out_b": np.zeros(1, np.float32),
            "mix": np.array([0.5, 0.25, 0.25, 0.0], np.float32),
        }

    def tables(self) -> np.ndarray:
        """Filter responses of each byte at each of the places: (WIDTH, 256, FILTERS)."""
        kernel = self.p["conv"].reshape(WIDTH, EMBEDDING, FILTERS)
        return np.stack([self.p["embed"] @ kernel[k] for k in range(WIDTH)]).astype(np.float32)

    def chunk_logits(self, pooled: np.ndarray) -> np.ndarray:
        hidden = np.maximum(pooled @ self.p["dense"] + self.p["dense_b"], 0)
        return hidden @ self.p["out"] + self.p["out_b"]

    def score(self, data: np.ndarray, offsets: np.ndarray) -> np.ndarray:
        """The probability of label 1 for each text of a block."""
        step, tables = CHUNK // 2, self.tables()
        size = np.diff(offsets)
        # Texts start at a multiple of a step and have WIDTH - 1 zero bytes behind them at least.
        # A response is of the bytes that end at its place, so none reads from another text.
        steps = -(-(size + WIDTH - 1) // step)
        first = np.concatenate([[0], np.cumsum(steps)]).astype(np.int64)
        padded = np.zeros(first[-1] * step + WIDTH - 1, np.uint8)
        shift = np.repeat(first[:-1] * step - offsets[:-1] + WIDTH - 1, size)
        padded[np.arange(len(data)) + shift] = data
        pooled = np.empty((first[-1], FILTERS), np.float32)
        for at in range(0, len(pooled), TILE // step):
            n = min(TILE // step, len(pooled) - at)
            span = padded[at * step : (at + n) * step + WIDTH - 1]
            response = tables[0][span[: n * step]]
            for k in range(1, WIDTH):
                response += tables[k][span[k : k + n * step]]
            pooled[at : at + n] = response.reshape(n, step, FILTERS).max(axis=1)
        pooled = np.maximum(pooled + self.p["conv_b"], 0)
        # A chunk is two steps; the last step of a text is a chunk with itself.
        last = np.zeros(len(pooled), bool)
        last[first[1:] - 1] = True
        following = np.where(last, np.arange(len(pooled)), np.arange(len(pooled)) + 1)
        # A last step that starts no chunk of its own is in the one before.
        logits = self.chunk_logits(np.maximum(pooled, pooled[following]))
        own = ~last
        own[first[:-1][steps == 1]] = True
        starts = np.concatenate([[0], np.cumsum(own)])[first[:-1]]
        logits = logits[own]
        count = np.diff(np.append(starts, len(logits)))
        mean = np.add.reduceat(logits, starts) / count if len(starts) else np.empty(0)
        least = np.minimum.reduceat(logits, starts) if len(starts) else np.empty(0)
        most = np.maximum.reduceat(logits, starts) if len(starts) else np.empty(0)
        a, b, c, d = self.p["mix"]
        return 1 / (1 + np.exp(-np.clip(a * mean + b * least + c * most + d, -30, 30).astype(float)))

    def fit(self, chunks: np.ndarray, doc: np.ndarray, labels: np.ndarray, epochs: int = EPOCHS, rate: float = 0.01, seed: int = 7) -> None:
        """Adam on the log loss. chunks: (m, CHUNK) bytes; doc: their documents, in order."""
        rng = np.random.default_rng(seed)
        bounds = np.searchsorted(doc, np.arange(len(labels) + 1))
        moments = {k: (np.zeros_like(v), np.zeros_like(v)) for k, v in self.p.items()}
        turn = 0
        for epoch in range(epochs):
            order = rng.permutation(len(labels))
            for at in range(0, len(order), BATCH_DOCS):
                some = order[at : at + BATCH_DOCS]
                count = bounds[some + 1] - bounds[some]
                rows = np.concatenate([np.arange(bounds[d], bounds[d + 1]) for d in some])
                grads = self._gradients(chunks[rows], count, labels[some])
                turn += 1
                lr = rate * (1 - 0.9 * epoch / epochs)
                for k, g in grads.items():
                    m, v = moments[k]
                    m += 0.1 * (g - m)
                    v += 0.01 * (g * g - v)
                    self.p[k] -= (lr * (m / (1 - 0.9**turn)) / (np.sqrt(v / (1 - 0.99**turn)) + 1e-7)).astype(np.float32)

    def _pooled(self, chunks: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Every filter's highest response in each chunk, and the place of it."""
        width, tables = CHUNK - WIDTH + 1, self.tables()
        most, where = [], []
        for at in range(0, len(chunks), TILE_CHUNKS):
            some = chunks[at : at + TILE_CHUNKS]
            response = tables[0][some[:, :width]]
            for k in range(1, WIDTH):
                response += tables[k][some[:, k : k + width]]
            place = response.argmax(axis=1)
            where.append(place)
            most.append(np.take_along_axis(response, place[:, None, :], 1)[:, 0])
        return np.concatenate(most), np.concatenate(where)

    def _gradients(self, chunks: np.ndarray, count: np.ndarray, labels: np.ndarray) -> dict[str, np.ndarray]:
        p = self.p
        starts = np.cumsum(count) - count
        pooled, where = self._pooled(chunks)
        pooled = pooled + p["conv_b"]
        active = pooled > 0
        pooled = pooled * active
        before = pooled @ p["dense"] + p["dense_b"]
        hidden = np.maximum(before, 0)
        z = hidden @ p["out"] + p["out_b"]
        mean = np.add.reduceat(z, starts) / count
        least, most = np.minimum.reduceat(z, starts), np.maximum.reduceat(z, starts)
        features = np.stack([mean, least, most, np.ones_like(mean)], axis=1)
        probability = 1 / (1 + np.exp(-np.clip(features @ p["mix"], -30, 30)))
        error = ((probability - labels) / len(labels)).astype(np.float32)
        of = np.repeat(np.arange(len(count)), count)
        dz = (error * p["mix"][0] / count)[of]
        dz += (error * p["mix"][1])[of] * (z == least[of]) + (error * p["mix"][2])[of] * (z == most[of])
        dbefore = (dz[:, None] * p["out"]) * (before > 0)
        dpooled = (dbefore @ p["dense"].T) * active
        dconv = np.zeros_like(p["conv"])
        dembed = np.zeros_like(p["embed"])
        # A filter learns from the bytes under its highest response only.
        kernel = p["conv"].reshape(WIDTH, EMBEDDING, FILTERS)
        filters = np.arange(FILTERS)[None, :]
        for at in range(0, len(chunks), TILE_CHUNKS):
            some, place, d = chunks[at : at + TILE_CHUNKS], where[at : at + TILE_CHUNKS], dpooled[at : at + TILE_CHUNKS]
            flat = np.arange(len(some))[:, None]
            for k in range(WIDTH):
                under = some[flat, place + k]
                dconv[k * EMBEDDING : (k + 1) * EMBEDDING] += np.einsum("mfe,mf->ef", p["embed"][under], d)
                weight = np.zeros((256, FILTERS), np.float32)
                np.add.at(weight, (under, filters), d)
                dembed += weight @ kernel[k].T
        return {
            "embed": dembed, "conv": dconv, "conv_b": dpooled.sum(axis=0), "dense": pooled.T @ dbefore,
            "dense_b": dbefore.sum(axis=0), "out": hidden.T @ dz, "out_b": dz.sum(keepdims=True),
            "mix": features.T @ error,
        }


def sample_chunks(docs: DataFrame, labels: DataFrame, id_col: str, text_col: str) -> list:
    """(id, label, chunks) of at most SAMPLE_ROWS labelled documents; the chunks hold the whole text. Of several texts
    of an id one is taken, the least by hash."""
    marked = labels.where("quality IN (0, 1)").groupBy(F.col(id_col).alias("id")).agg(F.max("quality").alias("label"))
    taught = marked.where(F.col("id").isNotNull() & ~held_out("id"))
    some = taught.orderBy(F.xxhash64("id"), "id").limit(SAMPLE_ROWS)

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            parts = []
            for text in batch.column("text").to_pylist():
                raw = (text or "").encode()
                n = max(1, -(-len(raw) // CHUNK))
                at = np.linspace(0, max(0, len(raw) - CHUNK), n).astype(int)
                parts.append(b"".join(raw[a : a + CHUNK].ljust(CHUNK, b"\0") for a in at))
            yield pa.record_batch({"id": batch.column("id"), "label": batch.column("label"), "chunks": pa.array(parts, pa.binary())})

    texts = docs.select(F.col(id_col).cast("long").alias("id"), F.col(text_col).alias("text"))
    chosen = texts.join(F.broadcast(some), "id").groupBy("id", "label").agg(
        F.min(F.struct(F.xxhash64("text"), "text")).alias("one")
    ).select("id", "label", "one.text")
    rows = chosen.mapInArrow(cut, "id long, label int, chunks binary")
    return sorted((r["id"], r["label"], bytes(r["chunks"])) for r in rows.collect())


def train(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> Network:
    """A network fitted on the sample; without labelled rows, one that gives label 1."""
    rows = sample_chunks(docs, labels, id_col, text_col)
    network = Network()
    if not rows:
        network.p["mix"] = np.array([0, 0, 0, 4], np.float32)
        return network
    chunks = np.frombuffer(b"".join(r[2] for r in rows), np.uint8).reshape(-1, CHUNK)
    doc = np.repeat(np.arange(len(rows)), [len(r[2]) // CHUNK for r in rows])
    network.fit(chunks, doc, np.array([r[1] for r in rows], np.float32))
    return network


def classify(docs: DataFrame, network: Network, text_col: str = "text") -> DataFrame:
    """All rows and columns of ``docs`` with score (0 to 1) and predicted (1 from THRESHOLD on).

    A null text scores as an empty one. Columns so named are replaced.
    """
    source = docs.drop("score", "predicted")
    kept = source.columns
    shared = docs.sparkSession.sparkContext.broadcast(network.p)  # some 10,000 numbers

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = Network()
        own.p = shared.value
        for batch in batches:
            for block in blocks(batch, text_col):
                score = own.score(*utf8(block.column(text_col)))
                yield pa.record_batch({n: block.column(n) for n in kept} | {
                    "score": pa.array(score), "predicted": pa.array((score >= THRESHOLD).astype(np.int32)),
                })

    schema = ", ".join([f"`{n}` {t}" for n, t in source.dtypes] + ["score double, predicted int"])
    return source.mapInArrow(run, schema)


def learn_and_classify(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per row of ``docs``: ``id_col``, held_out, score and predicted. Labels come only
    from rows that aren't held out; a null id is held out. Repeated labels of a document count
    once, the better one. Scores see the text only."""
    network = train(docs, labels, id_col, text_col)
    told = docs.select(F.col(id_col), F.col(text_col).alias("text"), F.coalesce(held_out(id_col), F.lit(True)).alias("held_out"))
    return classify(told, network).drop("text")
