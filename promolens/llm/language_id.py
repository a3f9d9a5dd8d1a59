"""Language identification by a bidirectional gated recurrent network over bytes, in numpy."""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from promolens.llm.common import text_bytes

UNDETERMINED = "und"
SAMPLE_ROWS = 4000  # most labelled rows that training reads; a row is a window of a text
SAMPLE_BYTES = 256  # bytes of a window; the windows of a text cover all of it
TRAIN_STEPS = 64
WINDOW = 128
LANES = 1024


@dataclass
class Network:
    """Weights; [0] reads forwards, [1] backwards. Gates lie side by side: update, reset, new."""

    languages: list[str]
    byte_in: np.ndarray  # (2, 256, 3h)
    state_in: np.ndarray  # (2, h, 3h)
    bias: np.ndarray  # (2, 3h), added to the state's part
    out: np.ndarray  # (2h, languages)
    out_bias: np.ndarray

    def weights(self) -> list[np.ndarray]:
        return [self.byte_in, self.state_in, self.bias, self.out, self.out_bias]


def new_network(languages: list[str], hidden: int, seed: int) -> Network:
    draw = np.random.default_rng(seed)
    scale = 1 / np.sqrt(hidden)
    return Network(
        languages,
        draw.normal(0, 0.3, (2, 256, 3 * hidden)).astype(np.float32),
        draw.uniform(-scale, scale, (2, hidden, 3 * hidden)).astype(np.float32),
        np.zeros((2, 3 * hidden), np.float32),
        draw.normal(0, scale, (2 * hidden, len(languages))).astype(np.float32),
        np.zeros(len(languages), np.float32),
    )


def _step(side: np.ndarray, state: np.ndarray, state_in: np.ndarray, bias: np.ndarray):
    """One step of a gated recurrent unit. side: the byte's part. Returns all that it made."""
    h = state.shape[1]
    fed = state @ state_in + bias
    gates = np.tanh((side[:, : 2 * h] + fed[:, : 2 * h]) * np.float32(0.5))
    gates *= np.float32(0.5)
    gates += np.float32(0.5)
    new = np.tanh(side[:, 2 * h :] + gates[:, h:] * fed[:, 2 * h :])
    state = new + gates[:, :h] * (state - new)
    return gates, new, fed[:, 2 * h :], state


def _states(net: Network, window: np.ndarray, keep: list | None = None) -> np.ndarray:
    """(steps, lanes, 2h) states of both directions for windows of bytes (lanes, steps)."""
    lanes, steps = window.shape
    h = net.state_in.shape[1]
    states = np.empty((steps, lanes, 2 * h), np.float32)
    columns = np.ascontiguousarray(window.T)
    for side in (0, 1):
        state = np.zeros((lanes, h), np.float32)
        for t in range(steps) if side == 0 else range(steps - 1, -1, -1):
            before = state
            fed = np.take(net.byte_in[side], columns[t], axis=0)
            made = _step(fed, state, net.state_in[side], net.bias[side])
            state = made[3]
            states[t, :, side * h : (side + 1) * h] = state
            if keep is not None:
                keep.append((side, t, before, *made[:3]))
    return states


def _softmax(logits: np.ndarray) -> np.ndarray:
    e = np.exp(logits - logits.max(axis=-1, keepdims=True))
    return e / e.sum(axis=-1, keepdims=True)


def position_probabilities(net: Network, window: np.ndarray) -> np.ndarray:
    """(languages, steps, lanes): the label probabilities of every position."""
    lanes, steps = window.shape
    states = _states(net, window).reshape(steps * lanes, -1)
    # One row a language: the maximum and the sum then run over whole rows.
    e = net.out.T @ states.T
    e += net.out_bias[:, None]
    e -= e.max(axis=0)
    np.exp(e, out=e)
    e /= e.sum(axis=0)
    return e.reshape(-1, steps, lanes)


def gradients(net: Network, window: np.ndarray, labels: np.ndarray, used: np.ndarray):
    """Mean cross entropy over the used positions and its gradients, back through time."""
    keep: list = []
    lanes, steps = window.shape
    h = net.state_in.shape[1]
    states = _states(net, window, keep)
    probs = _softmax(states @ net.out + net.out_bias)
    weight = (used.T / max(used.sum(), 1)).astype(np.float32)  # (steps, lanes)
    picked = probs[:, np.arange(lanes), labels]
    loss = float(-(np.log(picked + 1e-9) * weight).sum())
    error = probs.copy()
    error[:, np.arange(lanes), labels] -= 1
    error *= weight[:, :, None]
    flat_error, flat_states = error.reshape(-1, error.shape[2]), states.reshape(-1, 2 * h)
    grads = [np.zeros_like(w) for w in net.weights()]
    grads[3], grads[4] = flat_states.T @ flat_error, flat_error.sum(axis=0)
    above = error @ net.out.T  # (steps, lanes, 2h)
    back = np.zeros((lanes, h), np.float32)
    last = None
    for side, t, before, gates, new, fed_new in reversed(keep):
        if side != last:
            back, last = np.zeros((lanes, h), np.float32), side
        update, reset = gates[:, :h], gates[:, h:]
        d = above[t, :, side * h : (side + 1) * h] + back
        d_new = d * (1 - update) * (1 - new * new)
        d_update = d * (before - new) * update * (1 - update)
        d_reset = d_new * fed_new * reset * (1 - reset)
        d_side = np.concatenate([d_update, d_reset, d_new], axis=1)
        d_fed = np.concatenate([d_update, d_reset, d_new * reset], axis=1)
        np.add.at(grads[0][side], window[:, t], d_side)
        grads[1][side] += before.T @ d_fed
        grads[2][side] += d_fed.sum(axis=0)
        back = d * update + d_fed @ net.state_in[side].T
    return loss, grads


def train(
    samples: list[tuple[bytes, str]],
    hidden: int = 8,
    epochs: int = 6,
    min_steps: int = 750,
    batch: int = 128,
    rate: float = 0.01,
    seed: int = 7,
) -> Network:
    """Fit a network with Adam to (bytes, language). Texts are cut into windows.

    Small samples are read more than ``epochs`` times, until there are ``min_steps`` steps.
    """
    languages = sorted({lang for _, lang in samples})
    net = new_network(languages, hidden, seed)
    pieces = [
        (data[at : at + TRAIN_STEPS], languages.index(lang))
        for data, lang in samples
        for at in range(0, len(data), TRAIN_STEPS)
        if len(data) - at >= min(16, len(data))
    ]
    window = np.zeros((len(pieces), TRAIN_STEPS), np.uint8)
    used = np.zeros((len(pieces), TRAIN_STEPS), bool)
    for i, (data, _) in enumerate(pieces):
        window[i, : len(data)] = np.frombuffer(data, np.uint8)
        used[i, : len(data)] = True
    labels = np.array([label for _, label in pieces], np.int64)
    draw = np.random.default_rng(seed)
    first = [np.zeros_like(w) for w in net.weights()]
    second = [np.zeros_like(w) for w in net.weights()]
    step = 0
    each = -(-len(pieces) // batch)
    if each:
        epochs = max(epochs, -(-min_steps // each))
    total = epochs * each
    for _ in range(epochs):
        order = draw.permutation(len(pieces))
        for at in range(0, len(order), batch):
            pick = order[at : at + batch]
            _, grads = gradients(net, window[pick], labels[pick], used[pick])
            step += 1
            now = rate * (1 - (step - 1) / total)
            for w, g, m, v in zip(net.weights(), grads, first, second, strict=True):
                m += 0.1 * (g - m)
                v += 0.01 * (g * g - v)
                w -= now * (m / (1 - 0.9**step)) / (np.sqrt(v / (1 - 0.99**step)) + 1e-8)
    return net


def is_held_out(key: Column) -> Column:
    """True for the third of keys that training never reads; false for NULL."""
    return F.coalesce(F.pmod(F.crc32(key.cast("string")), F.lit(3)) == 1, F.lit(False))


def fit(
    docs: DataFrame,
    key: str = "doc_id",
    text: str = "text",
    lang: str = "lang",
    sample_rows: int = SAMPLE_ROWS,
    **settings,
) -> Network:
    """Train on at most ``sample_rows`` labelled rows outside the held-out third.

    Whole texts are cut into windows of SAMPLE_BYTES, each a row with its text's label, and the
    rows with the smallest hashes of key and place are taken, from wherever they stand. A bound
    on the hash, from the number of windows, leaves about twice as many to choose from. Texts
    that are NULL or empty have no window, and equal rows have equal ones.
    """
    labelled = docs.where(
        F.col(key).isNotNull() & F.col(lang).isNotNull() & ~is_held_out(F.col(key))
    ).select(
        F.col(key).alias("k"), F.col(lang).cast("string").alias("lang"),
        text_bytes(text).alias("data"),
    )
    windows = F.ceil(F.octet_length("data") / SAMPLE_BYTES)
    total = labelled.agg(F.sum(windows)).first()[0] or 0
    share = min(1.0, (2 * sample_rows + 200) / max(1, total))
    bound = min(int((2 * share - 1) * 2**63), 2**63 - 1)
    # Windows are chosen by number before any bytes are copied.
    chosen = F.filter(
        F.sequence(F.lit(0).cast("long"), windows - 1), lambda i: F.xxhash64("k", i) <= bound
    )
    cut = F.transform(
        chosen,
        lambda i: F.struct(
            F.xxhash64("k", i).alias("h"),
            F.substring(
                F.col("data"), (i * SAMPLE_BYTES + 1).cast("int"), F.lit(SAMPLE_BYTES)
            ).alias("data"),
        ),
    )
    rows = (
        labelled.where(F.octet_length("data") > 0)
        .select("lang", F.explode(cut).alias("w"))
        .select("w.h", "w.data", "lang")
        .orderBy("h", "data", "lang")
        .limit(sample_rows)
    )
    samples = [(bytes(r["data"]), r["lang"]) for r in rows.collect()]
    return train(samples, **settings)


def document_probabilities(net: Network, texts: list[bytes]) -> np.ndarray:
    """Mean position probabilities of each text. Every byte of every text is labelled.

    Texts are cut into windows that all go through the network side by side; the last one of a
    text is filled up with zero bytes, which are read but not counted.
    """
    sizes = np.array([len(t) for t in texts], np.int64)
    pieces = -(-sizes // WINDOW)
    owner = np.repeat(np.arange(len(texts)), pieces)
    window = np.zeros((len(owner), WINDOW), np.uint8)
    left = np.empty(len(owner), np.int64)
    row = 0
    for text, n in zip(texts, pieces.tolist(), strict=True):
        flat = np.frombuffer(text, np.uint8)
        window[row : row + n].reshape(-1)[: len(flat)] = flat
        left[row : row + n] = np.minimum(len(flat) - np.arange(n) * WINDOW, WINDOW)
        row += n
    total = np.zeros((len(texts), len(net.languages)))
    for at in range(0, len(owner), LANES):
        part = slice(at, at + LANES)
        probs = position_probabilities(net, window[part])
        probs *= np.arange(WINDOW)[:, None] < left[part]
        np.add.at(total, owner[part], probs.sum(axis=1, dtype=np.float64).T)
    return total / np.maximum(sizes, 1)[:, None]


def has_letter(text: bytes | None) -> bool:
    return text is not None and any(map(str.isalpha, text.decode()))


def predict(
    docs: DataFrame, net: Network, key: str = "doc_id", text: str = "text"
) -> DataFrame:
    """Every column of ``docs`` with ``held_out``, ``lang_pred`` and ``score`` (0 to 1).

    A text that is NULL or has no letter gets ``und`` with score 0, as does every text if there
    was nothing to learn from. Columns of those three names are replaced. Only the text is an
    input of the network. Texts of any length are read whole, of languages that tie the first by
    name counts, repeated rows fare alike, and an empty table gives an empty one.
    """
    languages = net.languages

    def run(batches):
        import pyarrow as pa

        for batch in batches:
            texts = batch.column("_data").to_pylist()
            known = [i for i, t in enumerate(texts) if languages and has_letter(t)]
            names, scores = [UNDETERMINED] * len(texts), [0.0] * len(texts)
            probs = document_probabilities(net, [texts[i] for i in known])
            for i, p in zip(known, probs, strict=True):
                best = int(p.argmax())
                names[i], scores[i] = languages[best], float(min(max(p[best], 0.0), 1.0))
            kept = [n for n in batch.schema.names if n != "_data"]
            yield pa.RecordBatch.from_arrays(
                [*(batch.column(n) for n in kept), pa.array(names), pa.array(scores)],
                [*kept, "lang_pred", "score"],
            )

    rows = docs.drop("held_out", "lang_pred", "score", "_data").withColumn(
        "held_out", is_held_out(F.col(key))
    )
    schema = StructType([*rows.schema.fields]).add("lang_pred", "string").add("score", "double")
    return rows.withColumn("_data", F.col(text).cast("binary")).mapInArrow(run, schema)
