"""Language identification by a bidirectional gated recurrent network over bytes, in numpy.

Bytes are fed one by one: ASCII letters in lower case and all bytes of other characters; everything
else becomes one gap.  Two gated recurrent layers read each lane forwards and backwards, an output
layer labels every position from both states, and a document's probabilities are the mean of those
of its letter positions.  Training is back-propagation through time with Adam on lanes of ``lane``
bytes; whole texts are scored in lanes of the same length, so no text is cut short and all texts of
a batch advance in step.

Training rows.  Labels are the non-null values of ``lang`` outside the held-out fold.  The network is
fitted on a bounded sample: about ``per_class`` rows of each label, those of least hash of the id (the
fraction comes from exact counts of all labels), twice that many in all at most.  Their whole texts
go to the driver, and lanes are drawn from any place of them.

Memory.  Texts are read in slices of about ``SLICE`` bytes; a longer text begins a new lane at each slice
and its slices are summed, so a worker holds arrays for slices, never for a whole batch or text.

Edge cases.  Null text, or text without a letter: ``und`` with score 0.  No labelled rows: ``und``
for all.  One label: that label.  Rows are scored one by one, repeated or not.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from cadastra.llm import _runtime as rt
from cadastra.llm import bytesops as bo

GAP = 32
_LETTER = np.zeros(256, bool)
_LETTER[97:123] = True
_LETTER[65:91] = True
_LETTER[128:] = True


def letters_only(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Lower-cased letter bytes with single gaps between runs, and the n+1 offsets."""
    low = bo.LOWER[data]
    letter = _LETTER[low]
    after = np.empty(len(low), bool)  # the byte before is a letter of the same text
    after[1:] = letter[:-1]
    if len(low):
        after[0] = False
        after[offsets[:-1][offsets[:-1] < len(low)]] = False
    keep = letter | after
    out = np.where(letter, low, np.uint8(GAP))[keep]
    return out, np.concatenate(([0], np.cumsum(keep)))[offsets]


def _sigmoid(x: np.ndarray) -> np.ndarray:
    x *= 0.5
    np.tanh(x, out=x)
    x *= 0.5
    x += 0.5
    return x


class Network:
    """Parameters by name; index 0 of the leading axis is the forward layer, 1 the backward one."""

    def __init__(self, labels: list[str], hidden: int, seed: int = 5):
        rng = np.random.Generator(np.random.PCG64(seed))
        h, k = hidden, max(1, len(labels))
        self.labels, self.hidden = labels, h
        normal = lambda *s, scale: rng.normal(0, scale, s).astype(np.float32)
        self.p = {
            "emb": normal(2, 256, 3 * h, scale=0.3),  # input weights of all gates, by byte
            "rec": normal(2, h, 2 * h, scale=0.3),  # update and reset gates
            "cand": normal(2, h, h, scale=0.3),
            "out": normal(2, h, k, scale=0.3),
            "bias": np.zeros(k, np.float32),
        }

    def states(self, lanes: np.ndarray, trace: list | None = None) -> np.ndarray:
        """Hidden states (2, steps, lanes, hidden) of lanes given as (steps, lanes) bytes."""
        t, n = lanes.shape
        h, p = self.hidden, self.p
        out = np.empty((2, t, n, h), np.float32)
        for way in range(2):
            s = np.zeros((n, h), np.float32)
            for i in range(t) if way == 0 else range(t - 1, -1, -1):
                x = p["emb"][way].take(lanes[i], axis=0)
                g = s @ p["rec"][way]
                g += x[:, : 2 * h]
                g = _sigmoid(g)
                z, r = g[:, :h], g[:, h:]
                c = (r * s) @ p["cand"][way]
                c += x[:, 2 * h :]
                np.tanh(c, out=c)
                new = c - s
                new *= z
                new += s
                if trace is not None:
                    trace.append((way, i, s, z, r, c))
                s = out[way, i] = new
        return out

    def positions(self, lanes: np.ndarray, states: np.ndarray | None = None) -> np.ndarray:
        """Label probabilities (steps, lanes, labels) of every position."""
        states = self.states(lanes) if states is None else states
        logit = states[0] @ self.p["out"][0]
        logit += states[1] @ self.p["out"][1]
        logit += self.p["bias"]
        np.exp(logit, out=logit)
        logit /= logit.sum(-1, keepdims=True)
        return logit

    def gradients(self, lanes: np.ndarray, label: np.ndarray) -> tuple[float, dict[str, np.ndarray]]:
        """Loss and gradients for lanes with one label each; gap positions carry no label."""
        t, n = lanes.shape
        h, p = self.hidden, self.p
        trace: list = []
        states = self.states(lanes, trace)
        prob = self.positions(lanes, states)
        used = (lanes != GAP)[:, :, None] / max(1, int((lanes != GAP).sum()))
        loss = float(-(np.log(prob[:, np.arange(n), label] + 1e-9) * used[:, :, 0]).sum())
        d = prob.copy()
        d[:, np.arange(n), label] -= 1
        d = (d * used).astype(np.float32)
        g = {k: np.zeros_like(v) for k, v in p.items()}
        g["bias"] = d.sum((0, 1))
        back = np.zeros((2, n, h), np.float32)
        for way in range(2):
            g["out"][way] = states[way].reshape(-1, h).T @ d.reshape(-1, d.shape[-1])
        for way, i, s, z, r, c in reversed(trace):
            ds = d[i] @ p["out"][way].T + back[way]
            dc = ds * z * (1 - c * c)
            dz = ds * (c - s) * z * (1 - z)
            drs = dc @ p["cand"][way].T
            dr = drs * s * r * (1 - r)
            gate = np.concatenate((dz, dr), 1)
            g["cand"][way] += (r * s).T @ dc
            g["rec"][way] += s.T @ gate
            np.add.at(g["emb"][way], lanes[i], np.concatenate((gate, dc), 1))
            back[way] = ds * (1 - z) + drs * r + gate @ p["rec"][way].T
        return loss, g


def fit(passages: list[tuple[bytes, str]], labels: list[str], *, hidden: int, lane: int, steps: int, batch: int, seed: int = 11) -> Network:
    """Train on (normalised bytes, label) passages; every label gets the same share of each batch."""
    net = Network(labels, hidden)
    rng = np.random.Generator(np.random.PCG64(seed))
    by_label = [[x for x, y in passages if y == k and x.strip()] for k in labels]
    by_label = [(k, xs) for k, xs in enumerate(by_label) if xs]
    if len(by_label) < 2:
        net.p["bias"][[k for k, _ in by_label]] = 20.0
        return net
    mean = {k: np.zeros_like(v) for k, v in net.p.items()}
    square = {k: np.zeros_like(v) for k, v in net.p.items()}
    for step in range(1, steps + 1):
        lanes, target = np.full((batch, lane), GAP, np.uint8), np.empty(batch, np.int64)
        for b in range(batch):
            k, xs = by_label[b % len(by_label)]
            x = xs[rng.integers(len(xs))]
            at = rng.integers(max(1, len(x) - lane + 1))
            piece = np.frombuffer(x[at : at + lane], np.uint8)
            lanes[b, : len(piece)], target[b] = piece, k
        _, grads = net.gradients(lanes.T.copy(), target)
        size = np.sqrt(sum(float((v * v).sum()) for v in grads.values()))
        rate = 0.02 * (1 - step / (steps + 1)) + 0.001
        for k, v in grads.items():
            v = v * min(1.0, 1.0 / (size + 1e-9))
            mean[k] = 0.9 * mean[k] + 0.1 * v
            square[k] = 0.99 * square[k] + 0.01 * v * v
            net.p[k] -= (rate * (mean[k] / (1 - 0.9**step)) / (np.sqrt(square[k] / (1 - 0.99**step)) + 1e-8)).astype(np.float32)
    return net


def _sums(net: Network, data: np.ndarray, offsets: np.ndarray, lane: int, width: int) -> tuple[np.ndarray, np.ndarray]:
    """Summed label probabilities of the letter positions of each text, and their number."""
    text, off = letters_only(data, offsets)
    n, k = len(off) - 1, len(net.labels)
    lanes_of = -(-np.diff(off) // lane)
    first = np.concatenate(([0], np.cumsum(lanes_of)))
    grid = np.full((first[-1], lane), GAP, np.uint8)
    shift = (first[:-1] * lane - off[:-1]).astype(np.int32)
    grid.reshape(-1)[np.arange(len(text), dtype=np.int32) + np.repeat(shift, np.diff(off))] = text
    total, seen = np.zeros((first[-1], k)), (grid != GAP).sum(1)
    for a in range(0, first[-1], width):
        block = np.ascontiguousarray(grid[a : a + width].T)
        prob = net.positions(block)
        total[a : a + width] = np.einsum("tnk,tn->nk", prob, (block != GAP).astype(np.float32))
    sums = np.concatenate((np.zeros((1, k)), np.cumsum(total, 0)))
    letters = np.concatenate(([0], np.cumsum(seen)))
    return sums[first[1:]] - sums[first[:-1]], letters[first[1:]] - letters[first[:-1]]


SLICE = 1 << 18


def pooled(net: Network, data: np.ndarray, offsets: np.ndarray, lane: int, width: int = 1024) -> tuple[np.ndarray, np.ndarray]:
    """Mean label probabilities of the letter positions of each text (zeros where there are none),
    and whether an ASCII letter occurs."""
    n = len(offsets) - 1
    total, seen, known = np.zeros((n, len(net.labels))), np.zeros(n, np.int64), np.zeros(n, bool)
    cuts, owner = bo.sliced(data, offsets, SLICE)
    for i, j in bo.pieces(cuts, SLICE):
        part, off, of = data[cuts[i] : cuts[j]], cuts[i : j + 1] - cuts[i], owner[i:j]
        plain = np.concatenate(([0], np.cumsum(_LETTER[part] & (part < 128), dtype=np.int32)))
        np.logical_or.at(known, of, plain[off[1:]] > plain[off[:-1]])
        if net.labels:
            sums, count = _sums(net, part, off, lane, width)
            np.add.at(total, of, sums)
            np.add.at(seen, of, count)
    return total / np.maximum(seen, 1)[:, None], known


def _has_letter(text: str) -> bool:
    return any(c.isalpha() for c in text)


def _predict_batches(shared, lane: int):
    def run(batches):
        net = shared.value
        for batch in batches:
            column = batch.column(2)
            data, offsets = bo.text_buffers(column)
            prob, known = pooled(net, data, offsets, lane)
            for i in np.flatnonzero(~known & (np.diff(offsets) > 0)):
                known[i] = _has_letter(column[int(i)].as_py())
            if net.labels:
                top = prob.argmax(1)
                lang = [net.labels[t] if k else "und" for t, k in zip(top, known, strict=True)]
                score = np.where(known, np.clip(prob[np.arange(len(top)), top], 0, 1), 0.0)
            else:
                lang, score = ["und"] * len(known), np.zeros(len(known))
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), pa.array(lang, pa.string()), pa.array(score)], names=["id", "held_out", "lang_pred", "score"])

    return run


def train(docs: DataFrame, *, modulus: int, held: int, id_col: str, text_col: str, lang_col: str, per_class: int, hidden: int, lane: int, steps: int, batch: int) -> Network:
    rows = docs.select(F.col(id_col).alias("id"), F.col(text_col).alias("text"), F.col(lang_col).alias("lang"))
    rows = rows.where((rt.bucket_of(F.col("id"), modulus) != held) & F.col("lang").isNotNull() & F.col("text").isNotNull())
    counts = {r.lang: r.n for r in rows.groupBy("lang").agg(F.count("*").alias("n")).collect()}
    labels = sorted(counts)
    if not labels:
        return Network([], hidden)
    draw = F.pmod(F.xxhash64("id", F.lit("langid")), F.lit(1_000_000))
    share = F.lit(0)
    for lang, n in counts.items():
        share = F.when(F.col("lang") == lang, int(min(1_000_000, 1_000_000 * per_class / n + 1))).otherwise(share)
    # ids of least hash first: which rows are taken does not depend on the layout of the files
    sample = rows.where(draw < share).orderBy(draw, F.xxhash64("text")).limit(2 * per_class * len(labels)).select("lang", "text").toArrow()
    data, offsets = bo.text_buffers(sample.column("text"))
    text, off = letters_only(data, offsets)
    raw = text.tobytes()
    passages = [(raw[off[i] : off[i + 1]], lang) for i, lang in enumerate(sample.column("lang").to_pylist())]
    return fit(passages, labels, hidden=hidden, lane=lane, steps=steps, batch=batch)


def identify(
    docs: DataFrame, *, modulus: int = 4, held: int = 2, id_col: str = "doc_id", text_col: str = "text", lang_col: str = "lang",
    per_class: int = 400, hidden: int = 8, lane: int = 64, steps: int = 260, batch: int = 96,
) -> DataFrame:
    """Per row: id, ``held_out``, ``lang_pred``, ``score``."""
    net = train(docs, modulus=modulus, held=held, id_col=id_col, text_col=text_col, lang_col=lang_col, per_class=per_class, hidden=hidden, lane=lane, steps=steps, batch=batch)
    rt.bounded_batches(docs.sparkSession)
    shared = docs.sparkSession.sparkContext.broadcast(net)  # a few kilobytes, whatever the corpus
    src = docs.select(F.col(id_col).alias("id"), (rt.bucket_of(F.col(id_col), modulus) == held).alias("held_out"), F.col(text_col).alias("text"))
    out = src.mapInArrow(_predict_batches(shared, lane), f"id {dict(src.dtypes)['id']}, held_out boolean, lang_pred string, score double")
    return out.withColumnRenamed("id", id_col)


def op5(spark, sf_dir: str) -> DataFrame:
    return identify(rt.table(spark, sf_dir, "documents"))
