"""Quality classifier: random-indexing word vectors pooled per document, then a two-layer network
in numpy with temperature-calibrated probabilities.

Tokens are runs of letters, digits or one kind of other characters, lower-cased; a token in capitals
or equal to one of the two before it adds a marker token.  Every token falls into one of ``buckets``
rows of a table.  Each row has a sparse random index vector (a few entries of +1 or -1, from its
number alone); a word's vector is the sum of the index vectors of its neighbours in all documents,
less what the mean neighbour would give, damped and scaled to unit length.  A document is the mean of its tokens' word vectors beside the mean
of their index vectors.  The network's logit is divided by a temperature fitted on rows that the
network was not trained on.

Word vectors are corpus statistics without labels: every task sums whole-number vectors for its texts,
and the sums are added by table row (``buckets`` rows a task, whatever its text).

Training rows.  Labelled rows outside the held-out fold; about ``sample_rows`` of them, twice that
many at most, those of least hash of the id.  Their whole texts are pooled on the executors; the driver
gets one vector a row.

Memory.  A text is read in slices of about half a megabyte, cut at white space; what a repeated token
follows is looked for within its slice.

Edge cases.  Empty or null text: zero vector, scored like any other.  No labels, or one class only:
every score is the smoothed base rate.  A null label is no label.  Of several labels of one id the
largest counts.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from cadastra.llm import _runtime as rt
from cadastra.llm import bytesops as bo

U64 = np.uint64
_KIND = np.full(256, 3, np.uint8)
_KIND[bo.SPACE] = 0
_KIND[48:58] = 2
_KIND[65:91] = _KIND[97:123] = 1
_KIND[128:] = 1
_CAPS, _AGAIN = 0, 1  # rows of the table that the markers use


def token_rows(data: np.ndarray, offsets: np.ndarray, buckets: int) -> tuple[np.ndarray, np.ndarray]:
    """Table rows of the tokens of all texts in order, markers after their token, and n+1 offsets."""
    if not len(data):
        return np.zeros(0, np.int64), np.zeros(len(offsets), np.int64)
    kind = _KIND[data]
    # other characters form runs of one and the same character
    change = np.empty(len(data) + 1, bool)
    change[0] = change[-1] = True
    change[1:-1] = (kind[1:] != kind[:-1]) | ((kind[1:] == 3) & (data[1:] != data[:-1]))
    change[offsets] = True
    edges = np.flatnonzero(change)
    starts, ends = edges[:-1], edges[1:]
    words = kind[starts] > 0
    starts, ends = starts[words], ends[words]
    low = bo.LOWER[data]
    # long runs of one symbol are one token whatever their length
    ends = np.where(kind[starts] == 3, np.minimum(ends, starts + 3), ends)
    rows = (bo.word_hashes(low, starts, ends) % U64(buckets - 2)).astype(np.int64) + 2
    upper = np.concatenate(([0], np.cumsum((data >= 65) & (data <= 90))))
    caps = (upper[ends] - upper[starts] >= 2) & (kind[starts] == 1)
    again = np.zeros(len(rows), bool)
    again[1:] |= rows[1:] == rows[:-1]
    again[2:] |= rows[2:] == rows[:-2]
    first = np.searchsorted(starts, offsets)
    again[first[:-1][first[:-1] < len(rows)]] = False
    inside = (np.arange(len(rows)) - np.repeat(first[:-1], np.diff(first))) > 1
    again &= inside
    n = 1 + caps + again
    out = np.repeat(rows, n)
    at = np.concatenate(([0], np.cumsum(n)))
    out[at[:-1][caps] + 1] = _CAPS
    out[at[1:][again] - 1] = _AGAIN
    return out, at[first]


def index_vectors(buckets: int, width: int, nonzero: int = 4) -> tuple[np.ndarray, np.ndarray]:
    """Places and signs (buckets x nonzero) of the index vectors' entries."""
    rng = np.random.Generator(np.random.PCG64(909))
    return rng.integers(0, width, (buckets, nonzero)), rng.choice([-1.0, 1.0], (buckets, nonzero))


def neighbour_sums(rows: np.ndarray, first: np.ndarray, place: np.ndarray, sign: np.ndarray, width: int, reach: int = 2) -> np.ndarray:
    """For each table row the sum (buckets x width) of the index vectors of its tokens' neighbours
    within ``reach`` tokens of the same text."""
    buckets = len(place)
    out = np.zeros(buckets * width)
    text = np.repeat(np.arange(len(first) - 1), np.diff(first))
    for shift in range(1, reach + 1):
        same = text[shift:] == text[:-shift]
        a, b = rows[:-shift][same], rows[shift:][same]
        for own, other in ((a, b), (b, a)):
            for k in range(place.shape[1]):
                out += np.bincount(own * width + place[other, k], sign[other, k], buckets * width)
    return out.reshape(buckets, width)


class Model:
    """Word vectors, standardisation, two layers and a temperature."""

    def __init__(self, buckets: int, width: int):
        self.buckets, self.width, self.rate = buckets, width, 0.5
        place, sign = index_vectors(buckets, width)
        index = np.zeros((buckets, width), np.float32)
        np.add.at(index, (np.arange(buckets)[:, None], place), sign)
        #: word vector beside index vector of each table row
        self.both = np.concatenate((np.zeros_like(index), index), 1)
        self.layers: tuple | None = None
        self.temperature = 1.0

    def set_words(self, rows: np.ndarray, sums: np.ndarray, seen: np.ndarray) -> None:
        """``sums`` of table rows that ``seen`` tokens fell into.  What the corpus' mean neighbour
        would give as many tokens is taken away: frequent words would else make all vectors alike."""
        sums = sums - seen[:, None] * (sums.sum(0) / max(1, seen.sum()))
        word = np.sign(sums) * np.sqrt(np.abs(sums))
        self.both[rows, : self.width] = word / np.maximum(np.linalg.norm(word, axis=1, keepdims=True), 1e-6)

    def pool(self, data: np.ndarray, offsets: np.ndarray) -> np.ndarray:
        """A vector per text: the mean over its tokens."""
        cuts, owner = bo.sliced(data, offsets)
        out, count = np.zeros((len(offsets) - 1, 2 * self.width)), np.zeros(len(offsets) - 1, np.int64)
        for i, j in bo.pieces(cuts):
            rows, first = token_rows(data[cuts[i] : cuts[j]], cuts[i : j + 1] - cuts[i], self.buckets)
            np.add.at(count, owner[i:j], np.diff(first))
            for d in range(j - i):
                r = rows[first[d] : first[d + 1]]
                for a in range(0, len(r), 4096):
                    out[owner[i + d]] += self.both.take(r[a : a + 4096], axis=0).sum(0)
        return (out / np.maximum(count, 1)[:, None]).astype(np.float32)

    def logits(self, x: np.ndarray) -> np.ndarray:
        centre, scale, w1, b1, w2, b2 = self.layers
        return np.tanh(((x - centre) / scale) @ w1 + b1) @ w2 + b2

    def score(self, data: np.ndarray, offsets: np.ndarray) -> np.ndarray:
        if self.layers is None:
            return np.full(len(offsets) - 1, self.rate)
        return 1 / (1 + np.exp(-np.clip(self.logits(self.pool(data, offsets)) / self.temperature, -40, 40)))


def fit(model: Model, x: np.ndarray, labels: np.ndarray, *, hidden: int, steps: int) -> Model:
    """Train the network on pooled vectors ``x``, then the temperature on a fifth kept apart."""
    model.rate = float((labels.sum() + 1) / (len(labels) + 2))
    if len(labels) < 8 or labels.min() == labels.max():
        return model
    y = labels.astype(np.float32)
    rng = np.random.Generator(np.random.PCG64(31))
    mixed = rng.permutation(len(y))
    cut = max(1, len(y) // 5)
    check, own = mixed[:cut], mixed[cut:]
    centre, scale = x[own].mean(0), x[own].std(0) + 1e-3
    params = [rng.normal(0, 1 / np.sqrt(x.shape[1]), (x.shape[1], hidden)).astype(np.float32), np.zeros(hidden, np.float32), np.zeros(hidden, np.float32), np.zeros(1, np.float32)]
    mean, square = [np.zeros_like(p) for p in params], [np.zeros_like(p) for p in params]
    z = (x - centre) / scale
    for step in range(1, steps + 1):
        pick = own[rng.integers(0, len(own), min(len(own), 256))]
        w1, b1, w2, b2 = params
        h = np.tanh(z[pick] @ w1 + b1)
        p = 1 / (1 + np.exp(-np.clip(h @ w2 + b2, -30, 30)))
        d = (p - y[pick]) / len(pick)
        dh = d[:, None] * w2[None] * (1 - h * h)
        grads = [z[pick].T @ dh + 1e-3 * w1, dh.sum(0), h.T @ d + 1e-3 * w2, np.array([d.sum()], np.float32)]
        for i, g in enumerate(grads):
            mean[i] = 0.9 * mean[i] + 0.1 * g
            square[i] = 0.999 * square[i] + 0.001 * g * g
            params[i] = params[i] - (0.01 * (mean[i] / (1 - 0.9**step)) / (np.sqrt(square[i] / (1 - 0.999**step)) + 1e-8)).astype(np.float32)
    model.layers = (centre, scale, *params)
    logit, target = model.logits(x[check]), y[check]
    grid = np.exp(np.linspace(np.log(0.25), np.log(8), 81))
    loss = [np.logaddexp(0, np.where(target > 0, -1, 1) * logit / t).mean() for t in grid]
    model.temperature = float(grid[int(np.argmin(loss))])
    return model


def _word_batches(buckets: int, width: int):
    """Per task the neighbour sums of its texts: ``row`` of the table, ``width`` whole numbers and
    the number of tokens."""

    def run(batches):
        place, sign = index_vectors(buckets, width)
        total = np.zeros((buckets, width + 1))
        for batch in batches:
            data, offsets = bo.text_buffers(batch.column(0))
            cuts, _ = bo.sliced(data, offsets)
            for i, j in bo.pieces(cuts, 1 << 21):
                rows, first = token_rows(data[cuts[i] : cuts[j]], cuts[i : j + 1] - cuts[i], buckets)
                total[:, :width] += neighbour_sums(rows, first, place, sign, width)
                total[:, width] += np.bincount(rows, minlength=buckets)
        used = np.flatnonzero(total.any(1))
        for a in range(0, len(used), 4096):
            own = used[a : a + 4096]
            yield pa.RecordBatch.from_arrays([pa.array(own.astype(np.int32)), *[pa.array(total[own, k].astype(np.int64)) for k in range(width + 1)]], names=["row", *[f"v{k}" for k in range(width + 1)]])

    return run


def learn_words(texts: DataFrame, model: Model) -> None:
    """Set the word vectors from all ``texts`` (one column)."""
    names = [f"v{k}" for k in range(model.width + 1)]
    sums = texts.mapInArrow(_word_batches(model.buckets, model.width), "row int, " + ", ".join(f"{v} long" for v in names)).groupBy("row").agg(*[F.sum(v).alias(v) for v in names])
    got = sums.toArrow()  # at most ``buckets`` rows
    vectors = np.stack([got.column(v).to_numpy() for v in names], 1).astype(float)
    model.set_words(got.column("row").to_numpy(), vectors[:, :-1], vectors[:, -1])


def _pool_batches(shared):
    def run(batches):
        for batch in batches:
            x = shared.value.pool(*bo.text_buffers(batch.column(0)))
            flat = pa.FixedSizeListArray.from_arrays(pa.array(x.reshape(-1)), x.shape[1]).cast(pa.list_(pa.float32()))
            yield pa.RecordBatch.from_arrays([batch.column(1), flat], names=["label", "x"])

    return run


def train(docs: DataFrame, labels: DataFrame, *, modulus: int, held: int, id_col: str, text_col: str, label_col: str, sample_rows: int, buckets: int, width: int, hidden: int, steps: int) -> Model:
    spark = docs.sparkSession
    model = Model(buckets, width)
    learn_words(docs.select(F.col(text_col).alias("text")), model)
    marked = labels.where(F.col(label_col).isNotNull() & (rt.bucket_of(F.col(id_col), modulus) != held)).select(F.col(id_col).alias("lid"), F.col(label_col).cast("int").alias("label"))
    draw = F.pmod(F.xxhash64("lid", F.lit("quality")), F.lit(1_000_000))
    share = int(min(1_000_000, 1_000_000 * sample_rows / max(marked.count(), 1) + 1))
    chosen = marked.where(draw < share).groupBy("lid").agg(F.max("label").alias("label")).orderBy(draw).limit(2 * sample_rows)
    chosen = rt.materialize(chosen, "labelled")  # 2 x sample_rows pairs of an id and a label at most: fit to be broadcast
    src = docs.select(F.col(id_col).alias("did"), F.col(text_col).alias("text"))
    found = src.join(F.broadcast(chosen), src["did"] == chosen["lid"]).select("text", "label")
    pooled = found.mapInArrow(_pool_batches(spark.sparkContext.broadcast(model)), "label int, x array<float>")
    # rows that share a drawn id may be many: 2 x sample_rows vectors go to the driver at most, in an order of their own
    got = pooled.orderBy(F.xxhash64("x"), "label").limit(2 * sample_rows).toArrow()
    x = np.array(got.column("x").to_pylist(), np.float32).reshape(-1, 2 * width)
    return fit(model, x, got.column("label").to_numpy().astype(int), hidden=hidden, steps=steps)


def _score_batches(shared):
    def run(batches):
        for batch in batches:
            score = shared.value.score(*bo.text_buffers(batch.column(2))).astype(float)
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), pa.array(score)], names=["id", "held_out", "score"])

    return run


def classify(
    docs: DataFrame, labels: DataFrame, *, modulus: int = 5, held: int = 0, threshold: float = 0.3, id_col: str = "doc_id", text_col: str = "text", label_col: str = "quality",
    sample_rows: int = 6000, buckets: int = 1 << 15, width: int = 32, hidden: int = 24, steps: int = 900,
) -> DataFrame:
    """Per row: id, ``held_out``, ``score`` (probability of label 1), ``predicted``."""
    rt.bounded_batches(docs.sparkSession)
    model = train(docs, labels, modulus=modulus, held=held, id_col=id_col, text_col=text_col, label_col=label_col, sample_rows=sample_rows, buckets=buckets, width=width, hidden=hidden, steps=steps)
    shared = docs.sparkSession.sparkContext.broadcast(model)  # buckets x width x 8 bytes
    src = docs.select(F.col(id_col).alias("id"), (rt.bucket_of(F.col(id_col), modulus) == held).alias("held_out"), F.col(text_col).alias("text"))
    out = src.mapInArrow(_score_batches(shared), f"id {dict(src.dtypes)['id']}, held_out boolean, score double")
    return out.select(F.col("id").alias(id_col), "held_out", "score", F.when(F.col("score") >= threshold, 1).otherwise(0).alias("predicted"))


def op9(spark, sf_dir: str) -> DataFrame:
    return classify(rt.table(spark, sf_dir, "documents"), rt.table(spark, sf_dir, "labels"))
