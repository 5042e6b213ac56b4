"""Document fingerprints by randomised edit embedding, with bit-sampled bands and verification.

Two texts are embedded by one shared random walk: at step j the walk writes the symbol under its
pointer and moves the pointer on if bit R[j, symbol] is set.  After an edit the walks over both
texts fall into step again, so a small edit distance becomes a small Hamming distance.

The fingerprint samples ``samples`` positions of the embedding.  Texts of all lengths share one
random priority per position, and a text of scale s (embedding length 2^s) samples the positions of
least priority below 2^s: the samples of two scales share every position that both could draw, so
texts of different lengths stay comparable.  A sampled symbol is a hash of two characters in four
bits (0: past the end).  Likeness is the share of equal symbols, corrected for chance.

``near_pairs`` cuts the positions that a scale shares with itself and with the next one into bands
and verifies every two texts that agree in a band by likeness.  Its links, and the comparisons, grow
with the square of the texts alike.  No query calls it.

Edge cases.  Null text: empty, with a fingerprint of its own.  Equal texts have equal fingerprints.
Repeated ids are ordered by text.  Null ids come last.  A single document is its own neighbour.
"""

from __future__ import annotations

import hashlib

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from cadastra.llm import _runtime as rt

SAMPLES = 128
_PERIOD = 4096
_MIN_SCALE, _MAX_SCALE = 6, 40
_rng = np.random.Generator(np.random.PCG64(4711))
_WALK = _rng.integers(0, 2, (_PERIOD, 256), dtype=np.uint8)
_WALK[:, 0] = 0  # symbol 0 stands for the end: the pointer stays
_ROWS = [bytes(r) for r in _WALK]
_DIGITS = np.frombuffer(b"0123456789abcdef", np.uint8)
_samples: dict[int, np.ndarray] = {}


def _lowest(start: int, stop: int, keep: int) -> np.ndarray:
    """Positions of [start, stop) by least priority, ``keep`` of them."""
    best = np.zeros(0, np.int64)
    for a in range(start, stop, 1 << 20):
        at = np.concatenate((best, np.arange(a, min(stop, a + (1 << 20)))))
        best = at[np.argsort(_priority(at), kind="stable")[:keep]]
    return best


def _priority(at: np.ndarray) -> np.ndarray:
    x = (at.astype(np.uint64) + np.uint64(1)) * np.uint64(0x9E3779B97F4A7C15)
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    return x ^ (x >> np.uint64(27))


def sample_positions(scale: int) -> np.ndarray:
    """The sampled positions below 2^scale in ascending order."""
    if scale not in _samples:
        # the embedding ends near twice the text length, two thirds of the scale's span at most
        if scale == _MIN_SCALE:
            _samples[scale] = np.sort(_lowest(0, 1 << scale, SAMPLES))
        else:
            at = np.concatenate((sample_positions(scale - 1), _lowest(1 << (scale - 1), 1 << scale, SAMPLES)))
            _samples[scale] = np.sort(at[np.argsort(_priority(at), kind="stable")[:SAMPLES]])
    return _samples[scale]


def scale_of(n: int) -> int:
    return min(max(_MIN_SCALE, int(3 * n).bit_length()), _MAX_SCALE)


def _symbols(text: str) -> tuple[np.ndarray, np.ndarray]:
    """Walk symbols 1..255 of the characters, and the nibbles 1..15 that samples record."""
    code = np.frombuffer(text.encode("utf-32-le", "surrogatepass"), np.uint32)
    walk = ((code * np.uint32(2654435761)) >> np.uint32(8)) % np.uint32(255) + np.uint32(1)
    pair = code * np.uint32(0x85EBCA6B)
    pair[1:] += code[:-1] * np.uint32(0xC2B2AE35)
    pair ^= pair >> np.uint32(15)
    pair *= np.uint32(0x27D4EB2F)
    return walk.astype(np.uint8), ((pair >> np.uint32(16)) % np.uint32(15) + np.uint32(1)).astype(np.uint8)


def embed(texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
    """Scale and sampled nibbles (n x SAMPLES) of every text; walks of one scale run in step."""
    scales = np.array([scale_of(len(t)) for t in texts], np.int64)
    out = np.zeros((len(texts), SAMPLES), np.uint8)
    for scale in np.unique(scales):
        members, at = np.flatnonzero(scales == scale), sample_positions(int(scale))
        for block in np.array_split(members, max(1, len(members) // 4096)):
            symbols = [_symbols(texts[i]) for i in block]
            if len(block) < 48:
                for i, (walk, nibble) in zip(block, symbols, strict=True):
                    out[i, : len(at)] = _alone(walk, nibble, at)
            else:
                out[block, : len(at)] = _together(symbols, at)
    return scales, out


def _alone(walk: np.ndarray, nibble: np.ndarray, at: np.ndarray) -> np.ndarray:
    w, n, rows, i, j = bytes(walk) + b"\0", len(walk), _ROWS, 0, 0
    seen = np.full(len(at), n)
    for k, stop in enumerate(at.tolist()):
        while j < stop:
            a = j % _PERIOD
            b = min(_PERIOD, a + stop - j)
            for row in rows[a:b]:
                i += row[w[i]]
            j += b - a
        if i >= n:
            break
        seen[k] = i
    return np.append(nibble, np.uint8(0))[seen]


def _together(symbols: list, at: np.ndarray) -> np.ndarray:
    lengths = np.array([len(w) for w, _ in symbols])
    first = np.concatenate(([0], np.cumsum(lengths + 1)))[:-1]
    walk, nibble = np.zeros(lengths.sum() + len(lengths), np.uint8), np.zeros(lengths.sum() + len(lengths), np.uint8)
    for f, (w, n) in zip(first, symbols, strict=True):
        walk[f : f + len(w)], nibble[f : f + len(n)] = w, n
    place, out, j = first.astype(np.int64), np.zeros((len(symbols), len(at)), np.uint8), 0
    for k, stop in enumerate(at.tolist()):
        while j < stop:
            place += _WALK[j % _PERIOD].take(walk.take(place))
            j += 1
        out[:, k] = nibble[place]
        if not k % 8 and not out[:, k].any():
            break
    return out


def render(scales: np.ndarray, nibbles: np.ndarray) -> list[str]:
    """Fingerprints as text: two hex digits of scale, then a digit per sample."""
    digits = _DIGITS[nibbles]
    return [f"{s:02x}" + row.tobytes().decode() for s, row in zip(scales, digits, strict=True)]


def parse(prints: list[str]) -> tuple[np.ndarray, np.ndarray]:
    scales = np.array([int(x[:2], 16) for x in prints], np.int64)
    raw = np.frombuffer("".join(x[2:] for x in prints).encode(), np.uint8).reshape(-1, SAMPLES)
    return scales, np.where(raw < 97, raw - 48, raw - 87).astype(np.uint8)


def likeness(sa: np.ndarray, a: np.ndarray, sb: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Likeness 0..1 of fingerprints row by row, over the positions that both scales sample."""
    out = np.zeros(len(a))
    for x, y in {*zip(sa.tolist(), sb.tolist(), strict=True)}:
        rows = np.flatnonzero((sa == x) & (sb == y))
        _, i, j = np.intersect1d(sample_positions(x), sample_positions(y), assume_unique=True, return_indices=True)
        p, q = a[rows][:, i], b[rows][:, j]
        used = (p > 0) | (q > 0)
        n, same = used.sum(1), ((p == q) & used).sum(1)
        share = np.where(n > 0, same / np.maximum(n, 1), 0)
        out[rows] = np.clip((share - 1 / 15) / (14 / 15), 0, 1)
        equal = (p == q).all(1) & (x == y)
        out[rows[equal]] = 1.0
    return out


def _hex_sha256(text: str) -> str:
    return hashlib.sha256(text.encode("utf-8", "surrogatepass")).hexdigest()


def _edit(text: str, following: str) -> str:
    cut = len(text) // 3
    return text[: len(text) - cut] + following[:cut]


_COLUMNS = "n_chars long, edited_sha256 string, fingerprint string, edited_fingerprint string, near_edited double, near_next double"


def _print_batches(id_type: pa.DataType):
    """Rows come by bucket in order; each row's neighbour is the row after it in its bucket."""

    def finish(ids: list, texts: list[str], following: list[str]) -> pa.RecordBatch:
        edited = [_edit(t, f) for t, f in zip(texts, following, strict=True)]
        order = {t: k for k, t in enumerate(dict.fromkeys([*texts, *edited, *following]))}
        scales, nibbles = embed(list(order))
        pick = lambda xs: np.array([order[x] for x in xs], np.int64)
        t, e, f = pick(texts), pick(edited), pick(following)
        names = ["doc_id", *(c.split()[0] for c in _COLUMNS.split(", "))]
        near = lambda x, y: pa.array(likeness(scales[x], nibbles[x], scales[y], nibbles[y]))
        columns = [
            pa.array(ids, id_type), pa.array([len(x) for x in texts], pa.int64()), pa.array([_hex_sha256(x) for x in edited]),
            pa.array(render(scales[t], nibbles[t])), pa.array(render(scales[e], nibbles[e])), near(t, e), near(t, f),
        ]
        return pa.RecordBatch.from_arrays(columns, names=names)

    def run(batches):
        waiting, ids, texts, following, held = None, [], [], [], 0
        for batch in batches:
            for bucket, halo, ident, text in zip(*(batch.column(i).to_pylist() for i in range(4)), strict=True):
                text = text or ""
                if waiting is not None and waiting[0] == bucket:
                    ids.append(waiting[1])
                    texts.append(waiting[2])
                    following.append(text)
                    held += len(waiting[2])
                waiting = None if halo else (bucket, ident, text)
                if held > 24_000_000:
                    yield finish(ids, texts, following)
                    ids, texts, following, held = [], [], [], 0
        if ids:
            yield finish(ids, texts, following)

    return run


def fingerprints(docs: DataFrame, *, id_col: str = "doc_id", text_col: str = "text", rows_per_bucket: int = 1024, max_buckets: int = 1 << 16) -> DataFrame:
    """Per row: id, ``n_chars``, ``edited_sha256``, ``fingerprint``, ``edited_fingerprint``,
    ``near_edited``, ``near_next``.  Neighbours follow in descending order of the (numeric) id.

    Ids are cut into ranges by quantiles (at most ``max_buckets``).  The first row of each range is
    also dealt to the range before it, so that one shuffle of the texts gives every document its
    neighbour; ranges stream through a task row by row."""
    src = docs.select(F.col(id_col).alias("id"), F.col(text_col).alias("text"))
    kind = dict(src.dtypes)["id"]
    n = src.count()
    buckets = max(1, min(max_buckets, n // rows_per_bucket))
    cuts = src.select(F.col("id").cast("double").alias("x")).dropna().approxQuantile("x", [i / buckets for i in range(1, buckets)], 0.2 / buckets) if buckets > 1 else []
    bounds = np.unique(np.array(cuts, float))
    last = len(bounds)

    @F.pandas_udf("int")
    def bucket_of(x: pd.Series) -> pd.Series:
        at = last - np.searchsorted(bounds, x.to_numpy(dtype=float, na_value=-np.inf), "right")
        return pd.Series(at.astype(np.int32))

    ranged = src.withColumn("bucket", bucket_of(F.col("id").cast("double")))
    heads = sorted((r.bucket, r.head) for r in ranged.groupBy("bucket").agg(F.max("id").alias("head")).collect())
    target = [(heads[k][1], heads[k - 1][0]) for k in range(len(heads))]  # k = 0 wraps round to the last bucket
    table = docs.sparkSession.createDataFrame(target, f"head {kind}, before int") if target else docs.sparkSession.createDataFrame([], f"head {kind}, before int")
    own = F.struct(F.col("bucket"), F.lit(0).alias("halo"))
    both = ranged.join(F.broadcast(table), ranged["id"].eqNullSafe(table["head"]), "left").select(
        "id", "text", F.explode(F.when(F.col("before").isNull(), F.array(own)).otherwise(F.array(own, F.struct(F.col("before").alias("bucket"), F.lit(1).alias("halo"))))).alias("to")
    )
    dealt = both.select(F.col("to.bucket").alias("bucket"), F.col("to.halo").alias("halo"), "id", "text").repartition(F.col("bucket"))
    ordered = dealt.sortWithinPartitions("bucket", "halo", F.col("id").desc_nulls_last(), F.col("text").asc_nulls_first())
    id_type = {"bigint": pa.int64(), "int": pa.int32(), "double": pa.float64(), "smallint": pa.int16()}.get(kind, pa.int64())
    out = ordered.mapInArrow(_print_batches(id_type), f"doc_id {kind}, {_COLUMNS}")
    return out.withColumnRenamed("doc_id", id_col)


def _band_keys(fingerprint: str, band: int) -> list[str]:
    """Bands of the positions shared with the own scale and with both neighbours, without empty ones."""
    scale, body, out = int(fingerprint[:2], 16), fingerprint[2:], []
    at = sample_positions(scale)
    for other in (scale - 1, scale, scale + 1):
        if not _MIN_SCALE <= other <= _MAX_SCALE:
            continue
        shared = np.flatnonzero(np.isin(at, sample_positions(other)))
        for i in range(len(shared) // band):
            key = "".join(body[k] for k in shared[i * band : (i + 1) * band])
            if key.strip("0"):
                out.append(f"{min(scale, other)}-{max(scale, other)}:{i}:{key}")
    return out


def near_pairs(prints: DataFrame, *, id_col: str = "doc_id", print_col: str = "fingerprint", band: int = 8, least: float = 0.8) -> DataFrame:
    """Links (a, b, likeness) between fingerprints that agree in a band of ``band`` samples and have
    at least the likeness ``least``; ``a`` is the smaller id.  Equal fingerprints collapse to the
    smallest id first.  Scales further apart than one step are not compared."""
    one = prints.groupBy(F.col(print_col).alias("p")).agg(F.min(id_col).alias("id"))

    @F.pandas_udf("array<string>")
    def keys_of(p: pd.Series) -> pd.Series:
        return pd.Series([_band_keys(x, band) for x in p], dtype=object)

    bands = one.select("id", "p", F.explode(keys_of("p")).alias("key"))
    x, y = (bands.select("key", F.col("id").alias(n), F.col("p").alias("p" + n)) for n in "ab")
    pairs = x.join(y, "key").where(F.col("a") < F.col("b")).select("a", "b", "pa", "pb").distinct()

    @F.pandas_udf("double")
    def compare(x: pd.Series, y: pd.Series) -> pd.Series:
        return pd.Series(likeness(*parse(x.tolist()), *parse(y.tolist())) if len(x) else [], dtype=float)

    return pairs.select("a", "b", compare("pa", "pb").alias("likeness")).where(F.col("likeness") >= least)


def op10(spark, sf_dir: str) -> DataFrame:
    return fingerprints(rt.table(spark, sf_dir, "documents"))
