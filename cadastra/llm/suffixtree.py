"""Language-model scores from a probabilistic suffix tree over the bytes of normalised texts.

A text is read as its tokens (A-Z lower-cased, split at ASCII white space), each closed by a space,
and an end symbol.  The tree gives every byte a probability; the score is the log10 probability of
the whole sequence of bytes, known tokens and unknown ones alike.  The base score has one type for
all unknown tokens and does not spell them, so on texts with many of them it is the higher one.

Training.  All documents outside the held-out fold are counted in one scan: n-grams of ``depth`` + 1
bytes and whole tokens, both as 64-bit keys, combined per task before the shuffle; shorter n-grams
are summed from the longer ones afterwards.  Contexts come from one document only.  A context stays in the tree if it was seen often enough and the
divergence test holds: its count times the Kullback-Leibler divergence of its next-symbol
distribution from that of its suffix is at least ``least_bits`` (or ``share`` of all symbols, if
that is more).  ``share`` bounds the tree whatever the corpus: counts of the contexts of one length
add up to the corpus, so at most 1/``share`` of them pass the count rule.  Distributions are
smoothed into that of the suffix.

Scoring.  The retained contexts and their prefixes form an automaton whose state is the longest
retained suffix.  The automaton is broadcast (bounded as above); texts are cut into equal lanes
with ``depth`` bytes of warm-up and walk it in step.

Base score.  Exact token counts may not be broadcast, since the vocabulary grows with the corpus.
Documents are dealt into blocks once; each block sends its distinct tokens to the counts and gets
its own dictionary back.  Tokens are identified by 64-bit hashes.

Memory.  Texts are read in runs of about half a megabyte; a longer text is read in slices cut at
white space, each led by the ``depth`` bytes before it, so its counts and score are those of the
whole text.  Only a single word of more than a run is held whole.

Edge cases.  Null text is empty: one token, the end.  Rows are scored one by one, repeated or not.
A null id is hashed as the empty string.  With no training rows every distribution is uniform.
"""

from __future__ import annotations

from functools import reduce

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from cadastra.llm import _runtime as rt
from cadastra.llm import bytesops as bo

U64 = np.uint64
END = 10  # the line feed never occurs inside a token
GAP = 32


def stream(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Normalised bytes of all texts (each word closed by GAP, each text by END), the n+1 offsets,
    and where tokens begin: every word and every END, in order."""
    low = bo.LOWER[data]
    starts, _, first = bo.word_spans(low, offsets)
    keep = ~bo.SPACE[low]
    kept = np.concatenate(([0], np.cumsum(keep)))
    words = np.diff(first)
    off = np.concatenate(([0], np.cumsum(kept[offsets[1:]] - kept[offsets[:-1]] + words + 1)))
    out = np.full(off[-1], GAP, np.uint8)
    out[off[1:] - 1] = END
    begins = np.zeros(len(low), np.int32)
    begins[starts] = 1
    doc_of_word = np.repeat(np.arange(len(words)), words)
    # a byte moves on by the words and the ends before it
    moved = np.arange(len(starts)) + doc_of_word
    word_of_byte = np.cumsum(begins)[keep] - 1
    out[np.arange(len(word_of_byte)) + moved[word_of_byte]] = low[keep]
    tokens = np.empty(len(starts) + len(words), np.int64)
    slot = np.zeros(len(tokens), bool)
    slot[np.cumsum(words + 1) - 1] = True
    tokens[slot] = off[1:] - 1
    tokens[~slot] = kept[starts] + moved
    return out, off, tokens


def _streams(data: np.ndarray, offsets: np.ndarray, depth: int, limit: int = bo.PIECE_BYTES):
    """Normalised streams of whole texts, or of slices of texts longer than ``limit``, run by run:
    lower-cased bytes and offsets of the run, its stream and offsets, the text that each part is of,
    and how many bytes at the front repeat the slice before (at most ``depth``, context only)."""
    cuts, owner = bo.sliced(data, offsets, limit)
    carry = np.zeros(0, np.uint8)
    for i, j in bo.pieces(cuts, limit):
        part, off = bo.LOWER[data[cuts[i] : cuts[j]]], cuts[i : j + 1] - cuts[i]
        text, own, _ = stream(part, off)
        if not (i and owner[i - 1] == owner[i]):
            carry = carry[:0]
        skip = len(carry)
        text, own = np.concatenate((carry, text)), own + skip
        own[0] = 0
        if j < len(owner) and owner[j] == owner[j - 1]:  # the text goes on: no END yet
            text = text[:-1]
            own[-1] -= 1
            carry = text[max(int(own[-2]), len(text) - depth) :]
        yield part, off, text, own, owner[i:j], skip


def _gram_keys(text: np.ndarray, off: np.ndarray, depth: int, skip: int = 0) -> list[np.ndarray]:
    """Keys of the (d+1)-grams, d = 0..depth, that have exactly the longest context their place
    allows.  The newest byte is lowest; a context never reaches beyond the END before its text.
    The first ``skip`` bytes are context only."""
    line = np.concatenate((np.array([END], np.uint8), text)).astype(np.uint64)  # END before the first text
    place = np.arange(len(text), dtype=np.int32) - np.repeat(off[:-1].astype(np.int32), np.diff(off))  # 0 for the first symbol of a text
    room = np.minimum(place + 1, depth).astype(np.uint8)
    room[:skip] = 255
    key = np.zeros(len(text), np.uint64)
    grams = []
    for k in range(depth + 1):
        if k:
            key[k - 1 :] |= line[: max(0, len(line) - k)] << U64(8 * k)
        else:
            key |= line[1:]
        grams.append(key[room == k].copy() if k < depth else key[room == depth])
    return grams


def _unique(keys: np.ndarray, counts: np.ndarray | None = None) -> tuple[np.ndarray, np.ndarray]:
    if counts is None:
        keys = np.sort(keys)
        edge = np.flatnonzero(np.concatenate(([True], keys[1:] != keys[:-1]))) if len(keys) else np.zeros(0, np.int64)
        return keys[edge], np.diff(np.append(edge, len(keys)))
    order = np.argsort(keys, kind="stable")
    keys, counts = keys[order], counts[order]
    edge = np.flatnonzero(np.concatenate(([True], keys[1:] != keys[:-1]))) if len(keys) else np.zeros(0, np.int64)
    return keys[edge], np.add.reduceat(counts, edge) if len(edge) else counts


class _Counter:
    """Counts of 64-bit keys, merged whenever ``limit`` unmerged keys are held."""

    def __init__(self, limit: int):
        self.limit, self.parts, self.held = limit, [], 0

    def add(self, keys: np.ndarray, counts: np.ndarray | None = None) -> bool:
        """Whether the counter is still nearly full after merging, so that it must be taken."""
        self.parts.append(_unique(keys, counts))
        self.held += len(self.parts[-1][0])
        if self.held <= self.limit:
            return False
        self.parts = [self.take()]
        self.held = len(self.parts[0][0])
        return self.held > self.limit * 7 // 10

    def take(self) -> tuple[np.ndarray, np.ndarray]:
        parts, self.parts, self.held = self.parts, [], 0
        if len(parts) == 1:
            return parts[0]
        keys = np.concatenate([np.zeros(0, np.uint64), *[k for k, _ in parts]])
        counts = np.concatenate([np.zeros(0, np.int64), *[c for _, c in parts]])
        del parts
        return _unique(keys, counts)


def _emitted(kind: int, keys: np.ndarray, counts: np.ndarray):
    for i in range(0, len(keys), 1 << 17):
        k = keys[i : i + (1 << 17)]
        yield pa.RecordBatch.from_arrays(
            [pa.array(np.full(len(k), kind, np.int32)), pa.array(k.view(np.int64)), pa.array(counts[i : i + (1 << 17)].astype(np.int64))], names=["kind", "key", "n"]
        )


def _count_batches(depth: int, limit: int = 1_500_000):
    """Kind 0: tokens.  Kind d+1: grams whose place in the text allows exactly d bytes of context,
    that is the deepest ones and those at the start of a text.  Only rows outside the fold."""

    def run(batches):
        words, deep = _Counter(limit // 4), _Counter(limit)
        starts_of = [_Counter(limit // 16) for _ in range(depth)]

        def flush():
            for d, held in enumerate([*starts_of, deep]):
                yield from _emitted(d + 1, *held.take())

        for batch in batches:
            batch = batch.filter(pa.compute.invert(batch.column(1)))
            data, offsets = bo.text_buffers(batch.column(0))
            for part, off, text, own, _, skip in _streams(data, offsets, depth):
                starts, ends, _ = bo.word_spans(part, off)
                if words.add(bo.word_hashes(part, starts, ends)):
                    yield from _emitted(0, *words.take())
                full = False
                for d, keys in enumerate(_gram_keys(text, own, depth, skip)):
                    full |= (deep if d == depth else starts_of[d]).add(keys)
                if full:
                    yield from flush()
        yield from _emitted(0, *words.take())
        yield from flush()
        bo.release()  # the worker stays and other stages need the room

    return run


def all_orders(counted: DataFrame, depth: int) -> DataFrame:
    """Counts of the grams of every order (kind d+1, key, n) from those of ``_count_batches``: a gram
    with d bytes of context occurs as often as the grams one byte longer that end in it, and at the
    start of a text.  Each order is derived from the summed one above it, so tasks ship only the deepest."""
    level = counted.where(F.col("kind") == depth + 1).select("key", "n")
    orders = [level]
    for d in range(depth - 1, -1, -1):
        shorter = level.select(F.col("key").bitwiseAND(F.lit((1 << (8 * d + 8)) - 1).cast("long")).alias("key"), "n")
        starts = counted.where(F.col("kind") == d + 1).select("key", "n")
        level = rt.materialize(shorter.unionByName(starts).groupBy("key").agg(F.sum("n").alias("n")), f"grams{d}")
        orders.append(level)
    tagged = [o.select(F.lit(depth + 1 - i).alias("kind"), "key", "n") for i, o in enumerate(orders)]
    return reduce(DataFrame.unionByName, tagged)


class Tree:
    """The automaton: ``step`` and ``logp`` by state and symbol code, ``code`` of each byte."""

    def __init__(self, code: np.ndarray, step: np.ndarray, logp: np.ndarray, depth: int, contexts: int):
        self.code, self.step, self.logp, self.depth, self.contexts = code, step, logp, depth, contexts

    def score(self, text: np.ndarray, lanes: int = 4096) -> np.ndarray:
        """log10 probability of every byte of a normalised stream that starts after an END."""
        n = len(text)
        if not n:
            return np.zeros(0)
        k = int(self.code.max()) + 1
        length = max(64, -(-n // lanes))
        rows = -(-n // length)
        padded = np.full(self.depth + rows * length, self.code[END], np.uint8)
        padded[self.depth : self.depth + n] = self.code[text]
        view = np.lib.stride_tricks.as_strided(padded, (self.depth + length, rows), (1, length))
        state, out = np.zeros(rows, np.int32), np.empty((length, rows), np.float32)
        for t in range(self.depth + length):
            at = state * np.int32(k) + view[t]
            if t >= self.depth:
                self.logp.take(at, out=out[t - self.depth])
            state = self.step.take(at)
        return out.T.reshape(-1)[:n].astype(np.float64)


def build_tree(grams: dict[int, tuple[np.ndarray, np.ndarray]], depth: int, least_bits: float, weight: float) -> Tree:
    """``grams[d]``: keys and counts of the grams with d bytes of context (frequent contexts only).

    Byte strings name contexts, oldest byte first.  A context is retained if its divergence from its
    suffix passes; all its suffixes are retained with it."""
    root = np.ones(256)
    for key, n in zip(*grams.get(0, ((), ())), strict=True):
        root[int(key)] += n
    root /= root.sum()
    dist: dict[bytes, np.ndarray] = {b"": root}
    gain: dict[bytes, float] = {}
    for d in range(1, depth + 1):
        keys, counts = grams.get(d, (np.zeros(0, np.uint64), np.zeros(0, np.int64)))
        order = np.argsort(keys)
        keys, counts = keys[order], counts[order].astype(float)
        edge = np.flatnonzero(np.concatenate(([True], (keys[1:] >> U64(8)) != (keys[:-1] >> U64(8))))) if len(keys) else []
        for a, b in zip(edge, np.append(edge[1:], len(keys)) if len(edge) else [], strict=True):
            name = int(keys[a] >> U64(8)).to_bytes(d, "big")
            parent = dist.get(name[1:])
            if parent is None:
                continue
            symbols, n = (keys[a:b] & U64(255)).astype(np.int64), counts[a:b]
            total = n.sum()
            smooth = weight * parent
            smooth[symbols] += n
            smooth /= total + weight
            gain[name] = float((n * np.log2(smooth[symbols] / parent[symbols])).sum())
            dist[name] = smooth
    kept = {b""}
    for name, g in gain.items():
        if g >= least_bits:
            kept.update(name[i:] for i in range(len(name)))
    states = sorted({name[:i] for name in kept for i in range(len(name) + 1)}, key=lambda x: (len(x), x))
    number = {name: i for i, name in enumerate(states)}
    used = sorted({b for name in states for b in name} | {int(k) for k in grams.get(0, ((), ()))[0]} | {END, GAP})
    code = np.full(256, len(used) if len(used) < 256 else 0, np.uint8)
    code[used] = np.arange(len(used))
    k = int(code.max()) + 1
    step, logp = np.zeros((len(states), k), np.int32), np.zeros((len(states), k), np.float32)
    # bytes that training never saw share one code and the root's probability of an unseen byte
    pick = np.array([*used, *([next(b for b in range(256) if b not in set(used))] if len(used) < 256 else [])])
    children: dict[bytes, list[tuple[int, int]]] = {}
    for name in states[1:]:
        children.setdefault(name[:-1], []).append((name[-1], number[name]))
    for name in states:  # shorter first: a state's failure state is complete when it is needed
        i = number[name]
        suffix = name[1:]
        while suffix not in number:
            suffix = suffix[1:]
        if name:
            step[i] = step[number[suffix]]
        for byte, child in children.get(name, ()):
            step[i, code[byte]] = child
        longest = name
        while longest not in kept:
            longest = longest[1:]
        logp[i] = np.log10(dist[longest][pick]) if longest in dist else logp[number[suffix]]
    return Tree(code, step.reshape(-1), logp.reshape(-1), depth, len(kept))


def _folded(docs: DataFrame, modulus: int, held: int, id_col: str, text_col: str) -> DataFrame:
    return docs.select(F.col(id_col).alias("id"), F.col(text_col).alias("text"), (rt.bucket_of(F.col(id_col), modulus) == held).alias("held_out"))


def train(folded: DataFrame, *, depth: int = 6, least_bits: float = 30.0, share: float = 3e-6, weight: float = 8.0) -> tuple[Tree, DataFrame, int, int, int]:
    """The tree, the token counts (key, n), N, V and the number of ends, all of the training rows."""
    src = folded.select("text", "held_out")
    counts = src.mapInArrow(_count_batches(depth), "kind int, key long, n long").groupBy("kind", "key").agg(F.sum("n").alias("n"))
    counts = rt.materialize(counts, "counts")
    words = counts.where("kind = 0").select("key", "n")
    grams_of = all_orders(counts, depth)
    w_n, w_v = words.agg(F.coalesce(F.sum("n"), F.lit(0)), F.count("*")).first()
    ends = folded.where(~F.col("held_out")).count()
    symbols = grams_of.where("kind = 1").agg(F.coalesce(F.sum("n"), F.lit(0))).first()[0]
    floor = max(20, int(share * symbols))
    context = F.shiftrightunsigned("key", 8)
    deep = grams_of.where("kind > 1").withColumn("context", context)
    often = deep.groupBy("kind", "context").agg(F.sum("n").alias("all")).where(F.col("all") >= floor).select("kind", "context")
    frequent = deep.join(often, ["kind", "context"]).select("kind", "key", "n").unionByName(grams_of.where("kind = 1"))
    got = frequent.toArrow()
    kind, key, n = (got.column(c).to_numpy() for c in ("kind", "key", "n"))
    grams = {d: (key[kind == d + 1].view(np.uint64), n[kind == d + 1]) for d in range(depth + 1)}
    tree = build_tree(grams, depth, max(least_bits, share * symbols), weight)
    return tree, words, w_n + ends, w_v + (ends > 0), ends


def _distinct_batches(batches):
    """(block, token) of every block that a task reads, once per batch."""
    for batch in batches:
        blocks = batch.column(0).to_numpy(zero_copy_only=False)
        data, offsets = bo.text_buffers(batch.column(2))
        seen: dict[int, list] = {}
        cuts, owner = bo.sliced(data, offsets)
        for i, j in bo.pieces(cuts):
            part, off = bo.LOWER[data[cuts[i] : cuts[j]]], cuts[i : j + 1] - cuts[i]
            starts, ends, first = bo.word_spans(part, off)
            h = bo.word_hashes(part, starts, ends)
            of = np.repeat(blocks[owner[i:j]], np.diff(first))
            for block in np.unique(of):
                seen.setdefault(int(block), []).append(_unique(h[of == block])[0])
        for block, keys in seen.items():
            k = _unique(np.concatenate(keys))[0]
            yield pa.RecordBatch.from_arrays([pa.array(np.full(len(k), block, np.int32)), pa.array(k.view(np.int64))], names=["block", "key"])


def _score_block(tree, total: int, distinct: int, ends: int):
    import math

    unit = math.log10(total + distinct + 1)

    def run(keys: tuple[pa.Scalar, ...], texts: pa.Table, counts: pa.Table) -> pa.Table:
        model = tree.value
        vocab = counts.column("key").to_numpy().view(np.uint64)
        n = counts.column("n").to_numpy()
        vocab, first_of = np.unique(vocab, return_index=True)
        n = n[first_of]
        data, offsets = bo.text_buffers(texts.column("text"))
        tokens, known = np.zeros(len(texts), np.int64), np.zeros(len(texts), np.int64)
        base, score = np.zeros(len(texts)), np.zeros(len(texts))
        for part, off, text, own, of, skip in _streams(data, offsets, model.depth):
            starts, stops, first = bo.word_spans(part, off)
            h = bo.word_hashes(part, starts, stops)
            at = np.searchsorted(vocab, h)
            at[at == len(vocab)] = 0
            c = np.where(vocab[at] == h, n[at], 0) if len(vocab) else np.zeros(len(h), np.int64)
            sums = np.concatenate(([0.0], np.cumsum(np.log10(c + 1.0))))
            hits = np.concatenate(([0], np.cumsum(c > 0)))
            np.add.at(tokens, of, np.diff(first))
            np.add.at(known, of, hits[first[1:]] - hits[first[:-1]])
            np.add.at(base, of, sums[first[1:]] - sums[first[:-1]])
            logs = model.score(text)
            logs[:skip] = 0
            sums = np.concatenate(([0.0], np.cumsum(logs)))
            np.add.at(score, of, sums[own[1:]] - sums[own[:-1]])
        tokens += 1
        known += ends > 0
        base += math.log10(ends + 1) - tokens * unit
        return pa.table(
            {"id": texts.column("id"), "held_out": texts.column("held_out"), "n_tokens": tokens, "n_known": known, "base_score": base, "score": score}
        )

    return run


def score_texts(docs: DataFrame, *, modulus: int = 7, held: int = 2, id_col: str = "doc_id", text_col: str = "text", rows_per_block: int = 2048, **training) -> DataFrame:
    """Per row: id, ``held_out``, ``n_tokens``, ``n_known``, ``train_tokens``, ``base_score``, ``score``."""
    spark = docs.sparkSession
    folded = _folded(docs, modulus, held, id_col, text_col)
    kind = dict(folded.dtypes)["id"]
    tree, words, total, distinct, ends = train(folded, **training)
    shared = spark.sparkContext.broadcast(tree)
    blocks = max(rt.shuffle_width(spark), folded.select("held_out").count() // rows_per_block)
    # rows of one id are dealt apart, so that no id makes a block large
    block = F.pmod(F.xxhash64("id", F.length("text"), F.substring("text", 1, 64)), F.lit(blocks)).cast("int")
    blocked = folded.select(block.alias("block"), "id", "text", "held_out").repartition(rt.shuffle_width(spark), "block")
    asked = blocked.mapInArrow(_distinct_batches, "block int, key long")
    told = asked.join(words, "key").select("block", "key", "n")
    scored = (
        blocked.groupBy("block")
        .cogroup(told.groupBy("block"))
        .applyInArrow(_score_block(shared, total, distinct, ends), f"id {kind}, held_out boolean, n_tokens long, n_known long, base_score double, score double")
    )
    return scored.select(F.col("id").alias(id_col), "held_out", "n_tokens", "n_known", F.lit(total).cast("long").alias("train_tokens"), "base_score", "score")


def op4(spark, sf_dir: str) -> DataFrame:
    return score_texts(rt.table(spark, sf_dir, "documents"))
