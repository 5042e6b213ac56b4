"""Near-duplicate documents by SetSketch registers, exact on every link that it confirms.

A document is the set of its ``k``-word shingles (64-bit hashes).  Its sketch has ``m`` registers:
register i is the minimum of exponential variates that shingles draw with seed i, on a scale of
powers of ``base`` truncated to the register range.  Registers of a union are the element-wise
maxima (``merge``), and equal registers become likelier as sets grow alike, so bands of ``rows``
registers give candidates.

1. Equal sets collapse to the smallest id (map-side combined, so one huge group of copies costs
   nothing).  All later steps see one representative per set.
2. Bands are hashed; buckets with one member go.  In each bucket the member that collides most over
   all bands is the hub, and every document is first compared with its best hub only: a star in
   place of all pairs.
3. Candidates pass the length bound and a joint maximum-likelihood estimate from the registers
   (five standard errors of slack), then the exact test on full shingle sets.
4. Links give components by min-label propagation with pointer jumping, all as tables.
5. What a star can miss is a link between *different* components that meet in a bucket.  For these
   each member outside the bucket's largest component is compared with every member, in a grid of
   cells of bounded size, so a hot bucket spreads over many tasks.  Registers first say which
   members may have such a link at all; the full sets of these then meet cell by cell, and each
   cell returns a spanning set of the links it finds, never its pairs.  Members of one component
   are not compared with each other: that could not change the result.

Recall: a pair at similarity 0.85 shares no band with probability (1 - 0.85^5)^20 = 8e-6.

Edge cases.  Null or wordless texts have an empty set, are linked with nothing and keep their own
id.  Rows that share an id are one document: all stay as rows and share a component (where their
texts differ, the one with fewest shingles stands for the id).  A null id keeps a null component
unless its set equals another's, and is never chosen over a real id.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from cadastra.llm import _runtime as rt
from cadastra.llm import bytesops as bo

U64 = np.uint64


class Params:
    """``bands`` x ``rows`` registers on a scale with ratio ``base``; links need
    ``100 * intersection >= percent * union`` on shingles of ``shingle`` words."""

    def __init__(self, shingle: int = 3, percent: int = 85, bands: int = 20, rows: int = 5, base: float = 1.001, rate: float = 20.0, block: int = 1500):
        self.shingle, self.percent, self.bands, self.rows, self.base, self.rate, self.block = shingle, percent, bands, rows, base, rate, block
        rng = np.random.Generator(np.random.PCG64(77))
        self.m = bands * rows
        # equal registers are at least as likely as the similarity: five standard errors below it,
        # and never more than half of the registers, a pair is not worth an estimate
        goal = percent / 100
        self.least_equal = self.m * min(0.5, goal - 5 * (goal * (1 - goal) / self.m) ** 0.5)
        self.flip = rng.integers(0, 1 << 32, self.m, dtype=np.uint32)
        self.times = rng.integers(0, 1 << 32, self.m, dtype=np.uint32) | np.uint32(1)
        self.band_seed = rng.integers(1, 1 << 63, (bands, rows), dtype=np.uint64)


def registers(p: Params, hashes: np.ndarray, first: np.ndarray) -> np.ndarray:
    """Registers (documents x m, uint16) of documents that have at least one shingle each."""
    low = np.empty((p.m, len(first) - 1), np.uint32)
    short = (hashes >> U64(32)).astype(np.uint32)
    for i in range(p.m):
        low[i] = np.minimum.reduceat((short ^ p.flip[i]) * p.times[i], first[:-1])
    smallest = -np.log1p(-((low.T.astype(np.float64) + 0.5) / 2.0**32)) / p.rate
    level = np.floor(1 - np.log(smallest) / np.log(p.base))
    return np.clip(level, 0, 65535).astype(np.uint16)


def merge(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    return np.maximum(a, b)


def estimate(p: Params, a: np.ndarray, b: np.ndarray, na: np.ndarray, nb: np.ndarray) -> np.ndarray:
    """Maximum-likelihood Jaccard similarity of register rows, set sizes known."""
    up, down = (a > b).sum(1), (a < b).sum(1)
    same = p.m - up - down
    u = (na / (na + nb))[:, None]
    v = 1 - u
    top = np.minimum(u / v, v / u)
    grid = np.linspace(0, 1, 65)[None, :] * top * (1 - 1e-9)
    step = (p.base - 1) / p.base
    prob = lambda x: np.clip(-np.log1p(-np.clip(x, 0, 1) * step) / np.log(p.base), 1e-12, 1)
    more, less = prob(u - v * grid), prob(v - u * grid)
    equal = np.clip(1 - more - less, 1e-12, 1)
    like = up[:, None] * np.log(more) + down[:, None] * np.log(less) + same[:, None] * np.log(equal)
    return np.take_along_axis(grid, like.argmax(1)[:, None], 1)[:, 0]


def plausible(p: Params, a, b, na, nb) -> np.ndarray:
    goal = p.percent / 100
    slack = 5 * np.sqrt(goal * (1 - goal) / p.m)
    ok = 100 * np.minimum(na, nb) >= p.percent * np.maximum(na, nb)
    near = np.zeros(len(ok), bool)
    at = np.flatnonzero(ok)
    for i in range(0, len(at), 4096):
        part = at[i : i + 4096]
        near[part] = estimate(p, a[part], b[part], na[part].astype(float), nb[part].astype(float)) >= goal - slack
    return near


def _sets(p: Params, column) -> Iterator[tuple[int, int, np.ndarray, np.ndarray]]:
    """For pieces of the batch: document range, shingle hashes and their offsets."""
    data, offsets = bo.text_buffers(column)
    for i, j in bo.pieces(offsets):
        a, b = offsets[i], offsets[j]
        part, off = bo.LOWER[data[a:b]], offsets[i : j + 1] - a
        starts, ends, first = bo.word_spans(part, off)
        yield i, j, *bo.shingle_hashes(bo.word_hashes(part, starts, ends), first, p.shingle)


def _sketch_batches(p: Params, id_name: str):
    def run(batches):
        for batch in batches:
            for i, j, hashes, first in _sets(p, batch.column(1)):
                n, key, own = np.zeros(j - i, np.int64), np.zeros((j - i, 2), np.int64), np.flatnonzero(np.diff(first))
                for d in own:
                    s = np.sort(hashes[first[d] : first[d + 1]])
                    s = s[np.concatenate(([True], s[1:] != s[:-1]))]
                    n[d] = len(s)
                    key[d] = np.array([s.sum(dtype=np.uint64), np.bitwise_xor.reduce(bo.mix(s * U64(0x9E3779B97F4A7C15)))]).view(np.int64)
                sketch = [None] * (j - i)
                if len(own):
                    regs = registers(p, hashes, np.concatenate((first[own], first[-1:])))
                    for d, row in zip(own, regs, strict=True):
                        sketch[d] = row.tobytes()
                yield pa.RecordBatch.from_arrays(
                    [batch.column(0).slice(i, j - i), pa.array(n), pa.array(key[:, 0]), pa.array(key[:, 1]), pa.array(sketch, pa.binary())],
                    names=[id_name, "n", "key1", "key2", "sketch"],
                )

    return run


def sketches(docs: DataFrame, p: Params, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Per row: id, ``n`` (set size), a 128-bit key of the set, the register bytes (null if empty)."""
    src = docs.select(F.col(id_col).alias("id"), F.col(text_col).alias("text"))
    kind = dict(src.dtypes)["id"]
    return src.mapInArrow(_sketch_batches(p, "id"), f"id {kind}, n long, key1 long, key2 long, sketch binary")


def band_keys(p: Params, regs: np.ndarray) -> np.ndarray:
    """64-bit key of each band of register rows (n x bands)."""
    parts = regs.reshape(-1, p.bands, p.rows).astype(np.uint64)
    return bo.mix((parts * p.band_seed[None] + p.band_seed[None]).sum(2, dtype=np.uint64) + np.arange(p.bands, dtype=np.uint64)[None])


def _band_batches(p: Params):
    def run(batches):
        for batch in batches:
            n = batch.num_rows
            if not n:
                continue
            keys = band_keys(p, np.frombuffer(b"".join(batch.column(1).to_pylist()), np.uint16))
            ids = batch.column(0).take(pa.array(np.repeat(np.arange(n), p.bands)))
            yield pa.RecordBatch.from_arrays([ids, pa.array(keys.reshape(-1).view(np.int64))], names=["id", "band"])

    return run


def _verify_batches(p: Params):
    def run(batches):
        for batch in batches:
            keep = []
            for r, (x, y) in enumerate(zip(batch.column(2), batch.column(3), strict=True)):
                a, b = np.frombuffer(x.as_buffer(), np.uint64), np.frombuffer(y.as_buffer(), np.uint64)
                both = len(np.intersect1d(a, b, assume_unique=True))
                if both and 100 * both >= p.percent * (len(a) + len(b) - both):
                    keep.append(r)
            yield pa.RecordBatch.from_arrays([batch.column(i).take(pa.array(keep, pa.int64())) for i in (0, 1)], names=["a", "b"])

    return run


def _set_batches(p: Params):
    def run(batches):
        for batch in batches:
            for i, j, hashes, first in _sets(p, batch.column(1)):
                sets = [np.unique(hashes[first[d] : first[d + 1]]).tobytes() for d in range(j - i)]
                yield pa.RecordBatch.from_arrays([batch.column(0).slice(i, j - i), pa.array(sets, pa.binary())], names=["id", "s"])

    return run


def _plausible_batches(p: Params):
    def run(batches):
        for batch in batches:
            if batch.num_rows:
                na, nb = (batch.column(i).to_numpy() for i in (2, 4))
                a, b = (np.frombuffer(b"".join(batch.column(i).to_pylist()), np.uint16).reshape(-1, p.m) for i in (3, 5))
                batch = batch.filter(pa.array(plausible(p, a, b, na, nb)))
            yield batch.select([0, 1])

    return run


def _full_sets(ids: DataFrame, docs: DataFrame, p: Params, kind: str) -> DataFrame:
    """``id`` and ``s``, the sorted shingle hashes, of the documents in ``ids``."""
    wanted = rt.materialize(ids.distinct(), "ends")
    # one row of text per id: ids stand for the smallest of their set, and any row of an id with that set will do
    texts = docs.join(rt.maybe_broadcast(wanted, 40), "id", "left_semi")
    return texts.mapInArrow(_set_batches(p), f"id {kind}, s binary").groupBy("id").agg(F.max("s").alias("s"))


def _confirm(pairs: DataFrame, docs: DataFrame, p: Params, kind: str) -> DataFrame:
    """Of the pairs (a, b) those whose full shingle sets are similar enough."""
    sets = _full_sets(pairs.select(F.col("a").alias("id")).unionByName(pairs.select(F.col("b").alias("id"))), docs, p, kind)
    left, right = sets.select(F.col("id").alias("a"), F.col("s").alias("sa")), sets.select(F.col("id").alias("b"), F.col("s").alias("sb"))
    joined = pairs.join(left, "a").join(right, "b").select("a", "b", "sa", "sb")
    return joined.mapInArrow(_verify_batches(p), f"a {kind}, b {kind}")


def components(links: DataFrame) -> DataFrame:
    """``id``, ``comp`` (smallest id reachable) for every id in ``links`` (columns a, b)."""
    both = rt.materialize(links.unionByName(links.select(F.col("b").alias("a"), F.col("a").alias("b"))).distinct(), "links")
    label = rt.materialize(both.groupBy(F.col("a").alias("id")).agg(F.least(F.min("b"), F.first("a")).alias("comp")), "label")
    while True:
        seen = both.join(label.select(F.col("id").alias("b"), "comp"), "b").groupBy(F.col("a").alias("id")).agg(F.min("comp").alias("near"))
        lower = label.join(seen, "id").select("id", F.least("comp", "near").alias("next"), F.col("comp").alias("was"))
        jump = label.select(F.col("id").alias("next"), F.col("comp").alias("far"))
        after = rt.materialize(
            lower.join(jump, "next", "left").select("id", F.least("next", F.coalesce("far", "next")).alias("comp"), "was"), "label"
        )
        changed = not after.where(F.col("comp") != F.col("was")).isEmpty()
        label = after.select("id", "comp")
        if not changed:
            return label


def _facing(tab: pa.Table, p: Params, n: np.ndarray) -> Iterator[tuple[int, np.ndarray]]:
    """Each left row of a cell with the right rows of other components that the length bound lets
    pass.  Two minority members face each other from both sides; the hash order keeps one of them."""
    left, minor, order = (tab.column(c).to_numpy() for c in ("left", "minor", "place"))
    codes = tab.column("comp").combine_chunks().dictionary_encode().indices.to_numpy()
    right = np.flatnonzero(~left)
    for r in np.flatnonzero(left):
        other = right[(codes[right] != codes[r]) & (~minor[right] | (order[right] <= order[r]))]
        yield r, other[100 * np.minimum(n[other], n[r]) >= p.percent * np.maximum(n[other], n[r])]


_CELL = ("band", "cell", "id", "comp", "left", "minor", "place")


def _meet_batches(p: Params):
    """Of one cell of a bucket those members that registers let be linked across components.  A pair
    counts only in the first band that it shares."""

    def run(keys: tuple[pa.Scalar, ...], tab: pa.Table) -> pa.Table:
        tab = tab.combine_chunks()
        n = tab.column("n").to_numpy()
        regs = np.frombuffer(b"".join(tab.column("sketch").to_pylist()), np.uint16).reshape(-1, p.m)
        own = band_keys(p, regs).view(np.int64) == keys[0].as_py()
        keep = np.zeros(len(n), bool)
        for r, near in _facing(tab, p, n):
            same = regs[near] == regs[r]
            first = same.reshape(-1, p.bands, p.rows).all(2).argmax(1)
            near = near[(same.sum(1) >= p.least_equal) & own[r, first]]
            if len(near):
                ok = near[plausible(p, regs[near], np.broadcast_to(regs[r], (len(near), p.m)), n[near], np.full(len(near), n[r]))]
                keep[ok] = True
                keep[r] |= len(ok) > 0
        return tab.select(_CELL).filter(pa.array(keep))

    return run


def _link_batches(p: Params, chunk: int = 1 << 20):
    """Links between the components of one cell by full shingle sets.  Components that a link has
    joined are one from then on, so a cell gives fewer links than it has members."""

    def run(keys: tuple[pa.Scalar, ...], tab: pa.Table) -> pa.Table:
        tab = tab.combine_chunks()
        sets = [np.frombuffer(x.as_buffer(), np.uint64) for x in tab.column("s")]
        n = np.array([len(x) for x in sets])
        codes = tab.column("comp").combine_chunks().dictionary_encode().indices.to_numpy()
        root = np.arange(codes.max() + 1)
        a, b = [], []
        for r, near in _facing(tab, p, n):
            while len(near := near[root[codes[near]] != root[codes[r]]]):
                part = near[: max(1, int(np.searchsorted(np.cumsum(n[near]), chunk)))]
                near = near[len(part) :]
                values, mine = np.concatenate([sets[i] for i in part]), sets[r]
                hit = mine[np.minimum(np.searchsorted(mine, values), len(mine) - 1)] == values
                both = np.add.reduceat(hit.astype(np.int64), np.concatenate(([0], np.cumsum(n[part])))[:-1])
                for i in part[100 * both >= p.percent * (n[part] + n[r] - both)]:
                    if root[codes[i]] != root[codes[r]]:
                        root[root == root[codes[i]]] = root[codes[r]]
                        a.append(r)
                        b.append(i)
        at = lambda x: tab.column("id").take(pa.array(x, pa.int64()))
        return pa.table([at(a), at(b)], names=["a", "b"])

    return run


def near_duplicates(docs: DataFrame, p: Params | None = None, *, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per row of ``docs``: id, ``n_shingles``, ``component_id``, ``kept``."""
    p = p or Params()
    spark = docs.sparkSession
    src = docs.select(F.col(id_col).alias("id"), F.col(text_col).alias("text"))
    kind = dict(src.dtypes)["id"]
    all_rows = rt.materialize(sketches(docs, p, id_col, text_col), "sketch")
    keyed = all_rows.where(F.col("n") > 0)
    # rows of one id that hold different texts are different sets under one id: keep them apart
    reps = rt.materialize(
        keyed.groupBy("key1", "key2", "n").agg(F.min("id").alias("id"), F.first("sketch").alias("sketch")).where(F.col("id").isNotNull()), "reps"
    )
    one = reps.groupBy("id").agg(F.min("n").alias("n"), F.min_by("sketch", "n").alias("sketch")) if _repeats(reps) else reps.select("id", "n", "sketch")
    bands = one.select("id", "sketch").mapInArrow(_band_batches(p), f"id {kind}, band long")
    sizes = bands.groupBy("band").agg(F.count("*").alias("size")).where(F.col("size") > 1)
    met = rt.materialize(bands.join(sizes, "band"), "bands")
    score = met.groupBy("id").agg(F.sum("size").alias("score"))
    scored = met.join(score, "id")
    hubs = scored.groupBy("band").agg(F.max(F.struct("score", "id")).alias("hub"))
    best = scored.join(hubs, "band").where(F.col("id") != F.col("hub.id")).groupBy("id").agg(F.max("hub").alias("hub"))
    star = best.select(F.least("id", "hub.id").alias("a"), F.greatest("id", "hub.id").alias("b")).distinct()
    lookup = one.select("id", "n", "sketch")
    pairs = (
        star.join(lookup.select(F.col("id").alias("a"), F.col("n").alias("na"), F.col("sketch").alias("ka")), "a")
        .join(lookup.select(F.col("id").alias("b"), F.col("n").alias("nb"), F.col("sketch").alias("kb")), "b")
        .select("a", "b", "na", "ka", "nb", "kb")
        .mapInArrow(_plausible_batches(p), f"a {kind}, b {kind}")
    )
    links = rt.materialize(_confirm(rt.materialize(pairs, "pairs"), src, p, kind), "links")
    label = components(links)

    # Links that a star cannot see: members of different components in one bucket.
    comp = F.coalesce("comp", "id").alias("comp")
    member = met.join(label, "id", "left").select("band", "id", comp)
    by_comp = member.groupBy("band", "comp").agg(F.count("*").alias("c"))
    mixed = by_comp.groupBy("band").agg(F.sum("c").alias("size"), F.max(F.struct("c", "comp")).alias("most"), F.count("*").alias("kinds")).where(F.col("kinds") > 1)
    # a grid of cells per bucket: a block of minority members (left) against a block of all (right)
    of = lambda c: F.ceil(c / p.block).cast("int")
    placed = member.join(mixed, "band").select(
        "band",
        "id",
        "comp",
        (F.col("comp") != F.col("most.comp")).alias("minor"),
        F.xxhash64("id").alias("place"),
        of(F.col("size")).alias("wide"),
        of(F.col("size") - F.col("most.c")).alias("high"),
    )
    cell = lambda i, j, left: F.struct((i * F.col("wide") + j).alias("cell"), F.lit(left).alias("left"))
    row, column = (F.pmod(F.col("place"), F.col(c)).cast("int") for c in ("high", "wide"))
    as_right = F.transform(F.sequence(F.lit(0), F.col("high") - 1), lambda i: cell(i, column, False))
    as_left = F.transform(F.sequence(F.lit(0), F.col("wide") - 1), lambda j: cell(row, j, True))
    spread = placed.select("band", "id", "comp", "minor", "place", F.explode(F.when(F.col("minor"), F.concat(as_right, as_left)).otherwise(as_right)).alias("c"))
    shape = f"band long, cell int, id {kind}, comp {kind}, left boolean, minor boolean, place long"
    cells = spread.select("band", "c.cell", "id", "comp", "c.left", "minor", "place")
    met_again = rt.materialize(cells.join(lookup, "id").groupBy("band", "cell").applyInArrow(_meet_batches(p), shape), "cross")
    if not met_again.isEmpty():
        sets = _full_sets(met_again.select("id"), src, p, kind)
        more = met_again.join(sets, "id").groupBy("band", "cell").applyInArrow(_link_batches(p), f"a {kind}, b {kind}")
        label = components(links.unionByName(more.select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b")).distinct()))
    # Back to all rows: a row's set gives its representative, the representative its component.
    joined = (
        all_rows.select("id", "n", "key1", "key2")
        .join(reps.select("key1", "key2", "n", F.col("id").alias("rep")), ["key1", "key2", "n"], "left")
        .join(label.select(F.col("id").alias("rep"), "comp"), "rep", "left")
    )
    comp_id = F.coalesce("comp", "rep", "id")
    return joined.select(F.col("id").alias(id_col), F.col("n").alias("n_shingles"), comp_id.alias("component_id"), F.coalesce(F.col("id") == comp_id, F.lit(True)).alias("kept"))


def _repeats(reps: DataFrame) -> bool:
    return not reps.groupBy("id").count().where("count > 1").isEmpty()


def drop_near_duplicates(docs: DataFrame, p: Params | None = None, *, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``docs`` with one document of each group of near copies: the one with the smallest id."""
    found = near_duplicates(docs, p, id_col=id_col, text_col=text_col)
    gone = rt.materialize(found.where(~F.col("kept")).select(F.col(id_col).alias("_gone")).distinct(), "gone")
    rest = docs.join(rt.maybe_broadcast(gone, 40), docs[id_col].eqNullSafe(gone["_gone"]), "left_anti")
    return rest


def op6(spark, sf_dir: str) -> DataFrame:
    return near_duplicates(rt.table(spark, sf_dir, "documents"))


OP6_SQL = r"""
WITH RECURSIVE d AS (
  SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x20\x09-\x0D]+') AS w
  FROM documents),
sh AS (
  SELECT DISTINCT doc_id, array_to_string(w[s : s + 2], ' ') AS g
  FROM (SELECT doc_id, w, unnest(generate_series(1, greatest(len(w) - 2, 1))) AS s FROM d WHERE len(w) > 0)),
n AS (SELECT doc_id, count(*) AS n FROM sh GROUP BY doc_id),
common AS (
  SELECT a.doc_id AS x, b.doc_id AS y, count(*) AS shared
  FROM sh a JOIN sh b ON a.g = b.g AND a.doc_id < b.doc_id GROUP BY ALL),
link AS (
  SELECT x, y FROM common c JOIN n p ON p.doc_id = c.x JOIN n q ON q.doc_id = c.y
  WHERE 100 * shared >= 85 * (p.n + q.n - shared)),
edge AS (SELECT x, y FROM link UNION ALL SELECT y, x FROM link),
reach(id, other) AS (
  SELECT doc_id, doc_id FROM d
  UNION
  SELECT r.id, e.y FROM reach r JOIN edge e ON e.x = r.other)
SELECT d.doc_id, CAST(coalesce(n.n, 0) AS BIGINT) AS n_shingles, r.c AS component_id, d.doc_id = r.c AS kept
FROM d LEFT JOIN n USING (doc_id) JOIN (SELECT id, min(other) AS c FROM reach GROUP BY id) r ON r.id = d.doc_id
"""
