"""The methods behind the corpus queries against brute force: suffix tree, gradients, URL rules and list."""

from __future__ import annotations

import math
import random
from collections import Counter

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

pytest.importorskip("cadastra.llm")
from cadastra.llm import _runtime as rt  # noqa: E402
from cadastra.llm import bytesops as bo  # noqa: E402
from cadastra.llm import langid, setsketch, suffixtree, urlfilter, warc  # noqa: E402


def odd_texts(rng: random.Random) -> list[str]:
    return ["".join(rng.choice("aB \n\té") for _ in range(rng.choice([0, 1, 3, 30, 90]))) for _ in range(rng.randint(1, 8))]


def counted(texts: list[str], depth: int, limit: int) -> dict[int, Counter]:
    data, offsets = bo.text_buffers(pa.array(texts))
    found: dict[int, Counter] = {}
    for _, _, text, own, _, skip in suffixtree._streams(data, offsets, depth, limit):
        for d, keys in enumerate(suffixtree._gram_keys(text, own, depth, skip)):
            found.setdefault(d, Counter()).update(keys.tolist())
    return {d: c for d, c in found.items() if c}


def test_slices_of_a_text_count_as_the_whole():
    rng = random.Random(3)
    for _ in range(150):
        texts = odd_texts(rng)
        assert counted(texts, 6, 1 << 20) == counted(texts, 6, 8) == counted(texts, 6, 1)


def normalised(text: str) -> bytes:
    low = text.encode().lower()  # bytes.lower touches A-Z only
    return b"".join(w + b" " for w in low.split()) + bytes([suffixtree.END])


def naive_tree(streams: list[bytes], depth: int, floor: int, least_bits: float, weight: float):
    grams: dict[bytes, Counter] = {}
    for text in streams:
        line = bytes([suffixtree.END]) + text
        for i in range(1, len(line)):
            for d in range(min(i, depth) + 1):
                grams.setdefault(line[i - d : i], Counter())[line[i]] += 1
    root = np.ones(256)
    for symbol, n in grams[b""].items():
        root[symbol] += n
    dist, kept = {b"": root / root.sum()}, {b""}
    for name in sorted(grams, key=len)[1:]:
        total = sum(grams[name].values())
        if total < floor or name[1:] not in dist:
            continue
        parent = dist[name[1:]]
        own = weight * parent
        for symbol, n in grams[name].items():
            own[symbol] += n
        own = own / (total + weight)
        dist[name] = own
        if sum(n * math.log2(own[x] / parent[x]) for x, n in grams[name].items()) >= least_bits:
            kept.update(name[i:] for i in range(len(name)))
    return grams, dist, kept


def test_suffix_tree_keeps_and_scores_as_brute_force():
    rng, depth, floor, bits, weight = random.Random(9), 3, 4, 6.0, 8.0
    words = ["ab", "abba", "baab", "ca", "cab", "é"]
    texts = [" ".join(rng.choice(words) for _ in range(rng.randint(0, 25))) for _ in range(60)]
    streams = [normalised(t) for t in texts]
    grams, dist, kept = naive_tree(streams, depth, floor, bits, weight)
    table = {}
    for d in range(depth + 1):
        rows = [(int.from_bytes(name + bytes([x]), "big"), n) for name, c in grams.items() if len(name) == d and (d == 0 or sum(c.values()) >= floor) for x, n in c.items()]
        table[d] = (np.array([k for k, _ in rows], np.uint64), np.array([n for _, n in rows], np.int64))
    tree = suffixtree.build_tree(table, depth, bits, weight)
    assert tree.contexts == len(kept) and 1 < len(kept) < len(dist)
    for text in [*streams[:10], normalised("abc zz cabab")]:
        line, want = bytes([suffixtree.END]) + text, []
        for i in range(1, len(line)):
            name = next(line[i - d : i] for d in range(min(i, depth), -1, -1) if line[i - d : i] in kept)
            want.append(math.log10(dist[name][line[i]]))
        assert np.allclose(tree.score(np.frombuffer(text, np.uint8)), want, atol=1e-4)


def test_counting_tasks_give_all_orders(spark):
    rng, depth = random.Random(4), 6
    texts = [t for _ in range(20) for t in odd_texts(rng)]
    batch = pa.RecordBatch.from_arrays([pa.array(texts), pa.array([False] * len(texts))], names=["text", "held_out"])
    for limit in (64, 1 << 20):  # emptied often, and once
        rows = [r for out in suffixtree._count_batches(depth, limit)(iter([batch])) for r in zip(*[c.to_pylist() for c in out.columns], strict=True)]
        counted = spark.createDataFrame(rows, "kind int, key long, n long").groupBy("kind", "key").agg(F.sum("n").alias("n"))
        got: dict[int, Counter] = {}
        for kind, key, n in [*counted.where("kind = 0").collect(), *suffixtree.all_orders(counted, depth).collect()]:
            got.setdefault(kind, Counter())[key & (1 << 64) - 1] += n
        grams = naive_tree([normalised(t) for t in texts], depth, 1, 1.0, 8.0)[0]
        for d in range(depth + 1):
            want = {int.from_bytes(name + bytes([x]), "big"): n for name, c in grams.items() if len(name) == d for x, n in c.items()}
            assert got[d + 1] == want
        assert sum(got[0].values()) == sum(len(t.split()) for t in texts)


def test_gradients_match_differences():
    net = langid.Network(["x", "y", "z"], 4, seed=2)
    rng = np.random.default_rng(1)
    net.p = {k: v.astype(np.float64) for k, v in net.p.items()}
    lanes, label = rng.integers(97, 123, (7, 5)).astype(np.uint8), np.array([0, 1, 2, 1, 0])
    _, grads = net.gradients(lanes, label)
    for name, value in net.p.items():
        way = rng.normal(size=value.shape)
        sides = []
        for sign in (1, -1):
            net.p[name] = value + sign * 1e-2 * way
            sides.append(net.gradients(lanes, label)[0])
        net.p[name] = value
        assert (sides[0] - sides[1]) / 2e-2 == pytest.approx(float((grads[name] * way).sum()), rel=0.03, abs=2e-4)


def test_many_rules_and_ties_decide_alike(spark):
    rng = random.Random(6)
    hosts = ["com", "example.com", "x.example.com", "a.net", "net"]
    rules = sorted({(rng.choice(hosts), "/" + "".join(rng.choice("ab/") for _ in range(rng.randint(0, 4))), rng.choice(["allow", "block"])) for _ in range(400)})
    rules += [("x.example.com", "/", "block"), ("example.com", "/de", "allow")]
    assert len(rules) > 200
    urls = [f"http://{rng.choice(['', 'x.', 'y.x.'])}{rng.choice(hosts)}/{''.join(rng.choice('abd/e') for _ in range(rng.randint(0, 6)))}" for _ in range(400)]
    pages = spark.createDataFrame([*enumerate([*urls, "http://x.example.com/de", None, "none"])], "page_id int, url string")
    none = pages.where("page_id < 0").select("url")
    both = [
        {r.page_id: (r.rule, r.verdict) for r in urlfilter.filter_urls(pages, none, rules=rules, literal_rules=n).collect()} for n in (0, len(rules))
    ]
    assert both[0] == both[1]
    for k, url in enumerate(urls):
        host, path = url[7:].split("/", 1)
        fits = [r for r in rules if (host == r[0] or host.endswith("." + r[0])) and ("/" + path).startswith(r[1])]
        best = min(fits, key=lambda r: (-len(r[0] + r[1]), r), default=None)
        assert both[0][k] == ((best[0] + best[1], best[2]) if best else (None, "allow"))


def test_exact_join_removes_false_hits_of_the_filter(spark):
    pages = spark.createDataFrame([(i, f"http://h{i % 7}.org/p{i}") for i in range(4000)], "page_id int, url string")
    listed = pages.where("page_id % 2 = 0").select("url")
    # one block of 256 bits for 2,000 URLs: nearly every URL passes the filter
    got = urlfilter.filter_urls(pages, listed, rules=(), max_blocks=1)
    assert {r.page_id for r in got.where("listed").collect()} == set(range(0, 4000, 2))
    assert got.where("verdict = 'block'").count() == 2000


def test_least_equal_registers_follow_the_threshold():
    assert setsketch.Params().least_equal == 50
    assert setsketch.Params(percent=40).least_equal < 20


@pytest.mark.parametrize("sizes, nested", [((700, 5000, 100_000_000), False), ((100_000_000,), True)])
def test_damaged_and_embedded_members(spark, tmp_path, sizes, nested):
    """Magic bytes inside members at any split; whole members inside members (``nested``) in one
    split only, since a split between the two is a known limit."""
    rng = random.Random(12)
    inner = warc.gzip_member(warc.warc_record(-1, "http://inside/", b"inner" * 9, None, "X"), 6) if nested else b""
    file, want = [], []
    for i in range(300):
        payload = bytes(rng.choices(range(256), k=rng.randint(0, 900)))
        if i % 5 == 1:
            payload = inner + payload + warc.MAGIC + inner + payload
        member = warc.gzip_member(warc.warc_record(i, f"http://h/{i}", payload, None, "D"), 0 if i % 2 else 6)
        if i % 7 == 3:
            member = member[: rng.randint(4, len(member) - 9)]  # broken off
        elif i % 7 == 5:
            at = rng.randint(len(member) // 2, len(member) - 9)
            member = member[:at] + bytes([member[at] ^ 0x55]) + member[at + 1 :]  # fails its checksum at the latest
        else:
            want.append((i, payload))
        file.append(member)
    where = tmp_path / "x.warc"
    where.write_bytes(b"".join(file))
    own = spark.newSession()
    for size in sizes:
        own.conf.set("spark.sql.files.maxPartitionBytes", str(size))
        own.conf.set("spark.sql.files.openCostInBytes", "0")
        got = [(r.page_id, bytes(r.payload)) for r in warc.read_warc(own, str(where)).collect()]
        # a damaged member that held whole ones leaves those behind
        assert sorted(x for x in got if x[0] != -1) == sorted(want), size
        assert nested or not any(x[0] == -1 for x in got)


def test_broadcast_is_decided_by_real_bytes(spark):
    wide = spark.range(100).selectExpr("id", "repeat('x', 1000) as s", "array('a', repeat('y', 500)) as a")
    assert rt.fits_broadcast(wide, 40, 200_000) and not rt.fits_broadcast(wide, 40, 100_000)
    assert not rt.fits_broadcast(wide.select("id"), 40, 3_999) and rt.fits_broadcast(wide.select("id"), 40, 4_000)
    assert rt.fits_broadcast(wide.limit(0), 40, 10)
