"""The mix against targets reckoned one source at a time, and against its own texts."""

import re
from collections import Counter, defaultdict

import numpy as np
import pytest

from courtledger.llm import mixing
from courtledger.llm.mixing import mix_sources, mixed_texts, permuted, taken_words
from courtledger.llm.queries import QUERIES

WORD = re.compile(r"[^\x20\x09-\x0D]+")


def reckoned(sizes, weights=(5, 2, 1), share=1.5, repeats=2):
    """Targets by sharing again and again until none is above its limit."""
    names = sorted((s for s in sizes if s is not None), key=lambda s: s.encode()) + [None] * (None in sizes)
    weight = {s: weights[k % len(weights)] for k, s in enumerate(names)}
    left, open_, target = share * sum(sizes.values()), set(names), {}
    while open_:
        level = left / sum(weight[s] for s in open_)
        above = {s for s in open_ if weight[s] * level > repeats * sizes[s]}
        if not above:
            target |= {s: weight[s] * level for s in open_}
            break
        for s in above:
            target[s] = repeats * sizes[s]
            left -= target[s]
        open_ -= above
    return target


def sizes_of(rows):
    sizes = defaultdict(int)
    for _, text, source in rows:
        sizes[source] += len(WORD.findall(text or ""))
    return dict(sizes)


@pytest.fixture(scope="module")
def rows():
    rng = np.random.default_rng(3)
    out = [(None, "no id", "b"), (1, None, "a"), (2, "", None), (3, " \n", "empty")]
    for k in range(4, 200):
        source = ["hot", "hot", "hot", "a", "b", "é", "Z", None, f"s{k}"][k % 9]
        out.append((k, " ".join(f"{k}.{i}" for i in range(int(rng.integers(0, 60)))), source))
    out.append((500, "\t".join(f"long{i}" for i in range(30_000)), "hot"))
    return out + out[5:9] + [(7, "other text of the same id", "a")]


@pytest.fixture(scope="module")
def docs(spark, rows):
    schema = "doc_id long, text string, source string, size long, place int, sid string"
    return spark.createDataFrame([(*r, 1, 2, "x") for r in rows], schema).repartition(5)


@pytest.mark.parametrize("block, shard_slots, fan", [(256, 1024, 1024), (16, 8, 1024), (7, 64, 3)])
def test_targets_are_met(rows, docs, monkeypatch, block, shard_slots, fan):
    """Also with many shards, and with draws that go down a tree of sources."""
    monkeypatch.setattr(mixing, "FAN", fan)
    found = taken_words(*mix_sources(docs, block=block, shard_slots=shard_slots)).collect()
    assert Counter(r.doc_id for r in found) == Counter(d for d, _, _ in rows)
    sizes = sizes_of(rows)
    targets = reckoned(sizes)
    by_id = defaultdict(list)
    for doc_id, text, source in rows:
        by_id[doc_id].append((len(WORD.findall(text or "")), sizes[source], pytest.approx(targets[source])))
    for r in found:
        assert (r.size, r.source_size, r.target) in by_id[r.doc_id]
        assert 0 <= r.taken <= 2 * r.size
    taken = defaultdict(int)
    for r in found:
        taken[r.source_size, round(r.target, 6)] += r.taken
    wanted = defaultdict(int)
    for source, target in targets.items():
        wanted[sizes[source], round(target, 6)] += round(min(target, 2 * sizes[source]))
    assert {k: v for k, v in taken.items() if v} == {k: v for k, v in wanted.items() if v}


def test_texts_of_the_mix_and_reruns(rows, docs):
    table, spans = mix_sources(docs, block=32, shard_slots=16)
    again = mix_sources(docs.repartition(3), block=32, shard_slots=16)
    key = lambda df: sorted(map(str, df.select("shard", "sid", "block", "first", "stop").collect()))
    assert key(spans) == key(again[1])
    words = defaultdict(set)
    for doc_id, text, _ in rows:
        words[doc_id].add(tuple(WORD.findall(text or "")))
    texts = mixed_texts(docs, table, spans).collect()
    assert len(texts) == spans.count()
    for r in texts:
        got = tuple(r.text.split())
        assert len(got) == r.stop - r.first
        assert any(w[r.first : r.stop] == got for w in words[r.doc_id])
    # Shards are full but for the last one, whose slots are counted by blocks.
    slots = Counter()
    for r in spans.select("shard", "sid", "block").distinct().collect():
        slots[r.shard] += 1
    assert max(slots.values()) <= 16


def test_nothing_to_mix(spark, docs):
    for df in (docs.limit(0), docs.filter("size(split(text, ' ')) < 0"), docs.filter("text = ''")):
        table, spans = mix_sources(df)
        assert spans.count() == 0 and table.filter("target <> 0 OR size <> 0").count() == 0


@pytest.mark.parametrize("n", [1, 2, 3, 7, 64, 65, 1000])
def test_permutations(n):
    x = np.arange(n)
    key = np.full(n, 99, np.uint64)
    out = permuted(x, np.full(n, n), key)
    assert sorted(out.tolist()) == x.tolist()
    assert (permuted(out, np.full(n, n), key, back=True) == x).all()


def test_query(spark):
    folder = "/root/testdata/sf0.001"
    docs = spark.read.parquet(f"{folder}/documents.parquet").select("doc_id", "text", "source").collect()
    sizes = sizes_of(docs)
    targets = reckoned(sizes)
    taken = defaultdict(int)
    found = {r.doc_id: r for r in QUERIES["op11_mixing"](spark, folder).collect()}
    for doc_id, text, source in docs:
        r = found[doc_id]
        assert r.size == len(WORD.findall(text or "")) and r.source_size == sizes[source]
        assert r.target == pytest.approx(targets[source]) and r.taken <= 2 * r.size
        taken[source] += r.taken
    assert all(abs(taken[s] - targets[s]) <= 1 for s in targets)
