"""Phrase mining against plain counts, and the double-array tries beneath it."""

import random
import re
from collections import Counter, defaultdict

import duckdb
import numpy as np
import pyarrow as pa
import pytest

from courtledger.llm import phrases
from courtledger.llm.phrases import collocations
from courtledger.llm.queries import QUERIES
from courtledger.llm.tries import DoubleArray, number_keys

LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def mined(rows, least):
    counts, total = defaultdict(Counter), Counter()
    for lang, text in rows:
        lang = "und" if lang is None else lang
        for piece in re.split(r"[.,;:!?\x0A-\x0D]", (text or "").translate(LOWER)):
            words = re.findall(r"[^\x20\x09]+", piece)
            total[lang] += len(words)
            for k in range(1, 5):
                for i in range(len(words) - k + 1):
                    counts[lang][tuple(words[i : i + k])] += 1
    out = []
    for lang, f in counts.items():
        candidates = {p: a for p, a in f.items() if len(p) > 1 and a >= least}
        dropped = {
            q[i : i + m]
            for q, b in candidates.items()
            for m in range(2, len(q))
            for i in range(len(q) - m + 1)
            if 100 * b >= 80 * candidates[q[i : i + m]]
        }
        for p, a in candidates.items():
            if p not in dropped:
                score, _, l, r = min(
                    (2_000_000 * a // (f[p[:k]] + f[p[k:]]), k, f[p[:k]], f[p[k:]]) for k in range(1, len(p))
                )
                out.append((lang, " ".join(p), a, l, r, total[lang], score))
    return sorted(out)


def found(df):
    return sorted(tuple(r[c] for c in ("lang", "phrase", "a", "l", "r", "n", "score")) for r in df.collect())


@pytest.fixture(scope="module")
def rows():
    random.seed(5)
    words = ["the", "The", "of", "court", "clay", "é", "x" * 80, "X" * 80, "ÀB", "set-point", "a"]
    gaps = [" ", "  ", "\t", " ", " ", ", ", ".", "\n", "\r\n", "\x0b", "?! "]
    out = [(None, None), ("en", ""), ("en", " ,. \n"), ("en", "a" * 200)]
    for lang in ("en", "fr", None, "und"):
        for _ in range(30):
            out.append((lang, "".join(random.choice(words) + random.choice(gaps) for _ in range(random.randint(1, 60)))))
    out.append(("en", "match point " * 40_000))
    out += out[5:15]
    return out


@pytest.mark.parametrize("keys", [1_000_000, 40])
def test_phrases(spark, rows, monkeypatch, keys):
    """Also with words and candidates in many shards."""
    monkeypatch.setattr(phrases, "MOST_KEYS", keys)
    schema = "lang string, text string, no long, ids string, marks int"
    docs = spark.createDataFrame([(*r, k, "x", None) for k, r in enumerate(rows)], schema).repartition(4)
    assert found(collocations(docs, least=6)) == mined(rows, 6)


def test_nothing_frequent(spark):
    docs = spark.createDataFrame([("en", "a b c"), ("en", None)], "lang string, text string")
    assert found(collocations(docs)) == []
    assert found(collocations(docs.limit(0))) == []
    # Frequent words, but no frequent pair.
    docs = spark.createDataFrame([("en", "a. b.")] * 40, "lang string, text string")
    assert found(collocations(docs)) == []


def test_query_against_sql(spark):
    folder = "/root/testdata/sf0.001"
    connection = duckdb.connect()
    connection.execute(f"CREATE VIEW documents AS SELECT * FROM '{folder}/documents.parquet'")
    expected = sorted(connection.sql(phrases.ORACLE).fetchall())
    columns = ["lang", "rank", "phrase", "a", "l", "r", "n", "score"]
    rows = QUERIES["op13_phrases"](spark, folder).select(columns).collect()
    assert sorted(tuple(r) for r in rows) == expected and expected


def test_long_texts_are_counted_in_slices(monkeypatch):
    monkeypatch.setattr(phrases, "SLICE", 10)
    raw = b"one two,three  four\nfive sixsixsixsixsixsix seven"
    parts = list(phrases._slices(raw))
    assert b"".join(parts) == raw and len(parts) > 2
    words = [w for part in parts for w in part.translate(phrases._LOWER).split()]
    assert words == raw.translate(phrases._LOWER).split()


def test_tries_hold_their_keys_only():
    rng = np.random.default_rng(1)
    words = sorted({bytes(rng.integers(97, 103, rng.integers(1, 9)).astype(np.uint8)) for _ in range(5000)})
    flat = np.frombuffer(b"".join(words), np.uint8)
    offsets = np.cumsum([0] + [len(w) for w in words])
    trie = DoubleArray(flat, offsets, np.arange(1, len(words) + 1))
    number = {w: k for k, w in enumerate(words, 1)}
    asked = sorted({w + b"a" for w in words} | {w[:-1] for w in words if len(w) > 1} | set(words))
    flat = np.frombuffer(b"".join(asked), np.uint8)
    ends = np.cumsum([len(w) for w in asked])
    starts = ends - [len(w) for w in asked]
    got = trie.segments(flat, starts, ends, np.zeros(len(asked), np.int64))
    assert got.tolist() == [number.get(w, 0) for w in asked]
    assert trie.walk(words[7]) >= 0 and trie.walk(b"zz") == -1


@pytest.mark.parametrize("width", [1, 2, 3])
def test_tries_of_numbers(width):
    rng = np.random.default_rng(width)
    numbers = rng.integers(1, min(90, 256**width), 20_000).astype(np.int32)
    rows = np.unique(np.stack([numbers[:-2], numbers[1:-1], numbers[2:]], 1), axis=0)[::3]
    trie = DoubleArray(*number_keys(rows, width), np.arange(1, len(rows) + 1))
    number = {tuple(r): k for k, r in enumerate(rows.tolist(), 1)}
    at = np.arange(len(numbers) - 2)
    expected = [number.get(tuple(numbers[i : i + 3].tolist()), 0) for i in at]
    assert trie.sequences(numbers, at, 3, width).tolist() == expected


def test_candidates_are_made_once(spark, rows, monkeypatch):
    """However many tasks and places meet them."""
    made, stored = [], phrases.ordered

    def kept(df, order, label, *args, **kw):
        if label == "candidates":
            made.extend(tuple(r.ids) for r in df.select("ids").collect())
        return stored(df, order, label, *args, **kw)

    monkeypatch.setattr(phrases, "ordered", kept)
    monkeypatch.setattr(phrases, "MOST_HELD", 10)
    docs = spark.createDataFrame(rows, "lang string, text string").repartition(12)
    assert found(collocations(docs, least=6)) == mined(rows, 6)
    assert made and len(made) == len(set(made))
    sizes = Counter(map(len, made))
    assert set(sizes) == {2, 3, 4}


def test_a_pair_stands_for_its_phrase(spark):
    former = spark.createDataFrame([([7, 8], 1), ([8, 9], 2), ([9, 7], 3)], "ids array<int>, no bigint")
    pairs = spark.createDataFrame([((1 << 32) | 2,), ((2 << 32) | 3,)], "pair bigint")
    got = phrases._candidates(pairs, former, 3).collect()
    assert sorted(r.ids for r in got) == [[7, 8, 9], [8, 9, 7]]
    got = phrases._candidates(pairs, former, 2).collect()
    assert sorted(r.ids for r in got) == [[1, 2], [2, 3]]


def test_batches_are_bounded_in_bytes(spark, monkeypatch):
    """Few rows of long texts are many bytes; nothing changes for what runs afterwards."""
    setting, kept, sizes = "spark.sql.execution.arrow.maxBytesPerBatch", phrases.stored, []
    before = spark.conf.get(setting)

    def bytes_of(batches):
        for batch in batches:
            yield pa.RecordBatch.from_arrays([pa.array([batch.nbytes])], ["size_"])

    def measured(df, label):
        table = kept(df, label)
        if label in ("numbered", "marked"):
            sizes.extend(r.size_ for r in table.coalesce(1).mapInArrow(bytes_of, "size_ bigint").collect())
        return table

    monkeypatch.setattr(phrases, "stored", measured)
    text = "match point lost " * 6000
    docs = spark.createDataFrame([("en", text)] * 120, "lang string, text string").coalesce(1)
    assert len(found(collocations(docs))) > 0
    assert sum(sizes) > 3 * (12 << 20) and max(sizes) < 5 << 20
    assert spark.conf.get(setting) == before


def test_texts_are_read_once_for_all_shards(spark, rows, monkeypatch):
    """However many tries there are: the tables made and the rows in them are as many, and the same phrases."""
    kept, made = phrases.stored, []

    def counted(df, label):
        table = kept(df, label)
        made[-1].append((label, table.filter("ids IS NOT NULL").count() if label == "numbered" else None))
        return table

    monkeypatch.setattr(phrases, "stored", counted)
    docs = spark.createDataFrame(rows, "lang string, text string").repartition(3)
    results = []
    for keys in (1_000_000, 40):
        monkeypatch.setattr(phrases, "MOST_KEYS", keys)
        made.append([])
        results.append(found(collocations(docs, least=6)))
    assert made[0] == made[1] and [label for label, _ in made[0]].count("marked") == 3
    assert results[0] == results[1] == mined(rows, 6)


def test_places_go_to_the_shards_of_their_word():
    rng = np.random.default_rng(3)
    # Sorted first words of keys; a word may fill several shards or end one and begin the next.
    keys = np.sort(np.append(rng.integers(1, 60, 120) * 2, [50] * 70))
    shards = np.split(keys, range(25, len(keys), 25))
    lows, highs = np.array([s[0] for s in shards]), np.array([s[-1] for s in shards])
    first = rng.integers(0, 130, 1000)
    order, begins, ends = phrases._by_shard(first, lows, highs)
    assert sorted(order) == list(range(1000))
    for k in range(len(shards)):
        own = np.sort(order[begins[k] : ends[k]])
        assert own.tolist() == np.flatnonzero((first >= lows[k]) & (first <= highs[k])).tolist()


@pytest.mark.parametrize("n_langs", [1, 3, 500])
def test_distinct_words_of_each_language(n_langs):
    rng = random.Random(n_langs)
    texts = [" ".join(rng.choice(["a", "B", "b", "é", "cc", "Cc."]) for _ in range(rng.randint(0, 9))) for _ in range(600)]
    langs = [f"l{rng.randrange(n_langs)}" for _ in texts]
    batch = pa.RecordBatch.from_arrays([pa.array(langs), pa.array(texts)], ["lang", "text"])
    expected = Counter()
    for lang, text in zip(langs, texts):
        words = text.encode().translate(phrases._LOWER).split()
        expected.update((lang, w) for w in [*words, *[None] * len(words)])
    got = Counter()
    for part in phrases._word_counts(iter([batch.slice(0, 250), batch.slice(250)])):
        for lang, word, n in zip(*(c.to_pylist() for c in part.columns)):
            got[lang, word] += n
    assert got == expected


def test_counts_of_buckets_and_chunks_add_up(monkeypatch):
    """What tasks hand on in packed rows is the sum over all of them."""
    monkeypatch.setattr(phrases, "MOST_HELD", 20)
    rng = np.random.default_rng(8)
    marks = rng.integers(0, 6, 5000).astype(np.int32)
    column = phrases._binary(marks, np.arange(0, 5001, 500))
    batch = pa.RecordBatch.from_arrays([column], ["marks"])
    packed = list(phrases._pairs(7)(iter([batch.slice(0, 4), batch.slice(4)])))
    table = pa.Table.from_batches(packed).sort_by("bucket")
    got = [p for part in phrases._paired(170)(iter(table.to_batches(max_chunksize=3))) for p in part["pair"].to_pylist()]
    expected = Counter()
    for a in (0, 2000):  # the batches
        part = marks[a : 2000 if not a else 5000].astype(np.int64)
        expected.update(((part[:-1] << 32) | part[1:])[(part[:-1] > 0) & (part[1:] > 0)].tolist())
    assert sorted(got) == sorted(p for p, n in expected.items() if n >= 170) and 0 < len(got) < len(expected)

    counts = [rng.integers(0, 4, 40_000) * (rng.random(40_000) < 0.2) for _ in range(3)]
    arrays = [phrases._chunked(c, 30_000) for c in counts]
    batches = [pa.RecordBatch.from_arrays(list(a), ["chunk", "at", "times"]) for a in arrays]
    table = pa.Table.from_batches(batches).sort_by("chunk")
    summed = pa.Table.from_batches(list(phrases._summed(3)(iter(table.to_batches(max_chunksize=2)))))
    total = sum(counts)
    assert summed["no"].to_pylist() == (np.flatnonzero(total >= 3) + 30_001).tolist()
    assert summed["n"].to_pylist() == total[total >= 3].tolist()
