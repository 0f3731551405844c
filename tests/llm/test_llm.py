"""Every operator against a brute-force version, on rows with nulls, repeats and odd texts."""

import hashlib
import math
import random
import re
import zlib
from collections import Counter, defaultdict

import duckdb
import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from corpus_pipeline import STAGES, run
from courtledger.llm import attention, minhash, packing, scoring, suffixes, wavelet
from courtledger.llm.blocks import shingle_sets, texts_of
from courtledger.llm.chat import escape, parse, render_turn, unescape
from courtledger.llm.common import components
from courtledger.llm.decontamination import cut, drop_leaks, leaks, myers, normal
from courtledger.llm.lines import drop_repeated_lines
from courtledger.llm.minhash import drop_near_duplicates
from courtledger.llm.quality import keep_good, measures
from courtledger.llm.queries import CONFLICT, ORACLE, QUERIES
from courtledger.llm.sharding import balanced_shards
from courtledger.llm.subwords import encoder, ended_ids, vocabulary

LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
WORD = re.compile(r"[^\x20\x09-\x0D]+")


def found(query, spark, folder):
    return [r.asDict() for r in QUERIES[query](spark, folder).collect()]


def words_of(text):
    return WORD.findall((text or "").translate(LOWER))


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_empty_tables(spark, empty_tables, name):
    rows = QUERIES[name](spark, empty_tables).collect()
    assert len(rows) == (1 if name == "op4_chat" else 0)


def test_pipeline_on_empty_tables(spark, empty_tables):
    assert run(spark, empty_tables).count() == 0


def test_lines_against_sql(spark):
    folder = "/root/testdata/sf0.001"
    got = QUERIES["op1_lines"](spark, folder).orderBy("doc_id").collect()
    duck = duckdb.connect()
    duck.execute(f"CREATE VIEW documents AS SELECT * FROM '{folder}/documents.parquet'")
    want = duck.sql(f"SELECT doc_id, n_lines, n_removed, text FROM ({ORACLE['op1_lines']}) ORDER BY doc_id").fetchall()
    assert [tuple(r) for r in got] == want
    assert any(r.n_removed for r in got)


def test_lines_keep_columns_and_nulls(spark, tables):
    docs = spark.read.parquet(f"{tables}/documents.parquet")
    out = drop_repeated_lines(docs)
    assert out.columns == docs.columns and out.count() == docs.count()
    assert out.filter("text IS NULL").count() == docs.filter("text IS NULL").count()
    texts = {r.doc_id: r.text for r in out.collect()}
    assert len(texts[11] or "") < len(texts[9])


def _ids(text, name):
    return np.array([*encoder(vocabulary(name)).tokenizer.encode(text or "", add_special_tokens=False).ids, 2], "<u4")


@pytest.mark.parametrize("name", ["byte_bpe_50k.json", "word_bpe_49k.json"])
def test_ids_are_the_library_s(name):
    odd = ["", "a  b", "x\ny", "x \n y", " lead", "trail ", "it's I'll", "\x1c a b", "Σ ΟΣ.a", "e ́ x", "a  b", "<|endoftext|>x", "é,×,Éx!é"]
    random.seed(1)
    alphabet = "ab \n\t.,'!é×́ Σ<|>0中"
    odd += ["".join(random.choice(alphabet) for _ in range(random.randint(1, 40))) for _ in range(400)]
    got = [x.tolist() for x in ended_ids(pa.array([*odd, None]), vocabulary(name), 2)]
    assert got == [_ids(x, name).tolist() for x in [*odd, None]]


def test_packing(spark, tables, rows):
    out = found("op2_packing", spark, tables)
    want = Counter()
    for doc, text in rows:
        ids = _ids(text, "byte_bpe_50k.json")
        first = len(ids) % 1024 or 1024
        for k, (a, b) in enumerate(zip([0, *range(first, len(ids), 1024)], range(first, len(ids) + 1, 1024))):
            want[doc, k, a, b - a, zlib.crc32(ids[a:b])] += 1
    assert Counter((r["doc_id"], r["piece"], r["start"], r["length"], r["ids_crc32"]) for r in out) == want
    _gapless(out, "sequence_id", 1024)
    assert len({r["sequence_id"] for r in out}) <= -(-sum(r["length"] for r in out) // 1024) + 2


def _gapless(rows, name, capacity):
    by = defaultdict(list)
    for r in rows:
        by[r[name]].append((r["offset"], r["length"]))
    for parts in by.values():
        at = 0
        for offset, length in sorted(parts):
            assert offset == at
            at += length
        assert at <= capacity


@pytest.mark.parametrize("sizes", [[60] * 50, [1] * 300, [50, 51] * 40, [100] * 3, list(range(1, 101)) * 3])
def test_best_fit_places_everything(spark, sizes):
    items = spark.createDataFrame(list(enumerate(sizes)), "id bigint, size bigint").repartition(4)
    out = packing.best_fit(items, 100).collect()
    assert sorted(r.id for r in out) == list(range(len(sizes)))
    _gapless([{"s": r.sequence_id, "offset": r.offset, "length": sizes[r.id]} for r in out], "s", 100)
    if sizes[0] == 1:
        assert len({r.sequence_id for r in out}) <= -(-sum(sizes) // 100) + 1


def _distance(a, b):
    row = [0] * (len(b) + 1)
    for x in a:
        new = [row[0] + 1]
        for j, y in enumerate(b):
            new.append(min(row[j] + (x != y), row[j + 1] + 1, new[j] + 1))
        row = new
    return min(row)


def test_myers_is_the_edit_distance():
    random.seed(2)
    for _ in range(400):
        a = "".join(random.choice("abc") for _ in range(random.randint(1, 14)))
        b = "".join(random.choice("abc") for _ in range(random.randint(0, 30)))
        assert myers(a, b)[0] == _distance(a, b)
    assert "".join(p for _, p in cut("abcdefghij", 3)) == "abcdefghij"


def test_leaks(spark, tables):
    random.seed(5)
    letters = "abcdefghijklmnopqrstuvwxyz "
    text = lambda n: "".join(random.choice(letters) for _ in range(n))
    items = [(k, text(120)) for k in range(20)] + [(7, None), (8, "tiny"), (None, text(60))]
    docs = []
    for k in range(200):
        body = text(300)
        if k % 2:
            item = list(random.choice([t for _, t in items if t and len(t) > 50]))
            for _ in range(random.choice([0, 2, 5, 6, 9])):
                place = random.randrange(len(item))
                item[place : place + random.randint(0, 1)] = random.choice(["", "q", "zz"])
            body = body[:150] + "".join(item).upper() + "\t " + body[150:]
        docs.append((k, body))
    docs += [(200, None), (201, ""), docs[1]]
    frame = spark.createDataFrame(docs, "doc_id bigint, text string").withColumn("item_id", F.lit("clash"))
    benchmark = spark.createDataFrame(items, "item_id bigint, text string")
    want = Counter()
    for doc, body in docs:
        for item, t in items:
            if t and len(normal(t)) >= 25:
                d = _distance(normal(t), normal(body or ""))
                if d <= len(normal(t)) * 5 // 100:
                    want[doc, item, d] += 1
    for block in (16 << 20, 500):
        got = leaks(frame, benchmark, block_chars=block).collect()
        assert Counter((r.doc_id, r.item_id, r.distance) for r in got) == want
    kept = drop_leaks(frame, benchmark)
    dirty = {doc for doc, _, _ in want}
    assert kept.columns == frame.columns
    assert sorted(r.doc_id for r in kept.collect()) == sorted(d for d, _ in docs if d not in dirty)


def test_chat(spark, tables):
    out = {r["conv_id"]: r for r in found("op4_chat", spark, tables)}
    null = lambda x: (x is not None, x)
    by = defaultdict(list)
    for r in spark.read.parquet(f"{tables}/conversations.parquet").collect():
        by[r.conv_id].append((null(r.turn), r.role or "", r.text or ""))
    by[-1] = [((True, 0), "user", CONFLICT), ((True, 1), "assistant", CONFLICT)]
    assert out.keys() == by.keys()
    for conv, turns in by.items():
        turns.sort()
        told = "".join(f"{role}\n{text}\n" for _, role, text in turns)
        said = "".join(text for _, role, text in turns if role == "assistant")
        r = out[conv]
        assert r["n_turns"] == len(turns)
        assert r["turns_sha256"] == hashlib.sha256(told.encode()).hexdigest()
        assert (r["loss_chars"], r["loss_sha256"]) == (len(said), hashlib.sha256(said.encode()).hexdigest())


def test_turns_round_trip():
    random.seed(4)
    bits = ["<", "|", "\\", "<|", "<|im_end|>", "<|im_start|>", "\n", "a", "<|n|>", ">"]
    for _ in range(3000):
        role, text = ("".join(random.choice(bits) for _ in range(random.randint(0, 6))) for _ in "ab")
        formatted = render_turn(role, text)
        assert [t[:2] for t in parse(formatted)] == [(role, text)]
        assert formatted.count("<|im_") == 2
        assert unescape(escape(text)) == text


def test_shards_read_back(spark, tables, rows):
    out = sorted(found("op5_wavelet", spark, tables), key=lambda r: r["start"])
    ids = {i: _ids(t, "word_bpe_49k.json") for i, t in enumerate(t for _, t in rows)}
    want = Counter((doc, len(ids[i]), zlib.crc32(ids[i])) for i, (doc, _) in enumerate(rows))
    assert Counter((r["doc_id"], r["n_tokens"], r["ids_crc32"]) for r in out) == want
    at = 0
    for r in out:
        assert r["start"] == at
        at += r["n_tokens"]
    known = [r["doc_id"] for r in out if r["doc_id"] is not None]
    assert known == sorted(known)


@pytest.mark.parametrize("n, top", [(0, 1), (1, 1), (700, 2), (5000, 50_000), (300_000, 9)])
def test_wavelet_matrix(n, top):
    ids = np.random.default_rng(n).integers(0, top, n).astype(np.uint32)
    raw = wavelet.encode_shard(ids, np.array([n]), np.array([4]), np.array([0]))
    shard = wavelet.Shard(raw)
    assert (shard.decode() == ids).all()
    for place in {0, n // 3, n - 1} & set(range(n)):
        token = int(ids[place])
        assert shard.access(place) == token
        assert shard.count(token) == (ids == token).sum()
        assert shard.count(token, 5, n // 2) == (ids[5 : n // 2] == token).sum()
        places = np.flatnonzero(ids == token)
        for k in {0, len(places) // 2, len(places) - 1}:
            assert shard.locate(token, k) == places[k]
    assert shard.count(1 << 20) == 0


def _repeats(rows, length):
    seen = Counter()
    for _, text in rows:
        raw = (text or "").encode()
        seen.update(raw[i : i + length] for i in range(len(raw) - length + 1))
    for doc, text in rows:
        raw = (text or "").encode()
        gone = np.zeros(len(raw) + 1, dtype=bool)
        for i in range(len(raw) - length + 1):
            if seen[raw[i : i + length]] > 1:
                gone[i : i + length] = True
        kept = bytes(np.frombuffer(raw, np.uint8)[~gone[:-1]])
        spans = int((np.diff(gone.astype(int)) == 1).sum() + gone[0])
        yield doc, len(raw), int(gone.sum()), spans, hashlib.sha256(kept).hexdigest()


@pytest.mark.parametrize("hot", [2000, 1])
def test_repeated_bytes(spark, tables, rows, monkeypatch, hot):
    monkeypatch.setattr(suffixes, "HOT_SLICES", hot)
    monkeypatch.setattr(suffixes, "CHUNK", 4096)
    out = found("op6_suffixes", spark, tables)
    names = ["doc_id", "n_bytes", "n_removed", "n_spans", "kept_sha256"]
    assert Counter(tuple(r[c] for c in names) for r in out) == Counter(_repeats(rows, 200))


@pytest.mark.parametrize("hot", [2000, 20])
def test_ends_of_a_shared_passage_are_spread(spark, monkeypatch, hot):
    """A passage in 120 texts, with other bytes before and after it in each: no group that
    is sorted in a task has more than ``HOT_SLICES`` pieces."""
    monkeypatch.setattr(suffixes, "HOT_SLICES", hot)
    rng = random.Random(9)
    letters = lambda n: "".join(rng.choice("abcdefghijklmnop") for _ in range(n))
    passage = letters(430) + "é" + "xy" * 150
    rows = [(k, letters(rng.randint(200, 300)) + passage + letters(rng.randint(180, 260))) for k in range(120)]
    rows += [(500, rows[3][1][150:600]), (501, passage[:300]), (None, passage[:300]), (502, letters(500))]
    search = suffixes._search

    def watched(length):
        run = search(length)

        def met(batches):
            pieces = Counter()
            for batch in batches:
                pieces.update(batch["key"].to_pylist())
                assert max(pieces.values(), default=0) <= hot
                yield batch

        return lambda batches: run(met(batches))

    monkeypatch.setattr(suffixes, "_search", watched)
    docs = spark.createDataFrame(rows, "doc_id bigint, text string").repartition(3)
    out = suffixes.remove_repeats(docs).collect()
    got = Counter((r.doc_id, r.n_bytes, sum(s.stop - s.start for s in r.spans or []), len(r.spans or []),
                   hashlib.sha256(r.kept).hexdigest()) for r in out)
    assert got == Counter(_repeats(rows, 200))


def test_suffix_order():
    rng = np.random.default_rng(8)
    for _ in range(60):
        parts = [rng.integers(97, 97 + rng.integers(1, 4), rng.integers(1, 60)).astype(np.uint8) for _ in range(5)]
        text = np.concatenate([np.append(p + 1, 0) for p in parts]).astype(np.uint8)
        order = suffixes.suffix_order(text, 24)
        raw = text.tobytes() + bytes(40)
        assert sorted(order.tolist()) == list(range(len(text)))
        keys = [raw[i : i + 24] for i in order]
        assert keys == sorted(keys)


def _sets(text, size):
    words = words_of(text)
    if len(words) >= size:
        return frozenset(zip(*(words[k:] for k in range(size))))
    return frozenset([tuple(words)]) if words else frozenset()


def _linked(rows, size):
    sets = [_sets(t, size) for _, t in rows]
    root = list(range(len(rows)))

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    for i in range(len(rows)):
        for j in range(i):
            shared = len(sets[i] & sets[j])
            if shared and 100 * shared >= 80 * (len(sets[i]) + len(sets[j]) - shared):
                a, b = find(i), find(j)
                root[max(a, b)] = min(a, b)
    return sets, [find(i) for i in range(len(rows))]


def _families(seed, n):
    """Chains of near copies around the threshold, which single stars do not hold together."""
    rng = random.Random(seed)
    out = []
    for k in range(6):
        words = [f"f{k}x{i}" for i in range(rng.choice([4, 9, 30, 90]))]
        for _ in range(n):
            own = [rng.choice(words) if rng.random() < 0.04 else w for w in words]
            if rng.random() < 0.3:
                words = own
            out.append(" ".join(own))
    return out


@pytest.mark.parametrize("source", ["tables", 1, 2])
def test_near_duplicates(spark, tables, rows, source):
    if source != "tables":
        rows = list(enumerate(_families(source, 25)))
        docs = spark.createDataFrame(rows, "doc_id bigint, text string").repartition(4)
        import tempfile

        tables = tempfile.mkdtemp(prefix="near-")
        docs.write.mode("overwrite").parquet(f"{tables}/documents.parquet")
    out = found("op7_minhash", spark, tables)
    sets, roots = _linked(rows, 2)
    low = -(2**63)
    least = defaultdict(lambda: 2**63)
    for (doc, _), root in zip(rows, roots):
        least[root] = min(least[root], low if doc is None else doc)
    want = Counter(
        (doc, len(s), None if doc is None else least[r], doc is not None and least[r] == doc)
        for (doc, _), s, r in zip(rows, sets, roots)
    )
    assert Counter((r["doc_id"], r["n_shingles"], r["component_id"], r["kept"]) for r in out) == want


def test_near_duplicates_dropped(spark, tables):
    docs = spark.read.parquet(f"{tables}/documents.parquet").filter("doc_id IS NOT NULL")
    kept = drop_near_duplicates(docs)
    ids = {r.doc_id for r in kept.select("doc_id").collect()}
    assert kept.columns == docs.columns
    assert {0, 3, 4, 5, 14} <= ids and not {1, 2, 7, 13} & ids


def test_near_duplicates_leave_one_of_a_group(spark):
    """Also of repeated rows, of rows that share an id, and of rows without one."""
    rng = random.Random(12)
    fresh = lambda: " ".join(f"w{rng.randrange(10**6)}" for _ in range(100))
    a, b, c, d, e, f = (fresh() for _ in range(6))
    rows = [(1, a)] * 3 + [(1, a + " x"), (7, a)]
    rows += [(None, b), (None, b + " x"), (None, b), (3, b), (None, c), (None, d), (None, d)]
    rows += [(5, e), (5, f)] + [(9, "")] * 2 + [(None, None)] * 2
    docs = spark.createDataFrame([(*r, k) for k, r in enumerate(rows)], "doc_id bigint, text string, _uid int")
    kept = drop_near_duplicates(docs.repartition(3)).collect()
    groups = {x: name for name, x in zip("abcdef", (a, b, c, d, e, f))} | {a + " x": "a", b + " x": "b"}
    assert Counter(groups.get(r.text) for r in kept) == Counter({g: 1 for g in "abcdef"} | {None: 4})
    assert {r.doc_id for r in kept if groups.get(r.text) in ("a", "b")} == {1, None}
    assert all((r.doc_id, r.text) == rows[r._uid] for r in kept)


def test_components(spark):
    random.seed(6)
    edges = [(k, k + 1) for k in range(200)] + [(500 + random.randrange(40), 500 + random.randrange(40)) for _ in range(30)]
    got = {r.node: r.component for r in components(spark.createDataFrame(edges, "a bigint, b bigint")).collect()}
    root = {x: x for e in edges for x in e}
    for _ in range(300):
        for a, b in edges:
            root[a] = root[b] = min(root[a], root[b])
    linked = {x for a, b in edges if a != b for x in (a, b)}
    assert got == {x: root[x] for x in linked}


def _measure(text):
    text = text or ""
    words = WORD.findall(text)
    lines = [line for line in text.split("\n") if WORD.search(line)]
    windows = Counter(zip(words, words[1:], words[2:]))
    covered = {k + d for k in range(len(words) - 2) if windows[tuple(words[k : k + 3])] > 1 for d in range(3)}
    return (
        len(words),
        sum(map(len, words)),
        len(re.findall(r"[#*$%&|<>]", text)),
        len(lines) - len(set(lines)),
        len(covered),
        len(words) < 50 or 100 * len(covered) > 50 * len(words),
    )


def _distance_of_histograms(p, q):
    m = [(a + b) / 2 for a, b in zip(p, q)]
    kl = lambda x: sum(a * math.log2(a / b) for a, b in zip(x, m) if a)
    return math.sqrt(max(0.0, (kl(p) + kl(q)) / 2))


@pytest.mark.parametrize("bits", [24, 3])
def test_quality(spark, tables, rows, monkeypatch, bits):
    from courtledger.llm import quality

    names = ["n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed"]
    if bits != 24:  # texts with more words than places have bits take the other way
        monkeypatch.setattr(quality, "PLACE_BITS", bits)
    out = found("op8_quality", spark, tables)
    want = Counter((doc, *_measure(text)) for doc, text in rows)
    assert Counter((r["doc_id"], *(r[c] for c in names)) for r in out) == want


def test_divergence(spark, tables):
    from courtledger.llm.quality import COMMON_WORDS, OTHER

    folder = "/root/testdata/sf0.001"
    docs = spark.read.parquet(f"{folder}/documents.parquet")
    out = {r.k0: r for r in measures(docs, docs["doc_id"]).collect()}
    rows = docs.collect()

    def classes(text):
        words = WORD.findall(text)
        chars = sum(map(len, words))
        counts = [len(re.findall(f"[{c}]", text)) for c in ("A-Z", "0-9", r".,;:!?'\"()\-", "#*$%&|<>")]
        return [*counts, len(text) - chars, len(text.encode()) - len(text), max(0, chars - sum(counts))]

    def listed(row):
        lang = row.lang if row.lang in COMMON_WORDS else OTHER
        return lang, COMMON_WORDS.get(lang, "").split()

    chars, words, totals = defaultdict(lambda: [0] * 7), defaultdict(Counter), Counter()
    for r in rows:
        lang, known = listed(r)
        chars[lang] = [a + b for a, b in zip(chars[lang], classes(r.text))]
        own = [w.lower() for w in WORD.findall(r.text)]
        totals[lang] += len(own)
        words[lang].update(w for w in own if w in known)
    share = lambda x: [a / sum(x) for a in x]
    checked = 0
    for r in rows:
        got, (lang, known) = out[r.doc_id], listed(r)
        if len(r.text) >= 200:
            want = _distance_of_histograms(share(classes(r.text)), share(chars[lang]))
            assert got.char_distance == pytest.approx(want, abs=1e-6)
        own = [w.lower() for w in WORD.findall(r.text)]
        if len(own) >= 100:
            p = [own.count(w) / len(own) for w in known]
            q = [words[lang][w] / totals[lang] for w in known]
            want = _distance_of_histograms([*p, 1 - sum(p)], [*q, 1 - sum(q)])
            assert got.word_distance == pytest.approx(want, abs=1e-6)
            checked += 1
    assert checked > 50
    kept = keep_good(docs)
    assert kept.columns == docs.columns
    assert {r.doc_id for r in kept.collect()} == {k for k, r in out.items() if r.kept}


def test_shards_are_even(spark, tables, rows):
    out = found("op9_sharding", spark, tables)
    want = Counter((doc, len((t or "").encode()) + 1, zlib.crc32((t or "").encode())) for doc, t in rows)
    assert Counter((r["doc_id"], r["size"], r["text_crc32"]) for r in out) == want
    by = defaultdict(list)
    for r in out:
        by[r["shard"]].append(r["slot"])
    assert all(sorted(x) == list(range(len(x))) for x in by.values()) and set(by) <= set(range(8))


def test_links_stay_together_under_quotas(spark):
    rng = random.Random(9)
    nodes = [(k, k // 3 if k < 6000 else None, rng.randint(50, 150)) for k in range(20_000)]
    nodes += [(20_000 + k, 999_999, 100) for k in range(10_000)]  # a link with a third of all bytes
    out = balanced_shards(spark.createDataFrame(nodes, "uid bigint, link bigint, size bigint"), 8).collect()
    shard = {r.uid: r.shard for r in out}
    assert len(shard) == len(nodes)
    loads, of_hot, apart = Counter(), Counter(), 0
    groups = defaultdict(set)
    for uid, link, size in nodes:
        loads[shard[uid]] += size
        if link == 999_999:
            of_hot[shard[uid]] += size
        elif link is not None:
            groups[link].add(shard[uid])
    even = sum(loads.values()) / 8
    assert all(abs(x - even) < 0.01 * even for x in loads.values())
    assert sum(len(g) == 1 for g in groups.values()) > 0.95 * len(groups)
    assert max(of_hot.values()) > 0.9 * even


def test_scores(spark, tables, rows, monkeypatch):
    monkeypatch.setattr(scoring, "COMMON_WORDS", 50)
    out = [r.asDict() for r in scoring.score_texts(
        spark.read.parquet(f"{tables}/documents.parquet"), vocabulary("word_bpe_49k.json"), sample_blocks=300, common_words=50
    ).collect()]
    held = lambda doc: zlib.crc32(("" if doc is None else str(doc)).encode()) % 5 == 1
    counts = Counter(w for doc, t in rows if not held(doc) for w in [*words_of(t), None])
    total, below = sum(counts.values()), math.log10(sum(counts.values()) + 0.5 * (len(counts) + 1))
    want = defaultdict(list)
    for doc, text in rows:
        tokens = [*words_of(text), None]
        base = sum(math.log10(counts[w] + 0.5) - below for w in tokens)
        want[doc].append((held(doc), len(tokens), sum(counts[w] > 0 for w in tokens), total, base))
    assert len(out) == len(rows)
    for r in out:
        assert r["score"] < 0
        own = (r["held_out"], r["n_tokens"], r["n_known"], r["train_tokens"])
        assert any(own == x[:4] and r["base_score"] == pytest.approx(x[4]) for x in want[r["doc_id"]])


def test_attention_learns_from_every_block(spark):
    """More than the 8192 blocks that were once sampled, copies and empty texts among them."""
    rng = random.Random(4)
    texts = [" ".join(rng.choice("abcdefgh") for _ in range(rng.choice([3, 40, 80]))) for _ in range(6000)]
    texts += [texts[0]] * 500 + [""] * 20
    docs = spark.createDataFrame([(k % 6000, k % 7, t) for k, t in enumerate(texts)], "rid bigint, rth bigint, text string")
    path = vocabulary("word_bpe_49k.json")
    ids = ended_ids(pa.array(texts), path, scoring.END)
    blocks = sum(len(attention.blocks_of(x.astype(np.int64), scoring.START)) for x in ids)
    model, learnt = scoring.fit(docs.repartition(5), path, part_blocks=1000)
    assert blocks > 8192 and learnt == [blocks] * attention.EPOCHS
    model, learnt = scoring.fit(docs.limit(0), path)
    assert learnt == [] and np.isfinite(model.token).all()


def test_attention_model_is_a_distribution_and_learns():
    rng = np.random.default_rng(1)
    texts = [np.append(np.cumsum(rng.integers(1, 3, 70)) % 40, 48) for _ in range(150)]
    counts = np.bincount(np.concatenate(texts), minlength=50)
    blocks = np.concatenate([attention.blocks_of(t, 49) for t in texts])
    model = attention.train(counts, blocks, 49, 48)
    total = np.zeros(6)
    for last in range(50):  # the probabilities of all ids at the last place add up to one
        row = attention.blocks_of(np.array([3, 5, 7, 9, last]), 49)
        before = attention.blocks_of(np.array([3, 5, 7, 9]), 49)
        p = attention.log_probabilities(model, row).sum() - attention.log_probabilities(model, before).sum()
        total[0] += np.exp(p)
    assert total[0] == pytest.approx(1, abs=1e-3)
    fresh = [np.append(np.cumsum(rng.integers(1, 3, 70)) % 40, 48) for _ in range(30)]
    score = sum(attention.log_probabilities(model, attention.blocks_of(t, 49)).sum() for t in fresh)
    base = sum(np.log((counts[t] + 0.5) / (counts + 0.5).sum()).sum() for t in fresh)
    assert score > base + 0.3 * abs(base)


def _plain_loss(w, x, absent, target, valid):
    """What the attention model loses on the wanted classes, place by place in double precision."""
    size, losses = attention.BLOCK, []
    for b, i in zip(*np.nonzero(valid)):
        at = size + i
        q, keys, values = x[b, at] @ w["q"], x[b, : at + 1] @ w["k"], x[b, : at + 1] @ w["v"]
        score = keys @ q * attention.WIDTH**-0.5 + w["distance"][i, : at + 1]
        score[absent[b, : at + 1]] = -1e9
        a = np.exp(score - score.max())
        h = x[b, at] + a / a.sum() @ values @ w["o"]
        one, member = divmod(int(target[b, i]), attention.MEMBERS)
        for logits, k in (
            (h @ w["group"] + w["group_bias"], one),
            (h @ w["member"][one] + w["member_bias"][one], member),
        ):
            losses.append(np.log(np.exp(logits - logits.max()).sum()) + logits.max() - logits[k])
    return sum(losses) / valid.sum()


@pytest.mark.parametrize(("wide", "low"), [(0.1, 0), (3.0, 0), (0.1, -200)])
def test_gradients_are_those_of_the_plain_formula(wide, low):
    """Also where scores leave the range of plain exponentials, before a text and after its end."""
    rng = np.random.default_rng(3)
    shapes = {c: (attention.WIDTH,) * 2 for c in "qkvo"}
    shapes |= {"distance": (attention.BLOCK, 2 * attention.BLOCK), "group": (attention.WIDTH, attention.GROUPS)}
    shapes |= {"group_bias": (attention.GROUPS,), "member_bias": (attention.GROUPS, attention.MEMBERS)}
    shapes |= {"member": (attention.GROUPS, attention.WIDTH, attention.MEMBERS)}
    w = {c: (rng.standard_normal(s) * wide / 3).astype(np.float32) for c, s in shapes.items()}
    w["distance"] += low
    ids = np.concatenate([attention.blocks_of(np.arange(n), 7) for n in (40, 5)])
    absent, valid = ids[:, :-1] < 0, ids[:, attention.BLOCK + 1 :] >= 0
    x = (rng.standard_normal((len(ids), 2 * attention.BLOCK, attention.WIDTH)) * wide).astype(np.float32)
    target = rng.integers(0, attention.CLASSES, valid.shape)
    g, dx = attention._gradients(w, x, absent, target, valid)
    exact = {c: v.astype(np.float64) for c, v in w.items()} | {"x": x.astype(np.float64)}
    assert set(g) == set(w)
    for c, gradient in {**g, "x": dx}.items():
        step = gradient / np.linalg.norm(gradient) * 1e-5
        loss = [
            _plain_loss(moved, moved["x"], absent, target, valid)
            for moved in (exact | {c: exact[c] + step}, exact | {c: exact[c] - step})
        ]
        assert (loss[0] - loss[1]) / 2e-5 == pytest.approx(np.linalg.norm(gradient), rel=2e-3), c


def test_descent_takes_plain_steps():
    """Against steps over whole tables of weights, with classes and ids added up place by place."""
    rng = np.random.default_rng(6)
    texts = [np.append(rng.integers(0, 40, n), 58) for n in (*rng.integers(0, 90, 60), 0, 31, 32)]
    windows = np.concatenate([attention.blocks_of(t, 59) for t in texts])
    classes = np.append(rng.integers(0, attention.CLASSES, 58), [attention.CLASSES - 1, 5])
    w = attention.untrained(np.bincount(np.concatenate(texts), minlength=60), classes)
    assert len(windows) > 2 * attention.BATCH
    got, active, shown = attention.descend(w, classes, windows, 59, 1, 3)
    context = np.where(windows < 0, 59, windows)
    assert active.tolist() == np.unique(context).tolist() and 45 not in active
    assert shown.tolist() == np.bincount(context[:, :-1].ravel(), minlength=60)[active].tolist()
    want = {c: v.astype(np.float64) for c, v in w.items()}
    first, second = ({c: np.zeros_like(v) for c, v in want.items()} for _ in range(2))
    order, own = np.random.default_rng(3).permutation(len(windows)), slice(attention.BLOCK + 1, None)
    for step, at in enumerate(range(0, len(order), attention.BATCH), 1):
        ids, inputs = windows[order[at : at + attention.BATCH]], context[order[at : at + attention.BATCH], :-1]
        now = {c: v.astype(np.float32) for c, v in want.items()}
        x = now["class"][classes[inputs]] + now["own"][inputs]
        target = classes[np.maximum(ids[:, own], 0)]
        within = {c: v for c, v in now.items() if c not in ("class", "own")}
        g, dx = attention._gradients(within, x, ids[:, :-1] < 0, target, ids[:, own] >= 0)
        g |= {"class": np.zeros_like(want["class"]), "own": np.zeros_like(want["own"])}
        np.add.at(g["class"], classes[inputs], dx)
        np.add.at(g["own"], inputs, dx)
        for c in want:
            first[c] = 0.9 * first[c] + 0.1 * g[c]
            second[c] = 0.99 * second[c] + 0.01 * g[c].astype(np.float64) ** 2
            root = np.sqrt(second[c] / (1 - 0.99**step)) + 1e-8
            want[c] -= attention.RATE * first[c] / (1 - 0.9**step) / root
    for c in want:
        assert got[c] == pytest.approx(want[c][active] if c == "own" else want[c], abs=3e-4), c


def test_blocks_score_every_id_once():
    for n in (1, 31, 32, 33, 64, 100):
        ids = np.arange(100, 100 + n)
        own = attention.blocks_of(ids, 7)[:, attention.BLOCK + 1 :]
        assert own[own >= 0].tolist() == ids.tolist()


def test_shingle_sets_keep_texts_apart():
    texts = ["a b", "b a", "a", "A", "", " a  b ", "a b c", None]
    sets = [s.tolist() for s in shingle_sets(*texts_of(pa.array(texts)), 2)]
    assert sets[0] == sets[5] != sets[1] and sets[2] == sets[3] and sets[4] == sets[7] == []
    assert len(sets[6]) == 2 and set(sets[0]) < set(sets[6])


def test_pipeline_runs_stage_by_stage(spark):
    folder = "/root/testdata/sf0.001"
    docs = spark.read.parquet(f"{folder}/documents.parquet")
    names = [name for name, _ in STAGES]
    assert names == ["quality_rules", "line_dedup", "near_dedup", "decontamination", "packing"]
    out = run(spark, folder)
    rows = [r.asDict() for r in out.collect()]
    _gapless(rows, "sequence_id", 1024)
    assert 0 < len({r["doc_id"] for r in rows}) < docs.count()


def test_a_pair_leaves_its_buckets_once(spark):
    """Not once for each bucket that two sets share; nor are pairs lost by that."""
    rng = random.Random(4)
    sets = {c: {rng.randrange(1536) for _ in range(20)} for c in range(9)}
    sets[1] = set(list(sets[0])[:19]) | {1535}
    shared = {c: [10 * c + 1, 500, 501, 502] for c in sets} | {8: [81, 503]}
    # In some buckets the first component is the largest one, in others another.
    part = {c: 2 if c in (2, 3, 4) else c for c in sets}
    largest = {500: 2, 501: 0, 502: 1}
    words = lambda marks: [
        sum(1 << b for b in range(63) if 64 * k + b in marks) for k in range(minhash.MARKS)
    ]
    rows = [
        (bucket, largest[bucket], part[c], c, 20, 0, 0, sum(w.bit_count() for w in words(marks)), shared[c], *words(marks))
        for c, marks in sets.items()
        for bucket in shared[c]
        if bucket in largest
    ]
    schema = "bucket bigint, largest bigint, component bigint, c bigint, n bigint, s1 bigint, s2 bigint, marked int, "
    schema += "bands array<bigint>, " + ", ".join(f"m{k} bigint" for k in range(minhash.MARKS))
    left = spark.createDataFrame(rows, schema)
    every = [tuple(sorted((r.a, r.b))) for r in minhash._across(left, 0).collect()]
    assert sorted(every) == [(a, b) for a in range(8) for b in range(a + 1, 8) if part[a] != part[b]]
    alike = [tuple(sorted((r.a, r.b))) for r in minhash._across(left, 80).collect()]
    assert alike == [(0, 1)]


def test_components_take_their_own_rows_as_edges(spark):
    """Repeated edges, both directions, loops; what was found stands for its edges."""
    schema = "a bigint, b bigint"
    found = components(spark.createDataFrame([(3, 1), (1, 3), (3, 1), (2, 2), (5, 4), (6, 5)], schema))
    assert {tuple(r) for r in found.collect()} == {(1, 1), (3, 1), (4, 4), (5, 4), (6, 4)}
    edges = found.toDF("a", "b").unionByName(spark.createDataFrame([(6, 3), (8, 7)], schema))
    nodes = [tuple(r) for r in components(edges).collect()]
    assert sorted(nodes) == [(1, 1), (3, 1), (4, 1), (5, 1), (6, 1), (7, 7), (8, 7)]
    assert components(spark.createDataFrame([], schema)).collect() == []
