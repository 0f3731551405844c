"""Words that fall together under every polynomial modulo 2^64: results must tell them apart."""

from collections import Counter

import numpy as np
import public_tokenizers
import pyarrow as pa
import pytest
from tokenizers import Tokenizer

from courtledger.llm import blocks
from courtledger.llm.queries import QUERIES
from courtledger.llm.scoring import _words
from courtledger.llm.subwords import encoder

SIZES = [1024, 2048, 4096]


def twins(size, letters="ab"):
    """A Thue-Morse word and its complement."""
    bits = [bin(k).count("1") % 2 for k in range(size)]
    return "".join(letters[b] for b in bits), "".join(letters[1 - b] for b in bits)


def hashes(*words, lower=False):
    data, offsets = blocks.texts_of(pa.array(words))
    return blocks.segment_hashes(data, offsets[:-1], offsets[1:], lower)


@pytest.mark.parametrize("size", SIZES)
@pytest.mark.parametrize("letters", ["ab", "xz", "09", "é漢"])
def test_words_have_hashes_of_their_own(size, letters):
    one, other = twins(size, letters)
    assert len(set(hashes(one, other, one + other, other + one, one).tolist())) == 4


def test_equal_words_have_one_hash_wherever_they_stand():
    rng = np.random.default_rng(1)
    words = ["".join(rng.choice(list("abC"), rng.integers(1, 9))) for _ in range(20_000)]
    words += ["x" * n for n in (0, 1, blocks.SPAN - 1, blocks.SPAN, blocks.SPAN + 1)] * 2
    for lower in (False, True):
        known = [w.lower() if lower else w for w in words]
        found = hashes(*words, lower=lower).tolist()
        assert len(set(found)) == len(set(known)) == len(set(zip(known, found)))
    assert (hashes("", "ab", "", "b") == np.concatenate([hashes(w) for w in ("", "ab", "", "b")])).all()


@pytest.mark.parametrize("name", ["byte_bpe_50k.json", "word_bpe_49k.json"])
def test_ids_of_twins_are_the_library_s(name):
    path = public_tokenizers.path(name)
    texts = [word for size in SIZES for word in twins(size)] + [" ".join(twins(1024)), " ".join(twins(1024)[::-1])]
    library = Tokenizer.from_file(path)
    data, offsets = blocks.texts_of(pa.array(texts))
    for low, high, ids, first in encoder(path).encode(data, offsets):
        for k in range(low, high):
            expected = library.encode(texts[k], add_special_tokens=False).ids
            assert ids[first[k - low] : first[k - low + 1]].tolist() == expected


def test_twins_are_no_near_duplicates(spark, tmp_path):
    texts = [word for size in SIZES for word in twins(size)]
    docs = spark.createDataFrame([*enumerate(texts), (90, texts[0])], "doc_id bigint, text string")
    docs.write.parquet(f"{tmp_path}/documents.parquet")
    found = {r.doc_id: r.component_id for r in QUERIES["op7_minhash"](spark, str(tmp_path)).collect()}
    assert found == {**{k: k for k in range(len(texts))}, 90: 0}


def test_twins_are_counted_apart():
    texts = [" ".join(twins(1024)), twins(1024)[0], " ".join(twins(2048) * 2)]
    found = np.concatenate([words for *_, words, _ in _words(*blocks.texts_of(pa.array(texts)))])
    assert sorted(Counter(found.tolist()).values()) == sorted(Counter(" ".join(texts).split()).values())
