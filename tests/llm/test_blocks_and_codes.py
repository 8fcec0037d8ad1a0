"""The pre-tokeniser, Simple-8b coding and BK-trees against plain versions."""

import random

import numpy as np
import pyarrow as pa
import pytest
import regex
from hypothesis import given, settings
from hypothesis import strategies as st

import public_tokenizers
from corpusflow.llm import bktree, blocks, bpe, common, simple8b

PATTERN = regex.compile(public_tokenizers.PATTERN)


@settings(max_examples=200, deadline=None)
@given(st.lists(st.text(alphabet="ab sé1²\n\t '’strevlmd.,\u00a0\u3000漢😀ß-_\x1c\x85", max_size=20), max_size=8))
def test_pieces_equal_the_pattern(texts):
    raw, off = common.utf8(pa.array(texts, pa.string()))
    bounds, rows = common.split_pieces(raw, off, step=16)
    pieces = [bytes(raw[a:b]).decode() for a, b in zip(bounds[:-1], bounds[1:], strict=True)]
    assert [pieces[a:b] for a, b in zip(rows[:-1], rows[1:], strict=True)] == [PATTERN.findall(t) for t in texts]


@pytest.mark.parametrize("values", [
    [], [0], [0] * 3000, [2**64 - 1] * 5, [2**60 - 1, 2**60, 2**60 - 2, 0, 2**64 - 1, 7], list(range(2500)), [1 << k for k in range(64)],
])
def test_simple8b_round_trip(values):
    v = np.array(values, np.uint64)
    words, offsets = simple8b.pack_ids(v)
    assert (simple8b.unpack_ids(words, offsets, len(v)) == v).all()
    lengths, ids = simple8b.from_bytes(simple8b.to_bytes(np.array([len(v)]), v))
    assert lengths.tolist() == [len(v)] and (ids == v).all()


@settings(max_examples=60, deadline=None)
@given(st.lists(st.integers(0, 2**64 - 1) | st.integers(0, 300), max_size=400))
def test_simple8b_any_values(values):
    v = np.array(values, np.uint64)
    words, offsets = simple8b.pack_ids(v)
    assert (simple8b.unpack_ids(words, offsets, len(v)) == v).all()


def test_small_ids_take_few_bytes():
    assert len(simple8b.pack_ids(np.ones(6000, np.uint64))[0]) <= 6000 / 60 + 10


def test_not_a_file():
    with pytest.raises(ValueError):
        simple8b.from_bytes(b"x" * 64)


@pytest.mark.parametrize("words", [1, 4])
def test_forest_finds_all(words):
    rng = random.Random(words)
    base = [rng.getrandbits(64 * words) for _ in range(20)]
    every = [b ^ sum(1 << rng.randrange(64 * words) for _ in range(rng.randint(0, 6))) for b in base for _ in range(10)] + base + base[:3]
    prints = np.array([[(x >> 64 * k) & (2**64 - 1) for k in range(words)] for x in every], np.uint64)
    prints = prints.reshape(-1) if words == 1 else prints
    group = np.array([k % 3 for k in range(len(every))])
    forest = bktree.Forest(prints, group)
    found = {(int(a), int(b)) for who, node in forest.search(prints, forest.roots[group], 5) for a, b in zip(who, node, strict=True)}
    assert found == {(a, b) for a in range(len(every)) for b in range(len(every)) if group[a] == group[b] and (every[a] ^ every[b]).bit_count() <= 5}


def test_union():
    sets = bktree.Union(6)
    sets.link(np.array([5, 4, 1]), np.array([4, 3, 2]))
    assert sets.label.tolist() == [0, 1, 1, 3, 3, 3]


def test_packing():
    for values in (np.array([], np.int32), np.arange(1000, dtype=np.int32), np.array([2**63], np.uint64)):
        assert (common.unpack(common.pack(values), values.dtype) == values).all()
    texts = pa.array(["", "ä", "xyz"], pa.large_string())
    assert common.unpack_strings(common.pack_strings(texts)).to_pylist() == texts.to_pylist()
    assert common.unpack_strings(common.pack_strings(texts[:0])).to_pylist() == []


def every_code_point():
    """Texts in which each code point follows and precedes a letter, a digit, a space and itself."""
    points = [chr(c) for c in range(0x110000) if not 0xD800 <= c < 0xE000]
    return ["".join(f"a{c}1{c} {c}{c}b" for c in points[k : k + 4096]) for k in range(0, len(points), 4096)]


def test_every_code_point_as_the_libraries_split_it():
    path, tokens = bpe.vocabulary_path(), simple8b.word_encoder(simple8b.tokenizer_path())
    encoder = bpe.encoder(path)
    texts = every_code_point()
    for k in range(0, len(texts), 32):
        own = texts[k : k + 32]
        cut = bpe._cut("text", "id")(7, pa.RecordBatch.from_pydict({"id": pa.array(range(len(own)), pa.int64()), "text": own}), 3)
        rows = list(blocks.each(blocks.rows(cut)))
        replies = bpe._answer(path)((r["block"], r["bucket"], r["head"], r["body"]) for r in rows if r["bucket"] >= 0)
        found = bpe._lists([rows[0], *blocks.each(blocks.rows(list(replies)))]).to_pylist()
        assert [r["ids"] for r in found] == [encoder.encode_ordinary(t) for t in own]
        sizes, ids = simple8b.encode_batch(pa.array(own), tokens, 0)
        want = [[*tokens.tokenizer.encode(t, add_special_tokens=False).ids, 0] for t in own]
        assert sizes.tolist() == [len(w) for w in want] and ids.tolist() == [i for w in want for i in w]


@pytest.mark.parametrize("step", [1, 7, 100, 10**4])
def test_step_sizes_change_no_piece(step):
    rng = np.random.default_rng(step)
    texts = ["".join(rng.choice(list(" a1'é漢.\n\tsl"), n)) for n in (0, 1, 5, 400, 3, 0, 2500)]
    raw, off = common.utf8(pa.array(texts))
    for a, b in zip(common.split_pieces(raw, off), common.split_pieces(raw, off, step), strict=True):
        assert a.tolist() == b.tolist()


@pytest.mark.parametrize("step", [1, 3, 1000])
def test_steps_change_no_digest(monkeypatch, step):
    path = bpe.vocabulary_path()
    texts = ["", "hello world, this is it", None, "x", "", "one two three four " * 9, "", "é漢 '"]
    rows = list(blocks.each(blocks.rows(bpe._cut("text", "id")(1, pa.RecordBatch.from_pydict({"id": pa.array(range(len(texts)), pa.int64()), "text": texts}), 5))))
    replies = bpe._answer(path)((r["block"], r["bucket"], r["head"], r["body"]) for r in rows if r["bucket"] >= 0)
    every = [rows[0], *blocks.each(blocks.rows(list(replies)))]
    want = bpe._digests(every, path).to_pylist()
    monkeypatch.setattr(bpe, "_STEP", step)
    assert bpe._digests(every, path).to_pylist() == want
