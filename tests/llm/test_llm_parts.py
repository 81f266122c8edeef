"""Codes, sequences and embeddings by themselves."""

from __future__ import annotations

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from shoptrail.llm import decontaminate, simple8b
from shoptrail.llm.elias_fano import ContextTrie, EliasFano
from shoptrail.llm.suffix_dedup import eight_bytes, multikey_quicksort


@settings(max_examples=60, deadline=None)
@given(st.lists(st.one_of(st.integers(0, 1), st.integers(0, 50_000), st.integers(0, 2**64 - 1)), max_size=700))
def test_simple8b_round_trip(values):
    data = np.array(values, np.uint64)
    words, offsets = simple8b.pack(data)
    assert (simple8b.unpack(words, offsets, len(data)) == data).all()


def test_simple8b_is_compact():
    words, _ = simple8b.pack(np.zeros(25_600, np.uint64))
    assert len(words) == 25_600 // 256 * 5  # 256 ids of one bit: five words of 60


@settings(max_examples=40, deadline=None)
@given(st.sets(st.integers(0, 2**40 - 1), max_size=300))
def test_elias_fano(values):
    data = np.array(sorted(values), np.uint64)
    sequence = EliasFano(*EliasFano.build(data, 40))
    if len(data):
        assert (sequence.access(np.arange(len(data))) == data).all()
    assert sequence.find(data).tolist() == list(range(len(data)))
    absent = np.array([v for v in range(50) if v not in values], np.uint64)
    assert (sequence.find(absent) == -1).all()


def test_trie_answers_like_a_dict():
    draw = np.random.default_rng(2)
    keys = np.unique((draw.integers(0, 300, 5000).astype(np.uint64) << np.uint64(28)) | draw.integers(0, 400, 5000).astype(np.uint64))
    codes = draw.integers(1, 255, len(keys)).astype(np.uint8)
    trie, table = ContextTrie(keys, codes, 28), dict(zip(keys.tolist(), codes.tolist()))
    asked = (draw.integers(0, 320, 3000).astype(np.uint64) << np.uint64(28)) | draw.integers(0, 420, 3000).astype(np.uint64)
    assert trie.query(asked).tolist() == [table.get(k, 0) for k in asked.tolist()]
    assert ContextTrie(keys[:0], codes[:0], 28).query(asked).sum() == 0


def test_multikey_quicksort_groups_equal_heads():
    draw = np.random.default_rng(3)
    data = draw.integers(97, 99, 4000).astype(np.uint8)
    data[2000:2600] = data[100:700]
    starts = np.arange(len(data) - 50)
    group = multikey_quicksort(eight_bytes(data), starts)
    seen = {}
    for s, g in zip(starts.tolist(), group.tolist()):
        assert seen.setdefault(data[s : s + 50].tobytes(), g) == g
    assert len(set(group.tolist())) == len(seen)


@pytest.mark.parametrize("words", [12, 35, 60])
def test_cgk_samples_reach_the_recall(words):
    """Items with as many random edits as are allowed, anywhere in a text: at least the target recall, less noise."""
    draw = np.random.default_rng(words)
    cfg = decontaminate.LeakSettings()
    found, tries = 0, 60
    texts = [" ".join(f"w{x}" for x in draw.integers(0, 4000, words)) for _ in range(20)]
    index = decontaminate.ItemIndex(list(range(20)), texts, cfg)
    for k in range(tries):
        item = list(index.items[k % 20][1])
        for _ in range(cfg.edits(words)):
            at, kind = int(draw.integers(len(item))), int(draw.integers(3))
            if kind == 0:
                item[at] = np.uint64(draw.integers(2**62))
            elif kind == 1:
                item.insert(at, np.uint64(draw.integers(2**62)))
            else:
                del item[at]
        noise = draw.integers(0, 2**62, 80, dtype=np.uint64)
        hashes = np.concatenate([noise[:30], np.array(item, np.uint64), noise[30:]])
        found += any(f[1] == k % 20 for f in index.find(hashes, np.zeros(len(hashes), np.int64)))
    assert found >= 0.95 * tries


def test_leaks_of_the_longer_items_of_a_class():
    """A copy of a 20-word item with four isolated substitutions keeps 11 pairs, one less than 19 words need."""
    draw = np.random.default_rng(20)
    texts = [" ".join(f"w{x}" for x in draw.integers(0, 1 << 40, n)) for n in [19, 20] * 15]
    index = decontaminate.ItemIndex(list(range(30)), texts, decontaminate.LeakSettings())
    assert [c[:2] for c in index.classes] == [(19, 20)]
    found = 0
    for k in range(1, 30, 2):
        item = index.items[k][1].copy()
        item[[3, 7, 11, 15]] = draw.integers(2**62, size=4)
        noise = draw.integers(0, 2**62, 80, dtype=np.uint64)
        hashes = np.concatenate([noise[:30], item, noise[30:]])
        found += any(f[1:3] == (k, 4) for f in index.find(hashes, np.zeros(len(hashes), np.int64)))
    assert found >= 14


@pytest.mark.parametrize("kind", ["substitute", "insert", "delete"])
@pytest.mark.parametrize("words", [44, 59, 100, 200])
def test_long_leaks_reach_the_target(words, kind):
    """Copies with as many edits of one kind as are allowed: the stated target recall, also for long items."""
    draw = np.random.default_rng(words)
    cfg = decontaminate.LeakSettings()
    texts = [" ".join(f"w{x}" for x in draw.integers(0, 4000, words)) for _ in range(20)]
    index = decontaminate.ItemIndex(list(range(20)), texts, cfg)
    found, tries = 0, 200
    for k in range(tries):
        item, edits = index.items[k % 20][1].copy(), cfg.edits(words)
        places = draw.choice(words, edits, replace=False)
        if kind == "substitute":
            item[places] = draw.integers(2**62, size=edits)
        elif kind == "insert":
            item = np.insert(item, places, draw.integers(2**62, size=edits).astype(np.uint64))
        else:
            item = np.delete(item, places)
        noise = draw.integers(0, 2**62, 80, dtype=np.uint64)
        hashes = np.concatenate([noise[:30], item, noise[30:]])
        found += any(f[1] == k % 20 for f in index.find(hashes, np.zeros(len(hashes), np.int64)))
    assert found >= cfg.target_recall * tries, found / tries


def test_records_of_a_buffer_are_not_held_several_times():
    """Packing a buffer takes little more memory than the buffer itself."""
    import tracemalloc

    from shoptrail.llm import phrases

    ids = (np.random.default_rng(1).zipf(1.3, (4, 200_000)) % 60_000).astype(np.uint64)
    weights, langs = np.ones(ids.shape[1], np.int64), ids[0] % np.uint64(4)
    tracemalloc.start()
    total = 0
    for _, blob in phrases._tiled(ids, weights, langs, 32, 3):
        total += int(phrases._tile_rows([blob])[0][4].sum())
    peak = tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    assert total == ids.shape[1] and peak < 2 * (ids.nbytes + weights.nbytes + langs.nbytes)


def test_rows_with_ids_leave_a_small_cache(monkeypatch):
    """A task remembers fewer pieces where its rows keep texts and ids, and forgets them at its end."""
    import pyarrow as pa

    from shoptrail.llm import bpe
    from shoptrail.llm.queries import tokenizer

    path, freed = tokenizer("word_bpe_49k.json"), []
    monkeypatch.setattr(bpe, "release", lambda: freed.append(len(bpe._MODELS[path].known) if path in bpe._MODELS else 0))
    words = [" ".join(f"w{k}x{j}" for j in range(50)) for k in range(400)]
    batch = pa.RecordBatch.from_pydict({"text": words})
    told = [[c for _, coded in bpe._coded(iter([batch] * 2), path, most) for c in coded] for most in (300, 100_000)]
    assert told[0] == told[1] and bpe.ROW_CACHE_WORDS < bpe.CACHE_WORDS
    assert freed == [0] * 4 and not bpe.word_bpe(path).older
