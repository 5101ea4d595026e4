import numpy as np
import pytest

from netaudit.llm import wavelet


def sequences():
    rng = np.random.default_rng(4)
    yield np.zeros(0, dtype=np.uint16)
    yield np.array([5], dtype=np.uint16)
    yield np.zeros(1000, dtype=np.uint16)
    yield rng.integers(0, 50257, 3000).astype(np.uint16)
    yield np.minimum(rng.zipf(1.3, 600_000), 50256).astype(np.uint16)
    yield rng.integers(0, 200_000, 5000).astype(np.uint32)
    yield rng.integers(0, 4, wavelet.BLOCK_BITS).astype(np.uint16)
    yield rng.integers(0, 4, 2 * wavelet.BLOCK_BITS).astype(np.uint16)


@pytest.mark.parametrize("ids", list(sequences()), ids=lambda a: f"{a.dtype}-{len(a)}")
def test_against_the_sequence(ids):
    rng = np.random.default_rng(7)
    cuts = np.sort(rng.integers(0, len(ids) + 1, 3))
    lengths = np.diff(np.r_[0, cuts, len(ids)]).tolist()
    content = wavelet.image(ids, [3, None, -8, 2**60], lengths)
    shard = wavelet.Shard(content + b"\n")
    names, starts = shard.documents()
    assert names == [3, None, -8, 2**60] and starts.tolist() == [0, *cuts.tolist(), len(ids)]
    assert np.array_equal(shard.tokens(), ids)
    if len(ids):
        places = np.r_[0, len(ids) - 1, rng.integers(0, len(ids), 200)]
        assert np.array_equal(shard.access(places), ids[places])
    for token in {0, 1, 3, 5, 65_535, 300_000, -1, *ids[: 20].tolist()}:
        assert np.array_equal(shard.places(token), np.flatnonzero(ids == token)), token
        begin, end = np.sort(rng.integers(0, len(ids) + 1, 2)).tolist()
        assert shard.count(token) == int((ids == token).sum())
        assert shard.count(token, begin, end) == int((ids[begin:end] == token).sum())


def test_access_opens_one_block_a_plane():
    ids = np.random.default_rng(1).integers(0, 50257, 4 * wavelet.BLOCK_BITS).astype(np.uint16)
    shard = wavelet.Shard(wavelet.image(ids, [1], [len(ids)]))
    assert shard.access(np.array([77]))[0] == ids[77] and len(shard.held) == shard.planes == 16 and shard.blocks == 4


def test_common_ids_take_less():
    rare = np.random.default_rng(1).integers(0, 50257, 100_000).astype(np.uint16)
    common = np.minimum(np.random.default_rng(1).zipf(1.3, 100_000), 50256).astype(np.uint16)
    assert len(wavelet.image(common, [1], [100_000])) < len(wavelet.image(rare, [1], [100_000])) < 2.1 * 100_000


def test_other_bytes_are_refused():
    with pytest.raises(ValueError):
        wavelet.Shard(b"PAR1" + bytes(60))
    with pytest.raises(ValueError):
        wavelet.Shard(wavelet.image(np.arange(9, dtype=np.uint16), [1], [9])[:-1])
    with pytest.raises(ValueError):
        wavelet.image(np.arange(9, dtype=np.uint16), [1], [8])
