import os
import zlib

import numpy as np
import pytest

from laserfold.llm import wavelet
from tests.llm.data import PATH, awkward, documents, library_ids


@pytest.mark.parametrize("top", [1, 2, 300, 70_000])
@pytest.mark.parametrize("size", [0, 1, 5000])
def test_matrix_answers_like_the_plain_array(top, size, monkeypatch):
    monkeypatch.setattr(wavelet, "BLOCK_BITS", 1024)
    ids = np.random.default_rng(top + size).integers(0, top, size).astype(np.uint32)
    data = wavelet.pack_file([None, 3], np.array([size, 0]), ids)
    matrix = wavelet.WaveletMatrix.of_bytes(data)
    assert matrix.decode().tolist() == ids.tolist()
    assert matrix.doc_ids == [None, 3] and matrix.lengths.tolist() == [size, 0]
    for place in range(0, size, 613):
        assert matrix.access(place) == ids[place]
    for token in {0, 1, top - 1, top, 10**7, *(ids[:3].tolist() if size else [])}:
        places = np.flatnonzero(ids == token)
        assert matrix.count(token) == len(places)
        assert matrix.count(token, size // 3, size // 2) == np.sum(
            (places >= size // 3) & (places < size // 2)
        )
        if len(places) < 60:
            assert matrix.occurrences(token) == places.tolist()
        elif len(places):
            assert matrix.select(token, len(places) - 1) == places[-1]
        assert matrix.select(token, len(places)) == -1


def test_other_files_are_refused():
    with pytest.raises(ValueError):
        wavelet.WaveletMatrix.of_bytes(b"x" * 40)


@pytest.mark.parametrize("shard_tokens", [50, 10**6])
def test_awkward_rows_round_trip(spark, tmp_path, shard_tokens):
    folder = str(tmp_path)
    manifest = wavelet.write_shards(documents(spark), PATH, folder, shard_tokens=shard_tokens)
    got = wavelet.read_shards(manifest, folder).orderBy("start").collect()
    encoded = {}
    for doc_id, text, *_ in awkward():
        encoded.setdefault(doc_id, []).append(library_ids(text) + [2])
    ids = [r.doc_id for r in got]
    assert ids == sorted(ids, key=lambda d: (d is not None, d or 0))
    at = 0
    for row in got:
        assert row.start == at
        at += row.n_tokens
        sums = {zlib.crc32(np.array(x, "<u4").tobytes()): len(x) for x in encoded[row.doc_id]}
        assert sums[row.ids_crc32] == row.n_tokens
    assert len(got) == len(awkward())
    assert not [f for f in os.listdir(folder) if f.endswith(".tmp")]


def test_empty_table(spark, tmp_path):
    manifest = wavelet.write_shards(documents(spark, []), PATH, str(tmp_path))
    assert manifest.count() == 0
    assert wavelet.read_shards(manifest, str(tmp_path)).count() == 0
