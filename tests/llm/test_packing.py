import random
import zlib

import numpy as np
import pandas as pd
import pytest

from doctext.llm import packing
from doctext.llm.tokens import default_path, encoder


def test_hilbert_keys_walk_every_cell_once_by_single_steps():
    for dims, bits in ((2, 4), (3, 3), (4, 2)):
        cells = np.stack(np.meshgrid(*[np.arange(1 << bits)] * dims, indexing="ij"), -1).reshape(-1, dims)
        keys = packing.hilbert_keys(cells, bits)
        walk = cells[np.argsort(keys)]
        assert sorted(keys) == list(range(len(cells)))
        assert (np.abs(np.diff(walk, axis=0)).sum(axis=1) == 1).all()


def test_cached_ids_equal_the_library():
    enc, rng = encoder(default_path()), random.Random(3)
    bits = [" ", " ", "  ", "\n", "a", "The", "é", "12", "!", "..", "'s", "'", "\t", "\xa0", "\x1c", " ", "中",
            "\r\n", "😀", "_", "\x85", "<|endoftext|>", "word", "$$$", "-", "don't"]
    for _ in range(5000):
        text = "".join(rng.choice(bits) for _ in range(rng.randint(0, 12)))
        want = enc.tok.encode(text, add_special_tokens=False).ids
        assert np.frombuffer(enc.encode(text), "<u4").tolist() == want, text


@pytest.mark.parametrize("length", [1024, 7])
def test_pieces_round_trip(nasty, length):
    got = packing.pack(nasty, length=length, with_ids=True).toPandas()
    tok = encoder(default_path())
    want = sorted(tok.encode(r.text or "") + b"\0\0\0\0" for r in nasty.collect())
    assert all(zlib.crc32(r.ids) == r.ids_crc32 and len(r.ids) == 4 * r.length for r in got.itertuples())
    for _, g in got.groupby("sequence_id"):
        g = g.sort_values("offset")
        assert g.offset.tolist() == [0, *g.length.cumsum().tolist()[:-1]]
        n = int(g.length.sum())
        assert n == length or n & (n - 1) == 0 and n < length
    # Rows of one id lie one after the other on the curve, in order of their pieces.
    texts = []
    for _, g in got.assign(doc=got.doc_id.fillna(-1)).sort_values(["sequence_id", "offset"]).groupby("doc"):
        part = b""
        for r in g.itertuples():
            part += r.ids
            if len(part) == 4 * r.doc_tokens:
                texts.append(part)
                part = b""
        assert part == b""
    assert sorted(texts) == want


def test_empty_table_and_no_padding(empty, docs):
    assert packing.pack(empty).count() == 0
    got = packing.pack(docs([(i, "some words here " * (i % 50), "a") for i in range(300)])).toPandas()
    sizes = pd.Series(got.groupby("sequence_id").length.sum())
    assert (sizes == 1024).mean() > 0.2 and got.length.sum() == got.drop_duplicates("doc_id").doc_tokens.sum()
